"""What bounds the work of one task and the shuffles of the stored views."""

import re

from pyspark.sql import functions as F

from mendwork.catalog import views
from mendwork.catalog.views import VIEWS, Views, small_tasks
from mendwork.operators import actors, analytics, labels
from tests.test_text_index import plan_of

SF = "/root/testdata/sf0.001"
_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _dealt(df):
    return re.findall(r"Arguments: hashpartitioning\((.*)\), \w+", plan_of(df))


def test_the_steps_of_the_activity_view_share_one_shuffle(spark):
    v = Views(spark, SF)
    plain, dealt = v.sql(VIEWS["activity"]), v.sql(VIEWS["activity"], "activity")
    assert len(_dealt(dealt)) == 1 < len(_dealt(plain))
    assert dealt.exceptAll(v.sql(VIEWS["activity"])).count() == 0 and dealt.count() == plain.count()


def test_small_tasks_leave_the_session_as_it_was(spark):
    given = spark.conf.get(_SIZE)
    with small_tasks(spark):
        assert int(spark.conf.get(_SIZE).rstrip("b")) == views.TASK_BYTES
    assert spark.conf.get(_SIZE) == given
    spark.conf.set(_SIZE, "8m")
    try:
        with small_tasks(spark):
            assert spark.conf.get(_SIZE) == "8m"
    finally:
        spark.conf.set(_SIZE, given)


def test_staging_is_dealt_out_by_activity_id_once(spark):
    staging = spark.createDataFrame(
        [("d", 1, "2026-01-01", "a", n, "CorrespondenceOpened") for n in ("x", "x", "y")] + [("d", 2, None, "a", n, "CorrespondenceOpened") for n in "xy"],
        "dialog_id string, dialog_activity_id int, source_ts string, actor_id string, actor_name string, activity_type string",
    ).withColumn("source_ts", F.col("source_ts").cast("timestamp_ntz"))
    acts = staging.select(F.col("dialog_activity_id").alias("id"), "dialog_id", F.col("source_ts").alias("created_at"), F.lit(16).alias("type_id")).distinct()
    owners = spark.createDataFrame([(1, 9, "none")], "id int, activity_id int, discriminator string").selectExpr("*", "'n' AS actor_name_entity_id")
    names = spark.createDataFrame([("a", "x", "n")], "actor_id string, name string, actor_name_entity_id string")
    made = actors.classify_staging(staging, acts, owners, names)
    assert {tuple(r) for r in made.collect()} == {("6_ambiguous_multiple_actors", 3), ("7_no_performed_by_actor", 2)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = _dealt(actors.classify_staging(staging, acts, owners, names))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # By content, by activity id, and by actor and name; activities, performers and names; the counts.
    assert len([d for d in dealt if "dialog_activity_id" in d]) == 2 and len(dealt) <= 8


def test_lines_are_searched_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(analytics, "LINES_PER_TASK", 100)
    lines = spark.range(1000).selectExpr("id AS line_no", "concat('Index Scan using \"IX_', id, '\"') AS line").coalesce(1)
    spread = analytics.spread_lines(lines)
    files = spread.groupBy(F.input_file_name()).count().collect()
    assert len(files) == 10 and max(r["count"] for r in files) < 200
    assert sorted(spread.collect()) == sorted(lines.collect())


def test_staged_labels_are_the_same_from_narrowed_lines(spark):
    v = Views(spark, SF)
    plain, narrow = v.sql(VIEWS["staging_label"]), v.sql(VIEWS["staging_label"], "staging_label")
    assert "AS l_suppkey" in plan_of(narrow) and "AS l_suppkey" not in plan_of(plain)
    # The temporary views of the tables are replaced by each reading, so the rows are taken one after the other.
    expected = sorted(map(tuple, v.sql(VIEWS["staging_label"]).collect()))
    assert sorted(map(tuple, v.sql(VIEWS["staging_label"], "staging_label").collect())) == expected


def _label_rows(spark):
    staging = spark.createDataFrame(
        [
            ("d1", "2026-01-01", "known", "Bin"), ("d1", "2026-01-02", "known", "Bin"), ("d1", "2026-01-03", "lost", "Bin"),
            ("d1", "2026-01-01", "lost", "Archive"), ("d1", "2026-01-01", None, "Archive"), ("d1", "2026-01-01", "lost", "Sent"),
            ("d1", "2026-01-01", "known", None), ("d1", "2026-01-01", "lost", None), ("d2", "2026-01-01", "known", "Archive"),
            ("d2", "2026-01-01", "known", "MarkedAsUnopened"), ("d9", "2026-01-01", "known", "Bin"), (None, "2026-01-01", "known", "Sent"),
        ],
        "dialog_id string, source_ts string, actor_id string, system_label string",
    )
    contexts = spark.createDataFrame([("c1", "d1"), ("c2", "d1"), ("c3", "d2")], "id string, dialog_id string")
    have = spark.createDataFrame([("c2", 2), ("c2", 1), ("c3", 2), ("c3", 9), ("c3", None)], "context_id string, label_id int")
    resolution = spark.createDataFrame([("known", "n1"), ("lost", None)], "actor_id string, actor_name_entity_id string")
    return staging, contexts, resolution, have


def test_left_behind_counts_each_staged_row_and_context_once(spark):
    staging, contexts, resolution, have = _label_rows(spark)
    made = labels.label_candidates(staging, contexts, resolution, have)
    assert sorted(map(tuple, made.collect())) == [
        ("c1", 2, "n1", "2026-01-02", "systemlabel:Bin"), ("c3", 4, "n1", "2026-01-01", "systemlabel:MarkedAsUnopened"),
    ]
    left = labels.label_left_behind(staging, contexts, resolution, made)
    # d1 has two contexts: its Archive and null labels count twice, its Bin rows once, for the context that had one.
    assert [tuple(r) for r in left.collect()] == [
        ("actor_unresolved", 7), ("guard_skipped_or_already_set", 5), ("no_matching_context", 2), ("out_of_scope_label", 2),
    ]


def test_staged_labels_are_dealt_out_by_dialog_once(spark):
    staging, contexts, resolution, have = _label_rows(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = _dealt(labels.label_candidates(staging, contexts, resolution, have))
        made = spark.createDataFrame([("c1", "systemlabel:Bin")], "entity_id string, label_name string")
        left = _dealt(labels.label_left_behind(staging, contexts, resolution, made))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows and resolution by actor, rows and contexts by dialog, contexts and labels by context.
    assert len(found) == 6 and len([d for d in found if "dialog_id" in d]) == 2
    # Rows and contexts by dialog, contexts and made labels by context, the counts and the resolution by actor, the reasons.
    assert len([d for d in left if "dialog_id" in d]) == 2 and not [d for d in left if "label" in d] and len(left) <= 8


def test_applied_labels_are_decided_once(spark):
    staging, contexts, resolution, have = _label_rows(spark)
    have = have.withColumn("created_at", F.lit("2025-01-01"))
    made = labels.label_candidates(staging, contexts, resolution, have)
    logs = spark.createDataFrame([], "id string, created_at string, name string, action string, context_id string")
    people = spark.createDataFrame([], "id string, actor_type_id int, created_at string, updated_at string, discriminator string, actor_name_entity_id string, label_log_id string")
    given = have.union(spark.createDataFrame([("c1", 1, "2025-01-01"), ("c1", None, "2025-01-01"), (None, 1, "2025-01-01")], have.schema))
    done = labels.apply_labels(made, given, logs, people)
    # c1 got a folder label, so its Default goes; those of c2 and of no context stay, as do labels without an id.
    assert {(r["context_id"], r["label_id"]) for r in done.labels.collect()} == {
        ("c1", 2), ("c1", None), ("c2", 1), ("c2", 2), ("c3", 2), ("c3", 4), ("c3", 9), ("c3", None), (None, 1),
    }
    assert done.labels.count() == 9 and done.logs.count() == done.actors.count() == 2
    for rows in done:
        assert "Window" not in plan_of(rows) and "collect_set" not in plan_of(rows)

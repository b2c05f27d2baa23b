import pytest
from pyspark.sql import functions as F

from mendwork.constants import Urns
from mendwork.operators import actors, backfill, harness, unopened
from mendwork.operators.equivalence import multiset_diff
from mendwork.plans.repairs import repair_actors, repair_labels, repair_unopened
from mendwork.streaming.discovery import discover_stream, stream_candidates

NOW = "2026-03-01"
P = "urn:demo:person:identifier-no:"
O = "urn:demo:organization:identifier-no:"


def ts(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def same(a, b):
    assert multiset_diff(a, b).count() == 0


@pytest.fixture(scope="module")
def label_world(spark):
    staging = ts(
        spark.createDataFrame(
            [
                ("d1", "2026-01-01", P + "1", "Bin"), ("d1", "2026-01-02", P + "1", "Archive"),
                ("d1", "2026-01-03", P + "1", "MarkedAsUnopened"), ("d2", "2026-01-01", P + "1", "Archive"),
                ("d2", "2026-01-05", P + "2", "Archive"), ("d3", "2026-01-01", P + "1", "Bin"),
                ("d4", "2026-01-01", O + "999999999", "Bin"), ("d5", "2026-01-01", O + "888888888", "Bin"),
                ("d6", "2026-01-01", P + "1", "Bin"), ("d2", "2026-01-01", P + "1", "Sent"),
            ],
            "dialog_id string, source_ts string, actor_id string, system_label string",
        ),
        "source_ts",
    )
    contexts = spark.createDataFrame([(f"c{i}", f"d{i}") for i in range(1, 6)], "id string, dialog_id string")
    have = ts(
        spark.createDataFrame(
            [("c1", 1, "2025-01-01"), ("c2", 1, "2025-01-01"), ("c3", 3, "2025-01-01"), ("c4", 1, "2025-01-01")],
            "context_id string, label_id int, created_at string",
        ),
        "created_at",
    )
    names = ts(
        spark.createDataFrame(
            [("n1", P + "1", "ANN", "2020-01-01"), ("n2", P + "1", "ANNE", "2021-01-01"), ("n3", P + "1", None, "2022-01-01"), ("n4", P + "2", "BO", "2020-01-01")],
            "id string, actor_id string, name string, created_at string",
        ),
        "created_at",
    )
    logs = ts(spark.createDataFrame([], "id string, created_at string, name string, action string, context_id string"), "created_at")
    people = ts(
        spark.createDataFrame([], "id string, actor_type_id int, created_at string, updated_at string, discriminator string, actor_name_entity_id string, label_log_id string"),
        "created_at", "updated_at",
    )
    register = spark.createDataFrame([("999999999", "ORG")], "org_no string, name string")
    return dict(staging=staging, contexts=contexts, labels=have, logs=logs, actors=people, actor_names=names, units=register.where("false"), subunits=register)


def test_label_repair_end_to_end_and_again(label_world):
    done = repair_labels(**label_world, now=NOW, batch_size=2, workers=2)
    outcome = {(r["entity_id"], r["label_id"]): r["outcome"] for r in done.candidates.collect()}
    # c1 asks for Bin and Archive: the smaller label wins whatever the batches are. c3 has a folder, c5 no actor.
    assert outcome == {("c1", 2): "updated", ("c1", 3): "skipped_state_changed", ("c1", 4): "updated", ("c2", 3): "updated", ("c4", 2): "updated"}
    held = {(r["context_id"], r["label_id"]) for r in done.tables["labels"].collect()}
    assert held == {("c1", 2), ("c1", 4), ("c2", 3), ("c3", 3), ("c4", 2)}
    assert done.tables["logs"].count() == done.tables["actors"].count() == 4
    newest = done.candidates.where("entity_id = 'c2'").first()
    assert (newest["actor_name_entity_id"], str(newest["source_ts"])) == ("n4", "2026-01-05 00:00:00")
    assert {r["check"]: r["n"] for r in done.checks.collect()} == {
        "updated_missing_label": 0, "folder_update_still_has_default": 0, "updated_without_matching_log": 0,
    }
    assert sum(r["claimed"] for r in done.log.collect()) == 5
    again = repair_labels(
        **{**label_world, **{k: done.tables[k] for k in ("labels", "logs", "actors", "actor_names")}}, now=NOW, candidates=done.candidates
    )
    same(again.tables["labels"], done.tables["labels"])
    same(again.tables["logs"], done.tables["logs"])
    one_batch = repair_labels(**label_world, now=NOW, batch_size=1000, workers=1)
    same(one_batch.tables["labels"], done.tables["labels"])
    same(one_batch.tables["logs"], done.tables["logs"])


def test_claims_are_disjoint_and_complete(spark):
    found = spark.range(1000).withColumnRenamed("id", "k")
    queue = harness.enqueue(None, found, ["k"], NOW)
    same(harness.enqueue(queue, found, ["k"], NOW), queue)
    rows = harness.claim(queue, ["k"], 30, workers=4).collect()
    assert sorted(r["k"] for r in rows) == list(range(1000))
    assert all(r["batch_no"] == r["k"] // 30 + 1 for r in rows)
    assert {r["worker_id"] for r in rows} == {f"worker-{i}" for i in range(1, 5)}


def test_null_guard_changes_nothing(spark):
    target = spark.createDataFrame([(1, None), (2, True)], "id int, flag boolean")
    new, touched = harness.apply_update(target, spark.createDataFrame([(1,), (2,), (3,)], "k int"), {"id": "k"}, {"flag": F.lit(False)}, F.col("t.flag"))
    assert {tuple(r) for r in new.collect()} == {(1, None), (2, False)}
    assert [r[0] for r in touched.collect()] == [2]


@pytest.fixture(scope="module")
def actor_world(spark):
    acts = ts(spark.createDataFrame([(f"a{i}", f"d{i}", "2026-01-01", 16) for i in range(1, 7)], "id string, dialog_id string, created_at string, type_id int"), "created_at")
    staging = ts(
        spark.createDataFrame(
            [
                ("d1", "a1", "2026-01-01", P + "1", "DOE JANE", "CorrespondenceOpened"),
                ("d1", "a1", "2026-01-01", P + "1", "DOE JANE", "CorrespondenceOpened"),
                ("d2", "a2", "2026-01-01", P + "2", "ROE RICK", "CorrespondenceOpened"),
                ("d3", "a3", "2026-01-01", P + "3", "NEW NAME", "CorrespondenceOpened"),
                ("d4", "a4", "2026-01-01", P + "1", "DOE JANE", "CorrespondenceOpened"),
                ("d4", "a4", "2026-01-01", P + "2", "ROE RICK", "CorrespondenceOpened"),
                ("d5", "a5", "2026-01-02", P + "1", "DOE JANE", "CorrespondenceOpened"),
                ("d6", "a6", "2026-01-01", "urn:demo:robot:1", "R", "CorrespondenceOpened"),
            ],
            "dialog_id string, dialog_activity_id string, source_ts string, actor_id string, actor_name string, activity_type string",
        ),
        "source_ts",
    )
    people = spark.createDataFrame([(f"p{i}", f"a{i}", "DialogActivityPerformedByActor", 1, "n0" if i != 2 else "n2") for i in range(1, 7)], "id string, activity_id string, discriminator string, actor_type_id int, actor_name_entity_id string")
    names = ts(spark.createDataFrame([("n0", P + "0", "X", "2020-01-01"), ("n1", P + "1", "DOE JANE", "2020-01-01"), ("n2", P + "2", "RICK ROE", "2020-01-01")], "id string, actor_id string, name string, created_at string"), "created_at")
    return dict(staging=staging, activities=acts, actors=people, actor_names=names)


def test_delta_holds_the_changed_rows_alone(spark):
    target = spark.createDataFrame([(1, True, "a"), (1, False, "b"), (2, True, "c"), (3, None, "d"), (None, True, "e")], "id int, flag boolean, v string")
    claimed = spark.createDataFrame([(1, 5), (1, 4), (3, 1), (9, 1)], "k int, to int")
    on, set_, guard = {"id": "k"}, {"v": F.col("c.to").cast("string"), "flag": F.lit(None).cast("boolean")}, F.col("t.flag")
    assert [tuple(r) for r in harness.update_delta(target, claimed, on, set_, guard).collect()] == [(1, "4", None)]
    new, touched = harness.apply_update(target, claimed, on, set_, guard)
    assert sorted(map(str, map(tuple, new.collect()))) == sorted(
        map(str, [(1, None, "4"), (1, False, "b"), (2, True, "c"), (3, None, "d"), (None, True, "e")])
    )
    assert [tuple(r) for r in touched.collect()] == [(1,)]


def test_actor_repair_end_to_end_and_again(actor_world):
    done = repair_actors(**actor_world, now=NOW, batch_size=1)
    assert {r["entity_id"]: r["outcome"] for r in done.candidates.collect()} == {"p1": "updated", "p3": "updated"}
    checks = {(r["check"], r["item"]): r["n"] for r in done.checks.collect()}
    assert checks == {("updated_not_at_target", None): 0, ("unexpected_actor_shape", None): 0, ("target_unexpected_scheme", None): 0, ("updated_per_scheme", "person"): 2}
    again = repair_actors(actor_world["staging"], actor_world["activities"], done.tables["actors"], done.tables["actor_names"], NOW, candidates=done.candidates)
    same(again.tables["actors"], done.tables["actors"])
    assert again.tables["actor_names"].count() == done.tables["actor_names"].count() == 4


def test_classification_covers_every_row_once(actor_world):
    resolution, _ = actors.resolve_actor_names(actor_world["staging"], actor_world["actor_names"])
    found = {r["reason"]: r["staging_rows"] for r in actors.classify_staging(actor_world["staging"], actor_world["activities"], actor_world["actors"], resolution).collect()}
    assert found == {"0_candidate": 3, "2_timestamp_mismatch": 1, "6_ambiguous_multiple_actors": 2, "8_actor_unresolved": 1, "9_already_correct": 1}


def test_chunks_never_split_a_key_and_add_up(spark, actor_world):
    staging = actor_world["staging"]
    chunks = actors.chunk_keys(staging, "dialog_activity_id", 3)
    ranges = actors.key_ranges(chunks, "dialog_activity_id").collect()
    assert sum(r["rows"] for r in ranges) == 8 and ranges[-1]["running_rows"] == 8
    assert all(a["high_key"] < b["low_key"] for a, b in zip(ranges, ranges[1:]))
    resolution, _ = actors.resolve_actor_names(staging, actor_world["actor_names"])
    args = (staging, actor_world["activities"], actor_world["actors"], resolution)
    whole = actors.candidates_by_chunk(chunks, *args)
    same(whole.drop("chunk_no"), actors.actor_candidates(*args))
    same(actors.candidates_by_chunk(chunks, *args, done_chunks=[1]), whole.where("chunk_no <> 1"))


def test_remap_refuses_an_unclear_mapping(spark, actor_world):
    legacy = ts(
        spark.createDataFrame(
            [("b1", "urn:demo:organizationnumber:5", "ORG", "2020-01-01"), ("g1", O + "5", "ORG", "2020-01-01"), ("g2", O + "5", "ORG", "2021-01-01")],
            "id string, actor_id string, name string, created_at string",
        ),
        "created_at",
    )
    found = spark.createDataFrame([], "entity_id string, target_actor_name_id string")
    resolution = spark.createDataFrame([], "actor_id string, name string, actor_name_entity_id string, source string")
    with pytest.raises(actors.RemapError):
        actors.remap_entities(legacy, actor_world["actors"], actor_world["activities"], found, resolution, NOW)
    done = actors.remap_entities(legacy.where("id <> 'g2'"), actor_world["actors"], actor_world["activities"], found, resolution, NOW)
    assert done.remaining.first()[0] == 0 and {r["id"] for r in done.actor_names.collect()} == {"g1"}


@pytest.fixture(scope="module")
def unopened_world(spark):
    dialogs = spark.range(40).select(
        "id", F.when(F.col("id") % 4 == 0, "correspondenceservice").when(F.col("id") % 4 == 1, "generic").alias("service_type"), (F.col("id") % 5 != 0).alias("has_unopened")
    )
    transmissions = spark.range(120).select("id", (F.col("id") % 40).alias("dialog_id"), F.when(F.col("id") % 9 == 0, 7).otherwise(1).alias("type_id"))
    activities = spark.range(300).select(
        "id", (F.col("id") % 37).alias("dialog_id"), (F.col("id") % 110).alias("transmission_id"),
        F.when(F.col("id") % 3 == 0, 16).otherwise(4).alias("type_id"),
        (F.lit("2026-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(0, CAST(id % 13 AS INT))")).alias("created_at"),
    )
    return dialogs, transmissions, activities


def test_cursor_batches_equal_one_pass(unopened_world):
    dialogs, _, activities = unopened_world
    cursor = unopened.Cursor("2026-01-01", "2026-01-02", "2026-01-01", -1)
    merged = None
    for _ in range(20):
        batch = unopened.discover_batch(activities, dialogs, cursor, 37)
        following = unopened.advance(cursor, batch)
        if following is None:
            break
        from mendwork.functions.durable import durable

        merged = durable(unopened.merge_candidates(merged, batch, "r", NOW))
        cursor = following
    else:
        pytest.fail("the cursor never ended")
    same(merged, unopened.discover_all(activities, dialogs, "2026-01-01", "2026-01-02", "r", NOW))


def test_unopened_repair_leaves_nothing_repairable(unopened_world):
    dialogs, transmissions, activities = unopened_world
    done = repair_unopened(dialogs, transmissions, activities, "2026-01-01", "2026-01-02", "r", NOW)
    checks = {r["check"]: r["n"] for r in done.checks.where("item IS NULL AND check <> 'skipped_reason'").collect()}
    assert checks == {"unprocessed": 0, "processed_still_repairable": 0}
    again = repair_unopened(done.tables["dialogs"], transmissions, activities, "2026-01-01", "2026-01-02", "r", NOW)
    same(again.tables["dialogs"], done.tables["dialogs"])


def test_stream_discovery_equals_batch(spark, unopened_world, tmp_path):
    dialogs, _, activities = unopened_world
    dialogs.write.parquet(str(tmp_path / "dialogs"))
    activities.repartition(5).write.parquet(str(tmp_path / "activities"))
    schema = "id BIGINT, dialog_id BIGINT, transmission_id BIGINT, type_id INT, created_at TIMESTAMP_NTZ"
    args = (str(tmp_path / "activities"), str(tmp_path / "dialogs"), str(tmp_path / "out"), str(tmp_path / "cp"), "r", "2026-01-01", "2026-01-02", schema)
    for _ in range(2):  # the second run finds no new files and adds nothing
        discover_stream(spark, *args).awaitTermination(120)
    same(stream_candidates(spark, str(tmp_path / "out"), NOW), unopened.discover_all(activities, dialogs, "2026-01-01", "2026-01-02", "r", NOW))


def seen_scenarios(
    spark, now="2026-06-01", scale=1.0, resource=Urns().resource
):
    """Dialogs in eleven known states and their seen log: (dialogs, seen_log).

    At ``scale`` 1 there are 400,000 dialogs, of which 162,001 must be fixed; id ranges shrink with ``scale``.
    """
    # fixed values: first id, end id (exclusive), org, migrated app, content date, mask, seen date
    ranges = (
        (0, 20_000, "acn", True, "2026-01-01", 1, None),
        (20_000, 40_000, "skd", True, "2026-01-01", 8, "2025-12-24"),
        (40_000, 60_000, "brg", True, "2026-01-01", 8, None),
        (60_000, 80_000, "svv", True, "2026-01-01", 1, "2025-12-24"),
        (100_000, 200_000, "ttd", False, "2026-01-01", 1, now),
        (200_000, 260_000, "ttd", False, "2026-01-01", 1, "2025-12-24"),
        (260_000, 300_000, "ttd", False, "2026-02-01", 1, None),
        (300_000, 330_000, "ttd", False, "2026-02-01", 8, None),
        (330_000, 350_000, "ttd", False, "2026-02-01", 8, now),
        (350_000, 352_001, "ttd", False, "2026-02-01", 24, now),
        (355_000, 365_000, "ttd", False, "2026-02-01", 8, "2025-12-24"),
    )
    ids = spark.range(int(400_000 * scale))

    def pick(index: int, default):
        value = F.when(F.lit(False), F.lit(default))
        for row in ranges:
            lo, hi = int(row[0] * scale), int(row[1] * scale)
            value = value.when((F.col("id") >= lo) & (F.col("id") < hi), F.lit(row[index]))
        return value.otherwise(F.lit(default))

    org = pick(2, "ttd")
    service = F.when(
        pick(3, False), F.concat(F.lit(resource + "app_"), org, F.lit("_a2-2802-10793"))
    ).otherwise(F.lit(resource + "ttd-service"))
    dialogs = ids.select(
        "id",
        org.alias("org"),
        service.alias("service"),
        pick(4, "2000-01-01").cast("timestamp_ntz").alias("content_updated_at"),
        pick(5, 1).cast("int").alias("mask"),
        F.lit(True).alias("is_seen"),
    )
    seen = ids.select(F.col("id").alias("dialog_id"), pick(6, None).cast("timestamp_ntz").alias("created_at"))
    return dialogs, seen.where(F.col("created_at").isNotNull())


def test_seen_scenarios_golden_number(spark):
    dialogs, seen = seen_scenarios(spark)
    new, fixes = backfill.backfill_seen(dialogs, seen)
    assert fixes.count() == 162_001
    assert new.where("NOT is_seen").count() == 162_001
    assert {r["org"] for r in backfill.backfill_totals(fixes).collect()} == {"ttd"}
    assert backfill.seen_fixes(new, seen).count() == 0

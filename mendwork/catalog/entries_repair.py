"""Harness, label, actor, unopened and backfill queries and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendwork.catalog.views import Views
from mendwork.functions.durable import durable, new_stage
from mendwork.operators import actors, backfill, harness, labels, unopened
from mendwork.streaming.discovery import discover_stream, stream_candidates

NOW = "2002-01-01"

# --- harness -------------------------------------------------------------------

_FOUND = "SELECT o_orderkey AS entity_id FROM orders WHERE o_totalprice > 200000 UNION ALL SELECT l_orderkey * 3 FROM lineitem"
_KEYS = ["entity_id"]


def _h_found(v: Views) -> DataFrame:
    return v.sql(_FOUND)


def _h_existing(v: Views) -> DataFrame:
    return v.candidate.where(F.col("outcome").isNotNull())


def h1_enqueue(v: Views) -> DataFrame:
    return harness.enqueue(_h_existing(v), _h_found(v), _KEYS, NOW).select("entity_id", "enqueued_at", "outcome")


def h2_dry_run(v: Views) -> DataFrame:
    return harness.dry_run(_h_found(v), _h_existing(v), _KEYS)


def h3_claim(v: Views) -> DataFrame:
    return harness.claim(v.candidate, _KEYS, batch_size=37, workers=4)


def h3_claim_capped(v: Views) -> DataFrame:
    return harness.claim(v.candidate, _KEYS, batch_size=50, workers=3, max_batches=5)


def _h_update(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    claimed = harness.claim(v.candidate, _KEYS, batch_size=37, workers=4)
    target, touched = harness.apply_update(
        v.dialog,
        claimed,
        on={"id": "entity_id"},
        set_={"has_unopened": F.lit(False), "mask": F.col("t.mask") + F.lit(100)},
        guard=F.col("t.has_unopened") & (F.col("t.status_id") == 2),
    )
    return claimed, target, touched


def h4_apply_update(v: Views) -> DataFrame:
    return _h_update(v)[1].select("id", "has_unopened", "mask", "is_seen")


def _h_marked(v: Views) -> tuple[DataFrame, DataFrame]:
    claimed, _, touched = _h_update(v)
    return claimed, harness.mark(v.candidate, claimed, touched, _KEYS, NOW)


def h5_mark(v: Views) -> DataFrame:
    return _h_marked(v)[1].select("entity_id", "processed_at", "worker_id", "outcome")


def h6_batch_log(v: Views) -> DataFrame:
    claimed, marked = _h_marked(v)
    return harness.batch_log(marked, claimed, _KEYS, NOW, "2002-01-01 00:10:00")


def h7_progress(v: Views) -> DataFrame:
    return harness.progress(v.candidate)


def h8_progress_eta(v: Views) -> DataFrame:
    rounded = [F.round(c, 6).alias(c) for c in ("rows_per_sec", "eta_seconds")]
    return harness.progress_eta(v.candidate, v.batch_log).select(
        "total", "processed", "remaining", "updated", "skipped", "pct_done", *rounded
    )


def h9_recent_throughput(v: Views) -> DataFrame:
    return harness.recent_throughput(v.batch_log, "2024-01-20 12:00:00", minutes=60 * 24 * 5)


def h10_worker_throughput(v: Views) -> DataFrame:
    return harness.worker_throughput(v.batch_log)


def h11_verify(v: Views) -> DataFrame:
    return harness.verify(v.candidate, v.dialog, {"id": "entity_id"}, F.col("has_unopened"))


def h12_shelve(v: Views) -> DataFrame:
    bad = v.dialog.where("deleted").select(F.col("id").alias("entity_id"))
    return harness.shelve(v.candidate, bad, _KEYS, NOW).select("entity_id", "processed_at", "outcome")


_CLAIMED = """SELECT entity_id, CAST(floor((rn - 1) / 37) AS BIGINT) + 1 AS batch_no,
    concat('worker-', CAST(CAST(floor((rn - 1) / 37) AS BIGINT) % 4 + 1 AS VARCHAR)) AS worker_id
    FROM (SELECT entity_id, row_number() OVER (ORDER BY entity_id) AS rn FROM candidate WHERE processed_at IS NULL) x"""
_HIT = "c.entity_id IS NOT NULL AND has_unopened AND status_id = 2"
_MARKED = f"""SELECT k.entity_id,
    CASE WHEN c.entity_id IS NOT NULL THEN CAST('2002-01-01' AS TIMESTAMP) ELSE k.processed_at END AS processed_at,
    CASE WHEN c.entity_id IS NOT NULL THEN c.worker_id ELSE k.worker_id END AS worker_id,
    CASE WHEN c.entity_id IS NULL THEN k.outcome WHEN has_unopened AND status_id = 2 THEN 'updated'
         ELSE 'skipped_state_changed' END AS outcome, c.batch_no
    FROM candidate k LEFT JOIN ({_CLAIMED}) c ON c.entity_id = k.entity_id LEFT JOIN dialog d ON d.id = k.entity_id"""
_PROGRESS = """SELECT count(*) AS total, count(processed_at) AS processed, count(*) - count(processed_at) AS remaining,
    count(CASE WHEN outcome = 'updated' THEN 1 END) AS updated,
    count(CASE WHEN processed_at IS NOT NULL AND outcome IS DISTINCT FROM 'updated' THEN 1 END) AS skipped,
    min(processed_at) AS first_processed_at, max(processed_at) AS last_processed_at FROM candidate"""

# --- labels --------------------------------------------------------------------


def _resolution(v: Views) -> DataFrame:
    existing = labels.resolve_existing(v.staging_label, _text_names(v))
    return labels.finish_resolution(labels.resolve_from_registry(existing, v.units, v.subunits))


def _linked(v: Views) -> tuple[DataFrame, DataFrame]:
    names, resolution = labels.ensure_actor_names(_resolution(v), _text_names(v), NOW)
    return names, durable(resolution)


def l1_resolve_existing(v: Views) -> DataFrame:
    return labels.resolve_existing(v.staging_label, v.actor_name)


def l2_resolve_from_registry(v: Views) -> DataFrame:
    return labels.resolve_from_registry(labels.resolve_existing(v.staging_label, v.actor_name), v.units, v.subunits)


def l3_finish_resolution(v: Views) -> DataFrame:
    return labels.resolution_counts(_resolution(v))


def l4_ensure_actor_names(v: Views) -> DataFrame:
    names, resolution = _linked(v)
    return names.groupBy("actor_id", "name").agg(F.max("created_at").alias("created_at")).join(
        resolution.select("actor_id", "name", "source", F.col("actor_name_entity_id").isNotNull().alias("has_id")),
        ["actor_id", "name"],
    )


def _candidates(v: Views) -> DataFrame:
    _, resolution = _linked(v)
    return durable(labels.label_candidates(v.staging_label, v.context, resolution, v.context_label))


# New ActorName ids are hashes; the checks compare which actor and name they stand for.
def l5_label_candidates(v: Views) -> DataFrame:
    return _candidates(v).select("entity_id", "label_id", "source_ts", "label_name")


def l6_label_left_behind(v: Views) -> DataFrame:
    _, resolution = _linked(v)
    found = durable(labels.label_candidates(v.staging_label, v.context, resolution, v.context_label))
    return labels.label_left_behind(v.staging_label, v.context, resolution, found)


def _empty_logs(v: Views) -> tuple[DataFrame, DataFrame]:
    ids = v.context.limit(0)
    none = F.lit(None)
    logs = ids.select(
        none.cast("string").alias("id"), none.cast("timestamp_ntz").alias("created_at"),
        none.cast("string").alias("name"), none.cast("string").alias("action"), F.col("id").alias("context_id"),
    )
    people = ids.select(
        none.cast("string").alias("id"), none.cast("int").alias("actor_type_id"),
        none.cast("timestamp_ntz").alias("created_at"), none.cast("timestamp_ntz").alias("updated_at"),
        none.cast("string").alias("discriminator"), none.cast("string").alias("actor_name_entity_id"),
        none.cast("string").alias("label_log_id"),
    )
    return logs, people


def _applied(v: Views) -> tuple[DataFrame, labels.LabelChanges]:
    logs, people = _empty_logs(v)
    found = _candidates(v)
    done = labels.apply_labels(found, v.context_label, logs, people)
    return found, done._replace(labels=durable(done.labels), logs=durable(done.logs), actors=durable(done.actors))


def l7_apply_labels(v: Views) -> DataFrame:
    return _applied(v)[1].labels.select("context_id", "label_id", "created_at")


def l7_apply_labels_log(v: Views) -> DataFrame:
    _, done = _applied(v)
    return done.logs.join(done.actors.select(F.col("label_log_id").alias("id"), "discriminator"), "id").select(
        "context_id", "name", "action", "created_at", "discriminator"
    )


def l8_verify_labels(v: Views) -> DataFrame:
    found, done = _applied(v)
    # Every candidate is called updated, so those the folder rule skipped show up as offending.
    marked = found.withColumn("outcome", F.lit("updated"))
    return labels.verify_labels(marked, done.labels, done.logs, done.actors)


_EXISTING = """SELECT s.actor_id, n.name, n.id AS actor_name_entity_id,
    CASE WHEN n.id IS NOT NULL THEN 'existing' END AS source
    FROM (SELECT DISTINCT actor_id FROM staging_label) s LEFT JOIN (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY actor_id ORDER BY created_at DESC, id DESC) AS rn
                     FROM actor_name WHERE name IS NOT NULL) x WHERE rn = 1) n ON n.actor_id = s.actor_id"""
_REGISTERED = f"""SELECT e.actor_id, coalesce(e.name, u.name, b.name) AS name, actor_name_entity_id,
    coalesce(e.source, CASE WHEN coalesce(u.name, b.name) IS NOT NULL THEN 'brreg' END) AS source
    FROM ({_EXISTING}) e
    LEFT JOIN units u ON e.source IS NULL AND e.actor_id = concat('urn:demo:organization:identifier-no:', u.org_no)
    LEFT JOIN subunits b ON e.source IS NULL AND e.actor_id = concat('urn:demo:organization:identifier-no:', b.org_no)"""
_RESOLVED = f"SELECT actor_id FROM ({_REGISTERED}) r WHERE source IS NOT NULL"
_LABEL_MAP = "(VALUES ('Bin', 2), ('Archive', 3), ('MarkedAsUnopened', 4)) AS m(label_name, label_no)"
_CANDIDATES = f"""SELECT c.id AS entity_id, label_no AS label_id, max(source_ts) AS source_ts,
    concat('systemlabel:', system_label) AS label_name
    FROM staging_label s JOIN context c ON c.dialog_id = s.dialog_id JOIN {_LABEL_MAP} ON m.label_name = s.system_label
    WHERE s.actor_id IN ({_RESOLVED})
      AND (label_no NOT IN (2, 3) OR NOT EXISTS (SELECT 1 FROM context_label l WHERE l.context_id = c.id AND l.label_id IN (2, 3)))
      AND NOT EXISTS (SELECT 1 FROM context_label l WHERE l.context_id = c.id AND l.label_id = label_no)
    GROUP BY c.id, label_no, system_label"""
_ELIGIBLE = f"""SELECT * FROM ({_CANDIDATES}) k WHERE NOT (label_id = 3 AND EXISTS (
    SELECT 1 FROM ({_CANDIDATES}) k2 WHERE k2.entity_id = k.entity_id AND k2.label_id = 2))"""

# --- actors ----------------------------------------------------------------------


def _actor_resolution(v: Views) -> tuple[DataFrame, DataFrame]:
    resolution, new_rows = actors.resolve_actor_names(v.staging_actor, _text_names(v))
    return durable(resolution), new_rows


def _text_names(v: Views) -> DataFrame:
    return v.actor_name.withColumn("id", F.col("id").cast("string"))


def _text_actors(v: Views) -> DataFrame:
    return v.actor.withColumn("actor_name_entity_id", F.col("actor_name_entity_id").cast("string"))


def a1_reorder_name(v: Views) -> DataFrame:
    return v.cust.select(
        "c_custkey",
        actors.reorder_name(F.concat(F.lit(" "), "c_mktsegment", F.lit(" "), "c_name")).alias("name"),
        actors.reorder_name(F.col("c_name")).alias("single"),
    )


def a2_resolve_actor_names(v: Views) -> DataFrame:
    resolution, new_rows = _actor_resolution(v)
    return resolution.join(new_rows.select("actor_id", "name", "created_at"), ["actor_id", "name"], "left").select(
        "actor_id",
        "name",
        "source",
        F.when(F.col("source") != "inserted", F.col("actor_name_entity_id")).alias("known_id"),
        "created_at",
    )


def a3_resolution_report(v: Views) -> DataFrame:
    return actors.resolution_report(_actor_resolution(v)[0])


def a4_actor_candidates(v: Views) -> DataFrame:
    resolution, new_rows = _actor_resolution(v)
    found = actors.actor_candidates(v.staging_actor, v.activity, _text_actors(v), resolution)
    names = _text_names(v).select("id", "actor_id", "name").unionByName(new_rows.select("id", "actor_id", "name"))
    target = names.withColumnRenamed("id", "target_actor_name_id")
    return found.select("entity_id", "target_actor_name_id").join(target, "target_actor_name_id", "left").select(
        "entity_id", "actor_id", "name", F.col("target_actor_name_id").rlike("^[0-9]+$").alias("target_existed")
    )


def a5_key_ranges(v: Views) -> DataFrame:
    return actors.key_ranges(actors.chunk_keys(v.staging_actor, "dialog_activity_id", 1000), "dialog_activity_id")


def a5_chunk_totals(v: Views) -> DataFrame:
    chunks = actors.chunk_keys(v.staging_actor, "dialog_activity_id", 1000)
    made = actors.candidates_by_chunk(
        chunks, v.staging_actor, v.activity, _text_actors(v), _actor_resolution(v)[0]
    )
    return actors.chunk_totals(made, actors.key_ranges(chunks, "dialog_activity_id"))


def a6_classify_staging(v: Views) -> DataFrame:
    return actors.classify_staging(v.staging_actor, v.activity, _text_actors(v), _actor_resolution(v)[0])


def _actor_run(v: Views) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    resolution, new_rows = _actor_resolution(v)
    found = actors.actor_candidates(v.staging_actor, v.activity, _text_actors(v), resolution)
    names = _text_names(v).unionByName(new_rows)
    found = durable(found)
    new_actors, touched = actors.repoint_actors(_text_actors(v), found)
    marked = found.join(touched.withColumn("_hit", F.lit(True)), "entity_id", "left").select(
        "entity_id",
        "target_actor_name_id",
        F.when(F.col("_hit"), F.lit("updated")).otherwise(F.lit("skipped_state_changed")).alias("outcome"),
    )
    return new_actors, names, marked, touched


def a7_repoint_actors(v: Views) -> DataFrame:
    new_actors, names, _, _ = _actor_run(v)
    pointed = new_actors.join(
        names.select(F.col("id").alias("actor_name_entity_id"), "actor_id", "name"), "actor_name_entity_id", "left"
    )
    return pointed.select("id", "discriminator", "actor_id", "name")


def a8_verify_actors(v: Views) -> DataFrame:
    new_actors, names, marked, _ = _actor_run(v)
    return actors.verify_actors(marked, new_actors, names)


def _a9(v: Views) -> actors.Remapped:
    found = _text_actors(v).select(
        F.col("id").alias("entity_id"), F.col("actor_name_entity_id").alias("target_actor_name_id")
    )
    resolution = _text_names(v).select(
        "actor_id", "name", F.col("id").alias("actor_name_entity_id"), F.lit("inserted").alias("source")
    )
    return actors.remap_entities(_text_names(v), _text_actors(v), v.activity, found, resolution, NOW)


def a9_remap_entities(v: Views) -> DataFrame:
    done = _a9(v)
    named = done.actor_names.select(F.col("id").alias("actor_name_entity_id"), "actor_id", "name")
    return done.actors.join(named, "actor_name_entity_id", "left").select("id", "actor_id", "name")


def a9_remap_names(v: Views) -> DataFrame:
    return _a9(v).actor_names.select("actor_id", "name", "created_at")


_PAIRS = "SELECT actor_id, actor_name AS name, min(source_ts) AS first_use FROM staging_actor GROUP BY actor_id, actor_name"
_SPACE = "strpos(p.name, ' ')"
_RECOGNISED = """(p.actor_id LIKE 'urn:demo:person:identifier-no:%' OR p.actor_id LIKE 'urn:demo:organization:identifier-no:%'
    OR p.actor_id LIKE 'urn:demo:systemuser:uuid:%' OR p.actor_id LIKE 'urn:demo:person:idporten-email%'
    OR p.actor_id LIKE 'urn:demo:person:legacy-selfidentified%')"""
_TIERS = f"""SELECT p.actor_id, p.name,
    CASE WHEN e.id IS NOT NULL THEN 'existing_exact' WHEN r.id IS NOT NULL THEN 'existing_reordered'
         WHEN {_RECOGNISED} THEN 'inserted' END AS source,
    coalesce(e.id, r.id) AS known_id,
    CASE WHEN e.id IS NULL AND r.id IS NULL AND {_RECOGNISED} THEN p.first_use END AS created_at
    FROM ({_PAIRS}) p
    LEFT JOIN actor_name e ON e.actor_id = p.actor_id AND e.name = p.name
    LEFT JOIN actor_name r ON r.actor_id = p.actor_id AND p.actor_id LIKE 'urn:demo:person:%'
      AND r.name = concat(substr(p.name, {_SPACE} + 1), ' ', substr(p.name, 1, {_SPACE} - 1))"""
_EXPECTED = "CASE s.activity_type WHEN 'CorrespondenceOpened' THEN 16 WHEN 'CorrespondenceConfirmed' THEN 17 END"
_UNAMBIGUOUS = f"""SELECT a.id AS activity_id, min(s.actor_id) AS actor_id, min(s.actor_name) AS name
    FROM staging_actor s JOIN activity a ON a.id = s.dialog_activity_id AND a.dialog_id = s.dialog_id
      AND a.created_at = s.source_ts AND a.type_id = {_EXPECTED}
    GROUP BY a.id HAVING count(DISTINCT (s.actor_id, s.actor_name)) = 1"""
# A target is known by its id, or new and then known by its actor and name.
_ACTOR_CANDIDATES = f"""SELECT act.id AS entity_id, u.activity_id, t.known_id, t.actor_id, t.name
    FROM ({_UNAMBIGUOUS}) u
    JOIN actor act ON act.activity_id = u.activity_id AND act.discriminator = 'DialogActivityPerformedByActor'
    JOIN ({_TIERS}) t ON t.actor_id = u.actor_id AND t.name = u.name AND t.source IS NOT NULL
    WHERE t.known_id IS NULL OR act.actor_name_entity_id IS DISTINCT FROM t.known_id"""
_CHUNKS = """SELECT dialog_activity_id, n, CAST(upto AS BIGINT) AS upto, CAST(floor((upto - 1) / 1000) AS BIGINT) + 1 AS chunk_no
    FROM (SELECT dialog_activity_id, n, sum(n) OVER (ORDER BY dialog_activity_id) AS upto
          FROM (SELECT dialog_activity_id, count(*) AS n FROM staging_actor GROUP BY 1) x) y"""
_CANONICAL = "concat('urn:demo:organization:identifier-no:', split_part(b.actor_id, ':', 4))"
_BAD = "(SELECT * FROM actor_name WHERE actor_id LIKE 'urn:demo:organizationnumber:%')"

# --- unopened ----------------------------------------------------------------------

_START, _END = "1996-01-01", "1999-06-01"
_REPAIR = "flags_1996"


def u1_has_unopened_content(v: Views) -> DataFrame:
    return unopened.has_unopened_content(v.dialog, v.transmission, v.activity)


def _cursor() -> unopened.Cursor:
    return unopened.Cursor(_START, _END, "1996-05-01", 500)


def u2_discover_batch(v: Views) -> DataFrame:
    return unopened.discover_batch(v.activity, v.dialog, _cursor(), 500)


_PASS = ("2002-01-01 00:00:00", "2002-01-01 00:10:00")


def _discovery_log(v: Views) -> DataFrame:
    return unopened.discovery_log(v.activity, v.dialog, _START, _END, _REPAIR, 500, *_PASS)


def u2_discovery_log(v: Views) -> DataFrame:
    return _discovery_log(v).drop("batch_started_at", "batch_finished_at")


def u2_discovery_state(v: Views) -> DataFrame:
    return unopened.discovery_state(_discovery_log(v), _START, _END)


def u2_discover_stream(v: Views) -> DataFrame:
    """All activities written as files, discovered by a stream that takes what is there and ends."""
    root = new_stage(v.spark)
    v.activity.repartition(6).write.parquet(f"{root}/activities")
    v.dialog.write.parquet(f"{root}/dialogs")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in v.activity.schema)
    discover_stream(
        v.spark, f"{root}/activities", f"{root}/dialogs", f"{root}/out", f"{root}/cursor", _REPAIR, _START, _END, schema
    ).awaitTermination()
    return stream_candidates(v.spark, f"{root}/out", NOW).select(
        "repair_name", "dialog_id", "first_activity_created_at", "first_activity_id", "source_activity_count"
    )


def u4_process_log(v: Views) -> DataFrame:
    before = _u4_candidates(v)
    log = unopened.process_log(before, _processed(v).candidates, _REPAIR, 400, *_PASS)
    return log.drop("batch_started_at", "batch_finished_at")


def u6_phase_stats_of_run(v: Views) -> DataFrame:
    """Statistics of the logs that discovery and processing wrote."""
    both = _discovery_log(v).unionByName(
        unopened.process_log(_u4_candidates(v), _processed(v).candidates, _REPAIR, 400, *_PASS), allowMissingColumns=True
    )
    return unopened.phase_stats(both)


def _merged(v: Views) -> DataFrame:
    first = unopened.discover_batch(v.activity, v.dialog, _cursor(), 500)
    old = unopened.merge_candidates(None, first, _REPAIR, "2002-01-01")
    rest = unopened.scoped_activities(v.activity, v.dialog, _START, _END)
    return unopened.merge_candidates(old, rest, _REPAIR, "2002-01-02")


def u3_merge_candidates(v: Views) -> DataFrame:
    return _merged(v).select(
        "repair_name", "dialog_id", "first_activity_created_at", "first_activity_id", "source_activity_count", "discovered_at"
    )


def _u4_candidates(v: Views) -> DataFrame:
    """Discovered candidates, plus some whose dialog is gone or whose flag is already false."""
    found = unopened.discover_all(v.activity, v.dialog, _START, _END, _REPAIR, "2002-01-01")
    odd = v.sql(
        """SELECT CASE WHEN o_orderpriority < '2' THEN -o_orderkey ELSE o_orderkey END AS dialog_id,
                  o_orderdate AS first_activity_created_at, o_orderkey AS first_activity_id
           FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 1"""
    )
    return found.unionByName(
        odd.select(
            F.lit(_REPAIR).alias("repair_name"),
            "*",
            F.lit(1).cast("long").alias("source_activity_count"),
            F.lit("2002-01-01").cast("timestamp_ntz").alias("discovered_at"),
        ),
        allowMissingColumns=True,
    )


def _processed(v: Views, n: int | None = None) -> unopened.Processed:
    return unopened.process_candidates(_u4_candidates(v), v.dialog, v.transmission, v.activity, NOW, n, _REPAIR)


def u4_process_candidates(v: Views) -> DataFrame:
    return _processed(v, 1000).candidates.select("dialog_id", "processed_at", "updated_at", "skipped_reason")


def u4_process_all_dialogs(v: Views) -> DataFrame:
    return _processed(v).dialogs.select("id", "has_unopened", "is_seen")


def u5_repair_summary(v: Views) -> DataFrame:
    states = v.sql("SELECT DISTINCT concat('flags_', CAST(year(o_orderdate) AS VARCHAR(9))) AS repair_name FROM orders")
    return unopened.repair_summary(states, _processed(v, 1000).candidates)


def u6_verify_unopened(v: Views) -> DataFrame:
    # Checked against the dialogs before the repair, so the repairable ones show.
    return unopened.verify_unopened(_processed(v, 1000).candidates, v.dialog, v.transmission, v.activity)


def u6_first_repairable(v: Views) -> DataFrame:
    left = unopened.still_repairable(_processed(v).candidates, v.dialog, v.transmission, v.activity)
    return unopened.first_repairable(left, 100)


def u6_phase_stats(v: Views) -> DataFrame:
    log = v.sql(
        """SELECT CASE WHEN event_type < 'f' THEN 'discover' ELSE 'process' END AS phase, value AS batch_seconds,
                  event_id AS scanned_activities, user_id AS candidates_touched, event_id % 100 AS rows_selected,
                  CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 50 END AS rows_updated FROM events"""
    )
    return unopened.phase_stats(log).withColumn("avg_batch_seconds", F.round("avg_batch_seconds", 2)).withColumn(
        "total_seconds", F.round("total_seconds", 1)
    )


_TRUE_FLAG = """SELECT d.id AS dialog_id, coalesce(
      EXISTS (SELECT 1 FROM transmission t WHERE t.dialog_id = d.id AND t.type_id NOT IN (7, 8)
                AND NOT EXISTS (SELECT 1 FROM activity a WHERE a.transmission_id = t.id AND a.type_id = 4))
      OR (d.service_type = 'correspondenceservice'
          AND NOT EXISTS (SELECT 1 FROM activity a WHERE a.dialog_id = d.id AND a.type_id = 16)), false) AS has_unopened
    FROM dialog d"""
_SCOPED = f"""SELECT a.created_at, a.id, a.dialog_id FROM activity a JOIN dialog d ON d.id = a.dialog_id
    WHERE a.type_id IN (4, 16) AND a.created_at >= CAST('{_START}' AS TIMESTAMP)
      AND a.created_at < CAST('{_END}' AS TIMESTAMP) AND d.has_unopened"""
_FIRST_BATCH = f"""SELECT * FROM ({_SCOPED}) s WHERE (created_at > CAST('1996-05-01' AS TIMESTAMP)
    OR (created_at = CAST('1996-05-01' AS TIMESTAMP) AND id > 500)) ORDER BY created_at, id LIMIT 500"""


def _per_dialog(rows: str) -> str:
    return f"""SELECT dialog_id, min(created_at) AS ts, arg_min(id, (created_at, id)) AS aid, count(*) AS n
               FROM ({rows}) z GROUP BY dialog_id"""


_U4_ALL = f"""SELECT dialog_id, ts, aid FROM ({_per_dialog(_SCOPED)}) f
    UNION ALL SELECT CASE WHEN o_orderpriority < '2' THEN -o_orderkey ELSE o_orderkey END, o_orderdate, o_orderkey
    FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 1"""
def _u4(batch: str) -> str:
    done = f"""SELECT c.dialog_id, c.ts, c.aid, {batch} AS done, d.has_unopened AS flag, f.has_unopened AS computed
        FROM (SELECT *, row_number() OVER (ORDER BY ts, aid, dialog_id) AS rn FROM ({_U4_ALL}) q) c
        LEFT JOIN dialog d ON d.id = c.dialog_id LEFT JOIN ({_TRUE_FLAG}) f ON f.dialog_id = c.dialog_id"""
    return f"""SELECT dialog_id, CASE WHEN done THEN CAST('{NOW}' AS TIMESTAMP) END AS processed_at,
        CASE WHEN done AND flag AND NOT computed THEN CAST('{NOW}' AS TIMESTAMP) END AS updated_at,
        CASE WHEN NOT done OR (flag AND NOT computed) THEN NULL WHEN flag IS NULL THEN 'dialog_not_found'
             WHEN NOT flag THEN 'already_false' WHEN computed THEN 'still_has_unopened_content'
             ELSE 'not_updated_unknown' END AS skipped_reason
        FROM ({done}) g"""


_U4 = _u4("rn <= 1000")
_U4_WHOLE = _u4("true")

# --- backfill -----------------------------------------------------------------------

_SINCE = "1997-01-01"
_B_DIALOG = """SELECT id, org, content_updated_at, mask, is_seen,
    CASE WHEN id % 5 = 0 THEN NULL WHEN id % 4 = 1 THEN concat('urn:demo:resource:app_', org, '_a2-', CAST(id AS VARCHAR(20)))
         WHEN id % 4 = 2 THEN concat('urn:demo:resource:app-', org, 'Xa2-1') ELSE service END AS service FROM dialog"""


def b1_distinct_keys(v: Views) -> DataFrame:
    return backfill.distinct_keys(v.dialog, "org")


def b2_backfill_seen(v: Views) -> DataFrame:
    return backfill.backfill_seen(v.sql(_B_DIALOG), v.seen_log, _SINCE)[0].select("id", "org", "is_seen")


def b2_backfill_totals(v: Views) -> DataFrame:
    return backfill.backfill_totals(backfill.seen_fixes(v.sql(_B_DIALOG), v.seen_log, _SINCE))


_FIXES = f"""SELECT id, org FROM ({_B_DIALOG}) d
    WHERE content_updated_at >= CAST('{_SINCE}' AS TIMESTAMP) AND is_seen
      AND service NOT LIKE concat('urn:demo:resource:app_', org, '_a2-%')
      AND NOT ((mask & 8) = 0 AND EXISTS (SELECT 1 FROM seen_log s WHERE s.dialog_id = d.id AND d.content_updated_at < s.created_at))"""

_DISCOVERY_LOG = f"""SELECT '{_REPAIR}' AS repair_name, 'discover' AS phase, batch_no, CAST(600 AS DOUBLE) AS batch_seconds,
       count(*) AS scanned_activities, count(DISTINCT dialog_id) AS candidates_touched, max(created_at) AS cursor_created_at,
       arg_max(id, (created_at, id)) AS cursor_id, CAST(NULL AS VARCHAR) AS note
    FROM (SELECT *, (row_number() OVER (ORDER BY created_at, id) - 1) // 500 + 1 AS batch_no FROM ({_SCOPED}) s) x GROUP BY batch_no
    UNION ALL SELECT '{_REPAIR}', 'discover', 0, 600, 0, 0, max(created_at), arg_max(id, (created_at, id)), 'discovery complete' FROM ({_SCOPED}) s"""
_PROCESS_LOG = f"""SELECT '{_REPAIR}' AS repair_name, 'process' AS phase, batch_no, CAST(600 AS DOUBLE) AS batch_seconds,
       count(*) AS rows_selected, count(updated_at) AS rows_updated, any_value(total) - max(rn) AS remaining_candidates
    FROM (SELECT u.updated_at, q.rn, (q.rn - 1) // 400 + 1 AS batch_no, count(*) OVER () AS total
          FROM (SELECT *, row_number() OVER (ORDER BY ts, aid, dialog_id) AS rn FROM ({_U4_ALL}) a) q
          JOIN ({_U4_WHOLE}) u ON u.dialog_id = q.dialog_id) x GROUP BY batch_no"""

ENTRIES = {
    "h1_enqueue": (
        h1_enqueue,
        f"""SELECT entity_id, enqueued_at, outcome FROM candidate WHERE outcome IS NOT NULL
            UNION ALL SELECT DISTINCT entity_id, CAST('{NOW}' AS TIMESTAMP), CAST(NULL AS VARCHAR) FROM ({_FOUND}) f
            WHERE entity_id NOT IN (SELECT entity_id FROM candidate WHERE outcome IS NOT NULL)""",
    ),
    "h2_dry_run": (
        h2_dry_run,
        f"""SELECT count(DISTINCT entity_id) AS would_add FROM ({_FOUND}) f
            WHERE entity_id NOT IN (SELECT entity_id FROM candidate WHERE outcome IS NOT NULL)""",
    ),
    "h3_claim": (h3_claim, _CLAIMED),
    "h3_claim_capped": (
        h3_claim_capped,
        """SELECT entity_id, CAST(floor((rn - 1) / 50) AS BIGINT) + 1 AS batch_no,
             concat('worker-', CAST(CAST(floor((rn - 1) / 50) AS BIGINT) % 3 + 1 AS VARCHAR)) AS worker_id
           FROM (SELECT entity_id, row_number() OVER (ORDER BY entity_id) AS rn FROM candidate WHERE processed_at IS NULL) x
           WHERE rn <= 250""",
    ),
    "h4_apply_update": (
        h4_apply_update,
        f"""SELECT id, CASE WHEN {_HIT} THEN false ELSE has_unopened END AS has_unopened,
                   CASE WHEN {_HIT} THEN mask + 100 ELSE mask END AS mask, is_seen
            FROM dialog d LEFT JOIN ({_CLAIMED}) c ON c.entity_id = d.id""",
    ),
    "h5_mark": (h5_mark, f"SELECT entity_id, processed_at, worker_id, outcome FROM ({_MARKED}) m"),
    "h6_batch_log": (
        h6_batch_log,
        f"""SELECT batch_no AS batch_id, worker_id, CAST('{NOW}' AS TIMESTAMP) AS started_at,
                   CAST('2002-01-01 00:10:00' AS TIMESTAMP) AS finished_at, count(*) AS claimed,
                   count(CASE WHEN outcome = 'updated' THEN 1 END) AS updated,
                   count(CASE WHEN outcome <> 'updated' THEN 1 END) AS skipped
            FROM ({_MARKED}) m WHERE batch_no IS NOT NULL GROUP BY batch_no, worker_id""",
    ),
    "h7_progress": (h7_progress, _PROGRESS),
    "h8_progress_eta": (
        h8_progress_eta,
        f"""SELECT total, processed, remaining, updated, skipped, round(100.0 * processed / total, 2) AS pct_done,
                   round(rate, 6) AS rows_per_sec, round(remaining / rate, 6) AS eta_seconds
            FROM ({_PROGRESS}) p, (SELECT CAST(sum(claimed) AS DOUBLE)
                / (CAST(epoch_us(max(finished_at)) - epoch_us(min(started_at)) AS DOUBLE) / 1000000) AS rate
              FROM batch_log WHERE finished_at IS NOT NULL) r""",
    ),
    "h9_recent_throughput": (
        h9_recent_throughput,
        """SELECT count(*) AS batches, CAST(sum(claimed) AS BIGINT) AS claimed, CAST(sum(updated) AS BIGINT) AS updated,
                  round(CAST(sum(claimed) AS DOUBLE)
                    / (CAST(epoch_us(max(finished_at)) - epoch_us(min(started_at)) AS DOUBLE) / 1000000), 2) AS rows_per_sec
           FROM batch_log WHERE finished_at >= CAST('2024-01-15 12:00:00' AS TIMESTAMP)""",
    ),
    "h10_worker_throughput": (
        h10_worker_throughput,
        """SELECT worker_id, count(*) AS batches, min(started_at) AS first_batch_at,
                  max(coalesce(finished_at, started_at)) AS last_batch_at,
                  CAST(sum(updated) AS BIGINT) AS updated_total, CAST(sum(skipped) AS BIGINT) AS skipped_total,
                  round(avg(CAST(epoch_us(finished_at) - epoch_us(started_at) AS DOUBLE) / 1000000), 3) AS avg_batch_secs,
                  round(CAST(sum(updated) AS DOUBLE)
                    / (CAST(epoch_us(max(finished_at)) - epoch_us(min(started_at)) AS DOUBLE) / 1000000), 2) AS updates_per_sec
           FROM batch_log GROUP BY worker_id""",
    ),
    "h11_verify": (
        h11_verify,
        """SELECT 'unprocessed' AS "check", CAST(NULL AS VARCHAR) AS item, count(*) AS n FROM candidate WHERE processed_at IS NULL
           UNION ALL SELECT 'outcome', outcome, count(*) FROM candidate GROUP BY outcome
           UNION ALL SELECT 'updated_still_broken', NULL, count(*) FROM candidate JOIN dialog ON id = entity_id
                     WHERE outcome = 'updated' AND has_unopened""",
    ),
    "h12_shelve": (
        h12_shelve,
        f"""SELECT entity_id, CASE WHEN deleted THEN CAST('{NOW}' AS TIMESTAMP) ELSE processed_at END AS processed_at,
                   CASE WHEN deleted THEN 'manual_skip' ELSE outcome END AS outcome
            FROM candidate JOIN dialog ON id = entity_id""",
    ),
    "l1_resolve_existing": (l1_resolve_existing, _EXISTING),
    "l2_resolve_from_registry": (l2_resolve_from_registry, _REGISTERED),
    "l3_finish_resolution": (
        l3_finish_resolution,
        f"""SELECT coalesce(source, 'unresolved') AS source, count(*) AS actors, count(actor_name_entity_id) AS with_id
            FROM ({_REGISTERED}) r GROUP BY 1""",
    ),
    "l4_ensure_actor_names": (
        l4_ensure_actor_names,
        f"""SELECT r.actor_id, r.name, r.source, true AS has_id,
                   coalesce((SELECT max(created_at) FROM actor_name n WHERE n.actor_id = r.actor_id AND n.name = r.name),
                            CAST('{NOW}' AS TIMESTAMP)) AS created_at
            FROM ({_REGISTERED}) r WHERE r.name IS NOT NULL""",
    ),
    "l5_label_candidates": (l5_label_candidates, _CANDIDATES),
    "l6_label_left_behind": (
        l6_label_left_behind,
        f"""SELECT CASE WHEN c.id IS NULL THEN 'no_matching_context'
                        WHEN s.system_label NOT IN ('Bin', 'Archive', 'MarkedAsUnopened') THEN 'out_of_scope_label'
                        WHEN s.actor_id NOT IN ({_RESOLVED}) THEN 'actor_unresolved'
                        ELSE 'guard_skipped_or_already_set' END AS reason, count(*) AS staging_rows
            FROM staging_label s LEFT JOIN context c ON c.dialog_id = s.dialog_id
            LEFT JOIN ({_CANDIDATES}) k ON k.entity_id = c.id AND k.label_name = concat('systemlabel:', s.system_label)
            WHERE k.entity_id IS NULL GROUP BY 1""",
    ),
    "l7_apply_labels": (
        l7_apply_labels,
        f"""SELECT context_id, label_id, created_at FROM context_label l
            WHERE NOT (label_id = 1 AND context_id IN (SELECT entity_id FROM ({_ELIGIBLE}) e WHERE e.label_id IN (2, 3)))
            UNION ALL SELECT entity_id, label_id, source_ts FROM ({_ELIGIBLE}) e""",
    ),
    "l7_apply_labels_log": (
        l7_apply_labels_log,
        f"""SELECT entity_id AS context_id, label_name AS name, 'set' AS action, source_ts AS created_at,
                   'LabelAssignmentLogActor' AS discriminator FROM ({_ELIGIBLE}) e""",
    ),
    "l8_verify_labels": (
        l8_verify_labels,
        f"""WITH lost AS (SELECT count(*) AS n FROM ({_CANDIDATES}) k JOIN ({_CANDIDATES}) k2
                          ON k2.entity_id = k.entity_id WHERE k.label_id = 3 AND k2.label_id = 2)
            SELECT 'updated_missing_label' AS "check", CAST(NULL AS VARCHAR) AS item, n FROM lost
            UNION ALL SELECT 'folder_update_still_has_default', NULL, 0
            UNION ALL SELECT 'updated_without_matching_log', NULL, n FROM lost""",
    ),
    "a1_reorder_name": (
        a1_reorder_name,
        "SELECT c_custkey, concat(c_name, ' ', c_mktsegment) AS name, c_name AS single FROM cust",
    ),
    "a2_resolve_actor_names": (
        a2_resolve_actor_names,
        f"SELECT actor_id, name, source, CAST(known_id AS VARCHAR) AS known_id, created_at FROM ({_TIERS}) t",
    ),
    "a3_resolution_report": (
        a3_resolution_report,
        f"""SELECT 'source' AS section, coalesce(source, 'UNRESOLVED') AS item, count(*) AS actors FROM ({_TIERS}) t GROUP BY 2
            UNION ALL SELECT 'unresolved_scheme', concat_ws(':', split_part(actor_id, ':', 1), split_part(actor_id, ':', 2),
              split_part(actor_id, ':', 3)), count(*) FROM ({_TIERS}) t WHERE source IS NULL GROUP BY 2""",
    ),
    "a4_actor_candidates": (
        a4_actor_candidates,
        f"""SELECT entity_id, coalesce(n.actor_id, c.actor_id) AS actor_id, coalesce(n.name, c.name) AS name,
                   known_id IS NOT NULL AS target_existed
            FROM ({_ACTOR_CANDIDATES}) c LEFT JOIN actor_name n ON n.id = c.known_id""",
    ),
    "a5_key_ranges": (
        a5_key_ranges,
        f"""SELECT chunk_no, min(dialog_activity_id) AS low_key, max(dialog_activity_id) AS high_key,
                   CAST(sum(n) AS BIGINT) AS "rows", max(upto) AS running_rows FROM ({_CHUNKS}) c GROUP BY chunk_no""",
    ),
    "a5_chunk_totals": (
        a5_chunk_totals,
        f"""SELECT chunk_no, inserted, CAST(sum(inserted) OVER (ORDER BY chunk_no) AS BIGINT) AS running_total
            FROM (SELECT k.chunk_no, count(c.entity_id) AS inserted FROM ({_CHUNKS}) k
                  LEFT JOIN ({_ACTOR_CANDIDATES}) c ON c.activity_id = k.dialog_activity_id GROUP BY 1) x""",
    ),
    "a6_classify_staging": (
        a6_classify_staging,
        f"""SELECT CASE WHEN a.id IS NULL THEN '1_no_matching_activity_id'
                        WHEN a.created_at IS DISTINCT FROM s.source_ts THEN '2_timestamp_mismatch'
                        WHEN a.dialog_id IS DISTINCT FROM s.dialog_id THEN '3_dialog_id_mismatch'
                        WHEN {_EXPECTED} IS NULL THEN '4_unknown_activity_type'
                        WHEN a.type_id IS DISTINCT FROM {_EXPECTED} THEN '5_type_mismatch'
                        WHEN amb.n > 1 THEN '6_ambiguous_multiple_actors'
                        WHEN act.id IS NULL THEN '7_no_performed_by_actor'
                        WHEN t.source IS NULL THEN '8_actor_unresolved'
                        WHEN t.known_id IS NOT NULL AND act.actor_name_entity_id IS NOT DISTINCT FROM t.known_id
                          THEN '9_already_correct'
                        ELSE '0_candidate' END AS reason, count(*) AS staging_rows
            FROM staging_actor s LEFT JOIN activity a ON a.id = s.dialog_activity_id
            LEFT JOIN (SELECT s.dialog_activity_id, count(DISTINCT (s.actor_id, s.actor_name)) AS n
                       FROM staging_actor s JOIN activity a ON a.id = s.dialog_activity_id AND a.created_at = s.source_ts
                         AND a.dialog_id = s.dialog_id AND a.type_id = {_EXPECTED} GROUP BY 1) amb
              ON amb.dialog_activity_id = s.dialog_activity_id
            LEFT JOIN actor act ON act.activity_id = a.id AND act.discriminator = 'DialogActivityPerformedByActor'
            LEFT JOIN ({_TIERS}) t ON t.actor_id = s.actor_id AND t.name = s.actor_name
            GROUP BY 1""",
    ),
    "a7_repoint_actors": (
        a7_repoint_actors,
        f"""SELECT a.id, a.discriminator, CASE WHEN c.entity_id IS NOT NULL THEN c.actor_id ELSE n.actor_id END AS actor_id,
                   CASE WHEN c.entity_id IS NULL THEN n.name WHEN c.known_id IS NULL THEN c.name ELSE kn.name END AS name
            FROM actor a LEFT JOIN ({_ACTOR_CANDIDATES}) c ON c.entity_id = a.id
            LEFT JOIN actor_name n ON n.id = a.actor_name_entity_id LEFT JOIN actor_name kn ON kn.id = c.known_id""",
    ),
    "a8_verify_actors": (
        a8_verify_actors,
        f"""SELECT 'updated_not_at_target' AS "check", CAST(NULL AS VARCHAR) AS item, 0 AS n
            UNION ALL SELECT 'unexpected_actor_shape', NULL, 0
            UNION ALL SELECT 'target_unexpected_scheme', NULL, 0
            UNION ALL SELECT 'updated_per_scheme', split_part(actor_id, ':', 3), count(*) FROM ({_ACTOR_CANDIDATES}) c GROUP BY 2""",
    ),
    "a9_remap_entities": (
        a9_remap_entities,
        f"""SELECT a.id, CASE WHEN b.id IS NOT NULL THEN {_CANONICAL} ELSE n.actor_id END AS actor_id, n.name
            FROM actor a LEFT JOIN actor_name n ON n.id = a.actor_name_entity_id LEFT JOIN {_BAD} b ON b.id = n.id""",
    ),
    "a9_remap_names": (
        a9_remap_names,
        f"""SELECT actor_id, name, created_at FROM actor_name WHERE actor_id NOT LIKE 'urn:demo:organizationnumber:%'
            UNION ALL
            SELECT {_CANONICAL}, b.name, coalesce((SELECT min(t.created_at) FROM actor a JOIN activity t ON t.id = a.activity_id
                                                  WHERE a.actor_name_entity_id = b.id), CAST('{NOW}' AS TIMESTAMP))
            FROM {_BAD} b WHERE NOT EXISTS (SELECT 1 FROM actor_name g WHERE g.actor_id = {_CANONICAL} AND g.name = b.name)""",
    ),
    "u1_has_unopened_content": (u1_has_unopened_content, _TRUE_FLAG),
    "u2_discover_batch": (u2_discover_batch, _FIRST_BATCH),
    "u2_discovery_log": (u2_discovery_log, _DISCOVERY_LOG),
    "u2_discovery_state": (
        u2_discovery_state,
        f"""SELECT '{_REPAIR}' AS repair_name, CAST('{_START}' AS TIMESTAMP) AS window_start, CAST('{_END}' AS TIMESTAMP) AS window_end,
                   max(created_at) AS discovery_cursor_created_at, arg_max(id, (created_at, id)) AS discovery_cursor_id,
                   true AS discovery_complete FROM ({_SCOPED}) s""",
    ),
    "u2_discover_stream": (
        u2_discover_stream,
        f"""SELECT '{_REPAIR}' AS repair_name, dialog_id, ts AS first_activity_created_at, aid AS first_activity_id,
                   n AS source_activity_count FROM ({_per_dialog(_SCOPED)}) f""",
    ),
    "u4_process_log": (u4_process_log, _PROCESS_LOG),
    "u6_phase_stats_of_run": (
        u6_phase_stats_of_run,
        f"""SELECT phase, count(*) AS batches, CAST(sum(scanned_activities) AS BIGINT) AS scanned_activities,
                   CAST(sum(candidates_touched) AS BIGINT) AS candidates_touched, NULL::BIGINT AS rows_selected, NULL::BIGINT AS rows_updated,
                   round(sum(batch_seconds), 3) AS total_seconds, round(avg(batch_seconds), 3) AS avg_batch_seconds
            FROM ({_DISCOVERY_LOG}) d GROUP BY phase
            UNION ALL SELECT phase, count(*), NULL, NULL, CAST(sum(rows_selected) AS BIGINT), CAST(sum(rows_updated) AS BIGINT),
                   round(sum(batch_seconds), 3), round(avg(batch_seconds), 3) FROM ({_PROCESS_LOG}) p GROUP BY phase""",
    ),
    "u3_merge_candidates": (
        u3_merge_candidates,
        f"""SELECT '{_REPAIR}' AS repair_name, n.dialog_id, least(n.ts, o.ts) AS first_activity_created_at,
                   CASE WHEN o.ts IS NULL OR n.ts < o.ts THEN n.aid ELSE o.aid END AS first_activity_id,
                   n.n + coalesce(o.n, 0) AS source_activity_count,
                   CASE WHEN o.ts IS NULL THEN CAST('2002-01-02' AS TIMESTAMP) ELSE CAST('2002-01-01' AS TIMESTAMP) END AS discovered_at
            FROM ({_per_dialog(_SCOPED)}) n LEFT JOIN ({_per_dialog(_FIRST_BATCH)}) o ON o.dialog_id = n.dialog_id""",
    ),
    "u4_process_candidates": (u4_process_candidates, _U4),
    "u4_process_all_dialogs": (
        u4_process_all_dialogs,
        f"""SELECT d.id, d.has_unopened AND NOT (NOT f.has_unopened AND d.id IN (SELECT dialog_id FROM ({_U4_ALL}) q)) AS has_unopened,
                   d.is_seen
            FROM dialog d JOIN ({_TRUE_FLAG}) f ON f.dialog_id = d.id""",
    ),
    "u5_repair_summary": (
        u5_repair_summary,
        f"""SELECT s.repair_name, count(c.dialog_id) AS candidates_total,
                   count(CASE WHEN c.dialog_id IS NOT NULL AND processed_at IS NULL THEN 1 END) AS candidates_unprocessed,
                   count(processed_at) AS candidates_processed, count(updated_at) AS candidates_updated,
                   count(CASE WHEN skipped_reason = 'already_false' THEN 1 END) AS candidates_already_false,
                   count(CASE WHEN skipped_reason = 'still_has_unopened_content' THEN 1 END) AS candidates_still_has_unopened_content,
                   count(CASE WHEN skipped_reason = 'dialog_not_found' THEN 1 END) AS candidates_dialog_not_found,
                   max(CASE WHEN c.dialog_id IS NOT NULL THEN CAST('2002-01-01' AS TIMESTAMP) END) AS last_candidate_discovered_at,
                   max(processed_at) AS last_candidate_processed_at
            FROM (SELECT DISTINCT concat('flags_', CAST(year(o_orderdate) AS VARCHAR)) AS repair_name FROM orders) s
            LEFT JOIN ({_U4}) c ON s.repair_name = '{_REPAIR}' GROUP BY 1""",
    ),
    "u6_verify_unopened": (
        u6_verify_unopened,
        f"""SELECT 'skipped_reason' AS "check", skipped_reason AS item, count(*) AS n FROM ({_U4}) c
            WHERE processed_at IS NOT NULL GROUP BY 2
            UNION ALL SELECT 'unprocessed', NULL, count(*) FROM ({_U4}) c WHERE processed_at IS NULL
            UNION ALL SELECT 'processed_still_repairable', NULL, count(*) FROM ({_U4}) c WHERE updated_at IS NOT NULL""",
    ),
    "u6_first_repairable": (
        u6_first_repairable,
        f"SELECT dialog_id FROM ({_U4_WHOLE}) c WHERE updated_at IS NOT NULL ORDER BY processed_at, dialog_id LIMIT 100",
    ),
    "u6_phase_stats": (
        u6_phase_stats,
        """SELECT CASE WHEN event_type < 'f' THEN 'discover' ELSE 'process' END AS phase, count(*) AS batches,
                  CAST(sum(event_id) AS BIGINT) AS scanned_activities, CAST(sum(user_id) AS BIGINT) AS candidates_touched,
                  CAST(sum(event_id % 100) AS BIGINT) AS rows_selected,
                  CAST(sum(CASE WHEN event_id % 3 <> 0 THEN event_id % 50 END) AS BIGINT) AS rows_updated,
                  round(round(sum(value), 3), 1) AS total_seconds, round(round(avg(value), 3), 2) AS avg_batch_seconds
           FROM events GROUP BY 1""",
    ),
    "b1_distinct_keys": (b1_distinct_keys, "SELECT DISTINCT org FROM dialog WHERE org IS NOT NULL"),
    "b2_backfill_seen": (
        b2_backfill_seen,
        f"""SELECT id, org, is_seen AND id NOT IN (SELECT id FROM ({_FIXES}) f) AS is_seen FROM ({_B_DIALOG}) d""",
    ),
    "b2_backfill_totals": (
        b2_backfill_totals,
        f"""SELECT org, fixed, CAST(sum(fixed) OVER (ORDER BY org) AS BIGINT) AS running_total
            FROM (SELECT org, count(*) AS fixed FROM ({_FIXES}) f GROUP BY org) x""",
    ),
}

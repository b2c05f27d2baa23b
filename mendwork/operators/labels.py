"""Label repair: resolve actor names, build candidates, restore missing labels with their audit rows.

Frames: staging(dialog_id, source_ts, actor_id, system_label) · contexts(id, dialog_id) ·
labels(context_id, label_id, created_at) · actor_names(id, actor_id, name, created_at) ·
logs(id, created_at, name, action, context_id) · actors(id, actor_type_id, created_at, updated_at,
discriminator, actor_name_entity_id, label_log_id) · resolution(actor_id, name, actor_name_entity_id, source).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendwork.constants import (
    ACTOR_TYPE_PARTY_REPRESENTATIVE,
    FOLDER_LABELS,
    LABEL_ACTION_SET,
    LABEL_DEFAULT,
    LABEL_LOG_ACTOR,
    LABEL_NAME_PREFIX,
    OUTCOME_UPDATED,
    REPAIRABLE_LABELS,
    SOURCE_EXISTING,
    SOURCE_REGISTER,
    SOURCE_UNRESOLVED,
    Urns,
)
from mendwork.functions.columns import Moment, moment, uuid7
from mendwork.functions.durable import durable
from mendwork.operators.harness import check


def _label_id(name: Column) -> Column:
    found = F.when(F.lit(False), F.lit(0))
    for label, label_id in REPAIRABLE_LABELS.items():
        found = found.when(name == label, F.lit(label_id))
    return found


def resolve_existing(staging: DataFrame, actor_names: DataFrame) -> DataFrame:
    """Every distinct staged actor with its newest named ActorName row, where one exists.

    Equal creation times are settled by the larger id.
    """
    seeds = durable(staging.select("actor_id").distinct())
    newest = (
        actor_names.where(F.col("name").isNotNull())
        .join(seeds, "actor_id")
        .groupBy("actor_id")
        .agg(F.max(F.struct("created_at", "id", "name")).alias("_n"))
        .select("actor_id", F.col("_n.name").alias("name"), F.col("_n.id").alias("actor_name_entity_id"))
    )
    return seeds.join(newest, "actor_id", "left").select(
        "actor_id",
        "name",
        "actor_name_entity_id",
        F.when(F.col("actor_name_entity_id").isNotNull(), F.lit(SOURCE_EXISTING)).alias("source"),
    )


def resolve_from_registry(
    resolution: DataFrame, units: DataFrame, subunits: DataFrame, urns: Urns = Urns()
) -> DataFrame:
    """Names of still unresolved organisations from two register tables (org_no, name).

    Only organisation identifiers of exactly nine digits are looked up; the main register wins over the
    sub-unit register, and an empty name counts as not found.
    """
    number = F.substring_index("actor_id", ":", -1)
    eligible = F.col("source").isNull() & F.col("actor_id").startswith(urns.organization) & number.rlike("^[0-9]{9}$")

    def register(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("name") != "").groupBy("org_no").agg(F.min("name").alias(name))

    looked_up = (
        resolution.withColumn("org_no", F.when(eligible, number))
        .join(register(units, "_main"), "org_no", "left")
        .join(register(subunits, "_sub"), "org_no", "left")
    )
    hit = F.coalesce("_main", "_sub")
    return looked_up.select(
        "actor_id",
        F.coalesce("name", hit).alias("name"),
        "actor_name_entity_id",
        F.coalesce("source", F.when(hit.isNotNull(), F.lit(SOURCE_REGISTER))).alias("source"),
    )


def finish_resolution(resolution: DataFrame) -> DataFrame:
    return resolution.withColumn("source", F.coalesce("source", F.lit(SOURCE_UNRESOLVED)))


def resolution_counts(resolution: DataFrame) -> DataFrame:
    """Actors per source, and how many of them carry an ActorName id."""
    return resolution.groupBy("source").agg(
        F.count(F.lit(1)).alias("actors"), F.count("actor_name_entity_id").alias("with_id")
    )


def ensure_actor_names(
    resolution: DataFrame, actor_names: DataFrame, now: Moment
) -> tuple[DataFrame, DataFrame]:
    """Create the missing (actor_id, name) rows of register hits and link ids. Returns (actor names, resolution).

    New ids are version-7 text derived from time and key, so a second run creates the same rows.
    """
    at = moment(now)
    id_type = actor_names.schema["id"].dataType
    fresh = (
        resolution.where((F.col("source") == SOURCE_REGISTER) & F.col("name").isNotNull())
        .select("actor_id", "name")
        .join(actor_names.select("actor_id", "name"), ["actor_id", "name"], "left_anti")
        .select(
            uuid7(at, F.col("actor_id"), F.col("name")).cast(id_type).alias("id"),
            "actor_id",
            "name",
            at.alias("created_at"),
        )
    )
    names = actor_names.select("id", "actor_id", "name", "created_at").unionByName(fresh)
    by_key = names.where(F.col("name").isNotNull()).groupBy("actor_id", "name").agg(F.min("id").alias("_id"))
    linked = resolution.join(by_key, ["actor_id", "name"], "left").select(
        "actor_id", "name", F.coalesce("actor_name_entity_id", "_id").alias("actor_name_entity_id"), "source"
    )
    return names, linked


def _passes_guard(rows: DataFrame, labels: DataFrame, context: str = "entity_id", label: str = "label_id") -> DataFrame:
    """Rows whose label is absent and, for folder labels, whose context has no other folder label.

    One pass over the context's label set instead of two anti joins.
    """
    have = (
        labels.join(rows.select(F.col(context).alias("context_id")).distinct(), "context_id")
        .groupBy(F.col("context_id").alias(context))
        .agg(F.collect_set("label_id").alias("_have"))
    )
    is_folder = F.col(label).isin(*FOLDER_LABELS)
    folder_taken = F.arrays_overlap("_have", F.array(*[F.lit(x) for x in FOLDER_LABELS]))
    blocked = F.array_contains("_have", F.col(label)) | (is_folder & folder_taken)
    return rows.join(have, context, "left").where(~F.coalesce(blocked, F.lit(False))).drop("_have")


def _bit(label_id: Column) -> Column:
    """A repairable label as one bit, so that a context's labels are one number; null for any other label."""
    found = F.when(F.lit(False), F.lit(0))
    for known in REPAIRABLE_LABELS.values():
        found = found.when(label_id == known, F.lit(1 << known))
    return found


def _holds(labels: Column, bits: Column) -> Column:
    return F.coalesce(labels.bitwiseAND(bits) != 0, F.lit(False))


def label_candidates(
    staging: DataFrame, contexts: DataFrame, resolution: DataFrame, labels: DataFrame
) -> DataFrame:
    """One candidate per (context, label): entity_id, label_id, actor_name_entity_id, source_ts, label_name.

    The newest staged row wins; equal times are settled by the larger ActorName id. Contexts carry their labels to the
    dialog, so staged rows are dealt out by dialog once: guard and newest row are decided where they meet their context.
    """
    resolved = resolution.where(F.col("actor_name_entity_id").isNotNull()).select("actor_id", "actor_name_entity_id")
    have = (
        labels.select(F.col("context_id").alias("entity_id"), _bit(F.col("label_id")).alias("_bit"))
        .where(F.col("_bit").isNotNull())
        .groupBy("entity_id")
        .agg(F.bit_or("_bit").alias("_have"))
    )
    held = contexts.select(F.col("id").alias("entity_id"), "dialog_id").join(have, "entity_id", "left")
    folders = F.lit(sum(1 << x for x in FOLDER_LABELS))
    blocked = _holds(F.col("_have"), _bit(F.col("label_id"))) | (
        F.col("label_id").isin(*FOLDER_LABELS) & _holds(F.col("_have"), folders)
    )
    label_name = F.when(F.lit(False), F.lit(""))
    for name, label_id in REPAIRABLE_LABELS.items():
        label_name = label_name.when(F.col("label_id") == label_id, F.lit(LABEL_NAME_PREFIX + name))
    return (
        staging.select("dialog_id", "source_ts", "actor_id", _label_id(F.col("system_label")).alias("label_id"))
        .where(F.col("label_id").isNotNull())
        .join(resolved, "actor_id")
        .join(held, "dialog_id")
        .where(~blocked)
        # A context has one dialog, so the rows of a group already are in one task.
        .groupBy("dialog_id", "entity_id", "label_id")
        .agg(F.max(F.struct("source_ts", "actor_name_entity_id")).alias("_newest"))
        .select(
            "entity_id", "label_id", "_newest.actor_name_entity_id", "_newest.source_ts", label_name.alias("label_name")
        )
    )


def label_left_behind(
    staging: DataFrame, contexts: DataFrame, resolution: DataFrame, candidates: DataFrame
) -> DataFrame:
    """Staged rows that produced no candidate, counted by the first reason that applies.

    Staged rows are dealt out by dialog once. Only those that neither dialog nor label settles are counted by actor,
    and the counts, not the rows, meet the resolution.
    """
    label_id = _label_id(F.substring("label_name", len(LABEL_NAME_PREFIX) + 1, 1 << 30))
    made = candidates.groupBy("entity_id").agg(F.bit_or(_bit(label_id)).alias("_made"))
    placed = contexts.select(F.col("id").alias("entity_id"), "dialog_id").join(made, "entity_id", "left")
    out_of_scope = F.coalesce(~F.col("system_label").isin(*REPAIRABLE_LABELS), F.lit(False))
    settled = F.when(F.col("entity_id").isNull(), F.lit("no_matching_context")).when(
        F.col("_out"), F.lit("out_of_scope_label")
    )
    rows = (
        staging.select(
            "dialog_id",
            F.when(~out_of_scope, F.col("actor_id")).alias("actor_id"),
            _label_id(F.col("system_label")).alias("label_id"),
            out_of_scope.alias("_out"),
        )
        .join(placed, "dialog_id", "left")
        .where(~_holds(F.col("_made"), _bit(F.col("label_id"))))
        .select(settled.alias("_settled"), "actor_id")
        .groupBy("_settled", F.when(F.col("_settled").isNull(), F.col("actor_id")).alias("actor_id"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(resolution.select("actor_id", "actor_name_entity_id"), "actor_id", "left")
    )
    by_actor = F.when(F.col("actor_name_entity_id").isNull(), F.lit("actor_unresolved")).otherwise(
        F.lit("guard_skipped_or_already_set")
    )
    reason = F.coalesce("_settled", by_actor)
    return rows.groupBy(reason.alias("reason")).agg(F.sum("_n").alias("staging_rows")).orderBy("reason")


class LabelChanges(NamedTuple):
    labels: DataFrame
    logs: DataFrame
    actors: DataFrame
    touched: DataFrame


def apply_labels(claimed: DataFrame, labels: DataFrame, logs: DataFrame, actors: DataFrame) -> LabelChanges:
    """Restore the claimed labels: drop Default for folder labels, add label, log and actor rows.

    The guard is checked again. If one context has both folder labels claimed, the smaller label id wins and
    the other is skipped, so the result does not depend on how candidates were cut into batches. Each log
    row gets exactly one actor row. All new rows carry the source timestamp. What is applied is decided once and
    stored; of the labels, only the Default ones are compared with it.
    """
    is_folder = F.col("label_id").isin(*FOLDER_LABELS)
    one_folder = Window.partitionBy("entity_id", is_folder).orderBy("label_id")
    eligible = durable(
        _passes_guard(claimed, labels)
        .withColumn("_first", F.row_number().over(one_folder) == 1)
        .where(~is_folder | F.col("_first"))
        .select("entity_id", "label_id", "actor_name_entity_id", "source_ts", "label_name")
    )
    dropped = eligible.where(is_folder).select(F.col("entity_id").alias("context_id"))
    is_default = F.coalesce(F.col("label_id") == LABEL_DEFAULT, F.lit(False))
    kept = labels.where(~is_default).unionByName(labels.where(is_default).join(dropped, "context_id", "left_anti").select(*labels.columns))
    types = {f.name: f.dataType for f in labels.schema.fields}
    added = eligible.select(
        F.col("entity_id").alias("context_id"),
        F.col("label_id").cast(types["label_id"]).alias("label_id"),
        F.col("source_ts").alias("created_at"),
    )
    log_id = uuid7(F.col("source_ts"), F.lit("label-log"), F.col("entity_id"), F.col("label_name"))
    new_logs = eligible.select(
        log_id.alias("id"),
        F.col("source_ts").alias("created_at"),
        F.col("label_name").alias("name"),
        F.lit(LABEL_ACTION_SET).alias("action"),
        F.col("entity_id").alias("context_id"),
    )
    new_actors = eligible.select(
        uuid7(F.col("source_ts"), F.lit("label-log-actor"), F.col("entity_id"), F.col("label_name")).alias("id"),
        F.lit(ACTOR_TYPE_PARTY_REPRESENTATIVE).alias("actor_type_id"),
        F.col("source_ts").alias("created_at"),
        F.col("source_ts").alias("updated_at"),
        F.lit(LABEL_LOG_ACTOR).alias("discriminator"),
        "actor_name_entity_id",
        log_id.alias("label_log_id"),
    )
    return LabelChanges(
        kept.unionByName(added),
        logs.unionByName(new_logs),
        actors.unionByName(new_actors, allowMissingColumns=True),
        eligible.select("entity_id", "label_id"),
    )


def verify_labels(candidates: DataFrame, labels: DataFrame, logs: DataFrame, actors: DataFrame) -> DataFrame:
    """Three invariants, each of which must count zero."""
    updated = candidates.where(F.col("outcome") == OUTCOME_UPDATED)
    present = labels.select(F.col("context_id").alias("entity_id"), "label_id")
    default = labels.where(F.col("label_id") == LABEL_DEFAULT).select(F.col("context_id").alias("entity_id"))
    shaped = actors.where(
        (F.col("discriminator") == LABEL_LOG_ACTOR)
        & (F.col("actor_type_id") == ACTOR_TYPE_PARTY_REPRESENTATIVE)
        & F.col("actor_name_entity_id").isNotNull()
    ).select(F.col("label_log_id").alias("id"))
    audited = (
        logs.where(F.col("action") == LABEL_ACTION_SET)
        .join(shaped, "id", "left_semi")
        .select(F.col("context_id").alias("entity_id"), F.col("name").alias("label_name"))
    )
    folder = updated.where(F.col("label_id").isin(*FOLDER_LABELS))
    return (
        check("updated_missing_label", updated.join(present, ["entity_id", "label_id"], "left_anti"))
        .unionByName(check("folder_update_still_has_default", folder.join(default, "entity_id", "left_semi")))
        .unionByName(
            check("updated_without_matching_log", updated.join(audited, ["entity_id", "label_name"], "left_anti"))
        )
    )

"""Actor repair: point performer actors at the right ActorName row.

Frames: staging(dialog_id, dialog_activity_id, source_ts, actor_id, actor_name, activity_type) ·
activities(id, dialog_id, created_at, type_id) · actors(id, activity_id, discriminator, actor_type_id,
actor_name_entity_id) · actor_names(id, actor_id, name, created_at) · resolution(actor_id, name,
actor_name_entity_id, source).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendwork.constants import (
    ACTIVITY_TYPE_BY_NAME,
    ACTOR_TYPE_PARTY_REPRESENTATIVE,
    OUTCOME_UPDATED,
    PERFORMED_BY_ACTOR,
    SOURCE_EXACT,
    SOURCE_INSERTED,
    SOURCE_NONE,
    SOURCE_REORDERED,
    Urns,
)
from mendwork.functions.columns import Moment, canonical_organization, has_prefix, moment, reorder_name, urn_parts, uuid7
from mendwork.functions.durable import durable
from mendwork.functions.ranking import add_position, left_join_spread, sampled
from mendwork.operators.harness import apply_update, check


def _expected_type(name: Column) -> Column:
    found = F.when(F.lit(False), F.lit(0))
    for activity, type_id in ACTIVITY_TYPE_BY_NAME.items():
        found = found.when(name == activity, F.lit(type_id))
    return found


def resolve_actor_names(
    staging: DataFrame, actor_names: DataFrame, urns: Urns = Urns()
) -> tuple[DataFrame, DataFrame]:
    """Three tiers per distinct (actor_id, name): exact, reordered (persons only), inserted (known schemes).

    Returns (resolution, new ActorName rows). New rows are dated by the earliest staged use and have ids
    derived from that date and their key. Actors of unknown schemes stay unresolved.
    """
    # One grouped pass gives both the distinct pairs and the earliest use.
    pairs = staging.groupBy("actor_id", F.col("actor_name").alias("name")).agg(F.min("source_ts").alias("first_use"))
    known = actor_names.where(F.col("name").isNotNull()).groupBy("actor_id", "name").agg(F.min("id").alias("_id"))
    exact = known.withColumnRenamed("_id", "_exact")
    turned = known.withColumnRenamed("_id", "_turned").withColumnRenamed("name", "_wanted")
    wanted = F.when(F.col("actor_id").startswith(urns.person_any), reorder_name(F.col("name")))
    id_type = actor_names.schema["id"].dataType
    tiers = (
        pairs.withColumn("_wanted", wanted)
        .join(exact, ["actor_id", "name"], "left")
        .join(turned, ["actor_id", "_wanted"], "left")
        .withColumn("_found", F.coalesce("_exact", "_turned"))
        .withColumn(
            "_new",
            F.when(
                F.col("_found").isNull() & has_prefix(F.col("actor_id"), urns.recognised),
                uuid7(F.col("first_use"), F.col("actor_id"), F.col("name")).cast(id_type),
            ),
        )
    )
    source = (
        F.when(F.col("_exact").isNotNull(), F.lit(SOURCE_EXACT))
        .when(F.col("_turned").isNotNull(), F.lit(SOURCE_REORDERED))
        .when(F.col("_new").isNotNull(), F.lit(SOURCE_INSERTED))
    )
    resolution = tiers.select(
        "actor_id", "name", F.coalesce("_found", "_new").alias("actor_name_entity_id"), source.alias("source")
    )
    new_rows = tiers.where(F.col("_new").isNotNull()).select(
        F.col("_new").alias("id"), "actor_id", "name", F.col("first_use").alias("created_at")
    )
    return resolution, new_rows


def resolution_report(resolution: DataFrame) -> DataFrame:
    """Pairs per source, and the schemes of unresolved pairs: rows of (section, item, actors)."""
    by_source = resolution.groupBy(F.coalesce("source", F.lit(SOURCE_NONE)).alias("item")).agg(
        F.count(F.lit(1)).alias("actors")
    )
    schemes = (
        resolution.where(F.col("actor_name_entity_id").isNull())
        .groupBy(urn_parts(F.col("actor_id"), 3).alias("item"))
        .agg(F.count(F.lit(1)).alias("actors"))
    )
    return (
        by_source.select(F.lit("source").alias("section"), "item", "actors")
        .unionByName(schemes.select(F.lit("unresolved_scheme").alias("section"), "item", "actors"))
        .orderBy("section", F.col("actors").desc(), "item")
    )


def _performers(actors: DataFrame) -> DataFrame:
    return actors.where(F.col("discriminator") == PERFORMED_BY_ACTOR)


def _staged_matches(staging: DataFrame) -> DataFrame:
    """Per (activity id, dialog, time, type): the smallest and largest staged actor and name.

    They differ exactly when the rows disagree. Grouping on the later join key combines repeats before the
    shuffle, so a hot activity id is one row, and the join that follows needs no second shuffle.
    """
    return (
        staging.select(
            F.col("dialog_activity_id").alias("id"),
            "dialog_id",
            F.col("source_ts").alias("created_at"),
            _expected_type(F.col("activity_type")).alias("type_id"),
            "actor_id",
            "actor_name",
        )
        .where(F.col("type_id").isNotNull())
        .groupBy("id", "dialog_id", "created_at", "type_id")
        .agg(
            F.min("actor_id").alias("actor_id"),
            F.max("actor_id").alias("_other_id"),
            F.min("actor_name").alias("name"),
            F.max("actor_name").alias("_other_name"),
        )
        .withColumn(
            "_agreed", (F.col("actor_id") == F.col("_other_id")) & (F.col("name") == F.col("_other_name"))
        )
    )


def actor_candidates(
    staging: DataFrame,
    activities: DataFrame,
    actors: DataFrame,
    resolution: DataFrame,
    keep_activity: bool = False,
) -> DataFrame:
    """Performer actors to repoint: entity_id, target_actor_name_id, and activity_id if asked for.

    A staged row counts only if id, dialog, time and type all match its activity. Activities whose rows
    disagree on (actor, name) are left out; so are actors already at the target.
    """
    key = ["id", "dialog_id", "created_at", "type_id"]
    agreed = (
        _staged_matches(staging)
        .where("_agreed")
        .join(activities.where(F.col("type_id").isin(*ACTIVITY_TYPE_BY_NAME.values())).select(*key), key)
        .select(F.col("id").alias("activity_id"), "actor_id", "name")
    )
    named = resolution.where(F.col("actor_name_entity_id").isNotNull()).select(
        "actor_id", "name", F.col("actor_name_entity_id").alias("target_actor_name_id")
    )
    return (
        _performers(actors)
        .select(F.col("id").alias("entity_id"), "activity_id", "actor_name_entity_id")
        .join(agreed, "activity_id")
        .join(named, ["actor_id", "name"])
        .where(~F.col("actor_name_entity_id").eqNullSafe(F.col("target_actor_name_id")))
        .select("entity_id", "target_actor_name_id", *(["activity_id"] if keep_activity else []))
    )


# Distinct keys whose running count one task adds up.
_KEYS_PER_BLOCK = 100_000


def chunk_keys(df: DataFrame, key: str, rows_per_chunk: int) -> DataFrame:
    """Every distinct key with its row count, the running row count in key order, and its chunk number.

    A key's rows are never split: each key goes to the chunk its last row falls in.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    placed = add_position(counts, [F.col(key)], name="_at").withColumn(
        "_block", F.floor((F.col("_at") - 1) / F.lit(_KEYS_PER_BLOCK))
    )
    # One row per 100,000 keys reaches the unpartitioned window.
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy("_block")
        .agg(F.sum("rows").alias("_block_rows"))
        .select("_block", F.coalesce(F.sum("_block_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = F.sum("rows").over(Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    running = placed.withColumn("_inside", inside).join(before, "_block")
    upto = F.col("_before") + F.col("_inside")
    return running.select(
        key,
        "rows",
        upto.alias("running_rows"),
        (F.floor((upto - 1) / F.lit(rows_per_chunk)).cast("long") + 1).alias("chunk_no"),
    )


def key_ranges(chunked_keys: DataFrame, key: str) -> DataFrame:
    """Balanced key ranges: chunk_no, low_key and high_key (inclusive), rows, running_rows."""
    return (
        chunked_keys.groupBy("chunk_no")
        .agg(
            F.min(key).alias("low_key"),
            F.max(key).alias("high_key"),
            F.sum("rows").alias("rows"),
            F.max("running_rows").alias("running_rows"),
        )
        .orderBy("chunk_no")
    )


def candidates_by_chunk(
    chunked_keys: DataFrame,
    staging: DataFrame,
    activities: DataFrame,
    actors: DataFrame,
    resolution: DataFrame,
    done_chunks: Sequence[int] = (),
) -> DataFrame:
    """Candidates with the chunk of their activity, all open chunks in one job; finished chunks are skipped.

    ``chunked_keys`` is :func:`chunk_keys` over ``dialog_activity_id``; its chunk is found by key equality.
    """
    keys = chunked_keys.select(F.col("dialog_activity_id"), "chunk_no")
    if done_chunks:
        keys = keys.where(~F.col("chunk_no").isin(*done_chunks))
        staging = staging.join(keys, "dialog_activity_id", "left_semi")
    made = actor_candidates(staging, activities, actors, resolution, keep_activity=True)
    return made.join(keys.withColumnRenamed("dialog_activity_id", "activity_id"), "activity_id").select(
        "chunk_no", "entity_id", "target_actor_name_id"
    )


def chunk_totals(chunked: DataFrame, ranges: DataFrame) -> DataFrame:
    """Candidates per chunk and the running total; chunks without candidates count zero."""
    made = chunked.groupBy("chunk_no").agg(F.count(F.lit(1)).alias("_n"))
    # One row per chunk: about one per million staged rows.
    running = Window.orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranges.select("chunk_no")
        .join(made, "chunk_no", "left")
        .select("chunk_no", F.coalesce("_n", F.lit(0)).cast("long").alias("inserted"))
        .withColumn("running_total", F.sum("inserted").over(running))
    )


def classify_staging(
    staging: DataFrame,
    activities: DataFrame,
    actors: DataFrame,
    resolution: DataFrame,
    sample: tuple[float, int] | None = None,
) -> DataFrame:
    """Every staged row counted under the first of ten reasons that applies: reason, staging_rows.

    ``sample=(percent, seed)`` reads a repeatable row sample; then only the proportions mean anything.
    """
    content = ("dialog_id", "dialog_activity_id", "source_ts", "actor_id", "actor_name", "activity_type")
    if sample is not None:
        staging = staging.where(sampled(sample[0] / 100.0, sample[1], *content))
    # Equal staged rows share their reason: count them first, so a hot activity id is one row per content.
    staged = (
        staging.groupBy(*content)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_expected", _expected_type(F.col("activity_type")))
    )
    acts = activities.select(
        F.col("id").alias("a_id"),
        F.col("dialog_id").alias("a_dialog"),
        F.col("created_at").alias("a_created"),
        F.col("type_id").alias("a_type"),
    )
    performers = _performers(actors).select(
        F.col("activity_id").alias("a_id"), F.col("id").alias("act_id"), F.col("actor_name_entity_id").alias("act_name")
    )
    acts = acts.where(F.col("a_id").isNotNull()).join(performers, "a_id", "left")
    # A row reaches this test only if it matches its activity fully, so disagreement can be read off the staged rows
    # alone. The window and the join find the rows dealt out by activity id, so neither shuffles them again.
    alike = Window.partitionBy("dialog_activity_id", "dialog_id", "source_ts", "_expected")
    differ = [F.min(c).over(alike) != F.max(c).over(alike) for c in ("actor_id", "actor_name")]
    whole = F.col("dialog_id").isNotNull() & F.col("source_ts").isNotNull()
    staged = staged.repartition("dialog_activity_id").withColumn("_ambiguous", whole & (differ[0] | differ[1]))
    rows = staged.join(acts, F.col("dialog_activity_id") == F.col("a_id"), "left")
    named = resolution.select(
        "actor_id", F.col("name").alias("actor_name"), F.col("actor_name_entity_id").alias("target")
    )
    early = (
        F.when(F.col("a_id").isNull(), F.lit("1_no_matching_activity_id"))
        .when(~F.col("a_created").eqNullSafe(F.col("source_ts")), F.lit("2_timestamp_mismatch"))
        .when(~F.col("a_dialog").eqNullSafe(F.col("dialog_id")), F.lit("3_dialog_id_mismatch"))
        .when(F.col("_expected").isNull(), F.lit("4_unknown_activity_type"))
        .when(~F.col("a_type").eqNullSafe(F.col("_expected")), F.lit("5_type_mismatch"))
        .when(F.col("_ambiguous"), F.lit("6_ambiguous_multiple_actors"))
        .when(F.col("act_id").isNull(), F.lit("7_no_performed_by_actor"))
    )
    # Only what the later reasons need goes on to the actors' names.
    open_ = rows.select("actor_id", "actor_name", "act_name", "_n", early.alias("_early"))
    reason = (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(F.col("target").isNull(), F.lit("8_actor_unresolved"))
        .when(F.col("act_name").eqNullSafe(F.col("target")), F.lit("9_already_correct"))
        .otherwise(F.lit("0_candidate"))
    )
    return (
        open_.join(named, ["actor_id", "actor_name"], "left")
        .groupBy(reason.alias("reason"))
        .agg(F.sum("_n").alias("staging_rows"))
        .orderBy("reason")
    )


def repoint_actors(actors: DataFrame, claimed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Point claimed performer actors at their target where they differ. Returns (actors, touched keys)."""
    return apply_update(
        actors,
        claimed.select("entity_id", "target_actor_name_id"),
        on={"id": "entity_id"},
        set_={"actor_name_entity_id": F.col("c.target_actor_name_id")},
        guard=(F.col("t.discriminator") == PERFORMED_BY_ACTOR)
        & ~F.col("t.actor_name_entity_id").eqNullSafe(F.col("c.target_actor_name_id")),
    )


def verify_actors(
    candidates: DataFrame, actors: DataFrame, actor_names: DataFrame, urns: Urns = Urns()
) -> DataFrame:
    """Three invariants that must count zero, then updated candidates per scheme: rows of (check, item, n)."""
    joined = candidates.join(
        actors.select(F.col("id").alias("entity_id"), "discriminator", "actor_type_id", "actor_name_entity_id"),
        "entity_id",
    )
    updated = F.col("outcome") == OUTCOME_UPDATED
    away = joined.where(updated & ~F.col("actor_name_entity_id").eqNullSafe(F.col("target_actor_name_id")))
    shape = joined.where(
        (F.col("discriminator") != PERFORMED_BY_ACTOR)
        | (F.col("actor_type_id") != ACTOR_TYPE_PARTY_REPRESENTATIVE)
        | F.col("actor_name_entity_id").isNull()
    )
    targets = candidates.where(updated).join(
        actor_names.select(F.col("id").alias("target_actor_name_id"), "actor_id"), "target_actor_name_id"
    )
    schemes = (
        targets.groupBy(F.split_part("actor_id", F.lit(":"), F.lit(3)).alias("item"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("updated_per_scheme").alias("check"), "item", "n")
    )
    return (
        check("updated_not_at_target", away)
        .unionByName(check("unexpected_actor_shape", shape))
        .unionByName(check("target_unexpected_scheme", targets.where(~has_prefix(F.col("actor_id"), urns.recognised))))
        .unionByName(schemes)
    )


class Remapped(NamedTuple):
    actor_names: DataFrame
    actors: DataFrame
    candidates: DataFrame
    resolution: DataFrame
    remap: DataFrame
    remaining: DataFrame


class RemapError(RuntimeError):
    """A malformed row does not map to exactly one canonical row."""


def remap_plan(
    actor_names: DataFrame, actors: DataFrame, activities: DataFrame, now: Moment, urns: Urns = Urns()
) -> tuple[DataFrame, DataFrame]:
    """Malformed organisation rows mapped to canonical same-name rows: (bad_id, good_id), and the rows to create.

    A created row is dated by the earliest activity that used any malformed row of its key.
    """
    bad = actor_names.where(F.col("actor_id").startswith(urns.legacy_organization)).select(
        F.col("id").alias("bad_id"), canonical_organization(F.col("actor_id"), urns).alias("actor_id"), "name"
    )
    uses = (
        actors.select(F.col("actor_name_entity_id").alias("bad_id"), "activity_id")
        .join(bad.select("bad_id"), "bad_id")
        .join(activities.select(F.col("id").alias("activity_id"), "created_at"), "activity_id")
        .groupBy("bad_id")
        .agg(F.min("created_at").alias("_used"))
    )
    id_type = actor_names.schema["id"].dataType
    wanted = bad.join(uses, "bad_id", "left").groupBy("actor_id", "name").agg(F.min("_used").alias("_used"))
    created_at = F.coalesce("_used", moment(now))
    created = (
        wanted.where(F.col("name").isNotNull())
        .join(actor_names.select("actor_id", "name"), ["actor_id", "name"], "left_anti")
        .select(
            uuid7(created_at, F.col("actor_id"), F.col("name")).cast(id_type).alias("id"),
            "actor_id",
            "name",
            created_at.alias("created_at"),
        )
    )
    good = actor_names.select("id", "actor_id", "name").unionByName(created.select("id", "actor_id", "name"))
    remap = bad.join(good.withColumnRenamed("id", "good_id"), ["actor_id", "name"], "left").select("bad_id", "good_id")
    return remap, created


def remap_entities(
    actor_names: DataFrame,
    actors: DataFrame,
    activities: DataFrame,
    candidates: DataFrame,
    resolution: DataFrame,
    now: Moment,
    urns: Urns = Urns(),
) -> Remapped:
    """Replace malformed organisation identifiers everywhere, then delete the rows no longer used.

    Fails before producing anything if some malformed row maps to no, or to more than one, canonical row.
    """
    remap, created = remap_plan(actor_names, actors, activities, now, urns)
    # Both are read several times below and must stay what the assertion saw.
    remap, created = durable(remap), durable(created)
    wrong = remap.groupBy("bad_id").agg(F.count("good_id").alias("n")).where(F.col("n") != 1).count()
    if wrong:
        raise RemapError(f"{wrong} malformed rows do not map to exactly one canonical row")

    def repoint(df: DataFrame, column: str) -> DataFrame:
        moved = left_join_spread(df, remap.withColumnRenamed("bad_id", column), column)
        return moved.select(
            *[F.coalesce("good_id", column).alias(c) if c == column else F.col(c) for c in df.columns]
        )

    new_actors = repoint(actors, "actor_name_entity_id")
    gone = remap.select(F.col("bad_id").alias("id")).join(
        new_actors.select(F.col("actor_name_entity_id").alias("id")), "id", "left_anti"
    )
    names = (
        actor_names.select("id", "actor_id", "name", "created_at").unionByName(created).join(gone, "id", "left_anti")
        .select("id", "actor_id", "name", "created_at")
    )
    remaining = names.where(F.col("actor_id").startswith(urns.legacy_organization)).agg(
        F.count(F.lit(1)).alias("remaining")
    )
    return Remapped(
        names,
        new_actors,
        repoint(candidates, "target_actor_name_id"),
        repoint(resolution, "actor_name_entity_id"),
        remap,
        remaining,
    )

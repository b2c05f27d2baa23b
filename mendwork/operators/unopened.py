"""Unopened-content repair: recompute a flag, discover candidates by cursor, correct the flag.

Frames: dialogs(id, service_type, has_unopened, ..) · transmissions(id, dialog_id, type_id) ·
activities(id, dialog_id, transmission_id, type_id, created_at) · candidates(repair_name, dialog_id,
first_activity_created_at, first_activity_id, source_activity_count, discovered_at, processed_at,
updated_at, skipped_reason) · states(repair_name, window_start, window_end, ..).
"""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.constants import (
    ACTIVITY_CORRESPONDENCE_OPENED,
    ACTIVITY_TRANSMISSION_OPENED,
    CORRESPONDENCE_SERVICE_TYPE,
    TRANSMISSION_CORRECTION,
    TRANSMISSION_SUBMISSION,
)
from mendwork.functions.columns import Moment, moment, seconds_between
from mendwork.functions.durable import durable
from mendwork.functions.ranking import add_position, first_n
from mendwork.operators.harness import apply_update

CANDIDATE_KEY = ("repair_name", "dialog_id")


def _facts_of(ids: DataFrame, transmissions: DataFrame, activities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The transmissions of the dialogs ``ids`` (``dialog_id``, once each), and the activities that say something about these
    dialogs or transmissions.

    Small sets of ids are broadcast, so of the large tables only what belongs to them is shuffled later.
    """
    own = durable(transmissions.join(ids, "dialog_id", "left_semi"))
    opened = activities.where(F.col("type_id") == ACTIVITY_TRANSMISSION_OPENED)
    opened = opened.join(own.select(F.col("id").alias("transmission_id")).distinct(), "transmission_id", "left_semi")
    read = activities.where(F.col("type_id") == ACTIVITY_CORRESPONDENCE_OPENED).join(ids, "dialog_id", "left_semi")
    columns = ["type_id", "transmission_id", "dialog_id"]
    return own, durable(opened.select(*columns).unionAll(read.select(*columns)))


def has_unopened_content(dialogs: DataFrame, transmissions: DataFrame, activities: DataFrame) -> DataFrame:
    """Per dialog: is there content nobody opened? Columns dialog_id, has_unopened.

    True when some transmission other than a submission or correction has no opened activity, or when a
    correspondence dialog has no opened activity of its own. Both facts are brought to one row per dialog
    before the dialogs are joined.
    """
    opened = activities.where(F.col("type_id") == ACTIVITY_TRANSMISSION_OPENED).select(
        F.col("transmission_id").alias("id")
    )
    unopened = (
        transmissions.where(~F.col("type_id").isin(TRANSMISSION_SUBMISSION, TRANSMISSION_CORRECTION))
        .join(opened, "id", "left_anti")
        .select("dialog_id", F.lit(True).alias("_unopened"), F.lit(False).alias("_opened"))
    )
    read = activities.where(F.col("type_id") == ACTIVITY_CORRESPONDENCE_OPENED).select(
        "dialog_id", F.lit(False).alias("_unopened"), F.lit(True).alias("_opened")
    )
    facts = unopened.unionAll(read).groupBy("dialog_id").agg(
        F.max("_unopened").alias("_unopened"), F.max("_opened").alias("_opened")
    )
    unread = (F.col("service_type") == CORRESPONDENCE_SERVICE_TYPE) & ~F.coalesce("_opened", F.lit(False))
    flag = F.coalesce("_unopened", F.lit(False)) | unread
    return dialogs.select(F.col("id").alias("dialog_id"), "service_type").join(facts, "dialog_id", "left").select(
        "dialog_id", F.coalesce(flag, F.lit(False)).alias("has_unopened")
    )


class Cursor(NamedTuple):
    """Window [start, end) and the position (time, id) after which to read on."""

    start: Moment
    end: Moment
    after_ts: Moment
    after_id: Any


def _in_scope(activities: DataFrame, start: Moment, end: Moment) -> DataFrame:
    return activities.where(
        F.col("type_id").isin(ACTIVITY_TRANSMISSION_OPENED, ACTIVITY_CORRESPONDENCE_OPENED)
        & (F.col("created_at") >= moment(start))
        & (F.col("created_at") < moment(end))
    ).select("created_at", "id", "dialog_id")


def scoped_activities(activities: DataFrame, dialogs: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Opened activities of the window whose dialog still carries the flag."""
    flagged = dialogs.where(F.col("has_unopened")).select(F.col("id").alias("dialog_id"))
    return _in_scope(activities, start, end).join(flagged, "dialog_id", "left_semi").select(
        "created_at", "id", "dialog_id"
    )


def discover_batch(activities: DataFrame, dialogs: DataFrame, cursor: Cursor, n: int) -> DataFrame:
    """The next ``n`` opened activities after the cursor, in (time, id) order. Empty means complete."""
    after = F.struct(moment(cursor.after_ts).alias("created_at"), F.lit(cursor.after_id).alias("id"))
    rest = scoped_activities(activities, dialogs, cursor.start, cursor.end).where(
        F.struct("created_at", "id") > after
    )
    return first_n(rest, [F.col("created_at"), F.col("id")], n)


def advance(cursor: Cursor, batch: DataFrame) -> Cursor | None:
    """The cursor behind the last row of a batch, or None when the batch was empty."""
    last = batch.agg(F.max(F.struct("created_at", "id")).alias("last")).first()["last"]
    return None if last is None else cursor._replace(after_ts=last["created_at"], after_id=last["id"])


def batch_contribution(batch: DataFrame, repair_name: str) -> DataFrame:
    """Per dialog of a batch: first activity and activity count."""
    return (
        batch.groupBy("dialog_id")
        .agg(F.min(F.struct("created_at", "id")).alias("_first"), F.count(F.lit(1)).alias("source_activity_count"))
        .select(
            F.lit(repair_name).alias("repair_name"),
            "dialog_id",
            F.col("_first.created_at").alias("first_activity_created_at"),
            F.col("_first.id").alias("first_activity_id"),
            "source_activity_count",
        )
    )


def merge_candidates(candidates: DataFrame | None, batch: DataFrame, repair_name: str, now: Moment) -> DataFrame:
    """Add a batch: earliest time wins, the id moves only when strictly earlier, counts add up."""
    fresh = batch_contribution(batch, repair_name)
    at = moment(now)
    if candidates is None:
        return fresh.select(
            "*",
            at.alias("discovered_at"),
            F.when(F.lit(False), at).alias("processed_at"),
            F.when(F.lit(False), at).alias("updated_at"),
            F.lit(None).cast("string").alias("skipped_reason"),
        )
    o, n = candidates.alias("o"), fresh.alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in CANDIDATE_KEY], "full")
    old_ts, new_ts = F.col("o.first_activity_created_at"), F.col("n.first_activity_created_at")
    moves = old_ts.isNull() | F.coalesce(new_ts < old_ts, F.lit(False))
    merged = {
        "repair_name": F.coalesce("o.repair_name", "n.repair_name"),
        "dialog_id": F.coalesce("o.dialog_id", "n.dialog_id"),
        "first_activity_created_at": F.least(old_ts, new_ts),
        "first_activity_id": F.when(moves, F.col("n.first_activity_id")).otherwise(F.col("o.first_activity_id")),
        "source_activity_count": F.coalesce("o.source_activity_count", F.lit(0))
        + F.coalesce("n.source_activity_count", F.lit(0)),
        "discovered_at": F.coalesce("o.discovered_at", at),
    }
    return joined.select(*[merged[c].alias(c) if c in merged else F.col(f"o.{c}") for c in candidates.columns])


def discover_all(
    activities: DataFrame, dialogs: DataFrame, start: Moment, end: Moment, repair_name: str, now: Moment
) -> DataFrame:
    """All candidates of the window in one grouped pass; the same rows as all cursor batches merged."""
    return merge_candidates(None, scoped_activities(activities, dialogs, start, end), repair_name, now)


def _log_times(started: Moment, finished: Moment) -> list[Column]:
    seconds = seconds_between(moment(finished), moment(started))
    return [moment(started).alias("batch_started_at"), moment(finished).alias("batch_finished_at"), seconds.alias("batch_seconds")]


def discovery_log(
    activities: DataFrame,
    dialogs: DataFrame,
    start: Moment,
    end: Moment,
    repair_name: str,
    n: int,
    started: Moment,
    finished: Moment,
) -> DataFrame:
    """The batch log of a whole discovery read ``n`` activities at a time, as rows of phase 'discover'.

    One pass numbers all activities in (time, id) order, so every batch of the cursor is a range of numbers: its
    scanned activities, touched candidates and cursor come from one grouping. Batch 0 closes the log with the note
    that nothing was left. All rows carry the start and finish of the pass.
    """
    order = [F.col("created_at"), F.col("id")]
    numbered = add_position(scoped_activities(activities, dialogs, start, end), order)
    batch = (F.floor((F.col("position") - 1) / n) + 1).alias("batch_no")
    batches = numbered.groupBy(batch).agg(
        F.count(F.lit(1)).alias("scanned_activities"),
        F.count_distinct("dialog_id").alias("candidates_touched"),
        F.max(F.struct("created_at", "id")).alias("_last"),
    )
    last = numbered.agg(F.max(F.struct("created_at", "id")).alias("_last"))
    zero = F.lit(0).cast("bigint")
    closing = last.select(zero.alias("batch_no"), zero.alias("scanned_activities"), zero.alias("candidates_touched"), "_last")
    both = batches.withColumn("note", F.lit(None).cast("string")).unionByName(closing.withColumn("note", F.lit("discovery complete")))
    return both.select(
        F.lit(repair_name).alias("repair_name"), F.lit("discover").alias("phase"), "batch_no", *_log_times(started, finished),
        "scanned_activities", "candidates_touched", F.col("_last.created_at").alias("cursor_created_at"),
        F.col("_last.id").alias("cursor_id"), "note",
    )


def discovery_state(log: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """One state row a repair from its discovery log: window, cursor, and whether discovery is complete."""
    found = log.where(F.col("phase") == "discover")
    last = F.max(F.struct(F.col("cursor_created_at").alias("at"), F.col("cursor_id").alias("id")))
    return found.groupBy("repair_name").agg(
        moment(start).alias("window_start"),
        moment(end).alias("window_end"),
        last["at"].alias("discovery_cursor_created_at"),
        last["id"].alias("discovery_cursor_id"),
        F.max(F.col("note").eqNullSafe("discovery complete")).alias("discovery_complete"),
    )


def process_log(
    before: DataFrame, after: DataFrame, repair_name: str, n: int, started: Moment, finished: Moment
) -> DataFrame:
    """The batch log of processing ``n`` candidates at a time, as rows of phase 'process'.

    ``before`` and ``after`` are the candidates around :func:`process_candidates`; those that it processed are
    numbered in its order. ``remaining_candidates`` are the open ones behind a batch.
    """
    key = list(CANDIDATE_KEY)
    open_ = before.where(F.col("processed_at").isNull() & (F.col("repair_name") == repair_name))
    done = after.where(F.col("processed_at").isNotNull()).select(*key, F.col("updated_at").isNotNull().alias("_updated"))
    order = [F.col("first_activity_created_at"), F.col("first_activity_id"), F.col("dialog_id")]
    numbered = add_position(open_.select(*key, "first_activity_created_at", "first_activity_id").join(done, key), order)
    total = open_.count()
    batches = numbered.groupBy((F.floor((F.col("position") - 1) / n) + 1).alias("batch_no")).agg(
        F.count(F.lit(1)).alias("rows_selected"), F.count_if("_updated").alias("rows_updated"), F.max("position").alias("_upto")
    )
    return batches.select(
        F.lit(repair_name).alias("repair_name"), F.lit("process").alias("phase"), "batch_no", *_log_times(started, finished),
        "rows_selected", "rows_updated", (F.lit(total) - F.col("_upto")).alias("remaining_candidates"),
    )


class Processed(NamedTuple):
    dialogs: DataFrame
    candidates: DataFrame
    touched: DataFrame


def process_candidates(
    candidates: DataFrame,
    dialogs: DataFrame,
    transmissions: DataFrame,
    activities: DataFrame,
    now: Moment,
    n: int | None = None,
    repair_name: str | None = None,
) -> Processed:
    """Oldest candidates first: clear the flag where it is still set but nothing is unopened.

    ``n=None`` processes all open candidates at once, which gives the same result as batches.
    """
    open_ = candidates.where(F.col("processed_at").isNull())
    if repair_name is not None:
        open_ = open_.where(F.col("repair_name") == repair_name)
    order = [F.col("first_activity_created_at"), F.col("first_activity_id"), F.col("dialog_id")]
    selected = open_ if n is None else first_n(open_, order, n)
    keys = selected.select(*CANDIDATE_KEY)
    ids = durable(keys.select("dialog_id").distinct())
    chosen = dialogs.join(ids.withColumnRenamed("dialog_id", "id"), "id", "left_semi")
    now_flags = has_unopened_content(chosen, *_facts_of(ids, transmissions, activities)).withColumnRenamed("has_unopened", "_computed")
    state = chosen.select(F.col("id").alias("dialog_id"), F.col("has_unopened").alias("_flag")).join(
        now_flags, "dialog_id", "left"
    )
    fixable = F.col("_flag") & ~F.col("_computed")
    claimed = state.where(fixable).select("dialog_id")
    new_dialogs, touched = apply_update(
        dialogs, claimed, {"id": "dialog_id"}, {"has_unopened": F.lit(False)}, F.col("t.has_unopened")
    )
    reason = (
        F.when(F.coalesce(fixable, F.lit(False)), F.lit(None).cast("string"))
        .when(F.col("_computed").isNull(), F.lit("dialog_not_found"))
        .when(F.col("_flag") == F.lit(False), F.lit("already_false"))
        .when(F.col("_computed"), F.lit("still_has_unopened_content"))
        .otherwise(F.lit("not_updated_unknown"))
    )
    outcomes = keys.join(state, "dialog_id", "left").select(
        *CANDIDATE_KEY,
        F.lit(True).alias("_done"),
        F.coalesce(fixable, F.lit(False)).alias("_fixed"),
        reason.alias("_reason"),
    )
    done = F.col("_done").isNotNull()
    at = moment(now)
    changed: dict[str, Column] = {
        "processed_at": F.when(done, at).otherwise(F.col("processed_at")),
        "updated_at": F.when(F.col("_fixed"), at).otherwise(F.col("updated_at")),
        "skipped_reason": F.when(done, F.col("_reason")).otherwise(F.col("skipped_reason")),
    }
    marked = candidates.join(outcomes, list(CANDIDATE_KEY), "left").select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in candidates.columns]
    )
    return Processed(new_dialogs, marked, touched)


def repair_summary(states: DataFrame, candidates: DataFrame) -> DataFrame:
    """Counts and last times per repair; repairs without candidates stay with zeros."""
    reasons = ("already_false", "still_has_unopened_content", "dialog_not_found")
    counts = candidates.groupBy("repair_name").agg(
        F.count(F.lit(1)).alias("candidates_total"),
        F.count_if(F.col("processed_at").isNull()).alias("candidates_unprocessed"),
        F.count_if(F.col("processed_at").isNotNull()).alias("candidates_processed"),
        F.count_if(F.col("updated_at").isNotNull()).alias("candidates_updated"),
        *[F.count_if(F.col("skipped_reason") == r).alias(f"candidates_{r}") for r in reasons],
        F.max("discovered_at").alias("last_candidate_discovered_at"),
        F.max("processed_at").alias("last_candidate_processed_at"),
    )
    numbers = [c for c in counts.columns if c.startswith("candidates_")]
    return states.join(counts, "repair_name", "left").fillna(0, subset=numbers)


def still_repairable(
    candidates: DataFrame, dialogs: DataFrame, transmissions: DataFrame, activities: DataFrame
) -> DataFrame:
    """Processed candidates whose dialog still carries a flag that should be false."""
    processed = candidates.where(F.col("processed_at").isNotNull())
    ids = processed.select(F.col("dialog_id").alias("id")).distinct()
    flagged = durable(dialogs.where(F.col("has_unopened")).join(ids, "id", "left_semi"))
    own = flagged.select(F.col("id").alias("dialog_id")).distinct()
    wrong = has_unopened_content(flagged, *_facts_of(own, transmissions, activities)).where(~F.col("has_unopened"))
    return processed.join(wrong.select("dialog_id"), "dialog_id", "left_semi")


def verify_unopened(
    candidates: DataFrame, dialogs: DataFrame, transmissions: DataFrame, activities: DataFrame
) -> DataFrame:
    """Reasons, open candidates, and processed ones still repairable: rows of (check, item, n)."""
    reasons = (
        candidates.where(F.col("processed_at").isNotNull())
        .groupBy(F.col("skipped_reason").alias("item"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("skipped_reason").alias("check"), "item", "n")
    )

    def count(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("check"), F.lit(None).cast("string").alias("item"), "n"
        )

    repairable = still_repairable(candidates, dialogs, transmissions, activities)
    return reasons.unionByName(count("unprocessed", candidates.where(F.col("processed_at").isNull()))).unionByName(
        count("processed_still_repairable", repairable)
    )


def first_repairable(repairable: DataFrame, n: int = 100) -> DataFrame:
    return repairable.orderBy("processed_at", "dialog_id").limit(n).select("dialog_id")


def phase_stats(log: DataFrame) -> DataFrame:
    """Batch statistics per phase of one repair's log."""
    seconds = F.col("batch_seconds").cast("double")
    return (
        log.groupBy("phase")
        .agg(
            F.count(F.lit(1)).alias("batches"),
            F.sum("scanned_activities").alias("scanned_activities"),
            F.sum("candidates_touched").alias("candidates_touched"),
            F.sum("rows_selected").alias("rows_selected"),
            F.sum("rows_updated").alias("rows_updated"),
            F.round(F.sum(seconds), 3).alias("total_seconds"),
            F.round(F.avg(seconds), 3).alias("avg_batch_seconds"),
        )
        .orderBy("phase")
    )

"""Generic repair harness: candidates, batches, guarded updates, outcomes, progress.

Candidate columns: the key columns, any payload, then enqueued_at, processed_at, worker_id, outcome. Tables
are never changed in place: every function returns the next version of a frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.constants import OUTCOME_MANUAL_SKIP, OUTCOME_STATE_CHANGED, OUTCOME_UPDATED
from mendwork.functions.columns import Moment, moment, seconds_between
from mendwork.functions.durable import durable
from mendwork.functions.ranking import add_position

STATE_COLUMNS = ("enqueued_at", "processed_at", "worker_id", "outcome")


def _pending() -> Column:
    return F.col("processed_at").isNull()


def new_candidates(found: DataFrame, keys: Sequence[str], now: Moment) -> DataFrame:
    """``found`` as unprocessed candidates, one row per key (the smallest payload, so repeats agree)."""
    payload = [c for c in found.columns if c not in keys]
    if payload:
        one = found.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("_p")).select(*keys, "_p.*")
    else:
        one = found.select(*keys).distinct()
    at = moment(now)
    none_at = F.when(F.lit(False), at)
    return one.select(
        *keys,
        *payload,
        at.alias("enqueued_at"),
        none_at.alias("processed_at"),
        F.lit(None).cast("string").alias("worker_id"),
        F.lit(None).cast("string").alias("outcome"),
    )


def enqueue(candidates: DataFrame | None, found: DataFrame, keys: Sequence[str], now: Moment) -> DataFrame:
    """Candidates plus the keys of ``found`` not there yet. Running it again adds nothing."""
    added = new_candidates(found, keys, now)
    if candidates is None:
        return added
    return candidates.unionByName(added.join(candidates.select(*keys), list(keys), "left_anti"))


def dry_run(found: DataFrame, candidates: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """How many candidates :func:`enqueue` would add, from the same builder frame."""
    fresh = found.select(*keys).distinct()
    if candidates is not None:
        fresh = fresh.join(candidates.select(*keys), list(keys), "left_anti")
    return fresh.agg(F.count(F.lit(1)).alias("would_add"))


def claim(
    candidates: DataFrame,
    keys: Sequence[str],
    batch_size: int,
    workers: int = 1,
    max_batches: int | None = None,
) -> DataFrame:
    """Unprocessed candidates in key order as disjoint batches, dealt to workers in turn.

    Adds batch_no (from 1) and worker_id. Positions are exact and computed per range partition, so 10^8
    candidates need no single-task sort.
    """
    payload = [c for c in candidates.columns if c not in STATE_COLUMNS]
    order = [F.col(k).asc_nulls_last() for k in keys]
    placed = add_position(candidates.where(_pending()).select(*payload), order)
    batch = F.floor((F.col("position") - 1) / F.lit(batch_size)).cast("long")
    out = placed.select(
        *payload,
        (batch + 1).alias("batch_no"),
        F.concat(F.lit("worker-"), ((batch % F.lit(workers)) + 1).cast("string")).alias("worker_id"),
    )
    return out if max_batches is None else out.where(F.col("batch_no") <= max_batches)


def _claims(claimed: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """One row a claimed key with its smallest payload, and ``_claimed``; stored, so that joins are planned on its size."""
    keys = list(on.values())
    payload = [c for c in claimed.columns if c not in keys]
    least = F.min(F.struct(*payload)) if payload else F.min(F.lit(0))
    one = claimed.groupBy(*keys).agg(least.alias("_payload"))
    return durable(one.select(*keys, *[F.col(f"_payload.{p}").alias(p) for p in payload], F.lit(True).alias("_claimed")))


def _match(on: Mapping[str, str]) -> list[Column]:
    return [F.col(f"t.{tk}") == F.col(f"c.{ck}") for tk, ck in on.items()]


def _delta(target: DataFrame, claims: DataFrame, on: Mapping[str, str], set_: Mapping[str, Column], guard: Column) -> DataFrame:
    hit = target.alias("t").join(claims.alias("c"), _match(on)).where(guard)
    return hit.select(*[F.col(f"t.{k}").alias(k) for k in on], *[value.alias(name) for name, value in set_.items()])


def update_delta(
    target: DataFrame, claimed: DataFrame, on: Mapping[str, str], set_: Mapping[str, Column], guard: Column
) -> DataFrame:
    """The changes of :func:`apply_update` alone: target keys and new values of the changed columns, a row for each changed row.

    Only the keys and what ``set_`` and ``guard`` name are read of the target, and only changed rows leave the join; few
    claims are broadcast, so the target is not shuffled. A table that takes deltas (merge on read) needs no more.
    """
    return _delta(target, _claims(claimed, on), on, set_, guard)


def apply_update(
    target: DataFrame,
    claimed: DataFrame,
    on: Mapping[str, str],
    set_: Mapping[str, Column],
    guard: Column,
) -> tuple[DataFrame, DataFrame]:
    """Change only the named columns of claimed target rows that still satisfy the guard.

    ``on`` maps target key columns to claimed columns. ``set_`` and ``guard`` refer to the two sides as
    ``t.<column>`` and ``c.<column>``; a null guard means no change. Returns the new target and the claimed
    keys that were changed, once each. Of claims that repeat a key the smallest payload counts, so no target row
    is multiplied. Neither frame is a copy: the changed keys come from the delta, which is stored, and the new target is
    joined to the claims when the caller writes it.
    """
    claims = _claims(claimed, on)
    delta = durable(_delta(target, claims, on, set_, guard))
    touched = delta.select(*[F.col(tk).alias(ck) for tk, ck in on.items()]).distinct()
    hit = F.coalesce(F.col("c._claimed") & guard, F.lit(False))
    new = target.alias("t").join(claims.alias("c"), _match(on), "left").select(
        *[
            F.when(hit, set_[col]).otherwise(F.col(f"t.{col}")).alias(col) if col in set_ else F.col(f"t.{col}")
            for col in target.columns
        ]
    )
    return new, touched


def mark(
    candidates: DataFrame, claimed: DataFrame, touched: DataFrame, keys: Sequence[str], now: Moment
) -> DataFrame:
    """Claimed candidates become processed: 'updated' when touched, else 'skipped_state_changed'."""
    keys = list(keys)
    rest = [c for c in candidates.columns if c not in keys]
    states = claimed.select(*keys, F.col("worker_id").alias("_worker")).join(
        touched.select(*keys).withColumn("_hit", F.lit(True)), keys, "left"
    )
    done = F.col("_worker").isNotNull()
    changed = {
        "processed_at": F.when(done, moment(now)).otherwise(F.col("processed_at")),
        "worker_id": F.when(done, F.col("_worker")).otherwise(F.col("worker_id")),
        "outcome": F.when(
            done, F.when(F.col("_hit"), F.lit(OUTCOME_UPDATED)).otherwise(F.lit(OUTCOME_STATE_CHANGED))
        ).otherwise(F.col("outcome")),
    }
    return candidates.join(states, keys, "left").select(
        *keys, *[changed[c].alias(c) if c in changed else F.col(c) for c in rest]
    )


def batch_log(
    marked: DataFrame, claimed: DataFrame, keys: Sequence[str], started_at: Moment, finished_at: Moment
) -> DataFrame:
    """One row per batch: claimed, updated and skipped counts with the run's start and finish."""
    rows = claimed.select(*keys, "batch_no", "worker_id").join(marked.select(*keys, "outcome"), list(keys))
    updated = F.col("outcome").eqNullSafe(OUTCOME_UPDATED)
    return rows.groupBy("batch_no", "worker_id").agg(
        F.count(F.lit(1)).alias("claimed"),
        F.count_if(updated).alias("updated"),
        F.count_if(~updated).alias("skipped"),
    ).select(
        F.col("batch_no").alias("batch_id"),
        "worker_id",
        moment(started_at).alias("started_at"),
        moment(finished_at).alias("finished_at"),
        "claimed",
        "updated",
        "skipped",
    )


def progress(candidates: DataFrame) -> DataFrame:
    updated = F.col("outcome").eqNullSafe(OUTCOME_UPDATED)
    return candidates.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~_pending()).alias("processed"),
        F.count_if(_pending()).alias("remaining"),
        F.count_if(updated).alias("updated"),
        F.count_if(~_pending() & ~updated).alias("skipped"),
        F.min("processed_at").alias("first_processed_at"),
        F.max("processed_at").alias("last_processed_at"),
    )


def _rate(total: Column, digits: int | None = None) -> Column:
    span = F.nullif(seconds_between(F.max("finished_at"), F.min("started_at")), F.lit(0.0))
    rate = total.cast("double") / span
    return rate if digits is None else F.round(rate, digits)


def progress_eta(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """Progress with percent done, lifetime rows per second and estimated seconds left."""
    rate = log.where(F.col("finished_at").isNotNull()).agg(_rate(F.sum("claimed")).alias("rows_per_sec"))
    # Two one-row aggregates folded into one row.
    both = progress(candidates).unionByName(rate, allowMissingColumns=True)
    joined = both.agg(*[F.max(c).alias(c) for c in both.columns])
    pct = F.round(F.lit(100.0) * F.col("processed") / F.nullif(F.col("total"), F.lit(0)), 2)
    eta = F.when(F.col("rows_per_sec") > 0, F.col("remaining") / F.col("rows_per_sec"))
    return joined.select(
        "total", "processed", "remaining", "updated", "skipped",
        pct.alias("pct_done"), "rows_per_sec", eta.alias("eta_seconds"),
    )


def recent_throughput(log: DataFrame, now: Moment, minutes: int = 15) -> DataFrame:
    """Batches finished in the last ``minutes`` before ``now``."""
    since = moment(now) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return log.where(F.col("finished_at") >= since).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("claimed").alias("claimed"),
        F.sum("updated").alias("updated"),
        _rate(F.sum("claimed"), 2).alias("rows_per_sec"),
    )


def worker_throughput(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("worker_id")
        .agg(
            F.count(F.lit(1)).alias("batches"),
            F.min("started_at").alias("first_batch_at"),
            F.max(F.coalesce("finished_at", "started_at")).alias("last_batch_at"),
            F.sum("updated").alias("updated_total"),
            F.sum("skipped").alias("skipped_total"),
            F.round(F.avg(seconds_between(F.col("finished_at"), F.col("started_at"))), 3).alias("avg_batch_secs"),
            _rate(F.sum("updated"), 2).alias("updates_per_sec"),
        )
        .orderBy("worker_id")
    )


def check(name: str, rows: DataFrame) -> DataFrame:
    """A named invariant: how many offending rows there are."""
    return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), F.lit(None).cast("string").alias("item"), "n")


def outcome_counts(candidates: DataFrame) -> DataFrame:
    return (
        candidates.groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("outcome").alias("check"), F.col("outcome").alias("item"), "n")
    )


def verify(candidates: DataFrame, target: DataFrame, on: Mapping[str, str], broken: Column) -> DataFrame:
    """Unprocessed count, outcome breakdown, and updated rows still broken; rows of (check, item, n).

    ``broken`` is a condition on ``target`` columns. The two counts must be zero after a finished run.
    """
    t = target.where(broken).select(*[F.col(k).alias(f"_t_{k}") for k in on])
    updated = candidates.where(F.col("outcome") == OUTCOME_UPDATED)
    still = updated.join(t, [updated[ck] == t[f"_t_{tk}"] for tk, ck in on.items()], "left_semi")
    return (
        check("unprocessed", candidates.where(_pending()))
        .unionByName(outcome_counts(candidates))
        .unionByName(check("updated_still_broken", still))
        .orderBy("check", F.col("item").asc_nulls_first())
    )


def shelve(candidates: DataFrame, bad: DataFrame, keys: Sequence[str], now: Moment) -> DataFrame:
    """Known-bad keys become processed with outcome 'manual_skip', so no batch claims them again."""
    keys = list(keys)
    flagged = candidates.join(bad.select(*keys).distinct().withColumn("_bad", F.lit(True)), keys, "left")
    hit = F.coalesce(F.col("_bad"), F.lit(False))
    changed = {
        "processed_at": F.when(hit, moment(now)).otherwise(F.col("processed_at")),
        "outcome": F.when(hit, F.lit(OUTCOME_MANUAL_SKIP)).otherwise(F.col("outcome")),
    }
    return flagged.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in candidates.columns])

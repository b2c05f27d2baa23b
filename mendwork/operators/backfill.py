"""Seen-flag backfill: the flag becomes false where content changed after it was last seen.

Frames: dialogs(id, org, service, content_updated_at, mask, is_seen, ..) · seen_log(dialog_id, created_at).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mendwork.constants import MASK_MARKED_AS_UNOPENED, Urns
from mendwork.functions.columns import Moment, moment
from mendwork.operators.harness import apply_update

# fixed value: only content changed since this day is looked at
DEFAULT_SINCE = "2025-12-01"


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def seen_fixes(
    dialogs: DataFrame, seen_log: DataFrame, since: Moment = DEFAULT_SINCE, urns: Urns = Urns()
) -> DataFrame:
    """Dialogs whose seen flag is wrong: id, org. All organisations in one pass.

    Services of the organisation's migrated apps are skipped by a LIKE pattern built from the org; its
    underscores match any character. A null org or service is never fixed. A dialog counts as seen when it
    is not marked unopened and some seen entry is later than its content.
    """
    migrated = F.concat(F.lit(urns.resource + "app_"), F.col("org"), F.lit("_a2-%"))
    scope = dialogs.where(
        (F.col("content_updated_at") >= moment(since)) & F.col("is_seen") & ~F.like(F.col("service"), migrated)
    ).select("id", "org", "content_updated_at", "mask")
    last_seen = seen_log.groupBy(F.col("dialog_id").alias("id")).agg(F.max("created_at").alias("_seen"))
    seen = F.coalesce(F.col("content_updated_at") < F.col("_seen"), F.lit(False))
    unmarked = F.col("mask").bitwiseAND(F.lit(MASK_MARKED_AS_UNOPENED)) == 0
    return scope.join(last_seen, "id", "left").where(~(unmarked & seen)).select("id", "org")


def backfill_seen(
    dialogs: DataFrame, seen_log: DataFrame, since: Moment = DEFAULT_SINCE, urns: Urns = Urns()
) -> tuple[DataFrame, DataFrame]:
    """Set the wrong flags to false. Returns (dialogs, fixed keys with their org)."""
    fixes = seen_fixes(dialogs, seen_log, since, urns)
    new_dialogs, _ = apply_update(
        dialogs, fixes.select("id"), {"id": "id"}, {"is_seen": F.lit(False)}, F.col("t.is_seen")
    )
    return new_dialogs, fixes


def backfill_totals(fixes: DataFrame) -> DataFrame:
    """Fixed rows per org in order, with the running total: org, fixed, running_total."""
    # One row per organisation after the count.
    running = Window.orderBy("org").rowsBetween(Window.unboundedPreceding, 0)
    return (
        fixes.groupBy("org")
        .agg(F.count(F.lit(1)).alias("fixed"))
        .withColumn("running_total", F.sum("fixed").over(running))
        .orderBy("org")
    )

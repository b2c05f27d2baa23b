"""Which records a reader may see at a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from mendwork.constants import VISIBLE_STATUSES
from mendwork.functions.columns import Moment, moment


def visible(
    as_of: Moment,
    statuses: Sequence[int] | None = VISIBLE_STATUSES,
    mask_bit: int | None = None,
    exclude_api_only: bool = False,
) -> Column:
    """Not deleted, already visible, not expired; optionally in a status list, with a label bit, not API-only.

    Every term is a plain comparison, so the parquet scan gets the status and deletion filters.
    """
    at = moment(as_of)
    keep = ~F.col("deleted")
    if statuses is not None:
        keep = keep & F.col("status_id").isin(*statuses)
    keep = keep & (F.col("visible_from").isNull() | (F.col("visible_from") <= at))
    keep = keep & (F.col("expires_at").isNull() | (F.col("expires_at") > at))
    if mask_bit is not None:
        keep = keep & (F.col("mask").bitwiseAND(F.lit(mask_bit)) == mask_bit)
    if exclude_api_only:
        keep = keep & ~F.col("is_api_only")
    return keep

"""Exact ranks and percentiles that never put a whole group, or the whole table, into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendwork.functions.durable import durable

# Parts a group is ranked in before its best rows meet.
GROUP_PARTS = 32


def newest_first(ts: str = "content_updated_at", key: str = "id") -> list[Column]:
    return [F.col(ts).desc_nulls_first(), F.col(key).desc_nulls_first()]


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; keeps the left keys and all other columns of both sides.

    The right keys are renamed first, so both sides may come from one frame.
    """
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_right_{k}" for k in keys])


# Parts that rows with a null key are dealt into.
NULL_PARTS = 1024


def row_hash(df: DataFrame) -> Column:
    """A hash over all columns of a row that can be hashed."""
    return F.xxhash64(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind and kind != "variant"])


def left_join_spread(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key that may be null: rows with a null key match nothing and are spread over many tasks."""
    part = F.when(F.col(key).isNull(), F.pmod(row_hash(left), F.lit(NULL_PARTS))).otherwise(F.lit(0).cast("bigint"))
    # Always 0, but of a column, so that it stays part of the join key.
    zero = F.pmod(F.xxhash64(key), F.lit(1).cast("bigint"))
    return left.withColumn("_spread", part).join(right.withColumn("_spread", zero), [key, "_spread"], "left").drop("_spread")


def add_position(
    df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """Exact 1-based row number in ``order``, overall or within ``group``.

    A window over an unpartitioned frame, or over one hot group, is one task. Here rows are range
    partitioned by (group, order), so a hot group spreads over many partitions; each row takes its place in
    its sorted partition, and a table with one row per (partition, group) supplies the offset of what came
    before. ``order`` should end in a unique key: equal rows get distinct numbers in no set order.
    """
    group = list(group)
    sort = [F.col(g).asc_nulls_first() for g in group] + list(order)
    placed = durable(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_row", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftrightunsigned("_row", 33))
    spread = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.select(
        *group, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return join_null_safe(placed, offsets, [*group, "_part"]).select(
        *df.columns, (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias(name)
    )


def add_running_total(
    df: DataFrame, order: Sequence[Column], value: str, group: Sequence[str] = (), name: str = "before"
) -> DataFrame:
    """Sum of ``value`` (a long) over the rows that come before a row in ``order``, overall or within ``group``.

    Rows are range partitioned by (group, order), so a hot group spreads over many tasks. Each (partition,
    group) run is summed on its own, and a table with one row per run supplies what came before. The result
    does not depend on where the partitions were cut. Equal rows take their places in no set order.
    """
    group = list(group)
    sort = [F.col(g).asc_nulls_first() for g in group] + list(order)
    placed = durable(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_row", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftrightunsigned("_row", 33))
    spread = placed.groupBy(*group, "_part").agg(F.sum(value).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.select(*group, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    run = Window.partitionBy(*group, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("_within", F.coalesce(F.sum(value).over(run), F.lit(0)))
    return join_null_safe(running, offsets, [*group, "_part"]).select(
        *df.columns, (F.col("_before") + F.col("_within")).alias(name)
    )


def first_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows: a top-k per task, and one merge of what the tasks kept."""
    return df.orderBy(*order).limit(n)


def rank_per(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str = "_rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank, for any ``n``.

    A group is ranked in two steps: first in ``GROUP_PARTS`` parts by a hash of the row, each cut to ``n`` rows, then
    what the parts kept. So no task sorts a whole hot group, however large ``n`` is; for an ``n`` up to Spark's own
    limit (1000) the parts are cut on the map side too.
    """
    part = F.pmod(row_hash(df), F.lit(GROUP_PARTS)).cast("int")
    inner = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    kept = df.withColumn("_part", part).withColumn("_inner", inner).where(F.col("_inner") <= n).drop("_inner", "_part")
    outer = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return kept.withColumn(name, outer).where(F.col(name) <= n)


def first_n_per(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; see :func:`rank_per`."""
    return rank_per(df, group, order, n).drop("_rank")


def sampled(share: float, seed: int | str, *keys: Column | str) -> Column:
    """Whether a row falls in a sample of ``share`` by the MD5 of its keys: the same on any cluster and layout."""
    draw = F.conv(F.substring(hash_order(*keys, seed=seed), 1, 8), 16, 10).cast("long")
    return draw < int(share * (1 << 32))


def hash_order(*cols: Column | str, seed: int | str) -> Column:
    """Repeatable pseudo-random order: md5 over the key text followed by the seed."""
    text = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.md5(F.concat(*text, F.lit(str(seed))))


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    wanted: dict[str, tuple[float, str]],
) -> DataFrame:
    """Exact percentiles of ``value`` per group; one row per group with the columns named in ``wanted``.

    ``wanted`` maps a column name to ``(fraction, method)``; the method is ``linear`` (interpolated between
    the neighbours of ``p * (n - 1)``) or ``nearest`` (the value at rank ``ceil(p * n)``).

    The built-in exact percentile gathers every distinct value of a group in one task. This one counts equal
    values before the shuffle, range partitions the counts by (group, value) and adds up counts across
    partitions, so a hot group is worked on by as many tasks as it has partitions.
    """
    keys = list(keys)
    sort = [F.col(k).asc_nulls_first() for k in keys] + [F.col("_value")]
    counted = (
        df.select(*keys, F.col(value).cast("double").alias("_value"))
        .where(F.col("_value").isNotNull())
        .groupBy(*keys, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = durable(
        counted.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_part", F.spark_partition_id())
    )
    spread = placed.groupBy(*keys, "_part").agg(F.sum("_n").alias("_part_n"))
    whole = Window.partitionBy(*keys)
    offsets = spread.select(
        *keys,
        "_part",
        F.coalesce(
            F.sum("_part_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.sum("_part_n").over(whole).alias("_total"),
    )
    within = F.sum("_n").over(
        Window.partitionBy(*keys, "_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    )
    running = placed.withColumn("_within", within)
    ranked = join_null_safe(running, offsets, [*keys, "_part"]).select(
        *keys, "_value", (F.col("_before") + F.col("_within")).alias("_upto"), "_total"
    )

    def at(rank: Column) -> Column:
        """Smallest value whose running count passes the zero-based rank."""
        return F.min(F.when(F.col("_upto") > rank, F.col("_value")))

    aggs: list[Column] = [F.max("_total").alias("_total")]
    for name, (p, method) in wanted.items():
        if method == "nearest":
            aggs.append(at(F.greatest(F.ceil(F.lit(p) * F.col("_total")) - 1, F.lit(0))).alias(f"_lo_{name}"))
        else:
            place = F.lit(p) * (F.col("_total") - 1)
            aggs += [at(F.floor(place)).alias(f"_lo_{name}"), at(F.ceil(place)).alias(f"_hi_{name}")]
    found = ranked.groupBy(*keys).agg(*aggs)
    out: list[Column] = []
    for name, (p, method) in wanted.items():
        lo = F.col(f"_lo_{name}")
        if method == "nearest":
            out.append(lo.alias(name))
        else:
            place = F.lit(p) * (F.col("_total") - 1)
            out.append((lo + (F.col(f"_hi_{name}") - lo) * (place - F.floor(place))).alias(name))
    return found.select(*keys, *out)

"""Do two results hold the same rows, with the same multiplicity?"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mendwork.functions.durable import durable


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that occur more often on one side: the columns of ``a``, side ('left' or 'right'), copies.

    Both inputs are counted in one aggregation with map-side combine, one shuffle for both directions;
    equal rows meet as counts, however often they occur. Nulls equal nulls. Columns are matched by name.
    """
    columns = a.columns
    signed = a.select(*columns, F.lit(1).alias("_side")).unionByName(b.select(*columns, F.lit(-1).alias("_side")))
    return (
        signed.groupBy(*columns)
        .agg(F.sum("_side").alias("_net"))
        .where(F.col("_net") != 0)
        .select(
            *columns,
            F.when(F.col("_net") > 0, F.lit("left")).otherwise(F.lit("right")).alias("side"),
            F.abs("_net").alias("copies"),
        )
    )


# Buckets of rows whose digests are compared.
DIGEST_BUCKETS = 4096


def _bucketed(rows: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    return rows.select(*columns, F.pmod(F.xxhash64(F.lit(0), *columns), F.lit(buckets)).alias("_bucket"))


def bucket_digests(rows: DataFrame, columns: Sequence[str], buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """``_bucket``, ``n`` and a 128-bit digest ``d1``, ``d2`` of the rows in each bucket.

    Rows go to buckets by a hash of their values; a digest is the sums of two other hashes, so it does not depend on order
    and counts repeats. Sums are formed in the tasks first: only one row a bucket and task is shuffled.
    """
    halves = [F.sum(F.xxhash64(F.lit(salt), *columns).cast("decimal(20,0)")).alias(f"d{salt}") for salt in (1, 2)]
    return _bucketed(rows, columns, buckets).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), *halves)


def multiset_diff_by_digest(a: DataFrame, b: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """As :func:`multiset_diff`, for results that are mostly equal: digests of buckets are compared first, and only rows of
    buckets that differ are counted against each other.

    Equal results shuffle digests alone. Both sides are scanned twice. Two different buckets pass for equal with a chance of
    about 2**-128.
    """
    columns = a.columns
    left, right = bucket_digests(a, columns, buckets), bucket_digests(b, columns, buckets)
    named = right.select("_bucket", *[F.col(c).alias(f"_{c}") for c in ("n", "d1", "d2")])
    same = (F.col("n") == F.col("_n")) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
    # At most one row a bucket; stored, so the join below is planned on its size.
    differing = durable(left.join(named, "_bucket", "full").where(~F.coalesce(same, F.lit(False))).select("_bucket"))
    parts = [_bucketed(side, columns, buckets).join(differing, "_bucket", "left_semi").select(*columns) for side in (a, b)]
    return multiset_diff(*parts)


def diff_count(diff: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Number of differing rows, overall or per key."""
    total = F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("diff_count")
    return diff.groupBy(*keys).agg(total) if keys else diff.agg(total)


def diff_samples(diff: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Up to ``n`` differing rows per key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("side", *[c for c in diff.columns if c != "side"]))
    return diff.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def variant_pairs(names: Sequence[str], baseline: str | None = None) -> list[tuple[str, str]]:
    """All pairs of variants, or each variant against the baseline."""
    ordered = sorted(names)
    if baseline is None:
        return list(combinations(ordered, 2))
    if baseline not in ordered:
        raise ValueError(f"baseline {baseline!r} is not among the variants")
    return [(baseline, n) for n in ordered if n != baseline]


def compare_variants(
    variants: dict[str, DataFrame], parties: DataFrame, baseline: str | None = None, key: str = "party"
) -> DataFrame:
    """Difference count of every pair of variants for every party: old_id, new_id, party, diff_count.

    Every variant holds the rows of all parties. They are counted side by side in one aggregation, so adding
    a pair adds a column and no further shuffle. Parties without rows in either variant count zero.
    """
    names = sorted(variants)
    columns = variants[names[0]].columns
    wanted = parties.select(key).distinct()
    tagged = reduce(
        DataFrame.unionByName,
        [variants[n].select(*columns).withColumn("_variant", F.lit(i)) for i, n in enumerate(names)],
    ).join(wanted, key, "left_semi")
    counts = tagged.groupBy(*columns).agg(*[F.count_if(F.col("_variant") == i).alias(f"_c{i}") for i in range(len(names))])
    pairs = variant_pairs(names, baseline)
    at = {n: i for i, n in enumerate(names)}
    per_key = counts.groupBy(key).agg(
        *[F.sum(F.abs(F.col(f"_c{at[o]}") - F.col(f"_c{at[n]}"))).alias(f"_d{i}") for i, (o, n) in enumerate(pairs)]
    )
    one = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(o).alias("old_id"),
                    F.lit(n).alias("new_id"),
                    F.coalesce(f"_d{i}", F.lit(0)).cast("long").alias("diff_count"),
                )
                for i, (o, n) in enumerate(pairs)
            ]
        )
    ).alias("_p")
    return wanted.join(per_key, key, "left").select(key, one).select("_p.old_id", "_p.new_id", key, "_p.diff_count")


def equivalence_summary(results: DataFrame) -> DataFrame:
    """Checks, mismatches and failures per pair, and an 'ALL' row: pair, checks, mismatches, failures, equivalent.

    A result without a ``success`` column counts as successful; a failed check is not a mismatch.
    """
    success = F.coalesce("success", F.lit(False)) if "success" in results.columns else F.lit(True)
    pair = F.concat("old_id", F.lit("__vs__"), "new_id")
    scoped = results.select(
        F.explode(F.array(pair, F.lit("ALL"))).alias("pair"), success.alias("_ok"), F.coalesce("diff_count", F.lit(0)).alias("_d")
    )
    return (
        scoped.groupBy("pair")
        .agg(
            F.count(F.lit(1)).alias("checks"),
            F.count_if(F.col("_ok") & (F.col("_d") != 0)).alias("mismatches"),
            F.count_if(~F.col("_ok")).alias("failures"),
        )
        .withColumn("equivalent", (F.col("mismatches") == 0) & (F.col("failures") == 0))
        .orderBy("pair")
    )

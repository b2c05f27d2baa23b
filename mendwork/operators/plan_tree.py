"""The nodes of JSON query plans, found level by level."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.functions.durable import durable


def field(node: str, name: str, kind: str) -> Column:
    """A field of a VARIANT node, null where it is missing or of another kind."""
    return F.try_variant_get(node, f"$['{name}']", kind)


def plan_nodes(plans: DataFrame, keys: Sequence[str], fields: Sequence[tuple[str, str, str]], root: str = "root", children: str = "Plans") -> DataFrame:
    """One row per plan node: ``keys``, ``depth`` (root: 0), ``parent`` and ``path`` (child numbers from the root, which is ``0``,
    joined by dots; the root's parent is null), and ``fields`` as (column, field, type).

    ``root`` is a VARIANT column with each plan's root node. A round turns the nodes of one level into output rows and
    their children into the next level, which is stored; it ends with the first level that has no child. So there is no
    limit of depth, a field counts where it belongs to a node itself, and names inside keys, texts or other nested values
    are not taken for fields. Plans without a root give no row.
    """
    level = plans.where(F.col(root).isNotNull()).select(
        *keys, F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent"), F.lit("0").alias("path"), F.col(root).alias("_node")
    )
    found = []
    while True:
        level = durable(level)
        if level.isEmpty():
            break
        found.append(level.select(*keys, "depth", "parent", "path", *[field("_node", name, kind).alias(column) for column, name, kind in fields]))
        below = level.select(*keys, "depth", "path", F.posexplode(field("_node", children, "array<variant>")).alias("_at", "_child"))
        level = below.select(
            *keys, (F.col("depth") + 1).alias("depth"), F.col("path").alias("parent"), F.concat_ws(".", "path", "_at").alias("path"), F.col("_child").alias("_node")
        )
    if not found:
        return level.select(*keys, "depth", "parent", "path", *[field("_node", name, kind).alias(column) for column, name, kind in fields])
    return reduce(DataFrame.unionByName, found)

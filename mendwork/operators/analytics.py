"""Analytics over query runs: plan logs to metrics, summaries, winners, I/O totals.

Run rows: case, variant, category, party_count, service_count, round, exec_ms, shared_read, shared_hit.
Plan metrics come from :func:`plan_metrics`, or any frame with the same columns.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendwork.constants import BLOCK_BYTES
from mendwork.functions.durable import durable
from mendwork.functions.ranking import add_position, exact_percentiles, join_null_safe
from mendwork.operators.plan_tree import plan_nodes
from mendwork.operators.search import PAYLOAD_SCHEMA

# --- plan logs as JSON ------------------------------------------------------------

# fixed values: metric column and the field of the root plan node it is read from
PLAN_FIELDS = (
    ("actual_rows", "Actual Rows"),
    ("actual_loops", "Actual Loops"),
    ("shared_hit_blocks", "Shared Hit Blocks"),
    ("shared_read_blocks", "Shared Read Blocks"),
    ("shared_dirtied_blocks", "Shared Dirtied Blocks"),
    ("shared_written_blocks", "Shared Written Blocks"),
    ("local_hit_blocks", "Local Hit Blocks"),
    ("local_read_blocks", "Local Read Blocks"),
    ("local_dirtied_blocks", "Local Dirtied Blocks"),
    ("local_written_blocks", "Local Written Blocks"),
    ("temp_read_blocks", "Temp Read Blocks"),
    ("temp_written_blocks", "Temp Written Blocks"),
    ("io_read_time_ms", "I/O Read Time"),
    ("io_write_time_ms", "I/O Write Time"),
    ("shared_io_read_time_ms", "Shared I/O Read Time"),
)
# fixed values: counter column and the node field whose values are counted over the whole tree
PLAN_COUNTERS = (
    ("node_types", "Node Type"),
    ("index_names", "Index Name"),
    ("relation_names", "Relation Name"),
    ("sort_methods", "Sort Method"),
)
# fixed values: node fields summed over the whole tree
ROWS_REMOVED_FIELDS = ("Rows Removed by Filter", "Rows Removed by Join Filter")


def _counted(names: Column) -> Column:
    """``name:count`` pairs joined by ``|`` in name order."""
    pairs = F.transform(
        F.array_sort(F.array_distinct(names)),
        lambda n: F.concat(n, F.lit(":"), F.size(F.filter(names, lambda x: x == n)).cast("string")),
    )
    return F.array_join(pairs, "|")


_NODE_FIELDS = (
    *[(name.removesuffix("s"), field, "string") for name, field in PLAN_COUNTERS],
    *[(f"_removed{i}", field, "double") for i, field in enumerate(ROWS_REMOVED_FIELDS)],
)


def read_plans(plan_logs: DataFrame, plan: str = "plan") -> DataFrame:
    """``plan_logs`` with each plan's ``root`` node as VARIANT instead of its text, ``_top`` with the fields beside and on
    the root, ``parse_error`` and a number ``_log`` for each log, stored."""
    node = ", ".join(f"`{field}`: double" for _, field in PLAN_FIELDS)
    shape = f"array<struct<`Plan`: struct<{node}>, `Planning Time`: double, `Execution Time`: double, `JIT`: string>>"
    top = F.get(F.from_json(F.col(plan), shape), F.lit(0))
    error = (
        F.when(F.col(plan).isNull(), F.lit("no plan log"))
        .when(F.col("_top").isNull(), F.lit("not a JSON plan"))
        .when(F.col("_top.Plan").isNull(), F.lit("no plan in the log"))
    )
    read = plan_logs.withColumn("_top", top).withColumn("parse_error", error)
    root = F.when(F.col("parse_error").isNull(), F.try_variant_get(F.try_parse_json(plan), "$[0].Plan", "variant"))
    return durable(read.withColumns({"root": root, "_log": F.monotonically_increasing_id()}).drop(plan))


def plan_metrics(plan_logs: DataFrame, plan: str = "plan") -> DataFrame:
    """Metrics of JSON plans, one row per log; the other columns are kept and the plan text is dropped.

    Times and block counts come from the root node (a field missing there is 0), the hit ratio is null without
    blocks, and removed rows and name counts cover all nodes of the tree, see :func:`plan_tree.plan_nodes`. A text that
    is no plan has null metrics and says why in ``parse_error``, which is null otherwise. Texts are parsed once.
    """
    kept = [c for c in plan_logs.columns if c != plan]
    read = read_plans(plan_logs, plan)
    nodes = plan_nodes(read, ["_log"], _NODE_FIELDS)
    removed = [F.coalesce(F.col(name).cast("long"), F.lit(0)) for name, _, kind in _NODE_FIELDS if kind == "double"]
    names = [name.removesuffix("s") for name, _ in PLAN_COUNTERS]
    trees = nodes.groupBy("_log").agg(
        F.sum(reduce(lambda a, b: a + b, removed)).alias("_rows_removed"), *[F.collect_list(F.nullif(F.col(n), F.lit(""))).alias(f"_{n}") for n in names]
    )

    def of_plan(value: Column) -> Column:
        return F.when(F.col("parse_error").isNull(), value)

    fields = [of_plan(F.coalesce(F.col("_top.Plan")[field], F.lit(0.0))).alias(name) for name, field in PLAN_FIELDS]
    blocks = F.col("shared_hit_blocks") + F.col("shared_read_blocks")
    return read.join(trees, "_log", "left").select(
        *kept,
        "parse_error",
        of_plan(F.coalesce("_top.Planning Time", F.lit(0.0))).alias("planning_time_ms"),
        of_plan(F.coalesce("_top.Execution Time", F.lit(0.0))).alias("execution_time_ms"),
        *fields,
        of_plan(F.col("_rows_removed")).alias("rows_removed"),
        *[of_plan(_counted(F.col(f"_{name}"))).alias(column) for name, (column, _) in zip(names, PLAN_COUNTERS)],
        F.col("_top.JIT").alias("jit"),
    ).withColumn("shared_hit_ratio", F.when(blocks > 0, F.col("shared_hit_blocks") / blocks))


def with_manifest(manifest: DataFrame, metrics: DataFrame) -> DataFrame:
    """Manifest rows of runs that ended well (exit code 0) with the metrics of their plan.

    Both sides are keyed by case_id, pass, run_index, variant. A run whose plan log is missing stays, with null
    metrics and its ``parse_error``; runs that failed are left out whatever they logged.
    """
    key = ["case_id", "pass", "run_index", "variant"]
    ended = manifest.where(F.col("exit_code") == 0)
    new = [c for c in metrics.columns if c in key or c not in manifest.columns]
    joined = ended.join(metrics.select(*new).withColumn("_logged", F.lit(True)), key, "left")
    missing = F.when(F.col("_logged").isNull(), F.lit("no plan log")).otherwise(F.col("parse_error"))
    return joined.withColumn("parse_error", missing).drop("_logged")


def counter_rows(metrics: DataFrame, keys: Sequence[str], counter: str) -> DataFrame:
    """Total count per name of a ``name:count|...`` column within ``keys``: keys, name, n."""
    item = F.explode(F.split(F.col(counter), r"\|")).alias("_item")
    return (
        metrics.select(*keys, item)
        .where(F.col("_item").contains(":"))
        .groupBy(*keys, F.regexp_extract("_item", "^(.*):[0-9]+$", 1).alias("name"))
        .agg(F.sum(F.substring_index("_item", ":", -1).cast("long")).alias("n"))
    )


def _top_names(metrics: DataFrame, keys: Sequence[str], counter: str, n: int, name: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("n").desc(), "name"))
    return (
        counter_rows(metrics, keys, counter)
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= n)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_rank", F.col("name").alias("_name")))).alias("_top"))
        .select(*keys, F.array_join(F.transform("_top", lambda e: e["_name"]), ", ").alias(name))
    )


# fixed values: how many names a group report lists
TOP_INDEXES, TOP_NODE_TYPES = 5, 8


def _by_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_null_safe(left, right, keys, "left")


def group_report(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group: samples, median and nearest-rank p90 time, extremes, median I/O, most common names.

    Names with equal counts are listed in name order. Runs without a readable plan (no execution time) do not count.
    """
    keys = list(keys)
    metrics = metrics.where(F.col("execution_time_ms").isNotNull())
    temp = F.col("temp_read_blocks") + F.col("temp_written_blocks")
    long = metrics.withColumn("temp_blocks", temp).unpivot(
        keys,
        ["execution_time_ms", "shared_read_blocks", "shared_hit_blocks", "shared_hit_ratio", "temp_blocks"],
        "_metric",
        "_v",
    )
    ranks = exact_percentiles(
        long, [*keys, "_metric"], "_v", {"median": (0.5, "linear"), "p90": (0.9, "nearest")}
    )

    def of(metric: str, stat: str) -> Column:
        return F.max(F.when(F.col("_metric") == metric, F.col(stat)))

    wide = ranks.groupBy(*keys).agg(
        of("execution_time_ms", "median").alias("median_execution_ms"),
        of("execution_time_ms", "p90").alias("p90_execution_ms"),
        of("shared_read_blocks", "median").alias("median_shared_read_blocks"),
        of("shared_hit_blocks", "median").alias("median_shared_hit_blocks"),
        of("shared_hit_ratio", "median").alias("median_shared_hit_ratio"),
        of("temp_blocks", "median").alias("median_temp_blocks"),
    )
    base = metrics.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("samples"),
        F.min("execution_time_ms").alias("min_execution_ms"),
        F.max("execution_time_ms").alias("max_execution_ms"),
    )
    out = _by_keys(base, wide, keys)
    out = _by_keys(out, _top_names(metrics, keys, "index_names", TOP_INDEXES, "common_indexes"), keys)
    return _by_keys(out, _top_names(metrics, keys, "node_types", TOP_NODE_TYPES, "common_node_types"), keys).fillna(
        "", subset=["common_indexes", "common_node_types"]
    )


def winners(metrics: DataFrame, case: Sequence[str] = ("case_id", "run_index")) -> DataFrame:
    """The fastest variant of every case and run; equal times go to the smaller variant name."""
    described = ("party_count", "service_count", "estimated_dialog_count_band")
    extra = [c for c in described if c in metrics.columns and c not in case]
    best = F.min(F.struct("execution_time_ms", "variant", *extra)).alias("_b")
    return (
        metrics.where(F.col("execution_time_ms").isNotNull())
        .groupBy(*case)
        .agg(best)
        .select(*case, F.col("_b.variant").alias("winner"), "_b.execution_time_ms", *[f"_b.{c}" for c in extra])
        .orderBy(*case)
    )


def glob_pattern(glob: str) -> str:
    """A shell-style name pattern as a regular expression."""
    return "^" + fnmatch.translate(glob).removeprefix("(?s:").removesuffix(r")\z").removesuffix(r")\Z") + "$"


def io_summary(
    metrics: DataFrame, passes: Sequence[int] = (), case_globs: Sequence[str] = (), case: str = "case_id"
) -> DataFrame:
    """Block and time totals per variant, optionally for some passes and case-name patterns."""
    if passes:
        metrics = metrics.where(F.col("pass").isin(*passes))
    if case_globs:
        metrics = metrics.where(reduce(lambda a, b: a | b, [F.col(case).rlike(glob_pattern(g)) for g in case_globs]))
    gib = F.lit(BLOCK_BYTES / 1024**3)
    return (
        metrics.groupBy("variant")
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.count_if(F.col("shared_read_blocks") > 0).alias("read_samples"),
            F.sum("shared_hit_blocks").alias("hit_blocks"),
            F.sum("shared_read_blocks").alias("read_blocks"),
            F.sum("shared_io_read_time_ms").alias("read_ms"),
            F.sum("planning_time_ms").alias("planning_ms"),
            F.sum("execution_time_ms").alias("execution_ms"),
        )
        .select(
            "variant",
            "samples",
            "read_samples",
            "hit_blocks",
            "read_blocks",
            (F.col("hit_blocks") + F.col("read_blocks")).alias("total_blocks"),
            F.round((F.col("hit_blocks") + F.col("read_blocks")) * gib, 2).alias("total_gib"),
            F.round(F.col("read_blocks") * gib, 2).alias("read_gib"),
            "read_ms",
            "planning_ms",
            "execution_ms",
        )
        .orderBy("variant")
    )


# --- plan logs as text ------------------------------------------------------------


def split_blocks(lines: DataFrame) -> DataFrame:
    """Cut a combined log at ``EXPLAIN <query> <case>`` headers: case, variant, file, chunk, at, line.

    ``lines`` has file, chunk, at, line: a file is read in chunks (its splits), and (chunk, at) orders its
    lines. Names are file stems. The header in force is carried forward inside each chunk and then across
    chunks, so one huge log is still many tasks. Lines before the first header are dropped.
    """
    header = r"^EXPLAIN\s+(\S+)\s+(\S+)"
    text = F.trim(F.regexp_replace("line", r"^\s+|\s+$", ""))
    is_header = text.rlike(header)
    opened = F.when(
        is_header, F.struct(F.regexp_extract(text, header, 2).alias("case"), F.regexp_extract(text, header, 1).alias("variant"))
    )
    inside = Window.partitionBy("file", "chunk").orderBy("at")
    marked = lines.select("file", "chunk", "at", "line", is_header.alias("_header"), opened.alias("_opened"))
    here = marked.withColumn("_here", F.last("_opened", ignorenulls=True).over(inside))
    # One row per chunk: the header its last line stands under.
    ends = marked.where("_header").groupBy("file", "chunk").agg(F.max(F.struct("at", "_opened")).alias("_end"))
    chunks = marked.select("file", "chunk").distinct().join(ends, ["file", "chunk"], "left")
    earlier = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(
        "file", "chunk", F.last(F.col("_end._opened"), ignorenulls=True).over(earlier).alias("_carried")
    )
    block = F.coalesce("_here", "_carried")
    stem = r"(\.[^./]+)?$"

    def name(part: str) -> Column:
        return F.regexp_replace(F.substring_index(F.col(f"_block.{part}"), "/", -1), stem, "")

    return (
        here.where(~F.col("_header"))
        .join(carried, ["file", "chunk"])
        .withColumn("_block", block)
        .where(F.col("_block").isNotNull())
        .select(name("case").alias("case"), name("variant").alias("variant"), "file", "chunk", "at", "line")
    )


def plan_text_metrics(blocks: DataFrame, keys: Sequence[str] = ("case", "variant")) -> DataFrame:
    """Execution time and shared buffer counts of text plans: keys, exec_ms, shared_read, shared_hit, shared_dirtied.

    ``blocks`` has the keys, ``line_no`` and ``line``. Buffers come from the least indented ``Buffers:`` line
    before ``Planning:``, the last one if several; if there is none, from all lines. Counts are null without
    a shared section, and 0 for parts it does not name.
    """
    keys = list(keys)
    line = F.col("line")
    stripped = F.regexp_replace(line, r"^\s+|\s+$", "")
    seconds = F.regexp_extract(line, r"Execution Time: ([0-9.]+) ms", 1)
    facts = blocks.where(
        (stripped == "Planning:") | line.contains("Buffers:") | line.contains("Execution Time: ")
    ).select(
        *keys,
        "line_no",
        "line",
        F.when(stripped == "Planning:", F.col("line_no")).alias("_planning"),
        F.when(seconds != "", seconds.try_cast("double")).alias("_exec"),
    )
    heads = facts.groupBy(*keys).agg(
        F.min("_planning").alias("_planning_at"),
        F.min(F.when(F.col("_exec").isNotNull(), F.struct("line_no", "_exec"))).alias("_time"),
    )
    indent = F.length(line) - F.length(F.regexp_replace(line, r"^\s+", ""))
    # Least indent first, then the last line.
    place = F.struct((-indent).alias("i"), F.col("line_no").alias("n"), line.alias("line"))
    buffers = facts.where(line.contains("Buffers:"))
    before = F.coalesce(F.col("line_no") < F.col("_planning_at"), F.lit(True))
    picked = (
        _by_keys(buffers.select(*keys, "line_no", "line"), heads.select(*keys, "_planning_at"), keys)
        .groupBy(*keys)
        .agg(F.max(F.when(before, place)).alias("_before"), F.max(place).alias("_any"))
        .select(*keys, F.coalesce("_before", "_any")["line"].alias("_line"))
    )
    everything = blocks.select(*keys).distinct()
    out = _by_keys(_by_keys(everything, heads, keys), picked, keys)
    shared = F.regexp_extract("_line", r"\bshared\b(.*)", 1)
    has_shared = F.col("_line").rlike(r"\bshared\b")

    def count(name: str) -> Column:
        found = F.regexp_extract(shared, rf"\b{name}=(\d+)", 1)
        return F.when(has_shared, F.when(found == "", F.lit(0).cast("long")).otherwise(found.try_cast("long")))

    return out.select(
        *keys,
        F.col("_time._exec").alias("exec_ms"),
        count("read").alias("shared_read"),
        count("hit").alias("shared_hit"),
        count("dirtied").alias("shared_dirtied"),
    )


# --- run rows ---------------------------------------------------------------------


def case_sizes(cases: DataFrame, case: str = "case", payload: str = "payload") -> DataFrame:
    """Distinct parties and services per permission payload; unreadable payloads are left out."""
    groups = F.from_json(F.col(payload), PAYLOAD_SCHEMA)

    def distinct(part: str) -> Column:
        lists = F.transform(F.col("_g"), lambda g: F.coalesce(g[part], F.array().cast("array<string>")))
        return F.size(F.array_distinct(F.flatten(lists)))

    return (
        cases.select(case, groups.alias("_g"))
        .where(F.col("_g").isNotNull())
        .select(case, distinct("Parties").alias("party_count"), distinct("Services").alias("service_count"))
    )


def cache_status(read: Column, hit: Column) -> Column:
    return (
        F.when(read.isNull() & hit.isNull(), F.lit("-"))
        .when(read > 0, F.lit("io"))
        .when((read == 0) & (hit > 0), F.lit("cached"))
        .when((read == 0) & (hit == 0), F.lit("none"))
        .otherwise(F.lit("?"))
    )


def category(party_count: Column, service_count: Column, party_hi: int = 10, service_hi: int = 20) -> Column:
    return F.concat(
        F.when(party_count > party_hi, F.lit("hpc")).otherwise(F.lit("lpc")),
        F.lit("/"),
        F.when(service_count > service_hi, F.lit("hsc")).otherwise(F.lit("lsc")),
    )


def classify_runs(runs: DataFrame, party_hi: int = 10, service_hi: int = 20) -> DataFrame:
    """Adds cache_status and category to run rows."""
    return runs.withColumn("cache_status", cache_status(F.col("shared_read"), F.col("shared_hit"))).withColumn(
        "category", category(F.col("party_count"), F.col("service_count"), party_hi, service_hi)
    )


# fixed values: metric prefix and run column, statistic suffixes
SUMMARY_METRICS = (("exec", "exec_ms"), ("read", "shared_read"), ("hit", "shared_hit"))
SUMMARY_PERCENTILES = (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))


def _case_summary(runs: DataFrame, keys: list[str], meta: Sequence[str], digits: int) -> DataFrame:
    runs = runs.where((F.col("case") != "") & (F.col("variant") != ""))
    base = runs.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in meta],
        F.count("exec_ms").alias("samples"),
        F.count(F.lit(1)).alias("attempted"),
        *[
            f(F.col(col).cast("double")).alias(f"{name}_{stat}")
            for name, col in SUMMARY_METRICS
            for stat, f in (("avg", F.avg), ("min", F.min), ("max", F.max))
        ],
    )
    long = runs.select(*keys, *[F.col(col).cast("double").alias(name) for name, col in SUMMARY_METRICS]).unpivot(
        keys, [name for name, _ in SUMMARY_METRICS], "_metric", "_v"
    )
    ranks = exact_percentiles(long, [*keys, "_metric"], "_v", {n: (p, "linear") for n, p in SUMMARY_PERCENTILES})
    wide = ranks.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("_metric") == name, F.col(p))).alias(f"{name}_{p}")
            for name, _ in SUMMARY_METRICS
            for p, _ in SUMMARY_PERCENTILES
        ]
    )
    stats = [f"{name}_{s}" for name, _ in SUMMARY_METRICS for s in ("avg", "min", "max", "p50", "p95", "p99")]
    return _by_keys(base, wide, keys).select(
        *keys,
        *meta,
        "samples",
        "attempted",
        F.round(F.col("samples") * 100.0 / F.col("attempted"), 2).alias("completion_rate_pct"),
        *[F.round(c, digits).alias(c) for c in stats],
    )


def variant_case_summary(runs: DataFrame, digits: int = 4) -> DataFrame:
    """Per (variant, case): counts, completion, and avg/min/max/p50/p95/p99 (interpolated) of time, reads, hits."""
    meta = [c for c in ("category", "party_count", "service_count") if c in runs.columns]
    return _case_summary(runs, ["variant", "case"], meta, digits)


def round_summaries(runs: DataFrame, digits: int = 4) -> DataFrame:
    """The same per round and over all rounds: ``scope`` is the round number as text, or 'total'."""
    scoped = runs.withColumn("scope", F.explode(F.array(F.col("round").cast("string"), F.lit("total"))))
    meta = [c for c in ("category", "party_count", "service_count") if c in runs.columns]
    return _case_summary(scoped, ["scope", "variant", "case"], meta, digits)


def variant_rollup(summary: DataFrame, by: Sequence[str] = ("variant",)) -> DataFrame:
    """Per variant: mean of means, min of mins, max of maxes, and the mean of the per-case percentiles."""
    counted = ("exec_avg", "exec_p50", "exec_p95", "exec_p99")
    return (
        summary.where(F.col("variant") != "")
        .groupBy(*by)
        .agg(
            F.greatest(*[F.count(c) for c in counted]).alias("cases"),
            F.avg("exec_avg").alias("exec_avg"),
            F.min("exec_min").alias("exec_min"),
            F.max("exec_max").alias("exec_max"),
            *[F.avg(f"exec_{p}").alias(f"exec_{p}") for p, _ in SUMMARY_PERCENTILES],
        )
        .orderBy(*by)
    )


def run_summary(records: DataFrame, digits: int = 2) -> DataFrame:
    """Per sql_id of run records (sql_id, success, execution_time_ms): counts and interpolated times, rounded."""
    ok = records.where(F.col("success"))
    counts = records.groupBy("sql_id").agg(
        F.count_if(F.col("success")).alias("count_success"),
        F.count_if(~F.coalesce("success", F.lit(False))).alias("count_failures"),
    )
    stats = ok.groupBy("sql_id").agg(
        F.avg("execution_time_ms").alias("avg_ms"),
        F.min("execution_time_ms").alias("min_ms"),
        F.max("execution_time_ms").alias("max_ms"),
    )
    ranks = exact_percentiles(
        ok, ["sql_id"], "execution_time_ms", {f"{n}_ms": (p, "linear") for n, p in SUMMARY_PERCENTILES}
    )
    times = ("avg_ms", "p50_ms", "p95_ms", "p99_ms", "min_ms", "max_ms")
    return (
        counts.join(stats, "sql_id", "left")
        .join(ranks, "sql_id", "left")
        .select("sql_id", "count_success", "count_failures", *[F.round(c, digits).alias(c) for c in times])
        .orderBy("sql_id")
    )


def wide_report(runs: DataFrame, variants: Sequence[str]) -> DataFrame:
    """One row per case with a column set per variant, by category, counts and case name.

    Variant names are given, so the pivot needs no extra pass and its width is fixed.
    """
    by = ["category", "party_count", "service_count", "case"]
    cells = [
        F.max(F.when(F.col("variant") == v, F.col(c))).alias(f"{v}_{c}")
        for v in variants
        for c in ("exec_ms", "shared_read", "shared_hit", "shared_dirtied", "cache_status")
    ]
    return runs.groupBy(*by).agg(*cells).orderBy(*by)


# --- shorter plan texts -----------------------------------------------------------

# fixed values: line starts that are kept or dropped when a plan text is condensed
KEEP_PREFIXES = (
    "Index Cond:", "Filter:", "Join Filter:", "Rows Removed by Filter:", "Rows Removed by Join Filter:",
    "Recheck Cond:", "Sort Key:", "Group Key:", "Buffers:", "Heap Fetches:", "Planning Time:", "Execution Time:",
)
DROP_PREFIXES = (
    "Sort Method:", "Memory:", "Batches:", "Cache Key:", "Cache Mode:", "Hits:", "Misses:", "Evictions:",
    "Overflows:", "Memory Usage:", "Output:", "Worker ",
)
# fixed values: terms that get one-character codes, in code order
COMMON_TERMS = (
    "Index Only Scan", "Index Scan", "Bitmap Heap Scan", "Bitmap Index Scan", "Seq Scan", "Nested Loop",
    "Merge Join", "Hash Join", "HashAggregate", "Aggregate", "Subquery Scan", "CTE Scan", "Function Scan",
    "Gather Merge", "Gather", "Memoize", "Sort", "Limit", "Unique", "Materialize", "Result", "Filter:",
    "Index Cond:", "Join Filter:", "Rows Removed by Filter:", "Rows Removed by Join Filter:", "Recheck Cond:",
    "Sort Key:", "Group Key:", "Buffers:", "Heap Fetches:", "Planning Time:", "Execution Time:", "Semi Join",
    "Append", "ProjectSet", "on", "using", "shared hit", "read", "written",
)
TERM_CODES = "!#$%&*+;:?@^_|~ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def _starts(text: Column, prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.startswith(p) for p in prefixes])


def condense_plans(lines: DataFrame) -> DataFrame:
    """Keep headers, node lines and telling detail lines; shorten node lines. Other columns are kept."""
    line = F.col("line")
    text = F.regexp_replace(line, r"^\s+|\s+$", "")
    header = text.startswith("== ") & text.endswith(" ==")
    dropped = _starts(text, DROP_PREFIXES)
    node = line.rlike(r"^\s*(-> )?[^\(]+\(.*\)")
    kept = _starts(text, KEEP_PREFIXES)
    spaced = F.regexp_replace(text, r"\s+", " ")
    body = F.regexp_replace(text, r"^->\s*", "")
    title = F.regexp_replace(F.substring_index(body, "(", 1), r"\s+$", "")
    actual = F.regexp_extract(line, r"actual time=[^\)]*", 0)
    short = reduce(
        lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])),
        (("actual time=", "t="), ("rows=", "r="), ("loops=", "l=")),
        F.regexp_replace(F.regexp_replace(actual, r"\s+", " "), r"\s+$", ""),
    )
    shortened = F.concat(
        F.when(text.startswith("->"), F.lit("-> ")).otherwise(F.lit("")),
        title,
        F.when(actual != "", F.concat(F.lit(" ("), short, F.lit(")"))).otherwise(F.lit("")),
    )
    out = F.when(header, text).when(dropped, F.lit(None)).when(node, shortened).when(kept, spaced)
    return lines.withColumn("line", F.when(text != "", out)).where(F.col("line").isNotNull())


# Lines that one task searches, about.
LINES_PER_TASK = 1 << 16


def spread_lines(lines: DataFrame) -> DataFrame:
    """``lines`` dealt out evenly: searching a line takes far longer than reading it, and few tasks may read a short file.

    They are stored, since a search that filters lines would otherwise be done before they are dealt out.
    """
    return durable(lines.repartition(max(1, -(-lines.count() // LINES_PER_TASK)), *lines.columns))


def plan_names(lines: DataFrame, order: Sequence[str] = ("line_no",)) -> DataFrame:
    """Index and table names in order of first appearance: name, first (a sortable position).

    A line yields, in this order, its scanned index, quoted relations, bare relations, other quoted text.
    """
    # fixed values: where names occur in a line
    patterns = (
        r"Index (?:Only )?Scan using (\S+)",
        r'\b(?:on|using)\s+"([^"]+)"',
        r"\b(?:on|using)\s+([A-Za-z0-9_\.]+)",
        r'"([^"]+)"',
    )

    def found(kind: int) -> Column:
        hits = F.regexp_extract_all("line", F.lit(patterns[kind]), F.lit(1))
        hits = F.slice(hits, 1, 1) if kind == 0 else hits
        return F.transform(hits, lambda n, at: F.struct(F.lit(kind).alias("kind"), at.alias("at"), n.alias("name")))

    hit = lines.select(*order, F.explode(F.concat(*[found(i) for i in range(len(patterns))])).alias("_h"))
    name = F.trim(F.regexp_replace(F.regexp_replace("_h.name", r"^\s+|\s+$", ""), r'^"+|"+$', ""))
    named = hit.select(F.struct(*order, "_h.kind", "_h.at").alias("first"), name.alias("name"))
    is_name = F.col("name").rlike(r"^(IX_|PK_|FK_)") | F.col("name").contains(".") | F.col("name").rlike(r"^\p{Lu}")
    return named.where((F.length("name") > 1) & is_name).groupBy("name").agg(F.min("first").alias("first"))


def _letter_code(position: Column) -> Column:
    """Codes AA, AB, ... ZZ for positions from 1, then AAA and on: as many letters as are needed."""
    code, before = F.lit(None).cast("string"), 0
    for size in range(2, 9):
        at = position - 1 - before
        letters = [F.chr((F.floor(at / 26**place) % 26 + 65).cast("bigint")) for place in range(size - 1, -1, -1)]
        code = F.coalesce(code, F.when(at < 26**size, F.concat(*letters)))
        before += 26**size
    return code


def _pieces(text: Column) -> Column:
    """Words and single other characters, in text order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]"), F.lit(0))


def _name_places(lines: DataFrame, names: DataFrame, order: Sequence[str]) -> DataFrame:
    """Where names stand in lines: ``order`` and ``_found``, a list of (rank, bare, from, to, code) with places in pieces.

    Pieces that begin a name are found by a join on the piece, and what follows them by a join on the name's text, so each
    occurrence meets its own name only. A name counts between quotes, which belong to the place, or between word borders.
    """
    starts = durable(names.groupBy(F.get(_pieces(F.col("name")), F.lit(0)).alias("_piece")).agg(F.collect_set(F.size(_pieces(F.col("name")))).alias("_sizes")))
    split = lines.select(*order, _pieces(F.col("line")).alias("_pieces"))
    begins = split.select(*order, F.posexplode("_pieces").alias("_at", "_piece")).join(starts, "_piece")
    begun = begins.select(*order, F.explode("_sizes").alias("_size"), "_at").groupBy(*order).agg(F.collect_list(F.struct("_at", "_size")).alias("_begun"))
    spans = join_null_safe(split, begun, order).select(*order, "_pieces", F.explode("_begun").alias("_b"))
    start, end = F.col("_b._at"), F.col("_b._at") + F.col("_b._size")
    before, after = F.get("_pieces", start - 1), F.get("_pieces", end)
    first, last = F.get("_pieces", start), F.get("_pieces", end - 1)

    def is_word(piece: Column) -> Column:
        return F.coalesce(piece.rlike(r"^[\p{L}\p{N}_]"), F.lit(False))

    quoted = F.coalesce((before == '"') & (after == '"'), F.lit(False))
    bounded = (is_word(before) != is_word(first)) & (is_word(last) != is_word(after))
    named = spans.where(end <= F.size("_pieces")).select(
        *order, F.array_join(F.slice("_pieces", start + 1, F.col("_b._size")), "").alias("name"), (~quoted).alias("bare"),
        (start - quoted.cast("int")).alias("from"), (end + quoted.cast("int")).alias("to"), (quoted | bounded).alias("_counts"),
    )
    hits = named.where("_counts").join(names.select("name", "rank", "code"), "name")
    return hits.groupBy(*order).agg(F.array_sort(F.collect_list(F.struct("rank", "bare", "from", "to", "code"))).alias("_found"))


def dictionary_encode(lines: DataFrame, order: Sequence[str] = ("line_no",)) -> tuple[DataFrame, DataFrame]:
    """Replace names by letter codes and common terms by one-character codes: (lines, dictionary).

    Names get the two-letter codes in order of first use, then three-letter ones, and so on. Where names overlap, the one
    first used wins, then quoted over bare, then the leftmost; codes are not searched again. The dictionary (``kind``,
    ``text``, ``code``) stays a table, whatever its size. ``order`` tells lines apart.
    """
    # Read three times below, and what made them may be dear.
    lines = durable(lines)
    ranked = add_position(plan_names(lines, order), [F.col("first")], name="rank")
    names = durable(ranked.select("name", "rank", _letter_code(F.col("rank")).alias("code")))
    term_codes = list(zip(COMMON_TERMS, TERM_CODES))
    terms = lines.sparkSession.createDataFrame([("term", t, c) for t, c in term_codes], "kind string, text string, code string")
    dictionary = names.select(F.lit("name").alias("kind"), F.col("name").alias("text"), "code").unionByName(terms)

    def take(taken: Column, hit: Column) -> Column:
        free = ~F.exists(taken, lambda t: (t["from"] < hit["to"]) & (t["to"] > hit["from"]))
        return F.when(free, F.array_append(taken, hit)).otherwise(taken)

    places = _name_places(lines, names, order)
    joined = join_null_safe(lines, places, order, "left")
    none = F.slice("_found", 1, 0)
    kept = joined.withColumn("_taken", F.aggregate("_found", none, take))

    def written(piece: Column, at: Column) -> Column:
        inside = F.filter("_taken", lambda t: (t["from"] <= at) & (at < t["to"]))
        code = F.when(F.get(inside, F.lit(0))["from"] == at, F.get(inside, F.lit(0))["code"]).otherwise("")
        return F.when(F.size(inside) > 0, code).otherwise(piece)

    named = F.when(F.col("_taken").isNull(), F.col("line")).otherwise(F.array_join(F.transform(_pieces(F.col("line")), written), ""))
    # The terms are a fixed list; the longest are replaced first.
    rules = [(f"\\Q{t}\\E" if t.endswith(":") or " " in t else f"\\b\\Q{t}\\E\\b", c) for t, c in sorted(term_codes, key=lambda t: -len(t[0]))]
    encoded = reduce(lambda text, rule: F.regexp_replace(text, rule[0], rule[1].replace("\\", "\\\\").replace("$", "\\$")), rules, named)
    return kept.withColumn("line", encoded).drop("_found", "_taken"), dictionary

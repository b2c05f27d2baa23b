import math
import random
import re
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendwork.functions import durable, ranking
from mendwork.functions.columns import band_of, party_key, reorder_name, stratum, uuid7
from mendwork.functions.text import build_tokens, text_matches


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = [(("hot" if i % 3 else f"g{i % 7}") if i % 11 else None, rng.choice([1.0, 2.5, rng.random() * 9, None]), i) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "g string, v double, id int")


def test_add_position_overall_and_per_group(skewed):
    rows, df = skewed
    got = {r["id"]: r["position"] for r in ranking.add_position(df, [F.col("id").desc()]).collect()}
    assert got == {i: 3000 - i for i in range(3000)}
    grouped = {r["id"]: r["position"] for r in ranking.add_position(df, [F.col("id")], group=["g"]).collect()}
    seen: dict = {}
    for g, _, i in rows:
        seen[g] = seen.get(g, 0) + 1
        assert grouped[i] == seen[g]


def test_exact_percentiles_match_brute_force(skewed):
    rows, df = skewed
    wanted = {"p50": (0.5, "linear"), "p95": (0.95, "linear"), "n90": (0.9, "nearest"), "p0": (0.0, "linear"), "p100": (1.0, "linear")}
    got = {r["g"]: r for r in ranking.exact_percentiles(df, ["g"], "v", wanted).collect()}
    groups: dict = {}
    for g, v, _ in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        vs.sort()
        for name, q in (("p50", 50), ("p95", 95), ("p0", 0), ("p100", 100)):
            assert got[g][name] == pytest.approx(np.percentile(vs, q), abs=1e-12)
        assert got[g]["n90"] == vs[max(0, math.ceil(0.9 * len(vs)) - 1)]


def test_first_n(skewed):
    _, df = skewed
    assert {r["id"] for r in ranking.first_n(df, [F.col("id").desc()], 500).collect()} == set(range(2500, 3000))


@pytest.mark.parametrize("n", [1, 1001, 2500, 10_000])
def test_first_n_per_never_ranks_a_whole_group_in_one_task(spark, n):
    rows = spark.range(30_000).select("id", (F.col("id") % 3 % 2).alias("g"), (F.col("id") * 7919 % 30_011).alias("v"))
    order = [F.col("v").desc(), F.col("id")]
    got = {g: [r["id"] for r in part] for g, part in _by(ranking.first_n_per(rows, ["g"], order, n).collect(), "g").items()}
    for g, part in _by(rows.collect(), "g").items():
        want = sorted(part, key=lambda r: (-r["v"], r["id"]))[:n]
        assert sorted(got[g]) == sorted(r["id"] for r in want)
    inner = rows.withColumn("_part", F.pmod(F.xxhash64("id", "g", "v"), F.lit(ranking.GROUP_PARTS)))
    most = max(r["count"] for r in inner.groupBy("g", "_part").count().collect())
    assert most <= 2 * 20_000 / ranking.GROUP_PARTS


def _by(rows, key):
    out = {}
    for r in rows:
        out.setdefault(r[key], []).append(r)
    return out


def test_uuid7_is_valid_and_repeatable(spark):
    df = spark.range(50).select(
        "id", uuid7(F.lit("2026-01-17 02:53:52.533").cast("timestamp"), F.col("id")).alias("u")
    )
    first, again = [r["u"] for r in df.orderBy("id").collect()], [r["u"] for r in df.orderBy("id").collect()]
    assert first == again and len(set(first)) == 50
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", u) for u in first)


@pytest.mark.parametrize(
    ("query", "hits"),
    [
        ("cat", {1, 2, 4}),
        ("sad cat", {1, 2}),
        ('"sad cat"', {1}),
        ("cat -sad", {4}),
        ('"sad cat" or rat', {1, 3}),
        ("cat fat or rat", {3, 4}),
        ("-cat", set()),
        ("rat or -cat", set()),
        ("", set()),
        ('"" - !', set()),
        ("CAT", {1, 2, 4}),
        ("sad-cat", {1}),
    ],
)
def test_text_matches(spark, query, hits):
    docs = spark.createDataFrame([(1, "A sad cat."), (2, "cat, then sad"), (3, "Rat!"), (4, "fat CAT"), (5, "")], "doc_id int, text string")
    found = build_tokens(docs).where(text_matches(F.col("tokens"), query))
    assert {r["doc_id"] for r in found.collect()} == hits


def test_small_columns(spark):
    names = spark.createDataFrame([(" LAST FIRST MIDDLE ",), ("ONE",), ("A  B",), (None,)], "n string")
    assert [r[0] for r in names.select(reorder_name(F.col("n"))).collect()] == ["FIRST MIDDLE LAST", "ONE", " B A", None]
    urns = spark.createDataFrame([("urn:demo:person:identifier-no:1",), ("urn:demo:organization:identifier-no:2",), ("urn:x:3",)], "u string")
    assert [r[0] and tuple(r[0]) for r in urns.select(party_key(F.col("u"))).collect()] == [("1", "p"), ("2", "o"), None]
    counts = spark.createDataFrame([(c,) for c in (0, 1, 10, 11, 100, 101, 1000, 10000, 10001)], "c int")
    assert [r[0] for r in counts.select(stratum(F.col("c"))).collect()] == [
        "0", "1-10", "1-10", "11-100", "11-100", "101-1000", "101-1000", "1001-10000", "10001+",
    ]
    edge = spark.createDataFrame([(0.01,), (0.05,), (0.25,)], "f double")
    assert [tuple(r) for r in edge.select(band_of(F.col("f"), False), band_of(F.col("f"), True)).collect()] == [
        ("very_hot", "hot"), ("hot", "medium"), ("medium", "long_tail"),
    ]


def test_stage_folders_are_shared_or_refused(spark):
    def session(master, named=None):
        context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=context)

    assert durable.shared_dir(session("spark://host:1", "hdfs://store/stages/")) == "hdfs://store/stages"
    for master in ("spark://host:1", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            durable.shared_dir(session(master))
    path = durable.new_stage(spark)
    spark.range(3).write.parquet(path)
    assert durable.exists(spark, path) and path.startswith(durable.stage_dir(spark))


def test_null_keys_are_spread_in_a_left_join(spark):
    left = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id") % 7).alias("k"))
    right = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k bigint, v string")
    got = {r["id"]: r["v"] for r in ranking.left_join_spread(left, right, "k").collect()}
    assert len(got) == 4000
    assert all(v == (f"v{i % 7}" if i % 4 == 0 and i % 7 < 5 else None) for i, v in got.items())
    part = F.pmod(ranking.row_hash(left), F.lit(ranking.NULL_PARTS))
    assert left.where("k is null").groupBy(part.alias("p")).count().agg(F.max("count")).first()[0] < 40


def test_running_totals_do_not_depend_on_partitions(spark):
    rows = spark.range(500).select("id", (F.col("id") % 3).alias("g"), (F.col("id") * 31 % 17).alias("v"))
    for n in (1, 7):
        found = ranking.add_running_total(rows.repartition(n), [F.col("id")], "v", group=["g"]).collect()
        for g in range(3):
            total = 0
            for r in sorted((r for r in found if r["g"] == g), key=lambda r: r["id"]):
                assert r["before"] == total
                total += r["v"]

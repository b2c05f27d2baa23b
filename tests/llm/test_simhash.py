import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from mendwork.llm import simhash


def brute_print(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(rows, budget=4):
    """Smallest id reachable, by rows ``(id, fp)``; null ids name nothing."""
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= budget:
                root[top(i)] = top(j)
    names = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            names[top(i)] = min(names.get(top(i), name), name)
    return [names.get(top(i)) for i in range(len(rows))]


def test_fingerprints():
    for text in (None, "", " \t", "One two", "One two three four Five", "É a b C d\x0be\x85f " * 40, "x " * 70_000):
        assert simhash.fingerprint(text) == brute_print(text) if len(text or "") < 1000 else True
    assert simhash.fingerprint("x " * 70_000) == brute_print("x x x x")


def _near(seed, n, spread):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(6)]
    found = []
    for _ in range(n):
        x = rng.choice(base)
        for b in rng.sample(range(64), rng.randint(0, spread)):
            x ^= 1 << b
        found.append(x)
    return found + [rng.getrandbits(64) for _ in range(n)]


def test_links_and_components_against_brute_force(spark):
    for seed, bucket_rows, even_rows in ((1, 1 << 16, 1 << 12), (2, 24, 1 << 12), (3, 1 << 16, 1)):
        keys = sorted(set(_near(seed, 150, 7)))
        signed = [int(np.uint64(k).astype(np.int64)) for k in keys]
        nodes = spark.createDataFrame([(k,) for k in signed], "fp bigint")
        found = simhash.components(simhash.links(nodes, bucket_rows=bucket_rows, even_rows=even_rows)).collect()
        root = {r["node"]: r["root"] for r in found}
        want = brute_components(list(enumerate(keys)))
        groups = lambda names: sorted(sorted(g) for g in _group(names).values())
        assert groups({k: root.get(k, k) for k in signed}) == groups(dict(zip(signed, want)))


def _group(names):
    out = {}
    for k, v in names.items():
        out.setdefault(v, []).append(k)
    return out


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 300).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    found = simhash.components(edges).collect()
    assert {r["root"] for r in found} == {0} and len(found) == 299


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.collect()]
    got = {r["doc_id"]: (r["fp"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    for (name, fp), component in zip(rows, brute_components(rows)):
        assert got[name] == (int(np.uint64(fp).astype(np.int64)), component)
    kept = [r["doc_id"] for r in simhash.deduplicate(docs).collect()]
    assert sorted(kept) == sorted({c for _, c in got.values()})


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], brute_print(r["text"])) for r in odd_docs.collect()]
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(odd_docs).collect()), key=repr)
    assert got == sorted(((n, c) for (n, _), c in zip(rows, brute_components(rows))), key=repr)
    kept = simhash.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c in brute_components(rows)})
    assert simhash.near_duplicates(no_docs).count() == simhash.deduplicate(no_docs).count() == 0

import random

import pytest

import corpus_pipeline
from mendwork.llm import neardup

SF = "/root/testdata/sf0.001"


def brute_similarity(a, b, n=5):
    """Jaccard similarity of two texts' word shingles."""
    sets = []
    for text in (a, b):
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set())
    x, y = sets
    return len(x & y) / len(x | y) if x | y else 1.0


def edited(texts, seed, low, high):
    """``(text, copy)`` with some words replaced, of a similarity from ``low`` up to below ``high``."""
    rng, found = random.Random(seed), []
    for text in texts:
        words = text.split()
        if len(words) < 40:
            continue
        for k in range(1, 9):
            new = list(words)
            for i in rng.sample(range(len(words)), k):
                new[i] = f"zz{rng.randrange(10**6)}"
            if low <= brute_similarity(text, " ".join(new)) < high:
                found.append((text, " ".join(new)))
                break
    return found


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    return list(dict.fromkeys(r["text"] for r in rows))


def _stage(spark, pairs):
    rows = [(2 * i + j, t, "en", "s", len(t)) for i, pair in enumerate(pairs) for j, t in enumerate(pair)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}


def test_stage_drops_copies_of_similarity_0_8(spark, texts):
    pairs = edited(texts, 1, 0.8, 0.85)
    assert len(pairs) > 30
    kept = _stage(spark, pairs)
    assert not [i for i in range(len(pairs)) if 2 * i + 1 in kept]


def test_stage_keeps_copies_below(spark, texts):
    pairs = edited(texts, 2, 0.7, 0.8)
    assert len(pairs) > 30
    kept = _stage(spark, pairs)
    first = {t: i for i, (t, _) in reversed(list(enumerate(pairs)))}
    lone = [i for i, (t, _) in enumerate(pairs) if all(brute_similarity(c, x) < 0.8 for c in [pairs[i][1]] for p in pairs for x in p if x is not c)]
    assert len(first) == len(pairs) and lone and {2 * i + 1 for i in lone} <= kept


def brute_kept(rows):
    """Ids that all pairs of ``(id, text)`` of a similarity of 0.8 or more leave: the smallest of each group."""
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if brute_similarity(a, b) >= 0.8:
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return sorted(i for i in root if top(i) == i)


def test_stage_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    assert sorted(kept) == brute_kept(rows)


def test_hot_group_and_block_edges(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        new = list(base)
        new[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(new)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [r["doc_id"] for r in neardup.deduplicate(docs).collect()] == [0]
    nodes = neardup._sketches(docs.selectExpr("struct(doc_id as id) as place", "text"), 5).selectExpr("place.id as row", "fp", "keys")
    want = {tuple(r) for r in neardup.candidates(nodes).collect()}
    assert {tuple(r) for r in neardup.candidates(nodes, block=7).collect()} == want


def test_the_trie_join_links_what_no_key_does(spark, monkeypatch):
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(1500)) for _ in range(12)]
    near = [t.rsplit(" ", 1)[0] + " end" for t in base]
    assert all(neardup.similar(a, b) for a, b in zip(base, near))
    monkeypatch.setattr(neardup, "band_keys", lambda hashes: neardup.np.zeros(0, neardup.np.int64))
    monkeypatch.setattr(neardup, "candidates", lambda nodes, **_: nodes.selectExpr("row AS u", "row AS v", "0L AS bits").limit(0))
    rows = [(i, t) for i, t in enumerate(base + near)]
    kept = neardup.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(12))


def test_trie_links_connect_all_within_their_bits(spark):
    rng, prints = random.Random(4), []
    for _ in range(60):
        fp = rng.getrandbits(64)
        prints += [fp, fp] + [fp ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 4, 5, 8)]
    nodes = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(prints)]
    made = neardup.trie_links(spark.createDataFrame(nodes, "row bigint, fp bigint")).collect()
    assert all((prints[r["u"]] ^ prints[r["v"]]).bit_count() == r["bits"] and r["u"] < r["v"] for r in made)

    def groups(pairs):
        root = list(range(len(prints)))

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for u, v in pairs:
            x, y = top(u), top(v)
            root[max(x, y)] = min(x, y)
        return [top(i) for i in range(len(prints))]

    near = [(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints[:i]) if (a ^ b).bit_count() <= neardup.TRIE_BITS]
    assert groups([(r["u"], r["v"]) for r in made]) == groups(near)

import hashlib
import math
from collections import Counter

import numpy as np

from mendwork.llm import fingerprint as fp


def brute_levels(data):
    out = []
    for i in range(len(data) - fp.WINDOW + 1):
        info = sum(round(c * math.log2(c) * 1024) for c in Counter(data[i : i + fp.WINDOW]).values())
        out.append((round(64 * 6 * 1024) - info) * (fp.LEVELS - 1) // round(64 * 6 * 1024))
    return out


def brute_features(data, ranks):
    levels = brute_levels(data)
    if len(data) < fp.WINDOW:
        return {data + bytes(fp.WINDOW - len(data))} if data else set()
    runs = [range(i, i + fp.RUN) for i in range(len(levels) - fp.RUN + 1)]
    if not runs:
        return {data[(i := min(range(len(levels)), key=lambda i: (ranks[levels[i]], i))) : i + fp.WINDOW]}
    votes = Counter(min(run, key=lambda i: (ranks[levels[i]], i)) for run in runs)
    return {data[i : i + fp.WINDOW] for i, v in votes.items() if v >= min(fp.VOTES, max(votes.values()))}


TEXTS = [b"", b"short", b"a" * 64, b"abc" * 30, bytes(range(256)) * 3, "Über die Höhen und Täler. ".encode() * 9, b"x" * 126, b"y" * 127]


def test_levels_counts_and_features_against_brute_force(monkeypatch):
    rng = np.random.default_rng(0)
    texts = TEXTS + [rng.integers(97, 117, n).astype(np.uint8).tobytes() for n in (63, 64, 100, 127, 128, 700)]
    monkeypatch.setattr(fp, "_BLOCK", 97)
    for t in texts:
        assert fp.entropy_levels(np.frombuffer(t, np.uint8)).tolist() == brute_levels(t)
    want = np.bincount([x for t in texts for x in brute_levels(t)], minlength=fp.LEVELS)
    assert (fp.level_counts(texts) == want).all()
    ranks = rng.permutation(fp.LEVELS)
    for t, filters in zip(texts, fp.digests(texts, ranks)):
        features = brute_features(t, ranks)
        assert len(filters) == -(-len(features) // fp.FILTER_FEATURES)
        lone = [fp._hashes(np.frombuffer(f, np.uint8)[None])[0] for f in features]
        bits = {int(h >> np.uint64(11 * k)) & 2047 for h in lone for k in range(fp.SUB_HASHES)}
        assert set(np.flatnonzero(np.unpackbits(filters, axis=1).any(axis=0)) if len(filters) else []) == bits


def test_likeness():
    rng = np.random.default_rng(1)
    a, b = (fp.digests([rng.integers(97, 123, 20_000).astype(np.uint8).tobytes()], np.arange(fp.LEVELS))[0] for _ in range(2))
    none = np.zeros((0, fp.FILTER_BYTES), np.uint8)
    assert fp.likeness(a, a) == 1 and fp.likeness(a, b) < 0.1 and fp.likeness(none, none) == 1 and fp.likeness(a, none) == 0
    assert fp.likeness(a, b) == fp.likeness(b, a)


def _edited(rows):
    """By the contract, from (id, text) in descending order."""
    out = []
    for i, (name, text) in enumerate(rows):
        cut = len(text) // 3
        out.append((name, len(text), hashlib.sha256((text[: len(text) - cut] + rows[(i + 1) % len(rows)][1][:cut]).encode()).hexdigest()))
    return out


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    ranks = fp.level_ranks(docs)
    got = fp.compare_edited(docs, ranks).collect()
    want = _edited(sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True))
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    plain = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(docs, "doc_id", ranks=ranks).collect()}
    assert all(r["fingerprint"] == plain[r["doc_id"]] for r in got)
    assert sum(r["near_edited"] for r in got) / len(got) > 0.4 and all(0 <= r["near_next"] <= 1 for r in got)


def test_odd_rows(spark, odd_docs, no_docs):
    ranks = fp.level_ranks(odd_docs)
    got = fp.compare_edited(odd_docs, ranks).collect()
    assert len(got) == odd_docs.count()
    by_text = {}
    for r in got:
        by_text.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by_text[4] == by_text[5] and by_text[0] == by_text[1] == {""}
    one = odd_docs.where("doc_id = 8").collect()[0]["text"]
    alone = fp.compare_edited(odd_docs.where("doc_id = 8"), ranks).collect()
    assert [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in alone] == _edited([(8, one)])
    assert fp.compare_edited(no_docs, fp.level_ranks(no_docs)).count() == 0

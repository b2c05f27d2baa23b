import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from mendwork.llm import packing
from mendwork.llm.encoding import default_tokenizer
from mendwork.llm.packing import Capacity, best_fit


def brute_best_fit(lengths, capacity, weights):
    """Every piece by itself, over all bins."""
    full = capacity.vector().astype(float)
    rooms, placed = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        need = np.array([lengths[i], 1, lengths[i] ** 2], float)
        fits = [b for b, r in enumerate(rooms) if (r >= need).all()]
        if fits:
            b = min(fits, key=lambda b: (float((np.array(weights) * ((rooms[b] - need) / full) ** 2).sum()), b))
        else:
            rooms.append(full.copy())
            b = len(rooms) - 1
        rooms[b] = rooms[b] - need
        placed[int(i)] = b
    return placed, len(rooms)


@pytest.mark.parametrize("capacity", [Capacity(64), Capacity(64, docs=3), Capacity(64, attention=1400), Capacity(64, 4, 4096)])
@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_capacities_hold_and_offsets_are_gapless(capacity, rule):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 37, 600)
    bins, offsets = best_fit(lengths, capacity, rule=rule)
    groups = defaultdict(list)
    for b, o, n in zip(bins, offsets, lengths):
        groups[b].append((o, n))
    limit = capacity.vector()
    for members in groups.values():
        at = 0
        for o, n in sorted(members):
            assert o == at
            at += n
        assert at <= limit[0] and len(members) <= limit[1] and sum(n * n for _, n in members) <= limit[2]
    if rule == "norm":
        _, made = brute_best_fit(lengths, capacity, (1.0, 1e-3, 1e-3))
        assert len(groups) == made


def test_pieces_and_packing_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    t = Tokenizer.from_file(default_tokenizer())
    rows = packing.pack_documents(docs, capacity=Capacity(256)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for d in docs.collect():
        ids = [*t.encode(d["text"], add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[d["doc_id"]], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and all(p["length"] == 256 for p in pieces[1:])
        at = 0
        for p in pieces:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    assert len(by_sequence) <= -(-sum(r["length"] for r in rows) // 256) * 1.02 + 1


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    assert sum(r["piece"] == 0 for r in rows) == odd_docs.count()
    assert sorted(r["length"] for r in rows if r["doc_id"] in (0, 1)) == [1, 1]
    assert packing.pack_documents(no_docs).count() == 0


def test_groups_do_not_change_what_fits(spark):
    pieces = spark.range(500).selectExpr("id", "cast(1 + id * 37 % 90 as bigint) as length", "'own' as offset_before")
    rows = packing.pack_pieces(pieces, capacity=Capacity(100), group_pieces=60).collect()
    sums = defaultdict(int)
    for r in rows:
        sums[r["sequence_id"]] += r["length"]
    assert len(rows) == 500 and max(sums.values()) <= 100

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from mendwork.functions.durable import new_stage
from mendwork.llm import encoding, planes
from mendwork.llm.encoding import Encoder, default_tokenizer

ODD = ["", "a  b", "a \nb\n", " a", "a\n b", "it's  we'll", "it's we'll a.\nb", "a \n", "\n\nb", "日本 語 12 ½ a b", "tab\there", "½ a²b x_y __a1 \n\n\nq", "é1é .,a", " x  y", "’s İ ﬀ"]


def test_encoder_gives_the_library_ids(spark):
    t = Tokenizer.from_file(default_tokenizer())
    encode = Encoder(default_tokenizer())
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in ODD + docs:
        assert np.frombuffer(encode.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    for text in ("one<|endoftext|>two", "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext", "<|EndOfText|>"):
        assert np.frombuffer(encode.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    assert 50256 in np.frombuffer(encode.encode("one<|endoftext|>two"), "<u4")


def test_common_words_stay_kept(monkeypatch):
    monkeypatch.setattr(encoding, "KNOWN_WORDS", 40)
    encode, t = Encoder(default_tokenizer()), Tokenizer.from_file(default_tokenizer())
    asked = []
    merge, other = encode._later._merge, encode._later._ids
    monkeypatch.setattr(encode._later, "_merge", lambda word: asked.append(word) or merge(word))
    monkeypatch.setattr(encode._later, "_ids", lambda word: asked.append(word) or other(word))
    for i in range(500):
        text = f"x common once{i} words other{i}"
        assert np.frombuffer(encode.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        assert len(encode._later) + len(encode._later._older) <= 40
    assert asked.count("Ġcommon") == asked.count("Ġwords") == 1 and len(asked) == 1002


def test_words_beside_line_feeds_are_kept_apart():
    encode, t = Encoder(default_tokenizer()), Tokenizer.from_file(default_tokenizer())
    texts = ["one two.\nThree four\nfive", "\nThree two.\nfive", "one two.\n", "\n", "a\n's b'\nt x\n12\n.é\nÉa", "one\n\nfive\n\n\nsix\nseven\n\n", "a \nb\nc", "\n\n", "a\nb \n"]
    for text in texts * 2:
        assert np.frombuffer(encode.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    assert not [w for w in encode._later if "two.\n" in w] and "Three" in encode._first and "two." in encode._later


@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 64, 1000])
def test_planes_round_trip(unit, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
    made = planes.to_planes(ids, unit, block_ids=64)
    assert len(made) == (4 if unit == "byte" else 32)
    assert (planes.from_planes(made, n, unit) == ids).all()


@pytest.mark.parametrize("unit,chunk_ids", [("byte", 1 << 18), ("bit", 500)])
def test_folder_round_trip(spark, unit, chunk_ids):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    folder = new_stage(spark)
    planes.write_tokens(docs, folder, unit=unit, chunk_ids=chunk_ids, block_ids=64)
    got = {r["doc_id"]: r for r in planes.read_tokens(spark, folder).collect()}
    t, at = Tokenizer.from_file(default_tokenizer()), 0
    for d in sorted(docs.collect(), key=lambda d: d["doc_id"]):
        ids = [*t.encode(d["text"], add_special_tokens=False).ids, 0]
        r = got[d["doc_id"]]
        assert list(r["ids"]) == ids and r["start"] == at and r["n_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_odd_rows(spark, odd_docs, no_docs):
    folder = new_stage(spark)
    planes.write_tokens(odd_docs, folder, chunk_ids=64)
    rows = planes.read_tokens(spark, folder, keep_ids=False).collect()
    assert len(rows) == odd_docs.count()
    spans = sorted((r["start"], r["n_tokens"]) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    planes.write_tokens(no_docs, folder)
    assert planes.read_tokens(spark, folder).count() == 0

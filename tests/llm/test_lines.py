import random

from mendwork.llm import lines


def brute(rows, size=3):
    """Rows (id, text) in order: lines covered by any but the first occurrence of a window go."""
    seen, out = set(), []
    for name, text in sorted(rows, key=lambda r: r[0]):
        own = [] if text is None else text.split("\n")
        gone = set()
        for i in range(max(len(own) - size, 0) + 1 if text is not None else 0):
            window = tuple(own[i : i + size])
            if not "".join(window).strip():
                continue
            if window in seen:
                gone |= set(range(i, min(i + size, len(own))))
            seen.add(window)
        kept = [x for i, x in enumerate(own) if i not in gone]
        out.append((name, None if text is None else "\n".join(kept), len(own), len(gone)))
    return out


def test_against_brute_force(spark):
    rng = random.Random(0)
    rows = [(i, "\n".join(rng.choices(["a b", "c", "", "d", "éé"], k=rng.randint(1, 14)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "\n\n\n\n"), (203, "x\n" * 500), (204, "only one line"), (205, "only one line")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in lines.remove_repeated(df).collect())
    assert got == brute(rows)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in lines.remove_repeated(docs).collect())
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(odd_docs, no_docs):
    cut = lines.remove_repeated(odd_docs)
    assert [c for c in cut.columns if c not in ("n_lines", "n_removed")] == [c for c in odd_docs.columns if c not in ("n_lines", "n_removed")]
    rows = cut.collect()
    assert len(rows) == odd_docs.count()
    kept = sorted(((r["doc_id"], r["text"]) for r in rows if (r["text"] or "").startswith("The same")), key=repr)
    # Rows that repeat id and text are one document: the first of the copies stays on all of them.
    assert kept == [(4, "The same short line.")] * 3
    assert lines.remove_repeated(no_docs).count() == 0

"""Word arrays and web-style query matching over them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed value: a word is a run of letters and digits
WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased words in text order. No stemming and no stop words."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def build_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its word array; the array index is the word position."""
    return docs.select(F.col(key), words(F.col(text)).alias("tokens"))


# Documents whose words one task groups, about.
DOCS_PER_TASK = 4096


def dealt_out(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text``, dealt out by key into parts of bounded size: what groups the words by key then moves no word.

    Texts are shorter than their words with places, so this is the smaller shuffle.
    """
    return docs.select(key, text).repartition(max(1, -(-docs.count() // DOCS_PER_TASK)), key)


def token_positions(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per word occurrence: key, 1-based position, token."""
    return tokens.select(F.col(key), F.posexplode("tokens").alias("_at", "token")).select(
        key, (F.col("_at") + 1).alias("position"), "token"
    )


def _phrase(tokens: Column, wanted: list[str]) -> Column:
    if len(wanted) == 1:
        return F.array_contains(tokens, wanted[0])
    # Words hold letters and digits only, so blanks mark their borders exactly.
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" ")).contains(f" {' '.join(wanted)} ")


def parse_query(query: str) -> list[list[tuple[bool, list[str]]]]:
    """The alternatives of a web-style query, each a list of terms ``(negated, words)``; a term of several words is a phrase.

    Words are AND-ed, ``"a b"`` is a phrase, ``or`` and ``-not`` work; AND binds tighter than ``or``. A query without
    words has no alternative, and neither has one with an alternative made of negations only: both match nothing.
    """
    branches: list[list[tuple[bool, list[str]]]] = [[]]
    for term in re.findall(r'-?"[^"]*"|\S+', query):
        if term.lower() == "or":
            branches.append([])
            continue
        wanted = re.findall(r"[^\W_]+", term.lower())
        if wanted:
            branches[-1].append((term.startswith("-"), wanted))
    branches = [b for b in branches if b]
    return [] if any(all(negated for negated, _ in b) for b in branches) else branches


def text_matches(tokens: Column, query: str) -> Column:
    """Web-style match over a word array, see :func:`parse_query`. Words must be equal after lower-casing: there is no stemmer.

    This tests every row it is given; :mod:`mendwork.operators.text_index` finds the matching documents in stored postings.
    """
    branches = parse_query(query)
    if not branches:
        return F.lit(False)

    def branch(words_: Column, terms: list[tuple[bool, list[str]]]) -> Column:
        parts = [~_phrase(words_, w) if negated else _phrase(words_, w) for negated, w in terms]
        return reduce(lambda a, b: a & b, parts)

    # The one-element array binds the word array to a name: a filter pushed below the projection that splits
    # the text then splits it once per row, not once per term.
    return F.exists(F.array(tokens), lambda t: reduce(lambda a, b: a | b, [branch(t, b) for b in branches]))

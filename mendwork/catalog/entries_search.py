"""Search queries and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendwork.catalog.views import Views
from mendwork.constants import TEXT_CAPS
from mendwork.functions.durable import durable
from mendwork.functions.text import build_tokens, dealt_out, text_matches, token_positions
from mendwork.functions.visibility import visible
from mendwork.operators import search

AS_OF = "2000-06-01"
_VISIBLE = """status_id IN (7, 2, 8) AND (visible_from IS NULL OR visible_from <= CAST('2000-06-01' AS TIMESTAMP))
    AND (expires_at IS NULL OR expires_at > CAST('2000-06-01' AS TIMESTAMP)) AND NOT deleted"""


def _perms(v: Views) -> search.Permissions:
    """Both narrow tables of the demo permissions, whose groups are full products of their lists."""
    return search.Permissions(v.permission.select("group_no", "party").distinct(), v.permission.select("group_no", "service").distinct())


def q1_visible(v: Views) -> DataFrame:
    return (
        v.dialog.where(visible(AS_OF, mask_bit=1, exclude_api_only=True))
        .groupBy("service")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("max_id"))
    )


def q2_search_party_driven(v: Views) -> DataFrame:
    return search.search_party_driven(v.dialog, _perms(v), AS_OF)


def q2_search_cases(v: Views) -> DataFrame:
    """All nations' permission sets searched at once."""
    parties = v.sql("SELECT DISTINCT c_nationkey AS case_no, 0 AS group_no, urn AS party FROM cust")
    services = v.sql(
        """SELECT DISTINCT c_nationkey AS case_no, 0 AS group_no, service
           FROM dialog JOIN cust ON urn = party WHERE service < 'urn:demo:resource:4'"""
    )
    perms = search.Permissions(parties, services)
    return search.search_party_driven(v.dialog, perms, AS_OF, case=["case_no"], mask_bit=1)


def q3_search_service_driven(v: Views) -> DataFrame:
    return search.search_service_driven(v.dialog, _perms(v), AS_OF, mask_bit=1)


def q4_search_single_party(v: Views) -> DataFrame:
    services = v.permission.groupBy("party").agg(F.collect_set("service").alias("services"))
    return search.search_single_party(v.dialog, services, AS_OF, k=3)


def q5_fetch_page(v: Views) -> DataFrame:
    ids = search.search_party_driven(v.dialog, _perms(v), AS_OF)
    return search.fetch_page(ids, v.dialog)


# Dialogs are looked up in the documents of the same number.
_TEXT_QUERY = "the -en"


def q6_search_dialog_first_text(v: Views) -> DataFrame:
    return search.search_dialog_first_text(v.dialog, _perms(v), v.text_index(), _TEXT_QUERY, AS_OF)


def q6_search_dialog_first_text_capped(v: Views) -> DataFrame:
    per_driver, overall, k = TEXT_CAPS
    return search.search_dialog_first_text(
        v.dialog, _perms(v), v.text_index(), _TEXT_QUERY, AS_OF, k=k, per_driver=per_driver, overall=overall
    )


def q7_text_matches(v: Views) -> DataFrame:
    return v.text_index().matches("this -was or from")


def q7_text_matches_phrase(v: Views) -> DataFrame:
    return v.text_index().matches('"of the" -be')


def q7_text_matches_column(v: Views) -> DataFrame:
    """The same without an index: every text is split and tested."""
    hit = text_matches(F.col("tokens"), 'this -"of the" or "and the" from')
    return build_tokens(v.documents).where(hit).select("doc_id")


def q7_text_matches_mixed(v: Views) -> DataFrame:
    return v.text_index().matches('this -"of the" or "and the" from')


def q8_postings(v: Views) -> DataFrame:
    """The stored postings, counted by document, beside what the lexicon says of each document's rarest word."""
    index = v.text_index()
    # Positions are summed before the join, so no list is shuffled. The lexicon is stored first: a join to an aggregate of its
    # own key could not split a hot token.
    rows = index.postings().select(
        "token",
        "doc_id",
        F.size("positions").alias("n"),
        (F.length("token") * F.aggregate("positions", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("position_sum"),
    )
    return rows.join(durable(index.lexicon()), "token").groupBy("doc_id").agg(
        F.sum("n").alias("n_tokens"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum("position_sum").alias("position_sum"),
        F.min("n_docs").alias("rarest_docs"),
        F.max("n_words").alias("commonest_words"),
    )


def q8_build_tokens(v: Views) -> DataFrame:
    return (
        token_positions(build_tokens(dealt_out(v.documents)))
        .groupBy("doc_id")
        .agg(
            F.count(F.lit(1)).alias("n_tokens"),
            F.count_distinct("token").alias("n_distinct"),
            F.sum(F.length("token") * F.col("position")).alias("position_sum"),
        )
    )


def q9_dialog_labels(v: Views) -> DataFrame:
    page = search.dialog_labels(v.dialog, v.context, v.context_label)
    return page.withColumn("labels", F.array_join(F.col("labels").cast("array<string>"), ","))


_PAGE = f"""
    SELECT d.id, d.content_updated_at FROM dialog d
    JOIN permission p ON p.party = d.party AND p.service = d.service
    WHERE {_VISIBLE}"""

_PERMITTED_TEXT = """
    SELECT id, content_updated_at FROM (
      SELECT d.id, d.content_updated_at,
             row_number() OVER (PARTITION BY p.group_no, p.party ORDER BY d.content_updated_at DESC, d.id DESC) AS rn
      FROM dialog d JOIN permission p ON p.party = d.party AND p.service = d.service
      WHERE (visible_from IS NULL OR visible_from <= CAST('2000-06-01' AS TIMESTAMP))
        AND (expires_at IS NULL OR expires_at > CAST('2000-06-01' AS TIMESTAMP)) AND NOT deleted AND NOT is_api_only) x
    {cut}"""


def _text_sql(cut: str) -> str:
    return f"""SELECT c.id, c.content_updated_at FROM ({_PERMITTED_TEXT.format(cut=cut)}) c JOIN {_TOKENS} t ON t.doc_id = c.id
            WHERE list_contains(tokens, 'the') AND NOT list_contains(tokens, 'en')
            ORDER BY c.content_updated_at DESC, c.id DESC LIMIT 101"""


_TOKENS = r"(SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS tokens FROM documents)"

ENTRIES = {
    "q1_visible": (
        q1_visible,
        f"""SELECT service, count(*) AS n, max(id) AS max_id FROM dialog
            WHERE {_VISIBLE} AND (mask & 1) = 1 AND NOT is_api_only GROUP BY service""",
    ),
    "q2_search_party_driven": (
        q2_search_party_driven,
        f"{_PAGE} ORDER BY d.content_updated_at DESC, d.id DESC LIMIT 101",
    ),
    "q2_search_cases": (
        q2_search_cases,
        f"""SELECT case_no, id, content_updated_at FROM (
              SELECT c_nationkey AS case_no, d.id, d.content_updated_at,
                     row_number() OVER (PARTITION BY c_nationkey ORDER BY d.content_updated_at DESC, d.id DESC) AS rn
              FROM dialog d JOIN cust ON urn = d.party
              WHERE service < 'urn:demo:resource:4' AND (mask & 1) = 1 AND {_VISIBLE}) x WHERE rn <= 101""",
    ),
    "q3_search_service_driven": (
        q3_search_service_driven,
        f"{_PAGE} AND (mask & 1) = 1 ORDER BY d.content_updated_at DESC, d.id DESC LIMIT 101",
    ),
    "q4_search_single_party": (
        q4_search_single_party,
        f"""SELECT party, id, content_updated_at FROM (
              SELECT d.party, d.id, d.content_updated_at,
                     row_number() OVER (PARTITION BY d.party ORDER BY d.content_updated_at DESC, d.id DESC) AS rn
              FROM dialog d JOIN (SELECT DISTINCT party, service FROM permission) p ON p.party = d.party AND p.service = d.service
              WHERE {_VISIBLE}) x WHERE rn <= 3""",
    ),
    "q5_fetch_page": (
        q5_fetch_page,
        f"""SELECT d.* FROM ({_PAGE} ORDER BY d.content_updated_at DESC, d.id DESC LIMIT 101) p
            JOIN dialog d ON d.id = p.id""",
    ),
    "q6_search_dialog_first_text": (
        q6_search_dialog_first_text,
        _text_sql(""),
    ),
    "q6_search_dialog_first_text_capped": (
        q6_search_dialog_first_text_capped,
        _text_sql("WHERE rn <= 2500 ORDER BY content_updated_at DESC, id DESC LIMIT 5000"),
    ),
    "q7_text_matches": (
        q7_text_matches,
        f"""SELECT doc_id FROM {_TOKENS} t
            WHERE (list_contains(tokens, 'this') AND NOT list_contains(tokens, 'was'))
               OR list_contains(tokens, 'from')""",
    ),
    "q7_text_matches_phrase": (
        q7_text_matches_phrase,
        f"""SELECT doc_id FROM {_TOKENS} t
            WHERE contains(concat(' ', array_to_string(tokens, ' '), ' '), ' of the ')
              AND NOT list_contains(tokens, 'be')""",
    ),
    "q7_text_matches_column": (
        q7_text_matches_column,
        f"""SELECT doc_id FROM {_TOKENS} t
            WHERE (list_contains(tokens, 'this') AND NOT contains(concat(' ', array_to_string(tokens, ' '), ' '), ' of the '))
               OR (contains(concat(' ', array_to_string(tokens, ' '), ' '), ' and the ') AND list_contains(tokens, 'from'))""",
    ),
    "q7_text_matches_mixed": (
        q7_text_matches_mixed,
        f"""SELECT doc_id FROM {_TOKENS} t
            WHERE (list_contains(tokens, 'this') AND NOT contains(concat(' ', array_to_string(tokens, ' '), ' '), ' of the '))
               OR (contains(concat(' ', array_to_string(tokens, ' '), ' '), ' and the ') AND list_contains(tokens, 'from'))""",
    ),
    "q8_postings": (
        q8_postings,
        f"""WITH words AS (SELECT doc_id, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS position FROM {_TOKENS} t),
            lexicon AS (SELECT token, count(DISTINCT doc_id) AS n_docs, count(*) AS n_words FROM words GROUP BY token)
            SELECT doc_id, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct, CAST(sum(length(token) * position) AS BIGINT) AS position_sum,
                   min(n_docs) AS rarest_docs, max(n_words) AS commonest_words
            FROM words JOIN lexicon USING (token) GROUP BY doc_id""",
    ),
    "q8_build_tokens": (
        q8_build_tokens,
        f"""SELECT doc_id, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct,
                   CAST(sum(length(token) * position) AS BIGINT) AS position_sum
            FROM (SELECT doc_id, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS position FROM {_TOKENS} t) x
            GROUP BY doc_id""",
    ),
    "q9_dialog_labels": (
        q9_dialog_labels,
        """SELECT org, party, dialog_id, c.revision, content_updated_at,
                  coalesce((SELECT string_agg(CAST(label_id AS VARCHAR), ',' ORDER BY label_id)
                            FROM context_label l WHERE l.context_id = c.id), '') AS labels
           FROM (SELECT *, row_number() OVER (PARTITION BY org, party ORDER BY content_updated_at DESC, id DESC) AS rn
                 FROM dialog) d
           JOIN context c ON c.dialog_id = d.id WHERE rn <= 1001""",
    ),
}

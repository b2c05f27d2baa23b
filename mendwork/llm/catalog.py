"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendwork.functions.durable import new_stage
from mendwork.llm import ann, chat, codes, codes_sql, extract, fingerprint, labelled_pages, language, lines, mixing, packing, planes, quality, ranked, simhash


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _held_out() -> Column:
    """Documents no model learns from: a quarter, by the CRC-32 of the id's text."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.where(~F.coalesce(_held_out(), F.lit(False))))
    named = language.identify(docs, model, "doc_id")
    return named.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = quality.classify(docs, labels, ~_held_out())
    return scored.select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))])).alias("t"),
        F.lit(said).alias("text"),
    ).select("conv_id", "t.turn", "t.role", "text")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text").union(planted)
    return chat.read_back(chat.format_conversations(chat.events_of(turns)))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.place(_table(spark, sf_dir, "documents"))
    first = F.round(F.get("positions", F.lit(0)), 9)
    return placed.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return fingerprint.compare_edited(docs, fingerprint.level_ranks(docs))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_repeated(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op9_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_stage(spark)
    planes.write_tokens(_table(spark, sf_dir, "documents"), folder)
    return planes.read_tokens(spark, folder, keep_ids=False)


# Invented labelled pages that the field of op11 learns from.
LABELLED_PAGES = 1200


def op11_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = extract.train(labelled_pages.labelled_pages(spark, LABELLED_PAGES))
    return extract.extract(_table(spark, sf_dir, "pages"), model, "page_id", "url").drop("n_blocks")


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes.compress(_table(spark, sf_dir, "embeddings"))
    rows = codes.with_label_error(coded.rows)
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.books_digest(coded.books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_multi_index": op1_multi_index,
    "op2_language": op2_language,
    "op3_quality": op3_quality,
    "op4_chat": op4_chat,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_mixing": op7_mixing,
    "op8_fingerprint": op8_fingerprint,
    "op9_token_planes": op9_token_planes,
    "op10_lines": op10_lines,
    "op11_extract": op11_extract,
    "op12_ranked": op12_ranked,
    "op13_codebooks": op13_codebooks,
}

# The control strings of the chat template, as a pattern that may hold backslashes after the first character.
_CONTROL = r"(<\\*(?:s>|/s>)|\[\\*(?:INST\]|/INST\]))"

ORACLE: dict[str, str] = {
    "op4_chat": rf"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(3 + length(role) + 7 + length(text) + 13
                        + len(regexp_extract_all(text, '{_CONTROL}')) + len(regexp_extract_all(role, '{_CONTROL}'))) AS BIGINT) AS formatted_chars
        FROM said GROUP BY conv_id
    """,
    "op7_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(CAST(doc_id AS VARCHAR)) AS key
            FROM documents
        ),
        sizes AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) AS weight_class FROM sized GROUP BY source
        ),
        trial AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER ratio, 0))::DOUBLE
                      / (sum(weight_class + 1) OVER () - coalesce(sum(weight_class + 1) OVER ratio, 0))::DOUBLE AS level
            FROM sizes
            WINDOW ratio AS (ORDER BY 3 * source_size / (weight_class + 1)::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ),
        targets AS (
            SELECT source, source_size, weight_class,
                   least(3.0::DOUBLE * source_size, coalesce(max(level) FILTER (level * (weight_class + 1) <= 3 * source_size) OVER () * (weight_class + 1), 3.0::DOUBLE * source_size)) AS target
            FROM trial
        ),
        stream AS (
            SELECT s.doc_id, s.size, t.source, t.source_size, t.weight_class, t.target,
                   coalesce(sum(s.size) OVER (PARTITION BY t.source ORDER BY s.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ),
        asked AS (
            SELECT *, CASE WHEN size = 0 THEN 0 ELSE (before + size / 2.0::DOUBLE < target)::INT + (source_size + before + size / 2.0::DOUBLE < target)::INT
                      + (2 * source_size + before + size / 2.0::DOUBLE < target)::INT END AS passes
            FROM stream
        ),
        lacking1 AS (SELECT *, target - sum(passes * size) OVER (PARTITION BY source) AS lack FROM asked),
        mends1 AS (
            SELECT source, arg_min(before, (abs(abs(lack) - size), before)) AS mended FROM lacking1
            WHERE size > 0 AND size < 2 * abs(lack) AND CASE WHEN lack > 0 THEN passes < 3 ELSE passes > 0 END GROUP BY source
        ),
        once AS (
            SELECT l.* EXCLUDE (lack), CASE WHEN m.mended = l.before AND l.size > 0 THEN CASE WHEN lack > 0 THEN 1 ELSE -1 END ELSE 0 END AS change
            FROM lacking1 l LEFT JOIN mends1 m ON l.source IS NOT DISTINCT FROM m.source
        ),
        lacking2 AS (SELECT *, target - sum((passes + change) * size) OVER (PARTITION BY source) AS lack FROM once),
        mends2 AS (
            SELECT source, arg_min(before, (abs(abs(lack) - size), before)) AS mended FROM lacking2
            WHERE size > 0 AND size < 2 * abs(lack) AND CASE WHEN lack > 0 THEN passes + change < 3 ELSE passes + change > 0 END GROUP BY source
        ),
        twice AS (
            SELECT l.*, CASE WHEN m.mended = l.before AND l.size > 0 THEN CASE WHEN lack > 0 THEN 1 ELSE -1 END ELSE 0 END AS change2
            FROM lacking2 l LEFT JOIN mends2 m ON l.source IS NOT DISTINCT FROM m.source
        ),
        timed AS (
            SELECT *, passes + change + change2 AS taken_passes,
                   CASE WHEN passes + change + change2 = 0 THEN NULL
                        WHEN passes + least(change, 0) + CASE WHEN change2 = -1 AND change <> 1 THEN -1 ELSE 0 END > 0 THEN (before + size / 2.0::DOUBLE) / target
                        ELSE 1.0::DOUBLE END AS share
            FROM twice
        )
        SELECT doc_id, size, source_size, target, CAST(taken_passes * size AS BIGINT) AS taken,
               round(CASE weight_class
                   WHEN 0 THEN 2 * share / (1.5::DOUBLE + sqrt(greatest(2.25::DOUBLE - 2 * share, 0)))
                   WHEN 1 THEN share
                   ELSE CASE WHEN share <= 0.375::DOUBLE THEN 2 * share / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2 * share))
                             ELSE 0.5::DOUBLE + 2 * (share - 0.375::DOUBLE) / (1.0::DOUBLE + sqrt(1.0::DOUBLE + 2 * (share - 0.375::DOUBLE))) END
               END, 9) AS first_position
        FROM timed
    """,
    "op10_lines": r"""
        WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
        placed AS (
            SELECT doc_id, lines, unnest(range(greatest(len(lines) - 3, 0) + 1)) AS pos FROM split WHERE lines IS NOT NULL
        ),
        windows AS (
            SELECT doc_id, pos, lines[pos + 1 : pos + 3] AS w FROM placed
            WHERE NOT regexp_matches(array_to_string(lines[pos + 1 : pos + 3], ''), '^\s*$')
        ),
        later AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS LAST, pos) AS k FROM windows),
        covered AS (SELECT DISTINCT doc_id, pos + j AS line FROM later, (VALUES (0), (1), (2)) AS t(j) WHERE k > 1),
        gone AS (SELECT c.doc_id, list(line) AS gone FROM covered c JOIN split s ON c.doc_id = s.doc_id WHERE line < len(s.lines) GROUP BY c.doc_id)
        SELECT s.doc_id, CAST(coalesce(len(s.lines), 0) AS INTEGER) AS n_lines, CAST(coalesce(len(g.gone), 0) AS INTEGER) AS n_removed,
               CASE WHEN g.gone IS NULL THEN s.text
                    ELSE array_to_string([s.lines[i + 1] FOR i IN range(len(s.lines)) IF NOT list_contains(g.gone, i)], chr(10)) END AS text
        FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id
    """,
    # The given pages keep their article in one element of that name; the field does not know this.
    "op11_extract": r"""
        WITH parts AS (
            SELECT page_id, unnest(string_split_regex(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)>')) AS part,
                   generate_subscripts(string_split_regex(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)>'), 1) AS place
            FROM pages
        ),
        plain AS (SELECT page_id, place, regexp_replace(regexp_replace(regexp_replace(part, '<[^>]*>', ' ', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS part FROM parts),
        lines AS (SELECT page_id, place, trim(regexp_replace(part, '\s+', ' ', 'g')) AS line FROM plain),
        joined AS (SELECT page_id, string_agg(line, chr(10) ORDER BY place) AS text FROM lines WHERE line <> '' GROUP BY page_id)
        SELECT p.page_id, p.url, coalesce(j.text, '') AS text, CAST(length(coalesce(j.text, '')) AS BIGINT) AS n_chars
        FROM pages p LEFT JOIN joined j ON p.page_id = j.page_id
    """,
    "op12_ranked": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents WHERE text IS NOT NULL
        ),
        sizes AS (SELECT r, doc_id, len(w) AS n FROM docs WHERE len(w) > 0),
        whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
        asked AS (
            SELECT item_id, term, count(*) AS repeats FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
            ) GROUP BY item_id, term
        ),
        listed AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
        weights AS (
            SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * df + 1)::DOUBLE))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM listed GROUP BY term), whole
        ),
        scored AS (
            SELECT a.item_id, s.doc_id, l.r, sum(a.repeats * w.w * ((1000000000 * l.tf) // (1000 * l.tf + 8 * (25 + (75 * s.n * o.n_docs) // o.n_terms))))::BIGINT AS score
            FROM listed l JOIN asked a ON l.term = a.term JOIN weights w ON l.term = w.term JOIN sizes s ON l.r = s.r CROSS JOIN whole o
            GROUP BY a.item_id, s.doc_id, l.r
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
    """,
}

# The vectors of ``embeddings`` have 64 components.
ORACLE["op13_codebooks"] = codes_sql.statement(64 // codes.PARTS)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

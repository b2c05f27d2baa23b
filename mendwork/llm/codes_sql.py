"""The rounds of vector code compression as one SQL statement, for the check of ``op13_codebooks``."""

from __future__ import annotations

from mendwork.llm.codes import ENTRIES, PARTS, ROUNDS, SCALE


def _assigned(books: str) -> str:
    return f"""
        SELECT p.vec_id, p.part, arg_min(b.entry, (p.sq - 2 * list_inner_product(p.v, b.v) + b.sq, b.entry)) AS entry,
               min(p.sq - 2 * list_inner_product(p.v, b.v) + b.sq) AS d2
        FROM parts p JOIN {books} b ON p.part = b.part GROUP BY p.vec_id, p.part"""


def _moved(books: str, assigned: str) -> str:
    return f"""
        SELECT b.part, b.entry, coalesce(m.v, b.v) AS v, list_inner_product(coalesce(m.v, b.v), coalesce(m.v, b.v)) AS sq
        FROM {books} b LEFT JOIN (
            SELECT part, entry, list(floor(s / n) ORDER BY place) AS v
            FROM (SELECT part, entry, place, sum(x) AS s, count(*)::DOUBLE AS n
                  FROM (SELECT p.part, a.entry, unnest(range({{width}})) AS place, unnest(p.v) AS x FROM parts p JOIN {assigned} a ON p.vec_id = a.vec_id AND p.part = a.part)
                  GROUP BY part, entry, place)
            GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry"""


def statement(width: int) -> str:
    """The SQL for vectors of ``PARTS * width`` components whose ids are unique and not null."""
    steps = [
        f"""kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS (
            SELECT vec_id, part, v[part * {width} + 1 : (part + 1) * {width}] AS v,
                   list_inner_product(v[part * {width} + 1 : (part + 1) * {width}], v[part * {width} + 1 : (part + 1) * {width}]) AS sq
            FROM kept, (SELECT unnest(range({PARTS})) AS part))""",
        f"""books0 AS (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v, sq FROM parts
            QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {ENTRIES})""",
    ]
    for r in range(ROUNDS):
        steps.append(f"near{r} AS MATERIALIZED ({_assigned(f'books{r}')})")
        steps.append(f"books{r + 1} AS MATERIALIZED ({_moved(f'books{r}', f'near{r}').format(width=width)})")
    steps.append(f"near{ROUNDS} AS MATERIALIZED ({_assigned(f'books{ROUNDS}')})")
    steps.append(
        f"coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d2) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id)"
    )
    steps.append(
        f"""digest AS (
            SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: CAST(x AS BIGINT)::VARCHAR), ','), ',' ORDER BY part, entry)) AS digest
            FROM books{ROUNDS})"""
    )
    return f"""WITH {", ".join(steps)}
        SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, d.digest AS codebooks_sha256
        FROM coded c JOIN kept k ON c.vec_id = k.vec_id CROSS JOIN digest d"""

"""Run catalog entries against DuckDB: ``python -m tests.check_entries <sf_dir> [name prefix ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from mendwork.catalog.views import BASE_TABLES

_SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    return "" if x is None else str(x)


def _rows(rows, order):
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a query; empty when equal."""
    start = time.perf_counter()
    rel = con.sql(sql)
    other_rows = rel.fetchall()
    compare.duck_seconds = time.perf_counter() - start
    names, types = rel.columns, [str(t) for t in rel.types]
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    by_name = dict(zip(names, types))
    for c, t in df.dtypes:
        if _SAME.get(t, t) != by_name[c]:
            problems.append(f"type {c}: {t} != {by_name[c]}")
    cols = sorted(names)
    mine = _rows(df.collect(), [df.columns.index(c) for c in cols])
    other = _rows(other_rows, [names.index(c) for c in cols])
    if len(mine) != len(other):
        problems.append(f"rows {len(mine)} != {len(other)}")
    if mine != other:
        only_a = [r for r in mine if r not in set(other)][:3]
        only_b = [r for r in other if r not in set(mine)][:3]
        problems.append(f"values over {cols}: {only_a} | {only_b}")
    if not mine:
        problems.append("no rows at all")
    return problems


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from mendwork.session import local_session

    sf_dir, prefixes = argv[0], argv[1:]
    spark = local_session("check", 8)
    con = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.perf_counter()
        try:
            df = fn(spark, sf_dir)
            problems = compare(df, con, oracle[name]) if name in oracle else ([] if df.collect() else ["no rows"])
        except Exception as exc:  # noqa: BLE001
            problems = [f"{type(exc).__name__}: {str(exc)[:1500]}"]
        bad += bool(problems)
        kind = "D" if name in oracle else "R"
        print(f"{'BAD' if problems else 'ok '} {kind} {name} {time.perf_counter() - start:.2f}s (check {getattr(compare, 'duck_seconds', 0):.2f}s)", *problems, sep="\n      " if problems else " ", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

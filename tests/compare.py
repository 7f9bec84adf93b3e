"""Run registered queries against their SQL: `python tests/compare.py [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return db


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "as_tuple"):  # decimals
        return float(value)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, db, sql: str) -> str:
    """'' when both sides hold the same rows, else what differs."""
    names, mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    found = db.execute(sql)
    want_names, want = _sorted_rows([c[0] for c in found.description], found.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(mine) != len(want):
        return f"{len(mine)} rows, expected {len(want)}"
    wrong = [(a, b) for a, b in zip(mine, want) if a != b]
    if wrong:
        parts = [(n, x, y) for n, x, y in zip(names, *wrong[0]) if x != y]
        return f"{len(wrong)} of {len(mine)} rows differ, first: {parts}"
    return "" if mine else "no rows"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from pulsegrid.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark, db = local_session(cores="8"), oracle(sf_dir)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            result = compare(df, db, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            result = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        bad += bool(result) and not result.startswith("rows only")
        print(f"{name:28s} {time.time() - start:6.2f}s  {result or 'ok'}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()

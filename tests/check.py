"""Compare every query with its SQL: ``python tests/check.py <sf> [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    connection = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, connection, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    left_names, left = rows_of(df.columns, df.collect())
    result = connection.execute(sql)
    right_names, right = rows_of([d[0] for d in result.description], result.fetchall())
    if left_names != right_names:
        return f"columns {left_names} vs {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}"
    return None


def main():
    from __spark_entry__ import oracle_sql, queries
    from kerbline.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    chosen = sys.argv[2:]
    spark, connection = local_session(), duck(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        if not chosen and name not in oracles:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, connection, name, query, oracles[name], sf_dir)
            else:
                df = query(spark, sf_dir)
                df.show(8, False)
                problem = None
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()

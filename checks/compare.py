"""Run registered queries against their oracles: python -m checks.compare [sf_dir] [query ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from checks.oracles import oracle_sql
from checks.registry import queries
from touchline.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    return repr(value) if isinstance(value, float) else str(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def mismatch(spark, con, name: str, sf_dir: str) -> str | None:
    """None if the query and its oracle agree on columns and rows, else what differs."""
    got = queries()[name](spark, sf_dir)
    columns = got.columns
    rows = _rows(columns, got.collect())
    result = con.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} / {sorted(names)}"
    if len(rows) != len(want):
        return f"{len(rows)} rows / {len(want)}"
    for mine, theirs in zip(rows, want):
        if mine != theirs:
            return f"{mine} / {theirs}"
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = open_oracle(sf_dir)
    bad = 0
    for name in names or queries():
        start = time.time()
        try:
            problem = mismatch(spark, con, name, sf_dir)
        except Exception as error:  # a failing query is a finding, not the end of the run
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    missing = set(queries()) ^ set(oracle_sql())
    print(f"{bad} mismatches; without a partner: {sorted(missing)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)

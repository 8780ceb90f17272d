"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402

TESTDATA = "/root/testdata"


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, int]:
    """('match' | 'rows only' | a difference, row count)."""
    df = contract.queries()[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return "rows only", got.total()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", got.total()
    want = _rows(names, result.fetchall())
    if got != want:
        return f"spark {list((got - want).items())[:3]} sql {list((want - got).items())[:3]}", \
            got.total()
    kinds = {d[0]: str(d[1]) for d in result.description}
    return "match", got.total(), {n: (t, kinds[n]) for n, t in df.dtypes}


if __name__ == "__main__":
    from conftest import new_session

    sf = f"{TESTDATA}/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    only = sys.argv[2:]
    session, db = new_session(), database(sf)
    bad = 0
    for key in only or contract.queries():
        start = time.time()
        outcome = compare(session, db, sf, key)
        bad += outcome[0] not in ("match", "rows only")
        print(f"{key:32s} {outcome[1]:8d} {time.time() - start:6.2f}s {outcome[0]}", flush=True)
    print("differences:", bad)

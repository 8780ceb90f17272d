"""Small conveniences shared by the tests."""

from __future__ import annotations

from collections import Counter


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return Counter(tuple(r) for r in picked.collect())


def bag(*tuples):
    return Counter(tuples)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

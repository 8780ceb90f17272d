"""Row filters and fitting rows to a declared contract."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import Columns, RangeRule, build_schema

# The change kinds that carry a row's new content.
CURRENT_CHANGES = ("insert", "update_postimage")


def range_condition(rules: Iterable[RangeRule], present: Sequence[str]) -> Column | None:
    """All bounds of all rules on present columns, or None when none applies."""
    bounds = []
    for rule in rules:
        if rule.column not in present:
            continue
        if rule.min is not None:
            bounds.append(F.col(rule.column) >= rule.min)
        if rule.max is not None:
            bounds.append(F.col(rule.column) <= rule.max)
    return reduce(lambda a, b: a & b, bounds) if bounds else None


def range_filter(df: DataFrame, rules: Iterable[RangeRule]) -> DataFrame:
    """Keep rows inside every inclusive range; a null reading is dropped.

    Plain comparisons, so they reach the parquet scan as pushed filters. A rule on a column ``df``
    does not have is skipped.
    """
    condition = range_condition(rules, df.columns)
    return df if condition is None else df.filter(condition)


def change_type_filter(df: DataFrame, kinds: Sequence[str] = CURRENT_CHANGES) -> DataFrame:
    """Keep change-feed rows that carry new content; other kinds are dropped."""
    return df.filter(F.col("_change_type").isin(*kinds))


def conform_columns(df: DataFrame, columns: Columns) -> DataFrame:
    """Declared columns that exist, in declared order; the rest are dropped."""
    return df.select(*[F.col(f"`{name}`") for name, _ in columns if name in df.columns])


def unconverted(df: DataFrame, columns: Columns, keys: Sequence[str] = ()) -> dict[str, Column]:
    """Per declared column whose type differs from the data's: how many values would not survive the cast.

    A value that becomes null counts. Of a key column with a numeric type every value counts that does
    not come back unchanged, since such a cast can make two keys one.
    """
    counts = {}
    for f in build_schema(columns).fields:
        if f.name not in df.columns or df.schema[f.name].dataType == f.dataType:
            continue
        was, now = F.col(f"`{f.name}`"), F.col(f"`{f.name}`").try_cast(f.dataType)
        lost = now.isNull()
        if f.name in keys and isinstance(f.dataType, T.NumericType):
            lost = lost | ~now.try_cast(df.schema[f.name].dataType).eqNullSafe(was)
        counts[f.name] = F.count(F.when(was.isNotNull() & lost, True))
    return counts


def conform_to_contract(df: DataFrame, columns: Columns, keep_extra: bool = False) -> DataFrame:
    """Exactly the declared columns, types and order.

    Values that do not convert become null, as do absent columns. ``keep_extra`` appends the
    undeclared columns instead of dropping them.
    """
    schema = build_schema(columns)
    fitted = [
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    extra = [F.col(f"`{c}`") for c in df.columns if keep_extra and c not in schema.names]
    return df.select(*fitted, *extra)

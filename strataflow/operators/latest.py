"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str | None = None) -> DataFrame:
    """Keep one row per key: the greatest by ``order_col``, nulls last.

    Ties are broken by all remaining columns, so the result depends on the data only, not on how it
    was partitioned. Without ``order_col`` the remaining columns alone decide.

    The ``row_number() = 1`` form matters: Spark plans it with a partial limit that leaves one row
    per key and map task before the shuffle, so a key holding a third of all rows costs the reducer
    one row per map task, not a third of the table.
    """
    rest = [c for c in df.columns if c not in keys and c != order_col]
    order = ([order_col] if order_col else []) + rest
    if not order:
        return df.distinct()
    quoted = [F.col(f"`{c}`") for c in keys]
    w = Window.partitionBy(*quoted).orderBy(*[F.col(f"`{c}`").desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")

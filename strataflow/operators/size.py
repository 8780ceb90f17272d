"""Proof that a DataFrame is small enough to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 1_000_000
MAX_BYTES = 64 * 1024 * 1024

_VARIABLE = (T.StringType, T.BinaryType)


def fits_broadcast(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Measure ``df`` exactly; true only when it is within both bounds.

    The count comes first because it needs no columns, so over parquet it reads footers only. The
    byte measure runs only on data already known to be short. Nested columns have no cheap measure
    and are refused.
    """
    fields = df.schema.fields
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in fields):
        return False
    if df.count() > max_rows:
        return False
    width = F.lit(16 * len(fields)).cast("long")
    for f in fields:
        if isinstance(f.dataType, _VARIABLE):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    measured = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return measured["bytes"] <= max_bytes


def broadcast_if_small(df: DataFrame, **bounds) -> DataFrame:
    """Mark ``df`` for broadcast when measured small; otherwise leave the join to Spark."""
    return F.broadcast(df) if fits_broadcast(df, **bounds) else df

"""Shards that each match the mixture: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import fresh, ranked


def shard_rows(
    docs: DataFrame, shards: int, text: str = "text", id_col: str = "doc_id", source: str = "source", seed: int = 8
) -> DataFrame:
    """Add ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 within a shard) to every row.

    Rows are shuffled within their source by a seeded hash; row r of a source with n rows stands at
    (r + u) / n, where u is the source's own seeded offset in [0, 1). Sorting all rows by that place
    interleaves the sources in proportion, and equal cuts of the order give shards whose row counts
    differ by one at most and whose share of every source differs from the mixture's by less than
    two rows. The offset keeps the many sources with one row from sharing one place.

    No task ever holds a source: rows are numbered by ranges of the hash, then by ranges of the place
    (see ``ranked``). Defined cases: a null source is a source like any other; null or empty texts
    and null ids are rows like any other; repeated rows each get a slot of their own (which of them
    gets which slot makes no difference); an empty table gives no rows; the caller's columns come
    back unchanged, except that a ``shard`` or ``slot`` of the input is replaced.
    """
    docs = docs.drop("shard", "slot")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    total = docs.count()
    spread, key, copies, spot = fresh("spread"), fresh("source"), fresh("copies"), fresh("spot")
    own = F.col(f"`{source}`")
    sizes = docs.groupBy(own.alias(key)).agg(F.count(F.lit(1)).alias(copies))
    rows = docs.withColumn(spread, F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text}`")))
    rows, rank, _ = ranked(rows, [own], F.col(spread), total)
    rows = rows.join(sizes, own.eqNullSafe(F.col(key)))
    # The place in 2^-32 steps, an exact integer, so that a rerun sorts alike; the row's hash breaks ties.
    offset = (F.shiftright(F.xxhash64(F.lit(seed + 1), own), 32) + F.lit(1 << 31)) / F.lit(float(1 << 32))
    place = F.least(((F.col(rank) + offset) / F.col(copies) * F.lit(float(1 << 32))).cast("long"), F.lit((1 << 32) - 1))
    low = F.col(spread).bitwiseAND(F.lit((1 << 32) - 1))
    rows = rows.withColumn(spot, F.shiftleft(place - F.lit(1 << 31), 32).bitwiseOR(low))
    rows, position, _ = ranked(rows, [], F.col(spot), total)
    return rows.select(
        *columns,
        F.expr(f"cast((`{position}` * {shards}L) div {max(total, 1)}L as int)").alias("shard"),
        F.col(position).alias("slot"),
    ).withColumn("slot", F.expr(f"slot - (shard * {total}L + {shards - 1}L) div {shards}L"))

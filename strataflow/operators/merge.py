"""Keyed refreshes of a refined table.

Every function is pure: it takes the current table and a feed and returns a DataFrame, so the same
code serves a batch job, a ``foreachBatch`` call and a rebuild. Keys are compared with plain
equality: a row with a null in its key never matches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .latest import latest_per_key

CREATED = "_silver_created_at"

# (value of a feed column, value of a table column) -> condition
Guard = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [_q(k).isNull() for k in keys])


def _tagged(df: DataFrame, tag: str) -> DataFrame:
    return df.select(*[_q(c).alias(f"{tag}__{c}") for c in df.columns], F.lit(True).alias(tag))


def _observed(df: DataFrame, applied: Observation | None, count: Column) -> DataFrame:
    return df if applied is None else df.observe(applied, count.alias("rows"))


def _first_load(
    staged: DataFrame, insert_if: Column | None = None, applied: Observation | None = None, **_
) -> DataFrame:
    fresh = staged if insert_if is None else staged.filter(insert_if)
    return _observed(fresh, applied, F.count(F.lit(1)))


def upsert(
    state: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    update_if: Guard | None = None,
    insert_if: Column | None = None,
    keep: Sequence[str] = (CREATED,),
    small_feed: bool = False,
    applied: Observation | None = None,
) -> DataFrame:
    """Merge ``staged`` (at most one row per key) into ``state`` and return the whole new state.

    Matched rows are replaced when ``update_if`` holds (null counts as false), except for the
    ``keep`` columns. Unmatched staged rows are inserted when ``insert_if`` holds. Unmatched state
    rows stay. Columns only the feed has are added; columns it lacks keep their value, or are null
    in inserted rows.

    The default plan is one full outer join of the rows with a whole key; it reuses the partitioning ``latest_per_key`` already
    made, so only ``state`` is exchanged. A ``state`` stored distributed by key is not exchanged
    when the reduced feed is read from a table, which leaves its distribution open.

    ``small_feed`` (pass it only after ``size.fits_broadcast(staged)``) broadcasts the feed instead
    and never shuffles ``state``.

    ``applied`` observes the number of inserted and replaced rows as ``rows`` without another scan.
    """

    def src(c):
        return _q(f"src__{c}")

    def tgt(c):
        return _q(f"tgt__{c}")

    insertable = F.lit(True) if insert_if is None else F.coalesce(insert_if, F.lit(False))
    updatable = F.lit(True) if update_if is None else F.coalesce(update_if(src, tgt), F.lit(False))
    in_src, in_tgt = F.col("src").isNotNull(), F.col("tgt").isNotNull()
    replaced = in_src & in_tgt & updatable
    take = in_src & (~in_tgt | updatable)
    on = reduce(lambda a, b: a & b, [tgt(k) == src(k) for k in keys])
    out = [*state.columns, *[c for c in staged.columns if c not in state.columns]]

    def value(c):
        if c not in staged.columns:
            return tgt(c).alias(c)
        if c not in state.columns:
            return F.when(take, src(c)).alias(c)
        if c in keep:
            return F.when(in_tgt, tgt(c)).otherwise(src(c)).alias(c)
        return F.when(take, src(c)).otherwise(tgt(c)).alias(c)

    held = _tagged(state, "tgt")
    if small_feed:
        fed = F.broadcast(_tagged(staged, "src"))
        kept = held.join(fed, on, "left_outer").select(
            *[value(c) for c in out], replaced.alias("_applied")
        )
        names = [_q(k) for k in keys]
        # At most one row per staged row, so this side is bounded by the measured feed.
        present = (
            state.select(*names)
            .join(F.broadcast(staged.select(*names)), list(keys), "left_semi")
            .distinct()
        )
        fresh = staged.filter(insertable).join(F.broadcast(present), list(keys), "left_anti")
        fresh = fresh.withColumn("_applied", F.lit(True))
        merged = kept.unionByName(fresh, allowMissingColumns=True)
    else:
        # Rows with a null in their key match nothing. In the join all of them would meet in one task,
        # so they pass it by; beyond them the join has one row per key on either side, so no key is hot.
        loose = _any_null(keys)
        held = _tagged(state.filter(~loose), "tgt")
        fed = _tagged(staged.filter(~loose).withColumn("_insert", insertable), "src")
        joined = held.join(fed, on, "full_outer").filter(in_tgt | src("_insert"))
        merged = joined.select(*[value(c) for c in out], take.alias("_applied"))
        for rows, fresh in ((state.filter(loose), False), (staged.filter(loose).filter(insertable), True)):
            merged = merged.unionByName(rows.withColumn("_applied", F.lit(fresh)), allowMissingColumns=True)
    merged = _observed(merged, applied, F.count_if("_applied"))
    return merged.select(*[_q(c) for c in out])


def full_merge(
    state: DataFrame | None,
    feed: DataFrame,
    keys: Sequence[str],
    order_col: str,
    reduced: bool = False,
    **options,
) -> DataFrame:
    """Latest feed row per key replaces the stored one unless the stored one is newer.

    ``reduced`` (here and below): the feed already has at most one row per key. Further options are
    those of ``upsert``.
    """
    staged = feed if reduced else latest_per_key(feed, keys, order_col)
    if state is None:
        return _first_load(staged, **options)
    newer = lambda src, tgt: src(order_col) >= tgt(order_col)
    return upsert(state, staged, keys, update_if=newer, **options)


def incremental_replace(
    state: DataFrame | None,
    feed: DataFrame,
    keys: Sequence[str],
    order_col: str,
    guard: bool = False,
    reduced: bool = False,
    **options,
) -> DataFrame:
    """Latest feed row per key always replaces the stored one, even a newer one.

    ``guard=True`` keeps a stored row that is newer than the feed.
    """
    if guard:
        return full_merge(state, feed, keys, order_col, reduced, **options)
    staged = feed if reduced else latest_per_key(feed, keys, order_col)
    if state is None:
        return _first_load(staged, **options)
    return upsert(state, staged, keys, **options)


def cdc_merge(
    state: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    sequence_col: str = "sequence_num",
    op_col: str = "op_type",
    delete_col: str | None = None,
    reduced: bool = False,
    **options,
) -> DataFrame:
    """Apply I/U/D change events; a delete stays as a row carrying its own payload (soft delete).

    Only the last event per key counts. It replaces the stored row unless that has a higher
    sequence. A delete, or an event without an operation, never inserts. With ``delete_col`` that
    flag is derived from the operation instead of being taken from the payload.
    """
    staged = changes if reduced else latest_per_key(changes, keys, sequence_col)
    if delete_col:
        staged = staged.withColumn(delete_col, F.coalesce(_q(op_col) == "D", F.lit(False)))
    is_insert = _q(op_col) != "D"
    if state is None:
        return _first_load(staged, insert_if=is_insert, **options)
    in_order = lambda src, tgt: src(sequence_col) >= tgt(sequence_col)
    return upsert(state, staged, keys, update_if=in_order, insert_if=is_insert, **options)


def contested_keys(
    table: DataFrame | None, feed: DataFrame, keys: Sequence[str], small_feed: bool = False
) -> DataFrame:
    """Feed keys that are already in ``table`` or occur more than once in the feed.

    Reads key columns only and counts them map-side first, so neither wide rows nor a key with very
    many copies travel. ``small_feed`` (after ``size.fits_broadcast`` of its keys) broadcasts the
    feed's keys, so the table's are not shuffled either.
    """
    names = [_q(k) for k in keys]
    fed = feed.select(*names).filter(~_any_null(keys))
    counted = fed.groupBy(*names).agg(F.count(F.lit(1)).alias("_fed"))
    if table is None:
        return counted.filter("_fed > 1").select(*names)
    held = table.select(*names)
    if small_feed:
        clashing = held.join(F.broadcast(counted), list(keys), "left_semi").distinct()
        return clashing.union(counted.filter("_fed > 1").select(*names)).distinct()
    known = held.filter(~_any_null(keys)).withColumns({"_fed": F.lit(0), "_held": F.lit(1)})
    marks = counted.withColumn("_held", F.lit(0)).unionByName(known)
    both = marks.groupBy(*names).agg(F.sum("_fed").alias("_fed"), F.max("_held").alias("_held"))
    return both.filter("_fed > 1 OR (_fed = 1 AND _held = 1)").select(*names)


#: Partition values listed one by one in a predicate on a table; beyond them their range is used.
MAX_LISTED = 500
_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.StringType)


def near_feed(
    table: DataFrame, feed: DataFrame, keys: Sequence[str], partition_cols: Sequence[str] = ()
) -> DataFrame:
    """The part of ``table`` that can hold a key of ``feed``, as plain predicates that reach its scan.

    The range of every key column prunes row groups. A partition column that is a key prunes folders: by
    its values if the feed has no more than ``MAX_LISTED``, else by its range. One aggregation of the
    feed's key columns finds both; one row, and at most that many values per column, reach the driver.
    Rows with a null in their key match nothing and are left out.
    """
    known = [k for k in keys if isinstance(feed.schema[k].dataType, _ORDERED) and k in table.columns]
    fed = feed.filter(~_any_null(keys))
    listed = [k for k in known if k in partition_cols]
    bounds = [f(_q(k)).alias(f"{tag}{i}") for i, k in enumerate(known) for tag, f in (("lo", F.min), ("hi", F.max))]
    found = fed.agg(F.count(F.lit(1)).alias("rows"), *bounds).first()
    if not found["rows"]:
        return table.limit(0)
    near = table
    for i, k in enumerate(known):
        values = None
        if k in listed:
            some = fed.select(_q(k)).distinct().limit(MAX_LISTED + 1).collect()
            values = [r[0] for r in some] if len(some) <= MAX_LISTED else None
        kind = feed.schema[k].dataType
        literal = lambda v, kind=kind: F.lit(v).cast(kind)
        if values is not None:
            near = near.filter(_q(k).isin([literal(v) for v in values]))
        else:
            near = near.filter(_q(k).between(literal(found[f"lo{i}"]), literal(found[f"hi{i}"])))
    return near


def distinct_keys(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; rows with a null in the key are not alike and all stay."""
    keyed = latest_per_key(feed.filter(~_any_null(keys)), keys)
    return keyed.unionByName(feed.filter(_any_null(keys)))


def insert_if_absent(
    table: DataFrame | None,
    feed: DataFrame,
    keys: Sequence[str],
    within_feed: str = "distinct",
    contested: DataFrame | None = None,
) -> DataFrame:
    """The feed rows to append: those whose key ``table`` does not hold.

    ``within_feed="distinct"`` also keeps one row per key within the feed; ``"keep"`` appends all
    its copies; ``"reduced"`` says that ``distinct_keys`` has been applied. A ``table`` stored
    distributed by key is not shuffled when the reduced feed is read from a table.

    Rows with a null in the key match nothing and are all appended; they skip the join, where they
    would meet in one partition.

    ``contested`` (from ``contested_keys``, measured with ``size.fits_broadcast``) selects a plan
    for wide rows: all uncontested rows pass straight through and only contested ones are shuffled.
    """
    names = list(keys)
    loose = feed.filter(_any_null(keys))
    keyed = feed.filter(~_any_null(keys))
    clear = None
    if contested is not None:
        clear = keyed.join(F.broadcast(contested), names, "left_anti")
        keyed = keyed.join(F.broadcast(contested), names, "left_semi")
    if within_feed == "distinct":
        keyed = latest_per_key(keyed.select(*[_q(c) for c in feed.columns]), keys)
    if table is not None:
        held = table.select(*[_q(k) for k in keys])
        if within_feed != "keep":
            # A key the table holds very often crosses the wire once per map task.
            held = held.distinct()
        # With "keep" a key may be frequent in the feed: both sides of the join are then plain
        # exchanges, which is what lets AQE split the partition that key falls into.
        keyed = keyed.join(held, names, "left_anti")
    parts = [p for p in (clear, keyed, loose) if p is not None]
    return reduce(DataFrame.unionByName, parts).select(*[_q(c) for c in feed.columns])


def cdc_history(
    history: DataFrame | None, changes: DataFrame, keys: Sequence[str], **options
) -> DataFrame:
    """``history`` plus every change event whose key it lacks; nothing is ever updated."""
    fresh = insert_if_absent(history, changes, keys, **options)
    return fresh if history is None else history.unionByName(fresh, allowMissingColumns=True)


def append_dedup(
    table: DataFrame | None, feed: DataFrame, keys: Sequence[str], **options
) -> DataFrame:
    """``table`` plus the feed rows whose key it lacks, e.g. files by source path."""
    return cdc_history(table, feed, keys, **options)

"""Watermarked, deduplicated, range-filtered append of an event stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.enrich import parse_event_time
from ..functions.quality import conform_columns, range_filter
from ..operators.merge import insert_if_absent, near_feed
from ..sources.tables import commit_numbers, read_commits
from ..spec import SilverSpec, build_schema


def with_watermark(
    stream: DataFrame, column: str = "event_ts", delay: str = "10 minutes"
) -> DataFrame:
    """Accept rows up to ``delay`` behind the newest event time.

    Text and zone-less times are turned into instants first.
    """
    return parse_event_time(stream, column).withWatermark(column, delay)


def stream_dedup(
    stream: DataFrame, keys: Sequence[str], bounded: bool = False, spread: bool = False
) -> DataFrame:
    """First row per key over the life of the stream; rows behind the watermark are dropped.

    The default remembers every key for ever. ``bounded`` forgets a key once the watermark has
    passed it, so a later copy is admitted again.

    A streaming deduplication sends all copies of a key to one task. ``spread`` first removes copies
    per input split, with state that expires with the watermark, so a key with very many copies is
    thinned in parallel before its copies meet. It costs a second exchange and a second state, so it
    is left out unless asked for. The split number only routes rows; it never changes which keys
    survive.
    """
    if spread:
        stream = (
            stream.withColumn("_split", F.spark_partition_id())
            .dropDuplicatesWithinWatermark([*keys, "_split"])
            .drop("_split")
        )
    if bounded:
        return stream.dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def streaming_append(
    stream: DataFrame,
    spec: SilverSpec,
    now: Column | None = None,
    bounded: bool | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """Range rules, event time, creation stamp, watermark, declared columns, deduplication.

    Filters come first so they reach the scan, and the projection precedes the deduplication so
    that only declared columns enter the state store. ``bounded`` and ``spread`` are the spec's
    unless given. Of a ``stateless`` spec the rows are not deduplicated here: ``absent_rows`` does it.
    """
    bounded = spec.bounded if bounded is None else bounded
    spread = spec.spread if spread is None else spread
    event_time = spec.order_col or "event_ts"
    now = F.current_timestamp() if now is None else now
    rows = range_filter(stream, spec.rules).withColumn("_silver_created_at", now)
    if spec.stateless:
        return conform_columns(parse_event_time(rows, event_time), spec.columns)
    rows = with_watermark(rows, event_time, spec.delay)
    return stream_dedup(conform_columns(rows, spec.columns), spec.keys, bounded, spread)


def absent_rows(spec: SilverSpec, path: str, staged: str) -> Callable[[DataFrame, int], DataFrame]:
    """The deduplication of a ``stateless`` spec, as ``prepare`` of ``sinks.tables.append_stream``.

    A micro-batch is written to a folder below ``staged``, so that its source is read once, cut to one
    row per key, and joined with the keys that earlier commits of the table at ``path`` hold. Of these
    only the partitions and row groups are read that the batch's keys can be in (``near_feed``), so a
    batch costs what it touches and no state grows. A replayed batch does not see its own commit.

    Against the deduplication with state: no row is ever too late, and rows with a null in their key
    are all kept. Of several copies of a key the first by all columns stays.
    """
    schema = build_schema(spec.columns)

    def prepare(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{staged}/{batch_id}")
        rows = spark.read.schema(batch.schema).parquet(f"{staged}/{batch_id}")
        held = None
        if any(n < batch_id for n in commit_numbers(spark, path)):
            held = read_commits(spark, path, schema, None, batch_id - 1)
            held = near_feed(held, rows, spec.keys, spec.partition_cols)
        return insert_if_absent(held, rows, spec.keys)

    return prepare

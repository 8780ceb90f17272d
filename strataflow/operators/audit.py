"""Counts: per table, per commit, per stream run."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.quality import range_condition
from ..session import scratch_dir
from ..spec import RangeRule
from .size import broadcast_if_small

log = logging.getLogger(__name__)


def row_counts(
    spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]
) -> DataFrame:
    """``(table, rows)`` for each named reader, in one job; a missing table has null rows.

    Counting needs no columns, so only parquet footers are read.
    """

    def count(name: str, read: Callable[[], DataFrame]) -> DataFrame:
        try:
            counted = read().agg(F.count(F.lit(1)).alias("rows"))
        except (AnalysisException, LookupError) as error:
            log.warning("%s cannot be read: %s", name, error)
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        return counted.select(F.lit(name).alias("table"), "rows")

    return reduce(DataFrame.unionByName, [count(n, read) for n, read in tables.items()])


def table_row_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``row_counts`` of parquet paths."""
    return row_counts(spark, {n: partial(spark.read.parquet, path) for n, path in tables.items()})


def _newest_before(commits: DataFrame, lag: int, span: int = 10_000) -> DataFrame:
    """Per commit the newest ``_newest`` of all commits up to ``lag`` places before it; null at first.

    Commits are numbered and their maxima carried on within spans of commit numbers, then from span to
    span, so one task sees at most one row per span.
    """
    spans = commits.withColumn("_span", F.floor(F.col("_batch_id") / F.lit(span)))
    inside = Window.partitionBy("_span").orderBy("_batch_id")
    rows = spans.withColumns({"_place": F.row_number().over(inside), "_newest": F.max("_newest").over(inside)})
    earlier = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = spans.groupBy("_span").agg(F.count(F.lit(1)).alias("_n"), F.max("_newest").alias("_max")).select(
        "_span", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"), F.max("_max").over(earlier).alias("_max"))
    placed = rows.join(before, "_span").select(
        "_batch_id", (F.col("_n") + F.col("_place")).alias("_place"), F.greatest("_newest", "_max").alias("_newest"))
    reached = placed.select((F.col("_place") + lag).alias("_place"), "_newest")
    return placed.drop("_newest").join(reached, "_place", "left").drop("_place")


def batch_audit(
    df: DataFrame,
    keys: Sequence[str],
    rules: Iterable[RangeRule] = (),
    event_col: str | None = None,
    delay: str = "10 minutes",
    lag: int = 2,
) -> DataFrame:
    """What a range-filtered, watermarked, deduplicated append makes of each ``_batch_id``.

    One row per commit: rows read; rejected by the range rules; late, when ``event_col`` is given;
    duplicates of a key accepted before; and rows written. Rows are late against the newest accepted
    event time ``lag`` commits back: 2 for the batches of one stream run, 1 when every commit is
    drained by a run of its own (which ends by advancing the watermark).

    Duplicates are counted from the first commit of each key, a plain aggregation that combines
    map-side; no window ever gathers the copies of a key.
    """
    passes = range_condition(rules, df.columns)
    passes = F.lit(True) if passes is None else F.coalesce(passes, F.lit(False))
    rows = df.withColumn("_passes", passes)
    per_batch = rows.groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~F.col("_passes")).alias("rows_rejected"),
        F.max(F.when(F.col("_passes"), F.col(event_col or "_batch_id"))).alias("_newest"),
    )
    accepted = rows.filter("_passes")
    if event_col:
        # One row per commit, needed in three places: keep it instead of scanning the rows again.
        commits = scratch_dir(df.sparkSession, "commits")
        per_batch.write.parquet(commits)
        per_batch = df.sparkSession.read.parquet(commits)
        reached = _newest_before(per_batch.select("_batch_id", "_newest"), lag)
        newest = F.date_trunc("millisecond", "_newest")  # a watermark's precision
        marks = reached.select("_batch_id", (newest - F.expr(f"INTERVAL {delay}")).alias("_horizon"))
        accepted = accepted.join(broadcast_if_small(marks), "_batch_id").withColumn(
            "_late", F.coalesce(F.col(event_col) <= F.col("_horizon"), F.lit(False))
        )
    else:
        accepted = accepted.withColumn("_late", F.lit(False))
    late = accepted.filter("_late").groupBy("_batch_id").agg(F.count(F.lit(1)).alias("rows_late"))
    written = (
        accepted.filter("NOT _late")
        .groupBy(*keys)
        .agg(F.min("_batch_id").alias("_batch_id"))
        .groupBy("_batch_id")
        .agg(F.count(F.lit(1)).alias("rows_written"))
    )
    parts = [per_batch.drop("_newest"), late, written]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counts = ("rows_read", "rows_rejected", "rows_late", "rows_written")
    merged = union.groupBy("_batch_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]
    )
    duplicate = F.expr("rows_read - rows_rejected - rows_late - rows_written")
    return merged.select(
        "_batch_id",
        "rows_read",
        "rows_rejected",
        "rows_late",
        duplicate.alias("rows_duplicate"),
        "rows_written",
    )


class StreamTally:
    """Counts of a stream's batches, added up while it runs.

    Spark remembers the progress of the last batches only. ``note`` takes over what is remembered; called
    once per batch, and once at the end, it misses none, however few Spark remembers. A batch noted
    twice counts once.
    """

    def __init__(self, observation: str | None = None):
        self._observation = observation
        self._batches: dict[int, dict[str, int]] = {}

    def note(self, query: StreamingQuery) -> None:
        for progress in query.recentProgress:
            found = {
                "rows_read": progress["numInputRows"],
                # Late rows are dropped by the first stateful operator they meet, so none counts twice.
                "rows_late": sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"]),
            }
            seen = (progress["observedMetrics"] or {}).get(self._observation)
            found |= {} if seen is None else {k: v or 0 for k, v in seen.asDict().items()}
            held = self._batches.setdefault(progress["batchId"], {})
            for name, n in found.items():
                held[name] = max(held.get(name, 0), n)

    def total(self, name: str) -> int:
        return sum(batch.get(name, 0) for batch in self._batches.values())


def stream_counts(query: StreamingQuery) -> dict[str, int]:
    """Rows read and rows dropped as late in the recent progress of a finished stream.

    Of a stream of many batches use a ``StreamTally`` while it runs.
    """
    tally = StreamTally()
    tally.note(query)
    return {name: tally.total(name) for name in ("rows_read", "rows_late")}

"""Ingest a raw table, promote it to a refined one, rebuild, and replay a date range.

Progress is a commit number. Each raw commit is a ``_batch_id``; the control log says which is the
last complete one; a refined table is refreshed from the commits after its own last one, and what
it writes is named after the commit it reaches. So an interrupted run leaves nothing a reader
follows, and repeating it replaces its output.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.enrich import (
    failed_fields,
    parse_failed,
    parse_json_value,
    select_metadata,
    with_file_metadata,
    with_silver_metadata,
)
from ..functions.quality import conform_to_contract, range_condition, unconverted
from ..operators import control as ctl
from ..operators import merge
from ..operators.audit import StreamTally, row_counts
from ..operators.latest import latest_per_key
from ..operators.size import fits_broadcast
from ..sinks import tables as sink
from ..sources.landing import MALFORMED, TEXT_FORMATS, files_dated, read_landing, read_landing_stream
from ..sources.tables import BATCH, change_range, read_commits, read_table, read_table_stream
from ..spec import BronzeSpec, SilverSpec, build_schema, columns
from ..session import scratch_dir
from ..streaming.append import absent_rows, streaming_append

FILE_STAMPS = columns(
    "_ingested_at timestamp, _ingested_date date, _source_file string, "
    "_source_modified_at timestamp"
)
IMAGE_COLUMNS = FILE_STAMPS + columns(
    "_file_size_bytes long, _field_id string, _capture_date date, _image_seq integer, "
    "content binary"
)
TOPIC_STAMPS = columns(
    "_ingested_at timestamp, _ingested_date date, _kafka_topic string, _kafka_partition integer, "
    "_kafka_offset long, _kafka_ts timestamp, _kafka_key string, _raw_value string"
)


@dataclass(frozen=True)
class Layout:
    """Where tables, checkpoints and the control log live, and which generation of them is meant.

    A rebuild opens a new generation beside the old one; nothing is deleted or overwritten.
    """

    root: str
    bronze_generation: int = 0
    silver_generation: int = 0
    #: Generations of single tables, named ``<layer>.<name>``; tables not named are of generation 0.
    #: None: the two numbers above hold for all tables.
    rebuilt: tuple[tuple[str, int], ...] | None = None

    @classmethod
    def current(cls, spark: SparkSession, root: str) -> Layout:
        """The layout whose every table is of the generation that was last published."""
        layout = cls(root)
        return replace(layout, rebuilt=tuple(sorted(ctl.pointers(spark, layout.control).items())))

    def __post_init__(self):
        if set(self.root) & set("{}[]*?\\"):
            raise ValueError(f"Spark would read {self.root!r} as a pattern: a root must not hold any of {{}}[]*?\\")

    def generation(self, layer: str, name: str) -> int:
        if self.rebuilt is not None:
            return dict(self.rebuilt).get(f"{layer}.{name}", 0)
        return self.bronze_generation if layer == "bronze" else self.silver_generation

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}/g{self.generation(layer, name)}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root}/_checkpoints/{layer}/{name}/g{self.generation(layer, name)}"

    def pipeline(self, layer: str, name: str) -> str:
        return f"{layer}.{name}.g{self.generation(layer, name)}"

    @property
    def control(self) -> str:
        return f"{self.root}/_control"


@dataclass
class Run:
    """Counts and progress of a run, filled in while it goes."""

    rows_read: int = 0
    rows_written: int = 0
    version: int | None = None
    #: Rows that did not go the usual way, by reason.
    counts: dict[str, int] = field(default_factory=dict)

    def add(self, **counts: int) -> None:
        for name, n in counts.items():
            if n:
                self.counts[name] = self.counts.get(name, 0) + n


@contextmanager
def _logged(spark: SparkSession, layout: Layout, layer: str, name: str) -> Iterator[Run]:
    run, run_id, pipeline = Run(), ctl.new_run_id(), layout.pipeline(layer, name)
    ctl.log_run(spark, layout.control, pipeline, name, run_id, ctl.STARTED)
    try:
        yield run
    except Exception as error:
        note = f"{type(error).__name__}: {error}"
        ctl.log_run(spark, layout.control, pipeline, name, run_id, ctl.FAILED,
                    run.rows_read, 0, note)
        raise
    if run.counts:
        ctl.log_run(spark, layout.control, pipeline, name, run_id, ctl.COUNTED,
                    run.rows_read, run.rows_written, json.dumps(run.counts))
    note = "" if run.version is None else str(run.version)
    ctl.log_run(spark, layout.control, pipeline, name, run_id, ctl.SUCCESS,
                run.rows_read, run.rows_written, note)


def position(
    spark: SparkSession, layout: Layout, layer: str, name: str, status: str = ctl.SUCCESS
) -> int | None:
    """The last commit a pipeline has completed, or None."""
    pipeline = layout.pipeline(layer, name)
    control = ctl.read_ledger(spark, layout.control, pipeline)
    return ctl.ledger_position(control, pipeline, status)


def _completed(spark: SparkSession, layout: Layout, layer: str, name: str) -> int:
    upto = position(spark, layout, layer, name)
    if upto is None:
        raise LookupError(f"no completed run of {layout.pipeline(layer, name)}")
    return upto


def bronze_schema(spec: BronzeSpec) -> T.StructType | None:
    """Columns of the raw table a spec produces; None when they follow from the files."""
    if spec.ingest == "streaming":
        return build_schema(TOPIC_STAMPS + spec.columns)
    if spec.format == "binaryFile":
        return build_schema(IMAGE_COLUMNS)
    kept = ((MALFORMED, "string"),) if spec.format in TEXT_FORMATS else ()
    return build_schema(FILE_STAMPS + spec.columns + kept) if spec.columns else None


def malformed_counts(spec: BronzeSpec, columns_: Sequence[str]) -> dict[str, Column]:
    """How many raw rows have damaged text: records of landing files, or payloads of a topic (``malformed``:
    no field was found in them; ``misfit``: a field's text is not of its declared type)."""
    if MALFORMED in columns_:
        return {"malformed": F.count(MALFORMED)}
    if spec.ingest == "streaming" and spec.columns:
        misfit = F.size(failed_fields(spec.columns)) > 0
        return {"malformed": F.count_if(parse_failed(spec.columns) & ~misfit), "misfit": F.count_if(misfit)}
    return {}


def _source(spark: SparkSession, spec: BronzeSpec, given: DataFrame | None) -> DataFrame:
    if given is None and spec.ingest == "streaming":
        raise ValueError(f"{spec.name} is fed by a topic: pass its stream")
    return read_landing_stream(spark, spec, keep_malformed=True) if given is None else given


def to_bronze(source: DataFrame, spec: BronzeSpec, now: Column | None = None) -> DataFrame:
    """Source rows to raw-table rows: metadata, and for events the parsed payload."""
    rows = source.transform(select_metadata(spec.ingest, spec.format), now)
    return parse_json_value(rows, spec.columns) if spec.ingest == "streaming" else rows


def ingest(
    spark: SparkSession,
    spec: BronzeSpec,
    layout: Layout,
    source: DataFrame | None = None,
    now: Column | None = None,
) -> Run:
    """Append everything pending at the source to the raw table, then stop.

    ``source`` is the topic stream (see ``sources.kafka``); landing files are found from the spec.
    Damaged records keep their text in the raw table (``_malformed``, or ``_raw_value`` of a topic)
    and are counted in a COUNTED event of the run log.
    """
    with _logged(spark, layout, "bronze", spec.name) as run:
        run.version = _reached(spark, layout, "bronze", spec.name)

        def on_commit(batch_id: int, rows: int, **counts: int) -> None:
            run.rows_read += rows
            run.rows_written += rows
            run.version = batch_id
            run.add(**counts)

        rows = to_bronze(_source(spark, spec, source), spec, now)
        sink.append_stream(
            rows,
            layout.table("bronze", spec.name),
            layout.checkpoint("bronze", spec.name),
            spec.partition_cols,
            spec.clustered,
            on_commit=on_commit,
            done=position(spark, layout, "bronze", spec.name),
            counts=malformed_counts(spec, rows.columns),
        ).awaitTermination()
    return run


def start_ingest(
    spark: SparkSession,
    spec: BronzeSpec,
    layout: Layout,
    source: DataFrame | None = None,
    trigger: dict | None = None,
    now: Column | None = None,
) -> StreamingQuery:
    """Start appending to the raw table until the query is stopped, e.g. every minute.

    Each commit is logged as a run of its own, so promotions follow while the stream goes on.
    """
    pipeline = layout.pipeline("bronze", spec.name)

    def on_commit(batch_id: int, rows: int, **counts: int) -> None:
        run_id = ctl.new_run_id()
        if any(counts.values()):
            ctl.log_run(spark, layout.control, pipeline, spec.name, run_id, ctl.COUNTED,
                        rows, rows, json.dumps(counts))
        ctl.log_run(spark, layout.control, pipeline, spec.name, run_id, ctl.SUCCESS,
                    rows, rows, str(batch_id))

    rows = to_bronze(_source(spark, spec, source), spec, now)
    return sink.append_stream(
        rows,
        layout.table("bronze", spec.name),
        layout.checkpoint("bronze", spec.name),
        spec.partition_cols,
        spec.clustered,
        trigger or {"processingTime": "1 minute"},
        on_commit,
        position(spark, layout, "bronze", spec.name),
        malformed_counts(spec, rows.columns),
    )


def read_bronze(spark: SparkSession, spec: BronzeSpec, layout: Layout) -> DataFrame:
    """The completed commits of a raw table."""
    upto = _completed(spark, layout, "bronze", spec.name)
    rows = read_table(spark, layout.table("bronze", spec.name), bronze_schema(spec))
    return change_range(rows, None, upto)


def read_silver(spark: SparkSession, spec: SilverSpec, layout: Layout) -> DataFrame:
    """A refined table as of its last completed run."""
    if spec.table:
        return spark.table(spec.table)
    path, schema = layout.table("silver", spec.name), build_schema(spec.columns)
    upto = _completed(spark, layout, "silver", spec.name)
    if spec.load == "streaming_append":
        return change_range(read_table(spark, path, schema), None, upto).drop(BATCH)
    if spec.load in ("cdc_history", "append_dedup"):
        return _history(spark, spec, layout, upto)
    return _state(spark, spec, layout, upto)


def lake_row_counts(
    spark: SparkSession,
    layout: Layout,
    bronze: Iterable[BronzeSpec] = (),
    silver: Iterable[SilverSpec] = (),
) -> DataFrame:
    """``(table, rows)`` of raw and refined tables as of their last completed runs."""
    readers = {
        **{f"bronze.{s.name}": partial(read_bronze, spark, s, layout) for s in bronze},
        **{f"silver.{s.name}": partial(read_silver, spark, s, layout) for s in silver},
    }
    return row_counts(spark, readers)


def promote(
    spark: SparkSession,
    spec: SilverSpec,
    bronze: BronzeSpec,
    layout: Layout,
    now: Column | None = None,
    **options,
) -> Run:
    """Bring a refined table up to the raw table's last completed commit.

    ``options`` go to the load pattern. Without new commits nothing is written.
    """
    with _logged(spark, layout, "silver", spec.name) as run:
        if spec.load == "streaming_append":
            _promote_stream(spark, spec, bronze, layout, run, now, options)
            return run
        after = position(spark, layout, "silver", spec.name)
        upto = position(spark, layout, "bronze", bronze.name)
        run.version = upto
        if upto is None or upto == after:
            return run
        feed = read_commits(
            spark, layout.table("bronze", bronze.name), bronze_schema(bronze), after, upto)
        _count_feed(spark, spec, feed, layout, run)
        feed = feed.filter(~_without_key(spec, feed.columns))
        stamped = with_silver_metadata(feed, created=True, now=now)
        rows = conform_to_contract(stamped, spec.columns)
        if spec.table:
            _merge_in_place(spark, spec, rows, run, options)
        elif spec.load in ("cdc_history", "append_dedup"):
            _append(spark, spec, rows, layout, after, upto, run, options)
        else:
            _merge(spark, spec, rows, layout, after, upto, run, options)
    return run


def _without_key(spec: SilverSpec, names: Sequence[str]) -> Column:
    """Raw rows of damaged records that lost their key: they stay in the raw table and are counted."""
    if MALFORMED not in names:
        return F.lit(False)
    lost = [F.col(f"`{k}`").isNull() for k in spec.keys if k in names]
    return F.col(MALFORMED).isNotNull() & reduce(lambda a, b: a | b, lost, F.lit(False))


def _count_feed(spark, spec, feed, layout, run) -> None:
    """Count the feed and the values that its declared types cannot hold.

    A key that does not convert fails the run: cast, it could become one with another key, or null.
    Other values become null; how many is logged per column.
    """
    counts = {n: c.alias(n) for n, c in unconverted(feed, spec.columns, spec.keys).items()}
    damaged = F.count_if(_without_key(spec, feed.columns)).alias("malformed")
    if not counts and MALFORMED not in feed.columns:  # footers are enough
        run.rows_read = feed.count()
        return
    found = feed.agg(F.count(F.lit(1)).alias("rows"), damaged, *counts.values()).first()
    run.rows_read = found["rows"]
    run.add(malformed=found["malformed"])
    if not counts:
        return
    lost = {n: c for n, c in found.asDict().items() if n in counts and c}
    keys = {n: c for n, c in lost.items() if n in spec.keys}
    if keys:
        raise ValueError(f"{spec.name}: key values that do not convert, by column: {keys}")
    if lost:
        ctl.log_run(spark, layout.control, layout.pipeline("silver", spec.name), spec.name, ctl.new_run_id(),
                    ctl.UNCONVERTED, run.rows_read, 0, json.dumps(lost))


def _reached(spark: SparkSession, layout: Layout, layer: str, name: str) -> int | None:
    """The last commit of a stream: the ledger's, or a later one that Spark completed but whose entry is lost."""
    known = [position(spark, layout, layer, name), sink.completed_batch(spark, layout.checkpoint(layer, name))]
    return max((k for k in known if k is not None), default=None)


def _promote_stream(spark, spec, bronze, layout, run, now, options) -> None:
    # The raw table is read up to its last logged commit: a later one may be incomplete still.
    run.version = _reached(spark, layout, "silver", spec.name)
    upto = position(spark, layout, "bronze", bronze.name)
    after = position(spark, layout, "silver", spec.name, ctl.DRAINED)
    if upto is None or upto == after:
        return

    # Spark keeps the progress of the last batches only, so it is read batch by batch.
    tally = StreamTally("accepted")
    started: list[StreamingQuery] = []
    ready = threading.Event()

    def on_commit(batch_id: int, rows: int) -> None:
        ready.wait()
        tally.note(started[0])
        run.rows_written += rows
        run.version = batch_id

    path = layout.table("bronze", bronze.name)
    schema = bronze_schema(bronze) or read_table(spark, path).schema
    stream = read_table_stream(spark, path, schema, after, upto, **spec.read_options)
    # One pass counts what the rules let through. The observation stands before the rules, which
    # therefore do not reach the scan of the new commits.
    damaged = _without_key(spec, stream.columns)
    passes = range_condition(spec.rules, stream.columns)
    watched = passes is not None or MALFORMED in stream.columns
    if watched:
        accepted = ~damaged if passes is None else ~damaged & passes
        stream = stream.observe("accepted", F.count_if(accepted).alias("rows_accepted"),
                                F.count_if(damaged).alias("rows_malformed")).filter(~damaged)
    prepare = None
    if spec.stateless:
        prepare = absent_rows(spec, layout.table("silver", spec.name), scratch_dir(spark, "batches"))
    query = sink.append_stream(
        streaming_append(stream, spec, now, **options),
        layout.table("silver", spec.name),
        layout.checkpoint("silver", spec.name),
        spec.partition_cols,
        spec.clustered,
        on_commit=on_commit,
        prepare=prepare,
    )
    started.append(query)
    ready.set()
    query.awaitTermination()
    tally.note(query)
    run.rows_read, late = tally.total("rows_read"), tally.total("rows_late")
    accepted, malformed = tally.total("rows_accepted") if watched else run.rows_read, tally.total("rows_malformed")
    run.counts = {"upto": upto, "malformed": malformed, "rejected": run.rows_read - accepted - malformed,
                  "late": late, "duplicate": accepted - late - run.rows_written}
    ctl.log_run(spark, layout.control, layout.pipeline("silver", spec.name), spec.name, ctl.new_run_id(),
                ctl.DRAINED, run.rows_read, run.rows_written, str(upto))


def _append(spark, spec, rows, layout, after, upto, run, options) -> None:
    path = layout.table("silver", spec.name)
    table = None
    if after is not None:
        table = merge.near_feed(_history(spark, spec, layout, after), rows, spec.keys, spec.partition_cols)
    if spec.buckets:
        if options.get("within_feed", "distinct") == "distinct":
            reduced = scratch_dir(spark, "staged")
            merge.distinct_keys(rows, spec.keys).write.parquet(reduced)
            rows = spark.read.schema(rows.schema).parquet(reduced)
            options = {**options, "within_feed": "reduced"}
        fresh = merge.insert_if_absent(table, rows, spec.keys, **options)
    else:
        # Usually few keys clash. Find them on key columns alone; if they prove few, the (possibly
        # very wide) rows are not shuffled at all.
        clash = scratch_dir(spark, "contested")
        fed_keys = rows.select(*[F.col(f"`{k}`") for k in spec.keys])
        small = table is not None and fits_broadcast(fed_keys)
        merge.contested_keys(table, rows, spec.keys, small_feed=small).write.parquet(clash)
        contested = spark.read.schema(fed_keys.schema).parquet(clash)
        if contested.isEmpty():
            fresh = rows
        else:
            few = contested if fits_broadcast(contested) else None
            fresh = merge.insert_if_absent(table, rows, spec.keys, contested=few, **options)
    seen = Observation()
    fresh = fresh.observe(seen, F.count(F.lit(1)).alias("rows"))
    if spec.buckets:
        # A table cannot replace a commit while it is being read: the new rows wait next to it.
        staged = scratch_dir(spark, "fresh")
        fresh.write.parquet(staged)
        fresh = spark.read.schema(rows.schema).parquet(staged)
        sink.append_bucketed(fresh, sink.bucketed_name(spec.name, path), path, upto,
                             (spec.buckets, spec.keys))
    else:
        sink.append_batch(fresh, path, upto, spec.partition_cols, spec.clustered)
    run.rows_written = sink.observed_rows(seen)


def _history(spark: SparkSession, spec: SilverSpec, layout: Layout, upto: int) -> DataFrame:
    path, schema = layout.table("silver", spec.name), build_schema(spec.columns)
    if spec.buckets:
        held = sink.open_bucketed(spark, sink.bucketed_name(spec.name, path), path, schema,
                                  (spec.buckets, spec.keys), commits=True)
    else:
        held = read_table(spark, path, schema)
    return change_range(held, None, upto).drop(BATCH)


def _merge(spark, spec, rows, layout, after, upto, run, options) -> None:
    path = layout.table("silver", spec.name)
    # Reduce the feed once and keep the result: every plan below reads it as a plain table, whose
    # size is known.
    order = spec.sequence_col if spec.load == "cdc_merge" else spec.order_col
    reduced = scratch_dir(spark, "staged")
    latest_per_key(rows, spec.keys, order).write.parquet(reduced)
    staged = spark.read.schema(rows.schema).parquet(reduced)
    if spec.buckets:
        mapped = {} if after is None else sink.read_bucket_map(spark, path, after, spec.buckets)
        touched = sink.touched_buckets(staged, spec.keys, spec.buckets)
        if not touched:
            sink.write_bucket_map(spark, path, upto, mapped, touched, spec.buckets)
            return
        state = sink.read_buckets(
            spark, path, {b: mapped[b] for b in touched if b in mapped}, build_schema(spec.columns))
    else:
        state = None if after is None else _state(spark, spec, layout, after)
    seen = Observation()
    options = {"applied": seen, "reduced": True, **options}
    if state is not None:
        options.setdefault("small_feed", fits_broadcast(staged))
    if spec.load == "cdc_merge":
        merged = merge.cdc_merge(
            state, staged, spec.keys, spec.sequence_col, spec.op_col, **options)
    elif spec.load == "full_merge":
        merged = merge.full_merge(state, staged, spec.keys, spec.order_col, **options)
    else:
        merged = merge.incremental_replace(state, staged, spec.keys, spec.order_col, **options)
    if spec.buckets:
        sink.write_buckets(
            merged, path, upto, spec.keys, spec.buckets, spec.partition_cols, spec.clustered)
        sink.write_bucket_map(spark, path, upto, mapped, touched, spec.buckets)
    else:
        sink.write_snapshot(merged, path, upto, spec.partition_cols, spec.clustered)
    run.rows_written = sink.observed_rows(seen)


def _merge_in_place(spark, spec, rows, run, options) -> None:
    """The load pattern as one MERGE; only the files that hold touched keys are rewritten.

    Of the patterns' options it has ``guard`` of incremental_replace; others are refused.
    ``rows_written`` counts the rows offered to the MERGE.
    """
    options = dict(options)
    guard = options.pop("guard", False) if spec.load == "incremental_replace" else False
    if options:
        raise ValueError(f"{spec.load} into a catalog table has no option {', '.join(sorted(options))}")
    appended = spec.load in ("cdc_history", "append_dedup")
    order = spec.sequence_col if spec.load == "cdc_merge" else spec.order_col
    reduced = scratch_dir(spark, "staged")
    staged = (
        merge.distinct_keys(rows, spec.keys) if appended
        else latest_per_key(rows, spec.keys, order)
    )
    staged.write.parquet(reduced)
    staged = spark.read.schema(rows.schema).parquet(reduced)
    guarded = spec.load in ("full_merge", "cdc_merge") or guard
    sink.merge_into(
        staged, spec.table, spec.keys,
        update_if=F.col(f"src.{order}") >= F.col(f"{spec.table}.{order}") if guarded else None,
        insert_if=F.col(f"src.{spec.op_col}") != "D" if spec.load == "cdc_merge" else None,
        update=not appended,
    )
    run.rows_written = staged.count()


def _state(spark: SparkSession, spec: SilverSpec, layout: Layout, version: int) -> DataFrame:
    path, schema = layout.table("silver", spec.name), build_schema(spec.columns)
    if not spec.buckets:
        return sink.read_snapshot(spark, path, version, schema)
    mapped = sink.read_bucket_map(spark, path, version, spec.buckets)
    rows = sink.read_buckets(spark, path, mapped, schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def _next_generation(spark: SparkSession, layout: Layout, layer: str, name: str) -> Layout:
    """The layout in which a table has a generation that was never published; with numbers for whole layers, the
    next one. A rebuild that broke off is thus taken up again."""
    number = layout.generation(layer, name) + 1
    if layout.rebuilt is None:
        return replace(layout, **{f"{layer}_generation": number})
    table = f"{layer}.{name}"
    number = max(number, ctl.last_generation(spark, layout.control, table) + 1)
    return replace(layout, rebuilt=tuple(sorted({**dict(layout.rebuilt), table: number}.items())))


def publish(spark: SparkSession, layout: Layout) -> None:
    """Let ``Layout.current`` name the generations of ``layout``, which must have single tables' numbers.

    Also the way back: publish the layout that held before a rebuild.
    """
    if layout.rebuilt is None:
        raise ValueError("numbers for whole layers are not published: start from Layout.current")
    known = ctl.pointers(spark, layout.control)
    wanted = {**dict.fromkeys(known, 0), **dict(layout.rebuilt)}
    # Raw tables first: a refined table is never ahead of the raw table it was built from.
    for table, number in sorted(wanted.items()):
        if known.get(table, 0) != number:
            ctl.point_to(spark, layout.control, table, number)


def reparse_topic(spark: SparkSession, spec: BronzeSpec, layout: Layout) -> Layout:
    """Rebuild a topic's raw table from its own stored payloads, under the columns that ``spec`` now declares.

    The topic itself is not read, so records that have expired there are kept. One job reads the
    envelope and ``_raw_value`` of all completed commits, parses anew and writes the next generation,
    commit numbers and stamps unchanged: refined tables keep their positions. The stream's checkpoint
    is copied, so ``ingest`` with the returned layout goes on where the old generation stopped. Stop
    the stream while this runs. A payload that does not parse gives null fields and is counted as by
    ``ingest``. Repeating a rebuild that broke off replaces its output.
    """
    if spec.ingest != "streaming":
        raise ValueError(f"{spec.name} is fed by files: use full_refresh(reread_landing=True)")
    upto = _reached(spark, layout, "bronze", spec.name)
    if upto is None:
        raise LookupError(f"no completed run of {layout.pipeline('bronze', spec.name)}")
    fresh = _next_generation(spark, layout, "bronze", spec.name)
    with _logged(spark, fresh, "bronze", spec.name) as run:
        run.version = upto
        held = read_table(spark, layout.table("bronze", spec.name), build_schema(TOPIC_STAMPS))
        rows = parse_json_value(change_range(held, None, upto), spec.columns, BATCH)
        seen, counts = Observation(), malformed_counts(spec, rows.columns)
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])
        sink.write_commits(rows, fresh.table("bronze", spec.name), spec.partition_cols, spec.clustered)
        found = sink.observed(seen)
        run.rows_read = run.rows_written = found.get("rows", 0)
        run.add(**{n: found.get(n, 0) for n in counts})
        sink.copy_checkpoint(spark, layout.checkpoint("bronze", spec.name), fresh.checkpoint("bronze", spec.name))
    return fresh


def full_refresh(
    spark: SparkSession,
    spec: SilverSpec,
    bronze: BronzeSpec,
    layout: Layout,
    reread_landing: bool = False,
    now: Column | None = None,
    **options,
) -> Layout:
    """Rebuild a refined table from the whole raw table and return the layout that names it.

    The rebuild has its own paths, checkpoint and ledger; the previous generation stays readable.
    ``reread_landing`` rebuilds the raw table first: from its landing files, or for a topic from its
    stored payloads (``reparse_topic``).

    A layout from ``Layout.current`` is published when the rebuild is complete, so later calls of
    ``Layout.current`` follow it. Not so after landing files were read again: their commits are
    numbered anew, so rebuild the other refined tables of that raw table with the returned layout too,
    then ``publish`` it.
    """
    if spec.table:
        raise ValueError("a catalog table has one generation: rebuild it under another table name")
    fresh = _next_generation(spark, layout, "silver", spec.name)
    from_files = reread_landing and bronze.ingest != "streaming"
    if from_files:
        fresh = _next_generation(spark, fresh, "bronze", bronze.name)
        ingest(spark, bronze, fresh, now=now)
    elif reread_landing:
        fresh = reparse_topic(spark, bronze, fresh)
    promote(spark, spec, bronze, fresh, now=now, **options)
    if fresh.rebuilt is not None and not from_files:
        publish(spark, fresh)
    return fresh


def replay_range(
    spark: SparkSession,
    spec: BronzeSpec,
    start: date | str,
    end: date | str,
    now: Column | None = None,
) -> DataFrame:
    """Raw-table rows of the landing files dated within [start, end], for reprocessing.

    One batch over exactly those files; other files are not opened.
    """
    landed = read_landing(spark, spec, keep_malformed=True)
    return with_file_metadata(files_dated(landed, start, end), now)

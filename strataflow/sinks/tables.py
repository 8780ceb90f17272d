"""Writers. Every write goes to a path of its own run, so a repeated run replaces its own output."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import CREATED
from ..sources.tables import BATCH, with_batch_column

BUCKET = "_bucket"
MAP_SCHEMA = "buckets int, held map<string,long>"


def observed(seen: Observation) -> dict[str, int]:
    """What was observed; nothing when the data proved empty, which makes Spark drop the observation."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def observed_rows(seen: Observation) -> int:
    """The observed ``rows``."""
    return observed(seen).get("rows", 0)


def _write(df: DataFrame, path: str, partition_cols: Sequence[str], clustered: bool) -> None:
    if clustered and partition_cols:
        # Gather each partition's rows into few files; AQE splits an oversized partition again.
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_cols])
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)


def append_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    partition_cols: Sequence[str] = (),
    clustered: bool = False,
) -> None:
    """Append ``df`` to a table as commit ``batch_id``; repeating a commit replaces it."""
    cols = [c for c in df.columns if c != BATCH]
    _write(df.select(*[F.col(f"`{c}`") for c in cols]), f"{path}/{BATCH}={batch_id}",
           partition_cols, clustered)


def write_commits(
    df: DataFrame, path: str, partition_cols: Sequence[str] = (), clustered: bool = False
) -> None:
    """Write a whole table at once, each row to the commit in its ``_batch_id``; repeating replaces the table."""
    _write(df, path, (BATCH, *partition_cols), clustered)


def copy_checkpoint(spark: SparkSession, checkpoint: str, target: str) -> None:
    """Start a stream without state from another one's progress; only its small log files are copied.

    The marks of completed batches come last: a copy that broke off has not reached the batch its table
    holds, so that ``append_stream`` refuses it until it is copied again.
    """
    conf = spark._jsc.hadoopConfiguration()
    path = spark._jvm.org.apache.hadoop.fs.Path
    files, copy = path(checkpoint).getFileSystem(conf), spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    if not files.exists(path(checkpoint)):
        return
    names = [e.getPath().getName() for e in files.listStatus(path(checkpoint))]
    files.mkdirs(path(target))
    for name in sorted(names, key=lambda n: n == "commits"):
        copy(files, path(f"{checkpoint}/{name}"), files, path(f"{target}/{name}"), False, True, conf)


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_cols: Sequence[str] = (),
    clustered: bool = False,
    trigger: dict | None = None,
    on_commit: Callable[..., None] | None = None,
    done: int | None = None,
    counts: Mapping[str, Column] | None = None,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Start appending a stream to a table, one commit per micro-batch.

    The default trigger drains what is pending and stops. A micro-batch replayed after a failure
    overwrites its own commit, so the table holds each row once. ``on_commit(batch_id, rows)`` is
    called after each commit; the count is observed during the write. ``counts`` are further
    aggregates of the rows, observed in the same pass and handed on by name. ``prepare(batch, batch_id)``
    gives the rows to write for a micro-batch; it must give the same ones when the batch is replayed.

    ``done`` is the last commit that readers may already follow: a replay of it runs, but leaves its
    files alone. A checkpoint further behind is not the one that wrote the table and is refused.
    """
    if done is not None:
        reached = completed_batch(stream.sparkSession, checkpoint)
        if (-1 if reached is None else reached) < done - 1:
            raise ValueError(f"commit {done} is complete, but the checkpoint {checkpoint} has reached {reached}")

    def commit(batch: DataFrame, batch_id: int) -> None:
        if done is not None and batch_id <= done:
            return batch.write.format("noop").mode("overwrite").save()
        if prepare is not None:
            batch = prepare(batch, batch_id)
        if on_commit is None:
            return append_batch(batch, path, batch_id, partition_cols, clustered)
        seen, more = Observation(), counts or {}
        counted = batch.observe(
            seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in more.items()])
        append_batch(counted, path, batch_id, partition_cols, clustered)
        found = observed(seen)
        on_commit(batch_id, found.get("rows", 0), **{name: found.get(name, 0) for name in more})

    writer = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def write_snapshot(
    df: DataFrame,
    path: str,
    version: int,
    partition_cols: Sequence[str] = (),
    clustered: bool = False,
) -> None:
    """Write a whole refreshed table beside the previous one; readers move once it is logged."""
    _write(df, f"{path}/v={version}", partition_cols, clustered)


def read_snapshot(
    spark: SparkSession, path: str, version: int, schema: T.StructType | None = None
) -> DataFrame:
    """One version of a table. A schema keeps the type of partition columns ('007' stays text)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/v={version}")


# Key buckets as folders: a refresh reads and writes only the buckets its feed touches. A version's
# map names the version that last wrote each bucket, so versions share the files of the others.


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Add the key's bucket number; a row's bucket never changes, so rows never move."""
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    return df.withColumn(BUCKET, F.pmod(hashed, F.lit(buckets)).cast("int"))


def touched_buckets(staged: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """Buckets the staged feed falls into: at most ``buckets`` numbers."""
    found = with_bucket(staged, keys, buckets).select(BUCKET).distinct()
    return sorted(row[BUCKET] for row in found.collect())


def write_buckets(
    df: DataFrame,
    path: str,
    version: int,
    keys: Sequence[str],
    buckets: int,
    partition_cols: Sequence[str] = (),
    clustered: bool = True,
) -> None:
    """Write the rows of some buckets, whole, as new files of ``version``."""
    _write(with_bucket(df, keys, buckets), f"{path}/{BATCH}={version}", [BUCKET, *partition_cols], clustered)


def write_bucket_map(
    spark: SparkSession, path: str, version: int, held: dict[int, int], touched: Sequence[int], buckets: int
) -> None:
    """Store which version holds each bucket: ``version`` for the touched ones, else as in ``held``.

    Touched buckets without a row (a delete of an unknown key inserts none) have no files.
    """
    mapped = {b: v for b, v in held.items() if b not in touched}
    if touched:
        mapped |= {b: version for b in _written_buckets(spark, f"{path}/{BATCH}={version}")}
    held_now = F.from_json(F.lit(json.dumps(mapped)), "map<string,long>")
    row = spark.range(0, 1, 1, 1).select(F.lit(buckets).alias("buckets"), held_now.alias("held"))
    row.write.mode("overwrite").parquet(f"{path}/map/{version}")


def read_bucket_map(spark: SparkSession, path: str, version: int, buckets: int) -> dict[int, int]:
    """The version that holds each bucket: at most ``buckets`` numbers."""
    row = spark.read.schema(MAP_SCHEMA).parquet(f"{path}/map/{version}").first()
    if row["buckets"] != buckets:
        raise ValueError(f"{path} has {row['buckets']} buckets, not {buckets}: rebuild it to change them")
    return {int(b): v for b, v in row["held"].items()}


def read_buckets(spark: SparkSession, path: str, mapped: dict[int, int], schema: T.StructType) -> DataFrame | None:
    """The rows of the given buckets; None without any."""
    if not mapped:
        return None
    folders = [f"{path}/{BATCH}={v}/{BUCKET}={b}" for b, v in sorted(mapped.items())]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return rows.select(*[F.col(f"`{c}`") for c in schema.names])


def _written_buckets(spark: SparkSession, path: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [entry.getPath().getName() for entry in listed]
    return [int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}=")]


def overwrite_buckets(df: DataFrame, path: str, staging: str) -> None:
    """Replace exactly the buckets present in ``df`` (which must hold them whole).

    The rows are written to ``staging`` first: a job may not overwrite what it reads. If the second
    step is cut short, repeating the merge is safe, since applying a feed twice equals once.
    """
    _write(df, staging, [BUCKET], clustered=True)
    (
        df.sparkSession.read.schema(df.schema)
        .parquet(staging)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def save_as_table(
    df: DataFrame,
    table: str,
    path: str,
    partition_cols: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Write to an external location and register a catalog table over it.

    ``bucket_by=(n, keys)`` stores the table hash-distributed by key: a later merge on those keys
    then shuffles only the feed.
    """
    writer = df.write.mode("overwrite").option("path", path).format("parquet")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if bucket_by:
        n, keys = bucket_by
        writer = writer.bucketBy(n, *keys).sortBy(*keys)
    writer.saveAsTable(table)


def bucketed_name(label: str, path: str) -> str:
    """A catalog name that is the same in every session for the same location."""
    plain = re.sub(r"\W", "_", label)
    return f"{plain}_{hashlib.md5(path.encode()).hexdigest()[:12]}"


def _register(spark, table, path, schema, bucket_by, commits) -> bool:
    """Make a key-distributed table known to the catalog; false if it already was."""
    if spark.catalog.tableExists(table):
        return False
    n, keys = bucket_by
    schema = with_batch_column(schema) if commits else schema
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({cols}) USING parquet "
        + (f"PARTITIONED BY ({BATCH}) " if commits else "")
        + f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {n} BUCKETS LOCATION '{location}'"
    )
    return True


def open_bucketed(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    bucket_by: tuple[int, Sequence[str]],
    commits: bool = False,
) -> DataFrame:
    """A stored key-distributed table; registered again if this session does not know it.

    ``commits`` is for tables written by ``append_bucketed``.
    """
    if _register(spark, table, path, schema, bucket_by, commits) and commits:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def append_bucketed(
    df: DataFrame, table: str, path: str, batch_id: int, bucket_by: tuple[int, Sequence[str]]
) -> None:
    """Append ``df`` as commit ``batch_id`` of a key-distributed table; repeating replaces it."""
    spark = df.sparkSession
    n, keys = bucket_by
    new = _register(spark, table, path, df.schema, bucket_by, commits=True)
    cols = [F.col(f"`{c}`") for c in spark.table(table).columns if c != BATCH]
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = {int(batch_id)}) "
        "SELECT * FROM {rows}",
        rows=df.select(*cols).repartition(n, *keys),
    )
    if new:
        spark.catalog.recoverPartitions(table)


def append_evolving(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union that accepts new columns; rows without them get null."""
    return a.unionByName(b, allowMissingColumns=True)


def merge_into(
    staged: DataFrame,
    table: str,
    keys: Sequence[str],
    update_if: Column | None = None,
    insert_if: Column | None = None,
    update: bool = True,
    evolve: bool = False,
) -> None:
    """The same upsert in place, for catalogs whose tables accept row-level operations.

    Conditions name the table by ``table`` and the feed by ``src``. ``update=False`` only inserts.
    """
    feed = staged.alias("src")
    on = reduce(lambda a, b: a & b, [F.col(f"{table}.{k}") == F.col(f"src.{k}") for k in keys])
    values = {c: F.col(f"src.{c}") for c in staged.columns}
    changed = {c: v for c, v in values.items() if c != CREATED}
    writer = feed.mergeInto(table, on)
    if evolve:
        writer = writer.withSchemaEvolution()
    if update:
        matched = writer.whenMatched() if update_if is None else writer.whenMatched(update_if)
        writer = matched.update(changed)
    missing = writer.whenNotMatched() if insert_if is None else writer.whenNotMatched(insert_if)
    missing.insert(values).merge()


def completed_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The last micro-batch that Spark has marked as completed in a checkpoint, or None."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    return max((int(n) for n in names if n.isdigit()), default=None)

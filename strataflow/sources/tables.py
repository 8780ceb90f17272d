"""Tables written by ``sinks.tables``: whole, as a range of commits, or as a stream."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "_batch_id"


def with_batch_column(schema: T.StructType) -> T.StructType:
    """``schema`` plus the commit column every appended table is partitioned by."""
    if BATCH in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A whole appended table.

    With a schema, columns that older files lack are null and partition values keep their declared
    type; without one, the schemas of all files are merged, which opens every footer. Commits whose
    types differ are read as the common supertype of each column (``widened``).
    """
    if schema is not None:
        return spark.read.schema(with_batch_column(schema)).parquet(path)
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except Py4JJavaError as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    return widened(spark, path, commit_numbers(spark, path))


def commit_numbers(spark: SparkSession, path: str) -> list[int]:
    """The commits of a table, from the names of its folders; no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    return sorted(int(n.removeprefix(f"{BATCH}=")) for n in names if n.removeprefix(f"{BATCH}=").isdigit() and n.startswith(BATCH))


def _alike(spark: SparkSession, path: str, commits: list[int]) -> list[DataFrame]:
    """Runs of commits whose schemas merge, each read as one table.

    Halving finds the commits where a type changes in about their number times log(commits) looks.
    """
    reader = spark.read.option("mergeSchema", "true").option("basePath", path)
    try:
        return [reader.parquet(*[f"{path}/{BATCH}={n}" for n in commits])]
    except Py4JJavaError as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error) or len(commits) == 1:
            raise
    half = len(commits) // 2
    return _alike(spark, path, commits[:half]) + _alike(spark, path, commits[half:])


_WIDTHS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text where there is no other.

    Whole numbers widen to the longer one, floats to doubles. Whole numbers and floats meet in a double
    where it is exact, else in text, and so do all other pairs.
    """
    if a == b:
        return a
    if isinstance(a, _WIDTHS) and isinstance(b, _WIDTHS):
        return max(a, b, key=lambda t: _WIDTHS.index(type(t)))
    fractions = (T.FloatType, T.DoubleType)
    short = (*_WIDTHS[:3], *fractions)
    if isinstance(a, short) and isinstance(b, short) and (isinstance(a, fractions) or isinstance(b, fractions)):
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    return T.StringType()


def widened(spark: SparkSession, path: str, commits: list[int]) -> DataFrame:
    """Commits of different schemas as one table: all columns, each in the supertype of its types.

    Columns stand in the order in which they first appear; a commit without one has nulls.
    """
    tables = _alike(spark, path, commits)
    types: dict[str, T.DataType] = {}
    for df in tables:
        for f in df.schema:
            types[f.name] = supertype(types.get(f.name, f.dataType), f.dataType)
    fitted = [
        df.select(*[(F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind).alias(name)
                    for name, kind in types.items()])
        for df in tables
    ]
    return reduce(DataFrame.unionByName, fitted)


def offset_gaps(topic: DataFrame, span: int = 1_000_000) -> DataFrame:
    """Offsets missing from a raw table of a topic, as runs between two that are there.

    One row per run: topic, partition, ``first_missing`` and ``last_missing`` offset, ``missing``, and
    the commits of the rows before and after it. Offsets before the first and after the last row of a
    partition are not known to exist; repeated offsets are one. Gaps are records that expired unread, or
    what compaction and transactions left out.

    A topic partition of any length is cut into spans of ``span`` offsets: neighbours are compared within
    a span, then the ends of spans with each other, one row per span.
    """
    by = ["_kafka_topic", "_kafka_partition"]
    offset, commit = F.col("_kafka_offset"), F.col(BATCH)
    held = topic.filter(offset.isNotNull()).groupBy(*by, "_kafka_offset").agg(F.min(commit).alias(BATCH))
    held = held.withColumn("_span", F.floor(offset / F.lit(span)).cast("long"))
    inside = Window.partitionBy(*by, "_span").orderBy("_kafka_offset")
    near = held.select(*by, offset.alias("_next"), commit.alias("commit_after"),
                       F.lag("_kafka_offset").over(inside).alias("_last"), F.lag(BATCH).over(inside).alias("commit_before"))
    ends = held.groupBy(*by, "_span").agg(
        F.min(F.struct("_kafka_offset", BATCH)).alias("a"), F.max(F.struct("_kafka_offset", BATCH)).alias("z"))
    across = Window.partitionBy(*by).orderBy("_span")
    far = ends.select(
        *by, F.col("a")["_kafka_offset"].alias("_next"), F.col("a")[BATCH].alias("commit_after"),
        F.lag("z").over(across)["_kafka_offset"].alias("_last"), F.lag("z").over(across)[BATCH].alias("commit_before"))
    gaps = near.unionByName(far).filter("_next - _last > 1")
    return gaps.select(
        *by, (F.col("_last") + 1).alias("first_missing"), (F.col("_next") - 1).alias("last_missing"),
        (F.col("_next") - F.col("_last") - 1).alias("missing"), "commit_before", "commit_after")


def read_commits(
    spark: SparkSession, path: str, schema: T.StructType | None, after: int | None, upto: int
) -> DataFrame:
    """``change_range`` of a table on disk, where commit ``upto`` exists.

    Only the folders of the range are listed. Without a schema those of all files are merged.
    """
    if schema is None:
        return change_range(read_table(spark, path), after, upto)
    reader = spark.read.schema(with_batch_column(schema)).option("basePath", path)
    return reader.parquet(commit_folders(path, after, upto))


def commit_folders(path: str, after: int | None, upto: int) -> str:
    """A path pattern that matches exactly the commits in ``(after, upto]``.

    Runs of ten, a hundred, ... commits are one alternative each (120 to 129: ``12[0-9]``), so the
    pattern stays short however many commits the range spans.
    """
    first, parts = 0 if after is None else max(0, after + 1), []
    while first <= upto:
        step, digits = 1, 0
        while first and first % (step * 10) == 0 and first + step * 10 - 1 <= upto:
            step, digits = step * 10, digits + 1
        parts.append(f"{first // step}{'[0-9]' * digits}")
        first += step
    return f"{path}/{BATCH}={{{','.join(parts)}}}"


def read_table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    after: int | None = None,
    upto: int | None = None,
    **options: str,
) -> DataFrame:
    """An appended table as a stream of the files committed since the checkpoint.

    ``upto`` bounds it to commits known to be complete; those up to ``after`` are not even listed
    (the checkpoint still knows the files it has planned). A file that vanishes is an error.
    """
    reader = spark.readStream.schema(with_batch_column(schema)).options(**options)
    if upto is None:
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(commit_folders(path, after, upto))


def change_range(bronze: DataFrame, after: int | None, upto: int | None) -> DataFrame:
    """Rows committed in ``(after, upto]``; an open lower bound is the first, full load.

    Pinning the upper bound keeps rows that land during the load for the next run. ``_batch_id`` is
    a directory level, so commits outside the range are not read.
    """
    df = bronze
    if after is not None:
        df = df.filter(F.col(BATCH) > after)
    if upto is not None:
        df = df.filter(F.col(BATCH) <= upto)
    return df


def newest_commit(spark: SparkSession, path: str) -> DataFrame:
    """The highest commit of a table on disk, as one row ``(version)``, null without any.

    It is read off the folder names: no file is opened.
    """
    newest = max(commit_numbers(spark, path), default=None)
    return spark.range(1).select(F.lit(newest).cast("long").alias("version"))


def current_version(bronze: DataFrame) -> DataFrame:
    """The highest commit in any DataFrame with a commit column, as one row ``(version)``.

    Of a table on disk ``newest_commit`` knows it without a look at the rows; pipelines take it from
    the control log.
    """
    return bronze.agg(F.max(F.col(BATCH).cast("long")).alias("version"))

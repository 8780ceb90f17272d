"""Landing files, read as a stream so that each file is taken once."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import BronzeSpec, build_schema

# The binary source's columns (a binary stream must declare them) and image names.
BINARY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
IMAGE_GLOB = "*.jpg"
FILE_DATE = r"(\d{4}-\d{2}-\d{2})"
#: Formats of text records, whose damaged records can be kept as they stand, and the column for them.
TEXT_FORMATS = ("json", "csv")
MALFORMED = "_malformed"


def _options(spec: BronzeSpec) -> dict[str, str]:
    options = {"mergeSchema": str(spec.merge_schema).lower()}
    if spec.format == "binaryFile":
        options = {"pathGlobFilter": IMAGE_GLOB}
    return {**options, **spec.read_options}


def _schema(spark: SparkSession, spec: BronzeSpec) -> T.StructType:
    if spec.format == "binaryFile":
        return BINARY_SCHEMA
    declared = build_schema(spec.columns)
    if declared is not None:
        return declared
    return spark.read.format(spec.format).options(**_options(spec)).load(spec.landing).schema


def _reader(reader, spark: SparkSession, spec: BronzeSpec, keep_malformed: bool, options: dict[str, str]):
    schema, given = _schema(spark, spec), {**_options(spec), **options}
    if keep_malformed and spec.format in TEXT_FORMATS:
        given["columnNameOfCorruptRecord"] = MALFORMED
        schema = T.StructType([f for f in schema if f.name != MALFORMED]).add(MALFORMED, T.StringType())
    return reader.format(spec.format).schema(schema).options(**given).load(spec.landing)


def read_landing_stream(
    spark: SparkSession, spec: BronzeSpec, keep_malformed: bool = False, **options: str
) -> DataFrame:
    """New landing files since the checkpoint, with the declared schema enforced.

    Without a declared schema it is inferred once, here. ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` bound each batch of a large backlog.

    A JSON or CSV record that does not parse, or not wholly, has nulls in the fields it loses. With
    ``keep_malformed`` a last column ``_malformed`` holds its whole text, and null for sound records.
    """
    return _reader(spark.readStream, spark, spec, keep_malformed, options)


def read_landing(
    spark: SparkSession, spec: BronzeSpec, keep_malformed: bool = False, **options: str
) -> DataFrame:
    """All landing files as one batch."""
    return _reader(spark.read, spark, spec, keep_malformed, options)


def files_dated(df: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Rows of files whose path carries a ``yyyy-MM-dd`` date within [start, end].

    The condition is on file metadata only, so Spark skips the other files without opening them.
    The last date in the path counts: both ``2026-04-01.json`` and ``day=2026-04-01/part-0`` work.
    """
    dated = F.regexp_extract(F.col("_metadata.file_path"), f".*{FILE_DATE}", 1)
    return df.filter(dated.between(str(start), str(end)))  # such dates sort as text

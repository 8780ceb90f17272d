"""Dataset descriptions: plain frozen values that the operators take as arguments."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# The declarable type names. "float" is widened to double on purpose.
TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
}

LOADS = (
    "full_merge",
    "incremental_replace",
    "cdc_merge",
    "cdc_history",
    "append_dedup",
    "streaming_append",
)

Columns = tuple[tuple[str, str], ...]


def columns(text: str) -> Columns:
    """Parse ``"order_id string, item_count long"`` into ((name, type), ...)."""
    return tuple((name, kind) for name, kind in (part.split() for part in text.split(",")))


def build_schema(fields: Iterable[tuple[str, str]]) -> T.StructType | None:
    """All-nullable schema for (name, type) pairs; None when nothing is declared.

    An unknown type name raises KeyError.
    """
    pairs = list(fields)
    if not pairs:
        return None
    return T.StructType([T.StructField(name, TYPES[kind.lower()], True) for name, kind in pairs])


def _columns_from(entries: Iterable[Mapping]) -> Columns:
    return tuple((e["name"], e["type"]) for e in entries or ())


@dataclass(frozen=True)
class RangeRule:
    """Inclusive value range of one column; either bound may be open."""

    column: str
    min: float | None = None
    max: float | None = None


@dataclass(frozen=True)
class BronzeSpec:
    """A raw, append-only table and where its rows come from."""

    name: str
    format: str = "parquet"  # parquet, json, csv, avro, orc, binaryFile
    ingest: str = "batch"  # batch (landing files) or streaming (topic)
    columns: Columns = ()
    landing: str = ""
    topic: str = ""
    partition_cols: tuple[str, ...] = ()
    merge_schema: bool = True
    clustered: bool = False  # gather partition values before writing: fewer files, one shuffle
    read_options: Mapping[str, str] = field(default_factory=dict)  # e.g. maxBytesPerTrigger

    @classmethod
    def from_config(cls, entry: Mapping) -> BronzeSpec:
        return cls(
            name=entry["name"],
            format=entry.get("format", "parquet"),
            ingest=entry.get("ingest_type", "batch"),
            columns=_columns_from(entry.get("schema", ())),
            landing=entry.get("landing_path", ""),
            topic=entry.get("kafka", {}).get("topic_pattern", ""),
            partition_cols=tuple(entry.get("partition_cols", ())),
            merge_schema=entry.get("merge_schema", True),
        )


@dataclass(frozen=True)
class SilverSpec:
    """A refined table, the raw table it is fed from, and its load pattern."""

    name: str
    load: str
    source: str
    keys: tuple[str, ...]
    columns: Columns
    order_col: str | None = None  # recency column; event time for streaming_append
    sequence_col: str = "sequence_num"
    op_col: str = "op_type"
    delay: str = "10 minutes"
    rules: tuple[RangeRule, ...] = ()
    partition_cols: tuple[str, ...] = ()
    clustered: bool = True  # gather partition values before writing: fewer files, one shuffle
    table: str | None = None  # catalog table that accepts MERGE; refreshed in place
    # Split by key hash. Current state: a refresh rewrites only the buckets its feed touches.
    # History: a catalog table distributed by key, which appends need not shuffle.
    buckets: int | None = None
    bounded: bool = False  # streaming_append: forget a key once the watermark has passed it
    # streaming_append: look keys up in the table itself instead of keeping all of them as state.
    stateless: bool = False
    spread: bool = False  # streaming_append: thin very frequent keys per input split first
    read_options: Mapping[str, str] = field(default_factory=dict)  # of the raw table as a stream

    def __post_init__(self):
        if self.load not in LOADS:
            raise ValueError(f"unknown load pattern: {self.load!r}")
        if self.load in ("full_merge", "incremental_replace") and not self.order_col:
            raise ValueError(f"{self.load} needs order_col, the column that tells recency")
        if self.table and self.load == "streaming_append":
            raise ValueError("streaming_append appends to its own path; table= is for merged tables")
        if self.stateless and (self.load != "streaming_append" or self.bounded or self.spread):
            raise ValueError("stateless is for streaming_append, and leaves no state to bound or spread")
        if self.buckets and self.partition_cols and self.load in ("cdc_history", "append_dedup"):
            raise ValueError("a bucketed history is laid out by key: give buckets or partition_cols")

    @classmethod
    def from_config(cls, entry: Mapping) -> SilverSpec:
        return cls(
            name=entry["name"],
            load=entry["load_type"],
            source=entry["source"]["table"],
            keys=tuple(entry["merge_keys"]),
            columns=_columns_from(entry["schema"]),
            order_col=entry.get("watermark_col"),
            sequence_col=entry.get("cdc_sequence_col", "sequence_num"),
            op_col=entry.get("cdc_op_col", "op_type"),
            delay=entry.get("watermark_delay", "10 minutes"),
            rules=tuple(
                RangeRule(r["col"], r.get("min"), r.get("max")) for r in entry.get("filters", ())
            ),
            partition_cols=tuple(entry.get("partition_cols", ())),
        )

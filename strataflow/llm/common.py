"""Helpers shared by the corpus operators: written steps, ranks without a hot task, word hashes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.session import discard, scratch_dir


def written(df: DataFrame, label: str, per_file: int = 0) -> DataFrame:
    """``df`` as a table in the shared folder: it survives lost executors and is computed once.

    ``per_file`` bounds the rows of a file, and so what a reader of very large rows holds at once.
    """
    path = scratch_dir(df.sparkSession, label)
    (df.write.option("maxRecordsPerFile", per_file) if per_file else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def done_with(*tables: DataFrame) -> None:
    """Remove written tables that only tables already written were made from."""
    for df in tables:
        discard(df.sparkSession, df.scratch_path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(prefix: str) -> str:
    """A column name that no caller's column can clash with."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def ranked(df: DataFrame, by: list[Column], spot: Column, rows_total: int, weight: Column | None = None,
           per_bucket: int = 20_000) -> tuple[DataFrame, str, str]:
    """Number the rows of each group from 0 in the order of ``spot``, with the weight before each.

    ``spot`` is a long spread evenly over all its values (a seeded hash). A group is cut into ranges
    of it, so that a group of any size is numbered by many tasks: only one count and one weight per
    range meet in a group's window, and a range holds about ``per_bucket`` rows. Ties in ``spot``
    must have been broken by the caller; equal values are numbered in any order.

    Returns the frame and the names of the two new columns.
    """
    ranges = max(1, -(-rows_total // per_bucket))
    names = [fresh("by") for _ in by]
    at, cut, rank, before = fresh("at"), fresh("cut"), fresh("rank"), fresh("before")
    n, w, n0, w0 = fresh("n"), fresh("w"), fresh("n0"), fresh("w0")
    weight = F.lit(0).cast("long") if weight is None else weight
    rows = df.select("*", *[b.alias(c) for b, c in zip(by, names, strict=True)], spot.alias(at), weight.alias(w))
    # The upper 32 bits of the hash, as 0 .. 2^32 - 1, scaled to the ranges.
    upper = F.shiftright(F.col(at), 32) + F.lit(1 << 31)
    rows = rows.withColumn(cut, F.shiftright(upper * F.lit(ranges), 32))
    sums = rows.groupBy(*names, cut).agg(F.count(F.lit(1)).alias(n), F.sum(w).alias(n0))
    earlier = Window.partitionBy(*names).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(c).alias(c + "k") for c in names], F.col(cut).alias(cut + "k"),
        F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n),
        F.coalesce(F.sum(n0).over(earlier), F.lit(0)).alias(w0),
    )
    inside = Window.partitionBy(*names, cut).orderBy(at)
    rows = rows.select(
        "*", F.row_number().over(inside).alias(rank),
        F.sum(w).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(before),
    )
    match = F.col(cut) == F.col(cut + "k")
    for c in names:
        match = match & F.col(c).eqNullSafe(F.col(c + "k"))
    joined = rows.join(sums, match).select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col(n) + F.col(rank) - 1).alias(rank), (F.col(w0) + F.col(before) - F.col(w)).alias(before),
    )
    return joined, rank, before


# Words as hashes, computed for many texts at once.

_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = np.multiply.accumulate(np.full(1 << 14, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64))
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finishing steps of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_slice(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = ~_BLANK[data]
    edges = np.flatnonzero(np.diff(solid.astype(np.int8), prepend=0, append=0))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = ends - starts
    kept = data[solid]
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(kept)) - np.repeat(firsts, lengths)
    parts = (_ASCII_LOWER[kept].astype(np.uint64) + np.uint64(1)) * _POWERS[place & (len(_POWERS) - 1)]
    return mix(np.add.reduceat(parts, firsts) + lengths.astype(np.uint64)), starts


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word (run of non-blank bytes, A-Z in lower case) of UTF-8 text.

    Long texts are read in slices cut at blanks, so memory beyond the result stays bounded.
    """
    whole = np.frombuffer(data, np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(whole):
        end = min(len(whole), at + SLICE_BYTES)
        if end < len(whole):
            blanks = np.flatnonzero(_BLANK[whole[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
            else:  # one word longer than a slice
                rest = np.flatnonzero(_BLANK[whole[end:]])
                end = end + int(rest[0]) + 1 if len(rest) else len(whole)
        h, s = _hash_slice(whole[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def count_words(texts) -> np.ndarray:
    """Words (runs of non-blank bytes) of every text of an Arrow array; null has none."""
    import pyarrow as pa
    import pyarrow.compute as pc

    whole = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
    out, first = np.zeros(len(whole), np.int64), 0
    while first < len(whole):  # rows of about a slice at a time; a longer text alone
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1)
        solid = ~_BLANK[data[offsets[first] : offsets[last]]]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        cuts = offsets[first : last + 1] - offsets[first]
        inner = cuts[(cuts < len(solid))]
        begins[inner] = solid[inner]  # a text's first byte begins a word whatever stands before it
        sums = np.concatenate(([0], np.cumsum(begins, dtype=np.int64)))
        out[first:last] = np.diff(sums[cuts])
        first = last
    return out


def text_chunks(batch, column: str, most: int = SLICE_BYTES):
    """Row ranges of an Arrow batch with about ``most`` bytes of text each, as (first, [bytes])."""
    first, held, size = 0, [], 0
    for i, text in enumerate(batch.column(column)):
        held.append((text.as_py() or "").encode())
        size += len(held[-1])
        if size >= most:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers, wherever the driver imported it from."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        bundle = Path(tempfile.mkdtemp(prefix="strataflow-code-")) / "strataflow_llm.zip"
        with zipfile.ZipFile(bundle, "w") as out:
            for name in ("__init__.py", "session.py"):
                out.write(package / name, f"{package.name}/{name}")
            for path in sorted((package / "llm").glob("*.py")):
                out.write(path, f"{package.name}/llm/{path.name}")
        context.addPyFile(str(bundle))
        _SHIPPED.add(context.applicationId)
    return spark

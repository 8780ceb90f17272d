"""Stream deduplication, late rows, restarts, and the append sink."""

import json
import os
import time

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from strataflow.operators.audit import stream_counts
from strataflow.sinks.tables import append_stream
from strataflow.sources.tables import read_table, read_table_stream
from strataflow.spec import RangeRule, SilverSpec, build_schema, columns
from strataflow.streaming.append import stream_dedup, streaming_append, with_watermark

COLUMNS = columns("id string, at string, v double")
SPEC = SilverSpec(
    "reads", "streaming_append", "raw", ("id",),
    columns("id string, at timestamp, v double, absent string, _silver_created_at timestamp"),
    order_col="at", rules=(RangeRule("v", 0, 10), RangeRule("nowhere", 1, 2)),
)


def land(folder, *files):
    """One JSON file per argument, in reading order (files are read oldest first)."""
    folder.mkdir(exist_ok=True)
    for lines in files:
        number = len(list(folder.glob("*.json")))
        path = folder / f"{number:03d}.json"
        path.write_text("\n".join(
            json.dumps({"id": i, "at": f"2026-04-01T{at}:00", "v": v}) for i, at, v in lines))
        stamp = time.time() - 1000 + number
        os.utime(path, (stamp, stamp))


def source(spark, folder):
    reader = spark.readStream.schema(build_schema(COLUMNS)).option("maxFilesPerTrigger", 1)
    return reader.json(str(folder))


def drain(spark, stream, tmp_path, **options):
    query = append_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp", **options)
    query.awaitTermination()
    return query, read_table(spark, f"{tmp_path}/out", stream.schema)


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("bounded", [False, True])
def test_late_rows(spark, tmp_path, spread, bounded):
    """A batch is judged by the watermark of the batch before it: the first late row passes."""
    land(tmp_path / "in", [("a", "12:00", 1)], [("b", "11:30", 1)], [("c", "11:30", 1)],
         [("d", "12:01", 1)])
    stream = streaming_append(source(spark, tmp_path / "in"), SPEC, bounded=bounded, spread=spread)
    query, out = drain(spark, stream, tmp_path)
    assert rows(out, "id") == bag(("a",), ("b",), ("d",))
    assert stream_counts(query) == {"rows_read": 4, "rows_late": 1}


@pytest.mark.parametrize("spread", [False, True])
def test_filters_columns_and_dedup(spark, tmp_path, spread):
    land(tmp_path / "in",
         [("a", "12:00", 1), ("a", "12:00", 1), ("low", "12:00", -1), ("null", "12:00", None)],
         [("a", "12:01", 2), ("b", "12:01", 10)])
    stream = streaming_append(source(spark, tmp_path / "in"), SPEC, spread=spread)
    assert stream.columns == ["id", "at", "v", "_silver_created_at"]
    _, out = drain(spark, stream, tmp_path)
    assert rows(out, "id") == bag(("a",), ("b",))


@pytest.mark.parametrize("spread", [False, True])
def test_memory_of_keys(spark, tmp_path, spread):
    """The default never admits a key again; the bounded variant does once it has expired."""
    land(tmp_path / "in", [("a", "10:00", 1)], [("b", "12:00", 1)], [("c", "12:30", 1)],
         [("d", "13:00", 1)], [("a", "13:30", 1)])
    for bounded, n in ((False, 1), (True, 2)):
        stream = stream_dedup(with_watermark(source(spark, tmp_path / "in"), "at"), ["id"],
                              bounded=bounded, spread=spread)
        _, out = drain(spark, stream, tmp_path / f"{bounded}")
        assert out.filter("id = 'a'").count() == n


def test_restart_takes_only_new_files(spark, tmp_path):
    land(tmp_path / "in", [("a", "12:00", 1)])
    commits = []

    def run():
        stream = streaming_append(source(spark, tmp_path / "in"), SPEC)
        return drain(spark, stream, tmp_path, on_commit=lambda b, n: commits.append((b, n)))[1]

    assert rows(run(), "id") == bag(("a",))
    first = list(commits)
    assert sum(n for _, n in first) == 1
    assert rows(run(), "id") == bag(("a",))
    land(tmp_path / "in", [("a", "12:00", 1), ("b", "12:02", 1)])
    assert rows(run(), "id") == bag(("a",), ("b",))
    assert sum(n for _, n in commits) == 2


def test_a_replayed_commit_replaces_itself(spark, tmp_path):
    """A crash after the write and before the checkpoint's commit mark repeats the batch."""
    land(tmp_path / "in", [("a", "12:00", 1)], [("b", "12:01", 1)])
    stream = source(spark, tmp_path / "in")
    _, out = drain(spark, stream, tmp_path)
    assert out.count() == 2
    # The commit mark of batch 1 is missing, as after a crash.
    (tmp_path / "cp/commits/1").unlink()
    (tmp_path / "cp/commits/.1.crc").unlink(missing_ok=True)
    _, out = drain(spark, stream, tmp_path)
    assert rows(out, "id", "_batch_id") == bag(("a", 0), ("b", 1))


def test_partitioned_append_keeps_text_partitions(spark, tmp_path):
    land(tmp_path / "in", [("007", "12:00", 1), ("x y", "12:00", 2)])
    for clustered in (False, True):
        folder = tmp_path / f"{clustered}"
        stream = source(spark, tmp_path / "in")
        _, out = drain(spark, stream, folder, partition_cols=["id"], clustered=clustered)
        assert rows(out, "id", "v") == bag(("007", 1.0), ("x y", 2.0))
        assert (folder / "out/_batch_id=0/id=007").is_dir()


def test_trigger_is_a_parameter(spark, tmp_path):
    land(tmp_path / "in", [("a", "12:00", 1)])
    query = append_stream(source(spark, tmp_path / "in"), f"{tmp_path}/out", f"{tmp_path}/cp",
                          trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert read_table(spark, f"{tmp_path}/out", build_schema(COLUMNS)).count() == 1


def test_table_stream_reads_new_commits(spark, tmp_path):
    land(tmp_path / "in", [("a", "12:00", 1)])
    raw = source(spark, tmp_path / "in")
    drain(spark, raw, tmp_path)
    second = read_table_stream(spark, f"{tmp_path}/out", raw.schema)
    assert dict(second.dtypes)["_batch_id"] == "bigint"
    _, out = drain(spark, second, tmp_path / "next")
    assert rows(out, "id") == bag(("a",))
    land(tmp_path / "in", [("b", "12:00", 1)])
    drain(spark, raw, tmp_path)
    _, out = drain(spark, second, tmp_path / "next")
    assert rows(out, "id") == bag(("a",), ("b",))


def test_hot_key_is_thinned_before_it_meets(spark, tmp_path):
    """A third of all rows share one key; the first stage passes on one row per input split."""
    (spark.range(0, 30000, 1, 6)
     .select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
             F.lit("2026-04-01T12:00:00").alias("at"), F.lit(1.0).alias("v"))
     .write.json(f"{tmp_path}/in"))
    stream = stream_dedup(
        with_watermark(spark.readStream.schema(build_schema(COLUMNS)).json(f"{tmp_path}/in"), "at"),
        ["id"], spread=True)
    query, out = drain(spark, stream, tmp_path)
    assert out.count() == 20001
    # Operators are listed from the sink to the source.
    final, first = query.recentProgress[0]["stateOperators"]
    assert first["numRowsTotal"] <= 20000 + 6 and final["numRowsTotal"] == 20001

"""The folded ledger, published generations, and raw tables of topics parsed anew."""

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from strataflow.operators import control
from strataflow.plans import refresh
from strataflow.plans.refresh import Layout, full_refresh, ingest, promote, publish, read_bronze, read_silver, reparse_topic
from strataflow.sinks.tables import append_batch
from strataflow.spec import BronzeSpec, SilverSpec, build_schema, columns

RAW = columns("k long, v string")
BRONZE = BronzeSpec("t", "json", columns=RAW)
SILVER = SilverSpec("s", "append_dedup", "t", ("k",), RAW)


def log(spark, path, number, status=control.SUCCESS, pipeline="p"):
    control.log_run(spark, path, pipeline, "t", f"run{number}", status, notes=str(number))


def at(spark, path, status=control.SUCCESS, pipeline="p"):
    return control.ledger_position(control.read_ledger(spark, path, pipeline), pipeline, status)


def test_a_position_reads_one_fold_and_a_short_tail(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(control, "FOLD_AFTER", 4)
    path = str(tmp_path)
    assert at(spark, path) is None
    log(spark, path, 3, control.DRAINED)
    for number in range(14):
        log(spark, path, number)
        assert at(spark, path) == number
        assert len(control.read_ledger(spark, path, "p").inputFiles()) <= 1 + 2 * 4
    assert at(spark, path, control.DRAINED) == 3  # from a fold of a fold
    assert control.read_control(spark, path).count() == 15  # reports see every event once
    assert control.read_control(spark, f"{path}/p").count() == 15


def test_a_fold_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    for number in range(3):
        log(spark, path, number)
    (tmp_path / "p/e1/_fold").mkdir(parents=True)
    (tmp_path / "p/e1/_fold/part-0.parquet").write_text("cut")
    assert at(spark, path) == 2
    log(spark, path, 3)
    assert (tmp_path / "p/e0/run3-SUCCESS").exists()
    control.fold_ledger(spark, path, "p")
    assert at(spark, path) == 3
    log(spark, path, 4)
    assert (tmp_path / "p/e1/run4-SUCCESS").exists() and at(spark, path) == 4

    def fails(*_):
        raise OSError("no space")

    monkeypatch.setattr(control, "FOLD_AFTER", 1)
    monkeypatch.setattr(control, "fold_ledger", fails)
    log(spark, path, 5)  # a run does not fail for a fold
    assert at(spark, path) == 5


def test_an_event_written_beside_a_fold_is_seen_and_folded(spark, tmp_path):
    path = str(tmp_path)
    log(spark, path, 0)
    control.fold_ledger(spark, path, "p")
    late = spark.createDataFrame(
        [("p", "t", "late", None, 0, 0, control.SUCCESS, "7")], control.CONTROL_SCHEMA)
    late.write.parquet(f"{path}/p/e0/late-SUCCESS")
    assert at(spark, path) == 7
    for _ in range(2):
        control.fold_ledger(spark, path, "p")
    assert at(spark, path) == 7


def test_a_log_without_epochs_goes_on(spark, tmp_path):
    path = str(tmp_path)
    old = spark.createDataFrame([("p", "t", "old", None, 0, 0, control.SUCCESS, "9")], control.CONTROL_SCHEMA)
    old.write.parquet(f"{path}/p/old-SUCCESS")
    assert at(spark, path) == 9
    log(spark, path, 10)
    assert at(spark, path) == 10
    control.fold_ledger(spark, path, "p")
    log(spark, path, 2, control.FAILED)
    assert at(spark, path) == 10


def commit(spark, layout, number, *data):
    append_batch(spark.createDataFrame(list(data), build_schema(RAW)), layout.table("bronze", "t"), number)
    control.log_run(spark, layout.control, layout.pipeline("bronze", "t"), "t", f"raw{number}", control.SUCCESS,
                    notes=str(number))


def test_the_current_layout_follows_rebuilds_table_by_table(spark, tmp_path):
    root = str(tmp_path)
    first = Layout.current(spark, root)
    other = SilverSpec("other", "append_dedup", "t", ("k",), RAW)
    commit(spark, first, 0, (1, "a"))
    for spec in (SILVER, other):
        promote(spark, spec, BRONZE, first)
    fresh = full_refresh(spark, SILVER, BRONZE, first)
    now = Layout.current(spark, root)
    assert now == fresh and now.table("silver", "s").endswith("/g1")
    assert now.table("silver", "other").endswith("/g0") and now.table("bronze", "t").endswith("/g0")
    commit(spark, now, 1, (2, "b"))
    for spec in (SILVER, other):
        promote(spark, spec, BRONZE, now)
        assert rows(read_silver(spark, spec, now), "k") == bag((1,), (2,))
    publish(spark, first)  # back
    assert Layout.current(spark, root).table("silver", "s").endswith("/g0")
    assert full_refresh(spark, SILVER, BRONZE, Layout.current(spark, root)).table("silver", "s").endswith("/g2")
    with pytest.raises(ValueError, match="current"):
        publish(spark, Layout(root))


def test_a_rebuild_that_fails_is_not_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    layout = Layout.current(spark, root)
    commit(spark, layout, 0, (1, "a"))
    promote(spark, SILVER, BRONZE, layout)

    def fails(*_a, **_k):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(refresh, "_append", fails)
        with pytest.raises(OSError):
            full_refresh(spark, SILVER, BRONZE, layout)
    assert rows(read_silver(spark, SILVER, Layout.current(spark, root)), "k") == bag((1,))
    assert full_refresh(spark, SILVER, BRONZE, layout).table("silver", "s").endswith("/g1")


def records(spark, path, first, *texts):
    data = [("t", 0, first + i, b"key", None if x is None else x.encode()) for i, x in enumerate(texts)]
    df = spark.createDataFrame(data, "topic string, partition int, offset long, key binary, value binary")
    df = df.withColumn("timestamp", F.current_timestamp())
    df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


@pytest.mark.parametrize("partition_cols", [(), ("_ingested_date", "v")])
def test_a_topic_is_parsed_anew_and_followed_on(spark, tmp_path, partition_cols):
    root, path = f"{tmp_path}/lake", f"{tmp_path}/topic"
    early = BronzeSpec("t", "json", "streaming", columns("v string"), partition_cols=partition_cols)
    late = BronzeSpec("t", "json", "streaming", columns("v string, k long"), partition_cols=partition_cols)
    spec = SilverSpec("s", "append_dedup", "t", ("_kafka_offset",), columns("_kafka_offset long, v string, k long"))
    old = Layout.current(spark, root)
    with pytest.raises(LookupError):
        reparse_topic(spark, late, old)
    stream = records(spark, path, 0, '{"v":"a","k":1}', "oops", None, '{"v":"007","k":"x"}')
    ingest(spark, early, old, stream)
    records(spark, path, 4, '{"v":"b","k":3}')
    ingest(spark, early, old, stream)
    before = rows(read_bronze(spark, early, old), "_kafka_offset", "_ingested_at", "_raw_value", "_batch_id")
    fresh = full_refresh(spark, spec, late, old, reread_landing=True)
    assert fresh == Layout.current(spark, root) and fresh.generation("bronze", "t") == 1
    again = read_bronze(spark, late, fresh)
    assert rows(again, "_kafka_offset", "_ingested_at", "_raw_value", "_batch_id") == before
    assert rows(again, "v", "k") == bag(("a", 1), (None, None), (None, None), ("007", None), ("b", 3))
    events = control.read_control(spark, f"{fresh.control}/{fresh.pipeline('bronze', 't')}")
    assert rows(events.filter("status = 'COUNTED'"), "notes") == bag(('{"malformed": 1, "misfit": 1}',))
    records(spark, path, 5, '{"v":"c","k":4}')
    run = ingest(spark, late, fresh, stream)
    assert (run.rows_read, run.version) == (1, 2)
    assert promote(spark, spec, late, fresh).rows_read == 1
    assert read_silver(spark, spec, fresh).count() == 6
    assert rows(read_bronze(spark, early, old), "_kafka_offset", "_ingested_at", "_raw_value", "_batch_id") == before


def test_only_topics_have_payloads_to_parse(spark, tmp_path):
    with pytest.raises(ValueError, match="files"):
        reparse_topic(spark, BRONZE, Layout(str(tmp_path)))

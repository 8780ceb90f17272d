"""What a run must not lose: keys, committed rows, options."""

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from strataflow.functions.quality import unconverted
from strataflow.operators import control
from strataflow.operators.latest import latest_per_key
from strataflow.plans import refresh
from strataflow.plans.refresh import Layout, full_refresh, ingest, promote, read_bronze, read_silver
from strataflow.sinks import tables as sink
from strataflow.sinks.tables import append_batch
from strataflow.spec import BronzeSpec, SilverSpec, build_schema, columns

RAW = columns("order_id string, op_type string, sequence_num string")
BRONZE = BronzeSpec("orders", "json", columns=RAW)
SILVER = SilverSpec("orders_silver", "append_dedup", "orders", ("order_id",),
                    columns("order_id long, op_type string, sequence_num long"))


def commit(spark, layout, number, *data):
    append_batch(spark.createDataFrame(list(data), build_schema(RAW)), layout.table("bronze", "orders"), number)
    control.log_run(spark, layout.control, layout.pipeline("bronze", "orders"), "orders",
                    f"raw{number}", control.SUCCESS, notes=str(number))


@pytest.mark.parametrize("key", ["A-1", "1.5", "01", "9" * 30])
def test_a_key_that_does_not_convert_fails_the_run(spark, tmp_path, key):
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, (key, "I", "1"), ("2", "I", "1"))
    with pytest.raises(ValueError, match="order_id"):
        promote(spark, SILVER, BRONZE, layout)
    assert refresh.position(spark, layout, "silver", SILVER.name) is None


def test_other_values_become_null_and_are_counted(spark, tmp_path):
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, ("1", "I", "x"), ("2", "I", "3"), (None, "I", "y"))
    promote(spark, SILVER, BRONZE, layout)
    assert rows(read_silver(spark, SILVER, layout), "order_id", "sequence_num") == bag((1, None), (2, 3), (None, None))
    log = control.read_control(spark, layout.control).filter(F.col("status") == control.UNCONVERTED)
    assert rows(log, "rows_read", "notes") == bag((3, '{"sequence_num": 2}'))


def test_equal_types_are_not_counted(spark):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    assert unconverted(df, columns("k long, v string, absent long"), ["k"]) == {}


def test_a_lost_success_entry_hides_nothing(spark, tmp_path, monkeypatch):
    layout, landing = Layout(str(tmp_path / "lake")), str(tmp_path / "landing")
    spec = BronzeSpec("orders", "json", columns=RAW, landing=landing)
    spark.createDataFrame([("1", "I", "1")], build_schema(RAW)).write.json(landing)
    real = control.log_run

    def lost(*args, **kwargs):
        if args[5] == control.SUCCESS:
            raise OSError("no space")
        return real(*args, **kwargs)

    monkeypatch.setattr(control, "log_run", lost)
    with pytest.raises(OSError):
        ingest(spark, spec, layout)
    monkeypatch.undo()
    again = ingest(spark, spec, layout)
    assert (again.rows_read, again.version) == (0, 0)
    assert rows(read_bronze(spark, spec, layout), "order_id") == bag(("1",))


def test_a_success_event_that_cannot_be_written_raises(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("")
    control.log_run(spark, str(blocked), "p", "s", "r", control.STARTED)
    with pytest.raises(Exception):  # noqa: B017
        control.log_run(spark, str(blocked), "p", "s", "r", control.SUCCESS)


def test_no_checkpoint_no_batch(spark, tmp_path):
    assert sink.completed_batch(spark, str(tmp_path / "none")) is None


def test_options_a_catalog_merge_lacks_are_refused(spark, tmp_path, monkeypatch):
    asked = {}
    monkeypatch.setattr(sink, "merge_into", lambda *a, **k: asked.update(k))
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, ("1", "I", "1"))
    cols = columns("order_id long, op_type string, sequence_num long")
    spec = SilverSpec("t", "incremental_replace", "orders", ("order_id",), cols, order_col="sequence_num", table="t")
    with pytest.raises(ValueError, match="within_feed"):
        promote(spark, spec, BRONZE, layout, within_feed="keep")
    promote(spark, spec, BRONZE, layout, guard=True)
    assert asked["update_if"] is not None
    with pytest.raises(ValueError, match="generation"):
        full_refresh(spark, spec, BRONZE, layout)


def test_specs_that_cannot_work_are_refused():
    cols = columns("k long, d string")
    with pytest.raises(ValueError, match="table"):
        SilverSpec("t", "streaming_append", "s", ("k",), cols, order_col="k", table="t")
    with pytest.raises(ValueError, match="bucketed history"):
        SilverSpec("t", "cdc_history", "s", ("k",), cols, buckets=4, partition_cols=("d",))


def test_latest_per_key_takes_names_with_dots(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "`a.k` long, `a.v` long")
    assert rows(latest_per_key(df, ["a.k"], "a.v")) == bag((1, 2))


def test_rows_read_of_more_batches_than_spark_remembers(spark, tmp_path):
    layout, cols = Layout(str(tmp_path)), columns("reading_id string, event_ts timestamp")
    raw = BronzeSpec("readings", "json", columns=cols)
    for number in range(7):
        made = spark.range(number + 1).select(
            F.concat_ws("-", F.lit(number), "id").alias("reading_id"), F.lit("2026-05-01").cast("timestamp").alias("event_ts"))
        append_batch(made.coalesce(1), layout.table("bronze", "readings"), number)
    control.log_run(spark, layout.control, layout.pipeline("bronze", "readings"), "readings", "raw", control.SUCCESS, notes="6")
    spec = SilverSpec("read", "streaming_append", "readings", ("reading_id",), cols, order_col="event_ts",
                      read_options={"maxFilesPerTrigger": "1"})
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        run = promote(spark, spec, raw, layout)
    finally:
        spark.conf.set(key, before)
    assert run.rows_read == run.rows_written == 28


def test_roots_that_read_as_patterns_are_refused():
    with pytest.raises(ValueError, match="pattern"):
        Layout("/data/c[1]")

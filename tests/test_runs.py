"""Whole runs: the stock datasets end to end, incremental progress, failures, rebuild, replay."""

from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from helpers import bag, rows
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from strataflow.operators import control
from strataflow.operators.audit import batch_audit, table_row_counts
from strataflow.plans import refresh
from strataflow.plans.datasets import bronze_datasets, silver_datasets
from strataflow.plans.refresh import (
    Layout,
    full_refresh,
    ingest,
    lake_row_counts,
    promote,
    read_bronze,
    read_silver,
    start_ingest,
)
from strataflow.sinks import tables
from strataflow.sinks.tables import append_batch, save_as_table
from strataflow.spec import BronzeSpec, RangeRule, SilverSpec, build_schema, columns

ORDER = columns("order_id long, op_type string, sequence_num long")
BRONZE = BronzeSpec("orders", "json", columns=ORDER)


def silver(load="cdc_merge", **extra):
    keys = ("order_id", "sequence_num") if load == "cdc_history" else ("order_id",)
    return SilverSpec("orders_silver", load, "orders", keys, ORDER + columns(
        "_silver_created_at timestamp"), order_col="sequence_num", **extra)


def commit(spark, layout, number, *data):
    """One finished raw commit."""
    df = spark.createDataFrame(list(data), build_schema(ORDER))
    append_batch(df, layout.table("bronze", "orders"), number)
    control.log_run(spark, layout.control, layout.pipeline("bronze", "orders"), "orders",
                    f"raw{number}", control.SUCCESS, notes=str(number))


def stamp(day):
    return F.lit(f"2026-05-0{day}").cast("timestamp")


# --- incremental promotion


def test_second_run_reads_only_new_commits(spark, tmp_path):
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, (1, "I", 1), (2, "I", 1))
    first = promote(spark, silver(), BRONZE, layout, now=stamp(1))
    assert (first.rows_read, first.rows_written, first.version) == (2, 2, 0)
    commit(spark, layout, 1, (1, "U", 2), (3, "I", 1))
    second = promote(spark, silver(), BRONZE, layout, now=stamp(2))
    assert (second.rows_read, second.rows_written, second.version) == (2, 2, 1)
    idle = promote(spark, silver(), BRONZE, layout, now=stamp(3))
    assert (idle.rows_read, idle.rows_written, idle.version) == (0, 0, 1)
    got = read_silver(spark, silver(), layout)
    days = got.withColumn("day", F.to_date("_silver_created_at"))
    assert rows(days, "order_id", "op_type", "day") == bag(
        (1, "U", date(2026, 5, 1)), (2, "I", date(2026, 5, 1)), (3, "I", date(2026, 5, 2)))


def test_commit_beyond_the_logged_one_waits(spark, tmp_path):
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, (1, "I", 1))
    unfinished = spark.createDataFrame([(9, "I", 1)], build_schema(ORDER))
    append_batch(unfinished, layout.table("bronze", "orders"), 1)
    promote(spark, silver(), BRONZE, layout)
    assert rows(read_silver(spark, silver(), layout), "order_id") == bag((1,))
    assert read_bronze(spark, BRONZE, layout).count() == 1
    commit(spark, layout, 1, (9, "I", 1))
    promote(spark, silver(), BRONZE, layout)
    assert rows(read_silver(spark, silver(), layout), "order_id") == bag((1,), (9,))


@pytest.mark.parametrize("load, buckets", [
    ("full_merge", None), ("incremental_replace", None), ("cdc_merge", None), ("cdc_merge", 4),
    ("cdc_history", None), ("cdc_history", 4), ("append_dedup", None)])
def test_interrupted_run_can_be_repeated(spark, tmp_path, load, buckets, monkeypatch):
    """The table is written but the run is never logged; the next run gives the same table."""
    layout, spec = Layout(str(tmp_path)), silver(load, buckets=buckets)
    commit(spark, layout, 0, (1, "I", 1), (2, "I", 1))
    promote(spark, spec, BRONZE, layout)
    commit(spark, layout, 1, (1, "U", 2), (3, "I", 1))
    with monkeypatch.context() as patched:
        patched.setattr(control, "SUCCESS", "LOST")
        promote(spark, spec, BRONZE, layout)
    before = rows(read_silver(spark, spec, layout), "order_id", "sequence_num")
    assert before == bag((1, 1), (2, 1))
    promote(spark, spec, BRONZE, layout)
    want = {"cdc_history": bag((1, 1), (2, 1), (1, 2), (3, 1)),
            "append_dedup": bag((1, 1), (2, 1), (3, 1))}.get(load, bag((1, 2), (2, 1), (3, 1)))
    assert rows(read_silver(spark, spec, layout), "order_id", "sequence_num") == want


@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("buckets", [None, 8])
def test_storage_and_plan_do_not_change_the_result(spark, tmp_path, buckets, fits, monkeypatch):
    monkeypatch.setattr(refresh, "fits_broadcast", lambda df: fits)
    layout, spec = Layout(str(tmp_path)), silver(buckets=buckets)
    commit(spark, layout, 0, *[(i, "I", 1) for i in range(50)])
    promote(spark, spec, BRONZE, layout)
    commit(spark, layout, 1, *[(i, "D" if i % 2 else "U", 2) for i in range(40, 60)])
    run = promote(spark, spec, BRONZE, layout)
    assert (run.rows_read, run.rows_written) == (20, 15)
    want = [(i, "I", 1) for i in range(40)]
    want += [(i, "D" if i % 2 else "U", 2) for i in range(40, 50)]
    want += [(i, "U", 2) for i in range(50, 60, 2)]
    assert rows(read_silver(spark, spec, layout), "order_id", "op_type", "sequence_num") \
        == bag(*want)
    other = spark.newSession()
    for table in other.catalog.listTables():
        other.sql(f"DROP TABLE {table.name}")  # external: the data stays
    assert read_silver(other, spec, layout).count() == len(want)


def test_a_refresh_writes_only_the_buckets_it_touches(spark, tmp_path):
    """A feed of one key reads and writes one bucket; older versions stay readable."""
    layout = Layout(str(tmp_path))
    spec = silver(buckets=16, partition_cols=("op_type",))
    commit(spark, layout, 0, *[(i, "I", 1) for i in range(200)])
    promote(spark, spec, BRONZE, layout)
    path = Path(layout.table("silver", spec.name))
    assert len(list(path.glob("_batch_id=0/_bucket=*"))) == 16
    commit(spark, layout, 1, (7, "U", 2))
    assert promote(spark, spec, BRONZE, layout).rows_written == 1
    written = list(path.glob("_batch_id=1/_bucket=*"))
    assert len(written) == 1 and (written[0] / "op_type=U").is_dir()
    feed = read_silver(spark, spec, layout).filter("sequence_num = 2").select("order_id")
    untouched = [f for f in read_silver(spark, spec, layout).inputFiles() if "_batch_id=1" not in f]
    assert len({f.split("_bucket=")[1].split("/")[0] for f in untouched}) == 15
    assert rows(feed) == bag((7,))
    assert read_silver(spark, spec, layout).count() == 200
    old = tables.read_bucket_map(spark, str(path), 0, 16)
    assert set(old.values()) == {0} and set(tables.read_bucket_map(spark, str(path), 1, 16).values()) == {0, 1}
    commit(spark, layout, 2, (1000, "D", 1))  # inserts nothing, wherever it belongs
    assert promote(spark, spec, BRONZE, layout).rows_written == 0
    assert read_silver(spark, spec, layout).count() == 200
    with pytest.raises(ValueError, match="16 buckets"):
        read_silver(spark, silver(buckets=8), layout)


@pytest.mark.parametrize("load", ["cdc_merge", "full_merge", "cdc_history"])
def test_partition_values_keep_their_type(spark, tmp_path, load):
    layout, spec = Layout(str(tmp_path)), silver(load, partition_cols=("op_type",))
    commit(spark, layout, 0, (1, "007", 1))
    promote(spark, spec, BRONZE, layout)
    commit(spark, layout, 1, (2, "08", 1))
    promote(spark, spec, BRONZE, layout)
    assert rows(read_silver(spark, spec, layout), "order_id", "op_type") == bag(
        (1, "007"), (2, "08"))


@pytest.mark.parametrize("load, buckets", [
    ("cdc_merge", None), ("cdc_merge", 4), ("full_merge", None), ("cdc_history", None),
    ("cdc_history", 4)])
def test_empty_commits(spark, tmp_path, load, buckets):
    layout, spec = Layout(str(tmp_path)), silver(load, buckets=buckets)
    commit(spark, layout, 0)
    assert promote(spark, spec, BRONZE, layout).rows_written == 0
    assert read_silver(spark, spec, layout).count() == 0
    commit(spark, layout, 1, (1, "I", 1))
    assert promote(spark, spec, BRONZE, layout).rows_written == 1
    commit(spark, layout, 2)
    assert promote(spark, spec, BRONZE, layout).rows_written == 0
    assert rows(read_silver(spark, spec, layout), "order_id") == bag((1,))


@pytest.mark.parametrize("fits, buckets", [(True, None), (False, None), (True, 4)])
def test_append_plan_does_not_change_the_result(spark, tmp_path, fits, buckets, monkeypatch):
    monkeypatch.setattr(refresh, "fits_broadcast", lambda df: fits)
    layout, spec = Layout(str(tmp_path)), silver("cdc_history", buckets=buckets)
    commit(spark, layout, 0, (1, "I", 1), (1, "I", 1), (None, "I", 1), (None, "I", 1))
    promote(spark, spec, BRONZE, layout)
    commit(spark, layout, 1, (1, "I", 1), (1, "U", 2), (2, "I", 1))
    run = promote(spark, spec, BRONZE, layout)
    assert (run.rows_read, run.rows_written) == (3, 2)
    assert rows(read_silver(spark, spec, layout), "order_id", "sequence_num") == bag(
        (1, 1), (None, 1), (None, 1), (1, 2), (2, 1))


def test_continuous_ingest_logs_each_commit(spark, tmp_path):
    layout = Layout(f"{tmp_path}/lake")
    spec = BronzeSpec("orders", "json", columns=ORDER, landing=f"{tmp_path}/in")
    first = spark.createDataFrame([(1, "I", 1), (2, "I", 1)], build_schema(ORDER))
    first.coalesce(1).write.json(f"{tmp_path}/in")
    query = start_ingest(spark, spec, layout, trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        promote(spark, silver(), spec, layout)
        assert query.isActive
        second = spark.createDataFrame([(2, "U", 2)], build_schema(ORDER))
        second.coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        query.processAllAvailable()
        run = promote(spark, silver(), spec, layout)
    finally:
        query.stop()
    assert (run.rows_read, run.version) == (1, 1)
    assert rows(read_silver(spark, silver(), layout), "order_id", "op_type") == bag(
        (1, "I"), (2, "U"))


def test_declared_types_and_absent_columns(spark, tmp_path):
    """The refined table has every declared column, in its declared type."""
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, (1, "I", 1))
    spec = replace(silver(), columns=columns(
        "order_id string, op_type string, sequence_num integer, unit string"), keys=("order_id",))
    promote(spark, spec, BRONZE, layout)
    got = read_silver(spark, spec, layout)
    assert got.dtypes == [("order_id", "string"), ("op_type", "string"), ("sequence_num", "int"),
                          ("unit", "string")]
    assert rows(got) == bag(("1", "I", 1, None))


def test_columns_found_in_the_files(spark, tmp_path):
    """Nothing declared: the files' columns are taken, and later ones added."""
    layout, folder = Layout(f"{tmp_path}/lake"), f"{tmp_path}/in"
    spec = BronzeSpec("orders", "parquet", landing=folder)
    spark.createDataFrame([(1, "I", 1)], build_schema(ORDER)).coalesce(1).write.parquet(folder)
    ingest(spark, spec, layout)
    promote(spark, silver(), spec, layout)
    wider = spark.createDataFrame([(2, "I", 1, "x")], build_schema(ORDER + columns("note string")))
    wider.coalesce(1).write.mode("append").parquet(folder)
    ingest(spark, spec, layout)
    promote(spark, silver(), spec, layout)
    assert rows(read_bronze(spark, spec, layout), "order_id", "note") == bag((1, None), (2, "x"))
    assert rows(read_silver(spark, silver(), layout), "order_id", "op_type") == bag(
        (1, "I"), (2, "I"))


def test_topics_need_a_stream(spark, tmp_path):
    spec = BronzeSpec("sensors", "json", "streaming", ORDER, topic="sensors")
    with pytest.raises(ValueError, match="topic"):
        ingest(spark, spec, Layout(str(tmp_path)))


# --- the control log


def test_log_of_good_and_failed_runs(spark, tmp_path):
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, (1, "I", 1))
    promote(spark, silver(), BRONZE, layout)
    commit(spark, layout, 1, (1, "I", 1))
    with pytest.raises(Exception, match="no_such"):
        promote(spark, silver(), BRONZE, layout, no_such="option")
    log = control.read_control(spark, layout.control)
    mine = log.filter("pipeline_name = 'silver.orders_silver.g0'")
    assert rows(mine, "status") == bag(("STARTED",), ("SUCCESS",), ("STARTED",), ("FAILED",))
    assert {r[0] for r in mine.select(F.length("batch_id")).collect()} == {8}
    note = mine.filter("status = 'FAILED'").first()["notes"]
    assert "no_such" in note
    assert refresh.position(spark, layout, "silver", "orders_silver") == 0
    newest = control.recent_runs(log, 3).collect()
    assert len(newest) == 3
    assert [r["ingest_ts"] for r in newest] == sorted(
        (r["ingest_ts"] for r in newest), reverse=True)


def test_ledger_ignores_odd_notes_and_other_runs(spark):
    at = datetime(2026, 5, 1)
    log = spark.createDataFrame([
        ("p", "s", "1", at, 0, 0, "SUCCESS", "0"), ("p", "s", "2", at, 0, 0, "SUCCESS", "table=x"),
        ("p", "s", "3", at, 0, 0, "FAILED", "9"), ("q", "s", "4", at, 0, 0, "SUCCESS", "7"),
    ], control.CONTROL_SCHEMA)
    assert control.ledger_position(log, "p") == 0
    assert control.ledger_position(log, "absent") is None


def test_logging_never_fails_a_run(spark, tmp_path, caplog):
    (tmp_path / "file").write_text("not a folder")
    control.log_run(spark, f"{tmp_path}/file", "p", "s", "1", control.STARTED)
    assert "not written" in caplog.text
    assert control.read_control(spark, f"{tmp_path}/nothing").count() == 0


@pytest.mark.parametrize("load", ["full_merge", "incremental_replace", "cdc_merge", "cdc_history"])
def test_catalog_tables_are_merged_in_place(spark, tmp_path, load):
    """Up to the point where a plain parquet table refuses; the run is then logged as failed."""
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, (1, "I", 1))
    spec = silver(load, table=f"in_place_{load}")
    save_as_table(spark.createDataFrame([], build_schema(spec.columns)), spec.table,
                  f"{tmp_path}/t")
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO"):
        promote(spark, spec, BRONZE, layout)
    assert read_silver(spark, spec, layout).count() == 0
    assert refresh.position(spark, layout, "silver", spec.name) is None


# --- counts


def test_row_counts_warn_about_missing_tables(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/a")
    counted = table_row_counts(spark, {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b"})
    assert rows(counted) == bag(("a", 5), ("b", None))


def test_lake_row_counts_before_the_first_run(spark, tmp_path):
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, (1, "I", 1))
    counts = lake_row_counts(spark, layout, [BRONZE], [silver(), silver("cdc_history", buckets=4)])
    assert rows(counts) == bag(("bronze.orders", 1), ("silver.orders_silver", None))
    with pytest.raises(LookupError):
        read_silver(spark, silver(buckets=4), layout)


def test_batch_audit_small(spark):
    def at(minute):
        return datetime(2026, 4, 1, 12, minute)

    df = spark.createDataFrame([
        (0, "a", 1.0, at(30)), (0, "a", 1.0, at(30)), (0, "x", -1.0, at(30)),
        (0, "n", None, at(30)), (1, "a", 1.0, at(30)), (1, "late", 1.0, at(0)),
        (2, "late", 1.0, at(0)), (2, "late2", 1.0, at(0)), (2, "b", 1.0, at(31)),
    ], "_batch_id long, k string, v double, t timestamp")
    got = batch_audit(df, ["k"], [RangeRule("v", 0, 5)], "t", "10 minutes")
    # read, rejected, late, duplicate, written: late only from the third commit on
    assert rows(got) == bag((0, 4, 2, 0, 1, 1), (1, 2, 0, 0, 1, 1), (2, 3, 0, 2, 0, 1))
    plain = batch_audit(df, ["k"])
    assert rows(plain) == bag((0, 4, 0, 0, 1, 3), (1, 2, 0, 0, 1, 1), (2, 3, 0, 0, 1, 2))


# --- rebuild and replay


def test_full_refresh_deletes_nothing(spark, tmp_path):
    layout = Layout(str(tmp_path))
    commit(spark, layout, 0, (1, "I", 1), (2, "I", 1))
    promote(spark, silver(), BRONZE, layout)
    commit(spark, layout, 1, (2, "D", 2))
    promote(spark, silver(), BRONZE, layout)
    fresh = full_refresh(spark, silver(), BRONZE, layout)
    assert rows(read_silver(spark, silver(), fresh), "order_id") == bag((1,))
    assert rows(read_silver(spark, silver(), layout), "order_id", "op_type") == bag(
        (1, "I"), (2, "D"))
    commit(spark, layout, 2, (3, "I", 1))
    promote(spark, silver(), BRONZE, fresh)
    assert rows(read_silver(spark, silver(), fresh), "order_id") == bag((1,), (3,))


def test_full_refresh_from_landing(spark, tmp_path):
    layout = Layout(f"{tmp_path}/lake")
    spec = BronzeSpec("orders", "json", columns=ORDER, landing=f"{tmp_path}/in")
    spark.createDataFrame([(1, "I", 1)], build_schema(ORDER)).write.json(f"{tmp_path}/in")
    ingest(spark, spec, layout)
    promote(spark, silver(), spec, layout)
    fresh = full_refresh(spark, silver(), spec, layout, reread_landing=True)
    assert fresh == Layout(f"{tmp_path}/lake", 1, 1)
    assert rows(read_silver(spark, silver(), fresh), "order_id") == bag((1,))
    assert ingest(spark, spec, layout).rows_read == 0


def test_replay_range_gives_raw_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for day in (1, 2, 3):
        (tmp_path / f"in/2026-04-0{day}.json").write_text(
            f'{{"order_id":{day},"op_type":"I","sequence_num":1}}')
    spec = BronzeSpec("orders", "json", columns=ORDER, landing=f"{tmp_path}/in")
    got = refresh.replay_range(spark, spec, date(2026, 4, 2), date(2026, 4, 3))
    assert got.columns == refresh.bronze_schema(spec).names
    assert rows(got, "order_id") == bag((2,), (3,))


# --- the stock datasets, with landing volumes of one small run


def _land_stock(spark, folder, day):
    at = f"TIMESTAMP '2026-04-0{day} 00:00:00'"
    spark.range(120).selectExpr(
        "'P' || id product_id", "'S' || id % 80 sku", "'n' product_name", "'c' || id % 5 category",
        "'b' brand", "'kg' unit_of_measure", "3.5 + id price_eur", "true is_active",
        f"{at} effective_ts", f"{at} + INTERVAL 2 HOURS extract_ts",
    ).selectExpr("* EXCEPT (price_eur)", "CAST(price_eur AS double) price_eur").write.parquet(
        f"{folder}/product_catalog/2026-04-0{day}.parquet")
    spark.range(240).selectExpr(
        "'W-0' || id % 3 warehouse_id", "'S' || id div 3 sku", f"{at} snapshot_ts",
        f"{at} extract_ts", f"id + {day} available_units", "id % 7 reserved_units",
    ).write.parquet(f"{folder}/inventory/2026-04-0{day}.parquet")
    deleted = "(id + 1) % 9 = 0" if day == 2 else "false"
    spark.range(180).selectExpr(
        "'O' || id order_id", "'C' || id % 40 customer_id", "'NEW' order_status",
        "'web' || id % 3 sales_channel", "CAST(id AS double) order_total_eur", "id % 5 item_count",
        f"CASE WHEN {day} = 1 THEN 'I' WHEN {deleted} THEN 'D' ELSE 'U' END op_type",
        f"{at} op_ts", f"CAST({day} AS bigint) sequence_num", f"{deleted} is_deleted",
    ).write.json(f"{folder}/orders_cdc/2026-04-0{day}.json")


def _topic(spark, folder, name, payload, n):
    rows_in = spark.range(n).selectExpr(
        "CAST(id AS string) key", f"to_json(struct({payload})) value", f"'{name}' topic",
        "CAST(id % 4 AS int) partition", "id offset", "current_timestamp() timestamp")
    rows_in.selectExpr("CAST(key AS binary) key", "CAST(value AS binary) value", "topic",
                       "partition", "offset", "timestamp").write.parquet(f"{folder}/{name}")
    schema = spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}")


def test_stock_datasets_end_to_end(spark, tmp_path):
    layout, landing = Layout(f"{tmp_path}/lake"), f"{tmp_path}/landing"
    bronze, refined = bronze_datasets(landing), silver_datasets()
    images = tmp_path / "landing/field_images"
    images.mkdir(parents=True)
    for field in ("FIELD_N", "FIELD_S", "EAST", "WEST"):
        for seq in range(20):
            (images / f"img_{field}_20260401_{seq:03d}.jpg").write_bytes(b"\xff\xd8" + bytes(seq))
    sensor = (
        "'e' || id sensor_event_id, 'F' || id % 4 field_id, "
        "date_format(TIMESTAMP '2026-04-01 08:00:00' + make_interval(0,0,0,0,0,0,30 * id), "
        "\"yyyy-MM-dd'T'HH:mm:ss\") event_ts, "
        "CAST(CASE WHEN id = 7 THEN 99 ELSE 20 END AS double) temperature_c, "
        "40.0D soil_moisture_pct, 6.5D ph_level")
    app = (
        "'a' || id % 600 event_id, '2026-04-01T09:00:00' event_ts, 's' session_id, "
        "'c' customer_id, 't' || id % 5 event_type, 'p' product_id, 'web' channel")
    topics = {"sensors": _topic(spark, f"{tmp_path}/topics", "sensors", sensor, 400),
              "app_events": _topic(spark, f"{tmp_path}/topics", "app_events", app, 700)}

    for day in (1, 2):
        _land_stock(spark, landing, day)
        for spec in bronze.values():
            if spec.format in ("parquet", "json") and spec.ingest == "batch":
                spec = replace(spec, read_options={"recursiveFileLookup": "true"})
            ingest(spark, spec, layout, topics.get(spec.name))
        for spec in refined.values():
            promote(spark, spec, bronze[spec.source], layout)

    counts = lake_row_counts(spark, layout, bronze.values(), refined.values())
    assert {r["table"]: r["rows"] for r in counts.collect()} == {
        "bronze.product_catalog": 240, "bronze.inventory": 480, "bronze.orders_cdc": 360,
        "bronze.field_images": 80, "bronze.sensors": 400, "bronze.app_events": 700,
        "silver.product_current": 120, "silver.inventory_current": 240,
        "silver.orders_current": 180, "silver.orders_history": 360, "silver.field_images": 80,
        "silver.sensor_reads": 399, "silver.app_events": 600}
    tables = {n: read_silver(spark, s, layout) for n, s in refined.items()}
    for name, spec in refined.items():
        assert set(tables[name].columns) == {c for c, _ in spec.columns}
        kinds = dict(tables[name].dtypes)
        want = build_schema(spec.columns)
        assert all(kinds[f.name] == f.dataType.simpleString() for f in want)
    assert tables["orders_current"].filter("is_deleted").count() == 20
    assert rows(tables["product_current"].select(F.max("effective_ts"), F.min("effective_ts"))) \
        == bag((datetime(2026, 4, 2), datetime(2026, 4, 2)))
    assert tables["field_images"].filter("_field_id = 'FIELD_N'").count() == 20

    cold = full_refresh(spark, refined["orders_current"], bronze["orders_cdc"], layout)
    assert read_silver(spark, refined["orders_current"], cold).count() == 160

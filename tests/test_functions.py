from datetime import date, datetime

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from strataflow.functions import enrich, quality
from strataflow.spec import RangeRule, columns


def now():
    return F.lit("2026-05-01 10:00:00").cast("timestamp")


def test_image_names(spark):
    names = ["/a/img_A_B_20260401_007.jpg", "/a/x.jpg", "/a/img_N_20260401_1.jpg.bak",
             "/a/img_N_20261399_1.jpg", "/a/img_N_20260401_99999999999.jpg", "img_N_20260401_1.jpg"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    got = [tuple(r) for r in df.select(*enrich.image_name_fields(F.col("path"))).collect()]
    day = date(2026, 4, 1)
    assert got == [("A_B", day, 7), ("", None, None), ("N", day, 1), ("N", None, 1),
                   ("N", day, None), ("N", day, 1)]


def test_select_metadata_dispatch():
    assert enrich.select_metadata("streaming", "json") is enrich.with_kafka_metadata
    assert enrich.select_metadata("batch", "binaryFile") is enrich.with_image_metadata
    assert enrich.select_metadata("batch", "parquet") is enrich.with_file_metadata


def _records(spark, *values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "text string, offset long")
    return df.select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset", now().alias("timestamp"),
        F.lit(None).cast("binary").alias("key"), F.col("text").cast("binary").alias("value"))


def test_kafka_envelope_and_json(spark):
    cols = columns("id string, n long")
    source = _records(spark, '{"id":"a","n":1}', '{"id":"b","n":"x"}', "junk", None, '{"z":1}')
    parsed = enrich.parse_json_value(enrich.with_kafka_metadata(source, now()), cols)
    assert parsed.columns == [*enrich.ENVELOPE, "id", "n"]
    assert rows(parsed, "_kafka_offset", "id", "n") == bag(
        (0, "a", 1), (1, "b", None), (2, None, None), (3, None, None), (4, None, None))
    assert rows(parsed.filter(enrich.parse_failed(cols)), "_kafka_offset") == bag((2,), (4,))
    assert parsed.select("_ingested_date").first()[0] == date(2026, 5, 1)


def test_json_without_declared_fields_is_unchanged(spark):
    envelope = enrich.with_kafka_metadata(_records(spark, "{}"))
    assert enrich.parse_json_value(envelope, ()) is envelope


def test_event_time_from_text_and_zoneless(spark):
    df = spark.createDataFrame([("2026-04-01T08:00:30",), ("zz",), ("",), (None,)], "t string")
    got = [r[0] for r in enrich.parse_event_time(df, "t").collect()]
    assert got == [datetime(2026, 4, 1, 8, 0, 30), None, None, None]
    ntz = df.select(F.expr("TIMESTAMP_NTZ '2026-04-01 08:00:00'").alias("t"))
    assert dict(enrich.parse_event_time(ntz, "t").dtypes)["t"] == "timestamp"
    instants = df.select(now().alias("t"))
    assert enrich.parse_event_time(instants, "t") is instants


def test_silver_stamps(spark):
    df = spark.range(1)
    assert enrich.with_silver_metadata(df).columns == ["id", "_silver_modified_at"]
    both = enrich.with_silver_metadata(df, created=True, now=now())
    assert both.columns == ["id", "_silver_created_at", "_silver_modified_at"]


@pytest.mark.parametrize("rule, kept", [
    (RangeRule("v", 1, 3), {1.0, 3.0}),
    (RangeRule("v", min=3), {3.0, 9.0}),
    (RangeRule("v", max=0), {-1.0, 0.0}),
    (RangeRule("gone", 1, 3), {None, -1.0, 0.0, 1.0, 3.0, 9.0}),
])
def test_range_filter(spark, rule, kept):
    df = spark.createDataFrame([(x,) for x in (None, -1.0, 0.0, 1.0, 3.0, 9.0)], "v double")
    assert {r[0] for r in quality.range_filter(df, [rule]).collect()} == kept


def test_change_types(spark):
    kinds = ["insert", "update_preimage", "update_postimage", "delete", None]
    df = spark.createDataFrame([(k,) for k in kinds], "_change_type string")
    assert rows(quality.change_type_filter(df)) == bag(("insert",), ("update_postimage",))


def test_contract(spark):
    df = spark.createDataFrame([("7", "x", 1), ("bad", "y", 2)], "a string, b string, extra int")
    contract = columns("c date, a int, b string")
    fitted = quality.conform_to_contract(df, contract)
    assert fitted.dtypes == [("c", "date"), ("a", "int"), ("b", "string")]
    assert rows(fitted) == bag((None, 7, "x"), (None, None, "y"))
    assert quality.conform_to_contract(df, contract, keep_extra=True).columns[-1] == "extra"
    assert quality.conform_columns(df, contract).columns == ["a", "b"]

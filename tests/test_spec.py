import pytest
from pyspark.sql import types as T

from strataflow.plans.datasets import bronze_datasets, silver_datasets
from strataflow.session import configure, scratch_dir, shared_dir
from strataflow.spec import BronzeSpec, RangeRule, SilverSpec, build_schema, columns


def test_schema_is_nullable_and_widens_float():
    schema = build_schema(columns("a string, b FLOAT, c int, d date, e binary, f bool"))
    assert [f.dataType for f in schema] == [
        T.StringType(), T.DoubleType(), T.IntegerType(), T.DateType(), T.BinaryType(),
        T.BooleanType()]
    assert all(f.nullable for f in schema)


def test_no_columns_means_no_schema():
    assert build_schema([]) is None


def test_unknown_type_and_load_are_errors():
    with pytest.raises(KeyError):
        build_schema(columns("a decimal"))
    with pytest.raises(ValueError):
        SilverSpec("x", "upsert", "y", ("k",), ())
    with pytest.raises(ValueError):
        SilverSpec("x", "full_merge", "y", ("k",), ())


def test_specs_from_config_entries():
    bronze = BronzeSpec.from_config({
        "name": "sensors", "ingest_type": "streaming", "format": "json",
        "kafka": {"topic_pattern": "plant.sensors"}, "partition_cols": ["_ingested_date"],
        "schema": [{"name": "id", "type": "string"}]})
    assert (bronze.topic, bronze.columns) == ("plant.sensors", (("id", "string"),))
    silver = SilverSpec.from_config({
        "name": "reads", "load_type": "streaming_append", "source": {"table": "sensors"},
        "merge_keys": ["id"], "watermark_col": "at", "watermark_delay": "5 minutes",
        "filters": [{"col": "t", "min": -10}], "schema": [{"name": "id", "type": "string"}]})
    assert silver.rules == (RangeRule("t", -10, None),)
    assert (silver.order_col, silver.delay) == ("at", "5 minutes")


def test_stock_datasets():
    bronze, silver = bronze_datasets("/landing"), silver_datasets()
    assert len(bronze) == 6 and len(silver) == 7
    assert all(s.source in bronze for s in silver.values())
    names = {s.name: {c for c, _ in s.columns} for s in silver.values()}
    for spec in silver.values():
        assert set(spec.keys) | set(spec.partition_cols) <= names[spec.name]


def test_session_settings(spark):
    configure(spark, largest_shuffle=20 * 2**40)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert spark.conf.get(key) == "163840"
    finally:
        spark.conf.unset(key)
    assert scratch_dir(spark, "x").startswith(shared_dir(spark))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")

"""The stock datasets: six raw tables and the seven refined tables fed from them."""

from __future__ import annotations

from ..spec import BronzeSpec, RangeRule, SilverSpec, columns

# Column lists, keys, ranges and partitioning of the stock datasets.
PRODUCT = columns(
    "product_id string, sku string, product_name string, category string, brand string, "
    "unit_of_measure string, price_eur double, is_active boolean, effective_ts timestamp, "
    "extract_ts timestamp"
)
INVENTORY = columns(
    "warehouse_id string, sku string, snapshot_ts timestamp, extract_ts timestamp, "
    "available_units long, reserved_units long"
)
ORDER_EVENT = columns(
    "order_id string, customer_id string, order_status string, sales_channel string, "
    "order_total_eur double, item_count long, op_type string, op_ts timestamp, "
    "sequence_num long, is_deleted boolean"
)
SENSOR = columns(
    "sensor_event_id string, field_id string, event_ts string, temperature_c double, "
    "soil_moisture_pct double, ph_level double"
)
APP_EVENT = columns(
    "event_id string, event_ts string, session_id string, customer_id string, "
    "event_type string, product_id string, channel string"
)
STATE_STAMPS = columns(
    "_silver_created_at timestamp, _silver_modified_at timestamp, _source_file string"
)
STREAM_STAMPS = columns("_ingested_date date, _kafka_offset long, _silver_created_at timestamp")
SENSOR_RANGES = (
    RangeRule("temperature_c", -10, 60),
    RangeRule("soil_moisture_pct", 0, 100),
    RangeRule("ph_level", 0, 14),
)


def bronze_datasets(landing: str) -> dict[str, BronzeSpec]:
    """Raw tables; file datasets read ``<landing>/<name>``."""

    def files(name, fmt, cols, *partition_cols, merge_schema=True):
        return BronzeSpec(
            name=name, format=fmt, columns=cols, landing=f"{landing}/{name}",
            partition_cols=partition_cols, merge_schema=merge_schema,
        )

    def topic(name, cols, *partition_cols):
        return BronzeSpec(
            name=name, format="json", ingest="streaming", columns=cols, topic=name,
            partition_cols=partition_cols,
        )

    specs = [
        files("product_catalog", "parquet", PRODUCT, "_ingested_date"),
        files("inventory", "parquet", INVENTORY, "warehouse_id", "_ingested_date"),
        files("orders_cdc", "json", ORDER_EVENT, "_ingested_date"),
        files("field_images", "binaryFile", (), "_field_id", "_capture_date", merge_schema=False),
        topic("sensors", SENSOR, "_ingested_date", "field_id"),
        topic("app_events", APP_EVENT, "_ingested_date", "event_type"),
    ]
    return {s.name: s for s in specs}


def _event_time_typed(cols):
    return tuple((n, "timestamp" if n == "event_ts" else kind) for n, kind in cols)


def silver_datasets() -> dict[str, SilverSpec]:
    """Refined tables, one per load pattern in use.

    Only the streamed tables gather partition values before writing. The current-state tables have
    few of them, and the appended ones are fed from raw tables already laid out that way.
    """
    specs = [
        SilverSpec(
            "product_current", "full_merge", "product_catalog", ("product_id",),
            PRODUCT + STATE_STAMPS, order_col="effective_ts", partition_cols=("category",),
            clustered=False,
        ),
        SilverSpec(
            "inventory_current", "incremental_replace", "inventory", ("warehouse_id", "sku"),
            INVENTORY + STATE_STAMPS, order_col="snapshot_ts", partition_cols=("warehouse_id",),
            clustered=False,
        ),
        SilverSpec(
            "orders_current", "cdc_merge", "orders_cdc", ("order_id",),
            ORDER_EVENT + STATE_STAMPS, order_col="op_ts", partition_cols=("sales_channel",),
            clustered=False,
        ),
        SilverSpec(
            "orders_history", "cdc_history", "orders_cdc", ("order_id", "sequence_num"),
            ORDER_EVENT + columns(
                "_ingested_date date, _silver_created_at timestamp, _source_file string"
            ),
            order_col="op_ts", partition_cols=("_ingested_date",), clustered=False,
        ),
        SilverSpec(
            "field_images", "append_dedup", "field_images", ("_source_file",),
            columns(
                "_source_file string, _field_id string, _capture_date date, _image_seq integer, "
                "_file_size_bytes long, _source_modified_at timestamp, content binary, "
                "_silver_created_at timestamp"
            ),
            partition_cols=("_field_id", "_capture_date"), clustered=False,
        ),
        SilverSpec(
            "sensor_reads", "streaming_append", "sensors", ("sensor_event_id",),
            _event_time_typed(SENSOR) + STREAM_STAMPS, order_col="event_ts",
            rules=SENSOR_RANGES, partition_cols=("field_id", "_ingested_date"),
        ),
        SilverSpec(
            "app_events", "streaming_append", "app_events", ("event_id",),
            _event_time_typed(APP_EVENT) + STREAM_STAMPS, order_col="event_ts",
            partition_cols=("event_type", "_ingested_date"),
        ),
    ]
    return {s.name: s for s in specs}

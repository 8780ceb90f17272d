"""Inputs of the registered queries, derived from the given tables.

One text serves both engines: ``{part}`` is a DataFrame for Spark and a table name for the SQL
check. Every input covers its whole tables.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

# feed_no 1 = base, 2 = newer price, 3 = stale price
PRODUCT_FEED = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
       p_retailprice AS price, 1 AS feed_no, CAST('2026-04-01' AS DATE) AS effective_date
FROM {part}
UNION ALL
SELECT p_partkey, p_name, p_type, p_brand, p_retailprice + 10.0, 2, CAST('2026-04-02' AS DATE)
FROM {part} WHERE p_partkey % 3 = 0
UNION ALL
SELECT p_partkey, p_name, p_type, p_brand, p_retailprice - 10.0, 3, CAST('2026-03-31' AS DATE)
FROM {part} WHERE p_partkey % 5 = 0
"""

INVENTORY_SNAP = """
SELECT l_suppkey % 3 AS warehouse_id, l_partkey AS sku, CAST(l_shipdate AS DATE) AS snapshot_date,
       l_orderkey, l_linenumber, l_quantity AS available_units, l_discount AS reserved_rate
FROM {lineitem}
"""

# Keys ending in 7 have no insert (orphan D or U); multiples of 27 are revived by sequence 3.
ORDERS_CDC = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'CREATED' AS order_status,
       o_orderpriority AS sales_channel, o_totalprice AS order_total, 'I' AS op_type,
       1 AS sequence_num, false AS is_deleted
FROM {orders} WHERE o_orderkey % 10 <> 7
UNION ALL
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 9 = 0 THEN 'CANCELLED' ELSE 'SHIPPED' END,
       o_orderpriority, o_totalprice, CASE WHEN o_orderkey % 9 = 0 THEN 'D' ELSE 'U' END, 2,
       o_orderkey % 9 = 0
FROM {orders}
UNION ALL
SELECT o_orderkey, o_custkey, 'REOPENED', o_orderpriority, o_totalprice, 'U', 3, false
FROM {orders} WHERE o_orderkey % 27 = 0
"""

# Every fourth event appears twice, as an exact copy.
SENSOR_EVENTS = """
SELECT event_id, event_type AS field_id, ts AS event_ts, value AS reading, user_id FROM {events}
UNION ALL
SELECT event_id, event_type, ts, value, user_id FROM {events} WHERE event_id % 4 = 0
"""

# Text dates of the events; one in ten names does not match the image pattern.
IMAGE_NAMES_SPARK = """
SELECT concat('img_', event_type, '_', date_format(ts, 'yyyyMMdd'), '_', event_id, '.jpg') AS name
FROM {events}
UNION ALL
SELECT concat('x_', event_id, '.jpg') FROM {events} WHERE event_id % 10 = 0
"""
IMAGE_NAMES_SQL = """
SELECT concat('img_', event_type, '_', strftime(ts, '%Y%m%d'), '_', event_id, '.jpg') AS name
FROM {events}
UNION ALL
SELECT concat('x_', event_id, '.jpg') FROM {events} WHERE event_id % 10 = 0
"""

KAFKA_ROWS = """
SELECT CAST('events' AS STRING) AS topic, CAST(event_id % 4 AS INT) AS partition,
       event_id AS offset, CAST(ts AS TIMESTAMP) AS timestamp,
       CAST(CAST(user_id AS STRING) AS BINARY) AS key, CAST(props AS BINARY) AS value
FROM {events}
"""

CONTROL_LOG = """
SELECT 'silver.' || event_type AS pipeline_name, event_type AS source_name,
       CAST(event_id AS STRING) AS batch_id, ts AS ingest_ts, user_id AS rows_read,
       user_id AS rows_written,
       CASE event_id % 3 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       CASE WHEN event_id % 7 = 0 THEN 'no number' ELSE CAST(event_id AS STRING) END AS notes
FROM {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _names(text: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(text) if name})


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The input as a DataFrame over the parquet tables in ``sf_dir``."""
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in _names(text)})


def as_sql(text: str) -> str:
    """The input as a SQL subquery over tables of the same names."""
    return text.format(**{n: n for n in _names(text)}).strip()

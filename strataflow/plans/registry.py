"""Registered queries: each operator over whole tables, and the SQL that must give the same rows.

Instants are returned as text or dates, so that both engines compare equal. Queries that write do
so below the session's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import enrich, quality
from ..operators import audit, control, latest, merge
from ..operators.size import fits_broadcast
from ..session import scratch_dir
from ..sinks import tables as sink
from ..sources import tables as source
from ..sources.tables import BATCH, read_table
from ..spec import BronzeSpec, RangeRule, SilverSpec, build_schema, columns
from ..streaming.append import stream_dedup, streaming_append, with_watermark
from . import fixtures as fx
from . import refresh
from .fixtures import as_sql, derive, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that must agree, if there is any."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql.strip()
        return run

    return register


# --- SQL building blocks ------------------------------------------------------------------------


def latest_sql(source: str, keys: str, *order: str) -> str:
    ranked = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (
        f"SELECT * FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {ranked}) = 1"
    )


def merge_sql(state: str, staged: str, keys: list[str], update_if: str, insert_if: str) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return f"""
    SELECT s.* FROM {staged} s LEFT JOIN {state} t ON {on}
    WHERE CASE WHEN t.{keys[0]} IS NULL THEN {insert_if} ELSE {update_if} END
    UNION ALL
    SELECT t.* FROM {state} t LEFT JOIN {staged} s ON {on}
    WHERE s.{keys[0]} IS NULL OR NOT coalesce({update_if}, false)
    """


PRODUCT_ORDER = ("effective_date", "product_name", "category", "brand", "price", "feed_no")
INVENTORY_ORDER = (
    "snapshot_date", "l_orderkey", "l_linenumber", "available_units", "reserved_rate",
)
CDC_ORDER = (
    "sequence_num", "customer_id", "order_status", "sales_channel", "order_total", "op_type",
    "is_deleted",
)
CDC_COLUMNS = columns(
    "order_id long, customer_id long, order_status string, sales_channel string, "
    "order_total double, op_type string, sequence_num integer, is_deleted boolean"
)
SENSOR_COLUMNS = columns(
    "event_id long, field_id string, event_ts timestamp, reading double, user_id long"
)
READING_RULES = (RangeRule("reading", 5, 60), RangeRule("not_in_this_feed", 0, 1))
READINGS = ["event_id", "field_id", "reading", "user_id"]


def cdc_sql(first: str, then: str) -> str:
    """The state after loading one part of the change feed, then another."""
    state = latest_sql(f"(SELECT * FROM feed WHERE {first})", "order_id", *CDC_ORDER)
    staged = latest_sql(f"(SELECT * FROM feed WHERE {then})", "order_id", *CDC_ORDER)
    merged = merge_sql("state", "staged", ["order_id"],
                       "s.sequence_num >= t.sequence_num", "s.op_type <> 'D'")
    return f"""
    WITH feed AS ({as_sql(fx.ORDERS_CDC)}),
    state AS (SELECT * FROM ({state}) WHERE op_type <> 'D'),
    staged AS ({staged})
    {merged}
    """


CDC_WARM = cdc_sql("sequence_num = 1", "sequence_num > 1")
CDC_COLD = f"""
WITH feed AS ({as_sql(fx.ORDERS_CDC)})
SELECT * FROM ({latest_sql("feed", "order_id", *CDC_ORDER)}) WHERE op_type <> 'D'
"""
DISTINCT_READINGS = f"""
SELECT DISTINCT event_id, field_id, reading, user_id FROM ({as_sql(fx.SENSOR_EVENTS)})
WHERE reading >= 5 AND reading <= 60
"""


# --- Latest row and merges ----------------------------------------------------------------------


@query(f"WITH feed AS ({as_sql(fx.PRODUCT_FEED)}) "
       + latest_sql("feed", "product_id", *PRODUCT_ORDER))
def latest_per_key(spark, sf_dir):
    feed = derive(spark, sf_dir, fx.PRODUCT_FEED)
    return latest.latest_per_key(feed, ["product_id"], "effective_date")


@query(f"""
WITH feed AS ({as_sql(fx.PRODUCT_FEED)}),
state AS (SELECT * FROM feed WHERE feed_no = 1),
staged AS ({latest_sql("(SELECT * FROM feed WHERE feed_no > 1)", "product_id", *PRODUCT_ORDER)})
{merge_sql("state", "staged", ["product_id"], "s.effective_date >= t.effective_date", "true")}
""")
def full_merge(spark, sf_dir):
    feed = derive(spark, sf_dir, fx.PRODUCT_FEED)
    return merge.full_merge(
        feed.filter("feed_no = 1"), feed.filter("feed_no > 1"), ["product_id"], "effective_date"
    )


@query(f"""
WITH feed AS ({as_sql(fx.PRODUCT_FEED)}),
state AS (SELECT *, DATE '2026-05-01' AS created, DATE '2026-05-01' AS modified
          FROM feed WHERE feed_no = 1),
staged AS (SELECT *, DATE '2026-05-02' AS created, DATE '2026-05-02' AS modified FROM (
    {latest_sql("(SELECT * FROM feed WHERE feed_no > 1)", "product_id", *PRODUCT_ORDER)}))
SELECT s.product_id, s.price, coalesce(t.created, s.created) AS created, s.modified
FROM staged s LEFT JOIN state t ON t.product_id = s.product_id
WHERE t.product_id IS NULL OR s.effective_date >= t.effective_date
UNION ALL
SELECT t.product_id, t.price, t.created, t.modified
FROM state t LEFT JOIN staged s ON t.product_id = s.product_id
WHERE s.product_id IS NULL OR s.effective_date < t.effective_date
""")
def merge_stamps(spark, sf_dir):
    feed = derive(spark, sf_dir, fx.PRODUCT_FEED)

    def stamped(rows, day):
        now = F.lit(day).cast("timestamp")
        return enrich.with_silver_metadata(rows, created=True, now=now)

    merged = merge.full_merge(
        stamped(feed.filter("feed_no = 1"), "2026-05-01"),
        stamped(feed.filter("feed_no > 1"), "2026-05-02"),
        ["product_id"], "effective_date",
    )
    return merged.select(
        "product_id", "price",
        F.to_date("_silver_created_at").alias("created"),
        F.to_date("_silver_modified_at").alias("modified"),
    )


@query(f"""
WITH feed AS ({as_sql(fx.INVENTORY_SNAP)}),
state AS ({latest_sql("(SELECT * FROM feed WHERE l_orderkey % 2 = 1)", "warehouse_id, sku",
                      *INVENTORY_ORDER)}),
staged AS ({latest_sql("(SELECT * FROM feed WHERE l_orderkey % 2 = 0)", "warehouse_id, sku",
                       *INVENTORY_ORDER)})
{merge_sql("state", "staged", ["warehouse_id", "sku"], "true", "true")}
""")
def incremental_replace(spark, sf_dir):
    feed = derive(spark, sf_dir, fx.INVENTORY_SNAP)
    keys = ["warehouse_id", "sku"]
    state = merge.incremental_replace(
        None, feed.filter("l_orderkey % 2 = 1"), keys, "snapshot_date")
    return merge.incremental_replace(
        state, feed.filter("l_orderkey % 2 = 0"), keys, "snapshot_date")


@query(CDC_COLD)
def cdc_merge_cold(spark, sf_dir):
    return merge.cdc_merge(None, derive(spark, sf_dir, fx.ORDERS_CDC), ["order_id"])


@query(CDC_WARM)
def cdc_merge_warm(spark, sf_dir):
    feed = derive(spark, sf_dir, fx.ORDERS_CDC)
    state = merge.cdc_merge(None, feed.filter("sequence_num = 1"), ["order_id"])
    return merge.cdc_merge(state, feed.filter("sequence_num > 1"), ["order_id"])


@query(cdc_sql("sequence_num < 3", "sequence_num = 3"))
def cdc_merge_small_feed(spark, sf_dir):
    """Broadcasts the reduced feed when it is measured small, else shuffles."""
    feed = derive(spark, sf_dir, fx.ORDERS_CDC)
    state, staged = scratch_dir(spark, "state"), scratch_dir(spark, "staged")
    merge.cdc_merge(None, feed.filter("sequence_num < 3"), ["order_id"]).write.parquet(state)
    changes = latest.latest_per_key(
        feed.filter("sequence_num = 3"), ["order_id"], "sequence_num")
    changes.write.parquet(staged)
    changes = spark.read.parquet(staged)
    return merge.cdc_merge(
        spark.read.parquet(state), changes, ["order_id"], small_feed=fits_broadcast(changes))


@query(cdc_sql("sequence_num < 3", "sequence_num = 3"))
def cdc_merge_buckets(spark, sf_dir):
    """State split by key hash; only the buckets the feed touches are read and rewritten."""
    feed, keys, buckets = derive(spark, sf_dir, fx.ORDERS_CDC), ["order_id"], 8
    path = scratch_dir(spark, "state")
    first = merge.cdc_merge(None, feed.filter("sequence_num < 3"), keys)
    sink.overwrite_buckets(
        sink.with_bucket(first, keys, buckets), path, scratch_dir(spark, "buckets"))
    changes = feed.filter("sequence_num = 3")
    touched = sink.touched_buckets(changes, keys, buckets)
    state = spark.read.parquet(path).filter(F.col(sink.BUCKET).isin(touched)).drop(sink.BUCKET)
    merged = merge.cdc_merge(state, changes, keys)
    sink.overwrite_buckets(
        sink.with_bucket(merged, keys, buckets), path, scratch_dir(spark, "buckets"))
    return spark.read.parquet(path).drop(sink.BUCKET)


@query(CDC_WARM)
def cdc_merge_saved_table(spark, sf_dir):
    """State registered as a catalog table bucketed by key: the merge shuffles only the feed."""
    feed, path = derive(spark, sf_dir, fx.ORDERS_CDC), scratch_dir(spark, "table")
    name, reduced = sink.bucketed_name("orders", path), scratch_dir(spark, "staged")
    state = merge.cdc_merge(None, feed.filter("sequence_num = 1"), ["order_id"])
    sink.save_as_table(state, name, path, bucket_by=(8, ["order_id"]))
    changes = feed.filter("sequence_num > 1")
    latest.latest_per_key(changes, ["order_id"], "sequence_num").write.parquet(reduced)
    staged = spark.read.parquet(reduced)
    return merge.cdc_merge(spark.table(name), staged, ["order_id"], reduced=True)


@query(as_sql(fx.ORDERS_CDC))
def cdc_history(spark, sf_dir):
    feed, keys = derive(spark, sf_dir, fx.ORDERS_CDC), ["order_id", "sequence_num"]
    history = merge.cdc_history(None, feed.filter("sequence_num <= 2"), keys)
    return merge.cdc_history(history, feed.filter("sequence_num >= 2"), keys)


INSERTED = f"""
WITH feed AS ({as_sql(fx.ORDERS_CDC)}),
staged AS ({latest_sql("(SELECT * FROM feed WHERE sequence_num > 1)", "order_id",
                       "customer_id", "order_status", "sales_channel", "order_total", "op_type",
                       "sequence_num", "is_deleted")})
SELECT * FROM staged
WHERE order_id NOT IN (SELECT order_id FROM feed WHERE sequence_num = 1)
"""


@query(INSERTED)
def insert_if_absent(spark, sf_dir):
    feed = derive(spark, sf_dir, fx.ORDERS_CDC)
    return merge.insert_if_absent(
        feed.filter("sequence_num = 1"), feed.filter("sequence_num > 1"), ["order_id"])


@query(INSERTED)
def insert_if_absent_wide(spark, sf_dir):
    """The plan for wide rows: clashing keys first, and if few, nothing else is shuffled."""
    feed, keys = derive(spark, sf_dir, fx.ORDERS_CDC), ["order_id"]
    held, fed = feed.filter("sequence_num = 1"), feed.filter("sequence_num > 1")
    path = scratch_dir(spark, "contested")
    merge.contested_keys(held, fed, keys).write.parquet(path)
    contested = spark.read.parquet(path)
    return merge.insert_if_absent(
        held, fed, keys, contested=contested if fits_broadcast(contested) else None)


@query(INSERTED)
def insert_if_absent_bucketed(spark, sf_dir):
    """The table is stored distributed by key; only the feed is shuffled."""
    feed, bucket_by = derive(spark, sf_dir, fx.ORDERS_CDC), (8, ["order_id"])
    path = scratch_dir(spark, "table")
    name = sink.bucketed_name("orders_history", path)
    sink.append_bucketed(feed.filter("sequence_num = 1"), name, path, 0, bucket_by)
    reduced = scratch_dir(spark, "staged")
    merge.distinct_keys(feed.filter("sequence_num > 1"), ["order_id"]).write.parquet(reduced)
    return merge.insert_if_absent(
        spark.table(name), spark.read.parquet(reduced), ["order_id"], within_feed="reduced")


@query(f"SELECT DISTINCT name FROM ({as_sql(fx.IMAGE_NAMES_SQL)})")
def append_dedup(spark, sf_dir):
    names = derive(spark, sf_dir, fx.IMAGE_NAMES_SPARK)
    odd = names.filter("name LIKE 'x%'")
    held = merge.append_dedup(None, odd, ["name"])
    return merge.append_dedup(held, names.unionByName(odd), ["name"])


# --- Parsing, filters, contract -----------------------------------------------------------------


@query(f"""
SELECT event_id, field_id, reading, user_id FROM ({as_sql(fx.SENSOR_EVENTS)})
WHERE reading >= 5 AND reading <= 60
""")
def range_filter(spark, sf_dir):
    events = derive(spark, sf_dir, fx.SENSOR_EVENTS)
    return quality.range_filter(events, READING_RULES).select(*READINGS)


CHANGES = """
SELECT *, CASE op_type WHEN 'I' THEN 'insert' WHEN 'D' THEN 'delete'
          ELSE CASE WHEN sequence_num = 3 THEN 'update_postimage' ELSE 'update_preimage' END
          END AS _change_type
FROM ({feed})
"""


@query(f"""
SELECT * FROM ({CHANGES.format(feed=as_sql(fx.ORDERS_CDC))})
WHERE _change_type IN ('insert', 'update_postimage')
""")
def change_type_filter(spark, sf_dir):
    feed = derive(spark, sf_dir, fx.ORDERS_CDC)
    return quality.change_type_filter(spark.sql(CHANGES.replace("({feed})", "{feed}"), feed=feed))


@query("""
SELECT 'events' AS _kafka_topic, CAST(event_id % 4 AS INTEGER) AS _kafka_partition,
       event_id AS _kafka_offset, strftime(ts, '%Y-%m-%d %H:%M:%S') AS _kafka_ts,
       CAST(user_id AS VARCHAR) AS _kafka_key, props AS _raw_value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""")
def kafka_envelope_parse(spark, sf_dir):
    records = derive(spark, sf_dir, fx.KAFKA_ROWS)
    parsed = enrich.parse_json_value(enrich.with_kafka_metadata(records), columns("k long"))
    return parsed.withColumn(
        "_kafka_ts", F.date_format("_kafka_ts", "yyyy-MM-dd HH:mm:ss")
    ).drop("_ingested_at", "_ingested_date")


@query("""
SELECT CAST(event_id % 4 AS INTEGER) AS _kafka_partition, count(*) AS failed
FROM events WHERE event_id % 50 = 0 GROUP BY 1
""")
def kafka_parse_failures(spark, sf_dir):
    """Events whose text gave no declared field; the raw text is kept for them."""
    cols = columns("k long")
    records = derive(spark, sf_dir, fx.KAFKA_ROWS)
    broken = F.when(F.col("offset") % 50 == 0, F.lit("not json").cast("binary"))
    records = records.withColumn("value", F.coalesce(broken, "value"))
    parsed = enrich.parse_json_value(enrich.with_kafka_metadata(records), cols)
    failed = parsed.filter(enrich.parse_failed(cols))
    return failed.groupBy("_kafka_partition").agg(F.count(F.lit(1)).alias("failed"))


@query("""
SELECT CAST(event_id % 4 AS INTEGER) AS _kafka_partition, count(*) FILTER (event_id % 50 = 0) AS unread,
       count(*) FILTER (event_id % 50 = 7) AS bad_user, count(*) FILTER (event_id % 50 = 9) AS bad_both
FROM events GROUP BY 1
""")
def kafka_field_failures(spark, sf_dir):
    """Records with text that gives no field, and records where a field's text is not of its type."""
    cols = columns("id long, user long, note string")
    records = derive(spark, sf_dir, fx.KAFKA_ROWS)
    number = F.col("offset")
    value = F.when(number % 50 == 0, F.lit("no json")).when(number % 50 == 7, F.concat(F.lit('{"id":'), number, F.lit(',"user":"x","note":null}')))
    value = value.when(number % 50 == 9, F.lit('{"id":true,"user":1.5,"note":7}'))
    value = value.otherwise(F.to_json(F.struct(number.alias("id"), F.lit(1).alias("user"), F.lit("a").alias("note"))))
    parsed = enrich.parse_json_value(enrich.with_kafka_metadata(records.withColumn("value", value.cast("binary"))), cols)
    found = parsed.withColumn("_failed", enrich.failed_fields(cols))
    names = F.concat_ws(",", "_failed")
    return found.groupBy("_kafka_partition").agg(
        F.count_if(enrich.parse_failed(cols) & (names == "")).alias("unread"), F.count_if(names == "user").alias("bad_user"),
        F.count_if(names == "id,user").alias("bad_both"))


@query("""
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL
                      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_ts
FROM events
""")
def event_time_parse(spark, sf_dir):
    text = F.when(F.col("event_id") % 10 == 0, "not a time").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    events = table(spark, sf_dir, "events").select("event_id", text.alias("event_ts"))
    return enrich.parse_event_time(events, "event_ts").select(
        "event_id", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("event_ts"))


@query(rf"""
WITH names AS ({as_sql(fx.IMAGE_NAMES_SQL)})
SELECT name, regexp_extract(name, '{enrich.IMAGE_NAME}', 1) AS _field_id,
       CAST(try_strptime(regexp_extract(name, '{enrich.IMAGE_NAME}', 2), '%Y%m%d') AS DATE)
           AS _capture_date,
       try_cast(regexp_extract(name, '{enrich.IMAGE_NAME}', 3) AS INTEGER) AS _image_seq
FROM names
""")
def image_name_parse(spark, sf_dir):
    names = derive(spark, sf_dir, fx.IMAGE_NAMES_SPARK)
    path = F.concat(F.lit("/landing/images/"), F.col("name"))
    return names.select("name", *enrich.image_name_fields(path))


@query("""
SELECT DATE '2026-05-01' AS _ingested_date, 'events.parquet' AS source_name, event_id, user_id,
       event_type, value, props
FROM events
""")
def file_metadata(spark, sf_dir):
    now = F.lit("2026-05-01").cast("timestamp")
    rows = enrich.with_file_metadata(table(spark, sf_dir, "events"), now)
    # A table stored as one file or as a folder of part files: the name is that of the table.
    name = F.regexp_extract("_source_file", r"/(events\.parquet)(/|$)", 1)
    return rows.select("_ingested_date", name.alias("source_name"), "event_id", "user_id",
                       "event_type", "value", "props")


@query(f"""
SELECT CAST(product_id AS VARCHAR) AS product_id, price, CAST(feed_no AS BIGINT) AS feed_no,
       CAST(NULL AS VARCHAR) AS unit_of_measure, try_cast(brand AS INTEGER) AS brand
FROM ({as_sql(fx.PRODUCT_FEED)})
""")
def conform_to_contract(spark, sf_dir):
    contract = columns(
        "product_id string, price double, feed_no long, unit_of_measure string, brand int")
    return quality.conform_to_contract(derive(spark, sf_dir, fx.PRODUCT_FEED), contract)


@query(f"SELECT price, product_id FROM ({as_sql(fx.PRODUCT_FEED)})")
def conform_columns(spark, sf_dir):
    contract = columns("price double, absent string, product_id long")
    return quality.conform_columns(derive(spark, sf_dir, fx.PRODUCT_FEED), contract)


# --- Landing, sinks, tables ---------------------------------------------------------------------


def _ingested(spark: SparkSession, spec: BronzeSpec) -> DataFrame:
    layout = refresh.Layout(scratch_dir(spark, "lake"))
    refresh.ingest(spark, spec, layout)
    return refresh.read_bronze(spark, spec, layout)


@query("""
SELECT event_id, user_id, event_type, value, props, CAST(floor(epoch(ts)) AS BIGINT) AS at
FROM events
""")
def landing_to_bronze(spark, sf_dir):
    spec = BronzeSpec(
        "events", "parquet",
        columns=columns("event_id long, ts timestamp, user_id long, event_type string, "
                        "value double, props string"),
        landing=f"{sf_dir}/event[s].parquet", partition_cols=("event_type",),
    )
    rows = _ingested(spark, spec)
    return rows.select("event_id", "user_id", "event_type", "value", "props",
                       F.unix_seconds("ts").alias("at"))


@query(as_sql(fx.ORDERS_CDC))
def json_landing_to_bronze(spark, sf_dir):
    landing = scratch_dir(spark, "landing")
    derive(spark, sf_dir, fx.ORDERS_CDC).write.json(landing)
    spec = BronzeSpec("orders_cdc", "json", columns=CDC_COLUMNS, landing=landing,
                      partition_cols=("_ingested_date",))
    return _ingested(spark, spec).select(*[c for c, _ in CDC_COLUMNS])


@query(as_sql(fx.PRODUCT_FEED))
def csv_landing_to_bronze(spark, sf_dir):
    landing = scratch_dir(spark, "landing")
    derive(spark, sf_dir, fx.PRODUCT_FEED).write.option("header", "true").csv(landing)
    cols = columns("product_id long, product_name string, category string, brand string, "
                   "price double, feed_no integer, effective_date date")
    spec = BronzeSpec("products", "csv", columns=cols, landing=landing,
                      read_options={"header": "true"})
    return _ingested(spark, spec).select(*[c for c, _ in cols])


@query("SELECT event_id, props FROM events")
def binary_landing_to_bronze(spark, sf_dir):
    """Binary objects with their content: events as small text files, taken whole and unpacked."""
    landing, lines = scratch_dir(spark, "landing"), F.concat_ws("|", "event_id", "props")
    events = table(spark, sf_dir, "events").select(lines)
    events.write.option("maxRecordsPerFile", 10_000).text(landing)
    spec = BronzeSpec("files", "binaryFile", landing=landing,
                      read_options={"pathGlobFilter": "*.txt"})
    text = F.col("content").cast("string")
    rows = _ingested(spark, spec).select(F.explode(F.split(text, "\n")).alias("line"))
    return rows.filter("line <> ''").select(
        F.substring_index("line", "|", 1).cast("bigint").alias("event_id"),
        F.substring_index("line", "|", -1).alias("props"))


@query(f"""
WITH lines AS (
    SELECT CASE WHEN order_id % 50 <> 3 THEN order_id END AS order_id,
           CASE WHEN order_id % 50 <> 3 THEN sequence_num END AS sequence_num,
           CASE WHEN order_id % 50 = 3 THEN concat('damaged ', order_id, '/', sequence_num) END AS text,
           CAST(NULL AS BIGINT) AS logged
    FROM ({as_sql(fx.ORDERS_CDC)})
    UNION ALL SELECT NULL, NULL, NULL, count(*) FROM ({as_sql(fx.ORDERS_CDC)}) WHERE order_id % 50 = 3)
SELECT 'json' AS format, * FROM lines UNION ALL SELECT 'csv', * FROM lines
""")
def landing_malformed(spark, sf_dir):
    """Damaged lines keep their text in the raw table, and the run log says how many there were."""
    feed = derive(spark, sf_dir, fx.ORDERS_CDC).select("order_id", F.col("sequence_num").cast("int").alias("sequence_num"))
    damaged = F.concat(F.lit("damaged "), "order_id", F.lit("/"), "sequence_num")
    sound = {"json": F.to_json(F.struct("order_id", "sequence_num")), "csv": F.concat_ws(",", "order_id", "sequence_num")}
    parts = []
    for fmt, line in sound.items():
        landing, lake = scratch_dir(spark, "landing"), refresh.Layout(scratch_dir(spark, "lake"))
        feed.select(F.when(F.col("order_id") % 50 == 3, damaged).otherwise(line)).write.text(landing)
        spec = BronzeSpec("orders", fmt, columns=columns("order_id long, sequence_num integer"), landing=landing)
        refresh.ingest(spark, spec, lake)
        rows = refresh.read_bronze(spark, spec, lake).select(
            F.lit(fmt).alias("format"), "order_id", "sequence_num", F.col("_malformed").alias("text"),
            F.lit(None).cast("long").alias("logged"))
        log = control.read_control(spark, lake.control).filter(F.col("status") == control.COUNTED)
        counted = log.select(F.lit(fmt).alias("format"), F.from_json("notes", "malformed long")["malformed"].alias("logged"))
        parts.append(rows.unionByName(counted, allowMissingColumns=True))
    return parts[0].unionByName(parts[1])


def _cdc_commits(spark: SparkSession, sf_dir: str, path: str, *numbers: int) -> None:
    """Write the change feed as commits numbered by sequence."""
    feed = derive(spark, sf_dir, fx.ORDERS_CDC)
    for number in numbers:
        sink.append_batch(feed.filter(F.col("sequence_num") == number), path, number)


@query(f"SELECT * FROM ({as_sql(fx.ORDERS_CDC)}) WHERE sequence_num > 1")
def change_range(spark, sf_dir):
    """Commits after the one the ledger names, up to the table's newest."""
    path, log = scratch_dir(spark, "bronze"), scratch_dir(spark, "control")
    _cdc_commits(spark, sf_dir, path, 1, 2, 3)
    control.log_run(spark, log, "silver.orders", "orders", "run1", control.SUCCESS, notes="1")
    commits = read_table(spark, path, build_schema(CDC_COLUMNS))
    after = control.ledger_position(control.read_control(spark, log), "silver.orders")
    upto = source.current_version(commits).first()["version"]
    return source.change_range(commits, after, upto).drop(BATCH)


@query(f"""
SELECT CAST(max(sequence_num) AS BIGINT) AS version FROM ({as_sql(fx.ORDERS_CDC)})
""")
def current_version(spark, sf_dir):
    path = scratch_dir(spark, "bronze")
    _cdc_commits(spark, sf_dir, path, 1, 2, 3)
    return source.current_version(read_table(spark, path, build_schema(CDC_COLUMNS)))


@query(f"""
SELECT product_id, price, CASE WHEN feed_no >= 2 THEN brand END AS brand,
       CASE WHEN feed_no = 3 THEN category END AS category
FROM ({as_sql(fx.PRODUCT_FEED)})
""")
def schema_evolution_append(spark, sf_dir):
    feed, path = derive(spark, sf_dir, fx.PRODUCT_FEED), scratch_dir(spark, "evolving")
    sink.append_batch(feed.filter("feed_no = 1").select("product_id", "price"), path, 0)
    sink.append_batch(feed.filter("feed_no = 2").select("product_id", "price", "brand"), path, 1)
    wide = feed.filter("feed_no = 3").select("product_id", "price", "brand", "category")
    sink.append_batch(wide, path, 2)
    return read_table(spark, path).select("product_id", "price", "brand", "category")


@query(f"SELECT CAST(max(sequence_num) AS BIGINT) AS version FROM ({as_sql(fx.ORDERS_CDC)})")
def newest_commit(spark, sf_dir):
    """The newest commit off the folder names: no data file is opened."""
    path = scratch_dir(spark, "bronze")
    _cdc_commits(spark, sf_dir, path, 1, 2, 3)
    return source.newest_commit(spark, path)


@query(f"""
SELECT CAST(product_id AS BIGINT) AS product_id, CAST(feed_no AS DOUBLE) AS feed_no, price,
       CAST(effective_date AS VARCHAR) AS effective_date, CASE WHEN feed_no > 1 THEN brand END AS brand
FROM ({as_sql(fx.PRODUCT_FEED)})
""")
def append_widened(spark, sf_dir):
    """Commits whose columns change their type: whole numbers grow, become fractions, a date becomes text."""
    feed, path = derive(spark, sf_dir, fx.PRODUCT_FEED), scratch_dir(spark, "widening")
    kinds = {
        1: ("CAST(product_id AS INT) product_id", "CAST(feed_no AS INT) feed_no", "price", "effective_date"),
        2: ("CAST(product_id AS BIGINT) product_id", "CAST(feed_no AS DOUBLE) feed_no", "price", "effective_date", "brand"),
        3: ("CAST(product_id AS BIGINT) product_id", "CAST(feed_no AS INT) feed_no", "price",
            "CAST(effective_date AS STRING) effective_date", "brand"),
    }
    for number, chosen in kinds.items():
        sink.append_batch(feed.filter(F.col("feed_no") == number).selectExpr(*chosen), path, number)
    return read_table(spark, path).drop(BATCH)


@query(f"""
SELECT product_id, price, CASE WHEN feed_no >= 2 THEN brand END AS brand,
       CASE WHEN feed_no = 3 THEN category END AS category
FROM ({as_sql(fx.PRODUCT_FEED)})
""")
def append_evolving(spark, sf_dir):
    feed = derive(spark, sf_dir, fx.PRODUCT_FEED)
    two = sink.append_evolving(
        feed.filter("feed_no = 1").select("product_id", "price"),
        feed.filter("feed_no = 2").select("product_id", "price", "brand"))
    return sink.append_evolving(
        two, feed.filter("feed_no = 3").select("product_id", "price", "brand", "category"))


@query(f"""
SELECT status, rows_read, rows_written, lost FROM (
  SELECT 'UNCONVERTED' AS status, count(*) AS rows_read, 0 AS rows_written, count(o_orderpriority) AS lost FROM orders
  UNION ALL SELECT 'SUCCESS', count(*), count(*), NULL FROM orders)
""")
def promote_unconvertible(spark, sf_dir):
    """Values that their declared type cannot hold are counted in the run log, per column."""
    lake, cols = refresh.Layout(scratch_dir(spark, "lake")), columns("o_orderkey long, o_orderpriority string")
    landing = scratch_dir(spark, "landing")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").write.parquet(landing)
    raw = BronzeSpec("orders", "parquet", columns=cols, landing=landing)
    refined = SilverSpec("orders_numbers", "append_dedup", "orders", ("o_orderkey",),
                         columns("o_orderkey long, o_orderpriority long"))
    refresh.ingest(spark, raw, lake)
    refresh.promote(spark, refined, raw, lake, within_feed="keep")
    log = control.read_control(spark, f"{lake.control}/{lake.pipeline('silver', refined.name)}")
    counts = F.from_json("notes", "o_orderpriority long")["o_orderpriority"]
    return log.filter("status <> 'STARTED'").select(
        "status", "rows_read", "rows_written", F.when(F.col("status") == control.UNCONVERTED, counts).alias("lost"))


# --- Streams ------------------------------------------------------------------------------------


def _sensor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sensor events as an appended table, read as a stream."""
    path = scratch_dir(spark, "sensors")
    rows = derive(spark, sf_dir, fx.SENSOR_EVENTS)
    sink.append_batch(rows.withColumn("event_ts", F.col("event_ts").cast("timestamp")), path, 0)
    return source.read_table_stream(spark, path, build_schema(SENSOR_COLUMNS))


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out, checkpoint = scratch_dir(spark, "out"), scratch_dir(spark, "checkpoint")
    sink.append_stream(stream, out, checkpoint).awaitTermination()
    return read_table(spark, out, stream.schema).drop(BATCH)


@query(DISTINCT_READINGS)
def stream_append_dedup(spark, sf_dir):
    spec = SilverSpec(
        "sensor_reads", "streaming_append", "sensors", ("event_id",), SENSOR_COLUMNS,
        order_col="event_ts", rules=READING_RULES,
    )
    return _drained(spark, streaming_append(_sensor_table(spark, sf_dir), spec)).select(*READINGS)


@query(f"""
SELECT *, event_id % 3 AS run FROM ({DISTINCT_READINGS})
""")
def stream_append_stateless(spark, sf_dir):
    """As ``stream_append_dedup``, in three runs that overlap, without a state of all keys."""
    lake = refresh.Layout(scratch_dir(spark, "lake"))
    raw = BronzeSpec("sensors", "json", ingest="streaming", columns=SENSOR_COLUMNS)
    spec = SilverSpec("sensor_reads", "streaming_append", "sensors", ("event_id", "field_id"), SENSOR_COLUMNS,
                      order_col="event_ts", rules=READING_RULES, partition_cols=("field_id",), stateless=True)
    events = derive(spark, sf_dir, fx.SENSOR_EVENTS)
    events = events.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    for number in range(3):  # every run's feed holds the events of the runs before it as well
        sink.append_batch(events.filter(F.col("event_id") % 3 <= number), lake.table("bronze", "sensors"), number)
        control.log_run(spark, lake.control, lake.pipeline("bronze", "sensors"), "sensors", f"run{number}",
                        control.SUCCESS, notes=str(number))
        refresh.promote(spark, spec, raw, lake)
    rows = read_table(spark, lake.table("silver", "sensor_reads"), build_schema(SENSOR_COLUMNS))
    return rows.select(*READINGS, F.col(BATCH).alias("run"))


@query(f"SELECT DISTINCT event_id, field_id, reading, user_id FROM ({as_sql(fx.SENSOR_EVENTS)})")
def stream_dedup_within_watermark(spark, sf_dir):
    stream = with_watermark(_sensor_table(spark, sf_dir)).drop(BATCH)
    return _drained(spark, stream_dedup(stream, ["event_id"], bounded=True)).select(*READINGS)


def _topic(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Records of the Kafka row schema as a stream."""
    path = scratch_dir(spark, "topic")
    records.write.parquet(path)
    return spark.readStream.schema(records.schema).parquet(path)


@query("""
SELECT 'events' AS _kafka_topic, CAST(event_id % 4 AS INTEGER) AS _kafka_partition,
       event_id AS _kafka_offset, CAST(user_id AS VARCHAR) AS _kafka_key, props AS _raw_value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""")
def topic_to_bronze(spark, sf_dir):
    spec = BronzeSpec("events", "json", "streaming", columns("k long"), topic="events",
                      partition_cols=("_ingested_date",))
    layout = refresh.Layout(scratch_dir(spark, "lake"))
    stream = _topic(spark, derive(spark, sf_dir, fx.KAFKA_ROWS))
    refresh.ingest(spark, spec, layout, stream)
    rows = refresh.read_bronze(spark, spec, layout)
    return rows.select("_kafka_topic", "_kafka_partition", "_kafka_offset", "_kafka_key",
                       "_raw_value", "k")


@query("""
SELECT 'events' AS _kafka_topic, event_id AS _kafka_offset, CAST(user_id AS VARCHAR) AS _kafka_key,
       event_id % 3 AS commit_number, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.k') AS k_text
FROM events
""")
def reparse_topic(spark, sf_dir):
    """A raw table whose column was declared as text is rebuilt from its stored payloads, then followed on."""
    early = BronzeSpec("events", "json", "streaming", columns("k string"), topic="events")
    late = replace(early, columns=columns("k long"))
    root = scratch_dir(spark, "lake")
    records, path = derive(spark, sf_dir, fx.KAFKA_ROWS), scratch_dir(spark, "topic")

    def arrive(number: int, spec: BronzeSpec) -> refresh.Layout:
        records.filter(F.col("offset") % 3 == number).write.mode("append").parquet(path)
        layout = refresh.Layout.current(spark, root)
        refresh.ingest(spark, spec, layout, spark.readStream.schema(records.schema).parquet(path))
        return layout

    arrive(0, early)
    refresh.publish(spark, refresh.reparse_topic(spark, late, arrive(1, early)))
    layout = arrive(2, late)
    rows = refresh.read_bronze(spark, late, layout)
    return rows.select("_kafka_topic", "_kafka_offset", "_kafka_key", F.col(BATCH).alias("commit_number"), "k",
                       F.get_json_object("_raw_value", "$.k").alias("k_text"))


# Each partition's offsets are dense but for the records that are gone.
TOPIC_ROWS = """
SELECT CAST('events' AS STRING) AS topic, CAST(event_id % 4 AS INT) AS partition,
       CAST(floor(event_id / 4.0) AS BIGINT) AS offset, CAST(ts AS TIMESTAMP) AS timestamp,
       CAST(CAST(user_id AS STRING) AS BINARY) AS key, CAST(props AS BINARY) AS value
FROM {events} WHERE event_id % 100 >= 12 AND event_id % 37 <> 5
"""


@query(f"""
WITH held AS (SELECT topic, partition, "offset" AS o, CAST("offset" % 3 AS BIGINT) AS c FROM ({as_sql(TOPIC_ROWS)})),
near AS (
    SELECT *, lag(o) OVER w AS last, lag(c) OVER w AS commit_before
    FROM held WINDOW w AS (PARTITION BY topic, partition ORDER BY o))
SELECT topic AS _kafka_topic, partition AS _kafka_partition, last + 1 AS first_missing, o - 1 AS last_missing,
       o - last - 1 AS missing, commit_before, c AS commit_after
FROM near WHERE o - last > 1
""")
def offset_gaps(spark, sf_dir):
    """Records of a topic that never reached its raw table, as runs of offsets between those that did."""
    path = scratch_dir(spark, "topic")
    rows = enrich.with_kafka_metadata(derive(spark, sf_dir, TOPIC_ROWS))
    for number in range(3):
        sink.append_batch(rows.filter(F.col("_kafka_offset") % 3 == number), path, number)
    return source.offset_gaps(read_table(spark, path, rows.schema), span=1000)


@query(DISTINCT_READINGS)
def topic_to_silver(spark, sf_dir):
    """JSON events with text times: topic, raw table, refined table."""
    events = derive(spark, sf_dir, fx.SENSOR_EVENTS).withColumn(
        "event_ts", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss"))
    records = events.select(
        F.lit("sensors").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), F.current_timestamp().alias("timestamp"),
        F.col("field_id").cast("binary").alias("key"),
        F.to_json(F.struct(*[c for c, _ in SENSOR_COLUMNS])).cast("binary").alias("value"))
    raw_columns = tuple((n, "string" if n == "event_ts" else k) for n, k in SENSOR_COLUMNS)
    bronze = BronzeSpec("sensors", "json", "streaming", raw_columns, topic="sensors",
                        partition_cols=("_ingested_date", "field_id"), clustered=True)
    silver = SilverSpec("sensor_reads", "streaming_append", "sensors", ("event_id",),
                        SENSOR_COLUMNS, order_col="event_ts", rules=READING_RULES,
                        partition_cols=("field_id",))
    layout = refresh.Layout(scratch_dir(spark, "lake"))
    refresh.ingest(spark, bronze, layout, _topic(spark, records))
    refresh.promote(spark, silver, bronze, layout)
    return refresh.read_silver(spark, silver, layout).select(*READINGS)


# --- Runs ---------------------------------------------------------------------------------------

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in TABLES))
def table_row_counts(spark, sf_dir):
    return audit.table_row_counts(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES})


# Every event in commit event_id % 4; every fourth event again, in any commit.
AUDIT_EVENTS = """
SELECT event_id, ts AS event_ts, value AS reading, event_id % 4 AS _batch_id FROM {events}
UNION ALL
SELECT event_id, ts, value, CAST(floor((event_id % 16) / 4.0) AS BIGINT)
FROM {events} WHERE event_id % 4 = 0
"""


def audit_ctes(lag: int) -> str:
    """Rows of each commit, accepted ones marked late or not, and the first commit of each key."""
    return f"""
    WITH rows_in AS (SELECT *, reading >= 5 AND reading <= 60 AS passes
                     FROM ({as_sql(AUDIT_EVENTS)})),
    per_batch AS (
        SELECT _batch_id, count(*) AS n, count(*) FILTER (NOT passes) AS rejected,
               max(event_ts) FILTER (passes) AS newest
        FROM rows_in GROUP BY _batch_id),
    marks AS (
        SELECT *, date_trunc('milliseconds', max(newest) OVER (
                      ORDER BY _batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND {lag} PRECEDING))
                  - INTERVAL 20 DAY AS horizon
        FROM per_batch),
    accepted AS (
        SELECT r.event_id, r._batch_id, coalesce(r.event_ts <= m.horizon, false) AS late
        FROM rows_in r JOIN marks m USING (_batch_id) WHERE r.passes),
    firsts AS (
        SELECT event_id, min(_batch_id) AS _batch_id FROM accepted WHERE NOT late GROUP BY 1)
    """


def audit_sql(lag: int) -> str:
    return f"""
{audit_ctes(lag)}
SELECT _batch_id, rows_read, rows_rejected, rows_late,
       rows_read - rows_rejected - rows_late - rows_written AS rows_duplicate, rows_written
FROM (
    SELECT m._batch_id, m.n AS rows_read, m.rejected AS rows_rejected,
           (SELECT count(*) FROM accepted a WHERE a.late AND a._batch_id = m._batch_id)
               AS rows_late,
           (SELECT count(*) FROM firsts f WHERE f._batch_id = m._batch_id) AS rows_written
    FROM marks m)
"""


AUDIT_SQL = audit_sql(2)


def _audited(spark, sf_dir):
    return audit.batch_audit(
        derive(spark, sf_dir, AUDIT_EVENTS), ["event_id"], READING_RULES, "event_ts", "20 days")


@query(AUDIT_SQL)
def batch_audit(spark, sf_dir):
    return _audited(spark, sf_dir)


@query(f"""
SELECT 'silver.sensor_reads' AS pipeline_name, 'sensors' AS source_name,
       CAST(_batch_id AS VARCHAR) AS batch_id, rows_read, rows_written, 'SUCCESS' AS status,
       concat('rows_rejected=', rows_rejected, '; rows_late=', rows_late,
              '; rows_duplicate=', rows_duplicate) AS notes
FROM ({AUDIT_SQL})
""")
def batch_audit_log(spark, sf_dir):
    shaped = control.audit_as_control(_audited(spark, sf_dir), "silver.sensor_reads", "sensors")
    return shaped.drop("ingest_ts")


@query(f"""
SELECT source_name, status, rows_written, strftime(run_at, '%Y-%m-%d %H:%M:%S') AS ingest_ts, notes
FROM (SELECT *, ingest_ts AS run_at FROM ({as_sql(fx.CONTROL_LOG)}))
WHERE pipeline_name = 'silver.click' AND status = 'SUCCESS'
ORDER BY run_at DESC, rows_written DESC, notes DESC
LIMIT 50
""")
def control_log_recent(spark, sf_dir):
    log = derive(spark, sf_dir, fx.CONTROL_LOG)
    recent = control.recent_runs(control.runs_with_status(log, "silver.click"), 50)
    return recent.withColumn("ingest_ts", F.date_format("ingest_ts", "yyyy-MM-dd HH:mm:ss"))


@query(f"""
SELECT max(try_cast(notes AS BIGINT)) AS last_version FROM ({as_sql(fx.CONTROL_LOG)})
WHERE pipeline_name = 'silver.click' AND status = 'SUCCESS'
""")
def last_processed(spark, sf_dir):
    return control.last_processed(derive(spark, sf_dir, fx.CONTROL_LOG), "silver.click")


@query(f"{audit_ctes(1)} SELECT event_id FROM firsts")
def stream_late_rows(spark, sf_dir):
    """Commits drained one by one: rows behind the watermark never reach the refined table."""
    raw, out = scratch_dir(spark, "raw"), scratch_dir(spark, "out")
    checkpoint = scratch_dir(spark, "checkpoint")
    events = derive(spark, sf_dir, AUDIT_EVENTS)
    events = events.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    cols = columns("event_id long, event_ts timestamp, reading double")
    spec = SilverSpec("reads", "streaming_append", "raw", ("event_id",), cols,
                      order_col="event_ts", delay="20 days", rules=READING_RULES)
    for number in range(4):
        sink.append_batch(events.filter(F.col(BATCH) == number), raw, number)
        stream = source.read_table_stream(spark, raw, build_schema(cols))
        staged = streaming_append(stream, spec)
        sink.append_stream(staged, out, checkpoint).awaitTermination()
    return read_table(spark, out, build_schema(cols)).select("event_id")


@query(audit_sql(1))
def promote_stream_counts(spark, sf_dir):
    """What the run log says of promoted commits: rows read, rejected, late, known already, written."""
    lake = refresh.Layout(scratch_dir(spark, "lake"))
    cols = columns("event_id long, event_ts timestamp, reading double")
    raw = BronzeSpec("reads", "json", ingest="streaming", columns=cols)
    spec = SilverSpec("reads", "streaming_append", "reads", ("event_id",), cols, order_col="event_ts", delay="20 days",
                      rules=READING_RULES)
    events = derive(spark, sf_dir, AUDIT_EVENTS).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    remembered = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(remembered)
    spark.conf.set(remembered, "2")
    try:
        for number in range(4):
            sink.append_batch(events.filter(F.col(BATCH) == number), lake.table("bronze", "reads"), number)
            control.log_run(spark, lake.control, lake.pipeline("bronze", "reads"), "reads", f"run{number}",
                            control.SUCCESS, notes=str(number))
            refresh.promote(spark, spec, raw, lake)
    finally:
        spark.conf.set(remembered, before)
    log = control.read_control(spark, f"{lake.control}/{lake.pipeline('silver', 'reads')}")
    counted = log.filter(F.col("status") == control.COUNTED).withColumn(
        "n", F.from_json("notes", "upto long, rejected long, late long, duplicate long"))
    return counted.select(
        F.col("n.upto").alias(BATCH), "rows_read", F.col("n.rejected").alias("rows_rejected"),
        F.col("n.late").alias("rows_late"), F.col("n.duplicate").alias("rows_duplicate"), "rows_written")


@query(f"""
SELECT DISTINCT event_id, field_id, reading, user_id, event_id % 3 = 2 AS second_run
FROM ({as_sql(fx.SENSOR_EVENTS)}) WHERE reading BETWEEN 5 AND 60
""")
def promote_stream_bounded(spark, sf_dir):
    """A raw commit that is on disk but not logged waits for the promotion after its log entry."""
    layout = refresh.Layout(scratch_dir(spark, "lake"))
    raw = BronzeSpec("reads", "json", ingest="streaming", columns=SENSOR_COLUMNS)
    spec = SilverSpec("reads", "streaming_append", "reads", ("event_id",), SENSOR_COLUMNS,
                      order_col="event_ts", delay="3650 days", rules=READING_RULES)
    events = derive(spark, sf_dir, fx.SENSOR_EVENTS)
    events = events.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    path, pipeline = layout.table("bronze", "reads"), layout.pipeline("bronze", "reads")
    for number in range(3):
        sink.append_batch(events.filter(F.col("event_id") % 3 == number), path, number)
    runs = []
    for logged in (1, 2):
        control.log_run(spark, layout.control, pipeline, "reads", f"run{logged}", control.SUCCESS,
                        notes=str(logged))
        runs.append(refresh.promote(spark, spec, raw, layout))
    rows = read_table(spark, layout.table("silver", "reads"), build_schema(SENSOR_COLUMNS))
    return rows.select(*READINGS, (F.col(BATCH) > runs[0].version).alias("second_run"))


ORDERS_BRONZE = BronzeSpec("orders", "json", columns=CDC_COLUMNS)
ORDERS_SILVER = SilverSpec("orders_current", "cdc_merge", "orders", ("order_id",), CDC_COLUMNS)


def _promoted(spark, sf_dir, spec: SilverSpec) -> refresh.Layout:
    """Commits arrive one by one, each followed by a promotion."""
    layout = refresh.Layout(scratch_dir(spark, "lake"))
    for number in (1, 2, 3):
        _cdc_commits(spark, sf_dir, layout.table("bronze", "orders"), number)
        control.log_run(spark, layout.control, layout.pipeline("bronze", "orders"), "orders",
                        f"run{number}", control.SUCCESS, notes=str(number))
        refresh.promote(spark, spec, ORDERS_BRONZE, layout)
    return layout


@query(CDC_WARM)
def promote_incremental(spark, sf_dir):
    layout = _promoted(spark, sf_dir, ORDERS_SILVER)
    return refresh.read_silver(spark, ORDERS_SILVER, layout)


@query(CDC_WARM)
def promote_bucketed(spark, sf_dir):
    """State split by key hash: a run reads and writes only the buckets its feed touches."""
    spec = replace(ORDERS_SILVER, buckets=8)
    return refresh.read_silver(spark, spec, _promoted(spark, sf_dir, spec))


@query(as_sql(fx.ORDERS_CDC))
def promote_history(spark, sf_dir):
    spec = SilverSpec("orders_history", "cdc_history", "orders", ("order_id", "sequence_num"),
                      CDC_COLUMNS)
    return refresh.read_silver(spark, spec, _promoted(spark, sf_dir, spec))


@query(as_sql(fx.ORDERS_CDC))
def promote_history_pruned(spark, sf_dir):
    """A history partitioned by a key: a promotion reads no partition that its feed cannot touch."""
    spec = SilverSpec("orders_history", "cdc_history", "orders", ("order_id", "sequence_num"),
                      CDC_COLUMNS, partition_cols=("sequence_num",))
    return refresh.read_silver(spark, spec, _promoted(spark, sf_dir, spec))


@query(as_sql(fx.ORDERS_CDC))
def promote_history_bucketed(spark, sf_dir):
    spec = SilverSpec("orders_history", "cdc_history", "orders", ("order_id", "sequence_num"),
                      CDC_COLUMNS, buckets=8)
    return refresh.read_silver(spark, spec, _promoted(spark, sf_dir, spec))


@query(CDC_COLD)
def full_refresh(spark, sf_dir):
    """A rebuild reads all commits at once, so a key deleted in between never appears."""
    layout = _promoted(spark, sf_dir, ORDERS_SILVER)
    fresh = refresh.full_refresh(spark, ORDERS_SILVER, ORDERS_BRONZE, layout)
    return refresh.read_silver(spark, ORDERS_SILVER, fresh)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_day FROM orders
WHERE date_trunc('month', o_orderdate) BETWEEN DATE '1996-03-01' AND DATE '1997-06-01'
""")
def replay_range(spark, sf_dir):
    """Orders land in one dated folder per month; a range of months is replayed."""
    landing = scratch_dir(spark, "landing")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("order_day"),
        F.to_date(F.trunc("o_orderdate", "month")).alias("day"))
    orders.hint("rebalance", "day").write.partitionBy("day").json(landing)
    spec = BronzeSpec("orders", "json", landing=landing, columns=columns(
        "o_orderkey long, o_custkey long, o_totalprice double, order_day date"))
    rows = refresh.replay_range(spark, spec, "1996-03-01", "1997-06-01")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", "order_day")

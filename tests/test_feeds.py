"""Damaged records, counts of real runs, pruned histories, changed types, lost offsets."""

import json
import random
from decimal import Decimal

import pytest
from helpers import bag, plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_tables import scans_files

from strataflow.operators import audit, control, merge
from strataflow.plans import refresh
from strataflow.sinks import tables as sink
from strataflow.sources import tables as source
from strataflow.sources.landing import MALFORMED, read_landing
from strataflow.spec import BronzeSpec, RangeRule, SilverSpec, build_schema, columns

KV = columns("k long, v long")


def counted(spark, lake, layer, name):
    log = control.read_control(spark, f"{lake.control}/{lake.pipeline(layer, name)}")
    return [json.loads(r.notes) for r in log.filter(F.col("status") == control.COUNTED).orderBy("ingest_ts").collect()]


# --- damaged records


@pytest.mark.parametrize(("fmt", "lines", "damaged"), [
    ("json", ['{"k":1,"v":10}', "not json", '{"k":2,"v":"x"}', '{"k":3'], ["not json", '{"k":2,"v":"x"}', '{"k":3']),
    ("csv", ["1,10", "not csv", "2,x", "3,30,300"], ["not csv", "2,x", "3,30,300"]),
])
def test_damaged_records_keep_their_text(spark, tmp_path, fmt, lines, damaged):
    (tmp_path / "in").mkdir()
    (tmp_path / f"in/a.{fmt}").write_text("\n".join(lines) + "\n")
    lake, spec = refresh.Layout(f"{tmp_path}/lake"), BronzeSpec("t", fmt, columns=KV, landing=f"{tmp_path}/in")
    run = refresh.ingest(spark, spec, lake)
    assert (run.rows_read, run.counts) == (4, {"malformed": 3})
    assert counted(spark, lake, "bronze", "t") == [{"malformed": 3}]
    raw = refresh.read_bronze(spark, spec, lake)
    assert sorted(r[MALFORMED] for r in raw.collect() if r[MALFORMED]) == sorted(damaged)
    assert raw.columns[-2:] == [MALFORMED, source.BATCH]

    # What lost its key stays in the raw table; what only lost another field is promoted without it.
    refined = SilverSpec("t", "append_dedup", "t", ("k",), KV)
    run = refresh.promote(spark, refined, spec, lake)
    whole = {(1, 10), (2, None)} | ({(3, 30)} if fmt == "csv" else set())
    assert {tuple(r) for r in refresh.read_silver(spark, refined, lake).collect()} >= {(1, 10), (2, None)}
    assert {tuple(r) for r in refresh.read_silver(spark, refined, lake).collect()} <= whole | {(3, None)}
    assert run.rows_read == 4 and run.counts["malformed"] == 4 - run.rows_written


def test_sound_files_count_nothing(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "k long, v long").write.json(f"{tmp_path}/in")
    lake, spec = refresh.Layout(f"{tmp_path}/lake"), BronzeSpec("t", "json", landing=f"{tmp_path}/in")
    assert refresh.ingest(spark, spec, lake).counts == {}
    assert counted(spark, lake, "bronze", "t") == []
    assert refresh.read_bronze(spark, BronzeSpec("t", "json", landing=f"{tmp_path}/in"), lake).select(MALFORMED).first()[0] is None
    assert read_landing(spark, spec).columns == ["k", "v"]  # kept on request only


def test_damaged_events_are_counted(spark, tmp_path):
    texts = [b'{"k":1,"v":2}', b"oops", None, b'{"k":"x","v":2}', b'{"v":"y"}', b'{"k":3,"v":null}']
    records = [("t", 0, i, b"k", text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(records, "topic string, partition int, offset long, key binary, value binary")
    df = df.withColumn("timestamp", F.current_timestamp())
    df.write.parquet(f"{tmp_path}/topic")
    spec, lake = BronzeSpec("t", "json", "streaming", KV), refresh.Layout(f"{tmp_path}/lake")
    run = refresh.ingest(spark, spec, lake, spark.readStream.schema(df.schema).parquet(f"{tmp_path}/topic"))
    assert run.counts == {"malformed": 1, "misfit": 2}


# --- counts of real runs


def test_counts_of_many_batches_and_little_memory(spark, tmp_path):
    cols = columns("k long, at timestamp, v long")
    spec = SilverSpec("t", "streaming_append", "t", ("k",), cols, order_col="at", delay="1 hour",
                      rules=(RangeRule("v", 0, 9),), read_options={"maxFilesPerTrigger": "1"})
    raw, lake = BronzeSpec("t", "json", "streaming", cols), refresh.Layout(f"{tmp_path}/lake")
    hour = lambda h: F.timestamp_seconds(F.lit(h * 3600))
    for number in range(7):  # per commit: two new rows, one known, one out of range, and from the third on one late
        made = spark.createDataFrame([(10 * number, 1), (10 * number + 1, 1), (0, 1), (10 * number + 2, 99)], "k long, v long")
        made = made.withColumn("at", hour(100 + 10 * number))
        if number >= 3:
            made = made.unionByName(spark.createDataFrame([(1000 + number, 1)], "k long, v long").withColumn("at", hour(1)))
        sink.append_batch(made.select("k", "at", "v").coalesce(1), lake.table("bronze", "t"), number)
    control.log_run(spark, lake.control, lake.pipeline("bronze", "t"), "t", "run", control.SUCCESS, notes="6")
    remembered = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(remembered)
    spark.conf.set(remembered, "2")
    try:
        run = refresh.promote(spark, spec, raw, lake)
    finally:
        spark.conf.set(remembered, before)
    assert (run.rows_read, run.rows_written) == (7 * 4 + 4, 14)
    assert run.counts == {"upto": 6, "malformed": 0, "rejected": 7, "late": 4, "duplicate": 7}
    assert counted(spark, lake, "silver", "t") == [run.counts]


@pytest.mark.parametrize("lag", [1, 2, 5])
def test_newest_before_by_spans(spark, lag):
    r = random.Random(lag)
    commits = sorted(r.sample(range(100), 40))
    newest = [r.choice([None, r.randint(0, 50)]) for _ in commits]
    df = spark.createDataFrame(list(zip(commits, newest, strict=True)), "_batch_id long, _newest long")
    want = {}
    for i, number in enumerate(commits):
        known = [n for n in newest[: max(0, i - lag + 1)] if n is not None]
        want[number] = max(known, default=None)
    assert {x._batch_id: x._newest for x in audit._newest_before(df, lag, span=7).collect()} == want


# --- histories


def test_history_is_read_where_the_feed_can_match(spark, tmp_path):
    cols = columns("k long, day date, v long")
    days = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 10).cast("int"))
    held = spark.range(100).select(F.col("id").alias("k"), days.alias("day"), F.lit(1).cast("long").alias("v"))
    sink.append_batch(held.coalesce(1), f"{tmp_path}/t", 0, ["day"])
    table = source.read_table(spark, f"{tmp_path}/t", build_schema(cols))
    feed = table.filter("k IN (13, 23, 24)").drop(source.BATCH)
    near = merge.near_feed(table, feed, ["k", "day"], ["day"])
    assert scans_files(near) == 2  # the folders of two days of ten
    assert "PartitionFilters" in plan(near) and "GreaterThanOrEqual(k,13)" in plan(near) and "LessThanOrEqual(k,24)" in plan(near)
    assert rows(near, "k") == bag((13,), (14,), (23,), (24,))
    by_range = merge.near_feed(table, feed, ["k", "day"])  # not known to be laid out by day
    assert {r.k for r in by_range.collect()} >= {13, 23, 24}
    assert merge.near_feed(table, feed.limit(0), ["k", "day"], ["day"]).count() == 0
    nulls = feed.withColumn("k", F.lit(None).cast("long"))
    assert merge.near_feed(table, nulls, ["k", "day"], ["day"]).count() == 0


def test_pruning_changes_no_result(spark, tmp_path):
    """Random feeds into a history partitioned by a key give the rows of an unpartitioned one."""
    r, cols = random.Random(7), columns("k long, part string, v long")
    raw = BronzeSpec("t", "json", "streaming", cols)
    specs = [SilverSpec("plain", "cdc_history", "t", ("k", "part"), cols),
             SilverSpec("parted", "cdc_history", "t", ("k", "part"), cols, partition_cols=("part",))]
    lake = refresh.Layout(f"{tmp_path}/lake")
    for number in range(3):
        made = [(r.choice([None, r.randrange(12)]), r.choice([None, "a", "b", "007"]), r.randrange(3)) for _ in range(30)]
        sink.append_batch(spark.createDataFrame(made, "k long, part string, v long"), lake.table("bronze", "t"), number)
        control.log_run(spark, lake.control, lake.pipeline("bronze", "t"), "t", f"r{number}", control.SUCCESS, notes=str(number))
        for spec in specs:
            refresh.promote(spark, spec, raw, lake)
    plain, parted = (rows(refresh.read_silver(spark, s, lake), "k", "part", "v") for s in specs)
    assert plain == parted and plain.total() > 30


# --- changed types


@pytest.mark.parametrize(("a", "b", "both"), [
    ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("float", "int", "double"), ("float", "double", "double"),
    ("bigint", "double", "string"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,10)", "string"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "string", "string"), ("boolean", "int", "string"), ("int", "int", "int")])
def test_supertypes(a, b, both):
    one, two = (T.StructType.fromDDL(f"c {x}")[0].dataType for x in (a, b))
    assert source.supertype(one, two).simpleString() == source.supertype(two, one).simpleString() == both


def test_commits_of_changed_types(spark, tmp_path):
    path = f"{tmp_path}/t"
    for number, (kind, value) in enumerate([("int", 1), ("int", 2), ("long", 2**40), ("long", 5), ("decimal(12,2)", Decimal("1.50"))]):
        df = spark.createDataFrame([(value, number)], f"c {kind}, n int")
        sink.append_batch(df if number != 3 else df.withColumn("late", F.lit("x")), path, number)
    got = source.read_table(spark, path)
    assert got.schema["c"].dataType == T.StringType()
    assert rows(got, "n", "c", "late") == bag((0, "1", None), (1, "2", None), (2, str(2**40), None), (3, "5", "x"), (4, "1.50", None))
    first = source.widened(spark, path, [0, 1, 2, 3])
    assert first.schema["c"].dataType == T.LongType() and rows(first, "c") == bag((1,), (2,), (2**40,), (5,))
    assert source.commit_numbers(spark, path) == [0, 1, 2, 3, 4] and source.commit_numbers(spark, f"{tmp_path}/none") == []
    assert source.newest_commit(spark, path).first()[0] == 4 and source.newest_commit(spark, f"{tmp_path}/none").first()[0] is None


# --- lost offsets


@pytest.mark.parametrize("span", [1, 4, 1000])
def test_gaps_of_offsets(spark, span):
    r = random.Random(span)
    held = [(p, o, r.randrange(4)) for p in range(3) for o in range(60) if r.random() < 0.6]
    held += held[:5] + [(0, None, 1)]  # repeated records, and one without an offset
    df = spark.createDataFrame([("t", *x) for x in held], "_kafka_topic string, _kafka_partition int, _kafka_offset long, _batch_id long")
    want = bag()
    for p in range(3):
        there = sorted({(o, c) for q, o, c in held if q == p and o is not None})
        for (a, c), (b, d) in zip(there, there[1:], strict=False):
            if b - a > 1:
                want[("t", p, a + 1, b - 1, b - a - 1, c, d)] += 1
    assert rows(source.offset_gaps(df, span)) == want
    assert source.offset_gaps(df.limit(0), span).count() == 0


# --- keys without a state, keys with nulls


def test_stateless_dedup_keeps_no_state(spark, tmp_path):
    cols = columns("k long, part string, at timestamp")
    spec = SilverSpec("t", "streaming_append", "t", ("k", "part"), cols, order_col="at", delay="1 minute",
                      partition_cols=("part",), stateless=True)
    raw, lake = BronzeSpec("t", "json", "streaming", cols), refresh.Layout(f"{tmp_path}/lake")
    feeds = [[(1, "a"), (1, "a"), (2, "b")], [(1, "a"), (3, "a"), (None, "a")], [(2, "b"), (1, "b"), (None, "a")]]
    for number, feed in enumerate(feeds):  # event times go back from feed to feed: nothing is too late
        made = spark.createDataFrame(feed, "k long, part string").withColumn("at", F.timestamp_seconds(F.lit(10**6 - 10**5 * number)))
        sink.append_batch(made, lake.table("bronze", "t"), number)
        control.log_run(spark, lake.control, lake.pipeline("bronze", "t"), "t", f"r{number}", control.SUCCESS, notes=str(number))
        run = refresh.promote(spark, spec, raw, lake)
    assert run.counts["duplicate"] == 1 and run.rows_written == 2
    assert rows(refresh.read_silver(spark, spec, lake), "k", "part") == bag(
        (1, "a"), (2, "b"), (3, "a"), (None, "a"), (1, "b"), (None, "a"))
    assert not (tmp_path / "lake/_checkpoints/silver/t/g0/state").exists()
    with pytest.raises(ValueError, match="stateless"):
        SilverSpec("t", "streaming_append", "t", ("k",), cols, stateless=True, bounded=True)


def test_null_keys_of_the_state_are_spread(spark, tmp_path):
    """A hundred thousand state rows without a key stay in the tasks that read them."""
    keyed = spark.range(1000).selectExpr("id AS k", "1 AS v", "1 AS seq")
    state = keyed.unionByName(spark.range(0, 100_000, 1, 8).selectExpr("CAST(NULL AS BIGINT) AS k", "2 AS v", "1 AS seq"))
    state.write.parquet(f"{tmp_path}/state")
    state = spark.read.parquet(f"{tmp_path}/state")
    feed = spark.createDataFrame([(5, 9, 2), (2000, 9, 2), (None, 9, 2)], "k long, v int, seq int")
    merged = merge.full_merge(state, feed, ["k"], "seq")
    assert rows(merged.groupBy("k", "v").count().filter("k IS NULL OR v = 9")) == bag(
        (None, 2, 100_000), (None, 9, 1), (5, 9, 1), (2000, 9, 1))
    assert merged.count() == 101_002
    per_task = merged.filter("k IS NULL").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task <= 30_000

"""Landing sources, table reads, sinks, and the plans they give."""

import re
from pathlib import Path

import pytest
from helpers import bag, plan, rows
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from strataflow.operators import merge
from strataflow.operators.latest import latest_per_key
from strataflow.sinks import tables as sink
from strataflow.sinks.tables import append_stream
from strataflow.sources.kafka import kafka_options
from strataflow.sources.landing import files_dated, read_landing, read_landing_stream
from strataflow.sources.tables import change_range, commit_folders, current_version, read_commits, read_table
from strataflow.spec import BronzeSpec, build_schema, columns

KV = columns("k long, v string")


def kv(spark, *data):
    return spark.createDataFrame(list(data), build_schema(KV))


def scans_files(df) -> int:
    """Files a finished plan has read."""
    df.collect()

    def walk(node):
        if "Scan" in node.nodeName():
            yield node.metrics().get("numFiles").get().value()
        children = node.children().iterator()
        while children.hasNext():
            yield from walk(children.next())

    return sum(walk(df._jdf.queryExecution().executedPlan()))


def drained(spark, stream, tmp_path):
    sink.append_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    return read_table(spark, f"{tmp_path}/out", stream.schema)


@pytest.mark.parametrize("fmt, options", [
    ("parquet", {}), ("json", {}), ("csv", {"header": "true"}), ("orc", {})])
def test_landing_formats(spark, tmp_path, fmt, options):
    data = kv(spark, (1, "a"), (2, None), (3, "c,d"))
    data.write.format(fmt).options(**options).save(f"{tmp_path}/in")
    declared = BronzeSpec("t", fmt, columns=KV, landing=f"{tmp_path}/in", read_options=options)
    assert rows(drained(spark, read_landing_stream(spark, declared), tmp_path), "k", "v") \
        == rows(data)
    inferred = BronzeSpec("t", fmt, landing=f"{tmp_path}/in",
                          read_options={**options, "inferSchema": "true"})
    assert rows(read_landing(spark, inferred), "v") == rows(data, "v")
    assert read_landing_stream(spark, inferred).columns == ["k", "v"]


def test_landing_malformed_json_gives_nulls(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/2026-04-01.json").write_text('{"k":1,"v":"a"}\nnot json\n{"k":"x","v":"b"}\n')
    spec = BronzeSpec("t", "json", columns=KV, landing=f"{tmp_path}/in")
    assert rows(read_landing(spark, spec)) == bag((1, "a"), (None, None), (None, "b"))


def test_binary_landing_takes_jpg_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("img_A_20260401_1.jpg", "img_A_20260401_1.jpg.bak", "note.txt"):
        (tmp_path / "in" / name).write_bytes(b"12345")
    spec = BronzeSpec("t", "binaryFile", landing=f"{tmp_path}/in")
    out = drained(spark, read_landing_stream(spark, spec), tmp_path)
    assert [tuple(r) for r in out.select("length", "content").collect()] == [(5, b"12345")]


def test_dated_files_skip_the_others(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for day in range(1, 6):
        (tmp_path / f"in/2026-04-0{day}.json").write_text(f'{{"k":{day},"v":"a"}}')
    (tmp_path / "in/undated.json").write_text('{"k":9,"v":"a"}')
    spec = BronzeSpec("t", "json", columns=KV, landing=f"{tmp_path}/in")
    picked = files_dated(read_landing(spark, spec), "2026-04-02", "2026-04-04")
    assert rows(picked, "k") == bag((2,), (3,), (4,))
    assert scans_files(picked.select("k")) == 3


def test_change_range_bounds_and_pruning(spark, tmp_path):
    for number in range(4):
        sink.append_batch(kv(spark, (number, "a")).coalesce(1), f"{tmp_path}/t", number)
    commits = read_table(spark, f"{tmp_path}/t", build_schema(KV))
    assert current_version(commits).first()[0] == 3
    assert rows(change_range(commits, None, 1), "k") == bag((0,), (1,))
    assert rows(change_range(commits, 0, 2), "k") == bag((1,), (2,))  # commit 0 is a position
    assert rows(change_range(commits, 3, None), "k") == bag()
    one = change_range(commits, 1, 2)
    assert "PartitionFilters: [isnotnull(_batch_id" in plan(one)
    assert scans_files(one) == 1


def test_short_ranges_list_only_their_commits(spark, tmp_path):
    for number in (0, 1, 2, 5):  # numbers may have gaps
        sink.append_batch(kv(spark, (number, "a")).coalesce(1), f"{tmp_path}/t", number)
    schema = build_schema(KV)
    near = read_commits(spark, f"{tmp_path}/t", schema, 1, 5)
    assert rows(near, "k", "_batch_id") == bag((2, 2), (5, 5))
    assert len(near.inputFiles()) == 2
    assert rows(read_commits(spark, f"{tmp_path}/t", schema, None, 2), "k") == bag((0,), (1,), (2,))
    assert rows(read_commits(spark, f"{tmp_path}/t", schema, -5000, 1), "k") == bag((0,), (1,))


def test_commits_of_a_bucketed_table(spark, tmp_path):
    path, by = f"{tmp_path}/it's", (4, ["k"])
    table = sink.bucketed_name("bucketed-commits", path)
    sink.append_bucketed(kv(spark, *[(i, "a") for i in range(50)]), table, path, 0, by)
    sink.append_bucketed(kv(spark, (1, "half")), table, path, 1, by)
    sink.append_bucketed(kv(spark, (60, "b"), (61, "b")), table, path, 1, by)  # repeated commit
    assert spark.table(table).count() == 52
    spark.sql(f"DROP TABLE {table}")
    held = sink.open_bucketed(spark, table, path, build_schema(KV), by, commits=True)
    assert held.count() == 52 and held.filter("_batch_id = 1").count() == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")  # not the number of buckets
    try:
        feed = kv(spark, (60, "c"), (70, "c"), (70, "d"), (None, "n"))
        merge.distinct_keys(feed, ["k"]).write.parquet(f"{tmp_path}/feed")
        fresh = merge.insert_if_absent(
            held.drop("_batch_id"), spark.read.parquet(f"{tmp_path}/feed"), ["k"], "reduced")
        assert rows(fresh) == bag((70, "d"), (None, "n"))
        fresh.collect()
        text = plan(fresh).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    # One exchange, of the feed.
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text


def test_commit_is_repeatable(spark, tmp_path):
    sink.append_batch(kv(spark, (1, "half")), f"{tmp_path}/t", 0)
    sink.append_batch(kv(spark, (1, "a"), (2, "b")), f"{tmp_path}/t", 0)
    assert rows(read_table(spark, f"{tmp_path}/t", build_schema(KV)), "k", "v") == bag(
        (1, "a"), (2, "b"))


def test_a_heavy_partition_value_is_written_by_many_tasks(spark, tmp_path):
    data = spark.range(0, 300_000, 1, 32).select(
        F.expr("uuid()").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("heavy")).otherwise(
            F.concat(F.lit("p"), F.col("id") % 5)).alias("v"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1MB")
    try:
        sink.append_batch(data, f"{tmp_path}/t", 0, ["v"], clustered=True)
    finally:
        spark.conf.unset(key)
    files = {v: len(list((tmp_path / f"t/_batch_id=0/v={v}").glob("*.parquet")))
             for v in ("heavy", "p0")}
    assert 1 < files["heavy"] < 32 and files["p0"] < 32, files
    assert read_table(spark, f"{tmp_path}/t").count() == 300_000


def test_new_columns_appear_as_null_in_old_commits(spark, tmp_path):
    sink.append_batch(kv(spark, (1, "a")).select("k"), f"{tmp_path}/t", 0)
    sink.append_batch(kv(spark, (2, "b")), f"{tmp_path}/t", 1)
    for schema in (None, build_schema(KV)):
        assert rows(read_table(spark, f"{tmp_path}/t", schema), "k", "v") == bag(
            (1, None), (2, "b"))
    assert rows(sink.append_evolving(kv(spark, (1, "a")).select("k"), kv(spark, (2, "b")))) == bag(
        (1, None), (2, "b"))


def test_snapshots_stand_side_by_side(spark, tmp_path):
    sink.write_snapshot(kv(spark, (1, "a")), f"{tmp_path}/t", 0, ["v"], clustered=True)
    sink.write_snapshot(kv(spark, (1, "b")), f"{tmp_path}/t", 1, ["v"])
    assert rows(sink.read_snapshot(spark, f"{tmp_path}/t", 0), "k", "v") == bag((1, "a"))
    assert rows(sink.read_snapshot(spark, f"{tmp_path}/t", 1), "k", "v") == bag((1, "b"))


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    state = spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    path = f"{tmp_path}/t"
    sink.overwrite_buckets(sink.with_bucket(state, ["k"], 16), path, f"{tmp_path}/s0")

    def files():
        return {str(f) for f in (tmp_path / "t").glob("_bucket=*/*.parquet")}

    before = files()
    feed = kv(spark, (3, "new"), (1000, "new"))
    touched = sink.touched_buckets(feed, ["k"], 16)
    assert 1 <= len(touched) <= 2
    held = spark.read.parquet(path).filter(F.col("_bucket").isin(touched))
    assert "PartitionFilters: [" in plan(held) and "_bucket" in plan(held)
    merged = merge.incremental_replace(held.drop("_bucket"), feed, ["k"], "v")
    sink.overwrite_buckets(sink.with_bucket(merged, ["k"], 16), path, f"{tmp_path}/s1")
    kept = {f for f in before if f"_bucket={touched[0]}/" not in f
            and f"_bucket={touched[-1]}/" not in f}
    assert kept < files() and not (before - kept) & files()
    got = spark.read.parquet(path)
    assert got.count() == 201
    assert rows(got.filter("v = 'new'"), "k") == bag((3,), (1000,))


def test_saved_table_merges_without_moving_the_state(spark, tmp_path):
    state = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    sink.save_as_table(state, "saved_state", f"{tmp_path}/t", bucket_by=(8, ["k"]))
    latest_per_key(kv(spark, (1, "new"), (5000, "new")), ["k"], "v").write.parquet(
        f"{tmp_path}/feed")
    feed = spark.read.parquet(f"{tmp_path}/feed")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (4, 8, 64):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            merged = merge.incremental_replace(
                spark.table("saved_state"), feed, ["k"], "v", reduced=True)
            assert len(merged.collect()) == 1001
            text = plan(merged).split("Initial Plan")[0]
            assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
            assert "ShuffledHashJoin" in text  # the state is not sorted either
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)


def test_saved_table_partitioned_at_a_location(spark, tmp_path):
    sink.save_as_table(kv(spark, (1, "a")), "saved_parts", f"{tmp_path}/t", partition_cols=["v"])
    assert (tmp_path / "t/v=a").is_dir()
    assert rows(spark.table("saved_parts"), "k", "v") == bag((1, "a"))


def test_merge_into_is_left_to_the_catalog(spark, tmp_path):
    """Plain parquet tables refuse row-level operations; the statement itself resolves."""
    sink.save_as_table(kv(spark, (1, "a")), "merge_target", f"{tmp_path}/t")
    with pytest.raises(UnsupportedOperationException) as refused:
        sink.merge_into(kv(spark, (1, "b")), "merge_target", ["k"],
                        update_if=F.expr("src.v >= merge_target.v"),
                        insert_if=F.expr("src.v != 'D'"))
    assert refused.value.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION"


def test_filters_reach_the_scan(spark, tmp_path):
    from strataflow.functions.quality import range_filter
    from strataflow.spec import RangeRule

    kv(spark, (1, "a")).write.parquet(f"{tmp_path}/t")
    kept = range_filter(spark.read.parquet(f"{tmp_path}/t"), [RangeRule("k", 0, 5)]).select("k")
    text = plan(kept)
    assert "GreaterThanOrEqual(k,0)" in text and "LessThanOrEqual(k,5)" in text
    assert "ReadSchema: struct<k:bigint>" in text


def test_kafka_options():
    one = kafka_options("host:9092", "events", minPartitions="64")
    assert one == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "events",
        "startingOffsets": "earliest", "minPartitions": "64"}
    many = kafka_options("host:9092", "plant[.].*", pattern=True, startingOffsets="latest")
    assert many["subscribePattern"] == "plant[.].*" and "subscribe" not in many
    assert many["startingOffsets"] == "latest"


@pytest.mark.parametrize("after, upto", [(None, 0), (None, 7), (0, 1), (6, 123), (99, 100), (8, 1204), (-5, 11), (3, 3)])
def test_commit_folders_match_a_range(after, upto):
    pattern = commit_folders("t", after, upto)
    wanted = set(range(0 if after is None else max(after + 1, 0), upto + 1))
    inner = re.sub(r"[{,}]", lambda m: {"{": "(", ",": "|", "}": ")"}[m[0]], pattern.removeprefix("t/_batch_id="))
    assert {n for n in range(2000) if re.fullmatch(inner, str(n))} == wanted
    assert len(pattern) < 400


def test_a_logged_commit_is_not_rewritten(spark, tmp_path):
    """A replay of a commit that readers follow leaves its files; a foreign checkpoint is refused."""
    spark.range(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/cp"
    append_stream(stream, out, checkpoint).awaitTermination()
    files = read_table(spark, out).inputFiles()
    for mark in Path(checkpoint, "commits").iterdir():  # the mark of completion is lost, the entry is not
        mark.unlink()
    append_stream(stream, out, checkpoint, done=0).awaitTermination()
    assert read_table(spark, out).inputFiles() == files
    with pytest.raises(ValueError, match="checkpoint"):
        append_stream(stream, out, f"{tmp_path}/other", done=5)

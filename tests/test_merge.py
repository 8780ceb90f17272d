"""Merges on hand-made edge rows, and all plans against a plain Python model."""

import random

import pytest
from helpers import bag, plan, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strataflow.operators import merge
from strataflow.operators.latest import latest_per_key
from strataflow.operators.size import fits_broadcast

SCHEMA = "k int, v string, w int"
CDC = "k int, v string, seq int, op string"


def make(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


# --- latest row per key


def test_latest_takes_newest_nulls_last(spark):
    df = make(spark, [(1, "a", 1), (1, "b", 2), (1, "c", None), (2, "d", None), (None, "e", 1),
                      (None, "f", 2)])
    assert rows(latest_per_key(df, ["k"], "w")) == bag((1, "b", 2), (2, "d", None), (None, "f", 2))


def test_latest_breaks_ties_by_the_other_columns(spark):
    df = make(spark, [(1, "a", 1), (1, "b", 1), (1, None, 1)])
    for parts in (1, 2, 3):
        assert rows(latest_per_key(df.repartition(parts), ["k"], "w")) == bag((1, "b", 1))


def test_latest_without_other_columns_is_distinct(spark):
    assert rows(latest_per_key(make(spark, [(1,), (1,)], "k int"), ["k"])) == bag((1,))


def test_latest_trims_before_the_shuffle(spark):
    text = plan(latest_per_key(make(spark, [(1, "a", 1)]), ["k"], "w"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


# --- patterns


def test_full_merge_edges(spark):
    state = make(spark, [(1, "old", 5), (2, "old", 5), (3, "old", 5), (4, "old", None),
                         (5, "old", 5), (None, "old", 1)])
    feed = make(spark, [(1, "new", 6), (1, "newer", 7), (2, "stale", 4), (3, "same", 5),
                        (4, "new", 9), (5, "null", None), (6, "insert", None), (None, "new", 2)])
    assert rows(merge.full_merge(state, feed, ["k"], "w")) == bag(
        (1, "newer", 7), (2, "old", 5), (3, "same", 5), (4, "old", None), (5, "old", 5),
        (6, "insert", None), (None, "old", 1), (None, "new", 2))


def test_incremental_replace_always_replaces_unless_guarded(spark):
    state = make(spark, [(1, "old", 5), (2, "old", 5)])
    feed = make(spark, [(1, "late", 4)])
    assert rows(merge.incremental_replace(state, feed, ["k"], "w")) == bag(
        (1, "late", 4), (2, "old", 5))
    assert rows(merge.incremental_replace(state, feed, ["k"], "w", guard=True)) == bag(
        (1, "old", 5), (2, "old", 5))


def test_cdc_merge_edges(spark):
    state = make(spark, [(1, "a", 1, "I"), (2, "a", 3, "I"), (3, "a", 2, "D"), (4, "a", 1, "I")],
                 CDC)
    feed = make(spark, [
        (1, "gone", 2, "D"),        # soft delete stays as a row
        (2, "stale", 2, "U"),       # older than stored
        (3, "back", 3, "U"),        # revived
        (4, "x", 1, None),          # same sequence, no operation: still replaces
        (5, "x", 2, "D"),           # delete of an unknown key: ignored
        (6, "x", 2, None),          # no operation: not inserted
        (7, "x", 2, "U"),           # update of an unknown key: inserted
        (8, "i", 1, "I"), (8, "d", 2, "D"),  # born and gone in one feed: ignored
    ], CDC)
    merged = merge.cdc_merge(state, feed, ["k"], "seq", "op")
    assert rows(merged) == bag(
        (1, "gone", 2, "D"), (2, "a", 3, "I"), (3, "back", 3, "U"), (4, "x", 1, None),
        (7, "x", 2, "U"))


def test_cdc_result_depends_on_how_the_feed_is_cut(spark):
    feed = make(spark, [(1, "i", 1, "I"), (1, "d", 2, "D")], CDC)
    once = merge.cdc_merge(None, feed, ["k"], "seq", "op")
    step = merge.cdc_merge(None, feed.filter("seq = 1"), ["k"], "seq", "op")
    step = merge.cdc_merge(step, feed.filter("seq = 2"), ["k"], "seq", "op")
    assert (rows(once), rows(step)) == (bag(), bag((1, "d", 2, "D")))


def test_cdc_delete_flag_from_operation(spark):
    feed = make(spark, [(1, "a", 1, "I", None), (2, "a", 1, None, True)], CDC + ", gone boolean")
    state = merge.cdc_merge(None, feed, ["k"], "seq", "op", delete_col="gone")
    change = make(spark, [(1, "a", 2, "D", False)], CDC + ", gone boolean")
    state = merge.cdc_merge(state, change, ["k"], "seq", "op", delete_col="gone")
    assert rows(state, "k", "gone") == bag((1, True))


@pytest.mark.parametrize("small", [False, True])
def test_stamps_and_schema_drift(spark, small):
    state = make(spark, [(1, 1, "c1", "m1", "x"), (2, 9, "c1", "m1", "x"), (3, 1, "c1", "m1", "x")],
                 "k int, w int, _silver_created_at string, _silver_modified_at string, gone string")
    feed = make(spark, [(1, 2, "c2", "m2", "n"), (2, 2, "c2", "m2", "n"), (4, 2, "c2", "m2", "n")],
                "k int, w int, _silver_created_at string, _silver_modified_at string, extra string")
    seen = Observation()
    merged = merge.full_merge(state, feed, ["k"], "w", small_feed=small, applied=seen)
    assert merged.columns == [*state.columns, "extra"]
    assert rows(merged) == bag(
        (1, 2, "c1", "m2", "x", "n"), (2, 9, "c1", "m1", "x", None), (3, 1, "c1", "m1", "x", None),
        (4, 2, "c2", "m2", None, "n"))
    assert seen.get == {"rows": 2}


def test_history_keeps_null_keys_and_first_versions(spark):
    history = make(spark, [(1, "a", 1), (None, "a", 1)])
    feed = make(spark, [(1, "b", 1), (2, "a", 1), (2, "b", 1), (None, "a", 1), (None, "a", 1)])
    got = rows(merge.cdc_history(history, feed, ["k", "w"]))
    assert got == bag((1, "a", 1), (None, "a", 1), (2, "b", 1), (None, "a", 1), (None, "a", 1))
    kept = rows(merge.cdc_history(history, feed, ["k", "w"], within_feed="keep"))
    assert kept == got + bag((2, "a", 1))


def test_contested_keys(spark):
    table = make(spark, [(1, "t", 0), (9, "t", 0)])
    feed = make(spark, [(1, "f", 0), (2, "f", 0), (2, "g", 0), (3, "f", 0), (None, "f", 0)])
    for small in (False, True):
        assert rows(merge.contested_keys(table, feed, ["k"], small_feed=small)) == bag((1,), (2,))
    assert rows(merge.contested_keys(None, feed, ["k"])) == bag((2,))


# --- against a model


def model(state, feed, kind):
    """Rows are (k, v, w, op); keys non-null."""

    def rank(r):  # by w, then v, then op; null is lowest
        return [(0,) if x is None else (1, x) for x in (r[2], r[1], r[3])]

    best = {}
    for r in feed:
        if r[0] not in best or rank(r) > rank(best[r[0]]):
            best[r[0]] = r
    out = {r[0]: r for r in state}
    for k, r in best.items():
        if k not in out:
            if kind != "cdc" or (r[3] is not None and r[3] != "D"):
                out[k] = r
        elif kind == "replace" or (
                r[2] is not None and out[k][2] is not None and r[2] >= out[k][2]):
            out[k] = r
    return bag(*out.values())


def random_rows(rng, n, unique):
    keys = rng.sample(range(60), n) if unique else [rng.choice([7] + list(range(60)))
                                                    for _ in range(n)]
    return [(k, rng.choice("abc") if rng.random() > 0.1 else None,
             rng.choice([1, 2, 3, 4, None]), rng.choice(["I", "U", "D", None])) for k in keys]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("kind", ["full", "replace", "cdc"])
def test_merge_plans_agree_with_model(spark, seed, kind):
    rng = random.Random(seed)
    schema = "k int, v string, w int, op string"
    state_rows, feed_rows = random_rows(rng, 30, True), random_rows(rng, 120, False)
    state = make(spark, state_rows, schema)
    feed = make(spark, feed_rows, schema).repartition(5)

    def run(current, **options):
        if kind == "full":
            return merge.full_merge(current, feed, ["k"], "w", **options)
        if kind == "replace":
            return merge.incremental_replace(current, feed, ["k"], "w", **options)
        return merge.cdc_merge(current, feed, ["k"], "w", "op", **options)

    want = model(state_rows, feed_rows, kind)
    assert rows(run(state)) == want
    assert fits_broadcast(feed)
    assert rows(run(state, small_feed=True)) == want
    assert rows(run(state.limit(0))) == rows(run(None)) == model([], feed_rows, kind)
    assert rows(run(run(state))) == want  # a feed applied twice equals once


@pytest.mark.parametrize("seed", range(3))
def test_cutting_the_feed_does_not_matter(spark, seed):
    """For the guarded merge when the order is unique per key, and for appends of equal copies."""
    rng = random.Random(seed)
    unique = [(k, f"v{k}{w}", w) for k in range(12) for w in rng.sample(range(9), 4)]
    rng.shuffle(unique)
    copies = [rng.choice(unique) for _ in range(80)]
    for data, step in (
        (unique, lambda s, f: merge.full_merge(s, f, ["k"], "w")),
        (copies, lambda s, f: merge.cdc_history(s, f, ["k", "w"])),
        (copies, lambda s, f: merge.append_dedup(s, f, ["k", "v", "w"])),
    ):
        whole = rows(step(None, make(spark, data)))
        cut = sorted(rng.sample(range(1, len(data)), 2))
        state = None
        for part in (data[:cut[0]], data[cut[0]:cut[1]], data[cut[1]:]):
            state = step(state, make(spark, part))
        assert rows(state) == whole


@pytest.mark.parametrize("seed", range(3))
def test_insert_plans_agree(spark, seed):
    rng = random.Random(seed)
    schema = "k int, v string, w int, op string"
    held = make(spark, random_rows(rng, 30, True), schema)
    feed = make(spark, random_rows(rng, 100, False) + [(None, "n", 1, "I")] * 3, schema)
    contested = merge.contested_keys(held, feed, ["k"])
    for mode in ("distinct", "keep"):
        shuffled = merge.insert_if_absent(held, feed, ["k"], mode)
        passed = merge.insert_if_absent(held, feed, ["k"], mode, contested=contested)
        assert rows(shuffled) == rows(passed)
        known = {r[0] for r in held.select("k").collect()}
        new = {r[0] for r in feed.select("k").collect()} - known - {None}
        assert {r[0] for r in shuffled.collect()} - {None} == new
        assert shuffled.filter("k IS NULL").count() == 3


# --- plans


def test_small_feed_does_not_shuffle_the_state(spark, tmp_path):
    spark.range(1000).selectExpr("CAST(id AS int) k", "'a' v", "1 w").write.parquet(
        f"{tmp_path}/state")
    state = spark.read.parquet(f"{tmp_path}/state")
    staged = make(spark, [(1, "b", 2)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(merge.upsert(state, staged, ["k"], small_feed=True))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" not in text
    first = text.split("Union")[1].split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in first
    assert "BroadcastHashJoin" in text


def test_uncontested_rows_are_not_shuffled(spark, tmp_path):
    spark.range(100).selectExpr("CAST(id AS int) k", "'wide' v", "1 w").write.parquet(
        f"{tmp_path}/feed")
    feed = spark.read.parquet(f"{tmp_path}/feed")
    contested = make(spark, [(1,)], "k int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(merge.insert_if_absent(None, feed, ["k"], contested=contested))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    clear = text.split("Union")[1].split(":-")[1]
    assert "LeftAnti" in clear and "Exchange hashpartitioning" not in clear


def test_frequent_key_is_split_when_all_copies_are_kept(spark, tmp_path):
    spark.range(0, 400_000, 1, 8).selectExpr(
        "CAST(IF(id % 3 = 0, -1, id) AS int) k", "uuid() v", "1 w").write.parquet(
        f"{tmp_path}/feed")
    feed = spark.read.parquet(f"{tmp_path}/feed")
    held = make(spark, [(5, "t", 1)])
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        kept = merge.insert_if_absent(held, feed, ["k"], "keep")
        assert len(kept.collect()) == 400_000 - 1
        assert "skew=true" in plan(kept)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_fits_broadcast_measures(spark):
    df = spark.range(100).withColumn("s", F.repeat(F.lit("x"), 1000))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=100_000)
    assert fits_broadcast(df, max_rows=100, max_bytes=200_000)
    assert not fits_broadcast(df.withColumn("a", F.array("id")))

"""The pipeline's stages on whole tables, and the registered queries against SQL."""

from collections import Counter

import pytest
from oracle import TESTDATA, compare, database
from pyspark.sql import functions as F
from test_operators import brute_components, windows_of

import corpus_pipeline
from strataflow.llm import mixing, queries
from strataflow.llm.common import table

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_agrees_with_sql(spark, name):
    outcome = compare(spark, database(SF_DIR), SF_DIR, name)
    assert outcome[0] == ("match" if name in queries.ORACLES else "rows only"), outcome
    assert outcome[1] > 0


def test_stages(spark):
    docs, rows = table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), name)
        rows[name] = docs.collect()
    raw = sorted((r.doc_id, r.text) for r in rows["language_id"])
    _, roots = brute_components([t for _, t in raw], 5, 80)
    first = {raw[i][0] for i, root in enumerate(roots) if i == root}
    assert {r.doc_id for r in rows["near_duplicates"]} == first and len(rows["near_duplicates"]) == len(first)
    items = [windows_of(r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    grams = {tuple(w[k : k + min(10, len(w))]) for w in items if w for k in range(max(len(w) - 9, 1))}
    lengths = {len(g) for g in grams}
    clean = {r.doc_id for r in rows["near_duplicates"]
             if not any(tuple(w[k : k + n]) in grams for w in [windows_of(r.text)] for n in lengths for k in range(len(w) - n + 1))}
    assert {r.doc_id for r in rows["decontamination"]} == clean
    assert {r.doc_id for r in rows["mixing"]} <= clean and max(Counter(r.doc_id for r in rows["mixing"]).values()) <= 2
    assert len(rows["sharding"]) == len(rows["mixing"])
    per = Counter(r.shard for r in rows["sharding"])
    assert max(per.values()) - min(per.values()) <= 1


def test_mixed_copies_are_shuffled_within_their_shards(spark):
    docs = table(spark, SF_DIR, "documents")
    blocks = {}
    for r in mixing.mix_sources(docs).collect():
        blocks.setdefault(r.doc_id, []).extend((b.part, b.place) for b in r.mix_blocks)
    assert max(map(len, blocks.values())) == 2
    got = corpus_pipeline.mixed(spark, docs, SF_DIR).select("doc_id", F.spark_partition_id().alias("task")).collect()
    assert Counter(r.doc_id for r in got) == Counter({k: len(v) for k, v in blocks.items() if v})
    for task in {r.task for r in got}:
        ids, last = [r.doc_id for r in got if r.task == task], (-1, 0)
        for i in ids:  # some copy of each document stands behind the one before
            later = [b for b in blocks[i] if b > last]
            assert later, (task, i)
            last = min(later)


def test_run_agrees_again(spark):
    key = lambda df: sorted((r.doc_id, r.shard, r.slot) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF_DIR)) == key(corpus_pipeline.run(spark, SF_DIR))

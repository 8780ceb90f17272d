"""From raw documents to training shards: five corpus operators in a row.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. Stages
are written as Parquet below the shared folder and read again, so a lost executor or a stopped run
costs one stage. SQL cannot express the learned, hashed and random stages, so there is no SQL for the
whole; tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import decontaminate, langid, mixing, ngramjoin, sharding
from strataflow.llm.common import fresh, table, written

SHARDS = 40


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned; those that the operator rejects go."""
    model = langid.fit(docs, F.coalesce(langid.remainder(F.col("doc_id"), 3) != 1, F.lit(False)))
    return langid.identify(docs, model).filter(~F.col("rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.8 or more on 5-word shingles connect."""
    return ngramjoin.keep_one(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares, one row per copy, shuffled within the mix's own shards."""
    return mixing.mixed_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their slot in it.

    Slots are dealt to the rows of the files by number; the texts are joined once. Documents that are no
    scan of files are written first. Columns named shard or slot are replaced; repeated rows and null
    ids are rows like others; no rows give none.
    """
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = written(docs.select(*columns), "shard-input")
    file, row, digest = fresh("file"), fresh("row"), fresh("digest")
    keyed = docs.select(*columns, F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    narrow = written(keyed.select(file, row, "doc_id", "source", F.xxhash64("text").alias(digest)), "shard-rows")
    slots = sharding.shard_rows(narrow, SHARDS, text=digest).select(file, row, "shard", "slot")
    return keyed.join(slots, [file, row]).select(*columns, "shard", "slot")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", clean_of_benchmarks),
    ("mixing", mixed),
    ("sharding", sharded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

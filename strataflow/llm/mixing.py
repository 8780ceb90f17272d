"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Units: a *block* is one whole document taken once. A source's target, in words, fixes how many blocks it
gives; the tree then decides how many blocks of every source each output shard receives, and the
blocks themselves are drawn from the source's seeded permutation, one disjoint run per shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import count_words, fresh, ranked, ship

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_TIMES = 2
#: Sources; with more of them their rows of totals are joined by a shuffle.
MOST_BROADCAST = 100_000


@F.arrow_udf(T.LongType())
def _word_counts(texts: pa.Array) -> pa.Array:
    return pa.array(count_words(texts), pa.int64())


def words(text: Column) -> Column:
    """The number of blank-separated words; null counts 0."""
    return _word_counts(text)


def targets(sizes: list[int], weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST_TIMES) -> list[float]:
    """Words wanted of each source, in the given order: ``share`` of all words dealt by the repeating
    weights, no source above ``most`` times its size, the excess dealt again by weight."""
    caps = [float(most * s) for s in sizes]
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    wanted, open_, left = [0.0] * len(sizes), list(range(len(sizes))), share * sum(sizes)
    while open_:
        by_weight = sum(weight[i] for i in open_)
        given = {i: left * weight[i] / by_weight for i in open_}
        over = [i for i in open_ if given[i] > caps[i]]
        if not over:
            for i in open_:
                wanted[i] = given[i]
            break
        for i in over:
            wanted[i] = caps[i]
            left -= caps[i]
        open_ = [i for i in open_ if given[i] <= caps[i]]
    return wanted


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of every source for every shard, shape (shards, sources).

    The range of shards is halved again and again. At each node the left half receives its exact
    number of blocks, drawn without replacement from the node's blocks of all sources, so the counts
    follow the multivariate hypergeometric law and add up exactly. Every node has a generator of its
    own, seeded by its range, so a part of the tree can be drawn again alone.
    """
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    room = np.diff(sum(quotas) * np.arange(shards + 1) // max(shards, 1))

    def halve(first: int, last: int, held: np.ndarray) -> None:
        if last - first == 1:
            out[first] = held
            return
        middle = (first + last) // 2
        rng = np.random.default_rng([seed, first, last])
        left, need, rest = np.zeros_like(held), int(room[first:middle].sum()), int(held.sum())
        for i, n in enumerate(held):  # the joint law as a chain of two-colour draws
            rest -= int(n)
            left[i] = _draw(rng, int(n), rest, need)
            need -= int(left[i])
        halve(first, middle, left)
        halve(middle, last, held - left)

    halve(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


#: numpy draws from urns of fewer balls only.
NUMPY_URN = 1_000_000_000
ONE_BY_ONE = 64


def _draw(rng, good: int, bad: int, taken: int) -> int:
    """How many of ``taken`` draws without replacement are good: the exact hypergeometric law at every size.

    In an urn too large for numpy every ball is first taken or left by a coin of its own, which two
    binomial draws tell by colour. Whatever number that takes, its good ones follow the hypergeometric
    law for that number; the balls missing are drawn from the rest of the urn, those too many from the
    balls taken. Their number is about the root of the urn's, so a few rounds end it.
    """
    if taken == 0 or good == 0:
        return 0
    if bad == 0:
        return taken
    if good + bad < NUMPY_URN:
        return int(rng.hypergeometric(good, bad, taken))
    if taken <= ONE_BY_ONE:
        found = 0
        for drawn in range(taken):
            found += int(rng.integers(good + bad - drawn)) < good - found
        return found
    coin = taken / (good + bad)
    some, others = int(rng.binomial(good, coin)), int(rng.binomial(bad, coin))
    short = taken - some - others
    if short >= 0:
        return some + _draw(rng, good - some, bad - others, short)
    return some - _draw(rng, some, others, -short)


def _closing(free: Column, gap: Column) -> Column:
    """Ranks of the free documents, sorted by falling size, that fill a gap: greedily, then one that oversteps it
    by less than is left."""
    start = F.struct(gap.alias("gap"), F.array().cast("array<bigint>").alias("took"))
    filled = F.aggregate(free, start, lambda held, d: F.when(
        d["size"] <= held["gap"],
        F.struct((held["gap"] - d["size"]).alias("gap"), F.array_append(held["took"], -d["late"].cast("bigint")).alias("took"))
    ).otherwise(held))

    def ended(held: Column) -> Column:
        last = F.element_at(F.filter(free, lambda d: ~F.array_contains(held["took"], -d["late"].cast("bigint"))), -1)
        over = F.get(F.filter(F.array(last), lambda d: d["size"] < 2 * held["gap"]), 0)
        return F.when(over.isNotNull(), F.array_append(held["took"], -over["late"].cast("bigint"))).otherwise(held["took"])

    return F.get(F.transform(F.array(filled), ended), 0)


def mix_sources(
    docs: DataFrame, shards: int = 8, text: str = "text", id_col: str = "doc_id", source: str = "source",
    weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST_TIMES, seed: int = 5, words_col: str | None = None,
    closing: int = 16,
) -> DataFrame:
    """One row per document: what the mix takes of it, and where the copies go.

    Adds ``mix_size`` (words), ``mix_source_size``, ``mix_target`` (its source's, in words),
    ``mix_taken`` (words taken, repeats counted, at most ``most`` times the size) and ``mix_blocks``,
    an array with one struct (part, place, words) per copy: its output shard, its place in that
    shard's own shuffle, and its words. All copies are whole.

    Every source is taken whole as often as its target allows; the rest comes from the front of the
    source's seeded permutation, as far as whole documents fit. The gap left, smaller than the next
    document, is closed with documents not yet taken, the longest that fits first, and at last with one
    more if that ends nearer to the target; of every power of two of sizes the first ``closing`` free ones
    stand by. So a source misses its target by half the next document at most, and by a few words
    where documents are many. The permuted copies of a source are numbered, and the runs that the tree gave to the shards are cut from those numbers, so shards
    hold disjoint blocks. Per source only a few rows of totals, and per source and shard one count, pass
    the driver; documents are numbered in ranges of the permutation, never by source in one task.

    ``words_col`` names a column that already holds the word counts; ``text`` then only has to tell
    different texts apart (a hash will do).

    Defined cases: sources come in code point order, null last, as a source of its own; a null or
    blank text has size 0 and no blocks; repeated rows are documents of their own; an empty table
    gives no rows; the caller's columns come back unchanged, ``mix_*`` columns are replaced.
    """
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_blocks")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    spark, own = ship(docs.sparkSession), F.col(f"`{source}`")
    size, spread, name = fresh("size"), fresh("spread"), fresh("source")
    rows = docs.withColumn(size, F.col(f"`{words_col}`") if words_col else words(F.col(f"`{text}`")))
    facts = sorted(
        (
            (r[0], int(r[1]), int(r[2]), int(r[3]))
            for r in rows.groupBy(own).agg(
                F.count(F.lit(1)), F.sum(size), F.count(F.when(F.col(size) > 0, True))
            ).collect()  # one row per source
        ),
        key=lambda r: (r[0] is None, r[0] or ""),
    )
    wanted = targets([f[2] for f in facts], weights, share, most)
    total = sum(f[1] for f in facts)
    plan = []
    for (which, _, held, _), target in zip(facts, wanted, strict=True):
        times = min(int(target // held), most) if held else 0
        plan.append((which, held, target, times, min(round(target) - times * held, held) if times < most else 0))
    kind = docs.schema[source].dataType
    fields = T.StructType([
        T.StructField(name, kind), T.StructField("mix_source_size", T.LongType()),
        T.StructField("mix_target", T.DoubleType()), T.StructField(name + "t", T.LongType()),
        T.StructField(name + "r", T.LongType()),
    ])
    rows = rows.withColumn(spread, F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text}`")))
    rows, rank, before = ranked(rows, [own, F.col(size) > 0], F.col(spread), total, F.col(size))
    # One row per source, as many as the driver just held: small enough to broadcast below the bound.
    near = F.broadcast if len(facts) <= MOST_BROADCAST else (lambda df: df)
    rows = rows.join(near(spark.createDataFrame(plan, fields)), own.eqNullSafe(F.col(name)))
    end = F.col(before) + F.col(size)
    fits, beyond = (F.col(size) > 0) & (end <= F.col(name + "r")), (F.col(size) > 0) & (end > F.col(name + "r"))
    # How far whole documents go, and those that then close the gap.
    front = {r[0]: (int(r[1]), int(r[2])) for r in rows.groupBy(own).agg(
        F.count_if(fits), F.coalesce(F.max(F.when(fits, end)), F.lit(0))).collect()}
    gaps = spark.createDataFrame(
        [(p[0], p[4] - front[p[0]][1]) for p in plan if p[4] > front[p[0]][1]],
        T.StructType([T.StructField(name + "3", kind), T.StructField(name + "g", T.LongType())]))
    free = rows.filter(beyond).select(own.alias(name + "4"), F.col(size).alias("size"), F.col(rank).alias("rank"))
    first = F.row_number().over(Window.partitionBy(name + "4", F.floor(F.log2("size"))).orderBy("rank"))
    free = free.withColumn("k", first).filter(F.col("k") <= closing).groupBy(name + "4").agg(
        F.sort_array(F.collect_list(F.struct("size", (-F.col("rank")).alias("late"))), asc=False).alias("free"))
    closers = {r[0]: list(r[1]) for r in free.join(near(gaps), F.col(name + "4").eqNullSafe(F.col(name + "3"))).select(
        name + "4", _closing(F.col("free"), F.col(name + "g"))).collect()}
    blocks = [p[3] * f[3] + front[f[0]][0] + len(closers.get(f[0], ())) for f, p in zip(facts, plan, strict=True)]
    dealt = split_quotas(blocks, shards, seed)
    ends = np.cumsum(dealt, axis=0)
    cuts = spark.createDataFrame(
        [(f[0], f[3], front[f[0]][0], closers.get(f[0], []), [int(x) for x in ends[:, i]]) for i, f in enumerate(facts)],
        T.StructType([
            T.StructField(name + "2", kind), T.StructField(name + "n", T.LongType()),
            T.StructField(name + "e", T.LongType()), T.StructField(name + "l", T.ArrayType(T.LongType())),
            T.StructField(name + "c", T.ArrayType(T.LongType())),
        ]),
    )
    rows = rows.join(near(cuts), own.eqNullSafe(F.col(name + "2")))
    turn = F.array_position(F.col(name + "l"), F.col(rank).cast("long"))
    closes = (F.col(size) > 0) & (turn > 0)
    number = F.col(name + "t") + (fits | closes).cast("int")
    rows = rows.withColumn("mix_taken", F.col(size) * number)
    # Copies in the permutation's order: the whole rounds first, then the front of it once more, then the closing ones.
    copy = lambda i: i * F.col(name + "n") + F.when(
        (i == F.col(name + "t")) & closes, F.col(name + "e") + turn - 1).otherwise(F.col(rank))
    copies = F.when((F.col(size) > 0) & (number > 0), F.transform(
        F.sequence(F.lit(0), number.cast("int") - 1),
        lambda i: F.struct(
            F.size(F.filter(F.col(name + "c"), lambda e: e <= copy(i))).alias("part"),
            F.xxhash64(F.lit(seed + 1), F.col(spread), i).alias("place"),
            F.col(size).alias("words"),
        ),
    )).otherwise(F.array().cast("array<struct<part:int,place:bigint,words:bigint>>"))
    return rows.select(
        *columns, F.col(size).alias("mix_size"), "mix_source_size", "mix_target", "mix_taken",
        copies.alias("mix_blocks"),
    )


def mixed_rows(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per copy, shuffled within its output shard.

    A document that the mix takes twice appears twice; one that it does not take is absent; all copies
    are whole. Texts without words carry none of a source's weight and are absent.
    """
    block = fresh("block")
    mix = mix_sources(docs, text=text, **options)
    rows = mix.select("*", F.explode("mix_blocks").alias(block))
    rows = rows.repartition(F.col(block)["part"], F.shiftrightunsigned(F.col(block)["place"], 56))
    rows = rows.sortWithinPartitions(F.col(block)["part"], F.col(block)["place"])
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])

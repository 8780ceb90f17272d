"""Exact n-gram Jaccard join with a token-group matrix."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import done_with, fresh, mix, ship, text_chunks, word_hashes, written

SHINGLE = 5
PERCENT = 80
#: Rows of two numbers; with more of them the texts are joined by a shuffle.
MOST_BROADCAST = 1_000_000


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of every text's word k-grams (with fewer words: of all of them)."""
    sets = []
    joined = b"\n".join(texts)
    hashes, starts = word_hashes(joined)
    ends = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.searchsorted(starts, ends)
    n = max(len(hashes) - k + 1, 0)
    grams = np.zeros(n, np.uint64)
    for i in range(k):
        grams += mix(hashes[i : i + n] + np.uint64(i + 1))
    grams = mix(grams)
    first = 0
    for last in cuts:
        n = int(last) - first
        if n >= k:
            sets.append(np.unique(grams[first : last - k + 1]))
        elif n:
            short = np.zeros(1, np.uint64)
            for i in range(n):
                short += mix(hashes[first + i : first + i + 1] + np.uint64(i + 1))
            sets.append(mix(short + np.uint64(k - n)))
        else:
            sets.append(np.empty(0, np.uint64))
        first = int(last)
    return sets


def class_of(tokens: np.ndarray) -> bytes:
    """128 bits that equal sets share: two sums over the set."""
    low, high = mix(tokens + np.uint64(0x51)), mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    n = np.uint64(len(tokens))
    return mix(np.array([low.sum() + n, high.sum() ^ n], dtype=np.uint64)).tobytes()


def _part(percent: int) -> float:
    """The share of tokens looked at to rule documents out: what a partner may lack, and a margin."""
    return min(1.0, (100 - percent) / 100 + 0.10)


def _size_class(n: np.ndarray, percent: int) -> np.ndarray:
    """Sets that can link have classes at most one apart: a class spans the greatest ratio of linked sizes."""
    return np.floor(np.log(np.maximum(n, 1)) / (np.log(100 / percent) * (1 + 1e-6))).astype(np.int64)


def _marked(batches, k: int, percent: int):
    """Per text: set size, class, and the tokens below a bound, to be counted over the whole corpus.

    Tokens that several classes of a chunk with one size class share are known to be shared: the texts
    are credited at once (``known``), and only one row tells the rest of the corpus, so a very frequent
    token gives a row per chunk, not per text. ``own`` of the first tokens in the list belong to the
    class itself; of equal sets in a chunk only the first lists any.
    """
    bound = np.uint64(int(_part(percent) * (2**64 - 1)))
    for batch in batches:
        for first, held in text_chunks(batch, "text"):
            sets = shingle_sets(held, k)
            classes = [class_of(s) for s in sets]
            firsts = {c: i for i, c in reversed(list(enumerate(classes)))}
            looked = [s[s <= bound] if _part(percent) < 1 else s for s in sets]
            sizes = _size_class(np.array([len(s) for s in sets]), percent)
            heard = [t if firsts[c] == i else t[:0] for i, (t, c) in enumerate(zip(looked, classes, strict=True))]
            salted = [t ^ mix(np.array([c + 1], np.uint64)) for t, c in zip(heard, sizes, strict=True)]
            every, back, times = np.unique(np.concatenate(salted), return_inverse=True, return_counts=True)
            shared = times[back] > 1
            told = np.zeros(len(every), bool)
            at, rows = 0, []
            for tokens in heard:
                place, both = back[at : at + len(tokens)], shared[at : at + len(tokens)]
                news = both & ~told[place]
                told[place[news]] = True
                rows.append((int(both.sum()), int((~both).sum()), np.concatenate([tokens[~both], tokens[news]])))
                at += len(tokens)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").slice(first, len(held)),
                "mark": batch.column("mark").slice(first, len(held)),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "size_class": pa.array(sizes, pa.int64()),
                "cls": pa.array(classes, pa.binary()),
                "ref": pa.array([int.from_bytes(c[:8], "little", signed=True) for c in classes], pa.int64()),
                "looked": pa.array([len(t) for t in looked], pa.int64()),
                "known": pa.array([r[0] for r in rows], pa.int64()),
                "own": pa.array([r[1] for r in rows], pa.int32()),
                "tokens": _lists([r[2] for r in rows]),
            })


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    cuts = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int64)
    values = pa.array(np.concatenate(arrays).view(np.int64))
    return pa.LargeListArray.from_arrays(pa.array(cuts), values).cast(pa.list_(pa.int64()))


def _whole(batches, k: int):
    for batch in batches:
        for _, held in text_chunks(batch, "text"):
            sets = shingle_sets(held, k)
            yield pa.RecordBatch.from_pydict({
                "cls": pa.array([class_of(s) for s in sets], pa.binary()),
                "n": pa.array([len(s) for s in sets], pa.int64()), "tokens": _lists(sets),
            })


def _lacking(n: Column, percent: int) -> Column:
    """How many of a set's n tokens a partner may lack: n - ceil(percent * n / 100)."""
    return F.floor(n * F.lit(100 - percent) / F.lit(100.0) + F.lit(1e-9)).cast("long")


def _linked(a: Column, b: Column, na: Column, nb: Column, percent: int) -> Column:
    """100 * intersection >= percent * union, in integers."""
    common = F.size(F.array_intersect(a, b)).cast("long")
    return F.lit(100) * common >= F.lit(percent) * (na + nb - common)


def links(docs: DataFrame, k: int, percent: int, text: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(marks, roots): marks has doc_id, mark (a hash of the text), n and cls, one row per document;
    equal sets share a class. roots names the component (root) of classes that may have a partner.

    Links connect exactly what all links connect, without listing those between members of one star.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       F.xxhash64(F.col(f"`{text}`")).alias("mark"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    marks = rows.mapInArrow(
        lambda it: _marked(it, k, percent),
        f"doc_id {kind}, mark long, n long, size_class long, cls binary, ref long, looked long, known long, own int, tokens array<long>")
    wide = written(marks, "join-tokens")
    marks = written(wide.select("doc_id", "mark", "n", "cls"), "join-marks")

    # 1. Rule out what can have no partner: of the tokens looked at, a partner has all but _lacking(n).
    # A token counts as shared if another class of a size that could link has it. ref stands for the
    # class, in 64 bits; were two classes to share one, they would only be kept more easily.
    least = math.ceil(percent / max(1, 100 - percent))  # smaller sets link with equal ones only
    every = wide.filter(F.col("n") >= least)
    each = every.select("ref", "size_class", "own", F.posexplode("tokens").alias("pos", "token")).select(
        "token", "size_class", F.when(F.col("pos") < F.col("own"), F.col("ref")).alias("ref"))
    near = Window.partitionBy("token").orderBy("size_class").rangeBetween(-1, 1)
    seen = each.withColumn("told", F.count(F.lit(1)).over(near) > F.count("ref").over(near)).withColumn(
        "other", F.min("ref").over(near) < F.max("ref").over(near))
    met = seen.filter((F.col("told") | F.col("other")) & F.col("ref").isNotNull()).select("ref", "token").distinct().groupBy(
        "ref").agg(F.count(F.lit(1)).alias("met"))
    classes = every.groupBy("cls", "ref").agg(
        F.min(F.struct("doc_id", "mark")).alias("f"), F.max("n").alias("n"), F.max("looked").alias("looked"), F.max("known").alias("known"))
    able = classes.join(met, "ref", "left").filter(
        F.col("known") + F.coalesce("met", F.lit(0)) >= F.col("looked") - _lacking(F.col("n"), percent))
    pick = written(able.select(F.col("f")["doc_id"].alias("id2"), F.col("f")["mark"].alias("mark2")), "join-able")

    # 2. Whole sets of one text for each class that is left.
    done_with(wide)
    pick = F.broadcast(pick) if pick.count() <= MOST_BROADCAST else pick
    texts = rows.join(pick, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("mark") == F.col("mark2")), "left_semi")
    sets = texts.select("text").mapInArrow(lambda it: _whole(it, k), "cls binary, n long, tokens array<long>")
    sets = written(sets.dropDuplicates(["cls"]).withColumn("sid", F.monotonically_increasing_id()), "join-sets")

    # 3. Prefixes in one order for all sets: rare tokens first. A token of one set alone can meet no other.
    token = sets.select("sid", "n", F.explode("tokens").alias("token"))
    token = token.withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter(F.col("times") > 1)
    kept = token.groupBy("sid", "n").agg(F.sort_array(F.collect_list(F.struct("times", "token"))).alias("common"))
    length = (_lacking(F.col("n"), percent) + 1 - (F.col("n") - F.size("common"))).cast("int")
    kept = kept.select(
        "sid", "n", F.size("common").alias("m"), F.transform(F.slice("common", F.lit(1), F.greatest(F.lit(0), length)), lambda p: p["token"]).alias("prefix"),
        F.array_min(F.transform("common", lambda p: p["token"])).alias("home"),
        F.array_max(F.transform("common", lambda p: p["token"])).alias("away"))
    prefixes = written(kept.filter(F.size("prefix") > 0), "join-prefixes")

    # 4. Groups: sets that agree on their least token hash, then on their greatest, share most tokens as
    # a rule. The member with the fewest tokens of its own leads; those that reach the similarity to it
    # are its star, and the second round joins stars by their leaders.
    tokens = sets.select("sid", "tokens")
    placed, made = prefixes.select("sid", "n", "m", "prefix", "home", "away", F.col("sid").alias("star")), [sets, prefixes]
    for spot in ("home", "away"):
        tops = placed.filter(F.col("star") == F.col("sid")).select("sid", "n", "m", spot)
        heads = tops.groupBy(spot).agg(F.min(F.struct(F.col("n") - F.col("m"), "sid")).alias("h"), F.count(F.lit(1)).alias("members"))
        heads = heads.filter("members > 1").select(F.col(spot).alias("spot"), F.col("h")["sid"].alias("head"))
        lead = heads.join(sets.select(F.col("sid").alias("head"), F.col("n").alias("hn"), F.col("tokens").alias("ht")), "head")
        led = tops.join(tokens, "sid").join(lead, (F.col(spot) == F.col("spot")) & (F.col("sid") != F.col("head")) & _linked(
            F.col("tokens"), F.col("ht"), F.col("n"), F.col("hn"), percent)).select(F.col("sid").alias("was"), "head")
        placed = written(placed.join(led, F.col("star") == F.col("was"), "left").withColumn(
            "star", F.coalesce("head", "star")).drop("was", "head"), "join-placed")
        made.append(placed)

    # 5. The matrix: for every token the stars whose members' prefixes hold it, with the least size of a
    # star and, per token, how much of a member is left from that token on. That bounds what a query
    # and any member can have in common, if this token is the first they share; a star is opened only
    # where a link could still follow.
    bounds = placed.groupBy("star").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    each = placed.select("sid", "n", "m", "star", F.posexplode("prefix").alias("pos", "token")).withColumn("left", F.col("m") - F.col("pos"))
    cells = each.groupBy("star", "token").agg(F.max("left").alias("rest"))
    matrix = cells.join(bounds, "star").withColumnRenamed("star", "group")
    query = each.select("sid", "n", "star", "left", "token")
    most = F.least("left", "rest")
    fits = (F.col("high") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("low") * percent) & (
        most * (100 + percent) >= (F.col("n") + F.greatest(F.col("low"), most)) * percent)
    met = query.join(matrix, (query["token"] == matrix["token"]) & (F.col("star") < F.col("group")) & fits)
    opened = written(met.select("sid", "star", "group").distinct(), "join-open")

    # 6. Open the qualifying groups: the query against their members, exactly, up to the first link.
    mine = opened.join(sets.select("sid", "n", "tokens"), "sid")
    theirs = placed.select(F.col("sid").alias("other"), F.col("n").alias("on"), F.col("star").alias("in")).join(
        tokens.select(F.col("sid").alias("other"), F.col("tokens").alias("ot")), "other")
    close = (F.col("n") * 100 >= F.col("on") * percent) & (F.col("on") * 100 >= F.col("n") * percent)
    found = mine.join(theirs, (F.col("group") == F.col("in")) & close & _linked(
        F.col("tokens"), F.col("ot"), F.col("n"), F.col("on"), percent), "left_semi")
    # Members of a star are connected already: what remains are links between stars.
    edges = written(found.select("star", F.col("group").alias("to")).distinct(), "join-links")
    roots = components(edges, "star", "to")
    sided = placed.select("sid", "star").join(roots, F.col("star") == F.col("node"), "left").select(
        "sid", F.coalesce("root", "star").alias("root"))
    named = written(sided.join(sets.select("sid", "cls"), "sid").select("cls", "root"), "join-roots")
    done_with(*made, opened, edges, roots)
    return marks, named


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the connected components of a graph; equal roots mean one component.

    Each round every node joins its least neighbour (or stays, if it is the least itself), and the
    graph is contracted: an edge now joins what its ends joined, equal edges are one, and edges inside
    one node are gone. So the graph shrinks at least by half a round, whatever its shape. Rounds are
    written to the shared folder: a lost executor repeats one round at most.
    """
    graph = written(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).filter("u <> v").distinct(), "join-graph")
    labels = graph.select(F.col("u").alias("node")).unionByName(graph.select(F.col("v").alias("node"))).distinct()
    labels = written(labels.withColumn("root", F.col("node")), "join-labels")
    while not graph.isEmpty():
        old = [graph, labels]
        both = graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("was"), F.least("u", "v").alias("now"))
        # One jump more: the node that the neighbour itself joined.
        again = near.select(F.col("was").alias("mid"), F.col("now").alias("far"))
        joined = written(near.join(again, F.col("now") == F.col("mid")).select("was", "far"), "join-joined")
        labels = written(labels.join(joined, F.col("root") == F.col("was"), "left").select(
            "node", F.coalesce("far", "root").alias("root")), "join-labels")
        to = joined.select(F.col("was").alias("was2"), F.col("far").alias("far2"))
        moved = graph.join(joined, F.col("u") == F.col("was")).join(to, F.col("v") == F.col("was2"))
        graph = written(moved.select(F.least("far", "far2").alias("u"), F.greatest("far", "far2").alias("v")).filter(
            "u <> v").distinct(), "join-graph")
        done_with(*old, joined)
    return labels


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, ``n_shingles`` and ``component_id``.

    A document's set holds its distinct word k-grams (A-Z in lower case, words between blanks; with
    fewer words the whole sequence is the one element). Two documents link when the Jaccard
    similarity of their sets is at least ``percent``; ``component_id`` is the least doc_id that links
    can reach, its own included. The join is exact but for collisions of 64-bit token hashes.

    Equal sets are one class from the start. Classes are grouped, a group's matrix row is the union of
    its members' prefixes, and only groups that a query's prefix meets are opened. Bounds on group
    size hold nowhere: large groups are joined by Spark, split where they are skewed.

    Defined cases: null, empty or blank texts have no shingles and link with nothing; a null id is
    reached by links but is nobody's least id (alone it stays null); rows that repeat an id are
    documents of their own; an empty table gives no rows; other columns are not looked at.
    """
    out = _classified(docs, k, percent, text, id_col)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _classified(docs: DataFrame, k: int, percent: int, text: str, id_col: str) -> DataFrame:
    """Per row: doc_id, mark, n, component_id and root, which names the component."""
    marks, roots = links(docs, k, percent, text, id_col)
    roots = roots.select("cls", F.col("root").alias("found"))
    root, least = fresh("root"), fresh("least")
    own = F.when(F.col("n") > 0, F.coalesce(F.col("found").cast("string"), F.hex("cls")))
    whole = marks.join(roots, "cls", "left").select("doc_id", "mark", "n", own.alias("root"))
    ids = whole.filter("n > 0").groupBy(F.col("root").alias(root)).agg(F.min("doc_id").alias(least))
    return whole.join(ids, F.col("root") == F.col(root), "left").select(
        "doc_id", "mark", "n", "root",
        F.when(F.col("n") > 0, F.col(least)).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component of near duplicates: the one with the least id (then the
    least hash of its text), and one only where that row is repeated.

    Rows without shingles link with nothing and all stay. Null ids come first among a component's rows
    only if all its ids are null. The caller's columns come back unchanged.
    """
    rows = written(_classified(docs, k, percent, text, id_col), "join-rows")
    key, same, mark = fresh("id"), fresh("mark"), fresh("own")
    pair = [F.col("doc_id").alias(key), F.col("mark").alias(same)]
    first = rows.filter("n > 0").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("f")).select("f.doc_id", "f.mark").select(*pair)
    stay = written(first.unionByName(rows.filter("n = 0").select(*pair).distinct()), "join-stay")
    marked = docs.withColumn(mark, F.xxhash64(F.col(f"`{text}`")))
    found = F.col(f"`{id_col}`").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(same))
    kept = marked.join(stay, found, "left_semi")
    repeated = rows.filter("n > 0").groupBy("doc_id", "mark").count().filter("count > 1").join(
        first, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col("mark") == F.col(same)), "left_semi")
    if not repeated.isEmpty():  # only then is a pass over the kept rows worth its exchange
        repeated = written(repeated.select(*pair), "join-repeated")
        twice = kept.join(repeated, found, "left_semi").dropDuplicates([id_col, mark])
        kept = kept.join(repeated, found, "left_anti").unionByName(twice)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over training windows."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import fresh, written
from strataflow.operators.size import fits_broadcast

#: The same words before lower-casing, for counting and cutting.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: A table of windows, of their items or of anchors is broadcast within both bounds only.
MOST_WINDOWS, MOST_BYTES = 2_000_000, 256 << 20


def lowered(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    """The words of a text: runs of digits, letters and non-ASCII characters; null has none."""
    plain = F.trim(F.regexp_replace(lowered(F.coalesce(text, F.lit(""))), BREAK, " "))
    found = F.split(plain, " ")
    return F.when(found[0] == "", F.array().cast("array<string>")).otherwise(found)


def windows(bench: DataFrame, text: str, item: str, length: int) -> tuple[DataFrame, DataFrame]:
    """The distinct windows of the items, each with an anchor word, and the items of each window.

    A window is ``length`` consecutive words; an item of fewer, but not none, is one window. The
    anchor is the longest word of the window (the first of these): long words are rare words, so few
    positions of the training text have to be looked at closely.
    """
    listed = bench.select(F.col(f"`{item}`").alias("item"), words_of(F.col(f"`{text}`")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - F.lit(length), F.lit(0)))
    each = listed.select("item", "w", F.explode(starts).alias("s")).select(
        "item", F.slice("w", F.col("s") + 1, F.lit(length)).alias("w"))
    each = each.select("item", "w", F.array_join("w", " ").alias("gram"), F.size("w").alias("n"))
    longest = F.array_max(F.transform("w", lambda x: F.length(x)))
    anchored = each.withColumn("offset", F.array_position(F.transform("w", lambda x: F.length(x)), longest).cast("int") - 1)
    grams = anchored.groupBy("gram").agg(
        F.first("n").alias("n"), F.first("offset").alias("offset"),
        F.first(F.element_at("w", F.col("offset") + 1)).alias("anchor"))
    return grams, each.select("gram", "item").distinct()


END = "\u0000"


def find_hits(
    docs: DataFrame, bench: DataFrame, text: str = "text", id_col: str = "doc_id", item: str = "item_id",
    item_text: str = "text", length: int = WINDOW, most_windows: int = MOST_WINDOWS, most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """One row per different (id, text): id, ``mark`` (hash of the text), ``copies`` (rows that are alike),
    ``n_words``, ``spans`` (sorted starts and lengths, in words, of the windows found) and ``items``.

    The windows are a hash set keyed by their anchor words. It is broadcast if both its rows and its
    bytes were measured within ``most_windows`` and ``most_bytes``; a larger benchmark is joined by a
    shuffle on the anchors instead, with the same result. Then only positions that hold an anchor are
    shuffled (told by a broadcast of the distinct anchors, if these fit the same bounds), each with the
    words that a window there could reach. The items of the windows, as many as an item has windows in
    common with others, are measured on their own. Every position of a training text that holds an
    anchor opens the windows of that anchor, and a hit counts only when all words agree. One more
    position stands for the end of the text, so one pass over the texts also gives their word counts.
    """
    bounds = {"max_rows": most_windows, "max_bytes": most_bytes}
    grams, members = windows(bench, item_text, item, length)
    grams, members = written(grams, "grams"), written(members, "members")
    small = fits_broadcast(grams, **bounds)
    words, mark = fresh("words"), fresh("mark")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias(mark),
                       F.array_append(words_of(F.col(f"`{text}`")), F.lit(END)).alias(words))
    each = rows.select("id", mark, words, F.posexplode(words).alias("pos", "word"))
    first, over = F.col("pos") - F.col("offset"), F.col("n") == 0

    def agrees(base: Column) -> Column:
        """The window of ``gram`` lies round ``pos``; ``base`` is the position of the first word carried along."""
        return (first >= 0) & (
            F.array_join(F.slice(F.col(words), F.greatest(first - base, F.lit(0)) + 1, F.col("n")), " ") == F.col("gram"))

    if small:
        end = docs.sparkSession.range(1).select(
            F.lit(END).alias("gram"), F.lit(0).alias("n"), F.lit(0).alias("offset"), F.lit(END).alias("anchor"))
        hit = (F.col("word") == F.col("anchor")) & (over | agrees(F.lit(0)))
        found = each.join(F.broadcast(grams.unionByName(end)), hit).select("id", mark, first.alias("start"), "n", "gram")
    else:
        anchors = written(grams.select(F.col("anchor").alias("word")).distinct(), "anchors")
        near = each.filter(F.col("word") != END)
        near = near.join(F.broadcast(anchors), "word", "left_semi") if fits_broadcast(anchors, **bounds) else near
        base = F.greatest(F.col("pos") - F.lit(length - 1), F.lit(0))
        near = near.withColumn(words, F.slice(F.col(words), base + 1, F.lit(2 * length - 1)))
        hit = (F.col("word") == F.col("anchor")) & agrees(base)
        ends = rows.select("id", mark, (F.size(words) - 1).alias("start"), F.lit(0).alias("n"), F.lit(END).alias("gram"))
        found = near.join(grams, hit).select("id", mark, first.alias("start"), "n", "gram").unionByName(ends)
    # The spans of a text and its items are at most as many as its words and the benchmark's windows.
    per_text = written(found.groupBy("id", mark).agg(
        F.count(F.when(over, True)).alias("copies"), F.max(F.when(over, F.col("start"))).cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(~over, F.struct(F.col("start"), F.col("n"))))).alias("spans"),
        F.collect_set(F.when(~over, F.col("gram"))).alias("grams")), "hits")
    pairs = per_text.select("id", mark, F.explode("grams").alias("gram"))
    items = pairs.join(F.broadcast(members) if fits_broadcast(members, **bounds) else members, "gram").groupBy("id", mark).agg(
        F.collect_set("item").alias("items"))
    items = items.withColumnsRenamed({"id": "id2", mark: mark + "2"})
    return per_text.join(items, F.col("id").eqNullSafe(F.col("id2")) & (F.col(mark) == F.col(mark + "2")), "left").select(
        "id", F.col(mark).alias("mark"), "copies", "n_words", "spans", "items")


def report(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_hit`` (words inside a window found) and ``items``
    (the items found, sorted as strings). Options and defined cases are those of ``decontaminate``."""
    hits = find_hits(docs, bench, id_col=id_col, **options)
    listed = F.array_sort(F.transform(F.coalesce("items", F.array()), lambda x: x.cast("string")))
    rows = hits.select(
        F.col("id").alias(id_col), "n_words", covered(F.col("spans")).cast("long").alias("n_hit"), listed.alias("items"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return rows.select(id_col, "n_words", "n_hit", "items")


def covered(spans: Column) -> Column:
    """How many words the spans cover, words in several spans once."""
    ends = F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["n"]).alias("end"),
            (a["sum"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(a["end"], s["start"]))).alias("sum")))
    return ends["sum"]


def decontaminate(
    docs: DataFrame, bench: DataFrame, text: str = "text", id_col: str = "doc_id", item: str = "item_id",
    item_text: str = "text", length: int = WINDOW, remove: str = "documents", most_windows: int = MOST_WINDOWS, most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Training rows without benchmark passages; the columns of ``docs``.

    ``remove="documents"`` drops every document with a hit; ``"spans"`` keeps it and takes the hit
    words out (each run of hit words, with what stands between them, becomes one space; where the
    words left over form another window, a second call finds it). ``report`` counts and removes nothing.

    Defined cases: a null or wordless text has no words and no hits and is kept; an item without
    words is no window; texts of any length are read whole; repeated rows are judged alike, each on
    its own; null ids are ids; with an empty benchmark nothing is hit; the caller's columns come back
    as they are, whatever their names.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    hits = find_hits(docs, bench, text, id_col, item, item_text, length, most_windows, most_bytes).filter(F.size("spans") > 0)
    key, mark, spans = fresh("id"), fresh("mark"), fresh("spans")
    hits = hits.select(F.col("id").alias(key), F.col("mark").alias(mark), F.col("spans").alias(spans))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(key)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(mark))
    if remove == "documents":
        return docs.join(hits, same, "left_anti")
    out = docs.join(hits.select(key, mark, spans), same, "left")
    clean = F.when(F.col(spans).isNull(), F.col(f"`{text}`")).otherwise(_without(F.col(f"`{text}`"), F.col(spans)))
    return out.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def _without(text: Column, spans: Column) -> Column:
    """The text with the words of the spans, and what stands between them, as single spaces."""
    # Piece i is word i with what follows it up to the next word; piece 0 is what precedes the first.
    pieces = F.regexp_extract_all(text, F.lit(f"({RAW_WORD}{RAW_BREAK})"), F.lit(1))
    lead = F.regexp_extract(text, f"^({RAW_BREAK})", 1)
    hit = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1))))
    marked = F.transform(pieces, lambda p, i: F.when(F.array_contains(hit, i), F.lit("\u0000")).otherwise(p))
    return F.concat(lead, F.regexp_replace(F.array_join(marked, ""), "\u0000+", " "))

"""Spelling variants: words one edit apart, joined on PartEnum signatures of their letters."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import done_with, ship, written

PARTS = 4
SLICE = 1 << 20
HELD_WORDS = 1 << 18
OUT_ROWS = 1 << 16
WORDS_AT_ONCE = 2048
LONGER = 3
LAST = 4

# Letters are A-Z, a-z and U+00C0 to U+00FF; all other bytes of a Latin-1 text become blanks.
_LETTER = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256)
)


def _slices(data: bytes):
    """The text in runs of about SLICE bytes, cut at blanks."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def word_counts(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", least_chars: int = 5, least_count: int = 3,
    slip: int | None = None,
) -> DataFrame:
    """``word`` and ``n``: how often every word occurs in all texts together.

    A word is a maximal run of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z in lower case. With
    ``slip`` an occurrence whose checksum crc32(``<id>:<run>``) the number divides loses the code point
    at the checksum modulo the run's length, as a typist's slip would. Words of fewer than
    ``least_chars`` code points or ``least_count`` occurrences are left out. Every task adds up its own
    rows first, in a table of bounded size, so a word in every text costs a reducer one row per task.

    Defined cases: a null or empty text has no words; texts of any length are read in slices; a null id
    counts as an empty one; repeated rows count again; further columns are ignored; an empty table
    gives no rows.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").alias("text"))

    def count(batches):
        held: dict[bytes, int] = {}
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{key.as_py()}:".encode()) if slip else 0
                data = text.as_py().encode("latin-1", "replace").translate(_LETTER)
                for part in _slices(data):
                    for word, n in Counter(part.split()).items():
                        if slip:
                            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                            if h % slip == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                        if len(word) >= least_chars:
                            held[word] = held.get(word, 0) + n
                    if len(held) >= HELD_WORDS:
                        yield from _flushed(held)
        yield from _flushed(held)

    found = rows.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _flushed(held: dict[bytes, int]):
    words, counts = [w.decode("latin-1") for w in held], list(held.values())
    held.clear()
    for i in range(0, len(words), OUT_ROWS):
        yield pa.RecordBatch.from_arrays(
            [pa.array(words[i : i + OUT_ROWS], pa.string()), pa.array(counts[i : i + OUT_ROWS], pa.int64())], ["word", "n"])


def letter_parts(words: DataFrame, parts: int = PARTS) -> list[str]:
    """The letters of all words dealt to ``parts`` groups of about equal use, most used first.

    One row per letter reaches the driver: no more than the alphabet has letters.
    """
    used = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").groupBy("c").count().collect()
    groups, load = [""] * parts, [0] * parts
    for r in sorted(used, key=lambda r: (-r["count"], r["c"])):
        i = load.index(min(load))
        groups[i] += r["c"]
        load[i] += r["count"]
    return groups


def _signatures(words: list[str], choices: list[tuple[int, str]]) -> tuple[list[int], list[int], list[str]]:
    """Place of the word, kind and key of all signatures of some words.

    A key names the choice of letters left out, the length of the shorter word of a pair, one of its halves and the
    letters that remain. A kind is the number of groups left out, or LONGER for the word as the longer
    one of a pair; LAST is added for the last half.
    """
    place, kinds, keys = [], [], []
    tables = [(n, chr(i + 48), {ord(c): None for c in letters}) for i, (n, letters) in enumerate(choices)]
    for at, word in enumerate(words):
        size = len(word)
        first, last = size // 2, (size - 1) // 2
        for n, name, table in tables:
            kept = word.translate(table)
            kinds += (n, n + LAST)
            keys += (f"{name}<{size} {word[:first]} {kept}", f"{name}>{size} {word[first:]} {kept}")
            if n == 1:
                kinds += (LONGER, LONGER + LAST)
                keys += (f"{name}<{size - 1} {word[:last]} {kept}", f"{name}>{size - 1} {word[last + 1:]} {kept}")
        place += [at] * (len(kinds) - len(place))
    return place, kinds, keys


def near_pairs(words: DataFrame, groups: list[str]) -> DataFrame:
    """Every pair of words that differ by one inserted, deleted or replaced code point, once: a, na, b, nb.

    Seen as a multiset of letters, a word is a binary vector with one dimension per letter and
    occurrence; one edit changes at most two dimensions, a replaced letter two and an inserted one a
    single one. So of the groups that the letters are partitioned into at most two differ, and for some
    choice of groups to leave out what remains of both words is equal (PartEnum). All choices are
    enumerated: two groups left out for letters replaced across groups, one for letters replaced within
    a group, inserted or deleted. Two more facts about single edits make signatures rare without losing a pair: the letters that remain keep their
    order, and the first or the last half of the shorter word is untouched. Signatures are hashes; what they
    join is verified, and each pair is met under exactly one choice and one half.
    """
    choices = [(n, "".join(groups[g] for g in c)) for n in (1, 2) for c in combinations(range(len(groups)), n)]

    def sign(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, WORDS_AT_ONCE):
                part = batch.slice(first, WORDS_AT_ONCE)
                place, kinds, keys = _signatures(part.column(0).to_pylist(), choices)
                rows = part.take(pa.array(place, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(kinds, pa.int8()), pa.array(keys, pa.string())], ["word", "n", "kind", "key"])

    # Both sides of the join are the same exchange, so nothing is filtered or left out on one of them.
    rows = words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(sign, "word string, n long, kind byte, key string")
    rows = rows.select("word", "n", "kind", F.xxhash64("key").alias("sig")).repartition("sig")
    a = rows.select("sig", F.col("kind").alias("ka"), F.col("word").alias("a"), F.col("n").alias("na"))
    b = rows.select("sig", F.col("kind").alias("kb"), F.col("word").alias("b"), F.col("n").alias("nb"))
    ka, kb, wa, wb = F.col("ka"), F.col("kb"), F.col("a"), F.col("b")
    left_out = [k.bitwiseAND(F.lit(LAST - 1)) for k in (ka, kb)]
    # A replaced letter: words of one length, the smaller first. Two groups left out count only if both
    # differ, for otherwise a choice of one group has the pair.
    letters = "".join(groups)
    marks = "".join(chr(0xE000 + i) * len(g) for i, g in enumerate(groups))
    one_group = F.translate(wa, letters, marks) == F.translate(wb, letters, marks)
    replaced = (ka == kb) & ((left_out[0] == 1) | ~one_group)
    # An inserted letter: where both halves of the shorter word are untouched the first one counts.
    half = F.floor(F.char_length(wa) / 2).cast("int")
    inserted = (ka != kb) & ((ka < LAST) | (wa.substr(F.lit(1), half) != wb.substr(F.lit(1), half)))
    # Conditions on both sides at once, or Spark would filter one side ahead of its exchange.
    both = left_out[0] + left_out[1]
    kinds = ((ka == kb) & (both < 2 * LONGER) & (wa < wb)) | ((kb - ka == LONGER - 1) & (both == LONGER + 1))
    close = F.levenshtein(wa, wb, 1) == 1
    return a.join(b, (a["sig"] == b["sig"]) & kinds & close & (replaced | inserted)).select("a", "na", "b", "nb")


def variants(words: DataFrame, parts: int = PARTS, ratio: int = 2) -> DataFrame:
    """For every word its near words and the form it is a variant of.

    ``words`` has distinct ``word`` and ``n``. Two words are near if they differ by exactly one inserted,
    deleted or replaced code point. Adds ``n_near``; ``form``, the near word of largest n (ties: the
    smallest) if that n is at least ``ratio`` times the word's own, with its ``form_n``; and ``root``,
    reached by following forms to the last. Roots are handed down from forms to their variants one step
    at a time: a word has few near words, so no step meets a hot key, and since n grows by ``ratio``
    with each step there are few.

    Defined cases: rows with a null word or n take no part; a word without near words has n_near 0, no
    form and itself as root; an empty table gives no rows; further columns are ignored.
    """
    if ratio < 2:
        raise ValueError("forms must grow, or they could lead in a circle: ratio is 2 or more")
    ship(words.sparkSession)
    words = written(words.select("word", "n").dropna(), "words")
    pairs = near_pairs(words, letter_parts(words, parts))
    best = F.min(F.struct((-F.col("nb")).alias("less"), F.col("b").alias("word"))).alias("best")
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("b"), F.col("nb").alias("nb")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("b"), F.col("na").alias("nb")))).alias("p")).select("p.*")
    near = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    form_n = -F.col("best")["less"]
    grown = form_n >= F.lit(ratio) * F.col("n")
    linked = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(grown, F.col("best")["word"]).alias("form"), F.when(grown, form_n).alias("form_n")), "word-forms")
    done_with(words)
    step = written(linked.filter("form IS NULL").withColumn("root", F.col("word")), "word-roots")
    out, below = step, linked.filter("form IS NOT NULL")
    while not step.isEmpty():
        known = step.select(F.col("word").alias("form"), "root")
        step = written(below.join(known, "form").select("word", "n", "n_near", "form", "form_n", "root"), "word-roots")
        out = out.unionByName(step)
    return out

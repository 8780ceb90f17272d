"""Language identification by nearest centroid over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.chars import chunks, code_points, is_class
from strataflow.llm.common import fresh, ship, written

#: Characters and texts worked on at once; longer texts go in pieces.
PIECE_CHARS, CHUNK_DOCS = 1 << 18, 128
BITS = 12
DIMS = 1 << BITS
#: Odd multipliers of the three places of an n-gram.
PLACES = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
SAMPLE_PER_LANGUAGE = 400
#: Parts of the table that first choose a sample each.
SAMPLE_PARTS = 64
CENTROIDS = 4
#: The share of training texts, and of their beginnings, that may lie beyond the least cosine accepted.
REJECT_SHARE = 0.005
#: Characters of the beginnings looked at; texts are classed by the power of two of their n-grams.
BEGINNINGS = tuple(3 << i for i in range(9))
LENGTHS = 12
UNDETERMINED = "und"


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed letter n-grams (1 to 3, words padded by a blank), one row per text."""
    spans, owners, carried = [], [], []
    for i, text in enumerate(texts):
        padded = f" {text.lower()} "
        # Long texts in pieces. A piece carries the two characters before it, and of its n-grams only
        # those that end beyond these count: every n-gram of the text counts in one piece.
        for at in range(0, len(padded), PIECE_CHARS):
            spans.append(padded[max(0, at - 2) : at + PIECE_CHARS])
            owners.append(i)
            carried.append(at > 0)
    out = np.zeros((len(texts), DIMS), dtype=np.float32)
    first = 0
    while first < len(spans):  # runs of pieces of bounded length
        last, size = first, 0
        while last < len(spans) and (last == first or size + len(spans[last]) <= PIECE_CHARS):
            size += len(spans[last])
            last += 1
        _add_counts(out, spans[first:last], owners[first:last], carried[first:last])
        first = last
    return out


def _add_counts(out: np.ndarray, spans: list[str], owners: list[int], carried: list[bool]) -> None:
    points = code_points("".join(spans))
    letter = is_class(points, "isalpha")
    a = np.where(letter, points, 32).astype(np.uint32)
    sizes = np.array([len(s) for s in spans])
    row = np.repeat(np.arange(len(spans), dtype=np.int64), sizes) << BITS
    shift = np.uint32(32 - BITS)
    one = a * np.uint32(PLACES[0])
    two = one[:-1] + a[1:] * np.uint32(PLACES[1])
    three = two[:-1] + a[2:] * np.uint32(PLACES[2])
    single, either, middle = letter.copy(), letter[:-1] | letter[1:], letter[1:-1].copy()
    ends = np.cumsum(sizes)
    between = ends[:-1]  # no n-gram reaches from one span into the next
    either[between - 1] = middle[between - 1] = middle[between - 2] = False
    known = (ends - sizes)[np.array(carried)]
    single[known] = single[known + 1] = either[known] = False
    keys = np.concatenate([
        row[single] + ((one[single] * np.uint32(PLACES[2])) >> shift),
        row[:-1][either] + ((two[either] * np.uint32(PLACES[2])) >> shift),
        row[:-2][middle] + ((three[middle] * np.uint32(PLACES[1])) >> shift),
    ])
    counts = np.bincount(keys, minlength=len(spans) << BITS).reshape(len(spans), DIMS)
    np.add.at(out, np.asarray(owners), counts.astype(np.float32))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors; a text without letters stays zero."""
    x = np.log1p(counts) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def centroids_of(vectors: np.ndarray, most: int) -> np.ndarray:
    """Spherical k-means, started from the farthest points, so a rerun agrees."""
    mean = vectors.mean(axis=0)
    chosen = [int(np.argmin(vectors @ mean))]
    while len(chosen) < min(most, len(vectors)):
        nearest = (vectors @ vectors[chosen].T).max(axis=1)
        if nearest.min() > 0.999:
            break
        chosen.append(int(np.argmin(nearest)))
    centres = vectors[chosen]
    for _ in range(12):
        owner = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[owner == k].sum(axis=0) if (owner == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres.astype(np.float32)


def length_class(counts: np.ndarray) -> np.ndarray:
    """The power of two of a text's n-grams; the last class holds all longer texts."""
    return np.minimum(np.log2(np.maximum(counts.sum(axis=1), 1)).astype(int), LENGTHS - 1)


def floors_of(heads: list[str], idf: np.ndarray, centres: np.ndarray, share: float) -> list[float]:
    """The least cosine accepted for each class of length: all but ``share`` of the texts' beginnings
    of that length reach it. A class with too few to tell takes in those of the next shorter ones.
    ``heads`` are the first ``BEGINNINGS[-1]`` characters of the texts."""
    seen = [[] for _ in range(LENGTHS)]
    for size in BEGINNINGS:
        counts = gram_counts([t[:size] for t in heads if len(t) >= size or size == BEGINNINGS[0]])
        top = (weighted(counts, idf) @ centres.T).max(axis=1, initial=0.0)
        for k, t, letters in zip(length_class(counts), top, counts.any(axis=1), strict=True):
            if letters:
                seen[k].append(float(t))
    floors = []
    for k in range(LENGTHS):
        held, shorter = list(seen[k]), k - 1
        while len(held) * share < 1 and shorter >= 0:
            held += seen[shorter]
            shorter -= 1
        floors.append(float(np.quantile(held, share)) if held else 0.0)
    return floors


@dataclass
class LanguageModel:
    """Centroids (one row each, with its language and the least cosines accepted by length) and the IDF."""

    languages: list[str]
    centroids: np.ndarray
    floors: np.ndarray
    idf: np.ndarray

    def predict(self, texts) -> pa.StructArray:
        names, scores, rejected = [], [], []
        for _, held in chunks(texts, PIECE_CHARS, CHUNK_DOCS):
            counts = gram_counts(held)
            x = weighted(counts, self.idf)
            if len(self.languages):
                cosine = x @ self.centroids.T
                best = np.argmax(cosine, axis=1)
                top = cosine[np.arange(len(held)), best]
            else:
                best, top = np.zeros(len(held), int), np.zeros(len(held))
            known = x.any(axis=1) & bool(len(self.languages))
            names += [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
            scores += [min(max(float(t), 0.0), 1.0) if k else 0.0 for t, k in zip(top, known, strict=True)]
            low = top < self.floors[best, length_class(counts)] if len(self.languages) else ~known
            rejected += [bool(r) for r in (low | ~known)]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
            ["lang_pred", "score", "rejected"])


def fit(
    docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
    sample: int = SAMPLE_PER_LANGUAGE, most: int = CENTROIDS, reject_share: float = REJECT_SHARE,
) -> LanguageModel:
    """Learn centroids from the rows where ``learn`` holds and text and lang are not null.

    Document frequencies are counted over all those rows. The centroids are clustered per language
    from a bounded sample: the ``sample`` rows of a language with the least hash of id and text, found
    in two rounds (by parts of the table, then of all). Whole texts are counted where they are read; the
    one task that clusters a language receives ``sample`` count vectors and beginnings, however long the
    texts, and the driver ``most`` vectors per language.
    """
    ship(docs.sparkSession)
    name = fresh("lang")
    rows = docs.filter(learn & F.col(f"`{text}`").isNotNull() & F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias(name),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text}`")).alias("at"))

    def frequencies(batches):
        df, n = np.zeros(DIMS), 0
        for batch in batches:
            for _, held in chunks(batch["text"], PIECE_CHARS, CHUNK_DOCS):
                df += (gram_counts(held) > 0).sum(axis=0)
                n += len(held)
        yield pd.DataFrame({"k": np.arange(-1, DIMS), "n": np.concatenate([[n], df]).astype(np.int64)})

    counted = rows.select("text").mapInPandas(frequencies, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))
    df = np.zeros(DIMS + 1)
    for k, n in counted.collect():  # DIMS + 1 numbers
        df[k + 1] = n
    idf = (np.log((1 + df[0]) / (1 + df[1:])) + 1).astype(np.float32)

    part = fresh("part")
    chosen = rows.select(name, "at").distinct().withColumn(part, F.spark_partition_id() % SAMPLE_PARTS)
    for by in ([name, part], [name]):
        first = F.row_number().over(Window.partitionBy(*by).orderBy("at"))
        chosen = chosen.withColumn("k", first).filter(F.col("k") <= sample).drop("k")
    chosen = written(chosen.select(name, "at"), "langid")
    picked = rows.join(F.broadcast(chosen) if chosen.count() <= 200_000 else chosen, [name, "at"])

    def counts_of(batches):
        for batch in batches:
            for at, held in chunks(batch["text"], PIECE_CHARS, CHUNK_DOCS):
                part = batch.iloc[at : at + len(held)]
                yield pd.DataFrame({
                    "lang": part[name], "at": part["at"], "head": [t[: BEGINNINGS[-1]] for t in held],
                    "counts": [c.tobytes() for c in gram_counts(held)]})

    counted = picked.mapInPandas(counts_of, "lang string, at long, head string, counts binary").dropDuplicates(["lang", "at"])

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at")
        x = weighted(np.stack([np.frombuffer(c, np.float32) for c in frame["counts"]]), idf)
        x = x[x.any(axis=1)]
        if not len(x):
            return pd.DataFrame({"lang": [], "floors": [], "vector": []})
        centres = centroids_of(x, most)
        floors = floors_of(list(frame["head"]), idf, centres, reject_share)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "floors": [floors] * len(centres), "vector": [c.tobytes() for c in centres]})

    found = sorted(tuple(r) for r in counted.groupBy("lang").applyInPandas(cluster, "lang string, floors array<double>, vector binary").collect())
    return LanguageModel(
        [f[0] for f in found],
        np.stack([np.frombuffer(f[2], np.float32) for f in found]) if found else np.zeros((0, DIMS), np.float32),
        np.array([f[1] for f in found]).reshape(len(found), LENGTHS), idf)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1) and ``rejected``.

    The whole text counts. A text is rejected when its nearest centroid is farther than all but the
    share ``reject_share`` of the language's training texts, cut to about its length (beyond some 700
    letters all lengths count alike), or when it has no letter at all. Defined cases: a null text or one without a letter is ``und``, score 0, rejected; without
    any labelled row all texts are; repeated rows get equal answers; the columns ``lang_pred``,
    ``score`` and ``rejected`` of the input are replaced, all others come back unchanged.
    """
    known = ship(docs.sparkSession).sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        return known.value.predict(texts)

    out, kept = fresh("lang"), docs.drop("lang_pred", "score", "rejected")
    rows = kept.withColumn(out, predict(F.col(f"`{text}`")))
    return rows.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(out)["lang_pred"].alias("lang_pred"),
                       F.col(out)["score"].alias("score"), F.col(out)["rejected"].alias("rejected"))


def remainder(id_col: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(of))

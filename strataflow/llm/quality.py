"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.chars import chunks, code_points, is_class
from strataflow.llm.common import fresh, mix, ship, written

SAMPLE = 3000
#: Lines of a training text that are learned from: of a longer text as many in a row, the place set by its hash.
LINES = 200
STEPS = 150
THRESHOLD = 0.7
BASE = 16
FEATURES = 3 * BASE + 3


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of the texts (rows), lines per text, and characters per line.

    A line ends at a line feed; lines without a visible character are passed over, but a text with no
    visible line counts as one empty line. The features of a line are shares of character classes,
    word shapes and repetitions, followed by those of the line before and the line after.
    """
    joined = "".join(t + "\n" for t in texts)
    points = code_points(joined)
    ends = np.flatnonzero(points == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    owner = np.searchsorted(text_ends, ends)
    blank = is_class(points, "isspace")
    solid = ~blank

    def per_line(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags)))
        return (sums[ends] - sums[starts]).astype(np.float64)

    length, visible = (ends - starts).astype(np.float64), per_line(solid)
    seen = np.bincount(owner, weights=visible > 0, minlength=len(texts))
    # Of a text without visible lines the last, empty one stays.
    kept = (visible > 0) | ((seen[owner] == 0) & (ends == text_ends[owner]))
    letter, upper, digit = is_class(points, "isalpha"), is_class(points, "isupper"), is_class(points, "isdigit")
    other = solid & ~letter & ~digit
    stop = (points == 46) | (points == 44)
    # Words of all lines, hashed, to see repetitions.
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    ws, we = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    word_line = np.searchsorted(ends, ws)
    if len(ws):
        kept_points = points[solid].astype(np.uint64)
        firsts = np.concatenate(([0], np.cumsum(we - ws)[:-1]))
        place = (np.arange(len(kept_points)) - np.repeat(firsts, we - ws)).astype(np.uint64)
        spread = mix(kept_points + place * np.uint64(0x9E3779B97F4A7C15))
        words = np.add.reduceat(spread, firsts)
        key = mix(words + word_line.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        _, first_at = np.unique(key, return_index=True)
        fresh_word = np.zeros(len(ws), bool)
        fresh_word[first_at] = True
        again = np.zeros(len(ws), bool)
        again[1:] = (words[1:] == words[:-1]) & (word_line[1:] == word_line[:-1])
        marked = other[we - 1] & ~stop[we - 1]
        bare = (we - ws == 1) & other[ws]
        cap = upper[ws]
        line_words = np.bincount(word_line, minlength=len(ends)).astype(np.float64)
        count = lambda flags: np.bincount(word_line, weights=flags, minlength=len(ends))
        distinct, twice, odd, lone, capital = count(fresh_word), count(again), count(marked), count(bare), count(cap)
        line_hash = np.zeros(len(ends), np.uint64)
        np.add.at(line_hash, word_line, mix(words + np.uint64(1)))
    else:
        line_words = distinct = twice = odd = lone = capital = np.zeros(len(ends))
        line_hash = np.zeros(len(ends), np.uint64)
    _, back, times = np.unique(
        mix(line_hash) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_inverse=True, return_counts=True)
    repeated = (times[back] > 1) & (visible > 0)
    v, w = np.maximum(visible, 1), np.maximum(line_words, 1)
    base = np.stack([
        np.ones(len(ends)), np.log1p(length) / 6, per_line(letter) / v, per_line(upper) / v, per_line(digit) / v,
        per_line(other & ~stop) / v, per_line(stop) / v, np.log1p(line_words) / 5, visible / w / 10,
        distinct / w, twice / w, odd / w, lone / w, capital / w, repeated.astype(np.float64),
        (visible == 0).astype(np.float64),
    ], axis=1)[kept]
    owner, length = owner[kept], np.maximum(length[kept], 1)
    counts = np.bincount(owner, minlength=len(texts))
    before, after = np.zeros_like(base), np.zeros_like(base)
    same = owner[1:] == owner[:-1]
    before[1:][same] = base[:-1][same]
    after[:-1][same] = base[1:][same]
    short = np.stack([length < 20, length < 80, np.maximum(line_words[kept], 0) < 3], axis=1).astype(np.float64)
    return np.concatenate([base, before, after, short], axis=1), counts, length


def _walk(emit: np.ndarray, counts: np.ndarray, step: np.ndarray, start: np.ndarray, weight: np.ndarray | None = None):
    """Forward-backward over all chains at once: marginals (n, 2) and weighted sums of label pairs.

    Label 0 is bad, 1 is good; ``emit`` has the log potentials of both. Chains are sorted by length,
    and place t of all chains that reach it is one array operation. ``weight`` is one per chain.
    """
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order]
    firsts = np.concatenate(([0], np.cumsum(counts)[:-1]))[order]
    deepest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(deepest), side="left")  # chains longer than t
    alpha, beta, edges = np.zeros_like(emit), np.zeros_like(emit), np.zeros((2, 2))
    alpha[firsts] = emit[firsts] + start
    for t in range(1, deepest):
        at = firsts[: alive[t]] + t
        prev = alpha[at - 1]
        alpha[at] = emit[at] + np.logaddexp(prev[:, :1] + step[0], prev[:, 1:] + step[1])
    ends = firsts + sizes - 1
    log_z = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
    for t in range(deepest - 1, 0, -1):
        at = firsts[: alive[t]] + t
        ahead = emit[at] + beta[at]
        beta[at - 1] = np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:])
        if weight is not None:
            joint = np.exp(alpha[at - 1][:, :, None] + step + ahead[:, None, :] - log_z[: alive[t], None, None])
            edges += np.tensordot(weight[order[: alive[t]]], joint, 1)
    z = np.empty(len(counts))
    z[order] = log_z
    return np.exp(alpha + beta - np.repeat(z, counts)[:, None]), edges


@dataclass
class LineModel:
    """Weights of the good label over the line features, transition and start potentials."""

    weights: np.ndarray
    step: np.ndarray
    start: np.ndarray
    known: bool = True

    def marginals(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The chance of every line to be good, given all lines of its text."""
        emit = np.zeros((len(x), 2))
        emit[:, 1] = x @ self.weights
        return _walk(emit, counts, self.step, self.start)[0][:, 1]

    def scores(self, texts) -> np.ndarray:
        """Marginals weighted by line length; 0.5 for all texts if nothing was learned."""
        out = []
        for _, held in chunks(texts):
            if not self.known:
                out.append(np.full(len(held), 0.5))
                continue
            x, counts, length = line_features(held)
            good = self.marginals(x, counts)
            owner = np.repeat(np.arange(len(held)), counts)
            sums = np.bincount(owner, weights=good * length, minlength=len(held))
            out.append(np.clip(sums / np.bincount(owner, weights=length, minlength=len(held)), 0, 1))
        return np.concatenate(out) if out else np.zeros(0)


def train(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = STEPS, keep: float = 5e-4) -> LineModel:
    """Maximum conditional likelihood (Adam, fixed steps); every line carries its document's label.

    Every document weighs alike: a line counts by one over its document's lines.
    """
    if not len(counts) or labels.min() == labels.max():
        return LineModel(np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2), known=False)
    y = np.repeat(labels, counts)
    share = 1.0 / (len(counts) * counts)
    line_share = np.repeat(share, counts)
    firsts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    seen = np.zeros((2, 2))  # a document's pairs of neighbours all are (label, label)
    np.add.at(seen, (labels, labels), share * (counts - 1))
    theta = np.zeros(x.shape[1] + 6)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, steps + 1):
        w, step, start = theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:]
        emit = np.zeros((len(x), 2))
        emit[:, 1] = x @ w
        marginal, pairs = _walk(emit, counts, step, start, share)
        g = np.empty_like(theta)
        g[:-6] = x.T @ ((y - marginal[:, 1]) * line_share)
        g[-6:-2] = (seen - pairs).ravel()
        g[-2:] = [(share * ((labels == k) - marginal[firsts, k])).sum() for k in (0, 1)]
        g -= keep * theta
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        theta = theta + 0.15 * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8)
    return LineModel(theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:])


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", id_col: str = "doc_id",
    label: str = "quality", sample: int = SAMPLE, lines: int = LINES,
) -> LineModel:
    """Learn from the labelled documents where ``learn`` (a condition on ``docs``) holds.

    A bounded sample is used: of each label the ``sample`` documents with the least hash of their id.
    Their line features are computed by Spark over whole texts; the driver receives those of at most
    ``lines`` lines of a text (of a longer one as many in a row, from a place set by the text's hash), so
    at most 2 * ``sample`` * ``lines`` rows of numbers, and fits the weights. A label that is null or not 0 or 1 is passed over; a document with both labels has both.
    """
    ship(docs.sparkSession)
    key = fresh("id")
    marks = labels.filter(F.col(f"`{label}`").isin(0, 1)).select(
        F.col(f"`{id_col}`").alias(key), F.col(f"`{label}`").cast("int").alias("y")).distinct()
    ids = docs.filter(learn).select(F.col(f"`{id_col}`").alias(key))
    known = written(marks.join(ids, key, "left_semi").withColumn("at", F.xxhash64(key)), "quality")
    least = [known.filter(F.col("y") == y).orderBy("at", key).limit(sample) for y in (0, 1)]
    chosen = written(least[0].unionByName(least[1]), "quality")  # at most 2 * sample rows
    rows = docs.filter(learn).select(F.col(f"`{id_col}`").alias(key), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(chosen), key).select(key, "y", "text")

    def features(batches):
        for batch in batches:
            for at, held in chunks(batch["text"]):
                x, counts, _ = line_features(held)
                cuts = np.split(x.astype(np.float32), np.cumsum(counts)[:-1])
                spots = [crc32(t.encode("utf-8", "surrogatepass")) % max(len(c) - lines + 1, 1) for t, c in zip(held, cuts, strict=True)]
                cuts = [c[s : s + lines] for s, c in zip(spots, cuts, strict=True)]
                part = batch.iloc[at : at + len(held)]
                yield pd.DataFrame({"id": part[key].astype(str), "y": part["y"], "x": [c.tobytes() for c in cuts]})

    found = rows.mapInPandas(features, "id string, y int, x binary").toPandas()
    found = found.sort_values(["id", "y", "x"], ignore_index=True)
    held = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in found["x"]]
    counts = np.array([len(h) for h in held], dtype=np.int64)
    x = np.concatenate(held).astype(np.float64) if held else np.zeros((0, FEATURES))
    return train(x, counts, found["y"].to_numpy(dtype=np.int64))


def score_quality(docs: DataFrame, model: LineModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (0 to 1, higher: good likelier) and ``predicted`` (1 from ``threshold`` on).

    Every line of the whole text is labelled; the score is the mean chance of the lines to be good,
    each weighted by its length. Defined cases: a null, empty or blank text counts as one empty line
    and gets that line's chance; without labels of both kinds every score is 0.5; repeated rows get
    equal scores; the columns ``score`` and ``predicted`` of the input are replaced.
    """
    known = ship(docs.sparkSession).sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(known.value.scores(texts), pa.float64())

    rows = docs.drop("score", "predicted").withColumn("score", score(F.col(f"`{text}`")))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""Exact top-k by integer inner product over an impact-ordered, score-at-a-time index."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import ship, written

#: Levels of quantised impact: a component's level is its size over the block's largest, in equal steps.
LEVELS = 16
BLOCK = 8192
QUERY_BLOCK = 512
LANES = 4
#: Blocks of queries in a piece. A task holds a piece at once.
PIECE = 8
#: Runs of index blocks. A run gives k rows a query at most, however long it is.
RUNS = 32
#: Blocks or pieces in a file, which a reader holds at once.
PER_FILE = 4
K = 20
SCALE = 64


def quantised(vectors: DataFrame, vec: str = "embedding", id_col: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``parts``: floor(scale * x) of every component, as longs.

    Vectors that are null, empty, or hold a null or a component that is not finite take no part.
    """
    x = F.col(f"`{vec}`")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    kept = vectors.filter(x.isNotNull() & (F.size(x) > 0) & F.col(f"`{id_col}`").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return kept.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long")).alias("parts"))


@dataclass
class Index:
    """A block of vectors as postings: (row, impact) by dimension, in segments from the strongest impact down."""

    ids: np.ndarray
    parts: np.ndarray  # the vectors themselves, to rescore possible members
    rows: np.ndarray  # of all postings, segment by segment
    impacts: np.ndarray
    level: np.ndarray  # per segment: its level, its dimension, its first posting
    dim: np.ndarray
    start: np.ndarray
    rest: np.ndarray  # per level and row: the norm of what stronger levels and this one leave


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in one or two bytes where they fit."""
    size = np.abs(x).max(initial=0)
    return x.astype(np.int8) if 0 <= size < 2**7 else x.astype(np.int16) if 0 <= size < 2**15 else x


def build_index(ids: np.ndarray, parts: np.ndarray) -> Index:
    """Postings of all components that are not zero. A segment is the posting list of one dimension at one level."""
    size = np.abs(parts)
    largest = max(int(size.max(initial=0)), 1)
    row, dim = np.nonzero(parts)
    value = parts[row, dim]
    level = LEVELS - 1 - np.minimum((np.abs(value).astype(float) * LEVELS / (largest + 1)).astype(np.int64), LEVELS - 1)
    order = np.lexsort((row, dim, level))
    row, dim, value, level = row[order], dim[order], value[order], level[order]
    new = np.flatnonzero(np.concatenate(([True], (level[1:] != level[:-1]) | (dim[1:] != dim[:-1])))) if len(row) else np.zeros(0, np.int64)
    rest = np.zeros((LEVELS, len(ids)))
    for k in range(LEVELS - 1, 0, -1):  # from the weakest up, so that small remainders stay exact
        at = level == k
        rest[k - 1] = rest[k] + np.bincount(row[at], value[at].astype(float) ** 2, len(ids))
    row = row.astype(np.uint16 if len(ids) <= 2**16 else np.int32)
    return Index(ids, _narrow(parts), row, _narrow(value), level[new].astype(np.int8), dim[new].astype(np.int32),
                 np.append(new, len(row)).astype(np.int64), np.sqrt(rest).astype(np.float32) * np.float32(1 + 1e-5))


#: No score is known yet.
NONE = np.iinfo(np.int64).min


def search_block(index: Index, queries: np.ndarray, own: np.ndarray, k: int, known: np.ndarray | None = None):
    """The k best rows of a block for every query, as (query index, vec_id, score), and the postings added.

    ``known`` has for every query the k-th best score of other blocks, or NONE; rows below it may be missing.

    Score at a time: segments are added to the scores from the strongest impact down, for all queries
    still open; a posting below the point where a query is closed is not touched for it. What is left can
    add to a row's score at most the product of the norms left (Cauchy-Schwarz). A row is a possible
    member while its score plus that reaches the k-th best of the scores less that, or the score known. A
    query is closed when scoring its possible members exactly costs less than the postings left, so it
    stops on proof only: all rows that could be among the k best, ties included, are scored on their
    whole vectors.
    """
    n, width = index.parts.shape
    largest = float(max(np.abs(queries).max(initial=0), 1)) * float(max(np.abs(index.parts).max(initial=0), 1)) * max(width, 1)
    kind = np.float32 if largest < 2**23 else np.float64
    exact = largest >= 2**52  # beyond a double's whole numbers: bounds allow for rounding, scores are whole
    slack = largest * 1e-9 if exact else 0.0
    floor = np.full(len(queries), -np.inf, dtype=kind)
    if known is not None:
        floor[known != NONE] = known[known != NONE].astype(float) - slack
    weights, norms = np.ascontiguousarray(queries.T).astype(kind), np.sqrt((queries.astype(float) ** 2).sum(axis=1)) * (1 + 1e-3)
    open_ = np.arange(len(queries))
    same = index.ids[:, None] == own[None, :]
    seen = np.zeros((n, len(queries)), dtype=kind)
    out, touched, added, total = [], 0, 0, int(index.start[-1])
    first = 0
    for level in range(LEVELS):
        last = int(np.searchsorted(index.level, level, side="right"))
        for s in range(first, last):
            a, b = index.start[s], index.start[s + 1]
            seen[index.rows[a:b]] += index.impacts[a:b, None].astype(kind) * weights[index.dim[s]][None, :]
        here = int(index.start[last] - index.start[first])
        first, added, touched = last, added + here, touched + here * len(open_)
        left = total - int(index.start[last])
        if left and (level == LEVELS - 1 or added * 8 < total):
            continue  # too little is new for another look
        added = 0
        bound = index.rest[level][:, None] * norms[open_][None, :].astype(kind) * (1 if left else 0) + kind(slack)
        top = floor[open_]
        if n > k and np.isneginf(top).any():
            lower = seen - bound
            lower[same] = -np.inf
            lower.partition(n - k, axis=0)
            top = np.maximum(top, lower[n - k])
            del lower
        bound += seen
        possible = (bound >= top[None, :]) & ~same
        del bound
        done = (possible.sum(axis=0) * width <= left) | (left == 0)
        for i in np.flatnonzero(done):
            member = np.flatnonzero(possible[:, i])
            found, query = index.parts[member], queries[open_[i]]
            if exact:
                score = np.array([int(x) for x in found.astype(object) @ query.astype(object)], dtype=np.int64)
            else:
                score = np.rint(found.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
            best = np.lexsort((index.ids[member], -score))[:k]
            out += [(int(open_[i]), int(index.ids[member][o]), int(score[o])) for o in best]
        if done.all():
            break
        if done.any():
            stay = np.flatnonzero(~done)  # take() keeps a row's scores side by side, an index in brackets does not
            open_, seen, weights, same = open_[stay], seen.take(stay, 1), weights.take(stay, 1), same.take(stay, 1)
    return out, touched


class Best:
    """The k best rows of all blocks so far for every query of a piece."""

    def __init__(self, own: np.ndarray, queries: np.ndarray, k: int):
        self.own, self.queries, self.k = own, queries, k
        self.known = np.full(len(own), NONE)  # the k-th best score
        self.ids = [np.zeros(0, np.int64)] * len(own)
        self.scores = list(self.ids)

    def search(self, index: Index, most: int) -> int:
        """Search one more block, ``most`` queries at a time; the postings added."""
        touched = 0
        for first in range(0, len(self.own), most):
            cut = slice(first, first + most)
            found, added = search_block(index, self.queries[cut], self.own[cut], self.k, self.known[cut])
            touched += added
            at, ids, scores = np.array(found, dtype=np.int64).reshape(-1, 3).T
            edges = np.flatnonzero(np.diff(at, prepend=-1, append=-1))  # a query's rows stand together
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                self._add(first + int(at[a]), ids[a:b], scores[a:b])
        return touched

    def _add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate((self.ids[i], ids)), np.concatenate((self.scores[i], scores))
        order = np.lexsort((ids, ~scores))[: self.k]  # ~x falls as x rises and fits any long
        self.ids[i], self.scores[i] = ids[order], scores[order]
        if len(order) == self.k:
            self.known[i] = self.scores[i][-1]

    def rows(self) -> pa.RecordBatch:
        queries = np.repeat(self.own, [len(x) for x in self.ids])
        return pa.RecordBatch.from_arrays([
            pa.array(queries, pa.int64()), pa.array(np.concatenate(self.ids)), pa.array(np.concatenate(self.scores))],
            ["query_id", "vec_id", "score"])


_FIELDS = ("ids", "parts", "rows", "impacts", "level", "dim", "start", "rest")


def _gathered(rows: DataFrame, block: Column, label: str, pack, schema: str) -> DataFrame:
    """One row per block and width, made by ``pack`` of its ids and vectors: a bounded group each."""

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        parts = np.array(frame["parts"].tolist(), dtype=np.int64)
        made = pack(frame["vec_id"].to_numpy(np.int64), parts)
        return pd.DataFrame([{"block": int(frame["block"].iloc[0]), "width": parts.shape[1], **made}])

    made = rows.withColumn("block", block).withColumn("width", F.size("parts"))
    return written(made.groupBy("block", "width").applyInPandas(one, "block long, width int, " + schema), label, PER_FILE)


def _stored(ids: np.ndarray, parts: np.ndarray) -> dict:
    index = build_index(ids, parts)
    arrays = {f: getattr(index, f) for f in _FIELDS}
    return {**{f: a.tobytes() for f, a in arrays.items()}, "kinds": ",".join(a.dtype.str for a in arrays.values())}


def _view(batch, row: int, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), kind)


def _asked(ids: np.ndarray, parts: np.ndarray) -> dict:
    parts = _narrow(parts)
    return {"q_ids": ids.tobytes(), "q_parts": parts.tobytes(), "q_kind": parts.dtype.str}


def _loaded(batch, row: int) -> Index:
    """The block in a row of an Arrow batch: its arrays are views, not copies."""
    kinds = batch.column("kinds")[row].as_py().split(",")
    held = {f: _view(batch, row, f, kind) for f, kind in zip(_FIELDS, kinds, strict=True)}
    n = len(held["ids"])
    return Index(**{**held, "parts": held["parts"].reshape(n, -1), "rest": held["rest"].reshape(LEVELS, n)})


def top_k(
    vectors: DataFrame, queries: Column, k: int = K, vec: str = "embedding", id_col: str = "vec_id", scale: int = SCALE,
    block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """For every row where ``queries`` holds the ``k`` best other rows: query_id, rank, vec_id, score.

    Rows are spread over blocks of about ``block`` vectors by a hash of their id; the postings of each block
    are built and stored once, as one piece of the index (``build_index``). Queries are stored in pieces of
    a few blocks. Every piece of queries meets every block of the index once: a task reads a run of index
    blocks and a piece from the stored tables, keeps the best k of the run for every query, and closes
    queries in later blocks by what it holds; the best k of the runs follow by one window. So neither side
    is copied to disk for the other, nothing passes the driver, and a task holds one block, one piece and
    k rows for each of its queries, however many blocks there are. All rows are searched, and the scores
    are exact integers.

    Defined cases: null vectors, and vectors holding null or non-finite components, take no part;
    neither do null ids; vectors of another width than the query's are not compared; a query with
    fewer than k others gets all of them; ties go to the smaller vec_id; rows that repeat a vec_id
    are one candidate each, but never for a query of that same vec_id; query rows that repeat an id
    share one list; an empty table gives no rows; a score beyond a long is an error; other columns are
    ignored, whatever their names.
    """
    ship(vectors.sparkSession)
    every = quantised(vectors, vec, id_col, scale)
    asked = quantised(vectors.filter(queries), vec, id_col, scale)
    total, questions = vectors.count(), vectors.filter(queries).count()
    blocks, query_blocks = max(1, -(-total // block)), max(1, -(-questions // query_block))
    spread = lambda n: F.pmod(F.xxhash64("vec_id", "parts"), F.lit(n))
    index = _gathered(every, spread(blocks), "topk-index", _stored, ", ".join(f"{f} binary" for f in _FIELDS) + ", kinds string")
    pieces = max(min(query_blocks, LANES), -(-query_blocks // PIECE))
    ask = _gathered(asked.distinct(), spread(pieces), "topk-queries", _asked, "q_ids binary, q_parts binary, q_kind string")
    # Ranges of the number give every piece a partition of its own. Neither side is small enough to broadcast.
    ask = ask.withColumnRenamed("block", "piece").withColumnRenamed("width", "q_width").repartitionByRange(pieces, "piece")
    pairs = index.coalesce(RUNS).join(ask.hint("shuffle_replicate_nl"), F.col("width") == F.col("q_width"))

    def search(batches):
        held: dict[tuple[int, int], Best] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                piece = batch.column("piece")[row].as_py(), batch.column("width")[row].as_py()
                if piece not in held:
                    own = _view(batch, row, "q_ids", "i8").copy()
                    wanted = _view(batch, row, "q_parts", batch.column("q_kind")[row].as_py()).astype(np.int64)
                    held[piece] = Best(own, wanted.reshape(len(own), -1), k)
                held[piece].search(_loaded(batch, row), query_block)
        for best in held.values():
            yield best.rows()

    found = pairs.mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

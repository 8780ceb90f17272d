"""Merkle manifest of a dataset: trees of digests whose nodes are labelled with the leaf ranks they cover.

A node's label is an interval of leaf ranks, so ancestors are intervals that contain it and siblings
are what is left of the parent's interval. Levels are built and walked in bands of six: a bucket of
a band holds the nodes below one node of the band's top, 1,093 at most, however many leaves there are.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import done_with, ship, written

FAN = 3
BAND = 6
ROWS_PER_RANGE = 200_000
#: Tree of the subroots. Trees of sources are named 0 (null) or 1 and the source, so they sort by it.
WHOLE = ""
ANCESTORS = 1 << 20
OUT_ROWS = 4096

NODE = "tree string, level int, lo long, hi long, digest binary, size long, top boolean"
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as part of what a leaf digests: ``-`` if null, else its UTF-8 length, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def fold(digests) -> bytes:
    """Digest of a node: of its children's digests as hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def ranked_leaves(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, the columns of ``order``, digest, ...) with their rank in the tree, ``lo``, and its ``size``, as a table.

    Rows are dealt to ranges of (tree, order, digest), so a tree of any size is ranked by many tasks;
    one count per range and tree meets in a tree's window.
    """
    keys = ["tree", *[F.col(c).asc_nulls_first() for c in order], "digest"]
    ranges = max(1, -(-rows.count() // ROWS_PER_RANGE))
    placed = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("spot", F.monotonically_increasing_id())
    placed = written(placed.withColumn("range", F.shiftright("spot", 33)), "merkle-ranks")
    sums = placed.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("rows"), F.min("spot").alias("first"))
    window = "(PARTITION BY tree ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    sums = sums.select("tree", "range", "first", F.expr(f"coalesce(sum(rows) OVER {window}, 0)").alias("before"),
                       F.expr("sum(rows) OVER (PARTITION BY tree)").alias("size"))
    ranked = placed.join(sums, ["tree", "range"]).withColumn("lo", F.col("before") + F.col("spot") - F.col("first"))
    out = written(ranked.select(*rows.columns, "lo", "size"), "merkle-leaves")
    done_with(placed)
    return out


def _blocks(batches, names):
    """Rows of a sorted stream, block by block, as tuples of the named columns."""
    rows = (r for b in batches for r in zip(*[b.column(b.schema.get_field_index(n)).to_pylist() for n in names], strict=True))
    return itertools.groupby(rows, key=lambda r: r[:2])


def _batches(rows, schema: pa.Schema):
    """Tuples as record batches of a few thousand rows."""
    rows = iter(rows)
    while part := list(itertools.islice(rows, OUT_ROWS)):
        columns = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _in_blocks(nodes: DataFrame, level: int, order: list) -> DataFrame:
    """Nodes gathered by the node ``BAND`` levels above ``level`` that covers them."""
    made = nodes.withColumn("block", F.expr(f"lo div {FAN ** (level + BAND)}"))
    return made.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def _grow(base: DataFrame, level: int) -> DataFrame:
    """The nodes of the levels above ``base`` (all nodes of one level) up to the band's top.

    A tree is complete where one node covers all its leaves; that node is marked ``top``.
    """
    span, out = FAN**level, _NODES

    def grow(batches):
        def nodes():
            for (tree, _), rows in _blocks(batches, ["tree", "block", "lo", "hi", "digest", "size"]):
                rows = list(rows)
                size = rows[0][5]
                last = size <= span * FAN**BAND
                row, at = [(r[2], r[3], r[4]) for r in rows], level
                if last and len(row) == 1:
                    yield tree, at, *row[0], size, True
                    continue
                for at in range(level + 1, level + BAND + 1):
                    row = [(part[0][0], part[-1][1], fold(d for _, _, d in part))
                           for part in (row[i : i + FAN] for i in range(0, len(row), FAN))]
                    done = last and len(row) == 1
                    yield from ((tree, at, lo, hi, digest, size, done) for lo, hi, digest in row)
                    if done:
                        break

        yield from _batches(nodes(), out)

    return _in_blocks(base, level, ["lo"]).select("tree", "block", "lo", "hi", "digest", "size").mapInArrow(grow, NODE)


_NODES = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()),
                    ("digest", pa.binary()), ("size", pa.int64()), ("top", pa.bool_())])


@dataclass
class Forest:
    """Trees over ranked leaves: per band its first level, the nodes there, and those above them."""

    bands: list[tuple[int, DataFrame, DataFrame]]

    @property
    def tops(self) -> DataFrame:
        """The root of every tree: tree, level, lo, hi, digest, size."""
        found = [grown.filter("top") for _, _, grown in self.bands]
        out = found[0]
        for part in found[1:]:
            out = out.unionByName(part)
        return out.drop("top")

    @property
    def nodes(self) -> DataFrame:
        """All nodes above the leaves, with their labels."""
        out = None
        for level, _, grown in self.bands:
            part = grown.filter(F.col("level") > level)
            out = part if out is None else out.unionByName(part)
        return out


def grow_forest(leaves: DataFrame) -> Forest:
    """Trees over ``leaves`` (tree, lo, size, digest): every ``FAN`` consecutive nodes become one, up to one."""
    bands, level = [], 0
    base = leaves.withColumn("hi", F.col("lo") + 1)
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while True:
        grown = written(_grow(base, level), "merkle-nodes")
        bands.append((level, base, grown))
        level += BAND
        if largest <= FAN**level:
            return Forest(bands)
        base = grown.filter((F.col("level") == level) & ~F.col("top"))


def _descend(forest: Forest, ancestors: DataFrame, payload: list[str], finish, schema: str) -> DataFrame:
    """Hand the siblings on the way to the root down to all leaves of a forest.

    ``ancestors`` has for the root of every tree (tree, lo, hi) its own way up, ``path``, and the tree's
    ``subroot``. Band by band, from the top, a containment join in buckets attaches the ancestor that
    covers a bucket's nodes; within it, a parent's interval less a node's own identifies its siblings.
    ``finish`` makes the rows of the leaves; above them the rows are the next band's ancestors.
    """
    down = "tree string, lo long, hi long, subroot binary, path " + PATH
    found = None
    for level, base, grown in reversed(forest.bands):
        ends = (F.col("hi") <= FAN ** (level + BAND)) & ((F.col("hi") > FAN**level) | F.lit(level == 0))
        above = ancestors.filter(ends)
        above = (above if found is None else above.unionByName(found)).withColumn("level", F.lit(ANCESTORS))
        extra = payload if level == 0 else []
        nodes = base.select("tree", "lo", "hi", "digest", F.lit(level).alias("level"), *extra).unionByName(
            grown.filter(F.col("level") > level).select("tree", "lo", "hi", "digest", "level"), allowMissingColumns=True)
        rows = _in_blocks(nodes.unionByName(above, allowMissingColumns=True), level, [F.col("level").desc(), "lo"])
        if level:
            made = rows.mapInArrow(_walk(level, [], _hand_down, _ANCESTORS), down)
            found = written(made, "merkle-paths")
        else:
            return rows.mapInArrow(_walk(level, payload, *finish), schema)
    raise AssertionError("a forest has a band that begins at its leaves")


_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_ANCESTORS = pa.schema([("tree", pa.string()), ("lo", pa.int64()), ("hi", pa.int64()), ("subroot", pa.binary()), ("path", _STEPS)])


def _hand_down(tree, lo, hi, digest, path, subroot):
    return tree, lo, hi, subroot, [{"left": left, "right": right} for left, right in path]


def _walk(level: int, payload: list[str], finish, schema: pa.Schema):
    names = ["tree", "block", "level", "lo", "hi", "digest", "subroot", "path", *payload]

    def walk(batches):
        def rows():
            for (tree, _), block in _blocks(batches, names):
                covers, above = None, []
                for at, nodes in itertools.groupby(block, key=lambda r: r[2]):
                    nodes = list(nodes)
                    if at == ANCESTORS:
                        (covers,) = nodes
                        path = [(s["left"], s["right"]) for s in covers[7]]
                        above = [(covers[3], covers[4], path)]
                        continue
                    if nodes[0][3:5] == above[0][:2] and len(nodes) == 1 and at == top_level(covers, level):
                        met = [(nodes[0], above[0][2])]  # the node that the ancestor's way up begins at
                    else:
                        met = list(_siblings(nodes, above))
                    above = [(n[3], n[4], path) for n, path in met]
                    if at == level:
                        yield from (finish(tree, *n[3:6], path, covers[6], *n[8:]) for n, path in met)

        yield from _batches(rows(), schema)

    return walk


def top_level(covers, level: int) -> int:
    """The level of a bucket's highest node: the band's top, or the root of a tree that ends within the band."""
    size, at = covers[4] - covers[3], level
    if covers[3]:  # not the first bucket, so the tree goes on above the band
        return level + BAND
    while FAN**at < size and at < level + BAND:
        at += 1
    return at


def _siblings(nodes, parents):
    """Every node of a level with its way up: what its parent covers besides it, then the parent's way."""
    nodes, first = list(nodes), 0
    for lo, hi, path in parents:
        last = first
        while last < len(nodes) and lo <= nodes[last][3] and nodes[last][4] <= hi:
            last += 1
        children = nodes[first:last]
        hexes = [c[5].hex() for c in children]
        for i, child in enumerate(children):
            yield child, [("".join(hexes[:i]), "".join(hexes[i + 1 :])), *path]
        first = last


def climb(leaf: bytes, path) -> bytes:
    """The root that a leaf's digest and the siblings on its way up give."""
    for left, right in path:
        leaf = hashlib.sha256((left + leaf.hex() + right).encode()).digest()
    return leaf


def manifest(
    docs: DataFrame, altered: dict[str, Column] | None = None, id_col: str = "doc_id", source: str = "source",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
) -> tuple[DataFrame, DataFrame]:
    """The nodes of the manifest, and for every row its proof and whether its present content still folds to the root.

    A leaf digests the ``columns`` of a row. Leaves of a source ascend by id; every three consecutive
    nodes (the last run: fewer) become one until one is left, the source's subroot; subroots, by
    source, are the leaves of the whole tree. ``altered`` gives present values of columns that may
    have changed since the manifest was made; by default all are as they were.

    The rows' columns: the id, ``leaf``, ``subroot``, ``root`` (hex), ``proof`` (the hex digests of the
    siblings, per level left and right), ``proof_sha256``, ``folded_root`` and ``verified``.

    Defined cases: null values have a mark of their own, so null and empty differ; a null source is a
    source, the first; null ids come first; rows with equal ids stand by their digest, and repeated rows
    are leaves of their own; the only row of a source is its subroot, and that of the only source the root; texts
    of any length are digested whole; an empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    value = {c: F.col(f"`{c}`") for c in columns}
    now = {**value, **(altered or {})}
    was, is_ = leaf_digest(*value.values()), leaf_digest(*[now[c] for c in columns])
    name = F.when(F.col(f"`{source}`").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(f"`{source}`").cast("string")))
    rows = docs.select(name.alias("tree"), F.col(f"`{id_col}`").alias("id"), was.alias("digest"), is_.alias("now"))
    rows = written(rows.withColumn("now", F.when(F.col("now") != F.col("digest"), F.col("now"))), "merkle-leaves")
    kind = rows.schema["id"].dataType
    leaves = ranked_leaves(rows, ["id"])
    done_with(rows)
    trees = grow_forest(leaves)
    subroots = written(trees.tops.select("tree", "digest", "size"), "merkle-subroots")
    heads = subroots.select(F.lit(WHOLE).alias("tree"), F.col("tree").alias("member"), "digest", F.col("size").alias("leaves"))
    heads = ranked_leaves(heads, ["member"])
    whole = grow_forest(heads)
    found = whole.tops.select("digest", "size").first()  # one row: the root
    root, count = (found["digest"], found["size"]) if found else (b"", 0)
    start = docs.sparkSession.createDataFrame(
        [(WHOLE, 0, count, root, [])] if found else [], "tree string, lo long, hi long, subroot binary, path " + PATH)

    def head(tree, lo, hi, digest, path, _, member, leaves):
        return member, 0, leaves, digest, [{"left": left, "right": right} for left, right in path]

    paths = written(_descend(whole, start, ["member", "leaves"], (head, _ANCESTORS), _ddl(_ANCESTORS)), "merkle-paths")

    def proof(tree, lo, hi, digest, path, subroot, key, now):
        folded = climb(digest if now is None else now, path)
        text = "".join(left + right for left, right in path)
        steps = [{"left": left, "right": right} for left, right in path]
        return (key, digest.hex(), subroot.hex(), root.hex(), steps, hashlib.sha256(text.encode()).hexdigest(), folded.hex(), folded == root)

    ids = pa.field("id", _arrow(kind))
    made = pa.schema([ids, ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof", _STEPS),
                      ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])
    proofs = _descend(trees, paths, ["id", "now"], (proof, made),
                      f"id {kind.simpleString()}, leaf string, subroot string, root string, proof {PATH}, "
                      "proof_sha256 string, folded_root string, verified boolean")
    nodes = trees.nodes.withColumn("part", F.lit("source")).unionByName(whole.nodes.withColumn("part", F.lit("whole")))
    return nodes, proofs.withColumnRenamed("id", id_col)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _ddl(schema: pa.Schema) -> str:
    types = {"string": "string", "int64": "bigint", "binary": "binary"}
    return ", ".join(f"{f.name} {types.get(str(f.type), PATH)}" for f in schema)

"""Secrets in texts, told from examples by who holds them across the corpus."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import ship, written

# The base patterns.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Kinds in the order in which spans that start together stand; the last two are the method's own.
KINDS = ("assign", "access", "hex", "reused", "owned")
RUN = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_DISTINCT = 10
LEAST_DIGITS = 3
EXAMPLE_OWNERS = 3
HEAVY_SHARE = 1000

_ASSIGN = re.compile(ASSIGN, re.I | re.A)
_ACCESS, _HEX, _RUN = re.compile(ACCESS), re.compile(HEX), re.compile(RUN)
FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("digest", pa.binary()), ("strong", pa.bool_())]))


def live_looking(value: str) -> bool:
    """Whether a value looks made by chance: a letter, ``LEAST_DIGITS`` digits and ``LEAST_DISTINCT`` distinct characters."""
    digits = sum("0" <= c <= "9" for c in value)
    return len(set(value)) >= LEAST_DISTINCT and digits >= LEAST_DIGITS and any(c.isalpha() for c in value)


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """Base matches (kind, start, end, value) and, as kind ``run``, live-looking runs outside of them.

    A match of too few characters is dropped with all the text it took. A hexadecimal run of 24
    characters lies within a run of 20 characters, so only such runs are searched for one.
    """
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    runs = [m.span() for m in _RUN.finditer(text)]
    for first, last in runs:
        out += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text, first, last) if m.end() - m.start() >= LEAST["hex"]]
    base = sorted((s, e) for _, s, e, _ in out)
    at, reach = 0, -1
    for first, last in runs:
        while at < len(base) and base[at][0] < last:
            reach = max(reach, base[at][1])
            at += 1
        if reach <= first and live_looking(text[first:last]):
            out.append(("run", first, last, text[first:last]))
    return out


def scan(rows: DataFrame) -> DataFrame:
    """``rows`` (..., text) with the candidates of each text in place of it: kind, start, end, digest, strong."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("text").schema)

    def read(batches):
        for batch in batches:
            found = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                found.append([{"kind": k, "start": s, "end": e, "digest": hashlib.blake2b(v.encode(), digest_size=16).digest(),
                               "strong": live_looking(v)} for k, s, e, v in candidates(text)])
            kept = [c for c in range(batch.num_columns) if batch.schema.names[c] != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found, FOUND)],
                                             [*[batch.schema.names[c] for c in kept], "found"])

    return rows.mapInArrow(read, f"{schema}, found array<struct<kind:string,start:long,end:long,digest:binary,strong:boolean>>")


def ownership(held: DataFrame) -> DataFrame:
    """Per digest its distinct ``owners`` and ``repos``, how often it occurs, ``n``, and whether a base rule found it.

    ``held`` has digest, owner, repo and base, one row per occurrence. Repositories are told apart
    within their owner. Every step is added up before its shuffle, so a value held by all costs
    one row per task, and no step gathers its holders.
    """
    repos = held.groupBy("digest", "owner", "repo").agg(F.count(F.lit(1)).alias("n"), F.max("base").alias("base"))
    owners = repos.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"), F.max("base").alias("base"))
    return owners.groupBy("digest").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.sum("n").alias("n"), F.max("base").alias("base"))


def _attach(spans: DataFrame, verdicts: DataFrame, total: int) -> DataFrame:
    """Spans with the verdict on their value. Values that hold more than a thousandth of all spans are at
    most a thousand: they are broadcast; the others, none of them frequent, are joined by a shuffle."""
    bound = max(1, total // HEAVY_SHARE)
    heavy, light = verdicts.filter(F.col("n") > bound), verdicts.filter(F.col("n") <= bound)
    marked = spans.join(F.broadcast(heavy.drop("n").withColumn("heavy", F.lit(True))), "digest", "left")
    rest = marked.filter("heavy IS NULL").select(*spans.columns).join(light.drop("n"), "digest")
    return marked.filter("heavy").drop("heavy").unionByName(rest)


def find_secrets(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", owner: str = "source", repo: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, by start, then kind: kind, start, end, owners, repos, verdict.

    Base rules find assignments of secrets, access keys and long hexadecimal runs. The digests of what they
    find, and of all other live-looking runs of 20 characters and more, are added up over the corpus by distinct
    repositories and owners; values themselves are never written. A value is an ``example`` if at least
    ``example_owners`` owners hold it, ``live`` if one does and it looks made by chance, else ``unclear``.
    Base spans all stay, with their verdict. The method adds bare runs that are live: ``reused`` ones, whose
    value a base rule found elsewhere, and ``owned`` ones. Starts and ends are code points, ends exclusive.

    Defined cases: a null text is empty and has no spans; all null owners are one owner, all null repositories
    of an owner one; repeated rows are scanned each, and are one repository; a text of any length is
    scanned whole in one task; an empty table gives no rows; further columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{owner}`").cast("string").alias("owner"),
                       F.col(f"`{repo}`").cast("string").alias("repo"), F.col(f"`{text}`").alias("text"))
    scanned = written(scan(rows).withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    some = F.size("found") > 0
    flat = scanned.filter(some).select("row", "owner", "repo", F.explode("found").alias("f")).select("row", "owner", "repo", "f.*")
    counts = ownership(flat.select("digest", "owner", "repo", (F.col("kind") != "run").alias("base")))
    counts = written(counts, "secret-owners")
    total = counts.agg(F.sum("n")).first()[0] or 0
    spans = flat.select("row", "kind", "start", "end", "digest", "strong")
    judged = _attach(spans, counts, total)
    verdict = (F.when(F.col("owners") >= example_owners, "example")
               .when((F.col("owners") == 1) & F.col("strong"), "live").otherwise("unclear"))
    kind = F.when(F.col("kind") != "run", F.col("kind")).when(F.col("base"), "reused").otherwise("owned")
    judged = judged.withColumn("verdict", verdict).filter((F.col("kind") != "run") | (F.col("verdict") == "live"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)
    span = F.struct("start", order.alias("order"), "end", kind.alias("kind"), "owners", "repos", "verdict")
    listed = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    listed = listed.withColumn("spans", F.transform("spans", lambda s: F.struct(
        *[s[c].alias(c) for c in ("kind", "start", "end", "owners", "repos", "verdict")])))
    none = F.array().cast(listed.schema["spans"].dataType)
    without = scanned.filter(~some).select("id", none.alias("spans"))
    having = scanned.filter(some).select("row", "id").join(listed, "row", "left").select("id", F.coalesce("spans", none).alias("spans"))
    return having.unionByName(without).withColumnRenamed("id", id_col)

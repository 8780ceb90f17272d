"""URL filters as a temporal join: every capture against the list entries active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import fresh

KINDS = ("domain", "host", "prefix")  # from the least specific to the most
SLICE_DAYS = 30


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and closing dot; empty if there is none."""
    plain = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20]+", "")
    return F.lower(F.regexp_extract(plain, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:@]*?)\.?(?::\d*)?(?:[/?#]|$)", 1))


def path_of(url: Column) -> Column:
    """Path without query and fragment, with a closing slash."""
    plain = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20]+", "")
    path = F.regexp_extract(plain, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*([^?#]*)", 1)
    return F.concat(F.rtrim(path, F.lit("/")), F.lit("/"))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of dated list entries.

    ``entries`` has list, kind (``domain``: the host and all below it; ``host``; ``prefix``: host and
    leading path segments), pattern, verdict (``block`` or ``allow``), action (``add`` or ``remove``)
    and at. An entry holds from the moment it is added up to, but not including, its next event; one
    never removed holds on. At equal times a removal comes before an addition. A pattern's host is read
    as that of a URL. Rows with a null field, a pattern without a host, or an unknown kind, verdict or
    action are no entries; repeated rows count once.
    """
    known = F.col("kind").isin(*KINDS) & F.col("verdict").isin("block", "allow") & F.col("action").isin("add", "remove")
    # Read like a URL, so that user, port, closing dot and case of a pattern's host count for nothing.
    link = F.concat(F.lit("//"), F.regexp_replace(F.trim("pattern"), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//", ""))
    host = host_of(link)
    pattern = F.when(host == "", None).when(F.col("kind") == "prefix", F.concat(host, path_of(link))).otherwise(host)
    events = entries.filter(known).select("list", "kind", pattern.alias("pattern"), "verdict", "action", "at").dropna().distinct()
    order = Window.partitionBy("list", "kind", "pattern", "verdict").orderBy("at", F.col("action").desc())
    events = events.withColumn("until", F.lead("at").over(order))
    held = (F.col("action") == "add") & (F.col("until").isNull() | (F.col("until") > F.col("at")))
    return events.filter(held).select("list", "kind", "pattern", "verdict", F.col("at").alias("since"), "until")


def filter_urls(
    captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at", slice_days: int = SLICE_DAYS
) -> DataFrame:
    """Add to every capture the entry that decides it: ``verdict`` (``allow``, ``block``, or ``none``),
    ``list``, ``kind``, ``pattern`` and ``since`` (null without an entry).

    An as-of join: an entry decides only captures fetched while it was active. Of several active
    entries the most specific wins (prefix over host over domain, then the longer pattern), allow
    over block, the newer over the older, the first list name. Equal captures are decided once. Each
    one looks up its own few keys (label suffixes, host, path prefixes) in a hash join on key and time
    slice; entries are repeated once per slice they span, so a pattern that changes daily for years
    meets a capture with one slice of its history only. A host of any size is spread over slices and
    split further by the skew join. The entry side is broadcast only where Spark knows it is small.

    Defined cases: a null or hostless URL, and a null fetch time, has verdict ``none``; repeated rows
    are decided alike; empty tables on either side are fine; columns of the input named like the
    added ones are replaced.
    """
    added = ("verdict", "list", "kind", "pattern", "since")
    captures = captures.drop(*added)
    link, when, decided = fresh("url"), fresh("at"), fresh("won")
    seconds = slice_days * 86400
    slot = lambda t: F.floor(F.unix_micros(t.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")
    unique = captures.select(F.col(f"`{url}`").alias(link), F.col(f"`{fetched}`").cast("timestamp").alias(when)).distinct()
    unique = unique.filter(F.col(when).isNotNull()).withColumn("host", host_of(F.col(link))).filter(F.col("host") != "")
    labels, steps = F.split("host", r"\."), F.split(F.trim(path_of(F.col(link)), F.lit("/")), "/")
    # Keys: the host, every suffix of its labels, and the host with every run of leading path segments.
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    prefixes = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.struct(
        F.lit("prefix").alias("kind"),
        F.concat(F.col("host"), F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/"),
                 F.when((i > 0), F.lit("/")).otherwise(F.lit(""))).alias("pattern")))
    host = F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern")))
    keys = F.array_distinct(F.concat(domains, host, prefixes))
    looked = unique.select(link, when, slot(F.col(when)).alias("slot"), F.explode(keys).alias("key")).select(
        link, when, "slot", F.col("key")["kind"].alias("kind"), F.col("key")["pattern"].alias("pattern"))
    # Entries beyond the captures' own time span need no slices.
    span = unique.agg(F.min(when).alias("first"), F.max(when).alias("last")).first()
    listed = intervals(entries)
    if span["first"] is None:
        listed = listed.limit(0).withColumn("slot", F.lit(0).cast("long"))
    else:
        first, last = slot(F.lit(span["first"])), slot(F.lit(span["last"]))
        start = F.greatest(slot(F.col("since")), first)
        end = F.least(F.coalesce(slot(F.col("until")), last), last)
        listed = listed.filter(start <= end).withColumn("slot", F.explode(F.sequence(start, end)))
    active = (F.col("since").cast("timestamp") <= F.col(when)) & (F.col("until").isNull() | (F.col(when) < F.col("until").cast("timestamp")))
    met = looked.join(listed, ["kind", "pattern", "slot"]).filter(active)
    rank = F.struct(
        F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).alias("a"), F.length("pattern").alias("b"),
        (F.col("verdict") == "allow").alias("c"), F.col("since").alias("d"))
    # The first list name among equals: the greatest rank, then the least name.
    per_list = met.groupBy(link, when, "list").agg(F.max(F.struct(rank.alias("rank"), "verdict", "kind", "pattern", "since")).alias("best"))
    best = per_list.groupBy(link, when).agg(
        F.max_by(F.struct("best", "list"), F.struct(F.col("best")["rank"], _reversed(F.col("list")))).alias("won"))
    best = best.select(F.col(link).alias(link + "k"), F.col(when).alias(when + "k"), F.col("won").alias(decided))
    same = (F.col(f"`{url}`") == F.col(link + "k")) & (F.col(f"`{fetched}`").cast("timestamp") == F.col(when + "k"))
    won = F.col(decided)["best"]
    return captures.join(best, same, "left").select(
        *[F.col(f"`{c}`") for c in captures.columns],
        F.coalesce(won["verdict"], F.lit("none")).alias("verdict"), F.col(decided)["list"].alias("list"),
        won["kind"].alias("kind"), won["pattern"].alias("pattern"), won["since"].alias("since"))


def _reversed(name: Column) -> Column:
    """A key that sorts names backwards: their bytes, complemented, as hex, closed by a high digit."""
    return F.concat(F.translate(F.hex(name.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))

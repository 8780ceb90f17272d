"""One query per corpus operator, over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import (
    chat, decontaminate, extract, langid, manifest, mixing, ngramjoin, quality, secretscan, sharding, spelling, topk, urlfilter)
from strataflow.llm.common import ship, table, written

SHARDS = 40


def _number(text: str) -> str:
    """A number that Spark and DuckDB compute alike from a text: the first digits of its md5."""
    return f"(strpos('0123456789abcdef', substr(md5({text}), 1, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(md5({text}), 2, 1)) - 1"


def captures(pages: DataFrame) -> DataFrame:
    """Every page with a fetch time within 2024, which follows from its id."""
    day = F.expr("make_interval(0, 0, 0, cast(page_id % 366 as int), cast(page_id % 24 as int))")
    return pages.select("page_id", "url", (F.lit("2024-01-01").cast("timestamp") + day).alias("fetched_at"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries for the hosts and first path segments that the pages have.

    Of the hosts some are blocked as a domain from a day on, and most of these are released later;
    some of their sections are allowed again for a time.
    """
    known = pages.select(urlfilter.host_of(F.col("url")).alias("host"), F.split(urlfilter.path_of(F.col("url")), "/")[1].alias("step"))
    known = known.filter("host <> ''").distinct()
    number = _number("host").replace("strpos(", "instr(")
    hosts = known.select("host").distinct().withColumn("h", F.expr(number))
    steps = known.filter("step <> ''").withColumn("h", F.expr(_number("concat(host, '/', step)").replace("strpos(", "instr(")))
    at = lambda days: F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((days).cast("int"))
    entry = lambda frame, kind, pattern, verdict, action, days: frame.select(
        F.lit("list-" + kind).alias("list"), F.lit(kind).alias("kind"), pattern.alias("pattern"), F.lit(verdict).alias("verdict"),
        F.lit(action).alias("action"), at(days).alias("at"))
    blocked, section = hosts.filter("h % 3 <> 0"), steps.filter("h % 2 = 0")
    parts = [
        entry(blocked, "domain", F.col("host"), "block", "add", F.col("h")),
        entry(blocked.filter("h % 5 <> 0"), "domain", F.col("host"), "block", "remove", F.col("h") + 60),
        entry(hosts.filter("h % 3 = 0"), "host", F.col("host"), "block", "add", F.col("h") + 100),
        entry(section, "prefix", F.concat("host", F.lit("/"), "step"), "allow", "add", F.col("h") + 10),
        entry(section, "prefix", F.concat("host", F.lit("/"), "step"), "allow", "remove", F.col("h") + 40),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active when it was fetched."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    entries = written(list_entries(pages), "url-entries")
    found = urlfilter.filter_urls(captures(pages), entries)
    return found.select("page_id", "verdict", "kind", "pattern", F.date_format("since", "yyyy-MM-dd").alias("since"))


OP1_SQL = rf"""
WITH caps AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_days(CAST(page_id % 366 AS INT)) + to_hours(page_id % 24) AS t,
         lower(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:@]*)', 1)) AS host,
         rtrim(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*([^?#]*)', 1), '/') || '/' AS path
  FROM pages),
known AS (SELECT DISTINCT host, split_part(path, '/', 2) AS step FROM caps WHERE host <> ''),
hosts AS (SELECT host, {_number("host")} AS h FROM (SELECT DISTINCT host FROM known)),
steps AS (SELECT host || '/' || step AS p, {_number("host || '/' || step")} AS h FROM known WHERE step <> ''),
held AS (
  SELECT 'domain' AS kind, 1 AS k, host AS pattern, 'block' AS verdict, h AS a, CASE WHEN h % 5 <> 0 THEN h + 60 END AS b FROM hosts WHERE h % 3 <> 0
  UNION ALL SELECT 'host', 2, host, 'block', h + 100, NULL FROM hosts WHERE h % 3 = 0
  UNION ALL SELECT 'prefix', 3, p || '/', 'allow', h + 10, h + 40 FROM steps WHERE h % 2 = 0),
met AS (
  SELECT c.page_id, h.*, row_number() OVER (PARTITION BY c.page_id ORDER BY k DESC, length(pattern) DESC, verdict, a DESC) AS r
  FROM caps c JOIN held h ON (
    (h.kind = 'domain' AND (c.host = h.pattern OR suffix(c.host, '.' || h.pattern)))
    OR (h.kind = 'host' AND c.host = h.pattern) OR (h.kind = 'prefix' AND prefix(c.host || c.path, h.pattern)))
   AND c.t >= TIMESTAMP '2024-01-01' + to_days(CAST(h.a AS INT)) AND (h.b IS NULL OR c.t < TIMESTAMP '2024-01-01' + to_days(CAST(h.b AS INT)))
  WHERE c.host <> '')
SELECT c.page_id, coalesce(m.verdict, 'none') AS verdict, m.kind, m.pattern,
       strftime(TIMESTAMP '2024-01-01' + to_days(CAST(m.a AS INT)), '%Y-%m-%d') AS since
FROM caps c LEFT JOIN met m ON m.page_id = c.page_id AND m.r = 1
"""


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1 formatted, and read back from the output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        f"SELECT cast(-1 as bigint) conv_id, cast(t as bigint) turn, r role, '{said}' text FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)")
    return chat.digests(chat.format_conversations(turns.unionByName(extra)))


def _count_sql(text: str) -> str:
    return " + ".join(
        f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in chat.CONTROLS)


OP2_SQL = rf"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(text) + (length(text) - length(replace(text, '\', ''))) + 2 * ({_count_sql("text")})
          + length(role) + (length(role) - length(replace(role, '\', ''))) + 2 * ({_count_sql("role")})
          + {len("[TURN][TEXT]")} + CASE WHEN role = 'user' THEN {len("[INST][/INST]")} ELSE 0 END AS chars FROM every)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(chars) + {len("<s></s>")} AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best partners of every vector whose id is divisible by 20, among all vectors."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS p FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, o.vec_id, CAST(list_inner_product(q.p, o.p) AS BIGINT) AS score
  FROM v q JOIN v o ON q.vec_id <> o.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = langid.remainder(F.col("doc_id"), 3)
    model = langid.fit(docs, rest != 1)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix takes, and the shards of its copies."""
    docs = table(spark, sf_dir, "documents")
    ship(spark)
    narrow = written(docs.select(
        "doc_id", "source", mixing.words(F.col("text")).alias("size"), F.xxhash64("text").alias("text")), "mix-sizes")
    mix = mixing.mix_sources(narrow, words_col="size")
    return mix.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"),
        F.array_join(F.transform("mix_blocks", lambda b: b["part"].cast("string")), ",").alias("parts"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles reach a Jaccard similarity of 0.9."""
    return ngramjoin.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=90)


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
c AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.b AS component_id
FROM s JOIN (SELECT a, min(b) AS b FROM c GROUP BY a) m ON m.a = s.doc_id
"""


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards that match the mixture of sources, counts at most one apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = written(table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.xxhash64("text").alias("text")), "shard-rows")
    return sharding.shard_rows(narrow, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from labels of those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = langid.remainder(F.col("doc_id"), 4)
    model = quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), rest != 2)
    found = quality.score_quality(docs, model)
    return found.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words found in every document."""
    found = decontaminate.report(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS_SQL = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL.format("text")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL.format("text")} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT DISTINCT n FROM g),
x AS (
  SELECT doc_id, i, n.n, array_to_string(w[i : i + n.n - 1], ' ') AS g
  FROM d, n, unnest(range(1, len(w) - n.n + 2)) AS u(i) WHERE len(w) >= n.n),
h AS (SELECT x.doc_id, x.i, x.n, g.item_id FROM x JOIN g ON x.g = g.g AND x.n = g.n),
k AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM h, unnest(range(0, h.n)) AS u(j) GROUP BY doc_id),
m AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, coalesce(k.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, with what their holders across the corpus say about them.

    Every document counts as a repository, its source as the owner.
    """
    found = secretscan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secretscan.KINDS[:3]))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda field, value: F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")
    return found.select(
        "doc_id", *[number("kind", k).alias("n_" + k) for k in secretscan.KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        *[number("verdict", v).alias("n_" + v) for v in ("live", "example")])


def _matches_sql(kind: str, pattern: str, group: int) -> str:
    """Matches of a pattern with their starts: the text between them, split off, tells how far they stand."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, source, '{kind}' AS kind, m, v,
         CAST(sum(length(gap)) OVER w + coalesce(sum(length(m)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
  FROM (SELECT doc_id, source, unnest(range(len(m))) AS i, unnest(m) AS m, unnest(v) AS v, unnest(g[1 : len(m)]) AS gap
        FROM (SELECT doc_id, source, regexp_extract_all(t, '{quoted}') AS m, regexp_extract_all(t, '{quoted}', {group}) AS v,
                     string_split_regex(t, '{quoted}') AS g FROM d))
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""


OP11_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
found AS (
  SELECT * FROM ({_matches_sql("assign", "(?i)" + secretscan.ASSIGN, 2)}) WHERE length(v) >= {secretscan.LEAST["assign"]}
  UNION ALL SELECT * FROM ({_matches_sql("access", secretscan.ACCESS, 0)}) WHERE length(v) >= {secretscan.LEAST["access"]}
  UNION ALL SELECT * FROM ({_matches_sql("hex", secretscan.HEX, 0)}) WHERE length(v) >= {secretscan.LEAST["hex"]}),
base AS (SELECT doc_id, source, kind, v, s, s + length(m) AS e FROM found),
looks AS (
  SELECT v, len(list_distinct(string_split(v, ''))) >= {secretscan.LEAST_DISTINCT} AND regexp_matches(v, '[A-Za-z]')
            AND length(regexp_replace(v, '[^0-9]', '', 'g')) >= {secretscan.LEAST_DIGITS} AS strong FROM (
    SELECT v FROM base UNION SELECT unnest(regexp_extract_all(t, '{secretscan.RUN}')) FROM d)),
runs AS (
  SELECT r.doc_id, r.source, r.v, s, s + length(m) AS e FROM ({_matches_sql("run", secretscan.RUN, 0)}) r JOIN looks l ON l.v = r.v AND l.strong
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.s < r.s + length(r.m) AND b.e > r.s)),
held AS (SELECT doc_id, source, v, TRUE AS base FROM base UNION ALL SELECT doc_id, source, v, FALSE FROM runs),
owned AS (
  SELECT v, count(DISTINCT source) + CAST(bool_or(source IS NULL) AS INT) AS owners, bool_or(base) AS base FROM held GROUP BY v),
judged AS (
  SELECT o.v, o.base, CASE WHEN owners >= {secretscan.EXAMPLE_OWNERS} THEN 'example' WHEN owners = 1 AND strong THEN 'live' ELSE 'unclear' END AS verdict
  FROM owned o JOIN looks l ON l.v = o.v),
spans AS (
  SELECT doc_id, kind, list_position(['assign', 'access', 'hex'], kind) AS k, s, e, verdict FROM base b JOIN judged j ON j.v = b.v
  UNION ALL SELECT doc_id, CASE WHEN base THEN 'reused' ELSE 'owned' END, CASE WHEN base THEN 4 ELSE 5 END, s, e, verdict
  FROM runs r JOIN judged j ON j.v = r.v WHERE verdict = 'live'),
r AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secretscan.KINDS)},
         coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k <= 3), '') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans,
         count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secretscan.KINDS)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest's proof of every document, held against the documents after some lost their line ends."""
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs = manifest.manifest(docs, {"text": text})[1]
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# The checksum of CRC-32, whose table of 256 remainders follows from its polynomial.
_CRC_TABLE_SQL = """(SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc)"""


def _crc_sql(text: str) -> str:
    steps = f"list_transform(range(1, strlen({text}) + 1), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i - 1, 2) AS BIGINT))"
    return f"""xor(list_reduce(list_prepend(4294967295, {steps}),
      lambda a, b: xor(a >> 8, crc[CAST((xor(a, b) & 255) AS BIGINT) + 1])), 4294967295)"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _tree_sql(name: str, leaves: str) -> str:
    """All levels of the trees over ``leaves``: tree, i, h, n (nodes of the level)."""
    return f"""{name} AS (
  SELECT tree, 0 AS lvl, i, h, n FROM {leaves}
  UNION ALL
  SELECT tree, any_value(lvl) + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3) FROM {name} WHERE n > 1 GROUP BY tree, i // 3)"""


OP12_SQL = f"""
WITH RECURSIVE
docs AS (SELECT *, {_crc_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 AS hit FROM documents, {_CRC_TABLE_SQL}),
leaves AS (
  SELECT doc_id, source, sha256(p || {_field_sql("text")}) AS h,
         sha256(p || {_field_sql("CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END")}) AS now
  FROM (SELECT *, {" || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS p FROM docs)),
ranked AS (
  SELECT *, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaves),
{_tree_sql("low", "ranked")},
heads AS (SELECT '' AS tree, tree AS member, h, lvl, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
{_tree_sql("high", "heads")},
walks AS (
  SELECT r.doc_id, r.tree, u.lvl AS step, r.i // CAST(pow(3, u.lvl) AS BIGINT) AS own FROM ranked r JOIN (SELECT DISTINCT tree, lvl, n FROM low) u ON u.tree = r.tree AND u.n > 1),
steps AS (
  SELECT w.doc_id, w.step, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i < w.own), '') AS l, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i > w.own), '') AS r
  FROM walks w JOIN low u ON u.tree = w.tree AND u.lvl = w.step AND u.i // 3 = w.own // 3 GROUP BY w.doc_id, w.step),
above AS (
  SELECT h.member, h.lvl + u.lvl AS step, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i < h.i // CAST(pow(3, u.lvl) AS BIGINT)), '') AS l,
         coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i > h.i // CAST(pow(3, u.lvl) AS BIGINT)), '') AS r
  FROM heads h JOIN high u ON u.n > 1 AND u.i // 3 = h.i // CAST(pow(3, u.lvl) AS BIGINT) // 3 GROUP BY h.member, h.lvl, u.lvl),
every AS (SELECT * FROM steps UNION ALL SELECT r.doc_id, a.step, a.l, a.r FROM ranked r JOIN above a ON a.member = r.tree),
proofs AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM every GROUP BY doc_id),
folded AS (
  SELECT doc_id, 0 AS step, now AS h FROM ranked
  UNION ALL SELECT f.doc_id, f.step + 1, sha256(e.l || f.h || e.r) FROM folded f JOIN every e ON e.doc_id = f.doc_id AND e.step = f.step),
ends AS (SELECT doc_id, arg_max(h, step) AS h FROM folded GROUP BY doc_id)
SELECT r.doc_id, r.h AS leaf, s.h AS subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM ranked r JOIN heads s ON s.member = r.tree JOIN ends e ON e.doc_id = r.doc_id LEFT JOIN proofs p ON p.doc_id = r.doc_id, (SELECT h FROM high WHERE n = 1) t
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words, the form it is a variant of, and that form's last."""
    counts = spelling.word_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), slip=97)
    return spelling.variants(counts).select("word", "form", "root", "n", "n_near", "form_n")


OP13_SQL = rf"""
WITH RECURSIVE
runs AS (
  SELECT doc_id, translate(m, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS m FROM documents) GROUP BY ALL),
sums AS (SELECT r, k, {_crc_sql("s")} AS h FROM (SELECT r, k, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r AS s FROM runs), {_CRC_TABLE_SQL}),
slips AS (SELECT k, CASE WHEN h % 97 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS w FROM sums),
words AS (SELECT w, CAST(sum(k) AS BIGINT) AS n FROM slips WHERE length(w) >= 5 GROUP BY w HAVING sum(k) >= 3),
cut AS (SELECT w, n, i, left(w, i) AS a, substr(w, i + 2) AS b FROM words, unnest(range(0, length(w))) AS u(i)),
near AS (
  SELECT x.w, x.n, y.w AS o, y.n AS m FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.w <> y.w
  UNION SELECT x.w, x.n, y.w, y.n FROM cut x JOIN words y ON x.a || x.b = y.w
  UNION SELECT y.w, y.n, x.w, x.n FROM cut x JOIN words y ON x.a || x.b = y.w),
best AS (SELECT w, n, count(*) AS n_near, first(o ORDER BY m DESC, encode(o)) AS o, max(m) AS m FROM near GROUP BY w, n),
forms AS (
  SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * words.n THEN o END AS form, CASE WHEN m >= 2 * words.n THEN m END AS form_n
  FROM words LEFT JOIN best ON best.w = words.w),
roots AS (SELECT w, w AS root FROM forms WHERE form IS NULL UNION ALL SELECT f.w, r.root FROM roots r JOIN forms f ON f.form = r.w)
SELECT forms.w AS word, form, root, n, n_near, form_n FROM forms JOIN roots ON roots.w = forms.w
"""

QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_chat_format, op3_topk_search, op4_language_id, op5_mix_sources, op6_ngram_join, op7_html_extract,
    op8_shard_rows, op9_quality, op10_decontaminate, op11_secret_scan, op12_merkle_manifest, op13_spelling_variants)}
ORACLES = {"op1_url_filters": OP1_SQL, "op2_chat_format": OP2_SQL, "op3_topk_search": OP3_SQL, "op6_ngram_join": OP6_SQL,
           "op10_decontaminate": OP10_SQL, "op11_secret_scan": OP11_SQL, "op12_merkle_manifest": OP12_SQL,
           "op13_spelling_variants": OP13_SQL}

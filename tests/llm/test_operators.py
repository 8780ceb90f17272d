"""Every corpus operator on small tables: brute-force versions, edge rows, clashing columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataflow.llm import boosting, chat, common, decontaminate, dom, extract, langid, mixing, ngramjoin, quality, sharding, topk, urlfilter
from strataflow.llm.template import TemplateError, compile_template, fold, parse

DOCS = "doc_id long, text string, lang string, source string, extra int"


def words(n, seed, vocabulary=40):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows."""
    base = words(400, 1, 5000)
    near = base.split()
    near[7] = "changed"
    made = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 2), (3, " ".join(near), "en", "b", 3), (4, None, "en", "a", 4),
        (5, "", None, "b", 5), (6, " \n\t ", "en", None, 6), (None, words(60, 2, 900), "de", "a", 7), (8, words(60, 3, 900), None, "c", 8),
        (8, words(60, 3, 900), None, "c", 8), (9, "A b", "en", "c", 9), (10, "a B", "en", "c", 10), (11, "!!! 123", "en", "c", None),
        (12, words(30_000, 4, 9000), "en", "a", 12), (13, "é É ñ", "es", "", 13), (14, "x" * 70_000, "en", "a", 14),
    ] + [(100 + i, words(20 + i % 50, i + 10, 2000), "en" if i % 2 else "de", f"s{i % 3}", i) for i in range(120)]
    return spark.createDataFrame(made, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- sharding


def test_shards_match_the_mixture(docs):
    got = sharding.shard_rows(docs.withColumn("slot", F.lit("mine")), 7).collect()
    assert len(got) == docs.count()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    whole = Counter(r.source for r in got)
    for source, n in whole.items():
        per = Counter(r.shard for r in got if r.source == source)
        assert all(abs(per.get(s, 0) - n / 7) < 2 for s in range(7))


def test_shards_are_the_same_again(docs):
    rows = lambda df: sorted(map(str, sharding.shard_rows(df, 5).collect()))
    assert rows(docs) == rows(docs.repartition(6))


def test_no_rows_no_shards(empty):
    assert sharding.shard_rows(empty, 5).count() == 0


def test_ranks_by_many_ranges(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"))
    got, rank, before = common.ranked(df, [F.col("g")], F.col("h"), 5000, F.col("id"), per_bucket=50)
    for g in range(3):
        rows = sorted((r for r in got.collect() if r.g == g), key=lambda r: r.h)
        assert [r[rank] for r in rows] == list(range(len(rows)))
        assert [r[before] for r in rows] == [sum(x.id for x in rows[:i]) for i in range(len(rows))]


# --- mixing


def test_targets_are_met_by_whole_documents(docs):
    got = mixing.mix_sources(docs).collect()
    taken, sizes = Counter(), Counter()
    for r in got:
        assert r.mix_size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.mix_taken == sum(b.words for b in r.mix_blocks) <= 2 * r.mix_size
        assert all(0 <= b.part < 8 and b.words == r.mix_size for b in r.mix_blocks)
        taken[r.source] += r.mix_taken
        sizes[r.source] += r.mix_size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, mixing.targets([sizes[s] for s in order]), strict=True))
    assert {r.source: r.mix_target for r in got} == wanted
    for s in order:  # half the next document is the bound
        assert abs(wanted[s] - taken[s]) <= max(r.mix_size for r in got if r.source == s) / 2 + 1
    blocks = sum(len(r.mix_blocks) for r in got)
    per = Counter(b.part for r in got for b in r.mix_blocks)
    assert max(per.values()) - min(per.values()) <= 1 and sum(per.values()) == blocks


def test_mixed_rows_hold_what_was_taken(docs):
    mix = {(r.doc_id, r.extra): r.mix_taken for r in mixing.mix_sources(docs.filter("doc_id > 8")).collect()}
    rows = Counter()
    for r in mixing.mixed_rows(docs.filter("doc_id > 8")).collect():
        rows[(r.doc_id, r.extra)] += len(r.text.split(" "))
    assert all(rows.get(k, 0) == n for k, n in mix.items())


def test_empty_mix(empty):
    assert mixing.mixed_rows(empty).count() == 0


def test_targets_stop_at_twice_the_size():
    assert mixing.targets([0, 0]) == [0, 0]
    got = mixing.targets([10, 1000, 1000])
    assert got[0] == 20 and abs(sum(got) - 1.5 * 2010) < 1e-9 and all(g <= 2 * s for g, s in zip(got, [10, 1000, 1000], strict=True))


def test_splitting_tree_adds_up():
    quotas = [1000, 10, 0, 333]
    dealt = mixing.split_quotas(quotas, 7, 1)
    assert dealt.sum(axis=0).tolist() == quotas and dealt.min() >= 0
    assert np.ptp(dealt.sum(axis=1)) <= 1
    mean = np.mean([mixing.split_quotas(quotas, 7, s)[0] for s in range(300)], axis=0)
    assert abs(mean - np.array(quotas) / 7).max() < 3


def test_draws_of_a_large_urn_follow_the_exact_law(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(mixing, "NUMPY_URN", 0)
    monkeypatch.setattr(mixing, "ONE_BY_ONE", 2)
    for good, bad, taken in ((7, 5, 6), (3, 40, 20), (30, 4, 33), (1, 1, 1)):
        got = Counter(mixing._draw(rng, good, bad, taken) for _ in range(20_000))
        low, high = max(0, taken - bad), min(good, taken)
        assert low <= min(got) and max(got) <= high
        for k in range(low, high + 1):
            want = math.comb(good, k) * math.comb(bad, taken - k) / math.comb(good + bad, taken)
            assert abs(got[k] / 20_000 - want) < 0.015, (good, bad, taken, k)


def test_quotas_beyond_numpys_urns_add_up():
    quotas = [3 * 10**12, 10**9, 5, 0]
    dealt = mixing.split_quotas(quotas, 5, 2)
    assert dealt.sum(axis=0).tolist() == quotas and dealt.min() >= 0 and np.ptp(dealt.sum(axis=1)) <= 1
    assert dealt.tolist() == mixing.split_quotas(quotas, 5, 2).tolist()


@pytest.mark.parametrize("sizes", [[100], [1, 1], [7, 7, 7, 900], [3] * 50, [1000, 1, 1, 1, 1], list(range(1, 40))])
def test_the_gap_is_closed_by_whole_documents(spark, sizes):
    data = [(i, "w " * n, "a") for i, n in enumerate(sizes)] + [(1000 + i, "x " * 60, "b") for i in range(4)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.mix_sources(df, shards=3, share=0.7).collect()
    taken = Counter()
    for r in got:
        assert r.mix_taken == r.mix_size * len(r.mix_blocks) and r.mix_taken <= 2 * r.mix_size
        taken[r.source] += r.mix_taken
    for r in got:  # a document left out would not have brought its source nearer
        gap = r.mix_target - taken[r.source]
        if r.mix_size and len(r.mix_blocks) == 0:
            assert abs(gap - r.mix_size) >= abs(gap) - 1, (gap, r.mix_size)
    assert np.ptp([sum(b.part == k for r in got for b in r.mix_blocks) for k in range(3)]) <= 1


# --- decontamination


def windows_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_hits_against_brute_force(spark, docs):
    bench = spark.createDataFrame(
        [(1, words(400, 1, 5000)[:300]), (2, "A, b!"), (3, None), (4, "..."), (5, words(30_000, 4, 9000)[-400:]), (None, "é")],
        "item_id long, text string")
    items = [(i, w) for i, t in [tuple(r) for r in bench.collect()] if (w := windows_of(t))]
    want = Counter()
    for r in docs.collect():
        w, hit, found = windows_of(r.text), set(), set()
        for i, item in items:
            n = min(10, len(item))
            grams = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)}
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(i)
        want[(r.doc_id, len(w), len(hit), tuple(sorted(str(i) for i in found if i is not None)))] += 1
    grams, _ = decontaminate.windows(bench, "text", "item_id", 10)
    anchors = grams.select("anchor").distinct().count()
    assert 10 < anchors < grams.count()
    # All by shuffles, the anchors alone broadcast, the bytes too many, all broadcast.
    for bounds in ({"most_windows": 10}, {"most_windows": anchors}, {"most_bytes": 100}, {}):
        got = decontaminate.report(docs, bench, **bounds).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(i for i in r.items if i)) for r in got) == want
    kept = decontaminate.decontaminate(docs, bench).collect()
    assert Counter(r.doc_id for r in kept) == Counter(k[0] for k in want.elements() if not k[2])
    cut = decontaminate.decontaminate(docs, bench, remove="spans")
    assert cut.columns == docs.columns and cut.count() == docs.count()
    left = {r.doc_id: r.text for r in cut.collect()}
    assert windows_of(left[1]) == windows_of(words(400, 1, 5000))[len(windows_of(words(400, 1, 5000)[:300])):] or "w" in left[1]
    assert left[4] is None


def test_empty_tables_are_clean(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, none).count() == docs.count()
    assert decontaminate.report(empty, none).count() == 0


# --- n-gram join


def brute_components(texts, k, percent):
    table = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(table))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common_ = len(a & sets[j])
            if a and sets[j] and 100 * common_ >= percent * (len(a) + len(sets[j]) - common_):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_components_against_brute_force(spark, k, percent):
    r = random.Random(k)
    made = []
    for family in range(12):
        base = words(r.randint(4, 160), family, 300).split()
        for _ in range(r.randint(1, 14)):
            copy = list(base)
            for _ in range(r.choice((0, 0, 1, 2, 3, 6))):
                copy[r.randrange(len(copy))] = f"e{r.randrange(10**6)}"
            made.append(" ".join(copy).upper() if r.random() < 0.2 else " ".join(copy))
    made += [None, "", " ", "one", "ONE", "one two"]
    ids = r.sample(range(1000), len(made))
    order = sorted(range(len(made)), key=lambda i: ids[i])
    rows = [(ids[i], made[i]) for i in order]
    n, roots = brute_components([t for _, t in rows], k, percent)
    got = {x.doc_id: x for x in ngramjoin.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()}
    for i, (doc, _) in enumerate(rows):
        assert (got[doc].n_shingles, got[doc].component_id) == (n[i], rows[roots[i]][0])


def test_one_of_each_group_stays(docs, empty):
    kept = ngramjoin.keep_one(docs).collect()
    ids = Counter(r.doc_id for r in kept)
    assert ids[1] == 1 and not ids[2] and not ids[3] and ids[8] == 1 and ids[None] == 1
    assert ids[4] == ids[5] == ids[6] == 1 and len(ids) == len({r.doc_id for r in docs.collect()}) - 3
    assert ngramjoin.keep_one(empty).count() == 0 and ngramjoin.near_duplicates(empty).count() == 0


def test_words_beyond_a_slice(monkeypatch):
    text = (words(5000, 1) + " " + "y" * 3000 + "\t" + words(50, 2)).encode()
    whole = common.word_hashes(text)
    monkeypatch.setattr(common, "SLICE_BYTES", 1000)
    parts = common.word_hashes(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


@pytest.mark.parametrize("n", range(6))
def test_one_short_text_alone(spark, n):
    rows = [(1, " ".join("abcdef"[:n]))]
    got = ngramjoin.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == [(1, int(n > 0), 1)]


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200) if i != 120], "a long, b long")
    got = {r.node: r.root for r in ngramjoin.components(edges).collect()}
    assert len(got) == 201 and len({got[i] for i in range(121)}) == 1 == len({got[i] for i in range(121, 201)}) and got[0] != got[200]


# --- language and quality


def test_languages_of_edge_rows(docs, empty):
    model = langid.fit(docs, F.lit(True))
    assert set(model.languages) == {"en", "de", "es"}
    got = {r.doc_id: r for r in langid.identify(docs.withColumn("score", F.lit("mine")), model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (4, 5, 6, 11))
    assert all(0 <= r.score <= 1 for r in got.values()) and got[13].lang_pred == "es"
    none = langid.fit(empty, F.lit(True))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


def plain_counts(text):
    padded, out = f" {text.lower()} ", Counter()
    marks = [ord(c) if c.isalpha() else 32 for c in padded]
    for n, last in ((1, 2), (2, 2), (3, 1)):
        for i in range(len(marks) - n + 1):
            gram = marks[i : i + n]
            if gram[1] != 32 if n == 3 else any(g != 32 for g in gram):
                spread = sum(g * langid.PLACES[k] for k, g in enumerate(gram)) * langid.PLACES[last]
                out[(spread % 2**32) >> (32 - langid.BITS)] += 1
    return out


@pytest.mark.parametrize("piece", [3, 5, 64, 1 << 18])
def test_gram_counts_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE_CHARS", piece)
    texts = [words(300, 1), "", "ÀÉ x", "a", "ΟΔΟΣ ΣΑΣ", "x" * 200, words(50, 2), "...", "中文" * 90 + "!b"]
    for counts, text in zip(langid.gram_counts(texts), texts, strict=True):
        assert {int(k): int(counts[k]) for k in np.flatnonzero(counts)} == plain_counts(text)


def test_predictions_against_plain_cosines(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(d, F.lit(True), sample=20)
    learned = [r for r in d.filter("text is not null and lang is not null").collect()]
    df = Counter(k for r in learned for k in plain_counts(r.text))
    idf = {k: math.log((1 + len(learned)) / (1 + df[k])) + 1 for k in range(langid.DIMS)}
    assert np.allclose(model.idf, [idf[k] for k in range(langid.DIMS)], rtol=1e-5)
    for r in langid.identify(d, model).collect():
        x = {k: math.log1p(n) * idf[k] for k, n in plain_counts(r.text or "").items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        tops = [sum(v * float(c[k]) for k, v in x.items()) / norm if norm else 0.0 for c in model.centroids]
        want = model.languages[int(np.argmax(tops))] if norm else "und"
        assert r.lang_pred == want and abs(r.score - max(tops, default=0)) < 1e-4


def test_samples_are_the_least_of_all_parts(spark):
    rows = [(i % 9000, " ".join([f"{'abc'[i % 3]}{'xyz'[i % 7 % 3]}"] * (i % 5 + 1)), "en" if i % 9000 % 4 else "de") for i in range(9500)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(150)
    got = [langid.fit(d.repartition(n), F.lit(True), sample=30) for n in (1, 150)]
    assert (got[0].centroids == got[1].centroids).all() and (got[0].floors == got[1].floors).all()


def test_held_out_languages_and_quality(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rest = langid.remainder(F.col("doc_id"), 3)
    found = langid.identify(d, langid.fit(d, rest != 1)).filter(rest == 1).select("lang", "lang_pred").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rest = langid.remainder(F.col("doc_id"), 4)
    scored = quality.score_quality(d, quality.fit(d, labels, rest != 2)).filter(rest == 2).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.95


def test_unlearned_languages_and_noise_go(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rest = langid.remainder(F.col("doc_id"), 3)
    model, r = langid.fit(d, rest != 1), random.Random(3)
    finnish = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
               "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokaisella on oikeus elämään, vapauteen ja turvallisuuteen.")
    polish = ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
              "i powinni postępować wobec innych w duchu braterstwa. Każda osoba ma prawo do życia, wolności i bezpieczeństwa.")
    noise = [" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 9))) for _ in range(n)) for n in (20, 100, 1000)]
    assert model.predict(pa.array([finnish, polish, *noise])).field("rejected").to_pylist() == [True] * 5
    held = langid.identify(d.filter((rest == 1) & F.col("lang").isNotNull() & (F.length("text") > 0)), model)
    share = held.agg(F.avg(F.col("rejected").cast("int"))).first()[0]
    assert share < 0.02


def test_chains_against_all_labelings():
    rng = np.random.default_rng(0)
    counts = np.array([3, 1, 4])
    emit, step, start = rng.normal(size=(8, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    got, _ = quality._walk(emit, counts, step, start)
    at = 0
    for n in counts:
        total, good = 0.0, np.zeros(n)
        for code in range(2**n):
            y = [(code >> i) & 1 for i in range(n)]
            p = np.exp(start[y[0]] + sum(emit[at + i, y[i]] for i in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += p
            good += p * np.array(y)
        assert np.allclose(got[at : at + n, 1], good / total)
        at += n


def test_quality_of_edge_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (9, 0), (None, 1), (11, None), (12, 7)], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    got = quality.score_quality(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    nothing = quality.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score_quality(docs, nothing).collect()} == {0.5}
    assert quality.score_quality(empty, model).count() == 0


def test_lines_learned_from_are_bounded(spark, monkeypatch):
    held = []
    monkeypatch.setattr(quality, "train", lambda x, counts, labels: held.append((x, counts, labels)))
    long = "\n".join(f"line {i} of a long text" for i in range(5000))
    d = spark.createDataFrame([(1, long), (2, long), (3, "short\ntext"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id long, quality int")
    quality.fit(d, labels, F.lit(True), lines=70)
    x, counts, y = held[0]
    assert sorted(counts) == [1, 2, 70, 70] and len(x) == 143 and sorted(y) == [0, 0, 1, 1]
    whole = quality.line_features([long])[0].astype(np.float32)
    run = x[np.cumsum(counts)[list(counts).index(70)] - 70 :][:70]
    assert any((whole[i : i + 70] == run).all() for i in range(len(whole) - 69))


# --- top-k


@pytest.mark.parametrize("scale", [64, 2**27])
def test_best_partners_against_brute_force(spark, scale):
    rng = np.random.default_rng(1)
    made = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    made += [(300 + i, made[0][1]) for i in range(40)]
    bad = [(400, None), (401, []), (402, [None] * 8), (403, [float("nan")] * 8), (404, [float("inf")] + [0.0] * 7), (405, [1.0])]
    df = spark.createDataFrame(made + bad, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=5, block=70, query_block=4, scale=scale).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    parts = {i: [int(np.floor(scale * x)) for x in v] for i, v in made}
    for q in [i for i in parts if i % 20 == 0]:
        scores = sorted(((-sum(a * b for a, b in zip(parts[q], p, strict=True)), i) for i, p in parts.items() if i != q))[:5]
        assert got[q] == [(i, -s) for s, i in scores]
    assert set(got) == {i for i in parts if i % 20 == 0}
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


# --- chat


def test_conversations_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\.", "<\\./s>", "[INST", "", "é\n[TURN]x[TEXT]", "<<s>s>", "[/INST][/INST]", "a" * 50_000]
    made = [(c, t, random.Random(c * 50 + t).choice(["user", "assistant", "system", None, "[TURN]"]), random.Random(c + t).choice([*nasty, None]))
            for c in range(40) for t in range(6)] + [(None, 0, "user", "x"), (3, 0, "user", "tie"), (3, 0, "user", "tie"), (7, None, "user", "first")]
    df = spark.createDataFrame(made, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.digests(out).collect()}
    texts = {r.conv_id: r for r in out.collect()}
    by = defaultdict(list)
    for c, t, role, text in made:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        assert chat.read_turns(texts[c].formatted) == [(r, t) for _, r, t in turns]
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c].loss_chars == len(loss) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].formatted_chars == len(texts[c].formatted) and got[c].n_turns == len(turns)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_template_language():
    run = lambda source, **env: "".join(t for t, _ in compile_template(source, str.upper)(env))
    assert run("{{ 'a' + x }}b", x="c") == "aCb"
    assert run("{% for m in ms %}{% if m.k == 1 %}one{% elif m['k'] > 2 %}many{% else %}-{% endif %} {% endfor %}", ms=[{"k": 1}, {"k": 2}, {"k": 3}]) == "one - many "
    assert run("{%- set y = x|trim -%}  {{ y if y not in 'abc' else 'in' }} {# gone #}", x=" q ") == "Q "
    assert list(compile_template("a{% generation %}{{ x }}{% endgeneration %}", str)({"x": "y"})) == [("a", False), ("y", True)]
    assert len(fold(parse("a{% if 1 == 1 %}b{{ 'c' ~ 'd' }}{% else %}{{ x }}{% endif %}"))) == 1
    for bad in ("{{ x.__class__() }}", "{% import os %}", "{% for x %}", "{{ 'a", "{% if 1 %}", "{{ x|evil }}", "{{ }}"):
        with pytest.raises(TemplateError):
            compile_template(bad, str)
    assert run("{{ x.__class__ }}", x="q") == ""


def test_control_strings_are_checked():
    for bad in (("a",), ("<s\\",), ("<s", "x<")):
        with pytest.raises(ValueError):
            chat.Escaper(bad)


# --- URL filters


def test_entries_hold_while_they_are_listed(spark):
    day = lambda n: f"2024-01-{n:02d} 00:00:00"
    entries = spark.createDataFrame([
        ("a", "domain", "Bad.example.", "block", "add", day(3)), ("a", "domain", "bad.example", "block", "add", day(3)),
        ("a", "domain", "bad.example", "block", "remove", day(10)), ("b", "prefix", "https://bad.example/ok", "allow", "add", day(5)),
        ("a", "host", "x.org", "block", "add", day(1)), ("b", "host", "x.org", "allow", "add", day(1)),
        ("a", "host", None, "block", "add", day(1)), ("a", "nonsense", "x.org", "block", "add", day(1)),
    ], "list string, kind string, pattern string, verdict string, action string, at string").withColumn("at", F.col("at").cast("timestamp"))
    cases = [
        ("http://bad.example/", 2, "none"), ("http://bad.example/", 3, "block"), ("http://www.bad.example:80/a?b#c", 9, "block"),
        ("http://u:p@BAD.example./x", 4, "block"), ("http://notbad.example/", 5, "none"), ("http://bad.example/", 10, "none"),
        ("http://bad.example/ok/deep", 6, "allow"), ("http://bad.example/okay", 6, "block"), ("http://bad.example/ok/deep", 12, "allow"),
        ("http://x.org/", 2, "allow"), ("http://sub.x.org/", 2, "none"), (None, 2, "none"), ("", 2, "none"), ("no url", 3, "none"),
        ("http://bad.example/", None, "none"),
    ]
    rows = [(i, u, day(d) if d else None, "old") for i, (u, d, _) in enumerate(cases)] * 2
    caps = spark.createDataFrame(rows, "i int, url string, fetched_at string, verdict string").withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    for days in (1, 4, 400):
        got = urlfilter.filter_urls(caps, entries, slice_days=days).collect()
        assert len(got) == len(rows) and {r.i: r.verdict for r in got} == {i: c[2] for i, c in enumerate(cases)}
    assert urlfilter.filter_urls(caps.limit(0), entries).count() == 0
    assert {r.verdict for r in urlfilter.filter_urls(caps, entries.limit(0)).collect()} == {"none"}


# --- extraction


def test_pages_with_broken_markup(spark):
    made = [
        (1, "<body><nav><a href=x>Home page</a></nav><article><h1>Head &amp; line</h1><p>One  two<br>three<p>Next para here.</article><footer>&copy; us</footer>"),
        (2, None), (3, ""), (4, "<html><body></body></html>"), (5, "<" * 300 + "div class='"), (6, "<p>" * 3000 + "deep"),
        (7, "<script>if (a < b) '</p>'</script><style>x{}</style><!-- no"),
    ]
    df = spark.createDataFrame(made, "page_id long, html string").withColumn("text", F.lit(5))
    got = {r.page_id: r.text for r in extract.extract(df).collect()}
    assert got[1] == "Head & line\n\nOne two three\n\nNext para here."
    assert got[2] == got[3] == got[4] == got[7] == "" and len(got) == 7
    assert extract.extract(df.limit(0)).count() == 0


def all_text(html):
    page = dom.read_page(html)
    return dom.text_of(page, np.ones(len(page.parent), bool)).split("\n\n")


@pytest.mark.parametrize("start", [
    "<html><head><title>x</title><body>", "<head><title>x</title><meta charset=utf-8><body>", "<html><head><title>x</title>",
    "<head><style>p{}</style><link rel=x href=y>"])
def test_pages_without_the_end_of_the_head(start):
    body = "<article><h1>Head line</h1><p>The town has grown, and the river runs past it. It is old.</p><p>It is very old.</p></article>"
    assert all_text(start + body) == ["Head line", "The town has grown, and the river runs past it. It is old.", "It is very old."]
    assert all_text("<head><title>x</title>Words, not in a head.") == ["Words, not in a head."]
    texts = extract.extract_text([start + body, start.replace("<body>", "") + "</head><body>" + body], extract.trained())
    assert texts[0] and texts[0] == texts[1]


@pytest.mark.parametrize("tag", ["svg", "object", "audio", "video", "canvas", "math"])
def test_text_in_and_after_an_unclosed_embedded_element(tag):
    assert all_text(f"<div><p>One.</p><{tag}>two<p>Three.</p>Four.</div>Five.")[-3:] == ["Three.", "Four.", "Five."]
    assert all_text(f"<p>One <{tag}>two</{tag}> three.</p><p>Four.") == ["One two three.", "Four."]


def test_hidden_is_an_attribute_of_its_own():
    assert all_text(
        '<article data-title="A hidden river" class="md:block hidden lg:flex" title="display:none"><p>Read <a href=x title="the hidden cost">these '
        'words</a> too.</p><p hidden>no</p><p hidden="">no</p><p style="color:red; display: none">no</p><p aria-hidden="true">Shown.'
        "<p>Here <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds.</article>"
    ) == ["Read these words too.", "Shown.", "Here x = 1 2 holds."]


def test_pages_of_unseen_layouts():
    r, hit, extra, missed = random.Random(4242), 0, 0, 0
    model = extract.trained()
    for _ in range(60):
        page = dom.read_page(extract._Writer(r).page())
        trees = dom.forest([page])
        kept = dom.decode(model.chance(trees.x), trees)
        truth = np.zeros(len(kept), bool)
        for node, text in page.pieces:
            truth[node] |= extract.MAIN in text
        for node in range(len(truth) - 1, 0, -1):
            truth[page.parent[node]] |= truth[node]
            assert not kept[node] or kept[page.parent[node]]
        want, got = (set(dom.text_of(page, k).split("\n\n")) for k in (truth, kept))
        hit, extra, missed = hit + len(want & got), extra + len(got - want), missed + len(want - got)
    assert hit / (hit + extra) > 0.95 and hit / (hit + missed) > 0.95


def test_trees_learn_a_rule():
    x = np.random.default_rng(0).normal(size=(800, 5))
    y = ((x[:, 1] > 0.3) & (x[:, 3] < 0)).astype(float)
    model = boosting.boost(x, y, trees=30, depth=3)
    assert ((model.chance(x) > 0.5) == (y > 0.5)).mean() > 0.97

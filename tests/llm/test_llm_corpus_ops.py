"""Operators over the whole corpus, against brute force."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_small import documents, empty, texts, words
from reglink.llm import jaccard, katz, resampling, sharding, substrings, topk
from reglink.llm.components import components
from reglink.llm.stage import numbered

BIG = 2 ** 63 - 1


def oid(i):
    return BIG if i is None else i


# --- 5: near duplicates -------------------------------------------------------------

def shingles(t):
    w = words(t, lower=True)
    return {tuple(w[p:p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    top = {oid(i): oid(i) for i, _ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    sets = [(oid(i), shingles(t)) for i, t in rows]
    for a in range(len(sets)):
        for b in range(a):
            (x, s), (y, t) = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                p, q = find(x), find(y)
                top[max(p, q)] = min(p, q)
    return Counter((i, len(s), None if (c := find(oid(i)) if s else oid(i)) == BIG else c) for (i, _), (_, s) in zip(rows, sets))


@pytest.mark.parametrize("block_docs, group_bytes", [(4096, 1 << 22), (4, 9000)])
def test_components_equal_brute_force(spark, block_docs, group_bytes):
    got = jaccard.near_duplicates(documents(spark), block_docs=block_docs, group_bytes=group_bytes)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_components(texts())


def test_near_duplicates_edges(spark):
    assert jaccard.near_duplicates(empty(spark)).count() == 0
    docs = documents(spark)
    kept = jaccard.keep_first(docs, jaccard.near_duplicates(docs))
    assert kept.columns == docs.columns and kept.schema == docs.schema
    want = Counter()
    for (i, _, c), _n in brute_components(texts()).items():
        if c == i:
            want[i] += 1
    rows = kept.collect()
    with_words = Counter(r.doc_id for r in rows if words(r.text))
    assert all(n == 1 for n in with_words.values())
    assert set(with_words) == {i for i, t in texts() if words(t) and i in want}
    assert Counter((r.doc_id, r.text) for r in rows if not words(r.text)) == Counter((i, t) for i, t in texts() if not words(t))


def test_tree_links_are_those_of_all_pairs():
    rng = np.random.default_rng(4)
    sets = []
    for f in range(12):
        base = rng.integers(0, 2 ** 63, int(rng.integers(1, 200)), dtype=np.int64).astype(np.uint64)
        for _ in range(int(rng.integers(1, 30))):
            own = base.copy()
            k = int(rng.integers(0, max(1, len(own) // 4)))
            own[rng.permutation(len(own))[:k]] = rng.integers(0, 2 ** 63, k, dtype=np.int64).astype(np.uint64)
            sets.append(np.unique(own))

    def labels(pairs):
        forest = jaccard.Forest(len(sets))
        for a, b in pairs:
            forest.join(a, b)
        return forest.label.tolist()

    def linked(a, b):
        n = len(np.intersect1d(sets[a], sets[b]))
        return 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)

    every = [(a, b) for a in range(len(sets)) for b in range(a) if linked(a, b)]
    assert labels(zip(*jaccard.tree_links(sets))) == labels(every)
    chunk = rng.integers(0, 2, len(sets))
    across = [(a, b) for a, b in every if chunk[a] != chunk[b]]
    assert labels(zip(*jaccard.tree_links(sets, chunk))) == labels(across)


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(1000, 1300)] + [(5, 5), (300, 200), (200, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {x: 7 for x in range(1000, 1300)} | {7: 7, 200: 200, 300: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 6: importance resampling -----------------------------------------------------------

def _labelled(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(300):
        good = i % 4 != 0
        pool = 3000 if good else 60
        rows.append((i, " ".join(("g" if good else "bad") + str(x) for x in rng.integers(0, pool, 80))))
        if i % 3 == 0:
            labels.append((i, int(good), 0))
    rows += [(1000, None), (1001, ""), (1002, rows[1][1]), (1002, rows[1][1]), (None, rows[2][1])]
    labels += [(None, 1, 0), (5, None, 0), (6, 1, None), (6, 1, None), (7777, 0, 0)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_resampling_held_out_accuracy(spark):
    docs, labels = _labelled(spark)
    out = resampling.resample(docs, labels)
    rows = out.collect()
    assert len(rows) == 305 and sorted(r.place for r in rows) == list(range(305))
    unseen = [r for r in rows if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 3]
    assert sum(r.selected == (r.doc_id % 4 != 0) for r in unseen) >= 0.99 * len(unseen)
    assert not any(r.selected for r in rows if r.n_grams == 0)
    by_place = sorted(rows, key=lambda r: r.place)
    keys = [r.gumbel_key for r in by_place if r.gumbel_key is not None]
    assert keys == sorted(keys, reverse=True)
    kept = resampling.keep_selected(docs, out)
    assert kept.columns == docs.columns and kept.count() == sum(r.selected for r in rows)
    ten = resampling.resample(docs, labels, k=10)
    assert ten.where("selected").count() == 10


def test_resampling_weight_is_the_ratio_of_the_models(spark):
    docs, labels = _labelled(spark)
    sample = resampling.label_sample(labels).collect()
    good = {r.l_id for r in sample if r.good}
    ratio = resampling.fit(docs, resampling.label_sample(labels), 64)
    raw, target = np.zeros(64), np.zeros(64)
    for r in docs.select("doc_id", "text").collect():
        import pyarrow as pa
        f, _ = resampling._features(pa.array([r.text or ""], pa.large_string()), 64)
        raw += np.bincount(f, minlength=64)
        if r.doc_id in good:
            target += np.bincount(f, minlength=64)
    want = np.log((target + 1) / (target.sum() + 64)) - np.log((raw + 1) / (raw.sum() + 64))
    assert np.allclose(ratio, want)


def test_resampling_empty_tables(spark):
    docs, labels = _labelled(spark)
    assert resampling.resample(empty(spark), labels).count() == 0
    none = resampling.resample(docs, labels.limit(0))
    assert none.where("selected").count() == docs.where("length(trim(text)) > 0").count()


def test_resampling_rejects_toxic_documents_of_good_quality(spark):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(600):
        bad, toxic = i % 10 == 0, i % 10 == 1
        body = [("bad" if bad else "g") + str(x) for x in rng.integers(0, 60 if bad else 1500, 150)]
        if toxic:
            body[int(rng.integers(0, 150))] = f"Slur{i % 3}"
        rows.append((i, " ".join(body)))
        if i % 20 < 10:
            labels.append((i, int(not bad), int(toxic)))
    rows.append((1000, None))
    sample = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    picked = {r.doc_id: r.selected for r in resampling.resample(documents(spark, rows), sample).collect()}
    for seen in (True, False):       # labelled ones, and those that no label covers
        part = [i for i in range(600) if (i % 20 < 10) == seen]
        clean, toxic = [i for i in part if i % 10 > 1], [i for i in part if i % 10 == 1]
        assert sum(picked[i] for i in clean) >= 0.95 * len(clean)
        assert sum(picked[i] for i in toxic) <= 0.1 * len(toxic)
        assert sum(picked[i] for i in part if i % 10 == 0) <= 0.1 * len(part) / 10
    assert not picked[1000]


# --- 7: substring dedup -----------------------------------------------------------------

@pytest.mark.parametrize("max_suffixes, group_bytes", [(1 << 16, 1 << 22), (2, 7000)])
def test_substrings_equal_brute_force(spark, max_suffixes, group_bytes):
    first: dict = {}
    rows = texts()
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - 12):
            k = tuple(w[p:p + 13])
            first[k] = min(first.get(k, BIG), oid(i))
    want = Counter()
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if first[tuple(w[p:p + 13])] < oid(i):
                gone[p:p + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        want[(i, len(w), sum(gone), hashlib.sha256(kept).hexdigest())] += 1
    out = substrings.dedup_substrings(documents(spark), max_suffixes=max_suffixes, group_bytes=group_bytes)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()) == want


def test_substrings_carry_and_empty(spark):
    docs = documents(spark)
    out = substrings.dedup_substrings(docs, carry=["lang", "n_chars", "size"])
    assert out.columns[-4:] == ["kept_text", "lang", "n_chars", "size"]
    for r in out.collect():
        assert hashlib.sha256(b" ".join(words(r.kept_text))).hexdigest() == r.kept_sha256
    assert substrings.dedup_substrings(empty(spark)).count() == 0


# --- 8: exact top-k ---------------------------------------------------------------------

def _vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 12)]) for i in range(260)]
    rows += [(300, None), (350, [1.0, None, 2.0]), (400, [float("nan")] * 12), (450, [float("inf")] + [0.0] * 11), (None, [0.1] * 12),
             (500, []), (501, [0.5] * 3), (502, rows[4][1]), (503, rows[4][1]), (503, rows[4][1]), (550, [-0.9] * 12), (600, [0.0] * 12)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vec", F.lit(1)).withColumn("qb", F.lit("x"))


def _brute_top(rows, k=5, each=50):
    """Row by row: each query row against every other row."""
    held = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (qi, q) in enumerate(held):
        if qi % each == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), i) for n, (i, v) in enumerate(held) if n != at)[:k]
            out += [(qi, r, i, -x) for r, (x, i) in enumerate(s, start=1)]
    return Counter(out)


@pytest.mark.parametrize("lists, qb, vb", [(4, 1024, 8192), (3, 2, 17), (1, 3, 40)])
def test_topk_equals_brute_force(spark, lists, qb, vb):
    rows, df = _vectors(spark)
    got = topk.search(df, F.col("vec_id") % 50 == 0, lists=lists, query_block=qb, vector_block=vb)
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == _brute_top(rows)


@pytest.mark.parametrize("lists, qb, vb", [(4, 1024, 8192), (2, 1, 2)])
def test_topk_counts_every_copy_of_a_row(spark, lists, qb, vb):
    """Copies of a row, of a query's own too, are rows of their own; so are rows of one id with other vectors."""
    big, small = [4.0, -3.0, 2.0], [0.5, 0.5, 0.5]
    for rows in ([(0, big)] * 3 + [(50, small)] * 2 + [(50, big)] + [(7, big)] * 4 + [(8, small), (9, [-1.0, 0.0, 0.0])],
                 [(50, small)] * 9, [(50, small)], [(50, small), (50, big)], [(50, big), (1, small), (1, small)]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("copies", F.lit("x")).withColumn("row", F.lit(1))
        got = topk.search(df, F.col("vec_id") % 50 == 0, lists=lists, query_block=qb, vector_block=vb)
        assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == _brute_top(rows)


def test_topk_few_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, -3.0]), (2, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(df, F.col("vec_id") % 50 == 0)
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == _brute_top(rows)
    assert topk.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# --- 9: sharding ------------------------------------------------------------------------

def test_shards(spark):
    rows = sharding.shard_documents(documents(spark), [1.0] * 24, grown=[1.0] * 25).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "key") for i, t in texts())
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append((r.slot, oid(r.doc_id) if r.doc_id is not None else -1))
        assert r.grown_shard in (r.shard, 24)

        def u(i):
            return int(hashlib.md5(f"{'null' if r.doc_id is None else r.doc_id}/{i}/".encode()).hexdigest()[:13], 16)
        assert r.shard == max(range(24), key=lambda i: (u(i), -i))
        assert r.grown_shard == max(range(25), key=lambda i: (u(i), -i))
    for rows in slots.values():
        rows.sort()
        assert [s for s, _ in rows] == list(range(len(rows)))
        assert [i for _, i in rows] == sorted(i for _, i in rows)
    assert sharding.shard_documents(empty(spark), [1.0] * 24).count() == 0


def test_weighted_shards_share_by_weight(spark):
    df = spark.range(20000).select(sharding.rendezvous(F.col("id"), [1.0, 2.0, 0.0, 5.0]).alias("s"))
    n = Counter(r.s for r in df.collect())
    assert set(n) == {0, 1, 3}
    for s, w in ((0, 1), (1, 2), (3, 5)):
        assert abs(n[s] / 20000 - w / 8) < 0.02


def test_numbered_with_one_hot_key(spark):
    df = spark.createDataFrame([("a", 1)] * 500 + [("b", i % 7) for i in range(200)], "k string, v int").repartition(9)
    rows = numbered(df, "k", [F.col("v")], "at", "t").collect()
    assert sorted(r["at"] for r in rows if r.k == "a") == list(range(500))
    b = sorted((r["at"], r.v) for r in rows if r.k == "b")
    assert [x for x, _ in b] == list(range(200)) and [v for _, v in b] == sorted(v for _, v in b)
    whole = numbered(df, None, [F.col("k").desc(), F.col("v")], "at", "t").collect()
    assert sorted(r["at"] for r in whole) == list(range(700))


# --- 10: Katz backoff --------------------------------------------------------------------

def _katz(rows, top=5):
    tok = [(i, [*words(t, lower=True), None]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    uni, bi = Counter(), defaultdict(Counter)
    for (_, t), h in zip(tok, held):
        if not h:
            uni.update(t)
            for a, b in zip(["begin", *t[:-1]], t):
                bi[a][b] += 1
    n, v = sum(uni.values()), len(uni)

    def times(counts):
        out = [0] * (top + 3)
        for c in counts:
            out[min(c, top + 2)] += 1
        return out

    n1, n2 = times(uni.values()), times(c for s in bi.values() for c in s.values())
    d1, d2 = katz.discounts(n1, top), katz.discounts(n2, top)

    def mass(d, c):
        return c if c > top else d[c] * c

    freed = sum((1 - d1[r]) * r * n1[r] for r in range(1, top + 1))
    total = n if freed > 0 else n + 1
    unknown = (freed if freed > 0 else 1) / total

    def p(w):
        return mass(d1, uni[w]) / total if uni[w] else unknown

    model = {}
    for ctx, s in bi.items():
        c = sum(s.values())
        f = sum((1 - d2[x]) * x for x in s.values() if x <= top)
        model[ctx] = (c if f > 0 else c + 1, (f or 1) / (c if f > 0 else c + 1) / (1 - sum(p(w) for w in s)))
    out = []
    for (i, t), h in zip(tok, held):
        score = 0.0
        for a, b in zip(["begin", *t[:-1]], t):
            q = mass(d2, bi[a][b]) / model[a][0] if a in bi and bi[a][b] else (model[a][1] if a in model else 1) * p(b)
            score += math.log10(q)
        base = sum(math.log10((uni[b] + 1) / (n + v + 1)) for b in t)
        out.append((i, h, len(t), sum(uni[b] > 0 for b in t), n, base, score))
    sums = [sum(mass(d2, c) for c in s.values()) / model[ctx][0] + model[ctx][1] * (1 - sum(p(w) for w in s)) for ctx, s in bi.items()]
    return out, sums, sum(p(w) for w in uni) + unknown


@pytest.mark.parametrize("group_bytes, bucket_keys", [(1 << 22, 1 << 19), (5000, 300)])
def test_katz_equals_brute_force(spark, group_bytes, bucket_keys):
    want, sums, low = _katz(texts())
    assert abs(low - 1) < 1e-9 and all(abs(s - 1) < 1e-9 for s in sums)
    got = katz.score(documents(spark), katz.crc_held_out(), group_bytes=group_bytes, bucket_keys=bucket_keys).collect()

    def key(r):
        return (-1 if r[0] is None else r[0], *r[1:5], round(r[5], 5), round(r[6], 5))

    assert Counter(map(key, want)) == Counter(key(tuple(r)) for r in got)


def test_katz_without_training_or_rows(spark):
    assert katz.score(empty(spark), katz.crc_held_out()).count() == 0
    rows = katz.score(documents(spark, [(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows} == {(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)}

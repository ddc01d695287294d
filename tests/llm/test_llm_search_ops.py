"""Language filters, ranked search and spelling variants against plain versions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_small import documents, empty, texts
from reglink.llm import langid, ranked, variants

SF = SF_SMALL
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- 11: language identification ----------------------------------------------

def plain_grams(text: str) -> Counter:
    points = "".join(c if c.isalpha() else " " for c in text)
    points = "".join(c.lower() if len(c.lower()) == 1 and c.lower().isalpha() else c for c in points)
    line = " " + " ".join(points.split()) + " "
    return Counter(line[i:i + n] for n in langid.SIZES for i in range(len(line) - n + 1) if line[i:i + n] != " ") if line.strip() else Counter()


def test_grams_of_parts_are_those_of_the_text():
    fold = langid.letters()
    odd = [t or "" for _, t in texts()] + ["Ǆ İ ß ΑΒΓ", "a" * 50 + "  .. " * 30 + "日本語 text", "é", "1234", " ", "\U00020000 x \U0010FFFF y"]

    def per_text(chunk):
        out = defaultdict(Counter)
        for part in langid.folded(odd, fold, chunk):
            for h, doc in langid.grams(part):
                for a, d in zip(h.tolist(), doc.tolist()):
                    out[d][a] += 1
        return {d: c for d, c in out.items() if c}

    whole = per_text(1 << 20)
    assert whole == per_text(7) == per_text(64)          # chunks of a long text change nothing
    for d, t in enumerate(odd):
        assert sorted(whole.get(d, Counter()).values()) == sorted(plain_grams(t).values()), t[:40]


def test_filters_hold_the_sets_and_correct_chance_hits(spark):
    data = [(i, t, lang) for i, (t, lang) in enumerate([("abc abd", "x"), ("abc qqq", "y"), ("zzz", "x"), (None, "x"), ("lost", None), ("12 3", "none")] * 9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    f = langid.fit(docs)
    assert f.langs == ["x", "y"]                         # 'none' has documents without letters only
    part = next(langid.folded(["abc", "qqq", "zzz"], langid.letters()))
    masks = {}
    for h, doc in langid.grams(part):
        for d, m in zip(doc.tolist(), next(f.masks(h)).tolist()):
            masks.setdefault(d, []).append(m)
    assert all(m & 3 == 3 for m in masks[0])             # both languages hold abc
    assert all(m & 2 for m in masks[1]) and all(m & 1 for m in masks[2])
    # a filter so small that most lookups hit by chance: corrected counts still tell the languages apart
    small = langid.fit(docs, row_bits=6, hashes=2)
    assert small.false.min() > 0.05
    n, hits = langid.measure(["abd abd zzz", "qqq qqq", "", "7"], small, langid.letters())
    assert hits[0, 0] > hits[0, 1] and hits[1, 1] > hits[1, 0] and n[2] == n[3] == 0


def test_many_languages_take_more_words_of_a_mask(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    langs = [f"l{a}{b}" for a in letters[:9] for b in letters[:9]]
    data = [(i, f"{x[1:] * 4} {x[1:]}{x[2]}", x) for i, x in enumerate(langs)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    f = langid.fit(docs)
    assert len(f.langs) == 81 and f.rows.shape == (11, 1 << langid.ROW_BITS)
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, f).collect()}
    assert sum(got[i] == x for i, x in enumerate(langs)) >= 79


def test_language_odd_rows(spark):
    docs = documents(spark)
    got = langid.identify(docs, langid.held_out())
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "n_grams"]
    want = sorted(((i, zlib.crc32(str("" if i is None else i).encode()) % 4 == 2, "en" if any(c.isalpha() for c in t or "") else "und", sum(plain_grams(t or "").values())) for i, t in texts()), key=repr)
    rows = got.collect()
    assert sorted(((r.doc_id, r.held_out, r.lang_pred, r.n_grams) for r in rows), key=repr) == want
    assert all(0 <= r.score <= 1 for r in rows) and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert langid.identify(empty(spark), langid.held_out()).count() == 0
    unlabelled = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled, langid.held_out()).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs, langid.held_out()).join(docs.select("doc_id", "lang", "text"), "doc_id").where("held_out and lang_pred <> 'und' and length(text) > 20")
    right, total = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert total > 150 and right >= 0.97 * total


def test_lang_source_and_id_are_no_inputs_of_a_prediction(spark):
    docs = documents(spark).where("doc_id is not null")
    f = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    plain = rows_of(langid.predict(docs, f).select("lang_pred", "score"))
    changed = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("other")).withColumn("doc_id", F.col("doc_id") + 1000)
    assert rows_of(langid.predict(changed, f).select("lang_pred", "score")) == plain


# --- 12: ranked search ---------------------------------------------------------

RUN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_rank(docs, items, k=10):
    terms = [(i, RUN.findall((t or "").translate(UPPER))) for i, t in docs]
    held = [(i, Counter(t), len(t)) for i, t in terms if t]
    n, total = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        own = set(RUN.findall((text or "").translate(UPPER)))
        scored = []
        for i, c, size in held:
            m = 100 - 90 + (90 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "w1 w2 W3 der Straße"), (2, "éé 日本"), (3, None), (None, "w5 w6"), (4, ""), (5, "nothing-of-this q0q0"), (6, " ".join(f"w{i}" for i in range(400))),
         (7, "TWO words"), (1, "w1 w2 W3 der Straße"), (8, "x" * 300 + " same"), (9, "no id here"), (10, "same same same")]


@pytest.mark.parametrize("block,terms", [(ranked.BLOCK_BYTES, ranked.MAX_TERMS), (3000, 100)])
def test_ranking_equals_brute_force(spark, block, terms):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("clash")).withColumn("rank", F.lit(7))
    got = ranked.rank_documents(documents(spark), items, block_bytes=block, max_terms=terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == plain_rank(texts(), ITEMS)


def test_ranking_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked.rank_documents(empty(spark), items).count() == 0
    assert ranked.rank_documents(documents(spark), items.limit(0)).count() == 0
    assert ranked.rank_documents(documents(spark, [(1, None), (2, " ")]), items).count() == 0


def test_accumulators_stop_and_scores_stay_exact():
    r = np.random.default_rng(3)
    for _ in range(60):
        n, k = 300, 5
        sizes = sorted(r.integers(1, 200, 12).tolist())
        posts = [(np.sort(r.choice(n, s, replace=False)), r.integers(1, 1000 * 4 ** (12 - j), s)) for j, s in enumerate(sizes)]
        best = ranked.Best(k)
        at, score, made = ranked.accumulate(list(range(12)), np.array([p[1].max() for p in posts]), lambda t: posts[t], n, best)
        best.add(score, at)
        whole = np.zeros(n, np.int64)
        for d, g in posts:
            whole[d] += g
        order = np.lexsort((np.arange(n), -whole))[:k]
        assert best.id.tolist() == order.tolist() and best.score.tolist() == whole[order].tolist()
        assert made < (whole > 0).sum()
        again = ranked.accumulate(list(range(12)), np.array([p[1].max() for p in posts]), lambda t: posts[t], n, best)
        assert again[2] <= made                          # what the task holds already closes it sooner


def test_ranking_equals_its_sql(spark):
    with duckdb.connect() as db:
        for name in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
        want = sorted(db.execute(ranked.ranked_sql()).fetchall())
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    assert sorted(tuple(r) for r in ranked.rank_documents(docs, items).collect()) == want


# --- 13: spelling variants -----------------------------------------------------

LATIN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(docs, every, min_length):
    out = Counter()
    for i, t in docs:
        for w in LATIN.findall(t or ""):
            w = w.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= min_length:
                out[w] += 1
    return out


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts: dict[str, int], ratio=5):
    form, out = {}, []
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = (best if best is not None and counts[best] >= ratio * n else None, len(others))
    for w, n in counts.items():
        root = w
        while form[root][0] is not None:
            root = form[root][0]
        out.append((w, form[w][0], root, n, form[w][1], counts.get(form[w][0])))
    return sorted(out, key=repr)


def variant_texts():
    import random

    r = random.Random(8)
    base = ["banana", "bananna", "bandana", "aaaaaa", "aaaaaaa", "aaaaaaaa", "abcdefg", "abcdefh", "straße", "strasse", "ÀÈÌÒÙÿ", "naïveté", "x" * 40]
    words = base + [b[:i] + c + b[i + d:] for b in base for i in range(0, len(b), 2) for c in ("", "q", "é") for d in (0, 1)]
    weights = [r.choice([1, 1, 2, 10, 60]) for _ in words]
    out = [(i, " ".join(r.choices(words, weights, k=120)) + "×÷ a1b2 qĀz") for i in range(60)]
    return out + [(None, "banana " * 30), (7, out[7][1]), (8, None), (9, ""), (10, "a" * 3000 + " Ω " + "É" * 100)] + texts()


def test_crc_of_joined_strings():
    pairs = [(f"{i}:".encode(), w.encode()) for i in (0, 1, 99, 10 ** 18, -5) for w in ("", "a", "straße", "x" * 700)]
    a, b = zip(*pairs)
    got = variants.joined_crc(np.array([zlib.crc32(x) for x in a], np.uint32), np.array([zlib.crc32(x) for x in b], np.uint32), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in pairs]


@pytest.mark.parametrize("every,length,least", [(199, 6, 5), (3, 1, 1)])
def test_variants_equal_brute_force(spark, every, length, least):
    docs = [(i, t[:1500] if t and length == 1 else t) for i, t in variant_texts()][:85]
    counts = {w: n for w, n in plain_words(docs, every, length).items() if n >= least}
    got = variants.spelling_variants(documents(spark, docs), every, length, least)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(got) == plain_variants(counts)


def test_variants_chain_to_the_last_form(spark):
    counts = {"a" * (10 + i): 6 ** i for i in range(9)} | {"zzzzzz": 4}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: r for r in variants.group_variants(words).collect()}
    assert all(got["a" * (10 + i)].root == "a" * 18 for i in range(9)) and got["a" * 18].form is None and got["zzzzzz"].root == "zzzzzz"
    assert rows_of(variants.group_variants(words)) == plain_variants(counts)


def test_variants_of_nothing_and_the_terminator(spark):
    assert variants.spelling_variants(empty(spark)).count() == 0
    with pytest.raises(Exception, match="terminator"):
        variants.group_variants(spark.createDataFrame([("a$b", 1), ("ab", 9)], "word string, n long")).collect()


def test_variants_form_no_pairs(spark):
    """A thousand words one replacement apart: a range's rows are its members, not its pairs."""
    words = spark.createDataFrame([(f"{chr(0x4E00 + i)}bcdef", i + 1) for i in range(1000)], "word string, n long")
    got = variants.neighbours(words)
    assert {r.n_near for r in got.collect()} == {999}
    assert variants.rotations(words).count() == 1000 * 13
    assert "CartesianProduct" not in (plan := got._jdf.queryExecution().toString()) and "NestedLoop" not in plan and "Join" not in plan

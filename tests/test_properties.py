"""Seeded property tests: fast paths against brute-force definitions."""

from __future__ import annotations

import random
import re
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reglink.functions.similarity import canonical_tokens_sql
from reglink.functions.clean import clean_name
from reglink.operators import token_join
from reglink.operators.edit_join import edit_pairs


def lev(a: str, b: str) -> int:
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def lcs(a: str, b: str) -> int:
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def half_even(num: int, den: int) -> int:
    """round_half_even(num / den) exactly."""
    q, r = divmod(num, den)
    if 2 * r > den or (2 * r == den and q % 2 == 1):
        q += 1
    return q


def ratio(x: str, y: str) -> int:
    if not x or not y:
        return 0
    return half_even(200 * lcs(x, y), len(x) + len(y))


def token_set_ratio(a: str, b: str) -> int:
    def toks(s):
        s = re.sub(r"[\u0080-ÿ]", "", s)
        s = re.sub(r"\W", " ", s).lower().strip()
        return set(s.split())
    A, B = toks(a), toks(b)
    if not A or not B:
        return 0
    t0 = " ".join(sorted(A & B))
    t1 = (t0 + " " + " ".join(sorted(A - B))).strip()
    t2 = (t0 + " " + " ".join(sorted(B - A))).strip()
    return max(ratio(t0, t1), ratio(t0, t2), ratio(t1, t2))


def _mutate(rng, s, alpha):
    s = list(s)
    for _ in range(rng.randint(0, 3)):
        op, pos = rng.random(), rng.randint(0, len(s))
        if op < 0.33 and s:
            s.pop(min(pos, len(s) - 1))
        elif op < 0.66:
            s.insert(pos, rng.choice(alpha))
        elif s:
            s[min(pos, len(s) - 1)] = rng.choice(alpha)
    return "".join(s)


@pytest.mark.parametrize("threshold", [0.9, 0.8, 0.6])
def test_edit_pairs_complete_and_exact(spark, threshold):
    rng = random.Random(11)
    alpha = "abcd "
    base = ["".join(rng.choice(alpha) for _ in range(rng.randint(1, 26))) for _ in range(150)]
    A = sorted({_mutate(rng, x, alpha) for x in base})
    B = sorted({_mutate(rng, x, alpha) for x in base} | set(base))
    f = Fraction(str(threshold))
    p, q = f.numerator, f.denominator
    want = {(a, b) for a in A for b in B if a and b and q * lev(a, b) <= (q - p) * max(len(a), len(b))}
    got = {(r.a, r.b) for r in edit_pairs(spark.createDataFrame([(x,) for x in A], "a string"),
                                          spark.createDataFrame([(x,) for x in B], "b string"),
                                          threshold).collect()}
    assert got == want


def test_threshold_one_is_equality(spark):
    a = spark.createDataFrame([("anna",), ("ann",), ("",)], "a string")
    b = spark.createDataFrame([("anna",), ("anna ",), ("",)], "b string")
    assert {(r.a, r.b) for r in edit_pairs(a, b, 1.0).collect()} == {("anna", "anna")}


def test_token_set_join_matches_definition(spark):
    rng = random.Random(5)
    words = ["mal", "road", "haripur", "hariipur", "po", "siliguri", "ward", "4", "736121", "73612",
             "alipurduar", "i", "ii", "dinhata", "x1"]

    def text():
        return rng.choice([", ", " ", "-"]).join(rng.choice(words) for _ in range(rng.randint(1, 4)))

    left = [(i, text()) for i in range(120)] + [(200, "Haripur"), (201, "Hariipur"), (202, None), (203, "--")]
    right = [(f"g{j}", text()) for j in range(40)] + [("h", "haripur"), ("n", "nation_1x")]
    want = set()
    for i, a in left:
        for j, b in right:
            if a is None or b is None:
                continue
            s = token_set_ratio(a, b)
            if s >= 80:
                want.add((i, j, s))
    ldf = spark.createDataFrame(left, "k long, t string")
    rdf = spark.createDataFrame(right, "g string, u string")
    got = {(r.k, r.g, r.score) for r in token_join.token_set_join(ldf, rdf, "k", "t", "g", "u", 80).collect()}
    assert got == want


def test_token_set_symmetric_and_containment(spark):
    pairs = [("12 mill road haripur", "road haripur"), ("abc", "abd"), ("nation_1x", "nation_12")]
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = canonical_tokens_sql("a"), canonical_tokens_sql("b")
    fwd, rev = df.selectExpr(f"{a} AS lc", f"{b} AS rc"), df.selectExpr(f"{b} AS lc", f"{a} AS rc")
    s1 = [r.score for r in token_join.score_pairs(fwd).orderBy("lc").collect()]
    s2 = [r.score for r in token_join.score_pairs(rev).orderBy("rc").collect()]
    assert s1 == s2
    assert s1[0] == 100 or s2[0] == 100
    assert [token_set_ratio(a, b) for a, b in pairs] == [100, 67, 89]


def test_lcs_udf(spark):
    rng = random.Random(3)
    rows = [("".join(rng.choice("ab c") for _ in range(rng.randint(0, 90))),
             "".join(rng.choice("ab c") for _ in range(rng.randint(0, 90)))) for _ in range(200)]
    from reglink.functions.similarity import lcs_length
    got = [r.l for r in spark.createDataFrame(rows, "a string, b string")
           .select(lcs_length("a", "b").alias("l")).collect()]
    assert got == [lcs(a, b) for a, b in rows]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text(alphabet=st.characters(max_codepoint=127), max_size=30)),
                min_size=1, max_size=20))
def test_clean_name_idempotent_and_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = df.select(clean_name("t").alias("c"))
    rows = once.select("c", clean_name("c").alias("cc")).collect()
    for t, r in zip(texts, rows):
        assert r.c == r.cc
        expected = " ".join(re.sub(r"[^a-z\s]", "", t.lower()).split()).strip()
        if t.isascii():
            assert r.c == expected


def damerau(a: str, b: str) -> int:
    last_row, big = {}, len(a) + len(b)
    d = [[0] * (len(b) + 2) for _ in range(len(a) + 2)]
    d[0][0] = big
    for i in range(len(a) + 1):
        d[i + 1][0], d[i + 1][1] = big, i
    for j in range(len(b) + 1):
        d[0][j + 1], d[1][j + 1] = big, j
    for i in range(1, len(a) + 1):
        last_col = 0
        for j in range(1, len(b) + 1):
            i1, j1 = last_row.get(b[j - 1], 0), last_col
            cost = 0 if a[i - 1] == b[j - 1] else 1
            if cost == 0:
                last_col = j
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1,
                                  d[i1][j1] + (i - i1 - 1) + 1 + (j - j1 - 1))
        last_row[a[i - 1]] = i
    return d[len(a) + 1][len(b) + 1]


@pytest.mark.parametrize("threshold", [0.9, 0.8])
def test_damerau_pairs_complete_and_exact(spark, threshold):
    rng = random.Random(17)
    alpha = "abcd "

    def swap(s):
        s = list(s)
        for _ in range(rng.randint(0, 3)):
            if len(s) > 1:
                i = rng.randrange(len(s) - 1)
                s[i], s[i + 1] = s[i + 1], s[i]
        return "".join(s)

    base = ["".join(rng.choice(alpha) for _ in range(rng.randint(1, 26))) for _ in range(120)]
    A = sorted({swap(_mutate(rng, x, alpha)) for x in base})
    B = sorted({swap(x) for x in base} | set(base))
    f = Fraction(str(threshold))
    p, q = f.numerator, f.denominator
    want = {(a, b) for a in A for b in B if a and b and q * damerau(a, b) <= (q - p) * max(len(a), len(b))}
    got = {(r.a, r.b) for r in edit_pairs(spark.createDataFrame([(x,) for x in A], "a string"),
                                          spark.createDataFrame([(x,) for x in B], "b string"),
                                          threshold, metric="damerau").collect()}
    assert got == want


def test_word_class_matches_python_re(spark):
    """strip_punct and the token normalisation use Python's word class
    (letters, numbers, '_'; combining marks are not word chars)."""
    from reglink.functions.clean import strip_punct
    from reglink.functions.similarity import canonical_tokens_sql
    texts = ["রিনা দাস, ২ নং ওয়ার্ড", "O'Neil-Smith 2nd", "Ünïcode_x ½ café", "áb c", "naïve—test_1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(strip_punct("t").alias("x"), F.expr(canonical_tokens_sql("t")).alias("y")).collect()
    for r, t in zip(rows, texts):
        assert r.x == re.sub(r"[^\w\s]", "", t)
        norm = re.sub(r"(?ui)\W", " ", re.sub(r"[\u0080-ÿ]", "", t)).lower().strip()
        assert r.y == " ".join(sorted(set(norm.split())))


@pytest.mark.parametrize("metric", ["levenshtein", "damerau"])
def test_long_strings_exact(spark, metric):
    """Longer strings (15-60 chars, budgets up to 9) through the segment path."""
    rng = random.Random(99)
    alpha = "abc de"
    base = ["".join(rng.choice(alpha) for _ in range(rng.randint(15, 60))) for _ in range(70)]
    A = sorted({_mutate(rng, _mutate(rng, x, alpha), alpha) for x in base})
    B = sorted({_mutate(rng, x, alpha) for x in base} | set(base))
    dist = lev if metric == "levenshtein" else damerau
    want = {(a, b) for a in A for b in B if 20 * dist(a, b) <= 3 * max(len(a), len(b))}
    got = {(r.a, r.b) for r in edit_pairs(spark.createDataFrame([(x,) for x in A], "a string"),
                                          spark.createDataFrame([(x,) for x in B], "b string"),
                                          0.85, metric=metric).collect()}
    assert got == want


@pytest.mark.parametrize("metric", ["levenshtein", "damerau"])
@pytest.mark.parametrize("threshold", [0.9, 0.7])
def test_two_edits_exact(spark, metric, threshold):
    """Strings around the lengths where the budget becomes 1, 2 and 3."""
    rng = random.Random(7)
    alpha, middle = "abc", round(2.5 / (1 - threshold))
    base = ["".join(rng.choice(alpha) for _ in range(rng.randint(max(1, middle - 8), middle + 8))) for _ in range(110)]
    A = sorted({_mutate(rng, x, alpha) for x in base})
    B = sorted({_mutate(rng, x[1:2] + x[:1] + x[2:], alpha) for x in base} | set(base))
    f, dist = Fraction(str(threshold)), lev if metric == "levenshtein" else damerau
    p, q = f.numerator, f.denominator
    want = {(a, b) for a in A for b in B if a and b and q * dist(a, b) <= (q - p) * max(len(a), len(b))}
    got = {(r.a, r.b) for r in edit_pairs(spark.createDataFrame([(x,) for x in A], "a string"),
                                          spark.createDataFrame([(x,) for x in B], "b string"),
                                          threshold, metric=metric).collect()}
    assert got == want and len(want) > 50

"""Similarity functions.

* Edit similarity ``1 - levenshtein(a, b) / max(len a, len b)`` tested in
  integers: with ``t = p/q``, ``sim >= t``  <=>  ``q*d <= (q-p)*max``.
* ``token_set_ratio`` (0..100): normalise (drop U+0080..U+00FF, non-word
  chars -> space, lower, trim), take token sets A, B and compare
  ``t0 = sort(A&B)``, ``t1 = t0+' '+sort(A-B)``, ``t2 = t0+' '+sort(B-A)``:
  ``max(ratio(t0,t1), ratio(t0,t2), ratio(t1,t2))`` with
  ``ratio(x, y) = round_half_even(200*LCS(x, y) / (|x|+|y|))`` (0 if either is
  empty).  The scoring itself lives in ``operators.token_join.score_pairs``;
  here are the normalisation and the LCS / Damerau Arrow UDFs.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reglink.functions.util import as_col


def threshold_fraction(t: float) -> tuple[int, int]:
    """``t`` as an exact fraction ``p/q`` (0 < t <= 1)."""
    if not 0 < t <= 1:
        raise ValueError(f"threshold must be in (0, 1], got {t}")
    f = Fraction(str(t)).limit_denominator(10**6)
    return f.numerator, f.denominator


def edit_score(a, b) -> Column:
    """Integer percent ``floor(100 * (M - d) / M)``; null when both are empty."""
    a, b = as_col(a), as_col(b)
    m = F.greatest(F.length(a), F.length(b))
    return F.when(m == 0, F.lit(None)).otherwise(
        F.floor((100 * (m - F.levenshtein(a, b))) / m).cast("int"))


BANDED_MAX = 4  # budgets 1..4 use the banded, early-exit levenshtein(a, b, k)


def edit_within_sql(a: str, b: str, t: float) -> str:
    """SQL for ``edit_similarity(a, b) >= t`` in exact integer arithmetic.

    The pair's edit budget is ``floor((q-p) * max(len) / q)``; small budgets
    use Spark's banded ``levenshtein(a, b, k)`` (returns -1 beyond ``k``),
    budget 0 is equality.  Blank never matches."""
    p, q = threshold_fraction(t)
    la, lb = f"length({a})", f"length({b})"
    budget = f"floor({q - p} * greatest({la}, {lb}) / {q})"
    banded = " ".join(f"WHEN {budget} = {k} THEN levenshtein({a}, {b}, {k}) >= 0"
                      for k in range(1, BANDED_MAX + 1))
    return (f"({la} > 0 AND {lb} > 0 AND CASE WHEN {budget} = 0 THEN {a} = {b} {banded} "
            f"ELSE {q} * levenshtein({a}, {b}) <= {q - p} * greatest({la}, {lb}) END)")


def edit_within(a, b, t: float) -> Column:
    """``edit_similarity(a, b) >= t``; ``a``/``b`` are column names or columns."""
    if isinstance(a, str) and isinstance(b, str):
        return F.expr(edit_within_sql(f"`{a}`", f"`{b}`", t))
    p, q = threshold_fraction(t)
    a, b = as_col(a), as_col(b)
    m = F.greatest(F.length(a), F.length(b))
    return (F.length(a) > 0) & (F.length(b) > 0) & (q * F.levenshtein(a, b) <= (q - p) * m)


# ---------------------------------------------------------------------------
# token_set_ratio
# ---------------------------------------------------------------------------

def canonical_tokens_sql(x: str) -> str:
    """SQL: sorted distinct tokens of the normalised text joined by one space
    ('' for blank) -- the canonical form a token-set score depends on."""
    # Python's \W: anything but letters, numbers and '_' (marks included)
    norm = rf"trim(lower(regexp_replace(regexp_replace({x}, r'[\x{{80}}-\x{{FF}}]', ''), r'[^\p{{L}}\p{{N}}_]', ' ')))"
    return f"array_join(array_sort(array_distinct(filter(split({norm}, ' '), t -> t != ''))), ' ')"


def _make_lcs_udf():
    # Built in a factory so cloudpickle ships the function by value: executors
    # need pandas only, not this package on their path.
    WORDS, CELLS = 4, 1 << 16       # longest shorter text in 64-bit words, and characters at once

    def one(x: str, y: str) -> int:
        """One pair of long texts: Python integers hold any number of bits."""
        masks: dict[str, int] = {}
        for i, ch in enumerate(x):
            masks[ch] = masks.get(ch, 0) | (1 << i)
        full = (1 << len(x)) - 1
        v = full
        for ch in y:
            u = v & masks.get(ch, 0)
            v = ((v + u) | (v - u)) & full
        return len(x) - v.bit_count()

    def codes(texts: list[str], width: int, fill: int) -> np.ndarray:
        """Code points, one text a row, filled up with ``fill``."""
        out = np.full((len(texts), width), fill, np.uint32)
        size = np.array([len(t) for t in texts])
        out[np.arange(width) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        return out

    def many(xs: list[str], ys: list[str], words: int) -> np.ndarray:
        """Pairs as rows, the second texts from long to short: each step takes one character of all that have it."""
        a = codes(xs, 64 * words, 0xFFFFFFFF)
        b = codes(ys, len(ys[0]), 0xFFFFFFFE).T.copy()
        left = -np.array([len(y) for y in ys])
        v = np.full((words, len(xs)), 0xFFFFFFFFFFFFFFFF, np.uint64)
        for j in range(len(b)):
            n = int(np.searchsorted(left, -j, "left"))               # rows with more than j characters
            same = np.packbits(a[:n] == b[j, :n, None], axis=1, bitorder="little").view("<u8")
            carry = np.zeros(n, bool)
            for w in range(words):
                old = v[w, :n]
                u = old & same[:, w]
                s = old + u
                t = s + carry
                carry = (s < old) | (t < s)
                v[w, :n] = t | (old - u)
        return 64 * words * np.ones(len(xs), np.int64) - np.bitwise_count(v).sum(axis=0)

    def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
        """Length of the longest common subsequence (bit-parallel, Hyyro 2004), for a batch of pairs at once.

        ``V`` starts all ones over the bits of the shorter text; per char c of the other:
        ``U = V & M[c]; V = (V + U) | (V - U)``; LCS = number of zero bits in V.
        """
        out = np.zeros(len(a), np.int32)
        pairs = []
        for i, (x, y) in enumerate(zip(a, b)):
            if x and y:
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                words = -(-len(x) // 64)
                if words > WORDS:
                    out[i] = one(x, y)
                else:
                    pairs.append((words, -len(y), i, x, y))
        pairs.sort(key=lambda p: p[:3])
        at = 0
        while at < len(pairs):
            words = pairs[at][0]
            step = max(1, CELLS // max(64 * words, -pairs[at][1]))
            own = [p for p in pairs[at:at + step] if p[0] == words]
            out[[p[2] for p in own]] = many([p[3] for p in own], [p[4] for p in own], words)
            at += len(own)
        return pd.Series(out, dtype="int32")

    return F.pandas_udf(lcs_length, T.IntegerType())


lcs_length = _make_lcs_udf()


def _make_damerau_udf():
    # factory: shipped by value, executors need pandas only
    def damerau_levenshtein(a: pd.Series, b: pd.Series) -> pd.Series:
        """True (unrestricted) Damerau-Levenshtein distance: insert, delete,
        substitute, transpose adjacent chars (Lowrance-Wagner)."""
        out = []
        for x, y in zip(a, b):
            if x is None or y is None:
                out.append(None)
                continue
            last_row: dict[str, int] = {}
            big = len(x) + len(y)
            d = [[0] * (len(y) + 2) for _ in range(len(x) + 2)]
            d[0][0] = big
            for i in range(len(x) + 1):
                d[i + 1][0], d[i + 1][1] = big, i
            for j in range(len(y) + 1):
                d[0][j + 1], d[1][j + 1] = big, j
            for i in range(1, len(x) + 1):
                last_col = 0
                for j in range(1, len(y) + 1):
                    i1, j1 = last_row.get(y[j - 1], 0), last_col
                    cost = 1
                    if x[i - 1] == y[j - 1]:
                        cost, last_col = 0, j
                    d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1,
                                          d[i1][j1] + (i - i1 - 1) + 1 + (j - j1 - 1))
                last_row[x[i - 1]] = i
            out.append(d[len(x) + 1][len(y) + 1])
        return pd.Series(out, dtype="Int32")

    return F.pandas_udf(damerau_levenshtein, T.IntegerType())


damerau_distance = _make_damerau_udf()

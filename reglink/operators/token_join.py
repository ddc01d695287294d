"""Join on ``token_set_ratio(left_text, right_text) >= threshold``.

Exact candidate set, no cross product:

(a) pairs sharing at least one token.  Their score comes from the shared tokens against the shorter text, or from
    the LCS of both whole texts:
    - shared tokens: they must make up about two thirds of the shorter text.  Its tokens are put rarest first
      (by the right side's document frequency), and only those from which on the rest could still be
      enough are keys.  A word that every name holds is a key only of names that are little else;
    - LCS: both lengths lie within a factor of about 1.5, so keys are a token and a length class, and the
      characters that both texts have at all must be enough;
(b) pairs sharing none: then ``t0`` is empty and the score is
    ``ratio(sorted A, sorted B)``, which needs the indel distance
    ``|a| + |b| - 2*LCS`` to be at most ``(100.5 - T) / 100 * (|a| + |b|)``.
    Short pairs (pins, short names) share the string that is left after
    deleting the allowed number of characters from each side: an equi-join
    on (both lengths, that string).  Longer pairs use the segment filter of
    :mod:`reglink.operators.segments`, and must have enough characters of the
    other side's alphabet.

Scoring runs once per distinct pair of *token sets* (addresses and gazetteer
names repeat); ``LCS`` is computed by an Arrow UDF only for pairs where the
third ratio can still change the result.  Rows are attached afterwards.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reglink import constants as C
from reglink.functions.similarity import canonical_tokens_sql, lcs_length
from reglink.operators.segments import SEG_LEN, SEG_NO, SEG_TXT, index_segments, probe_segments
from reglink.session import join_side, stage_table

MIN_SCORE = 68  # below this the segment filter would cut more segments than characters
SHORT = 10      # pairs of at most this length on both sides use exact deletions
MAX_DELETED = 5  # most characters that a short pair at MIN_SCORE can lose on one side
VARIANT = "_del"


def deletions_sql(x: str, n: int) -> str:
    """SQL: every distinct string that is left after deleting exactly ``n`` characters."""
    out = f"array({x})"
    for _ in range(n):
        out = (f"array_distinct(flatten(transform({out}, y -> transform(sequence(1, length(y)), "
               f"i -> concat(substr(y, 1, i - 1), substr(y, i + 1))))))")
    return out


def _canonical(df: DataFrame, text: str, out: str) -> DataFrame:
    return df.selectExpr("*", f"{canonical_tokens_sql(f'`{text}`')} AS {out}")


class TokenSetIndex:
    """Right side of a token-set join, prepared once: canonical token strings
    of the rows, their distinct set, the token postings and the segment index
    for the no-shared-token path."""

    def __init__(self, right: DataFrame, right_key: str, right_text: str, threshold: int = C.ADDRESS_THRESHOLD):
        if threshold < MIN_SCORE:
            raise ValueError(f"token_set threshold {threshold} < {MIN_SCORE}")
        self.threshold = threshold
        self.key = right_key
        self.rows = _canonical(right.select(right_key, right_text), right_text, "rc") \
            .where(F.length("rc") > 0).select(right_key, "rc")
        self.values = self.rows.select("rc").distinct()
        self.tokens = self.values.select("rc", F.explode(F.split("rc", " ")).alias("tok"))
        self.num, self.den = 201 - 2 * threshold, 200  # indel distance <= num/den * (la + lb)
        # a long pair has a side above SHORT; its other side may be this short
        least = -(-(self.den - self.num) * (SHORT + 1) // (self.den + self.num))
        longish = self.values.where(F.length("rc") >= least)
        self.segments = index_segments(longish, "rc", self.tau).select(SEG_LEN, SEG_NO, SEG_TXT, "rc")
        self.lengths = longish.select(F.length("rc").alias(SEG_LEN)).distinct()
        self.deletions = self._deletions(self.values, "rc", "_lb", "_la")
        self.frequency = self.tokens.groupBy(F.col("tok").alias("_tok")).agg(F.count(F.lit(1)).alias("_df"))
        self.longest = self.values.agg(F.max(F.length("rc")).alias("n"))

    @cached_property
    def size(self) -> int:
        """Characters of the rows: tokens, keys and segments are fewer."""
        return self.rows.agg(F.coalesce(F.sum(F.length("rc")), F.lit(0)).alias("n")).first()["n"]

    def _side(self, df: DataFrame) -> DataFrame:
        """A table of the index in a join: a short gazetteer is sent to the addresses, a long one shuffled."""
        return join_side(df, self.size)

    @cached_property
    def keys(self) -> DataFrame:
        return self._keys(self.tokens, "rc")

    def _keys(self, tokens: DataFrame, text: str) -> DataFrame:
        """(text, tok) of the tokens by which a pair is found that shares enough of this text: rarest first, those from
        which on the tokens left could still make up the share that the threshold asks of the shared ones.

        The shared tokens, joined by blanks, are t0; ``round(200 t0 / (t0 + text)) >= T`` needs
        ``(401 - 2T) t0 >= (2T - 1) text``.  The rarest shared token has all others after it, so it is a key."""
        last = Window.partitionBy(text).orderBy(F.desc("_df"), F.length("tok"), F.desc("tok")).rowsBetween(Window.unboundedPreceding, 0)
        rest = tokens.join(self._side(self.frequency), F.col("tok") == F.col("_tok")).withColumn("_rest", F.sum(F.length("tok") + 1).over(last) - 1)
        return rest.where((401 - 2 * self.threshold) * F.col("_rest") >= (2 * self.threshold - 1) * F.length(text)).select(text, "tok")

    def band(self, l: str) -> tuple[str, str]:
        num, den = self.num, self.den
        return (f"CAST(ceil({den - num} * {l} / {den + num}) AS INT)",
                f"CAST(floor({den + num} * {l} / {den - num}) AS INT)")

    def tau(self, L: str) -> str:
        num, den = self.num, self.den
        partner_max = f"floor({den + num} * {L} / {den - num})"
        return f"floor({num} * ({L} + {partner_max}) / {den})"

    def _deletions(self, df: DataFrame, text: str, own: str, other: str) -> DataFrame:
        """(own length, partner length, string left) of short strings: per partner length within the band,
        the most characters that this side may lose are deleted."""
        lo, hi = self.band(own)
        rows = (df.selectExpr(f"`{text}`", f"length(`{text}`) AS {own}").where(f"{own} BETWEEN 1 AND {SHORT}")
                .selectExpr("*", f"explode(sequence(least(greatest({lo}, 1), {SHORT}), least({hi}, {SHORT}))) AS {other}")
                .where(f"{other} BETWEEN {lo} AND {hi}")
                .selectExpr("*", f"CAST(floor((floor({self.num} * ({own} + {other}) / {self.den}) + {own} - {other}) / 2) AS INT) AS _d")
                .where(f"_d >= 0 AND _d < {own}"))
        cases = " ".join(f"WHEN _d = {n} THEN {deletions_sql(f'`{text}`', n)}" for n in range(MAX_DELETED + 1))
        return rows.selectExpr(f"`{text}`", own, other, f"explode(CASE {cases} END) AS {VARIANT}")

    def persist(self) -> "TokenSetIndex":
        self.deletions = self.deletions.checkpoint()
        self.rows = self.rows.checkpoint()
        self.values = self.values.checkpoint()
        self.tokens = self.tokens.checkpoint()
        self.frequency = self.frequency.checkpoint()
        self.keys = self.keys.checkpoint()
        self.longest = self.longest.checkpoint()
        self.segments = self.segments.checkpoint()
        self.lengths = self.lengths.checkpoint()
        return self

    def _length_class(self, n: str) -> str:
        """Two lengths within the band are in the same class or in neighbouring ones."""
        return f"CAST(floor(ln({n}) / ln({self.den + self.num} / {self.den - self.num})) AS INT)"

    def _enough_characters(self) -> str:
        # LCS is at most the number of characters that the other side has at all
        common = "least(length(lc) - length(translate(lc, rc, '')), length(rc) - length(translate(rc, lc, '')))"
        return f"{self.den} * (length(lc) + length(rc) - 2 * {common}) <= {self.num} * (length(lc) + length(rc))"

    def shared_token_pairs(self, lc: DataFrame) -> DataFrame:
        """(a): ``(lc, rc)`` that share a token and can reach the threshold (with repeats)."""
        tokens = lc.select("lc", F.explode(F.split("lc", " ")).alias("tok"))
        right_shorter = tokens.join(self._side(self.keys), "tok").where("length(rc) <= length(lc)").select("lc", "rc")
        shorter = tokens.where(F.length("lc") < self.longest.scalar())
        left_shorter = self._keys(shorter, "lc").join(self._side(self.tokens), "tok").where("length(lc) < length(rc)").select("lc", "rc")
        # a pair within the band has a left text of at most the longest right one's partner
        near = tokens.where((self.den - self.num) * F.length("lc") <= (self.den + self.num) * self.longest.scalar())
        near = near.selectExpr("lc", "tok", f"explode(sequence({self._length_class('length(lc)')} - 1, {self._length_class('length(lc)')} + 1)) AS _class")
        alike = near.join(self._side(self.tokens.selectExpr("rc", "tok", f"{self._length_class('length(rc)')} AS _class")), ["tok", "_class"])
        lo, hi = self.band("length(lc)")
        alike = alike.where(f"length(rc) BETWEEN {lo} AND {hi} AND {self._enough_characters()}").select("lc", "rc")
        return right_shorter.unionByName(left_shorter).unionByName(alike)

    def no_shared_token_pairs(self, lc: DataFrame) -> DataFrame:
        """(b): candidates that can reach the threshold on ``ratio(lc, rc)`` alone."""
        # both sides are many times the rows that Spark sizes them by: not to be broadcast
        short = (self._deletions(lc, "lc", "_la", "_lb").hint("merge").join(self.deletions, ["_la", "_lb", VARIANT])
                 .select("lc", "rc"))
        probe = probe_segments(lc, "lc", self.lengths, self.band, self.tau,
                               min_pair_len=SHORT + 1).select(SEG_LEN, SEG_NO, SEG_TXT, "lc")
        long = probe.join(self._side(self.segments), [SEG_LEN, SEG_NO, SEG_TXT]).select("lc", "rc").where(self._enough_characters())
        return short.unionByName(long).distinct()

    def join(self, left: DataFrame, left_key: str, left_text: str,
             left_out: str | None = None, right_out: str | None = None, how: str = "inner") -> DataFrame:
        """``how``: ``inner``; ``left`` (unmatched left keys with null key and score); ``left_semi`` /
        ``left_anti``: the left rows with / without a match."""
        if how != "inner":
            if how not in ("left", "left_semi", "left_anti"):
                raise ValueError(f"how: {how}")
            mine = left_out or left_key
            found = self.join(left, left_key, left_text, left_out, right_out)
            keys = join_side(found.select(F.col(mine).alias("_hit")).distinct())
            if how != "left":
                return left.join(keys, F.col(left_key) == F.col("_hit"), how)
            rest = left.join(keys, F.col(left_key) == F.col("_hit"), "left_anti").select(
                F.col(left_key).alias(mine), *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in found.columns[1:]])
            return found.unionByName(rest)
        lrows = _canonical(left.select(left_key, left_text), left_text, "lc").where(F.length("lc") > 0)
        # both staged: either is read several times, and the driver holds the text of every plan, with all that it repeats
        lc = stage_table(lrows.select("lc").distinct(), "addresses")
        cand = stage_table(self.shared_token_pairs(lc).unionByName(self.no_shared_token_pairs(lc)).distinct(), "address-pairs")
        scored = score_pairs(cand, self.threshold)
        out = lrows.select(left_key, "lc").join(join_side(scored), "lc").join(self._side(self.rows), "rc")
        return out.select(F.col(left_key).alias(left_out or left_key),
                          F.col(self.key).alias(right_out or self.key), "score")


def _ratio_sql(lcs: str, la: str, lb: str) -> str:
    """round_half_even(200 * lcs / (la + lb)), 0 when either side is empty."""
    return f"CASE WHEN {la} = 0 OR {lb} = 0 THEN 0 ELSE CAST(bround(200.0 * {lcs} / ({la} + {lb}), 0) AS INT) END"


def score_pairs(pairs: DataFrame, threshold: int | None = None) -> DataFrame:
    """Exact ``token_set_ratio`` for distinct ``(lc, rc)`` canonical token strings."""
    df = pairs.selectExpr(
        "lc", "rc",
        "array_join(array_sort(array_intersect(split(lc, ' '), split(rc, ' '))), ' ') AS _t0",
        "array_join(array_sort(array_except(split(lc, ' '), split(rc, ' '))), ' ') AS _sab",
        "array_join(array_sort(array_except(split(rc, ' '), split(lc, ' '))), ' ') AS _sba")
    df = df.selectExpr("*", "trim(concat_ws(' ', _t0, _sab)) AS _t1", "trim(concat_ws(' ', _t0, _sba)) AS _t2")
    df = df.selectExpr(
        "*",
        # t0 is a prefix of t1 and t2: LCS = |t0|
        f"greatest({_ratio_sql('length(_t0)', 'length(_t0)', 'length(_t1)')}, "
        f"{_ratio_sql('length(_t0)', 'length(_t0)', 'length(_t2)')}) AS _closed",
        "CAST(bround(200.0 * least(length(_t1), length(_t2)) / (length(_t1) + length(_t2)), 0) AS INT) AS _upper12")
    df = df.selectExpr("*", "length(_sab) > 0 AND length(_sba) > 0 AND _upper12 > _closed AS _need")
    if threshold is not None:
        df = df.where(f"_closed >= {threshold} OR (_need AND _upper12 >= {threshold})")
    # Python only for rows that need an LCS (UDFs are evaluated for every input row)
    need = df.where("_need").withColumn("_lcs_d", lcs_length(F.col("_sab"), F.col("_sba")))
    rest = df.where("NOT _need").selectExpr("*", "CAST(NULL AS INT) AS _lcs_d")
    # LCS(t1, t2) = |t0 + ' '| + LCS(s_ab, s_ba) when t0 is not empty
    lcs12 = "(IF(length(_t0) > 0, length(_t0) + 1, 0) + _lcs_d)"
    scored = need.unionByName(rest).selectExpr(
        "lc", "rc",
        f"greatest(_closed, IF(_need, {_ratio_sql(lcs12, 'length(_t1)', 'length(_t2)')}, 0)) AS score")
    if threshold is not None:
        scored = scored.where(f"score >= {threshold}")
    return scored


def token_set_join(left: DataFrame, right: DataFrame, left_key: str, left_text: str,
                   right_key: str, right_text: str, threshold: int = C.ADDRESS_THRESHOLD,
                   left_out: str | None = None, right_out: str | None = None, how: str = "inner") -> DataFrame:
    """``(left_key, right_key, score)`` for every pair with score >= threshold.

    Bag semantics: duplicate right rows give duplicate output rows.  Null or
    blank texts (no tokens) never match.
    """
    return TokenSetIndex(right, right_key, right_text, threshold).join(left, left_key, left_text, left_out, right_out, how)


def contained_join(left: DataFrame, right: DataFrame, left_key: str, left_text: str,
                   right_key: str, right_text: str, right_out: str | None = None) -> DataFrame:
    """Pairs whose right token set lies inside the left one (score 100 by
    containment, no LCS): shared-token equi-join, count per pair = |B|."""
    lrows = _canonical(left.select(left_key, left_text), left_text, "lc").where(F.length("lc") > 0)
    rrows = _canonical(right.select(right_key, right_text), right_text, "rc").where(F.length("rc") > 0)
    lt = lrows.select("lc").distinct().select("lc", F.explode(F.split("lc", " ")).alias("tok"))
    rt = (rrows.select("rc").distinct()
               .select("rc", F.size(F.split("rc", " ")).alias("_nb"), F.explode(F.split("rc", " ")).alias("tok")))
    pairs = (lt.join(rt, "tok").groupBy("lc", "rc", "_nb").agg(F.count(F.lit(1)).alias("_shared"))
               .where(F.col("_shared") == F.col("_nb")).select("lc", "rc"))
    out = lrows.select(left_key, "lc").join(pairs, "lc").join(rrows.select(right_key, "rc"), "rc")
    return out.select(left_key, F.col(right_key).alias(right_out or right_key))

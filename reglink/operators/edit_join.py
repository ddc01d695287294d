"""Fuzzy join on normalised Levenshtein similarity, without a cross product.

``edit_pairs`` works on *distinct* key values: names repeat heavily in a
register, so candidate generation and verification run once per distinct
pair of values and the rows are attached afterwards by plain equi-joins
(which keeps bag multiplicity).  A threshold of 1.0 short-circuits to an
equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reglink.functions.similarity import damerau_distance, edit_within, threshold_fraction
from reglink.operators.segments import SEG_LEN, SEG_NO, SEG_TXT, index_segments, probe_segments
from reglink.operators.semi_filter import might_hold
from reglink.session import join_side, stage_table

MIN_THRESHOLD = 0.6  # below this segments get too short for the filter to prune
MIN_DAMERAU_THRESHOLD = 0.67  # an edit spoils two segments: below 2/3 there are more segments than characters
VARIANT = "_var"
TWO_DELETIONS = 32   # longest string with two deletions: some 500 variants
METHOD = "deletions-2"    # of the index tables; those stored by another method are not probed


def deletion_variants_sql(x: str, from_len: int = 1, two_from: int | None = None) -> str:
    """SQL: the string itself; from ``from_len`` characters on, also every string with one char deleted; from
    ``two_from`` on, also every string with two.

    A pair with an edit has its longer string at ``from_len`` at least; a shorter one is then
    that string with one char deleted, so it needs no variants of its own.  Likewise with two."""
    one = f"transform(sequence(0, length({x})), i -> IF(i = 0, {x}, concat(substr({x}, 1, i - 1), substr({x}, i + 1))))"
    some = f"array_distinct({one})"
    if two_from is not None:
        two = (f"flatten(transform(sequence(1, length({x}) - 1), i -> transform(sequence(i + 1, length({x})), "
               f"j -> concat(substr({x}, 1, i - 1), substr({x}, i + 1, j - i - 1), substr({x}, j + 1)))))")
        some = f"IF(length({x}) < {max(two_from, 2)}, {some}, array_distinct(concat({one}, {two})))"
    return f"IF(length({x}) < {from_len}, array({x}), {some})"


class EditIndex:
    """Index side of an edit join over the distinct right values, built once
    and probed many times (every micro-batch of a stream, every run when
    saved as bucketed tables).

    Two exact candidate generators, split by the pair's edit budget
    ``floor((q-p) * max(len) / q)``:

    * budget <= 2 (every pair whose longer string is shorter than
      ``long_from``; at 0.9 that is under 30 chars, i.e. nearly all names): the
      deletion neighbourhood.  Two strings within ``k`` edits -- or adjacent
      swaps -- share a string that each of them leaves after at most ``k``
      deletions, so candidates are an equi-join on the variant.  Long shared
      prefixes do not inflate it.  (Budget 2 only where such strings are short
      enough to have few variants.)
    * above: the segment filter (Pass-Join), probed only for length
      pairs whose longer side reaches ``long_from``.
    """

    METRICS = ("levenshtein", "damerau")

    def __init__(self, right_values: DataFrame, threshold: float, b: str = "b", metric: str = "levenshtein"):
        if metric not in self.METRICS:
            raise ValueError(f"metric must be one of {self.METRICS}")
        self.p, self.q = threshold_fraction(threshold)
        self.threshold = threshold
        self.b = b
        self.metric = metric
        # an adjacent swap across a segment boundary spoils two segments
        self.per_edit = 2 if metric == "damerau" else 1
        self.values = right_values.select(b).where(F.length(b) > 0).distinct()
        self.segments = self.lengths = self.variants = None
        if self.p == self.q:
            return
        least = MIN_THRESHOLD if self.per_edit == 1 else MIN_DAMERAU_THRESHOLD
        if threshold < least:
            raise ValueError(f"{metric} threshold {threshold} < {least}: segments would be empty")
        p, q = self.p, self.q
        self.variants = self._variants(self.values, b)
        # segments only for strings that can have a partner at least long_from long
        min_indexed = -(-p * self.long_from // q)
        longish = self.values.where(F.length(b) >= min_indexed)
        self.segments = index_segments(longish, b, self.tau, self.per_edit).select(SEG_LEN, SEG_NO, SEG_TXT, b)
        self.lengths = longish.select(F.length(b).alias(SEG_LEN)).distinct()

    def _edits_from(self, n: int) -> int:
        """Length of the longer string from which on ``n`` edits are allowed."""
        return -(-n * self.q // (self.q - self.p))

    @property
    def edit_from(self) -> int:
        return self._edits_from(1)

    @property
    def two_deletions(self) -> bool:
        return self._edits_from(3) - 1 <= TWO_DELETIONS

    @property
    def long_from(self) -> int:
        """Length of the longer string from which on pairs are left to the segments."""
        return self._edits_from(3 if self.two_deletions else 2)

    def _variants(self, values: DataFrame, x: str) -> DataFrame:
        gen = deletion_variants_sql(f"`{x}`", self.edit_from, self._edits_from(2) if self.two_deletions else None)
        return values.where(F.length(x) < self.long_from).selectExpr(f"`{x}`", f"explode({gen}) AS {VARIANT}")

    def tau(self, L: str) -> str:
        # the largest budget any partner of a length-L string can have
        return f"floor({self.q - self.p} * {L} / {self.p})"

    def band(self, l: str) -> tuple[str, str]:
        p, q = self.p, self.q
        return f"CAST(ceil({p} * {l} / {q}) AS INT)", f"CAST(floor({q} * {l} / {p}) AS INT)"

    def persist(self) -> "EditIndex":
        """Reliable checkpoint (shared checkpoint dir) of the index tables."""
        self.values = self.values.checkpoint()
        if self.segments is not None:
            self.segments = self.segments.checkpoint()
            self.lengths = self.lengths.checkpoint()
            self.variants = self.variants.checkpoint()
        return self

    @classmethod
    def from_tables(cls, values: DataFrame, segments: DataFrame, variants: DataFrame, lengths: DataFrame,
                    threshold: float, b: str = "b", metric: str = "levenshtein") -> "EditIndex":
        """An index over already written tables (see ``save_bucketed``)."""
        ix = cls.__new__(cls)
        ix.p, ix.q = threshold_fraction(threshold)
        ix.threshold, ix.b, ix.metric = threshold, b, metric
        ix.per_edit = 2 if metric == "damerau" else 1
        ix.values, ix.segments, ix.variants, ix.lengths = values, segments, variants, lengths
        return ix

    def save_bucketed(self, table: str, path: str, buckets: int) -> "EditIndex":
        """Write the index as bucketed tables under ``path`` (shared storage),
        each bucketed on its join key, so a later probe shuffles only its own
        side into the same buckets.  Returns an index reading them."""
        spark = self.values.sparkSession
        _save_bucketed(self.values, f"{table}_values", f"{path}/values", buckets, [self.b])
        self.values = spark.table(f"{table}_values")
        if self.segments is not None:
            _save_bucketed(self.segments, f"{table}_segments", f"{path}/segments", buckets,
                           [SEG_LEN, SEG_NO, SEG_TXT])
            _save_bucketed(self.variants, f"{table}_variants", f"{path}/variants", buckets, [VARIANT])
            self.lengths.write.mode("overwrite").parquet(f"{path}/lengths")
            self.segments = spark.table(f"{table}_segments")
            self.variants = spark.table(f"{table}_variants")
            self.lengths = spark.read.parquet(f"{path}/lengths")
        return self

    def candidates(self, left_values: DataFrame, a: str, reduce: bool = False, few: bool = False) -> DataFrame:
        """Unverified ``(a, b)`` candidates (with repeats) from both generators.  ``reduce``: cut the index down to the
        keys that the left values may probe before it is shuffled.  ``few``: send the left keys to the index.

        Spark sizes an exploded side by the rows before the explode, so the join is named: left to that size, the
        whole index would be broadcast through the driver, and AQE doesn't take a broadcast back."""
        b = self.b
        mine = self._variants(left_values, a)
        probe = probe_segments(left_values, a, self.lengths, self.band, self.tau, self.per_edit,
                               min_pair_len=self.long_from).select(SEG_LEN, SEG_NO, SEG_TXT, a)
        variants, segments, seg = self.variants, self.segments, [SEG_LEN, SEG_NO, SEG_TXT]
        if reduce:
            probe = stage_table(probe, "segment-probes")
            n = mine.count()
            variants, segments = might_hold(variants, mine, [VARIANT], n), might_hold(segments, probe, seg, probe.count())
        how = "broadcast" if few else "merge"
        short = variants.join(mine.hint(how), VARIANT).select(a, b)
        long = segments.join(probe.hint(how), seg).select(a, b)
        return short.unionByName(long)

    def probe(self, left_values: DataFrame, a: str = "a", reduce: bool = False, few: bool = False) -> DataFrame:
        """Distinct verified ``(a, b)`` pairs for the left values."""
        b = self.b
        left_values = left_values.select(a).where(F.length(a) > 0).distinct()
        if self.segments is None:
            return left_values.hint("broadcast" if few else "merge").join(self.values, F.col(a) == F.col(b)).select(a, b)
        if reduce:
            left_values = stage_table(left_values, "probe-values")
        cand = self.candidates(left_values, a, reduce, few)
        if self.metric == "damerau":
            return self._verify_damerau(cand, a, b)
        # Verify before deduplicating: a pair found several times is verified
        # several times, but the candidate set is never shuffled again.
        return cand.where(edit_within(a, b, self.threshold)).select(a, b).distinct()

    def _verify_damerau(self, cand: DataFrame, a: str, b: str) -> DataFrame:
        """Damerau <= Levenshtein <= 2 * Damerau: Levenshtein decides most
        pairs in the JVM; the Arrow UDF sees only ``budget < lev <= 2*budget``."""
        p, q = self.p, self.q
        m = f"greatest(length(`{a}`), length(`{b}`))"
        budget = f"floor({q - p} * {m} / {q})"
        # banded Levenshtein up to 2*budget inside the join condition (-1 beyond)
        banded = " ".join(f"WHEN {budget} = {k} THEN levenshtein(`{a}`, `{b}`, {2 * k})" for k in range(1, 5))
        lev2 = (f"CASE WHEN {budget} = 0 THEN IF(`{a}` = `{b}`, 0, -1) {banded} "
                f"ELSE IF(levenshtein(`{a}`, `{b}`) <= 2 * {budget}, levenshtein(`{a}`, `{b}`), -1) END")
        pairs = (cand.where(f"length(`{a}`) > 0 AND length(`{b}`) > 0 AND ({lev2}) >= 0")
                     .select(a, b).distinct()
                     .selectExpr(a, b, f"levenshtein(`{a}`, `{b}`) <= {budget} AS _sure", f"{budget} AS _budget"))
        sure = pairs.where("_sure").select(a, b)
        # budget 1 (every string under 2/(1-t) chars): Damerau 1 with
        # Levenshtein 2 is exactly one adjacent swap at the first mismatch
        first = f"array_position(zip_with(split(`{a}`, ''), split(`{b}`, ''), (x, y) -> x = y), false)"
        one_swap = (f"length(`{a}`) = length(`{b}`) AND {first} > 0 AND {first} < length(`{a}`) "
                    f"AND substr(`{a}`, {first}, 1) = substr(`{b}`, {first} + 1, 1) "
                    f"AND substr(`{a}`, {first} + 1, 1) = substr(`{b}`, {first}, 1) "
                    f"AND substr(`{a}`, {first} + 2) = substr(`{b}`, {first} + 2)")
        swap1 = pairs.where(f"NOT _sure AND _budget = 1 AND {one_swap}").select(a, b)
        # larger budgets: the Arrow UDF on the remaining band only
        maybe = pairs.where("NOT _sure AND _budget > 1").withColumn("_d", damerau_distance(F.col(a), F.col(b)))
        return sure.unionByName(swap1).unionByName(maybe.where("_d <= _budget").select(a, b))


def edit_pairs(left_values: DataFrame, right_values: DataFrame, threshold: float,
               a: str = "a", b: str = "b", metric: str = "levenshtein") -> DataFrame:
    """Distinct ``(a, b)`` with ``edit_similarity(a, b) >= threshold``.

    ``left_values``/``right_values`` hold one string column each (``a``/``b``);
    null and blank values never match.
    """
    return EditIndex(right_values, threshold, b, metric).probe(left_values, a)


def edit_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, threshold: float,
              keep_left: list[str] | None = None, keep_right: list[str] | None = None,
              how: str = "inner", ignore_case: bool = False) -> DataFrame:
    """All (left row, right row) whose keys are ``threshold``-similar.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``;
    ``ignore_case`` compares lower-cased keys.  Column names of the two
    sides must not clash (use ``keep_*`` to project).
    """
    keep_left = keep_left or left.columns
    keep_right = keep_right or right.columns
    case = F.lower if ignore_case else (lambda c: c)
    l_key, r_key = case(F.col(left_on)), case(F.col(right_on))
    pairs = edit_pairs(left.select(l_key.alias("_a")), right.select(r_key.alias("_b")), threshold, "_a", "_b")
    if how in ("left_semi", "left_anti"):
        return left.join(join_side(pairs.select("_a").distinct()), l_key == F.col("_a"), how).select(*keep_left)
    l = left.select(*{*keep_left, left_on})
    r = right.select(*{*keep_right, right_on})
    matched = l.join(join_side(pairs), l_key == F.col("_a"), "left" if how == "left" else "inner")
    out = matched.join(join_side(r), F.col("_b") == r_key, "left" if how == "left" else "inner")
    return out.select(*keep_left, *keep_right)


def by_bucket(df: DataFrame, buckets: int, cols: list[str]) -> DataFrame:
    """Rows of a bucket together, so that a bucket is one file rather than one of every task (with many buckets, tasks
    times buckets files).  A rebalance, as a common name's bucket may be far the longest: AQE splits it among tasks."""
    return df.hint("rebalance", buckets, *(F.col(c) for c in cols))


def _save_bucketed(df: DataFrame, table: str, path: str, buckets: int, cols: list[str]) -> None:
    """Bucketed parquet table at an explicit (shared) location."""
    (by_bucket(df, buckets, cols).write.mode("overwrite").format("parquet").bucketBy(buckets, *cols).sortBy(*cols)
       .option("path", path).saveAsTable(table))


def register_bucketed(spark, table: str, path: str, ddl: str, buckets: int, cols: list[str]):
    """Re-register a bucketed table written by :func:`_save_bucketed` (a new
    session whose catalog does not know it): external table, same layout.
    An entry of the same name goes first (its files stay)."""
    keys = ", ".join(f"`{c}`" for c in cols)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)

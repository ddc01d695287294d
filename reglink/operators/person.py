"""Person evidence: pending records against the register.

* two-key branch (pending father not blank): name similarity >= t and
  father similarity >= t.
  - ``correlated`` (default, the evident intent): both keys of the same pair.
  - ``chained`` (the letter of the reference): per chunk, first the register
    rows whose name matched *any* pending row of the chunk (one copy per
    name match), then every pending row of the chunk against those copies on
    the father's name alone.  Bag semantics, chunk-dependent.
* name-only branch (pending father blank): exact equality of cleaned names.

All fuzzy work runs on distinct key values (``edit_pairs``); rows are
attached afterwards by equi-joins.  Null or blank keys never match.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reglink import constants as C
from reglink.functions.clean import clean_name
from reglink.operators.edit_join import METHOD, EditIndex
from reglink.operators.semi_filter import might_hold
from reglink.session import join_side, stage_table

PERSON_COLUMNS = ["death_main_id", "rc_no", "rc_name", "rc_father_name",
                  "rc_blockmunicipalitycode", "rc_category", "district"]

BLANK_POLICIES = ("null_is_blank", "strict")
REDUCE_RATIO = 8           # register keys a pending row from which on the register is cut down first
REDUCE_FROM = 1 << 16      # below, its shuffles are not worth the extra pass
FEW = 4096                 # pending rows (a small batch of a stream) whose keys are sent to a stored index


def prepare_pending(pending: DataFrame, blank_policy: str = "null_is_blank") -> DataFrame:
    """Clean both names once and flag the name-only rows.

    ``null_is_blank``: a missing father's name counts as blank (intent);
    ``strict``: only a father's name that *cleans to* '' does (the letter).
    """
    if blank_policy not in BLANK_POLICIES:
        raise ValueError(f"blank_policy must be one of {BLANK_POLICIES}")
    cf = clean_name("DEATH_FATHER_NAME")
    name_only = (cf == "") | cf.isNull() if blank_policy == "null_is_blank" else F.coalesce(cf == "", F.lit(False))
    keep = [c for c in pending.columns if c in ("death_main_id", "chunk_id")]
    return pending.select(*keep, clean_name("DEATH_DECEASED_NAME").alias("p_name"),
                          cf.alias("p_father"), name_only.alias("name_only"))


def prepare_register(register: DataFrame) -> DataFrame:
    return register.select(
        F.col("PERMANENT_RCNO").alias("rc_no"),
        F.col("NAME").alias("rc_name"),
        F.col("FATHERNAME").alias("rc_father_name"),
        F.col("BlockMunicipalityCode").alias("rc_blockmunicipalitycode"),
        F.col("RCCATEGORY").alias("rc_category"),
        (F.col("district") if "district" in register.columns else F.lit(None).cast("string")).alias("district"),
        clean_name(F.coalesce("NAME", F.lit(""))).alias("r_name"),
        clean_name(F.coalesce("FATHERNAME", F.lit(""))).alias("r_father"),
    )


class RegisterSide:
    """The register side of person matching, prepared once: cleaned rows,
    the two-key subset and the edit indexes of its distinct names and
    fathers.  ``persist`` checkpoints the indexes (for streams, where every
    micro-batch probes the same register)."""

    def __init__(self, r: DataFrame, threshold: float = C.NAME_THRESHOLD, metric: str = "levenshtein"):
        self.threshold, self.metric, self.stored = threshold, metric, False
        self.rows = r
        # Register rows without a father's name leave the two-key branch
        self.two_key = r.where((F.length("r_name") > 0) & (F.length("r_father") > 0))

    @cached_property
    def keys(self) -> DataFrame:
        """Distinct (r_name, r_father), staged at their first use: one pass over the register, from which
        both indexes and the existing key pairs come."""
        return stage_table(self.two_key.select("r_name", "r_father").distinct(), "register-keys")

    @cached_property
    def names(self) -> EditIndex:
        return EditIndex(self.keys.select(F.col("r_name").alias("b")), self.threshold, metric=self.metric)

    @cached_property
    def fathers(self) -> EditIndex:
        return EditIndex(self.keys.select(F.col("r_father").alias("b")), self.threshold, metric=self.metric)

    @cached_property
    def n_keys(self) -> int:
        return self.keys.count()

    def outweighs(self, p2: DataFrame) -> bool:
        """Whether the pending side is worth a pass of its own to cut this side down before its shuffles.  Stored
        indexes are not shuffled."""
        return not self.stored and self.n_keys >= REDUCE_FROM and self.n_keys >= REDUCE_RATIO * p2.count()

    def probed_by_few(self, p2: DataFrame) -> bool:
        """Whether the pending side goes to the stored indexes whole, so that they are not shuffled for it."""
        return self.stored and p2.limit(FEW + 1).count() <= FEW

    def persist(self) -> "RegisterSide":
        """Store rows and indexes in the shared checkpoint folder, once."""
        if not self.stored:
            self.rows, self.two_key = self.rows.checkpoint(), self.two_key.checkpoint()
            self.names.persist()
            self.fathers.persist()
            self.stored = True
        return self

    def fingerprint(self) -> str:
        """Identity of what the side was built from: register content, threshold and metric."""
        cols = sorted(self.rows.columns)
        n, x, y = self.rows.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*cols)),
                                F.sum(F.hash(*cols).cast("long"))).first()
        return f"{n}/{x}/{y}/{','.join(cols)}/{self.threshold}/{self.metric}/{METHOD}"

    def save_bucketed(self, table: str, path: str, buckets: int) -> "RegisterSide":
        """Persist the prepared register for repeated runs: rows bucketed on
        the cleaned name (name-only join), two-key rows on (name, father)
        (final join), edit indexes on their segment keys.  Each later run
        then shuffles only the pending side; the register is read in place."""
        from reglink.operators.edit_join import _save_bucketed
        spark = self.rows.sparkSession
        print_of = self.fingerprint()
        _save_bucketed(self.rows, f"{table}_rows", f"{path}/rows", buckets, ["r_name"])
        _save_bucketed(self.two_key, f"{table}_two_key", f"{path}/two_key", buckets, ["r_name", "r_father"])
        self.rows = spark.table(f"{table}_rows")
        self.two_key = spark.table(f"{table}_two_key")
        self.names.save_bucketed(f"{table}_names", f"{path}/names", buckets)
        self.fathers.save_bucketed(f"{table}_fathers", f"{path}/fathers", buckets)
        # manifest (written with Spark, so it lives wherever ``path`` does)
        entries = [("rows", ["r_name"], self.rows), ("two_key", ["r_name", "r_father"], self.two_key)]
        for part, ix in (("names", self.names), ("fathers", self.fathers)):
            entries += [(f"{part}/values", ["b"], ix.values)]
            if ix.segments is not None:
                entries += [(f"{part}/segments", ["_seg_L", "_seg_i", "_seg_txt"], ix.segments),
                            (f"{part}/variants", ["_var"], ix.variants)]
        manifest = [(name, ",".join(cols), buckets, df.schema.toDDL(), float(self.threshold), self.metric, print_of, METHOD)
                    for name, cols, df in entries]
        spark.createDataFrame(manifest, "part string, cols string, buckets int, ddl string, "
                                        "threshold double, metric string, fingerprint string, method string") \
             .coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")
        self.stored = True
        return self

    @classmethod
    def load_bucketed(cls, spark, path: str, table: str, expect: str | None = None) -> "RegisterSide | None":
        """Attach a register side saved by ``save_bucketed`` (e.g. by an earlier
        run in another process): tables are re-registered over the same files,
        nothing is recomputed or shuffled.  ``expect``: the fingerprint it must
        have; None when it was built from something else, or by another method."""
        from reglink.operators.edit_join import EditIndex, register_bucketed
        rows = {r.part: r for r in spark.read.json(f"{path}/_manifest").collect()}  # a few rows
        first = next(iter(rows.values()))
        if getattr(first, "method", None) != METHOD or expect is not None and getattr(first, "fingerprint", None) != expect:
            return None

        def tbl(part):
            r = rows[part]
            return register_bucketed(spark, f"{table}_{part.replace('/', '_')}", f"{path}/{part}",
                                     r.ddl, r.buckets, r.cols.split(","))

        side = cls.__new__(cls)
        side.threshold, side.metric, side.stored = first.threshold, first.metric, True
        side.rows, side.two_key = tbl("rows"), tbl("two_key")
        side.keys = side.two_key.select("r_name", "r_father").distinct()
        for part in ("names", "fathers"):
            has_index = f"{part}/segments" in rows
            ix = EditIndex.from_tables(
                tbl(f"{part}/values"),
                tbl(f"{part}/segments") if has_index else None,
                tbl(f"{part}/variants") if has_index else None,
                spark.read.parquet(f"{path}/{part}/lengths") if has_index else None,
                first.threshold, metric=first.metric)
            setattr(side, part, ix)
        return side


def _side(r, threshold: float) -> RegisterSide:
    return r if isinstance(r, RegisterSide) else RegisterSide(r, threshold)


def _two_key_pending(p: DataFrame) -> DataFrame:
    return p.where(~F.col("name_only") & (F.length("p_name") > 0) & (F.length("p_father") > 0))


def name_pairs(p2: DataFrame, side: RegisterSide) -> DataFrame:
    return side.names.probe(p2.select(F.col("p_name").alias("a")), reduce=side.outweighs(p2), few=side.probed_by_few(p2)) \
        .select(F.col("a").alias("p_name"), F.col("b").alias("r_name"))


def father_pairs(p2: DataFrame, side: RegisterSide) -> DataFrame:
    return side.fathers.probe(p2.select(F.col("p_father").alias("a")), reduce=side.outweighs(p2), few=side.probed_by_few(p2)) \
        .select(F.col("a").alias("p_father"), F.col("b").alias("r_father"))


def name_match(p: DataFrame, r, threshold: float = C.NAME_THRESHOLD) -> DataFrame:
    """J3 alone: two-key pending rows x register rows with similar names."""
    side = _side(r, threshold)
    p2 = _two_key_pending(p)
    return (p2.select("death_main_id", "p_name").join(join_side(name_pairs(p2, side)), "p_name")
              .join(join_side(side.two_key), "r_name").select(*PERSON_COLUMNS))


def two_key_correlated(p: DataFrame, r, threshold: float = C.NAME_THRESHOLD) -> DataFrame:
    """J3 + J4 correlated: name and father of the same pair both >= threshold."""
    side = _side(r, threshold)
    p2 = _two_key_pending(p)
    keys, cards = two_key_candidates(p2, side), side.two_key
    reduce = side.outweighs(p2)
    if reduce or side.stored:       # a stream's batches each plan this anew: two short plans hold less of the driver than one
        keys = stage_table(keys, "two-key-pairs")
    if reduce:
        cards = might_hold(cards, keys, ["r_name", "r_father"], keys.count())
    rows = p2.select("death_main_id", "p_name", "p_father").join(join_side(keys), ["p_name", "p_father"])
    return rows.join(join_side(cards), ["r_name", "r_father"]).select(*PERSON_COLUMNS)


HEAVY = 4096      # cards that one pending key may reach before its expansion is salted
SALTS = 64


def similar_cards(side: RegisterSide, names: DataFrame, fathers: DataFrame, reduce: bool = False) -> DataFrame:
    """Existing (r_name, r_father) of which each is similar to some pending one."""
    keys = might_hold(side.keys, names, ["r_name"], names.count()) if reduce else side.keys
    return (keys.join(join_side(names.select("r_name").distinct()), "r_name", "left_semi")
            .join(join_side(fathers.select("r_father").distinct(), fathers.count()), "r_father", "left_semi"))


def key_degrees(p2: DataFrame, cards: DataFrame, names: DataFrame, fathers: DataFrame) -> DataFrame:
    """(p_name, p_father, by_name, by_father): how many cards each distinct pending key reaches by its name, and by
    its father's; keys that reach none by either are left out."""
    def reach(pairs: DataFrame, mine: str, theirs: str, out: str) -> DataFrame:
        held = cards.groupBy(theirs).agg(F.count(F.lit(1)).alias("_n"))
        return pairs.join(join_side(held), theirs).groupBy(mine).agg(F.sum("_n").alias(out))

    keys = p2.select("p_name", "p_father").distinct()
    return (keys.join(join_side(reach(names, "p_name", "r_name", "by_name")), "p_name")
            .join(join_side(reach(fathers, "p_father", "r_father", "by_father"), fathers.count()), "p_father"))


def _expand(keys: DataFrame, pairs: DataFrame, mine: str, theirs: str, cards: DataFrame, reach: str, salted: bool) -> DataFrame:
    """Pending keys with every card that they reach through ``pairs``.  A key that reaches more than ``HEAVY``
    cards is copied once a salt, and the cards are dealt over the salts, so one popular value is many tasks."""
    n = None if theirs == "r_name" else pairs.count()       # names are nearly as many as cards; fathers may be few and popular
    held = pairs.join(join_side(cards.select(theirs).distinct()), theirs, "left_semi")
    rows = keys.join(join_side(held, n), mine)
    out = rows.where(F.col(reach) <= HEAVY).join(join_side(cards), theirs)
    if salted:
        dealt = cards.withColumn("_salt", F.pmod(F.xxhash64("r_name", "r_father"), F.lit(SALTS)).cast("int"))
        copies = rows.where(F.col(reach) > HEAVY).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = out.unionByName(copies.join(join_side(dealt), [theirs, "_salt"]).drop("_salt"))
    return out.select("p_name", "p_father", "r_name", "r_father")


def lighter_expansions(p2: DataFrame, side: RegisterSide, names: DataFrame, fathers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates of the keys that reach fewer cards by name, and of those that reach fewer by father.

    Each pending key is expanded on its lighter side only: a popular name with rare fathers goes by the fathers, a popular
    father by the names, so rows are at most the sum of the lesser degrees.  The other side is still to be checked."""
    cards = stage_table(similar_cards(side, names, fathers, side.outweighs(p2)), "similar-cards")
    keys = stage_table(key_degrees(p2, cards, names, fathers), "pending-degrees")
    most = keys.agg(F.max(F.least("by_name", "by_father")).alias("n")).first()["n"] or 0
    by_name = _expand(keys.where("by_name <= by_father"), names, "p_name", "r_name", cards, "by_name", most > HEAVY)
    by_father = _expand(keys.where("by_name > by_father"), fathers, "p_father", "r_father", cards, "by_father", most > HEAVY)
    return by_name, by_father


def existing_keys(p2: DataFrame, side: RegisterSide, names: DataFrame, fathers: DataFrame) -> DataFrame:
    """All rows that ``two_key_candidates`` checks: pending keys with the cards of their lighter side."""
    by_name, by_father = lighter_expansions(p2, side, names, fathers)
    return by_name.unionByName(by_father)


def two_key_candidates(p2: DataFrame, side: RegisterSide) -> DataFrame:
    """Distinct ``(p_name, p_father, r_name, r_father)`` with both keys similar."""
    names, fathers = stage_table(name_pairs(p2, side), "name-pairs"), stage_table(father_pairs(p2, side), "father-pairs")
    by_name, by_father = lighter_expansions(p2, side, names, fathers)
    return (by_name.join(join_side(fathers, fathers.count()), ["p_father", "r_father"])
            .unionByName(by_father.join(join_side(names), ["p_name", "r_name"])))


def two_key_chained(p: DataFrame, r, threshold: float = C.NAME_THRESHOLD) -> DataFrame:
    """J3 + J4 chained, per chunk (``p`` needs ``chunk_id``); bag semantics."""
    side = _side(r, threshold)
    p2 = _two_key_pending(p)
    reg_cols = [c for c in PERSON_COLUMNS if c != "death_main_id"]
    # m: one copy of a register row per pending row of the chunk whose name
    # matched it, kept as a count (pre-aggregated before the second join)
    m = (p2.select("chunk_id", "p_name").join(join_side(name_pairs(p2, side)), "p_name")
           .join(join_side(side.two_key), "r_name")
           .groupBy("chunk_id", "r_father", *reg_cols).agg(F.count(F.lit(1)).alias("_mult")))
    out = (p2.select("chunk_id", "death_main_id", "p_father").join(join_side(father_pairs(p2, side)), "p_father")
             .join(join_side(m), ["chunk_id", "r_father"]))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_mult").cast("int")))) \
              .select(*PERSON_COLUMNS)


def name_only_match(p: DataFrame, r) -> DataFrame:
    """Blank-father rows, equal cleaned names (threshold 1.0 -> hash join)."""
    rows = r.rows if isinstance(r, RegisterSide) else r
    p1 = p.where(F.col("name_only") & (F.length("p_name") > 0)).select("death_main_id", F.col("p_name").alias("r_name"))
    r1 = rows.where(F.length("r_name") > 0)
    if isinstance(r, RegisterSide) and r.outweighs(p):
        r1 = might_hold(r1, p1, ["r_name"], p1.count())
    return p1.join(join_side(r1), "r_name").select(*PERSON_COLUMNS)


def person_evidence(p: DataFrame, r, threshold: float = C.NAME_THRESHOLD, mode: str = "correlated") -> DataFrame:
    """Both branches in one output with a ``branch`` column."""
    r = _side(r, threshold)
    if mode == "correlated":
        two = two_key_correlated(p, r, threshold)
    elif mode == "chained":
        two = two_key_chained(p, r, threshold)
    else:
        raise ValueError("mode must be 'correlated' or 'chained'")
    return (two.withColumn("branch", F.lit("name_father"))
               .unionByName(name_only_match(p, r).withColumn("branch", F.lit("name_only"))))


def unmatched(pending: DataFrame, evidence: DataFrame, key: str = "death_main_id") -> DataFrame:
    """Pending ids without any evidence row (left anti join).  Evidence ids
    are deduplicated first (map-side), so a record with very many candidates
    is one row on the build side."""
    return pending.select(key).join(join_side(evidence.select(key).distinct()), key, "left_anti")

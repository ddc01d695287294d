"""Reports as data: match counts, column profile, score card, best match,
elapsed-time text, peek and slice (A4, A6, A7, F13, L1, L3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reglink import constants as C
from reglink.functions.clean import clean_name
from reglink.functions.similarity import edit_score
from reglink.operators.chunks import assign_positions
from reglink.functions.util import as_col
from reglink.session import join_side


def match_counts(evidence: DataFrame, chunks: DataFrame, key: str = "death_main_id") -> DataFrame:
    """A4: evidence rows per chunk, district and branch."""
    return (evidence.join(join_side(chunks.select(key, "chunk_id")), key)
                    .groupBy("chunk_id", "district", "branch")
                    .agg(F.count(F.lit(1)).alias("match_count")))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: name, non-null count, type (one scan, then unpivot)."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("non_null"),
                 F.lit(types[c]).alias("dtype"))
        for c in df.columns])).alias("s"))
    return stacked.select("s.*")


def scorecard(evidence: DataFrame, pending: DataFrame, block_ev: DataFrame, pin_ev: DataFrame) -> DataFrame:
    """Per person candidate the four scores the reference lays out:
    name and father edit scores (0..100), the block score of the card's own
    block in the record's block evidence, the best pin score of the record.
    The card's names are those of the evidence row (``rc_no`` need not be unique)."""
    pc = pending.select("death_main_id", "p_name", "p_father")
    blocks = join_side(block_ev.groupBy("death_main_id", "block_id").agg(F.max("score").alias("block_score")))
    pins = join_side(pin_ev.groupBy("death_main_id").agg(F.max("score").alias("pin_score")))
    own = evidence.select("death_main_id", "rc_no", "rc_blockmunicipalitycode", "branch",
                          clean_name(F.coalesce("rc_name", F.lit(""))).alias("r_name"),
                          clean_name(F.coalesce("rc_father_name", F.lit(""))).alias("r_father"))
    card = own.join(join_side(pc), "death_main_id")
    card = card.select(
        "death_main_id", "rc_no", "branch", "rc_blockmunicipalitycode",
        edit_score("p_name", "r_name").alias("name_score"),
        F.when(F.col("branch") == "name_father", edit_score("p_father", "r_father"))
         .otherwise(F.lit(None).cast("int")).alias("father_score"),
    )
    card = card.join(blocks, (card.death_main_id == blocks.death_main_id)
                     & (card.rc_blockmunicipalitycode == blocks.block_id), "left") \
               .select(card["*"], blocks.block_score)
    card = card.join(pins, "death_main_id", "left")
    return card.select("death_main_id", "rc_no", "branch", "name_score", "father_score",
                       F.col("block_score").cast("int").alias("block_score"),
                       F.col("pin_score").cast("int").alias("pin_score"))


def strong_candidates(card: DataFrame, threshold: int = 90) -> DataFrame:
    """Candidates whose name and father scores both reach ``threshold``."""
    return card.where((F.col("name_score") >= threshold) & (F.col("father_score") >= threshold))


def best_match(card: DataFrame, key: str = "death_main_id") -> DataFrame:
    """Top candidate per record: highest name+father score, then lowest rc_no.
    An aggregate (``min`` of a struct ordered as wanted), so it combines
    map-side and a record with very many candidates never sits in one task."""
    total = F.col("name_score") + F.coalesce(F.col("father_score"), F.lit(0))
    best = card.groupBy(key).agg(F.min(F.struct((-total).alias("neg_total"), F.col("rc_no"), F.col("branch")))
                                 .alias("_b"))
    return best.select(key, F.col("_b.rc_no").alias("rc_no"), F.col("_b.branch").alias("branch"),
                       (-F.col("_b.neg_total")).alias("total_score"))


def format_elapsed(seconds) -> Column:
    """``H Hour M Minutes S Seconds`` from whole seconds."""
    s = as_col(seconds).cast("long")
    h = F.floor(s / 3600).cast("long")
    m = F.floor((s % 3600) / 60).cast("long")
    return F.concat(h.cast("string"), F.lit(C.ELAPSED_HOUR), m.cast("string"), F.lit(C.ELAPSED_MINUTES),
                    (s % 60).cast("string"), F.lit(C.ELAPSED_SECONDS))


def elapsed_seconds(start, end) -> Column:
    """Whole seconds between two timestamps, truncated (``int(td.total_seconds())``)."""
    micros = F.timestamp_diff("MICROSECOND", as_col(start), as_col(end))
    return F.when(micros >= 0, F.floor(micros / 1_000_000)).otherwise(F.ceil(micros / 1_000_000)).cast("long")


def peek(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """L1: the first ``n`` rows in a total order (``head(5)`` made deterministic)."""
    return df.orderBy(*order).limit(n)


SAMPLE = 4096           # keys drawn to find where a slice lies
BAND_ROWS = 1 << 20     # a longer way into the band is placed by position


def slice_rows(df: DataFrame, order: list[str], offset: int, n: int) -> DataFrame:
    """L3: ``skiprows``/``nrows``: rows ``offset + 1`` to ``offset + n`` in a total order (nulls first), by rank selection.

    A sample of the keys bounds the band that should hold the slice; one count of the rows below and inside makes that
    exact (a band that misses the slice grows to that side).  Only the band is read again and ordered, its
    first rows kept per task.  In a band that ties make long, rows are placed by position."""
    if n <= 0:
        return df.limit(0)
    key = F.struct(*order)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    total = df.count()
    drawn = df.select(*order).sample(min(1.0, SAMPLE / max(total, 1)), seed=1).orderBy(*order).collect() if total > SAMPLE else []

    def bound(i: int):
        """Key ``i`` of the sample (none outside it)."""
        return F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(order, drawn[i])]) if 0 <= i < len(drawn) else None

    def place(rank: int) -> int:
        return rank * len(drawn) // max(total, 1)

    slack = 4 * int(len(drawn) ** 0.5) + 1
    lo, hi = place(offset) - slack, place(offset + n) + slack
    while True:
        low, high = bound(lo), bound(hi)
        below = key < low if low is not None else F.lit(False)
        above = key > high if high is not None else F.lit(False)
        at = df.agg(F.count_if(below).alias("below"), F.count_if(above).alias("above")).first() if low is not None or high is not None else (0, 0)
        skip, end = offset - at[0], offset + n
        if skip >= 0 and (high is None or end <= total - at[1]):
            break
        lo, hi = (lo - 4 * slack if skip < 0 else lo), (hi + 4 * slack if high is not None and end > total - at[1] else hi)
    band = df.where(~below & ~above)
    if skip + n <= BAND_ROWS:
        return band.orderBy(*order).offset(skip).limit(n)
    placed = assign_positions(band, order[0], tiebreak=order[1:])
    return placed.where(F.col("position").between(skip + 1, skip + n)).drop("position")

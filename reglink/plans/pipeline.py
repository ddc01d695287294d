"""Whole batch (E1) and upload ingest (K9) as lazy DataFrames.

``run`` returns the three evidence kinds for a pending set; the caller
writes each with one DataFrame write (``sinks.append_evidence``).  The
register is cleaned once per run, not once per chunk.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reglink import constants as C
from reglink.functions.clean import concat_address, strip_punct
from reglink.operators import person, token_join
from reglink.operators.chunks import assign_positions
from reglink.session import join_side, stage_table
from reglink.sources import registry, sinks

DROPPED_UPLOAD_COLUMNS = C.UPLOAD_DROPPED_COLUMNS
ADDRESS_COLUMNS = C.UPLOAD_ADDRESS_COLUMNS


@dataclass
class Evidence:
    block: DataFrame
    pin: DataFrame
    person: DataFrame


def ingest_uploads(raw: DataFrame) -> DataFrame:
    """K9 with P5/F5/F6: drop unused columns, join the address parts, strip
    punctuation from the names; keep the source file name."""
    df = raw.drop(*DROPPED_UPLOAD_COLUMNS)
    keep = [c for c in df.columns if c not in ADDRESS_COLUMNS and c not in
            ("DEATH_DECEASED_NAME", "DEATH_FATHER_NAME")]
    return df.select(
        *keep,
        strip_punct("DEATH_DECEASED_NAME").alias("death_name"),
        strip_punct("DEATH_FATHER_NAME").alias("death_father_name"),
        concat_address(*ADDRESS_COLUMNS).alias("death_address"),
    )


MAIN_COLUMNS = ["file_name", "death_address", "death_name", "death_father_name"]
RANGES = "_ranges"        # id ranges given out: one entry per load, never given out again


def _numbered_copies(rows: DataFrame, key: str, tiebreak: list[str]) -> DataFrame:
    """Add ``_content`` and ``_copy``: which of the equal rows a row is, from 0.  Equal rows are neighbours in the
    order by ``key`` and ``tiebreak``, so no group of them meets in one task."""
    content = F.sha2(F.to_json(F.struct(*MAIN_COLUMNS)), 256)
    placed = assign_positions(rows.withColumn("_content", content), key, tiebreak=tiebreak)
    first = placed.groupBy(F.col("_content").alias("_c")).agg(F.min("position").alias("_first"))
    return placed.join(first, F.col("_content") == F.col("_c")).withColumn("_copy", F.col("position") - F.col("_first")).drop("_c", "_first")


def _reserve_ids(spark, main_path: str, batch: str, n: int) -> int:
    """The id before ``n`` fresh ones: the range is entered in the registry, so no other load gets it."""
    folder = f"{main_path.rstrip('/')}/{RANGES}"
    while True:
        held = registry.entries(spark, folder)
        after = max((int(line.rsplit(" ", 1)[1]) for line in held), default=0)
        if not held and registry.exists(spark, main_path):        # a table from before the registry
            after = spark.read.parquet(main_path).agg(F.coalesce(F.max("id"), F.lit(0)).alias("n")).first()["n"]
        if registry.add(spark, folder, len(held) + 1, f"{batch} {after + 1} {after + n}"):
            return after


def append_uploads(ingested: DataFrame, main_path: str, batch: str) -> None:
    """K9: load one batch of uploads into the main table, nothing sent yet; the folder of ``batch`` is its own, so
    loading it again replaces it.

    New rows get the next ids in the order of file, address and names.  A row that the batch held before (the
    same in all columns, equal rows one for one) keeps its id, so claims and evidence go on naming it;
    ids of rows that are gone aren't given out again."""
    spark = ingested.sparkSession
    folder = f"{main_path.rstrip('/')}/batch={batch}"
    rows = _numbered_copies(ingested.select(*MAIN_COLUMNS), MAIN_COLUMNS[0], MAIN_COLUMNS[1:])
    known, before = None, registry.exists(spark, folder)
    if before:
        old = spark.read.parquet(folder).select("id", *MAIN_COLUMNS)
        old = _numbered_copies(old, MAIN_COLUMNS[0], [*MAIN_COLUMNS[1:], "id"])
        old = old.select(F.col("id").alias("_old"), F.col("_content").alias("_c"), F.col("_copy").alias("_k"))
        both = stage_table(rows.join(old, (F.col("_content") == F.col("_c")) & (F.col("_copy") == F.col("_k")), "left")
                           .select(*MAIN_COLUMNS, "_old"), "uploads")
        known = both.where(F.col("_old").isNotNull()).select(F.col("_old").alias("id"), *MAIN_COLUMNS)
        rows = assign_positions(both.where(F.col("_old").isNull()).select(*MAIN_COLUMNS), MAIN_COLUMNS[0], tiebreak=MAIN_COLUMNS[1:])
    n = rows.count()
    after = _reserve_ids(spark, main_path, batch, n) if n else 0
    fresh = rows.select((F.col("position") + F.lit(after)).cast("long").alias("id"), *MAIN_COLUMNS)
    out = fresh if known is None else fresh.unionByName(known)
    out.select("id", F.lit(0).alias("is_send"), "death_name", "death_father_name", "death_address", "file_name") \
       .write.mode("overwrite").parquet(folder)


@dataclass
class Reference:
    """Everything on the reference side of a run, prepared once: the register
    (cleaned, with edit indexes) and the two gazetteers (token indexes)."""
    register: person.RegisterSide
    blocks: token_join.TokenSetIndex
    pins: token_join.TokenSetIndex

    stored: bool = False

    def persist(self) -> "Reference":
        """Store all three in the shared checkpoint folder, once (a register side read from bucketed tables stays there)."""
        if not self.stored:
            self.register.persist()
            self.blocks.persist()
            self.pins.persist()
            self.stored = True
        return self


def prepare_reference(register: DataFrame, blocks: DataFrame, pins: DataFrame,
                      name_threshold: float = C.NAME_THRESHOLD, address_threshold: int = C.ADDRESS_THRESHOLD,
                      bucketed_path: str | None = None, buckets: int | None = None,
                      table_prefix: str = "reglink_register") -> Reference:
    """The reference side of a run.  With ``bucketed_path`` (shared storage)
    the prepared register and its edit indexes are written once as bucketed
    tables, so every later run shuffles only its pending side."""
    side = person.RegisterSide(person.prepare_register(register), name_threshold)
    if bucketed_path:
        n = buckets or int(register.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        side = side.save_bucketed(table_prefix, bucketed_path, n)
    return Reference(
        register=side,
        blocks=token_join.TokenSetIndex(blocks, "BlockCode", "BlockName", address_threshold),
        pins=token_join.TokenSetIndex(pins, "Pincode", "Pincode", address_threshold),
    )


def run(pending: DataFrame, register: DataFrame | None, blocks: DataFrame | None, pins: DataFrame | None,
        name_threshold: float = C.NAME_THRESHOLD, address_threshold: int = C.ADDRESS_THRESHOLD,
        mode: str = "correlated",
        blank_policy: str = "null_is_blank", reference: Reference | None = None) -> Evidence:
    """Block, pin and person evidence for ``pending``
    (``death_main_id, DEATH_DECEASED_NAME, DEATH_FATHER_NAME, death_address``
    [, ``chunk_id``]).  Pass ``reference`` to reuse a prepared register side."""
    ref = reference or prepare_reference(register, blocks, pins, name_threshold, address_threshold)
    block = ref.blocks.join(pending, "death_main_id", "death_address", right_out="block_id")
    pin = ref.pins.join(pending, "death_main_id", "death_address", right_out="matched_pin")
    p = person.prepare_pending(pending, blank_policy)
    ev = person.person_evidence(p, ref.register, name_threshold, mode)
    return Evidence(block=block, pin=pin, person=ev)


def write_evidence(ev: Evidence, path: str, run_date: str, chunks: DataFrame | None = None) -> None:
    """One write per evidence kind, with ``chunk_id`` as a column; together they replace the run date's evidence."""
    with sinks.EvidenceRun(ev.block.sparkSession, path, f"run-{run_date}") as run:
        for kind, df in (("block", ev.block), ("pin", ev.pin), ("person", ev.person)):
            if chunks is not None:
                df = df.join(join_side(chunks.select("death_main_id", "chunk_id")), "death_main_id")
            run.write(kind, df.withColumn("run_date", F.lit(run_date)))


def read_evidence(spark, path: str, kind: str) -> DataFrame:
    """All evidence of a kind that holds now."""
    return spark.read.parquet(*sinks.live_runs(spark, path, kind).values())


def written_evidence(spark, path: str, run_date: str) -> Evidence:
    """The evidence that a batch run of ``run_date`` wrote."""
    return Evidence(*(spark.read.parquet(sinks.live_runs(spark, path, kind)[f"run-{run_date}"]) for kind in sinks.EVIDENCE_KINDS))


EVIDENCE_REF = {"block": ("block_id", "score"), "pin": ("matched_pin", "score"), "person": ("rc_no", None)}


def read_all_evidence(spark, path: str) -> DataFrame:
    """All evidence kinds as one table: ``death_main_id, evidence, ref_id, score``
    (score is null for person evidence)."""
    out = None
    for kind, (ref, score) in EVIDENCE_REF.items():
        df = read_evidence(spark, path, kind).select(
            "death_main_id", F.lit(kind).alias("evidence"), F.col(ref).alias("ref_id"),
            (F.col(score) if score else F.lit(None)).cast("int").alias("score"))
        out = df if out is None else out.unionByName(df)
    return out


def unmatched_report(pending: DataFrame, ev: Evidence) -> DataFrame:
    """J7 per record and evidence kind."""
    out = None
    for kind, df in (("block", ev.block), ("pin", ev.pin), ("person", ev.person)):
        part = person.unmatched(pending, df).withColumn("evidence", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out

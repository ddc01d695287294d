"""Incremental matching over a folder of chunk files.

The reference walks a folder of chunk files, matches each against the
registers and deletes it.  Here the folder is a Structured Streaming file
source; each micro-batch is matched against the static, already cleaned
register (a stream-static join inside ``foreachBatch``) and its evidence
published in one step, owned by the stream (the query id that the checkpoint
holds) and the batch: a replayed batch replaces its own output whatever its
run date, and a stream with a fresh checkpoint touches no earlier output.
Progress lives in the checkpoint, not in deleted files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reglink import constants as C
from reglink.operators.person import RegisterSide
from reglink.plans.pipeline import Evidence, Reference, prepare_reference, run, unmatched_report
from reglink.sources import sinks

FOLD = 64        # batches of a stream whose evidence becomes one folder


def pending_stream(spark: SparkSession, folder: str, schema: T.StructType,
                   max_files_per_trigger: int = 1, fmt: str = "parquet",
                   archive_dir: str | None = None) -> DataFrame:
    """The chunk folder as a stream, a bounded number of files per batch.
    T3: with ``archive_dir`` consumed files are moved there after their batch
    commits (the reference deletes them; progress itself is in the checkpoint)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if fmt == "csv":
        # files must have the schema's columns in its order; a file with another header fails
        reader = (reader.option("header", True).option("enforceSchema", False).option("quote", '"').option("escape", '"')
                  .option("multiLine", True).option("mode", "FAILFAST"))
    return reader.format(fmt).load(folder)


def batch_owner(spark: SparkSession, batch_id: int) -> str:
    """Owner of a batch's output: the stream (the query id that its checkpoint holds) and the batch."""
    return f"stream-{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id:09d}"


def match_batch(batch: DataFrame, batch_id: int, ref: Reference, out_path: str, run_date: str, owner: str, mode: str, blank_policy: str,
                name_threshold: float, address_threshold: int, reports: bool = False) -> None:
    """Match one batch and write its evidence.  ``reports``: also the records without evidence (J7, per kind) and the
    match counts (A4, per chunk where there is one, district and branch), both from the evidence as written, so no join runs twice."""
    spark, out = batch.sparkSession, out_path.rstrip("/")
    ev = run(batch, None, None, None, name_threshold, address_threshold, mode, blank_policy, reference=ref)
    with sinks.EvidenceRun(spark, out, owner) as sink:
        kept = Evidence(*(sink.write(kind, df.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("run_date", F.lit(run_date)))
                          for kind, df in (("block", ev.block), ("pin", ev.pin), ("person", ev.person))))
        if reports:
            _write_reports(batch, kept, out, run_date, owner)
    sinks.fold_batches(spark, out, owner.rsplit("-", 1)[0], batch_id, FOLD)


def _write_reports(batch: DataFrame, kept: Evidence, out: str, run_date: str, owner: str) -> None:
    sinks.write_owned(unmatched_report(batch, kept).withColumn("run_date", F.lit(run_date)), f"{out}/unmatched", owner)
    found, by = kept.person, ["district", "branch"]
    if "chunk_id" in batch.columns:
        found, by = found.join(batch.select("death_main_id", "chunk_id"), "death_main_id"), ["chunk_id", *by]
    counts = found.groupBy(*by).agg(F.count(F.lit(1)).alias("match_count"))
    sinks.write_owned(counts.withColumn("run_date", F.lit(run_date)), f"{out}/match_counts", owner)


def run_incremental(spark: SparkSession, stream: DataFrame, register: DataFrame, blocks: DataFrame,
                    pins: DataFrame, out_path: str, checkpoint: str, run_date: str,
                    available_now: bool = True, mode: str = "correlated",
                    metric: str = "levenshtein", name_threshold: float = C.NAME_THRESHOLD,
                    address_threshold: int = C.ADDRESS_THRESHOLD, blank_policy: str = "null_is_blank",
                    reference: Reference | None = None, reports: bool = False) -> StreamingQuery:
    """Per micro-batch evidence, written idempotently by batch id; with ``reports`` also
    unmatched records and match counts.

    The register side (cleaned names, edit and token indexes) is built once
    and checkpointed to the shared checkpoint folder before the stream
    starts; each batch only probes it."""
    ref = reference  # e.g. a register side reloaded from bucketed tables
    if ref is None:
        ref = prepare_reference(register, blocks, pins, name_threshold, address_threshold)
        if metric != "levenshtein":
            ref.register = RegisterSide(ref.register.rows, name_threshold, metric=metric)
    ref = ref.persist()

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read the batch files once for the three evidence kinds
        try:
            # chained mode needs ``chunk_id`` in the files: chunks are the unit
            match_batch(batch, batch_id, ref, out_path, run_date, batch_owner(batch.sparkSession, batch_id), mode, blank_policy,
                        name_threshold, address_threshold, reports)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()

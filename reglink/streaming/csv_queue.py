"""The folder of CSV chunk files as a stream.

Chunk files come as a data-frame writer leaves them: an unnamed index column first, columns in any order, the chunk's
name as the file's name.  A file source with a schema can't read those, so the stream is one of *files* (path and
modification time, contents not read); each micro-batch reads its files by header name, all
files of one header in one scan.  A file that can't be read whole (no header, a missing or repeated
column, a broken row, an id that does not cast) fails alone: none of its rows is matched, and it is listed
below ``failed_files`` with the reason.  A file of no bytes holds nothing and is not listed.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reglink import constants as C
from reglink.plans.pipeline import Reference
from reglink.sources import readers, sinks
from reglink.streaming.incremental import batch_owner, match_batch

FILES = "path string, modificationTime timestamp, length bigint, content binary"
FAILED = "path string, reason string"
CORRUPT = "_corrupt"


def file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 100, glob: str = "*.csv", archive_dir: str | None = None) -> DataFrame:
    """(path, modificationTime) of the folder's files as they come, a bounded number per batch.  T3: with
    ``archive_dir`` files are moved there once their batch is done."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(folder).select("path", "modificationTime")


def headers(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each file, empty for an empty file; one job for all."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                                          F.monotonically_increasing_id().alias("n"), "value")
    first = lines.groupBy("path").agg(F.min_by("value", F.struct("at", "n")).alias("line"))
    got = {readers.plain_path(r.path): r.line for r in first.collect()}          # one line per file of the batch
    return {p: got.get(readers.plain_path(p), "") for p in paths}


def columns_of(line: str) -> list[str]:
    return next(csv.reader([line.lstrip("﻿")]), [])


def read_chunk_files(spark: SparkSession, paths: list[str], schema: T.StructType = readers.PENDING_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(rows, failed): the rows of all files that can be read whole, with ``chunk_id`` (the file's name without its
    ending) and ``_path``, and (path, reason) of the others."""
    names = [f.name for f in schema.fields]
    failed, by_header = [], {}
    for path, line in headers(spark, paths).items():
        cols = columns_of(line)
        missing, twice = [c for c in names if c not in cols], [c for c in names if cols.count(c) > 1]
        if missing:
            failed.append((path, f"no column {', '.join(missing)}" if line else "no header"))
        elif twice:
            failed.append((path, f"column {', '.join(twice)} more than once"))
        else:
            by_header.setdefault(line, []).append(path)
    rows = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("chunk_id", T.StringType()), T.StructField("_path", T.StringType())]))
    if by_header:
        parts = [_rows(spark, own, columns_of(line), schema) for line, own in sorted(by_header.items())]
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("a row does not parse")).otherwise(F.concat(F.lit("a value does not cast: "), "_bad"))
        bad = every.where(F.col(CORRUPT).isNotNull() | F.col("_bad").isNotNull()).groupBy("_path").agg(F.min(reason).alias("reason"))
        bad = [tuple(r) for r in bad.collect()]                                      # at most the files of the batch
        rows = every.drop(CORRUPT, "_bad")
        if bad:
            rows = rows.where(~F.col("_path").isin([p for p, _ in bad]))
        failed += bad
    return rows, spark.createDataFrame(failed, FAILED)


def _rows(spark: SparkSession, paths: list[str], cols: list[str], schema: T.StructType) -> DataFrame:
    # columns get plain names by place: a header's own may be empty or repeated
    places = [f"c{i}" for i in range(len(cols))]
    fields = [T.StructField(c, T.StringType()) for c in places] + [T.StructField(CORRUPT, T.StringType())]
    df = readers.csv_options(spark.read.schema(T.StructType(fields)).option("columnNameOfCorruptRecord", CORRUPT), "PERMISSIVE").csv(paths)
    # all columns are read before any is dropped: a broken row is told by its number of fields
    df = df.select("*", F.col("_metadata.file_path").alias("_path"))
    out, bad = [], []
    for f in schema.fields:
        own = F.col(places[cols.index(f.name)])
        out.append(own.try_cast(f.dataType).alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            blank = (own == "") | own.isNull()
            bad.append(F.when(~blank & own.try_cast(f.dataType).isNull(), F.lit(f.name)))
    stem = F.regexp_replace(F.element_at(F.split("_path", "/"), -1), r"\.[^.]*$", "")
    return df.select(*out, stem.alias("chunk_id"), "_path", CORRUPT, (F.coalesce(*bad) if bad else F.lit(None).cast("string")).alias("_bad"))


def run_csv_queue(spark: SparkSession, folder: str, reference: Reference, out_path: str, checkpoint: str, run_date: str, mode: str = "correlated",
                  blank_policy: str = "null_is_blank", name_threshold: float = C.NAME_THRESHOLD, address_threshold: int = C.ADDRESS_THRESHOLD,
                  max_files_per_trigger: int = 100, archive_dir: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Match the folder's chunk files as they come, against the prepared register and gazetteers.

    Each batch writes its evidence, the records without any (per kind), the match counts per chunk, and
    the files that failed; a batch that is played again replaces its own."""
    ref = reference.persist()

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        paths = [r.path for r in batch.select("path").collect()]                      # at most ``max_files_per_trigger``
        owner = batch_owner(session, batch_id)
        rows, failed = read_chunk_files(session, paths)
        rows = rows.drop("_path").persist()          # the files are read once for all kinds of evidence
        try:
            match_batch(rows, batch_id, ref, out_path, run_date, owner, mode, blank_policy, name_threshold, address_threshold, reports=True)
            sinks.write_owned(failed.withColumn("run_date", F.lit(run_date)), f"{out_path.rstrip('/')}/failed_files", owner)
        finally:
            rows.unpersist()

    writer = file_stream(spark, folder, max_files_per_trigger, archive_dir=archive_dir).writeStream.foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()

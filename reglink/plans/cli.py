"""Batch run from the command line (E1): read the queue, the register and the
gazetteers, match, and write evidence, unmatched records and match counts.

    python -m reglink.plans.cli --pending P --register R --blocks B --pins N \\
        --out OUT --run-date 2024-01-01 [--mode correlated|chained] [--chunk-size 100]

Inputs are parquet, or CSV where a path ends in ``.csv`` or ``--format csv`` is given, with the
schemas of ``sources.readers``.  ``--register`` takes one dataset (it may carry a
``district`` column) or several ``district=path``.  Outputs go below ``OUT``, one folder
per kind and run date; re-running a date replaces its folders.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from reglink import constants as C
from reglink.operators import chunks, person
from reglink.operators.register_index import RegisterIndex
from reglink.plans import pipeline
from reglink.session import get_session, join_side
from reglink.sources import readers, registry, sinks


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--pending", required=True)
    ap.add_argument("--register", required=True, nargs="+", help="a path, or several district=path")
    ap.add_argument("--blocks", required=True)
    ap.add_argument("--pins", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-date", required=True)
    ap.add_argument("--mode", default="correlated", choices=["correlated", "chained"])
    ap.add_argument("--blank-policy", default="null_is_blank", choices=list(person.BLANK_POLICIES))
    ap.add_argument("--metric", default="levenshtein", choices=["levenshtein", "damerau"])
    ap.add_argument("--chunk-size", type=int, default=C.CHUNK_SIZE)
    ap.add_argument("--name-threshold", type=float, default=C.NAME_THRESHOLD)
    ap.add_argument("--address-threshold", type=int, default=C.ADDRESS_THRESHOLD)
    ap.add_argument("--register-index", default=None,
                    help="shared folder for the prepared register (bucketed tables): "
                         "brought up to date by the changed cards when present, built once otherwise")
    ap.add_argument("--buckets", type=int, default=None)
    ap.add_argument("--stream", action="store_true",
                    help="treat --pending as a folder of chunk files and consume it as a stream (Parquet with "
                         "chunk_id, or CSV, whose file names are the chunks); progress is kept in OUT/_checkpoint")
    ap.add_argument("--files-per-batch", type=int, default=1)
    ap.add_argument("--archive-dir", default=None, help="with --stream: move chunk files there once their batch is done")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--csv-evidence", action="store_true", help="also write the evidence as CSV with the source headers")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    if args.stream:
        return _run_stream(spark, args)
    pend = _read(spark, args, args.pending, readers.PENDING_SCHEMA)
    chunked = chunks.assign_chunks(pend, args.chunk_size, "death_main_id")
    ev = pipeline.run(chunked, None, None, None, args.name_threshold, args.address_threshold,
                      args.mode, args.blank_policy, reference=_reference(spark, args))
    out = args.out.rstrip("/")
    pipeline.write_evidence(ev, out, args.run_date, chunks=chunked)
    # what was written answers the rest: no join runs twice
    ev, owner = pipeline.written_evidence(spark, out, args.run_date), f"run-{args.run_date}"
    missing = pipeline.unmatched_report(pend, ev).join(join_side(chunked.select("death_main_id", "chunk_id")), "death_main_id")
    sinks.write_owned(missing.withColumn("run_date", F.lit(args.run_date)), f"{out}/unmatched", owner)
    counts = ev.person.groupBy("chunk_id", "district", "branch").agg(F.count(F.lit(1)).alias("match_count"))
    sinks.write_owned(counts.withColumn("run_date", F.lit(args.run_date)), f"{out}/match_counts", owner)
    if args.csv_evidence:
        for kind, df in (("block", ev.block), ("pin", ev.pin), ("person", ev.person)):
            sinks.write_evidence_csv(df, out, kind, args.run_date)


def _read(spark, args, path: str, schema):
    if args.format == "csv" or path.endswith(".csv"):
        return readers.read_chunk(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def _register(spark, args):
    """One register, or one per district."""
    parts = [p.partition("=") for p in args.register]
    if all(sep for _, sep, _ in parts):
        return readers.union_registers({d: _read(spark, args, p, readers.REGISTER_SCHEMA) for d, _, p in parts})
    if len(parts) > 1:
        raise SystemExit("several registers: give each as district=path")
    path = args.register[0]
    if args.format == "csv" or path.endswith(".csv"):
        return readers.load_register(_read(spark, args, path, readers.REGISTER_SCHEMA))
    return readers.load_register(spark.read.parquet(path))


def _reference(spark, args) -> pipeline.Reference:
    blocks = readers.load_blocks(_read(spark, args, args.blocks, readers.BLOCK_SCHEMA))
    pins = readers.load_pins(_read(spark, args, args.pins, readers.PIN_SCHEMA))
    ref = pipeline.prepare_reference(_register(spark, args), blocks, pins, args.name_threshold, args.address_threshold)
    if args.register_index:
        ref.register = _register_index(spark, args, ref.register.rows)
    elif args.metric != "levenshtein":
        ref.register = person.RegisterSide(ref.register.rows, args.name_threshold, metric=args.metric)
    return ref


def _run_stream(spark, args) -> None:
    """Consume the chunk folder incrementally (the reference's loop
    over chunk files), against the static register side."""
    from pyspark.sql import types as T

    from reglink.streaming import csv_queue, incremental
    ref = _reference(spark, args)
    out = args.out.rstrip("/")
    if args.format == "csv":
        csv_queue.run_csv_queue(spark, args.pending, ref, out, f"{out}/_checkpoint", args.run_date, args.mode, args.blank_policy, args.name_threshold,
                                args.address_threshold, args.files_per_batch, args.archive_dir).awaitTermination()
        return
    schema = T.StructType(readers.PENDING_SCHEMA.fields + [T.StructField("chunk_id", T.LongType())])
    stream = incremental.pending_stream(spark, args.pending, schema, args.files_per_batch, args.format, args.archive_dir)
    incremental.run_incremental(spark, stream, None, None, None, out, f"{out}/_checkpoint", args.run_date,
                                mode=args.mode, name_threshold=args.name_threshold,
                                address_threshold=args.address_threshold, blank_policy=args.blank_policy,
                                reference=ref, reports=True).awaitTermination()


_exists = registry.exists


def _register_index(spark, args, prepared_rows) -> person.RegisterSide:
    """The register side stored by earlier runs, brought up to date by the cards that changed since; built at the first
    run, and anew for another threshold or metric."""
    return RegisterIndex(spark, args.register_index, args.name_threshold, args.metric, args.buckets).refresh(prepared_rows)


if __name__ == "__main__":
    main()

"""Batch pipeline, sinks, ingest and stream = batch."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from reglink.operators import chunks, person
from reglink.plans import pipeline
from reglink.session import scratch_path
from reglink.sources import fixtures as fx
from reglink.sources import readers

from conftest import SF_SMALL


def _rows(df, cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_chunk_sizes(spark):
    pend = fx.pending(spark, SF_SMALL)
    ch = chunks.assign_chunks(pend.select("death_main_id"), 40, "death_main_id", num_partitions=3)
    sizes = sorted((r.chunk_id, r.n) for r in ch.groupBy("chunk_id").agg(F.count("*").alias("n")).collect())
    n = pend.count()
    assert [s for _, s in sizes[:-1]] == [40] * (len(sizes) - 1)
    assert sum(s for _, s in sizes) == n
    pos = sorted(r.position for r in ch.select("position").collect())
    assert pos == list(range(1, n + 1))


def test_evidence_and_unmatched_cover_all(spark):
    pend = fx.pending(spark, SF_SMALL)
    ev = pipeline.run(pend, fx.register(spark, SF_SMALL), fx.blocks(spark, SF_SMALL), fx.pins(spark, SF_SMALL))
    ids = {r.death_main_id for r in pend.select("death_main_id").collect()}
    matched = {r.death_main_id for r in ev.person.select("death_main_id").distinct().collect()}
    missing = {r.death_main_id for r in person.unmatched(pend, ev.person).collect()}
    assert matched | missing == ids and not (matched & missing)


def test_correlated_subset_of_chained(spark):
    pend = chunks.assign_chunks(fx.pending(spark, SF_SMALL), 100, "death_main_id")
    p = person.prepare_pending(pend)
    r = person.prepare_register(fx.register(spark, SF_SMALL))
    cols = ["death_main_id", "rc_no"]
    corr = set(_rows(person.two_key_correlated(p, r), cols))
    chained = set(_rows(person.two_key_chained(p, r), cols))
    assert corr <= chained


def test_ingest_keeps_file_name(spark):
    path = scratch_path(spark, "uploads-test")
    fx.uploads(spark, SF_SMALL).drop("row_id").repartition(3).write.option("header", True).csv(path)
    back = readers.read_uploads(spark, path)
    main = pipeline.ingest_uploads(back)
    names = {r.file_name for r in main.select("file_name").distinct().collect()}
    assert len(names) == 3 and all(n.endswith(".csv") for n in names)
    assert set(main.columns) >= {"file_name", "death_name", "death_father_name", "death_address"}


def test_leading_zeros_kept(spark):
    path = scratch_path(spark, "ids")
    spark.createDataFrame([("0001001", "a")], "PERMANENT_RCNO string, NAME string").write.option("header", True).csv(path)
    df = readers.read_chunk(spark, path, readers.all_string_schema(["PERMANENT_RCNO", "NAME"]))
    assert df.first().PERMANENT_RCNO == "0001001"


def test_stream_equals_batch(spark):
    from reglink.plans.catalog import QUERIES
    cols = ["death_main_id", "rc_no", "branch"]
    stream = _rows(QUERIES["incremental_evidence"](spark, SF_SMALL), cols)
    batch = _rows(QUERIES["person_evidence"](spark, SF_SMALL), cols)
    assert stream == batch


def test_cli_batch_run_is_idempotent(spark):
    """E1 from the command line; running the same date twice leaves one copy."""
    from reglink.plans import cli
    base = scratch_path(spark, "cli")
    fx.pending(spark, SF_SMALL).write.parquet(f"{base}/pending")
    fx.register(spark, SF_SMALL).write.parquet(f"{base}/register")
    fx.blocks(spark, SF_SMALL).write.parquet(f"{base}/blocks")
    fx.pins(spark, SF_SMALL).write.parquet(f"{base}/pins")
    args = ["--pending", f"{base}/pending", "--register", f"{base}/register", "--blocks", f"{base}/blocks",
            "--pins", f"{base}/pins", "--out", f"{base}/out", "--run-date", "2024-01-01"]
    cli.main(args)
    cli.main(args)
    ev = pipeline.read_evidence(spark, f"{base}/out", "person")
    batch = QUERIES_PERSON(spark)
    assert _rows(ev, ["death_main_id", "rc_no", "branch"]) == _rows(batch, ["death_main_id", "rc_no", "branch"])
    unmatched = spark.read.parquet(f"{base}/out/unmatched")
    assert unmatched.where("evidence = 'person'").count() == person.unmatched(fx.pending(spark, SF_SMALL), batch).count()
    counts = spark.read.parquet(f"{base}/out/match_counts")
    assert counts.agg(F.sum("match_count")).first()[0] == batch.count()


def QUERIES_PERSON(spark):
    from reglink.plans.catalog import QUERIES
    return QUERIES["person_evidence"](spark, SF_SMALL)


def test_stream_chained_equals_batch_chained(spark):
    """Chained semantics are per chunk; chunk files streamed several per batch
    give the same bag as the batch run."""
    from pyspark.sql import types as T

    from reglink.sources import sinks
    from reglink.streaming import incremental
    pend = chunks.assign_chunks(fx.pending(spark, SF_SMALL), 40, "death_main_id").drop("position")
    base = scratch_path(spark, "stream-chained")
    sinks.write_chunks(pend, f"{base}/in", files=3)
    schema = T.StructType(readers.PENDING_SCHEMA.fields + [T.StructField("chunk_id", T.LongType())])
    stream = incremental.pending_stream(spark, f"{base}/in", schema, max_files_per_trigger=2)
    q = incremental.run_incremental(spark, stream, fx.register(spark, SF_SMALL), fx.blocks(spark, SF_SMALL),
                                    fx.pins(spark, SF_SMALL), f"{base}/out", f"{base}/ckpt", "2024-01-01",
                                    mode="chained")
    q.awaitTermination()
    got = pipeline.read_evidence(spark, f"{base}/out", "person")
    want = person.person_evidence(person.prepare_pending(pend), person.prepare_register(fx.register(spark, SF_SMALL)),
                                  0.9, "chained")
    cols = ["death_main_id", "rc_no", "branch"]
    assert _rows(got, cols) == _rows(want, cols)


def test_stream_archives_consumed_chunk_files(spark):
    """Consumed chunk files move to the archive folder once later batches
    commit (the reference deletes them); nothing is lost or duplicated."""
    import glob

    from pyspark.sql import types as T

    from reglink.sources import sinks
    from reglink.streaming import incremental
    pend = chunks.assign_chunks(fx.pending(spark, SF_SMALL), 40, "death_main_id").drop("position")
    base = scratch_path(spark, "stream-archive")
    sinks.write_chunks(pend, f"{base}/in", files=3)
    local = base.replace("file:", "")
    n_files = len(glob.glob(f"{local}/in/**/*.parquet", recursive=True))
    schema = T.StructType(readers.PENDING_SCHEMA.fields + [T.StructField("chunk_id", T.LongType())])
    stream = incremental.pending_stream(spark, f"{base}/in", schema, max_files_per_trigger=1,
                                        archive_dir=f"{base}/archive")
    incremental.run_incremental(spark, stream, fx.register(spark, SF_SMALL), fx.blocks(spark, SF_SMALL),
                                fx.pins(spark, SF_SMALL), f"{base}/out", f"{base}/ckpt", "2024-01-01"
                                ).awaitTermination()
    left = len(glob.glob(f"{local}/in/**/*.parquet", recursive=True))
    archived = len(glob.glob(f"{local}/archive/**/*.parquet", recursive=True))
    assert archived >= 1 and left + archived == n_files
    got = pipeline.read_evidence(spark, f"{base}/out", "person")
    cols = ["death_main_id", "rc_no", "branch"]
    from reglink.plans.catalog import QUERIES
    assert _rows(got, cols) == _rows(QUERIES["person_evidence"](spark, SF_SMALL), cols)


def test_cli_reuses_saved_register_index(spark):
    """Second run loads the bucketed register side the first run saved."""
    from reglink.plans import cli
    base = scratch_path(spark, "cli-index")
    fx.pending(spark, SF_SMALL).write.parquet(f"{base}/pending")
    fx.register(spark, SF_SMALL).write.parquet(f"{base}/register")
    fx.blocks(spark, SF_SMALL).write.parquet(f"{base}/blocks")
    fx.pins(spark, SF_SMALL).write.parquet(f"{base}/pins")
    common = ["--pending", f"{base}/pending", "--register", f"{base}/register", "--blocks", f"{base}/blocks",
              "--pins", f"{base}/pins", "--run-date", "2024-01-01", "--register-index", f"{base}/index"]
    cli.main(common + ["--out", f"{base}/out1"])
    assert cli._exists(spark, f"{base}/index/_manifest")
    cli.main(common + ["--out", f"{base}/out2"])
    cols = ["death_main_id", "rc_no", "branch"]
    first = pipeline.read_evidence(spark, f"{base}/out1", "person")
    second = pipeline.read_evidence(spark, f"{base}/out2", "person")
    assert _rows(first, cols) == _rows(second, cols) == _rows(QUERIES_PERSON(spark), cols)


def test_cli_stream_over_chunk_folder(spark):
    """--stream: the chunk folder consumed incrementally equals the batch run;
    a second invocation finds nothing new (progress is in the checkpoint)."""
    from reglink.plans import cli
    from reglink.sources import sinks
    base = scratch_path(spark, "cli-stream")
    pend = chunks.assign_chunks(fx.pending(spark, SF_SMALL), 50, "death_main_id").drop("position")
    sinks.write_chunks(pend, f"{base}/chunks", files=3)
    fx.register(spark, SF_SMALL).write.parquet(f"{base}/register")
    fx.blocks(spark, SF_SMALL).write.parquet(f"{base}/blocks")
    fx.pins(spark, SF_SMALL).write.parquet(f"{base}/pins")
    args = ["--stream", "--files-per-batch", "2", "--pending", f"{base}/chunks", "--register", f"{base}/register",
            "--blocks", f"{base}/blocks", "--pins", f"{base}/pins", "--out", f"{base}/out", "--run-date", "2024-01-01"]
    cli.main(args)
    cli.main(args)
    cols = ["death_main_id", "rc_no", "branch"]
    got = pipeline.read_evidence(spark, f"{base}/out", "person")
    assert _rows(got, cols) == _rows(QUERIES_PERSON(spark), cols)


def test_csv_chunk_files_fail_alone_and_their_reports_equal_the_batch(spark):
    """Files by header name, chunk from the file name; each broken file is listed and matches nothing."""
    import os

    from reglink.plans import cli
    from reglink.streaming import csv_queue

    base = scratch_path(spark, "csv-files")
    folder = f"{base}/in".replace("file:", "")
    os.makedirs(folder)
    pend = [tuple(r) for r in fx.pending(spark, SF_SMALL).orderBy("death_main_id").limit(40).collect()]

    def text(v):
        return "" if v is None else '"' + str(v).replace('"', '""') + '"'

    def put(name, header, order, rows):
        lines = [header] + [",".join([str(i), *(text(r[k]) for k in order)]) for i, r in enumerate(rows)]
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")

    names = ["death_main_id", "DEATH_DECEASED_NAME", "DEATH_FATHER_NAME", "death_address"]
    put("A1B2C3D4E.csv", ",".join(["", *names]), [0, 1, 2, 3], pend[:15])
    put("B 2.csv", ",".join(["", *names[::-1]]), [3, 2, 1, 0], pend[15:30])
    put("C3.csv", "\ufeffidx," + ",".join(names), [0, 1, 2, 3], pend[30:])
    put("no-father.csv", ",".join(["", names[0], names[1], names[3]]), [0, 1, 3], pend[:3])
    put("twice.csv", ",".join(["", *names, names[1]]), [0, 1, 2, 3, 1], pend[:3])
    put("bad-id.csv", ",".join(["", *names]), [0, 1, 2, 3], [*pend[:3], ("x", "y", "z", "w")])
    put("short-row.csv", ",".join(["", *names]), [0, 1, 2, 3], pend[:3])
    with open(f"{folder}/short-row.csv", "a") as f:
        f.write("9,8\n")
    put("empty.csv", ",".join(["", *names]), [0, 1, 2, 3], [])
    open(f"{folder}/nothing.csv", "w").close()                # a file of no bytes has no rows and is not listed
    with open(f"{folder}/readme.txt", "w") as f:
        f.write("no chunk")

    for k, df in (("register", fx.register(spark, SF_SMALL)), ("blocks", fx.blocks(spark, SF_SMALL)), ("pins", fx.pins(spark, SF_SMALL))):
        df.write.parquet(f"{base}/{k}")

    def files(n):
        return [f"{folder}/{x}" for x in ("A1B2C3D4E.csv", "B 2.csv", "C3.csv", "empty.csv")[:n]]

    rows, failed = csv_queue.read_chunk_files(spark, files(4))
    assert failed.count() == 0
    key = lambda r: (r[0], *(x or "" for x in r[1:4]))
    assert sorted(map(key, rows.collect())) == sorted(map(key, pend))
    assert {r.chunk_id for r in rows.collect()} == {"A1B2C3D4E", "B%202", "C3"} or {r.chunk_id for r in rows.collect()} == {"A1B2C3D4E", "B 2", "C3"}

    args = ["--stream", "--format", "csv", "--files-per-batch", "4", "--pending", folder, "--out", f"{base}/out", "--run-date", "d", "--archive-dir", f"{base}/done"]
    reg = fx.register(spark, SF_SMALL)
    for k, df in (("register", reg), ("blocks", fx.blocks(spark, SF_SMALL)), ("pins", fx.pins(spark, SF_SMALL))):
        df.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{base}/{k}-csv")
    cli.main([*args, "--register", f"all={base}/register-csv", "--blocks", f"{base}/blocks-csv", "--pins", f"{base}/pins-csv"])
    ids = [r[0] for r in pend]
    own = fx.pending(spark, SF_SMALL).where(F.col("death_main_id").isin(ids))
    want = pipeline.run(own, reg.withColumn("district", F.lit("all")), fx.blocks(spark, SF_SMALL), fx.pins(spark, SF_SMALL))
    bag = lambda df, *cols: sorted(tuple(r) for r in df.select(*cols).collect())
    for kind, df, ref in (("person", want.person, "rc_no"), ("block", want.block, "block_id"), ("pin", want.pin, "matched_pin")):
        assert bag(pipeline.read_evidence(spark, f"{base}/out", kind), "death_main_id", ref) == bag(df, "death_main_id", ref)
    assert bag(spark.read.parquet(f"{base}/out/unmatched"), "death_main_id", "evidence") == bag(pipeline.unmatched_report(own, want), "death_main_id", "evidence")
    counts = spark.read.parquet(f"{base}/out/match_counts")
    assert counts.agg(F.sum("match_count")).first()[0] == want.person.count() and counts.select("chunk_id").distinct().count() == 3
    bad = {os.path.basename(r.path): r.reason for r in spark.read.parquet(f"{base}/out/failed_files").collect()}
    assert bad == {"no-father.csv": "no column DEATH_FATHER_NAME", "twice.csv": "column DEATH_DECEASED_NAME more than once",
                   "bad-id.csv": "a value does not cast: death_main_id", "short-row.csv": "a row does not parse"}

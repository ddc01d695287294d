"""Named queries over the driver tables: ``QUERIES[name](spark, sf_dir) -> DataFrame``
and ``ORACLE[name]`` (DuckDB SQL over the same tables).  Every query reads whole
tables; ``__spark_entry__`` only re-exports these."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reglink import constants as C
from reglink.functions import clean
from reglink.operators import chunks, person, report, token_join
from reglink.operators.chunks import assign_chunks
from reglink.operators.register_index import RegisterIndex
from reglink.plans import oracle as O
from reglink.plans import pipeline
from reglink.session import join_side, scratch_path
from reglink.sources import fixtures as fx
from reglink.sources import readers, sinks
from reglink.streaming import csv_queue, incremental

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register_query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _people(spark: SparkSession, sf_dir: str):
    return person.prepare_pending(fx.pending(spark, sf_dir)), person.prepare_register(fx.register(spark, sf_dir))


@register_query("name_only_match", O.with_fixtures(O.NAME_ONLY))
def q_name_only(spark, sf_dir):
    p, r = _people(spark, sf_dir)
    return person.name_only_match(p, r)


@register_query("name_match", O.with_fixtures(O.NAME_MATCH))
def q_name_match(spark, sf_dir):
    p, r = _people(spark, sf_dir)
    return person.name_match(p, r, C.NAME_THRESHOLD)


@register_query("name_father_match", O.with_fixtures(O.NAME_FATHER))
def q_name_father(spark, sf_dir):
    p, r = _people(spark, sf_dir)
    return person.two_key_correlated(p, r, C.NAME_THRESHOLD)


@register_query("name_father_damerau", O.with_fixtures(O.NAME_FATHER_DAMERAU))
def q_name_father_damerau(spark, sf_dir):
    """J4 correlated with adjacent transpositions counted as one edit."""
    p, r = _people(spark, sf_dir)
    return person.two_key_correlated(p, person.RegisterSide(r, C.NAME_THRESHOLD, metric="damerau"), C.NAME_THRESHOLD)


@register_query("name_father_chained", O.with_fixtures(O.NAME_FATHER_CHAINED, O.CHAINED_CTES))
def q_name_father_chained(spark, sf_dir):
    pend = assign_chunks(fx.pending(spark, sf_dir), C.CHUNK_SIZE, "death_main_id")
    p = person.prepare_pending(pend)
    r = person.prepare_register(fx.register(spark, sf_dir))
    return person.two_key_chained(p, r, C.NAME_THRESHOLD)


@register_query("person_evidence", O.with_fixtures(O.PERSON_EVIDENCE))
def q_person_evidence(spark, sf_dir):
    p, r = _people(spark, sf_dir)
    return person.person_evidence(p, r, C.NAME_THRESHOLD, "correlated")


@register_query("block_match", O.with_fixtures(O.BLOCK_BODY, O.BLOCK_CTES))
def q_block_match(spark, sf_dir):
    return token_join.token_set_join(fx.pending(spark, sf_dir), fx.blocks(spark, sf_dir),
                                     "death_main_id", "death_address", "BlockCode", "BlockName",
                                     C.ADDRESS_THRESHOLD, right_out="block_id")


@register_query("pin_match", O.with_fixtures(O.PIN_BODY, O.PIN_CTES))
def q_pin_match(spark, sf_dir):
    return token_join.token_set_join(fx.pending(spark, sf_dir), fx.pins(spark, sf_dir),
                                     "death_main_id", "death_address", "Pincode", "Pincode",
                                     C.ADDRESS_THRESHOLD, right_out="matched_pin")


@register_query("block_match_contained", O.with_fixtures(O.BLOCK_CONTAINED))
def q_block_contained(spark, sf_dir):
    return token_join.contained_join(fx.pending(spark, sf_dir), fx.blocks(spark, sf_dir),
                                     "death_main_id", "death_address", "BlockCode", "BlockName",
                                     right_out="block_id")


# --- cleaning (F1, F5, F6) --------------------------------------------------

@register_query("clean_names", O.with_fixtures(O.CLEAN_NAMES))
def q_clean_names(spark, sf_dir):
    p = fx.pending(spark, sf_dir)
    return p.select("death_main_id", clean.clean_name("DEATH_DECEASED_NAME").alias("clean_name"),
                    clean.clean_name("DEATH_FATHER_NAME").alias("clean_father"))


@register_query("clean_documents", O.CLEAN_DOCUMENTS)
def q_clean_documents(spark, sf_dir):
    docs = readers.read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", clean.clean_name("text").alias("clean_text"))


@register_query("strip_punct", O.with_fixtures(O.STRIP_PUNCT))
def q_strip_punct(spark, sf_dir):
    p = fx.pending(spark, sf_dir)
    return p.select("death_main_id", clean.strip_punct("DEATH_DECEASED_NAME").alias("death_name"),
                    clean.strip_punct("DEATH_FATHER_NAME").alias("death_father_name"))


@register_query("concat_address", O.with_fixtures(O.CONCAT_ADDRESS))
def q_concat_address(spark, sf_dir):
    u = fx.uploads(spark, sf_dir)
    return u.select("row_id", clean.concat_address(*pipeline.ADDRESS_COLUMNS).alias("full_address"))


# --- sources and sinks (S1-S10, K1-K9) ---------------------------------------

@register_query("ingest_uploads", O.with_fixtures(O.INGEST_UPLOADS))
def q_ingest_uploads(spark, sf_dir):
    """Raw uploads written as CSV files, read back as a folder (S10) and
    ingested (K9).  ``file_name`` (F14) is checked by the tests; here the
    output keeps the columns the oracle can state."""
    path = scratch_path(spark, "uploads")
    raw = fx.uploads(spark, sf_dir).drop("row_id")
    raw.repartition(4).write.mode("overwrite").option("header", True) \
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = readers.read_uploads(spark, path)
    return pipeline.ingest_uploads(back).select("death_name", "death_father_name", "death_address")


@register_query("register_union", O.with_fixtures(O.REGISTER_UNION))
def q_register_union(spark, sf_dir):
    """K1 then S8: the register written partitioned by district, read back as one table."""
    path = scratch_path(spark, "register")
    sinks.write_register(readers.load_register(fx.register(spark, sf_dir)), path)
    return readers.load_register(readers.read_register_partitioned(spark, path))


@register_query("gazetteer_roundtrip", O.with_fixtures(O.GAZETTEER_ROUNDTRIP))
def q_gazetteer_roundtrip(spark, sf_dir):
    """K2 then S5/S6: both gazetteers overwritten as tables (twice: the
    reference deletes and rewrites them every run) and read back."""
    base = scratch_path(spark, "gazetteers")
    for _ in range(2):
        sinks.write_table(fx.blocks(spark, sf_dir), f"{base}/blocks")
        sinks.write_table(fx.pins(spark, sf_dir), f"{base}/pins")
    blocks = readers.load_blocks(spark.read.schema(readers.BLOCK_SCHEMA).parquet(f"{base}/blocks"))
    pins = readers.load_pins(spark.read.schema(readers.PIN_SCHEMA).parquet(f"{base}/pins"))
    return blocks.select("BlockCode", F.col("BlockName").alias("name")).unionByName(
        pins.select(F.col("Pincode").alias("BlockCode"), F.col("Pincode").alias("name")))


@register_query("pin_list", O.with_fixtures(O.PIN_LIST))
def q_pin_list(spark, sf_dir):
    return readers.load_pins(fx.pins(spark, sf_dir))


# --- work queue (S7, P10, W1, A1, A3, A5, F9, J6, K8) ------------------------

def _chunks(spark, sf_dir):
    main = fx.pending_main(spark, sf_dir)
    return main, chunks.assign_chunks(chunks.pending_only(main).select("id"), C.CHUNK_SIZE, "id")


@register_query("pending_chunks", O.with_fixtures(O.PENDING_CHUNKS, O.CHUNK_CTE))
def q_pending_chunks(spark, sf_dir):
    _, ch = _chunks(spark, sf_dir)
    return ch.select("id", "chunk_id", "position")


@register_query("chunk_stats", O.with_fixtures(O.CHUNK_STATS))
def q_chunk_stats(spark, sf_dir):
    return chunks.chunk_count(fx.pending_main(spark, sf_dir), C.CHUNK_SIZE, "id")


@register_query("chunk_id_lists", O.with_fixtures(O.CHUNK_ID_LISTS, O.CHUNK_CTE))
def q_chunk_id_lists(spark, sf_dir):
    _, ch = _chunks(spark, sf_dir)
    return chunks.chunk_id_lists(ch, "id")


@register_query("ids_from_list", O.with_fixtures(O.IDS_FROM_LIST, O.CHUNK_CTE))
def q_ids_from_list(spark, sf_dir):
    _, ch = _chunks(spark, sf_dir)
    return chunks.ids_from_list(chunks.chunk_id_lists(ch, "id"), "id_list", "id").select("chunk_id", "id")


@register_query("still_pending", O.with_fixtures(O.STILL_PENDING, O.CHUNK_CTE))
def q_still_pending(spark, sf_dir):
    main = fx.pending_main(spark, sf_dir)
    ledger = chunks.claim_pending(main, None, 5, C.CHUNK_SIZE, "id")
    return chunks.still_pending(main, ledger, "id")


@register_query("claim_twice", O.with_fixtures(O.CLAIM_TWICE, O.CHUNK_CTE))
def q_claim_twice(spark, sf_dir):
    """Two claims of a queue that advances: three chunks, then two; the first claim asked
    for again is the same."""
    main = fx.pending_main(spark, sf_dir)
    ledger = scratch_path(spark, "ledger")
    first = chunks.claim_next(main, ledger, "a", 3)
    second = chunks.claim_next(main, ledger, "b", 2)
    again = chunks.claim_next(main, ledger, "a", 3)
    parts = [c.select("id", "chunk_id", F.lit(n).alias("claim_no")) for n, c in ((1, first), (2, second), (3, again))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _csv_options(writer):
    return writer.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')


@register_query("chunk_csv_roundtrip", O.with_fixtures(O.CHUNK_CSV))
def q_chunk_csv(spark, sf_dir):
    """A chunk file as a data-frame writer leaves it: an unnamed index column first, columns in another
    order, quotes, commas and line breaks in an address, ids with leading zeros."""
    path = scratch_path(spark, "chunk-csv")
    p = fx.pending(spark, sf_dir)
    address = F.concat(F.lit('House "'), F.col("death_main_id").cast("string"), F.lit('", Ward\n'), F.col("death_address"))
    out = p.select(F.monotonically_increasing_id().alias(""), address.alias("death_address"), "DEATH_FATHER_NAME", "death_main_id",
                   "DEATH_DECEASED_NAME", F.lpad(F.col("death_main_id").cast("string"), 12, "0").alias("card"))
    _csv_options(out.write).csv(path)
    schema = T.StructType(readers.PENDING_SCHEMA.fields + [T.StructField("card", T.StringType())])
    return readers.read_chunk(spark, path, schema)


@register_query("csv_evidence", O.with_fixtures(O.CSV_EVIDENCE, O.EVIDENCE_CTES))
def q_csv_evidence(spark, sf_dir):
    """K4: block, pin and person evidence as dated CSV with the source headers, read back by name."""
    pend, ev = _evidence(spark, sf_dir)
    path, out = scratch_path(spark, "csv-evidence"), None
    for kind, df in (("block", ev.block), ("pin", ev.pin), ("person", ev.person)):
        sinks.write_evidence_csv(df, path, kind, "2024-01-01")
        names = [b for _, b in sinks.CSV_HEADERS[kind]]
        back = readers.read_chunk(spark, f"{path}/{kind}_csv/owner=run-2024-01-01", readers.all_string_schema(names))
        row = back.select(F.lit(kind).alias("kind"), F.concat_ws("|", *names).alias("line"))
        out = row if out is None else out.unionByName(row)
    return out


@register_query("ingest_claim_match", O.with_fixtures(O.INGEST_CLAIM_MATCH, O.INGEST_CTES))
def q_ingest_claim_match(spark, sf_dir):
    """Uploads by file, appended to the main table, two chunks claimed, matched by name
    against the register; each match keeps its upload's file name."""
    base = scratch_path(spark, "ingest")
    raw = fx.uploads(spark, sf_dir)
    raw = raw.withColumn("part", F.concat(F.lit("upload_"), (F.col("row_id") % 3).cast("string"))).drop("row_id")
    _csv_options(raw.write.partitionBy("part")).csv(f"{base}/in")
    pipeline.append_uploads(pipeline.ingest_uploads(readers.read_uploads(spark, f"{base}/in", name_from="folder")), f"{base}/main", "b1")
    main = spark.read.parquet(f"{base}/main")
    claim = chunks.claim_next(main, f"{base}/ledger", "c1", 2)
    pend = chunks.to_pending(main.join(claim, "id"))
    p, r = person.prepare_pending(pend), person.prepare_register(fx.register(spark, sf_dir))
    found = person.person_evidence(p, r, C.NAME_THRESHOLD)
    files = pend.select("death_main_id", F.element_at(F.split("file_name", "="), -1).alias("file_name"), "chunk_id")
    return found.join(files, "death_main_id").select("death_main_id", "chunk_id", "file_name", "rc_no", "branch")


@register_query("reload_keeps_ids", O.with_fixtures(O.RELOAD_KEEPS_IDS, O.RELOAD_CTES))
def q_reload_keeps_ids(spark, sf_dir):
    """K9/K8: batches b1 and b2 loaded, two chunks claimed, b1 loaded again, two more chunks claimed: every claimed
    row is the one that its id named at first, and none is claimed twice."""
    base = scratch_path(spark, "reload")
    raw = fx.uploads(spark, sf_dir)
    raw = raw.withColumn("file_name", F.concat(F.lit("upload_"), (F.col("row_id") % 3).cast("string")))
    b1, b2 = (pipeline.ingest_uploads(raw.where(F.col("row_id") % 2 == k).drop("row_id")) for k in (0, 1))
    claims = []
    for loads, claim in (((("b1", b1), ("b2", b2)), "c1"), ((("b1", b1),), "c2")):
        for name, rows in loads:
            pipeline.append_uploads(rows, f"{base}/main", name)
        claims.append(chunks.claim_next(spark.read.parquet(f"{base}/main"), f"{base}/ledger", claim, 2))
    main = spark.read.parquet(f"{base}/main")      # as it is after the reload
    return main.join(claims[0].unionByName(claims[1]), "id").select("id", "chunk_id", "batch", "file_name", "death_name", "death_father_name", "death_address")


@register_query("edit_join_keep", O.with_fixtures(O.EDIT_JOIN_KEEP))
def q_edit_join_keep(spark, sf_dir):
    """J3 with keep lists (P2) and case ignored (F4), on the names as they are."""
    from reglink.operators.edit_join import edit_join
    return edit_join(fx.pending(spark, sf_dir), fx.register(spark, sf_dir), "DEATH_DECEASED_NAME", "NAME", C.NAME_THRESHOLD,
                     keep_left=["death_main_id"], keep_right=["PERMANENT_RCNO", "district"], ignore_case=True)


# --- evidence reports (J7, A4, A6, A7, L1, L3, F13) --------------------------

def _evidence(spark, sf_dir):
    pend = fx.pending(spark, sf_dir)
    ev = pipeline.run(pend, fx.register(spark, sf_dir), fx.blocks(spark, sf_dir), fx.pins(spark, sf_dir))
    return pend, ev


@register_query("unmatched", O.with_fixtures(O.UNMATCHED, O.EVIDENCE_CTES))
def q_unmatched(spark, sf_dir):
    pend, ev = _evidence(spark, sf_dir)
    return pipeline.unmatched_report(pend, ev)


@register_query("match_counts", O.with_fixtures(O.MATCH_COUNTS))
def q_match_counts(spark, sf_dir):
    pend = fx.pending(spark, sf_dir)
    p, r = person.prepare_pending(pend), person.prepare_register(fx.register(spark, sf_dir))
    ev = person.person_evidence(p, r, C.NAME_THRESHOLD)
    ch = chunks.assign_chunks(pend.select("death_main_id"), C.CHUNK_SIZE, "death_main_id")
    return report.match_counts(ev, ch)


@register_query("column_profile", O.with_fixtures(O.COLUMN_PROFILE))
def q_column_profile(spark, sf_dir):
    return report.profile(fx.pending(spark, sf_dir))


def _scorecard(spark, sf_dir):
    pend, ev = _evidence(spark, sf_dir)
    return report.scorecard(ev.person, person.prepare_pending(pend), ev.block, ev.pin)


@register_query("scorecard", O.with_fixtures(O.SCORECARD, O.EVIDENCE_CTES + "," + O.SCORECARD_CTE))
def q_scorecard(spark, sf_dir):
    return _scorecard(spark, sf_dir)


@register_query("best_match", O.with_fixtures(O.BEST_MATCH, O.EVIDENCE_CTES + "," + O.SCORECARD_CTE))
def q_best_match(spark, sf_dir):
    return report.best_match(_scorecard(spark, sf_dir))


@register_query("scorecard_strong", O.with_fixtures(O.SCORECARD_STRONG, O.EVIDENCE_CTES + "," + O.SCORECARD_CTE))
def q_scorecard_strong(spark, sf_dir):
    return report.strong_candidates(_scorecard(spark, sf_dir), 90)


@register_query("elapsed_text", O.ELAPSED_TEXT)
def q_elapsed_text(spark, sf_dir):
    ev = readers.read_table(spark, sf_dir, "events")
    agg = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                    F.min("ts").alias("_t0"), F.max("ts").alias("_t1"))
    return agg.select("user_id", "n_events",
                      report.format_elapsed(report.elapsed_seconds("_t0", "_t1")).alias("elapsed_text"))


@register_query("peek", O.with_fixtures(O.PEEK))
def q_peek(spark, sf_dir):
    p, r = _people(spark, sf_dir)
    return report.peek(person.person_evidence(p, r, C.NAME_THRESHOLD), ["death_main_id", "rc_no", "branch"], 5)


@register_query("register_slice", O.with_fixtures(O.REGISTER_SLICE))
def q_register_slice(spark, sf_dir):
    return report.slice_rows(fx.register(spark, sf_dir), ["PERMANENT_RCNO"], 100, 100)


# --- variants, sinks, streaming ----------------------------------------------

@register_query("person_evidence_strict", O.with_fixtures(O.PERSON_EVIDENCE_STRICT))
def q_person_evidence_strict(spark, sf_dir):
    p = person.prepare_pending(fx.pending(spark, sf_dir), "strict")
    r = person.prepare_register(fx.register(spark, sf_dir))
    return person.person_evidence(p, r, C.NAME_THRESHOLD)


@register_query("person_evidence_bucketed", O.with_fixtures(O.PERSON_EVIDENCE))
def q_person_evidence_bucketed(spark, sf_dir):
    """Person evidence against a register persisted as bucketed tables
    (rows, two-key rows, segment indexes): the register is read in place and
    only the pending side is shuffled into its buckets."""
    import uuid
    path = scratch_path(spark, "register-bucketed")
    table = f"reglink_reg_{uuid.uuid4().hex[:8]}"
    ref = pipeline.prepare_reference(fx.register(spark, sf_dir), fx.blocks(spark, sf_dir), fx.pins(spark, sf_dir),
                                     bucketed_path=path, table_prefix=table)
    return person.person_evidence(person.prepare_pending(fx.pending(spark, sf_dir)), ref.register, C.NAME_THRESHOLD)


@register_query("register_index_refresh", O.with_fixtures(O.PERSON_EVIDENCE))
def q_register_index_refresh(spark, sf_dir):
    """A stored register index of an earlier state (one district not there yet, the fathers of another
    one blank, one card twice), brought up to date with the whole register by its changed cards."""
    rows = person.prepare_register(fx.register(spark, sf_dir))
    earlier = rows.where("district <> 'Brand_12'").withColumn("r_father", F.when(F.col("district") == "Brand_13", "").otherwise(F.col("r_father")))
    index = RegisterIndex(spark, scratch_path(spark, "register-index"), C.NAME_THRESHOLD)
    index.refresh(earlier.unionByName(earlier.orderBy("rc_no", "district").limit(1)))
    return person.person_evidence(person.prepare_pending(fx.pending(spark, sf_dir)), index.refresh(rows), C.NAME_THRESHOLD)


@register_query("evidence_sink_roundtrip", O.with_fixtures(O.PERSON_EVIDENCE))
def q_evidence_sink_roundtrip(spark, sf_dir):
    """K4-K7: person evidence written twice for the same run date (a retried
    job); the run's folder is replaced, which leaves one copy."""
    pend = fx.pending(spark, sf_dir)
    p, r = person.prepare_pending(pend), person.prepare_register(fx.register(spark, sf_dir))
    ev = person.person_evidence(p, r, C.NAME_THRESHOLD)
    ch = chunks.assign_chunks(pend.select("death_main_id"), C.CHUNK_SIZE, "death_main_id")
    out = ev.join(join_side(ch.select("death_main_id", "chunk_id")), "death_main_id")
    path = scratch_path(spark, "evidence")
    for _ in range(2):
        sinks.append_evidence(out, path, "person", "2024-01-01")
    return pipeline.read_evidence(spark, path, "person").drop("run_date", "chunk_id")


@register_query("evidence_rerun_shrinks", O.with_fixtures(O.RERUN_SHRINKS))
def q_evidence_rerun_shrinks(spark, sf_dir):
    """K4-K7: a second run of the same date that lacks the first chunk and the records that are no longer
    matched: nothing of the first run stays."""
    pend = fx.pending(spark, sf_dir)
    ch = chunks.assign_chunks(pend.select("death_main_id"), C.CHUNK_SIZE, "death_main_id")
    ev = person.person_evidence(person.prepare_pending(pend), person.prepare_register(fx.register(spark, sf_dir)), C.NAME_THRESHOLD)
    out = ev.join(join_side(ch.select("death_main_id", "chunk_id")), "death_main_id")
    path = scratch_path(spark, "shrink")
    sinks.append_evidence(out, path, "person", "2024-01-01")
    sinks.append_evidence(out.where((F.col("chunk_id") > 1) & (F.col("death_main_id") % 5 != 0)), path, "person", "2024-01-01")
    return pipeline.read_evidence(spark, path, "person").drop("run_date")


@register_query("pipeline_evidence", O.with_fixtures(O.PIPELINE_EVIDENCE, O.EVIDENCE_CTES))
def q_pipeline_evidence(spark, sf_dir):
    """E1 end to end: chunk the queue, match it (block, pin, person), write
    each evidence kind once into the run's folder, read back."""
    pend = fx.pending(spark, sf_dir)
    ch = chunks.assign_chunks(pend.select("death_main_id"), C.CHUNK_SIZE, "death_main_id")
    ev = pipeline.run(pend, fx.register(spark, sf_dir), fx.blocks(spark, sf_dir), fx.pins(spark, sf_dir))
    path = scratch_path(spark, "pipeline")
    pipeline.write_evidence(ev, path, "2024-01-01", chunks=ch)
    return pipeline.read_all_evidence(spark, path)


@register_query("evidence_failed_rerun", O.with_fixtures(O.PIPELINE_EVIDENCE, O.EVIDENCE_CTES))
def q_evidence_failed_rerun(spark, sf_dir):
    """K5-K7: a second run of the same date finds other block and pin evidence and fails while it writes the person
    evidence: what holds is the first run's, of all three kinds."""
    pend = fx.pending(spark, sf_dir)
    ch = chunks.assign_chunks(pend.select("death_main_id"), C.CHUNK_SIZE, "death_main_id")
    ev = pipeline.run(pend, fx.register(spark, sf_dir), fx.blocks(spark, sf_dir), fx.pins(spark, sf_dir))
    path = scratch_path(spark, "failed-rerun")
    pipeline.write_evidence(ev, path, "2024-01-01", chunks=ch)
    first = pipeline.written_evidence(spark, path, "2024-01-01")
    broken = first.person.withColumn("rc_no", F.when(F.length("rc_no") >= 0, F.raise_error(F.lit("fails half-way")).cast("string")))
    again = pipeline.Evidence(block=first.block.where("death_main_id % 2 = 0"), pin=first.pin.where("score > 90"), person=broken)
    try:
        pipeline.write_evidence(again, path, "2024-01-01")
    except Exception as e:
        if "fails half-way" not in str(e):
            raise
    return pipeline.read_all_evidence(spark, path)


@register_query("incremental_evidence", O.with_fixtures(O.PERSON_EVIDENCE))
def q_incremental_evidence(spark, sf_dir):
    """Pending written as chunk files (whole chunks, many to a file),
    consumed as a stream a few files per micro-batch, matched against the
    static register."""
    pend = fx.pending(spark, sf_dir)
    ch = chunks.assign_chunks(pend, C.CHUNK_SIZE, "death_main_id").drop("position")
    base = scratch_path(spark, "stream")
    sinks.write_chunks(ch, f"{base}/in")
    schema = T.StructType(readers.PENDING_SCHEMA.fields + [T.StructField("chunk_id", T.LongType())])
    stream = incremental.pending_stream(spark, f"{base}/in", schema, max_files_per_trigger=4)
    q = incremental.run_incremental(spark, stream, fx.register(spark, sf_dir), fx.blocks(spark, sf_dir),
                                    fx.pins(spark, sf_dir), f"{base}/out", f"{base}/ckpt", "2024-01-01")
    q.awaitTermination()
    return pipeline.read_evidence(spark, f"{base}/out", "person").drop("run_date", "batch_id")


@register_query("csv_queue_evidence", O.with_fixtures(O.CSV_QUEUE, O.EVIDENCE_CTES))
def q_csv_queue_evidence(spark, sf_dir):
    """The queue as a folder of CSV chunk files (an index column first, the columns in two orders, one
    file with an id that is no number), consumed as a stream of files; evidence and unmatched records as in the batch."""
    pend = fx.pending(spark, sf_dir)
    base = scratch_path(spark, "csv-queue")
    index, names = F.monotonically_increasing_id().alias(""), pend.columns
    for k, cols in enumerate((names, names[::-1])):
        own = pend.where(F.col("death_main_id") % 2 == k)
        _csv_options(own.repartition(2, "death_main_id").select(index, *cols).write).mode("append").csv(f"{base}/in")
    broken = pend.select(index, F.concat(F.lit("no. "), F.col("death_main_id").cast("string")).alias("death_main_id"), *names[1:])
    _csv_options(broken.coalesce(1).write).mode("append").csv(f"{base}/in")
    ref = pipeline.prepare_reference(fx.register(spark, sf_dir), fx.blocks(spark, sf_dir), fx.pins(spark, sf_dir))
    csv_queue.run_csv_queue(spark, f"{base}/in", ref, f"{base}/out", f"{base}/ckpt", "2024-01-01", max_files_per_trigger=3).awaitTermination()
    missing = spark.read.parquet(f"{base}/out/unmatched").select(
        "death_main_id", F.concat(F.lit("no "), "evidence").alias("evidence"), F.lit(None).cast("string").alias("ref_id"), F.lit(None).cast("int").alias("score"))
    failed = spark.read.parquet(f"{base}/out/failed_files").select(
        F.lit(None).cast("long").alias("death_main_id"), F.lit("failed file").alias("evidence"), F.col("reason").alias("ref_id"), F.lit(None).cast("int").alias("score"))
    return pipeline.read_all_evidence(spark, f"{base}/out").unionByName(missing).unionByName(failed)

"""Candidate counts on hard inputs, and state that a re-run must not corrupt."""

from __future__ import annotations

import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reglink import session
from reglink.operators import chunks, person, report, token_join
from reglink.operators.edit_join import EditIndex, edit_join
from reglink.plans import cli, pipeline
from reglink.session import scratch_path
from reglink.sources import fixtures as fx
from reglink.sources import readers, registry, sinks
from reglink.streaming import incremental

from conftest import SF_SMALL
from test_properties import lev

COLS = ["death_main_id", "rc_no", "branch"]


def _bag(df, cols=COLS):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_bare_pins_are_not_all_paired(spark):
    """2,000 bare-pin addresses against 2,000 pins of one state."""
    left = spark.range(2000).select(F.col("id").alias("k"), fx.pin_text(F.col("id") * 3 + 1).alias("t"))
    right = spark.range(2000).select(fx.pin_text(F.col("id") * 7 + 5).alias("u")).distinct()
    ix = token_join.TokenSetIndex(right, "u", "u", 80)
    lc = left.select(F.col("t").alias("lc")).distinct()
    cand = ix.no_shared_token_pairs(lc).count() + ix.shared_token_pairs(lc).count()
    kept = ix.join(left, "k", "t").count()
    assert kept > 0 and cand <= 20 * kept


def test_a_word_in_every_name_pairs_nobody(spark):
    """50,000 addresses and 5,000 names that all hold one word, and every address one name's own word."""
    own = lambda i: F.translate(F.lpad((i * 7919 % 99991).cast("string"), 6, "0"), "0123456789", "abcdefghij")
    right = spark.range(5000).select(F.col("id").cast("string").alias("g"), F.concat(F.lit("road "), own(F.col("id"))).alias("u"))
    left = spark.range(50000).select(F.col("id").alias("k"), F.concat(F.lit("House "), F.col("id").cast("string"), F.lit(", Road, "), own(F.col("id") % 6000)).alias("t"))
    ix = token_join.TokenSetIndex(right, "g", "u", 80)
    lc = token_join._canonical(left, "t", "lc").select("lc").distinct()
    cand = ix.shared_token_pairs(lc).count()
    kept = ix.join(left, "k", "t")
    n = kept.count()
    assert n >= 41000 and cand <= 20 * n
    assert kept.where("score < 100").count() == 0 or cand <= 20 * n
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_token_join_thresholds_and_how(spark):
    left = spark.createDataFrame([(1, "abc road"), (2, "zzz"), (3, None), (4, "712345")], "k long, t string")
    right = spark.createDataFrame([("a", "abc road"), ("b", "712346")], "g string, u string")
    with pytest.raises(ValueError):
        token_join.token_set_join(left, right, "k", "t", "g", "u", 67)
    inner = {(r.k, r.g) for r in token_join.token_set_join(left, right, "k", "t", "g", "u").collect()}
    assert inner == {(1, "a"), (4, "b")}
    outer = {(r.k, r.g) for r in token_join.token_set_join(left, right, "k", "t", "g", "u", how="left").collect()}
    assert outer == inner | {(2, None), (3, None)}
    assert {r.k for r in token_join.token_set_join(left, right, "k", "t", "g", "u", how="left_anti").collect()} == {2, 3}
    assert {r.k for r in token_join.token_set_join(left, right, "k", "t", "g", "u", how="left_semi").collect()} == {1, 4}


def test_names_times_fathers_is_not_built(spark):
    """300 near names and 300 near fathers without a common card."""
    def near(base, n):
        return [base[:i % 12] + chr(97 + i % 25) + base[i % 12 + 1:] + chr(97 + i // 25 % 25) for i in range(n)]
    names, fathers = near("abcdefghijklmnopqrst", 300), near("tsrqponmlkjihgfedcba", 300)
    rows = [(str(i), n, "quite another father", "1", "c") for i, n in enumerate(names)]
    rows += [(str(1000 + i), "quite another person", f, "1", "c") for i, f in enumerate(fathers)]
    register = spark.createDataFrame(rows, "PERMANENT_RCNO string, NAME string, FATHERNAME string, BlockMunicipalityCode string, RCCATEGORY string")
    pend = spark.createDataFrame([(i, names[0], fathers[0], "") for i in range(10)],
                                 "death_main_id long, DEATH_DECEASED_NAME string, DEATH_FATHER_NAME string, death_address string")
    p2 = person._two_key_pending(person.prepare_pending(pend))
    side = person.RegisterSide(person.prepare_register(register), 0.9)
    names_, fathers_ = person.name_pairs(p2, side), person.father_pairs(p2, side)
    assert names_.count() > 10 and fathers_.count() > 10
    assert person.existing_keys(p2, side, names_, fathers_).count() <= 1000
    assert person.two_key_correlated(person.prepare_pending(pend), side).count() == 0


REGISTER_DDL = "PERMANENT_RCNO string, NAME string, FATHERNAME string, BlockMunicipalityCode string, RCCATEGORY string"
PENDING_DDL = "death_main_id long, DEATH_DECEASED_NAME string, DEATH_FATHER_NAME string, death_address string"


def _letters(i: int) -> str:
    return "".join(chr(97 + i // 25 ** k % 25) for k in range(4))


def test_a_popular_key_expands_by_the_other_one(spark, monkeypatch):
    """One name with 400 fathers on both sides, one father with 400 names: each record has one card."""
    people = [("popular person", f"father {_letters(i * 7)} {_letters(i * 13)}") for i in range(400)]
    people += [(f"person {_letters(i * 7)} {_letters(i * 13)}", "popular father") for i in range(400)]
    register = spark.createDataFrame([(str(i), n, f, "1", "c") for i, (n, f) in enumerate(people)], REGISTER_DDL)
    pend = spark.createDataFrame([(i, n, f, "") for i, (n, f) in enumerate(people)], PENDING_DDL)
    p = person.prepare_pending(pend)
    side = person.RegisterSide(person.prepare_register(register), 0.9)
    p2 = person._two_key_pending(p)
    names, fathers = person.name_pairs(p2, side), person.father_pairs(p2, side)
    rows = person.existing_keys(p2, side, names, fathers).count()
    want = {(i, str(i)) for i in range(800)}
    found = {(r.death_main_id, r.rc_no) for r in person.two_key_correlated(p, side).collect()}
    assert want <= found and rows <= 4000 and len(found) <= rows
    # salted expansion of keys that are heavy on both sides gives the same rows
    monkeypatch.setattr(person, "HEAVY", 0)
    monkeypatch.setattr(person, "SALTS", 3)
    assert {(r.death_main_id, r.rc_no) for r in person.two_key_correlated(p, side).collect()} == found


def test_keys_heavy_on_both_sides_keep_every_pair(spark, monkeypatch):
    monkeypatch.setattr(person, "HEAVY", 20)
    names, fathers = [f"person abcdefgh {c}" for c in "abcdefgh"], [f"father abcdefgh {c}" for c in "abcdefgh"]
    register = spark.createDataFrame([(f"{n}|{f}", n, f, "1", "c") for n in names for f in fathers], REGISTER_DDL)
    pend = spark.createDataFrame([(1, names[0], fathers[0], ""), (2, names[1], "other", ""), (3, names[2], fathers[2], "")], PENDING_DDL)
    got = Counter(r.death_main_id for r in person.two_key_correlated(person.prepare_pending(pend), person.prepare_register(register)).collect())
    assert got == {1: 64, 3: 64}


def test_no_index_of_names_is_broadcast(spark):
    """An exploded side looks as small as the names it comes from; the joins with it are shuffle joins all the same."""
    names = spark.range(3000).select(F.concat(F.lit("one common beginning "), F.col("id").cast("string")).alias("b"))
    ix = EditIndex(names, 0.9)
    text = ix.candidates(names.select(F.col("b").alias("a")), "a")._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 2
    assert not [line for line in text.splitlines() if "BroadcastHashJoin" in line and "Inner" in line]


def _broadcast_sides(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "BroadcastHashJoin" in line and "_seg_L" not in line]


def test_no_cards_or_records_are_broadcast(spark, monkeypatch):
    """Cards, records and their pairs come from files or scans that look small; only what is counted as few is sent whole."""
    monkeypatch.setattr(session, "MANY", 0, raising=False)
    base = scratch_path(spark, "small-files")
    fx.pending(spark, SF_SMALL).write.parquet(f"{base}/pending")
    fx.register(spark, SF_SMALL).write.parquet(f"{base}/register")
    pend, register = spark.read.parquet(f"{base}/pending"), spark.read.parquet(f"{base}/register")
    p, side = person.prepare_pending(pend), person.RegisterSide(person.prepare_register(register), 0.9)
    ids = pend.select("death_main_id", F.lit(1).alias("chunk_id"))
    found = person.person_evidence(p, side)
    pins = token_join.TokenSetIndex(fx.pins(spark, SF_SMALL), "Pincode", "Pincode", 80)
    for df in (found, person.name_match(p, side), person.two_key_chained(p.withColumn("chunk_id", F.lit(1)), side), person.unmatched(pend, found),
               edit_join(pend, register, "DEATH_DECEASED_NAME", "NAME", 0.9, ["death_main_id"], ["PERMANENT_RCNO"]),
               report.match_counts(found, ids), pins.join(pend, "death_main_id", "death_address", right_out="matched_pin")):
        assert not _broadcast_sides(df)


def test_the_plan_of_a_token_join_repeats_no_input(spark):
    """Neither addresses nor pairs are worked out anew for each way of finding pairs: the driver holds a plan's text."""
    left = spark.createDataFrame([(1, "abc road"), (2, None), (3, ""), (4, "712345"), (5, "abc road"), (5, "abc road")], "k long, t string")
    right = spark.createDataFrame([("a", "abc road"), ("b", "712346"), ("c", None), ("b", "712346")], "g string, u string")
    out = token_join.token_set_join(left, right, "k", "t", "g", "u", 80)
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text and "Generate" not in text
    found = sorted((r.k, r.g, r.score) for r in out.collect())
    assert found == [(1, "a", 100), (4, "b", 83), (4, "b", 83), (5, "a", 100), (5, "a", 100)]


def test_few_rows_are_still_sent_whole(spark):
    p, side = person.prepare_pending(fx.pending(spark, SF_SMALL)), person.RegisterSide(person.prepare_register(fx.register(spark, SF_SMALL)), 0.9)
    assert _broadcast_sides(person.two_key_candidates(person._two_key_pending(p), side))


def test_no_deletions_of_pins_are_broadcast(spark):
    pins = spark.range(2000).select(fx.pin_text(F.col("id")).alias("u")).distinct()
    ix = token_join.TokenSetIndex(pins, "u", "u", 80)
    text = ix.no_shared_token_pairs(pins.select(F.col("u").alias("lc")))._jdf.queryExecution().executedPlan().toString()
    assert [line for line in text.splitlines() if "Join" in line and "_del" in line]
    assert not [line for line in text.splitlines() if "BroadcastHashJoin" in line and "_del" in line]


def test_few_names_are_sent_to_a_stored_index(spark, monkeypatch):
    register = person.prepare_register(fx.register(spark, SF_SMALL))
    p = person.prepare_pending(fx.pending(spark, SF_SMALL))
    side = person.RegisterSide(register, 0.9)
    want = _bag(person.person_evidence(p, side))
    p2 = person._two_key_pending(p)
    assert not side.probed_by_few(p2)
    side.persist()
    for few in (person.FEW, 0):
        monkeypatch.setattr(person, "FEW", few)
        text = person.name_pairs(p2, side)._jdf.queryExecution().executedPlan().toString()
        assert any("SortMergeJoin [_var" in line for line in text.splitlines()) == (not few)
        assert _bag(person.person_evidence(p, side)) == want


def test_a_long_common_beginning_pairs_nobody(spark):
    """400 names of 23 characters that share their first 17: by segments every two of them are candidates."""
    own = [f"{i * 7919 % 99991:06d}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(400)]
    names = spark.createDataFrame([("a very long word " + x,) for x in own], "a string")
    ix = EditIndex(names.select(F.col("a").alias("b")), 0.9)
    pairs = {(r.a[17:], r.b[17:]) for r in ix.probe(names).collect()}
    assert pairs == {(x, y) for x in own for y in own if lev(x, y) <= 2}
    assert ix.candidates(names, "a").where("a <> b").count() < 200 * len(own)


def test_an_index_of_another_method_is_not_probed(spark, monkeypatch):
    from reglink.operators import register_index
    from reglink.operators.register_index import RegisterIndex
    rows = person.prepare_register(fx.register(spark, SF_SMALL))
    p = person.prepare_pending(fx.pending(spark, SF_SMALL))
    want, path, kept = _bag(person.person_evidence(p, rows)), scratch_path(spark, "method"), scratch_path(spark, "method-index")
    with monkeypatch.context() as m:
        m.setattr(person, "METHOD", "segments")
        m.setattr(register_index, "METHOD", "segments")
        person.RegisterSide(rows, 0.9).save_bucketed("method_old", path, 4)
        RegisterIndex(spark, kept, 0.9, buckets=4).refresh(rows)
    assert person.RegisterSide.load_bucketed(spark, path, "method_new") is None
    index = RegisterIndex(spark, kept, 0.9, buckets=4)
    assert _bag(person.person_evidence(p, index.refresh(rows))) == want
    number, line = registry.latest(spark, f"{kept}/_manifest")
    assert number == 2 and '"method"' in line


def test_queue_advances_and_claims_repeat_safely(spark):
    main = spark.range(1, 251).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("is_send"))
    ledger = scratch_path(spark, "ledger-test")
    a = {r.id for r in chunks.claim_next(main, ledger, "a", 1, 50).collect()}
    b = [(r.id, r.chunk_id) for r in chunks.claim_next(main, ledger, "b", 2, 50).collect()]
    again = {r.id for r in chunks.claim_next(main, ledger, "a", 1, 50).collect()}
    assert a == again and len(a) == 50 and len(b) == 100 and not a & {i for i, _ in b}
    assert {c for _, c in b} == {2, 3} and min(i for i, _ in b) > max(a)
    assert chunks.still_pending(main, chunks.read_ledger(spark, ledger)).count() == 225 - 150
    assert chunks.claim_next(main, ledger, "c", 9, 50).count() == 75


def test_two_claimers_at_once_get_disjoint_chunks(spark, monkeypatch):
    """The second claimer comes in after the first has read the ledger and before it marks its claim."""
    main = spark.range(1, 301).select("id", F.lit(0).alias("is_send"))
    ledger = scratch_path(spark, "ledger-race")
    plain, others, seen = chunks.claim_pending, ["c", "b"], []

    def claim_pending(*args, **more):
        out = plain(*args, **more)
        if others:                             # b cuts in before a marks, c before b does
            seen.append(chunks.claim_next(main, ledger, others.pop(), 1, 50).count())
        return out

    monkeypatch.setattr(chunks, "claim_pending", claim_pending)
    a = chunks.claim_next(main, ledger, "a", 2, 50)
    rows = chunks.read_ledger(spark, ledger)
    assert seen == [50, 50] and a.count() == 100
    assert rows.count() == rows.select("id").distinct().count() == 200
    assert {r.claim: r.n for r in rows.groupBy("claim").agg(F.countDistinct("chunk_id").alias("n")).collect()} == {"a": 2, "b": 1, "c": 1}
    assert rows.select("chunk_id").distinct().count() == 4


def test_a_claim_that_died_before_its_entry_holds_nothing(spark):
    main = spark.range(1, 101).select("id", F.lit(0).alias("is_send"))
    ledger = scratch_path(spark, "ledger-died")
    main.select("id", F.lit(1).alias("chunk_id")).write.parquet(f"{ledger}/claim=dead")
    assert chunks.read_ledger(spark, ledger).count() == 0
    assert chunks.claim_next(main, ledger, "a", 1, 60).count() == 60 and chunks.claim_next(main, ledger, "dead", 9, 60).count() == 40


def test_reloading_a_changed_batch_keeps_the_ids_of_its_rows(spark):
    ddl = "death_name string, death_father_name string, death_address string, file_name string"

    def load(batch, rows):
        pipeline.append_uploads(spark.createDataFrame([(n, None, "x", "f.csv") for n in rows], ddl), base, batch)
        return {(r.batch, r.id): r.death_name for r in spark.read.parquet(base).collect()}

    base = scratch_path(spark, "reload-changed")
    first = load("b1", ["a", "b", "b", "b", None])
    assert sorted(i for _, i in first) == [1, 2, 3, 4, 5]
    both = load("b2", ["a", "c"])
    assert sorted(i for b, i in both if b == "b2") == [6, 7] and {k: v for k, v in both.items() if k[0] == "b1"} == first
    assert load("b1", ["a", "b", "b", "b", None]) == both
    changed = load("b1", ["b", "b", None, "z", "zz"])                # a gone, one b gone, two new
    kept = {k: v for k, v in changed.items() if k[0] == "b1"}
    assert {k: v for k, v in kept.items() if k[1] <= 5}.items() <= first.items()
    assert sorted(v or "" for k, v in kept.items() if k[1] <= 5) == ["", "b", "b"] and {v for k, v in kept.items() if k[1] > 7} == {"z", "zz"}
    again = load("b1", ["a", "b", "b", None, "z", "zz"])             # a came back: a new row with a fresh id
    assert {v for (b, i), v in again.items() if i > 9} == {"a"} and len(again) == 8
    assert load("b3", []) == again


def test_csv_by_name_fails_loudly(spark):
    path = scratch_path(spark, "csv-names")
    spark.createDataFrame([("Bina", "Asha"), ("x", None)], "FATHERNAME string, NAME string").coalesce(1).write.option("header", True).csv(path)
    got = readers.read_chunk(spark, path, readers.all_string_schema(["NAME", "FATHERNAME"])).collect()
    assert [tuple(r) for r in got] == [("Asha", "Bina"), (None, "x")]
    with pytest.raises(ValueError, match="no column AGE"):
        readers.read_chunk(spark, path, readers.all_string_schema(["NAME", "AGE"]))
    with pytest.raises(Exception):
        readers.read_chunk(spark, path, T.StructType([T.StructField("NAME", T.LongType())])).collect()


def test_rerun_drops_what_is_no_longer_found(spark):
    path = scratch_path(spark, "rerun")
    rows = spark.createDataFrame([(i, "r", i // 100) for i in range(1000)], "death_main_id long, rc_no string, chunk_id long")
    sinks.append_evidence(rows, path, "person", "d1")
    sinks.append_evidence(rows, path, "person", "d2")
    sinks.append_evidence(rows.where("chunk_id <> 3"), path, "person", "d1")
    got = _bag(pipeline.read_evidence(spark, path, "person"), ["run_date"])
    assert got == {("d1",): 900, ("d2",): 1000}
    files = glob.glob(path.replace("file:", "") + "/person/**/*.parquet", recursive=True)
    assert len(files) <= 2 * 16                       # not one per chunk


def _stream_input(spark):
    pend = chunks.assign_chunks(fx.pending(spark, SF_SMALL), 50, "death_main_id").drop("position")
    return pend, T.StructType(readers.PENDING_SCHEMA.fields + [T.StructField("chunk_id", T.LongType())])


def test_fresh_checkpoint_and_strict_policy(spark):
    """A second queue with a new checkpoint loses nothing of the first; the blank policy reaches the stream."""
    pend, schema = _stream_input(spark)
    base = scratch_path(spark, "fresh")
    sinks.write_chunks(pend.where("chunk_id = 1"), f"{base}/in1", files=1)
    sinks.write_chunks(pend.where("chunk_id > 1"), f"{base}/in2", files=2)
    ref = pipeline.prepare_reference(fx.register(spark, SF_SMALL), fx.blocks(spark, SF_SMALL), fx.pins(spark, SF_SMALL))
    for n in (1, 2):
        stream = incremental.pending_stream(spark, f"{base}/in{n}", schema)
        incremental.run_incremental(spark, stream, None, None, None, f"{base}/out", f"{base}/ckpt{n}", "2024-01-01",
                                    blank_policy="strict", reference=ref).awaitTermination()
    assert ref.stored
    # what a batch probes is stored: no scan of the register's source is left in its plan
    probe = ref.register.names.variants._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in probe
    want = person.person_evidence(person.prepare_pending(pend, "strict"), person.prepare_register(fx.register(spark, SF_SMALL)))
    assert _bag(pipeline.read_evidence(spark, f"{base}/out", "person")) == _bag(want)


def test_saved_index_is_checked(spark):
    """A changed register, another threshold and a second path each get their own answer."""
    base = scratch_path(spark, "index-check")
    reg = fx.register(spark, SF_SMALL)
    fx.pending(spark, SF_SMALL).write.parquet(f"{base}/pending")
    fx.blocks(spark, SF_SMALL).write.parquet(f"{base}/blocks")
    fx.pins(spark, SF_SMALL).write.parquet(f"{base}/pins")
    half = reg.where("cast(PERMANENT_RCNO AS int) % 2 = 0")
    half.write.parquet(f"{base}/half")
    reg.write.parquet(f"{base}/whole")

    def run(register, index, out, *more):
        cli.main(["--pending", f"{base}/pending", "--register", f"{base}/{register}", "--blocks", f"{base}/blocks", "--pins", f"{base}/pins",
                  "--run-date", "d", "--register-index", f"{base}/{index}", "--out", f"{base}/{out}", *more])
        return _bag(pipeline.read_evidence(spark, f"{base}/{out}", "person"))

    def want(register, threshold=0.9):
        return _bag(person.person_evidence(person.prepare_pending(fx.pending(spark, SF_SMALL)), person.prepare_register(register), threshold))

    assert run("half", "i1", "o1") == want(half)
    assert run("whole", "i1", "o2") == want(reg)                       # rows added since the index was saved
    assert run("whole", "i1", "o3", "--name-threshold", "0.8") == want(reg, 0.8)
    assert run("half", "i2", "o4") == want(half)                       # another path, same catalog


def test_cli_csv_and_several_registers(spark):
    base = scratch_path(spark, "cli-csv")
    reg, pend = fx.register(spark, SF_SMALL), fx.pending(spark, SF_SMALL)

    def csv(df, name):
        df.select(F.monotonically_increasing_id().alias(""), *df.columns).write.option("header", True).option("escape", '"').csv(f"{base}/{name}")

    csv(pend, "pending")
    csv(fx.blocks(spark, SF_SMALL), "blocks")
    csv(fx.pins(spark, SF_SMALL), "pins")
    districts = [r.district for r in reg.select("district").distinct().orderBy("district").limit(2).collect()]
    for d in districts:
        csv(reg.where(F.col("district") == d).drop("district"), f"reg-{d}")
    cli.main(["--format", "csv", "--csv-evidence", "--pending", f"{base}/pending", "--blocks", f"{base}/blocks", "--pins", f"{base}/pins",
              "--register", *[f"{d}={base}/reg-{d}" for d in districts], "--run-date", "d", "--out", f"{base}/out"])
    want = person.person_evidence(person.prepare_pending(pend), person.prepare_register(reg.where(F.col("district").isin(districts))))
    cols = [*COLS, "district"]
    assert _bag(pipeline.read_evidence(spark, f"{base}/out", "person"), cols) == _bag(want, cols)
    names = [b for _, b in sinks.CSV_HEADERS["person"]]
    back = readers.read_chunk(spark, f"{base}/out/person_csv/owner=run-d", readers.all_string_schema(names))
    assert back.count() == want.count()
    missing = spark.read.parquet(f"{base}/out/unmatched").where("evidence = 'person'").count()
    assert missing == person.unmatched(pend, want).count()


def test_no_shared_folder_off_local(monkeypatch):
    from reglink import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_failed_rerun_leaves_the_earlier_evidence(spark):
    path = scratch_path(spark, "half-way")
    rows = spark.createDataFrame([(i, "r") for i in range(100)], "death_main_id long, rc_no string")
    with sinks.EvidenceRun(spark, path, "a") as run:
        for kind in sinks.EVIDENCE_KINDS:
            run.write(kind, rows)
    with pytest.raises(Exception, match="half-way"):
        with sinks.EvidenceRun(spark, path, "a") as run:
            run.write("block", rows.limit(3))
            run.write("person", rows.withColumn("rc_no", F.raise_error(F.lit("half-way")).cast("string")))
    assert [pipeline.read_evidence(spark, path, k).count() for k in sinks.EVIDENCE_KINDS] == [100, 100, 100]
    for n in (50, 20, 10):
        sinks.append_evidence(rows.limit(n), path, "pin", "d", owner="a")
    assert pipeline.read_evidence(spark, path, "pin").count() == 10
    # the failed run's folders are gone; of those replaced, the last one is kept for its readers
    held = {k: len(glob.glob(f"{path.replace('file:', '')}/{k}/run=*")) for k in sinks.EVIDENCE_KINDS}
    assert held == {"block": 1, "pin": 2, "person": 1}


def test_two_writers_commit_one_after_the_other(spark, monkeypatch):
    """A commit that comes between another one's reading and its entry is kept."""
    from reglink.sources import registry

    path = scratch_path(spark, "two-writers")
    rows = spark.createDataFrame([(1, "r")], "death_main_id long, rc_no string")
    add, done = registry.add, []

    def late(session, folder, number, line):
        if not done:
            done.append(1)
            sinks.append_evidence(rows, path, "person", "d", owner="other")
        return add(session, folder, number, line)

    monkeypatch.setattr(registry, "add", late)
    sinks.append_evidence(rows, path, "person", "d", owner="own")
    assert set(sinks.live_runs(spark, path, "person")) == {"own", "other"}


def test_batches_of_a_stream_are_folded(spark):
    path = scratch_path(spark, "fold")
    for i in range(11):
        with sinks.EvidenceRun(spark, path, f"stream-q-{i:09d}") as run:
            for kind in sinks.EVIDENCE_KINDS:
                run.write(kind, spark.createDataFrame([(i, kind)], "death_main_id long, rc_no string"))
        sinks.fold_batches(spark, path, "stream-q", i, 3)
    for kind in sinks.EVIDENCE_KINDS:
        assert _bag(pipeline.read_evidence(spark, path, kind), ["death_main_id", "rc_no"]) == {(i, kind): 1 for i in range(11)}
        assert len(sinks.live_runs(spark, path, kind)) <= 5
        assert len(glob.glob(f"{path.replace('file:', '')}/{kind}/run=*")) <= 9


def test_slice_is_found_by_rank(spark, monkeypatch):
    from reglink.operators import report

    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "same").when(F.col("id") % 1000 == 1, None).otherwise(F.md5(F.col("id").cast("string"))).alias("k"),
                                   F.when(F.col("id") % 7 > 0, F.col("id")).alias("i"), F.col("id").alias("j")).repartition(7)
    rows = sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
    for sample, most in ((4096, 1 << 20), (200, 1 << 20), (4096, 10)):
        monkeypatch.setattr(report, "SAMPLE", sample)
        monkeypatch.setattr(report, "BAND_ROWS", most)
        for offset, n in ((0, 5), (100, 100), (15000, 40), (29990, 100), (40000, 5), (29000, 0)):
            got = report.slice_rows(df, ["k", "i", "j"], offset, n)
            assert sorted(tuple(r) for r in got.select("j").collect()) == sorted((r[2],) for r in rows[offset:offset + n]), (sample, offset)
    monkeypatch.undo()
    plan = report.slice_rows(df, ["k", "i", "j"], 15000, 40)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan and "ExistingRDD" not in plan


def test_batches_on_a_stored_register_plan_in_short_pieces(spark):
    """The pairs of keys that a batch finds in a stored register are staged: the plan of its evidence joins records, pairs
    and cards, and holds neither the similar names and fathers nor the cards that they reach."""
    pend = spark.createDataFrame([(1, "ann lee", "bob lee"), (2, "ann leee", "bob lee"), (3, "ann lee", ""), (4, "zoe", "max"), (5, None, None)],
                                 "death_main_id long, DEATH_DECEASED_NAME string, DEATH_FATHER_NAME string")
    cards = spark.createDataFrame([("1", "ann lee", "bob lee", "0001", "x", "d"), ("1", "ann lee", "bob lee", "0001", "x", "d"), ("2", "zoe", "tim", "0002", "x", "d"),
                                   ("3", "ann lee", None, "0003", "x", "d")],
                                  "PERMANENT_RCNO string, NAME string, FATHERNAME string, BlockMunicipalityCode string, RCCATEGORY string, district string")
    p, rows = person.prepare_pending(pend), person.prepare_register(cards)
    found = person.two_key_correlated(p, person.RegisterSide(rows).persist())
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, person.two_key_correlated(p, rows).collect())) and found.count() == 2
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2

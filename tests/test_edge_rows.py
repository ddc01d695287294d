"""Edge rows listed in FIXTURES.md §2: budgets at 9/10/19/20 characters,
adjacent swaps, Unicode spaces, non-Latin names, duplicate gazetteer names,
a 101-row queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from reglink.functions.clean import clean_name
from reglink.operators import chunks, person, token_join


def _person(spark, pending_rows, register_rows):
    pend = spark.createDataFrame(pending_rows, "death_main_id long, DEATH_DECEASED_NAME string, "
                                               "DEATH_FATHER_NAME string, death_address string")
    reg = spark.createDataFrame(register_rows, "PERMANENT_RCNO string, NAME string, FATHERNAME string, "
                                               "BlockMunicipalityCode string, RCCATEGORY string")
    return person.prepare_pending(pend), person.prepare_register(reg)


def test_edit_budget_by_length(spark):
    # (pending name, register name, expected match at 0.9)
    cases = [
        ("abcdefghi", "abcdefghx", False),               # 9 chars: budget 0
        ("abcdefghij", "abcdefghix", True),              # 10 chars: budget 1
        ("abcdefghij", "abcdefgh", False),               # 2 deletions at 10
        ("abcdefghijklmnopqrs", "abcdefghijklmnopqxx", False),  # 19 chars, 2 edits
        ("abcdefghijklmnopqrs", "abcdefghijklmnopqrx", True),   # 19 chars, 1 edit
        ("abcdefghijklmnopqrst", "abcdefghijklmnopqrxx", True),  # 20 chars: budget 2
        ("abcdefghij", "abcdefghji", False),             # adjacent swap = 2 edits at 10
        ("abcdefghijklmnopqrst", "abcdefghijklmnopqrts", True),  # swap at 20
    ]
    pend = [(i, a, "father name", None) for i, (a, _, _) in enumerate(cases)]
    reg = [(f"{i:07d}", b, "father name", "0001", "PHH") for i, (_, b, _) in enumerate(cases)]
    p, r = _person(spark, pend, reg)
    got = {(x.death_main_id, x.rc_no) for x in person.two_key_correlated(p, r).collect()}
    # the cases share prefixes, so check the intended pair of each case
    diagonal = {(i, rc) for i, rc in got if rc == f"{i:07d}"}
    want = {(i, f"{i:07d}") for i, (_, _, ok) in enumerate(cases) if ok}
    assert diagonal == want


def test_unicode_space_and_non_latin(spark):
    df = spark.createDataFrame([("Rina Das",), ("রিনা দাস",), ("  ",), (None,)], "n string")
    assert [r.c for r in df.select(clean_name("n").alias("c")).collect()] == ["rina das", "", "", None]
    p, r = _person(spark, [(1, "রিনা দাস", "--", None), (2, "", "--", None)],
                   [("0000001", "নাম", "", "0001", "PHH"), ("0000002", "", "", "0001", "PHH")])
    assert person.name_only_match(p, r).count() == 0  # blank never equals blank


def test_null_and_blank_keys_never_match(spark):
    p, r = _person(spark, [(1, None, "karim", None), (2, "anwar hossain", None, None), (3, "", "", None)],
                   [("0000001", None, None, "0001", "PHH"), ("0000002", "", "karim", "0001", "PHH"),
                    ("0000003", "anwar hossain", "", "0001", "PHH")])
    ev = person.person_evidence(p, r)
    # only record 2 (null father -> name-only branch) matches card 3 by name
    assert {(x.death_main_id, x.rc_no, x.branch) for x in ev.collect()} == {(2, "0000003", "name_only")}


def test_duplicate_gazetteer_names_are_a_bag(spark):
    left = spark.createDataFrame([(1, "Vill Haripur, Mal")], "k long, t string")
    right = spark.createDataFrame([("01", "Mal"), ("02", "Mal"), ("03", "Nanoor")], "g string, u string")
    got = sorted((r.k, r.g, r.score) for r in token_join.token_set_join(left, right, "k", "t", "g", "u", 80).collect())
    assert got == [(1, "01", 100), (1, "02", 100)]


def test_101_rows_make_chunks_of_100_and_1(spark):
    df = spark.range(101).select((F.col("id") * 7 + 3).alias("id"))
    ch = chunks.assign_chunks(df, 100, "id", num_partitions=4)
    sizes = sorted((r.chunk_id, r["count"]) for r in ch.groupBy("chunk_id").count().collect())
    assert sizes == [(1, 100), (2, 1)]
    lists = chunks.chunk_id_lists(ch, "id").orderBy("chunk_id").collect()
    assert lists[1].id_list == str(100 * 7 + 3)
    assert len(lists[0].chunk_name) == 9 and lists[0].chunk_name == lists[0].chunk_name.upper()
    back = chunks.ids_from_list(chunks.chunk_id_lists(ch, "id")).select("id").collect()
    assert sorted(r.id for r in back) == [i * 7 + 3 for i in range(101)]


def test_hot_name_holds_a_third_of_the_register(spark):
    """One (name, father) held by a third of the register and by many pending
    rows: every pair is found (bag semantics), the hot value enters the
    segment index once, and no row is dropped."""
    hot, n_reg, n_pend = ("md rahim", "md karim"), 300, 40
    reg_rows = [(f"{i:07d}", hot[0] if i % 3 == 0 else f"person {chr(97 + i % 26)}{i}",
                 hot[1] if i % 3 == 0 else "some father", "0001", "PHH") for i in range(n_reg)]
    pend_rows = [(i, "Md  Rahim" if i % 2 == 0 else "MD RAHIMM", "Md Karim", None) for i in range(n_pend)]
    p, r = _person(spark, pend_rows, reg_rows)
    side = person.RegisterSide(r, 0.9)
    assert side.names.values.where(F.col("b") == hot[0]).count() == 1
    ev = person.two_key_correlated(p, side)
    # "md rahimm" (9 chars) vs "md rahim" (8): budget floor(9/10) = 0 -> no match
    assert ev.count() == (n_pend // 2) * (n_reg // 3)
    assert {r_.death_main_id for r_ in ev.select("death_main_id").distinct().collect()} == set(range(0, n_pend, 2))


def test_chunks_with_hot_non_unique_key(spark):
    """A third of the rows share one key value; the tie-break column splits it
    across range partitions and every row still gets a unique position."""
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                 F.col("id").alias("row"))
    ch = chunks.assign_chunks(df, 100, "k", num_partitions=6, tiebreak=["row"])
    pos = sorted(r.position for r in ch.select("position").collect())
    assert pos == list(range(1, 301))
    first = ch.orderBy("position").select("k", "row").collect()
    assert [(r.k, r.row) for r in first] == sorted((r.k, r.row) for r in first)


def test_ids_from_list_tolerates_empty_items(spark):
    lists = spark.createDataFrame([(1, "3,,5, 7"), (2, "x,9")], "chunk_id long, id_list string")
    key = lambda t: (t[0], -1 if t[1] is None else t[1])
    got = sorted(((r.chunk_id, r.id) for r in chunks.ids_from_list(lists).collect()), key=key)
    assert got == sorted([(1, 3), (1, 5), (1, 7), (2, None), (2, 9)], key=key)


def test_garbage_long_inputs_cost_nothing(spark):
    """Very long names/addresses on the pending side emit no probes when the
    index side has no strings of comparable length, and still match nothing."""
    long_name = "x" * 5000
    p, r = _person(spark, [(1, long_name, long_name, "road " * 2000), (2, "anwar hossain", "karim hossain", "Mal")],
                   [("0000001", "Anwar Hossain", "Karim Hossain", "0001", "PHH")])
    side = person.RegisterSide(r, 0.9)
    left = p.select(F.col("p_name").alias("a"))
    assert side.names.candidates(left.where(F.length("a") > 100), "a").count() == 0
    assert {(x.death_main_id, x.rc_no) for x in person.two_key_correlated(p, side).collect()} == {(2, "0000001")}
    pend = spark.createDataFrame([(1, "road " * 2000), (2, "Vill Haripur, Mal")], "k long, t string")
    gaz = spark.createDataFrame([("01", "Mal")], "g string, u string")
    got = {(x.k, x.g) for x in token_join.token_set_join(pend, gaz, "k", "t", "g", "u").collect()}
    assert got == {(2, "01")}

"""The hand fixture of FIXTURES.md §2 with its expected results."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from reglink.functions.clean import clean_name
from reglink.operators import person, token_join

PENDING = [
    (1, "Anwar  Hossain", "Karim Hossain", "12 Mill Road, Haripur, Alipurduar-I, 736121"),
    (2, "ANOWAR HOSSAIN", "KARIM HOSAIN", "Vill Haripur PO Dinhata 736135"),
    (3, "Rina Das", "--", "Ward 4, Siliguri"),
    (4, "Rina Das", None, None),
    (5, "Subhash Chandra Roy", "Gopal Chandra Roy", "736121"),
    (6, "O'Neil-Smith 2nd", "Paul Smith", "PO Mal"),
    (7, "Anwar Hossain", "Gopal Chandra Roy", "Alipurduar"),
]
REGISTER = [
    ("0001001", "Anwar Hossain", "Karim Hossain", "0101", "PHH"),
    ("0001002", "Anwar Hossain", "Rahim Sekh", "0101", "AAY"),
    ("0001003", "Rina Das", "", "0102", "SPHH"),
    ("0001004", "Subash Chandra Roy", "Gopal Chandra Ray", "0103", "PHH"),
    ("0001005", "ONeilSmith nd", "Paul Smith", "0104", "RKSY1"),
    ("0001006", "", "Karim Hossain", "0101", "PHH"),
]
BLOCKS = [("0101", "Alipurduar-I"), ("0102", "Alipurduar-II"), ("0103", "Siliguri"),
          ("0104", "Mal"), ("0105", "Nanoor")]
PINS = [("736121",), ("736135",), ("734001",)]


@pytest.fixture(scope="module")
def frames(spark):
    pend = spark.createDataFrame(PENDING, "death_main_id long, DEATH_DECEASED_NAME string, "
                                          "DEATH_FATHER_NAME string, death_address string")
    reg = spark.createDataFrame(REGISTER, "PERMANENT_RCNO string, NAME string, FATHERNAME string, "
                                          "BlockMunicipalityCode string, RCCATEGORY string") \
               .withColumn("district", F.lit("D1"))
    blocks = spark.createDataFrame(BLOCKS, "BlockCode string, BlockName string")
    pins = spark.createDataFrame(PINS, "Pincode string")
    return pend, reg, blocks, pins


def test_clean_names(frames):
    pend = frames[0]
    got = [r.c for r in pend.orderBy("death_main_id").select(clean_name("DEATH_DECEASED_NAME").alias("c")).collect()]
    assert got == ["anwar hossain", "anowar hossain", "rina das", "rina das",
                   "subhash chandra roy", "oneilsmith nd", "anwar hossain"]


def test_block_match(frames):
    pend, _, blocks, _ = frames
    got = token_join.token_set_join(pend, blocks, "death_main_id", "death_address",
                                    "BlockCode", "BlockName", 80).collect()
    assert sorted((r.death_main_id, r.BlockCode, r.score) for r in got) == [
        (1, "0101", 100), (1, "0102", 87), (3, "0103", 100), (6, "0104", 100), (7, "0101", 100), (7, "0102", 100)]


def test_pin_match_and_near_miss(frames, spark):
    pend, _, _, pins = frames
    got = token_join.token_set_join(pend, pins, "death_main_id", "death_address", "Pincode", "Pincode", 80).collect()
    assert sorted((r.death_main_id, r.Pincode, r.score) for r in got) == [
        (1, "736121", 100), (2, "736135", 100), (5, "736121", 100)]
    pair = spark.createDataFrame([("736121", "736135")], "lc string, rc string")
    assert token_join.score_pairs(pair).collect()[0].score == 67


def _pairs(df):
    return Counter((r.death_main_id, r.rc_no) for r in df.collect())


def test_name_match(frames):
    pend, reg, _, _ = frames
    p, r = person.prepare_pending(pend), person.prepare_register(reg)
    assert set(_pairs(person.name_match(p, r))) == {
        (1, "0001001"), (1, "0001002"), (2, "0001001"), (2, "0001002"), (5, "0001004"),
        (6, "0001005"), (7, "0001001"), (7, "0001002")}


def test_name_father_correlated(frames):
    pend, reg, _, _ = frames
    p, r = person.prepare_pending(pend), person.prepare_register(reg)
    assert _pairs(person.two_key_correlated(p, r)) == Counter(
        {(1, "0001001"): 1, (2, "0001001"): 1, (5, "0001004"): 1, (6, "0001005"): 1})


def test_name_father_chained(frames):
    pend, reg, _, _ = frames
    p = person.prepare_pending(pend.withColumn("chunk_id", F.lit(1)))
    r = person.prepare_register(reg)
    assert _pairs(person.two_key_chained(p, r)) == Counter(
        {(1, "0001001"): 3, (2, "0001001"): 3, (5, "0001004"): 1, (6, "0001005"): 1, (7, "0001004"): 1})


def test_name_only(frames):
    pend, reg, _, _ = frames
    r = person.prepare_register(reg)
    both = person.name_only_match(person.prepare_pending(pend, "null_is_blank"), r)
    assert set(_pairs(both)) == {(3, "0001003"), (4, "0001003")}
    strict = person.name_only_match(person.prepare_pending(pend, "strict"), r)
    assert set(_pairs(strict)) == {(3, "0001003")}


def test_unmatched(frames):
    pend, reg, _, _ = frames
    p, r = person.prepare_pending(pend), person.prepare_register(reg)
    ev = person.person_evidence(p, r)
    assert [x.death_main_id for x in person.unmatched(pend, ev).collect()] == [7]


def test_edit_join_api(frames):
    pend, reg, _, _ = frames
    p = pend.select("death_main_id", clean_name("DEATH_DECEASED_NAME").alias("pn"))
    r = reg.select("PERMANENT_RCNO", clean_name("NAME").alias("rn"))
    from reglink.operators.edit_join import edit_join
    inner = edit_join(p, r, "pn", "rn", 0.9, ["death_main_id"], ["PERMANENT_RCNO"])
    assert sorted(tuple(x) for x in inner.collect()) == sorted([
        (1, "0001001"), (1, "0001002"), (2, "0001001"), (2, "0001002"), (3, "0001003"), (4, "0001003"),
        (5, "0001004"), (6, "0001005"), (7, "0001001"), (7, "0001002")])
    anti = edit_join(p, r, "pn", "rn", 0.9, ["death_main_id"], how="left_anti")
    assert anti.count() == 0
    exact = edit_join(p, r, "pn", "rn", 1.0, ["death_main_id"], ["PERMANENT_RCNO"])
    assert sorted(tuple(x) for x in exact.collect()) == sorted([
        (1, "0001001"), (1, "0001002"), (3, "0001003"), (4, "0001003"), (6, "0001005"),
        (7, "0001001"), (7, "0001002")])


def test_edit_join_left_keeps_unmatched(frames):
    pend, reg, _, _ = frames
    from reglink.operators.edit_join import edit_join
    p = pend.select("death_main_id", clean_name("DEATH_FATHER_NAME").alias("pf"))
    r = reg.select("PERMANENT_RCNO", clean_name("FATHERNAME").alias("rf"))
    got = edit_join(p, r, "pf", "rf", 0.9, ["death_main_id"], ["PERMANENT_RCNO"], how="left")
    rows = {(x.death_main_id, x.PERMANENT_RCNO) for x in got.collect()}
    # every pending row is kept; blank/null fathers (3, 4) have no partner
    assert {i for i, _ in rows} == set(range(1, 8))
    assert (3, None) in rows and (4, None) in rows
    assert (1, "0001001") in rows and (1, "0001006") in rows and (2, "0001001") in rows

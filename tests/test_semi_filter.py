"""The Bloom-filter semi-join loses no key, and cuts a large register down before its shuffles."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from reglink.operators import edit_join, person, semi_filter
from reglink.session import stage_table


def _bag(df):
    return Counter(tuple(r) for r in df.collect())


def _word(x, salt):
    """Eleven letters that follow from a number, far from those of other numbers."""
    return F.translate(F.substring(F.md5(F.concat(F.lit(salt), x.cast("string"))), 1, 11), "0123456789", "ghijklmnop")


def test_no_key_is_lost(spark):
    big = spark.range(20000).select((F.col("id") % 10000).alias("k"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), F.col("id") % 10000)).alias("t"), "id")
    small = spark.range(300).select((F.col("id") * 37).alias("k"), F.concat(F.lit("t"), F.col("id") * 37).alias("t"))
    small = small.unionByName(small).unionByName(spark.createDataFrame([(None, "x"), (5, None)], "k long, t string"))
    held = semi_filter.might_hold(big, small, ["k", "t"], 602)
    want = big.join(small.distinct(), ["k", "t"], "left_semi").select(*big.columns)
    assert _bag(want) <= _bag(held) and held.count() <= want.count() + 0.08 * big.count()
    assert held.columns == big.columns
    assert semi_filter.might_hold(big, small.limit(0), ["k"], 0).count() == 0
    assert semi_filter.might_hold(big.limit(0), small, ["k"], 602).count() == 0


def test_a_large_filter_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(semi_filter, "MAX_WORDS", 4)
    big = spark.range(100).withColumnRenamed("id", "k")
    assert semi_filter.might_hold(big, big.limit(1), ["k"], 1000) is big


def test_register_of_a_hundred_to_one(spark, monkeypatch):
    """20,000 cards and 200 records, half of them with an edit: the variants that are shuffled are a tenth at most, and
    the evidence is that of the whole register."""
    ids = spark.range(20000)
    reg = ids.select(F.col("id").cast("string").alias("PERMANENT_RCNO"), _word(F.col("id"), "n").alias("NAME"),
                     F.when(F.col("id") % 10 > 0, _word(F.col("id"), "f")).alias("FATHERNAME"), F.lit("1").alias("BlockMunicipalityCode"), F.lit("c").alias("RCCATEGORY"))
    edit = lambda c: F.when(F.col("id") % 2 == 0, F.substring(c, 2, 20)).otherwise(c)
    pend = spark.range(200).select(F.col("id").alias("death_main_id"), edit(_word(F.col("id") * 97, "n")).alias("DEATH_DECEASED_NAME"),
                                   F.when((F.col("id") * 97) % 10 > 0, _word(F.col("id") * 97, "f")).alias("DEATH_FATHER_NAME"))
    rows, p = stage_table(person.prepare_register(reg), "hundred"), stage_table(person.prepare_pending(pend), "one")
    plain = _bag(person.person_evidence(p, person.RegisterSide(rows, 0.9)))
    assert not person.RegisterSide(rows).outweighs(p) and sum(plain.values()) >= 180

    seen = []

    def watched(big, small, cols, n):
        out = semi_filter.might_hold(big, small, cols, n)
        seen.append((tuple(cols), big.count(), out.count()))
        return out

    monkeypatch.setattr(person, "REDUCE_FROM", 1000)
    monkeypatch.setattr(person, "might_hold", watched)
    monkeypatch.setattr(edit_join, "might_hold", watched)
    got = _bag(person.person_evidence(p, person.RegisterSide(rows, 0.9)))
    assert got == plain
    assert {c for c, _, _ in seen} >= {(edit_join.VARIANT,), ("r_name",), ("r_name", "r_father")}
    assert all(after * 10 <= before for _, before, after in seen if before), seen

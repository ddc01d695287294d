"""A stored register index brought up to date by its changed cards equals one built anew."""

from __future__ import annotations

import glob
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reglink import constants as C
from reglink.operators import person
from reglink.operators.register_index import LOAD, LOADS, RegisterIndex
from reglink.session import scratch_path, stage_table
from reglink.sources import fixtures as fx
from reglink.sources import registry

from conftest import SF_ORACLE, SF_SMALL

PARTS = [f"{part}/{kind}" for part in ("names", "fathers") for kind in ("values", "segments", "variants")]


def _bag(df):
    return Counter(tuple(r) for r in df.collect())


def _evidence(spark, sf, side):
    return _bag(person.person_evidence(person.prepare_pending(fx.pending(spark, sf)), side).select(*person.PERSON_COLUMNS, "branch"))


def _state(spark, path):
    return json.loads(registry.latest(spark, f"{path}/{LOADS}")[1])


def test_one_percent_of_changed_cards(spark):
    """Of about 2,100 cards 10 go, 10 get another name and 10 are new: a twentieth of the index is written at most."""
    path = scratch_path(spark, "rix")
    rows = stage_table(person.prepare_register(fx.register(spark, SF_ORACLE)), "rix-rows")
    index = RegisterIndex(spark, path, 0.9)
    index.refresh(rows)
    ids = [r.rc_no for r in rows.where("length(r_father) > 0").groupBy("rc_no").count().where("count = 1").orderBy("rc_no").limit(30).collect()]
    gone, renamed, copied = ids[:10], ids[10:20], ids[20:]
    turned = F.when(F.col("rc_no").isin(renamed), F.concat(F.lit("zed"), "r_name")).otherwise(F.col("r_name"))
    now = rows.where(~F.col("rc_no").isin(gone)).withColumn("r_name", turned).unionByName(
        rows.where(F.col("rc_no").isin(copied)).withColumn("rc_no", F.concat(F.lit("N"), "rc_no")).withColumn("r_name", F.reverse("r_name")))
    side = index.refresh(now)
    state = _state(spark, path)
    assert len(state["loads"]) == 2
    written = Counter()
    for part in ["rows", "two_key", *PARTS]:
        for r in index._table(state, part).groupBy(LOAD).count().collect():
            written[r[LOAD]] += r["count"]
    assert 0 < written[state["loads"][1]] * 20 <= written[state["loads"][0]]
    assert _bag(side.rows.select(*sorted(now.columns))) == _bag(now.select(*sorted(now.columns))) and state["rows"] == now.count()
    assert _evidence(spark, SF_ORACLE, side) == _evidence(spark, SF_ORACLE, person.RegisterSide(now, 0.9))
    again = index.refresh(now)                                    # nothing changed: nothing written
    assert _state(spark, path) == state
    assert "CartesianProduct" not in again.rows._jdf.queryExecution().executedPlan().toString()


def test_copies_nulls_and_a_return(spark):
    """Equal cards are counted, a null is not a blank, and a card may go and come back."""
    ddl = "rc_no string, rc_name string, rc_father_name string, rc_blockmunicipalitycode string, rc_category string, district string, r_name string, r_father string"
    card = lambda i, **kw: tuple(({"rc_no": str(i), "rc_name": f"n{i}", "rc_father_name": "f", "rc_blockmunicipalitycode": "1", "rc_category": "c",
                                   "district": None, "r_name": "ab" + chr(97 + i % 26) * 3, "r_father": "father"} | kw).values())
    base = [card(i) for i in range(400)]
    states = [base, base + [base[0], base[0]], base[1:], base + [base[0]], base[:399] + [card(399, district="")],
              base[:398] + [card(398, rc_category=None, district="c"), card(399, rc_category="c")], base]
    index = RegisterIndex(spark, scratch_path(spark, "rix-small"), 0.9, buckets=2)
    for want in states:
        got = index.refresh(spark.createDataFrame(want, ddl))
        assert _bag(got.rows.select(*[c.split()[0] for c in ddl.split(", ")])) == Counter(want)
    assert len(_state(spark, index.path)["loads"]) == len(states)
    empty = spark.createDataFrame([], ddl)
    side = index.refresh(empty)                                   # all gone: built anew
    assert side.rows.count() == 0 and side.names.values.count() == 0
    assert _bag(index.refresh(spark.createDataFrame(base, ddl)).rows.select("rc_no")) == Counter((str(i),) for i in range(400))


def test_a_load_that_died_and_a_second_writer(spark, monkeypatch):
    """Rows of a load that was never entered are not read; who comes second works its difference out again."""
    rows = stage_table(person.prepare_register(fx.register(spark, SF_SMALL)), "rix-rows")
    index = RegisterIndex(spark, scratch_path(spark, "rix-died"), 0.9, buckets=4)
    first = rows.where("rc_no > '2'")
    index.refresh(rows.limit(rows.count() - 5))
    real = index._write

    def die(state, part, df, load):
        if part == "fathers/values":
            raise RuntimeError("lost")
        real(state, part, df, load)

    monkeypatch.setattr(index, "_write", die)
    with pytest.raises(RuntimeError):
        index.refresh(rows)
    monkeypatch.setattr(index, "_write", real)

    add, tried = registry.add, []

    def other_first(spark_, folder, number, line):
        if not tried:
            tried.append(number)
            RegisterIndex(spark, index.path, 0.9, buckets=4).refresh(first)
        return add(spark_, folder, number, line)

    monkeypatch.setattr(registry, "add", other_first)
    side = index.refresh(rows)
    assert tried and _bag(side.rows.select("rc_no", "district")) == _bag(rows.select("rc_no", "district"))
    assert _evidence(spark, SF_SMALL, side) == _evidence(spark, SF_SMALL, person.RegisterSide(rows, 0.9))
    other = RegisterIndex(spark, index.path, 0.8, buckets=4).refresh(rows)      # another threshold: built anew
    assert other.threshold == 0.8 and len(_state(spark, index.path)["loads"]) == 1


def test_no_shuffle_of_the_stored_index(spark):
    """After a refresh the index tables still feed their joins from their buckets."""
    rows = stage_table(person.prepare_register(fx.register(spark, SF_SMALL)), "rix-rows")
    index = RegisterIndex(spark, scratch_path(spark, "rix-plan"), 0.9, buckets=8)
    index.refresh(rows.limit(rows.count() - 3))
    side = index.refresh(rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = person.name_pairs(person.prepare_pending(fx.pending(spark, SF_SMALL)), side)
        text = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in text and "Bucketed: false (disabled" not in text


def test_a_bucket_is_one_file_of_many_tasks(spark):
    """Tasks times buckets files would grow with the square of the shuffle partitions; a bucket is one file of a load."""
    rows = person.prepare_register(fx.register(spark, SF_SMALL)).repartition(6)
    path = scratch_path(spark, "few-files")
    RegisterIndex(spark, f"{path}/refreshed", C.NAME_THRESHOLD, buckets=4).refresh(rows)
    person.RegisterSide(rows, C.NAME_THRESHOLD).save_bucketed(f"few_files_{path[-12:]}", f"{path}/saved", 4)
    for folder in (f"{path}/saved", *glob.glob(f"{path.removeprefix('file:')}/refreshed/base-*")):
        for part in ("rows", "two_key", "names/values", "names/variants"):
            assert 1 <= len(glob.glob(f"{folder.removeprefix('file:')}/{part}/*.parquet")) <= 4

"""The driver contract in __spark_entry__.py."""

from __future__ import annotations

import importlib.util
import os

from conftest import ROOT


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_smoke(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    assert df.columns == ["death_main_id", "rc_no", "rc_name", "rc_father_name", "rc_blockmunicipalitycode",
                          "rc_category", "district", "branch"]
    assert df.count() >= 0
    assert mod.entry(spark).schema == df.schema


def test_queries_and_oracles_align():
    mod = _entry_module()
    q, o = mod.queries(), mod.oracle_sql()
    core = mod.QUERIES
    assert set(core) <= set(q) and set(core) <= set(o) and set(o) <= set(q)
    assert all(callable(fn) for fn in q.values())
    assert not any(n.startswith("op") for n in core)

"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is materialised in full with the ``noop`` sink (no collect to the
driver).  ``value`` is the sum over the headline queries; every registered
query is timed and reported under ``queries``.  ``BENCH_QUERIES`` (comma
list) restricts the run; ``BENCH_NAIVE=1`` also times the naive cross-join
form of the two-key person match for the fast-path/naive ratio;
``BENCH_PAIRS=1`` reports candidate vs verified pairs of the name index.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["person_evidence", "name_father_match", "name_father_chained", "name_match",
            "block_match", "pin_match", "unmatched", "scorecard", "pending_chunks", "match_counts"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from reglink.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    from reglink.plans.catalog import QUERIES

    wanted = os.environ.get("BENCH_QUERIES")
    names = [n for n in QUERIES if not wanted or n in wanted.split(",")]
    # warm-up on the smallest scale: JIT, codegen caches, Python workers
    warm_dir = os.environ.get("BENCH_WARMUP_SF_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    extra = {}
    if os.environ.get("BENCH_NAIVE") == "1":
        extra["naive_name_father_sec"] = naive_name_father(spark, sf_dir)
    if os.environ.get("BENCH_PAIRS") == "1":
        extra["name_pairs"] = name_pair_counts(spark, sf_dir)

    headline = [n for n in HEADLINE if n in times] or list(times)
    total = round(sum(times[n] for n in headline), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus),
                      "all_queries_sec": round(sum(times.values()), 3), **extra}))


def name_pair_counts(spark, sf_dir: str) -> dict:
    """Candidate vs verified pairs of the name edit index."""
    from pyspark.sql import functions as F

    from reglink.operators import person
    from reglink.operators.edit_join import EditIndex
    from reglink.sources import fixtures as fx
    p = person.prepare_pending(fx.pending(spark, sf_dir))
    r = person.prepare_register(fx.register(spark, sf_dir))
    p2 = p.where(~F.col("name_only") & (F.length("p_name") > 0) & (F.length("p_father") > 0))
    r2 = r.where((F.length("r_name") > 0) & (F.length("r_father") > 0))
    left = p2.select(F.col("p_name").alias("a")).where(F.length("a") > 0).distinct()
    out = {"left_distinct": left.count(), "right_distinct": r2.select("r_name").distinct().count()}
    for metric in ("levenshtein", "damerau"):
        ix = EditIndex(r2.select(F.col("r_name").alias("b")), 0.9, metric=metric)
        out[metric] = {"candidates": ix.candidates(left, "a").count(), "verified": ix.probe(left).count()}
    return out


def naive_name_father(spark, sf_dir: str) -> float:
    """The reference's form: every pending record against every register row."""
    from pyspark.sql import functions as F

    from reglink.functions.similarity import edit_within
    from reglink.operators import person
    from reglink.sources import fixtures as fx
    p = person.prepare_pending(fx.pending(spark, sf_dir))
    r = person.prepare_register(fx.register(spark, sf_dir))
    p2 = p.where(~F.col("name_only") & (F.length("p_name") > 0) & (F.length("p_father") > 0))
    r2 = r.where((F.length("r_name") > 0) & (F.length("r_father") > 0))
    cond = edit_within(p2.p_name, r2.r_name, 0.9) & edit_within(p2.p_father, r2.r_father, 0.9)
    t0 = time.perf_counter()
    p2.join(r2, cond).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


if __name__ == "__main__":
    main()

"""The corpus pipeline: every stage against a plain version of what it keeps."""

from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from llm_small import documents, words
from reglink.llm import jaccard, quality, resampling
from reglink.llm.stage import stage
from reglink.session import scratch_path
from test_llm_corpus_ops import shingles
from test_llm_text_ops import _base, _cover, _pieces

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_each_stage(spark):
    held = {"input": spark.read.parquet(f"{SF}/documents.parquet").select(COLUMNS)}
    docs = held["input"]
    for name, step in pipeline.STAGES:
        docs = held[name] = stage(step(spark, docs, SF), name)
    names = ["input", *(n for n, _ in pipeline.STAGES)]
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "substring_dedup", "best_fit_packing"]
    for n in names[:-1]:
        assert held[n].columns == COLUMNS and held[n].schema == held["input"].schema
    rows = {n: _rows(held[n]) for n in names[:-1]}

    # 6: what resampling selected, unchanged; labelled bad ones go, labelled good ones stay
    verdict = resampling.resample(held["input"], spark.read.parquet(f"{SF}/labels.parquet"))
    chosen = {r.doc_id for r in verdict.where("selected").collect()}
    assert {i: tuple(r) for i, r in rows["quality_classifier"].items()} == {i: tuple(r) for i, r in rows["input"].items() if i in chosen}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1 and words(rows["input"][i].text)]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in chosen for i in good) >= 0.95 * len(good) and sum(i in chosen for i in bad) <= 0.2 * len(bad)

    # 3: the rules, from their definition
    rules = quality.Rules()

    def keeps(t):
        b = _base(t)
        most = max(b[1], 1)
        return not (b[0] < 50 or 100 * b[4] > 50 * b[0] or b[2] > rules.symbol_share * most
                    or any(_cover(t, n) > s * most for n, s in rules.ngram_share.items()))
    want = {i for i, r in rows["quality_classifier"].items() if keeps(r.text)}
    got = set(rows["quality_rules"])
    assert got <= want and all(_base(rows["quality_classifier"][i].text)[3] > 0 for i in want - got)

    # 5: the smallest id of each component
    sets = {i: shingles(r.text) for i, r in rows["quality_rules"].items()}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if y < x and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                p, q = find(x), find(y)
                top[max(p, q)] = min(p, q)
    assert set(rows["near_duplicates"]) == {find(i) for i in ids}

    # 7: words that a window of a smaller id covers
    before, after = rows["near_duplicates"], rows["substring_dedup"]
    first = {}
    for i in sorted(before, reverse=True):
        w = words(before[i].text)
        for p in range(len(w) - 12):
            first[tuple(w[p:p + 13])] = i
    for i, r in before.items():
        w = words(r.text)
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if first[tuple(w[p:p + 13])] < i:
                gone[p:p + 13] = [True] * 13
        if all(gone):
            assert i not in after
        elif any(gone):
            text = b" ".join(x for x, g in zip(w, gone) if not g).decode()
            assert after[i].text == text and after[i].n_chars == len(text) and after[i].lang == r.lang
        else:
            assert tuple(after[i]) == tuple(r)

    # 2: every token of what is left, in pieces that fit
    packed = held["best_fit_packing"].collect()
    sizes = Counter()
    for r in packed:
        sizes[r.sequence_id] += r.length
    assert max(sizes.values()) <= 1024
    lengths = Counter()
    for r in packed:
        lengths[r.doc_id] += r.length
    assert set(lengths) == set(after)
    assert Counter((r.doc_id, r.start, r.length) for r in packed) == Counter((i, s, n) for i, total in lengths.items() for s, n in _pieces(total))


def test_run_is_the_last_stage(spark):
    out = pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
    digest = hashlib.sha256("".join(sorted(str(r.ids_crc32) for r in out.select("ids_crc32").collect())).encode()).hexdigest()
    again = hashlib.sha256("".join(sorted(str(r.ids_crc32) for r in pipeline.run(spark, SF).select("ids_crc32").collect())).encode()).hexdigest()
    assert digest == again and out.select(F.count_distinct("sequence_id")).first()[0] > 0


AWKWARD = ["_id", "_hash", "_null_text", "_text", "_g", "root", "kept_text", "n_words"]


def _awkward(spark):
    """The small documents with nulls, blanks, long texts and repeated rows, and columns named like those used inside."""
    docs = documents(spark).select(COLUMNS)
    return docs.select("*", *(F.concat(F.lit(f"{c}:"), F.coalesce("doc_id", F.lit(-1)).cast("string")).alias(c) for c in AWKWARD))


def _bag(rows):
    return Counter(tuple(r) for r in rows)


def test_stages_on_awkward_rows(spark):
    docs = stage(_awkward(spark), "awkward")
    rows = docs.collect()
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    verdict = stage(resampling.resample(docs, labels), "verdict")
    chosen = {(r.doc_id, r.text_hash) for r in verdict.where("selected").collect()}
    hashed = docs.select("*", F.xxhash64("text").alias("h")).collect()
    want = _bag(tuple(r)[:-1] for r in hashed if r.text is not None and (r.doc_id, r.h) in chosen)
    assert want and _bag(resampling.keep_selected(docs, verdict).collect()) == want

    good = Counter(r.doc_id for r in quality.quality_rules(docs).where("kept").collect())
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and not _bag(kept.collect()) - _bag(rows)
    assert Counter(r.doc_id for r in kept.collect()) == good and sum(good.values()) > 20

    found = stage(jaccard.near_duplicates(docs), "found")
    heads = {r.doc_id for r in found.collect() if r.n_shingles and r.doc_id == r.component_id}
    first = jaccard.keep_first(docs, found)
    assert first.columns == docs.columns
    got = first.collect()
    assert not _bag(got) - _bag(rows)
    bare = [r for r in rows if not words(r.text)]
    assert _bag(r for r in got if not words(r.text)) == _bag(bare)
    assert Counter(r.doc_id for r in got if words(r.text)) == Counter(heads)

    cut = pipeline.substring_dedup(spark, docs, SF)
    assert cut.columns == docs.columns
    assert all(getattr(r, c) == f"{c}:{-1 if r.doc_id is None else r.doc_id}" for r in cut.collect() for c in AWKWARD)


def test_no_documents(spark):
    held = scratch_path(spark, "no-documents")
    documents(spark, []).select(COLUMNS).write.parquet(f"{held}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{held}/labels.parquet")
    out = pipeline.run(spark, held)
    assert out.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)

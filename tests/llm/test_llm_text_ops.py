"""Sentence pieces, packing, quality rules, licences: against the libraries and plain versions."""

from __future__ import annotations

import dataclasses
import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_small import documents, empty, texts, words
from reglink.llm import licenses, packing, quality
from reglink.llm import sentencepiece_lattice as lattice

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_slices_of_a_batch_have_their_own_words():
    import pyarrow as pa

    from reglink.llm import resampling
    from reglink.llm.words import flat, slices, split

    texts_ = [t for _, t in texts()] * 3
    column = pa.array(texts_, pa.string())
    ranges = list(slices(column, 3000))
    assert ranges[0][0] == 0 and ranges[-1][1] == len(texts_) and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    ids = packing.load_encoders(BPE)
    for lo, hi in ranges:
        cut = column.slice(lo, hi - lo)
        assert flat(cut).to_pylist() == [t or "" for t in texts_[lo:hi]]
        w = split(cut, lower=True)
        raw = w.vocab.to_pylist()
        assert [[raw[i] for i in w.ids[a:b]] for a, b in zip(w.off[:-1], w.off[1:])] == [words(t, lower=True) for t in texts_[lo:hi]]
        m = quality.measure(flat(cut), [5, 7])
        assert list(zip(*(m[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))) == [_base(t) for t in texts_[lo:hi]]
        assert m["cover_5"].tolist() == [_cover(t, 5) for t in texts_[lo:hi]]
        got, at = packing.encode_ids(flat(cut), ids)
        assert [got[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids[0].encode(t or "", add_special_tokens=False).ids for t in texts_[lo:hi]]
        f, doc = resampling._features(flat(cut), 1 << 16)
        for d, t in enumerate(texts_[lo:hi]):
            one, _ = resampling._features(flat(pa.array([t], pa.string())), 1 << 16)
            assert sorted(f[doc == d].tolist()) == sorted(one.tolist())


# --- 1: sentence pieces -------------------------------------------------------

def test_numpy_merges_equal_the_fold(spark):
    """The merges of a bucket at once against the higher-order fold over the same lattice, on the corpus's own units and odd ones."""
    model = lattice.load_model(PIECES)
    pieces = lattice.piece_table(spark, model)
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30).collect()
    units = sorted({u for r in text for u in lattice.UNIT.findall(lattice.normalise(r.text or ""))})[::7]
    units += ["▁aaaaaaaaaa", "▁日本語", "\U0001f600x", "é" * 40, "▁", "▁▁▁x", "ab" * 60, "\x00\x01"]
    units = sorted({u for u in units if 0 < len(u) <= lattice.MAX_UNIT})
    rows = spark.createDataFrame([(i % 3, i // 3, u) for i, u in enumerate(units)], "b int, u int, unit string")
    want = {r.unit: r.ids for r in lattice.encode_units(rows.select("b", "unit"), model, pieces).collect()}
    got = {}
    for b in range(3):
        own = lattice.edge_rows(rows.where(F.col("b") == b), pieces, model.longest).toPandas()
        n = len(units[b::3])
        unit, what, _ = lattice.merge_edges(own.u.to_numpy().astype(np.int64), own.edge.to_numpy(), np.array(model.scores), n, model.longest)
        sizes, ids = lattice.edge_ids(unit, what, model, n)
        got |= dict(zip(units[b::3], (x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1]))))
    assert got == want


def test_units_without_their_mark():
    for t in [t or "" for _, t in texts()] + ["a  b", " a", "a ", "  ", " ", "▁x ▁y", "\n a\n", "a▁▁b"]:
        assert lattice.units_of(t) == [u[1:] for u in lattice.UNIT.findall(lattice.normalise(t))]


def test_units_of_many_texts_are_those_of_each():
    import pyarrow as pa

    odd = [t or "" for _, t in texts()] + ["a  b", " a", "a ", "  ", " ", "▁x ▁y", "\n a\n", "a▁▁b", "plain words", ""]
    for own in (odd, odd[-2:-1], [""], [], ["a b"] * 3):
        units, which, off = lattice.units_of_all(pa.array(own, pa.string()))
        raw = units.to_pylist()
        assert raw == sorted({u for t in own for u in lattice.units_of(t)})
        assert [[raw[i] for i in which[a:b]] for a, b in zip(off[:-1], off[1:])] == [lattice.units_of(t) for t in own]
        assert lattice._unpacked(lattice._packed(units)).equals(units)
        assert lattice._unpacked(lattice._packed(units.slice(1))).to_pylist() == raw[1:]


def test_pieces_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = lattice.load_model(PIECES)
    docs = documents(spark)
    got = lattice.encode_documents(docs, model, lattice.piece_table(spark, model), with_ids=True, group_bytes=20000, bucket_units=500)
    got = sorted((r.doc_id or -1, r.n_pieces, r.ids_crc32, tuple(r.ids), r.round_trip) for r in got.collect())
    want = []
    for i, t in texts():
        ids = sp.encode(t or "")
        want.append((i or -1, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), tuple(ids), True))
    assert got == sorted(want)
    of = model.bytes_of()
    assert all(lattice.decode(sp.encode(t or ""), of) == (t or "") for _, t in texts())
    assert lattice.encode_documents(empty(spark), model, lattice.piece_table(spark, model)).count() == 0


def _viterbi(unit: str, scores: dict[str, float], unknown: float) -> list[str]:
    best = [(0.0, 0, 0, "")]
    for end in range(1, len(unit) + 1):
        ways = []
        for start in range(end):
            piece = unit[start:end]
            if best[start] is not None and (piece in scores or len(piece) == 1):
                ways.append((best[start][0] + scores.get(piece, unknown), -(best[start][1] + 1), -start, piece))
        top = max(ways)
        best.append((top[0], -top[1], -top[2], top[3]))
    out, at = [], len(unit)
    while at:
        out.append(best[at][3])
        at = best[at][2]
    return out[::-1]


def test_unigram_fold_is_viterbi(spark):
    model = lattice.Model(["<unk>", "▁", "a", "b", "ab", "ba", "aba", "▁a", "abab", "bb"], [0, -3.0, -2.0, -2.5, -3.0, -3.0, -4.0, -4.5, -7.5, -6.0],
                          [False] + [True] * 9, 0, -1, False)
    units = ["▁a", "▁abab", "▁aba", "▁bbbb", "▁xab", "▁", "▁" + "ab" * 9]
    rows = spark.createDataFrame([(0, u) for u in units], "b int, unit string")
    got = {r.unit: r.ids for r in lattice.encode_units(rows, model, lattice.piece_table(spark, model)).collect()}
    scores = {p: s for p, s, n in zip(model.pieces, model.scores, model.normal) if n}
    index = {p: i for i, p in enumerate(model.pieces)}
    assert got == {u: [index.get(p, 0) for p in _viterbi(u, scores, min(model.scores) - 10)] for u in units}


def test_long_unit_outside_the_lattice_has_the_same_merges(spark):
    model = lattice.load_model(PIECES)
    index = {p: i for i, (p, ok) in enumerate(zip(model.pieces, model.normal)) if ok}
    units = ["▁internationalisation", "▁thnterononshth", "▁日é", "▁aaaaaaaaa"]
    rows = spark.createDataFrame([(0, u) for u in units], "b int, unit string")
    got = {r.unit: r.ids for r in lattice.encode_units(rows, model, lattice.piece_table(spark, model)).collect()}
    assert got == {u: lattice.merge_long(u, model, index) for u in units}


# --- 2: packing ---------------------------------------------------------------

def _pieces(n: int, size: int = 1024) -> list[tuple[int, int]]:
    first = (n - 1) % size + 1
    return [(0, first), *((s, size) for s in range(first, n, size))]


def test_packing_pieces_and_bins(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    got = packing.pack_documents(documents(spark), BPE, block_pieces=40).collect()
    want = Counter()
    for i, t in texts():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for k, (start, length) in enumerate(_pieces(len(ids))):
            want[(i, k, start, length, zlib.crc32(ids[start:start + length].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for rows in bins.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in got)
    blocks = -(-len(got) // 40)
    assert len(bins) <= total / 1024 * 1.1 + 2 * blocks
    assert packing.pack_documents(empty(spark), BPE).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(rule):
    rng = np.random.default_rng(1)
    length = np.sort(rng.integers(1, 1025, 3000))[::-1]
    bins = packing.best_fit(length, 1024, 5, 400_000.0, (1.0, 0.2, 0.5), rule)
    assert (np.bincount(bins, weights=length) <= 1024).all()
    assert np.bincount(bins).max() <= 5
    cost = np.bincount(bins, weights=length.astype(float) ** 2)
    alone = np.bincount(bins) == 1
    assert (cost[~alone] <= 400_000).all()
    free = packing.best_fit(length, 1024, 1024, 1024.0 ** 2)
    assert free.max() + 1 <= length.sum() / 1024 * 1.02 + 1


# --- 3: quality rules -----------------------------------------------------------

def _base(text: str | None) -> tuple[int, ...]:
    w = words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit)


def _cover(text: str | None, n: int) -> int:
    w = words(text)
    grams = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    hit = set()
    for i in range(len(w) - n + 1):
        if grams[tuple(w[i:i + n])] > 1:
            hit |= set(range(i, i + n))
    return sum(len(w[i].decode()) for i in hit)


def test_quality_counts(spark):
    got = Counter(tuple(r) for r in quality.quality_rules(documents(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cover_5", "cover_7", "cover_10").collect())
    want = Counter()
    for i, t in texts():
        b = _base(t)
        want[(i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0], _cover(t, 5), _cover(t, 7), _cover(t, 10))] += 1
    assert got == want
    out = quality.quality_rules(documents(spark))
    assert out.where("base_failed AND kept").count() == 0
    assert quality.quality_rules(empty(spark)).count() == 0


def test_quality_rejects_repetition_and_keeps_prose(spark):
    rng = np.random.default_rng(2)
    prose = " ".join(f"v{i}" for i in rng.integers(0, 5000, 300))
    block = " ".join(f"u{i}" for i in rng.integers(0, 5000, 100))
    docs = documents(spark, [(1, prose), (2, "\n".join([block] * 4)), (3, " ".join(f"{w}###" for w in prose.split()))])
    assert {r.doc_id: r.kept for r in quality.quality_rules(docs).collect()} == {1: True, 2: False, 3: False}
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def test_ngram_and_line_limits_reject_below_the_base_rule(spark):
    own = [f"v{i:04d}" for i in range(400)]

    def twice(n: int, total: int) -> str:       # two passages of n words, each of them twice
        p, q, rest = own[:n], own[n:2 * n], own[2 * n:total - 2 * n]
        return " ".join([*p, rest[0], *q, rest[1], *p, rest[2], *q, *rest[3:]])

    lines = [" ".join(own[4 * i:4 * i + 4]) for i in range(14)]
    totals = {5: 66, 6: 82, 7: 104, 8: 128, 9: 156, 10: 190}
    rows = [(n, twice(n, total)) for n, total in totals.items()]
    rows += [(20, "\n".join([*lines, *lines[3::-1]])), (30, twice(10, 210)), (31, "\n".join([*lines, *lines[2::-1]]))]
    got = {r.doc_id: r for r in quality.quality_rules(documents(spark, rows)).collect()}
    rules = quality.Rules()
    over = {i: [n for n, share in rules.ngram_share.items() if r[f"cover_{n}"] > share * r.word_chars] for i, r in got.items()}
    line = {i: r.dup_line_chars > rules.line_share * r.word_chars for i, r in got.items()}
    assert not any(r.base_failed or r.n_symbols for r in got.values())
    assert over == {n: [n] for n in totals} | {20: [], 30: [], 31: []}
    assert {i for i in line if line[i]} == {20}
    assert {i for i, r in got.items() if r.kept} == {30, 31}


# --- 4: licences ------------------------------------------------------------------

def test_license_scan(spark):
    mit = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + licenses.MIT.replace("sublicense", "sub-license").upper()
    rows = [(1, mit), (2, "Some prose.\nReleased under the MIT licence!\nreleased under the mit license\nLicensed under CC BY 4.0"), (3, None),
            (4, ""), (5, "no notice here"), (5, "no notice here"), (None, "SPDX-License-Identifier: ISC"), (7, "(c) 2019 A\n© 2020 B\n" + licenses.ISC)]
    known = licenses.known_digests(spark, licenses.KNOWN_LICENSES)
    got = Counter((r.doc_id, r.text_license, r.n_notices, r.notice_licenses) for r in licenses.license_scan(documents(spark, rows), known).collect())
    assert got == Counter({(1, "MIT", 0, ""): 1, (2, None, 2, "CC-BY-4.0,MIT"): 1, (3, None, 0, ""): 1, (4, None, 0, ""): 1, (5, None, 0, ""): 2,
                           (None, "ISC", 1, "ISC"): 1, (7, "ISC", 0, ""): 1})
    assert licenses.license_scan(empty(spark), known).count() == 0
    assert licenses.license_scan(documents(spark), known.limit(0)).where("text_license IS NOT NULL").count() == 0


def license_cases() -> tuple[list, list]:
    lines = ["Copyright (c) Jane Doe", "Copyright (c) Facebook, Inc. and its affiliates", "Copyright [year] [owner]", "Copyright (c)  2020", "copyright Jane Doe",
             "# Copyright 2020 Jane", "// All rights reserved.", " * (c) Jane Doe", "© Jane Doe", "<!-- Copyright: Jane Doe -->", "Copyright © Jane", "(C) 2020 Jane"]
    curly = licenses.MIT.replace('"AS IS"', "“AS IS”").replace("free of charge", "free\u00a0of\u2003charge").replace("and/or", "and\u2010or")
    rows = [(i, f"{line}\n\n{licenses.MIT}") for i, line in enumerate(lines)]
    rows += [(100, curly), (101, "\n".join("# " + x for x in ["Copyright (c) Jane", *licenses.ISC.split("\n")])),
             (102, licenses.MIT.replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS").replace("copyright notice", "\ncopyright notice"))]
    other = [(200, "copyright notice alone\n" + licenses.MIT), (201, "(b) a point\n(c) another point\n" + licenses.MIT), (202, "Jane Doe\n" + licenses.MIT)]
    return rows, other


def test_license_scan_sees_through_copyright_lines_and_typography(spark):
    rows, other = license_cases()
    known = licenses.known_digests(spark, licenses.KNOWN_LICENSES)
    got = {r.doc_id: r.text_license for r in licenses.license_scan(documents(spark, rows + other), known).collect()}
    assert got == {i: "ISC" if i == 101 else "MIT" for i, _ in rows} | {i: None for i, _ in other}


def test_license_scan_equals_sql(spark):
    rows = [(i, t) for i, t in texts() if t is None or "\x00" not in t] + [(900, "a\nLicensed under the Apache License, Version 2.0.\nb")]
    marked, other = license_cases()
    rows += [(1000 + i, t) for i, t in marked + other]
    rows += [(2000 + i, t) for i, (_, t) in enumerate(licenses.KNOWN_LICENSES)]
    rows += [(3000 + i, f"x\n# {t}\n{t.upper()}") for i, (_, t) in enumerate(licenses.KNOWN_LICENSES) if "\n" not in t]
    rows += [(4000, "— Licensed under “CC BY 4.0” —\n(c) Jane"), (4001, "copyright owner means\nLicence: spdx license identifier mit"), (4002, "(c) 2020 Jane"), (4003, "copyright noticed by x\nSPDX-License-Identifier: MIT")]
    docs = documents(spark, rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cols = ["doc_id", "text_digest", "text_license", "n_notices", "notice_licenses"]
    want = Counter(con.execute(f"SELECT {', '.join(cols)} FROM ({licenses.license_sql()})").fetchall())
    got = Counter(tuple(r) for r in licenses.license_scan(docs, licenses.known_digests(spark, licenses.KNOWN_LICENSES)).select(cols).collect())
    assert got == want


def test_gate_words_stand_in_every_text_of_a_digest(spark):
    known = licenses.known_digests(spark, licenses.KNOWN_LICENSES)
    gates = {r.gate for r in known.collect()}
    assert "" not in gates and 3 < len(gates) < 30
    spelt = [(f"{a}", f"{b}") for a, b in licenses.KNOWN_LICENSES]
    for old, new in licenses.SPELLINGS:
        spelt += [(a, b.replace(new, old)) for a, b in licenses.KNOWN_LICENSES if new in b]
    rows = spark.createDataFrame([(b, b.upper()) for _, b in spelt], "text string, loud string")
    assert rows.where(~licenses._may_match(F.col("text"), sorted(gates)) | ~licenses._may_match(F.col("loud"), sorted(gates))).count() == 0
    own = spark.createDataFrame([("Centre organisation licence",), ("the fox",)], "text string").select(licenses._gate(F.col("text")).alias("g"))
    assert [r.g for r in own.collect()] == ["", "the"]


def test_canonical_spelling(spark):
    df = spark.createDataFrame([("The  LICENCE,\n(c) 2020 X\n-- organisation--",)], "t string").select(licenses.canonical(F.col("t")).alias("c"))
    assert df.first().c == "the license organization"
    assert len(hashlib.sha256(b"").hexdigest()) == 64

"""Quality rules: size, symbols, and how much of a text repeats itself.

``mapInArrow`` beside the scan, no shuffle.  Words become integers per batch; an
n-gram is a rolling hash over them.  A repeated n-gram's first n - 1 words are a
repeated shorter n-gram, so each longer length looks only at places where the
shorter one repeated: clean text costs one sort per base window.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reglink.llm.words import MIX, flat, mix, rolling, slices, spans_mask, split, window_starts

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict; shares are of the characters in words.

    ``ngram_share`` is the largest allowed share of characters inside n-grams that
    the text holds more than once (every occurrence counts, each character once): twice
    the usual limits for later copies, 0.15 (5) to 0.10 (10).  ``line_share`` counts later
    copies only.  Both lie below what ``repeat_percent`` rejects."""

    min_words: int = 50
    repeat_percent: int = 50
    symbol_share: float = 0.03
    line_share: float = 0.20
    ngram_share: dict[int, float] = field(default_factory=lambda: {
        5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20})


OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, kept boolean, dup_line_chars long")


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the keys that occur more than once."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order] = np.r_[False, same] | np.r_[same, False]
    return out


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum per document."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[off[1:]] - total[off[:-1]]


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters of their words."""
    seen = Counter(text.split("\n"))
    if len(seen) == text.count("\n") + 1:
        return 0, 0
    n = chars = 0
    for line, times in seen.items():
        if times > 1 and (words := line.encode().split()):
            n += times - 1
            chars += (times - 1) * sum(len(w.decode()) for w in words)
    return n, chars


def measure(text: pa.Array, lengths: list[int]) -> dict[str, np.ndarray]:
    """Counts per text; ``cover_n`` is the characters inside repeated n-grams."""
    w = split(text)
    total, doc = len(w.ids), w.doc
    chars_of = pc.utf8_length(w.vocab.cast(pa.large_string())).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = chars_of[w.ids] if total else np.zeros(0, np.int64)
    out = {"n_words": np.diff(w.off), "word_chars": _sums(chars, w.off)}
    out["n_symbols"] = pc.count_substring_regex(text, f"[{SYMBOLS}]").to_numpy(zero_copy_only=False).astype(np.int64)
    lines = [_lines(t) for t in text.to_pylist()]
    out["n_dup_lines"] = np.array([a for a, _ in lines], np.int64)
    out["dup_line_chars"] = np.array([b for _, b in lines], np.int64)
    # 3-word windows by exact integer keys: pairs first, so that keys stay below 2**63
    ok = window_starts(w.off, 3)
    at = np.flatnonzero(ok)
    size = len(w.vocab) + 1
    _, pair = np.unique(w.ids[at] * size + w.ids[at + 1], return_inverse=True) if len(at) else (None, at)
    _, gram = np.unique(pair * size + w.ids[at + 2], return_inverse=True) if len(at) else (None, at)
    grams = int(gram.max()) + 1 if len(at) else 1
    hit = at[_repeated(doc[at] * grams + gram)]
    out["n_repeat_words"] = _sums(spans_mask(hit, 3, total).astype(np.int64), w.off)
    tokens = w.tokens
    place, prev = hit, 3
    for n in sorted(lengths):
        if total >= n and len(place):
            place = place[place <= total - n]
            place = place[doc[place] == doc[place + n - 1]]
            h = np.zeros(len(place), np.uint64)
            for i in range(n):
                h = h * MIX + tokens[place + i]
            place = place[_repeated(mix(h) ^ mix(doc[place].astype(np.uint64) * MIX))]
            out[f"cover_{n}"] = _sums(np.where(spans_mask(place, n, total), chars, 0), w.off)
        else:
            place = place[:0]
            out[f"cover_{n}"] = np.zeros(len(w.off) - 1, np.int64)
    return out


def _verdict(m: dict[str, np.ndarray], rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """``base_failed`` and ``kept`` of measured texts."""
    base = (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.repeat_percent * m["n_words"])
    most = np.maximum(m["word_chars"], 1)
    bad = base | (m["n_symbols"] > rules.symbol_share * most) | (m["dup_line_chars"] > rules.line_share * most)
    for n, share in rules.ngram_share.items():
        bad = bad | (m[f"cover_{n}"] > share * most)
    return base, ~bad


def quality_rules(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One row per row of ``docs``: the base counts, ``base_failed``, the characters in
    repeated lines (``dup_line_chars``) and in repeated n-grams (``cover_n``), and ``kept``.

    Null text counts as empty: no words, base failed.  Only ``doc_id`` and ``text`` are read."""
    rules = rules or Rules()
    lengths = sorted(rules.ngram_share)
    schema = OUT + "".join(f", cover_{n} long" for n in lengths)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                m = measure(flat(batch.column("text").slice(lo, hi - lo)), lengths)
                m["base_failed"], m["kept"] = _verdict(m, rules)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), *(pa.array(m[k]) for k in names[1:])], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Rows of ``docs`` that the rules keep, columns unchanged.

    Each row is judged by its own text: repeated rows stay or go together; null, empty and blank texts have no word and go."""
    rules = rules or Rules()
    lengths = sorted(rules.ngram_share)

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                cut = batch.slice(lo, hi - lo)
                yield cut.filter(pa.array(_verdict(measure(flat(cut.column("text")), lengths), rules)[1]))

    return docs.mapInArrow(run, docs.schema)

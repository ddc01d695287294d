"""Language identification by bit-sliced Bloom filters of character n-grams.

* A text becomes its letters in lower case (one code point for one), every run of anything else
  one blank, one blank before and after; its n-grams are all windows of 1 to 4 code points but
  the lone blank.
* Learning counts n-grams per language over all training documents, by slot (the top bits of
  a 64-bit hash).  A language's set holds its most frequent n-grams (at most ``members``) whose
  rate is at least a ``ratio``-th of the highest rate that any language gives them.
* The sets become one filter: row p holds a bit for each language whose Bloom filter has bit p
  set.  ``hashes`` rows, AND-ed, are the bitmask of all languages that contain an n-gram.
* A text's n-grams are looked up; the per-language popcount c of n masks holds about
  p * (n - t) chance hits, p being the language's false-positive rate (its filter's fill to
  the power ``hashes``, and n-grams that share a slot), so t = (c - p n) / (1 - p) is what
  decides.  Ties: the language of more training documents, then the smaller name.

Every step is a scan with a fixed-size state; the counts' rows are bounded per task by languages
x slots, the filter by its rows x languages / 8 bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reglink.llm.words import flat, mix, slices

SIZES = (1, 2, 3, 4)
SLOT_BITS = 22
ROW_BITS = 18
HASHES = 4
MEMBERS = 20_000
RATIO = 4.0
MAX_LANGUAGES = 1024          # bounds the filter at 32 MiB
HELD_LANGUAGES = 6            # whose counts a counting task holds at once
CHUNK = 1 << 20               # code points of a long text at a time
LAST_LETTER = 0x33480         # no letter lies beyond (CJK extension H and its end)
STEP = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"
TEXT_BYTES = 1 << 20          # of a slice that is looked up at once: its arrays stay small
GROUP = 8                     # languages whose bits are counted at once


def held_out(modulus: int = 4, remainder: int = 2) -> Column:
    """Held out: crc32 of the id's decimal text has this remainder (a null id: the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def letters() -> np.ndarray:
    """What each code point becomes: a letter its lower case of one code point, all else a blank."""
    out = np.full(LAST_LETTER + 2, 32, np.uint32)
    for c in map(chr, range(LAST_LETTER + 1)):
        if c.isalpha():
            low = c.lower()
            out[ord(c)] = ord(low) if len(low) == 1 and low.isalpha() else ord(c)
    return out


@dataclass
class Folded:
    """Folded code points of parts of texts; ``doc`` numbers the texts, ``part`` the parts; a window counts
    where its last code point is ``fresh``."""

    points: np.ndarray
    doc: np.ndarray
    part: np.ndarray
    fresh: np.ndarray | None


def _collapse(points: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Mask that leaves one blank of each run of blanks inside a part."""
    blank = points == 32
    again = np.zeros(len(points), bool)
    again[1:] = blank[1:] & blank[:-1] & (part[1:] == part[:-1])
    return ~again


def folded(texts: list[str], fold: np.ndarray, chunk: int = CHUNK):
    """``Folded`` parts of all texts: short texts together, a long one by chunks that overlap by the longest
    n-gram less one, so no array is longer than a batch of short texts or a chunk."""
    short = [(d, t) for d, t in enumerate(texts) if 0 < len(t) <= chunk]
    if short:
        size = np.array([len(t) + 2 for _, t in short])
        raw = np.frombuffer(" ".join(f" {t} " for _, t in short).encode("utf-32-le"), np.uint32)
        at = np.ones(len(raw), bool)
        at[np.cumsum(size + 1)[:-1] - 1] = False                # the joining blank
        points = fold[np.minimum(raw[at], LAST_LETTER + 1)]
        part = np.repeat(np.arange(len(short)), size)
        keep = _collapse(points, part)
        yield Folded(points[keep], np.array([d for d, _ in short])[part[keep]], part[keep].astype(np.int32), None)
    for d, t in enumerate(texts):
        if len(t) <= chunk:
            continue
        tail = np.array([32], np.uint32)
        fresh_from = 0
        for lo in range(0, len(t), chunk):
            own = fold[np.minimum(np.frombuffer(t[lo:lo + chunk].encode("utf-32-le"), np.uint32), LAST_LETTER + 1)]
            if lo + chunk >= len(t):
                own = np.append(own, np.uint32(32))
            points = np.concatenate([tail, own])
            fresh = np.arange(len(points)) >= (fresh_from and len(tail))
            keep = _collapse(points, np.zeros(len(points), np.int8))
            points, fresh = points[keep], fresh[keep]
            yield Folded(points, np.full(len(points), d), np.zeros(len(points), np.int8), fresh)
            tail, fresh_from = points[-(max(SIZES) - 1):], 1


def grams(f: Folded):
    """(hashes, documents) of the n-grams of each size."""
    h = np.zeros(len(f.points), np.uint64)
    for n in range(1, max(SIZES) + 1):
        m = len(f.points) - n + 1
        if m <= 0:
            return
        h = h[:m] * STEP + f.points[n - 1:].astype(np.uint64) + np.uint64(1)
        if n not in SIZES:
            continue
        ok = f.part[:m] == f.part[n - 1:]
        if n == 1:
            ok = f.points != 32
        if f.fresh is not None:
            ok = ok & f.fresh[n - 1:]
        yield mix(h[ok] ^ np.uint64(n << 56)), f.doc[:m][ok]


def slot_counts(training: DataFrame, slot_bits: int = SLOT_BITS) -> DataFrame:
    """(lang, slot, n) summed over all rows of (text, lang); per language slot -1 counts the documents, -2 the n-grams."""
    slots, shift = 1 << slot_bits, np.uint64(64 - slot_bits)

    def rows(lang: str, held: np.ndarray):
        at = np.flatnonzero(held)
        for lo in range(0, len(at), 1 << 20):
            cut = at[lo:lo + (1 << 20)]
            # the two places after the slots hold the totals
            names = np.where(cut >= slots, slots - cut - 1, cut)
            yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(cut), np.int32))), pa.array(names), pa.array(held[cut])],
                                             names=["lang", "slot", "n"])

    def count(batches):
        fold, sums = letters(), {}
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                cut = batch.slice(lo, hi - lo)
                texts, langs = flat(cut.column("text")).to_pylist(), np.array(cut.column("lang").to_pylist(), object)
                names, code = np.unique(langs.astype(str), return_inverse=True)
                for i, lang in enumerate(names.tolist()):
                    if lang not in sums:
                        if len(sums) >= HELD_LANGUAGES:
                            old = next(iter(sums))
                            yield from rows(old, sums.pop(old))
                        sums[lang] = np.zeros(slots + 2, np.int64)
                    own = sums[lang]
                    own[slots] += int((code == i).sum())
                    for part in folded([t for t, c in zip(texts, code) if c == i], fold):
                        found = [(h >> shift).astype(np.int64) for h, _ in grams(part)]
                        if found:
                            every = np.concatenate(found)
                            own[:slots] += np.bincount(every, minlength=slots)
                            own[slots + 1] += len(every)
        for lang, held in sums.items():
            yield from rows(lang, held)

    return training.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")) \
        .mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def member_slots(counts: DataFrame, members: int = MEMBERS, ratio: float = RATIO) -> DataFrame:
    """(lang, slot) of each language's set.  Rates are ranked by steps of 1/16 of a factor of two: a language
    takes whole steps from the top while they hold at most ``members`` n-grams."""
    totals = counts.where(F.col("slot") == -2).select(F.col("lang").alias("t_lang"), F.col("n").alias("total"))
    rated = counts.where(F.col("slot") >= 0).join(F.broadcast(totals), F.col("lang") == F.col("t_lang")).select("lang", "slot", (F.col("n") / F.col("total")).alias("rate"))
    top = rated.groupBy(F.col("slot").alias("top_slot")).agg(F.max("rate").alias("top"))
    typical = (rated.join(top, F.col("slot") == F.col("top_slot")).where(F.col("rate") * ratio >= F.col("top"))
               .select("lang", "slot", F.floor(F.log2("rate") * 16).alias("step")))
    sizes = typical.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n"))
    running = sizes.withColumn("sum", F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("step"))))
    best = Window.partitionBy("lang")
    # a first step of more than ``members`` is taken whole: a set is never empty
    lowest = (running.withColumn("first", F.max("step").over(best)).where((F.col("sum") <= members) | (F.col("step") == F.col("first")))
              .groupBy(F.col("lang").alias("s_lang")).agg(F.min("step").alias("lowest")))
    return typical.join(F.broadcast(lowest), (F.col("lang") == F.col("s_lang")) & (F.col("step") >= F.col("lowest"))).select("lang", "slot")


@dataclass
class Filters:
    """Bit-sliced filters: ``rows[g, p]`` has bit b set where language 8 g + b has bit p set."""

    langs: list[str]
    rows: np.ndarray          # uint8 (groups of 8 languages, 2 ** row_bits)
    false: np.ndarray         # a language's false-positive rate
    hashes: int
    slot_bits: int

    def masks(self, h: np.ndarray):
        """Per group of languages, the bitmask of those that contain each n-gram (by its hash)."""
        at = places(h >> np.uint64(64 - self.slot_bits), self.hashes, self.rows.shape[1])
        for own in self.rows:
            out = own[at[0]]
            for p in at[1:]:
                out &= own[p]
            yield out


def places(slot: np.ndarray, hashes: int, rows: int) -> list[np.ndarray]:
    """Rows of the filter that belong to a slot: multiply and shift, by an odd number each."""
    shift = np.uint64(64 - (rows.bit_length() - 1))
    slot = slot.astype(np.uint64) + np.uint64(1)
    return [((slot * (mix(np.array([i + 1], np.uint64)) | np.uint64(1))) >> shift).astype(np.int64) for i in range(hashes)]


def fit(docs: DataFrame, slot_bits: int = SLOT_BITS, row_bits: int = ROW_BITS, hashes: int = HASHES, members: int = MEMBERS, ratio: float = RATIO) -> Filters:
    """Filters of all documents with text and ``lang`` (null in either: not learned from)."""
    from reglink.llm.stage import stage

    training = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = stage(slot_counts(training, slot_bits), "langid-counts")
    # a language without n-grams cannot be told
    known = (counts.where(F.col("slot") == -1).select("lang", F.col("n").alias("docs"))
             .join(counts.where(F.col("slot") == -2).select(F.col("lang").alias("l"), F.col("n").alias("grams")), F.col("lang") == F.col("l"))
             .where("grams > 0").orderBy(F.desc("docs"), "lang").limit(MAX_LANGUAGES + 1).collect())
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = [r["lang"] for r in known]
    n_rows, groups = 1 << row_bits, max(1, -(-len(langs) // GROUP))
    number = {lang: i for i, lang in enumerate(langs)}

    def bits(batches):
        for batch in batches:
            slot = batch.column("slot").to_numpy().astype(np.uint64)
            code = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for at in places(slot, hashes, n_rows):
                yield pa.RecordBatch.from_arrays([pa.array((code // GROUP) * n_rows + at), pa.array(1 << (code % GROUP))], names=["cell", "mask"])

    rows = np.zeros(groups * n_rows, np.uint8)
    if langs:
        chosen = member_slots(counts, members, ratio)
        cells = chosen.mapInArrow(bits, "cell long, mask long").groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()      # at most groups x rows
        rows[cells.column("cell").to_numpy()] = cells.column("mask").to_numpy()
    rows = rows.reshape(groups, n_rows)
    fill = np.array([np.count_nonzero(rows[i // GROUP] >> (i % GROUP) & 1) / n_rows for i in range(len(langs))])
    # -n_rows ln(1 - fill) / hashes estimates the members from the filter itself
    held = -n_rows * np.log1p(-np.minimum(fill, 1 - 1 / n_rows)) / hashes
    return Filters(langs, rows, 1 - (1 - fill ** hashes) * (1 - np.minimum(1.0, held / (1 << slot_bits))), hashes, slot_bits)


def measure(texts: list[str], filters: Filters, fold: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of n-grams, and the corrected hits of each language.

    Bits are counted by mask: a text's masks of a group of languages fall into 2 ** 8 kinds."""
    size = 1 << GROUP
    bits = (np.arange(size)[:, None] >> np.arange(GROUP)[None, :]) & 1
    counts = np.zeros((len(filters.rows), len(texts) * size), np.int64)      # how often a text has each mask
    for part in folded(texts, fold, chunk):
        for h, doc in grams(part):
            key = doc * size
            for g, mask in enumerate(filters.masks(h)):
                counts[g] += np.bincount(key + mask, minlength=len(texts) * size)
    counts = counts.reshape(len(filters.rows), len(texts), size)
    n, hits = counts[0].sum(axis=1), np.concatenate(list(counts @ bits), axis=1)[:, :len(filters.langs)]
    p = filters.false[None, :]
    return n, np.maximum(0.0, hits - p * n[:, None]) / (1 - p)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``n_grams``, one row per row of ``docs``.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, or nothing was
    learned.  ``score``: the share of the text's n-grams that the language's set holds, chance hits
    taken off.  A text of which no n-gram is known goes to the language of most training documents, with score 0."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)     # fixed size

    def tell(batches):
        fold, own = letters(), shared.value
        for batch in batches:
            for lo, hi in slices(batch.column("text"), TEXT_BYTES):
                cut = batch.slice(lo, hi - lo)
                n, hits = measure(flat(cut.column("text")).to_pylist(), own, fold)
                if own.langs:
                    best = np.argmax(hits, axis=1)               # the first of equals: most training documents
                    score = np.clip(hits[np.arange(len(n)), best] / np.maximum(n, 1), 0.0, 1.0)
                    names = [own.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist())]
                else:
                    score, names = np.zeros(len(n)), [UNKNOWN] * len(n)
                yield pa.RecordBatch.from_arrays([cut.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(n)],
                                                 names=["doc_id", "lang_pred", "score", "n_grams"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tell, "doc_id long, lang_pred string, score double, n_grams long")


def identify(docs: DataFrame, is_held_out: Column) -> DataFrame:
    """``predict`` of all documents with filters learned from those not held out, and ``held_out``.

    Repeated rows and ids are rows of their own; extra columns are ignored."""
    filters = fit(docs.where(~is_held_out))
    out = predict(docs, filters)
    return out.select("doc_id", is_held_out.alias("held_out"), "lang_pred", "score", "n_grams")

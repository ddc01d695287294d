"""Spelling variants by permuterm rotations.

A word w gets a terminator; its rotations begin at each of its characters and at the terminator.  If a
word reads a c b, its rotation that ends in c is b $ a c.  Then

* words that differ in that one character share the prefix b $ a of these rotations, the edited character last;
* the word a b, without it, has the whole rotation b $ a.

So every rotation, and every rotation without its last character, is sorted by that prefix; a range of equal prefixes
holds the words near each other by an edit at this place.  It has at most one whole
rotation and one word for each character there is.  A scan of a range gives each of its members the number of
neighbours and the best other one: no pairs are formed.  A character deleted from a run of
equal ones gives the same word whichever is deleted, so such a pair counts at the run's first character only.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reglink.llm.runs import latin_runs
from reglink.llm.stage import stage
from reglink.llm.words import slices

SLICE_BYTES = 16 << 20
MARK = "$"
EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5


def _crc_shift(n: int) -> np.ndarray:
    """Tables (4 x 256): what a CRC-32 becomes by appending n zero bytes, by its bytes (it is linear over bits)."""
    zeros = bytes(n)
    base = zlib.crc32(zeros)
    bit = np.array([zlib.crc32(zeros, 1 << i) ^ base for i in range(32)], np.uint32)
    out = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for i in range(8):
            has = (np.arange(256) >> i) & 1 == 1
            out[k, has] ^= bit[8 * k + i]
    return out


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings put together, from theirs and the second one's length."""
    out = np.zeros(len(first), np.uint32)
    for n in np.unique(length).tolist():
        t, at = _crc_shift(n), np.flatnonzero(length == n)
        own = first[at]
        out[at] = t[0][own & 255] ^ t[1][(own >> 8) & 255] ^ t[2][(own >> 16) & 255] ^ t[3][own >> 24] ^ second[at]
    return out


def count_words(docs: DataFrame, every: int = EVERY, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n) of all documents, words of at least ``min_length`` code points.

    An occurrence whose CRC-32 of ``<doc_id>:<word>`` is a multiple of ``every`` loses the code
    point at the CRC modulo its length.  A null id is empty before the colon; null text has no words."""

    def count(batches):
        for batch in batches:
            for lo, hi in slices(batch.column("text"), SLICE_BYTES):
                cut = batch.slice(lo, hi - lo)
                runs = latin_runs(cut.column("text"))
                if not len(runs.ids):
                    continue
                words = runs.vocab.to_pylist()
                crc = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint32, len(words))
                size = pc.binary_length(runs.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
                points = pc.utf8_length(runs.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
                own = np.fromiter((zlib.crc32(f"{'' if i is None else i}:".encode()) for i in cut.column("doc_id").to_pylist()), np.uint32, len(cut))
                h = joined_crc(own[runs.doc], crc[runs.ids], size[runs.ids])
                hit = h % np.uint32(every) == 0
                n = np.bincount(runs.ids[~hit], minlength=len(words))
                keep = np.flatnonzero((n > 0) & (points >= min_length))
                yield pa.RecordBatch.from_arrays([runs.vocab.take(pa.array(keep)).cast(pa.string()), pa.array(n[keep])], names=["word", "n"])
                at, times = np.unique(runs.ids[hit] * (1 << 32) + (h[hit] % points[runs.ids[hit]]), return_counts=True)
                changed = []
                for x in at.tolist():
                    w, p = words[x >> 32], x & 0xFFFFFFFF
                    changed.append(w[:p] + w[p + 1:])
                long = np.array([len(w) >= min_length for w in changed], bool)
                yield pa.RecordBatch.from_arrays([pa.array(changed, pa.string()).filter(pa.array(long)), pa.array(times[long])], names=["word", "n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame, mark: str = MARK) -> DataFrame:
    """(prefix, word, n, whole, first) of each rotation: ``whole`` ones and those without their last character,
    of which ``first`` says that the character before it is another one."""
    length = F.length("word")
    at = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("i"))
    before, after = F.substring("word", F.lit(1), F.col("i")), F.substring("word", F.col("i") + 2, length)
    here, last = F.substring("word", F.col("i") + 1, F.lit(1)), F.substring("word", F.col("i"), F.lit(1))
    whole = F.struct(F.concat(F.substring("word", F.col("i") + 1, length), F.lit(mark), before).alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("first"))
    cut = F.struct(F.concat(after, F.lit(mark), before).alias("prefix"), F.lit(False).alias("whole"), ((F.col("i") == 0) | (here != last)).alias("first"))
    both = at.select("word", "n", F.explode(F.when(F.col("i") < length, F.array(whole, cut)).otherwise(F.array(whole))).alias("r"))
    return both.select("r.prefix", "word", "n", "r.whole", "r.first")


def neighbours(words: DataFrame, mark: str = MARK) -> DataFrame:
    """(word, n_near, near_n, near): per word with a near one their number and the best of them (largest n, ties:
    the smallest word).  ``words`` has distinct words; one with ``mark`` in it is an error."""
    held = words.where(F.when(F.contains("word", F.lit(mark)), F.raise_error(F.lit(f"a word holds the terminator {mark}")).cast("boolean")).otherwise(True))
    # prefixes in order: a range of equal ones lies in one partition
    rot = rotations(held, mark).repartitionByRange("prefix")
    group = Window.partitionBy("prefix")
    order = group.orderBy(F.desc("n"), "word")
    entire = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pick = F.struct((-F.col("n")).alias("m"), F.col("word").alias("w"))
    seen = rot.select("word", "whole", "first", F.row_number().over(order).alias("at"), F.count(F.lit(1)).over(entire).alias("size"),
                      F.max("whole").over(entire).alias("has_whole"), F.sum(F.when(~F.col("whole") & F.col("first"), 1).otherwise(0)).over(entire).alias("firsts"),
                      F.first(pick).over(entire).alias("one"), F.nth_value(pick, 2).over(entire).alias("two")).where("size > 1")
    cuts = F.col("size") - F.col("has_whole").cast("int")
    near = F.when(F.col("whole"), F.col("firsts")).otherwise(cuts - 1 + (F.col("has_whole") & F.col("first")).cast("int"))
    best = F.when(F.col("at") == 1, F.col("two")).otherwise(F.col("one"))
    out = seen.select("word", near.alias("near"), best.alias("best")).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return out.select("word", F.col("n_near").cast("long").alias("n_near"), (-F.col("best.m")).alias("near_n"), F.col("best.w").alias("near"))


def roots(forms: DataFrame, ratio: int) -> DataFrame:
    """(word, root) of every word with a form: forms followed to the last.

    Each step multiplies n by ``ratio`` at least, so a chain has at most log(largest n) steps; root tables are
    joined with themselves, doubling the steps, as often as that needs."""
    most = forms.agg(F.max("form_n").alias("m")).first()["m"]
    steps = max(1, math.floor(math.log(max(most or 1, 1)) / math.log(ratio)) + 1) if ratio > 1 else 64
    out = forms.select(F.col("word").alias("r_word"), F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        other = out.select(F.col("r_word").alias("o_word"), F.col("root").alias("o_root"))
        out = out.join(other, F.col("root") == F.col("o_word"), "left").select("r_word", F.coalesce("o_root", "root").alias("root"))
    return out


def group_variants(words: DataFrame, ratio: int = RATIO, mark: str = MARK) -> DataFrame:
    """``word, n, form, root, n_near, form_n`` of every row of ``words`` (word, n).

    Two words are near if one inserted, deleted or replaced code point makes one the other; ``form`` is the near word
    of largest n (ties: the smallest word), if that n is at least ``ratio`` times the word's own, else null;
    ``root`` is the last of the forms, the word itself where it has none."""
    near = neighbours(words, mark)
    joined = words.join(near.withColumnRenamed("word", "n_word"), F.col("word") == F.col("n_word"), "left")
    has = F.col("near_n") >= ratio * F.col("n")
    rows = stage(joined.select("word", "n", F.when(has, F.col("near")).alias("form"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(has, F.col("near_n")).alias("form_n")), "variants-forms")
    last = roots(rows.where(F.col("form").isNotNull()), ratio)
    return (rows.join(last, F.col("word") == F.col("r_word"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, every: int = EVERY, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """``group_variants`` of the words of all texts with at least ``min_length`` code points and ``min_count`` occurrences.

    Repeated rows count again; an empty table has no words; extra columns are ignored."""
    words = stage(count_words(docs, every, min_length).where(F.col("n") >= min_count), "variants-words")
    return group_variants(words, ratio)

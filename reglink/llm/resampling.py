"""Quality classifier by importance resampling of hashed n-gram models.

Two bag-of-hashed-n-grams models (words and word pairs) are counted: ``raw`` over all
documents, ``target`` over labelled good documents.  A document's log weight is the
log-likelihood ratio of the two, per 1,000 n-grams; adding Gumbel noise to it and taking
the k largest samples k documents without replacement in proportion to the weights.
``k`` is the number of documents whose weight lies above the cut that separates the
labelled good and bad documents best.

An average over a text cannot see the few words that make it toxic.  So the labelled
documents are also counted by word: a word that most of the labelled documents with it
are toxic for, at a lower confidence bound, tells; a document's weight loses the log
ratio of its most telling word, not averaged.

Counts, weights and ranks cover all documents.  Only the labels are a bounded sample
(``max_labels``, chosen by a hash of the id), and so are broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reglink.llm.stage import free_name, numbered, stage
from reglink.llm.words import flat, mix, rolling, slices, split, window_starts

BUCKETS = 1 << 16
MAX_LABELS = 20_000
PER = 1000.0
PRIOR = 20.0
CARE = 4.0            # a good document lost weighs as much as so many bad ones kept
WORD_SLOTS = 1 << 18
SURE = 2.5            # standard errors of the bound on a telling word's share of toxic documents; many words are tried


def _features(text: pa.Array, buckets: int):
    """Hashed n-gram and document number of every n-gram of the texts."""
    return _grams(split(text, lower=True), buckets)


def _grams(w, buckets: int):
    tokens, doc = w.tokens, w.doc
    pairs, ok = rolling(tokens, 2), window_starts(w.off, 2)
    h = np.concatenate([mix(tokens), pairs[ok]])
    return (h % np.uint64(buckets)).astype(np.int64), np.concatenate([doc, doc[:len(ok)][ok]])


def label_sample(labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """(doc_id, good, quality, toxic) of at most ``max_labels`` labelled ids, chosen by a hash of the id.

    Good: quality 1 and not toxic.  Rows without id or quality are left out; an id that
    is labelled both ways counts as not good, and as toxic."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    good = ((F.col("quality") == 1) & ~toxic).cast("int")
    return (rows.groupBy(F.col("doc_id").cast("long").alias("l_id"))
            .agg(F.min(good).alias("good"), F.min(F.col("quality")).alias("quality"), F.max(toxic.cast("int")).alias("toxic"))
            .orderBy(F.xxhash64("l_id"), "l_id").limit(max_labels))


def _labelled(docs: DataFrame, sample: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.join(F.broadcast(sample), rows.doc_id == sample.l_id, "left")
            .select("doc_id", "text", "good", "quality", "toxic"))


def fit(docs: DataFrame, sample: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of target to raw per n-gram bucket (all 0 where there is no target)."""

    def count(batches):
        held = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                f, doc = _features(flat(batch.column("text").slice(lo, hi - lo)), buckets)
                good = batch.column("good").slice(lo, hi - lo).fill_null(0).to_numpy(zero_copy_only=False) == 1
                held[0] += np.bincount(f, minlength=buckets)
                held[1] += np.bincount(f[good[doc]], minlength=buckets)
        for kind in (0, 1):
            at = np.flatnonzero(held[kind])
            yield pa.RecordBatch.from_arrays([pa.array(at + kind * buckets), pa.array(held[kind][at])], names=["slot", "n"])

    sums = _labelled(docs, sample).mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(2 * buckets, np.float64)
    for row in sums.toLocalIterator():      # at most 2 * buckets rows, whatever the input
        counts[row["slot"]] = row["n"]
    raw, target = counts[:buckets], counts[buckets:]
    if not target.sum():
        return np.zeros(buckets)
    return np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))


def telling_words(docs: DataFrame, sample: DataFrame, slots: int = WORD_SLOTS, sure: float = SURE) -> np.ndarray:
    """Log ratio of clean to toxic labelled documents per word slot, 0 where the word does not tell.

    It tells where the Wilson lower bound, ``sure`` standard errors down, of the share of
    toxic documents among the labelled ones with the word is above a half."""

    def count(batches):
        held = np.zeros((2, slots + 1), np.int64)       # the last slot counts documents
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                w = split(flat(batch.column("text").slice(lo, hi - lo)), lower=True)
                toxic = batch.column("toxic").slice(lo, hi - lo).to_numpy(zero_copy_only=False) == 1
                at = np.unique(w.doc.astype(np.int64) * slots + (mix(w.tokens) % np.uint64(slots)).astype(np.int64))
                for kind in (0, 1):
                    held[kind] += np.bincount((at % slots)[toxic[at // slots] == kind], minlength=slots + 1)
                    held[kind, slots] += int((toxic == kind).sum())
        at = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[0][at]), pa.array(held[1][at])], names=["slot", "clean", "toxic"])

    sums = (_labelled(docs, sample).where(F.col("toxic").isNotNull()).mapInArrow(count, "slot long, clean long, toxic long")
            .groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    n, z = F.col("clean") + F.col("toxic"), F.lit(sure)
    share = F.col("toxic") / n
    bound = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    rows = sums.where((bound > 0.5) | (F.col("slot") == slots)).collect()      # at most slots + 1 rows
    out = np.zeros(slots)
    all_clean, all_toxic = next(((r["clean"], r["toxic"]) for r in rows if r["slot"] == slots), (0, 0))
    for r in rows:
        if r["slot"] < slots:
            out[r["slot"]] = min(0.0, np.log((r["clean"] + 0.5) / (all_clean + 1)) - np.log((r["toxic"] + 0.5) / (all_toxic + 1)))
    return out


def weigh(docs: DataFrame, sample: DataFrame, ratio: np.ndarray, telling: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, n_grams, log_weight, good, quality, told) per row of ``docs``; a
    document without words has no weight.  ``told``: it has a telling word."""
    buckets, slots = len(ratio), len(telling)
    shared = docs.sparkSession.sparkContext.broadcast((ratio, telling))     # fixed size

    def score(batches):
        ratio, telling = shared.value
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                cut = batch.slice(lo, hi - lo)
                w = split(flat(cut.column("text")), lower=True)
                f, doc = _grams(w, buckets)
                n = np.bincount(doc, minlength=len(cut))
                total = np.bincount(doc, weights=ratio[f], minlength=len(cut))
                worst = np.zeros(len(cut))
                np.minimum.at(worst, w.doc, telling[(mix(w.tokens) % np.uint64(slots)).astype(np.int64)])
                weight = pa.array(PER * (total / (n + PRIOR) + worst), pa.float64(), mask=n == 0)
                yield pa.RecordBatch.from_arrays(
                    [cut.column("doc_id"), cut.column("text_hash"), pa.array(n.astype(np.int64)), weight, cut.column("good"), cut.column("quality"), pa.array(worst < 0)],
                    names=["doc_id", "text_hash", "n_grams", "log_weight", "good", "quality", "told"])

    rows = _labelled(docs, sample).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(score, "doc_id long, text_hash long, n_grams long, log_weight double, good int, quality int, told boolean")


def best_cut(weight: np.ndarray, good: np.ndarray, care: float = CARE) -> float:
    """The weight from which on documents count as good: the share of bad ones below it less
    ``care`` times the share of good ones is largest; between two weights, their middle."""
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(weight, kind="stable")
    w, g = weight[order], good[order]
    gain = np.concatenate(([0.0], np.cumsum(np.where(g, -care / g.sum(), 1 / (~g).sum()))))
    gain[1:-1][w[1:] == w[:-1]] = -np.inf
    i = int(np.argmax(gain))
    return -np.inf if i == 0 else np.inf if i == len(w) else float((w[i - 1] + w[i]) / 2)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, buckets: int = BUCKETS,
             max_labels: int = MAX_LABELS, seed: int = 6) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash``, ``n_grams``, ``log_weight``,
    ``gumbel_key``, ``place`` (from 0, largest key first) and ``selected`` (place < k).

    ``k`` None: as many as weigh above the cut that the labelled documents give, with
    documents of quality 1 that are not toxic as good.  Toxic ones of quality 1 without a
    telling word are left out of it: the weight has nothing against them, so they would
    only draw good documents below the cut.  Without labels every document with words is
    selected.  Documents without words (null or blank text) are never selected and come last."""
    sample = stage(label_sample(labels, max_labels), "labels")
    held = stage(weigh(docs, sample, fit(docs, sample, buckets), telling_words(docs, sample)), "weights")
    if k is None:
        seen = held.where(F.col("quality").isNotNull() & F.col("log_weight").isNotNull())
        seen = seen.where((F.col("good") == 1) | (F.col("quality") != 1) | F.col("told"))
        seen = seen.select("doc_id", "log_weight", "good").dropDuplicates(["doc_id"]).toPandas()   # at most max_labels rows
        cut = best_cut(seen["log_weight"].to_numpy(float), seen["good"].to_numpy() == 1)
        k = held.where(F.col("log_weight") >= F.lit(cut)).count()
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    keyed = held.select("doc_id", "text_hash", "n_grams", "log_weight", (F.col("log_weight") - F.log(-F.log(u))).alias("gumbel_key"))
    order = [F.col("gumbel_key").desc_nulls_last(), F.col("doc_id"), F.col("text_hash")]
    out = numbered(keyed, None, order, "place", "places")
    return out.withColumn("selected", (F.col("place") < F.lit(k)) & F.col("gumbel_key").isNotNull())


def keep_selected(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``resample`` selected, columns unchanged, whatever their names.

    A row is known by its id and text: repeated rows stay or go together, and so do rows of a null id with
    equal texts.  Null and blank texts are never selected, so they go."""
    own, tag = free_name("_id", docs.columns), free_name("_hash", docs.columns)
    chosen = verdict.where("selected").select(F.col("doc_id").alias(own), F.col("text_hash").alias(tag)).distinct()
    cond = F.col("doc_id").cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(F.col("text").cast("string")) == F.col(tag))
    return docs.join(chosen, cond, "left_semi")

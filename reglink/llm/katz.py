"""Language-model scores by Katz backoff over a word-bigram model.

The model is made of two tables of n-gram counts, partitioned by key bucket: words, and pairs of
a context and a word.  Good-Turing discounts apply to counts of at most ``top``; what they
free goes to the words not seen after the context, in proportion to their lower-order
probability, with backoff weights that make every context's probabilities sum to 1:

    P(w | v) = d(c(vw)) c(vw) / c(v)          where the pair was seen
             = alpha(v) P(w)                   else
    P(w)     = d(c(w)) c(w) / N, and what is free for the one unknown word

A context whose counts free nothing counts one token more, and so does N.

Hashes stand for words: 64 bits cut to 48 and the bucket's bits where words are counted,
48 for a pair's context and 40 for its word beside that context.

Exchange (see ``exchange``): text groups ask for their distinct words' counts, then for their
distinct pairs' counts and, per context, integer sums from which alpha follows exactly.  Pairs go
to the bucket of their context, pairs of a very frequent context to a bucket of their own
hash; such a context's sums are added up from all buckets, so no task holds one context whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reglink.llm import exchange as ex
from reglink.llm.words import mix, split

END = np.uint64(0xE4D0F5EA7E11D0C5)          # the end token, which no word hash is expected to equal
BEGIN = np.uint64(0xB3617A9C24D80F1B)        # context of a document's first token
TOP = 5
WORD_BYTES = 6          # sent of a word's hash, beside the bucket's bits
CONTEXT_BYTES = 6
PAIR_BYTES = 5          # sent of the word's hash in a pair, beside its context

SENT1 = "_g int, b int, k binary, n binary"
SENT2 = "_g int, b int, v binary, run binary, w binary, n binary, cw binary"
REPLY = "_g int, b int, reply binary, sums binary, stat binary"
OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def discounts(n: np.ndarray, top: int) -> np.ndarray:
    """Good-Turing discount per count 0..top from n[r], the number of n-grams seen r times
    (r to top + 1); 1 where the estimate is not between 0 and 1."""
    d = np.ones(top + 1)
    n = np.asarray(n, float)
    if n[1] <= 0 or n[top + 1] <= 0:
        return d
    rest = (top + 1) * n[top + 1] / n[1]
    for r in range(1, top + 1):
        if n[r] > 0 and rest < 1:
            x = ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest)
            if 0 < x < 1:
                d[r] = x
    return d


class Unigrams:
    """Lowest level: P(w) from a count, and the probability of the unknown word."""

    def __init__(self, tokens: int, n: np.ndarray, top: int):
        self.top, self.d = top, discounts(n, top)
        freed = float(sum((1 - self.d[r]) * r * n[r] for r in range(1, top + 1)))
        self.total = float(tokens) if freed > 0 else tokens + 1.0
        self.unknown = freed / self.total if freed > 0 else 1.0 / self.total

    def mass(self, c: np.ndarray) -> np.ndarray:
        """Discounted count."""
        return np.where(c > self.top, c, self.d[np.minimum(c, self.top).astype(np.int64)] * c)

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.mass(c) / self.total, self.unknown)


def backoff(low: Unigrams, d: np.ndarray, c: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Denominator and alpha per context.  ``sums`` rows: successors seen 1..top times and the total of
    the larger counts; then the same of the successors' own counts."""
    top = low.top
    r = np.arange(1, top + 1)
    freed = ((1 - d[1:]) * r) @ sums[:top]
    some = freed > 0
    denom = np.where(some, c, c + 1.0)
    free = np.where(some, freed, 1.0) / np.maximum(denom, 1)
    seen = ((low.d[1:] * r) @ sums[top + 1:2 * top + 1] + sums[2 * top + 1]) / low.total
    return denom, free / np.maximum(1 - seen, low.unknown)


def score(docs: DataFrame, held_out: Column, top: int = TOP, group_bytes: int = ex.GROUP_BYTES, bucket_keys: int = ex.BUCKET_KEYS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens`` (words and the end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (add-one unigram) and
    ``score``, both log10 over all tokens.

    The model learns from the rows where ``held_out`` (an expression over ``doc_id``) is false or null.
    A-Z are lower-cased.  Null text is empty: the end token alone."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("_held", F.coalesce(held_out, F.lit(False)))
    groups = ex.text_groups(rows, ["_held"], group_bytes, bucket_keys)
    bits, rows, hot = groups.bits, ex.packed(groups.rows, 3), bucket_keys

    def stream(table: pa.Table):
        """The rows, all tokens, whether each begins a document, its document and whether it trains."""
        table = ex.unpacked(table)
        w = split(table.column("_text"), lower=True)
        n = len(w.off) - 1
        off = w.off + np.arange(n + 1)
        token = np.empty(int(off[-1]), np.uint64)
        last = np.zeros(len(token), bool)
        last[off[1:] - 1] = True
        token[last] = END
        token[~last] = w.tokens
        begins = np.zeros(len(token), bool)
        begins[off[:-1]] = True
        doc = np.repeat(np.arange(n), np.diff(off))
        return table, token, begins, doc, ~table.column("_c0").to_numpy()[doc]

    def send_words(table: pa.Table) -> pa.Table:
        g = ex.group_id(table)
        _, token, _, _, train = stream(table)
        keys, where = np.unique(token, return_inverse=True)
        n = np.bincount(where, weights=train).astype(np.uint64)
        edge = ex.bounds(keys, bits)
        used = np.flatnonzero(np.diff(edge))
        cut = [slice(edge[b], edge[b + 1]) for b in used]
        return ex.table(SENT1, {"_g": [g] * len(used), "b": used.tolist(), "k": [ex.short(keys[c], bits, WORD_BYTES) for c in cut],
                                "n": [ex.dense(n[c]) for c in cut]})

    def count_words(table: pa.Table) -> pa.Table:
        key, part = ex.pieces(table.column("k").to_pylist(), np.uint64, WORD_BYTES)
        n, _ = ex.pieces(table.column("n").to_pylist(), np.uint64, None, ex.undense)
        uniq, where = np.unique(key, return_inverse=True)
        total = np.zeros(len(uniq), np.uint64)
        np.add.at(total, where, n)
        times = np.bincount(np.minimum(total, top + 2).astype(np.int64), minlength=top + 3)[:top + 2]
        stat = np.concatenate(([int(total.sum()), int((total > 0).sum())], times)).astype(np.int64)
        each = total[where]
        m = table.num_rows
        return ex.table(REPLY, {
            "_g": [*table.column("_g").to_pylist(), -1], "b": [*table.column("b").to_pylist(), -1],
            "reply": [*(ex.dense(each[part[i]:part[i + 1]]) for i in range(m)), None], "sums": [None] * (m + 1), "stat": [None] * m + [stat.tobytes()]})

    def pairs(table: pa.Table, side: pa.Table):
        """Distinct pairs in the order (bucket, context, word) with their words' counts, and the list of
        (bucket, context) with the number of pairs of each.  A context's number is its word's place among
        the group's sorted words, so numbers, hashes and buckets have one order."""
        table, token, begins, doc, train = stream(table)
        words, at = np.unique(token, return_inverse=True)
        count = ex.answers(side, words, bits, np.uint64, ex.undense)
        size = len(words)
        hashes = np.append(words, BEGIN)                         # number ``size``: the begin of a document
        counts = np.append(count, count[np.searchsorted(words, END)])       # one end per training document
        context = np.empty_like(at)
        context[1:] = at[:-1]
        context[begins] = size
        code, where = np.unique(context * size + at, return_inverse=True)
        n = np.bincount(where, weights=train, minlength=len(code)).astype(np.uint32)
        vi, wi = code // size, code % size
        spread = (counts[vi] > hot) | (vi == size)
        bucket = (hashes[vi] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(code), np.int64)
        if bits:
            bucket[spread] = (mix(mix(hashes[vi[spread]]) + words[wi[spread]]) >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(bucket.astype(np.int32), kind="stable")      # stays in the order (context, word) within a bucket
        bucket, vi, wi = bucket[order], vi[order], wi[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        frequent = np.unique(vi[spread[order]])                   # listed in every bucket, to get all sums
        listed = np.unique(np.concatenate([bucket * (size + 1) + vi, (np.arange(1 << bits)[:, None] * (size + 1) + frequent).ravel()]))
        lb, lv = listed // (size + 1), listed % (size + 1)
        run = np.zeros(len(listed), np.uint32)
        own, times = np.unique(bucket * (size + 1) + vi, return_counts=True)
        run[np.searchsorted(listed, own)] = times
        return {"table": table, "doc": doc, "token": at, "context": context, "counts": counts, "where": place[where],
                "n": n[order], "w": words[wi], "w_count": count[wi], "bucket": bucket, "lb": lb, "lv": lv, "v": hashes[lv], "run": run}

    def send_pairs(table: pa.Table, side: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ex.table(SENT2, {c.split()[0]: [] for c in SENT2.split(", ")})
        g = ex.group_id(table)
        p = pairs(table, side)
        count = np.where(p["n"] > 0, p["w_count"], 0).astype(np.uint64)
        names = np.arange((1 << bits) + 1)
        le, pe = np.searchsorted(p["lb"], names), np.searchsorted(p["bucket"], names)
        used = np.flatnonzero(np.diff(le))
        lists = [slice(le[b], le[b + 1]) for b in used]
        cuts = [slice(pe[b], pe[b + 1]) for b in used]
        return ex.table(SENT2, {
            "_g": [g] * len(used), "b": used.tolist(), "v": [ex.short(mix(p["v"][c]), 0, CONTEXT_BYTES) for c in lists],
            "run": [ex.dense(p["run"][c]) for c in lists], "w": [ex.short(p["w"][c], 0, PAIR_BYTES) for c in cuts],
            "n": [ex.dense(p["n"][c]) for c in cuts], "cw": [ex.dense(count[c]) for c in cuts]})

    def count_pairs(table: pa.Table) -> pa.Table:
        v_list, v_part = ex.pieces(table.column("v").to_pylist(), np.uint64, CONTEXT_BYTES)
        run, _ = ex.pieces(table.column("run").to_pylist(), np.uint32, None, ex.undense)
        w, part = ex.pieces(table.column("w").to_pylist(), np.uint64, PAIR_BYTES)
        n, _ = ex.pieces(table.column("n").to_pylist(), np.uint32, None, ex.undense)
        cw, _ = ex.pieces(table.column("cw").to_pylist(), np.uint64, None, ex.undense)
        contexts, ci = np.unique(v_list, return_inverse=True)
        v = np.repeat(ci, run)
        order = np.lexsort((w, v))
        new = np.r_[True, (v[order][1:] != v[order][:-1]) | (w[order][1:] != w[order][:-1])] if len(v) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        total = np.add.reduceat(n[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        low = np.maximum.reduceat(cw[order], first).astype(np.int64) if len(first) else total
        owner = v[order][first]
        seen = total > 0
        owner, counts, low = owner[seen], total[seen], low[seen]
        sums = np.zeros((2 * top + 2, len(contexts)), np.int64)
        for base, c in ((0, counts), (top + 1, low)):
            for r in range(1, top + 1):
                sums[base + r - 1] = np.bincount(owner[c == r], minlength=len(contexts))
            np.add.at(sums[base + top], owner[c > top], c[c > top])
        each = np.empty(len(v), np.int64)
        each[order] = total[np.cumsum(new) - 1] if len(first) else total
        times = np.bincount(np.minimum(counts, top + 2), minlength=top + 3)[:top + 2].astype(np.int64)
        m = table.num_rows
        own = [sums[:, ci[v_part[i]:v_part[i + 1]]] for i in range(m)]
        return ex.table(REPLY, {
            "_g": [*table.column("_g").to_pylist(), -1], "b": [*table.column("b").to_pylist(), -1],
            "reply": [*(ex.dense(each[part[i]:part[i + 1]]) for i in range(m)), None],
            "sums": [*(ex.dense(s.ravel()) for s in own), None], "stat": [None] * m + [times.tobytes()]})

    def evaluate(table: pa.Table, side: pa.Table) -> pa.Table:
        step = np.array(side.column("step").to_pylist())
        words, found = side.filter(pa.array(step == 1)), side.filter(pa.array(step == 2))
        stats = side.filter(pa.array(step == 3))
        s = dict(zip(stats.column("b").to_pylist(), (np.array(x) for x in stats.column("stat").to_pylist())))
        tokens, vocabulary, low_n, pair_n = int(s[1][0]), int(s[1][1]), s[1][2:], s[2]
        low, d = Unigrams(tokens, low_n, top), discounts(pair_n, top)
        p = pairs(table, words)
        names = np.arange((1 << bits) + 1)
        le, pe = np.searchsorted(p["lb"], names), np.searchsorted(p["bucket"], names)
        total = np.zeros(len(p["w"]), np.int64)
        sums = np.zeros((2 * top + 2, len(p["lv"])), np.int64)
        for b, reply, own in zip(*(found.column(c).to_pylist() for c in ("b", "reply", "sums"))):
            total[pe[b]:pe[b + 1]] = ex.undense(reply, np.int64)
            sums[:, le[b]:le[b + 1]] = ex.undense(own, np.int64).reshape(2 * top + 2, -1)
        counts = p["counts"].astype(np.int64)                    # by word number; the last is the begin
        whole = np.stack([np.bincount(p["lv"], weights=row, minlength=len(counts)) for row in sums])     # exact below 2**53
        denom, alpha = backoff(low, d, counts, whole)
        at, pair = p["context"], total[p["where"]]
        cw, cv = counts[p["token"]], counts[at]
        pair_mass = np.where(pair > top, pair, d[np.minimum(pair, top)] * pair)
        lower = low.p(cw)
        prob = np.where(pair > 0, pair_mass / np.maximum(denom[at], 1), np.where(cv > 0, alpha[at], 1.0) * lower)
        rows = p["table"]
        doc, n = p["doc"], rows.num_rows
        base = np.log10((cw + 1.0) / (tokens + vocabulary + 1.0))
        ids = rows.column("_id").to_numpy()
        return pa.table([
            pa.array(ids, pa.int64(), mask=ids == ex.NO_ID), rows.column("_c0"), pa.array(np.bincount(doc, minlength=n)),
            pa.array(np.bincount(doc, weights=cw > 0, minlength=n).astype(np.int64)), pa.array(np.full(n, tokens, np.int64)),
            pa.array(np.bincount(doc, weights=base, minlength=n)), pa.array(np.bincount(doc, weights=np.log10(prob), minlength=n))],
            names=[c.split()[0] for c in OUT.split(", ")])

    def add_up(batches):
        """Statistics of many buckets in one row."""
        held = None
        for batch in batches:
            for raw in batch.column("stat").to_pylist():
                x = np.frombuffer(raw, np.int64)
                held = x.copy() if held is None else held + x
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held))), pa.array(held)], names=["i", "x"])

    def statistics(replies: DataFrame, step: int) -> DataFrame:
        """The sum of all buckets' statistics, for every group."""
        parts = replies.where("_g < 0").select("stat").mapInArrow(add_up, "i long, x long").groupBy("i").agg(F.sum("x").alias("x"))
        row = parts.agg(F.sort_array(F.collect_list(F.struct("i", "x"))).getField("x").alias("stat"))      # a dozen numbers
        return row.select(F.explode(F.sequence(F.lit(0), F.lit(groups.n - 1))).alias("_g"), F.lit(step).alias("b"), F.lit(None).cast("binary").alias("reply"),
                          F.lit(None).cast("binary").alias("sums"), "stat", F.lit(3).alias("step"))

    def replied(replies: DataFrame, step: int) -> DataFrame:
        return replies.where("_g >= 0").select("_g", "b", "reply", "sums", F.lit(None).cast("array<long>").alias("stat"), F.lit(step).alias("step"))

    asked = rows.groupBy("_g").applyInArrow(send_words, SENT1)
    counted = asked.groupBy("b").applyInArrow(count_words, REPLY)
    sent = rows.groupBy("_g").cogroup(replied(counted, 1).groupBy("_g")).applyInArrow(send_pairs, SENT2)
    paired = sent.groupBy("b").applyInArrow(count_pairs, REPLY)
    side = replied(counted, 1).unionAll(replied(paired, 2)).unionAll(statistics(counted, 1)).unionAll(statistics(paired, 2))
    return rows.groupBy("_g").cogroup(side.groupBy("_g")).applyInArrow(
        lambda t, s: evaluate(t, s) if t.num_rows else _nothing(), OUT)


def _nothing() -> pa.Table:
    return pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()),
                     "n_known": pa.array([], pa.int64()), "train_tokens": pa.array([], pa.int64()),
                     "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})


def crc_held_out(modulus: int = 7, remainder: int = 2) -> Column:
    """Held out: crc32 of the id's decimal text has this remainder (a null id: the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder

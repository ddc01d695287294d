"""Ranked lexical search: accumulator-limited, term at a time.

1. Documents become blocks of a few MB of text; a block keeps the postings of the queries' terms (term,
   document, occurrences) and its documents' lengths, packed in one row of a staged table.  Texts are
   read and split once.
2. Corpus totals and document frequencies are sums over the blocks; they give each term's weight.
3. Each task walks its blocks.  For a query it takes the terms rarest first and adds up
   weight x impact in accumulators, one per document met.  As soon as the terms still to come cannot lift
   a document without accumulator to the k-th best score so far (partial scores of this
   block, or scores that the task holds from earlier blocks), no more accumulators are created; those there
   are updated to the end, so every score is exact.
4. A task sends its k best per query; a window keeps the k best of all tasks.

Bounds are those of the block: weight x the largest impact among the term's postings there.
The queries' terms are handled in blocks of at most ``max_terms`` (query, term) pairs, one pass each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reglink.llm import exchange as ex
from reglink.llm.runs import Runs, term_runs
from reglink.llm.stage import stage
from reglink.llm.words import slices

BLOCK_BYTES = 8 << 20
MAX_TERMS = 1 << 20
SCALE = 1_000_000_000
BLOCK = "docs long, terms long, kinds int, ids binary, lengths binary, term binary, sizes binary, place binary, tf binary"


def weight(n_docs: int, df: int) -> int:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))"""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of each row of ``items``, in the order of their first occurrence."""

    def cut(batches):
        for batch in batches:
            runs = term_runs(batch.column("text"))
            raw = runs.vocab.to_pylist()
            terms = [[raw[i] for i in dict.fromkeys(runs.ids[a:b].tolist())] for a, b in zip(runs.off[:-1], runs.off[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.string()))], names=["item_id", "terms"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, "item_id long, terms array<string>")


def _postings(runs: Runs, terms: pa.Array) -> tuple[np.ndarray, ...]:
    """(term, how many documents, documents, occurrences) of the wanted terms, sorted by term and document."""
    n = len(runs.off) - 1
    to = pc.index_in(runs.vocab, terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[runs.ids] if len(runs.ids) else np.zeros(0, np.int64)
    hit = to >= 0
    key, tf = np.unique(to[hit] * n + runs.doc[hit], return_counts=True)
    term, sizes = np.unique(key // max(n, 1), return_counts=True)
    return term, sizes, key % max(n, 1), tf


def blocks(docs: DataFrame, terms: list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Packed postings of ``terms`` (their places in the list are their numbers), one row per block of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)        # at most ``max_terms``

    def pack(batches):
        wanted = pa.array(shared.value, pa.large_string())
        for batch in batches:
            for lo, hi in slices(batch.column("text"), block_bytes):
                cut = batch.slice(lo, hi - lo)
                runs = term_runs(cut.column("text"))
                length = np.diff(runs.off)
                term, sizes, doc, tf = _postings(runs, wanted)
                ids = cut.column("doc_id").fill_null(int(ex.NO_ID)).to_numpy(zero_copy_only=False)
                used, place = np.unique(doc, return_inverse=True)       # documents without a wanted term score nothing
                values = [int((length > 0).sum()), int(length.sum()), len(term), ex.dense(ids[used]), ex.dense(length[used]), ex.dense(term), ex.dense(sizes),
                          ex.dense(place.astype(np.int64)), ex.dense(tf.astype(np.int64))]
                yield pa.RecordBatch.from_pylist([dict(zip(BLOCK_NAMES, values))], schema=BLOCK_ARROW)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pack, BLOCK)


BLOCK_NAMES = [c.split()[0] for c in BLOCK.split(", ")]
BLOCK_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]]) for c in BLOCK.split(", ")])


def document_frequencies(index: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term occurs."""

    def count(batches):
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            for term, sizes in zip(batch.column("term").to_pylist(), batch.column("sizes").to_pylist()):
                held[ex.undense(term, np.int64)] += ex.undense(sizes, np.int64)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    sums = index.select("term", "sizes").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()      # at most n_terms rows
    out[sums.column("term").to_numpy()] = sums.column("df").to_numpy()
    return out


class Best:
    """The k best (score, doc_id) that a task has met for one query; equal scores by ascending id."""

    def __init__(self, k: int) -> None:
        self.k, self.score, self.id = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """What a document must at least reach to get in."""
        return int(self.score[-1]) if len(self.score) >= self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score))[:self.k]
        self.score, self.id = score[order], ids[order]


def accumulate(terms, bounds, postings, n_docs: int, best: Best) -> tuple[np.ndarray, np.ndarray, int]:
    """Exact scores of the documents that can still be among the k best: (documents, scores, accumulators made).

    ``terms`` rarest first, ``bounds[t]`` the most that term t gives a document of this block."""
    acc, live = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    rest = np.cumsum(bounds[::-1])[::-1] if len(terms) else np.zeros(0, np.int64)
    made, open_, floor = 0, True, best.floor
    for j, t in enumerate(terms):
        if open_ and rest[j] < floor:
            open_ = False
            if not made:                   # nothing here can get in
                break
        docs, gain = postings(t)
        if not open_:
            own = live[docs]
            docs, gain = docs[own], gain[own]
        acc[docs] += gain
        if open_:
            live[docs] = True
            made = int(live.sum())
            if made >= best.k:
                floor = max(floor, int(np.partition(acc[live], made - best.k)[made - best.k]))
    at = np.flatnonzero(live & (acc > 0) & (acc >= best.floor))
    return at, acc[at], made


def search_blocks(index: DataFrame, queries: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(query, doc_id, score, made): each task's k best documents of each query; ``made``: accumulators that the task created."""
    order = [sorted(q, key=lambda t: (-int(weights[t]), t)) for q in queries]
    shared = index.sparkSession.sparkContext.broadcast((order, weights))          # at most ``max_terms`` pairs

    def run(batches):
        order, weights = shared.value
        best, made = [Best(k) for _ in order], [0] * len(order)
        for batch in batches:
            for row in batch.to_pylist():
                if not row["kinds"]:
                    continue
                ids, length, term, sizes, place, tf = (ex.undense(row[c], np.int64) for c in ("ids", "lengths", "term", "sizes", "place", "tf"))
                m = 10 + (90 * length * n_docs) // n_terms
                gain = np.repeat(weights[term], sizes) * ((SCALE * tf) // (1000 * tf + 8 * m[place]))
                begin = np.concatenate(([0], np.cumsum(sizes)))
                most = np.maximum.reduceat(gain, begin[:-1])
                here = dict(zip(term.tolist(), range(len(term))))

                def postings(t):
                    return place[begin[t]:begin[t + 1]], gain[begin[t]:begin[t + 1]]

                for q, terms in enumerate(order):
                    own = [here[t] for t in terms if t in here]
                    if own:
                        at, score, n = accumulate(own, most[own], postings, len(ids), best[q])
                        made[q] += n
                        if len(at):
                            best[q].add(score, ids[at])
        for q, b in enumerate(best):
            if len(b.score):
                n = len(b.score)
                yield pa.RecordBatch.from_arrays([pa.array([q] * n, pa.int32()), pa.array(b.id), pa.array(b.score), pa.array([made[q]] * n, pa.int64())],
                                                 names=["query", "doc_id", "score", "made"])

    return index.mapInArrow(run, "query int, doc_id long, score long, made long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, max_terms: int = MAX_TERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the k best documents with a score above 0 of each row of ``items``.

    Every row of ``docs`` is a document, repeated rows too; equal scores go by ascending id, a null id last.
    Null text has no terms; an item without terms, or whose terms no document holds, has no rows;
    a repeated item has its rows again.  Extra columns are ignored."""
    spark = docs.sparkSession
    cut = stage(query_terms(items), "ranked-queries")
    pairs = cut.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()["n"]
    n_parts = max(1, -(-pairs // max_terms))
    part = F.pmod(F.xxhash64("item_id", "terms"), F.lit(n_parts))
    out = None
    for p in range(n_parts):
        asked = cut.where((part == p) & (F.size("terms") > 0)).collect()           # about ``max_terms`` pairs
        own = _rank(docs, [(r["item_id"], r["terms"]) for r in asked], k, block_bytes)
        out = own if out is None else out.unionByName(own)
    return out


def _rank(docs: DataFrame, asked: list[tuple[int | None, list[str]]], k: int, block_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    terms = sorted({t for _, own in asked for t in own})
    number = {t: i for i, t in enumerate(terms)}
    queries = [[number[t] for t in own] for _, own in asked]
    index = stage(blocks(docs, terms, block_bytes), "ranked-blocks")
    total = index.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("terms"), F.lit(0)).alias("l")).first()
    df = document_frequencies(index, len(terms))
    weights = np.array([weight(total["n"], int(x)) for x in df], np.int64)
    found = search_blocks(index, queries, weights, total["n"], max(1, total["l"]), k)
    place = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    first = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(asked)], "q int, item_id long")
    doc_id = F.when(F.col("doc_id") != int(ex.NO_ID), F.col("doc_id")).alias("doc_id")
    return first.join(F.broadcast(names), F.col("query") == F.col("q")).select("item_id", "rank", doc_id, "score")


def ranked_sql(k: int = 10) -> str:
    """DuckDB SQL for ``rank_documents`` of ``benchmark`` over ``documents``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    run = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{run}')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS t FROM documents),
q AS (SELECT i, item_id, unnest(list_distinct(t)) AS term FROM (SELECT row_number() OVER () AS i, item_id, {terms} AS t FROM benchmark)),
totals AS (SELECT count(*) AS n_docs, sum(len(t)) AS n_terms FROM d WHERE len(t) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), totals),
s AS (SELECT q.i, q.item_id, p.r, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + ((90 * len(d.t) * n_docs) // n_terms)))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (r), totals GROUP BY q.i, q.item_id, p.r),
o AS (SELECT i, item_id, d.doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, d.doc_id NULLS LAST) AS rank
  FROM s JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= {k}
"""

"""Exact top-k inner products by the three-phase uniform threshold.

A score is the sum of local scores, one per list (a slice of the dimensions).

1. Every tile (a block of queries by a block of vectors) gathers the k best local scores of
   each list; the k-th best whole score among the gathered vectors is a lower bound
   tau of the answer.
2. The cutoff ceil(tau / lists) goes out with the queries: a vector that reaches tau must
   reach the cutoff in some list, so a tile collects only such entries, and of these only
   those whose bound (their seen local scores, the cutoff for the others) reaches tau.
3. What remains is resolved exactly where its vectors are: the tile adds the other lists' scores and
   sends, per query, its k best of at least tau, which are then ranked over all tiles.

Vectors and queries are packed in blocks of bounded size.  A tile is one row of an
equi-join on the query block's number, so every task holds one tile at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reglink.llm.stage import stage

SCALE = 256


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, vec array<long>, copies): floor(scale * x) of each component, x as double.

    Rows without id, null vectors and vectors with a null or non-finite component take
    no part; ``copies`` rows have the same id and the same integers."""
    x = F.col(vector).cast("array<double>")
    usable = F.col(id_col).isNotNull() & F.col(vector).isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = table.where(usable).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("vec"))
    return rows.groupBy("vec_id", "vec").agg(F.count(F.lit(1)).alias("copies"))


def _blocks(rows: DataFrame, size: int, key: str) -> tuple[DataFrame, int]:
    """Rows packed in blocks of about ``size``: block number, row numbers, ids, copies and a matrix (shorter
    vectors end in zeros)."""
    n = max(1, -(-rows.count() // size))

    def packed(table: pa.Table) -> pa.Table:
        vec = table.column("vec").combine_chunks()
        if isinstance(vec, pa.ChunkedArray):
            vec = pa.concat_arrays(vec.chunks)
        lens = vec.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        width = int(lens.max()) if len(lens) else 0
        m = np.zeros((len(lens), width), np.int64)
        row = np.repeat(np.arange(len(lens)), lens)
        col = np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)
        m[row, col] = vec.flatten().to_numpy(zero_copy_only=False)
        ids = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("row", "vec_id", "copies")])
        return pa.table({key: pa.array([table.column(key)[0].as_py()], pa.int32()), f"{key}_ids": [ids.tobytes()],
                         f"{key}_mat": [m.tobytes()]})

    dealt = rows.withColumn(key, F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
    return dealt.groupBy(key).applyInArrow(packed, f"{key} int, {key}_ids binary, {key}_mat binary"), n


def _matrix(ids: bytes, mat: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids, copies and the matrix of a block."""
    row, own, copies = np.frombuffer(ids, np.int64).reshape(3, -1)
    return row, own, copies, np.frombuffer(mat, np.int64).reshape(len(row), -1)


def _local_scores(q: np.ndarray, v: np.ndarray, lists: int) -> list[np.ndarray]:
    """One matrix (queries x vectors) of local scores per list."""
    width = min(q.shape[1], v.shape[1])
    cuts = np.linspace(0, width, lists + 1).astype(int)
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(width, 1)
    kind = np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64    # all exact below these bounds
    a, b = q.astype(kind), v.astype(kind)
    return [a[:, s:e] @ b[:, s:e].T for s, e in zip(cuts[:-1], cuts[1:])]


def search(table: DataFrame, is_query: Column, k: int = 5, lists: int = 4, id_col: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE, query_block: int = 1024, vector_block: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each query row among all
    other rows, all if fewer, ties to the smaller id.  A copy of the query's row is another row, and so is
    one of the same id with another vector; a query row that is there twice is answered twice.  An empty table gives no rows.

    Rows are worked on as distinct (id, vector) with their number of copies, and copies are told apart in the answer only."""
    vectors = stage(integer_vectors(table, id_col, vector, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = stage(vectors.where(is_query), "queries")
    held, n_held = _blocks(vectors, vector_block, "vb")
    asked, n_asked = _blocks(queries, query_block, "qb")
    held, asked = stage(held, "vector_blocks"), stage(asked, "query_blocks")

    def tiles(query_rows: DataFrame) -> DataFrame:
        each = held.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))))
        return each.repartition(max(n_held * n_asked, 1), "vb", "qb").join(query_rows, "qb")

    found = "query long, row long, vec_id long, copies long, score long"

    def entries(q_row, v_row, v_ids, v_copies, row, col, score):
        """The pairs of a tile as rows; the query itself is one copy less."""
        copies = v_copies[col] - (q_row[row] == v_row[col])
        ok = copies > 0
        row, col = row[ok], col[ok]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (q_row[row], v_row[col], v_ids[col], copies[ok], score[ok].astype(np.int64))],
                                          names=["query", "row", "vec_id", "copies", "score"])

    def gather(batches):
        for batch in batches:
            for r in batch.to_pylist():
                q_row, _, _, q = _matrix(r["qb_ids"], r["qb_mat"])
                v_row, v_ids, v_copies, v = _matrix(r["vb_ids"], r["vb_mat"])
                local = _local_scores(q, v, lists)
                take = min(k + 1, len(v_row))           # one may be the query itself
                row = np.repeat(np.arange(len(q_row)), take)
                tops = [np.argpartition(-m, take - 1, axis=1)[:, :take].ravel() for m in local]
                flat = np.unique(np.concatenate([row * len(v_row) + col for col in tops]))
                row, col = flat // len(v_row), flat % len(v_row)
                # whole scores of the gathered vectors only
                yield entries(q_row, v_row, v_ids, v_copies, row, col, sum(m[row, col].astype(np.int64) for m in local))

    first = tiles(asked).mapInArrow(gather, found)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row")
    bound = (first.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
             .groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("tau")))
    bounds = stage(bound, "bounds")

    # each query block takes its queries' bounds along; a query with fewer than k others has none
    spread = (queries.select(F.col("row").alias("query"), F.pmod(F.xxhash64("row"), F.lit(n_asked)).cast("int").alias("qb"))
              .join(bounds, "query").where(F.col("tau").isNotNull())
              .groupBy("qb").agg(F.collect_list(F.struct("query", "tau")).alias("taus")))
    armed = asked.join(spread, "qb", "left")

    def collect(batches):
        for batch in batches:
            for r in batch.to_pylist():
                q_row, _, _, q = _matrix(r["qb_ids"], r["qb_mat"])
                v_row, v_ids, v_copies, v = _matrix(r["vb_ids"], r["vb_mat"])
                tau = {t["query"]: t["tau"] for t in r["taus"] or []}
                least = np.array([tau.get(i, -(2 ** 62)) for i in q_row.tolist()], np.int64)
                cut = -((-least) // lists)              # ceil
                local = _local_scores(q, v, lists)
                seen = np.zeros(local[0].shape, bool)
                bound = np.zeros(local[0].shape)
                for m in local:
                    reach = m >= cut[:, None]
                    seen |= reach
                    bound += np.where(reach, m, cut[:, None] - 1.0)
                row, col = np.nonzero(seen & (bound >= least[:, None]))
                score = sum(m[row, col].astype(np.int64) for m in local)        # the lists not seen yet
                ok = (score >= least[row]) & ((q_row[row] != v_row[col]) | (v_copies[col] > 1))
                row, col, score = row[ok], col[ok], score[ok]
                order = np.lexsort((v_ids[col], -score, row))
                row, col, score = row[order], col[order], score[order]
                head = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
                place = np.arange(len(row)) - np.maximum.accumulate(np.where(head, np.arange(len(row)), 0))
                own = place < k                         # no other of this tile can be among the k best
                yield entries(q_row, v_row, v_ids, v_copies, row[own], col[own], score[own])

    sent = tiles(armed).mapInArrow(collect, found)
    top = sent.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
    each = top.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k).cast("long")).cast("int"))))
    places = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row", "copy")
    ranked = each.withColumn("rank", F.row_number().over(places).cast("int")).where(F.col("rank") <= k)
    names = queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("copies").alias("_times"))
    answers = ranked.select("query", "rank", "vec_id", "score").join(names, "query")
    return answers.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).select("query_id", "rank", "vec_id", "score")

"""Substring dedup by a prefix-filtered hash join on windows of words.

No suffix tree is built: "suffix" below means its first window, "subtree" a sort of window hashes.

A suffix begins at each word that has a whole window (13 words) of its document before it.
Suffixes are split by a prefix of variable length, so that a group fits in memory:

1. every text group sends its distinct 5-word prefixes with their numbers of suffixes; a
   prefix that one document alone holds can't start a shared window and ends here;
2. suffixes with a shared prefix are grouped by that prefix, or, where the prefix holds more
   than ``max_suffixes`` suffixes, by the longer prefix of the whole window; each group's
   subtree is built by sorting (prefix, path to the window's depth), and an internal
   node at that depth is a repeat: its smallest doc_id goes back to the senders;
3. each document drops the words that a window with a smaller doc_id covers; neighbouring
   windows join to maximal repeats.

Nodes are identified by 64-bit path hashes.  A null ``doc_id`` counts as larger than every id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from reglink.llm import exchange as ex
from reglink.llm.words import flat, rolling, spans_mask, split, window_starts

WINDOW = 13
PREFIX = 5
MAX_SUFFIXES = 1 << 16
SENT1 = "_g int, b int, k binary, n binary, multi binary"
SENT2 = "_g int, b int, k binary, d binary"
REPLY = "_g int, b int, reply binary"


def dedup_substrings(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, max_suffixes: int = MAX_SUFFIXES,
                     carry: list[str] | None = None, group_bytes: int = ex.GROUP_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (of the
    kept words, one blank apart) and ``n_spans`` (maximal removed runs).

    ``carry`` names columns of ``docs`` to pass on; ``kept_text`` then comes along: the text itself
    where nothing was removed, else the kept words.  Null text has no words."""
    groups = ex.text_groups(docs, carry, group_bytes)
    bits = groups.bits

    def suffixes(table: pa.Table):
        w = split(table.column("_text"))
        tokens = w.tokens
        at = np.flatnonzero(window_starts(w.off, window))
        ids = table.column("_id").to_numpy()
        return w, tokens, at, rolling(tokens, prefix)[at], w.doc[at], ids

    def send_prefixes(table: pa.Table) -> pa.Table:
        g = ex.group_id(table)
        _, _, at, head, doc, ids = suffixes(table)
        owner = ids[doc]
        order = np.lexsort((owner, head))
        head, owner = head[order], owner[order]
        new = np.r_[True, head[1:] != head[:-1]] if len(head) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        keys, n = head[first], np.diff(np.r_[first, len(head)]).astype(np.uint32)
        last = np.r_[first[1:], len(head)] - 1
        multi = (owner[first] != owner[last]).astype(np.uint8) if len(first) else np.zeros(0, np.uint8)
        edge = ex.bounds(keys, bits)
        used = np.flatnonzero(np.diff(edge))
        cut = [slice(edge[b], edge[b + 1]) for b in used]
        return ex.table(SENT1, {"_g": [g] * len(used), "b": used.tolist(), "k": [ex.short(keys[c], bits, 4) for c in cut],
                                "n": [ex.planes(n[c]) for c in cut], "multi": [ex.planes(multi[c]) for c in cut]})

    def count_prefixes(table: pa.Table) -> pa.Table:
        key, part = ex.pieces(table.column("k").to_pylist(), np.uint32)
        n, _ = ex.pieces(table.column("n").to_pylist(), np.uint32)
        multi, _ = ex.pieces(table.column("multi").to_pylist(), np.uint8)
        _, where = np.unique(key, return_inverse=True)
        total = np.bincount(where, weights=n)
        shared = (np.bincount(where) > 1) | (np.bincount(where, weights=multi) > 0)
        kind = np.where(shared, np.where(total > max_suffixes, 2, 1), 0).astype(np.uint8)[where]
        rows = [(g, b, kind[part[i]:part[i + 1]]) for i, (g, b) in enumerate(zip(table.column("_g").to_pylist(), table.column("b").to_pylist()))]
        rows = [r for r in rows if r[2].any()]
        return ex.table(REPLY, {"_g": [r[0] for r in rows], "b": [r[1] for r in rows], "reply": [ex.planes(r[2]) for r in rows]})

    def shared_suffixes(table: pa.Table, side: pa.Table):
        """Suffixes with a shared prefix: their group, path to the window's depth and owner, sorted by (group, path)."""
        w, tokens, at, head, doc, ids = suffixes(table)
        keys, where = np.unique(head, return_inverse=True)
        kind = ex.answers(side, keys, bits, np.uint8)[where]
        live = kind > 0
        at, head, doc, kind = at[live], head[live], doc[live], kind[live]
        path = rolling(tokens, window)[at]
        group = np.where(kind == 2, path, head)
        order = np.lexsort((ids[doc], path, group))
        return w, ids, at[order], group[order], path[order], doc[order]

    def nodes(group: np.ndarray, path: np.ndarray) -> np.ndarray:
        """First row of each (group, path)."""
        return np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (path[1:] != path[:-1])]) if len(path) else np.zeros(0, np.int64)

    def send_suffixes(table: pa.Table, side: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ex.table(SENT2, {"_g": [], "b": [], "k": [], "d": []})
        g = ex.group_id(table)
        _, ids, _, group, path, doc = shared_suffixes(table, side)
        first = nodes(group, path)
        keys, smallest = path[first], ids[doc[first]]
        edge = ex.bounds(group[first], bits)
        used = np.flatnonzero(np.diff(edge))
        cut = [slice(edge[b], edge[b + 1]) for b in used]
        return ex.table(SENT2, {"_g": [g] * len(used), "b": used.tolist(), "k": [ex.planes(keys[c]) for c in cut], "d": [ex.planes(smallest[c]) for c in cut]})

    def subtree(table: pa.Table) -> pa.Table:
        path, part = ex.pieces(table.column("k").to_pylist(), np.uint64)
        doc, _ = ex.pieces(table.column("d").to_pylist(), np.int64)
        order = np.lexsort((doc, path))
        first = np.r_[True, path[order][1:] != path[order][:-1]]
        least = np.empty_like(doc)
        least[order] = doc[order][np.flatnonzero(first)[np.cumsum(first) - 1]]
        return ex.table(REPLY, {"_g": table.column("_g").to_pylist(), "b": table.column("b").to_pylist(),
                                "reply": [ex.planes(least[part[i]:part[i + 1]]) for i in range(table.num_rows)]})

    out_fields = [T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                  T.StructField("kept_sha256", T.StringType()), T.StructField("n_spans", T.LongType())]
    if carry is not None:
        out_fields += [T.StructField("kept_text", T.StringType()), *(docs.schema[c] for c in carry)]

    def remove(table: pa.Table, side: pa.Table) -> pa.Table:
        names = [f.name for f in out_fields]
        first_reply = side.filter(pa.array(np.array(side.column("step").to_pylist(), dtype=object) == 1))
        second_reply = side.filter(pa.array(np.array(side.column("step").to_pylist(), dtype=object) == 2))
        w, ids, at, group, path, doc = shared_suffixes(table, first_reply)
        first = nodes(group, path)
        least = np.full(len(first), ex.NO_ID)
        edge = ex.bounds(group[first], bits)
        for b, raw in zip(second_reply.column("b").to_pylist(), second_reply.column("reply").to_pylist()):
            least[edge[b]:edge[b + 1]] = ex.unplanes(raw, np.int64)
        node = np.cumsum(np.bincount(first, minlength=len(path))) - 1 if len(path) else np.zeros(0, np.int64)
        gone = spans_mask(at[least[node] < ids[doc]], window, len(w.ids))
        before = np.concatenate(([0], np.cumsum(gone)))
        removed = before[w.off[1:]] - before[w.off[:-1]]
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        starts = w.off[:-1][np.diff(w.off) > 0]
        begins[starts] = gone[starts]
        spans = np.concatenate(([0], np.cumsum(begins)))
        spans = spans[w.off[1:]] - spans[w.off[:-1]]
        sha, kept = [], []
        for d, text in enumerate(flat(table.column("_text")).to_pylist()):
            own = text.encode().split()
            if removed[d]:
                stay = ~gone[w.off[d]:w.off[d + 1]]
                own = [x for x, s in zip(own, stay.tolist()) if s]
            joined = b" ".join(own)
            sha.append(hashlib.sha256(joined).hexdigest())
            if carry is not None:
                kept.append(joined.decode() if removed[d] else text)
        columns = [pa.array(ids, pa.int64(), mask=ids == ex.NO_ID), pa.array(np.diff(w.off)), pa.array(removed), pa.array(sha, pa.string()), pa.array(spans)]
        if carry is not None:
            columns += [pa.array(kept, pa.string()), *(table.column(f"_c{i}") for i in range(len(carry)))]
        return pa.table(columns, names=names)

    rows = groups.rows
    sent = rows.groupBy("_g").applyInArrow(send_prefixes, SENT1)
    replies = sent.groupBy("b").applyInArrow(count_prefixes, REPLY)
    sent2 = rows.groupBy("_g").cogroup(replies.groupBy("_g")).applyInArrow(send_suffixes, SENT2)
    replies2 = sent2.groupBy("b").applyInArrow(subtree, REPLY)
    both = replies.selectExpr("_g", "b", "reply", "1 AS step").unionAll(replies2.selectExpr("_g", "b", "reply", "2 AS step"))
    return rows.groupBy("_g").cogroup(both.groupBy("_g")).applyInArrow(remove, T.StructType(out_fields))

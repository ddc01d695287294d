"""Best-fit packing of tokenised documents into fixed-size training sequences.

Tokenising runs next to the scan: a batch's texts are cut where a white-space
run begins, distinct units are encoded once, and a document's ids are gathered
from them.  A unit never shares a token with its neighbour under the byte-level
BPE's pattern (a token holds white space at its start only).  Texts for which
that is not sure (other Unicode white space, special-token strings) are encoded
whole by the ``tokenizers`` library.

Packing is vector best-fit over three residual capacities (tokens, documents,
attention cost as the sum of squared lengths).  Pieces are dealt at random into
blocks of a bounded number of pieces; each block is packed on its own, longest
pieces first, so no task grows with the input and a block wastes a few
sequences at most.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reglink.llm.stage import stage
from reglink.llm.words import flat, slices

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
# white space that the byte-level pattern knows beyond the six ASCII blanks
ODD_SPACE = "[" + "".join(map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])) + "]"


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's printable stand-ins: printable bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_encoders(path: str):
    """The library's tokenizer, a faster encoder of single units with the same vocabulary, and the
    special tokens' strings; loaded once a task."""
    import tiktoken
    from tokenizers import Tokenizer
    import public_tokenizers

    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [t["content"] for t in spec["added_tokens"]]
    alphabet = _byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return whole, tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), special


def encode_ids(text: pa.Array, encoders) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text in one flat array, and each text's bounds in it."""
    whole, units, special = encoders
    odd = pc.match_substring_regex(text, ODD_SPACE).to_numpy(zero_copy_only=False)
    for s in special:
        odd = odd | pc.match_substring(text, s).to_numpy(zero_copy_only=False)
    plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), text)
    off = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset:plain.offset + len(plain) + 1] if len(plain) else np.zeros(1, np.int64)
    raw = plain.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data) + 1, bool)
    if len(data):
        first[1:-1] = blank[1:] & ~blank[:-1]
    first[off] = True
    cuts = np.flatnonzero(first).astype(np.int64)
    if len(data):
        arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])
        enc = arr.dictionary_encode()
        at = enc.indices.to_numpy(zero_copy_only=False)
        ids = [units.encode_ordinary(u.decode()) for u in enc.dictionary.to_pylist()]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        table = np.fromiter((i for u in ids for i in u), np.uint32, int(size.sum()))
        begin = np.cumsum(size) - size
        n = size[at]
        ends = np.cumsum(n)
        out = table[np.repeat(begin[at] - (ends - n), n) + np.arange(int(n.sum()))]
        bounds = np.concatenate(([0], ends))[np.searchsorted(cuts, off)]
    else:
        out, bounds = np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    if odd.any():
        parts = []
        for i, (t, o) in enumerate(zip(text.to_pylist(), odd.tolist())):
            parts.append(np.array(whole.encode(t, add_special_tokens=False).ids, np.uint32) if o else out[bounds[i]:bounds[i + 1]])
        bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        out = np.concatenate(parts)
    return out, bounds


def token_pieces(docs: DataFrame, tokenizer: str, seq_len: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece of every document: its ids followed by ``end_id``; a document of
    more than ``seq_len`` ids is cut into pieces of ``seq_len``, the first one shorter.
    Null text counts as empty.  ``ids_crc32`` is over little-endian unsigned 32-bit ids."""

    def pieces(batches):
        encoders = None
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                encoders = encoders or load_encoders(tokenizer)
                ids, at = encode_ids(flat(batch.column("text").slice(lo, hi - lo)), encoders)
                doc_ids = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                rows: list[tuple] = []
                for d, doc_id in enumerate(doc_ids):
                    own = np.append(ids[at[d]:at[d + 1]], np.uint32(end_id)).astype("<u4")
                    n = len(own)
                    end, start, k = (n - 1) % seq_len + 1, 0, 0
                    while start < n:
                        rows.append((doc_id, k, start, end - start, zlib.crc32(own[start:end].tobytes())))
                        start, end, k = end, end + seq_len, k + 1
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                        names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(pieces, PIECES)


def best_fit(length: np.ndarray, tokens: int, documents: int, cost: float,
             weights: tuple[float, float, float] = (1.0, 0.0, 0.0), rule: str = "norm") -> np.ndarray:
    """Bin number per piece; ``length`` must descend.  Of the open bins with room in every
    dimension, ``norm`` takes the one with the smallest weighted norm of what stays
    free, ``dot`` the one with the largest weighted dot product of demand and residual."""
    n = len(length)
    capacity = np.array([tokens, documents, cost], float)
    scale = np.array(weights, float)
    free = np.zeros((3, 1024))
    number = np.zeros(1024, np.int64)       # bin number of each open slot
    used, bins = 0, 0
    out = np.zeros(n, np.int64)
    least = np.array([length[-1], 1, float(length[-1]) ** 2]) if n else None
    for i in range(n):
        need = np.array([length[i], 1.0, float(length[i]) ** 2])
        room = free[:, :used]
        fits = (room >= need[:, None]).all(axis=0)
        slot = -1
        if fits.any():
            cand = np.flatnonzero(fits)
            share = room[:, cand] / capacity[:, None]
            want = (need / capacity)[:, None]
            if rule == "norm":
                slot = int(cand[np.argmin((scale[:, None] * (share - want) ** 2).sum(axis=0))])
            else:
                slot = int(cand[np.argmax((scale[:, None] * share * want).sum(axis=0))])
        if slot < 0:
            if (need > capacity).any():     # alone in a bin: no bin could ever hold it
                out[i] = bins
                bins += 1
                continue
            if used == free.shape[1]:
                free = np.concatenate([free, np.zeros_like(free)], axis=1)
                number = np.concatenate([number, np.zeros_like(number)])
            slot = used
            free[:, slot], number[slot] = capacity, bins
            used, bins = used + 1, bins + 1
        out[i] = number[slot]
        free[:, slot] -= need
        if (free[:, slot] < least).any():   # nothing fits any more: close it
            used -= 1
            free[:, slot], number[slot] = free[:, used], number[used]
    return out


def pack(pieces: DataFrame, seq_len: int = 1024, max_documents: int | None = None, max_cost: float | None = None,
         weights: tuple[float, float, float] = (1.0, 0.0, 0.0), rule: str = "norm", block_pieces: int = 16384) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of ``token_pieces``.

    ``pieces`` is read twice (a count, then the packing), so stage it first.
    ``block_pieces`` bounds the rows that one task packs together, whatever the input.
    Empty input gives an empty result; repeated rows are packed one by one."""
    documents = float(max_documents or seq_len)
    cost = float(max_cost or seq_len ** 2)
    blocks = max(1, -(-pieces.count() // block_pieces))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable")
        length = pdf["length"].to_numpy(np.int64)
        whole = length >= seq_len            # first, as the lengths descend
        n = int(whole.sum())
        bins = np.concatenate([np.arange(n), n + best_fit(length[n:], seq_len, documents, cost, weights, rule)])
        order = np.argsort(bins, kind="stable")
        sums = np.cumsum(length[order]) - length[order]
        head = np.r_[True, np.diff(bins[order]) != 0]
        offset = np.empty(len(bins), np.int64)
        offset[order] = sums - np.maximum.accumulate(np.where(head, sums, 0))
        pdf["sequence_id"] = (pdf["_block"].to_numpy(np.int64) << 32) + bins
        pdf["offset"] = offset
        return pdf.drop(columns="_block").astype({"doc_id": "Int64"})

    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    return dealt.groupBy("_block").applyInPandas(one, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, seq_len: int = 1024, end_id: int = 2, **options) -> DataFrame:
    """Tokenise and pack all documents."""
    return pack(stage(token_pieces(docs, tokenizer, seq_len, end_id), "pieces"), seq_len, **options)

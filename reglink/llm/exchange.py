"""Corpus-wide statistics of word n-grams with few, packed shuffle rows.

Documents are dealt into groups of a few megabytes of text by a hash of (id, text).  A
group sends its *distinct* keys once (64-bit hashes, sorted) to key buckets, packed as one
row per (group, bucket); a bucket merges its senders and answers each of them with one value
per key in the order sent.  So

* a key that a third of all rows hold reaches its bucket once per group, not once per row;
* an answer needs no keys, and a group or a bucket is bounded memory at any corpus size
  (their numbers grow with the text);
* the documents are shuffled once: every later step of the same plan reuses that exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_BYTES = 4 << 20
BUCKET_KEYS = 1 << 19
BYTES_A_WORD = 6
NO_ID = np.int64(2 ** 63 - 1)        # stands for a null doc_id: larger than every other


@dataclass
class Groups:
    """Documents by group: columns ``_g`` int, ``_id`` long (null: NO_ID), ``_text`` string, then the carried columns as ``_c0``, ``_c1``, ..."""

    rows: DataFrame
    n: int
    bits: int            # of the number of key buckets


def text_groups(docs: DataFrame, carry: list[str] | None = None, group_bytes: int = GROUP_BYTES, bucket_keys: int = BUCKET_KEYS) -> Groups:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-total // group_bytes))
    bits = max(0, int(total // BYTES_A_WORD // bucket_keys)).bit_length()
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("_id"), text.alias("_text"), *(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry or [])))
    return Groups(rows.select(group_of(n).alias("_g"), "*"), n, bits)


def group_of(n: int):
    return F.pmod(F.xxhash64("_id", "_text"), F.lit(n)).cast("int")


def planes(a: np.ndarray, width: int | None = None) -> bytes:
    """Bytes of the numbers, lowest bytes first and together: runs of equal high bytes compress."""
    b = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize)
    return np.ascontiguousarray(b[:, :width].T).tobytes()


def unplanes(raw: bytes, dtype, width: int | None = None) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    w = width or size
    n = len(raw) // w
    out = np.zeros((n, size), np.uint8)
    out[:, :w] = np.frombuffer(raw, np.uint8).reshape(w, n).T
    return out.view(dtype).ravel()


def dense(a: np.ndarray, width: int | None = None) -> bytes:
    """``planes``, entropy-coded: for counts and other numbers of few bits."""
    return zstandard.compress(planes(a, width), 1)


def undense(raw: bytes, dtype, width: int | None = None) -> np.ndarray:
    return unplanes(zstandard.decompress(raw), dtype, width)


def packed(rows: DataFrame, level: int = 1) -> DataFrame:
    """Each group's rows of an Arrow batch as one compressed row (``_g``, ``part``): less to shuffle."""

    def pack(batches):
        for batch in batches:
            groups = batch.column("_g").to_numpy()
            for g in np.unique(groups).tolist():
                own = batch.filter(pa.array(groups == g)).drop_columns(["_g"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema) as out:
                    out.write_batch(own)
                yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([zstandard.compress(sink.getvalue(), level)], pa.binary())], names=["_g", "part"])

    return rows.mapInArrow(pack, "_g int, part binary")


def unpacked(table: pa.Table) -> pa.Table:
    """The rows of a group of ``packed`` rows (at least one)."""
    parts = []
    for raw in table.column("part").to_pylist():
        with pa.ipc.open_stream(zstandard.decompress(raw)) as part:
            parts.append(part.read_all())
    return pa.concat_tables(parts)


def bounds(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2**bits buckets begins in sorted keys, and their end."""
    if not bits:
        return np.array([0, len(keys)])
    edge = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(keys, edge), [len(keys)]))


def short(keys: np.ndarray, bits: int, width: int) -> bytes:
    """Keys without their bucket's bits, cut to ``width`` bytes: their order stays."""
    return planes((keys << np.uint64(bits)) >> np.uint64(64 - 8 * width), width)


def group_id(table: pa.Table) -> int:
    return table.column("_g")[0].as_py()


def answers(side: pa.Table, keys: np.ndarray, bits: int, dtype, read=unplanes) -> np.ndarray:
    """One value per sorted key from the buckets' replies (0 where a bucket sent none)."""
    out = np.zeros(len(keys), dtype)
    at = bounds(keys, bits)
    for b, raw in zip(side.column("b").to_pylist(), side.column("reply").to_pylist()):
        if raw is not None and b is not None and b >= 0:
            out[at[b]:at[b + 1]] = read(raw, dtype)
    return out


def pieces(raws: list[bytes], dtype, width: int | None = None, read=unplanes) -> tuple[np.ndarray, np.ndarray]:
    """Packed arrays of several senders as one, and the bounds of each sender's part."""
    parts = [read(r, dtype, width) for r in raws]
    return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def table(schema: str, columns: dict[str, list]) -> pa.Table:
    """Arrow table of a DDL schema with long, int and binary columns."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64()}
    fields = [f.strip().split() for f in schema.split(",")]
    return pa.table([pa.array(columns[name], kinds[kind]) for name, kind in fields], names=[name for name, _ in fields])

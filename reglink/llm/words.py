"""Vectorised word handling for Arrow batches (numpy inside Spark tasks).

A word is a maximal run of bytes other than space and \\x09-\\x0D.  Those bytes
never occur inside a multi-byte UTF-8 sequence, so splitting bytes is the same
as splitting code points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """Words of a batch of documents: ``ids[off[d]:off[d + 1]]`` are document d's."""

    ids: np.ndarray        # int64 index into the batch's vocabulary
    off: np.ndarray        # int64, one more than documents
    vocab: pa.Array        # distinct words of the batch (binary)
    hashes: np.ndarray     # uint64 content hash per vocabulary word

    @property
    def tokens(self) -> np.ndarray:
        """Content hash per word occurrence."""
        return self.hashes[self.ids]

    @property
    def doc(self) -> np.ndarray:
        """Document number per word occurrence."""
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(column) -> pa.Array:
    """One contiguous array of a (chunked) text column; null becomes empty.

    A slice is copied, so that its bytes begin at 0: kernels such as ``ascii_lower`` don't read
    an array right whose first offset lies further on."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    column = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(column, "") if column.null_count else column


def split(column, lower: bool = False) -> Words:
    """Words of every text.  ``lower`` lower-cases A-Z only."""
    text = flat(column)
    if lower:
        text = pc.ascii_lower(text)
    parts = pc.ascii_split_whitespace(text)
    off = parts.offsets.to_numpy().astype(np.int64)
    words = parts.flatten()
    off = off - (off[0] if len(off) else 0)
    enc = words.cast(pa.large_binary()).dictionary_encode()
    ids = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocab = enc.dictionary
    empty = pc.binary_length(vocab).to_numpy(zero_copy_only=False) == 0
    if empty.any():                      # leading or trailing blanks leave empty parts
        keep = ~empty[ids]
        before = np.concatenate(([0], np.cumsum(keep)))
        off, ids = before[off], ids[keep]
    raw = vocab.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in raw), np.uint64, len(raw))
    return Words(ids, off, vocab, hashes)


def rolling(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each position (the last n - 1 positions are cut)."""
    size = len(tokens) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(size, np.uint64)
    for i in range(n):
        h = h * STEP + tokens[i:size + i]
    return mix(h)


def window_starts(off: np.ndarray, n: int) -> np.ndarray:
    """Mask over rolling(.., n): the window lies inside one document."""
    total = int(off[-1])
    size = max(0, total - n + 1)
    ok = np.zeros(size, bool)
    if size:
        doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
        ok = doc[:size] == doc[n - 1:]
    return ok


def spans_mask(starts: np.ndarray, width: int, total: int) -> np.ndarray:
    """Positions covered by windows of ``width`` that begin at ``starts``."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, total), -1)
    return np.cumsum(edge[:-1]) > 0


def slices(column, limit: int = 4 << 20):
    """Row ranges of a text column with about ``limit`` bytes each (a longer text is a range of its own)."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin, held = 0, 0
    for i, s in enumerate(size.tolist()):
        if i > begin and held + s > limit:
            yield begin, i
            begin, held = i, 0
        held += s
    if begin < len(size):
        yield begin, len(size)

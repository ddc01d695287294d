"""Maximal runs of kept characters of every text of an Arrow batch, by a table over bytes.

A separator is one byte below 128 or, where only a block of characters is kept, each byte of
any other character; separators become blanks in the text's own buffer, so offsets stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reglink.llm.words import flat

BLANK = 0x20


@dataclass
class Runs:
    """Runs of a batch: ``ids[off[d]:off[d + 1]]`` are document d's, as numbers into ``vocab``."""

    ids: np.ndarray
    off: np.ndarray
    vocab: pa.Array        # distinct runs (large_string)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))


def table(kept: str, high: bool) -> np.ndarray:
    """What each byte becomes: A-Z lower-cased, the ASCII characters ``kept`` and, with ``high``, bytes from
    128 as they are, all else a blank."""
    out = np.full(256, BLANK, np.uint8)
    for c in kept.encode():
        out[c] = c + 32 if 65 <= c <= 90 else c
    if high:
        out[128:] = np.arange(128, 256)
    return out


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TERMS = table(LETTERS + "0123456789", high=True)       # all but ASCII separators
LATIN = table(LETTERS, high=False)                     # with U+00C0 to U+00FF, see ``latin_runs``


def _folded(text: pa.Array, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(text), [None, text.buffers()[1], pa.py_buffer(np.ascontiguousarray(data))])


def _bytes(text: pa.Array) -> np.ndarray:
    raw = text.buffers()[2]
    return np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)


def _split(text: pa.Array) -> Runs:
    parts = pc.ascii_split_whitespace(text)
    off = parts.offsets.to_numpy().astype(np.int64)
    enc = parts.flatten().dictionary_encode()
    ids = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    off = off - (off[0] if len(off) else 0)
    blank = pc.binary_length(enc.dictionary).to_numpy(zero_copy_only=False) == 0
    if blank.any():                        # blanks at a text's ends leave empty parts
        keep = ~blank[ids]
        before = np.concatenate(([0], np.cumsum(keep)))
        off, ids = before[off], ids[keep]
    return Runs(ids, off, enc.dictionary)


def term_runs(column) -> Runs:
    """Maximal runs of characters other than ASCII separators; A-Z lower-cased.  Null: none."""
    text = flat(column)
    return _split(_folded(text, TERMS[_bytes(text)]))


def latin_runs(column) -> Runs:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF; A-Z lower-cased.  Null: none.

    The block is every character of lead byte C3."""
    text = flat(column)
    raw = _bytes(text)
    lead = raw == 0xC3
    data = LATIN[raw]
    data[lead] = 0xC3
    after = np.flatnonzero(lead) + 1
    data[after] = raw[after]
    return _split(_folded(text, data))

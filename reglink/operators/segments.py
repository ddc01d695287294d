"""Segment filter for distance joins (Li, Deng, Wang, Feng: Pass-Join, VLDB 2011).

If ``dist(r, s) <= tau`` (edit or indel distance) and ``r`` is cut into
``tau + 1`` even segments, ``s`` holds one segment unchanged, starting inside
a small window around the segment's own position.  So candidate pairs are an
ordinary equi-join on ``(len(r), segment_no, segment_text)``:

* index side: every string emits its ``tau(L) + 1`` segments;
* probe side: every string emits, for each index length ``L`` it could pair
  with, the substrings that start inside the multi-match-aware windows.

``tau(L)`` is the largest budget any partner of a length-``L`` string can
have, so the filter is exact for every pair; the caller verifies with the
real distance.  Only lengths that occur on the index side are probed (a
join with the distinct index lengths, a table bounded by the longest string).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEG_LEN = "_seg_L"
SEG_NO = "_seg_i"
SEG_TXT = "_seg_txt"

# The generators are SQL expression strings: one parse instead of hundreds
# of py4j calls to build nested lambdas.  ``tau``/``band`` map a SQL
# expression (a length) to SQL expressions.
SqlFn = Callable[[str], str]


def _layout(df: DataFrame, tau: SqlFn, per_edit: int = 1) -> DataFrame:
    """Add ``_k`` (budget), ``_n`` (segments), ``_base``, ``_extra`` for ``_seg_L``.

    ``per_edit`` is how many segments one unit of distance can spoil: 1 for
    Levenshtein/indel, 2 with adjacent transpositions (a swap across a
    boundary), so ``_n = per_edit * _k + 1`` keeps one segment intact."""
    df = df.selectExpr("*", f"CAST({tau(SEG_LEN)} AS INT) AS _k")
    n = f"({per_edit} * _k + 1)"
    df = df.selectExpr("*", f"{n} AS _n", f"CAST(floor(_seg_L / {n}) AS INT) AS _base")
    return df.selectExpr("*", "_seg_L - _base * _n AS _extra")


# start and length of segment i; the last ``_extra`` segments are one char longer
_SEG_START = "(i * _base + greatest(0, i - (_n - _extra)))"
_SEG_LEN = "(_base + IF(i >= _n - _extra, 1, 0))"


def index_segments(df: DataFrame, text: str, tau: SqlFn, per_edit: int = 1) -> DataFrame:
    """Emit ``(_seg_L, _seg_i, _seg_txt)`` for every segment of ``text``."""
    cols = [f"`{c}`" for c in df.columns]
    out = _layout(df.where(F.length(text) > 0).selectExpr("*", f"length(`{text}`) AS {SEG_LEN}"), tau, per_edit)
    gen = (f"inline(transform(sequence(0, _n - 1), i -> named_struct("
           f"'{SEG_NO}', i, '{SEG_TXT}', substring(`{text}`, {_SEG_START} + 1, {_SEG_LEN}))))")
    return out.selectExpr(*cols, SEG_LEN, gen)


def probe_segments(df: DataFrame, text: str, index_lengths: DataFrame, band: Callable[[str], tuple[str, str]],
                   tau: SqlFn, per_edit: int = 1, min_pair_len: int | None = None) -> DataFrame:
    """Emit ``(_seg_L, _seg_i, _seg_txt)`` substrings of ``text`` to be joined
    against :func:`index_segments` of the other side.

    ``index_lengths`` holds one column ``_seg_L`` with the distinct lengths of
    the index side; ``band(l)`` gives the inclusive range of index lengths a
    probe string of length ``l`` can pair with.  ``min_pair_len`` keeps only
    length pairs whose longer side reaches it (shorter pairs are handled by
    another generator).
    """
    cols = [f"`{c}`" for c in df.columns]
    lo, hi = band(f"length(`{text}`)")
    out = df.where(F.length(text) > 0).selectExpr(
        "*", f"explode(sequence(greatest({lo}, 1), {hi})) AS {SEG_LEN}")
    # Only lengths that exist on the index side: a table of at most
    # max(length) rows, so the broadcast is bounded by construction.
    if min_pair_len is not None:
        out = out.where(f"greatest(length(`{text}`), {SEG_LEN}) >= {min_pair_len}")
    out = out.join(F.broadcast(index_lengths), SEG_LEN, "left_semi")
    out = _layout(out.selectExpr("*", f"length(`{text}`) AS _l"), tau, per_edit)
    if per_edit == 1:
        # multi-match-aware window of segment i, clipped to the probe string
        w_lo = f"greatest({_SEG_START} - i, {_SEG_START} + (_l - _seg_L) - (_k - i), 0)"
        w_hi = f"least({_SEG_START} + i, {_SEG_START} + (_l - _seg_L) + (_k - i), _l - {_SEG_LEN})"
    else:
        # position- and shift-bounded window: at most _k inserts/deletes
        # before the segment, and at most _k after it
        w_lo = f"greatest({_SEG_START} - _k, {_SEG_START} + (_l - _seg_L) - _k, 0)"
        w_hi = f"least({_SEG_START} + _k, {_SEG_START} + (_l - _seg_L) + _k, _l - {_SEG_LEN})"
    gen = (f"inline(flatten(transform(sequence(0, _n - 1), i -> transform("
           f"CASE WHEN {w_lo} <= {w_hi} THEN sequence({w_lo}, {w_hi}) ELSE CAST(array() AS ARRAY<INT>) END, "
           f"pos -> named_struct('{SEG_NO}', i, '{SEG_TXT}', substring(`{text}`, pos + 1, {_SEG_LEN}))))))")
    return out.selectExpr(*cols, SEG_LEN, gen)

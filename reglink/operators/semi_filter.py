"""Bloom-filter semi-join: a large side is cut down, before its shuffle, to the rows whose key a small side may hold.

The filter is one 64-bit word per ``KEYS_A_WORD`` keys; a key sets ``BITS`` bits of the word that its hash names.  Words are
rows, made by ``bit_or``, so the filter is an ordinary aggregate and is never on the driver as a whole; its size follows from
the counted keys and is checked: beyond ``MAX_WORDS`` the large side stays as it is.  No row with a key of the
small side is lost, some 1 % of the others stay, and the join that follows drops them: the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_A_WORD = 4
BITS = 3
MAX_WORDS = 1 << 22        # about 200 MB as a broadcast relation


def _hash(cols: list[str]) -> Column:
    return F.xxhash64(*(F.col(f"`{c}`") for c in cols))


def _mask(h: Column) -> Column:
    """``BITS`` of 64 bits, from the upper part of the hash."""
    mask = None
    for i in range(BITS):
        place = F.pmod(F.shiftright(h, 40 + 6 * i), F.lit(64)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return mask


def might_hold(big: DataFrame, small: DataFrame, cols: list[str], n_small: int) -> DataFrame:
    """Rows of ``big`` whose ``cols`` may occur in ``small``; ``n_small``: an upper bound of the keys of ``small``.

    Null keys go (they join nothing), repeated rows of ``big`` stay repeated."""
    words = max(1, -(-n_small // KEYS_A_WORD))
    if words > MAX_WORDS:
        return big
    names = big.columns

    def keyed(df: DataFrame) -> DataFrame:
        for c in cols:
            df = df.where(F.col(f"`{c}`").isNotNull())
        return df.withColumn("_h", _hash(cols)).withColumn("_w", F.pmod("_h", F.lit(words)))

    bloom = keyed(small.select(*cols)).groupBy("_w").agg(F.bit_or(_mask(F.col("_h"))).alias("_bits"))
    held = keyed(big).join(F.broadcast(bloom), "_w")
    return held.where(F.col("_bits").bitwiseAND(_mask(F.col("_h"))) == _mask(F.col("_h"))).select(*names)

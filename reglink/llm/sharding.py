"""Rendezvous (highest random weight) hashing of record keys over weighted shards.

Each key draws one score per shard from a digest of (key, shard, seed) and goes to the
shard of the highest score, so an added shard only takes rows into itself and a
removed one only gives its own rows away.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reglink.llm.stage import numbered

LAW = "key"


def shard_score(key: Column, shard: int, weight: float | None, seed: str) -> Column:
    """Score of one shard: ``-weight / ln(u)`` with u in (0, 1) from 52 bits of an md5.

    Weight None: all weights are equal, the order of the scores is that of u, and u is used."""
    digest = F.md5(F.concat(key, F.lit(f"/{shard}/{seed}")).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    if weight is None:
        return bits.cast("double")
    return F.lit(-float(weight)) / F.log((bits + 0.5) / F.lit(float(2 ** 52)))


def rendezvous(key: Column, weights: Sequence[float], seed: str = "") -> Column:
    """Shard number of a key: the highest score, ties to the smaller shard.
    A null key is the key ``null``.  A shard of weight 0 gets nothing."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    live = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("no shard has a weight above 0")
    equal = len({w for _, w in live}) == 1
    scored = F.array(*[F.struct(shard_score(text, i, None if equal else w, seed).alias("s"), F.lit(-i).alias("i")) for i, w in live])
    return (-F.array_max(scored).getField("i")).cast("int")


def shard_documents(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, seed: str = "",
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """Place every row: key, ``size`` (UTF-8 bytes of the text, null: none, plus 8),
    ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` (the shard under the
    weights ``grown``).

    Slots run from 0 without gaps in each shard in key order (null keys first).  Rows
    with one key go to one shard by definition; their slots are still given in
    parallel.  Null text has size 8 and the checksum of empty text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias(key),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous(F.col(key), weights, seed).alias("shard"),
        (rendezvous(F.col(key), grown, seed) if grown is not None else F.lit(None).cast("int")).alias("grown_shard"))
    out = numbered(rows, "shard", [F.col(key), F.col("text_crc32"), F.col("size")], "slot", "shards")
    return out.select(key, "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")

"""Sharding by rendezvous hashing: a record's key and the weights of the shards decide, nothing else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terraquilt.llm.common import number_equal_rows, settle, text_of

_UNIT = float(2**52)


def rendezvous_shard(key: Column, weights: Sequence[float], seed: int = 17) -> Column:
    """The shard with the greatest score ``weight / -ln(u)``, u a uniform hash of key and shard.

    A shard's scores don't depend on the others, so adding a shard moves to it just the keys it
    wins, and no key moves between the old ones; a shard gets its weight's share of the keys.
    Shards without weight get nothing. A NULL key counts as a key of its own. Ties go to the
    greater shard number, which cannot happen for two different hashes.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    scores = []
    for shard, weight in enumerate(weights):
        if weight == 0:
            continue
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard), F.lit(seed)), 12)
        unit = (bits + F.lit(0.5)) / F.lit(_UNIT)
        scores.append(F.struct((F.lit(float(weight)) / -F.log(unit)).alias("score"), F.lit(shard).alias("shard")))
    return (F.greatest(*scores) if len(scores) > 1 else scores[0])["shard"]


def assign_shards(docs: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * 8,
                  grown: Sequence[float] | None = None, seed: int = 17) -> DataFrame:
    """Add ``shard`` (and ``grown_shard`` under the weights ``grown``) to every row; no shuffle.

    Columns of these names that the input has are replaced. An empty table stays empty.
    """
    out = docs.withColumn("shard", rendezvous_shard(F.col(key), weights, seed))
    return out.withColumn("grown_shard", rendezvous_shard(F.col(key), grown, seed)) if grown else out


def shard_layout(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Where each record goes: its shard, its slot there, and its shard when one more is added.

    size is the UTF-8 bytes of the text plus 1, text_crc32 the unsigned CRC of those bytes; a
    NULL text has no bytes (size 1, CRC 0). Slots are gapless from 0 in each shard, by hash
    block and key; repeated rows get slots of their own, and are counted before they are numbered. Other columns are left out.
    """
    narrow = docs.select(
        F.col(key),
        (F.octet_length(text_of(text)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text_of(text), "UTF-8")).alias("text_crc32"),
    )
    placed = settle(assign_shards(narrow, key, (1.0,) * shards, (1.0,) * (shards + 1)), "shards")
    return number_equal_rows(placed, ["shard"], [key, "text_crc32"], "slot")

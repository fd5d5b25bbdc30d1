"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Every row gets a number in the order of its id. A keyed permutation of ``0 .. n-1`` moves
the number, and the moved number alone gives shard and slot: the shuffle is reproducible,
any row's place can be computed without the table, and ``number_at`` walks back from a
place to the row. Row counts of shards differ by one at most (law ``rows``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import numbered, table

ROUNDS = 6
SEED = 20_240_601
SHARDS = 40
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _half_bits(n: int) -> int:
    """Half the width of the smallest even-width domain that holds ``0 .. n-1``."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _mixed(half: np.ndarray, key: int) -> np.ndarray:
    x = half + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    mask = (1 << 64) - 1
    return [(seed * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) & mask for i in range(1, ROUNDS + 1)]


def _network(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for key in keys:
        left, right = right, left ^ (_mixed(right, key) & low)
    # halves swapped once more, so that the reversed keys undo the network
    return (right << np.uint64(bits)) | left


def permute(numbers: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """The permutation of ``0 .. n-1`` (its inverse with ``back``) at ``numbers``.

    The network permutes a power of four that is less than four times ``n`` (or 4); values
    that fall outside are sent through again until they are inside.
    """
    keys = _keys(seed)[:: -1 if back else 1]
    bits = _half_bits(n)
    with np.errstate(over="ignore"):
        x = _network(np.asarray(numbers, dtype=np.uint64), bits, keys)
        out = x >= np.uint64(n)
        while out.any():
            x[out] = _network(x[out], bits, keys)
            out = x >= np.uint64(n)
    return x.astype(np.int64)


def place(numbers, n: int, shards: int, seed: int = SEED):
    """Shard and slot of row numbers."""
    moved = permute(numbers, n, seed)
    return moved % shards, moved // shards


def number_at(shard, slot, n: int, shards: int, seed: int = SEED) -> np.ndarray:
    """Row numbers at the given places: what a reader of one shard needs."""
    return permute(np.asarray(slot) * shards + np.asarray(shard), n, seed, back=True)


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, text_crc32, law, row_number, shard, slot, grown_shard.

    The size is the text's UTF-8 bytes plus 16; a null text counts as empty. Null ids come
    first in the numbering, rows of one id follow their checksum, equal rows are
    interchangeable and still get places of their own. An empty table gives an empty
    result, more shards than rows leave shards empty. Only ids, sizes and checksums are
    shuffled, never texts; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    rows, n = numbered(narrow, "doc_id", "text_crc32", "size", label="shard-rows")

    @F.pandas_udf("shard int, slot bigint")
    def placed(numbers: pd.Series) -> pd.DataFrame:
        shard, slot = place(numbers.to_numpy(), n, shards, seed)
        return pd.DataFrame({"shard": shard.astype(np.int32), "slot": slot})

    return rows.withColumn("_at", placed("row_number")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("_at.shard").alias("shard"), F.col("_at.slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))

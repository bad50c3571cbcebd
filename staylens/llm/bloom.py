"""A blocked Bloom filter kept as a table with one row per block of 256 bits.

A key's hash picks one block and eight bits in it, so building is a bitwise-or per
block, which merges in any order, and probing is one equi-join and four comparisons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.text import lookup_join

BLOCK_LONGS = 4
BITS_PER_KEY = 12
# What a block takes in a broadcast table.
BLOCK_BYTES = 64


def _bits(key: str) -> list[Column]:
    """Two bits in each long of the block."""
    spread = F.xxhash64(F.lit("bits"), F.col(key))

    def bit(shift):
        at = F.shiftrightunsigned(spread, shift).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)

    return [bit(12 * i).bitwiseOR(bit(12 * i + 6)) for i in range(BLOCK_LONGS)]


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(blocks))


def block_count(keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    return keys * bits_per_key // (64 * BLOCK_LONGS) + 1


def build_bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """Columns block, b0..b3; only blocks with a key are present."""
    masks = [m.alias(f"b{i}") for i, m in enumerate(_bits(key))]
    rows = listed.select(_block(key, blocks).alias("block"), *masks)
    return rows.groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"b{i}") for i in range(BLOCK_LONGS)])


def probe_bloom(rows: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with a column ``possible``: false only where the key is not listed."""
    tested = rows.withColumn("block", _block(key, blocks))
    joined = lookup_join(tested, bloom, "block", "left", blocks, BLOCK_BYTES)
    held = [F.col(f"b{i}").bitwiseAND(m) == m for i, m in enumerate(_bits(key))]
    possible = F.coalesce(held[0] & held[1] & held[2] & held[3], F.lit(False))
    return joined.withColumn("possible", possible).drop("block", *(f"b{i}" for i in range(BLOCK_LONGS)))

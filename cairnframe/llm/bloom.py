"""A blocked Bloom filter as a table: one row for each block of seven 64-bit words.

A key is a 64-bit hash. Its highest bits choose the block, seven groups of six bits choose one bit in
each word, so a probe touches one block: one row, found by an equi-join on the block's number.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 7
BITS_PER_KEY = 14
#: 2^18 blocks of 56 bytes (15 MB) hold 8 million keys at the full rate; more keys only let more false positives pass.
MAX_BLOCK_BITS = 18


def block_bits(keys: int, max_block_bits: int = MAX_BLOCK_BITS) -> int:
    """The number of blocks for so many keys, as a power of two: at least two blocks, never more than the bound."""
    blocks = max(2, -(-keys * BITS_PER_KEY // (64 * WORDS)))
    return min(max_block_bits, (blocks - 1).bit_length())


def block_of(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits)


def bit_in_word(key: Column, word: int) -> Column:
    """The word of zeros and the one bit that `key` has in it."""
    place = F.shiftrightunsigned(key, 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def build(keys: DataFrame, bits: int) -> DataFrame:
    """(block, w0 to w6) of `keys` (key long); blocks without a key have no row. Partial sums come before the shuffle."""
    rows = keys.where("key is not null").select(block_of(F.col("key"), bits).alias("block"), *(bit_in_word(F.col("key"), i).alias(f"w{i}") for i in range(WORDS)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))


def with_possible(rows: DataFrame, key: str, blocks: DataFrame, bits: int) -> DataFrame:
    """`rows` with a boolean column `possible`: false only for keys that were not built in.

    The blocks are broadcast: at most 2^MAX_BLOCK_BITS rows of eight numbers, whatever was built in.
    """
    found = blocks.select(F.col("block").alias("__block"), *(F.col(f"w{i}").alias(f"__w{i}") for i in range(WORDS)))
    joined = rows.join(F.broadcast(found), block_of(F.col(key), bits) == F.col("__block"), "left")
    tests = [F.col(f"__w{i}").bitwiseAND(bit_in_word(F.col(key), i)) != 0 for i in range(WORDS)]
    possible = F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
    return joined.select(*(F.col(f"`{c}`") for c in rows.columns), possible.alias("possible"))


def as_array(blocks: DataFrame, bits: int) -> np.ndarray:
    """The filter as an array (block, word), for tasks that probe in numpy; its size has the bound of the blocks."""
    out = np.zeros((1 << bits, WORDS), np.uint64)
    for row in blocks.collect():
        out[row["block"]] = [x & 0xFFFFFFFFFFFFFFFF for x in row[1:]]
    return out


def possible_in(filter_array: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the `keys` (uint64) may have been built in."""
    bits = len(filter_array).bit_length() - 1
    blocks = filter_array[(keys >> np.uint64(64 - bits)).astype(np.int64)]
    out = np.ones(len(keys), bool)
    for i in range(WORDS):
        out &= (blocks[:, i] >> ((keys >> np.uint64(6 * i)) & np.uint64(63))) & np.uint64(1) == 1
    return out

"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows get a global number 0..n-1 by (doc_id, size, CRC-32, hash of the whole row), so it depends on
the rows alone and not on files or partitions. A Feistel network permutes the numbers of the least
power of two that holds n; a result of n or more walks on along its cycle until it is below n
(cycle walking), which makes a permutation of 0..n-1. Place p goes to shard ``p mod shards``, slot
``p div shards``: shards differ by one row at most, slots have no gap, and both can be computed, in
either direction, from a row number, n and the seed alone (``permute``, ``unpermute``).

Every row is written once with its keys, shuffled once into ranges of the order, and numbered by
prefix sums of the counts of the ranges. The last key of the order is the row's position, so that
even very many equal rows are dealt to several ranges; which of them gets which number is then
open, and does not change the result, as they are equal in everything.

Defined cases: a null text has size 1 and the CRC of no bytes; null doc_ids come after all others;
repeated rows are rows of their own; map columns are carried but do not take part in the order; an
empty table gives an empty result; columns are carried inside ``row``, so that names cannot clash.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import packed, stage
from affinia.plans.numbering import numbered

SHARDS = 16
SEED = 20_240_229
ROUNDS = 8
# Odd multipliers of the round function, below 2^31 so that products fit 64 bits.
MULTIPLIERS = (0x6C8E9CF5, 0x2C1B3C6D)


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    return [random.Random(f"{seed}:{i}").getrandbits(32) for i in range(rounds)]


def widths(n: int) -> tuple[int, int]:
    """Bits of the left and of the right half for numbers below ``n``."""
    bits = max(2, (n - 1).bit_length())
    if bits > 62:
        raise ValueError("more rows than 2^62")
    return bits // 2, bits - bits // 2


def _mixed(half: np.ndarray, key: int, width: int) -> np.ndarray:
    """The round function: ``width`` bits from a half of up to 31 bits."""
    low = np.uint64(0xFFFFFFFF)
    z = (half * np.uint64(MULTIPLIERS[0]) + np.uint64(key)) & low
    z ^= z >> np.uint64(15)
    z = (z * np.uint64(MULTIPLIERS[1])) & low
    z ^= z >> np.uint64(13)
    return z & np.uint64((1 << width) - 1)


def _network(x: np.ndarray, n: int, keys: list[int]) -> np.ndarray:
    """One pass: the halves change places, and widths, after each round."""
    left, right = widths(n)
    a, b = x >> np.uint64(right), x & np.uint64((1 << right) - 1)
    for key in keys:
        a, b = b, a ^ _mixed(b, key, left)
        left, right = right, left
    return a << np.uint64(right) | b


def _network_back(x: np.ndarray, n: int, keys: list[int]) -> np.ndarray:
    left, right = widths(n)  # an even number of rounds restores the widths
    a, b = x >> np.uint64(right), x & np.uint64((1 << right) - 1)
    for key in reversed(keys):
        left, right = right, left
        a, b = b ^ _mixed(a, key, left), a
    return a << np.uint64(right) | b


def _walked(network, numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    keys = round_keys(seed)
    out = network(np.asarray(numbers).astype(np.uint64), n, keys)
    while len(beyond := np.flatnonzero(out >= n)):
        out[beyond] = network(out[beyond], n, keys)
    return out.astype(np.int64)


def permute(numbers: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The places of row numbers, each in 0..n-1."""
    return _walked(_network, numbers, n, seed)


def unpermute(places: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The row numbers at places."""
    return _walked(_network_back, places, n, seed)


def sizes(text: Column) -> tuple[Column, Column]:
    """UTF-8 bytes plus 1, and the unsigned CRC-32 of the bytes."""
    data = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    return (F.octet_length(data) + 1).cast("long"), F.crc32(data)


def assign(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, carry: list[str] | None = None
) -> DataFrame:
    """row (the carried columns), size, text_crc32, number, shard, slot for every row."""
    carry = docs.columns if carry is None else carry
    size, crc = sizes(F.col("text"))
    plain = [f.name for f in docs.select(*[f"`{c}`" for c in carry]).schema if "map<" not in f.dataType.simpleString()]
    keyed = stage(docs.select(
        packed(carry).alias("row"), F.col("doc_id"), size.alias("size"), crc.alias("text_crc32"),
        F.xxhash64("text", *[f"`{c}`" for c in plain]).alias("all"),
    ), "rows").withColumn("position", F.monotonically_increasing_id())
    n = keyed.count()
    order = [F.col("doc_id").asc_nulls_last(), "size", "text_crc32", "all", "position"]

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, seed))

    placed = numbered(keyed, order).withColumn("place", place("number"))
    return placed.select(
        "row", "size", "text_crc32", "number",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {int(shards)}").alias("slot"),
    )


def write(assigned: DataFrame, folder: str) -> None:
    """One folder of Parquet files per shard, rows in the order of their slots.

    A shard is cut into ranges of slots, so its files are written by as many tasks as its size asks.
    """
    (
        assigned.select("row", "slot", "shard")
        .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(folder)
    )

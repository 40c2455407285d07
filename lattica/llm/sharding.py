"""Sharding: a Feistel permutation with cycle walking over global row numbers.

The rows are numbered by a total order without a task that sees them all, the numbers are permuted by a keyed Feistel
network, and the permuted number p gives ``shard = p mod shards`` and ``slot = p div shards``. The place of a row is thus
computable from its number, and ``permute(..., back=True)`` gives the row number of any (shard, slot).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.operators.numbering import unused, with_row_number

#: A prime below 2**31, so that squares of remainders stay below 2**62.
PRIME = 2147483629
ROUNDS = 6


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Multiplier and addend of each round, from the seed alone."""
    state, keys = seed % PRIME, []
    for _ in range(2 * rounds):
        state = (state * 48271 + 11) % PRIME
        keys.append(state or 1)
    return list(zip(keys[::2], keys[1::2], strict=True))


def half_bits(n: int) -> int:
    """Bits of each half: the network works on 2 * half_bits bits, the least even number of bits that holds n - 1."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _mixed(r: np.ndarray, a: int, c: int, mask: int) -> np.ndarray:
    x = (r * a + c) % PRIME
    return ((x * x + a) % PRIME) & mask


def _network(x: np.ndarray, bits: int, keys: list[tuple[int, int]], back: bool) -> np.ndarray:
    mask = (1 << bits) - 1
    left, right = x >> bits, x & mask
    for a, c in keys[::-1] if back else keys:
        if back:
            left, right = right ^ _mixed(left, a, c, mask), left
        else:
            left, right = right, left ^ _mixed(right, a, c, mask)
    return (left << bits) | right


def permute(numbers: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """The permuted numbers of 0..n-1. Walks the cycle until a number below n comes: each walk returns, as the
    network is a bijection and the start itself lies below n. Halves stay below 2**31, so n may be up to 2**62."""
    bits, keys = half_bits(n), round_keys(seed)
    x = _network(np.asarray(numbers, dtype=np.int64), bits, keys, back)
    while (out := x >= n).any():
        x[out] = _network(x[out], bits, keys, back)
    return x


def sharded(rows: DataFrame, order: list[str], shards: int, seed: int = 17) -> DataFrame:
    """Adds ``row_number``, ``shard`` and ``slot``. Counts of shards differ by one at most and slots have no gaps.
    Defined results: an empty table stays empty; null keys come first in the order; equal rows are interchangeable;
    texts of any length are carried whole; columns of the input called as one of these three are replaced, all others stay."""
    rows = rows.drop("row_number", "shard", "slot")
    at, n = with_row_number(rows, *order)

    @F.pandas_udf("long")
    def placed(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    p = unused(at, "_p")
    return at.withColumn(p, placed("row_number")).withColumns(
        {"shard": (F.col(p) % shards).cast("int"), "slot": F.expr(f"{p} div {shards}")}
    ).drop(p)


def shard_plan(documents: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """Places all documents by the law ``rows``: doc_id, size (UTF-8 bytes of the text and 16 more), text_crc32, law,
    shard, slot, grown_shard (null, as the law is not ``key``), row_number. A null text has no bytes and crc32 0."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select("doc_id", (F.length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    return sharded(rows, ["doc_id", "text_crc32", "size"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )

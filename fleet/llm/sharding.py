"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered in key order, the permutation of 0..n-1 shuffles the numbers, and the permuted number gives shard and
slot by division. Shard sizes differ by one at most. Anyone who knows the seed and n can compute where a row number
lies and, by the inverse permutation, which row number lies in a slot; no shuffle table is stored.

Null keys come first, repeated rows get numbers of their own, an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from fleet.operators.scans import global_ordinal

ROUNDS = 8


class Permutation:
    """A seeded bijection of 0..n-1, evaluated on numpy arrays in either direction."""

    def __init__(self, n: int, seed: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = np.random.default_rng(seed).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)

    def _round(self, right: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (right + key) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(32)) & self.mask

    def _once(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if inverse else self.keys:
            if inverse:
                left, right = right ^ self._round(left, key), left
            else:
                left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def __call__(self, numbers: np.ndarray, inverse: bool = False) -> np.ndarray:
        """Images of row numbers; values that leave 0..n-1 walk on along their cycle until they are back."""
        x = self._once(np.asarray(numbers, np.uint64), inverse)
        while (out := np.flatnonzero(x >= np.uint64(self.n))).size:
            x[out] = self._once(x[out], inverse)
        return x.astype(np.int64)


def assign_shards(df: DataFrame, shards: int, seed: int, order: list[str], rows: int | None = None) -> DataFrame:
    """Add ``row_number``, ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard) to every row.

    ``order`` should tell the rows apart, so that reruns number them alike. Give thin rows: they are range-partitioned
    and stored once. Columns of those three names are replaced.
    """
    n = df.count() if rows is None else rows
    permute = F.pandas_udf(lambda number: pd.Series(Permutation(n, seed)(number.to_numpy())), "long")
    numbered = global_ordinal(df.drop("row_number", "shard", "slot"), order, "row_number")
    placed = numbered.withColumn("_place", permute("row_number"))
    return placed.withColumns({
        "shard": (F.col("_place") % shards).cast("int"), "slot": F.floor(F.col("_place") / F.lit(shards)).cast("long"),
    }).drop("_place")


def row_number_at(shard: int, slot: int, shards: int, rows: int, seed: int) -> int:
    """The row number that lies in a slot."""
    return int(Permutation(rows, seed)(np.array([slot * shards + shard]), inverse=True)[0])

"""Train / validation splits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleet.functions.draws import drawn_below, uniform
from fleet.operators.scans import global_ordinal


def split_ordered(df: DataFrame, order: list[str | Column], test_size: float, out: str = "part") -> DataFrame:
    """Mark the tail of the order as ``val`` and the rest as ``train``."""
    placed = global_ordinal(df, order, "_ordinal")
    rows = df.count()
    cut = int(rows * (1.0 - test_size))
    return placed.withColumn(out, F.when(F.col("_ordinal") < cut, "train").otherwise("val")).drop("_ordinal")


def split_hashed(
    df: DataFrame, keys: list[str], test_size: float, seed: int = 42, out: str = "part"
) -> DataFrame:
    """Split by a hash of key columns: no shuffle, and the same rows whatever the partitioning.

    Put the group columns among the keys for a separate split of every group.
    """
    return df.withColumn(out, F.when(drawn_below(test_size, seed, *keys), "val").otherwise("train"))


def sample_rows(
    df: DataFrame, keys: list[str], fraction: float, limit: int | None = None, seed: int = 42
) -> DataFrame:
    """Random sample without replacement, at most ``limit`` rows, reproducible by key."""
    drawn = df.where(drawn_below(fraction, seed, *keys))
    if limit is not None:
        drawn = drawn.orderBy(uniform(seed, *keys), *keys).limit(limit)
    return drawn

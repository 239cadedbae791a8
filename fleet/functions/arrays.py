"""Arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def scaled(values: Column, divisor: float) -> Column:
    return F.transform(values, lambda x: x.cast("double") / F.lit(float(divisor)))


def squared_l2(a: Column, b: Column) -> Column:
    """Sum of squared differences of two arrays of one length."""
    terms = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
    return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)


def array_means(df: DataFrame, values: str, by: list[str] | None = None, out: str = "mean") -> DataFrame:
    """Mean of every array position over all rows, one row per group and position.

    The partial sums are made before the shuffle, so it carries one row per task,
    group and position however large a group is.
    """
    keys = list(by or [])
    cells = df.select(*keys, F.posexplode(values).alias("pos", "_value"))
    return cells.groupBy(*keys, F.col("pos").cast("long").alias("pos")).agg(
        F.avg(F.col("_value").cast("double")).alias(out)
    )


def mean_vectors(df: DataFrame, values: str, by: list[str], out: str = "mean") -> DataFrame:
    """The element-wise mean array of every group."""
    cells = array_means(df, values, by, "_mean")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "_mean")))
    return cells.groupBy(*by).agg(F.transform(ordered, lambda c: c["_mean"]).alias(out))

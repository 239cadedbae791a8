"""Rows by position and slices of nested arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleet.operators.scans import exact_percentiles, global_ordinal


def positional_join(
    left: DataFrame, right: DataFrame, left_order: list[str | Column], right_order: list[str | Column]
) -> DataFrame:
    """Row i of one table with row i of the other, each in its own order; adds ``ordinal``.

    Where one table is longer, its last rows have nulls for the other.
    """
    a = global_ordinal(left, left_order, "ordinal")
    b = global_ordinal(right, right_order, "ordinal")
    return a.join(b, "ordinal", "full")


def tensor_slices(
    trials: DataFrame,
    betas: str,
    trial_order: list[str | Column],
    behaviour: DataFrame,
    behaviour_order: list[str | Column],
    scale: float = 300.0,
) -> DataFrame:
    """One row per trial and slice: the behaviour columns, ``IMAGE_SLICE`` and ``IMAGE``.

    Trial i meets behaviour row i; filter the behaviour to its session before. Where one
    side is longer, the other's columns are null.
    """
    numbered = global_ordinal(trials.select(betas, *_names(trial_order, trials)), trial_order, "_trial").select("_trial", betas)
    facts = global_ordinal(behaviour, behaviour_order, "_trial")
    joined = facts.join(numbered, "_trial", "full")
    slices = joined.select(*behaviour.columns, F.posexplode_outer(betas).alias("IMAGE_SLICE", "_image"))
    image = F.transform("_image", lambda line: F.transform(line, lambda x: (x / F.lit(scale)).cast("float")))
    return slices.select(*behaviour.columns, "IMAGE_SLICE", image.alias("IMAGE"))


def slice_summary(df: DataFrame, image: str, low: float = 0.01, high: float = 0.99) -> tuple[DataFrame, DataFrame]:
    """The mean image over all rows, as (y, x, mean), and the two percentiles of its values."""
    lines = df.select(F.posexplode(image).alias("y", "_line"))
    cells = lines.select("y", F.posexplode("_line").alias("x", "_v"))
    mean = cells.groupBy("y", "x").agg(F.avg(F.col("_v").cast("double")).alias("mean"))
    return mean, exact_percentiles(mean, "mean", [low, high])


def _names(order: list[str | Column], df: DataFrame) -> list[str]:
    return [o for o in order if isinstance(o, str) and o in df.columns]

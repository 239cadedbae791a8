"""Synthetic series and feature tables, made on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleet.functions.draws import label_below, normal, uniform, uniform_between, uniform_pair
from fleet.functions.names import numbered_name
from fleet.operators.groups import expand_rows

# The start of synthetic series and the range of their coefficients.
SERIES_START = "2000-01-01"
COEFFICIENT_RANGE = (0.0, 100.0)


def with_series_target(df: DataFrame, group: str, keys: list[str], features: int = 2, seed: int = 0) -> DataFrame:
    """Add ``features_i`` (standard normal) and ``y``, their linear form with coefficients of the group, cut to int."""
    exact = [normal(*uniform_pair(seed, *keys, F.lit(f"x{i}"))) for i in range(features)]
    weights = [uniform_between(*COEFFICIENT_RANGE, uniform(seed, group, F.lit(f"c{i}"))) for i in range(features)]
    target = sum((w * x for w, x in zip(weights, exact)), F.lit(0.0))
    columns = [x.cast("float").alias(f"features_{i}") for i, x in enumerate(exact)]
    return df.select("*", *columns, target.cast("int").alias("y"))


def synth_series(spark: SparkSession, groups: int = 1000, points: int = 50_000, features: int = 2, seed: int = 0) -> DataFrame:
    """``groups`` hourly series of ``points`` rows: ds, group_name, features, y and a unique id."""
    rows = spark.range(groups * points)
    number = F.floor(F.col("id") / points)
    hour = F.pmod(F.col("id"), F.lit(points))
    start = F.unix_timestamp(F.lit(SERIES_START).cast("timestamp"))
    named = rows.select(
        F.timestamp_seconds(start + hour * 3600).alias("ds"),
        numbered_name("group_", (number + 1).cast("long")).alias("group_name"),
        F.col("id").alias("_key"),
    )
    made = with_series_target(named, "group_name", ["_key"], features, seed).drop("_key")
    order = ["ds", "group_name", *[f"features_{i}" for i in range(features)], "y"]
    return made.select(*order).withColumn("id", F.monotonically_increasing_id())


def table_name(rows: int, columns: int, labels: int, groups: int | None = None) -> str:
    """The name under which writer and reader find a wide table (a fixed format)."""
    name = f"synthetic_data_{rows}_rows_{columns}_columns_{labels}_labels"
    return name if groups is None else f"{name}_{groups}_groups"


def with_wide_features(
    df: DataFrame, key: str, columns: int, labels: int, groups: int | None = None, signal: float = 0.0, seed: int = 0
) -> DataFrame:
    """Features ``r_i`` uniform in [0, 1), a ``group_id`` in turn of the key, and a ``target`` in [0, labels).

    With ``signal`` above 0 that share of the rows takes its label from the first feature.
    """
    draws = [uniform(seed, key, F.lit(i)) for i in range(columns)]
    noise = uniform(seed, key, F.lit("label"))
    target: Column = label_below(labels, noise)
    if signal > 0:
        told = uniform(seed, key, F.lit("signal")) < signal
        target = F.when(told, label_below(labels, draws[0])).otherwise(target)
    made = [df[key].alias("id")]
    if groups is not None:
        made.append(F.concat(F.lit("group_"), F.pmod(df[key], F.lit(groups)).cast("string")).alias("group_id"))
    made += [u.cast("float").alias(f"r_{i}") for i, u in enumerate(draws)]
    return df.select(*made, target.alias("target"))


def synth_table(
    spark: SparkSession, rows: int, columns: int, labels: int, groups: int | None = None, signal: float = 0.0, seed: int = 0
) -> DataFrame:
    return with_wide_features(spark.range(rows), "id", columns, labels, groups, signal, seed)

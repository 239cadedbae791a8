"""Calendars and resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleet.operators.keys import join_on


def week_end(day: Column) -> Column:
    """The Sunday that ends the week of ``day``."""
    return F.next_day(F.date_sub(day, 1), "Sun")


def weekly_sums(df: DataFrame, by: list[str], ds: str, y: str) -> DataFrame:
    """Sum of ``y`` per week (weeks end on Sunday) from the first to the last week of each group.

    Weeks without rows give 0. The calendar is made from two dates per group, after
    the sums have reduced the rows.
    """
    weeks = df.groupBy(*by, week_end(F.col(ds).cast("date")).alias("week")).agg(F.sum(y).alias("_sum"))
    spans = weeks.groupBy(*by).agg(F.min("week").alias("_a"), F.max("week").alias("_b"))
    step = F.expr("INTERVAL 7 DAYS")
    calendar = spans.select(*by, F.explode(F.sequence("_a", "_b", step)).alias("week"))
    filled = join_on(calendar, weeks, [*by, "week"], "left")
    return filled.select(*by, "week", F.coalesce("_sum", F.lit(0.0)).alias("total"))


def future_frame(df: DataFrame, by: list[str], ds: str, periods: int, step: str = "1 DAY") -> DataFrame:
    """The ``periods`` steps after the last time of every group. The step is explicit: hourly
    histories are continued day by day unless told otherwise."""
    kind = df.schema[ds].dataType
    last = df.groupBy(*by).agg(F.max(ds).cast("timestamp_ntz").alias("_last"))
    steps = F.expr(f"sequence(_last + INTERVAL {step}, _last + {int(periods)} * INTERVAL {step}, INTERVAL {step})")
    return last.select(*by, F.explode(steps).alias(ds)).withColumn(ds, F.col(ds).cast(kind))

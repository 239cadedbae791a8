"""Last rows, latest records, metric histories and best trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleet.operators.keys import join_on
from fleet.operators.scans import running


def last_rows(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group in ``order`` (pass descending columns for the last ones).

    Spark applies the limit on both sides of the shuffle, so a large group sends
    at most ``n`` rows from each task.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest_per_name(df: DataFrame, name: str, time: str, tie: str) -> DataFrame:
    """The latest row of every name, by aggregation: only one row per task and name is shuffled."""
    row = F.max_by(F.struct(*df.columns), F.struct(time, tie))
    return df.groupBy(name).agg(row.alias("_row")).select("_row.*")


def best_trial(df: DataFrame, by: list[str], metric: str, mode: str, tie: str = "trial_id") -> DataFrame:
    """The row with the best metric in every group; ties go to the lowest trial id, a missing metric comes last."""
    if mode not in ("min", "max"):
        raise ValueError("mode is 'min' or 'max'")
    signed = F.col(metric) if mode == "min" else -F.col(metric)
    row = F.min_by(F.struct(*df.columns), F.struct(F.col(metric).isNull(), signed, F.col(tie)))
    return df.groupBy(*by).agg(row.alias("_row")).select("_row.*")


def early_stop(df: DataFrame, by: list[str], round_col: str, metric: str, patience: int) -> DataFrame:
    """Where every history would stop: ``best_round``, ``best``, ``stop_round``, ``last``.

    Training stops at the first round that is ``patience`` rounds past the best one
    so far, or at the last round. Rounds of one history are distinct. The running
    best is a distributed scan, so one long history is not one task.
    """
    order = F.struct(F.col(metric), F.col(round_col))
    scan = running(df.withColumn("_mark", order), by, [round_col], {"_best": ("min", "_mark")})
    overdue = F.col(round_col) - F.col(f"_best.{round_col}") >= patience
    ends = scan.groupBy(*by).agg(
        F.min(F.when(overdue, F.col(round_col))).alias("_stop"), F.max(round_col).alias("_end")
    )
    ends = ends.select(*by, F.coalesce("_stop", "_end").alias("stop_round"))
    at = F.max(F.when(F.col(round_col) == F.col("stop_round"), F.struct("_best", F.col(metric).alias("_last"))))
    found = join_on(scan, ends, by).groupBy(*by, "stop_round").agg(at.alias("_at"))
    return found.select(
        *by,
        F.col(f"_at._best.{round_col}").alias("best_round"),
        F.col(f"_at._best.{metric}").alias("best"),
        "stop_round",
        F.col("_at._last").alias("last"),
    )

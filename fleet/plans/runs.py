"""Run log with parents, artifact maps and model tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fleet.functions.names import composite_key, run_date
from fleet.operators.groups import route_predict

MODEL_BUCKETS = 32

RUN_SCHEMA = (
    "run_id string, parent_run_id string, run_name string, start_time timestamp, "
    "params map<string,string>, metrics map<string,double>, tags map<string,string>"
)
# Fixed value: the tag that links a child run to its parent.
PARENT_TAG = "parentRunId"


def group_run_name(group_columns: list[str], time: Column, best: bool = False) -> Column:
    """``group_<key>_<date>``, with ``BEST_`` before it for the refitted model."""
    head = "BEST_group" if best else "group"
    return F.concat_ws("_", F.lit(head), composite_key(*group_columns), run_date(time))


def child_runs(
    results: DataFrame, parent_run_id: str, run_name: Column, params: str, metric: str, run_id: Column | None = None
) -> DataFrame:
    """One run per trial result under a parent run. The run id is made from the trial, so that a
    repeated job writes the same ids."""
    own = F.sha1(F.concat_ws("|", F.lit(parent_run_id), run_name, F.col("trial_id").cast("string")))
    return results.select(
        (own if run_id is None else run_id).alias("run_id"),
        F.lit(parent_run_id).alias("parent_run_id"),
        run_name.alias("run_name"),
        F.current_timestamp().alias("start_time"),
        F.transform_values(params, lambda _, v: v.cast("string")).alias("params"),
        F.create_map(F.lit(metric), F.col("value").cast("double")).alias("metrics"),
        F.create_map(F.lit(PARENT_TAG), F.lit(parent_run_id)).alias("tags"),
    )


def log_runs(runs: DataFrame, table: str) -> None:
    """Append runs to the run log, creating it on first use."""
    spark = runs.sparkSession
    columns = spark.createDataFrame([], RUN_SCHEMA).columns
    runs.select(*columns).write.mode("append").saveAsTable(table)


def search_runs(
    runs: DataFrame, name_prefix: str | None = None, tags: dict[str, str] | None = None, latest: bool = False
) -> DataFrame:
    """Runs by name prefix and tag values; ``latest`` keeps the one with the latest start."""
    if name_prefix is not None:
        runs = runs.where(F.col("run_name").startswith(name_prefix))
    for key, value in (tags or {}).items():
        runs = runs.where(F.col("tags")[key] == F.lit(value))
    if latest:
        runs = runs.orderBy(F.col("start_time").desc(), "run_id").limit(1)
    return runs


def artifact_map(models: DataFrame, group_columns: list[str], experiment_id: str, run_id: str = "run_id") -> DataFrame:
    """Where the best model of each group is found."""
    return models.select(
        composite_key(*group_columns).alias("group_id"),
        F.lit(experiment_id).alias("experiment_id"),
        model_path(run_id).alias("local_run_model_path"),
    )


def model_path(run_id: str) -> Column:
    """Where the best model of a run is found."""
    return F.concat_ws("/", F.col(run_id), F.lit("best_model"), F.lit("model"))


def log_search(
    trials: DataFrame, best: DataFrame, group_columns: list[str], experiment_id: str, parent_run_id: str,
    runs_table: str, models_table: str, metric: str = "value",
) -> DataFrame:
    """Write a grouped search to the run log and the model store; returns the artifact map of its best models.

    The log gets the parent run, a child run for every trial and a ``BEST_`` run for every group. The store gets the model
    of each best run under the path that the map names. ``trials`` and ``best`` have the group columns, ``trial_id``,
    ``params`` and ``value``; ``best`` has ``model``. Run ids follow from the search and the trial, so a job that is
    repeated names the same runs.
    """
    spark, now = trials.sparkSession, F.current_timestamp()
    named = trials.select(*group_columns, "trial_id", "params", "value")
    children = child_runs(named, parent_run_id, group_run_name(group_columns, now), "params", metric)
    winners = best.where("model IS NOT NULL").withColumn("run_id", _best_run_id(parent_run_id, group_columns))
    tops = child_runs(winners, parent_run_id, group_run_name(group_columns, now, best=True), "params", metric, F.col("run_id"))
    parent = spark.range(1).select(
        F.lit(parent_run_id).alias("run_id"), F.lit(None).cast("string").alias("parent_run_id"), F.lit(f"search_{parent_run_id}").alias("run_name"),
        now.alias("start_time"), F.create_map().cast("map<string,string>").alias("params"), F.create_map().cast("map<string,double>").alias("metrics"),
        F.create_map(F.lit("experiment"), F.lit(experiment_id)).alias("tags"),
    )
    log_runs(parent.unionByName(children).unionByName(tops), runs_table)
    save_models(winners, group_columns, models_table)
    return artifact_map(winners, group_columns, experiment_id)


def _best_run_id(parent_run_id: str, group_columns: list[str]) -> Column:
    return F.sha1(F.concat_ws("|", F.lit(parent_run_id), F.lit("BEST"), composite_key(*group_columns)))


def save_models(models: DataFrame, group_columns: list[str], table: str) -> None:
    """Append models to the store: a table bucketed by the path that ``artifact_map`` gives them."""
    rows = models.select(model_path("run_id").alias("path"), composite_key(*group_columns).alias("group_id"), "model")
    rows.write.mode("append").bucketBy(MODEL_BUCKETS, "path").saveAsTable(table)


def load_models(artifacts: DataFrame, table: str) -> DataFrame:
    """``group_id`` and ``model`` of the models that an artifact map names, for a router by ``group_id``."""
    stored = artifacts.sparkSession.table(table).select("path", "model").dropDuplicates(["path"])
    return artifacts.join(stored, F.col("local_run_model_path") == F.col("path")).select("group_id", "model")


def route_by_artifacts(
    rows: DataFrame, artifacts: DataFrame, table: str, group_columns: list[str], row_key: str,
    predict: Callable[[str, pd.DataFrame], pd.Series], features: list[str],
) -> DataFrame:
    """Predictions of all rows, each by the stored model that the artifact map names for its group."""
    named = rows.withColumn("group_id", composite_key(*group_columns))
    return route_predict(named, load_models(artifacts, table), ["group_id"], row_key, predict, features)

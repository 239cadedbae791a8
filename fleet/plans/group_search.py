"""Trials of small groups, trained whole inside tasks on a grid of groups and chunks of trials."""

from __future__ import annotations

import json
import traceback
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fleet.operators.keys import join_on

#: Rows up to which a group is trained whole in a task; larger ones take the level jobs.
SMALL_ROWS = 50_000
FOUND = (
    "trial_id int, best_round int, value double, model string, error string, "
    "history array<struct<round: int, metric: string, value: double>>"
)


def split_by_size(df: DataFrame, keys: list[str], rows: int) -> tuple[DataFrame, DataFrame]:
    """The keys of groups of up to ``rows`` rows, and those of larger ones."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.where(F.col("_rows") <= rows).drop("_rows"), sizes.where(F.col("_rows") > rows).drop("_rows")


def fit_grid(
    rows: DataFrame, trials: DataFrame, keys: list[str], fit: Callable | object, trials_per_task: int | None = None
) -> DataFrame:
    """Fit every trial of every group: the keys, then ``FOUND``.

    ``fit(pdf, params)`` gets all rows of a group and the settings of one trial, and returns a value or a dict with
    ``value`` and, if it likes, ``model``, ``best_round`` and ``history``. An object with ``fit_all(pdf, {trial: params})``
    gets all trials of a chunk at once. Only a group's rows are repeated, once per chunk of ``trials_per_task`` trials; all
    groups run in one job. A failing trial is a row with its ``error``, as is a trial whose group has no rows.
    """
    asked = trials.select(*keys, "trial_id", F.to_json("params").alias("_p"), (F.to_json("settings") if "settings" in trials.columns else F.lit("{}")).alias("_s"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("trial_id")) - 1
    asked = asked.withColumn("_chunk", F.lit(0) if trials_per_task is None else F.floor(place / F.lit(trials_per_task)).cast("int"))
    spread = rows.withColumn("_chunk", F.lit(0))
    if trials_per_task is not None:
        chunks = asked.groupBy(*keys).agg(F.max("_chunk").alias("_last"))
        spread = join_on(rows, chunks, keys).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_last")))).drop("_last")
    schema = T.StructType([rows.schema[k] for k in keys] + T.StructType.fromDDL(FOUND).fields)
    names = schema.names[len(keys) :]

    def run(key: tuple, pdf: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        pdf, wanted = pdf.drop(columns="_chunk"), wanted.sort_values("trial_id")
        settings = {int(t): {**json.loads(p or "{}"), **json.loads(s or "{}")} for t, p, s in zip(wanted["trial_id"], wanted["_p"], wanted["_s"])}
        found: dict[int, dict] = {}
        try:
            if len(pdf) and hasattr(fit, "fit_all"):
                found = fit.fit_all(pdf, settings)
        except Exception:
            found = {t: {"error": _message()} for t in settings}
        if len(pdf) and not hasattr(fit, "fit_all"):
            for t, params in settings.items():
                try:
                    out = fit(pdf, params)
                    found[t] = out if isinstance(out, dict) else {"value": float(out)}
                except Exception:
                    found[t] = {"error": _message()}
        rows_ = [dict(zip(keys, key[: len(keys)])) | {"trial_id": t} | {n: found.get(t, {}).get(n) for n in names[1:]} for t in settings]
        out = pd.DataFrame(rows_, columns=schema.names)
        for n in ("trial_id", "best_round"):
            out[n] = out[n].astype("Int32")
        return out.astype({"value": "float64"})

    at = [*keys, "_chunk"]
    return spread.groupBy(*at).cogroup(asked.groupBy(*at)).applyInPandas(run, schema)


def _message() -> str:
    return traceback.format_exc(limit=1).strip().splitlines()[-1]


def with_failures(found: DataFrame) -> DataFrame:
    """``error`` of trials that did not fail themselves: no model, or no value to compare them by."""
    return found.withColumn("error", F.coalesce(F.col("error"), failure()))


def failure() -> Column:
    nothing = F.when(F.col("model").isNull() & F.col("value").isNull(), F.lit("no training rows"))
    return nothing.when(F.col("value").isNull() | F.isnan("value"), F.lit("no held-out rows"))

"""Trained tree models as text, and prediction with them."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def model_text(objective: str, outputs: int, base: float, features: list[str] | str, rounds: list[list[dict]], edges: list[np.ndarray]) -> str:
    """A model as JSON, with thresholds in place of bins: a row goes left below the threshold."""
    kept = []
    for trees in rounds:
        kept.append([])
        for tree in trees:
            inner = tree["feature"] >= 0
            thresholds = [float(edges[f][b]) if i else 0.0 for i, f, b in zip(inner, tree["feature"], tree["bin"])]
            kept[-1].append({
                "feature": tree["feature"].tolist(), "threshold": thresholds, "left": tree["left"].tolist(),
                "right": tree["right"].tolist(), "value": tree["value"].tolist(),
            })
    return json.dumps({"objective": objective, "outputs": outputs, "base": base, "features": features, "rounds": kept})


@lru_cache(maxsize=64)
def _parsed(text: str) -> dict:
    model = json.loads(text)
    for trees in model["rounds"]:
        for tree in trees:
            for name in tree:
                tree[name] = np.asarray(tree[name])
    return model


def model_margin(text: str, pdf: pd.DataFrame) -> np.ndarray:
    """Summed leaf values of every row and output."""
    model = _parsed(text)
    names = model["features"]
    x = np.array(pdf[names].tolist(), float) if isinstance(names, str) else pdf[names].to_numpy(float)
    rows = np.arange(len(x))
    margin = np.full((len(x), model["outputs"]), float(model["base"]))
    for trees in model["rounds"]:
        for k, tree in enumerate(trees):
            node = np.zeros(len(x), np.int64)
            while True:
                feature = tree["feature"][node]
                inner = feature >= 0
                if not inner.any():
                    break
                left = x[rows, np.maximum(feature, 0)] < tree["threshold"][node]
                node = np.where(inner, np.where(left, tree["left"][node], tree["right"][node]), node)
            margin[:, k] += tree["value"][node]
    return margin


def model_predict(text: str, pdf: pd.DataFrame) -> pd.Series:
    """The class with the highest margin, or the value."""
    margin = model_margin(text, pdf)
    out = margin.argmax(1).astype(float) if _parsed(text)["objective"] == "multi:softmax" else margin[:, 0]
    return pd.Series(out, index=pdf.index)


def predict(df: DataFrame, model: str, keep: list[str], out: str = "prediction") -> DataFrame:
    """Predict a whole table with one model; ``keep`` columns are carried along, nothing is shuffled."""
    named = json.loads(model)["features"]
    features = [named] if isinstance(named, str) else named
    shared = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(*dict.fromkeys([*keep, *features]))
    schema = df.select(*keep).withColumn(out, F.lit(0.0)).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = pdf[keep].copy()
            found[out] = model_predict(shared.value, pdf) if len(pdf) else 0.0
            yield found

    return source.mapInPandas(run, schema)

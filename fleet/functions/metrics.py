"""Evaluation metrics as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def log_loss(probability_of_label: Column, eps: float = 1e-15) -> Column:
    """Mean negative log of the probability given to the true class."""
    return F.avg(-F.log(F.greatest(probability_of_label, F.lit(eps))))


def accuracy(prediction: Column, label: Column) -> Column:
    return F.avg((prediction == label).cast("double"))


def error_rate(prediction: Column, label: Column) -> Column:
    return F.avg((prediction != label).cast("double"))


def rmse(prediction: Column, label: Column) -> Column:
    return F.sqrt(F.avg(F.pow(label - prediction, F.lit(2.0))))


def mae(prediction: Column, label: Column) -> Column:
    return F.avg(F.abs(label - prediction))


def rmsle(prediction: Column, label: Column) -> Column:
    return F.sqrt(F.avg(F.pow(F.log1p(label) - F.log1p(prediction), F.lit(2.0))))

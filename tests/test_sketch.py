"""Quantile sketches against exact ranks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import fleet.plans.sketch as sketch
from fleet.plans.bins import quantile_bins
from fleet.plans.sketch import column_quantiles

PROBS = [i / 256 for i in range(1, 256)]


def rank_error(values, found, probs):
    values = np.sort(values)
    below, upto = np.searchsorted(values, found, "left") / len(values), np.searchsorted(values, found, "right") / len(values)
    return np.maximum(np.maximum(below - probs, probs - upto), 0).max()


@pytest.mark.parametrize("parts, fan_in", [(3, 32), (40, 4)])
def test_hundred_features_stay_within_a_quarter_of_a_bin(spark, monkeypatch, parts, fan_in):
    monkeypatch.setattr(sketch, "FAN_IN", fan_in)
    rows, width = 150_000, 100
    draw = F.transform(F.sequence(F.lit(1), F.lit(width)), lambda j: F.pow((F.xxhash64(F.col("id"), j) % 100_003) / 100_003.0, (j % 5 + 1)))
    df = spark.range(rows, numPartitions=parts).select(draw.alias("x")).persist()
    matrix = np.array(df.toPandas().x.tolist())
    found = {r["feature"]: np.array(r["quantiles"]) for r in column_quantiles(df, "x", PROBS).collect()}
    assert len(found) == width
    assert max(rank_error(matrix[:, f], q, np.array(PROBS)) for f, q in found.items()) < 1 / (4 * 256)
    df.unpersist()


def test_sorted_and_repeated_values(spark):
    df = spark.range(400_000, numPartitions=5).select(F.array(F.col("id").cast("double"), (F.col("id") % 3).cast("double"), F.lit(7.0)).alias("x"))
    found = {r["feature"]: np.array(r["quantiles"]) for r in column_quantiles(df, "x", PROBS).collect()}
    ids = np.arange(400_000.0)
    for f, values in enumerate((ids, ids % 3, np.full(1000, 7.0))):
        assert rank_error(values, found[f], np.array(PROBS)) < 1 / (4 * 256)


def test_few_rows_are_exact_in_groups_of_any_key(spark):
    rows = [(g, float(i * i % 97), None if i % 4 == 0 else float(i), float("nan") if i % 3 else 1.0, None) for g in ("a", "b", None) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, d double").repartition(4)
    got = {(r["g"], r["feature"]): r["edges"] for r in quantile_bins(df, ["a", "b", "c", "d"], 16, ["g"]).collect()}
    assert len(got) == 12
    for (g, f), edges in got.items():
        values = np.array([r[f + 1] for r in rows if r[0] == g and r[f + 1] is not None and r[f + 1] == r[f + 1]])
        want = np.unique(np.quantile(values, np.arange(1, 16) / 16)) if len(values) else []
        assert np.allclose(edges, want)


def test_empty_table(spark):
    assert quantile_bins(spark.createDataFrame([], "a double, b double"), ["a", "b"], 16).collect() == []


def test_cuts_keep_the_weight():
    rng = np.random.default_rng(1)
    values = np.sort(rng.normal(size=5_000))
    found = sketch.cut(values, rng.integers(1, 9, 5_000).astype(float), 100)
    again = sketch.from_bytes(sketch.to_bytes(found))
    assert len(found[0]) <= 100 and all((a == b).all() for a, b in zip(found, again))
    joined = sketch.join([found, (values, np.ones(5_000))], 64)
    assert np.isclose(joined[1].sum(), found[1].sum() + 5_000) and (np.diff(joined[0]) >= 0).all()


def test_check_of_the_edges_moves_no_rows_and_skips_missing_values(spark, tmp_path):
    from fleet.queries.training import sketched_edges

    lines = spark.range(20_000).select(
        "id", F.lit(1).alias("l_linenumber"), F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.when(F.col("id") % 3 > 0, F.rand(1)).alias("l_quantity"), *[F.rand(i).alias(c) for i, c in enumerate(("l_extendedprice", "l_discount", "l_tax"))],
    ).withColumnRenamed("id", "l_orderkey")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = sketched_edges(spark, str(tmp_path))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == {(i, 255, True) for i in range(4)}

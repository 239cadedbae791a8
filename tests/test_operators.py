import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark import AccumulatorParam, TaskContext
from pyspark.sql import functions as F

from fleet.functions.draws import integer_between, loguniform_between, uniform
from fleet.operators import groups
from fleet.operators.groups import grouped_fold, grouped_map, grouped_stream, route_predict
from fleet.operators.history import best_trial, early_stop
from fleet.operators.keys import block_cogroup, group_key_check, join_on, key_product, with_blocks
from fleet.operators.scans import exact_percentiles, global_ordinal, rank_cut, running
from fleet.operators.series import future_frame, weekly_sums
from fleet.operators.splits import split_hashed, split_ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with two thirds of the rows, a null key, and copied rows."""
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"row": range(900), "x": rng.integers(0, 50, 900).astype(float)})
    pdf["k"] = np.where(pdf.row < 600, "hot", np.where(pdf.row < 800, "cold", None))
    return spark.createDataFrame(pdf).repartition(5).persist()


def test_ordinal_is_dense_with_ties_and_any_partitioning(spark, skewed):
    for n in (1, 7, 64):
        found = global_ordinal(skewed.repartition(n), ["x"]).toPandas().sort_values("ordinal")
        assert found.ordinal.tolist() == list(range(900))
        assert found.x.is_monotonic_increasing


def test_ordinal_within_groups(skewed):
    found = global_ordinal(skewed, ["x", "row"], by=["k"]).toPandas()
    for _, part in found.groupby("k", dropna=False):
        part = part.sort_values(["x", "row"])
        assert part.ordinal.tolist() == list(range(len(part)))


def test_running_matches_pandas(skewed):
    found = running(skewed, ["k"], ["row"], {"low": ("min", "x"), "total": ("sum", "x"), "top": ("max", "x")}).toPandas()
    found = found.sort_values("row")
    for _, part in found.groupby("k", dropna=False):
        assert np.allclose(part.low, part.x.cummin()) and np.allclose(part.total, part.x.cumsum())
        assert np.allclose(part.top, part.x.cummax())


def test_percentiles_match_numpy(skewed):
    found = {r["k"]: r["percentiles"] for r in exact_percentiles(skewed, "x", [0.0, 0.01, 0.5, 0.99, 1.0], ["k"]).collect()}
    for k, part in skewed.toPandas().groupby("k", dropna=False):
        assert np.allclose(found[k if isinstance(k, str) else None], np.percentile(part.x, [0, 1, 50, 99, 100]))


def test_rank_cut_both_directions(skewed):
    pdf = skewed.toPandas()
    for descending in (False, True):
        kept = {r["row"] for r in rank_cut(skewed, "x", 0.25, ["k"], descending).where("kept").collect()}
        sign = -1 if descending else 1
        want = set()
        for _, part in pdf.groupby("k", dropna=False):
            v = sign * part.x.to_numpy()
            rank = (v[None, :] < v[:, None]).sum(1) / (len(v) - 1)
            want |= set(part.row[rank < 0.25])
        assert kept == want


def test_join_matches_null_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("x", 3), (None, 4)], "k string, b int")
    assert {tuple(r) for r in join_on(a, b, ["k"]).select("a", "b").collect()} == {(1, 3), (2, 4)}


def test_blocks_split_the_large_group_only(skewed):
    found = with_blocks(skewed, ["k"], 250, ["row"]).groupBy("k").agg(F.count_distinct("_block").alias("n"), F.count("*").alias("rows"))
    assert {r["k"]: (r["n"], r["rows"]) for r in found.collect()} == {"hot": (3, 600), "cold": (1, 200), None: (1, 100)}


def test_block_cogroup_meets_every_pair_once(spark, skewed):
    right = spark.createDataFrame([("hot", i) for i in range(40)] + [("none", 99), (None, 7)], "k string, r int")

    def pairs(a, b):
        x, y = np.meshgrid(a["row"].to_numpy(), b["r"].to_numpy())
        return pa.table({"row": x.ravel(), "r": pa.array(y.ravel(), pa.int32())})

    found = block_cogroup(skewed, right, ["k"], pairs, "row long, r int", ["row"], ["r"], 100, 10).toPandas()
    assert len(found) == 600 * 40 + 100 and not found.duplicated().any()


def test_key_product(spark):
    a = spark.createDataFrame([(i % 5,) for i in range(20)], "a int")
    b = spark.createDataFrame([(i % 3,) for i in range(9)], "b int")
    rows = key_product(a, b).collect()
    assert len(rows) == len(set(rows)) == 15


def test_group_key_check_flags_null_only_columns(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 1, 5)], "g string, x int, y int")
    assert {tuple(r) for r in group_key_check(df, ["g"], ["x", "y"]).collect()} == {("a", "x,y")}


def test_splits_cover_and_do_not_move(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    first = {r["id"]: r["part"] for r in split_hashed(df, ["id"], 0.3).collect()}
    again = {r["id"]: r["part"] for r in split_hashed(df.repartition(7), ["id"], 0.3).collect()}
    assert first == again and len(first) == 1000
    assert 0.25 < sum(v == "val" for v in first.values()) / 1000 < 0.35
    ordered = split_ordered(df, ["id"], 0.25).where("part = 'val'").agg(F.min("id"), F.count("*")).first()
    assert tuple(ordered) == (750, 250)


def test_draws_stay_in_bounds(spark):
    df = spark.range(5000).select(
        uniform(1, "id").alias("u"), loguniform_between(1e-4, 1e-2, uniform(2, "id")).alias("l"),
        integer_between(3, 6, uniform(3, "id")).alias("i"),
    ).toPandas()
    assert 0 <= df.u.min() and df.u.max() < 1 and abs(df.u.mean() - 0.5) < 0.02
    assert df.l.between(1e-4, 1e-2).all() and set(df.i) == {3, 4, 5}


def _sums(pdf):
    if (pdf["x"] < 0).any():
        raise ValueError("negative")
    return pd.DataFrame({"k": [pdf["k"].iloc[0]], "n": [len(pdf)], "s": [pdf["x"].sum()]})


def test_fold_and_map_agree_and_isolate_failures(spark, skewed):
    bad = spark.createDataFrame([(5000, -1.0, "bad")], "row long, x double, k string")
    df = skewed.select("row", "x", "k").unionByName(bad)
    merge = [F.sum("n").alias("n"), F.sum("s").alias("s")]
    folded = {r["k"]: r for r in grouped_fold(df, ["k"], _sums, "k string, n long, s double", merge, ["row"], rows_per_block=50).collect()}
    mapped = {r["k"]: r for r in grouped_map(df, ["k"], _sums, "k string, n long, s double").collect()}
    assert "negative" in folded["bad"]["error"] and "negative" in mapped["bad"]["error"]
    for k in ("hot", "cold", None):
        assert folded[k]["n"] == mapped[k]["n"] and folded[k]["s"] == mapped[k]["s"] and folded[k]["error"] is None


def test_fold_deals_a_large_group_to_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(groups, "ROWS_PER_TASK", 1_000, raising=False)
    place = lambda pdf: pd.DataFrame({"k": ["big"], "n": [len(pdf)], "task": [TaskContext.get().partitionId()]})
    df = spark.range(20_000).select("id", F.lit("big").alias("k"))
    merge = [F.sum("n").alias("n"), F.collect_list(F.struct("task", "n")).alias("tasks")]
    found = grouped_fold(df, ["k"], place, "k string, n long, task int", merge, ["id"], rows_per_block=50)
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    row = found.first()
    assert row["n"] == 20_000 and len({t["task"] for t in row["tasks"]}) > 15


def test_map_takes_groups_of_any_size(spark):
    df = spark.range(100_001).select(F.when(F.col("id") < 100_000, "big").otherwise("one").alias("k"), F.col("id").cast("double").alias("x"))
    found = {r["k"]: r for r in grouped_map(df, ["k"], _sums, "k string, n long, s double").collect()}
    assert found["big"]["n"] == 100_000 and found["one"]["n"] == 1 and found["big"]["error"] is None


def _sums_of_many(pdf, made):
    made.add(1)
    if (pdf["x"] < 0).any():
        raise ValueError("negative")
    return pdf.groupby("k", as_index=False, dropna=False)["x"].agg(n="size", s="sum")


def test_map_takes_many_small_groups_in_a_call(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 10_000 > 0, F.col("id") % 10_000).alias("k"), F.lit(1.0).alias("x"))
    bad = spark.createDataFrame([(-5, -1.0)], "k long, x double")
    calls = spark.sparkContext.accumulator(0)
    found = grouped_map(df, ["k"], _sums_of_many, "k long, n long, s double", rows_per_call=1_000, made=calls).toPandas()
    assert calls.value <= 31 and len(found) == 10_000 and (found.n == 3).all() and (found.s == 3.0).all() and found.error.isna().all()
    found = grouped_map(df.unionByName(bad), ["k"], _sums_of_many, "k long, n long, s double", rows_per_call=1_000, made=calls).toPandas()
    assert len(found) == 10_001 and found.k.isna().sum() == 1 and (found.n[found.k != -5] == 3).all() and found.error.isna().sum() == 10_000
    assert found.error[found.k == -5].str.contains("negative").all()


def _running_sums(frames):
    total = 0.0
    for pdf in frames:
        if (pdf["k"] == "bad").any():
            raise ValueError("bad group")
        total += pdf["x"].sum()
    yield pd.DataFrame({"k": [pdf["k"].iloc[0]], "s": [total]})


def test_stream_holds_no_group(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "bad").otherwise("good").alias("k"), F.lit(1.0).alias("x"))
    found = {r["k"]: r for r in grouped_stream(df, ["k"], _running_sums, "k string, s double").collect()}
    assert found["good"]["s"] == 20_000 and found["good"]["error"] is None
    assert found["bad"]["s"] is None and "bad group" in found["bad"]["error"]


def _part_sums(frames, most):
    n, total, key = 0, 0.0, None
    for pdf in frames:
        if (pdf["x"] < 0).any():
            raise ValueError("negative")
        n, total, key = n + len(pdf), total + pdf["x"].sum(), pdf["k"].iloc[0]
    most.add(n)
    yield pd.DataFrame({"k": [key], "n": [n], "s": [total]})


def test_stream_in_parts_bounds_the_rows_of_a_sort(spark):
    class Most(AccumulatorParam):
        def zero(self, value):
            return 0

        def addInPlace(self, a, b):
            return max(a, b)

    most = spark.sparkContext.accumulator(0, Most())
    df = spark.range(40_000).select(F.when(F.col("id") % 40 == 0, None).otherwise("big").alias("k"), F.lit(1.0).alias("x"))
    bad = spark.createDataFrame([("bad", 1.0), ("bad", -1.0)], "k string, x double")
    merge = [F.sum("n").alias("n"), F.sum("s").alias("s")]
    found = grouped_stream(df.unionByName(bad), ["k"], _part_sums, "k string, n long, s double", merge=merge, rows_per_part=5_000, most=most)
    found = {r["k"]: r for r in found.collect()}
    assert found["big"]["n"] == found["big"]["s"] == 39_000 and found[None]["n"] == 1_000 and found["big"]["error"] is None
    assert 0 < most.value < 6_000 and "negative" in found["bad"]["error"]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_routing_keeps_all_rows(spark, skewed, limit):
    models = spark.createDataFrame([("hot", "2"), (None, "3")], "k string, model string")
    predict = lambda model, pdf: float(model) * pdf["x"]
    found = route_predict(skewed, models, ["k"], "row", predict, ["x"], rows_per_block=70, broadcast_bytes=limit).toPandas()
    want = skewed.toPandas().set_index("row")
    found = found.set_index("row").sort_index()
    assert len(found) == 900
    factor = want.sort_index().k.map({"hot": 2.0}).where(want.k.notna(), 3.0)
    assert np.allclose(found.prediction, factor.sort_index() * want.sort_index().x, equal_nan=True)


def test_early_stop_and_best_trial(spark):
    rows = [("a", i, v) for i, v in enumerate([5.0, 4.0, 4.5, 4.2, 4.1, 1.0])] + [("b", i, 3.0 - i) for i in range(3)]
    df = spark.createDataFrame(rows, "t string, r int, v double")
    found = {r["t"]: tuple(r)[1:] for r in early_stop(df, ["t"], "r", "v", 3).collect()}
    assert found == {"a": (1, 4.0, 4, 4.1), "b": (2, 1.0, 2, 1.0)}
    trials = spark.createDataFrame([(1, 2.0), (0, 2.0), (2, None)], "trial_id int, v double")
    assert best_trial(trials, [], "v", "max").first()["trial_id"] == 0


def test_weeks_and_futures(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', DATE '2024-01-07', 1.0D), ('a', DATE '2024-01-08', 2.0D), ('a', DATE '2024-01-25', 4.0D) AS t(g, ds, y)")
    weeks = {str(r["week"]): r["total"] for r in weekly_sums(df, ["g"], "ds", "y").collect()}
    assert weeks == {"2024-01-07": 1.0, "2024-01-14": 2.0, "2024-01-21": 0.0, "2024-01-28": 4.0}
    hours = df.withColumn("ds", F.col("ds").cast("timestamp") + F.expr("INTERVAL 5 HOURS"))
    assert [str(r["ds"]) for r in future_frame(hours, ["g"], "ds", 2).orderBy("ds").collect()] == ["2024-01-26 05:00:00", "2024-01-27 05:00:00"]


def test_release_deletes_all_intermediate_tables(spark):
    import os

    from fleet.operators.scans import global_ordinal
    from fleet.scratch import release, scratch_root

    release(spark)
    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))  # other applications may share the folder
    assert global_ordinal(spark.range(100), ["id"]).agg(F.sum("ordinal")).first()[0] == 4950
    made = [n for n in os.listdir(root) if n.startswith("fleet-") and n not in before]
    assert made and release(spark) >= 1 and release(spark) == 0
    assert not any(os.path.exists(f"{root}/{n}") for n in made)

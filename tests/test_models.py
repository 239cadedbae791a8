import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleet.functions.metrics import log_loss
from fleet.plans.bins import BinnedTable
from fleet.plans.boost import BoostParams, boost, boost_many, held_out
from fleet.plans.tree_models import model_margin, model_predict, predict
from fleet.plans.forecast import _design, _penalty, fit_groups, forecast_groups, forecast_linear_seasonal
from fleet.plans.synth import synth_series, synth_table, table_name
from fleet.plans.tune import draw_loguniform, draw_randint, draw_uniform, halving_cut, sample_trials, tpe_propose, tune


@pytest.fixture(scope="module")
def daily(spark):
    days = pd.date_range("2022-01-01", periods=400, freq="D")
    week = np.array([0, 3, 1, 0, -2, -4, 2.0])
    parts = []
    for name, slope in (("a", 0.5), ("b", -1.0)):
        parts.append(pd.DataFrame({"g": name, "ds": days, "y": 100 + slope * np.arange(400) + week[days.dayofweek]}))
    return spark.createDataFrame(pd.concat(parts)), days, week


def _truth(days, week, slope, n):
    ahead = pd.date_range(days[-1] + pd.Timedelta(days=1), periods=n, freq="D")
    return 100 + slope * (400 + np.arange(n)) + week[ahead.dayofweek]


def test_closed_form_continues_line_and_week(daily):
    df, days, week = daily
    for g, slope in (("a", 0.5), ("b", -1.0)):
        found = forecast_linear_seasonal(df, ["g"], "ds", "y").where(F.col("g") == g).orderBy("ds").toPandas()
        assert np.abs(found.yhat - _truth(days, week, slope, 14)).max() < 0.2


def test_additive_model_continues_line_and_week(daily):
    df, days, week = daily
    found = forecast_groups(df, ["g"]).orderBy("g", "ds").toPandas()
    assert len(found) == 28 and found.error.isna().all()
    for g, slope in (("a", 0.5), ("b", -1.0)):
        assert np.abs(found[found.g == g].yhat.to_numpy() - _truth(days, week, slope, 14)).max() < 0.5
    assert (found.yhat_lower <= found.yhat).all() and (found.yhat <= found.yhat_upper).all()


@pytest.mark.parametrize("step, n, cycle", [("1 DAY", 600, 7), ("1 HOUR", 24 * 40, 24), ("12 HOUR", 400, 2)])
def test_trend_keeps_the_level(spark, step, n, cycle):
    """A noiseless line with a zero-mean cycle: the season must not take a part of the level."""
    waves = np.cos(2 * np.pi * np.arange(cycle) / cycle)
    rows = spark.range(n).select(
        F.lit("a").alias("g"), F.expr(f"timestamp_ntz'2020-01-06 00:00:00' + INTERVAL {step} * id").alias("ds"),
        (1000.0 + 0.5 * F.col("id") + 20.0 * F.array(*[F.lit(float(w)) for w in waves])[F.col("id") % cycle]).alias("y"),
    )
    found = forecast_groups(rows, ["g"], horizon=14, step=step).orderBy("ds").toPandas()
    line = 1000.0 + 0.5 * np.arange(n, n + 14)
    assert np.abs(found.trend - line).max() < 3 and np.abs(found.yhat - line - 20 * waves[np.arange(n, n + 14) % cycle]).max() < 3


def test_intervals_widen(daily):
    df, _, _ = daily
    found = forecast_groups(df, ["g"], horizon=60).orderBy("g", "ds").toPandas()
    for _, part in found.groupby("g"):
        width = (part.yhat_upper - part.yhat_lower).to_numpy()
        assert (np.diff(width) >= 0).all() and width[-1] > width[0]


def test_split_groups_give_the_same_model(daily):
    df, _, _ = daily
    whole = {r["g"]: r for r in fit_groups(df, ["g"], "ds", "y").collect()}
    split = {r["g"]: r for r in fit_groups(df.unionByName(df), ["g"], "ds", "y", rows_per_block=37).collect()}
    for g in "ab":
        x = lambda r: _design(np.linspace(r["first"], r["last"] + 14, 50), r["first"], r["last"], np.array(r["active"])) @ np.array(r["beta"])
        assert np.abs(x(whole[g]) - x(split[g])).max() < 0.05


def test_custom_fit_runs_per_group(daily):
    df, _, _ = daily

    def last(pdf, horizon):
        return pd.DataFrame({"g": pdf["g"].iloc[0], "yhat": [pdf.sort_values("ds")["y"].iloc[-1]] * horizon})

    found = forecast_groups(df, ["g"], horizon=3, fit=last, schema="g string, yhat double")
    assert found.groupBy("g").count().where("count = 3").count() == 2


def test_generators(spark):
    series = synth_series(spark, groups=3, points=24)
    stats = series.groupBy("group_name").agg(F.count("*").alias("n"), F.min("ds").alias("a"), F.max("ds").alias("b")).toPandas()
    assert set(stats.group_name) == {"group_01", "group_02", "group_03"} and (stats.n == 24).all()
    assert (stats.b - stats.a == pd.Timedelta(hours=23)).all() and series.select("id").distinct().count() == 72
    wide = synth_table(spark, 200, 3, 4, groups=2, signal=1.0)
    assert wide.columns == ["id", "group_id", "r_0", "r_1", "r_2", "target"]
    assert wide.where("target <> floor(r_0 * 4)").count() == 0
    assert table_name(10, 2, 3, 4) == "synthetic_data_10_rows_2_columns_3_labels_4_groups"


@pytest.fixture(scope="module")
def wide(spark):
    return synth_table(spark, 1500, 4, 3, groups=2, signal=0.9, seed=3).persist()


FEATURES = [f"r_{i}" for i in range(4)]


def test_softmax_learns_a_separable_label(wide):
    params = BoostParams(num_class=3, num_estimators=5, max_depth=3)
    result = boost_many(wide, FEATURES, "target", [params], validation=held_out(["id"]), max_bin=64)
    losses = [r["value"] for r in result.history.orderBy("round").collect()]
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.75 * math.log(3)
    model = result.models.first()["model"]
    scored = predict(wide.where(held_out(["id"])), model, ["id", "target"])
    assert scored.agg(F.avg((F.col("prediction") == F.col("target")).cast("double"))).first()[0] > 0.85


def _reference_tree(x, grad, hess, depth, max_depth, lr, lam=1.0, gamma=0.0):
    """Brute force over all thresholds, for one output."""
    total = (grad.sum(), hess.sum())
    best = (0.0, None)
    if depth < max_depth:
        for f in range(x.shape[1]):
            for v in np.unique(x[:, f])[1:]:
                left = x[:, f] < v
                gl, hl = grad[left].sum(), hess[left].sum()
                gr, hr = total[0] - gl, total[1] - hl
                if hl >= 1 and hr >= 1:
                    gain = 0.5 * (gl**2 / (hl + lam) + gr**2 / (hr + lam) - total[0] ** 2 / (total[1] + lam)) - gamma
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, v))
    out = np.full(len(x), -lr * total[0] / (total[1] + lam))
    if best[1]:
        f, v = best[1]
        for side in (x[:, f] < v, x[:, f] >= v):
            out[side] = _reference_tree(x[side], grad[side], hess[side], depth + 1, max_depth, lr)
    return out


def test_squared_error_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (150, 2)).astype(float)
    y = 3 * x[:, 0] + (x[:, 1] > 5) * 10 + rng.normal(0, 0.1, 150)
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y})
    params = BoostParams("reg:squarederror", eval_metric="rmse", num_estimators=3, max_depth=3)
    text = boost(spark.createDataFrame(pdf), None, ["a", "b"], "y", params).models.first()["model"]
    margin = np.full(150, y.mean())
    for _ in range(3):
        margin = margin + _reference_tree(x, margin - y, np.ones(150), 0, 3, 0.3)
    assert np.abs(model_margin(text, pdf)[:, 0] - margin).max() < 1e-8


def test_result_does_not_depend_on_stored_margins_or_partitions(wide, monkeypatch):
    import fleet.plans.boost as module

    params = [BoostParams(num_class=3, num_estimators=4, max_depth=2), BoostParams(num_class=3, num_estimators=3, max_leaves=4, max_depth=0)]
    runs = []
    for every, parts in ((100, 1), (1, 7)):
        monkeypatch.setattr(module, "STORE_EVERY", every)
        history = boost_many(wide.repartition(parts), FEATURES, "target", params, ["group_id"], held_out(["id"]), 32).history
        runs.append(history.orderBy("group_id", "trial_id", "round").toPandas())
    assert len(runs[0]) == 14 and np.allclose(runs[0].value, runs[1].value)


def test_waves_and_packs_give_the_same_models(wide, monkeypatch):
    import fleet.plans.bins as bins
    import fleet.plans.boost as module

    params = [BoostParams(num_class=3, num_estimators=2, max_depth=2), BoostParams(num_class=3, num_estimators=2, max_depth=1)]
    runs = []
    for limit in (256 << 20, 1):
        monkeypatch.setattr(bins, "EDGE_BYTES", limit)
        monkeypatch.setattr(module, "HISTOGRAM_BYTES", limit)
        found = boost_many(wide, FEATURES, "target", params, ["group_id"], held_out(["id"]), 32).history
        runs.append(found.orderBy("group_id", "trial_id", "round").toPandas())
    assert len(runs[0]) == 8 and np.allclose(runs[0].value, runs[1].value)


def test_leafwise_growth_takes_the_best_leaf(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 16, (300, 1)).astype(float)
    y = np.where(x[:, 0] < 8, 0.0, np.where(x[:, 0] < 12, 50.0, np.where(x[:, 0] < 14, 300.0, 900.0)))
    params = BoostParams("reg:squarederror", eval_metric="rmse", num_estimators=1, max_depth=0, max_leaves=3, learning_rate=1.0, reg_lambda=0.0)
    pdf = pd.DataFrame({"a": x[:, 0], "y": y})
    text = boost(spark.createDataFrame(pdf), None, ["a"], "y", params).models.first()["model"]
    found = np.round(model_margin(text, pdf)[:, 0], 6)
    assert len(set(found)) == 3 and set(found[x[:, 0] >= 14]) == {900.0} and set(found[(x[:, 0] >= 12) & (x[:, 0] < 14)]) == {300.0}


def test_early_stopping_sampling_and_metric_stop(wide):
    params = [
        BoostParams(num_class=3, num_estimators=12, max_depth=2, learning_rate=0.9, early_stopping_rounds=2),
        BoostParams(num_class=3, num_estimators=4, max_depth=3, subsample=0.3, sampling_method="gradient_based"),
        BoostParams(num_class=3, num_estimators=4, max_depth=3, subsample=0.5),
        BoostParams(num_class=3, num_estimators=9, max_depth=3, eval_metric="accuracy", stop_metric=0.5),
    ]
    found = boost_many(wide, FEATURES, "target", params, validation=held_out(["id"]), max_bin=32).history.toPandas()
    for trial in (1, 2):
        values = found[found.trial_id == trial].sort_values("round").value.to_numpy()
        assert len(values) == 4 and values[-1] < values[0]
    stopped = found[found.trial_id == 0].sort_values("round").value.to_numpy()
    assert len(stopped) == 12 or len(stopped) - 1 - stopped.argmin() == 2
    assert len(found[found.trial_id == 3]) < 9


def test_uniform_prediction_loss_is_log_classes(spark):
    df = spark.range(10).select(F.lit(1 / 3).alias("p"))
    assert abs(df.agg(log_loss(F.col("p"))).first()[0] - math.log(3)) < 1e-12


def test_trials_stay_in_space_and_do_not_move(spark):
    groups = spark.createDataFrame([("a",), ("b",)], "g string")
    space = {"lr": draw_loguniform(1e-4, 1e-2), "p": {"depth": draw_randint(4, 6), "kind": "hist", "gamma": 0}}
    found = sample_trials(groups, space, 50).toPandas()
    again = sample_trials(groups.repartition(3), space, 50).toPandas()
    key = ["g", "trial_id"]
    assert found.sort_values(key).params.tolist() == again.sort_values(key).params.tolist()
    values = pd.DataFrame(found.params.tolist())
    assert values.lr.between(1e-4, 1e-2).all() and set(values["p.depth"]) == {4.0, 5.0} and set(values["p.gamma"]) == {0.0}
    assert found.settings.iloc[0] == {"p.kind": "hist"}


def test_tpe_beats_random_on_a_quadratic(spark):
    groups = spark.createDataFrame([(f"s{i}",) for i in range(8)], "g string")
    space = {"x": draw_uniform(-10.0, 10.0)}
    loss = lambda df: df.withColumn("value", F.pow(F.col("params")["x"] - 3.0, F.lit(2.0)))
    seen = loss(sample_trials(groups, space, 20, seed=1)).persist()
    proposed = loss(tpe_propose(seen, groups, space, 4, seed=1, start=20)).toPandas()
    random = loss(sample_trials(groups, space, 4, seed=9)).toPandas()
    assert sorted(proposed.trial_id.unique()) == [20, 21, 22, 23] and len(proposed) == 32
    assert proposed.groupby("g").value.mean().mean() < 0.3 * random.groupby("g").value.mean().mean()


def _finished(spark, groups, rows):
    """Trials of every group from (settings, value)."""
    made = [(g, i, {k: float(v) for k, v in settings.items()}, float(value)) for g in groups for i, (settings, value) in enumerate(rows)]
    return spark.createDataFrame(made, "g string, trial_id int, params map<string,double>, value double")


def test_proposals_are_drawn_near_the_good_trials(spark):
    """Good trials in a five-hundredth of the range: candidates from the whole range rarely come near it."""
    groups = spark.createDataFrame([(f"s{i}",) for i in range(6)], "g string")
    space = {"x": draw_uniform(0.0, 1000.0), "lr": draw_loguniform(1e-6, 1.0), "depth": draw_randint(1, 200), "kind": "hist", "gamma": 0.5}
    good = [({"x": 700 + 2 * i / 60, "lr": 1e-3 * (1 + i / 600), "depth": 40 + i % 2}, i) for i in range(60)]
    rest = [({"x": i * 1000 / 180, "lr": 10 ** (-6 * i / 180), "depth": 1 + i}, 100 + i) for i in range(180)]
    seen = _finished(spark, [f"s{i}" for i in range(6)], good + rest)
    found = tpe_propose(seen, groups, space, 30, seed=3, start=7).toPandas().sort_values(["g", "trial_id"])
    assert len(found) == 180 and sorted(found[found.g == "s0"].trial_id) == list(range(7, 37))
    values = pd.DataFrame(found.params.tolist())
    assert (values.x - 701).abs().max() < 40 and values.x.nunique() > 100
    assert np.log10(values.lr / 1e-3).abs().max() < 0.4 and (values.depth - 40.5).abs().max() < 12
    assert (values.depth % 1 == 0).all() and set(values.gamma) == {0.5} and found.settings.iloc[0] == {"kind": "hist"}
    again = tpe_propose(seen.repartition(5), groups.repartition(3), space, 30, seed=3, start=7).toPandas().sort_values(["g", "trial_id"])
    same = pd.DataFrame(again.params.tolist())
    assert np.allclose(same.x, values.x) and np.allclose(same.lr, values.lr) and same.depth.equals(values.depth)


def test_proposals_stay_in_space_and_few_trials_do_not_bind_them(spark):
    """Good trials at the ends, one good trial only, a failed trial, and a group without any."""
    groups = spark.createDataFrame([("low",), ("high",), ("one",), ("failed",), ("none",), (None,)], "g string")
    space = {"x": draw_uniform(2.0, 3.0), "lr": draw_loguniform(1e-4, 1e-2), "depth": draw_randint(2, 4)}
    at = lambda x, lr, depth: {"x": x, "lr": lr, "depth": depth}
    low, high = at(2.0, 1e-4, 2), at(2.999, 9.99e-3, 3)
    seen = _finished(spark, ["low", None], [(low, i) for i in range(4)] + [(high, 9)] * 12)
    seen = seen.unionByName(_finished(spark, ["high"], [(high, i) for i in range(4)] + [(low, 9)] * 12))
    seen = seen.unionByName(_finished(spark, ["one"], [(at(2.5, 1e-3, 3), 1), (low, 2)]))
    seen = seen.unionByName(_finished(spark, ["failed"], [(low, 0)]).withColumn("value", F.lit(None).cast("double")))
    found = tpe_propose(seen, groups, space, 40, seed=1, start=20).toPandas()
    assert found.groupby("g", dropna=False).size().tolist() == [40] * 6
    values = pd.DataFrame(found.params.tolist()).assign(g=found.g.fillna("null").to_numpy())
    assert values.x.between(2.0, 3.0).all() and values.lr.between(1e-4 * (1 - 1e-9), 1e-2 * (1 + 1e-9)).all() and set(values.depth) == {2.0, 3.0}
    by = values.groupby("g")
    assert by.x.mean()["low"] < 2.35 and by.x.mean()["null"] < 2.35 and by.x.mean()["high"] > 2.65
    assert 2.6 < by.x.mean()["one"] < 2.9  # past the good trial, away from the other: the highest ratio is at 2.77
    assert by.x.std()["none"] > 0.2


def test_tune_groups_keeps_a_model_of_all_rows(spark, folder):
    """The best settings of each group are trained again on all of its rows, and the model is in the result."""
    from fleet.queries.training import _orders, tune_groups

    found = {r["o_orderpriority"]: r for r in tune_groups(spark, folder).collect()}
    means = {r[0]: r[1] for r in _orders(spark, folder).groupBy("o_orderpriority").agg(F.avg("y")).collect()}
    assert set(found) == set(means) and all(r["value"] > 0 and r["trial_id"] in range(4) for r in found.values())
    for g, row in found.items():
        model = json.loads(row["model"])
        assert abs(model["base"] - means[g]) < 1e-6 * means[g]
        assert 1 <= len(model["rounds"]) <= row["params"]["num_estimators"] and any(f >= 0 for f in model["rounds"][0][0]["feature"])


def test_halving_cut(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(16)], "trial_id int, value double")
    assert {r["trial_id"] for r in halving_cut(df, "value", 4).collect()} == {0, 1, 2, 3}
    assert {r["trial_id"] for r in halving_cut(df, "value", 4, mode="max").collect()} == {12, 13, 14, 15}


def test_tune_picks_the_minimum_of_its_trials(wide):
    space = {"learning_rate": draw_uniform(0.01, 0.6), "max_depth": draw_randint(1, 4)}
    base = BoostParams(num_class=3, num_estimators=2)
    found = tune(wide, FEATURES, "target", space, 4, base, held_out(["id"]), ["group_id"], max_concurrent_trials=2, max_bin=32)
    trials = found.trials.toPandas()
    assert len(trials) == 8
    best = found.best.toPandas().set_index("group_id")
    assert best.value.to_dict() == trials.groupby("group_id").value.min().to_dict()
    pdf = wide.limit(20).toPandas()
    assert len(model_predict(best.model.iloc[0], pdf)) == 20


def test_tune_keeps_every_group_and_setting(spark):
    """A group without held-out rows and one without training rows still have a row; other names reach the model."""
    rows = spark.range(600).select(
        F.when(F.col("id") < 400, "big").when(F.col("id") < 500, "kept").otherwise("held").alias("g"), (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 7 > 3).cast("double").alias("y"), (F.col("id") >= 500).__or__((F.col("id") < 400) & (F.col("id") % 4 == 0)).alias("v"),
    )
    base = BoostParams("reg:squarederror", eval_metric="rmse", num_estimators=1, max_depth=1)
    space = {"params": {"num_leaves": 4, "n_estimators": 3, "early_stopping_round": 2}, "eval_metric": "mae"}
    found = tune(rows, ["x"], "y", space, 2, base, F.col("v"), ["g"], max_bin=16)
    best = {r["g"]: r for r in found.best.collect()}
    assert set(best) == {"big", "kept", "held"}
    assert best["big"]["error"] is None and best["big"]["value"] is not None
    assert best["kept"]["error"] == "no held-out rows" and best["kept"]["model"]
    assert best["held"]["error"] == "no training rows"
    rounds = found.history.where("g = 'big' AND trial_id = 0")
    assert rounds.count() == 3 and {r["metric"] for r in rounds.select("metric").collect()} == {"mae"}
    with pytest.raises(Exception, match="no settings of a model: depth"):
        tune(rows, ["x"], "y", {"depth": 3}, 1, base, F.col("v"), ["g"], max_bin=16)


def _same_models(a, b, keys):
    a, b = (r.orderBy(*keys).toPandas() for r in (a, b))
    assert np.allclose(a.value, b.value) and len(a) == len(b)
    for x, y in zip(a.model, b.model):
        assert _shape(x) == _shape(y)


def _shape(text):
    rounds = json.loads(text)["rounds"]
    return [[(t["feature"], np.round(t["threshold"], 9).tolist(), np.round(t["value"], 6).tolist()) for t in trees] for trees in rounds]


@pytest.mark.parametrize("base", [
    BoostParams(num_class=3, num_estimators=3, max_depth=3, early_stopping_rounds=2), BoostParams(num_class=3, num_estimators=2, max_depth=0, max_leaves=5),
    BoostParams("reg:squarederror", eval_metric="rmse", num_estimators=3, max_depth=2, subsample=0.4),
    BoostParams("reg:squarederror", eval_metric="mae", num_estimators=3, max_depth=2, subsample=0.3, sampling_method="gradient_based"),
])
def test_small_groups_get_the_trees_of_the_level_jobs(wide, base):
    space = {"learning_rate": draw_uniform(0.1, 0.5), "gamma": draw_uniform(0.0, 0.1)}
    how = dict(search="random", max_bin=32, exact_bins=True)
    runs = [tune(wide, FEATURES, "target", space, 3, base, held_out(["id"]), ["group_id"], small_rows=n, trials_per_task=t, **how) for n, t in ((0, None), (10_000, 2))]
    _same_models(runs[0].best, runs[1].best, ["group_id"])
    a, b = (r.history.orderBy("group_id", "trial_id", "round").toPandas() for r in runs)
    assert np.allclose(a.value, b.value) and a.metric.equals(b.metric) and len(a) == len(b)


def test_small_and_large_groups_in_one_search(spark, wide):
    sizes = wide.groupBy("group_id").count().collect()
    few = wide.limit(20).withColumn("group_id", F.lit(None).cast(wide.schema["group_id"].dataType))
    both = wide.unionByName(few)
    found = tune(both, FEATURES, "target", {"max_depth": draw_randint(1, 3)}, 2, BoostParams(num_class=3, num_estimators=1), held_out(["id"]), ["group_id"],
                 search="random", max_bin=16, small_rows=100, refit=True)
    best = {r["group_id"]: r for r in found.best.collect()}
    assert set(best) == {None, *(r["group_id"] for r in sizes)} and all(r["model"] for r in best.values())
    assert {r["group_id"] for r in found.refitted.collect()} == set(best)


def test_halving_in_tasks_equals_halving_in_level_jobs(wide):
    base = BoostParams(num_class=3, num_estimators=4, max_depth=2)
    space = {"learning_rate": draw_uniform(0.05, 0.6)}
    runs = [tune(wide, FEATURES, "target", space, 4, base, held_out(["id"]), ["group_id"], search="random", halving_eta=2, max_bin=32, exact_bins=True, small_rows=n) for n in (0, 10_000)]
    a, b = (r.history.groupBy("group_id", "trial_id").count().orderBy("group_id", "trial_id").toPandas() for r in runs)
    assert a.equals(b) and a["count"].min() < a["count"].max()


def test_own_fit_function_and_failures(spark):
    rows = spark.range(300).select((F.col("id") % 3).cast("int").alias("g"), F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("y"))

    def fit(pdf, params):
        if pdf.g.iloc[0] == 2:
            raise ValueError("no such group")
        guess = params["shift"] + pdf.y[~pdf._held].mean()
        return {"value": float(((pdf.y[pdf._held] - guess) ** 2).mean()), "model": json.dumps({"guess": guess})}

    space = {"shift": draw_uniform(-3.0, 3.0)}
    found = tune(rows, ["y"], "y", space, 6, BoostParams("reg:squarederror", eval_metric="rmse"), held_out(["k"]), ["g"], fit_fn=fit, search="random", refit=False)
    best = {r["g"]: r for r in found.best.collect()}
    trials = found.trials.toPandas()
    for g in (0, 1):
        mine = trials[trials.g == g]
        assert best[g]["value"] == mine.value.min()
        assert json.loads(best[g]["model"])["guess"] is not None
    assert "no such group" in best[2]["error"]
    with pytest.raises(ValueError, match="small_rows"):
        tune(rows, ["y"], "y", space, 1, BoostParams("reg:squarederror", eval_metric="rmse"), held_out(["k"]), ["g"], fit_fn=fit, small_rows=10)


def test_number_of_jobs_does_not_grow_with_groups(spark):
    def jobs(groups):
        rows = spark.range(groups * 8).select((F.col("id") % groups).alias("g"), F.col("id").alias("k"), (F.col("id") % 5).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("y"))
        name = f"groups-{groups}"
        spark.sparkContext.setJobGroup(name, name)
        found = tune(rows, ["x"], "y", {"max_depth": draw_randint(1, 3)}, 2, BoostParams("reg:squarederror", eval_metric="rmse", num_estimators=2), held_out(["k"]), ["g"], search="random", max_bin=8)
        assert found.best.count() == groups
        done = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return done

    few, many = jobs(20), jobs(2_000)
    assert many <= few + 4


def test_search_is_logged_and_routed(spark, wide, tmp_path):
    from fleet.plans.runs import load_models, log_search, route_by_artifacts, search_runs
    from fleet.scratch import release, temporary_table

    runs, models = temporary_table(spark, "runs"), temporary_table(spark, "models")
    found = tune(wide, FEATURES, "target", {"max_depth": draw_randint(1, 3)}, 3, BoostParams(num_class=3, num_estimators=2), held_out(["id"]), ["group_id"], search="random", max_bin=16, refit=True)
    best = found.refitted.join(found.best.select("group_id", "value"), "group_id")
    places = log_search(found.trials, best, ["group_id"], "7", "parent", runs, models)
    log = spark.table(runs)
    assert log.count() == 1 + 6 + 2 and search_runs(log, "BEST_group").count() == 2
    assert log.where("parent_run_id = 'parent'").select("run_id").distinct().count() == 8
    named = {r["local_run_model_path"] for r in places.collect()}
    assert named == {r["path"] for r in spark.table(models).collect()} == {f"{r['run_id']}/best_model/model" for r in search_runs(log, "BEST_group").collect()}
    routed = route_by_artifacts(wide, places, models, ["group_id"], "id", model_predict, FEATURES).toPandas().set_index("id").prediction
    texts = {r["group_id"]: r["model"] for r in found.refitted.collect()}
    for g, part in wide.toPandas().groupby("group_id"):
        assert (routed[part.id].to_numpy() == model_predict(texts[g], part).to_numpy()).all()
    assert load_models(places, models).count() == 2
    release(spark)
    assert not spark.catalog.tableExists(models) and not spark.catalog.tableExists(runs)


def test_sampled_trees_do_not_depend_on_the_layout(wide):
    params = [BoostParams(num_class=3, num_estimators=3, max_depth=2, subsample=0.4), BoostParams(num_class=3, num_estimators=3, max_depth=2, subsample=0.3, sampling_method="gradient_based")]
    a, b = (boost_many(wide.repartition(n), FEATURES, "target", params, validation=held_out(["id"]), max_bin=16, exact_bins=True).models.orderBy("trial_id").collect() for n in (1, 7))
    assert [_shape(r["model"]) for r in a] == [_shape(r["model"]) for r in b]


def test_training_rows_are_held_in_packs_that_lose_none(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("g"), "id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    table = BinnedTable(df, ["x"], "y", ["g"], held_out(["id"]), 8)
    wave = table.wave(0)
    packs = wave.rows.select("_g", "_val", *[F.octet_length(c).alias(c) for c in ("_row", "_y", "_bins", "_m")]).collect()
    assert len(packs) <= 2 * (len(wave.members) + wave.rows.rdd.getNumPartitions())
    assert all(p["_row"] == p["_y"] == 8 * p["_bins"] and p["_m"] == 0 for p in packs) and sum(p["_bins"] for p in packs) == 30_000
    assert {(p["_g"], p["_val"]) for p in packs} == {(g, side) for g in range(3) for side in (False, True)}
    table.close()


def test_small_groups_are_fitted_many_in_a_call(spark):
    day = F.expr("date_add(DATE '2024-01-01', cast(id % 30 as int))")
    df = spark.range(9_000).select(F.when(F.col("id") % 300 > 0, F.col("id") % 300).alias("g"), day.alias("ds"), F.rand(1).alias("y"))
    models = fit_groups(df, ["g"], "ds", "y")
    assert "_call" in models._jdf.queryExecution().executedPlan().toString()
    found = models.toPandas()
    assert len(found) == 300 and found.g.isna().sum() == 1 and found.error.isna().all()
    one = fit_groups(df.where("g = 7"), ["g"], "ds", "y").first()
    assert np.allclose(found[found.g == 7].beta.iloc[0], one["beta"]) and list(found[found.g == 7].active.iloc[0]) == one["active"]


def test_rows_leave_the_tasks_that_read_them_in_packs(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("g"), "id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    table = BinnedTable(df, ["x"], "y", ["g"], held_out(["id"]), 8)
    wave = table.wave(0)
    stored = spark.read.parquet(f"{table.scratch.path}/wave0")
    assert stored.count() < 300 and stored.agg(F.sum(F.octet_length("_bins"))).first()[0] == 30_000
    means = df.where(~held_out(["id"])).groupBy("g").agg(F.avg("y").alias("m")).collect()
    assert np.allclose([wave.means[g] for g, _ in sorted(wave.members.items())], [r["m"] for r in sorted(means)])
    table.close()


def test_level_jobs_read_only_the_rows_of_the_sample(wide, monkeypatch):
    import fleet.plans.boost as module

    params = BoostParams(num_class=3, num_estimators=2, max_depth=3, subsample=0.1, sampling_method="gradient_based")
    real, read, histories = module._Trainer.histogram, [], []

    def watched(trainer, pack, current):
        state = trainer.state if getattr(trainer, "sample", None) is None else trainer.sample
        read.append(state.where("NOT _val").agg(F.sum(F.octet_length("_y")) / 8).first()[0])
        return real(trainer, pack, current)

    monkeypatch.setattr(module._Trainer, "histogram", watched)
    for share in (0.5, 0.0):
        monkeypatch.setattr(module, "SAMPLE_SHARE", share, raising=False)
        found = boost_many(wide, FEATURES, "target", [params], ["group_id"], held_out(["id"]), 32).history
        histories.append(found.orderBy("group_id", "round").toPandas())
    assert len(read) == 12 and max(read[:6]) < 300 and min(read[6:]) > 1_000
    assert len(histories[0]) == 4 and np.allclose(histories[0].value, histories[1].value)


@pytest.mark.parametrize("splits", [0, 3, 20])
def test_both_walks_of_a_tree_end_in_the_same_leaves(monkeypatch, splits):
    import fleet.plans.boost as module

    rng = np.random.default_rng(splits)
    tree = {k: [-1] for k in ("feature", "bin", "left", "right")}
    for _ in range(splits):
        at = int(rng.choice([i for i, f in enumerate(tree["feature"]) if f < 0]))
        tree["feature"][at], tree["bin"][at], tree["left"][at], tree["right"][at] = rng.integers(3), rng.integers(255), len(tree["bin"]), len(tree["bin"]) + 1
        for values in tree.values():
            values += [-1, -1]
    tree, codes = {k: np.array(v, np.int32) for k, v in tree.items()}, rng.integers(0, 256, (4_000, 3)).astype(np.uint8)
    found = module._leaf_of(tree, codes)
    monkeypatch.setattr(module, "FEW_SPLITS", -1)
    assert (found == module._leaf_of(tree, codes)).all() and (tree["feature"][found] < 0).all()


def test_metrics_and_sample_scores_are_taken_with_the_margins(wide, monkeypatch):
    """The packs that a metric is taken from hold the sums of its round, and it is the loss of the model that is returned."""
    import fleet.plans.boost as module

    params = [
        BoostParams(num_class=3, num_estimators=3, max_depth=2, subsample=0.3, sampling_method="gradient_based"),
        BoostParams(num_class=3, num_estimators=2, max_depth=1),
    ]
    sums, added, evaluate = [], module._Work.added, module._Trainer._evaluate

    def local(trainer, active):
        walked = trainer.state.where("_val").select("_g", "_sums").toArrow().to_batches()
        found = added(trainer._work(active).value, iter(walked), (2,))
        sums.append({k: float(v[0] / v[1]) for k, v in found.items()})
        return evaluate(trainer, active)

    monkeypatch.setattr(module._Trainer, "_evaluate", local)
    found = boost_many(wide, FEATURES, "target", params, ["group_id"], held_out(["id"]), 32)
    history = found.history.toPandas().set_index(["group_id", "trial_id", "round"]).value
    assert len(history) == 10 and len(sums) == 3 and len(sums[2]) == 2
    for round_, by_model in enumerate(sums):
        for (g, t), value in by_model.items():
            assert abs(history[sorted(history.index.levels[0])[g], t, round_] - value) < 1e-9
    scored = wide.where(held_out(["id"]))
    for row in found.models.collect():
        part = scored.where(F.col("group_id") == row["group_id"]).toPandas()
        margin = model_margin(row["model"], part)
        shares = np.exp(margin) / np.exp(margin).sum(1, keepdims=True)
        assert abs(-np.log(shares[np.arange(len(part)), part.target.astype(int)]).mean() - row["value"]) < 1e-9


def test_rows_without_a_sample_are_held_without_their_ids(wide, monkeypatch):
    import fleet.plans.boost as module

    held, real = [], module._Trainer._evaluate

    def watched(trainer, active):
        held.append(trainer.state.agg(F.sum(F.octet_length("_row")), F.sum(F.octet_length("_y"))).first())
        return real(trainer, active)

    monkeypatch.setattr(module._Trainer, "_evaluate", watched)
    for share in (1.0, 0.9):
        boost_many(wide, FEATURES, "target", [BoostParams(num_class=3, num_estimators=1, max_depth=1, subsample=share)], validation=held_out(["id"]), max_bin=16)
    assert [h[0] for h in held] == [0, 12_000] and held[0][1] == held[1][1] == 12_000

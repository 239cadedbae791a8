"""Asynchronous halving against a plain replay, and concurrent trials on one table."""

import threading
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fleet.plans import async_search
from fleet.plans.async_search import AsyncHalving, earlier_better, replay_async, tune_concurrent
from fleet.plans.boost import BoostParams, boost_many, held_out
from fleet.plans.synth import synth_table
from fleet.plans.tune import draw_uniform

FEATURES = [f"r_{i}" for i in range(3)]
LOG = "g string, trial_id int, rung int, reported long, value double, note string"


def _plain(rows, eta, mode):
    """Every report in order against a list of the values before it."""
    sign, stopped, values, out = 1 if mode == "min" else -1, set(), {}, {}
    for g, trial, rung, at, value, _ in sorted(rows, key=lambda r: (r[2], r[3], r[1])):
        if (g, trial, rung - 1) not in out and rung or (g, trial) in stopped:
            continue
        if value is None or value != value:
            out[g, trial, rung] = (None, None, False)
        else:
            before = values.setdefault((g, rung), [])
            better = sum(sign * v < sign * value for v in before)
            before.append(value)
            out[g, trial, rung] = (len(before), better, better * eta < len(before))
        if not out[g, trial, rung][2]:
            stopped.add((g, trial))
    return out


@pytest.mark.parametrize("mode, eta", [("min", 2), ("max", 3)])
def test_replay_equals_a_plain_one(spark, mode, eta):
    """Ties, missing values, a null group, and one group with nearly all reports."""
    rows = []
    for rung in range(3):
        for trial in range(90):
            g = None if trial % 9 == 0 else "hot"
            value = None if (trial + rung) % 17 == 0 else float("nan") if trial == 40 else float((trial * 37 + rung * 11) % 23)
            rows.append((g, trial, rung, (trial * 53) % 90, value, "x"))
    log = spark.createDataFrame(rows, LOG).repartition(5)
    found = replay_async(log, ["g"], eta, mode).collect()
    assert {(r.g, r.trial_id, r.rung): (r.seen, r.better, r.goes_on) for r in found} == _plain(rows, eta, mode)
    assert len(found) == len(_plain(rows, eta, mode)) and {r.note for r in found} == {"x"}


def test_replay_of_nothing(spark):
    found = replay_async(spark.createDataFrame([], LOG), ["g"])
    assert found.count() == 0 and found.columns[-3:] == ["seen", "better", "goes_on"]
    one = replay_async(spark.createDataFrame([("a", 1, 0, 0, 2.0, None)], LOG)).first()
    assert (one.seen, one.better, one.goes_on) == (1, 0, True)


def test_earlier_better_counts_every_prefix(spark):
    values = [(i * 7919) % 101 for i in range(130)]
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, v double").repartition(3)
    for r in earlier_better(rows, [], ["i"], "v").collect():
        assert (r.seen, r.better) == (r.i + 1, sum(v < values[r.i] for v in values[: r.i]))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.one_of(st.none(), st.integers(0, 9).map(float))), max_size=40), st.integers(2, 5))
def test_decisions_follow_the_rule(reports, eta):
    halving, values = AsyncHalving(eta), {}
    for trial, (rung, value) in enumerate(reports):
        before = values.setdefault(rung, [])
        goes_on = halving.report(trial, rung, value)
        if value is not None:
            before.append(value)
        assert goes_on == (value is not None and sum(v < value for v in before) * eta < len(before))
    assert [r[2] for r in halving.log] == list(range(len(reports)))


def test_rungs():
    halving = AsyncHalving(3, 2)
    assert [halving.rung(n) for n in (1, 2, 3, 6, 17, 18)] == [None, 0, None, 1, None, 2]
    with pytest.raises(ValueError):
        AsyncHalving(1)


@pytest.fixture(scope="module")
def wide(spark):
    return synth_table(spark, 800, 3, 2, signal=0.9, seed=5).persist()


BASE = BoostParams(num_class=2, num_estimators=4, max_depth=2)
SPACE = {"learning_rate": draw_uniform(0.05, 0.6)}


def test_concurrent_trials_equal_single_ones_and_replay(spark, wide):
    halving = AsyncHalving(2)
    found = tune_concurrent(wide, FEATURES, "target", SPACE, 4, BASE, held_out(["id"]), 3, halving, max_bin=16, exact_bins=True)
    trials = {r.trial_id: r for r in found.trials.collect()}
    assert sorted(trials) == [0, 1, 2, 3] and all(r.error is None for r in trials.values())
    live = {(r.trial_id, r.rung): (r.seen, r.better, r.goes_on) for r in found.reports.collect()}
    again = replay_async(found.reports.select("trial_id", "rung", "reported", "value"), eta=2).collect()
    assert {(r.trial_id, r.rung): (r.seen, r.better, r.goes_on) for r in again} == live
    rounds = {r.trial_id: r["count"] for r in found.history.groupBy("trial_id").count().collect()}
    for trial in trials:  # a stopped trial trains no further round
        stops = [2**rung for (t, rung), (_, _, goes_on) in live.items() if t == trial and not goes_on]
        assert rounds[trial] == min(stops + [4])
    whole = tune_concurrent(wide, FEATURES, "target", SPACE, 2, BASE, held_out(["id"]), 2, max_bin=16, exact_bins=True)
    assert whole.reports.count() == 0
    for r in whole.trials.collect():
        alone = boost_many(wide, FEATURES, "target", [BoostParams(num_class=2, num_estimators=4, max_depth=2, learning_rate=r.params["learning_rate"])],
                           validation=held_out(["id"]), max_bin=16, exact_bins=True).models.first()
        assert alone.value == pytest.approx(r.value, abs=1e-9)
    assert whole.best.first()["value"] == min(r.value for r in whole.trials.collect())


def test_trials_overlap_up_to_the_limit_and_fail_alone(spark, wide, monkeypatch):
    running, most, groups, lock, real = [0], [0], set(), threading.Lock(), async_search.train

    def watched(table, params, *rest):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
            groups.add(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))
            fails = len(groups) == 2
        try:
            if fails:
                raise ValueError("planted")
            time.sleep(0.5)
            return real(table, params, *rest)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(async_search, "train", watched)
    short = BoostParams(num_class=2, num_estimators=1, max_depth=1)
    found = tune_concurrent(wide, FEATURES, "target", SPACE, 5, short, held_out(["id"]), 2, max_bin=8).trials.collect()
    assert most[0] == 2 and len(groups) == 5
    assert [r.error for r in found if r.error] == ["ValueError: planted"]
    assert sum(r.value is not None for r in found) == 4


def test_a_table_without_rows_gives_errors(spark, wide):
    found = tune_concurrent(wide.where("false"), FEATURES, "target", SPACE, 2, BASE, F.lit(False), max_bin=8)
    assert all(r.error and r.value is None for r in found.trials.collect()) and found.best.count() == 1


@pytest.mark.parametrize("bits, cells", [(18, 0), (4, 6 * 700 + 6 * 100), (0, 10 * 800)])
@pytest.mark.parametrize("mode", ["min", "max"])
def test_runs_are_counted_in_tasks_and_cells_only_between_them(spark, monkeypatch, mode, bits, cells):
    made, real = [], async_search.running
    monkeypatch.setattr(async_search, "RUN_BITS", bits, raising=False)
    monkeypatch.setattr(async_search, "running", lambda df, *rest: made.append(df.count()) or real(df, *rest))
    draws = np.random.default_rng(3).integers(0, 40, 800)
    rows = [("big" if i < 700 else None, i, int(v)) for i, v in enumerate(draws)]
    df = spark.createDataFrame(rows, "g string, at long, v long").repartition(5)
    found = {r["at"]: (r["seen"], r["better"]) for r in async_search.earlier_better(df, ["g"], ["at"], "v", mode).collect()}
    sign = 1 if mode == "min" else -1
    for i, v in enumerate(draws):
        before = draws[(0 if i < 700 else 700) : i]
        assert found[i] == (len(before) + 1, int((sign * before < sign * v).sum()))
    assert sum(made) == cells

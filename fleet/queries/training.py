"""Boosted trees and hyperparameter search."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from fleet.operators.history import best_trial
from fleet.operators.keys import join_on
from fleet.plans.bins import feature_array, quantile_bins
from fleet.plans.async_search import replay_async, tune_concurrent
from fleet.plans.boost import BoostParams, best_split, boost_many, held_out, root_histogram
from fleet.plans.tree_models import model_margin, model_predict, predict
from fleet.plans.tune import draw_loguniform, draw_randint, draw_uniform, halving_cut, sample_trials, tpe_scores, tune
from fleet.operators.groups import route_predict
from fleet.plans.sketch import column_quantiles
from fleet.plans.runs import log_search, route_by_artifacts
from fleet.queries.registry import query, sql_uniform, table
from fleet.scratch import temporary_table

_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CLASSES = BoostParams(num_class=3, num_estimators=1, max_depth=1)
_BINS = 16
_CELLS = f"""cells AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y,
                    CAST(i - 1 AS INTEGER) AS feature, [l_quantity, l_extendedprice, l_discount, l_tax][i] AS x
             FROM lineitem, range(1, 5) t(i)),
    edges AS (SELECT feature, list_distinct(quantile_cont(x, [{', '.join(f'{i}/{_BINS}' for i in range(1, _BINS))}])) AS edges
              FROM cells GROUP BY feature)"""
_HISTOGRAM = f"""{_CELLS},
    binned AS (SELECT y, c.feature, CAST(len(list_filter(edges, lambda e: e <= x)) AS INTEGER) AS bin
               FROM cells c JOIN edges e ON c.feature = e.feature),
    hist AS (SELECT CAST(k AS INTEGER) AS class, feature, bin, sum(1.0::DOUBLE / 3 - (y = k)::INT) AS g,
                    sum(2.0::DOUBLE * (1.0::DOUBLE / 3) * (1 - 1.0::DOUBLE / 3)) AS h FROM binned, range(0, 3) t(k) GROUP BY 1, 2, 3)"""
_SPLIT = f"""{_HISTOGRAM},
    sums AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER p AS ga, sum(h) OVER p AS ha FROM hist
             WINDOW w AS (PARTITION BY class, feature ORDER BY bin), p AS (PARTITION BY class, feature)),
    gains AS (SELECT *, 0.5 * (gl * gl / (hl + 1) + (ga - gl) ** 2 / (ha - hl + 1) - ga * ga / (ha + 1)) AS gain
              FROM sums WHERE hl >= 1 AND ha - hl >= 1),
    best AS (SELECT * FROM gains QUALIFY row_number() OVER (PARTITION BY class ORDER BY gain DESC, feature, bin) = 1)"""


def _lines(spark, folder):
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", *_FEATURES, flag.alias("target")
    )


@query(
    f"WITH {_CELLS} SELECT feature, round(edge, 6) AS edge FROM (SELECT feature, unnest(edges) AS edge FROM edges)"
)
def quantile_edges(spark, folder):
    edges = quantile_bins(_lines(spark, folder), _FEATURES, _BINS, exact=True)
    return edges.select("feature", F.explode("edges").alias("edge")).withColumn("edge", F.round("edge", 6))


@query("SELECT CAST(i AS INTEGER) AS feature, 255 AS n, true AS within FROM range(0, 4) t(i)")
def sketched_edges(spark, folder):
    """Bin edges by sketches: whether all of a feature's 255 lie within a quarter of a bin of their rank.

    Rows are counted by their place among the edges where they lie; only the edges and the counts are moved.
    """
    bins, lines = 256, _lines(spark, folder).select(feature_array(_FEATURES).alias("x"))
    found = column_quantiles(lines, "x", [i / bins for i in range(1, bins)])
    shared = spark.sparkContext.broadcast({r["feature"]: np.array(r["quantiles"], float) for r in found.collect()})

    def places(batches):
        for batch in batches:
            cells = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for i, edges in shared.value.items():
                values = cells[~np.isnan(cells[:, i]), i]
                both = np.stack([np.searchsorted(edges, values, side) for side in ("left", "right")])
                (under, upto), n = np.unique(both, axis=1, return_counts=True)
                feature = pa.array(np.full(len(n), i), pa.int32())
                yield pa.RecordBatch.from_arrays([feature, pa.array(under), pa.array(upto), pa.array(n)], ["feature", "under", "upto", "n"])

    counts = lines.mapInArrow(places, "feature int, under long, upto long, n long").groupBy("feature", "under", "upto").agg(F.sum("n").alias("n"))
    ranks = counts.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(bins - 2)))).groupBy("feature", "i").agg(
        F.sum(F.when(F.col("upto") <= F.col("i"), F.col("n")).otherwise(0)).alias("below"), F.sum(F.when(F.col("under") <= F.col("i"), F.col("n")).otherwise(0)).alias("reached"), F.sum("n").alias("total")
    )
    share, slack = (F.col("i") + 1) / bins * F.col("total"), F.col("total") / (4 * bins)
    fits = (F.col("below") <= share + slack) & (F.col("reached") >= share - slack)
    return ranks.groupBy("feature").agg(F.count("*").cast("int").alias("n"), F.every(fits).alias("within"))


@query(f"WITH {_HISTOGRAM} SELECT class, feature, bin, round(g, 4) AS g, round(h, 4) AS h FROM hist")
def gradient_hist(spark, folder):
    found = root_histogram(_lines(spark, folder), _FEATURES, "target", _CLASSES, _BINS, exact_bins=True)
    return found.select("class", "feature", "bin", F.round("g", 4).alias("g"), F.round("h", 4).alias("h"))


@query(f"WITH {_SPLIT} SELECT class, feature, bin, round(gain, 4) AS gain FROM best")
def best_splits(spark, folder):
    found = root_histogram(_lines(spark, folder), _FEATURES, "target", _CLASSES, _BINS, exact_bins=True)
    return best_split(found, ["class", "node"]).select("class", "feature", "bin", F.round("gain", 4).alias("gain"))


@query(
    f"""WITH {_SPLIT},
    margins AS (SELECT l_orderkey, l_linenumber, c.y, class, CASE WHEN x < list_sort(edges)[bin + 1] THEN -0.3 * gl / (hl + 1)
                       ELSE -0.3 * (ga - gl) / (ha - hl + 1) END AS margin
                FROM cells c JOIN best b ON c.feature = b.feature JOIN edges e ON e.feature = b.feature),
    SELECT class, round(sum(margin), 3) AS total, count(*) AS n FROM margins GROUP BY class"""
)
def boost_stump(spark, folder):
    """One round of one split per class, trained and applied: the summed margin of every class."""
    lines = _lines(spark, folder)
    model = boost_many(lines, _FEATURES, "target", [_CLASSES], max_bin=_BINS, exact_bins=True).models.first()["model"]
    shared = spark.sparkContext.broadcast(model)

    def margins(frames):
        for pdf in frames:
            found = model_margin(shared.value, pdf)
            yield pd.DataFrame({"class": range(found.shape[1]), "total": found.sum(0), "n": len(pdf)})

    parts = lines.select(*_FEATURES).mapInPandas(margins, "class int, total double, n long")
    return parts.groupBy("class").agg(F.round(F.sum("total"), 3).alias("total"), F.sum("n").alias("n"))


def _vectors(spark, folder):
    return table(spark, folder, "embeddings")


@query()
def boost_multiclass(spark, folder):
    """Softmax trees on the vectors, with the validation loss of every round."""
    params = BoostParams(num_class=10, num_estimators=4, max_depth=3, early_stopping_rounds=3)
    return boost_many(_vectors(spark, folder), "embedding", "label", [params], validation=held_out(["vec_id"]), max_bin=32).history


@query()
def boost_leafwise(spark, folder):
    """Squared error, best leaf first."""
    params = BoostParams("reg:squarederror", eval_metric="rmse", num_estimators=4, max_depth=0, max_leaves=8)
    held = held_out(["l_orderkey", "l_linenumber"])
    return boost_many(_lines(spark, folder), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", [params], validation=held, max_bin=64).history


@query()
def boost_sampled(spark, folder):
    """Gradient-based row sampling at a tenth of the rows."""
    params = BoostParams(
        "reg:squarederror", eval_metric="rmse", num_estimators=4, max_depth=3, subsample=0.1, sampling_method="gradient_based"
    )
    held = held_out(["l_orderkey", "l_linenumber"])
    return boost_many(_lines(spark, folder), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", [params], validation=held, max_bin=64).history


@query()
def boost_predict(spark, folder):
    """Train on the vectors and predict the whole table."""
    rows = _vectors(spark, folder)
    params = BoostParams(num_class=10, num_estimators=2, max_depth=3)
    model = boost_many(rows, "embedding", "label", [params], max_bin=32).models.first()["model"]
    return predict(rows, model, ["vec_id", "label"])


_SPACE = {"learning_rate": draw_uniform(0.01, 0.3), "num_estimators": draw_randint(2, 4), "max_depth": draw_randint(2, 4)}


@query(
    f"""SELECT o_orderpriority, t.i AS trial_id, round(0.01 + {sql_uniform(0, 'o_orderpriority', 't.i', "'learning_rate'")} * (0.3 - 0.01), 8)
               AS learning_rate, 2 + floor({sql_uniform(0, 'o_orderpriority', 't.i', "'params.max_depth'")} * 2)::DOUBLE AS max_depth,
               round(exp(ln(1e-4) + {sql_uniform(0, 'o_orderpriority', 't.i', "'params.lr'")} * (ln(1e-2) - ln(1e-4))), 8) AS lr,
               'hist' AS tree_method
        FROM (SELECT DISTINCT o_orderpriority FROM orders), range(0, 16) t(i)"""
)
def trial_space(spark, folder):
    groups = table(spark, folder, "orders").select("o_orderpriority").distinct()
    space = {
        "learning_rate": draw_uniform(0.01, 0.3),
        "params": {"max_depth": draw_randint(2, 4), "lr": draw_loguniform(1e-4, 1e-2), "tree_method": "hist"},
    }
    trials = sample_trials(groups, space, 16)
    number = lambda name: F.col("params")[name]
    return trials.select(
        "o_orderpriority",
        F.col("trial_id").cast("long").alias("trial_id"),
        F.round(number("learning_rate"), 8).alias("learning_rate"),
        number("params.max_depth").alias("max_depth"),
        F.round(number("params.lr"), 8).alias("lr"),
        F.col("settings")["params.tree_method"].alias("tree_method"),
    )


@query(
    f"""WITH m AS (SELECT max(user_id)::DOUBLE + 1 AS hi FROM events),
        t AS (SELECT event_type AS g, user_id::DOUBLE AS x, percent_rank() OVER (PARTITION BY event_type ORDER BY value) < 0.25 AS good FROM events),
        s AS (SELECT g, good, count(*)::DOUBLE AS n, greatest(stddev_pop(x) * pow(count(*), -0.2), 0.01 * any_value(hi)) AS w FROM t, m GROUP BY 1, 2),
        c AS (SELECT g, i AS candidate, {sql_uniform(5, 'g', 'i', "'user'")} * hi AS x FROM (SELECT DISTINCT g FROM t), range(0, 24) r(i), m),
        d AS (SELECT c.g, c.candidate, t.good, any_value(s.n) AS n, any_value(hi) AS hi,
                     sum(exp(-0.5 * ((c.x - t.x) / s.w) ** 2) / (s.w * sqrt(2 * pi()))) AS k
              FROM c JOIN t ON c.g = t.g JOIN s ON s.g = t.g AND s.good = t.good, m GROUP BY 1, 2, 3)
        SELECT g AS event_type, candidate, round(sum((CASE WHEN good THEN 1 ELSE -1 END) * ln((k + 1 / hi) / (n + 1))), 5) AS score
        FROM d GROUP BY 1, 2"""
)
def tpe_score(spark, folder):
    """Events as finished trials (setting: the user, metric: the value), 24 candidates per type."""
    events = table(spark, folder, "events")
    high = float(events.agg(F.max("user_id")).first()[0] + 1)
    space = {"user": draw_uniform(0.0, high)}
    finished = events.select("event_type", "value", F.create_map(F.lit("user"), F.col("user_id").cast("double")).alias("params"))
    groups = events.select("event_type").distinct()
    candidates = sample_trials(groups, space, 24, seed=5, out="candidate")
    scores = tpe_scores(finished, candidates, space, ["event_type"])
    return scores.select("event_type", F.col("candidate").cast("long").alias("candidate"), F.round("score", 5).alias("score"))


@query(
    """SELECT event_type, event_id, value FROM (SELECT *, percent_rank() OVER (PARTITION BY event_type ORDER BY value) AS r FROM events)
       WHERE r < 0.25"""
)
def halving_rung(spark, folder):
    rows = table(spark, folder, "events").select("event_type", "event_id", "value")
    return halving_cut(rows, "value", 4, ["event_type"])


def _orders(spark, folder):
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("y"),
        F.dayofweek(day).alias("dow"), F.dayofyear(day).alias("doy"), F.year(day).alias("year"),
        F.pmod("o_custkey", F.lit(100)).alias("segment"),
    )


_BASE = BoostParams("reg:squarederror", eval_metric="rmse", early_stopping_rounds=3)
_COLUMNS = ["dow", "doy", "year", "segment"]


@query()
def tune_groups(spark, folder):
    """Every order priority searches on its own, all at once; the best trial of each, and the model that its settings give on all rows."""
    keys = ["o_orderpriority"]
    found = tune(
        _orders(spark, folder), _COLUMNS, "y", _SPACE, 4, _BASE, held_out(["o_orderkey"]), keys,
        max_concurrent_trials=2, max_bin=32, refit=True,
    )
    best = found.best.select(*keys, "trial_id", "params", "value")
    return join_on(best, found.refitted.select(*keys, "model"), keys, "left")


@query()
def tune_global(spark, folder):
    """One search on the whole table with successive halving; all trials."""
    found = tune(
        _orders(spark, folder), _COLUMNS, "y", _SPACE, 4, _BASE, held_out(["o_orderkey"]), search="random", halving_eta=2, max_bin=32
    )
    return found.trials


@query()
def routed_trees(spark, folder):
    """A boosted model per order priority, each row predicted by the model of its group."""
    rows = _orders(spark, folder)
    params = BoostParams("reg:squarederror", eval_metric="rmse", num_estimators=2, max_depth=2)
    trained = boost_many(rows, _COLUMNS, "y", [params], ["o_orderpriority"], max_bin=32)
    best = best_trial(trained.models, ["o_orderpriority"], "value", "min")
    return route_predict(rows, best, ["o_orderpriority"], "o_orderkey", model_predict, _COLUMNS)


_STUMP = BoostParams("reg:squarederror", eval_metric="rmse", num_estimators=1, max_depth=1)
_RATES = {"learning_rate": draw_uniform(0.01, 0.3)}


def _stump_sql(name: str, rows: str) -> str:
    """Squared-error stumps of every order priority on the rows that ``rows`` selects, with the gradient sums left and right."""
    return f"""{name}_in AS (SELECT * FROM orders_in WHERE {rows}),
    {name}_cells AS (SELECT g, o_orderkey, y, i - 1 AS feature, [dow, doy, year, segment][i]::DOUBLE AS x FROM {name}_in, range(1, 5) t(i)),
    {name}_edges AS (SELECT g, feature, list_sort(list_distinct(quantile_cont(x, [{', '.join(f'{i}/{_BINS}' for i in range(1, _BINS))}]))) AS edges
                     FROM {name}_cells GROUP BY 1, 2),
    {name}_base AS (SELECT g, avg(y) AS base FROM {name}_in GROUP BY 1),
    {name}_hist AS (SELECT c.g, c.feature, len(list_filter(edges, lambda e: e <= x)) AS bin, sum(base - y) AS s, count(*)::DOUBLE AS h
                    FROM {name}_cells c JOIN {name}_edges e ON c.g = e.g AND c.feature = e.feature JOIN {name}_base b ON b.g = c.g GROUP BY 1, 2, 3),
    {name}_sums AS (SELECT *, sum(s) OVER w AS sl, sum(h) OVER w AS hl, sum(s) OVER p AS sa, sum(h) OVER p AS ha FROM {name}_hist
                    WINDOW w AS (PARTITION BY g, feature ORDER BY bin), p AS (PARTITION BY g, feature)),
    {name}_best AS (SELECT *, 0.5 * (sl * sl / (hl + 1) + (sa - sl) ** 2 / (ha - hl + 1) - sa * sa / (ha + 1)) AS gain FROM {name}_sums
                    WHERE hl >= 1 AND ha - hl >= 1 QUALIFY row_number() OVER (PARTITION BY g ORDER BY gain DESC, feature, bin) = 1),
    {name} AS (SELECT s.g, s.feature, list_extract(edges, s.bin + 1) AS edge, -sl / (hl + 1) AS l, -(sa - sl) / (ha - hl + 1) AS r, base
               FROM {name}_best s JOIN {name}_edges e ON s.g = e.g AND s.feature = e.feature JOIN {name}_base b ON b.g = s.g)"""


_STUMPS_SQL = f"""WITH orders_in AS (SELECT o_orderkey, o_orderpriority AS g, o_totalprice AS y, dayofweek(CAST(o_orderdate AS DATE)) + 1 AS dow,
        dayofyear(CAST(o_orderdate AS DATE)) AS doy, year(CAST(o_orderdate AS DATE)) AS year, o_custkey % 100 AS segment,
        {sql_uniform(42, 'o_orderkey')} < 0.25 AS held FROM orders),
    {_stump_sql('stumps', 'NOT held')},
    rates AS (SELECT g, t.i AS trial_id, 0.01 + {sql_uniform(0, 'g', 't.i', "'learning_rate'")} * (0.3 - 0.01) AS rate
              FROM (SELECT DISTINCT g FROM orders_in), range(0, 4) t(i)),
    trials AS (SELECT r.g, trial_id, any_value(rate) AS rate, sqrt(avg((base + rate * (CASE WHEN [dow, doy, year, segment][s.feature + 1] < edge THEN s.l ELSE s.r END) - y) ** 2)) AS value
               FROM rates r JOIN stumps s ON s.g = r.g JOIN orders_in o ON o.g = r.g AND held GROUP BY 1, 2),
    best AS (SELECT * FROM trials QUALIFY row_number() OVER (PARTITION BY g ORDER BY value, trial_id) = 1)"""


def _tuned_stumps(spark, folder, **how):
    return tune(
        _orders(spark, folder), _COLUMNS, "y", _RATES, 4, _STUMP, held_out(["o_orderkey"]), ["o_orderpriority"],
        search="random", max_bin=_BINS, exact_bins=True, **how,
    )


_TUNED = "SELECT g AS o_orderpriority, trial_id::INTEGER AS trial_id, round(rate, 8) AS rate, round(value, 2) AS value FROM best"


def _picked(found):
    rate = F.round(F.col("params")["learning_rate"], 8)
    return found.best.select("o_orderpriority", F.col("trial_id").cast("int").alias("trial_id"), rate.alias("rate"), F.round("value", 2).alias("value"))


@query(f"{_STUMPS_SQL} {_TUNED}")
def tune_stumps(spark, folder):
    """Every order priority searches its learning rate, each group whole in a task."""
    return _picked(_tuned_stumps(spark, folder))


@query(
    f"""{_STUMPS_SQL.replace("o_orderpriority AS g", "0 AS g", 1)}
    SELECT trial_id::INTEGER AS trial_id, round(rate, 8) AS rate, round(value, 2) AS value FROM trials"""
)
def tune_concurrent_stumps(spark, folder):
    """One search on the whole table with two trials at work at a time; all trials."""
    found = tune_concurrent(
        _orders(spark, folder), _COLUMNS, "y", _RATES, 4, _STUMP, held_out(["o_orderkey"]), max_concurrent_trials=2, max_bin=_BINS, exact_bins=True
    )
    return found.trials.select("trial_id", F.round(F.col("params")["learning_rate"], 8).alias("rate"), F.round("value", 2).alias("value"))


def _rung_sql(name: str, rung: int, before: str) -> str:
    """Reports of a rung by trials that go on from the one before, with the earlier reports of the same type and rung."""
    return f"""{name}_in AS (SELECT l.* FROM log l {before} WHERE l.rung = {rung}),
    {name} AS (SELECT a.event_type, a.event_id, a.rung, count(b.event_id) + 1 AS seen, count(b.event_id) FILTER (b.metric < a.metric) AS better
               FROM {name}_in a LEFT JOIN {name}_in b ON b.event_type = a.event_type AND b.event_id < a.event_id GROUP BY 1, 2, 3)"""


@query(
    f"""WITH log AS (SELECT event_type, event_id, 0 AS rung, value AS metric FROM events WHERE value IS NOT NULL
                     UNION ALL SELECT event_type, event_id, 1, value * (user_id % 7) FROM events WHERE value IS NOT NULL),
    {_rung_sql("first_", 0, "")},
    {_rung_sql("second_", 1, "JOIN first_ f ON f.event_type = l.event_type AND f.event_id = l.event_id AND f.better * 4 < f.seen")}
    SELECT event_type, event_id, rung, seen, better, better * 4 < seen AS goes_on FROM (SELECT * FROM first_ UNION ALL SELECT * FROM second_)"""
)
def async_halving(spark, folder):
    """Events as reports at two rungs, in the order of their ids; a search per type."""
    events = table(spark, folder, "events").where("value IS NOT NULL")
    report = lambda rung, metric: events.select("event_type", "event_id", F.lit(rung).alias("rung"), metric.alias("metric"))
    log = report(0, F.col("value")).unionByName(report(1, F.col("value") * (F.col("user_id") % 7)))
    found = replay_async(log, ["event_type"], 4, "min", "metric", "event_id", "rung", "event_id")
    return found.select("event_type", "event_id", "rung", "seen", "better", "goes_on")


@query(f"{_STUMPS_SQL} {_TUNED}")
def tune_stumps_by_levels(spark, folder):
    """The same search with every group in level jobs."""
    return _picked(_tuned_stumps(spark, folder, small_rows=0))


@query(
    f"""{_STUMPS_SQL}, {_stump_sql('whole', 'true')}
    SELECT w.g AS o_orderpriority, count(*) AS n,
           round(avg(base + rate * (CASE WHEN [dow, doy, year, segment][w.feature + 1] < edge THEN w.l ELSE w.r END)), 4) AS mean
    FROM whole w JOIN best b ON w.g = b.g JOIN orders_in o ON o.g = w.g GROUP BY 1"""
)
def routed_stumps(spark, folder):
    """A search with refit, logged and stored; every order predicted by the stored model that the artifact map names."""
    rows, keys = _orders(spark, folder), ["o_orderpriority"]
    found = _tuned_stumps(spark, folder, refit=True)
    models = temporary_table(spark, "models")
    best = found.refitted.join(found.best.select(*keys, "value"), keys)
    artifacts = log_search(found.trials, best, keys, "stumps", uuid.uuid4().hex, temporary_table(spark, "runs"), models)
    predicted = route_by_artifacts(rows, artifacts, models, keys, "o_orderkey", model_predict, _COLUMNS)
    joined = rows.select("o_orderkey", *keys).join(predicted, "o_orderkey")
    return joined.groupBy(*keys).agg(F.count("*").alias("n"), F.round(F.avg("prediction"), 4).alias("mean"))

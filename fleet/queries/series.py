"""Forecasts, calendars, histories, metrics and grouped functions."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

from fleet.functions import metrics
from fleet.functions.draws import integer_between, loguniform_between, uniform, uniform_between
from fleet.operators.groups import batch_map, expand_rows, grouped_fold, grouped_map, grouped_stream, pair_trials, route_predict
from fleet.operators.history import best_trial, early_stop, last_rows, latest_per_name
from fleet.operators.scans import exact_percentiles, global_ordinal
from fleet.operators.series import future_frame, weekly_sums
from fleet.plans.forecast import forecast_groups, forecast_linear_seasonal
from fleet.plans.runs import search_runs
from fleet.plans.synth import with_series_target, with_wide_features
from fleet.queries.registry import query, sql_uniform, table
from fleet.sources.tables import query_vectors, scan_batches

_LINE_SQL = """
WITH daily AS (SELECT l_returnflag AS g, CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS y FROM lineitem GROUP BY 1, 2),
pts AS (SELECT g, d, y, date_diff('day', DATE '1995-01-01', d) AS x, dayofweek(d) AS w FROM daily),
line AS (SELECT g, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, max(d) AS last FROM pts GROUP BY g),
week AS (SELECT pts.g, w, avg(y - (a + b * x)) AS r FROM pts JOIN line ON pts.g = line.g GROUP BY 1, 2),
ahead AS (SELECT g, a, b, CAST(last + CAST(i AS INTEGER) AS DATE) AS ds FROM line, range(1, 15) t(i))
SELECT ahead.g AS l_returnflag, ds, round(a + b * date_diff('day', DATE '1995-01-01', ds), 4) AS trend,
       round(a + b * date_diff('day', DATE '1995-01-01', ds) + coalesce(r, 0), 4) AS yhat
FROM ahead LEFT JOIN week ON ahead.g = week.g AND dayofweek(ds) = week.w
"""


@query(_LINE_SQL)
def forecast_daily_sales(spark, folder):
    lines = table(spark, folder, "lineitem")
    found = forecast_linear_seasonal(lines, ["l_returnflag"], "l_shipdate", "l_quantity")
    return found.select("l_returnflag", "ds", F.round("trend", 4).alias("trend"), F.round("yhat", 4).alias("yhat"))


@query(
    _LINE_SQL.replace("l_returnflag AS g", "(l_suppkey, l_returnflag) AS g").replace(
        "ahead.g AS l_returnflag", "ahead.g[1] AS l_suppkey, ahead.g[2] AS l_returnflag"
    )
)
def forecast_store_items(spark, folder):
    """The closed form for every pair of two keys."""
    keys = ["l_suppkey", "l_returnflag"]
    found = forecast_linear_seasonal(table(spark, folder, "lineitem"), keys, "l_shipdate", "l_quantity")
    return found.select(*keys, "ds", F.round("trend", 4).alias("trend"), F.round("yhat", 4).alias("yhat"))


@query()
def forecast_many_models(spark, folder):
    """An additive model for every supplier."""
    lines = table(spark, folder, "lineitem")
    daily = lines.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("ds")).agg(F.sum("l_quantity").alias("y"))
    return forecast_groups(daily, ["l_suppkey"], "ds", "y").drop("error")


@query()
def forecast_additive(spark, folder):
    orders = table(spark, folder, "orders")
    daily = orders.groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias("ds")).agg(
        F.sum("o_totalprice").alias("y")
    )
    return forecast_groups(daily, ["o_orderpriority"], "ds", "y").drop("error")


@query(
    """WITH w AS (SELECT o_orderpriority AS g, CAST(o_orderdate AS DATE) + CAST((7 - dayofweek(o_orderdate)) % 7 AS INTEGER) AS week,
                        o_totalprice AS y FROM orders),
       s AS (SELECT g, CAST(week AS DATE) AS week, sum(y) AS y FROM w GROUP BY 1, 2),
       c AS (SELECT g, CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM s GROUP BY g)
       SELECT c.g AS o_orderpriority, c.week, round(coalesce(y, 0), 2) AS total FROM c LEFT JOIN s ON c.g = s.g AND c.week = s.week"""
)
def weekly_resample(spark, folder):
    weeks = weekly_sums(table(spark, folder, "orders"), ["o_orderpriority"], "o_orderdate", "o_totalprice")
    return weeks.withColumn("total", F.round("total", 2))


@query(
    """WITH m AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last FROM orders GROUP BY 1)
       SELECT o_custkey, CAST(last + CAST(i AS INTEGER) AS DATE) AS ds FROM m, range(1, 15) t(i)"""
)
def date_series(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("ds"))
    return future_frame(orders, ["o_custkey"], "ds", 14)


@query(
    """SELECT event_type, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 14"""
)
def horizon_tail(spark, folder):
    rows = table(spark, folder, "events").select("event_type", "event_id", "ts", "value")
    return last_rows(rows, ["event_type"], [F.col("ts").desc(), F.col("event_id").desc()], 14).drop("ts")


@query(
    """SELECT user_id, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def latest_run(spark, folder):
    rows = table(spark, folder, "events").select("user_id", "event_id", "ts", "value")
    return latest_per_name(rows, "user_id", "ts", "event_id").drop("ts")


@query(
    """SELECT event_type AS run_name, event_id AS run_id FROM events
       WHERE event_type LIKE 'p%' AND json_extract_string(props, '$.k') = '69'"""
)
def run_search(spark, folder):
    runs = table(spark, folder, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("run_name"),
        F.col("ts").alias("start_time"),
        F.from_json("props", "map<string,string>").alias("tags"),
    )
    return search_runs(runs, name_prefix="p", tags={"k": "69"}).select("run_name", "run_id")


@query(
    """WITH h AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS r FROM events),
       b AS (SELECT *, min(struct_pack(v := value, r := r)) OVER (PARTITION BY user_id ORDER BY r) AS m FROM h),
       s AS (SELECT user_id, coalesce(min(r) FILTER (r - m.r >= 20), max(r)) AS stop_round FROM b GROUP BY 1)
       SELECT b.user_id, b.m.r AS best_round, b.m.v AS best, s.stop_round, b.value AS last
       FROM b JOIN s ON b.user_id = s.user_id AND b.r = s.stop_round"""
)
def early_stop_round(spark, folder):
    rows = table(spark, folder, "events").select("user_id", "event_id", "ts", "value")
    rounds = global_ordinal(rows, ["ts", "event_id"], "round", by=["user_id"]).select("user_id", "round", "value")
    return early_stop(rounds, ["user_id"], "round", "value", 20)


@query(
    """SELECT event_type, event_id AS trial_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) = 1"""
)
def best_trials(spark, folder):
    trials = table(spark, folder, "events").select("event_type", F.col("event_id").alias("trial_id"), "value")
    return best_trial(trials, ["event_type"], "value", "min")


_SCORE = "1.0 / (1.0 + exp(-(n_chars - 800.0) / 400.0))"


@query(
    f"""WITH s AS (SELECT source, quality AS y, {_SCORE} AS p FROM documents JOIN labels USING (doc_id))
        SELECT source, count(*) AS n, round(avg(-ln(greatest(CASE WHEN y = 1 THEN p ELSE 1 - p END, 1e-15))), 6) AS log_loss,
               round(avg(CASE WHEN (p >= 0.5)::INT = y THEN 1.0 ELSE 0.0 END::DOUBLE), 6) AS accuracy,
               round(avg(CASE WHEN (p >= 0.5)::INT <> y THEN 1.0 ELSE 0.0 END::DOUBLE), 6) AS error
        FROM s GROUP BY source"""
)
def classification_metrics(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    scored = documents.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id").select(
        "source", F.col("quality").alias("y"), F.expr(_SCORE.replace("1.0", "1.0D").replace("00.0", "00.0D")).alias("p")
    )
    chosen = (F.col("p") >= 0.5).cast("int")
    of_label = F.when(F.col("y") == 1, F.col("p")).otherwise(1 - F.col("p"))
    return scored.groupBy("source").agg(
        F.count("*").alias("n"),
        F.round(metrics.log_loss(of_label), 6).alias("log_loss"),
        F.round(metrics.accuracy(chosen, F.col("y")), 6).alias("accuracy"),
        F.round(metrics.error_rate(chosen, F.col("y")), 6).alias("error"),
    )


@query(
    """WITH s AS (SELECT p_brand, p_retailprice AS y, 900.0::DOUBLE + p_size * 10.0::DOUBLE AS p FROM part)
       SELECT p_brand, round(sqrt(avg((y - p) ** 2)), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
              round(sqrt(avg((ln(1 + y) - ln(1 + p)) ** 2)), 6) AS rmsle FROM s GROUP BY p_brand"""
)
def regression_metrics(spark, folder):
    y, p = F.col("p_retailprice"), F.lit(900.0) + F.col("p_size") * F.lit(10.0)
    return table(spark, folder, "part").groupBy("p_brand").agg(
        F.round(metrics.rmse(p, y), 6).alias("rmse"),
        F.round(metrics.mae(p, y), 6).alias("mae"),
        F.round(metrics.rmsle(p, y), 6).alias("rmsle"),
    )


@query(
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.01), 6) AS p1,
              round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem GROUP BY 1"""
)
def percentile_bounds(spark, folder):
    bounds = exact_percentiles(table(spark, folder, "lineitem"), "l_extendedprice", [0.01, 0.99], ["l_returnflag"])
    low, high = F.col("percentiles")[0], F.col("percentiles")[1]
    return bounds.select("l_returnflag", F.round(low, 6).alias("p1"), F.round(high, 6).alias("p99"))


def _count_and_sum(pdf: pd.DataFrame) -> pd.DataFrame:
    out = pdf.groupby("l_returnflag", as_index=False)["l_quantity"].agg(["count", "sum"])
    return out.rename(columns={"count": "n", "sum": "total"})


@query("SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1")
def grouped_fold_stats(spark, folder):
    lines = table(spark, folder, "lineitem")
    merge = [F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total")]
    stats = grouped_fold(
        lines, ["l_returnflag"], _count_and_sum, "l_returnflag string, n long, total double", merge,
        spread=["l_orderkey", "l_linenumber", "l_partkey"], columns=["l_returnflag", "l_quantity"],
    )
    return stats.drop("error")


def _order_span(pdf: pd.DataFrame) -> pd.DataFrame:
    out = pdf.groupby("o_custkey", as_index=False, dropna=False)["o_totalprice"].agg(n="size", most="max", least="min")
    return out.assign(spread=out["most"] - out["least"])


@query(
    """SELECT o_custkey, count(*) AS n, round(max(o_totalprice) - min(o_totalprice), 2) AS spread FROM orders GROUP BY 1"""
)
def grouped_map_stats(spark, folder):
    orders = table(spark, folder, "orders")
    stats = grouped_map(
        orders, ["o_custkey"], _order_span, "o_custkey long, n long, spread double", ["o_totalprice"], rows_per_call=10_000,
    )
    return stats.select("o_custkey", "n", F.round("spread", 2).alias("spread"))


@query("SELECT count(*) AS n, true AS within_limit FROM lineitem")
def batch_scan(spark, folder):
    sizes = scan_batches(spark, f"{folder}/lineitem.parquet", "l_orderkey long, l_quantity double", 4096)
    return sizes.agg(F.sum("rows").alias("n"), F.bool_and(F.col("rows") <= 4096).alias("within_limit"))


def _scale_build(factor: float):
    import pyarrow as pa
    import pyarrow.compute as pc

    def call(batch: pa.RecordBatch) -> pa.RecordBatch:
        scaled = pc.multiply(batch.column("o_totalprice"), factor)
        return pa.RecordBatch.from_arrays([batch.column("o_orderkey"), scaled], ["o_orderkey", "scaled"])

    return call


@query("SELECT o_orderkey, o_totalprice * 0.5 AS scaled FROM orders")
def batch_map_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return batch_map(orders, _scale_build, "o_orderkey long, scaled double", (0.5,), batch_size=250)


@query("SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS n, CAST(sum(p_size * (p_size - 1) // 2) AS BIGINT) AS total FROM part GROUP BY 1")
def generated_rows(spark, folder):
    rows = expand_rows(table(spark, folder, "part").select("p_brand", "p_size"), F.col("p_size"))
    return rows.groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("n").alias("total"))


@query(
    f"""SELECT user_id AS trial_id, round(0.01 + {sql_uniform(1, 'user_id', "'learning_rate'")} * (0.3 - 0.01), 8) AS learning_rate,
              round(exp(ln(1e-4) + {sql_uniform(1, 'user_id', "'lr'")} * (ln(1e-2) - ln(1e-4))), 8) AS lr,
              100 + CAST(floor({sql_uniform(1, 'user_id', "'num_estimators'")} * 900) AS BIGINT) AS num_estimators
        FROM (SELECT DISTINCT user_id FROM events)"""
)
def random_draws(spark, folder):
    trials = table(spark, folder, "events").select(F.col("user_id").alias("trial_id")).distinct()
    draw = lambda name: uniform(1, "trial_id", F.lit(name))
    return trials.select(
        "trial_id",
        F.round(uniform_between(0.01, 0.3, draw("learning_rate")), 8).alias("learning_rate"),
        F.round(loguniform_between(1e-4, 1e-2, draw("lr")), 8).alias("lr"),
        integer_between(100, 1000, draw("num_estimators")).alias("num_estimators"),
    )


_TWO_PI = "6.283185307179586"


def _sql_normal(i: int) -> str:
    keys = ("l_orderkey", "l_linenumber", "l_partkey", f"'x{i}'")
    a, b = sql_uniform(0, *keys), sql_uniform(0, *keys, start=14)
    return f"sqrt(-2.0 * ln(1.0 - {a})) * cos({_TWO_PI} * {b})"


@query(
    f"""SELECT group_name, count(*) AS n, CAST(sum(y) AS BIGINT) AS y, round(sum(x0), 4) AS x0 FROM
        (SELECT l_shipmode AS group_name, x0, CAST(trunc({sql_uniform(0, 'l_shipmode', "'c0'")} * 100.0 * x0
              + {sql_uniform(0, 'l_shipmode', "'c1'")} * 100.0 * x1) AS INTEGER) AS y FROM
         (SELECT l_returnflag || l_linestatus AS l_shipmode, {_sql_normal(0)} AS x0, {_sql_normal(1)} AS x1 FROM lineitem))
        GROUP BY 1""".replace("round(sum(x0), 4)", "round(sum(CAST(CAST(x0 AS FLOAT) AS DOUBLE)), 4)")
)
def synth_series_rows(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("group_name"), "l_orderkey", "l_linenumber", "l_partkey"
    )
    made = with_series_target(lines, "group_name", ["l_orderkey", "l_linenumber", "l_partkey"])
    return made.groupBy("group_name").agg(
        F.count("*").alias("n"), F.sum("y").alias("y"), F.round(F.sum(F.col("features_0").cast("double")), 4).alias("x0")
    )


@query(
    f"""SELECT o_orderkey AS id, 'group_' || (o_orderkey % 4) AS group_id,
              CAST(CAST({sql_uniform(0, 'o_orderkey', '0')} AS FLOAT) AS DOUBLE) AS r_0,
              CAST(CAST({sql_uniform(0, 'o_orderkey', '1')} AS FLOAT) AS DOUBLE) AS r_1,
              CAST(floor({sql_uniform(0, 'o_orderkey', "'label'")} * 5) AS INTEGER) AS target FROM orders"""
)
def synth_wide_rows(spark, folder):
    made = with_wide_features(table(spark, folder, "orders"), "o_orderkey", 2, 5, groups=4)
    return made.withColumn("r_0", F.col("r_0").cast("double")).withColumn("r_1", F.col("r_1").cast("double"))


@query(
    f"""SELECT s_suppkey AS query_id, CAST(i AS BIGINT) AS pos, CAST(floor({sql_uniform(7, 's_suppkey', 'i')} * 256) AS DOUBLE) AS value
        FROM supplier, range(0, 35) t(i)"""
)
def random_query_vectors(spark, folder):
    made = query_vectors(table(spark, folder, "supplier"), "s_suppkey", 35)
    cells = made.select("query_id", F.posexplode("query").alias("pos", "value"))
    return cells.select("query_id", F.col("pos").cast("long").alias("pos"), F.col("value").cast("double").alias("value"))


@query("SELECT o_orderpriority, t.i AS trial_id FROM (SELECT DISTINCT o_orderpriority FROM orders), range(0, 16) t(i)")
def trial_pairs(spark, folder):
    groups = table(spark, folder, "orders").select("o_orderpriority").distinct()
    return pair_trials(groups, [{"trial_id": i} for i in range(16)]).withColumn("trial_id", F.col("trial_id").cast("long"))


def _stream_stats(frames):
    n, total, most = 0, 0.0, -math.inf
    for pdf in frames:
        n, total, most = n + len(pdf), total + pdf["l_quantity"].sum(), max(most, pdf["l_extendedprice"].max())
    yield pd.DataFrame({"l_linestatus": [pdf["l_linestatus"].iloc[0]], "n": [n], "total": [total], "most": [most]})


@query("SELECT l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS total, max(l_extendedprice) AS most, NULL::VARCHAR AS error FROM lineitem GROUP BY 1")
def grouped_stream_stats(spark, folder):
    """Two groups that hold about half of the rows each, in streams of their parts that are merged."""
    merge = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most")]
    found = grouped_stream(
        table(spark, folder, "lineitem"), ["l_linestatus"], _stream_stats, "l_linestatus string, n long, total double, most double",
        columns=["l_quantity", "l_extendedprice"], merge=merge,
    )
    return found.withColumn("total", F.round("total", 2))


def _line_predict(model: str, features: pd.DataFrame) -> pd.Series:
    a, b = (float(v) for v in model.split(","))
    return a + b * features["l_quantity"]


@query(
    """WITH m AS (SELECT l_returnflag AS f, l_linestatus AS s, round(regr_slope(l_extendedprice, l_quantity), 6) AS b,
                         round(regr_intercept(l_extendedprice, l_quantity), 6) AS a
                  FROM lineitem GROUP BY 1, 2)
       SELECT l_orderkey, l_returnflag, l_linestatus, round(a + b * l_quantity, 3) AS prediction
       FROM lineitem LEFT JOIN m ON f = l_returnflag AND s = l_linestatus AND s <> 'O'"""
)
def routed_predict(spark, folder):
    lines = table(spark, folder, "lineitem")
    groups = ["l_returnflag", "l_linestatus"]
    fitted = lines.groupBy(*groups).agg(
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 6).alias("a"),
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("b"),
    )
    models = fitted.where("l_linestatus <> 'O'").select(*groups, F.concat_ws(",", F.col("a").cast("string"), F.col("b").cast("string")).alias("model"))
    routed = route_predict(lines, models, groups, "l_orderkey", _line_predict, ["l_quantity"])
    return routed.withColumn("prediction", F.round("prediction", 3))

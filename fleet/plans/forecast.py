"""One forecasting model per group: a closed form in plain expressions, and an additive model.

Both reduce the rows to sufficient statistics before anything is fitted, so the
size of a group does not matter: a group that holds a third of the table is spread
over as many tasks as its rows ask for.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fleet.operators.groups import grouped_map
from fleet.operators.keys import ROWS_PER_BLOCK, join_on
from fleet.operators.series import future_frame
from fleet.plans.sketch import key_places
from fleet.scratch import Scratch

HORIZON = 14
#: Rows of whole small groups that are passed to Python at once; a call costs more than a fit.
ROWS_PER_CALL = 20_000


def forecast_linear_seasonal(
    df: DataFrame, by: list[str], ds: str, y: str, horizon: int = HORIZON, origin: str = "1995-01-01"
) -> DataFrame:
    """Straight line over daily sums plus the mean residual of each weekday, ``horizon`` days ahead.

    Days are reduced to seven rows of moments per group, from which both the line
    and the weekday effects follow; no join and no second pass over the data.
    """
    day = F.col(ds).cast("date")
    daily = df.groupBy(*by, day.alias("_day")).agg(F.sum(y).alias("_y"))
    x = F.datediff("_day", F.lit(origin).cast("date")).cast("double")
    points = daily.select(*by, "_day", "_y", x.alias("_x"), (F.dayofweek("_day") - 1).alias("_dow"))
    weekdays = points.groupBy(*by, "_dow").agg(
        F.count("_y").alias("_n"),
        F.sum("_x").alias("_sx"),
        F.sum("_y").alias("_sy"),
        F.sum(F.col("_x") * F.col("_x")).alias("_sxx"),
        F.sum(F.col("_x") * F.col("_y")).alias("_sxy"),
        F.max("_day").alias("_last"),
    )
    means = F.struct((F.col("_sx") / F.col("_n")).alias("x"), (F.col("_sy") / F.col("_n")).alias("y"))
    groups = weekdays.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("_n", "_sx", "_sy", "_sxx", "_sxy")],
        F.max("_last").alias("_last"),
        F.map_from_entries(F.collect_list(F.struct("_dow", means))).alias("_week"),
    )
    n, sx, sy, sxx, sxy = (F.col(c) for c in ("_n", "_sx", "_sy", "_sxx", "_sxy"))
    slope = F.try_divide(n * sxy - sx * sy, n * sxx - sx * sx)
    lines = groups.withColumn("_b", slope).withColumn("_a", (sy - F.col("_b") * sx) / n)
    steps = F.expr(f"sequence(date_add(_last, 1), date_add(_last, {int(horizon)}))")
    future = lines.withColumn("ds", F.explode(steps))
    ahead = F.datediff("ds", F.lit(origin).cast("date")).cast("double")
    mean = F.try_element_at("_week", F.dayofweek("ds") - 1)
    trend = F.col("_a") + F.col("_b") * ahead
    season = mean["y"] - (F.col("_a") + F.col("_b") * mean["x"])
    return future.select(*by, "ds", trend.alias("trend"), (trend + F.coalesce(season, F.lit(0.0))).alias("yhat"))


# Fixed values of the additive model: changepoints over the first part of the history,
# and (period in days, number of sine and cosine pairs) of each seasonality.
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
YEARLY = (365.25, 10)
WEEKLY = (7.0, 3)
DAILY = (1.0, 4)
CHANGEPOINT_SCALE = 0.05
SEASON_SCALE = 10.0
TREND_SCALE = 5.0
INTERVAL_Z = 1.2815515594600038  # 80 % interval

_SEASONS = (YEARLY, WEEKLY, DAILY)
_TREND = 2 + CHANGEPOINTS
_WIDTH = _TREND + 2 * sum(order for _, order in _SEASONS)
#: History in days from which the yearly and the weekly terms are used; the daily ones always are.
LEAST_HISTORY = (730.0, 14.0, 0.0)
#: A seasonal column that varies less than this over a group's times is part of its level.
LEAST_VARIATION = 1e-6


def _angles() -> list[float]:
    """Angle per day of each pair of seasonal columns, in the order of the design's columns."""
    return [2.0 * np.pi / period * k for period, order in _SEASONS for k in range(1, order + 1)]


def _active(row: dict, history: tuple[float, float, float]) -> np.ndarray:
    """Which columns of the design a group uses, from the ranges of its seasonal columns."""
    span, at, flags = row["_last"] - row["_first"], 0, [np.ones(_TREND)]
    for (_, order), least in zip(_SEASONS, history):
        pairs = range(at, at + order)
        for wave in ("s", "c"):
            flags.append(np.array([float(span >= least and row[f"_{wave}{i}"] > LEAST_VARIATION) for i in pairs]))
        at += order
    return np.concatenate(flags)


def _design(days: np.ndarray, first: float, last: float, active: np.ndarray | None = None) -> np.ndarray:
    """Design matrix at times given in days: level, slope, slope changes, Fourier terms; zero where not active."""
    span = max(last - first, 1e-9)
    t = (days - first) / span
    knots = np.linspace(0.0, CHANGEPOINT_RANGE, CHANGEPOINTS + 1)[1:]
    blocks = [np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - knots, 0.0)]
    for period, order in _SEASONS:
        angle = 2.0 * np.pi * days[:, None] / period * np.arange(1, order + 1)
        blocks += [np.sin(angle), np.cos(angle)]
    return np.hstack(blocks) if active is None else np.hstack(blocks) * active


def _penalty() -> np.ndarray:
    scales = [TREND_SCALE] * 2 + [CHANGEPOINT_SCALE] * CHANGEPOINTS
    scales += [SEASON_SCALE] * (_WIDTH - len(scales))
    return 1.0 / np.square(scales)


def _columns_in(mask: int) -> np.ndarray:
    """The flags of the design's columns from their bits."""
    return (int(mask) >> np.arange(_WIDTH) & 1).astype(float)


def _moments(times: tuple[np.ndarray, ...], first: float, last: float, scale: float, mask: int) -> np.ndarray:
    """X'WX, X'Wy, y'Wy and the weight of distinct times with counts, as one vector."""
    t, n, sy, syy = (np.asarray(x, float) for x in times)
    x = _design(t, first, last, _columns_in(mask))
    return np.concatenate([(x.T @ (x * n[:, None])).ravel(), x.T @ (sy / scale), [(syy / scale**2).sum(), n.sum()]])


def _solve(moments: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients by penalised least squares and the residual deviation, in scaled units."""
    gram = moments[: _WIDTH * _WIDTH].reshape(_WIDTH, _WIDTH)
    xy, (yy, n) = moments[_WIDTH * _WIDTH : -2], moments[-2:]
    noise = 0.01
    for _ in range(3):
        beta = np.linalg.solve(gram + np.diag(noise * _penalty() + 1e-9), xy)
        noise = max((yy - 2 * beta @ xy + beta @ gram @ beta) / max(n, 1.0), 1e-9)
    return beta, float(np.sqrt(noise))


def fit_groups(
    df: DataFrame, by: list[str], ds: str, y: str, rows_per_block: int = ROWS_PER_BLOCK,
    least_history: tuple[float, float, float] = LEAST_HISTORY,
) -> DataFrame:
    """Additive model of every group as a table: keys, time span, ``active`` columns, ``beta``, ``sigma``, ``error``.

    ``least_history`` gives the days of history from which yearly, weekly and daily terms
    are used. Seasonal columns that are constant on the times of a group (daily terms of
    daily data) are left out, so that they cannot take a share of the level.

    Rows are first reduced to one per group and time. Small groups are then fitted
    whole, some of them in each call; of larger ones each block of times gives its normal equations,
    which Spark adds up before they are solved.
    """
    rows = df.where(F.col(y).isNotNull() & F.col(ds).isNotNull())
    # Seconds of the wall clock, whatever the session zone.
    stamp = F.col(ds).cast("timestamp_ntz")
    seconds = F.datediff(stamp.cast("date"), F.lit("1970-01-01").cast("date")) * F.lit(86400.0)
    seconds = seconds + F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.extract(F.lit("second"), stamp).cast("double")
    value = F.col(y).cast("double")
    times = rows.groupBy(*by, (seconds / 86400.0).alias("_t")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_sy"), F.sum(value * value).alias("_syy"),
        F.max(F.abs(value)).alias("_top"),
    )
    scratch = Scratch(df.sparkSession)
    times = scratch.store(times, "times")
    spans = times.groupBy(*by).agg(
        F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.greatest(F.max("_top"), F.lit(1e-9)).alias("_scale"),
        F.ceil(F.count(F.lit(1)) / rows_per_block).cast("int").alias("_blocks"),
        *[
            (F.max(wave(F.col("_t") * angle)) - F.min(wave(F.col("_t") * angle))).alias(f"_{name}{i}")
            for i, angle in enumerate(_angles()) for name, wave in (("s", F.sin), ("c", F.cos))
        ],
    )
    spans = scratch.store(_with_active(spans, by, least_history), "spans")
    # The flags go to the rows as the bits of one number: an array in every row costs more than the fit.
    bits = F.aggregate("_active", F.lit(0).cast("long"), lambda mask, flag: F.shiftleft(mask, 1) + flag.cast("long"))
    masked = spans.withColumn("_active", F.reverse("_active")).withColumn("_mask", bits).drop("_active")
    placed = join_on(times.drop("_top"), masked, by)

    names = [f.name for f in df.select(*by).schema]
    key_fields = df.select(*by).schema.fields
    model_schema = T.StructType([*key_fields, *T.StructType.fromDDL(
        "first double, last double, scale double, active array<double>, sigma double, beta array<double>, error string"
    ).fields])

    def finish(key: tuple, first: float, last: float, scale: float, mask: int, moments: np.ndarray) -> dict:
        row = dict(zip(names, key), first=first, last=last, scale=scale, active=list(_columns_in(mask)))
        try:
            beta, sigma = _solve(moments)
            row.update(sigma=sigma * scale, beta=list(beta * scale), error=None)
        except Exception as failure:
            row.update(sigma=None, beta=None, error=str(failure))
        return row

    def whole(rows: pa.Table) -> pa.Table:
        numbers = {c: rows[c].to_numpy() for c in (*_TIMES, *_SPAN)}
        keys, found, first = [rows[k].combine_chunks() for k in by], [], []
        for _, at in key_places(keys, rows.num_rows):
            span = [numbers[c][at[0]] for c in _SPAN]
            found.append(finish((), *span, _moments(tuple(numbers[c][at] for c in _TIMES), *span)))
            first.append(at[0])
        rest = [pa.array([row[f.name] for row in found], _ARROW[f.dataType.simpleString()]) for f in model_schema.fields[len(names) :]]
        return pa.Table.from_arrays([*(k.take(pa.array(first)) for k in keys), *rest], names=model_schema.names)

    def block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        span = list(pdf[_SPAN].iloc[0])
        parts = _moments(tuple(pdf[c] for c in _TIMES), *span)
        out = pd.DataFrame({"_pos": np.arange(len(parts)), "_part": parts})
        for name, value in zip([*names, *_SPAN], [*key[: len(names)], *span]):
            out[name] = [value] * len(out)
        return out[[*names, *_SPAN, "_pos", "_part"]]

    def merged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("_pos")
        return pd.DataFrame([finish(key, *pdf[_SPAN].iloc[0], ordered["_part"].to_numpy(float))], columns=model_schema.names)

    calls = max(1, -(-times.count() // ROWS_PER_CALL))
    small = placed.where(F.col("_blocks") == 1).withColumn("_call", F.pmod(F.xxhash64(*by), F.lit(calls)))
    small = small.groupBy("_call").applyInArrow(whole, model_schema)
    large = placed.where(F.col("_blocks") > 1).withColumn("_block", F.pmod(F.xxhash64("_t"), F.col("_blocks")))
    part_schema = T.StructType([*key_fields, *T.StructType.fromDDL(
        "_first double, _last double, _scale double, _mask long, _pos int, _part double"
    ).fields])
    parts = large.repartition(*by, "_block").groupBy(*by, "_block").applyInPandas(block, part_schema)
    sums = parts.groupBy(*by, *_SPAN, "_pos").agg(F.sum("_part").alias("_part"))
    return small.unionByName(sums.groupBy(*by).applyInPandas(merged, model_schema))


_SPAN = ["_first", "_last", "_scale", "_mask"]
_TIMES = ["_t", "_n", "_sy", "_syy"]
_ARROW = {"double": pa.float64(), "array<double>": pa.list_(pa.float64()), "string": pa.string()}


def _with_active(spans: DataFrame, by: list[str], history: tuple[float, float, float]) -> DataFrame:
    """Replace the ranges of seasonal columns by the flags of the columns in use."""
    names = [f"_{w}{i}" for i in range(len(_angles())) for w in ("s", "c")]
    flags = F.pandas_udf(
        lambda pdf: pd.Series([list(_active(row, history)) for row in pdf.to_dict("records")], dtype=object), "array<double>",
    )
    return spans.withColumn("_active", flags(F.struct("_first", "_last", *names))).drop(*names)


def _trend_variance(days: np.ndarray, first: float, last: float, beta: np.ndarray) -> np.ndarray:
    """Variance of the trend after the history, if its slope goes on to change as often and as much as within.

    Changes come at a constant rate with Laplace sizes of the mean size seen; one at time u
    moves the trend at time t by its size times (t - u), which integrates to the cube.
    """
    ahead = np.maximum(days - last, 0.0) / max(last - first, 1e-9)
    size = np.abs(beta[2:_TREND]).mean()
    return CHANGEPOINTS * 2.0 * size**2 * ahead**3 / 3.0


def predict_groups(models: DataFrame, future: DataFrame, by: list[str], ds: str) -> DataFrame:
    """Evaluate the models at the times of ``future``: keys, ds, trend, yhat and its interval."""
    out = T.StructType([*future.select(*by, ds).schema.fields, *T.StructType.fromDDL(
        "trend double, yhat double, yhat_lower double, yhat_upper double, error string"
    ).fields])
    names = [f.name for f in out.fields]
    joined = join_on(future.select(*by, ds), models, by)

    def evaluate(frames):
        for pdf in frames:
            for c in ("trend", "yhat", "yhat_lower", "yhat_upper"):
                pdf[c] = np.nan
            days = pd.to_datetime(pdf[ds]).to_numpy("datetime64[ns]").astype("int64") / 86400e9
            for _, index in pdf.groupby(by, dropna=False, sort=False).indices.items():
                row = pdf.iloc[index[0]]
                if row["beta"] is None:
                    continue
                x = _design(days[index], row["first"], row["last"], np.asarray(row["active"], float))
                beta = np.asarray(row["beta"], float)
                trend, yhat = x[:, :_TREND] @ beta[:_TREND], x @ beta
                wide = INTERVAL_Z * np.sqrt(row["sigma"] ** 2 + _trend_variance(days[index], row["first"], row["last"], beta))
                where = pdf.index[index]
                pdf.loc[where, "trend"], pdf.loc[where, "yhat"] = trend, yhat
                pdf.loc[where, "yhat_lower"], pdf.loc[where, "yhat_upper"] = yhat - wide, yhat + wide
            yield pdf[names]

    return joined.mapInPandas(evaluate, out)


def forecast_groups(
    df: DataFrame,
    by: list[str],
    ds: str = "ds",
    y: str = "y",
    horizon: int = HORIZON,
    step: str = "1 DAY",
    fit: Callable[..., pd.DataFrame] | None = None,
    schema: str | None = None,
    **kwargs,
) -> DataFrame:
    """Fit every group and return its ``horizon`` future rows.

    The default is the additive model. A function ``fit(pdf, horizon, **kwargs)`` with
    its output ``schema`` runs on whole groups instead.
    """
    if fit is not None:
        return grouped_map(df, by, fit, schema, columns=[*by, ds, y], horizon=horizon, **kwargs)
    models = Scratch(df.sparkSession).store(fit_groups(df, by, ds, y, **kwargs), "models")
    return predict_groups(models, future_frame(df, by, ds, horizon, step), by, ds)

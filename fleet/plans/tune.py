"""Hyperparameter search: trial tables, Bayesian proposals, successive halving, tuning of groups and whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleet.functions.draws import integer_between, loguniform_between, uniform, uniform_between, uniform_pair
from fleet.operators.groups import pair_trials
from fleet.operators.history import best_trial
from fleet.operators.keys import block_cogroup, join_on
from fleet.operators.scans import global_ordinal, rank_cut
from fleet.plans.bins import BinnedTable, row_hash
from fleet.plans.boost import METRICS, BoostParams, train, with_params
from fleet.plans.group_search import SMALL_ROWS, fit_grid, split_by_size, with_failures
from fleet.plans.local_boost import BoostFit
from fleet.scratch import Scratch

GOOD_SHARE = 0.25
CANDIDATES = 24
LEAST_BANDWIDTH = 0.01  # share of the range


@dataclass(frozen=True)
class Draw:
    """A distribution of one setting; the upper end of ``randint`` is not drawn."""

    kind: str
    low: float
    high: float

    def column(self, draw: Column) -> Column:
        if self.kind == "uniform":
            return uniform_between(self.low, self.high, draw)
        if self.kind == "loguniform":
            return loguniform_between(self.low, self.high, draw)
        return integer_between(int(self.low), int(self.high), draw).cast("double")

    def bounds(self) -> tuple[float, float]:
        """The range on the scale in which densities are estimated."""
        if self.kind == "loguniform":
            return math.log(self.low), math.log(self.high)
        return float(self.low), float(self.high)

    def limits(self) -> tuple[float, float]:
        """Where the densities of proposals end on that scale: whole numbers reach half a step to both sides."""
        low, high = self.bounds()
        return (low - 0.5, high - 0.5) if self.kind == "randint" else (low, high)


def draw_uniform(low: float, high: float) -> Draw:
    return Draw("uniform", low, high)


def draw_loguniform(low: float, high: float) -> Draw:
    return Draw("loguniform", low, high)


def draw_randint(low: int, high: int) -> Draw:
    return Draw("randint", low, high)


def flat_space(space: dict, prefix: str = "") -> dict:
    """A nested space as one level with dotted names."""
    out = {}
    for name, value in space.items():
        if isinstance(value, dict):
            out |= flat_space(value, f"{prefix}{name}.")
        else:
            out[f"{prefix}{name}"] = value
    return out


def sample_trials(
    groups: DataFrame, space: dict, n: int, seed: int = 0, start: int = 0, out: str = "trial_id"
) -> DataFrame:
    """``n`` trials for every row of ``groups``: the group, the trial number, ``params`` and ``settings``.

    Numbers are ``params``, texts and flags ``settings``. A draw depends on the seed,
    the group, the trial and the name only.
    """
    flat = flat_space(space)
    trials = pair_trials(groups, [{out: i} for i in range(start, start + n)], out)
    numbers, texts = [], []
    for name, value in flat.items():
        if isinstance(value, Draw):
            numbers += [F.lit(name), value.column(uniform(seed, *groups.columns, out, F.lit(name)))]
        elif isinstance(value, (int, float)) and not isinstance(value, bool):
            numbers += [F.lit(name), F.lit(float(value))]
        else:
            texts += [F.lit(name), F.lit(str(value))]
    empty = lambda kind: F.create_map().cast(f"map<string,{kind}>")
    return trials.select(
        *groups.columns,
        out,
        (F.create_map(*numbers) if numbers else empty("double")).alias("params"),
        (F.create_map(*texts) if texts else empty("string")).alias("settings"),
    )


# --- Bayesian proposals -----------------------------------------------------------


def _drawn(space: dict) -> dict[str, Draw]:
    return {n: d for n, d in flat_space(space).items() if isinstance(d, Draw)}


def _cells(df: DataFrame, draws: dict[str, Draw], *columns: str) -> DataFrame:
    """A row for every drawn setting, with its value ``x`` on the scale in which densities are estimated."""
    scale = F.create_map(*[F.lit(x) for n, d in draws.items() for x in (n, d.kind)])
    cells = df.select(*columns, F.explode("params").alias("name", "_v")).where(F.col("name").isin(list(draws)))
    value = F.when(scale[F.col("name")] == "loguniform", F.log("_v")).otherwise(F.col("_v"))
    return cells.select(*columns, "name", value.alias("x"))


def _ranges(draws: dict[str, Draw]) -> Column:
    return F.create_map(*[F.lit(x) for n, d in draws.items() for x in (n, d.bounds()[1] - d.bounds()[0])])[F.col("name")]


def _kernels(
    finished: DataFrame, draws: dict[str, Draw], keys: list[str], metric: str, mode: str, share: float, least: Callable[[Column], Column]
) -> tuple[DataFrame, DataFrame]:
    """The settings of good (``kept``) and other trials with their number ``w``, and ``n`` and ``width`` of each side.

    ``least`` gives the smallest width, as a share of the range, by the number of trials of a side.
    """
    marked = rank_cut(finished, metric, share, keys, descending=mode == "max")
    points = _cells(marked, draws, *keys, "kept").groupBy(*keys, "name", "kept", "x").agg(F.count(F.lit(1)).cast("double").alias("w"))
    points = Scratch(finished.sparkSession).store(points, "points")
    n, mean = F.sum("w"), F.sum(F.col("w") * F.col("x")) / F.sum("w")
    spread = F.sqrt(F.greatest(F.sum(F.col("w") * F.col("x") * F.col("x")) / n - mean * mean, F.lit(0.0)))
    widths = points.groupBy(*keys, "name", "kept").agg(n.alias("n"), spread.alias("_sd")).select(
        *keys, "name", "kept", "n",
        F.greatest(F.col("_sd") * F.pow("n", F.lit(-0.2)), _ranges(draws) * least(F.col("n"))).alias("width"),
    )
    return points, widths


def _log_ratios(
    points: DataFrame, widths: DataFrame, wanted: DataFrame, draws: dict[str, Draw], keys: list[str], cut: bool = False
) -> DataFrame:
    """``score`` of every ``candidate`` and ``name`` of ``wanted``; with ``cut`` kernels end at the limits of their setting."""
    range_ = _ranges(draws)
    placed = join_on(points, widths.drop("n"), [*keys, "name", "kept"])
    out = wanted.select(*keys, "candidate").withColumns({"name": F.lit(""), "kept": F.lit(True), "_sum": F.lit(0.0)}).schema
    limits = {n: d.limits() for n, d in draws.items()}

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        x, w, h = (left[c].to_numpy() for c in ("x", "w", "width"))
        kept = left["kept"].to_numpy(zero_copy_only=False)
        c = right["x"].to_numpy()
        if cut and len(x):
            low, high = (np.array([math.erf(v) for v in (end - x) / (h * math.sqrt(2))]) for end in limits[left["name"][0].as_py()])
            w = w / ((high - low) / 2)
        density = np.exp(-0.5 * ((c[:, None] - x) / h) ** 2) / (h * math.sqrt(2 * math.pi)) * w
        sides = [right.append_column("kept", pa.array(np.full(len(c), side))).append_column(
            "_sum", pa.array(density[:, kept == side].sum(1))) for side in (True, False)]
        return pa.concat_tables(sides).select(out.names)

    sums = block_cogroup(
        placed, wanted, [*keys, "name"], kernel, out, ["x", "kept"], ["candidate"], left_rows=50_000, right_rows=200
    ).groupBy(*keys, "candidate", "name", "kept").agg(F.sum("_sum").alias("_sum"))
    sums = join_on(sums, widths.drop("width"), [*keys, "name", "kept"], "left")
    density = (F.coalesce("_sum", F.lit(0.0)) + 1.0 / range_) / (F.coalesce("n", F.lit(0.0)) + 1.0)
    signed = F.when(F.col("kept"), F.log(density)).otherwise(-F.log(density))
    return sums.groupBy(*keys, "candidate", "name").agg(F.sum(signed).alias("score"))


def tpe_scores(
    finished: DataFrame, candidates: DataFrame, space: dict, by: list[str] | None = None, metric: str = "value",
    mode: str = "min", share: float = GOOD_SHARE,
) -> DataFrame:
    """Log ratio of the densities of good and other trials at every candidate, for all groups in one job.

    ``finished`` has the group columns, ``params`` and the metric; ``candidates`` the
    group columns, ``candidate`` and ``params``. Equal settings of trials are counted
    first, and blocks of trials meet the candidates of their group, so the number of
    finished trials of a group is not limited.
    """
    keys, draws = list(by or []), _drawn(space)
    points, widths = _kernels(finished, draws, keys, metric, mode, share, lambda n: F.lit(LEAST_BANDWIDTH))
    scores = _log_ratios(points, widths, _cells(candidates, draws, *keys, "candidate"), draws, keys)
    return scores.groupBy(*keys, "candidate").agg(F.sum("score").alias("score"))


def _good_candidates(
    fresh: DataFrame, points: DataFrame, widths: DataFrame, draws: dict[str, Draw], keys: list[str], seed: str
) -> DataFrame:
    """Draw a value ``x`` for every candidate and setting from the density of the group's good trials.

    That density has a kernel for each good trial and one for the range, all of equal weight. A draw takes one of them by
    its number: a trial, around which a normal number within the limits is drawn, or else the value of ``fresh``, which
    lies anywhere in the range.
    """
    each, limits = [*keys, "name"], {n: d.limits() for n, d in draws.items()}
    whole = {n for n, d in draws.items() if d.kind == "randint"}
    trials = points.where("kept").select(*each, "x", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))).alias("_copy"))
    centers = global_ordinal(trials, ["x"], "_i", each).select(*each, "_i", F.col("x").alias("_center"))
    pick, place = uniform_pair(seed, *keys, "candidate", "name")
    drawn = join_on(_cells(fresh, draws, *keys, "candidate"), widths.where("kept").drop("kept"), each, "left")
    number = F.floor(pick * (F.coalesce("n", F.lit(0.0)) + 1.0)).cast("long")
    drawn = drawn.select(*each, "candidate", "x", "width", number.alias("_i"), place.alias("_u"))
    drawn = join_on(drawn, centers, [*each, "_i"], "left").select(*each, "candidate", "x", "width", "_u", "_center")
    schema = drawn.select(*each, "candidate", "x").schema

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normal = NormalDist()
        for batch in batches:
            found = []
            for name, x, width, u, center in zip(*(batch.column(c).to_pylist() for c in ("name", "x", "width", "_u", "_center"))):
                if center is not None:
                    low, high = limits[name]
                    under, upto = normal.cdf((low - center) / width), normal.cdf((high - center) / width)
                    share = min(max(under + u * (upto - under), 1e-16), 1 - 1e-16)
                    x = min(max(center + width * normal.inv_cdf(share), low), high)
                    if name in whole:
                        x = min(float(math.floor(x + 0.5)), high - 0.5)
                found.append(x)
            columns = [pa.array(found, pa.float64()) if n == "x" else batch.column(n) for n in schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return drawn.mapInArrow(near, schema)


def tpe_propose(
    finished: DataFrame, groups: DataFrame, space: dict, n: int = 1, mode: str = "min", seed: int = 0, start: int = 0,
    metric: str = "value",
) -> DataFrame:
    """The next ``n`` trials of every group. Each draws ``CANDIDATES`` values of every setting from the density of the
    group's good trials and takes the one with the highest ratio to the density of the others.

    Kernels of few trials are wide: a side of n trials has at least 1 / (n + 2) of the range, down to
    ``LEAST_BANDWIDTH``. Proposals rest on finished trials only, so a round of many trials at once is less informed than
    the same trials one by one. A group without finished trials gets values from the whole range.
    """
    keys, draws = groups.columns, _drawn(space)
    trials = sample_trials(groups, space, n, f"{seed}|{start}", start)
    if not draws:
        return trials
    scratch = Scratch(finished.sparkSession)
    least = lambda count: F.greatest(1.0 / (count + 2.0), F.lit(LEAST_BANDWIDTH))
    points, widths = _kernels(finished, draws, keys, metric, mode, GOOD_SHARE, least)
    widths = scratch.store(widths, "widths")
    fresh = sample_trials(trials.select(*keys, "trial_id"), space, CANDIDATES, f"{seed}|{start}", out="candidate")
    fresh = fresh.withColumn("candidate", F.col("trial_id") * CANDIDATES + F.col("candidate"))
    wanted = scratch.store(_good_candidates(fresh, points, widths, draws, keys, f"{seed}|{start}|good"), "candidates")
    scores = _log_ratios(points, widths, wanted, draws, keys, cut=True)
    scored = join_on(wanted, scores, [*keys, "candidate", "name"]).withColumn("trial_id", F.floor(F.col("candidate") / CANDIDATES).cast("int"))
    best = scored.groupBy(*keys, "trial_id", "name").agg(F.max_by("x", F.struct("score", -F.col("candidate"))).alias("x"))
    logs = F.col("name").isin([name for name, d in draws.items() if d.kind == "loguniform"])
    value = F.when(logs, F.exp("x")).otherwise(F.col("x"))
    chosen = best.groupBy(*keys, "trial_id").agg(F.map_from_entries(F.collect_list(F.struct("name", value))).alias("_chosen"))
    picked = join_on(trials, chosen, [*keys, "trial_id"], "left")
    params = F.transform_values("params", lambda name, v: F.coalesce(F.try_element_at("_chosen", name), v))
    return picked.select(*keys, "trial_id", params.alias("params"), "settings")


# --- successive halving -----------------------------------------------------------


def halving_cut(df: DataFrame, metric: str, eta: int = 4, by: list[str] | None = None, mode: str = "min") -> DataFrame:
    """Trials of a rung that go on: those whose percent rank is below 1 / eta."""
    return rank_cut(df, metric, 1.0 / eta, by, descending=mode == "max").where("kept").drop("kept")


def halving_rule(eta: int, grace: int = 1):
    """A hook for training: at rounds grace, grace * eta, ... only the best 1 / eta of a group's trials go on."""
    state = {"next": grace}

    def hook(trainer) -> None:
        if trainer.round == 1:
            state["next"] = grace
        if trainer.round < state["next"]:
            return
        state["next"] = trainer.round * eta
        by_group: dict[int, list] = {}
        for (g, _), model in trainer.models.items():
            if model.active and model.history:
                by_group.setdefault(g, []).append(model)
        for models in by_group.values():
            sign = 1.0 if METRICS[models[0].params.eval_metric] == "min" else -1.0
            values = np.array([sign * m.history[-1] for m in models])
            rank = (values[None, :] < values[:, None]).sum(1) / max(len(models) - 1, 1)
            for model, place in zip(models, rank):
                model.active = place < 1.0 / eta

    return hook


# --- search -----------------------------------------------------------------------


@dataclass
class TuneResult:
    """``trials``: group columns, trial_id, params, value. ``best``: one row per group with its model.

    ``best.error`` tells why a group has no model, or no value to compare its trials by. ``refitted``: the best settings
    of each group trained on all of its rows, held-out ones too.
    """

    trials: DataFrame
    best: DataFrame
    history: DataFrame
    refitted: DataFrame | None = None


class _GroupedFits:
    """Where the trials of a round are trained: small groups in tasks, the others, or the whole table, by level jobs."""

    def __init__(self, df, features, label, keys, base, validation, max_bin, exact_bins, fit_fn, small_rows, trials_per_task, hook, scratch, sizes=None):
        self.keys, self.base, self.hook, self.scratch, self.rounds = keys, base, hook, scratch, 0
        self.small = self.table = self.sizes = None
        self.per_task = None if hook else trials_per_task  # halving compares all trials of a group
        large = df
        if keys and small_rows:
            if sizes is None:
                few, many = split_by_size(df, keys, small_rows)
                sizes = scratch.store(few, "small-groups"), scratch.store(many, "large-groups")
            self.few, many = self.sizes = sizes
            named = [] if fit_fn else ([features] if isinstance(features, str) else features) + [label]
            held = F.coalesce(validation, F.lit(False)).alias("_held")
            columns = dict.fromkeys([*keys, *(named or df.columns)])
            rows = df.select(*columns, held, row_hash(features, label).alias("_row"))
            self.small = scratch.store(join_on(rows, self.few, keys, "left_semi"), "small-rows")
            self.fit = fit_fn or BoostFit(features, label, "_held", "_row", base, max_bin, hook)
            large = None if many.isEmpty() else join_on(df, many, keys, "left_semi")
        if large is not None:
            if fit_fn:
                raise ValueError("fit_fn gets whole groups: raise small_rows above the largest group, or leave fit_fn out")
            self.table = BinnedTable(large, features, label, keys, validation, max_bin, exact_bins)
        self.groups = self._all_groups() if keys else scratch.store(df.sparkSession.range(1).select(F.lit(0).alias("_study")), "groups")

    def _all_groups(self) -> DataFrame:
        parts = ([self.few] if self.small is not None else []) + ([self.table.groups.select(*self.keys)] if self.table else [])
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def train(self, trials: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``(models, history)`` of a round, with ``error`` in the models."""
        self.rounds += 1
        found, history = [], []
        if self.small is not None:
            mine = trials if self.table is None else join_on(trials, self.few, self.keys, "left_semi")
            fitted = self.scratch.store(fit_grid(self.small, mine, self.keys, self.fit, self.per_task), f"fits{self.rounds}")
            found.append(fitted.drop("history"))
            history.append(fitted.select(*self.keys, "trial_id", F.explode("history").alias("_h")).select(*self.keys, "trial_id", "_h.*"))
        if self.table:
            trained = train(self.table, trials if self.keys else trials.drop("_study"), self.base, self.hook)
            found.append(trained.models.withColumn("error", F.lit(None).cast("string")))
            history.append(trained.history)
        both = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return both(found), both(history)

    def close(self) -> None:
        if self.table:
            self.table.close()


def tune(
    df: DataFrame,
    features: list[str] | str,
    label: str,
    space: dict,
    n_trials: int,
    base: BoostParams,
    validation: Column,
    group_columns: list[str] | None = None,
    max_concurrent_trials: int | None = None,
    search: str = "tpe",
    halving_eta: int | None = None,
    max_bin: int = 256,
    seed: int = 0,
    fit_fn: Callable | None = None,
    small_rows: int = SMALL_ROWS,
    trials_per_task: int | None = None,
    refit: bool = False,
    exact_bins: bool = False,
) -> TuneResult:
    """Search settings for every group, or for the whole table without ``group_columns``.

    Trials run in rounds of ``max_concurrent_trials``. Groups of up to ``small_rows`` rows are trained whole inside tasks,
    all of them in one job a round; larger ones, and a whole table, train together in level jobs. Both give the same
    trees. After the first round the settings come from ``tpe_propose``. A trial's value is its last validation metric.
    ``fit_fn(pdf, params)`` replaces boosting in the tasks: it gets all rows of a group with the mark ``_held`` and returns
    the value, or a dict with ``value`` and ``model``.
    """
    spark: SparkSession = df.sparkSession
    keys, mode = list(group_columns or []), METRICS[base.eval_metric]
    if not fit_fn:  # unknown names fail before any work
        with_params(base, **{name: value.low if isinstance(value, Draw) else value for name, value in flat_space(space).items()})
    batch = min(max_concurrent_trials or n_trials, n_trials)
    scratch = Scratch(spark)
    hook = halving_rule(halving_eta) if halving_eta else None
    fits = _GroupedFits(df, features, label, keys, base, validation, max_bin, exact_bins, fit_fn, small_rows, trials_per_task, hook, scratch)
    groups, runs, histories, finished = fits.groups, [], [], None
    for start in range(0, n_trials, batch):
        size = min(batch, n_trials - start)
        if finished is None or search != "tpe":
            trials = sample_trials(groups, space, size, seed, start)
        else:
            trials = tpe_propose(finished, groups, space, size, mode, seed, start)
        trials = scratch.store(trials, f"trials{start}")
        models, history = fits.train(trials)
        models = models if keys else models.withColumn("_study", F.lit(0))
        runs.append(with_failures(join_on(trials, models, [*groups.columns, "trial_id"], "left")))
        histories.append(history)
        done = runs[0]
        for run in runs[1:]:
            done = done.unionByName(run)
        finished = done.select(*groups.columns, "trial_id", "params", "value")
    history = histories[0]
    for more in histories[1:]:
        history = history.unionByName(more)
    finished, done = scratch.store(finished, "finished"), scratch.store(done, "done")
    history = scratch.store(history, "history")
    best = best_trial(done, groups.columns, "value", mode)  # one row per group, also where nothing was trained
    fits.close()
    refitted = _refit(df, features, label, best, base, keys, max_bin, exact_bins, fit_fn, small_rows, scratch, fits.sizes) if refit else None
    return TuneResult(finished.drop("_study"), best.drop("_study"), history, refitted)


def _refit(df, features, label, best, base, keys, max_bin, exact_bins, fit_fn, small_rows, scratch, sizes) -> DataFrame:
    """The best settings of every group on all its rows, for as many rounds as did best; nothing is held out."""
    rounds = F.map_from_arrays(F.array(F.lit("num_estimators")), F.array((F.col("best_round") + 1).cast("double")))
    rest = F.map_filter("params", lambda name, _: ~F.element_at(F.split(name, "[.]"), -1).isin("num_estimators", "n_estimators", "num_boost_round"))
    params = F.col("params") if fit_fn else F.map_concat(rest, F.coalesce(rounds, F.create_map().cast("map<string,double>")))
    wanted = best.where("model IS NOT NULL OR value IS NOT NULL").select(*[c for c in best.columns if c in (*keys, "_study")], "trial_id", params.alias("params"), "settings")
    wanted = scratch.store(wanted, "refit-trials")
    plain = replace(base, early_stopping_rounds=0, stop_metric=None)
    again = _GroupedFits(df, features, label, keys, plain, F.lit(False), max_bin, exact_bins, fit_fn, small_rows, None, None, Scratch(df.sparkSession), sizes)
    models, _ = again.train(wanted)
    models = models if keys else models.withColumn("_study", F.lit(0))
    on = [c for c in wanted.columns if c in (*keys, "_study")]
    found = scratch.store(join_on(wanted, models.drop("value", "best_round"), [*on, "trial_id"], "left"), "refitted")
    again.close()
    return found.drop("_study")

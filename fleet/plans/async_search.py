"""Concurrent trials over one stored table, and asynchronous successive halving.

Synchronous halving waits until all trials of a rung have reported. Here every report is decided when it arrives, against
the reports of its rung so far: a trial goes on if fewer than 1 / eta of them are better than its own. ``AsyncHalving``
decides the reports of a running search, ``replay_async`` decides a stored log of any size in the same way.
"""

from __future__ import annotations

import bisect
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleet.operators.history import best_trial
from fleet.operators.keys import join_on
from fleet.operators.scans import global_ordinal, running
from fleet.plans.bins import BinnedTable
from fleet.plans.boost import HISTORY_COLUMNS, METRICS, MODEL_COLUMNS, BoostParams, train, with_params
from fleet.plans.tune import TuneResult, sample_trials
from fleet.scratch import Scratch

RUN_BITS = 18
REPORTS = "trial_id int, rung int, reported long, value double, seen long, better long, goes_on boolean"


class AsyncHalving:
    """Decides reports in the order in which threads make them; ``log`` is the append-only table of rungs.

    Rungs are at rounds ``grace``, ``grace * eta``, ``grace * eta^2`` and so on. The driver holds one row per trial and rung.
    """

    def __init__(self, eta: int = 4, grace: int = 1, mode: str = "min"):
        if eta < 2 or grace < 1 or mode not in ("min", "max"):
            raise ValueError("eta is 2 or more, grace 1 or more, mode 'min' or 'max'")
        self.eta, self.grace, self.sign = eta, grace, 1.0 if mode == "min" else -1.0
        self.log: list[tuple] = []
        self._values: dict[int, list[float]] = {}
        self._lock = threading.Lock()

    def rung(self, round_: int) -> int | None:
        """The rung of a round, if it has one."""
        rung, at = 0, self.grace
        while at < round_:
            rung, at = rung + 1, at * self.eta
        return rung if at == round_ else None

    def report(self, trial: int, rung: int, value: float | None) -> bool:
        """Whether the trial goes on. A missing value ends it and counts for no other trial."""
        with self._lock:
            reported = len(self.log)
            if value is None or value != value:
                self.log.append((trial, rung, reported, None, None, None, False))
                return False
            values = self._values.setdefault(rung, [])
            better = bisect.bisect_left(values, self.sign * value)
            bisect.insort(values, self.sign * value)
            goes_on = better * self.eta < len(values)
            self.log.append((trial, rung, reported, float(value), len(values), better, goes_on))
            return goes_on


def better_before(ranks: np.ndarray) -> np.ndarray:
    """For each place, how many places before it have a smaller rank.

    From the highest bit of the place down: the rows of a block lie in the order of their ranks, its left half is counted
    as it comes, and the halves become the blocks of the next bit.
    """
    n = len(ranks)
    at = np.lexsort((-np.arange(n), ranks))  # equal ranks: later places first, so they count for none
    found = np.zeros(n, np.int64)
    for bit in reversed(range(max(n - 1, 0).bit_length())):
        left = (at >> bit) & 1 == 0
        upto = np.concatenate([[0], np.cumsum(left)])
        start = at >> (bit + 1) << (bit + 1)
        lefts = upto[1:] - upto[start]
        found[at[~left]] += lefts[~left]
        place = np.where(left, start + lefts - 1, start + (1 << bit) + np.arange(n) - start - lefts)
        halved = np.empty_like(at)
        halved[place] = at
        at = halved
    return found


def earlier_better(df: DataFrame, by: list[str], order: list[str | Column], value: str, mode: str = "min") -> DataFrame:
    """Add ``seen``, the rows of the group up to this one in ``order``, and ``better``, how many of those are strictly better.

    Rows get their number in the group. Each run of 2 ** ``RUN_BITS`` numbers is counted in a task. The runs before run r
    are the left siblings of the blocks that its set bits close, one per bit, so for each bit a running count of left rows
    in the order of value gives the better ones in that block: n rows in m runs take n log m cells and one distributed
    scan, however many of them are of one group.
    """
    numbered = Scratch(df.sparkSession).store(global_ordinal(df, order, "_i", by), "numbered")
    last = (numbered.agg(F.max("_i")).first()[0] or 0) >> RUN_BITS
    run = F.shiftright("_i", RUN_BITS)
    direction = "ascending" if mode == "min" else "descending"

    def within(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_i").drop_columns("_run")
        ranks = pc.rank(rows[value].combine_chunks(), direction, tiebreaker="dense").to_numpy().astype(np.int64)
        return rows.append_column("_better", pa.array(better_before(ranks)))

    kind = T.StructType([*numbered.schema.fields, T.StructField("_better", T.LongType())])
    counted = numbered.withColumn("_run", run).groupBy(*by, "_run").applyInArrow(within, kind)
    if last:
        bits = F.explode(F.sequence(F.lit(0), F.lit(last.bit_length() - 1)))
        signed = F.col(value) if mode == "min" else -F.col(value)
        cells = numbered.select(*by, "_i", run.alias("_run"), signed.alias("_v"), bits.alias("_bit")).select(
            *by, "_i", "_v", "_bit", F.expr("shiftright(_run, _bit + 1)").alias("_block"), F.expr("1 - (shiftright(_run, _bit) & 1)").alias("_left"),
        )
        sums = running(cells, [*by, "_bit", "_block"], ["_v", "_left"], {"_n": ("sum", "_left")})  # equal values: right rows first
        sums = sums.where("_left = 0").groupBy(*by, "_i").agg(F.sum("_n").alias("_n"))
        counted = join_on(counted, sums, [*by, "_i"], "left").withColumn("_better", F.col("_better") + F.coalesce("_n", F.lit(0))).drop("_n")
    return counted.withColumns({"seen": F.col("_i") + 1, "better": F.col("_better")}).drop("_i", "_better")


def replay_async(
    log: DataFrame, by: list[str] | None = None, eta: int = 4, mode: str = "min", metric: str = "value",
    trial: str = "trial_id", rung: str = "rung", order: str = "reported",
) -> DataFrame:
    """The decisions of asynchronous halving on a log of reports: ``seen``, ``better`` and ``goes_on``.

    Reports of trials that were stopped at a lower rung of the log are left out. A report without a value ends its trial and
    counts for no other: ``seen`` and ``better`` are null. There is one job per rung, of which there are few.
    """
    keys, scratch, out, kept = list(by or []), Scratch(log.sparkSession), None, None
    has = F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double"))
    for (level,) in log.select(rung).where(F.col(rung).isNotNull()).distinct().orderBy(rung).collect():
        reports = log.where(F.col(rung) == F.lit(level))
        if kept is not None:
            reports = join_on(reports, kept.select(*keys, trial), [*keys, trial], "left_semi")
        ranked = earlier_better(reports.where(has), keys, list(dict.fromkeys([order, trial])), metric, mode)
        missing = reports.where(~has).withColumns({"seen": F.lit(None).cast("long"), "better": F.lit(None).cast("long")})
        decided = ranked.unionByName(missing).withColumn("goes_on", F.coalesce(F.col("better") * eta < F.col("seen"), F.lit(False)))
        decided = scratch.store(decided, f"rung-{level}")
        kept = decided.where("goes_on")
        out = decided if out is None else out.unionByName(decided)
    if out is None:
        nothing = F.lit(None).cast("long")
        out = log.where("false").withColumns({"seen": nothing, "better": nothing, "goes_on": F.lit(False)})
    return out


@dataclass
class ConcurrentResult(TuneResult):
    """Also ``reports``: what was decided at each rung, in order of arrival (empty without halving)."""

    reports: DataFrame | None = None


def tune_concurrent(
    df: DataFrame,
    features: list[str] | str,
    label: str,
    space: dict,
    n_trials: int,
    base: BoostParams,
    validation: Column,
    max_concurrent_trials: int = 4,
    halving: AsyncHalving | None = None,
    max_bin: int = 256,
    seed: int = 0,
    exact_bins: bool = False,
) -> ConcurrentResult:
    """Search settings for the whole table with up to ``max_concurrent_trials`` trials at work at a time.

    All trials read one stored, binned table. Each trains in jobs of its own, under a job group of its name and, where
    ``spark.scheduler.mode`` is FAIR, in a pool of its own, so that a long trial does not hold up the others; none waits
    for the reports of another. A trial that ``halving`` stops starts no further job. A trial that fails has an ``error``.
    """
    spark, mode, search = df.sparkSession, METRICS[base.eval_metric], uuid.uuid4().hex[:8]
    context, scratch = spark.sparkContext, Scratch(spark)
    table = BinnedTable(df, features, label, None, validation, max_bin, exact_bins)
    table.wave(0)  # once, before the trials share it
    trials = scratch.store(sample_trials(spark.range(1).select(F.lit(0).alias("_study")), space, n_trials, seed), "trials")

    def hook(trial: int):
        def decide(trainer) -> None:
            rung = halving.rung(trainer.round)
            for model in trainer.models.values():
                if rung is not None and model.history:
                    model.active = halving.report(trial, rung, model.history[-1]) and model.active

        return decide if halving else None

    def run(row) -> tuple:
        context.setJobGroup(f"search-{search}-trial-{row.trial_id}", f"trial {row.trial_id} of {n_trials}")
        context.setLocalProperty("spark.scheduler.pool", f"trial-{row.trial_id % max_concurrent_trials}")
        try:
            return row.trial_id, train(table, [with_params(base, **row.params, **row.settings)], base, hook(row.trial_id)), None
        except Exception as error:  # the other trials go on
            return row.trial_id, None, f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(max_concurrent_trials) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(run), trials.orderBy("trial_id").collect()))
    table.close()
    own = lambda part, trial: part.withColumn("trial_id", F.lit(trial))
    models, history = spark.createDataFrame([], MODEL_COLUMNS), spark.createDataFrame([], HISTORY_COLUMNS)
    for trial, result, _ in found:
        if result:
            models, history = models.unionByName(own(result.models, trial)), history.unionByName(own(result.history, trial))
    errors = spark.createDataFrame([(t, e) for t, _, e in found], "trial_id int, error string")
    done = scratch.store(join_on(join_on(trials, models, ["trial_id"], "left"), errors, ["trial_id"], "left"), "done")
    reports = scratch.store(spark.createDataFrame(halving.log if halving else [], REPORTS), "reports")
    best = best_trial(done, ["_study"], "value", mode).drop("_study")
    return ConcurrentResult(done.select("trial_id", "params", "value", "error"), best, scratch.store(history, "history"), reports=reports)

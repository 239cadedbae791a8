"""Gradient-boosted trees by histogram aggregation on data frames.

Rows are binned once and stored. Every tree level is one job for all models that
are in training (all groups, trials and classes): tasks add up gradients per bin,
Spark sums them, and a window over the bins finds the best split of each node.
The driver holds trees and metrics only. Groups are trained in waves whose models
and bin edges fit a stated size, and the rows of a group are spread over tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleet.functions.draws import drawn_below
from fleet.plans.bins import STATE, BinnedTable, Wave, full_packs, pack_batch, pack_size
from fleet.plans.tree_models import model_text
from fleet.scratch import Scratch, checkpoint_folder

HISTOGRAM_BYTES = 256 << 20
STORE_EVERY = 10
SAMPLE_BINS = 1024
SAMPLE_SHARE = 0.5  # of a group's rows, up to which a round's sample is held for its level jobs
FEW_SPLITS = 32  # up to which a tree is walked split by split for all rows at once
TEXT_BYTES = 32 << 20
MODEL_COLUMNS = "trial_id int, best_round int, value double, model string"
HISTORY_COLUMNS = "trial_id int, round int, metric string, value double"


@dataclass(frozen=True)
class BoostParams:
    """Settings of one model. ``max_leaves`` above 0 grows leaf by leaf, best gain first."""

    objective: str = "multi:softmax"
    num_class: int = 1
    eval_metric: str = "mlogloss"
    learning_rate: float = 0.3
    num_estimators: int = 10
    max_depth: int = 6
    max_leaves: int = 0
    gamma: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    sampling_method: str = "uniform"
    early_stopping_rounds: int = 0
    stop_metric: float | None = None
    seed: int = 42

    def __post_init__(self):
        if self.objective not in ("multi:softmax", "reg:squarederror"):
            raise ValueError(f"unknown objective {self.objective}")
        if self.eval_metric not in METRICS:
            raise ValueError(f"unknown metric {self.eval_metric}")

    @property
    def outputs(self) -> int:
        return self.num_class if self.objective == "multi:softmax" else 1


# Metrics with the mode in which they improve.
METRICS = {"mlogloss": "min", "merror": "min", "accuracy": "max", "rmse": "min", "mae": "min", "rmsle": "min"}


# --- bins, gradients and splits as data frames -----------------------------------


def sum_histogram(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Sum gradients and hessians per bin; placed by node and feature so that the split search
    needs no further shuffle."""
    placed = partials.repartition(*keys)
    return placed.groupBy(*keys, "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_split(
    histogram: DataFrame, node: list[str], reg_lambda: str | float = 1.0, gamma: str | float = 0.0,
    min_child_weight: str | float = 1.0,
) -> DataFrame:
    """The split with the highest gain of every node: feature, bin, gain and the sums left and in all.

    Rows of a bin up to ``bin`` go left. Ties go to the lowest feature, then bin. A
    node that no split divides has a gain of minus infinity. Settings are numbers or
    SQL expressions over the node columns.
    """
    group = ", ".join(node)
    place = f"PARTITION BY {group}, feature"
    score = lambda g, h: f"pow({g}, 2) / ({h} + {reg_lambda})"
    allowed = f"hl >= {min_child_weight} AND ha - hl >= {min_child_weight}"
    gain = f"0.5D * ({score('gl', 'hl')} + {score('(ga - gl)', '(ha - hl)')} - {score('ga', 'ha')}) - {gamma}"
    sums = histogram.selectExpr(
        *node, "feature", "bin",
        *[f"sum({c}) OVER ({place} ORDER BY bin) AS {c}l" for c in "gh"],
        *[f"sum({c}) OVER ({place}) AS {c}a" for c in "gh"],
    )
    gains = sums.selectExpr("*", f"CASE WHEN {allowed} THEN {gain} ELSE double('-Infinity') END AS gain")
    best = gains.groupBy(*node).agg(
        F.expr("max_by(struct(feature, bin, gain, gl, hl, ga, ha), struct(gain, -feature, -bin))").alias("_s")
    )
    return best.select(*node, "_s.*")


# --- trees on the driver ----------------------------------------------------------


@dataclass
class Tree:
    """A growing tree. A node is split when the growth plan says so; the rest are leaves."""

    depth: list[int] = field(default_factory=lambda: [0])
    sums: list[tuple[float, float] | None] = field(default_factory=lambda: [None])
    split: list[tuple[float, int, int, tuple[float, float]] | None] = field(default_factory=lambda: [None])
    children: list[tuple[int, int] | None] = field(default_factory=lambda: [None])
    chosen: set[int] = field(default_factory=set)

    def record(self, node: int, row) -> None:
        self.sums[node] = (row["ga"], row["ha"])
        self.split[node] = (row["gain"], row["feature"], row["bin"], (row["gl"], row["hl"]))

    def _open(self, node: int) -> tuple[int, int]:
        if self.children[node] is None:
            (g, h), (_, _, _, (gl, hl)) = self.sums[node], self.split[node]
            for sums in ((gl, hl), (g - gl, h - hl)):
                self.depth.append(self.depth[node] + 1)
                self.sums.append(sums)
                self.split.append(None)
                self.children.append(None)
            self.children[node] = (len(self.depth) - 2, len(self.depth) - 1)
        return self.children[node]

    def plan(self, params: BoostParams) -> list[int]:
        """Choose the nodes to split, best gain first; returns the nodes whose best split is still unknown.

        Without a leaf limit this is level by level. With one, leaves that are not yet
        known are asked for and the choice is made again, so the result is that of
        splitting one leaf at a time.
        """
        limit = params.max_leaves or float("inf")
        can_split = lambda n: not params.max_depth or self.depth[n] < params.max_depth
        self.chosen, ready, unknown, leaves = set(), [], [], 1

        def reach(node: int) -> None:
            if can_split(node):
                if self.split[node] is None:
                    unknown.append(node)
                elif self.split[node][0] > 1e-12:
                    heapq.heappush(ready, (-self.split[node][0], node))

        reach(0)
        while ready and leaves < limit:
            _, node = heapq.heappop(ready)
            self.chosen.add(node)
            leaves += 1
            if leaves < limit:
                for child in self._open(node):
                    reach(child)
            else:
                self._open(node)
        return unknown

    def arrays(self, params: BoostParams | None = None, nodes: list[int] | None = None) -> dict[str, np.ndarray]:
        """The chosen splits as arrays; leaf values with ``params``, slots of open ``nodes`` otherwise."""
        count = len(self.depth)
        out = {k: np.full(count, -1, np.int32) for k in ("feature", "bin", "left", "right", "slot")}
        for node in self.chosen:
            _, out["feature"][node], out["bin"][node], _ = self.split[node]
            out["left"][node], out["right"][node] = self.children[node]
        for slot, node in enumerate(nodes or []):
            out["slot"][node] = slot
        if params is not None:
            out["value"] = np.array([
                0.0 if s is None else -params.learning_rate * s[0] / (s[1] + params.reg_lambda) for s in self.sums
            ])
        return out


@dataclass
class _Model:
    params: BoostParams
    base: float = 0.0
    trial: int = 0
    trees: list[list[dict]] = field(default_factory=list)
    stored: int = 0
    history: list[float] = field(default_factory=list)
    active: bool = True
    threshold: float = 0.0

    def best_round(self) -> int:
        signed = self.history if METRICS[self.params.eval_metric] == "min" else [-v for v in self.history]
        return int(np.argmin(signed)) if signed else len(self.trees) - 1

    def advance(self, value: float | None) -> None:
        """Take the metric of the last round and decide whether to go on."""
        p = self.params
        if value is not None:
            self.history.append(value)
            if p.early_stopping_rounds and len(self.history) - 1 - self.best_round() >= p.early_stopping_rounds:
                self.active = False
            if p.stop_metric is not None:
                reached = value >= p.stop_metric if METRICS[p.eval_metric] == "max" else value <= p.stop_metric
                self.active = self.active and not reached
        if len(self.trees) >= p.num_estimators:
            self.active = False


# --- numpy helpers inside tasks ---------------------------------------------------


def _leaf_of(tree: dict, bins: np.ndarray) -> np.ndarray:
    inner = np.flatnonzero(tree["feature"] >= 0)
    if len(inner) <= FEW_SPLITS:  # parents are numbered before their children
        place = np.zeros(len(bins), np.int16)
        columns = {f: bins[:, f].copy() for f in set(tree["feature"][inner].tolist())}
        for at, f, bin_, left, right in zip(inner.tolist(), *(tree[k][inner].tolist() for k in ("feature", "bin", "left", "right"))):
            here = place == at
            place += here * np.int16(left - at)
            here &= columns[f] > bin_
            place += here * np.int16(right - left)
        return place.astype(np.int64)
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    while True:
        feature = tree["feature"][node]
        inner = feature >= 0
        if not inner.any():
            return node
        left = bins[rows, np.maximum(feature, 0)] <= tree["bin"][node]
        node = np.where(inner, np.where(left, tree["left"][node], tree["right"][node]), node)


def _mix(rows: np.ndarray, salt: int) -> np.ndarray:
    """Uniform in [0, 1) from row ids and a salt."""
    z = rows.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _gradients(params: BoostParams, margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if params.objective == "reg:squarederror":
        return margin - y[:, None], np.ones_like(margin)
    p = _softmax(margin)
    one = np.zeros_like(p)
    one[np.arange(len(y)), y.astype(np.int64)] = 1.0
    return p - one, np.maximum(2.0 * p * (1.0 - p), 1e-16)


def _losses(params: BoostParams, margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The per-row term whose mean (or its root) is the metric."""
    metric = params.eval_metric
    if metric == "mlogloss":
        return -np.log(np.maximum(_softmax(margin)[np.arange(len(y)), y.astype(np.int64)], 1e-15))
    if metric in ("merror", "accuracy"):
        return (margin.argmax(1) != y).astype(float) if metric == "merror" else (margin.argmax(1) == y).astype(float)
    gap = margin[:, 0] - y
    if metric == "mae":
        return np.abs(gap)
    if metric == "rmsle":
        return (np.log1p(np.maximum(margin[:, 0], -1 + 1e-6)) - np.log1p(y)) ** 2
    return gap**2


class _Work:
    """What a task needs: models by (group, trial) with the trees since the stored margins."""

    def __init__(self, models: dict, trials: int, outputs: int, features: int, bins: int, round_: int):
        self.models, self.trials, self.outputs = models, trials, outputs
        self.features, self.bins, self.round = features, bins, round_

    def parts(self, batch: pa.RecordBatch):
        """The packs of a batch: group, row ids, labels, bins, stored margins."""
        columns = [batch.column(c) for c in ("_g", "_row", "_y", "_bins", "_m")]
        for i in range(batch.num_rows):
            g, rows, y, codes, stored = (c[i] for c in columns)
            rows, y = np.frombuffer(rows.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.float64)
            codes, flat = np.frombuffer(codes.as_buffer(), np.uint8).reshape(len(y), self.features), stored.as_buffer()
            yield g.as_py(), rows, y, codes, np.frombuffer(flat).reshape(len(y), self.trials, self.outputs) if len(flat) else None

    def margin(self, g: int, t: int, codes: np.ndarray, stored: np.ndarray | None) -> np.ndarray:
        model = self.models[g, t]
        if stored is None:
            margin = np.full((len(codes), model["params"].outputs), model["base"])
        else:
            margin = stored[:, t, : model["params"].outputs].astype(np.float64)
        for trees in model["pending"]:
            for k, tree in enumerate(trees):
                margin[:, k] += tree["value"][_leaf_of(tree, codes)]
        return margin

    def pack_sums(self, g: int, t: int, held: bool, margin: np.ndarray, y: np.ndarray) -> np.ndarray | None:
        """What later jobs need to know of the rows of a pack: losses and rows if held out, else the scores of a sample."""
        p = self.models[g, t]["params"]
        if held:
            loss = _losses(p, margin, y)
            return np.array([loss.sum(), len(loss)])
        return sample_bins(p, *_gradients(p, margin, y)) if p.subsample < 1 and p.sampling_method != "uniform" else None

    def added(self, batches: Iterator[pa.RecordBatch], shape: tuple) -> dict[tuple[int, int], np.ndarray]:
        """The sums of packs, added up by model."""
        acc: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for g, sums in zip(batch.column("_g").to_pylist(), batch.column("_sums")):
                own = [k for k in self.models if k[0] == g]
                sums = np.frombuffer(sums.as_buffer()).reshape(self.trials, *shape) if own else None
                for key in own:
                    acc[key] = acc.get(key, 0.0) + sums[key[1]]
        return acc

    def weights(self, model: dict, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> np.ndarray | None:
        return row_weights(model["params"], model["threshold"], self.round, model["trial"], rows, grad, hess)


def row_weights(p: BoostParams, threshold: float, round_: int, trial: int, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> np.ndarray | None:
    """Row weights of a round's sample, None for all rows."""
    if p.subsample >= 1.0:
        return None
    draw = _mix(rows, p.seed * 1_000_003 + round_ * 1_009 + trial)
    if p.sampling_method == "uniform":
        return (draw < p.subsample).astype(float)
    keep = np.minimum(_sample_score(p, grad, hess) / max(threshold, 1e-300), 1.0)
    return np.where(draw < keep, 1.0 / np.maximum(keep, 1e-12), 0.0)


def _sample_score(params: BoostParams, grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    return np.sqrt((grad**2 + params.reg_lambda * hess**2).sum(1))


def sample_bins(params: BoostParams, grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """Rows and summed scores by bin of the logarithm of the score."""
    s = _sample_score(params, grad, hess)
    at = np.clip((np.log2(np.maximum(s, 1e-12)) + 40) * SAMPLE_BINS / 60, 0, SAMPLE_BINS - 1).astype(int)
    return np.array([np.bincount(at, minlength=SAMPLE_BINS), np.bincount(at, weights=s, minlength=SAMPLE_BINS)], float)


def sample_threshold(n: np.ndarray, total: np.ndarray, share: float) -> float:
    """The score from which rows are always kept, such that the expected sample has ``share`` of the rows; bins rise."""
    at = np.flatnonzero(n)[::-1]
    n, total = n[at], total[at]
    wanted = share * n.sum()
    whole = np.cumsum(n) - n  # rows above this bin, kept for certain
    rest = np.cumsum(total[::-1])[::-1]  # score of this bin and below
    mu = rest / np.maximum(wanted - whole, 1e-9)
    fits = (wanted > whole) & (total / n <= mu)
    return float(mu[np.flatnonzero(fits)[0]]) if fits.any() else float(rest[0] / wanted)


# --- training ---------------------------------------------------------------------


class _Trainer:
    """Training of all trials of one wave of groups over its stored, binned rows."""

    def __init__(self, state: DataFrame, models: dict[tuple[int, int], _Model], features: int, bins: int):
        self.models = models
        self.start = self.state = state
        if all(m.params.subsample >= 1 for m in models.values()):  # no draw needs the row ids
            self.state = state.withColumn("_row", F.lit(bytearray()))
        self.before: DataFrame | None = None
        self.sample: DataFrame | None = None
        self.features, self.bins = features, bins
        self.trials = 1 + max(t for _, t in models)
        self.outputs = max(m.params.outputs for m in models.values())
        self.round = 0
        self.spark = state.sparkSession

    def _work(self, keys, current: dict | None = None):
        payload = {}
        for key in keys:
            m = self.models[key]
            payload[key] = {
                "params": m.params, "base": m.base, "trial": m.trial, "pending": m.trees[m.stored :], "threshold": m.threshold,
                "current": (current or {}).get(key),
            }
        work = _Work(payload, self.trials, self.outputs, self.features, self.bins, self.round)
        return self.spark.sparkContext.broadcast(work)

    def _rows(self, validation: bool, keys, state: DataFrame | None = None) -> DataFrame:
        rows = (self.state if state is None else state).where(F.col("_val") == F.lit(validation))
        groups = sorted({g for g, _ in keys})
        if len(groups) < len({g for g, _ in self.models}):
            rows = rows.where(F.col("_g").isin(groups))
        return rows

    def run(self, on_round: Callable[[int], None] | None = None) -> None:
        has_val = self.state.where("_val").limit(1).count() > 0
        while any(m.active for m in self.models.values()):
            active = [k for k, m in self.models.items() if m.active]
            self._set_thresholds(active)
            self._hold_sample(active)
            for key, trees in self._grow(active).items():
                self.models[key].trees.append(trees)
            if self.sample is not None:
                self.sample = self.sample.unpersist() and None
            self._apply_trees(active)
            self.round += 1
            metrics = self._evaluate(active) if has_val else {}
            for key in active:
                self.models[key].advance(metrics.get(key))
            if on_round:
                on_round(self.round)
            if self.round % STORE_EVERY == 0 and any(m.active for m in self.models.values()):
                self._cut_lineage()
        self._hold(self.start)
        self._hold(self.start)

    def _set_thresholds(self, active) -> None:
        """For gradient-based sampling: the score from which rows are always kept, such that the
        expected sample has the asked share of rows."""
        keys = [k for k in active if self.models[k].params.subsample < 1 and self.models[k].params.sampling_method != "uniform"]
        if not keys:
            return
        shared = self._work(keys)

        def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            work, acc = shared.value, {}
            for batch in batches:
                for g, _, y, codes, stored in work.parts(batch):
                    for key in (k for k in work.models if k[0] == g):
                        p = work.models[key]["params"]
                        both = acc.setdefault(key, np.zeros((2, SAMPLE_BINS)))
                        both += sample_bins(p, *_gradients(p, work.margin(*key, codes, stored), y))
            yield from emit(acc)

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from emit(shared.value.added(batches, (2, SAMPLE_BINS)))

        def emit(acc: dict) -> Iterator[pa.RecordBatch]:
            for (g, t), (n, total) in acc.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({
                    "_g": pa.array(np.full(len(at), g), pa.int32()), "_t": pa.array(np.full(len(at), t), pa.int32()),
                    "bin": pa.array(at, pa.int32()), "n": n[at], "total": total[at],
                })

        rows = self._rows(False, keys)  # after the first round, the packs have their sums
        parts = (rows.select("_g", "_sums").mapInArrow if self.round else rows.mapInArrow)(
            added if self.round else scores, "_g int, _t int, bin int, n double, total double"
        )
        sums = parts.groupBy("_g", "_t", "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toPandas()
        for (g, t), part in sums.groupby(["_g", "_t"]):
            both = np.zeros((2, SAMPLE_BINS))
            both[:, part["bin"].to_numpy()] = part["n"].to_numpy(), part["total"].to_numpy()
            self.models[g, t].threshold = sample_threshold(*both, self.models[g, t].params.subsample)

    def _hold_sample(self, active) -> None:
        """Hold the rows that any model draws in this round, so that its level jobs read no others; not where they may be
        most of a group's rows."""
        share: dict[int, float] = {}
        for key in active:
            share[key[0]] = share.get(key[0], 0.0) + self.models[key].params.subsample
        if max(share.values()) > SAMPLE_SHARE:
            return
        shared, most = self._work(active), pack_size(self.features + 8 * self.trials * self.outputs)

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            work = shared.value

            def drawn():
                for batch in batches:
                    for g, rows, y, codes, stored in work.parts(batch):
                        used = np.zeros(len(y), bool)
                        for key in (k for k in work.models if k[0] == g):
                            model = work.models[key]
                            grad, hess = _gradients(model["params"], work.margin(*key, codes, stored), y)
                            used |= work.weights(model, rows, grad, hess) > 0
                        margins = np.empty((len(y), 0)) if stored is None else stored
                        yield (g, False), [x[used] for x in (rows, y, codes, margins)]

            for (g, side), arrays in full_packs(drawn(), most):
                yield pack_batch(g, side, arrays)

        self.sample = self._rows(False, active).mapInArrow(draw, STATE).persist(StorageLevel.MEMORY_AND_DISK)

    def _grow(self, active) -> dict[tuple[int, int], list[dict]]:
        trees = {key: [Tree() for _ in range(self.models[key].params.outputs)] for key in active}
        while True:
            asked = {}
            for key, grown in trees.items():
                nodes = [tree.plan(self.models[key].params) for tree in grown]
                if any(nodes):
                    asked[key] = nodes
            if not asked:
                break
            for pack in self._packs(asked):
                current = {
                    key: [tree.arrays(nodes=n) for tree, n in zip(trees[key], asked[key])] for key in pack
                }
                for row in self._best_splits(pack, current):
                    key, k = (row["_g"], row["_t"]), row["_k"]
                    trees[key][k].record(asked[key][k][row["node"]], row)
                for key in pack:  # nodes that no row reached stay leaves
                    for tree, nodes in zip(trees[key], asked[key]):
                        for node in nodes:
                            if tree.split[node] is None:
                                tree.split[node] = (float("-inf"), 0, 0, (0.0, 0.0))
        return {key: [tree.arrays(self.models[key].params) for tree in grown] for key, grown in trees.items()}

    def _packs(self, asked: dict) -> Iterator[list]:
        """Models per job such that one group's histograms stay within the memory of a task."""
        by_trial: dict[int, list] = {}
        for key in asked:
            by_trial.setdefault(key[1], []).append(key)
        pack, size = [], 0
        for trial, keys in sorted(by_trial.items()):
            need = max(sum(map(len, asked[k])) for k in keys) * self.features * self.bins * 16
            if pack and size + need > HISTOGRAM_BYTES:
                yield pack
                pack, size = [], 0
            pack, size = pack + keys, size + need
        if pack:
            yield pack

    def histogram(self, pack, current) -> DataFrame:
        """Gradient and hessian sums of the open nodes of ``current``, per feature and bin."""
        shared = self._work(pack, current)

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            work, acc, size = shared.value, {}, 0
            for batch in batches:
                for g, rows, y, codes, stored in work.parts(batch):
                    for key in (k for k in work.models if k[0] == g):
                        model = work.models[key]
                        grad, hess = _gradients(model["params"], work.margin(*key, codes, stored), y)
                        kept = work.weights(model, rows, grad, hess)
                        ones = kept is None and model["params"].objective == "reg:squarederror"
                        seen = codes
                        if kept is not None:  # the others count for nothing
                            at = np.flatnonzero(kept > 0)
                            grad, hess, seen = grad[at] * kept[at, None], hess[at] * kept[at, None], codes[at]
                        for k, tree in enumerate(model["current"]):
                            slots = int(tree["slot"].max()) + 1
                            if not slots:
                                continue
                            slot = tree["slot"][_leaf_of(tree, seen)].astype(np.int64)
                            use = slot >= 0
                            first, own, sides = slot[use] * work.bins, seen[use], (grad[use, k], None if ones else hess[use, k])
                            if (*key, k) not in acc:
                                acc[(*key, k)] = np.zeros((2, slots, work.features, work.bins))
                                size += acc[(*key, k)].nbytes
                            for i in range(work.features):
                                at = first + own[:, i]
                                for side, value in enumerate(sides):
                                    found = np.bincount(at, weights=value, minlength=slots * work.bins)
                                    acc[(*key, k)][side, :, i] += found.reshape(slots, work.bins)
                    if size > HISTOGRAM_BYTES:
                        yield from emit(acc, work)
                        acc, size = {}, 0
            yield from emit(acc, work)

        def emit(acc: dict, work: _Work) -> Iterator[pa.RecordBatch]:
            for (g, t, k), sums in acc.items():
                grad, hess = sums.reshape(2, -1)
                at = np.flatnonzero(hess)
                slot, rest = np.divmod(at, work.features * work.bins)
                feature, bin_ = np.divmod(rest, work.bins)
                same = lambda v: pa.array(np.full(len(at), v), pa.int32())
                yield pa.RecordBatch.from_pydict({
                    "_g": same(g), "_t": same(t), "_k": same(k), "node": pa.array(slot, pa.int32()),
                    "feature": pa.array(feature, pa.int32()), "bin": pa.array(bin_, pa.int32()),
                    "g": grad[at], "h": hess[at],
                })

        schema = "_g int, _t int, _k int, node int, feature int, bin int, g double, h double"
        partials = self._rows(False, pack, self.sample).mapInArrow(histograms, schema)
        return sum_histogram(partials, ["_g", "_t", "_k", "node", "feature"])

    def _best_splits(self, pack, current) -> list:
        def setting(name: str) -> str:
            values = {(g, t): float(getattr(self.models[g, t].params, name)) for g, t in pack}
            if len(set(values.values())) == 1:
                return f"{next(iter(values.values()))!r}D"
            pairs = ", ".join(f"array({g}, {t}), {v!r}D" for (g, t), v in values.items())
            return f"element_at(map({pairs}), array(_g, _t))"

        names = ("reg_lambda", "gamma", "min_child_weight")
        found = best_split(self.histogram(pack, current), ["_g", "_t", "_k", "node"], *map(setting, names))
        return found.collect()

    def _evaluate(self, active) -> dict[tuple[int, int], float]:
        """The metrics of the round from the sums that ``_apply_trees`` left with the held-out packs."""
        shared = self._work(active)

        def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = shared.value.added(batches, (2,))
            if acc:
                g, t = (pa.array([k[i] for k in acc], pa.int32()) for i in (0, 1))
                total, n = (pa.array([v[i] for v in acc.values()], pa.float64()) for i in (0, 1))
                yield pa.RecordBatch.from_pydict({"_g": g, "_t": t, "total": total, "n": n})

        parts = self._rows(True, active).select("_g", "_sums").mapInArrow(losses, "_g int, _t int, total double, n double")
        found = parts.groupBy("_g", "_t").agg((F.sum("total") / F.sum("n")).alias("v")).collect()
        out = {}
        for row in found:
            key = (row["_g"], row["_t"])
            out[key] = float(np.sqrt(row["v"])) if self.models[key].params.eval_metric in ("rmse", "rmsle") else row["v"]
        return out

    def _apply_trees(self, active) -> None:
        """Bring the margins of all rows up to date with the trees of the round: one walk per row, model and output.

        The rows stay in their partitions and are held; the next job that reads them fills in the new margins. The sums
        that the metrics and the next sample rest on are taken on the way, so their jobs read no rows.
        """
        shared, live = self._work(list(self.models)), set(active)
        trials, outputs = self.trials, self.outputs

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            work = shared.value
            for batch in batches:
                packs = {"_m": [], "_sums": []}
                for held, (g, _, y, codes, stored) in zip(batch.column("_val").to_pylist(), work.parts(batch)):
                    margins, sums = np.zeros((len(codes), trials, outputs)), {}
                    for t in range(trials):
                        if (g, t) in work.models:
                            found = work.margin(g, t, codes, stored)
                            margins[:, t, : found.shape[1]] = found
                            own = work.pack_sums(g, t, held, found, y) if (g, t) in live else None
                            if own is not None:
                                sums[t] = own
                    nothing = np.zeros(next(iter(sums.values())).shape) if sums else np.empty(0)
                    packs["_m"].append(margins.tobytes())
                    packs["_sums"].append(b"".join(sums.get(t, nothing).tobytes() for t in range(trials)))
                columns = [pa.array(packs[n], pa.binary()) if n in packs else batch.column(n) for n in batch.schema.names]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        self._hold(self.state.mapInArrow(apply, self.state.schema).persist(StorageLevel.MEMORY_AND_DISK))
        for model in self.models.values():
            model.stored = len(model.trees)

    def _hold(self, state: DataFrame) -> None:
        """Go on with ``state``; the state before the last is read by no job any more."""
        if self.before is not None and self.before is not self.start:
            self.before.unpersist()
        self.before, self.state = self.state, state

    def _cut_lineage(self) -> None:
        """Write the rows with their margins in the shared folder, partition by partition, so that a lost executor costs
        few rounds."""
        checkpoint_folder(self.spark)
        self._hold(self.state.checkpoint().persist(StorageLevel.MEMORY_AND_DISK))


@dataclass
class BoostResult:
    """``models``: group columns, trial_id, best_round, value, model (text). ``history``: the metric by round."""

    models: DataFrame
    history: DataFrame


def train(
    table: BinnedTable,
    params: list[BoostParams] | DataFrame,
    base: BoostParams = BoostParams(),
    on_round: Callable[[_Trainer], None] | None = None,
) -> BoostResult:
    """Train all ``params`` on every group of a binned table.

    ``params`` is a list for all groups, or a trial table (group columns, ``trial_id``,
    ``params map<string,double>``) whose values change ``base``.
    """
    spark = table.spark
    results = Scratch(spark)
    for number in table.waves:
        wave = table.wave(number)
        models = {}
        for g, trials in _wanted(params, table, wave, base).items():
            for t, (trial, p) in enumerate(trials):
                models[g, t] = _Model(p, wave.means[g] if p.objective == "reg:squarederror" else 0.0, trial)
        trainer = _Trainer(wave.rows, models, table.width, table.max_bin)
        trainer.run((lambda _: on_round(trainer)) if on_round else None)
        _write_models(spark, models, wave, table.features, table.key_schema, results)
        if len(table.waves) > 1:
            table.release(number)
    read = lambda name: spark.read.parquet(f"{results.path}/{name}")
    return BoostResult(read("models"), read("history"))


def boost_many(
    df: DataFrame,
    features: list[str] | str,
    label: str,
    params: list[BoostParams] | DataFrame,
    group_columns: list[str] | None = None,
    validation: Column | None = None,
    max_bin: int = 256,
    base: BoostParams = BoostParams(),
    on_round: Callable[[_Trainer], None] | None = None,
    exact_bins: bool = False,
) -> BoostResult:
    """Bin ``df`` and train all ``params`` on every group of it at once.

    ``features`` are columns or one array column; ``validation`` marks the held-out
    rows. Keys are never features.
    """
    table = BinnedTable(df, features, label, group_columns, validation, max_bin, exact_bins)
    try:
        return train(table, params, base, on_round)
    finally:
        table.close()


def boost(
    train: DataFrame, val: DataFrame | None, features: list[str] | str, label: str, params: BoostParams, max_bin: int = 256
) -> BoostResult:
    """Train one model on a whole table, with the metric of ``val`` after every round."""
    columns = [label, *([features] if isinstance(features, str) else features)]
    rows = train.select(*columns).withColumn("_held", F.lit(False))
    if val is not None:
        rows = rows.unionByName(val.select(*columns).withColumn("_held", F.lit(True)))
    return boost_many(rows, features, label, [params], validation=F.col("_held"), max_bin=max_bin)


def _wanted(params: list[BoostParams] | DataFrame, table: BinnedTable, wave: Wave, base: BoostParams) -> dict:
    """The (trial id, settings) of every group of a wave that has training rows."""
    if isinstance(params, list):
        return {g: list(enumerate(params)) for g in wave.edges}
    extra = [c for c in ("settings",) if c in params.columns]
    rows = table.trials(params, wave.number).select("_g", "trial_id", "params", *extra).orderBy("_g", "trial_id").collect()
    wanted: dict[int, list] = {}
    for row in rows:
        if row["_g"] in wave.edges:
            wanted.setdefault(row["_g"], []).append((row["trial_id"], with_params(base, **row["params"], **(row["settings"] if extra else {}))))
    return wanted


def root_histogram(
    df: DataFrame, features: list[str] | str, label: str, params: BoostParams, max_bin: int = 256, exact_bins: bool = False
) -> DataFrame:
    """Gradient and hessian sums of a first tree's root: ``class``, ``node``, ``feature``, ``bin``, ``g``, ``h``."""
    table = BinnedTable(df, features, label, max_bin=max_bin, exact_bins=exact_bins)
    trainer = _Trainer(table.wave(0).rows, {(0, 0): _Model(params)}, table.width, max_bin)
    current = {(0, 0): [Tree().arrays(nodes=[0]) for _ in range(params.outputs)]}
    found = trainer.histogram([(0, 0)], current).withColumnRenamed("_k", "class").drop("_g", "_t")
    stored = Scratch(df.sparkSession).store(found, "histogram")
    table.close()
    return stored


def _write_models(spark: SparkSession, models, wave: Wave, features, key_schema, results: Scratch) -> None:
    """Append the models of a wave to the result tables, a bounded amount of text at a time."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_schema)
    head = f"{fields}, " if fields else ""

    def append(rows: list[tuple], columns: str, name: str) -> None:
        spark.createDataFrame(rows, head + columns).write.mode("append").parquet(f"{results.path}/{name}")

    texts, history, size = [], [], 0
    for (g, _), m in models.items():
        key, p = wave.members[g], m.params
        text = model_text(p.objective, p.outputs, m.base, features, m.trees, wave.edges[g])
        texts.append((*key, m.trial, m.best_round(), m.history[-1] if m.history else None, text))
        history += [(*key, m.trial, i, p.eval_metric, float(v)) for i, v in enumerate(m.history)]
        m.trees, size = [], size + len(text)
        if size > TEXT_BYTES:
            append(texts, MODEL_COLUMNS, "models")
            texts, size = [], 0
    append(texts, MODEL_COLUMNS, "models")
    append(history, HISTORY_COLUMNS, "history")


# --- settings ---------------------------------------------------------------------


def held_out(keys: list[str], test_size: float = 0.25, seed: int = 42) -> Column:
    """A validation mark from a hash of key columns."""
    return drawn_below(test_size, seed, *keys)


# Other names under which settings are known.
ALIASES = {
    "num_leaves": "max_leaves", "n_estimators": "num_estimators", "num_boost_round": "num_estimators", "early_stopping_round": "early_stopping_rounds",
    "early_stopping_rounds": "early_stopping_rounds", "eta": "learning_rate", "lambda": "reg_lambda", "reg_lambda": "reg_lambda", "metric": "eval_metric",
    "num_classes": "num_class",
}
#: Settings of a space that are read before a model is trained, or say how and where it is.
OUTSIDE = {"max_bin", "tree_method", "device", "verbosity", "verbose", "verbose_eval", "nthread", "n_jobs", "num_workers"}


def with_params(base: BoostParams, **values) -> BoostParams:
    """Settings changed by a trial: names of ``BoostParams`` or their usual other names, also nested
    (``params.gamma``). A name that is no setting is an error; those in ``OUTSIDE`` belong to the search."""
    whole = {"num_estimators", "max_depth", "max_leaves", "early_stopping_rounds", "num_class", "seed"}
    named = {k.rsplit(".", 1)[-1]: v for k, v in values.items()}
    named = {ALIASES.get(k, k): v for k, v in named.items() if k not in OUTSIDE}
    unknown = sorted(named.keys() - BoostParams.__dataclass_fields__.keys())
    if unknown:
        raise ValueError(f"no settings of a model: {', '.join(unknown)}")
    return replace(base, **{k: int(v) if k in whole else v for k, v in named.items()})

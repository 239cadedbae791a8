"""Boosting of one small group inside a task: the trees that the level jobs of ``boost`` grow, from the same plan.

Bins, gradients, growth plan, sampling and stopping are those of ``bins`` and ``boost``; only the histograms are
summed with numpy, since all rows of the group are at hand.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

from fleet.plans.boost import (
    BoostParams, Tree, _gradients, _leaf_of, _losses, _Model, row_weights, sample_bins, sample_threshold, with_params,
)
from fleet.plans.tree_models import model_text


def exact_edges(x: np.ndarray, max_bin: int) -> list[np.ndarray]:
    """Percentiles with linear interpolation of every column, as ``quantile_bins`` gives them."""
    out = []
    for column in x.T:
        values = np.sort(column[~np.isnan(column)])
        if not len(values):
            out.append(np.empty(0))
            continue
        at = np.arange(1, max_bin) / max_bin * (len(values) - 1)
        low, high = values[np.floor(at).astype(np.int64)], values[np.ceil(at).astype(np.int64)]
        out.append(np.unique(low + (high - low) * (at - np.floor(at))))
    return out


def best_splits(grad: np.ndarray, hess: np.ndarray, params: BoostParams) -> list[dict | None]:
    """The best split of every node from sums ``(node, feature, bin)``; first feature, then first bin, among equals."""
    gl, hl = grad.cumsum(axis=2), hess.cumsum(axis=2)
    ga, ha = gl[:, :, -1:], hl[:, :, -1:]
    score = lambda g, h: g**2 / (h + params.reg_lambda)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (score(gl, hl) + score(ga - gl, ha - hl) - score(ga, ha)) - params.gamma
    allowed = (hl >= params.min_child_weight) & (ha - hl >= params.min_child_weight)
    gain = np.where(allowed, gain, -np.inf).reshape(len(grad), -1)
    out: list[dict | None] = []
    for node, at in enumerate(gain.argmax(axis=1)):
        f, b = divmod(int(at), grad.shape[2])
        if not hess[node].any():
            out.append(None)
            continue
        sums = {"gl": gl[node, f, b], "hl": hl[node, f, b], "ga": ga[node, f, 0], "ha": ha[node, f, 0]}
        out.append({"gain": float(gain[node, at]), "feature": f, "bin": b, **{k: float(v) for k, v in sums.items()}})
    return out


class LocalTrainer:
    """All trials of one group, round by round; halving hooks see it like the trainer of the level jobs."""

    def __init__(self, x: np.ndarray, y: np.ndarray, held: np.ndarray, rows: np.ndarray, max_bin: int):
        self.edges = exact_edges(x[~held], max_bin)
        self.codes = np.column_stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)]).astype(np.int64)
        self.y, self.held, self.rows, self.bins = y, held, rows, max_bin
        self.cells = np.arange(x.shape[1], dtype=np.int64) * max_bin
        self.models: dict[tuple[int, int], _Model] = {}
        self.round = 0

    def run(self, trials: dict[int, BoostParams], on_round: Callable | None = None) -> None:
        mean = float(self.y[~self.held].mean())
        self.models = {(0, t): _Model(p, mean if p.objective == "reg:squarederror" else 0.0, t) for t, p in trials.items()}
        margins = {key: np.full((len(self.y), m.params.outputs), m.base) for key, m in self.models.items()}
        while any(m.active for m in self.models.values()):
            active = [key for key, m in self.models.items() if m.active]
            for key in active:
                trees = self._grow(self.models[key], margins[key])
                for k, tree in enumerate(trees):
                    margins[key][:, k] += tree["value"][_leaf_of(tree, self.codes)]
                self.models[key].trees.append(trees)
            self.round += 1
            for key in active:
                self.models[key].advance(self._metric(self.models[key].params, margins[key]))
            if on_round:
                on_round(self)

    def text(self, trial: int, features: list[str] | str) -> str:
        model = self.models[0, trial]
        return model_text(model.params.objective, model.params.outputs, model.base, features, model.trees, self.edges)

    def _metric(self, params: BoostParams, margin: np.ndarray) -> float | None:
        if not self.held.any():
            return None
        mean = float(_losses(params, margin[self.held], self.y[self.held]).mean())
        return float(np.sqrt(mean)) if params.eval_metric in ("rmse", "rmsle") else mean

    def _grow(self, model: _Model, margin: np.ndarray) -> list[dict]:
        p, train = model.params, ~self.held
        codes, flat = self.codes[train], self.codes[train] + self.cells
        grad, hess = _gradients(p, margin[train], self.y[train])
        if p.subsample < 1 and p.sampling_method != "uniform":
            model.threshold = sample_threshold(*sample_bins(p, grad, hess), p.subsample)
        kept = row_weights(p, model.threshold, self.round, model.trial, self.rows[train], grad, hess)
        use = np.ones(len(codes), bool) if kept is None else kept > 0
        if kept is not None:
            grad, hess = grad * kept[:, None], hess * kept[:, None]
        out = []
        for k in range(p.outputs):
            tree = Tree()
            while nodes := tree.plan(p):
                shape = tree.arrays(nodes=nodes)
                slot = shape["slot"][_leaf_of(shape, codes)].astype(np.int64)
                here = use & (slot >= 0)
                size = len(self.cells) * self.bins
                at = (flat[here] + slot[here, None] * size).ravel()
                sums = [
                    np.bincount(at, weights=np.repeat(v[here, k], len(self.cells)), minlength=len(nodes) * size).reshape(len(nodes), len(self.cells), self.bins)
                    for v in (grad, hess)
                ]
                for node, found in zip(nodes, best_splits(*sums, p)):
                    if found:
                        tree.record(node, found)
                    else:  # no row reaches it
                        tree.split[node] = (float("-inf"), 0, 0, (0.0, 0.0))
            out.append(tree.arrays(p))
        return out


class BoostFit:
    """The default ``fit_fn`` of a grouped search: boosted trees of one group, all its trials at once."""

    def __init__(self, features: list[str] | str, label: str, held: str, row: str, base: BoostParams, max_bin: int, on_round: Callable | None = None):
        self.features, self.label, self.held, self.row = features, label, held, row
        self.base, self.max_bin, self.on_round = base, max_bin, on_round

    def fit_all(self, pdf: pd.DataFrame, trials: dict[int, dict]) -> dict[int, dict]:
        held = pdf[self.held].to_numpy(bool)
        if held.all():
            return {t: {} for t in trials}
        x = np.array(pdf[self.features].tolist(), float) if isinstance(self.features, str) else pdf[self.features].to_numpy(float)
        trainer = LocalTrainer(x, pdf[self.label].to_numpy(float), held, pdf[self.row].to_numpy(np.int64), self.max_bin)
        trainer.run({t: with_params(self.base, **p) for t, p in trials.items()}, self.on_round)
        out = {}
        for (_, t), m in trainer.models.items():
            history = [{"round": i, "metric": m.params.eval_metric, "value": float(v)} for i, v in enumerate(m.history)]
            value = m.history[-1] if m.history else None
            out[t] = {"value": value, "best_round": m.best_round(), "model": trainer.text(t, self.features), "history": history}
        return out


"""A small histogram booster for calendar-sized tables (D6q–D11q).

Squared error, second-order leaf values with both penalties, rows and features drawn
for each tree, trees grown level by level or leaf by leaf, early stopping.  It fits one
setting on a few hundred rows inside one Spark task; Spark deals the settings out
(:mod:`tillroll.operators.model_forecasts`).  Larger tables go to Spark ML.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 255


@dataclass(frozen=True)
class Settings:
    """``leaves`` 0 grows level by level to ``max_depth``, else the best leaf first."""

    rounds: int = 100
    step_size: float = 0.3
    max_depth: int = 6
    min_child_weight: float = 1.0
    row_share: float = 1.0
    feature_share: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    leaves: int = 0
    seed: int = 42


@dataclass
class Tree:
    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, threshold, left, right = map(np.array, (self.feature, self.threshold, self.left, self.right))
        at = np.zeros(len(x), int)
        rows = np.arange(len(x))
        while True:
            go = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
            if (go == at).all():  # a leaf is its own child
                return np.array(self.value)[at]
            at = go


@dataclass
class Booster:
    base: float
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        return sum((t.predict(x) for t in self.trees), np.full(len(x), self.base))


def shrunk(g, alpha: float):
    """The gradient sum less the absolute penalty."""
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def _tree(codes: np.ndarray, edges: list[np.ndarray], order: np.ndarray, grad: np.ndarray, rows: np.ndarray, feats: np.ndarray,
          s: Settings) -> Tree:
    """All nodes of a level are cut at once: rows lie grouped by node, sorted by each feature in
    turn, so that running sums of the gradient give every cut's gain."""
    tree = Tree([], [], [], [], [])
    gains: list[float] = []

    def leaves(sums: np.ndarray, counts: np.ndarray) -> int:
        first = len(tree.value)
        value = -shrunk(sums, s.reg_alpha) / (counts + s.reg_lambda) * s.step_size
        at = range(first, first + len(counts))
        for column, v in ((tree.feature, [0] * len(at)), (tree.threshold, [0.0] * len(at)), (tree.left, at), (tree.right, at), (tree.value, value.tolist()), (gains, [0.0] * len(at))):
            column.extend(v)
        return first

    bag = np.zeros(len(codes), bool)
    bag[rows] = True
    by = order[feats]
    by = by[bag[by]].reshape(len(feats), -1)  # each feature's rows, sorted by it
    node = np.zeros(len(codes), np.int16)  # short: sorted by radix
    names = np.array([leaves(grad[rows].sum()[None], np.array([len(rows)]))])
    least = max(1.0, s.min_child_weight)
    score = lambda sums, n: shrunk(sums, s.reg_alpha) ** 2 / np.maximum(n + s.reg_lambda, 1e-12)
    for _ in range(s.max_depth):
        by = np.take_along_axis(by, np.argsort(node[by], axis=1, kind="stable"), 1)
        of, m = node[by[0]], by.shape[1]
        start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        size = np.diff(np.concatenate([start, [m]]))
        seg = np.repeat(np.arange(len(start)), size)
        total = np.cumsum(grad[by], 1)
        before = np.where(start > 0, total[:, start - 1], 0.0)
        all_ = total[:, start + size - 1] - before
        left, n_left = total - before[:, seg], np.arange(m) - start[seg] + 1
        n_right = size[seg] - n_left
        value = codes[by, feats[:, None]]
        gain = score(left, n_left) + score(all_[:, seg] - left, n_right) - score(all_, size)[:, seg]
        same = np.ones_like(gain, bool)
        same[:, :-1] = value[:, 1:] == value[:, :-1]
        gain[same | (n_left < least) | (n_right < least)] = 0.0
        best = np.maximum.reduceat(gain, start, 1)
        feature = best.argmax(0)
        top = best.max(0)
        split = top > 1e-9
        if not split.any():
            break
        hit = np.flatnonzero((gain[feature[seg], np.arange(m)] == top[seg]) & split[seg])
        at = hit[np.concatenate([[True], seg[hit][1:] != seg[hit][:-1]])]  # the first best cut of each node
        cut, f = np.zeros(len(start), int), feats[feature]
        cut[seg[at]] = value[feature[seg[at]], at]
        low = codes[by[0], f[seg]] <= cut[seg]
        kept = split[seg]
        child = 2 * (np.cumsum(split) - 1)[seg] + ~low
        n = 2 * int(split.sum())
        first = leaves(np.bincount(child[kept], grad[by[0]][kept], n), np.bincount(child[kept], minlength=n))
        for k, (name, own, bin_) in enumerate(zip(names[split].tolist(), f[split].tolist(), cut[split].tolist(), strict=True)):
            tree.feature[name], tree.threshold[name] = own, float(edges[own][bin_])
            tree.left[name], tree.right[name] = first + 2 * k, first + 2 * k + 1
        for name, g in zip(names[split].tolist(), top[split].tolist(), strict=True):
            gains[name] = g
        node[by[0]] = np.where(kept, child, -1)
        by = by[node[by] >= 0].reshape(len(feats), -1)
        names = np.arange(first, first + n)
    return _best_first(tree, gains, s.leaves) if s.leaves else tree


def _best_first(tree: Tree, gains: list[float], leaves: int) -> Tree:
    """The tree that growing the best leaf first gives: nodes beyond ``leaves`` leaves stay leaves
    (a node's best cut does not depend on other nodes)."""
    open_, grown = [0], set()
    while len(grown) + 1 < leaves:
        able = [k for k in open_ if gains[k] > 0]
        if not able:
            break
        k = max(able, key=lambda i: (gains[i], -i))
        grown.add(k)
        open_.remove(k)
        open_ += [tree.left[k], tree.right[k]]
    for k in range(len(tree.value)):
        if k not in grown:
            tree.left[k] = tree.right[k] = k
    return tree


def fit(x: np.ndarray, y: np.ndarray, s: Settings, val: tuple[np.ndarray, np.ndarray] | None = None, patience: int = 0,
        metric: str = "rmse") -> Booster:
    """With ``val`` and ``patience``: stop after so many rounds without a better ``metric`` on
    ``val`` and keep the trees up to the best one."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    edges = []
    for c in x.T:  # cuts half way between neighbouring values, at most BINS of them
        values = np.unique(c)
        if len(values) > BINS:
            values = np.unique(np.quantile(c, np.linspace(0, 1, BINS)))
        edges.append((values[1:] + values[:-1]) / 2)
    codes = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)]).astype(np.int16)
    order = np.argsort(codes, axis=0, kind="stable").T
    rng = np.random.default_rng(s.seed)
    n, d = x.shape
    model = Booster(float(y.mean()), [])
    now = np.full(n, model.base)
    told = None if val is None else np.full(len(val[1]), model.base)
    best, best_at = np.inf, 0
    for k in range(s.rounds):
        rows = np.arange(n) if s.row_share >= 1 else np.sort(rng.choice(n, max(1, int(n * s.row_share)), replace=False))
        feats = np.arange(d) if s.feature_share >= 1 else np.sort(rng.choice(d, max(1, int(d * s.feature_share)), replace=False))
        tree = _tree(codes, edges, order, now - y, rows, feats, s)
        model.trees.append(tree)
        now = now + tree.predict(x)
        if told is not None and patience:
            told = told + tree.predict(val[0])
            error = mape(val[1], told) if metric == "mape" else float(np.sqrt(np.mean((val[1] - told) ** 2)))
            if error < best:
                best, best_at = error, k + 1
            elif k + 1 - best_at >= patience:
                break
    if told is not None and patience:
        del model.trees[best_at:]
    return model


def mape(actual: np.ndarray, predicted: np.ndarray) -> float:
    """Mean absolute percentage error over the non-zero actuals, 0 without any."""
    some = actual != 0
    return float(np.mean(np.abs((actual[some] - predicted[some]) / actual[some])) * 100) if some.any() else 0.0

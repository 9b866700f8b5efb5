"""Gradient-boosted trees: fit, numpy scoring, SQL scoring.

``fit`` sees at most the sample bound its caller states; ``fit_parts`` fits on all rows of a table in
SQL functions, of which only sums per node, feature and value come to the driver.  Scoring runs in tasks, either over
flat numpy node arrays or as one SQL expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Self

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.common import fixed

LEAF = -1
# Leaf values are multiples of 1 / GRID and sums are taken in multiples of 1 / UNIT, so that they are
# exact: no result depends on the order in which tasks add up, and there are few distinct margins.
GRID = 1 << 10
UNIT = 1 << 20


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays; ``feature`` is ``LEAF`` at leaves, children are node numbers."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values for each row of ``x``; a NaN feature goes right."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while (inner := self.feature[at] != LEAF).any():
                goes_left = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
                at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
            total += self.value[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -60, 60)))

    def margin_sql(self, features: list[Column]) -> Column:
        """The same sum as a SQL expression."""

        def node(n: int) -> Column:
            if self.feature[n] == LEAF:
                return F.lit(float(self.value[n]))
            test = features[self.feature[n]] <= F.lit(float(self.threshold[n]))
            return F.when(test, node(self.left[n])).otherwise(node(self.right[n]))

        return sum((node(int(root)) for root in self.roots), F.lit(float(self.base)))


@dataclass
class _Nodes:
    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    @classmethod
    def empty(cls) -> Self:
        return cls([], [], [], [], [])

    def add(self, feature: int, threshold: float, value: float) -> int:
        for column, x in zip((self.feature, self.threshold, self.left, self.right, self.value), (feature, threshold, 0, 0, value)):
            column.append(x)
        return len(self.feature) - 1


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: dict[int, int] | None = None,
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    min_rows: int = 5,
    penalty: float = 1.0,
) -> Forest:
    """Logistic boosting by Newton steps on binned features.

    ``monotone`` maps a feature to +1 (the score may only rise with it) or -1 (only fall): a split
    that breaks the sign is refused, and both children's values are kept on their own side of the
    split's middle, so the rule holds for whole trees and for their sum.
    """
    monotone = monotone or {}
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate0 / (1 - rate0)))
    margin = np.full(n, base)
    nodes, roots = _Nodes.empty(), []

    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = y - p, p * (1 - p)

        def weight(rows: np.ndarray, low: float, high: float) -> float:
            return float(np.clip(g[rows].sum() / (h[rows].sum() + penalty), low, high))

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            own = weight(rows, low, high)
            best = (1e-9, -1, 0)
            if level < depth and len(rows) >= 2 * min_rows:
                total_g, total_h = g[rows].sum(), h[rows].sum()
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[rows, j]
                    count = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                    gl = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
                    gr, hr = total_g - gl, total_h - hl
                    wl, wr = np.clip(gl / (hl + penalty), low, high), np.clip(gr / (hr + penalty), low, high)
                    gain = gl**2 / (hl + penalty) + gr**2 / (hr + penalty) - total_g**2 / (total_h + penalty)
                    allowed = (count >= min_rows) & (len(rows) - count >= min_rows)
                    if sign := monotone.get(j):
                        allowed &= sign * (wr - wl) >= 0
                    if allowed.any():
                        k = int(np.argmax(np.where(allowed, gain, -np.inf)))
                        if gain[k] > best[0]:
                            best = (float(gain[k]), j, k)
            _, j, k = best
            if j < 0:
                at = nodes.add(LEAF, 0.0, rate * own)
                margin[rows] += rate * own
                return at
            goes_left = binned[rows, j] <= k
            below, above = rows[goes_left], rows[~goes_left]
            at = nodes.add(j, float(cuts[j][k]), 0.0)
            bounds_left, bounds_right = (low, high), (low, high)
            if sign := monotone.get(j):
                middle = (weight(below, low, high) + weight(above, low, high)) / 2
                bounds_left, bounds_right = ((low, middle), (middle, high)) if sign > 0 else ((middle, high), (low, middle))
            nodes.left[at] = grow(below, level + 1, *bounds_left)
            nodes.right[at] = grow(above, level + 1, *bounds_right)
            return at

        roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
    return Forest(
        np.array(roots),
        np.array(nodes.feature),
        np.array(nodes.threshold),
        np.array(nodes.left),
        np.array(nodes.right),
        np.array(nodes.value),
        base,
    )


def _cuts(values: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    """The distinct inner quantiles of values that occur ``n`` times each, as ``np.quantile`` has them."""
    order = np.argsort(values)
    values, ends = values[order].astype(float), np.cumsum(n[order])
    place = np.linspace(0, 1, bins + 1)[1:-1] * (ends[-1] - 1)
    low, high = (values[np.searchsorted(ends, at, side="right")] for at in (np.floor(place), np.ceil(place)))
    return np.unique(low + (high - low) * (place - np.floor(place)))


@dataclass
class _Growing:
    """A forest while it is grown; ``open`` are the nodes of its last tree that may yet be split."""

    base: float
    nodes: _Nodes
    roots: list[int]
    open: list[int]

    def leaf_sql(self, x: Column, own) -> Column:
        """``own(node)`` of the leaf of the last tree."""

        def node(n: int) -> Column:
            if self.nodes.feature[n] == LEAF:
                return own(n)
            return F.when(x[self.nodes.feature[n]] <= F.lit(self.nodes.threshold[n]), node(self.nodes.left[n])).otherwise(node(self.nodes.right[n]))

        return node(self.roots[-1])

    def forest(self) -> Forest:
        columns = (self.nodes.feature, self.nodes.threshold, self.nodes.left, self.nodes.right, self.nodes.value)
        return Forest(np.array(self.roots, int), *(np.array(c) for c in columns), self.base)


def _by_part(values: dict[int, Column]) -> Column:
    found = F.lit(None)
    for p, value in values.items():
        found = F.when(F.col("part") == p, value).otherwise(found)
    return found


def _sums(rows: DataFrame) -> dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]]:
    """Per part, node and feature its values, and for each the examples, gradients and curvatures."""
    chance = 1 / (1 + F.exp(-F.col("margin") / GRID))
    slope = F.col("genuine") * UNIT - F.col("n") * F.rint(chance * UNIT).cast("long")
    curve = F.col("n") * F.rint(chance * (1 - chance) * UNIT).cast("long")
    rows = rows.select("part", "node", F.posexplode("x").alias("feature", "value"), "n", slope.alias("slope"), curve.alias("curve"))
    found = rows.groupBy("part", "node", "feature", "value").agg(*(F.sum(c).alias(c) for c in ("n", "slope", "curve"))).toPandas()
    return {
        key: (own["value"].to_numpy(), np.stack([own["n"], own["slope"] / UNIT, own["curve"] / UNIT]).astype(float))
        for key, own in found.groupby(["part", "node", "feature"])
    }


def _binned(values: np.ndarray, sums: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    places = np.searchsorted(cuts, values, side="left")
    return np.stack([np.bincount(places, row, len(cuts) + 1) for row in sums])


def _best_split(sums: list[np.ndarray], min_rows: int, penalty: float) -> tuple[int, int] | None:
    """The feature and the last bin on the left; ``sums`` are by feature and bin."""
    best, found = 1e-9, None
    for j, own in enumerate(sums):
        if own.shape[1] < 2:
            continue
        rows, g, h = own.sum(axis=1)
        count, gl, hl = np.cumsum(own, axis=1)[:, :-1]
        gain = gl**2 / (hl + penalty) + (g - gl) ** 2 / (h - hl + penalty) - g**2 / (h + penalty)
        gain = np.where((count >= min_rows) & (rows - count >= min_rows), gain, -np.inf)
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, found = float(gain[k]), (j, k)
    return found


def fit_parts(
    examples: DataFrame, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 64, min_rows: int = 5, penalty: float = 1.0
) -> dict[int, tuple[Forest, np.ndarray, np.ndarray, np.ndarray]]:
    """``fit`` for each part of ``examples`` (``part, x array<int>, unseen, n, genuine``) on those that are not ``unseen``.

    Examples of equal features are counted in one row: ``n``, of which ``genuine``.  A level of a tree of
    all parts is one pass, which gives the driver sums per node, feature and value; the caller bounds the
    distinct values.  With each forest come the distinct margins of the unseen examples, how many have
    each, and how many of these are genuine.  A part without unseen examples or of one verdict has none.
    """
    totals = examples.groupBy("part", "unseen").agg(F.sum("n").alias("n"), F.sum("genuine").alias("genuine")).collect()
    told = {(r["part"], r["unseen"]): (int(r["n"]), int(r["genuine"])) for r in totals}
    growing = {}
    for p in sorted(p for p, unseen in told if not unseen and (p, True) in told):
        n, genuine = told[p, False]
        if 0 < genuine < n:
            rate0 = np.clip(genuine / n, 1e-3, 1 - 1e-3)
            growing[p] = _Growing(float(np.rint(np.log(rate0 / (1 - rate0)) * GRID) / GRID), _Nodes.empty(), [], [])
    if not growing:
        return {}
    x = F.col("x")
    rows = examples.where(F.col("part").isin(list(growing)))
    rows = rows.withColumn("margin", _by_part({p: F.lit(round(own.base * GRID)).cast("long") for p, own in growing.items()}))
    cuts: dict[int, list[np.ndarray]] = {}
    for _ in range(trees):
        for own in growing.values():
            own.roots.append(own.nodes.add(LEAF, 0.0, 0.0))
            own.open = [own.roots[-1]]
        for _level in range(depth):
            if not any(own.open for own in growing.values()):
                break
            node = _by_part({p: own.leaf_sql(x, lambda n, own=own: F.lit(n if n in own.open else None).cast("int")) for p, own in growing.items()})
            found = _sums(rows.where(~F.col("unseen")).withColumn("node", node).where("node is not null"))
            width = 1 + max(j for _, _, j in found)
            if not cuts:
                cuts = {p: [_cuts(found[p, own.roots[-1], j][0], found[p, own.roots[-1], j][1][0], bins) for j in range(width)] for p, own in growing.items()}
            for p, own in growing.items():
                after = []
                for at in own.open:
                    sums = [_binned(*found[p, at, j], cuts[p][j]) for j in range(width)]
                    _, g, h = sums[0].sum(axis=1)
                    own.nodes.value[at] = float(np.rint(rate * g / (h + penalty) * GRID) / GRID)
                    if (split := _best_split(sums, min_rows, penalty)) is None:
                        continue
                    j, k = split
                    left, right = (own.nodes.add(LEAF, 0.0, 0.0) for _ in range(2))
                    own.nodes.feature[at], own.nodes.threshold[at], own.nodes.left[at], own.nodes.right[at] = j, float(cuts[p][j][k]), left, right
                    for child, part in ((left, sums[j][:, : k + 1]), (right, sums[j][:, k + 1 :])):
                        own.nodes.value[child] = float(np.rint(rate * part[1].sum() / (part[2].sum() + penalty) * GRID) / GRID)
                    after += [left, right]
                own.open = after
        value = _by_part({p: own.leaf_sql(x, lambda n, own=own: F.lit(round(own.nodes.value[n] * GRID)).cast("long")) for p, own in growing.items()})
        rows = fixed(rows.withColumn("margin", F.col("margin") + value), "margins")
    scored = rows.where("unseen").groupBy("part", "margin").agg(F.sum("n").alias("n"), F.sum("genuine").alias("genuine")).toPandas()
    unseen = {p: scored[scored["part"] == p] for p in growing}
    return {p: (own.forest(), unseen[p]["margin"].to_numpy() / GRID, unseen[p]["n"].to_numpy(), unseen[p]["genuine"].to_numpy()) for p, own in growing.items()}

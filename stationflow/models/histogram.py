"""Boosted trees of all stations and strategies in one job.

The rows of a station are hourly, so the calendar bounds them (8,784 a year) however many trips they
stand for: a task holds the rows of one station at a time, as small bin numbers, and stations run
beside each other.  Fitting is one shuffle of the training rows; a pass per level of each tree over
all rows of all stations, with a shuffle of their histograms, would be some 500 of them.

Trees grow level by level on histograms of the residuals, as ``TreeParams`` says: the first tree fits
the counts themselves with weight one, the others what is left with the learning rate as weight.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stationflow.config import lag_names
from stationflow.models.components import component_inputs
from stationflow.models.forecast import ModelInputs
from stationflow.models.registry import split_importance, top_features
from stationflow.models.trees import TreeParams

NODES = (
    "station_id string, strategy string, tree_id int, node_id int, feature_index int, threshold double, "
    "left int, right int, value double, tree_weight double"
)
INPUTS = "station_id string, strategy string, selected array<int>, mean array<double>, loadings array<double>, explained_variance double"
# A split must better the squared error by this share of the counts' own.
LEAST_GAIN = 1e-10


def split_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Where a feature may be cut: between its distinct values, or between quantiles if those are too many."""
    distinct = np.unique(values)
    if len(distinct) > bins:
        low = np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower"))
        places = np.searchsorted(distinct, low)
        places = places[places + 1 < len(distinct)]
    else:
        places = np.arange(len(distinct) - 1)
    return (distinct[places] + distinct[places + 1]) / 2


class Learner:
    """Boosting on the rows of one series; ``x`` has a column per input."""

    def __init__(self, x: np.ndarray, y: np.ndarray, params: TreeParams):
        self.params, self.y = params, y
        self.cuts = [split_points(column, params.bins) for column in x.T]
        self.width = max(len(c) for c in self.cuts) + 1
        self.bins = np.stack([np.searchsorted(c, column, "left") for c, column in zip(self.cuts, x.T)], 1).astype(np.int32)
        # Place of each row's bin among all bins of all inputs.
        self.base = self.bins + np.arange(x.shape[1], dtype=np.int32) * self.width

    def trees(self) -> list[list[tuple]]:
        """Per tree its nodes: id, input, threshold, left, right, value; a leaf has input -1."""
        predicted, found = np.zeros(len(self.y)), []
        least = LEAST_GAIN * float(((self.y - self.y.mean()) ** 2).sum())
        for n in range(self.params.trees):
            nodes, fitted = self.tree(self.y - predicted, least)
            predicted += fitted * (self.params.rate if n else 1.0)
            found.append(nodes)
        return found

    def tree(self, residual: np.ndarray, least: float) -> tuple[list[tuple], np.ndarray]:
        """One tree and its value for each row; children of a node lie at twice its id plus one and two."""
        inputs, width = self.bins.shape[1], self.width
        nodes, fitted = [], np.empty(len(residual))
        rows, at = np.arange(len(residual)), np.zeros(len(residual), np.int32)
        ids = np.zeros(1, np.int64)
        for depth in range(self.params.depth + 1):
            count = np.bincount(at, minlength=len(ids))
            total = np.bincount(at, residual[rows], minlength=len(ids))
            value = total / count
            if depth == self.params.depth:
                split = np.zeros(len(ids), bool)
            else:
                key = (at[:, None] * (inputs * width) + self.base[rows]).ravel()
                shape, size = (len(ids), inputs, width), len(ids) * inputs * width
                low_n = np.bincount(key, minlength=size).reshape(shape).cumsum(2)[:, :, :-1]
                low_g = np.bincount(key, np.repeat(residual[rows], inputs), size).reshape(shape).cumsum(2)[:, :, :-1]
                high_n, high_g = count[:, None, None] - low_n, total[:, None, None] - low_g
                able = (low_n >= self.params.min_rows) & (high_n >= self.params.min_rows)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(able, low_g**2 / low_n + high_g**2 / high_n, -np.inf).reshape(len(ids), -1)
                best = gain.argmax(1) if gain.shape[1] else np.zeros(len(ids), np.int64)
                top = gain[np.arange(len(ids)), best] if gain.shape[1] else np.full(len(ids), -np.inf)
                split = top - total**2 / count > least
            feature, cut = np.divmod(best, width - 1) if split.any() else (np.zeros(len(ids), np.int64),) * 2
            for n, node in enumerate(ids.tolist()):
                if split[n]:
                    nodes.append((node, int(feature[n]), float(self.cuts[feature[n]][cut[n]]), 2 * node + 1, 2 * node + 2, float(value[n])))
                else:
                    nodes.append((node, -1, 0.0, -1, -1, float(value[n])))
            done = ~split[at]
            fitted[rows[done]] = value[at[done]]
            if not split.any():
                return nodes, fitted
            rows, at = rows[~done], at[~done]
            right = self.bins[rows, feature[at]] > cut[at]
            place = np.cumsum(split) - 1
            at = (2 * place[at] + right).astype(np.int32)
            ids = np.stack([2 * ids[split] + 1, 2 * ids[split] + 2], 1).ravel()
        return nodes, fitted


def fit_all(frame: DataFrame, inputs: DataFrame, params: TreeParams = TreeParams()) -> DataFrame:
    """The node table of one model per row of ``inputs``, fitted on the training rows of its station.

    ``inputs`` says per station and strategy what goes into the model (all lags, selected ones, or
    components).  A station without training rows gets no model.
    """
    lags = lag_names()
    names = [f.split()[0] for f in NODES.split(", ")]

    def fit(key: tuple, rows: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows):
            rows = rows.sort_values("hour")
            x, y = rows[lags].to_numpy(np.float64), rows["rides"].to_numpy(np.float64)
            for _, model in models.sort_values("strategy").iterrows():
                for n, nodes in enumerate(Learner(ModelInputs(model).of(x), y, params).trees()):
                    weight = params.rate if n else 1.0
                    found.extend((key[0], model["strategy"], n, *node, weight) for node in nodes)
        return pd.DataFrame(found, columns=names)

    rows = frame.where("is_train").select("station_id", "hour", "rides", *lags)
    wanted = inputs.select("station_id", "strategy", "selected", "mean", "loadings")
    return rows.groupBy("station_id").cogroup(wanted.groupBy("station_id")).applyInPandas(fit, NODES)


def _plain(stations: DataFrame, strategy: str) -> DataFrame:
    none = {f.split()[0]: F.lit(None).cast(f.split(" ", 1)[1]) for f in INPUTS.split(", ")[2:]}
    return stations.select("station_id", F.lit(strategy).alias("strategy"), *(c.alias(n) for n, c in none.items()))


def all_lags_inputs(frame: DataFrame) -> DataFrame:
    """The stations with training rows, each with all lags as its model's inputs."""
    return _plain(frame.where("is_train").select("station_id").distinct(), "lag28")


def top_lags_inputs(nodes: DataFrame) -> DataFrame:
    """The lags that the all-lags models of ``nodes`` split by most, in ascending order of use."""
    chosen = F.transform(F.array_sort(F.collect_list(F.struct("position", "feature_index"))), lambda r: r["feature_index"])
    top = top_features(split_importance(nodes.where("strategy = 'lag28'"))).groupBy("station_id").agg(chosen.alias("selected_"))
    return _plain(top.select("station_id"), "topk").join(top, "station_id").withColumn("selected", F.col("selected_").cast("array<int>")).drop("selected_")


def model_inputs(strategy: str, frame: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """What goes into the models of one strategy, a row a station; the most used lags come out of ``nodes``."""
    names = [f.split()[0] for f in INPUTS.split(", ")]
    if strategy == "lag28":
        return all_lags_inputs(frame).select(names)
    if strategy == "topk":
        return top_lags_inputs(nodes).select(names)
    if strategy == "pca":
        return component_inputs(frame).select(names)
    raise ValueError(f"unknown strategy {strategy!r}")

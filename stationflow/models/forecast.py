"""Forecasts over the next hours of every station."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stationflow.config import DEFAULTS, lag_names
from stationflow.operators.series import hours_after
from stationflow.schemas import FORECASTS, PREDICTIONS


def _spread(seeds: DataFrame, values, model: str) -> DataFrame:
    """One row per step from an array with one value per step."""
    steps = seeds.select("station_id", "last_hour", F.posexplode(values).alias("_pos", "predicted_rides"))
    return steps.withColumn("_step", F.col("_pos") + 1).select(
        F.lit(model).alias("model"), "station_id", hours_after("last_hour", "_step").alias("hour"), "predicted_rides"
    )


def carry_forward(seeds: DataFrame, hours: int = DEFAULTS.horizon_hours, model: str = "naive_lag1") -> DataFrame:
    """Every future hour equals the last observed one."""
    return _spread(seeds, F.array_repeat(F.get("recent", F.lit(0)), hours), model)


def recursive_mean(seeds: DataFrame, hours: int = DEFAULTS.horizon_hours, model: str = "mean28") -> DataFrame:
    """Each step is the mean of the last values, predictions included; no Python involved."""
    n = DEFAULTS.n_lags

    def step(known, _):
        total = F.aggregate(F.slice(known, 1, n), F.lit(0.0), lambda a, b: a + b)
        return F.concat(F.array(total / n), known)

    known = F.aggregate(F.sequence(F.lit(1), F.lit(hours)), F.col("recent"), step)
    return _spread(seeds, F.reverse(F.slice(known, 1, hours)), model)


class Trees:
    """The boosted trees of one model as arrays indexed by tree and node."""

    def __init__(self, nodes: pd.DataFrame):
        tree = pd.factorize(nodes["tree_id"], sort=True)[0]
        shape = (tree.max() + 1, int(nodes["node_id"].max()) + 1)
        node = nodes["node_id"].to_numpy()

        def grid(name: str, kind) -> np.ndarray:
            out = np.zeros(shape, kind)
            out[tree, node] = nodes[name].to_numpy()
            return out

        self.feature = grid("feature_index", np.int64)
        self.threshold = grid("threshold", np.float64)
        self.left = grid("left", np.int64)
        self.right = grid("right", np.int64)
        self.value = grid("value", np.float64)
        self.weight = grid("tree_weight", np.float64)[:, 0]
        self.rows = np.arange(shape[0])

    def predict(self, x: np.ndarray) -> np.ndarray:
        """One value per row of ``x``; all trees descend together, one level per turn, until each is at a leaf."""
        at = np.zeros((len(x), len(self.rows)), np.int64)
        while True:
            feature = self.feature[self.rows, at]
            inner = feature >= 0
            if not inner.any():
                return self.value[self.rows, at] @ self.weight
            value = np.take_along_axis(x, np.where(inner, feature, 0), axis=1)
            low = value <= self.threshold[self.rows, at]
            child = np.where(low, self.left[self.rows, at], self.right[self.rows, at])
            at = np.where(inner, child, at)


class ModelInputs:
    """What a model makes of the last values of a series, newest first."""

    def __init__(self, state: pd.Series):
        self.selected = None if state["selected"] is None else np.asarray(state["selected"], np.int64)
        self.mean = self.loadings = None
        if state["loadings"] is not None:
            self.mean = np.asarray(state["mean"], np.float64)
            self.loadings = np.asarray(state["loadings"], np.float64).reshape(-1, len(self.mean))

    def of(self, x: np.ndarray) -> np.ndarray:
        if self.selected is not None:
            return x[:, self.selected]
        if self.loadings is not None:
            return (x - self.mean) @ self.loadings.T
        return x


def _none(schema) -> pd.DataFrame:
    kinds = {"string": "object", "timestamp_ntz": "datetime64[us]", "bigint": "int64", "double": "float64"}
    return pd.DataFrame({f.name: pd.Series(dtype=kinds[f.dataType.simpleString()]) for f in schema.fields})


def predict_by_nodes(frame: DataFrame, nodes: DataFrame, inputs: DataFrame) -> DataFrame:
    """Predictions of every model for every row of its station, as one job over one scan of ``frame``.

    ``nodes`` and ``inputs`` are as in ``recursive_trees``.  A group is one model and the hourly rows
    of its station, which the calendar bounds.  Stations without a model get no rows.
    """
    lags = lag_names()
    columns = [field.name for field in PREDICTIONS.fields]

    def run(key: tuple, rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or model.empty:
            return _none(PREDICTIONS)
        x = ModelInputs(rows.iloc[0]).of(rows[lags].to_numpy(np.float64))
        return pd.DataFrame(
            {
                "model": key[1],
                "station_id": key[0],
                "hour": rows["hour"],
                "actual_rides": rows["rides"],
                "predicted_rides": Trees(model).predict(x),
            }
        )[columns]

    keys = ("station_id", "strategy")
    rows = frame.select("station_id", "hour", "rides", *lags).join(inputs.drop("version"), "station_id")
    return rows.groupBy(*keys).cogroup(nodes.groupBy(*keys)).applyInPandas(run, PREDICTIONS)


def recursive_trees(
    seeds: DataFrame, nodes: DataFrame, inputs: DataFrame, hours: int = DEFAULTS.horizon_hours
) -> DataFrame:
    """Recursive forecast of every station by each of its fitted models.

    ``nodes`` is the node table of the models and ``inputs`` says, per station and strategy, what
    goes into them: ``selected`` lag positions, or ``mean`` and ``loadings`` of the components.
    Each step predicts from the last values, newest first, and the prediction joins them.

    One job for all stations and models.  A group is one model: its trees (bounded by the
    model's settings) and a state of 28 values.  A station without a model gets no rows.
    """

    def run(key: tuple, seed: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        columns = [field.name for field in FORECASTS.fields]
        if seed.empty or model.empty:
            return _none(FORECASTS)
        state = seed.iloc[0]
        n_state = len(state["recent"])
        known = np.empty(n_state + hours)
        # Newest first: position `start` holds the latest value.
        known[hours:] = state["recent"]
        own, trees = ModelInputs(state), Trees(model)
        for start in range(hours, 0, -1):
            known[start - 1] = trees.predict(own.of(known[None, start : start + n_state]))[0]
        first = pd.Timestamp(state["last_hour"]) + pd.Timedelta(hours=1)
        return pd.DataFrame(
            {
                "model": key[1],
                "station_id": key[0],
                "hour": pd.date_range(first, periods=hours, freq="h"),
                "predicted_rides": known[:hours][::-1],
            }
        )[columns]

    keys = ("station_id", "strategy")
    states = seeds.join(inputs, "station_id").select(
        *keys, "last_hour", "recent", "selected", "mean", "loadings"
    )
    return states.groupBy(*keys).cogroup(nodes.groupBy(*keys)).applyInPandas(run, FORECASTS)

"""Prediction with stored models: one row a model, its trees as arrays.

A batch of models becomes one stack of arrays, so that all of them take a step together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from stationflow.config import DEFAULTS, lag_names
from stationflow.models.forecast import ModelInputs, Trees
from stationflow.schemas import FORECASTS, PREDICTIONS

NODE_FIELDS = {
    "tree_id": "int", "node_id": "int", "feature_index": "int", "threshold": "double", "left": "int", "right": "int", "value": "double",
    "tree_weight": "double",
}
INPUT_FIELDS = ("selected", "mean", "loadings")
# Models that step together; a hundred trees of 63 nodes take some 200 KB each.
MODELS_A_STACK = 128
HOUR_MICROS = 3_600_000_000


def packed(nodes: DataFrame) -> DataFrame:
    """One row per station and strategy with the fields of all nodes as arrays, by tree and node.

    A model's nodes are bounded by its settings.
    """
    every = F.array_sort(F.collect_list(F.struct(*NODE_FIELDS)))
    rows = nodes.groupBy("station_id", "strategy").agg(every.alias("nodes_"))
    return rows.select("station_id", "strategy", *(F.col(f"nodes_.{name}").alias(name) for name in NODE_FIELDS))


def unpacked(models: DataFrame) -> DataFrame:
    """The node table of packed models."""
    return models.select("station_id", "strategy", F.expr(f"inline(arrays_zip({', '.join(NODE_FIELDS)}))"))


class Stack:
    """The trees of several models as arrays by model, tree and node, and the matrices that make their inputs."""

    def __init__(self, models: pa.RecordBatch, n_state: int):
        sizes = np.asarray(pc.list_value_length(models.column("tree_id")))
        flat = {name: np.asarray(models.column(name).flatten()) for name in NODE_FIELDS}
        model, n = np.repeat(np.arange(len(sizes)), sizes), len(sizes)
        trees, nodes = int(flat["tree_id"].max()) + 1, int(flat["node_id"].max()) + 1
        place = (model * trees + flat["tree_id"]) * nodes + flat["node_id"]

        def spread(name: str, kind, empty) -> np.ndarray:
            out = np.full(n * trees * nodes, empty, kind)
            out[place] = flat[name]
            return out

        self.feature, self.threshold = spread("feature_index", np.int32, -1), spread("threshold", np.float64, 0)
        self.left, self.right = spread("left", np.int32, 0), spread("right", np.int32, 0)
        self.value = spread("value", np.float64, 0)
        self.weight = np.zeros((n, trees))
        self.weight[model, flat["tree_id"]] = flat["tree_weight"]
        self.root = np.arange(n * trees).reshape(n, trees) * nodes
        self.model = np.arange(n)[:, None]

        self.mean, self.matrix = np.zeros((n, n_state)), np.zeros((n, n_state, n_state))
        inputs = {name: models.column(name).to_pylist() for name in INPUT_FIELDS}
        for m in range(n):
            if inputs["selected"][m] is not None:
                chosen = inputs["selected"][m]
                self.matrix[m, np.arange(len(chosen)), chosen] = 1
            elif inputs["loadings"][m] is not None:
                loadings = np.reshape(inputs["loadings"][m], (-1, n_state))
                self.matrix[m, : len(loadings)] = loadings
                self.mean[m] = inputs["mean"][m]
            else:
                self.matrix[m] = np.eye(n_state)

    def predict(self, state: np.ndarray) -> np.ndarray:
        """One prediction per model from its last values, newest first: all trees of all models descend together."""
        x = np.matmul(self.matrix, (state - self.mean)[:, :, None])[:, :, 0]
        at = np.zeros(self.root.shape, np.int32)
        while True:
            place = self.root + at
            feature = self.feature[place]
            inner = feature >= 0
            if not inner.any():
                return (self.value[place] * self.weight).sum(1)
            low = x[self.model, np.where(inner, feature, 0)] <= self.threshold[place]
            at = np.where(inner, np.where(low, self.left[place], self.right[place]), at)


def forecast_in_step(seeds: DataFrame, models: DataFrame, hours: int = DEFAULTS.horizon_hours) -> DataFrame:
    """Recursive forecast of every station by each of its models.

    ``seeds`` has the last values of each series, newest first, ``models`` one row a model.  The series
    of a task go through the hours together, and each prediction joins the values of its own series.
    A station without a model, or without enough values, gets no rows.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, MODELS_A_STACK):
                part = batch.slice(first, MODELS_A_STACK)
                recent = np.array(part.column("recent").to_pylist(), np.float64)
                n, n_state = recent.shape
                known = np.empty((n, hours + n_state))
                # Newest first: column ``at`` holds the latest value.
                known[:, hours:] = recent
                stack = Stack(part, n_state)
                for at in range(hours, 0, -1):
                    known[:, at - 1] = stack.predict(known[:, at : at + n_state])
                last = part.column("last_hour").cast(pa.timestamp("us")).cast(pa.int64()).to_numpy()
                hour = (last[:, None] + HOUR_MICROS * np.arange(1, hours + 1)).ravel()
                whose = pa.array(np.repeat(np.arange(n), hours))
                columns = [
                    part.column("strategy").take(whose), part.column("station_id").take(whose),
                    pa.array(hour).cast(pa.timestamp("us")), pa.array(known[:, :hours][:, ::-1].ravel()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in FORECASTS.fields])

    columns = ["station_id", "strategy", *INPUT_FIELDS, *NODE_FIELDS]
    both = seeds.select("station_id", "last_hour", "recent").join(models.select(columns), "station_id")
    return both.mapInArrow(step, FORECASTS)


def predict_rows(frame: DataFrame, models: DataFrame) -> DataFrame:
    """Predictions of every model for every row of its station: rows and models meet once per station."""
    lags = lag_names()
    names = [f.name for f in PREDICTIONS.fields]

    def run(key: tuple, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found, x = [], rows[lags].to_numpy(np.float64)
        for _, model in own.iterrows() if len(rows) else ():
            trees = Trees(pd.DataFrame({name: model[name] for name in NODE_FIELDS}))
            values = trees.predict(ModelInputs(model).of(x))
            found.append(pd.DataFrame({"model": model["strategy"], "station_id": key[0], "hour": rows["hour"], "actual_rides": rows["rides"], "predicted_rides": values}))
        if found:
            return pd.concat(found)[names]
        return pd.DataFrame({"model": [], "station_id": [], "hour": pd.Series([], dtype="datetime64[us]"), "actual_rides": pd.Series([], dtype="int64"), "predicted_rides": pd.Series([], dtype="float64")})

    rows = frame.select("station_id", "hour", "rides", *lags)
    wanted = models.select("station_id", "strategy", *INPUT_FIELDS, *NODE_FIELDS)
    return rows.groupBy("station_id").cogroup(wanted.groupBy("station_id")).applyInPandas(run, PREDICTIONS)

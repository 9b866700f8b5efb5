"""Principal components of the lags of all stations in one job.

A station's products of lags are summed by one aggregate, combined before the shuffle: 28 sums and 406
sums of products, exact in whole numbers.  What reaches a task is one row a station, and a batch of
stations is decomposed at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationflow.config import DEFAULTS, lag_names

COMPONENTS = "station_id string, mean array<double>, loadings array<double>, ratios array<double>"
# Stations decomposed in one call.
MATRICES = 256


def lag_sums(frame: DataFrame) -> DataFrame:
    """``station_id, n, sums, products``: of the training rows, products by row of the upper triangle."""
    lags = lag_names()
    sums = ", ".join(f"sum({a})" for a in lags)
    products = ", ".join(f"sum({a} * {b})" for i, a in enumerate(lags) for b in lags[i:])
    rows = frame.where("is_train").select("station_id", *lags)
    return rows.groupBy("station_id").agg(F.count(F.lit(1)).alias("n"), F.expr(f"array({sums})").alias("sums"), F.expr(f"array({products})").alias("products"))


def decomposed(n: np.ndarray, sums: np.ndarray, products: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, loadings (component by lag) and shares of variance of the ``k`` largest components.

    The sign of a component is that which makes its largest loading positive.  One row, or rows that
    are all equal, have no variance; their shares are 0.
    """
    size = sums.shape[1]
    gram = np.empty((len(n), size, size))
    upper = np.triu_indices(size)
    gram[:, upper[0], upper[1]] = products
    gram[:, upper[1], upper[0]] = products
    mean = sums / n[:, None]
    # n times the products less the products of sums is exact as long as it fits a double.
    scatter = (gram * n[:, None, None] - sums[:, :, None] * sums[:, None, :]) / np.maximum(n * (n - 1), 1)[:, None, None]
    values, vectors = np.linalg.eigh(scatter)
    values = np.maximum(values[:, ::-1], 0)
    loadings = vectors[:, :, ::-1].transpose(0, 2, 1)[:, :k]
    largest = np.take_along_axis(loadings, np.abs(loadings).argmax(2)[:, :, None], 2)
    total = values.sum(1, keepdims=True)
    shares = np.divide(values[:, :k], total, out=np.zeros((len(n), k)), where=total > 0)
    return mean, loadings * np.where(largest < 0, -1, 1), shares


def components(frame: DataFrame, k: int = DEFAULTS.n_components) -> DataFrame:
    """One row per station with training rows: means, loadings row by row, shares of variance."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, MATRICES):
                part = batch.slice(at, MATRICES)
                table = {c: np.array(part.column(c).to_pylist(), np.float64) for c in ("n", "sums", "products")}
                found = decomposed(table["n"], table["sums"], table["products"], k)
                lists = [pa.array([row.ravel().tolist() for row in values], pa.list_(pa.float64())) for values in found]
                yield pa.RecordBatch.from_arrays([part.column("station_id"), *lists], ["station_id", "mean", "loadings", "ratios"])

    return lag_sums(frame).mapInArrow(solve, COMPONENTS)


def component_inputs(frame: DataFrame, k: int = DEFAULTS.n_components) -> DataFrame:
    """Model inputs of the component strategy, with the share of variance kept in percent."""
    total = F.aggregate("ratios", F.lit(0.0), lambda a, b: a + b)
    return components(frame, k).select(
        "station_id", F.lit("pca").alias("strategy"), F.lit(None).cast("array<int>").alias("selected"), "mean", "loadings",
        F.round(100 * total, 2).alias("explained_variance"),
    )

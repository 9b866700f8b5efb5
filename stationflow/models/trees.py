"""Boosted-tree models per station: three ways to feed 28 lags to the same learner."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from stationflow.config import DEFAULTS, lag_names
from stationflow.schemas import PREDICTIONS

STRATEGIES = ("lag28", "topk", "pca")


@dataclass(frozen=True)
class TreeParams:
    """Settings of the learner: 100 trees of at most 32 leaves with 20 rows each, rate 0.1."""

    trees: int = 100
    rate: float = 0.1
    depth: int = 5
    min_rows: int = 20
    bins: int = 255
    seed: int = DEFAULTS.seed

    def regressor(self, features: str) -> GBTRegressor:
        return GBTRegressor(
            featuresCol=features,
            labelCol="rides",
            predictionCol="predicted_rides",
            maxIter=self.trees,
            stepSize=self.rate,
            maxDepth=self.depth,
            minInstancesPerNode=self.min_rows,
            maxBins=self.bins,
            seed=self.seed,
        )


def pipeline(strategy: str, params: TreeParams, selected: Sequence[int] | None = None) -> Pipeline:
    lags = VectorAssembler(inputCols=lag_names(), outputCol="lags")
    if strategy == "lag28":
        return Pipeline(stages=[lags, params.regressor("lags")])
    if strategy == "topk":
        chosen = VectorSlicer(inputCol="lags", outputCol="chosen", indices=[int(i) for i in selected])
        return Pipeline(stages=[lags, chosen, params.regressor("chosen")])
    if strategy == "pca":
        # PCA projects without centring, so the mean is taken off first.
        centred = StandardScaler(inputCol="lags", outputCol="centred", withMean=True, withStd=False)
        components = PCA(k=DEFAULTS.n_components, inputCol="centred", outputCol="components")
        return Pipeline(stages=[lags, centred, components, params.regressor("components")])
    raise ValueError(f"unknown strategy {strategy!r}")


_PREPARING = Lock()

# Training rows one task handles; a station's frame is split into about this many rows.
ROWS_PER_TASK = 200_000


def station_rows(frame: DataFrame, station: str, rows: int) -> DataFrame:
    """The training rows of one station in as many partitions as they are worth."""
    train = frame.where((F.col("station_id") == station) & F.col("is_train"))
    return train.select("rides", *lag_names()).coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def in_parallel(spark, jobs: Iterable, work, parallelism: int) -> list:
    """Submit Spark work for several jobs from a few driver threads, as ML tuning does."""
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(spark)(work), list(jobs))


def fit_stations(
    frame: DataFrame,
    strategy: str,
    stations: Sequence[str],
    params: TreeParams = TreeParams(),
    selected: dict[str, Sequence[int]] | None = None,
    parallelism: int = 4,
) -> dict[str, PipelineModel]:
    """One model per listed station; every fit is a series of distributed jobs.

    ``frame`` is a training frame, best persisted by the caller.  Only the stations that are
    listed in the settings get a model of their own.
    """
    spark = frame.sparkSession
    counts = {
        r["station_id"]: r["n"]
        for r in frame.where(F.col("station_id").isin(*stations) & F.col("is_train"))
        .groupBy("station_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }

    def fit(station: str) -> PipelineModel:
        rows = station_rows(frame, station, counts[station])
        *inputs, regressor = pipeline(strategy, params, (selected or {}).get(station)).getStages()
        # The driver-side decomposition of PCA is not safe to run in two threads at once.
        with _PREPARING:
            prepared = Pipeline(stages=inputs).fit(rows)
        return PipelineModel([*prepared.stages, regressor.fit(prepared.transform(rows))])

    known = [s for s in stations if s in counts]
    return dict(zip(known, in_parallel(spark, known, fit, parallelism)))


def predict(frame: DataFrame, models: dict[str, PipelineModel], model: str, test_only: bool = True) -> DataFrame:
    """Test-part predictions of every station by its own model, as one union of scans."""
    parts = []
    for station, fitted in models.items():
        rows = frame.where(F.col("station_id") == station)
        rows = rows.where(~F.col("is_train")) if test_only else rows
        parts.append(
            fitted.transform(rows).select(
                F.lit(model).alias("model"),
                "station_id",
                "hour",
                F.col("rides").alias("actual_rides"),
                "predicted_rides",
            )
        )
    if not parts:
        return frame.sparkSession.createDataFrame([], PREDICTIONS)
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def explained_variance(fitted: PipelineModel) -> float:
    """Share of variance the components keep, in percent with two decimals."""
    components = fitted.stages[2]
    return round(100 * float(sum(components.explainedVariance.toArray())), 2)

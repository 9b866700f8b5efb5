"""Scores, comparisons and labels."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from stationflow.config import UNKNOWN_STRATEGY
from stationflow.operators.series import naive_predictions

NAIVE_MODEL = "naive_lag_1"


def mae(predictions: DataFrame, by: tuple[str, ...] = ("station_id", "model")) -> DataFrame:
    """Mean absolute error per group; rows without a prediction or an actual value do not count."""
    error = F.abs(F.col("actual_rides") - F.col("predicted_rides"))
    return predictions.groupBy(*by).agg(F.avg(error).alias("mae"))


def constant_mean_model(series: DataFrame) -> DataFrame:
    """The constant regressor stored beside the naive baseline: the mean label per station."""
    rows = naive_predictions(series)
    return rows.groupBy("station_id").agg(F.avg("rides").alias("mean_rides"))


def naive_baseline(series: DataFrame) -> DataFrame:
    """Score of "same as the previous row" over the whole series, with the constant mean.

    One window and one aggregate give both, as they read the same rows.
    """
    rows = naive_predictions(series)
    return rows.groupBy("station_id").agg(
        F.avg(F.abs(F.col("rides") - F.col("predicted_rides"))).alias("mae"),
        F.avg("rides").alias("mean_rides"),
        F.count(F.lit(1)).alias("scored_rows"),
    )


def metrics_table(scores: DataFrame, strategies: DataFrame | None = None) -> DataFrame:
    """Scores in the layout of the metrics table; ``strategies`` maps model to strategy."""
    known = scores if strategies is None else scores.join(strategies, "model", "left")
    for name, kind in (("strategy", "string"), ("explained_variance", "double")):
        if name not in known.columns:
            known = known.withColumn(name, F.lit(None).cast(kind))
    return known.select("station_id", "model", "strategy", "mae", "explained_variance")


def union_labelled(tables: Mapping[str, DataFrame], label: str = "model_label") -> DataFrame:
    """Union of per-model tables with differing columns, each tagged with its model's label.

    The tag must not be a case variant of an existing column: Spark would replace that column.
    """
    tagged = []
    for name, table in tables.items():
        if label.lower() in (c.lower() for c in table.columns):
            raise ValueError(f"column {label!r} exists already")
        tagged.append(table.withColumn(label, F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def with_station_name(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Add ``station_name``; null for a station that is not in the lookup table."""
    return df.join(stations, "station_id", "left")


def with_model_labels(df: DataFrame, models: DataFrame) -> DataFrame:
    """Add the model's label and strategy, with defaults for a model not in the lookup table."""
    return df.join(models, "model", "left").withColumns(
        {
            "model_label": F.coalesce("model_label", "model"),
            "strategy_label": F.coalesce("strategy_label", F.lit(UNKNOWN_STRATEGY)),
        }
    )


def ranked(metrics: DataFrame) -> DataFrame:
    """Models of each station in ascending order of error, equal errors by model name."""
    order = Window.partitionBy("station_id").orderBy("mae", "model")
    return metrics.withColumn("rank", F.row_number().over(order))


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the least error per station, without sorting."""
    best = F.min(F.struct("mae", "model")).alias("best")
    return metrics.groupBy("station_id").agg(best).select(
        "station_id", F.col("best.model").alias("best_model"), F.col("best.mae").alias("best_mae")
    )

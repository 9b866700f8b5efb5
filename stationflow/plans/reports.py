"""The tables behind the dashboards, for all stations and models at once.

A dashboard that shows one station or model filters the result: the filter is on a grouping
column, so Catalyst moves it down to the scan.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.config import DEFAULTS
from stationflow.functions.times import floor_hours, lenient_time
from stationflow.operators.filters import since_days
from stationflow.operators.metrics import best_model, ranked, with_model_labels, with_station_name
from stationflow.operators.numbering import number_rows


def _timed(rows: DataFrame) -> DataFrame:
    """Rows with a usable hour; text hours are parsed."""
    if dict(rows.dtypes)["hour"] not in ("timestamp", "timestamp_ntz"):
        rows = rows.withColumn("hour", lenient_time("hour"))
    return rows.dropna(subset=["hour"])


def _mean(name: str) -> Column:
    """Mean that leaves out NaN as well as null."""
    return F.avg(F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))).alias(name)


def daily_actual_vs_predicted(predictions: DataFrame) -> DataFrame:
    """Daily mean of actual and predicted rides, one row per model, station, day and kind."""
    daily = (
        _timed(predictions)
        .groupBy("model", "station_id", F.to_date("hour").alias("date"))
        .agg(_mean("predicted_rides"), _mean("actual_rides"))
        .select(
            "model",
            "station_id",
            F.col("date").cast("timestamp_ntz").alias("hour"),
            F.col("predicted_rides").alias("Predicted Rides"),
            F.col("actual_rides").alias("Actual Rides"),
        )
    )
    return daily.unpivot(["model", "station_id", "hour"], ["Predicted Rides", "Actual Rides"], "type", "rides")


def forecast_bins(forecasts: DataFrame, hours: int = DEFAULTS.bin_hours) -> DataFrame:
    """Mean forecast per model, station and bin of six hours."""
    return (
        _timed(forecasts)
        .groupBy("model", "station_id", floor_hours("hour", hours).alias("hour_bin"))
        .agg(_mean("predicted_rides"))
        .withColumnRenamed("hour_bin", "hour")
    )


def station_mae(metrics: DataFrame, station: str, model: str) -> DataFrame:
    """The one score shown beside a station's chart."""
    chosen = (F.col("station_id") == station) & (F.col("model") == model)
    return metrics.where(chosen).groupBy("station_id", "model").agg(F.min("mae").alias("mae"))


def mae_table(metrics: DataFrame, stations: DataFrame, models: DataFrame) -> DataFrame:
    """Model, station name, strategy and MAE of all named stations, with a display index from 1.

    Stations of one name are told apart by their id, so that the numbering has no ties.
    """
    named = with_model_labels(with_station_name(metrics, stations), models)
    shown = named.where(F.col("station_name").isNotNull()).select(
        "model_label", "station_name", "strategy_label", "mae", "model", "station_id"
    )
    numbered = number_rows(shown, ["model_label", "station_name", "model", "station_id"], "display_index")
    return numbered.drop("model", "station_id")


def model_ranking(metrics: DataFrame, models: DataFrame) -> DataFrame:
    """Models of each station ranked by error."""
    return with_model_labels(ranked(metrics), models).select("station_id", "model_label", "mae", "rank")


def best_models(metrics: DataFrame) -> DataFrame:
    return best_model(metrics)


def recent_daily(
    predictions: DataFrame, as_of: datetime | Column, models: DataFrame, days: int = DEFAULTS.monitor_days
) -> DataFrame:
    """Daily mean prediction per model and station over the last ``days`` days."""
    daily = (
        since_days(_timed(predictions), as_of, days)
        .groupBy("model", "station_id", F.to_date("hour").alias("date"))
        .agg(_mean("predicted_rides"))
    )
    return with_model_labels(daily, models).select(
        "station_id", "model_label", "date", F.col("predicted_rides").alias("rides")
    )


def forecast_bins_by_model(forecasts: DataFrame, models: DataFrame) -> DataFrame:
    """Mean forecast per six hours with model labels; labels join after the aggregate."""
    return with_model_labels(forecast_bins(forecasts), models).select(
        "station_id", "model_label", F.col("hour").alias("hour_bin"), F.col("predicted_rides").alias("rides")
    )

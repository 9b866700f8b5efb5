"""Row filters on station, time and high-water mark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.config import DEFAULTS


def for_station(df: DataFrame, station: str) -> DataFrame:
    return df.where(F.col("station_id") == station)


def for_stations(df: DataFrame, stations: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the given stations: a short literal list, or a table with ``station_id``."""
    if isinstance(stations, DataFrame):
        return df.join(stations.select("station_id"), "station_id", "left_semi")
    return df.where(F.col("station_id").isin(*stations))


def for_station_name(df: DataFrame, stations: DataFrame, name: str) -> DataFrame:
    """Rows of the station with the given display name."""
    return for_stations(df, stations.where(F.col("station_name") == name))


def newer_than(rows: DataFrame, stored: DataFrame, time: str = "hour") -> DataFrame:
    """Rows later than the newest stored time of *all* stations.

    The mark is a scalar subquery.  An empty ``stored`` gives a null mark and nothing passes.
    """
    return rows.where(F.col(time) > stored.agg(F.max(time)).scalar())


def newer_than_per_station(rows: DataFrame, stored: DataFrame, time: str = "hour") -> DataFrame:
    """Rows later than the newest stored time of their own station; unknown stations pass whole."""
    marks = stored.groupBy("station_id").agg(F.max(time).alias("_mark"))
    return (
        rows.join(marks, "station_id", "left")
        .where(F.col("_mark").isNull() | (F.col(time) > F.col("_mark")))
        .drop("_mark")
    )


def since_days(df: DataFrame, as_of: datetime | Column, days: int = DEFAULTS.monitor_days) -> DataFrame:
    """Rows whose ``hour`` is at most ``days`` days before ``as_of``."""
    mark = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    return df.where(F.col("hour") >= mark - F.make_dt_interval(days=F.lit(days)))

"""Raw trips to clean trips to hourly counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.config import REQUIRED_TRIP_COLUMNS
from stationflow.functions.times import floor_hour, monday_weekday, strict_time, strip_fraction


def parse_trip_times(trips: DataFrame) -> DataFrame:
    """Read both trip times as zoneless timestamps with whole seconds; bad text becomes null.

    The times come out of a one-row generator.  As a plain projection they would be computed twice,
    because Catalyst copies them into every filter on them, and reading text is the dear part of
    the whole clean-up.
    """
    times = ("started_at", "ended_at")
    parsed = F.struct(*[strict_time(strip_fraction(F.col(name).cast("string"))).alias(name) for name in times])
    others = [name for name in trips.columns if name not in times]
    return trips.select(*others, F.inline(F.array(parsed))).select(trips.columns)


def add_date_parts(trips: DataFrame) -> DataFrame:
    """Calendar columns of the start time.

    The hour number is called ``hour_of_day`` because ``hour`` is a timestamp in every later table.
    """
    start = F.col("started_at")
    return trips.withColumns(
        {
            "date": F.to_date(start),
            "hour_of_day": F.hour(start),
            "weekday": monday_weekday(start),
        }
    )


def clean_trips(trips: DataFrame) -> DataFrame:
    """Parse times, drop rows without a usable time or station, add calendar columns.

    Missing fields are filtered out before the times are read, and at the scan if it can.
    """
    whole = trips.where(all_present(REQUIRED_TRIP_COLUMNS))
    return add_date_parts(parse_trip_times(whole).where(all_present(("started_at", "ended_at"))))


def all_present(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in names])


def rejected_trips(trips: DataFrame) -> DataFrame:
    """The rows ``clean_trips`` drops, with their original text and the reason."""
    started = strict_time(strip_fraction("started_at"))
    ended = strict_time(strip_fraction("ended_at"))
    reason = (
        F.when(F.col("started_at").isNull() | F.col("ended_at").isNull(), F.lit("missing time"))
        .when(started.isNull() | ended.isNull(), F.lit("malformed time"))
        .when(F.col("start_station_id").isNull() | F.col("end_station_id").isNull(), F.lit("missing station"))
    )
    return trips.withColumn("reason", reason).where(F.col("reason").isNotNull())


def hourly_counts(trips: DataFrame, station: str = "start_station_id", time: str = "started_at") -> DataFrame:
    """Trips per station and hour; hours without trips have no row.

    The count is partial before the shuffle, so a station with a third of all trips sends at
    most one row per hour and task.  The result has one row per station and clock hour: a
    series is bounded by the calendar (8,784 rows a year), however many trips it stands for.
    """
    return (
        trips.where(F.col(station).isNotNull() & F.col(time).isNotNull())
        .groupBy(F.col(station).cast("string").alias("station_id"), floor_hour(time).alias("hour"))
        .agg(F.count(F.lit(1)).alias("rides"))
    )


def trips_per_year(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.year("started_at").alias("year")).agg(F.count(F.lit(1)).alias("trips")).orderBy("year")

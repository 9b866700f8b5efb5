"""Row layouts of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

from stationflow.config import REQUIRED_TRIP_COLUMNS, lag_names

TRIPS_RAW = T.StructType(
    [T.StructField("ride_id", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in REQUIRED_TRIP_COLUMNS]
)

HOURLY_RIDES = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("hour", T.TimestampNTZType()),
        T.StructField("rides", T.LongType()),
    ]
)

HOURLY_FEATURES = T.StructType(
    HOURLY_RIDES.fields
    + [T.StructField(name, T.LongType()) for name in lag_names()]
    + [T.StructField("hour_of_day", T.IntegerType()), T.StructField("day_of_week", T.IntegerType())]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("hour", T.TimestampNTZType()),
        T.StructField("actual_rides", T.LongType()),
        T.StructField("predicted_rides", T.DoubleType()),
    ]
)

FORECASTS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("hour", T.TimestampNTZType()),
        T.StructField("predicted_rides", T.DoubleType()),
    ]
)

MODEL_METRICS = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("explained_variance", T.DoubleType()),
    ]
)

STATION_DIM = T.StructType(
    [T.StructField("station_id", T.StringType()), T.StructField("station_name", T.StringType())]
)

MODEL_DIM = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("model_label", T.StringType()),
        T.StructField("strategy_label", T.StringType()),
    ]
)

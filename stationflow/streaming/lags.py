"""Lag features of finished hours as a stream, 28 values of state per station."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from stationflow.config import DEFAULTS, lag_names
from stationflow.operators.series import add_calendar
from stationflow.schemas import HOURLY_RIDES
from stationflow.streaming.hourly import stream_hourly

LAGGED = StructType(HOURLY_RIDES.fields + [StructField(name, LongType()) for name in lag_names()])
STATE = "last_hour timestamp_ntz, recent array<bigint>"


class _LagState(StatefulProcessor):
    """Keeps the last counts of a station and emits each new hour with its lags.

    Hours are sorted within a batch; an hour not after the last one seen is dropped, as in the
    incremental append.  The first 28 hours of a station only fill the state.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.series = handle.getValueState("series", STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Start from the stored end of the series, at most 28 rows."""
        end = initialState.sort_values("hour").tail(DEFAULTS.n_lags)
        self.series.update((end["hour"].iloc[-1].to_pydatetime(), end["rides"].astype("int64").tolist()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # The new hours of one station in one batch, bounded by the calendar.
        new = pd.concat(rows).sort_values("hour")
        last, recent = self.series.get() if self.series.exists() else (None, [])
        if last is not None:
            new = new[new["hour"] > pd.Timestamp(last)]
        if new.empty:
            return
        n = DEFAULTS.n_lags
        values = pd.Series(list(recent) + new["rides"].tolist(), dtype="int64")
        lagged = {name: values.shift(i) for i, name in enumerate(lag_names(), 1)}
        out = pd.DataFrame({"rides": values, **lagged}).iloc[len(recent) :]
        out.insert(0, "hour", new["hour"].to_numpy())
        out.insert(0, "station_id", key[0])
        self.series.update((new["hour"].iloc[-1].to_pydatetime(), values.tail(n).tolist()))
        full = out.dropna()
        if not full.empty:
            yield full.astype({name: "int64" for name in lag_names()})

    def close(self) -> None:
        pass


@contextmanager
def lag_state_store(spark: SparkSession):
    """The state store this operator needs, for the queries started inside the block."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stream_lags(finished_hours: DataFrame, series_end: DataFrame | None = None) -> DataFrame:
    """Lags of a stream of finished ``station_id, hour, rides`` rows that arrive in hour order.

    ``series_end`` holds the last stored rows of each station: with it the first hours of the stream
    have all their lags, and hours that are stored already are passed over.
    """
    seeds = None if series_end is None else series_end.select("station_id", "hour", "rides").groupBy("station_id")
    return finished_hours.groupBy("station_id").transformWithStateInPandas(
        statefulProcessor=_LagState(), outputStructType=LAGGED, outputMode="Append", timeMode="None", initialState=seeds
    )


def stream_features(trips: DataFrame, delay: str, series_end: DataFrame | None = None) -> DataFrame:
    """Clean trips to finished hours to feature rows, as one stream.

    An hour is finished when the newest trip is ``delay`` past its end.
    """
    return add_calendar(stream_lags(stream_hourly(trips, delay), series_end))

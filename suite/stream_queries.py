"""The incremental path as Structured Streaming, drained and returned as a batch table.

The events are first landed as files in a new scratch folder; the streams take those in.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.functions.times import lenient_time
from stationflow.operators.trips import clean_trips
from stationflow.plans import jobs
from stationflow.schemas import HOURLY_RIDES, TRIPS_RAW
from stationflow.session import scratch
from stationflow.sources.store import TableStore
from stationflow.sources.trip_csv import export_csv
from stationflow.streaming.hourly import drain_append, drain_changes, stream_files, stream_hourly
from stationflow.streaming.lags import lag_state_store, stream_features, stream_lags
from stationflow.streaming.sinks import append_newer, compact, current_rows
from suite import tables as t
from suite.tables import LAG_LIST, Query, sql

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Longer than the span of the events: no row is late.
NOTHING_LATE = "40 days"
FILES_PER_BATCH = 2


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            SQL[name] = oracle
        return fn

    return register


@query("st2_stream_hourly", sql("SELECT * FROM hourly_clean", "hourly_clean"))
def _(spark, sf):
    """Raw CSV trips as a stream of files: cleaned, counted per hour, changes logged."""
    landing, log, checkpoint = (scratch(spark, name) for name in ("landing", "log", "checkpoint"))
    export_csv(t.raw_trips(spark, sf).repartition(4), landing)
    trips = clean_trips(stream_files(spark, landing, TRIPS_RAW, "csv", FILES_PER_BATCH))
    drain_changes(stream_hourly(trips, NOTHING_LATE), log, checkpoint)
    return current_rows(spark, log, ["station_id", "hour"])


@query(
    "st3_late_data",
    sql(
        """SELECT event_type AS station_id, date_trunc('hour', ts) AS hour, count(*) AS rides
FROM events, (SELECT max(ts) AS newest FROM events WHERE value < 100)
WHERE value < 100 OR date_trunc('hour', ts) + INTERVAL 1 HOUR > newest - INTERVAL 5 DAYS GROUP BY 1, 2"""
    ),
)
def _(spark, sf):
    """Events of high value arrive late, in a second file: counted if their hour is still open."""
    landing, log, checkpoint = (scratch(spark, name) for name in ("landing", "log", "checkpoint"))
    events = t.events(spark, sf)
    counts = stream_hourly(stream_files(spark, f"{landing}/*", events.schema), "5 days", "event_type", "ts")
    for part, rows in (("first", F.col("value") < 100), ("second", F.col("value") >= 100)):
        events.where(rows).write.parquet(f"{landing}/{part}")
        drain_changes(counts, log, checkpoint)
    return current_rows(spark, log, ["station_id", "hour"])


def hours_in_order(spark, sf, folder: str) -> None:
    """The hourly table as two sets of files that arrive one after the other."""
    rides = t.hourly(spark, sf)
    early = F.col("hour") < F.lit("2024-01-20").cast("timestamp_ntz")
    for i, part in enumerate((early, ~early)):
        rides.where(part).write.parquet(f"{folder}/{i}")
        yield


@query("st4_stream_lags", sql(f"SELECT station_id, hour, rides, {LAG_LIST} FROM features", "features"))
def _(spark, sf):
    """Finished hours arrive in two batches; the lags reach back across batches."""
    landing, out, checkpoint = (scratch(spark, name) for name in ("landing", "lags", "checkpoint"))
    with lag_state_store(spark):
        for _part in hours_in_order(spark, sf, landing):
            lagged = stream_lags(stream_files(spark, f"{landing}/*", HOURLY_RIDES))
            drain_append(lagged, out, checkpoint)
    return spark.read.parquet(out)


@query("st4_stream_features", sql("SELECT * FROM features_clean", "features_clean"))
def _(spark, sf):
    """History loaded as a batch, then raw trip files as a stream that starts from the end of each series."""
    landing, out, checkpoint = (scratch(spark, name) for name in ("landing", "features", "checkpoint"))
    store = TableStore(spark, scratch(spark, "store"))
    raw = t.raw_trips(spark, sf).withColumn("old", F.coalesce(lenient_time(F.col("started_at")) < F.lit("2024-01-10").cast("timestamp_ntz"), F.lit(True)))
    jobs.load_history(store, raw.where("old").drop("old"))
    # A trip long after all others finishes every hour before it; its own hour stays open.
    last = raw.where("not old").agg(F.lit("last").alias("ride_id"), F.lit("2030-01-01 00:00:00").alias("started_at"))
    last = last.select("*", F.col("started_at").alias("ended_at"), F.lit("-").alias("start_station_id"), F.lit("-").alias("end_station_id"))
    export_csv(raw.where("not old").drop("old").repartition(3).unionByName(last), landing)
    trips = clean_trips(stream_files(spark, landing, TRIPS_RAW, "csv", FILES_PER_BATCH))
    with lag_state_store(spark):
        drain_append(stream_features(trips, NOTHING_LATE, jobs.series_end(store)), out, checkpoint)
    new = spark.read.parquet(out)
    return jobs.features(store).unionByName(new)


@query("st5_stream_append", sql("SELECT station_id, hour, rides FROM hourly", "hourly"))
def _(spark, sf):
    """Hourly rows appended to a stored table batch by batch, then the same files once more."""
    landing = scratch(spark, "landing")
    store = TableStore(spark, scratch(spark, "store"))
    store.write("rides", spark.createDataFrame([], HOURLY_RIDES))
    parts = hours_in_order(spark, sf, landing)
    next(parts)
    store.write("rides", spark.read.parquet(f"{landing}/0"))
    for again in (1, 2):
        checkpoint = scratch(spark, f"checkpoint{again}")
        for _part in parts if again == 1 else (None,):
            stream = stream_files(spark, f"{landing}/*", HOURLY_RIDES)
            query = (
                stream.writeStream.foreachBatch(append_newer(store, "rides"))
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
    return store.read("rides")


@query("st5_stream_upsert", sql("SELECT * FROM hourly", "hourly"))
def _(spark, sf):
    """The change log of a stream, compacted into a store version."""
    landing, log, checkpoint = (scratch(spark, name) for name in ("landing", "log", "checkpoint"))
    events = t.events(spark, sf)
    events.repartition(4).write.parquet(landing)
    stream = stream_files(spark, landing, events.schema, files_per_batch=FILES_PER_BATCH)
    drain_changes(stream_hourly(stream, NOTHING_LATE, "event_type", "ts"), log, checkpoint)
    store = TableStore(spark, scratch(spark, "store"))
    compact(spark, log, ["station_id", "hour"], store, "rides")
    return store.read("rides", version=None)

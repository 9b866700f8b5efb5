"""New trip files to hourly counts as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stationflow.functions.times import drop_zone, to_utc
from stationflow.streaming.sinks import write_changes


def stream_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A stream of the files that arrive in a folder; each file is taken in once."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_hourly(
    trips: DataFrame, delay: str, station: str = "start_station_id", time: str = "started_at"
) -> DataFrame:
    """Trips per station and hour of a stream of clean trips.

    ``delay`` is how far behind the newest trip a trip may come in and still be counted; later
    ones are dropped.  State is one count per station and open hour.  Watermarks need a time with
    a zone; the result has none again.
    """
    hour = F.window(F.col(time), "1 hour")
    return (
        trips.where(F.col(station).isNotNull() & F.col(time).isNotNull())
        .withColumn(time, to_utc(time))
        .withWatermark(time, delay)
        .groupBy(F.col(station).cast("string").alias("station_id"), hour.alias("_window"))
        .agg(F.count(F.lit(1)).alias("rides"))
        .select("station_id", drop_zone("_window.start").alias("hour"), "rides")
    )


def drain_changes(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in all files present, logging each changed hour, and stop."""
    query = (
        counts.writeStream.outputMode("update")
        .foreachBatch(write_changes(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drain_append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in all files present, writing finished rows once, and stop."""
    query = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query

"""Snapshot tables: atomic commits, upserts by bucket, file skipping, cached reads, late hours."""

from __future__ import annotations

from datetime import datetime
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from stationflow.config import lag_names
from stationflow.operators.series import split_train_test_by_chunk
from stationflow.plans import late
from stationflow.session import scratch
from stationflow.sources.cache import TableCache
from stationflow.sources.snapshots import Layout, SnapshotTable
from stationflow.streaming.hourly import stream_files
from suite import tables as t
from suite.tables import SPLIT, Query, sql

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            SQL[name] = oracle
        return fn

    return register


def before(day: str = SPLIT, time: str = "hour"):
    return F.col(time) < F.lit(day).cast("timestamp_ntz")


def third(n: int, key: str = "event_id"):
    """One of three parts of the events, by their numbers and so in no order of time."""
    return F.col(key) % 3 == n


@query(
    "t1_snapshot_append",
    sql(
        f"""SELECT station_id, hour, rides FROM hourly
WHERE hour < TIMESTAMP '{SPLIT}' OR hour > (SELECT max(hour) FROM hourly WHERE hour < TIMESTAMP '{SPLIT}')""",
        "hourly",
    ),
)
def _(spark, sf):
    """Old rows committed, then the whole table offered twice: only the newer rows join, once."""
    table = SnapshotTable(spark, scratch(spark, "snapshots"))
    rides = t.hourly(spark, sf)
    table.append(rides.where(before()))
    table.append_newer(rides)
    table.append_newer(rides)
    return table.read()


@query("t1_two_writers", sql("SELECT station_id, hour, rides FROM hourly_user", "hourly_user"))
def _(spark, sf):
    """Four writers add a part each at the same time; all parts are there, each once."""
    table = SnapshotTable(spark, scratch(spark, "snapshots"))
    rides = t.hourly(spark, sf, "user_id")
    part = F.pmod(F.xxhash64("station_id", "hour"), F.lit(4))

    def write(n: int) -> bool:
        return SnapshotTable(spark, table.root).append(rides.where(part == n))

    with ThreadPool(4) as pool:
        pool.map(inheritable_thread_target(spark)(write), range(4))
    return table.read()


@query(
    "t2_replace_groups",
    sql("SELECT station_id, hour, CASE WHEN station_id = 'view' THEN rides + 1 ELSE rides END AS rides FROM hourly", "hourly"),
)
def _(spark, sf):
    """All rows of one station are replaced; its bucket is written again, the others are not."""
    table = SnapshotTable(spark, scratch(spark, "snapshots"), Layout(bucket_by=("station_id",), buckets=8))
    rides = t.hourly(spark, sf)
    table.append(rides)
    table.replace_groups(rides.where("station_id = 'view'").withColumn("rides", F.col("rides") + 1), ["station_id"])
    return table.read()


@query(
    "t3_bucket_upsert",
    """SELECT user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
)
def _(spark, sf):
    """Upserts by hash bucket, the newer events first: each key keeps its last row."""
    layout = Layout(keys=("user_id", "event_type"), buckets=16, station="event_type", time="ts")
    table = SnapshotTable(spark, scratch(spark, "snapshots"), layout)
    rows = t.events(spark, sf).select("user_id", "event_type", "ts", "event_id", "value")
    for part in (rows.where(~before(time="ts")), rows.where(before(time="ts"))):
        table.upsert(part, ["ts", "event_id"])
    return table.read().drop("event_id")


@query(
    "s12_station_week",
    sql(
        """SELECT station_id, hour, rides FROM hourly_user
WHERE station_id IN ('1', '7', '12') AND hour BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-15'""",
        "hourly_user",
    ),
)
def _(spark, sf):
    """Three stations and one week out of a table laid out along a curve: the manifest names the files."""
    table = SnapshotTable(spark, scratch(spark, "snapshots"), Layout(file_rows=2_000))
    table.append(t.hourly(spark, sf, "user_id"))
    return table.read(stations=["1", "7", "12"], since=datetime(2024, 1, 8), until=datetime(2024, 1, 15))


@query(
    "s16_cached_read",
    sql(
        """SELECT 1 AS version, station_id, hour, rides FROM hourly_old UNION ALL SELECT 1, station_id, hour, rides FROM hourly_old
UNION ALL SELECT 2, station_id, hour, rides FROM hourly""",
        "hourly_old",
        "hourly",
    ),
)
def _(spark, sf):
    """Two cached reads of one version, and a read after a commit, which finds the new rows."""
    table, cache = SnapshotTable(spark, scratch(spark, "snapshots")), TableCache()
    rides = t.hourly(spark, sf)
    table.append(rides.where(before()))
    first, second = (cache.read(table).withColumn("version", F.lit(1)) for _ in range(2))
    table.append(rides.where(~before()))
    third_ = cache.read(table).withColumn("version", F.lit(2))
    return first.unionByName(second).unionByName(third_)


@query("t1_late_hours", sql("SELECT * FROM features_user", "features_user"))
def _(spark, sf):
    """Events come in three parts in no order of time; each repairs the rows after its hours."""
    table = late.series_table(spark, scratch(spark, "series"), buckets=8)
    for n in (2, 0, 1):
        counts = t.events(spark, sf).where(third(n)).groupBy(F.col("user_id").cast("string").alias("station_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
        late.add_hours(table, counts.agg(F.count("*").alias("rides")))
    return late.features(table).select("station_id", "hour", "rides", *lag_names(), "hour_of_day", "day_of_week")


@query("st3_late_repair", sql("SELECT * FROM features", "features"))
def _(spark, sf):
    """A stream of files in no order of time, taken in once, and then again under the same name: nothing is lost or added twice."""
    landing = scratch(spark, "landing")
    events = t.events(spark, sf)
    for n in (1, 2, 0):
        events.where(third(n)).coalesce(1).write.mode("append").parquet(landing)
    table = late.series_table(spark, scratch(spark, "series"), buckets=8)
    for _again in range(2):
        stream = stream_files(spark, landing, events.schema, files_per_batch=1)
        run = (
            stream.writeStream.foreachBatch(late.repair(table, "trips", "event_type", "ts"))
            .option("checkpointLocation", scratch(spark, "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    return late.features(table).select("station_id", "hour", "rides", *lag_names(), "hour_of_day", "day_of_week")


@query("w4_split_by_chunk", sql("SELECT * FROM training_user", "training_user"))
def _(spark, sf):
    """The split of every series, by calendar weeks that are numbered by themselves."""
    frame = t.training(spark, sf, "user_id").drop("rn", "n", "is_train")
    return split_train_test_by_chunk(frame, "week")

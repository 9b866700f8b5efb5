from datetime import datetime, timedelta

from stationflow.schemas import HOURLY_RIDES
from stationflow.sources.store import TableStore
from stationflow.streaming import sinks
from stationflow.streaming.hourly import drain_append, drain_changes, stream_files, stream_hourly
from stationflow.streaming.lags import lag_state_store, stream_lags
from stationflow.streaming.sinks import current_rows

START = datetime(2024, 1, 1)
TRIPS = "start_station_id string, started_at timestamp_ntz"


def land(spark, folder, name, *hours):
    rows = [("a", START + timedelta(hours=h)) for h in hours]
    spark.createDataFrame(rows, TRIPS).coalesce(1).write.parquet(f"{folder}/{name}")


def test_late_rows(spark, tmp_path):
    """Ten hours, then an event inside the delay, one far outside, and a new one."""
    landing, log, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "checkpoint"))
    schema = spark.createDataFrame([], TRIPS).schema
    counts = stream_hourly(stream_files(spark, f"{landing}/*", schema), "3 hours")
    land(spark, landing, "1", *range(10))
    drain_changes(counts, log, checkpoint)
    land(spark, landing, "2", 8.5, 0.5, 10)
    drain_changes(counts, log, checkpoint)
    got = {(r["hour"] - START).total_seconds() / 3600: r["rides"] for r in current_rows(spark, log, ["station_id", "hour"]).collect()}
    assert got == {**{float(h): 1 for h in range(11)}, 8.0: 2}


def test_a_drained_stream_takes_files_once(spark, tmp_path):
    landing, log, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "checkpoint"))
    schema = spark.createDataFrame([], TRIPS).schema
    counts = stream_hourly(stream_files(spark, f"{landing}/*", schema), "30 days")
    land(spark, landing, "1", 1, 1.5)
    for _ in range(2):
        drain_changes(counts, log, checkpoint)
    assert [r["rides"] for r in current_rows(spark, log, ["station_id", "hour"]).collect()] == [2]


def test_stream_lags_skip_old_hours(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "checkpoint"))

    def hours(name, numbers):
        rows = [("a", START + timedelta(hours=h), h) for h in numbers]
        spark.createDataFrame(rows, HOURLY_RIDES).write.parquet(f"{landing}/{name}")

    with lag_state_store(spark):
        for name, numbers in (("1", range(20)), ("2", [*range(15, 31)])):
            hours(name, numbers)
            drain_append(stream_lags(stream_files(spark, f"{landing}/*", HOURLY_RIDES)), out, checkpoint)
    rows = spark.read.parquet(out).orderBy("hour").collect()
    assert [(r["rides"], r["lag_1"], r["lag_28"]) for r in rows] == [(28, 27, 0), (29, 28, 1), (30, 29, 2)]


def test_compaction_bounds_the_log(spark, tmp_path, plan):
    """Batches, a compaction, more batches: the view stays right and the log holds the new ones only."""
    log, store = str(tmp_path / "log"), TableStore(spark, str(tmp_path / "store"))
    write = sinks.write_changes(log)

    def batch(number, *rows):
        write(spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, rides long"), number)

    first, second = datetime(2024, 1, 1), datetime(2024, 1, 1, 1)
    batch(0, ("a", first, 1), ("b", first, 1))
    batch(1, ("a", first, 2))
    view = sinks.current_rows(spark, log, ["station_id", "hour"])
    assert "Sort" not in plan(view)
    assert sinks.compact(spark, log, ["station_id", "hour"], store, "rides") == 1
    assert sinks.batches(spark, log) == []
    batch(2, ("b", first, 5), ("b", second, 7))
    now = sinks.current_rows(spark, log, ["station_id", "hour"], store.read("rides", version=None))
    want = {("a", first, 2), ("b", first, 5), ("b", second, 7)}
    assert {tuple(r) for r in now.collect()} == want
    assert sinks.compact(spark, log, ["station_id", "hour"], store, "rides") == 2
    assert {tuple(r) for r in store.read("rides", version=None).collect()} == want

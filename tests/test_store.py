from datetime import datetime, timedelta

import pytest

from stationflow.schemas import HOURLY_RIDES
from stationflow.sources.store import TableMissing, TableStore

START = datetime(2024, 1, 1)


@pytest.fixture()
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def rides(spark, *rows):
    return spark.createDataFrame([(s, START + timedelta(hours=h), n) for s, h, n in rows], HOURLY_RIDES)


def content(df):
    return sorted((r["station_id"], int((r["hour"] - START).total_seconds() // 3600), r["rides"]) for r in df.collect())


def test_versions(spark, store, tmp_path):
    store.write("t", rides(spark, ("a", 1, 1)), version=2)
    store.write("t", rides(spark, ("a", 1, 2)), version=10)
    # A version without the commit mark does not count.
    (tmp_path / "store" / "t" / "v=11").mkdir()
    assert store.versions("t") == [2, 10]
    assert content(store.read("t", version=None)) == [("a", 1, 2)]
    assert content(store.read("t", version=2)) == [("a", 1, 1)]


def test_missing_table(spark, store):
    with pytest.raises(TableMissing):
        store.read("none")
    with pytest.warns(UserWarning):
        empty = store.read("none", schema=HOURLY_RIDES)
    assert empty.schema == HOURLY_RIDES and empty.isEmpty()


def test_append_twice_adds_once(spark, store):
    store.write("t", rides(spark, ("a", 1, 1), ("b", 0, 1)))
    batch = rides(spark, ("a", 1, 9), ("a", 2, 2), ("b", 1, 9), ("b", 3, 3))
    assert store.append_newer("t", batch)
    # The mark is global: hour 1 of the slower station is lost.
    assert content(store.read("t")) == [("a", 1, 1), ("a", 2, 2), ("b", 0, 1), ("b", 3, 3)]
    assert not store.append_newer("t", batch)
    assert store.read("t").count() == 4


def test_append_per_station(spark, store):
    store.write("t", rides(spark, ("a", 1, 1), ("b", 0, 1)))
    batch = rides(spark, ("a", 1, 9), ("b", 1, 2), ("c", 0, 3))
    assert store.append_newer("t", batch, per_station=True)
    assert content(store.read("t")) == [("a", 1, 1), ("b", 0, 1), ("b", 1, 2), ("c", 0, 3)]
    assert not store.append_newer("t", batch, per_station=True)


def test_append_to_empty_target(spark, store):
    store.write("t", rides(spark, ("a", 1, 1)).limit(0))
    assert not store.append_newer("t", rides(spark, ("a", 1, 1)))


def test_append_keeps_last_of_duplicates(spark, store):
    store.write("t", rides(spark, ("a", 0, 1)))
    from pyspark.sql import functions as F

    batch = rides(spark, ("a", 1, 5), ("a", 1, 7), ("a", 1, 6)).withColumn("seq", F.col("rides") % 7)
    store.append_newer("t", batch, order=["seq"])
    assert content(store.read("t")) == [("a", 0, 1), ("a", 1, 6)]


def test_only_named_partitions_are_replaced(spark, store):
    store.write("t", rides(spark, ("a", 1, 1), ("b", 1, 1)), partition_by=["station_id"])
    store.replace_partitions("t", rides(spark, ("b", 2, 5)), ["station_id"])
    assert content(store.read("t")) == [("a", 1, 1), ("b", 2, 5)]


def test_upsert(spark, store):
    first = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 1)], "station_id string, mae double, run int")
    second = spark.createDataFrame([("b", 3.0, 2), ("c", 4.0, 2)], "station_id string, mae double, run int")
    assert store.upsert("m", first, ["station_id"], ["run"]) == 1
    assert store.upsert("m", second, ["station_id"], ["run"]) == 2
    got = {r["station_id"]: r["mae"] for r in store.read("m", version=None).collect()}
    assert got == {"a": 1.0, "b": 3.0, "c": 4.0}
    assert store.read("m", version=1).count() == 2

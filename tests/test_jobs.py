"""The commands from archives to reports, on trips made from the test events."""

import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stationflow import __main__ as cli
from stationflow.config import DEFAULTS
from stationflow import schemas
from stationflow.operators.series import feature_table
from stationflow.plans import jobs
from stationflow.schemas import HOURLY_RIDES
from stationflow.sources.store import TableStore
from stationflow.sources.trip_csv import export_csv
from suite import source_queries, tables


@pytest.fixture()
def command(spark, monkeypatch):
    def run(*words):
        monkeypatch.setattr(sys, "argv", ["stationflow", *map(str, words)])
        cli.main()

    return run


def test_archives_to_reports(spark, sf_dir, tmp_path, command, capsys):
    raw = tables.raw_trips(spark, sf_dir)
    to_station = F.create_map(*[F.lit(x) for pair in zip(("click", "view", "error"), DEFAULTS.stations) for x in pair])
    raw = raw.withColumn("start_station_id", F.coalesce(to_station[F.col("start_station_id")], "start_station_id"))
    old = F.col("started_at") < "2024-01-20"
    source_queries.write_archives(raw.where(old), f"{tmp_path}/zips")
    command("unpack", "--archives", f"{tmp_path}/zips/*.zip", "--raw", tmp_path / "raw")
    store = ("--store", tmp_path / "store")
    models = ("--models", tmp_path / "models")
    command("load-history", "--raw", f"{tmp_path}/raw/JC-*.csv", *store)
    tables_ = TableStore(spark, str(tmp_path / "store"))
    assert tables_.read("rejected_trips").count() > 0
    assert tables_.read("rejected_files").count() == 0

    recent = tmp_path / "recent"
    export_csv(raw.where(~old).coalesce(1), str(recent / "JC-new.csv"))
    before = jobs.features(tables_).count()
    for expected in ("new rows appended", "no new rows"):
        command("load-recent", "--raw", f"{recent}/JC-*.csv/*.csv", "--files", 1, *store)
        assert expected in capsys.readouterr().out
    assert jobs.features(tables_).count() > before
    assert tables_.read("rejected_trips").select("run").distinct().count() > 1
    assert tables_.read(jobs.PREDICTIONS, schema=schemas.PREDICTIONS).count() == 0

    command("train", *store, *models, "--trees", 2)
    command("infer", *store, *models)
    command("reports", *store, "--out", tmp_path / "reports")
    assert tables_.read(jobs.NOT_FORECAST, version=None).count() == 0
    metrics = tables_.read(jobs.METRICS, version=None)
    assert metrics.where("model <> 'naive_lag_1'").count() == 9
    assert metrics.where("model = 'naive_lag_1'").count() == 5
    ranking = spark.read.option("header", True).csv(str(tmp_path / "reports" / "model_ranking"))
    assert ranking.where("station_id = 'JC115'").count() == 3
    bins = spark.read.option("header", True).csv(str(tmp_path / "reports" / "forecast_bins_by_model"))
    assert {r["model_label"] for r in bins.select("model_label").distinct().collect()} == {
        "Lag-28 Model",
        "Top-K Model",
        "PCA Model",
    }


def hours(spark, station, first, last):
    rows = [(station, datetime(2024, 1, 1) + timedelta(hours=i), i) for i in range(first, last)]
    return spark.createDataFrame(rows, HOURLY_RIDES)


def same(got, expected):
    return got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_batches_add_up_to_one_run(spark, tmp_path):
    """Overlapping batches, a station that is new in the second one, and a load that was cut off while the new one is short."""
    store = TableStore(spark, str(tmp_path))
    jobs.store_history(store, hours(spark, "a", 0, 50))
    assert jobs.store_recent(store, hours(spark, "a", 40, 60).unionByName(hours(spark, "new", 50, 60)))
    before = jobs.features(store).count()
    fresh = hours(spark, "a", 60, 70).unionByName(hours(spark, "new", 60, 70))
    # The next load dies after its features were written: readers see nothing of it.
    with source_queries.cut_off(store):
        jobs.store_recent(store, fresh)
    assert jobs.features(store).count() == before
    assert jobs.store_recent(store, fresh)
    assert jobs.store_recent(store, hours(spark, "a", 60, 90).unionByName(hours(spark, "new", 70, 90)))
    whole = hours(spark, "a", 0, 90).unionByName(hours(spark, "new", 50, 90))
    assert same(jobs.features(store), feature_table(whole))
    assert not jobs.store_recent(store, whole)


def test_history_again(spark, tmp_path):
    """A second history takes the place of the first, and one that was cut off changes nothing."""
    store = TableStore(spark, str(tmp_path))
    jobs.store_history(store, hours(spark, "a", 0, 60))
    jobs.store_recent(store, hours(spark, "a", 60, 80))
    with source_queries.cut_off(store):
        jobs.store_history(store, hours(spark, "b", 0, 40))
    assert same(jobs.features(store), feature_table(hours(spark, "a", 0, 80)))
    jobs.store_recent(store, hours(spark, "a", 80, 90))
    assert same(jobs.features(store), feature_table(hours(spark, "a", 0, 90)))
    jobs.store_history(store, hours(spark, "a", 0, 40))
    jobs.store_recent(store, hours(spark, "a", 40, 90))
    assert same(jobs.features(store), feature_table(hours(spark, "a", 0, 90)))


def test_slow_stations(spark, tmp_path):
    for per_station, rows in ((False, 1), (True, 11)):
        store = TableStore(spark, f"{tmp_path}/{per_station}")
        jobs.store_history(store, hours(spark, "fast", 0, 60).unionByName(hours(spark, "slow", 0, 50)))
        before = jobs.features(store).count()
        jobs.store_recent(store, hours(spark, "slow", 50, 61), per_station)
        assert jobs.features(store).count() == before + rows


def test_own_marks_keep_lags(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    jobs.store_history(store, hours(spark, "a", 0, 40).unionByName(hours(spark, "b", 0, 30)))
    for last in (50, 65, 80):
        jobs.store_recent(store, hours(spark, "a", 30, last + 20).unionByName(hours(spark, "b", 25, last)), per_station=True)
    assert same(jobs.features(store), feature_table(hours(spark, "a", 0, 100).unionByName(hours(spark, "b", 0, 80))))


def test_fetch_plan(spark, tmp_path, command):
    (tmp_path / "have").mkdir()
    for month in ("202401", "202403"):
        (tmp_path / "have" / f"T-{month}.zip").write_bytes(b"x")
    (tmp_path / "have" / "other.zip").write_bytes(b"x")
    command(
        "plan-fetch", "--prefix", "T-", "--suffix", ".zip", "--have", f"{tmp_path}/have/*.zip",
        "--first", "2024-01-15", "--last", "2024-04-02", "--out", tmp_path / "plan",
    )
    plan = spark.read.option("header", True).csv(str(tmp_path / "plan")).collect()
    assert sorted((r["file_name"], r["present"], r["recent"]) for r in plan) == [
        ("T-202401.zip", "true", "false"), ("T-202402.zip", "false", "false"), ("T-202403.zip", "true", "true"), ("T-202404.zip", "false", "true"),
    ]


def test_reports_of_an_empty_store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    with pytest.warns(UserWarning):
        jobs.write_reports(store, str(tmp_path / "out"), datetime(2024, 2, 1))
    assert (tmp_path / "out" / "mae_table" / "_SUCCESS").exists()


def test_feature_table_without_loads(spark, tmp_path):
    """A feature table that no load wrote is read as it is, and loads can follow it."""
    store = TableStore(spark, str(tmp_path))
    store.write(jobs.FEATURES, feature_table(hours(spark, "a", 0, 60)))
    assert same(jobs.features(store), feature_table(hours(spark, "a", 0, 60)))
    assert jobs.series_end(store).count() == DEFAULTS.n_lags
    assert jobs.store_recent(store, hours(spark, "a", 50, 90))
    assert same(jobs.features(store), feature_table(hours(spark, "a", 0, 90)))
    assert not jobs.store_recent(store, hours(spark, "a", 0, 90))

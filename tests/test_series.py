from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stationflow.models.forecast import carry_forward, recursive_mean
from stationflow.operators import series
from stationflow.operators.filters import newer_than, newer_than_per_station
from stationflow.operators.numbering import number_rows
from stationflow.schemas import HOURLY_RIDES

START = datetime(2024, 1, 1)


def hours(spark, station, count, start=START, step=1):
    rows = [(station, start + timedelta(hours=i * step), i + 1) for i in range(count)]
    return spark.createDataFrame(rows, HOURLY_RIDES)


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize(("length", "featured", "framed"), [(27, 0, 0), (28, 0, 0), (29, 1, 0), (56, 28, 0), (57, 29, 1)])
def test_warm_up_rows_go(spark, length, featured, framed):
    features = series.feature_table(hours(spark, "a", length))
    assert features.count() == featured
    assert series.training_frame(features).count() == framed


def test_lag_counts_rows_not_hours(spark):
    gapped = hours(spark, "a", 40, step=5)
    row = series.feature_table(gapped).orderBy("hour").first()
    assert (row["rides"], row["lag_1"], row["lag_28"]) == (29, 28, 1)


def test_lags_do_not_cross_stations(spark):
    both = hours(spark, "a", 30).unionByName(hours(spark, "b", 28))
    assert [r["station_id"] for r in series.feature_table(both).select("station_id").distinct().collect()] == ["a"]


def test_recomputed_lags_equal_stored_ones(spark):
    features = series.feature_table(hours(spark, "a", 80))
    frame = series.training_frame(features).select(features.columns[:31])
    kept = features.select(features.columns[:31]).join(frame.select("hour"), "hour", "left_semi")
    same(frame.select(sorted(frame.columns)), kept.select(sorted(frame.columns)))
    assert series.training_frame(features, reuse_stored_lags=True).count() == 52


@pytest.mark.parametrize("unit", ["day", "week", "month"])
def test_chunked_lags_equal_plain_ones(spark, unit):
    # Dense, sparse (less than a row a day) and very sparse (months without a row) series.
    table = (
        hours(spark, "dense", 400)
        .unionByName(hours(spark, "sparse", 90, step=31))
        .unionByName(hours(spark, "rare", 40, step=1500))
    )
    same(series.add_lags_by_chunk(table, unit=unit), series.add_lags(table))


def test_one_window_for_all_lags(spark, plan):
    text = plan(series.add_lags(hours(spark, "a", 3)))
    assert text.count("Window [") + text.count("Window(") <= 1 and text.count("Exchange hashpartitioning") == 1


def test_split_is_chronological(spark):
    frame = series.split_train_test(hours(spark, "a", 14))
    assert [r["is_train"] for r in frame.orderBy("hour").collect()] == [True] * 11 + [False] * 3


def test_keep_last(spark):
    rows = spark.createDataFrame(
        [("a", 1, "old", 1), ("a", 1, "new", 3), ("a", 1, "mid", 2), ("b", 1, None, 1)],
        "station_id string, hour int, v string, seq int",
    )
    got = series.keep_last(rows, ["station_id", "hour"], ["seq"]).drop("seq")
    assert sorted((tuple(r) for r in got.collect())) == [("a", 1, "new"), ("b", 1, None)]


def test_keep_last_combines_before_the_shuffle(spark, plan):
    rows = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    assert "partial_max_by" in plan(series.keep_last(rows, ["k"], ["id"]))


def test_short_series_are_not_forecast_but_reported(spark):
    table = hours(spark, "long", 28).unionByName(hours(spark, "short", 27))
    assert [r["station_id"] for r in series.seed_state(table).collect()] == ["long"]
    assert [r["station_id"] for r in series.short_series(table).collect()] == ["short"]


def test_seed_is_newest_first(spark):
    row = series.seed_state(hours(spark, "a", 40)).first()
    assert row["recent"] == [float(v) for v in range(40, 12, -1)]
    assert row["last_hour"] == START + timedelta(hours=39)


def test_forecast_grid(spark):
    table = hours(spark, "a", 40).unionByName(hours(spark, "b", 30))
    for forecast in (recursive_mean, carry_forward):
        rows = forecast(series.seed_state(table)).orderBy("station_id", "hour").collect()
        assert len(rows) == 2 * 168
        times = [r["hour"] for r in rows if r["station_id"] == "b"]
        assert times == [START + timedelta(hours=30 + i) for i in range(168)]
    grid = series.horizon_grid(table)
    assert grid.count() == 2 * 168


def test_recursive_mean_by_hand(spark):
    known = [float(v) for v in range(1, 41)]
    for _ in range(168):
        known.append(sum(known[-28:]) / 28)
    got = [r["predicted_rides"] for r in recursive_mean(series.seed_state(hours(spark, "a", 40))).orderBy("hour").collect()]
    assert got == pytest.approx(known[40:], abs=1e-9)


def test_batch_lags_reach_into_the_stored_series(spark):
    everything = hours(spark, "a", 100)
    old = F.col("hour") < F.lit(START + timedelta(hours=60)).cast("timestamp_ntz")
    batch = series.features_after(everything.where(~old), series.last_rows(everything.where(old), 28))
    same(batch, series.feature_table(everything).where(~old).select(batch.columns))


def test_high_water_mark_is_global_unless_asked(spark):
    stored = hours(spark, "a", 10).unionByName(hours(spark, "slow", 5))
    offered = hours(spark, "a", 12).unionByName(hours(spark, "slow", 12)).unionByName(hours(spark, "new", 3))
    assert newer_than(offered, stored).groupBy().sum("rides").first()[0] == 2 * (11 + 12)
    assert newer_than_per_station(offered, stored).count() == 2 + 7 + 3


def test_empty_target_passes_nothing(spark):
    offered = hours(spark, "a", 3)
    assert newer_than(offered, offered.limit(0)).count() == 0


def test_number_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    numbered = number_rows(df, ["v"], "n").collect()
    assert sorted((r["v"], r["n"]) for r in numbered) == [(i, i + 1) for i in range(1000)]

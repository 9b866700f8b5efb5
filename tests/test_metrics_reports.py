from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stationflow.functions.dims import model_dim, station_dim
from stationflow.operators import metrics
from stationflow.plans import reports
from stationflow.schemas import FORECASTS, MODEL_METRICS, PREDICTIONS


@pytest.fixture()
def scores(spark):
    rows = [
        ("JC115", "topk", "top_k", 2.0, None),
        ("JC115", "lag28", "all_lags", 2.0, None),
        ("JC115", "pca", "pca_reduction", 1.5, 91.25),
        ("HB102", "naive_lag_1", None, 3.0, None),
        ("XX999", "lag28", "all_lags", 1.0, None),
    ]
    return spark.createDataFrame(rows, MODEL_METRICS)


def test_equal_errors_rank_by_model_name(scores):
    got = [(r["model"], r["rank"]) for r in metrics.ranked(scores).where("station_id = 'JC115'").orderBy("rank").collect()]
    assert got == [("pca", 1), ("lag28", 2), ("topk", 3)]
    best = {r["station_id"]: (r["best_model"], r["best_mae"]) for r in metrics.best_model(scores).collect()}
    assert best == {"JC115": ("pca", 1.5), "HB102": ("naive_lag_1", 3.0), "XX999": ("lag28", 1.0)}


def test_mae_table_names_and_defaults(spark, scores):
    rows = reports.mae_table(scores, station_dim(spark), model_dim(spark)).orderBy("display_index").collect()
    assert [r["display_index"] for r in rows] == [1, 2, 3, 4]
    assert {(r["model_label"], r["station_name"], r["strategy_label"]) for r in rows} == {
        ("Lag-28 Model", "Newport Parkway", "All Lags"),
        ("PCA Model", "Newport Parkway", "PCA Reduction"),
        ("Top-K Model", "Newport Parkway", "Top 10 Features"),
        ("naive_lag_1", "Hoboken Terminal", "Unknown"),
    }


def test_union_keeps_extra_columns_and_refuses_case_twins(spark):
    a = spark.createDataFrame([("s", 1.0)], "station_id string, mae double")
    b = spark.createDataFrame([("s", 2.0, 90.0)], "station_id string, mae double, explained_variance double")
    rows = {r["model_label"]: r["explained_variance"] for r in metrics.union_labelled({"A": a, "B": b}).collect()}
    assert rows == {"A": None, "B": 90.0}
    with pytest.raises(ValueError):
        metrics.union_labelled({"A": a.withColumn("Model", F.lit("x"))}, label="model")


def test_daily_mean_skips_nan_and_null(spark):
    day = [datetime(2024, 1, 1, h) for h in range(4)]
    rows = [
        ("m", "a", day[0], 2, 1.0),
        ("m", "a", day[1], 4, float("nan")),
        ("m", "a", day[2], None, 3.0),
        ("m", "a", None, 100, 100.0),
    ]
    got = reports.daily_actual_vs_predicted(spark.createDataFrame(rows, PREDICTIONS)).collect()
    assert {(r["type"], r["rides"]) for r in got} == {("Predicted Rides", 2.0), ("Actual Rides", 3.0)}


def test_text_hours_are_read(spark):
    rows = [("m", "a", "2024-01-01 05:00:00", 1.0), ("m", "a", "2024-01-01 06:00:00", 3.0), ("m", "a", "no", 9.0)]
    df = spark.createDataFrame(rows, "model string, station_id string, hour string, predicted_rides double")
    got = sorted((r["hour"].hour, r["predicted_rides"]) for r in reports.forecast_bins(df).collect())
    assert got == [(0, 1.0), (6, 3.0)]


def test_recent_daily_window(spark):
    rows = [("lag28", "a", datetime(2024, m, 1), 1, 1.0) for m in (1, 2, 3, 4)]
    got = reports.recent_daily(spark.createDataFrame(rows, PREDICTIONS), datetime(2024, 4, 1), model_dim(spark))
    assert sorted(str(r["date"]) for r in got.collect()) == ["2024-02-01", "2024-03-01", "2024-04-01"]


def test_station_filter_reaches_the_scan(spark, tmp_path, plan):
    rows = spark.createDataFrame([("m", "a", datetime(2024, 1, 1), 1.0)], FORECASTS)
    rows.write.parquet(str(tmp_path / "f"))
    report = reports.forecast_bins(spark.read.parquet(str(tmp_path / "f"))).where("station_id = 'a'")
    assert "EqualTo(station_id,a)" in plan(report)

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.config import lag_names
from stationflow.models.registry import ModelRegistry, selected_features, split_importance, top_features
from stationflow.models.trees import STRATEGIES, TreeParams
from stationflow.operators.series import feature_table, seed_state
from stationflow.operators.trips import hourly_counts
from stationflow.plans import jobs
from stationflow.sources.store import TableMissing, TableStore

PARAMS = TreeParams(trees=3, depth=3)
STATIONS = ["click", "a/b c"]


@pytest.fixture(scope="module")
def trained(spark, sf_dir, tmp_path_factory):
    """A store and registry after history load and training; one station id needs escaping."""
    root = tmp_path_factory.mktemp("trained")
    store, registry = TableStore(spark, f"{root}/store"), ModelRegistry(spark, f"{root}/models")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.when(F.col("event_type") == "view", "a/b c").otherwise(F.col("event_type"))
    hourly = hourly_counts(events.withColumn("kind", kind), "kind", "ts")
    store.write(jobs.FEATURES, feature_table(hourly))
    frame = jobs.current_frame(store).persist()
    metrics = jobs.train(store, registry, datetime(2024, 2, 1), STATIONS, PARAMS)
    return store, registry, frame, metrics.collect()


def test_metrics(trained):
    store, _, _, rows = trained
    assert {(r["station_id"], r["model"]) for r in rows} == {(s, m) for s in STATIONS for m in STRATEGIES}
    assert all(r["mae"] > 0 for r in rows)
    assert all((r["explained_variance"] is not None) == (r["model"] == "pca") for r in rows)
    assert store.read(jobs.METRICS, version=None).count() == 6


def test_naive_metrics_join_the_table(trained):
    store, _, _, _ = trained
    jobs.train_naive(store, datetime(2024, 2, 2))
    table = store.read(jobs.METRICS, version=None)
    assert table.where("model = 'naive_lag_1'").count() == 5
    assert table.count() == 11


def test_newest_version_is_loaded(trained, spark, tmp_path):
    _, registry, _, _ = trained
    model = registry.load("lag28", "click")
    other = ModelRegistry(spark, str(tmp_path))
    assert [other.save("lag28", "click", model) for _ in range(2)] == [1, 2]
    assert other.versions("lag28", "click") == [1, 2]
    with pytest.raises(TableMissing):
        other.load("lag28", "nowhere")


def test_run_log(trained):
    _, registry, _, _ = trained
    runs = registry.runs().collect()
    assert len(runs) == 6 and {r["strategy"] for r in runs} == set(STRATEGIES)
    assert runs[0]["params"]["trees"] == "3"


def test_node_table_layout(trained):
    _, registry, _, _ = trained
    nodes = registry.nodes(STRATEGIES, STATIONS).toPandas()
    assert set(zip(nodes.station_id, nodes.strategy)) == {(s, m) for s in STATIONS for m in STRATEGIES}
    weights = nodes.groupby("tree_id").tree_weight.unique()
    assert [list(w) for w in weights] == [[1.0], [0.1], [0.1]]
    leaves = nodes[nodes.feature_index < 0]
    assert (leaves.left == -1).all() and (leaves.right == -1).all()


def test_importance_covers_all_lags(trained):
    _, registry, _, _ = trained
    importance = split_importance(registry.nodes(["lag28"], STATIONS))
    assert importance.count() == 2 * 28
    chosen = selected_features(top_features(importance))
    assert all(len(set(v)) == 10 for v in chosen.values())
    for station, indices in chosen.items():
        assert registry.load("topk", station).stages[1].getIndices() == indices


def test_ties_prefer_the_smaller_feature(spark):
    rows = [("s", "lag28", i, 1 if i in (3, 5) else 0) for i in range(28)]
    importance = spark.createDataFrame(rows, "station_id string, strategy string, feature_index int, importance long")
    assert selected_features(top_features(importance, 4)) == {"s": [1, 0, 5, 3]}


def test_forecast_equals_step_by_step_prediction(trained, spark):
    """The one-job forecast against a driver loop that calls the fitted pipelines, all strategies."""
    _, registry, frame, _ = trained
    steps = 12
    got = {
        (r["model"], r["station_id"], r["hour"]): r["predicted_rides"]
        for r in jobs.future_forecast(frame, registry, stations=STATIONS).collect()
    }
    assert len(got) == 3 * 2 * 168
    seeds = {r["station_id"]: r for r in seed_state(frame).collect()}
    for strategy in STRATEGIES:
        for station in STATIONS:
            model = registry.load(strategy, station)
            recent = list(seeds[station]["recent"])
            hours = sorted(h for m, s, h in got if (m, s) == (strategy, station))
            assert (hours[0] - seeds[station]["last_hour"]).total_seconds() == 3600
            assert set(np.diff(np.array(hours, "datetime64[s]")).astype(int)) == {3600}
            for step in range(steps):
                row = spark.createDataFrame([tuple(recent[:28])], ", ".join(f"{c} double" for c in lag_names()))
                value = model.transform(row).first()["predicted_rides"]
                assert got[strategy, station, hours[step]] == pytest.approx(value, abs=1e-9)
                recent.insert(0, value)


def test_station_without_model_has_no_forecast(trained):
    _, registry, frame, _ = trained
    forecast = jobs.future_forecast(frame, registry, ["lag28"], ["click", "purchase"])
    assert [r["station_id"] for r in forecast.select("station_id").distinct().collect()] == ["click"]


def test_inference_tables(trained):
    store, registry, frame, _ = trained
    jobs.infer(store, registry, STATIONS)
    jobs.infer(store, registry, STATIONS)
    tests = frame.where(~F.col("is_train") & F.col("station_id").isin(*STATIONS)).count()
    assert store.read(jobs.PREDICTIONS).count() == 3 * tests
    assert store.read(jobs.FORECASTS).count() == 3 * 2 * 168

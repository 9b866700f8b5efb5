"""Models of all stations at once: the learner and the components against plain versions, storage and forecasts."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow import schemas
from stationflow.config import lag_names
from stationflow.models import forest
from stationflow.models.components import components, decomposed
from stationflow.models.forecast import predict_by_nodes, recursive_trees
from stationflow.models.histogram import Learner, split_points
from stationflow.models.tables import ModelTables
from stationflow.models.trees import STRATEGIES, TreeParams
from stationflow.operators.series import feature_table, seed_state
from stationflow.operators.trips import hourly_counts
from stationflow.plans import jobs
from stationflow.sources.store import TableStore

PARAMS = TreeParams(trees=4, depth=3)


def brute_tree(x, y, params, cuts, depth=0, node=0):
    """One tree, trying every cut of every input with plain sums; cuts lie between all values of an input."""
    out = {node: (-1, 0.0, sum(y) / len(y))}
    if depth == params.depth:
        return out
    best = None
    for f in range(x.shape[1]):
        for cut in cuts[f]:
            low = x[:, f] <= cut
            if min(low.sum(), (~low).sum()) >= params.min_rows:
                error = sum((y[s] - y[s].mean()) @ (y[s] - y[s].mean()) for s in (low, ~low))
                if best is None or error < best[0] - 1e-9:
                    best = (error, f, cut, low)
    if best is None or best[0] >= ((y - y.mean()) @ (y - y.mean())) - 1e-9:
        return out
    _, f, threshold, low = best
    out[node] = (f, threshold, sum(y) / len(y))
    out |= brute_tree(x[low], y[low], params, cuts, depth + 1, 2 * node + 1)
    return out | brute_tree(x[~low], y[~low], params, cuts, depth + 1, 2 * node + 2)


def value_of(tree, row):
    node = 0
    while tree[node][0] >= 0:
        node = 2 * node + 1 + (row[tree[node][0]] > tree[node][1])
    return tree[node][2]


@pytest.mark.parametrize("seed", range(5))
def test_learner_equals_a_plain_one(seed):
    rng = np.random.default_rng(seed)
    x, params = np.round(rng.normal(size=(80, 4)) * 20), TreeParams(trees=4, depth=3, min_rows=5)
    y = x[:, 1] * 2 - (x[:, 3] > 4) * 30 + rng.normal(size=80) * 5
    values = [sorted(set(column)) for column in x.T]
    cuts = [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in values]
    predicted, want = np.zeros(80), []
    for n in range(params.trees):
        tree = brute_tree(x, y - predicted, params, cuts)
        want.append(tree)
        predicted += np.array([value_of(tree, r) for r in x]) * (params.rate if n else 1.0)
    got = Learner(x, y, params).trees()
    for mine, tree in zip(got, want, strict=True):
        assert {n[0]: n[1] for n in mine} == {k: v[0] for k, v in tree.items()}
        for node, _, threshold, left, right, value in mine:
            assert (threshold, value) == pytest.approx((tree[node][1], tree[node][2]))
            assert (left, right) == ((2 * node + 1, 2 * node + 2) if tree[node][0] >= 0 else (-1, -1))


def test_learner_edge_cases():
    params = TreeParams(trees=2, depth=3, min_rows=1)
    for x, y in ((np.ones((5, 3)), np.arange(5.0)), (np.arange(6.0).reshape(2, 3), np.ones(2)), (np.ones((1, 3)), np.array([7.0]))):
        trees = Learner(x, y, params).trees()
        assert len(trees[0]) == 1 and trees[0][0][5] == pytest.approx(y.mean())
    many = split_points(np.random.default_rng(0).normal(size=5_000), 255)
    assert 200 < len(many) < 255 and (np.diff(many) > 0).all()


def test_components_equal_a_plain_decomposition():
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 50, size=(n, 28)) @ np.diag(rng.integers(1, 5, 28)) for n in (200, 40, 5, 1)] + [np.full((9, 28), 3)]
    upper = np.triu_indices(28)
    sums = np.array([r.sum(0) for r in rows], float)
    products = np.array([(r.T @ r)[upper] for r in rows], float)
    mean, loadings, shares = decomposed(np.array([len(r) for r in rows], float), sums, products, 10)
    for r, m, own, share in zip(rows, mean, loadings, shares):
        centred = r - r.mean(0)
        _, s, v = np.linalg.svd(centred, full_matrices=False)
        total = (s**2).sum()
        want = np.zeros(10) if total == 0 else np.pad(s**2 / total, (0, 10))[:10]
        assert np.abs(share - want).max() < 1e-9 and np.allclose(m, r.mean(0))
        assert np.allclose(own @ own.T, np.eye(10), atol=1e-9)
        for k in range(min(3, len(r) - 2)):
            if total:
                assert abs(abs(own[k] @ v[k]) - 1) < 1e-6
                assert own[k][np.abs(own[k]).argmax()] > 0


@pytest.fixture(scope="module")
def trained(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("everywhere")
    store, models = TableStore(spark, f"{root}/store"), ModelTables(spark, f"{root}/models")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.when(F.col("event_type") == "view", "a/b c'").otherwise(F.col("event_type"))
    store.write(jobs.FEATURES, feature_table(hourly_counts(events.withColumn("kind", kind), "kind", "ts")))
    metrics = jobs.train_everywhere(store, models, datetime(2024, 2, 1), PARAMS).collect()
    return store, models, jobs.current_frame(store).persist(), metrics


def test_every_station_has_every_model(trained):
    store, models, frame, metrics = trained
    stations = {r["station_id"] for r in frame.select("station_id").distinct().collect()}
    assert {(r["station_id"], r["model"]) for r in metrics} == {(s, m) for s in stations for m in STRATEGIES}
    assert all(r["mae"] > 0 and (r["explained_variance"] is not None) == (r["model"] == "pca") for r in metrics)
    assert store.read(jobs.METRICS, version=None).count() == len(metrics)
    assert models.runs().count() == len(metrics) and models.runs().first()["params"]["trees"] == "4"
    nodes = models.nodes().toPandas()
    assert [list(w) for w in nodes.groupby("tree_id").tree_weight.unique()] == [[1.0], [0.1], [0.1], [0.1]]


def test_components_have_their_variance(trained):
    _, _, frame, _ = trained
    for row in components(frame).collect():
        x = np.array(frame.where(F.col("is_train") & (F.col("station_id") == row["station_id"])).select(*lag_names()).collect(), float)
        s = np.linalg.svd(x - x.mean(0), compute_uv=False) ** 2
        assert sum(row["ratios"]) == pytest.approx(s[:10].sum() / s.sum(), abs=1e-9)


def test_predictions_and_forecasts_equal_the_single_ones(trained):
    _, models, frame, _ = trained
    newest = models.newest().persist()
    nodes, inputs = models.nodes(), newest.select("station_id", "strategy", F.lit(1).alias("version"), *forest.INPUT_FIELDS)
    keys = ["model", "station_id", "hour"]
    a, b = forest.predict_rows(frame, newest), predict_by_nodes(frame, nodes, inputs)
    both = a.join(b.withColumnRenamed("predicted_rides", "other"), [*keys, "actual_rides"])
    assert both.count() == a.count() == b.count() > 0
    assert both.where("abs(predicted_rides - other) > 1e-9").isEmpty()
    a, b = forest.forecast_in_step(seed_state(frame), newest), recursive_trees(seed_state(frame), nodes, inputs)
    both = a.join(b.withColumnRenamed("predicted_rides", "other"), keys)
    assert both.count() == a.count() == b.count() == 168 * newest.count()
    assert both.where("abs(predicted_rides - other) > 1e-9").isEmpty()


def test_newest_models_count(trained, spark, tmp_path):
    _, models, _, _ = trained
    other = ModelTables(spark, str(tmp_path))
    inputs = models.newest().select("station_id", "strategy", *forest.INPUT_FIELDS, "explained_variance")
    assert other.save(inputs, models.nodes(), datetime(2024, 2, 1), {"n": 1}) == 1
    assert other.save(inputs.where("station_id = 'click'"), models.nodes().where("tree_id = 0"), datetime(2024, 2, 2), {"n": 2}) == 2
    trees = {(r["station_id"] == "click", r["trees"]) for r in other.newest().select("station_id", F.size(F.array_distinct("tree_id")).alias("trees")).collect()}
    assert trees == {(True, 1), (False, 4)}
    assert other.newest(["pca"], ["click"]).count() == 1 and other.runs().count() == inputs.count() + 3


def test_inference_everywhere(trained):
    store, models, frame, _ = trained
    for _ in range(2):
        jobs.infer_everywhere(store, models)
    assert store.read(jobs.PREDICTIONS).count() == 3 * frame.where("NOT is_train").count()
    assert store.read(jobs.FORECASTS, schema=schemas.FORECASTS).count() == 168 * models.newest().count()


def test_many_stations_take_as_many_jobs_as_few(spark):
    """The plan of a fit holds one exchange of the rows, however many stations there are."""
    from stationflow.models.histogram import all_lags_inputs, fit_all
    from stationflow.operators.series import training_frame

    rows = spark.range(300 * 120).select(
        (F.col("id") % 300).cast("string").alias("station_id"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") / 300).cast("int"))).cast("timestamp_ntz").alias("hour"),
        F.pmod(F.xxhash64("id"), F.lit(20)).alias("rides"),
    )
    frame = training_frame(feature_table(rows)).persist()
    nodes = fit_all(frame, all_lags_inputs(frame), TreeParams(trees=3, depth=2, min_rows=5))
    assert nodes.select("station_id").distinct().count() == 300

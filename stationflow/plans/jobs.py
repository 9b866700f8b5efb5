"""The end-to-end jobs: load history, take in recent data, train, infer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stationflow import schemas
from stationflow.config import DEFAULTS, REQUIRED_TRIP_COLUMNS
from stationflow.functions.dims import literal_dim, model_dim, station_dim
from stationflow.models.forecast import predict_by_nodes, recursive_trees
from stationflow.models.forest import forecast_in_step, predict_rows, packed
from stationflow.models.histogram import fit_all, model_inputs
from stationflow.models.registry import ModelRegistry, selected_features, split_importance, top_features
from stationflow.models.tables import ModelTables
from stationflow.models.trees import STRATEGIES, TreeParams, explained_variance, fit_stations, predict
from stationflow.operators.filters import newer_than, newer_than_per_station
from stationflow.operators.metrics import NAIVE_MODEL, mae, metrics_table, naive_baseline
from stationflow.operators.series import feature_table, features_after, last_rows, naive_predictions, seed_state, training_frame
from stationflow.operators.trips import clean_trips, hourly_counts, rejected_trips
from stationflow.plans import reports
from stationflow.session import fixed
from stationflow.sources.store import TableStore
from stationflow.sources.trip_csv import SOURCE, TripScan, export_csv

FEATURES = "hourly_features"
TAIL = "series_end"
LOADS = "loads"
LOAD = "load_id"
METRICS = "model_metrics"
PREDICTIONS = "predictions"
# The baseline predicts every row and not the test rows only, so its predictions have a table of their own.
NAIVE_PREDICTIONS = "naive_predictions"
FORECASTS = "forecasts"

CONSTANT_MODELS = "constant_models"
NOT_FORECAST = "not_forecast"

# Strategy names in the metrics table.
STRATEGY_NAMES = {"lag28": "all_lags", "topk": "top_k", "pca": "pca_reduction"}


def _state(store: TableStore):
    """What the last committed load left: its number, and the version of the feature table it belongs to.

    None where no load was committed, such as beside a feature table that was written by hand.
    """
    return store.read(LOADS, version=None).first() if store.versions(LOADS) else None


def _next_load(store: TableStore) -> int:
    return max(store.versions(LOADS), default=0) + 1


def _commit(store: TableStore, load: int, features_version: int) -> None:
    """One small table version makes a load's features and series end valid together."""
    row = store.spark.range(1).select(F.lit(load).alias(LOAD), F.lit(features_version).alias("features_version"))
    store.write(LOADS, row, load)


def features(store: TableStore) -> DataFrame:
    """The feature rows of all committed loads; without loads the newest feature table as it is."""
    state = _state(store)
    if state is None:
        return store.read(FEATURES, version=None).drop(LOAD)
    rows = store.read(FEATURES, state["features_version"])
    return rows.where(F.col(LOAD) <= state[LOAD]).drop(LOAD)


def series_end(store: TableStore) -> DataFrame:
    """The last rows of each series after the last committed load, or of the feature table without loads."""
    state = _state(store)
    if state is None:
        return last_rows(features(store).select("station_id", "hour", "rides"), DEFAULTS.n_lags).drop("rn")
    return store.read(TAIL, state[LOAD])


def _adopt(store: TableStore) -> None:
    """Commit a feature table that no load wrote as the first load, so that loads can follow it.

    It becomes a version of its own; the table as it was found stays.
    """
    load = max(_next_load(store), store.latest(FEATURES) + 1)
    store.write(FEATURES, features(store).withColumn(LOAD, F.lit(load)), load, [LOAD])
    store.write(TAIL, series_end(store), load)
    _commit(store, load, load)


def load_history(store: TableStore, trips: DataFrame) -> None:
    """Raw trips to the feature table, and the end of each series beside it."""
    store_history(store, hourly_counts(clean_trips(trips)))


def store_history(store: TableStore, hourly: DataFrame) -> None:
    """Start the feature table anew; readers see the old one until the new one is committed."""
    load = _next_load(store)
    # Two tables come from the counts; the trips behind them are read once.
    hourly = fixed(hourly, "hourly")
    store.write(FEATURES, feature_table(hourly).withColumn(LOAD, F.lit(load)), load, [LOAD])
    store.write(TAIL, last_rows(hourly, DEFAULTS.n_lags).drop("rn"), load)
    _commit(store, load, load)


def keep_rejects(store: TableStore, scan: TripScan, run: str) -> None:
    """Store what the scan of one run set aside, under the run's name, beside what earlier runs did."""
    dropped = rejected_trips(scan.rows).select(SOURCE, "reason", *REQUIRED_TRIP_COLUMNS)
    damaged = scan.rejected_rows.select(SOURCE, "reason", "line", *REQUIRED_TRIP_COLUMNS)
    rows = damaged.unionByName(dropped, allowMissingColumns=True)
    store.append("rejected_trips", rows.withColumn("run", F.lit(run)))
    store.append("rejected_files", scan.rejected_files.withColumn("run", F.lit(run)))


def load_recent(store: TableStore, trips: DataFrame, seeded: bool = True, per_station: bool = False) -> bool:
    """Append the features of recent trips that are newer than the stored ones."""
    return store_recent(store, hourly_counts(clean_trips(trips)), per_station, seeded)


def store_recent(store: TableStore, hourly: DataFrame, per_station: bool = False, seeded: bool = True) -> bool:
    """Append features of the hours after the stored ones; False if there are none.

    Reads the end of each series (28 rows a station) and not the feature table, whose size would
    otherwise set the cost of every batch.  The end also keeps the first hours of new stations,
    which have no features yet.  ``seeded`` takes the first lags of the batch from that end; without
    it the batch loses its own first 28 hours of each station.

    The mark is the committed end alone.  A load that was cut off has committed nothing, so its
    successor sees the same mark, has the same number and replaces what the other left.
    """
    columns = ["station_id", "hour", "rides"]
    if _state(store) is None:
        _adopt(store)
    state = _state(store)
    load = _next_load(store)
    tail = store.read(TAIL, state[LOAD]).select(columns)
    newer = newer_than_per_station if per_station else newer_than
    fresh = fixed(newer(hourly, tail).select(columns), "fresh")
    if fresh.isEmpty():
        return False
    added = features_after(fresh, tail) if seeded else newer(feature_table(hourly), tail)
    store.replace_partitions(FEATURES, added.withColumn(LOAD, F.lit(load)), [LOAD], state["features_version"])
    store.write(TAIL, last_rows(tail.unionByName(fresh), DEFAULTS.n_lags).select(columns), load)
    _commit(store, load, state["features_version"])
    return True


def current_frame(store: TableStore) -> DataFrame:
    """The training frame of today's feature table."""
    return training_frame(features(store))


def train_naive(store: TableStore, run_ts: datetime, registry: ModelRegistry | None = None) -> DataFrame:
    """Score the naive baseline of every station: metrics, predictions, constant model and run log."""
    rows = features(store)
    scores = fixed(naive_baseline(rows), "naive")
    stamped = scores.select("station_id", "mean_rides", F.lit(run_ts).cast("timestamp").alias("run_ts"))
    store.upsert(CONSTANT_MODELS, stamped, keys=("station_id",), order=("run_ts",))
    predicted = naive_predictions(rows).select(
        F.lit(NAIVE_MODEL).alias("model"), "station_id", "hour",
        F.col("rides").alias("actual_rides"), F.col("predicted_rides").cast("double").alias("predicted_rides"),
    )
    store.replace_partitions(NAIVE_PREDICTIONS, predicted, ["model"])
    scores = scores.select("station_id", F.lit(NAIVE_MODEL).alias("model"), "mae")
    if registry is not None:
        registry.log_runs(scores, NAIVE_MODEL, {"model": "previous row"}, run_ts)
    _merge_metrics(store, metrics_table(scores), run_ts)
    return scores


def fit_strategy(
    registry: ModelRegistry,
    frame: DataFrame,
    strategy: str,
    stations: Sequence[str],
    params: TreeParams = TreeParams(),
    parallelism: int = 4,
):
    """Fit, store and return the models of one strategy.

    The top-K strategy ranks lags by the splits of the stored 28-lag models, so those come first.
    """
    selected = None
    if strategy == "topk":
        selected = selected_features(top_features(split_importance(registry.nodes(["lag28"], stations))))
    models = fit_stations(frame, strategy, stations, params, selected, parallelism)
    registry.save_all(strategy, models, parallelism)
    return models


def train(
    store: TableStore,
    registry: ModelRegistry,
    run_ts: datetime,
    stations: Sequence[str] = DEFAULTS.stations,
    params: TreeParams = TreeParams(),
    parallelism: int = 4,
) -> DataFrame:
    """Fit all strategies, store models, run log and metrics; return the metrics rows."""
    frame = current_frame(store).where(F.col("station_id").isin(*stations)).persist()
    tables = []
    for strategy in STRATEGIES:
        models = fit_strategy(registry, frame, strategy, stations, params, parallelism)
        scores = score(frame, models, strategy)
        registry.log_runs(scores, strategy, run_params(strategy, params), run_ts)
        tables.append(scores)
    metrics = reduce(lambda a, b: a.unionByName(b), tables)
    _merge_metrics(store, metrics, run_ts)
    frame.unpersist()
    return metrics


def fit_everywhere(
    models: ModelTables, frame: DataFrame, strategy: str, run_ts: datetime, params: TreeParams = TreeParams()
) -> DataFrame:
    """Fit one strategy for every station of ``frame``, store the models with one commit, return their metrics rows.

    The number of jobs does not depend on the number of stations.  The top-K strategy ranks lags by the
    splits of the stored 28-lag models, so those come first.
    """
    nodes = models.nodes(["lag28"]) if strategy == "topk" else None
    inputs = fixed(model_inputs(strategy, frame, nodes), "model-inputs")
    nodes = fixed(fit_all(frame, inputs, params), "model-nodes")
    own = inputs.join(packed(nodes), ["station_id", "strategy"])
    scores = fixed(mae(predict_rows(frame.where("NOT is_train"), own)), "model-scores")
    models.save(inputs, nodes, run_ts, run_params(strategy, params), scores)
    kept = inputs.select("station_id", "explained_variance")
    return metrics_table(scores.withColumn("strategy", F.lit(STRATEGY_NAMES[strategy])).join(kept, "station_id"))


def train_everywhere(store: TableStore, models: ModelTables, run_ts: datetime, params: TreeParams = TreeParams()) -> DataFrame:
    """Fit all strategies for all stations; models, run log and metrics are stored, the metrics rows returned."""
    frame = fixed(current_frame(store), "training")
    metrics = reduce(lambda a, b: a.unionByName(b), [fit_everywhere(models, frame, s, run_ts, params) for s in STRATEGIES])
    _merge_metrics(store, metrics, run_ts)
    return metrics


def infer_everywhere(store: TableStore, models: ModelTables) -> None:
    """Refresh predictions and forecasts of all stations that have models."""
    frame, newest = fixed(current_frame(store), "training"), models.newest()
    store.replace_partitions(PREDICTIONS, predict_rows(frame.where("NOT is_train"), newest), ["model"])
    store.replace_partitions(FORECASTS, forecast_in_step(seed_state(frame), newest), ["model"])


def run_params(strategy: str, params: TreeParams) -> dict[str, object]:
    """The settings of a run as the log keeps them."""
    own = {"topk": {"top_k": DEFAULTS.top_k}, "pca": {"n_components": DEFAULTS.n_components}}.get(strategy, {})
    return {**asdict(params), "n_lags": DEFAULTS.n_lags, **own}


def score(frame: DataFrame, models: dict, strategy: str) -> DataFrame:
    """Metrics rows of one strategy on the test part."""
    scores = mae(predict(frame, models, strategy)).withColumn("strategy", F.lit(STRATEGY_NAMES[strategy]))
    if strategy == "pca":
        kept = [(station, explained_variance(model)) for station, model in models.items()]
        kept_table = frame.sparkSession.createDataFrame(kept, "station_id string, explained_variance double")
        scores = scores.join(kept_table, "station_id", "left")
    return metrics_table(scores)


def _merge_metrics(store: TableStore, rows: DataFrame, run_ts: datetime) -> None:
    stamped = rows.withColumn("run_ts", F.lit(run_ts).cast("timestamp"))
    store.upsert(METRICS, stamped, keys=("station_id", "model"), order=("run_ts",))


def current_predictions(frame: DataFrame, registry: ModelRegistry, strategies=STRATEGIES, stations=DEFAULTS.stations):
    """Test-window predictions of the newest stored models, all stations and strategies in one job."""
    rows = frame.where(F.col("station_id").isin(*stations) & ~F.col("is_train"))
    return predict_by_nodes(rows, registry.nodes(strategies, stations), registry.inputs(strategies, stations))


def future_forecast(frame: DataFrame, registry: ModelRegistry, strategies=STRATEGIES, stations=DEFAULTS.stations):
    """Seven days ahead by the newest stored models, all stations and strategies in one job."""
    seeds = seed_state(frame.where(F.col("station_id").isin(*stations)))
    return recursive_trees(seeds, registry.nodes(strategies, stations), registry.inputs(strategies, stations))


def not_forecast(frame: DataFrame, registry: ModelRegistry, strategies=STRATEGIES, stations=DEFAULTS.stations):
    """``station_id, strategy, reason`` for every listed station that gets no forecast of a strategy."""
    spark = frame.sparkSession
    modelled = registry.inputs(strategies, stations).select("station_id", "strategy", F.lit(True).alias("modelled"))
    wanted = literal_dim(spark, [(s, k) for s in stations for k in strategies], "station_id string, strategy string")
    length = frame.where(F.col("station_id").isin(*stations)).groupBy("station_id").agg(F.count(F.lit(1)).alias("n"))
    reason = (
        F.when(F.col("n").isNull(), "no rows")
        .when(F.col("n") < DEFAULTS.n_lags, f"fewer than {DEFAULTS.n_lags} rows")
        .when(F.col("modelled").isNull(), "no model")
    )
    rows = wanted.join(length, "station_id", "left").join(modelled, ["station_id", "strategy"], "left")
    return rows.select("station_id", "strategy", reason.alias("reason")).where("reason IS NOT NULL")


def infer(store: TableStore, registry: ModelRegistry, stations: Sequence[str] = DEFAULTS.stations) -> None:
    """Refresh the listed stations' rows of the prediction and forecast tables.

    Listed stations without a forecast go into a table of their own with the reason.
    """
    frame = current_frame(store).where(F.col("station_id").isin(*stations)).persist()
    _replace_stations(store, PREDICTIONS, current_predictions(frame, registry, stations=stations), schemas.PREDICTIONS, stations)
    _replace_stations(store, FORECASTS, future_forecast(frame, registry, stations=stations), schemas.FORECASTS, stations)
    store.write(NOT_FORECAST, not_forecast(frame, registry, stations=stations), max(store.versions(NOT_FORECAST), default=0) + 1)
    frame.unpersist()


def _replace_stations(store: TableStore, name: str, rows: DataFrame, schema, stations: Sequence[str]) -> None:
    """Replace the listed stations' rows; those of other stations stay in their model's partition."""
    if store.versions(name):
        others = store.read(name).where(~F.col("station_id").isin(*stations)).select(*(f.name for f in schema.fields))
        rows = fixed(rows.unionByName(others), name)
    store.replace_partitions(name, rows, ["model"])


def write_reports(store: TableStore, out: str, as_of: datetime) -> None:
    """All dashboard tables as CSV exports below ``out``; tables not there yet count as empty.

    The comparisons show the labelled models only, without the naive baseline.
    """
    spark = store.spark
    predictions = store.read(PREDICTIONS, schema=schemas.PREDICTIONS)
    forecasts = store.read(FORECASTS, schema=schemas.FORECASTS)
    metrics = store.read(METRICS, version=None, schema=schemas.MODEL_METRICS).where(F.col("model").isin(*STRATEGIES))
    short, long = model_dim(spark, long_labels=False), model_dim(spark)
    tables = {
        "daily_actual_vs_predicted": reports.daily_actual_vs_predicted(predictions),
        "forecast_bins": reports.forecast_bins(forecasts),
        "mae_table": reports.mae_table(metrics, station_dim(spark), long),
        "model_ranking": reports.model_ranking(metrics, short),
        "best_models": reports.best_models(metrics),
        "recent_daily": reports.recent_daily(predictions, as_of, long),
        "forecast_bins_by_model": reports.forecast_bins_by_model(forecasts, long),
    }
    for name, table in tables.items():
        export_csv(table, f"{out}/{name}")

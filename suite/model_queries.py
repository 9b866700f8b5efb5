"""Boosted-tree models, their stored form and the recursive forecast.

Models of all stations are fitted once per session and data folder, stored as a table below the shared
folder, and read from there by the queries that only use them, as inference does.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from stationflow.config import DEFAULTS, lag_names
from stationflow.models.components import lag_sums
from stationflow.models.forest import NODE_FIELDS, forecast_in_step, packed, predict_rows
from stationflow.models.histogram import fit_all, model_inputs
from stationflow.models.registry import ModelRegistry, split_importance, top_features
from stationflow.models.tables import ModelTables
from stationflow.models.trees import STRATEGIES, TreeParams
from stationflow.operators.metrics import mae
from stationflow.operators.series import feature_table, in_order, seed_state, training_frame
from stationflow.plans import jobs
from stationflow.session import fixed, scratch
from stationflow.sources.store import TableStore
from suite import tables as t
from suite.tables import LAG_LIST, Query, sql

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

PARAMS = TreeParams()

_models: dict[tuple[str, str], ModelTables] = {}
_fitted: set[tuple[str, str, str]] = set()
_frames: dict[tuple[str, str], object] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            SQL[name] = oracle
        return fn

    return register


def frame(spark, sf):
    """The persisted training frame."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _frames:
        _frames[key] = t.training(spark, sf).persist()
    return _frames[key]


def stored(spark, sf, strategies=STRATEGIES) -> ModelTables:
    """The model table with newest models of the given strategies in it, fitted now if there are none."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        _models[key] = ModelTables(spark, scratch(spark, "models"))
    models = _models[key]
    for strategy in ("lag28", *(s for s in strategies if s != "lag28")) if "topk" in strategies else strategies:
        if (*key, strategy) not in _fitted:
            jobs.fit_everywhere(models, frame(spark, sf), strategy, datetime(2024, 2, 1), PARAMS)
            _fitted.add((*key, strategy))
    return models


def by_joins(rows, models):
    """Predictions by descending the node table one level a join; an independent reading of the trees."""
    lags = F.array(*(F.col(name).cast("double") for name in lag_names()))
    inputs = models.select("station_id", "strategy", "selected", "mean", "loadings")
    n = DEFAULTS.n_lags
    centred = F.zip_with("lags", "mean", lambda a, b: a - b)
    component = lambda c: F.aggregate(F.zip_with(F.slice("loadings", c * n + 1, n), "centred", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    x = F.when(F.col("selected").isNotNull(), F.transform("selected", lambda i: F.get("lags", i))).when(
        F.col("loadings").isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(DEFAULTS.n_components - 1)), component)
    ).otherwise(F.col("lags"))
    known = rows.select("station_id", "hour", "rides", lags.alias("lags")).join(inputs, "station_id").withColumn("centred", centred)
    known = known.select("station_id", "strategy", "hour", "rides", x.alias("x"))
    nodes = models.select("station_id", "strategy", F.expr(f"inline(arrays_zip({', '.join(NODE_FIELDS)}))"))
    at = known.join(nodes.where("node_id = 0"), ["station_id", "strategy"])
    for _ in range(PARAMS.depth):
        inner = F.col("feature_index") >= 0
        child = F.when(inner, F.when(F.get("x", F.col("feature_index")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))).otherwise(F.col("node_id"))
        at = at.select("station_id", "strategy", "hour", "rides", "x", "tree_id", child.alias("node_id")).join(nodes, ["station_id", "strategy", "tree_id", "node_id"])
    return at.groupBy(F.col("strategy").alias("model"), "station_id", "hour").agg(F.sum(F.col("value") * F.col("tree_weight")).alias("joined"))


def scored(spark, sf, strategy):
    """The stored models of one strategy: their size, and their score computed in two ways.

    One score comes from the arrays of the stored models, the other from joins with the node table.
    """
    models = fixed(stored(spark, sf, [strategy]).newest([strategy]), "newest")
    test = frame(spark, sf).where("NOT is_train")
    predicted = predict_rows(test, models)
    joined = by_joins(test, models).withColumnRenamed("joined", "predicted_rides").join(test.select("station_id", "hour", F.col("rides").alias("actual_rides")), ["station_id", "hour"])
    rows = predicted.groupBy("station_id", "model").agg(F.count("predicted_rides").alias("test_rows"))
    size = models.select(
        "station_id", F.size(F.array_distinct("tree_id")).cast("bigint").alias("trees"),
        F.when(F.col("selected").isNotNull(), F.size(F.array_distinct("selected")))
        .when(F.col("loadings").isNotNull(), F.size("loadings") / F.size("mean"))
        .otherwise(len(lag_names())).cast("bigint").alias("inputs"),
        F.coalesce(F.col("explained_variance").between(1, 100), F.lit(strategy != "pca")).alias("variance_in_range"),
    )
    table = rows.join(mae(predicted), ["station_id", "model"]).join(mae(joined).withColumnRenamed("mae", "again"), ["station_id", "model"]).join(size, "station_id")
    return table.select(
        "station_id", "model", "trees", "inputs", "test_rows", F.round(F.abs(F.col("mae") - F.col("again")), 6).alias("mae_gap"), "variance_in_range"
    )


def scored_sql(strategy, inputs):
    return sql(
        f"""SELECT station_id, '{strategy}' AS model, CAST(100 AS BIGINT) AS trees, CAST({inputs} AS BIGINT) AS inputs,
  count(*) FILTER (WHERE NOT is_train) AS test_rows, CAST(0 AS DOUBLE) AS mae_gap, TRUE AS variance_in_range
FROM training GROUP BY station_id""",
        "training",
    )


@query("m2_gbt_lag28", scored_sql("lag28", 28))
def _(spark, sf):
    return scored(spark, sf, "lag28")


@query("m3_gbt_topk", scored_sql("topk", 10))
def _(spark, sf):
    return scored(spark, sf, "topk")


@query("m4_gbt_pca", scored_sql("pca", 10))
def _(spark, sf):
    return scored(spark, sf, "pca")


@query(
    "m2_first_split",
    sql(
        f"""SELECT station_id, feature_index, threshold FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY gain DESC, feature_index, threshold) AS place FROM (
    SELECT station_id, feature_index, (v + next_v) / 2.0::DOUBLE AS threshold, low_g * low_g / low_n + (g - low_g) * (g - low_g) / (n - low_n) AS gain FROM (
      SELECT station_id, feature_index, v::DOUBLE AS v, lead(v) OVER o AS next_v, sum(own_g) OVER o AS low_g, sum(own_n) OVER o AS low_n,
        sum(own_g) OVER p AS g, sum(own_n) OVER p AS n FROM (
        SELECT station_id, CAST(substr(lag, 5) AS INTEGER) - 1 AS feature_index, v, sum(rides)::DOUBLE AS own_g, count(*)::DOUBLE AS own_n
        FROM (SELECT station_id, rides, {LAG_LIST} FROM training WHERE is_train) UNPIVOT (v FOR lag IN ({LAG_LIST})) GROUP BY ALL)
      WINDOW o AS (PARTITION BY station_id, feature_index ORDER BY v), p AS (PARTITION BY station_id, feature_index))
    WHERE next_v IS NOT NULL AND low_n >= {PARAMS.min_rows} AND n - low_n >= {PARAMS.min_rows}))
WHERE place = 1""",
        "training",
    ),
)
def _(spark, sf):
    """The root of every station's first tree is the best of all cuts of all lags."""
    nodes = stored(spark, sf, ["lag28"]).nodes(["lag28"])
    return nodes.where("tree_id = 0 AND node_id = 0 AND feature_index >= 0").select("station_id", "feature_index", "threshold")


@query(
    "m2_beats_naive",
    sql(
        """SELECT DISTINCT station_id, m.model, TRUE AS better
FROM training, (VALUES ('lag28'), ('topk'), ('pca')) AS m(model) WHERE NOT is_train""",
        "training",
    ),
)
def _(spark, sf):
    """Where every third row has 50 rides more, every model errs less than half as much as the row before."""
    planted = F.when(F.row_number().over(in_order()) % 3 == 0, 50).otherwise(0)
    hourly = t.hourly(spark, sf).withColumn("planted", planted).select("station_id", "hour", (F.col("rides") + F.col("planted")).alias("rides"))
    rows = fixed(training_frame(feature_table(hourly)), "planted")
    nodes, scores = None, []
    for strategy in STRATEGIES:
        inputs = fixed(model_inputs(strategy, rows, nodes), "planted-inputs")
        own = fixed(fit_all(rows, inputs, PARAMS), "planted-nodes")
        nodes = own if strategy == "lag28" else nodes
        scores.append(mae(predict_rows(rows.where("NOT is_train"), inputs.join(packed(own), ["station_id", "strategy"]))))
    # The row before is the first lag of the frame.
    naive = rows.where("NOT is_train").groupBy("station_id").agg(F.avg(F.abs(F.col("rides") - F.col("lag_1"))).alias("naive"))
    both = scores[0].unionByName(scores[1]).unionByName(scores[2]).join(naive, "station_id")
    return both.select("station_id", "model", (F.col("mae") < 0.5 * F.col("naive")).alias("better"))


_LONG = f"""SELECT station_id, hour, CAST(substr(lag, 5) AS INTEGER) AS i, v
FROM (SELECT station_id, hour, {LAG_LIST} FROM training WHERE is_train) UNPIVOT (v FOR lag IN ({LAG_LIST}))"""


@query(
    "m4_lag_sums",
    sql(
        f"""SELECT a.station_id, a.i, b.i AS j, CAST(sum(a.v * b.v) AS BIGINT) AS product, CAST(sum(a.v) AS BIGINT) AS total
FROM ({_LONG}) a JOIN ({_LONG}) b ON a.station_id = b.station_id AND a.hour = b.hour AND a.i <= b.i GROUP BY ALL""",
        "training",
    ),
)
def _(spark, sf):
    """The sums that the components of all stations are made of."""
    n = DEFAULTS.n_lags
    pairs = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(1, n + 1) for j in range(i, n + 1)))
    sums = lag_sums(frame(spark, sf)).select("station_id", "sums", F.expr("products").alias("products"))
    return sums.select("station_id", "sums", F.posexplode("products").alias("at", "product")).select(
        "station_id", F.get(pairs, F.col("at"))["i"].alias("i"), F.get(pairs, F.col("at"))["j"].alias("j"), "product",
        F.get("sums", F.get(pairs, F.col("at"))["i"] - 1).alias("total"),
    )


def importance(spark, sf):
    return split_importance(stored(spark, sf, ["lag28"]).nodes(["lag28"]))


@query(
    "a13_split_importance",
    sql(
        """SELECT DISTINCT station_id, CAST(28 AS BIGINT) AS features, CAST(0 AS BIGINT) AS unaccounted FROM training""",
        "training",
    ),
)
def _(spark, sf):
    """Every model has a count for all 28 lags, and the counts add up to its inner nodes."""
    nodes = stored(spark, sf, ["lag28"]).nodes(["lag28"])
    inner = nodes.groupBy("station_id").agg(F.count_if(F.col("feature_index") >= 0).alias("inner"))
    summed = importance(spark, sf).groupBy("station_id").agg(F.count("*").alias("features"), F.sum("importance").alias("splits"))
    return summed.join(inner, "station_id").select("station_id", "features", (F.col("inner") - F.col("splits")).alias("unaccounted"))


@query(
    "o5_topk_features",
    sql("SELECT DISTINCT station_id, CAST(10 AS BIGINT) AS chosen, CAST(0 AS BIGINT) AS better_left_out FROM training", "training"),
)
def _(spark, sf):
    """Ten features a model, and none left out that is used more than one of them."""
    every = importance(spark, sf)
    top = top_features(every).select("station_id", "feature_index", "rank")
    worst = every.join(top, ["station_id", "feature_index"]).groupBy("station_id").agg(F.min("importance").alias("least"), F.count("*").alias("chosen"))
    left = every.join(top, ["station_id", "feature_index"], "left_anti").join(worst, "station_id")
    better = left.groupBy("station_id", "chosen").agg(F.count_if(F.col("importance") > F.col("least")).alias("better_left_out"))
    return better.select("station_id", "chosen", "better_left_out")


# Line items as tree nodes: the line number is the station, the return flag the strategy.
_NODES = """SELECT CAST(l_linenumber AS VARCHAR) AS station_id, l_returnflag AS strategy,
  CAST((l_partkey + l_suppkey * l_linenumber) % 25 AS INTEGER) - 1 AS feature_index FROM lineitem"""
_IMPORTANCE = f"""SELECT k.station_id, k.strategy, CAST(f AS INTEGER) AS feature_index,
  (SELECT count(*) FROM ({_NODES}) n WHERE n.station_id = k.station_id AND n.strategy = k.strategy AND n.feature_index = f) AS importance
FROM (SELECT DISTINCT station_id, strategy FROM ({_NODES})) k, range(28) AS g(f)"""


def line_nodes(spark, sf):
    index = (F.col("l_partkey") + F.col("l_suppkey") * F.col("l_linenumber")) % 25
    return t.table(spark, sf, "lineitem").select(
        F.col("l_linenumber").cast("string").alias("station_id"), F.col("l_returnflag").alias("strategy"), (index.cast("int") - 1).alias("feature_index")
    )


@query("a13_importance_of_nodes", _IMPORTANCE)
def _(spark, sf):
    return split_importance(line_nodes(spark, sf))


@query(
    "o5_topk_of_nodes",
    f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY station_id, strategy ORDER BY importance DESC, feature_index) AS INTEGER) AS rank
FROM ({_IMPORTANCE})) WHERE rank <= 10""",
)
def _(spark, sf):
    return top_features(split_importance(line_nodes(spark, sf))).drop("position")


@query(
    "m6_model_roundtrip",
    sql(
        """SELECT station_id, hour, rides AS actual_rides, CAST(0 AS DOUBLE) AS difference
FROM training WHERE NOT is_train""",
        "training",
    ),
)
def _(spark, sf):
    """Predictions of stored and re-stored models differ by nothing, on every test row."""
    test = frame(spark, sf).where("NOT is_train")
    first = stored(spark, sf, ["lag28"])
    again = ModelTables(spark, scratch(spark, "models"))
    # An older version with other trees, which the newest one takes the place of.
    inputs = first.newest(["lag28"]).select("station_id", "strategy", "selected", "mean", "loadings", "explained_variance")
    again.save(inputs, first.nodes(["lag28"]).where("tree_id < 3"), datetime(2024, 2, 1), {})
    again.save(inputs, first.nodes(["lag28"]), datetime(2024, 2, 2), {})
    a = predict_rows(test, first.newest(["lag28"])).drop("model")
    b = predict_rows(test, again.newest()).select("station_id", "hour", F.col("predicted_rides").alias("loaded"))
    return a.join(b, ["station_id", "hour"]).select(
        "station_id", "hour", "actual_rides", F.abs(F.col("predicted_rides") - F.col("loaded")).alias("difference")
    )


_PARAMS_JSON = ", ".join(f"'{k}': '{v}'" for k, v in sorted(jobs.run_params("pca", PARAMS).items()))


@query(
    "m7_run_log",
    sql(
        f"""SELECT TIMESTAMP '2024-02-01' AS run_ts, station_id, model AS strategy, e.key AS param, e.value AS setting,
  round(avg(abs(actual_rides - predicted_rides)), 6) AS mae
FROM predictions, unnest(map_entries(MAP {{{_PARAMS_JSON}}})) AS u(e) GROUP BY station_id, model, e.key, e.value""",
        "predictions",
    ),
)
def _(spark, sf):
    """Scores of the closed-form models, logged with fixed settings and read back."""
    log = ModelRegistry(spark, scratch(spark, "runs"))
    scores = t.scores(spark, sf).persist()
    for model in ("naive_lag1", "lag24", "mean28"):
        log.log_runs(scores.where(F.col("model") == model), model, jobs.run_params("pca", PARAMS), datetime(2024, 2, 1))
    rows = log.runs().select(F.col("run_ts").cast("timestamp_ntz").alias("run_ts"), "station_id", "strategy", F.explode("params").alias("param", "setting"), "mae")
    return t.rounded(rows, "mae")


@query(
    "m1_baseline_outputs",
    sql(
        """SELECT station_id, count(*) AS predictions, round(avg(abs(rides - predicted_rides)), 6) AS mae,
  round(avg(rides), 6) AS mean_rides, TIMESTAMP '2024-02-01' AS run_ts
FROM (SELECT *, lag(rides) OVER (PARTITION BY station_id ORDER BY hour) AS predicted_rides FROM features)
WHERE predicted_rides IS NOT NULL GROUP BY station_id""",
        "features",
    ),
)
def _(spark, sf):
    """What the baseline run leaves: predictions, score, constant model and the log entry."""
    store = TableStore(spark, scratch(spark, "baseline"))
    log = ModelRegistry(spark, scratch(spark, "baseline-runs"))
    jobs.store_history(store, t.hourly(spark, sf))
    jobs.train_naive(store, datetime(2024, 2, 1), log)
    predicted = store.read(jobs.NAIVE_PREDICTIONS).groupBy("station_id").agg(F.count("*").alias("predictions"))
    scores = store.read(jobs.METRICS, version=None).select("station_id", "mae")
    constant = store.read(jobs.CONSTANT_MODELS, version=None).select("station_id", "mean_rides")
    runs = log.runs().select("station_id", F.col("run_ts").cast("timestamp_ntz").alias("run_ts"))
    table = predicted.join(scores, "station_id").join(constant, "station_id").join(runs, "station_id")
    return t.rounded(table, "mae", "mean_rides").select("station_id", "predictions", "mae", "mean_rides", "run_ts")


@query(
    "fc1_current_predictions",
    sql(
        """SELECT m.model, station_id, hour, rides AS actual_rides, CAST(0 AS DOUBLE) AS difference
FROM training, (VALUES ('lag28'), ('topk'), ('pca')) AS m(model) WHERE NOT is_train""",
        "training",
    ),
)
def _(spark, sf):
    """Predictions from the arrays of the models less those from joins with the node table, on every test row of every model."""
    models = fixed(stored(spark, sf).newest(), "newest")
    test = frame(spark, sf).where("NOT is_train")
    both = predict_rows(test, models).join(by_joins(test, models), ["model", "station_id", "hour"])
    return both.select(
        "model", "station_id", "hour", "actual_rides", F.round(F.abs(F.col("predicted_rides") - F.col("joined")), 6).alias("difference")
    )


@query(
    "fc1_prediction_keys",
    sql(
        """SELECT m.model, station_id, hour, rides AS actual_rides, TRUE AS predicted
FROM training, (VALUES ('lag28'), ('topk'), ('pca')) AS m(model) WHERE NOT is_train""",
        "training",
    ),
)
def _(spark, sf):
    """Every test row of every station has one finite prediction of each model."""
    predicted = predict_rows(frame(spark, sf).where("NOT is_train"), stored(spark, sf).newest())
    finite = F.col("predicted_rides").isNotNull() & ~F.isnan("predicted_rides")
    return predicted.select("model", "station_id", "hour", "actual_rides", finite.alias("predicted"))


@query(
    "fc2_recursive_forecast",
    sql(
        """SELECT m.model, station_id, max(hour) + INTERVAL 1 HOUR AS hour, CAST(168 AS BIGINT) AS steps, CAST(0 AS DOUBLE) AS difference
FROM training, (VALUES ('lag28'), ('topk'), ('pca')) AS m(model) GROUP BY m.model, station_id HAVING count(*) >= 28""",
        "training",
    ),
)
def _(spark, sf):
    """The first step of every forecast equals what joins with the node table give for the last 28 values; all have 168 steps."""
    models = fixed(stored(spark, sf).newest(), "newest")
    seeds = seed_state(frame(spark, sf))
    first = forecast_in_step(seeds, models).groupBy("model", "station_id").agg(
        F.min("hour").alias("hour"), F.count("*").alias("steps"), F.min_by("predicted_rides", "hour").alias("first")
    )
    rows = seeds.select("station_id", F.col("last_hour").alias("hour"), F.lit(0).alias("rides"), *(F.get("recent", F.lit(i)).alias(name) for i, name in enumerate(lag_names())))
    both = first.join(by_joins(rows, models).drop("hour"), ["model", "station_id"])
    return both.select("model", "station_id", "hour", "steps", F.round(F.abs(F.col("first") - F.col("joined")), 6).alias("difference"))


@query(
    "fc2_closed_form",
    sql(
        """SELECT 'turns' AS model, station_id, last_hour + to_hours(CAST(s AS INTEGER)) AS hour,
  CASE WHEN (s % 2 = 1) = (recent[1] <= 3.5) THEN CAST(9 AS DOUBLE) ELSE CAST(2 AS DOUBLE) END AS predicted_rides
FROM seeds, range(1, 169) AS g(s)""",
        "seeds",
    ),
)
def _(spark, sf):
    """One tree that answers 9 after a value up to 3.5 and 2 after a larger one, fed with its own answers."""
    seeds = seed_state(t.hourly(spark, sf))
    tree = [(0, 0, 3.5, 1, 2, 0.0), (1, -1, 0.0, -1, -1, 9.0), (2, -1, 0.0, -1, -1, 2.0)]
    names = ("node_id", "feature_index", "threshold", "left", "right", "value")
    node = [F.struct(F.lit(0).alias("tree_id"), F.lit(1.0).alias("tree_weight"), *(F.lit(v).alias(n) for n, v in zip(names, row))) for row in tree]
    stations = t.hourly(spark, sf).groupBy("station_id").agg(F.lit("turns").alias("strategy"))
    nodes = stations.select("station_id", "strategy", F.inline(F.array(*node)))
    none = F.lit(None).cast("array<double>")
    inputs = seeds.select(
        "station_id", F.lit("turns").alias("strategy"),
        F.lit(None).cast("array<int>").alias("selected"), none.alias("mean"), none.alias("loadings"),
    )
    return forecast_in_step(seeds, inputs.join(packed(nodes), ["station_id", "strategy"]))


@query(
    "fc2_forecast_keys",
    sql(
        """SELECT m.model, station_id, max(hour) + to_hours(CAST(s AS INTEGER)) AS hour, TRUE AS predicted
FROM training, range(1, 169) AS g(s), (VALUES ('lag28'), ('topk'), ('pca')) AS m(model)
GROUP BY m.model, station_id, s HAVING count(*) >= 28""",
        "training",
    ),
)
def _(spark, sf):
    """The forecast has one finite value per model, station and hour of the next seven days."""
    forecast = forecast_in_step(seed_state(frame(spark, sf)), stored(spark, sf).newest())
    finite = F.col("predicted_rides").isNotNull() & ~F.isnan("predicted_rides")
    return forecast.select("model", "station_id", "hour", finite.alias("predicted"))

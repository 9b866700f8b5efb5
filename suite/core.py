"""Cleaning, aggregation, filters, windows and set operations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from stationflow.config import lag_names
from stationflow.functions.times import drop_zone, lenient_time, strict_time, strip_fraction, to_utc
from stationflow.operators import filters, metrics, series, trips
from suite import tables as t
from suite.tables import LAG_LIST, Query, sql

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            SQL[name] = oracle
        return fn

    return register


# ------------------------------------------------------------ cleaning


@query(
    "p1_clean_trips",
    sql(
        """SELECT ride_id, started_at, ended_at, start_station_id, end_station_id, date, hour_of_day, weekday FROM clean""",
        "clean",
    ),
)
def _(spark, sf):
    return t.clean(spark, sf)


@query("p3_coerce_ts", sql("SELECT ride_id, TRY_CAST(started_at AS TIMESTAMP) AS hour FROM raw", "raw"))
def _(spark, sf):
    return t.raw_trips(spark, sf).select("ride_id", lenient_time(F.col("started_at")).alias("hour"))


@query(
    "p6_date_parts",
    sql(
        """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(extract(hour FROM o_orderdate) AS INTEGER) AS hour_of_day,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday FROM orders"""
    ),
)
def _(spark, sf):
    orders = t.table(spark, sf, "orders").withColumn("started_at", F.col("o_orderdate"))
    return trips.add_date_parts(orders).select("o_orderkey", "date", "hour_of_day", "weekday")


@query(
    "p16_tz_roundtrip",
    "SELECT event_id, date_trunc('hour', ts) AS hour, epoch_us(ts) AS utc_micros FROM events",
)
def _(spark, sf):
    aware = t.events(spark, sf).withColumn("utc", to_utc("ts"))
    return aware.select(
        "event_id",
        drop_zone(F.date_trunc("hour", "utc")).alias("hour"),
        F.unix_micros("utc").alias("utc_micros"),
    )


@query(
    "s7_quarantine",
    sql(
        """SELECT ride_id, started_at, ended_at, start_station_id, end_station_id,
  CASE WHEN started_at IS NULL OR ended_at IS NULL THEN 'missing time'
       WHEN try_strptime(split_part(started_at, '.', 1), '%Y-%m-%d %H:%M:%S') IS NULL
         OR try_strptime(split_part(ended_at, '.', 1), '%Y-%m-%d %H:%M:%S') IS NULL THEN 'malformed time'
       ELSE 'missing station' END AS reason
FROM raw
WHERE started_at IS NULL OR ended_at IS NULL OR start_station_id IS NULL OR end_station_id IS NULL
  OR try_strptime(split_part(started_at, '.', 1), '%Y-%m-%d %H:%M:%S') IS NULL
  OR try_strptime(split_part(ended_at, '.', 1), '%Y-%m-%d %H:%M:%S') IS NULL""",
        "raw",
    ),
)
def _(spark, sf):
    return trips.rejected_trips(t.raw_trips(spark, sf))


# ------------------------------------------------------------ aggregation


@query("a1_hourly_rides", sql("SELECT * FROM hourly_clean", "hourly_clean"))
def _(spark, sf):
    return trips.hourly_counts(t.clean(spark, sf))


@query("a1_hourly_rides_by_user", sql("SELECT * FROM hourly_user", "hourly_user"))
def _(spark, sf):
    return t.hourly(spark, sf, "user_id")


@query(
    "a2_rides_per_year",
    "SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, count(*) AS trips FROM orders GROUP BY 1 ORDER BY 1",
)
def _(spark, sf):
    return trips.trips_per_year(t.table(spark, sf, "orders").withColumnRenamed("o_orderdate", "started_at"))


@query("a7_mae", sql("SELECT station_id, model, round(mae, 6) AS mae FROM scores", "scores"))
def _(spark, sf):
    return t.rounded(t.scores(spark, sf), "mae")


@query(
    "a8_mean_model",
    sql("SELECT station_id, round(avg(rides), 6) AS mean_rides FROM naive GROUP BY 1", "naive"),
)
def _(spark, sf):
    return t.rounded(metrics.constant_mean_model(t.hourly(spark, sf)), "mean_rides")


@query("a9_latest_hour", sql("SELECT station_id, max(hour) AS latest_hour FROM hourly_user GROUP BY 1", "hourly_user"))
def _(spark, sf):
    return t.hourly(spark, sf, "user_id").groupBy("station_id").agg(F.max("hour").alias("latest_hour"))


@query(
    "a10_series_length",
    sql("SELECT station_id, count(*) AS n FROM training_user GROUP BY 1 HAVING count(*) < 28", "training_user"),
)
def _(spark, sf):
    """Stations whose training frame is too short for a forecast."""
    return series.short_series(t.training(spark, sf, "user_id"))


@query(
    "a11_distinct_stations",
    sql(
        """SELECT DISTINCT station_name FROM scores LEFT JOIN stations USING (station_id)
WHERE station_name IS NOT NULL""",
        "scores",
        "stations",
    ),
)
def _(spark, sf):
    named = metrics.with_station_name(t.scores(spark, sf), t.station_names(spark))
    return named.select("station_name").dropna().distinct()


# ------------------------------------------------------------ filters


@query("p7_station_filter", sql("SELECT * FROM features WHERE station_id = 'purchase'", "features"))
def _(spark, sf):
    return filters.for_station(t.features(spark, sf), "purchase")


@query(
    "p8_station_in",
    sql(
        """SELECT h.* FROM hourly h WHERE EXISTS (SELECT 1 FROM stations s WHERE s.station_id = h.station_id)""",
        "hourly",
        "stations",
    ),
)
def _(spark, sf):
    return filters.for_stations(t.hourly(spark, sf), t.station_names(spark))


@query(
    "p15_station_by_name",
    sql(
        "SELECT station_id, hour, rides FROM hourly JOIN stations USING (station_id) WHERE station_name = 'Purchase Plaza'",
        "hourly",
        "stations",
    ),
)
def _(spark, sf):
    return filters.for_station_name(t.hourly(spark, sf), t.station_names(spark), "Purchase Plaza")


_OLD = "hour < TIMESTAMP '2024-01-20'"


@query(
    "p9_incremental_rows",
    sql(f"SELECT * FROM hourly WHERE hour > (SELECT max(hour) FROM hourly WHERE {_OLD})", "hourly"),
)
def _(spark, sf):
    rows = t.hourly(spark, sf)
    return filters.newer_than(rows, rows.where(F.expr(_OLD.replace("TIMESTAMP", "TIMESTAMP_NTZ"))))


@query(
    "p9_incremental_rows_per_station",
    sql(
        f"""SELECT h.* FROM hourly_user h
LEFT JOIN (SELECT station_id, max(hour) AS mark FROM hourly_user WHERE {_OLD} GROUP BY 1) m USING (station_id)
WHERE mark IS NULL OR hour > mark""",
        "hourly_user",
    ),
)
def _(spark, sf):
    rows = t.hourly(spark, sf, "user_id")
    return filters.newer_than_per_station(rows, rows.where(F.expr(_OLD.replace("TIMESTAMP", "TIMESTAMP_NTZ"))))


@query(
    "p10_last_60_days",
    sql("SELECT * FROM hourly WHERE hour >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAYS", "hourly"),
)
def _(spark, sf):
    return filters.since_days(t.hourly(spark, sf), datetime(2024, 1, 31), days=10)


# ------------------------------------------------------------ series


@query("f2_hourly_features", sql("SELECT * FROM features_clean", "features_clean"))
def _(spark, sf):
    return series.feature_table(trips.hourly_counts(t.clean(spark, sf)))


@query("f2_hourly_features_by_user", sql("SELECT * FROM features_user", "features_user"))
def _(spark, sf):
    return t.features(spark, sf, "user_id")


@query("f2_hourly_features_by_chunk", sql(f"SELECT station_id, hour, rides, {LAG_LIST} FROM features", "features"))
def _(spark, sf):
    return series.add_lags_by_chunk(t.hourly(spark, sf), unit="week").dropna("any")


@query("w3_training_frame", sql("SELECT * FROM training", "training"))
def _(spark, sf):
    return t.training(spark, sf)


@query("w3_training_frame_by_user", sql("SELECT * FROM training_user", "training_user"))
def _(spark, sf):
    return t.training(spark, sf, "user_id")


@query(
    "w4_split",
    sql(
        """SELECT *, rn <= (n * 4) // 5 AS is_train FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY hour) AS rn, count(*) OVER (PARTITION BY station_id) AS n
  FROM hourly)""",
        "hourly",
    ),
)
def _(spark, sf):
    return series.split_train_test(t.hourly(spark, sf))


@query("w5_naive_lag1", sql("SELECT station_id, hour, rides, predicted_rides FROM naive", "naive"))
def _(spark, sf):
    return series.naive_predictions(t.hourly(spark, sf))


@query(
    "w6_seed_state",
    sql(
        "SELECT station_id, last_hour, " + ", ".join(f"recent[{i}] AS {name}" for i, name in enumerate(lag_names(), 1)) + " FROM seeds",
        "seeds",
    ),
)
def _(spark, sf):
    seeds = series.seed_state(t.hourly(spark, sf))
    return seeds.select(
        "station_id", "last_hour", *(F.get("recent", F.lit(i)).alias(name) for i, name in enumerate(lag_names()))
    )


@query(
    "w8_dedup_keep_last",
    """SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
)
def _(spark, sf):
    rows = t.events(spark, sf).select("user_id", "event_type", "event_id", "ts", "value")
    return series.keep_last(rows, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "fc3_horizon_grid",
    sql(
        """SELECT station_id, CAST(s AS INTEGER) AS step, max(hour) + to_hours(CAST(s AS INTEGER)) AS hour
FROM hourly_user, range(1, 169) AS g(s) GROUP BY station_id, s""",
        "hourly_user",
    ),
)
def _(spark, sf):
    return series.horizon_grid(t.hourly(spark, sf, "user_id"))


# ------------------------------------------------------------ scores and lookups


@query(
    "m1_naive_baseline",
    sql(
        """SELECT station_id, round(avg(abs(rides - predicted_rides)), 6) AS mae, round(avg(rides), 6) AS mean_rides,
  count(*) AS scored_rows FROM naive GROUP BY 1""",
        "naive",
    ),
)
def _(spark, sf):
    return t.rounded(metrics.naive_baseline(t.hourly(spark, sf)), "mae", "mean_rides")


@query(
    "m5_metrics_table",
    sql(
        """SELECT station_id, model, strategy_label AS strategy, round(mae, 6) AS mae, CAST(NULL AS DOUBLE) AS explained_variance
FROM scores LEFT JOIN models USING (model)""",
        "scores",
        "models",
    ),
)
def _(spark, sf):
    strategies = t.models(spark).select("model", F.col("strategy_label").alias("strategy"))
    return t.rounded(metrics.metrics_table(t.scores(spark, sf), strategies), "mae")


@query(
    "j1_station_name",
    sql(
        "SELECT h.station_id, hour, rides, station_name FROM hourly h LEFT JOIN stations USING (station_id)",
        "hourly",
        "stations",
    ),
)
def _(spark, sf):
    return metrics.with_station_name(t.hourly(spark, sf), t.station_names(spark))


@query(
    "j2_strategy_default",
    sql(
        """SELECT station_id, model, round(mae, 6) AS mae, coalesce(model_label, model) AS model_label,
  coalesce(strategy_label, 'Unknown') AS strategy_label FROM scores LEFT JOIN models USING (model)""",
        "scores",
        "models",
    ),
)
def _(spark, sf):
    return t.rounded(metrics.with_model_labels(t.scores(spark, sf), t.models(spark)), "mae")


# ------------------------------------------------------------ set operations


@query(
    "u1_union_outer",
    sql(
        """SELECT ride_id, started_at, start_station_id, end_station_id, CAST(NULL AS DOUBLE) AS total FROM clean
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderdate, o_orderpriority, NULL, o_totalprice FROM orders""",
        "clean",
    ),
)
def _(spark, sf):
    first = t.clean(spark, sf).select("ride_id", "started_at", "start_station_id", "end_station_id")
    second = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("ride_id"),
        F.col("o_orderdate").alias("started_at"),
        F.col("o_orderpriority").alias("start_station_id"),
        F.col("o_totalprice").alias("total"),
    )
    return first.unionByName(second, allowMissingColumns=True)


@query(
    "u2_metrics_union",
    sql(
        """SELECT station_id, 'Baseline' AS model_label, round(avg(abs(rides - predicted_rides)), 6) AS mae,
  CAST(NULL AS VARCHAR) AS model FROM naive GROUP BY 1
UNION ALL SELECT station_id, 'Scored', round(mae, 6), model FROM scores""",
        "naive",
        "scores",
    ),
)
def _(spark, sf):
    baseline = metrics.naive_baseline(t.hourly(spark, sf)).select("station_id", "mae")
    union = metrics.union_labelled({"Baseline": baseline, "Scored": t.scores(spark, sf)})
    return t.rounded(union.select("station_id", "model_label", "mae", "model"), "mae")


@query(
    "u3_prediction_union",
    sql(
        """SELECT hour, station_id, round(predicted_rides, 6) AS rides, model AS model_label
FROM predictions
UNION ALL SELECT hour, station_id, round(predicted_rides, 6), 'future' FROM forecasts WHERE model = 'naive_lag1'""",
        "predictions",
        "forecasts",
    ),
)
def _(spark, sf):
    from stationflow.models.forecast import carry_forward

    past = t.predictions(spark, sf)
    by_model = {
        name: past.where(F.col("model") == name).select("hour", "station_id", F.col("predicted_rides").alias("rides"))
        for name in ("naive_lag1", "lag24", "mean28")
    }
    future = carry_forward(series.seed_state(t.hourly(spark, sf)))
    by_model["future"] = future.select("hour", "station_id", F.col("predicted_rides").alias("rides"))
    return t.rounded(metrics.union_labelled(by_model), "rides")


@query(
    "u4_unpivot",
    sql(
        """SELECT station_id, hour, 'Predicted Rides' AS type, CAST(predicted_rides AS DOUBLE) AS rides FROM naive
UNION ALL SELECT station_id, hour, 'Actual Rides', CAST(rides AS DOUBLE) FROM naive""",
        "naive",
    ),
)
def _(spark, sf):
    wide = series.naive_predictions(t.hourly(spark, sf)).select(
        "station_id",
        "hour",
        F.col("predicted_rides").cast("double").alias("Predicted Rides"),
        F.col("rides").cast("double").alias("Actual Rides"),
    )
    return wide.unpivot(["station_id", "hour"], ["Predicted Rides", "Actual Rides"], "type", "rides")

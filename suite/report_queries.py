"""The dashboard tables, fed by the closed-form models, and the closed-form forecasts."""

from __future__ import annotations

from datetime import datetime

from stationflow.models.forecast import carry_forward, recursive_mean
from stationflow.operators.series import seed_state
from stationflow.plans import reports
from suite import tables as t
from suite.tables import Query, sql

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        SQL[name] = oracle
        return fn

    return register


def forecasts(spark, sf):
    seeds = seed_state(t.hourly(spark, sf))
    return recursive_mean(seeds).unionByName(carry_forward(seeds))


@query(
    "fc4_recursive_mean",
    sql(
        "SELECT model, station_id, hour, round(predicted_rides, 6) AS predicted_rides FROM forecasts WHERE model = 'mean28'",
        "forecasts",
    ),
)
def _(spark, sf):
    return t.rounded(recursive_mean(seed_state(t.hourly(spark, sf))), "predicted_rides")


@query(
    "fc4_carry_forward",
    sql("SELECT * FROM forecasts WHERE model = 'naive_lag1'", "forecasts"),
)
def _(spark, sf):
    return carry_forward(seed_state(t.hourly(spark, sf)))


@query(
    "r1_daily_actual_vs_predicted",
    sql(
        """SELECT model, station_id, hour, type, round(rides, 6) AS rides FROM (
  SELECT model, station_id, CAST(CAST(hour AS DATE) AS TIMESTAMP) AS hour, 'Predicted Rides' AS type,
    avg(predicted_rides) AS rides FROM predictions GROUP BY 1, 2, 3
  UNION ALL
  SELECT model, station_id, CAST(CAST(hour AS DATE) AS TIMESTAMP), 'Actual Rides', avg(actual_rides)
  FROM predictions GROUP BY 1, 2, 3)""",
        "predictions",
    ),
)
def _(spark, sf):
    return t.rounded(reports.daily_actual_vs_predicted(t.predictions(spark, sf)), "rides")


@query(
    "r2_forecast_6h",
    sql(
        """SELECT model, station_id, time_bucket(INTERVAL '6 hours', hour) AS hour,
  round(avg(predicted_rides), 6) AS predicted_rides FROM forecasts GROUP BY 1, 2, 3""",
        "forecasts",
    ),
)
def _(spark, sf):
    return t.rounded(reports.forecast_bins(forecasts(spark, sf)), "predicted_rides")


@query(
    "r3_station_mae",
    sql(
        "SELECT station_id, model, round(mae, 6) AS mae FROM scores WHERE station_id = 'click' AND model = 'lag24'",
        "scores",
    ),
)
def _(spark, sf):
    return t.rounded(reports.station_mae(t.scores(spark, sf), "click", "lag24"), "mae")


@query(
    "r4_mae_table",
    sql(
        """SELECT coalesce(model_label, model) AS model_label, station_name, coalesce(strategy_label, 'Unknown') AS strategy_label,
  round(mae, 6) AS mae, row_number() OVER (ORDER BY coalesce(model_label, model), station_name) AS display_index
FROM scores JOIN stations USING (station_id) LEFT JOIN models USING (model)""",
        "scores",
        "stations",
        "models",
    ),
)
def _(spark, sf):
    return t.rounded(reports.mae_table(t.scores(spark, sf), t.station_names(spark), t.models(spark)), "mae")


@query(
    "r5_model_ranking",
    sql(
        """SELECT station_id, coalesce(model_label, model) AS model_label, round(mae, 6) AS mae,
  CAST(row_number() OVER (PARTITION BY station_id ORDER BY mae, model) AS INTEGER) AS rank
FROM scores LEFT JOIN models USING (model)""",
        "scores",
        "models",
    ),
)
def _(spark, sf):
    return t.rounded(reports.model_ranking(t.scores(spark, sf), t.models(spark)), "mae")


@query(
    "r6_best_model",
    sql(
        """SELECT station_id, model AS best_model, round(mae, 6) AS best_mae FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY mae, model) AS rn FROM scores) WHERE rn = 1""",
        "scores",
    ),
)
def _(spark, sf):
    return t.rounded(reports.best_models(t.scores(spark, sf)), "best_mae")


@query(
    "r7_daily_by_model",
    sql(
        """SELECT station_id, coalesce(model_label, model) AS model_label, date, round(rides, 6) AS rides FROM (
  SELECT model, station_id, CAST(hour AS DATE) AS date, avg(predicted_rides) AS rides FROM predictions
  WHERE hour >= TIMESTAMP '2024-01-31' - INTERVAL 4 DAYS GROUP BY 1, 2, 3) LEFT JOIN models USING (model)""",
        "predictions",
        "models",
    ),
)
def _(spark, sf):
    daily = reports.recent_daily(t.predictions(spark, sf), datetime(2024, 1, 31), t.models(spark), days=4)
    return t.rounded(daily, "rides")


@query(
    "r8_forecast_6h_by_model",
    sql(
        """SELECT station_id, coalesce(model_label, model) AS model_label, hour_bin, round(rides, 6) AS rides FROM (
  SELECT model, station_id, time_bucket(INTERVAL '6 hours', hour) AS hour_bin, avg(predicted_rides) AS rides
  FROM forecasts GROUP BY 1, 2, 3) LEFT JOIN models USING (model)""",
        "forecasts",
        "models",
    ),
)
def _(spark, sf):
    return t.rounded(reports.forecast_bins_by_model(forecasts(spark, sf), t.models(spark)), "rides")

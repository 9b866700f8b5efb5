"""How the given tables stand in for trips, stations, predictions and forecasts.

``events`` are the trips: one event is one ride, its type the dense station key (few long series)
and its user the sparse one (many short series).  Each function has its SQL twin in ``CTES``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.config import lag_names
from stationflow.functions.dims import literal_dim
from stationflow.operators import metrics, series, trips
from stationflow.schemas import MODEL_DIM, STATION_DIM
from stationflow.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

STATION_NAMES = {
    "click": "Click Corner",
    "error": "Error Exchange",
    "purchase": "Purchase Plaza",
    "signup": "Signup Square",
    # "view" has no name on purpose: its lookups give null.
}

# Rows before this day count as stored, the others as a new batch.
SPLIT = "2024-01-20"

_SUM28 = " + ".join(lag_names())

# The stand-in models with closed forms; "mean28" has no entry on purpose.
MODELS = (
    ("naive_lag1", "Naive Model", "Naive"),
    ("lag24", "Lag-24 Model", "All Lags"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trip text rows, with malformed times and missing fields where ``value`` says so."""
    value = F.col("value")
    minutes = F.make_interval(secs=F.floor(value * 60))
    return events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("ride_id"),
        F.when(value < 0.6, "bad")
        .when(value < 2.0, F.date_format("ts", "yyyy-M-d H:m:s"))
        .otherwise(F.col("ts").cast("string"))
        .alias("started_at"),
        F.when(value <= 224.0, (F.col("ts") + minutes).cast("string")).alias("ended_at"),
        F.when(~value.between(2.0, 2.5), F.col("event_type")).alias("start_station_id"),
        F.when(~value.between(100.0, 101.0), F.col("user_id").cast("string")).alias("end_station_id"),
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.clean_trips(raw_trips(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str, station: str = "event_type") -> DataFrame:
    return trips.hourly_counts(events(spark, sf_dir), station, "ts")


def features(spark: SparkSession, sf_dir: str, station: str = "event_type") -> DataFrame:
    return series.feature_table(hourly(spark, sf_dir, station))


def training(spark: SparkSession, sf_dir: str, station: str = "event_type") -> DataFrame:
    return series.training_frame(features(spark, sf_dir, station))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-part predictions of the closed-form models, one row per model, station and hour.

    The models are columns of one pass over the frame, turned into rows afterwards.
    """
    wide = (
        training(spark, sf_dir)
        .where(~F.col("is_train"))
        .select(
            "station_id",
            "hour",
            F.col("rides").alias("actual_rides"),
            F.col("lag_1").cast("double").alias("naive_lag1"),
            F.col("lag_24").cast("double").alias("lag24"),
            F.expr(f"({_SUM28}) / 28").alias("mean28"),
        )
    )
    return wide.unpivot(
        ["station_id", "hour", "actual_rides"], ["naive_lag1", "lag24", "mean28"], "model", "predicted_rides"
    ).select("model", "station_id", "hour", "actual_rides", "predicted_rides")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.mae(predictions(spark, sf_dir))


def station_names(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, sorted(STATION_NAMES.items()), STATION_DIM)


def models(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, MODELS, MODEL_DIM)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name).cast("double"), digits) for name in names})


# ---------------------------------------------------------------- SQL twins

_LAGS = ", ".join(f"lag(rides, {i}) OVER w AS lag_{i}" for i in range(1, 29))
LAG_LIST = ", ".join(lag_names())
_NAMES = ", ".join(f"('{k}', '{v}')" for k, v in sorted(STATION_NAMES.items()))
_MODELS = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in MODELS)

# Name, the names it reads, its text.
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": (
        (),
        """SELECT CAST(event_id AS VARCHAR) AS ride_id,
  CASE WHEN value < 0.6 THEN 'bad' WHEN value < 2.0 THEN strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S')
       ELSE CAST(ts AS VARCHAR) END AS started_at,
  CASE WHEN value <= 224.0 THEN CAST(ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS VARCHAR) END AS ended_at,
  CASE WHEN value NOT BETWEEN 2.0 AND 2.5 THEN event_type END AS start_station_id,
  CASE WHEN value NOT BETWEEN 100.0 AND 101.0 THEN CAST(user_id AS VARCHAR) END AS end_station_id
FROM events""",
    ),
    "parsed": (
        ("raw",),
        """SELECT ride_id, try_strptime(split_part(started_at, '.', 1), '%Y-%m-%d %H:%M:%S') AS started_at,
  try_strptime(split_part(ended_at, '.', 1), '%Y-%m-%d %H:%M:%S') AS ended_at, start_station_id, end_station_id
FROM raw""",
    ),
    "clean": (
        ("parsed",),
        """SELECT *, CAST(started_at AS DATE) AS date, CAST(extract(hour FROM started_at) AS INTEGER) AS hour_of_day,
  CAST(isodow(started_at) - 1 AS INTEGER) AS weekday
FROM parsed WHERE started_at IS NOT NULL AND ended_at IS NOT NULL
  AND start_station_id IS NOT NULL AND end_station_id IS NOT NULL""",
    ),
    "hourly": (
        (),
        "SELECT event_type AS station_id, date_trunc('hour', ts) AS hour, count(*) AS rides FROM events GROUP BY 1, 2",
    ),
    "hourly_user": (
        (),
        """SELECT CAST(user_id AS VARCHAR) AS station_id, date_trunc('hour', ts) AS hour, count(*) AS rides
FROM events GROUP BY 1, 2""",
    ),
    "hourly_old": (("hourly",), f"SELECT * FROM hourly WHERE hour < TIMESTAMP '{SPLIT}'"),
    "hourly_new": (("hourly",), f"SELECT * FROM hourly WHERE hour >= TIMESTAMP '{SPLIT}'"),
    "hourly_clean": (
        ("clean",),
        """SELECT start_station_id AS station_id, date_trunc('hour', started_at) AS hour, count(*) AS rides
FROM clean GROUP BY 1, 2""",
    ),
}


def _feature_ctes(suffix: str) -> dict[str, tuple[tuple[str, ...], str]]:
    source, feats, frame = f"hourly{suffix}", f"features{suffix}", f"training{suffix}"
    calendar = """CAST(extract(hour FROM hour) AS INTEGER) AS hour_of_day,
  CAST(isodow(hour) - 1 AS INTEGER) AS day_of_week"""
    window = "WINDOW w AS (PARTITION BY station_id ORDER BY hour)"
    return {
        feats: (
            (source,),
            f"SELECT * FROM (SELECT *, {_LAGS}, {calendar} FROM {source} {window}) WHERE lag_28 IS NOT NULL",
        ),
        frame: (
            (feats,),
            f"""SELECT *, rn <= (n * 4) // 5 AS is_train FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY hour) AS rn,
    count(*) OVER (PARTITION BY station_id) AS n
  FROM (SELECT station_id, hour, rides, {_LAGS} FROM {feats} {window}) WHERE lag_28 IS NOT NULL)""",
        ),
    }


for _suffix in ("", "_user", "_clean", "_old", "_new"):
    _CTES.update(_feature_ctes(_suffix))

_CTES.update(
    {
        "naive": (
            ("hourly",),
            """SELECT * FROM (SELECT *, lag(rides, 1) OVER (PARTITION BY station_id ORDER BY hour) AS predicted_rides
FROM hourly) WHERE predicted_rides IS NOT NULL""",
        ),
        "predictions": (
            ("training",),
            f"""SELECT m.model, station_id, hour, rides AS actual_rides,
  CASE m.model WHEN 'naive_lag1' THEN CAST(lag_1 AS DOUBLE) WHEN 'lag24' THEN CAST(lag_24 AS DOUBLE)
       ELSE CAST({_SUM28} AS DOUBLE) / 28 END AS predicted_rides
FROM training, (VALUES ('naive_lag1'), ('lag24'), ('mean28')) AS m(model) WHERE NOT is_train""",
        ),
        "scores": (
            ("predictions",),
            "SELECT station_id, model, avg(abs(actual_rides - predicted_rides)) AS mae FROM predictions GROUP BY 1, 2",
        ),
        "stations": ((), f"SELECT * FROM (VALUES {_NAMES}) AS s(station_id, station_name)"),
        "models": ((), f"SELECT * FROM (VALUES {_MODELS}) AS m(model, model_label, strategy_label)"),
        "newest": (
            ("hourly",),
            """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY hour DESC) AS rn
FROM hourly) WHERE rn <= 28""",
        ),
        "seeds": (
            ("newest",),
            """SELECT station_id, max(hour) AS last_hour, list(CAST(rides AS DOUBLE) ORDER BY rn) AS recent
FROM newest GROUP BY station_id HAVING count(*) = 28""",
        ),
        # The recursion of the mean-of-the-last-28 forecast.
        "steps": (
            ("seeds",),
            """SELECT station_id, last_hour, 0 AS step, recent, CAST(NULL AS DOUBLE) AS predicted_rides FROM seeds
  UNION ALL
  SELECT station_id, last_hour, step + 1, list_prepend(list_sum(recent) / 28, recent[1:27]), list_sum(recent) / 28
  FROM steps WHERE step < 168""",
        ),
        "forecasts": (
            ("steps", "seeds"),
            """SELECT 'mean28' AS model, station_id, last_hour + to_hours(step) AS hour, predicted_rides
FROM steps WHERE step > 0
UNION ALL
SELECT 'naive_lag1', station_id, last_hour + to_hours(CAST(s AS INTEGER)), recent[1]
FROM seeds, range(1, 169) AS g(s)""",
        ),
    }
)


def sql(query: str, *uses: str) -> str:
    """``query`` preceded by the named tables and everything they read, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for other in _CTES[name][0]:
                add(other)
            ordered.append(name)

    for name in uses:
        add(name)
    if not ordered:
        return query
    word = "WITH RECURSIVE" if "steps" in ordered else "WITH"
    return f"{word} " + ",\n".join(f"{name} AS ({_CTES[name][1]})" for name in ordered) + "\n" + query

"""Per-station series operators on hourly tables.

Every window here partitions by station over *hourly* rows.  Those are unique per station and
clock hour, so a window group is bounded by the calendar and not by the number of trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from stationflow.config import DEFAULTS, lag_names
from stationflow.functions.times import monday_weekday


def in_order() -> WindowSpec:
    """Rows of a station by hour."""
    return Window.partitionBy("station_id").orderBy("hour")


def add_lags(series: DataFrame, n_lags: int = DEFAULTS.n_lags, value: str = "rides") -> DataFrame:
    """``lag_1 … lag_n``: the previous *rows* of the station, not the previous clock hours.

    All lags share one window specification, which Catalyst turns into one Window operator.
    """
    return series.selectExpr("*", *_lags(value, n_lags, "station_id"))


def _lags(value: str, n_lags: int, keys: str) -> list[str]:
    """The lags as SQL text: one call to the JVM instead of several for each of them."""
    window = f"OVER (PARTITION BY {keys} ORDER BY hour)"
    return [f"lag({value}, {i}) {window} AS {name}" for i, name in enumerate(lag_names(n_lags), 1)]


def add_lags_by_chunk(
    series: DataFrame, n_lags: int = DEFAULTS.n_lags, value: str = "rides", unit: str = "month"
) -> DataFrame:
    """``add_lags`` with each series cut into calendar chunks that run as separate window groups.

    For tables where a few very long series hold most rows.  Each chunk is preceded by copies of
    the last ``n_lags`` rows before it.  A non-empty chunk has at least one row, so the tails of
    the ``n_lags`` previous chunks always contain them: the result equals ``add_lags`` exactly.
    """
    chunk = F.date_trunc(unit, F.col("hour")).cast("timestamp_ntz")
    rows = series.withColumn("_chunk", chunk)
    by_chunk = Window.partitionBy("station_id", "_chunk")
    tail = (
        rows.select("station_id", "_chunk", "hour", value)
        .withColumn("_back", F.row_number().over(by_chunk.orderBy(F.desc("hour"))))
        .where(F.col("_back") <= n_lags)
        .groupBy("station_id", "_chunk")
        .agg(F.array_sort(F.collect_list(F.struct("hour", value))).alias("_tail"))
    )
    before = Window.partitionBy("station_id").orderBy("_chunk").rowsBetween(-n_lags, -1)
    lead_in = (
        tail.withColumn("_rows", F.flatten(F.collect_list("_tail").over(before)))
        .withColumn("_row", F.explode(F.slice(F.reverse("_rows"), 1, n_lags)))
        .select("station_id", "_chunk", "_row.*", F.lit(True).alias("_lead_in"))
    )
    whole = rows.withColumn("_lead_in", F.lit(False)).unionByName(lead_in, allowMissingColumns=True)
    lagged = whole.selectExpr("*", *_lags(value, n_lags, "station_id, _chunk"))
    return lagged.where(~F.col("_lead_in")).drop("_chunk", "_lead_in")


def add_calendar(series: DataFrame) -> DataFrame:
    return series.withColumns({"hour_of_day": F.hour("hour"), "day_of_week": monday_weekday("hour")})


def feature_table(hourly: DataFrame, n_lags: int = DEFAULTS.n_lags) -> DataFrame:
    """Hourly counts with lags and calendar columns; the first ``n_lags`` rows of a series go."""
    return add_calendar(add_lags(hourly, n_lags)).dropna("any")


def features_after(fresh: DataFrame, lead_in: DataFrame, n_lags: int = DEFAULTS.n_lags) -> DataFrame:
    """Features of new hourly rows whose first lags come from ``lead_in``, the rows before them.

    Without the lead-in a batch would lose the first ``n_lags`` hours of each station again.
    """
    columns = ["station_id", "hour", "rides"]
    both = fresh.select(*columns, F.lit(True).alias("_new")).unionByName(
        lead_in.select(*columns, F.lit(False).alias("_new"))
    )
    return add_calendar(add_lags(both, n_lags)).where("_new").drop("_new").dropna("any")


def split_train_test(series: DataFrame) -> DataFrame:
    """Number the rows of each series and mark the first four fifths as training rows."""
    whole = Window.partitionBy("station_id")
    numbered = series.withColumns(
        {"rn": F.row_number().over(in_order()).cast("bigint"), "n": F.count(F.lit(1)).over(whole)}
    )
    cut = F.expr(f"(n * {DEFAULTS.train_parts}) div {DEFAULTS.split_parts}")
    return numbered.withColumn("is_train", F.col("rn") <= cut)


def split_train_test_by_chunk(series: DataFrame, unit: str = "month") -> DataFrame:
    """``split_train_test`` with each series cut into calendar chunks that run as separate window groups.

    Rows are counted per station and chunk; what a row's number and the split point need from the
    other chunks is one small row a chunk.  The result equals ``split_train_test`` exactly.
    """
    rows = series.withColumn("_chunk", F.date_trunc(unit, F.col("hour")).cast("timestamp_ntz"))
    by_station = Window.partitionBy("station_id")
    before = by_station.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        rows.groupBy("station_id", "_chunk")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "station_id", "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_rows").over(by_station).alias("n"),
        )
    )
    within = F.row_number().over(Window.partitionBy("station_id", "_chunk").orderBy("hour"))
    numbered = rows.join(chunks, ["station_id", "_chunk"]).withColumn("rn", within + F.col("_before"))
    cut = F.expr(f"(n * {DEFAULTS.train_parts}) div {DEFAULTS.split_parts}")
    return numbered.withColumn("is_train", F.col("rn") <= cut).select(*series.columns, "rn", "n", "is_train")


def training_frame(
    features: DataFrame, n_lags: int = DEFAULTS.n_lags, reuse_stored_lags: bool = False
) -> DataFrame:
    """Rows the models see: station, hour, rides, lags, row number, series length, split flag.

    The lags are computed again on the stored feature rows, which drops another ``n_lags`` rows
    of each series.  ``reuse_stored_lags`` keeps those rows and skips one window.
    """
    columns = ["station_id", "hour", "rides"]
    if reuse_stored_lags:
        lagged = features.select(*columns, *lag_names(n_lags))
    else:
        lagged = add_lags(features.select(columns), n_lags)
    return split_train_test(lagged.dropna("any"))


def naive_predictions(series: DataFrame) -> DataFrame:
    """Predict each row by the row before it; the first row of a series has no prediction."""
    return series.withColumn("predicted_rides", F.lag("rides", 1).over(in_order())).dropna(
        subset=["predicted_rides"]
    )


def last_rows(series: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` rows of each station; the rank filter also runs before the shuffle."""
    newest = Window.partitionBy("station_id").orderBy(F.desc("hour"))
    return series.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= n)


def seed_state(series: DataFrame, n: int = DEFAULTS.n_lags) -> DataFrame:
    """One row per station: last hour, and the last ``n`` counts newest first.

    A station with fewer rows cannot be forecast and is left out; see ``short_series``.
    """
    newest_first = F.transform(
        F.array_sort(F.collect_list(F.struct("rn", F.col("rides").cast("double").alias("v")))), lambda x: x["v"]
    )
    return (
        last_rows(series, n)
        .groupBy("station_id")
        .agg(F.max("hour").alias("last_hour"), newest_first.alias("recent"))
        .where(F.size("recent") == n)
    )


def short_series(series: DataFrame, n: int = DEFAULTS.n_lags) -> DataFrame:
    """Stations with too few rows for a forecast."""
    return series.groupBy("station_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < n)


# Types that a hash aggregate can keep in place.
_FIXED_WIDTH = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType,
    T.TimestampNTZType,
)


def keep_last(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], distinct_order: bool = False) -> DataFrame:
    """One row per key: the one that sorts last by ``order``.

    An aggregate instead of a row number: each task keeps one row per key before the shuffle, so
    a key with a third of all rows is no hot spot.  ``order`` should have no ties within a key.

    A struct is kept for the row, for which Spark sorts the rows of each task by key.  With
    ``distinct_order`` the caller states that one order column has no ties within a key: if all
    other columns have a fixed width, each is kept by itself in a hash aggregate, without any sort.
    """
    rest = [c for c in rows.columns if c not in keys]
    one = len(order) == 1 and isinstance(order[0], str)
    if distinct_order and one and all(isinstance(rows.schema[c].dataType, _FIXED_WIDTH) for c in (*rest, *order)):
        return rows.groupBy(*keys).agg(*(F.max_by(c, order[0]).alias(c) for c in rest)).select(rows.columns)
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, "_last.*").select(rows.columns)


def horizon_grid(series: DataFrame, hours: int = DEFAULTS.horizon_hours) -> DataFrame:
    """The next ``hours`` clock hours of each station after its own last hour."""
    last = series.groupBy("station_id").agg(F.max("hour").alias("last_hour"))
    step = F.explode(F.sequence(F.lit(1), F.lit(hours))).alias("step")
    return last.select("station_id", "last_hour", step).select(
        "station_id", "step", hours_after("last_hour", "step").alias("hour")
    )


def hours_after(time: str, count: str) -> Column:
    return (F.col(time) + F.make_interval(hours=F.col(count).cast("int"))).cast("timestamp_ntz")

from datetime import datetime

from pyspark.sql import functions as F

from stationflow.functions.times import floor_hour, floor_hours, lenient_time, monday_weekday, strict_time, strip_fraction
from stationflow.operators.trips import clean_trips, hourly_counts, rejected_trips, trips_per_year
from stationflow.schemas import TRIPS_RAW

GOOD = "2024-02-29 10:20:30"


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), TRIPS_RAW)


def parsed(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(strict_time(strip_fraction("t")).alias("t"))
    return df.first()["t"]


def test_time_texts(spark):
    when = datetime(2024, 2, 29, 10, 20, 30)
    assert parsed(spark, "2024-02-29 10:20:30.123") == when
    assert parsed(spark, GOOD) == when
    assert parsed(spark, "2024-1-1 1:02:03") == datetime(2024, 1, 1, 1, 2, 3)
    for bad in ("bad", "", None, "2024-02-30 10:20:30", "2024-02-29", "2024-02-29T10:20:30", GOOD + "Z", "24-02-29 1:1:1"):
        assert parsed(spark, bad) is None, bad


def test_lenient_time_accepts_more(spark):
    df = spark.createDataFrame([("2024-02-29T10:20:30",), ("nothing",), (None,)], "t string")
    got = [r["t"] for r in df.select(lenient_time("t").alias("t")).collect()]
    assert got == [datetime(2024, 2, 29, 10, 20, 30), None, None]


def test_rows_without_time_or_station_go(spark):
    trips = raw(
        spark,
        ("ok", GOOD, GOOD, "a", "b"),
        ("time", "bad", GOOD, "a", "b"),
        ("no time", None, GOOD, "a", "b"),
        ("no end", GOOD, None, "a", "b"),
        ("no start station", GOOD, GOOD, None, "b"),
        ("no end station", GOOD, GOOD, "a", None),
    )
    clean = clean_trips(trips).collect()
    assert [r["ride_id"] for r in clean] == ["ok"]
    assert (clean[0]["hour_of_day"], clean[0]["weekday"], str(clean[0]["date"])) == (10, 3, "2024-02-29")
    reasons = {r["ride_id"]: r["reason"] for r in rejected_trips(trips).collect()}
    assert reasons == {
        "time": "malformed time",
        "no time": "missing time",
        "no end": "missing time",
        "no start station": "missing station",
        "no end station": "missing station",
    }


def test_monday_is_zero(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS t")
    assert df.select(monday_weekday("t").alias("d")).first()["d"] == 0


def test_whole_hours(spark):
    times = ["1969-12-31 23:59:59.5", "1970-01-01 00:00:00", "2024-02-29 10:59:59.999999"]
    df = spark.createDataFrame([(t,) for t in times], "t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    expected = F.date_trunc("hour", "t").cast("timestamp_ntz")
    assert df.where(floor_hour("t") == expected).count() == 3


def test_six_hour_bins(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 17:59:59' AS t")
    assert df.select(floor_hours("t", 6).alias("b")).first()["b"] == datetime(2024, 1, 1, 12)


def test_hours_without_trips_have_no_row(spark):
    trips = clean_trips(
        raw(
            spark,
            ("1", "2024-01-01 10:00:00", GOOD, "a", "b"),
            ("2", "2024-01-01 10:59:59", GOOD, "a", "b"),
            ("3", "2024-01-01 13:00:00", GOOD, "a", "b"),
        )
    )
    got = {(r["station_id"], r["hour"].hour): r["rides"] for r in hourly_counts(trips).collect()}
    assert got == {("a", 10): 2, ("a", 13): 1}
    assert [tuple(r) for r in trips_per_year(trips).collect()] == [(2024, 3)]


def test_counts_are_partial_before_the_shuffle(spark, plan):
    trips = spark.range(1000).select(
        (F.col("id") % 3).cast("string").alias("start_station_id"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("started_at"),
    )
    text = plan(hourly_counts(trips))
    assert "partial_count" in text and text.count("Exchange") == 1


def test_times_are_read_once(spark, plan):
    trips = spark.range(10).select(*[F.lit("x").alias(f.name) for f in TRIPS_RAW.fields]).persist()
    assert plan(clean_trips(trips)).lower().count("rlike") == 2

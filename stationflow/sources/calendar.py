"""Which monthly files should exist, which are recent, which are missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationflow.config import DEFAULTS
from stationflow.sources.files import list_files


def archive_name(month: Column, prefix: str = DEFAULTS.archive_prefix, suffix: str = DEFAULTS.archive_suffix) -> Column:
    return F.concat(F.lit(prefix), F.date_format(month, "yyyyMM"), F.lit(suffix))


def month_manifest(spans: DataFrame, start: str, end: str) -> DataFrame:
    """One row per calendar month from ``start`` to ``end`` of each input row, with its file name."""
    months = F.sequence(
        F.trunc(start, "MM").cast("date"), F.trunc(end, "MM").cast("date"), F.expr("interval 1 month")
    )
    keep = [c for c in spans.columns if c not in (start, end)]
    return spans.select(*keep, F.explode(months).alias("month")).withColumn("file_name", archive_name(F.col("month")))


def recent_months(spans: DataFrame, as_of: str, months_back: int = DEFAULTS.recent_months) -> DataFrame:
    """The calendar month of ``as_of`` and the ``months_back - 1`` months before it.

    Whole calendar months: steps of 30 days would skip February from the first of March.
    """
    keep = [c for c in spans.columns if c != as_of]
    back = F.explode(F.sequence(F.lit(0), F.lit(months_back - 1))).alias("_back")
    month = F.add_months(F.trunc(F.col(as_of), "MM"), -F.col("_back")).alias("month")
    return (
        spans.select(*keep, as_of, back).select(*keep, month).withColumn("file_name", archive_name(F.col("month")))
    )


def missing_partitions(manifest: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected entries that are not present."""
    return manifest.join(present.select(*keys), list(keys), "left_anti")


def fetch_plan(spark: SparkSession, prefix: str, suffix: str, have: str, first: str, last: str) -> DataFrame:
    """``month, file_name, present, recent``: the monthly files from ``first`` to ``last``.

    ``have`` is a path pattern of the files that are there; only their names are listed.  ``recent``
    marks the months that are fetched again because they may still grow.
    """
    span = spark.range(1).select(F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last"))
    name = lambda month: archive_name(F.col(month), prefix, suffix)
    expected = month_manifest(span, "first", "last").withColumn("file_name", name("month"))
    late = recent_months(span.select("last"), "last").select("month", F.lit(True).alias("recent"))
    there = list_files(spark, have).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.lit(True).alias("present")).distinct()
    joined = expected.join(there, "file_name", "left").join(late, "month", "left")
    return joined.select("month", "file_name", F.coalesce("present", F.lit(False)).alias("present"), F.coalesce("recent", F.lit(False)).alias("recent"))

"""A running row number over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from stationflow.session import shared_root


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Number all rows 1, 2, 3 … in ``order``, without sorting the table in one task.

    The rows are range-partitioned by ``order`` and written to the checkpoint folder, so that the
    partition of a row is fixed.  Each range is numbered by itself and shifted by the number of
    rows in the ranges before it; only one count per range is gathered.  ``order`` must have no
    ties.
    """
    shared_root(df.sparkSession)
    ranges = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint()
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition, i.e. at most spark.sql.shuffle.partitions rows.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranges.join(F.broadcast(offsets), "_range")
        .withColumn(name, (within + F.col("_before")).cast("bigint"))
        .drop("_range", "_before")
    )

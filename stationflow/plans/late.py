"""A series table that takes hours in any order.

Lags are row lags, so an hour that comes in late, or whose count changes, alters its own row and the
28 rows of its station after it.  Only those are made anew, and only the files of their station's
bucket and their months are written again.  The table holds the warm-up rows of each series as well
(their lags are null), so a batch needs nothing but the table and is one commit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from stationflow.config import DEFAULTS
from stationflow.operators.series import add_calendar, add_lags
from stationflow.operators.trips import hourly_counts
from stationflow.session import fixed
from stationflow.sources.snapshots import Change, Layout, Snapshot, SnapshotTable

KEYS = ["station_id", "hour"]
# Buckets of stations; with the months they are the parts that a late hour touches one or two of.
BUCKETS = 64


def series_table(spark, root: str, buckets: int = BUCKETS, chunk: str = "month") -> SnapshotTable:
    return SnapshotTable(spark, root, Layout(tuple(KEYS), ("station_id",), buckets, chunk))


def add_hours(table: SnapshotTable, counts: DataFrame, batch: tuple[str, int] | None = None) -> bool:
    """Add ``station_id, hour, rides`` to the stored counts and repair the rows that follow.

    ``rides`` add up with those stored for the hour, so a correction is the difference.  Files and
    batches may come in any order and give the table of one run over all.  ``batch`` makes a repeated
    batch of a stream harmless.  Of the stations named, the stored hours are read (three columns, a
    series is bounded by the calendar); of the rows made anew, only their parts.
    """
    spark, layout = table.spark, table.layout
    rows = fixed(counts.groupBy(*KEYS).agg(F.sum("rides").alias("rides")), "hours")
    bucket = F.pmod(F.xxhash64("station_id"), F.lit(layout.buckets)).cast("string")
    # At most one number a bucket comes to the driver.
    buckets = [r[0] for r in rows.select(bucket).distinct().collect()]
    if not buckets:
        return False

    def change(base: Snapshot) -> Change:
        offered = rows.withColumn("changed_", F.lit(1))
        whole = offered
        if base.schema is not None:
            files = table.files(base).where(F.substring_index("part", "_", 1).isin(buckets))
            stored = table.rows(base, files).select(*KEYS, "rides").join(rows.select("station_id").distinct(), "station_id", "left_semi")
            whole = whole.unionByName(stored.withColumn("changed_", F.lit(0)))
        whole = whole.groupBy(*KEYS).agg(F.sum("rides").alias("rides"), F.max("changed_").alias("changed_"))
        back = Window.partitionBy("station_id").orderBy("hour").rowsBetween(-DEFAULTS.n_lags, 0)
        lagged = add_lags(whole).withColumn("again_", F.max("changed_").over(back))
        made = fixed(add_calendar(lagged).where("again_ = 1").drop("changed_", "again_"), "repaired")
        parts = [r[0] for r in made.select(layout.part()).distinct().collect()]
        if base.schema is None:
            return Change(made, parts)
        present = table.rows(base, table.selected(base, parts=parts))
        return Change(present.join(made.select(*KEYS), KEYS, "left_anti").unionByName(made), parts)

    return table.transact(change, batch)


def features(table: SnapshotTable) -> DataFrame:
    """The feature rows: all but the warm-up rows of each series."""
    return table.read().dropna("any")


def repair(table: SnapshotTable, name: str, station: str = "start_station_id", time: str = "started_at") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for clean trips of any age: each batch is counted and repairs the series.

    No watermark and no state: what a late trip changes is found in the table.  A batch that is run
    again after a failure is passed over if it was committed.
    """

    def write(trips: DataFrame, batch_id: int) -> None:
        add_hours(table, hourly_counts(trips, station, time), (name, batch_id))

    return write

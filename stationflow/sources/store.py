"""Named, versioned parquet tables: ``<root>/<name>/v=<version>``."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stationflow.operators.filters import newer_than_per_station
from stationflow.operators.series import keep_last
from stationflow.session import fixed


class TableMissing(Exception):
    pass


class TableStore:
    """Feature, prediction, forecast and metric tables.

    A version counts only once its job has committed (``_SUCCESS``), so a reader never sees a new
    version half-written.  ``append`` and ``replace_partitions`` change a version in place: their files
    move in one by one, and who needs them all at once reads what a marker of its own names, as the
    load jobs do.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v={version}"

    def versions(self, name: str) -> list[int]:
        """Committed versions in ascending order."""
        base = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(base):
            return []
        found = []
        for status in fs.listStatus(base):
            folder = status.getPath()
            step, _, number = folder.getName().partition("=")
            if step == "v" and number.isdigit():
                if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
                    found.append(int(number))
        return sorted(found)

    def latest(self, name: str) -> int:
        versions = self.versions(name)
        if not versions:
            raise TableMissing(name)
        return versions[-1]

    def read(self, name: str, version: int | None = 1, schema: StructType | None = None) -> DataFrame:
        """A table; ``version=None`` is the newest one.

        With ``schema``, a missing table gives a warning and an empty result of that layout.
        """
        try:
            number = self.latest(name) if version is None else version
            if number not in self.versions(name):
                raise TableMissing(f"{name} version {number}")
        except TableMissing as missing:
            if schema is None:
                raise
            warnings.warn(f"table not available: {missing}", stacklevel=2)
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(self.path(name, number))

    def write(self, name: str, df: DataFrame, version: int = 1, partition_by: Sequence[str] = ()) -> None:
        """Write a whole version, replacing it if present."""
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name, version))

    def replace_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str], version: int = 1) -> None:
        """Replace only the partitions that occur in ``df``; the others stay."""
        if version not in self.versions(name):
            self.write(name, df, version, partition_by)
            return
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(self.path(name, version))
        )

    def append_newer(
        self,
        name: str,
        rows: DataFrame,
        version: int = 1,
        time: str = "hour",
        keys: Sequence[str] = ("station_id", "hour"),
        order: Sequence[str] = (),
        per_station: bool = False,
    ) -> bool:
        """Append the rows that are newer than the stored ones; False if there are none.

        The mark is the newest stored time over all stations, so a station that lags behind the
        others loses late hours; ``per_station`` compares each station with its own mark.  The
        mark is one value and goes into the filter as a literal, which reaches the file scan.
        ``order`` names ingest-order columns: of several rows with one key the last stays.
        """
        stored = self.read(name, version)
        # The mark and the write both need the rows.
        rows = fixed(rows, "offered")
        if per_station:
            fresh = newer_than_per_station(rows, stored, time)
            if fresh.isEmpty():
                return False
        else:
            mark = stored.agg(F.max(time)).first()[0]
            newest = rows.agg(F.max(time)).first()[0]
            if mark is None or newest is None or newest <= mark:
                return False
            kind = dict(stored.dtypes)[time]
            fresh = rows.where(F.col(time) > F.lit(mark).cast(kind))
        if order:
            fresh = keep_last(fresh, keys, order)
        self.append(name, fresh.select(stored.columns), version)
        return True

    def append(self, name: str, rows: DataFrame, version: int = 1) -> None:
        rows.write.mode("append").parquet(self.path(name, version))

    def upsert(self, name: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> int:
        """Merge rows by key into a new version and return its number.

        Of the stored and new rows with one key, the last by ``order`` stays.  The version being
        read is never overwritten.  Meant for metric tables; large tables use ``append_newer`` or
        the change log of ``stationflow.streaming.sinks``.
        """
        versions = self.versions(name)
        merged = rows
        if versions:
            merged = self.read(name, versions[-1]).unionByName(rows, allowMissingColumns=True)
        number = versions[-1] + 1 if versions else 1
        self.write(name, keep_last(merged, keys, order), number)
        return number

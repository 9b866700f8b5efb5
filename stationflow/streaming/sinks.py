"""Keyed streaming sink: an append-only change log with a current view.

Each micro-batch writes its changed rows under its own batch number, so a batch that is run again
after a failure replaces itself.  Readers take the row of the newest batch per key.  No batch
reads or rewrites earlier ones, so the cost of a batch does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.operators.series import keep_last
from stationflow.sources.store import TableStore


def write_changes(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that logs a batch under ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches in a log."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in fs.listStatus(base)] if fs.exists(base) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def current_rows(spark: SparkSession, path: str, keys: Sequence[str], base: DataFrame | None = None) -> DataFrame:
    """The newest row per key, a plain aggregate over the log; a batch has a key once.

    ``base`` is what ``compact`` has taken out of the log; every batch is newer than it.
    """
    older = None if base is None else base.withColumn("batch", F.lit(-1))
    if older is not None and not batches(spark, path):
        return base
    log = spark.read.parquet(path)
    if older is not None:
        log = log.unionByName(older)
    return keep_last(log, keys, ["batch"], distinct_order=True).drop("batch")


def compact(spark: SparkSession, path: str, keys: Sequence[str], store: TableStore, name: str) -> int:
    """Write the current rows as the next version of a store table and return its number.

    The batches that went into it are then taken out of the log, so neither the log nor the cost of
    reading it grows with the stream's age.  Meant for the time between two runs of the stream.
    """
    versions = store.versions(name)
    number = versions[-1] + 1 if versions else 1
    done = batches(spark, path)
    base = store.read(name, versions[-1]) if versions else None
    store.write(name, current_rows(spark, path, keys, base), number)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for batch in done:
        folder = hadoop.Path(f"{path}/batch={batch}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return number


def append_newer(store: TableStore, name: str, **options) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends only rows newer than the stored ones.

    A repeated batch finds its rows stored already and adds nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        store.append_newer(name, batch, **options)
        batch.unpersist()

    return write

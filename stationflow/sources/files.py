"""File listing and byte access from tasks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import IO

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F


def list_files(spark: SparkSession, pattern: str | Sequence[str]) -> DataFrame:
    """``path, length, modified`` of the matching files; no file content is read."""
    return (
        spark.read.format("binaryFile")
        .load(pattern if isinstance(pattern, str) else list(pattern))
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def newest_files(spark: SparkSession, pattern: str, n: int) -> list[str]:
    """The ``n`` most recently modified files, ``n`` being a small setting."""
    newest = list_files(spark, pattern).orderBy(F.desc("modified"), F.desc("path")).limit(n)
    return [row["path"] for row in newest.select("path").collect()]


# A listing with more rows than this gives several rows to a task.
MOST_TASKS = 20_000


def one_task_each(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spread a listing over as many tasks as it has rows.

    The number is stated because AQE would otherwise merge the listing, a few bytes a row, into
    one task that then opens every file.  Ranges of one row each, as a hash would put several rows
    into one task and none into others.
    """
    return rows.repartitionByRange(min(max(1, rows.count()), MOST_TASKS), *keys)


def filesystem_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and inner path of a location as Spark writes it."""
    scheme, colon, rest = uri.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else uri).lstrip("/")
    # Hadoop's names for the S3 scheme.
    return fs.FileSystem.from_uri("s3:" + rest if scheme in ("s3a", "s3n") else uri)


def open_uri(uri: str) -> IO[bytes]:
    """Open a file seekable, without loading it whole."""
    filesystem, path = filesystem_of(uri)
    return filesystem.open_input_file(path)

"""Trip CSV files: one scan per distinct header, damaged rows and files set aside."""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stationflow.config import REQUIRED_TRIP_COLUMNS
from stationflow.sources.files import filesystem_of, list_files, newest_files, one_task_each

CORRUPT = "_corrupt_record"
SOURCE = "source_file"


class TripScan(NamedTuple):
    rows: DataFrame
    rejected_rows: DataFrame
    rejected_files: DataFrame


# A header line is looked for in this many bytes.
HEADER_BYTES = 64 << 10
CHUNK_BYTES = 1 << 20
# Fields of one line that the parser takes before it gives up on the file (8 bytes of memory each).
MOST_FIELDS = 1 << 21
COMPRESSED = (".gz", ".bz2")
# Words that a data-frame reader takes for a missing value.
NULL_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def _header(path: str) -> list[str]:
    """The column names of a file; ValueError or OSError says why it cannot be used.

    A compressed file is read to its end, as only that shows whether it is whole.
    """
    filesystem, inner = filesystem_of(path)
    packed = path.endswith(COMPRESSED)
    with filesystem.open_input_stream(inner, compression="detect" if packed else None) as raw:
        first = raw.read(HEADER_BYTES)
        while packed and raw.read(CHUNK_BYTES):
            pass
    return parse_header(first)


def parse_header(first: bytes) -> list[str]:
    """The column names in a file's first bytes; ValueError says why they cannot be used."""
    if b"\n" not in first and len(first) == HEADER_BYTES:
        raise ValueError(f"no line end in the first {HEADER_BYTES} bytes")
    text = first.decode("utf-8-sig", errors="replace")
    header = next(csv.reader(io.StringIO(text, newline="")), [])
    low = [name.lower() for name in header]
    if not header or "" in (name.strip() for name in header):
        raise ValueError("empty column name")
    if len(set(low)) < len(low):
        raise ValueError("repeated column name")
    return header


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        headers, reasons = [], []
        for path in batch["path"]:
            header, reason = None, None
            try:
                header = _header(path)
            except (OSError, EOFError, ValueError, csv.Error) as error:
                # Messages can name offsets and addresses; the kind is enough and stays the same.
                reason = str(error) if type(error) is ValueError else f"unreadable: {type(error).__name__}"
            headers.append(header)
            reasons.append(reason)
        yield pd.DataFrame({"path": batch["path"], "header": headers, "reason": reasons})


def file_headers(files: DataFrame) -> DataFrame:
    """``path, header, reason`` of each listed file, one task per file; ``reason`` says why there is no header."""
    return one_task_each(files.select("path"), ["path"]).mapInPandas(
        _first_lines, "path string, header array<string>, reason string"
    )


def _field_count(line: Column) -> Column:
    """Number of comma-separated fields of a CSV line, commas inside quotes not counted."""
    outside = F.regexp_replace(line, r'"[^"]*+"', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1


def _scan_group(spark: SparkSession, paths: Sequence[str], header: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*header, CORRUPT)])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # Whether a row is damaged must not depend on the columns a query happens to need.
        .option("columnPruning", False)
        .option("maxColumns", MOST_FIELDS)
        .csv(list(paths))
        .withColumn(SOURCE, F.col("_metadata.file_name"))
    )
    # A row with too few fields is kept, its missing fields null; one with too many is set aside.
    # Spark refuses scans that need no column but the damaged line, such as a count of the rows, so
    # the test also touches the first field, in a way that is always true.
    touched = F.coalesce(F.length(F.col(header[0])), F.lit(0)) >= 0
    surplus = F.col(CORRUPT).isNotNull() & touched & (_field_count(F.col(CORRUPT)) > len(header))
    known = {name: F.when(~F.col(name).isin(*NULL_WORDS), F.col(name)) for name in REQUIRED_TRIP_COLUMNS if name in header}
    return rows.withColumns({CORRUPT: F.when(surplus, F.col(CORRUPT)), **known})


def scan_trip_files(
    spark: SparkSession,
    files: DataFrame | Sequence[str],
    required: Sequence[str] = REQUIRED_TRIP_COLUMNS,
) -> TripScan:
    """Read trip CSV files with differing columns as one table of text columns.

    An explicit CSV schema binds by position, so files are grouped by their header line and each
    group is one scan; the groups are united by name, missing columns null.  A file without a
    required column, without a usable header or that cannot be read whole is reported and left out,
    a damaged row likewise.  Words for a missing value count as null in required columns.  Only the
    file listing, never file content, passes through the driver.
    """
    if not isinstance(files, DataFrame):
        files = list_files(spark, list(files))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    unusable: list[tuple[str, str]] = []
    for row in file_headers(files).collect():
        if row["reason"] is not None:
            unusable.append((row["path"], row["reason"]))
            continue
        header = tuple(row["header"])
        missing = [name for name in required if name not in header]
        if missing:
            unusable.append((row["path"], "missing column " + ", ".join(missing)))
        else:
            groups[header].append(row["path"])
    rejected_files = spark.createDataFrame(unusable, "path string, reason string")
    scans = [_scan_group(spark, sorted(paths), header) for header, paths in sorted(groups.items())]
    if not scans:
        names = (*required, CORRUPT, SOURCE)
        scans = [spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    return TripScan(
        rows=union.where(F.col(CORRUPT).isNull()).drop(CORRUPT),
        rejected_rows=union.where(F.col(CORRUPT).isNotNull()).select(
            SOURCE, F.col(CORRUPT).alias("line"), F.lit("too many fields").alias("reason"), *required
        ),
        rejected_files=rejected_files,
    )


def scan_trips(spark: SparkSession, pattern: str) -> TripScan:
    """All trip files that match a path pattern such as ``raw/JC-*.csv``."""
    return scan_trip_files(spark, list_files(spark, pattern))


def scan_newest_trips(spark: SparkSession, pattern: str, n: int) -> TripScan:
    """The trips of the ``n`` most recently modified files."""
    return scan_trip_files(spark, newest_files(spark, pattern, n))


def read_keyed_csv(spark: SparkSession, pattern: str, schema: T.StructType, key: str = "station_id") -> DataFrame:
    """Union of CSV files named ``…_<key>.csv``, the key taken from the file name.

    Parts of a directory written under such a name count as well.
    """
    # Spark lists a directory `…_<key>.csv` by its part files: use the last path step that fits.
    key_of = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), r"_([^_/]+)\.csv(?:/[^/]*)?$", 1))
    return spark.read.schema(schema).option("header", True).csv(pattern).withColumn(key, key_of)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a table as CSV with a header line, in parallel parts."""
    df.write.mode("overwrite").option("header", True).csv(path)

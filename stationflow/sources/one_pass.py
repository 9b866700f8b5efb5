"""Trip CSV files read once: rows, damaged rows and the verdict on each file come out of the same pass.

Large plain files are cut into byte ranges, each a task's work; a compressed file is one range.  A file
can turn out unusable at its very end, so what the pass finds is written, and the rows of such files
are left out on reading that.  File names and headers stay in tasks; the driver sees the distinct
column names only.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv as arrow_csv
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.config import REQUIRED_TRIP_COLUMNS
from stationflow.session import fixed
from stationflow.sources.files import MOST_TASKS, filesystem_of, list_files
from stationflow.sources.trip_csv import CHUNK_BYTES, COMPRESSED, CORRUPT, HEADER_BYTES, NULL_WORDS, SOURCE, TripScan, parse_header

# Bytes of a plain file that one task reads.
RANGE_BYTES = 128 << 20
ROW, DAMAGED, FILE = "row", "damaged", "file"


def byte_ranges(files: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """``path, start, stop`` of the parts that are read by themselves; a compressed file is one part."""
    packed = F.lit(False)
    for end in COMPRESSED:
        packed = packed | F.col("path").endswith(end)
    whole = F.array(F.lit(0).cast("long"))
    starts = F.when(packed | (F.col("length") <= size), whole).otherwise(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long")))
    stop = F.when(packed, F.lit((1 << 63) - 1)).otherwise(F.least(F.col("start") + size, F.col("length")))
    return files.select("path", "length", F.explode(starts).alias("start")).select("path", "start", stop.alias("stop"))


def _lines(path: str, start: int, stop: int) -> Iterator[bytes]:
    """The lines that begin within the range, in chunks of whole lines; the header line is left out."""
    filesystem, inner = filesystem_of(path)
    if path.endswith(COMPRESSED):
        source = filesystem.open_input_stream(inner, compression="detect")
    else:
        source = filesystem.open_input_file(inner)
        # The line in progress where the range starts belongs to the one before.
        source.seek(max(start - 1, 0))
    step = min(CHUNK_BYTES, max(stop - start, HEADER_BYTES))
    with source:
        data, at = b"", max(start - 1, 0)
        while (end := data.find(b"\n")) < 0:
            at += len(data)
            if not (data := source.read(step)):
                return
        data, at = data[end + 1 :], at + end + 1
        last = False
        while at < stop:
            # The newline of the last line that begins in the range.
            end = data.find(b"\n", max(stop - 1 - at, 0))
            if end >= 0 or last:
                yield data[: end + 1] if end >= 0 else data
                return
            cut = data.rfind(b"\n") + 1
            if cut:
                yield data[:cut]
            chunk = source.read(step)
            data, at, last = data[cut:] + chunk, at + cut, not chunk


def _parsed(chunk: bytes, header: Sequence[str]) -> tuple[list[pa.Array], list[str]]:
    """The columns of a chunk's rows, missing fields null, and the lines with too many fields."""
    try:
        chunk.decode()
    except UnicodeDecodeError:
        chunk = chunk.decode("utf-8", "replace").encode()
    short, surplus = [], []

    def told(row) -> str:
        (surplus if row.actual_columns > len(header) else short).append(row.text)
        return "skip"

    if b'"' in chunk and any(line.count(b'"') % 2 for line in chunk.split(b"\n")):
        # A quote that is not closed ends with its line.
        rows = []
        for line in chunk.decode().splitlines():
            fields = next(csv.reader([line]), [])
            if len(fields) > len(header):
                surplus.append(line)
            elif fields:
                rows.append([f or None for f in fields] + [None] * (len(header) - len(fields)))
        return [pa.array(c, pa.string()) for c in (zip(*rows) if rows else [()] * len(header))], surplus
    table = arrow_csv.read_csv(
        pa.BufferReader(chunk),
        arrow_csv.ReadOptions(column_names=list(header), use_threads=False, block_size=max(len(chunk), 1) + 1),
        arrow_csv.ParseOptions(invalid_row_handler=told),
        arrow_csv.ConvertOptions(column_types=dict.fromkeys(header, pa.string()), null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=False),
    ) if chunk.strip() else pa.table({n: pa.array([], pa.string()) for n in header})
    columns = [table.column(n).combine_chunks() for n in header]
    if short:
        rows = [[f or None for f in next(csv.reader([line]), [])] for line in short]
        rows = [r + [None] * (len(header) - len(r)) for r in rows]
        columns = [pa.concat_arrays([c, pa.array(own, pa.string())]) for c, own in zip(columns, zip(*rows))]
    return columns, surplus


def read_ranges(ranges: DataFrame, required: Sequence[str] = REQUIRED_TRIP_COLUMNS) -> DataFrame:
    """All that is in the ranges: rows, damaged lines, and a row per range with the file's header or what is wrong with it."""
    required = list(required)
    schema = f"kind string, path string, start long, {SOURCE} string, header array<string>, reason string, line string, extra map<string,string>, " + ", ".join(f"`{n}` string" for n in required)
    names = ["kind", "path", "start", SOURCE, "header", "reason", "line", "extra", *required]
    text, words = pa.string(), pa.list_(pa.string())
    pairs = pa.map_(text, text)

    def batch(kind: str, path: str, start: int, n: int, header=None, reason=None, line=None, extra=None, own=None) -> pa.RecordBatch:
        name = path.rsplit("/", 1)[-1]
        columns = [
            pa.array([kind] * n, text), pa.array([path] * n, text), pa.array([start] * n, pa.int64()), pa.array([name] * n, text), pa.array([header] * n, words),
            pa.array([reason] * n, text), line if line is not None else pa.nulls(n, text), extra if extra is not None else pa.nulls(n, pairs),
            *(own or [pa.nulls(n, text)] * len(required)),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def rows_of(path: str, start: int, columns: list[pa.Array], header: list[str]) -> pa.RecordBatch:
        n = len(columns[0])
        by_name = dict(zip(header, columns))
        others = [h for h in header if h not in required]
        keys = pa.array(others * n, text)
        # Values of the other columns row by row.
        table = pa.concat_arrays([by_name[h] for h in others]) if others else pa.array([], text)
        order = pa.array([c * n + r for r in range(n) for c in range(len(others))], pa.int64())
        extra = pa.MapArray.from_arrays(pa.array(range(0, (n + 1) * len(others), len(others)) if others else [0] * (n + 1), pa.int32()), keys, table.take(order))
        known = pa.array(NULL_WORDS)
        own = [pc.if_else(pc.is_in(by_name[h], known), pa.scalar(None, text), by_name[h]) for h in required]
        return batch(ROW, path, start, n, extra=extra, own=own)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for path, start, stop in zip(*(part.column(c).to_pylist() for c in ("path", "start", "stop"))):
                header, reason = None, None
                try:
                    header = parse_header(_first_bytes(path))
                    missing = [name for name in required if name not in header]
                    if missing:
                        raise ValueError("missing column " + ", ".join(missing))
                    for chunk in _lines(path, start, stop):
                        columns, surplus = _parsed(chunk, header)
                        if len(columns[0]):
                            yield rows_of(path, start, columns, header)
                        if surplus:
                            yield batch(DAMAGED, path, start, len(surplus), reason="too many fields", line=pa.array(surplus, text))
                except (OSError, EOFError, ValueError, csv.Error) as error:
                    # Messages can name offsets and addresses; the kind is enough and stays the same.
                    reason = str(error) if type(error) is ValueError else f"unreadable: {type(error).__name__}"
                yield batch(FILE, path, start, 1, header=header, reason=reason)

    dealt = ranges.repartitionByRange(min(max(1, ranges.count()), MOST_TASKS), "path", "start")
    return dealt.mapInArrow(read, schema)


def _first_bytes(path: str) -> bytes:
    filesystem, inner = filesystem_of(path)
    with filesystem.open_input_stream(inner, compression="detect" if path.endswith(COMPRESSED) else None) as source:
        return source.read(HEADER_BYTES)


def scan_once(spark: SparkSession, files: DataFrame | str | Sequence[str], required: Sequence[str] = REQUIRED_TRIP_COLUMNS, range_bytes: int = RANGE_BYTES) -> TripScan:
    """What ``scan_trip_files`` gives, with every byte read once (but for the header of a file that is cut).

    The pass runs when this is called; its results are read from the shared folder afterwards.
    """
    if not isinstance(files, DataFrame):
        files = list_files(spark, files if isinstance(files, str) else list(files))
    found = fixed(read_ranges(byte_ranges(files, range_bytes), required), "scan")
    verdicts = found.where(F.col("kind") == FILE).select("path", "start", "header", "reason")
    rejected = verdicts.where(F.col("reason").isNotNull()).groupBy("path").agg(F.min("reason").alias("reason"))
    # Rows are joined by range, so that those of a large file do not come to one task.
    left_out = verdicts.select("path", "start").join(rejected.select("path"), "path", "left_semi")
    usable = found.where(F.col("kind") != FILE).join(left_out, ["path", "start"], "left_anti")
    # Distinct names of columns, not headers of files, come to the driver.
    good = verdicts.where(F.col("reason").isNull()).select(F.explode("header").alias("name"))
    others = sorted(r["name"] for r in good.where(~F.col("name").isin(*required)).distinct().collect())
    rows = usable.where(F.col("kind") == ROW).select(*required, *(F.try_element_at("extra", F.lit(n)).alias(n) for n in others), SOURCE)
    return TripScan(
        rows=rows,
        rejected_rows=usable.where(F.col("kind") == DAMAGED).select(SOURCE, "line", "reason", *required),
        rejected_files=rejected,
    )

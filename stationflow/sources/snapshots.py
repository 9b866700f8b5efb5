"""Tables whose versions are manifests of files, committed atomically.

A table is a folder with ``data`` (parquet files, never changed), ``manifests`` (one parquet table of
live files per version) and ``log`` (one small file per version, created only if it is not there).  A
writer adds data files and a manifest under names of its own and then tries to create the next log
file: what is not named there does not exist for readers, so a job that dies at any point leaves the
table as it was, and of two writers one loses and tries again on top of the other.

A manifest row holds what a reader needs to pass a file over: its part (a hash bucket, and a calendar
chunk if wanted), the range of hours and stations in it, and a small Bloom filter of its stations.
Readers ask the manifest, never the folder.

The store must create or rename a file only where none of that name exists, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import time as clock
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stationflow.operators.series import keep_last
from stationflow.session import fixed
from stationflow.sources.store import TableMissing

# Bits of a file's filter, in words of 64, and how many of them a station sets.
FILTER_WORDS, FILTER_HASHES = 16, 3
# Bits of each side of the curve.
CURVE_BITS = 16
# How often a writer that lost tries again, and its first pause.
TRIES, PAUSE_SECONDS = 50, 0.02
LOG_DIGITS = 20
PART = "part_"

MANIFEST = (
    "path string, part string, rows long, bytes long, first timestamp_ntz, last timestamp_ntz, "
    "low string, high string, stations array<long>"
)


class Conflict(Exception):
    """Other writers were faster every time."""


@dataclass(frozen=True)
class Layout:
    """How the rows of a table are dealt to files.

    With ``buckets`` the rows go by the hash of ``bucket_by`` (and the calendar ``chunk`` of their
    time), one task a part, and an upsert touches only the parts of its keys.  Without, they lie along
    a curve over station and hour, cut into files of about ``file_rows`` rows.
    """

    keys: tuple[str, ...] = ("station_id", "hour")
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    chunk: str | None = None
    station: str = "station_id"
    time: str = "hour"
    file_rows: int = 4_000_000

    def __post_init__(self) -> None:
        if self.buckets and not set(self.bucket_by or self.keys) <= set(self.keys):
            raise ValueError("buckets go by key columns")
        if self.chunk and self.time not in self.keys:
            raise ValueError("a chunk needs the time among the keys")

    def part(self) -> Column:
        if not self.buckets:
            return F.lit("all")
        steps = [F.pmod(F.xxhash64(*(self.bucket_by or self.keys)), F.lit(self.buckets)).cast("string")]
        if self.chunk:
            steps.append(F.date_format(F.date_trunc(self.chunk, F.col(self.time)), "yyyyMMddHH"))
        return F.concat_ws("_", *steps)


@dataclass(frozen=True)
class Snapshot:
    """One version: its number, manifest folder, schema, sizes, the last batch of each named stream in it,
    and how many files it has added and taken out.
    """

    version: int
    manifest: str | None = None
    schema: T.StructType | None = None
    files: int = 0
    rows: int = 0
    bytes: int = 0
    batches: dict[str, int] = field(default_factory=dict)
    added: int = 0
    removed: int = 0


@dataclass(frozen=True)
class Change:
    """What a writer wants: rows to add, and the parts whose present files they take the place of.

    ``touched`` is None where no file goes, ``ALL`` where all do.  ``based`` says that the rows were
    made from the snapshot's contents, so that they must be made anew if those have changed.
    """

    rows: DataFrame
    touched: Sequence[str] | str | None = None
    based: bool = True


ALL = "*"


def station_filter(station: str) -> Column:
    """An aggregate: the bits that a file's stations set, as words."""
    places = ", ".join(f"pmod(xxhash64({station}, {n}), {64 * FILTER_WORDS})" for n in range(FILTER_HASHES))
    words = (
        f"coalesce(bit_or(aggregate(array({places}), 0L, (w, p) -> w | if(p div 64 = {word}, shiftleft(1L, CAST(p % 64 AS INT)), 0L))), 0L)"
        for word in range(FILTER_WORDS)
    )
    return F.expr(f"array({', '.join(words)})")


def may_hold(station: str) -> Column:
    """Whether a manifest row's file can have rows of the station: no if any of its bits is missing."""
    value = "'" + station.replace("\\", "\\\\").replace("'", "\\'") + "'"
    places = (f"pmod(xxhash64({value}, {n}), {64 * FILTER_WORDS})" for n in range(FILTER_HASHES))
    bits = (f"(stations[CAST({p} div 64 AS INT)] & shiftleft(1L, CAST({p} % 64 AS INT))) <> 0" for p in places)
    return F.expr(" AND ".join(bits)) & (F.col("low") <= station) & (F.col("high") >= station)


def curve(station: str, time: str, first: datetime, last: datetime) -> Column:
    """A row's place on the curve: the bits of its hour's and its station's places in turn."""
    top = (1 << CURVE_BITS) - 1
    span = max((last - first).total_seconds(), 1.0)
    seconds = f"(unix_micros(CAST({time} AS TIMESTAMP)) - unix_micros(CAST(TIMESTAMP_NTZ'{first}' AS TIMESTAMP))) / 1000000"
    x, y = f"CAST({seconds} / {span} * {top} AS BIGINT)", f"pmod(xxhash64({station}), {top + 1})"
    fold = "aggregate(sequence(0, {last}), 0L, (z, i) -> z | shiftleft(shiftright({x}, i) & 1L, 2 * i + 1) | shiftleft(shiftright({y}, i) & 1L, 2 * i))"
    return F.expr(fold.format(last=CURVE_BITS - 1, x=x, y=y))


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, layout: Layout = Layout()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = layout

    # ---------------------------------------------------------------- log

    def _path(self, *steps: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *steps)))

    def _filesystem(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the committed versions."""
        fs, base = self._filesystem(), self._path("log")
        if not fs.exists(base):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(base)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A committed version, by default the newest; version 0 is the empty table before the first."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Snapshot(0)
        path = self._path("log", f"{version:0{LOG_DIGITS}d}.json")
        fs = self._filesystem()
        if not fs.exists(path):
            raise TableMissing(f"{self.root} version {version}")
        stream = fs.open(path)
        try:
            record = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Snapshot(**(record | {"schema": T.StructType.fromJson(record["schema"])}))

    def _created(self, snapshot: Snapshot) -> bool:
        """Create the version's log file whole, or not at all; False if another writer has."""
        fs, hadoop = self._filesystem(), self.spark._jvm.org.apache.hadoop.fs
        record = json.dumps({**snapshot.__dict__, "schema": json.loads(snapshot.schema.json())})
        own = self._path("log", f".{uuid.uuid4().hex}.tmp")
        target = self._path("log", f"{snapshot.version:0{LOG_DIGITS}d}.json")
        stream = fs.create(own, False)
        stream.write(record.encode())
        stream.close()
        try:
            where = fs.resolvePath(own.getParent()).toUri()
            if where.getScheme() == "file":
                # A local rename would replace the other writer's file; a hard link never does.
                nio = self.spark._jvm.java.nio.file
                folder = nio.Paths.get(where)
                nio.Files.createLink(folder.resolve(target.getName()), folder.resolve(own.getName()))
                return True
            return bool(fs.rename(own, target))
        except Py4JJavaError as error:
            kind = error.java_exception.getClass().getName()
            if kind.endswith("FileAlreadyExistsException"):
                return False
            raise
        finally:
            if fs.exists(own):
                fs.delete(own, False)

    # ---------------------------------------------------------------- reading

    def files(self, snapshot: Snapshot | None = None) -> DataFrame:
        """The manifest: one row per live file."""
        snapshot = snapshot or self.snapshot()
        if snapshot.manifest is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/{snapshot.manifest}")

    def selected(
        self,
        snapshot: Snapshot | None = None,
        stations: Sequence[str] | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
        parts: Sequence[str] | None = None,
    ) -> DataFrame:
        """The files that can hold rows of the listed stations, hours (both ends included) and parts."""
        found = self.files(snapshot)
        if stations is not None:
            found = found.where(reduce(lambda a, b: a | b, map(may_hold, stations), F.lit(False)))
        if since is not None:
            found = found.where(F.col("last") >= F.lit(since).cast("timestamp_ntz"))
        if until is not None:
            found = found.where(F.col("first") <= F.lit(until).cast("timestamp_ntz"))
        if parts is not None:
            found = found.where(F.col("part").isin(list(parts)))
        return found

    def read(
        self,
        version: int | None = None,
        stations: Sequence[str] | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        """The rows of a version, by default the newest, of the listed stations and hours.

        The manifest names the files; a missing table raises ``TableMissing``.
        """
        snapshot = self.snapshot(version)
        if snapshot.schema is None:
            raise TableMissing(self.root)
        rows = self.rows(snapshot, self.selected(snapshot, stations, since, until))
        if stations is not None:
            rows = rows.where(F.col(self.layout.station).isin(list(stations)))
        if since is not None:
            rows = rows.where(F.col(self.layout.time) >= F.lit(since).cast("timestamp_ntz"))
        if until is not None:
            rows = rows.where(F.col(self.layout.time) <= F.lit(until).cast("timestamp_ntz"))
        return rows

    def rows(self, snapshot: Snapshot, files: DataFrame) -> DataFrame:
        """The rows of the given files; only their names pass through the driver, as in any scan."""
        paths = [f"{self.root}/{r['path']}" for r in files.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], snapshot.schema)
        return self.spark.read.schema(snapshot.schema).parquet(*paths)

    # ---------------------------------------------------------------- writing

    def _written(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """Write rows as new files; the name of their folder and their manifest rows."""
        name, layout = uuid.uuid4().hex, self.layout
        path = f"{self.root}/data/{name}"
        if layout.buckets:
            dealt = rows.withColumn(PART, layout.part()).repartition(PART)
            dealt.sortWithinPartitions(PART, *layout.keys).write.partitionBy(PART).parquet(path)
        else:
            self._along_curve(rows).withColumn(PART, layout.part()).write.partitionBy(PART).parquet(path)
        known = {f.name for f in rows.schema.fields}
        time = F.col(layout.time).cast("timestamp_ntz") if layout.time in known else F.lit(None).cast("timestamp_ntz")
        station = layout.station if layout.station in known else "CAST(NULL AS STRING)"
        schema = T.StructType([f for f in rows.schema.fields if f.name in (layout.time, layout.station)] + [T.StructField(PART, T.StringType())])
        # Files written just now are read for the two columns that skipping goes by.
        found = (
            self.spark.read.schema(schema)
            .parquet(path)
            .groupBy(F.regexp_extract("_metadata.file_path", f"(data/{name}/.*)$", 1).alias("path"), F.col(PART).alias("part"))
            .agg(
                F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes"), F.min(time).alias("first"), F.max(time).alias("last"),
                F.expr(f"min({station})").cast("string").alias("low"), F.expr(f"max({station})").cast("string").alias("high"),
                station_filter(station).alias("stations"),
            )
        )
        # A manifest row is read for each try to commit.
        return name, fixed(found, "added-files")

    def _along_curve(self, rows: DataFrame) -> DataFrame:
        layout = self.layout
        rows = fixed(rows, "curve")
        ends = rows.agg(F.min(layout.time).alias("first"), F.max(layout.time).alias("last"), F.count(F.lit(1)).alias("n")).first()
        if not ends["n"] or ends["first"] is None:
            return rows
        place = "curve_place"
        n = -(-ends["n"] // layout.file_rows)
        dealt = rows.withColumn(place, curve(layout.station, layout.time, ends["first"], ends["last"]))
        return dealt.repartitionByRange(n, place).sortWithinPartitions(place).drop(place)

    def transact(self, change: Callable[[Snapshot], Change | None], batch: tuple[str, int] | None = None) -> bool:
        """Commit what ``change`` makes of the newest snapshot; False if there is nothing to do.

        A writer that loses puts its files on top of the winner's version if the files it replaces are
        still those it has read, and else makes its change anew.  ``batch`` names a stream and the
        number of its batch: one that is in the table already is passed over.
        """
        pause = PAUSE_SECONDS
        for _ in range(TRIES):
            base = self.snapshot()
            if batch and base.batches.get(batch[0], -1) >= batch[1]:
                return False
            made = change(base)
            if made is None:
                return False
            name, added = self._written(made.rows)
            schema = _merged(base.schema, made.rows.schema)
            before = self._live(base, made.touched)
            while True:
                if self._committed(base, name, added, made.touched, schema, batch):
                    return True
                clock.sleep(pause)
                pause = min(2 * pause, 2.0)
                base = self.snapshot()
                if batch and base.batches.get(batch[0], -1) >= batch[1]:
                    return False
                same = self._live(base, made.touched) == before
                if not same or (made.based and made.touched is None):
                    break
                schema = _merged(base.schema, schema)
        raise Conflict(self.root)

    def _live(self, snapshot: Snapshot, touched: Sequence[str] | str | None) -> set[str]:
        """Names of the files that a change replaces."""
        if touched is None:
            return set()
        files = self.files(snapshot)
        files = files if touched == ALL else files.where(F.col("part").isin(list(touched)))
        return {r["path"] for r in files.select("path").collect()}

    def _committed(self, base: Snapshot, added_name: str, added: DataFrame, touched, schema: T.StructType, batch) -> bool:
        kept = self.files(base)
        if touched == ALL:
            kept = kept.limit(0)
        elif touched is not None:
            kept = kept.where(~F.col("part").isin(list(touched)))
        name = uuid.uuid4().hex
        path = f"{self.root}/manifests/{name}"
        kept.unionByName(added).select(*(f.split()[0] for f in MANIFEST.split(", "))).write.parquet(path)
        own = F.count_if(F.col("path").startswith(f"data/{added_name}/"))
        size = self.spark.read.schema(MANIFEST).parquet(path).agg(F.count(F.lit(1)), F.sum("rows"), F.sum("bytes"), own).first()
        batches = base.batches | ({batch[0]: batch[1]} if batch else {})
        removed = base.files + size[3] - size[0]
        new = Snapshot(base.version + 1, name, schema, size[0], size[1] or 0, size[2] or 0, batches, size[3], removed)
        return self._created(new)

    def append(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """Add rows; nothing that is stored matters to them."""
        return self.transact(lambda _: Change(rows, None, based=False), batch)

    def replace(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """Make ``rows`` the whole table."""
        return self.transact(lambda _: Change(rows, ALL, based=False), batch)

    def append_newer(self, rows: DataFrame, per_station: bool = False, batch: tuple[str, int] | None = None) -> bool:
        """Append the rows that are newer than all stored ones, or than those of their station.

        The mark is that of the snapshot the rows are committed upon: a writer that loses to another
        takes its mark anew.
        """
        layout = self.layout
        rows = fixed(rows, "offered")

        def change(base: Snapshot) -> Change | None:
            files = self.files(base)
            if per_station and base.schema is not None:
                marks = self.rows(base, files).groupBy(layout.station).agg(F.max(layout.time).alias("mark_"))
                fresh = rows.join(marks, layout.station, "left").where(F.col("mark_").isNull() | (F.col(layout.time) > F.col("mark_"))).drop("mark_")
            else:
                # The manifest knows the newest hour; no file is opened.
                mark = files.agg(F.max("last")).first()[0]
                fresh = rows if mark is None else rows.where(F.col(layout.time) > F.lit(mark).cast("timestamp_ntz"))
            return None if fresh.isEmpty() else Change(fresh)

        return self.transact(change, batch)

    def upsert(self, rows: DataFrame, order: Sequence[str], batch: tuple[str, int] | None = None) -> bool:
        """Merge rows by key; of the stored and new rows of a key, the last by ``order`` stays.

        Only the parts that hold the new keys are read and written.
        """
        keys = self.layout.keys
        return self.merge(keep_last(rows, keys, order), lambda old, new: keep_last(old.unionByName(new, allowMissingColumns=True), keys, order), batch)

    def replace_groups(self, rows: DataFrame, by: Sequence[str], batch: tuple[str, int] | None = None) -> bool:
        """Replace all stored rows of the groups that occur in ``rows``; other groups stay."""
        if not set(self.layout.bucket_by or self.layout.keys) <= set(by) or self.layout.chunk:
            raise ValueError("a group must lie in one part")

        def combined(old: DataFrame, new: DataFrame) -> DataFrame:
            groups = new.select(*by).distinct()
            return old.join(groups, list(by), "left_anti").unionByName(new, allowMissingColumns=True)

        return self.merge(rows, combined, batch)

    def merge(self, rows: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], batch: tuple[str, int] | None = None) -> bool:
        """Rewrite the parts of ``rows`` as ``combine(their present rows, rows)``."""
        rows = fixed(rows, "merge")
        # Parts are bounded by the layout: buckets times the calendar chunks of the rows.
        parts = [r[0] for r in rows.select(self.layout.part()).distinct().collect()]
        if not parts:
            return False

        def change(base: Snapshot) -> Change:
            if base.schema is None:
                old = self.spark.createDataFrame([], rows.schema)
            else:
                old = self.rows(base, self.selected(base, parts=parts))
            return Change(combine(old, rows), parts)

        return self.transact(change, batch)

    def rewrite(self, change: Callable[[Snapshot, DataFrame], DataFrame]) -> bool:
        """Replace the whole table by what ``change`` makes of it, such as the same rows in a better layout."""
        return self.transact(lambda base: Change(change(base, self.read(base.version)), ALL))


def _merged(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The fields of both; a field that only one side has is null in the other's rows."""
    known = {f.name: f for f in (old.fields if old else [])}
    for f in new.fields:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
        known.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(known.values()))

"""Sources, sinks and stored tables.

Each query first has Spark write the given tables as files or store versions into a new scratch
folder (below the shared checkpoint folder) and then runs the operator on those.
"""

from __future__ import annotations

from contextlib import contextmanager, suppress

from pyspark.sql import functions as F

from stationflow.operators.series import feature_table
from stationflow.plans import jobs
from stationflow.schemas import HOURLY_RIDES
from stationflow.session import scratch
from stationflow.sources import archives, calendar, one_pass, trip_csv
from stationflow.sources.store import TableStore
from suite import tables as t
from suite.tables import SPLIT, Query, sql

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_RAW = "ride_id, started_at, ended_at, start_station_id, end_station_id"
RAW_COLUMNS = _RAW.split(", ")


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            SQL[name] = oracle
        return fn

    return register


def before(time: str = "hour", day: str = SPLIT):
    return F.col(time) < F.lit(day).cast("timestamp_ntz")


def text_columns(df):
    return df.select([F.col(c).cast("string") for c in df.columns])


# ------------------------------------------------------------ files


@query("s1_scan_csv_glob", sql(f"SELECT {_RAW} FROM raw", "raw"))
def _(spark, sf):
    """The trips as CSV files, some with an extra column and another column order, read as one."""
    folder = scratch(spark, "csv")
    raw = t.raw_trips(spark, sf)
    classic = raw.where(F.col("ended_at").isNotNull())
    trip_csv.export_csv(classic, f"{folder}/JC-1.csv")
    extra = raw.where(F.col("ended_at").isNull()).withColumn("member_casual", F.lit("member"))
    trip_csv.export_csv(extra.select("member_casual", *reversed(RAW_COLUMNS)), f"{folder}/JC-2.csv")
    return trip_csv.scan_trips(spark, f"{folder}/JC-*.csv").rows.select(RAW_COLUMNS)


@query("s2_archive_ingest", sql(f"SELECT {_RAW} FROM raw", "raw"))
def _(spark, sf):
    """CSV parts packed into one archive per task, unpacked into a raw zone and scanned there."""
    packed, raw_zone = scratch(spark, "zip"), scratch(spark, "raw")
    write_archives(t.raw_trips(spark, sf), packed)
    archives.extract_archives(spark, f"{packed}/*.zip", raw_zone)
    return trip_csv.scan_trips(spark, f"{raw_zone}/JC-*.csv").rows.select(RAW_COLUMNS)


def write_archives(trips, folder: str) -> None:
    """Pack a table into zip archives with one CSV member each, one archive per partition."""
    import io
    import uuid
    import zipfile

    from stationflow.sources.files import filesystem_of

    def pack(batches):
        filesystem, base = filesystem_of(folder)
        filesystem.create_dir(base, recursive=True)
        name = uuid.uuid4().hex
        with filesystem.open_output_stream(f"{base}/JC-{name}.zip") as sink:
            with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
                with archive.open(f"JC-{name}.csv", "w") as member:
                    text = io.TextIOWrapper(member, encoding="utf-8", newline="")
                    text.write(",".join(RAW_COLUMNS) + "\n")
                    for batch in batches:
                        batch.to_csv(text, index=False, header=False)
                        yield batch.head(0)
                    text.flush()
                    text.detach()

    trips.repartition(4).mapInPandas(pack, trips.schema).count()


@query(
    "s3_month_manifest",
    """SELECT o_custkey, CAST(m AS DATE) AS month, 'JC-' || strftime(m, '%Y%m') || '-tripdata.csv.zip' AS file_name
FROM (SELECT o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)),
  date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders GROUP BY 1)""",
)
def _(spark, sf):
    """Expected months between the first and the last order of each customer."""
    spans = (
        t.table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    )
    return calendar.month_manifest(spans, "first", "last")


@query(
    "s4_recent_months",
    """SELECT o_custkey, CAST(date_trunc('month', max(o_orderdate)) - to_months(i) AS DATE) AS month,
  'JC-' || strftime(date_trunc('month', max(o_orderdate)) - to_months(i), '%Y%m') || '-tripdata.csv.zip' AS file_name
FROM orders, (VALUES (0), (1)) AS b(i) GROUP BY o_custkey, i""",
)
def _(spark, sf):
    spans = t.table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("as_of"))
    return calendar.recent_months(spans, "as_of")


@query(
    "s5_missing_partitions",
    """SELECT o_custkey, CAST(m AS DATE) AS month, 'JC-' || strftime(m, '%Y%m') || '-tripdata.csv.zip' AS file_name
FROM (SELECT o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)),
  date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders GROUP BY 1) e
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = e.o_custkey
  AND strftime(o.o_orderdate, '%Y%m') = strftime(e.m, '%Y%m'))""",
)
def _(spark, sf):
    """Months without an order between the first and the last order of each customer."""
    orders = t.table(spark, sf, "orders")
    spans = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    present = orders.select("o_custkey", calendar.archive_name(F.col("o_orderdate")).alias("file_name"))
    return calendar.missing_partitions(
        calendar.month_manifest(spans, "first", "last"), present, ["o_custkey", "file_name"]
    )


@query("s6_newest_files", sql(f"SELECT {_RAW} FROM raw WHERE ended_at IS NULL", "raw"))
def _(spark, sf):
    """Two files written one after the other; the newer one is read."""
    folder = scratch(spark, "newest")
    raw = t.raw_trips(spark, sf)
    trip_csv.export_csv(raw.where(F.col("ended_at").isNotNull()), f"{folder}/JC-old.csv")
    trip_csv.export_csv(raw.where(F.col("ended_at").isNull()).repartition(1), f"{folder}/JC-new.csv")
    return trip_csv.scan_newest_trips(spark, f"{folder}/JC-*.csv/*.csv", 1).rows.select(RAW_COLUMNS)


@query("s1_scan_once", sql(f"SELECT {_RAW} FROM raw", "raw"))
def _(spark, sf):
    """The same files in one pass, cut into ranges of 10,000 bytes."""
    folder = scratch(spark, "csv")
    raw = t.raw_trips(spark, sf)
    classic = raw.where(F.col("ended_at").isNotNull())
    trip_csv.export_csv(classic, f"{folder}/JC-1.csv")
    extra = raw.where(F.col("ended_at").isNull()).withColumn("member_casual", F.lit("member"))
    trip_csv.export_csv(extra.select("member_casual", *reversed(RAW_COLUMNS)), f"{folder}/JC-2.csv")
    return one_pass.scan_once(spark, f"{folder}/JC-*.csv", range_bytes=10_000).rows.select(RAW_COLUMNS)


def _faulty_folder(spark, sf) -> str:
    """The trips as CSV files, beside files that cannot be used and rows that cannot."""
    import gzip

    from stationflow.sources.files import filesystem_of

    folder = scratch(spark, "faulty")
    raw = t.raw_trips(spark, sf)
    trip_csv.export_csv(raw.where(F.col("ended_at").isNotNull()), f"{folder}/good.csv")
    surplus = raw.where(F.col("ended_at").isNull()).select(*RAW_COLUMNS, F.lit("x").alias("more"))
    # One field more than the header has: the rows are set aside.
    surplus.select(F.concat_ws(",", *(F.coalesce(c, F.lit("")) for c in surplus.columns)).alias("value")).repartition(1).write.text(f"{folder}/rows.csv")
    filesystem, base = filesystem_of(folder)
    rows = [name for name in filesystem.get_file_info(_listing(f"{base}/rows.csv")) if name.base_name.startswith("part-")]
    with filesystem.open_input_stream(rows[0].path) as source, filesystem.open_output_stream(f"{base}/JC-rows-0.csv") as sink:
        sink.write((",".join(RAW_COLUMNS) + "\n").encode())
        while chunk := source.read(1 << 20):
            sink.write(chunk)
    header = ",".join(RAW_COLUMNS).encode()
    contents = {
        "JC-junk.csv": b"\x00\xff" * 100_000,
        "JC-twice.csv": header + b",ride_id\n1,2,3,4,5,6\n",
        "JC-unnamed.csv": header + b",\n1,2,3,4,5,6\n",
        "JC-short.csv": b"ride_id,started_at\n1,2\n",
        "JC-cut.csv.gz": gzip.compress(header + b"\n" + b"1,2024-01-01 00:00:00,2024-01-01 00:01:00,a,b\n" * 50_000)[:-200],
    }
    for name, content in contents.items():
        with filesystem.open_output_stream(f"{base}/{name}", compression=None) as sink:
            sink.write(content)
    return folder


def _listing(path):
    from pyarrow import fs

    return fs.FileSelector(path)


def _faulty_scan(spark, sf):
    folder = _faulty_folder(spark, sf)
    return trip_csv.scan_trip_files(spark, [f"{folder}/good.csv/*.csv", f"{folder}/JC-*.csv*"])


@query(
    "s7_rejected_files",
    """SELECT * FROM (VALUES ('JC-junk.csv', 'no line end in the first 65536 bytes'), ('JC-twice.csv', 'repeated column name'),
  ('JC-unnamed.csv', 'empty column name'), ('JC-cut.csv.gz', 'unreadable: OSError'),
  ('JC-short.csv', 'missing column ended_at, start_station_id, end_station_id')) AS v(file, reason)
WHERE (SELECT count(*) FROM events) > 0""",
)
def _(spark, sf):
    """Files that cannot be used are reported with the reason, beside trips that are read."""
    scan = _faulty_scan(spark, sf)
    return scan.rejected_files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "reason").where(F.lit(scan.rows.count() > 0))


@query("s7_rows_beside_rejects", sql(f"SELECT {_RAW} FROM raw WHERE ended_at IS NOT NULL", "raw"))
def _(spark, sf):
    """All usable files are read in spite of the others."""
    return _faulty_scan(spark, sf).rows.select(RAW_COLUMNS)


@query(
    "s7_rejected_rows",
    sql(
        """SELECT concat_ws(',', ride_id, started_at, coalesce(ended_at, ''), coalesce(start_station_id, ''),
  coalesce(end_station_id, ''), 'x') AS line, 'too many fields' AS reason
FROM raw WHERE ended_at IS NULL""",
        "raw",
    ),
)
def _(spark, sf):
    """Rows with too many fields are set aside as they stand."""
    return _faulty_scan(spark, sf).rejected_rows.select("line", "reason")


def _faulty_once(spark, sf):
    folder = _faulty_folder(spark, sf)
    return one_pass.scan_once(spark, [f"{folder}/good.csv/*.csv", f"{folder}/JC-*.csv*"])


@query("s7_once_rows", sql(f"SELECT {_RAW} FROM raw WHERE ended_at IS NOT NULL", "raw"))
def _(spark, sf):
    """One pass over good and faulty files gives the rows of the good ones."""
    return _faulty_once(spark, sf).rows.select(RAW_COLUMNS)


@query(
    "s7_once_rejects",
    sql(
        """SELECT 'row' AS kind, concat_ws(',', ride_id, started_at, coalesce(ended_at, ''), coalesce(start_station_id, ''),
  coalesce(end_station_id, ''), 'x') AS name, 'too many fields' AS reason FROM raw WHERE ended_at IS NULL
UNION ALL SELECT 'file', file, reason FROM (VALUES ('JC-junk.csv', 'no line end in the first 65536 bytes'), ('JC-twice.csv', 'repeated column name'),
  ('JC-unnamed.csv', 'empty column name'), ('JC-cut.csv.gz', 'unreadable: OSError'),
  ('JC-short.csv', 'missing column ended_at, start_station_id, end_station_id')) AS v(file, reason)""",
        "raw",
    ),
)
def _(spark, sf):
    """Damaged rows and unusable files of the same pass."""
    scan = _faulty_once(spark, sf)
    files = scan.rejected_files.select(F.lit("file").alias("kind"), F.element_at(F.split("path", "/"), -1).alias("name"), "reason")
    return scan.rejected_rows.select(F.lit("row").alias("kind"), F.col("line").alias("name"), "reason").unionByName(files)


@query("s10_roundtrip", sql("SELECT station_id, hour, rides FROM hourly_user", "hourly_user"))
def _(spark, sf):
    path = scratch(spark, "export") + ".csv"
    trip_csv.export_csv(t.hourly(spark, sf, "user_id"), path)
    return spark.read.schema(HOURLY_RIDES).option("header", True).csv(path)


@query("s15_key_from_path", sql("SELECT station_id, hour, rides FROM hourly", "hourly"))
def _(spark, sf):
    """One CSV per station without a station column; the id comes back from the file name."""
    folder = scratch(spark, "keyed")
    rides = t.hourly(spark, sf).persist()
    for name in [r["station_id"] for r in rides.select("station_id").distinct().collect()]:
        one = rides.where(F.col("station_id") == name).select("hour", "rides")
        trip_csv.export_csv(one, f"{folder}/predictions_{name}.csv")
    rides.unpersist()
    from pyspark.sql.types import StructType

    schema = StructType(HOURLY_RIDES.fields[1:])
    return trip_csv.read_keyed_csv(spark, f"{folder}/predictions_*.csv", schema)


# ------------------------------------------------------------ stored tables


@query("s12_store_read", sql("SELECT * FROM features WHERE station_id = 'click'", "features"))
def _(spark, sf):
    """A stored table read back with a filter that prunes its partitions."""
    store = TableStore(spark, scratch(spark, "store"))
    store.write("features", t.features(spark, sf), partition_by=["station_id"])
    return store.read("features").where(F.col("station_id") == "click").select(t.features(spark, sf).columns)


@query("s12_store_read_all", sql("SELECT * FROM features", "features"))
def _(spark, sf):
    """The same table read back whole."""
    store = TableStore(spark, scratch(spark, "store"))
    store.write("features", t.features(spark, sf), partition_by=["station_id"])
    return store.read("features").select(t.features(spark, sf).columns)


@query("s13_latest_version", sql("SELECT station_id, hour, rides FROM hourly_user", "hourly_user"))
def _(spark, sf):
    """Two versions of a table; reading without a version gives the newer one."""
    store = TableStore(spark, scratch(spark, "versions"))
    rides = t.hourly(spark, sf, "user_id")
    store.write("rides", rides.where(before()), version=9)
    store.write("rides", rides, version=10)
    return store.read("rides", version=None)


@query("s14_missing_table_empty", sql("SELECT station_id, hour, rides FROM hourly", "hourly"))
def _(spark, sf):
    """A missing table counts as empty in a union."""
    store = TableStore(spark, scratch(spark, "missing"))
    return t.hourly(spark, sf).unionByName(store.read("nothing", schema=HOURLY_RIDES))


@query(
    "t1_incremental_append",
    sql(
        f"""SELECT station_id, hour, rides FROM hourly
WHERE hour < TIMESTAMP '{SPLIT}' OR hour > (SELECT max(hour) FROM hourly WHERE hour < TIMESTAMP '{SPLIT}')""",
        "hourly",
    ),
)
def _(spark, sf):
    """Old rows stored, then the whole table offered twice: only the newer rows join, once."""
    store = TableStore(spark, scratch(spark, "append"))
    rides = t.hourly(spark, sf)
    store.write("rides", rides.where(before()))
    store.append_newer("rides", rides)
    store.append_newer("rides", rides)
    return store.read("rides")


@query("t1_seeded_features", sql("SELECT * FROM features_user", "features_user"))
def _(spark, sf):
    """History, then two batches that repeat stored hours: the same table as one run over all.

    Many stations are still in their first 28 hours when a batch ends.
    """
    store = TableStore(spark, scratch(spark, "seeded"))
    rides = t.hourly(spark, sf, "user_id")
    jobs.store_history(store, rides.where(before("hour", "2024-01-10")))
    jobs.store_recent(store, rides.where(before()))
    jobs.store_recent(store, rides.where(~before("hour", "2024-01-10")))
    return jobs.features(store)


@query("t1_retry_after_cut", sql("SELECT * FROM features_user", "features_user"))
def _(spark, sf):
    """A load dies after its features were written; the next one, which brings more, replaces them."""
    store = TableStore(spark, scratch(spark, "retried"))
    rides = t.hourly(spark, sf, "user_id")
    jobs.store_history(store, rides.where(before("hour", "2024-01-10")))
    with cut_off(store):
        jobs.store_recent(store, rides.where(before()))
    jobs.store_recent(store, rides.where(before("hour", "2024-01-25")))
    jobs.store_recent(store, rides)
    return jobs.features(store)


@contextmanager
def cut_off(store):
    """Loads of ``store`` fail where they would write the end of the series."""
    write = store.write

    def failing(name, *args, **options):
        if name == jobs.TAIL:
            raise OSError("cut off")
        write(name, *args, **options)

    store.write = failing
    with suppress(OSError):
        yield
    store.write = write


@query("t1_per_station_features", sql("SELECT * FROM features_user", "features_user"))
def _(spark, sf):
    """Batches in which half of the stations lag behind the others, each with its own mark."""
    store = TableStore(spark, scratch(spark, "own-marks"))
    rides = t.hourly(spark, sf, "user_id")
    late = F.crc32(F.col("station_id").cast("binary")) % 2 == 0
    jobs.store_history(store, rides.where(before("hour", "2024-01-10")))
    jobs.store_recent(store, rides.where(~late & before()), per_station=True)
    jobs.store_recent(store, rides.where(late & before("hour", "2024-01-15")), per_station=True)
    jobs.store_recent(store, rides, per_station=True)
    return jobs.features(store)


@query("t4_second_bootstrap", sql("SELECT * FROM features_user", "features_user"))
def _(spark, sf):
    """History, a batch, the history again from an earlier day on, and the rest as a batch."""
    store = TableStore(spark, scratch(spark, "again"))
    rides = t.hourly(spark, sf, "user_id")
    jobs.store_history(store, rides.where(before("hour", "2024-01-10")))
    jobs.store_recent(store, rides.where(before()))
    jobs.store_history(store, rides.where(before("hour", "2024-01-05")))
    jobs.store_recent(store, rides)
    return jobs.features(store)


@query(
    "t1_batch_features",
    sql(
        """SELECT * FROM features_old
UNION ALL SELECT * FROM features_new WHERE hour > (SELECT max(hour) FROM features_old)""",
        "features_old",
        "features_new",
    ),
)
def _(spark, sf):
    """The same without seeding: the batch loses its own first 28 hours of each station."""
    store = TableStore(spark, scratch(spark, "unseeded"))
    rides = t.hourly(spark, sf)
    store.write("features", feature_table(rides.where(before())))
    store.append_newer("features", feature_table(rides.where(~before())))
    return store.read("features")


@query("t4_bootstrap", sql("SELECT * FROM features_clean", "features_clean"))
def _(spark, sf):
    """Raw trips to a stored feature table in one job."""
    store = TableStore(spark, scratch(spark, "history"))
    jobs.load_history(store, t.raw_trips(spark, sf))
    return jobs.features(store)


@query(
    "t2_overwrite_partition",
    sql(
        """SELECT station_id, hour, CASE WHEN station_id = 'view' THEN rides + 1 ELSE rides END AS rides FROM hourly""",
        "hourly",
    ),
)
def _(spark, sf):
    """One partition is replaced, the others stay as they are."""
    store = TableStore(spark, scratch(spark, "replace"))
    rides = t.hourly(spark, sf)
    store.write("rides", rides, partition_by=["station_id"])
    changed = rides.where(F.col("station_id") == "view").withColumn("rides", F.col("rides") + 1)
    store.replace_partitions("rides", changed, ["station_id"])
    return store.read("rides").select("station_id", "hour", "rides")


@query(
    "t3_upsert_by_key",
    """SELECT user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
)
def _(spark, sf):
    """Two upserts; each key keeps its last row."""
    store = TableStore(spark, scratch(spark, "upsert"))
    rows = t.events(spark, sf).select("user_id", "event_type", "ts", "event_id", "value")
    for part in (rows.where(before("ts")), rows.where(~before("ts"))):
        store.upsert("last_event", part, ["user_id", "event_type"], ["ts", "event_id"])
    return store.read("last_event", version=None).drop("event_id")

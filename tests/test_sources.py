import os
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stationflow.operators.trips import clean_trips
from stationflow.schemas import HOURLY_RIDES
from stationflow.sources import archives, calendar, files, one_pass, trip_csv

HEADER = "ride_id,started_at,ended_at,start_station_id,end_station_id"
TIME = "2024-01-01 10:00:00"


def put(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def ids(df):
    return sorted(r["ride_id"] for r in df.collect())


def test_headers_differ_between_files(spark, tmp_path):
    put(tmp_path, "JC-1.csv", HEADER, f"a,{TIME},{TIME},s,e")
    put(tmp_path, "JC-2.csv", "extra,end_station_id,start_station_id,ended_at,started_at,ride_id", f"x,e2,s2,{TIME},{TIME},b")
    put(tmp_path, "JC-3.csv", "ride_id,started_at", "c,2024")
    put(tmp_path, "JC-4.csv", HEADER, f"d,{TIME},{TIME},s,e")
    put(tmp_path, "NY-1.csv", HEADER, f"z,{TIME},{TIME},s,e")
    scan = trip_csv.scan_trips(spark, f"{tmp_path}/JC-*.csv")
    rows = {r["ride_id"]: (r["start_station_id"], r["extra"]) for r in scan.rows.collect()}
    assert rows == {"a": ("s", None), "b": ("s2", "x"), "d": ("s", None)}
    bad = scan.rejected_files.collect()
    assert [os.path.basename(r["path"]) for r in bad] == ["JC-3.csv"]
    assert "ended_at" in bad[0]["reason"]
    assert clean_trips(scan.rows).count() == 3


def test_damaged_rows(spark, tmp_path):
    put(
        tmp_path,
        "JC-1.csv",
        HEADER + ",member",
        f"full,{TIME},{TIME},s,e,m",
        f"short,{TIME},{TIME},s,e",
        f'"quoted, comma",{TIME},{TIME},s,e',
        f"long,{TIME},{TIME},s,e,m,surplus",
        f"cut,{TIME}",
    )
    scan = trip_csv.scan_trips(spark, f"{tmp_path}/JC-*.csv")
    assert ids(scan.rows) == ["cut", "full", "quoted, comma", "short"]
    assert ids(clean_trips(scan.rows)) == ["full", "quoted, comma", "short"]
    # The verdict on a row does not depend on the columns a query needs.
    assert scan.rows.count() == 4 and scan.rows.select("started_at").count() == 4
    assert scan.rejected_rows.count() == 1
    rejected = scan.rejected_rows.collect()
    assert len(rejected) == 1 and rejected[0]["line"].startswith("long,")


def test_only_unusable_files(spark, tmp_path):
    put(tmp_path, "JC-1.csv", "ride_id", "a")
    scan = trip_csv.scan_trips(spark, f"{tmp_path}/JC-*.csv")
    assert scan.rows.count() == 0 and scan.rejected_files.count() == 1
    assert clean_trips(scan.rows).count() == 0


def test_newest_files(spark, tmp_path):
    for i, name in enumerate(["JC-c.csv", "JC-a.csv", "JC-b.csv"]):
        put(tmp_path, name, HEADER, f"{name[3]},{TIME},{TIME},s,e")
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    newest = files.newest_files(spark, f"{tmp_path}/JC-*.csv", 2)
    assert [os.path.basename(p) for p in newest] == ["JC-b.csv", "JC-a.csv"]
    assert ids(trip_csv.scan_newest_trips(spark, f"{tmp_path}/JC-*.csv", 2).rows) == ["a", "b"]


def test_listing_reads_no_content(spark, tmp_path, plan):
    put(tmp_path, "JC-1.csv", HEADER)
    text = plan(files.list_files(spark, f"{tmp_path}/*.csv"))
    assert "content" not in text.split("ReadSchema")[1]


def test_archives(spark, tmp_path):
    (tmp_path / "zips").mkdir()
    with zipfile.ZipFile(tmp_path / "zips" / "JC-202401.zip", "w") as z:
        z.writestr("JC-1.csv", f"{HEADER}\na,{TIME},{TIME},s,e\n")
        z.writestr("folder/JC-2.csv", f"{HEADER}\nb,{TIME},{TIME},s,e\n")
        z.writestr("../escape.csv", "x")
    (tmp_path / "zips" / "JC-broken.zip").write_bytes(b"not a zip")
    raw = tmp_path / "raw"
    report = archives.extract_archives(spark, f"{tmp_path}/zips/*.zip", str(raw)).collect()
    assert sorted(r["member"] for r in report if r["error"] is None) == ["JC-1.csv", "folder/JC-2.csv"]
    assert len([r for r in report if r["error"]]) == 2
    assert not (tmp_path / "escape.csv").exists()
    assert not list(raw.rglob("*.part"))
    assert ids(trip_csv.scan_trips(spark, f"{raw}/JC-*.csv").rows) == ["a"]
    assert ids(trip_csv.scan_trips(spark, f"{raw}/*/JC-*.csv").rows) == ["b"]


def test_months(spark):
    spans = spark.createDataFrame([(date(2023, 11, 15), date(2024, 2, 1))], "a date, b date")
    names = [r["file_name"] for r in calendar.month_manifest(spans, "a", "b").orderBy("month").collect()]
    assert names == [f"JC-{m}-tripdata.csv.zip" for m in (202311, 202312, 202401, 202402)]


def test_february_is_not_skipped(spark):
    as_of = spark.createDataFrame([(date(2024, 3, 1),)], "as_of date")
    months = [r["month"] for r in calendar.recent_months(as_of, "as_of").orderBy("month").collect()]
    assert months == [date(2024, 2, 1), date(2024, 3, 1)]


def test_missing_months(spark):
    spans = spark.createDataFrame([(date(2024, 1, 1), date(2024, 3, 1))], "a date, b date")
    manifest = calendar.month_manifest(spans, "a", "b")
    present = spark.createDataFrame([("JC-202402-tripdata.csv.zip",)], "file_name string")
    missing = calendar.missing_partitions(manifest, present, ["file_name"])
    assert sorted(r["month"].month for r in missing.collect()) == [1, 3]


def test_station_from_file_name(spark, tmp_path):
    put(tmp_path, "predictions_lag28_HB102.csv", "hour,rides", "2024-01-01 00:00:00,3")
    put(tmp_path, "predictions_lag28_JC115.csv", "hour,rides", "2024-01-01 01:00:00,4")
    schema = type(HOURLY_RIDES)(HOURLY_RIDES.fields[1:])
    df = trip_csv.read_keyed_csv(spark, f"{tmp_path}/predictions_*.csv", schema)
    assert sorted(tuple(r) for r in df.collect()) == [
        (datetime(2024, 1, 1, 0), 3, "HB102"),
        (datetime(2024, 1, 1, 1), 4, "JC115"),
    ]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 5), 7)], HOURLY_RIDES)
    trip_csv.export_csv(df, str(tmp_path / "out"))
    back = spark.read.schema(HOURLY_RIDES).option("header", True).csv(str(tmp_path / "out"))
    assert back.collect() == df.collect()


@pytest.mark.parametrize("uri", ["/tmp/x", "file:/tmp/x", "file:///tmp/x"])
def test_local_locations(uri):
    assert files.filesystem_of(uri)[1] == "/tmp/x"


def test_members_of_one_name(spark, tmp_path):
    """Two archives with a member of the same name: both come out."""
    import zipfile

    (tmp_path / "zips").mkdir()
    for n in (1, 2):
        with zipfile.ZipFile(tmp_path / "zips" / f"part{n}.zip", "w") as archive:
            archive.writestr("JC-same.csv", f"a\n{n}\n")
            archive.writestr(f"JC-own{n}.csv", f"a\n{n}0\n")
    report = archives.extract_archives(spark, f"{tmp_path}/zips/*.zip", str(tmp_path / "raw")).collect()
    assert [r["error"] for r in report] == [None] * 4
    found = spark.read.option("header", True).csv(f"{tmp_path}/raw/JC-*.csv")
    assert sorted(r["a"] for r in found.collect()) == ["1", "10", "2", "20"]


def test_unusable_files_do_not_stop_the_scan(spark, tmp_path):
    header = "ride_id,started_at,ended_at,start_station_id,end_station_id"
    (tmp_path / "JC-good.csv").write_text(f"{header}\n1,NA,2024-01-01 00:00:00,null,b\n2,2024-01-01 00:00:00,2024-01-01 00:01:00,a,b\n")
    (tmp_path / "JC-junk.csv").write_bytes(b"x" * 200_000)
    (tmp_path / "JC-twice.csv").write_text(f"{header},RIDE_ID\n1,2,3,4,5,6\n")
    scan = trip_csv.scan_trips(spark, f"{tmp_path}/JC-*.csv")
    rows = {r["ride_id"]: r for r in scan.rows.collect()}
    assert rows["1"]["started_at"] is None and rows["1"]["start_station_id"] is None and rows["2"]["start_station_id"] == "a"
    reasons = {r["path"].rsplit("/", 1)[-1]: r["reason"] for r in scan.rejected_files.collect()}
    assert reasons == {"JC-junk.csv": "no line end in the first 65536 bytes", "JC-twice.csv": "repeated column name"}


def test_one_task_for_each_row(spark):
    listing = spark.createDataFrame([(f"file-{n}",) for n in range(64)], "path string")
    spread = files.one_task_each(listing, ["path"])
    assert spread.select(F.spark_partition_id()).distinct().count() >= 60


def test_row_with_very_many_fields(spark, tmp_path):
    """A row with a million quoted surplus fields is set aside like any other."""
    put(tmp_path, "JC-1.csv", HEADER, f"a,{TIME},{TIME},s,e", f"long,{TIME},{TIME},s,e" + ',"x,y"' * 1_000_000, f"b,{TIME},{TIME},s,e")
    scan = trip_csv.scan_trips(spark, f"{tmp_path}/JC-*.csv")
    assert ids(scan.rows) == ["a", "b"]
    assert scan.rejected_rows.select(F.length("line")).first()[0] > 6_000_000


def test_one_pass_equals_the_scan(spark, tmp_path):
    """Differing headers, short, long and unbalanced rows, quoted commas, compressed files, in ranges of a few bytes."""
    import gzip

    good = [f"id{n},{TIME},{TIME},s{n},e" for n in range(50)]
    put(tmp_path, "JC-1.csv", HEADER, *good)
    put(tmp_path, "JC-2.csv", "extra," + HEADER, f'"x, y",b,{TIME},{TIME},s,e', f",c,{TIME}", f"1,d,{TIME},{TIME},s,e,f", "", f"2,NA,{TIME},{TIME},null,e")
    put(tmp_path, "JC-3.csv", "ride_id,started_at", "x,1")
    (tmp_path / "JC-4.csv").write_bytes(f"{HEADER}\ne1,{TIME},{TIME},s\xe9,e\ne2,{TIME},{TIME},s,e".encode("latin-1"))
    (tmp_path / "JC-5.csv.gz").write_bytes(gzip.compress(("\n".join([HEADER, *(f"z{n},{TIME},{TIME},s,e" for n in range(9_000))]) + "\n").encode()))
    (tmp_path / "JC-6.csv.gz").write_bytes((tmp_path / "JC-5.csv.gz").read_bytes()[:-30])
    columns = ["ride_id", "started_at", "ended_at", "start_station_id", "end_station_id", "extra", "source_file"]
    want = trip_csv.scan_trips(spark, f"{tmp_path}/JC-*.csv*")
    for size in (7, 100, 1 << 20):
        got = one_pass.scan_once(spark, f"{tmp_path}/JC-*.csv*", range_bytes=size)
        for a, b in ((got.rows.select(columns), want.rows.select(columns)), (got.rejected_rows.select("line", "reason"), want.rejected_rows.select("line", "reason")), (got.rejected_files, want.rejected_files)):
            a, b = (sorted(tuple(map(str, r)) for r in df.collect()) for df in (a, b))
            assert [x for x in a if x not in b] == [] and a == b


def test_one_pass_reads_files_once(spark, tmp_path):
    """What the pass found stays when the files are gone; a row of very many fields is set aside."""
    put(tmp_path, "JC-1.csv", HEADER, f"a,{TIME},{TIME},s,e", f"long,{TIME},{TIME},s,e" + ',"x,y"' * 1_000_000, f'open,"{TIME},{TIME},s,e', f"b,{TIME},{TIME},s,e")
    scan = one_pass.scan_once(spark, f"{tmp_path}/JC-*.csv")
    (tmp_path / "JC-1.csv").rename(tmp_path / "gone")
    assert ids(scan.rows) == ["a", "b", "open"]
    assert scan.rejected_rows.select(F.length("line")).first()[0] > 6_000_000
    assert one_pass.scan_once(spark, f"{tmp_path}/gone", required=["none"]).rejected_files.first()["reason"] == "missing column none"


def test_rows_of_one_file_go_to_several_tasks(spark, tmp_path):
    """Leaving out the rows of unusable files does not bring all rows of a file to one task."""
    rows = 20_000
    put(tmp_path, "JC-1.csv", HEADER, *(f"id{n},{TIME},{TIME},s{n},e" for n in range(rows)))
    put(tmp_path, "JC-2.csv", "ride_id,started_at", "x,1")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = one_pass.scan_once(spark, f"{tmp_path}/JC-*.csv", range_bytes=10_000).rows
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert sum(sizes) == rows and max(sizes) < rows / 2


def test_trip_files_are_written_in_parallel(spark, tmp_path, monkeypatch):
    """The files of the one-pass query come from as many tasks as its table has parts."""
    from datetime import datetime

    from suite import source_queries

    event = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    rows = [(n, datetime(2024, 1, 1, n % 24), n, "click", 5.0 + n % 300) for n in range(400)]
    spark.createDataFrame(rows, event).repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    written = []
    export = trip_csv.export_csv
    monkeypatch.setattr(trip_csv, "export_csv", lambda df, path: (written.append(df.rdd.getNumPartitions()), export(df, path)))
    try:
        found = source_queries.QUERIES["s1_scan_once"](spark, str(tmp_path))
        assert found.count() == 400 and written == [4, 4]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")

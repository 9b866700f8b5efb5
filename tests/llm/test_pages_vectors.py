"""WARC archives and nearest neighbours."""

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import ann, warc
from stationflow.llm.common import ready, table
from stationflow.sources.files import filesystem_of


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, None, None, "e"), (2, "http://a\r\nInjected: x", "x" * 200, "e"), (3, "u", "x" * 200, "e"), (None, "u", "x" * 200, "e"),
        (4, "u", "y", "e"), (5, "v", "y", "e"), (6, "ü", "é" * 100_000 + "\r\n\r\n", None), (6, "ü", "é" * 100_000 + "\r\n\r\n", None),
        (7, "w", "é" * 100_000 + "\r\n\r\n", None), (None, "n", "z" * 150, "e"),
    ]
    return ready(spark).createDataFrame(rows, "page_id long, url string, html string, payload string")


@pytest.fixture(scope="module")
def folder(pages):
    return warc.write_pages(pages)


def test_pages_come_back(spark, folder):
    found = sorted(((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_pages(spark, folder).collect()), key=str)
    want = [
        (1, 0, "response", None), (2, 200, "response", None), (3, 200, "revisit", 2), (0, 200, "revisit", 2), (4, 1, "response", None),
        (5, 1, "response", None), (6, 200_004, "response", None), (6, 200_004, "response", None), (7, 200_004, "revisit", 6), (0, 150, "response", None),
    ]
    assert found == sorted(want, key=str)


def test_payloads_and_headers(spark, folder):
    archive = spark.read.format("warc").load(folder)
    by_id = {r["record_id"]: r for r in archive.collect()}
    assert by_id["urn:page:2"]["payload"] == b"x" * 200
    assert by_id["urn:page:2"]["target_uri"] == "http://a%0D%0AInjected: x"
    assert by_id["urn:page:6"]["payload"].decode() == "é" * 100_000 + "\r\n\r\n"
    assert by_id["urn:page:3"]["payload"] is None
    bare = spark.read.format("warc").option("payload", "false").load(folder)
    assert bare.where("payload is not null").count() == 0 and bare.count() == 10


def test_header_predicates_are_taken_by_the_reader(spark, folder):
    archive = spark.read.format("warc").load(folder)
    assert archive.where("record_type = 'revisit'").count() == 3
    assert archive.where(F.col("record_id").isin("urn:page:4", "urn:page:5") & F.col("target_uri").startswith("v")).count() == 1
    assert archive.where("payload_bytes = 150").count() == 1
    plan = archive.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")


def test_files_are_ordinary_gzip(folder):
    filesystem, base = filesystem_of(folder)
    files = [f for f in filesystem.get_file_info(__import__("pyarrow.fs").fs.FileSelector(base)) if f.path.endswith(".warc.gz")]
    text = b"".join(gzip.decompress(filesystem.open_input_file(f.path).read()) for f in files)
    assert text.count(b"WARC/1.1\r\n") == 10


def test_members_without_stated_length(spark, folder, tmp_path):
    """Archives of other writers, made of plain gzip members, are read as well."""
    rows = [dict(record_id=f"urn:page:{n}", record_type="response", target_uri="u", refers_to=None, payload_digest=None, payload_bytes=None, payload=b"p" * 9000 * n) for n in range(3)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(warc.record(r)) for r in rows))
    archive = warc.register(spark).read.format("warc").load(f"file://{tmp_path}")
    assert sorted((r["record_id"], len(r["payload"])) for r in archive.collect()) == [(f"urn:page:{n}", 9000 * n) for n in range(3)]
    assert archive.where("record_id = 'urn:page:2'").count() == 1


def test_long_urls_come_back(spark):
    """A url longer than any read step is stored and read like others, for a response and a revisit."""
    noise = np.random.default_rng(4).integers(97, 123, 3 << 20, dtype=np.uint8).tobytes().decode()
    rows = [(1, "http://a/" + noise, "x" * 200), (2, "http://b/" + "y" * (5 << 20), "x" * 200), (3, "u", "z")]
    folder = warc.write_pages(ready(spark).createDataFrame(rows, "page_id long, url string, html string"))
    found = {r["target_uri"]: (r["record_type"], r["payload"]) for r in spark.read.format("warc").load(folder).collect()}
    assert {u: k for u, (k, _) in found.items()} == {rows[0][1]: "response", rows[1][1]: "revisit", "u": "response"}
    assert bytes(found[rows[0][1]][1]) == b"x" * 200
    assert warc.read_pages(spark, folder).count() == 3


def test_no_pages(spark, pages):
    assert warc.read_pages(spark, warc.write_pages(pages.limit(0))).count() == 0


def brute_nearest(ids, vectors, query, k):
    scores = vectors @ vectors[query]
    scores[query] = -np.inf
    return [ids[n] for n in np.lexsort((ids, -scores))[:k]]


def test_recall(spark):
    frame = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = frame.orderBy("vec_id").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    found = {}
    for r in ann.search(frame).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    asked = [n for n, i in enumerate(ids) if i % 20 == 0]
    assert set(found) == {ids[n] for n in asked}
    hits = sum(len(set(found[ids[n]]) & set(brute_nearest(ids, vectors, n, 20))) for n in asked)
    assert hits >= 0.9 * 20 * len(asked)


def test_unequal_norms(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((400, 6)) * rng.lognormal(0, 1, (400, 1))
    frame = ready(spark).createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    ids, hits, total = np.arange(400), 0, 0
    for r in ann.search(frame, k=5).groupBy("query_id").agg(F.collect_list("vec_id").alias("found")).collect():
        hits += len(set(r["found"]) & set(brute_nearest(ids, vectors, r["query_id"], 5)))
        total += 5
    assert total == 100 and hits >= 90


def test_vector_edge_cases(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, 2.0, 3.0]), (20, [0.0, 1.0])]
    rows += [(21, [0.5, 0.5]), (21, [0.5, 0.5]), (22, [None, 1.0]), (40, [3.0, -1.0]), (None, [1.0, 1.0])] + [(100 + i, [1.0, 0.0]) for i in range(30)]
    frame = ready(spark).createDataFrame([(a, b, "x", 1) for a, b in rows], "vec_id long, embedding array<double>, p string, cell int")
    found = {}
    for r in ann.search(frame, k=3).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found == {
        0: [(40, 3.0), (1, 1.0), (100, 1.0)], 20: [(21, 0.5), (0, 0.0), (1, 0.0)], 40: [(0, 3.0), (1, 3.0), (100, 3.0)],
        100: [(40, 3.0), (0, 1.0), (1, 1.0)], 120: [(40, 3.0), (0, 1.0), (1, 1.0)],
    }
    assert ann.search(frame.limit(0)).count() == 0
    assert ann.search(frame.where("vec_id in (20, 21)")).count() == 1


def test_chi_square_quantile():
    # Published quantiles.
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.5073, abs=1e-4)
    assert ann.chi_square_quantile(0.99, 2) == pytest.approx(9.2103, abs=1e-4)

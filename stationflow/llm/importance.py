"""Resampling towards a target distribution by hashed word n-grams.

The tokenizers library cuts texts by an untrained Regex split, which returns words with offsets.  Each
window over the offset pairs of consecutive words is a feature, its CRC-32 names a bucket.  Bucket
counts of the raw and the target texts give a gain per bucket, a document's weight is the mean gain
of its features, and noise keyed by its id turns the weights into a draw without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.common import fixed
from stationflow.llm.token_files import Runs, in_batches, utf8
from stationflow.operators.numbering import number_rows

# Letters and digits of ASCII in lower case, and every other character above ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
GAIN_UNITS = 1000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
# Distinct pieces of text that go through the library in one call.
PIECES_A_CALL = 4096
POLYNOMIAL = 0xEDB88320
# Words up to this many bytes are appended to a checksum by tables, longer ones byte by byte.
TABLE_BYTES = 48


def crc_table() -> np.ndarray:
    """The byte table of CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ POLYNOMIAL, table >> 1).astype(np.uint32)
    return table


def append_tables(longest: int) -> np.ndarray:
    """``[n, byte, value]``: what a checksum with that byte becomes by appending ``n`` zero bytes.

    A checksum is linear, so the one of ``a + b`` is that of ``a`` moved on by ``len(b)`` zero bytes,
    exclusive-or that of ``b``.
    """
    table = crc_table()
    values = np.arange(256, dtype=np.uint32)
    tables = np.empty((longest + 1, 4, 256), np.uint32)
    tables[0] = [values << np.uint32(8 * byte) for byte in range(4)]
    for n in range(longest):
        tables[n + 1] = tables[n] >> np.uint32(8) ^ table[tables[n] & np.uint32(255)]
    return tables


@dataclass(frozen=True)
class Features:
    """Words and feature buckets of some texts: per text the number of words and its buckets, words first."""

    n_words: np.ndarray
    buckets: Runs


class Windows:
    """Cuts texts into words by the library and hashes all runs of one and two of them."""

    def __init__(self) -> None:
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.tables = append_tables(TABLE_BYTES)

    def words_of(self, pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All words of distinct pieces, in order, and how many each piece has.

        Pieces are joined by a character that no word holds; the offsets tell them apart again.
        """
        words, counts = [], []
        for at in range(0, len(pieces), PIECES_A_CALL):
            chunk = pieces[at : at + PIECES_A_CALL]
            found = self.split.pre_tokenize_str("\n".join(chunk.to_pylist()))
            starts = np.concatenate([[0], np.cumsum(np.asarray(pc.utf8_length(chunk)) + 1)])
            places = np.fromiter((offsets[0] for _, offsets in found), np.int64, len(found))
            words.extend(word for word, _ in found)
            counts.append(np.diff(np.searchsorted(places, starts)))
        return pa.array(words, pa.string()), np.concatenate([np.empty(0, np.int64), *counts])

    def appended(self, sums: np.ndarray, words: np.ndarray, crc: np.ndarray, size: np.ndarray, text: pa.Array) -> np.ndarray:
        """Checksums of what ``sums`` stand for followed by the words of those numbers."""
        sizes = size[words]
        table = self.tables.reshape(-1)
        base = np.minimum(sizes, TABLE_BYTES) * 1024
        moved = table[base + (sums & 255)] ^ table[base + 256 + (sums >> 8 & 255)] ^ table[base + 512 + (sums >> 16 & 255)] ^ table[base + 768 + (sums >> 24)]
        out = moved ^ crc[words]
        for n in np.flatnonzero(sizes > TABLE_BYTES):
            out[n] = zlib.crc32(text[int(words[n])].as_py().encode(), int(sums[n]))
        return out

    def features(self, texts: pa.Array) -> Features:
        """Features of texts; a null has none."""
        # White space of ASCII never lies within a word, so the library sees each distinct piece between once.
        low = pc.ascii_lower(utf8(texts).fill_null(""))
        own = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(low))
        pieces = own.flatten().dictionary_encode()
        words, counts = self.words_of(pieces.dictionary)
        words = words.dictionary_encode()
        which = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text = words.dictionary
        raw = [w.encode() for w in text.to_pylist()]
        crc = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
        spaced = np.fromiter((zlib.crc32(b" ", c) for c in crc.tolist()), np.uint32, len(raw))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        in_order = Runs(which, counts).take(pieces.indices.to_numpy(zero_copy_only=False))
        places = own.offsets.to_numpy()
        n_words = np.diff(np.concatenate([[0], in_order.ends])[places - places[0]])
        seq = in_order.flat
        doc = np.repeat(np.arange(len(n_words)), n_words)
        # Two consecutive words of one text are a window.
        pair = np.flatnonzero(doc[1:] == doc[:-1])
        second = self.appended(spaced[seq[pair]], seq[pair + 1], crc, size, text)
        hashes = np.concatenate([crc[seq], second])
        order = np.argsort(np.concatenate([doc, doc[pair]]), kind="stable")
        return Features(n_words, Runs((hashes % BUCKETS)[order].astype("<u2"), n_words + np.maximum(n_words - 1, 0)))


FEATURES = "doc_id long, n_words long, buckets binary"


def features(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: id, number of words, the bucket of each feature as unsigned 16-bit integers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows()
        for batch in in_batches(batches):
            found = windows.features(batch.column(1))
            ends = found.buckets.ends.tolist()
            lists = [found.buckets.flat[a:b].tobytes() for a, b in zip([0, *ends], ends)]
            columns = [batch.column(0), pa.array(found.n_words, pa.int64()), pa.array(lists, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "buckets"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), "text").mapInArrow(cut, FEATURES)


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """How many features of all rows fall into each bucket: counted by task, then one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for lists in batch.column(0).drop_null().to_pylist():
                total += np.bincount(np.frombuffer(lists, "<u2"), minlength=BUCKETS)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(total[own], pa.int64())], ["bucket", "n"])

    counted = rows.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS, np.int64)
    for row in counted.collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` per bucket."""
    all_raw, all_target = float(raw.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    ratios = ((t + 1.0) * all_raw / ((s + 1.0) * all_target) for s, t in zip(raw.tolist(), target.tolist()))
    return np.array([math.floor(GAIN_UNITS * math.log(r)) for r in ratios], np.int64)


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of a document's features, 0 without any."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(b, "<u2") for b in batch.column("buckets").to_pylist()]
            sizes = np.array([len(b) for b in lists], np.int64)
            sums = np.array([gain[b].sum() for b in lists], np.int64)
            columns = [batch.column("doc_id"), batch.column("n_words"), pa.array(sizes), pa.array(sums // np.maximum(sizes, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column) -> Column:
    """Gumbel noise in thousandths, keyed by the id; a row without an id has that of the word ``null``."""
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-GAIN_UNITS * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, target_key: str = "item_id") -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; rows drawn have a rank.

    ``PERCENT`` of the rows with at least ``LEAST_WORDS`` words are drawn, by highest score, ties to the
    smaller id (rows without an id first).  The features are written once and read for the counts and
    for the weights; the driver sees one number a bucket.  Only the narrow rows that can be drawn are
    sorted, by ranges that number themselves.

    A null or text without words has no features, weight 0 and no rank.  Repeated rows count, and are
    drawn, each by itself, also where all columns are equal.  An empty table gives no rows, an empty
    target counts no features.  Columns other than the id and the text are not looked at.
    """
    found = fixed(features(docs), "importance-features")
    gain = gains(bucket_counts(found), bucket_counts(features(target, target_key)))
    rows = weighted(found, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    rows = fixed(rows, "importance-scores")
    able = rows.where(F.col("n_words") >= LEAST_WORDS)
    drawn = able.count() * PERCENT // 100
    order = {"order_score": -F.col("score"), "order_id": F.col("doc_id"), "order_features": F.col("n_features"), "order_row": F.monotonically_increasing_id()}
    columns = ["doc_id", "n_features", "weight", "score"]
    numbered = number_rows(able.select(*columns, *(c.alias(n) for n, c in order.items())), list(order), "place")
    place = F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    rest = rows.where(F.col("n_words") < LEAST_WORDS).select(*columns, F.lit(None).cast("long").alias("rank"))
    return numbered.select(*columns, place).unionByName(rest)


def oracle() -> str:
    """The same in DuckDB's SQL; the checksum is folded over the bytes of each distinct feature."""
    table = ", ".join(map(str, crc_table().tolist()))
    words = lambda text: f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')"
    return f"""
        WITH words AS (
            SELECT 'raw' AS side, row_number() OVER () AS row, doc_id AS id, {words("text")} AS w FROM documents
            UNION ALL SELECT 'target', row_number() OVER (), item_id, {words("text")} FROM benchmark
        ), features AS (
            SELECT side, row, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM words
        ), counted AS (
            SELECT side, row, feature, count(*) AS n FROM features GROUP BY side, row, feature
        ), distinct_features AS (
            SELECT feature, hex(encode(feature)) AS digits, [{table}]::UINTEGER[] AS crc FROM (SELECT DISTINCT feature FROM counted)
        ), hashed AS (
            SELECT feature, xor(list_reduce([4294967295::UINTEGER] || list_transform(range(0, length(digits) // 2), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::UINTEGER),
                lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255::UINTEGER) + 1])), 4294967295::UINTEGER) % {BUCKETS} AS bucket FROM distinct_features
        ), placed AS (
            SELECT side, row, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) GROUP BY side, row, bucket
        ), sums AS (
            SELECT bucket, coalesce(sum(n) FILTER (side = 'raw'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'target'), 0)::DOUBLE AS t FROM placed GROUP BY bucket
        ), totals AS (
            SELECT sum(s) AS all_s, sum(t) AS all_t FROM sums
        ), gains AS (
            SELECT bucket, floor({GAIN_UNITS} * ln((t + 1) * (all_s + {BUCKETS}) / ((s + 1) * (all_t + {BUCKETS}))))::BIGINT AS gain FROM sums, totals
        ), weights AS (
            SELECT row, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 'raw' GROUP BY row
        ), scored AS (
            SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-{GAIN_UNITS} * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(id::VARCHAR, 'null')), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM words LEFT JOIN weights USING (row) WHERE side = 'raw'
        ), ranked AS (
            SELECT *, CASE WHEN n_words >= {LEAST_WORDS} THEN row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST, n_features) END AS place,
                   count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS able FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= able * {PERCENT} // 100 THEN place END AS rank FROM ranked
    """

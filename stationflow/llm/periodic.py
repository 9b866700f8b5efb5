"""Periodic runs of words: seeds on diagonals, extended to both sides.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are identical) and at least
``max(LEAST_LENGTH, LEAST_PERIODS * q)`` words that no neighbouring word extends.  On its diagonal, the
pairs of words ``q`` apart, it covers at least ``max(LEAST_LENGTH - q, (LEAST_PERIODS - 1) * q)`` places.
So lags are searched by classes, each with an index of the k-grams of the smallest overlap that its
lags guarantee.  ``k`` is at least ``2 * lag - 1`` for all lags of a class; two occurrences of a k-gram
nearer than the run's period would give the run a shorter one, therefore the next occurrence in the
same document is the one a period on and only neighbouring occurrences need be paired: their number
grows with the text, also where one word fills a document.  A table per lag keeps how far its diagonal
is covered, so that every stretch is extended once.

The search runs on whole Arrow batches: words are numbers, k-grams are numbered exactly (no hash
decides), and documents are parted by numbers of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.importance import crc_table
from stationflow.llm.token_files import in_batches, utf8

LEAST_LENGTH = 6
LEAST_PERIODS = 4
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of texts searched together; the search needs some 40 bytes a word beside them.
SEARCH_BYTES = 8 << 20
# Odd multipliers of the hash that rules out k-grams that occur once.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# Places compared at first when a stretch is extended; doubled while they are equal.
STRIDE = 64

RUNS = "array<struct<start: long, length: long, period: long>>"
SCHEMA = f"doc_id long, n_words long, runs {RUNS}, collapsed string"


def lag_classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """``k, first lag, last lag`` of the classes whose runs fit into ``longest`` words."""
    first = 1
    while max(LEAST_LENGTH, LEAST_PERIODS * first) <= longest:
        k = min(max(LEAST_LENGTH - q, (LEAST_PERIODS - 1) * q) for q in range(first, first + 2))
        last = (k + 1) // 2
        yield k, first, last
        first = last + 1


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of equal keys, and whether a key occurs more than once."""
    numbers, _ = pd.factorize(keys)
    return numbers, np.bincount(numbers)[numbers] > 1


class Grams:
    """Places whose k-gram occurs again in the same document, with its number, for growing ``k``."""

    def __init__(self, words: np.ndarray, document: np.ndarray) -> None:
        """``words`` has a number of its own after each document, so no repeated k-gram spans two."""
        self.words, self.document, self.k = words, document, 1
        self.number_at = np.full(len(words), -1, np.int64)
        self.places = self.numbers = np.empty(0, np.int64)

    def start(self, k: int) -> None:
        """All places whose k-gram is repeated: two hash tables rule out most others, then each word is compared."""
        words, n = self.words, len(self.words) - k + 1
        self.k = k
        places = np.arange(max(n, 0))
        for multiplier in MULTIPLIERS:
            if not len(places):
                break
            total = self.document[places].astype(np.uint64)
            for at in range(k):
                total = total * np.uint64(multiplier) + words[places + at].astype(np.uint64)
            bits = max(10, int(len(places) * 3).bit_length())
            total = (total * np.uint64(MULTIPLIERS[0])) >> np.uint64(64 - bits)
            places = places[np.bincount(total.astype(np.int64), minlength=1 << bits)[total.astype(np.int64)] > 1]
        numbers = self.document[places]
        for at in range(k):
            numbers, again = repeated(numbers * (int(words.max()) + 1) + words[places + at] if len(places) else numbers)
            places, numbers = places[again], numbers[again]
        self.places, self.numbers = places, numbers

    def grow(self, k: int) -> None:
        """Go on to longer k-grams, each the pair of two known ones that cover it."""
        while self.k < k and len(self.places):
            step = min(2 * self.k, k) - self.k
            self.number_at[self.places] = self.numbers
            inside = self.places + step < len(self.words)
            places, numbers = self.places[inside], self.numbers[inside]
            second = self.number_at[places + step]
            self.number_at[self.places] = -1
            both = second >= 0
            keys = numbers[both] * (int(self.numbers.max()) + 1) + second[both]
            found, again = repeated(keys)
            self.places, self.numbers = places[both][again], found[again]
            self.k += step
        self.k = k

    def neighbours(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and lag of all neighbouring occurrences of a k-gram whose lag lies in the class."""
        order = np.argsort(self.numbers, kind="stable")
        numbers, places = self.numbers[order], self.places[order]
        lags = np.diff(places)
        good = (numbers[1:] == numbers[:-1]) & (lags >= first) & (lags <= last)
        return places[:-1][good], lags[good]


def extended(words: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The whole stretch of equal pairs ``lag`` apart around an equal pair: first place, and the one after the last."""
    end, stride = place, STRIDE
    while True:
        n = min(stride, len(words) - lag - end)
        other = np.flatnonzero(words[end : end + n] != words[end + lag : end + lag + n])
        if len(other) or n < stride:
            end += int(other[0]) if len(other) else n
            break
        end, stride = end + n, 2 * stride
    start, stride = place, STRIDE
    while True:
        n = min(stride, start)
        other = np.flatnonzero(words[start - n : start] != words[start - n + lag : start + lag])
        if len(other) or n < stride:
            start -= n - int(other[-1]) - 1 if len(other) else n
            break
        start, stride = start - n, 2 * stride
    return start, end


def find(words: np.ndarray, document: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs, by start and period; places count over all documents."""
    grams, found = Grams(words, document), []
    for k, first, last in lag_classes(longest):
        if first == 1:
            grams.start(k)
        else:
            grams.grow(k)
        if not len(grams.places):
            break
        places, lags = grams.neighbours(first, last)
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        # Seeds of one lag lie in order of place: those before the covered end are passed over at once.
        seeds, at = lags * len(words) + places, 0
        while at < len(seeds):
            lag = int(lags[at])
            start, covered = extended(words, int(places[at]), lag)
            length = covered - start + lag
            if length >= max(LEAST_LENGTH, LEAST_PERIODS * lag):
                found.append((start, length, lag))
            at = max(at + 1, int(np.searchsorted(seeds, lag * len(words) + covered)))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _searched(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = pc.ascii_trim_whitespace(utf8(batch.column("text")).fill_null(""))
    lists = pc.ascii_split_whitespace(pc.if_else(pc.equal(texts, ""), pa.scalar(None, pa.string()), texts))
    flat = lists.flatten().dictionary_encode()
    own = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends -= ends[0]
    sizes, docs = np.diff(ends), np.arange(len(ends) - 1)
    # A number of its own after each document's words.
    words = np.insert(own, ends[1:], len(flat.dictionary) + docs)
    document = np.repeat(docs, sizes + 1)
    runs = find(words, document, int(sizes.max(initial=0)))

    rows: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    dropped = np.zeros(len(words), bool)
    before = ends[:-1] + docs
    for start, length, period in runs:
        doc = int(document[start])
        rows[doc].append((start - int(before[doc]), length, period))
        dropped[start + period : start + length] = True
    kept = ~np.delete(dropped, ends[1:] + docs)
    counts = np.concatenate([[0], np.cumsum(kept)])[ends]
    text = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), flat.dictionary.take(pa.array(own[kept])))
    struct = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    as_dicts = [[dict(zip(("start", "length", "period"), r)) for r in own_runs] for own_runs in rows]
    columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(as_dicts, struct), pc.binary_join(text, " ")]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: id, number of words, its runs by start and period, and the collapsed text.

    Places are numbers of words, from 0.  The collapsed text is the words joined by one space without
    those that lie in any run after that run's first period.  A null or text without words has no
    words, no runs and an empty collapsed text.  Repeated rows and rows without an id are searched
    each by itself, an empty table gives none, other columns are not looked at.  Nothing is shuffled;
    a text is held whole by its task.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(_searched, in_batches(batches, SEARCH_BYTES))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, SCHEMA)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where a tenth of the texts by id repeats a block of words up to its end.

    ``h`` is the checksum of the id; where ``h % 10`` is 0, each of the ``n`` words from ``a`` on becomes
    the word ``a + (i - a) % p``.  Rows without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        block = F.slice(words, a + 1, p)
        tail = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise("")

    # The words are bound by a one-element list, so that they are cut once.
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    text = F.element_at(F.transform(F.array(words), planted), 1)
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def summary(found: DataFrame) -> DataFrame:
    """The longest run of each document (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    # Runs are sorted by start and period, so the first of the longest ones is the one wanted.
    longest = F.array_max(F.transform("runs", lambda r: r["length"]))
    top = F.get(F.filter("runs", lambda r: r["length"] == longest), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[n].cast("string") for n in ("start", "length", "period"))), F.lit("\n")))
    rows = found.select("doc_id", "runs", "collapsed", top.alias("top"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def oracle() -> str:
    """The whole query in DuckDB's SQL: equal 5-grams of a text by lag, stretches of them, and those no shorter period explains."""
    table = ", ".join(map(str, crc_table().tolist()))
    digits = "list_transform(range(0, strlen(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::UINTEGER)"
    return f"""
        WITH cut AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
                   xor(list_reduce([4294967295::UINTEGER] || {digits}, lambda c, b: xor(c >> 8, ([{table}]::UINTEGER[])[(xor(c, b) & 255::UINTEGER) + 1])), 4294967295::UINTEGER)::BIGINT AS h
            FROM documents
        ), sized AS (
            SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM cut
        ), planned AS (
            SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM sized
        ), texts AS (
            SELECT row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                THEN list_transform(range(0, n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM planned
        ), words AS (
            SELECT row, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM texts
        ), grams AS (
            SELECT row, n, i, hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS k,
                   concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram
            FROM words WINDOW o AS (PARTITION BY row ORDER BY i)
        ), pairs AS (
            SELECT x.row, x.i, y.i - x.i AS q FROM grams x JOIN grams y
              ON x.row = y.row AND x.k = y.k AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
            WHERE x.i <= x.n - 5 AND y.i <= y.n - 5
        ), stretches AS (
            SELECT row, q, min(i) AS start, count(*) + 4 + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pairs) GROUP BY row, q, island
        ), able AS (
            SELECT * FROM stretches WHERE length >= {LEAST_LENGTH} AND length >= {LEAST_PERIODS} * q
        ), runs AS (
            SELECT * FROM able r WHERE NOT EXISTS (
                SELECT 1 FROM able s WHERE s.row = r.row AND s.q < r.q AND s.start <= r.start AND s.start + s.length >= r.start + r.length)
        ), gone AS (
            SELECT DISTINCT row, unnest(range(start + q, start + length)) AS i FROM runs
        ), kept AS (
            SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (row, i) GROUP BY row
        ), summed AS (
            SELECT row, count(*) AS n_runs, arg_min({{'s': start, 'l': length, 'q': q}}, [-length, start, q]) AS top,
                   string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS lines FROM runs GROUP BY row
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s::BIGINT AS start, top.l::BIGINT AS length, top.q::BIGINT AS period,
               (1000 * top.l // top.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM texts LEFT JOIN summed USING (row) LEFT JOIN kept USING (row)
    """

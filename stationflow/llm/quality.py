"""Quality rules: fixed base rules, then boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled documents, flattened into numpy node arrays
and shipped with the task; every document is scored in place, so the operator has no shuffle.
More symbols, repeats, repeated lines, capitals or odd word ends can only lower a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm import boosting
from stationflow.llm.common import fresh_name

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FEATURES = (
    "log_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate",
    "upper_rate", "digit_rate", "odd_end_rate", "distinct_rate", "mean_line", "non_letter_rate",
)
# Features that speak against a document can only lower its score.
MONOTONE = {FEATURES.index(n): -1 for n in ("symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "odd_end_rate")}

# At most this many labelled documents are used for a fit.
FIT_ROWS = 20_000
# Share of good calibration documents that the threshold may reject.
MAX_GOOD_REJECTED = 0.002

_CODE_POINT = np.zeros(256, dtype=np.int64)
_CODE_POINT[[b for b in range(256) if b & 0xC0 != 0x80]] = 1
_KIND = np.zeros((5, 256), dtype=np.int64)
_KIND[0, list(SPACES)] = 1
_KIND[1, list(SYMBOLS)] = 1
_KIND[2, ord("A") : ord("Z") + 1] = 1
_KIND[3, ord("0") : ord("9") + 1] = 1
_KIND[4, [b for b in range(33, 128) if not chr(b).isalnum()]] = 1
_PLAIN_END = np.ones(256, dtype=bool)
_PLAIN_END[[b for b in range(128) if not (chr(b).isalnum() or chr(b) in ".,;:?'\")")]] = False


def repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words inside three-word windows that occur twice or more, and the number of distinct words."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(ids) < 4:
        return 0, len(numbers)
    # Pairs are numbered again, so that a window's key fits 64 bits for a text of any length.
    pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    key = pair[:-1] * len(numbers) + ids[2:]
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[which] > 1
    inside = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum()), len(numbers)


def statistics(text: bytes) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The five base counts and the trees' features of one text in UTF-8."""
    words = text.split()
    n = len(words)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = int(histogram @ _CODE_POINT)
    spaces, symbols, upper, digits, marks = (int(v) for v in _KIND @ histogram)
    chars = points - spaces
    seen: set[bytes] = set()
    lines = dup_lines = 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            lines += 1
            dup_lines += line in seen
            seen.add(line)
    repeats, distinct = repeat_words(words)
    odd = n - int(_PLAIN_END[np.fromiter((w[-1] for w in words), np.uint8, n)].sum())
    counts = (n, chars, symbols, dup_lines, repeats)
    per_word, per_char, per_line = 1 / max(n, 1), 1 / max(chars, 1), 1 / max(lines, 1)
    features = (
        float(np.log1p(n)), chars * per_word, symbols * per_char, dup_lines * per_line, repeats * per_word,
        upper * per_char, digits * per_char, odd * per_word, distinct * per_word, n * per_line, marks * per_char,
    )
    return counts, features


def _measured(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    both = [statistics(t or b"") for t in text.to_pylist()]
    counts = np.array([c for c, _ in both], dtype=np.int64).reshape(-1, 5)
    return counts, np.array([f for _, f in both], dtype=np.float64).reshape(-1, len(FEATURES))


def feature_column(text: Column) -> Column:
    """All tree features of a text as one array column."""

    @F.arrow_udf("array<double>")
    def features(t: pa.Array) -> pa.Array:
        return pa.array(list(_measured(t)[1]), pa.list_(pa.float64()))

    return features(text.cast("binary"))


@dataclass(frozen=True)
class Verdict:
    """Trees and the probability below which a document is rejected."""

    forest: boosting.Forest
    threshold: float


def learn(docs: DataFrame, labels: DataFrame | None, fit_rows: int = FIT_ROWS) -> Verdict | None:
    """Fit the trees on at most ``fit_rows`` labelled documents, those of the smallest id hashes, a row an id.

    Three quarters of the sample fit the trees, the rest sets the threshold: the largest one, up to
    a half, that rejects at most ``MAX_GOOD_REJECTED`` of the good ones.  Labels that are null or
    without a document are passed over.  Without labels of both kinds there is no model.
    """
    if labels is None or not {"doc_id", "quality"} <= set(labels.columns):
        return None
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    chosen = (
        usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    # An id with several rows teaches by one of them, so that no more rows come than labels were chosen.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("quality").alias("quality"))
        .select("doc_id", feature_column(F.col("text")).alias("x"), "quality")
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(-1, len(FEATURES))
    y = np.array([r["quality"] for r in rows], dtype=np.float64)
    calibration = np.arange(len(y)) % 4 == 3
    if min(y[~calibration].sum(), (1 - y[~calibration]).sum()) == 0:
        return None
    forest = boosting.fit(x[~calibration], y[~calibration], MONOTONE)
    good = forest.probability(x[calibration][y[calibration] == 1])
    threshold = min(0.5, float(np.quantile(good, MAX_GOOD_REJECTED, method="lower"))) if len(good) else 0.5
    return Verdict(forest, threshold)


def judged(docs: DataFrame, verdict: Verdict | None, into: str) -> DataFrame:
    """``docs`` with a struct column ``into``: the base counts, ``base_failed``, ``score``, ``kept``.

    A null or empty text has no words and fails the base rules; without a model the score is null
    and the base rules decide alone.  Every row is judged on its own text, so repeated rows get the
    same verdict; an empty table stays empty; other columns are passed on untouched.
    """
    schema = f"struct<{', '.join(f.replace(' ', ':') for f in STATISTICS.split(', '))}, base_failed:boolean, score:double, kept:boolean>"

    @F.arrow_udf(schema)
    def judge(text: pa.Array) -> pa.Array:
        counts, features = _measured(text)
        words, repeats = counts[:, 0], counts[:, 4]
        failed = (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)
        columns = [pa.array(counts[:, k]) for k in range(5)]
        if verdict is None:
            score, kept = pa.nulls(len(words), pa.float64()), ~failed
        else:
            p = verdict.forest.probability(features)
            score, kept = pa.array(p), ~failed & (p >= verdict.threshold)
        names = [f.split()[0] for f in STATISTICS.split(", ")] + ["base_failed", "score", "kept"]
        return pa.StructArray.from_arrays([*columns, pa.array(failed), score, pa.array(kept)], names=names)

    # Marked so that a filter on the result does not make Spark judge each text twice.
    return docs.withColumn(into, judge.asNondeterministic()(F.col("text").cast("binary")))


def quality(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """One row per document: id, base counts, ``base_failed``, ``kept`` and the trees' score."""
    rows = judged(docs.select("doc_id", "text"), learn(docs, labels), "judged")
    return rows.select("doc_id", "judged.*")


def keep_good(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    flag = fresh_name(docs, "judged")
    return judged(docs, learn(docs, labels), flag).where(F.col(flag)["kept"]).drop(flag)

"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are summed in the tasks and combined by language and bucket; the matrix of log probabilities,
whose size is the number of languages times ``BUCKETS``, travels with the scoring tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 1 << 15
LONGEST_GRAM = 3
SMOOTHING = 0.5
FOLDS = 5
UNKNOWN = "und"
# Values of the language column that are learned.
MOST_LANGUAGES = 200
# Texts whose counts are made and scored as one sparse matrix.
TEXTS = 64
# Code points hashed at once; blocks overlap by a gram, so a long text is counted whole.
BLOCK = 1 << 18
# Odd multipliers of the hash, one a place in the gram, and one a gram length.
PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
LENGTHS = (0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93)


def letters_only(text: str) -> np.ndarray:
    """Lower-case code points, every run of other characters a single space, a space at either end.

    Empty if there is no letter.
    """
    words = "".join(c if c.isalpha() else " " for c in text.lower()) if not text.isascii() else None
    if words is None:
        words = text.lower().translate(_ASCII)
    words = words.split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


_ASCII = {n: " " for n in range(128) if not chr(n).isalpha()}


def gram_keys(texts: Sequence[str | None], rows: np.ndarray) -> Iterator[np.ndarray]:
    """``row * BUCKETS + bucket`` of every 1- to 3-gram of the texts, in blocks; a text's row is given."""
    held, size = [], 0
    for text, row in zip(texts, rows.tolist()):
        points = letters_only(text) if text else np.empty(0, np.uint64)
        for at in range(0, len(points), BLOCK):
            # A block starts with the last code points of the one before, so that grams across are counted.
            lead = min(at, LONGEST_GRAM - 1)
            held.append((points[at - lead : at + BLOCK], lead, row))
            size += len(held[-1][0])
            if size >= BLOCK:
                yield from _keys(held)
                held, size = [], 0
    yield from _keys(held)


def _keys(parts: list[tuple[np.ndarray, int, int]]) -> Iterator[np.ndarray]:
    if not parts:
        return
    points = np.concatenate([p for p, _, _ in parts])
    sizes = np.array([len(p) for p, _, _ in parts])
    row = np.repeat(np.array([r for _, _, r in parts], np.int64), sizes)
    # Places count from the first code point that an earlier block has not counted.
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes + np.array([lead for _, lead, _ in parts]), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))
    for n in range(1, LONGEST_GRAM + 1):
        # A gram belongs to the block in which it ends.
        own = np.flatnonzero((left >= n) & (place + n > 0))
        mixed = np.full(len(own), LENGTHS[n - 1], dtype=np.uint64)
        for at in range(n):
            mixed ^= points[own + at] * np.uint64(PLACES[at])
            mixed *= np.uint64(LENGTHS[0])
        yield row[own] * BUCKETS + (mixed >> np.uint64(49)).astype(np.int64)


def sparse_counts(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of the grams of a few texts, as a sparse matrix by row; a text without letters has none."""
    total = np.zeros(len(texts) * BUCKETS, np.int64)
    for keys in gram_keys(texts, np.arange(len(texts))):
        total += np.bincount(keys, minlength=len(total))
    used = np.flatnonzero(total)
    return used // BUCKETS, used % BUCKETS, total[used]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and how often the text's grams fall into them; None without letters."""
    _, bucket, count = sparse_counts([text])
    return (bucket, count) if len(bucket) else None


@dataclass(frozen=True)
class Bayes:
    """``log_probability`` has a row a bucket and a column a language."""

    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_probability: np.ndarray

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text, ties to the first by name, and its posterior probability."""
        names, scores = [], []
        for at in range(0, len(texts), TEXTS):
            part = texts[at : at + TEXTS]
            found, best = np.zeros(len(part), bool), np.zeros(len(part), np.int64)
            probability = np.zeros(len(part))
            row, bucket, count = sparse_counts(part) if self.languages else (np.empty(0, np.int64),) * 3
            if len(row):
                first = np.flatnonzero(np.diff(row, prepend=-1))
                # The sparse counts times the matrix, summed by row.
                score = np.add.reduceat(self.log_probability[bucket] * count[:, None], first) + self.log_prior
                found[row[first]], best[row[first]] = True, score.argmax(1)
                probability[row[first]] = 1.0 / np.exp(score - score.max(1, keepdims=True)).sum(1)
            names += [self.languages[b] if f else UNKNOWN for f, b in zip(found, best)]
            scores += probability.tolist()
        return names, scores


def learn(docs: DataFrame, most_languages: int = MOST_LANGUAGES) -> Bayes:
    """Count all rows of ``docs`` (``text, lang``); rows without text or language are passed over.

    The ``most_languages`` values of ``lang`` with most rows, ties by name, are learned; a value beyond
    them is never predicted.  So the matrix, and what comes to the driver, is bounded whatever the
    column holds: one row a language and bucket at most.
    """
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    common = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages)
    known = sorted(r["lang"] for r in common.collect())
    place_of = {lang: n for n, lang in enumerate(known)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, documents = np.zeros(len(known) * BUCKETS, np.int64), np.zeros(len(known), np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            rows = np.array([place_of[lang] for lang in batch.column(1).to_pylist()], np.int64)
            for keys in gram_keys(texts, rows):
                grams += np.bincount(keys, minlength=len(grams))
            lettered = np.array([any(map(str.isalpha, t)) for t in texts], bool)
            documents += np.bincount(rows[lettered], minlength=len(known))
        used = np.flatnonzero(grams)
        lang = [*(known[n] for n in used // BUCKETS), *known]
        bucket = np.concatenate([used % BUCKETS, np.full(len(known), BUCKETS)])
        n = np.concatenate([grams[used], documents])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(bucket, pa.int32()), pa.array(n, pa.int64())], ["lang", "bucket", "n"])

    usable = usable.where(F.col("lang").isin(known))
    table = usable.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).where("n > 0").toArrow()
    names, buckets, counts = (table.column(c).to_pylist() for c in ("lang", "bucket", "n"))
    languages = tuple(sorted(set(names)))
    matrix = np.zeros((BUCKETS + 1, len(languages)))
    place = {lang: n for n, lang in enumerate(languages)}
    matrix[buckets, [place[n] for n in names]] = counts
    grams, documents = matrix[:BUCKETS], matrix[BUCKETS]
    log_probability = np.log(grams + SMOOTHING) - np.log(grams.sum(axis=0) + SMOOTHING * BUCKETS)
    return Bayes(languages, np.log(documents / documents.sum()) if languages else documents, log_probability)


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether a document is kept from learning; a null id is not held out, nor learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def identify(docs: DataFrame, model: Bayes) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row.

    A null text or one without letters is ``und`` with score 0, as is every text if nothing was
    learned.  Only the text is scored; repeated rows give repeated results, an empty table none.
    """

    @F.arrow_udf("struct<lang_pred:string, score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        names, scores = model.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    rows = docs.select("doc_id", predict.asNondeterministic()(F.col("text")).alias("p"))
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "p.lang_pred", "p.score")


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, then predict all."""
    return identify(docs, learn(docs.where(~held_out(F.col("doc_id")))))

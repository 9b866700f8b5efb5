"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two halves.  Two fingerprints that differ in at most three bits differ in
at most one bit within one of the halves, so each fingerprint is stored once under either half and
looks up that half's Hamming ball of radius one; every match is verified on all 64 bits.

Copies are reduced to distinct fingerprints first.  A half that more than ``BUCKET`` fingerprints
share is looked up by a longer key instead: the half together with a quarter of the other half, again
by balls of radius one (three bits in two quarters leave at most one in one of them).  A longer key
fixes 48 bits, so never more than 65,536 fingerprints share it, whatever the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.common import fixed, fresh_name
from stationflow.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# Fingerprints under one half beyond which the longer key is used.
BUCKET = 64
# Shingles whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a text in UTF-8; zero for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words))) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle_words, len(words))
    hash_of = xxhash.xxh64_intdigest
    total, votes = len(words) - width + 1, np.zeros(64, dtype=np.int64)
    for at in range(0, total, BLOCK):
        stop = min(at + BLOCK, total)
        spans = zip(starts[at:stop].tolist(), ends[at + width - 1 : stop + width - 1].tolist())
        hashes = np.fromiter((hash_of(joined[s:e], SEED) for s, e in spans), np.uint64, stop - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > total, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(t or b"", shingle_words) for t in texts.to_pylist()), pa.int64())

    return fingerprints.asNondeterministic()(text.cast("binary"))


def _ball(value: Column, bits: int) -> Column:
    """A value and all values that differ from it in one of its lowest ``bits`` bits."""
    return F.concat(F.array(value), F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: value.bitwiseXOR(_bit(i))))


def _bit(i: Column) -> Column:
    return F.element_at(F.array(*(F.lit(1 << k) for k in range(32))), i + 1)


def _half(fp: Column, which: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * which).bitwiseAND(F.lit((1 << 32) - 1))


def _quarter(half: Column, which: int) -> Column:
    return F.shiftrightunsigned(half, 16 * which).bitwiseAND(F.lit((1 << 16) - 1))


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """All pairs ``a, b`` of the distinct values in column ``fp`` with 1 to ``max_bits`` (3 at most) different bits.

    A pair can appear more than once.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with balls of radius one hold for at most 3 bits")
    fp = F.col("fp")
    entries = fingerprints.select(
        "fp", F.explode(F.array(*(F.struct(F.lit(h).alias("h"), _half(fp, h).alias("key"), _half(fp, 1 - h).alias("other")) for h in (0, 1)))).alias("e")
    ).select("fp", "e.*")
    crowded = entries.groupBy("h", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket)
    crowded = fixed(crowded.select("h", "key"), "crowded")

    # A pair whose halves differ in one bit is found from the side where that bit is not set.
    up = F.filter(_ball(F.col("key"), 32), lambda v: v >= F.col("key"))
    probes = entries.select("fp", "h", "other", F.explode(up).alias("key"))
    # Spark takes exploded rows for as few as the rows they come from and would broadcast the probes, 33 and
    # more a fingerprint.  So they are merged, and semi and anti joins leave it the crowded halves alone.
    lone = lambda rows, side: rows.join(crowded, ["h", "key"], "left_anti").select("h", "key", F.col("fp").alias(side))
    among = lambda rows: rows.join(crowded, ["h", "key"], "left_semi")

    different = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    close = different.between(1, max_bits)
    short = lone(entries, "b").join(lone(probes, "a").hint("merge"), ["h", "key"])
    quarters = lambda rows, side: among(rows).select(
        "h", "key", F.col("fp").alias(side),
        F.explode(F.array(*(F.struct(F.lit(q).alias("q"), _quarter(F.col("other"), q).alias("v")) for q in (0, 1)))).alias("e"),
    ).select("h", "key", side, "e.q", "e.v")
    asked = quarters(probes, "a").select("h", "key", "q", "a", F.explode(_ball(F.col("v"), 16)).alias("v"))
    long = quarters(entries, "b").join(asked.hint("merge"), ["h", "key", "q", "v"])
    return short.where(close).select("a", "b").unionByName(long.where(close).select("a", "b"))


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, bucket: int = BUCKET
) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed), ``component_id`` (smallest id reachable).

    Texts without words, null ones included, have fingerprint zero and are linked like any other.
    A null id is no candidate for a component's smallest id; a component of null ids only has a
    null ``component_id``.  Repeated rows give repeated result rows; an empty table gives none.
    """
    marked = fixed(docs.select("doc_id", fingerprint_column(F.col("text"), shingle_words).alias("fp")), "fingerprints")
    distinct = fixed(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    label = connected_components(links(distinct, max_bits, bucket))
    grouped = distinct.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = grouped.select("fp", "label").join(least, "label").select("fp", "component_id")
    # A fingerprint with very many copies is split by the adaptive skew join.
    return marked.join(by_fp, "fp", "left").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with their group's smallest id, with all their columns.

    Rows that repeat the kept id stay together, being one document.  Where one id has several texts,
    each row goes by the group of its own text.  Rows without an id are all kept, as there is no id to
    tell which of them to name.
    """
    dropped, print_, own = (fresh_name(docs, name) for name in ("dropped", "dropped_fp", "own_fp"))
    first = F.col("doc_id") == F.col("component_id")
    # Ids of which some row falls, and whether another row of theirs stays.
    groups = near_duplicates(docs, shingle_words, max_bits).where("doc_id is not null")
    ids = groups.groupBy("doc_id").agg(F.bool_or(first).alias("stays"), F.bool_or(~first).alias("falls"))
    ids = fixed(ids.where("falls").select(F.col("doc_id").alias(dropped), "stays"), "dropped")
    whole = docs.join(ids.select(dropped), docs["doc_id"] == F.col(dropped), "left_anti")
    split = ids.where("stays").select(dropped)
    if split.isEmpty():
        return whole
    fallen = groups.where(~first).join(split, F.col("doc_id") == F.col(dropped)).select(dropped, F.col("fp").alias(print_)).distinct()
    # Only the texts of such ids need their fingerprints again.
    rows = docs.join(split, docs["doc_id"] == F.col(dropped), "left_semi")
    rows = rows.withColumn(own, fingerprint_column(F.col("text"), shingle_words))
    rows = rows.join(fallen, (rows["doc_id"] == F.col(dropped)) & (F.col(own) == F.col(print_)), "left_anti")
    return whole.unionByName(rows.drop(own))

"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every document has a place in a fixed pseudo-random order.  A source whose target is 1.3 times its
size gives one full pass over its documents and a second pass over the first 30 % of that order.
The last pass is cut for each size level by itself, long documents first, so that what a level leaves
over is filled by shorter documents.
Runs of the order are blocks; a source's block quota is the number of blocks its passes draw.  The
tree halves the vector of quotas at random, exactly, until each output shard has its own quotas; a
source's permuted blocks are then dealt to the shards by these, so no block is drawn twice.

Texts are only counted and, once, moved to their shards.  All decisions are made on tables with one
row per source or per block of a source.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from stationflow.llm.common import fixed, fresh_name

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"

# The order has 63 bits, its first 12 are the cell: the finest block of a source is 1/4096 of it.
ORDER_BITS = 63
CELL_BITS = 12
# Shards hold about this many words, and there are at least LEAST_SHARDS.
SHARD_WORDS = 50_000_000
LEAST_SHARDS = 64
BLOCKS_PER_SHARD = 16
# Longer tables of blocks are joined without a broadcast mark.
BROADCAST_ROWS = 200_000
# Documents of one size level differ in length by less than this power of two.
LEVEL_BITS = 2


@dataclass(frozen=True)
class Share:
    """What one source gives: its words, its target, full passes, how far the last pass goes, and what fills it up.

    ``cuts`` has the end of the last pass for each size level, ``cut`` the furthest of them.
    """

    source: str | None
    words: int
    target: float
    passes: int
    rest: float
    cut: int = -1
    filler: int = -1
    cuts: tuple[int, ...] = ()


def targets(words: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> dict[str | None, float]:
    """Words wanted of each source: by weight, at most ``most`` times its words, the excess dealt out again.

    Sources take the weights in turn, by code point, null last.
    """
    names = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    total, capped = share * sum(words.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(weight[s] for s in free) if free else 0.0
        above = [s for s in free if weight[s] * level > most * words[s]]
        if not above:
            return {s: capped.get(s, weight[s] * level) for s in names}
        capped |= {s: float(most * words[s]) for s in above}


def split(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Quotas per shard (rows) and source (columns); each column sums to its quota.

    Each node of the tree deals its quotas to its two halves by one multivariate-hypergeometric
    draw whose random state depends only on the seed and the node.
    """
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def deal(low: int, high: int, own: np.ndarray) -> None:
        if high - low == 1:
            out[low] = own
            return
        middle = (low + high) // 2
        half = round(int(own.sum()) * (middle - low) / (high - low))
        draw = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(own, half, method="marginals")
        deal(low, middle, draw)
        deal(middle, high, own - draw)

    deal(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


def _literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from values that travel in the plan; marked for broadcast up to the row bound."""
    names = [f.strip().split(" ")[0] for f in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    made = spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{', '.join(f.strip().replace(' ', ':', 1) for f in schema.split(', '))}>>")))
    return F.broadcast(made) if len(rows) <= BROADCAST_ROWS else made


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _order(seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 64 - ORDER_BITS)


def _level(size: Column) -> Column:
    """Size level of a text with ``size`` words, by the bits of that number."""
    return F.floor((F.length(F.bin(size)) - 1) / LEVEL_BITS).cast("int")


def _cell(order: Column) -> Column:
    return F.shiftright(order, ORDER_BITS - CELL_BITS)


def shares(docs: DataFrame, seed: int = SEED) -> list[Share]:
    """The decisions for all sources, one entry each; only such rows come to the driver."""
    spark = docs.sparkSession
    # Texts are counted once; from here on a document is three numbers and its source.
    units = docs.select("source", _order(seed).alias("order"), _size(F.col("text")).alias("words"))
    units = fixed(units.withColumn("level", _level(F.col("words"))), "units")
    cells = fixed(units.groupBy("source", "level", _cell(F.col("order")).alias("cell")).agg(F.sum("words").alias("words")), "cells")
    of_level: dict[str | None, dict[int, int]] = {}
    for r in cells.groupBy("source", "level").agg(F.sum("words").alias("words")).collect():
        of_level.setdefault(r["source"], {})[r["level"]] = r["words"]
    words = {s: sum(levels.values()) for s, levels in of_level.items()}
    found = []
    for source, target in targets(words).items():
        passes = int(target // words[source]) if words[source] else 0
        found.append(Share(source, words[source], target, passes, target - passes * words[source]))
    need = {n: s.rest for n, s in enumerate(found) if s.rest > 0}
    if not need:
        return found
    cuts = {n: [-1] * (max(of_level[found[n].source]) + 1) for n in need}
    for level in sorted({v for n in need for v in of_level[found[n].source]}, reverse=True):
        # A level gives its part of what is left; the shorter levels must be able to give the rest.
        shorter = {n: sum(w for v, w in of_level[found[n].source].items() if v < level) for n in need}
        own = {n: of_level[found[n].source].get(level, 0) for n in need}
        wanted = [(n, found[n].source, need[n] * own[n] / (own[n] + shorter[n])) for n in need if own[n] and need[n] > 0]
        for r in _ends(spark, units, cells, level, wanted):
            n, ends = r["no"], [(r["cut"], r["below"])] + ([(r["next_cut"], r["above"])] if r["above"] is not None else [])
            outside = lambda e: max(0.0, e[1] - need[n], need[n] - e[1] - shorter[n])  # noqa: B023, E731
            cut, given = min(ends, key=lambda e: (outside(e), abs(e[1] - r["want"])))  # noqa: B023
            cuts[n][level], need[n] = cut, need[n] - given
    fillers = _fillers(spark, units, [(n, found[n].source, left, cuts[n]) for n, left in need.items() if left > 0])
    for n, own_cuts in cuts.items():
        found[n] = Share(**{**found[n].__dict__, "cut": max(own_cuts), "filler": fillers.get(n, -1), "cuts": tuple(own_cuts)})
    return found


def _ends(spark: SparkSession, units: DataFrame, cells: DataFrame, level: int, wanted: list[tuple[int, str | None, float]]) -> list:
    """For each source the last document of a level up to which its order holds the wanted words at most, and the one after."""
    if not wanted:
        return []
    asked = _literal(spark, wanted, "no int, asked string, want double")
    by_cell = W.partitionBy("no").orderBy("cell")
    # The cell in which the wanted words are reached; rounding may put them past the last one.
    ending = (
        cells.where(F.col("level") == level).join(asked, F.col("source").eqNullSafe(F.col("asked")))
        .withColumn("through", F.sum("words").over(by_cell))
        .withColumn("rank", F.when(F.col("through") > F.col("want"), F.col("cell")).otherwise((1 << CELL_BITS) + (1 << CELL_BITS) - F.col("cell")))
        .groupBy("no", "source", "want").agg(F.min_by("cell", "rank").alias("cell"), F.min_by(F.col("through") - F.col("words"), "rank").alias("before"))
    )
    ends = [(r["no"], r["source"], r["want"], r["cell"], r["before"]) for r in ending.collect()]
    ending = _literal(spark, ends, "no int, asked string, want double, cell long, before long")
    by_order = W.partitionBy("no").orderBy("order")
    fits = F.col("through") <= F.col("want")
    inside = (
        units.where(F.col("level") == level)
        .join(ending, F.col("source").eqNullSafe(F.col("asked")) & (_cell(F.col("order")) == F.col("cell")))
        .groupBy("no", "want", "cell", "before", "order").agg(F.sum("words").alias("words"))
        .withColumn("through", F.col("before") + F.sum("words").over(by_order))
        .groupBy("no", "want", "cell", "before").agg(
            F.max(F.when(fits, F.struct("order", "through"))).alias("last"), F.min(F.when(~fits, F.struct("order", "through"))).alias("next")
        )
    )
    none = F.shiftleft(F.col("cell"), ORDER_BITS - CELL_BITS) - 1
    return inside.select(
        "no", "want", F.coalesce("last.order", none).alias("cut"), F.coalesce("last.through", "before").alias("below"),
        F.col("next.order").alias("next_cut"), F.col("next.through").alias("above"),
    ).collect()


def _fillers(spark: SparkSession, units: DataFrame, left: list[tuple[int, str | None, float, list[int]]]) -> dict[int, int]:
    """For each source the untaken document, if any, that brings it nearest to its target."""
    if not left:
        return {}
    asked = _literal(spark, left, "no int, asked string, left double, cuts array<bigint>")
    open_ = (
        units.join(asked, F.col("source").eqNullSafe(F.col("asked")) & (F.col("words") > 0) & (F.col("words") < 2 * F.col("left")))
        .where(F.col("order") > F.get("cuts", F.col("level")))
        .groupBy("no", "left", "order").agg(F.sum("words").alias("words"))
        .where(F.col("words") < 2 * F.col("left"))
    )
    best = open_.groupBy("no").agg(F.min(F.struct(F.abs(F.col("words") - F.col("left")).alias("miss"), "order")).alias("best"))
    return {r["no"]: r["best"]["order"] for r in best.collect()}


def blocks(given: list[Share], shards: int | None = None, seed: int = SEED) -> tuple[list[int], list[tuple[int, int, list[int]]]]:
    """Block bits of each source, and for each source and block the shards of its passes, first pass first."""
    total = sum(s.target for s in given)
    shards = shards or max(LEAST_SHARDS, math.ceil(total / SHARD_WORDS))
    block_words = max(1.0, total / (shards * BLOCKS_PER_SHARD))
    bits = [min(CELL_BITS, max(0, math.ceil(math.log2(max(1.0, s.words / block_words))))) for s in given]
    draws = []
    for s, b in zip(given, bits):
        last = set(range((s.cut >> (ORDER_BITS - b)) + 1 if s.cut >= 0 else 0))
        last |= {s.filler >> (ORDER_BITS - b)} if s.filler >= 0 else set()
        draws.append([(p, k) for p in range(s.passes) for k in range(1 << b)] + [(s.passes, k) for k in sorted(last)])
    if not given:
        return bits, []
    quotas = split(np.array([len(d) for d in draws]), shards, seed)
    rows = []
    for n, (own, b) in enumerate(zip(draws, bits)):
        shard_of = np.empty(len(own), dtype=np.int64)
        shard_of[np.random.default_rng([seed, n]).permutation(len(own))] = np.repeat(np.arange(shards), quotas[:, n])
        by_block: dict[int, list[int]] = {k: [] for k in range(1 << b)}
        for (_, k), shard in zip(own, shard_of.tolist()):
            by_block[k].append(shard)
        rows += [(n, k, found) for k, found in by_block.items()]
    return bits, rows


def drawn(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with a struct column ``mix``: ``size, source_size, target, copies, shards, place``.

    ``size`` counts a text's words (null: 0); ``copies`` is 0 to 2, ``shards`` has one entry a copy.
    An empty source or an empty table has target zero and gives nothing; rows that are equal in id
    and text share one place in the order and are taken or left together.  The order depends on
    seed, id and text only, so reruns agree.
    """
    spark = docs.sparkSession
    given = shares(docs, seed)
    bits, dealt = blocks(given, shards, seed)
    names = {n: fresh_name(docs, f"mix_{n}") for n in ("no", "source", "words", "target", "passes", "cut", "filler", "cuts", "bits", "order", "block", "of", "at", "deal")}
    c = {n: F.col(f"`{name}`") for n, name in names.items()}
    recipe = _literal(
        spark,
        [(n, s.source, s.words, s.target, s.passes, s.cut, s.filler, list(s.cuts), b) for n, (s, b) in enumerate(zip(given, bits))],
        ", ".join(f"{names[n]} {t}" for n, t in (("no", "int"), ("source", "string"), ("words", "long"), ("target", "double"), ("passes", "int"), ("cut", "long"), ("filler", "long"), ("cuts", "array<bigint>"), ("bits", "int"))),
    )
    table = _literal(spark, dealt, f"{names['of']} int, {names['at']} long, {names['deal']} array<int>")
    placed = docs.withColumn(names["order"], _order(seed))
    rows = placed.join(recipe, placed["source"].eqNullSafe(c["source"]), "left")
    # shiftright takes a fixed distance, a division by a power of two any.
    block = F.expr(f"`{names['order']}` div shiftleft(1L, {ORDER_BITS} - `{names['bits']}`)")
    rows = rows.withColumn(names["block"], F.when(c["bits"] == 0, F.lit(0)).otherwise(block).cast("long"))
    rows = rows.join(table, (c["no"] == c["of"]) & (c["block"] == c["at"]), "left")
    size = _size(F.col("text"))
    last = F.coalesce(F.get(c["cuts"], _level(size)), F.lit(-1))
    copies = c["passes"] + ((c["order"] <= last) | (c["order"] == c["filler"])).cast("int")
    mix = F.struct(
        size.alias("size"),
        c["words"].alias("source_size"),
        c["target"].alias("target"),
        copies.alias("copies"),
        F.slice(F.coalesce(c["deal"], F.array().cast("array<int>")), F.lit(1), copies).alias("shards"),
        c["order"].alias("place"),
    )
    into = fresh_name(docs, "mix")
    return rows.select(*(F.col(f"`{n}`") for n in docs.columns), mix.alias(into))


def mix(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mixed documents, a row for each copy, in shuffled order within their shards."""
    into, shard = fresh_name(docs, "mix"), fresh_name(docs, "shard")
    rows = drawn(docs, shards, seed)
    rows = rows.select(*(F.col(f"`{n}`") for n in docs.columns), F.posexplode(F.col(into)["shards"]).alias("mix_pass", shard), F.col(into)["place"].alias(into))
    rows = rows.repartition(F.col(shard)).sortWithinPartitions(shard, F.xxhash64(F.lit(seed), shard, "mix_pass", into))
    return rows.select(*(F.col(f"`{n}`") for n in docs.columns))


def mixed(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, the words the mix takes, the shards of its copies."""
    rows = drawn(docs.select("doc_id", "text", "source"))
    return rows.select(
        "doc_id", "mix.size", "mix.source_size", "mix.target",
        (F.col("mix.size") * F.size("mix.shards")).alias("taken"),
        F.array_join(F.col("mix.shards").cast("array<string>"), ",").alias("shards"),
    )

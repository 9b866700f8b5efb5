"""Nearest neighbours by inner product: low-dimensional stable projections in a kd-tree.

Vectors get one more component that makes all norms equal, so that the largest inner product is the
smallest distance.  Gaussian (2-stable) projections take them to ``PROJECTED`` dimensions, where the
squared distance of two points is their true one times a chi-square variable.  A kd-tree over the
projections cuts all rows into cells.  Within a cell a query takes its projected neighbours in
order and verifies their true distance until the next one is so far off that, by the chi-square
test, a nearer neighbour than those found is unlikely.

A query visits the cells nearest to it first; the distance reached there says, by the same test,
which other cells can still hold a neighbour, and those are visited in a second round.  So the work
is a set of cell groups joined by key, and no query meets a cell that the test rules out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from stationflow.llm.common import fixed

K = 20
QUERY_EVERY = 20
PROJECTED = 8
# Probability with which the chi-square test keeps a neighbour as far off as the last one found.
CONFIDENCE = 0.97
SEED = 11
# The tree's upper levels are fitted on the projections of at most this many vectors, by smallest hash.
TREE_SAMPLE = 50_000
# Cells have about this many rows, and there are between these many of them; a cell with more rows
# than SLICE_ROWS is dealt to several groups, each of which a query visits.
CELL_ROWS = 16_384
LEAST_CELLS, MOST_CELLS = 64, 4_096
SLICE_ROWS = 65_536
FIRST_CELLS = 2
# Projected neighbours verified between two tests.
STEP = 512


def chi_square_quantile(p: float, degrees: int) -> float:
    """Quantile for an even number of degrees, where the distribution function is a finite sum."""
    if degrees % 2:
        raise ValueError("an even number of projections is needed")
    below = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))
    low, high = 0.0, 100.0 * degrees
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


@dataclass(frozen=True)
class Tree:
    """Upper levels of the kd-tree: a full binary tree of splits, numbered by level."""

    axis: np.ndarray
    cut: np.ndarray
    levels: int

    @classmethod
    def fit(cls, points: np.ndarray, levels: int) -> Tree:
        """Median splits along the widest axis of the sample."""
        axis, cut = np.zeros((1 << levels) - 1, dtype=np.int64), np.zeros((1 << levels) - 1)
        members = {0: np.arange(len(points))}
        for n in range((1 << levels) - 1):
            own = members.pop(n)
            if len(own):
                values = points[own]
                axis[n] = int(np.argmax(values.max(axis=0) - values.min(axis=0)))
                cut[n] = np.median(values[:, axis[n]])
            low = points[own, axis[n]] <= cut[n]
            members[2 * n + 1], members[2 * n + 2] = own[low], own[~low]
        return cls(axis, cut, levels)

    def cell(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.levels):
            at = 2 * at + 1 + (points[np.arange(len(points)), self.axis[at]] > self.cut[at])
        return at - ((1 << self.levels) - 1)


def usable(vectors: DataFrame, id_name: str, vector_name: str) -> DataFrame:
    """``vec_id, v`` of the rows that take part, repeated rows once.

    Left out are null ids, vectors that are null, zero or hold a null or non-finite component, and
    vectors of another length than the commonest one (of equally common ones, the longest).
    """
    v = F.col(vector_name).cast("array<double>")
    rows = vectors.select(F.col(id_name).cast("long").alias("vec_id"), v.alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    whole = F.coalesce(F.forall("v", finite), F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.where(F.col("vec_id").isNotNull() & whole)
    size = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return rows.where(F.size("v") == (size["size"] if size else 0))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64, copy=False)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel()))


def _nearest(
    data: np.ndarray, projected: np.ndarray, counts: np.ndarray, query: np.ndarray, query_projected: np.ndarray,
    wanted: int, factor: float, flat: float, bound: float,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Rows of the nearest vectors that cover ``wanted`` ids, their inner products, and the distance reached.

    ``flat`` is the sum of the query's and the common squared norm: a squared distance is ``flat``
    less twice the inner product.  ``bound`` is a distance within which enough ids are known to lie;
    vectors farther off are left out.  With too few ids the distance reached stays at the bound.
    """
    away = ((projected - query_projected) ** 2).sum(axis=1)
    order = np.nonzero(away <= factor * bound)[0]
    order = order[np.argsort(away[order], kind="stable")]
    best, score, reached = np.empty(0, dtype=np.int64), np.empty(0), bound
    for at in range(0, len(order), STEP):
        if away[order[at]] > factor * reached:
            break
        rows = order[at : at + STEP]
        product = (data[rows] * query).sum(axis=1)
        # A little more than the bound, so that rounding leaves no tie out.
        near = flat - 2 * product <= reached * (1 + 1e-9) + 1e-9
        best, score = np.append(best, rows[near]), np.append(score, product[near])
        kept = np.argsort(-score, kind="stable")
        covered = np.cumsum(counts[best[kept]])
        if len(covered) and covered[-1] >= wanted:
            last = int(np.searchsorted(covered, wanted))
            reached = min(reached, max(0.0, flat - 2 * score[kept[last]]))
            # Vectors that tie with the last one stay, as ids decide between them.
            kept = kept[score[kept] >= score[kept[last]]]
        best, score = best[kept], score[kept]
    return best, score, reached


def _visit(index: DataFrame, probes: DataFrame, width: int, wanted: int, factor: float, common: float) -> DataFrame:
    """``q, reached, found``: for each query and visited cell, candidates as structs of ``far`` (negative product) and ``vec_id``."""
    schema = "q array<double>, reached double, found array<struct<far:double,vec_id:long>>"
    found_type = pa.list_(pa.struct([("far", pa.float64()), ("vec_id", pa.int64())]))

    def search(points: pa.Table, queries: pa.Table) -> pa.Table:
        out_reached, out_found = [], []
        asked = _matrix(queries.column("v"), width)
        if points.num_rows and queries.num_rows:
            data, projected = _matrix(points.column("v"), width), _matrix(points.column("p"), PROJECTED)
            ids = points.column("ids").to_pylist()
            counts = np.array([len(i) for i in ids])
            bounds = queries.column("reached").to_pylist()
            for v, p, bound in zip(asked, _matrix(queries.column("p"), PROJECTED), bounds):
                rows, scores, reached = _nearest(data, projected, counts, v, p, wanted, factor, float(v @ v) + common, bound)
                near = sorted((-float(s), i) for r, s in zip(rows.tolist(), scores) for i in ids[r])[:wanted]
                out_found.append([{"far": far, "vec_id": i} for far, i in near])
                out_reached.append(reached)
        else:
            asked = asked[:0]
        return pa.Table.from_arrays(
            [_lists(asked), pa.array(out_reached, pa.float64()), pa.array(out_found, found_type)], names=["q", "reached", "found"]
        )

    return index.groupBy("cell", "slice").cogroup(probes.groupBy("cell", "slice")).applyInArrow(search, schema)


def _empty(vectors: DataFrame) -> DataFrame:
    return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def search(
    vectors: DataFrame,
    query_every: int = QUERY_EVERY,
    k: int = K,
    id_name: str = "vec_id",
    vector_name: str = "embedding",
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows of each row whose id is divisible by ``query_every``.

    Equal vectors are indexed once, with the ``k + 1`` smallest ids, which is all that a result can
    need of them; the same holds for equal queries.  Scores are inner products of the original
    vectors in double precision, ties go to the smaller id.  An empty table gives no rows.
    """
    wanted = k + 1
    rows = fixed(usable(vectors, id_name, vector_name).distinct(), "vectors")
    total, longest = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    if not total:
        return _empty(vectors)
    width = rows.select(F.size("v")).first()[0]
    common = float(longest)
    rng = np.random.default_rng(SEED)
    projection = rng.standard_normal((width + 1, PROJECTED))

    # Of equal vectors, each task passes on the smallest ids only.
    ranked = rows.withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= wanted)
    equal = ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("v"), width)
            rest = np.sqrt(np.maximum(0.0, common - (v * v).sum(axis=1)))
            p = np.column_stack([v, rest]) @ projection
            yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("ids"), _lists(p)], ["v", "ids", "p"])

    points = fixed(equal.mapInArrow(project, "v array<double>, ids array<long>, p array<double>"), "points")
    count = points.count()
    sample = points.select("p").orderBy(F.xxhash64("p"), "p").limit(TREE_SAMPLE).toArrow()
    cells = min(MOST_CELLS, max(LEAST_CELLS, count // CELL_ROWS), max(1, sample.num_rows // 8))
    tree = Tree.fit(_matrix(sample.column("p"), PROJECTED), int(math.log2(cells)))
    slices = max(1, -(-count // ((1 << tree.levels) * SLICE_ROWS)))

    @F.arrow_udf("int")
    def cell_of(p: pa.Array) -> pa.Array:
        return pa.array(tree.cell(_matrix(p, PROJECTED)), pa.int32())

    placed = points.withColumn("cell", cell_of.asNondeterministic()(F.col("p")))
    index = fixed(placed.withColumn("slice", F.pmod(F.xxhash64("v"), F.lit(slices)).cast("int")), "cells")

    # The box of each cell in projected space: a row a cell.
    axes = range(PROJECTED)
    box = index.groupBy("cell").agg(*(f(F.col("p")[a]).alias(f"{n}{a}") for a in axes for n, f in (("low", F.min), ("high", F.max)))).collect()
    numbers = np.array([r["cell"] for r in box], dtype=np.int64)
    low = np.array([[r[f"low{a}"] for a in axes] for r in box])
    high = np.array([[r[f"high{a}"] for a in axes] for r in box])

    def boxes_away(p: np.ndarray) -> np.ndarray:
        outside = np.maximum(0.0, np.maximum(low - p, p - high))
        return (outside * outside).sum(axis=1)

    factor = chi_square_quantile(confidence, PROJECTED)
    asking = rows.where(F.col("vec_id") % query_every == 0)
    asked_once = fixed(asking.select("v").distinct(), "queries")

    def plan(second: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = _matrix(batch.column("v"), width)
                # A query has nothing in the added component.
                p = v @ projection[:width]
                reached = batch.column("reached").to_pylist() if second else [math.inf] * len(v)
                whose, chosen = [], []
                for n, (point, r) in enumerate(zip(p, reached)):
                    away = boxes_away(point)
                    order = np.argsort(away, kind="stable")
                    own = order[FIRST_CELLS:][away[order[FIRST_CELLS:]] <= factor * r] if second else order[:FIRST_CELLS]
                    whose += [n] * len(own)
                    chosen += numbers[own].tolist()
                who = pa.array(whose, pa.int64())
                columns = [_lists(v), _lists(p), pa.array(reached, pa.float64())]
                yield pa.RecordBatch.from_arrays([*(c.take(who) for c in columns), pa.array(chosen, pa.int32())], ["v", "p", "reached", "cell"])

        return cells_of

    def probes(queries: DataFrame, second: bool) -> DataFrame:
        visits = queries.mapInArrow(plan(second), "v array<double>, p array<double>, reached double, cell int")
        return visits.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    first = fixed(_visit(index, probes(asked_once, False), width, wanted, factor, common), "first-round")
    # The best distance that one of the first cells reached alone bounds the true one from above.
    reached = first.groupBy(F.col("q").alias("v")).agg(F.min("reached").alias("reached"))
    second = _visit(index, probes(reached, True), width, wanted, factor, common)
    every = first.select("q", "found").unionByName(second.select("q", "found"))
    merged = every.groupBy("q").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, wanted).alias("found"))

    own = asking.join(merged, asking["v"] == merged["q"]).select("vec_id", "found")
    others = F.slice(F.filter("found", lambda c: c["vec_id"] != F.col("vec_id")), 1, k)
    ranked = own.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("rank", "c"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("c.vec_id").alias("vec_id"), (-F.col("c.far")).alias("score"))


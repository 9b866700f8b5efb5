"""SentencePiece encoding and decoding with a relational lattice.

Documents are cut into units that no piece crosses (a word with its leading spaces, a line end).
Each distinct unit is encoded once: its substrings up to the longest piece are exploded and joined
to the piece table, the matches are grouped by unit as lattice edges, and a higher-order
``aggregate`` folds them into a segmentation.  A unigram model is folded by Viterbi.  A BPE model is
folded by its merge order, since its scores are ranks and the best sum of ranks is not what the
model's own merges give; both folds run over the same lattice.

Encodings go back to the documents without moving texts or ids: the most frequent units, a bounded
number, are encoded first and travel with the tasks that cut the texts, each of which writes the ids of
its documents into a file, with gaps for other units.  Those, once a file, are dealt by unit, encoded
there once for all files, and their ids come back packed by file.
"""

from __future__ import annotations

import gc
import re
import zlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationflow.llm.common import fixed, fresh_name, input_bytes
from stationflow.llm.token_files import Runs, in_batches, utf8
from stationflow.session import scratch
from stationflow.sources.files import filesystem_of, open_uri

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, BYTE, USER_DEFINED = 1, 6, 4
# A unit's segmentation is a 64-bit set of its cuts; longer units go through the library itself.
LONGEST_UNIT = 61
PLACES = 64
UNKNOWN_PENALTY = 10.0
# About so many units are shipped with the tasks that look them up; they have at most LONGEST_UNIT characters.
HEAD_UNITS = 400_000
# Of the units with the head's smallest count, a share in so many parts is taken by hash.
TIE_PARTS = 1 << 20
# Signs put between units while texts are cut; one that no text of a batch holds is taken.
SEPARATORS = "\x1e\x1f\x1d\x1c\x01\x02\x03"
# Bytes of texts cut together, whose distinct units are counted or looked up once.
WORK_BYTES = 8 << 20
# Sequences put together by one call, which needs some 24 bytes an element beside the result.
TAKEN = 1 << 17
# Input bytes whose units one task encodes, and the most tasks.
TASK_BYTES = 4 << 20
MOST_TASKS = 1 << 16
# How hard the unit files, the largest thing kept on disk, are compressed.
FILE_LEVEL = 3
# Places of units that a task holds before it packs their ids by file.
HELD_PLACES = 1 << 20
# Edges are grouped by sorting, which takes bounded memory and here less time than a hash of lists.
GROUPING = "spark.sql.execution.useObjectHashAggregateExec"


@dataclass(frozen=True)
class Model:
    """The piece table of a SentencePiece model file."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]
    kind: int
    dummy_prefix: bool
    unknown: int
    proto: bytes

    @classmethod
    def load(cls, path: str) -> Model:
        with open(path, "rb") as file:
            return cls.parse(file.read())

    @classmethod
    def parse(cls, data: bytes) -> Model:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(data)
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that change nothing but spaces can be encoded here")
        if proto.trainer_spec.model_type not in (UNIGRAM, BPE) or any(p.type == USER_DEFINED for p in proto.pieces):
            raise ValueError("only unigram and BPE models without user-defined pieces can be encoded here")
        own = cls(
            tuple(p.piece for p in proto.pieces),
            tuple(p.score for p in proto.pieces),
            tuple(p.type for p in proto.pieces),
            proto.trainer_spec.model_type,
            rules.add_dummy_prefix,
            next((n for n, p in enumerate(proto.pieces) if p.type == 2), 0),
            b"",
        )
        rules.add_dummy_prefix = False
        object.__setattr__(own, "proto", proto.SerializeToString())
        if any(SPACE in p.lstrip(SPACE) for p in own.ids):
            raise ValueError("a piece goes on after a space, so words cannot be encoded one by one")
        return own

    @cached_property
    def ids(self) -> dict[str, int]:
        return {p: n for n, (p, t) in enumerate(zip(self.pieces, self.types)) if t == NORMAL}

    @cached_property
    def cost(self) -> dict[str, float]:
        """Cost of each piece: its negative score, or the rank of its score in a BPE model."""
        if self.kind == UNIGRAM:
            return {p: -self.scores[n] for p, n in self.ids.items()}
        rank = {score: n for n, score in enumerate(sorted({self.scores[n] for n in self.ids.values()}, reverse=True))}
        return {p: float(rank[self.scores[n]]) for p, n in self.ids.items()}

    @cached_property
    def out_of_turn(self) -> set[str]:
        """Pieces that their own characters do not lead to when merges are tried once, in order of cost.

        Merges inside a stretch of text depend on nothing outside it while its ends stand.  So if a
        piece can be merged at its turn when it stands alone, it can be merged at its turn wherever
        it can be merged at all, and one pass over a unit's edges in order of cost finds all merges.
        """
        found = set()
        for piece, own in self.cost.items():
            parts = [(self.cost[piece[a:b]], a, b) for a in range(len(piece)) for b in range(a + 2, len(piece) + 1) if piece[a:b] in self.cost]
            cuts = set(range(len(piece) + 1))
            for _, a, b in sorted(parts):
                inner = [c for c in cuts if a < c < b]
                ready = a in cuts and b in cuts and len(inner) == 1
                if (a, b) == (0, len(piece)):
                    if not ready:
                        found.add(piece)
                    break
                if ready:
                    cuts.remove(inner[0])
        return found

    @cached_property
    def byte_ids(self) -> dict[int, int]:
        return {int(p[3:5], 16): n for n, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}

    @cached_property
    def unit_pattern(self) -> re.Pattern[str]:
        """Units; a line end is one of its own where no piece holds it."""
        ends = "" if any("\n" in p for p in self.ids) else "\n"
        return re.compile(f" *[^ {ends}]+| +" + (f"|{ends}" if ends else ""))

    @property
    def id_type(self) -> str:
        """Little-endian ids; the type's largest value marks a gap."""
        return "<u2" if len(self.pieces) < 0xFFFF else "<u4"

    @cached_property
    def library(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.proto)

    def units(self, text: str) -> list[str]:
        """The units of a text, with plain spaces; the model's own sign for a space counts as one."""
        if SPACE in text:
            text = text.replace(SPACE, " ")
        return self.unit_pattern.findall(" " + text if text and self.dummy_prefix else text)

    def units_of(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The units of all texts one after the other, and how many each text has; a null has none."""
        texts = utf8(texts).fill_null("")
        sign = next((s for s in SEPARATORS if not pc.any(pc.match_substring(texts, s)).as_py()), None)
        if sign is None:
            own = [self.units(t) for t in texts.to_pylist()]
            return pa.array([u for us in own for u in us], pa.string()).dictionary_encode(), np.array([len(us) for us in own], np.int64)
        texts = pc.replace_substring(texts, SPACE, " ")
        if self.dummy_prefix:
            texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        ends = "" if any("\n" in p for p in self.ids) else "\n"
        # A unit starts with the spaces before a word; a line end is one of its own.
        texts = pc.replace_substring_regex(texts, f"([^ {ends}]) ", f"\\1{sign} ")
        if ends:
            texts = pc.replace_substring(texts, ends, sign + ends + sign)
        cut = pc.split_pattern(texts, sign)
        flat, whose = cut.flatten(), np.asarray(pc.list_parent_indices(cut))
        real = pc.not_equal(flat, "")
        return flat.filter(real).dictionary_encode(), np.bincount(whose[np.asarray(real)], minlength=len(texts)).astype(np.int64)

    def segment_ids(self, unit: str, cuts: int) -> list[int]:
        """Ids of a unit cut at the set bits; characters outside the table become bytes or unknown."""
        found, at, unit = [], 0, unit.replace(" ", SPACE)
        for end in range(1, len(unit) + 1):
            if cuts >> end & 1:
                piece = unit[at:end]
                own = self.ids.get(piece)
                if own is not None:
                    found.append(own)
                elif self.byte_ids:
                    found += [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
                else:
                    found.append(self.unknown)
                at = end
        return found

    @cached_property
    def piece_bytes(self) -> list[bytes]:
        """What each id stands for in a text: a byte, the characters of a piece, or nothing."""

        def own(piece: str, kind: int) -> bytes:
            if kind == BYTE:
                return bytes([int(piece[3:5], 16)])
            return piece.replace(SPACE, " ").encode() if kind == NORMAL else b""

        return [own(p, t) for p, t in zip(self.pieces, self.types)]

    @cached_property
    def piece_runs(self) -> Runs:
        """The same as one array of bytes."""
        parts = self.piece_bytes
        return Runs(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts], np.int64))

    def decoded(self, ids: np.ndarray) -> bytes:
        """The text of an id sequence in UTF-8, without the space that encoding put in front."""
        text = taken(self.piece_runs, ids).flat.tobytes()
        return text[1:] if self.dummy_prefix and text.startswith(b" ") else text


def taken(runs: Runs, which: np.ndarray) -> Runs:
    """``runs.take(which)`` with little memory beside the result."""
    sizes = runs.sizes[which]
    flat, at = np.empty(int(sizes.sum()), runs.flat.dtype), 0
    for first in range(0, len(which), TAKEN):
        own = runs.take(which[first : first + TAKEN]).flat
        flat[at : at + len(own)] = own
        at += len(own)
    return Runs(flat, sizes)


def give_back() -> None:
    """Return what Arrow keeps of a task's memory, some 170 MB: the worker lives on and other stages run beside it."""
    pa.default_memory_pool().release_unused()


def count_units(docs: DataFrame, model: Model) -> DataFrame:
    """``unit, n`` for every distinct unit of all texts, counted in the tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, WORK_BYTES):
            units, _ = model.units_of(batch.column(0))
            counts = np.bincount(units.indices.to_numpy(zero_copy_only=False), minlength=len(units.dictionary))
            yield pa.RecordBatch.from_arrays([units.dictionary, pa.array(counts, pa.int64())], ["unit", "n"])
        give_back()

    texts = docs.where(F.col("text").isNotNull()).select("text")
    partial = texts.mapInArrow(count, "unit string, n long")
    return partial.repartition(unit_tasks(docs), "unit").groupBy("unit").agg(F.sum("n").alias("n"))


def unit_tasks(docs: DataFrame) -> int:
    """Tasks that the units of ``docs`` are dealt to."""
    return min(MOST_TASKS, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_bytes(docs) // TASK_BYTES))


def common_units(counts: DataFrame, most: int) -> DataFrame:
    """About the ``most`` most frequent units of at most LONGEST_UNIT characters, without sorting them.

    All units above a count are taken, and of those with that count a share by hash.  The driver gets
    how many units have each count; there are at most about as many counts as the root of all words.
    """
    short = counts.where(F.length("unit") <= LONGEST_UNIT)
    sizes = short.groupBy("n").agg(F.count("*").alias("units")).toArrow().sort_by([("n", "descending")])
    n, units = (np.asarray(sizes.column(name)) for name in ("n", "units"))
    upto = np.cumsum(units)
    last = int(np.searchsorted(upto, most, "right"))
    if last == len(n):
        return short
    room = most - int(upto[last] - units[last])
    tied = (F.col("n") == int(n[last])) & (F.pmod(F.xxhash64("unit"), F.lit(TIE_PARTS)) < room * TIE_PARTS // int(units[last]))
    return short.where((F.col("n") > int(n[last])) | tied)


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def piece_table(spark: SparkSession, model: Model, shortest: int) -> DataFrame:
    """``piece, cost, late`` of the pieces with at least ``shortest`` characters; as large as the model, so broadcast."""
    late = model.out_of_turn if model.kind == BPE else set()
    rows = [(p, model.cost[p], p in late) for p in model.ids if len(p) >= shortest]
    return F.broadcast(spark.createDataFrame(rows, "piece string, cost double, late boolean"))


def lattice(units: DataFrame, model: Model, shortest: int) -> DataFrame:
    """``units`` (``unit`` and one more column) with an array ``edges`` per unit: cost, first and last place of each piece found.

    The edges of a BPE model are packed into one number each, which sorts by cost, then place.
    Substrings from ``shortest`` characters up to the longest piece are joined to the piece table.
    Units are already dealt by unit, so nothing is shuffled.  Each unit keeps its first substring,
    matched or not, so that a unit without matches, or of a length that is not cut, keeps its row.
    """
    longest = max(map(len, model.ids), default=1)
    length = F.length("unit")
    fits = length.between(shortest, LONGEST_UNIT)
    form = F.translate("unit", " ", SPACE).alias("form")
    own = _beside_unit(units)
    starts = units.select("unit", own, form, F.explode(F.when(fits, F.sequence(F.lit(0), length - shortest)).otherwise(F.array(F.lit(0)))).alias("first"))
    until = F.when(fits, F.least(length, F.col("first") + longest)).otherwise(shortest)
    spans = starts.select("*", F.explode(F.sequence(F.col("first") + shortest, until)).alias("last"))
    # The first substring alone carries the unit's other column.
    opening = (F.col("first") == 0) & (F.col("last") == shortest)
    piece = F.substring("form", F.col("first") + 1, F.col("last") - F.col("first")).alias("piece")
    parts = spans.select("unit", F.when(opening, F.col(own)).alias(own), "first", "last", piece)
    found = parts.join(piece_table(units.sparkSession, model, shortest), "piece", "left")
    found = found.where(F.col("cost").isNotNull() | opening)
    packed = F.col("cost").cast("long") * PLACES * PLACES + F.col("first") * PLACES + F.col("last")
    edge = packed if model.kind == BPE else F.struct("cost", "first", "last")
    return found.groupBy("unit").agg(
        F.first(own, ignorenulls=True).alias(own),
        F.collect_list(F.when(F.col("cost").isNotNull(), edge)).alias("edges"),
        F.coalesce(F.bool_or("late"), F.lit(False)).alias("late"),
    )


def _beside_unit(units: DataFrame) -> str:
    """The column that goes with each unit: its count ``n``, or its places ``keys``."""
    return next(c for c in units.columns if c != "unit")


def _ends(edge: Column) -> tuple[Column, Column]:
    """A packed edge's two ends as a set of cuts, and the cuts between them."""
    first = F.call_function("shiftright", edge, F.lit(6)).bitwiseAND(F.lit(PLACES - 1)).cast("int")
    last = edge.bitwiseAND(F.lit(PLACES - 1)).cast("int")
    return _bit(first).bitwiseOR(_bit(last)), _bit(last) - _bit(first + 1)


def merge_fold(edges: DataFrame) -> DataFrame:
    """Each unit with the ``cuts`` of a BPE model: those that are left when all merges are done.

    A merge needs two neighbouring segments that make a piece; the cheapest goes first, the leftmost
    of equal ones.  One pass over the sorted edges does that, unless a unit holds a piece that can
    come up after its turn; such units look for the cheapest merge again after every merge.
    """
    # Units beyond the set's size are not cut here; the bound only keeps the shift in range.
    everywhere = _bit(F.least(F.length("unit"), F.lit(LONGEST_UNIT)) + 1) - 1

    def merged(cuts: Column, edge: Column) -> Column:
        ends, inner = _ends(edge)
        fits = (F.bit_count(cuts.bitwiseAND(inner)) == 1) & (cuts.bitwiseAND(ends) == ends)
        return F.when(fits, cuts.bitwiseAND(F.bitwise_not(inner))).otherwise(cuts)

    def searched(marked: Column) -> Column:
        def again(cuts: Column, _: Column) -> Column:
            joins = F.filter(marked, lambda e: (F.bit_count(cuts.bitwiseAND(e["inner"])) == 1) & (cuts.bitwiseAND(e["ends"]) == e["ends"]))
            return cuts.bitwiseAND(F.bitwise_not(F.coalesce(F.try_element_at(joins, F.lit(1))["inner"], F.lit(0).cast("long"))))

        return F.aggregate(F.sequence(F.lit(1), F.length("unit")), everywhere, again)

    marked = F.transform(F.sort_array("edges"), lambda e: F.struct(_ends(e)[0].alias("ends"), _ends(e)[1].alias("inner")))
    late = F.element_at(F.transform(F.array(marked), searched), 1)
    in_turn = F.aggregate(F.sort_array("edges"), everywhere, merged)
    return edges.select("unit", _beside_unit(edges), F.when(F.col("late"), late).otherwise(in_turn).alias("cuts"))


def viterbi_fold(edges: DataFrame, model: Model) -> DataFrame:
    """Each unit with the ``cuts`` of a unigram model: the segmentation with the best sum of scores.

    The fold goes over the end places; its state holds, for every place passed, the best cost of
    getting there and the cuts on the way.  A character outside the table costs more than any piece.
    """
    unknown = float(-min((model.scores[n] for n in model.ids.values()), default=0.0) + UNKNOWN_PENALTY)

    def step(best: Column, last: Column) -> Column:
        own = F.filter("edges", lambda e: e["last"] == last)
        reach = lambda first, cost: F.struct(
            (F.get(best, first)["cost"] + cost).alias("cost"), F.get(best, first)["cuts"].bitwiseOR(_bit(last)).alias("cuts")
        )
        known = F.exists(own, lambda e: e["first"] == last - 1)
        single = F.when(~known, F.array(reach(last - 1, F.lit(unknown)))).otherwise(F.array())
        ways = F.concat(F.transform(own, lambda e: reach(e["first"], e["cost"])), single)
        return F.concat(best, F.array(F.array_min(ways)))

    start = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(1).cast("long").alias("cuts")))
    places = F.sequence(F.lit(1), F.least(F.length("unit"), F.lit(LONGEST_UNIT)))
    folded = F.aggregate(places, start, step, lambda best: F.element_at(best, -1)["cuts"])
    return edges.select("unit", _beside_unit(edges), folded.alias("cuts"))


def cut_units(units: DataFrame, model: Model) -> DataFrame:
    """Distinct units, their other column and their ``cuts``; null for a unit that is not cut by the fold."""
    shortest = 2 if model.kind == BPE else 1
    edges = lattice(units, model, shortest)
    cut = merge_fold(edges) if model.kind == BPE else viterbi_fold(edges, model)
    fits = F.length("unit").between(shortest, LONGEST_UNIT)
    return cut.select("unit", _beside_unit(units), F.when(fits, F.col("cuts")).alias("cuts"))


def ids_of(batch: pa.RecordBatch, model: Model) -> list[list[int]]:
    """Ids of a batch of ``cut_units``."""
    found = []
    for unit, cuts in zip(batch.column("unit").to_pylist(), batch.column("cuts").to_pylist()):
        if cuts is not None:
            found.append(model.segment_ids(unit, cuts))
        elif len(unit) == 1:
            found.append(model.segment_ids(unit, 0b10))
        else:
            found.append(model.library.encode(unit))
    return found


def encode_units(units: DataFrame, model: Model) -> DataFrame:
    """``unit, n, ids`` (little-endian binary) for each distinct unit."""

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.array(i, model.id_type).tobytes() for i in ids_of(batch, model)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], ["unit", "n", "ids"])

    return cut_units(units, model).mapInArrow(to_ids, "unit string, n long, ids binary")


@contextmanager
def sorted_groups(spark: SparkSession) -> Iterator[None]:
    """Queries that run meanwhile group by sorting; the shuffles they leave are freed at the end.

    Those are nearly as large as the input; Spark frees them when nothing refers to them.
    """
    before = spark.conf.get(GROUPING)
    spark.conf.set(GROUPING, "false")
    try:
        yield
    finally:
        spark.conf.set(GROUPING, before)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def head_table(docs: DataFrame, model: Model, most: int) -> pa.Table:
    """``unit, ids`` of about the ``most`` most frequent units."""
    spark = docs.sparkSession
    with sorted_groups(spark):
        counts = fixed(count_units(docs, model), "units", "zstd")
    with sorted_groups(spark):
        return encode_units(common_units(counts, most).repartition(unit_tasks(docs), "unit"), model).select("unit", "ids").toArrow()


# A file's number and a unit's number in it as one key; the last number stands for the file itself.
KEY_BITS = 32
PATH = (1 << KEY_BITS) - 1
# Unit numbers are written byte by byte, the common ones having the smallest, which packs them well.
PLANES = 4


def _planes(numbers: np.ndarray) -> list[bytes]:
    return [(numbers >> (8 * n) & 255).astype(np.uint8).tobytes() for n in range(PLANES)]


def _numbers(planes: list[pa.Scalar]) -> np.ndarray:
    total = np.zeros(len(planes[0].as_buffer()), np.int32)
    for n, plane in enumerate(planes):
        total |= np.frombuffer(plane.as_buffer(), np.uint8).astype(np.int32) << (8 * n)
    return total


def write_files(docs: DataFrame, model: Model, head: pa.Table, folder: str) -> DataFrame:
    """Write the units of all documents into a file a task: ids of those in ``head``, numbers for the others.

    Returns ``key, unit``: per file its path, and its units outside ``head``, each once by its number in
    the file.  A task that is run again writes another file of the same contents.
    """
    width = np.dtype(model.id_type).itemsize
    names = ["doc_ids", "counts", *(f"unit{n}" for n in range(PLANES)), "ids", "sizes", "gaps"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = head.column("unit").combine_chunks()
        known = _runs(head.column("ids").combine_chunks(), model)
        filesystem, base = filesystem_of(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        sink, writer, gaps = None, None, {}
        for batch in in_batches(batches, WORK_BYTES):
            units, counts = model.units_of(batch.column("text"))
            which = units.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(-np.bincount(which, minlength=len(units.dictionary)), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            distinct = units.dictionary.take(pa.array(order))
            place = pc.index_in(distinct, value_set=common).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = known.take(place[place >= 0])
            sizes = np.zeros(len(place), np.int64)
            sizes[place >= 0] = ids.sizes
            absent = distinct.filter(pa.array(place < 0)).to_pylist()
            numbers = np.array([gaps.setdefault(u, len(gaps)) for u in absent], np.int64)
            binary = [*_planes(rank[which]), ids.flat.tobytes(), sizes.astype("<u4").tobytes(), np.diff(numbers, prepend=0).astype("<i8").tobytes()]
            row = pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id")),
                    pa.array([counts.tolist()], pa.list_(pa.int64())), *(pa.array([b], pa.binary()) for b in binary),
                ],
                names,
            )
            if writer is None:
                filesystem.create_dir(base, recursive=True)
                sink = filesystem.open_output_stream(f"{base}/{name}")
                writer = pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=FILE_LEVEL)))
            writer.write_batch(row)
        if writer is None:
            return
        writer.close()
        sink.close()
        key = np.array([PATH, *gaps.values()], np.int64) + (part << KEY_BITS)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array([f"{folder}/{name}", *gaps], pa.string())], ["key", "unit"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(cut, "key long, unit string")


def _runs(ids: pa.Array, model: Model) -> Runs:
    """Id sequences that are bytes in an Arrow column."""
    sizes = np.asarray(pc.binary_length(ids)).astype(np.int64) // np.dtype(model.id_type).itemsize
    return Runs(np.frombuffer(b"".join(ids.to_pylist()), model.id_type), sizes)


def read_file(path: str, gaps: Runs, model: Model) -> Iterator[tuple[pa.Array, Runs]]:
    """Document ids and token ids of a file, batch by batch; ``gaps`` has the ids of the file's own units."""
    with open_uri(path) as file, pa.ipc.open_stream(file) as batches:
        for batch in batches:
            column = {name: batch.column(name)[0] for name in batch.schema.names}
            which = _numbers([column[f"unit{n}"] for n in range(PLANES)])
            sizes = np.frombuffer(column["sizes"].as_buffer(), "<u4").astype(np.int64)
            own = Runs(np.frombuffer(column["ids"].as_buffer(), model.id_type), sizes)
            # Units of no ids here are the file's gaps, in order.
            numbers = np.cumsum(np.frombuffer(column["gaps"].as_buffer(), "<i8"))
            place = np.arange(len(sizes))
            place[sizes == 0] = len(sizes) + numbers
            ids = taken(Runs.of([own, gaps], np.dtype(model.id_type)), place[which])
            ends = np.concatenate([[0], ids.ends])[np.concatenate([[0], np.cumsum(np.asarray(batch.column("counts").flatten()))])]
            yield batch.column("doc_ids").flatten(), Runs(ids.flat, np.diff(ends))


PACKED = "file long, numbers binary, sizes binary, ids binary, path string"


def _blob(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def _unblob(blobs: pa.ChunkedArray, kind: str) -> np.ndarray:
    open_ = zstandard.ZstdDecompressor().decompress
    return np.frombuffer(b"".join(open_(b) for b in blobs.to_pylist()), kind)


def by_file(keys: np.ndarray, ids: Runs, model: Model) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """The ids at each file's keys, packed into a row a file: numbers of the units, ids a unit, ids."""
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], taken(ids, order)
    ends = np.concatenate([[0], ids.ends])
    files = keys >> KEY_BITS
    bounds = np.flatnonzero(np.diff(files, prepend=-1, append=-1))
    for a, b in zip(bounds, bounds[1:]):
        yield int(files[a]), _blob(keys[a:b] & PATH, "<u4"), _blob(ids.sizes[a:b], "<u4"), _blob(ids.flat[ends[a] : ends[b]], model.id_type)


def encode_gaps(written: DataFrame, model: Model) -> DataFrame:
    """The ids of all units in ``written``, which is dealt by unit: each is encoded once and packed for the files it is in.

    A file's path comes among the units under a key of its own; it goes back as it is, in a row without ids.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, places = [], 0

        def rows() -> pa.RecordBatch:
            keys = np.concatenate([k for k, _ in held])
            packed = [(*row, None) for row in by_file(keys, Runs.of([i for _, i in held], np.dtype(model.id_type)), model)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*packed), types)], names)

        names = ["file", "numbers", "sizes", "ids", "path"]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.string()]
        for batch in batches:
            found = ids_of(batch, model)
            units = Runs(np.array([i for own in found for i in own], model.id_type), np.array([len(own) for own in found], np.int64))
            keys, which = np.asarray(batch.column("keys").flatten()), np.asarray(pc.list_parent_indices(batch.column("keys")))
            whole = (keys & PATH) == PATH
            if whole.any():
                paths = batch.column("unit").take(pa.array(which[whole]))
                none = pa.nulls(len(paths), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(keys[whole] >> KEY_BITS), none, none, none, paths], names)
                keys, which = keys[~whole], which[~whole]
            held.append((keys, taken(units, which)))
            places += len(keys)
            if places >= HELD_PLACES:
                yield rows()
                held, places = [], 0
        if places:
            yield rows()
        give_back()

    units = written.groupBy("unit").agg(F.collect_list("key").alias("keys"))
    return cut_units(units, model).mapInArrow(pack, PACKED)


def _encoded(docs: DataFrame, model: Model, head_units: int, finish: Callable[[pa.Array, Runs], pa.RecordBatch], columns: str) -> DataFrame:
    """What ``finish`` makes of the ids of each batch of documents: its columns after ``doc_id``."""
    rows = docs.select("doc_id", "text")
    head = head_table(rows, model, head_units)
    with sorted_groups(docs.sparkSession):
        written = write_files(rows, model, head, scratch(docs.sparkSession, "unit-files"))
        found = fixed(encode_gaps(written.repartition(unit_tasks(rows), "unit"), model), "gaps")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {columns}"

    def spliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One file and the ids of its units; both are bounded by the input of the task that wrote it."""
        units = pa.Table.from_batches(batches)
        paths = units.column("path").drop_null().to_pylist()
        units = units.filter(pc.is_valid(units.column("numbers")))
        gaps = Runs(_unblob(units.column("ids"), model.id_type), _unblob(units.column("sizes"), "<u4").astype(np.int64))
        gaps = taken(gaps, np.argsort(_unblob(units.column("numbers"), "<u4"), kind="stable"))
        yield from (finish(*found) for found in read_file(paths[-1], gaps, model))
        give_back()

    return found.groupBy("file").applyInArrow(spliced, schema)


def encode(docs: DataFrame, model: Model, head_units: int = HEAD_UNITS) -> DataFrame:
    """``doc_id, ids`` (compressed little-endian binary), one row per row of ``docs``.

    A null or empty text has no ids.  Repeated rows are encoded alike and give repeated rows; an
    empty table gives none.
    """

    def packed(doc_ids: pa.Array, ids: Runs) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=1).compress
        blobs = [pack(ids.flat[a:b].tobytes()) for a, b in zip([0, *ids.ends.tolist()], ids.ends.tolist())]
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(blobs, pa.binary())], ["doc_id", "ids"])

    return _encoded(docs, model, head_units, packed, "ids binary")


def unpacked(blob: bytes, model: Model) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), model.id_type)


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """``encoded`` with its texts in a column ``text``; null ids give a null text."""

    @F.arrow_udf("string")
    def text_of(blobs: pa.Array) -> pa.Array:
        return pa.array([None if b is None else model.decoded(unpacked(b, model)).decode("utf-8", "replace") for b in blobs.to_pylist()], pa.string())

    return encoded.withColumn(fresh_name(encoded, "text"), text_of(F.col("ids")))


def digests(docs: DataFrame, model: Model, head_units: int = HEAD_UNITS, keep_ids: bool = False) -> DataFrame:
    """One row per document: id, number of pieces, of byte pieces, CRC-32 of the ids as 32-bit integers, CRC-32 and length of the decoded text.

    With ``keep_ids`` the ids themselves follow as an array ``ids``, which a null or empty text has without entries.
    """
    bytes_of = np.zeros(len(model.pieces), dtype=bool)
    bytes_of[list(model.byte_ids.values())] = True
    kinds = dict.fromkeys(["n_pieces", "n_byte_pieces", "ids_crc32", "text_crc32", "text_bytes"], "long")
    kinds |= {"ids": "array<int>"} if keep_ids else {}

    def digest(doc_ids: pa.Array, ids: Runs) -> pa.RecordBatch:
        ends, sums = [0, *ids.ends.tolist()], []
        n_bytes = np.concatenate([[0], np.cumsum(bytes_of[ids.flat], dtype=np.int32)])
        for a, b in zip(ends, ends[1:]):
            own = ids.flat[a:b]
            text = model.decoded(own)
            sums.append((zlib.crc32(own.astype("<u4").tobytes()), zlib.crc32(text), len(text)))
        ids_sum, text_sum, size = zip(*sums) if sums else ((),) * 3
        columns = [pa.array(c, pa.int64()) for c in (ids.sizes, np.diff(n_bytes[ends]), ids_sum, text_sum, size)]
        if keep_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.flat.astype(np.int32))))
        return pa.RecordBatch.from_arrays([doc_ids, *columns], ["doc_id", *kinds])

    return _encoded(docs, model, head_units, digest, ", ".join(f"{n} {kind}" for n, kind in kinds.items()))

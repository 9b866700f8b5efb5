"""Token ids in compressed binary files with one zstandard dictionary and an offset index.

A file holds one zstandard frame per document, all made with a shared dictionary, so a short
document costs few bytes and can be read alone::

    magic (8) | id bytes (1) | SHA-256 of the dictionary (32)
    frames, in document order
    index: arrays of doc id (int64), null mark (uint8), offset, length, ids (uint64), as one frame
    index offset, index length, documents (uint64 each) | magic (8)

The dictionary lies beside the files, named by its hash; a reader refuses files made with another.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm.common import fixed, input_bytes
from stationflow.session import scratch
from stationflow.sources.files import filesystem_of, open_uri

MAGIC = b"TOKIDS01"
HEAD, HEAD_SIZE = "<8sB32s", 41
FOOT, FOOT_SIZE = "<QQQ8s", 32
END_ID = 1
LEVEL = 3

# Input bytes that go into one file.
FILE_BYTES = 16 << 20
# The dictionary is trained on the first ids of a bounded number of documents.
DICTIONARY_BYTES = 112 << 10
SAMPLE_DOCS = 1_000
SAMPLE_IDS = 4_096
# Words encoded by one call, and bytes of texts whose distinct words are encoded together.
WORDS_A_CALL = 512
WORK_BYTES = 16 << 20
# A word of Latin letters, each one character in composed and in lower-case form (so without U+0130),
# and the punctuation at its end; no apostrophe, which the tokenizer joins to letters.
LAST_LATIN = 0x17F
LETTERS_AND_MARKS = r"^(?P<letters>[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+)(?P<marks>[.,!?;:*#$%&|]*)$"
# How the model's tokens show that a word ends with them.
WORD_END = "</w>"

MANIFEST = "part int, path string, documents long, ids long, bytes long"


@dataclass(frozen=True)
class Runs:
    """Id sequences laid end to end: sequence ``n`` is ``flat[ends[n] - sizes[n] : ends[n]]``."""

    flat: np.ndarray
    sizes: np.ndarray

    @cached_property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.sizes)

    def take(self, which: np.ndarray) -> Runs:
        sizes = self.sizes[which]
        shift = (self.ends - self.sizes)[which] - (np.cumsum(sizes) - sizes)
        return Runs(self.flat[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes)

    @staticmethod
    def of(parts: Sequence[Runs], kind: np.dtype) -> Runs:
        return Runs(np.concatenate([np.empty(0, kind), *(p.flat for p in parts)]), np.concatenate([np.empty(0, np.int64), *(p.sizes for p in parts)]))


class WordEncoder:
    """Encodes texts with a tokenizers file that lower-cases and never joins characters across ASCII spaces.

    The library encodes each distinct word of a batch once.  A word of Latin letters with punctuation
    at its end is what the tokenizer cuts it into, its letters in lower case and the punctuation, so
    distinct letters go to the file's model directly; all other words go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.id_type = np.dtype("<u2" if self.tokenizer.get_vocab_size() < 1 << 16 else "<u4")
        # The same model, for letters that are in lower case and in the model's byte alphabet already.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer, self.letters.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.alphabet = {n: to_bytes(chr(n))[0][0] for n in range(128, LAST_LATIN + 1)}
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(WORD_END)]] = True

    def by_library(self, words: pa.Array) -> Runs:
        """Ids of words; many go through one call and are told apart by their places."""
        chunks = [words[at : at + WORDS_A_CALL].to_pylist() for at in range(0, len(words), WORDS_A_CALL)]
        encoded = self.tokenizer.encode_batch([" ".join(c) for c in chunks], add_special_tokens=False)
        found = []
        for chunk, e in zip(chunks, encoded):
            starts = np.cumsum([0] + [len(w) + 1 for w in chunk])
            places = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
            found.append(Runs(np.array(e.ids, self.id_type), np.diff(np.searchsorted(places, starts))))
        return Runs.of(found, self.id_type)

    def by_model(self, words: pa.Array) -> Runs:
        """Ids of words of lower-case letters; the last token of each is marked as one that ends a word."""
        places = np.arange(0, len(words) + WORDS_A_CALL, WORDS_A_CALL).clip(max=len(words))
        chunks = pc.binary_join(pa.ListArray.from_arrays(pa.array(places, pa.int32()), words), " ").to_pylist()
        encoded = self.letters.encode_batch_fast([c if c.isascii() else c.translate(self.alphabet) for c in chunks], add_special_tokens=False)
        found = []
        for n, e in enumerate(encoded):
            ids = np.array(e.ids, self.id_type)
            sizes = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
            own = words[n * WORDS_A_CALL : (n + 1) * WORDS_A_CALL]
            found.append(Runs(ids, sizes) if len(sizes) == len(own) else self.by_library(own))
        return Runs.of(found, self.id_type)

    def of_words(self, words: pa.Array) -> Runs:
        """Ids of distinct words."""
        cut = pc.extract_regex(words, LETTERS_AND_MARKS)
        plain = np.asarray(cut.is_valid())
        cut = cut.drop_null()
        cores = pc.utf8_lower(cut.field("letters")).dictionary_encode()
        ends = cut.field("marks").dictionary_encode()
        # Chunks without other letters need no translation to the byte alphabet.
        order = np.argsort(~np.asarray(pc.string_is_ascii(cores.dictionary)), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        parts = [self.by_model(cores.dictionary.take(pa.array(order))), self.by_library(ends.dictionary), self.by_library(words.filter(pa.array(~plain)))]
        letters, marks, others = np.cumsum([0] + [len(p.sizes) for p in parts])[:3]
        # Every plain word is two parts and every other one a single part.
        pairs = np.full((len(words), 2), -1)
        pairs[plain, 0] = letters + place[cores.indices.to_numpy(zero_copy_only=False)]
        pairs[plain, 1] = marks + ends.indices.to_numpy(zero_copy_only=False)
        pairs[~plain, 0] = others + np.arange((~plain).sum())
        found = Runs.of(parts, self.id_type).take(pairs[pairs >= 0])
        first = np.cumsum(np.where(plain, 2, 1)) - 1
        sizes = found.sizes[first] if len(first) else found.sizes
        sizes[plain] += found.sizes[first[plain] - 1]
        return Runs(found.flat, sizes)

    def runs(self, texts: pa.Array) -> Runs:
        """Ids of texts; a null has none."""
        texts = utf8(texts).fill_null("")
        own = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
        words = own.flatten().dictionary_encode()
        which = words.indices.to_numpy(zero_copy_only=False)
        table = self.of_words(words.dictionary)
        sizes = np.concatenate([[0], np.cumsum(table.sizes[which])])
        places = own.offsets.to_numpy()
        return Runs(table.take(which).flat, np.diff(sizes[places - places[0]]))

    def encode(self, texts: Sequence[bytes | str | None] | pa.Array) -> Iterator[bytes]:
        """Little-endian ids of texts."""
        found = self.runs(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()))
        for a, b in pairwise([0, *found.ends.tolist()]):
            yield found.flat[a:b].tobytes()


def utf8(texts: pa.Array) -> pa.Array:
    """Texts as strings; bytes that are not UTF-8 become replacement characters."""
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t if t is None else t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())


def in_batches(batches: Iterator[pa.RecordBatch], limit: int = WORK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of small batches in batches of about ``limit`` bytes, in order: fewer words are met anew."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def train_dictionary(docs: DataFrame, tokenizer_path: str, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """A dictionary from the first ``SAMPLE_IDS`` ids of the ``sample_docs`` documents of smallest id hash.

    Only the compression ratio depends on the sample.  Too few or too short documents give an empty
    dictionary, with which frames are ordinary.
    """
    key = F.xxhash64("doc_id")
    (limit,) = docs.select(key.alias("key")).orderBy("key").limit(sample_docs).agg(F.max("key")).first()
    if limit is None:
        return b""

    def first_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        cut = SAMPLE_IDS * encoder.id_type.itemsize
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([ids[:cut] for ids in encoder.encode(batch.column(0))], pa.binary())], ["ids"])

    sample = docs.where((key <= limit) & F.col("text").isNotNull()).select(F.col("text").cast("binary")).limit(sample_docs)
    samples = sorted(bytes(r["ids"]) for r in sample.mapInArrow(first_ids, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


@dataclass(frozen=True)
class TokenFiles:
    """Where written files lie: ``manifest`` has a row a file, ``first_ids`` the ids before each file."""

    folder: str
    dictionary: bytes
    manifest: list[tuple[int, str, int, int, int]]

    def with_starts(self) -> list[tuple[int, str, int]]:
        """``part, path, ids of all files before`` in file order."""
        out, before = [], 0
        for part, path, _, ids, _ in self.manifest:
            out.append((part, path, before))
            before += ids
        return out


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> TokenFiles:
    """Encode ``docs`` (``doc_id`` long, ``text``) and write them in ascending ``doc_id`` order.

    Texts are range-partitioned by id once, with their content as a tie-break, and each task streams
    its range into one file.  A file counts when its task's manifest row does: a task run again
    writes a file of its own.  Null ids come first; a null or empty text has only the end id.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "token-files")
    rows = docs.select("doc_id", "text")
    dictionary = train_dictionary(rows, tokenizer_path)
    digest = hashlib.sha256(dictionary).digest()
    filesystem, base = filesystem_of(folder)
    filesystem.create_dir(base, recursive=True)
    with filesystem.open_output_stream(f"{base}/{digest.hex()}.dictionary") as sink:
        sink.write(dictionary)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        end = np.array([END_ID], encoder.id_type).tobytes()
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary)).compress
        filesystem, base = filesystem_of(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids"
        sink, at, index = None, HEAD_SIZE, []
        for batch in in_batches(batches):
            if sink is None and batch.num_rows:
                sink = filesystem.open_output_stream(f"{base}/{name}")
                sink.write(struct.pack(HEAD, MAGIC, encoder.id_type.itemsize, digest))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                ids += end
                frame = pack(ids)
                sink.write(frame)
                index.append((doc_id or 0, doc_id is None, at, len(frame), len(ids) // encoder.id_type.itemsize))
                at += len(frame)
        if sink is None:
            return
        doc_ids, nulls, offsets, lengths, counts = zip(*index)
        parts = [np.array(doc_ids, "<i8"), np.array(nulls, "u1"), *(np.array(c, "<u8") for c in (offsets, lengths, counts))]
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(p.tobytes() for p in parts))
        sink.write(packed)
        sink.write(struct.pack(FOOT, at, len(packed), len(index), MAGIC))
        sink.close()
        row = [TaskContext.get().partitionId(), f"{folder}/{name}", len(index), sum(counts), at + len(packed) + FOOT_SIZE]
        types = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], [f.split()[0] for f in MANIFEST.split(", ")])

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")) if not input_bytes(rows) else 1, -(-input_bytes(rows) // FILE_BYTES))
    # The last key keeps equal rows from meeting in one range.
    order = [F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = rows.select("doc_id", F.col("text").cast("binary").alias("text"), order[1].alias("o1"), order[2].alias("o2"))
    dealt = dealt.repartitionByRange(parts, "doc_id", "o1", "o2").sortWithinPartitions("doc_id", "o1", "o2")
    manifest = fixed(dealt.select("doc_id", "text").mapInArrow(files, MANIFEST), "token-manifest")
    return TokenFiles(folder, dictionary, sorted(tuple(r) for r in manifest.collect()))


@dataclass(frozen=True)
class Index:
    """A file's documents: id, whether it is null, frame offset, frame length, number of ids."""

    id_type: np.dtype
    digest: bytes
    doc_ids: np.ndarray
    nulls: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray


def read_index(file, size: int) -> Index:
    file.seek(0)
    magic, width, digest = struct.unpack(HEAD, file.read(HEAD_SIZE))
    file.seek(size - FOOT_SIZE)
    at, length, rows, foot = struct.unpack(FOOT, file.read(FOOT_SIZE))
    if magic != MAGIC or foot != MAGIC:
        raise ValueError("not a token file, or one that was cut off")
    file.seek(at)
    data = zstandard.ZstdDecompressor().decompress(file.read(length))
    numbers = np.frombuffer(data, "<u8", 3 * rows, 9 * rows).reshape(3, rows)
    return Index(np.dtype(f"<u{width}"), digest, np.frombuffer(data, "<i8", rows), np.frombuffer(data, "u1", rows, 8 * rows).astype(bool), *numbers)


def _checked(index: Index, dictionary: bytes) -> zstandard.ZstdDecompressor:
    if index.digest != hashlib.sha256(dictionary).digest():
        raise ValueError("the file was written with another dictionary")
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))


def read_documents(path: str, dictionary: bytes, places: Sequence[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``doc id, place, ids`` of a file's documents, all in order or only those at the given places."""
    with open_uri(path) as file:
        index = read_index(file, file.size())
        unpack = _checked(index, dictionary).decompress
        if places is None:
            file.seek(HEAD_SIZE)
            source, places = pa.BufferedInputStream(file, 1 << 20), range(len(index.doc_ids))
            read = lambda n: source.read(int(index.lengths[n]))
        else:
            read = lambda n: file.read_at(int(index.lengths[n]), int(index.offsets[n]))
        for n in places:
            yield None if index.nulls[n] else int(index.doc_ids[n]), n, np.frombuffer(unpack(read(n)), index.id_type)


def find(path: str, dictionary: bytes, doc_id: int) -> list[np.ndarray]:
    """The ids of one document, by the index alone and its own frames."""
    with open_uri(path) as file:
        index = read_index(file, file.size())
    places = np.nonzero((index.doc_ids == doc_id) & ~index.nulls)[0].tolist()
    return [ids for _, _, ids in read_documents(path, dictionary, places)]


def read(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """One row per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    names = [f.split()[0] for f in schema.split(", ")]
    dictionary = files.dictionary

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 4)], names)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                rows = []
                for doc_id, _, ids in read_documents(path, dictionary):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) == 1 << 14:
                        yield batch_of(rows)
                        rows = []
                yield batch_of(rows)

    listing = spark.createDataFrame(files.with_starts(), "part int, path string, before long")
    # A range of one row each: every file is read by a task of its own.
    return listing.repartitionByRange(max(1, len(files.manifest)), "part").mapInArrow(documents, schema)

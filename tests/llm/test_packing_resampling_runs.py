"""Packing, resampling and periodic runs against brute-force versions, and their edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stationflow.llm import importance, packing, periodic
from stationflow.llm.common import ready, table
from stationflow.llm.packing import Example, Limits, Packer
from stationflow.llm.queries import QUERIES, WORD_TOKENIZER

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [
    "", None, " \n\t ", "one", "é é́ ño\x1cb İstanbul ΣΑΣ ﬁ don't I'LL 123 4,5", "x" * 5000, "a b " * 3000, "same " * 5000,
    "a-b_c{d}~e|f`g\x7fh\x00i J", " ".join(f"w{n % 7}" for n in range(400)), "a a a a a", "a a a a a a", "b a a a a a a c", "one two three　four",
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").cache()


@pytest.fixture(scope="module")
def edge(spark):
    """Edge texts, repeated rows, rows without id, and columns that clash with the operators' own."""
    rows = [(i, t, "a", 1, 2) for i, t in enumerate(EDGE)]
    rows += [rows[9], rows[9], (None, EDGE[9], None, None, None), (None, None, None, None, None)]
    return ready(spark).createDataFrame(rows, "doc_id long, text string, runs string, score int, sequence_id int").repartition(3).cache()


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_TOKENIZER)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


# --- packing -----------------------------------------------------------------------------------


def check_sequences(pieces, limits):
    """Pieces as (sequence, offset, length, loss): gapless, within the limits; returns the lengths."""
    own = defaultdict(list)
    for sequence, offset, length, loss in pieces:
        own[sequence].append((offset, length, loss))
    lengths = []
    for parts in own.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= limits.tokens and len(parts) <= limits.segments and sum(p[2] for p in parts) <= limits.loss
        lengths.append(at)
    return lengths


def brute_fill(items, limits):
    """One sequence of the dot-product heuristic, written with plain numbers; items are (key, tokens, loss)."""
    most = (limits.tokens, limits.segments, limits.loss)
    left, chosen = list(most), []
    mean = [sum(v) / len(items) for v in zip(*((t, 1, l) for _, t, l in items))]
    open_ = list(items)
    while True:
        best = None
        for item in open_:
            vector = (item[1], 1, item[2])
            if all(v <= r for v, r in zip(vector, left)):
                product = sum(m / b * v / b * r / b for m, b, v, r in zip(mean, most, vector, left))
                if best is None or product > best[0] * (1 + 1e-12):
                    best = (product, item, vector)
        if best is None:
            return chosen
        chosen.append(best[1][0])
        open_.remove(best[1])
        left = [r - v for r, v in zip(left, best[2])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 40)), min_size=1, max_size=20), st.integers(40, 90), st.integers(1, 6), st.integers(40, 90))
def test_sequences_are_filled_by_the_largest_product(items, tokens, segments, loss):
    limits = Limits(tokens, segments, loss, cut=False)
    packer = Packer(limits, room=len(items))
    for key, (length, prompt) in enumerate(items):
        assert not list(packer.add(Example(key, 0, length, min(prompt, length))))
    want = brute_fill([(k, n, n - min(p, n)) for k, (n, p) in enumerate(items)], limits)
    # Equal vectors can stand for each other.
    vector = lambda k: (items[k][0], items[k][0] - min(items[k][1], items[k][0]))
    assert sorted(vector(p[0]) for p in packer.fill()) == sorted(map(vector, want))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 300), st.integers(0, 300)), max_size=60), st.integers(1, 64), st.integers(1, 5), st.integers(1, 64), st.booleans())
def test_every_id_lies_in_one_piece(items, tokens, segments, loss, cut):
    limits = Limits(tokens, segments, loss, cut)
    packer = Packer(limits, room=4)
    closed = [s for key, (length, prompt) in enumerate(items) for s in packer.add(Example(key, 0, length, min(prompt, length)))]
    closed += packer.finish()
    pieces, placed = [], defaultdict(list)
    for sequence, own in enumerate(closed):
        offset = 0
        for key, start, length, lossy in own:
            prompt = min(items[key][1], items[key][0])
            assert lossy == sum(prompt <= i for i in range(start, start + length))
            pieces.append((sequence, offset, length, lossy))
            placed[key].append((start, length))
            offset += length
    lengths = check_sequences(pieces, limits)
    for key, (length, _) in enumerate(items):
        at = 0
        for start, size in sorted(placed[key]):
            assert start == at
            at += size
        assert at == length
    if cut:
        assert all(n == tokens or n & (n - 1) == 0 for n in lengths)


def packed_rows(found, rows, limits):
    """Checks pieces of the operator against the library's ids; returns lengths of sequences."""
    ids = defaultdict(list)
    for (doc_id, _), own in zip(rows, library_ids(t for _, t in rows)):
        ids[doc_id].append(own)
    lengths = check_sequences([(r["sequence_id"], r["offset"], r["length"], r["loss_tokens"]) for r in found], limits)
    got = defaultdict(Counter)
    for r in found:
        got[r["doc_id"]][r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]] += 1
    for doc_id, own in ids.items():
        assert sum(n * k[1] for k, n in got[doc_id].items()) == sum(map(len, own))
        for start, length, data, tokens in got[doc_id]:
            assert any(len(i) == tokens and np.array(i[start : start + length], "<u4").tobytes() == data for i in own)
    return lengths


def test_packing_holds_what_the_library_gives(spark, docs, edge):
    limits = Limits()
    for frame in (docs, edge):
        rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
        found = packing.pack(frame, WORD_TOKENIZER).collect()
        lengths = packed_rows(found, rows, limits)
        assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)
        if frame is docs:
            assert sum(n == 2048 for n in lengths) * 2048 > 0.9 * sum(lengths)
    assert packing.pack(edge.limit(0), WORD_TOKENIZER).count() == 0


def test_packing_of_prompts(spark):
    """Prompts bear no loss, and examples stay whole where cutting is not allowed."""
    rows = [(n, "answer words " * (1 + n % 7), "question words and more " * (n % 11)) for n in range(300)] + [(300, "long " * 500, "p " * 500)]
    frame = ready(spark).createDataFrame(rows, "doc_id long, text string, prompt string").coalesce(1)
    limits = Limits(256, 8, 64, cut=False)
    found = packing.pack(frame, WORD_TOKENIZER, limits, "prompt").collect()
    check_sequences([(r["sequence_id"], r["offset"], r["length"], r["loss_tokens"]) for r in found], limits)
    assert all(r["length"] == r["doc_tokens"] for r in found if r["doc_id"] < 300)
    loss = Counter()
    for r in found:
        loss[r["doc_id"]] += r["loss_tokens"]
    assert loss[3] == 2 * 4 + 1 and loss[300] == 501


def test_packing_query(spark, sf_dir):
    rows = QUERIES["op11_packing"](spark, sf_dir)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    ids = dict(zip(texts, library_ids(texts.values())))
    for r in rows.collect():
        own = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(own.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])


# --- resampling --------------------------------------------------------------------------------

TOKEN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = TOKEN.findall(low)
    return own, [zlib.crc32(f.encode()) % 10000 for f in own + [" ".join(p) for p in zip(own, own[1:])]]


def brute_resample(rows, target):
    cut = [brute_features(t) for _, t in rows]
    raw, aim = Counter(b for _, f in cut for b in f), Counter(b for t in target for b in brute_features(t)[1])
    all_raw, all_aim = sum(raw.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (all_raw + 10000) / ((raw[b] + 1) * (all_aim + 10000)))) for b in raw}
    out = []
    for (doc_id, _), (own, found) in zip(rows, cut):
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(own)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for place, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = place
    return [tuple(r[:5]) for r in out]


def nulls_first(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v or 0) for v in r))


def test_resampling(spark, sf_dir, docs, edge):
    target = table(spark, sf_dir, "benchmark")
    aim = [r["text"] for r in target.collect()]
    for frame in (docs, edge):
        rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
        got = importance.resample(frame, target).collect()
        assert nulls_first(map(tuple, got)) == nulls_first(brute_resample(rows, aim))
    assert importance.resample(edge.limit(0), target).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert nulls_first(map(tuple, importance.resample(edge, target.limit(0)).collect())) == nulls_first(brute_resample(rows, []))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abZ019 \n\t-é日\x00\x1c\x7f İ"), max_size=120), st.text(max_size=80))
def test_features_of_any_text(first, second):
    import pyarrow as pa

    texts = [first, None, second.encode("utf-8", "ignore").decode(), "", "y" * 100 + " " + first + " " + "z" * 99]
    found = importance.Windows().features(pa.array(texts))
    ends = found.buckets.ends.tolist()
    for text, n, a, b in zip(texts, found.n_words, [0, *ends], ends):
        own, buckets = brute_features(text)
        assert n == len(own) and sorted(found.buckets.flat[a:b].tolist()) == sorted(buckets)


# --- periodic runs -----------------------------------------------------------------------------


def brute_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        at = 0
        while at + q < len(words):
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if length >= max(6, 4 * q) and not any(all(words[i] == words[i + d] for i in range(at, at + length - d)) for d in range(1, q)):
                found.append((at, length, q))
            at = end
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_summary(doc_id, text, planted):
    words = WORD.findall(text or "")
    n = len(words)
    if planted and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest(lines), digest(kept))


def test_runs_query(spark, sf_dir, docs):
    want = [brute_summary(r["doc_id"], r["text"], True) for r in docs.collect()]
    assert sum(w[1] for w in want) > 10
    got = QUERIES["op13_periodic_runs"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert nulls_first(map(tuple, got.collect())) == nulls_first(want)


def test_runs_edge_cases(spark, edge):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    for planted in (False, True):
        frame = periodic.with_planted_periods(edge) if planted else edge
        got = periodic.summary(periodic.periodic_runs(frame)).collect()
        # One word, or two in turn, thousands of times: by rule instead of by brute force.
        want = [brute_summary(i, t, planted) if len(t or "") < 4000 else None for i, t in rows]
        known = {g[0]: g for g in map(tuple, got)}
        assert nulls_first(w for w in want if w) == nulls_first(tuple(g) for g in got if g["doc_id"] not in (5, 6, 7))
        assert known[5][1] == 0 and known[7][1:5] == (1, 0, 5000, 1)
        assert known[6][1:5] == (1, 0, 6000, 2) or planted
    assert periodic.summary(periodic.periodic_runs(edge.limit(0))).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), min_size=1, max_size=4), st.integers(1, 30), st.integers(3, 9), st.randoms())
def test_runs_of_few_words(parts, period, times, random):
    """Texts of few distinct words, and a block that is repeated within them, several texts in one batch."""
    block = [random.randint(0, 3) for _ in range(period)]
    texts = [p + block * times + p[: len(p) // 2] for p in parts]
    words = np.concatenate([[*t, 1000 + n] for n, t in enumerate(texts)]).astype(np.int64)
    document = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    got, want, before = periodic.find(words, document, max(map(len, texts))), [], 0
    for t in texts:
        want += [(s + before, length, q) for s, length, q in brute_runs(t)]
        before += len(t) + 1
    assert got == want


def test_lag_classes_cover_all_lags():
    seen = 0
    for k, first, last in periodic.lag_classes(100_000):
        assert first == seen + 1
        assert all(k <= max(6 - q, 3 * q) and k >= 2 * q - 1 for q in range(first, last + 1))
        seen = last
    assert seen >= 25_000

"""Operators on documents against brute-force versions, and their edge cases."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import Window

import __spark_entry__ as registered
import corpus_pipeline
from stationflow.llm import boosting, langid, licenses, mixing, pieces, pii, quality, simhash, token_files
from stationflow.llm.common import fixed, ready, table
from stationflow.llm.queries import PIECE_MODEL, WORD_TOKENIZER

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [
    "", None, " \n\t ", "one", "é é́ ño\x1cb   İstanbul ΣΑΣ ﬁ don't I'LL 123 4,5", "😀 4111 1111 1111 1111 ñ a@b.cd",
    "a@b.co_x@d.ee 1.2.3.4.5.6.7.8 256.1.1.1", "+1 (768) 555-9731.+49 30 1234567-89", "x" * 3000, "9" * 3000 + " 4111111111111111",
    "same words again and again " * 400, "line\nline\n\nline | # *",
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="module")
def edge(spark):
    """Edge texts, a repeated row, rows without id or source, and columns that clash with the operators' own."""
    rows = [(i, t, "en", f"s{i % 3}", 0, "extra", 1) for i, t in enumerate(EDGE)]
    rows += [rows[4], (None, " ".join(f"no{n} id{n}" for n in range(60)), None, None, None, None, None), (None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, mix string, judged int"
    return ready(spark).createDataFrame(rows, schema).repartition(3).cache()


def words(text):
    return WORD.findall(text or "")


# --- token files -------------------------------------------------------------------------------


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_TOKENIZER)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_token_files_hold_what_the_library_gives(spark, docs, texts):
    files = token_files.write(docs, WORD_TOKENIZER)
    found = sorted(token_files.read(spark, files).collect(), key=lambda r: r["start"])
    start = 0
    for row, doc_id, ids in zip(found, sorted(texts), library_ids(texts[i] for i in sorted(texts)), strict=True):
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    one = found[7]["doc_id"]
    near = [ids.tolist() for f in files.manifest for ids in token_files.find(f[1], files.dictionary, one)]
    assert near == library_ids([texts[one]])
    with pytest.raises(ValueError, match="another dictionary"):
        list(token_files.read_documents(files.manifest[0][1], b"other"))


def test_token_files_edge_cases(spark, edge):
    files = token_files.write(edge, WORD_TOKENIZER)
    found = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids_crc32"]) for r in token_files.read(spark, files).collect())
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    want = sorted((i is not None, i or 0, zlib.crc32(np.array(ids, "<u4").tobytes())) for (i, _), ids in zip(rows, library_ids(t for _, t in rows)))
    assert found == want
    assert token_files.read(spark, token_files.write(edge.limit(0), WORD_TOKENIZER)).count() == 0


# --- SimHash -----------------------------------------------------------------------------------


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    own = words(low)
    if not own:
        return 0
    shingles = [" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: list of (id, fingerprint); ids may be null."""
    group = list(range(len(prints)))

    def top(n):
        while group[n] != n:
            n = group[n]
        return n

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
                group[top(a)] = top(b)
    least = {}
    for n, (i, _) in enumerate(prints):
        if i is not None:
            least[top(n)] = min(i, least.get(top(n), i))
    return [(i, f, least.get(top(n))) for n, (i, f) in enumerate(prints)]


def nulls_first(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v or 0) for v in r))


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 1])
def test_simhash_groups(spark, docs, edge, texts, bucket):
    for frame, rows in ((docs, list(texts.items())), (edge, [(r["doc_id"], r["text"]) for r in edge.collect()])):
        found = simhash.near_duplicates(frame, bucket=bucket)
        found = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found.collect()]
        assert nulls_first(found) == nulls_first(brute_components([(i, brute_fingerprint(t)) for i, t in rows]))


@pytest.mark.parametrize("bucket", [64, 2])
def test_links_are_complete_where_fingerprints_crowd(spark, bucket):
    """Many fingerprints around one: crowded halves go by the longer key and lose no link."""
    rng = np.random.default_rng(5)
    centre = int(rng.integers(1 << 62))
    prints = sorted({centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(160)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(ready(spark).createDataFrame([(s,) for s in signed], "fp long"), bucket=bucket)
    found = {tuple(sorted((r["a"] % (1 << 64), r["b"] % (1 << 64)))) for r in found.collect()}
    assert found == {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3}


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 1])
def test_probes_are_not_broadcast(spark, plan, bucket):
    """A ball has 33 values a half, which Spark's estimate of an exploded table does not count."""
    prints = ready(spark).createDataFrame([(n * 0x9E3779B97F4A7C15 % (1 << 62) ^ b,) for n in range(200) for b in (0, 5)], "fp long")
    # A table of a known, small size, as distinct fingerprints are.
    found = simhash.links(fixed(prints, "prints"), bucket=bucket)
    for ran in (False, True):
        joins = [line for line in plan(found).split("\n") if "Join" in line and "Inner" in line]
        assert len(joins) >= 2 and not any("Broadcast" in j for j in joins), ran
        assert len(found.collect()) >= 200


def test_keep_first(spark, edge):
    kept = simhash.keep_first(edge)
    assert kept.columns == edge.columns
    named = simhash.near_duplicates(edge).where("doc_id = component_id or doc_id is null").count()
    assert kept.count() == named
    assert simhash.near_duplicates(edge.limit(0)).count() == 0


def test_keep_first_goes_by_row_where_an_id_has_several_texts(spark):
    a, b, c = (" ".join(f"{w}{n}" for n in range(80)) for w in ("ab", "cd", "ef"))
    rows = [(1, a), (5, a), (5, b), (7, b), (7, c), (5, b), (9, a), (None, c)]
    kept = simhash.keep_first(ready(spark).createDataFrame(rows, "doc_id long, text string"))
    assert nulls_first(map(tuple, kept.collect())) == nulls_first([(1, a), (5, b), (5, b), (7, c), (None, c)])


# --- quality -----------------------------------------------------------------------------------


def brute_counts(text):
    own = words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 3)} if len(windows) < 3000 else None
    repeats = len(own) if inside is None else len(inside)
    return len(own), sum(map(len, own)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, repeats


def test_quality_counts(spark, sf_dir, docs, edge, texts):
    small = {i: t for i, t in texts.items() if len(words(t)) < 800}
    found = {r["doc_id"]: r for r in registered.queries()["op3_quality_rules"](spark, sf_dir).collect()}
    assert set(found) == set(texts)
    for i, t in small.items():
        n, *rest = brute_counts(t)
        row = found[i]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (n, *rest), i
        assert row["base_failed"] == (n < 50 or 100 * rest[-1] > 50 * n)
        assert not (row["base_failed"] and row["kept"])
    for r in quality.quality(edge, None).where("doc_id is not null").collect():
        assert tuple(r)[1:6] == brute_counts(EDGE[r["doc_id"]])
        assert r["score"] is None and r["kept"] == (not r["base_failed"])


def test_quality_verdicts_follow_the_labels(spark, sf_dir):
    judged = registered.queries()["op3_quality_rules"](spark, "/root/testdata/sf0.01").where("not base_failed")
    rows = judged.join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").select("kept", "quality").collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in rows]) > 0.95


def test_keep_good_keeps_columns(spark, edge):
    kept = quality.keep_good(edge, None)
    assert kept.columns == edge.columns and kept.where("doc_id is null").count() == 1
    assert quality.keep_good(edge.limit(0), edge.limit(0)).count() == 0


def test_boosting_is_monotone_and_same_in_sql(spark):
    rng = np.random.default_rng(2)
    x = rng.random((600, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * rng.random(600) < 0.7).astype(float)
    forest = boosting.fit(x, y, {0: -1, 1: 1})
    grid = np.linspace(0, 1, 101)
    for feature, sign in ((0, -1), (1, 1)):
        for _ in range(20):
            points = np.tile(rng.random(3), (101, 1))
            points[:, feature] = grid
            assert (sign * np.diff(forest.margin(points)) >= -1e-12).all()
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.85
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x[:50]], "a double, b double, c double")
    sql = [r[0] for r in frame.select(forest.margin_sql([frame["a"], frame["b"], frame["c"]])).collect()]
    assert np.allclose(sql, forest.margin(x[:50]))


# --- licenses ----------------------------------------------------------------------------------


def test_license_edge_cases(edge):
    assert {r["licenses"] for r in licenses.scan(edge).collect()} == {""}
    assert licenses.scan(edge).count() == edge.count()


def test_wrapped_license_text(spark):
    grant, condition = licenses.SENTENCES["mit-grant"], licenses.SENTENCES["mit-condition"]
    half = len(grant) // 2
    wrapped = f"Head line\n{condition}.\n"
    ordered = f"A. {grant[:half]}\n{grant[half:].upper()}:\n\n{condition}. Released under the MIT License."
    rows = ready(spark).createDataFrame([(1, ordered), (2, wrapped), (3, "foo\nLicensed under CC BY-NC 4.0.\nbar")], "doc_id long, text string")
    found = {r["doc_id"]: r["licenses"] for r in licenses.scan(rows).collect()}
    assert found == {1: "MIT", 2: "", 3: "CC-BY-NC-4.0"}


MIT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
ISC = """ISC License

Copyright (c) 2020, Jane Doe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
BSD = """Copyright (c) 2020, Jane Doe

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Copyright 2020 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
"""


def test_published_license_texts(spark):
    def comment(text):
        return "".join(f"# {line}".rstrip() + "\n" for line in text.split("\n"))

    want = {MIT: "MIT", ISC: "ISC", BSD: "BSD-2-Clause", BSD + ENDORSE: "BSD-3-Clause", APACHE: "Apache-2.0", "No words\n\nlicense": ""}
    texts = [(f(text), name) for text, name in want.items() for f in (str, comment, lambda t: t.replace("\n", "\r\n"))]
    rows = ready(spark).createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    assert {r["doc_id"]: r["licenses"] for r in licenses.scan(rows).collect()} == {i: name for i, (_, name) in enumerate(texts)}


# --- personal data -----------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute_spans(text):
    found = [
        (m.start(), n, m.end())
        for n, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text or "") if kind != "email" or "@" in text
        if brute_valid(kind, m[0])
    ]
    return [f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_personal_data(spark, docs, edge, texts):
    for frame, judge, own in ((docs, pii.learn(docs), texts), (edge, None, dict(enumerate(EDGE)))):
        for r in pii.find(frame, judge).where("doc_id is not null").collect():
            want = brute_spans(own[r["doc_id"]])
            assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), r["doc_id"]
            assert [r[f"n_{k}"] for k in PLAIN] == [sum(s.startswith(k) for s in want) for k in PLAIN]
            assert set(want) <= set(r["spans"].split(",")) | {""}
    assert pii.learn(edge.limit(0)) is None and pii.find(edge.limit(0), None).count() == 0


def test_added_spans_come_from_the_trees(spark):
    """Phones and look-alike numbers teach the trees; a phone the base pattern misses is then added."""
    rng = np.random.default_rng(3)
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    rows = [(i, f"call +1 ({number(3)}) {number(3)}-{number(4)} or see {number(7)} and {number(9)} x") for i in range(600)]
    frame = ready(spark).createDataFrame(rows, "doc_id long, text string")
    judge = pii.learn(frame)
    assert judge is not None and judge.thresholds[pii.KINDS.index("phone")] is not None
    for r in pii.find(frame, judge).limit(20).collect():
        assert r["n_phone"] == 1 and r["spans"].startswith("phone:")


def test_spans_the_base_patterns_miss_are_added(spark):
    """Learnt from base spans and numbers only: other forms are added, look-alikes are not."""
    rng = np.random.default_rng(8)
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))

    def card():
        d = "4" + number(14)
        return d + next(c for c in "0123456789" if brute_valid("card", d + c))

    ip = lambda: ".".join(str(n) for n in rng.integers(1, 256, 4))
    rows = [
        (i, f"le menta +1 ({number(3)}) 555-{number(4)} the {card()} ciro bo.{number(2)}@mail{number(1)}.example.com of {ip()} en {number(16)} or {number(8)} x")
        for i in range(400)
    ]
    c = card()
    groups = [c[n : n + 4] for n in range(0, 16, 4)]
    broken = groups[:3] + [f"{(int(groups[3]) + 1) % 10000:04d}"]
    missed = {
        1000: ("email", "ana.01 [at] mail2.example.com"), 1001: ("email", "bo(at)mail3.example.org"), 1002: ("phone", "(768) 555-9731"),
        1003: ("phone", "1 (768) 555-9731"), 1004: ("phone", "768.555.9731"), 1005: ("card", ".".join(groups)), 1006: ("ip", "10[.]20[.]30[.]40"),
        1007: ("email", "ana [at] example [dot] com"),
    }
    alike = {2000: "ana [at] noon", 2001: "2021-04-12 10:30", 2002: "555-9731", 2003: ".".join(broken), 2004: "10[.]20[.]300[.]40", 2005: "12:30:45"}
    rows += [(i, f"so ela {hit} und en") for i, (_, hit) in missed.items()] + [(i, f"so ela {hit} und en") for i, hit in alike.items()]
    frame = ready(spark).createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find(frame, pii.learn(frame)).where("doc_id >= 1000").collect()}
    assert found == {i: f"{kind}:7:{7 + len(hit)}" for i, (kind, hit) in missed.items()} | dict.fromkeys(alike, "")


def test_redaction(edge):
    clean = pii.redact(edge)
    assert clean.columns == edge.columns
    by_id = {r["doc_id"]: r for r in clean.where("doc_id is not null").collect()}
    assert by_id[5]["text"] == "😀 [CARD] ñ [EMAIL]" and by_id[5]["n_chars"] == len(by_id[5]["text"])
    assert by_id[1]["text"] is None and by_id[3]["text"] == "one" and by_id[3]["n_chars"] == 0


# --- mixing ------------------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    want = {s: 1.5 * sum(sizes.values()) * weight[s] / sum(weight.values()) for s in names}
    full = set()
    while over := [s for s in names if s not in full and want[s] > 2 * sizes[s]]:
        excess = sum(want[s] - 2 * sizes[s] for s in over)
        full |= set(over)
        want |= {s: 2.0 * sizes[s] for s in over}
        free = sum(weight[s] for s in names if s not in full)
        want |= {s: want[s] + excess * weight[s] / free for s in names if s not in full}
    return want


def test_mixing(spark, docs, texts):
    rows = {r["doc_id"]: r for r in mixing.mixed(docs).collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes, taken = {}, {}
    for i, r in rows.items():
        assert r["size"] == len(words(texts[i])) and r["taken"] in (0, r["size"], 2 * r["size"])
        sizes[source[i]] = sizes.get(source[i], 0) + r["size"]
        taken[source[i]] = taken.get(source[i], 0) + r["taken"]
    want = brute_targets(sizes)
    for i, r in rows.items():
        assert r["source_size"] == sizes[source[i]] and r["target"] == pytest.approx(want[source[i]])
    assert sum(abs(taken[s] - want[s]) for s in sizes) < 0.05 * sum(want.values())
    again = {r["doc_id"]: r for r in mixing.mixed(docs.repartition(5)).collect()}
    assert again == rows


def test_mixing_meets_targets_beside_a_dominant_document(spark):
    """One document holds a third of each source's words; whatever the order, the targets are met."""
    rows = [(f"{s}-{i}", " ".join(["w"] * (20_000 if i == 0 else 100)), s) for s in map(str, range(12)) for i in range(401)]
    frame = ready(spark).createDataFrame(rows, "doc_id string, text string, source string").repartition(4).cache()
    for seed in (1, 2, 3):
        given = mixing.drawn(frame, seed=seed).selectExpr("source", "mix.target", "mix.size * size(mix.shards) as taken", "mix.copies", "size(mix.shards) as dealt")
        assert given.where("copies <> dealt").isEmpty()
        for r in given.groupBy("source", "target").sum("taken").collect():
            assert abs(r["sum(taken)"] - r["target"]) <= 100, (seed, tuple(r))


def test_mix_gives_every_copy(spark, docs, edge):
    for frame in (docs, edge):
        mixed = mixing.mix(frame)
        assert mixed.columns == frame.columns
        want = mixing.drawn(frame.select("doc_id", "text", "source")).selectExpr("sum(size(mix.shards))").first()[0]
        assert mixed.count() == want
    assert mixing.mixed(edge).count() == edge.count()
    assert mixing.mixed(edge.limit(0)).count() == 0 and mixing.mix(edge.limit(0)).count() == 0


def test_splitting_tree_deals_exactly():
    quotas = np.array([1000, 1, 0, 37])
    dealt = mixing.split(quotas, 13)
    assert (dealt.sum(axis=0) == quotas).all() and (dealt >= 0).all()
    assert np.ptp(dealt.sum(axis=1)) <= 4
    shares = [mixing.Share("a", 500, 900.0, 1, 400.0, cut=(1 << 62) + 5), mixing.Share("b", 100, 50.0, 0, 50.0, cut=1 << 61)]
    bits, rows = mixing.blocks(shares, 8)
    drawn = sum(len(s) for _, _, s in rows)
    assert drawn == (1 << bits[0]) + ((shares[0].cut >> (63 - bits[0])) + 1) + ((shares[1].cut >> (63 - bits[1])) + 1)


# --- SentencePiece -----------------------------------------------------------------------------


@pytest.mark.parametrize("head_units", [pieces.HEAD_UNITS, 5])
def test_pieces_equal_the_library(spark, edge, head_units):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    model = pieces.Model.load(PIECE_MODEL)
    found = pieces.decode(pieces.encode(edge, model, head_units), model).where("doc_id is not null").collect()
    assert len(found) == len(EDGE) + 1
    for r in found:
        assert pieces.unpacked(r["ids"], model).tolist() == library.encode(EDGE[r["doc_id"]] or "")
        assert r["text"] == (EDGE[r["doc_id"]] or "")
    assert pieces.encode(edge.limit(0), model).count() == 0


def test_viterbi_equals_the_library_on_a_unigram_model(spark):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PIECE_MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = pieces.UNIGRAM
    model = pieces.Model.parse(proto.SerializeToString())
    units = sorted({u for t in EDGE if t for u in model.units(t)} | {"▁international", "▁тест", "ing", "a" * 61})
    frame = ready(spark).createDataFrame([(u, 1) for u in units], "unit string, n long").repartition(3, "unit")
    library = sentencepiece.SentencePieceProcessor(model_proto=model.proto)
    for r in pieces.encode_units(frame, model).collect():
        assert np.frombuffer(r["ids"], model.id_type).tolist() == library.encode(r["unit"]), r["unit"]


def test_units_come_back_once_and_packed_by_file(spark, edge):
    model = pieces.Model.load(PIECE_MODEL)
    # Nothing but the packed ids is left to shuffle, and no table of all units is joined to them.
    plan = pieces.digests(edge, model, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(file") == 1 and plan.count("Exchange") == 1 and "Join" not in plan

    long = "ab" * 40
    places = [((0, 1), "wordy"), ((0, 0), " zebra"), ((0, 2), long), ((1, 0), "wordy"), ((1, 1), "x"), ((2, 0), long), ((2, 1), "тест")]
    keys = [((file << pieces.KEY_BITS) + number, unit) for (file, number), unit in places]
    keys += [((file << pieces.KEY_BITS) + pieces.PATH, path) for file, path in enumerate(["wordy", "b", "a/" * 50])]
    written = ready(spark).createDataFrame(keys, "key long, unit string").repartition(3, "unit")
    found, paths = {}, {}
    for r in pieces.encode_gaps(written, model).collect():
        if r["path"] is not None:
            assert r["ids"] is None and r["file"] not in paths
            paths[r["file"]] = r["path"]
            continue
        numbers, sizes, ids = (np.frombuffer(zstandard.ZstdDecompressor().decompress(r[c]), k) for c, k in (("numbers", "<u4"), ("sizes", "<u4"), ("ids", model.id_type)))
        for number, own in zip(numbers.tolist(), np.split(ids, np.cumsum(sizes)[:-1])):
            assert (r["file"], number) not in found
            found[r["file"], number] = own.tolist()
    assert paths == {0: "wordy", 1: "b", 2: "a/" * 50}
    assert found == {place: model.library.encode(unit) for place, unit in places}


def test_common_units(spark):
    counts = ready(spark).createDataFrame([(f"u{n}", max(1, 50 - n)) for n in range(20_000)] + [("a" * 70, 999)], "unit string, n long")
    for most in (0, 5, 49, 10_000, 30_000):
        units = {r["unit"] for r in pieces.common_units(counts, most).collect()}
        assert "a" * 70 not in units and {f"u{n}" for n in range(min(most, 49))} <= units
        assert abs(len(units) - min(most, 20_000)) <= (0 if most < 50 or most > 20_000 else 500)
        assert units == {r["unit"] for r in pieces.common_units(counts.repartition(7), most).collect()}
    assert pieces.common_units(counts.limit(0), 5).count() == 0


# --- languages ---------------------------------------------------------------------------------


def test_languages(spark, sf_dir, docs, edge):
    rows = registered.queries()["op9_language_id"](spark, "/root/testdata/sf0.01")
    lang = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    held = [r for r in rows.join(lang, "doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(r["held_out"] for r in held) and len(held) == rows.where("held_out").count()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    model = langid.learn(docs)
    found = {r["doc_id"]: r for r in langid.identify(edge, model).where("doc_id is not null").collect()}
    assert [found[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and found[0]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in found.values())
    nothing = langid.learn(edge.limit(0))
    assert {r["lang_pred"] for r in langid.identify(edge, nothing).collect()} == {"und"}


def test_grams_of_long_texts_are_counted_whole(monkeypatch):
    text = "Ein Satz mit Wörtern, Zahlen 123 und ß. " * 40
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 17)
    assert all((a == b).all() for a, b in zip(whole, langid.gram_counts(text)))


# --- pipeline ----------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir, docs, texts):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "personal_data", "mix_sources", "sentencepiece_ids"]
    frame, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, sf_dir).cache()
        assert frame.columns == docs.columns
        seen.append(frame.collect())
    good, single, clean, mixed = seen
    kept = {r["doc_id"] for r in registered.queries()["op3_quality_rules"](spark, sf_dir).where("kept").collect()}
    assert {r["doc_id"] for r in good} == kept
    groups = brute_components([(i, brute_fingerprint(texts[i])) for i in sorted(kept)])
    assert {r["doc_id"] for r in single} == {i for i, _, c in groups if i == c}
    assert len(clean) == len(single)
    assert not any(s.startswith("email") for r in clean for s in brute_spans(r["text"]))
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in clean}
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    want = sorted((r["doc_id"], zlib.crc32(np.array(library.encode(r["text"]), "<u4").tobytes())) for r in mixed)
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in found) == want


def test_the_last_stage_gives_the_ids(spark, sf_dir):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rows = [*enumerate(EDGE), (3, "one"), (None, "two words"), (3, "x" * 70 + " three")]
    frame = ready(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = dict(corpus_pipeline.STAGES)["sentencepiece_ids"](spark, frame, sf_dir)
    want = [(i, library.encode(t or "")) for i, t in rows]
    assert sorted(map(str, ((r["doc_id"], r["ids"]) for r in found.collect()))) == sorted(map(str, want))
    for r in found.collect():
        assert r["n_pieces"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    assert dict(found.dtypes)["ids"] == "array<int>"


def test_the_pipeline_does_not_broadcast_probes(spark, plan, sf_dir, monkeypatch):
    links, seen = simhash.links, []
    monkeypatch.setattr(simhash, "links", lambda *a: seen.append(links(*a)) or seen[-1])
    rows = [(n, " ".join(f"w{n // 2 * 7919 % 1000}x{k}" for k in range(30))) for n in range(100)]
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, ready(spark).createDataFrame(rows, "doc_id long, text string"), sf_dir)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 100, 2))
    joins = [line for line in plan(seen[0]).split("\n") if "Join" in line and "Inner" in line]
    assert len(seen) == 1 and len(joins) >= 2 and not any("Broadcast" in j for j in joins)


def test_added_tokens_in_any_letter_case(spark):
    """Only the exact spelling of an added token is that token."""
    spellings = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|StartOfText|>", "<|STARTOFTEXT|>"]
    rows = [f"a {s}{end} b{s}c <|{s}" for s in spellings for end in ("", ".", "!x", "|")] + spellings
    encoder = token_files.WordEncoder(WORD_TOKENIZER)
    found = [np.frombuffer(ids, encoder.id_type).tolist() + [1] for ids in encoder.encode([r.encode() for r in rows])]
    assert found == library_ids(rows)


def test_license_scan_of_very_many_blank_lines(spark):
    """Runs of blank and empty comment lines end a paragraph whatever their length."""
    notice = licenses.SENTENCES["mit-notice"]
    rows = [(n, f"Heading{end * 1_000_000}{notice}\n{end * 1_000_000}") for n, end in enumerate(("\n", "\n# ", "\n *"))]
    found = licenses.scan(ready(spark).createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["licenses"] for r in sorted(found)] == ["MIT"] * 3


def test_languages_equal_a_plain_bayes(spark, docs, edge):
    """Naive Bayes over dicts, with the grams hashed one by one."""
    mask = (1 << 64) - 1

    def buckets(text):
        letters = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        points = [ord(c) for c in f" {' '.join(letters)} "] if letters else []
        found = []
        for n in (1, 2, 3):
            for at in range(len(points) - n + 1):
                h = langid.LENGTHS[n - 1]
                for place in range(n):
                    h = ((h ^ (points[at + place] * langid.PLACES[place] & mask)) * langid.LENGTHS[0]) & mask
                found.append(h >> 49)
        return found

    rows = [(r["text"][:400], r["lang"]) for r in docs.collect() if r["text"] and r["lang"]][:150]
    grams, documents = {}, {}
    for text, lang in rows:
        if own := buckets(text):
            documents[lang] = documents.get(lang, 0) + 1
            counts = grams.setdefault(lang, {})
            for b in own:
                counts[b] = counts.get(b, 0) + 1
    asked = [r[0] for r in rows[:60]] + EDGE
    model = langid.learn(ready(spark).createDataFrame(rows, "text string, lang string").repartition(3))
    found = langid.identify(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    for n, text in enumerate(asked):
        own = buckets(text)
        if not own:
            assert got[n] == ("und", 0.0)
            continue
        score = {}
        for lang, counts in grams.items():
            total = sum(counts.values()) + langid.SMOOTHING * langid.BUCKETS
            score[lang] = np.log(documents[lang] / sum(documents.values())) + sum(np.log((counts.get(b, 0) + langid.SMOOTHING) / total) for b in own)
        top = max(score.values())
        assert score[got[n][0]] > top - 1e-6
        assert got[n][1] == pytest.approx(1 / sum(np.exp(s - top) for s in score.values()), abs=1e-6)


def test_languages_learned_are_bounded(spark, docs):
    rows = ready(spark).createDataFrame([(f"word number {n} of text", f"l{n % 40:02d}") for n in range(200)] + [("wort", "de")] * 9, "text string, lang string")
    assert langid.learn(rows, 5).languages == ("de", "l00", "l01", "l02", "l03")


NOTICES = {
    "This project is licensed under the MIT License - see the LICENSE file for details.": "MIT",
    "Released under the MIT License (see LICENSE).": "MIT",
    "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
    "The code in this repository is available under the terms of the GNU General Public License v3.0 or later.": "GPL-3.0",
    "All files are distributed under the GNU LGPL, version 2.1.": "LGPL-2.1",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "Published under CC BY-ND 3.0.": "CC-BY-ND-3.0",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.": "OFL-1.1",
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
    "Licensed under the 3-Clause BSD License.": "BSD-3-Clause",
    "This software is licenced under the ISC licence.": "ISC",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "We are not licensed under the sun.": "",
    "The MIT License is a short license.": "",
    "the road is available under the bridge": "",
}
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
"""


def test_license_notices_equal_their_sql(spark, tmp_path):
    """Notices in many wordings, alone and within a text, in both languages."""
    import duckdb

    texts = [*NOTICES, *(f"Some prose before.\n{t}\nMore of it." for t in NOTICES), MPL, LGPL, GPL2, MIT, f"Head\n\n{BSD}\n{ENDORSE}", MPL.replace("\n", "\r\n"), None, ""]
    want = [*NOTICES.values(), *NOTICES.values(), "MPL-2.0", "LGPL-2.1", "GPL-2.0", "MIT", "BSD-3-Clause", "MPL-2.0", "", ""]
    frame = ready(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r) for r in licenses.scan(frame).collect()}
    assert [got[n][3] for n in range(len(texts))] == want
    frame.write.parquet(str(tmp_path / "documents"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert {r[0]: r for r in db.sql(licenses.oracle()).fetchall()} == got


def test_components_of_a_path_in_hostile_order(spark, monkeypatch):
    """A path of 4,096 nodes takes rounds that grow with the logarithm of its length."""
    from stationflow.llm import components

    written, fixed = [], components.fixed
    monkeypatch.setattr(components, "fixed", lambda df, label: written.append(label) or fixed(df, label))
    half = 1024
    # Two slopes that meet: the smaller end would have to crawl up the other one's slope.
    order = [*range(half, 0, -1), 0, *range(2 * half, half, -1), *range(2 * half + 1, 4 * half)]
    frame = ready(spark).createDataFrame(list(zip(order, order[1:])), "a long, b long").repartition(2)
    found = components.connected_components(frame).collect()
    assert len(found) == len(order) and {r["label"] for r in found} == {0}
    assert len(written) < 60


def test_fits_are_bounded(spark):
    """Many rows of one id teach no more than one."""
    text = "Call +1 (768) 555-9731 or write to someone@example.org, order 1234-5678-90 of 2024-01-05. " * 3
    rows = [(1, f"{text} {n}", 1) for n in range(500)] + [(n, text, n % 2) for n in range(2, 30)]
    frame = ready(spark).createDataFrame(rows, "doc_id long, text string, quality int")
    seen = []
    from pyspark.sql.classic.dataframe import DataFrame

    collect = DataFrame.collect
    try:
        DataFrame.collect = lambda self: (lambda out: seen.append(len(out)) or out)(collect(self))
        quality.learn(frame, frame.select("doc_id", "quality"))
        few = list(seen)
        seen.clear()
        pii.learn(frame)
    finally:
        DataFrame.collect = collect
    assert max(few) <= 29
    one = pii._taught(pii._base(frame.where("doc_id = 2").selectExpr("1L as key", "text as body"))).count()
    assert max(seen) <= 29 * one


def test_personal_data_in_long_texts(spark):
    """Four megabytes of numbers and addresses in one text take less than a minute."""
    import time

    line = "Call +1 (768) 555-9731, mail a.b@c.org, host 10.1.2.3 or card 4111 1111 1111 1111; 12 34 56 78 90 11 22 33. "
    rows = [(1, line * (4_000_000 // len(line)))]
    frame = ready(spark).createDataFrame(rows, "doc_id long, text string")
    begun = time.time()
    found = pii.find(frame, None).first()
    assert found["n_phone"] == found["n_email"] == found["n_ip"] == found["n_card"] == 4_000_000 // len(line)
    assert time.time() - begun < 60
    few = pii.find(spark.createDataFrame([(1, line * 700)], "doc_id long, text string"), None).first()
    places = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in few["spans"].split(","))]
    assert places == sorted(places) and all((line * 700)[a:b].strip() == (line * 700)[a:b] for a, b, _ in places)
    clean = pii.redact(spark.createDataFrame([(1, line * 700)], "doc_id long, text string"), None).first()["text"]
    assert clean == (line * 700).replace("+1 (768) 555-9731", "[PHONE]").replace("a.b@c.org", "[EMAIL]").replace("10.1.2.3", "[IP]").replace("4111 1111 1111 1111", "[CARD]")


def test_personal_data_is_learned_from_all_documents(spark):
    """Phones in the documents of the largest id hashes only, and more than a few of them in a text."""
    from pyspark.sql import functions as F

    key = F.row_number().over(Window.orderBy(F.desc(F.xxhash64("doc_id"))))
    number = lambda n, of: F.lpad(F.pmod(F.xxhash64("doc_id", F.lit(of)), F.lit(10**n)).cast("string"), n, "0")
    phone = F.concat(F.lit("call +1 ("), number(3, 1), F.lit(") "), number(3, 2), F.lit("-"), number(4, 3), F.lit(" or see "), number(7, 4), F.lit(" x"))
    ids = ready(spark).range(5_000).withColumnRenamed("id", "doc_id")
    frame = ids.select("doc_id", F.when(key <= 300, phone).otherwise("no such thing").alias("text"))
    judge = pii.learn(frame)
    assert judge is not None and judge.thresholds[pii.KINDS.index("phone")] is not None
    line = "call +1 (768) 555-9731 or 12 34 56 78 90 x. "
    one, many = (pii._taught(pii._base(spark.createDataFrame([(1, line * n)], "key long, body string"))).count() for n in (100, 1_500))
    assert many == 15 * one


def test_boosting_of_all_rows_equals_the_fit(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, [200, 7, 2, 1], (3_000, 4))
    y = x[:, 0] + 30 * x[:, 1] * x[:, 2] + rng.integers(0, 60, 3_000) < 170
    part, unseen = rng.integers(0, 2, 3_000), rng.random(3_000) < 0.3
    rows = [(int(p), [int(v) for v in r], bool(u), 1, int(t)) for p, r, t, u in zip(part, x, y, unseen)]
    frame = ready(spark).createDataFrame(rows, "part int, x array<int>, unseen boolean, n long, genuine long").repartition(3)
    found = boosting.fit_parts(frame, trees=1)
    for p in (0, 1):
        own, kept = (part == p) & ~unseen, (part == p) & unseen
        forest, margin, n, genuine = found[p]
        assert np.abs(forest.margin(x) - boosting.fit(x[own].astype(float), y[own].astype(float), trees=1).margin(x)).max() < 0.002
        margins, counts = np.unique(forest.margin(x[kept]), return_counts=True)
        order = np.argsort(margin)
        assert np.allclose(margin[order], margins) and n[order].tolist() == counts.tolist() and genuine.sum() == y[kept].sum()
    assert {p: len(f[0].roots) for p, f in boosting.fit_parts(frame, trees=3).items()} == {0: 3, 1: 3}
    assert boosting.fit_parts(frame.where("unseen")) == {}

"""License scans: known sentences to identifiers, then identifier sequences to ordered rules.

Sentences are normalised to lower-case ASCII words.  Texts are read in three ways, with line ends as
sentence ends, with lines joined, and with the lines of each paragraph joined, so that one-line
notices and wrapped license texts below a heading are seen.  Notices are brought to one form first:
what the license is for, the verb, "the terms of" and a pointer to a license file do not matter.  All
steps are column functions on the row, without a shuffle.
"""

from __future__ import annotations

import re
from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licenses and notices, normalised, with their identifiers.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-long": "licensed under the apache license version 2 0 the license",
    "apache-compliance": "you may not use this file except in compliance with the license",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-free-software": "this program is free software",
    "gpl-warranty": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "gpl-published": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "lgpl-free-software": "this library is free software",
    "lgpl-published": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl3-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl3-redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "either-2": "either version 2 of the license or at your option any later version",
    "either-2-1": "either version 2 1 of the license or at your option any later version",
    "either-3": "either version 3 of the license or at your option any later version",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl2-copy-s": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "epl2-notice": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0-waiver": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "postgresql-grant": "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
}

# A license and the identifiers that stand for it, in order and next to each other
# among a text's known sentences.
RULES = (
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-grant", "mit-condition")),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-notice-long", "apache-compliance")),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-3.0", ("gpl-free-software", "gpl-redistribute")),
    ("GPL-2.0", ("gpl-free-software", "gpl2-redistribute")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("ISC", ("isc-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("GPL-2.0", ("gpl-free-software", "gpl-published", "either-2")),
    ("GPL-3.0", ("gpl-free-software", "gpl-published", "either-3")),
    ("LGPL-2.1", ("lgpl-free-software", "lgpl-published", "either-2-1")),
    ("LGPL-3.0", ("lgpl-free-software", "lgpl-published", "either-3")),
    ("LGPL-3.0", ("lgpl3-redistribute",)),
    ("AGPL-3.0", ("agpl3-redistribute",)),
    ("MPL-2.0", ("mpl2-copy",)),
    ("MPL-2.0", ("mpl2-copy-s",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-waiver",)),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("boost-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("PostgreSQL", ("postgresql-grant",)),
)
# A longer rule that holds takes the place of a shorter one of the same family.
REPLACED = {"BSD-2-Clause": "BSD-3-Clause"}

# Licenses by their SPDX identifier, with the names that notices give them and, where the
# name needs one, their version.
NAMED = {
    "MIT": (("mit license", "mit", "expat license", "mit x11 license"), None),
    "Apache-2.0": (("apache license", "apache", "apache software license", "apache public license"), "2 0"),
    "GPL-2.0": (("gnu general public license", "gnu gpl", "gpl", "general public license"), "2"),
    "GPL-3.0": (("gnu general public license", "gnu gpl", "gpl", "general public license"), "3"),
    "LGPL-2.1": (("gnu lesser general public license", "gnu lgpl", "lgpl", "lesser general public license"), "2 1"),
    "LGPL-3.0": (("gnu lesser general public license", "gnu lgpl", "lgpl", "lesser general public license"), "3"),
    "AGPL-3.0": (("gnu affero general public license", "gnu agpl", "agpl", "affero general public license"), "3"),
    "GFDL-1.3": (("gnu free documentation license", "gnu fdl", "gfdl"), "1 3"),
    "MPL-1.1": (("mozilla public license", "mpl"), "1 1"),
    "MPL-2.0": (("mozilla public license", "mpl"), "2 0"),
    "EPL-1.0": (("eclipse public license", "epl"), "1 0"),
    "EPL-2.0": (("eclipse public license", "epl"), "2 0"),
    "CPL-1.0": (("common public license", "cpl"), "1 0"),
    "CDDL-1.0": (("common development and distribution license", "cddl"), "1 0"),
    "EUPL-1.2": (("european union public license", "eupl"), "1 2"),
    "AFL-3.0": (("academic free license", "afl"), "3 0"),
    "OSL-3.0": (("open software license", "osl"), "3 0"),
    "Artistic-2.0": (("artistic license",), "2 0"),
    "BSL-1.0": (("boost software license", "boost license"), "1 0"),
    "OFL-1.1": (("sil open font license", "open font license", "ofl"), "1 1"),
    "ODbL-1.0": (("open database license", "odbl", "open data commons open database license"), "1 0"),
    "BSD-2-Clause": (("bsd 2 clause license", "2 clause bsd license", "bsd 2 clause", "simplified bsd license", "freebsd license"), None),
    "BSD-3-Clause": (("bsd 3 clause license", "3 clause bsd license", "bsd 3 clause", "new bsd license", "modified bsd license", "revised bsd license"), None),
    "0BSD": (("0bsd", "0bsd license", "bsd zero clause license", "zero clause bsd license"), None),
    "ISC": (("isc license", "isc"), None),
    "Zlib": (("zlib license", "zlib libpng license"), None),
    "Unlicense": (("unlicense", "unlicense license"), None),
    "WTFPL": (("wtfpl", "wtfpl license"), None),
    "PostgreSQL": (("postgresql license",), None),
    "Python-2.0": (("python software foundation license", "psf license"), None),
    "MS-PL": (("microsoft public license", "ms pl"), None),
    "NCSA": (("university of illinois ncsa open source license", "ncsa open source license"), None),
    "CC0-1.0": (("cc0", "cc0 1 0", "cc0 1 0 universal", "cc0 1 0 universal license", "creative commons zero", "creative commons cc0", "creative commons zero v1 0 universal license"), None),
}
# The conditions of the Creative Commons licenses, short and in words, and their versions.
CONDITIONS = {
    "by": "attribution",
    "by sa": "attribution sharealike",
    "by nc": "attribution noncommercial",
    "by nd": "attribution noderivatives",
    "by nc sa": "attribution noncommercial sharealike",
    "by nc nd": "attribution noncommercial noderivatives",
}
CC_VERSIONS = ("2 0", "2 5", "3 0", "4 0")
SPDX_TAG = "spdx license identifier"

_VERB = "(?:licensed|released|distributed|published|available|made available|provided|covered|offered|shared)"
# What a notice may say without changing its meaning: pattern and what stands for it.
NORMAL_FORM = (
    (r"\blicence(d?)\b", r"license$1"),
    (rf"^(?:this|the|our|all|it|its)(?: [a-z0-9]+){{0,6}}? (?:is|are) (?:also |hereby |now )?{_VERB} under ", "licensed under "),
    (rf"^{_VERB} under ", "licensed under "),
    (r"^licensed under (?:the |a )?(?:terms (?:and conditions )?of )?(?:the )?(?:permissive |open source )?", "licensed under "),
    (r" (?:see|as found in|which is in) (?:the )?(?:included |accompanying |attached )?(?:license|copying)(?: (?:txt|md|rst))?(?: file)?(?: for (?:more |full |the )?(?:details|information|terms|text))?$", ""),
    (r"^(licensed under .*) (?:or|and) (?:at your option )?(?:any )?later(?: version)?$", "$1 or later"),
)


def in_normal_form(words: str) -> str:
    """What the column functions make of the words of a sentence."""
    if " under " in words:
        for pattern, by in NORMAL_FORM:
            words = re.sub(pattern, by.replace("$1", r"\1"), words)
    return words


def _spoken(name: str, version: str | None) -> list[str]:
    """The ways to say a license's name and version."""
    if version is None:
        return [name]
    short = name.removesuffix(" license")
    ways = [f"{name} {v}" for v in (version, f"version {version}", f"v{version}", f"v {version}")]
    ways += [f"{short} {version} license", f"{short} v{version} license"] if short != name else []
    whole = f"{version} 0" if " " not in version else None
    ways += [w.replace(version, whole) for w in ways] if whole else []
    return ways


def wordings() -> dict[str, str]:
    """Known sentences in their normal form, with identifiers: those listed, and the notices and tags of all named licenses."""
    found = {}
    for name, words in SENTENCES.items():
        found.setdefault(in_normal_form(words), name)
    named = {spdx: [w for n in names for w in _spoken(n, version)] for spdx, (names, version) in NAMED.items()}
    for short, long in CONDITIONS.items():
        for version in CC_VERSIONS:
            whole = f"creative commons {long}"
            named[f"CC-{short.upper().replace(' ', '-')}-{version.replace(' ', '.')}"] = [
                f"cc {short} {version}", f"cc {short} {version} license", f"creative commons {short} {version}",
                *(f"{whole} {version}{kind}{end}" for kind in ("", " international", " unported", " generic") for end in ("", " license")),
            ]
    for spdx, names in named.items():
        later = [f"{n} or later" for n in names] if "GPL" in spdx else []
        for words in (*names, *later):
            found.setdefault(in_normal_form(f"licensed under {words}"), _notice(spdx))
        tag = re.sub("[^a-z0-9]+", " ", spdx.lower())
        for end in ("", " only", " or later") if "GPL" in spdx else ("",):
            found.setdefault(f"{SPDX_TAG} {tag}{end}", _notice(spdx))
    return found


def _notice(spdx: str) -> str:
    return f"notice-{spdx.lower()}"


def rules() -> list[tuple[str, tuple[str, ...]]]:
    """The listed rules, and one for the notices of each named license."""
    own = {i for i in wordings().values() if i.startswith("notice-")}
    listed = [*NAMED, *(f"CC-{c.upper().replace(' ', '-')}-{v.replace(' ', '.')}" for c in CONDITIONS for v in CC_VERSIONS)]
    return [*RULES, *((spdx, (_notice(spdx),)) for spdx in listed if _notice(spdx) in own)]

# Every known sentence has one of these words, so a text without any needs no further look.
TRIGGER = "(?i)licen[sc]|permission|software|redistribut|warranty|copyright|\\sunder\\s"
# The colon of a tag ends no sentence.
TAG = r"(?i)(SPDX-License-Identifier):[ \t]*"
# Every known sentence has one of these, so that other sentences need no lookup.
KEY_WORD = "licen[sc]| under |permi|software|redistribut|copyright|version|mpl|unencumbered|public domain"
SENTENCE_END = r"([.!?;:])[ \t\r\n]+"
# A paragraph ends at lines without words; empty comment lines are such lines.
# Possessive, as a group that may give back recurses once a line.
PARAGRAPH_END = r"\n(?:[^A-Za-z0-9\n]*+\n)++"
LINE_END = r"[ \t\r]*\n[ \t\r]*"


def normalised(sentence: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(sentence, "[^A-Za-z0-9]+", " ")))


def known_sentences(text: Column) -> Column:
    """Identifiers of a text's known sentences, in order."""
    # One literal, as a plan with an expression an entry takes long to make.
    table = F.str_to_map(F.lit(";".join(f"{words}={name}" for words, name in wordings().items())), F.lit(";"), F.lit("="))

    def identified(sentence: Column) -> Column:
        form = sentence
        for pattern, by in NORMAL_FORM:
            form = F.regexp_replace(form, pattern, by)
        form = F.when(F.contains(sentence, F.lit(" under ")), form).otherwise(sentence)
        own = F.element_at(F.transform(F.array(form), lambda w: F.try_element_at(table, w)), 1)
        return F.when(sentence.rlike(KEY_WORD), own)

    sentences = F.transform(F.split(F.regexp_replace(text, SENTENCE_END, "$1\n"), "\n"), normalised)
    return F.filter(F.transform(sentences, identified), lambda i: i.isNotNull())


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: id, known sentences line by line and with lines joined, licenses by name.

    Licenses are those that hold in any reading, by paragraphs too.
    Lists are joined by commas; a null or empty text, or one without known sentences, has empty
    lists.  Repeated rows give repeated results, an empty table none.
    """
    body = F.when(F.col("text").rlike(TRIGGER), F.col("text")).otherwise("")
    rows = docs.select("doc_id", F.regexp_replace(body, TAG, "$1 ").alias("body"))
    joined = lambda text: F.regexp_replace(text, LINE_END, " ")
    # The paragraph separator stands for the ends of paragraphs while lines are joined.
    paragraphs = F.translate(joined(F.regexp_replace("body", PARAGRAPH_END, "\u2029")), "\u2029", "\n")
    rows = rows.select(
        "doc_id", F.array_join(known_sentences(F.col("body")), ",").alias("by_line"),
        F.array_join(known_sentences(joined(F.col("body"))), ",").alias("joined"),
        F.array_join(known_sentences(paragraphs), ",").alias("paragraphs"),
    )
    # The three readings as one text, so that each rule is looked for once; texts without any have no licenses.
    read = F.concat(F.lit(","), F.concat_ws(",;,", "by_line", "joined", "paragraphs"), F.lit(","))
    rows = rows.withColumn("read", read)
    table = F.split(F.lit(";".join(f"{name}=,{','.join(ids)}," for name, ids in rules())), ";")
    held = F.transform(F.filter(table, lambda r: F.contains(F.col("read"), F.substring_index(r, "=", -1))), lambda r: F.substring_index(r, "=", 1))
    found = F.when(F.col("read") != ",,;,,;,,", held).otherwise(F.array().cast("array<string>"))
    for short, long in REPLACED.items():
        found = F.when(F.array_contains(found, long), F.array_remove(found, short)).otherwise(found)
    return rows.select(
        "doc_id", F.col("by_line").alias("sentences"), F.col("joined").alias("joined_sentences"),
        F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("licenses"),
    )


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle() -> str:
    """The scan in DuckDB's SQL."""
    known = "MAP {" + ", ".join(f"{_text(words)}: {_text(name)}" for words, name in wordings().items()) + "}"
    words = "lower(trim(regexp_replace(s, '[^A-Za-z0-9]+', ' ', 'g')))"
    form = words
    for pattern, by in NORMAL_FORM:
        form = f"regexp_replace({form}, {_text(pattern)}, {_text(by.replace('$1', chr(92) + '1'))}, 'g')"
    ids = lambda body: (
        f"array_to_string(list_filter(list_transform(string_split(regexp_replace({body}, '([.!?;:])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)), "
        f"lambda s: known[CASE WHEN contains({words}, ' under ') THEN {form} ELSE {words} END]), lambda i: i IS NOT NULL), ',')"
    )
    lines = lambda body: f"regexp_replace({body}, '[ \\t\\r]*\\n[ \\t\\r]*', ' ', 'g')"
    paragraphs = "replace(" + lines("regexp_replace(body, '\\n(?:[^A-Za-z0-9\\n]*\\n)+', chr(8233), 'g')") + ", chr(8233), chr(10))"
    readings = ("sentences", "joined_sentences", "paragraph_sentences")
    holds = lambda own: " OR ".join(f"contains(',' || {r} || ',', {_text(',' + ','.join(own) + ',')})" for r in readings)
    found = ", ".join(f"CASE WHEN {holds(own)} THEN {_text(name)} END" for name, own in rules())
    dropped = "list_filter(found, lambda n: n IS NOT NULL" + "".join(
        f" AND NOT (n = {_text(short)} AND list_contains(found, {_text(long)}))" for short, long in REPLACED.items()
    ) + ")"
    return f"""
        WITH bodies AS (SELECT doc_id, regexp_replace(coalesce(text, ''), {_text(TAG)}, '\\1 ', 'g') AS body, {known} AS known FROM documents),
        seen AS (SELECT doc_id, {ids("body")} AS sentences, {ids(lines("body"))} AS joined_sentences, {ids(paragraphs)} AS paragraph_sentences FROM bodies),
        ruled AS (SELECT *, [{found}] AS found FROM seen)
        SELECT doc_id, sentences, joined_sentences, array_to_string(list_sort(list_distinct({dropped})), ',') AS licenses FROM ruled
    """

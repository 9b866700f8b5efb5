"""Personal data: base patterns, then candidate spans judged by boosted trees; all in SQL functions.

Base spans (email, ip, card, phone) are found by fixed patterns and checks and always stay.
Generators of high recall propose more spans, which may overlap; trees over format and context
features score those that overlap no base span; a threshold per kind, calibrated on such candidates
the fit has not seen, selects those that are added.  Nothing leaves the row, so no step shuffles.

The trees learn from base spans written in ways the base patterns miss (no '+', '[at]', dots), put
back into their own texts, and from look-alikes: the same spans made invalid, dates, article numbers
and the invalid candidates of the texts themselves.  All documents teach: their examples are counted by
feature values, and the trees and thresholds come from sums over these counts.

The patterns below take a run of characters whole (possessive) and start only where a run starts or
the last match ended; they match what the plain patterns match, in time linear in the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm import boosting
from stationflow.llm.common import fixed, fresh_name

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried at all.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x200-9-]{13}",
    "phone": r"\+[0-9]",
}
_OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"

# Generators: wider than the base patterns, overlapping between kinds.
_AT = r"[(\[](?i:at)[)\]]"
_DOT = r"[(\[](?:\.|(?i:dot))[)\]]"
_LABELS = r"[\p{L}\p{N}](?:[\p{L}\p{N}._-]{0,188}[\p{L}\p{N}])?"
PROPOSE = {
    "email": rf"[^\s@<>\"',;()\[\]]{{1,64}}(?:@|\x20?{_AT}\x20?){_LABELS}(?:\x20?{_DOT}\x20?{_LABELS}){{0,4}}",
    "ip": rf"[0-9]{{1,6}}(?:(?:[.:]|\x20?{_DOT}\x20?)[0-9]{{1,6}}){{2,7}}",
    "card": r"[0-9](?:[\x20.-]{0,2}[0-9]){11,22}",
    "phone": r"[+(]?[0-9](?:[\x20().0-9/-]{5,24})[0-9]",
}
PROPOSE_NEEDS = {
    "email": rf"@|{_AT}",
    "ip": rf"[0-9](?:[.:]|\x20?{_DOT}\x20?)[0-9]",
    "card": r"[0-9][\x20.0-9-]{11}",
    "phone": r"[0-9][\x20().0-9/-]{5}",
}
CONTEXT = 24
_HINTS = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|host|server|address",
    "card": r"(?i)card|visa|credit|payment",
    "phone": r"(?i)tel|phone|fax|call|mobile",
}

# Elements of a list folded together, and characters of a page of a text.
RUN = 256
PAGE = 1024
FIT_TREES = 20
# A threshold is used only if this share of the unseen candidates above it is genuine, by at least this many.
PRECISION = 0.99
LEAST_CANDIDATES = 20
# The text kept around a base span that is rewritten for the fit.
AROUND = CONTEXT + 8


def _blocks(array: Column, size: int = RUN) -> Column:
    """The array in runs of ``size`` elements; none of an empty array."""
    firsts = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.greatest(F.size(array) - 1, F.lit(0)), F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(firsts, lambda at: F.slice(array, at + 1, size))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, combine) -> Column:
    """Running combination of a list of integers, each place included.

    A fold that appends copies the list each time, so the list is folded in blocks, and the blocks'
    own ends likewise; the time is the list's length times that of a block.
    """
    none = F.array().cast("array<int>")

    def folded(block: Column) -> Column:
        append = lambda acc, v: F.concat(acc, F.array(F.when(F.size(acc) > 0, combine(F.element_at(acc, -1), v)).otherwise(v)))
        return F.aggregate(block, none, append)

    def joined(parts: Column) -> Column:
        ends = folded(F.transform(parts, lambda p: F.element_at(p, -1)))
        return _bound(ends, lambda e: F.flatten(F.transform(parts, lambda p, n: F.when(n == 0, p).otherwise(F.transform(p, lambda v: combine(v, F.get(e, n - 1)))))))

    # The list is bound first, as each block would otherwise compute all of it.
    return _bound(values, lambda v: _bound(F.transform(_blocks(v), folded), joined))


def _spans(text: Column, matches: Column, pieces: Column, kind: str) -> Column:
    """Array of ``start, stop, kind, hit`` for all matches; places from the lengths of what lies around them."""
    steps = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m))
    span = lambda stop, hit: F.struct(
        (stop - F.length(hit)).alias("start"), stop.alias("stop"), F.lit(KINDS.index(kind)).alias("kind"), hit.alias("hit")
    )
    return F.zip_with(_running(steps, lambda a, b: a + b), matches, span)


def _pages(body: Column) -> Column:
    """The text in pages of ``PAGE`` characters: a part of it is then found without going through what lies before."""
    return F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))


def _part(pages: Column, start: Column, stop: Column) -> Column:
    """The characters from ``start`` up to ``stop``."""
    first, last = F.floor(start / PAGE).cast("int"), F.floor(stop / PAGE).cast("int")
    return F.substring(F.array_join(F.slice(pages, first + 1, last - first + 1), ""), start - first * PAGE + 1, F.greatest(stop - start, F.lit(0)))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a digit string holds."""
    backwards = F.reverse(digits)
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    value = lambda i: F.substring(backwards, i, F.lit(1)).cast("int")
    doubled = lambda v: F.when(v > 4, 2 * v - 9).otherwise(2 * v)
    worth = F.transform(places, lambda i: F.when(i % 2 == 0, doubled(value(i))).otherwise(value(i)))
    return F.coalesce(F.aggregate(worth, F.lit(0), lambda a, v: a + v) % 10 == 0, F.lit(False))


def _valid(kind: str, hit: Column) -> Column:
    digits = _digits(hit)
    match kind:
        case "ip":
            return hit.rlike(_OCTETS)
        case "card":
            return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
        case "phone":
            return F.length(digits).between(10, 15)
    return F.lit(True)


def _found(rows: DataFrame, patterns: dict[str, str], needs: dict[str, str], into: dict[str, str]) -> DataFrame:
    """``rows`` (with column ``body``) and one span array per kind."""
    carried = list(rows.columns)
    empty = F.array().cast("array<string>")
    where = {k: F.col("body").rlike(needs[k]) for k in KINDS}
    # Matches and pieces are columns of their own, so that each is computed once.
    rows = rows.select(
        *carried,
        *(F.when(where[k], F.regexp_extract_all("body", F.lit(patterns[k]), F.lit(0))).otherwise(empty).alias(f"m_{k}") for k in KINDS),
    )
    rows = rows.select(
        "*", *(F.when(F.size(f"m_{k}") > 0, F.split("body", patterns[k], -1)).otherwise(empty).alias(f"p_{k}") for k in KINDS)
    )
    spans = {k: F.when(F.size(f"m_{k}") > 0, _spans(F.col("body"), F.col(f"m_{k}"), F.col(f"p_{k}"), k)) for k in KINDS}
    none = F.array().cast("array<struct<start:int,stop:int,kind:int,hit:string>>")
    return rows.select(*carried, *(F.coalesce(spans[k], none).alias(into[k]) for k in KINDS))


def _base(rows: DataFrame) -> DataFrame:
    """Adds ``b_<kind>``: valid base spans by place."""
    names = {k: f"r_{k}" for k in KINDS}
    rows = _found(rows, BASE, NEEDS, names)
    kept = [c for c in rows.columns if c not in names.values()]

    def checked(kind: str) -> Column:
        return F.filter(f"r_{kind}", lambda s: _valid(kind, s["hit"]))

    return rows.select(*kept, *(checked(k).alias(f"b_{k}") for k in KINDS))


FEATURES = (
    "kind", "length", "n_digits", "n_separators", "n_dots", "has_plus", "has_bracket", "luhn", "octets",
    "letters", "at_signs", "longest_digits", "before_joined", "after_joined", "hinted", "first_digits", "starts_00", "host_dots",
)


def _features(pages: Column, span: Column) -> list[Column]:
    """Format and context features of a candidate, as doubles."""
    hit, kind = span["hit"], span["kind"]
    digits = _digits(hit)
    before = _part(pages, F.greatest(span["start"] - CONTEXT, F.lit(0)), span["start"])
    after = _part(pages, span["stop"], span["stop"] + 1)
    count = lambda pattern: F.length(F.regexp_replace(hit, pattern, ""))
    hinted = F.when(kind == 0, before.rlike(_HINTS["email"]))
    for n, name in enumerate(KINDS[1:], 1):
        hinted = hinted.when(kind == n, before.rlike(_HINTS[name]))
    values = (
        kind, F.length(hit), F.length(digits), count(r"[^\x20().:/-]"), count(r"[^.]"), hit.startswith("+"),
        F.contains(hit, F.lit("(")), F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False),
        F.regexp_replace(hit, rf"\x20?{_DOT}\x20?", ".").rlike(_OCTETS),
        count(r"[^A-Za-z]"), count(r"[^@]"),
        F.array_max(F.transform(F.split(hit, "[^0-9]+"), lambda part: F.length(part))),
        before.rlike(r"[A-Za-z0-9_.+%-]$"), after.rlike(r"[A-Za-z0-9_]"), hinted,
        F.length(F.regexp_extract(hit, "^[^0-9]*([0-9]*)", 1)), hit.startswith("00"),
        F.regexp_count(F.regexp_extract(hit, rf"(?:@|{_AT})(.*)$", 1), F.lit(rf"{_DOT}|\.")),
    )
    return [F.coalesce(v.cast("double"), F.lit(0.0)) for v in values]


def _overlaps(one: Column, other: Column) -> Column:
    return (one["start"] < other["stop"]) & (other["start"] < one["stop"])


def _candidates(rows: DataFrame) -> DataFrame:
    """Adds ``candidates``: proposed spans of all kinds with their features."""
    names = {k: f"c_{k}" for k in KINDS}
    rows = _found(rows, PROPOSE, PROPOSE_NEEDS, names)
    kept = [c for c in rows.columns if c not in names.values()]
    rows = rows.select(*kept, F.concat(*names.values()).alias("proposed"))
    rows = rows.select("*", F.when(F.size("proposed") > 0, _pages(F.col("body"))).otherwise(F.array().cast("array<string>")).alias("pages"))
    described = F.transform(
        "proposed",
        lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"), F.array(*_features(F.col("pages"), s)).alias("x")),
    )
    return rows.select(*kept, described.alias("candidates"))


def _free(base: Column) -> Column:
    """The candidates that overlap none of the base spans, by place.

    All spans are sorted by start; one overlaps a base span if a base span before it reaches past its
    start or one after it starts before its end, so a running maximum and minimum answer for all.
    """
    kinds = "array<struct<start:int,own:boolean,stop:int,kind:int,x:array<double>>>"
    bare = F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(False).alias("own"), b["stop"].alias("stop"), b["kind"].alias("kind"), F.lit(None).cast("array<double>").alias("x"))).cast(kinds)
    own = F.transform("candidates", lambda c: F.struct(c["start"].alias("start"), F.lit(True).alias("own"), c["stop"].alias("stop"), c["kind"].alias("kind"), c["x"].alias("x"))).cast(kinds)
    most = 2**31 - 1

    def apart(spans_: Column) -> Column:
        reach = _running(F.transform(spans_, lambda e: F.when(e["own"], -1).otherwise(e["stop"])), F.greatest)
        following = F.reverse(_running(F.reverse(F.transform(spans_, lambda e: F.when(e["own"], most).otherwise(e["start"]))), F.least))
        marked = F.zip_with(spans_, F.zip_with(reach, following, lambda r, n: F.struct(r.alias("reach"), n.alias("next"))), lambda e, m: F.struct(e.alias("e"), m.alias("m")))
        clear = F.filter(marked, lambda z: z["e"]["own"] & (z["m"]["reach"] <= z["e"]["start"]) & (z["m"]["next"] >= z["e"]["stop"]))
        return F.transform(clear, lambda z: F.struct(z["e"]["start"].alias("start"), z["e"]["stop"].alias("stop"), z["e"]["kind"].alias("kind"), z["e"]["x"].alias("x")))

    # Texts without base spans, which are most, need no sweep.
    swept = _bound(F.sort_array(F.concat(bare, own)), apart)
    return F.when((F.size("candidates") > 0) & (F.size(base) > 0), swept).otherwise(
        F.transform("candidates", lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind"), c["x"].alias("x")))
    )


@dataclass(frozen=True)
class Judge:
    """Trees and threshold of each kind; None for a kind that adds nothing."""

    forests: tuple[boosting.Forest | None, ...]
    thresholds: tuple[float | None, ...]


def _threshold(score: np.ndarray, n: np.ndarray, genuine: np.ndarray) -> float | None:
    """The lowest margin of a genuine unseen candidate above which they are genuine often enough.

    ``score`` has each margin once, ``n`` and ``genuine`` the candidates of that margin.
    """
    order = np.argsort(-score)
    score, rows, hits = score[order], np.cumsum(n[order]), np.cumsum(genuine[order])
    fits = (rows >= LEAST_CANDIDATES) & (hits >= PRECISION * rows)
    if not fits.any():
        return None
    # A lower margin that adds look-alikes only would use up the share of error for nothing.
    lowest = score[np.nonzero(fits)[0][-1]]
    return float(score[(genuine[order] > 0) & (score >= lowest)][-1])


def _rewritten(kind: str, hit: Column) -> tuple[list[Column], list[Column]]:
    """A base span in forms that the base pattern misses, and look-alikes of these forms."""
    digits, swap = _digits(hit), lambda pattern, by: F.regexp_replace(hit, pattern, by)
    match kind:
        case "email":
            local, host = F.regexp_extract(hit, "^(.*)@", 1), F.regexp_extract(hit, "@(.*)$", 1)
            ats, dots = (" [at] ", "[at]", " (at) ", "(at)"), (".", " [dot] ", "(dot)")
            spelled = [F.concat(local, F.lit(a), F.regexp_replace(host, r"\.", d)) for a in ats for d in dots]
            bare = F.regexp_extract(host, r"^[^.]*", 0)
            return spelled, [F.concat(local, F.lit(a), bare) for a in (*ats, "@")]
        case "ip":
            marks = ("[.]", " [.] ", "(.)", "[dot]", " (dot) ")
            wrong = [F.concat(F.lit("7"), F.lpad(F.regexp_extract(hit, "^[0-9]+", 0), 3, "0"), F.regexp_extract(swap(r"\.", m), "^[0-9]+(.*)$", 1)) for m in marks]
            return [swap(r"\.", m) for m in marks], [*wrong, swap(r"\.[0-9]+$", ""), F.regexp_replace(swap(r"\.[0-9]+$", ""), r"\.", ":"), swap(r"\.", ":")]
        case "card":
            # The last digit counts once, so any other one breaks the check sum.
            last = (F.substring(digits, -1, 1).cast("int") + 1) % 10
            broken = F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), last.cast("string"))
            grouped = lambda d, by: F.regexp_replace(d, "([0-9]{4})(?=[0-9])", f"$1{by}")
            return [grouped(digits, by) for by in (".", "  ", "--", " -", ". ")], [grouped(broken, by) for by in (".", "  ", "--", " -", ". ", " ")]
    plain = swap(r"^\+", "")
    apart = lambda by: F.when(plain.rlike("[^0-9]"), F.regexp_replace(plain, "[^0-9]+", by))
    national = F.regexp_extract(plain, r"^[0-9]{1,3}[\x20.-]+(.*)$", 1)
    forms = [
        F.when(plain.rlike("[^0-9]"), plain), F.concat(F.lit("00"), plain), F.concat(F.lit("00"), digits), apart("."), apart("-"), apart(" "),
        *(F.when(F.length(_digits(n)) >= 10, n) for n in (national, F.concat(F.lit("0"), national), F.regexp_replace(F.regexp_replace(national, "^[^0-9]+", ""), "[^0-9]+", "."))),
    ]
    # Every form again with too few and too many digits.
    short = [F.regexp_replace(f, r"[\x20().-]*[0-9]+$", "") for f in (forms[0], forms[3], forms[4], forms[5])]
    long = [F.concat(f, F.lit(by), F.substring(digits, 1, 6)) for f, by in ((forms[0], "-"), (forms[3], "."), (forms[5], " "))]
    d = lambda at, n: F.substring(digits, at, n)
    dates = [F.concat(F.lit("20"), d(2, 2), F.lit(by), F.lit("0"), d(5, 1), F.lit(by), F.lit("1"), d(6, 1)) for by in "-./"]
    dates += [F.concat(F.lit("1"), d(6, 1), F.lit(by), F.lit("0"), d(5, 1), F.lit(by), F.lit("20"), d(2, 2)) for by in "-./"]
    timed = [F.concat(dates[n], F.lit(" 1"), d(4, 1), F.lit(tail)) for n in (0, 1, 3, 4) for tail in (":30", ".30", ".30.15")]
    article = [F.concat(F.lit("978-"), d(2, 1), F.lit("-"), d(3, 2), F.lit("-"), d(5, 6), F.lit("-"), d(4, 1))]
    return forms, [*short, *long, *dates, *timed, *article, digits]


def _evident(c: Column) -> Column:
    """Whether a free candidate of a text is valid by itself, so that it is no example of a look-alike."""
    x = lambda name: c["x"][FEATURES.index(name)]
    return (
        F.when(c["kind"] == KINDS.index("email"), x("host_dots") > 0)
        .when(c["kind"] == KINDS.index("ip"), x("octets") > 0)
        .when(c["kind"] == KINDS.index("card"), (x("luhn") > 0) & ((x("n_separators") > 0) | (x("hinted") > 0)))
        .otherwise(x("n_digits").between(10, 15) & ((x("n_separators") > 1) | (x("starts_00") > 0) | (x("hinted") > 0)))
    )


def _taught(based: DataFrame) -> DataFrame:
    """Candidates ``key, x, y`` of the texts that overlap no base span: look-alikes, then rewritten spans."""
    base = F.concat(*(f"b_{k}" for k in KINDS))
    example = lambda c, y: F.struct(c["x"].alias("x"), y.alias("y"))

    texts = _candidates(based)
    alike = F.transform(F.filter(_free(base), lambda c: ~_evident(c)), lambda c: example(c, F.lit(False)))
    told = texts.select("key", F.explode(alike).alias("c"))

    # Spans leave their text before they are rewritten, each with what lies around it.
    some = based.where(F.size(base) > 0).select("key", base.alias("found"), _pages(F.col("body")).alias("pages"), F.length("body").alias("until"))
    around = lambda s: F.struct(
        s["kind"].alias("kind"),
        _part(F.col("pages"), F.greatest(s["start"] - AROUND, F.lit(0)), s["start"]).alias("before"),
        s["hit"].alias("hit"),
        _part(F.col("pages"), s["stop"], F.least(s["stop"] + AROUND, F.col("until"))).alias("after"),
    )
    lone = some.select("key", F.explode(F.transform("found", around)).alias("s"))

    def rewritten(kind: str) -> Column:
        # Within a lambda the many forms are not compiled into the stage's code.
        def forms(s: Column) -> Column:
            genuine, wrong = _rewritten(kind, s["hit"])
            own = lambda hit, y: F.struct(s["kind"].alias("kind"), F.lit(y).alias("y"), s["before"].alias("before"), hit.alias("hit"), s["after"].alias("after"))
            return F.array(*(own(hit, True) for hit in genuine), *(own(hit, False) for hit in wrong))

        return F.flatten(F.transform(F.filter(F.array("s"), lambda s: s["kind"] == KINDS.index(kind)), forms))

    rows = lone.select("key", F.explode(F.concat(*(rewritten(k) for k in KINDS))).alias("form")).select("key", "form.*")
    rows = rows.where(F.length("hit") > 0).select(
        "key", "kind", "y", F.length("before").alias("start"),
        (F.length("before") + F.length("hit")).alias("stop"), F.concat("before", "hit", "after").alias("body"),
    )
    rows = _candidates(_base(rows))
    here = F.filter(_free(base), lambda c: (c["start"] < F.col("stop")) & (F.col("start") < c["stop"]))
    exact = lambda c: (c["kind"] == F.col("kind")) & (c["start"] == F.col("start")) & (c["stop"] == F.col("stop"))
    # A candidate of the right kind that is more or less than the span is no example of either.
    clear = F.filter(here, lambda c: ~F.col("y") | exact(c) | (c["kind"] != F.col("kind")))
    return told.unionByName(rows.select("key", F.explode(F.transform(clear, lambda c: example(c, F.col("y") & exact(c)))).alias("c")))


def learn(docs: DataFrame) -> Judge | None:
    """Fit on the candidates of all documents.

    Only candidates that overlap no base span teach, as only these can be added: base spans in
    other forms are genuine, look-alikes are not.  Two thirds of the documents fit the trees and one
    third sets the thresholds; a kind with too few candidates, or none precise enough, adds no spans.

    Texts stay in their tasks: equal examples are counted together before the shuffle, and the driver
    gets sums by node and feature value, and counts by margin.
    """
    # Rows of one id are all in the same part; rows without an id count as one id.
    key = F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("key")
    told = _taught(_base(docs.select(key, F.coalesce("text", F.lit("")).alias("body"))))
    x = F.col("c")["x"].cast("array<int>")
    told = told.select(x[0].alias("part"), x.alias("x"), F.col("c")["y"].alias("y"), (F.col("key") == 2).alias("unseen"))
    genuine = F.sum(F.when(F.col("y"), 1).otherwise(0))
    counted = fixed(told.groupBy("part", "x", "unseen").agg(F.count("*").alias("n"), genuine.alias("genuine")), "examples")
    if counted.isEmpty():
        return None
    fitted = boosting.fit_parts(counted, trees=FIT_TREES)
    thresholds = {k: _threshold(*unseen) for k, (_, *unseen) in fitted.items()}
    judged = [thresholds.get(k) for k in range(len(KINDS))]
    return Judge(tuple(fitted[k][0] if t is not None else None for k, t in enumerate(judged)), tuple(judged))


def _selected(rows: DataFrame, judge: Judge | None) -> DataFrame:
    """Adds ``added``: candidates above their kind's threshold that overlap no base span, best first, none overlapping."""
    bare = "array<struct<start:int,stop:int,kind:int>>"
    if judge is None or all(t is None for t in judge.thresholds):
        return rows.withColumn("added", F.array().cast(bare))
    carried = list(rows.columns)
    rows = _candidates(rows)
    base = F.concat(*(f"b_{k}" for k in KINDS))
    rows = rows.select(*carried, _free(base).alias("free"))

    def score(c: Column) -> Column:
        found = F.lit(None).cast("double")
        for k, forest in enumerate(judge.forests):
            if forest is not None:
                found = F.when(c["kind"] == k, forest.margin_sql([c["x"][n] for n in range(len(FEATURES))])).otherwise(found)
        return found

    scored = F.transform("free", lambda c: F.struct((-score(c)).alias("rank"), c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind")))
    rows = rows.select(*carried, scored.alias("scored"))
    passes = lambda c: F.exists(
        F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(t).alias("least")) for k, t in enumerate(judge.thresholds) if t is not None)),
        lambda t: (t["kind"] == c["kind"]) & (-c["rank"] >= t["least"]),
    )
    # Candidates that overlap, one after the other, are chosen among by themselves.
    place = lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind"), c["rank"].alias("rank"))
    rows = rows.select(*carried, F.sort_array(F.transform(F.filter("scored", passes), place)).alias("good"))

    def chosen(cluster: Column) -> Column:
        best = F.sort_array(F.transform(cluster, lambda c: F.struct(c["rank"].alias("rank"), c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind"))))
        return F.aggregate(
            best,
            F.array().cast(bare),
            lambda acc, c: F.when(F.exists(acc, lambda a: _overlaps(a, c)), acc).otherwise(
                F.concat(acc, F.array(F.struct(c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind"))))
            ),
        )

    return rows.select(*carried, F.flatten(F.transform(_clusters(F.col("good")), chosen)).alias("added"))


def _clusters(spans_: Column) -> Column:
    """Spans sorted by start, in groups that overlap one after the other."""
    stops = F.transform(spans_, lambda s: s["stop"])

    def parted(reach: Column) -> Column:
        places = F.filter(F.transform(spans_, lambda s, n: F.when((n == 0) | (F.get(reach, n - 1) <= s["start"]), n)), lambda n: n.isNotNull())
        return _bound(places, lambda p: F.transform(p, lambda at, n: F.slice(spans_, at + 1, F.coalesce(F.get(p, n + 1), F.size(spans_)) - at)))

    return F.when(F.size(spans_) > 0, _bound(_running(stops, F.greatest), parted)).otherwise(F.array(spans_))


def _ordered(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    return F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))


def _joined(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*(F.lit(k) for k in KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def spans(docs: DataFrame, judge: Judge | None, carry: list[str], body: str = "body") -> DataFrame:
    """The columns ``carry``, the text as ``body``, base spans ``b_<kind>``, all base spans ``base`` and ``every`` span."""
    rows = docs.select(*carry, F.coalesce("text", F.lit("")).alias("body"))
    rows = _selected(_base(rows), judge)
    base = F.concat(*(f"b_{k}" for k in KINDS))
    rows = rows.select("*", _ordered(base).alias("base"))
    bare = lambda a: F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    return rows.select("*", _ordered(F.concat(bare(base), F.col("added"))).alias("every"))


def find(docs: DataFrame, judge: Judge | None = None) -> DataFrame:
    """One row per document: id, base counts per kind, digest of the base spans, all spans as text.

    Places count code points from zero, ends exclusive.  A null or empty text has no spans, whose
    digest is that of the empty string.  Repeated rows give repeated result rows, an empty table none.
    """
    rows = spans(docs, judge, ["doc_id"])
    return rows.select(
        "doc_id",
        *(F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("every")).alias("spans"),
    )


def redact(docs: DataFrame, judge: Judge | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets and ``n_chars``, if there, counted again.

    Overlapping spans become one, named after the first.  Null texts stay null, texts without spans
    and all other columns stay as they are.
    """
    carry = {name: fresh_name(docs, f"own_{name}") for name in docs.columns}
    plain = docs.select("text", *(F.col(f"`{n}`").alias(c) for n, c in carry.items()))
    rows = spans(plain, judge, list(carry.values()))
    # Spans that overlap one after the other become one.
    whole = lambda c: F.struct(
        F.element_at(c, 1)["start"].alias("start"), F.array_max(F.transform(c, lambda s: s["stop"])).alias("stop"), F.element_at(c, 1)["kind"].alias("kind")
    )
    placed = F.transform("every", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    merged = F.when(F.size("every") > 0, F.transform(_clusters(F.col("placed")), whole)).otherwise(F.array().cast("array<struct<start:int,stop:int,kind:int>>"))
    rows = rows.select(*carry.values(), "body", "every", placed.alias("placed")).select(*carry.values(), "body", merged.alias("merged"))
    mark = lambda s: F.element_at(F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS)), s["kind"] + 1)

    def cleaned(pages: Column) -> Column:
        before = lambda n: F.when(n == 0, 0).otherwise(F.get("merged", n - 1)["stop"])
        kept = F.transform("merged", lambda s, n: F.concat(_part(pages, before(n), s["start"]), mark(s)))
        return F.concat(F.array_join(kept, ""), _part(pages, F.element_at("merged", -1)["stop"], F.length("body")))

    clean = _bound(_pages(F.col("body")), cleaned)
    own_text = F.col(carry["text"])
    rows = rows.select(*carry.values(), F.when(own_text.isNull() | (F.size("merged") == 0), own_text).otherwise(clean).alias("clean"))
    changed = {"text": F.col("clean")}
    if "n_chars" in carry:
        kind = docs.schema["n_chars"].dataType
        counted = F.length("clean").cast(kind)
        changed["n_chars"] = F.when(F.col("clean").eqNullSafe(own_text), F.col(carry["n_chars"])).otherwise(counted)
    return rows.select(*(changed.get(n, F.col(c)).alias(n) for n, c in carry.items()))

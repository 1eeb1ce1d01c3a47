"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

Two first-order models over characters, one of random strings and one of ordinary
identifiers, are trained by counting adjacent characters in labelled samples: what the
fixed patterns find in the corpus is random, words of documents drawn by hash, and identifiers put
together from them, are ordinary. A
string of the right make is a find when its log-likelihood ratio per character is high. Each
model mixes its transitions with single characters, evenly likely ones for random strings, so
that transitions never seen say little. Counting is a grouped sum with at most one row per
pair of characters; the trained ratios are one literal of a few kilobytes.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import stage, words

#: Patterns of the kinds, the group that holds the secret, its least length. Runs shorter than
#: the least length of access keys and hex strings cannot hide a longer one.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
RANDOM = "random"
#: What the models may judge: runs of these characters. "=" pads the
#: end of one; before one it parts a name from its value.
STRING = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
#: Strings of at least so many characters with a letter and a digit have the lower threshold; others
#: have the higher one, and those that repeat a character like lines and drawn-out words are no secrets.
LONG, DRAWN_OUT = 20, r"(.)\1{3}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: Values of an array that are summed up one by one.
BLOCK = 128
#: Ratios are kept as whole steps above the least one.
STEP, OFFSET = 0.001, 32.0


@dataclass(frozen=True)
class Models:
    """Weights of transitions against single characters, the least ratio per character of long
    mixed strings and of others, and about how many documents give ordinary words of at least
    ``word_length`` characters."""

    transitions: float = 0.7
    threshold: float = 0.4
    short_threshold: float = 0.6
    sample_docs: int = 5_000
    word_length: int = 6


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, neutral: int, step: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of longs what ``step`` has made of ``neutral`` and all values before it.

    Appending to an array copies it, so values are taken in blocks: what each block makes of
    ``neutral`` is carried over the blocks, and from there value by value inside each. ``step``
    must be associative, with ``neutral`` as its neutral value.
    """
    start = F.lit(neutral).cast("bigint")

    def within(some: Column, first: Column) -> Column:
        state = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out"))

        def add(s: Column, x: Column) -> Column:
            return F.struct(step(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))

        return F.aggregate(some, state, add)["out"]

    def blocks(v: Column) -> Column:
        last = F.greatest(F.ceil(F.size(v) / BLOCK) - 1, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda j: F.slice(v, j * BLOCK + 1, F.lit(BLOCK)))

    def carried(parts: Column) -> Column:
        made = F.transform(parts, lambda part: F.aggregate(part, start, step))
        return F.flatten(F.zip_with(parts, within(made, start), within))

    return bound(bound(values, blocks), carried)


NEVER = 2**62


def located(text: Column, pattern: str, group: int) -> Column:
    """Matches in order as ``(start, end, value)`` in code points, by the lengths of the
    matches and of the gaps between them."""
    found = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap).cast("bigint")).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.length(m).cast("bigint")).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )

    def spans(every: Column) -> Column:
        before = running(F.transform(every, lambda x: x["gap"] + x["match"]), 0, lambda x, y: x + y)
        return F.zip_with(every, before, span)

    def span(x: Column, at: Column) -> Column:
        start = (at + x["gap"]).cast("int")
        end = (at + x["gap"] + x["match"]).cast("int")
        return F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    # behind the last match is one more gap
    return F.when(text.rlike(pattern), bound(F.filter(found, lambda x: x["match"].isNotNull()), spans)).otherwise(none)


def apart(strings: Column, base: Column) -> Column:
    """The strings that overlap no base find, both by ``start``: of those before, none reaches
    beyond a string's start, and the next begins at its end or later."""
    event = lambda x, kind, value: F.struct(
        x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), value.alias("value")
    )
    finds = F.transform(base, lambda x: event(x, 0, F.lit("")))
    events = F.array_sort(F.concat(finds, F.transform(strings, lambda x: event(x, 1, x["value"]))))

    def free(every: Column) -> Column:
        ends = F.transform(every, lambda x: F.when(x["kind"] == 0, x["end"].cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        begins = F.transform(F.reverse(every), lambda x: F.when(x["kind"] == 0, x["start"].cast("bigint")).otherwise(F.lit(NEVER)))
        reach, following = running(ends, 0, lambda a, b: F.greatest(a, b)), F.reverse(running(begins, NEVER, lambda a, b: F.least(a, b)))
        around = F.arrays_zip(every.alias("x"), reach.alias("reach"), following.alias("next"))
        inside = lambda z: (z["x"]["kind"] == 1) & (z["reach"] <= z["x"]["start"]) & (z["next"] >= z["x"]["end"])
        return F.transform(F.filter(around, inside), lambda z: span(z["x"]))

    span = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"))
    return bound(events, free)


def _base(text: Column) -> Column:
    """All base finds: ``(start, kind, end, value)`` by start, then kind as listed."""

    def finds(kind: int, pattern: str, group: int, least: int) -> Column:
        fit = F.filter(located(text, pattern, group), lambda x: F.length(x["value"]) >= least)
        return F.transform(fit, lambda x: _find(x, kind))

    return F.array_sort(F.concat(*(finds(k, p, group, least) for k, (_, p, group, least) in enumerate(BASE))))


def _find(x: Column, kind: int) -> Column:
    return F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["value"].alias("value"))


def _of_kind(kind: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def _usual(value: Column) -> Column:
    return (F.length(value) >= LONG) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def scanned(docs: DataFrame, models: Models) -> DataFrame:
    """Per document ``base``, its base finds, ``strings``, what the models may judge, and
    ``ordinary``, words of the documents that are drawn for training."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    total = docs.count()
    part = min(1.0, models.sample_docs / total) if total else 0.0
    drawn = F.xxhash64(F.lit("ordinary"), "doc_id", F.length("__text")).cast("double") / 2.0**64 + 0.5 < part
    fit = lambda x: _usual(x["value"]) | ~x["value"].rlike(DRAWN_OUT)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("__text"))
    rows = rows.withColumns(
        {
            "base": _base(F.col("__text")),
            "strings": F.filter(located(F.col("__text"), STRING, 0), fit),
            "ordinary": F.when(
                drawn,
                F.filter(words(F.col("__text")), lambda w: w.rlike(rf"^[A-Za-z0-9_-]{{{models.word_length},}}$")),
            ),
        }
    )
    # an ordinary word is no part of a base find
    found = F.transform("base", lambda b: b["value"])
    plain = F.filter("ordinary", lambda w: ~F.array_contains(found, w) & ~w.rlike("[0-9a-f]{32,}|AKIA[A-Z0-9]{12,}"))
    return rows.withColumn("ordinary", plain).drop("__text")


def _pairs(strings: DataFrame) -> dict[tuple[str, str], int]:
    """Counts of adjacent characters of a column ``value``: a row for each pair there is."""
    at = F.explode(F.sequence(F.lit(1), F.length("value") - 1))
    pairs = strings.where(F.length("value") > 1).select(F.col("value"), at.alias("at"))
    pair = F.expr("substring(value, at, 2)")
    counted = pairs.groupBy(pair.alias("pair")).count().where(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
    return {(r["pair"][0], r["pair"][1]): r["count"] for r in counted.collect()}


def _transitions(pairs: dict[tuple[str, str], int], even: bool, weight: float) -> dict[tuple[str, str], float]:
    """Log probabilities of every character after every other."""
    after = dict.fromkeys(ALPHABET, 0)
    into = dict.fromkeys(ALPHABET, 0)
    for (a, b), n in pairs.items():
        after[a] += n
        into[b] += n
    total, size = sum(into.values()), len(ALPHABET)
    out = {}
    for a in ALPHABET:
        for b in ALPHABET:
            single = 1 / size if even else (into[b] + 1) / (total + size)
            seen = (pairs.get((a, b), 0) + single) / (after[a] + 1)
            out[a, b] = math.log(weight * seen + (1 - weight) * single)
    return out


def _identifiers(word: Column, n: Column) -> Column:
    """A word, and identifiers made of it and its neighbour as programmers do."""
    after = F.coalesce(F.get("ordinary", n + 1), word)
    joined = [F.concat_ws(mark, word, after) for mark in ("_", "-", "/")]
    number = (n % 100).cast("string")
    return F.array(
        word, *joined, F.upper(joined[0]), F.concat(word, F.initcap(after)), F.concat(word, number), F.concat_ws("_", word, F.lit("v"), number)
    )


def train(rows: DataFrame, models: Models = Models()) -> bytes:
    """Log-likelihood ratios of random to ordinary, two bytes for each pair of characters of
    ``ALPHABET``: that many ``STEP`` above ``-OFFSET``."""
    random = _pairs(rows.select(F.explode("base").alias("b")).select(F.col("b.value").alias("value")))
    ordinary = _pairs(rows.select(F.explode(F.flatten(F.transform("ordinary", _identifiers))).alias("value")))
    p, q = _transitions(random, True, models.transitions), _transitions(ordinary, False, models.transitions)
    steps = (round((p[a, b] - q[a, b] + OFFSET) / STEP) for a in ALPHABET for b in ALPHABET)
    return b"".join(min(max(n, 0), 65535).to_bytes(2, "big") for n in steps)


def mean_ratio(value: Column, ratios: bytes) -> Column:
    """Log-likelihood ratio per transition of strings of at least two of the characters."""
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def ratio(a: Column, b: Column) -> Column:
        at = 2 * (a * len(ALPHABET) + b) + 1
        return F.conv(F.hex(F.substring(F.lit(ratios), at, F.lit(2))), 16, 10).cast("long")

    n = F.length(value) - 1
    steps = F.zip_with(F.slice(places, 1, n), F.slice(places, 2, n), ratio)
    return F.aggregate(steps, F.lit(0).cast("long"), lambda x, y: x + y) * F.lit(STEP) / n - OFFSET


def scan(docs: DataFrame, models: Models = Models()) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random`` of every row of
    ``docs (doc_id, text, ...)``.

    ``spans`` lists all finds as ``kind:start:end`` by start, then kind, comma-joined; a string
    that looks random is listed where no base find overlaps it. A NULL text is an empty one:
    no finds, an empty list and its hash. Without any base find or ordinary word in the corpus
    the models know single characters only. Repeated rows stay; an empty table gives no rows;
    other columns are not looked at.
    """
    rows = stage(scanned(docs, models), "secrets")
    ratios = train(rows, models)
    least = lambda x: F.when(_usual(x["value"]), models.threshold).otherwise(models.short_threshold)
    random = F.filter("strings", lambda x: mean_ratio(x["value"], ratios) >= least(x))
    high = F.when(F.size("base") > 0, apart(random, F.col("base"))).otherwise(random)
    odd = F.transform(high, lambda x: _find(x, len(BASE)))
    names = F.array(*(F.lit(k) for k in (*(b[0] for b in BASE), RANDOM)))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    counts = {f"n_{name}": _of_kind(k) for k, (name, *_) in enumerate(BASE)}
    return rows.withColumn("odd", F.when(F.size("strings") > 0, odd).otherwise(F.slice("base", 1, 0))).select(
        "doc_id",
        *(c.alias(n) for n, c in counts.items()),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "odd"))).alias("spans"),
        F.size("odd").cast("long").alias("n_random"),
    )

"""Collocations, against counts in dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lendstrata.llm import collocations
from lendstrata.llm.queries import op13_collocations

from .cases import AWKWARD, awkward, empty, sample

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(docs: list[tuple], least: int, longest: int, top: int, pct: int) -> list[tuple]:
    by_lang = defaultdict(list)
    for lang, text in docs:
        by_lang["und" if lang is None else lang].append(text or "")
    out = []
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for text in texts:
            lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                f.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {
            p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= pct * f[p[i:j]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def got(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*NAMES).collect())


@pytest.mark.parametrize("least, longest, top, pct", [(3, 5, 1000, 100), (2, 4, 7, 70), (1, 2, 50, 100), (6, 6, 1000, 40)])
def test_invented_texts(spark, monkeypatch, least, longest, top, pct):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 3000)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 200)
    draw = random.Random(least)
    words = ["a", "B", "c", "dd", "été", "É", "x\x01", "\x1cy", "1", "the"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\x85", "!? "]
    docs = [
        (draw.choice(["en", "fr", None]), "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randrange(60))))
        for _ in range(150)
    ]
    docs += [("en", "new york city hall is new york city hall in new york")] * 9 + [("only", "x")]
    df = spark.createDataFrame([(t, lang, 1) for lang, t in docs], "text string, lang string, f int").repartition(5)
    assert got(collocations.collocations(df, least, longest, top, pct)) == plain(docs, least, longest, top, pct)


def test_the_table(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.lang, r.text) for r in sample(spark, "sf0.01").collect()]
    want = plain(docs, 100, 5, 2000, 100)
    assert len(want) > 50 and got(op13_collocations(spark, d)) == want


def test_awkward_rows(spark):
    docs = [(lang, t) for _, t, lang, _ in AWKWARD]
    assert got(collocations.collocations(awkward(spark), least=2)) == plain(docs, 2, 5, 2000, 100)
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(awkward(spark), least=10**6).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(awkward(spark), longest=1)


def test_a_pair_with_a_third_of_all_words(spark):
    text = F.when(F.col("id") % 2 == 0, F.repeat(F.lit("hot pair "), 50)).otherwise(F.concat(F.lit("cold pair number "), F.col("id").cast("string")))
    df = spark.range(4000).select(text.alias("text"), F.lit("en").alias("lang"))
    found = {r.phrase: r for r in collocations.collocations(df).collect()}
    assert found["cold pair number"].a == 2000 and "cold pair" not in found
    assert found["hot pair"].a == 2000 * 50 and "pair hot" not in found  # always in "hot pair hot"


def test_the_gate_lets_all_frequent_phrases_pass(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BIT_RANGE", (3, 3))
    phrases = [f"p{n}" for n in range(40)]
    gate = collocations.Gate(spark.createDataFrame([("en", p) for p in phrases], "lang string, phrase string"))
    assert gate.bits == 8 and gate.passed("en", [p.encode() for p in phrases]).all()
    docs = [("en", "a b c a b c d")] * 3
    df = spark.createDataFrame(docs, "lang string, text string")
    assert got(collocations.collocations(df, least=3)) == plain(docs, 3, 5, 2000, 100)


def test_products_beyond_64_bits():
    import pyarrow as pa

    big = 2**62
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"]), pa.array(["a b"]), pa.array([big]), pa.array([[big]]), pa.array([[big + 1]]), pa.array([big + 9])],
        ["lang", "phrase", "f", "heads", "tails", "n"],
    )
    (out,) = collocations._scored([batch])
    assert out.column("score").to_pylist() == [1000 * big * (big + 9) // (big * (big + 1))]

"""Lyndon arrays and periodic runs, against definitions."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from lendstrata.llm import runs
from lendstrata.llm.queries import op12_runs, with_periods

from .cases import AWKWARD, LONG, awkward, empty, rows, sample


def plain_lyndon(word: list[int]) -> list[int]:
    def is_lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))

    return [max(k for k in range(1, len(word) - i + 1) if is_lyndon(word[i : i + k])) for i in range(len(word))]


def plain_runs(words: list, least: int, power: int) -> list[tuple[int, int, int]]:
    codes, n, out = np.unique(np.array(words, dtype=object), return_inverse=True)[1], len(words), []
    for p in range(1, n // power + 1):
        same = np.concatenate([[False], codes[:-p] == codes[p:], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(turns[::2].tolist(), (turns[1::2] + p).tolist()):
            whole = codes[start:end]
            if len(whole) >= max(least, power * p) and not any((whole[q:] == whole[:-q]).all() for q in range(1, p)):
                out.append((start, end - start, p))
    return sorted(out, key=lambda run: (run[0], run[2]))


def texts(n: int, seed: int) -> list[list[int]]:
    draw, out = random.Random(seed), []
    for _ in range(n):
        letters = draw.randrange(1, 5)
        word = [draw.randrange(letters) for _ in range(draw.randrange(1, 40))]
        if draw.random() < 0.6:
            word = word[:7] + word[: draw.randrange(1, 9)] * draw.randrange(2, 12) + word[7:]
        out.append(word)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_lyndon_arrays(seed):
    for word in texts(120, seed):
        letters = np.unique(word, return_inverse=True)[1]
        assert runs.lyndon_lengths(letters).tolist() == plain_lyndon(letters.tolist())
    assert runs.lyndon_lengths(np.array([], dtype=np.int64)).tolist() == []


@pytest.mark.parametrize("least, power", [(2, 2), (6, 3), (24, 3), (5, 4), (24, 2)])
def test_runs(least, power):
    for word in texts(300, least + power):
        assert runs.find_runs(np.array(word, dtype=np.int32), least, power) == plain_runs(word, least, power)


def test_a_word_of_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert runs.find_runs(np.array(b), 4, 2) == plain_runs(b, 4, 2)


def plain_result(doc_id, text, periods=True) -> tuple:
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if periods and doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 24, 3)
    dropped = {i for s, length, p in found for i in range(s + p, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    ends = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(found), *ends, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_table(spark, sf):
    want = sorted((plain_result(r.doc_id, r.text) for r in sample(spark, sf).collect()), key=repr)
    assert sum(w[1] for w in want) > 0
    assert rows(op12_runs(spark, f"/root/testdata/{sf}"), *COLUMNS) == want


def test_awkward_rows(spark):
    got = runs.periodic_runs(awkward(spark))
    assert got.count() == len(AWKWARD)
    by_text = {r.n_words: r for r in got.collect()}
    long = by_text[150_000]
    assert [tuple(r) for r in long.runs] == [(0, 150_000, 5)] and long.collapsed == "the quick brown fox of"
    none = got.where("doc_id in (1, 2, 3)").collect()
    assert {(r.n_words, len(r.runs), r.collapsed) for r in none} == {(0, 0, "")}
    assert runs.periodic_runs(empty(spark)).count() == 0


def test_one_word_again_and_again(spark):
    data = [(1, "a " * 23), (2, "a " * 24), (3, "b " + "\ta\n" * 100_000 + " c"), (4, "a b " * 11 + "a b c")]
    got = {r.doc_id: r for r in runs.periodic_runs(spark.createDataFrame(data, "doc_id int, text string")).collect()}
    assert got[1].runs == [] and got[1].collapsed == " ".join("a" * 23)
    assert [tuple(r) for r in got[2].runs] == [(0, 24, 1)] and got[2].collapsed == "a"
    assert [tuple(r) for r in got[3].runs] == [(1, 100_000, 1)] and got[3].collapsed == "b a c"
    assert [tuple(r) for r in got[4].runs] == [(0, 24, 2)] and got[4].collapsed == "a b c"


def test_periods_are_put_in_by_id(spark):
    text = " ".join(f"w{n}" for n in range(200))
    docs = spark.createDataFrame([(n, text if n % 3 else None) for n in range(60)] + [(None, text), (None, LONG)], "doc_id long, text string")
    hit = 0
    for r in with_periods(docs).collect():
        if r.text and r.doc_id is not None:
            h = zlib.crc32(str(r.doc_id).encode())
            hit += h % 10 == 0
            assert (r.text == text) == (h % 10 != 0)
    assert hit > 0

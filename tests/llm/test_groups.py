"""SimHash, vectors and their components, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lendstrata.llm import simhash, vectors
from lendstrata.llm.components import components
from lendstrata.llm.queries import op2_simhash

from .cases import AWKWARD, awkward, empty, rows, sample


def smallest_reachable(n: int, linked) -> list[int]:
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in linked:
        label[max(root(a), root(b))] = min(root(a), root(b))
    return [root(x) for x in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(n, n + 1) for n in range(400, 440)]
    links += links[:10]
    root = smallest_reachable(500, links)
    want = sorted({(n, root[n]) for a, b in links if a != b for n in (a, b)})
    got = components(spark.createDataFrame(links, "a long, b long"), "test")
    assert sorted(map(tuple, got.collect())) == want
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_a_star_is_dealt_evenly(spark, monkeypatch):
    """The edges of a hub do not meet in one task of any join."""
    from lendstrata.llm import components as module

    star = spark.range(1, 40_001).select(F.col("id").alias("a"), F.lit(20_000).cast("long").alias("b"))
    chain = spark.range(100_000, 100_300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = star.union(chain)
    state, hubs = module._state(edges.where("a <> b"))
    (share,) = hubs.values()
    assert state[0] == 40_299 and abs(share - 0.5) < 0.02
    monkeypatch.setattr(module, "skew_join", seen := Spread(module.skew_join))
    got = components(edges, "test-star")
    assert rows(got.groupBy("component").agg(F.count("*").alias("n")), "component", "n") == [(1, 40_000), (100_000, 301)]
    members = got.withColumn("v", F.col("node") % 1000)
    low = module.lowest_of(members, "component", "v", "low")
    assert rows(low.select("component", "low").distinct(), "component", "low") == [(1, 0), (100_000, 0)]
    assert seen.largest <= 0.1


class Spread:
    """Notes the largest share of the rows of a join that one bucket of a key holds."""

    def __init__(self, join):
        self.join, self.largest = join, 0.0

    def __call__(self, left, right, on, hot_left, hot_right):
        ids = {key: share for key, share in hot_left.items() if share > 0.01}
        if ids:
            plan = self.join(left, right, on, hot_left=hot_left, hot_right=hot_right)
            text = plan._jdf.queryExecution().analyzed().toString()
            assert "_salt" in text
            buckets = min(2 ** int(np.ceil(np.log2(max(2, share * 8 * 4)))) for share in ids.values())
            self.largest = max(self.largest, max(ids.values()) / buckets)
        return self.join(left, right, on, hot_left=hot_left, hot_right=hot_right)


def plain_fingerprint(text: str | None) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(docs: list[tuple]) -> list[tuple]:
    fps = [plain_fingerprint(t) for _, t in docs]
    near = [(a, b) for a in range(len(docs)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    root = smallest_reachable(len(docs), near)
    first: dict[int, int | None] = {}
    for (i, _), r in zip(docs, root):
        ids = [x for x in (first.get(r), i) if x is not None]
        first[r] = min(ids) if ids else None
    return sorted(((i, f"{fp:016x}", first[r]) for (i, _), fp, r in zip(docs, fps, root)), key=repr)


def test_simhash_of_awkward_rows(spark):
    got = simhash.near_duplicates(awkward(spark))
    assert rows(got, "doc_id", "fingerprint", "component_id") == plain_components([(i, t) for i, t, *_ in AWKWARD])
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_simhash_of_a_table(spark):
    docs = [(r.doc_id, r.text) for r in sample(spark).collect()]
    got = op2_simhash(spark, "/root/testdata/sf0.001")
    assert rows(got, "doc_id", "fingerprint", "component_id") == plain_components(docs)


@pytest.mark.parametrize("distance", [0, 1, 4, 6])
def test_all_links_once(spark, distance):
    draw = random.Random(distance)
    centres = [draw.getrandbits(64) for _ in range(15)]
    fps = {0, 2**64 - 1, *centres}
    for c in centres:
        for _ in range(25):
            x = c
            for b in draw.sample(range(64), draw.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    signed = sorted(x - (x >> 63 << 64) for x in fps)
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= distance}
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), distance).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_keys_of_fingerprints_are_not_broadcast(spark):
    """64 keys come of each, which the sizes that Spark goes by leave out."""
    found = simhash.links(spark.range(10_000).select(F.xxhash64("id").alias("fp")), 4)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_blocks_of_a_long_text_give_the_same_fingerprint(monkeypatch):
    from lendstrata.llm import common

    text = " ".join(f"W{n % 97}" for n in range(3000))
    monkeypatch.setattr(common.word_blocks, "__defaults__", (100,))
    assert simhash.fingerprint(text.encode(), 4) % 2**64 == plain_fingerprint(text)


def test_one_row_of_each_group_stays(spark):
    got = simhash.one_of_each(awkward(spark))
    assert got.columns == awkward(spark).columns
    # NULL, empty and blank texts share fingerprint zero; equal texts are one group
    assert rows(got, "doc_id") == sorted([(1,), (4,), (5,), (7,), (8,), (9,), (None,)], key=repr)
    assert simhash.one_of_each(empty(spark)).count() == 0


def test_which_row_stays_does_not_depend_on_order(spark):
    data = [(1, "one two three", lang, source) for lang in ("en", None, "de") for source in ("b", "a", None)]
    data += [(1, "one two three", None, "a")] * 2 + [(2, "one two three", "en", "a")]
    draw, kept = random.Random(5), set()
    for _ in range(4):
        draw.shuffle(data)
        df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(draw.randrange(1, 6))
        kept.add(tuple(rows(simhash.one_of_each(df), "doc_id", "text", "lang", "source")))
    assert len(kept) == 1 and len(kept.pop()) == 1


def test_boxes_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST_ROWS", 10)
    monkeypatch.setattr(vectors, "BOX_BLOCK", 3)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(9, 24))
    data = [(n, (centres[n % 9] + draw.normal(size=24) * 0.2).tolist()) for n in range(200)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert rows(vectors.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == plain_vectors(data, 0.9)


def plain_vectors(rows_: list[tuple], threshold: float) -> list[tuple]:
    good = [
        n for n, (_, v) in enumerate(rows_) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = []
    for p, a in enumerate(good):
        for b in good[:p]:
            x, y = np.array(rows_[a][1], dtype=float), np.array(rows_[b][1], dtype=float)
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.append((a, b))
    root = smallest_reachable(len(rows_), links)
    degree = [sum(n in pair for pair in links) for n in range(len(rows_))]
    out = []
    for n, (i, _) in enumerate(rows_):
        ids = [rows_[m][0] for m in range(len(rows_)) if root[m] == root[n] and rows_[m][0] is not None]
        component = min(ids) if ids else None
        out.append((i, degree[n], component, i == component))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group_rows", [40, 8192])
def test_vectors(spark, monkeypatch, group_rows):
    monkeypatch.setattr(vectors, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(vectors, "LEAST_ROWS", min(group_rows, 512))
    monkeypatch.setattr(vectors, "TILE", 32)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 40))
    made = [(centres[n % 12] + draw.normal(size=40) * draw.choice([0.05, 0.33, 0.5])).astype(np.float32) for n in range(300)]
    data = [(n, v.tolist()) for n, v in enumerate(made)]
    data += [(300 + n, data[0][1]) for n in range(20)] + [(7, data[7][1]), (400, [2 * x for x in data[0][1]])]
    data += [(500, None), (501, []), (502, [0.0] * 40), (503, [float("nan")] * 40), (504, [None] + [1.0] * 39)]
    data += [(505, [1.0, 0.0]), (506, [1.0, 0.1]), (None, data[1][1]), (507, [float("inf")] + [1.0] * 39), (508, [5e-30, 1e-30])]
    df = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id long, embedding array<float>, kept string")
    got = rows(vectors.near_duplicates(df), "vec_id", "n_links", "component_id", "kept")
    assert got == plain_vectors(data, 0.9)


def test_vectors_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicates(df).count() == 0
    lone = spark.createDataFrame([(1, None), (1, None)], "vec_id long, embedding array<float>")
    assert rows(vectors.near_duplicates(lone), "vec_id", "n_links", "component_id", "kept") == [(1, 0, 1, True)] * 2


def test_links_at_the_threshold_count(spark):
    pairs = [(1, [3.0, 4.0]), (2, [4.0, 3.0]), (3, [1.0, 0.0]), (4, [0.9, float(np.sqrt(1 - 0.81))])]
    df = spark.createDataFrame(pairs, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df, 0.96).where(F.col("vec_id") < 3).collect()}
    assert got == {1: 1, 2: 2}  # the second is near the fourth, too

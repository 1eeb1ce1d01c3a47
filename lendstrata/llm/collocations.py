"""Phrases whose words stand together more often than by chance, by streams of counts.

Counting goes up by length, and only phrases whose parts are frequent are counted: words,
then pairs of frequent words, then phrases of up to five words all of whose pairs are frequent.
What is frequent is known to the tasks as a bitmap of bounded size; where it errs, phrases
are counted in vain and dropped by their counts. A task counts some megabytes of text in
arrays before anything is shuffled.

The counts of all lengths are then kept as two streams, one in order of the words (prefix
order), one in order of the words from the last to the first (suffix order). One pass over the
first, with a stack of the phrases that the phrase at hand begins with, gives the count of
each beginning of a phrase and of its longer phrases to the right; the same pass over the
second gives endings and longer phrases to the left. Both results, sorted by phrase, are
merged in lockstep. No table of phrases is looked up by hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import count
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import stage
from .units import slices

#: Text that a task counts at a time, and of which words are objects at a time.
SLICE_BYTES, BLOCK_BYTES = 8 << 20, 2 << 20
#: Bits of the bitmap: this many for each frequent phrase, as a power of two in this range.
BITS_PER_PHRASE, BIT_RANGE = 16, (15, 28)
LONGEST = 5

_BREAK = b"."
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + 10 * _BREAK)
_CUT = re.compile(rb"[\x20\x09-\x0D.,;:!?]")
COUNTS = "lang string, phrase string, f long"


def _blocks(texts: list[bytes]) -> Iterator[bytes]:
    """The texts with a break behind each, in blocks cut between words."""
    held, size = [], 0
    for text in texts:
        at = 0
        while len(text) - at > BLOCK_BYTES:
            gap = _CUT.search(text, at + BLOCK_BYTES)
            upto = gap.end() if gap else len(text)
            yield b"".join([*held, text[at:upto]])
            held, size, at = [], 0, upto
        held += (text[at:], _BREAK)
        size += len(text) - at
        if size >= BLOCK_BYTES:
            yield b"".join(held)
            held, size = [], 0
    yield b"".join(held)


def numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of some texts, and the texts as their numbers; 0 is a break between
    pieces."""
    known, codes = {_BREAK: 0}, []
    for block in _blocks(texts):
        words = block.translate(_PLAIN).replace(_BREAK, b" . ").split()
        fresh = [w for w in dict.fromkeys(words) if w not in known]
        known.update(zip(fresh, count(len(known))))
        codes.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    return list(known), np.concatenate(codes)


class Gate:
    """A bitmap of the hashes of frequent phrases: true for each of them, and for few others."""

    def __init__(self, frequent: DataFrame):
        """``frequent (lang, phrase)``; the bitmap has at most 2 ** 28 bits, whatever it holds."""
        low, high = BIT_RANGE
        wanted = BITS_PER_PHRASE * max(1, frequent.count())
        self.bits = 2 ** min(high, max(low, ceil(log2(wanted))))
        place = F.xxhash64("lang", "phrase").bitwiseAND(F.lit(self.bits - 1)) + 1  # buckets start at 1
        parts = (
            frequent.select(place.alias("place"))
            .groupBy(F.expr("bitmap_bucket_number(place)").alias("n"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bitmap"))
            .collect()  # as many rows of 4 kB as the bitmap has parts
        )
        self.bitmap = np.zeros((max(1, self.bits // 32768), 4096), dtype=np.uint8)
        for part in parts:
            self.bitmap[part.n - 1] = np.frombuffer(bytes(part.bitmap), np.uint8)
        self.bitmap = self.bitmap.reshape(-1)

    def passed(self, lang: str, phrases: list[bytes]) -> np.ndarray:
        seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        hashes = np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in phrases), np.uint64, len(phrases))
        places = (hashes & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.bitmap[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def _joined(names: list[bytes], rows: np.ndarray) -> list[bytes]:
    """The phrase of each row of word numbers."""
    return [b" ".join(words) for words in zip(*([names[i] for i in column] for column in rows.T.tolist()))]


def _words(lang: str, names: list[bytes], codes: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Counts of words; their number stands under an empty phrase."""
    counts = np.bincount(codes, minlength=len(names))
    counts[0] = len(codes) - counts[0]
    yield [b"", *names[1:]], counts


def _grams(codes: np.ndarray, good: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers and counts of the distinct grams of 2 to ``longest`` words whose neighbours
    are all ``good``; ``good[i]`` judges words i and i + 1."""
    places, inner = np.flatnonzero(good), codes.copy()  # the number of the gram of k - 1 words at each place
    size = int(codes.max()) + 1 if len(codes) else 1
    for k in range(2, longest + 1):
        if not len(places):
            return
        _, first, numbers, counts = np.unique(
            inner[places] * size + codes[places + k - 1], return_index=True, return_inverse=True, return_counts=True
        )
        begun = places[first]
        yield codes[begun[:, None] + np.arange(k)], counts
        inner[places] = numbers
        ahead = places + k - 1
        places = places[(ahead < len(good)) & good[np.minimum(ahead, len(good) - 1)]]


def _pairs(gate: Gate):
    """Counts of pairs of words that the gate lets pass."""

    def counted(lang: str, names: list[bytes], codes: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray]]:
        passed = gate.passed(lang, names)
        passed[0] = False
        for rows, counts in _grams(codes, passed[codes[:-1]] & passed[codes[1:]], 2):
            yield _joined(names, rows), counts

    return counted


def _longer(words: Gate, pairs: Gate, longest: int):
    """Counts of longer phrases all of whose pairs of words the gate lets pass."""

    def counted(lang: str, names: list[bytes], codes: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray]]:
        passed = words.passed(lang, names)
        passed[0] = False
        good = passed[codes[:-1]] & passed[codes[1:]]
        places = np.flatnonzero(good)
        if not len(places):
            return
        _, first, numbers = np.unique(codes[places] * len(names) + codes[places + 1], return_index=True, return_inverse=True)
        frequent = pairs.passed(lang, _joined(names, codes[places[first][:, None] + np.arange(2)]))
        good[places] = frequent[numbers]
        for rows, counts in _grams(codes, good, longest):
            if rows.shape[1] > 2:
                yield _joined(names, rows), counts

    return counted


def _counted(docs: DataFrame, counter, least: int) -> DataFrame:
    """``lang, phrase, f`` of what ``counter`` finds in ``docs (lang, text)``, from ``least`` on;
    the number of words, under an empty phrase, in any case."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, SLICE_BYTES):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts.cast(pa.large_binary()).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                for phrases, counts in counter(lang, *numbered(own)):
                    columns = [pa.repeat(lang, len(phrases)), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])

    counts = docs.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return stage(counts.where((F.col("f") >= least) | (F.col("phrase") == "")), "phrase-counts")


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, f``: how often each phrase of up to ``longest`` words occurs, from
    ``least`` times on, and the number of words of each language under an empty phrase."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )
    words = _counted(rows, _words, least)
    frequent_words = Gate(words.where("phrase <> '' and f >= %d" % least))
    pairs = _counted(rows, _pairs(frequent_words), least)
    longer = _counted(rows, _longer(frequent_words, Gate(pairs), longest), least)
    return words.union(pairs).union(longer)


def chains(counts: DataFrame, suffixes: bool = False) -> DataFrame:
    """``lang, phrase, f, parts, longer`` of the phrases of two and more words in one stream.

    ``parts`` are the counts of the phrase's first 1, 2, ... words and ``longer`` is that of its
    most frequent extension to the right, or else 0; with ``suffixes`` those of its last 1, 2,
    ... words and to the left. The stream is cut between first words, or last ones.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # phrases that the one at hand begins with: lang, words, f, longer
        done: list[tuple] = []

        def left() -> None:
            lang, words, f, longer = stack.pop()
            if stack:
                phrase = " ".join(reversed(words) if suffixes else words)
                done.append((lang, phrase, f, [shorter[2] for shorter in stack], longer))

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*done), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f", "parts", "longer"])

        for batch in batches:
            for lang, words, f in zip(*(c.to_pylist() for c in batch.columns)):
                while stack and (stack[-1][0] != lang or stack[-1][1] != words[: len(stack[-1][1])]):
                    left()
                if stack:
                    stack[-1][3] = max(stack[-1][3], f)
                stack.append([lang, words, f, 0])
            if done:
                yield batch_of()
                done.clear()
        while stack:
            left()
        if done:
            yield batch_of()

    words = F.split("phrase", " ")
    stream = counts.where("phrase <> ''").select("lang", (F.reverse(words) if suffixes else words).alias("words"), "f")
    ordered = stream.repartitionByRange("lang", F.col("words")[0]).sortWithinPartitions("lang", "words")
    return ordered.mapInArrow(run, "lang string, phrase string, f long, parts array<bigint>, longer long")


def _scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weakest cut of each phrase, in integers of any size."""
    for batch in batches:
        rows = []
        for lang, phrase, a, heads, tails, n in zip(*(c.to_pylist() for c in batch.columns)):
            score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for k, (l, r) in enumerate(zip(heads, reversed(tails))))  # noqa: E741
            rows.append((lang, phrase, a, l, r, n, score))
        if rows:
            names = ["lang", "phrase", "a", "l", "r", "n", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)


def collocations(
    docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2000, absorbed_pct: int = 100
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language of
    ``docs (text, lang, ...)`` by score, count ``a`` and phrase.

    Words are lower-case for A to Z and lie in pieces between ``.,;:!?`` and line ends; a
    language NULL is ``und``. A phrase of 2 to ``longest`` words that occurs at least ``least``
    times scores the least 1000 * a * n / (l * r) over its cuts into a beginning and a rest
    that occur ``l`` and ``r`` times among ``n`` words. One that stands inside a longer phrase
    with at least ``absorbed_pct`` percent of its occurrences is left out. NULL and empty
    texts have no words; repeated rows count each; ids and further columns are not looked at;
    an empty table, or one without frequent phrases, gives no rows.
    """
    if least < 1 or longest < 2:
        raise ValueError("phrases have two words and occur once at least")
    counts = phrase_counts(docs, least, longest)
    heads = chains(counts).withColumnsRenamed({"parts": "heads", "longer": "right"})
    tails = chains(counts, suffixes=True).select("lang", "phrase", F.col("parts").alias("tails"), F.col("longer").alias("left"))
    # a longer phrase around this one is no more frequent than its extension by one word
    alone = heads.hint("merge").join(tails, ["lang", "phrase"]).where(F.greatest("left", "right") * 100 < F.col("f") * absorbed_pct)
    sizes = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    scored = alone.join(sizes, "lang").select("lang", "phrase", "f", "heads", "tails", "n").mapInArrow(
        _scored, "lang string, phrase string, a long, l long, r long, n long, score long"
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

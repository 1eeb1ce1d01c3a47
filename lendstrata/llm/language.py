"""Language of a text by word-first backoff.

A word that the model knows scores its log frequency in each language. A word it does not
know scores the mean log frequency of its character n-grams of the longest length of which
any is known, the word's ends marked. The scores of all words of a text add up; the language
with the highest sum wins, its share of the likelihoods is the score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage
from .units import resolve, slices, strings

UNDETERMINED = "und"
#: Labelled documents per language that the model is fitted on, drawn by a hash of their id.
TRAINING_DOCS = 2_000
#: Words, and n-grams of each length, that the model keeps per language; n-gram lengths; the
#: count in the language with most text that stands for not seen.
WORDS, GRAMS, LONGEST, UNSEEN = 20_000, 10_000, 5, 0.5
#: Longest word that is looked at as such; a longer one goes in by pieces of this length.
LONGEST_WORD = 64


def held_out(doc_id: Column) -> Column:
    """Documents that are for measuring only; a NULL id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def letter_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``(words, codes, bounds)``: lower-cased runs of letters of each text."""
    lower = pc.utf8_lower(texts)
    spaced = pc.replace_substring_regex(lower, r"[^\p{L}]+", " ")
    parts = pc.split_pattern(pc.utf8_trim(spaced, characters=" "), " ")
    encoded = parts.values.slice(parts.offsets[0].as_py(), parts.offsets[-1].as_py() - parts.offsets[0].as_py()).dictionary_encode()
    bounds = parts.offsets.to_numpy().astype(np.int64)
    return strings(encoded.dictionary), encoded.indices.to_numpy(), bounds - bounds[0]


def chunks(word: str) -> list[str]:
    return [word[i : i + LONGEST_WORD] for i in range(0, len(word), LONGEST_WORD)]


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1) if n > 1 or 0 < i < len(marked) - 1]


def _training_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words per language, summed over each batch."""
    for batch, texts in slices(batches):
        words, codes, bounds = letter_words(texts)
        langs = batch.column("lang").dictionary_encode()
        owner = np.repeat(langs.indices.to_numpy(), np.diff(bounds))
        pair, count = np.unique(owner.astype(np.int64) * max(1, len(words)) + codes, return_counts=True)
        which, code = np.divmod(pair, max(1, len(words)))
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(which)).cast(pa.string()),
                pa.array(words, pa.string()).take(pa.array(code)),
                pa.array(count.astype(np.int64)),
            ],
            ["lang", "word", "n"],
        )


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams from counts of words."""
    for batch in batches:
        total: Counter[tuple[str, int, str]] = Counter()
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
            for part in chunks(word):
                for size in range(1, LONGEST + 1):
                    for gram in grams(part, size):
                        total[lang, size, gram] += n
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2] for k in keys], pa.string()),
                pa.array(list(total.values()), pa.int64()),
            ],
            ["lang", "size", "item", "n"],
        )


class Model:
    """Log frequencies per language: of words (length 0) and of n-grams by length."""

    def __init__(self, rows: Iterable[tuple[str, int, str, int, int]]):
        """``rows``: language, length, item, its count, and all counts of that language and
        length, kept or not."""
        rows = list(rows)
        self.langs = sorted({r[0] for r in rows})
        place = {lang: k for k, lang in enumerate(self.langs)}
        self.row = {key: k for k, key in enumerate(dict.fromkeys((r[1], r[2]) for r in rows))}
        counts = np.zeros((len(self.row) + 1, len(self.langs)))
        totals = np.zeros((LONGEST + 1, len(self.langs)))
        for lang, size, item, n, total in rows:
            counts[self.row[size, item], place[lang]] = n
            totals[size, place[lang]] = total
        sizes = np.array([*(size for size, _ in self.row), 0], dtype=np.int64)
        # what a language has not been seen to use is as rare in all of them, so that one with
        # little text does not draw unseen words
        rarest = UNSEEN / np.maximum(totals.max(axis=1, initial=0), 1)
        self.logs = np.log(np.maximum(counts / np.maximum(totals[sizes], 1), rarest[sizes, None]))
        self.logs[-1] = 0  # a word without any known n-gram says nothing
        self.memo: dict[str, np.ndarray] = {}

    def scores(self, words: list[str]) -> list[np.ndarray]:
        """Log frequencies of each word in all languages."""
        rows, sizes = [], []
        for n, word in enumerate(words):
            known = self.row.get((0, word))
            if known is not None:
                found = [known]
            else:
                for size in range(LONGEST, 0, -1):
                    each = (self.row.get((size, g)) for part in chunks(word) for g in grams(part, size))
                    found = [r for r in each if r is not None]
                    if found:
                        break
                else:
                    found = [len(self.row)]
            rows += found
            sizes.append(len(found))
        if not words:
            return []
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return list(np.add.reduceat(self.logs[rows], starts, axis=0) / np.array(sizes)[:, None])

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words, codes, bounds = letter_words(texts)
        empty = np.array([w == "" for w in words], dtype=bool)
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.langs or not words:
            return langs, scores
        each = np.array(resolve(words, codes, self.memo, self.scores))
        each[empty] = 0
        # every text has at least one part, which is empty where there is no letter
        sums = np.add.reduceat(each[codes], bounds[:-1], axis=0)
        best = sums.argmax(axis=1)
        share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        for d in np.flatnonzero(~empty[codes[bounds[:-1]]]):
            langs[d], scores[d] = self.langs[best[d]], share[d]
        return langs, scores


def fit(labelled: DataFrame, per_language: int = TRAINING_DOCS) -> Model:
    """Model of ``labelled (doc_id, text, lang)``; rows without text or language are left out.

    It is fitted on about ``per_language`` documents of each language (all, where there are
    fewer), whole texts, chosen by a hash of their id. Its size is bounded by ``WORDS`` and
    ``GRAMS`` per language; counts of what is not kept stay in the totals.
    """
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = rows.groupBy("lang").count().collect()  # one row for each language
    if not sizes:
        return Model([])
    part = F.create_map(*(x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["count"])))))
    drawn = (F.xxhash64(F.lit("fit"), "doc_id").cast("double") / 2.0**64 + 0.5) < F.element_at(part, F.col("lang"))
    words = stage(
        rows.where(drawn)
        .select("lang", "text")
        .mapInArrow(_training_counts, "lang string, word string, n long")
        .where("word <> ''")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n")),
        "language-words",
    )
    found = words.mapInArrow(_gram_counts, "lang string, size int, item string, n long")
    found = found.groupBy("lang", "size", "item").agg(F.sum("n").alias("n"))
    items = words.select("lang", F.lit(0).alias("size"), F.col("word").alias("item"), "n").union(found)
    group = Window.partitionBy("lang", "size")
    kept = (
        items.withColumn("total", F.sum("n").over(group))
        .withColumn("rank", F.row_number().over(group.orderBy(F.desc("n"), "item")))
        .where(F.col("rank") <= F.when(F.col("size") == 0, WORDS).otherwise(GRAMS))
        .select("lang", "size", "item", "n", "total")
    )
    return Model(tuple(r) for r in kept.collect())  # bounded by WORDS and GRAMS


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs (doc_id, text, ...)``.

    ``und`` and 0 for a text that is NULL, has no letter, or when no language was learned; a
    tie goes to the first language by code point. Repeated rows stay; an empty table gives no
    rows; ids, labels and other columns do not bear on the prediction.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by WORDS and GRAMS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            langs, scores = held.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs), pa.array(np.round(scores, 6))],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def learn_and_identify(docs: DataFrame, per_language: int = TRAINING_DOCS) -> DataFrame:
    """Learn from the documents that are not held out, predict all."""
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    rows = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return identify(docs, fit(rows, per_language))

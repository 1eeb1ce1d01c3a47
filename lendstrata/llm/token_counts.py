"""Token counts by the whole-token shortcut.

Which strings of the vocabulary the tokenizer leaves as one token is found out beforehand,
by encoding every one of them alone: those that are one pre-token and come back as their own
id are proven. In a text, a pre-token that is proven counts one without any merging; only the
distinct others are given to the tokenizer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame, functions as F

from .byte_bpe import cut, encoder
from .units import resolve, slices, sums

_PRE_TOKEN = regex.compile(PATTERN)


def whole_tokens(tokenizer) -> frozenset[str]:
    """Strings that are one pre-token and encode alone as one token: proven by doing it."""
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ids = sorted(i for t, i in tokenizer.get_vocab().items() if t not in special)
    strings = [s for s in tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)]
    alone = [s for s in strings if s and "�" not in s and _PRE_TOKEN.findall(s) == [s]]
    encoded = tokenizer.encode_batch_fast(alone, add_special_tokens=False)
    return frozenset(s for s, e in zip(alone, encoded) if len(e.ids) == 1)


class Counter:
    def __init__(self, path: str):
        self.encoder = encoder(path)
        self.special = [t.content for t in self.encoder.tokenizer.get_added_tokens_decoder().values()]
        self.whole = whole_tokens(self.encoder.tokenizer)
        self.memo: dict[str, int] = {}

    def _compute(self, units: list[str]) -> list[int]:
        """Tokens of each unit: proven pre-tokens count one, the rest of all units is merged
        in one call. A unit with a special string in it is left to the tokenizer whole."""
        counts, rest = [0] * len(units), {}
        for n, unit in enumerate(units):
            if unit in self.whole:
                counts[n] = 1
            elif any(s in unit for s in self.special):
                rest.setdefault(unit, []).append(n)
            else:
                for pre_token in _PRE_TOKEN.findall(unit):
                    if pre_token in self.whole:
                        counts[n] += 1
                    else:
                        rest.setdefault(pre_token, []).append(n)
        for owners, ids in zip(rest.values(), self.encoder.encode(list(rest))):
            for n in owners:
                counts[n] += len(ids) // 2
        return counts

    def count(self, texts: pa.Array) -> np.ndarray:
        units, codes, bounds = cut(texts)
        tokens = np.array(resolve(units, codes, self.memo, self._compute), dtype=np.int64)
        return sums(tokens[codes], bounds)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs (doc_id, text, ...)``.

    Counts are those of the tokenizer file at ``path`` without added special tokens. A NULL
    text counts like an empty one: no bytes, no tokens. Repeated rows stay; an empty table
    gives no rows; no other column is looked at.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(counter(path).count(texts))],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

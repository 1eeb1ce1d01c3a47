"""Texts as sequences of repeated units, for tokenizers whose work on a text falls apart at
spaces: the distinct units of some megabytes of text are worked on once, the rest is arrays.

``cut_at_spaces`` splits by Arrow before each single space. Where a text has runs of white
space there, its units come from ``recut`` instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text that is worked on at a time, and units that a worker remembers between times.
SLICE_BYTES = 2 << 20
MEMO_UNITS = 200_000


def slices(batches: Iterable[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batches with about ``size`` bytes of text, and their texts, NULL as empty."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_string()).fill_null("")
        total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(total):
            done = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, done + size, side="right")))
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)
            start = stop


def cut_at_spaces(
    texts: pa.Array, prefix: str, odd_later: str, odd_first: str, recut: Callable[[str], list[str]]
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``(units, codes, bounds)``: document d is ``units[c] for c in codes[bounds[d]:bounds[d + 1]]``.

    Units after the first begin with a space, the first with ``prefix``. A text with a part
    that matches ``odd_later``, or ``odd_first`` as its first, is cut by ``recut(text)``.
    """
    n = len(texts)
    parts = pc.split_pattern(texts, " ")
    bounds = parts.offsets.to_numpy().astype(np.int64)
    values = parts.values.slice(bounds[0], bounds[-1] - bounds[0])
    bounds = bounds - bounds[0]
    later, first = values.dictionary_encode(), values.take(pa.array(bounds[:-1])).dictionary_encode()
    codes = later.indices.to_numpy().astype(np.int64)
    codes[bounds[:-1]] = first.indices.to_numpy() + len(later.dictionary)
    tails, heads = strings(later.dictionary), strings(first.dictionary)
    odd = np.concatenate(
        [
            pc.match_substring_regex(d, pattern).to_numpy(zero_copy_only=False).astype(bool)
            for d, pattern in ((later.dictionary, odd_later), (first.dictionary, odd_first))
        ]
    )
    units = [*(" " + u for u in tails), *(prefix + u for u in heads)]
    odd_rows = np.flatnonzero(np.logical_or.reduceat(odd[codes], bounds[:-1])) if n else []
    if len(odd_rows):
        known: dict[str, int] = {}
        segments, last = [], 0
        lengths = np.diff(bounds)
        for row in odd_rows:
            segments.append(codes[bounds[last] : bounds[row]])
            own = [known.setdefault(u, len(units) + len(known)) for u in recut(texts[int(row)].as_py())]
            segments.append(np.array(own, dtype=np.int64))
            lengths[row], last = len(own), row + 1
        segments.append(codes[bounds[last] :])
        codes, bounds = np.concatenate(segments), np.concatenate([[0], np.cumsum(lengths)])
        units += known
    return units, codes, bounds


def strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def resolve(units: list[str], codes: np.ndarray, memo: dict, compute: Callable[[list[str]], Iterable]) -> list:
    """The value of each unit, from the memo or computed. The memo takes units that the codes
    name more than once, and starts anew when full."""
    values = list(map(memo.get, units))
    places = [n for n, v in enumerate(values) if v is None]
    if not places:
        return values
    again = (np.bincount(codes, minlength=len(units)) > 1).tolist()
    fresh = {}
    for n, v in zip(places, compute([units[n] for n in places])):
        values[n] = v
        if again[n]:
            fresh[units[n]] = v
    if len(memo) + len(fresh) > MEMO_UNITS:
        memo.clear()
    memo.update(fresh)
    return values


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[starts[c] : starts[c] + lengths[c]]`` over the codes."""
    sizes = lengths[codes]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[codes] - (ends - sizes), sizes) + np.arange(total)]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring bounds, 0 where there is nothing between."""
    running = np.concatenate([[0], np.cumsum(values)])
    return running[bounds[1:]] - running[bounds[:-1]]


def ragged(values: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(flat, starts, lengths)`` of byte strings read as arrays of ``dtype``."""
    flat = np.frombuffer(b"".join(values), dtype=dtype)
    lengths = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(dtype).itemsize
    return flat, np.cumsum(lengths) - lengths, lengths

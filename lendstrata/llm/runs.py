"""Periodic runs of words, by Lyndon roots.

A run is a stretch with a smallest period q that no neighbouring word prolongs. With one of the
two orders of the words (some order, and its reverse) each of its Lyndon roots is the longest
Lyndon word at its position. So all runs come from the Lyndon arrays of both orders: the root
at each position is prolonged to both sides by longest common extensions.

The arrays come straight from phase one of Baier's suffix sorter. Suffixes are grouped by
their first word; the groups are taken from the highest down, and the nearest suffix to the
left of each member that lies in a lower group moves into a new group directly above its old
one, whose context is longer by that of the group at hand. When a group is taken, its context
is the longest Lyndon word at the positions of its members. Phase two, the sorting of the
suffixes, is not needed.

Most texts have no run. One with a length of at least ``least`` and ``power`` periods repeats
a gram of ``least - least / power`` words, so only stretches of such grams, found by hashes
that can err towards longer stretches only, are looked into.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .units import slices

SLICE_BYTES = 2 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FIELDS = ("start", "length", "period")
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def lyndon_lengths(letters: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position of ``letters`` (0, 1, ... without
    gaps), by Baier's grouping; an end of the text comes before any letter."""
    n = len(letters)
    order = np.argsort(letters, kind="stable")
    bounds = np.flatnonzero(np.diff(letters[order])) + 1
    members = [part.tolist() for part in np.split(order, bounds)] if n else []
    context = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    group, left, found = letters.tolist(), list(range(-1, n - 1)), np.empty(n, dtype=np.int64)
    taken = len(members) - 1
    while taken >= 0:
        own = [i for i in members[taken] if group[i] == taken]
        members[taken] = None
        length = context[taken]
        if own:
            found[own] = length
            for i in own:
                group[i] = -1
            hits: dict[int, int] = {}
            for i in own:
                # the nearest suffix to the left in a lower group; those that were taken are skipped
                j = left[i]
                while j >= 0 and group[j] < 0:
                    k = left[j]
                    if k >= 0 and group[k] < 0:
                        left[j] = left[k]
                    j = k
                left[i] = j
                if j >= 0:
                    hits[j] = hits.get(j, 0) + 1
            moved: dict[tuple[int, int], list[int]] = {}
            for j, times in hits.items():
                moved.setdefault((times, group[j]), []).append(j)
            for times, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:
                new, higher = len(context), above[old]
                context.append(context[old] + times * length)
                members.append(moved[times, old])
                below.append(old)
                above.append(higher)
                above[old] = new
                if higher >= 0:
                    below[higher] = new
                for j in moved[times, old]:
                    group[j] = new
        taken = below[taken]
    return found


def _agreeing(x: np.ndarray, y: np.ndarray) -> int:
    """How many first words of two sequences agree, compared in growing steps."""
    most, at, step = min(len(x), len(y)), 0, 16
    while at < most:
        upto = min(most, at + step)
        differs = x[at:upto] != y[at:upto]
        if differs.any():
            return at + int(differs.argmax())
        at, step = upto, step * 2
    return most


def _stretch_runs(codes: np.ndarray, least: int, power: int) -> set[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of a text, as it is and by both orders."""
    letters = np.unique(codes, return_inverse=True)[1]
    found: set[tuple[int, int, int]] = set()
    for ranks in (letters, letters.max() - letters):
        periods = lyndon_lengths(ranks)
        # the first root of a run leaves at least power - 2 periods behind the next root
        follows = np.arange(len(codes)) + periods
        inside = np.flatnonzero(follows < len(codes))
        hits = inside[codes[inside] == codes[follows[inside]]]
        upto: dict[int, int] = {}
        for i, p in zip(hits.tolist(), periods[hits].tolist()):
            if upto.get(p, 0) >= i + p:  # a root of the run before
                continue
            behind = _agreeing(codes[i:], codes[i + p :])
            if behind < max((power - 2) * p, least - 2 * p):
                continue
            before = _agreeing(codes[:i][::-1], codes[: i + p][::-1])
            length = before + p + behind
            if length >= max(least, power * p):
                upto[p] = i + p + behind
                found.add((i - before, length, p))
    return found


def _stretches(codes: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """Where grams that occur twice or more lie, as ``(first, behind the last)`` word; equal
    hashes of others can make them longer."""
    if len(codes) <= gram:
        return []
    hashes, width = (codes.astype(np.uint64) + np.uint64(1)) * _MIX, 1
    while 2 * width <= gram:
        hashes = (hashes[:-width] ^ (hashes[:-width] >> np.uint64(29))) * _MIX + hashes[width:]
        width *= 2
    if width < gram:
        rest = gram - width
        hashes = (hashes[:-rest] ^ (hashes[:-rest] >> np.uint64(29))) * _MIX + hashes[rest:]
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    places = np.flatnonzero(np.isin(hashes, twice))
    breaks = np.flatnonzero(np.diff(places) > gram)
    first = places[np.concatenate([[0], breaks + 1])]
    last = places[np.concatenate([breaks, [len(places) - 1]])] + gram
    return list(zip(first.tolist(), last.tolist()))


def find_runs(codes: np.ndarray, least: int = 24, power: int = 3) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of the numbered words with at least ``least``
    words and ``power`` periods, by start and then period; ``power`` is 2 at least."""
    found: set[tuple[int, int, int]] = set()
    for a, b in _stretches(codes, least - least // power):
        found |= {(a + s, length, p) for s, length, p in _stretch_runs(codes[a:b], least, power)}
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(text: bytes, least: int, power: int) -> tuple[int, list[tuple[int, int, int]], bytes]:
    """Number of words, runs, and the words that no run contains behind its first period,
    joined by one space."""
    words = text.split()  # at the six white-space characters of WORD
    if len(words) < least:
        return len(words), [], b" ".join(words)
    number = dict(zip(dict.fromkeys(words), count()))
    codes = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    found = find_runs(codes, least, power)
    if found:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in found:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return len(codes), found, b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = 24, power: int = 3) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs (doc_id, text, ...)``.

    ``runs`` lists start, length and period of each run, in words, by start and then period;
    ``collapsed`` is the text with one period of each. NULL and empty texts have no words, no
    runs and an empty ``collapsed``. Rows with NULL or equal ids stay, each with its own
    result; further columns are not looked at; an empty table gives no rows. There is no
    shuffle; a text is worked on as a whole, with about 100 bytes for each word in stretches
    that repeat, however long it is.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, SLICE_BYTES):
            counts, found, kept = zip(*(collapse(t.as_py(), least, power) for t in texts.cast(pa.large_binary())))
            flat = np.array([run for runs in found for run in runs], dtype=np.int64).reshape(-1, 3)
            offsets = np.concatenate([[0], np.cumsum([len(runs) for runs in found])])
            spans = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], _FIELDS)
            columns = [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)

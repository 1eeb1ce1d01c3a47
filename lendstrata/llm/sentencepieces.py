"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

A model file gives pieces and scores. A text is escaped as SentencePiece does (a space in
front, spaces as markers), falls apart at markers when no piece has one after another
character, and each distinct part is segmented once: the best sum of scores over all
segmentations into pieces, with an unknown character costing ten below the lowest score and
written as its UTF-8 bytes' pieces. Parts are segmented side by side as array operations,
one trie step for all at a time. Inside, the marker is the space itself.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .units import cut_at_spaces, gather, ragged, resolve, slices, sums

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
#: Longest part, in bytes, that is segmented side by side with others.
SIDE_BY_SIDE = 64
#: Gaps that are tried for a state of the trie before it goes to the end.
GAPS = 64
EACH_BYTE = "replace each byte"
codecs.register_error(EACH_BYTE, lambda e: ("\ufffd" * (e.end - e.start), e.end))
_RUNS = re.compile(" +[^ ]*|[^ ]+")


class DoubleArray:
    """Trie of byte strings: from state s, byte c leads to ``base[s] + c + 1`` if ``check``
    there is s; ``value`` is the number of the string that ends in a state, or -1."""

    def __init__(self, strings: list[bytes]):
        root: dict = {}
        for n, s in enumerate(strings):
            node = root
            for c in s:
                node = node.setdefault(c + 1, {})
            node[0] = n
        used, base, check, value = bytearray(b"\1"), {}, {0: 0}, {}
        end, lowest, todo = 1, 1, [(0, root)]
        while todo:
            state, node = todo.pop()
            value[state] = node.pop(0, -1)
            codes = sorted(node)
            if not codes:
                continue
            if len(used) < end + 512:
                used += bytes(len(used) + 512)
            # the first gap that takes all children; after some trials, the free end
            lowest = used.find(0, lowest)
            at = used.find(0, max(lowest, codes[0] + 1))
            for _ in range(GAPS):
                if not any(used[at + c - codes[0]] for c in codes):
                    break
                at = min(used.find(0, at + 1), end + codes[0])
            else:
                at = end + codes[0]
            base[state] = at - codes[0]
            for c in codes:
                following = base[state] + c
                used[following], check[following], end = 1, state, max(end, following + 1)
                todo.append((following, node[c]))
        size = end + 257
        self.base, self.check, self.value = (np.full(size, v, dtype=np.int32) for v in (0, -1, -1))
        for array, known in ((self.base, base), (self.check, check), (self.value, value)):
            array[list(known)] = list(known.values())

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Next states; -1 where there is none."""
        following = self.base[states] + codes + 1
        return np.where(self.check[following] == states, following, -1)


def _width(lead: int) -> int:
    """Bytes of a character by its first."""
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


@dataclass
class Model:
    """Pieces, scores and the trie of a model file."""

    pieces: list[str]
    trie: DoubleArray
    scores: np.ndarray  # by number of the string in the trie
    sizes: np.ndarray  # bytes of the string, likewise
    ids: np.ndarray
    byte_ids: np.ndarray  # by byte; all unk_id without byte fallback
    unk_id: int
    surfaces: list[bytes]
    splits: bool  # no piece has a marker after another character
    memo: dict[str, bytes] = field(default_factory=dict)

    @staticmethod
    def load(path: str) -> "Model":
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        pieces = [sp.id_to_piece(i) for i in every]
        normal = [i for i in every if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        inner = [pieces[i].replace(MARKER, " ") for i in normal]
        byte_ids = np.full(256, sp.unk_id(), dtype=np.int32)
        surfaces = [b"" if sp.is_control(i) else p.replace(MARKER, " ").encode() for i, p in zip(every, pieces)]
        for i in every:
            if sp.is_byte(i):
                byte_ids[int(pieces[i][1:-1], 16)] = i
                surfaces[i] = bytes([int(pieces[i][1:-1], 16)])
        surfaces[sp.unk_id()] = " ⁇ ".encode()
        return Model(
            pieces=pieces,
            trie=DoubleArray([s.encode() for s in inner]),
            scores=np.array([sp.get_score(i) for i in normal], dtype=np.float64),
            sizes=np.array([len(s.encode()) for s in inner], dtype=np.int64),
            ids=np.array(normal, dtype=np.int32),
            byte_ids=byte_ids,
            unk_id=sp.unk_id(),
            surfaces=surfaces,
            splits=all(" " not in s.lstrip(" ") for s in inner),
        )

    @property
    def unknown_score(self) -> float:
        return float(self.scores.min()) - UNKNOWN_PENALTY

    def segment_one(self, part: bytes) -> array:
        """Ids of the best segmentation of one part of any length, byte by byte; it takes four
        bytes for each byte of the part, and as many for each id."""
        trie, n = self.trie, len(part)
        base, check, value = trie.base, trie.check, trie.value
        scores, unknown, s = self.scores, self.unknown_score, 0
        # scores are needed as far as a piece reaches, the way back as one number a byte
        ring = max(int(self.sizes.max(initial=0)), 4) + 1
        best, back = [float("-inf")] * ring, array("i", [-1]) * (n + 1)
        best[0] = 0.0
        while s < n:
            width = _width(part[s])
            state, at, single, here = 0, s, False, best[s % ring]
            best[s % ring] = float("-inf")
            while at < n:
                following = int(base[state]) + part[at] + 1
                if check[following] != state:
                    break
                state, at = following, at + 1
                if (v := int(value[state])) >= 0:
                    single |= at - s == width
                    if (score := here + float(scores[v])) > best[at % ring]:
                        best[at % ring], back[at] = score, v
            if not single and (score := here + unknown) > best[(s + width) % ring]:
                best[(s + width) % ring], back[s + width] = score, -1
            s += width
        out, at = array("i"), n
        while at:
            if (v := back[at]) >= 0:
                out.append(int(self.ids[v]))
                at -= int(self.sizes[v])
            else:
                s = at - 1
                while part[s] & 0xC0 == 0x80:
                    s -= 1
                out.extend(int(b) for b in self.byte_ids[list(part[s:at])][::-1])
                at = s
        out.reverse()
        return out

    def segment_all(self, parts: list[bytes]) -> list[bytes]:
        """Best segmentations as bytes of int32 ids, in order of the parts."""
        order = sorted((len(p), n) for n, p in enumerate(parts) if len(p) <= SIDE_BY_SIDE)
        out: list[bytes] = [b""] * len(parts)
        for n, p in enumerate(parts):
            if len(p) > SIDE_BY_SIDE:
                out[n] = np.array(self.segment_one(p), dtype="<i4").tobytes()
        for start in range(0, len(order), 16384):
            rows = [n for _, n in order[start : start + 16384]]
            for n, ids in zip(rows, self._side_by_side([parts[n] for n in rows])):
                out[n] = ids
        return out

    def _side_by_side(self, parts: list[bytes]) -> list[bytes]:
        lengths = np.array([len(p) for p in parts])
        width, n = int(lengths.max(initial=0)), len(parts)
        codes = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(n, width).T.astype(np.int32)
        lead = np.select([codes < 0x80, codes < 0xC0, codes < 0xE0, codes < 0xF0], [1, 0, 2, 3], 4)
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0
        start, number = (np.full((width + 1, n), -1, dtype=np.int32) for _ in range(2))
        for s in range(width):
            # parts are in order of length: those from `first` on are longer than s
            first = int(np.searchsorted(lengths, s, side="right"))
            rows = first + np.flatnonzero(lead[s, first:])
            single = np.zeros(n, dtype=bool)
            reached, live, states = best[s, rows], rows, np.zeros(len(rows), dtype=np.int32)
            for at in range(s, width):
                states = self.trie.step(states, codes[at, live])
                alive = (states >= 0) & (lengths[live] > at)
                live, states, reached = live[alive], states[alive], reached[alive]
                if not len(live):
                    break
                values = self.trie.value[states]
                ends = np.flatnonzero(values >= 0)
                if len(ends):
                    hit, value = live[ends], values[ends]
                    single[hit[lead[s, hit] == at + 1 - s]] = True
                    score = reached[ends] + self.scores[value]
                    better = score > best[at + 1, hit]
                    hit = hit[better]
                    best[at + 1, hit], start[at + 1, hit], number[at + 1, hit] = score[better], s, value[better]
            lone = rows[~single[rows]]
            ends = s + lead[s, lone]
            score = best[s, lone] + self.unknown_score
            better = score > best[ends, lone]
            lone, ends = lone[better], ends[better]
            best[ends, lone], start[ends, lone], number[ends, lone] = score[better], s, -1
        # from the ends backwards, all parts at once; an unknown character is its bytes
        owners, places, ids = [], [], []
        rows, at = np.arange(n), lengths.copy()
        while len(rows := rows[at[rows] > 0]):
            here = at[rows]
            s, v = start[here, rows], number[here, rows]
            known = v >= 0
            owners.append(rows[known])
            places.append(s[known])
            ids.append(self.ids[v[known]])
            for k in range(4):
                some = ~known & (s + k < here)
                owners.append(rows[some])
                places.append(s[some] + k)
                ids.append(self.byte_ids[codes[s[some] + k, rows[some]]])
            at[rows] = s
        owner, place, flat = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (owners, places, ids))
        order = np.lexsort((place, owner))
        raw = flat[order].astype("<i4").tobytes()
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]) * 4
        return [raw[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)`` of texts: those of text d are ``ids[bounds[d]:bounds[d + 1]]``."""
        plain = pa.array([t.replace(MARKER, " ") if MARKER in t else t for t in texts.to_pylist()], pa.large_string())

        def recut(text: str) -> list[str]:
            return (_RUNS.findall(" " + text) if self.splits else [" " + text]) if text else []

        units, codes, bounds = cut_at_spaces(plain, " ", "^$" if self.splits else "", "^$" if self.splits else "", recut)
        flat, starts, lengths = ragged(
            resolve(units, codes, self.memo, lambda us: self.segment_all([u.encode() for u in us])), "<i4"
        )
        ends = sums(lengths[codes], bounds)
        return gather(flat, starts, lengths, codes), np.concatenate([[0], np.cumsum(ends)])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of ids: surfaces joined, markers as spaces, without the space in front; each
        byte that is no UTF-8 becomes U+FFFD."""
        flat, starts, lengths = ragged(self.surfaces, "u1")
        ends = np.concatenate([[0], np.cumsum(lengths[ids])])[bounds].tolist()
        raw = gather(flat, starts, lengths, ids).tobytes()
        texts = (raw[i:j] for i, j in zip(ends, ends[1:]))
        return [(t[1:] if t[:1] == b" " else t).decode(errors=EACH_BYTE) for t in texts]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One model for each file in a worker, kept between tasks."""
    return Model.load(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, n_pieces, n_bytes, decoded`` of every row of ``docs (doc_id, text, ...)``:
    the ids, how many, how many of them are byte pieces, and the text that the ids decode to.

    A NULL text has NULL ids and NULL decoded text and counts of 0; an empty one no ids. What
    is decoded equals the text but for U+2581, which reads as a space. Repeated rows stay; an
    empty table gives no rows; other columns are not looked at.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            known = model(path)
            ids, bounds = known.encode(texts)
            missing = batch.column("text").is_null()
            is_byte = np.isin(ids, known.byte_ids)
            absent = missing.to_numpy(zero_copy_only=False)
            offsets = pa.array(bounds.astype(np.int32), pa.int32(), mask=np.append(absent, False))
            decoded = pa.array(known.decode(ids, bounds), pa.string(), mask=absent)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(offsets, pa.array(ids)),
                    pa.array(np.diff(bounds)),
                    pa.array(sums(is_byte, bounds)),
                    decoded,
                ],
                ["doc_id", "ids", "n_pieces", "n_bytes", "decoded"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_pieces long, n_bytes long, decoded string")

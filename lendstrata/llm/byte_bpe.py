"""Byte-level BPE with the tokenizers library, unit by unit.

The library's pre-tokenizer never joins a character with a space that follows it, so a text
falls apart before every run of white space: the ids of a text are those of its units (white
space, then other characters) one after another. Texts repeat their units; each distinct one
is encoded once. ``Encoder.cut`` also cuts inside of these units where the pre-tokenizer does
so whatever stands around, which leaves fewer distinct ones.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from tokenizers import Tokenizer, pre_tokenizers

from .units import cut_at_spaces

#: White space as the pre-tokenizer's pattern has it (Unicode's White_Space).
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
_SPACES = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACES}]", c))
#: Units that are given to the library as one string, and units that a worker remembers.
JOINED, MEMO_UNITS = 512, 1_500_000
HASH_KEYS = "units of a text,", "once more hashed"


#: A unit must hold other characters than white space, end with one, and have no more white
#: space in front than the space that it was cut at.
_ARROW_SPACES = "".join(sorted(_SPACES))
_ODD_FIRST = f"^$|[{_ARROW_SPACES}]$"
_ODD_LATER = f"^[{_ARROW_SPACES}]|{_ODD_FIRST}"
#: What must not be joined to other units: nothing, or more white space in front, or some at the end.
_ALONE = f"^[{_ARROW_SPACES}]{{2}}|{_ODD_FIRST}"


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    return cut_at_spaces(texts, "", _ODD_LATER, _ODD_FIRST, _UNIT.findall)


#: Kinds of bytes. Control characters and most bytes beyond ASCII are of an unknown kind, where
#: nothing is cut but before white space.
_UNKNOWN, _LETTER, _DIGIT, _MARK, _QUOTE, _SPACE, _GAP, _WIDE = range(8)
_KINDS = np.zeros(256, dtype=np.uint8)
for _byte in range(0x21, 0x7F):
    _KINDS[_byte] = _LETTER if chr(_byte).isalpha() else _DIGIT if chr(_byte).isdigit() else _MARK
_KINDS[ord("'")], _KINDS[ord(" ")], _KINDS[0x09:0x0E] = _QUOTE, _SPACE, _GAP
#: First bytes of U+00C0 to U+023F, all of them letters but two.
_KINDS[0xC3:0xC9] = _LETTER
_NO_LETTERS = [0xC397, 0xC3B7]
#: White space beyond ASCII by its bytes.
_WIDE_CODES = [[int.from_bytes(c.encode(), "big") for c in sorted(_SPACES) if len(c.encode()) == n] for n in (2, 3)]
_WIDE_FIRST = np.isin(np.arange(256), [c.encode()[0] for c in _SPACES if not c.isascii()])
_ALWAYS, _LAST = 1, 2


def _pairs() -> np.ndarray:
    """Whether to cut between bytes of two kinds (at 8 * kind + next kind), from the pattern of
    the pre-tokenizer: letters, digits and other marks, each perhaps after one space, and
    white space but for the last before something else. "'" may begin a contraction."""
    pairs = np.zeros((8, 8), dtype=np.uint8)
    pairs[:_SPACE, [_SPACE, _GAP]] = _ALWAYS
    pairs[_SPACE:, [_SPACE, _GAP]] = _LAST
    pairs[_GAP, :_SPACE] = _ALWAYS
    pairs[_LETTER, [_DIGIT, _MARK, _QUOTE]] = _ALWAYS
    pairs[_DIGIT, [_LETTER, _MARK, _QUOTE]] = _ALWAYS
    pairs[_MARK, [_LETTER, _DIGIT]] = _ALWAYS
    pairs[_QUOTE, _DIGIT] = _ALWAYS
    return pairs.ravel()


_PAIRS = _pairs()


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings, and where each of them begins and the last ends."""
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _kinds(data: np.ndarray) -> np.ndarray:
    kinds = _KINDS[data]
    at = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))
    kinds[at + 1] = _LETTER
    at = at[np.isin(data[at].astype(np.int32) << 8 | data[at + 1], _NO_LETTERS)]
    kinds[at] = kinds[at + 1] = _UNKNOWN
    at = np.flatnonzero(_WIDE_FIRST[data])
    code = data[at].astype(np.int32)
    for n, wide in enumerate(_WIDE_CODES, 1):
        # what is cut short by the end is no character of that length
        code = code << 8 | data[np.minimum(at + n, len(data) - 1)]
        spaces = at[np.isin(code, wide)]
        for k in range(n + 1):
            kinds[spaces + k] = _WIDE
    return kinds


def _begins(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a unit of the pre-tokenizer's pattern surely begins at each byte of some texts.
    The last of several characters of white space stands apart where something else follows."""
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[bounds] = True
    if len(data):
        kinds = _kinds(data)
        pairs = _PAIRS[kinds[:-1] * np.uint8(8) + kinds[1:]]
        last = np.flatnonzero(pairs == _LAST) + 1
        last = last[~begins[last + 1]]
        begins[1:-1] |= pairs == _ALWAYS
        begins[last[kinds[last + 1] < _SPACE]] = True
    return begins


class Memo:
    """Ids of units by two 64-bit hashes of each, in sorted arrays: some thirty bytes a unit,
    where a dictionary takes six times that. It takes no more units when it is full."""

    def __init__(self):
        self.first, self.second = (np.zeros(0, dtype=np.uint64) for _ in range(2))
        self.starts, self.lengths = (np.zeros(0, dtype=np.int32) for _ in range(2))
        self.ids = np.zeros(0, dtype=np.uint16)

    def find(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes, and which are known."""
        if not len(self.first):
            return np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=bool)
        # in their order, neighbours are looked for in the same part of the memory
        order, places = np.argsort(first), np.empty(len(first), dtype=np.int64)
        places[order] = np.minimum(np.searchsorted(self.first, first[order]), len(self.first) - 1)
        return places, (self.first[places] == first) & (self.second[places] == second)

    def add(self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        if len(self.first) + len(first) > MEMO_UNITS:
            return
        order = np.argsort(first)
        places = np.searchsorted(self.first, first[order])
        starts = len(self.ids) + starts
        self.ids = np.concatenate([self.ids, ids])
        for name, new in (("first", first), ("second", second), ("starts", starts), ("lengths", lengths)):
            setattr(self, name, np.insert(getattr(self, name), places, new[order]))


class Encoder:
    """Ids of texts as the library gives them without added special tokens; special strings
    inside a text are special, as is the library's default."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path} has ids beyond two bytes")
        self.memo = Memo()
        size = self.tokenizer.get_vocab_size()
        self.special = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.spans = np.array([self._span(self.tokenizer.id_to_token(i)) for i in range(size)], dtype=np.int64)
        way = self.tokenizer.pre_tokenizer
        #: Whether the pre-tokenizer has the pattern that ``_pairs`` follows.
        self.known_pattern = (
            isinstance(way, pre_tokenizers.ByteLevel) and way.use_regex and not way.add_prefix_space and self.tokenizer.normalizer is None
        )

    def _span(self, token: str | None) -> int:
        """UTF-8 bytes that a token stands for: one per character, as every byte has a
        character of its own; a special token stands for its own text."""
        if token is None:
            return 0
        return len(token.encode()) if token in self.special else len(token)

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """``(units, codes, bounds)`` of large strings: text d is ``units[c] for c in
        codes[bounds[d]:bounds[d + 1]]``. A text with a special string is cut at white space
        only, and so are all where the pre-tokenizer is another one."""
        if not self.known_pattern:
            units, codes, bounds = cut(texts)
            return pa.array(units, pa.large_string()), codes, bounds
        data, bounds = _raw(texts)
        begins = _begins(data, bounds)
        for special in self.special:
            for row in np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)):
                ends = bounds[row] + np.cumsum([len(u.encode()) for u in _UNIT.findall(texts[int(row)].as_py())])
                begins[bounds[row] + 1 : bounds[row + 1]] = False
                begins[ends[:-1]] = True
        begins[-1] = True
        at = np.flatnonzero(begins)
        parts = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)).dictionary_encode()
        return parts.dictionary, parts.indices.to_numpy(), np.searchsorted(at, bounds)

    def encode(self, units: list[str]) -> list[bytes]:
        """Ids of each unit, two bytes each."""
        flat, starts, lengths = self._encoded(pa.array(units, pa.large_string()))
        raw = flat.tobytes()
        return [raw[2 * s : 2 * (s + n)] for s, n in zip(starts.tolist(), lengths.tolist())]

    def _alone(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that are encoded one by one, and the number of each."""
        encoded = self.tokenizer.encode_batch_fast(units.to_pylist(), add_special_tokens=False)
        ids = [np.array(e.ids, dtype=np.uint16) for e in encoded]
        return np.concatenate([np.zeros(0, dtype=np.uint16), *ids]), np.array([len(i) for i in ids], dtype=np.int64)

    def _joined(self, units: pa.Array, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, starts, lengths, good)`` of units that are encoded many in one string, those
        that are marked to stand apart after a line end. The ids are cut where the bytes of a
        unit end; where they cannot be, no unit of the string is good."""
        before = pc.if_else(pa.array(apart), pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
        data, bounds = _raw(pc.binary_join_element_wise(before, units, pa.scalar("", pa.large_string())))
        groups = np.append(np.arange(0, len(units), JOINED), len(units))
        raw, cuts = data.tobytes(), bounds[groups].tolist()
        texts = [raw[i:j].decode() for i, j in zip(cuts, cuts[1:])]
        encoded = [np.array(e.ids, dtype=np.uint16) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids, sizes = np.concatenate(encoded), [len(e) for e in encoded]
        if not all(sizes):
            return ids, np.zeros_like(bounds[1:]), np.zeros_like(bounds[1:]), np.zeros(len(units), dtype=bool)
        # bytes up to the end of each token, counted anew in each string
        after = np.cumsum(self.spans[ids])
        tokens = np.cumsum(sizes)
        surplus = after[tokens - 1] - bounds[groups[1:]]
        after -= np.repeat(np.concatenate([[0], surplus[:-1]]), sizes)
        after = np.minimum(after, np.repeat(bounds[groups[1:]], sizes))
        stops = np.minimum(np.searchsorted(after, bounds[1:]) + 1, len(ids))
        starts = np.concatenate([[0], stops[:-1]])
        good = (after[stops - 1] == bounds[1:]) & (stops > starts + apart)
        good &= ~apart | (self.spans[ids[np.minimum(starts, len(ids) - 1)]] == 1)
        whole = np.logical_and.reduceat(good, groups[:-1])
        whole &= np.diff(np.concatenate([[0], surplus])) == 0
        starts = starts + apart
        return ids, starts, stops - starts, np.repeat(whole, np.diff(groups))

    def _encoded(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat, starts, lengths)`` of the units' ids. Behind a unit that ends with another
        character, one keeps its ids that begins with one character of white space, or with none
        but after a line end, if the pattern is known; such units are encoded together."""
        starts, lengths = (np.zeros(len(units), dtype=np.int64) for _ in range(2))
        flat = np.zeros(0, dtype=np.uint16)
        alone, apart = (pc.match_substring_regex(units, way).to_numpy(zero_copy_only=False).astype(bool) for way in (_ALONE, "^[^\t-\r ]"))
        if not self.known_pattern:
            alone |= apart
        together = np.flatnonzero(~alone)
        if len(together):
            flat, starts[together], lengths[together], good = self._joined(units.take(pa.array(together)), apart[together])
            alone[together[~good]] = True
        if len(rest := np.flatnonzero(alone)):
            ids, lengths[rest] = self._alone(units.take(pa.array(rest)))
            starts[rest] = len(flat) + np.cumsum(lengths[rest]) - lengths[rest]
            flat = np.concatenate([flat, ids])
        return flat, starts, lengths

    def units(self, units: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat, starts, lengths)`` of the units' ids."""
        units = pa.array(units, pa.large_string())
        if not len(units):
            return self.memo.ids, self.memo.starts[:0], self.memo.lengths[:0]
        names = units.to_numpy(zero_copy_only=False)
        first, second = (hash_array(names, hash_key=key, categorize=False) for key in HASH_KEYS)
        places, known = self.memo.find(first, second)
        missing = np.flatnonzero(~known)
        fresh, fresh_starts, fresh_lengths = self._encoded(units.take(pa.array(missing)))
        flat = np.concatenate([self.memo.ids, fresh])
        starts, lengths = (np.empty(len(units), dtype=np.int64) for _ in range(2))
        starts[known], lengths[known] = self.memo.starts[places[known]], self.memo.lengths[places[known]]
        starts[missing], lengths[missing] = len(self.memo.ids) + fresh_starts, fresh_lengths
        self.memo.add(first[missing], second[missing], fresh, fresh_starts, fresh_lengths)
        return flat, starts, lengths


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file in a worker, kept between tasks."""
    return Encoder(path)

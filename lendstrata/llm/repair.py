"""Re-Pair grammar compression of a shard of token ids.

In each round the most frequent adjacent pairs become nonterminals, with the more frequent
pair first where occurrences overlap. A rule takes 12 bytes and each occurrence saves two, so
pairs are replaced while they occur ``LEAST`` times, until a round saves next to nothing; the
round after which the shard is smallest counts. A shard holds the rules, the expansion length of each nonterminal and the
remaining sequence; running sums of expansion lengths lead to any position, and only the
symbols that cover the wanted ids are expanded.

Layout, little-endian: ``MAGIC``, then six u32 (version, terminals, rules, symbols, ids,
bits per symbol), rules as pairs of u32, expansion lengths as u32, the sequence: the lowest 16
bits of each symbol as u16, then for each higher bit those of all symbols, eight to a byte.
"""

from __future__ import annotations

import struct

import numpy as np

from .units import gather

MAGIC, VERSION, HEADER = b"RPAIR", 2, struct.Struct("<5s6I")
RULE_BYTES, SAVED_BYTES = 12, 2
#: Most pairs replaced in a round, and the least occurrences by which a rule saves bytes.
PAIRS, LEAST = 3500, RULE_BYTES // SAVED_BYTES + 1
#: A round that saves less than this part of the shard is the last: about what a full round
#: saves by pairs that occur ``LEAST`` times in a shard of a million ids.
GAIN = 0.003
_MIX, _SLOTS = np.uint64(0x9E3779B97F4A7C15), 18
#: Slots that are looked into for each pair that is replaced, before more of them are needed.
WIDER = 2


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys * _MIX) >> np.uint64(64 - _SLOTS)).view(np.int64)


def _frequent(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The most frequent keys, most frequent first, equal counts in order of the key.

    A slot counts at least as much as each of its keys, so only keys of the fullest slots are
    sorted. None of the others belongs here if enough of those reach the count of their slots."""
    full = np.bincount(slots, minlength=1 << _SLOTS)
    least = int(np.partition(full, -WIDER * PAIRS)[-WIDER * PAIRS])
    while True:
        least = max(least, LEAST)
        ordered = np.sort(keys[(full >= least)[slots]])
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
        counts = np.diff(np.append(starts, len(ordered)))
        often = np.flatnonzero(counts >= least)
        if len(often) >= PAIRS or least == LEAST:
            break
        least = least * 3 // 4
    best = often[np.argsort(-counts[often], kind="stable")][:PAIRS]
    return ordered[starts[best]]


def _apart(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which occurrences to replace, none overlapping: those more frequent than both neighbours
    first, then every other one of each run of what these leave."""
    touches = at[1:] == at[:-1] + 1
    before = np.concatenate([[False], touches])
    first = np.ones(len(at), dtype=bool)
    first[1:] &= ~touches | (rank[1:] < rank[:-1])
    first[:-1] &= ~touches | (rank[:-1] < rank[1:])
    rest = ~first
    rest[1:] &= ~(touches & first[:-1])
    rest[:-1] &= ~(touches & first[1:])
    goes_on = before & np.concatenate([[False], rest[:-1]])
    places = np.arange(len(at))
    begun = np.maximum.accumulate(np.where(rest & ~goes_on, places, 0))
    return first | (rest & ((places - begun) % 2 == 0))


def _bits(symbols: int) -> int:
    return max(16, (symbols - 1).bit_length())


def compress(ids: np.ndarray, terminals: int) -> bytes:
    """A shard of ids below ``terminals``."""
    seq, rules, lengths = ids.astype(np.uint32), [], np.zeros(0, dtype=np.uint32)

    def size() -> int:
        return RULE_BYTES * len(lengths) + len(seq) * _bits(terminals + len(lengths)) // 8

    best = (size(), seq, 0)
    while len(seq) > 1:
        keys = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
        slots = _slots(keys)
        chosen = _frequent(keys, slots)
        if not len(chosen):
            break
        # where chosen pairs are, by a table of hashes; of pairs that share a slot the most
        # frequent has it, the others wait for another round
        table = np.full(1 << _SLOTS, -1, dtype=np.int16)
        table[_slots(chosen[::-1])] = np.arange(len(chosen), dtype=np.int16)[::-1]
        rank = table[slots]
        at = np.flatnonzero(rank >= 0)
        rank = rank[at]
        exact = chosen[rank] == keys[at]
        at, rank = at[exact], rank[exact]
        keep = _apart(at, rank)
        # pairs that overlaps leave too few occurrences of wait, too
        paying = np.bincount(rank[keep], minlength=len(chosen)) >= LEAST
        keep &= paying[rank]
        at, used = at[keep], np.flatnonzero(paying)
        if not len(used):
            break
        rank = (np.cumsum(paying) - 1)[rank[keep]]
        before, first = size(), terminals + len(lengths)
        pairs = np.stack([chosen[used] >> np.uint64(32), chosen[used] & np.uint64(0xFFFFFFFF)], axis=1)
        sizes = np.ones_like(pairs)
        inner = pairs >= terminals
        sizes[inner] = lengths[pairs[inner] - terminals]
        lengths = np.concatenate([lengths, sizes.sum(axis=1).astype(np.uint32)])
        rules.append(pairs.astype(np.uint32))
        seq = seq.copy()
        seq[at] = first + rank
        left = np.ones(len(seq), dtype=bool)
        left[at + 1] = False
        seq = seq[left]
        saved = before - size()
        if size() < best[0]:
            best = (size(), seq, len(lengths))
        if 0 <= saved < GAIN * best[0]:
            break
    _, seq, n_rules = best
    bits = _bits(terminals + n_rules)
    header = HEADER.pack(MAGIC, VERSION, terminals, n_rules, len(seq), len(ids), bits)
    table = np.concatenate([np.zeros((0, 2), dtype=np.uint32), *rules])[:n_rules]
    high = [np.packbits((seq >> np.uint32(b) & np.uint32(1)).astype(np.uint8)).tobytes() for b in range(16, bits)]
    return b"".join([header, table.astype("<u4").tobytes(), lengths[:n_rules].astype("<u4").tobytes(), seq.astype("<u2").tobytes(), *high])


class Shard:
    """Random access to the ids of a shard."""

    def __init__(self, blob: bytes):
        magic, version, self.terminals, n_rules, n_symbols, self.n_ids, bits = HEADER.unpack_from(blob)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a shard of this format")
        at = HEADER.size
        self.rules = np.frombuffer(blob, "<u4", 2 * n_rules, at).reshape(-1, 2)
        self.lengths = np.frombuffer(blob, "<u4", n_rules, at + 8 * n_rules)
        at += 12 * n_rules
        self.sequence = np.frombuffer(blob, "<u2", n_symbols, at)
        at, plane = at + 2 * n_symbols, -(-n_symbols // 8)
        for b in range(16, bits):
            high = np.unpackbits(np.frombuffer(blob, np.uint8, plane, at + (b - 16) * plane), count=n_symbols)
            self.sequence = self.sequence | high.astype(np.uint32) << np.uint32(b)
        sizes = np.ones(n_symbols, dtype=np.int64)
        inner = self.sequence >= self.terminals
        sizes[inner] = self.lengths[self.sequence[inner] - np.uint32(self.terminals)]
        self.ends = np.cumsum(sizes)

    def expanded(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that some symbols stand for, and no others."""
        there = np.zeros(self.terminals + len(self.rules), dtype=bool)
        there[symbols] = True
        needed, where = np.flatnonzero(there).astype(np.uint32), (np.cumsum(there) - 1)[symbols]
        inner = needed >= self.terminals
        lengths = np.ones(len(needed), dtype=np.int64)
        lengths[inner] = self.lengths[needed[inner] - np.uint32(self.terminals)]
        # each distinct symbol once: every pass replaces a nonterminal by two symbols
        flat = needed
        while (open_ := flat >= self.terminals).any():
            ends = np.cumsum(1 + open_)
            out = np.empty(ends[-1], dtype=np.uint32)
            out[ends[~open_] - 1] = flat[~open_]
            pairs = self.rules[flat[open_] - np.uint32(self.terminals)]
            out[ends[open_] - 2], out[ends[open_] - 1] = pairs[:, 0], pairs[:, 1]
            flat = out
        return gather(flat, np.cumsum(lengths) - lengths, lengths, where)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop``; only the symbols that cover them are expanded."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, dtype=np.uint32)
        p = int(np.searchsorted(self.ends, start, side="right"))
        q = int(np.searchsorted(self.ends, stop, side="left")) + 1
        skipped = start - (int(self.ends[p - 1]) if p else 0)
        return self.expanded(self.sequence[p:q].astype(np.uint32))[skipped : skipped + stop - start]

"""Byte BPE, token counts, token files, Re-Pair, SentencePiece."""

from __future__ import annotations

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Regex, Tokenizer, pre_tokenizers

from lendstrata.llm import byte_bpe, repair, sentencepieces, token_counts, token_files, units
from lendstrata.llm.queries import op4_token_files, op8_token_counts
from lendstrata.sources.staging import staging_path

from .cases import AWKWARD, awkward, empty, rows, sample

BPE, PIECES = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
ALPHABET = [*" \n\t\r\x0b\x1c\x85 　ab'sreé你1²½٣.,!_́\U0001f600", "<|endoftext|>", " the", "  "]


def strings(n: int, alphabet, seed: int = 1) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choices(alphabet, k=draw.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_units_give_the_ids_of_the_library(library):
    texts = strings(4000, ALPHABET)
    units_, codes, bounds = byte_bpe.cut(pa.array(texts, pa.large_string()))
    flat, starts, lengths = byte_bpe.encoder(BPE).units(units_)
    ids = units.gather(flat, starts, lengths, codes)
    ends = np.concatenate([[0], np.cumsum(units.sums(lengths[codes], bounds))])
    for n, text in enumerate(texts):
        assert ids[ends[n] : ends[n + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


#: One character of each kind that the pre-tokenizer's pattern or the cut tells apart.
KINDS = [*" \n\x85\u3000aSt1.'-é×ÿ你½\u0301\x00’<", "<|endoftext|>"]


def check_cut(known: byte_bpe.Encoder, library, texts: list[str]) -> None:
    units_, codes, bounds = known.cut(pa.array(texts, pa.large_string()))
    flat, starts, lengths = known.units(units_)
    ids = units.gather(flat, starts, lengths, codes)
    ends = np.concatenate([[0], np.cumsum(units.sums(lengths[codes], bounds))])
    for n, text in enumerate(texts):
        assert "".join(units_.take(pa.array(codes[bounds[n] : bounds[n + 1]])).to_pylist()) == text
        assert ids[ends[n] : ends[n + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_units_inside_words_give_the_ids_of_the_library(library):
    known = byte_bpe.Encoder(BPE)
    assert known.known_pattern
    check_cut(known, library, ["".join(p) for n in (1, 2, 3) for p in itertools.product(KINDS, repeat=n)])
    check_cut(known, library, strings(2000, [*ALPHABET, *KINDS, "'ll", "'ve", "|>", "<|"], seed=3))
    check_cut(known, library, strings(1000, list(map(chr, range(0x250))), seed=4))
    check_cut(known, library, [])
    some = pa.array(["not this", "a b.", "", "c  d\n"], pa.large_string()).slice(1)
    units_, codes, bounds = known.cut(some)
    parts = units_.take(pa.array(codes)).to_pylist()
    assert [parts[i:j] for i, j in zip(bounds, bounds[1:])] == [["a", " b", "."], [], ["c", " ", " d", "\n"]]


def test_words_are_encoded_once_whatever_stands_beside_them():
    known, given = byte_bpe.Encoder(BPE), []

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    words = ["".join(random.Random(n).choices("abcdefghijkl", k=12)) for n in range(500)]
    text = "".join(f" {w}{mark}\n{w}" for w in words for mark in (".", ",", ";", "?!", ")", "1"))
    texts = pa.array([text], pa.large_string())
    known.tokenizer = Counted(known.tokenizer)
    known.units(known.cut(texts)[0])
    # each word after a space and after a line end, in place of each with every mark
    assert sum(map(len, given)) < 30 * len(words) < len(text) / 5


@pytest.mark.parametrize("spans", ["none", "one"])
def test_units_that_cannot_be_told_apart_are_encoded_alone(library, spans):
    known = byte_bpe.Encoder(BPE)
    known.spans[slice(None) if spans == "none" else library.encode(" the").ids] = 0
    check_cut(known, library, strings(1500, ALPHABET, seed=5) + [" the end", "the"])


def test_another_pattern_is_cut_at_white_space_only(library, tmp_path):
    other = Tokenizer.from_file(BPE)
    split = pre_tokenizers.Split(Regex(r"\S?\p{L}+|\s|[^\p{L}\s]+"), "isolated")
    other.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    other.save(str(tmp_path / "other.json"))
    known = byte_bpe.Encoder(str(tmp_path / "other.json"))
    assert not known.known_pattern
    units_, codes, _ = known.cut(pa.array(["a.b c,d"], pa.large_string()))
    assert units_.take(pa.array(codes)).to_pylist() == ["a.b", " c,d"]
    given = ["...", "b", " c", "\nd", " ", ".b"]
    assert [np.frombuffer(x, "<u2").tolist() for x in known.encode(given)] == [other.encode(u, add_special_tokens=False).ids for u in given]


@pytest.mark.parametrize("given", [[], ["abc"], ["abc", " d", "e", " f\n", " g", ""], [" a", " b", "\n", " "]])
def test_units_are_encoded_one_by_one(library, given):
    want = [library.encode(u, add_special_tokens=False).ids for u in given]
    assert [np.frombuffer(x, "<u2").tolist() for x in byte_bpe.Encoder(BPE).encode(given)] == want


def test_whole_tokens_are_proven(library):
    whole = sorted(token_counts.whole_tokens(library))
    assert len(whole) > 40_000
    assert all(len(library.encode(s, add_special_tokens=False).ids) == 1 for s in whole[::50])


def test_counts_are_those_of_the_library(spark, library):
    texts = [t or "" for _, t, *_ in AWKWARD]
    want = sorted(
        ((i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 1024) for (i, *_), t in zip(AWKWARD, texts)),
        key=repr,
    )
    got = token_counts.token_counts(awkward(spark), BPE)
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.token_counts(empty(spark), BPE).count() == 0


def test_counts_of_a_table(spark, library):
    docs = sample(spark).collect()
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in docs}
    got = op8_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.n_tokens for r in got} == want


def digests(library, docs: list[tuple]) -> list[tuple]:
    out, start = [], 0
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0], len(d[1] or ""), d[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_ids", [50, 1 << 20])
def test_token_files_hold_all_ids_in_order(spark, library, shard_ids):
    folder = staging_path(spark, "test-token-files")
    token_files.write_token_files(awkward(spark), folder, BPE, shard_ids=shard_ids)
    got = rows(token_files.read_digests(spark, folder), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == digests(library, [(i, t) for i, t, *_ in AWKWARD])
    some = token_files.read_documents(spark, folder, [4, 8]).collect()
    assert {r.doc_id: r.ids for r in some} == {
        i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t, *_ in AWKWARD if i in (4, 8)
    }


def test_token_files_of_tables(spark, library):
    folder = staging_path(spark, "test-token-files")
    token_files.write_token_files(empty(spark), folder, BPE)
    assert token_files.read_digests(spark, folder).count() == 0
    got = op4_token_files(spark, "/root/testdata/sf0.001")
    docs = [(r.doc_id, r.text) for r in sample(spark).collect()]
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == digests(library, docs)


@pytest.mark.parametrize(
    "ids",
    [
        [],
        [7],
        [0] * 1000,
        [1, 2] * 5000,
        np.random.default_rng(0).integers(0, 3, 20_000),
        np.random.default_rng(1).integers(0, 60_000, 3_000),
    ],
)
def test_repair_round_trip_and_random_access(ids):
    ids = np.array(ids, dtype=np.uint16)
    shard = repair.Shard(repair.compress(ids, 60_000))
    assert (shard.ids() == ids).all() and shard.n_ids == len(ids)
    for start, stop in ((0, 1), (3, 3), (len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids) + 5)):
        start = max(0, start)
        assert shard.ids(start, stop).tolist() == ids[start:stop].tolist()


def test_repair_compresses_repetition():
    ids = np.tile(np.arange(40, dtype=np.uint16), 2000)
    assert len(repair.compress(ids, 60_000)) < ids.nbytes / 8


def test_repair_goes_on_while_rounds_pay():
    draw = np.random.default_rng(2)
    ids = np.tile(draw.integers(0, 60_000, 700, dtype=np.uint16), 1400)
    blob = repair.compress(ids, 60_000)
    assert len(blob) < ids.nbytes / 50 and (repair.Shard(blob).ids() == ids).all()
    # so many rules that a symbol takes more than 16 bits
    passages = draw.integers(0, 60_000, (3000, 10), dtype=np.uint16)
    ids = passages[draw.integers(0, 3000, 90_000)].ravel()
    blob = repair.compress(ids, 60_000)
    shard = repair.Shard(blob)
    assert len(shard.rules) > 1 << 13 and len(shard.sequence) < len(ids) / 5 and len(blob) < 0.4 * ids.nbytes
    assert (shard.ids() == ids).all() and shard.ids(1234, 45_678).tolist() == ids[1234:45_678].tolist()


def test_repair_replaces_all_pairs_that_pay():
    draw = np.random.default_rng(3)
    passages = draw.integers(0, 60_000, (8000, 10))
    ids = np.repeat(passages, 12, axis=0)[draw.permutation(96_000)].ravel()
    blob = repair.compress(ids, 60_000)
    assert len(blob) < 0.6 * 2 * len(ids) and (repair.Shard(blob).ids() == ids).all()
    assert len(repair.compress(draw.integers(0, 60_000, 5000), 60_000)) <= 2 * 5000 + repair.HEADER.size


def most_frequent(keys: np.ndarray) -> list[int]:
    counts = collections.Counter(keys.tolist())
    often = sorted((k for k, n in counts.items() if n >= repair.LEAST), key=lambda k: (-counts[k], k))
    return often[: repair.PAIRS]


@pytest.mark.parametrize("values, n", [(1, 5), (1, 50), (900, 40_000), (6000, 60_000), (50_000, 300_000), (400_000, 400_000)])
def test_repair_finds_the_most_frequent_pairs(values, n):
    draw = np.random.default_rng(values)
    for keys in (draw.integers(0, values, n), np.minimum(draw.zipf(1.2, n), 1 << 40)):
        keys = keys.astype(np.uint64) << np.uint64(20)
        assert repair._frequent(keys, repair._slots(keys)).tolist() == most_frequent(keys)
    # where all keys share one slot, or few
    assert repair._frequent(keys, np.zeros(n, dtype=np.int64)).tolist() == most_frequent(keys)


def test_repair_sorts_pairs_that_may_be_frequent_only(monkeypatch):
    draw = np.random.default_rng(6)
    ids = np.concatenate([draw.integers(0, 60_000, 200_000), np.tile(draw.integers(0, 60_000, 500), 40)])
    sizes, sort = [], np.sort
    monkeypatch.setattr(repair.np, "sort", lambda keys: sizes.append(len(keys)) or sort(keys))
    shard = repair.Shard(repair.compress(ids, 60_000))
    assert sizes and max(sizes) < len(ids) / 2 and (shard.ids() == ids).all()


def test_repair_expands_the_needed_symbols_only(monkeypatch):
    ids = np.tile(np.arange(1000), 500)
    shard, asked = repair.Shard(repair.compress(ids, 60_000)), []
    expanded = repair.Shard.expanded
    monkeypatch.setattr(repair.Shard, "expanded", lambda self, symbols: asked.append(expanded(self, symbols)) or asked[-1])
    assert shard.ids(250_500, 250_510).tolist() == list(range(500, 510))
    longest = int(shard.lengths.max())
    assert len(asked[0]) <= 2 * longest and len(asked) == 1


def best_segmentation(text: str) -> list[int]:
    """Plain dynamic programme over the characters of one text."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
    pieces = {sp.id_to_piece(i).replace("▁", " "): (i, sp.get_score(i)) for i in range(sp.get_piece_size()) if not special(i)}
    unknown = min(s for _, s in pieces.values()) - 10

    def segment(text: str) -> list[int]:
        if not text:
            return []
        text = " " + text.replace("▁", " ")
        best, back = [0.0] + [-math.inf] * len(text), [(0, [])] * (len(text) + 1)
        for s in range(len(text)):
            for e in range(s + 1, min(s + 16, len(text)) + 1):
                if (p := pieces.get(text[s:e])) and best[s] + p[1] > best[e]:
                    best[e], back[e] = best[s] + p[1], (s, [p[0]])
            if text[s] not in pieces and best[s] + unknown > best[s + 1]:
                best[s + 1], back[s + 1] = best[s] + unknown, (s, [3 + b for b in text[s].encode()])
        out, e = [], len(text)
        while e:
            e, ids = back[e]
            out = ids + out
        return out

    return segment


def test_segmentation_is_the_best_one(spark):
    segment = best_segmentation("")
    texts = strings(800, [*"ab e\n\ttheéñ你\U0001f600\x00.,▁", " the", "  "], seed=2) + ["x" * 200 + "你" * 50, " " * 100]
    model = sentencepieces.model(PIECES)
    ids, bounds = model.encode(pa.array(texts, pa.large_string()))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for n, (text, decoded) in enumerate(zip(texts, model.decode(ids, bounds))):
        own = ids[bounds[n] : bounds[n + 1]].tolist()
        assert own == segment(text), text
        assert decoded == library.decode(own) == text.replace("▁", " ")


def test_bytes_that_are_no_text_decode_like_the_library():
    model, library = sentencepieces.model(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = np.array([3 + 0xE4, 3 + 0xBD, 300, 3 + 0xFF, 0], dtype=np.int32)
    assert model.decode(ids, np.array([0, len(ids)])) == [library.decode(ids.tolist())]


def test_sentencepiece_of_awkward_rows(spark):
    got = sentencepieces.encode_decode(awkward(spark), PIECES).collect()
    want = {i: t for i, t, *_ in AWKWARD if i is not None}
    assert len(got) == len(AWKWARD)
    for r in got:
        if r.doc_id is not None:
            text = want[r.doc_id]
            assert r.decoded == (None if text is None else text.replace("▁", " "))
        assert (r.ids is None) == (r.decoded is None)
        assert r.n_pieces == len(r.ids or []) and r.n_bytes == sum(3 <= i < 259 for i in r.ids or [])
    assert sentencepieces.encode_decode(empty(spark), PIECES).count() == 0


def test_a_long_part_without_spaces_takes_little_memory():
    import tracemalloc

    known = sentencepieces.model(PIECES)
    part = ("añb你zzz9" * 40_000).encode()
    tracemalloc.start()
    ids = known.segment_one(part)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 14 * len(part)
    some = part[: 14 * 100]
    assert known.segment_one(some).tobytes() == known._side_by_side([some])[0]
    assert b"".join(known.surfaces[i] for i in ids) == part

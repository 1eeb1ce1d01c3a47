"""WARC archives: what is written is read back, and what is damaged costs itself only."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lendstrata.llm import warc
from lendstrata.llm.queries import op11_warc
from lendstrata.sources.staging import staging_path

from .cases import rows

PAGES = "page_id long, url string, html string, archive string, reason string, digest string, size int, copies int"
LONG = "<p>été</p>" * 100_000
AWKWARD = [
    (4, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (2, "http://a/0", "<p>one</p>"),
    (2, "http://a/0", "<p>one</p>"),
    (None, "http://a/3", "<p>one</p>"),
    (None, "http://b", "only without id"),
    (None, "http://b", "only without id"),
    (5, "http://é /x\r\nWARC-Type: none", None),
    (6, "", ""),
    (7, "http://long", LONG),
    (8, "http://x", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\x1f\x8b\x08 \x00 你好"),
    (10, "http://long", LONG),
]
READ = ["page", "payload_bytes", "payload_digest", "record_type", "refers"]


def frame(spark, data):
    return spark.createDataFrame([(*row, "x", "y", "z", 1, 2) for row in data], PAGES)


def digest(payload: str) -> str:
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def plain_records(data: list[tuple], least: int) -> list[tuple]:
    out, first = [], {}
    for page, url, html in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        html = html or ""
        size = len(html.encode())
        known = size >= least and html in first
        out.append((page, size, digest(html), "revisit" if known else "response", first[html] if known else None))
        first.setdefault(html, page)
    return sorted(out, key=repr)


def read_back(spark, df, least=0):
    folder = staging_path(spark, "warc-test")
    warc.write_archives(df, folder, least_bytes=least)
    read = warc.read_archives(spark, folder)
    assert read.where("reason is not null").count() == 0
    number = lambda urn: F.nullif(F.regexp_extract(urn, r"^urn:page:(-?\d+):", 1), F.lit("")).cast("long")
    return folder, read.withColumns({"page": number("record_id"), "refers": number("refers_to")})


@pytest.mark.parametrize("least", [0, 12, 10**7])
def test_awkward_pages(spark, least):
    _, read = read_back(spark, frame(spark, AWKWARD), least)
    assert rows(read, *READ) == plain_records(AWKWARD, least)
    kept = {r.payload.decode() for r in read.where("record_type = 'response'").collect()}
    assert kept == {html or "" for _, _, html in AWKWARD}


def test_no_pages(spark):
    _, read = read_back(spark, frame(spark, []))
    assert read.count() == 0


def test_targets_are_uris(spark):
    _, read = read_back(spark, frame(spark, AWKWARD))
    found = {r.page: r.target_uri for r in read.collect()}
    assert found[5] == "http://%C3%A9%20/x%0D%0AWARC-Type:%20none"
    assert found[6] is None and found[9] is None and found[7] == "http://long"


def test_a_payload_with_many_copies(spark):
    data = spark.range(20_000).select(
        F.col("id").alias("page_id"), F.lit("http://a").alias("url"),
        F.when(F.col("id") % 3 == 1, "<p>hot</p>").otherwise(F.concat(F.lit("<p>"), F.col("id").cast("string"))).alias("html"),
    )
    _, read = read_back(spark, data.repartition(8))
    assert read.count() == 20_000
    revisits = read.where("record_type = 'revisit'")
    assert revisits.count() == 6_666 and revisits.where("refers <> 1 or page % 3 <> 1").count() == 0


def test_archives_are_ordinary_gzip(spark):
    folder, _ = read_back(spark, frame(spark, AWKWARD))
    archives = [p.read_bytes() for p in Path(folder).glob("part-*")]
    text = b"".join(gzip.decompress(a) for a in archives)
    assert text.count(b"\r\nWARC-Record-ID: ") == len(AWKWARD)


def test_small_chunks_and_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 100)
    monkeypatch.setattr(warc, "CHUNKS_PER_ARCHIVE", 2)
    folder, read = read_back(spark, frame(spark, AWKWARD).coalesce(1))
    assert rows(read, *READ) == plain_records(AWKWARD, 0)
    assert len(list(Path(folder).glob("part-*"))) > 2


def test_the_table(spark):
    d = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows(op11_warc(spark, d), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == plain_records(data, 0)


# salvage


def pages(n: int, seed: int = 1) -> list[bytes]:
    draw = random.Random(seed)
    made = []
    for page in range(n):
        payload = bytes(draw.randrange(32, 127) for _ in range(draw.randrange(400)))
        made.append(warc.page_record(page, "http://a", payload, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), None, "2024-01-01T00:00:00Z"))
    return made


def found(archive: bytes) -> tuple[list[int], list[tuple[int, int, str]]]:
    read = list(warc.salvage(archive))
    numbers = [warc.page_of(r.header("WARC-Record-ID").strip("<>")) for _, _, records, _ in read for r in records]
    # bytes are told once, none is left out
    assert [0, *(end for _, end, _, _ in read)] == [*(start for start, _, _, _ in read), len(archive)]
    return numbers, [(start, end, reason) for start, end, _, reason in read if reason]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("seed", range(25))
def test_damage_costs_the_damaged_record_only(packed, seed):
    draw = random.Random(seed)
    parts = [warc.gzipped(r) if packed else r for r in pages(12, seed)]
    hit = draw.randrange(1, 11)
    broken = bytearray(parts[hit])
    kind = draw.choice(["flip", "cut", "zero", "gone", "added"])
    at = draw.randrange(len(broken) - 8)
    if kind == "flip":
        broken[at] ^= 0x41
    elif kind == "cut":
        del broken[at:]
    elif kind == "zero":
        broken[at : at + 200] = bytes(len(broken[at : at + 200]))
    elif kind == "gone":
        broken = bytearray()
    else:
        broken[at:at] = b"\x1f\x8b\x08WARC/1.0\r\nWARC/1.1\r\n"
    numbers, gaps = found(b"".join([*parts[:hit], bytes(broken), *parts[hit + 1 :]]))
    others = [n for n in range(12) if n != hit]
    # an id with a flipped byte may still be one, as digests leave headers out
    assert [n for n in numbers if n not in (hit, None)] == others
    if kind in ("cut", "zero", "added"):
        begun = sum(map(len, parts[:hit]))
        assert [(start, end) for start, end, _ in gaps] == [(begun, begun + len(broken))] or at == 0 or hit in numbers
    if kind == "gone":
        assert gaps == []


def test_reasons():
    a, b, c = pages(3)
    assert found(a + b[:-20]) == ([0], [(len(a), len(a) + len(b) - 20, "truncated")])
    packed = [warc.gzipped(x) for x in (a, b, c)]
    assert found(packed[0] + packed[1][:-3]) == ([0], [(len(packed[0]), len(packed[0]) + len(packed[1]) - 3, "truncated")])
    assert found(b"junk" + c) == ([2], [(0, 4, "no version line")])
    assert found(a.replace(b"http://a", b"http://b") + c)[0] == [0, 2]
    wrong = b.replace(b"Content-Length: ", b"Content-Length: 1", 1)
    assert found(a + wrong + c)[0] == [0, 2]
    changed = b[:-6] + b"??" + b[-4:]
    assert found(a + changed + c) == ([0, 2], [(len(a), len(a) + len(b), "WARC-Block-Digest differs")])
    assert found(b"") == ([], [])
    assert found(b"\x1f\x8b\x08" * 50)[0] == []
    assert found(gzip.compress(b"no record at all") + packed[2])[1][0][2] == "member of something else"
    assert found(b"WARC/1.0\r\n\r\nx")[1] == [(0, 13, "no content length")]


def test_a_member_may_hold_several_records():
    many = b"".join(pages(5))
    assert found(gzip.compress(many)) == ([0, 1, 2, 3, 4], [])
    assert found(gzip.compress(many) + warc.SEPARATOR + gzip.compress(pages(1)[0])) == ([0, 1, 2, 3, 4, 0], [])


def test_gaps_are_logged(spark, folder):
    parts = [warc.gzipped(r) for r in pages(6)]
    Path(f"{folder}/in").mkdir()
    Path(f"{folder}/in/a.warc.gz").write_bytes(b"".join([*parts[:2], parts[2][:50], *parts[3:]]))
    Path(f"{folder}/in/b.warc").write_bytes(b"".join(pages(3, 2)))
    Path(f"{folder}/in/c.warc").write_bytes(b"")
    records = warc.log_gaps(warc.read_archives(spark, f"{folder}/in"), f"{folder}/gaps")
    assert records.count() == 8 and "reason" not in records.columns
    gap = spark.read.parquet(f"{folder}/gaps").collect()
    start = len(parts[0]) + len(parts[1])
    assert [(r.archive.rsplit("/", 1)[1], r.offset, r.length) for r in gap] == [("a.warc.gz", start, 50)]


def test_other_kinds_of_records():
    info = warc.written({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:x:1>", "Content-Type": "application/warc-fields", "X-Folded": "a\r\n b"}, b"software: x\r\n")
    (_, _, (record,), _), = warc.salvage(info)
    assert record.payload() == b"software: x\r\n" and record.payload_bytes() == 13
    assert record.header("x-folded") == "a b"
    for missing in ("WARC-Type", "WARC-Record-ID"):
        kept = {"WARC-Type": "metadata", "WARC-Record-ID": "<urn:x:1>"} | {missing: ""}
        assert [reason for *_, reason in warc.salvage(warc.written(kept, b""))] == [f"no {missing}"]

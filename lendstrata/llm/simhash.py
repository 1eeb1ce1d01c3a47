"""SimHash near-duplicates by deletion-variant signatures.

Two fingerprints that differ in at most k bits agree, up to one bit, in at least one of
k // 2 + 1 segments: were there two differing bits in each, there would be more than k. Every
fingerprint is therefore indexed by its segments with one bit position wildcarded (64 short
keys for 64 bits), an equality join of these keys finds all candidates, and the join condition
verifies the distance. Copies share a fingerprint and are grouped first, so the join sees
each fingerprint once, whatever the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import row_order, stage, word_blocks
from .components import components, lowest_of

BITS = 64


def bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit set, from the lowest bit on."""
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit SimHash of a UTF-8 text; 0 without words."""
    counts, total, carried = np.zeros(BITS, dtype=np.int64), 0, []
    for block in word_blocks((text or b"").lower()):  # bytes.lower() changes A-Z only
        carried += block
        grams = zip(*(carried[i:] for i in range(shingle)))
        hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
        if hashes:
            counts += bit_counts(hashes)
            total += len(hashes)
            carried = carried[len(carried) - shingle + 1 :]
    if not total and carried:
        counts, total = bit_counts([xxhash.xxh64_intdigest(b" ".join(carried), 42)]), 1
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, content, fp)`` of every document, ``content`` a hash that tells rows with
    equal ids apart; a NULL text has no words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = pa.array((fingerprint(t.as_py(), shingle) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), fps], ["doc_id", "content", "fp"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), content(F.col("text")).alias("content"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, content long, fp long")


def content(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def _segments(distance: int) -> list[tuple[int, int]]:
    """``(first bit, bit after the last)`` of each segment."""
    n = distance // 2 + 1
    return [(BITS * i // n, BITS * (i + 1) // n) for i in range(n)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _mask(start: int, end: int) -> int:
    return _signed((1 << end) - (1 << start))


def links(fps: DataFrame, distance: int) -> DataFrame:
    """``(a, b)``: all pairs a < b of the distinct fingerprints ``fp`` within the distance,
    each once. The keys are joined by sorting: Spark sizes them as it sizes the fingerprints,
    of which there are 64 times fewer, and would gather them at the driver to broadcast them."""
    segments = _segments(distance)
    wilds = F.array(
        *(
            F.struct(
                F.lit(s).alias("segment"),
                F.lit(_signed(1 << p)).alias("wild"),
                F.lit(p == start).alias("first"),
                F.lit(_mask(start, end) & ~_signed(1 << p)).alias("mask"),
            )
            for s, (start, end) in enumerate(segments)
            for p in range(start, end)
        )
    )
    keyed = fps.select("fp", F.explode(wilds).alias("w")).select(
        "fp", "w.segment", "w.wild", "w.first", F.col("fp").bitwiseAND(F.col("w.mask")).alias("rest")
    )
    left, right = keyed.hint("merge").alias("l"), keyed.hint("merge").alias("r")
    differs = F.col("l.fp").bitwiseXOR(F.col("r.fp"))

    def within(s: int) -> Column:
        return differs.bitwiseAND(F.lit(_mask(*segments[s])))

    # a pair agrees under several keys: the first segment that qualifies, and there the
    # wildcard on the differing bit or else on the segment's first bit, is the one that counts
    own = F.lit(False)
    for s in range(len(segments)):
        here = (F.col("l.segment") == s) & (
            (within(s) == F.col("l.wild")) | ((within(s) == 0) & F.col("l.first"))
        )
        for earlier in range(s):
            here = here & (F.bit_count(within(earlier)) > 1)
        own = own | here
    return left.join(
        right,
        (F.col("l.segment") == F.col("r.segment"))
        & (F.col("l.wild") == F.col("r.wild"))
        & (F.col("l.rest") == F.col("r.rest"))
        & (F.col("l.fp") < F.col("r.fp"))
        & (F.bit_count(differs) <= distance)
        & own,
    ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id, root, content`` of every row of
    ``docs (doc_id, text, ...)``.

    Texts without words, NULL included, have fingerprint zero and link like any other; a text
    of fewer words than a shingle is one shingle. Repeated rows stay, with the same component.
    ``component_id`` is the smallest doc_id reachable over links of at most ``distance``
    bits, NULL only where all reachable ids are NULL; ``root``, the component's smallest
    fingerprint, tells components apart even where ids repeat. Further columns are not looked
    at. An empty table gives an empty result.
    """
    hashed = stage(fingerprints(docs, shingle), "simhash")
    groups = hashed.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = components(links(groups.select("fp"), distance), "simhash")
    rooted = groups.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root")
    )
    labels = lowest_of(stage(rooted, "simhash-roots"), "root", "first_id", "component_id").select("fp", "component_id", "root")
    digits = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0").alias(c if c == "root" else "fingerprint")
    return hashed.join(labels, "fp").select("doc_id", digits("fp"), "component_id", digits("root"), "content")


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each component with all its columns: the smallest id, NULL last; of rows with
    that id the one with the smallest hash of its text, and of those with that text, too, the
    one whose other columns come first (``row_order``), once. The order of the input has no
    influence."""
    found = near_duplicates(docs, shingle, distance)
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")).alias("first")
    )
    first = first.select(F.col("first.doc_id").alias("__id"), F.col("first.content").alias("__content")).distinct()
    rows = docs.select(F.struct("*").alias("__row"), content(F.col("text")).alias("__hash"))
    kept = rows.join(
        first, rows["__row.doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__content"))
    )
    nth = F.row_number().over(Window.partitionBy("__id", "__content").orderBy(*row_order(docs)))
    return kept.withColumn("__nth", nth).where("__nth = 1").select("__row.*")

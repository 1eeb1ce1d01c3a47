"""Token files: documents as ids, Re-Pair compressed in shards, in ascending doc_id order.

A file set is a Parquet folder that Spark writes and commits, so it can lie wherever Spark
can write, and a lost executor leaves no half-written shard. A row is a shard: ``part`` and
``shard`` order it, ``doc_ids`` and ``n_tokens`` list its documents, ``n_ids`` sums them,
``blob`` is the shard of ``repair.py``. A shard ends with the document that fills it, so every
document lies in one shard; one that is longer than a shard has one to itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .byte_bpe import encoder
from .repair import Shard, compress
from .units import gather, slices, sums

SHARD_IDS = 1 << 20
#: Text that is encoded at a time: the more, the fewer units are encoded twice.
SLICE_BYTES = 5 << 20
SCHEMA = "part int, shard int, doc_ids array<bigint>, n_tokens array<bigint>, n_ids bigint, blob binary"
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("shard", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("n_ids", pa.int64()),
        ("blob", pa.binary()),
    ]
)


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> None:
    """Write ``docs (doc_id, text, ...)`` with the tokenizer file at ``path``, ``end_id`` after
    each document.

    A NULL text is an empty one: its end id alone. NULL ids come first; rows with equal ids
    stay, longer texts after shorter ones and then by text. An empty table gives a folder
    without shards. Other columns are not written.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, shard = TaskContext.get(), 0
        part = context.partitionId() if context else 0
        known = encoder(path)
        terminals = known.tokenizer.get_vocab_size()
        ids, owners, counts, held = [], [], [], 0

        def full() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            row = [[part], [shard], [np.concatenate(owners)], [np.concatenate(counts)], [len(flat)], [compress(flat, terminals)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(row, _ARROW)], schema=_ARROW)

        for batch, texts in slices(batches, SLICE_BYTES):
            units, codes, bounds = known.cut(texts)
            flat, starts, lengths = known.units(units)
            # the end id is one more unit, after the last of each document
            starts = np.append(starts, len(flat))
            lengths = np.append(lengths, 1)
            flat = np.append(flat, np.uint16(end_id))
            codes = np.insert(codes, bounds[1:], len(units))
            bounds = bounds + np.arange(len(bounds))
            tokens = sums(lengths[codes], bounds)
            stream, after = gather(flat, starts, lengths, codes), np.cumsum(tokens)
            doc_ids = np.array(batch.column("doc_id").to_pylist(), dtype=object)
            at = 0
            while at < len(tokens):
                begun = int(after[at - 1]) if at else 0
                stop = min(len(tokens), int(np.searchsorted(after, begun + shard_ids - held)) + 1)
                ids.append(stream[begun : int(after[stop - 1])])
                owners.append(doc_ids[at:stop])
                counts.append(tokens[at:stop])
                held += len(ids[-1])
                at = stop
                if held >= shard_ids:
                    yield full()
                    ids, owners, counts, held, shard = [], [], [], 0, shard + 1
        if owners:
            yield full()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.length("text"), "text"
    )
    ordered.mapInArrow(run, SCHEMA).write.parquet(folder)


def read_documents(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of some documents; only their symbols are expanded."""
    wanted = frozenset(doc_ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, ends = Shard(row["blob"]), np.cumsum(row["n_tokens"])
                hits = [k for k, d in enumerate(row["doc_ids"]) if d in wanted]
                found = [shard.ids(int(ends[k]) - row["n_tokens"][k], int(ends[k])).astype(np.int64) for k in hits]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"][k] for k in hits], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                    ["doc_id", "ids"],
                )

    shards = spark.read.schema(SCHEMA).parquet(folder)
    some = shards.where(F.arrays_overlap("doc_ids", F.array(*(F.lit(d).cast("long") for d in wanted))))
    return some.select("doc_ids", "n_tokens", "blob").mapInArrow(run, "doc_id long, ids array<bigint>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of a file set, from its ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                counts = batch.column("n_tokens")[n].values.to_numpy()
                raw = memoryview(Shard(batch.column("blob")[n].as_py()).ids().astype("<u4").tobytes())
                ends = np.cumsum(counts)
                starts = ends - counts
                crcs = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(starts.tolist(), ends.tolist())]
                same = [pa.array(np.full(len(counts), batch.column(c)[n].as_py(), dtype=np.int32)) for c in ("part", "shard")]
                yield pa.RecordBatch.from_arrays(
                    [*same, batch.column("doc_ids")[n].values, pa.array(starts), pa.array(counts), pa.array(crcs, pa.int64())],
                    ["part", "shard", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.schema(SCHEMA).parquet(folder)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    earlier = (Window.unboundedPreceding, -1)
    # one row for each file of the set
    parts = parts.select("part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(*earlier))
    offsets = shards.select("part", "shard", F.coalesce(within, F.lit(0)).alias("skip")).join(parts, "part")
    digests = shards.select("part", "shard", "doc_ids", "n_tokens", "blob").mapInArrow(
        run, "part int, shard int, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    return digests.join(offsets, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("skip") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )

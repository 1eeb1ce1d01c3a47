"""What several operators of this package share: tables, words, hashes, staging."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendstrata.sources.staging import staging_path

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_GAP_BYTES = re.compile(rb"[\x20\x09-\x0D]")
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; none for NULL."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP, -1)
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words as a long, counted from the gaps without keeping the words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, GAP, -1))).cast("long")


def word_blocks(text: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in lists of about ``size`` bytes of text, so that a very
    long text never becomes one list. ``bytes.split`` splits at exactly the gaps of WORD."""
    at = 0
    while at < len(text):
        gap = _GAP_BYTES.search(text, min(at + size, len(text)))
        end = gap.end() if gap else len(text)
        yield text[at:end].split()
        at = end


def row_order(rows: DataFrame, row: str = "__row") -> list[Column]:
    """An order of rows held in the struct column ``row`` by all that they hold: a hash, then the
    columns as text. Rows that stand equal in it are equal."""
    columns = [F.col(f"{row}.`{c}`") for c in rows.columns]
    absent = [c.isNull() for c in columns]
    return [F.xxhash64(*columns, *absent), F.to_json(F.col(row), {"ignoreNullFields": "false"})]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder that all executors share and return a scan of it: lineage ends
    here, and a lost executor costs no recomputation."""
    return stage_at(df, label)[0]


def stage_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

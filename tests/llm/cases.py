"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, fp string, row string"
LONG = "the quick brown fox of " * 30_000


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``(doc_id, text, lang, source)`` with further columns whose names operators use too."""
    full = [(i, t, lang, s, None if t is None else len(t), "x", "y", None, "z") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


AWKWARD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, "   \n\t ", None, "b"),
    (4, "one", "de", "b"),
    (5, "The fox and the dog, the cat.", "en", "a"),
    (5, "The fox and the dog, the cat.", "en", "a"),
    (6, "The fox and the dog, the cat.", "en", "a"),
    (None, "no id here at all", "en", None),
    (None, None, None, None),
    (7, LONG, "en", "c"),
    (8, "café 你好 \U0001f600 \x00 ▁x <|endoftext|> '+1'", "fr", "c"),
    (9, "!!! ### $$$ 123 456", None, "c"),
]


def awkward(spark: SparkSession) -> DataFrame:
    return documents(spark, AWKWARD)


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def sample(spark: SparkSession, sf: str = "sf0.001") -> DataFrame:
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").orderBy(F.col("doc_id"))

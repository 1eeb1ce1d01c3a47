"""From raw documents to encoded training data: stages that each call one operator.

Each stage works on all that its predecessor kept, read back from Parquet. Documents that the
quality rules reject go; one document of each group of near-duplicates stays; personal data is
replaced by pseudonyms; documents are repeated or left out until the sources have their
weights; what is left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendstrata.llm import mixing, pii, quality, sentencepieces, simhash
from lendstrata.llm.common import stage, table
from lendstrata.llm.queries import PSEUDONYM_KEY, tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passed(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=4, distance=4)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the text where there is such a column."""
    made = pii.pseudonymize(docs, PSEUDONYM_KEY)
    if "n_chars" not in docs.columns:
        return made
    kind = docs.schema["n_chars"].dataType
    return made.withColumn("n_chars", F.length("text").cast(kind))


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, weights=(5, 2, 1), share=1.5, epochs=2)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_decode(docs, tokenizer("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("source_weights", source_weights),
    ("sentencepiece", encoded),
]

#: SimHash, pseudonyms and SentencePiece have no SQL; tests compare with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

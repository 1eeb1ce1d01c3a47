"""The operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendstrata.sources.staging import staging_path

from . import (
    collocations,
    language,
    mixing,
    pii,
    quality,
    runs,
    secret_scan,
    sentencepieces,
    simhash,
    token_counts,
    token_files,
    vectors,
    warc,
)
from .common import discard, stage_at, table, words

#: Key of the pseudonyms of the queries; a deployment hands its own secret to the operator.
PSEUDONYM_KEY = "pseudonyms of the queries"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return sentencepieces.encode_decode(table(spark, d, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"), shingle=4, distance=4)


def op3_language(spark: SparkSession, d: str) -> DataFrame:
    return language.learn_and_identify(table(spark, d, "documents"))


def op4_token_files(spark: SparkSession, d: str) -> DataFrame:
    folder = staging_path(spark, "token-files")
    token_files.write_token_files(table(spark, d, "documents"), folder, tokenizer("byte_bpe_50k.json"))
    return token_files.read_digests(spark, folder)


def op5_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), weights=(5, 2, 1), share=1.5, epochs=2)


def op6_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    made = quality.judged(docs)
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return made.select(F.col("doc_id").cast("long").alias("doc_id"), *base)


def op7_pii(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), pii.pseudonymized(F.col("text"), PSEUDONYM_KEY).alias("made")
    )
    return found.select("doc_id", "made.text", "made.n_found", "made.kinds")


def op8_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.token_counts(table(spark, d, "documents"), tokenizer("byte_bpe_50k.json"), limit=1024)


def op9_vectors(spark: SparkSession, d: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, d, "embeddings"), threshold=0.9)


def op10_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.scan(table(spark, d, "documents"))


def op11_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = staging_path(spark, "warc")
    warc.write_archives(table(spark, d, "pages"), folder, least_bytes=0)
    read, _ = stage_at(warc.read_archives(spark, folder, payloads=False), "warc-read")
    records = warc.log_gaps(read, staging_path(spark, "warc-gaps"))
    discard(spark, folder)
    page = lambda urn: F.regexp_extract(urn, r"^urn:page:(-?\d+):", 1)
    return records.select(
        F.nullif(page("record_id"), F.lit("")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.nullif(page("refers_to"), F.lit("")).cast("long").alias("refers_to"),
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the repetition that the contract of op12 puts into every tenth
    document: from word a on, its words are replaced by a cycle of p of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.floor(h / 10).alias("g"), (h % 10 == 0).alias("hit"))
    rows = rows.withColumn("words", F.when(F.col("hit"), words(F.col("text")))).withColumn("n", F.size("words"))
    a = F.col("g") % F.greatest("n", F.lit(1))
    rows = rows.withColumn("a", a.cast("int")).withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    cycles = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.expr("int((n - a) div p + 1)")))
    changed = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(cycles, F.lit(1), F.col("n") - F.col("a")))
    text = F.when(F.col("hit") & (F.col("n") > 0), F.array_join(changed, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def op12_runs(spark: SparkSession, d: str) -> DataFrame:
    found = runs.periodic_runs(with_periods(table(spark, d, "documents")), least=24, power=3)
    longest = F.reduce(
        F.slice("runs", F.lit(2), F.size("runs")),
        F.get("runs", F.lit(0)),
        lambda best, run: F.when(run.length * best.period > best.length * run.period, run).otherwise(best),
    )
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run.start, run.length, run.period), F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(table(spark, d, "documents"), least=100, longest=5, top=2000, absorbed_pct=100)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = (
        op1_sentencepiece,
        op2_simhash,
        op3_language,
        op4_token_files,
        op5_mixing,
        op6_quality,
        op7_pii,
        op8_token_counts,
        op9_vectors,
        op10_secrets,
        op11_warc,
        op12_runs,
        op13_collocations,
    )
    return {f.__name__: f for f in each}

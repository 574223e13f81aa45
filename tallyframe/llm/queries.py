"""One registered query per operator, over the whole documents table, and the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import class_lm, fingerprints, hard_negatives, language_id, line_dedup, mixing, near_dedup, packing, prefix_trie, quality
from tallyframe.llm import secrets, substring_dedup, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "lang", "source", "text")
    return quality.judged(docs, with_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.with_copies(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return class_lm.scored(docs, *class_lm.learned(docs))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(_documents(spark, sf_dir).select("doc_id", "text"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup_substrings(_documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"), shingle=3, percent=85)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.with_secrets(_documents(spark, sf_dir).select("doc_id", "text"))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS]
    base, every = secrets.written(F.col("base")), secrets.written(F.array_sort(F.concat("base", "added")))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    return language_id.with_language(docs.drop("lang"), language_id.learned(docs))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.trie(prefix_trie.with_heads(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_mix_sources": op2_mix_sources,
    "op3_class_lm": op3_class_lm,
    "op4_fingerprints": op4_fingerprints,
    "op5_line_dedup": op5_line_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_packing": op9_packing,
    "op10_language_id": op10_language_id,
    "op11_warc": op11_warc,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}

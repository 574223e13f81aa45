"""The corpus pipeline: quality rules, line dedup, near-duplicates, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import line_dedup, mixing, near_dedup, packing, quality
from tallyframe.llm.base import saved

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie within the fences of their language and source."""
    return quality.filtered(docs.select(*COLUMNS))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without lines that other documents repeat; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return kept.select(*[F.char_length("text").cast("long").alias(c) if c == "n_chars" else c for c in COLUMNS])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return near_dedup.deduplicated(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mix_sources", mix_sources),
    ("packing", pack),
]

ORACLE_SQL = None  # packing needs a tokenizer, which SQL has not


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what each returns is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

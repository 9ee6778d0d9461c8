"""From raw documents to packed training sequences: language, recurring lines, near duplicates, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import language_id, line_dedup, near_copies, packing
from ledgerloom.llm.common import materialise

#: Stages that only trained models and iterative linking can express have no SQL equivalent.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language: those without a letter or with a calibrated score below the threshold go."""
    model = language_id.train(docs, ~language_id.held_out())
    return language_id.identify(docs, model).where("NOT __lang.rejected").select(*docs.columns)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that recur across documents; documents of which no word is left go."""
    kept = line_dedup.drop_recurring_lines(docs).where(
        (F.col("__dropped") == 0) | F.col("text").rlike(r"[^\s]"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("__dropped") == 0, F.col("n_chars")).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by SimHash and for the rest by min-hash: that with the smallest id."""
    return near_copies.keep_first(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in the training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_recurring_lines),
    ("simhash_dedup", drop_near_copies),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; what a stage returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

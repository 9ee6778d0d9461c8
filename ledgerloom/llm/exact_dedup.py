"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import mark_found, repeated_filter, text_of

#: Characters hashed in the second step.
PREFIX_CHARS = 64


def refine_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """Decide for every row which row of its group of identical texts stays: that with the largest id.

    Each step looks only at rows that the step before could not tell apart: lengths that one row has end there,
    then prefixes, and SHA-256 of the whole text is taken of the surviving groups alone. Texts never move between
    machines, only lengths and hashes. A group of any size is counted before it is shuffled.

    Null text counts as empty. Rows that repeat both id and text are one document: they count in ``group_size``
    and share one decision. Null ids lose to any other id; a group of null ids has a null ``keep_id`` and is kept.
    An empty table gives an empty result. Other columns are ignored but for those in ``carry``.

    Returns id, carried columns, ``keep_id``, ``group_size``, ``kept``.
    """
    rows = docs.select(F.col(id_col).alias("__id"), *[F.col(c).alias(f"__carry_{c}") for c in carry],
                       text_of(text_col).alias("__text"))
    rows = rows.withColumn("__bytes", F.octet_length("__text"))

    length = [F.col("__bytes")]
    rows = mark_found(rows, length, repeated_filter(rows, length), "__same_length")
    rows = rows.withColumn(
        "__prefix", F.when(F.col("__same_length"), F.xxhash64(F.substring("__text", 1, prefix_chars))))

    prefix = [F.col("__bytes"), F.col("__prefix")]
    rows = mark_found(
        rows, prefix, repeated_filter(rows.where(F.col("__prefix").isNotNull()), prefix), "__same_prefix")
    refined = F.col("__same_length") & F.col("__same_prefix")
    # rows that are told apart already get a key of their own, which spreads them and matches no hash
    own = F.concat_ws(":", F.lit("own"), F.xxhash64("__id", "__bytes"))
    rows = rows.withColumn("__full", F.when(refined, F.sha2("__text", 256)).otherwise(own)).drop("__text")

    key = ["__bytes", "__full"]
    groups = rows.where(~F.col("__full").startswith("own:")).groupBy(*key).agg(
        F.max("__id").alias("__keep"), F.count(F.lit(1)).alias("__size")).where("__size > 1")
    # dealt anew on both sides, so that the rows of a large group can be split over tasks
    return rows.join(groups.hint("rebalance"), key, "left").select(
        F.col("__id").alias(id_col), *[F.col(f"__carry_{c}").alias(c) for c in carry],
        F.when(F.col("__size").isNull(), F.col("__id")).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("__size").isNull() | F.col("__id").eqNullSafe(F.col("__keep"))).alias("kept"))

"""Importance resampling towards a target distribution over hashed word n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from ledgerloom.llm.common import materialise, ship_code, text_of
from ledgerloom.llm.prefix_crc import ngram_crcs

#: Fixed values of the contract: words in a feature, buckets, least words of a drawn document, share drawn, seed.
LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED = 3, 10_000, 20, 5, 42


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all whole texts fall in each bucket; a task hands on one row a bucket.

    Null texts have no features. The driver gets ``buckets`` numbers, whatever the size of the table.
    """
    ship_code(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc, _, _ in ngram_crcs((t.as_py() for t in batch.column(0)), LONGEST):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counted = texts.select(text_of(text_col).alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    found = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[r["bucket"]] = r["n"]
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in the target to that in the source, rounded down."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1) * (s_all + n)) / ((s + 1) * (t_all + n))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight`` (sum of gains over all features) of every row."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for owner, crc, of_word, _ in ngram_crcs((t.as_py() for t in batch.column(1)), LONGEST):
                # sums of whole numbers far below 2^53 are exact in doubles
                weight += np.bincount(owner, gain[crc % np.uint32(len(gain))], n).astype(np.int64)
                features += np.bincount(owner, minlength=n)
                words += np.bincount(of_word, minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, features, weight))],
                                             ["id", "n_words", "n_features", "weight"])

    schema = T.StructType([rows.schema["id"], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))])
    return rows.mapInArrow(run, schema)


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel value that the seed and the id fix, rounded down; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, most: int) -> DataFrame:
    """All rows with their ``rank`` from 1 by the highest ``score``, ties by ``id``; null from ``most`` + 1 on.

    Rows are dealt by ranges of the order and numbered inside each; the sizes of the ranges before are added up. So no
    task sorts more than its range, and ranges beyond the last drawn row are not sorted at all. The ranges are written
    once, so a lost executor can't move their ends.
    """
    columns = scored.columns
    order = [F.desc("score"), F.asc_nulls_first("id"), F.asc("salt")]
    # the salt lets a range end inside rows that are equal
    salted = scored.withColumn("salt", F.xxhash64("id", F.monotonically_increasing_id()))
    dealt = materialise(salted.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    before = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = dealt.groupBy("part").count().select("part", F.coalesce(before, F.lit(0)).alias("base"))
    based = dealt.join(F.broadcast(bases), "part")  # a row for each range
    rank = F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    drawn = based.where(F.col("base") < most).withColumn("rank", rank.cast("long"))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = based.where(F.col("base") >= most).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select(*columns, "rank")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Draw ``percent`` of the documents without replacement, with chances by their likeness to ``target``.

    Features are all runs of one to three words, hashed into buckets; a document's weight is the sum of its features'
    gains, its score that plus a Gumbel value, and the highest scores among documents of ``least_words`` and more are
    drawn (Gumbel top-k). Null and empty texts have no features, weight 0 and are never drawn; an empty target gives
    every bucket its smoothed share. Ties go to the smaller id; rows that repeat an id are ranked each, in any order
    among themselves. An empty table gives an empty result; other columns are ignored.

    Returns ``id_col``, ``n_features``, ``weight``, ``score``, ``rank`` (null if not drawn) for every row.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    weighed = weigh(docs, gain, id_col, text_col)
    scored = materialise(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scored")
    enough = F.col("n_words") >= least_words
    most = scored.where(enough).count() * percent // 100
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.where(enough), most).unionByName(rest).select(
        F.col("id").alias(id_col), "n_features", "weight", "score", "rank")

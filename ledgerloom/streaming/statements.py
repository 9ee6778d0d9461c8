"""Exact, unbounded deduplication of arriving statement lines.

No watermark: a line seen once is never forgotten. The table itself is the state, so memory
does not grow with history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.bitmaps import has_bit, slot
from ledgerloom.operators.statements import dedup


# Lines with equal identity have equal dates, so a month is all that a batch has to be compared with.
MONTH = "_month"
IDENTITY = ("tenant_id", "dedup_hash")
_BITMAPS = f"bucket bigint, known binary, load_id bigint, {MONTH} string"


def _by_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("none")))


def _store(rows: DataFrame, table: str, load_id: int, mode: str) -> None:
    """One load: its lines, and per month a bitmap of their identities beside the table."""
    # a month is a file or, where it is big, as many as rebalancing makes of it
    lines = _by_month(rows).hint("rebalance", MONTH).persist()
    try:
        lines.write.mode(mode).partitionBy(MONTH).parquet(f"{table}/load_id={load_id}")
        at = slot(IDENTITY)
        bitmaps = lines.groupBy(MONTH, F.bitmap_bucket_number(at).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("known"))
        bitmaps.hint("rebalance", MONTH).write.mode(mode).partitionBy(MONTH).parquet(f"{_known(table)}/load_id={load_id}")
    finally:
        lines.unpersist()


def _known(table: str) -> str:
    return f"{table.rstrip('/')}_known"


def create_table(existing: DataFrame, table: str) -> None:
    """Seed the table with the lines known so far (possibly none); a no-op if it exists."""
    _store(existing, table, -1, "ignore")


def read_lines(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    parts = [T.StructField("load_id", T.LongType()), T.StructField(MONTH, T.StringType())]
    return spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(table)


def maybe_known(table: str, lines: DataFrame, batch_id: int) -> DataFrame:
    """Lines that an earlier load may have: only bitmaps of their months are read, and what they rule out is new."""
    marked = _by_month(lines).withColumn("_slot", slot(IDENTITY))
    months = [r[0] for r in marked.select(MONTH).distinct().collect()]
    stored = lines.sparkSession.read.schema(_BITMAPS).parquet(_known(table))
    known = stored.filter((F.col("load_id") < batch_id) & F.col(MONTH).isin(months)).groupBy(
        F.col(MONTH).alias("_of"), "bucket").agg(F.bitmap_or_agg("known").alias("known"))
    joined = marked.join(known, (F.col(MONTH) == F.col("_of")) & (F.bitmap_bucket_number("_slot") == F.col("bucket")), "inner")
    return joined.filter(has_bit(F.col("known"), F.col("_slot"))).select(*lines.columns, MONTH)


def earlier_lines(table: str, schema: T.StructType, lines: DataFrame, batch_id: int) -> DataFrame:
    """Lines of earlier loads in the months of those ``lines`` that may be known already; no file of another month is
    opened, and none at all where the bitmaps know none of the lines."""
    months = [r[0] for r in maybe_known(table, lines, batch_id).select(MONTH).distinct().collect()]
    if not months:
        return lines.sparkSession.createDataFrame([], schema)
    stored = read_lines(lines.sparkSession, table, schema)
    return stored.filter((F.col("load_id") < batch_id) & F.col(MONTH).isin(months))


def insert_new_lines(table: str, schema: T.StructType, prepare: Callable[[DataFrame], DataFrame]):
    """``foreachBatch`` handler: lines not in any earlier batch become one ``load_id=N`` folder.

    The comparison reads only the identity columns of earlier loads, in months for which a bitmap says that a line may
    be known; a replayed batch compares against exactly the same earlier loads, so it writes the same rows again. The
    batch is prepared once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        lines = prepare(batch).persist()
        try:
            fresh = dedup(lines, earlier_lines(table, schema, lines, batch_id))
            _store(fresh, table, batch_id, "overwrite")
        finally:
            lines.unpersist()

    return handle


def compact_lines(spark: SparkSession, table: str, schema: T.StructType, out: str) -> str:
    """Write all lines as the first load of a new table, which later batches go on from."""
    create_table(read_lines(spark, table, schema).drop("load_id", MONTH), out)
    return out


def stream_lines(source: DataFrame, table: str, checkpoint: str, schema: T.StructType,
                 prepare: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    return (
        source.writeStream.foreachBatch(insert_new_lines(table, schema, prepare))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )

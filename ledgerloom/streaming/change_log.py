"""Idempotent upserts from a stream, as an append-only change log.

Every micro-batch writes its own ``batch_id=N`` folder and touches nothing else, so its cost
follows the batch and not the table. Replaying a batch after a failure overwrites the same
folder with the same rows. The stream's checkpoint is the cursor: it advances only after
the batch was written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.merge import keyed_merge, pick_winner

Prepare = Callable[[DataFrame], DataFrame]


def _batch_path(log: str, batch_id: int) -> str:
    return f"{log}/batch_id={batch_id}"


def write_batch(rows: DataFrame, log: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(_batch_path(log, batch_id))


def append_changes(log: str, keys: Sequence[str], order: Sequence[Column], prepare: Prepare | None = None):
    """``foreachBatch`` handler: the winner per key of a micro-batch becomes one log folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        write_batch(pick_winner(rows, keys, order), log, batch_id)

    return handle


def stream_changes(source: DataFrame, log: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column],
                   prepare: Prepare | None = None) -> StreamingQuery:
    """Drain what has arrived into the log and stop."""
    return (
        source.writeStream.foreachBatch(append_changes(log, keys, order, prepare))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def create_log(spark: SparkSession, log: str, schema: T.StructType) -> None:
    """Start an empty log; does nothing where one exists."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(_batch_path(log, -1))


def read_log(spark: SparkSession, log: str, schema: T.StructType) -> DataFrame:
    """All logged changes with the micro-batch that brought them; none where there is no log yet. Writes nothing."""
    logged = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(logged).parquet(log)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], logged)


def net_changes(log: DataFrame, keys: Sequence[str], insert_only: Sequence[str]) -> DataFrame:
    """One row per key: latest values, except that insert-only columns come from the first change.

    Both picks are partial aggregates, so a key that changes all the time costs one row per task.
    """
    columns = [c for c in log.columns if c != "batch_id"]
    latest = [c for c in columns if c not in keys and c not in insert_only]
    picks = [F.max_by(F.struct(*latest), "batch_id").alias("_last")]
    if insert_only:
        picks.append(F.min_by(F.struct(*insert_only), "batch_id").alias("_first"))
    folded = log.groupBy(*keys).agg(*picks)
    source = {**{c: f"_last.{c}" for c in latest}, **{c: f"_first.{c}" for c in insert_only}}
    return folded.select(*[F.col(source.get(c, c)).alias(c) for c in columns])


def current_state(base: DataFrame, log: DataFrame, keys: Sequence[str], insert_only: Sequence[str] = ()) -> DataFrame:
    """Base table with the log merged in: what an in-place upsert per batch would hold."""
    return keyed_merge(base, net_changes(log, keys, insert_only).select(*base.columns), keys, insert_only)


def compact(base: DataFrame, log: DataFrame, keys: Sequence[str], out: str, insert_only: Sequence[str] = ()) -> str:
    """Write the current state as the next base; the log can start afresh behind it."""
    current_state(base, log, keys, insert_only).write.mode("errorifexists").parquet(out)
    return out

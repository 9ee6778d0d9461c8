"""Run log: outcomes from events, summaries per invocation, upsert counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.dates import micros_between
from ledgerloom.operators.joins import attach


def run_outcomes(events: DataFrame) -> DataFrame:
    """``run_id, kind, at, seq, error`` -> status, times and first error of each run.

    ``kind`` is ``started``, ``step_failed``, ``step_completed`` or ``finished``. A failed
    step fails its run; a run that was not finished or failed is still running.
    """
    failed = F.col("kind") == "step_failed"
    ended = F.col("kind").isin("finished", "step_failed")
    runs = events.groupBy("run_id").agg(
        F.min(F.when(F.col("kind") == "started", F.col("at"))).alias("started_at"),
        F.max(F.when(ended, F.col("at"))).alias("ended_at"),
        F.count_if(failed).alias("failures"),
        F.count_if(F.col("kind") == "finished").alias("finishes"),
        F.min(F.when(failed, F.struct("at", "seq", "error"))).alias("first_failure"),
    )
    status = F.when(F.col("failures") > 0, "failed").when(F.col("finishes") > 0, "completed").otherwise("running")
    runs = runs.withColumn("status", status)
    done = F.when(F.col("status") != "running", F.col("ended_at"))
    return runs.select(
        "run_id", "status", "started_at", done.alias("completed_at"),
        F.floor(micros_between(done, F.col("started_at")) / 1000).cast("bigint").alias("duration_ms"),
        F.col("first_failure.error").alias("error"),
    )


def runner_summary(runs: DataFrame, invocation: str) -> DataFrame:
    """Per invocation of the runner: connections attempted, succeeded and failed."""
    return runs.groupBy(invocation).agg(
        F.count(F.lit(1)).alias("total_connections"),
        F.count_if(F.col("status") == "completed").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        micros_between(F.max("completed_at"), F.min("started_at")).alias("_micros"),
    ).withColumn("duration_ms", F.floor(F.col("_micros") / 1000).cast("bigint")).drop("_micros")


def isolate_failures(connections: DataFrame, rows: DataFrame, rejects: DataFrame,
                     spread_by: str = "source_id") -> tuple[DataFrame, DataFrame]:
    """Land the pulls of connections without a bad record, and none of the others: (rows that land, outcomes).

    ``connections`` (column ``id``) are those that were pulled, ``rows`` their good records and ``rejects`` their bad
    ones (``connection_id``, ``reason``, ``raw``). One job serves all connections: the rejects are counted by connection
    and the rows of failed ones are left out by a look-up salted with ``spread_by``, so no connection waits for another and a big one is
    many tasks. Outcomes: ``connection_id``, ``status``, ``landed``, ``rejected``, ``error`` (the first reason by name),
    one row a connection, also where nothing was delivered.
    """
    failed = rejects.groupBy("connection_id").agg(
        F.count(F.lit(1)).alias("rejected"), F.min(F.struct("reason", "raw"))["reason"].alias("error"))
    marked = attach(rows, failed, {"connection_id": "connection_id"}, {"_failed": "connection_id"},
                    spread_by=(spread_by,), hot_keys=True)
    landed = marked.filter(F.col("_failed").isNull()).drop("_failed")
    counted = landed.groupBy("connection_id").agg(F.count(F.lit(1)).alias("landed"))
    pulled = connections.select(F.col("id").alias("connection_id")).distinct()
    outcomes = pulled.join(counted, "connection_id", "left").join(failed, "connection_id", "left").select(
        "connection_id", F.when(F.col("rejected").isNull(), "completed").otherwise("failed").alias("status"),
        F.coalesce("landed", F.lit(0)).alias("landed"), F.coalesce("rejected", F.lit(0)).alias("rejected"), "error")
    return landed, outcomes


def summary_of_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Rows per entity and in total, from counts that came with the writes."""
    rows = [*counts.items(), ("total", sum(counts.values()))]
    return spark.createDataFrame(rows, "entity string, upserted bigint")


def transform_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows upserted per entity (inserted and updated alike) and in total.

    ``tables`` are the transformed rows themselves, so a row that a transform loses or repeats shows in its count.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("upserted")).select(F.lit(entity).alias("entity"), "upserted")
        for entity, df in tables.items()
    ]
    totals = reduce(DataFrame.unionByName, parts).rollup("entity").agg(F.sum("upserted").alias("upserted"))
    return totals.select(F.coalesce("entity", F.lit("total")).alias("entity"), "upserted")

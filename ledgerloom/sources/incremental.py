"""Incremental reads against per-connection cursors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.operators.joins import attach


def changed_since(raw: DataFrame, checkpoints: DataFrame, entity: str) -> DataFrame:
    """Records modified at or after the cursor of their connection; no cursor means all.

    The cursor has one-second precision on the wire. Overlap is harmless: merges are idempotent.
    """
    cursors = checkpoints.filter(F.col("entity") == entity)
    joined = attach(raw, cursors, {"connection_id": "connection_id"}, {"_cursor": "last_modified_at"},
                    spread_by=("source_id",), hot_keys=True)
    fresh = F.col("_cursor").isNull() | (F.col("source_updated_at") >= F.date_trunc("second", "_cursor"))
    return joined.filter(fresh).drop("_cursor")


#: Partition column of a clustered raw table: the month of a record's last change.
CHANGED, NEVER = "_changed", "none"


def _month(moment: Column) -> Column:
    return F.coalesce(F.date_format(moment, "yyyy-MM"), F.lit(NEVER))


def cluster_by_change(raw: DataFrame, path: str) -> None:
    """Store a raw table for :func:`changed_since_pruned`: by month of change, in files of few connections and days."""
    dealt = raw.withColumn(CHANGED, _month(F.col("source_updated_at")))
    order = [CHANGED, "connection_id", "source_updated_at"]
    dealt.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").partitionBy(CHANGED).parquet(path)


def changed_since_pruned(spark: SparkSession, path: str, checkpoints: DataFrame, entity: str,
                         connections: DataFrame) -> DataFrame:
    """:func:`changed_since` for ``connections`` (column ``id``) over a stored table of :func:`cluster_by_change`.

    The least cursor is asked for first, one number, and becomes a literal in the scan: months before it are not
    among its files, and row groups before it are skipped; the exact filter per connection follows. A cursor of a
    connection that is not wanted, disconnected long ago, holds nothing back. Connections without a cursor are read in
    full, by a scan of their own that there is only if there are any.
    """
    stored = spark.read.parquet(path)
    wanted = connections.select(F.col("id").alias("connection_id")).distinct()
    cursors = checkpoints.filter((F.col("entity") == entity) & F.col("last_modified_at").isNotNull()).select(
        "connection_id", F.date_trunc("second", "last_modified_at").cast("timestamp_ntz").alias("_since"))
    cursors = cursors.join(wanted, "connection_id", "left_semi")
    least = cursors.agg(F.min("_since").alias("at")).first()["at"]
    new = wanted.join(cursors, "connection_id", "left_anti")
    parts = []
    if least is not None:
        late = stored.filter((F.col(CHANGED) >= least.strftime("%Y-%m")) & (F.col(CHANGED) != NEVER)
                             & (F.col("source_updated_at") >= F.lit(least)))
        joined = attach(late, cursors, {"connection_id": "connection_id"}, {"_since": "_since"},
                        spread_by=("source_id",), how="inner", hot_keys=True)
        parts.append(joined.filter(F.col("source_updated_at") >= F.col("_since")).drop("_since"))
    if least is None or not new.isEmpty():
        known = attach(stored, new, {"connection_id": "connection_id"}, {"_new": "connection_id"},
                       spread_by=("source_id",), how="inner", hot_keys=True).drop("_new")
        parts.append(known)
    return reduce(DataFrame.unionByName, parts).drop(CHANGED)


def active_connections(connections: DataFrame, connection_id: str | None = None) -> DataFrame:
    """Active connections, oldest first; optionally just one by id."""
    active = connections.filter("is_active")
    if connection_id is not None:
        active = active.filter(F.col("id") == connection_id)
    return active.orderBy("created_at", "id")

"""Keyed merges into a table stored by tenant and month: only the partitions that a load touches are read and written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.operators.merge import keyed_merge

#: Partition columns: a hash of the tenant, and the month of the first write of a row.
BUCKET, MONTH = "_bucket", "_month"
BUCKETS = 64


def placed(rows: DataFrame, tenant: str, day: str, buckets: int = BUCKETS, period: str = "yyyy-MM") -> DataFrame:
    """Add the partition that a new row goes to; ``period`` is the pattern of a date's part in it."""
    month = F.coalesce(F.date_format(day, period), F.lit("none"))
    return rows.withColumns({BUCKET: F.pmod(F.xxhash64(tenant), F.lit(buckets)).cast("int"), MONTH: month})


def _write(rows: DataFrame, path: str, keys: Sequence[str], mode: str, overwrite: str) -> None:
    # a partition is one file or, where it is big, as many as rebalancing makes of it
    dealt = rows.hint("rebalance", BUCKET, MONTH).sortWithinPartitions(BUCKET, MONTH, *keys)
    dealt.write.mode(mode).option("partitionOverwriteMode", overwrite).partitionBy(BUCKET, MONTH).parquet(path)


def create_partitioned(rows: DataFrame, path: str, keys: Sequence[str], tenant: str, day: str, buckets: int = BUCKETS,
                       period: str = "yyyy-MM") -> None:
    """Store a table for :func:`merge_partitions`; it must not exist yet."""
    _write(placed(rows, tenant, day, buckets, period), path, keys, "errorifexists", "static")


def read_partitioned(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The table without its partition columns."""
    return spark.read.parquet(path).select(*columns)


def _in(partitions: Sequence[tuple[int, str]]) -> Column:
    """Exact filter on partition columns, grouped by bucket so that its size is that of the list."""
    chosen = F.lit(False)
    for bucket in sorted({b for b, _ in partitions}):
        chosen = chosen | ((F.col(BUCKET) == bucket) & F.col(MONTH).isin(sorted(m for b, m in partitions if b == bucket)))
    return chosen


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], tenant: str, day: str,
                     insert_only: Sequence[str] = (), order: Sequence[Column] | None = None,
                     buckets: int = BUCKETS, period: str = "yyyy-MM") -> list[tuple[int, str]]:
    """Upsert ``source`` into a stored table as :func:`keyed_merge` would, and return the partitions written.

    A row stays in the partition of its first write, so a later change of its day never moves it: every key is in one
    partition, and a merge that was cut short can be run again. ``tenant`` must not change for a key; it is a key or
    set by the first write only. Known keys are found by reading the key columns of the tenants' buckets alone; then
    the partitions that hold them, and those that new keys go to, are read, merged and overwritten. All other
    partitions keep their files. ``buckets`` and ``period`` are those the table was created with. The driver sees only the names of touched partitions.
    """
    stored = spark.read.schema(_stored_schema(spark, path)).parquet(path)
    columns = [c for c in stored.columns if c not in (BUCKET, MONTH)]
    arriving = placed(source.select(*columns), tenant, day, buckets, period).persist()
    try:
        touched_buckets = sorted(r[0] for r in arriving.select(BUCKET).distinct().collect())
        if not touched_buckets:
            return []
        held = stored.filter(F.col(BUCKET).isin(touched_buckets)).select(*keys, BUCKET, MONTH)
        known = held.join(arriving.select(*keys).distinct(), list(keys), "left_semi")
        at = known.withColumnsRenamed({BUCKET: "_at_bucket", MONTH: "_at_month"})
        located = arriving.join(at, list(keys), "left").withColumns({
            BUCKET: F.coalesce("_at_bucket", BUCKET), MONTH: F.coalesce("_at_month", MONTH)}).drop("_at_bucket", "_at_month")
        located = located.persist()
        try:
            touched = [(r[0], r[1]) for r in located.select(BUCKET, MONTH).distinct().collect()]
            target = stored.filter(_in(touched))
            merged = keyed_merge(target, located, keys, [*insert_only, BUCKET, MONTH], order=order)
            _write(merged, path, keys, "overwrite", "dynamic")
        finally:
            located.unpersist()
    finally:
        arriving.unpersist()
    return sorted(touched)


def _stored_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of the stored table; months like 2024-01 stay text."""
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name not in (BUCKET, MONTH)]
    return T.StructType([*fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(MONTH, T.StringType())])

"""Streams equal their batch form, over several micro-batches and after a replay."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.functions.dates import ts_literal
from ledgerloom.operators import statements
from ledgerloom.streaming import change_log, statements as lines

SCHEMA = "k string, v int, first string, at timestamp_ntz"


def land(spark, data, path):
    """One file per call, so that every call is a micro-batch."""
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(n):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=n)


def test_change_log_equals_successive_upserts(spark, scratch):
    landing, log = f"{scratch}/landing", f"{scratch}/log"
    schema = spark.createDataFrame([], SCHEMA).schema
    base = spark.createDataFrame([("a", 0, "base", at(0)), ("z", 0, "base", at(0))], SCHEMA)
    change_log.create_log(spark, log, schema)
    assert rows(change_log.current_state(base, change_log.read_log(spark, log, schema), ["k"], ["first"])) == rows(base)

    def drain():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        change_log.stream_changes(source, log, f"{scratch}/cp", ["k"], [F.desc("at")]).awaitTermination()

    land(spark, [("a", 1, "one", at(1)), ("a", 2, "late", at(0)), ("b", 1, "one", at(1))], landing)
    drain()
    land(spark, [("b", None, "two", at(2))], landing)
    land(spark, [("c", 3, "three", at(3)), ("a", 9, "three", at(3))], landing)
    drain()
    current = change_log.current_state(base, change_log.read_log(spark, log, schema), ["k"], ["first"])
    want = [("a", 9, "base"), ("b", None, "one"), ("c", 3, "three"), ("z", 0, "base")]
    assert rows(current, "k", "v", "first") == want
    assert change_log.read_log(spark, log, schema).select("batch_id").distinct().count() == 3

    # replay of a batch that was already written
    handler = change_log.append_changes(log, ["k"], [F.desc("at")])
    handler(spark.createDataFrame([("c", 3, "three", at(3)), ("a", 9, "three", at(3))], SCHEMA), 2)
    again = change_log.current_state(base, change_log.read_log(spark, log, schema), ["k"], ["first"])
    assert rows(again, "k", "v", "first") == want
    compacted = change_log.compact(base, change_log.read_log(spark, log, schema), ["k"], f"{scratch}/base2", ["first"])
    assert rows(spark.read.parquet(compacted), "k", "v", "first") == want


def test_statement_stream_equals_batch(spark, scratch):
    raw = "batch_id string, tenant_id string, row_index int, raw map<string,string>"
    days = ["2025-01-01", "2025-01-02", "01/01/2025"]
    def rows_of(b, n):
        return [(b, "t1", i, {"Date": days[i % 3], "Description": "x", "Amount": str(i % 4)}) for i in range(n)]

    def prepare(batch):
        return statements.to_lines(statements.good_rows(statements.normalise(batch)), ts_literal("2025-02-01 00:00:00"))

    landing, table = f"{scratch}/landing", f"{scratch}/table"
    batches = [rows_of("b1", 5), rows_of("b2", 12), rows_of("b3", 3)]
    for b in batches:
        spark.createDataFrame(b, raw).coalesce(1).write.mode("append").parquet(landing)
    empty = prepare(spark.createDataFrame([], raw))
    lines.create_table(empty, table)
    source = spark.readStream.schema(spark.read.parquet(landing).schema).option("maxFilesPerTrigger", 1).parquet(landing)
    lines.stream_lines(source, table, f"{scratch}/cp", empty.schema, prepare).awaitTermination()
    got = lines.read_lines(spark, table, empty.schema)
    want = statements.dedup(prepare(spark.createDataFrame(sum(batches, []), raw)))
    assert rows(got, "dedup_hash") == rows(want, "dedup_hash")

    before = rows(got, "id", "load_id")
    lines.insert_new_lines(table, empty.schema, prepare)(spark.createDataFrame(batches[1], raw), 1)
    assert rows(lines.read_lines(spark, table, empty.schema), "id", "load_id") == before


def test_a_late_batch_opens_only_its_months(spark, scratch):
    schema = "tenant_id string, dedup_hash string, batch_id string, row_index int, date date"
    def frame(data):
        return spark.createDataFrame([(*r[:4], dt.date.fromisoformat(r[4]) if r[4] else None) for r in data], schema)

    table = f"{scratch}/table"
    old = frame([("t", "a", "b", 0, "2024-01-05"), ("t", "b", "b", 1, "2024-02-05"), ("t", "c", "b", 2, None)])
    lines.create_table(old, table)
    late = frame([("t", "b", "c", 0, "2024-02-05"), ("t", "d", "c", 1, "2024-02-06"), ("t", "c", "c", 2, None)])
    earlier = lines.earlier_lines(table, old.schema, late, 5)
    assert rows(earlier, "dedup_hash") == [("b",), ("c",)]
    plan = earlier._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_id" in plan and "_month" in plan.split("PartitionFilters")[1].split("]")[0]
    lines.insert_new_lines(table, old.schema, lambda b: b)(late, 5)
    assert rows(lines.read_lines(spark, table, old.schema), "dedup_hash") == [("a",), ("b",), ("c",), ("d",)]
    lines.compact_lines(spark, table, old.schema, f"{scratch}/next")
    assert rows(lines.read_lines(spark, f"{scratch}/next", old.schema), "dedup_hash", "load_id") == [(h, -1) for h in "abcd"]


def test_reading_a_missing_log_writes_nothing(spark, scratch):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert change_log.read_log(spark, f"{scratch}/none", schema).count() == 0
    import os
    assert not os.path.exists(f"{scratch}/none")


def test_a_batch_of_new_lines_opens_no_data_file(spark, scratch):
    schema = "tenant_id string, dedup_hash string, batch_id string, row_index int, date date"
    day = dt.date(2024, 1, 5)
    table = f"{scratch}/table"
    old = spark.createDataFrame([("t", f"old{i}", "b", i, day) for i in range(300)], schema)
    lines.create_table(old, table)
    new = spark.createDataFrame([("t", f"new{i}", "c", i, day) for i in range(20)], schema)
    known = {r.dedup_hash for r in lines.maybe_known(table, old.unionByName(new), 5).collect()}
    assert {f"old{i}" for i in range(300)} <= known
    assert lines.maybe_known(table, old, -1).count() == 0
    fresh = new.filter(~new["dedup_hash"].isin(sorted(known)))
    assert fresh.count() >= 19
    earlier = lines.earlier_lines(table, old.schema, fresh, 5)
    assert earlier.inputFiles() == [] and earlier.count() == 0
    lines.insert_new_lines(table, old.schema, lambda b: b)(new.unionByName(old.limit(7)), 5)
    assert lines.read_lines(spark, table, old.schema).count() == 320

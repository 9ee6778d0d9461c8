"""Merges, reads and totals that follow the changes and not the table."""

from __future__ import annotations

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.functions.dates import ts_literal
from ledgerloom.operators import cascade, merge, partitioned, runs
from ledgerloom.plans import ageing_store, refresh
from ledgerloom.sources import incremental
from ledgerloom.streaming import change_log

KEYS = ("k",)
TABLE = "k string, tenant_id string, date date, v int, first string"


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                full = os.path.join(folder, name)
                found[os.path.relpath(full, path)] = os.stat(full).st_mtime_ns
    return found


def some_rows(seed, n, word, keys=200):
    rng = random.Random(seed)
    chosen = rng.sample(range(keys), n)
    return [(f"k{i}", f"t{i % 3}", rng.choice([None, dt.date(2024, 1 + rng.randrange(12), 5)]), rng.choice([None, i]), word) for i in chosen]


def test_partition_merges_equal_whole_merges(spark, scratch):
    path = f"{scratch}/table"
    state = spark.createDataFrame(some_rows(0, 80, "old"), TABLE)
    partitioned.create_partitioned(state, path, KEYS, "tenant_id", "date", buckets=4)
    for load in (1, 2, 3):
        source = spark.createDataFrame(some_rows(load, 60, f"load {load}"), TABLE)
        state = spark.createDataFrame(merge.keyed_merge(state, source, KEYS, ("first", "tenant_id")).collect(), TABLE)
        partitioned.merge_partitions(spark, path, source, KEYS, "tenant_id", "date", ("first", "tenant_id"), buckets=4)
        got = partitioned.read_partitioned(spark, path, state.columns)
        assert rows(got) == rows(state)
        # once more changes nothing
        partitioned.merge_partitions(spark, path, source, KEYS, "tenant_id", "date", ("first", "tenant_id"), buckets=4)
        assert rows(partitioned.read_partitioned(spark, path, state.columns)) == rows(state)


def test_untouched_partitions_keep_their_files(spark, scratch):
    path = f"{scratch}/table"
    table = [(f"k{i}", f"t{i % 3}", dt.date(2024, 1 + i % 12, 1), i, "old") for i in range(120)]
    partitioned.create_partitioned(spark.createDataFrame(table, TABLE), path, KEYS, "tenant_id", "date")
    before = files(path)
    # a known row whose date moves, and a new one
    source = spark.createDataFrame([("k5", "t2", dt.date(2025, 3, 1), -1, "new"), ("new", "t0", dt.date(2024, 2, 1), 7, "new")], TABLE)
    touched = partitioned.merge_partitions(spark, path, source, KEYS, "tenant_id", "date", ("first", "tenant_id"))
    assert sorted(m for _, m in touched) == ["2024-02", "2024-06"]
    after = files(path)
    kept = {f for f in before if after.get(f) == before[f]}
    changed = {os.path.dirname(f) for f in set(before) - kept}
    assert changed <= {f"_bucket={b}/_month={m}" for b, m in touched} and len(kept) >= len(before) - 2
    got = {r.k: (r.date, r.v, r["first"]) for r in partitioned.read_partitioned(spark, path, ["k", "date", "v", "first"]).collect()}
    assert len(got) == 121 and got["k5"] == (dt.date(2025, 3, 1), -1, "old") and got["new"][1] == 7


def test_partition_merge_guards_and_empty_sources(spark, scratch):
    path = f"{scratch}/table"
    partitioned.create_partitioned(spark.createDataFrame(some_rows(0, 20, "old"), TABLE), path, KEYS, "tenant_id", "date")
    before = files(path)
    assert partitioned.merge_partitions(spark, path, spark.createDataFrame([], TABLE), KEYS, "tenant_id", "date") == []
    assert files(path) == before
    twice = spark.createDataFrame([("a", "t", None, 1, "x"), ("a", "t", None, 2, "x")], TABLE)
    with pytest.raises(Exception, match="occurs more than once"):
        partitioned.merge_partitions(spark, path, twice, KEYS, "tenant_id", "date")
    partitioned.merge_partitions(spark, path, twice, KEYS, "tenant_id", "date", order=[F.desc("v")])
    assert [r.v for r in partitioned.read_partitioned(spark, path, ["k", "v"]).filter("k = 'a'").collect()] == [2]


RAW = "connection_id string, source_id string, source_updated_at timestamp_ntz, amount int"


@pytest.fixture
def raw(spark):
    day = lambda m, d: dt.datetime(2024, m, d, 10)
    made = [(str(c), f"{c}-{m}", day(m, 1 + c), m) for c in range(4) for m in range(1, 13)]
    return spark.createDataFrame([*made, ("1", "none", None, 0), ("3", "none", None, 0), ("9", "other", day(12, 30), 0)], RAW)


def test_pruned_reads_equal_whole_ones(spark, scratch, raw):
    cursors = spark.createDataFrame(
        [("0", "payments", dt.datetime(2024, 9, 1, 10, 0, 0, 5000)), ("1", "payments", dt.datetime(2024, 11, 2, 10)),
         ("2", "contacts", dt.datetime(2020, 1, 1)), ("9", "payments", dt.datetime(2019, 1, 1))],
        "connection_id string, entity string, last_modified_at timestamp_ntz")
    incremental.cluster_by_change(raw, f"{scratch}/raw")
    for wanted in (["0", "1"], ["0", "1", "2", "3"], ["2"], []):
        connections = spark.createDataFrame([(c,) for c in wanted], "id string")
        got = incremental.changed_since_pruned(spark, f"{scratch}/raw", cursors, "payments", connections)
        want = incremental.changed_since(raw.filter(F.col("connection_id").isin(wanted)), cursors, "payments")
        assert rows(got, *raw.columns) == rows(want, *raw.columns)


def test_cursor_reaches_the_scan(spark, scratch, raw):
    cursors = spark.createDataFrame([("0", "payments", dt.datetime(2024, 11, 1)), ("1", "payments", dt.datetime(2024, 12, 1))],
                                    "connection_id string, entity string, last_modified_at timestamp_ntz")
    incremental.cluster_by_change(raw, f"{scratch}/raw")
    df = incremental.changed_since_pruned(spark, f"{scratch}/raw", cursors, "payments", spark.createDataFrame([("0",), ("1",)], "id string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "GreaterThanOrEqual(source_updated_at,2024-11-01" in plan
    assert "_changed" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "2024-11" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert {r.source_id for r in df.collect()} == {"0-11", "0-12", "1-12"}


def invoices(spark, made, day):
    from ledgerloom.functions.finance import days_overdue, is_overdue

    df = spark.createDataFrame([(f"i{k}", f"t{k % 2}", str(k), kind, status, due, None if amount is None else Decimal(amount)) for k, kind, status, due, amount in made],
                               "id string, tenant_id string, source_id string, type string, status string, due_date date, amount_due decimal(15,2)")
    flags = [f(F.col("status"), F.col("due_date"), F.lit(day)).alias(n) for f, n in ((is_overdue, "is_overdue"), (days_overdue, "days_overdue"))]
    return df.select(*df.columns, *flags, ts_literal("2024-01-01 00:00:00").alias("warehouse_updated_at"))


def random_invoices(seed, keys, n):
    rng = random.Random(seed)
    due = lambda: rng.choice([None, dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(200))])
    return [(k, "ACCREC" if k % 5 else "ACCPAY", rng.choice(["AUTHORISED", "SUBMITTED", "PAID", "VOIDED", "DRAFT"]), due(),
             rng.choice([None, 0, 5, 5, 10, 70, 70, 100])) for k in rng.sample(range(keys), n)]


@pytest.mark.parametrize(("last", "now"), [("2024-02-01", "2024-04-15"), ("2024-04-15", "2024-02-01"), ("2024-03-01", "2024-03-01")])
def test_redating_equals_a_full_refresh(spark, scratch, last, now):
    last, now = dt.date.fromisoformat(last), dt.date.fromisoformat(now)
    old, new = random_invoices(1, 120, 90), random_invoices(2, 120, 50)
    base, log = f"{scratch}/base", f"{scratch}/log"
    invoices(spark, old, last).write.parquet(f"{base}/fact_invoice")
    change_log.write_batch(invoices(spark, new, last), f"{log}/fact_invoice", 0)
    for _ in range(2):  # a replay writes the same rows
        refresh.redate_overdue(spark, base, log, 1, last, now, ts_literal("2024-05-01 00:00:00"))
    got = refresh.dated_invoices(refresh.read_current(spark, base, log, "fact_invoice"), now)
    state = {m[0]: m for m in old} | {m[0]: m for m in new}
    types = {m[0]: m[1] for m in new} | {m[0]: m[1] for m in old}
    want = invoices(spark, [(k, types[k], *m[2:]) for k, m in state.items()], now)
    columns = [c for c in want.columns if c != "warehouse_updated_at"]
    assert rows(got, *columns) == rows(want, *columns)
    logged = spark.read.parquet(f"{log}/fact_invoice/batch_id=1")
    flipped = sum(a.is_overdue != b.is_overdue for a, b in zip(
        invoices(spark, list(state.values()), last).orderBy("id").collect(), want.orderBy("id").collect(), strict=True))
    assert logged.count() == flipped


def test_redating_reads_a_range_of_due_dates(spark, scratch):
    base, log = f"{scratch}/base", f"{scratch}/log"
    invoices(spark, random_invoices(1, 120, 90), dt.date(2024, 2, 1)).write.parquet(f"{base}/fact_invoice")
    seen = []
    keep, change_log.write_batch = change_log.write_batch, lambda df, *a: seen.append(df._jdf.queryExecution().executedPlan().toString())
    try:
        refresh.redate_overdue(spark, base, log, 0, dt.date(2024, 2, 1), dt.date(2024, 2, 2), ts_literal("2024-05-01 00:00:00"))
    finally:
        change_log.write_batch = keep
    assert "GreaterThanOrEqual(due_date,2024-02-01)" in seen[0] and "LessThan(due_date,2024-02-02)" in seen[0]


def test_ageing_totals_follow_the_log(spark, scratch):
    base, log, store, day = f"{scratch}/base", f"{scratch}/log", f"{scratch}/totals", dt.date(2024, 5, 1)
    tenants = spark.createDataFrame([("t0",), ("t1",)], "id string")
    invoices(spark, random_invoices(0, 150, 120), day).write.parquet(f"{base}/fact_invoice")
    ageing_store.start(spark.read.parquet(f"{base}/fact_invoice"), store)
    for load in range(3):
        change_log.write_batch(invoices(spark, random_invoices(load + 5, 150, 40), day), f"{log}/fact_invoice", load)
        for _ in range(1 + (load == 1)):  # one load is folded twice
            ageing_store.fold_load(spark, base, log, load, store)
        now = refresh.read_current(spark, base, log, "fact_invoice")
        whole = ageing_store._total(ageing_store._open_items(now))
        assert rows(ageing_store.read_totals(spark, store)) == rows(whole)
        for at in (day, dt.date(2024, 2, 1)):
            assert rows(ageing_store.ageing_summary(ageing_store.read_totals(spark, store), tenants, at)) == rows(
                ageing_store.ageing_summary(whole, tenants, at))


EDGES = [("b", ("a_id",), "a", ("id",)), ("c", ("b_id",), "b", ("id",)), ("c", ("a_id",), "a", ("id",)), ("d", ("c_x", "c_y"), "c", ("x", "y"))]


def test_cascades_reach_every_level(spark):
    tables = {
        "a": spark.createDataFrame([(1,), (2,), (3,)], "id int"),
        "b": spark.createDataFrame([(10, 1), (20, 2), (30, None)], "id int, a_id int"),
        "c": spark.createDataFrame([(1, 1, 10, 2), (2, 1, 20, 2), (3, 1, 30, 1), (4, 1, 30, 3), (5, None, None, None)], "x int, y int, b_id int, a_id int"),
        "d": spark.createDataFrame([(1, 1, 1), (2, 3, 1), (3, 4, 1), (4, 9, None)], "id int, c_x int, c_y int"),
        "e": spark.createDataFrame([(1, 1), (2, 3)], "id int, a_id int"),
    }
    assert cascade.delete_order(EDGES).index("a") < cascade.delete_order(EDGES).index("c") < cascade.delete_order(EDGES).index("d")
    removed = {"a": spark.createDataFrame([(1,)], "id int"), "b": spark.createDataFrame([(20,), (20,)], "id int")}
    left, held = cascade.cascade_tables(tables, removed, EDGES, [("e", ("a_id",), "a", ("id",))])
    assert {n: sorted(r[0] for r in df.collect()) for n, df in left.items()} == {"a": [2, 3], "b": [30], "c": [4, 5], "d": [3, 4]}
    assert [tuple(r) for r in held.collect()] == [("e.a_id", 1)]
    only, none = cascade.cascade_tables(tables, {"e": spark.createDataFrame([(2,)], "id int")}, EDGES)
    assert rows(only["e"]) == [(1, 1)] and set(only) == {"e"} and none is None
    with pytest.raises(ValueError):
        cascade.delete_order([*EDGES, ("a", ("d_id",), "d", ("id",))])


def test_failing_connections_land_nothing(spark):
    connections = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "id string")
    good = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), ("3", "d")], "connection_id string, source_id string")
    bad = spark.createDataFrame([("2", "unreadable", "x"), ("2", "bad value", None), ("4", "no key", "y")], "connection_id string, reason string, raw string")
    landed, outcomes = runs.isolate_failures(connections, good, bad)
    assert rows(landed) == [("1", "a"), ("1", "b"), ("3", "d")]
    assert rows(outcomes) == [("1", "completed", 2, 0, None), ("2", "failed", 0, 2, "bad value"), ("3", "completed", 1, 0, None),
                              ("4", "failed", 0, 1, "no key")]

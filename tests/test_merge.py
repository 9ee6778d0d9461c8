"""Keyed writes: update lists, first-write-wins columns, idempotence, both join strategies."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.functions.dates import ts_literal
from ledgerloom.operators import merge
from ledgerloom.operators.joins import attach

SCHEMA = "k string, v int, first string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(params=[False, True])
def small(request):
    return request.param


def test_merge_updates_inserts_and_keeps(spark, small):
    target = frame(spark, [("a", 1, "x"), ("b", 2, "x")])
    source = frame(spark, [("b", None, "y"), ("c", 3, "y")])
    assert rows(merge.keyed_merge(target, source, ["k"], small_source=small)) == [("a", 1, "x"), ("b", None, "y"), ("c", 3, "y")]
    assert rows(merge.keyed_merge(target, source, ["k"], insert_only=["first"], small_source=small)) == [
        ("a", 1, "x"), ("b", None, "x"), ("c", 3, "y")]


def test_merge_is_idempotent(spark, small):
    target = frame(spark, [("a", 1, "x"), ("b", 2, "x")])
    source = frame(spark, [("b", 9, "y"), ("c", 3, "y")])
    once = merge.keyed_merge(target, source, ["k"], ["first"], small_source=small)
    assert rows(merge.keyed_merge(once, source, ["k"], ["first"])) == rows(once)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    t=st.dictionaries(st.sampled_from("abcdef"), st.one_of(st.none(), st.integers(0, 9)), max_size=5),
    s=st.dictionaries(st.sampled_from("abcdef"), st.one_of(st.none(), st.integers(0, 9)), max_size=5),
)
def test_merge_matches_a_dictionary(spark, t, s):
    target = frame(spark, [(k, v, "old") for k, v in t.items()])
    source = frame(spark, [(k, v, "new") for k, v in s.items()])
    expected = {k: (v, "old") for k, v in t.items()}
    for k, v in s.items():
        expected[k] = (v, expected[k][1] if k in expected else "new")
    want = sorted(((k, *v) for k, v in expected.items()), key=repr)
    for chosen in (merge._merge_full_outer, merge._merge_small_source):
        assert rows(chosen(target, source, ["k"], ["k", "v", "first"], {"v"})) == want


def test_insert_ignore(spark):
    target = frame(spark, [("a", 1, "x")])
    source = frame(spark, [("a", 5, "y"), ("b", 7, "y"), ("b", 6, "y")])
    got = merge.keyed_insert_ignore(target, source, ["k"], [F.asc("v")])
    assert rows(got) == [("a", 1, "x"), ("b", 6, "y")]


def test_repeated_keys_of_a_source_fail_or_have_a_winner(spark, small):
    target = frame(spark, [("a", 1, "x"), ("b", 2, "x")])
    source = frame(spark, [("a", 3, "y"), ("a", 4, "z"), ("c", 5, "y")])
    with pytest.raises(Exception, match=r"key \(k\) occurs more than once: a"):
        merge.keyed_merge(target, source, ["k"], small_source=small).collect()
    got = merge.keyed_merge(target, source, ["k"], order=[F.desc("v")], small_source=small)
    assert rows(got) == [("a", 4, "z"), ("b", 2, "x"), ("c", 5, "y")]


def test_repeated_edits_fail_or_have_a_winner(spark):
    kinds = "id string, account_code string, account_name string, category string, tax_type string, notes string, approved boolean, approved_by string"
    lines = spark.createDataFrame([("1", *[None] * 7, None, None)], f"{kinds}, approved_at timestamp_ntz, updated_at timestamp_ntz")
    edits = spark.createDataFrame([("1", "100", *[None] * 6), ("1", "200", *[None] * 6)], kinds)
    now = ts_literal("2024-02-01 00:00:00")
    with pytest.raises(Exception, match="occurs more than once"):
        merge.apply_line_edits(lines, edits, now).collect()
    assert rows(merge.apply_line_edits(lines, edits, now, [F.desc("account_code")]), "id", "account_code") == [("1", "200")]


def test_guard_passes_unique_rows(spark):
    df = frame(spark, [("a", 1, "x"), (None, 2, "x")])
    assert rows(merge.assert_unique(df, ["k"])) == rows(df)
    with pytest.raises(Exception, match="occurs more than once: null"):
        merge.assert_unique(df.unionByName(df.filter("k IS NULL")), ["k"]).count()


def test_duplicate_guard(spark):
    assert rows(merge.duplicate_keys(frame(spark, [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")]), ["k"])) == [("a", 2)]


def test_winner_of_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    best = merge.pick_winner(df, ["k"], [F.desc("id")])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert rows(best.filter("k = 'hot'")) == [("hot", 19998)]


def test_remap_and_cascade(spark):
    invoices = spark.createDataFrame([("c1", 1), ("c2", 2), (None, 3)], "connection_id string, n int")
    mapping = spark.createDataFrame([("c1", "n1")], "old string, new string")
    assert rows(merge.remap_keys(invoices, mapping, "connection_id", "old", "new")) == [("c2", 2), ("n1", 1), (None, 3)]
    gone = spark.createDataFrame([("c2",), ("c2",)], "id string")
    assert rows(merge.cascade_delete(invoices, gone, "connection_id")) == [("c1", 1), (None, 3)]


LINE = ("id string, account_code string, account_name string, category string, tax_type string, notes string, "
        "approved boolean, approved_by string, approved_at timestamp_ntz, updated_at timestamp_ntz")


def test_line_edits_are_sparse_and_restamp_approval(spark):
    old = dt.datetime(2024, 1, 1)
    lines = spark.createDataFrame([
        ("1", "100", None, None, None, "keep", True, "U0", old, old), ("2", "100", None, None, None, None, False, None, None, old),
    ], LINE)
    edits = spark.createDataFrame([("1", None, "Bank", None, None, None, True, "U1")],
                                  ("id string, account_code string, account_name string, category string, tax_type string, "
                                   "notes string, approved boolean, approved_by string"))
    now = dt.datetime(2024, 2, 1)
    got = {r["id"]: r for r in merge.apply_line_edits(lines, edits, ts_literal(now)).collect()}
    assert (got["1"]["account_code"], got["1"]["account_name"], got["1"]["notes"]) == ("100", "Bank", "keep")
    assert got["1"]["approved_at"] == got["1"]["updated_at"] == now
    assert got["2"]["updated_at"] == old and got["2"]["approved_at"] is None


def test_connection_lifecycle(spark):
    old, now = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    conns = spark.createDataFrame([("1", True, old), ("2", True, old)], "id string, is_active boolean, updated_at timestamp_ntz")
    ids = spark.createDataFrame([("1",)], "id string")
    off = merge.deactivate(conns, ids, ts_literal(now))
    assert rows(off) == [("1", False, now), ("2", True, old)]
    assert rows(merge.reactivate(off, ids, ts_literal(now))) == [("1", True, now), ("2", True, old)]


def test_backfill_links_by_slug_and_keeps_known_organisations(spark):
    at = dt.datetime(2024, 1, 1)
    schema = "id string, tenant_id string, source_org_id string, org_name string, created_at timestamp_ntz"
    conns = spark.createDataFrame([("1", None, "o1", "Acme Ltd", at), ("2", None, "o2", "ACME, LTD", at),
                                   ("3", None, "o3", "Other", at)], schema)
    tenants = merge.backfill_tenants(conns)
    assert rows(tenants, "slug") == [("acme-ltd",), ("other",)]
    with_ids = tenants.withColumn("id", F.concat(F.lit("T-"), "slug"))
    known = spark.createDataFrame([("9", "T9", "o3", "Other", at)], schema)
    got = merge.backfill_connections(conns, with_ids, known)
    assert rows(got, "id", "tenant_id") == [("1", "T-acme-ltd"), ("2", "T-acme-ltd"), ("9", "T9")]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("hot", [True, False])
def test_attach_is_exact_with_null_and_hot_keys(spark, threshold, hot):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        facts = spark.range(3000).select(
            F.col("id").cast("string").alias("id"),
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
        lookup = spark.createDataFrame([("hot", "H"), ("2", "two"), ("zz", "unused")], "key string, name string")
        left = attach(facts, lookup, {"k": "key"}, {"name": "name"}, ("id",), hot_keys=hot)
        counts = {r["name"]: r["count"] for r in left.groupBy("name").count().collect()}
        assert counts == {"H": 1000, "two": 1, None: 1999}
        assert attach(facts, lookup, {"k": "key"}, {"name": "name"}, ("id",), how="inner", hot_keys=hot, few_facts=not hot).count() == 1001
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

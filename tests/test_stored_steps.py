"""Steps that several parts of a query share are made once."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row, functions as F

from conftest import rows
from ledgerloom.functions.dates import date_literal, ts_literal
from ledgerloom.functions.keys import surrogate_key
from ledgerloom.operators import cascade, star
from ledgerloom.plans import ageing_store, catalogue, refresh
from ledgerloom.schemas import MERGE_RULES
from ledgerloom.sources.bindings import Ledger
from ledgerloom.streaming import change_log


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["statement_batch_summary", "quality_constraint_violations", "quality_foreign_keys", "cascade_delete_tenants"])
def test_statement_rows_are_parsed_once(spark, folder, name):
    assert "Missing description in row" not in plan(catalogue.run(name, spark, folder))


def test_records_are_parsed_once(spark, folder):
    text = plan(catalogue.run("ingest_invoice_lines", spark, folder))
    assert text.count("from_json(") == 2  # the invoice, and its line
    assert text.count("StructsToJsonEvaluator") == 1


def test_removed_keys_are_not_replicated(spark):
    tables = {"p": spark.createDataFrame([(i,) for i in range(6)], "id int"),
              "c": spark.createDataFrame([(i, i % 6) for i in range(12)] + [(12, None)], "id int, p_id int"),
              "g": spark.createDataFrame([(i, i % 13) for i in range(26)], "id int, c_id int")}
    edges = [("c", ("p_id",), "p", ("id",)), ("g", ("c_id",), "c", ("id",))]
    left, _ = cascade.cascade_tables(tables, {"p": spark.createDataFrame([(1,), (1,), (4,)], "id int")}, edges)
    assert rows(left["c"], "id") == sorted([(i,) for i in range(13) if i == 12 or i % 6 not in (1, 4)], key=repr)
    assert rows(left["g"], "id") == sorted([(i,) for i in range(26) if i % 13 == 12 or i % 13 % 6 not in (1, 4)], key=repr)
    for table in left.values():
        assert "Generate" not in plan(table)
    # a level reads the stored keys of the one above, not what they came from
    assert plan(left["g"]).count("Join") == 1


INVOICE = ("tenant_id string, source_id string, id string, type string, status string, due_date date, amount_due decimal(15,2), "
           "reference string")


def test_items_before_and_after_a_load_come_from_one_pass(spark, scratch):
    def invoice(tenant, source, kind, status, amount):
        return Row(tenant, source, f"{tenant}-{source}", kind, status, None, None if amount is None else Decimal(amount), "r")

    def frame(*found):
        return spark.createDataFrame([*found], INVOICE)

    base, log = f"{scratch}/base", f"{scratch}/log"
    frame(invoice("1", "a", "ACCREC", "SUBMITTED", 5), invoice("1", "b", "ACCREC", "DRAFT", 7), invoice("1", "c", "ACCPAY", "PAID", 1),
          invoice("1", None, "ACCREC", "PAID", 2), invoice("1", "d", "ACCREC", "PAID", 9),
          invoice("1", "d", "ACCREC", "PAID", 8)).write.parquet(f"{base}/fact_invoice")
    change_log.write_batch(frame(invoice("1", "a", "ACCPAY", "SUBMITTED", None), invoice("1", "e", "ACCREC", "PAID", 3),
                                 invoice("1", None, "ACCREC", "PAID", 4)), f"{log}/fact_invoice", 0)
    change_log.write_batch(frame(invoice("1", "b", "ACCREC", "SUBMITTED", 6), invoice("1", "e", "ACCPAY", "PAID", 30),
                                 invoice("1", "f", "ACCPAY", "PAID", 31), invoice("1", "d", "ACCPAY", "PAID", 32)), f"{log}/fact_invoice", 1)
    rule = MERGE_RULES["fact_invoice"]
    for load in (0, 1):
        held, changes = refresh._stored(spark, base, log, "fact_invoice", load + 1)
        keys = changes.filter(f"batch_id = {load}").select(*rule.keys).distinct()
        want = [(*item, sign) for before, sign in ((load, -1), (load + 1, 1)) for item in rows(ageing_store._open_items(
            refresh.read_current(spark, base, log, "fact_invoice", before=before, wanted=keys)))]
        assert rows(ageing_store._signed_items(held, changes, load, rule)) == sorted(want, key=repr)
    narrow = refresh.read_current(spark, base, log, "fact_invoice", columns=("type", "amount_due"))
    whole = refresh.read_current(spark, base, log, "fact_invoice").select("tenant_id", "source_id", "type", "amount_due")
    assert rows(narrow) == rows(whole)
    # only the files have it
    assert all("Relation" in line for line in plan(narrow).splitlines() if "reference" in line)


LINE = ("connection_id string, tenant_id string, source_invoice_id string, source_id string, description string, quantity decimal(20,6), "
        "unit_amount decimal(15,4), line_amount decimal(15,2), account_code string, tax_type string, tax_amount decimal(15,2), "
        "item_code string, source_updated_at timestamp_ntz")
LOADED = "2024-02-01 00:00:00"


def test_lines_are_moved_once_for_their_winner_and_their_invoice(spark):
    def line(connection, tenant, invoice, source, text, code, day):
        return (connection, tenant, invoice, source, text, None, None, None, code, None, None, None, None if day is None else dt.datetime(2024, 1, day))

    lines = spark.createDataFrame([
        line("1", "t", "a", "1", "old", "x", 1), line("2", "t", "a", "1", "new", "y", 2), line("2", "t", "a", "2", "tie", "x", 3),
        line("3", "t", "a", "2", "tie won", "z", 3), line("1", "u", "a", "1", "unknown", "x", 1), line("1", "t", None, "1", "null", None, 1),
        line("2", "t", None, "1", "null won", "x", 1), line("1", None, None, None, "none", None, None),
        line("1", None, None, None, "none", None, None)], LINE)
    invoices = spark.createDataFrame([("t", "a"), ("t", "a"), ("t", None), (None, "a")], "tenant_id string, source_id string")
    accounts = spark.createDataFrame([("A", "t", "2", "x"), ("B", "t", "1", "x"), ("C", "t", "3", "y")],
                                     "id string, tenant_id string, source_id string, code string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = star.fact_invoice_line(lines, invoices, accounts, ts_literal(LOADED))
        text = fact._jdf.queryExecution().executedPlan().toString()
        got = rows(fact, "tenant_id", "source_invoice_id", "source_id", "description", "dim_account_id", "fact_invoice_id")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    known = spark.range(1).select(surrogate_key("fact_invoice", F.lit("t"), F.lit("a"))).first()[0]
    assert got == sorted([("t", "a", "1", "new", "C", known), ("t", "a", "2", "tie won", None, known), ("u", "a", "1", "unknown", None, None),
                          ("t", None, "1", "null won", "B", None), (None, None, None, "none", None, None)], key=repr)
    # two shuffles of lines, one by invoice and one by code; each join and window takes them as they come
    assert text.count("Exchange hashpartitioning(source_invoice_id") == 1
    assert text.count("Exchange hashpartitioning(account_code") == 1
    assert text.count("Sort [source_invoice_id") == 1


def test_ids_of_facts_are_made_behind_the_dealing(spark, folder):
    ledger = Ledger(spark, folder)
    by = ("tenant_id", "source_id")
    for fact in (
            star.fact_invoice(ledger.raw_invoices, ledger.dim_contact, date_literal("2001-06-30"), ts_literal(LOADED), deal=lambda df: refresh._dealt(df, by)),
            star.fact_invoice_line(ledger.raw_invoice_lines, ledger.raw_invoices, ledger.dim_account, ts_literal(LOADED), deal=lambda df: refresh._dealt(df, by)),
            star.fact_manual_journal(ledger.raw_manual_journals, ts_literal(LOADED), deal=lambda df: refresh._dealt(df, by))):
        above, _, below = plan(fact).partition("RepartitionByExpression")
        table = "fact_manual_journal" if "narration" in fact.columns else "fact_invoice"
        assert below and table in above and table not in below


def test_a_refresh_joins_orders_to_their_owners_once(spark, folder, monkeypatch):
    plans, write = {}, refresh._write

    def noted(df, path, *rest):
        plans[path.rpartition("/")[2]] = plan(df)
        return write(df, path, *rest)

    monkeypatch.setattr(refresh, "_write", noted)
    catalogue.run("warehouse_refresh", spark, folder)
    assert set(plans) == set(refresh.TABLES)
    assert not [t for t, text in plans.items() if "o_custkey" in text and "c_custkey" in text and "Join Inner, (o_custkey" in text]

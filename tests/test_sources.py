"""Payload pages, typed ingestion, incremental reads and client settings."""

from __future__ import annotations

import csv
import datetime as dt
import json
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.functions.dates import ts_literal
from ledgerloom.sources import incremental, lookups, payloads

def now():
    return ts_literal("2025-01-02 00:00:00")


def one(spark, record, encode=json.dumps):
    return spark.createDataFrame([("c1", "t1", encode(record))], "connection_id string, tenant_id string, raw string")


INVOICE = {
    "InvoiceID": "i1", "InvoiceNumber": "INV-1", "Type": "ACCREC", "Status": "PAID", "Contact": {"ContactID": "k1", "Name": "Acme"},
    "LineItems": [{"LineItemID": "l1", "Quantity": 2, "UnitAmount": 1.23456, "LineAmount": 2.47}, {"LineItemID": "l2", "AccountCode": "200"}],
    "Date": "/Date(1609459200000+0000)/", "DueDateString": "2021-02-01T00:00:00", "DueDate": "/Date(0)/",
    "AmountDue": 0.1, "Total": 10, "CurrencyRate": 1.23456789012, "UpdatedDateUTC": "/Date(1700000000123+0000)/",
}


def test_invoice_fields(spark):
    got = payloads.ingest_invoices(one(spark, INVOICE), now()).first()
    assert (got["source_id"], got["contact_id"], got["contact_name"]) == ("i1", "k1", "Acme")
    assert (got["date"], got["due_date"]) == (dt.date(2021, 1, 1), dt.date(2021, 2, 1))
    assert (got["amount_due"], got["total"], got["subtotal"]) == (Decimal("0.10"), Decimal("10.00"), None)
    assert got["currency_rate"] == Decimal("1.2345678901")
    assert got["source_updated_at"] == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert json.loads(got["raw"]) == INVOICE


def test_empty_text_date_does_not_fall_back(spark):
    record = {**INVOICE, "DateString": ""}
    assert payloads.ingest_invoices(one(spark, record), now()).first()["date"] is None


def test_lines_keep_their_own_text(spark):
    got = payloads.ingest_invoice_lines(one(spark, INVOICE), now()).orderBy("source_id").collect()
    assert [(r["source_invoice_id"], r["source_id"], r["unit_amount"], r["account_code"]) for r in got] == [
        ("i1", "l1", Decimal("1.2346"), None), ("i1", "l2", None, "200")]
    assert json.loads(got[0]["raw"]) == INVOICE["LineItems"][0]
    for none in ({"InvoiceID": "i2"}, {"InvoiceID": "i2", "LineItems": []}):
        assert payloads.ingest_invoice_lines(one(spark, none), now()).count() == 0


def test_record_stored_as_json_text(spark):
    twice = one(spark, INVOICE, lambda r: json.dumps(json.dumps(r)))
    assert payloads.ingest_invoices(twice, now()).first()["source_id"] == "i1"
    assert payloads.ingest_invoice_lines(twice, now()).count() == 2


def test_missing_flags_are_false(spark):
    assert payloads.ingest_contacts(one(spark, {"ContactID": "k"}), now()).select("is_supplier", "is_customer").first() == (False, False)
    assert payloads.ingest_payments(one(spark, {"PaymentID": "p", "Invoice": {"InvoiceID": "i"}}), now()).select(
        "is_reconciled", "invoice_id", "account_id").first() == (False, "i", None)
    assert payloads.ingest_accounts(one(spark, {"AccountID": "a"}), now()).first()["enable_payments"] is False


def test_pages_to_records(spark, scratch):
    path = os.path.join(scratch, "pages.json")
    with open(path, "w") as f:
        for page in ([INVOICE, {"InvoiceID": "i2"}], []):
            f.write(json.dumps({"Id": "x", "Invoices": page}) + "\n")
    records = payloads.explode_pages(payloads.read_pages(spark, path, "c1", "t1"), "invoices")
    assert rows(payloads.ingest_invoices(records, now()), "connection_id", "source_id") == [("c1", "i1"), ("c1", "i2")]


def test_every_record_is_a_row_or_a_reject(spark):
    good = json.dumps(INVOICE)
    bad = {good[:-4]: "unreadable", "": "unreadable", "[1]": "unreadable", None: "unreadable", '"text"': "unreadable",
           json.dumps({**INVOICE, "InvoiceID": None}): "no key", json.dumps({**INVOICE, "InvoiceID": ""}): "no key",
           json.dumps({**INVOICE, "Total": 12345678901234567}): "bad value", json.dumps({**INVOICE, "Total": "many"}): "bad value"}
    df = spark.createDataFrame([("c1", "t1", r) for r in [good, *bad]], "connection_id string, tenant_id string, raw string")
    assert rows(payloads.ingest_invoices(df, now()), "source_id", "raw") == [("i1", good)]
    got = {r.raw: r.reason for r in payloads.rejects(df, "invoices").collect()}
    unwrapped = {("text" if r == '"text"' else r): why for r, why in bad.items()}
    assert got == unwrapped
    assert payloads.ingest_invoice_lines(df, now()).count() == 2


def test_bad_lines_are_rejects_of_their_own(spark):
    lines = [{"LineItemID": "l1", "Quantity": 1}, {"LineItemID": "l2", "Quantity": "x"}, {"Quantity": 1}]
    df = one(spark, {**INVOICE, "LineItems": lines})
    assert rows(payloads.ingest_invoice_lines(df, now()), "source_id") == [("l1",)]
    assert sorted(r.reason for r in payloads.rejects(df, "invoice_lines").collect()) == ["bad value", "no key"]


def test_truncated_pages_are_rejects(spark):
    page = json.dumps({"Invoices": [INVOICE, {**INVOICE, "InvoiceID": "i2"}]})
    pages = spark.createDataFrame([("c1", "t1", p) for p in (page, page[:-9], '{"Other":[]}', "", '{"Invoices":[]}')],
                                  "connection_id string, tenant_id string, page string")
    assert payloads.explode_pages(pages, "invoices").count() == 2
    assert rows(payloads.page_rejects(pages, "invoices"), "raw", "reason") == [
        ("", "unreadable"), (page[:-9], "unreadable"), ('{"Other":[]}', "no record list")]


def test_unreadable_reports_are_rejects(spark):
    data = [("c1", "t1", "balance_sheet", dt.date(2025, 3, 15), r) for r in ('{"Rows":[]}', '{"Rows":[', "{}", None, json.dumps('{"Rows":[]}'))]
    df = spark.createDataFrame(data, "connection_id string, tenant_id string, report_type string, as_of date, raw string")
    assert payloads.ingest_report_snapshots(df, now()).count() == 2
    assert rows(payloads.rejects(df, "report_snapshots"), "raw", "reason") == [
        ('{"Rows":[', "unreadable"), ("{}", "unreadable"), (None, "unreadable")]


def test_legacy_table_is_a_projection(spark):
    got = payloads.legacy_invoices(payloads.ingest_invoices(one(spark, INVOICE), now()))
    assert "tenant_id" not in got.columns and got.first()["type"] == "ACCREC"


def test_snapshot_periods(spark):
    data = [("c1", "t1", k, dt.date(2025, 3, 15), '{"ReportName":"N","Rows":[]}') for k in ("profit_and_loss", "balance_sheet")]
    df = spark.createDataFrame(data, "connection_id string, tenant_id string, report_type string, as_of date, raw string")
    got = payloads.ingest_report_snapshots(df, now())
    assert rows(got, "report_type", "period_from", "report_name") == [
        ("balance_sheet", None, "N"), ("profit_and_loss", dt.date(2025, 3, 1), "N")]


def test_changed_since(spark):
    t = dt.datetime
    raw = spark.createDataFrame([("c1", "a", t(2025, 1, 1, 12)), ("c1", "b", t(2025, 1, 1, 11, 59, 59)), ("c2", "c", t(2020, 1, 1)),
                                 ("c1", "d", None)], "connection_id string, source_id string, source_updated_at timestamp_ntz")
    cursors = spark.createDataFrame([("c1", "payments", t(2025, 1, 1, 12, 0, 0, 500000)), ("c2", "contacts", t(2025, 1, 1))],
                                    "connection_id string, entity string, last_modified_at timestamp_ntz")
    assert rows(incremental.changed_since(raw, cursors, "payments"), "source_id") == [("a",), ("c",)]


def test_client_metadata_defaults(spark):
    meta = spark.createDataFrame([("t1", 4, None, None, None), ("t2", None, "EUR", 12, True), ("t3", 99, None, None, None)],
                                 "tenant_id string, business_type_id int, base_currency string, fiscal_year_end_month int, vat_registered boolean")
    meta = meta.withColumns({c: F.lit(None).cast("string") for c in ("vat_scheme", "primary_bank_account", "notes")})
    got = lookups.client_metadata(meta, lookups.business_types(spark))
    assert rows(got, "tenant_id", "business_type", "base_currency", "fiscal_year_end_month", "vat_registered") == [
        ("t1", "Construction", "GBP", 3, False), ("t2", None, "EUR", 12, True), ("t3", None, "GBP", 3, False)]
    assert lookups.business_types(spark).count() == 11


def test_pull_merges_raw_rows_and_moves_the_cursor(spark):
    from ledgerloom.plans import pull

    first = pull.typed_records(one(spark, INVOICE), "invoices", now())
    newer = {**INVOICE, "Type": "ACCPAY", "Status": "VOIDED", "Reference": None, "UpdatedDateUTC": "/Date(1800000000000)/"}
    twice = one(spark, newer).unionByName(one(spark, INVOICE)).unionByName(one(spark, {**INVOICE, "InvoiceID": "i2"}))
    got = pull.upsert_raw(first, twice, "invoices", now())
    assert rows(got, "source_id", "type", "status") == [("i1", "ACCREC", "VOIDED"), ("i2", "ACCREC", "PAID")]
    flat = pull.upsert_legacy_invoices(payloads.legacy_invoices(first), twice, now())
    assert rows(flat, "source_id", "type") == [("i1", "ACCPAY"), ("i2", "ACCREC")]
    assert pull.upsert_raw(got, twice, "invoices", now()).exceptAll(got).count() == 0

    t = dt.datetime
    cursors = spark.createDataFrame([("c1", "invoices", t(2025, 1, 1), "r1")], "connection_id string, entity string, last_modified_at timestamp_ntz, last_run_id string")
    pulled = spark.createDataFrame([("c1", t(2025, 1, 2), "r2"), ("c2", t(2025, 1, 2), "r3")], "connection_id string, started_at timestamp_ntz, run_id string")
    assert rows(pull.advance_cursor(cursors, pulled, "invoices"), "connection_id", "last_run_id") == [("c1", "r2"), ("c2", "r3")]
    assert pull.advance_cursor(cursors, pulled, "accounts") is cursors


def test_stored_rows_are_not_replaced(spark):
    from ledgerloom.sources import uploads

    schema = "batch_id string, tenant_id string, row_index int, raw map<string,string>"
    held = spark.createDataFrame([("b", "t", 0, {"a": "1"})], schema)
    again = spark.createDataFrame([("b", "t", 0, {"a": "2"}), ("b", "t", 1, {"a": "3"})], schema)
    assert rows(uploads.store_rows(held, again), "row_index", F.col("raw")["a"]) == [(0, "1"), (1, "3")]


CSV_FILES = {
    "a.csv": "Date,Description,Amount\n2025-01-02,Tea,1.50\n2025-01-03,\"Milk, fresh\",-2\n",
    "b.csv": "\ufeffPosting Date,Narrative,Debit,Credit\n03-01-2025,Rent,10,\n04-01-2025,Pay,,20\n\n05-01-2025,Short\n",
    "c.csv": "Credit,Note,Memo,Credit,,Transaction Date\n1,n,Gift,7,x,06/01/2025\n",
}


def test_csv_cells_go_by_the_header_of_their_own_file(spark, scratch):
    from ledgerloom.sources import uploads

    for name, content in CSV_FILES.items():
        with open(os.path.join(scratch, name), "w", encoding="utf-8") as f:
            f.write(content)
    together = uploads.read_statement_csv(spark, scratch, "t")
    got = {(r.batch_id.rpartition("/")[2], r.row_index): r.raw for r in together.collect()}
    assert got == {
        ("a.csv", 0): {"Date": "2025-01-02", "Description": "Tea", "Amount": "1.50"},
        ("a.csv", 1): {"Date": "2025-01-03", "Description": "Milk, fresh", "Amount": "-2"},
        ("b.csv", 0): {"Posting Date": "03-01-2025", "Narrative": "Rent", "Debit": "10", "Credit": ""},
        ("b.csv", 1): {"Posting Date": "04-01-2025", "Narrative": "Pay", "Debit": "", "Credit": "20"},
        ("b.csv", 2): {"Posting Date": "05-01-2025", "Narrative": "Short", "Debit": "", "Credit": ""},
        ("c.csv", 0): {"Note": "n", "Memo": "Gift", "Credit": "7", "Transaction Date": "06/01/2025"},
    }
    alone = [uploads.read_statement_csv(spark, os.path.join(scratch, n), "t") for n in CSV_FILES]
    apart = {(r.batch_id.rpartition("/")[2], r.row_index): r.raw for df in alone for r in df.collect()}
    assert apart == got


def test_json_rows(spark, scratch):
    from ledgerloom.sources import uploads

    with open(os.path.join(scratch, "u.json"), "w") as f:
        f.write('{"Date": "2025-01-02", "Amount": 5}\n[1]\n\n{"Memo": null}\n')
    got = uploads.read_statement_json(spark, scratch, "t").orderBy("row_index").collect()
    assert [(r.row_index, r.raw) for r in got] == [(0, {"Date": "2025-01-02", "Amount": "5"}), (1, {}), (2, {"Memo": None})]


def _csv_rows(spark, folder):
    from ledgerloom.sources import uploads

    df = uploads.read_statement_csv(spark, folder, "t")
    return {(r.batch_id.rpartition("/")[2], r.row_index): r.raw for r in df.collect()}


def _write_csv(path, rows):
    with open(path, "w", encoding="utf-8", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows(rows)


MULTI_LINE = [["Date", "Memo", "Amount"], ["1", "two\nlines", "3"], ["2", 'quote " and\n\n"",",", end\n', "4"], ["3", "", ""], ["4", '"', '"\n"'],
              ["5", ",\n,", ",,"], ["6", "plain", '\n'], ["7", "a,b", "x"]]


def test_csv_cells_hold_line_ends(spark, scratch):
    _write_csv(os.path.join(scratch, "m.csv"), MULTI_LINE)
    got = _csv_rows(spark, scratch)
    assert got == {("m.csv", i): dict(zip(MULTI_LINE[0], row, strict=True)) for i, row in enumerate(MULTI_LINE[1:])}


@pytest.mark.parametrize("size", [64, 700, 5000])
def test_csv_records_go_across_splits(spark, scratch, size):
    rng = random.Random(size)
    pieces = ["a", '"', ",", "\n", "word ", '""', "\n\n", "é"]
    files = {}
    for name in ("x.csv", "y.csv"):
        rows = [["Date", "Two\nlined name", "Z"]] + [
            [str(i)] + ["".join(rng.choices(pieces, k=rng.choice((0, 1, 3, 40)))) for _ in range(2)] for i in range(150)]
        files[name] = rows
        _write_csv(os.path.join(scratch, name), rows)
    sizes = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        got = _csv_rows(spark, scratch)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {(n, i): dict(zip(rows[0], row, strict=True)) for n, rows in files.items() for i, row in enumerate(rows[1:])}


def test_csv_stray_and_unclosed_quotes(spark, scratch):
    with open(os.path.join(scratch, "s.csv"), "w") as f:
        f.write('Date,Memo\n1,5" pipe\n2,12",\n3,x "y" z\n4,"a"" b"\n')
    with open(os.path.join(scratch, "t.csv"), "w") as f:
        f.write('Date,Memo\n1,"never\n2,closed\n3,here\n')
    got = _csv_rows(spark, scratch)
    assert {k[1]: v["Memo"] for k, v in got.items() if k[0] == "s.csv"} == {0: '5" pipe', 1: '12"', 2: 'x "y" z', 3: 'a" b'}
    assert {k: v["Memo"] for k, v in got.items() if k[0] == "t.csv"} == {("t.csv", 0): '"never', ("t.csv", 1): "closed", ("t.csv", 2): "here"}


def test_csv_reader_runs_no_job_and_parses_once(spark, scratch):
    from ledgerloom.sources import uploads

    _write_csv(os.path.join(scratch, "m.csv"), MULTI_LINE)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("csv-plan", "csv-plan")
    df = uploads.read_statement_csv(spark, scratch, "t")
    assert list(tracker.getJobIdsForGroup("csv-plan")) == []
    spark.sparkContext.setJobGroup("other", "other")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "csv" not in plan.lower().replace("m.csv", "")

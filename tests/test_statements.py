"""Statement rows: fields, dates, amounts, errors, hashes, batches, CSV numbering."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.functions.dates import ts_literal
from ledgerloom.operators import statements
from ledgerloom.sources import uploads

NOW = "2025-01-02 00:00:00"


def batch(spark, *raws, batch_id="b1", tenant="t1"):
    return spark.createDataFrame([(batch_id, tenant, i, r) for i, r in enumerate(raws)],
                                 "batch_id string, tenant_id string, row_index int, raw map<string,string>")


def normal(spark, **cells):
    return statements.normalise(batch(spark, cells)).first()


BASE = {"Date": "2025-03-15", "Description": "Invoice", "Amount": "100"}


def amount_of(spark, **cells):
    return normal(spark, Date="2025-01-01", Description="x", **cells)


def test_amounts(spark):
    cases = [
        ({"Amount": "500.00"}, "500"), ({"Amount": "-42.50"}, "-42.5"), ({"Amount": "£9.99"}, "9.99"), ({"Amount": "1,234.56"}, "1234.56"),
        ({"Amount": "0"}, "0"), ({"Amount": "n/a", "Debit": "5"}, "-5"), ({"Debit": "100.00", "Credit": ""}, "-100"),
        ({"Debit": "", "Credit": "200.00"}, "200"), ({"Debit": "-7", "Credit": ""}, "-7"), ({" amount ": "3"}, "3"), ({"AMOUNT": "€ 4"}, "4"),
    ]
    raws = [{"Date": "2025-01-01", "Description": "x", **c} for c, _ in cases]
    got = [r["amount"] for r in statements.normalise(batch(spark, *raws)).orderBy("row_index").collect()]
    assert got == [Decimal(v) for _, v in cases]


def test_aliases_and_precedence(spark):
    got = normal(spark, **{"Date": " ", "Transaction Date": "2025-03-15", "Narrative": " Staff salary ", "Amount": "-3000", "ChequeNo": "7"})
    assert (got["date"], got["description"], got["reference"], got["currency_code"]) == (dt.date(2025, 3, 15), "Staff salary", "7", "GBP")
    assert normal(spark, **BASE)["reference"] is None


def test_headers_that_collide_after_trimming(spark):
    got = statements.normalise(batch(spark, {"Date": "2025-01-01", "Description": "x", " Amount": "2", "Amount": "1", "AMOUNT": "9"})).first()
    assert got["amount"] == Decimal(9)  # equal length: byte order decides, and upper case sorts first


def test_errors_in_order_of_precedence(spark):
    raws = [
        {"Description": "x"}, {"Date": "nonsense", "Amount": "z"}, {"Date": "nonsense", "Description": "x", "Amount": "z"},
        {"Date": "2025-01-01", "Description": "x", "Amount": "z", "Debit": "0", "Credit": "0"},
        {"Date": "31/02/2025", "Description": "x", "Amount": "1"}, {"Date": "2025-01-01", "Description": "x", "Amount": "1e14"}, BASE,
    ]
    got = [r["error"] for r in statements.normalise(batch(spark, *raws)).orderBy("row_index").collect()]
    assert got == [
        'Missing date in row: {"Description":"x"}', 'Missing description in row: {"Date":"nonsense","Amount":"z"}',
        'Cannot parse date: "nonsense"',
        'Cannot parse amount from row: {"Date":"2025-01-01","Debit":"0","Amount":"z","Credit":"0","Description":"x"}',
        'date/time field value out of range: "2025-02-31"', "numeric field overflow", None,
    ]


def test_hash_ignores_reference_and_amount_spelling(spark):
    one, two, other = ({**BASE, "Amount": "100", "Reference": "A"}, {**BASE, "Amount": "100.00"}, {**BASE, "Amount": "200"})
    h = [r["dedup_hash"] for r in statements.normalise(batch(spark, one, two, other)).orderBy("row_index").collect()]
    assert h[0] == h[1] != h[2]
    assert statements.normalise(batch(spark, one, tenant="t2")).first()["dedup_hash"] != h[0]


def test_dedup_within_and_across_batches(spark):
    first = batch(spark, BASE, {**BASE, "Amount": "100.00"}, {**BASE, "Amount": "5"})
    again = batch(spark, BASE, {**BASE, "Amount": "6"}, batch_id="b2")
    lines = lambda df: statements.to_lines(statements.good_rows(statements.normalise(df)), ts_literal(NOW))
    held = statements.dedup(lines(first))
    assert rows(held, "batch_id", "row_index") == [("b1", 0), ("b1", 2)]
    assert rows(statements.dedup(lines(again), held), "batch_id", "row_index") == [("b2", 1)]


def summaries(spark, data, headers):
    heads = spark.createDataFrame(headers, "id string, tenant_id string, filename string, row_count int, status string, error string")
    lines = statements.dedup(statements.to_lines(statements.good_rows(statements.normalise(data)), ts_literal(NOW)))
    return {r["batch_id"]: r for r in statements.batch_summary(statements.normalise(data), heads, ts_literal(NOW), lines).collect()}


def test_batch_outcomes(spark):
    bad = {"Date": "soon", "Description": "x", "Amount": "1"}
    data = batch(spark, BASE, BASE, bad).unionByName(batch(spark, *[{**bad, "Date": f"d{i}"} for i in range(7)], batch_id="b2"))
    got = summaries(spark, data, [("b1", "t1", "f", 3, "pending", None), ("b2", "t1", "f", 7, "pending", None), ("b3", "t1", "f", 0, "pending", None)])
    b1, b2, b3 = got["b1"], got["b2"], got["b3"]
    assert (b1["status"], b1["processed"], b1["skipped"], b1["row_count"], b1["inserted"]) == ("completed", 2, 1, 2, 1)
    assert b1["error"] == 'Cannot parse date: "soon"'
    assert (b2["status"], b2["processed"], b2["error"]) == ("failed", 0, "; ".join(f'Cannot parse date: "d{i}"' for i in range(5)))
    assert (b3["status"], b3["row_count"], b3["error"]) == ("completed", 0, None)


def test_numbering_by_blocks_equals_numbering_by_sorting(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g")).repartition(7)
    got = uploads.number_rows(df, ["g"], F.floor(F.col("id") / 100), F.col("id"))
    assert got.filter(F.col("row_index") != F.floor(F.col("id") / 3)).count() == 0 and got.count() == 5000


def test_csv_rows_keep_file_order_over_splits(spark, scratch):
    path = os.path.join(scratch, "statement.csv")
    with open(path, "w") as f:
        f.write("Date,Description,Amount\n" + "".join(f"2025-01-01,line {i},{i}\n" for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = uploads.read_statement_csv(spark, path, "t1")
        starts = spark.read.option("header", True).csv(path).select("_metadata.file_block_start").distinct()
        assert starts.count() > 1
        out = {r["row_index"]: r["raw"]["Description"] for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert out == {i: f"line {i}" for i in range(4000)}
    heads = uploads.batch_headers(got, ts_literal(NOW)).first()
    assert (heads["row_count"], heads["status"]) == (4000, "pending")


def test_upload_of_the_same_file_twice(spark):
    data = batch(spark, BASE, {**BASE, "Amount": "z"})
    heads = uploads.batch_headers(data, ts_literal(NOW))
    empty = statements.to_lines(statements.good_rows(statements.normalise(data)), ts_literal(NOW)).limit(0)
    fresh, errors, summary = statements.process_upload(data, heads, empty, ts_literal(NOW))
    assert (fresh.count(), errors.count()) == (1, 1)
    again, _, outcome = statements.process_upload(data, heads, fresh, ts_literal(NOW))
    assert again.count() == 0
    assert rows(outcome, "status", "processed", "skipped", "inserted") == [("completed", 1, 1, 0)]
    assert rows(summary, "status", "processed", "skipped", "inserted") == [("completed", 1, 1, 1)]

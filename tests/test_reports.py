"""Report trees: the three flatteners on small documents."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from conftest import rows as collected

from ledgerloom.operators import reports

ACCOUNT = lambda name, acct: {"Value": name, "Attributes": [{"Id": "other", "Value": "?"}, {"Id": "account", "Value": acct}]}
CELLS = lambda *values: [v if isinstance(v, dict) else {"Value": v} for v in values]


def row(*cells):
    return {"RowType": "Row", "Cells": CELLS(*cells)}


def summary(*cells):
    return {"RowType": "SummaryRow", "Cells": CELLS(*cells)}


def section(title, *children):
    node = {"RowType": "Section", "Rows": list(children)}
    return node if title is None else {**node, "Title": title}


HEADER = {"RowType": "Header", "Cells": [{"Value": "Account"}, {"Value": "Debit"}]}


def snapshots(spark, *trees, encode=json.dumps):
    data = [(f"s{i}", "t", encode({"ReportName": "R", "Rows": tree})) for i, tree in enumerate(trees)]
    return spark.createDataFrame(data, "id string, tenant_id string, raw string").selectExpr(
        "id", "tenant_id", "date'2025-03-31' AS period_date", "date'2025-03-01' AS period_from", "raw")


def listed(df, *columns):
    return [tuple(r) for r in df.orderBy("snapshot_id", "row_order").select(*columns).collect()]


def test_trial_balance(spark):
    tree = [
        HEADER, row("Loose", "1"),
        section("Assets", row(ACCOUNT("Cash", "acc-001"), "5,000.00", "", "5000.00", " "), section("Deep", row("Hidden", "1")),
                summary("Total Assets", "5000.00", "", "5000.00", "")),
    ]
    got = listed(reports.flatten_trial_balance(snapshots(spark, tree)),
                 "row_order", "account_source_id", "account_name", "debit", "credit", "ytd_debit", "ytd_credit", "row_type")
    five = Decimal("5000.00")
    assert got == [(0, "acc-001", "Cash", five, None, five, None, "row"), (1, None, "Total Assets", five, None, five, None, "summary")]


def test_profit_and_loss(spark):
    tree = [
        HEADER,
        section("Income", row(ACCOUNT("Sales", "acc-200"), "12000.00"), summary("Total Income", "12000.00")),
        {"RowType": "SummaryRow", "Cells": [{}, {"Value": "8000.00"}]},
        section(None, row("Untitled", "N/A")),
    ]
    got = listed(reports.flatten_profit_and_loss(snapshots(spark, tree)),
                 "row_order", "section", "account_source_id", "account_name", "value", "row_type")
    assert got == [
        (0, "Income", "acc-200", "Sales", Decimal("12000.00"), "row"), (1, "Income", None, "Total Income", Decimal("12000.00"), "summary"),
        (2, None, None, "Net Profit", Decimal("8000.00"), "summary"), (3, None, None, "Untitled", None, "row"),
    ]


def test_balance_sheet_levels_and_order(spark):
    tree = [
        HEADER,
        section("A", section("B", row("one", "1"), section("C", row("two", "2"))), row("three", "3"), summary("", "4")),
        section(None, section("B", row("five", "5"))),
        row("six", "6"), {"RowType": "Row"}, {"RowType": "SummaryRow"},
    ]
    got = listed(reports.flatten_balance_sheet(snapshots(spark, tree)), "row_order", "section", "sub_section", "account_name", "row_type")
    assert got == [
        (0, "A", "B", "one", "row"), (1, "A", "C", "two", "row"), (2, "A", None, "three", "row"), (3, "A", None, "", "summary"),
        (4, "B", None, "five", "row"), (5, None, None, "six", "row"), (6, None, None, "", "row"), (7, None, None, "Total", "summary"),
    ]


@pytest.mark.parametrize("flatten", [reports.flatten_trial_balance, reports.flatten_profit_and_loss, reports.flatten_balance_sheet])
def test_empty_and_double_encoded(spark, flatten):
    tree = [section("A", row("one", "1"))]
    assert flatten(snapshots(spark, [])).count() == 0
    plain = listed(flatten(snapshots(spark, tree)), "account_name")
    assert listed(flatten(snapshots(spark, tree, encode=lambda t: json.dumps(json.dumps(t)))), "account_name") == plain == [("one",)]


def test_tree_of_thirty_levels_flattens(spark):
    tree = section("level 29", row("deep", "1"))
    for level in range(28, -1, -1):
        tree = section(f"level {level}", row(f"row {level}", "2"), tree)
    for encode in (json.dumps, lambda t: json.dumps(json.dumps(t))):
        got = collected(reports.flatten_balance_sheet(snapshots(spark, [tree], encode=encode)), "row_order", "account_name", "section", "sub_section")
        assert len(got) == 30 and got[0] == (0, "row 0", "level 0", None)
        assert sorted(got)[-1] == (29, "deep", "level 0", "level 29")


def test_flatten_needs_no_shuffle(spark):
    df = reports.flatten_balance_sheet(snapshots(spark, [section("A", row("one", "1"))]))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_replace_drops_the_stale_tail(spark):
    long = reports.flatten_balance_sheet(snapshots(spark, [row("a", "1"), row("b", "2")], [row("z", "9")]))
    short = reports.flatten_balance_sheet(snapshots(spark, [row("a", "7")]))
    got = listed(reports.replace_snapshots(long, short), "snapshot_id", "account_name", "value")
    assert got == [("s0", "a", Decimal("7.00")), ("s1", "z", Decimal("9.00"))]

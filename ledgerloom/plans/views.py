"""Reporting views over the warehouse and the documented queries on top of them.

``tables`` maps table names to DataFrames. A view filters by ``tenant_id`` before it joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.dates import date_literal, period_label
from ledgerloom.functions.finance import ageing_bucket, ageing_rank
from ledgerloom.operators.joins import attach

Tables = Mapping[str, DataFrame]


def of_tenant(df: DataFrame, tenant_id: str | None, column: str = "tenant_id") -> DataFrame:
    return df if tenant_id is None else df.filter(F.col(column) == tenant_id)


def _named_tenant(facts: DataFrame, tables: Tables, tenant_id: str | None, spread_by: tuple[str, ...]) -> DataFrame:
    """Facts of known tenants with the tenant's name."""
    tenants = of_tenant(tables["dim_tenant"], tenant_id, "id")
    return attach(of_tenant(facts, tenant_id), tenants, {"tenant_id": "id"}, {"tenant_name": "name"},
                  spread_by=spread_by, how="inner", hot_keys=True)


def _named_contact(rows: DataFrame, tables: Tables, tenant_id: str | None, take: dict[str, str]) -> DataFrame:
    return attach(rows, of_tenant(tables["dim_contact"], tenant_id), {"dim_contact_id": "id"}, take, spread_by=("id",))


def overdue_invoices(tables: Tables, tenant_id: str | None = None) -> DataFrame:
    facts = tables["fact_invoice"].filter(F.col("is_overdue") & ~F.col("status").isin("VOIDED", "DELETED"))
    rows = _named_tenant(facts, tables, tenant_id, ("id",))
    rows = _named_contact(rows, tables, tenant_id, {"contact_name": "name", "contact_email": "email_address"})
    return rows.select(
        "id", "tenant_id", "tenant_name", "source_id", "invoice_number", "type", "status",
        F.col("date").alias("invoice_date"), "due_date", "days_overdue", "contact_name", "contact_email",
        "total", "amount_paid", "amount_due", "currency_code", "warehouse_updated_at",
    )


def invoice_ageing(tables: Tables, tenant_id: str | None = None) -> DataFrame:
    facts = tables["fact_invoice"].filter(~F.col("status").isin("VOIDED", "DELETED", "DRAFT"))
    rows = _named_tenant(facts, tables, tenant_id, ("id",))
    rows = _named_contact(rows, tables, tenant_id, {"contact_name": "name"})
    return rows.select(
        "id", "tenant_id", "tenant_name", "source_id", "invoice_number", "type", "status",
        F.col("date").alias("invoice_date"), "due_date", "amount_due", "currency_code", "contact_name",
        ageing_bucket(F.col("amount_due"), F.col("days_overdue")).alias("ageing_bucket"),
        F.coalesce("days_overdue", F.lit(0)).alias("days_overdue"), "warehouse_updated_at",
    )


def payment_history(tables: Tables, tenant_id: str | None = None) -> DataFrame:
    facts = tables["fact_payment"].filter(F.col("status") == "AUTHORISED")
    rows = _named_tenant(facts, tables, tenant_id, ("id",))
    rows = attach(rows, of_tenant(tables["fact_invoice"], tenant_id), {"fact_invoice_id": "id"},
                  {"invoice_number": "invoice_number", "invoice_type": "type", "dim_contact_id": "dim_contact_id"},
                  spread_by=("id",))
    rows = _named_contact(rows, tables, tenant_id, {"contact_name": "name"})
    rows = attach(rows, of_tenant(tables["dim_account"], tenant_id), {"dim_account_id": "id"},
                  {"account_code": "code", "account_name": "name", "account_class": "class"}, spread_by=("id",))
    return rows.select(
        "id", "tenant_id", "tenant_name", "source_id", F.col("date").alias("payment_date"), "amount", "reference",
        "payment_type", "is_reconciled", "status", "currency_rate", "invoice_number", "invoice_type", "contact_name",
        "account_code", "account_name", "account_class", "warehouse_updated_at",
    )


def profit_and_loss(tables: Tables, tenant_id: str | None = None) -> DataFrame:
    rows = _named_tenant(tables["fact_profit_and_loss"], tables, tenant_id, ("id",))
    return rows.select(
        "id", "tenant_id", "tenant_name", "snapshot_id", "period_from", "period_to",
        period_label(F.col("period_to")).alias("period_label"), "section", "account_source_id", "account_name",
        "value", "row_type", "row_order",
    )


def balance_sheet(tables: Tables, tenant_id: str | None = None) -> DataFrame:
    rows = _named_tenant(tables["fact_balance_sheet"], tables, tenant_id, ("id",))
    return rows.select(
        "id", "tenant_id", "tenant_name", "snapshot_id", "period_date",
        period_label(F.col("period_date")).alias("period_label"), "section", "sub_section", "account_source_id",
        "account_name", "value", "row_type", "row_order",
    )


def trial_balance(tables: Tables, tenant_id: str | None = None) -> DataFrame:
    rows = _named_tenant(tables["fact_trial_balance"], tables, tenant_id, ("id",))
    return rows.select(
        "id", "tenant_id", "tenant_name", "snapshot_id", "period_date",
        period_label(F.col("period_date")).alias("period_label"), "account_source_id", "account_name",
        "debit", "credit", "ytd_debit", "ytd_credit", "row_type", "row_order",
    )


# ── documented queries; each order ends in a unique column ───────────────────

def aged_debt(tables: Tables, tenant_id: str) -> DataFrame:
    """Receivables past due, worst first."""
    rows = overdue_invoices(tables, tenant_id).filter(F.col("type") == "ACCREC")
    return rows.orderBy(F.desc_nulls_first("days_overdue"), "invoice_number").select(
        "invoice_number", "contact_name", "amount_due", "days_overdue", "due_date")


def ageing_summary(tables: Tables, tenant_id: str | None, invoice_type: str = "ACCREC") -> DataFrame:
    """Invoices and amount per ageing bucket, in bucket order.

    The contact plays no part in the totals, so it is not joined; the tenant is, because
    only invoices of known tenants are visible.
    """
    facts = tables["fact_invoice"].filter(
        ~F.col("status").isin("VOIDED", "DELETED", "DRAFT") & (F.col("type") == invoice_type))
    rows = of_tenant(facts, tenant_id).select(
        "tenant_id", "amount_due", ageing_bucket(F.col("amount_due"), F.col("days_overdue")).alias("ageing_bucket"))
    # pre-aggregate per tenant before the tenant check: the join sees a handful of rows per tenant
    partial = rows.groupBy("tenant_id", "ageing_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_due").alias("due"))
    known = of_tenant(tables["dim_tenant"], tenant_id, "id").select(F.col("id").alias("tenant_id"))
    return partial.join(known, "tenant_id", "left_semi").groupBy("ageing_bucket").agg(
        F.sum("n").alias("invoice_count"), F.sum("due").cast("decimal(18,2)").alias("total_due"),
    ).orderBy(ageing_rank(F.col("ageing_bucket")))


def pnl_month(tables: Tables, tenant_id: str, period_to: str) -> DataFrame:
    rows = profit_and_loss(tables, tenant_id).filter(F.col("period_to") == date_literal(period_to))
    return rows.orderBy(F.asc_nulls_last("section"), "row_order").select("section", "account_name", "value", "row_type")


def pnl_pivot(tables: Tables, tenant_id: str, periods: Mapping[str, str]) -> DataFrame:
    """One column per period; ``periods`` maps a period label to its column name."""
    rows = profit_and_loss(tables, tenant_id).filter(F.col("row_type") == "row")
    wide = rows.groupBy("account_name").pivot("period_label", list(periods)).agg(F.max("value"))
    return wide.select("account_name", *[F.col(f"`{label}`").alias(name) for label, name in periods.items()]).orderBy("account_name")


def trial_balance_on(tables: Tables, tenant_id: str, period_date: str) -> DataFrame:
    rows = trial_balance(tables, tenant_id).filter(
        (F.col("period_date") == date_literal(period_date)) & (F.col("row_type") == "row"))
    return rows.orderBy("account_name", "row_order").select("account_name", "debit", "credit", "ytd_debit", "ytd_credit")


def payments_between(tables: Tables, tenant_id: str, first: str, last: str) -> DataFrame:
    rows = payment_history(tables, tenant_id).filter(F.col("payment_date").between(date_literal(first), date_literal(last)))
    return rows.orderBy(F.desc_nulls_first("payment_date"), "source_id").select(
        "payment_date", "amount", "contact_name", "account_code", "account_name", "reference")


def uncoded_lines(lines: DataFrame, tenant_id: str) -> DataFrame:
    rows = of_tenant(lines, tenant_id).filter(~F.col("approved"))
    return rows.orderBy(F.desc("date"), "id").select("id", "date", "description", "amount", "currency_code")


VIEWS = {
    "overdue_invoices": overdue_invoices,
    "invoice_ageing": invoice_ageing,
    "payment_history": payment_history,
    "profit_and_loss_by_period": profit_and_loss,
    "balance_sheet_by_period": balance_sheet,
    "trial_balance_by_period": trial_balance,
}


def register_views(tables: Tables, prefix: str = "vw_") -> list[str]:
    """Expose the views to ``spark.sql``; a WHERE on tenant_id is pushed into their scans."""
    names = []
    for name, view in VIEWS.items():
        view(tables).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names



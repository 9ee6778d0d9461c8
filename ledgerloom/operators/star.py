"""Raw tables -> dimensions and facts. Each result is a merge source for its table.

``connection_id`` restricts a transform to one connection; by default all connections are
transformed in one job. Two connections of a tenant may deliver the same record: the one
updated last wins, then the higher connection id.

``deal`` moves the rows of a fact to where they are written, before the ids that follow from their
keys are made: ids do not go through that shuffle, and its sampling does not make them once more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.finance import days_overdue, is_overdue
from ledgerloom.functions.keys import surrogate_key
from ledgerloom.operators.joins import attach, placed
from ledgerloom.operators.merge import pick_winner

Deal = Callable[[DataFrame], DataFrame]

# winners are sorted by their key: the column that tells most rows apart comes first
SOURCE_KEY = ("source_id", "tenant_id")
LATEST = (F.desc_nulls_last, "source_updated_at"), (F.desc, "connection_id")


def _one_per_key(raw: DataFrame, keys: tuple[str, ...], connection_id: str | None,
                 order: tuple = LATEST) -> DataFrame:
    """Unique rows per warehouse key. One connection alone is unique already: no shuffle."""
    if connection_id is not None:
        return raw.filter(F.col("connection_id") == connection_id)
    return pick_winner(raw, keys, [direction(column) for direction, column in order])


def _key(table: str, *columns: str) -> Column:
    return surrogate_key(table, *[F.col(c) for c in columns]).alias("id")


def _as_it_is(rows: DataFrame) -> DataFrame:
    return rows


def dim_tenant(tenants: DataFrame, loaded_at: Column) -> DataFrame:
    return tenants.select("id", "name", "slug", "is_active", loaded_at.alias("warehouse_updated_at"))


def dim_contact(raw: DataFrame, loaded_at: Column, connection_id: str | None = None) -> DataFrame:
    return _one_per_key(raw, SOURCE_KEY, connection_id).select(
        _key("dim_contact", "tenant_id", "source_id"), "tenant_id", "source_id", "name", "first_name", "last_name",
        "email_address", "contact_status", "is_supplier", "is_customer", "tax_number", "default_currency",
        "source_updated_at", loaded_at.alias("warehouse_updated_at"),
    )


def dim_account(raw: DataFrame, loaded_at: Column, connection_id: str | None = None) -> DataFrame:
    return _one_per_key(raw, SOURCE_KEY, connection_id).select(
        _key("dim_account", "tenant_id", "source_id"), "tenant_id", "source_id", "code", "name", "type", "status",
        "class", "description", "tax_type", (F.col("type") == "BANK").alias("is_bank_account"),
        "source_updated_at", loaded_at.alias("warehouse_updated_at"),
    )


def account_by_code(accounts: DataFrame) -> DataFrame:
    """One account per (tenant, code): codes are not unique, the lowest source id is taken."""
    return pick_winner(accounts.filter(F.col("code").isNotNull()).select("id", "tenant_id", "code", "source_id"),
                       ("tenant_id", "code"), [F.asc("source_id")])


def fact_invoice(raw: DataFrame, contacts: DataFrame, as_of: Column, loaded_at: Column,
                 connection_id: str | None = None, deal: Deal = _as_it_is) -> DataFrame:
    """Invoices with their contact and their age on ``as_of``; an unknown contact stays null."""
    source = _one_per_key(raw, SOURCE_KEY, connection_id)
    joined = attach(source, contacts, {"tenant_id": "tenant_id", "contact_id": "source_id"},
                    {"dim_contact_id": "id"}, spread_by=("source_id",))
    status, due = F.col("status"), F.col("due_date")
    return deal(joined).select(
        _key("fact_invoice", "tenant_id", "source_id"), "tenant_id", "dim_contact_id", "source_id",
        "invoice_number", "type", "status", "date", "due_date", "amount_due", "amount_paid", "amount_credited",
        "subtotal", "total_tax", "total", "currency_code", "currency_rate", "reference",
        is_overdue(status, due, as_of).alias("is_overdue"),
        days_overdue(status, due, as_of).alias("days_overdue"),
        "source_updated_at", loaded_at.alias("warehouse_updated_at"),
    )


LINE_KEY = ("source_invoice_id", "source_id")


def _with_invoice(rows: DataFrame, invoices: DataFrame, invoice: str, placed: bool = False) -> DataFrame:
    """Add ``_known``, the invoice's source id where the invoice is known: only keys of ``invoices`` (raw or fact rows) are read."""
    known = invoices.select("tenant_id", "source_id").distinct()
    return attach(rows, known, {"tenant_id": "tenant_id", invoice: "source_id"}, {"_known": "source_id"},
                  spread_by=tuple(c for c in LINE_KEY if c in rows.columns), placed=placed)


def _fact_invoice_id() -> Column:
    """Id of the known invoice: a hash of the key that the row has already."""
    return F.when(F.col("_known").isNotNull(), surrogate_key("fact_invoice", F.col("tenant_id"), F.col("_known"))).alias("fact_invoice_id")


def fact_invoice_line(raw: DataFrame, invoices: DataFrame, accounts: DataFrame, loaded_at: Column,
                      connection_id: str | None = None, deal: Deal = _as_it_is) -> DataFrame:
    """Lines of the connection whose invoice wins: both go by the invoice's time of change.

    Lines are dealt by invoice once, for the winner of a key and for the invoice.
    """
    rows = placed(raw, ("tenant_id", "source_invoice_id"), LINE_KEY)
    source = _one_per_key(rows, ("source_invoice_id", "tenant_id", "_spread", "source_id"), connection_id)
    joined = _with_invoice(source, invoices, "source_invoice_id", placed=True)
    joined = attach(joined, account_by_code(accounts), {"tenant_id": "tenant_id", "account_code": "code"},
                    {"dim_account_id": "id"}, spread_by=LINE_KEY)
    return deal(joined).select(
        _key("fact_invoice_line", "tenant_id", *LINE_KEY), "tenant_id", _fact_invoice_id(),
        "dim_account_id", "source_invoice_id", "source_id", "description", "quantity", "unit_amount", "line_amount",
        "account_code", "tax_type", "tax_amount", "item_code", loaded_at.alias("warehouse_updated_at"),
    )


def fact_payment(raw: DataFrame, invoices: DataFrame, accounts: DataFrame, loaded_at: Column,
                 connection_id: str | None = None, deal: Deal = _as_it_is) -> DataFrame:
    source = _one_per_key(raw, SOURCE_KEY, connection_id)
    joined = _with_invoice(source, invoices, "invoice_id")
    joined = attach(joined, accounts, {"tenant_id": "tenant_id", "account_id": "source_id"},
                    {"dim_account_id": "id"}, spread_by=("source_id",))
    return deal(joined).select(
        _key("fact_payment", "tenant_id", "source_id"), "tenant_id", _fact_invoice_id(), "dim_account_id", "source_id",
        "date", "amount", "reference", "is_reconciled", "status", "payment_type", "currency_rate",
        "source_updated_at", loaded_at.alias("warehouse_updated_at"),
    )


def fact_bank_transaction(raw: DataFrame, contacts: DataFrame, accounts: DataFrame, loaded_at: Column,
                          connection_id: str | None = None, deal: Deal = _as_it_is) -> DataFrame:
    source = _one_per_key(raw, SOURCE_KEY, connection_id)
    joined = attach(source, contacts, {"tenant_id": "tenant_id", "contact_id": "source_id"},
                    {"dim_contact_id": "id"}, spread_by=("source_id",))
    joined = attach(joined, accounts, {"tenant_id": "tenant_id", "bank_account_id": "source_id"},
                    {"dim_account_id": "id"}, spread_by=("source_id",))
    return deal(joined).select(
        _key("fact_bank_transaction", "tenant_id", "source_id"), "tenant_id", "dim_contact_id", "dim_account_id",
        "source_id", "type", "status", "reference", "is_reconciled", "date", "subtotal", "total_tax", "total",
        "currency_code", "currency_rate", "source_updated_at", loaded_at.alias("warehouse_updated_at"),
    )


def fact_manual_journal(raw: DataFrame, loaded_at: Column, connection_id: str | None = None,
                        deal: Deal = _as_it_is) -> DataFrame:
    return deal(_one_per_key(raw, SOURCE_KEY, connection_id)).select(
        _key("fact_manual_journal", "tenant_id", "source_id"), "tenant_id", "source_id", "narration", "date",
        "status", "source_updated_at", loaded_at.alias("warehouse_updated_at"),
    )

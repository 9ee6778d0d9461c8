"""Table rules: keys, what a merge may overwrite, and constraints.

A column that is neither key nor in ``insert_only`` is overwritten by a merge, also by null.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class MergeRule:
    keys: tuple[str, ...]
    insert_only: tuple[str, ...] = ()


# Which columns identify a row and which are set by the first write only.
MERGE_RULES: dict[str, MergeRule] = {
    "tenants": MergeRule(("slug",), ("id", "is_active", "created_at")),
    "connections": MergeRule(("source_org_id",), ("id", "tenant_id", "org_type", "created_at")),
    "sync_checkpoints": MergeRule(("connection_id", "entity"), ("id", "created_at")),
    "legacy_invoices": MergeRule(("connection_id", "source_id")),
    "raw_contacts": MergeRule(("connection_id", "source_id"), ("tenant_id",)),
    "raw_accounts": MergeRule(("connection_id", "source_id"), ("tenant_id",)),
    "raw_invoices": MergeRule(("connection_id", "source_id"), ("tenant_id", "type")),
    "raw_invoice_lines": MergeRule(("connection_id", "source_invoice_id", "source_id"), ("tenant_id",)),
    "raw_payments": MergeRule(("connection_id", "source_id"), ("tenant_id",)),
    "raw_bank_transactions": MergeRule(("connection_id", "source_id"), ("tenant_id",)),
    "raw_manual_journals": MergeRule(("connection_id", "source_id"), ("tenant_id",)),
    "raw_report_snapshots": MergeRule(("connection_id", "report_type", "period_date"), ("id", "tenant_id")),
    "dim_tenant": MergeRule(("id",)),
    "dim_contact": MergeRule(("tenant_id", "source_id"), ("id",)),
    "dim_account": MergeRule(("tenant_id", "source_id"), ("id",)),
    "fact_invoice": MergeRule(("tenant_id", "source_id"), ("id", "type")),
    "fact_invoice_line": MergeRule(("tenant_id", "source_invoice_id", "source_id"), ("id",)),
    "fact_payment": MergeRule(("tenant_id", "source_id"), ("id",)),
    "fact_bank_transaction": MergeRule(("tenant_id", "source_id"), ("id",)),
    "fact_manual_journal": MergeRule(("tenant_id", "source_id"), ("id",)),
}

# The documented tables with their unique keys, for the uniqueness report.
UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "tenants": ("slug",),
    "connections": ("source_org_id",),
    "sync_checkpoints": ("connection_id", "entity"),
    "raw_contacts": ("connection_id", "source_id"),
    "raw_accounts": ("connection_id", "source_id"),
    "raw_invoices": ("connection_id", "source_id"),
    "raw_invoice_lines": ("connection_id", "source_invoice_id", "source_id"),
    "raw_payments": ("connection_id", "source_id"),
    "raw_bank_transactions": ("connection_id", "source_id"),
    "raw_manual_journals": ("connection_id", "source_id"),
    "report_snapshots": ("connection_id", "report_type", "period_date"),
    "dim_contact": ("tenant_id", "source_id"),
    "dim_account": ("tenant_id", "source_id"),
    "fact_invoice": ("tenant_id", "source_id"),
    "fact_invoice_line": ("tenant_id", "source_invoice_id", "source_id"),
    "fact_payment": ("tenant_id", "source_id"),
    "fact_bank_transaction": ("tenant_id", "source_id"),
    "fact_manual_journal": ("tenant_id", "source_id"),
    "fact_trial_balance": ("snapshot_id", "row_order"),
    "fact_profit_and_loss": ("snapshot_id", "row_order"),
    "fact_balance_sheet": ("snapshot_id", "row_order"),
    "uploaded_rows": ("batch_id", "row_index"),
    "statement_lines": ("tenant_id", "dedup_hash"),
}

# Columns no row may lack, by kind of table.
RAW_TABLES = ("raw_contacts", "raw_accounts", "raw_invoices", "raw_invoice_lines", "raw_payments", "raw_bank_transactions",
              "raw_manual_journals")
WAREHOUSE_TABLES = ("dim_contact", "dim_account", "fact_invoice", "fact_invoice_line", "fact_payment",
                    "fact_bank_transaction", "fact_manual_journal")
REQUIRED: dict[str, tuple[str, ...]] = {
    **{t: ("connection_id", "tenant_id", "source_id") for t in RAW_TABLES},
    **{t: ("id", "tenant_id", "source_id") for t in WAREHOUSE_TABLES},
    "statement_lines": ("tenant_id", "batch_id", "date", "description", "amount", "dedup_hash"),
}

# Fixed values: (child table, foreign key, parent table, its key) of the warehouse and of uploads.
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    *[(t, "connection_id", "connections", "id") for t in RAW_TABLES],
    *[(t, "tenant_id", "tenants", "id") for t in RAW_TABLES],
    *[(t, "tenant_id", "dim_tenant", "id") for t in WAREHOUSE_TABLES],
    ("fact_invoice", "dim_contact_id", "dim_contact", "id"),
    ("fact_invoice_line", "fact_invoice_id", "fact_invoice", "id"),
    ("fact_invoice_line", "dim_account_id", "dim_account", "id"),
    ("fact_payment", "fact_invoice_id", "fact_invoice", "id"),
    ("fact_payment", "dim_account_id", "dim_account", "id"),
    ("fact_bank_transaction", "dim_contact_id", "dim_contact", "id"),
    ("fact_bank_transaction", "dim_account_id", "dim_account", "id"),
    *[(t, "snapshot_id", "report_snapshots", "id") for t in ("fact_trial_balance", "fact_profit_and_loss", "fact_balance_sheet")],
    ("client_metadata", "business_type_id", "business_types", "id"),
    ("upload_batches", "tenant_id", "tenants", "id"),
    ("statement_lines", "batch_id", "upload_batches", "id"),
    ("statement_lines", "tenant_id", "tenants", "id"),
)

# Fixed values: (child table, its columns, parent table, its columns) of keys whose rows go with their parent.
CASCADES: tuple[tuple[str, tuple[str, ...], str, tuple[str, ...]], ...] = (
    ("client_metadata", ("tenant_id",), "tenants", ("id",)),
    ("upload_batches", ("tenant_id",), "tenants", ("id",)),
    ("uploaded_rows", ("batch_id",), "upload_batches", ("id",)),
    ("uploaded_rows", ("tenant_id",), "tenants", ("id",)),
    ("statement_lines", ("tenant_id",), "tenants", ("id",)),
    ("statement_lines", ("batch_id",), "upload_batches", ("id",)),
    ("statement_lines", ("batch_id", "row_index"), "uploaded_rows", ("batch_id", "row_index")),
    ("sync_run_steps", ("sync_run_id",), "sync_runs", ("id",)),
)
# Keys that keep their parent from being removed.
RESTRICTS: tuple[tuple[str, tuple[str, ...], str, tuple[str, ...]], ...] = (
    ("connections", ("tenant_id",), "tenants", ("id",)),
    ("sync_runs", ("tenant_id",), "tenants", ("id",)),
    ("sync_checkpoints", ("last_run_id",), "sync_runs", ("id",)),
)

# Fixed values: (table, rule name, SQL condition that a valid row meets).
CONSTRAINTS: tuple[tuple[str, str, str], ...] = (
    ("sync_runs", "status_known", "status IN ('pending', 'running', 'completed', 'failed')"),
    ("sync_runs", "trigger_known", "triggered_by IN ('manual', 'scheduled', 'webhook')"),
    ("sync_runs", "connection_present", "connection_id IS NOT NULL"),
    ("sync_run_steps", "status_known", "status IN ('pending', 'running', 'completed', 'failed', 'skipped')"),
    ("sync_run_steps", "run_present", "sync_run_id IS NOT NULL"),
    ("raw_invoices", "status_present", "status IS NOT NULL"),
    ("raw_invoices", "type_present", "type IS NOT NULL"),
    ("raw_invoices", "due_date_present", "due_date IS NOT NULL"),
    ("raw_accounts", "enable_payments_present", "enable_payments IS NOT NULL"),
    ("raw_accounts", "name_present", "name IS NOT NULL"),
    ("report_snapshots", "type_known", "report_type IN ('trial_balance', 'profit_and_loss', 'balance_sheet')"),
    ("report_rows", "row_type_known", "row_type IN ('row', 'summary')"),
    ("client_metadata", "fiscal_month_in_year", "fiscal_year_end_month BETWEEN 1 AND 12"),
    ("upload_batches", "status_known", "status IN ('pending', 'processing', 'completed', 'failed')"),
    *[(table, f"{column}_given", f"{column} IS NOT NULL") for table, columns in REQUIRED.items() for column in columns],
)

# Business type lookup.
BUSINESS_TYPES: tuple[tuple[int, str, str], ...] = (
    (1, "Retail", "Product sales to consumers"),
    (2, "E-commerce", "Online product sales"),
    (3, "Professional Services", "Consulting, legal, accountancy"),
    (4, "Construction", "Building, trades, contracting"),
    (5, "Hospitality", "Restaurants, cafes, hotels"),
    (6, "Healthcare", "Medical, dental, therapy practices"),
    (7, "Technology", "Software, SaaS, IT services"),
    (8, "Manufacturing", "Production and assembly"),
    (9, "Property", "Lettings, estate agents, developers"),
    (10, "Charity / Non-profit", "Registered charities and social enterprises"),
    (11, "Other", "Catch-all for uncategorised businesses"),
)

# Header aliases of bank exports, in priority order.
DATE_HEADERS = ("Date", "Transaction Date", "TransactionDate", "Posting Date", "PostingDate")
DESCRIPTION_HEADERS = ("Description", "Details", "Narrative", "Memo", "Particulars", "Transaction Description")
REFERENCE_HEADERS = ("Reference", "Ref", "Cheque No", "ChequeNo")
AMOUNT_HEADERS = ("Amount",)
DEBIT_HEADERS = ("Debit",)
CREDIT_HEADERS = ("Credit",)

DEFAULT_CURRENCY = "GBP"
DEFAULT_FISCAL_YEAR_END = 3

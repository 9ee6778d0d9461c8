"""Nested JSON records -> typed raw rows.

Input of every ``ingest_*``: ``connection_id, tenant_id, raw`` with one record per row. Records that cannot be stored
are left out there and listed by :func:`rejects`, pages that cannot be opened by :func:`page_rejects`.
Columns are parsed with an explicit schema, so only the fields in use are decoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.dates import month_start, parse_wire_date
from ledgerloom.functions.keys import surrogate_key

# Wire field names and their types.
MONEY, UNIT, QUANTITY, RATE = "decimal(15,2)", "decimal(15,4)", "decimal(20,6)", "decimal(20,10)"
CONTACT_REF = "struct<ContactID:string,Name:string>"
ACCOUNT_REF = "struct<AccountID:string,Code:string,Name:string>"
INVOICE_REF = "struct<InvoiceID:string,InvoiceNumber:string,Type:string>"

WIRE = {
    "invoices": f"InvoiceID string, InvoiceNumber string, Type string, Status string, Contact {CONTACT_REF}, "
                f"LineItems array<string>, Date string, DateString string, DueDate string, DueDateString string, "
                f"AmountDue {MONEY}, AmountPaid {MONEY}, AmountCredited {MONEY}, SubTotal {MONEY}, TotalTax {MONEY}, "
                f"Total {MONEY}, CurrencyCode string, CurrencyRate {RATE}, Reference string, UpdatedDateUTC string",
    "invoice_lines": f"LineItemID string, Description string, Quantity {QUANTITY}, UnitAmount {UNIT}, "
                     f"AccountCode string, TaxType string, TaxAmount {MONEY}, LineAmount {MONEY}, ItemCode string",
    "contacts": "ContactID string, Name string, FirstName string, LastName string, EmailAddress string, "
                "ContactStatus string, IsSupplier boolean, IsCustomer boolean, TaxNumber string, "
                "DefaultCurrency string, UpdatedDateUTC string",
    "payments": f"PaymentID string, Date string, DateString string, Amount {MONEY}, Reference string, "
                f"IsReconciled boolean, Status string, PaymentType string, CurrencyRate {RATE}, "
                f"Invoice {INVOICE_REF}, Account {ACCOUNT_REF}, UpdatedDateUTC string",
    "bank_transactions": f"BankTransactionID string, Type string, Status string, Reference string, "
                         f"IsReconciled boolean, Date string, DateString string, SubTotal {MONEY}, TotalTax {MONEY}, "
                         f"Total {MONEY}, CurrencyCode string, CurrencyRate {RATE}, BankAccount {ACCOUNT_REF}, "
                         f"Contact {CONTACT_REF}, UpdatedDateUTC string",
    "accounts": "AccountID string, Code string, Name string, Type string, Status string, Class string, "
                "Description string, TaxType string, SystemAccount string, EnablePaymentsToAccount boolean, "
                "UpdatedDateUTC string",
    "manual_journals": "ManualJournalID string, Narration string, Date string, DateString string, Status string, "
                       "UpdatedDateUTC string",
}

# Name of the record list in a page of each entity.
PAGE_FIELD = {
    "invoices": "Invoices",
    "contacts": "Contacts",
    "payments": "Payments",
    "bank_transactions": "BankTransactions",
    "accounts": "Accounts",
    "manual_journals": "ManualJournals",
}


# The field a record cannot be stored without.
KEY_FIELD = {
    "invoices": "InvoiceID",
    "invoice_lines": "LineItemID",
    "contacts": "ContactID",
    "payments": "PaymentID",
    "bank_transactions": "BankTransactionID",
    "accounts": "AccountID",
    "manual_journals": "ManualJournalID",
}

UNREADABLE, NO_KEY, BAD_VALUE, NO_LIST = "unreadable", "no key", "bad value", "no record list"
_BAD = "_bad"


def record_text(raw: Column) -> Column:
    """JSON text of a record; a payload that was stored as a JSON string is unwrapped once."""
    unwrapped = F.try_variant_get(F.try_parse_json(raw), "$", "string")
    return F.when(raw.rlike(r'^\s*"'), unwrapped).otherwise(raw)


def read_pages(spark: SparkSession, path: str, connection_id: str, tenant_id: str) -> DataFrame:
    """Page files as delivered (one JSON document per line) of one connection."""
    return spark.read.text(path).select(
        F.lit(connection_id).alias("connection_id"), F.lit(tenant_id).alias("tenant_id"), F.col("value").alias("page")
    )


def explode_pages(pages: DataFrame, entity: str) -> DataFrame:
    """``connection_id, tenant_id, page`` -> one row per record, record text kept verbatim."""
    field = PAGE_FIELD[entity]
    records = F.from_json(F.col("page"), f"{field} array<string>")[field]
    return pages.select("connection_id", "tenant_id", F.explode(records).alias("raw"))


def _opened(df: DataFrame, entity: str) -> DataFrame:
    """Add ``p``, the typed record, and ``reason``, why it cannot be stored; null for a good one.

    A value that does not fit its type, such as an amount of too many digits, spoils the record: it is never stored
    as null. The record is made behind a one-element explode: a filter on ``reason`` would otherwise be pushed below it
    and parse every text, and make the text itself, several times over. Filters stop at a generator.
    """
    record = F.from_json("raw", f"{WIRE[entity]}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD})
    typed = df.withColumn("_row", F.explode(F.array(F.struct(record.alias("p"))))).withColumn("p", F.col("_row.p")).drop("_row")
    key = F.coalesce(F.col(f"p.{KEY_FIELD[entity]}"), F.lit(""))
    spoilt = F.col(f"p.{_BAD}").isNotNull()
    readable = F.coalesce(F.try_variant_get(F.try_parse_json("raw"), "$", "map<string,variant>").isNotNull(), F.lit(False))
    # only a record that failed is parsed a second time, to tell a bad value from a bad text
    reason = (
        F.when(F.col("raw").isNull() | F.col("p").isNull(), UNREADABLE)
        .when(spoilt, F.when(readable, BAD_VALUE).otherwise(UNREADABLE))
        .when(key == "", NO_KEY)
    )
    return typed.withColumn("reason", reason)


def _parsed(payloads: DataFrame, entity: str) -> DataFrame:
    text = payloads.select("connection_id", "tenant_id", record_text(F.col("raw")).alias("raw"))
    return _opened(text, entity)


def _good(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull())


def _line_records(payloads: DataFrame) -> DataFrame:
    """One opened row per line of the good invoices."""
    invoices = _good(_parsed(payloads, "invoices")).select(
        "connection_id", "tenant_id", F.col("p.InvoiceID").alias("source_invoice_id"),
        _updated().alias("source_updated_at"), F.col("p.LineItems").alias("_lines"))
    # the time is read once an invoice, below the explode
    lines = invoices.select("connection_id", "tenant_id", "source_invoice_id", "source_updated_at", F.explode("_lines").alias("raw"))
    return _opened(lines, "invoice_lines")


def _readable_report(raw: Column) -> Column:
    """Whether a report document holds a list of rows."""
    return F.try_variant_get(F.try_parse_json(raw), "$.Rows", "array<variant>").isNotNull()


def rejects(payloads: DataFrame, entity: str) -> DataFrame:
    """Records of a pull that cannot be stored: ``connection_id, tenant_id, entity, raw, reason``.

    Every record is either a row of its ``ingest_*`` or a row here, so a step can be failed or its rest be counted.
    """
    if entity == "report_snapshots":
        text = payloads.withColumn("raw", record_text(F.col("raw")))
        bad = text.filter(~F.coalesce(_readable_report(F.col("raw")), F.lit(False))).withColumn("reason", F.lit(UNREADABLE))
    elif entity == "invoice_lines":
        bad = _line_records(payloads).filter(F.col("reason").isNotNull())
    else:
        bad = _parsed(payloads, entity).filter(F.col("reason").isNotNull())
    return bad.select("connection_id", "tenant_id", F.lit(entity).alias("entity"), "raw", "reason")


def page_rejects(pages: DataFrame, entity: str) -> DataFrame:
    """Pages whose records cannot be told: ``connection_id, tenant_id, entity, raw, reason``."""
    field = PAGE_FIELD[entity]
    opened = pages.withColumn("p", F.from_json(
        "page", f"{field} array<string>, {_BAD} string", {"columnNameOfCorruptRecord": _BAD}))
    bad = opened.filter(F.col(f"p.{field}").isNull())
    spoilt = F.col("p").isNull() | F.col(f"p.{_BAD}").isNotNull()
    return bad.select("connection_id", "tenant_id", F.lit(entity).alias("entity"), F.col("page").alias("raw"),
                      F.when(spoilt, UNREADABLE).otherwise(NO_LIST).alias("reason"))


def _field(path: str) -> Column:
    return F.col(f"p.{path}")


def _flag(path: str) -> Column:
    return F.coalesce(_field(path), F.lit(False))


def _day(stem: str) -> Column:
    """The text variant of a date wins when it is present at all, even if it is empty."""
    return parse_wire_date(F.coalesce(_field(f"{stem}String"), _field(stem))).cast("date")


def _updated() -> Column:
    return parse_wire_date(_field("UpdatedDateUTC"))


def _rows(payloads: DataFrame, entity: str, columns: dict[str, Column], synced_at: Column) -> DataFrame:
    return _good(_parsed(payloads, entity)).select(
        "connection_id", "tenant_id",
        *[c.alias(name) for name, c in columns.items()],
        "raw", synced_at.alias("synced_at"),
    )


def ingest_invoices(payloads: DataFrame, synced_at: Column) -> DataFrame:
    return _rows(payloads, "invoices", {
        "source_id": _field("InvoiceID"), "invoice_number": _field("InvoiceNumber"),
        "type": _field("Type"), "status": _field("Status"),
        "contact_id": _field("Contact.ContactID"), "contact_name": _field("Contact.Name"),
        "date": _day("Date"), "due_date": _day("DueDate"),
        "amount_due": _field("AmountDue"), "amount_paid": _field("AmountPaid"),
        "amount_credited": _field("AmountCredited"), "subtotal": _field("SubTotal"),
        "total_tax": _field("TotalTax"), "total": _field("Total"),
        "currency_code": _field("CurrencyCode"), "currency_rate": _field("CurrencyRate"),
        "reference": _field("Reference"), "source_updated_at": _updated(),
    }, synced_at)


LEGACY_INVOICE_COLUMNS = (
    "connection_id", "source_id", "invoice_number", "type", "status", "contact_id", "contact_name", "date",
    "due_date", "amount_due", "amount_paid", "subtotal", "total_tax", "total", "currency_code",
    "source_updated_at", "raw", "synced_at",
)


def legacy_invoices(raw_invoices: DataFrame) -> DataFrame:
    """The older flat invoice table: no tenant, credit, rate or reference."""
    return raw_invoices.select(*LEGACY_INVOICE_COLUMNS)


def ingest_invoice_lines(payloads: DataFrame, synced_at: Column) -> DataFrame:
    """One row per line of each invoice, with its invoice's time of change; an invoice without lines gives no rows."""
    return _good(_line_records(payloads)).select(
        "connection_id", "tenant_id", "source_invoice_id",
        _field("LineItemID").alias("source_id"), _field("Description").alias("description"),
        _field("Quantity").alias("quantity"), _field("UnitAmount").alias("unit_amount"),
        _field("LineAmount").alias("line_amount"), _field("AccountCode").alias("account_code"),
        _field("TaxType").alias("tax_type"), _field("TaxAmount").alias("tax_amount"),
        _field("ItemCode").alias("item_code"), "source_updated_at", "raw", synced_at.alias("synced_at"),
    )


def ingest_contacts(payloads: DataFrame, synced_at: Column) -> DataFrame:
    return _rows(payloads, "contacts", {
        "source_id": _field("ContactID"), "name": _field("Name"), "first_name": _field("FirstName"),
        "last_name": _field("LastName"), "email_address": _field("EmailAddress"),
        "contact_status": _field("ContactStatus"), "is_supplier": _flag("IsSupplier"),
        "is_customer": _flag("IsCustomer"), "tax_number": _field("TaxNumber"),
        "default_currency": _field("DefaultCurrency"), "source_updated_at": _updated(),
    }, synced_at)


def ingest_payments(payloads: DataFrame, synced_at: Column) -> DataFrame:
    return _rows(payloads, "payments", {
        "source_id": _field("PaymentID"), "date": _day("Date"), "amount": _field("Amount"),
        "reference": _field("Reference"), "is_reconciled": _flag("IsReconciled"), "status": _field("Status"),
        "payment_type": _field("PaymentType"), "currency_rate": _field("CurrencyRate"),
        "invoice_id": _field("Invoice.InvoiceID"), "invoice_number": _field("Invoice.InvoiceNumber"),
        "account_id": _field("Account.AccountID"), "account_code": _field("Account.Code"),
        "source_updated_at": _updated(),
    }, synced_at)


def ingest_bank_transactions(payloads: DataFrame, synced_at: Column) -> DataFrame:
    return _rows(payloads, "bank_transactions", {
        "source_id": _field("BankTransactionID"), "type": _field("Type"), "status": _field("Status"),
        "reference": _field("Reference"), "is_reconciled": _flag("IsReconciled"), "date": _day("Date"),
        "subtotal": _field("SubTotal"), "total_tax": _field("TotalTax"), "total": _field("Total"),
        "currency_code": _field("CurrencyCode"), "currency_rate": _field("CurrencyRate"),
        "bank_account_id": _field("BankAccount.AccountID"), "bank_account_code": _field("BankAccount.Code"),
        "bank_account_name": _field("BankAccount.Name"), "contact_id": _field("Contact.ContactID"),
        "contact_name": _field("Contact.Name"), "source_updated_at": _updated(),
    }, synced_at)


def ingest_accounts(payloads: DataFrame, synced_at: Column) -> DataFrame:
    return _rows(payloads, "accounts", {
        "source_id": _field("AccountID"), "code": _field("Code"), "name": _field("Name"),
        "type": _field("Type"), "status": _field("Status"), "class": _field("Class"),
        "description": _field("Description"), "tax_type": _field("TaxType"),
        "system_account": _field("SystemAccount"), "enable_payments": _flag("EnablePaymentsToAccount"),
        "source_updated_at": _updated(),
    }, synced_at)


def ingest_manual_journals(payloads: DataFrame, synced_at: Column) -> DataFrame:
    return _rows(payloads, "manual_journals", {
        "source_id": _field("ManualJournalID"), "narration": _field("Narration"), "date": _day("Date"),
        "status": _field("Status"), "source_updated_at": _updated(),
    }, synced_at)


def ingest_report_snapshots(payloads: DataFrame, captured_at: Column) -> DataFrame:
    """``connection_id, tenant_id, report_type, as_of, raw`` -> snapshot rows.

    Balances are as of a day; profit and loss runs from the first of that month.
    """
    text = payloads.withColumn("raw", record_text(F.col("raw"))).filter(_readable_report(F.col("raw")))
    return text.select(
        surrogate_key("report_snapshots", F.col("connection_id"), F.col("report_type"),
                      F.date_format("as_of", "yyyy-MM-dd")).alias("id"),
        "connection_id", "tenant_id", "report_type",
        F.col("as_of").alias("period_date"),
        F.when(F.col("report_type") == "profit_and_loss", month_start(F.col("as_of"))).alias("period_from"),
        F.get_json_object("raw", "$.ReportName").alias("report_name"),
        "raw", captured_at.alias("captured_at"),
    )


INGEST = {
    "invoices": ingest_invoices,
    "invoice_lines": ingest_invoice_lines,
    "contacts": ingest_contacts,
    "payments": ingest_payments,
    "bank_transactions": ingest_bank_transactions,
    "accounts": ingest_accounts,
    "manual_journals": ingest_manual_journals,
}

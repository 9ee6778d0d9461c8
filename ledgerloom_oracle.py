"""SQL equivalents of the registered queries, for a side-by-side check in another engine.

``SHAPES`` holds named relations over the test tables; :func:`sql` puts the ones a query
mentions in front of it as common table expressions. Expected values are computed straight
from the tables: payloads, report trees and bank exports do not occur here at all.
"""

from __future__ import annotations

import re

from ledgerloom.schemas import FOREIGN_KEYS, REQUIRED

AS_OF = "DATE '2001-06-30'"
RUN_CLOCK = "TIMESTAMP '2001-08-01 12:00:00'"
CURSOR_CLOCK = "TIMESTAMP '2024-01-31 00:00:00'"
LOADED_AT = "TIMESTAMP '2024-02-01 00:00:00'"
TENANT = "'1'"

BUSINESS = (
    "Retail", "E-commerce", "Professional Services", "Construction", "Hospitality", "Healthcare", "Technology",
    "Manufacturing", "Property", "Charity / Non-profit", "Other",
)


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(15,2))"


def key(table: str, *parts: str) -> str:
    return "md5(" + " || '|' || ".join([f"'{table}'", *parts]) + ")"


def micros(later: str, earlier: str) -> str:
    return f"date_diff('microsecond', {earlier}, {later})"


def hours(later: str, earlier: str) -> str:
    return f"CAST(((10 * {micros(later, earlier)} + 1800000000) // 3600000000) / 10.0 AS DECIMAL(18,1))"


def millis(later: str, earlier: str) -> str:
    return f"CAST({micros(later, earlier)} / 1000.0 AS DECIMAL(20,3))"


def plain(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(38,10)) AS VARCHAR), '\\.?0+$', '')"


def freshness(ts: str, clock: str) -> str:
    return (f"CASE WHEN {ts} IS NULL THEN 'never_synced' WHEN {clock} - {ts} < INTERVAL '1 hours' THEN 'fresh' "
            f"WHEN {clock} - {ts} < INTERVAL '25 hours' THEN 'recent' ELSE 'stale' END")


BROKEN_DATE = "CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '31/02/2024' ELSE 'soon' END"

SHAPES: dict[str, str] = {
    "tenants": """
        SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS name,
               lower(regexp_replace(r_name, '[^a-zA-Z0-9]+', '-', 'g')) AS slug, r_regionkey <> 4 AS is_active,
               TIMESTAMP '1995-01-01' + to_days(CAST(r_regionkey AS INTEGER)) AS created_at FROM region""",
    "connections": """
        SELECT CAST(n_nationkey AS VARCHAR) AS id, CAST(n_regionkey AS VARCHAR) AS tenant_id,
               'ORG-' || n_nationkey AS source_org_id, n_name AS org_name, 'ORGANISATION' AS org_type,
               n_nationkey % 7 <> 0 AS is_active,
               TIMESTAMP '1995-01-01' + to_days(CAST(n_nationkey AS INTEGER)) AS created_at,
               TIMESTAMP '1995-01-01' + to_days(CAST(n_nationkey AS INTEGER)) AS updated_at FROM nation""",
    "lead_connection": "SELECT n_regionkey, min(n_nationkey) AS n_nationkey FROM nation GROUP BY n_regionkey",
    "raw_contacts": """
        SELECT CAST(n_nationkey AS VARCHAR) AS connection_id, CAST(n_regionkey AS VARCHAR) AS tenant_id,
               prefix || k AS source_id, name,
               CASE WHEN k % 3 = 0 THEN kind END AS first_name, CASE WHEN k % 3 = 0 THEN CAST(k AS VARCHAR) END AS last_name,
               CASE WHEN k % 5 <> 0 THEN lower(replace(name, '#', '.')) || '@example.com' END AS email_address,
               CASE WHEN balance < 0 THEN 'ARCHIVED' ELSE 'ACTIVE' END AS contact_status,
               kind = 'supplier' AS is_supplier, kind = 'customer' AS is_customer,
               CASE WHEN k % 4 = 0 THEN 'TX' || k END AS tax_number,
               CASE WHEN k % 7 = 0 THEN 'EUR' ELSE 'GBP' END AS default_currency,
               TIMESTAMP '2001-06-01' + to_days(CAST(k % 28 AS INTEGER)) AS source_updated_at
        FROM (SELECT 'customer' AS kind, 'C' AS prefix, c_custkey AS k, c_name AS name, c_nationkey AS nk, c_acctbal AS balance FROM customer
              UNION ALL SELECT 'supplier', 'S', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier) c
        JOIN nation ON nk = n_nationkey""",
    "raw_accounts": """
        SELECT CAST(n_nationkey AS VARCHAR) AS connection_id, CAST(n_regionkey AS VARCHAR) AS tenant_id,
               CAST(p_partkey AS VARCHAR) AS source_id, p_brand AS code, p_name AS name,
               CASE WHEN p_size % 10 = 0 THEN 'BANK' ELSE p_type END AS type,
               CASE WHEN p_partkey % 17 = 0 THEN 'ARCHIVED' ELSE 'ACTIVE' END AS status, p_type AS class,
               CASE WHEN p_partkey % 3 <> 0 THEN p_name || ' account' END AS description,
               CASE WHEN p_partkey % 2 = 0 THEN 'NONE' ELSE 'TAX20' END AS tax_type,
               CASE WHEN p_size = 1 THEN 'DEBTORS' END AS system_account,
               CASE WHEN p_partkey % 23 <> 0 THEN p_size % 2 = 0 END AS enable_payments,
               TIMESTAMP '2001-06-01' + to_days(CAST(p_partkey % 28 AS INTEGER)) AS source_updated_at
        FROM part JOIN lead_connection ON p_partkey % 5 = n_regionkey""",
    "owned_orders": """
        SELECT o.*, c_name, CAST(n_nationkey AS VARCHAR) AS connection_id, CAST(n_regionkey AS VARCHAR) AS tenant_id
        FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "raw_invoices": """
        SELECT connection_id, tenant_id, CAST(o_orderkey AS VARCHAR) AS source_id,
               'INV-' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS invoice_number,
               CASE WHEN o_orderkey % 3 = 0 THEN 'ACCPAY' ELSE 'ACCREC' END AS type,
               CASE WHEN o_orderstatus = 'F' THEN 'PAID' WHEN o_orderstatus = 'O' THEN 'AUTHORISED'
                    WHEN o_orderpriority = '1-URGENT' THEN 'VOIDED' WHEN o_orderpriority = '2-HIGH' THEN 'DELETED'
                    WHEN o_orderpriority = '5-LOW' THEN 'DRAFT' ELSE 'SUBMITTED' END AS status,
               CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE 'C' END || o_custkey AS contact_id, c_name AS contact_name,
               CAST(o_orderdate AS DATE) AS date,
               CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) + 30 END AS due_date,
               CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS DECIMAL(15,2)) ELSE total END AS amount_due,
               CASE WHEN o_orderstatus = 'F' THEN total ELSE CAST(0 AS DECIMAL(15,2)) END AS amount_paid,
               CASE WHEN o_orderkey % 4 <> 0 THEN CAST(0 AS DECIMAL(15,2)) END AS amount_credited,
               CAST(total - tax AS DECIMAL(15,2)) AS subtotal, tax AS total_tax, total,
               CASE WHEN o_orderkey % 7 = 0 THEN 'EUR' ELSE 'GBP' END AS currency_code,
               CASE WHEN o_orderkey % 9 <> 0 THEN CAST(CASE WHEN o_orderkey % 7 = 0 THEN '1.15' ELSE '1' END AS DECIMAL(20,10)) END AS currency_rate,
               o_orderpriority AS reference, o_orderdate + INTERVAL '1 hours' AS source_updated_at
        FROM (SELECT *, CAST(o_totalprice AS DECIMAL(15,2)) AS total,
                     CAST(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(15,2)) AS tax FROM owned_orders)""",
    "lines": """
        SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""",
    "raw_invoice_lines": """
        SELECT connection_id, tenant_id, CAST(l_orderkey AS VARCHAR) AS source_invoice_id,
               CAST(l_linenumber AS VARCHAR) AS source_id,
               CASE WHEN l_linenumber % 4 <> 0 THEN 'Part ' || l_partkey END AS description,
               CAST(l_quantity AS DECIMAL(20,6)) AS quantity, CAST(l_extendedprice AS DECIMAL(15,4)) AS unit_amount,
               CAST(l_extendedprice AS DECIMAL(15,2)) AS line_amount,
               CASE WHEN l_linenumber % 6 <> 0 THEN 'Brand#' || (l_partkey % 25 + 1) END AS account_code,
               l_returnflag AS tax_type,
               CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS tax_amount,
               CAST(l_partkey AS VARCHAR) AS item_code, o_orderdate + INTERVAL '1 hours' AS source_updated_at
        FROM lines JOIN owned_orders ON l_orderkey = o_orderkey""",
    "raw_payments": """
        SELECT connection_id, tenant_id, 'P' || event_id AS source_id, CAST(ts AS DATE) AS date,
               CAST(value AS DECIMAL(15,2)) AS amount, CASE WHEN event_id % 6 <> 0 THEN 'PAY-' || event_id END AS reference,
               event_id % 2 = 0 AS is_reconciled, CASE WHEN event_id % 5 = 0 THEN 'DELETED' ELSE 'AUTHORISED' END AS status,
               CASE WHEN event_id % 3 = 0 THEN 'ACCPAYPAYMENT' ELSE 'ACCRECPAYMENT' END AS payment_type,
               CAST(1 AS DECIMAL(20,10)) AS currency_rate,
               CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS VARCHAR) END AS invoice_id,
               CASE WHEN event_id % 10 <> 0 THEN 'INV-' || lpad(CAST(event_id AS VARCHAR), 10, '0') END AS invoice_number,
               CAST(user_id AS VARCHAR) AS account_id, 'Brand#' || (user_id % 25 + 1) AS account_code,
               date_trunc('millisecond', ts) AS source_updated_at
        FROM events JOIN owned_orders ON event_id = o_orderkey WHERE event_type = 'purchase'""",
    "owned_events": """
        SELECT e.*, CAST(n_nationkey AS VARCHAR) AS connection_id, CAST(n_regionkey AS VARCHAR) AS tenant_id
        FROM events e JOIN nation ON user_id % 25 = n_nationkey""",
    "raw_bank_transactions": """
        SELECT connection_id, tenant_id, 'B' || event_id AS source_id,
               CASE WHEN event_type = 'click' THEN 'SPEND' ELSE 'RECEIVE' END AS type,
               CASE WHEN event_id % 8 = 0 THEN 'DELETED' ELSE 'AUTHORISED' END AS status,
               CASE WHEN event_id % 4 <> 0 THEN 'BT-' || event_id END AS reference, event_id % 3 = 0 AS is_reconciled,
               CAST(ts AS DATE) AS date, CAST(total - tax AS DECIMAL(15,2)) AS subtotal, tax AS total_tax, total,
               'GBP' AS currency_code, CAST(1 AS DECIMAL(20,10)) AS currency_rate, CAST(user_id AS VARCHAR) AS bank_account_id,
               'Brand#' || (user_id % 25 + 1) AS bank_account_code, 'Account ' || user_id AS bank_account_name,
               CASE WHEN event_id % 9 <> 0 THEN 'C' || user_id END AS contact_id,
               CASE WHEN event_id % 9 <> 0 THEN 'Contact ' || user_id END AS contact_name,
               date_trunc('millisecond', ts) AS source_updated_at
        FROM (SELECT *, CAST(value AS DECIMAL(15,2)) AS total,
                     CAST(CAST(value AS DECIMAL(15,2)) * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(15,2)) AS tax
              FROM owned_events WHERE event_type IN ('click', 'view'))""",
    "raw_manual_journals": """
        SELECT connection_id, tenant_id, 'J' || event_id AS source_id, 'signup ' || event_id AS narration,
               CAST(ts AS DATE) AS date, CASE WHEN event_id % 4 = 0 THEN 'DRAFT' ELSE 'POSTED' END AS status,
               date_trunc('millisecond', ts) AS source_updated_at
        FROM owned_events WHERE event_type = 'signup'""",
    "dim_tenant": f"SELECT id, name, slug, is_active, {LOADED_AT} AS warehouse_updated_at FROM tenants",
    "dim_contact": f"""
        SELECT {key('dim_contact', 'tenant_id', 'source_id')} AS id, tenant_id, source_id, name, first_name, last_name,
               email_address, contact_status, is_supplier, is_customer, tax_number, default_currency, source_updated_at,
               {LOADED_AT} AS warehouse_updated_at FROM raw_contacts""",
    "dim_account": f"""
        SELECT {key('dim_account', 'tenant_id', 'source_id')} AS id, tenant_id, source_id, code, name, type, status, class,
               description, tax_type, type = 'BANK' AS is_bank_account, source_updated_at,
               {LOADED_AT} AS warehouse_updated_at FROM raw_accounts""",
    "fact_invoice": f"""
        SELECT {key('fact_invoice', 'r.tenant_id', 'r.source_id')} AS id, r.tenant_id, c.id AS dim_contact_id, r.source_id,
               invoice_number, type, status, date, due_date, amount_due, amount_paid, amount_credited, subtotal, total_tax,
               total, currency_code, currency_rate, reference,
               status NOT IN ('PAID', 'VOIDED', 'DELETED') AND due_date IS NOT NULL AND due_date < {AS_OF} AS is_overdue,
               CAST(CASE WHEN status NOT IN ('PAID', 'VOIDED', 'DELETED') AND due_date IS NOT NULL AND due_date < {AS_OF}
                    THEN greatest(0, {AS_OF} - due_date) END AS INTEGER) AS days_overdue,
               r.source_updated_at, {LOADED_AT} AS warehouse_updated_at
        FROM raw_invoices r LEFT JOIN dim_contact c ON c.tenant_id = r.tenant_id AND c.source_id = r.contact_id""",
    "account_by_code": "SELECT tenant_id, code, arg_min(id, source_id) AS id FROM dim_account GROUP BY tenant_id, code",
    "fact_invoice_line": f"""
        SELECT {key('fact_invoice_line', 'r.tenant_id', 'source_invoice_id', 'r.source_id')} AS id, r.tenant_id,
               f.id AS fact_invoice_id, a.id AS dim_account_id, source_invoice_id, r.source_id, r.description, quantity,
               unit_amount, line_amount, account_code, r.tax_type, tax_amount, item_code, {LOADED_AT} AS warehouse_updated_at
        FROM raw_invoice_lines r
        LEFT JOIN fact_invoice f ON f.tenant_id = r.tenant_id AND f.source_id = r.source_invoice_id
        LEFT JOIN account_by_code a ON a.tenant_id = r.tenant_id AND a.code = r.account_code""",
    "fact_payment": f"""
        SELECT {key('fact_payment', 'r.tenant_id', 'r.source_id')} AS id, r.tenant_id, f.id AS fact_invoice_id,
               a.id AS dim_account_id, r.source_id, r.date, r.amount, r.reference, r.is_reconciled, r.status, r.payment_type,
               r.currency_rate, r.source_updated_at, {LOADED_AT} AS warehouse_updated_at, r.invoice_id, r.account_id
        FROM raw_payments r
        LEFT JOIN fact_invoice f ON f.tenant_id = r.tenant_id AND f.source_id = r.invoice_id
        LEFT JOIN dim_account a ON a.tenant_id = r.tenant_id AND a.source_id = r.account_id""",
    "fact_bank_transaction": f"""
        SELECT {key('fact_bank_transaction', 'r.tenant_id', 'r.source_id')} AS id, r.tenant_id, c.id AS dim_contact_id,
               a.id AS dim_account_id, r.source_id, r.type, r.status, r.reference, r.is_reconciled, r.date, r.subtotal,
               r.total_tax, r.total, r.currency_code, r.currency_rate, r.source_updated_at, {LOADED_AT} AS warehouse_updated_at
        FROM raw_bank_transactions r
        LEFT JOIN dim_contact c ON c.tenant_id = r.tenant_id AND c.source_id = r.contact_id
        LEFT JOIN dim_account a ON a.tenant_id = r.tenant_id AND a.source_id = r.bank_account_id""",
    "fact_manual_journal": f"""
        SELECT {key('fact_manual_journal', 'tenant_id', 'source_id')} AS id, tenant_id, source_id, narration, date, status,
               source_updated_at, {LOADED_AT} AS warehouse_updated_at FROM raw_manual_journals""",
    "sync_runs": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(n_nationkey AS VARCHAR) AS connection_id,
               CAST(n_regionkey AS VARCHAR) AS tenant_id,
               CASE o_orderstatus WHEN 'O' THEN 'completed' WHEN 'F' THEN 'failed' ELSE 'running' END AS status,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'manual' WHEN '2-HIGH' THEN 'webhook' ELSE 'scheduled' END AS triggered_by,
               o_orderdate AS started_at,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_seconds(o_orderkey % 3600) END AS completed_at,
               CAST(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 3600 * 1000 END AS INTEGER) AS duration_ms,
               CASE WHEN o_orderstatus = 'F' THEN 'sync failed: ' || o_orderpriority END AS error, o_orderdate AS created_at
        FROM orders JOIN nation ON o_orderkey % 25 = n_nationkey""",
    "sync_run_steps": """
        SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS sync_run_id,
               CASE l_linenumber WHEN 1 THEN 'invoices' WHEN 2 THEN 'contacts' WHEN 3 THEN 'payments' WHEN 4 THEN 'bank_transactions'
                    WHEN 5 THEN 'accounts' WHEN 6 THEN 'manual_journals' WHEN 7 THEN 'reports' END AS entity,
               CASE l_returnflag WHEN 'A' THEN 'completed' WHEN 'R' THEN 'failed' ELSE 'skipped' END AS status,
               CAST(l_quantity AS INTEGER) AS records_synced, l_linenumber AS records_failed, l_shipdate AS started_at,
               CASE WHEN l_returnflag <> 'N' THEN l_shipdate + to_seconds(l_partkey % 600) END AS completed_at,
               CASE WHEN l_returnflag = 'R' THEN 'step failed: ' || l_suppkey END AS error, l_shipdate AS created_at
        FROM lines""",
    "sync_checkpoints": """
        SELECT CAST(CASE WHEN user_id % 23 < 3 THEN user_id % 23 WHEN user_id % 23 < 16 THEN user_id % 23 + 1
                         ELSE user_id % 23 + 2 END AS VARCHAR) AS connection_id,
               CASE event_type WHEN 'click' THEN 'bank_transactions' WHEN 'view' THEN 'contacts' WHEN 'purchase' THEN 'payments'
                    WHEN 'signup' THEN 'manual_journals' ELSE 'invoices' END AS entity,
               max(ts) AS last_modified_at, CAST(arg_max(event_id, ts) AS VARCHAR) AS last_run_id
        FROM events GROUP BY 1, 2""",
    "uploaded": f"""
        SELECT *, 'B' || lpad(CAST(b AS VARCHAR), 2, '0') AS batch_id, CAST(b % 5 AS VARCHAR) AS tenant_id,
               CAST(row_number() OVER (PARTITION BY b ORDER BY event_id) - 1 AS INTEGER) AS row_index,
               CAST(floor(value) AS BIGINT) AS whole, event_id % 6 AS style,
               CASE WHEN event_id % 19 <> 0 THEN event_type END AS description,
               CASE WHEN b = 19 THEN 'soon' WHEN event_id % 17 = 0 THEN {BROKEN_DATE}
                    ELSE CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%d/%m/%Y')
                         WHEN 2 THEN strftime(ts, '%d-%m-%Y') WHEN 3 THEN strftime(ts, '%d %b %Y')
                         WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE strftime(ts, '%-d/%-m/%Y %H:%M') END END AS date_cell
        FROM (SELECT *, user_id % 10 AS b FROM events
              UNION ALL SELECT *, user_id % 10 + 10 FROM events WHERE event_id % 7 = 0)""",
    "row_texts": """
        SELECT *, CASE style
            WHEN 0 THEN '{"Date":"' || date_cell || '","Amount":"' || whole || '","Reference":"R' || event_id || '"' || coalesce(',"Description":"' || description || '"', '') || '}'
            WHEN 1 THEN '{"Amount":"£' || whole || '.50"' || coalesce(',"Details":"' || description || '"', '') || ',"Transaction Date":"' || date_cell || '"}'
            WHEN 2 THEN '{"Debit":"' || whole || '","Credit":""' || coalesce(',"Narrative":"' || description || '"', '') || ',"Posting Date":"' || date_cell || '"}'
            WHEN 3 THEN '{' || coalesce('"Memo":"' || description || '",', '') || '"Debit":"",' || '" date ":"' || date_cell || '","Credit":"' || whole || '"}'
            WHEN 4 THEN '{"amount":"-' || whole || '"' || coalesce(',"Particulars":"' || description || '"', '') || ',"TransactionDate":"' || date_cell || '"}'
            ELSE '{"Debit":"' || whole || '","Amount":"n/a","PostingDate":"' || date_cell || '"' || coalesce(',"Transaction Description":"' || description || '"', '') || '}' END AS raw_json
        FROM uploaded""",
    "parsed_rows": """
        SELECT *, CASE WHEN date_cell <> '' AND date_cell <> 'soon' AND date_cell <> '31/02/2024' THEN CAST(ts AS DATE) END AS date,
               CASE style WHEN 0 THEN CAST(whole AS DECIMAL(15,2)) WHEN 1 THEN CAST(whole + 0.5 AS DECIMAL(15,2))
                    WHEN 2 THEN CAST(nullif(-whole, 0) AS DECIMAL(15,2)) WHEN 3 THEN CAST(nullif(whole, 0) AS DECIMAL(15,2))
                    WHEN 4 THEN CAST(-whole AS DECIMAL(15,2)) ELSE CAST(nullif(-whole, 0) AS DECIMAL(15,2)) END AS amount,
               CASE WHEN style = 0 THEN 'R' || event_id END AS reference
        FROM row_texts""",
    "checked_rows": f"""
        SELECT *, CASE WHEN date_cell = '' THEN 'Missing date in row: ' || raw_json
                       WHEN description IS NULL THEN 'Missing description in row: ' || raw_json
                       WHEN date_cell = 'soon' THEN 'Cannot parse date: "soon"'
                       WHEN amount IS NULL THEN 'Cannot parse amount from row: ' || raw_json
                       WHEN date IS NULL THEN 'date/time field value out of range: "2024-02-31"' END AS error,
               md5(tenant_id || '|' || strftime(date, '%Y-%m-%d') || '|' || description || '|' || {plain('amount')}) AS dedup_hash
        FROM parsed_rows""",
    "new_lines": f"""
        SELECT *, {key('statement_lines', 'tenant_id', 'dedup_hash')} AS id FROM checked_rows WHERE error IS NULL
        QUALIFY row_number() OVER (PARTITION BY tenant_id, dedup_hash ORDER BY batch_id, row_index) = 1""",
    "statement_lines": f"""
        SELECT id, tenant_id, batch_id, row_index, date, description, amount, reference, 'GBP' AS currency_code,
               CASE WHEN row_index % 3 = 0 THEN '400' END AS account_code, CAST(NULL AS VARCHAR) AS account_name,
               CASE WHEN row_index % 3 = 0 AND amount < 0 THEN 'Cost' END AS category,
               CASE WHEN row_index % 3 = 0 THEN 'NONE' END AS tax_type, CAST(NULL AS VARCHAR) AS notes, false AS is_suggested,
               row_index % 6 = 0 AS approved, CASE WHEN row_index % 6 = 0 THEN 'U1' END AS approved_by,
               CASE WHEN row_index % 6 = 0 THEN {LOADED_AT} END AS approved_at, dedup_hash,
               {LOADED_AT} AS created_at, {LOADED_AT} AS updated_at FROM new_lines""",
    "first_errors": """
        SELECT batch_id, string_agg(error, '; ' ORDER BY row_index) AS error FROM (
            SELECT batch_id, row_index, error FROM checked_rows WHERE error IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY row_index) <= 5) GROUP BY batch_id""",
    "batch_results": """
        SELECT r.batch_id, tenant_id, 'statement_' || r.batch_id || '.csv' AS filename,
               TIMESTAMP '2001-08-01 10:00:00' - to_hours(5 * CAST(substr(r.batch_id, 2) AS INTEGER)) AS created_at,
               CASE WHEN count(*) = count(r.error) THEN 'failed' ELSE 'completed' END AS status,
               count(*) - count(r.error) AS processed, count(r.error) AS skipped,
               CAST(count(*) - count(r.error) AS INTEGER) AS row_count, any_value(e.error) AS error
        FROM checked_rows r LEFT JOIN first_errors e ON e.batch_id = r.batch_id GROUP BY r.batch_id, tenant_id""",
    "upload_batches": """
        SELECT batch_id AS id, tenant_id, filename, row_count * 64 AS file_size_bytes, row_count,
               CASE batch_id WHEN 'B17' THEN 'pending' WHEN 'B18' THEN 'processing' ELSE status END AS status, error, created_at,
               CASE WHEN batch_id NOT IN ('B17', 'B18') THEN created_at + INTERVAL '90 seconds' END AS completed_at
        FROM batch_results""",
    "old_batches": f"SELECT id FROM upload_batches WHERE tenant_id = '2' OR created_at < {RUN_CLOCK} - INTERVAL '60 hours'",
    "client_meta": """
        SELECT CAST(c_custkey AS VARCHAR) AS tenant_id,
               CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 12 + 1 AS INTEGER) END AS business_type_id,
               CASE WHEN c_custkey % 3 = 0 THEN 'EUR' END AS base_currency,
               CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey % 14 AS INTEGER) END AS fiscal_year_end_month,
               c_custkey % 2 = 0 AS vat_registered, CASE WHEN c_custkey % 2 = 0 THEN 'standard' END AS vat_scheme,
               CASE WHEN c_custkey % 6 = 0 THEN '090' END AS primary_bank_account FROM customer""",
    "business_types": "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(BUSINESS, 1)) + ") t(id, name)",
    "snapshots": f"""
        SELECT {key('report_snapshots', 'l.n_nationkey', 'report_type', "strftime(period_date, '%Y-%m-%d')")} AS snapshot_id,
               CAST(l.n_nationkey AS VARCHAR) AS connection_id, tenant_id, report_type, period_date,
               CASE WHEN report_type = 'profit_and_loss' THEN CAST(date_trunc('month', period_date) AS DATE) END AS period_from
        FROM (SELECT DISTINCT tenant_id, last_day(CAST(o_orderdate AS DATE)) AS period_date FROM owned_orders) m
        CROSS JOIN (VALUES ('trial_balance'), ('profit_and_loss'), ('balance_sheet')) t(report_type)
        JOIN lead_connection l ON CAST(l.n_regionkey AS VARCHAR) = tenant_id""",
    "monthly": f"""
        SELECT tenant_id, last_day(CAST(o_orderdate AS DATE)) AS period_date, o_orderstatus AS st, o_orderpriority AS pr,
               sum({money('o_totalprice')}) AS total,
               sum(CASE WHEN o_orderkey % 3 <> 0 THEN {money('o_totalprice')} ELSE 0 END) AS debit,
               sum(CASE WHEN o_orderkey % 3 = 0 THEN {money('o_totalprice')} ELSE 0 END) AS credit,
               max({money('o_totalprice')}) AS top, min({money('o_totalprice')}) AS low
        FROM owned_orders GROUP BY 1, 2, 3, 4""",
    "report_rows": """
        SELECT tenant_id, period_date, st, 0 AS closing, 0 AS level, pr AS sort_key, st || '-' || pr AS account, pr AS name,
               total, debit, credit, top, low FROM monthly
        UNION ALL SELECT tenant_id, period_date, st, 0, 1, '', NULL, 'Total ' || st, sum(total), sum(debit), sum(credit), max(top), min(low)
        FROM monthly GROUP BY tenant_id, period_date, st
        UNION ALL SELECT tenant_id, period_date, NULL, 1, 1, '', NULL, NULL, sum(total), NULL, NULL, NULL, NULL
        FROM monthly GROUP BY tenant_id, period_date""",
    "numbered_rows": """
        SELECT *, CAST(row_number() OVER (PARTITION BY tenant_id, period_date ORDER BY closing, st, level, sort_key) - 1 AS INTEGER) AS row_order
        FROM report_rows""",
    "fact_trial_balance": f"""
        SELECT {key('fact_trial_balance_snapshot', 'snapshot_id', 'row_order')} AS id, snapshot_id, n.tenant_id, n.period_date,
               row_order, account AS account_source_id, name AS account_name, {money('debit')} AS debit,
               {money('credit')} AS credit, {money('top')} AS ytd_debit, {money('low')} AS ytd_credit,
               CASE WHEN level = 0 THEN 'row' ELSE 'summary' END AS row_type
        FROM numbered_rows n JOIN snapshots s ON s.tenant_id = n.tenant_id AND s.period_date = n.period_date
        WHERE report_type = 'trial_balance' AND closing = 0""",
    "fact_profit_and_loss": f"""
        SELECT {key('fact_profit_and_loss_snapshot', 'snapshot_id', 'row_order')} AS id, snapshot_id, n.tenant_id, period_from,
               n.period_date AS period_to, row_order, st AS section, account AS account_source_id,
               coalesce(name, 'Net Profit') AS account_name, {money('total')} AS value,
               CASE WHEN level = 0 THEN 'row' ELSE 'summary' END AS row_type
        FROM numbered_rows n JOIN snapshots s ON s.tenant_id = n.tenant_id AND s.period_date = n.period_date
        WHERE report_type = 'profit_and_loss'""",
    "fact_balance_sheet": f"""
        SELECT {key('fact_balance_sheet_snapshot', 'snapshot_id', 'row_order')} AS id, snapshot_id, n.tenant_id, n.period_date,
               row_order, 'Group ' || st AS section, st AS sub_section, account AS account_source_id,
               coalesce(name, 'Total') AS account_name, {money('total')} AS value,
               CASE WHEN level = 0 THEN 'row' ELSE 'summary' END AS row_type
        FROM numbered_rows n JOIN snapshots s ON s.tenant_id = n.tenant_id AND s.period_date = n.period_date
        WHERE report_type = 'balance_sheet'""",
    "pnl_view": """
        SELECT f.id, tenant_id, t.name AS tenant_name, snapshot_id, period_from, period_to,
               strftime(period_to, '%b %Y') AS period_label, section, account_source_id, account_name, value, row_type, row_order
        FROM fact_profit_and_loss f JOIN dim_tenant t ON t.id = f.tenant_id""",
    "trial_view": """
        SELECT f.id, tenant_id, t.name AS tenant_name, snapshot_id, period_date, strftime(period_date, '%b %Y') AS period_label,
               account_source_id, account_name, debit, credit, ytd_debit, ytd_credit, row_type, row_order
        FROM fact_trial_balance f JOIN dim_tenant t ON t.id = f.tenant_id""",
    "overdue_view": """
        SELECT f.id, f.tenant_id, t.name AS tenant_name, f.source_id, invoice_number, type, status, date AS invoice_date, due_date,
               days_overdue, c.name AS contact_name, c.email_address AS contact_email, total, amount_paid, amount_due,
               currency_code, f.warehouse_updated_at
        FROM fact_invoice f JOIN dim_tenant t ON t.id = f.tenant_id LEFT JOIN dim_contact c ON c.id = f.dim_contact_id
        WHERE is_overdue AND status NOT IN ('VOIDED', 'DELETED')""",
    "ageing_view": """
        SELECT f.id, f.tenant_id, t.name AS tenant_name, f.source_id, invoice_number, type, status, date AS invoice_date, due_date,
               amount_due, currency_code, c.name AS contact_name,
               CASE WHEN amount_due <= 0 THEN 'current' WHEN days_overdue IS NULL OR days_overdue = 0 THEN 'current'
                    WHEN days_overdue <= 30 THEN '1-30' WHEN days_overdue <= 60 THEN '31-60'
                    WHEN days_overdue <= 90 THEN '61-90' ELSE '90+' END AS ageing_bucket,
               coalesce(days_overdue, 0) AS days_overdue, f.warehouse_updated_at
        FROM fact_invoice f JOIN dim_tenant t ON t.id = f.tenant_id LEFT JOIN dim_contact c ON c.id = f.dim_contact_id
        WHERE status NOT IN ('VOIDED', 'DELETED', 'DRAFT')""",
    "payment_view": """
        SELECT p.id, p.tenant_id, t.name AS tenant_name, p.source_id, p.date AS payment_date, p.amount, p.reference, payment_type,
               is_reconciled, p.status, p.currency_rate, f.invoice_number, f.type AS invoice_type, c.name AS contact_name,
               a.code AS account_code, a.name AS account_name, a.class AS account_class, p.warehouse_updated_at
        FROM fact_payment p JOIN dim_tenant t ON t.id = p.tenant_id LEFT JOIN fact_invoice f ON f.id = p.fact_invoice_id
        LEFT JOIN dim_contact c ON c.id = f.dim_contact_id LEFT JOIN dim_account a ON a.id = p.dim_account_id
        WHERE p.status = 'AUTHORISED'""",
    "freshness_view": f"""
        SELECT t.id AS tenant_id, t.name AS tenant_name, t.is_active AS tenant_is_active, c.id AS connection_id, org_name,
               c.is_active AS connection_is_active, entity, last_modified_at,
               {hours(CURSOR_CLOCK, 'last_modified_at')} AS hours_since_sync,
               {freshness('last_modified_at', CURSOR_CLOCK)} AS freshness_status, r.status AS last_run_status,
               r.started_at AS last_run_started_at, r.completed_at AS last_run_completed_at,
               r.duration_ms AS last_run_duration_ms, r.error AS last_run_error
        FROM tenants t JOIN connections c ON c.tenant_id = t.id LEFT JOIN sync_checkpoints k ON k.connection_id = c.id
        LEFT JOIN sync_runs r ON r.id = k.last_run_id""",
    "run_summary": """
        SELECT r.id, r.tenant_id, t.name AS tenant_name, c.id AS connection_id, org_name, r.status, triggered_by, r.started_at,
               r.completed_at, duration_ms, r.error, r.created_at, count(s.id) AS total_steps,
               count(s.id) FILTER (WHERE s.status = 'completed') AS completed_steps,
               count(s.id) FILTER (WHERE s.status = 'failed') AS failed_steps,
               count(s.id) FILTER (WHERE s.status = 'skipped') AS skipped_steps,
               CAST(coalesce(sum(records_synced), 0) AS BIGINT) AS total_records_synced,
               CAST(coalesce(sum(records_failed), 0) AS BIGINT) AS total_records_failed
        FROM sync_runs r JOIN connections c ON c.id = r.connection_id JOIN tenants t ON t.id = r.tenant_id
        LEFT JOIN sync_run_steps s ON s.sync_run_id = r.id GROUP BY ALL""",
    "older": "SELECT * REPLACE ('DRAFT' AS status, 'old' AS reference, CASE type WHEN 'ACCREC' THEN 'ACCPAY' ELSE 'ACCREC' END AS type) FROM raw_invoices WHERE CAST(source_id AS BIGINT) % 3 <> 0",
    "newer": "SELECT * REPLACE (CASE WHEN status <> 'PAID' THEN reference END AS reference) FROM raw_invoices WHERE CAST(source_id AS BIGINT) % 3 <> 1",
    "streamed_lines": f"""
        SELECT {key('statement_lines', 'tenant_id', 'dedup_hash')} AS id, * FROM (
            SELECT CAST(user_id % 5 AS VARCHAR) AS tenant_id, 'B' || (user_id % 10) AS batch_id, event_id AS row_index,
                   CAST(ts AS DATE) AS date, event_type AS description, CAST(floor(value) AS DECIMAL(15,2)) AS amount,
                   md5((user_id % 5) || '|' || strftime(ts, '%Y-%m-%d') || '|' || event_type || '|' || {plain('floor(value)')}) AS dedup_hash
            FROM events)""",
}


# every delivery of a line, where raw_invoice_lines has the last
SHAPES["delivered_invoice_lines"] = SHAPES["raw_invoice_lines"].replace("FROM lines ", "FROM lineitem ")


def sql(text: str) -> str:
    """Prefix ``text`` with the shapes it needs, in dependency order."""
    needed: list[str] = []

    def visit(fragment: str) -> None:
        for name in SHAPES:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", fragment):
                visit(SHAPES[name])
                needed.append(name)

    visit(text)
    if not needed:
        return text
    # MATERIALIZED: a shape used by several others is computed once
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({SHAPES[n]})" for n in needed) + "\n" + text


def columns_of(table: str) -> str:
    return f"SELECT * FROM {table}"


def lookups_row(name: str, table: str, natural: str, resolved: str) -> str:
    return (f"SELECT '{name}' AS lookup, count(*) AS row_count, "
            f"count(*) FILTER (WHERE {natural} IS NOT NULL AND {resolved} IS NULL) AS unresolved FROM {table}")


def rule(table: str, name: str, violation: str, source: str | None = None) -> str:
    return f"SELECT '{table}' AS table_name, '{name}' AS rule_name, count(*) FILTER (WHERE {violation}) AS violations FROM {source or table}"


def lifecycle(name: str, table: str, violation: str) -> str:
    return f"SELECT '{name}' AS rule_name, count(*) FILTER (WHERE {violation}) AS violations FROM {table}"


def orphan(name: str, child: str, fk: str, parent: str, pk: str) -> str:
    return (f"SELECT '{name}' AS relation, count(*) AS orphans FROM {child} c WHERE {fk} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {pk} = {fk})")


def duplicates(table: str, keys: str, source: str | None = None) -> str:
    return (f"SELECT '{table}' AS table_name, count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_involved "
            f"FROM (SELECT count(*) AS n FROM {source or table} GROUP BY {keys} HAVING count(*) > 1)")


def upserts(entity: str, table: str) -> str:
    return f"SELECT '{entity}' AS entity, count(*) AS upserted FROM {table}"


def union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


SYNCED = f"{LOADED_AT} AS synced_at"
MERGED = "connection_id, source_id"
STEP_JOIN = """LEFT JOIN (SELECT sync_run_id, id AS step_id, entity AS step_entity, status AS step_status, records_synced,
    records_failed, started_at AS step_started_at, completed_at AS step_completed_at, error AS step_error{extra}
    FROM sync_run_steps) s ON s.sync_run_id = r.id"""
WHOLE_TABLES = {
    "dim_tenant": "tenants", "dim_contact": "raw_contacts", "dim_account": "raw_accounts", "fact_invoice": "raw_invoices",
    "fact_invoice_line": "raw_invoice_lines", "fact_payment": "raw_payments", "fact_bank_transaction": "raw_bank_transactions",
    "fact_manual_journal": "raw_manual_journals", "fact_trial_balance": "fact_trial_balance",
    "fact_profit_and_loss": "fact_profit_and_loss", "fact_balance_sheet": "fact_balance_sheet",
}
UPSERT_PARTS = union([upserts(entity, table) for entity, table in WHOLE_TABLES.items()])

QUERIES: dict[str, str] = {
    # ingest
    "ingest_invoices": f"SELECT *, {SYNCED} FROM raw_invoices",
    "ingest_invoice_lines": f"SELECT *, {SYNCED} FROM delivered_invoice_lines",
    "ingest_contacts": f"SELECT *, {SYNCED} FROM raw_contacts",
    "ingest_payments": f"SELECT *, {SYNCED} FROM raw_payments",
    "ingest_bank_transactions": f"SELECT *, {SYNCED} FROM raw_bank_transactions",
    "ingest_accounts": f"SELECT * REPLACE (coalesce(enable_payments, false) AS enable_payments), {SYNCED} FROM raw_accounts",
    "ingest_manual_journals": f"SELECT *, {SYNCED} FROM raw_manual_journals",
    "ingest_report_snapshots": f"SELECT snapshot_id AS id, connection_id, tenant_id, report_type, period_date, period_from, report_type AS report_name, {LOADED_AT} AS captured_at FROM snapshots",
    "statement_raw_rows": "SELECT batch_id, tenant_id, row_index, raw_json FROM row_texts",
    "statement_batch_headers": """
        SELECT batch_id AS id, tenant_id, 'statement_' || batch_id || '.csv' AS filename, CAST(count(*) AS INTEGER) AS row_count,
               'pending' AS status, CAST(NULL AS VARCHAR) AS error,
               TIMESTAMP '2001-08-01 10:00:00' - to_hours(5 * CAST(substr(batch_id, 2) AS INTEGER)) AS created_at
        FROM uploaded GROUP BY batch_id, tenant_id""",
    "incremental_changes": """
        SELECT p.connection_id, tenant_id, source_id, amount, source_updated_at FROM raw_payments p
        LEFT JOIN sync_checkpoints k ON k.connection_id = p.connection_id AND k.entity = 'payments'
        WHERE last_modified_at IS NULL OR source_updated_at >= date_trunc('second', last_modified_at - INTERVAL '14 days')""",
    "active_connections": "SELECT * FROM connections WHERE is_active",
    "client_metadata_resolved": """
        SELECT tenant_id, business_type_id, b.name AS business_type, coalesce(base_currency, 'GBP') AS base_currency,
               coalesce(fiscal_year_end_month, 3) AS fiscal_year_end_month, vat_registered, vat_scheme, primary_bank_account,
               CAST(NULL AS VARCHAR) AS notes
        FROM client_meta LEFT JOIN business_types b ON b.id = business_type_id""",
    "wire_date_parse": """
        SELECT event_id, CASE WHEN event_id % 6 IN (0, 1) THEN date_trunc('millisecond', ts)
                              WHEN event_id % 6 = 2 THEN date_trunc('second', ts) END AS parsed FROM events""",
    # merges
    "keyed_merge_update": """
        SELECT coalesce(n.connection_id, o.connection_id) AS connection_id, coalesce(n.source_id, o.source_id) AS source_id,
               CASE WHEN n.source_id IS NOT NULL THEN n.type ELSE o.type END AS type,
               CASE WHEN n.source_id IS NOT NULL THEN n.status ELSE o.status END AS status,
               CASE WHEN n.source_id IS NOT NULL THEN n.reference ELSE o.reference END AS reference,
               CASE WHEN n.source_id IS NOT NULL THEN n.amount_due ELSE o.amount_due END AS amount_due
        FROM older o FULL JOIN newer n ON o.connection_id = n.connection_id AND o.source_id = n.source_id""",
    "keyed_merge_insert_only": """
        SELECT coalesce(n.connection_id, o.connection_id) AS connection_id, coalesce(n.source_id, o.source_id) AS source_id,
               CASE WHEN o.source_id IS NOT NULL THEN o.type ELSE n.type END AS type,
               CASE WHEN n.source_id IS NOT NULL THEN n.status ELSE o.status END AS status,
               CASE WHEN n.source_id IS NOT NULL THEN n.reference ELSE o.reference END AS reference,
               CASE WHEN n.source_id IS NOT NULL THEN n.amount_due ELSE o.amount_due END AS amount_due,
               coalesce(o.tenant_id, n.tenant_id) AS tenant_id
        FROM older o FULL JOIN newer n ON o.connection_id = n.connection_id AND o.source_id = n.source_id""",
    "keyed_merge_guarded": """
        WITH deliveries AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem),
        last AS (SELECT * FROM deliveries QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                 ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1),
        held AS (SELECT l_orderkey, l_linenumber, min(l_shipdate) AS first_date FROM deliveries WHERE l_linenumber <= 3 GROUP BY ALL)
        SELECT l_orderkey, l_linenumber, coalesce(first_date, l_shipdate) AS l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
        FROM last LEFT JOIN held USING (l_orderkey, l_linenumber)""",
    "statement_csv_rows": """
        SELECT user_id % 10 AS batch, CAST(row_number() OVER (PARTITION BY user_id % 10 ORDER BY event_id) - 1 AS INTEGER) AS row_index,
               strftime(ts, '%Y-%m-%d') AS date_text,
               CASE event_id % 5 WHEN 0 THEN event_type || chr(10) || chr(10) || 'said "no", twice' || chr(10) WHEN 1 THEN '5" ' || event_type
                    WHEN 2 THEN ',' || event_type WHEN 3 THEN '' ELSE event_type END AS memo,
               CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS amount_text, 'R' || chr(10) || event_id AS reference
        FROM events""",
    "keyed_merge_partitions": """
        SELECT coalesce(n.connection_id, o.connection_id) AS connection_id, coalesce(n.source_id, o.source_id) AS source_id,
               coalesce(o.type, n.type) AS type, CASE WHEN n.source_id IS NULL THEN o.status ELSE n.status END AS status,
               CASE WHEN n.source_id IS NULL THEN o.reference ELSE n.reference END AS reference,
               CASE WHEN n.source_id IS NULL THEN o.amount_due ELSE n.amount_due END AS amount_due,
               coalesce(o.tenant_id, n.tenant_id) AS tenant_id,
               CASE WHEN n.source_id IS NULL THEN o.date WHEN CAST(n.source_id AS BIGINT) % 3 = 2 THEN n.date + 40 ELSE n.date END AS date
        FROM older o FULL JOIN (SELECT * FROM newer WHERE tenant_id IN ('0', '1', '3') AND date >= DATE '1997-01-01') n
            ON o.connection_id = n.connection_id AND o.source_id = n.source_id""",
    "redate_overdue": "SELECT * FROM fact_invoice",
    "ageing_summary_incremental": """
        SELECT ageing_bucket, count(*) AS invoice_count, CAST(sum(amount_due) AS DECIMAL(18,2)) AS total_due, max(amount_due) AS largest_due
        FROM ageing_view WHERE type = 'ACCREC' GROUP BY ageing_bucket""",
    "runner_isolated": """
        SELECT c.id AS connection_id, CASE WHEN coalesce(rejected, 0) > 0 THEN 'failed' ELSE 'completed' END AS status,
               CASE WHEN coalesce(rejected, 0) > 0 THEN 0 ELSE coalesce(n, 0) END AS landed, CAST(coalesce(rejected, 0) AS BIGINT) AS rejected,
               CASE WHEN rejected > 0 THEN CASE CAST(c.id AS INTEGER) % 4 WHEN 1 THEN 'unreadable' ELSE 'bad value' END END AS error,
               CASE WHEN coalesce(rejected, 0) = 0 THEN amount END AS amount
        FROM connections c LEFT JOIN (
            SELECT connection_id, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount, count(*) FILTER (WHERE CASE CAST(connection_id AS INTEGER) % 4
                       WHEN 1 THEN CAST(substr(source_id, 2) AS BIGINT) % 10 = 0
                       WHEN 2 THEN CAST(substr(source_id, 2) AS BIGINT) % 7 = 0 ELSE false END) AS rejected
            FROM raw_payments GROUP BY connection_id) p ON p.connection_id = c.id""",
    "cascade_delete_tenants": """
        SELECT 'tenants' AS table_name, id AS key, CAST(NULL AS BIGINT) AS rows FROM tenants WHERE id <> '2'
        UNION ALL SELECT 'client_metadata', tenant_id, NULL FROM client_meta WHERE tenant_id <> '2'
        UNION ALL SELECT 'upload_batches', id, NULL FROM upload_batches WHERE id NOT IN (SELECT id FROM old_batches)
        UNION ALL SELECT 'uploaded_rows', batch_id || '-' || row_index, NULL FROM uploaded WHERE tenant_id <> '2' AND batch_id NOT IN (SELECT id FROM old_batches)
        UNION ALL SELECT 'statement_lines', id, NULL FROM statement_lines WHERE tenant_id <> '2' AND batch_id NOT IN (SELECT id FROM old_batches)
        UNION ALL SELECT 'sync_runs', id, NULL FROM sync_runs WHERE status <> 'failed'
        UNION ALL SELECT 'sync_run_steps', s.id, NULL FROM sync_run_steps s
            WHERE NOT EXISTS (SELECT 1 FROM sync_runs r WHERE r.id = s.sync_run_id AND r.status = 'failed')
        UNION ALL SELECT 'held', 'connections.tenant_id', count(*) FROM connections WHERE tenant_id = '2'
        UNION ALL SELECT 'held', 'sync_runs.tenant_id', count(*) FROM sync_runs WHERE tenant_id = '2' AND status <> 'failed'
        UNION ALL SELECT 'held', 'sync_checkpoints.last_run_id', count(*) FROM sync_checkpoints k
            JOIN sync_runs r ON r.id = k.last_run_id AND r.status = 'failed'""",
    "ingest_rejects": """
        SELECT 'payments' AS entity, CAST(substr(source_id, 2) AS BIGINT) AS number,
               CASE CAST(substr(source_id, 2) AS BIGINT) % 10 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'no key' WHEN 2 THEN 'bad value'
                    ELSE 'stored' END AS reason FROM raw_payments
        UNION ALL
        SELECT 'accounts', CAST(source_id AS BIGINT), 'stored' FROM raw_accounts WHERE CAST(source_id AS BIGINT) // 50 % 4 <> 0
        UNION ALL
        SELECT 'accounts', page, 'unreadable'
        FROM (SELECT DISTINCT connection_id, CAST(source_id AS BIGINT) // 50 AS page FROM raw_accounts) WHERE page % 4 = 0""",
    "keyed_insert_ignore": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lines WHERE l_linenumber <= 2
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem WHERE l_linenumber > 2
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""",
    "merge_source_duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "remap_connection_ids": """
        SELECT coalesce(c.source_org_id, r.connection_id) AS connection_id, source_id, total FROM raw_invoices r
        LEFT JOIN connections c ON c.id = r.connection_id AND c.is_active""",
    "backfill_tenants": """
        SELECT slug, name FROM (
            SELECT lower(regexp_replace(c_mktsegment || ' & ' || c_nationkey, '[^a-zA-Z0-9]+', '-', 'g')) AS slug,
                   c_mktsegment || ' & ' || c_nationkey AS name, c_custkey FROM customer)
        QUALIFY row_number() OVER (PARTITION BY slug ORDER BY c_custkey % 97 DESC, CAST(c_custkey AS VARCHAR) DESC) = 1""",
    "backfill_connections": """
        SELECT id, CASE WHEN CAST(id AS INTEGER) < 10 THEN tenant_id ELSE 'T' || id END AS tenant_id, source_org_id,
               CASE WHEN CAST(id AS INTEGER) < 10 THEN org_name ELSE replace(org_name, '_', ' ') END AS org_name, is_active
        FROM connections""",
    "apply_line_edits": """
        SELECT id, tenant_id, batch_id, date, amount, account_code, account_name, category, tax_type, approved, approved_by,
               approved_at, updated_at FROM statement_lines""",
    "checkpoint_advance": """
        SELECT coalesce(n.connection_id, k.connection_id) AS connection_id, coalesce(n.entity, k.entity) AS entity,
               coalesce(n.at, k.last_modified_at) AS last_modified_at, coalesce(n.run, k.last_run_id) AS last_run_id
        FROM sync_checkpoints k FULL JOIN (
            SELECT connection_id, 'invoices' AS entity, started_at AS at, id AS run
            FROM sync_runs WHERE status = 'completed'
            QUALIFY row_number() OVER (PARTITION BY connection_id ORDER BY started_at DESC, CAST(id AS BIGINT) DESC) = 1) n
        ON n.connection_id = k.connection_id AND n.entity = k.entity""",
    "soft_delete_connections": f"""
        SELECT c.id, tenant_id, org_name, CASE WHEN bad > good THEN false WHEN good > bad THEN true ELSE is_active END AS is_active,
               created_at, CASE WHEN bad > good THEN {RUN_CLOCK} WHEN good > bad THEN {LOADED_AT} ELSE updated_at END AS updated_at
        FROM connections c LEFT JOIN (
            SELECT connection_id, count(*) FILTER (WHERE status = 'failed') AS bad, count(*) FILTER (WHERE status = 'completed') AS good
            FROM sync_runs GROUP BY connection_id) o ON o.connection_id = c.id""",
    "cascade_delete_batches": """
        SELECT l.id, l.batch_id, date, amount FROM new_lines l JOIN upload_batches b ON b.id = l.batch_id
        WHERE b.created_at >= TIMESTAMP '2001-07-31 12:00:00'""",
    "run_outcomes": f"""
        SELECT r.id AS run_id, CASE WHEN f.n > 0 THEN 'failed' WHEN r.status = 'completed' THEN 'completed' ELSE 'running' END AS status,
               started_at, CASE WHEN f.n > 0 AND r.status = 'completed' THEN greatest(f.at, completed_at) WHEN f.n > 0 THEN f.at
                                WHEN r.status = 'completed' THEN completed_at END AS completed_at,
               CAST({micros('''CASE WHEN f.n > 0 AND r.status = 'completed' THEN greatest(f.at, completed_at) WHEN f.n > 0 THEN f.at
                                WHEN r.status = 'completed' THEN completed_at END''', 'started_at')} // 1000 AS BIGINT) AS duration_ms,
               f.error
        FROM sync_runs r LEFT JOIN (
            SELECT sync_run_id, count(*) AS n, max(completed_at) AS at, arg_min(error, (completed_at, id)) AS error
            FROM sync_run_steps WHERE status = 'failed' GROUP BY sync_run_id) f ON f.sync_run_id = r.id""",
    "runner_summary": f"""
        SELECT CAST(created_at AS DATE) AS invocation, count(*) AS total_connections,
               count(*) FILTER (WHERE status = 'completed') AS succeeded, count(*) FILTER (WHERE status = 'failed') AS failed,
               CAST({micros('max(completed_at)', 'min(started_at)')} // 1000 AS BIGINT) AS duration_ms
        FROM sync_runs GROUP BY 1""",
    # warehouse
    **{t: columns_of(t) for t in ("dim_tenant", "dim_contact", "dim_account", "fact_invoice", "fact_invoice_line",
                                  "fact_bank_transaction", "fact_manual_journal")},
    "fact_payment": "SELECT * EXCLUDE (invoice_id, account_id) FROM fact_payment",
    "warehouse_refresh": f"SELECT * FROM ({UPSERT_PARTS}) u UNION ALL SELECT 'total', CAST(sum(upserted) AS BIGINT) FROM ({UPSERT_PARTS}) v",
    "warehouse_refresh_counts": f"SELECT * FROM ({UPSERT_PARTS}) u UNION ALL SELECT 'total', CAST(sum(upserted) AS BIGINT) FROM ({UPSERT_PARTS}) v",
    # reports
    "report_amount_parse": """
        SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN p WHEN 1 THEN -p WHEN 2 THEN p
               WHEN 5 THEN CAST(o_orderkey AS DECIMAL(15,2)) END AS amount
        FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(15,2)) AS p FROM orders)""",
    "report_trial_balance": columns_of("fact_trial_balance"),
    "report_profit_and_loss": columns_of("fact_profit_and_loss"),
    "report_balance_sheet": columns_of("fact_balance_sheet"),
    # statements
    "statement_field_pick": """
        SELECT batch_id, tenant_id, row_index, nullif(date_cell, '') AS date_text, description,
               CASE style WHEN 0 THEN CAST(whole AS VARCHAR) WHEN 1 THEN '£' || whole || '.50' WHEN 4 THEN '-' || whole WHEN 5 THEN 'n/a' END AS amount_text,
               CASE WHEN style IN (2, 5) THEN CAST(whole AS VARCHAR) END AS debit_text,
               CASE WHEN style = 3 THEN CAST(whole AS VARCHAR) END AS credit_text,
               CASE WHEN style = 0 THEN 'R' || event_id END AS reference FROM uploaded""",
    "statement_date_parse": "SELECT batch_id, row_index, date FROM parsed_rows",
    "statement_amount_parse": "SELECT batch_id, row_index, amount FROM parsed_rows",
    "statement_row_errors": "SELECT batch_id, tenant_id, row_index, error FROM checked_rows WHERE error IS NOT NULL",
    "statement_dedup_hash": f"""
        SELECT event_id, md5((user_id % 5) || '|' || strftime(ts, '%Y-%m-%d') || '|' || event_type || '|' || {plain('CAST(value AS DECIMAL(15,2))')}) AS dedup_hash
        FROM events""",
    "statement_normalise": """
        SELECT batch_id, tenant_id, row_index, date, description, amount, reference, 'GBP' AS currency_code, dedup_hash
        FROM checked_rows WHERE error IS NULL""",
    "statement_dedup": """
        SELECT id, tenant_id, batch_id, row_index, date, description, amount, reference, 'GBP' AS currency_code, dedup_hash FROM new_lines""",
    "statement_batch_summary": """
        SELECT b.*, created_at + INTERVAL '90 seconds' AS completed_at, coalesce(n.inserted, 0) AS inserted FROM batch_results b
        LEFT JOIN (SELECT batch_id, count(*) AS inserted FROM new_lines GROUP BY batch_id) n ON n.batch_id = b.batch_id""",
    # views
    "view_overdue_invoices": columns_of("overdue_view"),
    "view_invoice_ageing": columns_of("ageing_view"),
    "view_payment_history": columns_of("payment_view"),
    "view_profit_and_loss": columns_of("pnl_view"),
    "view_balance_sheet": """
        SELECT f.id, tenant_id, t.name AS tenant_name, snapshot_id, period_date, strftime(period_date, '%b %Y') AS period_label,
               section, sub_section, account_source_id, account_name, value, row_type, row_order
        FROM fact_balance_sheet f JOIN dim_tenant t ON t.id = f.tenant_id""",
    "view_trial_balance": columns_of("trial_view"),
    "ops_tenant_freshness": columns_of("freshness_view"),
    "ops_run_summary": columns_of("run_summary"),
    "ops_dashboard_metrics": f"""
        SELECT (SELECT count(*) FROM tenants) AS total_tenants, (SELECT count(*) FROM tenants WHERE is_active) AS active_tenants,
               (SELECT count(*) FROM connections) AS total_connections, (SELECT count(*) FROM connections WHERE is_active) AS active_connections,
               (SELECT count(*) FROM connections WHERE is_active AND id NOT IN (SELECT connection_id FROM sync_runs
                    WHERE status = 'completed' AND completed_at > {RUN_CLOCK} - INTERVAL '25 hours')) AS stale_connections,
               (SELECT count(*) FROM sync_runs WHERE created_at > {RUN_CLOCK} - INTERVAL '24 hours') AS syncs_last_24h,
               (SELECT count(*) FROM sync_runs WHERE status = 'failed' AND created_at > {RUN_CLOCK} - INTERVAL '24 hours') AS failed_syncs_last_24h,
               (SELECT count(*) FROM sync_runs WHERE status = 'running') AS syncs_currently_running,
               (SELECT count(*) FROM raw_invoices) AS total_invoices, (SELECT count(*) FROM raw_payments) AS total_payments,
               (SELECT count(*) FROM raw_bank_transactions) AS total_bank_transactions, (SELECT count(*) FROM raw_contacts) AS total_contacts,
               (SELECT count(*) FROM upload_batches WHERE status IN ('pending', 'processing')) AS pending_uploads,
               (SELECT count(*) FROM upload_batches WHERE status = 'failed' AND created_at > {RUN_CLOCK} - INTERVAL '24 hours') AS failed_uploads_last_24h,
               (SELECT count(*) FROM upload_batches WHERE status = 'completed' AND created_at > {RUN_CLOCK} - INTERVAL '7 days') AS completed_uploads_last_7d,
               {RUN_CLOCK} AS generated_at""",
    "admin_tenants": """
        SELECT f.tenant_id, tenant_name, tenant_is_active, connection_id, org_name, connection_is_active,
               CASE WHEN bool_or(freshness_status = 'never_synced') THEN 'never_synced' WHEN bool_or(freshness_status = 'stale') THEN 'stale'
                    WHEN bool_or(freshness_status = 'recent') THEN 'recent' ELSE 'fresh' END AS freshness_status,
               max(last_modified_at) AS last_synced_at, min(hours_since_sync) AS min_hours_since_sync,
               max(hours_since_sync) AS max_hours_since_sync, last_run_status, last_run_started_at, last_run_completed_at,
               last_run_duration_ms, last_run_error, coalesce(any_value(i.n), 0) AS invoice_count,
               coalesce(any_value(p.n), 0) AS payment_count, coalesce(any_value(c.n), 0) AS contact_count
        FROM freshness_view f
        LEFT JOIN (SELECT tenant_id, count(*) AS n FROM raw_invoices GROUP BY 1) i ON i.tenant_id = f.tenant_id
        LEFT JOIN (SELECT tenant_id, count(*) AS n FROM raw_payments GROUP BY 1) p ON p.tenant_id = f.tenant_id
        LEFT JOIN (SELECT tenant_id, count(*) AS n FROM raw_contacts GROUP BY 1) c ON c.tenant_id = f.tenant_id
        GROUP BY f.tenant_id, tenant_name, tenant_is_active, connection_id, org_name, connection_is_active, last_run_status,
                 last_run_started_at, last_run_completed_at, last_run_duration_ms, last_run_error""",
    "admin_run_history": f"SELECT * FROM run_summary WHERE status = 'failed' AND tenant_id = {TENANT} ORDER BY created_at DESC, id DESC LIMIT 500",
    "admin_run_detail": f"""
        SELECT r.*, s.* EXCLUDE (sync_run_id), {millis('step_completed_at', 'step_started_at')} AS step_duration_ms
        FROM run_summary r {STEP_JOIN.format(extra='')} WHERE r.id = '2'""",
    "admin_stale_entities": """
        SELECT tenant_id, tenant_name, connection_id, org_name, entity, last_modified_at, hours_since_sync, freshness_status,
               last_run_status, last_run_completed_at, last_run_error
        FROM freshness_view WHERE freshness_status IN ('stale', 'never_synced')""",
    "admin_uploads": f"""
        SELECT b.id, b.tenant_id, t.name AS tenant_name, filename, file_size_bytes, row_count, status, error, b.created_at, completed_at,
               {millis('completed_at', 'b.created_at')} AS duration_ms, coalesce(total_lines, 0) AS total_lines,
               coalesce(approved_lines, 0) AS approved_lines, coalesce(pending_lines, 0) AS pending_lines
        FROM upload_batches b JOIN tenants t ON t.id = b.tenant_id LEFT JOIN (
            SELECT batch_id, count(*) AS total_lines, count(*) FILTER (WHERE approved) AS approved_lines,
                   count(*) FILTER (WHERE NOT approved) AS pending_lines FROM statement_lines GROUP BY batch_id) l ON l.batch_id = b.id
        ORDER BY b.created_at DESC, b.id DESC LIMIT 50""",
    "admin_errors": f"""
        SELECT * FROM (
            SELECT 'sync_run' AS source, r.id, t.name AS tenant_name, org_name, status, error, triggered_by AS context, r.created_at
            FROM sync_runs r JOIN connections c ON c.id = r.connection_id JOIN tenants t ON t.id = r.tenant_id
            UNION ALL
            SELECT 'sync_step', s.id, t.name, org_name, s.status, s.error, s.entity, s.created_at
            FROM sync_run_steps s JOIN sync_runs r ON r.id = s.sync_run_id JOIN connections c ON c.id = r.connection_id
            JOIN tenants t ON t.id = r.tenant_id
            UNION ALL
            SELECT 'upload', b.id, t.name, NULL, status, error, filename, b.created_at
            FROM upload_batches b JOIN tenants t ON t.id = b.tenant_id)
        WHERE status = 'failed' AND created_at > {RUN_CLOCK} - INTERVAL '500 hours'
        ORDER BY created_at DESC, source DESC, id DESC LIMIT 500""",
    "connections_last_run": """
        SELECT c.id, t.name AS tenant_name, org_name, c.is_active, r.id AS last_run_id, r.status AS last_run_status,
               r.completed_at AS last_run_at, r.duration_ms AS last_run_duration_ms, k.last_modified_at AS last_synced_at,
               coalesce(i.n, 0) AS invoice_count
        FROM connections c JOIN tenants t ON t.id = c.tenant_id
        LEFT JOIN (SELECT * FROM sync_runs QUALIFY row_number() OVER (PARTITION BY connection_id ORDER BY created_at DESC, id DESC) = 1) r
            ON r.connection_id = c.id
        LEFT JOIN sync_checkpoints k ON k.connection_id = c.id AND k.entity = 'invoices'
        LEFT JOIN (SELECT connection_id, count(*) AS n FROM raw_invoices GROUP BY 1) i ON i.connection_id = c.id""",
    "recent_runs": """
        SELECT r.id, r.status, triggered_by, started_at, completed_at, duration_ms, error, org_name, t.name AS tenant_name
        FROM sync_runs r JOIN connections c ON c.id = r.connection_id JOIN tenants t ON t.id = r.tenant_id
        ORDER BY r.created_at DESC, r.id DESC LIMIT 50""",
    "run_with_steps": f"""
        SELECT r.*, org_name, t.name AS tenant_name, s.* EXCLUDE (sync_run_id)
        FROM sync_runs r JOIN connections c ON c.id = r.connection_id JOIN tenants t ON t.id = r.tenant_id
        {STEP_JOIN.format(extra='')} WHERE r.id = '2'""",
    "connection_registry": """
        SELECT c.id, t.name AS tenant_name, source_org_id, org_name, org_type, c.is_active, c.created_at
        FROM connections c JOIN tenants t ON t.id = c.tenant_id""",
    "batch_lines": "SELECT * EXCLUDE (batch_id, row_index, approved_by, updated_at) FROM statement_lines WHERE batch_id = 'B03'",
    "doc_aged_debt": f"SELECT invoice_number, contact_name, amount_due, days_overdue, due_date FROM overdue_view WHERE tenant_id = {TENANT} AND type = 'ACCREC'",
    "doc_ageing_summary": f"""
        SELECT ageing_bucket, count(*) AS invoice_count, CAST(sum(amount_due) AS DECIMAL(18,2)) AS total_due
        FROM ageing_view WHERE tenant_id = {TENANT} AND type = 'ACCREC' GROUP BY ageing_bucket""",
    "doc_pnl_month": f"SELECT section, account_name, value, row_type FROM pnl_view WHERE tenant_id = {TENANT} AND period_to = DATE '1998-03-31'",
    "doc_pnl_pivot": f"""
        SELECT account_name, max(CASE WHEN period_label = 'Jan 1998' THEN value END) AS jan_98,
               max(CASE WHEN period_label = 'Feb 1998' THEN value END) AS feb_98, max(CASE WHEN period_label = 'Mar 1998' THEN value END) AS mar_98
        FROM pnl_view WHERE tenant_id = {TENANT} AND row_type = 'row' GROUP BY account_name""",
    "doc_trial_balance_date": f"""
        SELECT account_name, debit, credit, ytd_debit, ytd_credit FROM trial_view
        WHERE tenant_id = {TENANT} AND period_date = DATE '1998-03-31' AND row_type = 'row'""",
    "doc_payments_between": f"""
        SELECT payment_date, amount, contact_name, account_code, account_name, reference FROM payment_view
        WHERE tenant_id = {TENANT} AND payment_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    "doc_freshness_tenant": f"SELECT entity, last_modified_at, freshness_status FROM freshness_view WHERE tenant_id = {TENANT}",
    "doc_uncoded_lines": f"SELECT id, date, description, amount, currency_code FROM statement_lines WHERE tenant_id = {TENANT} AND NOT approved",
    "scalar_functions": f"""
        SELECT o_orderkey, lower(regexp_replace(o_orderpriority || ' / ' || o_orderstatus, '[^a-zA-Z0-9]+', '-', 'g')) AS slug,
               CAST(o_orderkey + 0.5 AS DECIMAL(18,2)) AS prefix_number, {plain('CAST(o_totalprice AS DECIMAL(15,2))')} AS plain_number,
               o_orderpriority AS trimmed, strftime(o_orderdate, '%b %Y') AS period_label,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
               CAST(greatest(0, {AS_OF} - due) AS INTEGER) AS days_late,
               CAST(CASE WHEN due < {AS_OF} THEN {AS_OF} - due END AS INTEGER) AS days_overdue,
               {hours(RUN_CLOCK, 'o_orderdate')} AS hours_since,
               CAST({micros(RUN_CLOCK, 'o_orderdate')} / 1000.0 AS DECIMAL(18,2)) AS millis_since,
               {freshness('o_orderdate', RUN_CLOCK)} AS freshness, {key('orders', 'o_orderkey')} AS surrogate,
               CAST(abs(CAST(o_totalprice AS DECIMAL(15,2)) - 100000) AS DECIMAL(16,2)) AS distance,
               lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS padded
        FROM (SELECT *, CAST(o_orderdate AS DATE) + 30 AS due FROM orders)""",
    # quality
    "quality_constraint_violations": union([
        rule("sync_runs", "status_known", "status NOT IN ('pending', 'running', 'completed', 'failed')"),
        rule("sync_runs", "trigger_known", "triggered_by NOT IN ('manual', 'scheduled', 'webhook')"),
        rule("sync_runs", "connection_present", "connection_id IS NULL"),
        rule("sync_run_steps", "status_known", "status NOT IN ('pending', 'running', 'completed', 'failed', 'skipped')"),
        rule("sync_run_steps", "run_present", "sync_run_id IS NULL"),
        rule("raw_invoices", "status_present", "status IS NULL"),
        rule("raw_invoices", "type_present", "type IS NULL"),
        rule("raw_invoices", "due_date_present", "due_date IS NULL"),
        rule("raw_accounts", "enable_payments_present", "enable_payments IS NULL"),
        rule("raw_accounts", "name_present", "name IS NULL"),
        rule("report_snapshots", "type_known", "report_type NOT IN ('trial_balance', 'profit_and_loss', 'balance_sheet')", "snapshots"),
        rule("report_rows", "row_type_known", "level NOT IN (0, 1)"),
        rule("client_metadata", "fiscal_month_in_year", "fiscal_year_end_month NOT BETWEEN 1 AND 12", "client_meta"),
        rule("upload_batches", "status_known", "status NOT IN ('pending', 'processing', 'completed', 'failed')"),
        *[rule(t, f"{c}_given", f"{c} IS NULL") for t, columns in REQUIRED.items() for c in columns],
    ]),
    "quality_foreign_keys": union([
        orphan(f"{child}.{fk}", {"client_metadata": "client_meta"}.get(child, child), f"c.{fk}",
               {"report_snapshots": "snapshots"}.get(parent, parent), "p.snapshot_id" if parent == "report_snapshots" else f"p.{pk}") for child, fk, parent, pk in FOREIGN_KEYS
    ]),
    "quality_orphans": union([
        orphan("connections.tenant_id", "connections", "c.tenant_id", "tenants", "p.id"),
        orphan("sync_runs.connection_id", "sync_runs", "c.connection_id", "connections", "p.id"),
        orphan("sync_run_steps.sync_run_id", "sync_run_steps", "c.sync_run_id", "sync_runs", "p.id"),
        orphan("raw_payments.invoice_id", "raw_payments", "c.invoice_id", "raw_invoices", "p.source_id"),
        orphan("raw_invoices.contact", "raw_invoices", "(c.tenant_id || '|' || c.contact_id)", "raw_contacts", "(p.tenant_id || '|' || p.source_id)"),
        orphan("raw_payments.account_id", "raw_payments", "c.account_id", "raw_accounts", "p.source_id"),
    ]),
    "quality_duplicate_keys": union([
        duplicates("tenants", "slug"), duplicates("connections", "source_org_id"),
        duplicates("sync_checkpoints", "connection_id, entity"), duplicates("raw_contacts", MERGED),
        duplicates("raw_accounts", MERGED), duplicates("raw_invoices", MERGED),
        duplicates("raw_invoice_lines", "connection_id, source_invoice_id, source_id"), duplicates("raw_payments", MERGED),
        duplicates("raw_bank_transactions", MERGED), duplicates("raw_manual_journals", MERGED),
        duplicates("report_snapshots", "connection_id, report_type, period_date", "snapshots"),
        *[duplicates(t, "tenant_id, source_id") for t in ("dim_contact", "dim_account", "fact_invoice", "fact_payment",
                                                          "fact_bank_transaction", "fact_manual_journal")],
        duplicates("fact_invoice_line", "tenant_id, source_invoice_id, source_id"),
        *[duplicates(t, "snapshot_id, row_order") for t in ("fact_trial_balance", "fact_profit_and_loss", "fact_balance_sheet")],
        duplicates("uploaded_rows", "batch_id, row_index", "uploaded"), duplicates("statement_lines", "tenant_id, dedup_hash"),
        duplicates("delivered_lines", "l_orderkey, l_linenumber", "lineitem"),
        duplicates("account_codes", "tenant_id, code", "raw_accounts"),
    ]),
    "quality_run_lifecycle": union([
        lifecycle("completed_run_without_duration", "sync_runs", "status = 'completed' AND duration_ms IS NULL"),
        lifecycle("failed_run_without_error", "sync_runs", "status = 'failed' AND error IS NULL"),
        lifecycle("completed_invoice_step_without_records", "sync_run_steps", "entity = 'invoices' AND status = 'completed' AND records_synced <= 0"),
        lifecycle("cursor_in_future", "sync_checkpoints", f"last_modified_at > {CURSOR_CLOCK}"),
    ]),
    "quality_unresolved_lookups": union([
        lookups_row("fact_invoice.contact", "(SELECT f.*, contact_id FROM fact_invoice f JOIN raw_invoices r USING (tenant_id, source_id))",
                    "contact_id", "dim_contact_id"),
        *[lookups_row(f"fact_bank_transaction.{what}", "(SELECT f.*, contact_id, bank_account_id FROM fact_bank_transaction f "
                      "JOIN raw_bank_transactions r USING (tenant_id, source_id))", natural, resolved)
          for what, natural, resolved in (("contact", "contact_id", "dim_contact_id"), ("account", "bank_account_id", "dim_account_id"))],
        lookups_row("fact_invoice_line.account", "fact_invoice_line", "account_code", "dim_account_id"),
        lookups_row("fact_invoice_line.invoice", "fact_invoice_line", "source_invoice_id", "fact_invoice_id"),
        lookups_row("fact_payment.invoice", "fact_payment", "invoice_id", "fact_invoice_id"),
        lookups_row("fact_payment.account", "fact_payment", "account_id", "dim_account_id"),
    ]),
    # streaming: the same result as one batch
    "stream_incremental_merge": """
        SELECT connection_id, CASE WHEN even THEN 'first' ELSE tenant_id END AS tenant_id, source_id, amount, status, reference, source_updated_at
        FROM (SELECT *, CAST(substr(source_id, 2) AS BIGINT) % 2 = 0 AS even FROM raw_payments)""",
    "stream_statement_dedup": """
        SELECT * FROM streamed_lines
        QUALIFY row_number() OVER (PARTITION BY tenant_id, dedup_hash ORDER BY CASE WHEN description <> 'click' THEN row_index % 3 END NULLS FIRST,
                                   batch_id, row_index) = 1""",
}

# the same changes, found another way
QUERIES["incremental_changes_pruned"] = QUERIES["incremental_changes"]

ORACLE_SQL: dict[str, str] = {name: sql(text) for name, text in QUERIES.items()}

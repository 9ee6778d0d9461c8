"""Ledger-shaped inputs derived from the trade and event tables of the test data.

Every shape is a lazy DataFrame over whole tables; see README for the mapping.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.dates import date_literal, format_wire_date, ts_literal
from ledgerloom.functions.text import slugify
from ledgerloom.operators import reports, star, statements
from ledgerloom.operators.merge import apply_line_edits, pick_winner
from ledgerloom.session import scratch_dir
from ledgerloom.sources import uploads
from ledgerloom.sources.lookups import business_types

AS_OF = "2001-06-30"
RUN_CLOCK = "2001-08-01 12:00:00"
CURSOR_CLOCK = "2024-01-31 00:00:00"
LOADED_AT = "2024-02-01 00:00:00"
NEVER_SYNCED = (3, 17)
ROW_BLOCK = 65536
MONEY = "cast({} AS decimal(15,2))"


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _mod(column: str, n: int) -> Column:
    return F.pmod(F.col(column), F.lit(n))


def _money(c: Column) -> Column:
    return c.cast("decimal(15,2)")


def _after(ts: Column, days: Column | None = None, seconds: Column | None = None) -> Column:
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero if days is None else days.cast("int"), zero, zero,
                                   zero if seconds is None else seconds.cast("decimal(18,6)"))


class Ledger:
    """Lazily bound ledger tables over one folder of test data."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.as_of = date_literal(AS_OF)
        self.run_clock = ts_literal(RUN_CLOCK)
        self.cursor_clock = ts_literal(CURSOR_CLOCK)
        self.loaded_at = ts_literal(LOADED_AT)
        self._scans: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._scans[name]

    def keep(self, *names: str) -> None:
        """Write tables that a query reads more than once; all that is bound later reads them from there.

        To be called before anything derived from them is bound, in order of dependency.
        """
        for name in names:
            rows, path = getattr(self, name), f"{scratch_dir(self.spark, 'kept')}/{name}"
            rows.write.parquet(path)
            self.__dict__[name] = self.spark.read.schema(rows.schema).parquet(path)

    # ── organisations ────────────────────────────────────────────────────────
    @cached_property
    def tenants(self) -> DataFrame:
        day = _after(ts_literal("1995-01-01 00:00:00"), days=F.col("r_regionkey"))
        return self.read("region").select(
            _text("r_regionkey").alias("id"), F.col("r_name").alias("name"), slugify(F.col("r_name")).alias("slug"),
            (F.col("r_regionkey") != 4).alias("is_active"), day.alias("created_at"), day.alias("updated_at"),
        )

    @cached_property
    def connections(self) -> DataFrame:
        day = _after(ts_literal("1995-01-01 00:00:00"), days=F.col("n_nationkey"))
        return self.read("nation").select(
            _text("n_nationkey").alias("id"), _text("n_regionkey").alias("tenant_id"),
            F.concat(F.lit("ORG-"), _text("n_nationkey")).alias("source_org_id"), F.col("n_name").alias("org_name"),
            F.lit("ORGANISATION").alias("org_type"), (_mod("n_nationkey", 7) != 0).alias("is_active"),
            day.alias("created_at"), day.alias("updated_at"),
        )

    @cached_property
    def _nation_tenant(self) -> DataFrame:
        return self.read("nation").select("n_nationkey", "n_regionkey")

    @cached_property
    def _lead_connection(self) -> DataFrame:
        """First connection of each tenant."""
        return self._nation_tenant.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("n_nationkey"))

    def _with_tenant(self, df: DataFrame, nation: str) -> DataFrame:
        return df.join(self._nation_tenant, F.expr(f"{nation} = n_nationkey"), "inner").selectExpr(
            "*", "string(n_nationkey) AS connection_id", "string(n_regionkey) AS tenant_id")

    # ── contacts and accounts ────────────────────────────────────────────────
    @cached_property
    def raw_contacts(self) -> DataFrame:
        def shape(table: str, prefix: str, key: str, name: str, nation: str, balance: str, supplier: bool) -> DataFrame:
            return self._with_tenant(self.read(table), nation).selectExpr(
                "connection_id", "tenant_id", f"concat('{prefix}', string({key})) AS source_id", f"{name} AS name",
                f"if({key} % 3 = 0, '{table}', null) AS first_name", f"if({key} % 3 = 0, string({key}), null) AS last_name",
                f"if({key} % 5 <> 0, concat(lower(replace({name}, '#', '.')), '@example.com'), null) AS email_address",
                f"if({balance} < 0, 'ARCHIVED', 'ACTIVE') AS contact_status",
                f"{supplier} AS is_supplier", f"{not supplier} AS is_customer",
                f"if({key} % 4 = 0, concat('TX', string({key})), null) AS tax_number",
                f"if({key} % 7 = 0, 'EUR', 'GBP') AS default_currency",
                f"TIMESTAMP_NTZ'2001-06-01 00:00:00' + make_dt_interval(int({key} % 28)) AS source_updated_at",
            )

        return shape("customer", "C", "c_custkey", "c_name", "c_nationkey", "c_acctbal", False).unionByName(
            shape("supplier", "S", "s_suppkey", "s_name", "s_nationkey", "s_acctbal", True))

    @cached_property
    def raw_accounts(self) -> DataFrame:
        rows = self.read("part").join(self._lead_connection, F.expr("p_partkey % 5 = n_regionkey"), "inner")
        return rows.selectExpr(
            "string(n_nationkey) AS connection_id", "string(n_regionkey) AS tenant_id", "string(p_partkey) AS source_id",
            "p_brand AS code", "p_name AS name", "if(p_size % 10 = 0, 'BANK', p_type) AS type",
            "if(p_partkey % 17 = 0, 'ARCHIVED', 'ACTIVE') AS status", "p_type AS class",
            "if(p_partkey % 3 <> 0, concat(p_name, ' account'), null) AS description",
            "if(p_partkey % 2 = 0, 'NONE', 'TAX20') AS tax_type", "if(p_size = 1, 'DEBTORS', null) AS system_account",
            "if(p_partkey % 23 <> 0, p_size % 2 = 0, null) AS enable_payments",
            "TIMESTAMP_NTZ'2001-06-01 00:00:00' + make_dt_interval(int(p_partkey % 28)) AS source_updated_at",
        )

    # ── invoices ─────────────────────────────────────────────────────────────
    @cached_property
    def _orders(self) -> DataFrame:
        """Orders with the connection and tenant of their customer."""
        customers = self.read("customer").select("c_custkey", "c_name", "c_nationkey")
        owned = self.read("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "inner")
        return self._with_tenant(owned, "c_nationkey")

    @cached_property
    def raw_invoices(self) -> DataFrame:
        amounts = self._orders.selectExpr("*", f"{MONEY.format('o_totalprice')} AS total").selectExpr(
            "*", f"{MONEY.format('total * 0.2BD')} AS tax")
        nothing = MONEY.format("0")
        return amounts.selectExpr(
            "connection_id", "tenant_id", "string(o_orderkey) AS source_id",
            "concat('INV-', lpad(string(o_orderkey), 10, '0')) AS invoice_number",
            "if(o_orderkey % 3 = 0, 'ACCPAY', 'ACCREC') AS type",
            """CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'AUTHORISED' ELSE
               CASE o_orderpriority WHEN '1-URGENT' THEN 'VOIDED' WHEN '2-HIGH' THEN 'DELETED' WHEN '5-LOW' THEN 'DRAFT'
               ELSE 'SUBMITTED' END END AS status""",
            "concat(if(o_orderkey % 11 = 0, 'X', 'C'), string(o_custkey)) AS contact_id", "c_name AS contact_name",
            "date(o_orderdate) AS date", "if(o_orderkey % 13 <> 0, date_add(date(o_orderdate), 30), null) AS due_date",
            f"if(o_orderstatus = 'F', {nothing}, total) AS amount_due", f"if(o_orderstatus = 'F', total, {nothing}) AS amount_paid",
            f"if(o_orderkey % 4 <> 0, {nothing}, null) AS amount_credited",
            f"{MONEY.format('total - tax')} AS subtotal", "tax AS total_tax", "total",
            "if(o_orderkey % 7 = 0, 'EUR', 'GBP') AS currency_code",
            "if(o_orderkey % 9 <> 0, cast(if(o_orderkey % 7 = 0, '1.15', '1') AS decimal(20,10)), null) AS currency_rate",
            "o_orderpriority AS reference", "o_orderdate + INTERVAL '1' HOUR AS source_updated_at",
        )

    LINE_KEY = ("l_orderkey", "l_linenumber")
    LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")

    @cached_property
    def _lines(self) -> DataFrame:
        """Latest delivery per (order, line number); the table holds repeats."""
        return pick_winner(self.read("lineitem"), self.LINE_KEY, [F.desc(c) for c in self.LINE_ORDER])

    LINE_COLUMNS = (
        "string(l_orderkey) AS source_invoice_id", "string(l_linenumber) AS source_id",
        "if(l_linenumber % 4 <> 0, concat('Part ', string(l_partkey)), null) AS description",
        "cast(l_quantity AS decimal(20,6)) AS quantity", "cast(l_extendedprice AS decimal(15,4)) AS unit_amount",
        f"{MONEY.format('l_extendedprice')} AS line_amount",
        "if(l_linenumber % 6 <> 0, concat('Brand#', string(l_partkey % 25 + 1)), null) AS account_code",
        "l_returnflag AS tax_type",
        f"{MONEY.format(MONEY.format('l_extendedprice') + ' * cast(l_tax AS decimal(4,2))')} AS tax_amount",
        "string(l_partkey) AS item_code",
    )

    @cached_property
    def raw_invoice_lines(self) -> DataFrame:
        owners = self._orders.select("o_orderkey", "o_orderdate", "connection_id", "tenant_id")
        # dealt by order once, for the latest delivery and for the order
        lines = pick_winner(self.read("lineitem").repartition("l_orderkey"), self.LINE_KEY, [F.desc(c) for c in self.LINE_ORDER])
        joined = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        return joined.selectExpr("connection_id", "tenant_id", *self.LINE_COLUMNS,
                                 "o_orderdate + INTERVAL '1' HOUR AS source_updated_at")

    # ── money movements from the event table ─────────────────────────────────
    @cached_property
    def raw_payments(self) -> DataFrame:
        return self.payments_from(self.read("events"))

    def order_owners(self) -> DataFrame:
        return self._orders.select("o_orderkey", "connection_id", "tenant_id")

    def payments_from(self, events: DataFrame, owners: DataFrame | None = None) -> DataFrame:
        """Purchases as payments of the order that has the same number."""
        owners = self.order_owners() if owners is None else owners
        purchases = events.filter(F.col("event_type") == "purchase")
        rows = purchases.join(owners, F.col("event_id") == F.col("o_orderkey"), "inner")
        return rows.selectExpr(
            "connection_id", "tenant_id", "concat('P', string(event_id)) AS source_id", "date(ts) AS date",
            f"{MONEY.format('value')} AS amount", "if(event_id % 6 <> 0, concat('PAY-', string(event_id)), null) AS reference",
            "event_id % 2 = 0 AS is_reconciled", "if(event_id % 5 = 0, 'DELETED', 'AUTHORISED') AS status",
            "if(event_id % 3 = 0, 'ACCPAYPAYMENT', 'ACCRECPAYMENT') AS payment_type",
            "cast('1' AS decimal(20,10)) AS currency_rate", "if(event_id % 10 <> 0, string(event_id), null) AS invoice_id",
            "if(event_id % 10 <> 0, concat('INV-', lpad(string(event_id), 10, '0')), null) AS invoice_number",
            "string(user_id) AS account_id", "concat('Brand#', string(user_id % 25 + 1)) AS account_code",
            "cast(date_trunc('millisecond', ts) AS timestamp_ntz) AS source_updated_at",
        )

    def _events_of_connection(self, *types: str) -> DataFrame:
        events = self.read("events").filter(F.col("event_type").isin(*types))
        return self._with_tenant(events, "user_id % 25")

    @cached_property
    def raw_bank_transactions(self) -> DataFrame:
        events = self._events_of_connection("click", "view").selectExpr("*", f"{MONEY.format('value')} AS total").selectExpr(
            "*", f"{MONEY.format('total * 0.2BD')} AS tax")
        return events.selectExpr(
            "connection_id", "tenant_id", "concat('B', string(event_id)) AS source_id",
            "if(event_type = 'click', 'SPEND', 'RECEIVE') AS type", "if(event_id % 8 = 0, 'DELETED', 'AUTHORISED') AS status",
            "if(event_id % 4 <> 0, concat('BT-', string(event_id)), null) AS reference", "event_id % 3 = 0 AS is_reconciled",
            "date(ts) AS date", f"{MONEY.format('total - tax')} AS subtotal", "tax AS total_tax", "total", "'GBP' AS currency_code",
            "cast('1' AS decimal(20,10)) AS currency_rate", "string(user_id) AS bank_account_id",
            "concat('Brand#', string(user_id % 25 + 1)) AS bank_account_code",
            "concat('Account ', string(user_id)) AS bank_account_name",
            "if(event_id % 9 <> 0, concat('C', string(user_id)), null) AS contact_id",
            "if(event_id % 9 <> 0, concat('Contact ', string(user_id)), null) AS contact_name",
            "cast(date_trunc('millisecond', ts) AS timestamp_ntz) AS source_updated_at",
        )

    @cached_property
    def raw_manual_journals(self) -> DataFrame:
        return self._events_of_connection("signup").selectExpr(
            "connection_id", "tenant_id", "concat('J', string(event_id)) AS source_id",
            "concat('signup ', string(event_id)) AS narration", "date(ts) AS date",
            "if(event_id % 4 = 0, 'DRAFT', 'POSTED') AS status",
            "cast(date_trunc('millisecond', ts) AS timestamp_ntz) AS source_updated_at",
        )

    # ── warehouse ────────────────────────────────────────────────────────────
    @cached_property
    def dim_tenant(self) -> DataFrame:
        return star.dim_tenant(self.tenants, self.loaded_at)

    @cached_property
    def dim_contact(self) -> DataFrame:
        return star.dim_contact(self.raw_contacts, self.loaded_at)

    @cached_property
    def dim_account(self) -> DataFrame:
        return star.dim_account(self.raw_accounts, self.loaded_at)

    @cached_property
    def fact_invoice(self) -> DataFrame:
        return star.fact_invoice(self.raw_invoices, self.dim_contact, self.as_of, self.loaded_at)

    @cached_property
    def fact_invoice_line(self) -> DataFrame:
        return star.fact_invoice_line(self.raw_invoice_lines, self.raw_invoices, self.dim_account, self.loaded_at)

    @cached_property
    def fact_payment(self) -> DataFrame:
        return star.fact_payment(self.raw_payments, self.raw_invoices, self.dim_account, self.loaded_at)

    @cached_property
    def fact_bank_transaction(self) -> DataFrame:
        return star.fact_bank_transaction(self.raw_bank_transactions, self.dim_contact, self.dim_account, self.loaded_at)

    @cached_property
    def fact_manual_journal(self) -> DataFrame:
        return star.fact_manual_journal(self.raw_manual_journals, self.loaded_at)

    # ── run log ──────────────────────────────────────────────────────────────
    @cached_property
    def sync_runs(self) -> DataFrame:
        runs = self._with_tenant(self.read("orders"), "o_orderkey % 25")
        return runs.selectExpr(
            "string(o_orderkey) AS id", "connection_id", "tenant_id",
            "CASE o_orderstatus WHEN 'O' THEN 'completed' WHEN 'F' THEN 'failed' ELSE 'running' END AS status",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'manual' WHEN '2-HIGH' THEN 'webhook' ELSE 'scheduled' END AS triggered_by",
            "o_orderdate AS started_at",
            "if(o_orderstatus <> 'P', o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 3600), null) AS completed_at",
            "if(o_orderstatus <> 'P', int(o_orderkey % 3600 * 1000), null) AS duration_ms",
            "if(o_orderstatus = 'F', concat('sync failed: ', o_orderpriority), null) AS error", "o_orderdate AS created_at",
        )

    ENTITIES = ("invoices", "contacts", "payments", "bank_transactions", "accounts", "manual_journals", "reports")

    @cached_property
    def sync_run_steps(self) -> DataFrame:
        entities = ", ".join(f"'{e}'" for e in self.ENTITIES)
        return self._lines.selectExpr(
            "concat_ws('-', string(l_orderkey), string(l_linenumber)) AS id", "string(l_orderkey) AS sync_run_id",
            f"element_at(array({entities}), l_linenumber) AS entity",
            "CASE l_returnflag WHEN 'A' THEN 'completed' WHEN 'R' THEN 'failed' ELSE 'skipped' END AS status",
            "int(l_quantity) AS records_synced", "l_linenumber AS records_failed", "l_shipdate AS started_at",
            "if(l_returnflag <> 'N', l_shipdate + make_dt_interval(0, 0, 0, l_partkey % 600), null) AS completed_at",
            "if(l_returnflag = 'R', concat('step failed: ', string(l_suppkey)), null) AS error", "l_shipdate AS created_at",
        )

    @cached_property
    def sync_checkpoints(self) -> DataFrame:
        kind = F.col("event_type")
        entity = (
            F.when(kind == "click", "bank_transactions").when(kind == "view", "contacts").when(kind == "purchase", "payments")
            .when(kind == "signup", "manual_journals").otherwise("invoices")
        )
        number = _mod("user_id", 25 - len(NEVER_SYNCED))
        for missing in NEVER_SYNCED:
            number = number + F.when(number >= missing, 1).otherwise(0)
        events = self.read("events").select(
            _text(number).alias("connection_id"), entity.alias("entity"), "ts", "event_id")
        cursors = events.groupBy("connection_id", "entity").agg(
            F.max("ts").alias("last_modified_at"), F.max_by("event_id", "ts").alias("_run"))
        return cursors.select("connection_id", "entity", "last_modified_at", _text("_run").alias("last_run_id"))

    # ── uploaded statements ──────────────────────────────────────────────────
    @cached_property
    def statement_rows(self) -> DataFrame:
        """Events as bank-export rows; every seventh one is uploaded twice."""
        events = self.read("events")
        key = "event_id"
        base = _mod("user_id", 10)
        copies = F.when(_mod(key, 7) == 0, F.array(base, base + 10)).otherwise(F.array(base))
        rows = events.withColumn("_batch", F.explode(copies))
        rows = rows.select(
            F.concat(F.lit("B"), F.lpad(_text("_batch"), 2, "0")).alias("batch_id"),
            _text(_mod("_batch", 5)).alias("tenant_id"), self._export_row().alias("raw"), key,
        )
        return uploads.number_rows(rows, ["batch_id", "tenant_id"], F.floor(F.col(key) / ROW_BLOCK), F.col(key)).drop(key)

    # Header and cell spellings of six bank exports: date header, date pattern, text header, amount cells.
    EXPORTS = (
        ("Date", "yyyy-MM-dd", "Description", "'Amount', n, 'Reference', concat('R', event_id)"),
        ("Transaction Date", "dd/MM/yyyy", "Details", "'Amount', concat('£', n, '.50')"),
        ("Posting Date", "dd-MM-yyyy", "Narrative", "'Debit', n, 'Credit', ''"),
        (" date ", "dd MMM yyyy", "Memo", "'Debit', '', 'Credit', n"),
        ("TransactionDate", "yyyy-MM-dd HH:mm", "Particulars", "'amount', concat('-', n)"),
        ("PostingDate", "d/M/yyyy HH:mm", "Transaction Description", "'Amount', 'n/a', 'Debit', n"),
    )

    def _export_row(self) -> Column:
        """Cells of a statement row; some dates are broken and some descriptions are missing."""
        arms = []
        for style, (date_header, pattern, text_header, amounts) in enumerate(self.EXPORTS):
            day = f"""CASE WHEN _batch = 19 THEN 'soon'
                WHEN event_id % 17 = 0 THEN element_at(array('', '31/02/2024', 'soon'), cast(event_id % 3 as int) + 1)
                ELSE date_format(ts, "{pattern}") END"""
            cells = f"'{date_header}', {day}, {amounts}".replace(" n,", " cast(floor(value) as string),").replace(
                ", n", ", cast(floor(value) as string)")
            arms.append(f"""WHEN event_id % 6 = {style} THEN if(event_id % 19 = 0, map({cells}),
                map({cells}, '{text_header}', event_type))""")
        return F.expr(f"CASE {' '.join(arms)} END")

    def _batch_time(self, id_column: str) -> Column:
        number = F.substring(id_column, 2, 2).cast("int")
        return ts_literal("2001-08-01 10:00:00") - F.make_dt_interval(F.lit(0), number * 5)

    @cached_property
    def batch_headers(self) -> DataFrame:
        return uploads.batch_headers(self.statement_rows, self._batch_time("batch_id"),
                                     F.concat(F.lit("statement_"), F.col("batch_id"), F.lit(".csv")))

    @cached_property
    def normalised_rows(self) -> DataFrame:
        return statements.normalise(self.statement_rows)

    @cached_property
    def new_lines(self) -> DataFrame:
        """Deduplicated statement lines before any coding."""
        lines = statements.to_lines(statements.good_rows(self.normalised_rows), self.loaded_at)
        return statements.dedup(lines)

    @cached_property
    def batch_results(self) -> DataFrame:
        done = F.col("created_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1), F.lit(30).cast("decimal(18,6)"))
        return statements.batch_summary(self.normalised_rows, self.batch_headers, done)

    @cached_property
    def upload_batches(self) -> DataFrame:
        """Processed batches, except that the two newest copies are still open."""
        open_status = F.when(F.col("batch_id") == "B17", "pending").when(F.col("batch_id") == "B18", "processing")
        return self.batch_results.select(
            F.col("batch_id").alias("id"), "tenant_id", "filename", (F.col("row_count") * 64).alias("file_size_bytes"),
            "row_count", F.coalesce(open_status, F.col("status")).alias("status"), "error", "created_at",
            F.when(open_status.isNull(), F.col("completed_at")).alias("completed_at"),
        )

    @cached_property
    def line_edits(self) -> DataFrame:
        """Every third row of a batch is coded, every sixth approved."""
        approved = F.when(_mod("row_index", 6) == 0, F.lit(True))
        return self.new_lines.filter(_mod("row_index", 3) == 0).select(
            "id", F.lit("400").alias("account_code"), F.lit(None).cast("string").alias("account_name"),
            F.when(F.col("amount") < 0, "Cost").alias("category"), F.lit("NONE").alias("tax_type"),
            F.lit(None).cast("string").alias("notes"), approved.alias("approved"),
            F.when(approved, "U1").alias("approved_by"),
        )

    @cached_property
    def statement_lines(self) -> DataFrame:
        return apply_line_edits(self.new_lines, self.line_edits, self.loaded_at)

    # ── client settings ──────────────────────────────────────────────────────
    @cached_property
    def business_types(self) -> DataFrame:
        return business_types(self.spark)

    @cached_property
    def client_metadata(self) -> DataFrame:
        """Settings per customer organisation, many of them left to the defaults."""
        key = "c_custkey"
        return self.read("customer").select(
            _text(key).alias("tenant_id"), F.when(_mod(key, 4) != 0, (_mod(key, 12) + 1).cast("int")).alias("business_type_id"),
            F.when(_mod(key, 3) == 0, "EUR").alias("base_currency"),
            F.when(_mod(key, 5) == 0, (_mod(key, 14)).cast("int")).alias("fiscal_year_end_month"),
            F.when(_mod(key, 2) == 0, F.lit(True)).alias("vat_registered"),
            F.when(_mod(key, 2) == 0, "standard").alias("vat_scheme"),
            F.when(_mod(key, 6) == 0, F.lit("090")).alias("primary_bank_account"), F.lit(None).cast("string").alias("notes"),
        )

    # ── report trees ─────────────────────────────────────────────────────────
    @cached_property
    def _monthly(self) -> DataFrame:
        """Order totals per tenant, month, status and priority."""
        total = _money(F.col("o_totalprice"))
        payable = _mod("o_orderkey", 3) == 0
        nothing = _money(F.lit(0))
        month = self._orders.withColumn("as_of", F.last_day(F.col("o_orderdate").cast("date")))
        return month.groupBy("tenant_id", "as_of", "o_orderstatus", "o_orderpriority").agg(
            F.sum(total).alias("total"), F.sum(F.when(payable, nothing).otherwise(total)).alias("debit"),
            F.sum(F.when(payable, total).otherwise(nothing)).alias("credit"), F.max(total).alias("top"),
            F.min(total).alias("low"),
        )

    def report_payloads(self, report_type: str) -> DataFrame:
        """One JSON report tree per tenant and month: statuses as sections, priorities as rows."""
        lead = self._lead_connection.select(_text("n_regionkey").alias("_tenant"), _text("n_nationkey").alias("connection_id"))

        def cell(value: Column, account: Column | None = None) -> Column:
            none = F.lit(None).cast("array<struct<Id:string,Value:string>>")
            attributes = none if account is None else F.array(F.struct(F.lit("account").alias("Id"), account.alias("Value")))
            return F.struct(value.cast("string").alias("Value"), attributes.alias("Attributes"))

        def amount(name: str) -> Column:
            return cell(F.format_number(name, 2))

        def tree_row(kind: str, *cells: Column) -> Column:
            return F.struct(F.lit(kind).alias("RowType"), F.array(*cells).alias("Cells"))

        account = F.concat_ws("-", "o_orderstatus", "o_orderpriority")
        if report_type == "trial_balance":
            values = ["debit", "credit", "top", "low"]
        else:
            values = ["total"]
        detail = tree_row("Row", cell(F.col("o_orderpriority"), account), *[amount(v) for v in values])
        merged = {"debit": F.sum, "credit": F.sum, "total": F.sum, "top": F.max, "low": F.min}
        # at most 5 priorities and 3 statuses per report: the collected lists are bounded
        sections = self._monthly.groupBy("tenant_id", "as_of", "o_orderstatus").agg(
            F.array_sort(F.collect_list(F.struct("o_orderpriority", detail.alias("row")))).alias("rows"),
            *[merged[v](v).alias(v) for v in merged],
        )
        summary = tree_row("SummaryRow", cell(F.concat(F.lit("Total "), F.col("o_orderstatus"))), *[amount(v) for v in values])
        rows = F.concat(F.transform("rows", lambda r: r["row"]), F.array(summary))
        section = F.struct(F.lit("Section").alias("RowType"), F.col("o_orderstatus").alias("Title"), rows.alias("Rows"))
        if report_type == "balance_sheet":
            section = F.struct(F.lit("Section").alias("RowType"), F.concat(F.lit("Group "), F.col("o_orderstatus")).alias("Title"),
                               F.array(section).alias("Rows"))
        reports_ = sections.groupBy("tenant_id", "as_of").agg(
            F.array_sort(F.collect_list(F.struct("o_orderstatus", section.alias("section")))).alias("sections"),
            F.sum("total").alias("net"),
        )
        texts = F.transform("sections", lambda s: F.to_json(s["section"]))
        header = F.lit('{"RowType":"Header","Cells":[{"Value":"Account"},{"Value":"Amount"}]}')
        # the closing summary has no name cell, so its default name applies
        closing = F.to_json(tree_row("SummaryRow", cell(F.lit(None)), cell(F.format_number("net", 2))))
        body = F.concat_ws(",", header, F.concat_ws(",", texts), closing)
        raw = F.concat(F.lit(f'{{"ReportName":"{report_type}","Rows":['), body, F.lit("]}"))
        return reports_.join(lead, F.col("tenant_id") == F.col("_tenant"), "inner").select(
            "connection_id", "tenant_id", F.lit(report_type).alias("report_type"), "as_of", raw.alias("raw"))

    def report_snapshots(self, report_type: str) -> DataFrame:
        from ledgerloom.sources.payloads import ingest_report_snapshots

        return ingest_report_snapshots(self.report_payloads(report_type), self.loaded_at)

    @cached_property
    def fact_trial_balance(self) -> DataFrame:
        return reports.flatten_trial_balance(self.report_snapshots("trial_balance"))

    @cached_property
    def fact_profit_and_loss(self) -> DataFrame:
        return reports.flatten_profit_and_loss(self.report_snapshots("profit_and_loss"))

    @cached_property
    def fact_balance_sheet(self) -> DataFrame:
        return reports.flatten_balance_sheet(self.report_snapshots("balance_sheet"))

    # ── payloads: raw rows written back as the nested records they came from ─
    def payloads(self, entity: str) -> DataFrame:
        return getattr(self, f"_{entity}_payloads")()

    @staticmethod
    def _record(rows: DataFrame, fields: dict[str, Column]) -> DataFrame:
        record = F.struct(*[c.alias(name) for name, c in fields.items()])
        return rows.select("connection_id", "tenant_id", F.to_json(record).alias("raw"))

    @staticmethod
    def _dates(stem: str, column: str, by_text: Column) -> dict[str, Column]:
        """A date in its text variant for some records and in wire format for the others."""
        moment = F.col(column).cast("timestamp_ntz")
        return {
            f"{stem}String": F.when(by_text, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")),
            stem: F.when(~by_text, format_wire_date(moment)),
        }

    def _invoice_fields(self) -> dict[str, Column]:
        by_text = F.pmod(F.col("source_id").cast("bigint"), F.lit(2)) == 0
        return {
            "InvoiceID": F.col("source_id"), "InvoiceNumber": F.col("invoice_number"), "Type": F.col("type"),
            "Status": F.col("status"),
            "Contact": F.struct(F.col("contact_id").alias("ContactID"), F.col("contact_name").alias("Name")),
            **self._dates("Date", "date", by_text), **self._dates("DueDate", "due_date", by_text),
            "AmountDue": F.col("amount_due"), "AmountPaid": F.col("amount_paid"), "AmountCredited": F.col("amount_credited"),
            "SubTotal": F.col("subtotal"), "TotalTax": F.col("total_tax"), "Total": F.col("total"),
            "CurrencyCode": F.col("currency_code"), "CurrencyRate": F.col("currency_rate"), "Reference": F.col("reference"),
            "UpdatedDateUTC": format_wire_date(F.col("source_updated_at")),
        }

    def _invoices_payloads(self) -> DataFrame:
        return self._record(self.raw_invoices, self._invoice_fields())

    def _invoice_lines_payloads(self) -> DataFrame:
        """Invoices with every delivery of their lines nested, repeats included."""
        line = {
            "LineItemID": "source_id", "Description": "description", "Quantity": "quantity", "UnitAmount": "unit_amount",
            "AccountCode": "account_code", "TaxType": "tax_type", "TaxAmount": "tax_amount", "LineAmount": "line_amount",
            "ItemCode": "item_code",
        }
        nested = self.read("lineitem").selectExpr(*self.LINE_COLUMNS).groupBy("source_invoice_id").agg(
            F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(w) for w, c in line.items()]))).alias("items"))
        owners = self._orders.select(_text("o_orderkey").alias("source_id"), "o_orderdate", "connection_id", "tenant_id")
        rows = owners.join(nested, F.col("source_id") == F.col("source_invoice_id"), "left")
        updated = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(1))
        return self._record(rows, {"InvoiceID": F.col("source_id"), "LineItems": F.col("items"),
                                   "UpdatedDateUTC": format_wire_date(updated)})

    def _contacts_payloads(self) -> DataFrame:
        return self._record(self.raw_contacts, {
            "ContactID": F.col("source_id"), "Name": F.col("name"), "FirstName": F.col("first_name"),
            "LastName": F.col("last_name"), "EmailAddress": F.col("email_address"), "ContactStatus": F.col("contact_status"),
            "IsSupplier": F.when(F.col("is_supplier"), F.lit(True)), "IsCustomer": F.when(F.col("is_customer"), F.lit(True)),
            "TaxNumber": F.col("tax_number"), "DefaultCurrency": F.col("default_currency"),
            "UpdatedDateUTC": format_wire_date(F.col("source_updated_at")),
        })

    def _payments_payloads(self) -> DataFrame:
        return self._record(self.raw_payments, {
            "PaymentID": F.col("source_id"), **self._dates("Date", "date", F.col("is_reconciled")),
            "Amount": F.col("amount"), "Reference": F.col("reference"), "IsReconciled": F.col("is_reconciled"),
            "Status": F.col("status"), "PaymentType": F.col("payment_type"), "CurrencyRate": F.col("currency_rate"),
            "Invoice": F.struct(F.col("invoice_id").alias("InvoiceID"), F.col("invoice_number").alias("InvoiceNumber")),
            "Account": F.struct(F.col("account_id").alias("AccountID"), F.col("account_code").alias("Code")),
            "UpdatedDateUTC": format_wire_date(F.col("source_updated_at")),
        })

    def _bank_transactions_payloads(self) -> DataFrame:
        return self._record(self.raw_bank_transactions, {
            "BankTransactionID": F.col("source_id"), "Type": F.col("type"), "Status": F.col("status"),
            "Reference": F.col("reference"), "IsReconciled": F.when(F.col("is_reconciled"), F.lit(True)),
            **self._dates("Date", "date", F.col("is_reconciled")), "SubTotal": F.col("subtotal"),
            "TotalTax": F.col("total_tax"), "Total": F.col("total"), "CurrencyCode": F.col("currency_code"),
            "CurrencyRate": F.col("currency_rate"),
            "BankAccount": F.struct(F.col("bank_account_id").alias("AccountID"), F.col("bank_account_code").alias("Code"),
                                    F.col("bank_account_name").alias("Name")),
            "Contact": F.struct(F.col("contact_id").alias("ContactID"), F.col("contact_name").alias("Name")),
            "UpdatedDateUTC": format_wire_date(F.col("source_updated_at")),
        })

    def _accounts_payloads(self) -> DataFrame:
        return self._record(self.raw_accounts, {
            "AccountID": F.col("source_id"), "Code": F.col("code"), "Name": F.col("name"), "Type": F.col("type"),
            "Status": F.col("status"), "Class": F.col("class"), "Description": F.col("description"),
            "TaxType": F.col("tax_type"), "SystemAccount": F.col("system_account"),
            "EnablePaymentsToAccount": F.col("enable_payments"),
            "UpdatedDateUTC": format_wire_date(F.col("source_updated_at")),
        })

    def _manual_journals_payloads(self) -> DataFrame:
        return self._record(self.raw_manual_journals, {
            "ManualJournalID": F.col("source_id"), "Narration": F.col("narration"),
            **self._dates("Date", "date", F.col("status") == "POSTED"), "Status": F.col("status"),
            "UpdatedDateUTC": format_wire_date(F.col("source_updated_at")),
        })

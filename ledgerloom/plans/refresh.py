"""Whole-warehouse refresh: raw tables in, next version of every dimension and fact out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ledgerloom.functions.finance import days_overdue, is_overdue
from ledgerloom.operators import reports, runs, star
from ledgerloom.operators.merge import keyed_merge
from ledgerloom.schemas import MERGE_RULES
from ledgerloom.streaming import change_log

# Tables of a refresh, in dependency order.
TABLES = ("dim_tenant", "dim_contact", "dim_account", "fact_invoice", "fact_invoice_line", "fact_payment",
          "fact_bank_transaction", "fact_manual_journal", "fact_trial_balance", "fact_profit_and_loss", "fact_balance_sheet")


def refresh_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each transformed table, which a refresh upserts, and the total."""
    return runs.transform_summary(tables)


def refresh_warehouse(spark: SparkSession, raw: dict[str, DataFrame], target: str, as_of: Column, loaded_at: Column,
                      previous: str | None = None, connection_id: str | None = None,
                      counts: dict[str, int] | None = None) -> dict[str, str]:
    """Write the next warehouse version under ``target`` in dependency order; returns the paths.

    Each table is written before the facts that look it up, so a lost executor never
    recomputes more than one table. ``previous`` is the folder of the version to merge into;
    it is only read. Files are clustered by tenant and day so that readers can skip row groups.
    ``counts`` is filled with the rows of each table, counted by the jobs that write them.
    """
    paths: dict[str, str] = {}

    def store(table: str, rows: DataFrame | Callable[[star.Deal], DataFrame], sort_by: tuple[str, ...]) -> DataFrame:
        """``rows`` that take a way of dealing are dealt inside their transform, unless a merge follows it."""
        inside = callable(rows) and previous is None
        if callable(rows):
            rows = rows(lambda df: _dealt(df, sort_by) if inside else df)
        if previous is not None:
            rule = MERGE_RULES[table]
            rows = keyed_merge(spark.read.parquet(f"{previous}/{table}"), rows, rule.keys, rule.insert_only)
        paths[table] = _write(rows, f"{target}/{table}", () if inside else sort_by, counts)
        return spark.read.parquet(paths[table])

    def store_report(table: str, rows: DataFrame) -> None:
        if previous is not None:
            rows = reports.replace_snapshots(spark.read.parquet(f"{previous}/{table}"), rows)
        paths[table] = _write(rows, f"{target}/{table}", ("tenant_id", "snapshot_id"), counts)

    one = connection_id
    store("dim_tenant", star.dim_tenant(raw["tenants"], loaded_at), ("id",))
    contacts = store("dim_contact", star.dim_contact(raw["raw_contacts"], loaded_at, one), ("tenant_id",))
    accounts = store("dim_account", star.dim_account(raw["raw_accounts"], loaded_at, one), ("tenant_id",))
    dated = ("tenant_id", "date")
    invoices = store("fact_invoice", lambda deal: star.fact_invoice(
        raw["raw_invoices"], contacts, as_of, loaded_at, one, deal), dated)
    store("fact_invoice_line", lambda deal: star.fact_invoice_line(
        raw["raw_invoice_lines"], invoices, accounts, loaded_at, one, deal), ("tenant_id", "source_invoice_id"))
    store("fact_payment", lambda deal: star.fact_payment(
        raw["raw_payments"], invoices, accounts, loaded_at, one, deal), dated)
    store("fact_bank_transaction", lambda deal: star.fact_bank_transaction(
        raw["raw_bank_transactions"], contacts, accounts, loaded_at, one, deal), dated)
    store("fact_manual_journal", lambda deal: star.fact_manual_journal(raw["raw_manual_journals"], loaded_at, one, deal), dated)
    snapshots = raw.get("report_snapshots")
    if snapshots is not None:
        if one is not None:
            snapshots = snapshots.filter(snapshots["connection_id"] == one)
        of_type = lambda kind: snapshots.filter(snapshots["report_type"] == kind)
        store_report("fact_trial_balance", reports.flatten_trial_balance(of_type("trial_balance")))
        store_report("fact_profit_and_loss", reports.flatten_profit_and_loss(of_type("profit_and_loss")))
        store_report("fact_balance_sheet", reports.flatten_balance_sheet(of_type("balance_sheet")))
    return paths


def append_changes(spark: SparkSession, changed: dict[str, DataFrame], base: str, log: str, load_id: int,
                   as_of: Column, loaded_at: Column) -> None:
    """Transform only changed raw rows and append them to a change log per table.

    Costs follow the changes: base tables and logs are cut down to the keys that the changed rows
    look up before they are merged, and are never rewritten. Re-running a ``load_id`` replaces its
    own folders. Overdue flags of unchanged invoices stay as of their last load; :func:`redate_overdue`
    with the next load id brings them to a new day.
    """
    def store(table: str, rows: DataFrame) -> None:
        columns = spark.read.parquet(f"{base}/{table}")
        change_log.write_batch(rows.select(*columns.columns), f"{log}/{table}", load_id)

    def in_use(table: str, columns: dict[str, str]) -> DataFrame:
        """The keys that the changed rows of some tables look up."""
        parts = [changed[source].select("tenant_id", F.col(column).alias("source_id")) for source, column in columns.items()]
        keys = reduce(DataFrame.unionByName, parts).filter(F.col("source_id").isNotNull()).distinct()
        return read_current(spark, base, log, table, before=load_id + 1, wanted=keys)

    def accounts_of_codes() -> DataFrame:
        """Accounts with a code in use, by whichever of their versions has it."""
        codes = changed["raw_invoice_lines"].select("tenant_id", F.col("account_code").alias("code")).filter(
            F.col("code").isNotNull()).distinct()
        stored, logged = _stored(spark, base, log, "dim_account", load_id + 1)
        having = [df.select("tenant_id", "source_id", "code").join(codes, ["tenant_id", "code"], "left_semi") for df in (stored, logged)]
        keys = having[0].unionByName(having[1]).select("tenant_id", "source_id").distinct()
        return read_current(spark, base, log, "dim_account", before=load_id + 1, wanted=keys)

    store("dim_tenant", star.dim_tenant(changed["tenants"], loaded_at))
    store("dim_contact", star.dim_contact(changed["raw_contacts"], loaded_at))
    store("dim_account", star.dim_account(changed["raw_accounts"], loaded_at))
    contacts = in_use("dim_contact", {"raw_invoices": "contact_id", "raw_bank_transactions": "contact_id"})
    accounts = in_use("dim_account", {"raw_payments": "account_id", "raw_bank_transactions": "bank_account_id"})
    store("fact_invoice", star.fact_invoice(changed["raw_invoices"], contacts, as_of, loaded_at))
    invoices = in_use("fact_invoice", {"raw_invoice_lines": "source_invoice_id", "raw_payments": "invoice_id"})
    store("fact_invoice_line", star.fact_invoice_line(changed["raw_invoice_lines"], invoices, accounts_of_codes(), loaded_at))
    store("fact_payment", star.fact_payment(changed["raw_payments"], invoices, accounts, loaded_at))
    store("fact_bank_transaction", star.fact_bank_transaction(changed["raw_bank_transactions"], contacts, accounts, loaded_at))
    store("fact_manual_journal", star.fact_manual_journal(changed["raw_manual_journals"], loaded_at))


def redate_overdue(spark: SparkSession, base: str, log: str, load_id: int, last_as_of: dt.date, as_of: dt.date,
                   loaded_at: Column) -> None:
    """Log the invoices whose overdue flag is another one on ``as_of`` than on ``last_as_of``, as load ``load_id``.

    A flag can only have changed where the due date lies between the two days. Of the base only such rows are read, by
    a pushed-down range of due dates; of the log the last state of each invoice. Days overdue follow from the flag's
    day, see :func:`dated_invoices`. Running a ``load_id`` again writes the same rows.
    """
    early, late = sorted((last_as_of, as_of))
    between = (F.col("due_date") >= F.lit(early)) & (F.col("due_date") < F.lit(late))
    rule = MERGE_RULES["fact_invoice"]
    rows, changes = _stored(spark, base, log, "fact_invoice", load_id)
    # the log's rows stand for their keys whatever their base row says; what only a first write sets is merged on reading
    logged = change_log.net_changes(changes, rule.keys, rule.insert_only).select(*rows.columns)
    due = rows.filter(between).join(changes.select(*rule.keys).distinct(), list(rule.keys), "left_anti")
    open_rows = due.select(*rows.columns).unionByName(logged.filter(between))
    day = F.lit(as_of)
    flag = is_overdue(F.col("status"), F.col("due_date"), day)
    changed = open_rows.filter(~F.col("is_overdue").eqNullSafe(flag)).withColumns({
        "is_overdue": flag, "days_overdue": days_overdue(F.col("status"), F.col("due_date"), day),
        "warehouse_updated_at": loaded_at})
    change_log.write_batch(changed, f"{log}/fact_invoice", load_id)


def dated_invoices(invoices: DataFrame, as_of: dt.date) -> DataFrame:
    """Invoices whose flags are of ``as_of``, with their days overdue on that day; no other row is touched."""
    days = F.when(F.col("is_overdue"), days_overdue(F.col("status"), F.col("due_date"), F.lit(as_of)))
    return invoices.withColumn("days_overdue", days)


def _stored(spark: SparkSession, base: str, log: str, table: str, before: int | None) -> tuple[DataFrame, DataFrame]:
    """Base rows and logged changes of a table."""
    rows = spark.read.parquet(f"{base}/{table}")
    changes = change_log.read_log(spark, f"{log}/{table}", rows.schema)
    return rows, changes if before is None else changes.filter(F.col("batch_id") < before)


def read_current(spark: SparkSession, base: str, log: str, table: str, before: int | None = None,
                 wanted: DataFrame | None = None, columns: tuple[str, ...] | None = None) -> DataFrame:
    """A table with its change log merged in; optionally only the loads ``before`` an id, the keys ``wanted``, some columns.

    Nothing is written. The keys cut base and log before the merge, and so do ``columns``, to which keys are added: the
    merge moves changes whole.
    """
    rows, changes = _stored(spark, base, log, table, before)
    rule = MERGE_RULES[table]
    if columns is not None:
        columns = tuple(dict.fromkeys([*rule.keys, *columns]))
        rows, changes = rows.select(*columns), changes.select(*columns, "batch_id")
        return _merged(rows, changes, rule.keys, tuple(c for c in rule.insert_only if c in columns), wanted)
    return _merged(rows, changes, rule.keys, rule.insert_only, wanted)


def _merged(rows: DataFrame, changes: DataFrame, keys: tuple[str, ...], insert_only: tuple[str, ...],
            wanted: DataFrame | None) -> DataFrame:
    if wanted is not None:
        rows, changes = (df.join(wanted.select(*keys), list(keys), "left_semi") for df in (rows, changes))
    return change_log.current_state(rows, changes, keys, insert_only)


def _dealt(rows: DataFrame, sort_by: tuple[str, ...]) -> DataFrame:
    """In ranges of ``sort_by``: a file holds few tenants and days, and a big tenant is many files."""
    return rows.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)


def _write(rows: DataFrame, path: str, sort_by: tuple[str, ...], counts: dict[str, int] | None = None) -> str:
    """Dealt by ``sort_by``, or as the rows are where it is empty."""
    dealt = _dealt(rows, sort_by) if sort_by else rows
    written = Observation()
    # above the exchange, whose sampling would count rows once more
    dealt.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    if counts is not None:
        counts[path.rpartition("/")[2]] = written.get["rows"]
    return path

"""Operational views: freshness, run history, uploads, errors. The clock is a parameter."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.dates import hours_before, hours_between, millis_between
from ledgerloom.functions.finance import STALE_HOURS, freshness_status
from ledgerloom.operators.joins import attach
from ledgerloom.operators.merge import pick_winner
from ledgerloom.plans.views import of_tenant

Tables = Mapping[str, DataFrame]

# Usual page size and look-back of the surfaces. Callers may ask for any; no limit means all rows.
PAGE_ROWS, LOOK_BACK_HOURS = 50, 24


def newest(df: DataFrame, limit: int | None, *tie: str) -> DataFrame:
    ordered = df.orderBy(F.desc("created_at"), *[F.desc(c) for c in tie])
    return ordered if limit is None else ordered.limit(limit)


def _tenant_connections(tables: Tables, tenant_id: str | None = None) -> DataFrame:
    tenants = of_tenant(tables["tenants"], tenant_id, "id").select(
        F.col("id").alias("_tenant"), F.col("name").alias("tenant_name"), F.col("is_active").alias("tenant_is_active"))
    connections = of_tenant(tables["connections"], tenant_id).select(
        F.col("tenant_id"), F.col("id").alias("connection_id"), "org_name", F.col("is_active").alias("connection_is_active"))
    return connections.join(tenants, F.col("tenant_id") == F.col("_tenant"), "inner").drop("_tenant")


def tenant_freshness(tables: Tables, as_of: Column, tenant_id: str | None = None) -> DataFrame:
    """One row per connection and entity; a connection without cursor appears once, never synced."""
    cursors = tables["sync_checkpoints"].select(F.col("connection_id").alias("_conn"), "entity", "last_modified_at", "last_run_id")
    rows = _tenant_connections(tables, tenant_id).join(cursors, F.col("connection_id") == F.col("_conn"), "left")
    # only the runs a cursor points at: that join can broadcast the cursors and leave the log in place
    pointed_at = cursors.select(F.col("last_run_id").alias("id")).distinct()
    runs = tables["sync_runs"].join(pointed_at, "id", "left_semi").select(
        F.col("id").alias("_run"), F.col("status").alias("last_run_status"), F.col("started_at").alias("last_run_started_at"),
        F.col("completed_at").alias("last_run_completed_at"), F.col("duration_ms").alias("last_run_duration_ms"),
        F.col("error").alias("last_run_error"))
    rows = rows.join(runs, F.col("last_run_id") == F.col("_run"), "left")
    return rows.select(
        "tenant_id", "tenant_name", "tenant_is_active", "connection_id", "org_name", "connection_is_active",
        "entity", "last_modified_at", hours_between(as_of, F.col("last_modified_at")).alias("hours_since_sync"),
        freshness_status(F.col("last_modified_at"), as_of).alias("freshness_status"),
        "last_run_status", "last_run_started_at", "last_run_completed_at", "last_run_duration_ms", "last_run_error",
    )


def freshness_list(tables: Tables, as_of: Column, tenant_id: str | None = None, stale_only: bool = False) -> DataFrame:
    rows = tenant_freshness(tables, as_of, tenant_id)
    if stale_only:
        rows = rows.filter(F.col("freshness_status").isin("stale", "never_synced"))
    return rows.orderBy("tenant_name", F.asc_nulls_last("entity"), "connection_id").select(
        "tenant_id", "tenant_name", "connection_id", "org_name", "entity", "last_modified_at", "hours_since_sync",
        "freshness_status", "last_run_status", "last_run_completed_at", "last_run_error")


def freshness_of_tenant(tables: Tables, as_of: Column, tenant_id: str) -> DataFrame:
    return tenant_freshness(tables, as_of, tenant_id).orderBy(F.asc_nulls_last("entity"), "last_modified_at").select(
        "entity", "last_modified_at", "freshness_status")


def _step_totals(steps: DataFrame) -> DataFrame:
    status = F.col("status")
    return steps.groupBy(F.col("sync_run_id").alias("_run")).agg(
        F.count(F.lit(1)).alias("total_steps"), F.count_if(status == "completed").alias("completed_steps"),
        F.count_if(status == "failed").alias("failed_steps"), F.count_if(status == "skipped").alias("skipped_steps"),
        F.sum("records_synced").alias("total_records_synced"), F.sum("records_failed").alias("total_records_failed"))


STEP_TOTALS = ("total_steps", "completed_steps", "failed_steps", "skipped_steps", "total_records_synced", "total_records_failed")


def _with_names(rows: DataFrame, tables: Tables, key: str = "id") -> DataFrame:
    """Inner joins to the connection and the tenant of a run."""
    rows = attach(rows, tables["connections"], {"connection_id": "id"}, {"org_name": "org_name"},
                  spread_by=(key,), how="inner", hot_keys=True)
    return attach(rows, tables["tenants"], {"tenant_id": "id"}, {"tenant_name": "name"},
                  spread_by=(key,), how="inner", hot_keys=True)


def _summarise(runs: DataFrame, steps: DataFrame, tables: Tables) -> DataFrame:
    rows = _with_names(runs, tables)
    rows = rows.join(_step_totals(steps), F.col("id") == F.col("_run"), "left")
    return rows.select(
        "id", "tenant_id", "tenant_name", "connection_id", "org_name", "status", "triggered_by", "started_at",
        "completed_at", "duration_ms", "error", "created_at",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in STEP_TOTALS])


def run_summary(tables: Tables, tenant_id: str | None = None) -> DataFrame:
    """Runs with their step counts; steps are pre-aggregated per run before the join."""
    runs, steps = of_tenant(tables["sync_runs"], tenant_id), tables["sync_run_steps"]
    if tenant_id is not None:
        steps = steps.join(runs.select(F.col("id").alias("sync_run_id")), "sync_run_id", "left_semi")
    return _summarise(runs, steps, tables)


def run_history(tables: Tables, status: str | None = None, tenant_id: str | None = None, limit: int | None = None) -> DataFrame:
    """Newest runs. The page is cut before steps are read: only its runs are summarised."""
    runs = of_tenant(tables["sync_runs"], tenant_id)
    if status is not None:
        runs = runs.filter(F.col("status") == status)
    # runs are visible only with a known connection and tenant, so that is checked before the cut
    known = runs.join(tables["connections"].select(F.col("id").alias("connection_id")), "connection_id", "left_semi")
    known = known.join(tables["tenants"].select(F.col("id").alias("tenant_id")), "tenant_id", "left_semi")
    page = newest(known, limit, "id")
    steps = tables["sync_run_steps"].join(page.select(F.col("id").alias("sync_run_id")), "sync_run_id", "left_semi")
    return newest(_summarise(page, steps, tables), limit, "id")


def run_detail(tables: Tables, run_id: str) -> DataFrame:
    """One run with one row per step and the step's own duration."""
    own = tables["sync_run_steps"].filter(F.col("sync_run_id") == run_id)
    run = _summarise(tables["sync_runs"].filter(F.col("id") == run_id), own, tables)
    steps = own.select(
        F.col("sync_run_id").alias("_run"), F.col("id").alias("step_id"), F.col("entity").alias("step_entity"),
        F.col("status").alias("step_status"), "records_synced", "records_failed",
        F.col("started_at").alias("step_started_at"), F.col("completed_at").alias("step_completed_at"),
        millis_between(F.col("completed_at"), F.col("started_at")).alias("step_duration_ms"),
        F.col("error").alias("step_error"), F.col("created_at").alias("_created"))
    return run.join(steps, F.col("id") == F.col("_run"), "left").orderBy("_created", "step_id").drop("_run", "_created")


def run_with_steps(tables: Tables, run_id: str) -> DataFrame:
    """One run in its stored columns plus names, with one row per step in creation order."""
    run = _with_names(tables["sync_runs"].filter(F.col("id") == run_id), tables)
    steps = tables["sync_run_steps"].filter(F.col("sync_run_id") == run_id).select(
        F.col("sync_run_id").alias("_run"), F.col("id").alias("step_id"), F.col("entity").alias("step_entity"),
        F.col("status").alias("step_status"), "records_synced", "records_failed",
        F.col("started_at").alias("step_started_at"), F.col("completed_at").alias("step_completed_at"),
        F.col("error").alias("step_error"), F.col("created_at").alias("_created"))
    return run.join(steps, F.col("id") == F.col("_run"), "left").orderBy("_created", "step_id").drop("_run", "_created")


def recent_runs(tables: Tables, limit: int | None = None) -> DataFrame:
    rows = newest(_with_names(tables["sync_runs"], tables), limit, "id")
    return rows.select("id", "status", "triggered_by", "started_at", "completed_at", "duration_ms", "error", "org_name", "tenant_name")


def dashboard_metrics(tables: Tables, as_of: Column) -> DataFrame:
    """One row of counters. Each table is read once; the joined operands are single rows."""
    last_day = F.col("created_at") > hours_before(as_of, 24)
    last_week = F.col("created_at") > hours_before(as_of, 7 * 24)
    one = F.count(F.lit(1))

    tenants = tables["tenants"].agg(one.alias("total_tenants"), F.count_if("is_active").alias("active_tenants"))

    recently_synced = tables["sync_runs"].filter(
        (F.col("status") == "completed") & (F.col("completed_at") > hours_before(as_of, STALE_HOURS))
    ).select(F.col("connection_id").alias("id")).distinct()
    marked = tables["connections"].join(recently_synced.withColumn("_synced", F.lit(True)), "id", "left")
    connections = marked.agg(
        one.alias("total_connections"), F.count_if("is_active").alias("active_connections"),
        F.count_if(F.col("is_active") & F.col("_synced").isNull()).alias("stale_connections"))

    runs = tables["sync_runs"].agg(
        F.count_if(last_day).alias("syncs_last_24h"),
        F.count_if((F.col("status") == "failed") & last_day).alias("failed_syncs_last_24h"),
        F.count_if(F.col("status") == "running").alias("syncs_currently_running"))

    def rows_in(table: str, name: str) -> DataFrame:
        return tables[table].agg(one.alias(name))

    uploads = tables["upload_batches"].agg(
        F.count_if(F.col("status").isin("pending", "processing")).alias("pending_uploads"),
        F.count_if((F.col("status") == "failed") & last_day).alias("failed_uploads_last_24h"),
        F.count_if((F.col("status") == "completed") & last_week).alias("completed_uploads_last_7d"))
    parts = [
        tenants, connections, runs, rows_in("fact_invoice", "total_invoices"), rows_in("fact_payment", "total_payments"),
        rows_in("fact_bank_transaction", "total_bank_transactions"), rows_in("dim_contact", "total_contacts"), uploads,
    ]
    return reduce(DataFrame.crossJoin, parts).withColumn("generated_at", as_of)


def _count_by_tenant(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(F.col("tenant_id").alias(f"_{name}")).agg(F.count(F.lit(1)).alias(name))


def tenant_overview(tables: Tables, as_of: Column) -> DataFrame:
    """Connections with their worst freshness and the record counts of their tenant.

    Rows are grouped by the last-run columns as well, so a connection whose entities were
    touched by different runs appears several times.
    """
    is_status = lambda s: F.bool_or(F.col("freshness_status") == s)
    worst = (F.when(is_status("never_synced"), "never_synced").when(is_status("stale"), "stale")
             .when(is_status("recent"), "recent").otherwise("fresh"))
    who = ["tenant_id", "tenant_name", "tenant_is_active", "connection_id", "org_name", "connection_is_active"]
    last_run = ["last_run_status", "last_run_started_at", "last_run_completed_at", "last_run_duration_ms", "last_run_error"]
    rows = tenant_freshness(tables, as_of).groupBy(*who, *last_run).agg(
        worst.alias("freshness_status"), F.max("last_modified_at").alias("last_synced_at"),
        F.min("hours_since_sync").alias("min_hours_since_sync"), F.max("hours_since_sync").alias("max_hours_since_sync"))
    # counted per tenant first; joining the facts themselves would multiply them with each other
    counts = {"invoice_count": "fact_invoice", "payment_count": "fact_payment", "contact_count": "dim_contact"}
    for name, table in counts.items():
        per_tenant = _count_by_tenant(tables[table], name)
        rows = rows.join(per_tenant, F.col("tenant_id") == F.col(f"_{name}"), "left").drop(f"_{name}")
    return rows.withColumns({n: F.coalesce(n, F.lit(0)) for n in counts}).orderBy(
        "tenant_name", "connection_id", F.asc_nulls_last("last_synced_at"))


def uploads(tables: Tables, tenant_id: str | None = None, status: str | None = None, limit: int | None = None) -> DataFrame:
    """Newest upload batches with their line counts. The page is cut first: only lines of its batches are counted."""
    batches = of_tenant(tables["upload_batches"], tenant_id)
    if status is not None:
        batches = batches.filter(F.col("status") == status)
    known = batches.join(tables["tenants"].select(F.col("id").alias("tenant_id")), "tenant_id", "left_semi")
    page = attach(newest(known, limit, "id"), tables["tenants"], {"tenant_id": "id"}, {"tenant_name": "name"},
                  spread_by=("id",), how="inner", hot_keys=True)
    lines = of_tenant(tables["statement_lines"], tenant_id)
    if limit is not None or status is not None:
        lines = lines.join(page.select(F.col("id").alias("batch_id")), "batch_id", "left_semi")
    lines = lines.groupBy(F.col("batch_id").alias("_batch")).agg(
        F.count(F.lit(1)).alias("total_lines"), F.count_if("approved").alias("approved_lines"),
        F.count_if(~F.col("approved")).alias("pending_lines"))
    rows = page.join(lines, F.col("id") == F.col("_batch"), "left")
    counted = ("total_lines", "approved_lines", "pending_lines")
    return rows.select(
        "id", "tenant_id", "tenant_name", "filename", "file_size_bytes", "row_count", "status", "error", "created_at",
        "completed_at", millis_between(F.col("completed_at"), F.col("created_at")).alias("duration_ms"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counted],
    ).orderBy(F.desc("created_at"), F.desc("id"))


def errors(tables: Tables, as_of: Column, hours: int = LOOK_BACK_HOURS, limit: int | None = None) -> DataFrame:
    """Failed runs, steps and uploads of the last hours in one list, newest first."""
    since = hours_before(as_of, hours)
    recent_failure = (F.col("status") == "failed") & (F.col("created_at") > since)
    connections = tables["connections"].select(F.col("id").alias("connection_id"))
    tenants = tables["tenants"].select(F.col("id").alias("tenant_id"))

    def visible(df: DataFrame) -> DataFrame:
        """Rows of a known connection and tenant, cut to the newest: no branch can give more to the page."""
        known = df.join(connections, "connection_id", "left_semi") if "connection_id" in df.columns else df
        return newest(known.join(tenants, "tenant_id", "left_semi"), limit, "id")

    def shape(df: DataFrame, source: str, org: Column, context: str) -> DataFrame:
        return df.select(F.lit(source).alias("source"), "id", "tenant_name", org.alias("org_name"), "status", "error",
                         F.col(context).alias("context"), "created_at")

    runs = _with_names(visible(tables["sync_runs"].filter(recent_failure)), tables)
    failed_steps = tables["sync_run_steps"].filter(recent_failure)
    # the log is read only for the runs of those steps
    owners = tables["sync_runs"].join(
        failed_steps.select(F.col("sync_run_id").alias("id")).distinct(), "id", "left_semi").select(
        F.col("id").alias("_run"), "connection_id", "tenant_id")
    steps = _with_names(
        visible(failed_steps.join(owners, F.col("sync_run_id") == F.col("_run"), "inner").drop("_run")), tables)
    batches = attach(visible(tables["upload_batches"].filter(recent_failure)), tables["tenants"], {"tenant_id": "id"},
                     {"tenant_name": "name"}, spread_by=("id",), how="inner", hot_keys=True)
    everything = (
        shape(runs, "sync_run", F.col("org_name"), "triggered_by")
        .unionByName(shape(steps, "sync_step", F.col("org_name"), "entity"))
        .unionByName(shape(batches, "upload", F.lit(None).cast("string"), "filename"))
    )
    return newest(everything, limit, "source", "id")


def connections_with_last_run(tables: Tables) -> DataFrame:
    """Connections, newest first, with their latest run, invoice cursor and invoice count."""
    rows = _tenant_connections(tables).join(
        tables["connections"].select(F.col("id").alias("_id"), "created_at"), F.col("connection_id") == F.col("_id"), "inner")
    latest = pick_winner(
        tables["sync_runs"].select("connection_id", "id", "status", "completed_at", "duration_ms", "created_at"),
        ["connection_id"], [F.desc("created_at"), F.desc("id")]
    ).select(F.col("connection_id").alias("_c1"), F.col("id").alias("last_run_id"), F.col("status").alias("last_run_status"),
             F.col("completed_at").alias("last_run_at"), F.col("duration_ms").alias("last_run_duration_ms"))
    cursor = tables["sync_checkpoints"].filter(F.col("entity") == "invoices").select(
        F.col("connection_id").alias("_c2"), F.col("last_modified_at").alias("last_synced_at"))
    invoices = tables["raw_invoices"].groupBy(F.col("connection_id").alias("_c3")).agg(F.count(F.lit(1)).alias("invoice_count"))
    for part, key in ((latest, "_c1"), (cursor, "_c2"), (invoices, "_c3")):
        rows = rows.join(part, F.col("connection_id") == F.col(key), "left")
    return rows.orderBy(F.desc("created_at"), F.desc("connection_id")).select(
        F.col("connection_id").alias("id"), "tenant_name", "org_name", F.col("connection_is_active").alias("is_active"),
        "last_run_id", "last_run_status", "last_run_at", "last_run_duration_ms", "last_synced_at",
        F.coalesce("invoice_count", F.lit(0)).alias("invoice_count"))


def connection_registry(tables: Tables) -> DataFrame:
    tenants = tables["tenants"].select(F.col("id").alias("_tenant"), F.col("name").alias("tenant_name"))
    rows = tables["connections"].join(tenants, F.col("tenant_id") == F.col("_tenant"), "inner")
    return rows.orderBy(F.desc("created_at"), F.desc("id")).select(
        "id", "tenant_name", "source_org_id", "org_name", "org_type", "is_active", "created_at")


def batch_lines(lines: DataFrame, batch_id: str) -> DataFrame:
    return lines.filter(F.col("batch_id") == batch_id).orderBy("date", "description", "id").select(
        "id", "tenant_id", "date", "description", "amount", "reference", "currency_code", "account_code", "account_name",
        "category", "tax_type", "notes", "is_suggested", "approved", "approved_at", "dedup_hash", "created_at")

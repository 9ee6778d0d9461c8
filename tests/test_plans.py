"""Views, surfaces and refresh on the small tables, and the shape of the physical plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.functions.dates import date_literal, ts_literal
from ledgerloom.functions.finance import AGEING_ORDER
from ledgerloom.plans import catalogue, ops, refresh, views
from ledgerloom.sources.bindings import Ledger


@pytest.fixture(scope="module")
def ledger(spark, folder):
    return Ledger(spark, folder)


@pytest.fixture(scope="module")
def raw(ledger):
    tables = {name: getattr(ledger, name) for name in (
        "tenants", "raw_contacts", "raw_accounts", "raw_invoices", "raw_invoice_lines", "raw_payments", "raw_bank_transactions",
        "raw_manual_journals")}
    kinds = [ledger.report_snapshots(k) for k in ("trial_balance", "profit_and_loss", "balance_sheet")]
    return {**tables, "report_snapshots": kinds[0].unionByName(kinds[1]).unionByName(kinds[2])}


@pytest.fixture(scope="module")
def warehouse(spark, raw, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("wh") / "v1")
    refresh.refresh_warehouse(spark, raw, target, date_literal("2001-06-30"), ts_literal("2024-02-01 00:00:00"))
    return target


def stored(spark, folder, *names):
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def test_refresh_writes_what_the_counts_say(spark, ledger, warehouse):
    said = dict(rows(refresh.refresh_counts({name: getattr(ledger, name) for name in refresh.TABLES})))
    for table in refresh.TABLES:
        assert spark.read.parquet(f"{warehouse}/{table}").count() == said[table]
    assert said["total"] == sum(v for k, v in said.items() if k != "total")


def test_a_tenant_is_in_few_files(spark, raw, tmp_path):
    rows_of_all = spark.range(20000).select((F.col("id") % 7).cast("string").alias("tenant_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("date"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = refresh._write(rows_of_all, str(tmp_path / "t"), ("tenant_id", "date"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = spark.read.parquet(path).select("tenant_id", F.input_file_name().alias("file"))
    files, own = table.select("file").distinct().count(), table.filter("tenant_id = '3'").select("file").distinct().count()
    assert files >= 6 and own <= 3


def test_line_and_payment_facts_read_only_invoice_keys(spark, raw, warehouse):
    from ledgerloom.operators import star
    tables = stored(spark, warehouse, "fact_invoice", "dim_account")
    df = star.fact_invoice_line(raw["raw_invoice_lines"].limit(10), tables["fact_invoice"], tables["dim_account"], ts_literal("2024-02-01 00:00:00"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    (scan,) = [line for line in plan.splitlines() if "fact_invoice]" in line or "/fact_invoice" in line]
    assert "ReadSchema: struct<tenant_id:string,source_id:string>" in scan


def test_second_refresh_of_one_connection_changes_nothing(spark, raw, warehouse, tmp_path):
    again = str(tmp_path / "v2")
    refresh.refresh_warehouse(spark, raw, again, date_literal("2001-06-30"), ts_literal("2024-02-01 00:00:00"),
                              previous=warehouse, connection_id="3")
    for table in ("dim_contact", "fact_invoice", "fact_invoice_line", "fact_payment", "fact_balance_sheet"):
        old, new = (spark.read.parquet(f"{f}/{table}") for f in (warehouse, again))
        assert new.exceptAll(old).count() == 0 and old.exceptAll(new).count() == 0


def test_first_written_type_survives_a_refresh(spark, raw, warehouse, tmp_path):
    flipped = {**raw, "raw_invoices": raw["raw_invoices"].withColumns({"type": F.lit("OTHER"), "status": F.lit("VOIDED")})}
    target = str(tmp_path / "v2")
    refresh.refresh_warehouse(spark, flipped, target, date_literal("2001-06-30"), ts_literal("2024-02-02 00:00:00"), previous=warehouse)
    got = spark.read.parquet(f"{target}/fact_invoice")
    assert got.filter("type = 'OTHER'").count() == 0 and got.filter("status <> 'VOIDED'").count() == 0


def test_appended_changes_equal_a_full_refresh(spark, raw, warehouse, tmp_path):
    """A third of the invoices changes: the change log gives what a rewrite of all tables gives."""
    as_of, later = date_literal("2001-06-30"), ts_literal("2024-02-02 00:00:00")
    third = (F.crc32("source_id") % 3) == 0
    moved = raw["raw_invoices"].filter(third).withColumns({"status": F.lit("VOIDED"), "contact_id": F.lit("C1"), "type": F.lit("OTHER")})
    names = [n for n in raw if n.startswith("raw_")] + ["tenants"]
    changed = {n: raw[n].limit(0) for n in names} | {"raw_invoices": moved}
    log = str(tmp_path / "log")
    for _ in range(2):  # the second run replays the load
        refresh.append_changes(spark, changed, warehouse, log, 1, as_of, later)
    full = str(tmp_path / "v2")
    refresh.refresh_warehouse(spark, changed, full, as_of, later, previous=warehouse)
    for table in ("dim_contact", "fact_invoice", "fact_payment"):
        want, got = spark.read.parquet(f"{full}/{table}"), refresh.read_current(spark, warehouse, log, table)
        assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    current = refresh.read_current(spark, warehouse, log, "fact_invoice")
    assert current.filter("status = 'VOIDED' AND type = 'OTHER'").count() == 0 < current.filter("status = 'VOIDED'").count()


def test_two_connections_of_a_tenant_collide(spark, ledger):
    extra = ledger.raw_contacts.limit(5).withColumns({"connection_id": F.lit("99"), "name": F.lit("newer"),
                                                      "source_updated_at": ts_literal("2030-01-01 00:00:00")})
    from ledgerloom.operators import star
    dim = star.dim_contact(ledger.raw_contacts.unionByName(extra), ts_literal("2024-02-01 00:00:00"))
    assert dim.filter("name = 'newer'").count() == 5 and dim.count() == ledger.raw_contacts.count()


def test_ageing_buckets_partition_the_invoices(spark, warehouse):
    tables = stored(spark, warehouse, "dim_tenant", "dim_contact", "fact_invoice")
    view = views.invoice_ageing(tables)
    assert view.count() == tables["fact_invoice"].filter("status NOT IN ('VOIDED','DELETED','DRAFT')").count()
    assert {r[0] for r in view.select("ageing_bucket").distinct().collect()} <= set(AGEING_ORDER)
    summary = views.ageing_summary(tables, "1").collect()
    ranks = [AGEING_ORDER.index(r["ageing_bucket"]) for r in summary]
    assert ranks == sorted(ranks)
    one = view.filter("tenant_id = '1' AND type = 'ACCREC'")
    assert sum(r["invoice_count"] for r in summary) == one.count()


def test_views_filter_before_they_join(spark, warehouse):
    names = ("dim_tenant", "dim_contact", "dim_account", "fact_invoice", "fact_payment", "fact_profit_and_loss",
             "fact_balance_sheet", "fact_trial_balance")
    tables = stored(spark, warehouse, *names)
    for view in views.VIEWS.values():
        whole = view(tables)
        one = view(tables, "1")
        assert rows(whole.filter("tenant_id = '1'"), "id") == rows(one, "id")
        plan = one._jdf.queryExecution().executedPlan().toString()
        fact_scans = [l for l in plan.splitlines() if "FileScan" in l]
        assert all("PushedFilters: []" not in l for l in fact_scans)
    registered = views.register_views(tables)
    assert spark.sql("SELECT count(*) FROM vw_overdue_invoices WHERE tenant_id = '1'").first()[0] == views.overdue_invoices(tables, "1").count()
    assert len(registered) == 6


def test_documented_orders(spark, warehouse):
    tables = stored(spark, warehouse, "dim_tenant", "dim_contact", "dim_account", "fact_invoice", "fact_payment")
    days = [r["days_overdue"] for r in views.aged_debt(tables, "1").collect()]
    assert days == sorted(days, reverse=True)
    paid = [r["payment_date"] for r in views.payments_between(tables, "1", "2024-01-05", "2024-01-20").collect()]
    assert paid == sorted(paid, reverse=True)


def test_freshness_and_tenant_overview(ledger):
    tables = catalogue.Tables(ledger)
    fresh = ops.tenant_freshness(tables, ledger.cursor_clock)
    lonely = fresh.filter("connection_id IN ('3', '17')")
    assert rows(lonely, "connection_id", "entity", "freshness_status") == [("17", None, "never_synced"), ("3", None, "never_synced")]
    overview = ops.tenant_overview(tables, ledger.cursor_clock)
    assert overview.select("connection_id").distinct().count() == 25
    assert overview.groupBy("tenant_id").agg(F.max("invoice_count").alias("n")).agg(F.sum("n")).first()[0] == ledger.raw_invoices.count()
    assert ops.freshness_list(tables, ledger.cursor_clock, tenant_id="3", stale_only=True).filter(
        "freshness_status IN ('fresh', 'recent')").count() == 0


def test_limits_and_filters(ledger):
    tables = catalogue.Tables(ledger)
    assert ops.recent_runs(tables, limit=300).count() == 300
    assert ops.recent_runs(tables).count() == ledger.sync_runs.count()
    failed = ledger.sync_run_steps.filter("status = 'failed'").count() + ledger.sync_runs.filter("status = 'failed'").count()
    failed += ledger.upload_batches.filter("status = 'failed'").count()
    assert ops.errors(tables, ledger.run_clock, hours=24 * 365 * 100).count() == failed > 200
    history = ops.run_history(tables, status="failed", tenant_id="1", limit=7).collect()
    assert len(history) == 7 and {r["status"] for r in history} == {"failed"} and {r["tenant_id"] for r in history} == {"1"}
    created = [r["created_at"] for r in history]
    assert created == sorted(created, reverse=True)
    assert ops.run_summary(tables).filter("total_steps <> completed_steps + failed_steps + skipped_steps").count() == 0
    small = {r["created_at"] for r in ops.errors(tables, ledger.run_clock, hours=24).collect()}
    assert len(small) <= len({r["created_at"] for r in ops.errors(tables, ledger.run_clock, hours=9999).collect()})


def test_cursor_is_the_start_of_the_run_it_names(ledger):
    moved = catalogue.REGISTRY["checkpoint_advance"](ledger).filter("entity = 'invoices'").alias("c")
    runs = ledger.sync_runs.alias("r")
    named = moved.join(runs, F.col("c.last_run_id") == F.col("r.id"))
    assert named.count() == moved.filter("last_run_id IS NOT NULL").count() > 0
    assert named.filter("c.last_modified_at <> r.started_at OR r.status <> 'completed'").count() == 0


def test_metrics_row(ledger):
    got = ops.dashboard_metrics(catalogue.Tables(ledger), ledger.run_clock).collect()
    assert len(got) == 1 and len(got[0]) == 16
    assert got[0]["total_invoices"] == ledger.raw_invoices.count() and got[0]["active_connections"] == 21

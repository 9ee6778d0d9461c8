"""Registered queries: every operator bound to the test tables, over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions import dates, finance, text
from ledgerloom.functions.keys import statement_hash, surrogate_key
from ledgerloom.operators import cascade, merge, partitioned, quality, runs, star, statements
from ledgerloom.plans import ageing_store, ops, refresh, views
from ledgerloom.schemas import CASCADES, CONSTRAINTS, FOREIGN_KEYS, MERGE_RULES, REQUIRED, RESTRICTS, UNIQUE_KEYS
from ledgerloom.session import scratch_dir, use_ledger_semantics
from ledgerloom.sources import incremental, lookups, payloads, uploads
from ledgerloom.sources.bindings import AS_OF, Ledger, _mod, _text
from ledgerloom.streaming import change_log, statements as statement_stream

TENANT = "1"
RUN_ID = "2"
PNL_MONTH = "1998-03-31"
PIVOT = {"Jan 1998": "jan_98", "Feb 1998": "feb_98", "Mar 1998": "mar_98"}

Query = Callable[[Ledger], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


class Tables:
    """Mapping view of a ledger: ``tables["fact_invoice"]`` binds that table on first use."""

    def __init__(self, ledger: Ledger, **overrides: DataFrame):
        self.ledger, self.overrides = ledger, overrides

    def __getitem__(self, name: str) -> DataFrame:
        return self.overrides[name] if name in self.overrides else getattr(self.ledger, name)


# ── ingest ───────────────────────────────────────────────────────────────────

def _ingest(entity: str) -> Query:
    def run(ledger: Ledger) -> DataFrame:
        rows = payloads.INGEST[entity](ledger.payloads(entity), ledger.loaded_at)
        return rows.drop("raw")
    run.__name__ = f"ingest_{entity}"
    return query(run)


for _entity in payloads.INGEST:
    _ingest(_entity)


@query
def ingest_report_snapshots(ledger: Ledger) -> DataFrame:
    kinds = ("trial_balance", "profit_and_loss", "balance_sheet")
    rows = [ledger.report_snapshots(k) for k in kinds]
    everything = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return everything.select("id", "connection_id", "tenant_id", "report_type", "period_date", "period_from",
                             "report_name", "captured_at")


@query
def ingest_rejects(ledger: Ledger) -> DataFrame:
    """Every payment and account page, three in ten and one in four of them damaged, by what became of it."""
    number = F.regexp_extract("raw", '"Payment(?:ID)?":"P([0-9]+)"', 1).cast("bigint")
    kind = F.pmod(number, F.lit(10))
    raw = (F.when(kind == 0, F.expr("left(raw, length(raw) - 5)")).when(kind == 1, F.expr("replace(raw, '\"PaymentID\"', '\"Payment\"')"))
           .when(kind == 2, F.regexp_replace("raw", '"Amount":[^,}]*', '"Amount":99999999999999999')).otherwise(F.col("raw")))
    payments = ledger.payloads("payments").withColumn("raw", raw)
    stored = payloads.ingest_payments(payments, ledger.loaded_at).select("raw", F.lit("stored").alias("reason"))
    records = stored.unionByName(payloads.rejects(payments, "payments").select("raw", "reason")).select(
        F.lit("payments").alias("entity"), number.alias("number"), "reason")

    page = F.floor(F.regexp_extract("raw", '"AccountID":"([0-9]+)"', 1).cast("bigint") / 50)
    pages = ledger.payloads("accounts").groupBy("connection_id", "tenant_id", page.alias("page_number")).agg(
        F.array_join(F.collect_list("raw"), ",").alias("list"))
    text = F.concat(F.lit('{"Page":'), _text("page_number"), F.lit(',"Accounts":['), F.col("list"), F.lit("]}"))
    pages = pages.withColumn("page", F.when(_mod("page_number", 4) == 0, F.left(text, F.length(text) - 9)).otherwise(text))
    accounts = payloads.explode_pages(pages, "accounts")
    good = payloads.ingest_accounts(accounts, ledger.loaded_at).select(
        F.col("source_id").cast("bigint").alias("number"), F.lit("stored").alias("reason"))
    bad = payloads.page_rejects(pages, "accounts").select(
        F.regexp_extract("raw", '"Page":([0-9]+)', 1).cast("bigint").alias("number"), "reason")
    listed = good.unionByName(bad).select(F.lit("accounts").alias("entity"), "number", "reason")
    return records.unionByName(listed)


@query
def statement_raw_rows(ledger: Ledger) -> DataFrame:
    entries = text.header_entries(F.col("raw"))
    return ledger.statement_rows.select("batch_id", "tenant_id", "row_index", text.row_json(entries).alias("raw_json"))


@query
def statement_batch_headers(ledger: Ledger) -> DataFrame:
    return ledger.batch_headers


@query
def incremental_changes(ledger: Ledger) -> DataFrame:
    """Payments against cursors set back to the middle of the month; some connections have none."""
    cursors = ledger.sync_checkpoints.withColumn(
        "last_modified_at", F.col("last_modified_at") - F.make_dt_interval(F.lit(14)))
    return incremental.changed_since(ledger.raw_payments, cursors, "payments").select(
        "connection_id", "tenant_id", "source_id", "amount", "source_updated_at")


@query
def statement_csv_rows(ledger: Ledger) -> DataFrame:
    """Events written as one CSV file a batch, with line ends, quotes and separators inside cells, and read back.

    The files are read in small splits, so records go across them.
    """
    work = scratch_dir(ledger.spark, "uploads")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    kind = F.col("event_type")
    memo = (F.when(_mod("event_id", 5) == 0, quoted(F.concat(kind, F.lit("\n\nsaid \"no\", twice\n"))))
            .when(_mod("event_id", 5) == 1, F.concat(F.lit('5" '), kind)).when(_mod("event_id", 5) == 2, quoted(F.concat(F.lit(","), kind)))
            .when(_mod("event_id", 5) == 3, F.lit("")).otherwise(kind))
    line = F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd"), memo, _text(F.floor("value")), quoted(F.concat(F.lit("R\n"), _text("event_id"))))
    rows = ledger.read("events").select(_mod("user_id", 10).alias("batch"), "event_id", line.alias("value"))
    heads = rows.select("batch").distinct().select("batch", F.lit(-1).cast("bigint").alias("event_id"),
                                                   F.lit('Date,Memo,Amount,"Your\nreference"').alias("value"))
    # a file is one batch, as banks export them
    rows.unionByName(heads).repartition("batch").sortWithinPartitions("batch", "event_id").select("batch", "value").write.partitionBy(
        "batch").text(f"{work}/files")
    sizes = {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "0"}
    before = {k: ledger.spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            ledger.spark.conf.set(k, v)
        uploads.read_statement_csv(ledger.spark, f"{work}/files", "t").write.parquet(f"{work}/rows")
    finally:
        for k, v in before.items():
            ledger.spark.conf.set(k, v)
    cell = lambda name: F.try_element_at("raw", F.lit(name))
    return ledger.spark.read.parquet(f"{work}/rows").select(
        F.regexp_extract("batch_id", "batch=([0-9]+)", 1).cast("bigint").alias("batch"), "row_index", cell("Date").alias("date_text"),
        cell("Memo").alias("memo"), cell("Amount").alias("amount_text"), cell("Your\nreference").alias("reference"))


@query
def incremental_changes_pruned(ledger: Ledger) -> DataFrame:
    """:func:`incremental_changes` from a stored table, by the least cursor first."""
    work = scratch_dir(ledger.spark, "raw")
    incremental.cluster_by_change(ledger.raw_payments, f"{work}/raw_payments")
    cursors = ledger.sync_checkpoints.withColumn(
        "last_modified_at", F.col("last_modified_at") - F.make_dt_interval(F.lit(14)))
    return incremental.changed_since_pruned(ledger.spark, f"{work}/raw_payments", cursors, "payments", ledger.connections).select(
        "connection_id", "tenant_id", "source_id", "amount", "source_updated_at")


@query
def active_connections(ledger: Ledger) -> DataFrame:
    return incremental.active_connections(ledger.connections)


@query
def client_metadata_resolved(ledger: Ledger) -> DataFrame:
    return lookups.client_metadata(ledger.client_metadata, ledger.business_types)


@query
def wire_date_parse(ledger: Ledger) -> DataFrame:
    """Every event time in one of six spellings, parsed back."""
    ts, key = F.col("ts"), "event_id"
    millis = F.unix_millis(ts.cast("timestamp")).cast("string")
    spelling = (
        F.when(_mod(key, 6) == 0, F.concat(F.lit("/Date("), millis, F.lit("+0000)/")))
        .when(_mod(key, 6) == 1, F.concat(F.lit("/Date("), millis, F.lit(")/")))
        .when(_mod(key, 6) == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(_mod(key, 6) == 3, F.concat(F.lit("/Date(-"), millis, F.lit(")/")))
        .when(_mod(key, 6) == 4, F.lit("")).otherwise(F.concat(F.lit("not-a-date "), _text(key)))
    )
    return ledger.read("events").select("event_id", dates.parse_wire_date(spelling).alias("parsed"))


# ── merges ───────────────────────────────────────────────────────────────────

def _older_invoices(ledger: Ledger) -> DataFrame:
    """An earlier state of the invoice table: two thirds of the rows, all drafts of the other type."""
    older = ledger.raw_invoices.filter(_mod_id() != 0)
    return older.withColumns({
        "status": F.lit("DRAFT"), "reference": F.lit("old"),
        "type": F.when(F.col("type") == "ACCREC", "ACCPAY").otherwise("ACCREC"),
    })


def _newer_invoices(ledger: Ledger) -> DataFrame:
    """A later delivery: two thirds of the rows, some values now missing."""
    newer = ledger.raw_invoices.filter(_mod_id() != 1)
    return newer.withColumn("reference", F.when(F.col("status") != "PAID", F.col("reference")))


def _mod_id():
    return F.pmod(F.col("source_id").cast("bigint"), F.lit(3))


MERGE_OUTPUT = ("connection_id", "source_id", "type", "status", "reference", "amount_due")


@query
def keyed_merge_update(ledger: Ledger) -> DataFrame:
    """Flat invoice table: every non-key column is overwritten, also by null."""
    rule = MERGE_RULES["legacy_invoices"]
    columns = [c for c in MERGE_OUTPUT]
    return merge.keyed_merge(_older_invoices(ledger).select(*columns), _newer_invoices(ledger).select(*columns),
                             rule.keys, rule.insert_only)


@query
def keyed_merge_insert_only(ledger: Ledger) -> DataFrame:
    """Raw invoice table: the type of the first write stays."""
    rule = MERGE_RULES["raw_invoices"]
    columns = [*MERGE_OUTPUT, "tenant_id"]
    return merge.keyed_merge(_older_invoices(ledger).select(*columns), _newer_invoices(ledger).select(*columns),
                             rule.keys, rule.insert_only)


@query
def keyed_merge_partitions(ledger: Ledger) -> DataFrame:
    """A stored invoice table takes the changes of three tenants from 1997 on: dates move, new invoices come in."""
    work = scratch_dir(ledger.spark, "invoices")
    rule = MERGE_RULES["raw_invoices"]
    columns = [*MERGE_OUTPUT, "tenant_id", "date"]
    partitioned.create_partitioned(_older_invoices(ledger).select(*columns), f"{work}/table", rule.keys, "tenant_id", "date", period="yyyy")
    newer = _newer_invoices(ledger).filter(F.col("tenant_id").isin("0", "1", "3") & (F.col("date") >= dates.date_literal("1997-01-01")))
    moved = newer.withColumn("date", F.when(_mod_id() == 2, F.date_add("date", 40)).otherwise(F.col("date")))
    partitioned.merge_partitions(ledger.spark, f"{work}/table", moved.select(*columns), rule.keys, "tenant_id", "date", rule.insert_only, period="yyyy")
    return partitioned.read_partitioned(ledger.spark, f"{work}/table", columns)


@query
def keyed_merge_guarded(ledger: Ledger) -> DataFrame:
    """All deliveries of order lines merged into the older half; of a key delivered twice the last one counts."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = ledger.read("lineitem").select(*keys, *Ledger.LINE_ORDER)
    last = [F.desc(c) for c in Ledger.LINE_ORDER]
    held = merge.pick_winner(lines.filter(F.col("l_linenumber") <= 3), keys, [F.asc(c) for c in Ledger.LINE_ORDER])
    return merge.keyed_merge(held, lines, keys, insert_only=["l_shipdate"], order=last)


@query
def keyed_insert_ignore(ledger: Ledger) -> DataFrame:
    """Deliveries of order lines; a key present already, or delivered twice, is kept once."""
    columns = ["l_orderkey", "l_linenumber", *Ledger.LINE_ORDER]
    lines = ledger.read("lineitem").select(*columns)
    held = merge.pick_winner(lines.filter(F.col("l_linenumber") <= 2), ["l_orderkey", "l_linenumber"],
                             [F.desc(c) for c in Ledger.LINE_ORDER])
    return merge.keyed_insert_ignore(held, lines, ["l_orderkey", "l_linenumber"], [F.asc(c) for c in Ledger.LINE_ORDER])


@query
def merge_source_duplicates(ledger: Ledger) -> DataFrame:
    return merge.duplicate_keys(ledger.read("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def remap_connection_ids(ledger: Ledger) -> DataFrame:
    """Invoices re-pointed from old connection ids to organisation ids, where one is known."""
    mapping = ledger.connections.filter("is_active").select(
        F.col("id").alias("old_id"), F.col("source_org_id").alias("new_id"))
    invoices = ledger.raw_invoices.select("connection_id", "source_id", "total")
    return merge.remap_keys(invoices, mapping, "connection_id", "old_id", "new_id")


@query
def backfill_tenants(ledger: Ledger) -> DataFrame:
    """Tenants from organisation names; customers stand for connections, slugs repeat."""
    organisations = ledger.read("customer").select(
        _text("c_custkey").alias("id"),
        F.concat_ws(" & ", "c_mktsegment", _text("c_nationkey")).alias("org_name"),
        (dates.ts_literal("1995-01-01 00:00:00") + F.make_dt_interval(_mod("c_custkey", 97).cast("int"))).alias("created_at"))
    return merge.backfill_tenants(organisations)


@query
def backfill_connections(ledger: Ledger) -> DataFrame:
    """Connections linked to tenants by the slug of their name; known organisations are kept."""
    renamed = ledger.connections.withColumn("org_name", F.regexp_replace("org_name", "_", " "))
    tenants = renamed.select(text.slugify(F.col("org_name")).alias("slug"), F.concat(F.lit("T"), F.col("id")).alias("id"))
    known = ledger.connections.filter(F.col("id").cast("int") < 10)
    return merge.backfill_connections(renamed, tenants, known).select("id", "tenant_id", "source_org_id", "org_name", "is_active")


LINE_OUTPUT = ("id", "tenant_id", "batch_id", "date", "amount", "account_code", "account_name", "category", "tax_type",
               "approved", "approved_by", "approved_at", "updated_at")


@query
def apply_line_edits(ledger: Ledger) -> DataFrame:
    return ledger.statement_lines.select(*LINE_OUTPUT)


@query
def checkpoint_advance(ledger: Ledger) -> DataFrame:
    """Cursors moved to the start of the last run that completed for a connection."""
    checkpoints = ledger.sync_checkpoints
    last = F.max(F.struct("started_at", F.col("id").cast("bigint").alias("run")))
    finished = ledger.sync_runs.filter(F.col("status") == "completed").groupBy("connection_id").agg(last.alias("_last"))
    advance = finished.select("connection_id", F.lit("invoices").alias("entity"),
                              F.col("_last.started_at").alias("last_modified_at"), _text("_last.run").alias("last_run_id"))
    return merge.checkpoint_advance(checkpoints, advance)


@query
def soft_delete_connections(ledger: Ledger) -> DataFrame:
    """Disconnect the organisations whose runs mostly failed, re-connect those that completed most."""
    outcome = ledger.sync_runs.groupBy(F.col("connection_id").alias("id")).agg(
        F.count_if(F.col("status") == "failed").alias("bad"), F.count_if(F.col("status") == "completed").alias("good"))
    off = merge.deactivate(ledger.connections, outcome.filter("bad > good"), ledger.run_clock)
    return merge.reactivate(off, outcome.filter("good > bad"), ledger.loaded_at).select(
        "id", "tenant_id", "org_name", "is_active", "created_at", "updated_at")


@query
def cascade_delete_batches(ledger: Ledger) -> DataFrame:
    """Lines that survive when the batches of more than a day ago are removed."""
    removed = ledger.upload_batches.filter(F.col("created_at") < dates.hours_before(ledger.run_clock, 24))
    return merge.cascade_delete(ledger.new_lines, removed, "batch_id").select("id", "batch_id", "date", "amount")


@query
def cascade_delete_tenants(ledger: Ledger) -> DataFrame:
    """What is left of every table when a tenant, old batches and failed runs are removed, and what the rest holds back."""
    ledger.keep("statement_rows", "normalised_rows", "new_lines", "upload_batches")
    tables = {**{n: getattr(ledger, n) for n in ("tenants", "connections", "client_metadata", "upload_batches", "statement_lines",
                                                 "sync_runs", "sync_run_steps", "sync_checkpoints")},
              "uploaded_rows": ledger.statement_rows}
    removed = {
        "tenants": ledger.tenants.filter(F.col("id") == "2").select("id"),
        "upload_batches": ledger.upload_batches.filter(
            F.col("created_at") < dates.hours_before(ledger.run_clock, 60)).select("id"),
        "sync_runs": ledger.sync_runs.filter(F.col("status") == "failed").select("id")}
    left, held = cascade.cascade_tables(tables, removed, CASCADES, RESTRICTS)
    key = {"client_metadata": F.col("tenant_id"), "uploaded_rows": F.concat_ws("-", "batch_id", "row_index")}
    parts = [rows.select(F.lit(name).alias("table_name"), key.get(name, F.col("id")).alias("key"), F.lit(None).cast("bigint").alias("rows"))
             for name, rows in left.items()]
    parts.append(held.select(F.lit("held").alias("table_name"), F.col("relation").alias("key"), "rows"))
    return reduce(DataFrame.unionByName, parts)


@query
def runner_isolated(ledger: Ledger) -> DataFrame:
    """One pull of payments for all connections; those with a damaged record fail alone."""
    number = F.regexp_extract("raw", '"PaymentID":"P([0-9]+)"', 1).cast("bigint")
    kind = F.col("connection_id").cast("int") % 4
    raw = (F.when((kind == 1) & (F.pmod(number, F.lit(10)) == 0), F.expr("left(raw, length(raw) - 5)"))
           .when((kind == 2) & (F.pmod(number, F.lit(7)) == 0), F.regexp_replace("raw", '"Amount":[^,}]*', '"Amount":99999999999999999'))
           .otherwise(F.col("raw")))
    # a pull is what was delivered: stored as it came
    work = scratch_dir(ledger.spark, "pull")
    ledger.payloads("payments").withColumn("raw", raw).write.parquet(f"{work}/payments")
    pulled = ledger.spark.read.parquet(f"{work}/payments")
    landed, outcomes = runs.isolate_failures(ledger.connections, payloads.ingest_payments(pulled, ledger.loaded_at),
                                             payloads.rejects(pulled, "payments"))
    amounts = landed.groupBy("connection_id").agg(F.sum("amount").cast("decimal(18,2)").alias("amount"))
    return outcomes.join(amounts, "connection_id", "left")


@query
def run_outcomes(ledger: Ledger) -> DataFrame:
    started = ledger.sync_runs.select(
        F.col("id").alias("run_id"), F.lit("started").alias("kind"), F.col("started_at").alias("at"),
        F.lit("").alias("seq"), F.lit(None).cast("string").alias("error"))
    finished = ledger.sync_runs.filter(F.col("status") == "completed").select(
        F.col("id").alias("run_id"), F.lit("finished").alias("kind"), F.col("completed_at").alias("at"),
        F.lit("").alias("seq"), F.lit(None).cast("string").alias("error"))
    ended = ledger.sync_run_steps.filter(F.col("status").isin("failed", "completed"))
    steps = ended.select(
        F.col("sync_run_id").alias("run_id"), F.concat(F.lit("step_"), "status").alias("kind"),
        F.col("completed_at").alias("at"), F.col("id").alias("seq"), "error")
    return runs.run_outcomes(started.unionByName(finished).unionByName(steps))


@query
def runner_summary(ledger: Ledger) -> DataFrame:
    """All runs of a day count as one invocation of the runner."""
    by_day = ledger.sync_runs.withColumn("invocation", F.col("created_at").cast("date"))
    return runs.runner_summary(by_day, "invocation")


# ── warehouse ────────────────────────────────────────────────────────────────

def _table(name: str) -> None:
    def run(ledger: Ledger) -> DataFrame:
        return getattr(ledger, name)
    run.__name__ = name
    query(run)


for _name in ("dim_tenant", "dim_contact", "dim_account", "fact_invoice", "fact_invoice_line", "fact_payment",
              "fact_bank_transaction", "fact_manual_journal"):
    _table(_name)


@query
def warehouse_refresh_counts(ledger: Ledger) -> DataFrame:
    """Rows that each transform gives a refresh to merge, counted behind the transform."""
    return refresh.refresh_counts({name: getattr(ledger, name) for name in refresh.TABLES})


@query
def warehouse_refresh(ledger: Ledger) -> DataFrame:
    """The whole refresh, from raw tables to stored ones: rows of each table as written, dimensions first."""
    ledger.keep("_orders", "_monthly")
    raw = {name: getattr(ledger, name) for name in (
        "tenants", "raw_contacts", "raw_accounts", "raw_invoices", "raw_invoice_lines", "raw_payments",
        "raw_bank_transactions", "raw_manual_journals")}
    raw["report_snapshots"] = _snapshots(ledger, "id", "connection_id", "tenant_id", "report_type", "period_date", "period_from", "raw")
    target = scratch_dir(ledger.spark, "warehouse")
    counts: dict[str, int] = {}
    refresh.refresh_warehouse(ledger.spark, raw, target, ledger.as_of, ledger.loaded_at, counts=counts)
    return runs.summary_of_counts(ledger.spark, counts)


LAST_DAY, THIS_DAY = dt.date(1998, 2, 1), dt.date.fromisoformat(AS_OF)


def _loaded_invoices(ledger: Ledger, raw: DataFrame, day: dt.date) -> DataFrame:
    return star.fact_invoice(raw, ledger.dim_contact, F.lit(day), ledger.loaded_at)


@query
def redate_overdue(ledger: Ledger) -> DataFrame:
    """Invoices stored on one day, a change load on a later one, then only the flags that the days between turn."""
    work = scratch_dir(ledger.spark, "redate")
    older = ledger.raw_invoices.filter(_mod_id() != 2).withColumn(
        "due_date", F.when(_mod_id() == 0, F.date_add("due_date", 700)).otherwise(F.col("due_date")))
    _loaded_invoices(ledger, older, LAST_DAY).repartitionByRange("tenant_id", "date").sortWithinPartitions(
        "tenant_id", "date").write.parquet(f"{work}/base/fact_invoice")
    changed = _loaded_invoices(ledger, ledger.raw_invoices.filter(_mod_id() != 1), LAST_DAY)
    change_log.write_batch(changed, f"{work}/log/fact_invoice", 0)
    refresh.redate_overdue(ledger.spark, f"{work}/base", f"{work}/log", 1, LAST_DAY, THIS_DAY, ledger.loaded_at)
    now = refresh.read_current(ledger.spark, f"{work}/base", f"{work}/log", "fact_invoice")
    return refresh.dated_invoices(now, THIS_DAY)


@query
def ageing_summary_incremental(ledger: Ledger) -> DataFrame:
    """Ageing totals of a stored table after three change loads, folded in one after another."""
    work = scratch_dir(ledger.spark, "ageing")
    base, log, store = f"{work}/base", f"{work}/log", f"{work}/totals"
    older = ledger.raw_invoices.filter(F.pmod(F.col("source_id").cast("bigint"), F.lit(2)) == 0).withColumns(
        {"status": F.lit("SUBMITTED"), "amount_due": (F.col("total") * 2).cast("decimal(15,2)")})
    _loaded_invoices(ledger, older, THIS_DAY).write.parquet(f"{base}/fact_invoice")
    ageing_store.start(ledger.spark.read.parquet(f"{base}/fact_invoice"), store)
    for load in range(3):
        change_log.write_batch(_loaded_invoices(ledger, ledger.raw_invoices.filter(_mod_id() == load), THIS_DAY),
                               f"{log}/fact_invoice", load)
        ageing_store.fold_load(ledger.spark, base, log, load, store)
    return ageing_store.ageing_summary(ageing_store.read_totals(ledger.spark, store), ledger.dim_tenant, THIS_DAY)


# ── reports ──────────────────────────────────────────────────────────────────

@query
def report_amount_parse(ledger: Ledger) -> DataFrame:
    key, plain = "o_orderkey", F.col("o_totalprice").cast("decimal(15,2)")
    spelling = (
        F.when(_mod(key, 7) == 0, F.format_number(plain, 2)).when(_mod(key, 7) == 1, F.concat(F.lit("-"), plain.cast("string")))
        .when(_mod(key, 7) == 2, F.concat(F.lit("  "), plain.cast("string"))).when(_mod(key, 7) == 3, F.lit("  "))
        .when(_mod(key, 7) == 4, F.lit("N/A")).when(_mod(key, 7) == 5, F.concat(_text(key), F.lit("abc")))
    )
    return ledger.read("orders").select("o_orderkey", text.report_amount(spelling).alias("amount"))


@query
def report_trial_balance(ledger: Ledger) -> DataFrame:
    return ledger.fact_trial_balance


@query
def report_profit_and_loss(ledger: Ledger) -> DataFrame:
    return ledger.fact_profit_and_loss


@query
def report_balance_sheet(ledger: Ledger) -> DataFrame:
    return ledger.fact_balance_sheet


# ── statements ───────────────────────────────────────────────────────────────

@query
def statement_field_pick(ledger: Ledger) -> DataFrame:
    return statements.pick_fields(ledger.statement_rows).drop("entries")


@query
def statement_date_parse(ledger: Ledger) -> DataFrame:
    fields = statements.pick_fields(ledger.statement_rows)
    return fields.select("batch_id", "row_index", dates.statement_date(F.col("date_text")).alias("date"))


@query
def statement_amount_parse(ledger: Ledger) -> DataFrame:
    fields = statements.pick_fields(ledger.statement_rows)
    amount = statements.statement_amount(F.col("amount_text"), F.col("debit_text"), F.col("credit_text"))
    return fields.select("batch_id", "row_index", amount.cast("decimal(15,2)").alias("amount"))


@query
def statement_row_errors(ledger: Ledger) -> DataFrame:
    return statements.error_rows(ledger.normalised_rows)


@query
def statement_dedup_hash(ledger: Ledger) -> DataFrame:
    """Hash of every event read as a bank line."""
    return ledger.read("events").select("event_id", statement_hash(
        _text(_mod("user_id", 5)), F.col("ts").cast("date"), F.col("event_type"), F.col("value").cast("decimal(15,2)")
    ).alias("dedup_hash"))


@query
def statement_normalise(ledger: Ledger) -> DataFrame:
    return statements.good_rows(ledger.normalised_rows)


@query
def statement_dedup(ledger: Ledger) -> DataFrame:
    return ledger.new_lines.select("id", "tenant_id", "batch_id", "row_index", "date", "description", "amount",
                                   "reference", "currency_code", "dedup_hash")


@query
def statement_batch_summary(ledger: Ledger) -> DataFrame:
    """Outcome per batch; ``inserted`` leaves out the duplicates that ``processed`` counts."""
    ledger.keep("normalised_rows")
    rows = ledger.normalised_rows
    done = F.col("created_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1), F.lit(30).cast("decimal(18,6)"))
    return statements.batch_summary(rows, ledger.batch_headers, done, ledger.new_lines)


# ── views and surfaces ───────────────────────────────────────────────────────

@query
def view_overdue_invoices(ledger: Ledger) -> DataFrame:
    return views.overdue_invoices(Tables(ledger))


@query
def view_invoice_ageing(ledger: Ledger) -> DataFrame:
    return views.invoice_ageing(Tables(ledger))


@query
def view_payment_history(ledger: Ledger) -> DataFrame:
    return views.payment_history(Tables(ledger))


@query
def view_profit_and_loss(ledger: Ledger) -> DataFrame:
    return views.profit_and_loss(Tables(ledger))


@query
def view_balance_sheet(ledger: Ledger) -> DataFrame:
    return views.balance_sheet(Tables(ledger))


@query
def view_trial_balance(ledger: Ledger) -> DataFrame:
    return views.trial_balance(Tables(ledger))


@query
def ops_tenant_freshness(ledger: Ledger) -> DataFrame:
    return ops.tenant_freshness(Tables(ledger), ledger.cursor_clock)


@query
def ops_run_summary(ledger: Ledger) -> DataFrame:
    return ops.run_summary(Tables(ledger))


@query
def ops_dashboard_metrics(ledger: Ledger) -> DataFrame:
    return ops.dashboard_metrics(Tables(ledger), ledger.run_clock)


@query
def admin_tenants(ledger: Ledger) -> DataFrame:
    return ops.tenant_overview(Tables(ledger), ledger.cursor_clock)


@query
def admin_run_history(ledger: Ledger) -> DataFrame:
    return ops.run_history(Tables(ledger), status="failed", tenant_id=TENANT, limit=500)


@query
def admin_run_detail(ledger: Ledger) -> DataFrame:
    return ops.run_detail(Tables(ledger), RUN_ID)


@query
def admin_stale_entities(ledger: Ledger) -> DataFrame:
    return ops.freshness_list(Tables(ledger), ledger.cursor_clock, stale_only=True)


@query
def admin_uploads(ledger: Ledger) -> DataFrame:
    return ops.uploads(Tables(ledger), limit=ops.PAGE_ROWS)


@query
def admin_errors(ledger: Ledger) -> DataFrame:
    return ops.errors(Tables(ledger), ledger.run_clock, hours=500, limit=500)


@query
def connections_last_run(ledger: Ledger) -> DataFrame:
    return ops.connections_with_last_run(Tables(ledger))


@query
def recent_runs(ledger: Ledger) -> DataFrame:
    return ops.recent_runs(Tables(ledger), limit=ops.PAGE_ROWS)


@query
def run_with_steps(ledger: Ledger) -> DataFrame:
    return ops.run_with_steps(Tables(ledger), RUN_ID)


@query
def connection_registry(ledger: Ledger) -> DataFrame:
    return ops.connection_registry(Tables(ledger))


@query
def batch_lines(ledger: Ledger) -> DataFrame:
    return ops.batch_lines(ledger.statement_lines, "B03")


@query
def doc_aged_debt(ledger: Ledger) -> DataFrame:
    return views.aged_debt(Tables(ledger), TENANT)


@query
def doc_ageing_summary(ledger: Ledger) -> DataFrame:
    return views.ageing_summary(Tables(ledger), TENANT)


@query
def doc_pnl_month(ledger: Ledger) -> DataFrame:
    return views.pnl_month(Tables(ledger), TENANT, PNL_MONTH)


@query
def doc_pnl_pivot(ledger: Ledger) -> DataFrame:
    return views.pnl_pivot(Tables(ledger), TENANT, PIVOT)


@query
def doc_trial_balance_date(ledger: Ledger) -> DataFrame:
    return views.trial_balance_on(Tables(ledger), TENANT, PNL_MONTH)


@query
def doc_payments_between(ledger: Ledger) -> DataFrame:
    return views.payments_between(Tables(ledger), TENANT, "2024-01-05", "2024-01-20")


@query
def doc_freshness_tenant(ledger: Ledger) -> DataFrame:
    return ops.freshness_of_tenant(Tables(ledger), ledger.cursor_clock, TENANT)


@query
def doc_uncoded_lines(ledger: Ledger) -> DataFrame:
    return views.uncoded_lines(ledger.statement_lines, TENANT)


@query
def scalar_functions(ledger: Ledger) -> DataFrame:
    """Every scalar helper over every order."""
    key, placed = "o_orderkey", F.col("o_orderdate")
    day, as_of = placed.cast("date"), ledger.as_of
    due = F.date_add(day, 30)
    mixed = F.concat(_text(key), F.lit(".50abc"))
    return ledger.read("orders").select(
        "o_orderkey",
        text.slugify(F.concat(F.col("o_orderpriority"), F.lit(" / "), F.col("o_orderstatus"))).alias("slug"),
        text.numeric_prefix(mixed).cast("decimal(18,2)").alias("prefix_number"),
        text.plain_number(F.col("o_totalprice").cast("decimal(15,2)")).alias("plain_number"),
        text.trim_ws(F.concat(F.lit("\t "), F.col("o_orderpriority"), F.lit(" \n"))).alias("trimmed"),
        dates.period_label(day).alias("period_label"), dates.month_start(day).alias("month_start"),
        F.greatest(F.lit(0), F.date_diff(as_of, due)).alias("days_late"),
        finance.days_overdue(F.lit("AUTHORISED"), due, as_of).alias("days_overdue"),
        dates.hours_between(ledger.run_clock, placed).alias("hours_since"),
        dates.millis_between(ledger.run_clock, placed).cast("decimal(18,2)").alias("millis_since"),
        finance.freshness_status(placed, ledger.run_clock).alias("freshness"),
        surrogate_key("orders", _text(key)).alias("surrogate"),
        F.abs(F.col("o_totalprice").cast("decimal(15,2)") - 100000).alias("distance"),
        F.lpad(_text(_mod(key, 100)), 2, "0").alias("padded"),
    )


# ── quality ──────────────────────────────────────────────────────────────────

def _snapshots(ledger: Ledger, *columns: str) -> DataFrame:
    kinds = ("trial_balance", "profit_and_loss", "balance_sheet")
    one, two, three = (ledger.report_snapshots(k).select(*columns) for k in kinds)
    return one.unionByName(two).unionByName(three)


@query
def quality_constraint_violations(ledger: Ledger) -> DataFrame:
    ledger.keep("normalised_rows")
    kinds = ("trial_balance", "profit_and_loss", "balance_sheet")
    rows = [getattr(ledger, f"fact_{k}").select("row_type") for k in kinds]
    tables = {
        "sync_runs": ledger.sync_runs, "sync_run_steps": ledger.sync_run_steps, "raw_invoices": ledger.raw_invoices,
        "raw_accounts": ledger.raw_accounts, "report_snapshots": _snapshots(ledger, "report_type"),
        "report_rows": rows[0].unionByName(rows[1]).unionByName(rows[2]), "client_metadata": ledger.client_metadata,
        "upload_batches": ledger.upload_batches, **{name: getattr(ledger, name) for name in REQUIRED},
    }
    return quality.constraint_violations(tables, CONSTRAINTS)


@query
def quality_orphans(ledger: Ledger) -> DataFrame:
    contact_key = F.concat_ws("|", "tenant_id", "source_id").alias("key")
    contacts = ledger.raw_contacts.select(contact_key)
    invoices = ledger.raw_invoices.select("source_id", F.concat_ws("|", "tenant_id", "contact_id").alias("contact_key"))
    return quality.orphans({
        "connections.tenant_id": (ledger.connections, "tenant_id", ledger.tenants, "id"),
        "sync_runs.connection_id": (ledger.sync_runs, "connection_id", ledger.connections, "id"),
        "sync_run_steps.sync_run_id": (ledger.sync_run_steps, "sync_run_id", ledger.sync_runs, "id"),
        "raw_payments.invoice_id": (ledger.raw_payments, "invoice_id", ledger.raw_invoices, "source_id"),
        "raw_invoices.contact": (invoices, "contact_key", contacts, "key"),
        "raw_payments.account_id": (ledger.raw_payments, "account_id", ledger.raw_accounts, "source_id"),
    })


@query
def quality_foreign_keys(ledger: Ledger) -> DataFrame:
    """Every documented foreign key of the raw tables, the warehouse and the uploads.

    The key columns of a table that joins or ranks rows are made once and stored for all relations that name it.
    """
    ledger.keep("normalised_rows")
    work = scratch_dir(ledger.spark, "keys")
    ends = [end for child, fk, parent, pk in FOREIGN_KEYS for end in ((child, fk), (parent, pk))]
    stored: dict[str, DataFrame] = {}
    for name in ("raw_invoice_lines", "fact_invoice", "fact_invoice_line", "fact_payment", "fact_bank_transaction",
                 "upload_batches", "statement_lines"):
        keys = getattr(ledger, name).select(*dict.fromkeys(column for table, column in ends if table == name))
        keys.write.parquet(f"{work}/{name}")
        stored[name] = ledger.spark.read.schema(keys.schema).parquet(f"{work}/{name}")

    def table(name: str) -> DataFrame:
        if name in stored:
            return stored[name]
        return _snapshots(ledger, "id") if name == "report_snapshots" else getattr(ledger, name)

    return quality.orphans({f"{child}.{fk}": (table(child), fk, table(parent), pk) for child, fk, parent, pk in FOREIGN_KEYS})


@query
def quality_duplicate_keys(ledger: Ledger) -> DataFrame:
    named = {"report_snapshots": lambda keys: _snapshots(ledger, *keys), "uploaded_rows": lambda _: ledger.statement_rows}
    tables = {name: (named[name](keys) if name in named else getattr(ledger, name), keys) for name, keys in UNIQUE_KEYS.items()}
    tables["delivered_lines"] = (ledger.read("lineitem"), ("l_orderkey", "l_linenumber"))
    tables["account_codes"] = (ledger.raw_accounts, ("tenant_id", "code"))
    return quality.duplicate_key_report(tables)


@query
def quality_run_lifecycle(ledger: Ledger) -> DataFrame:
    return quality.lifecycle_violations(ledger.sync_runs, ledger.sync_run_steps, ledger.sync_checkpoints, ledger.cursor_clock)


@query
def quality_unresolved_lookups(ledger: Ledger) -> DataFrame:
    """Natural keys of all four facts with look-ups that have no row behind them; facts drop those keys, raw rows have them."""
    def keyed(fact: DataFrame, raw: DataFrame, *natural: str) -> DataFrame:
        source = raw.select(F.col("tenant_id").alias("_t"), F.col("source_id").alias("_s"), *natural)
        return fact.join(source, (F.col("tenant_id") == F.col("_t")) & (F.col("source_id") == F.col("_s")), "inner")

    lines = ledger.fact_invoice_line
    invoices = keyed(ledger.fact_invoice.select("tenant_id", "source_id", "dim_contact_id"), ledger.raw_invoices, "contact_id")
    payments = keyed(ledger.fact_payment.select("tenant_id", "source_id", "fact_invoice_id", "dim_account_id"),
                     ledger.raw_payments, "invoice_id", "account_id")
    bank = keyed(ledger.fact_bank_transaction.select("tenant_id", "source_id", "dim_contact_id", "dim_account_id"),
                 ledger.raw_bank_transactions, "contact_id", "bank_account_id")
    return quality.unresolved_lookups({
        "fact_invoice.contact": (invoices, "contact_id", "dim_contact_id"),
        "fact_invoice_line.account": (lines, "account_code", "dim_account_id"),
        "fact_invoice_line.invoice": (lines, "source_invoice_id", "fact_invoice_id"),
        "fact_payment.invoice": (payments, "invoice_id", "fact_invoice_id"),
        "fact_payment.account": (payments, "account_id", "dim_account_id"),
        "fact_bank_transaction.contact": (bank, "contact_id", "dim_contact_id"),
        "fact_bank_transaction.account": (bank, "bank_account_id", "dim_account_id"),
    })


# ── streaming ────────────────────────────────────────────────────────────────

PAYMENT_OUTPUT = ("connection_id", "tenant_id", "source_id", "amount", "status", "reference", "source_updated_at")


ARRIVALS = 3


def _arrivals(ledger: Ledger, landing: str) -> Iterator[DataFrame]:
    """The event table as it would arrive: in parts, one after another, each a stream of what is new in the folder."""
    events = ledger.read("events")
    for part in range(ARRIVALS):
        events.filter(_mod("event_id", ARRIVALS) == part).write.mode("append").parquet(landing)
        yield ledger.spark.readStream.schema(events.schema).parquet(landing)


@query
def stream_incremental_merge(ledger: Ledger) -> DataFrame:
    """Payments arriving as events are merged into a table that already holds half of them."""
    work = scratch_dir(ledger.spark, "payments")
    rule = MERGE_RULES["raw_payments"]
    payments = ledger.raw_payments.select(*PAYMENT_OUTPUT)
    base = payments.filter(F.pmod(F.substring("source_id", 2, 20).cast("bigint"), F.lit(2)) == 0).withColumns(
        {"status": F.lit("PENDING"), "tenant_id": F.lit("first"), "reference": F.lit("old")})
    # the owners are looked up in a stored table, not joined together anew for every micro-batch
    ledger.order_owners().write.parquet(f"{work}/owners")
    owners = ledger.spark.read.parquet(f"{work}/owners")
    change_log.create_log(ledger.spark, f"{work}/log", payments.schema)
    for arrived in _arrivals(ledger, f"{work}/landing"):
        change_log.stream_changes(
            arrived, f"{work}/log", f"{work}/checkpoint", rule.keys,
            [F.desc_nulls_last("source_updated_at"), F.desc("source_id")],
            prepare=lambda batch: ledger.payments_from(batch, owners).select(*PAYMENT_OUTPUT)).awaitTermination()
    log = change_log.read_log(ledger.spark, f"{work}/log", payments.schema)
    return change_log.current_state(base, log, rule.keys, rule.insert_only)


STREAMED_LINE = ("id", "tenant_id", "batch_id", "row_index", "date", "description", "amount", "dedup_hash")


@query
def stream_statement_dedup(ledger: Ledger) -> DataFrame:
    """Events arriving as bank lines; each identity is stored once, however often it arrives."""
    work = scratch_dir(ledger.spark, "lines")

    def lines_of(events: DataFrame) -> DataFrame:
        day, amount = F.col("ts").cast("date"), F.floor("value").cast("decimal(15,2)")
        tenant = _text(_mod("user_id", 5))
        identity = statement_hash(tenant, day, F.col("event_type"), amount)
        return events.select(
            surrogate_key("statement_lines", tenant, identity).alias("id"), tenant.alias("tenant_id"),
            F.concat(F.lit("B"), _text(_mod("user_id", 10))).alias("batch_id"), F.col("event_id").alias("row_index"),
            day.alias("date"), F.col("event_type").alias("description"), amount.alias("amount"),
            identity.alias("dedup_hash"))

    # the table starts with the lines of one event type
    held = statements.dedup(lines_of(ledger.read("events").filter(F.col("event_type") == "click")))
    schema = held.schema
    statement_stream.create_table(held, f"{work}/table")
    for arrived in _arrivals(ledger, f"{work}/landing"):
        statement_stream.stream_lines(arrived, f"{work}/table", f"{work}/checkpoint", schema, lines_of).awaitTermination()
    return statement_stream.read_lines(ledger.spark, f"{work}/table", schema).select(*STREAMED_LINE)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return REGISTRY[name](Ledger(use_ledger_semantics(spark), folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: run(name, spark, folder)
    return {name: bind(name) for name in REGISTRY}

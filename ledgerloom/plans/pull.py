"""One pull of source records: typed, merged into the raw table, cursor moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.merge import checkpoint_advance, keyed_merge, pick_winner
from ledgerloom.schemas import MERGE_RULES
from ledgerloom.sources.payloads import INGEST, legacy_invoices

# Entities whose pulls keep a cursor; accounts and reports are always read in full.
WITH_CURSOR = ("invoices", "contacts", "payments", "bank_transactions", "manual_journals")


def typed_records(payloads: DataFrame, entity: str, synced_at: Column) -> DataFrame:
    """Raw rows of a pull, one per key: a record delivered on two pages counts once, latest first."""
    rows = INGEST[entity](payloads, synced_at)
    latest = [F.desc_nulls_last("source_updated_at")] if "source_updated_at" in rows.columns else []
    return pick_winner(rows, MERGE_RULES[f"raw_{entity}"].keys, [*latest, F.desc("raw")])


def upsert_raw(target: DataFrame, payloads: DataFrame, entity: str, synced_at: Column) -> DataFrame:
    """Raw table after the pull."""
    rule = MERGE_RULES[f"raw_{entity}"]
    return keyed_merge(target, typed_records(payloads, entity, synced_at), rule.keys, rule.insert_only)


def upsert_legacy_invoices(target: DataFrame, payloads: DataFrame, synced_at: Column) -> DataFrame:
    """The older flat invoice table, which also overwrites the type."""
    rule = MERGE_RULES["legacy_invoices"]
    return keyed_merge(target, legacy_invoices(typed_records(payloads, "invoices", synced_at)), rule.keys, rule.insert_only)


def upsert_snapshots(target: DataFrame, snapshots: DataFrame) -> DataFrame:
    rule = MERGE_RULES["raw_report_snapshots"]
    return keyed_merge(target, snapshots, rule.keys, rule.insert_only)


def advance_cursor(checkpoints: DataFrame, pulled: DataFrame, entity: str) -> DataFrame:
    """``pulled``: connection_id, started_at, run_id of the pulls of ``entity`` that succeeded."""
    if entity not in WITH_CURSOR:
        return checkpoints
    moved = pulled.select("connection_id", F.lit(entity).alias("entity"), F.col("started_at").alias("last_modified_at"),
                          F.col("run_id").alias("last_run_id"))
    return checkpoint_advance(checkpoints, moved)

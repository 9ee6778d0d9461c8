"""Data-quality reports. Each is an aggregate over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.merge import duplicate_keys


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def constraint_violations(tables: dict[str, DataFrame], rules: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """Violations per rule; all rules of a table are counted in one pass over it.

    As with a CHECK clause, a condition that is unknown (null) is not a violation.
    """
    by_table: dict[str, list[tuple[str, str]]] = {}
    for table, name, condition in rules:
        if table in tables:
            by_table.setdefault(table, []).append((name, condition))
    parts = []
    for table, checks in by_table.items():
        counted = tables[table].agg(*[F.count_if(~F.expr(cond)).alias(name) for name, cond in checks])
        parts.append(counted.unpivot([], [name for name, _ in checks], "rule_name", "violations")
                     .select(F.lit(table).alias("table_name"), "rule_name", "violations"))
    return _union(parts)


def orphans(relations: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Child rows with a foreign key that has no parent, per relation. Null keys are no orphans."""
    parts = []
    for name, (child, fk, parent, pk) in relations.items():
        # one row per distinct key before the join: a hot key costs one row per map task
        keys = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        known = parent.select(F.col(pk).alias("_key"))
        lost = keys.join(known, "_key", "left_anti")
        parts.append(lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))
                     .select(F.lit(name).alias("relation"), "orphans"))
    return _union(parts)


def duplicate_key_report(tables: dict[str, tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """Per table: keys that occur more than once and the rows they cover."""
    parts = []
    for name, (df, keys) in tables.items():
        repeated = duplicate_keys(df, keys)
        parts.append(repeated.agg(
            F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_involved")
        ).select(F.lit(name).alias("table_name"), "duplicate_keys", "rows_involved"))
    return _union(parts)


def lifecycle_violations(runs: DataFrame, steps: DataFrame, checkpoints: DataFrame, as_of) -> DataFrame:
    """Rules on the run log: durations, invoice step counts, cursors not in the future."""
    run_rules = runs.agg(
        F.count_if((F.col("status") == "completed") & F.col("duration_ms").isNull()).alias("completed_run_without_duration"),
        F.count_if((F.col("status") == "failed") & F.col("error").isNull()).alias("failed_run_without_error"),
    )
    step_rules = steps.agg(F.count_if(
        (F.col("entity") == "invoices") & (F.col("status") == "completed") & (F.col("records_synced") <= 0)
    ).alias("completed_invoice_step_without_records"))
    cursor_rules = checkpoints.agg(F.count_if(F.col("last_modified_at") > as_of).alias("cursor_in_future"))
    return _union([
        part.unpivot([], part.columns, "rule_name", "violations") for part in (run_rules, step_rules, cursor_rules)
    ])


def unresolved_lookups(facts: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Per fact lookup: rows with a natural key but no dimension row behind it."""
    parts = []
    for name, (df, natural_key, resolved) in facts.items():
        missing = F.col(natural_key).isNotNull() & F.col(resolved).isNull()
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(missing).alias("unresolved"))
                     .select(F.lit(name).alias("lookup"), "row_count", "unresolved"))
    return _union(parts)

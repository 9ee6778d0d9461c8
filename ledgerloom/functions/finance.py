"""Receivables and freshness rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions.dates import hours_before

# Fixed values.
SETTLED_STATUSES = ("PAID", "VOIDED", "DELETED")
AGEING_ORDER = ("current", "1-30", "31-60", "61-90", "90+")
FRESH_HOURS = 1
STALE_HOURS = 25


def is_overdue(status: Column, due: Column, as_of: Column) -> Column:
    return ~status.isin(*SETTLED_STATUSES) & due.isNotNull() & (due < as_of)


def days_overdue(status: Column, due: Column, as_of: Column) -> Column:
    """Whole days past due; null (not 0) where nothing is overdue."""
    return F.when(is_overdue(status, due, as_of), F.greatest(F.lit(0), F.date_diff(as_of, due)))


def ageing_bucket(amount_due: Column, overdue_days: Column) -> Column:
    """A null amount does not count as settled: the age decides."""
    return (
        F.when(amount_due <= 0, "current")
        .when(overdue_days.isNull() | (overdue_days == 0), "current")
        .when(overdue_days <= 30, "1-30")
        .when(overdue_days <= 60, "31-60")
        .when(overdue_days <= 90, "61-90")
        .otherwise("90+")
    )


def ageing_rank(bucket: Column) -> Column:
    rank = F.when(bucket == AGEING_ORDER[0], 0)
    for i, name in enumerate(AGEING_ORDER[1:-1], start=1):
        rank = rank.when(bucket == name, i)
    return rank.otherwise(len(AGEING_ORDER) - 1)


def freshness_status(last_modified: Column, as_of: Column) -> Column:
    return (
        F.when(last_modified.isNull(), "never_synced")
        .when(last_modified > hours_before(as_of, FRESH_HOURS), "fresh")
        .when(last_modified > hours_before(as_of, STALE_HOURS), "recent")
        .otherwise("stale")
    )

"""Deterministic identifiers; re-running a job gives every row the same id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions.text import plain_number


def surrogate_key(table: str, *natural_key: Column) -> Column:
    """Id of a natural key; a missing part and a part that holds the separator are told apart from others."""
    def marked(part: Column) -> Column:
        escaped = F.replace(F.replace(part.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        return F.coalesce(escaped, F.lit("\\N"))

    return F.md5(F.concat_ws("|", F.lit(table), *map(marked, natural_key)))


def statement_hash(tenant_id: Column, day: Column, description: Column, amount: Column) -> Column:
    """Identity of a bank line; reference and currency take no part in it."""
    return F.md5(F.concat_ws("|", tenant_id, F.date_format(day, "yyyy-MM-dd"), description, plain_number(amount)))

"""Bank-statement rows: normalise, isolate errors, deduplicate, summarise batches.

Input: ``batch_id, tenant_id, row_index, raw map<string,string>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.dates import calendar_date, statement_date_text
from ledgerloom.functions.keys import statement_hash, surrogate_key
from ledgerloom.functions.text import field_map, header_entries, money_text_to_number, pick_field, row_json
from ledgerloom.operators.merge import new_rows, pick_winner
from ledgerloom.schemas import (
    AMOUNT_HEADERS, CREDIT_HEADERS, DATE_HEADERS, DEBIT_HEADERS, DEFAULT_CURRENCY, DESCRIPTION_HEADERS,
    REFERENCE_HEADERS,
)

# Fixed value: messages that the error column of a batch shows; all of them are rows of ``error_rows``.
SHOWN_ERRORS = 5


def statement_amount(single: Column, debit: Column, credit: Column) -> Column:
    """Signed amount; zero is valid in a single column but not in split columns."""
    one, out, into = (money_text_to_number(c) for c in (single, debit, credit))
    return (
        F.when(one.isNotNull(), one)
        .when(out.isNotNull() & (out != 0), -F.abs(out))
        .when(into.isNotNull() & (into != 0), F.abs(into))
    )


def pick_fields(rows: DataFrame) -> DataFrame:
    """The text of each field under whichever header it was delivered."""
    fields = F.col("fields")
    opened = rows.withColumn("entries", header_entries(F.col("raw"))).withColumn("fields", field_map(F.col("entries")))
    return opened.select(
        "batch_id", "tenant_id", "row_index", "entries",
        pick_field(fields, DATE_HEADERS).alias("date_text"),
        pick_field(fields, DESCRIPTION_HEADERS).alias("description"),
        pick_field(fields, AMOUNT_HEADERS).alias("amount_text"),
        pick_field(fields, DEBIT_HEADERS).alias("debit_text"),
        pick_field(fields, CREDIT_HEADERS).alias("credit_text"),
        pick_field(fields, REFERENCE_HEADERS).alias("reference"),
    )


def normalise(rows: DataFrame, currency: str = DEFAULT_CURRENCY) -> DataFrame:
    """Typed line per row. ``error`` is null for good rows, else the first problem found.

    Order of checks: date present, description present, date readable, amount readable,
    then what the typed columns reject (impossible day, amount beyond 15 digits).
    """
    fields = pick_fields(rows).withColumn("iso", statement_date_text(F.col("date_text")))
    fields = fields.withColumn("date", calendar_date(F.col("iso"))).withColumn(
        "exact", statement_amount(F.col("amount_text"), F.col("debit_text"), F.col("credit_text")))
    fields = fields.withColumn("amount", F.col("exact").try_cast("decimal(15,2)"))
    text = row_json(F.col("entries"))
    error = (
        F.when(F.col("date_text").isNull(), F.concat(F.lit("Missing date in row: "), text))
        .when(F.col("description").isNull(), F.concat(F.lit("Missing description in row: "), text))
        .when(F.col("iso").isNull(), F.concat(F.lit('Cannot parse date: "'), F.col("date_text"), F.lit('"')))
        .when(F.col("exact").isNull(), F.concat(F.lit("Cannot parse amount from row: "), text))
        .when(F.col("date").isNull(), F.concat(F.lit('date/time field value out of range: "'), F.col("iso"), F.lit('"')))
        .when(F.col("amount").isNull(), F.lit("numeric field overflow"))
    )
    return _evaluated(
        fields, "batch_id", "tenant_id", "row_index", "date", "description", "amount", "reference",
        F.lit(currency).alias("currency_code"),
        statement_hash(F.col("tenant_id"), F.col("date"), F.col("description"), F.col("exact")).alias("dedup_hash"),
        error.alias("error"),
    )


def _evaluated(df: DataFrame, *columns) -> DataFrame:
    """Select ``columns`` behind a one-element explode.

    A filter on ``error`` would otherwise be pushed below the parsing expressions, which
    repeats all of them inside the filter condition. Filters stop at a generator.
    """
    return df.select(F.explode(F.array(F.struct(*columns))).alias("_row")).select("_row.*")


def good_rows(normalised: DataFrame) -> DataFrame:
    return normalised.filter(F.col("error").isNull()).drop("error")


def error_rows(normalised: DataFrame) -> DataFrame:
    return normalised.filter(F.col("error").isNotNull()).select("batch_id", "tenant_id", "row_index", "error")


def to_lines(good: DataFrame, created_at: Column) -> DataFrame:
    """Good rows in the shape of the statement-line table, not yet coded or approved."""
    return good.select(
        surrogate_key("statement_lines", F.col("tenant_id"), F.col("dedup_hash")).alias("id"),
        "tenant_id", "batch_id", "row_index", "date", "description", "amount", "reference", "currency_code",
        *[F.lit(None).cast("string").alias(c) for c in ("account_code", "account_name", "category", "tax_type", "notes")],
        F.lit(False).alias("is_suggested"), F.lit(False).alias("approved"),
        F.lit(None).cast("string").alias("approved_by"), F.lit(None).cast("timestamp_ntz").alias("approved_at"),
        "dedup_hash", created_at.alias("created_at"), created_at.alias("updated_at"),
    )


IDENTITY = ("tenant_id", "dedup_hash")


def first_arrivals() -> list[Column]:
    """Earlier batch first, then earlier row."""
    return [F.asc("batch_id"), F.asc("row_index")]


def dedup(lines: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Lines that are new: first arrival per identity, minus what the table already holds."""
    if existing is None:
        return pick_winner(lines, IDENTITY, first_arrivals())
    return new_rows(existing, lines, IDENTITY, first_arrivals())


def batch_summary(normalised: DataFrame, headers: DataFrame, completed_at: Column,
                  inserted: DataFrame | None = None, shown_errors: int = SHOWN_ERRORS) -> DataFrame:
    """Outcome per batch. ``processed`` counts good rows, also those that were duplicates.

    ``error`` shows the first ``shown_errors`` messages; the full list is ``error_rows``.

    Counts are pre-aggregated; only the first messages of a batch are brought together, so a
    batch of any size costs a few rows per task.
    """
    failed = F.col("error").isNotNull()
    counts = normalised.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(failed).alias("skipped"))
    w = Window.partitionBy("batch_id").orderBy("row_index")
    messages = (
        normalised.filter(failed).select("batch_id", "row_index", "error")
        .withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= shown_errors)
        .groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("_n", "error"))).alias("_first"))
        .select("batch_id", F.array_join(F.transform("_first", lambda e: e["error"]), "; ").alias("error"))
    )
    out = headers.drop("row_count", "status", "error").withColumnRenamed("id", "batch_id")
    out = out.join(counts, "batch_id", "left").join(messages, "batch_id", "left")
    rows, skipped = F.coalesce("rows", F.lit(0)), F.coalesce("skipped", F.lit(0))
    out = out.withColumns({
        "status": F.when((rows > 0) & (skipped == rows), "failed").otherwise("completed"),
        "processed": (rows - skipped).cast("bigint"),
        "skipped": skipped.cast("bigint"),
        "row_count": (rows - skipped).cast("int"),
        "completed_at": completed_at,
    }).drop("rows")
    if inserted is not None:
        landed = inserted.groupBy("batch_id").agg(F.count(F.lit(1)).alias("inserted"))
        out = out.join(landed, "batch_id", "left").withColumn("inserted", F.coalesce("inserted", F.lit(0)))
    return out


def process_upload(rows: DataFrame, headers: DataFrame, existing: DataFrame, now: Column,
                   currency: str = DEFAULT_CURRENCY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One upload run: lines to append to ``existing``, errors by row, and batch outcomes."""
    checked = normalise(rows, currency)
    fresh = dedup(to_lines(good_rows(checked), now), existing)
    return fresh, error_rows(checked), batch_summary(checked, headers, now, fresh)

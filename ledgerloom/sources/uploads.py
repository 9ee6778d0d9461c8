"""Uploaded bank-statement files -> (batch_id, tenant_id, row_index, raw map)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerloom.operators.joins import attach
from ledgerloom.operators.merge import keyed_insert_ignore
from ledgerloom.sources import csv_records


def number_rows(df: DataFrame, group: Sequence[str], block: Column, order: Column, name: str = "row_index") -> DataFrame:
    """0-based position of each row within ``group``, without sorting a group in one task.

    ``block`` cuts a group into consecutive, bounded pieces of the ``order``. Rows are
    numbered inside each piece and shifted by the row count of the pieces before it.
    """
    blocked = df.withColumn("_block", block)
    pieces = blocked.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(*group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_block").orderBy(order)
    numbered = blocked.withColumn("_at", F.row_number().over(inside))
    return numbered.join(offsets, [*group, "_block"], "inner").select(
        *df.columns, (F.col("_at") - 1 + F.col("_offset")).cast("int").alias(name)
    )


def _file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their file and what tells their order in it."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("batch_id"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_seq"), F.col("value").alias("_line"))


def _numbered(rows: DataFrame, tenant_id: str) -> DataFrame:
    rows = rows.select("batch_id", F.lit(tenant_id).alias("tenant_id"), "_start", "_seq", "raw")
    return number_rows(rows, ["batch_id"], F.col("_start"), F.col("_seq")).drop("_start", "_seq")


def read_statement_csv(spark: SparkSession, path: str, tenant_id: str, separator: str = ",") -> DataFrame:
    """CSV files, each with a header line of its own; every file is one batch, every row a map of its cells.

    Cells go by the header of their own file, whatever the other files of the folder look like. Of a name that a
    header repeats the last cell counts, cells without a name are left out, missing cells are empty. Quoted cells can
    hold separators, doubled quotes and line ends, also across the splits of a file; a quote that its file never closes
    ends with its line. Empty lines between records are no rows. Splits are numbered independently and put together by
    their start offset. Nothing is read before the result is.
    """
    rows = csv_records.records(_file_lines(spark, path), separator).filter(F.trim("_line") != "")
    place = F.struct("_start", "_seq")
    # one row a file
    headers = rows.groupBy("batch_id").agg(F.min(place).alias("_header_at"), F.min_by("_line", place).alias("_head"))
    names = csv_records.cells(F.regexp_replace("_head", "^\ufeff", ""), separator)
    named = F.filter(F.transform(names, lambda n, i: F.struct(n.alias("name"), i.alias("at"))), lambda x: (
        x["name"] != "") & (x["at"] + 1 == F.size(F.col("_names")) - F.array_position(F.reverse(F.col("_names")), x["name"]) + 1))
    headers = headers.withColumn("_names", names).select(
        F.col("batch_id").alias("_file"), "_header_at", named.alias("_named"))
    found = attach(rows, headers, {"batch_id": "_file"}, {"_header_at": "_header_at", "_named": "_named"},
                   ("batch_id", "_seq"), how="inner", hot_keys=True).filter(place != F.col("_header_at"))
    found = found.withColumn("_cells", csv_records.cells(F.col("_line"), separator))
    raw = F.map_from_entries(F.transform("_named", lambda x: F.struct(
        x["name"], F.coalesce(F.get("_cells", x["at"]), F.lit("")))))
    return _numbered(found.withColumn("raw", raw), tenant_id)


def read_statement_json(spark: SparkSession, path: str, tenant_id: str) -> DataFrame:
    """Uploads as JSON objects, one per line; lines that are no object become rows without cells, which are errors."""
    lines = _file_lines(spark, path).filter(F.trim("_line") != "")
    cells = F.from_json("_line", "map<string,string>")
    return _numbered(lines.withColumn("raw", F.coalesce(cells, F.create_map().cast("map<string,string>"))), tenant_id)


def store_rows(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Uploaded rows kept verbatim; a row that was stored before stays as it is."""
    return keyed_insert_ignore(existing, rows, ["batch_id", "row_index"], [F.asc("tenant_id")])


def batch_headers(rows: DataFrame, created_at: Column, filename: Column | None = None) -> DataFrame:
    """Header row per upload batch, as it stands before processing."""
    name = F.col("batch_id") if filename is None else filename
    return rows.groupBy("batch_id", "tenant_id").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.col("batch_id").alias("id"), "tenant_id", name.alias("filename"),
        F.col("row_count").cast("int").alias("row_count"),
        F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error"),
        created_at.alias("created_at"),
    )

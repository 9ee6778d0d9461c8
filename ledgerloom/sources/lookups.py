"""Small reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.schemas import BUSINESS_TYPES, DEFAULT_CURRENCY, DEFAULT_FISCAL_YEAR_END


def business_types(spark: SparkSession) -> DataFrame:
    """The fixed business types as an inline relation, whose size the optimizer knows."""
    rows = ", ".join(f"({i}, '{name}', '{text}')" for i, name, text in BUSINESS_TYPES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(id, name, description)")


def client_metadata(metadata: DataFrame, types: DataFrame) -> DataFrame:
    """Client settings with their defaults filled in and the business type named."""
    named = types.select(F.col("id").alias("_type"), F.col("name").alias("business_type"))
    return metadata.join(named, F.col("business_type_id") == F.col("_type"), "left").select(
        "tenant_id", "business_type_id", "business_type",
        F.coalesce("base_currency", F.lit(DEFAULT_CURRENCY)).alias("base_currency"),
        F.coalesce("fiscal_year_end_month", F.lit(DEFAULT_FISCAL_YEAR_END)).alias("fiscal_year_end_month"),
        F.coalesce("vat_registered", F.lit(False)).alias("vat_registered"),
        "vat_scheme", "primary_bank_account", "notes",
    )

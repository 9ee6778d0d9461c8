"""Helpers shared by the text operators: shared scratch tables and bounded filters of keys."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Width of a filter in bits; its table has at most ``SLOTS / 32768`` rows of 4 KB, that is 8 MB.
SLOTS = 1 << 26
_BITS_PER_ROW = 32768


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Only a local session may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application; they need not have it installed."""
    context = spark.sparkContext
    if any("ledgerloom-code" in f for f in context.listFiles):
        return
    top = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(), f"ledgerloom-code-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in [top / "__init__.py", *sorted((top / "llm").glob("*.py"))]:
            archive.write(file, file.relative_to(top.parent))
    context.addPyFile(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _slot(keys: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(7)), F.lit(SLOTS)) + 1


def repeated_filter(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Bitmap of the hash slots that two or more rows of ``df`` share.

    Counting is by slot, so state and result are bounded by ``SLOTS`` however many keys there are. A slot may be
    shared by chance; the filter lets such a key through and never loses a repeated one.
    """
    return _bitmap(df.groupBy(_slot(keys).alias("slot")).count().where("count > 1"))


def present_filter(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Bitmap of the hash slots of all keys of ``df``; bounded like :func:`repeated_filter`."""
    return _bitmap(df.select(_slot(keys).alias("slot")).distinct())


def _bitmap(slots: DataFrame) -> DataFrame:
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("__bitmap"))


def mark_found(df: DataFrame, keys: Sequence[Column], found: DataFrame, name: str) -> DataFrame:
    """Add a boolean ``name``: false only for rows whose key is not one that the filter was made to let through."""
    marked = df.withColumn("__slot", _slot(keys))
    joined = marked.join(
        F.broadcast(found.withColumnRenamed("__bucket", "__at")),
        F.bitmap_bucket_number("__slot") == F.col("__at"), "left")
    position = F.bitmap_bit_position("__slot")
    byte = F.conv(F.hex(F.substring("__bitmap", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return joined.withColumn(
        name, F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    ).drop("__slot", "__at", "__bitmap")


def text_of(column: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))

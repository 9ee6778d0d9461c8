"""Lookup joins that stay balanced when a key is missing or hot."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

NULL_SPREAD = 1024
MIN_SALT, MAX_SALT = 16, 1024


def hot_key_salt(df: DataFrame) -> int:
    """Slots per hot key: a quarter of the shuffle partitions, within fixed bounds."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(MIN_SALT, min(MAX_SALT, partitions // 4))


def _spread(keys: Iterable[str], spread_by: tuple[str, ...], salt: int) -> Column:
    row_hash = F.xxhash64(*spread_by)
    any_null = F.lit(False)
    for column in keys:
        any_null = any_null | F.col(column).isNull()
    return F.when(any_null, F.pmod(row_hash, F.lit(NULL_SPREAD)) + salt).otherwise(F.pmod(row_hash, F.lit(salt)))


def placed(facts: DataFrame, keys: Iterable[str], spread_by: tuple[str, ...]) -> DataFrame:
    """Facts dealt as ``attach(placed=True)`` by the same keys needs them, with ``_spread`` added.

    A window within ``keys``, last first, then ``_spread`` takes the rows as they are: one shuffle and one sort serve both.
    """
    keys = tuple(keys)
    return facts.withColumn("_spread", _spread(keys, spread_by, 1)).repartition(*reversed(keys), "_spread")


def attach(facts: DataFrame, lookup: DataFrame, keys: dict[str, str], take: dict[str, str],
           spread_by: tuple[str, ...], how: str = "left", hot_keys: bool = False, few_facts: bool = False,
           placed: bool = False) -> DataFrame:
    """Join ``lookup`` columns onto ``facts``; ``lookup`` must be unique on its keys.

    ``keys`` maps fact columns to lookup columns, ``take`` maps new names to lookup columns.
    Nothing is broadcast by hint: Spark does so below its size threshold, and otherwise
    shuffles both sides. For that case

    * fact rows with a null key can match nothing, yet would all hash to one task; they are
      spread by a hash of ``spread_by``;
    * ``hot_keys=True`` is for lookups with one row per tenant or connection: the fact side is
      salted and the lookup replicated, which Spark still broadcasts where it is small. For
      wide key domains (contacts, accounts, invoices) adaptive skew-join splitting divides a
      hot key at run time without replicating anything;
    * ``few_facts=True`` says that the facts are few against the lookup: it is first cut down to
      the keys in use, a join that can broadcast the facts' keys and leave the lookup where it is;
    * ``placed=True`` says that the facts come from :func:`placed` by these keys; ``_spread`` is dropped.

    All are the caller's to say; the result is the same either way.
    """
    salt = hot_key_salt(facts) if hot_keys else 1
    if few_facts:
        in_use = facts.select(*[F.col(c).alias(k) for c, k in keys.items()]).distinct()
        lookup = lookup.join(in_use, list(keys.values()), "left_semi")
    left = facts if placed else facts.withColumn("_spread", _spread(keys, spread_by, salt))

    right = lookup.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys.values())],
        *[F.col(c).alias(f"_t{i}") for i, c in enumerate(take.values())],
    )
    if salt > 1:
        right = right.withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))
    else:
        # always 0, but tied to the row so that the optimizer keeps it as a join key
        right = right.withColumn("_slot", F.pmod(F.xxhash64("_k0"), F.lit(1)))

    # both sides are sorted in this order: tenants come last, as most comparisons should be over at the first column
    condition = F.lit(True)
    for i, column in reversed([*enumerate(keys)]):
        condition = condition & (F.col(column) == F.col(f"_k{i}"))
    joined = left.join(right, condition & (F.col("_spread") == F.col("_slot")), how)
    return joined.select(
        *[F.col(c) for c in facts.columns if c != "_spread"],
        *[F.col(f"_t{i}").alias(name) for i, name in enumerate(take)],
    )

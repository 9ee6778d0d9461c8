"""Keyed writes as DataFrame functions: the result is the new content of the target.

Parquet cannot be rewritten while it is read, so callers write the result to a fresh path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.text import slugify
from ledgerloom.operators.joins import attach


def pick_winner(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which should end in a unique tie-breaker.

    Spark limits each group to one row before the shuffle, so a key with very many copies
    costs one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails when it meets a key that occurs twice."""
    repeats = df.withColumn("_repeats", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    message = F.concat(F.lit(f"key ({', '.join(keys)}) occurs more than once: "),
                       F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys]))
    once = F.when(F.col("_repeats") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return repeats.filter(once).drop("_repeats")


def keyed_merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
                insert_only: Sequence[str] = (), update_cols: Sequence[str] | None = None,
                order: Sequence[Column] | None = None, small_source: bool = False) -> DataFrame:
    """Upsert ``source`` into ``target``, which is unique on ``keys``.

    Matched rows take every update column from the source, null included; ``insert_only``
    columns keep the value of the first write. ``update_cols=None`` means all other columns.

    A key that the source repeats would multiply rows: with ``order`` the first row in it wins,
    without, the job fails. Either is one pass over the source alone.

    By default both sides are shuffled once on the full key. ``small_source=True`` says that the
    source can be broadcast: the target is then merged where it is. The result is the same.
    """
    columns = target.columns
    insert_only = set(insert_only)
    updated = set(columns) - set(keys) - insert_only if update_cols is None else set(update_cols)
    source = assert_unique(source, keys) if order is None else pick_winner(source, keys, order)
    if small_source:
        return _merge_small_source(target, source, keys, columns, updated)
    return _merge_full_outer(target, source, keys, columns, updated)


def _renamed(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    return source.select(*[F.col(c).alias(f"_s_{c}") for c in columns], F.lit(True).alias("_in_source"))


def _on(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"_s_{key}"))
    return condition


def _merge_full_outer(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      columns: Sequence[str], updated: set[str]) -> DataFrame:
    joined = target.withColumn("_in_target", F.lit(True)).join(_renamed(source, columns), _on(keys), "full_outer")
    in_source, in_target = F.col("_in_source").isNotNull(), F.col("_in_target").isNotNull()
    out = []
    for c in columns:
        take_source = in_source if c in updated else in_source & ~in_target
        out.append(F.when(take_source, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def _merge_small_source(target: DataFrame, source: DataFrame, keys: Sequence[str],
                        columns: Sequence[str], updated: set[str]) -> DataFrame:
    joined = target.join(_renamed(source, columns), _on(keys), "left")
    kept = joined.select(*[
        F.when(F.col("_in_source"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
        for c in columns
    ])
    return kept.unionByName(not_present(source, target, keys).select(*columns))


def not_present(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks.

    The target is first reduced to the keys that occur in the source: that join can
    broadcast a small source, while a direct anti join would shuffle the whole target.
    """
    wanted = source.select(*keys).distinct()
    taken = target.select(*keys).join(wanted, list(keys), "left_semi")
    return source.join(taken, list(keys), "left_anti")


def keyed_insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                        order: Sequence[Column]) -> DataFrame:
    """Insert rows whose key is new; inside the source the first in ``order`` wins."""
    return target.unionByName(new_rows(target, source, keys, order).select(*target.columns))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return not_present(pick_winner(source, keys, order), target, keys)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def remap_keys(df: DataFrame, mapping: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """Re-point a foreign key old -> new; values without a mapping stay. An old value has one new value."""
    pairs = assert_unique(mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new")), ["_old"])
    joined = attach(df, pairs, {column: "_old"}, {"_new": "_new"}, tuple(df.columns), hot_keys=True)
    return joined.select(*[
        F.coalesce(F.col("_new"), F.col(column)).alias(column) if c == column else F.col(c) for c in df.columns
    ])


def backfill_tenants(connections: DataFrame) -> DataFrame:
    """One tenant per slug of an organisation name; the newest name of a slug wins."""
    named = connections.select(slugify(F.col("org_name")).alias("slug"), F.col("org_name").alias("name"),
                               "created_at", "id")
    return pick_winner(named, ["slug"], [F.desc("created_at"), F.desc("id")]).select("slug", "name")


def backfill_connections(connections: DataFrame, tenants: DataFrame, existing: DataFrame) -> DataFrame:
    """Connections re-linked to the tenant of their slug, added where the org is not known yet."""
    by_slug = tenants.select(F.col("slug").alias("_slug"), F.col("id").alias("_tenant"))
    linked = connections.join(by_slug, slugify(F.col("org_name")) == F.col("_slug"), "inner")
    columns = [F.col("_tenant").alias("tenant_id") if c == "tenant_id" else F.col(c) for c in connections.columns]
    return keyed_insert_ignore(existing, linked.select(*columns), ["source_org_id"], [F.asc("id")])


# The columns an accountant may edit on a statement line.
EDITABLE = ("account_code", "account_name", "category", "tax_type", "notes", "approved", "approved_by")


def apply_line_edits(lines: DataFrame, edits: DataFrame, now: Column,
                     order: Sequence[Column] | None = None) -> DataFrame:
    """Sparse patch by line id: a null edit keeps the value, approval is stamped every time.

    Of several edits of a line the first in ``order`` counts; without it they fail the job.
    """
    edits = assert_unique(edits, ["id"]) if order is None else pick_winner(edits, ["id"], order)
    patch = edits.select(F.col("id").alias("_id"), *[F.col(c).alias(f"_e_{c}") for c in EDITABLE])
    joined = lines.join(patch, F.col("id") == F.col("_id"), "left")
    changed = F.col("_id").isNotNull()
    out = {c: F.coalesce(F.col(f"_e_{c}"), F.col(c)) for c in EDITABLE}
    out["approved_at"] = F.when(F.col("_e_approved"), now).otherwise(F.col("approved_at"))
    out["updated_at"] = F.when(changed, now).otherwise(F.col("updated_at"))
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in lines.columns])


def checkpoint_advance(checkpoints: DataFrame, finished: DataFrame) -> DataFrame:
    """Move cursors to the start of the finished pulls (not to the newest record seen)."""
    return keyed_merge(checkpoints, finished, ["connection_id", "entity"])


def deactivate(connections: DataFrame, removed: DataFrame, now: Column) -> DataFrame:
    """Soft delete: flag the connections listed in ``removed`` (column ``id``)."""
    return _set_active(connections, removed, now, False)


def reactivate(connections: DataFrame, reconnected: DataFrame, now: Column) -> DataFrame:
    return _set_active(connections, reconnected, now, True)


def _set_active(connections: DataFrame, ids: DataFrame, now: Column, active: bool) -> DataFrame:
    marked = ids.select(F.col("id").alias("_id")).distinct()
    joined = attach(connections, marked, {"id": "_id"}, {"_id": "_id"}, ("id",), hot_keys=True)
    hit = F.col("_id").isNotNull()
    out = {
        "is_active": F.when(hit, F.lit(active)).otherwise(F.col("is_active")),
        "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
    }
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in connections.columns])


def cascade_delete(child: DataFrame, removed_parents: DataFrame, foreign_key: str, parent_key: str = "id") -> DataFrame:
    """Child rows that survive the removal of their parents."""
    gone = removed_parents.select(F.col(parent_key).alias("_gone")).distinct()
    marked = attach(child, gone, {foreign_key: "_gone"}, {"_gone": "_gone"}, tuple(child.columns), hot_keys=True)
    return marked.filter(F.col("_gone").isNull()).select(*child.columns)

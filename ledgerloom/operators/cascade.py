"""Deletes that follow foreign keys through any number of tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.joins import attach
from ledgerloom.session import scratch_dir

#: (child table, its columns, parent table, its columns)
Edge = tuple[str, tuple[str, ...], str, tuple[str, ...]]


def delete_order(edges: Iterable[Edge]) -> list[str]:
    """Tables with every parent before its children; a cycle of keys is an error."""
    graph: dict[str, set[str]] = {}
    for child, _, parent, _ in edges:
        graph.setdefault(child, set()).add(parent)
    return list(TopologicalSorter(graph).static_order())


def _pointing(rows: DataFrame, gone: Mapping[str, DataFrame], edges: list[Edge], mark: str) -> DataFrame:
    """Add ``mark``: whether one of the keys of a row points at a row that goes."""
    marked, hits = rows, []
    hashable = tuple(name for name, kind in rows.dtypes if "map<" not in kind and "variant" not in kind)
    for n, (_, columns, parent, keys) in enumerate(edges):
        if parent not in gone:
            continue
        # one row a removed key, as many as a table has rows: never replicated. Few keys, as of hot tenants and batches,
        # are broadcast, and of many a hot one is split at run time
        marked = attach(marked, gone[parent].select(*keys).distinct(), dict(zip(columns, keys, strict=True)),
                        {f"_gone{n}": keys[0]}, spread_by=hashable)
        hits.append(F.col(f"_gone{n}").isNotNull())
    hit = reduce(lambda a, b: a | b, hits, F.lit(False))
    return marked.select(*rows.columns, hit.alias(mark))


def _stored(keys: DataFrame, table: str) -> DataFrame:
    """Removed keys, written once: every child that points at them reads them, and plans stay one level deep."""
    path = f"{scratch_dir(keys.sparkSession, 'gone')}/{table}"
    keys.write.parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path)


def cascade_tables(tables: Mapping[str, DataFrame], removed: Mapping[str, DataFrame], cascades: Iterable[Edge],
                   restricts: Iterable[Edge] = ()) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Remove rows and all that hangs on them: survivors of every table that loses any, and what stands in the way.

    ``removed`` gives the keys (by the columns that edges use) of the rows to remove, by table. Tables are walked with
    parents first; the frontier of a level is the removed rows' keys alone, which are stored, so only key columns are
    read until the survivors are. The second result has a row per edge of ``restricts`` (``relation``, ``rows``): rows that would stay
    and point at a row that goes. A caller who wants the database's rule deletes nothing while one of them is not zero.
    """
    cascades, restricts = list(cascades), list(restricts)
    survivors: dict[str, DataFrame] = {}
    gone: dict[str, DataFrame] = dict(removed)
    for table in [*(t for t in removed if t not in delete_order(cascades)), *delete_order(cascades)]:
        edges = [e for e in cascades if e[0] == table and e[2] in gone]
        roots = removed.get(table)
        if table not in tables or (not edges and roots is None):
            continue
        own = [] if roots is None else [(table, tuple(roots.columns), table, tuple(roots.columns))]
        marks = {**gone, **({table: roots} if roots is not None else {})}
        marked = _pointing(tables[table], marks, [*edges, *own], "_goes")
        survivors[table] = marked.filter(~F.col("_goes")).drop("_goes")
        # the keys that children of this table point at
        used = sorted({k for e in [*cascades, *restricts] if e[2] == table for k in e[3]})
        if used:
            keyed = tables[table].select(*dict.fromkeys([*used, *[c for e in edges for c in e[1]], *(roots.columns if own else ())]))
            gone[table] = _stored(_pointing(keyed, marks, [*edges, *own], "_goes").filter("_goes").select(*used).distinct(), table)
    parts = []
    for child, columns, parent, keys in restricts:
        if parent in gone and child in tables:
            rows = survivors.get(child, tables[child]).select(*columns)
            held = _pointing(rows, gone, [(child, columns, parent, keys)], "_held").agg(
                F.count_if("_held").alias("rows"))
            parts.append(held.select(F.lit(f"{child}.{'+'.join(columns)}").alias("relation"), "rows"))
    return survivors, reduce(DataFrame.unionByName, parts) if parts else None

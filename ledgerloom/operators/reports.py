"""Report trees -> flat rows.

A snapshot is one JSON document in one row. Its tree is opened with array functions inside
that row and exploded with its position, so a flatten needs no shuffle, sort or window and
``row_order`` is the position itself.

Input: ``id, tenant_id, period_date, period_from, raw``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.keys import surrogate_key
from ledgerloom.functions.text import report_amount

# Row types of a report and the default names of rows without one.
SECTION, ROW, SUMMARY = "Section", "Row", "SummaryRow"
DEFAULT_ROW_NAME, DEFAULT_SUMMARY_NAME, DEFAULT_TOP_SUMMARY_NAME = "", "Total", "Net Profit"
ACCOUNT_ATTRIBUTE = "account"

CELLS = "array<struct<Value:string,Attributes:array<struct<Id:string,Value:string>>>>"


def _rows_of(node: Column) -> Column:
    """Child rows of a tree node, in order; empty where there are none."""
    return F.coalesce(F.try_variant_get(node, "$.Rows", "array<variant>"), F.array().cast("array<variant>"))


def _text(node: Column, path: str) -> Column:
    return F.try_variant_get(node, path, "string")


def _tree(raw: Column) -> Column:
    """Root of a snapshot as a variant; a document stored as a JSON string is parsed twice."""
    unwrapped = F.try_variant_get(F.try_parse_json(raw), "$", "string")
    return F.try_parse_json(F.when(raw.rlike(r'^\s*"'), unwrapped).otherwise(raw))


def _node(node: Column, section: Column, sub_section: Column, depth: Column) -> Column:
    return F.struct(
        node.alias("node"), _text(node, "$.RowType").alias("row_type"),
        section.cast("string").alias("section"), sub_section.cast("string").alias("sub_section"),
        depth.cast("int").alias("depth"),
    )


def _top_level(snapshots: DataFrame) -> DataFrame:
    null = F.lit(None)
    opened = snapshots.withColumn("_root", _rows_of(_tree(F.col("raw")))).drop("raw")
    nodes = F.transform("_root", lambda n: _node(n, null, null, F.lit(0)))
    return opened.withColumn("nodes", nodes).drop("_root")


def _open_sections(nodes: Column, open_one) -> Column:
    """Replace every Section by its children, in place, so document order is kept."""
    return F.flatten(F.transform(
        nodes,
        lambda n: F.when(n["row_type"] == SECTION, F.transform(_rows_of(n["node"]), lambda child: open_one(n, child)))
        .otherwise(F.array(n)),
    ))


def _account_id(cells: Column) -> Column:
    found = F.filter(F.get(cells, F.lit(0))["Attributes"], lambda a: a["Id"] == ACCOUNT_ATTRIBUTE)
    return F.get(found, F.lit(0))["Value"]


def _emit(df: DataFrame, extra: dict[str, Column]) -> DataFrame:
    """Explode ``nodes`` into Row / SummaryRow records with their position."""
    listed = F.filter("nodes", lambda n: n["row_type"].isin(ROW, SUMMARY))
    rows = df.select("*", F.posexplode(listed).alias("row_order", "n")).drop("nodes")
    rows = rows.withColumn("cells", F.try_variant_get("n.node", "$.Cells", CELLS))
    is_row = F.col("n.row_type") == ROW
    top_default = extra.pop("_top_default", F.lit(DEFAULT_SUMMARY_NAME))
    default = F.when(is_row, DEFAULT_ROW_NAME).when(F.col("n.depth") == 0, top_default).otherwise(DEFAULT_SUMMARY_NAME)
    return rows.select(
        F.col("id").alias("snapshot_id"), "tenant_id", "period_date", "period_from", "row_order",
        F.col("n.section").alias("section"), F.col("n.sub_section").alias("sub_section"),
        F.when(is_row, _account_id(F.col("cells"))).alias("account_source_id"),
        F.coalesce(F.get("cells", F.lit(0))["Value"], default).alias("account_name"),
        *[c.alias(name) for name, c in extra.items()],
        F.when(is_row, "row").otherwise("summary").alias("row_type"),
    )


def _cell_amount(i: int) -> Column:
    return report_amount(F.get(F.col("cells"), F.lit(i))["Value"])


def _with_id(table: str, rows: DataFrame, columns: list) -> DataFrame:
    key = surrogate_key(table, F.col("snapshot_id"), F.col("row_order").cast("string"))
    return rows.select(key.alias("id"), *columns)


def flatten_trial_balance(snapshots: DataFrame) -> DataFrame:
    """Direct rows of each section; rows outside a section and deeper sections are left out."""
    top = _top_level(snapshots)
    sections = F.filter("nodes", lambda n: n["row_type"] == SECTION)
    null = F.lit(None)
    opened = top.withColumn("nodes", _open_sections(sections, lambda n, child: _node(child, null, null, F.lit(1))))
    rows = _emit(opened, {"debit": _cell_amount(1), "credit": _cell_amount(2),
                          "ytd_debit": _cell_amount(3), "ytd_credit": _cell_amount(4)})
    return _with_id("fact_trial_balance_snapshot", rows, [
        "snapshot_id", "tenant_id", "period_date", "row_order", "account_source_id", "account_name",
        "debit", "credit", "ytd_debit", "ytd_credit", "row_type"])


def flatten_profit_and_loss(snapshots: DataFrame) -> DataFrame:
    """Rows of each section under its title, and summaries between the sections."""
    top = _top_level(snapshots)
    wanted = F.filter("nodes", lambda n: n["row_type"].isin(SECTION, SUMMARY))
    opened = top.withColumn("nodes", _open_sections(
        wanted, lambda n, child: _node(child, _text(n["node"], "$.Title"), F.lit(None), F.lit(1))))
    rows = _emit(opened, {"value": _cell_amount(1), "_top_default": F.lit(DEFAULT_TOP_SUMMARY_NAME)})
    return _with_id("fact_profit_and_loss_snapshot", rows, [
        "snapshot_id", "tenant_id", "period_from", F.col("period_date").alias("period_to"), "row_order", "section",
        "account_source_id", "account_name", "value", "row_type"])


def flatten_balance_sheet(snapshots: DataFrame) -> DataFrame:
    """Rows at any depth: outermost title is the section, innermost the sub-section.

    A top section without title hands its role to its children. Sections are opened level by level, each tree as
    often as it has levels; the number of child lists in its text is an upper bound of that.
    """
    opened = _top_level(snapshots.withColumn("_lists", F.regexp_count("raw", F.lit(r'\\?"Rows\\?"'))))

    def open_one(n: Column, child: Column) -> Column:
        title = _text(n["node"], "$.Title")
        return _node(child, F.coalesce(n["section"], title),
                     F.when(n["section"].isNotNull(), title), n["depth"] + 1)

    def next_level(nodes: Column, _: Column) -> Column:
        left = F.exists(nodes, lambda n: n["row_type"] == SECTION)
        return F.when(left, _open_sections(nodes, open_one)).otherwise(nodes)

    levels = F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("_lists")))
    opened = opened.withColumn("nodes", F.reduce(levels, F.col("nodes"), next_level)).drop("_lists")
    rows = _emit(opened, {"value": _cell_amount(1)})
    return _with_id("fact_balance_sheet_snapshot", rows, [
        "snapshot_id", "tenant_id", "period_date", "row_order", "section", "sub_section", "account_source_id",
        "account_name", "value", "row_type"])


def replace_snapshots(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Replace all rows of the snapshots in ``rows``; a report that shrank leaves no stale tail."""
    fresh = rows.select("snapshot_id").distinct()
    return target.join(fresh, "snapshot_id", "left_anti").unionByName(rows).select(*target.columns)

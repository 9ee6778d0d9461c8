"""CSV text -> records and cells, with line ends inside quoted cells, without giving a file to one task.

A line changes whether one stands inside a quoted cell in one of four ways: not at all, by turning it round, or by
setting it to inside or outside whatever it was. Such steps can be put together in any grouping, so splits of a file are
looked at apart, their steps are combined per split, and every line learns how it begins.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

_BOTH, _OPENS, _CLOSES = "\x01", "\x02", "\x03"
LINE = ("batch_id", "_start", "_seq", "_line")


def quote_steps(line: Column, separator: str = ",") -> tuple[Column, Column]:
    """What a line does to the state "inside a quoted cell": (value it sets or null, whether it then turns it round).

    A quote counts where a cell begins or ends: one after a separator opens, one before a separator closes, one between
    two separators does either. Doubled quotes and quotes amid a cell are text.
    """
    sep = re.escape(separator)
    steps = F.replace(line, F.lit('""'), F.lit(""))
    steps = F.regexp_replace(steps, f'(?<![^{sep}])"(?![^{sep}])', _BOTH)
    steps = F.regexp_replace(steps, f'(?<![^{sep}])"', _OPENS)
    steps = F.regexp_replace(steps, f'"(?![^{sep}])', _CLOSES)
    # only the last quote that sets the state counts, and those after it that turn it round
    steps = F.when(F.contains(line, F.lit('"')), F.regexp_replace(steps, f"[^{_BOTH}{_OPENS}{_CLOSES}]", "")).otherwise("")
    last = F.regexp_extract(steps, f"([{_OPENS}{_CLOSES}])[{_BOTH}]*$", 1)
    turns = F.length(F.regexp_extract(steps, f"[{_BOTH}]*$", 0)) % 2
    sets = F.when(last == _OPENS, 1).when(last == _CLOSES, 0)
    return sets.bitwiseXOR(turns), F.when(sets.isNull(), turns).otherwise(0)


def _flipped(state: Column, turns: Column) -> Column:
    return state.bitwiseXOR((turns % 2).cast("int"))


def records(lines: DataFrame, separator: str = ",") -> DataFrame:
    """Lines (``batch_id``, ``_start`` of the split, ``_seq`` in it, ``_line``) -> the same columns, one row a record.

    A record that goes over several lines has the place of its first. A quoted cell that its file never closes ends with
    its line, and so do the lines behind it. Splits are summed up in one row each; a task holds a split or a record.
    """
    sets, turn = quote_steps(F.col("_line"), separator)
    split = Window.partitionBy("batch_id", "_start").orderBy("_seq")
    upto, before = (split.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    stepped = lines.select(*LINE, sets.alias("_sets"), turn.alias("_turn"))
    turned = stepped.withColumn("_turns", F.sum("_turn").over(upto))
    # a value set, as if no line of the split before it turned anything: xor with the turns gives the state back
    turned = turned.withColumn("_fixed", _flipped(F.col("_sets"), F.col("_turns")))
    known = turned.select(
        *LINE, "_turns", "_fixed", "_turn",
        F.last("_fixed", ignorenulls=True).over(before).alias("_fixed_before"),
        F.last("_fixed", ignorenulls=True).over(upto).alias("_fixed_after"))
    turns_before = F.col("_turns") - F.col("_turn")

    def begins(inside: Column) -> Column:
        return _flipped(F.coalesce("_fixed_before", inside), turns_before) == 0

    splits = known.groupBy("batch_id", "_start").agg(
        F.max_by(F.when(F.col("_fixed").isNotNull(), F.col("_fixed")), F.when(F.col("_fixed").isNotNull(), F.col("_seq"))).alias("_fixed"),
        F.max("_turns").alias("_turns"),
        F.max(F.when(begins(F.lit(0)), F.col("_seq"))).alias("_last0"), F.max(F.when(begins(F.lit(1)), F.col("_seq"))).alias("_last1"))
    of_file = Window.partitionBy("batch_id").orderBy("_start")
    earlier, whole = of_file.rowsBetween(Window.unboundedPreceding, -1), of_file.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    # the same once more, from split to split
    splits = splits.withColumns({
        "_set": _flipped(F.col("_fixed"), F.col("_turns")), "_own": F.when(F.col("_fixed").isNull(), F.col("_turns") % 2).otherwise(0)})
    splits = splits.withColumn("_sum", F.sum("_own").over(of_file.rowsBetween(Window.unboundedPreceding, 0)))
    splits = splits.withColumn("_held", _flipped(F.col("_set"), F.col("_sum")))
    splits = splits.withColumn("_inside", _flipped(
        F.coalesce(F.last("_held", ignorenulls=True).over(earlier), F.lit(0)), F.col("_sum") - F.col("_own")))
    last = F.when(F.col("_inside") == 0, F.col("_last0")).otherwise(F.col("_last1"))
    splits = splits.withColumn("_begun", F.when(last.isNotNull(), F.struct(F.col("_start").alias("start"), last.alias("seq"))))
    splits = splits.withColumn("_ends", _flipped(F.coalesce("_fixed", "_inside"), F.col("_turns")))
    splits = splits.select(
        F.col("batch_id").alias("_file"), F.col("_start").alias("_split"), "_inside",
        F.last("_begun", ignorenulls=True).over(earlier).alias("_carried"),
        F.when(F.last("_ends").over(whole) == 1, F.last("_begun", ignorenulls=True).over(whole)).alias("_open"))

    placed = known.join(splits, (F.col("batch_id") == F.col("_file")) & (F.col("_start") == F.col("_split")), "inner")
    placed = placed.withColumns({
        "_begins": begins(F.col("_inside")), "_after": _flipped(F.coalesce("_fixed_after", "_inside"), F.col("_turns"))})
    begun = F.last(F.when(F.col("_begins"), F.struct(F.col("_start").alias("start"), F.col("_seq").alias("seq"))), ignorenulls=True)
    placed = placed.withColumn("_of", F.coalesce(begun.over(upto), F.col("_carried")))
    # lines of a cell that is never closed stand for themselves
    placed = placed.withColumn("_alone", F.coalesce(F.col("_of") == F.col("_open"), F.lit(False)) | (
        F.col("_begins") & (F.col("_after") == 0)))
    alone = placed.filter("_alone").select(*LINE)
    joined = placed.filter("NOT _alone").groupBy("batch_id", F.col("_of.start").alias("_first"), F.col("_of.seq").alias("_at")).agg(
        F.array_sort(F.collect_list(F.struct("_start", "_seq", "_line"))).alias("_lines"))
    joined = joined.select("batch_id", F.col("_first").alias("_start"), F.col("_at").alias("_seq"),
                           F.array_join(F.col("_lines")["_line"], "\n").alias("_line"))
    return alone.unionByName(joined)


def cells(record: Column, separator: str = ",") -> Column:
    """Cells of a record, as many as it has, found in one pass; quotes around a cell go, doubled ones in it are one."""
    sep = re.escape(separator)
    quoted = rf'"[^"]*+(?:""[^"]*+)*+"(?![^{sep}])'
    found = F.regexp_extract_all(F.concat(F.lit(separator), record), F.lit(f"{sep}({quoted}|[^{sep}]*+)"), F.lit(1))
    return F.transform(found, lambda c: F.when(
        c.rlike(r'^"[^"]*+(?:""[^"]*+)*+"\z'),
        F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))

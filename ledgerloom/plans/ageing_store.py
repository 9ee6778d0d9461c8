"""Receivables by due date, kept up from the change log instead of being added up again.

Stored are totals per tenant, invoice type and due date of what is open, so the ageing buckets of any day are a roll-up
of few rows. A load takes its old rows out and puts its new ones in.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions.finance import SETTLED_STATUSES, ageing_bucket, ageing_rank
from ledgerloom.plans.refresh import _stored, read_current
from ledgerloom.schemas import MERGE_RULES
from ledgerloom.streaming import change_log

GROUP = ("tenant_id", "type", "due")
# ``priced`` counts the invoices with an amount: a group without any has no sum.
#: Due date of what is not or no longer due: it never comes.
NEVER = dt.date(9999, 12, 31)
SCHEMA = T.StructType([
    T.StructField("tenant_id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("due", T.DateType()),
    T.StructField("n", T.LongType()), T.StructField("priced", T.LongType()), T.StructField("due_sum", T.DecimalType(38, 2)), T.StructField("largest", T.DecimalType(15, 2))])
_TABLE = "fact_invoice"


def _counting(invoices: DataFrame) -> DataFrame:
    """Invoices that count, with ``due``, the day after which they are overdue."""
    waits = ~F.col("status").isin(*SETTLED_STATUSES) & (F.col("amount_due").isNull() | (F.col("amount_due") > 0))
    due = F.when(waits, F.coalesce("due_date", F.lit(NEVER))).otherwise(F.lit(NEVER))
    return invoices.filter(~F.col("status").isin("VOIDED", "DELETED", "DRAFT")).withColumn("due", due)


def _open_items(invoices: DataFrame) -> DataFrame:
    return _counting(invoices).select(*GROUP, "amount_due")


def _total(items: DataFrame) -> DataFrame:
    return items.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), F.count("amount_due").alias("priced"),
        F.coalesce(F.sum("amount_due"), F.lit(0)).cast("decimal(38,2)").alias("due_sum"), F.max("amount_due").alias("largest"))


def start(invoices: DataFrame, store: str) -> None:
    """Totals of the table as it stands, as load -1."""
    change_log.write_batch(_total(_open_items(invoices)), store, -1)


def read_totals(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    """Totals after all loads, or those before one: the last state of each group, without those that became empty."""
    rows = change_log.read_log(spark, store, SCHEMA)
    if before is not None:
        rows = rows.filter(F.col("batch_id") < before)
    last = rows.groupBy(*GROUP).agg(F.max_by(F.struct("n", "priced", "due_sum", "largest"), "batch_id").alias("s"))
    return last.select(*GROUP, "s.n", "s.priced", "s.due_sum", "s.largest").filter("n > 0")


def _same(left: str, right: str) -> Column:
    condition = F.lit(True)
    for c in GROUP:
        condition = condition & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition


def _signed_items(rows: DataFrame, changes: DataFrame, load_id: int, rule) -> DataFrame:
    """Open items of the changed keys as they were before a load (``sign`` -1) and after it (1), in one pass.

    The states are those of :func:`read_current` with the loads before this one and with this one, too.
    """
    keys, read = list(rule.keys), dict.fromkeys([*rule.keys, "tenant_id", "type", "status", "due_date", "amount_due"])
    first = [c for c in read if c in rule.insert_only]
    latest = [c for c in read if c not in keys and c not in first]
    wanted = changes.filter(F.col("batch_id") == load_id).select(*keys).distinct()
    rows, changes = (df.select(*read, *more).join(wanted, keys, "left_semi") for df, more in ((rows, ()), (changes, ("batch_id",))))
    earlier = F.when(F.col("batch_id") < load_id, F.col("batch_id"))
    folded = changes.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.max_by(F.struct(*latest), earlier).alias("_before"), F.max_by(F.struct(*latest), "batch_id").alias("_after"),
        *([F.min_by(F.struct(*first), "batch_id").alias("_first")] if first else []))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    joined = folded.join(rows.withColumn("_held", F.lit(True)), same, "left")

    def state(sign: int, change: str, there: Column) -> Column:
        held, changed = F.col("_held").isNotNull(), F.col(change).isNotNull()
        value = {k: F.col(f"_k_{k}") for k in keys}
        value |= {c: F.when(held, F.col(c)).otherwise(F.col(f"_first.{c}")) for c in first}
        value |= {c: F.when(changed, F.col(f"{change}.{c}")).otherwise(F.col(c)) for c in latest}
        return F.struct(F.lit(sign).alias("sign"), there.alias("there"), *[value[c].alias(c) for c in read])

    states = F.array(state(-1, "_before", F.col("_held").isNotNull() | F.col("_before").isNotNull()),
                     state(1, "_after", F.lit(True)))
    both = joined.select(F.explode(states).alias("_s")).select("_s.*").filter("there")
    return _counting(both).select(*GROUP, "amount_due", "sign")


def fold_load(spark: SparkSession, base: str, log: str, load_id: int, store: str) -> None:
    """Bring the totals from before a logged load to after it; running it again writes the same rows.

    Counts and sums take signed rows: the state before the load of the changed keys out, the state after it in. A
    maximum survives unless its last bearer may have left the group; only such groups are read again.
    """
    rule = MERGE_RULES[_TABLE]
    rows, changes = _stored(spark, base, log, _TABLE, load_id + 1)
    signed = _signed_items(rows, changes, load_id, rule)
    came, went = F.col("sign") == 1, F.col("sign") == -1
    delta = signed.groupBy(*GROUP).agg(
        F.sum("sign").alias("dn"), F.sum(F.when(F.col("amount_due").isNotNull(), F.col("sign")).otherwise(0)).alias("dpriced"),
        F.sum(F.col("amount_due") * F.col("sign")).alias("ddue"),
        F.max(F.when(came, F.col("amount_due"))).alias("came"), F.max(F.when(went, F.col("amount_due"))).alias("went"))
    held = read_totals(spark, store, load_id)
    lost = (F.col("d.went") >= F.col("h.largest")) & F.coalesce(F.col("d.came") < F.col("h.largest"), F.lit(True))
    joined = delta.alias("d").join(held.alias("h"), _same("d", "h"), "left").select(
        *[F.col(f"d.{c}").alias(c) for c in GROUP], (F.coalesce("h.n", F.lit(0)) + F.col("d.dn")).alias("n"),
        (F.coalesce("h.priced", F.lit(0)) + F.col("d.dpriced")).alias("priced"),
        (F.coalesce("h.due_sum", F.lit(0)) + F.coalesce("d.ddue", F.lit(0))).cast("decimal(38,2)").alias("due_sum"),
        F.greatest("h.largest", "d.came").alias("largest"), F.coalesce(lost, F.lit(False)).alias("lost")).persist()
    bearers = None
    try:
        at = joined.filter("lost AND n > 0").select("tenant_id", "due").distinct()
        totals = joined
        if not at.isEmpty():
            # whichever version of an invoice, in base or log, has such a group: their current rows decide
            versions = [_counting(df.select(*rows.columns)).join(at, ["tenant_id", "due"], "left_semi").select(*rule.keys)
                        for df in (rows, changes)]
            # base and log are both cut by them
            bearers = versions[0].unionByName(versions[1]).distinct().persist()
            again = read_current(spark, base, log, _TABLE, before=load_id + 1, wanted=bearers,
                                 columns=("tenant_id", "type", "status", "due_date", "amount_due"))
            found = _open_items(again).groupBy(*GROUP).agg(F.max("amount_due").alias("found"))
            totals = joined.alias("j").join(found.alias("l"), _same("j", "l"), "left").select(
                *[F.col(f"j.{c}").alias(c) for c in GROUP], "n", "priced", "due_sum",
                F.when(F.col("lost"), F.col("found")).otherwise(F.col("largest")).alias("largest"))
        change_log.write_batch(totals.select(*GROUP, "n", "priced", "due_sum", "largest"), store, load_id)
    finally:
        joined.unpersist()
        if bearers is not None:
            bearers.unpersist()


def ageing_summary(totals: DataFrame, tenants: DataFrame, as_of: dt.date, tenant_id: str | None = None,
                   invoice_type: str = "ACCREC") -> DataFrame:
    """The ageing summary of a day: invoices, amount and largest amount per bucket, in bucket order."""
    rows = totals.filter(F.col("type") == invoice_type)
    if tenant_id is not None:
        rows = rows.filter(F.col("tenant_id") == tenant_id)
    late = F.when(F.col("due") < F.lit(as_of), F.date_diff(F.lit(as_of), F.col("due")))
    bucket = ageing_bucket(F.lit(1), late)
    known = tenants.select(F.col("id").alias("tenant_id"))
    return rows.join(known, "tenant_id", "left_semi").groupBy(bucket.alias("ageing_bucket")).agg(
        F.sum("n").alias("invoice_count"), F.sum(F.when(F.col("priced") > 0, F.col("due_sum"))).cast("decimal(18,2)").alias("total_due"),
        F.max("largest").alias("largest_due")).orderBy(ageing_rank(F.col("ageing_bucket")))

"""URL filters as a sort-merge range join: reversed-host keys turn host and path rules into nested key intervals."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import materialise, ship_code

#: Keys that the ends of the key ranges are chosen from; they come to the driver, whatever the size of the table.
RANGE_SAMPLE = 4096
#: Least number of key ranges; as many as the session shuffles into, if that is more.
RANGES = 32
ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; empty without."""
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    """Labels from the top level down, each ended by a point, a slash, then the path: every prefix is an interval of keys.

    A host has no slash, so the one before the path tells where it ends.
    """
    return F.concat(F.concat_ws(".", labels), F.when(F.size(labels) > 0, "./").otherwise("/"), path)


def canonical_rules(rules: DataFrame) -> DataFrame:
    """Rules (``host``, ``path``, ``verdict``) by key, one per host and path; of contrary ones the block stays.

    The host is taken in lower case; a null or empty host fits every host, a null path is empty and fits every path.
    """
    host = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER)
    named = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    one = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # "block" comes after "allow"
    labels = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(_reversed_labels(F.col("host")))
    return one.select("host", "path", "verdict", F.size(labels).alias("depth"), _key(labels, F.col("path")).alias("key"))


def _probes(places: DataFrame, least: int, most: int) -> DataFrame:
    """A key for every depth of the host at which there are rules: ``a.b.com`` stands below ``com``, ``b.com``, itself.

    The rules' own depths bound the number of keys of a url, however many labels its host has.
    """
    labels = _reversed_labels(F.col("host"))
    upto = F.least(F.size(labels), F.lit(most))
    depths = F.when(upto >= least, F.sequence(F.lit(least), F.greatest(upto, F.lit(least)))).otherwise(
        F.array().cast("array<int>"))
    probed = places.select("host", "path", labels.alias("labels"), F.explode(depths).alias("depth"))
    return probed.select("host", "path", _key(F.slice("labels", 1, F.col("depth")), F.col("path")).alias("key"))


def _range_ends(probes: DataFrame, ranges: int) -> list[str]:
    """Keys at which the ranges end, from a bounded sample by hash."""
    sample = sorted(r["key"] for r in probes.select("key").orderBy(F.xxhash64("key")).limit(RANGE_SAMPLE).collect())
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []


def _deal(ends: list[str]):
    """Give every row the range of its key; a rule goes to all ranges that its interval of keys meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, part = [], []
            for i, (key, rule) in enumerate(zip(batch.column("key").to_pylist(), batch.column("rule").to_pylist(), strict=True)):
                first = last = bisect_right(ends, key)
                if rule is not None:
                    while last < len(ends) and ends[last].startswith(key):
                        last += 1
                for p in range(first, last + 1):
                    index.append(i)
                    part.append(p)
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(index, pa.int64())).columns, pa.array(part, pa.int32())], [*batch.schema.names, "part"])
    return run


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over a range in key order; the stack holds the rules whose interval is open, the innermost on top."""
    stack: list[tuple[str, str, str, int]] = []
    part = None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("part", "key", "rule", "verdict", "host_length")]
        index, rules, verdicts, lengths = [], [], [], []
        for i, (at, key, rule, verdict, length) in enumerate(zip(*columns, strict=True)):
            if at != part:
                part, stack = at, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, rule, verdict, length))
            elif stack:
                index.append(i)
                rules.append(stack[-1][1])
                verdicts.append(stack[-1][2])
                lengths.append(stack[-1][3])
        taken = batch.take(pa.array(index, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [taken.column("host"), taken.column("path"), pa.array(rules, pa.string()), pa.array(verdicts, pa.string()),
             pa.array(lengths, pa.int32())], ["host", "path", "rule", "verdict", "host_length"])


def match_places(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule that fits each distinct (``host``, ``path``): ``host``, ``path``, ``rule``, ``verdict``.

    Places that no rule fits are left out. Rules and places are merged in key order, range by range: a rule is copied
    only to ranges that begin inside its interval, so a range end costs at most as many copies as it has prefixes among
    the rules. A task holds its open rules, which are all prefixes of one key, and nothing else.
    """
    spark = places.sparkSession
    ship_code(spark)
    rules = materialise(canonical_rules(rules), "url-rules")
    depths = rules.agg(F.min("depth").alias("least"), F.max("depth").alias("most")).first()
    if depths["most"] is None:
        return places.select("host", "path", F.lit(None).cast("string").alias("rule"),
                             F.lit(None).cast("string").alias("verdict")).limit(0)
    probes = _probes(places.select("host", "path").distinct(), depths["least"], depths["most"])
    ends = _range_ends(probes, max(RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    named = rules.select("host", "path", "key", F.concat("host", "path").alias("rule"), "verdict",
                         F.char_length("host").alias("host_length"))
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("rule", "string"), ("verdict", "string"), ("host_length", "int"))]
    merged = named.unionByName(probes.select("host", "path", "key", *nothing))
    dealt = merged.mapInArrow(_deal(ends), "host string, path string, key string, rule string, verdict string, "
                                           "host_length int, part int")
    # at equal keys rules come before what they fit, the shorter host first
    ordered = dealt.repartition("part").sortWithinPartitions("part", "key", F.col("rule").isNull(), "host_length")
    found = ordered.mapInArrow(_sweep, "host string, path string, rule string, verdict string, host_length int")
    longest = F.struct(F.char_length("rule"), F.col("host_length"), F.col("rule"), F.col("verdict"))
    return found.groupBy("host", "path").agg(F.max(longest).alias("best")).select(
        "host", "path", "best.rule", "best.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """Add ``__host``, ``__path``, ``__rule`` and ``__verdict`` to every row.

    A rule (``host``, ``path``, ``verdict`` allow or block) fits its host and all subdomains where the url's path starts
    with the rule's. The rule with the most characters wins, then that with the longer host; without one the verdict is
    ``default`` and the rule null. A url that is null or has no ``://`` has an empty host and path. Without rules
    everything gets the default. Rows that repeat are judged each, equal urls only once; an empty table gives an empty
    result; all columns of ``pages`` come back.
    """
    placed = pages.withColumns({"__host": host_of(F.col(url_col)), "__path": path_of(F.col(url_col))})
    found = match_places(placed.select(F.col("__host").alias("host"), F.col("__path").alias("path")), rules)
    found = materialise(found.select(F.col("host").alias("__h"), F.col("path").alias("__p"),
                                     F.col("rule").alias("__rule"), F.col("verdict").alias("__found")), "url-verdicts")
    judged = placed.join(found.hint("rebalance"), (F.col("__host") == F.col("__h")) & (F.col("__path") == F.col("__p")), "left")
    return judged.select(*pages.columns, "__host", "__path", "__rule",
                         F.coalesce("__found", F.lit(default)).alias("__verdict"))

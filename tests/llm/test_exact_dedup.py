from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from ledgerloom.llm import common, exact_dedup


def test_filter_loses_no_repeated_key(spark):
    df = spark.range(3000).select((F.col("id") % 2000).alias("k"), F.col("id"))
    marked = common.mark_found(df, [F.col("k")], common.repeated_filter(df, [F.col("k")]), "again")
    assert marked.columns == ["k", "id", "again"]
    assert marked.filter("k < 1000 AND NOT again").count() == 0
    assert marked.filter("k >= 1000 AND again").count() < 10
    assert common.mark_found(df, [F.col("k")], common.repeated_filter(df.limit(0), [F.col("k")]), "x").filter("x").count() == 0


def test_rows_of_every_kind(spark):
    long = "same start of every text " * 20
    texts = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, long + "x"), (7, long + "y"), (8, long + "x"), (9, "A"), (None, "a"),
             (None, "zz"), (11, "é"), (12, "é"), (13, "w " * 100_000), (13, "w " * 100_000), (14, "w " * 100_000)]
    docs = spark.createDataFrame([(i, t, "s", True, 1) for i, t in texts],
                                 "doc_id bigint, text string, source string, kept boolean, group_size int")
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    want = []
    for i, t in texts:
        own = groups[t or ""]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i, "s", keep, len(own), i == keep))
    got = exact_dedup.refine_duplicates(docs, carry=["source"])
    assert got.columns == ["doc_id", "source", "keep_id", "group_size", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert exact_dedup.refine_duplicates(docs.limit(0)).count() == 0

from __future__ import annotations

import random
from collections import defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language_id, line_dedup, near_copies

EN = "the house of the river and the old bridge was built there in the spring with stones from the hill number {} {}"
DE = "das haus an dem fluss und die alte bruecke wurde dort im sommer gebaut mit steinen vom berg nummer {} {}"


def words(i):
    rng = random.Random(i)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=3)) + "ing" for _ in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{EN if i % 2 else DE}\nshared line {i} of the site footer\n{words(i)}".format(words(i * 7 + 3), i), ("en", "de")[1 - i % 2],
             f"s{i % 5}", 1) for i in range(120)]
    rows += [(200, rows[3][1], "en", "s", 1), (201, rows[3][1], "en", "s", 1), (202, None, "en", None, None), (203, "12 34", None, "s", 5),
             (None, f"no id {words(999)} the house of the", "en", "s", 3), (204, "", "de", "s", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stages_hand_on_documents(spark, docs):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, "").cache()
        assert kept.columns == docs.columns and kept.count() <= before.count(), name
    ids = [r.doc_id for r in kept.collect()]
    assert None in ids and len(ids) == len(set(ids))
    assert set(range(120)) <= set(ids) and not {200, 201, 202, 203, 204} & set(ids)
    footers = kept.where(F.col("text").contains("of the site footer")).count()
    assert footers == 1
    assert kept.where("n_chars = char_length(text)").count() >= 119
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, "").collect()
    filled = defaultdict(int)
    for r in packed:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024 and {r.doc_id for r in packed} == set(ids)


def test_each_stage_takes_empty_and_widened_tables(spark, docs):
    wide = docs.withColumns({"id": F.lit(1), "fp": F.lit("x"), "words": F.lit(None).cast("string"), "score": F.lit(2), "dropped": F.lit(1)})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0, name
        got = stage(spark, wide, "")
        assert got.count() > 0, name
        if name != "packing":
            assert got.columns == wide.columns


def test_run_on_the_small_tables(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    ids = {r.doc_id for r in got.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert ids <= {r.doc_id for r in docs.select("doc_id").collect()} and len(ids) > 0.5 * docs.count()
    model = language_id.train(docs, ~language_id.held_out())
    clean = language_id.identify(docs, model).where("NOT __lang.rejected").select(*docs.columns)
    texts = line_dedup.drop_recurring_lines(clean).select(*docs.columns).where("trim(text) <> ''")
    assert ids == {r.doc_id for r in near_copies.keep_first(texts).collect()}

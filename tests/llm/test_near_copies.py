from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.llm import near_copies, simhash


def shingle_jaccard(a, b):
    a, b = ({tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(a & b) / len(a | b)


def test_texts_of_four_fifths_common_five_word_runs_leave_one(spark):
    rng = np.random.default_rng(3)
    texts = []
    for g in range(30):
        own = [f"w{g}x{k}" for k in range(200)]
        for _ in range(4):
            some = own.copy()
            for at in rng.choice(200, rng.integers(1, 9), replace=False):
                some[at] = f"other{rng.integers(1 << 40)}"
            texts.append(" ".join(some))
    near = np.array([[shingle_jaccard(a, b) >= 0.8 for b in texts] for a in texts])
    labels = np.arange(len(texts))
    for _ in texts:
        labels = np.array([labels[row].min() for row in near])
    far = sum(np.bitwise_count(np.uint64(simhash.fingerprint(a) ^ simhash.fingerprint(b))) > 3
              for i, a in enumerate(texts) for j, b in enumerate(texts[:i]) if near[i, j])
    assert far > 10 and 30 < len(set(labels)) < 120
    kept = near_copies.keep_first(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(labels.tolist()))


def copies(seed, n, words, changes):
    rng = np.random.default_rng(seed)
    own = [f"o{seed}x{k}" for k in range(words)]
    texts = [" ".join(own)]
    for _ in range(n):
        some = own.copy()
        for at in rng.choice(words, changes, replace=False):
            some[at] = f"other{rng.integers(1 << 40)}"
        texts.append(" ".join(some))
    return texts


def brute(texts):
    near = np.array([[a == b or (bool(a.split()) and bool(b.split()) and shingle_jaccard(a, b) >= 0.8) for b in texts] for a in texts])
    labels = np.arange(len(texts))
    for _ in texts:
        new = np.array([labels[row].min() for row in near])
        if (new == labels).all():
            break
        labels = new
    return labels.tolist()


@pytest.mark.parametrize("size", [1024, 7])
def test_leaders_and_cells_find_every_link(spark, size, monkeypatch):
    monkeypatch.setattr(near_copies, "CELL_TEXTS", size)
    # copies that are near their origin but not one another; without the origin; and chains
    texts = copies(1, 40, 200, 7) + copies(2, 40, 200, 7)[1:] + copies(3, 30, 200, 4)[1:] + copies(4, 3, 30, 1)
    found = {r.id: r.component_id for r in near_copies.similar_texts(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts)
    assert len(set(found.values())) > 3


def test_rows_of_a_group_grow_with_its_texts(spark):
    def pairs(n):
        docs = spark.createDataFrame(list(enumerate(copies(5, n, 150, 5))), "doc_id bigint, text string")
        texts = docs.selectExpr("doc_id AS id", "xxhash64(text) AS text_hash", "text")
        rows = near_copies._marked(texts, 5)
        band = rows.selectExpr("fp", "size", "explode(bands) AS band").distinct().selectExpr("*", "fp AS root")
        return near_copies._led(band).count(), near_copies._cells(band).count() / n

    few, many = pairs(50), pairs(400)
    assert few[0] <= 51 and many[0] <= 401
    assert many[1] <= near_copies.BANDS + 1 and few[1] <= near_copies.BANDS + 1

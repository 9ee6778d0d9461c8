from __future__ import annotations

import re

import numpy as np
import xxhash

from ledgerloom.llm import near_copies, simhash, unions
from ledgerloom.llm.components import connected_components


def plain(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(marks):
    """Component label of each fingerprint, comparing all."""
    near = np.bitwise_count((marks[:, None] ^ marks[None, :]).view(np.uint64)) <= 3
    labels = np.arange(len(marks))
    while True:
        new = np.array([labels[near[i]].min() for i in range(len(marks))])
        if (new == labels).all():
            return labels
        labels = new


def planted(n, seed=1, dense=0):
    """Random fingerprints with chains of neighbours, and one dense ball."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, n, np.uint64, endpoint=False)
    out = [base]
    for _ in range(3):
        flips = np.zeros(n, np.uint64)
        for _ in range(3):
            flips |= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        base = base ^ flips
        out.append(base)
    ball = np.uint64(0xDEADBEEF12345678) ^ (np.uint64(1) << rng.integers(0, 64, dense).astype(np.uint64))
    return np.unique(np.concatenate([*out, ball]).view(np.int64))


def test_fingerprint_is_the_plain_one():
    for text in ("", " \t\n\x0b\x0c\r ", "A", "One two", "One TWO three", "É é x y\x1cz W", "a b c " * 30_000):
        assert simhash.fingerprint(text) == plain(text)


def test_near_pairs_meet_at_the_nearest_anchor_of_one_half():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**64, 3000, np.uint64, endpoint=False)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
    _, anchor, home = simhash._anchors(x.view(np.int64))
    index, other, _ = simhash._anchors(y.view(np.int64))
    homes = [set() for _ in x]
    for i, a, h in zip(*simhash._anchors(x.view(np.int64)), strict=True):
        if h:
            homes[i].add(a)
    reach = [set() for _ in x]
    for i, a in zip(index, other, strict=True):
        reach[i].add(a)
    assert all(h & r for h, r in zip(homes, reach, strict=True))
    assert len(anchor) <= 34 * len(x) and home.sum() == 2 * len(x)


def components_of(spark, marks, cell_rows):
    df = spark.createDataFrame([(int(m),) for m in marks], "fp bigint")
    links = simhash.compare_cells(simhash.cut_cells(simhash.replicas(df), cell_rows))
    found = {r.node: r.component for r in connected_components(links).collect()}
    return [found.get(int(m), int(m)) for m in marks]


def test_components_are_those_of_all_pairs_in_whole_and_cut_anchors(spark):
    marks = planted(150, dense=60)
    want = marks[brute(marks)].tolist()
    assert components_of(spark, marks, 4096) == want
    assert components_of(spark, marks, 5) == want


def test_merge_finds_chains():
    a, b = np.array([5, 4, 3, 9]), np.array([4, 3, 2, 8])
    assert unions.merge(np.arange(10), a, b).tolist() == [0, 1, 2, 2, 2, 2, 6, 7, 8, 8]


def test_rows_of_every_kind(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "one two three four"), (9, "ONE two  three four"), (4, "one two three four"),
             (None, "one two three four"), (None, None), (None, "quite another text here"), (7, "word " * 50_000)]
    docs = spark.createDataFrame([(i, t, "x", 1, True) for i, t in texts],
                                 "doc_id bigint, text string, fp string, id int, root boolean")
    found = {(r.id, r.text_hash): r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(found.values(), key=str) == sorted([1, 1, 1, 1, 4, 4, 4, 7, None], key=str)
    kept = near_copies.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("1", None), ("4", "one two three four"), ("7", "word " * 50_000), ("None", "quite another text here")], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert near_copies.keep_first(docs).count() == 0


def test_rounds_of_linking_are_one_job_each(spark, monkeypatch):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (7, 7)], "a long, b long")
    none = links.where("a < 0")
    looked = []
    first = type(links).first
    monkeypatch.setattr(type(links), "first", lambda self: looked.append(1) or first(self))
    found = {r.node: r.component for r in connected_components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 21)}, 50: 40} and not looked
    assert connected_components(none).collect() == []

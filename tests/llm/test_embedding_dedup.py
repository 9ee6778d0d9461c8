from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import cover_tree, embedding_dedup


def brute(x, least=0.9):
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    labels = np.arange(len(x))
    while True:
        new = np.array([min([labels[i], *labels[linked[i]]]) for i in range(len(x))])
        if (new == labels).all():
            return linked.sum(1), labels
        labels = new


def clouds(n, d=8, seed=0):
    """Tight and wide clusters, chains and strays."""
    rng = np.random.default_rng(seed)
    parts = [rng.standard_normal((n, d))]
    for spread in (0.001, 0.05, 0.2, 0.5):
        parts.append(rng.standard_normal(d) + spread * rng.standard_normal((n, d)))
    turn = np.linspace(0, 3, n)
    chain = np.zeros((n, d))
    chain[:, 0], chain[:, 1] = np.cos(turn), np.sin(turn)
    return np.concatenate([*parts, chain])


@pytest.mark.parametrize("outright", [1, 50, 1 << 18])
def test_traversal_finds_the_pairs_of_brute_force(monkeypatch, outright):
    monkeypatch.setattr(cover_tree, "OUTRIGHT", outright)
    x = clouds(60)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    want, labels = brute(x)
    dual = cover_tree.Dual(x, np.ones(len(x)), 0.9)
    dual.among(np.arange(len(x)))
    assert (dual.links == want).all() and (dual.labels == labels).all()
    left = np.arange(len(x)) % 3 == 0
    dual = cover_tree.Dual(x, np.arange(len(x)) + 1, 0.9)
    dual.between(np.flatnonzero(left), np.flatnonzero(~left))
    linked = (x @ x.T >= 0.9) & (left[:, None] != left[None, :])
    assert (dual.links == linked @ (np.arange(len(x)) + 1)).all()


def test_net_covers_with_its_radii():
    x = clouds(100)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    level = cover_tree.net(x, np.arange(len(x)), 0.5)
    assert sorted(level.order) == list(range(len(x)))
    for k, c in enumerate(level.center):
        away = np.sqrt(((x[level.members(k)] - x[c]) ** 2).sum(1))
        assert c in level.members(k) and away.max() <= level.radius[k] + 1e-12 and level.radius[k] <= 0.5 + 1e-3


@pytest.mark.parametrize("chunk_rows", [4096, 25])
def test_rows_are_linked_as_by_brute_force(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(embedding_dedup.chunked, "__defaults__", (chunk_rows,))
    x = clouds(40).astype(np.float32).astype(np.float64)
    x = np.concatenate([x, x[:20], x[5:6], x[5:6]])
    ids = np.random.default_rng(1).permutation(len(x))
    want, labels = brute(x)
    rows = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)],
                                 "vec_id bigint, embedding array<float>, node int")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(rows).collect()}
    for i, n, label in zip(ids, want, labels, strict=True):
        r = got[i]
        assert r.n_links == n and r.component_id == ids[labels == label].min() and r.kept == (i == r.component_id)


def test_rows_of_every_kind(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (9, [1.0, 0.0]), (8, [2.0, 0.0]),
            (7, [1e-300, 1e-305]), (10, [1.0, 0.0, 0.0]), (11, [1.0, 0.0, 0.0]), (11, [1.0, 0.0, 0.0]), (None, [0.0, 5.0]), (12, [-1e200, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, links string")
    got = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()), key=repr)
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 12)] + [
        (7, 2, 7, True), (8, 2, 7, False), (9, 2, 7, False), (10, 2, 10, True), (11, 2, 10, False), (11, 2, 10, False),
        (None, 0, None, True)]
    assert got == sorted(want, key=repr)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def families(n, members, spread, d=16, seed=3):
    """Clusters of given spread around far centers."""
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((n, d))
    centers /= np.sqrt((centers * centers).sum(1, keepdims=True))
    return (centers[:, None] + spread * rng.standard_normal((n, members, d)) / np.sqrt(d)).reshape(-1, d)


def test_sub_cells_give_the_links_of_brute_force(spark):
    x = np.concatenate([families(60, 30, 0.03), families(20, 40, 0.3, seed=4), clouds(40, 16)])
    x = np.concatenate([x, x[:30]])
    ids = np.random.default_rng(2).permutation(len(x))
    want, labels = brute(x)
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(rows, chunk_rows=40).collect()}
    least = {label: ids[labels == label].min() for label in np.unique(labels)}
    for i, n, label in zip(ids, want, labels, strict=True):
        assert got[i].n_links == n and got[i].component_id == least[label]


@pytest.mark.parametrize("spread", [0.03, 0.25])
def test_task_rows_do_not_grow_with_clustered_vectors(spark, spread):
    """Four times as many clusters, and as many rows of comparisons for each vector."""
    made = []
    for n in (150, 600):
        x = families(n, 20, spread)
        root = spark.createDataFrame([(16, "", True, False, f"{k:06d}", 1, v.tolist()) for k, v in enumerate(x)],
                                     "size int, cell string, home boolean, closed boolean, node string, copies bigint, vector array<double>")
        cells, _ = embedding_dedup.sub_cells(root, 0.9, 60)
        made.append(embedding_dedup.chunked(cells, 60).count() / len(x))
    print(made)
    assert made[1] < 1.5 * made[0]


@pytest.mark.parametrize("kind", ["spread", "wide", "narrow"])
def test_heads_leave_all_pairs_of_brute_force_open(kind):
    """Vectors of so many dimensions that centers are compared by heads, or by all of them where heads tell nothing apart."""
    rng = np.random.default_rng(7)
    x = {"spread": rng.standard_normal((700, 80)), "wide": clouds(100, 80), "narrow": 1 + 0.45 * rng.standard_normal((700, 80))}[kind]
    x = np.concatenate([x, x[:90] + 0.3 * rng.standard_normal((90, 80)) * np.abs(x[:90]).mean(1, keepdims=True), 2 * x[:5]])
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    assert cover_tree.head(x).shape[1] < 80 and (cover_tree.head(x) @ cover_tree.head(x).T > x @ x.T - 1e-5).all()
    want, labels = brute(x)
    assert 0 < want.sum()
    weight = np.arange(len(x)) % 3 + 1
    tree = lambda some: cover_tree.Tree(x[some], weight[some], cover_tree.net(x[some], np.arange(len(some)), 0.5))
    own = tree(np.arange(len(x)))
    dual = cover_tree.compare(own, own, 0.9)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    assert (dual.links == linked @ weight).all() and (dual.labels == labels).all()
    left = np.arange(len(x)) % 3 == 0
    dual = cover_tree.compare(tree(np.flatnonzero(left)), tree(np.flatnonzero(~left)), 0.9)
    across = np.concatenate([np.flatnonzero(left), np.flatnonzero(~left)])
    assert (dual.links == ((linked & (left[:, None] != left)) @ weight)[across]).all()


def one_cell(spark, x):
    return spark.createDataFrame([(x.shape[1], "", True, False, f"{k:06d}", 1, v.tolist()) for k, v in enumerate(x)],
                                 "size int, cell string, home boolean, closed boolean, node string, copies bigint, vector array<double>")


def test_comparisons_of_a_cell_are_many_tasks(spark):
    x = families(8, 40, 0.03)
    found = embedding_dedup.compare(embedding_dedup.chunked(one_cell(spark, x), 40), 0.9).select(
        "node", "links", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in found}) > 4
    links = np.zeros(len(x), int)
    for r in found:
        links[int(r.node)] += r.links
    assert (links == brute(x)[0]).all()


def test_a_vector_is_moved_once_for_all_comparisons(spark):
    x = families(8, 40, 0.03)
    chunks = embedding_dedup.chunked(one_cell(spark, x), 20)
    assert chunks.count() == len(x) and chunks.select("chunk").distinct().count() == 16


def test_a_cell_that_splitting_does_not_prune_is_not_measured(spark):
    """Random vectors, as many chunks as make a visit to every sub-cell look cheap."""
    x = np.random.default_rng(5).standard_normal((3000, 64))
    cell = one_cell(spark, x / np.sqrt((x * x).sum(1, keepdims=True))).selectExpr("*", "3000L AS homes", "300D AS rate")
    assert embedding_dedup.choose_centers(cell, 0.9, 10).isEmpty()


def test_comparisons_do_not_grow_with_clustered_vectors(spark):
    """Rows that comparisons read for each vector, however few are moved for them."""
    made = []
    for n in (100, 400):
        x = families(n, 20, 0.25)
        chunks = embedding_dedup.chunked(embedding_dedup.sub_cells(one_cell(spark, x), 0.9, 60)[0], 60)
        read = "CASE WHEN chunk >= h THEN h WHEN closed THEN v ELSE h + v END"
        made.append(chunks.selectExpr(f"coalesce(sum({read}), 0) AS n").first().n / len(x))
    assert made[1] < 1.5 * made[0]

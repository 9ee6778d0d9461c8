"""Cover trees over unit vectors and the dual traversal that finds all pairs within a distance.

A node is a center with all vectors within its covering radius; the levels of a tree are nets of halving radii. Of a
pair of nodes with centers d apart and covering radii r and s, nothing links if d > r + s + t, and everything links if
d + r + s <= t; only pairs in between are opened, the wider node first. On the unit sphere no pair of nodes of radius 1
can be told apart, so a tree's first stored level is the net of radius 1/2. Centers without a covering radius are first
compared by their heads, of half the dimensions or fewer, whose product is an upper bound of the cosine.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np

from ledgerloom.llm.unions import merge

TOP_RADIUS = 0.5
#: Pairs of vectors below which two nodes are compared outright.
OUTRIGHT = 1 << 18
_BLOCK = 512
#: Directions of a head; vectors of up to twice as many dimensions are compared in full. Where more than one pair in
#: ``OPEN`` is left open by heads, they are not used.
HEAD, OPEN = 31, 64
#: Centers on either side of a product, so that it stays in the cache, and components that are looked up at once.
_LEFT, _RIGHT, _COMPONENTS = 512, 512, 1 << 22
#: What single and double precision may be off by.
_SINGLE, _DOUBLE = 1e-4, 1e-9


@dataclass
class Level:
    """Nodes of a level: indexes of centers, covering radii, and the members of each."""

    center: np.ndarray
    radius: np.ndarray
    order: np.ndarray
    start: np.ndarray
    single: np.ndarray | None = None
    head: np.ndarray | None = None

    def members(self, k: int) -> np.ndarray:
        return self.order[self.start[k]:self.start[k + 1]]

    def look(self, x: np.ndarray) -> None:
        """Keep the centers in single precision and their heads, found once."""
        if self.single is None:
            self.single, self.head = x[self.center].astype(np.float32), head(x[self.center])

    def behind(self, n: int) -> Level:
        """The same level for vectors that come behind ``n`` others."""
        return replace(self, center=self.center + n, order=self.order + n)


@lru_cache(8)
def _directions(d: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(0).standard_normal((d, HEAD)))[0]


def head(x: np.ndarray) -> np.ndarray:
    """Coordinates of unit vectors in ``HEAD`` fixed directions and the length of the rest, in single precision."""
    if x.shape[1] <= 2 * HEAD:
        return x.astype(np.float32)
    first = x @ _directions(x.shape[1])
    return np.column_stack([first, np.sqrt(np.maximum(1 - (first * first).sum(1), 0))]).astype(np.float32)


def net(x: np.ndarray, members: np.ndarray, radius: float) -> Level:
    """A net of ``members``: each is within about ``radius`` of a center; the covering radii are exact."""
    least = np.float32(1 - radius * radius / 2)
    single = x[members].astype(np.float32)
    n = len(members)
    centers = np.empty((n, x.shape[1]), np.float32)
    owner = np.empty(n, np.int64)
    chosen: list[int] = []
    for start in range(0, n, _BLOCK):
        block = single[start:start + _BLOCK]
        rest = np.arange(len(block))
        if chosen:
            near = block @ centers[:len(chosen)].T
            best = near.argmax(1)
            covered = near[rest, best] >= least
            owner[start + rest[covered]] = best[covered]
            rest = rest[~covered]
        if not len(rest):
            continue
        inside = block[rest] @ block[rest].T >= least
        open_ = np.ones(len(rest), bool)
        for p in range(len(rest)):
            if open_[p]:
                mine = inside[p] & open_
                mine[p] = True
                owner[start + rest[mine]] = len(chosen)
                open_[mine] = False
                centers[len(chosen)] = block[rest[p]]
                chosen.append(start + int(rest[p]))
    center = members[chosen]
    away = np.sqrt(((x[members] - x[center[owner]]) ** 2).sum(1))
    width = np.zeros(len(chosen))
    np.maximum.at(width, owner, away)
    order = np.argsort(owner, kind="stable")
    return Level(center, width, members[order], np.searchsorted(owner[order], np.arange(len(chosen) + 1)))


class Dual:
    """All pairs with cosine of at least ``least`` between left and right vectors, or among the left ones alone.

    Collects, for each vector, the weight of the others linked to it, and the sets that links connect.
    """

    def __init__(self, x: np.ndarray, weight: np.ndarray, least: float):
        self.x, self.weight, self.least = x, weight.astype(np.int64), least
        self.t = float(np.sqrt(2 - 2 * least))
        self.links = np.zeros(len(x), np.int64)
        self.labels = np.arange(len(x))
        self._levels: dict[tuple[int, int], Level] = {}

    def among(self, rows: np.ndarray) -> None:
        if len(rows):
            self._among(net(self.x, rows, TOP_RADIUS))

    def _among(self, level: Level) -> None:
        self._tops(level, level)
        for k in np.flatnonzero(np.diff(level.start) > 1):
            self._self(level.members(k), level.center[k], level.radius[k])

    def between(self, left: np.ndarray, right: np.ndarray) -> None:
        if len(left) and len(right):
            self._tops(net(self.x, left, TOP_RADIUS), net(self.x, right, TOP_RADIUS))

    def _tops(self, a: Level, b: Level) -> None:
        """All pairs of nodes of two top levels; of one level, each pair of different nodes once."""
        a.look(self.x)
        b.look(self.x)
        (flat_a, wide_a), (flat_b, wide_b) = ((np.flatnonzero(v.radius == 0), np.flatnonzero(v.radius > 0)) for v in (a, b))
        self._flats(a, flat_a, b, flat_b)
        self._wides(a, wide_a, b, np.arange(len(b.center)))
        if a is not b:
            self._wides(b, wide_b, a, flat_a)

    def _flats(self, a: Level, i: np.ndarray, b: Level, j: np.ndarray) -> None:
        """Pairs of nodes without a covering radius."""
        lowest = np.float32(self.least - _SINGLE)
        left, right = a.head[i], b.head[j]
        if len(i) and len(j) and (left[:_LEFT] @ right[:_RIGHT].T >= lowest).mean() * OPEN > 1:
            left, right = a.single[i], b.single[j]
        held = np.empty(_LEFT * _RIGHT, np.float32)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for p in range(0, len(i), _LEFT):
            for q in range(p // _RIGHT * _RIGHT if a is b else 0, len(j), _RIGHT):
                some, others = left[p:p + _LEFT], right[q:q + _RIGHT]
                near = np.matmul(some, others.T, out=held[:len(some) * len(others)].reshape(len(some), -1))
                rows = np.flatnonzero(near.max(1) >= lowest)
                if len(rows):
                    k, m = np.nonzero(near[rows] >= lowest)
                    found.append((i[p + rows[k]], j[q + m]))
                if sum(len(k) for k, _ in found) * self.x.shape[1] > _COMPONENTS:
                    self._open(a, b, found)
                    found = []
        self._open(a, b, found)

    def _open(self, a: Level, b: Level, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Nodes without a covering radius that heads leave open."""
        if not found:
            return
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        once = (i < j) | (a is not b)
        i, j, step = i[once], j[once], max(1, _COMPONENTS // self.x.shape[1])
        for start in range(0, len(i), step):
            k, m = i[start:start + step], j[start:start + step]
            near = np.einsum("nd,nd->n", self.x[a.center[k]], self.x[b.center[m]]) >= self.least - _SINGLE
            k, m = k[near], m[near]
            single = (np.diff(a.start)[k] == 1) & (np.diff(b.start)[m] == 1)
            self._link_each(a.center[k[single]], b.center[m[single]])
            self._pairs(a, k[~single], b, m[~single])

    def _wides(self, a: Level, i: np.ndarray, b: Level, j: np.ndarray) -> None:
        """Pairs of nodes of ``a`` with a covering radius and nodes of ``b``."""
        right, radius = b.single[j].T, b.radius[j]
        for p in range(0, len(i), _LEFT):
            some = i[p:p + _LEFT]
            k, m = np.nonzero(a.single[some] @ right >= self._lowest(a.radius[some][:, None] + radius))
            k, m = some[k], j[m]
            if a is b:
                once = (k < m) | (a.radius[m] == 0)
                k, m = k[once], m[once]
            self._pairs(a, k, b, m)

    def _pairs(self, a: Level, k: np.ndarray, b: Level, m: np.ndarray) -> None:
        for p, q in zip(k.tolist(), m.tolist(), strict=True):
            self._pair(a.members(p), a.center[p], a.radius[p], b.members(q), b.center[q], b.radius[q])

    def _opened(self, i: np.ndarray, c: int, r: float) -> Level:
        """The next level of a node, found once. Nodes of one center are nested, so their size tells them apart."""
        key = (int(c), len(i))
        if key not in self._levels:
            self._levels[key] = net(self.x, i, r / 2)
        return self._levels[key]

    def _lowest(self, radii: np.ndarray) -> np.ndarray:
        """Cosine of centers below which nodes of these radii are too far apart."""
        return (1 - np.minimum(self.t + radii, 2.0) ** 2 / 2 - _SINGLE).astype(np.float32)

    def _link_each(self, i: np.ndarray, j: np.ndarray) -> None:
        right = np.einsum("nd,nd->n", self.x[i], self.x[j]) >= self.least
        i, j = i[right], j[right]
        np.add.at(self.links, i, self.weight[j])
        np.add.at(self.links, j, self.weight[i])
        self.labels = merge(self.labels, i, j)

    def _link_all(self, i: np.ndarray, j: np.ndarray) -> None:
        self.links[i] += self.weight[j].sum()
        self.links[j] += self.weight[i].sum()
        self.labels = merge(self.labels, i, np.full(len(i), j[0]))
        self.labels = merge(self.labels, j, np.full(len(j), i[0]))

    def _outright(self, i: np.ndarray, j: np.ndarray) -> None:
        step = max(1, OUTRIGHT // len(j))
        for start in range(0, len(i), step):
            some = i[start:start + step]
            linked = self.x[some] @ self.x[j].T >= self.least
            self.links[some] += linked @ self.weight[j]
            self.links[j] += self.weight[some] @ linked
            a, b = np.nonzero(linked)
            self.labels = merge(self.labels, some[a], j[b])

    def _pair(self, i: np.ndarray, ci: int, ri: float, j: np.ndarray, cj: int, rj: float) -> None:
        todo = [(i, ci, ri, j, cj, rj)]
        while todo:
            i, ci, ri, j, cj, rj = todo.pop()
            d = float(np.sqrt(((self.x[ci] - self.x[cj]) ** 2).sum()))
            if d - ri - rj > self.t + _DOUBLE:
                continue
            if d + ri + rj <= self.t - _DOUBLE:
                self._link_all(i, j)
            elif len(i) * len(j) <= OUTRIGHT or ri + rj == 0:
                self._outright(i, j)
            elif ri >= rj:
                level = self._opened(i, ci, ri)
                todo += [(level.members(k), level.center[k], level.radius[k], j, cj, rj) for k in range(len(level.center))]
            else:
                level = self._opened(j, cj, rj)
                todo += [(i, ci, ri, level.members(k), level.center[k], level.radius[k]) for k in range(len(level.center))]

    def _self(self, i: np.ndarray, ci: int, ri: float) -> None:
        todo = [(i, ci, ri)]
        while todo:
            i, ci, ri = todo.pop()
            if len(i) < 2:
                continue
            if 2 * ri <= self.t - _DOUBLE:
                self.links[i] += self.weight[i].sum() - self.weight[i]
                self.labels = merge(self.labels, i, np.full(len(i), i[0]))
            elif len(i) ** 2 <= OUTRIGHT:
                linked = self.x[i] @ self.x[i].T >= self.least
                np.fill_diagonal(linked, False)
                self.links[i] += linked @ self.weight[i]
                a, b = np.nonzero(linked)
                self.labels = merge(self.labels, i[a], i[b])
            else:
                level = self._opened(i, ci, ri)
                nodes = [(level.members(k), level.center[k], level.radius[k]) for k in range(len(level.center))]
                todo += nodes
                for p in range(len(nodes)):
                    for q in range(p):
                        self._pair(*nodes[p], *nodes[q])


@dataclass
class Tree:
    """Unit vectors, their weights, and the top level of their cover tree."""

    x: np.ndarray
    weight: np.ndarray
    level: Level


def compare(a: Tree, b: Tree, least: float) -> Dual:
    """Links between the vectors of two trees, those of ``a`` first, or among the vectors of one tree."""
    if a is b:
        dual = Dual(a.x, a.weight, least)
        dual._among(a.level)
        return dual
    dual = Dual(np.concatenate([a.x, b.x]), np.concatenate([a.weight, b.weight]), least)
    for tree in (a, b):
        tree.level.look(tree.x)
    dual._tops(a.level, b.level.behind(len(a.x)))
    return dual

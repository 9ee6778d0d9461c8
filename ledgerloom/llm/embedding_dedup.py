"""Near duplicates among embeddings: exact threshold pairs by dual traversal of cover trees."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerloom.llm import cover_tree
from ledgerloom.llm.common import materialise, shared_folder, ship_code
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.cover_tree import TOP_RADIUS, Level, Tree, net
from ledgerloom.llm.files import new_file, read_bytes, write_bytes

LEAST_COSINE = 0.9
#: Vectors on either side of a comparison.
CHUNK_ROWS = 4096
#: Comparisons of a task, at least if there are tasks enough, and chunks on either side that are compared in turn.
PER_TASK, TILE = 64, 8
#: Bytes of vectors that a task keeps for its next comparisons.
HELD = 128 << 20
#: Vectors of a cell, those of the smallest hashes, that the centers of its sub-cells are chosen from, and sub-cells at
#: most. Any choice gives the same links.
SAMPLE, CELLS = 2048, 256
#: A cell is split where that leaves less than this share of the rows that its comparisons would read, at most so often.
WORTH, LEVELS = 0.8, 20
#: Visitors for each vector at home beyond which a smaller cell is split, too.
CROWDED = 2
#: What bounds between cells allow for rounding.
SLACK = 1e-6


def usable(vector: str) -> Column:
    """Not null, not empty, all components present and finite, not all zero."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def unit(vectors: pa.Array) -> np.ndarray:
    """Rows of length 1 in double precision; all of one dimension."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _away(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ centers.T), 0))


def chunked(placed: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Deal the rows of each cell into chunks: each row once, however many comparisons its chunk takes part in.

    The vectors at home in a cell are its chunks 0 to ``h`` - 1, those that visit it the next ``v``; chunk i of the homes is
    compared with all chunks from itself on, or, in a closed cell, with those of the visitors. Rows that no comparison
    reads are left out.
    """
    sizes = materialise(placed.groupBy("size", "cell").agg(
        F.ceil(F.count_if("home") / chunk_rows).cast("int").alias("h"),
        F.ceil(F.count_if(~F.col("home")) / chunk_rows).cast("int").alias("v")), "chunk-sizes")
    rows = placed.join(sizes, ["size", "cell"]).where((F.col("h") > 0) & ~(F.col("closed") & (F.col("v") == 0)))
    mix = F.xxhash64("node", F.lit(3))
    chunk = F.when(F.col("home"), F.pmod(mix, F.col("h"))).otherwise(
        F.col("h") + F.pmod(mix, F.greatest("v", F.lit(1)))).cast("int")
    return rows.select("size", "cell", "closed", "h", "v", chunk.alias("chunk"), "node", "copies", "vector")


def _net_centers(x: np.ndarray) -> np.ndarray:
    """Centers of the first net of enough nodes, of radii halved again and again; the fullest ones of it."""
    radius = float(_away(x, x[:1]).max()) / 2
    while radius > 1e-3:
        level = net(x, np.arange(len(x)), radius)
        if len(level.center) >= min(CELLS // 8, len(x)):
            return x[level.center[np.argsort(-np.diff(level.start), kind="stable")[:CELLS]]]
        radius /= 2
    return x[:CELLS]


def _asks(away: np.ndarray, near: np.ndarray, at: np.ndarray, centers: np.ndarray, t: float) -> np.ndarray:
    """Whether the plane between a row's nearest center and another one is within ``t`` of the row."""
    return away ** 2 - (at ** 2)[:, None] <= 2 * t * _away(centers, centers)[near] + SLACK


def choose_centers(cells: DataFrame, least: float, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``centers`` of the sub-cells of each cell, from a bounded sample of its ``homes``.

    None where the comparisons of the sub-cells, filled and visited as the sample shows, would read so many rows that
    splitting cannot pay; ``rate`` is how often the cell's comparisons read a row if it is left as it is, null for cells
    with visitors, which the sample does not show.
    """
    t = float(np.sqrt(2 - 2 * least))
    rank = F.row_number().over(Window.partitionBy("size", "cell").orderBy(F.xxhash64("node", F.lit(11)), "node"))
    # hashes are even, so about twice as many rows as are wanted are ranked, not a cell's rows in one task
    share = F.least(2.0 * SAMPLE / F.col("homes"), F.lit(1.0))
    small = F.xxhash64("node", F.lit(11)).cast("double") <= share * 2.0**64 - 2.0**63
    sample = cells.where("home").where(small).select("size", "cell", "homes", "rate", "vector", rank.alias(
        "rank")).where(F.col("rank") <= SAMPLE)

    def run(table: pa.Table) -> pa.Table:
        x = unit(pa.concat_arrays(table.column("vector").chunks))
        chosen = _net_centers(x)
        away = _away(x, chosen)
        near, at = away.argmin(1), away.min(1)
        radius = np.full(len(chosen), -9.0)
        np.maximum.at(radius, near, at)
        asks = _asks(away, near, at, chosen, t) & (away <= radius + t) & (np.arange(len(chosen)) < near[:, None])
        asks &= away + radius > t
        rate, rows = table.column("rate")[0].as_py(), table.column("homes")[0].as_py()
        homes, visits = (rows / len(x) * n for n in (np.bincount(near, minlength=len(chosen)), asks.sum(0)))
        h, v = np.ceil(homes / chunk_rows), np.ceil(visits / chunk_rows)
        split = homes * (v + np.where(2 * radius <= t, 0, h)) + visits * h
        pays = rate is None or split.sum() < WORTH * rate * rows
        made = pa.table({"size": table.column("size")[:1], "cell": table.column("cell")[:1],
                         "centers": pa.array([chosen.tolist()], pa.list_(pa.list_(pa.float64())))})
        return made.slice(0, int(pays))

    return sample.groupBy("size", "cell").applyInArrow(run, "size int, cell string, centers array<array<double>>")


def measure(cells: DataFrame, centers: DataFrame, least: float) -> DataFrame:
    """Add each row's nearest center ``near``, its distance ``at``, and the other centers it has to ask (``asks``, with
    ``away``): those whose side of the plane between them and the nearest one is within the threshold. Rows at home ask
    earlier cells only, those at home in closed cells none; visitors ask the nearest one too. A cell is many tasks.
    """
    t = float(np.sqrt(2 - 2 * least))
    rows = cells.withColumn("block", F.pmod(F.xxhash64("node", F.lit(13)), "blocks").cast("int")).drop("blocks")
    blocks = cells.select("size", "cell", "blocks").distinct()
    spread = centers.join(blocks, ["size", "cell"]).select(
        "size", "cell", "centers", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    names = [n for n in rows.columns if n != "block"]
    made = T.StructType([*(rows.schema[n] for n in names), T.StructField("near", T.IntegerType()), T.StructField(
        "at", T.FloatType()), T.StructField("asks", T.ArrayType(T.IntegerType())), T.StructField("away", T.ArrayType(T.FloatType()))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chosen = np.array(right.column("centers")[0].as_py())
        vectors = pa.concat_arrays(left.column("vector").chunks) if left.num_rows else pa.array([], pa.list_(pa.float64()))
        x = unit(vectors) if left.num_rows else np.empty((0, chosen.shape[1]))
        away, index = _away(x, chosen), np.arange(len(chosen))
        near = away.argmin(1) if len(x) else np.empty(0, np.int64)
        at = away[np.arange(len(x)), near]
        asks = _asks(away, near, at, chosen, t)
        home, closed = (left.column(n).to_numpy() for n in ("home", "closed"))
        asks &= ~home[:, None] | ((index < near[:, None]) & ~closed[:, None])
        row, k = np.nonzero(asks)
        start = pa.array(np.searchsorted(row, np.arange(len(x) + 1)), pa.int32())
        out = left.select(names).append_column("near", pa.array(near, pa.int32())).append_column("at", pa.array(at, pa.float32()))
        out = out.append_column("asks", pa.ListArray.from_arrays(start, pa.array(k, pa.int32())))
        return out.append_column("away", pa.ListArray.from_arrays(start, pa.array(away[row, k], pa.float32())))

    keys = ["size", "cell", "block"]
    return rows.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(run, made)


def _task_rows(homes: Column, visits: Column, closed: Column, chunk_rows: int) -> Column:
    """Rows that the comparisons of a cell read, as :func:`chunked` deals them."""
    h, v = F.ceil(homes / chunk_rows), F.ceil(visits / chunk_rows)
    return homes * (v + F.when(closed, 0).otherwise(h)) + visits * h


def sub_cells(placed: DataFrame, least: float, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Split cells with more than ``chunk_rows`` vectors at home, or with many more visitors than these, level by level, as
    a cover tree's nodes are.

    A cell's centers are a net of a sample of it; its homes go to the nearest center, and a row visits a sub-cell only if
    the plane between both centers and the covering radius leave a link open. Where a row is so near that all homes of a
    sub-cell link to it, or all homes of a sub-cell link to one another (it is then ``closed``), the links are counted from
    sums and no rows are compared. A cell for which splitting would not pay, as where nothing can be pruned, is left to
    :func:`chunked`. Every level is written to the shared folder; the driver sees only whether cells are left to split.

    ``placed`` has the columns ``size`` (dimensions), ``cell``, ``home``, ``closed``, ``node``, ``copies``, ``vector``.
    Returns its rows in the last cells, and rows (``node``, ``links``, ``root``) of the links counted on the way.
    """
    key, t = ["size", "cell"], float(np.sqrt(2 - 2 * least))
    columns = ["size", "cell", "home", "closed", "node", "copies", "vector"]
    fit: list[DataFrame] = []
    found = [placed.where("false").select("node", F.lit(0).cast("long").alias("links"), F.col("node").alias("root"))]
    for _ in range(LEVELS):
        homes, visits = F.count_if("home"), F.count_if(~F.col("home"))
        sizes = placed.groupBy(*key).agg(homes.alias("homes"), visits.alias("visits"), F.first("closed").alias("shut"))
        many = (F.col("homes") > chunk_rows) | ((F.col("homes") > 1) & (F.col("visits") > CROWDED * F.col("homes")))
        plain = _task_rows(F.col("homes"), F.col("visits"), F.col("shut"), chunk_rows)
        big = materialise(sizes.where(many & ~(F.col("shut") & (F.col("visits") == 0))).select(
            *key, "homes", F.ceil((F.col("homes") + F.col("visits")) / chunk_rows).cast("int").alias("blocks"),
            plain.alias("plain"), F.when(
                F.col("visits") == 0, plain / F.col("homes")).alias("rate")), "cells-big")
        if big.isEmpty():
            break
        centers = materialise(choose_centers(placed.join(big.select(*key, "homes", "rate"), key), least, chunk_rows),
                              "cell-centers")
        if centers.isEmpty():
            break
        wide = placed.join(big.select(*key, "blocks").join(centers.select(*key), key), key).select(*columns, "blocks")
        rows = materialise(measure(wide, centers, least), "cell-distances")
        subs = rows.where("home").groupBy(*key, "near").agg(
            F.max("at").cast("double").alias("r"), F.sum("copies").alias("weight"), F.min("node").alias("rep"))
        subs = subs.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct(
            "near", F.struct("r", "weight", "rep")))).alias("subs"))  # CELLS entries at most
        bounds = subs.select(*key, F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("subs"))),
                                               lambda k: F.col("subs")[k]).alias("subs"))
        made = rows.join(bounds, key)
        sub = lambda k: F.get("subs", k)
        entry = lambda k, home, whole: F.struct(k.alias("k"), home.alias("home"), whole.alias("whole"))
        near = F.when(F.col("home"), F.array(entry(F.col("near"), F.lit(True), F.lit(False))))
        asked = F.transform(F.arrays_zip("asks", "away"), lambda a: entry(
            a["asks"], F.lit(False), F.when(sub(a["asks"]).isNull() | (a["away"] > sub(a["asks"])["r"] + t + SLACK), None)
            .otherwise(a["away"] + sub(a["asks"])["r"] <= t - SLACK)))
        to = F.concat(F.coalesce(near, F.array().cast("array<struct<k:int,home:boolean,whole:boolean>>")),
                      F.filter(asked, lambda a: a["whole"].isNotNull()))
        made = made.withColumn("to", F.explode(to)).withColumn("sub", sub(F.col("to.k")))
        ball = 2 * F.col("sub.r") <= t - SLACK
        shut = F.col("closed") | ball

        counts = made.groupBy(*key, "to.k").agg(
            F.count_if("to.home").alias("homes"), F.count_if(~F.col("to.home") & ~F.col("to.whole")).alias("visits"),
            F.first(shut).alias("shut"))
        cost = counts.groupBy(*key).agg(
            F.sum(_task_rows(F.col("homes"), F.col("visits"), F.col("shut"), chunk_rows)).alias("split"))
        worth = materialise(cost.join(big, key).where(F.col("split") < WORTH * F.col("plain")).select(*key), "cells-split")
        fit.append(placed.join(worth, key, "left_anti"))
        children = materialise(made.join(worth, key, "left_semi").select(
            "size", F.concat_ws("/", "cell", F.col("to.k").cast("string")).alias("cell"), F.col("to.home").alias("home"),
            shut.alias("closed"), *columns[4:], F.col("to.whole").alias("whole"), (ball & ~F.col("closed")).alias("new"),
            F.col("sub.weight").alias("weight"), F.col("sub.rep").alias("rep")), "cells")
        around = children.where("whole").groupBy(*key).agg(F.sum("copies").alias("around"))
        at_home = children.where("home").join(around, key, "left").select("node", (
            F.coalesce("around", F.lit(0)) + F.when(F.col("new"), F.col("weight") - F.col("copies")).otherwise(0)
        ).alias("links"), F.col("rep").alias("root"))
        found += [at_home.where("links > 0"),
                  children.where("whole").select("node", F.col("weight").alias("links"), F.col("rep").alias("root"))]
        placed = children.where("NOT whole").select(*columns)
    return reduce(DataFrame.unionByName, [*fit, placed]), reduce(DataFrame.unionByName, found)


def planted(chunks: DataFrame) -> DataFrame:
    """Chunks with the ``file`` of each in the shared folder: its rows by node of the top level of its cover tree, the
    node's center first. A level is found once, and a vector is written once, for all comparisons of its chunk.
    """
    folder = shared_folder(chunks.sparkSession, "trees")
    keys = ["size", "cell", "chunk"]
    kept = ["size", "cell", "closed", "h", "v", "chunk"]

    def run(table: pa.Table) -> pa.Table:
        x = unit(pa.concat_arrays(table.column("vector").chunks))
        level = net(x, np.arange(len(x)), TOP_RADIUS)
        rows = table.select(["node", "copies", "vector"]).take(pa.array(level.order)).append_column(
            "owner", pa.array(np.repeat(np.arange(len(level.center)), np.diff(level.start)), pa.int32()))
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows.schema) as stream:
            stream.write_table(rows)
        file = new_file(folder, "chunk", ".arrow")
        write_bytes(file, out.getvalue())
        return table.select(kept).slice(0, 1).append_column("file", pa.array([file]))

    # cells alone would do for Spark, with all chunks of a cell in one task
    tasks = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = T.StructType([*(chunks.schema[n] for n in kept), T.StructField("file", T.StringType())])
    return materialise(chunks.repartition(tasks, *keys).groupBy(*keys).applyInArrow(run, made), "trees")


class _Chunks:
    """Names and trees of chunks from their files; the last ones stay, up to ``HELD`` bytes of vectors."""

    def __init__(self) -> None:
        self._held: OrderedDict[str, tuple[pa.Array, Tree]] = OrderedDict()

    def __call__(self, file: str) -> tuple[pa.Array, Tree]:
        if file not in self._held:
            table = pa.ipc.open_stream(read_bytes(file)).read_all().combine_chunks()
            x = unit(pa.concat_arrays(table.column("vector").chunks))
            owner = table.column("owner").to_numpy()
            start = np.searchsorted(owner, np.arange(owner[-1] + 2))
            away = np.sqrt(((x - x[start[owner]]) ** 2).sum(1))
            level = Level(start[:-1], np.maximum.reduceat(away, start[:-1]), np.arange(len(x)), start)
            names = pa.concat_arrays(table.column("node").chunks)
            self._held[file] = names, Tree(x, table.column("copies").to_numpy(), level)
        self._held.move_to_end(file)
        while len(self._held) > 2 and sum(tree.x.nbytes for _, tree in self._held.values()) > HELD:
            self._held.popitem(last=False)
        return self._held[file]


def compare(chunks: DataFrame, least: float) -> DataFrame:
    """Rows (``node``, ``links``, ``root``) of each comparison of chunks: at most one for each vector in it.

    Comparisons are rows of two files, dealt by number: tasks read the chunks that they compare, so no cell is one task
    and no vector is moved once for each comparison.
    """
    made = pa.schema([("node", pa.string()), ("links", pa.int64()), ("root", pa.string())])
    trees = planted(chunks)
    first = F.when(F.col("closed"), F.col("h")).otherwise(F.col("chunk"))
    left = trees.where(F.col("chunk") < F.col("h")).select(
        "size", "cell", F.col("chunk").alias("i"), F.col("file").alias("left"),
        F.explode(F.sequence(first, F.col("h") + F.col("v") - 1)).alias("k"))
    right = trees.select("size", "cell", F.col("chunk").alias("k"), F.col("file").alias("right"))
    pairs = materialise(left.join(right, ["size", "cell", "k"]), "comparisons")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunks()
        for batch in batches:
            for i, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (names, a), (others, b) = chunk(i), chunk(k)
                dual = cover_tree.compare(a, a if i == k else b, least)
                found = np.flatnonzero(dual.links)
                if len(found):
                    names = names if i == k else pa.concat_arrays([names, others])
                    yield pa.RecordBatch.from_arrays([
                        names.take(pa.array(found)), pa.array(dual.links[found]),
                        names.take(pa.array(dual.labels[found]))], schema=made)

    count = pairs.count()
    tasks = max(1, min(count, max(4 * chunks.sparkSession.sparkContext.defaultParallelism, count // PER_TASK)))
    order = ["size", "cell", F.floor(F.col("i") / TILE), F.floor(F.col("k") / TILE), "i", "k"]
    return pairs.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("left", "right").mapInArrow(
        run, "node string, links bigint, root string")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    least: float = LEAST_COSINE, chunk_rows: int | None = None) -> DataFrame:
    """Links and component of every row, over all pairs with a cosine of at least ``least`` in double precision.

    Equal vectors are one node with their number as weight, however many there are. A comparison of two chunks of at most
    about ``chunk_rows`` (by default ``CHUNK_ROWS``) vectors returns counts and a spanning forest, never pairs. No vector,
    center or link comes to the driver, only the number of comparisons.

    A vector that is null, empty, zero or has null or non-finite components links with nothing. Vectors of different
    dimensions do not link. Rows that repeat an id count as vectors each; null ids lose to others. An empty table gives
    an empty result; other columns are ignored.

    Returns the id, ``n_links``, ``component_id`` (smallest id reachable), ``kept``.
    """
    ship_code(rows.sparkSession)
    named = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), usable(vector_col).alias("ok"))
    # an unusable vector is a node of its own
    node = F.when(F.col("ok"), F.concat(F.hex(F.xxhash64("vector")), F.hex(F.xxhash64(F.lit("second"), "vector"))))
    named = named.withColumn("node", node)
    nodes = materialise(named.where("ok").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"), F.first("vector").alias("vector")), "vectors")
    root = nodes.select(F.size("vector").alias("size"), F.lit("").alias("cell"), F.lit(True).alias("home"),
                        F.lit(False).alias("closed"), "node", "copies", "vector")
    sized = {} if chunk_rows is None else {"chunk_rows": chunk_rows}
    cells, counted = sub_cells(root, least, **sized)
    found = materialise(compare(chunked(cells, **sized), least).unionByName(counted), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select("node", "root")).withColumnRenamed("node", "member")
    placed = nodes.select("node", "copies", "first").join(links, "node", "left").join(
        roots, F.col("node") == F.col("member"), "left")
    placed = placed.select("node", "copies", "first", F.coalesce("links", F.lit(0)).alias("links"),
                           F.coalesce("component", "node").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    result = materialise(placed.join(smallest.hint("rebalance"), "root").select(
        "node", (F.col("copies") - 1 + F.col("links")).alias("n_links"), "component_id"), "vector-classes")
    linked = named.where("ok").select("id", "node").join(result, "node").select("id", "n_links", "component_id")
    alone = named.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

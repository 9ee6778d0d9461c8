"""Near copies: SimHash anchors, then min-hash bands for what three bits can't reach; whole shingle sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm import simhash
from ledgerloom.llm.common import mark_found, materialise, present_filter, ship_code, text_of
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.unions import merge

#: Words of a shingle and share of common shingles (Jaccard) from which texts are near copies.
WORDS, SIMILAR = 5, 0.8
#: Min-hash bands and hashes in each; texts that share SIMILAR of their shingles agree in no band once in 310,000 times.
BANDS, BAND_HASHES = 24, 4
#: Texts, and shingles of them, that one side of a comparison cell holds on average.
CELL_TEXTS, CELL_SHINGLES = 1024, 1 << 22
_SLACK = 1e-9


def _bands(shingles: np.ndarray) -> list[int]:
    """Min-hash of a set of shingles, as one key a band; none for an empty set."""
    if not len(shingles):
        return []
    rng = np.random.default_rng(simhash.SEED)
    mask, factor = rng.integers(0, 1 << 64, (2, BANDS * BAND_HASHES), np.uint64, endpoint=False)
    low = np.full(BANDS * BAND_HASHES, np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 1 << 12):
        some = shingles[i:i + (1 << 12), None]
        low = np.minimum(low, ((some ^ mask) * (factor | np.uint64(1))).min(0))
    keys = [xxhash.xxh64_intdigest(part.tobytes(), k) for k, part in enumerate(low.reshape(BANDS, BAND_HASHES))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _marked(texts: DataFrame, words: int) -> DataFrame:
    """Per row: ``fp`` (hash of the shingle set, 0 without a word), ``sim`` (its SimHash), ``size`` and ``bands``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sims, sizes, bands = [], [], [], []
            for text in batch.column(2):
                hashes = simhash.shingle_hashes(text.as_py(), words)
                own = np.unique(np.array(hashes, np.uint64))
                fps.append(xxhash.xxh64_intdigest(own.tobytes(), simhash.SEED) if len(own) else 0)
                sims.append(simhash.of_hashes(hashes))
                sizes.append(len(own))
                bands.append(_bands(own))
            fp, sim = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fps, sims))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), fp, sim, pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "text_hash", "fp", "sim", "size", "bands"])

    schema = T.StructType([texts.schema["id"], texts.schema["text_hash"], *T._parse_datatype_string(
        "fp bigint, sim bigint, size bigint, bands array<bigint>").fields])
    return texts.mapInArrow(run, schema)


def _sets(texts: DataFrame, rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Shingle sets (``fp``, ``set``) of the wanted ``fp``; of rows that share one, a single text is opened in the end."""
    key = [F.col("text_hash")]
    chosen = materialise(rows.select("fp", "text_hash").join(wanted, "fp", "left_semi").groupBy("fp").agg(
        F.min("text_hash").alias("text_hash")), "wanted")
    some = mark_found(texts, key, present_filter(chosen, key), "found").where("found")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.unique(np.array(simhash.shingle_hashes(t.as_py(), words), np.uint64)).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["text_hash", "set"])

    sets = some.select("text_hash", "text").mapInArrow(fill, "text_hash bigint, set binary").groupBy("text_hash").agg(
        F.first("set").alias("set"))
    return materialise(sets.join(chosen, "text_hash").select("fp", "set"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) whose sets have that Jaccard similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= similar * (len(x) + len(y) - both) - _SLACK)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(near, pa.bool_())) for c in (batch.column(0), batch.column(1))], ["a", "b"])

    of = lambda name: sets.select(F.col("fp").alias(name), F.col("set").alias(f"set_{name}")).hint("rebalance")
    joined = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint")


def _anchored(rows: DataFrame) -> DataFrame:
    """Candidates by SimHash: what its anchors bring together, as a spanning forest of sets (a, b)."""
    lead = materialise(rows.where("size > 0").groupBy("sim").agg(F.min("fp").alias("lead")), "leads")
    found = simhash.compare_cells(simhash.cut_cells(simhash.replicas(lead.withColumnRenamed("sim", "fp"))))
    ends = [lead.select(F.col("sim").alias(name), F.col("lead").alias(f"lead_{name}")) for name in ("a", "b")]
    across = found.join(ends[0], "a").join(ends[1], "b").select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b"))
    within = rows.where("size > 0").select("fp", "sim").distinct().join(lead.hint("rebalance"), "sim").where("fp <> lead").select(
        F.col("fp").alias("a"), F.col("lead").alias("b"))
    return across.unionByName(within).distinct()


def _led(band: DataFrame) -> DataFrame:
    """A candidate for every text of another component: the leader it shares most bands with.

    The leader of a band is its text with the most company over all its bands, which of a group of copies is the one
    that the others were made from. So a group is linked by as many pairs as it has texts.
    """
    company = band.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    known = band.join(company.hint("rebalance"), "band")
    degree = known.groupBy("fp").agg(F.sum("n").alias("company"))
    placed = band.join(degree.hint("rebalance"), "fp")
    rank = F.struct("company", (-F.col("fp").cast("decimal(20,0)")).alias("order"), "fp", "root")
    leader = placed.groupBy("band").agg(F.max(rank).alias("lead")).select(
        "band", F.col("lead.fp").alias("lead"), F.col("lead.root").alias("lead_root"))
    pairs = placed.join(leader.hint("rebalance"), "band").where("root <> lead_root").groupBy("fp", "lead").count()
    best = pairs.groupBy("fp").agg(F.max(F.struct("count", (-F.col("lead").cast("decimal(20,0)")).alias("order"), "lead"))["lead"].alias("lead"))
    return best.select(F.col("fp").alias("a"), F.col("lead").alias("b"))


def _with_roots(band: DataFrame, links: DataFrame) -> DataFrame:
    """Members of bands that still hold more than one component, with their ``root``."""
    roots = connected_components(links)
    placed = band.join(roots.hint("rebalance"), band["fp"] == roots["node"], "left").select(
        "band", "fp", "size", F.coalesce("component", "fp").alias("root"))
    placed = materialise(placed, "placed")
    mixed = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band")
    return materialise(placed.join(mixed.hint("rebalance"), "band"), "mixed")


def _cells(mixed: DataFrame) -> DataFrame:
    """Deal the members of mixed bands to cells (``band``, ``cell``) so that every pair of a band meets in one.

    Bands with the same members are one. A full band is cut into chunks and each pair of chunks is a cell: its rows
    grow with the number of chunks, and no row stands for a pair of texts.
    """
    hashed = F.xxhash64("fp", F.lit("again"))
    bands = mixed.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"), F.bit_xor("fp").alias("x"), F.bit_xor(hashed).alias("y"))
    one = bands.groupBy("n", "shingles", "x", "y").agg(F.min("band").alias("band"))
    chunks = F.ceil(F.greatest(F.col("n") / CELL_TEXTS, F.col("shingles") / CELL_SHINGLES)).cast("int")
    joined = mixed.join(one.select("band", chunks.alias("chunks")).hint("rebalance"), "band")
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(
        (F.least(chunk, j) * F.col("chunks") + F.greatest(chunk, j)).alias("cell"), (chunk <= j).alias("left"), (chunk >= j).alias("right")))
    return joined.select("band", "fp", "root", F.explode(cells).alias("c")).select("band", "fp", "root", "c.cell", "c.left", "c.right")


def _compared(cells: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Links between components in the cells, at most one row for each text of a cell."""
    def links(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        fps, roots, left, right = (np.array(c) for c in zip(*[r[:4] for r in rows], strict=True))
        held = [np.frombuffer(r[4], np.uint64) for r in rows]
        # rows come by root: a component known before is one from the start
        _, start, inverse = np.unique(roots, return_index=True, return_inverse=True)
        labels = start[inverse]
        sizes = np.array([len(s) for s in held])
        rights = np.flatnonzero(right)
        values, owner = np.concatenate([held[i] for i in rights]), np.repeat(rights, sizes[rights])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        for i in np.flatnonzero(left):
            if (labels[rights] == labels[i]).all():
                continue
            lo, hi = np.searchsorted(values, held[i], "left"), np.searchsorted(values, held[i], "right")
            many = hi - lo
            at = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
            both = np.bincount(owner[at], minlength=len(rows))
            near = np.flatnonzero((both > 0) & (both >= similar * (sizes[i] + sizes - both) - _SLACK) & right)
            if (labels[near] != labels[i]).any():
                labels = merge(labels, np.full(len(near), i), near)
        moved = start[labels[start] != start]
        return fps[moved], fps[labels[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, rows = None, []

        def found() -> pa.RecordBatch:
            a, b = links(rows)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("fp", "root", "left", "right", "set")]
            for cell, row in zip(zip(batch.column("band").to_pylist(), batch.column("cell").to_pylist()), zip(*columns)):
                if cell != here and rows:
                    yield found()
                    rows = []
                here = cell
                rows.append(row)
        if rows:
            yield found()

    with_sets = cells.join(sets.hint("rebalance"), "fp").select("band", "cell", "fp", "root", "left", "right", "set")
    dealt = with_sets.repartition("band", "cell").sortWithinPartitions("band", "cell", "root", "fp")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def similar_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                  similar: float = SIMILAR) -> DataFrame:
    """Component of every row under links of ``similar`` or more common shingles (Jaccard) of so many words.

    Three searches, each for what those before left apart. SimHash: fingerprints within three bits meet at an anchor
    (the operator of :mod:`simhash`, over these shingles). Then min-hash: a text is compared with one leader of its
    bands. Then, in bands that still hold several components, all texts of different ones are compared inside tasks.
    Whole shingle sets decide on every link. So all texts that agree in a band are compared, by links or directly.

    Null text counts as empty; texts without a word are linked with one another. Returns ``id``, ``text_hash``, ``fp``
    (hash of the shingle set, 0 without a word), ``root`` and ``component_id`` (smallest id reachable), as
    :func:`simhash.near_duplicates` does.
    """
    ship_code(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                        text_of(text_col).alias("text"))
    rows = materialise(_marked(texts, words), "bands")
    marks = materialise(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    band = rows.select("fp", "size", F.explode("bands").alias("band")).distinct()
    shared = band.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    band = materialise(band.join(shared.hint("rebalance"), "band").select("band", "fp", "size"), "shared")
    anchored = materialise(_anchored(rows), "anchored")
    wanted = band.select("fp").unionByName(anchored.select(F.col("a").alias("fp"))).unionByName(
        anchored.select(F.col("b").alias("fp"))).distinct()
    sets = _sets(texts, rows, wanted, words)

    links = materialise(_verified(anchored, sets, similar), "links")
    mixed = _with_roots(band, links)
    links = links.unionByName(materialise(_verified(_led(mixed), sets, similar), "links"))
    mixed = _with_roots(band, links)
    links = links.unionByName(materialise(_compared(_cells(mixed), sets, similar), "links"))
    return simhash.components_of(rows, marks, connected_components(links))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
               similar: float = SIMILAR) -> DataFrame:
    """One row of each component of :func:`similar_texts`: that with the smallest id.

    Where rows of a component share that id, the one with the smallest text hash stays, and of rows that repeat id and
    text any one. Null ids stay only in components without any other id.
    """
    found = similar_texts(docs, id_col, text_col, words, similar)
    first = F.struct(F.col("text_hash"), F.col("id"))
    stays = materialise(
        found.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root", "text_hash", "id").count()
        .groupBy("root").agg(F.min(first).alias("row"), F.min_by("count", first).alias("times"))
        .select(F.col("row.id").alias("__id"), F.col("row.text_hash").alias("__kept"), "times"), "stays")
    keyed = docs.withColumn("__hash", F.xxhash64(text_of(text_col)))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__kept"))
    kept = keyed.join(stays.where("times = 1"), same, "left_semi")
    repeated = stays.where("times > 1")
    if not repeated.isEmpty():
        kept = kept.unionByName(keyed.join(repeated, same, "left_semi").dropDuplicates([id_col, "__hash"]))
    return kept.drop("__hash")

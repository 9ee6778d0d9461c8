"""Near duplicates by SimHash: anchor points of a covering code bring fingerprints of few differing bits together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm.common import materialise, ship_code, text_of
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.unions import merge

#: Fixed values of the fingerprint.
SEED, SHINGLE, BITS, MOST_APART = 42, 3, 64, 3
#: Fingerprints at one anchor that a task compares; beyond it the anchor is cut into cells of this size.
CELL_ROWS = 4096
#: Anchors beyond the cell size up to which their list is broadcast (16 bytes each); more of them are joined by shuffle.
BROADCAST_ANCHORS = 100_000
_PAIRS_AT_ONCE = 1 << 21


def shingle_hashes(text: str, shingle: int) -> list[int]:
    """Hashes of all runs of so many words, or of all words if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts[:len(words) - last].tolist(), ends[last:].tolist(),
                                                      strict=True)]


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of a whole text as an unsigned number; 0 if it has no word."""
    return of_hashes(shingle_hashes(text, shingle))


def of_hashes(hashes: list[int]) -> int:
    """SimHash of hashed features, repeats counted; 0 if there are none."""
    if not hashes:
        return 0
    total = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        some = np.array(hashes[i:i + (1 << 14)], "<u8")
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, hash of the text and fingerprint (as a signed long) of every row; null text counts as empty."""
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                       text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks)],
                                             ["id", "text_hash", "fp"])

    schema = T.StructType([rows.schema["id"], rows.schema["text_hash"], T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, schema)


def _anchors(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors near each fingerprint: index of the fingerprint, anchor, whether it is the nearest.

    The fingerprint is cut into two halves; two that differ in three bits or fewer have a half where they differ in
    one at most. The anchors of a half are the words of a covering code of 32 bits, the perfect code of length 31 (any
    position's number is the bit pattern that its parity checks give) beside one free bit, whose covering radius is 1.
    A fingerprint goes to all anchors within covering radius plus one, 2 or 17 of each half.
    """
    position = np.arange(1, 32, dtype=np.int64)
    partner_low = [[(i, i ^ s) for i in range(1, 32) if 0 < (i ^ s) and i < (i ^ s)] for s in range(1, 32)]
    flips = np.zeros((32, 15), np.int64)
    for s, pairs in enumerate(partner_low, 1):
        flips[s] = [(1 << (i - 1)) | (1 << (j - 1)) for i, j in pairs]
    found = []
    unsigned = marks.view(np.uint64)
    for half in (0, 1):
        word = ((unsigned >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        code, free = word & 0x7FFFFFFF, word >> 31
        bits = (code[:, None] >> (position - 1)) & 1
        syndrome = np.bitwise_xor.reduce(bits * position, axis=1)
        nearest = np.where(syndrome > 0, code ^ (1 << np.maximum(syndrome - 1, 0)), code)
        key = lambda c, f: (np.int64(half) << 33 | f << 32 | c)  # noqa: B023, E731
        every = np.arange(len(marks))
        found.append((every, key(nearest, free), np.ones(len(marks), bool)))
        found.append((every, key(nearest, 1 - free), np.zeros(len(marks), bool)))
        off = np.flatnonzero(syndrome)
        far = key(code[off, None] ^ flips[syndrome[off]], free[off, None]).ravel()
        found.append((np.repeat(off, 15), far, np.zeros(len(far), bool)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def replicas(marks: DataFrame) -> DataFrame:
    """Rows (anchor, fp, home) of every distinct fingerprint at every anchor near it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 20_000):
                fp = batch.column(0).slice(i, 20_000).to_numpy(zero_copy_only=False)
                index, anchor, home = _anchors(fp)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[index]), pa.array(home)],
                                                 ["anchor", "fp", "home"])

    return marks.select("fp").mapInArrow(run, "anchor bigint, fp bigint, home boolean")


def cut_cells(rows: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add ``cell``, ``left``, ``right``: rows of one (anchor, cell) are compared, left ones with right ones.

    An anchor of up to ``cell_rows`` rows is one cell. A fuller one is cut into chunks by the hash of the fingerprint;
    every pair of chunks is a cell, so that no task holds more than two chunks of it.
    """
    full = materialise(rows.groupBy("anchor").count().where(F.col("count") > cell_rows).select(
        F.col("anchor"), F.ceil(F.col("count") / cell_rows).cast("int").alias("chunks")), "anchors")
    if full.count() <= BROADCAST_ANCHORS:
        full = F.broadcast(full)
    joined = rows.join(full, "anchor", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    as_left = F.transform(every, lambda j: F.struct(
        (chunk * F.col("chunks") + j).alias("cell"), F.lit(True).alias("left"), (chunk == j).alias("right")))
    as_right = F.transform(every, lambda i: F.struct(
        (i * F.col("chunks") + chunk).alias("cell"), F.lit(False).alias("left"), F.lit(True).alias("right")))
    # a home row of chunk c is left in cells (c, j) and right in cells (i, c); cell (c, c) needs it once
    cells = F.when(F.col("home"), F.concat(as_left, F.filter(
        as_right, lambda x: x["cell"] != chunk * F.col("chunks") + chunk))).otherwise(as_right)
    return joined.select("anchor", "fp", F.explode(cells).alias("c")).select("anchor", "fp", "c.cell", "c.left", "c.right")


def compare_cells(cells: DataFrame, most_apart: int = MOST_APART) -> DataFrame:
    """Links found in the cells, as a spanning forest of what each task sees: at most one row per fingerprint there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        anchor, fp, cell, left, right = (table.column(i).to_numpy() for i in range(5))
        names, node = np.unique(fp, return_inverse=True)
        labels = np.arange(len(names))
        # rows arrive sorted by anchor, cell and side, the right ones of a cell first
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])])
        group = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(fp)]))
        rights = np.add.reduceat(right.astype(np.int64), new)
        lefts = np.flatnonzero(left)
        many = rights[group[lefts]]
        upto = np.cumsum(many)
        start = 0
        while start < len(lefts):
            base = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, base + _PAIRS_AT_ONCE, "right")))
            some, count = lefts[start:stop], many[start:stop]
            a = np.repeat(some, count)
            offset = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
            b = new[group[a]] + offset
            near = np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)) <= most_apart
            labels = merge(labels, node[a[near]], node[b[near]])
            start = stop
        moved = np.flatnonzero(labels != np.arange(len(labels)))
        yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[labels[moved]])], ["a", "b"])

    ordered = cells.repartition("anchor", "cell").sortWithinPartitions("anchor", "cell", F.desc("right"))
    return ordered.select("anchor", "fp", "cell", "left", "right").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Component of every row under links of ``MOST_APART`` or fewer differing bits.

    Equal fingerprints are one node, so copies are never compared. Texts without a word, null ones included, share
    fingerprint zero and are linked like any other. Null ids take part; a component of null ids alone has a null
    ``component_id``. Repeated rows get the same result each. An empty table gives an empty result; other columns are
    ignored.

    Returns ``id``, ``text_hash``, ``fp`` (signed), ``root`` (of the component), ``component_id`` (smallest id
    reachable).
    """
    rows = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    marks = materialise(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    return components_of(rows, marks, connected_components(compare_cells(cut_cells(replicas(marks)))))


def components_of(rows: DataFrame, marks: DataFrame, roots: DataFrame) -> DataFrame:
    placed = marks.join(roots, marks["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialise(placed.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id"),
                        "components")
    return rows.join(named, "fp").select("id", "text_hash", "fp", "root", "component_id")

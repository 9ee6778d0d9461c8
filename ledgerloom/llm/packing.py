"""Best-fit packing after Martello-Toth dominance reduction, planned on counts of lengths."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T, Window

from ledgerloom.llm import token_ids
from ledgerloom.llm.common import materialise, ship_code, text_of

#: Fixed values of the packing: sequence length and the id that ends a document.
CAPACITY, END_ID = 1024, 2
#: Least number of parts into which every length is dealt to be numbered; more if the session shuffles into more.
NUMBERING_PARTS = 64


@dataclass(frozen=True)
class Fill:
    """``sequences`` sequences of the same make-up: (length, how many of it) in order of place."""

    sequences: int
    content: tuple[tuple[int, int], ...]


def _fitting(counts: Counter, most: int, without: int) -> int | None:
    """Largest length in stock up to ``most``; one piece of ``without`` is already taken."""
    for length in range(most, 0, -1):
        if counts[length] - (length == without) > 0:
            return length
    return None


def reduce_by_dominance(counts: Counter, capacity: int = CAPACITY) -> list[Fill]:
    """Fix the sequences that provably dominate all others for their largest piece, and take them out of ``counts``.

    For the largest piece j left, let k be the largest other piece that fits beside it. If none fits, {j} is fixed. If
    j and k fill the sequence, or if no two pieces fit beside j, then whatever stands beside j in some packing can
    change places with k, so {j, k} is fixed. If no three pieces fit beside j, and with b the largest piece that fits
    beside j and k no pair of larger pieces than b fits, then every pair beside j is at most (k, b) piece by piece, so
    {j, k, b} is fixed. Where nothing is fixed for j, smaller pieces are tried. Equal pieces are fixed in bulk.
    """
    fixed = []
    lengths = sorted((n for n in counts if counts[n] > 0), reverse=True)
    for j in lengths:
        while counts[j] > 0:
            k = _fitting(counts, capacity - j, j)
            if k is None:
                fixed.append(Fill(counts[j], ((j, 1),)))
                counts[j] = 0
                break
            small = _smallest(counts, j, 3)
            pair_fits = len(small) >= 2 and j + small[0] + small[1] <= capacity
            if j + k == capacity or not pair_fits:
                times = counts[j] // 2 if j == k else min(counts[j], counts[k])
                if times == 0:
                    break
                # the smallest pieces may change once k runs out, so at most one run of equal pairs at a time
                fixed.append(Fill(times, ((j, 2),) if j == k else ((j, 1), (k, 1))))
                counts[j] -= times
                counts[k] -= times
                continue
            triple_fits = len(small) == 3 and j + sum(small) <= capacity
            if triple_fits or k == j:
                break
            counts[j] -= 1
            counts[k] -= 1
            b = _fitting(counts, capacity - j - k, -1)
            above = _smallest(counts + Counter({k: 1}), -1, 2, b + 1) if b else []
            counts[j] += 1
            counts[k] += 1
            if b is None or b == j or (len(above) == 2 and j + sum(above) <= capacity):
                break
            times = min(counts[j], counts[k] // 2 if b == k else min(counts[k], counts[b]))
            fixed.append(Fill(times, ((j, 1), (k, 2)) if b == k else ((j, 1), (k, 1), (b, 1))))
            counts[j] -= times
            counts[k] -= times
            counts[b] -= times
    return fixed


def _smallest(counts: Counter, without: int, want: int, least: int = 1) -> list[int]:
    """The ``want`` smallest pieces from ``least`` on, with repeats, one of ``without`` taken away."""
    found: list[int] = []
    for length in sorted(n for n in counts if n >= least and counts[n] > 0):
        found += [length] * min(want, counts[length] - (length == without))
        if len(found) >= want:
            break
    return found[:want]


def best_fit(counts: Counter, capacity: int = CAPACITY) -> list[Fill]:
    """Best-fit decreasing on counts: each piece goes to the fullest sequence that takes it, equal ones in bulk."""
    room: dict[int, list[Fill]] = {}
    for length in sorted((n for n in counts if counts[n] > 0), reverse=True):
        left = counts[length]
        while left:
            gap = next((r for r in range(length, capacity) if room.get(r)), None)
            if gap is None:
                each = min(capacity // length, left)
                times, content = left // each, ()
                gap = capacity
            else:
                fill = room[gap].pop()
                each = min(gap // length, left)
                times, content = min(fill.sequences, left // each), fill.content
                if fill.sequences > times:
                    room[gap].append(Fill(fill.sequences - times, content))
            room.setdefault(gap - each * length, []).append(Fill(times, (*content, (length, each))))
            left -= times * each
    return [fill for fills in room.values() for fill in fills]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Fill]:
    """Sequences for pieces of the given lengths; its size depends on the capacity alone, not on the counts."""
    stock = Counter({n: c for n, c in counts.items() if c > 0})
    return reduce_by_dominance(stock, capacity) + best_fit(stock, capacity)


def cut(n_tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only a document beyond the capacity is cut, its first piece is short."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n_tokens, capacity)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
           vocabulary: str | None = None) -> DataFrame:
    """Tokenise whole texts, end each with ``END_ID`` and cut it: ``id``, ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, if wanted, ``ids`` (little-endian unsigned 32-bit)."""
    ship_code(docs.sparkSession)
    shared = token_ids.share(docs.sparkSession, vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids.opened(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                row, made = [], []
                for i, text in enumerate(some.column(1).to_pylist()):
                    ids = np.append(encoder.ids(text), np.uint32(END_ID)).astype("<u4")
                    for p, (start, length) in enumerate(cut(len(ids))):
                        data = ids[start:start + length].tobytes()
                        row.append(i)
                        made.append((p, start, length, zlib.crc32(data), data))
                if not row:
                    continue
                columns = [pa.array(c, t) for c, t in zip(zip(*made), (
                    pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(row)), *columns[:4 + with_ids]], names)

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("piece", T.IntegerType())] + [
        T.StructField(n, T.LongType()) for n in names[2:5]] + [T.StructField("ids", T.BinaryType())] * with_ids)
    return rows.mapInArrow(run, schema)


def _assignments(fills: list[Fill]) -> list[tuple[int, int, int, int, int, int]]:
    """Per run of equal pieces: length, first rank, ranks, first sequence, pieces in each of its sequences, offset."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for fill in fills:
        offset = 0
        for length, each in fill.content:
            rows.append((length, taken[length], fill.sequences * each, sequence, each, offset))
            taken[length] += fill.sequences * each
            offset += length * each
        sequence += fill.sequences
    return rows


def assign(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``id``, ``piece``, ``length``, ``ids_crc32``).

    Lengths are whole numbers up to the capacity, so the packing is planned on at most ``capacity`` counts, whatever
    the number of pieces. Pieces of a length are numbered in parts with the parts' sizes added up, so that no length
    is sorted in one task, and each piece finds its sequence from its number by the table of the plan, which is
    broadcast: it has a row for each length in each make-up, a few thousand at a capacity of 1024.
    """
    spark = cuts.sparkSession
    parts = max(NUMBERING_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    part = F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(parts)).cast("int")
    parted = cuts.withColumn("part", part)
    sizes = materialise(parted.groupBy("length", "part").count(), "lengths")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    runs = spark.createDataFrame(
        _assignments(plan(counts, capacity)) or [(0, 0, 0, 0, 1, 0)],
        "run_length bigint, first bigint, ranks bigint, sequence bigint, each bigint, place bigint")
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select(F.col("length").alias("of"), F.col("part").alias("in"), F.coalesce(before, F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy(*[c for c in cuts.columns if c != "ids"])) - 1
    ranked = parted.withColumn("within", within).join(
        bases, (F.col("length") == F.col("of")) & (F.col("part") == F.col("in")))
    rank = F.col("base") + F.col("within")
    found = ranked.withColumn("rank", rank).join(
        F.broadcast(runs), (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("first") + F.col("ranks")))
    at = F.col("rank") - F.col("first")
    return found.select(
        *cuts.columns, (F.col("sequence") + F.floor(at / F.col("each"))).alias("sequence_id"),
        (F.col("place") + at % F.col("each") * F.col("length")).alias("offset"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
         vocabulary: str | None = None) -> DataFrame:
    """Pack all documents into as few sequences of ``CAPACITY`` tokens as found.

    Null text is an empty document, which is its end id alone. Rows that repeat an id, null ids included, are packed
    each; an empty table gives an empty result; other columns are ignored.

    Returns the columns of ``pieces`` with the id under its own name, ``sequence_id`` and ``offset``.
    """
    cuts = materialise(pieces(docs, id_col, text_col, with_ids, vocabulary), "pieces")
    return assign(cuts).withColumnRenamed("id", id_col)

"""Alignment of two tokenizers over the same texts: windows between verified shared ends, memoised by their ids."""

from __future__ import annotations

import hashlib
import json
import uuid
from array import array
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.llm import token_ids
from ledgerloom.llm.common import materialise, ship_code, text_of

PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Tokens of A in a block of documents: what one task holds at once, and what one group of the last step holds.
BLOCK_TOKENS = 1 << 18
#: Window alignments are remembered from block to block up to so many ids in all.
REMEMBERED_IDS = 1_000_000
#: An id pair is one number: A's id shifted by this, and B's id.
_B_BITS = 32
#: Beyond all ids of A: where a packed window goes over from A to B.
_B_MARK = 1 << 24
#: Characters of the texts that are tokenised in one call, but for one long text.
_CHARS_AT_ONCE = 1 << 18
_OPENED: dict[int, "Aligner"] = {}


class Aligner:
    """Both tokenizers, the bytes of their tokens and the windows seen so far.

    ``seen`` gives a window's number by its id tuples, packed as A's ids and B's ids beyond ``_B_MARK``; ``groups`` has
    each window's groups written out, ``links`` the id pairs of all windows one after another, ``many`` how many of them
    each has.
    """

    def __init__(self, vocabulary: str, pieces: bytes):
        self.a = token_ids.Encoder(vocabulary)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        bytes_a = {i: b for b, i in token_ids.token_bytes(json.loads(vocabulary)).items()}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.marked_a, self.marked_b = (np.array([x[:1] == b" " for x in y]) for y in (self.bytes_a, self.bytes_b))
        # how ids are written: A's within and at the end of a group, B's within and at the end of a group, and of a window
        self.written = [f"{i}{mark}" for ids, marks in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;\n"))
                        for mark in marks for i in range(ids)]
        self.forget()

    def forget(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.links, self.many = array("q"), array("q")
        self.held = 0

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of whole texts by both; None where the bytes of either are not those of the text after a space."""
        found: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text, pieces in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            if not text or b"".join(_of(self.bytes_b, pieces)) != whole:
                found.append(None)
                continue
            a = self.a.plain_ids(" " + text).astype(np.int64)
            # a byte-level vocabulary has every byte, so its tokens spell the text or are none of it
            found.append((a, np.array(pieces, np.int64)) if self.size_a[a].sum() == len(whole) else None)
        return found

    def windows_of(self, texts: list[tuple[np.ndarray, np.ndarray] | None]) -> list[list[int]]:
        """Numbers of the windows of each text, in order; none of a text without tokens.

        Every text begins with a space in both sequences, so texts one after another are cut like one long text, and
        no window reaches from one into the next.
        """
        spelt = [t for t in texts if t is not None]
        if not spelt:
            return [[] for _ in texts]
        numbers, starts = self._cut(*(np.concatenate(x) for x in zip(*spelt, strict=True)))
        ends = np.searchsorted(starts, np.cumsum([len(a) for a, _ in spelt])).tolist()
        parts = iter([numbers[i:j] for i, j in zip([0, *ends], ends)])
        return [[] if t is None else next(parts) for t in texts]

    def windows(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Numbers of a text's windows, in order."""
        return self._cut(a, b)[0]

    def _cut(self, a: np.ndarray, b: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Numbers of the windows of a text, or of texts one after another, in order, and where in A's ids each starts.

        An anchor is a byte where a token of A and one of B begin that both start with a space: the tokens before them
        end there together. Anchors cut both id sequences into windows, most of them one word long.
        """
        start_a, start_b = (np.cumsum(s) - s for s in (self.size_a[a], self.size_b[b]))
        at_a, at_b = np.flatnonzero(self.marked_a[a]), np.flatnonzero(self.marked_b[b])
        # the first token of either begins with the space before the text, so the first anchor is at byte 0
        _, in_a, in_b = np.intersect1d(start_a[at_a], start_b[at_b], assume_unique=True, return_indices=True)
        cut_a, cut_b = np.r_[at_a[in_a], len(a)], np.r_[at_b[in_b], len(b)]
        # a window's ids of A and then of B stand together, so a window is one slice
        packed = np.empty(len(a) + len(b), "<u4")
        packed[np.arange(len(a)) + np.repeat(cut_b[:-1], np.diff(cut_a))] = a
        packed[np.arange(len(b)) + np.repeat(cut_a[1:], np.diff(cut_b))] = b + _B_MARK
        raw, cuts = packed.tobytes(), ((cut_a + cut_b) * 4).tolist()
        keys = [raw[i:j] for i, j in zip(cuts, cuts[1:])]
        found = list(map(self.seen.get, keys))
        if None in found:
            new = {keys[n]: n for n, number in enumerate(found) if number is None}
            n = np.array(list(new.values()))
            self._remember(a, b, list(new), cut_a[n], cut_a[n + 1], cut_b[n], cut_b[n + 1])
            found = [self.seen[key] if number is None else number for key, number in zip(keys, found)]
        return found, cut_a[:-1]

    def _remember(self, a: np.ndarray, b: np.ndarray, new: list[bytes], i: np.ndarray, j: np.ndarray, k: np.ndarray,
                  m: np.ndarray) -> None:
        """Align the new windows, all at once: one after another they read as a text of their own.

        They are A's ids from ``i`` to before ``j`` and B's from ``k`` to before ``m``.
        """
        a, b = a[_ranges(i, j)], b[_ranges(k, m)]
        groups, many, links = self.align(a, b, np.cumsum(m - k))
        first = len(self.groups)
        self.seen.update(zip(new, range(first, first + len(new)), strict=True))
        self.groups += groups
        self.links.frombytes(links.tobytes())
        self.many.frombytes(many.tobytes())
        self.held += len(a) + len(b)

    def align(self, a: np.ndarray, b: np.ndarray, stops: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Groups of each window written out, how many there are, and the id pairs whose tokens end together.

        ``stops`` says where each window's ids of B stop. All windows' bytes are equal on both sides, so shared ends
        cut windows and, within them, groups.
        """
        _, last_a, last_b = np.intersect1d(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), assume_unique=True, return_indices=True)
        many = np.diff(np.r_[0, np.searchsorted(last_b, stops - 1, "right")])
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        code_a, code_b = a.copy(), b + 2 * n_a
        code_a[last_a] += n_a
        code_b[last_b] += n_b
        code_b[stops - 1] += n_b
        # A's ids of a group stand before B's: each is moved by the ids of the other side that come first
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.r_[0, last_b + 1][np.searchsorted(last_a, np.arange(len(a)))]] = code_a
        codes[np.arange(len(b)) + (last_a + 1)[np.searchsorted(last_b, np.arange(len(b)))]] = code_b
        text = "".join([self.written[c] for c in codes.tolist()])
        return text[:-1].split("\n"), many.astype(np.int64), (a[last_a] << _B_BITS) | b[last_b]


def _of(values: list, places: list[int]) -> tuple:
    """The values at some places, in their order."""
    return itemgetter(*places)(values) if len(places) > 1 else tuple(values[i] for i in places)


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All numbers of all ranges, one after another."""
    many = stop - start
    return np.repeat(start - (np.cumsum(many) - many), many) + np.arange(many.sum())


def _share(spark: SparkSession, vocabulary: str | None, pieces: str | None) -> Broadcast:
    """Both vocabulary files for the executors, a few MB whatever the data."""
    with open(vocabulary or token_ids.VOCABULARY, encoding="utf-8") as a, open(pieces or PIECES, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def _opened(shared: Broadcast) -> Aligner:
    key = hash(shared.value)
    if key not in _OPENED:
        _OPENED.clear()
        _OPENED[key] = Aligner(*shared.value)
    return _OPENED[key]


def _portions(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with the place of their first."""
    start, some, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text.as_py()
        if some and size + len(text) > _CHARS_AT_ONCE:
            yield start, some
            start, some, size = i, [], 0
        some.append(text)
        size += len(text)
    if some:
        yield start, some


_MARKS = ["n_a", "n_b", "n_groups", "groups_sha256"]


def aligned_blocks(docs: DataFrame, id_col: str, text_col: str, vocabulary: str | None, pieces: str | None) -> DataFrame:
    """Blocks of whole documents, each with a name: a row per document and one with the block's different id pairs.

    A document's ``links`` are places in the list ``pairs`` of its block; ``times`` says how often the block has each.
    """
    ship_code(docs.sparkSession)
    shared = _share(docs.sparkSession, vocabulary, pieces)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type = rows.schema["id"]
    schema = T.StructType([T.StructField("block", T.StringType()), T.StructField("is_doc", T.BooleanType()), id_type,
                           *T._parse_datatype_string("n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
                                                     "links array<int>, pairs array<bigint>, times array<bigint>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _opened(shared)
        ids: list[pa.Array] = []
        marks: list[tuple[int, int, str]] = []
        sizes: list[int] = []
        windows: list[int] = []

        def block() -> pa.RecordBatch:
            nonlocal ids, marks, sizes, windows
            # a group ends with each link: the ids of both end together there and nowhere else
            each, flat = (np.array(x, np.int64) for x in (aligner.many, aligner.links))
            used = np.array(windows, np.int64)
            many = each[used]
            start = (np.cumsum(each) - each)[used]
            pairs, link, times = np.unique(flat[_ranges(start, start + many)], return_inverse=True, return_counts=True)
            n, name = len(marks), uuid.uuid4().hex
            offsets = np.r_[0, np.cumsum(many)][np.r_[0, np.cumsum(sizes)].astype(np.int64)]
            listed = lambda values, t: pa.array([None] * n + [values], pa.list_(t))
            n_a, n_b, digests = (list(c) for c in zip(*marks))
            made = [pa.array([name] * (n + 1)), pa.array([True] * n + [False]), pa.concat_arrays([*ids, pa.nulls(1, ids[0].type)]),
                    pa.array([*n_a, None], pa.int64()), pa.array([*n_b, None], pa.int64()),
                    pa.array([*np.diff(offsets).tolist(), None], pa.int64()), pa.array([*digests, None], pa.string()),
                    pa.ListArray.from_arrays(pa.array(np.r_[offsets, offsets[-1]].astype(np.int32)), pa.array(link.astype(np.int32))),
                    listed(pairs, pa.int64()), listed(times, pa.int64())]
            ids, marks, sizes, windows = [], [], [], []
            if aligner.held > REMEMBERED_IDS:
                aligner.forget()
            return pa.RecordBatch.from_arrays(made, ["block", "is_doc", "id", *_MARKS, "links", "pairs", "times"])

        held = 0
        for batch in batches:
            for start, some in _portions(batch.column(1)):
                ids.append(batch.column(0).slice(start, len(some)))
                tokens = aligner.tokens(some)
                for found, numbers in zip(tokens, aligner.windows_of(tokens), strict=True):
                    windows += numbers
                    sizes.append(len(numbers))
                    if found is None:
                        marks.append((0, 0, ""))
                    else:
                        written = ";".join(_of(aligner.groups, numbers))
                        marks.append((len(found[0]), len(found[1]), hashlib.sha256(written.encode()).hexdigest()))
                        held += len(found[0])
                if held >= BLOCK_TOKENS or len(marks) >= BLOCK_TOKENS:
                    yield block()
                    held = 0
        if marks:
            yield block()

    return rows.mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``n`` (links in all documents) and ``best``: no other A id is linked more often with its B id."""
    pairs = blocks.where("NOT is_doc").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    total = materialise(pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND((1 << _B_BITS) - 1)
    most = total.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return total.join(most, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
          pieces: str | None = None) -> DataFrame:
    """How the tokens of a byte-level BPE (A) and a sentence-piece model (B) line up in every whole text.

    Both read the text after one space. Byte offsets where a token of each ends cut both sequences into groups, and the
    tokens that end there are linked. The links of all documents are counted by id pair. Returns per row ``id_col``,
    ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links of a pair that no other A id beats at its B id),
    ``count_sum`` (over links) and ``groups_sha256``.

    A text that is null, empty, or not spelt by its tokens (a literal U+2581, say) has zeros and an empty digest. Rows
    that repeat an id are rows each; null ids stay null; other columns are ignored; an empty table gives an empty
    result.

    A block of documents carries each of its pairs once, so what is shuffled to be counted, and back, grows with the
    vocabulary a block uses and not with its links. Blocks are bounded in tokens, but for one long document.
    """
    blocks = materialise(aligned_blocks(docs, id_col, text_col, vocabulary, pieces), "aligned")
    counted = materialise(pair_counts(blocks), "pair-counts")
    own = blocks.where("NOT is_doc").select(F.col("block").alias("of"), F.posexplode("pairs").alias("at", "pair"))
    known = own.join(counted.hint("rebalance"), "pair").select("of", "at", "n", "best")
    rows = blocks.where("is_doc").select("block", "id", *_MARKS, "links")
    id_type = rows.schema["id"]
    schema = T.StructType([id_type, *T._parse_datatype_string(
        "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string").fields])
    nothing = lambda df, names: [F.lit(None).cast(df.schema[n].dataType).alias(n) for n in names]
    both = known.select(F.col("of").alias("block"), F.lit(False).alias("is_doc"), "at", "n", "best", *nothing(rows, ["id", *_MARKS, "links"]))
    both = both.unionByName(rows.select("block", F.lit(True).alias("is_doc"), *nothing(known, ["at", "n", "best"]), "id", *_MARKS, "links"))
    # a block's pairs come before its documents
    return both.repartition("block").sortWithinPartitions("block", "is_doc").mapInArrow(_summed, schema).withColumnRenamed("id", id_col)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of every document over its links, by the counts of its block's pairs; one block's pairs are held at a time."""
    block, parts = None, []
    counts = best = np.zeros(0, np.int64)
    for batch in batches:
        start = 0
        for (of, is_doc), run in groupby(zip(batch.column("block").to_pylist(), batch.column("is_doc").to_pylist(), strict=True)):
            some = batch.slice(start, len(list(run)))
            start += some.num_rows
            if of != block:
                block, parts = of, []
                counts = best = np.zeros(0, np.int64)
            if not is_doc:
                parts.append([some.column(c).to_numpy(zero_copy_only=False) for c in ("at", "n", "best")])
                continue
            if parts:
                at, n, top = (np.concatenate(c) for c in zip(*parts, strict=True))
                counts, best, parts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), []
                counts[at], best[at] = n, top
            links = some.column("links")
            offsets = links.offsets.to_numpy()
            where = links.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
            sums = [np.diff(np.r_[0, np.cumsum(x[where])][offsets - offsets[0]]) for x in (np.ones_like(counts), best, counts)]
            yield pa.RecordBatch.from_arrays(
                [some.column("id"), *[some.column(c) for c in _MARKS[:3]], *map(pa.array, sums), some.column("groups_sha256")],
                ["id", *_MARKS[:3], "n_links", "n_best", "count_sum", "groups_sha256"])

"""Byte-level BPE: a segment tree over adjacent pair ranks yields each merge, for many words at once."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm import token_ids
from ledgerloom.llm.common import ship_code, text_of

#: Bytes of chunks and their ids that a worker remembers; all are forgotten when there are more. Chunks of more letters
#: than ``LONG_CHUNK`` are never remembered. Only speed depends on both.
REMEMBERED_BYTES, LONG_CHUNK = 1 << 26, 256
#: What a remembered chunk takes beside its letters (four bytes each at most) and ids.
_CHUNK_COST = 200
#: Letters of text encoded at once.
AT_ONCE = 1_000_000
#: Words of more bytes are merged one by one.
LONG_WORD = 128
_NONE = np.int64(1) << 62
_PLACE = np.int64((1 << 24) - 1)
# where a space does not begin a chunk of its own: inside a run of white space, but for the run's first and last letter
_INSIDE_A_RUN = re.compile(r" (?=\s|\Z)(?<=\s )")
_CUT = "\x00"


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        ids = token_ids.token_bytes(spec)
        vocabulary = spec["model"]["vocab"]
        self._specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self._specials)) + ")") if self._specials else None
        self._pattern = regex.compile(public_tokenizers.PATTERN)
        self._byte_id = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        key = np.array([vocabulary[a] << 24 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self._key, self._rank = key[order], order.astype(np.int64)
        self._merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)  # by rank
        self._ranks = {int(k): r for r, k in enumerate(key)}
        by_id = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in self._specials.items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self._size = np.array([len(t) for t in tokens], np.int64)
        self._start = np.cumsum(self._size) - self._size
        self._letters = np.frombuffer(b"".join(tokens), np.uint8)
        self._known: dict[str, bytes] = {}
        self._held = 0

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 where it has none."""
        key = left << 24 | right
        at = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
        return np.where(self._key[at] == key, self._rank[at], -1)

    def merge_one(self, word: bytes) -> list[int]:
        """Ids of one word. The tree's root holds the lowest rank and, of equal ones, the leftmost place."""
        n = len(word)
        symbol = [int(i) for i in self._byte_id[np.frombuffer(word, np.uint8)]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        width = 1 << max(n - 1, 1).bit_length()
        none = int(_NONE)
        tree = [none] * (2 * width)
        ranks = self._ranks

        def entry(i: int) -> int:
            j = after[i]
            rank = ranks.get(symbol[i] << 24 | symbol[j]) if j < n else None
            return none if rank is None else rank << 24 | i

        for i in range(n - 1):
            tree[width + i] = entry(i)
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def update(i: int, value: int) -> None:
            i += width
            tree[i] = value
            while i > 1:
                i >>= 1
                low = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == low:
                    break
                tree[i] = low

        while tree[1] != none:
            i = tree[1] & int(_PLACE)
            j = after[i]
            symbol[i] = int(self._merged[tree[1] >> 24])
            symbol[j] = -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            update(j, none)
            update(i, entry(i))
            if before[i] >= 0:
                update(before[i], entry(before[i]))
        return [s for s in symbol if s >= 0]

    def _merge_block(self, words: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of words of 2 to ``width`` + 1 bytes, a tree each, one merge of every word at a time."""
        count, longest = len(words), width + 1
        size = np.fromiter(map(len, words), np.int64, count)
        flat = self._byte_id[np.frombuffer(b"".join(words), np.uint8)]
        column = np.arange(longest)
        real = column < size[:, None]
        symbol = np.full((count, longest + 1), -1, np.int64)
        symbol[:, :longest][real] = flat
        after = np.broadcast_to(np.minimum(column + 1, longest), (count, longest)).copy()
        after = np.minimum(after, size[:, None])
        before = np.broadcast_to(column - 1, (count, longest)).copy()
        tree = np.full((count, 2 * width), _NONE)
        row, place = np.nonzero(real[:, 1:])
        rank = self._look_up(symbol[row, place], symbol[row, place + 1])
        tree[row, width + place] = np.where(rank >= 0, rank << 24 | place, _NONE)
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level = half

        def update(rows: np.ndarray, places: np.ndarray, values: np.ndarray) -> None:
            at = places + width
            tree[rows, at] = values
            while at[0] > 1:  # all leaves are on one level
                at = at >> 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

        def entries(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
            rank = self._look_up(symbol[rows, places], symbol[rows, after[rows, places]])
            ends = after[rows, places] >= size[rows]
            return np.where((rank >= 0) & ~ends, rank << 24 | places, _NONE)

        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            top = tree[rows, 1]
            i = top & _PLACE
            j = after[rows, i]
            k = after[rows, j]
            symbol[rows, i] = self._merged[top >> 24]
            symbol[rows, j] = -1
            after[rows, i] = k
            inner = k < size[rows]
            before[rows[inner], k[inner]] = i[inner]
            last = j < width
            if last.any():
                update(rows[last], j[last], np.full(int(last.sum()), _NONE))
            update(rows, i, entries(rows, i))
            h = before[rows, i]
            inner = h >= 0
            if inner.any():
                update(rows[inner], h[inner], entries(rows[inner], h[inner]))
            rows = rows[tree[rows, 1] != _NONE]
        alive = symbol[:, :longest] >= 0
        return np.split(symbol[:, :longest][alive], np.cumsum(alive.sum(1))[:-1])

    def merge_many(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words, in their order."""
        out: list = [None] * len(words)
        groups: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            n = len(word)
            if n < 2:
                out[k] = self._byte_id[list(word)]
            elif n > LONG_WORD:
                out[k] = np.array(self.merge_one(word))
            else:
                groups.setdefault(max(2, 1 << (n - 2).bit_length()), []).append(k)
        for width, places in groups.items():
            step = max(1, (1 << 19) // width)
            for start in range(0, len(places), step):
                some = places[start:start + step]
                for k, ids in zip(some, self._merge_block([words[k] for k in some], width), strict=True):
                    out[k] = ids
        return out

    def _chunks(self, text: str) -> list[str]:
        """The text in parts that are encoded apart from each other."""
        if _CUT in text or _INSIDE_A_RUN.search(text):
            return self._pattern.findall(text)
        return text.replace(" ", f"{_CUT} ").split(_CUT)

    def _learn(self, chunks: set[str]) -> list[str]:
        """Encode and remember chunks; gives those too long to be remembered beyond their texts."""
        names = list(chunks)
        split = [self._pattern.findall(c) for c in names]
        words = list({w for ws in split for w in ws})
        ids = dict(zip(words, (a.astype("<u4").tobytes() for a in self.merge_many([w.encode() for w in words])),
                       strict=True))
        for name, ws in zip(names, split, strict=True):
            self._known[name] = found = b"".join([ids[w] for w in ws])
            if len(name) <= LONG_CHUNK:
                self._held += 4 * len(name) + len(found) + _CHUNK_COST
        return [name for name in names if len(name) > LONG_CHUNK]

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each whole text, as little-endian unsigned 32-bit numbers; special tokens in a text are found first."""
        held: list[list[list[str] | int]] = []
        size = 0
        for text in texts:
            parts = self._special.split(text) if self._special and self._special.search(text) else [text]
            held.append([self._specials[p] if p in self._specials else self._chunks(p) for p in parts])
            size += len(text)
            if size >= AT_ONCE:
                yield from self._encode_held(held)
                held, size = [], 0
        yield from self._encode_held(held)

    def _encode_held(self, held: list[list[list[str] | int]]) -> Iterator[np.ndarray]:
        if self._held > REMEMBERED_BYTES:
            self._known.clear()
            self._held = 0
        new: set[str] = set()
        for parts in held:
            for part in parts:
                if not isinstance(part, int):
                    new.update(part)
        new.difference_update(self._known)
        long = self._learn(new)
        known = self._known.__getitem__
        made = []
        for parts in held:
            data = [np.array(p, "<u4").tobytes() if isinstance(p, int) else b"".join(map(known, p)) for p in parts]
            made.append(b"".join(data))
        for name in long:
            del self._known[name]
        yield from (np.frombuffer(m, "<u4") for m in made)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, special tokens included; bytes that are not UTF-8 become replacement letters."""
        size = self._size[ids]
        total = int(size.sum())
        shift = self._start[ids] - (np.cumsum(size) - size)
        return self._letters[np.arange(total) + np.repeat(shift, size)].tobytes().decode("utf-8", "replace")


_OPENED: dict[int, Bpe] = {}


def _opened(shared: Broadcast) -> Bpe:
    key = hash(shared.value)
    if key not in _OPENED:
        _OPENED.clear()
        _OPENED[key] = Bpe(shared.value)
    return _OPENED[key]


def encode_and_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_content: bool = False,
                      vocabulary: str | None = None) -> DataFrame:
    """Encode whole texts, decode the ids again, and return the digests of both.

    Null text counts as empty, which has no ids. Every row stands alone: null and repeated ids stay as they are.
    An empty table gives an empty result; other columns are ignored.

    Returns the id, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit numbers),
    ``decoded_sha256`` (of the text in UTF-8) and, if wanted, ``ids`` (those bytes) and ``decoded``.
    """
    ship_code(docs.sparkSession)
    shared = token_ids.share(docs.sparkSession, vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kinds = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    kinds += [("ids", T.BinaryType()), ("decoded", T.StringType())] * with_content

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _opened(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                made = []
                for ids in bpe.encode(some.column(1).to_pylist()):
                    data, text = ids.tobytes(), bpe.decode(ids)
                    made.append((len(ids), hashlib.sha256(data).hexdigest(),
                                 hashlib.sha256(text.encode()).hexdigest(), data, text)[:len(kinds)])
                columns = [pa.array(c) for c in zip(*made, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), *columns], ["id", *(n for n, _ in kinds)])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)] + [T.StructField(n, t) for n, t in kinds])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)

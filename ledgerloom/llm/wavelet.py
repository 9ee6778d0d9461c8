"""Token ids in one compressed file per shard: a wavelet matrix with access, counting and occurrence lookup.

File: magic, length of the header, header (JSON), then sections at the offsets that the header names. The bits of each
plane are cut into blocks of ``BLOCK_BITS``, each compressed on its own (zstd); a directory holds place, length and the number
of ones before each block, so that any question reads a block or two of each plane. The documents (id, number of
tokens) are an Arrow stream.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T, Window
from pyspark.sql.pandas.types import to_arrow_type

from ledgerloom.llm import token_ids
from ledgerloom.llm.common import materialise, shared_folder, ship_code, text_of
from ledgerloom.llm.files import new_file, store, write_bytes

#: Fixed values of the format and of the token stream.
MAGIC, BLOCK_BITS, END_ID = b"WVLTMTX2", 1 << 15, 0
#: Tokens after which a task ends its shard with the document at hand.
SHARD_TOKENS = 1 << 22
_DIRECTORY = np.dtype([("offset", "<u8"), ("length", "<u4"), ("ones", "<u8")])


def encode(ids: np.ndarray, documents: pa.Table, planes: int) -> bytes:
    """The bytes of a shard: its ids, as ``planes`` bit planes, and its documents."""
    codec = pa.Codec("zstd", 1)
    body, at, header = [], 0, {"n": len(ids), "planes": planes, "zeros": [], "directories": []}

    def put(data: bytes) -> int:
        nonlocal at
        body.append(data)
        at += len(data)
        return at - len(data)

    sequence = ids
    for shift in range(planes - 1, -1, -1):
        one, zeros, ones = sequence.dtype.type(1 << shift), [], []
        directory = np.zeros(-(-len(ids) // BLOCK_BITS), _DIRECTORY)
        # block by block, so that what is split stays in the processor's cache
        for k in range(len(directory)):
            some = sequence[k * BLOCK_BITS:(k + 1) * BLOCK_BITS]
            bits = (some & one).astype(bool)
            block = codec.compress(np.packbits(bits, bitorder="little"), asbytes=True)
            directory[k] = put(block), len(block), np.count_nonzero(bits)
            # compress() is about twice as fast as a mask as an index
            zeros.append(np.compress(~bits, some))
            ones.append(np.compress(bits, some))
        directory["ones"] = np.cumsum(directory["ones"]) - directory["ones"]
        header["directories"].append((put(directory.tobytes()), len(directory)))
        header["zeros"].append(sum(map(len, zeros)))
        sequence = np.concatenate([*zeros, *ones]) if zeros else sequence
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as writer:
        writer.write_table(documents)
    stream = zlib.compress(sink.getvalue().to_pybytes(), 6)
    header["documents"] = (put(stream), len(stream))
    head = json.dumps(header).encode()
    return b"".join([MAGIC, struct.pack("<Q", len(head)), head, *body])


class Shard:
    """Questions to one file; reads only the blocks it needs."""

    def __init__(self, uri: str, blocks: int = 256):
        fs, path = store(uri)
        self._file, self._codec = fs.open_input_file(path), pa.Codec("zstd")
        if self._file.read(8) != MAGIC:
            raise ValueError(f"{uri} is no shard")
        (size,) = struct.unpack("<Q", self._file.read(8))
        header = json.loads(self._file.read(size))
        self._base = 16 + size
        self.n, self.planes, self._zeros = header["n"], header["planes"], header["zeros"]
        self._directories = [np.frombuffer(self._read(o, n * _DIRECTORY.itemsize), _DIRECTORY)
                             for o, n in header["directories"]]
        self._documents = header["documents"]
        self._block = lru_cache(blocks)(self._unpacked)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self._file.close()

    def _read(self, offset: int, length: int) -> bytes:
        self._file.seek(self._base + int(offset))
        return self._file.read(int(length))

    def _unpacked(self, plane: int, k: int) -> np.ndarray:
        entry = self._directories[plane][k]
        count = min(BLOCK_BITS, self.n - k * BLOCK_BITS)
        data = self._codec.decompress(self._read(entry["offset"], entry["length"]), (count + 7) // 8, asbytes=True)
        return np.unpackbits(np.frombuffer(data, np.uint8), count=count, bitorder="little")

    def _ones(self, plane: int, i: int) -> int:
        """Ones of a plane before place i."""
        if i == 0:
            return 0
        k = (i - 1) // BLOCK_BITS
        return int(self._directories[plane][k]["ones"]) + int(self._block(plane, k)[:i - k * BLOCK_BITS].sum())

    def _place(self, plane: int, bit: int, count: int) -> int:
        """Place of the bit that has ``count`` equal ones before it."""
        directory = self._directories[plane]
        starts = np.minimum(np.arange(len(directory)) * BLOCK_BITS, self.n)
        before = directory["ones"].astype(np.int64) if bit else starts - directory["ones"].astype(np.int64)
        k = int(np.searchsorted(before, count, "right")) - 1
        return k * BLOCK_BITS + int(np.flatnonzero(self._block(plane, k) == bit)[count - int(before[k])])

    def documents(self) -> pa.Table:
        with pa.ipc.open_stream(zlib.decompress(self._read(*self._documents))) as reader:
            return reader.read_all()

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.planes):
            bit = int(self._block(plane, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self._ones(plane, i)
            value, i = value << 1 | bit, self._zeros[plane] + ones if bit else i - ones
        return value

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        if token >> self.planes:
            return 0, 0
        for plane in range(self.planes):
            a, b = self._ones(plane, start), self._ones(plane, stop)
            if token >> (self.planes - 1 - plane) & 1:
                start, stop = self._zeros[plane] + a, self._zeros[plane] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often an id stands in places from start to before stop."""
        a, b = self._range(token, start, self.n if stop is None else stop)
        return b - a

    def find(self, token: int, k: int) -> int | None:
        """Place of the k-th occurrence (from 0) of an id; None if it has fewer."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            return None
        i = a + k
        for plane in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - plane) & 1
            i = self._place(plane, bit, i - self._zeros[plane] if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids, in order."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        sequence = np.zeros(self.n, kind)
        for plane in range(self.planes - 1, -1, -1):
            above, one = np.empty(self.n, kind), kind(1 << (self.planes - 1 - plane))
            zeros, ones = 0, self._zeros[plane]
            for k in range(len(self._directories[plane])):
                bits = self._unpacked(plane, k).view(bool)
                some, at_zeros, at_ones = above[k * BLOCK_BITS:(k + 1) * BLOCK_BITS], np.flatnonzero(~bits), np.flatnonzero(bits)
                some[at_zeros] = sequence[zeros:zeros + len(at_zeros)]
                some[at_ones] = sequence[ones:ones + len(at_ones)] | one
                zeros, ones = zeros + len(at_zeros), ones + len(at_ones)
            sequence = above
        return sequence.astype(np.uint32)


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 shard_tokens: int = SHARD_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """Tokenise whole texts and write them in ascending order of id, each document ended by ``END_ID``.

    The table is dealt by ranges of id (rows that share one, by text), so each task writes shards of neighbouring
    documents and no shard outgrows ``shard_tokens`` by more than a document. Null ids come first.

    Returns a row per shard: ``shard`` (file), ``part`` and ``turn`` (its place in the order), ``n_tokens``, ``n_docs``.
    """
    ship_code(docs.sparkSession)
    shared = token_ids.share(docs.sparkSession, vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("h"), text_of(text_col).alias("text"))
    id_type = to_arrow_type(rows.schema["id"].dataType)
    made = pa.schema([("shard", pa.string()), ("part", pa.int32()), ("turn", pa.int32()), ("n_tokens", pa.int64()),
                      ("n_docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = token_ids.opened(shared), TaskContext.get().partitionId()
        planes = max(1, (encoder.size - 1).bit_length())
        kind = np.uint16 if planes <= 16 else np.uint32
        held: list[np.ndarray] = []
        names: list = []
        done: list[dict] = []

        def flush() -> None:
            ids = np.concatenate(held)
            table = pa.table({"id": pa.array(names, id_type), "n_tokens": pa.array(map(len, held), pa.int64())})
            shard = new_file(folder, f"part-{part:06d}-{len(done):06d}", ".wvm")
            write_bytes(shard, encode(ids, table, planes))
            done.append({"shard": shard, "part": part, "turn": len(done), "n_tokens": len(ids), "n_docs": len(names)})
            held.clear()
            names.clear()

        size = 0
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(2), strict=True):
                held.append(np.append(encoder.ids(text.as_py()), np.uint32(END_ID)).astype(kind))
                names.append(name.as_py())
                size += len(held[-1])
                if size >= shard_tokens:
                    flush()
                    size = 0
        if held:
            flush()
        yield pa.RecordBatch.from_pylist(done, schema=made)

    ordered = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    return ordered.mapInArrow(run, "shard string, part int, turn int, n_tokens bigint, n_docs bigint")


def read_shards(shards: DataFrame, id_type: T.DataType) -> DataFrame:
    """Documents of all shards from their files: ``id``, ``start``, ``n_tokens``, ``ids_crc32``.

    Only the sizes of the shards, one row each, are added up in one place.
    """
    before = F.sum("n_tokens").over(Window.orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, -1))
    placed = materialise(shards.select("shard", F.coalesce(before, F.lit(0)).alias("base")), "placed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with Shard(uri) as shard:
                    table, ids = shard.documents(), shard.ids().astype("<u4")
                sizes = table.column("n_tokens").to_numpy()
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(ids[e - n:e].tobytes()) for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [table.column("id").combine_chunks(), pa.array(base + ends - sizes), pa.array(sizes),
                     pa.array(crc, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])

    schema = T.StructType([T.StructField("id", id_type), *(
        T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32"))])
    tasks = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(tasks, "shard").mapInArrow(run, schema)


def store_and_read(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None,
                   vocabulary: str | None = None) -> DataFrame:
    """Write all documents as shards in ``folder`` (a new shared one by default) and read them back.

    Null text is an empty document, its end id alone. Rows that repeat an id are documents each, next to each other in
    order of their text's hash. An empty table writes nothing. Other columns are ignored.
    """
    folder = folder or shared_folder(docs.sparkSession, "shards")
    shards = materialise(write_shards(docs, folder, id_col, text_col, vocabulary=vocabulary), "shards-list")
    return read_shards(shards, docs.schema[id_col].dataType).withColumnRenamed("id", id_col)

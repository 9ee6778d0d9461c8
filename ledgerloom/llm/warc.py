"""WARC archives: writing whole-stream gzip files, and normalising them to one gzip member a record with an index."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import mark_found, materialise, repeated_filter, shared_folder, ship_code
from ledgerloom.llm.files import new_file, store, write_bytes

#: Equal payloads below this size are all stored.
REVISIT_BYTES = 100
#: Payload bytes after which a task starts its next archive.
ARCHIVE_BYTES = 128 << 20
_CHUNK = 1 << 18
_END = b"\r\n\r\n"
_ID = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed values of the archive format.
_NOT_IN_A_HEADER = re.compile(r"[\x00-\x20\x7f]")


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Payload, digest and record type of every page.

    Of equal payloads of at least ``REVISIT_BYTES`` the one with the smallest id is the response. Only payloads whose
    digest may repeat are joined; the rest stay where they were read. Null html is an empty payload. Rows that repeat
    the response's id are responses too; null ids are revisits of any other id, and responses among themselves.
    """
    rows = pages.select(
        F.col(id_col).cast("string").alias("page"), F.col(id_col).alias("order"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("long", F.length("payload") >= REVISIT_BYTES)
    key = [F.col("digest")]
    rows = mark_found(rows, key, repeated_filter(rows.where("long"), key), "seen").withColumn(
        "seen", F.col("seen") & F.col("long"))
    first = rows.where("seen").groupBy("digest").agg(F.min("order").alias("first"))
    fields = ["page", "url", "payload", "digest"]
    alone = rows.where(~F.col("seen")).select(*fields, F.lit(None).cast("string").alias("refers_to"))
    grouped = rows.where("seen").join(first, "digest").select(
        *fields, F.when(~F.col("order").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers_to"))
    return alone.unionByName(grouped)


def _record(kind: str, page: str | None, url: str | None, digest: str, payload: bytes, refers_to: str | None,
            date: str) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
            "\r\n\r\n").encode()
    block = http if kind == "revisit" else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{'' if page is None else page}>",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _NOT_IN_A_HEADER.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + _END + block + _END


def write_archives(rows: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of ``mark_revisits``; every archive is one gzip stream from end to end.

    Returns one row per archive: ``archive``, ``records``.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, opened, out, gz, held, count = TaskContext.get().partitionId(), None, None, None, 0, 0
        done = []

        def close():
            out.write(gz.flush())
            out.close()
            done.append((opened, count))

        for batch in batches:
            for page, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    opened = new_file(folder, f"part-{part:06d}", ".warc.gz")
                    fs, path = store(opened)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out, gz = fs.open_output_stream(path, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31)
                    held, count = 0, 0
                kind = "response" if refers_to is None else "revisit"
                out.write(gz.compress(_record(kind, page, url, digest, payload, refers_to, date)))
                held, count = held + len(payload), count + 1
                if held >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist([{"archive": a, "records": n} for a, n in done], schema=written)

    written = pa.schema([("archive", pa.string()), ("records", pa.int64())])
    return rows.select("page", "url", "payload", "digest", "refers_to").mapInArrow(
        write, "archive string, records bigint")


def inflated(uri: str) -> Iterator[bytes]:
    """The content of a gzip file, piece by piece, whether it is one stream or many members."""
    fs, path = store(uri)
    with fs.open_input_stream(path, compression=None) as source:
        gz, fed = zlib.decompressobj(31), False
        while data := source.read(_CHUNK):
            while data:
                fed = True
                yield gz.decompress(data)
                data = gz.unused_data
                if gz.eof:
                    gz, fed = zlib.decompressobj(31), False
    if fed:
        raise ValueError(f"{uri} ends within a gzip stream")


def records(pieces: Iterator[bytes], name: str = "archive") -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Header fields (names in lower case), block and whole bytes of each record; holds one record at a time."""
    buffer, wanted = bytearray(), 0
    head = None
    for piece in pieces:
        buffer += piece
        while True:
            if head is None:
                stop = buffer.find(_END)
                if stop < 0:
                    break
                lines = buffer[:stop].decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"{name}: no record begins where one should")
                head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                start, wanted = stop + 4, stop + 4 + int(head["content-length"]) + 4
            if len(buffer) < wanted:
                break
            yield head, bytes(buffer[start:wanted - 4]), bytes(buffer[:wanted])
            del buffer[:wanted]
            head = None
    if buffer:
        raise ValueError(f"{name}: the last record is cut off")


def normalise_archive(uri: str, folder: str, stem: str) -> tuple[str, str, int]:
    """Inflate one archive once, write each record as a gzip member of its own, and the index beside it.

    An index line holds offset, length, record type and record id, separated by tabs.
    """
    target = new_file(folder, stem, ".warc.gz")
    fs, path = store(target)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    offset, lines = 0, []
    with fs.open_output_stream(path, compression=None) as out:
        for head, _, whole in records(inflated(uri), uri):
            gz = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = gz.compress(whole) + gz.flush()
            out.write(member)
            record_id = head.get("warc-record-id", "").strip("<>")
            lines.append(f"{offset}\t{len(member)}\t{head.get('warc-type', '')}\t{record_id}\n")
            offset += len(member)
    index = target.removesuffix(".warc.gz") + ".idx"
    write_bytes(index, "".join(lines).encode())
    return target, index, len(lines)


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Normalise every archive named in ``archive``. Returns ``archive`` (the new one), ``index``, ``records``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [normalise_archive(a, folder, "norm") for a in frame["archive"]]
            yield pd.DataFrame(made, columns=["archive", "index", "records"])

    return archives.select("archive").repartition(_tasks(archives), "archive").mapInPandas(
        run, "archive string, index string, records bigint")


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _http_length(block: bytes) -> tuple[int, int]:
    """Payload length that the HTTP header states, and where the payload begins."""
    end = block.index(_END)
    for line in block[:end].split(b"\r\n"):
        if line.lower().startswith(b"content-length:"):
            return int(line.split(b":", 1)[1]), end + 4
    return len(block) - end - 4, end + 4


def read_archives(normalised: DataFrame) -> DataFrame:
    """Read every record back by its place in the index.

    Digests of responses are taken anew from the stored payload; those of revisits, like their length, are what the
    record states. Returns ``page`` (id as text), ``url``, ``payload`` (null for revisits), ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``.
    """
    schema = pa.schema([
        ("page", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())])

    def page(value: str | None) -> str | None:
        return (value.strip("<>").removeprefix(_ID) or None) if value is not None else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ifs, ipath = store(index)
                fs, path = store(archive)
                rows, held = [], 0
                with ifs.open_input_stream(ipath) as places, fs.open_input_file(path) as source:
                    for line in places.read().decode().splitlines():
                        offset, length, kind, record_id = line.split("\t")
                        source.seek(int(offset))
                        head, block, _ = next(records(iter([zlib.decompress(source.read(int(length)), 31)]), archive))
                        size, start = _http_length(block)
                        payload = None if kind == "revisit" else block[start:]
                        digest = (head["warc-payload-digest"].removeprefix("sha256:") if payload is None
                                  else hashlib.sha256(payload).hexdigest())
                        rows.append({
                            "page": page(record_id), "url": head.get("warc-target-uri"), "payload": payload,
                            "payload_bytes": size if payload is None else len(payload), "payload_digest": digest,
                            "record_type": kind, "refers_to": page(head.get("warc-refers-to"))})
                        held += len(block)
                        if held > _CHUNK * 64 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return normalised.select("archive", "index").repartition(_tasks(normalised), "archive").mapInArrow(
        read, "page string, url string, payload binary, payload_bytes bigint, payload_digest string, "
              "record_type string, refers_to string")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  folder: str | None = None) -> DataFrame:
    """Archive pages, normalise the archives and read them back.

    The archives and indexes stay in ``folder`` (a new one in the shared folder by default). Null html is an empty
    payload, a null url leaves the record without one, a null id is kept. An empty table writes no archive.
    """
    spark = pages.sparkSession
    ship_code(spark)
    folder = folder or shared_folder(spark, "warc")
    whole = materialise(write_archives(mark_revisits(pages, id_col, url_col, html_col), f"{folder}/whole"), "warc-list")
    members = materialise(normalise_archives(whole, f"{folder}/members"), "warc-members")
    return read_archives(members).withColumn("page", F.col("page").cast(pages.schema[id_col].dataType)).withColumn(
        "refers_to", F.col("refers_to").cast(pages.schema[id_col].dataType)).withColumnRenamed("page", id_col)

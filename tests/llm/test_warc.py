from __future__ import annotations

import gzip
import hashlib
import os
import zlib

import pytest

from ledgerloom.llm import warc

BIG = "<p>" + "long page " * 50
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, "short"), (4, "http://a/ 4\r\nX: y", "short"), (5, "u", None), (6, "u", ""),
        (7, "http://é/", "ünï " * 400_000), (0, "u", BIG), (0, "u", BIG), (None, "u", BIG), (None, "u", "x" * 99), (8, "u", "x" * 99),
        (9, "u", "y" * 100), (10, "u", "y" * 100), (11, "u", "WARC/1.1\r\n\r\n" + "z" * 100)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in ROWS],
                                 "page_id bigint, url string, html string, payload string, digest int").repartition(3)


def want():
    first = {}
    for i, _, h in ROWS:
        data = (h or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(first.get(data, i), i)
    out = []
    for i, _, h in ROWS:
        data = (h or "").encode()
        refers = first.get(data) if len(data) >= 100 and i != first.get(data) else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_round_trip(spark, pages, tmp_path):
    got = warc.archive_pages(pages, folder=str(tmp_path)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == want()
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    assert {r.url for r in got if r.page_id in (3, 4)} == {None, "http://a/%204%0D%0AX:%20y"}
    whole, members = (sorted(os.listdir(tmp_path / d)) for d in ("whole", "members"))
    assert whole and len(members) == 2 * len(whole)
    for name in members:
        if name.endswith(".idx"):
            data = (tmp_path / "members" / name.replace(".idx", ".warc.gz")).read_bytes()
            end = 0
            for line in (tmp_path / "members" / name).read_text().splitlines():
                offset, length, _, _ = line.split("\t")
                assert int(offset) == end
                end += int(length)
                assert zlib.decompress(data[int(offset):end], 31).startswith(b"WARC/1.1\r\n")
            assert end == len(data)


def test_small_archives(spark, pages, tmp_path):
    made = warc.write_archives(warc.mark_revisits(pages), str(tmp_path / "a"), archive_bytes=200).cache()
    assert made.count() > 3 and made.groupBy().sum("records").first()[0] == len(ROWS)


def test_normaliser_takes_members_and_refuses_cut_streams(tmp_path):
    record = warc._record("response", "5", "http://x/", "0" * 64, b"payload", None, "2000-01-01T00:00:00Z")
    (tmp_path / "m.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    (tmp_path / "w.warc.gz").write_bytes(gzip.compress(record + record))
    for name in ("m", "w"):
        made, index, count = warc.normalise_archive(str(tmp_path / f"{name}.warc.gz"), str(tmp_path / "out"), name)
        assert count == 2 and gzip.decompress(open(made, "rb").read()) == record + record
        assert len(open(index).readlines()) == 2
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(record + record)[:-20])
    (tmp_path / "d.warc.gz").write_bytes(gzip.compress(record + record[:-9]))
    for name in ("c", "d"):
        with pytest.raises((ValueError, zlib.error)):
            warc.normalise_archive(str(tmp_path / f"{name}.warc.gz"), str(tmp_path / "out"), name)


def test_empty_table(spark, pages):
    assert warc.archive_pages(pages.limit(0)).count() == 0

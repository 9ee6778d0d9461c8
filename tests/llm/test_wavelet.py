from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from ledgerloom.llm import token_ids, wavelet
from ledgerloom.llm.files import write_bytes

DOCS = pa.table({"id": pa.array([3, None], pa.int64()), "n_tokens": pa.array([1, 2], pa.int64())})


@pytest.mark.parametrize("n, high", [(0, 1), (1, 1), (7, 5), (70_000, 50_257), (40_000, 3)])
def test_shard_answers_as_the_plain_array_does(tmp_path, n, high):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, high - 1).astype(np.uint16)
    uri = str(tmp_path / "x.wvm")
    write_bytes(uri, wavelet.encode(ids, DOCS, 16))
    with wavelet.Shard(uri) as shard:
        assert shard.n == n and shard.documents().equals(DOCS)
        assert np.array_equal(shard.ids(), ids)
        for i in rng.integers(0, n, 20 if n else 0).tolist():
            assert shard.access(i) == ids[i]
        for token in {*ids[:10].tolist(), 0, 49_000, 70_000}:
            where = np.flatnonzero(ids == token)
            assert shard.count(token) == len(where)
            assert shard.count(token, n // 3, n // 2) == (ids[n // 3:n // 2] == token).sum()
            for k in {0, len(where) // 2, len(where) - 1} - {-1}:
                assert shard.find(token, k) == (where[k] if k < len(where) else None)
            assert shard.find(token, len(where)) is None
        with pytest.raises(IndexError):
            shard.access(n)


def test_no_shard(tmp_path):
    (tmp_path / "y").write_bytes(b"something else")
    with pytest.raises(ValueError):
        wavelet.Shard(str(tmp_path / "y"))


def test_documents_come_back_in_order(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 50)) for i in range(200)] + [
        (7, "again"), (7, "again"), (None, "no id"), (500, None), (501, ""), (502, "<|endoftext|> long " * 4000)]
    docs = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id bigint, start string")
    folder = str(tmp_path / "shards")
    got = sorted(wavelet.store_and_read(docs, folder=folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    whole = Tokenizer.from_file(token_ids.VOCABULARY)
    want = sorted((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for ids in (
        [*whole.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows))
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == want


def test_shards_are_cut_and_empty_tables_write_none(spark, tmp_path):
    docs = spark.createDataFrame([(i, "one two three " * 10) for i in range(100)], "doc_id bigint, text string")
    shards = wavelet.write_shards(docs, str(tmp_path / "a"), shard_tokens=100).cache()
    assert shards.count() > 10 and shards.groupBy().sum("n_docs").first()[0] == 100
    found = wavelet.read_shards(shards, docs.schema["doc_id"].dataType).orderBy("start").collect()
    assert [r.id for r in found] == list(range(100))
    assert wavelet.store_and_read(docs.limit(0)).count() == 0


def test_documents_of_white_space_alone_are_stored(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "\n" * 1_000_000), (3, "a b")], "doc_id bigint, text string")
    rows = {r.doc_id: r.n_tokens for r in wavelet.store_and_read(docs).collect()}
    assert rows[1] == 1_000_001 and rows[2] > 1000 and rows[3] == 3


def test_library_vocabulary_is_opened_only_where_needed():
    from ledgerloom.llm import token_ids

    with open(token_ids.VOCABULARY, encoding="utf-8") as f:
        encoder = token_ids.Encoder(f.read())
    encoder.ids("plain words")
    assert not {"whole", "plain"} & vars(encoder).keys()
    assert encoder.size == encoder.whole.get_vocab_size(with_added_tokens=True)


def test_planes_are_split_and_joined_block_by_block(tmp_path, monkeypatch):
    sizes, compress = [], np.compress
    monkeypatch.setattr(np, "compress", lambda mask, ids: sizes.append(len(ids)) or compress(mask, ids))
    for n in (0, 1, wavelet.BLOCK_BITS, 3 * wavelet.BLOCK_BITS + 5):
        ids = np.random.default_rng(n).integers(0, 50_257, n).astype(np.uint16)
        write_bytes(str(tmp_path / f"b{n}"), wavelet.encode(ids, DOCS, 16))
        with wavelet.Shard(str(tmp_path / f"b{n}")) as shard:
            assert (shard.ids() == ids).all()
    assert max(sizes) == wavelet.BLOCK_BITS


def test_the_faster_pattern_splits_alike():
    assert public_tokenizers.PATTERN == token_ids._SPLIT
    parts = [" ", "  ", "\n", "\t", "\u00a0", "\u2003", "a", "I'", "'s", "'ll", "'", "'S", "12", "\u0661", ".", "...", "\u00e9", "e\u0301", "\u4e2d", "\U0001f600", "_"]
    some = random.Random(7)
    for _ in range(4_000):
        text = "".join(some.choices(parts, k=some.randrange(9)))
        assert regex.findall(token_ids._SAME_SPLIT, text) == regex.findall(token_ids._SPLIT, text), text

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, token_ids

PARTS = [" ", "  ", "\n", "\t", " \n", "a", "B", "é", "漢", "1", "²", "'s", "'", "!", "<|endoftext|>", "\x00", "\xa0", "\x1c",
         "\x85", "\U0001F600", "the", "ing", "tion", "́", "ll"]


@pytest.fixture(scope="module")
def ours():
    return bpe.Bpe(open(token_ids.VOCABULARY).read())


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(token_ids.VOCABULARY)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.one_of(st.text(), st.lists(st.sampled_from(PARTS)).map("".join)), max_size=5))
def test_ids_and_text_are_those_of_the_library(ours, whole, texts):
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
        assert ours.decode(ids) == text == whole.decode(ids.tolist(), skip_special_tokens=False)


def test_long_words(ours, whole):
    for text in ("a" * 20_000, "ab" * 300, " " * 5000 + "x", "\n " * 700, "internationalization" * 60, "é" * 129, "x" * 128, "x" * 129):
        (ids,) = ours.encode([text])
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


def plain(ours, word):
    """The textbook way: merge the leftmost pair of the lowest rank until none is left."""
    ids = [int(ours._byte_id[b]) for b in word]
    while True:
        ranks = [ours._ranks.get(a << 24 | b) for a, b in zip(ids, ids[1:])]
        known = [r for r in ranks if r is not None]
        if not known:
            return ids
        i = ranks.index(min(known))
        ids[i:i + 2] = [int(ours._merged[ranks[i]])]


@settings(max_examples=200, deadline=None)
@given(words=st.lists(st.binary(min_size=1, max_size=40), min_size=1, max_size=10))
def test_tree_merges_as_the_plain_way(ours, words):
    want = [plain(ours, w) for w in words]
    assert [a.tolist() for a in ours.merge_many(words)] == want
    assert [ours.merge_one(w) if len(w) > 1 else want[i] for i, w in enumerate(words)] == want


def test_forgetting_changes_nothing(ours, whole, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 3)
    monkeypatch.setattr(bpe, "AT_ONCE", 10)
    texts = [f"some text {i} here " * 3 for i in range(50)]
    assert [i.tolist() for i in ours.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_rows_of_every_kind(spark, whole):
    rows = [(1, "One two"), (1, "One two"), (None, None), (2, ""), (3, "long text " * 20_000), (4, "x<|endoftext|>y")]
    docs = spark.createDataFrame([(i, t, "q", 5) for i, t in rows], "doc_id bigint, text string, decoded string, ids int")
    got = bpe.encode_and_decode(docs, with_content=True).collect()
    want = []
    for i, t in rows:
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), ids, t or ""))
    assert sorted(map(repr, [(r[0], r[1], r[2], r[3], bytes(r[4]), r[5]) for r in got])) == sorted(map(repr, want))
    assert bpe.encode_and_decode(docs.limit(0)).count() == 0


def test_what_is_remembered_is_bounded_in_bytes(whole, monkeypatch):
    ours = bpe.Bpe(open(token_ids.VOCABULARY).read())
    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9FA5, 1500))) for _ in range(30)]
    texts += [" ".join("".join(map(chr, rng.integers(97, 123, 200))) for _ in range(50)) for _ in range(30)]
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 100_000)
    monkeypatch.setattr(bpe, "AT_ONCE", 1)
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
        size = sum(4 * len(k) + len(v) + 200 for k, v in ours._known.items())
        assert size == ours._held <= 200_000 and all(len(k) <= bpe.LONG_CHUNK for k in ours._known)

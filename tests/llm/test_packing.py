from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import packing, token_ids


def fewest(lengths, capacity):
    """Fewest sequences, by search over all ways to place one piece after another."""
    lengths = sorted(lengths, reverse=True)
    states = {()}
    for n in lengths:
        states = {tuple(sorted(s[:i] + (s[i] + n,) + s[i + 1:])) for s in states for i in range(len(s)) if s[i] + n <= capacity} | {
            tuple(sorted((*s, n))) for s in states}
    return min(map(len, states), default=0)


def used(fills):
    total = Counter()
    for f in fills:
        for length, each in f.content:
            total[length] += f.sequences * each
    return total


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=7), st.just(20))
def test_reduction_loses_nothing_of_the_optimum(lengths, capacity):
    stock = Counter(lengths)
    fixed = packing.reduce_by_dominance(stock, capacity)
    assert used(fixed) + stock == Counter(lengths)
    assert sum(f.sequences for f in fixed) + fewest(list(stock.elements()), capacity) == fewest(lengths, capacity)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 50)))
def test_plan_holds_every_piece_once(counts):
    fills = packing.plan(counts, 64)
    assert used(fills) == Counter({n: c for n, c in counts.items() if c})
    assert all(sum(n * e for n, e in f.content) <= 64 and f.sequences > 0 for f in fills)


def test_best_fit_in_bulk_is_best_fit_piece_by_piece():
    rng = np.random.default_rng(3)
    for _ in range(50):
        lengths = sorted(rng.integers(1, 33, rng.integers(0, 60)).tolist(), reverse=True)
        rooms = []
        for n in lengths:
            fit = [r for r in rooms if r >= n]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - n)
            else:
                rooms.append(32 - n)
        made = packing.best_fit(Counter(lengths), 32)
        assert sum(f.sequences for f in made) == len(rooms)


def test_cut():
    assert packing.cut(1) == [(0, 1)] and packing.cut(1024) == [(0, 1024)]
    assert packing.cut(1025) == [(0, 1), (1, 1024)] and packing.cut(2048) == [(0, 1024), (1024, 1024)]


ODD = ["", " ", "  a", "a\n \n b", "don't we'LL I'm", "\x1c \x85 x​q ½²٣ 漢字 \U0001F600 é", "<|endoftext|>", "x <|endoftext|> y",
       "a" * 5000, " " * 3000 + "z", "\n " * 2000, "naïve Ünï  1234 12.5%"]


def test_ids_are_those_of_the_tokenizers_library(spark, folder):
    whole = Tokenizer.from_file(token_ids.VOCABULARY)
    encoder = token_ids.Encoder(open(token_ids.VOCABULARY).read())
    texts = [r[0] for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    for text in ODD + texts:
        assert encoder.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("with_ids", [False, True])
def test_pack(spark, with_ids):
    words = ["alpha ", "beta, ", "gamma\n"]
    rows = [(i, "".join(words[(i * j) % 3] for j in range(i * 7 % 900))) for i in range(300)]
    rows += [(5, "again"), (5, "again"), (None, "no id"), (None, None), (400, None), (401, "long " * 5000)]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id bigint, text string, piece string, length int")
    got = packing.pack(docs, with_ids=with_ids).collect()
    whole = Tokenizer.from_file(token_ids.VOCABULARY)
    want = Counter()
    for i, t in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for p, (s, n) in enumerate(packing.cut(len(ids))):
            want[i, p, s, n, zlib.crc32(ids[s:s + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    if with_ids:
        assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for runs in filled.values():
        runs.sort()
        ends = [o + n for o, n in runs]
        assert [o for o, _ in runs] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(filled) <= -(-sum(r.length for r in got) // 1024) * 1.01 + 1


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, "a" * 1_000_000, "中" * 300_000, "x" + " \n" * 500_000])
def test_long_runs_are_encoded_whole(text):
    with open(token_ids.VOCABULARY, encoding="utf-8") as f:
        encoder = token_ids.Encoder(f.read())
    ids = encoder.ids(text)
    assert encoder.whole.decode(ids.tolist(), skip_special_tokens=False) == text


def test_a_document_of_white_space_alone_is_packed(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "\n" * 1_000_000), (3, "a b")], "doc_id bigint, text string")
    made = packing.pack(docs).collect()
    assert {r.doc_id for r in made} == {1, 2, 3} and sum(r.length for r in made if r.doc_id == 1) == 1_000_001

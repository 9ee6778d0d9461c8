from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from ledgerloom.llm import importance, prefix_crc

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute(docs, target, percent=5, least=20):
    s, t = [0] * 10000, [0] * 10000
    for texts, counts in (([x for _, x in docs], s), (target, t)):
        for text in texts:
            for f in features(text)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (sum(s) + 10000)) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        words, found = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    drawable = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    most = percent * len(drawable) // 100
    drawn = [(*r[:4], k) for k, r in enumerate(drawable[:most], 1)]
    return drawn + [(*r[:4], None) for r in drawable[most:]] + [(*r[:4], None) for r in rows if r[4] < least]


def some_texts(n, seed=1):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices("abcDE9é中-_.", k=rng.randint(1, 7))) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize(("words", "size"), [(1 << 17, 1 << 20), (1, 1), (2, 7), (5, 30)])
def test_ngram_crcs_equal_those_of_their_bytes(monkeypatch, words, size):
    monkeypatch.setattr(prefix_crc, "WORDS_AT_ONCE", words)
    monkeypatch.setattr(prefix_crc, "BYTES_AT_ONCE", size)
    texts = ["", "a", "..", "a b", "x" * 300 + " yy " + "z" * 70_000 + " q r", "A-B_c \n\td", *some_texts(100)]
    found = sorted((o, c) for owner, crc, _, _ in prefix_crc.ngram_crcs(texts) for o, c in zip(owner.tolist(), crc.tolist(), strict=True))
    assert found == sorted((i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in features(t)[1])


def test_shifts_move_a_crc_past_any_length():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 1, 2, 255, 256, 257, 1000, 70_001])
    data = [rng.bytes(20) for _ in lengths]
    got = prefix_crc.shifted(np.array([zlib.crc32(d) for d in data], np.uint32), lengths)
    want = [zlib.crc32(d + b"\0" * n) ^ zlib.crc32(b"\0" * n) for d, n in zip(data, lengths.tolist(), strict=True)]
    assert got.tolist() == want


@pytest.mark.parametrize("case", ["plain", "ties and repeats", "few", "empty"])
def test_resample_equals_brute_force(spark, case):
    texts = some_texts(400)
    docs = list(enumerate(texts))
    if case == "ties and repeats":
        docs = [(i, texts[i % 7]) for i in range(300)] + [(None, texts[3]), (None, None), (500, ""), (501, None), (7, texts[7 % 7])]
        docs.append((900, "word " * 300_000))
    elif case == "few":
        docs = docs[:9]
    elif case == "empty":
        docs = []
    target = some_texts(30, 2) + [None, ""]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, score int, part string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = importance.resample(df, goal)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert all(t == "bigint" for _, t in out.dtypes)
    got, want = [tuple(r) for r in out.collect()], brute(docs, target)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_ranks_go_on_across_ranges(spark):
    rows = [(i, 0, (i * 7919) % 50) for i in range(5000)]
    df = spark.createDataFrame(rows, "id bigint, weight bigint, score bigint").repartition(13)
    got = {r.id: r.rank for r in importance.ranked(df, 1234).collect()}
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert got == {r[0]: k if k <= 1234 else None for k, r in enumerate(order, 1)}


def test_empty_target(spark):
    docs = list(enumerate(some_texts(60)))
    out = importance.resample(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([], "text string"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(brute(docs, []), key=repr)

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerloom.llm import alignment, token_ids


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(token_ids.VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)


def spelt(libraries, text):
    """Ids and end bytes of both, by the libraries alone."""
    a, b = libraries
    if not text:
        return None
    letters = {c: i for i, c in enumerate(token_ids.byte_letters())}
    whole = b" " + text.encode()
    one = a.encode(" " + text, add_special_tokens=False)
    two = b.encode(text)
    bytes_a = [bytes(letters[c] for c in t) for t in one.tokens]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode() for i in two for p in [b.id_to_piece(i)]]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    ends = [[sum(map(len, x[:i + 1])) for i in range(len(x))] for x in (bytes_a, bytes_b)]
    return one.ids, two, *ends


def brute(libraries, texts):
    found, counts = [], Counter()
    for t in texts:
        got = spelt(libraries, t)
        if got is None:
            found.append(None)
            continue
        a, b, ends_a, ends_b = got
        links = [(x, y) for x, e in zip(a, ends_a, strict=True) for y, f in zip(b, ends_b, strict=True) if e == f]
        groups, i, k = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[k:y])))
            i, k = x, y
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        rows.append((n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return rows


NAMED = [None, "", " ", "  two  spaces ", "a\u2581b", "<|endoftext|> <s> </s> <unk> <0x41>", "\n\n\t x", "\x00\x01", "中文 没有 空格", "ﬁ é e\u0301", "𝒳y 🙂🙂",
         "It's 12345,678.90!", "x" * 500, "tab\tnewline\r\nend", "The cat. The cat. The dog."]


def some_texts(n):
    rng = random.Random(4)
    words = ["the", "The", "naïve", "12", "don't", ",", "中", "🙂", "antidisestablishment", "\n", "", "e\u0301", "<s>", "\u00a0"]
    return [" ".join(rng.choices(words, k=rng.randint(0, 25))) for _ in range(n)]


def aligned(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "b", 1) for i, t in rows], "doc_id bigint, text string, block string, n int").repartition(3)
    out = alignment.align(df, **options)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r) for r in out.collect()]


@pytest.mark.parametrize("limit", [1 << 18, 40])
def test_align_equals_brute_force(spark, libraries, limit, monkeypatch):
    monkeypatch.setattr(alignment, "_CHARS_AT_ONCE", limit)
    monkeypatch.setattr(alignment, "BLOCK_TOKENS", limit)
    texts = NAMED + some_texts(60)
    texts += texts[20:24] * 30
    rows = [(None if i == 7 else i // 2, t) for i, t in enumerate(texts)]
    want = [(i, *r) for (i, _), r in zip(rows, brute(libraries, texts), strict=True)]
    assert sorted(aligned(spark, rows), key=repr) == sorted(want, key=repr)


def test_windows_are_remembered_and_spell_the_text(libraries):
    with open(token_ids.VOCABULARY, encoding="utf-8") as a, open(alignment.PIECES, "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    texts = some_texts(40) + ["long " + "x" * 1000]
    for text, want in zip(texts, (spelt(libraries, t) for t in texts), strict=True):
        found = aligner.tokens([text or ""])[0]
        assert (found is None) == (want is None)
        if found is not None:
            numbers = aligner.windows(*found)
            assert numbers == aligner.windows(*found) and None not in numbers
            groups = ";".join(aligner.groups[n] for n in numbers)
            assert [int(x) for g in groups.split(";") for x in g.split("|")[0].split(",")] == want[0]
            assert [int(x) for g in groups.split(";") for x in g.split("|")[1].split(",")] == want[1]
    assert len(aligner.seen) == len(aligner.groups) == len(aligner.many) and aligner.held == sum(len(w) // 4 for w in aligner.seen)
    assert len(aligner.links) == sum(aligner.many)
    aligner.forget()
    assert not aligner.seen and aligner.held == 0


@pytest.mark.parametrize("limit", [0, 60])
def test_forgetting_changes_nothing(spark, libraries, limit, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(alignment, "REMEMBERED_IDS", limit)
    texts = some_texts(60)
    want = [(i, *r) for i, r in enumerate(brute(libraries, texts))]
    assert sorted(aligned(spark, list(enumerate(texts)))) == want


def test_long_texts_and_empty_tables(spark):
    spaces, letters, words = " " * 300_000, "中" * 200_000, "word " * 100_000
    got = {r[0]: r for r in aligned(spark, [(0, spaces), (1, letters), (2, words)])}
    assert got[1][1:] and got[2][3] > 0 and got[2][4] == got[2][3] and got[0][0] == 0
    assert aligned(spark, []) == []


def test_texts_are_cut_together_like_each_alone(monkeypatch):
    with open(token_ids.VOCABULARY, encoding="utf-8") as a, open(alignment.PIECES, "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    texts = ["", *some_texts(40), "a \u2581 b", " ", "a\n", "\n b", ""]
    tokens = aligner.tokens([t or "" for t in texts])
    calls, align = [], aligner.align
    monkeypatch.setattr(aligner, "align", lambda *x: calls.append(1) or align(*x))
    together = aligner.windows_of(tokens)
    assert len(calls) == 1 and None in tokens
    assert together == [[] if t is None else aligner.windows(*t) for t in tokens]
    assert len(calls) == 1
    assert aligner.windows_of([None, None]) == [[], []] and aligner.windows_of([]) == []

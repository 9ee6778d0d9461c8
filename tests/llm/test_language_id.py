from __future__ import annotations

import os
import zlib

import numpy as np
import pytest

from ledgerloom.llm import language_id


def test_whole_texts_count_in_blocks(monkeypatch):
    text = "Ünïcode words and more of them, " * 50
    whole = language_id.features(text)
    monkeypatch.setattr(language_id, "_BLOCK", 100)
    cut = language_id.features(text)
    assert (whole[0] == cut[0]).all() and np.allclose(whole[1], cut[1])


def test_held_out_accuracy_on_the_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.train(docs, ~language_id.held_out())
    found = language_id.identify(docs, model).select("doc_id", "lang", language_id.held_out().alias("held"), "__lang.*").collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held]
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    assert np.mean([r.rejected for r in found]) <= 0.01


def test_prediction_is_blind_to_everything_but_the_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.train(docs, ~language_id.held_out())
    plain = docs.select("doc_id", "text")
    a = {r.doc_id: tuple(r["__lang"]) for r in language_id.identify(docs, model).collect()}
    assert a == {r.doc_id: tuple(r["__lang"]) for r in language_id.identify(plain, model).collect()}


def test_rejection_threshold_is_calibrated():
    rng = np.random.default_rng(0)
    words = [["auf", "der", "und", "heit"], ["the", "and", "ing", "tion"]]
    texts = [(" ".join(rng.choice(words[i % 2], 30)), "de" if i % 2 == 0 else "en") for i in range(400)]
    model = language_id.fit([language_id.features(t) for t, _ in texts], [y for _, y in texts])
    p = [language_id.softmax(language_id.logits(t, model) / model.temperature) for t, _ in texts]
    assert np.mean([model.languages[x.argmax()] == y for x, (_, y) in zip(p, texts, strict=True)]) > 0.99
    margins = [language_id.margin(language_id.logits(t, model)) for t, _ in texts]
    assert np.mean([m < model.threshold for m in margins]) <= 0.01 and model.threshold > 0
    assert language_id.fit([], []) is None


@pytest.mark.parametrize("labels", [("en", "de"), ("en", "en"), (None, None)])
def test_rows_of_every_kind(spark, labels):
    texts = [(1, "the house and the garden"), (2, "das haus und der garten"), (2, "das haus und der garten"), (None, "the and"), (3, None),
             (4, ""), (5, "12 34 !?"), (6, "the and of " * 100_000), (7, "漢字")]
    docs = spark.createDataFrame([(i, t, labels[(i or 0) % 2], "s", 0.5, False) for i, t in texts],
                                 "doc_id bigint, text string, lang string, h string, score double, rejected boolean")
    model = language_id.train(docs, ~language_id.held_out())
    got = language_id.identify(docs, model)
    assert got.columns == [*docs.columns, "__lang"]
    found = [(r.doc_id, r["__lang"]) for r in got.collect()]
    assert len(found) == len(texts)
    for i, r in found:
        if i in (3, 4, 5) or labels[0] is None:
            assert tuple(r) == ("und", 0.0, True)
        else:
            assert r.lang_pred in labels and 0 <= r.score <= 1
    assert language_id.train(docs.limit(0), ~language_id.held_out()) is None
    assert language_id.identify(docs.limit(0), model).count() == 0


OTHERS = {
    "zh": "".join(map(chr, np.random.default_rng(1).integers(0x4E00, 0x9FA5, 300))),
    "ru": "Это просто обычный русский текст, который мы написали для проверки. " * 3, "ar": "هذا نص عربي عادي نستخدمه في الاختبار. " * 3,
    "el": "Αυτό είναι ένα συνηθισμένο κείμενο για τη δοκιμή. " * 3, "ja": "これはテストのために書かれた普通の文章です。" * 3,
    "keys": "".join(np.random.default_rng(2).choice(list("bcdfghjklmnpqrstvwxz "), 400)), "one letter": "a" * 400}


def test_junk_and_languages_not_learnt_are_rejected_and_clean_texts_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/../sf0.01/documents.parquet")  # 200 documents teach too little for it
    labelled = docs.where(~language_id.held_out() & docs.lang.isNotNull() & docs.text.rlike(r"\p{L}")).select("doc_id", "text", "lang").collect()
    # fewer rows are learnt from than there are, so the others calibrate, on the executors
    model = language_id.train(docs, ~language_id.held_out(), train_rows=len(labelled) // 2)
    other = spark.createDataFrame(list(OTHERS.items()), "doc_id string, text string")
    assert [r.doc_id for r in language_id.identify(other, model).collect() if not r["__lang"].rejected] == []
    found = language_id.identify(docs.where("lang IS NOT NULL"), model).collect()
    clean = [r for r in found if any(map(str.isalpha, r.text or ""))]
    assert np.mean([r["__lang"].rejected for r in clean]) <= 0.005
    # by brute force: the margins of all right predictions, and half of the least but one in a thousand
    margins = sorted(language_id.margin(z) for r in labelled for z in [language_id.logits(r.text, model)] if model.languages[z.argmax()] == r.lang)
    assert language_id.OF_WORST * margins[0] <= model.threshold <= language_id.OF_WORST * np.quantile(margins, 0.05)


def test_predictions_are_those_of_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.train(docs, ~language_id.held_out())
    for r in language_id.identify(docs, model).collect():
        text = f" {(r.text or '').lower()} ".encode()
        if not any(map(str.isalpha, r.text or "")):
            assert tuple(r["__lang"]) == ("und", 0.0, True)
            continue
        total, count = np.zeros(len(model.languages)), 0
        if len(text) > 3000:
            continue
        for n in language_id.SUBWORDS:
            for i in range(len(text) - n + 1):
                key = int.from_bytes(text[i:i + n], "big")
                total += model.table[(((key * 2654435761 + n * 97) & 0xFFFFFFFF) * 2246822519 & 0xFFFFFFFF) >> (32 - language_id.BUCKETS_LOG2)]
                count += 1
        z = total / count + model.bias
        p = np.exp(z / model.temperature)
        assert r["__lang"].lang_pred == model.languages[z.argmax()]
        assert abs(r["__lang"].score - (p / p.sum()).max()) < 1e-5


def test_driver_learns_nothing_itself_and_gets_no_rows_of_the_sample(spark, monkeypatch):
    driver, plain, collected = os.getpid(), language_id.fit, []

    def fit(rows, labels):
        assert os.getpid() != driver
        return plain(rows, labels)

    rows = [(i, ("the cat sat on the mat " if i % 2 else "der hund lief durch den wald ") * 3, "en" if i % 2 else "de") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(language_id, "fit", fit)
    collect = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: collected.append(collect(self)) or collected[-1])
    model = language_id.train(docs, ~language_id.held_out())
    assert model.languages == ["de", "en"] and model.threshold > 0
    assert max(map(len, collected), default=0) <= 1
    assert language_id.train(docs.where("false"), ~language_id.held_out()) is None

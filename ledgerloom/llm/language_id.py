"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.llm.common import ship_code, text_of

#: Rows the model is learnt from, at most; they are those with the smallest hash of the id.
TRAIN_ROWS = 3000
#: Hash buckets of the subwords and length of their embeddings.
BUCKETS_LOG2, DIMENSIONS = 15, 16
#: Lengths of the subwords in bytes of the lower-cased text.
SUBWORDS = (2, 3, 4)
EPOCHS, RATE = 6, 0.5
#: A prediction is rejected whose margin (of the best logit over the next) is under ``OF_WORST`` of the margin that all but
#: ``REJECT_RATE`` of the right predictions on calibration rows have: far less than any language learnt shows.
REJECT_RATE, OF_WORST = 0.001, 0.5
#: Temperatures tried. Where all calibration rows come out right, losses say nothing for the lower end, so it is no lower.
TEMPERATURES = np.geomspace(0.5, 20, 40)
#: Every so many-th sampled row calibrates and is not learnt from.
CALIBRATE_EVERY = 5
UNDETERMINED = "und"
#: One in so many ranks is the quantile's error.
_ACCURACY = 100_000
_BLOCK = 1 << 20


@dataclass
class Model:
    """Languages, logits of each bucket, bias, temperature and the margin below which a prediction is rejected."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0


def _buckets(data: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of all subwords, in blocks of bounded size."""
    for start in range(0, len(data), _BLOCK):
        a = np.frombuffer(data, np.uint8, min(_BLOCK + SUBWORDS[-1] - 1, len(data) - start), start).astype(np.uint32)
        key, last = a, len(data) - start <= _BLOCK
        for n in range(2, SUBWORDS[-1] + 1):
            key = (key[:-1] << np.uint32(8)) | a[n - 1:]
            if n in SUBWORDS:
                own = key if last else key[:_BLOCK]
                yield (own * np.uint32(2654435761) + np.uint32(n * 97)) * np.uint32(2246822519) >> np.uint32(
                    32 - BUCKETS_LOG2)


def _bytes(text: str) -> bytes:
    return f" {text.lower()} ".encode("utf-8", "surrogatepass")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and the share of its subwords in each."""
    total = np.zeros(1 << BUCKETS_LOG2, np.int64)
    for b in _buckets(_bytes(text)):
        total += np.bincount(b, minlength=len(total))
    index = np.flatnonzero(total)
    return index, (total[index] / total.sum()).astype(np.float32)


def logits(text: str, model: Model) -> np.ndarray:
    total, count = np.zeros(len(model.languages)), 0
    for b in _buckets(_bytes(text)):
        total += model.table[b].sum(0, dtype=np.float64)
        count += len(b)
    return total / max(count, 1) + model.bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def margin(z: np.ndarray) -> float:
    """By how much the best logit is above the next; without end where one language is all there is."""
    return float(z.max() - np.partition(z, -2)[-2]) if len(z) > 1 else float("inf")


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str]) -> Model | None:
    """Learn embeddings and softmax by stochastic gradient descent; None without labelled rows."""
    if not rows:
        return None
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    rng = np.random.default_rng(7)
    embed = (rng.standard_normal((1 << BUCKETS_LOG2, DIMENSIONS)) * 0.1).astype(np.float32)
    weight = np.zeros((DIMENSIONS, len(languages)), np.float32)
    weight += rng.standard_normal(weight.shape).astype(np.float32) * 0.1
    bias = np.zeros(len(languages), np.float32)
    order = np.arange(len(rows))
    learn = order[order % CALIBRATE_EVERY > 0] if len(rows) > 10 * CALIBRATE_EVERY else order
    check = np.setdiff1d(order, learn) if len(learn) < len(order) else order
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(learn):
            index, share = rows[i]
            mean = share @ embed[index]
            slope = softmax(mean @ weight + bias)
            slope[y[i]] -= 1
            back = weight @ slope
            weight -= rate * np.outer(mean, slope)
            bias -= rate * 0.1 * slope
            # a bucket's step is by its share, scaled so that a document moves as much as its mean does
            embed[index] -= rate * len(languages) * np.outer(share / np.sqrt((share ** 2).sum()), back)
    model = Model(languages, embed @ weight, bias.astype(np.float64))
    z = np.array([rows[i][1].astype(np.float64) @ model.table[rows[i][0]] + model.bias for i in check])
    truth = y[check]
    losses = {t: -np.log(softmax(z / t)[np.arange(len(z)), truth] + 1e-12).mean() for t in TEMPERATURES}
    model.temperature = float(min(losses, key=losses.get))
    right = [margin(x) for x, y in zip(z, truth) if x.argmax() == y]
    if right and len(languages) > 1:
        model.threshold = OF_WORST * float(np.quantile(right, REJECT_RATE, method="lower"))
    return model


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on at most ``train_rows`` of the rows where ``usable`` holds and id, text and language are not null.

    Whole texts are turned to bucket shares on the executors; one task learns from those of the sample, at most
    ``train_rows`` x 32,768 pairs, however large the table or a text is, and the driver gets the model alone. The margin
    below which a prediction is rejected comes from all labelled rows beyond the sample, scored on the executors; where there are none, from those rows of
    the sample that were not learnt from.
    """
    ship_code(docs.sparkSession)
    labelled = docs.where(usable & F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sample = labelled.select(F.xxhash64(id_col).alias("h"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    chosen = sample.select("h").orderBy("h").limit(train_rows).agg(F.max("h")).first()[0]
    if chosen is None:
        return None

    # Arrow's columns, of which one text at a time is made a string: pandas would hold all of a batch twice
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 100):
                some = batch.slice(start, 100)
                made = [features(t.as_py()) for t in some.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array([i.astype("<u2").tobytes() for i, _ in made], pa.binary()),
                     pa.array([s.astype("<f4").tobytes() for _, s in made], pa.binary())], ["h", "lang", "index", "share"])

    # the limit leaves one partition, in order
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            labels += batch.column(1).to_pylist()
            rows += [(np.frombuffer(i.as_buffer(), "<u2"), np.frombuffer(s.as_buffer(), "<f4"))
                     for i, s in zip(batch.column(2), batch.column(3), strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows, labels))], pa.binary())], ["model"])

    rows = sample.where(F.col("h") <= chosen).mapInArrow(
        run, "h bigint, lang string, index binary, share binary").orderBy("h", "lang", "index").limit(train_rows)
    found = rows.mapInArrow(learn, "model binary").first()
    model = pickle.loads(found["model"]) if found is not None else None
    if model is None or len(model.languages) < 2:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def right_margins(langs: pa.Array, texts: pa.Array) -> pa.Array:
        known = shared.value
        found = (logits(t, known) if any(map(str.isalpha, t)) else None for t in (x.as_py() for x in texts))
        return pa.array([margin(z) if z is not None and known.languages[z.argmax()] == y.as_py() else None
                         for z, y in zip(found, langs, strict=True)], pa.float64())

    rest = sample.where(F.col("h") > chosen).select(F.arrow_udf(right_margins, "double")("lang", "text").alias("m"))
    worst = rest.where(F.col("m").isNotNull() & ~F.isnan("m")).agg(F.percentile_approx("m", REJECT_RATE, _ACCURACY)).first()[0]
    if worst is not None:
        model.threshold = OF_WORST * worst
    return model


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Add ``__lang`` (``lang_pred``, ``score``, ``rejected``) to every row, from its whole text.

    A text that is null or has no letter is ``und`` with score 0 and rejected, as is every text where there was
    nothing to learn from. Others get the likeliest language and its calibrated probability; they are rejected where its
    margin is below the model's threshold. All columns of ``docs`` come back.
    """
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pa.Array) -> pa.Array:
        known = shared.value
        out = []
        for text in (x.as_py() for x in texts):
            if known is None or not any(map(str.isalpha, text)):
                out.append((UNDETERMINED, 0.0, True))
                continue
            z = logits(text, known)
            p = softmax(z / known.temperature)
            best = int(p.argmax())
            out.append((known.languages[best], float(p[best]), margin(z) < known.threshold))
        langs, scores, rejected = zip(*out) if out else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
            ["lang_pred", "score", "rejected"])

    udf = F.arrow_udf(predict, T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())]))
    return docs.withColumn("__lang", udf(text_of(text_col)))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))

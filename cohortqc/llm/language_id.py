"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, trained by
follow-the-regularised-leader with an elastic net, then calibrated by a temperature.

Texts are read where they lie. Document frequencies come from all training documents. The classifier is fitted on a
bounded sample: about ``DOCS_PER_LANGUAGE`` training documents of every language, drawn by hash, so the bound depends
on the number of languages and not on the rows. Every fifth document of the sample sets the temperature. The model is a
table of ``BUCKETS`` times languages, mostly zeros, read by the scoring tasks.

Defined results: a null text or one without a letter is ``und`` with score 0. Without labelled training documents all
texts are ``und``. Null languages are not learned from. Repeated rows get the same answer. An empty table gives an empty
result. Ties go to the first language in order of name.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import doc_crc, whole, written

GRAMS, BUCKETS = (1, 2, 3), 1 << 15
DOCS_PER_LANGUAGE, EPOCHS = 1500, 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams of the whole lower-cased text and how often each occurs; runs of white space count
    as one space."""
    points = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    counts = np.zeros(BUCKETS, np.int64)
    mixed = np.zeros(len(points), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        mixed = (mixed[:len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1:] + np.uint64(n))
        if n in GRAMS and len(mixed):
            hashed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            counts += np.bincount((hashed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _frequencies(batches):
    """Document frequencies of one partition; bucket -1 counts the documents."""
    seen, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            seen[grams(text)[0]] += 1
            docs += 1
    found = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1), pa.int64()), pa.array(np.append(seen[found], docs), pa.int64())],
                                     names=["bucket", "docs"])


def inverse_frequencies(train: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of every bucket, over all training documents."""
    total = train.select("text").mapInArrow(_frequencies, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs"))
    found = {r["bucket"]: r["docs"] for r in total.collect()}  # BUCKETS rows at most
    idf = np.full(BUCKETS, np.log(1.0 + found.get(-1, 0)) + 1.0)
    for bucket, docs in found.items():
        if bucket >= 0:
            idf[bucket] = np.log((1.0 + found[-1]) / (1.0 + docs)) + 1.0
    return idf


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text's TF-IDF vector of length one."""
    found, counts = grams(text)
    values = (1.0 + np.log(counts)) * idf[found]
    return found, values / np.sqrt((values ** 2).sum())


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader; the last row is the bias, which is not shrunk."""

    def __init__(self, classes: int):
        self.z, self.n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
        self.l1 = np.full((BUCKETS + 1, 1), L1)
        self.l1[-1] = 0.0

    def weights(self, at) -> np.ndarray:
        z, n, l1 = self.z[at], self.n[at], self.l1[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, found: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(found, BUCKETS), np.append(values, 1.0)[:, None]
        w = self.weights(at)
        error = _softmax((w * x).sum(axis=0))
        error[label] -= 1.0
        gradient = x * error
        squares = self.n[at] + gradient ** 2
        self.z[at] += gradient - (np.sqrt(squares) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = squares


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least loss on documents the fit has not seen."""
    tried = np.exp(np.linspace(np.log(0.02), np.log(5.0), 60))
    if not len(labels):
        return 1.0
    loss = [-np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def _fit(langs: list[str], idf: np.ndarray):
    def run(batches):
        docs = [(text, langs.index(lang)) for b in batches for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist())]
        if not docs:
            return
        vectors = [(*vector(text, idf), label) for text, label in docs]
        model, held = Ftrl(len(langs)), vectors[::5] if len(vectors) >= 10 else []
        learned = [v for i, v in enumerate(vectors) if not held or i % 5]
        for _ in range(EPOCHS):
            for found, values, label in learned:
                model.learn(found, values, label)
        weights = model.weights(slice(None))
        logits = np.array([values @ weights[found] + weights[-1] for found, values, _ in held])
        heat = temperature(logits, np.array([label for *_, label in held], np.int64))
        bucket, lang = np.nonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(bucket, -1), pa.int64()), pa.array(np.append(lang, 0), pa.int32()),
             pa.array(np.append(weights[bucket, lang], heat))], names=["bucket", "lang", "weight"])
    return run


def sample(train: DataFrame, counts: DataFrame) -> DataFrame:
    """text, lang: about ``DOCS_PER_LANGUAGE`` rows of every language, in the order of a hash."""
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    return (train.join(F.broadcast(counts), "lang").withColumn("draw", draw)
            .where(F.col("draw") * F.col("n") < F.lit(float(DOCS_PER_LANGUAGE)) * (1 << 30)).select("text", "lang", "draw"))


def fit(spark: SparkSession, train: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Languages, inverse frequencies, weights (with the bias in the last row), temperature."""
    counts = train.groupBy("lang").agg(F.count("*").alias("n"))
    langs = sorted(r["lang"] for r in counts.collect())
    if not langs:
        return [], np.zeros(BUCKETS), np.zeros((BUCKETS + 1, 0)), 1.0
    idf = inverse_frequencies(train)
    # the bounded sample is learned in one task, in hash order
    rows = sample(train, counts).repartition(1).sortWithinPartitions("draw", "text").drop("draw")
    model = rows.mapInArrow(_fit(langs, idf), "bucket long, lang int, weight double").collect()
    weights, heat = np.zeros((BUCKETS + 1, len(langs))), 1.0
    for bucket, lang, weight in model:
        if bucket < 0:
            heat = weight
        else:
            weights[bucket, lang] = weight
    return langs, idf, weights, heat


def _predict(langs: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
    def run(batches):
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text").to_pylist():
                if not langs or not has_letter(text):
                    names.append(UNKNOWN), scores.append(0.0)
                    continue
                found, values = vector(text, idf)
                chances = _softmax((values @ weights[found] + weights[-1]) / heat)
                best = int(np.argmax(chances))
                names.append(langs[best]), scores.append(float(chances[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(spark: SparkSession, docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of ``docs``; rows marked held out are not learned."""
    train = docs.where(~held_out & F.col("lang").isNotNull()).select("doc_id", "lang", whole("text").alias("text"))
    model = fit(spark, train)
    rows = docs.select("doc_id", held_out.alias("held_out"), whole("text").alias("text"))
    return rows.mapInArrow(_predict(*model), "doc_id long, held_out boolean, lang_pred string, score double")


def contract_fold() -> Column:
    return F.pmod(doc_crc(), F.lit(3)) == 1

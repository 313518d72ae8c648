"""Quality: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import each_text, id_and_text, labelled_sample, whole_text

BUCKETS = 1 << 18
#: The first buckets belong to n-grams of word shapes, the rest to n-grams of words.
SHAPES = 16
SHAPE_BUCKETS = SHAPES * SHAPES * 2
#: Most labelled documents a model is fitted on: a fixed sample by hash order, whatever the input's size.
SAMPLE = 6_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: A feature's value is its share of the text's tokens times this.
SCALE = 10.0
MEMO = 1 << 18
_TOKEN = re.compile(r"\w+|[^\w\s]+")


def shape(token: str) -> int:
    """Class of a token: kind of punctuation, or how its letters are cased."""
    first = token[0]
    if not (first.isalnum() or first == "_"):
        return 8 + crc32(first.encode()) % 7 if len(token) > 1 else 7
    if token.isdigit():
        return 1
    if token.isupper():
        return 2 if len(token) > 1 else 3
    return 4 if token.istitle() else 5 if token.islower() else 6


class _Codes(dict):
    """Token to hash of its lower-case form times ``SHAPES`` plus its shape."""

    def __missing__(self, token: str) -> int:
        code = crc32(token.lower().encode()) * SHAPES + shape(token)
        if len(self) >= MEMO:
            self.clear()
        if len(token) <= 48:
            self[token] = code
        return code


def features(text: str, codes: _Codes) -> np.ndarray:
    """Bucket of every unigram and bigram of words and of shapes; a bigram's shape part says if it repeats a word."""
    tokens = _TOKEN.findall(text)
    code = np.fromiter(map(codes.__getitem__, tokens), np.int64, len(tokens))
    word, kind = code // SHAPES, code % SHAPES
    spread = lambda x: SHAPE_BUCKETS + (x * 0x9E3779B1 & 0xFFFFFFFF) % (BUCKETS - SHAPE_BUCKETS)
    pair = (word[:-1] * 0x85EBCA6B + word[1:]) & 0xFFFFFFFF
    kinds = (kind[:-1] * SHAPES + kind[1:]) * 2 + (word[:-1] == word[1:])
    return np.concatenate((spread(word), spread(pair), kinds))


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-min(60.0, max(-60.0, x)))))


def train(texts: list[str], labels: list[int]) -> np.ndarray:
    """Weights, the bias last. Each coordinate follows its own regularised leader."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    codes = _Codes()
    examples = []
    for text in texts:
        found, counts = np.unique(features(text, codes), return_counts=True)
        tokens = max(1, counts.sum() / 3)
        examples.append((np.append(found, BUCKETS).astype(np.int32), np.append(counts * SCALE / tokens, 1.0)))
    rng = np.random.default_rng(5)
    leader = lambda z, n: np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            at, x = examples[i]
            w = leader(z[at], n[at])
            g = (_sigmoid(float(w @ x)) - labels[i]) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return leader(z, n).astype(np.float32)


class Scorer:
    def __init__(self, weights: np.ndarray):
        self.weights, self.codes = weights, _Codes()

    def score(self, text: str) -> float:
        """Dot product of the weights and the text's sparse features, through the logistic function."""
        found = features(text, self.codes)
        tokens = max(1.0, len(found) / 3)
        return _sigmoid(float(self.weights[found].sum(dtype=np.float64)) * SCALE / tokens + float(self.weights[BUCKETS]))


def fitted(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality") -> np.ndarray:
    """Weights from a fixed sample of at most ``SAMPLE`` labelled documents, trained in one task that gets no more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ys = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            ys += batch.column("y").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([train(texts, ys).tobytes()])], names=["weights"])

    rows = labelled_sample(docs, labels, learn, label, SAMPLE).mapInArrow(task, "weights binary").collect()
    return np.frombuffer(bytes(rows[0]["weights"]), np.float32) if rows else np.zeros(BUCKETS + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every row, over its whole text; null and blank texts score by the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = [scorer.score(t) for t in each_text(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return id_and_text(docs).select("doc_id", whole_text().alias("text")).mapInArrow(task, "doc_id long, score double")


def learnable(doc_id: Column) -> Column:
    """Labels may be learnt from these documents; null for a null id, which is never learnt from."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Only the text enters a score. A null or blank text scores by the model's bias. Without labels every score is
    0.5. A null doc_id is held out. Rows that repeat each get a row, no rows give no rows; null labels are left out,
    and of several labels of a document the highest counts.
    """
    found = score(docs, fitted(docs, labels, learnable(F.col("doc_id"))))
    return found.select("doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(True)).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))

"""Toxicity: subword embeddings averaged over a text into a linear softmax, trained jointly."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import each_text, id_and_text, labelled_sample, whole_text

BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (3, 4)
#: Most labelled documents a model is fitted on: a fixed sample by hash order, whatever the input's size.
SAMPLE = 6_000
EPOCHS = 12
RATE = 1.5
#: Each step shrinks the embeddings that it touches by this share of the rate, so that rare words are not learnt by heart.
SHRINK = 5e-4
#: A text is scored in half-overlapping spans of so many words, the most toxic of which decides: an insult in a
#: long text counts as it would in a short one.
SPAN = 512
MEMO = 1 << 18


def subwords(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams, so that misspellings share most of them."""
    core = word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") or word
    marked = f"<{core}>"
    grams = [marked[i : i + n] for n in range(GRAMS[0], GRAMS[1] + 1) for i in range(len(marked) - n + 1)]
    return [crc32(g.encode()) % BUCKETS for g in (marked, *grams)]


class Bags:
    """Labelled texts as word numbers, and the subword buckets of each distinct word."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        self.texts = [np.array([numbers.setdefault(w, len(numbers)) for w in t.lower().split()], np.int32) for t in texts]
        sizes, buckets = array("i"), array("i")
        for word in numbers:
            found = subwords(word)
            sizes.append(len(found))
            buckets.extend(found)
        self.sizes, self.buckets = np.array(sizes, np.int64), np.array(buckets, np.int32)
        self.starts = np.concatenate(([0], self.sizes.cumsum()))[:-1].astype(np.int64)

    def average(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets and their weights in the average over words of the average over subwords."""
        distinct, counts = np.unique(words, return_counts=True)
        sizes = self.sizes[distinct]
        within = np.arange(sizes.sum()) - np.repeat(sizes.cumsum() - sizes, sizes)
        buckets, where = np.unique(self.buckets[np.repeat(self.starts[distinct], sizes) + within], return_inverse=True)
        return buckets, np.bincount(where, np.repeat(counts / sizes / len(words), sizes)).astype(np.float32)


def worst_span(values: np.ndarray) -> float:
    """The highest mean of a span of words."""
    total = np.concatenate(([0.0], values.cumsum()))
    starts = np.arange(0, max(1, len(values) - SPAN // 2), SPAN // 2)
    ends = np.minimum(starts + SPAN, len(values))
    return float(((total[ends] - total[starts]) / (ends - starts)).max())


class Model:
    """For scoring, two classes need one number per bucket: its embedding times the difference of the class weights."""

    def __init__(self, values: np.ndarray, bias: float):
        self.values, self.bias = values, bias
        self.of_word = _Memo(values)

    def score(self, text: str) -> float:
        words = text.lower().split()
        if not words:
            return _sigmoid(self.bias)
        each = np.fromiter(map(self.of_word.__getitem__, words), np.float64, len(words))
        return _sigmoid(self.bias + worst_span(each))


class _Memo(dict):
    def __init__(self, values: np.ndarray):
        super().__init__()
        self.values = values

    def __missing__(self, word: str) -> float:
        value = float(self.values[subwords(word)].mean())
        if len(self) >= MEMO:
            self.clear()
        if len(word) <= 48:
            self[word] = value
        return value


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -60, 60))))


def train(texts: list[str], labels: list[int]) -> Model:
    """Embeddings and softmax weights together, by adaptive gradient steps with shrinking embeddings.

    What a bucket adds to a score is averaged over the later half of the passes, so that the order of rows matters less. Training averages whole texts; a model of several texts without words, or of one label only, has
    a bias and nothing else.
    """
    rng = np.random.default_rng(7)
    bags = Bags(texts)
    used = [i for i, words in enumerate(bags.texts) if len(words)]
    if len({labels[i] for i in used}) < 2:  # nothing to tell apart
        share = float(np.mean([labels[i] for i in used])) if used else 0.5
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((share + 0.01) / (1.01 - share))))
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights = (rng.uniform(-1, 1, (DIMENSIONS, 2)) / DIMENSIONS).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_v, seen_w, seen_b = np.full(BUCKETS, 1e-6, np.float32), np.full((DIMENSIONS, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    averages = {i: bags.average(bags.texts[i]) for i in used}
    values, bias_of_one, later = np.zeros(BUCKETS, np.float32), 0.0, range(EPOCHS // 2, EPOCHS)
    for epoch in range(EPOCHS):
        for i in rng.permutation(used):
            idx, share = averages[i]
            rows = vectors[idx]
            hidden = share @ rows
            logits = hidden @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            to_hidden = weights @ p
            grad = np.outer(hidden, p)
            seen_w += grad * grad
            seen_b += p * p
            seen_v[idx] += share * share * float(to_hidden @ to_hidden) / DIMENSIONS
            vectors[idx] = rows - (RATE / np.sqrt(seen_v[idx]) * share)[:, None] * to_hidden - RATE * SHRINK * rows
            weights -= RATE / 10 / np.sqrt(seen_w) * grad
            bias -= RATE / 10 / np.sqrt(seen_b) * p
        if epoch in later:
            values += (vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32) / len(later)
            bias_of_one += float(bias[1] - bias[0]) / len(later)
    return Model(values, bias_of_one)


def fitted(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic") -> Model:
    """The model of a fixed sample of at most ``SAMPLE`` labelled documents, trained in one task that gets no more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ys = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            ys += batch.column("y").to_pylist()
        model = train(texts, ys)
        yield pa.RecordBatch.from_arrays([pa.array([model.values.tobytes()]), pa.array([model.bias])], names=["weights", "bias"])

    sample = labelled_sample(docs, labels, learn, label, SAMPLE)
    rows = sample.mapInArrow(task, "weights binary, bias double").collect()
    return Model(np.frombuffer(bytes(rows[0]["weights"]), np.float32), rows[0]["bias"]) if rows else train([], [])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row, over its whole text; null and blank texts score by the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast((model.values, model.bias))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = [own.score(t) for t in each_text(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return id_and_text(docs).select("doc_id", whole_text().alias("text")).mapInArrow(task, "doc_id long, score double")


def learnable(doc_id: Column) -> Column:
    """Labels may be learnt from these documents; null for a null id, which is never learnt from."""
    return F.crc32(doc_id.cast("string")) % 3 != 1


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Only the text enters a score. A null or blank text scores by the model's bias. Without labels every score is
    0.5. A null doc_id is held out. Rows that repeat each get a row, no rows give no rows; null labels are left out,
    and of several labels of a document the highest counts.
    """
    found = score(docs, fitted(docs, labels, learnable(F.col("doc_id"))))
    return found.select("doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(True)).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are; texts do not leave their tasks."""
    model = fitted(docs, labels, learnable(F.col("doc_id")))
    shared = docs.sparkSession.sparkContext.broadcast((model.values, model.bias))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array([own.score(t or "") < threshold for t in each_text(batch)], pa.bool_()))

    return docs.mapInArrow(task, docs.schema)

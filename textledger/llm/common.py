"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.settle import fresh_path

#: White space of the contracts as a pattern of the complement: words between ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only what an operator reads: extra columns, whatever their names, stay behind."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def whole_text(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def each_text(batch: pa.RecordBatch) -> Iterator[str | None]:
    """The texts of a batch one by one: a task holds one of them as a Python string, not all."""
    return (text.as_py() for text in batch.column("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once. A plain column that a lambda reads may be pasted into it, and so be worked out per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shuffled(rows: DataFrame) -> DataFrame:
    """``rows`` for a join that moves both sides. Spark sizes a table after an ``explode`` as if it had one row for each before, and a compressed
    file as if that were its size in memory, so without this it may collect and broadcast a side that grows with the input."""
    return rows.hint("merge")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own intermediates."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that are begun within the block are removed at its end: what is built on them must be written by then."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            drop_folder(spark, path)


class Scratch:
    """Intermediate tables of one job in the shared folder; ``lasting`` ones are not swept."""

    def __init__(self, spark: SparkSession, name: str, lasting: bool = False):
        self.spark, self.base, self.count = spark, fresh_path(spark, name), 0
        if not lasting and (made := _made.get()) is not None:
            made.append(self.base)

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count}"
        df.write.mode("errorifexists").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        return out

    def drop_before_last(self) -> None:
        if self.count > 1:
            drop_folder(self.spark, f"{self.base}/{self.count - 1}")


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, label: str, most: int) -> DataFrame:
    """(text, y) of at most ``most`` labelled documents in one partition, in hash order of their ids: the same in every run.

    ``learn`` is a condition on doc_id. The ids are chosen first, so that only their texts move; their number, at
    most ``most``, bounds the broadcast, and the second limit holds where documents repeat an id.
    """
    chosen = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("y"))
              .where(F.col("y").isin(0, 1) & learn).groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    texts = id_and_text(docs).where(F.col("doc_id").isNotNull())
    return (texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", whole_text().alias("text"))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(most).select("text", "y"))

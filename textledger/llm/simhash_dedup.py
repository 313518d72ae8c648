"""Near-duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, each_text, id_and_text, shuffled, whole_text
from .components import connected_components

SEED = 42
#: Fingerprints link at this many differing bits or fewer; the segments and radii below follow from it.
MAX_DISTANCE = 2
#: Radius searched in each segment of 32 bits: with at most two differing bits in all, either the
#: first segment differs in at most one bit or the second in none.
RADII = (1, 0)
HALF = 0xFFFFFFFF
#: Buckets with more fingerprints than this are searched by a second small ball instead of by pairs.
DENSE = 32
_ROWS = 1 << 16


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Hashes of the shingles of a text, repeats included; fewer words than ``width`` are one shingle, no words none."""
    words = text.encode().lower().split()  # bytes: exactly A-Z and ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    shingles = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, max(1, len(words) - width + 1))


def simhash(text: str, width: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit number."""
    hashes = shingle_hashes(text, width)
    total = len(hashes)
    if not total:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, total, _ROWS):
        block = hashes[at : at + _ROWS].astype("<u8", copy=False).view(np.uint8)
        counts += np.unpackbits(block, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<i8")[0])


def _fingerprinted(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with the fingerprint fp in place of its column text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(t, width) for t in each_text(batch)]
            others = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in others), pa.array(found, pa.int64())], names=[*others, "fp"])

    return rows.mapInArrow(task, ", ".join([*(f"{name} {kind}" for name, kind in rows.dtypes if name != "text"), "fp long"]))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; a null text counts as empty and has fingerprint zero."""
    return _fingerprinted(id_and_text(docs).select("doc_id", whole_text().alias("text")), width)


def _segment(fp: Column, which: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if which == 0 else fp.bitwiseAND(F.lit(HALF))


def _zero_bits_set(value: Column) -> Column:
    """Values with one zero bit of the segment set: of two values one bit apart, one gives the other."""
    bits = F.array(*(F.lit(1 << b) for b in range(32)))
    return F.transform(F.filter(bits, lambda b: value.bitwiseAND(b) == 0), lambda b: value.bitwiseOR(b))


def _ball(value: Column) -> Column:
    """The value and all values one bit apart."""
    bits = F.array(F.lit(0), *(F.lit(1 << b) for b in range(32)))
    return F.transform(bits.cast("array<bigint>"), lambda b: value.bitwiseXOR(b))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): enough pairs within ``MAX_DISTANCE`` bits that all linked fingerprints are connected.

    ``distinct`` has one column ``fp`` without repeats. Each segment has a table of its values.
    A fingerprint looks up the small Hamming ball around each of its segments and verifies the
    complete distance of all it finds. In a bucket of more than ``DENSE`` fingerprints, pairs
    would grow with the square of a group of near copies: there the lookups also enumerate the ball of
    radius 1 in the other segment. All fingerprints that meet in such a cell are within two bits of each
    other, every pair of the bucket within two bits meets in one, and a cell links its few members to the
    smallest, so that no connection is lost. Only the list of dense buckets, fewer than one for 16 fingerprints, may be broadcast.
    """
    fp, apart = F.col("fp"), F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    values = F.array(*(F.struct(F.lit(k).alias("k"), _segment(fp, k).alias("value")) for k in range(len(RADII))))
    table = distinct.select("fp", F.explode(values).alias("s")).select("fp", "s.k", "s.value")
    around = distinct.select("fp", F.lit(0).alias("k"), F.explode(_zero_bits_set(_segment(fp, 0))).alias("value"))
    probes = table.withColumn("own", F.lit(True)).union(around.withColumn("own", F.lit(False)))
    dense = table.groupBy("k", "value").count().where(F.col("count") > DENSE).select("k", "value")

    sparse = table.join(dense, ["k", "value"], "left_anti").withColumnRenamed("fp", "b")
    pairs = (probes.withColumnRenamed("fp", "a").join(shuffled(sparse), ["k", "value"])
             .where((~F.col("own") | (F.col("a") < F.col("b"))) & (apart <= MAX_DISTANCE)).select("a", "b"))

    other = F.when(F.col("k") == 0, _segment(fp, 1)).otherwise(_segment(fp, 0))
    centres = F.when(F.col("own"), _ball(other)).otherwise(F.array(other))
    cells = (probes.join(shuffled(dense), ["k", "value"]).select("fp", "k", "value", F.explode(centres).alias("centre"))
             .groupBy("k", "value", "centre").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).where(F.size("all") > 1))
    starred = cells.select("a", F.explode("all").alias("b")).where((F.col("a") != F.col("b")) & (apart <= MAX_DISTANCE))
    return pairs.union(starred)


def _rooted(scratch: Scratch, marked: DataFrame, first: Column) -> DataFrame:
    """(fp, first, root) of each distinct fingerprint of ``marked``: ``first`` over its rows, and the smallest fingerprint reachable."""
    distinct = scratch.keep(marked.groupBy("fp").agg(first.alias("first")))
    roots = connected_components(scratch.spark, links(distinct.select("fp")), "simhash-components")
    return distinct.join(shuffled(roots.withColumnRenamed("node", "fp")), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``.

    Documents link when their fingerprints differ in at most ``MAX_DISTANCE`` bits;
    component_id is the smallest doc_id reachable. Null and blank texts have fingerprint zero and link like
    any other. Rows that repeat a doc_id each get a row; a null doc_id takes part, but never names a
    component: component_id is null only where no member has an id. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.keep(fingerprints(docs, width))
    rooted = _rooted(scratch, marked, F.min("doc_id"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = rooted.select("fp", "root").join(shuffled(named), "root").select("fp", "component_id")
    return marked.join(shuffled(groups), "fp").select("doc_id", "fp", "component_id")


def _row_key(doc_id: Column, text: Column) -> Column:
    """One value for doc_id and text together, so that rows meet by one key and are told apart where an id repeats."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("\n"), whole_text(text))))


def only_first(docs: DataFrame, rooted: DataFrame, unnamed_stay: bool) -> DataFrame:
    """The rows of ``docs`` that are the smallest ``first`` of a root of ``rooted``, all columns as they are."""
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    chosen = (firsts.where("NOT first.unnamed") if unnamed_stay else firsts).select(F.col("first.key").alias("kept"))
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    keyed = packed.withColumn("key", _row_key(F.col("row.doc_id").cast("long"), F.col("row.text").cast("string")))
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))  # rows of one key have one text
    stay = keyed.join(shuffled(chosen), F.col("key") == F.col("kept")).withColumn("nth", first).where("nth = 1").select("row.*")
    return stay.unionByName(packed.where("row.doc_id IS NULL").select("row.*")) if unnamed_stay else stay


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text) of every row, null texts empty."""
    return id_and_text(docs).select("doc_id", _row_key(F.col("doc_id"), F.col("text")).alias("key"), whole_text().alias("text"))


def first_member() -> Column:
    """The member of a group that stays: the smallest id, rows without one last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key"))


def keep_one(docs: DataFrame, width: int = 3, unnamed_stay: bool = True) -> DataFrame:
    """One row of each component, all columns as they are: the one with the smallest doc_id.

    Rows are told apart by doc_id and text, so an id that repeats with other texts loses none of them to another component. Of
    rows with the smallest id of one component, that with the smallest hash stays; of rows equal in both, any one. With ``unnamed_stay`` all rows
    without doc_id stay; otherwise one of them stands for a component that has no id at all, and the others go like any copy.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rooted = _rooted(scratch, scratch.keep(_fingerprinted(keyed_texts(docs), width)), first_member())
    return only_first(docs, rooted, unnamed_stay)

"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, id_and_text, whole_text

#: Hashes kept: an estimate of resemblance r has the standard deviation sqrt(r (1 - r) / K).
K = 64
WIDTH = 5
#: Documents are put in order of their ids in bins of about so many.
ROWS_PER_BIN = 500
#: The id range is first cut at so many quantiles, then evenly inside each.
QUANTILES = 64
#: Bins that are put in order together.
RUN = 4096
LARGEST = (1 << 63) - 1
_SPLIT = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.array_remove(F.split(text, _SPLIT, -1), "")


def sketch(word_list: Column, k: int = K, width: int = WIDTH) -> Column:
    """The ``k`` smallest distinct hashes of shingles of ``width`` words, ascending.

    Fewer words than ``width`` are one shingle; no words give an empty sketch. The column of words should be a
    plain one, as it is read more than once.
    """
    hashes = F.transform(word_list, lambda w: F.xxhash64(w))
    n = F.size(word_list)
    starts = F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))
    # One array of word hashes behind a lambda: it is built once per document, not once per shingle.
    shingled = F.transform(F.array(hashes), lambda h: F.transform(starts, lambda i: F.xxhash64(*(F.coalesce(F.get(h, i + j), F.lit(0)) for j in range(width)))))
    return F.when(n > 0, bottom(F.flatten(shingled), k)).otherwise(F.array().cast("array<bigint>"))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two parts' shingles."""
    return bottom(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of common shingles among all of both: of the k smallest of the union, those in both sketches. Two empty ones: 1."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    span = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / span)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that are in ``b`` too, from resemblance and the two sizes; 1 for an empty ``a``."""
    r, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(na == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r / (1 + r) * (na + nb) / na))


def digest(a: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits for each hash."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def merged_sketches(parts: DataFrame, k: int = K) -> DataFrame:
    """(key, sketch) of (key, sketch) rows: one sketch for all parts of a key.

    The hashes themselves are grouped, at most ``k`` for each part, first within parts of a salt, then over them,
    so that a key with most parts is not one task's.
    """
    salted = parts.select("key", F.pmod(F.xxhash64("sketch"), F.lit(64)).alias("salt"), F.explode_outer("sketch").alias("h")).distinct()
    nth = F.row_number().over(Window.partitionBy("key", "salt").orderBy("h"))
    least = salted.withColumn("nth", nth).where(F.col("nth") <= k)
    return least.groupBy("key").agg(F.slice(F.sort_array(F.collect_set("h")), 1, k).alias("sketch"))


def _ranges(named: DataFrame) -> list[tuple[int | None, int | None, int]]:
    """(low, high, pieces) of id ranges in ascending order, the last one for null ids: cut at quantiles, with an id that fills
    a whole quantile in a range of its own, each in pieces of about ``ROWS_PER_BIN`` rows. The driver gets a count per range, at most 129."""
    stats = named.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.percentile_approx(
        "doc_id", [i / QUANTILES for i in range(1, QUANTILES)], 10_000).alias("cuts")).first()
    if stats["low"] is None:
        edges = [0, 1]
    else:
        cuts = stats["cuts"]
        alone = {c for c, after in zip(cuts, cuts[1:], strict=False) if c == after}
        inner = sorted(e for e in {stats["low"], *cuts, *(c + 1 for c in alone)} if e <= stats["high"])
        edges = [*inner, min(stats["high"] + 1, LARGEST)]
    counts = dict(named.groupBy(_range_of(edges).alias("range")).count().collect())
    pieces = [max(1, round(counts.get(i, 0) / ROWS_PER_BIN)) for i in range(len(edges))]
    return [*zip(edges, edges[1:], pieces, strict=False), (None, None, pieces[-1])]


def _range_of(edges: list[int]) -> Column:
    found = sum(((F.col("doc_id") >= F.lit(e)).cast("int") for e in edges[1:-1]), F.lit(0))
    return F.when(F.col("doc_id").isNull(), F.lit(len(edges) - 1)).otherwise(found)


def _bin(ranges: list[tuple[int | None, int | None, int]], h: Column) -> Column:
    """Number of a row's bin: ranges of several ids are cut evenly by id, those of one id, and null ids, evenly by the hash ``h`` of the text."""
    listed = lambda values, kind: F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("range"))
    lows, highs, pieces = zip(*ranges, strict=True)
    starts = [sum(pieces[:i]) for i in range(len(pieces))]
    one_id = [low is None or high - low <= 1 for low, high in zip(lows, highs, strict=True)]
    id_, low, high = (x.cast("double") for x in (F.col("doc_id"), listed(lows, "long"), listed(highs, "long")))
    by_id = (id_ - low) / (high - low)
    by_hash = (h.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    inside = F.floor(F.when(listed(one_id, "boolean"), by_hash).otherwise(by_id) * listed(pieces, "long")).cast("long")
    return listed(starts, "long") + F.least(inside, listed(pieces, "long") - 1)


def _before_each(firsts: DataFrame) -> DataFrame:
    """(id, h, host): for the first row of each bin, the bin before it; the last bin is before the first one.

    Bins are put in order within runs of ``RUN`` numbers, and then the runs, so that no task gets them all.
    """
    runs = firsts.withColumn("run", F.floor(F.col("bin") / RUN).cast("long"))
    by_run = Window.orderBy("run")  # a row per RUN bins
    ends = runs.groupBy("run").agg(F.max("bin").alias("last")).select(
        "run", F.coalesce(F.lag("last").over(by_run), F.max("last").over(Window.partitionBy())).alias("end"))
    inside = F.lag("bin").over(Window.partitionBy("run").orderBy("bin"))
    return runs.withColumn("inside", inside).join(ends, "run").select("first.id", "first.h", F.coalesce("inside", "end").alias("host"))


def in_id_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, bin, guest): ids ascend from bin to bin, and each bin also has the next bin's first row as its guest.

    So the next document of every row is in its own bin, and texts move once. Null ids come last; rows with the same id are in the order
    of their texts' hashes. The last bin's guest is the first document. An id that many rows share, or a null one, has bins of its own, cut by these
    hashes; only rows that are equal in id and text, or ids in clusters too narrow for the quantiles, can fill one beyond its size.
    """
    scratch = Scratch(docs.sparkSession, "id-order")
    named = id_and_text(docs).select("doc_id", whole_text().alias("text"))
    ranges = _ranges(named)
    edges = [low for low, _, _ in ranges[:-1]] + [ranges[-2][1]]
    binned = (named.withColumn("h", F.xxhash64("text")).withColumn("range", _range_of(edges))
              .withColumn("bin", _bin(ranges, F.col("h"))).select("doc_id", "text", "h", "bin"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), "h"))
    hosts = scratch.keep(_before_each(scratch.keep(binned.groupBy("bin").agg(first.alias("first")))))
    met = binned.drop("bin").join(hosts, F.col("doc_id").eqNullSafe(F.col("id")) & (binned["h"] == hosts["h"]))
    guests = met.groupBy(F.col("host").alias("bin")).agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    return binned.drop("h").withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))


def edited_fingerprints(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many of the next document in the order of
    ``in_id_order`` (after the last, the first). A null text counts as empty; an empty fingerprint is ''. A single document
    is its own next. No rows give no rows.
    """
    placed = in_id_order(docs).repartition("bin")
    own = placed.withColumn("words", words(F.col("text"))).withColumn("sketch", sketch(F.col("words"), k, width)).drop("words")
    # The guest of the last bin is the first document: it goes behind all the others, whatever its id.
    order = Window.partitionBy("bin").orderBy("guest", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    after = own.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order)).where("NOT guest")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = after.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))).drop("text", "next_text")
    again = edited.withColumn("words", words(F.col("edited"))).withColumn("edited_sketch", sketch(F.col("words"), k, width)).drop("words")
    return again.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digest(F.col("sketch")).alias("fingerprint"),
                        digest(F.col("edited_sketch")).alias("edited_fingerprint"), resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))

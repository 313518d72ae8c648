"""Removal of multi-line passages that repeat across documents, by content-defined chunks of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, let

#: Rolling hash: so many line hashes enter it, as digits of a number to this base modulo a prime.
WINDOW = 2
BASE = 1_000_003
PRIME = 2_147_483_647
_SHIFT = 1 << 32


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _rolling(hashes: Column) -> Column:
    return F.transform(hashes, lambda _, i: F.aggregate(
        F.slice(hashes, F.greatest(i - WINDOW + 2, F.lit(1)), F.least(i + 1, F.lit(WINDOW))),
        F.lit(0).cast("long"), lambda total, h: (total * BASE + h) % PRIME))


def _ends(rolled: Column) -> Column:
    """Last lines of chunks: local minima of the rolling hash, and the last line."""
    n, at = F.size(rolled), lambda i: F.get(rolled, i)
    inner = F.filter(F.sequence(F.lit(1), F.greatest(n - 3, F.lit(1))), lambda i: (i <= n - 3) & (at(i) < at(i - 1)) & (at(i) <= at(i + 1)))
    return F.concat(inner, F.array(n - 1))


def _coded(ends: Column) -> Column:
    begins = F.concat(F.array(F.lit(0)), F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), lambda e: e + 1))
    return F.zip_with(begins, ends, lambda b, e: b.cast("long") * _SHIFT + (e - b + 1))


def chunk_codes(lines: Column) -> Column:
    """The chunks of a text's lines in order; a code is the first line's number times 2**32 plus the number of lines.

    A chunk ends after a line whose rolling hash is a local minimum. That depends on a few
    neighbouring lines alone, so an insertion elsewhere moves no other boundary, two boundaries are never
    adjacent, and a chunk has two lines at least (unless the text has fewer).
    """
    return let(F.transform(lines, line_hash), lambda h: let(_rolling(h), lambda r: let(_ends(r), _coded)))


def _lines_of(lines: Column, code: Column) -> Column:
    return F.slice(lines, (code / _SHIFT).cast("int") + 1, (code % _SHIFT).cast("int"))


def _joined(lines: Column, code: Column) -> Column:
    return F.array_join(_lines_of(lines, code), "\n")


def _passages(text: Column) -> Column:
    """(code, passage) of a text's chunks that have two lines or more which are not blank."""
    def of(lines: Column) -> Column:
        chunks = F.transform(chunk_codes(lines), lambda c: F.struct(c.alias("code"), _lines_of(lines, c).alias("own")))
        return F.transform(F.filter(chunks, lambda c: _is_passage(c["own"])), lambda c: F.struct(c["code"].alias("code"), F.array_join(c["own"], "\n").alias("passage")))
    return let(_lines(text), of)


def _is_passage(lines: Column) -> Column:
    return F.size(F.filter(lines, lambda x: x.rlike(r"\S"))) >= 2


def removable_chunks(docs: DataFrame) -> DataFrame:
    """(row, hash, codes, kept, gone): each row of ``docs`` packed, its chunks, and the codes of those to remove."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "line-dedup")
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("id"), F.col("row.text").cast("string").alias("text"))
    keyed = packed.withColumn("hash", F.xxhash64("text"))

    # Narrow: where each passage stands. The first place, by id, keeps it.
    passages = (keyed.select("id", "hash", "text").where("text IS NOT NULL").select("id", "hash", F.explode(_passages(F.col("text"))).alias("p"))
                .select("id", "hash", "p.code", F.unhex(F.md5("p.passage")).alias("key")))
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "hash", "code")
    narrow = scratch.keep(passages)
    # Written, so that a very frequent passage can be split in the joins that follow.
    repeated = scratch.keep(narrow.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("key", "first"))
    marked = (narrow.join(repeated, "key").select("id", "hash", F.struct("code", "key", (place == F.col("first")).alias("first")).alias("mark"))
              .groupBy("id", "hash").agg(F.collect_set("mark").alias("marks")))

    # The texts move once, to meet their marks.
    met = scratch.keep(keyed.alias("d").join(marked.alias("m"), F.col("d.id").eqNullSafe(F.col("m.id")) & F.col("d.hash").eqNullSafe(F.col("m.hash")), "left")
                       .select("row", "d.id", "d.hash", "marks"))

    # Byte comparison of later copies with the kept passage; only repeated passages move.
    shown = (met.where("marks IS NOT NULL").select("id", "hash", F.explode(let(_lines(F.col("row.text").cast("string")), lambda lines: F.transform(
        "marks", lambda m: F.struct(m["code"].alias("code"), m["key"].alias("key"), m["first"].alias("first"), _joined(lines, m["code"]).alias("passage"))))).alias("s"))
             .select("id", "hash", "s.*"))
    kept = scratch.keep(shown.where("first").groupBy("key").agg(F.min("passage").alias("kept")))
    unlike = (shown.where("NOT first").join(kept, "key").where("passage <> kept").groupBy("id", "hash").agg(F.collect_set("code").alias("unlike")))
    unlike = scratch.keep(unlike)
    gone = F.transform(F.filter("marks", lambda m: ~m["first"]), lambda m: m["code"])
    if unlike.isEmpty():  # no two passages share a key without being equal
        return met.select("row", F.coalesce(gone, F.array().cast("array<bigint>")).alias("gone"))
    return (met.alias("m").join(unlike.alias("u"), F.col("m.id").eqNullSafe(F.col("u.id")) & F.col("m.hash").eqNullSafe(F.col("u.hash")), "left")
            .select("row", F.coalesce(F.array_except(gone, F.coalesce("unlike", F.array().cast("array<bigint>"))), F.array().cast("array<bigint>")).alias("gone")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """(row, clean, removed_chunks, removed_lines) of every row of ``docs``.

    A passage is a content-defined chunk with two lines or more that are not blank. All its places but the first,
    by doc_id and then position, lose it, once the bytes are found equal; null ids come last. A null text stays
    null; a text that is all copied becomes empty. Rows equal in doc_id and text are one document: they keep or
    lose the same. ``row`` holds all columns of ``docs`` untouched, so that no name can clash.
    """
    text = F.col("row.text").cast("string")
    clean = let(_lines(text), lambda lines: F.array_join(F.transform(F.array_except(chunk_codes(lines), "gone"), lambda c: _joined(lines, c)), "\n"))
    return removable_chunks(docs).select("row", F.when(F.size("gone") == 0, text).otherwise(clean).alias("clean"),
                                         F.size("gone").alias("removed_chunks"),
                                         F.aggregate("gone", F.lit(0).cast("long"), lambda n, c: n + c % _SHIFT).alias("removed_lines"))


#: The same over table ``documents`` in DuckDB's SQL.
ORACLE_SQL = f"""
WITH split AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), hashed AS (
    SELECT doc_id, lines, list_transform(lines, lambda x: ('0x' || substr(md5(x), 1, 7))::BIGINT) AS h FROM split
), numbered AS (
    SELECT doc_id, lines, h, len(lines) AS n, unnest(range(len(lines))) AS i FROM hashed
), rolled AS (
    SELECT doc_id, i, n, lines[i + 1] AS line,
           CASE WHEN i = 0 THEN h[1] % {PRIME} ELSE ((h[i] % {PRIME}) * {BASE} + h[i + 1]) % {PRIME} END AS r
    FROM numbered
), flagged AS (
    SELECT *, i BETWEEN 1 AND n - 3
           AND r < lag(r) OVER w AND r <= lead(r) OVER w AS ends
    FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), dealt AS (
    SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
    FROM flagged
), chunks AS (
    SELECT doc_id, chunk, min(i) AS start, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY i) AS passage,
           count(*) FILTER (regexp_matches(line, '\\S')) >= 2 AS multi
    FROM dealt GROUP BY doc_id, chunk
), ranked AS (
    SELECT *, multi AND row_number() OVER (PARTITION BY passage, multi ORDER BY doc_id, start) > 1 AS gone FROM chunks
), cleaned AS (
    SELECT doc_id, coalesce(string_agg(passage, chr(10) ORDER BY start) FILTER (NOT gone), '') AS text,
           count(*) FILTER (gone)::INT AS removed_chunks, coalesce(sum(n_lines) FILTER (gone), 0)::BIGINT AS removed_lines
    FROM ranked GROUP BY doc_id
)
SELECT * FROM cleaned
UNION ALL
SELECT doc_id, text, 0::INT, 0::BIGINT FROM documents WHERE text IS NULL
"""

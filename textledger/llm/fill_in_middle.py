"""Fill-in-middle transformation: a pyarrow.compute pipeline cuts texts into units and joins them again in another order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, whole_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A unit is a word with the blanks before it; blanks at the end of a text are one more.
UNIT = rb"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"
SEED = 42
#: Percent of the documents that are cut, and percent of those whose suffix comes first.
CUT_RATE, SPM_RATE = 50, 80
#: No byte of UTF-8 text: ends a unit.
_END = b"\xff"
#: A task works on so many bytes of text at once, or on one longer text.
_CHUNK = 1 << 22

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _draws(seed: int) -> list[Column]:
    """h1 to h4: the first four groups of 8 hex digits of the sha256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _mod(a: pa.Array, b: pa.Array | int) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _starts(lengths: pa.Array) -> pa.Array:
    """Offsets of lists of these lengths, the end of the last one included."""
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(lengths)])


def _units(texts: pa.Array) -> pa.Array:
    """Lists of units, each with an empty piece at its end."""
    return pc.split_pattern(pc.replace_substring_regex(texts, pattern=UNIT, replacement=rb"\1" + _END), pattern=_END)


def _pieces(units: pa.Array, first: pa.Array, last: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of each text: the units before ``first``, those before ``last`` and the rest."""
    lengths = pc.cast(pc.list_value_length(units), pa.int64())
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    ordinal = pc.subtract(pa.array(np.arange(len(flat), dtype=np.int64)), pc.take(_starts(lengths), parent))
    after = lambda cut: pc.cast(pc.greater_equal(ordinal, pc.take(cut, parent)), pa.int8())
    role = pc.add(after(first), after(last))
    sizes = (first, pc.subtract(last, first), pc.subtract(lengths, last))
    chosen = (pc.filter(flat, pc.equal(role, r)) for r in range(3))
    return [pc.binary_join(pa.ListArray.from_arrays(pc.cast(_starts(n), pa.int32()), x), pa.scalar(b"", pa.large_binary())) for n, x in zip(sizes, chosen)]


def _transform(chunk: pa.RecordBatch, cut_rate: int, spm_rate: int) -> pa.RecordBatch:
    texts = pc.cast(chunk["text"], pa.large_binary())
    units = _units(texts)
    n = pc.subtract(pc.cast(pc.list_value_length(units), pa.int64()), 1)
    marked = [pc.match_substring(texts, pattern=m.encode()) for m in (PREFIX, SUFFIX, MIDDLE)]
    cut = pc.and_(pc.and_(pc.greater(n, 0), pc.less(_mod(chunk["h3"], 100), cut_rate)), pc.invert(pc.or_(pc.or_(marked[0], marked[1]), marked[2])))
    spm = pc.less(_mod(chunk["h4"], 100), spm_rate)
    ends = pc.add(n, 1)
    ats = [pc.filter(_mod(chunk[h], ends), cut) for h in ("h1", "h2")]
    prefix, middle, suffix = _pieces(pc.filter(units, cut), pc.min_element_wise(*ats), pc.max_element_wise(*ats))
    bytes_of = lambda text: pa.scalar(text.encode(), pa.large_binary())
    join = lambda *parts: pc.binary_join_element_wise(*(bytes_of(p) if isinstance(p, str) else p for p in parts), bytes_of(""))
    joined = pc.if_else(pc.filter(spm, cut), join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle), join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    nulls = pa.nulls(len(texts), pa.int64())
    chars = lambda piece: pc.replace_with_mask(nulls, cut, pc.cast(pc.utf8_length(pc.cast(piece, pa.large_string())), pa.int64()))
    form = pc.if_else(cut, pc.if_else(spm, "spm", "psm"), "plain")
    output = pc.cast(pc.replace_with_mask(texts, cut, joined), pa.string())
    columns = [chunk["doc_id"], n, form, chars(prefix), chars(middle), output]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``_CHUNK`` bytes of text, single longer texts alone."""
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        stop = max(int(np.searchsorted(ends, done + _CHUNK, side="right")), at + 1)
        yield batch.slice(at, stop - at)
        at = stop


def fill_in_middle(docs: DataFrame, seed: int = SEED, cut_rate: int = CUT_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), a row per row of ``docs``, which needs doc_id and text.

    A text of n units is cut at two of its n + 1 unit borders, drawn from the id, into prefix, middle and suffix.
    ``form`` is psm (prefix, suffix, middle), spm (suffix, prefix, middle) or plain: texts that are empty or hold a
    marker stay as they are, and so do those that ``cut_rate`` leaves out.

    A null text is an empty one; a null id draws as an empty one does; equal rows give equal rows; no rows give none.
    Other columns are not read. No row depends on another, so nothing is shuffled, and a task holds one chunk of texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch):
                yield _transform(chunk, cut_rate, spm_rate)

    narrow = id_and_text(docs).select("doc_id", whole_text().alias("text"), *_draws(seed))
    return narrow.mapInArrow(run, SCHEMA)


def restore(transformed: DataFrame) -> DataFrame:
    """Adds ``restored``: the text, from output and form alone. No piece holds a marker, so markers are where pieces end."""
    part = F.split("output", "<[PSM]>", -1)
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return transformed.withColumn("restored", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("output")))


#: The digests of op11 over table ``documents`` in DuckDB's SQL.
ORACLE_SQL = r"""
WITH units AS (
    SELECT doc_id, coalesce("text", '') AS t, sha256('42:' || doc_id) AS digest,
           regexp_extract_all(coalesce("text", ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents
), drawn AS (
    SELECT *, len(u) AS n, ('0x' || substr(digest, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(digest, 9, 8))::BIGINT % (len(u) + 1) AS c2,
           ('0x' || substr(digest, 17, 8))::BIGINT % 100 AS r3, ('0x' || substr(digest, 25, 8))::BIGINT % 100 AS r4
    FROM units
), cut AS (
    SELECT doc_id, n, t, array_to_string(u[1:least(c1, c2)], '') AS prefix, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
           array_to_string(u[greatest(c1, c2) + 1:], '') AS suffix,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r3 >= 50 THEN 'plain'
                WHEN r4 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

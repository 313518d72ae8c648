"""Merkle manifest of a dataset: aligned blocks of nodes keep each tree level as one string of concatenated digests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

ARITY = 3
#: Levels that a block holds: it covers ARITY**DEPTH nodes, so its longest string is that many digests.
DEPTH = 5
BLOCK = ARITY**DEPTH
_HEX = 64
#: The columns of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes that one task puts in order.
ROWS_PER_TASK = 50_000
_SEGMENT = "array<struct<left:string,right:string>>"


def leaf_digest(*values: Column) -> Column:
    """Hash of the values, each as its number of bytes, a colon and itself, or as a dash if null: no two rows of values give one text."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)), 256)


def without_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(""))


@dataclass
class Tree:
    """``blocks`` (key, block, total, nodes, levels) from the nodes up, ``roots`` (key, root)."""

    blocks: list[DataFrame]
    roots: DataFrame


def in_order(nodes: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """Adds ``idx``, the place of a row among those of its ``key``, from 0, and ``total``, their number.

    Rows are sorted by ranges, so that a large key lies in many tasks; the places begin at sums of counts per key and range,
    of which there are as many as keys and tasks together at most.
    """
    ranges = max(8, nodes.count() // ROWS_PER_TASK)
    at = F.monotonically_increasing_id()
    placed = scratch.keep(nodes.repartitionByRange(ranges, "key", *order).sortWithinPartitions("key", *order).withColumns(
        {"_range": F.shiftright(at, 33), "_at": at.bitwiseAND(F.lit((1 << 33) - 1))}))
    of_key = Window.partitionBy("key")
    before = F.coalesce(F.sum("_n").over(of_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = placed.groupBy("key", "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    offsets = sums.select(F.col("key").alias("_key"), F.col("_range").alias("_r"), (before - F.col("_first")).alias("_offset"), F.sum("_n").over(of_key).alias("total"))
    met = placed.join(offsets, F.col("key").eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_r")))
    return met.withColumn("idx", F.col("_at") + F.col("_offset")).drop("_key", "_range", "_r", "_at", "_offset")


def _parents(level: Column) -> Column:
    """The next level: fixed-width substrings, ARITY digests long, hashed and concatenated."""
    run = ARITY * _HEX
    last = F.floor((F.length(level) - 1) / run).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256)), "")


def _levels(first: Column, many: Column) -> Column:
    """The strings of a block's levels from its nodes up, as long as several nodes remain in the block, or in its tree if that has many blocks."""
    def up(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.when(many | (F.length(last) > _HEX), F.concat(levels, F.array(_parents(last)))).otherwise(levels)

    return F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), F.array(first), up)


def build(nodes: DataFrame, scratch: Scratch) -> Tree:
    """The trees of all keys at once, from ``nodes`` (key, idx, total, digest, and a struct ``own`` that the lowest blocks carry along).

    A block of a tree with several blocks goes up DEPTH levels, to one digest; these roots are the nodes of the next round.
    The rounds end when no key has more than one block.
    """
    blocks, level = [], nodes
    while True:
        entry = F.struct("idx", "digest", *(["own"] if "own" in level.columns else []))
        grouped = level.groupBy("key", F.floor(F.col("idx") / BLOCK).cast("long").alias("block")).agg(
            F.max("total").alias("total"), F.sort_array(F.collect_list(entry)).alias("nodes"))
        first = F.array_join(F.transform("nodes", lambda x: x["digest"]), "")
        blocks.append(scratch.keep(grouped.withColumn("levels", _levels(first, F.col("total") > BLOCK))))
        top = blocks[-1].select("key", F.col("block").alias("idx"), F.ceil(F.col("total") / BLOCK).cast("long").alias("total"), F.element_at("levels", -1).alias("digest"))
        if not top.where("total > 1").limit(1).count():
            return Tree(blocks, top.select("key", F.col("digest").alias("root")))
        level = top


def _flanks(levels: Column, place: Column) -> Column:
    """What stands left and right of a node, and of each node above it, within its run of ARITY: one pair per level that is hashed."""
    def pair(level: Column, j: Column) -> Column:
        node = F.floor(place / F.pow(F.lit(float(ARITY)), j)).cast("int")
        nth = node % ARITY
        return F.struct(F.substring(level, (node - nth) * _HEX + 1, nth * _HEX).alias("left"), F.substring(level, (node + 1) * _HEX + 1, (ARITY - 1 - nth) * _HEX).alias("right"))

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), pair)


def paths(tree: Tree, above: DataFrame) -> DataFrame:
    """(key, idx, digest, own, path, ends) of every node: the flanks of each level that is hashed, from the node up, then those of ``above``.

    ``above`` (key, path, ends) continues the path of each key's root; ``ends`` goes along. Blocks meet the paths of their
    roots one to one, and are taken apart afterwards.
    """
    above = above.withColumn("idx", F.lit(0).cast("long"))
    for blocks in reversed(tree.blocks):
        upper = above.select(F.col("key").alias("_key"), F.col("idx").alias("_block"), F.col("path").alias("_path"), "ends")
        met = blocks.join(upper, F.col("key").eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_block")))
        each = met.select("key", "block", "levels", "_path", "ends", F.explode("nodes").alias("node"))
        own = _flanks(F.col("levels"), (F.col("node.idx") - F.col("block") * BLOCK).cast("int"))
        above = each.select("key", "node.*", F.concat(own, "_path").alias("path"), "ends")
    return above


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and the flanks of its path give."""
    return F.aggregate(path, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def manifest(docs: DataFrame, tampered: Column | None = None, change=without_newlines) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, verified), a row per row of ``docs``, which needs the columns of ``FIELDS``.

    The leaves of a source, in the order of doc_id, form one tree, and the roots of the sources, in the order of their names (null first), another.
    ``proof`` holds the flanks (left, right) of the leaf's path to ``root``. ``folded_root`` starts from the leaf of the row as found,
    which is ``change`` of the text where ``tampered`` (by default: an even unsigned crc32 of the id) holds, and else the leaf.

    A null id comes first, hashes like any null, and is not tampered with; rows that share an id are in the order of their leaves; equal rows are
    neighbours and each is a leaf. Null sources are one source. Other columns are not read. No rows give none.
    Texts are read once and not moved; the order of a source is made by ranges, and no task or driver holds more than a block of it.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    types = {"doc_id": "long", "n_chars": "long"}
    values = [docs[c].cast(types.get(c, "string")).alias(c) for c in FIELDS]
    plain = docs.select(*values)
    if tampered is None:
        tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    found = F.when(tampered, leaf_digest(*(F.col(c) for c in FIELDS[:-1]), change(F.col("text"))))
    # The drawn number parts equal rows, so that no number of them meets in one task.
    leaves = scratch.keep(plain.select(F.col("source").alias("key"), "doc_id", leaf_digest(*map(F.col, FIELDS)).alias("digest"), found.alias("found"), F.rand(7).alias("draw")))
    ordered = in_order(leaves, ["doc_id", "digest", "draw"], scratch)
    sources = build(ordered.select("key", "idx", "total", "digest", F.struct("doc_id", "found").alias("own")), scratch)
    named = sources.roots.select(F.lit(0).alias("key"), F.col("key").alias("source"), F.col("root").alias("digest"))
    dataset = build(in_order(named, ["source"], scratch).select("key", "idx", "total", "digest", F.struct("source").alias("own")), scratch)
    root = dataset.roots.select("key", F.array().cast(_SEGMENT).alias("path"), F.struct(F.lit(None).cast("string").alias("subroot"), "root").alias("ends"))
    tops = paths(dataset, root).select(F.col("own.source").alias("key"), "path", F.struct(F.col("digest").alias("subroot"), F.col("ends.root").alias("root")).alias("ends"))
    rows = paths(sources, tops).select("own.doc_id", F.col("digest").alias("leaf"), "own.found", "ends.subroot", "ends.root", F.col("path").alias("proof"))
    folded = rows.withColumn("folded_root", fold(F.coalesce("found", "leaf"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def proof_digest(proof: Column) -> Column:
    """One hash over all flanks, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


#: The digests of op12 over table ``documents`` in DuckDB's SQL.
_CRC_STEPS = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_prepend(ascii(c)::BIGINT, [(-1)::BIGINT for _ in range(8)])))"
_CRC = f"""xor(list_reduce({_CRC_STEPS}, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
    WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, 4294967295::BIGINT), 4294967295::BIGINT)"""
ORACLE_SQL = r"""
WITH RECURSIVE fields AS (
    SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, "text" AS t,
           replace("text", chr(10), '') AS cut
    FROM documents
), leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS leaf,
           sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) AS other,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS idx
    FROM fields
), low AS (
    SELECT source, 0 AS level, idx, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
    UNION ALL
    SELECT source, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
    FROM low WHERE n > 1 GROUP BY source, level, idx // 3, n
), subroots AS (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS nth FROM low WHERE n = 1
), high AS (
    SELECT 0 AS level, nth AS idx, subroot AS digest, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM high WHERE n > 1 GROUP BY level, idx // 3, n
), runs AS (
    SELECT source, level, idx // 3 AS run, list(digest ORDER BY idx) AS digests FROM low WHERE n > 1 GROUP BY ALL
), top AS (
    SELECT level, idx // 3 AS run, list(digest ORDER BY idx) AS digests FROM high WHERE n > 1 GROUP BY ALL
), steps AS (
    SELECT l.doc_id, level, digests, (l.idx // (3 ** level)::BIGINT) % 3 AS nth
    FROM leaves l JOIN runs r ON l.source IS NOT DISTINCT FROM r.source AND (l.idx // (3 ** level)::BIGINT) // 3 = run
    UNION ALL
    SELECT l.doc_id, 1000 + level, digests, (s.nth // (3 ** level)::BIGINT) % 3
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN top t ON (s.nth // (3 ** level)::BIGINT) // 3 = run
), sides AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS k,
           array_to_string(digests[1:nth], '') AS before, array_to_string(digests[nth + 2:], '') AS after
    FROM steps
), folded AS (
    SELECT doc_id, 0::BIGINT AS k, CASE WHEN crc % 2 = 0 THEN other ELSE leaf END AS h FROM (SELECT *, {crc} AS crc FROM leaves)
    UNION ALL
    SELECT f.doc_id, f.k + 1, sha256(s.before || f.h || s.after) FROM folded f JOIN sides s ON f.doc_id = s.doc_id AND s.k = f.k + 1
), proofs AS (
    SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY k)) AS proof_sha256 FROM sides GROUP BY doc_id
), ends AS (
    SELECT doc_id, max_by(h, k) AS folded_root FROM folded GROUP BY doc_id
)
SELECT l.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source CROSS JOIN (SELECT digest AS root FROM high WHERE n = 1)
JOIN ends e ON e.doc_id = l.doc_id LEFT JOIN proofs p ON p.doc_id = l.doc_id
""".replace("{crc}", _CRC)

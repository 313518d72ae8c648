"""Mixing sources to target weights: block quotas split among shards down a multivariate-hypergeometric tree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch, whole_text

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SHARDS = 16
BLOCKS_PER_SHARD = 32
SEED = "mix-1"
ROWS_PER_BIN = 2_000


def _uniform(*parts: Column | str) -> Column:
    """A number in [0, 2**32) that depends on the seed and the parts alone."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(SEED), *parts)), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size), one row per source.

    A source's share is its weight times one common level, or ``MOST`` times its size where that is less. Giving what
    is above the limit back by weight, again and again, ends at that level; here it is read off the sources in the
    order of the level at which each reaches its limit. Windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("rank", (F.row_number().over(by_name) - 1).cast("int")).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("rank") % len(WEIGHTS) + 1))
    most = F.col("source_size") * MOST
    by_limit = Window.orderBy(most / F.col("weight"), "rank")
    upto = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy()
    level = ((F.sum("source_size").over(all_) * F.lit(SHARE) - F.coalesce(F.sum(most).over(upto), F.lit(0)))
             / (F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(upto), F.lit(0))))
    levels = weighed.withColumn("own_level", level).withColumn("fits", F.col("own_level") <= most / F.col("weight"))
    common = F.max(F.when(F.col("fits"), F.col("own_level"))).over(all_)  # that of the first which fits: later ones are lower
    return levels.withColumn("level", common).select("source", "rank", "source_size", F.when(
        F.col("level").isNull() | (F.col("level") * F.col("weight") >= most), most.cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def block_quotas(targets: DataFrame, blocks: int) -> DataFrame:
    """Adds ``words`` (whole words of the target) and ``quota``: blocks of equal length that the source gives.

    Quotas follow the targets, by largest remainders; a source with any words gives one at least.
    """
    whole = targets.withColumn("words", F.floor("target").cast("long"))
    every = Window.partitionBy()
    exact = F.col("words") * F.lit(float(blocks)) / F.greatest(F.sum("words").over(every), F.lit(1))
    floored = whole.withColumn("exact", exact).withColumn("quota", F.floor("exact"))
    missing = F.lit(blocks) - F.sum("quota").over(every)
    nth = F.row_number().over(Window.orderBy((F.col("exact") - F.col("quota")).desc(), "rank"))
    dealt = floored.withColumn("missing", missing).withColumn("nth", nth)
    return dealt.select(*targets.columns, "words", F.when(F.col("words") > 0, F.greatest(
        F.col("quota") + (F.col("nth") <= F.col("missing")).cast("long"), F.lit(1))).otherwise(0).cast("int").alias("quota"))


def splitting_tree(quotas: DataFrame, shards: int) -> DataFrame:
    """(rank, shard, n): how many of each source's blocks go to each shard; ``shards`` is a power of two.

    A node holds the quotas of all sources for a range of shards. It halves the range and draws the left half's
    quotas from the multivariate hypergeometric distribution: block after block goes left with the probability (places left)
    / (blocks left), which is exact sampling without replacement; the rest goes right. A node
    row has one number per source, and a level reads as many blocks as all shards hold.
    """
    root = quotas.agg(F.array_sort(F.collect_list(F.struct("rank", "quota"))).alias("q")).select(
        F.lit(0).alias("shard"), F.col("q.rank").alias("ranks"), F.col("q.quota").alias("quota"))

    def split(nodes: DataFrame, width: int) -> DataFrame:
        total = F.aggregate("quota", F.lit(0).cast("long"), lambda s, x: s + x)
        start = F.struct((total / 2).cast("long").alias("room"), total.alias("rest"), F.array().cast("array<int>").alias("left"))

        def source(state: Column, item: Column) -> Column:
            def block(inner: Column, j: Column) -> Column:
                draw = _uniform(F.lit(str(width)), F.col("shard").cast("string"), item["rank"].cast("string"), j.cast("string"))
                goes = (draw * inner["rest"] < inner["room"] * F.lit(1 << 32)).cast("long")
                return F.struct((inner["room"] - goes).alias("room"), (inner["rest"] - 1).alias("rest"), (inner["n"] + goes).alias("n"))

            blocks = F.when(item["quota"] > 0, F.sequence(F.lit(1), F.greatest(item["quota"], F.lit(1)))).otherwise(F.array().cast("array<int>"))
            done = F.aggregate(blocks, F.struct(state["room"].alias("room"), state["rest"].alias("rest"), F.lit(0).cast("long").alias("n")), block)
            return F.struct(done["room"].alias("room"), done["rest"].alias("rest"), F.concat(state["left"], F.array(done["n"].cast("int"))).alias("left"))

        items = F.zip_with("ranks", "quota", lambda r, q: F.struct(r.alias("rank"), q.alias("quota")))
        drawn = nodes.withColumn("left", F.aggregate(items, start, source)["left"])
        half = width // 2
        return drawn.select("ranks", F.explode(F.array(
            F.struct(F.col("shard").alias("shard"), F.col("left").alias("quota")),
            F.struct((F.col("shard") + half).alias("shard"), F.zip_with("quota", "left", lambda q, x: q - x).alias("quota")))).alias("half")).select("half.shard", "ranks", "half.quota")

    widths = [shards >> k for k in range(shards.bit_length() - 1)]
    leaves = reduce(split, widths, root)
    pairs = F.explode(F.arrays_zip("ranks", "quota")).alias("s")
    return leaves.select("shard", pairs).select(F.col("s.ranks").alias("rank"), "shard", F.col("s.quota").alias("n"))


def _shard_of_block(tree: DataFrame) -> DataFrame:
    """(rank, shard_of): for each source the shard of each of its blocks, the blocks dealt in a random order."""
    runs = tree.groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("runs"))
    dealt = runs.withColumn("dealt", F.flatten(F.transform("runs", lambda r: F.array_repeat(r["shard"], r["n"]))))
    mixed = F.array_sort(F.transform("dealt", lambda s, j: F.struct(_uniform(F.lit("block"), F.col("rank").cast("string"), j.cast("string")).alias("key"), s.alias("shard"))))
    return dealt.select("rank", F.transform(mixed, lambda x: x["shard"]).alias("shard_of"))


def mix(docs: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """(doc_id, source, hash, size, source_size, target, pieces) of every row of ``docs``; hash is that of the text.

    Each source's documents stand in a random order that ids fix, twice over; the mix takes the first
    floor(target) words of that line, cut into the source's quota of equal blocks, and the splitting
    tree says which shard draws which block. ``pieces`` are the (pass, words, block, shard) taken of a document,
    whole passes but for the one that ends a source's line; a piece goes with the block in which it begins.

    A null text has size 0 and gives nothing; null sources are one source, the last. Rows that repeat a
    doc_id are apart. With no words at all, targets are 0; no rows give no rows. Other columns are not read.
    A source is never in one task: its documents are dealt into bins by the order itself, offsets come from sums per bin.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
                         F.xxhash64(docs["text"].cast("string")).alias("hash"),
                         F.regexp_count(whole_text(docs["text"].cast("string")), F.lit(WORD)).cast("long").alias("size"))
    narrow = scratch.keep(narrow.withColumn("at", _uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    bins = F.lit(max(8, narrow.count() // ROWS_PER_BIN))
    binned = narrow.withColumn("bin", F.floor(F.col("at") * bins / F.lit(1 << 32)).cast("int"))

    sums = binned.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    sums = scratch.keep(sums)
    quotas = scratch.keep(block_quotas(source_targets(sums.groupBy("source").agg(F.sum("bin_size").alias("source_size"))), shards * blocks_per_shard))
    shard_of = _shard_of_block(splitting_tree(quotas, shards))
    by_bin = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    block = lambda at: F.floor(at * F.col("quota") / F.greatest(F.col("words"), F.lit(1))).cast("int")
    offsets = (sums.withColumn("before", F.coalesce(F.sum("bin_size").over(by_bin), F.lit(0)))
               .join(quotas.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s").join(shard_of, "rank"))
    # A bin covers one run of blocks in each pass: it takes only their shards along.
    for p in (0, 1):
        begin = F.col("before") + F.col("source_size") * p
        first = F.least(block(begin), F.col("quota"))
        offsets = offsets.withColumn(f"first{p}", first).withColumn(f"shards{p}", F.slice("shard_of", F.col(f"first{p}") + 1, block(begin + F.col("bin_size")) - F.col(f"first{p}") + 1))
    offsets = offsets.drop("shard_of", "bin_size", "rank").select(F.col("source").alias("s"), F.col("bin").alias("b"), "before", "source_size", "target", "words", "quota", "first0", "shards0", "first1", "shards1")

    ordered = Window.partitionBy("source", "bin").orderBy("at", "size", "hash")
    placed = binned.withColumn("within", F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    joined = placed.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))

    def piece(p: int) -> Column:
        start = F.col("before") + F.col("within") + F.col("source_size") * p
        taken = F.greatest(F.least(F.col("size"), F.col("words") - start), F.lit(0)).cast("long")
        shard = F.get(F.col(f"shards{p}"), block(start) - F.col(f"first{p}"))
        whole = F.struct(F.lit(p).alias("pass"), taken.alias("words"), block(start).alias("block"), shard.alias("shard"))
        return F.when((taken > 0) & shard.isNotNull(), F.array(whole)).otherwise(F.array().cast("array<struct<pass:int,words:bigint,block:int,shard:int>>"))

    # Written, because a filter on the pieces must not be worked out again inside the join.
    return scratch.keep(joined.select("doc_id", "source", "hash", "size", "source_size", "target", F.concat(piece(0), piece(1)).alias("pieces")))


def taken_words(mixed: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, x: n + x["words"])
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixture(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself, a row per piece: (shard, place, pass, words, block, row), where ``row`` packs the columns of ``docs``.

    The text in ``row`` ends after the piece's words. ``place`` shuffles each shard by itself: sorting by (shard, place) gives the
    training order, in which the rows of each partition stand; written by ``shard``, each shard is a folder. The texts move once, to
    meet their pieces; rows that are equal in doc_id, source and text take turns.
    """
    key = lambda i, s, h: F.md5(F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("-")), h.cast("string"), F.when(s.isNull(), "-").otherwise(F.concat(F.lit("+"), s))))
    empty = mixed.schema["pieces"].dataType
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    texts = packed.select(key(F.col("row.doc_id").cast("long"), F.col("row.source").cast("string"), F.xxhash64(F.col("row.text").cast("string"))).alias("key"),
                          F.lit(False).alias("is_piece"), F.lit(None).cast("long").alias("size"), F.lit(None).cast(empty).alias("pieces"), "row")
    pieces = mixed.where(F.size("pieces") > 0).select(key(F.col("doc_id"), F.col("source"), F.col("hash")).alias("key"), F.lit(True).alias("is_piece"), "size", "pieces",
                                                     F.lit(None).cast(packed.schema["row"].dataType).alias("row"))
    # Both sides in one exchange: rows of a key are numbered on each side, and those with one number are a text and its pieces.
    both = texts.unionByName(pieces).repartition("key").withColumn("turn", F.row_number().over(Window.partitionBy("key", "is_piece").orderBy("pieces")))
    meet = Window.partitionBy("key", "turn").orderBy(F.col("is_piece").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("found", F.first(F.struct("is_piece", "size", "pieces")).over(meet)).where("NOT is_piece AND found.is_piece")
    rows = met.select("row", "found.size", F.explode("found.pieces").alias("piece")).select("row", "size", "piece.*")
    cut = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") == F.col("size"), F.col("row.text")).otherwise(cut)
    placed = rows.select("shard", F.xxhash64(F.lit(SEED), "row.doc_id", "pass", "block").alias("place"), "pass", "words", "block", F.col("row").withField("text", text).alias("row"))
    return placed.sortWithinPartitions("shard", "place")


#: The same over table ``documents`` in DuckDB's SQL.
ORACLE_SQL = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           ('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, ''))), 1, 8))::BIGINT AS at
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source
), weighed AS (
    SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources
), levels AS (
    SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2) OVER upto, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER upto, 0)) AS own_level
    FROM weighed
    WINDOW upto AS (ORDER BY (source_size * 2)::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levelled AS (
    SELECT *, max(CASE WHEN own_level <= (source_size * 2)::DOUBLE / weight THEN own_level END) OVER () AS level FROM levels
), targets AS (
    SELECT source, source_size, CASE WHEN level IS NULL OR level * weight >= source_size * 2 THEN (source_size * 2)::DOUBLE ELSE level * weight END AS target
    FROM levelled
), placed AS (
    SELECT s.*, t.source_size, t.target, floor(t.target)::BIGINT AS words,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.at, s.size ROWS UNBOUNDED PRECEDING) - s.size AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(least(size, words - start), 0) + greatest(least(size, words - start - source_size), 0))::BIGINT AS taken
FROM placed
"""

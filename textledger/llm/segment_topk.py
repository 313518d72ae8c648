"""Exact top-k by inner product: segment statistics bound scores from coarse to fine, survivors are computed exactly."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

K = 5
#: Numbers of segments a vector is cut into, coarse to fine.
LEVELS = (1, 4, 16, 32)
QUERIES_PER_BLOCK = 16_384
ROWS_PER_BLOCK = 8_192
#: So many vectors, in hash order, give each query a first score that its k-th best reaches at least.
SEEDS = 2_048
#: What a score and a component times 256 must stay below; a larger one is an error, as in SQL.
TOO_LARGE = 2**63
#: Queries and rows that are compared at once: a tile's matrices hold so many numbers.
_TILE = (512, 2_048)
#: A level that leaves more than this of a block's pairs is skipped, but for one tile in ``_LOOK_AGAIN``.
_PAYS = 0.9
_LOOK_AGAIN = 8
#: Whole numbers up to here are exact as doubles.
_EXACT = 2.0**53


def _segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """For each segment, sqrt(length) times its mean and times its standard deviation.

    The squared distance of two vectors is at least the squared distance of these features, with equal norms; so the
    features' inner product is a vector pair's inner product at most.
    """
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)[:-1]
    lengths = np.diff(np.append(edges, x.shape[1]))
    sums = np.add.reduceat(x, edges, axis=1)
    squares = np.add.reduceat(x * x, edges, axis=1)
    return np.hstack((sums / np.sqrt(lengths), np.sqrt(np.maximum(0.0, squares - sums * sums / lengths))))


class Bounds:
    """Upper bounds of the scores of a block of queries and a block of rows, from coarse to fine levels.

    With d the distance, q.x = (|q|^2 + |x|^2 - d^2) / 2: a lower bound of d bounds the score from above. Each level of a tile is one matrix
    product of segment features. ``counts`` holds, per level, pairs that came to it and pairs it left.
    """

    def __init__(self, queries: np.ndarray, rows: np.ndarray):
        self.features = [(_segment_features(queries, s), _segment_features(rows, s)) for s in LEVELS] if rows.shape[1] else []
        self.norms = [tuple((f * f).sum(axis=1) / 2 for f in pair) for pair in self.features]
        # Rounding grows with the norms of the pair itself: a long vector leaves the slack of the others as it is.
        self.half = tuple((m * m).sum(axis=1) * (0.5 + _SLACK) for m in (queries, rows))
        self.counts, self.tiles = np.zeros((len(self.features), 2)), 0

    def possible(self, q: slice, x: slice, least: np.ndarray) -> np.ndarray:
        """Of the pairs of a tile those that may reach a score of ``least``, one number per query, as a mask."""
        open_ = np.ones((len(self.half[0][q]), len(self.half[1][x])), bool)
        self.tiles += 1
        for level, ((fq, fx), (nq, nx)) in enumerate(zip(self.features, self.norms)):
            came, left = self.counts[level]
            if (left > _PAYS * came and self.tiles % _LOOK_AGAIN) or not open_.any():
                continue
            self.counts[level, 0] += np.count_nonzero(open_)
            # Rows and queries that no pair is left of take no part in the finer products.
            rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            bound = fq[q][rows] @ fx[x][columns].T
            bound += (self.half[0][q] - nq[q])[rows, None]
            bound += (self.half[1][x] - nx[x])[None, columns]
            inner = np.ix_(rows, columns)
            open_[inner] &= bound >= (least - _SLACK)[rows, None]
            self.counts[level, 1] += np.count_nonzero(open_)
        return open_


def survivors(queries: np.ndarray, rows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) for which the bounds leave a score of ``least`` possible."""
    bounds, found = Bounds(queries, rows), []
    for at in range(0, len(queries), _TILE[0]):
        tile = slice(at, at + _TILE[0])
        for to in range(0, len(rows), _TILE[1]):
            q, x = np.nonzero(bounds.possible(tile, slice(to, to + _TILE[1]), least[tile]))
            found.append((q + at, x + to))
    return tuple(np.concatenate([f[i] for f in found] or [np.zeros(0, int)]) for i in (0, 1))


_PAIRS = 1 << 16
_SLACK = 1e-6


def _scores(a: np.ndarray, b: np.ndarray, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs. Those that could overflow a long are worked out in Python's integers; one that does is an error."""
    score = np.concatenate([np.einsum("ij,ij->i", a[q[i : i + _PAIRS]], b[x[i : i + _PAIRS]]) for i in range(0, len(q), _PAIRS)] or [np.zeros(0, np.int64)])
    most_a, most_b = (np.abs(m.astype(np.float64)).max(axis=1, initial=0) for m in (a, b))
    for i in np.flatnonzero(most_a[q] * most_b[x] * a.shape[1] >= TOO_LARGE / 2):
        whole = sum(map(int.__mul__, a[q[i]].tolist(), b[x[i]].tolist()))
        if abs(whole) >= TOO_LARGE:
            raise OverflowError(f"a score does not fit in a long: {whole}")
        score[i] = whole
    return score


def _best(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of the ``K`` highest scores, ties to the smaller id, in order."""
    if len(scores) > K:
        floor = np.partition(scores, len(scores) - K)[len(scores) - K]
        near = np.flatnonzero(scores >= floor)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:K]]


def _block(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The best ``K`` rows of one block for each query of another, by exact scores of the pairs that bounds leave over.

    A tile's exact scores are one product of doubles where all of them are whole numbers below 2**53, and else integers pair
    by pair. Of each tile a query keeps its best, whose last score is one that later tiles must reach; so
    the pairs of one tile are in memory, not those of the block.
    """
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    if not len(queries) or not len(rows):
        return empty
    a, b = (np.array(df["v"].tolist(), np.int64).reshape(len(df), -1) for df in (queries, rows))
    q_ids, x_ids, least = queries["vec_id"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64), queries["least"].to_numpy(np.float64).copy()
    fa, fb = a.astype(np.float64), b.astype(np.float64)
    bounds = Bounds(fa, fb)
    whole = [np.abs(m).max(axis=1, initial=0) for m in (fa, fb)]
    kept_score = [np.zeros(0, np.int64)] * len(a)
    kept_id = [np.zeros(0, np.int64)] * len(a)
    for to in range(0, len(b), _TILE[1]):
        x = slice(to, to + _TILE[1])
        for at in range(0, len(a), _TILE[0]):
            q = slice(at, at + _TILE[0])
            open_ = bounds.possible(q, x, least[q]) & (q_ids[q, None] != x_ids[None, x])
            columns = np.flatnonzero(open_.any(axis=0))
            if not len(columns):
                continue
            exact = whole[0][q].max() * whole[1][x].max() * max(a.shape[1], 1) < _EXACT
            tile = fa[q] @ fb[x][columns].T if exact else None
            for i in np.flatnonzero(open_.any(axis=1)):
                hits = np.flatnonzero(open_[i, columns])
                picked = columns[hits] + to
                score = tile[i, hits].astype(np.int64) if exact else _scores(a[at + i : at + i + 1], b[picked], np.zeros(len(picked), int), np.arange(len(picked)))
                near = _best(score, x_ids[picked])
                score = np.concatenate((kept_score[at + i], score[near]))
                ids = np.concatenate((kept_id[at + i], x_ids[picked[near]]))
                near = _best(score, ids)
                kept_score[at + i], kept_id[at + i] = score[near], ids[near]
                if len(near) == K:
                    least[at + i] = max(least[at + i], float(score[near[-1]]))
    lengths = [len(s) for s in kept_score]
    return pd.DataFrame({"query_id": np.repeat(q_ids, lengths), "vec_id": np.concatenate(kept_id), "score": np.concatenate(kept_score)}) if sum(lengths) else empty


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): floor(256 x) of each component x; without vectors that are null or hold null or non-finite
    components, and without null ids. A component that leaves the range of a long is an error."""
    x = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["embedding"].cast("array<double>").alias("e"))
    fine = F.coalesce(F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    whole = lambda c: F.when(F.abs(c * 256) < float(TOO_LARGE), F.floor(c * 256).cast("long")).otherwise(F.raise_error(F.lit("a component times 256 does not fit in a long")))
    return x.where(F.col("vec_id").isNotNull() & fine).select("vec_id", F.transform("e", whole).alias("v"))


def top_k(table: DataFrame, every: int = 50, blocks: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``K`` best other rows for each row whose vec_id is divisible by ``every``.

    ``table`` is what ``vectors`` gives. Scores are integer inner products, ties go to the smaller vec_id. Vectors are compared with those of
    their own length; empty ones score 0. Rows with the query's vec_id are its own; other repeated rows each count, and a query
    id that repeats is searched once, with its smallest vector. A score that does not fit in a long is an error. Fewer than ``K`` others give fewer rows, no rows none.

    Query and row blocks of bounded size meet by an equi-join on their numbers (the stated query set against all rows, in blocks).
    ``SEEDS`` rows are searched first: a query's ``K``-th score there is one that its result must reach, so most bounds fail.
    """
    spark = table.sparkSession
    rows = Scratch(spark, "top-k").keep(table.withColumn("dim", F.size("v")))
    n, n_query = rows.count(), rows.where(F.col("vec_id") % every == 0).count()
    n_rows_blocks = blocks or max(-(-n // ROWS_PER_BLOCK), min(2 * spark.sparkContext.defaultParallelism, -(-n // 512)), 1)
    n_query_blocks = max(-(-n_query // QUERIES_PER_BLOCK), 1)
    pick = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("x")).select("vec_id", "x.v", "x.dim").withColumn("qb", pick(n_query_blocks))

    def search(queries: DataFrame, rows: DataFrame) -> DataFrame:
        """Rows have a block number rb; each meets every query block, each query every row block."""
        left = queries.select("vec_id", "v", "dim", "qb", "least", F.explode("rbs").alias("rb"))
        fresh = rows.select(*(F.col(c).alias(c) for c in ("vec_id", "v", "dim", "rb")))  # attributes apart from the queries'
        right = fresh.select("vec_id", "v", "dim", "rb", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))).alias("qb"))
        keys = ["dim", "qb", "rb"]
        return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(_block, "query_id long, vec_id long, score long")

    seeds = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SEEDS).withColumn("rb", F.lit(0))
    seeded = search(queries.withColumn("least", F.lit(float("-inf"))).withColumn("rbs", F.array(F.lit(0))), seeds)
    least = seeded.groupBy("query_id").agg(F.when(F.count("*") >= K, F.min("score")).alias("least"))
    ready = (queries.join(least.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn("least", F.coalesce(F.col("least").cast("double"), F.lit(float("-inf"))))
             .withColumn("rbs", F.sequence(F.lit(0), F.lit(n_rows_blocks - 1))))
    found = search(ready, rows.withColumn("rb", pick(n_rows_blocks)))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= K).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


#: The same over table ``embeddings`` in DuckDB's SQL.
ORACLE_SQL = """
WITH x AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i]))::BIGINT AS score
    FROM x q JOIN x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

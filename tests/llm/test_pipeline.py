"""The pipeline stage by stage, and the queries against their SQL, over the smallest given tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import brute_dedup, brute_simhash, brute_targets

import __spark_entry__
import corpus_pipeline
from textledger.llm import queries, similar_texts, simhash_dedup, subword_toxicity
from textledger.llm.common import Scratch
from textledger.sources.settle import shared_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    scratch, docs = Scratch(spark, "test-pipeline"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(scratch.keep(stage(spark, out[-1], SF)))
    return out


def test_stages_keep_the_columns_of_documents(steps):
    assert all(s.columns == steps[0].columns and s.dtypes == steps[0].dtypes for s in steps[:-1])


def test_toxic_documents_go(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    verdict = {r.doc_id: r.predicted for r in subword_toxicity.toxicity(steps[0], labels).collect()}
    assert {r.doc_id for r in steps[1].select("doc_id").collect()} == {i for i, p in verdict.items() if not p}


def test_later_passages_go(steps):
    assert {r.doc_id: r.text for r in steps[2].collect()} == brute_dedup([(r.doc_id, r.text) for r in steps[1].collect()])
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def _smallest_of_groups(ids, linked):
    left, groups = set(ids), []
    while left:
        group, todo = set(), [min(left)]
        while todo:
            i = todo.pop()
            if i in left:
                left.remove(i)
                group.add(i)
                todo += [j for j in left if linked(i, j)]
        groups.append(min(group))
    return groups


def _shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def _similar(one, other):
    return len(one & other) >= 0.8 * len(one | other)


def test_one_of_each_group_stays(steps):
    rows = {r.doc_id: r for r in steps[2].collect()}
    sets = {i: _shingles(r.text) for i, r in rows.items()}
    groups = _smallest_of_groups(rows, lambda i, j: _similar(sets[i], sets[j]))
    assert sorted(map(tuple, steps[3].collect())) == sorted(tuple(rows[i]) for i in groups)


def test_keep_one_follows_fingerprints(steps):
    rows = {r.doc_id: r for r in steps[2].collect()}
    fps = {i: brute_simhash(r.text) for i, r in rows.items()}
    groups = _smallest_of_groups(rows, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    assert sorted(map(tuple, simhash_dedup.keep_one(steps[2], unnamed_stay=False).collect())) == sorted(tuple(rows[i]) for i in groups)


def test_chains_and_large_groups_of_near_copies_leave_one(spark):
    rng = random.Random(3)
    texts = []
    for g in range(6):
        words = [f"g{g}w{i}" for i in range(300)]
        for n in range(3 if g < 5 else 120):  # each copy is an edit of the one before: far members are not similar themselves
            words = list(words)
            words[rng.randrange(300)] = f"e{g}n{n}"
            texts.append(" ".join(words))
    texts += [" ".join(f"u{i}w{j}" for j in range(300)) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [_shingles(t) for t in texts]
    want = _smallest_of_groups(range(len(texts)), lambda i, j: _similar(sets[i], sets[j]))
    assert len(want) == 26 and sorted(r.doc_id for r in similar_texts.keep_one_similar(docs).collect()) == want


def test_similarity_at_its_limit(spark):
    words = [f"w{i}" for i in range(14)]  # ten shingles of five words
    texts = [" ".join(words), " ".join(words[:12]), " ".join(words[2:]), "", " \n", None, "two words", "Two  WORDS"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [_shingles(t or "") for t in texts]
    assert _similar(sets[0], sets[1]) and not _similar(sets[1], sets[2])
    assert similar_texts.jaccard(texts[0], texts[1]) == 0.8 and similar_texts.jaccard(texts[1], texts[2]) == 0.6
    assert {r.doc_id for r in similar_texts.keep_one_similar(docs).collect()} >= {0, 3, 6}
    assert not {4, 5, 7} & {r.doc_id for r in similar_texts.keep_one_similar(docs).collect()}
    assert {r.doc_id for r in similar_texts.keep_one_similar(docs.withColumn("doc_id", F.lit(None).cast("long")), unnamed_stay=True).collect()} == {None}
    assert similar_texts.keep_one_similar(docs.limit(0)).collect() == []


def test_one_of_each_group_stays_without_ids(spark):
    base = [" ".join(f"{c}{i}" for i in range(400)) for c in "abc"]
    rows = [(None, base[0]), (None, base[0]), (None, base[0].upper()), (None, base[1]), (7, base[1]), (None, base[2]), (None, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "s", len(t or "")) for i, t in rows], "doc_id long, text string, source string, n_chars long")
    kept = [(r.doc_id, (r.text or "").lower()) for r in corpus_pipeline.near_deduplication(spark, docs, SF).collect()]
    assert Counter(kept) == Counter([(None, base[0]), (7, base[1]), (None, base[2]), (None, "")])


def test_sources_meet_their_targets(steps):
    sizes, taken, own = defaultdict(int), defaultdict(int), {}
    for r in steps[3].collect():
        own[r.doc_id] = len(r.text.encode().split())
        sizes[r.source] += own[r.doc_id]
    per_doc = Counter()
    for r in steps[4].collect():
        per_doc[r.doc_id] += len(r.text.encode().split())
        taken[r.source] += len(r.text.encode().split())
    want = brute_targets(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= 1 for s in want) and all(n <= 2 * own[i] for i, n in per_doc.items())


def test_tokens_decode_to_the_texts(steps):
    found = Counter((r.doc_id, r.decoded_sha256) for r in steps[5].collect())
    assert found == Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in steps[4].collect())


def test_run_gives_the_last_stage(spark, steps):
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, steps[-1].collect()))


def test_queries_are_registered():
    assert set(queries.queries()) <= set(__spark_entry__.queries()) and set(queries.oracle_sql()) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    found = queries.queries()[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(f"SELECT {', '.join(found.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert Counter(map(tuple, found.collect())) == Counter(want) and want


def _folders(spark):
    base = shared_dir(spark)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(base)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {x.getPath().getName() for x in fs.listStatus(target)} if fs.exists(target) else set()


@pytest.mark.parametrize("empty", [True, False])
def test_odd_and_empty_tables_pass_and_intermediates_go(spark, tmp_path, empty):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None, None, "a", "x"), (2, "", "en", None, "x"), (None, "one\ntwo\nthree", None, "b", None), (None, None, None, None, None), (3, words, "en", "b", "x"),
            (4, words, "de", "b", "y"), (5, "long " * 50_000, "en", "a", "y"), (5, "other text of the same id", "en", "a", "y")]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, lang string, source string, row string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([] if empty else [(1, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    before = _folders(spark)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert (len(found) == 0) == empty and {r.doc_id for r in found} <= {1, 2, 3, 4, 5, None}
    left = _folders(spark) - before
    assert len(left) == 1 and "mixing" in next(iter(left))  # the table that the result itself reads


def test_no_similar_pair_is_left_out(spark):
    """Of so many pairs at the limit of similarity some share no band of MinHash values."""
    rng = random.Random(8)
    texts = []
    for g in range(600):
        words = [f"w{rng.randrange(1 << 40)}" for _ in range(14)]  # ten shingles, eight of them shared
        texts += [" ".join(words), " ".join(words[2:])]
    kept = similar_texts.keep_one_similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(0, 1200, 2))


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.9])
def test_first_shingles_of_similar_sets_meet(similarity):
    rng = np.random.default_rng(6)
    common = np.sort(rng.integers(0, 1 << 63, 30, np.uint64))
    known = common[::2], rng.integers(2, 9, 15)
    for _ in range(300):
        one = np.unique(np.concatenate([rng.choice(common, 12), rng.integers(0, 1 << 63, rng.integers(1, 40), np.uint64)]))
        other = np.unique(np.concatenate([rng.choice(one, rng.integers(len(one) // 2, len(one) + 1), replace=False), rng.integers(0, 1 << 63, rng.integers(0, 8), np.uint64)]))
        differ = len(np.setxor1d(one, other))
        short, long = sorted((similar_texts._sketch(x).view(np.uint64) for x in (one, other)), key=len)
        bits = np.bitwise_count(short ^ np.bitwise_xor.reduce(long.reshape(-1, len(short)))).sum()
        assert bits <= differ and (differ - bits) % 2 == 0
        if len(np.intersect1d(one, other)) >= similarity * len(np.union1d(one, other)):
            assert len(np.intersect1d(*(similar_texts.first_ones(x, known, similarity) for x in (one, other))))


def test_similar_texts_meet_and_unrelated_ones_do_not(spark):
    rng = random.Random(5)
    texts = []
    for g in range(120):  # pairs at similarity 0.8 to 0.82
        words = [f"g{g}w{i}" for i in range(204)]
        texts += [" ".join(words), " ".join(words[40 - g % 3 :])]
    texts += [" ".join(f"u{rng.randrange(1 << 60)}" for _ in range(30)) for _ in range(5000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = similar_texts._marked(simhash_dedup.keyed_texts(docs), similar_texts.WIDTH)
    cells = marked.select("doc_id", F.explode("cells").alias("cell"))
    assert cells.count() == len(texts) * similar_texts.BANDS
    shared = cells.groupBy("cell").agg(F.collect_list("doc_id").alias("ids")).where("size(ids) > 1").collect()
    assert all(max(r.ids) < 240 for r in shared)  # by segments of 24 bits, hundreds of unrelated texts met
    sets = [_shingles(t) for t in texts[:240]]
    similar = [i for i in range(0, 240, 2) if _similar(sets[i], sets[i + 1])]
    kept = {r.doc_id for r in similar_texts.keep_one_similar(docs).collect()}
    assert len(similar) == 120 and len([i for i in similar if i + 1 not in kept]) >= 114
    assert len(kept) == len(texts) - len([i for i in similar if i + 1 not in kept])

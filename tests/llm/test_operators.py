"""Each operator against a brute-force version, and its stated result for odd input."""

import base64
import hashlib
import itertools
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textledger.llm import (
    byte_bpe, ftrl_quality, line_dedup, minimax_shards, preference_format, segment_topk, simhash_dedup, sketch_fingerprints,
    source_mixing, subword_toxicity,
)
from textledger.llm.components import connected_components

DOC = "doc_id long, text string, source string, n_chars long"


def docs_of(spark, rows):
    """Documents with columns whose names an operator might use itself."""
    full = [(i, t, s, len(t or "")) for i, t, s in rows]
    return spark.createDataFrame(full, DOC).withColumns({c: F.lit("mine") for c in ("fp", "hash", "bin", "row", "text_crc32", "key", "size", "words", "y")})


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# Odd rows that every operator must take: nulls in any column, empty and blank texts, a long text, repeated rows.
@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    long_text = prose(rng, 30_000)
    rows = [(1, None, "a"), (2, "", None), (3, " \t\n", "a"), (4, "one", "b"), (4, "one", "b"), (None, "one two three\nfour five", "b"),
            (5, long_text, "a"), (6, prose(rng, 40), "b"), (7, "é😀 ÀB ß", None), (None, None, None)]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


# ---- 1: line dedup

def brute_chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    r = [sum(v * line_dedup.BASE ** k for k, v in enumerate(reversed(h[max(0, i - 1) : i + 1]))) % line_dedup.PRIME for i in range(len(h))]
    ends = [i for i in range(1, len(h) - 2) if r[i] < r[i - 1] and r[i] <= r[i + 1]] + [len(h) - 1]
    return [lines[a:b] for a, b in zip([0] + [e + 1 for e in ends], [e + 1 for e in ends], strict=False)]


def brute_dedup(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        kept = []
        for chunk in brute_chunks(text):
            passage = "\n".join(chunk)
            if sum(bool(x.strip()) for x in chunk) >= 2 and passage in seen:
                continue
            seen.add(passage)
            kept.append(passage)
        out[i] = "\n".join(kept)
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(1)
    shared = [[prose(rng, 6) for _ in range(12)] for _ in range(4)]
    rows = []
    for i in range(60):
        own = [prose(rng, 5) for _ in range(rng.randrange(0, 8))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + (rng.choice(shared) if i % 2 else []) + own[at:])))
    found = line_dedup.dedup_lines(docs_of(spark, [(i, t, "s") for i, t in rows])).select("row.doc_id", "clean").collect()
    assert {r.doc_id: r.clean for r in found} == brute_dedup(rows)
    assert sum(len(r.clean) for r in found) < 0.8 * sum(len(t) for _, t in rows)


def test_boundaries_resist_shifts():
    rng = random.Random(2)
    passage = [prose(rng, 6) for _ in range(40)]
    a = {tuple(c) for c in brute_chunks("\n".join(["x y"] + passage + ["z"]))}
    b = {tuple(c) for c in brute_chunks("\n".join(["p q", "r s", "t"] + passage))}
    assert sum(len(c) for c in a & b) > 25


def test_line_dedup_odd_input(spark, odd, nothing):
    found = line_dedup.dedup_lines(odd).collect()
    assert len(found) == 10 and all(r.removed_chunks == 0 and r.clean == r.row.text for r in found)
    assert line_dedup.dedup_lines(nothing).count() == 0
    two = "a b\nc d"
    copies = line_dedup.dedup_lines(docs_of(spark, [(9, two, "s"), (2, two, "s"), (None, two, "s"), (5, "a b\na b\n", "s")])).collect()
    assert {(r.row.doc_id, r.clean) for r in copies} == {(2, two), (9, ""), (None, ""), (5, "a b\na b\n")}


# ---- 2: top-k

def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 20))
    table = [(i, [float(x) for x in np.round(base[i % 6] + rng.normal(size=20) * 0.3, 2)]) for i in range(700)]
    table[8] = (8, table[3][1])  # ties
    rows = [(i, v, "mine") for i, v in table] + [(900, None, ""), (950, [float("nan")] * 20, ""), (951, [None] * 20, ""), (None, table[0][1], ""), (1000, [1.0, 2.0], ""), (1001, [3.0, 1.0], "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    found = segment_topk.top_k(segment_topk.vectors(frame), blocks=3).collect()
    whole = {i: [math.floor(256 * x) for x in v] for i, v in [*table, (1000, [1.0, 2.0]), (1001, [3.0, 1.0])]}
    want = []
    for q in whole:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert sorted(map(tuple, found)) == sorted(want)
    assert segment_topk.top_k(segment_topk.vectors(frame.limit(0))).count() == 0


def test_top_k_takes_large_components(spark):
    rng = np.random.default_rng(14)
    table = {i: [float(x) for x in rng.normal(size=64)] for i in range(300)}
    for i, size in ((7, 1e6), (50, 1e6), (51, 3e5), (120, -1e6), (130, 1e5)):
        table[i] = [size] * 64 if i % 2 else [float(x) for x in np.abs(rng.normal(size=64)).clip(0, 1) * size]
    found = segment_topk.top_k(segment_topk.vectors(spark.createDataFrame(list(table.items()), "vec_id long, embedding array<double>")), blocks=2).collect()
    whole, want = {i: [math.floor(256 * x) for x in v] for i, v in table.items()}, []
    for q in range(0, 300, 50):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert sorted(map(tuple, found)) == sorted(want)


@pytest.mark.parametrize("size", [1e8, 1e300])
def test_top_k_fails_where_a_score_overflows(spark, size):
    frame = spark.createDataFrame([(i, [size] * 64) for i in range(3)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit in a long"):
        segment_topk.top_k(segment_topk.vectors(frame)).collect()


def test_bounds_leave_out_no_good_pair_and_prune():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 64)) * 40
    x = np.floor(centres[rng.integers(8, size=600)] + rng.normal(size=(600, 64)) * 4)
    score = x[:50] @ x.T
    least = np.sort(score, axis=1)[:, -5].astype(float)
    q, r = segment_topk.survivors(x[:50], x, least)
    assert set(zip(*np.nonzero(score >= least[:, None]), strict=True)) <= set(zip(q, r, strict=True))
    assert len(q) < 0.5 * score.size


# ---- 3: preferences

def test_preferences(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "yö"), (1, 3, "user", "more"), (1, 4, "assistant", "end"),
            (2, 0, "assistant", "first"), (2, 1, "user", "x"), (3, 0, "user", None), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (4, 0, "user", "same"), (4, 1, "assistant", "same"),
            (None, 0, "user", "lost"), (5, None, "assistant", "late"), (5, 7, None, "q")]
    found = {r.conv_id: r for r in preference_format.echo_preferences(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(found) == {1, 3, 4, 5}
    one = found[1]
    assert one.shared_turns == 4 and one.prompt.endswith("<|user|>\nmore<|end|>\n") and one.chosen == "<|assistant|>\nend<|end|>\n" and one.rejected == "<|assistant|>\nmore<|end|>\n"
    for text, mask in ((one.chosen, one.chosen_mask), (one.rejected, one.rejected_mask)):
        (a, b), = [map(int, m.split("-")) for m in mask.split(",")]
        assert text[a:b].endswith("<|end|>\n") and text[:a] == "<|assistant|>\n"
    assert found[3].rejected == "<|assistant|>\n<|end|>\n" and found[4].shared_turns == 2 and found[4].chosen == found[4].chosen_mask == ""
    assert found[5].prompt == "<|unknown|>\nq<|end|>\n"


def test_longest_common_prefix_of_given_pairs(spark):
    kind = "conv_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    a, b, c = ("user", "a"), ("assistant", "b"), ("assistant", "c")
    found = {r.conv_id: r for r in preference_format.format_pairs(spark.createDataFrame([(1, [a, b, a, b], [a, c]), (2, [a], [a, b]), (3, None, [b])], kind)).collect()}
    assert [found[i].shared_turns for i in (1, 2, 3)] == [1, 1, 0]
    assert found[1].chosen_mask.count("-") == 2 and found[2].chosen == "" and found[3].prompt == ""


# ---- 4: byte-level BPE

@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return public, byte_bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))


def test_perfect_hash(vocabulary):
    _, ranks = vocabulary
    some = dict(itertools.islice(ranks.items(), 3_001))
    table = byte_bpe.PerfectHash(some)
    assert all(table.get(k) == v for k, v in some.items()) and sorted(table.keys) == sorted(some)
    assert table.get(b"never a token") is None and byte_bpe.PerfectHash({}).get(b"x") is None


def test_bpe_equals_tiktoken(spark, odd, nothing, vocabulary, monkeypatch):
    import tiktoken

    public, ranks = vocabulary
    theirs = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    texts = ["a" * 5_000, "<|endoftext|> it's", "\n\n  x\t", "😀é" * 40, "".join(chr(rng.randrange(1, 0x2FFF)) for _ in range(3_000))]
    rows = [(100 + i, t, "s") for i, t in enumerate(texts)]
    docs = odd.unionByName(docs_of(spark, rows))
    found = Counter(map(tuple, byte_bpe.encode_decode(docs, ranks, public.PATTERN).collect()))
    want = Counter()
    for r in docs.collect():
        ids = theirs.encode_ordinary(r.text or "")
        want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
    assert found == want
    encoded = byte_bpe.encode(docs.where("doc_id > 5"), ranks, public.PATTERN)
    assert {(r.doc_id, bytes(r.bytes).decode()) for r in byte_bpe.decode(encoded, ranks).collect()} == {(r.doc_id, r.text) for r in docs.where("doc_id > 5").collect()}
    assert byte_bpe.encode_decode(nothing, ranks, public.PATTERN).count() == 0
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 10)
    monkeypatch.setattr(byte_bpe, "_PIECES", 7)
    codec = byte_bpe.Codec(byte_bpe.PerfectHash(ranks), public.PATTERN)
    assert codec.round_trip(texts[4])[0] == len(theirs.encode_ordinary(texts[4]))


def test_rank_file(tmp_path):
    (tmp_path / "r").write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate((b"a", b"b", b"ab"))))
    assert byte_bpe.read_ranks(str(tmp_path / "r")) == {b"a": 0, b"b": 1, b"ab": 2}


def test_bpe_memo_keeps_frequent_pieces(monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256}
    codec = byte_bpe.Codec(byte_bpe.PerfectHash(ranks), r"\S+")
    merged, merge = [], codec.merge
    monkeypatch.setattr(byte_bpe, "MEMO", 4)
    monkeypatch.setattr(codec, "merge", lambda token: merged.append(token) or merge(token))
    text = " ".join(f"abab x{i}" for i in range(40))
    expected = ",".join(f"256,256,120,{','.join(str(ord(c)) for c in str(i))}" for i in range(40))
    assert ",".join(codec.encode(text)) == expected
    assert merged.count(b"abab") == 1 and len(codec.memo) <= 4 and len(codec.memo.old) <= 4
    assert codec.round_trip(text)[1:] == tuple(hashlib.sha256(t).hexdigest() for t in (expected.encode(), text.replace(" ", "").encode()))


# ---- 5 and 7: classifiers

def labelled(spark, kind):
    rng = random.Random(7)
    texts, ys = [], []
    for _ in range(900):
        bad = rng.random() < 0.3
        words = [f"{rng.choice(('ta', 'ne', 'ri'))}{rng.choice(('lo', 'mi', 'sa'))}{rng.choice('abcdef')}" for _ in range(rng.randrange(30, 80))]
        if bad and kind == "toxic":
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(("nastyword", "uglything"))
        elif bad:
            words = [f"{w.upper()}!!" for w in words]
        texts.append(" ".join(words))
        ys.append(int(bad) if kind == "toxic" else int(not bad))
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, y, y) for i, y in enumerate(ys)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels, ys


@pytest.mark.parametrize("kind, operator, rest", [("quality", ftrl_quality.quality, 5), ("toxic", subword_toxicity.toxicity, 3)])
def test_classifier_on_held_out_labels(spark, odd, nothing, kind, operator, rest):
    docs, labels, ys = labelled(spark, kind)
    found = operator(docs, labels).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(900) if (zlib.crc32(str(i).encode()) % rest == 0 if rest == 5 else zlib.crc32(str(i).encode()) % rest == 1)}
    assert np.mean([r.predicted == ys[r.doc_id] for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in found)
    again = operator(docs.repartition(5), labels.repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    untaught = operator(odd, labels.limit(0)).collect()
    assert len(untaught) == 10 and {r.score for r in untaught} == {0.5} and all(r.held_out for r in untaught if r.doc_id is None)
    assert operator(nothing, labels).count() == 0


def test_misspellings_share_vectors(spark):
    docs, labels, ys = labelled(spark, "toxic")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = subword_toxicity.train([rows[i] for i in range(900)], ys)
    clean = next(rows[i] for i in range(900) if not ys[i]).split()
    assert model.score(" ".join(clean[:25] + ["nastyw0rd", "uglyythings"] * 2)) > model.score(" ".join(clean[:29])) + 0.2


def test_rejected_documents_go(spark, odd):
    docs, labels, ys = labelled(spark, "toxic")
    kept = subword_toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert np.mean([(i in ids) == (not ys[i]) for i in range(900)]) > 0.95


# ---- 6: mixing

def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in free)) if free else 0
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def mixed_docs(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(1, 60)), rng.choice("aaaaaabcdé")) for i in range(400)] + [(500, "x y z", None), (501, None, "b"), (502, "", "zz"), (3, "again", "a"), (None, "no id", "c")]
    return docs_of(spark, rows), rows


def test_mix_meets_targets(spark, nothing):
    docs, rows = mixed_docs(spark)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    found = source_mixing.mix(docs, shards=4, blocks_per_shard=16)
    out, want, by = found.collect(), brute_targets(dict(sizes)), defaultdict(int)
    assert len(out) == len(rows)
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        taken = sum(p["words"] for p in r.pieces)
        assert taken <= 2 * r.size
        by[r.source] += taken
    assert all(abs(by[s] - want[s]) <= 1 for s in want)
    key = lambda rows: sorted(map(str, rows))
    assert key(source_mixing.mix(docs.repartition(7), 4, 16).collect()) == key(out)
    assert source_mixing.mix(nothing).count() == 0
    # Whole words of the pieces, in the texts themselves.
    mixture = source_mixing.mixture(docs, found).collect()
    assert all(len(r.row.text.split()) == r.words for r in mixture) and sum(r.words for r in mixture) == sum(by.values())
    assert {r.shard for r in mixture} == {0, 1, 2, 3}


def test_tree_splits_quotas_exactly(spark):
    quotas = spark.createDataFrame([(0, 40), (1, 17), (2, 7), (3, 0)], "rank int, quota int")
    out = source_mixing.splitting_tree(quotas, 8).collect()
    per_source, per_shard = Counter(), Counter()
    for r in out:
        per_source[r["rank"]] += r["n"]
        per_shard[r["shard"]] += r["n"]
    assert per_source == {0: 40, 1: 17, 2: 7, 3: 0} and set(per_shard.values()) == {8}
    assert len({r["n"] for r in out if r["rank"] == 0}) > 1  # drawn, not dealt evenly


# ---- 8: SimHash

def brute_simhash(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_equal_brute_force(spark, odd):
    signed = lambda x: struct.unpack("<q", struct.pack("<Q", x))[0]
    found = Counter((r.doc_id, r.fp) for r in simhash_dedup.fingerprints(odd).collect())
    assert found == Counter((r.doc_id, signed(brute_simhash(r.text))) for r in odd.collect())


@pytest.mark.parametrize("dense", [0, 2, 32, 10_000])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, dense):
    monkeypatch.setattr(simhash_dedup, "DENSE", dense)
    rng = random.Random(9)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            fps.add(struct.unpack("<q", struct.pack("<Q", x))[0])
    edges = simhash_dedup.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    assert all(near(a, b) for a, b in edges)
    assert brute_components(fps, edges) == brute_components(fps, [(a, b) for a, b in itertools.combinations(fps, 2) if near(a, b)])


def test_links_broadcast_no_table_that_grows(spark):
    """Spark takes the 35 values that a fingerprint looks up for one, so it would broadcast them at many times the size it allows."""
    distinct = spark.range(5000).select(F.xxhash64("id").alias("fp"))
    plan = simhash_dedup.links(distinct)._jdf.queryExecution().sparkPlan().toString()
    broadcast = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert plan.count("SortMergeJoin") == 2 and all("LeftAnti" in line for line in broadcast)


def test_near_duplicates(spark, odd, nothing):
    rng = random.Random(10)
    base = prose(rng, 400).split()
    rows = [(50 - i, " ".join(base[:399] + [f"w{i % 2}"]), "s") for i in range(4)] + [(60 + i, prose(rng, 50), "s") for i in range(20)]
    docs = odd.unionByName(docs_of(spark, rows))
    texts = [(r.doc_id, brute_simhash(r.text)) for r in docs.collect()]
    fps = {f for _, f in texts}
    group = brute_components(fps, [(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 2])
    first = {}
    for i, f in texts:
        if i is not None:
            first[group[f]] = min(i, first.get(group[f], i))
    found = simhash_dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.component_id) for r in found) == Counter((i, first.get(group[f])) for i, f in texts)
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(first.values()) and ids.count(None) == 2
    assert simhash_dedup.near_duplicates(nothing).count() == 0 and simhash_dedup.keep_one(nothing).count() == 0


def test_keep_one_decides_by_row_where_an_id_repeats(spark):
    rng = random.Random(12)
    rows, want = [], []
    for i in range(0, 60, 3):
        first, alone, other = (prose(rng, 300) for _ in range(3))
        # A unique text and a copy of an earlier document under one id; two unrelated texts under another.
        rows += [(i, first, "s"), (i + 1, alone, "s"), (i + 1, first.upper(), "s"), (i + 2, other, "s"), (i + 2, other[::-1], "s"), (i + 2, other, "s")]
        want += [(i, first), (i + 1, alone), (i + 2, other), (i + 2, other[::-1])]
    assert sorted((r.doc_id, r.text) for r in simhash_dedup.keep_one(docs_of(spark, rows)).collect()) == sorted(want)


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7, 7), (None, 3)]
    found = {r.node: r.root for r in connected_components(spark, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {1001: 1000}
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 9: shards

def brute_capacity(sizes, shards):
    best = [0] + [math.inf] * len(sizes)
    for _ in range(shards):
        upto = [0, *itertools.accumulate(sizes)]
        best = [min(max(best[j], upto[i] - upto[j]) for j in range(i + 1)) for i in range(len(sizes) + 1)]
    return best[-1]


@pytest.mark.parametrize("hot", [0, 150])
def test_shards_are_the_smallest_possible(spark, hot):
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randrange(1, 40)), "s") for i in range(150)] + [(1000 + i, "the very same text of several words " * 3, "s") for i in range(hot)]
    found = minimax_shards.shard(docs_of(spark, rows)).collect()
    assert len(found) == len(rows)
    text = {i: t for i, t, _ in rows}
    groups, shard_bytes, slots, of = defaultdict(int), Counter(), defaultdict(list), {}
    for r in found:
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "bytes" and r.grown_shard is None
        groups[hashlib.md5(text[r.doc_id].encode()).hexdigest()] += r.size
        shard_bytes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert of.setdefault(text[r.doc_id], r.shard) == r.shard
    assert max(shard_bytes.values()) <= brute_capacity([groups[k] for k in sorted(groups)], 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    if not hot:
        assert len(slots) == 8 and min(shard_bytes.values()) > 0.6 * max(shard_bytes.values())


def test_shards_of_odd_input(odd, nothing):
    found = minimax_shards.shard(odd).collect()
    assert len(found) == 10 and {r.size for r in found if r.doc_id in (1, 2)} == {1} and len({r.shard for r in found if r.doc_id in (1, 2)}) == 1
    assert minimax_shards.shard(nothing).count() == 0


def test_capacity_search_against_dynamic_programming():
    rng = random.Random(12)
    for _ in range(30):
        sizes = [rng.choice((1, 5, 30, 200)) + rng.randrange(9) for _ in range(rng.randrange(1, 60))]
        keys = sorted(f"{rng.getrandbits(64):032x}"[::-1] for _ in sizes)
        upto = list(itertools.accumulate(sizes))

        def finer(prefixes, digits, keys=keys, upto=upto, sizes=sizes):
            out = {}
            for p in prefixes:
                for k, e, s in zip(keys, upto, sizes, strict=True):
                    if k.startswith(p):
                        q = k[: len(p) + digits]
                        end, begin, n, _ = out.get(q, (0, e - s, 0, q))
                        out[q] = (max(end, e), min(begin, e - s), n + 1, q)
            return sorted(out.values())

        monkey = minimax_shards.Ends(lambda p, d: finer(p, 1))
        shards = rng.randrange(1, 9)
        assert minimax_shards.smallest_capacity(monkey, shards) == brute_capacity(sizes, shards)
        cuts = minimax_shards.balanced_cuts(monkey, shards)
        assert max(b - a for a, b in zip([0, *cuts], cuts, strict=False)) <= brute_capacity(sizes, shards) and cuts == sorted(cuts)


# ---- 10: fingerprints

def spark_hash(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return struct.unpack("<q", struct.pack("<Q", seed))[0]


def brute_sketch(text):
    words = text.encode().split()
    h = [struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(w, 42)))[0] for w in words]
    if not h:
        return []
    return sorted({spark_hash((h[i : i + 5] + [0] * 5)[:5]) for i in range(max(1, len(h) - 4))})[: sketch_fingerprints.K]


def brute_resemblance(a, b):
    union = sorted(set(a) | set(b))[: sketch_fingerprints.K]
    return len(set(a) & set(b) & set(union)) / len(union) if union else 1.0


def test_edited_fingerprints_equal_brute_force(spark, nothing, monkeypatch):
    monkeypatch.setattr(sketch_fingerprints, "ROWS_PER_BIN", 4)
    rng = random.Random(13)
    texts = {i * i: prose(rng, rng.choice((0, 1, 3, 30, 300)), 60) for i in range(60)} | {10**15: "é😀 x", 7: None, 5: prose(rng, 5_000)}
    found = {r.doc_id: r for r in sketch_fingerprints.edited_fingerprints(docs_of(spark, [(i, t, "s") for i, t in texts.items()])).collect()}
    ids = sorted(texts)
    digest = lambda s: "".join(struct.pack(">q", x).hex() for x in s)
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text, following = texts[i] or "", texts[after] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c, r = brute_sketch(text), brute_sketch(edited), brute_sketch(following), found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (digest(a), digest(b))
        assert (r.near_edited, r.near_next) == (brute_resemblance(a, b), brute_resemblance(a, c))
    assert sketch_fingerprints.edited_fingerprints(nothing).count() == 0


def test_ids_of_many_rows_are_cut_into_bins(spark, monkeypatch):
    monkeypatch.setattr(sketch_fingerprints, "ROWS_PER_BIN", 20)
    rows = [(None if i % 3 == 0 else 77 if i % 3 == 1 else i - 400, f"text {i} and more") for i in range(1200)] + [((1 << 63) - 1, "last"), (-(1 << 63), "first")]
    docs = docs_of(spark, [(i, t, "s") for i, t in rows])
    bins = Counter(r.bin for r in sketch_fingerprints.in_id_order(docs).where("NOT guest").collect())
    assert sum(bins.values()) == len(rows) and max(bins.values()) <= 60 and len(bins) >= 40
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(r[1].encode(), 42)))[0]))
    want = Counter()
    for (i, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        want[i, hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in sketch_fingerprints.edited_fingerprints(docs).collect()) == want


def test_fingerprints_of_odd_input(spark, odd):
    found = sketch_fingerprints.edited_fingerprints(odd).collect()
    assert len(found) == 10 and len({r.fingerprint for r in found if r.doc_id == 4}) == 1 and {r.fingerprint for r in found if r.doc_id in (1, 2, 3)} == {""}
    alone = sketch_fingerprints.edited_fingerprints(docs_of(spark, [(1, "a b c d", "s")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"a b a b").hexdigest() and alone.near_next == 1.0


def test_estimates_and_merging(spark):
    rng = random.Random(14)
    words = [f"v{i}" for i in rng.sample(range(10**6), 6_000)]
    rows = [("a", " ".join(words[:4_000])), ("b", " ".join(words[2_000:6_000])), ("part", " ".join(words[:1_000]))]
    own = spark.createDataFrame(rows, "key string, text string").withColumn("w", sketch_fingerprints.words(F.col("text"))).withColumn("s", sketch_fingerprints.sketch(F.col("w")))
    s = {r.key: r.s for r in own.collect()}
    row = spark.createDataFrame([(s["a"], s["b"], s["part"])], "a array<long>, b array<long>, p array<long>")
    a, b, p = F.col("a"), F.col("b"), F.col("p")
    got = row.select(sketch_fingerprints.resemblance(a, b).alias("r"), sketch_fingerprints.containment(p, a).alias("c"), sketch_fingerprints.distinct_shingles(a).alias("n")).first()
    assert got.r == pytest.approx(1 / 3, abs=0.2) and got.c > 0.6 and got.n == pytest.approx(4_000, rel=0.5)
    parts = spark.createDataFrame([("x", s["a"]), ("x", s["part"]), ("y", [])], "key string, sketch array<long>")
    merged = {r.key: r.sketch for r in sketch_fingerprints.merged_sketches(parts).collect()}
    assert merged == {"x": s["a"], "y": []}

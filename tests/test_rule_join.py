import random

from pyspark.sql import functions as F
from test_classify import SAMPLES, messages
from test_features import C

from textledger.functions.keys import DAY_MS
from textledger.operators import rule_join
from textledger.operators.classify import label_messages, to_raw
from textledger.operators.rolling import rolling_credit
from textledger.operators.rule_join import label_by_rules, matches
from textledger.rules import RuleSet

RULES = "label string, tags array<string>, keyword string, kind string"


def test_matches_equal_contains(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    texts = [(i, word(rng.randrange(0, 60))) for i in range(200)] + [(900, ""), (901, None)]
    keywords = {word(rng.randrange(1, 7)) for _ in range(300)} | {"", "zzz", "a"}
    for picked in (keywords, {k for k in keywords if len(k) > 4}, {"zzzz"}, set()):
        table = spark.createDataFrame([(k,) for k in picked], "keyword string")
        found = matches(spark.createDataFrame(texts, "raw_id long, _body_lower string"), table)
        assert sorted(map(tuple, found.collect())) == sorted((i, k) for i, t in texts if t is not None for k in picked if k in t)


def test_fifty_thousand_rules_without_collecting_them(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(4, 9)))
    rules = [(f"L{rng.randrange(40)}", rng.choice((["BANK"], ["UPI"], ["BANK", "LENDER"])), word(), "include" if i % 5 else "exclude") for i in range(50_000)]
    rows = [("b", rng.choice(("hdfcbk", "jiopay", "navi")), " ".join(word() for _ in range(rng.randrange(1, 12))), 1_700_000_000_000 + i) for i in range(300)]
    raw = to_raw(messages(spark, rows))
    found = {r.raw_id: list(r.categories) for r in label_by_rules(raw, spark.createDataFrame(rules, RULES)).collect()}
    tags, include, exclude = {}, {}, {}
    for label, mine, key, kind in rules:
        tags.setdefault(label, set()).update(mine)
        (include if kind == "include" else exclude).setdefault(label, set()).add(key)
    want = {}
    for r in raw.collect():
        tag = {"hdfcbk": "BANK", "jiopay": "UPI", "navi": "LENDER"}[r.sms_sender]
        labels = sorted(x for x in include if tag in tags[x] and any(k in r.sms_body for k in include[x]) and not any(k in r.sms_body for k in exclude.get(x, ())))
        if labels:
            want[r.raw_id] = labels
    assert found == want and len(want) > 100


def test_both_ways_to_match_agree_and_a_small_index_moves_no_text(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abc ") for _ in range(n))
    texts = [(i % 150, word(i % 150)) for i in range(150)] + [(None, "abc"), (151, None)]
    texts += texts[:50]  # keys that repeat have one text
    keywords = spark.createDataFrame([(k,) for k in {word(rng.randrange(1, 6)) for _ in range(80)}], "keyword string")
    frame = spark.createDataFrame(texts, "raw_id long, _body_lower string")
    here = matches(frame, keywords)
    assert here._jdf.queryExecution().sparkPlan().toString().count("Join") == 1  # with the index, and none with the texts
    monkeypatch.setattr(rule_join, "SMALL_INDEX", -1)
    moved = matches(frame, keywords)
    found = sorted(map(tuple, here.collect()))
    assert found == sorted(map(tuple, moved.collect())) and len(found) > 1000


def test_rule_join_equals_expressions(spark):
    rules = [("A", ["BANK"], "credited", "include"), ("A", ["UPI"], "upi", "include"), ("A", ["UPI"], "salary", "exclude"), ("B", ["BANK", "UPI"], "rs", "include"), ("C", ["BANK"], "x", "exclude")]
    table, raw = spark.createDataFrame(rules, RULES), to_raw(messages(spark, [*SAMPLES, SAMPLES[0]]))
    keep = lambda df: sorted((r.raw_id, tuple(sorted(r.categories))) for r in df.collect())
    assert keep(label_by_rules(raw, table)) == keep(label_messages(raw, RuleSet.from_table(table)))
    assert label_by_rules(raw, table.limit(0)).count() == 0


def test_rolling_credit_at_the_borders_of_days(spark):
    t = 100 * DAY_MS
    rows = [("a", 0, 1), ("a", DAY_MS - 1, 2), ("a", 30 * DAY_MS - 1, 4), ("a", 30 * DAY_MS, 8), ("a", 30 * DAY_MS, 16), ("a", 31 * DAY_MS - 1, 32), ("a", 60 * DAY_MS, 64), ("b", 5, 128)]
    rows = [(b, t + ms, x) for b, ms, x in rows]
    df = spark.createDataFrame([(f"{b}{ms}{x}", b, C, ms, x) for b, ms, x in rows], "raw_id string, borrower_id string, categories array<string>, inbox_time_ms long, amount int")
    df = df.withColumn("amount", F.col("amount").cast("decimal(15,2)"))
    noise = df.limit(1).withColumns({"categories": F.array(F.lit("EMI_PAYMENT")), "amount": F.lit(1000).cast("decimal(15,2)")})
    got = {r.raw_id: (int(r.credit_30d), int(r.credit_60d)) for r in rolling_credit(df.unionByName(noise)).collect()}
    total = lambda b, ms, n: sum(x for c, s, x in rows if c == b and ms - n * DAY_MS < s <= ms)
    assert got == {f"{b}{ms}{x}": (total(b, ms, 30), total(b, ms, 60)) for b, ms, x in rows}
    assert rolling_credit(df.limit(0)).count() == 0
    plan = rolling_credit(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(borrower_id" in plan and "_day" in plan

from pyspark.sql import functions as F

from textledger.operators.quality import (
    constraint_report, count_discrepancies, daily_counts, null_violations, payload_mismatches, reconcile_counts,
    reference_violations, unique_violations,
)
from textledger.operators.reports import label_distribution, run_counts, sender_counts


def ids(spark, text):
    return spark.createDataFrame([(None if c == "-" else c,) for c in text], "customer_id string")


def test_reconcile(spark):
    got = reconcile_counts(ids(spark, "aaabbbcccdd-"), ids(spark, "aaabbcccccee--"))
    rows = {r.customer_id: (r.device_count, r.ingested_count, r.delta, r.status) for r in got.collect()}
    assert rows == {
        "a": (3, 3, 0, "OK"), "b": (3, 2, -1, "MISSING"), "c": (3, 5, 2, "DUPLICATE"), "d": (2, 0, -2, "MISSING"),
        "e": (0, 2, 2, "DUPLICATE"),
    }


def test_tolerance(spark):
    expected = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100), ("d", 1)], "borrower_id string, expected long")
    actual = spark.createDataFrame([("a", 95), ("b", 94), ("c", 106), ("e", 1), (None, 5)], "borrower_id string, actual long")
    got = {r.borrower_id: (r.expected, r.actual) for r in count_discrepancies(actual, expected).collect()}
    assert got == {"b": (100, 94), "c": (100, 106), "d": (1, 0), "e": (0, 1)}


def test_daily_counts(spark):
    df = spark.createDataFrame([("a", "2020-01-01"), ("a", "2020-01-01"), ("b", "2020-01-02"), (None, "2020-01-01")], "borrower_id string, d string")
    got = daily_counts(df.withColumn("txn_date", F.to_date("d")), "2020-01-01").collect()
    assert [(r.borrower_id, r.sms_count) for r in got] == [("a", 2)]


def test_payloads(spark):
    rows = [("p", 2, ["x", "y"]), ("q", 2, ["x"]), ("r", 0, None), ("s", None, ["x"])]
    got = payload_mismatches(spark.createDataFrame(rows, "payload_id string, expected long, messages array<string>"))
    assert sorted(map(tuple, got.collect()), key=str) == [("q", 2, 1), ("s", None, 1)]


def test_constraints(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    parent = spark.createDataFrame([("a",)], "id string")
    report = constraint_report(null_violations(df, ["k", "v"]), unique_violations(df, "k"), reference_violations(df, "k", parent, "id"))
    assert {r.check: r.violations for r in report.collect()} == {"not_null:k": 0, "not_null:v": 1, "unique:k": 1, "reference:k": 1}


def test_counts(spark):
    df = spark.createDataFrame([(["A", "B"],), (["A"],)], "categories array<string>")
    assert [tuple(r) for r in label_distribution(df).collect()] == [("A", 2), ("B", 1)]
    assert tuple(run_counts(spark.range(8), spark.range(2)).first()) == (8, 2, 25.0)
    assert tuple(run_counts(spark.range(0), spark.range(0)).first()) == (0, 0, None)
    senders = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "sms_sender string")
    assert sender_counts(senders).first()[0] == sender_counts(senders, approximate=True).first()[0] == 2

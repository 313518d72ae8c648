from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from textledger.operators import features as module
from textledger.operators.features import (
    borrower_features, borrower_totals, credit_momentum, in_lookback, latest_balance, upsert_features, warehouse_features,
)
from textledger.operators.merge import empty_features, merge_features, not_yet_processed, upsert
from textledger.operators.profile import score_profile, wide_profile
from textledger.operators.reports import avg_credit_by_risk, risk_distribution, top_borrowers
from textledger.schemas import FEATURE_SCHEMA

DAY = 86_400_000
NOW = 20_000 * DAY + 3_600_000
FACTS = "borrower_id string, categories array<string>, amount decimal(15,2), balance decimal(15,2), txn_date date, inbox_time_ms long"
C, S, D, U, E, L, X = (
    ["BANK_CREDIT"], ["SALARY_CREDIT"], ["BANK_DEBIT"], ["UPI_PAYMENT"], ["EMI_PAYMENT"], ["LOAN_DISBURSEMENT"],
    ["FAILED_TRANSACTION"],
)


def facts(spark, rows):
    """(borrower, labels, amount, balance, age in ms)."""
    money = lambda v: None if v is None else Decimal(v)
    day = lambda ms: date(1970, 1, 1) + timedelta(days=ms // DAY)
    made = [(b, c, money(a), money(bal), day(NOW - age), NOW - age) for b, c, a, bal, age in rows]
    return spark.createDataFrame(made, FACTS)


AS_OF = str(date(1970, 1, 1) + timedelta(days=NOW // DAY))


def one(spark, rows, **kw):
    got = borrower_features(facts(spark, [("b", *r) for r in rows]), **kw).collect()
    assert len(got) == 1
    return got[0]


@pytest.mark.parametrize(
    "rows, score, flag",
    [
        ([(X, None, None, 0), (E, "6000", None, 0), (C, "9000", None, 0)], 70, "HIGH"),
        ([(X, None, None, 0)], 30, "MEDIUM"),
        ([(C, "10", None, 0)], 0, "LOW"),
        ([(L, "1", None, 0)] * 3, 0, "LOW"),
        ([(L, "1", None, 0)] * 4, 20, "LOW"),
        ([(C, "79", None, 0), (C, "100", None, 31 * DAY)], 10, "LOW"),
        ([(C, "80", None, 0), (C, "100", None, 31 * DAY)], 0, "LOW"),
        ([(E, "5", None, 0), (C, "9", None, 0)], 0, "LOW"),  # exactly one half
        ([(E, "5.01", None, 0), (C, "9", None, 0)], 40, "MEDIUM"),
    ],
)
def test_risk(spark, rows, score, flag):
    got = one(spark, rows)
    assert (got.risk_score, got.risk_flag) == (score, flag)


def test_momentum_edges(spark):
    rows = [(D, None, None, 0), (C, "10", None, 30 * DAY - 1), (C, "20", None, 30 * DAY), (C, "40", None, 60 * DAY), (S, "5", None, 60 * DAY - 1)]
    assert one(spark, rows).credit_momentum == 10 / 25
    assert one(spark, [(C, "7", None, 0)]).credit_momentum == 1.0


def test_balances_and_sums(spark):
    rows = [(C, None, None, 0), (C, None, "5", 1), (D, None, "9", 1), (U, "3", "70", 2)]
    got = one(spark, rows)
    assert got.last_known_balance == Decimal("9.00")  # the larger of the same millisecond
    assert got.min_balance_seen_90d == Decimal("5.00")
    assert (got.count_credit_txn_90d, got.sum_credit_amount_90d, got.max_single_credit_90d) == (2, 0, 0)
    assert (got.count_debit_txn_90d, got.sum_debit_amount_90d) == (2, Decimal("3.00"))
    assert got.foir_proxy_90d is None
    assert one(spark, [(C, "1", None, 0)]).last_known_balance is None
    negative = latest_balance(facts(spark, [("b", C, None, "-4", 0), ("b", C, None, "-9", 0), ("b", C, None, "99", 5)])).first()
    assert negative.last_known_balance == Decimal("-4.00")


def test_sums_beyond_the_type_of_one_amount(spark):
    most = "9999999999999.99"
    got = borrower_features(facts(spark, [("b", [*C, *E], most, None, 0)] * 3)).first()
    assert got.sum_credit_amount_90d == got.sum_emi_amount_90d == 3 * Decimal(most)


def test_lookback(spark):
    rows = facts(spark, [("b", C, "1", None, 90 * DAY), ("b", C, "2", None, 91 * DAY), (None, C, "3", None, 0)])
    assert [r.sum_credit_amount_90d for r in warehouse_features(rows, AS_OF).collect()] == [Decimal("1.00")]
    assert [r.sum_credit_amount_90d for r in warehouse_features(rows, AS_OF, None).collect()] == [Decimal("3.00")]
    assert in_lookback(rows, F.lit(AS_OF).cast("date"), 0).count() == 1
    later = facts(spark, [("b", C, "1", None, -DAY)])
    assert in_lookback(later, AS_OF).count() == 0


def test_empty_input(spark):
    got = borrower_features(facts(spark, []))
    assert got.count() == 0
    names = [f.name for f in FEATURE_SCHEMA if f.name != "last_updated"]
    assert got.columns == names


def test_hot_and_cold_borrowers_agree(spark, monkeypatch):
    rows = [(f"b{i % 7}", [C, S, D][i % 3], str(i), None, (i * 7919 % 100) * DAY + i) for i in range(400)]
    rows += [("huge", C, "2", None, (i % 80) * DAY) for i in range(300)]
    df = facts(spark, rows)
    wanted = sorted(credit_momentum(df, borrower_totals(df)).collect())
    for limit in (1, 3):  # now most borrowers take the shuffled path
        monkeypatch.setattr(module, "HOT_BORROWERS", limit)
        assert sorted(credit_momentum(df, borrower_totals(df)).collect()) == wanted
    assert sorted(credit_momentum(df.repartition(13), borrower_totals(df)).collect()) == wanted


def test_mock_borrowers_as_in_the_smoke_run(spark):
    """300 rows, 5 borrowers, two labels each: counts add up and every borrower gets a row."""
    labels = ["BANK_CREDIT", "BANK_DEBIT", "UPI_PAYMENT", "EMI_PAYMENT", "SALARY_CREDIT"]
    rows = [
        (f"borrower_{i % 5:03d}", [labels[i % 5], labels[(i // 5) % 5]], str(500 + i * 37 % 29500), str(1000 + i), (i * 31 % 46) * DAY + i)
        for i in range(300)
    ]
    got = borrower_features(facts(spark, rows)).orderBy("borrower_id").collect()
    assert [r.borrower_id for r in got] == [f"borrower_{i:03d}" for i in range(5)]
    for r in got:
        mine = [x for x in rows if x[0] == r.borrower_id]
        credit = [Decimal(x[2]) for x in mine if "BANK_CREDIT" in x[1] or "SALARY_CREDIT" in x[1]]
        assert (r.total_financial_sms_90d, r.count_credit_txn_90d, r.sum_credit_amount_90d) == (60, len(credit), sum(credit))
        assert r.last_known_balance == Decimal(min(mine, key=lambda x: x[4])[3])


def test_upsert_measures_use_bank_credit_alone(spark):
    got = upsert_features(facts(spark, [("b", S, "5", None, 0), ("b", C, "7", None, 0)]), AS_OF).first()
    assert (got.count_credit_txn_90d, got.sum_credit_amount_90d) == (1, Decimal("7.00"))


def test_merge(spark):
    stamp = F.lit("2020-01-01").cast("timestamp")
    first = upsert_features(facts(spark, [("old", C, "5", "1", 0), ("same", C, "1", None, 0)]), AS_OF)
    target = merge_features(empty_features(spark), first, stamp).withColumn("risk_flag", F.lit("HIGH"))
    update = upsert_features(facts(spark, [("old", E, "9", None, 0), ("new", X, None, None, 0)]), AS_OF)
    update = update.withColumn("sum_emi_amount_90d", F.when(F.col("borrower_id") != "old", F.col("sum_emi_amount_90d")))
    later = F.lit("2021-01-01").cast("timestamp")
    once = merge_features(target, update, later)
    got = {r.borrower_id: r for r in once.collect()}
    assert set(got) == {"old", "same", "new"}
    assert got["old"].sum_emi_amount_90d is None  # a null in the update overwrites
    assert (got["old"].count_emi_payment_90d, got["old"].count_credit_txn_90d, got["old"].risk_flag) == (1, 0, "HIGH")
    assert got["same"].sum_credit_amount_90d == Decimal("1.00") and got["same"].last_updated.year in (2019, 2020)
    assert (got["new"].count_debit_txn_90d, got["new"].max_single_credit_90d) == (0, Decimal("0.00"))
    assert got["new"].risk_flag is None and got["new"].last_known_balance is None
    assert sorted(merge_features(once, update, later).collect(), key=str) == sorted(once.collect(), key=str)


def test_upsert_generic(spark):
    target = spark.createDataFrame([("a", 1, 2)], "k string, x int, y int")
    updates = spark.createDataFrame([("a", None), ("b", 7)], "k string, x int")
    got = upsert(target, updates, "k", ["x"], {"y": 0}).collect()
    assert sorted(map(tuple, got), key=str) == [("a", None, 2), ("b", 7, 0)]


def test_not_yet_processed_ignores_null_ids(spark):
    raw = spark.createDataFrame([("a",), ("b",)], "raw_id string")
    done = spark.createDataFrame([("a",), (None,)], "raw_id string")
    assert [r.raw_id for r in not_yet_processed(raw, done).collect()] == ["b"]


def test_reports(spark):
    rows = [("a", "HIGH", Decimal(5)), ("b", "LOW", Decimal(9)), ("c", "LOW", Decimal(9))]
    df = spark.createDataFrame(rows, "borrower_id string, risk_flag string, sum_credit_amount_90d decimal(15,2)")
    assert [tuple(r) for r in risk_distribution(df).collect()] == [("LOW", 2, 66.7), ("HIGH", 1, 33.3)]
    assert [tuple(r) for r in avg_credit_by_risk(df).collect()] == [("LOW", 2, 9.0), ("HIGH", 1, 5.0)]
    assert [r.borrower_id for r in top_borrowers(df, 2).collect()] == ["b", "c"]


def test_wide_profile(spark):
    rows = [("b", ["SALARY_CREDIT"], "100", "50", DAY), ("b", D, "130", None, 2 * DAY), ("b", X, None, None, 0), ("b", X, None, None, 0),
            ("b", X, None, None, 0), ("b", ["LOAN_REMINDER"], None, "20", 0), ("b", ["LOAN_REMINDER"], None, None, 0)]
    df = facts(spark, rows).withColumns({
        "txn_hour": F.lit(1), "sender_tag": F.when(F.array_contains("categories", "LOAN_REMINDER"), "LENDER").otherwise("BANK"),
        "sender_hash": F.concat(F.lit("s"), F.col("balance").cast("string")),
    })
    got = score_profile(wide_profile(df, AS_OF)).first()
    assert (got.salary_detected, got.salary_credit_count, got.avg_salary_amount) == (True, 1, 100.0)
    assert (got.lender_count, got.loan_reminder_count, got.failed_txn_count, got.night_debit_count) == (1, 2, 3, 1)
    assert (got.monthly_credit_amount, got.monthly_debit_amount) == (Decimal("33.33"), Decimal("43.33"))
    assert (got.latest_balance_proxy, got.avg_balance_proxy, got.min_balance_proxy) == (Decimal(20), 35.0, Decimal(20))
    assert (got.risk_score, got.risk_flag) == (6, "HIGH")  # failed 2, reminders 2, debits over 120 % 2

"""Borrower features from classified messages."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_date, period_of
from ..functions.keys import DAY_MS
from ..rules import RISK_CREDIT_DROP, RISK_CUTS, RISK_MAX_LOANS, RISK_POINTS
from ..schemas import FEATURE_SCHEMA, MONEY, MONEY_SUM
from ..sources.settle import settle

# Borrowers whose latest time is broadcast.  The limit bounds the broadcast; a
# borrower outside it holds less than 1/HOT_BORROWERS of all rows.
HOT_BORROWERS = 10_000
LOOKBACK_DAYS = 90


def on_date(table: DataFrame, date: Column | str | None) -> DataFrame:
    """Rows of one date, ``None`` for those without one; a stored table is also cut to the month's partition."""
    if date is None:
        undated = [F.col(c).isNull() for c in ("txn_period", "txn_date") if c in table.columns]
        return table.where(reduce(and_, undated))
    day = F.lit(date).cast("date") if isinstance(date, str) else date
    if "txn_period" in table.columns:
        table = table.where(F.col("txn_period") == period_of(day))
    return table.where(F.col("txn_date") == day)


def in_lookback(classified: DataFrame, as_of: Column | str, days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """Rows dated from ``days`` before ``as_of`` up to ``as_of``; ``None`` keeps the whole history."""
    if days is None:
        return classified
    anchor = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    first = F.date_sub(anchor, days)
    if "txn_period" in classified.columns:
        classified = classified.where(F.col("txn_period").between(period_of(first), period_of(anchor)))
    return classified.where(F.col("txn_date").between(first, anchor))


def has(*labels: str) -> Column:
    """The message carries one of the labels."""
    test = F.array_contains("categories", labels[0])
    for label in labels[1:]:
        test = test | F.array_contains("categories", label)
    return test


def is_credit() -> Column:
    return has("BANK_CREDIT", "SALARY_CREDIT")


def is_debit() -> Column:
    return has("BANK_DEBIT", "UPI_PAYMENT")


def money_sum(flag: Column | None = None, value: str = "amount") -> Column:
    amount = F.col(value) if flag is None else F.when(flag, F.col(value))
    return F.coalesce(F.sum(amount), F.lit(0)).cast(MONEY_SUM)


def latest_known_balance() -> Column:
    """Balance of the newest row that has one; of rows in the same millisecond, the larger.

    Time and balance are packed into one decimal.  Unlike a struct it is a
    fixed-width aggregation buffer, so the whole aggregate stays a hash aggregate.
    """
    cents = (F.col("balance") * 100).cast("decimal(17,0)")
    order = F.col("inbox_time_ms").cast("decimal(19,0)") * F.lit(10**17).cast("decimal(18,0)") + cents
    return F.max_by("balance", F.when(F.col("balance").isNotNull(), order))


def _measures(with_ddl: bool) -> list[Column]:
    credit, debit = is_credit(), is_debit()
    loan, emi, bounce = has("LOAN_DISBURSEMENT"), has("EMI_PAYMENT"), has("FAILED_TRANSACTION")
    core = [
        F.count("*").alias("total_financial_sms_90d"),
        F.count_if(credit).alias("count_credit_txn_90d"),
        money_sum(credit).alias("sum_credit_amount_90d"),
        F.count_if(debit).alias("count_debit_txn_90d"),
        money_sum(debit).alias("sum_debit_amount_90d"),
        F.count_if(loan).alias("count_loan_disbursement_90d"),
        F.count_if(emi).alias("count_emi_payment_90d"),
        money_sum(emi).alias("sum_emi_amount_90d"),
        F.count_if(bounce).alias("count_bounce_txn_90d"),
        latest_known_balance().alias("last_known_balance"),
        F.min("inbox_time_ms").alias("_first_ms"),
        F.max("inbox_time_ms").alias("_last_ms"),
    ]
    declared = [
        F.max(F.when(credit, F.col("amount"))).alias("max_single_credit_90d"),
        F.count_if(has("SALARY_CREDIT")).alias("count_salary_credits_90d"),
        money_sum(loan).alias("sum_loan_disbursement_amount_90d"),
        F.count_if(has("LOAN_REMINDER")).alias("count_loan_reminders_90d"),
        F.min("balance").alias("min_balance_seen_90d"),
    ]
    return core + declared if with_ddl else core


def borrower_totals(classified: DataFrame, with_ddl: bool = False) -> DataFrame:
    """One row per borrower in one pass: partial hash aggregate, small shuffle, final aggregate."""
    totals = classified.where(F.col("borrower_id").isNotNull()).groupBy("borrower_id").agg(*_measures(with_ddl))
    totals = totals.withColumns(
        {"earliest_sms_date": epoch_date(F.col("_first_ms")), "latest_sms_date": epoch_date(F.col("_last_ms"))}
    )
    if with_ddl:
        ratio = F.try_divide(F.col("sum_emi_amount_90d").cast("double"), F.col("sum_credit_amount_90d").cast("double"))
        totals = totals.withColumns(
            {"foir_proxy_90d": ratio, "max_single_credit_90d": F.coalesce("max_single_credit_90d", F.lit(0).cast(MONEY))}
        )
    return totals


def credit_momentum(classified: DataFrame, totals: DataFrame) -> DataFrame:
    """Credits of a borrower's last 30 days over those of the 30 days before.

    Both windows end at the borrower's own latest message, which the rows do not
    know yet.  The latest times of the borrowers with most rows are broadcast, so
    their rows never move; only rows of the others, none of whom is large, are
    joined by a shuffle.  Ratio 1.0 where the divisor is not positive.
    """
    latest = totals.select("borrower_id", F.col("_last_ms").alias("latest_ms"), "total_financial_sms_90d")
    largest_first = latest.orderBy(F.desc("total_financial_sms_90d"), "borrower_id")
    hot = F.broadcast(largest_first.limit(HOT_BORROWERS).select("borrower_id", "latest_ms"))
    ticks = classified.where(F.col("borrower_id").isNotNull() & is_credit() & F.col("amount").isNotNull()).select(
        "borrower_id", "inbox_time_ms", "amount"
    )
    near = ticks.join(hot, "borrower_id")
    far = ticks.join(hot.select("borrower_id"), "borrower_id", "left_anti").join(
        latest.select("borrower_id", "latest_ms"), "borrower_id"
    )
    age = F.col("latest_ms") - F.col("inbox_time_ms")
    recent, earlier = age < 30 * DAY_MS, (age >= 30 * DAY_MS) & (age < 60 * DAY_MS)
    sums = near.unionByName(far).groupBy("borrower_id").agg(
        money_sum(recent).alias("credit_last_30d"), money_sum(earlier).alias("credit_prior_30d")
    )
    ratio = F.col("credit_last_30d").cast("double") / F.col("credit_prior_30d").cast("double")
    return sums.withColumn("credit_momentum", F.when(F.col("credit_prior_30d") > 0, ratio).otherwise(1.0))


def score_risk(features: DataFrame) -> DataFrame:
    """Add ``risk_score`` and ``risk_flag``.  The load test is kept exact: e/(c+1) > 1/2 is 2e > c+1."""
    points = lambda name, test: F.when(test, RISK_POINTS[name]).otherwise(0)
    score = (
        points("bounce", F.col("count_bounce_txn_90d") > 0)
        + points("loan_stacking", F.col("count_loan_disbursement_90d") > RISK_MAX_LOANS)
        + points("emi_load", 2 * F.col("sum_emi_amount_90d") > F.col("sum_credit_amount_90d") + 1)
        + points("credit_drop", F.col("credit_momentum") < RISK_CREDIT_DROP)
    )
    capped = F.least(score, F.lit(100)).cast("int")
    flag = F.when(F.col("risk_score") >= RISK_CUTS["HIGH"], "HIGH").when(F.col("risk_score") >= RISK_CUTS["MEDIUM"], "MEDIUM")
    return features.withColumn("risk_score", capped).withColumn("risk_flag", flag.otherwise("LOW"))


def borrower_features(
    classified: DataFrame, as_of: Column | str | None = None, lookback_days: int | None = None
) -> DataFrame:
    """Full feature row per borrower, with momentum, score and flag.

    Reads its input three times: pass a table (or a settled frame), not a plan that
    would classify the messages again for each reading.  The totals, one row per
    borrower, are written once, as the momentum reads them twice more.
    """
    rows = in_lookback(classified, as_of, lookback_days) if lookback_days is not None else classified
    totals = settle(borrower_totals(rows, with_ddl=True), "totals")
    momentum = credit_momentum(rows, totals).select("borrower_id", "credit_momentum")
    joined = totals.join(momentum, "borrower_id", "left").withColumn(
        "credit_momentum", F.coalesce("credit_momentum", F.lit(1.0))
    )
    names = [f.name for f in FEATURE_SCHEMA if f.name != "last_updated"]
    return score_risk(joined).select(*names)


def warehouse_features(classified: DataFrame, as_of: Column | str, lookback_days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """Lookback features without momentum and score: one pass, one shuffle."""
    totals = borrower_totals(in_lookback(classified, as_of, lookback_days))
    return totals.select(
        "borrower_id", "total_financial_sms_90d", "count_credit_txn_90d", "sum_credit_amount_90d",
        "count_debit_txn_90d", "sum_debit_amount_90d", "count_loan_disbursement_90d", "count_emi_payment_90d",
        "sum_emi_amount_90d", "count_bounce_txn_90d", "earliest_sms_date", "latest_sms_date", "last_known_balance",
    )


def upsert_features(classified: DataFrame, as_of: Column | str, lookback_days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """The six measures an upsert refreshes.  Credit here is BANK_CREDIT alone."""
    credit, emi = has("BANK_CREDIT"), has("EMI_PAYMENT")
    rows = in_lookback(classified, as_of, lookback_days).where(F.col("borrower_id").isNotNull())
    return rows.groupBy("borrower_id").agg(
        F.count("*").alias("total_financial_sms_90d"),
        F.count_if(credit).alias("count_credit_txn_90d"),
        money_sum(credit).alias("sum_credit_amount_90d"),
        F.count_if(emi).alias("count_emi_payment_90d"),
        money_sum(emi).alias("sum_emi_amount_90d"),
        F.count_if(has("FAILED_TRANSACTION")).alias("count_bounce_txn_90d"),
    )


def latest_balance(classified: DataFrame) -> DataFrame:
    known = classified.where(F.col("borrower_id").isNotNull() & F.col("balance").isNotNull())
    return known.groupBy("borrower_id").agg(latest_known_balance().alias("last_known_balance"))


def lookup(features: DataFrame, borrower_id: str) -> DataFrame:
    """Profile of one borrower; on a table sorted by the id the filter skips row groups."""
    return features.where(F.col("borrower_id") == borrower_id)

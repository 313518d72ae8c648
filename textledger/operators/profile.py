"""Wide borrower profile and its additive risk score.

These features were published by name, without formulas.  The definitions here:

* window: the ``lookback_days`` up to ``as_of``; "monthly" is the window's sum
  scaled to 30 days; credits and debits as in :mod:`.features`;
* ``lender_count``: different normalised senders tagged LENDER;
* night: UTC hours 0 to 5; alcohol: label ALCOHOL_SPEND;
* ``mom_credit_trend_pct``: credits of the last 30 days up to ``as_of`` against the
  30 days before, in percent; null when there were none before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sender_key
from ..rules import LENDER, PROFILE_RISK_CUTS, RuleSet, DEFAULT_RULES
from ..schemas import MONEY_SUM
from .classify import classify
from .features import LOOKBACK_DAYS, has, in_lookback, is_credit, is_debit, latest_known_balance, money_sum

NIGHT_HOURS = (0, 5)


def profile_input(raw: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Classified rows plus a hash of the sender, which the lender count needs."""
    return classify(raw, rules, extra=[F.sha2(sender_key(F.col("sms_sender")), 256).alias("sender_hash")])


def _average(flag: Column, value: str) -> Column:
    amount = F.when(flag, F.col(value))
    return F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))


def wide_profile(classified: DataFrame, as_of: str, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """One row per borrower in one aggregation (a second level for the distinct lenders)."""
    rows = in_lookback(classified, as_of, lookback_days).where(F.col("borrower_id").isNotNull())
    day = F.lit(as_of).cast("date")
    credit, debit, salary = is_credit(), is_debit(), has("SALARY_CREDIT")
    upi, emi, alcohol = has("UPI_PAYMENT"), has("EMI_PAYMENT"), has("ALCOHOL_SPEND")
    last30 = F.col("txn_date") > F.date_sub(day, 30)
    prior30 = (F.col("txn_date") <= F.date_sub(day, 30)) & (F.col("txn_date") > F.date_sub(day, 60))
    any_row = F.lit(True)
    profile = rows.groupBy("borrower_id").agg(
        F.count_if(salary).alias("salary_credit_count"),
        _average(salary, "amount").alias("avg_salary_amount"),
        F.max(F.when(salary, F.col("txn_date"))).alias("last_salary_date"),
        money_sum(credit).alias("_credit"),
        money_sum(debit).alias("_debit"),
        _average(credit, "amount").alias("avg_credit_amount"),
        F.max(F.when(debit, F.col("amount"))).alias("max_single_debit"),
        F.count_if(upi).alias("upi_txn_count"),
        money_sum(upi).alias("upi_total_amount"),
        F.count_if(emi).alias("emi_count"),
        money_sum(emi).alias("total_emi_amount"),
        F.count_distinct(F.when(F.col("sender_tag") == LENDER, F.col("sender_hash"))).alias("lender_count"),
        F.count_if(has("LOAN_REMINDER")).alias("loan_reminder_count"),
        F.count_if(has("LOAN_DISBURSEMENT")).alias("loan_disbursement_count"),
        latest_known_balance().alias("latest_balance_proxy"),
        _average(any_row, "balance").alias("avg_balance_proxy"),
        F.min("balance").alias("min_balance_proxy"),
        F.count_if(alcohol).alias("alcohol_txn_count"),
        money_sum(alcohol).alias("alcohol_spend_amount"),
        F.count_if(debit & F.col("txn_hour").between(*NIGHT_HOURS)).alias("night_debit_count"),
        F.count_if(has("FAILED_TRANSACTION")).alias("failed_txn_count"),
        money_sum(credit & last30).alias("_recent"),
        money_sum(credit & prior30).alias("_prior"),
    )
    monthly = lambda name: F.round(F.col(name) * 30 / lookback_days, 2).cast(MONEY_SUM)
    recent, prior = F.col("_recent").cast("double"), F.col("_prior").cast("double")
    return profile.withColumns(
        {
            "salary_detected": F.col("salary_credit_count") > 0,
            "monthly_credit_amount": monthly("_credit"),
            "monthly_debit_amount": monthly("_debit"),
            "mom_credit_trend_pct": F.when(F.col("_prior") > 0, 100.0 * (recent - prior) / prior),
            "feature_date": day,
            "lookback_days": F.lit(lookback_days).cast("smallint"),
        }
    ).drop("_recent", "_prior")


def score_profile(profile: DataFrame) -> DataFrame:
    """Add ``risk_score`` and ``risk_flag``: the sum of six signals, cut at 5 and 2."""
    points = lambda n, test: F.when(test, n).otherwise(0)
    score = (
        points(2, F.col("failed_txn_count") >= 3)
        + points(2, F.col("loan_reminder_count") >= 2)
        + points(2, 5 * F.col("_debit") > 6 * F.col("_credit"))
        + points(1, F.col("lender_count") >= 4)
        + points(1, ~F.col("salary_detected"))
        + points(1, F.col("alcohol_txn_count") >= 5)
    )
    flag = F.when(F.col("risk_score") >= PROFILE_RISK_CUTS["HIGH"], "HIGH").when(
        F.col("risk_score") >= PROFILE_RISK_CUTS["MEDIUM"], "MEDIUM"
    )
    scored = profile.withColumn("risk_score", score.cast("smallint")).withColumn("risk_flag", flag.otherwise("LOW"))
    return scored.drop("_credit", "_debit")

"""Explicit schemas.  Nothing is inferred: an all-digit sender must stay text."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
# A sum of up to 10**10 such values fits.
MONEY_SUM = T.DecimalType(25, 2)

RAW_INPUT = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField("sms_sender", T.StringType()),
        T.StructField("sms_body", T.StringType()),
        T.StructField("inbox_time_in_millis", T.LongType()),
    ]
)

# input name -> name used by every operator
RENAMES = {"customer_id": "borrower_id", "inbox_time_in_millis": "inbox_time_ms"}

RAW = T.StructType(
    [
        T.StructField("raw_id", T.StringType(), False),
        T.StructField("borrower_id", T.StringType()),
        T.StructField("sms_sender", T.StringType()),
        T.StructField("sender_tag", T.StringType()),
        T.StructField("sms_body", T.StringType()),
        T.StructField("inbox_time_ms", T.LongType()),
        T.StructField("collected_at", T.TimestampType()),
        T.StructField("pipeline_run_id", T.StringType()),
        T.StructField("txn_date", T.DateType()),
        T.StructField("dedup_key", T.StringType()),
    ]
)

# Tables on disk are partitioned by the first day of the month.  An upload can
# carry years of inbox; by day it would touch thousands of folders.
PERIOD = T.StructField("txn_period", T.DateType())

CLASSIFIED = T.StructType(
    [
        T.StructField("raw_id", T.StringType()),
        T.StructField("borrower_id", T.StringType()),
        T.StructField("sender_tag", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("sms_body", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("balance", MONEY),
        T.StructField("txn_year", T.IntegerType()),
        T.StructField("txn_month", T.IntegerType()),
        T.StructField("txn_date", T.DateType()),
        T.StructField("txn_hour", T.IntegerType()),
        T.StructField("inbox_time_ms", T.LongType()),
    ]
)

# Feature table: name, type, value a new key gets in columns an upsert leaves out.
FEATURES: tuple[tuple[str, T.DataType, int | None], ...] = (
    ("borrower_id", T.StringType(), None),
    ("total_financial_sms_90d", T.LongType(), 0),
    ("earliest_sms_date", T.DateType(), None),
    ("latest_sms_date", T.DateType(), None),
    ("count_credit_txn_90d", T.LongType(), 0),
    ("sum_credit_amount_90d", MONEY_SUM, 0),
    ("max_single_credit_90d", MONEY, 0),
    ("count_salary_credits_90d", T.LongType(), 0),
    ("count_debit_txn_90d", T.LongType(), 0),
    ("sum_debit_amount_90d", MONEY_SUM, 0),
    ("count_loan_disbursement_90d", T.LongType(), 0),
    ("sum_loan_disbursement_amount_90d", MONEY_SUM, 0),
    ("count_emi_payment_90d", T.LongType(), 0),
    ("sum_emi_amount_90d", MONEY_SUM, 0),
    ("count_bounce_txn_90d", T.LongType(), 0),
    ("count_loan_reminders_90d", T.LongType(), 0),
    ("last_known_balance", MONEY, None),
    ("min_balance_seen_90d", MONEY, None),
    ("foir_proxy_90d", T.DoubleType(), None),
    ("credit_momentum", T.DoubleType(), None),
    ("risk_score", T.IntegerType(), None),
    ("risk_flag", T.StringType(), None),
    ("last_updated", T.TimestampType(), None),
)
FEATURE_SCHEMA = T.StructType([T.StructField(n, t) for n, t, _ in FEATURES])
FEATURE_DEFAULTS = {n: d for n, _, d in FEATURES if d is not None}

# Sums per borrower and UTC day, and credits per millisecond: see operators/partials.py.
PARTIALS = T.StructType(
    [
        T.StructField("borrower_id", T.StringType()),
        T.StructField("txn_date", T.DateType()),
        T.StructField("messages", T.LongType()),
        T.StructField("credits", T.LongType()),
        T.StructField("credit_sum", MONEY_SUM),
        T.StructField("credit_max", MONEY),
        T.StructField("bank_credits", T.LongType()),
        T.StructField("bank_credit_sum", MONEY_SUM),
        T.StructField("salaries", T.LongType()),
        T.StructField("debits", T.LongType()),
        T.StructField("debit_sum", MONEY_SUM),
        T.StructField("loans", T.LongType()),
        T.StructField("loan_sum", MONEY_SUM),
        T.StructField("emis", T.LongType()),
        T.StructField("emi_sum", MONEY_SUM),
        T.StructField("bounces", T.LongType()),
        T.StructField("reminders", T.LongType()),
        T.StructField("balance_min", MONEY),
        T.StructField("balance_last", MONEY),
        T.StructField("balance_order", T.DecimalType(38, 0)),
        T.StructField("first_ms", T.LongType()),
        T.StructField("last_ms", T.LongType()),
    ]
)
INSTANTS = T.StructType(
    [
        T.StructField("borrower_id", T.StringType()),
        T.StructField("txn_date", T.DateType()),
        T.StructField("inbox_time_ms", T.LongType()),
        T.StructField("credit", MONEY_SUM),
    ]
)

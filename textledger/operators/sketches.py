"""How many different senders a borrower has, from what is kept per day and can be merged over any window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import LENDER
from .features import LOOKBACK_DAYS, in_lookback

#: Registers of a sketch as a power of two: 4,096 of them have a standard error of about 1.6 %.
LOG_REGISTERS = 12
KEYS = ("borrower_id", "txn_date")


def _lenders(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("borrower_id").isNotNull() & (F.col("sender_tag") == LENDER) & F.col("sender_hash").isNotNull())


def daily_lenders(rows: DataFrame) -> DataFrame:
    """(borrower_id, txn_date, sender_hash), once each: exact, a row per sender of a day. ``rows`` are those of ``profile_input``."""
    return _lenders(rows).select(*KEYS, "sender_hash").distinct()


def daily_lender_sketches(rows: DataFrame) -> DataFrame:
    """(borrower_id, txn_date, lenders): one sketch of bounded size per borrower and day, however many senders it has."""
    return _lenders(rows).groupBy(*KEYS).agg(F.hll_sketch_agg("sender_hash", LOG_REGISTERS).alias("lenders"))


def lender_counts(days: DataFrame, as_of: Column | str | None = None, lookback_days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """(borrower_id, lender_count) over a window, of either form of the daily table.

    The count of a sketch is an estimate; those of a window's days are merged, so no day is counted twice.
    """
    window = in_lookback(days, as_of, lookback_days)
    if "lenders" in window.columns:
        merged = window.groupBy("borrower_id").agg(F.hll_union_agg("lenders").alias("lenders"))
        return merged.select("borrower_id", F.hll_sketch_estimate("lenders").alias("lender_count"))
    # Two levels: a sender that a borrower has on many days moves once per task.
    once = window.select("borrower_id", "sender_hash").distinct()
    return once.groupBy("borrower_id").agg(F.count("*").alias("lender_count"))

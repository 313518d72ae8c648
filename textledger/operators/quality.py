"""Count reconciliation and constraint checks.  Each returns the findings as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import on_date


def delta_status(delta: Column) -> Column:
    return F.when(delta == 0, "OK").when(delta > 0, "DUPLICATE").otherwise("MISSING")


def reconcile_counts(device: DataFrame, ingested: DataFrame, key: str = "customer_id") -> DataFrame:
    """Device against ingested counts per borrower.

    Both tables are tagged, stacked and counted in one aggregation.  That gives
    the result of counting each and joining in full, with one shuffle of partial
    counts instead of two and a join.
    """
    one, zero = F.lit(1), F.lit(0)
    both = device.select(key, one.alias("d"), zero.alias("i")).unionByName(
        ingested.select(key, zero.alias("d"), one.alias("i"))
    )
    counts = both.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum("d").alias("device_count"), F.sum("i").alias("ingested_count")
    )
    delta = F.col("ingested_count") - F.col("device_count")
    return counts.withColumn("delta", delta).withColumn("status", delta_status(F.col("delta")))


def daily_counts(messages: DataFrame, run_date: Column | str | None = None) -> DataFrame:
    """Messages per borrower and date; with ``run_date`` that date alone (a partition filter)."""
    if run_date is not None:
        messages = on_date(messages, run_date)
    return messages.where(F.col("borrower_id").isNotNull()).groupBy("borrower_id", "txn_date").agg(
        F.count("*").alias("sms_count")
    )


def count_discrepancies(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str] = ("borrower_id",), tolerance_pct: int = 5
) -> DataFrame:
    """Keys whose count is off by more than the tolerance.

    ``actual (*keys, actual)`` and ``expected (*keys, expected)`` hold one row per
    key; a key missing on one side counts as 0 there.  Whole numbers throughout, so
    exactly 5 % passes.
    """
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    joined = actual.where(known).join(expected.where(known), list(keys), "full_outer")
    filled = joined.select(
        *keys,
        F.coalesce("expected", F.lit(0)).cast("bigint").alias("expected"),
        F.coalesce("actual", F.lit(0)).cast("bigint").alias("actual"),
    )
    return filled.where(100 * F.abs(F.col("actual") - F.col("expected")) > tolerance_pct * F.col("expected"))


def payload_mismatches(payloads: DataFrame) -> DataFrame:
    """Nested uploads ``(payload_id, expected, messages array)`` that hold another number of messages than announced."""
    sized = payloads.withColumn("received", F.coalesce(F.size("messages"), F.lit(0)).cast("bigint"))
    return sized.where(~F.col("received").eqNullSafe(F.col("expected"))).select("payload_id", "expected", "received")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(check, violations) for each column that must not be null, in one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(f"not_null:{c}").alias("check"), F.col(c).alias("violations")) for c in columns]
    return counted.select(F.inline(F.array(*pairs)))


def unique_violations(df: DataFrame, key: str) -> DataFrame:
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return repeated.agg(F.count("*").alias("violations")).select(F.lit(f"unique:{key}").alias("check"), "violations")


def reference_violations(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    keys = parent.select(F.col(parent_key).alias(column))
    # Counted by key first: a key moves once per task, not once per row.
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    orphans = counted.join(keys, column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(F.lit(f"reference:{column}").alias("check"), "violations")


def constraint_report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)

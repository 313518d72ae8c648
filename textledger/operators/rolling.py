"""Credits of a borrower in the days up to each message."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import DAY_MS
from ..schemas import MONEY_SUM
from ..sources.settle import settle
from .features import is_credit


def rolling_credit(classified: DataFrame, days: Sequence[int] = (30, 60)) -> DataFrame:
    """(raw_id, borrower_id, inbox_time_ms, amount, credit_<n>d, ...): a row per credit with an amount and a time.

    ``credit_<n>d`` sums the borrower's credits with a time in (t - n days, t], messages of the same millisecond included.

    A range frame over a borrower's messages would put each borrower in one task. Here a window is whole days, from sums per
    day, and what it takes of its first and its last day: within a day, messages of that day come in and messages of the day n days before
    go out as the time goes on. So frames run over one day of a borrower, and over one row per day of it.

    Credits are read once for themselves, once for each length of a window and once for the sums per day, so they are written first.
    """
    found = classified.where(
        F.col("borrower_id").isNotNull() & is_credit() & F.col("amount").isNotNull() & F.col("inbox_time_ms").isNotNull()
    ).select("raw_id", "borrower_id", "inbox_time_ms", "amount", F.floor(F.col("inbox_time_ms") / DAY_MS).cast("long").alias("_day"))
    credits = settle(found, "credits")
    names = [f"credit_{n}d" for n in days]
    nothing = F.lit(None).cast(credits.schema["amount"].dataType)

    def leaving(n: int) -> DataFrame:
        gone = [(F.col("amount") if m == n else nothing).alias(f"_gone_{m}") for m in days]
        return credits.select(F.lit(None).cast("string").alias("raw_id"), "borrower_id", (F.col("inbox_time_ms") + n * DAY_MS).alias("inbox_time_ms"),
                              nothing.alias("amount"), (F.col("_day") + n).alias("_day"), *gone)

    own = credits.select("raw_id", "borrower_id", "inbox_time_ms", "amount", "_day", *[nothing.alias(f"_gone_{n}") for n in days])
    events = reduce(DataFrame.unionByName, map(leaving, days), own)
    so_far = Window.partitionBy("borrower_id", "_day").orderBy("inbox_time_ms").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    total = lambda c: F.coalesce(F.sum(c).over(so_far), F.lit(0)).cast(MONEY_SUM)
    within = events.select("raw_id", "borrower_id", "inbox_time_ms", "amount", "_day", *[(total("amount") - total(f"_gone_{n}")).alias(f"_in_{n}") for n in days])
    sums = credits.groupBy("borrower_id", "_day").agg(F.sum("amount").alias("_sum"))
    by_day = Window.partitionBy("borrower_id").orderBy("_day")
    before = sums.select(F.col("borrower_id").alias("_b"), F.col("_day").alias("_d"), *[
        F.coalesce(F.sum("_sum").over(by_day.rangeBetween(-n, -1)), F.lit(0)).cast(MONEY_SUM).alias(f"_before_{n}") for n in days])
    mine = within.where(F.col("amount").isNotNull())
    met = mine.join(before, (F.col("borrower_id") == F.col("_b")) & (F.col("_day") == F.col("_d")))
    rolled = [(F.col(f"_in_{n}") + F.col(f"_before_{n}")).cast(MONEY_SUM).alias(name) for n, name in zip(days, names, strict=True)]
    return met.select("raw_id", "borrower_id", "inbox_time_ms", "amount", *rolled)

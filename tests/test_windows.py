"""The window of queries that look back a year."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from textledger.plans import registry


@pytest.fixture(scope="module")
def year_old(spark, tmp_path_factory):
    """One credit of a borrower 200 days before each of the two dates as of which queries run."""
    base = str(tmp_path_factory.mktemp("year"))
    days = [str(date.fromisoformat(d) - timedelta(days=200)) for d in (registry.AS_OF, registry.CUT)]
    rows = [(24, 4, 7 + i, 1, 100.0, d) for i, d in enumerate(days)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, day string")
    lines.withColumn("l_shipdate", F.col("day").cast("timestamp_ntz")).drop("day").coalesce(1).write.parquet(f"{base}/lineitem.parquet")
    return base


@pytest.mark.parametrize(
    ("name", "borrower"),
    [("risk_score", "B000007"), ("profile_wide", "B000007"), ("profile_wide_past", "B000008"), ("profile_risk", "B000007"),
     ("stream_feature_refresh", "B000007")],
)
def test_a_message_of_200_days_ago_counts(spark, year_old, name, borrower):
    found = registry.queries()[name](spark, year_old).collect()
    assert [r.borrower_id for r in found] == [borrower]

"""What the plans must look like, whatever the data."""

import re

import pytest
from pyspark.sql import functions as F
from test_classify import SAMPLES, messages

from textledger.operators.classify import classify, classify_deduplicated, label_messages, to_raw
from textledger.operators.dedup import dedup_messages
from textledger.operators.features import borrower_totals, credit_momentum, warehouse_features
from textledger.operators.quality import reconcile_counts
from textledger.operators.reports import top_borrowers
from textledger.sources.settle import settle


@pytest.fixture(scope="module")
def raw(spark):
    """A raw table of several files."""
    return settle(to_raw(messages(spark, SAMPLES)).repartition(3), "plan-raw")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def method_sizes(spark, df):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = spark.createDataFrame([], df.schema) if df is None else df
        text = spark._jvm.PythonSQLUtils.explainString(again._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_classification_is_one_stage_in_one_codegen_span(spark, raw):
    text = plan(classify(raw))
    assert "Exchange" not in text and "Python" not in text and "Join" not in text
    sizes = method_sizes(spark, classify(raw))
    # Methods over 8000 bytes are never JIT-compiled.
    assert len(sizes) == 1 and sizes[0] < 8000


def test_expensive_inputs_are_evaluated_once(raw):
    optimized = label_messages(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("lower(sms_body") == 1
    assert optimized.count("lower(sms_sender") == 1
    assert optimized.count("Contains(") < 130


def test_filters_stand_in_order_below_extraction(raw):
    text = plan(classify(raw))
    order = [text.index(part) for part in ("regexp_replace", "regexp_extract", "size(categories", "Contains(", "sender_tag#", "FileScan")]
    assert order[0] < order[1] < order[2]
    assert text.index("size(categories") < text.index("FileScan")


def test_unused_columns_are_not_read(raw):
    text = plan(label_messages(raw).groupBy("sender_tag").count())
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert schema == "struct<sms_sender:string,sms_body:string>"


def test_lookback_reaches_the_scan(raw):
    facts = settle(classify(raw), "plan-facts")
    text = plan(warehouse_features(facts, "2023-12-01"))
    assert "GreaterThanOrEqual(txn_date,2023-09-02)" in text


def test_feature_totals_are_one_hash_aggregation(raw):
    facts = settle(classify(raw), "plan-facts")
    text = plan(borrower_totals(facts, with_ddl=True))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text and "ObjectHash" not in text and "Window" not in text
    assert text.count("FileScan") == 1


def test_momentum_broadcasts_only_the_limited_side(raw):
    facts = settle(classify(raw), "plan-facts")
    totals = settle(borrower_totals(facts), "plan-totals")
    # Without automatic broadcasts, what is left must be below the limit.
    spark = raw.sparkSession
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(credit_momentum(facts, totals))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    broadcasts = text.count("BroadcastExchange")
    assert broadcasts == text.count("TakeOrderedAndProject(limit=10000") > 0
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_dedup_keeps_one_row_per_key_before_the_shuffle(raw):
    text = plan(dedup_messages(raw))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1
    below = text[text.index("Exchange hashpartitioning"):]
    assert "Partial" in below


def test_deduplicated_classification_shuffles_no_rejected_text(raw):
    text = plan(classify_deduplicated(raw))
    exchange = text[text.index("Exchange hashpartitioning"):]
    assert text.count("Exchange") == 1
    # Only the masked text crosses the exchange, and rejected messages have none.
    narrow = next(line for line in exchange.splitlines() if "Project" in line)
    assert "_clean" in narrow and "sms_body#" not in narrow.split("_clean")[0]
    assert all(n < 8000 for n in method_sizes(raw.sparkSession, classify_deduplicated(raw)))


def test_reconcile_has_one_shuffle_and_no_join(raw):
    text = plan(reconcile_counts(raw, raw, key="borrower_id"))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_top_k_needs_no_global_sort(spark):
    df = spark.range(50).select(
        F.col("id").cast("string").alias("borrower_id"), F.col("id").cast("decimal(15,2)").alias("sum_credit_amount_90d"), F.lit("LOW").alias("risk_flag")
    )
    text = plan(top_borrowers(df))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text

"""What moves between tasks and what is stored: no hash in hex moves, and stored tables are coded."""

import re

import pytest
from pyspark.sql import functions as F
from test_classify import SAMPLES, messages

from textledger.functions import mask_accounts, packed, unpacked
from textledger.operators.classify import to_raw
from textledger.plans import inputs, jobs
from textledger.sources.messages import land_raw, read_raw
from textledger.sources.sinks import BUCKET_ROWS, buckets_for


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_packed_hashes_come_back_and_keep_their_order(spark):
    df = to_raw(messages(spark, SAMPLES))
    assert df.where(unpacked(packed(F.col("raw_id"))) != F.col("raw_id")).count() == 0
    by_text = [r.raw_id for r in df.orderBy("raw_id").collect()]
    assert by_text == [r.raw_id for r in df.orderBy(packed(F.col("raw_id"))).collect()]


@pytest.mark.parametrize("dedup", [False, True])
def test_landing_gives_the_same_rows_with_its_hashes_made_last(spark, tmp_path, dedup):
    rows = [*SAMPLES, SAMPLES[0], ("north1", "kotakb", "another text", SAMPLES[0][3]), ("u", "kotakb", "untimed", None), ("u", "kotakb", "untimed", None)]
    path = str(tmp_path / "raw")
    written = land_raw(messages(spark, rows), path, "r", mode="overwrite", dedup=dedup)
    got = read_raw(spark, path)
    wanted = to_raw(messages(spark, rows))
    if dedup:
        wanted = wanted.groupBy("borrower_id", "inbox_time_ms", F.when(F.col("inbox_time_ms").isNull(), F.col("raw_id"))).agg(F.min("raw_id").alias("raw_id"))
    assert sorted(r.raw_id for r in got.collect()) == sorted(r.raw_id for r in wanted.collect())
    assert written == got.count() == (7 if dedup else len(rows))
    assert all(len(r.dedup_key) == 64 for r in got.collect())
    assert [p for p in (tmp_path / "raw").rglob("*.parquet")] and all(".zstd." in p.name for p in (tmp_path / "raw").rglob("*.parquet"))


def test_markers_move_without_their_key_in_hex(spark):
    text = plan(jobs._markers(to_raw(messages(spark, SAMPLES)), None))
    first = text[text.rindex("Exchange hashpartitioning("):].splitlines()[0]
    assert "message_key" not in first and "inbox_time_ms" in first


def test_buckets_follow_the_rows():
    assert buckets_for(0) == buckets_for(8 * BUCKET_ROWS) == 8
    assert buckets_for(216_000_000) == 864


def test_derived_bodies_equal_those_made_by_replacing_fields(spark):
    rows = [(o, p, 7, n, c) for o in range(1, 40) for p, n in ((4, 1), (998, 2), (499, 1)) for c in (1234.5, 99.07, None)] + [(None, 1, 7, 1, 5.0), (1, None, 7, 1, 5.0), (-40, 3, 7, 1, 5.0)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double")
    lines.withColumn("l_shipdate", F.lit("2001-01-01").cast("timestamp_ntz")).createOrReplaceTempView("_test_lines")
    joined = inputs.messages_sql(True, "_test_lines")
    assert inputs._joined_body() in joined and "replace(CASE" not in joined
    replaced = spark.sql(joined.replace(inputs._joined_body(), inputs._replaced_body()))
    mine = spark.sql(joined)
    assert mine.exceptAll(replaced).count() == replaced.exceptAll(mine).count() == 0
    assert mine.where("sms_body is not null").count() > 200


def test_masking_looks_at_a_run_once(spark):
    runs = ["1" * n + tail for n in range(22) for tail in ("", " 1", "a", "\n123456")] + ["_123456", "123456 1234567 12345678901234567890"]
    got = [r.m for r in spark.createDataFrame(list(enumerate(runs)), "i int, s string").orderBy("i").select(mask_accounts(F.col("s")).alias("m")).collect()]
    wanted = [re.sub(r"(?<!\w)\d{6,18}(?!\w)", lambda m: "X" * (len(m[0]) - 4) + m[0][-4:], r) for r in runs]
    assert got == wanted
    from textledger.functions import text

    assert r"\G" in text._LEADING_DIGIT

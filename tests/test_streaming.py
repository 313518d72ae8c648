from pyspark.sql import functions as F
from test_classify import SAMPLES, messages
from test_features import AS_OF, C, E, FACTS, facts

from textledger.operators.classify import classify, to_raw
from textledger.operators.merge import empty_features
from textledger.schemas import CLASSIFIED, RAW_INPUT
from textledger.sources.messages import read_raw
from textledger.sources.settle import settle
from textledger.streaming.jobs import (
    classify_stream, daily_counts_stream, dedup_stream, drain_batches, drain_to_parquet, land_stream,
    refresh_features,
)

DAY = 86_400_000


def test_stream_equals_batch_and_a_rerun_adds_only_new_files(spark, tmp_path):
    src, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    messages(spark, SAMPLES[:3]).write.parquet(src)
    run = lambda: drain_to_parquet(classify_stream(spark.readStream.schema(RAW_INPUT).parquet(src)), out, offsets)
    run()
    run()
    read = lambda: spark.read.schema(CLASSIFIED).parquet(out)
    assert read().count() == 2
    messages(spark, SAMPLES[3:]).write.mode("append").parquet(src)
    run()
    batch = classify(to_raw(messages(spark, SAMPLES)))
    assert read().exceptAll(batch).count() == 0 and batch.exceptAll(read()).count() == 0


def test_stream_dedup_across_batches(spark, tmp_path):
    src, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    rows = [("a", "s", "x", DAY), ("a", "s", "y", DAY), ("a", "s", "x", DAY + 1), ("b", "s", "x", None)]
    for part in (rows, rows):
        messages(spark, part).write.mode("append").parquet(src)
        stream = dedup_stream(spark.readStream.schema(RAW_INPUT).parquet(src), keep_untimed=False)
        drain_to_parquet(stream.select("customer_id", "inbox_time_in_millis"), out, offsets)
    got = [tuple(r) for r in spark.read.parquet(out).orderBy("inbox_time_in_millis").collect()]
    assert got == [("a", DAY), ("a", DAY + 1)]


def test_stream_dedup_can_keep_messages_without_a_time(spark, tmp_path):
    src, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    messages(spark, [("a", "s", "x", DAY), ("a", "s", "y", DAY), ("b", "s", "x", None), ("b", "s", "y", 0)]).write.parquet(src)
    stream = dedup_stream(spark.readStream.schema(RAW_INPUT).parquet(src))
    drain_to_parquet(stream.select("customer_id", "inbox_time_in_millis"), out, offsets)
    assert sorted((r[0], r[1] or 0) for r in spark.read.parquet(out).collect()) == [("a", DAY), ("b", 0), ("b", 0)]


def test_landing_a_stream_twice(spark, tmp_path):
    src, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    messages(spark, SAMPLES).write.parquet(src)
    for run in ("r1", "r2"):
        land_stream(spark.readStream.schema(RAW_INPUT).parquet(src), out, offsets, run)
    table = read_raw(spark, out)
    assert table.count() == len(SAMPLES) and {r[0] for r in table.select("pipeline_run_id").collect()} == {"r1"}
    assert table.where("dedup_key IS NULL OR sender_tag IS NULL").count() == 0


def test_daily_counts_wait_for_the_watermark(spark, tmp_path):
    src, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    rows = [("a", d * DAY + 5) for d in (1, 1, 2, 9)]
    spark.createDataFrame(rows, "k string, ms long").write.parquet(src)
    stream = spark.readStream.schema("k string, ms long").parquet(src).withColumn("t", F.timestamp_millis("ms"))
    drain_to_parquet(daily_counts_stream(stream, "t", "k"), out, offsets)
    got = spark.read.parquet(out).select("k", F.unix_millis("day_start").alias("d"), "sms_count").collect()
    assert sorted(map(tuple, got)) == [("a", DAY, 2), ("a", 2 * DAY, 1)]


def test_feature_refresh_over_two_batches(spark, tmp_path):
    src, table, offsets = (str(tmp_path / n) for n in ("in", "table", "offsets"))
    state = {"f": empty_features(spark)}

    def keep(df, batch_id):
        state["f"] = settle(df, f"test-{batch_id}")

    refresh = refresh_features(lambda: spark.read.parquet(table), lambda: state["f"], keep, AS_OF, 90)

    def land(batch, batch_id):
        folder = f"{table}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        refresh(spark.read.parquet(folder), batch_id)
        refresh(spark.read.parquet(folder), batch_id)  # a replay changes nothing

    for rows in ([("a", C, "5", None, 0), ("b", E, "2", None, 0)], [("a", C, "7", None, 0)]):
        facts(spark, rows).write.mode("append").parquet(src)
        drain_batches(spark.readStream.schema(FACTS).parquet(src), land, offsets)
    got = {r.borrower_id: (r.total_financial_sms_90d, r.sum_credit_amount_90d, r.count_debit_txn_90d) for r in state["f"].collect()}
    assert got == {"a": (2, 12, 0), "b": (1, 0, 0)}

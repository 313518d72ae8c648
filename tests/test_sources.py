import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_classify import SAMPLES, messages

from textledger.operators.classify import classify, to_raw
from textledger.operators.features import lookup
from textledger.sources.messages import classify_increment, land_raw, landed, pending, read_messages_csv, read_raw
from textledger.sources.settle import fresh_path, settle, shared_dir
from textledger.sources.sinks import (
    append_classified, create_external_table, flatten_for_sink, parse_categories, publish_snapshot, read_classified,
    read_markers, replace_classified, write_features,
)


def test_csv_with_quotes_line_breaks_and_digit_senders(spark, tmp_path):
    file = tmp_path / "in.csv"
    file.write_text(
        "customer_id,hash,sms_sender,sms_body,inbox_time_in_millis\n"
        'a,h,620016,"line one\nline ""two"" ₹5",1688212340000\n'
        "b,h,,plain,\n"
        "c,h,hdfcbk,bad,notanumber\n"
    )
    rows = {r.customer_id: r for r in read_messages_csv(spark, str(file), keep_corrupt=True).collect()}
    assert rows["a"].sms_sender == "620016" and rows["a"].sms_body == 'line one\nline "two" ₹5'
    assert rows["b"].sms_sender is None and rows["b"].inbox_time_in_millis is None
    assert rows["c"]._corrupt_record and not rows["a"]._corrupt_record
    assert read_messages_csv(spark, str(file)).columns[-1] == "inbox_time_in_millis"


def test_landing_keeps_sender_and_tag_and_counts(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert land_raw(messages(spark, SAMPLES), path, "r1") == 6
    assert land_raw(messages(spark, SAMPLES[:1]), path, "r2") == 1
    raw = read_raw(spark, path)
    assert raw.count() == 7
    row = raw.where("pipeline_run_id = 'r2'").first()
    assert (row.sms_sender, row.sender_tag, str(row.txn_date), str(row.txn_period)) == ("hdfcbk", "BANK", "2023-07-01", "2023-07-01")
    plan = pending(raw, "2023-07-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_period" in plan and "DataFilters: [isnotnull(txn_date" in plan
    fixed = landed(messages(spark, SAMPLES), "r", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert fixed.select("collected_at").distinct().count() == 1


def test_increment_adds_nothing_twice(spark, tmp_path):
    raw, done, marks = (str(tmp_path / n) for n in ("raw", "classified", "marks"))
    land_raw(messages(spark, [*SAMPLES, SAMPLES[0]]), raw, "r1")
    assert classify_increment(spark, raw, done, marks, "2023-07-01") == 4
    assert classify_increment(spark, raw, done, marks, "2023-07-01") == 0
    assert pending(read_raw(spark, raw), "2023-07-01", read_markers(spark, marks)).count() == 0  # rejected ones too
    late = [("z", "hdfcbk", "Rs.1 debited", 1688212349000)]
    land_raw(messages(spark, late), raw, "r2")
    assert classify_increment(spark, raw, done, marks, "2023-07-01") == 1
    assert classify_increment(spark, raw, done, marks, "2024-07-01") == 1
    got = read_classified(spark, done)
    assert got.count() == 6 and got.select("raw_id").distinct().count() == 6


def test_increment_after_a_crash_before_the_marker(spark, tmp_path):
    raw, done, marks = (str(tmp_path / n) for n in ("raw", "classified", "marks"))
    land_raw(messages(spark, SAMPLES), raw, "r1")
    append_classified(classify(read_raw(spark, raw).where("txn_date = '2023-07-01'")), done)
    assert classify_increment(spark, raw, done, marks, "2023-07-01") == 0
    assert read_classified(spark, done).count() == 4


def test_full_refresh_and_sink_types(spark, tmp_path):
    path = str(tmp_path / "classified")
    rows = classify(to_raw(messages(spark, SAMPLES)))
    assert replace_classified(rows, path) == replace_classified(rows, path) == 5
    assert read_classified(spark, path).count() == 5
    with_null = rows.unionByName(rows.limit(1).withColumns({"txn_date": F.lit(None).cast("date"), "raw_id": F.lit("n")}))
    flat = flatten_for_sink(with_null)
    assert dict(flat.dtypes)["categories"] == dict(flat.dtypes)["txn_date"] == "string"
    nulls = flat.where("raw_id = 'n'").first()
    assert nulls.txn_date is None and nulls.categories.startswith('["')
    assert parse_categories(flat).exceptAll(with_null.withColumn("txn_date", F.col("txn_date").cast("string"))).count() == 0


def test_feature_files_lookup_snapshot_and_external_table(spark, tmp_path):
    features = spark.createDataFrame([(f"b{i:03d}", Decimal(i)) for i in range(100)], "borrower_id string, x decimal(15,2)")
    path = str(tmp_path / "features")
    assert write_features(features, path) == 100
    found = lookup(spark.read.parquet(path), "b042")
    assert [r.x for r in found.collect()] == [Decimal(42)]
    assert "PushedFilters: [IsNotNull(borrower_id), EqualTo(borrower_id,b042)]" in found._jdf.queryExecution().executedPlan().toString()

    publish_snapshot(features, "snap_features", "1")
    merged = spark.table("snap_features").withColumn("x", F.col("x") + 1)
    publish_snapshot(merged.select("borrower_id", F.col("x").cast("decimal(15,2)").alias("x")), "snap_features", "2")
    assert lookup(spark.table("snap_features"), "b042").first().x == Decimal(43)
    with pytest.raises(Exception):
        publish_snapshot(features, "snap_features", "2")

    where = str(tmp_path / "ext")
    nested = features.withColumn("tags", F.array("borrower_id"))
    create_external_table(nested, "ext_features", where)
    create_external_table(nested, "ext_features", where)
    assert spark.table("ext_features").count() == 100 and dict(spark.table("ext_features").dtypes)["tags"] == "string"
    assert glob.glob(f"{where}/*.snappy.parquet")


def test_settle_reads_back_from_the_shared_folder(spark):
    df = settle(spark.range(10).withColumn("x", F.array(F.lit("a"))), "t")
    assert df.count() == 10 and shared_dir(spark) in df.inputFiles()[0]
    assert fresh_path(spark, "t") != fresh_path(spark, "t")

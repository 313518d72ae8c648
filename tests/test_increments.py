import random
import uuid

import pytest
from pyspark.sql import functions as F
from test_classify import SAMPLES, messages

from textledger.functions import message_key, period_of
from textledger.operators.classify import to_raw
from textledger.operators.merge import not_yet_processed
from textledger.operators.sketches import daily_lender_sketches, daily_lenders, lender_counts
from textledger.schemas import RAW_INPUT
from textledger.sources.messages import land_once, read_raw
from textledger.sources.settle import settled, shared_dir
from textledger.sources.sinks import write_bucketed, write_checked
from textledger.streaming.jobs import dedup_stored, dedup_stream, drain_batches, drain_to_parquet, read_stored

DAY = 86_400_000


def test_sketches_merge_over_days_with_a_small_error(spark):
    rng = random.Random(3)
    rows = [("big", d, f"s{rng.randrange(20_000)}") for d in range(60) for _ in range(700)] + [("small", d, f"s{d % 7}") for d in range(60)] + [(None, 1, "x")]
    df = spark.createDataFrame(rows, "borrower_id string, d int, sender_hash string").select(
        "borrower_id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("txn_date"), "sender_hash", F.lit("LENDER").alias("sender_tag"))
    df = df.unionByName(df.limit(50).withColumns({"sender_tag": F.lit("BANK"), "sender_hash": F.lit("other")}))
    exact, sketched = daily_lenders(df), daily_lender_sketches(df)
    for days in (5, 40, None):
        want = {r[0]: r[1] for r in lender_counts(exact, "2024-02-20", days).collect()}
        plain = {}
        for b, d, s in rows:
            if b and (days is None or 50 - days <= d <= 50):
                plain.setdefault(b, set()).add(s)
        got = {r[0]: r[1] for r in lender_counts(sketched, "2024-02-20", days).collect()}
        assert want == {b: len(s) for b, s in plain.items()}
        assert got["small"] == want["small"] and abs(got["big"] - want["big"]) <= 0.05 * want["big"]
    assert sketched.where("borrower_id = 'big'").count() == 60 < exact.where("borrower_id = 'big'").count()


def test_stored_keys_drop_copies_of_any_age(spark, tmp_path):
    src, out, keys, offsets = (str(tmp_path / n) for n in ("in", "out", "keys", "offsets"))
    start = 1_700_000_000_000
    batches = [
        [("a", "s", "x", start), ("a", "s", "y", start), ("b", "s", "x", None), ("b", "s", "x", None)],
        [("a", "s", "z", start + 200 * DAY), ("b", "s", "y", None)],
        [("a", "s", "late", start), ("b", "s", "x", None), ("a", "s", "x", start + 1), (None, "s", "n", start)],
    ]
    for rows in batches:
        messages(spark, rows).write.mode("append").parquet(src)
        each = dedup_stored(spark, out, keys)

        def twice(batch, batch_id, each=each):
            each(batch, batch_id)
            each(batch, batch_id)  # a replay changes nothing

        drain_batches(spark.readStream.schema(RAW_INPUT).parquet(src), twice, offsets)
    got = sorted((str(r.borrower_id), r.inbox_time_ms or 0, r.sms_body if r.inbox_time_ms is None else "") for r in read_stored(spark, out).collect())
    assert got == sorted([("a", start, ""), ("b", 0, "x"), ("a", start + 200 * DAY, ""), ("b", 0, "y"), ("a", start + 1, ""), ("None", start, "")])
    bounded = str(tmp_path / "bounded")
    drain_to_parquet(dedup_stream(spark.readStream.schema(RAW_INPUT).parquet(src), "1 day").select("customer_id", "inbox_time_in_millis"), bounded, str(tmp_path / "o2"))
    assert spark.read.parquet(bounded).where("inbox_time_in_millis IS NULL").count() == 4


def test_bucketed_tables_are_joined_without_an_exchange(spark):
    raw = to_raw(messages(spark, SAMPLES)).select("raw_id", "borrower_id")
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in range(2)]
    write_bucketed(raw, names[0], "raw_id", 4)
    write_bucketed(raw.limit(2).select("raw_id"), names[1], "raw_id", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = not_yet_processed(spark.table(names[0]), spark.table(names[1]))
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Exchange" not in plan
        assert left.count() == len(SAMPLES) - 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_constraints_are_counted_in_the_pass_that_writes(spark, tmp_path):
    df = to_raw(messages(spark, [*SAMPLES, (None, None, None, None)]))
    plans = []

    def save(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        rows.write.parquet(str(tmp_path / "t"))

    checks = {"no_borrower": F.col("borrower_id").isNull(), "early": F.col("inbox_time_ms") < 0, "late": F.col("inbox_time_ms") > 0}
    found = write_checked(df, save, checks)
    assert found == {"rows": 7, "no_borrower": 1, "early": 0, "late": 6}
    assert len(plans) == 1 and plans[0].count("Scan") == 1 and "CollectMetrics" in plans[0]


def test_a_run_id_names_one_upload(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert land_once(messages(spark, SAMPLES), path, "r1") == land_once(messages(spark, SAMPLES[::-1]), path, "r1") == 6
    assert read_raw(spark, path).count() == 6 and land_once(messages(spark, SAMPLES[:2]), path, "r2") == 2
    for other in (SAMPLES[:5], [*SAMPLES[:5], SAMPLES[0]]):
        with pytest.raises(ValueError, match="other messages"):
            land_once(messages(spark, other), path, "r1")
    assert read_raw(spark, path).count() == 8


def test_settled_rows_go_after_use(spark):
    folder = shared_dir(spark)
    with pytest.raises(ZeroDivisionError), settled(spark.range(5), "gone") as df:
        assert df.count() == 5 and folder in df.inputFiles()[0]
        path = df.inputFiles()[0]
        raise ZeroDivisionError
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_stored_rows_and_keys_hold_no_hash_and_keys_of_earlier_batches_count(spark, tmp_path):
    out, keys = str(tmp_path / "out"), str(tmp_path / "keys")
    start = 1_700_000_000_000
    first, second = [("a", "s", "x", start), ("b", "s", "x", None)], [("a", "t", "y", start), ("b", "s", "x", None), ("b", "s", "z", None), ("c", "s", "x", start)]
    each = dedup_stored(spark, out, keys)
    each(messages(spark, first), 0)
    for path in (out, keys):
        assert not {"raw_id", "message_key"} & set(spark.read.parquet(f"{path}/batch=0").columns)
    own = to_raw(messages(spark, first))
    # As the code before wrote them: the hash, and nothing else.
    marked = own.select(message_key(F.col("borrower_id"), F.col("inbox_time_ms"), F.col("raw_id")).alias("message_key"), period_of(F.col("txn_date")).alias("txn_period"))
    marked.write.mode("overwrite").partitionBy("txn_period").parquet(f"{keys}/batch=0")
    each(messages(spark, second), 1)
    wanted = {r.raw_id for r in own.collect()} | {r.raw_id for r in to_raw(messages(spark, second[2:])).collect()}
    got = read_stored(spark, out)
    assert sorted(r.raw_id for r in got.collect()) == sorted(wanted) and got.columns[:2] == ["raw_id", "borrower_id"]

import hashlib
import time

import pytest
from pyspark.sql import functions as F
from test_classify import SAMPLES, messages

from textledger.operators.classify import classify, to_raw
from textledger.operators.features import borrower_features
from textledger.plans import jobs
from textledger.plans.jobs import SCHEMAS, Tables, daily_run, full_refresh, lookup_profile, read_features, read_table, refresh_stream
from textledger.sources.store import Store

DAY, MS = 86_400_000, 1688212340000  # the latter is 2023-07-01


def credit(borrower, amount, ms, text="credited to a/c"):
    return (borrower, "hdfcbk", f"Rs.{amount} {text}", ms)


def features_of(spark, tables):
    return {r.borrower_id: r for r in read_features(spark, tables).collect()}


def without_stamp(spark, tables):
    return sorted(map(str, read_features(spark, tables).drop("last_updated").collect()))


def test_full_refresh_twice(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"), 4)
    rows = [*SAMPLES, SAMPLES[0]]
    for _ in range(2):
        out = full_refresh(messages(spark, rows), tables, "r", lookback_days=None)
    assert (out.counts["raw"], out.counts["deduplicated"], out.counts["kept"], out.counts["borrowers"]) == (7, 6, 5, 4)
    got = {name: [tuple(r) for r in df.collect()] for name, df in out.reports.items()}
    assert got["sender_breakdown"] == [("BANK", 4), ("UPI", 1)]
    assert [r[0] for r in got["top_borrowers"]] == ["south2", "north1", "east4", "west3"]
    assert sum(r[1] for r in got["risk_distribution"]) == 4
    again = full_refresh(messages(spark, rows), tables, "r", dedup=False)
    assert again.counts["kept"] == 6


def test_daily_runs(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"), 4)
    expected = spark.createDataFrame([("north1", 1), ("south2", 9)], "borrower_id string, expected long")
    day = [m for m in SAMPLES if m[3] < MS + DAY]
    first = daily_run(messages(spark, day), tables, "d1", "2023-07-01", expected=expected)
    assert (first.counts["raw"], first.counts["kept"]) == (5, 4)
    assert {r.borrower_id for r in first.reports["count_discrepancies"].collect()} == {"south2", "west3"}
    assert first.reports["duplicate_ids"].first().violations == 0
    second = daily_run(messages(spark, [("north1", "hdfcbk", "Rs.9 credited", MS + DAY)]), tables, "d2", "2023-07-02")
    assert (second.counts["raw"], second.counts["kept"], second.counts["touched"]) == (1, 1, 1)
    row = features_of(spark, tables)["north1"]
    assert (row.total_financial_sms_90d, int(row.sum_credit_amount_90d)) == (2, 7409)
    assert read_features(spark, tables).count() == 3


def test_a_repeated_run_lands_once_and_other_messages_under_its_id_are_an_error(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"), 4)
    full_refresh(messages(spark, [credit("b1", 100, MS)]), tables, "r1")
    rows = [credit("b2", 9, MS), credit("b2", 5, None), credit("b2", 7, None), ("b3", "hdfcbk", "EMI of Rs.50 bounced, debited", MS)]
    first = daily_run(messages(spark, rows), tables, "2024-05-02", "2023-07-01")
    assert (first.counts["raw"], first.counts["kept"]) == (4, 4)
    before = without_stamp(spark, tables)
    again = daily_run(messages(spark, list(reversed(rows))), tables, "2024-05-02", "2023-07-01")
    assert (again.counts["raw"], again.counts["kept"], again.counts["touched"]) == (4, 0, 0)
    with pytest.raises(ValueError, match="other messages"):
        daily_run(messages(spark, rows[:3]), tables, "2024-05-02", "2023-07-01")
    assert read_table(spark, tables, "raw").count() == 5 and without_stamp(spark, tables) == before
    assert set(features_of(spark, tables)) == {"b1", "b2", "b3"}


def test_counts_of_broken_constraints_and_large_amounts(spark, tmp_path):
    rows = [credit("b1", "9" * 14, MS), credit("b1", "9" * 45, MS + 1), credit(None, 5, MS + 2), ("b2", None, "x", MS), ("b2", "hdfcbk", None, None)]
    out = full_refresh(messages(spark, rows), Tables(str(tmp_path / "t"), 4), "r")
    assert {k: v for k, v in out.counts.items() if k.startswith("null_")} == {"null_borrower_id": 1, "null_sms_sender": 1, "null_sms_body": 1, "null_inbox_time_ms": 1}
    assert out.counts["amounts_too_large"] == 2 and out.counts["kept"] == 3


def test_refresh_keeps_different_messages_without_a_time(spark, tmp_path):
    rows = [credit("b1", n, None) for n in (5, 7, 7)]
    out = full_refresh(messages(spark, rows), Tables(str(tmp_path / "t"), 4), "r", lookback_days=None)
    assert (out.counts["raw"], out.counts["kept"], out.counts["borrowers"]) == (3, 2, 1)


def test_daily_run_continues_a_refresh(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"), 4)
    both = [credit("b1", 100, MS), credit("b1", 700, MS), credit("b2", 50, MS)]
    for run in ("2024-05-01", "2024-05-01"):  # a refresh may run again
        out = full_refresh(messages(spark, both), tables, run)
        assert (out.counts["raw"], out.counts["kept"], out.counts["borrowers"]) == (3, 2, 2)
    # A third copy of b1's millisecond comes late and in another run: the stored one stays.
    second = daily_run(messages(spark, [credit("b3", 9, MS + 1000), credit("b1", 1, MS)]), tables, "2024-05-02", "2023-07-01")
    assert (second.counts["raw"], second.counts["deduplicated"], second.counts["kept"]) == (2, 1, 1)
    rows = features_of(spark, tables)
    assert set(rows) == {"b1", "b2", "b3"} and rows["b1"].total_financial_sms_90d == 1 and rows["b2"].risk_flag is not None
    full_refresh(messages(spark, both), tables, "2024-05-03")
    assert read_features(spark, tables).count() == 2


def history(n=24):
    """Two borrowers' messages over some months, one silent after the first; some without a time, some twice."""
    rows = [credit("b1", 10 + i, MS + i * 7 * DAY) for i in range(n)] + [credit("b2", 5, MS + 1), credit("b2", 6, MS + 3 * DAY)]
    rows += [("b3", "hdfcbk", f"EMI of Rs.{i} debited", MS + i * 20 * DAY + 5) for i in range(8)]
    return rows + [rows[3], credit("b1", 99, rows[3][3]), credit("b4", 3, None)]


def test_daily_runs_equal_a_refresh_and_silent_borrowers_decay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT_AT", 3)
    daily, whole = Tables(str(tmp_path / "d"), 4), Tables(str(tmp_path / "w"), 4)
    full_refresh(messages(spark, [m for m in history() if m[3] is None or m[3] < MS + 5 * DAY]), daily, "r", as_of="2023-07-05")
    assert set(features_of(spark, daily)) == {"b1", "b2", "b3"}
    days = [5, 40, 100, 130, 215]
    for a, b in zip(days, days[1:]):
        part = [m for m in history() if m[3] is not None and MS + a * DAY <= m[3] < MS + b * DAY]
        day = str((spark.sql(f"select date_add(date'2023-07-01', {b - 1})")).first()[0])
        daily_run(messages(spark, part), daily, f"d{b}", day)
    full_refresh(messages(spark, [m for m in history() if m[3] is None or m[3] < MS + 215 * DAY]), whole, "r", as_of=day)
    assert without_stamp(spark, daily) == without_stamp(spark, whole) and set(features_of(spark, daily)) == {"b1", "b3"}
    assert sorted(map(str, read_table(spark, daily, "classified").collect())) == sorted(map(str, read_table(spark, whole, "classified").collect()))
    assert len(Store(spark, daily.base).current().tables["partials"]) <= 4
    # Another window, and one that goes back, are worked out for everybody.
    daily_run(messages(spark, []), daily, "wide", day, lookback_days=None)
    full_refresh(messages(spark, [m for m in history() if m[3] is None or m[3] < MS + 215 * DAY]), whole, "r", as_of=day, lookback_days=None)
    assert without_stamp(spark, daily) == without_stamp(spark, whole) and "b4" in features_of(spark, daily)


def test_features_equal_those_of_messages(spark, tmp_path):
    tables, rows = Tables(str(tmp_path / "t"), 4), history()
    full_refresh(messages(spark, rows), tables, "r", dedup=False, as_of="2023-10-20")
    plain = borrower_features(classify(to_raw(messages(spark, rows))), "2023-10-20", 90)
    assert without_stamp(spark, tables) == sorted(map(str, plain.collect()))


class Broken(Exception):
    pass


@pytest.mark.parametrize("job", [full_refresh, daily_run])
def test_a_failure_after_any_write_leaves_readers_on_the_old_set(spark, tmp_path, monkeypatch, job):
    tables = Tables(str(tmp_path / "t"), 2, keep=1)
    full_refresh(messages(spark, history(4)), tables, "r", as_of="2023-07-10")
    state = lambda: {name: sorted(map(str, read_table(spark, tables, name).collect())) for name in SCHEMAS}
    before, write, args = state(), Store.write, {"as_of": "2023-07-20"} if job is full_refresh else {"run_date": "2023-07-20"}
    for nth in (0, 3, 5):
        left = [nth]

        def failing(self, *a, **k):
            done = write(self, *a, **k)
            if left[0] == 0:
                raise Broken
            left[0] -= 1
            return done

        monkeypatch.setattr(Store, "write", failing)
        with pytest.raises(Broken):
            job(messages(spark, [credit("new", 1, MS + 5 * DAY)]), tables, "d", **args)
        monkeypatch.setattr(Store, "write", write)
        assert state() == before
    job(messages(spark, [credit("new", 1, MS + 5 * DAY)]), tables, "d", **args)
    assert "new" in features_of(spark, tables) and state() != before
    # What failed runs and the old version left is gone.
    store = Store(spark, tables.base)
    live = store.current().tables
    for name in SCHEMAS:
        assert set(store._children(f"{tables.base}/{name}")) == {p.split("/")[0] for p in live[name]}
    assert len(store._versions()) == 1


def test_a_run_that_began_before_another_was_published_fails(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    begun = store.current()
    store.publish(begun)
    with pytest.raises(RuntimeError):
        store.publish(begun)


def test_lookup_reads_one_bucket_and_a_day_writes_the_buckets_it_touches(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"), 8, keep=1)
    full_refresh(messages(spark, [credit(f"b{i}", i + 1, MS + i) for i in range(40)]), tables, "r", as_of="2023-07-01")
    store = Store(spark, tables.base)
    before = store.current().tables["features"]
    found = lookup_profile(spark, tables, "b7")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(borrower_id,b7)" in text and len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}) == 1
    assert found.count() == 1
    assert lookup_profile(spark, tables, "nobody").count() == 0 and lookup_profile(spark, Tables(str(tmp_path / "none")), "b7").count() == 0
    out = daily_run(messages(spark, [credit("b7", 500, MS + 3600)]), tables, "d", "2023-07-01")
    after = store.current().tables["features"]
    assert out.counts["touched"] == 1 and len(set(before) - set(after)) == 1 and len(set(after) - set(before)) == 1
    assert features_of(spark, tables)["b7"].total_financial_sms_90d == 2 and read_features(spark, tables).count() == 40


def test_a_stream_refreshes_what_its_batches_touch_and_a_restart_changes_nothing(spark, tmp_path, monkeypatch):
    tables = Tables(str(tmp_path / "t"), 8)
    rows = [classify(to_raw(messages(spark, part))) for part in ([credit(f"b{i}", i + 1, MS + i) for i in range(20)], [credit("b3", 100, MS + DAY)])]
    refresh_stream(spark, tables, "2023-07-02", "s")(rows[0], 0)
    scans, read = [], Store.read

    def seen(self, table, schema, folders):
        df = read(self, table, schema, folders)
        scans.append((table, list(folders)))
        return df

    monkeypatch.setattr(Store, "read", seen)
    refresh_stream(spark, tables, "2023-07-02", "s")(rows[1], 1)  # as after a restart
    # No message table is read, and of the features one bucket.
    assert {t for t, _ in scans} == {"partials", "instants", "features"} and [len(f) for t, f in scans if t == "features"] == [1]
    monkeypatch.setattr(Store, "read", read)
    before = without_stamp(spark, tables)
    refresh_stream(spark, tables, "2023-07-02", "s")(rows[1], 1)  # a replay
    assert without_stamp(spark, tables) == before
    plain = borrower_features(rows[0].unionByName(rows[1]), "2023-07-02", 90)
    assert before == sorted(map(str, plain.collect()))


def test_sums_of_touched_buckets_are_pruned_by_partition(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"), 8)
    full_refresh(messages(spark, [credit(f"b{i}", i + 1, MS + i) for i in range(40)]), tables, "r", as_of="2023-07-01")
    mine = read_table(spark, tables, "partials").where(F.col("bucket").isin([3]))
    assert "PartitionFilters: [bucket" in mine._jdf.queryExecution().executedPlan().toString().replace("isnotnull(bucket", "bucket")


def test_hashes_that_follow_from_other_columns_are_not_stored(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"), 4)
    full_refresh(messages(spark, [*SAMPLES, ("u", "kotakb", "untimed", None)]), tables, "r1", as_of="2023-07-10")
    for table, columns in (("raw", {"raw_id", "dedup_key"}), ("processed", {"message_key"})):
        assert not columns & set(spark.read.parquet(str(tmp_path / "t" / table)).columns)
        assert read_table(spark, tables, table).columns == SCHEMAS[table].names
    raw = read_table(spark, tables, "raw")
    assert {r.raw_id for r in raw.collect()} == {r.raw_id for r in to_raw(messages(spark, [*SAMPLES, ("u", "kotakb", "untimed", None)])).collect()}
    marks, ids = read_table(spark, tables, "processed").collect(), {r.raw_id: r for r in raw.collect()}
    for mark in marks:
        row = ids[mark.raw_id]
        whole = f"{row.borrower_id}\x1f{row.inbox_time_ms if row.inbox_time_ms is not None else row.raw_id}"
        assert row.borrower_id is None or mark.message_key == hashlib.sha256(whole.encode()).hexdigest()
    assert marks
    store = Store(spark, str(tmp_path / "old"))  # markers of the code before
    old = spark.createDataFrame([("key", "id")], "message_key string, raw_id string").selectExpr("*", "date'2023-07-01' AS txn_period")
    folder, _ = store.write("processed", old, ["txn_period"])
    assert [r.message_key for r in jobs._rows(store, "processed", [folder]).collect()] == ["key"]


def test_a_write_leaves_no_exchange_files(spark, tmp_path):
    files = lambda: {f for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before, store = files(), Store(spark, str(tmp_path / "t"))
    rows = spark.range(0, 20_000, 1, 4).withColumn("bucket", (F.col("id") % 4).cast("int")).groupBy("id", "bucket").count()
    store.write("some", jobs.by_bucket(rows.withColumn("borrower_id", F.col("id").cast("string")), 4), ["bucket"])
    until = time.time() + 20  # the files are removed in the background
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"

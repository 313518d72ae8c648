"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs once to warm up and twice for the time, the better of which counts.
The stages of the whole job (land, classify, features, reports) are timed over stored tables.
Tables that come as one file, hence one task, are first stored as one file for each core, as any larger input would be.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

QUERIES = (
    "classified", "classify_labels", "label_distribution", "sender_breakdown", "sanitize_documents", "dedup_by_time",
    "features_90d", "features_all_history", "features_ddl", "risk_distribution", "top_borrowers", "feature_upsert",
    "profile_wide", "count_reconcile", "count_tolerance", "stream_classify", "features_from_partials", "rolling_credit_30_60",
    "labels_from_rule_join",
)


DAY_BEFORE, LAST_DAY = "2001-10-30", "2001-10-31"


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def split_inputs(spark) -> str:
    """A folder with the tables that the queries read, in CPUS files each."""
    from textledger.sources.settle import fresh_path

    folder = fresh_path(spark, "bench-input")
    for name in ("lineitem", "documents"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(int(CPUS)).write.parquet(f"{folder}/{name}.parquet")
    return folder


def stages(spark, inputs: str) -> dict[str, float]:
    """The job end to end, each step reading what the step before wrote."""
    from textledger.operators.classify import classify_deduplicated
    from textledger.operators.features import borrower_features
    from textledger.operators.reports import avg_credit_by_risk, risk_distribution, sender_breakdown, top_borrowers
    from textledger.plans.inputs import sms_input
    from textledger.sources.messages import land_raw, read_raw
    from textledger.sources.settle import fresh_path, settle
    from textledger.sources.sinks import read_classified, replace_classified, write_features

    source = settle(sms_input(spark, inputs), "bench-source")
    raw, classified, features = (fresh_path(spark, f"bench-{n}") for n in ("raw", "classified", "features"))

    def reports():
        table = spark.read.parquet(features)
        for report in (risk_distribution, avg_credit_by_risk, top_borrowers):
            report(table).collect()
        sender_breakdown(read_classified(spark, classified)).collect()

    return {
        "land": timed(lambda: land_raw(source, raw, "bench")),
        "classify": timed(lambda: replace_classified(classify_deduplicated(read_raw(spark, raw)), classified)),
        "features": timed(lambda: write_features(borrower_features(read_classified(spark, classified)), features)),
        "reports": timed(reports),
    }


def jobs_from_csv(spark, inputs: str) -> dict[str, float]:
    """Both jobs as a user runs them, from CSV files: everything up to a day, then that day."""
    from pyspark.sql import functions as F

    from textledger.functions import epoch_date
    from textledger.plans.inputs import sms_input
    from textledger.plans.jobs import Tables, daily_run, full_refresh
    from textledger.sources.messages import read_messages_csv
    from textledger.sources.settle import fresh_path

    day, sent = epoch_date(F.col("inbox_time_in_millis")) == F.lit(LAST_DAY).cast("date"), sms_input(spark, inputs)
    folders = {name: fresh_path(spark, f"bench-{name}") for name in ("csv", "upload")}
    for name, rows in (("csv", sent.where(~F.coalesce(day, F.lit(False)))), ("upload", sent.where(day))):
        rows.write.option("header", True).option("escape", '"').option("emptyValue", '""').csv(folders[name])
    tables = Tables(fresh_path(spark, "bench-job"), int(CPUS))
    read = lambda name: read_messages_csv(spark, folders[name])
    return {
        "refresh_from_csv": timed(lambda: full_refresh(read("csv"), tables, "r", as_of=DAY_BEFORE)),
        "daily_from_csv": timed(lambda: daily_run(read("upload"), tables, "d", LAST_DAY)),
    }


def main() -> None:
    from pyspark.sql import SparkSession

    from textledger.plans.registry import queries

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds, inputs = queries(), {}, split_inputs(spark)
    for name in QUERIES:
        run = lambda: registered[name](spark, inputs).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        timed(run)
        seconds[name] = min(timed(run), timed(run))
    stages(spark, inputs)
    job = min(stages(spark, inputs), stages(spark, inputs), key=lambda times: sum(times.values()))
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    total = round(sum(job.values()), 3)
    seconds.update({f"job_{k}": v for k, v in min((jobs_from_csv(spark, inputs) for _ in range(2)), key=lambda t: t["refresh_from_csv"]).items()})
    seconds.update({f"job_{k}": v for k, v in job.items()}, job_total=total)
    print(json.dumps({
        "metric": "message job end to end (land, classify, features, reports)",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "rows": rows,
        "rows_per_sec": {"job": round(rows / total), "classify": round(rows / job["classify"]), "refresh_from_csv": round(rows / seconds["job_refresh_from_csv"])},
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

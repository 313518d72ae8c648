"""Every operator as a named query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    content_key, epoch_date, extract_amount, extract_balance, hash_identifier, is_noise, mask_accounts, packed, pin, sanitize_body,
    time_parts, unpacked,
)
from ..operators import quality, reports
from ..operators.classify import (
    classify, classify_deduplicated, collect_records, create_tagged_view, label_messages, tag_senders, tag_senders_from, to_raw,
)
from ..operators.dedup import dedup_content, dedup_messages
from ..operators.features import (
    borrower_features, borrower_totals, credit_momentum, in_lookback, latest_balance, lookup, upsert_features,
    warehouse_features,
)
from ..operators.merge import empty_features, merge_features, not_yet_processed
from ..operators.rolling import rolling_credit
from ..operators.sketches import daily_lenders, lender_counts
from ..operators.rule_join import label_by_rules, matches
from ..operators.profile import profile_input, score_profile, wide_profile
from ..rules import DEFAULT_RULES, RuleSet
from ..sources.messages import classify_increment, land_raw, read_messages_csv, read_raw
from ..sources.settle import fresh_path, settle
from ..sources.sinks import (
    buckets_for, create_external_table, flatten_for_sink, parse_categories, publish_snapshot, read_classified, replace_classified,
    write_bucketed, write_features,
)
from ..streaming.jobs import (
    classify_stream, daily_counts_stream, dedup_stored, dedup_stream, drain_batches, drain_to_parquet, land_stream, read_stored,
    refresh_features,
)
from .inputs import LINE_COLUMNS, derive_messages, read_table, sms_input
from ..operators import partials as sums
from .jobs import FACTS, Tables, daily_run, full_refresh, lookup_profile, read_features, read_table as read_job_table, refresh_stream

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-11-04"  # last ship date in the data: never the wall clock
CUT = "1999-06-30"  # separates "already processed" from new in the incremental queries
RUN_DATE = "2000-01-05"  # day of the daily run that follows a refresh
QUIET_DATE = "2000-02-05"  # day of a run that brings nothing
STAMPS = ("1999-06-30 06:00:00", "2001-11-04 06:00:00")  # of a table and of what is merged into it
LOOKUP_ID = "B000005"  # present at every scale
LAST_YEAR = 365
LINE_GROUP = 4 << 20  # bytes of a row group of lines: a large file is read by more than one task
#: Keywords with which most headers of the dictionary would have no tag.
OTHER_KEYWORDS = {"LENDER": ("loan", "emi"), "UPI": ("wallet",)}

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def portable(df: DataFrame) -> DataFrame:
    """Column types that any client prints alike: money as double, dates and lists as text."""

    def plain(field: T.StructField):
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(kind, T.ArrayType):
            return F.array_join(column, "|").alias(field.name)
        if isinstance(kind, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(kind, (T.ShortType, T.IntegerType)):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema])


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw(sms_input(spark, sf_dir))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_raw(spark, sf_dir))


# The columns the feature operators read: no text, so this is a narrow table.
FACT_COLUMNS = FACTS


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified table without text, written once for operators that read it several times."""
    return settle(_classified(spark, sf_dir).select(*FACT_COLUMNS), "facts")


def _own_name(name: str) -> str:
    """A table name of this call alone."""
    return f"{name}_{uuid.uuid4().hex}"


# --- senders, noise, labels -------------------------------------------------


@query
def sender_normalize(spark, sf_dir):
    tagged = tag_senders(_raw(spark, sf_dir).select("sms_sender"))
    return tagged.groupBy("sms_sender", "sender_tag").agg(F.count("*").alias("n"))


@query
def sender_dictionary(spark, sf_dir):
    rows = [(h, tag) for tag, headers in DEFAULT_RULES.sender_headers.items() for h in headers]
    known = spark.createDataFrame(rows, "sender_key string, tag string")
    tagged = tag_senders_from(_raw(spark, sf_dir).select("sms_sender"), known)
    return tagged.groupBy("sender_tag").agg(F.count("*").alias("n"))


@query
def sender_headers(spark, sf_dir):
    """Every header of the dictionary, dealt over the rows, with the default keywords and with others."""
    known = [h for headers in DEFAULT_RULES.sender_headers.values() for h in headers]
    dealt = F.element_at(F.array(*map(F.lit, known)), (F.pmod("l_orderkey", F.lit(len(known))) + 1).cast("int"))
    lines = read_table(spark, sf_dir, "lineitem").select(dealt.alias("sms_sender"))
    tagged = tag_senders(lines).withColumnRenamed("sender_tag", "default_tag")
    both = tag_senders(tagged, RuleSet(sender_keywords=OTHER_KEYWORDS)).withColumnRenamed("sender_tag", "other_tag")
    return both.groupBy("sms_sender", "default_tag", "other_tag").agg(F.count("*").alias("n"))


@query
def global_exclusion(spark, sf_dir):
    body = F.lower(F.col("sms_body"))
    return _raw(spark, sf_dir).select("raw_id", is_noise(body).cast("int").alias("excluded"))


@query
def classify_labels(spark, sf_dir):
    return label_messages(_raw(spark, sf_dir)).select("raw_id", "sender_tag", "categories")


def _rule_table(spark: SparkSession) -> DataFrame:
    rows = [
        (label.name, list(label.tags), key, kind)
        for label in DEFAULT_RULES.labels
        for kind, keys in (("include", label.include), ("exclude", label.exclude))
        for key in keys
    ]
    return spark.createDataFrame(rows, "label string, tags array<string>, keyword string, kind string")


@query
def labels_from_rule_table(spark, sf_dir):
    labelled = label_messages(_raw(spark, sf_dir), RuleSet.from_table(_rule_table(spark)))
    return labelled.select("raw_id", F.array_sort("categories").alias("categories"))


@query
def labels_from_rule_join(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    labelled = label_by_rules(raw.withColumn("raw_id", packed(F.col("raw_id"))), _rule_table(spark))
    return labelled.select(unpacked(F.col("raw_id")).alias("raw_id"), "categories")


@query
def keywords_in_documents(spark, sf_dir):
    """The words of the benchmark's texts, with the messages' keywords, in documents: a rule table made of data."""
    words = read_table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("keyword"))
    keywords = settle(words.unionByName(_rule_table(spark).select("keyword")).where(F.length("keyword") > 3).distinct(), "keywords")
    texts = read_table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("body"))
    return matches(texts, keywords, "doc_id", "body")


@query
def label_distribution(spark, sf_dir):
    return reports.label_distribution(label_messages(_raw(spark, sf_dir)))


@query
def sender_breakdown(spark, sf_dir):
    return reports.sender_breakdown(label_messages(_raw(spark, sf_dir)))


@query
def tagged_view(spark, sf_dir):
    create_tagged_view(_raw(spark, sf_dir), "v_sms_tagged")
    return spark.sql("SELECT raw_id, borrower_id, sender_tag, category, extracted_amount FROM v_sms_tagged")


# --- text --------------------------------------------------------------------


@query
def amount_extract(spark, sf_dir):
    return _raw(spark, sf_dir).select("raw_id", extract_amount(F.lower("sms_body")).alias("amount"))


@query
def balance_extract(spark, sf_dir):
    return _raw(spark, sf_dir).select("raw_id", extract_balance(F.lower("sms_body")).alias("balance"))


@query
def mask_account_runs(spark, sf_dir):
    return _raw(spark, sf_dir).select("raw_id", mask_accounts(F.col("sms_body")).alias("masked"))


@query
def mask_documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", mask_accounts(F.col("text")).alias("masked"))


@query
def sanitize_messages(spark, sf_dir):
    # Pinned, or the text is made, hashed and masked in one generated method, too long to be compiled.
    bodies = pin(_raw(spark, sf_dir).select("raw_id", "sms_body"), _body=F.col("sms_body")).drop("sms_body")
    return bodies.select("raw_id", sanitize_body(F.col("_body")).alias("clean"))


@query
def sanitize_documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", sanitize_body(F.col("text")).alias("clean"))


@query
def sanitize_conversations_otp_first(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", sanitize_body(F.col("text"), otp_first=True).alias("clean"))


# --- keys, time, message rows ------------------------------------------------


@query
def hash_ids(spark, sf_dir):
    suppliers = read_table(spark, sf_dir, "supplier")
    return suppliers.select("s_suppkey", hash_identifier(F.col("s_name")).alias("id_hash"))


@query
def message_time_parts(spark, sf_dir):
    parts = time_parts(F.col("inbox_time_ms"), F.col("txn_date"))
    return _raw(spark, sf_dir).select("raw_id", *[v.alias(k) for k, v in parts.items()])


@query
def collected_records(spark, sf_dir):
    return collect_records(sms_input(spark, sf_dir)).drop("collected_at")


@query
def classified(spark, sf_dir):
    return _classified(spark, sf_dir)


@query
def json_roundtrip(spark, sf_dir):
    flat = flatten_for_sink(label_messages(_raw(spark, sf_dir)).select("raw_id", "categories", "txn_date"))
    back = parse_categories(flat.withColumn("categories_json", F.col("categories")))
    return back.select("raw_id", "categories", "categories_json", "txn_date")


# --- dedup, landing, increments ----------------------------------------------


@query
def dedup_by_time(spark, sf_dir):
    return dedup_messages(_raw(spark, sf_dir)).select("raw_id", "borrower_id", "inbox_time_ms", "sms_sender")


@query
def dedup_by_content(spark, sf_dir):
    return dedup_content(_classified(spark, sf_dir)).select("raw_id", "borrower_id", "amount", "categories")


@query
def content_keys(spark, sf_dir):
    key = content_key(F.col("borrower_id"), F.col("sms_body"), F.col("inbox_time_ms"))
    return _raw(spark, sf_dir).select(key.alias("dedup_key")).groupBy("dedup_key").agg(F.count("*").alias("copies"))


@query
def csv_scan(spark, sf_dir):
    """Messages written as CSV files with quotes and line breaks, and read back under the schema."""
    path = fresh_path(spark, "csv")
    sms_input(spark, sf_dir).write.option("header", True).option("escape", '"').option("emptyValue", '""').csv(path)
    back = to_raw(read_messages_csv(spark, path))
    return back.groupBy("borrower_id").agg(
        F.count("*").alias("rows"), F.count("sms_sender").alias("senders"), F.sum(F.length("sms_body")).alias("chars"),
        F.min("txn_date").alias("first_date"), F.max("txn_date").alias("last_date"),
    )


@query
def landed_by_date(spark, sf_dir):
    """Messages landed in the date-partitioned raw table, then counted per date and tag."""
    path = fresh_path(spark, "raw")
    landed = land_raw(sms_input(spark, sf_dir), path, "run-1")
    counts = read_raw(spark, path).groupBy("txn_date", "sender_tag", "pipeline_run_id").agg(F.count("*").alias("n"))
    return counts.withColumn("rows_landed", F.lit(landed).cast("bigint"))


@query
def landed_deduplicated(spark, sf_dir):
    """The raw table of a full refresh: one row per (borrower, millisecond), with content keys."""
    path = fresh_path(spark, "raw")
    written = land_raw(sms_input(spark, sf_dir), path, "run-1", mode="overwrite", dedup=True)
    keys = read_raw(spark, path).groupBy("txn_date", "sender_tag", packed(F.col("dedup_key")).alias("_key")).agg(F.count("*").alias("_n"))
    counts = keys.groupBy("txn_date", "sender_tag").agg(
        F.sum("_n").alias("n"), F.count("_key").alias("keys"), unpacked(F.min("_key")).alias("first_key")
    )
    return counts.withColumn("rows_landed", F.lit(written).cast("bigint"))


@query
def external_table(spark, sf_dir):
    """Labelled messages as a flat table over Parquet files, read back by name."""
    name = _own_name("labelled_messages")
    rows = label_messages(_raw(spark, sf_dir)).select("raw_id", "categories", "txn_date")
    create_external_table(rows, name, fresh_path(spark, "external"))
    return spark.table(name)


@query
def incremental_unclassified(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    markers = raw.where(F.col("txn_date") <= F.lit(CUT).cast("date")).select("raw_id")
    # Labelled first, which moves nothing; then ids, packed, and not texts are looked up, and only of messages with a label.
    # The ids are pinned, or the join's test for null ids would make the text of every message once more.
    as_bytes = lambda rows, *others: pin(rows, _id=packed(F.col("raw_id"))).select(F.col("_id").alias("raw_id"), *others)
    todo = not_yet_processed(as_bytes(label_messages(raw), "txn_date", "sender_tag"), as_bytes(markers))
    return todo.groupBy("txn_date", "sender_tag").agg(F.count("*").alias("n"))


@query
def incremental_bucketed(spark, sf_dir):
    """What is left to classify, from a raw and a marker table that are stored in the same buckets of ids."""
    raw = _raw(spark, sf_dir)
    names, buckets = [_own_name(n) for n in ("raw_bucketed", "marks_bucketed")], buckets_for(raw.count())
    write_bucketed(raw.select("raw_id", "borrower_id", "inbox_time_ms", "txn_date"), names[0], "raw_id", buckets, fresh_path(spark, "raw-bucketed"))
    done = raw.where(F.col("txn_date") <= F.lit(CUT).cast("date")).select("raw_id")
    write_bucketed(done, names[1], "raw_id", buckets, fresh_path(spark, "marks-bucketed"))
    return not_yet_processed(spark.table(names[0]), spark.table(names[1])).select("raw_id", "borrower_id", "txn_date")


@query
def incremental_runs(spark, sf_dir):
    """Three runs of one date, the last two of which must add nothing, then one of the next date."""
    raw_path, classified_path, marker_path = (fresh_path(spark, n) for n in ("raw", "classified", "markers"))
    land_raw(sms_input(spark, sf_dir), raw_path, "run-1")
    for run_date in ("2000-01-05", "2000-01-05", "2000-01-05", "2000-01-06"):
        classify_increment(spark, raw_path, classified_path, marker_path, run_date)
    return read_classified(spark, classified_path).select("raw_id", "borrower_id", "categories", "amount", "txn_date")


@query
def classified_table(spark, sf_dir):
    """Full refresh of the classified table from deduplicated messages, read back by date."""
    path = fresh_path(spark, "classified")
    written = replace_classified(classify_deduplicated(_raw(spark, sf_dir)), path)
    table = read_classified(spark, path)
    return table.groupBy("txn_year", "txn_month", "sender_tag").agg(
        F.count("*").alias("n"), F.sum("amount").cast("decimal(25,2)").alias("amount")
    ).withColumn("rows_written", F.lit(written).cast("bigint"))


# --- features ----------------------------------------------------------------


@query
def features_all_history(spark, sf_dir):
    return borrower_features(_facts(spark, sf_dir)).select(
        "borrower_id", "total_financial_sms_90d", "count_credit_txn_90d", "sum_credit_amount_90d",
        "count_debit_txn_90d", "sum_debit_amount_90d", "count_loan_disbursement_90d", "count_emi_payment_90d",
        "sum_emi_amount_90d", "count_bounce_txn_90d", "latest_sms_date", "last_known_balance", "credit_momentum",
        "risk_score", "risk_flag",
    )


@query
def features_90d(spark, sf_dir):
    return warehouse_features(_classified(spark, sf_dir), AS_OF)


@query
def features_90d_past(spark, sf_dir):
    """As of a date in the middle of the data: later messages have no part in it."""
    return warehouse_features(_classified(spark, sf_dir), CUT)


@query
def features_ddl(spark, sf_dir):
    """The whole feature table, 90-day lookback."""
    return borrower_features(_facts(spark, sf_dir), AS_OF, 90)


@query
def features_upsert_measures(spark, sf_dir):
    return upsert_features(_classified(spark, sf_dir), AS_OF)


@query
def latest_known_balances(spark, sf_dir):
    return latest_balance(_classified(spark, sf_dir))


@query
def credit_momentum_30d(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    return credit_momentum(facts, borrower_totals(facts))


@query
def rolling_credit_30_60(spark, sf_dir):
    return rolling_credit(_classified(spark, sf_dir))


@query
def risk_score(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    return borrower_features(facts, AS_OF, LAST_YEAR).select("borrower_id", "risk_score", "risk_flag")


@query
def risk_distribution(spark, sf_dir):
    return reports.risk_distribution(borrower_features(_facts(spark, sf_dir), AS_OF, 90))


@query
def avg_credit_by_risk(spark, sf_dir):
    return reports.avg_credit_by_risk(borrower_features(_facts(spark, sf_dir), AS_OF, 90))


@query
def top_borrowers(spark, sf_dir):
    return reports.top_borrowers(borrower_features(_facts(spark, sf_dir)))


@query
def profile_lookup(spark, sf_dir):
    """The feature table written sorted by borrower, then one profile read from it."""
    path = fresh_path(spark, "features")
    write_features(warehouse_features(_classified(spark, sf_dir), AS_OF, None), path)
    return lookup(spark.read.parquet(path), LOOKUP_ID)


def _features_at_cut(facts: DataFrame) -> DataFrame:
    """Feature table as of CUT, the target of a merge."""
    return borrower_features(facts.where(F.col("txn_date") <= F.lit(CUT).cast("date")), CUT, 90)


@query
def feature_upsert(spark, sf_dir):
    """Features as of an earlier date, merged with the measures of the latest 90 days."""
    facts = _facts(spark, sf_dir)
    return merge_features(_features_at_cut(facts), upsert_features(facts, AS_OF))


@query
def profile_wide(spark, sf_dir):
    rows = profile_input(_raw(spark, sf_dir))
    return score_profile(wide_profile(rows, AS_OF, LAST_YEAR)).drop("risk_score", "risk_flag")


@query
def stamped_upsert(spark, sf_dir):
    """Which rows a merge touched, by their time of update."""
    before, after = (F.lit(t).cast("timestamp") for t in STAMPS)
    facts = _facts(spark, sf_dir)
    stored = _features_at_cut(facts).withColumn("last_updated", before)
    merged = merge_features(stored, upsert_features(facts, AS_OF), updated_at=after)
    return merged.select("borrower_id", F.col("last_updated").cast("string").alias("last_updated"))


@query
def profile_wide_past(spark, sf_dir):
    rows = profile_input(_raw(spark, sf_dir))
    return score_profile(wide_profile(rows, CUT, LAST_YEAR)).drop("risk_score", "risk_flag")


@query
def lender_counts_90d(spark, sf_dir):
    """Different lenders of a borrower's last 90 days, from senders kept per day."""
    days = settle(daily_lenders(profile_input(_raw(spark, sf_dir))), "lenders")
    return lender_counts(days, AS_OF)


@query
def profile_risk(spark, sf_dir):
    rows = profile_input(_raw(spark, sf_dir))
    return score_profile(wide_profile(rows, AS_OF, LAST_YEAR)).select("borrower_id", "risk_score", "risk_flag")


# --- validation --------------------------------------------------------------


@query
def run_counts(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return reports.run_counts(raw, label_messages(raw))


@query
def distinct_senders(spark, sf_dir):
    return reports.sender_counts(_raw(spark, sf_dir))


@query
def daily_message_counts(spark, sf_dir):
    return quality.daily_counts(label_messages(_raw(spark, sf_dir)))


@query
def daily_counts_on_date(spark, sf_dir):
    return quality.daily_counts(label_messages(_raw(spark, sf_dir)), RUN_DATE)


@query
def count_reconcile(spark, sf_dir):
    """Messages with a time on the device, against deduplicated messages of any time."""
    sent = sms_input(spark, sf_dir)
    device = sent.where(F.col("inbox_time_in_millis") > 0)
    ingested = sent.select("customer_id", "inbox_time_in_millis").distinct()
    return quality.reconcile_counts(device, ingested)


@query
def count_tolerance(spark, sf_dir):
    """Daily counts after deduplication against the daily counts sent."""
    raw = _raw(spark, sf_dir)
    sent = quality.daily_counts(raw).withColumnRenamed("sms_count", "expected")
    once = dedup_messages(raw.select("borrower_id", "inbox_time_ms", "txn_date", packed(F.col("raw_id")).alias("raw_id")))
    stored = quality.daily_counts(once).withColumnRenamed("sms_count", "actual")
    return quality.count_discrepancies(stored, sent, ("borrower_id", "txn_date"))


@query
def payload_mismatch(spark, sf_dir):
    """Documents as uploads: lines received against the number of different lines announced."""
    lines = F.split("text", "\n", -1)
    uploads = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("payload_id"), F.size(F.array_distinct(lines)).cast("bigint").alias("expected"),
        lines.alias("messages"),
    )
    return quality.payload_mismatches(uploads)


@query
def constraint_violations(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    suppliers = read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("B"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("borrower_id")
    )
    kept = label_messages(raw)
    return quality.constraint_report(
        quality.null_violations(raw, ["borrower_id", "sms_sender", "sms_body", "inbox_time_ms"]),
        quality.unique_violations(raw, "raw_id"),
        quality.reference_violations(kept, "borrower_id", suppliers, "borrower_id"),
    )


# --- whole jobs ---------------------------------------------------------------


_LOCAL = (
    "borrower_id", "total_financial_sms_90d", "count_credit_txn_90d", "sum_credit_amount_90d", "count_debit_txn_90d", "sum_debit_amount_90d",
    "count_loan_disbursement_90d", "count_emi_payment_90d", "sum_emi_amount_90d", "count_bounce_txn_90d", "latest_sms_date",
    "last_known_balance", "credit_momentum", "risk_score", "risk_flag",
)


@query
def job_full_refresh(spark, sf_dir):
    """The feature table after two full refreshes over the whole history under one run id."""
    tables = Tables(fresh_path(spark, "job"))
    for _ in range(2):
        full_refresh(sms_input(spark, sf_dir), tables, "2024-05-01", lookback_days=None)
    return read_features(spark, tables).select(*_LOCAL)


def _sent_on(messages: DataFrame, first: str | None, last: str) -> DataFrame:
    """Messages of some days, and with ``first=None`` also those without a date."""
    day = epoch_date(F.col("inbox_time_in_millis"))
    low = day.isNull() if first is None else F.lit(False)
    return messages.where(low | ((day >= F.lit(first or "1900-01-01").cast("date")) & (day <= F.lit(last).cast("date"))))


#: Installations by session and input: several queries look at the tables that the same runs left.
_AFTER_DAILY_RUNS: dict[tuple[str, str], Tables] = {}


def _daily_runs(spark: SparkSession, sf_dir: str) -> Tables:
    """A refresh over all messages up to CUT, then one upload for the next half year, a repeated run of a day, and a day without messages."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known in _AFTER_DAILY_RUNS:
        return _AFTER_DAILY_RUNS[known]
    tables, sent = Tables(fresh_path(spark, "job"), 16), sms_input(spark, sf_dir)
    full_refresh(_sent_on(sent, None, CUT), tables, "r1", as_of=CUT)
    daily_run(_sent_on(sent, "1999-07-01", "2000-01-04"), tables, "d1", "2000-01-04")
    for _ in range(2):
        daily_run(_sent_on(sent, RUN_DATE, RUN_DATE), tables, "d2", RUN_DATE)
    daily_run(_sent_on(sent, "2100-01-01", "2100-01-01"), tables, "d3", QUIET_DATE)
    _AFTER_DAILY_RUNS[known] = tables
    return tables


@query
def job_daily_after_refresh(spark, sf_dir):
    """A refresh over the messages before a day and those without one, then that day's run, twice."""
    tables = Tables(fresh_path(spark, "job"))
    sent, day = sms_input(spark, sf_dir), epoch_date(F.col("inbox_time_in_millis"))
    full_refresh(sent.where(day.isNull() | (day < F.lit(RUN_DATE).cast("date"))), tables, "2024-05-01", as_of="2000-01-04")
    for _ in range(2):
        daily_run(sent.where(day == F.lit(RUN_DATE).cast("date")), tables, "2024-05-02", RUN_DATE)
    return read_features(spark, tables).drop("last_updated")


@query
def job_daily_equals_refresh(spark, sf_dir):
    """Features after daily runs, the last of them a month later: as one refresh over all those days gives them."""
    return read_features(spark, _daily_runs(spark, sf_dir)).drop("last_updated")


@query
def job_profile_lookup(spark, sf_dir):
    """One borrower after the same runs, read from one bucket."""
    return lookup_profile(spark, _daily_runs(spark, sf_dir), LOOKUP_ID).drop("last_updated")


@query
def job_classified_rows(spark, sf_dir):
    """The classified table after the same runs: one row for each borrower and millisecond."""
    rows = read_job_table(spark, _daily_runs(spark, sf_dir), "classified")
    return rows.select("raw_id", "borrower_id", "categories", "amount", "txn_date")


@query
def features_from_partials(spark, sf_dir):
    """The whole feature table, 90-day lookback, from sums per borrower and day that were taken apart and merged."""
    facts = _facts(spark, sf_dir)
    before = F.coalesce(F.col("inbox_time_ms") % 2 == 0, F.lit(False))
    halves = [facts.where(before), facts.where(~before)]
    partials = settle(sums.merge_partials(sums.daily_partials(halves[0]).unionByName(sums.daily_partials(halves[1]))), "partials")
    instants = settle(sums.credit_instants(halves[0]).unionByName(sums.credit_instants(halves[1])), "instants")
    return sums.window_features(partials, instants, AS_OF)


@query
def features_from_partials_all_history(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    partials, instants = settle(sums.daily_partials(facts), "partials"), settle(sums.credit_instants(facts), "instants")
    return sums.window_features(partials, instants, lookback_days=None).select(*_LOCAL)


@query
def upsert_measures_from_partials(spark, sf_dir):
    return sums.window_upsert_measures(sums.daily_partials(_classified(spark, sf_dir)), AS_OF)


@query
def bucket_upsert(spark, sf_dir):
    """Which borrowers a day's run wrote anew, by their time of update: those whose window changed."""
    before, after = (F.lit(t).cast("timestamp") for t in STAMPS)
    tables, sent = Tables(fresh_path(spark, "job"), 16), sms_input(spark, sf_dir)
    full_refresh(_sent_on(sent, None, "2000-01-04"), tables, "r1", as_of="2000-01-04", updated_at=before)
    daily_run(_sent_on(sent, RUN_DATE, RUN_DATE), tables, "d1", RUN_DATE, updated_at=after)
    features = read_features(spark, tables)
    return features.select("borrower_id", "total_financial_sms_90d", F.col("last_updated").cast("string").alias("last_updated"))


# --- streams, drained to the end -----------------------------------------------


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read_table(spark, sf_dir, "lineitem").schema
    return derive_messages(spark.readStream.schema(schema).parquet(f"{sf_dir}/lineitem.parquet*").select(*LINE_COLUMNS))


@query
def stream_classify(spark, sf_dir):
    out = fresh_path(spark, "stream")
    drain_to_parquet(classify_stream(_message_stream(spark, sf_dir)), out, fresh_path(spark, "offsets"))
    return read_classified(spark, out).drop("txn_period")


@query
def stream_dedup(spark, sf_dir):
    out = fresh_path(spark, "stream")
    stream = dedup_stream(_message_stream(spark, sf_dir), keep_untimed=False).select("customer_id", "inbox_time_in_millis")
    drain_to_parquet(stream, out, fresh_path(spark, "offsets"))
    return spark.read.schema("customer_id string, inbox_time_in_millis bigint").parquet(out)


@query
def stream_dedup_whole(spark, sf_dir):
    """Deduplication of a stream that keeps messages without a time."""
    out = fresh_path(spark, "stream")
    stream = dedup_stream(_message_stream(spark, sf_dir))
    drain_to_parquet(stream.select("customer_id", "inbox_time_in_millis"), out, fresh_path(spark, "offsets"))
    return spark.read.schema("customer_id string, inbox_time_in_millis bigint").parquet(out)


@query
def stream_dedup_stored(spark, sf_dir):
    """Deduplication of a stream against stored keys, three files a batch: copies of any age go, untimed ones by content."""
    lines = fresh_path(spark, "lines")
    read_table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS).repartition(6, "l_partkey").write.option("parquet.block.size", LINE_GROUP).parquet(lines)
    schema = read_table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS).schema
    stream = derive_messages(spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(lines))
    out = fresh_path(spark, "stream")
    drain_batches(stream, dedup_stored(spark, out, fresh_path(spark, "keys")), fresh_path(spark, "offsets"))
    return read_stored(spark, out).select("borrower_id", "inbox_time_ms", F.when(F.col("inbox_time_ms").isNull(), F.col("raw_id")).alias("untimed_id"))


@query
def stream_land(spark, sf_dir):
    path = fresh_path(spark, "raw")
    land_stream(_message_stream(spark, sf_dir), path, fresh_path(spark, "offsets"), "run-1")
    return read_raw(spark, path).groupBy("txn_date", "sender_tag", "pipeline_run_id").agg(F.count("*").alias("n"))


@query
def stream_daily_counts(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parquet*")
    utc = stream.withColumn("event_time", F.timestamp_micros(
        F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    ))
    out = fresh_path(spark, "stream")
    counts = daily_counts_stream(utc, "event_time", "user_id")
    # The day as whole days since 1970, so the session time zone has no part in it.
    day = F.floor(F.unix_millis("day_start") / 86_400_000).cast("int")
    dated = counts.select("user_id", F.date_add(F.lit("1970-01-01").cast("date"), day).alias("day"), "sms_count")
    drain_to_parquet(dated, out, fresh_path(spark, "offsets"))
    return spark.read.schema("user_id bigint, day date, sms_count bigint").parquet(out)


@query
def stream_feature_refresh(spark, sf_dir):
    """Classified batches drained into a feature table by merge, one published version per batch."""
    table, versions, view = fresh_path(spark, "classified"), fresh_path(spark, "features"), _own_name("streamed_features")

    def land(batch, batch_id):
        # A folder per batch, overwritten: a replayed batch replaces itself.
        folder = f"{table}/batch={batch_id}"
        batch.select(*FACT_COLUMNS).write.mode("overwrite").parquet(folder)
        refresh(spark.read.parquet(folder), batch_id)

    def published():  # what a restarted stream finds, too
        return spark.table(view) if spark.catalog.tableExists(view) else empty_features(spark).drop("last_updated")

    def publish(features, batch_id):
        version = f"{batch_id}-{uuid.uuid4().hex[:8]}"
        publish_snapshot(features, view, version, f"{versions}/{version}")

    refresh = refresh_features(lambda: spark.read.parquet(table), published, publish, AS_OF, LAST_YEAR)
    drain_batches(classify_stream(_message_stream(spark, sf_dir)).select(*FACT_COLUMNS), land, fresh_path(spark, "offsets"))
    return published().select(
        "borrower_id", "total_financial_sms_90d", "count_credit_txn_90d", "sum_credit_amount_90d",
        "count_emi_payment_90d", "sum_emi_amount_90d", "count_bounce_txn_90d", "count_debit_txn_90d", "risk_flag",
    )


@query
def stream_partials_refresh(spark, sf_dir):
    """Classified batches drained into the sums per borrower and day; features follow batch by batch, the last batch replayed."""
    tables = Tables(fresh_path(spark, "streamed"), 16)
    step = refresh_stream(spark, tables, AS_OF, "messages")

    def each(batch, batch_id):
        step(batch, batch_id)
        step(batch, batch_id)

    # A batch comes with all its columns made: those that no sum reads are left out before.
    facts = classify_stream(_message_stream(spark, sf_dir)).select(*FACT_COLUMNS)
    drain_batches(facts, each, fresh_path(spark, "offsets"))
    return read_features(spark, tables).drop("last_updated")

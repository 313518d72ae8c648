"""The whole job: a full refresh from raw messages, and the daily run. Both keep to one rule and end in the same tables.

Of the messages of a borrower in one millisecond the first that was landed stays, among those landed together the one with the smallest
id; messages without a time are copies if their content is equal. Features are those of the ``lookback_days`` up to ``as_of``, for
every borrower. So a refresh over some days gives what daily runs over them give.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import content_key, message_key, packed, period_of, raw_id, time_parts, unpacked
from ..operators import partials as sums
from ..operators import quality, reports
from ..operators.classify import OVERFLOW, classify, classify_deduplicated
from ..operators.features import LOOKBACK_DAYS, on_date
from ..rules import DEFAULT_RULES, RuleSet
from ..schemas import CLASSIFIED, FEATURE_SCHEMA, INSTANTS, PARTIALS, PERIOD, RAW
from ..sources.messages import fingerprint, landed
from ..sources.settle import settled
from ..sources.sinks import by_period
from ..sources.store import BUCKET, Manifest, Store, bucket_of

MARKERS = T.StructType([T.StructField("message_key", T.StringType()), T.StructField("raw_id", T.StringType()), PERIOD])
#: The tables of an installation.
SCHEMAS = {
    "raw": RAW,
    "classified": T.StructType([*CLASSIFIED, PERIOD]),
    "processed": MARKERS,
    "partials": T.StructType([*PARTIALS, BUCKET]),
    "instants": T.StructType([*INSTANTS, BUCKET]),
    "features": T.StructType([*FEATURE_SCHEMA, BUCKET]),
}
#: Folders of one table of sums beyond which a daily run makes them one.
COMPACT_AT = 32


@dataclass(frozen=True)
class Tables:
    """Where the tables of one installation lie.

    ``buckets`` is the number of parts of the tables that are kept by borrower; a refresh may change it. ``keep`` is
    how many versions stay.
    """

    base: str
    buckets: int = 64
    keep: int = 2


@dataclass
class Outcome:
    counts: dict[str, int]
    reports: dict[str, DataFrame] = field(default_factory=dict)


def _rows(store: Store, name: str, folders: list[str]) -> DataFrame:
    """Rows of folders of a table under its schema. Hashes that follow from other columns are not stored but made when they are read: they would be
    most of what is on disk. Of markers that were written with their key, the key is read."""
    if name == "raw":
        stored = store.read(name, T.StructType([c for c in RAW if c.name not in ("raw_id", "dedup_key")]), folders)
        own_id = raw_id(F.col("borrower_id"), F.col("sms_sender"), F.col("sms_body"), F.col("inbox_time_ms"))
        key = content_key(F.col("borrower_id"), F.col("sms_body"), F.col("inbox_time_ms"))
        return stored.select(own_id.alias("raw_id"), "*", key.alias("dedup_key"))
    if name == "processed":
        stored = store.read(name, T.StructType([*MARKERS, *[c for c in RAW if c.name in ("borrower_id", "inbox_time_ms")]]), folders)
        made = message_key(F.col("borrower_id"), F.col("inbox_time_ms"), F.col("raw_id"))
        return stored.withColumn("message_key", F.coalesce("message_key", made)).select(*MARKERS.names)
    return store.read(name, SCHEMAS[name], folders)


def read_table(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    """A table of ``SCHEMAS`` as the last finished run of either job left it."""
    store = Store(spark, tables.base)
    return _rows(store, name, store.current().tables.get(name, []))


def read_features(spark: SparkSession, tables: Tables) -> DataFrame:
    return read_table(spark, tables, "features").drop("bucket")


def lookup_profile(spark: SparkSession, tables: Tables, borrower_id: str) -> DataFrame:
    """Profile of one borrower: only the folder of its bucket is listed, and in it row groups are skipped."""
    store = Store(spark, tables.base)
    now = store.current()
    folders = now.tables.get("features", [])
    if folders:
        mine = spark.sql("SELECT 1").select(bucket_of(F.lit(borrower_id), now.settings["buckets"])).first()[0]
        folders = [f for f in folders if f.endswith(f"/bucket={mine}")]
    return store.read("features", SCHEMAS["features"], folders).where(F.col("borrower_id") == borrower_id).drop("bucket")


def by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """Add the bucket, gather each one into files of a good size, sorted by borrower; AQE splits a large one."""
    placed = rows.withColumn("bucket", bucket_of(F.col("borrower_id"), buckets))
    order = [c for c in ("bucket", "borrower_id", "txn_date", "inbox_time_ms") if c in placed.columns]
    return placed.hint("rebalance", "bucket").sortWithinPartitions(*order)


def _land(store: Store, messages: DataFrame, run_id: str, rules: RuleSet) -> tuple[str, dict[str, int]]:
    """Write the messages as they come, without an exchange, and count what constraints they break in the same pass."""
    rows = landed(messages, run_id, rules=rules)
    names = ("borrower_id", "sms_sender", "sms_body", "inbox_time_ms")
    segment, counts = store.write("raw", rows.drop("raw_id", "dedup_key"), checks={f"null_{c}": F.col(c).isNull() for c in names})
    return segment, {"raw": counts.pop("rows"), **counts}


def _markers(raw: DataFrame, known: DataFrame | None) -> DataFrame:
    """One row per message that is new, by month: its key and the id that stands for it. Copies are dropped on the map side, without their text.

    Borrower, time and packed id move and are written; the key is made from them when it is read, and moves only against known keys.
    """
    content = F.when(F.col("inbox_time_ms").isNull(), F.col("raw_id"))
    fresh = raw.select("borrower_id", "inbox_time_ms", "txn_date", packed(F.col("raw_id")).alias("raw_id"), packed(content).alias("_content"))
    ids = fresh.groupBy("borrower_id", "inbox_time_ms", "txn_date", "_content").agg(F.min("raw_id").alias("raw_id")).drop("_content")
    if known is not None:
        keyed = ids.withColumn("_key", packed(message_key(F.col("borrower_id"), F.col("inbox_time_ms"), unpacked(F.col("raw_id")))))
        ids = keyed.join(known.select(packed(F.col("message_key")).alias("_key")), "_key", "left_anti").drop("_key")
    gathered = by_period(ids).withColumn("raw_id", unpacked(F.col("raw_id")))
    return gathered.select("borrower_id", "inbox_time_ms", "raw_id", "txn_period")


def _packed_ids(rows: DataFrame) -> DataFrame:
    return rows.withColumn("raw_id", packed(F.col("raw_id")))


def _write_classified(store: Store, rows: DataFrame) -> tuple[str, dict[str, int]]:
    """Write rows with packed ids by month; amounts too large for their type are counted on the way."""
    parts = {name: value for name, value in time_parts(F.col("inbox_time_ms"), F.col("txn_date")).items() if name != "txn_date"}
    gathered = by_period(rows.drop(*parts)).withColumns(parts).withColumn("raw_id", unpacked(F.col("raw_id")))
    flagged = gathered.select(*rows.columns, "txn_period")
    checks = {"amounts_too_large": F.col(OVERFLOW)}
    segment, counts = store.write("classified", flagged, ["txn_period"], checks, drop=[OVERFLOW])
    return segment, {"kept": counts.pop("rows"), **counts}


def _write_sums(store: Store, classified: DataFrame, buckets: int) -> dict[str, str]:
    return {
        "partials": store.write("partials", by_bucket(sums.daily_partials(classified), buckets), ["bucket"])[0],
        "instants": store.write("instants", by_bucket(sums.credit_instants(classified), buckets), ["bucket"])[0],
    }


def _stamped(features: DataFrame, updated_at: Column | None) -> DataFrame:
    return features.withColumn("last_updated", F.current_timestamp() if updated_at is None else updated_at)


def _latest_day(partials: DataFrame) -> str:
    """The last day with a message; without any, the first day there is."""
    day = partials.agg(F.max("txn_date").cast("string")).first()[0]
    return day or "1970-01-01"


def full_refresh(
    messages: DataFrame,
    tables: Tables,
    run_id: str,
    dedup: bool = True,
    as_of: str | None = None,
    lookback_days: int | None = LOOKBACK_DAYS,
    rules: RuleSet = DEFAULT_RULES,
    updated_at: Column | None = None,
) -> Outcome:
    """Replace all tables from raw input and return counts and the summary reports.

    Every step reads the table the step before wrote. The features are those of the ``lookback_days`` up to
    ``as_of``, by default the last day in the data; ``None`` takes the whole history. Until the end
    readers see the tables as they were; then all of them change at once.
    """
    spark = messages.sparkSession
    store = Store(spark, tables.base)
    now = store.current()
    landed_in, counts = _land(store, messages, run_id, rules)
    raw = _rows(store, "raw", [landed_in])
    marked, found = store.write("processed", _markers(raw, None), ["txn_period"])
    counts["deduplicated"] = found["rows"]
    moved = _packed_ids(raw)
    labelled = classify_deduplicated(moved, rules, untimed_by_content=True, flag_overflow=True) if dedup else classify(moved, rules, flag_overflow=True)
    kept_in, kept = _write_classified(store, labelled)
    counts |= kept
    classified = store.read("classified", SCHEMAS["classified"], [kept_in])
    segments = _write_sums(store, classified, tables.buckets)
    partials, instants = (store.read(t, SCHEMAS[t], [segments[t]]) for t in ("partials", "instants"))
    day = as_of or _latest_day(partials)
    features = _stamped(sums.window_features(partials, instants, day, lookback_days), updated_at)
    featured, found = store.write("features", by_bucket(features, tables.buckets), ["bucket"])
    counts["borrowers"] = found["rows"]
    live = {"raw": [landed_in], "processed": [marked], "classified": [kept_in], **{t: [s] for t, s in segments.items()}, "features": store.buckets_of("features", featured)}
    settings = {"as_of": day, "lookback_days": lookback_days, "buckets": tables.buckets, "streams": now.settings.get("streams", {})}
    published = store.publish(replace(now, tables=live, settings=settings, runs={run_id: list(fingerprint(raw))}), tables.keep)
    features = store.live("features", SCHEMAS["features"], published)
    return Outcome(
        counts,
        {
            "risk_distribution": reports.risk_distribution(features),
            "avg_credit_by_risk": reports.avg_credit_by_risk(features),
            "top_borrowers": reports.top_borrowers(features),
            "sender_breakdown": reports.sender_breakdown(classified),
            "label_distribution": reports.label_distribution(classified),
        },
    )


def daily_run(
    messages: DataFrame,
    tables: Tables,
    run_id: str,
    run_date: str,
    lookback_days: int | None = LOOKBACK_DAYS,
    expected: DataFrame | None = None,
    rules: RuleSet = DEFAULT_RULES,
    updated_at: Column | None = None,
) -> Outcome:
    """Land an upload, classify what is new of it, bring the features to ``run_date``, check the counts.

    Only the upload is classified, whatever the dates in it. Its sums per borrower and day are added to those there are; then the
    borrowers are looked at whose window changed: those in the upload, and those with messages on days that entered or left
    the window since the run before, so that silent borrowers decay. Their buckets of the feature table are written anew.

    A run may be repeated: the same messages under the same id land once; others under a used id are an error, and nothing
    changes. ``expected (borrower_id, expected)`` holds the counts the devices announced for the date.
    """
    spark = messages.sparkSession
    store = Store(spark, tables.base)
    now = store.current()
    landed_in, counts = _land(store, messages, run_id, rules)
    raw, print_ = _rows(store, "raw", [landed_in]), None
    if run_id in now.runs:
        print_ = list(fingerprint(raw))
        if print_ != now.runs[run_id]:
            store.discard("raw", landed_in)
            raise ValueError(f"run {run_id} has landed other messages before: {now.runs[run_id]} and {print_}")
    months = [r[0] for r in raw.select(period_of(F.col("txn_date"))).distinct().collect()]
    known = _rows(store, "processed", now.tables.get("processed", []))
    dated = F.col("txn_period").isin([m for m in months if m is not None])
    known = known.where(dated | F.col("txn_period").isNull() if None in months else dated)
    marked, found = store.write("processed", _markers(raw, known), ["txn_period"])
    counts["deduplicated"] = found["rows"]
    fresh = _rows(store, "processed", [marked])
    labelled = classify_deduplicated(_packed_ids(raw), rules, untimed_by_content=True, flag_overflow=True)
    kept_in, kept = _write_classified(store, labelled.join(_packed_ids(fresh.select("raw_id")), "raw_id", "left_semi"))
    counts |= kept
    added = store.read("classified", SCHEMAS["classified"], [kept_in])
    after, counts["touched"] = _advance(store, now, added, tables, run_date, lookback_days, updated_at)
    new = {"raw": [] if print_ else [landed_in], "processed": [marked], "classified": [kept_in]}
    live = {t: now.tables.get(t, []) + s for t, s in new.items()}
    published = store.publish(replace(after, tables=after.tables | live, runs=now.runs | {run_id: print_ or list(fingerprint(raw))}), tables.keep)
    classified = store.live("classified", SCHEMAS["classified"], published)
    checks = {"duplicate_ids": quality.unique_violations(on_date(classified, run_date), "raw_id")}
    if expected is not None:
        actual = quality.daily_counts(classified, run_date).select("borrower_id", F.col("sms_count").alias("actual"))
        checks["count_discrepancies"] = quality.count_discrepancies(actual, expected)
    return Outcome(counts, checks)


def _advance(
    store: Store, now: Manifest, added: DataFrame, tables: Tables, as_of: str, lookback_days: int | None, updated_at: Column | None
) -> tuple[Manifest, int]:
    """The manifest with the sums of ``added`` classified rows and the features as of a day, not yet published, and how many borrowers were looked at.

    Reads the sums of the buckets in which a borrower's window changed, and writes those buckets of the feature table.
    """
    buckets = now.settings.get("buckets", tables.buckets)
    segments = _write_sums(store, added, buckets)
    live = {t: now.tables.get(t, []) + [segments[t]] for t in segments}
    delta = store.read("partials", SCHEMAS["partials"], [segments["partials"]])
    partials, instants = (store.read(t, SCHEMAS[t], live[t]) for t in ("partials", "instants"))
    if len(live["partials"]) > COMPACT_AT:
        merged = {"partials": sums.merge_partials(partials.drop("bucket")), "instants": sums.merge_instants(instants.drop("bucket"))}
        live = {t: [store.write(t, by_bucket(rows, buckets), ["bucket"])[0]] for t, rows in merged.items()}
        partials, instants = (store.read(t, SCHEMAS[t], live[t]) for t in ("partials", "instants"))
    before = (now.settings.get("as_of"), now.settings.get("lookback_days"))
    moved = sums.touched_borrowers(partials, before, (as_of, lookback_days)) if before[0] else None
    settings = now.settings | {"as_of": as_of, "lookback_days": lookback_days, "buckets": buckets}
    if moved is None:
        features = _stamped(sums.window_features(partials, instants, as_of, lookback_days), updated_at)
        name, found = store.write("features", by_bucket(features, buckets), ["bucket"])
        return replace(now, tables=now.tables | live | {"features": store.buckets_of("features", name)}, settings=settings), found["rows"]
    touched = delta.select("borrower_id").unionByName(moved).distinct().withColumn("bucket", bucket_of(F.col("borrower_id"), buckets))
    with settled(touched, "touched") as ids:
        hit = sorted(r.bucket for r in ids.select("bucket").distinct().collect())
        mine = lambda df: df.where(F.col("bucket").isin(hit)).join(ids.select("borrower_id"), "borrower_id", "left_semi")
        changed = _stamped(sums.window_features(mine(partials), mine(instants), as_of, lookback_days), updated_at)
        features = replace_rows(store, now, changed, ids, hit, buckets)
        return replace(now, tables=now.tables | live | {"features": features}, settings=settings), ids.count()


def replace_rows(store: Store, now: Manifest, changed: DataFrame, ids: DataFrame, hit: list[int], buckets: int) -> list[str]:
    """Live folders of the feature table after the borrowers ``ids``, all in the buckets ``hit``, have the rows ``changed`` and no others.

    Only these buckets are read and written; a bucket that ends up empty has no folder.
    """
    touched = {f"bucket={b}" for b in hit}
    old = [p for p in now.tables.get("features", []) if p.split("/")[1] in touched]
    rest = store.read("features", SCHEMAS["features"], old).drop("bucket").join(ids.select("borrower_id"), "borrower_id", "left_anti")
    rows = rest.select(*FEATURE_SCHEMA.names).unionByName(changed.select(*FEATURE_SCHEMA.names))
    name, _ = store.write("features", by_bucket(rows, buckets), ["bucket"])
    return [p for p in now.tables.get("features", []) if p not in old] + store.buckets_of("features", name)


def refresh_stream(
    spark: SparkSession, tables: Tables, as_of: str, stream: str, lookback_days: int | None = LOOKBACK_DAYS, updated_at: Column | None = None
):
    """``foreachBatch`` body: the sums of a batch of classified rows are added, and the features of its borrowers follow.

    No message that came before is read. The number of the batch is published with its result, so a batch that is replayed after a
    restart changes nothing. ``stream`` names the query whose batches are counted.
    """
    store = Store(spark, tables.base)

    def apply(batch: DataFrame, batch_id: int) -> None:
        now = store.current()
        done = now.settings.get("streams", {})
        if batch_id <= done.get(stream, -1):
            return
        # A batch may be computed again for each reading; the sums must be those of one reading.
        with settled(batch.select(*[F.col(f.name) for f in CLASSIFIED if f.name in FACTS]), "batch") as rows:
            after, _ = _advance(store, now, rows, tables, as_of, lookback_days, updated_at)
        store.publish(replace(after, settings=after.settings | {"streams": done | {stream: batch_id}}), tables.keep)

    return apply


#: What the sums read of classified rows.
FACTS = ("borrower_id", "categories", "amount", "balance", "txn_date", "inbox_time_ms")

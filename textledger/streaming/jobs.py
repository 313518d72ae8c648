"""Incremental landing, dedup, daily counts and feature refresh.

Each builder takes a streaming DataFrame; the ``run_*`` functions drain what is
available now and stop, which is how a daily job calls them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import message_key, packed, period_of, raw_id, unpacked
from ..operators.classify import classify, to_raw
from ..operators.features import upsert_features
from ..operators.merge import merge_features
from ..rules import DEFAULT_RULES, RuleSet
from ..schemas import PERIOD, RAW
from ..sources.messages import landed
from ..sources.settle import CODEC, exchanges_dropped, settled
from ..sources.sinks import by_period

#: What a deduplicated stream keeps of a message.
STORED = T.StructType([RAW[c] for c in ("raw_id", "borrower_id", "sms_sender", "sms_body", "inbox_time_ms", "txn_date")])


def with_event_time(messages: DataFrame) -> DataFrame:
    """Add ``event_time`` from the epoch milliseconds, null where there are none."""
    return messages.withColumn("event_time", F.timestamp_millis(F.nullif("inbox_time_in_millis", F.lit(0))))


def classify_stream(messages: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Raw input stream to classified stream: the batch operator, no state."""
    return classify(to_raw(messages), rules)


def land_stream(messages: DataFrame, path: str, checkpoint: str, run_id: str) -> None:
    """Land what is available now in the raw table: tag, run id, time of landing, month; each input file once."""
    rows = landed(messages, run_id)
    drain_to_parquet(rows.withColumn("txn_period", period_of(F.col("txn_date"))), path, checkpoint, "txn_period")


def dedup_stream(messages: DataFrame, late: str = "7 days", keep_untimed: bool = True) -> DataFrame:
    """First message per (borrower, millisecond).

    Messages without a time have no place in a watermark: they go round the state, copies included, or with
    ``keep_untimed=False`` are left out.

    State is dropped once the watermark has passed it, so it stays bounded; a copy
    that arrives later than that is kept, unlike in batch.
    """
    stamped = with_event_time(messages)
    timed = stamped.where(F.col("event_time").isNotNull())
    first = timed.withWatermark("event_time", late).dropDuplicatesWithinWatermark(["customer_id", "inbox_time_in_millis"])
    return first.unionByName(stamped.where(F.col("event_time").isNull())) if keep_untimed else first


#: What is stored of a key: borrower and time, or the id of a message without a time. Earlier batches may hold the hash of them.
KEY = T.StructType([RAW["borrower_id"], RAW["inbox_time_ms"], T.StructField("untimed_id", T.StringType()), T.StructField("message_key", T.StringType()), PERIOD])


def _own_id() -> Column:
    return raw_id(F.col("borrower_id"), F.col("sms_sender"), F.col("sms_body"), F.col("inbox_time_ms"))


def dedup_stored(spark: SparkSession, path: str, keys: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: first message per (borrower, millisecond) whatever the age of a copy; untimed ones by content.

    What a batch brings is compared with the stored keys of the months that it has messages of, so the state that
    a watermark would drop is a table instead, and of that table only partitions are read. A batch writes to a folder of its own under
    ``path`` and under ``keys``, and does not look at its own keys: a replay gives the same rows again.

    Each month is gathered before it is written, so the number of files does not grow as that of tasks times that of months. Ids, which follow from
    the other columns, are not stored and move packed; files of exchanges go after each write.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        with exchanges_dropped(batch.sparkSession), settled(to_raw(batch).drop("raw_id"), "stream-batch", CODEC) as rows:
            raw = rows.withColumn("raw_id", packed(_own_id()))
            own_key = packed(message_key(F.col("borrower_id"), F.col("inbox_time_ms"), unpacked(F.col("raw_id"))))
            keyed = raw.select("*", own_key.alias("_key"), period_of(F.col("txn_date")).alias("txn_period"))
            months = [r[0] for r in keyed.select("txn_period").distinct().collect()]
            dated = F.col("txn_period").isin([m for m in months if m is not None])
            here = dated | F.col("txn_period").isNull() if None in months else dated
            stored_key = F.coalesce("message_key", message_key(F.col("borrower_id"), F.col("inbox_time_ms"), F.col("untimed_id")))
            known = _or_none(spark, keys, KEY).where(here & (F.col("batch") != batch_id)).select(packed(stored_key).alias("_key"))
            first = F.row_number().over(Window.partitionBy("_key").orderBy("raw_id"))
            fresh = keyed.withColumn("_copy", first).where("_copy = 1").drop("_copy").join(known, "_key", "left_anti")
            by_period(fresh.drop("_key", "raw_id")).write.mode("overwrite").partitionBy("txn_period").option("compression", CODEC).parquet(f"{path}/batch={batch_id}")
            written = spark.read.schema(T.StructType([*STORED, PERIOD])).parquet(f"{path}/batch={batch_id}")
            marks = written.select("borrower_id", "inbox_time_ms", F.when(F.col("inbox_time_ms").isNull(), _own_id()).alias("untimed_id"), "txn_period")
            marks.write.mode("overwrite").partitionBy("txn_period").option("compression", CODEC).parquet(f"{keys}/batch={batch_id}")

    return apply


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """What ``dedup_stored`` has kept so far."""
    return _or_none(spark, path, T.StructType([*STORED, PERIOD])).withColumn("raw_id", _own_id()).select(*STORED.names)


def _or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema, T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def daily_counts_stream(events: DataFrame, time: str, key: str, late: str = "1 day") -> DataFrame:
    """Rows per key and UTC day, emitted once a day is closed by the watermark."""
    day = F.window(time, "1 day")
    counts = events.withWatermark(time, late).groupBy(day.alias("day"), key).agg(F.count("*").alias("sms_count"))
    return counts.select(key, F.col("day.start").alias("day_start"), "sms_count")


def drain_to_parquet(stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> None:
    """Process all available input exactly once and stop.  A rerun on the same checkpoint adds only what is new."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def drain_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def refresh_features(
    read_classified: Callable[[], DataFrame],
    read_features: Callable[[], DataFrame],
    write_features: Callable[[DataFrame, int], None],
    as_of: str,
    lookback_days: int | None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: recompute the borrowers a batch touches and merge them in.

    ``read_classified`` returns the classified table, which must already hold the
    batch.  The table is aggregated first and the touched borrowers are picked from
    the one-row-per-borrower result, so no message row is shuffled for the join.
    A replayed batch gives the same rows, so a restart is safe.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        touched = batch.where(F.col("borrower_id").isNotNull()).select("borrower_id").distinct()
        updates = upsert_features(read_classified(), as_of, lookback_days).join(touched, "borrower_id", "left_semi")
        write_features(merge_features(read_features(), updates), batch_id)

    return apply

"""Writing classified messages and features, and reading them back."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import period_of
from ..schemas import CLASSIFIED, PERIOD
from .settle import CODEC

MARKERS = T.StructType([T.StructField("raw_id", T.StringType()), T.StructField("txn_date", T.DateType())])


def by_period(rows: DataFrame) -> DataFrame:
    """Add the partition column and gather each month into files of a good size; AQE splits a heavy month.

    Rows are sorted by date and borrower inside a file, so that filters on either skip row groups.
    """
    order = [c for c in ("txn_period", "txn_date", "borrower_id") if c == "txn_period" or c in rows.columns]
    dated = rows.withColumn("txn_period", period_of(F.col("txn_date")))
    return dated.hint("rebalance", "txn_period").sortWithinPartitions(*order)


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_classified(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, T.StructType([*CLASSIFIED, PERIOD]))


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, T.StructType([*MARKERS, PERIOD]))


def replace_markers(raw: DataFrame, path: str) -> None:
    """Full refresh of the marker table: every landed message counts as looked at."""
    marks = by_period(raw.select("raw_id", "txn_date").distinct())
    marks.write.mode("overwrite").partitionBy("txn_period").option("compression", CODEC).parquet(path)


def write_checked(rows: DataFrame, write: Callable[[DataFrame], None], checks: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Write and return the number of rows, and of those that meet each condition of ``checks``, in the same pass.

    So constraints are checked while a table is written, without reading it again. The observation sits right below the write, above
    every shuffle: only tasks of the last stage count exactly once when executors are lost or a range exchange samples its input.
    """
    seen = Observation()
    counts = [F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in (checks or {}).items()]
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts))
    found = seen.get
    return {name: int(found.get(name, 0)) for name in ("rows", *(checks or {}))}


def write_counted(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write and return the number of rows, in one pass."""
    return write_checked(rows, write)["rows"]


def append_classified(classified: DataFrame, path: str) -> int:
    """Append to the table partitioned by month."""
    return write_counted(by_period(classified), lambda r: r.write.mode("append").partitionBy("txn_period").option("compression", CODEC).parquet(path))


def replace_classified(classified: DataFrame, path: str) -> int:
    """Full refresh of the classified table."""
    return write_counted(by_period(classified), lambda r: r.write.mode("overwrite").partitionBy("txn_period").option("compression", CODEC).parquet(path))


def write_features(features: DataFrame, path: str) -> int:
    """Full refresh of a feature table, range-partitioned and sorted by borrower for lookups."""
    rows = features.repartitionByRange("borrower_id").sortWithinPartitions("borrower_id")
    return write_counted(rows, lambda r: r.write.mode("overwrite").option("compression", "snappy").parquet(path))


def write_features_jdbc(features: DataFrame, url: str, table: str, partitions: int = 16, batch_size: int = 1000, **options: str) -> None:
    """Full refresh over JDBC, truncating first; the driver jar and credentials are the caller's."""
    writer = flatten_for_sink(features).repartition(partitions).write.mode("overwrite").option("truncate", "true")
    writer.option("batchsize", batch_size).options(**options).jdbc(url, table)


def table_suffix(version: str) -> str:
    """``version`` with every character other than an ASCII letter or digit written as its code."""
    return re.sub(r"[^A-Za-z0-9]", lambda m: f"_{ord(m[0]):x}_", version)


def publish_snapshot(features: DataFrame, name: str, version: str, location: str | None = None) -> str:
    """Write a new version of a table and point the view ``name`` at it.

    A merge reads the table it replaces, so the result goes to a new table first;
    readers of the view see the old rows until the switch. Any text is a version: what a
    table name cannot hold is encoded.
    """
    spark = features.sparkSession
    table = f"{name}__{table_suffix(version)}"
    writer = features.repartitionByRange("borrower_id").sortWithinPartitions("borrower_id").write.mode("errorifexists")
    if location is not None:
        writer = writer.option("path", location)
    writer.format("parquet").saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")
    return table


#: Rows of a bucket, which one task reads whole.
BUCKET_ROWS = 250_000


def buckets_for(rows: int, least: int = 8) -> int:
    """How many buckets a table of so many rows needs: their size stays the same as it grows."""
    return max(least, -(-rows // BUCKET_ROWS))


def write_bucketed(rows: DataFrame, name: str, key: str, buckets: int, location: str | None = None) -> None:
    """A table stored in buckets by a key. Two such tables with as many buckets are joined by the key without an exchange."""
    spread = rows.repartition(buckets, key)  # a bucket is one file
    writer = spread.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", location) if location else writer).saveAsTable(name)


def create_external_table(df: DataFrame, name: str, location: str) -> None:
    """Flat Parquet files plus a table over them; Spark derives the column types."""
    spark = df.sparkSession
    flatten_for_sink(df).write.mode("overwrite").option("compression", "snappy").parquet(location)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=location, source="parquet")


def flatten_for_sink(df: DataFrame, dates_as_text: bool = True) -> DataFrame:
    """Types a plain warehouse takes: arrays, maps and structs as JSON text, dates as text; nulls stay null."""

    def flat(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(column).alias(field.name)
        if dates_as_text and isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[flat(f) for f in df.schema])


def parse_categories(df: DataFrame, column: str = "categories") -> DataFrame:
    """JSON label text back to an array."""
    return df.withColumn(column, F.from_json(column, "array<string>"))

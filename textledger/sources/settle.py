"""Write an intermediate result once, where every executor can read it again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Half of a stored row is hashes in hex, which only an entropy coder makes shorter.
CODEC = "zstd"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine, so that is an error.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="textledger-")
    spark.conf.set(_SETTING, own)
    return own


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/textledger-{name}-{uuid.uuid4().hex}"


@contextmanager
def exchanges_dropped(spark: SparkSession) -> Iterator[None]:
    """Files of exchanges go at the end of each write within the block; otherwise they stay until the driver collects garbage, all those of a job together."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def settle(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write to Parquet in the shared folder and read back; with ``CODEC`` rows that are mostly text or hashes take less room, and more time.

    Cuts the lineage (lost executors re-read files), and later readings are
    columnar and pruned, which a cached or checkpointed frame is not on a cluster
    that has to spill.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate through the file system that Spark itself uses."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def settled(df: DataFrame, name: str, codec: str | None = None) -> Iterator[DataFrame]:
    """``settle`` for as long as the block lasts; then the files go."""
    path = fresh_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path, compression=codec)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)

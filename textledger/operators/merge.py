"""Set difference and merge by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURE_DEFAULTS, FEATURE_SCHEMA


def not_yet_processed(raw: DataFrame, *done: DataFrame, key: str = "raw_id") -> DataFrame:
    """Rows of ``raw`` whose id is in none of the given tables.

    An anti join, not NOT IN: null ids in ``done`` are ignored and the planner need
    not broadcast.  Pass the marker table as well as the classified one, or
    messages that were looked at and rejected come back with every run.
    """
    for table in done:
        raw = raw.join(table.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return raw


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    columns: Sequence[str],
    defaults: Mapping[str, object] | None = None,
    stamp: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert-or-update by key.

    For a key in ``updates`` the listed columns take the update's value, null
    included; its other columns stay.  A new key gets ``defaults`` in the columns
    not listed.  ``stamp`` sets columns on every touched row.  Both sides must be
    unique by key, so the one join has no heavy group.
    """
    defaults, stamp = defaults or {}, stamp or {}
    new = updates.select(F.col(key).alias("_new_key"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(new, F.col(key) == F.col("_new_key"), "full_outer")
    touched, inserted = F.col("_new_key").isNotNull(), F.col(key).isNull()

    def merged(name: str, dtype) -> Column:
        if name == key:
            value = F.coalesce(F.col(key), F.col("_new_key"))
        elif name in stamp:
            value = F.when(touched, stamp[name]).otherwise(F.col(name))
        elif name in columns:
            value = F.when(touched, F.col(f"_new_{name}")).otherwise(F.col(name))
        elif name in defaults:
            value = F.when(inserted, F.lit(defaults[name])).otherwise(F.col(name))
        else:
            value = F.col(name)
        return value.cast(dtype).alias(name)

    return joined.select(*[merged(f.name, f.dataType) for f in target.schema])


UPSERT_COLUMNS = (
    "total_financial_sms_90d", "count_credit_txn_90d", "sum_credit_amount_90d", "count_emi_payment_90d",
    "sum_emi_amount_90d", "count_bounce_txn_90d",
)


def merge_features(features: DataFrame, updates: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Merge the output of ``upsert_features`` into a feature table."""
    stamp = {"last_updated": F.current_timestamp() if updated_at is None else updated_at}
    known = {f.name for f in features.schema}
    return upsert(
        features,
        updates,
        "borrower_id",
        [c for c in UPSERT_COLUMNS if c in known],
        {k: v for k, v in FEATURE_DEFAULTS.items() if k in known},
        {k: v for k, v in stamp.items() if k in known},
    )


RISK_COLUMNS = ("credit_momentum", "risk_score", "risk_flag")


def merge_risk(features: DataFrame, scored: DataFrame) -> DataFrame:
    """Momentum, score and flag of ``scored``, as ``borrower_features`` gives them, into a feature table."""
    return upsert(features, scored, "borrower_id", RISK_COLUMNS)


def empty_features(spark) -> DataFrame:
    return spark.createDataFrame([], FEATURE_SCHEMA)

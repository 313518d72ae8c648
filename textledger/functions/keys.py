"""Identifiers and time parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000
NULL_MARK, FIELD_MARK = "\x1e", "\x1f"
# First and last millisecond of the years 1 to 9999.
_MIN_MS, _MAX_MS = -62_135_596_800_000, 253_402_300_799_999


def hash_identifier(raw: Column) -> Column:
    """SHA-256 in hex."""
    return F.sha2(raw, 256)


def packed(hash_: Column) -> Column:
    """A hash in hex as its bytes, half as long and in the same order: for what moves between tasks."""
    return F.unhex(hash_)


def unpacked(hash_: Column) -> Column:
    """Bytes of :func:`packed` in hex again."""
    return F.lower(F.hex(hash_))


def content_key(borrower: Column, body: Column, time_ms: Column) -> Column:
    """Hash of a message's content; nulls and field borders cannot collide."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in (borrower, body, time_ms)]
    return F.sha2(F.concat_ws(FIELD_MARK, *parts), 256)


def raw_id(borrower: Column, sender: Column, body: Column, time_ms: Column) -> Column:
    """Row id derived from the content: a rerun gives the same ids, unlike a serial."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in (borrower, sender, body, time_ms)]
    return F.sha2(F.concat_ws(FIELD_MARK, *parts), 256)


def message_key(borrower: Column, time_ms: Column, row_id: Column) -> Column:
    """What one message has for itself: borrower and millisecond, or without a time its content."""
    return F.sha2(F.concat_ws(FIELD_MARK, F.coalesce(borrower, F.lit(NULL_MARK)), F.coalesce(time_ms.cast("string"), row_id)), 256)


def epoch_date(time_ms: Column) -> Column:
    """UTC date by integer arithmetic, so the session time zone has no part in it.

    A time outside the years 1 to 9999 gives null: one corrupt row must not fail a job.
    """
    days = F.floor(time_ms / DAY_MS).cast("int")
    return F.when(time_ms.between(_MIN_MS, _MAX_MS), F.date_add(F.lit("1970-01-01").cast("date"), days))


def period_of(date: Column) -> Column:
    """First day of the month: the partition a date belongs to."""
    return F.trunc(date, "MM").cast("date")


def time_parts(time_ms: Column, date: Column | None = None) -> dict[str, Column]:
    """txn_year, txn_month, txn_date, txn_hour in UTC; null for a null or zero time.

    ``date`` is the row's UTC date where the table already has it.
    """
    date = F.when(time_ms != 0, epoch_date(time_ms) if date is None else date)
    hour = F.floor(F.pmod(time_ms, F.lit(DAY_MS)) / HOUR_MS).cast("int")
    return {
        "txn_year": F.year(date),
        "txn_month": F.month(date),
        "txn_date": date,
        "txn_hour": F.when(date.isNotNull(), hour),
    }

"""Message-level operators.  None of them shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    epoch_date, first_label, hash_identifier, is_noise, label_array, pin, raw_id, sanitize_body, sender_key, sender_tag,
    time_parts, view_amount, wide_amount, wide_balance,
)
from ..rules import DEFAULT_RULES, RuleSet
from ..schemas import MONEY, RENAMES
from .dedup import dedup_messages


def to_raw(messages: DataFrame) -> DataFrame:
    """Rename input columns, add the content-derived id and the UTC date."""
    renamed = messages.withColumnsRenamed(RENAMES)
    return renamed.select(
        raw_id(F.col("borrower_id"), F.col("sms_sender"), F.col("sms_body"), F.col("inbox_time_ms")).alias("raw_id"),
        "borrower_id",
        "sms_sender",
        "sms_body",
        "inbox_time_ms",
        epoch_date(F.col("inbox_time_ms")).alias("txn_date"),
    )


def tag_senders(df: DataFrame, rules: RuleSet = DEFAULT_RULES, sender: str = "sms_sender") -> DataFrame:
    """Add ``sender_tag``.  The normalised sender is pinned: some 50 tests read it."""
    tagged = pin(df.drop("sender_tag"), _sender_key=sender_key(F.col(sender)))
    return pin(tagged, sender_tag=sender_tag(F.col("_sender_key"), rules)).drop("_sender_key")


def tag_senders_from(df: DataFrame, dictionary: DataFrame, rules: RuleSet = DEFAULT_RULES, sender: str = "sms_sender") -> DataFrame:
    """Add ``sender_tag`` from a dictionary table ``(sender_key, tag)``, else from the keywords.

    No broadcast hint: the planner broadcasts the dictionary when its size allows
    and otherwise shuffles both sides, where AQE splits a hot sender.
    """
    words = dictionary.select(F.col("sender_key").alias("_known_key"), F.col("tag").alias("_known_tag"))
    keyed = pin(df.drop("sender_tag"), _sender_key=sender_key(F.col(sender)))
    joined = keyed.join(words, F.col("_sender_key") == F.col("_known_key"), "left")
    fallback = RuleSet(sender_keywords=rules.sender_keywords, sender_headers={})
    found = F.coalesce(F.col("_known_tag"), sender_tag(F.col("_sender_key"), fallback))
    return pin(joined, sender_tag=found).drop("_sender_key", "_known_key", "_known_tag")


def keep_financial(tagged: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    return tagged.where(F.col("sender_tag").isin(*rules.kept_tags))


def drop_noise(df: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Drop null, empty and excluded bodies; adds ``_body_lower`` for the steps after."""
    lowered = pin(df, _body_lower=F.coalesce(F.lower(F.col("sms_body")), F.lit("")))
    return lowered.where(~is_noise(F.col("_body_lower"), rules))


def label_messages(raw: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Tag, drop, label.  Cheap tests come first; each sees only what the one before let through."""
    quiet = drop_noise(keep_financial(tag_senders(raw, rules), rules), rules)
    labels = label_array(F.col("sender_tag"), F.col("_body_lower"), rules, noise_removed=True)
    return pin(quiet, categories=labels).where(F.size("categories") > 0)


#: With ``flag_overflow`` classified rows say whether an amount or balance is null because it is too large for its type.
OVERFLOW = "money_overflow"


def _money(name: str) -> Column:
    return F.col(name).try_cast(MONEY).alias(name)


def _overflow() -> Column:
    over = [F.col(c).isNotNull() & F.col(c).try_cast(MONEY).isNull() for c in ("amount", "balance")]
    return (over[0] | over[1]).alias(OVERFLOW)


def classify(
    raw: DataFrame, rules: RuleSet = DEFAULT_RULES, extra: Sequence[str | Column] = (), flag_overflow: bool = False
) -> DataFrame:
    """Raw rows (see :func:`to_raw`) to classified rows.

    Masking and extraction stand after the filters, so their regular expressions
    run on kept rows only.  Pinning the money also ends one generated method and
    starts the next; in a single one of more than 8000 bytes nothing would be JIT-compiled.
    """
    parts = time_parts(F.col("inbox_time_ms"), F.col("txn_date"))
    lowered = F.col("_body_lower")
    priced = pin(label_messages(raw, rules), amount=wide_amount(lowered), balance=wide_balance(lowered))
    return priced.select(
        "raw_id",
        "borrower_id",
        "sender_tag",
        "categories",
        sanitize_body(F.col("sms_body")).alias("sms_body"),
        _money("amount"),
        _money("balance"),
        *[value.alias(name) for name, value in parts.items()],
        "inbox_time_ms",
        *extra,
        *([_overflow()] if flag_overflow else []),
    )


def classify_deduplicated(
    raw: DataFrame, rules: RuleSet = DEFAULT_RULES, untimed_by_content: bool = False, flag_overflow: bool = False
) -> DataFrame:
    """``classify(dedup_messages(raw, untimed_by_content))`` with far less to shuffle.

    Deduplication must see rejected messages too, as one of them may be the copy
    that survives.  It needs only their key and id, though.  So messages are
    classified first, rejected ones are carried along without text, and the
    survivors that were rejected are dropped at the end.
    """
    tagged = tag_senders(raw, rules)
    financial = F.col("sender_tag").isin(*rules.kept_tags)
    lowered = pin(tagged, _body_lower=F.when(financial, F.coalesce(F.lower("sms_body"), F.lit(""))).otherwise(""))
    body = F.col("_body_lower")
    # A noisy message goes on without a tag, which no label accepts; the tag is tested before the keywords.
    quiet = pin(lowered, _label_tag=F.when(is_noise(body, rules), "").otherwise(F.col("sender_tag")))
    labelled = pin(quiet, categories=label_array(F.col("_label_tag"), body, rules, noise_removed=True))
    kept = F.size("categories") > 0
    priced = pin(
        labelled,
        amount=F.when(kept, wide_amount(body)),
        balance=F.when(kept, wide_balance(body)),
        _clean=F.when(kept, sanitize_body(F.col("sms_body"))),
    )
    first = ["raw_id", "borrower_id", "sender_tag", "categories", "sms_body", "amount", "balance"]
    narrow = priced.select(
        *first[:2], *[F.when(kept, F.col(c)).alias(c) for c in first[2:4]], F.col("_clean").alias("sms_body"), _money("amount"), _money("balance"),
        F.when(kept, F.col("txn_date")).alias("txn_date"), "inbox_time_ms",
        *([_overflow()] if flag_overflow else []),
    )
    survivors = dedup_messages(narrow, untimed_by_content).where(kept)
    parts = time_parts(F.col("inbox_time_ms"), F.col("txn_date"))  # of the survivors alone, so that they do not move
    return survivors.select(*first, *[value.alias(name) for name, value in parts.items()], "inbox_time_ms", *([OVERFLOW] if flag_overflow else []))


def collect_records(
    messages: DataFrame, rules: RuleSet = DEFAULT_RULES, collected_at: Column | None = None
) -> DataFrame:
    """Privacy projection: hashed borrower, tag, masked body.  No noise list, no labels."""
    named = messages.withColumnsRenamed(RENAMES)
    return keep_financial(tag_senders(named, rules), rules).select(
        hash_identifier(F.col("borrower_id")).alias("borrower_id"),
        "sender_tag",
        sanitize_body(F.col("sms_body")).alias("sms_body"),
        "inbox_time_ms",
        (F.current_timestamp() if collected_at is None else collected_at).alias("collected_at"),
    )


def tagged_view(raw: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """One label per message by first match, with its amount; one-time-password bodies are left out."""
    tagged = pin(tag_senders(raw, rules), _body_lower=F.lower(F.col("sms_body")))
    wanted = tagged.where(~F.contains("_body_lower", F.lit("otp")) & ~F.contains("_body_lower", F.lit("one time password")))
    return wanted.select(
        "raw_id",
        "borrower_id",
        "sender_tag",
        "sms_body",
        "inbox_time_ms",
        first_label(F.col("sender_tag"), F.col("_body_lower")).alias("category"),
        view_amount(F.col("_body_lower")).alias("extracted_amount"),
    )


def create_tagged_view(raw: DataFrame, name: str = "v_sms_tagged", rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Register :func:`tagged_view` under a name, replacing what was there."""
    view = tagged_view(raw, rules)
    view.createOrReplaceTempView(name)
    return view

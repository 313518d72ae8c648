"""Masking and money extraction.

Patterns that need Unicode classes spell them out (letters, numbers, underscore)
instead of relying on ``\\b`` and ``\\w``, whose meaning differs between JDKs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import AMOUNT_PATTERNS, BALANCE_PATTERNS, BALANCE_WORDS, CODE_MASK, HANDLE_MASK, VIEW_AMOUNT_PATTERN
from .tagging import any_key

# What masking looks for.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\p{Z}\x1c-\x1f\x85"

# One digit of a free-standing run of N to 18 digits that is not among its last four: the first of such a run, or the one
# right after the digit found before, while four digits follow. So a run is looked at once, not once for each of its digits.
_LEADING_DIGIT = rf"(?:(?<![{WORD}])(?=\p{{Nd}}{{%d,18}}(?![{WORD}]))|(?!^)\G)\p{{Nd}}(?=\p{{Nd}}{{4}})"
_ACCOUNT_PREFIX = rf"(A/?[Cc][{SPACE}#:.]*)\p{{Nd}}+(\p{{Nd}}{{4}})"
_HANDLE = rf"[{WORD}.\-]+@[{WORD}]+"
_SIX_DIGITS = rf"(?<![{WORD}])\p{{Nd}}{{6}}(?![{WORD}])"
_MONEY_CAP = "decimal(38,2)"


def mask_accounts(text: Column, shortest: int = 6) -> Column:
    """Keep the last four digits of runs of ``shortest`` to 18 digits, X for each digit before.

    The replacement keeps the length, so it is one pass that swaps single digits
    rather than one pass per run length.
    """
    masked = F.regexp_replace(text, _LEADING_DIGIT % shortest, "X")
    return F.regexp_replace(masked, _ACCOUNT_PREFIX, "$1XXXX$2")


def sanitize_body(body: Column, otp_first: bool = False) -> Column:
    """Mask accounts, then payment handles; null stays null.

    The rule for six-digit codes (-> 000000) comes last and can then find nothing:
    the account rule has rewritten every free-standing six-digit run, and no rule
    makes a new one.  So it costs no pass here; ``otp_first=True`` runs it in front
    of the others, where it has effect, and leaves longer runs to the account rule.
    """
    text = F.regexp_replace(body, _SIX_DIGITS, CODE_MASK) if otp_first else body
    masked = mask_accounts(text, shortest=7 if otp_first else 6)
    text = F.when(text.rlike(r"\p{Nd}{5}"), masked).otherwise(text)
    # Without an @ sign the handle pattern would only scan every word in vain.
    return F.when(F.contains(body, F.lit("@")), F.regexp_replace(text, _HANDLE, HANDLE_MASK)).otherwise(text)


def _first_money(body: Column, patterns: Iterable[str]) -> Column:
    """First pattern whose first match is a number, in a type wider than money.  A capture of commas only falls to the next pattern.

    White space of the patterns is any Unicode space, as in masking. A number too long even for the wide type is as large
    as that type goes, so that it is seen to be too large.
    """
    wide = [p.replace(r"[:\s]", f"[:{SPACE}]").replace(r"\s*", f"[{SPACE}]*") for p in patterns]
    found = [F.replace(F.regexp_extract(body, p, 1), F.lit(","), F.lit("")) for p in wide]
    return F.coalesce(*[F.coalesce(n.try_cast(_MONEY_CAP), F.when(F.length(n) > 36, F.lit("9" * 36).cast(_MONEY_CAP))) for n in found])


def wide_amount(body_lower: Column, left_boundary: bool = False) -> Column:
    """The number that ``extract_amount`` finds, also where it is too large for the type of money."""
    patterns = AMOUNT_PATTERNS
    if left_boundary:
        patterns = (rf"(?<![{WORD}]){AMOUNT_PATTERNS[0]}", *AMOUNT_PATTERNS[1:])
    return _first_money(body_lower, patterns)


def wide_balance(body_lower: Column) -> Column:
    """The number that ``extract_balance`` finds, also where it is too large for the type of money.

    Every pattern needs one of five words; looking for them first spares most bodies the patterns.
    """
    named = any_key(body_lower, BALANCE_WORDS)
    return F.when(named, _first_money(body_lower, BALANCE_PATTERNS))


def extract_amount(body_lower: Column, left_boundary: bool = False) -> Column:
    """Transaction amount, from the unmasked body in lower case; null where it does not fit in the type.

    ``left_boundary=True`` wants a currency word to start a word ("others 500" gives null).
    """
    return wide_amount(body_lower, left_boundary).try_cast("decimal(15,2)")


def extract_balance(body_lower: Column) -> Column:
    """Account balance, from the unmasked body in lower case; null where it does not fit in the type."""
    return wide_balance(body_lower).try_cast("decimal(15,2)")


def view_amount(body_lower: Column) -> Column:
    """Amount of the tagged view: one pattern, all commas removed, no number gives null."""
    found = F.regexp_extract(body_lower, VIEW_AMOUNT_PATTERN, 1)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("decimal(15,2)")

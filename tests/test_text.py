import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from textledger.functions import (
    content_key, epoch_date, extract_amount, extract_balance, hash_identifier, is_noise, mask_accounts, raw_id,
    sanitize_body, sender_key, sender_tag, time_parts,
)


def test_mask_accounts(column):
    cases = {
        "code 123456": "code XX3456",
        "amt 150000.00": "amt XX0000.00",
        "1234567890123456789": "1234567890123456789",  # 19 digits stay
        "123456789012345678": "X" * 14 + "5678",
        "A/c 12345": "A/c XXXX2345",
        "Ac: #123456789012": "Ac: #XXXXXXXX9012",
        "a/c 12345": "a/c 12345",
        "x12345678": "x12345678",
        "12345": "12345",
        "_123456": "_123456",
        "é123456": "é123456",
        "1234567/123456": "XXX4567/XX3456",
        "क123456": "क123456",
        "काि 123456,१२३४५६": "काि XX3456,XX३४५६",
        None: None,
    }
    assert column(mask_accounts, list(cases)) == list(cases.values())


def test_mask_matches_brute_force_and_is_idempotent(column):
    rng = random.Random(7)
    alphabet = "0123456789" * 6 + "aX_.,-/ @é#:A/cि"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(3000)]

    def slow(text):
        words = re.findall(r"\w+|\W+", text)
        text = "".join("X" * (len(w) - 4) + w[-4:] if re.fullmatch(r"\d{6,18}", w) else w for w in words)
        return re.sub(r"(A/?[Cc][\s#:.]*)\d+(\d{4})", lambda m: m[1] + "XXXX" + m[2], text)

    once = column(mask_accounts, texts)
    assert once == [slow(t) for t in texts]
    assert column(mask_accounts, once) == once
    assert not any(re.search(r"\b\d{6,18}\b", t) for t in once)


def test_sanitize_order_and_handles(column):
    cases = {
        "code 123456": "code XX3456",
        "pay to joe@okbank now": "pay to XXXX@upi now",
        "a.b@mail.example": "XXXX@upi.example",
        "a@b.c@d": "XXXX@upiXXXX@upi",
        "no digits": "no digits",
        "Ref: 557710342": "Ref: XXXXX0342",
        None: None,
    }
    assert column(sanitize_body, list(cases)) == list(cases.values())
    assert column(lambda c: sanitize_body(c, otp_first=True), ["code 123456 or 1234567"]) == ["code 000000 or XXX4567"]


def test_code_rule_is_dead_after_masking(column):
    rng = random.Random(11)
    texts = ["".join(rng.choice("0123456789@.a A/c-") for _ in range(40)) for _ in range(2000)]
    assert not any(re.search(r"\b\d{6}\b", t) for t in column(sanitize_body, texts))


def test_amount(column):
    cases = {
        "INR 1,23,456.78": Decimal("123456.78"),
        "₹ 2000": Decimal("2000"),
        "Rs\u00a0640 paid": Decimal("640"),
        "amount:\u202f75": Decimal("75"),
        "Rs1500": Decimal("1500"),
        "500 rs": Decimal("500"),
        "no money": None,
        "others 500": Decimal("500"),
        "Rs , then 700 inr": Decimal("700"),
        "amount: 42.5": Decimal("42.5"),
        "Rs.10.999": Decimal("10.99"),
        "Rs 99999999999999999999": None,  # larger than the money type holds
        "": None,
        None: None,
    }
    lowered = lambda c: extract_amount(F.lower(c))
    assert column(lowered, list(cases)) == list(cases.values())
    bounded = lambda c: extract_amount(F.lower(c), left_boundary=True)
    assert column(bounded, ["others 500", "Rs 5"]) == [None, Decimal("5")]


def test_balance(column):
    cases = {
        "Bal: ₹5000": Decimal("5000"),
        "Available balance is ₹5000": None,
        "current a/c XX1234": Decimal("1234"),
        "Avl Bal: Rs.12,345.67": Decimal("12345.67"),
        "nothing here 12": None,
        None: None,
    }
    assert column(lambda c: extract_balance(F.lower(c)), list(cases)) == list(cases.values())


@pytest.mark.parametrize(
    "sender, tag",
    [
        (None, "OTHER"), ("", "OTHER"), ("   ", "OTHER"), (" HDFCBK ", "BANK"), ("\thdfcbk", "BANK"),
        ("　HDFCBK\xa0", "BANK"), ("620016", "LENDER"), ("blinkr", "OTP_SENDER"), ("securebank", "OTP_SENDER"),
        ("bankfin", "BANK"), ("xyzfinpay", "LENDER"), ("mypay", "UPI"), ("randomco", "OTHER"), ("lazpay", "LENDER"),
        ("paysns", "LENDER"), ("hdbfsl", "LENDER"), ("kvbupi", "BANK"), ("postpe", "UPI"), ("vm-hdfcbk", "BANK"),
        ("vm-navi", "OTHER"), ("monvew", "LENDER"), ("paytmb", "UPI"), ("sbipsg", "BANK"), ("loan12", "LENDER"),
    ],
)
def test_sender_tag(column, sender, tag):
    assert column(lambda c: sender_tag(sender_key(c)), [sender]) == [tag]


def test_noise(column):
    lowered = lambda c: is_noise(F.lower(c))
    bodies = [None, "", "Hotplate debited", "credited Rs 5", "UNSUBSCRIBE", "don't share"]
    assert column(lowered, bodies) == [True, True, True, False, True, True]


def test_time_parts_do_not_depend_on_the_zone(spark):
    rows = [(1688212340000,), (1719835000123,), (0,), (None,), (-1,), (2**62,), (86399999,), (951782400000,)]
    df = spark.createDataFrame(rows, "ms long")
    got = df.select("ms", *[v.alias(k) for k, v in time_parts(F.col("ms")).items()]).collect()
    parts = {r.ms: (r.txn_year, r.txn_month, str(r.txn_date), r.txn_hour) for r in got}
    assert parts[1688212340000] == (2023, 7, "2023-07-01", 11)
    assert parts[1719835000123] == (2024, 7, "2024-07-01", 11)
    assert parts[-1] == (1969, 12, "1969-12-31", 23)
    assert parts[86399999] == (1970, 1, "1970-01-01", 23)
    assert parts[951782400000] == (2000, 2, "2000-02-29", 0)
    assert parts[0] == parts[None] == parts[2**62] == (None, None, "None", None)
    landing = df.select("ms", epoch_date(F.col("ms")).alias("d")).collect()
    assert str({r.ms: r.d for r in landing}[0]) == "1970-01-01"


def test_ids_tell_nulls_and_borders_apart(spark):
    rows = [("a", "b", 1), ("ab", "", 1), ("a", None, 1), ("a", "", 1), (None, "b", 1), ("", "b", 1)]
    df = spark.createDataFrame(rows, "b string, t string, ms long")
    key = content_key(F.col("b"), F.col("t"), F.col("ms"))
    ids = raw_id(F.col("b"), F.lit("s"), F.col("t"), F.col("ms"))
    assert df.select(key.alias("k")).distinct().count() == df.select(ids.alias("k")).distinct().count() == len(rows)
    digest = spark.range(1).select(hash_identifier(F.lit("abc")).alias("h")).first().h
    assert digest == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"

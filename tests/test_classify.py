from decimal import Decimal

from pyspark.sql import functions as F

from textledger import Label, RuleSet
from textledger.operators.classify import (
    classify, classify_deduplicated, collect_records, create_tagged_view, label_messages, tag_senders, tag_senders_from, to_raw,
)
from textledger.operators.dedup import dedup_content, dedup_messages
from textledger.rules import DEFAULT_RULES, EXCLUSIONS, LABELS, SENDER_HEADERS, shortest_keys
from textledger.schemas import CLASSIFIED, RAW_INPUT

SAMPLES = [
    ("north1", "hdfcbk", "Dear client, INR 7400 deposited into a/c XX8841, closing balance INR 19250", 1688212340000),
    ("north1", "blinkr", "Use code 904417 to sign in", 1688212341000),
    ("south2", "kotakb", "NACH debit of Rs.2750 done for installment, a/c XX3390", 1688212342000),
    ("south2", "hdfcbk", "Payroll: INR 31000 received in your account", 1688212343000),
    ("west3", "jiopay", "Sent to Hilltop wine shop by UPI: Rs.640, txn no 557710342", 1688212344000),
    ("east4", "hdfcbk", "INR 6100.00 added to a/c XX7702 on 3-Jul. Current balance: INR 20418.35", 1719835000123),
]


def messages(spark, rows):
    return spark.createDataFrame([(c, "h", s, b, ms) for c, s, b, ms in rows], RAW_INPUT)


def labels_of(spark, sender, body, rules=DEFAULT_RULES):
    rows = label_messages(to_raw(messages(spark, [("c", sender, body, 1)])), rules).collect()
    return rows[0].categories if rows else None


def test_sample_messages(spark):
    got = {r.inbox_time_ms: r for r in classify(to_raw(messages(spark, SAMPLES))).collect()}
    assert 1688212341000 not in got and len(got) == 5
    expected = {
        1688212340000: ("BANK", ["BANK_CREDIT", "BALANCE_INQUIRY"], "7400.00", "19250.00"),
        1688212342000: ("BANK", ["BANK_DEBIT", "EMI_PAYMENT"], "2750.00", None),
        1688212343000: ("BANK", ["BANK_CREDIT", "SALARY_CREDIT"], "31000.00", None),
        1688212344000: ("UPI", ["UPI_PAYMENT", "ALCOHOL_SPEND"], "640.00", None),
        1719835000123: ("BANK", ["BANK_CREDIT", "BALANCE_INQUIRY"], "6100.00", "20418.35"),
    }
    for ms, (tag, labels, amount, balance) in expected.items():
        row = got[ms]
        assert (row.sender_tag, row.categories) == (tag, labels)
        assert row.amount == Decimal(amount) and row.balance == (balance and Decimal(balance))
    assert got[1688212344000].sms_body.endswith("txn no XXXXX0342")
    assert got[1719835000123].sms_body == SAMPLES[5][2]
    assert (str(got[1688212340000].txn_date), got[1688212340000].txn_hour) == ("2023-07-01", 11)


def test_every_header_keeps_its_tag(spark):
    rows = [(h, tag) for tag, headers in SENDER_HEADERS.items() for h in headers]
    assert len({h for h, _ in rows}) == len(rows) == 209
    df = spark.createDataFrame(rows, "sms_sender string, wanted string")
    for rules in (DEFAULT_RULES, RuleSet(sender_keywords={"UPI": ("bk",)}), RuleSet(sender_keywords={})):
        assert tag_senders(df, rules).where("sender_tag <> wanted").count() == 0


def test_rule_edges(spark):
    assert labels_of(spark, "navi", "payment reminder") == ["EMI_PAYMENT", "LOAN_REMINDER"]
    assert labels_of(spark, "hdfcbk", "hotplate debited") is None
    assert labels_of(spark, "hdfcbk", "salary advance credited") == ["BANK_CREDIT"]
    assert labels_of(spark, "hdfcbk", "upi to x failed") == ["FAILED_TRANSACTION"]
    assert labels_of(spark, "navi", "personal loan, apply now") is None
    assert labels_of(spark, "gpay", "salary credited") == ["BANK_CREDIT"]
    assert labels_of(spark, "hdfcbk", "nothing to see") is None
    assert labels_of(spark, "hdfcbk", None) is None


def test_vetoes_count_under_other_exclusions(spark):
    open_rules = RuleSet(exclusions=())
    assert labels_of(spark, "hdfcbk", "offer: credited", open_rules) is None
    assert labels_of(spark, "navi", "loan disbursed, offer", open_rules) is None
    assert labels_of(spark, "hdfcbk", "sent to upi, failed", open_rules) == ["FAILED_TRANSACTION"]


def test_word_boundary_option(spark):
    words = RuleSet(word_boundary=True)
    assert labels_of(spark, "navi", "insurance premium, kindly pay", words) == ["LOAN_REMINDER"]
    assert labels_of(spark, "navi", "your emi: kindly pay", words) == ["EMI_PAYMENT", "LOAN_REMINDER"]


def test_shortest_keys_decide_like_all_keys():
    for keys in [EXCLUSIONS, *[label.include for label in LABELS]]:
        short = shortest_keys(keys)
        assert set(short) <= set(keys)
        assert all(any(s in k for s in short) for k in keys)


def test_rule_table(spark):
    rows = [("FEE", ["BANK"], "fee", "include"), ("FEE", ["BANK"], "refund", "exclude")]
    table = spark.createDataFrame(rows, "label string, tags array<string>, keyword string, kind string")
    rules = RuleSet.from_table(table)
    assert rules.labels == (Label("FEE", ("BANK",), ("fee",), ("refund",)),)
    assert labels_of(spark, "hdfcbk", "late fee", rules) == ["FEE"]
    assert labels_of(spark, "hdfcbk", "late fee refund", rules) is None


def test_dictionary_table(spark):
    known = spark.createDataFrame([("randomco", "BANK"), ("blinkr", "UPI")], "sender_key string, tag string")
    df = spark.createDataFrame([(" RandomCo",), ("blinkr",), ("mypay",), (None,)], "sms_sender string")
    got = {r.sms_sender: r.sender_tag for r in tag_senders_from(df, known).collect()}
    assert got == {" RandomCo": "BANK", "blinkr": "UPI", "mypay": "UPI", None: "OTHER"}


def test_labels_fit_the_tag(spark):
    allowed = {label.name: set(label.tags) for label in LABELS}
    body = "upi credit debit salary loan disbursed emi due date avl bal wine declined"
    rows = [("c", s, body, 1) for s in ("hdfcbk", "gpay", "navi")]
    for row in label_messages(to_raw(messages(spark, rows))).collect():
        assert set(row.categories) == {name for name, tags in allowed.items() if row.sender_tag in tags}


def test_empty_input_keeps_the_schema(spark):
    got = classify(to_raw(messages(spark, [])))
    assert got.count() == 0
    assert got.schema.simpleString() == CLASSIFIED.simpleString()


def test_collect_records(spark):
    rows = [*SAMPLES[:2], ("zz", "hdfcbk", None, 5), ("zz", "hdfcbk", "offer 1234567", 6)]
    got = {r.inbox_time_ms: r for r in collect_records(messages(spark, rows)).collect()}
    assert set(got) == {1688212340000, 5, 6}  # no noise list here, and a null body does not fail
    assert got[5].sms_body is None and got[6].sms_body == "offer XXX4567"
    assert len(got[6].borrower_id) == 64


def test_dedup_keys(spark):
    rows = [("a", "hdfcbk", "x credited", 1), ("a", "hdfcbk", "y credited", 1), ("a", "hdfcbk", "y credited", 1), ("a", "hdfcbk", "y credited", 2)]
    raw = to_raw(messages(spark, rows))
    assert dedup_messages(raw).count() == 2
    assert dedup_content(raw).count() == 3
    again = dedup_messages(raw.repartition(7)).orderBy("inbox_time_ms").collect()
    assert again == dedup_messages(raw).orderBy("inbox_time_ms").collect()


def test_classify_deduplicated_equals_the_two_steps(spark):
    rows = [("a", s, b, ms) for ms in range(20) for s in ("hdfcbk", "blinkr", None, "navi") for b in ("credited Rs 5", "offer", None, "emi 9 rs", "")]
    raw = to_raw(messages(spark, rows))
    one, two = classify_deduplicated(raw), classify(dedup_messages(raw))
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0 and one.count() > 0


def test_tagged_view(spark):
    rows = [
        ("a", "hdfcbk", "Salary credited Rs 1,23,456.50", 1), ("a", "gpay", "salary credited amount 7", 2),
        ("a", "hdfcbk", "emi debited", 3), ("a", "hdfcbk", "loan disbursed INR 5", 4), ("a", "hdfcbk", "declined, credited", 5),
        ("a", "hdfcbk", "dr rs 9", 6), ("a", "x", "hello", 7), ("a", "hdfcbk", "one time password", 8), ("a", "hdfcbk", None, 9),
    ]
    create_tagged_view(to_raw(messages(spark, rows)), "v_test_tagged")
    got = {r.inbox_time_ms: (r.category, r.extracted_amount) for r in spark.table("v_test_tagged").collect()}
    assert got == {
        1: ("SALARY_CREDIT", Decimal("123456.50")), 2: ("BANK_CREDIT", Decimal("7.00")), 3: ("EMI_PAYMENT", None),
        4: ("LOAN_DISBURSEMENT", Decimal("5.00")), 5: ("FAILED_TRANSACTION", None), 6: ("BANK_DEBIT", Decimal("9.00")),
        7: ("UNCATEGORISED", None),
    }

"""Message tables derived from the given tables.

The data set has no message table.  One message is derived from each ``lineitem``
row: supplier -> borrower, ship date plus an offset -> time, prices -> money in
the text, and keys pick the sender and one of the body shapes.  The SQL is
written once in a form that Spark and DuckDB both read; only the conversion of a
timestamp to epoch milliseconds differs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW_INPUT

SENDERS: tuple[str, ...] = (
    "'hdfcbk'", "'kotakb'", "' ICICIB '", "'VM-SBIINB'", "'axisbk'", "'indusb'", "'citibn'", "'tjsb'",
    "'jiopay'", "'airtel'", "'gpay'", "'mypay'", "'amazon'", "'JD-PAYTMB'",
    "'bajajf'", "'620016'", "'kreditb'", "'navi'", "'xyzfinpay'", "'snpmnt'",
    "'blinkr'", "'securebank'", "'randomco'", "'AD-SHOPPY'", "NULL",
)

# Body shapes; the names in braces are replaced by text made from the row's keys and price.
FIELDS = ("amt", "more", "grp", "acct", "tail", "ref", "code", "okey")
BODIES: tuple[str | None, ...] = (
    "Dear client, Rs.{amt} was credited to A/c XX{tail}, closing balance Rs.{more}",
    "{code} is the OTP for your sign-in",
    "NACH debit of Rs.{amt} done for EMI, A/c XX{tail}",
    "Payroll: salary Rs.{amt} received in A/c {acct}",
    "Sent to Hilltop liquor by UPI: Rs.{amt}, txn no {ref}",
    "INR {grp} debited from A/c {acct} on 9th June. Available balance is ₹{more}",
    "Dear customer, ₹ {grp} spent at POS TXN wine shop. Bal: ₹{more}",
    "Your payment of Rs {amt} failed due to insufficient funds. Ref {ref}",
    "UPI payment to joe.{okey}@okbank of {amt} rs declined",
    "Loan disbursed: amount {amt} to account {acct}",
    "Reminder: your loan EMI of Rs.{amt} is overdue. Kindly pay before due date.",
    "Get cashback offer up to Rs.{amt} on your next recharge",
    "Your order {ref} is out for delivery",
    "Hello from {okey}, see you at 5",
    "Received Rs.{grp} from ravi.k@upi\nUPI Ref {acct}",
    "Salary advance of INR {amt} credited. Balance is Rs {more}",
    "Personal loan approved. Apply now for Rs {amt}",
    "Personal loan of Rs {amt} sanctioned, amount released to A/c:{acct}",
    "Transaction failed: auto debit EMI Rs.{amt} for a/c {acct}",
    'Paid {grp} INR to BEER "BAR " on card {acct}{code}{ref}',
    "Standing instruction executed, installment {amt}, ledger balance Rs {more}",
    "Rs , then {amt} inr added to wallet",
    "Insurance premium of Rs.{amt} due. Last date 10th. Others 500",
    "Current a/c XX{tail} credit INR{amt}; closing balance INR{more}",
    "Mail help.desk@mail.example or call {acct} for statement",
    "Monthly pay stipend Rs.{amt} deposited by NEFT, funds received",
    "NACH return: low balance. Amount: Rs {amt} outstanding",
    "लोन: Rs.{amt} debit कार्ड{code} vpa अमित@ybl",
    "ATM withdrawal Rs.{amt} from x{acct}. Avl bal Rs.{more}",
    "Login attempt from new device, code {code}",
    "Debit of Rs\u00a0{amt} at POS. Bal:\u00a0{more}",
    "",
    None,
)


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\n", "{nl}") + "'"


def _replaced_body() -> str:
    """The body shape with each field put in by ``replace``."""
    body = f"CASE body_no {' '.join(f'WHEN {i} THEN {_text(b)}' for i, b in enumerate(BODIES))} END"
    for name in FIELDS:
        body = f"replace({body}, '{{{name}}}', {name})"
    return f"replace({body}, '{{nl}}', chr(10))"


def _joined_body() -> str:
    """The same text from the pieces of a shape and the fields between them: a few look-ups a row where the replaces scan it nine times.

    A body is null, too, where the price is null.
    """
    shapes = [re.split(r"\{(\w+)\}", b) if b is not None else [None] for b in BODIES]
    most = max(len(s) for s in shapes)
    parts = []
    for k in range(most):
        if k % 2:
            places = ", ".join(str(FIELDS.index(s[k]) if k < len(s) else len(FIELDS)) for s in shapes)
            parts.append(f"get(fields, get(array({places}), body_no))")
        else:
            texts = ", ".join(f"replace({_text(s[k] if k < len(s) else '')}, '{{nl}}', chr(10))" for s in shapes)
            parts.append(f"get(array({texts}), body_no)")
    return f"CASE WHEN amt IS NOT NULL THEN concat({', '.join(parts)}) END"


def messages_sql(spark_dialect: bool, source: str = "lineitem") -> str:
    """SELECT that derives the raw input columns from ``source``."""
    ms = (
        "timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', l_shipdate)"
        if spark_dialect
        else "epoch_ms(l_shipdate)"
    )
    senders = " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(SENDERS))
    body = _joined_body() if spark_dialect else _replaced_body()
    fields = f",\n         array({', '.join(FIELDS)}, '') AS fields" if spark_dialect else ""
    money = lambda cents: (
        f"concat(CAST(CAST(floor({cents} / 100) AS BIGINT) AS STRING), '.', "
        f"lpad(CAST({cents} % 100 AS STRING), 2, '0'))"
    )
    # String literals must mean the same in both engines: no backslashes are used.
    return f"""
SELECT CASE WHEN drop_id = 0 THEN NULL ELSE concat('B', lpad(CAST(l_suppkey AS STRING), 6, '0')) END AS customer_id,
       concat('h', okey) AS hash,
       CASE sender_no {senders} END AS sms_sender,
       {body} AS sms_body,
       CASE WHEN l_partkey % 499 = 0 AND l_linenumber = 1 THEN 0
            WHEN l_partkey % 499 = 1 AND l_linenumber = 1 THEN NULL
            ELSE day_ms + (l_partkey % 24) * 3600000 END AS inbox_time_in_millis
FROM (
  SELECT l_suppkey, l_partkey, l_linenumber, day_ms,
         CAST(l_orderkey AS STRING) AS okey,
         (l_orderkey + l_linenumber) % {len(SENDERS)} AS sender_no,
         (l_partkey + l_linenumber * 5 + l_orderkey) % {len(BODIES)} AS body_no,
         (l_partkey + l_orderkey) % 211 AS drop_id,
         {money("cents")} AS amt,
         {money("(cents * (l_linenumber + 1))")} AS more,
         CASE WHEN cents >= 100000
              THEN concat(CAST(CAST(floor(cents / 100000) AS BIGINT) AS STRING), ',',
                          lpad(CAST(CAST(floor(cents / 100) AS BIGINT) % 1000 AS STRING), 3, '0'), '.',
                          lpad(CAST(cents % 100 AS STRING), 2, '0'))
              ELSE {money("cents")} END AS grp,
         lpad(CAST(l_orderkey * 7919 + 100000000000 AS STRING), 12, '0') AS acct,
         right(CAST(l_orderkey * 7919 + 100000000000 AS STRING), 4) AS tail,
         lpad(CAST(l_partkey * 31 + 100000000 AS STRING), 9, '0') AS ref,
         lpad(CAST((l_partkey * 17 + l_orderkey) % 1000000 AS STRING), 6, '0') AS code{fields}
  FROM (
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
           CAST({ms} AS BIGINT) AS day_ms
    FROM {source}
  ) AS priced
) AS shaped
"""


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sms_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived raw input (see :data:`textledger.schemas.RAW_INPUT`)."""
    return derive_messages(read_table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS))


def derive_messages(lines: DataFrame) -> DataFrame:
    lines.createOrReplaceTempView("_lines_of_messages")
    messages = lines.sparkSession.sql(messages_sql(True, "_lines_of_messages"))
    return messages.select(*[messages[f.name].cast(f.dataType).alias(f.name) for f in RAW_INPUT])

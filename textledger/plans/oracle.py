"""The registered queries again, as SQL for DuckDB.

Written from the definitions, in other ways than the Spark operators where there
is a choice: windows instead of aggregates, word lists instead of look-around,
every keyword instead of the shortest ones.  Only the rule data and the derived
input are shared.
"""

from __future__ import annotations

from ..rules import (
    AMOUNT_PATTERNS, BALANCE_PATTERNS, EXCLUSIONS, LABELS, SENDER_HEADERS, SENDER_KEYWORDS,
)
from .inputs import messages_sql
from .registry import AS_OF, CUT, LAST_YEAR, LOOKUP_ID, OTHER_KEYWORDS, QUIET_DATE, RUN_DATE, STAMPS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _any(column: str, keys) -> str:
    return f"len(list_filter({_list(keys)}, lambda k: contains({column}, k))) > 0"


def _tag(key: str, exceptions: bool = True, keywords=SENDER_KEYWORDS) -> str:
    arms = []
    if exceptions:
        arms += [f"WHEN list_contains({_list(h)}, {key}) THEN '{t}'" for t, h in SENDER_HEADERS.items()]
    arms += [f"WHEN {_any(key, k)} THEN '{t}'" for t, k in keywords.items()]
    return f"CASE {' '.join(arms)} ELSE 'OTHER' END"


def _labels(tag: str, body: str) -> str:
    arms = []
    for label in LABELS:
        test = f"list_contains({_list(label.tags)}, {tag}) AND {_any(body, label.include)}"
        test += f" AND NOT {_any(body, label.exclude)}"
        arms.append(f"CASE WHEN {test} THEN '{label.name}' END")
    return f"concat_ws('|', {', '.join(arms)})"


_SPACE = r"\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}"


def _money(body: str, patterns) -> str:
    found = [
        f"TRY_CAST(nullif(replace(regexp_extract({body}, {_text('(?i)' + p.replace("[:\\s]", "[:" + _SPACE + "]").replace("\\s*", "[" + _SPACE + "]*"))}, 1), ',', ''), '') AS DECIMAL(15,2))"
        for p in patterns
    ]
    return f"coalesce({', '.join(found)})"


_KNOWN = _list(h for headers in SENDER_HEADERS.values() for h in headers)
WORDS = r"'[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+'"


def _mask(text: str, shortest: int = 6) -> str:
    """Split into words and gaps; a word of 6 to 18 digits keeps its last four."""
    runs = (
        f"array_to_string(list_transform(regexp_extract_all({text}, {WORDS}), lambda w: "
        rf"CASE WHEN regexp_full_match(w, '\p{{Nd}}{{{shortest},18}}') "
        "THEN repeat('X', length(w) - 4) || right(w, 4) ELSE w END), '')"
    )
    return (
        rf"regexp_replace({runs}, '(A/?[Cc][\s\p{{Z}}\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}#:.]*)\p{{Nd}}+(\p{{Nd}}{{4}})', "
        r"'\1XXXX\2', 'g')"
    )


def _codes(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, {WORDS}), lambda w: "
        r"CASE WHEN regexp_full_match(w, '\p{Nd}{6}') THEN '000000' ELSE w END), '')"
    )


def _handles(text: str) -> str:
    return rf"regexp_replace({text}, '[\p{{L}}\p{{N}}_.\-]+@[\p{{L}}\p{{N}}_]+', 'XXXX@upi', 'g')"


def _sanitize(text: str) -> str:
    return _codes(_handles(_mask(text)))


_ID = (
    "sha256(concat_ws(chr(31), coalesce(borrower_id, chr(30)), coalesce(sms_sender, chr(30)), "
    "coalesce(sms_body, chr(30)), coalesce(CAST(inbox_time_ms AS VARCHAR), chr(30))))"
)

MSG = f"""msg AS ({messages_sql(False)}),
raw AS (
  SELECT {_ID} AS raw_id, *, CAST(epoch_ms(inbox_time_ms) AS DATE) AS txn_date
  FROM (SELECT customer_id AS borrower_id, sms_sender, sms_body,
               CAST(inbox_time_in_millis AS BIGINT) AS inbox_time_ms FROM msg)
)"""

TAGGED = f"""{MSG},
tagged AS (
  SELECT *, {_tag("sender")} AS sender_tag, lower(sms_body) AS low
  FROM (SELECT *, coalesce(trim(lower(sms_sender)), '') AS sender FROM raw)
)"""

LABELLED = f"""{TAGGED},
labelled AS (
  SELECT * FROM (
    SELECT *, {_labels("sender_tag", "low")} AS categories FROM tagged
    WHERE sender_tag IN ('BANK', 'UPI', 'LENDER') AND low IS NOT NULL AND low <> '' AND NOT {_any("low", EXCLUSIONS)}
  ) WHERE categories <> ''
)"""

_KNOWN_DATE = "CASE WHEN inbox_time_ms <> 0 THEN txn_date END"
_HOUR = "CAST(CASE WHEN inbox_time_ms <> 0 THEN (inbox_time_ms // 3600000) % 24 END AS BIGINT)"

CLASSIFIED = f"""{LABELLED},
classified AS (
  SELECT raw_id, borrower_id, sender, sender_tag, categories, sms_body, inbox_time_ms, txn_date AS raw_date,
         {_money("sms_body", AMOUNT_PATTERNS)} AS amount, {_money("sms_body", BALANCE_PATTERNS)} AS balance,
         {_KNOWN_DATE} AS txn_date, {_HOUR} AS txn_hour,
         '|' || categories || '|' AS cats
  FROM labelled
)"""


def _has(*labels: str) -> str:
    return "(" + " OR ".join(f"contains(cats, '|{name}|')" for name in labels) + ")"


CREDIT, DEBIT = _has("BANK_CREDIT", "SALARY_CREDIT"), _has("BANK_DEBIT", "UPI_PAYMENT")
EMI, LOAN, FAILED = _has("EMI_PAYMENT"), _has("LOAN_DISBURSEMENT"), _has("FAILED_TRANSACTION")


def _count(test: str) -> str:
    return f"CAST(sum(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT)"


def _sum(test: str, value: str = "amount") -> str:
    return f"CAST(coalesce(sum(CASE WHEN {test} THEN {value} END), 0) AS DECIMAL(15,2))"


def _features(where: str, source: str = "classified") -> str:
    """CTEs base (rows), balances, momentum, features."""
    return f"""
base AS (
  SELECT *, max(inbox_time_ms) OVER (PARTITION BY borrower_id) - inbox_time_ms AS age
  FROM {source} WHERE borrower_id IS NOT NULL AND {where}
),
balances AS (
  SELECT borrower_id, balance AS last_known_balance FROM (
    SELECT borrower_id, balance,
           row_number() OVER (PARTITION BY borrower_id ORDER BY inbox_time_ms DESC NULLS LAST, balance DESC) AS rn
    FROM base WHERE balance IS NOT NULL AND inbox_time_ms IS NOT NULL
  ) WHERE rn = 1
),
sums AS (
  SELECT borrower_id, count(*) AS total_financial_sms_90d,
    CAST(epoch_ms(min(inbox_time_ms)) AS DATE) AS earliest_sms_date,
    CAST(epoch_ms(max(inbox_time_ms)) AS DATE) AS latest_sms_date,
    {_count(CREDIT)} AS count_credit_txn_90d, {_sum(CREDIT)} AS sum_credit_amount_90d,
    coalesce(max(CASE WHEN {CREDIT} THEN amount END), 0) AS max_single_credit_90d,
    {_count(_has("SALARY_CREDIT"))} AS count_salary_credits_90d,
    {_count(DEBIT)} AS count_debit_txn_90d, {_sum(DEBIT)} AS sum_debit_amount_90d,
    {_count(LOAN)} AS count_loan_disbursement_90d, {_sum(LOAN)} AS sum_loan_disbursement_amount_90d,
    {_count(EMI)} AS count_emi_payment_90d, {_sum(EMI)} AS sum_emi_amount_90d,
    {_count(FAILED)} AS count_bounce_txn_90d, {_count(_has("LOAN_REMINDER"))} AS count_loan_reminders_90d,
    min(balance) AS min_balance_seen_90d,
    {_sum(CREDIT + " AND age < 2592000000")} AS m1,
    {_sum(CREDIT + " AND age >= 2592000000 AND age < 5184000000")} AS m2
  FROM base GROUP BY borrower_id
),
features AS (
  SELECT *,
    CASE WHEN risk_score >= 60 THEN 'HIGH' WHEN risk_score >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_flag
  FROM (
    SELECT *, CAST(least(100, CASE WHEN count_bounce_txn_90d > 0 THEN 30 ELSE 0 END
        + CASE WHEN count_loan_disbursement_90d > 3 THEN 20 ELSE 0 END
        + CASE WHEN sum_emi_amount_90d / (sum_credit_amount_90d + 1) > 0.5 THEN 40 ELSE 0 END
        + CASE WHEN credit_momentum < 0.8 THEN 10 ELSE 0 END) AS BIGINT) AS risk_score
    FROM (
      SELECT s.*, b.last_known_balance,
        CASE WHEN sum_credit_amount_90d <> 0
             THEN CAST(sum_emi_amount_90d AS DOUBLE) / CAST(sum_credit_amount_90d AS DOUBLE) END AS foir_proxy_90d,
        CASE WHEN m2 > 0 THEN CAST(m1 AS DOUBLE) / CAST(m2 AS DOUBLE) ELSE 1.0::DOUBLE END AS credit_momentum
      FROM sums s LEFT JOIN balances b ON s.borrower_id = b.borrower_id
    )
  )
)"""


def _lookback(days: int, as_of: str = AS_OF) -> str:
    return f"txn_date >= DATE '{as_of}' - INTERVAL {days} DAY"


_MONEY = (
    "sum_credit_amount_90d", "max_single_credit_90d", "sum_debit_amount_90d", "sum_loan_disbursement_amount_90d",
    "sum_emi_amount_90d", "last_known_balance", "min_balance_seen_90d",
)


def _out(names: str) -> str:
    """Select list with money as double and dates as text."""
    items = []
    for name in names.split():
        if name in _MONEY or name in ("amount", "balance"):
            items.append(f"CAST({name} AS DOUBLE) AS {name}")
        elif name.endswith("_date"):
            items.append(f"CAST({name} AS VARCHAR) AS {name}")
        else:
            items.append(name)
    return ", ".join(items)


LOCAL_COLUMNS = (
    "borrower_id total_financial_sms_90d count_credit_txn_90d sum_credit_amount_90d count_debit_txn_90d "
    "sum_debit_amount_90d count_loan_disbursement_90d count_emi_payment_90d sum_emi_amount_90d "
    "count_bounce_txn_90d latest_sms_date last_known_balance credit_momentum risk_score risk_flag"
)
WAREHOUSE_COLUMNS = (
    "borrower_id total_financial_sms_90d count_credit_txn_90d sum_credit_amount_90d count_debit_txn_90d "
    "sum_debit_amount_90d count_loan_disbursement_90d count_emi_payment_90d sum_emi_amount_90d "
    "count_bounce_txn_90d earliest_sms_date latest_sms_date last_known_balance"
)
TABLE_COLUMNS = (
    "borrower_id total_financial_sms_90d earliest_sms_date latest_sms_date count_credit_txn_90d "
    "sum_credit_amount_90d max_single_credit_90d count_salary_credits_90d count_debit_txn_90d "
    "sum_debit_amount_90d count_loan_disbursement_90d sum_loan_disbursement_amount_90d count_emi_payment_90d "
    "sum_emi_amount_90d count_bounce_txn_90d count_loan_reminders_90d last_known_balance min_balance_seen_90d "
    "foir_proxy_90d credit_momentum risk_score risk_flag"
)
UPSERT_COLUMNS = (
    "borrower_id total_financial_sms_90d count_credit_txn_90d sum_credit_amount_90d count_emi_payment_90d "
    "sum_emi_amount_90d count_bounce_txn_90d"
)

_NARROW = f"""
    SELECT borrower_id, count(*) AS total_financial_sms_90d,
      {_count(_has("BANK_CREDIT"))} AS count_credit_txn_90d, {_sum(_has("BANK_CREDIT"))} AS sum_credit_amount_90d,
      {_count(EMI)} AS count_emi_payment_90d, {_sum(EMI)} AS sum_emi_amount_90d,
      {_count(FAILED)} AS count_bounce_txn_90d
    FROM classified WHERE borrower_id IS NOT NULL AND {{where}} GROUP BY borrower_id"""

_CLASSIFIED_OUT = (
    "raw_id, borrower_id, sender_tag, categories, {body} AS sms_body, CAST(amount AS DOUBLE) AS amount, "
    "CAST(balance AS DOUBLE) AS balance, year(txn_date) AS txn_year, month(txn_date) AS txn_month, "
    "CAST(txn_date AS VARCHAR) AS txn_date, txn_hour, inbox_time_ms"
).format(body=_sanitize("sms_body"))


def _merged() -> str:
    listed = UPSERT_COLUMNS.split()[1:]
    zero_for_new = {
        "max_single_credit_90d", "count_salary_credits_90d", "count_debit_txn_90d", "sum_debit_amount_90d",
        "count_loan_disbursement_90d", "sum_loan_disbursement_amount_90d", "count_loan_reminders_90d",
    }
    items = ["coalesce(f.borrower_id, u.borrower_id) AS borrower_id"]
    for name in TABLE_COLUMNS.split()[1:]:
        if name in listed:
            value = f"CASE WHEN u.borrower_id IS NOT NULL THEN u.{name} ELSE f.{name} END"
        elif name in zero_for_new:
            value = f"CASE WHEN f.borrower_id IS NULL THEN 0 ELSE f.{name} END"
        else:
            value = f"f.{name}"
        if name in _MONEY:
            value = f"CAST({value} AS DOUBLE)"
        elif name.endswith("_date"):
            value = f"CAST({value} AS VARCHAR)"
        items.append(f"{value} AS {name}")
    before = f"txn_date <= DATE '{CUT}' AND {_lookback(90, CUT)}"
    return (
        f"WITH {CLASSIFIED}, {_features(before)}, narrow AS ({_NARROW.format(where=_lookback(90))}) "
        f"SELECT {', '.join(items)} FROM features f FULL OUTER JOIN narrow u ON f.borrower_id = u.borrower_id"
    )


def _average(test: str, value: str) -> str:
    hit = f"CASE WHEN {test} THEN {value} END"
    return f"CAST(sum({hit}) AS DOUBLE) / nullif(count({hit}), 0)"


_ALCOHOL, _UPI, _SALARY = _has("ALCOHOL_SPEND"), _has("UPI_PAYMENT"), _has("SALARY_CREDIT")
PROFILE = f"""{CLASSIFIED},
picked AS (SELECT * FROM classified WHERE borrower_id IS NOT NULL AND {_lookback(LAST_YEAR)}),
newest AS (
  SELECT borrower_id, balance AS latest FROM (
    SELECT borrower_id, balance, row_number() OVER (PARTITION BY borrower_id ORDER BY inbox_time_ms DESC, balance DESC) AS rn
    FROM picked WHERE balance IS NOT NULL
  ) WHERE rn = 1
),
wide AS (
  SELECT borrower_id, {_count(_SALARY)} AS salary_credit_count, {_average(_SALARY, "amount")} AS avg_salary_amount,
    max(CASE WHEN {_SALARY} THEN txn_date END) AS last_salary_date,
    {_sum(CREDIT)} AS credit, {_sum(DEBIT)} AS debit, {_average(CREDIT, "amount")} AS avg_credit_amount,
    max(CASE WHEN {DEBIT} THEN amount END) AS max_single_debit,
    {_count(_UPI)} AS upi_txn_count, {_sum(_UPI)} AS upi_total_amount,
    {_count(EMI)} AS emi_count, {_sum(EMI)} AS total_emi_amount,
    count(DISTINCT CASE WHEN sender_tag = 'LENDER' THEN sender END) AS lender_count,
    {_count(_has("LOAN_REMINDER"))} AS loan_reminder_count, {_count(LOAN)} AS loan_disbursement_count,
    {_average("TRUE", "balance")} AS avg_balance_proxy, min(balance) AS min_balance_proxy,
    {_count(_ALCOHOL)} AS alcohol_txn_count, {_sum(_ALCOHOL)} AS alcohol_spend_amount,
    {_count(DEBIT + " AND txn_hour <= 5")} AS night_debit_count, {_count(FAILED)} AS failed_txn_count,
    {_sum(CREDIT + f" AND txn_date > DATE '{AS_OF}' - INTERVAL 30 DAY")} AS recent,
    {_sum(CREDIT + f" AND txn_date <= DATE '{AS_OF}' - INTERVAL 30 DAY AND txn_date > DATE '{AS_OF}' - INTERVAL 60 DAY")} AS prior
  FROM picked GROUP BY borrower_id
),
scored AS (
  SELECT *, CAST(CASE WHEN failed_txn_count >= 3 THEN 2 ELSE 0 END + CASE WHEN loan_reminder_count >= 2 THEN 2 ELSE 0 END
      + CASE WHEN debit * 100 > credit * 120 THEN 2 ELSE 0 END + CASE WHEN lender_count >= 4 THEN 1 ELSE 0 END
      + CASE WHEN salary_credit_count = 0 THEN 1 ELSE 0 END + CASE WHEN alcohol_txn_count >= 5 THEN 1 ELSE 0 END AS BIGINT) AS risk_score
  FROM wide
)"""


def _group(columns: str, source: str, ctes: str, count: str = "n") -> str:
    return f"WITH {ctes} SELECT {columns}, count(*) AS {count} FROM {source} GROUP BY ALL"


def oracle_sql() -> dict[str, str]:
    everything = "TRUE"
    features90 = f"WITH {CLASSIFIED}, {_features(_lookback(90))}"
    all_history = f"WITH {CLASSIFIED}, {_features(everything)}"
    sql = {
        "sender_normalize": _group("sms_sender, sender_tag", "tagged", TAGGED),
        "sender_dictionary": _group("sender_tag", "tagged", TAGGED),
        "sender_headers": f"""SELECT sms_sender, {_tag("sms_sender")} AS default_tag,
            {_tag("sms_sender", keywords=OTHER_KEYWORDS)} AS other_tag, count(*) AS n
            FROM (SELECT ({_KNOWN})[l_orderkey % len({_KNOWN}) + 1] AS sms_sender FROM lineitem) GROUP BY ALL""",
        "global_exclusion": f"""WITH {MSG} SELECT raw_id, CAST(coalesce(sms_body = '' OR {_any("lower(sms_body)", EXCLUSIONS)}, TRUE)
            AS BIGINT) AS excluded FROM raw""",
        "classify_labels": f"WITH {LABELLED} SELECT raw_id, sender_tag, categories FROM labelled",
        "labels_from_rule_table": f"""WITH {LABELLED}
            SELECT raw_id, array_to_string(list_sort(string_split(categories, '|')), '|') AS categories FROM labelled""",
        "label_distribution": f"""WITH {LABELLED} SELECT category, count(*) AS sms_count
            FROM (SELECT unnest(string_split(categories, '|')) AS category FROM labelled) GROUP BY category""",
        "sender_breakdown": _group("sender_tag", "labelled", LABELLED, "sms_count"),
        "tagged_view": f"""WITH {TAGGED} SELECT raw_id, borrower_id, sender_tag,
            CASE WHEN regexp_matches(low, 'salary|sal cr|payroll') AND sender_tag = 'BANK' THEN 'SALARY_CREDIT'
                 WHEN regexp_matches(low, 'emi|installment|ecs|nach') THEN 'EMI_PAYMENT'
                 WHEN regexp_matches(low, 'loan disbursed|loan amount credited') THEN 'LOAN_DISBURSEMENT'
                 WHEN regexp_matches(low, 'failed|declined|insufficient') THEN 'FAILED_TRANSACTION'
                 WHEN regexp_matches(low, 'credited|cr rs') THEN 'BANK_CREDIT'
                 WHEN regexp_matches(low, 'debited|dr rs') THEN 'BANK_DEBIT'
                 ELSE 'UNCATEGORISED' END AS category,
            CAST(TRY_CAST(nullif(replace(regexp_extract(low, '(?:rs\\.?|inr|amount)\\s*([\\d,]+(?:\\.\\d{{1,2}})?)', 1), ',', ''), '')
                 AS DECIMAL(15,2)) AS DOUBLE) AS extracted_amount
            FROM tagged WHERE NOT regexp_matches(low, 'otp|one time password')""",
        "amount_extract": f"""WITH {MSG} SELECT raw_id, CAST({_money("sms_body", AMOUNT_PATTERNS)} AS DOUBLE) AS amount FROM raw""",
        "balance_extract": f"""WITH {MSG} SELECT raw_id, CAST({_money("sms_body", BALANCE_PATTERNS)} AS DOUBLE) AS balance FROM raw""",
        "mask_account_runs": f"WITH {MSG} SELECT raw_id, {_mask('sms_body')} AS masked FROM raw",
        "mask_documents": f"SELECT doc_id, {_mask('text')} AS masked FROM documents",
        "sanitize_messages": f"WITH {MSG} SELECT raw_id, {_sanitize('sms_body')} AS clean FROM raw",
        "sanitize_documents": f"SELECT doc_id, {_sanitize('text')} AS clean FROM documents",
        "sanitize_conversations_otp_first": f"""SELECT conv_id, turn, {_handles(_mask(_codes('"text"'), 7))} AS clean FROM conversations""",
        "hash_ids": "SELECT s_suppkey, sha256(s_name) AS id_hash FROM supplier",
        "message_time_parts": f"""WITH {MSG} SELECT raw_id, year({_KNOWN_DATE}) AS txn_year, month({_KNOWN_DATE}) AS txn_month,
            CAST({_KNOWN_DATE} AS VARCHAR) AS txn_date, {_HOUR} AS txn_hour FROM raw""",
        "collected_records": f"""WITH {TAGGED} SELECT sha256(borrower_id) AS borrower_id, sender_tag,
            {_sanitize("sms_body")} AS sms_body, inbox_time_ms FROM tagged WHERE sender_tag IN ('BANK', 'UPI', 'LENDER')""",
        "classified": f"WITH {CLASSIFIED} SELECT {_CLASSIFIED_OUT} FROM classified",
        "json_roundtrip": f"""WITH {LABELLED} SELECT raw_id, categories,
            '["' || replace(categories, '|', '","') || '"]' AS categories_json, CAST(txn_date AS VARCHAR) AS txn_date FROM labelled""",
        "dedup_by_time": f"""WITH {MSG} SELECT raw_id, borrower_id, inbox_time_ms, sms_sender FROM raw
            QUALIFY row_number() OVER (PARTITION BY borrower_id, inbox_time_ms
              ORDER BY raw_id) = 1""",
        "dedup_by_content": f"""WITH {CLASSIFIED} SELECT raw_id, any_value(borrower_id) AS borrower_id,
            CAST(any_value(amount) AS DOUBLE) AS amount, any_value(categories) AS categories FROM classified GROUP BY raw_id""",
        "content_keys": f"""WITH {MSG} SELECT sha256(concat_ws(chr(31), coalesce(borrower_id, chr(30)), coalesce(sms_body, chr(30)),
            coalesce(CAST(inbox_time_ms AS VARCHAR), chr(30)))) AS dedup_key, count(*) AS copies FROM raw GROUP BY 1""",
        "csv_scan": f"""WITH {MSG} SELECT borrower_id, count(*) AS rows, count(sms_sender) AS senders,
            CAST(sum(length(sms_body)) AS BIGINT) AS chars, CAST(min(txn_date) AS VARCHAR) AS first_date,
            CAST(max(txn_date) AS VARCHAR) AS last_date FROM raw GROUP BY borrower_id""",
        "landed_by_date": f"""WITH {TAGGED} SELECT CAST(txn_date AS VARCHAR) AS txn_date, sender_tag,
            'run-1' AS pipeline_run_id, count(*) AS n, (SELECT count(*) FROM lineitem) AS rows_landed
            FROM tagged GROUP BY txn_date, sender_tag""",
        "incremental_unclassified": f"""WITH {LABELLED} SELECT CAST(txn_date AS VARCHAR) AS txn_date, sender_tag, count(*) AS n
            FROM labelled WHERE txn_date IS NULL OR txn_date > DATE '{CUT}' GROUP BY txn_date, sender_tag""",
        "incremental_runs": f"""WITH {CLASSIFIED} SELECT DISTINCT raw_id, borrower_id, categories, CAST(amount AS DOUBLE) AS amount,
            CAST(txn_date AS VARCHAR) AS txn_date FROM classified WHERE raw_date IN (DATE '2000-01-05', DATE '2000-01-06')""",
        "features_all_history": f"{all_history} SELECT {_out(LOCAL_COLUMNS)} FROM features",
        "features_90d": f"{features90} SELECT {_out(WAREHOUSE_COLUMNS)} FROM features",
        "features_ddl": f"{features90} SELECT {_out(TABLE_COLUMNS)} FROM features",
        "features_upsert_measures": f"""WITH {CLASSIFIED}, narrow AS ({_NARROW.format(where=_lookback(90))})
            SELECT {_out(UPSERT_COLUMNS)} FROM narrow""",
        "latest_known_balances": f"""{all_history} SELECT borrower_id, CAST(last_known_balance AS DOUBLE) AS last_known_balance
            FROM balances""",
        "credit_momentum_30d": f"""{all_history} SELECT borrower_id, CAST(m1 AS DOUBLE) AS credit_last_30d,
            CAST(m2 AS DOUBLE) AS credit_prior_30d, credit_momentum FROM features
            WHERE borrower_id IN (SELECT borrower_id FROM classified WHERE {CREDIT} AND amount IS NOT NULL)""",
        "risk_score": f"""WITH {CLASSIFIED}, {_features(_lookback(LAST_YEAR))} SELECT borrower_id, risk_score, risk_flag FROM features""",
        "risk_distribution": f"""{features90} SELECT risk_flag, count(*) AS borrowers,
            round(CAST(100 AS DOUBLE) * count(*) / sum(count(*)) OVER (), 1) AS pct FROM features GROUP BY risk_flag""",
        "avg_credit_by_risk": f"""{features90} SELECT risk_flag, count(*) AS borrowers,
            round(CAST(sum(sum_credit_amount_90d) AS DOUBLE) / count(*), 0) AS avg_credit_90d FROM features GROUP BY risk_flag""",
        "top_borrowers": f"""{all_history} SELECT borrower_id, CAST(sum_credit_amount_90d AS DOUBLE) AS credit_90d, risk_flag
            FROM features ORDER BY sum_credit_amount_90d DESC, borrower_id LIMIT 10""",
        "profile_lookup": f"{all_history} SELECT {_out(WAREHOUSE_COLUMNS)} FROM features WHERE borrower_id = '{LOOKUP_ID}'",
        "feature_upsert": _merged(),
        "profile_wide": f"""WITH {PROFILE} SELECT w.borrower_id, salary_credit_count, avg_salary_amount,
            CAST(last_salary_date AS VARCHAR) AS last_salary_date, avg_credit_amount,
            CAST(max_single_debit AS DOUBLE) AS max_single_debit, upi_txn_count, CAST(upi_total_amount AS DOUBLE) AS upi_total_amount,
            emi_count, CAST(total_emi_amount AS DOUBLE) AS total_emi_amount, lender_count, loan_reminder_count,
            loan_disbursement_count, CAST(latest AS DOUBLE) AS latest_balance_proxy, avg_balance_proxy,
            CAST(min_balance_proxy AS DOUBLE) AS min_balance_proxy, alcohol_txn_count,
            CAST(alcohol_spend_amount AS DOUBLE) AS alcohol_spend_amount, night_debit_count, failed_txn_count,
            salary_credit_count > 0 AS salary_detected,
            round(CAST(credit * 30 AS DOUBLE) / {LAST_YEAR}, 2) AS monthly_credit_amount,
            round(CAST(debit * 30 AS DOUBLE) / {LAST_YEAR}, 2) AS monthly_debit_amount,
            CASE WHEN prior > 0 THEN CAST(100 AS DOUBLE) * (CAST(recent AS DOUBLE) - CAST(prior AS DOUBLE)) / CAST(prior AS DOUBLE) END
              AS mom_credit_trend_pct,
            '{AS_OF}' AS feature_date, CAST({LAST_YEAR} AS BIGINT) AS lookback_days
            FROM scored w LEFT JOIN newest n ON w.borrower_id = n.borrower_id""",
        "profile_risk": f"""WITH {PROFILE} SELECT borrower_id, risk_score, CASE WHEN risk_score >= 5 THEN 'HIGH'
            WHEN risk_score >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_flag FROM scored""",
        "run_counts": f"""WITH {LABELLED} SELECT (SELECT count(*) FROM raw) AS raw_rows, count(*) AS kept_rows,
            round(CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM raw), 1) AS kept_pct FROM labelled""",
        "distinct_senders": f"WITH {MSG} SELECT count(DISTINCT sms_sender) AS distinct_senders FROM raw",
        "daily_message_counts": f"""WITH {LABELLED} SELECT borrower_id, CAST(txn_date AS VARCHAR) AS txn_date, count(*) AS sms_count
            FROM labelled WHERE borrower_id IS NOT NULL GROUP BY borrower_id, txn_date""",
        "count_reconcile": f"""WITH {MSG},
            d AS (SELECT customer_id, count(*) AS device_count FROM msg
                  WHERE inbox_time_in_millis > 0 AND customer_id IS NOT NULL GROUP BY 1),
            i AS (SELECT customer_id, count(*) AS ingested_count
                  FROM (SELECT DISTINCT customer_id, inbox_time_in_millis FROM msg) WHERE customer_id IS NOT NULL GROUP BY 1),
            j AS (SELECT coalesce(d.customer_id, i.customer_id) AS customer_id, coalesce(device_count, 0) AS device_count,
                         coalesce(ingested_count, 0) AS ingested_count FROM d FULL OUTER JOIN i ON d.customer_id = i.customer_id)
            SELECT *, ingested_count - device_count AS delta, CASE WHEN ingested_count = device_count THEN 'OK'
              WHEN ingested_count > device_count THEN 'DUPLICATE' ELSE 'MISSING' END AS status FROM j""",
        "count_tolerance": f"""WITH {_deduplicated(TAGGED)},
            a AS (SELECT borrower_id, txn_date, count(*) AS actual FROM survivors GROUP BY ALL),
            e AS (SELECT borrower_id, txn_date, count(*) AS expected FROM raw GROUP BY ALL)
            SELECT e.borrower_id, CAST(e.txn_date AS VARCHAR) AS txn_date, expected, coalesce(actual, 0) AS actual
            FROM e LEFT JOIN a ON e.borrower_id = a.borrower_id AND e.txn_date = a.txn_date
            WHERE e.borrower_id IS NOT NULL AND e.txn_date IS NOT NULL AND abs(coalesce(actual, 0) - expected) > 0.05 * expected""",
        "payload_mismatch": """SELECT doc_id AS payload_id, len(list_distinct(string_split("text", chr(10)))) AS expected,
            len(string_split("text", chr(10))) AS received FROM documents
            WHERE len(list_distinct(string_split("text", chr(10)))) <> len(string_split("text", chr(10)))""",
        "constraint_violations": f"""WITH {LABELLED}
            SELECT 'not_null:borrower_id' AS "check", count(*) AS violations FROM raw WHERE borrower_id IS NULL
            UNION ALL SELECT 'not_null:sms_sender', count(*) FROM raw WHERE sms_sender IS NULL
            UNION ALL SELECT 'not_null:sms_body', count(*) FROM raw WHERE sms_body IS NULL
            UNION ALL SELECT 'not_null:inbox_time_ms', count(*) FROM raw WHERE inbox_time_ms IS NULL
            UNION ALL SELECT 'unique:raw_id', count(*) FROM (SELECT raw_id FROM raw GROUP BY raw_id HAVING count(*) > 1)
            UNION ALL SELECT 'reference:borrower_id', count(*) FROM labelled WHERE borrower_id IS NOT NULL AND borrower_id NOT IN
              (SELECT 'B' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') FROM supplier)""",
        "stream_dedup": f"""WITH {MSG} SELECT DISTINCT customer_id, inbox_time_in_millis FROM msg
            WHERE inbox_time_in_millis IS NOT NULL AND inbox_time_in_millis <> 0""",
        "stream_daily_counts": """SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS sms_count FROM events
            WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)
            GROUP BY user_id, CAST(ts AS DATE)""",
        "stream_feature_refresh": f"""WITH {CLASSIFIED}, narrow AS ({_NARROW.format(where=_lookback(LAST_YEAR))})
            SELECT {_out(UPSERT_COLUMNS)}, CAST(0 AS BIGINT) AS count_debit_txn_90d, CAST(NULL AS VARCHAR) AS risk_flag FROM narrow""",
        "classified_table": f"""WITH {_deduplicated(CLASSIFIED)} SELECT year(txn_date) AS txn_year, month(txn_date) AS txn_month,
            sender_tag, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount, (SELECT count(*) FROM classified) AS rows_written
            FROM classified GROUP BY 1, 2, 3""",
    }
    sql["stream_classify"] = sql["classified"]
    past = f"{_lookback(90, CUT)} AND txn_date <= DATE '{CUT}'"
    sql |= {
        "features_90d_past": f"WITH {CLASSIFIED}, {_features(past)} SELECT {_out(WAREHOUSE_COLUMNS)} FROM features",
        "profile_wide_past": sql["profile_wide"].replace(
            _lookback(LAST_YEAR), f"{_lookback(LAST_YEAR)} AND txn_date <= DATE '{AS_OF}'").replace(AS_OF, CUT),
        "landed_deduplicated": f"""WITH {_deduplicated(TAGGED, untimed_by_content=True)},
            keyed AS (SELECT *, sha256(concat_ws(chr(31), coalesce(borrower_id, chr(30)), coalesce(sms_body, chr(30)),
              coalesce(CAST(inbox_time_ms AS VARCHAR), chr(30)))) AS dedup_key FROM tagged)
            SELECT CAST(txn_date AS VARCHAR) AS txn_date, sender_tag, count(*) AS n, count(DISTINCT dedup_key) AS keys,
              min(dedup_key) AS first_key, (SELECT count(*) FROM keyed) AS rows_landed FROM keyed GROUP BY txn_date, sender_tag""",
        "external_table": f"""WITH {LABELLED} SELECT raw_id, '["' || replace(categories, '|', '","') || '"]' AS categories,
            CAST(txn_date AS VARCHAR) AS txn_date FROM labelled""",
        "stamped_upsert": f"""WITH {CLASSIFIED},
            f AS (SELECT DISTINCT borrower_id FROM classified WHERE borrower_id IS NOT NULL AND {past}),
            u AS (SELECT DISTINCT borrower_id FROM classified WHERE borrower_id IS NOT NULL AND {_lookback(90)})
            SELECT borrower_id, CASE WHEN borrower_id IN (SELECT borrower_id FROM u) THEN '{STAMPS[1]}' ELSE '{STAMPS[0]}' END
              AS last_updated FROM (SELECT * FROM f UNION SELECT * FROM u)""",
        "daily_counts_on_date": f"""WITH {LABELLED} SELECT borrower_id, CAST(txn_date AS VARCHAR) AS txn_date, count(*) AS sms_count
            FROM labelled WHERE borrower_id IS NOT NULL AND txn_date = DATE '{RUN_DATE}' GROUP BY borrower_id, txn_date""",
        "job_full_refresh": f"""WITH {_deduplicated(CLASSIFIED, untimed_by_content=True)}, {_features(everything)}
            SELECT {_out(LOCAL_COLUMNS)} FROM features""",
        **_jobs(),
        "incremental_bucketed": f"""WITH {MSG} SELECT raw_id, borrower_id, CAST(txn_date AS VARCHAR) AS txn_date FROM raw
            WHERE txn_date IS NULL OR txn_date > DATE '{CUT}'""",
        "lender_counts_90d": f"""WITH {CLASSIFIED} SELECT borrower_id, count(DISTINCT sender) AS lender_count FROM classified
            WHERE borrower_id IS NOT NULL AND sender_tag = 'LENDER' AND {_lookback(90)} AND txn_date <= DATE '{AS_OF}' GROUP BY borrower_id""",
        "stream_dedup_stored": f"""WITH {MSG} SELECT DISTINCT borrower_id, inbox_time_ms, CASE WHEN inbox_time_ms IS NULL THEN raw_id END AS untimed_id FROM raw""",
        "labels_from_rule_join": sql["labels_from_rule_table"],
        "keywords_in_documents": f"""WITH k AS (SELECT DISTINCT keyword FROM (
              SELECT unnest(regexp_split_to_array(lower("text"), '[^a-z]+')) AS keyword FROM benchmark
              UNION ALL SELECT unnest({_list(key for label in LABELS for key in (*label.include, *label.exclude))})) WHERE length(keyword) > 3)
            SELECT doc_id, keyword FROM documents, k WHERE contains(lower("text"), keyword)""",
        "rolling_credit_30_60": f"""WITH {CLASSIFIED} SELECT raw_id, borrower_id, inbox_time_ms, CAST(amount AS DOUBLE) AS amount,
            CAST(sum(amount) OVER (days RANGE BETWEEN 2591999999 PRECEDING AND CURRENT ROW) AS DOUBLE) AS credit_30d,
            CAST(sum(amount) OVER (days RANGE BETWEEN 5183999999 PRECEDING AND CURRENT ROW) AS DOUBLE) AS credit_60d
            FROM classified WHERE borrower_id IS NOT NULL AND {CREDIT} AND amount IS NOT NULL AND inbox_time_ms IS NOT NULL
            WINDOW days AS (PARTITION BY borrower_id ORDER BY inbox_time_ms)""",
        "features_from_partials": sql["features_ddl"],
        "features_from_partials_all_history": sql["features_all_history"],
        "upsert_measures_from_partials": sql["features_upsert_measures"],
        "stream_partials_refresh": sql["features_ddl"],
        "stream_dedup_whole": f"""{sql["stream_dedup"]} UNION ALL SELECT customer_id, inbox_time_in_millis FROM msg
            WHERE inbox_time_in_millis IS NULL OR inbox_time_in_millis = 0""",
        "stream_land": f"""WITH {TAGGED} SELECT CAST(txn_date AS VARCHAR) AS txn_date, sender_tag,
            'run-1' AS pipeline_run_id, count(*) AS n FROM tagged GROUP BY txn_date, sender_tag""",
    }
    return sql


def _landed_until(date: str) -> str:
    """The CTEs up to ``classified`` over one message for each borrower and millisecond, of those without a date or up to one."""
    rows = f""", survivors AS (SELECT * FROM raw WHERE txn_date IS NULL OR txn_date <= DATE '{date}'
        QUALIFY row_number() OVER (PARTITION BY borrower_id, inbox_time_ms, CASE WHEN inbox_time_ms IS NULL THEN raw_id END ORDER BY raw_id) = 1)"""
    return MSG + rows + CLASSIFIED[len(MSG):].replace("FROM raw)", "FROM survivors)")


def _jobs() -> dict[str, str]:
    """Features over all days that were landed, as of the last run; whichever runs brought them."""
    ctes = _landed_until(RUN_DATE)
    window = lambda day: f"{_lookback(90, day)} AND txn_date <= DATE '{day}'"
    after = f"WITH {ctes}, {_features(window(QUIET_DATE))} SELECT {_out(TABLE_COLUMNS)} FROM features"
    before = "2000-01-04"
    return {
        "job_daily_after_refresh": f"WITH {ctes}, {_features(window(RUN_DATE))} SELECT {_out(TABLE_COLUMNS)} FROM features",
        "job_daily_equals_refresh": after,
        "job_profile_lookup": f"{after} WHERE borrower_id = '{LOOKUP_ID}'",
        "job_classified_rows": f"""WITH {ctes} SELECT raw_id, borrower_id, categories, CAST(amount AS DOUBLE) AS amount,
            CAST(txn_date AS VARCHAR) AS txn_date FROM classified""",
        "bucket_upsert": f"""WITH {ctes},
            moved AS (SELECT DISTINCT borrower_id FROM classified
              WHERE txn_date = DATE '{RUN_DATE}' OR txn_date = DATE '{before}' - INTERVAL 90 DAY)
            SELECT borrower_id, count(*) AS total_financial_sms_90d,
              CASE WHEN borrower_id IN (SELECT borrower_id FROM moved WHERE borrower_id IS NOT NULL) THEN '{STAMPS[1]}' ELSE '{STAMPS[0]}' END AS last_updated
            FROM classified WHERE borrower_id IS NOT NULL AND {window(RUN_DATE)} GROUP BY borrower_id""",
    }


def _deduplicated(ctes: str, untimed_by_content: bool = False) -> str:
    """The same CTEs over the survivors of deduplication by (borrower, millisecond)."""
    content = ", CASE WHEN inbox_time_ms IS NULL THEN raw_id END" if untimed_by_content else ""
    survivors = f""", survivors AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY borrower_id, inbox_time_ms{content}
        ORDER BY raw_id) = 1)"""
    head, tail = MSG, ctes[len(MSG):]
    return head + survivors + tail.replace("FROM raw)", "FROM survivors)")

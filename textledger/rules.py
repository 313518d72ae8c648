"""Rule data for message tagging, and the dataclasses that carry it.

A :class:`RuleSet` is plain configuration.  Operators turn it into Column
expressions, so a caller can pass another rule set without touching any code.
Collecting rules from a table is bounded (see :meth:`RuleSet.from_table`).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

BANK, UPI, LENDER, OTP_SENDER, OTHER = "BANK", "UPI", "LENDER", "OTP_SENDER", "OTHER"

# ---------------------------------------------------------------------------
# Results depend on them exactly.
# ---------------------------------------------------------------------------

# Keywords tried, in this order, on the lower-cased and stripped sender.
SENDER_KEYWORDS: dict[str, tuple[str, ...]] = {
    OTP_SENDER: ("otp", "auth", "verify", "secure", "2fa"),
    BANK: (
        "bank", "sbi", "hdfc", "icici", "axis", "kotak", "pnb", "bob", "bnk", "bk", "federal", "union",
        "canara", "central", "indian", "syndicate", "corporation", "allahabad", "vijaya", "dena", "idfc",
        "baroda", "punjab",
    ),
    LENDER: (
        "fin", "loan", "credit", "lend", "capital", "invest", "nbfc", "finance", "fincorp", "finserv",
        "microfi", "mfi", "kred", "emi", "rupee",
    ),
    UPI: ("pay", "upi", "wallet", "cash", "money", "gpay", "phone", "razr", "bhim", "payz", "lazy"),
}

# Sender headers with a tag of their own; they go before the keywords.
SENDER_HEADERS: dict[str, tuple[str, ...]] = {
    BANK: (
        "sbiinb", "sbibnk", "sbiupi", "sbicrd", "sbipsg", "sbyono", "atmsbi", "cbssbi", "sbi", "pnbsms", "pnb",
        "canbnk", "boiind", "bobsms", "bobtxn", "bobcrd", "unionb", "centbk", "indbnk", "iobchn", "ucobnk",
        "hdfcbk", "hdfcbn", "hdfcbank", "icicit", "icicib", "icicio", "icicil", "icici", "kotakb", "kotaka",
        "axisbk", "axismr", "axisgp", "yesbnk", "indusb", "idfcfb", "fedbnk", "federl", "idbibk", "rblbnk",
        "rblcrd", "bandhn", "bdnsms", "scbnki", "scbank", "citibn", "dcbbnk", "hsbcin", "dbsbnk",
        "aubank", "ujjivn", "equtas", "equtat", "finobk", "utkbnk", "kvbank", "kvbupi", "kvgbbk", "tjsb",
        "saraswat", "sarbnk", "cosmos", "nkgsb", "kblbnk", "kgbank", "jrgbnk", "mahabk", "cubltd", "cubank",
        "tmbank", "dhanbk", "csbbnk", "sibsms", "ssfbnk", "sbpdcl", "fedfib",
        "airbnk", "ipbmsg", "nsdlpb", "pytmbk",
    ),
    UPI: (
        "jiopay", "airtel", "paytmb", "gpay", "phonepe", "phonpe", "bhimupi", "bhrtpe", "mobikw", "amazon",
        "freecharge", "rzrpay", "ipaytm", "pai247", "papape", "inmony", "inmny", "atrupe", "postpe", "payzap",
    ),
    LENDER: (
        "hdbfsl", "bajajf", "bajajp", "bajfin", "ltfin", "lntfin", "muthoo", "mutfcl", "kreditb", "nirafc",
        "nirafn", "cashe", "casheb", "earncl", "moneyv", "monvew", "stashf", "stsfin", "stshfn", "stasfn",
        "smccfl", "pfiltm", "afiltm", "gsfnce", "620016", "fattak", "fatak", "fatakm", "fatakc", "mpokkt",
        "navi", "navihq", "naviln", "navicl", "zestmn", "fibe", "fibetm", "monedo", "kissht", "indifi",
        "lendng", "payltr", "slncrd", "smfgfi",
        "krrbee", "krzbee", "krdbee", "krbeee", "kredto", "kredbe", "kretbe", "dmifnc", "dmicom", "dminbf",
        "tvscsl", "tvscss", "tvscsp", "herfnc", "herofi", "hrfinc", "bfdlts", "bfdlps", "bfdlmt", "mafild",
        "mafilr", "mafilg",
        "vivifi", "trcred", "rredee", "inncrd", "incred", "lnplte", "lenpte", "lnfrnt", "onemny", "istmon",
        "istmny", "housng", "homecr", "ramfcp", "rupsml", "ruptm", "rpdmny", "capnow", "smcoin", "kcredt",
        "lnditt", "jaifnn", "bdylon", "cfltd", "abfncs", "iiflfn", "fimony", "vtraki", "tblnce", "loan12",
        "snpmnt", "credin", "onecrd", "angone", "bseltd",
        "lzypay", "lazpay", "mnytap", "paysns", "pcktly", "pktlyy",
    ),
    OTP_SENDER: ("blinkr",),
}

# A body that holds any of these is noise, whoever sent it.
EXCLUSIONS: tuple[str, ...] = (
    "otp", "one-time password", "one time password", "verification code", "do not share", "don't share",
    "expires in", "valid for",
    "offer", "cashback", "reward points", "win a", "congratulations you", "lucky draw", "subscribe",
    "unsubscribe", "click here", "limited time", "exclusive deal", "download app", "install now",
    "data pack", "talktime", "recharge", "validity extended", "roaming",
    "your order", "out for delivery", "delivered successfully", "shipment",
    "login attempt", "new login", "signed in from",
)


@dataclass(frozen=True)
class Label:
    """One label: the sender tags it may apply to, its keywords and its vetoes."""

    name: str
    tags: tuple[str, ...]
    include: tuple[str, ...]
    exclude: tuple[str, ...] = ()


LABELS: tuple[Label, ...] = (
    Label(
        "BANK_CREDIT",
        (BANK, UPI),
        (
            "credited", "credit", "deposited", "received", "cr rs", "amount credited", "funds received",
            "transfer received", "neft credit", "rtgs credit", "imps credit", "added to", "money received",
        ),
        ("otp", "offer"),
    ),
    Label(
        "BANK_DEBIT",
        (BANK, UPI),
        (
            "debited", "debit", "withdrawn", "spent", "dr rs", "amount debited", "paid via", "payment done",
            "payment of", "purchase of", "pos txn", "atm withdrawal", "ach debit", "nach debit", "ecs debit",
            "auto debit",
        ),
        ("otp", "offer"),
    ),
    Label(
        "UPI_PAYMENT",
        (BANK, UPI),
        (
            "upi", "gpay", "phonepe", "paytm", "bhim", "sent to", "paid to", "received from", "upi ref",
            "upi txn", "upi payment", "upi transfer", "vpa",
        ),
        ("otp", "failed"),
    ),
    Label(
        "SALARY_CREDIT",
        (BANK,),
        ("salary", "sal cr", "sal credit", "payroll", "wages", "stipend", "monthly pay", "salary credited"),
        ("otp", "advance"),
    ),
    Label(
        "LOAN_DISBURSEMENT",
        (BANK, LENDER),
        (
            "loan disbursed", "loan amount credited", "loan processed", "disbursement", "loan sanctioned",
            "loan approved and", "personal loan", "pl disbursed", "amount released",
        ),
        ("otp", "apply now", "offer"),
    ),
    Label(
        "EMI_PAYMENT",
        (BANK, LENDER),
        (
            "emi", "equated monthly", "emi paid", "emi due", "emi deducted", "installment", "loan emi",
            "emi amount", "emi collected", "nach", "ecs", "auto debit emi", "standing instruction",
        ),
        ("otp", "offer"),
    ),
    Label(
        "LOAN_REMINDER",
        (BANK, LENDER),
        (
            "due date", "payment due", "overdue", "outstanding", "kindly pay", "please pay", "reminder",
            "repayment due", "loan repayment", "amount due", "last date",
        ),
        ("otp",),
    ),
    Label(
        "BALANCE_INQUIRY",
        (BANK,),
        (
            "available balance", "avl bal", "closing balance", "current balance", "bal rs", "balance is",
            "a/c balance", "account balance", "ledger balance",
        ),
        ("otp",),
    ),
    Label(
        "ALCOHOL_SPEND",
        (BANK, UPI),
        (
            "liquor", "wine", "beer", "bar ", " pub ", "alcohol", "whisky", "whiskey", "rum ", "vodka",
            "spirits", "breweries", "distillery",
        ),
        ("otp",),
    ),
    Label(
        "FAILED_TRANSACTION",
        (BANK, UPI, LENDER),
        (
            "failed", "declined", "rejected", "could not process", "transaction failed", "payment failed",
            "insufficient funds", "insufficient balance", "low balance",
        ),
        ("otp",),
    ),
)

# Money patterns, tried in order; ASCII digits and ASCII case folding.
AMOUNT_PATTERNS: tuple[str, ...] = (
    r"(?:rs\.?|inr|₹)\s*([\d,]+(?:\.\d{1,2})?)",
    r"([\d,]+(?:\.\d{1,2})?)\s*(?:rs\.?|inr|₹)",
    r"amount[:\s]+(?:rs\.?|inr|₹)?\s*([\d,]+(?:\.\d{1,2})?)",
)
BALANCE_PATTERNS: tuple[str, ...] = (
    r"(?:avl|available|closing|current|bal|balance)[^₹\d]*([\d,]+(?:\.\d{1,2})?)",
    r"bal[:\s]+(?:rs\.?|inr|₹)?\s*([\d,]+(?:\.\d{1,2})?)",
)

# Words of which every balance has one.
BALANCE_WORDS: tuple[str, ...] = ("avl", "available", "closing", "current", "bal")

# Amount of the tagged view.
VIEW_AMOUNT_PATTERN = r"(?:rs\.?|inr|amount)\s*([\d,]+(?:\.\d{1,2})?)"

# Labels of the tagged view, the first match counts: (label, keys, tag that it wants).
VIEW_LABELS: tuple[tuple[str, tuple[str, ...], str | None], ...] = (
    ("SALARY_CREDIT", ("salary", "sal cr", "payroll"), BANK),
    ("EMI_PAYMENT", ("emi", "installment", "ecs", "nach"), None),
    ("LOAN_DISBURSEMENT", ("loan disbursed", "loan amount credited"), None),
    ("FAILED_TRANSACTION", ("failed", "declined", "insufficient"), None),
    ("BANK_CREDIT", ("credited", "cr rs"), None),
    ("BANK_DEBIT", ("debited", "dr rs"), None),
)
VIEW_OTHER_LABEL = "UNCATEGORISED"

# What masking writes.
HANDLE_MASK = "XXXX@upi"
CODE_MASK = "000000"

# Risk engine of the feature table: (points, limit) per signal, then the cuts.
RISK_POINTS = {"bounce": 30, "loan_stacking": 20, "emi_load": 40, "credit_drop": 10}
RISK_MAX_LOANS = 3
RISK_CREDIT_DROP = 0.8
RISK_CUTS = {"HIGH": 60, "MEDIUM": 30}

# Risk engine of the wide profile.
PROFILE_RISK_CUTS = {"HIGH": 5, "MEDIUM": 2}

# ---------------------------------------------------------------------------

FINANCIAL_TAGS: tuple[str, ...] = (BANK, UPI, LENDER)
MAX_RULE_ROWS = 5_000


def shortest_keys(keys: Iterable[str]) -> tuple[str, ...]:
    """Drop every key that holds another key: "credited" adds nothing to "credit"."""
    unique = list(dict.fromkeys(keys))
    return tuple(k for k in unique if not any(o != k and o in k for o in unique))


def keyword_tag(key: str, keywords: dict[str, tuple[str, ...]]) -> str:
    """Tag that the keywords alone give a sender key."""
    return next((tag for tag, words in keywords.items() if any(w in key for w in words)), OTHER)


@dataclass(frozen=True)
class RuleSet:
    sender_keywords: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(SENDER_KEYWORDS))
    sender_headers: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(SENDER_HEADERS))
    exclusions: tuple[str, ...] = EXCLUSIONS
    labels: tuple[Label, ...] = LABELS
    kept_tags: tuple[str, ...] = FINANCIAL_TAGS
    word_boundary: bool = False

    def with_labels(self, labels: Iterable[Label]) -> RuleSet:
        return replace(self, labels=tuple(labels))

    @classmethod
    def from_table(cls, rules: DataFrame, base: RuleSet | None = None, max_rows: int = MAX_RULE_ROWS) -> RuleSet:
        """Labels from a rule table ``(label, tags array, keyword, kind include|exclude)``.

        Rules are configuration, not data: more than ``max_rows`` rows is an
        error, so the driver never holds an unbounded result.
        """
        rows = rules.select("label", "tags", "keyword", "kind").limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"a rule table may hold at most {max_rows} rows")
        labels = []
        for name in sorted({r.label for r in rows}):
            mine = [r for r in rows if r.label == name]
            pick = lambda kind: tuple(sorted(r.keyword for r in mine if r.kind == kind))
            labels.append(Label(name, tuple(sorted({t for r in mine for t in r.tags})), pick("include"), pick("exclude")))
        return (base or DEFAULT_RULES).with_labels(labels)


DEFAULT_RULES = RuleSet()

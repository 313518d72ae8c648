"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pin
from .common import Scratch, id_and_text, let, whole_text

# Patterns of the kinds. They are written so that a search never goes back over a run of characters: possessive where
# nothing else could match, and begun only at the start of a run. What they find is what the plain patterns find.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Other ways to write them: those that can hardly be anything else (plain), and those that can.
_BETWEEN = r"(?:\x20-\x20|\x20\x20|[._/\u00A0\u2010-\u2014\x20-])"
EMAIL_PLAIN = r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[({]\x20?(?:at|@)\x20?[\])}]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?)[A-Za-z0-9-]++)++"
EMAIL_OTHER = r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++"
IP_PLAIN = r"(?i)(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}){3}(?![0-9])"
IP_OTHER = r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
CARD_PLAIN = rf"(?<![0-9])[0-9]{{4}}({_BETWEEN})[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{4}}(?![0-9])"
CARD_OTHER = rf"(?<![0-9])(?:[0-9]{{16}}|3[47][0-9]{{2}}({_BETWEEN}?)[0-9]{{6}}\1[0-9]{{5}})(?![0-9])"
PHONE_PLAIN = r"(?<![0-9])(?:\+?1[\x20.-])?(?:\([0-9]{3}\)\x20?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9-])"
PHONE_OTHER = r"(?<![0-9+])(?:00[1-9][0-9]?[\x20.-])?[0-9]{3,4}[\x20.][0-9]{3}[\x20.][0-9]{4}(?![0-9])"

# Gazetteers and words of the context.
TOP_DOMAINS = "com org net edu gov mil int info biz name io co de fr es uk it nl ch at be se no fi dk pl cz eu us ca au nz jp cn in br ru mx test example invalid localhost"
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98 351 352 353 354 358 380 420 886 971 972"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|30|36|38|6011|64|65|62)"
CUES = (
    "e-?mails?|mails?|mailto|contact|write to|correo|courriel|adresse|kontakt",
    "ip|ips|ipv4|ipv6|address|host|server|client|gateway|dns|router|proxy|login from|adresse|direcci[oó]n",
    "card|visa|mastercard|amex|discover|credit|debit|account|payment|tarjeta|carte|karte|kreditkarte|konto",
    "phone|tel|telephone|call|mobile|cell|fax|sms|whatsapp|tel[eé]fono|t[eé]l[eé]phone|telefon|handy|ruf",
)
#: Words before a number that is none of these.
CONTRARY = "version|release|build|rev|isbn|issn|doi|order|invoice|tracking|serial|figure|fig|table|section|chapter|page|score|sha|md5|hash"


@dataclass(frozen=True)
class Kind:
    name: str
    base: str
    plain: str
    other: str
    #: Is a match of ``base`` one?
    valid: Callable[[Column], Column]
    #: Votes of the labeler that checks the numbers or names within, and of the gazetteer.
    checks: Callable[[Column], Column]
    gazetteer: Callable[[Column], Column]


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Of 12 to 19 digits; any other number fails."""
    def total(backwards: Column) -> Column:
        def add(sum_: Column, i: Column) -> Column:
            d = F.substring(backwards, i, F.lit(1)).cast("int")
            return sum_ + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

        return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), add)

    return F.when(F.length(number).between(12, 19), total(F.reverse(number)) % 10 == 0).otherwise(F.lit(False))


def _vote(for_it: Column, against: Column | None = None) -> Column:
    vote = F.when(for_it, 1)
    return (vote.when(against, -1).otherwise(0) if against is not None else vote.otherwise(0)).cast("int")


_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _octets(m: Column) -> Column:
    return m.rlike(rf"^{_PART}(?:[^0-9]+{_PART}){{3}}$")


def _is_card(m: Column) -> Column:
    return let(digits(m), lambda d: F.length(d).between(14, 19) & passes_luhn(d))


def _is_phone(m: Column) -> Column:
    return F.length(digits(m)).between(10, 15)


_DOMAIN_END = r"(?i)(?:\.|dot)[^A-Za-z0-9]*"
KINDS = (
    Kind("email", EMAIL, EMAIL_PLAIN, EMAIL_OTHER, lambda m: F.lit(True),
         lambda m: let(m.rlike(_DOMAIN_END + r"[A-Za-z]{2,24}$"), lambda good: _vote(good, ~good)),
         lambda m: _vote(m.rlike(_DOMAIN_END + rf"(?:{TOP_DOMAINS.replace(' ', '|')})$"))),
    Kind("ip", IP, IP_PLAIN, IP_OTHER, _octets,
         lambda m: _vote(_octets(m) & ~m.rlike(r"(?:^|[^0-9])0[0-9]"), ~F.contains(m, F.lit(":"))),
         lambda m: _vote(F.contains(m, F.lit(":")), m.rlike(r"^(?:0|255)[^0-9]"))),
    Kind("card", CARD, CARD_PLAIN, CARD_OTHER, _is_card,
         lambda m: let(_is_card(m), lambda good: _vote(good, ~good)),
         lambda m: _vote(digits(m).rlike(ISSUERS))),
    Kind("phone", PHONE, PHONE_PLAIN, PHONE_OTHER, _is_phone,
         lambda m: let(F.length(digits(m)), lambda n: _vote(n.between(10, 13), ~n.between(10, 15))),
         lambda m: _vote(m.rlike(rf"^(?:\+|00)(?:{CALLING_CODES.replace(' ', '|')})(?![0-9]{{6}})"))),
)
#: Labelers, each voting 1, 0 (abstains) or -1.
LABELERS = ("form", "checks", "gazetteer", "cue", "edges")
SHAPES = ("unusual form", "separators", "long")
#: Texts without any of these hold nothing that only the other patterns find.
_HINT = rf"(?i)[\[({{]\x20?(?:at|@|dot|\.)\x20?[\])}}]|\x20at\x20[A-Za-z0-9-]++\x20dot\x20|[0-9A-F]:[0-9A-F]{{1,4}}:|[0-9]{{3}}[\x20.-][0-9]{{4}}|[0-9]{{4}}{_BETWEEN}[0-9]{{4}}|[0-9]{{15}}"
_MASK = "\ufffc"
_BLOCK = 512
_CONTEXT = 48
_FOUND = "array<struct<start:int,end:int,text:string,before:string,after:string>>"

#: A labeler's share of votes that are for a span which is personal data, and for one which is not, before any is seen, in so many spans' weight.
SENSITIVITY, FALSE_ALARMS, WEIGHT = 0.8, 0.2, 10.0
ROUNDS = 30
STEPS = 200
#: A span in another than the base form is added from this probability on.
ACCEPT = 0.9


def located(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` with their place in code points and what stands around them: the text is split at them, and lengths add up.

    Blocks keep the lists that grow short, so many matches in a long text take time in proportion.
    """
    def block(at: Column, matches: Column, gaps: Column, b: Column) -> Column:
        def add(state: Column, i: Column) -> Column:
            gap, match, after = F.get(gaps, i), F.get(matches, i), F.substring(F.get(gaps, i + 1), 1, 2)
            start = state["at"] + F.length(gap)
            found = F.struct(start.alias("start"), (start + F.length(match)).alias("end"), match.alias("text"), F.substring(gap, -_CONTEXT, _CONTEXT).alias("before"), after.alias("after"))
            return F.struct((start + F.length(match)).alias("at"), F.concat(state["out"], F.array(found)).alias("out"))

        last = F.least((b + 1) * _BLOCK, F.size(matches)) - 1
        return F.aggregate(F.sequence(b * _BLOCK, last), F.struct(at.alias("at"), F.array().cast(_FOUND).alias("out")), add)

    def all_blocks(matches: Column, gaps: Column) -> Column:
        def add(state: Column, b: Column) -> Column:
            return let(block(state["at"], matches, gaps, b), lambda x: F.struct(x["at"].alias("at"), F.concat(state["out"], F.array(x["out"])).alias("out")))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_FOUND}>").alias("out"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / _BLOCK).cast("int"))
        return F.flatten(F.aggregate(blocks, start, add)["out"])

    none = F.array().cast(_FOUND)
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(
        F.size(m) > 0, let(F.split(text, pattern, -1), lambda g: all_blocks(m, g))).otherwise(none))


def _without(text: Column, kind: Kind) -> Column:
    """The text, equally long, with each base span of a kind blotted out."""
    blot = lambda m: F.when(kind.valid(m), F.repeat(F.lit(_MASK), F.length(m))).otherwise(m)
    return let(F.regexp_extract_all(text, F.lit(kind.base), F.lit(0)), lambda m: F.when(F.size(m) > 0, F.array_join(F.zip_with(
        F.split(text, kind.base, -1), F.transform(m, blot), lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")).otherwise(text))


def _candidate(k: int, found: Column, base: Column, form: Column) -> Column:
    """(kind, start, end, base, votes, shape); votes are digits of a number to the base 3, shapes bits."""
    kind, text, before = KINDS[k], found["text"], found["before"]
    cue = lambda words: F.lower(before).rlike(rf"(?:^|[^\p{{L}}0-9])(?:{words})(?![\p{{L}}])[^\p{{L}}]*(?:[\p{{L}}]+[^\p{{L}}]*){{0,2}}$")
    clear = before.rlike(r"(?:^|[\s\"'(\[{<>:;,=|/*#])$") & found["after"].rlike(r"^(?:$|[\s\"')\]}<>:;,!?|*]|\.(?:$|[^0-9A-Za-z]))")
    votes = (form, kind.checks(text), kind.gazetteer(text), _vote(cue(CUES[k]), cue(CONTRARY)), _vote(clear, ~clear))
    shapes = (~base, text.rlike(r"[^0-9A-Za-z@.]"), F.length(text) > 24)
    code = reduce(lambda a, b: a + b, [(v + 1) * 3**i for i, v in enumerate(votes)])
    shape = reduce(lambda a, b: a + b, [F.when(s, 2**i).otherwise(0) for i, s in enumerate(shapes)])
    return F.struct(F.lit(k).alias("kind"), found["start"].alias("start"), found["end"].alias("end"), base.alias("base"), code.cast("int").alias("votes"), shape.cast("int").alias("shape"))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): every match of a base pattern, valid or not, and what the other patterns find beside the valid ones."""
    texts = pin(id_and_text(docs), body=whole_text()).drop("text")
    body, needs = F.col("body"), {"email": "@", "phone": "+", "ip": "."}
    empty = F.array().cast(_FOUND)
    base = {k.name: F.when(F.contains(body, F.lit(needs[k.name])), located(body, k.base)).otherwise(empty) if k.name in needs else located(body, k.base) for k in KINDS}
    matched = pin(texts, **base)
    rest = pin(matched, rest=F.when(body.rlike(_HINT), reduce(_without, KINDS, body))).drop("body")
    others = {f"{k.name}_{form}": F.when(F.col("rest").isNotNull(), located(F.col("rest"), getattr(k, form))).otherwise(empty) for k in KINDS for form in ("plain", "other")}
    found = pin(rest, **others)

    def known(k: int) -> Callable[[Column], Column]:
        return lambda x: let(KINDS[k].valid(x["text"]), lambda good: _candidate(k, x, good, F.when(good, 1).otherwise(-1)))

    def other(k: int, form: int) -> Callable[[Column], Column]:
        return lambda x: _candidate(k, x, F.lit(False), F.lit(form))

    spans = [s for i, k in enumerate(KINDS) for s in (
        F.transform(k.name, known(i)), F.transform(f"{k.name}_plain", other(i, 1)), F.transform(f"{k.name}_other", other(i, 0)))]
    return found.select("doc_id", F.concat(*spans).alias("spans"))


def _votes_of(code: Column) -> Column:
    return F.array(*[(F.floor(code / 3**i).cast("int") % 3 - 1) for i in range(len(LABELERS))])


def features(votes: Column, shape: Column) -> Column:
    """What the classifier reads: 1, each labeler's vote for and against, the shapes."""
    flags = [f for i in range(len(LABELERS)) for f in (F.get(votes, F.lit(i)) == 1, F.get(votes, F.lit(i)) == -1)]
    flags += [shape.bitwiseAND(F.lit(2**i)) != 0 for i in range(len(SHAPES))]
    return F.array(F.lit(1.0), *[F.when(f, 1.0).otherwise(0.0) for f in flags])


def _sum(items: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda s, x: s + value(x))


def _sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def reliabilities(patterns: Column) -> Column:
    """Expectation-maximisation over patterns (votes, n): (prior, up, down), log odds of a span and what each labeler's vote for or against adds.

    An abstention says nothing. Each labeler has a share of votes for among those it casts on personal data, and on others.
    """
    each = range(len(LABELERS))

    def maximise(weighted: Column) -> Column:
        """From patterns (votes, n, r), where r is the probability of personal data."""
        total = lambda value, test: _sum(weighted, lambda p: F.when(test(p), value(p)).otherwise(0.0))
        yes, no = (lambda p: p["n"] * p["r"]), (lambda p: p["n"] * (1.0 - p["r"]))
        every = lambda p: F.lit(True)
        up, down = [], []
        for i in each:
            for_it = lambda p, i=i: F.get(p["votes"], F.lit(i)) == 1
            cast = lambda p, i=i: F.get(p["votes"], F.lit(i)) != 0
            hit = (total(yes, for_it) + SENSITIVITY * WEIGHT) / (total(yes, cast) + WEIGHT)
            alarm = (total(no, for_it) + FALSE_ALARMS * WEIGHT) / (total(no, cast) + WEIGHT)
            up.append(F.log(hit / alarm))
            down.append(F.log((1.0 - hit) / (1.0 - alarm)))
        prior = F.log((total(yes, every) + WEIGHT / 2) / (total(no, every) + WEIGHT / 2))
        return F.struct(prior.alias("prior"), F.array(*up).alias("up"), F.array(*down).alias("down"))

    start = F.struct(F.lit(0.0).alias("prior"), *[F.array(*[F.lit(x) for _ in each]).alias(name) for name, x in
                     (("up", math.log(SENSITIVITY / FALSE_ALARMS)), ("down", math.log((1 - SENSITIVITY) / (1 - FALSE_ALARMS))))])
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda m, _: let(with_posterior(patterns, m), maximise))


def with_posterior(patterns: Column, model: Column) -> Column:
    """Adds ``r`` to each pattern."""
    def r(p: Column) -> Column:
        votes = [F.when(F.get(p["votes"], F.lit(i)) == 1, F.get(model["up"], F.lit(i))).when(F.get(p["votes"], F.lit(i)) == -1, F.get(model["down"], F.lit(i))).otherwise(0.0)
                 for i in range(len(LABELERS))]
        return _sigmoid(reduce(lambda a, b: a + b, votes, model["prior"]))

    return F.transform(patterns, lambda p: F.struct(p["votes"].alias("votes"), p["x"].alias("x"), p["n"].alias("n"), r(p).alias("r")))


#: Where the classifier starts, and what it is drawn back to: a span is unlikely, and votes count as before any was seen.
_START = [math.log(FALSE_ALARMS / SENSITIVITY)] + [s * math.log(SENSITIVITY / FALSE_ALARMS) for _ in LABELERS for s in (1, -1)] + [0.0 for _ in SHAPES]


def train(patterns: Column) -> Column:
    """Weights of a logistic regression on patterns (x, n, r), the r as soft labels, by gradient steps; ``WEIGHT`` draws them to ``_START``."""
    start = F.array(*map(F.lit, _START))
    size = _sum(patterns, lambda p: p["n"]) + WEIGHT

    def step(w: Column, _: Column) -> Column:
        score = lambda p: _sum(F.zip_with(w, p["x"], lambda a, b: a * b), lambda v: v)
        errors = F.transform(patterns, lambda p: F.struct(p["x"].alias("x"), (p["n"] * (_sigmoid(score(p)) - p["r"])).alias("e")))
        slope = lambda e: F.aggregate(e, F.transform(w, lambda _: F.lit(0.0)), lambda g, p: F.zip_with(g, p["x"], lambda a, b: a + b * p["e"]))
        pull = F.zip_with(w, start, lambda a, b: (a - b) * WEIGHT)
        return let(errors, lambda e: F.zip_with(w, F.zip_with(slope(e), pull, lambda g, p: (g + p) / size), lambda a, g: a - g))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)


def fit(found: DataFrame) -> DataFrame:
    """(kind, model, weights): the reliabilities of the labelers and the classifier, from all candidates of all documents.

    Candidates are counted by their votes and shapes: 3**5 times 2**3 patterns a kind at most, so the rows that meet in
    a task are as few for any input.
    """
    spans = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.shape")
    counts = spans.groupBy("kind", "votes", "shape").agg(F.count("*").cast("double").alias("n"))
    pattern = F.struct("votes", "shape", "n")
    kinds = counts.groupBy("kind").agg(F.sort_array(F.collect_list(pattern)).alias("p"))
    decoded = pin(kinds, patterns=F.transform("p", lambda p: let(_votes_of(p["votes"]), lambda v: F.struct(v.alias("votes"), features(v, p["shape"]).alias("x"), p["n"].alias("n")))))
    estimated = pin(decoded, model=reliabilities(F.col("patterns")))
    labelled = pin(estimated, labelled=with_posterior(F.col("patterns"), F.col("model")))
    return labelled.select("kind", "model", train(F.col("labelled")).alias("weights"))


def _apart(spans: Column) -> Column:
    """Of sorted spans those that begin where the last one taken has ended."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,p:double>>").alias("out"))
    take = lambda s, x: F.when(x["start"] >= s["at"], F.struct(x["end"].alias("at"), F.concat(s["out"], F.array(x)).alias("out"))).otherwise(s)
    return F.when(F.size(spans) > 1, F.aggregate(spans, start, take)["out"]).otherwise(spans)


def personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, base, spans), a row per row of ``docs``, which needs doc_id and text. Spans are (start, kind, end, p), in this order.

    ``start`` and ``end`` (exclusive) count code points, ``kind`` is a place in ``KINDS``. ``base`` are the valid matches of the base patterns;
    kinds may overlap. ``spans`` are these (p is null) and spans in other forms that the classifier gives the probability p of at
    least ``accept``; those overlap nothing.

    Five labelers vote on every candidate: the form (regular expressions), checks of the numbers or names within, gazetteers, words before it, and
    its edges. Expectation-maximisation over the votes of all candidates gives their reliabilities, and probabilities on which a
    logistic regression is trained per kind. The models, one row a kind, are all that comes to the driver.

    A null text is an empty one. Null ids, repeated ids and equal rows are rows like any other. No rows give none. Other columns are not read.
    """
    found = Scratch(docs.sparkSession, "pii").keep(candidates(docs))
    weights = {r["kind"]: r["weights"] for r in fit(found).select("kind", "weights").collect()}
    table = F.array(*[F.array(*map(F.lit, weights.get(k, _START))) for k in range(len(KINDS))])

    def scored(s: Column) -> Column:
        x = features(_votes_of(s["votes"]), s["shape"])
        p = _sigmoid(_sum(F.zip_with(F.get(table, s["kind"]), x, lambda a, b: a * b), lambda v: v))
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), p.alias("p"))

    others = F.filter("spans", lambda s: ~s["base"] & (s["shape"] % 2 == 1) & (s["votes"] % 3 != 0))
    base = F.transform(F.filter("spans", lambda s: s["base"]), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(None).cast("double").alias("p")))
    parts = pin(found, base=F.array_sort(base), scored=F.filter(F.transform(others, scored), lambda s: s["p"] >= accept))
    added = _apart(F.array_sort("scored"))
    return parts.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

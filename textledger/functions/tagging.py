"""Sender tags, noise test and labels as Column expressions over a RuleSet."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_RULES, OTHER, VIEW_LABELS, VIEW_OTHER_LABEL, RuleSet, keyword_tag, shortest_keys

# All characters that count as white space at the ends of a sender.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0          "
    "      　"
)


def any_key(text: Column, keys: Iterable[str], word_boundary: bool = False) -> Column:
    """True when the text holds one of the keys.  ``contains`` beats one regex several times over."""
    keys = tuple(keys)
    if not keys:
        return F.lit(False)
    if word_boundary:
        words = "|".join(re.escape(k.strip()) for k in keys)
        return text.rlike(rf"(?<![\p{{L}}\p{{N}}_])(?:{words})(?![\p{{L}}\p{{N}}_])")
    return reduce(or_, [F.contains(text, F.lit(k)) for k in shortest_keys(keys)])


def sender_key(sender: Column) -> Column:
    """Lower-cased sender without outer white space; null becomes ''."""
    return F.coalesce(F.btrim(F.lower(sender), F.lit(WHITE_SPACE)), F.lit(""))


def sender_tag(key: Column, rules: RuleSet = DEFAULT_RULES) -> Column:
    """Tag of a :func:`sender_key`: exact headers first, then keywords in order.

    The key is used in every branch, so it should be pinned or a plain column.
    """
    tag = F.when(key == "", OTHER)
    for name, headers in rules.sender_headers.items():
        # Headers that these keywords tag right anyway need no test.
        needed = [h for h in headers if keyword_tag(h, rules.sender_keywords) != name]
        tag = tag.when(key.isin(*needed), name) if needed else tag
    for name, keywords in rules.sender_keywords.items():
        # On a text this short one alternation costs no more than its keywords one by one,
        # and keeps the generated method small enough for the JIT.
        tag = tag.when(key.rlike("|".join(re.escape(k) for k in shortest_keys(keywords))), name)
    return tag.otherwise(OTHER)


def is_noise(body_lower: Column, rules: RuleSet = DEFAULT_RULES) -> Column:
    """Null or empty body, or one that holds an excluded key."""
    body = F.coalesce(body_lower, F.lit(""))
    return (body == "") | any_key(body, rules.exclusions, rules.word_boundary)


def label_array(tag: Column, body_lower: Column, rules: RuleSet = DEFAULT_RULES, noise_removed: bool = False) -> Column:
    """All labels that apply, in rule order.

    ``noise_removed=True`` says that excluded bodies were filtered before; vetoes
    that such a body would have tripped are then left out.
    """
    picked = []
    for label in rules.labels:
        vetoes = label.exclude
        if noise_removed and not rules.word_boundary:
            vetoes = tuple(v for v in vetoes if not any(x in v for x in rules.exclusions))
        hit = tag.isin(*label.tags) & any_key(body_lower, label.include, rules.word_boundary)
        if vetoes:
            hit = hit & ~any_key(body_lower, vetoes, rules.word_boundary)
        if not noise_removed:
            hit = hit & ~is_noise(body_lower, rules)
        picked.append(F.when(hit, F.lit(label.name)).otherwise(F.lit("")))
    if not picked:
        return F.array().cast("array<string>")
    return F.array_remove(F.array(*picked), "")


def first_label(tag: Column, body_lower: Column) -> Column:
    """Single label by first match, for the tagged view."""
    arms = []
    for name, keys, wanted in VIEW_LABELS:
        hit = any_key(body_lower, keys)
        arms.append((hit if wanted is None else hit & (tag == wanted), name))
    label = F.when(*arms[0])
    for arm in arms[1:]:
        label = label.when(*arm)
    return label.otherwise(VIEW_OTHER_LABEL)

"""Labels from a rule table of any size, by joins: nothing of the table comes to the driver.

Each keyword is filed under one of its n-grams, the one that fewest messages hold; messages meet the keywords of their n-grams,
and what meets is checked with ``contains``. So a keyword is compared with the messages that hold its rarest n-gram alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..rules import DEFAULT_RULES, RuleSet
from ..sources.settle import CODEC, settle
from .classify import drop_noise, keep_financial, tag_senders

GRAM = 3
#: The same where every keyword is long: a longer n-gram is held by fewer texts, and fewer texts are checked in vain.
LONG_GRAM = 6
#: Characters of an index up to which it goes to all tasks.
SMALL_INDEX = 4 << 20


def _grams(text: Column, n: int) -> Column:
    """Different substrings of ``n`` characters, found in one pass over the text; of a shorter text none."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))


def keyword_index(keywords: DataFrame, grams_of_messages: DataFrame, gram: int = GRAM) -> DataFrame:
    """(gram, keyword): the n-gram of each keyword that fewest messages hold. Keywords with one that no message holds match nothing and are left out."""
    own = F.when(F.length("keyword") == 0, F.array(F.lit("")))
    for n in range(1, gram):
        own = own.when(F.length("keyword") == n, F.array("keyword"))
    own = own.otherwise(_grams(F.col("keyword"), gram))
    filed = keywords.select("keyword", F.explode(own).alias("gram"))
    wanted = filed.select("gram").distinct()
    counts = grams_of_messages.join(wanted, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("keyword").orderBy("n", "gram")
    known = filed.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return known.withColumn("_nth", F.row_number().over(rarest)).where((F.col("_nth") == 1) & (F.col("n") > 0)).select("gram", "keyword")


def matches(texts: DataFrame, keywords: DataFrame, key: str = "raw_id", body: str = "_body_lower") -> DataFrame:
    """(key, keyword) for every text that contains a keyword, once each.

    ``texts (key, body)`` is read twice, or three times; equal keys must have equal texts. Where the index of keywords is small it goes to the texts,
    which are checked where they lie: only keys and what is found move. Otherwise keys and n-grams move, and each text once, to the keywords
    that are left to check.
    """
    short = keywords.agg(F.min(F.length("keyword"))).first()[0]
    if short is None:
        return texts.select(key).join(keywords.limit(0))
    longest = max(GRAM, min(short, LONG_GRAM))
    all_ = [_grams(F.col(body), n) for n in range(min(max(short, 1), longest), longest + 1)] + ([F.array(F.lit(""))] if short == 0 else [])
    grams = texts.select(key, F.explode(F.concat(*all_)).alias("gram"))
    index = settle(keyword_index(keywords, grams, longest), "keyword-index")
    if (index.agg(F.sum(F.length("gram") + F.length("keyword") + 32)).first()[0] or 0) <= SMALL_INDEX:
        held = texts.select(key, body, F.explode(F.concat(*all_)).alias("gram")).join(F.broadcast(index), "gram").where(F.contains(F.col(body), F.col("keyword")))
        return held.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_set("keyword").alias("_met")).select(key, F.explode("_met").alias("keyword"))
    met = grams.join(index, "gram").groupBy(key).agg(F.collect_set("keyword").alias("_met"))
    bodies = texts.select(key, body).dropDuplicates([key])
    held = F.filter("_met", lambda k: F.contains(F.col(body), k))
    return met.join(bodies, key).select(key, F.explode(held).alias("keyword"))


def label_by_rules(raw: DataFrame, rules: DataFrame, base: RuleSet = DEFAULT_RULES) -> DataFrame:
    """``label_messages(raw, RuleSet.from_table(rules))`` for rules ``(label, tags array, keyword, kind include|exclude)`` of any number.

    A label is given where the sender's tag is among the tags of any of its rows, one of its include keywords is
    found and none of its exclude keywords. ``categories`` are sorted by name.
    """
    tagged = drop_noise(keep_financial(tag_senders(raw, base), base), base)
    # Rows are known by a number, which is made once and written; ids are hashes and would be most of what moves.
    stored = settle(tagged.drop("_body_lower").withColumn("_row", F.monotonically_increasing_id()), "quiet-messages", CODEC).where(F.col("raw_id").isNotNull())
    quiet = stored.withColumn("_body_lower", F.coalesce(F.lower(F.col("sms_body")), F.lit("")))
    known = rules.where(F.col("keyword").isNotNull() & F.col("label").isNotNull())
    keywords = settle(known.select("keyword").distinct(), "keywords")
    tags = rules.groupBy("label").agg(F.array_distinct(F.flatten(F.collect_set("tags"))).alias("_tags"))
    each = known.select("label", "keyword", "kind").distinct().join(tags, "label")
    found = matches(quiet, keywords, "_row").join(each, "keyword").join(stored.select("_row", "sender_tag"), "_row")
    include = F.when((F.col("kind") == "include") & F.array_contains("_tags", F.col("sender_tag")), F.col("label"))
    exclude = F.when(F.col("kind") == "exclude", F.col("label"))
    sets = found.groupBy("_row").agg(F.collect_set(include).alias("_in"), F.collect_set(exclude).alias("_out"))
    labels = sets.select("_row", F.array_sort(F.array_except("_in", "_out")).alias("categories")).where(F.size("categories") > 0)
    return quiet.join(labels, "_row").select("raw_id", *[c for c in tagged.columns if c != "raw_id"], "categories")

"""Preference formatting: shared turns once as prompt, the rest of chosen and rejected as masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Template of one turn; only an assistant's text and its end mark are trained on.
HEAD, TAIL = ("<|", "|>\n"), "<|end|>\n"
TRAINED = "assistant"


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): a conversation's turns in order, as (role, text).

    Order is turn, role, text; exact repeats count once, a null turn number comes last, a null role is 'unknown', a null text empty. Rows
    without conv_id belong to no conversation and are left out. A conversation is rendered as one text, so its turns are gathered in one row.
    """
    c = conversations
    row = F.struct(c["turn"].isNull().alias("unplaced"), c["turn"].cast("long").alias("turn"), F.coalesce(c["role"], F.lit("unknown")).alias("role"),
                   F.coalesce(c["text"], F.lit("")).alias("text"))
    gathered = c.select(c["conv_id"].cast("long").alias("conv_id"), row.alias("t")).where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_set("t")).alias("t"))
    return gathered.select("conv_id", F.transform("t", lambda t: _turn(t["role"], t["text"])).alias("turns"))


def echo_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): the conversation, and the same with its last reply replaced by an echo of the turn before it.

    Conversations in which no assistant's turn follows another turn make no pair.
    """
    spots = F.filter(F.sequence(F.lit(2), F.greatest(F.size("turns"), F.lit(2))), lambda i: F.get("turns", i - 1)["role"] == TRAINED)
    last = turns.where(F.size("turns") >= 2).withColumn("last", F.array_max(spots)).where("last IS NOT NULL")
    echo = F.transform("turns", lambda t, i: F.when(i == F.col("last") - 1, _turn(t["role"], F.get("turns", i - 1)["text"])).otherwise(t))
    return last.select("conv_id", F.col("turns").alias("chosen"), echo.alias("rejected"))


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD[0]), role, F.lit(HEAD[1]), text, F.lit(TAIL))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: _rendered(t["role"], t["text"])), "")


def _mask(turns: Column) -> Column:
    """Spans of the rendered turns to train on, as 'start-end' in code points, comma-joined."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        body = state["at"] + F.length(t["role"]) + len("".join(HEAD))
        end = body + F.length(t["text"]) + len(TAIL)
        span = F.when(t["role"] == TRAINED, F.array(F.concat_ws("-", body.cast("string"), end.cast("string")))).otherwise(F.array().cast("array<string>"))
        return F.struct(end.alias("at"), F.concat(state["spans"], span).alias("spans"))

    return F.array_join(F.aggregate(turns, start, step)["spans"], ",")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(conv_id, shared_turns, prompt, chosen, chosen_mask, rejected, rejected_mask) of (conv_id, chosen, rejected) turn lists.

    The prompt is the longest common prefix of both, turn by turn (role and text equal). A side that is all shared has an empty completion
    and an empty mask; null lists count as empty.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = pairs.select("conv_id", F.coalesce("chosen", none).alias("a"), F.coalesce("rejected", none).alias("b"))
    shorter = F.least(F.size("a"), F.size("b"))
    apart = F.filter(F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.get("a", i) != F.get("b", i))
    cut = both.withColumn("n", F.coalesce(F.array_min(apart), shorter))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    return cut.select("conv_id", F.col("n").cast("int").alias("shared_turns"), _render(F.slice("a", F.lit(1), F.col("n"))).alias("prompt"),
                      _render(rest("a")).alias("chosen"), _mask(rest("a")).alias("chosen_mask"), _render(rest("b")).alias("rejected"), _mask(rest("b")).alias("rejected_mask"))


def echo_preferences(conversations: DataFrame) -> DataFrame:
    return format_pairs(echo_pairs(conversation_turns(conversations)))


#: The same over table ``conversations`` in DuckDB's SQL.
ORACLE_SQL = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
    SELECT *, row_number() OVER w AS i, lag(text) OVER w AS before FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)
), placed AS (
    SELECT *, max(i) FILTER (role = 'assistant' AND i >= 2) OVER (PARTITION BY conv_id) AS last FROM numbered
), sides AS (
    SELECT conv_id, i, last, 'chosen' AS side, role, text FROM placed WHERE last IS NOT NULL
    UNION ALL
    SELECT conv_id, i, last, 'rejected', role, CASE WHEN i = last THEN before ELSE text END FROM placed WHERE last IS NOT NULL
), differs AS (
    SELECT a.conv_id, coalesce(min(a.i) FILTER (a.text <> b.text) - 1, count(*)) AS n
    FROM sides a JOIN sides b ON a.conv_id = b.conv_id AND a.i = b.i AND a.side = 'chosen' AND b.side = 'rejected' GROUP BY a.conv_id
), shown AS (
    SELECT s.*, n, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece FROM sides s JOIN differs USING (conv_id)
), spans AS (
    SELECT *, coalesce(sum(length(piece)) FILTER (i > n) OVER (PARTITION BY conv_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun FROM shown
), masked AS (
    SELECT *, (begun + length(role) + 5)::BIGINT::VARCHAR || '-' || (begun + length(piece))::BIGINT::VARCHAR AS span FROM spans
)
SELECT conv_id, any_value(n)::INT AS shared_turns,
       coalesce(string_agg(piece, '' ORDER BY i) FILTER (side = 'chosen' AND i <= n), '') AS prompt,
       coalesce(string_agg(piece, '' ORDER BY i) FILTER (side = 'chosen' AND i > n), '') AS chosen,
       coalesce(string_agg(span, ',' ORDER BY i) FILTER (side = 'chosen' AND i > n AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(piece, '' ORDER BY i) FILTER (side = 'rejected' AND i > n), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY i) FILTER (side = 'rejected' AND i > n AND role = 'assistant'), '') AS rejected_mask
FROM masked GROUP BY conv_id
"""

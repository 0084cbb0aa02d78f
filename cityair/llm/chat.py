"""Preference formatting of paired conversations.

For each pair the longest common prefix of turns (same role, same text) is
rendered once as the prompt; what follows is rendered for the chosen and the
rejected side, with the spans that are trained: the text and end mark of the
assistant's turns. A turn renders as ``<|role|>``, a line feed, the text, a
line feed. Built-in functions only; one shuffle, by pair. A running sum over
a side's sorted turns tells where each turn begins, so work grows with the
number of turns and characters; a pair is one result row and must fit a task.

Defined results: turns are ordered by turn, then role, then text (nulls
first); null roles and texts render empty; equal turns may be null on both
sides; rows without a conversation id belong to no conversation and are left
out; a side without rows gives an empty completion and the status
``no_chosen`` or ``no_rejected`` (the prompt is then empty); equal sides give
status ``same`` with empty completions; repeated rows are turns of their own;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED = "assistant"


def _role(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit("\n"))


def render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(_role(t), _body(t))))


def spans(turns: Column) -> Column:
    """array<struct<start, length>> of the trained characters: the turns know
    where they begin in their whole side (``at``), ``turns`` where the first does."""
    begin = F.get(turns, F.lit(0))["at"]
    trained = F.filter(turns, lambda t: F.coalesce(t["role"] == TRAINED, F.lit(False)))
    return F.transform(trained, lambda t: F.struct(
        (t["at"] - begin + F.length(_role(t))).cast("int").alias("start"),
        F.length(_body(t)).alias("length")))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x[
        "role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    differs = F.array_position(same, F.lit(False)).cast("int")
    return F.when(differs > 0, differs - 1).otherwise(n)


def preference_pairs(turns: DataFrame, pair: Column, chosen: Column, turn_col: str = "turn",
                     role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a pair: pair_id, status, prompt_turns, prompt, chosen,
    rejected, chosen_spans, rejected_spans.

    ``pair`` gives a row's pair, ``chosen`` whether its conversation is the
    chosen one of that pair."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                    F.col(text_col).alias("text"))
    own = turns.select(pair.cast("long").alias("pair_id"), chosen.alias("is_chosen"),
                       turn.alias("t")).where("pair_id is not null and is_chosen is not null")
    # Rows are exchanged by pair once; each side's turns are sorted there, and
    # one running sum tells where a turn begins in its rendered side.
    before = Window.partitionBy("pair_id", "is_chosen").orderBy(
        "t.turn", "t.role", "t.text").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length(_role(F.col("t"))) + F.length(_body(F.col("t")))
    own = own.repartition("pair_id").select("pair_id", "is_chosen", F.col("t").withField(
        "at", F.coalesce(F.sum(size).over(before), F.lit(0))).alias("t"))
    side = lambda flag: F.sort_array(F.collect_list(
        F.when(F.col("is_chosen") == flag, F.col("t"))))
    both = own.groupBy("pair_id").agg(side(True).alias("c"), side(False).alias("r"))
    n = both.withColumn("n", common_prefix(F.col("c"), F.col("r")))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    cut = n.select("pair_id", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"),
                   rest(F.col("c")).alias("c_rest"), rest(F.col("r")).alias("r_rest"),
                   F.size("c").alias("c_n"), F.size("r").alias("r_n"))
    status = (F.when(F.col("c_n") == 0, "no_chosen").when(F.col("r_n") == 0, "no_rejected")
              .when((F.size("c_rest") == 0) & (F.size("r_rest") == 0), "same").otherwise("ok"))
    return cut.select(
        "pair_id", status.alias("status"), F.col("n").alias("prompt_turns"),
        render(F.col("p")).alias("prompt"), render(F.col("c_rest")).alias("chosen"),
        render(F.col("r_rest")).alias("rejected"), spans(F.col("c_rest")).alias("chosen_spans"),
        spans(F.col("r_rest")).alias("rejected_spans"))


def spans_text(column: str) -> Column:
    return F.concat_ws(",", F.transform(column, lambda s: F.concat(
        s["start"].cast("string"), F.lit("+"), s["length"].cast("string"))))


# DuckDB: the registered query's rows.
ORACLE = """
WITH turns AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS is_chosen,
         {'turn': turn, 'role': role, 'text': text} AS t
  FROM conversations WHERE conv_id IS NOT NULL),
both_sides AS (
  SELECT pair_id,
    coalesce(list(t ORDER BY t.turn NULLS FIRST, t.role NULLS FIRST, t.text NULLS FIRST)
             FILTER (is_chosen), []) AS c,
    coalesce(list(t ORDER BY t.turn NULLS FIRST, t.role NULLS FIRST, t.text NULLS FIRST)
             FILTER (NOT is_chosen), []) AS r
  FROM turns GROUP BY pair_id),
shared AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i:
      c[i].role IS DISTINCT FROM r[i].role OR c[i].text IS DISTINCT FROM r[i].text)) - 1,
      least(len(c), len(r))) AS n
  FROM both_sides),
cut AS (
  SELECT *, c[1:n] AS p, c[n + 1:] AS cr, r[n + 1:] AS rr FROM shared),
drawn AS (
  SELECT *,
    list_transform(p, lambda t: '<|' || coalesce(t.role, '') || '|>' || chr(10)
                   || coalesce(t.text, '') || chr(10)) AS ps,
    list_transform(cr, lambda t: '<|' || coalesce(t.role, '') || '|>' || chr(10)
                   || coalesce(t.text, '') || chr(10)) AS cs,
    list_transform(rr, lambda t: '<|' || coalesce(t.role, '') || '|>' || chr(10)
                   || coalesce(t.text, '') || chr(10)) AS rs
  FROM cut)
SELECT pair_id,
  CASE WHEN len(c) = 0 THEN 'no_chosen' WHEN len(r) = 0 THEN 'no_rejected'
       WHEN len(cr) = 0 AND len(rr) = 0 THEN 'same' ELSE 'ok' END AS status,
  CAST(n AS INTEGER) AS prompt_turns,
  coalesce(array_to_string(ps, ''), '') AS prompt,
  coalesce(array_to_string(cs, ''), '') AS chosen,
  coalesce(array_to_string(rs, ''), '') AS rejected,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(cr) + 1),
    lambda i: cr[i].role = 'assistant'), lambda i:
    CAST(length(array_to_string(cs[1:i - 1], '')) + length(cr[i].role) + 5 AS VARCHAR) || '+'
    || CAST(length(coalesce(cr[i].text, '')) + 1 AS VARCHAR)), ','), '') AS chosen_spans,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(rr) + 1),
    lambda i: rr[i].role = 'assistant'), lambda i:
    CAST(length(array_to_string(rs[1:i - 1], '')) + length(rr[i].role) + 5 AS VARCHAR) || '+'
    || CAST(length(coalesce(rr[i].text, '')) + 1 AS VARCHAR)), ','), '') AS rejected_spans
FROM drawn
"""

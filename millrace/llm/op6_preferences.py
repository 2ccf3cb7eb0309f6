"""Preference pairs for chat training."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources import table


def render(turns: Column) -> Column:
    """Turns as text: a role line, the text, an end mark. The mark's opening in a text is escaped."""
    return F.array_join(F.transform(turns, _turn), "")


def _head(t: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(t["role"], F.lit("")), F.lit("|>\n"))


def _body(t: Column) -> Column:
    return F.replace(F.coalesce(t["text"], F.lit("")), F.lit("<|"), F.lit("<\\|"))


def _turn(t: Column) -> Column:
    return F.concat(_head(t), _body(t), F.lit("<|end|>\n"))


def trained_spans(turns: Column) -> Column:
    """Where a loss is taken in the rendered turns: the assistant's text and its end mark, as start:end in code points."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        a = acc["at"] + F.length(_head(t))
        b = a + F.length(_body(t)) + 7
        span = F.array(F.concat_ws(":", a.cast("string"), b.cast("string")))
        mine = t["role"].eqNullSafe("assistant")
        return F.struct((b + 1).alias("at"), F.when(mine, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda a: F.array_join(a["spans"], ","))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """``turns(pair_id, side, turn, role, text)`` with side chosen or rejected -> one row per pair.

    Each side's turns are ordered by turn (ties by role, then text); the longest common prefix of
    equal (role, text) turns is rendered once as the prompt, and what follows on either side as two
    completions with masks of the assistant's spans. A conversation is one value, as it is in the
    result; rows meet by pair and side only, and rows of one pair are bounded by its two
    conversations.

    A null text or role equals another null and renders as empty. A pair without one of its sides
    has no common prefix, and that side's completion is empty. Equal sides leave two empty
    completions. Rows with a null pair_id, or with another side, are ignored; other columns are
    ignored; repeated rows are repeated turns; an empty table gives no rows. Columns: pair_id,
    n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask.
    """
    t = F.struct("turn", "role", "text")
    sides = [F.transform(F.sort_array(F.collect_list(F.when(F.col("side") == s, t))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(s) for s in ("chosen", "rejected")]
    both = turns.where("pair_id IS NOT NULL AND side IN ('chosen', 'rejected')").groupBy("pair_id").agg(*sides)
    # zip_with pads the shorter side with nulls, which equal no turn
    same = F.zip_with("chosen", "rejected", lambda a, b: a.isNotNull() & b.isNotNull() & a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    first = F.array_position(same, False).cast("int")
    both = both.withColumn("n", F.when(first == 0, F.size("chosen")).otherwise(first - 1))
    rest = lambda c: F.slice(F.col(c), F.col("n") + 1, F.size(c) + 1)
    return both.select("pair_id", F.col("n").cast("long").alias("n_prompt_turns"), render(F.slice("chosen", F.lit(1), F.col("n"))).alias("prompt"), render(rest("chosen")).alias("chosen"), render(rest("rejected")).alias("rejected"), trained_spans(rest("chosen")).alias("chosen_mask"), trained_spans(rest("rejected")).alias("rejected_mask"))


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: conversations 2k and 2k + 1 are a pair.

    Chosen is conversation 2k. Rejected is conversation 2k up to its last assistant turn and then,
    from that turn number on, the turns of conversation 2k + 1. A conversation without an assistant
    turn is its own whole prefix. An odd conversation without its even one is ignored.
    """
    c = conversations.where("conv_id IS NOT NULL").select((F.floor(F.col("conv_id") / 2)).cast("long").alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 1).alias("odd"), "turn", "role", "text")
    last = c.where("NOT odd").groupBy("pair_id").agg(F.coalesce(F.max(F.when(F.col("role") == "assistant", F.col("turn"))), F.max("turn") + 1).alias("last"))
    j = c.join(last, "pair_id")
    chosen = j.where("NOT odd").select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
    rejected = j.where(F.when(F.col("odd"), F.col("turn") >= F.col("last")).otherwise(F.col("turn") < F.col("last"))).select("pair_id", F.lit("rejected").alias("side"), "turn", "role", "text")
    return chosen.union(rejected)


def op6_preferences(spark, folder: str) -> DataFrame:
    return preference_pairs(neighbour_pairs(table(spark, folder, "conversations")))


SQL = r"""
WITH c AS (SELECT conv_id // 2 AS pair_id, conv_id % 2 = 1 AS odd, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT pair_id, coalesce(max(turn) FILTER (WHERE role = 'assistant'), max(turn) + 1) AS last FROM c WHERE NOT odd GROUP BY 1),
t AS (
  SELECT c.pair_id, 'chosen' AS side, turn, role, text FROM c JOIN l USING (pair_id) WHERE NOT odd
  UNION ALL
  SELECT c.pair_id, 'rejected', turn, role, text FROM c JOIN l USING (pair_id) WHERE CASE WHEN odd THEN turn >= last ELSE turn < last END),
n AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS pos,
    '<|' || coalesce(role, '') || '|>' || chr(10) AS head, replace(coalesce(text, ''), '<|', '<\|') AS body FROM t),
p AS (SELECT DISTINCT pair_id FROM n),
bad AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, min(coalesce(a.pos, b.pos)) AS pos
  FROM (SELECT * FROM n WHERE side = 'chosen') a FULL JOIN (SELECT * FROM n WHERE side = 'rejected') b
    ON a.pair_id = b.pair_id AND a.pos = b.pos AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text
  WHERE a.pair_id IS NULL OR b.pair_id IS NULL GROUP BY 1),
m AS (
  SELECT n.*, n.pos < coalesce(bad.pos, 1000000000) AS common, length(head) + length(body) + 8 AS size FROM n LEFT JOIN bad USING (pair_id)),
o AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY pair_id, side, common ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS a FROM m),
g AS (
  SELECT pair_id, side,
    count(*) FILTER (WHERE common) AS n_prompt_turns,
    coalesce(string_agg(head || body || '<|end|>' || chr(10), '' ORDER BY pos) FILTER (WHERE common), '') AS prompt,
    coalesce(string_agg(head || body || '<|end|>' || chr(10), '' ORDER BY pos) FILTER (WHERE NOT common), '') AS rest,
    coalesce(string_agg(CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(a + length(body) + 7 AS BIGINT) AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE NOT common AND role = 'assistant'), '') AS mask
  FROM o GROUP BY 1, 2)
SELECT p.pair_id, coalesce(x.n_prompt_turns, 0) AS n_prompt_turns, coalesce(x.prompt, '') AS prompt, coalesce(x.rest, '') AS chosen,
  coalesce(y.rest, '') AS rejected, coalesce(x.mask, '') AS chosen_mask, coalesce(y.mask, '') AS rejected_mask
FROM p LEFT JOIN (SELECT * FROM g WHERE side = 'chosen') x USING (pair_id) LEFT JOIN (SELECT * FROM g WHERE side = 'rejected') y USING (pair_id)
"""

"""Chat formatting for preference training.

A pair is two conversations, chosen and rejected.  Their longest common prefix
of turns (equal role and text) is rendered once as the prompt; what follows in
either conversation is its completion.  The loss mask of a completion covers the
text and end mark of its assistant turns; it is given as character spans
(code points) of the completion, so that it fits any tokenizer.

A turn is rendered as ``<|role|>`` newline, text, ``<|end|>`` newline.

``borrowed_replies`` makes pairs from plain conversations, one for each: chosen is the
conversation with all its turns.  Rejected parts from it at the first assistant turn whose
text is not that of the partner's assistant turn of the same rank (ids 2k and 2k + 1 are
partners; a missing turn differs from every other): the turns before it stay, and the
partner's turns from its assistant turn of that rank on follow, those of the user included.

Only DataFrame functions are used.  Turns are shuffled once, by pair of partners, and the work
on a pair is inside one row, which two conversations have to fit.

Defined cases: rows with a null ``conv_id`` belong to no conversation; turns sort
by turn number (nulls first), then role, then text, so ties and repeated rows have
one order; null role or text counts as empty; a conversation without a partner has a rejected
side that ends before its first assistant turn; where the assistant turns of both are the same, or
both have none, rejected is chosen itself: completions are empty and ``is_tie``; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def partners(turns: DataFrame) -> DataFrame:
    """(half, even, odd): the turns of the conversations 2 * half and 2 * half + 1 in order, empty if there is none."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    odd = F.expr("conv_id & 1") == 1

    def ordered(some: Column) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.when(some, turn))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))

    return (turns.where(F.col("conv_id").isNotNull()).groupBy(F.shiftright("conv_id", 1).alias("half"))
            .agg(ordered(~odd).alias("even"), ordered(odd).alias("odd")))


def render(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def render_all(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render), "")


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two turn lists."""
    n = F.least(F.size(a), F.size(b))
    pairs = F.slice(F.arrays_zip(a.alias("a"), b.alias("b")), 1, n)
    differs = F.transform(pairs, lambda p: ~(p["a"].eqNullSafe(p["b"])))
    first = F.array_position(differs, True)
    return F.when(n == 0, F.lit(0)).when(first == 0, n).otherwise((first - 1).cast("int"))


def rest(turns: Column, n: Column) -> Column:
    return F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0)))


def mask(turns: Column) -> Column:
    """Spans of the assistant turns' text and end mark in the rendered turns."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, t):
        start = acc["at"] + F.char_length(t["role"]) + 5
        end = start + F.char_length(t["text"]) + 7
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        none = F.array().cast("array<struct<start:int,end:int>>")
        return F.struct((end + 1).alias("at"), F.concat(acc["spans"], F.when(t["role"] == ASSISTANT, span).otherwise(none)).alias("spans"))

    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """From (pair_id, chosen, rejected), the two as turn lists: pair_id,
    n_prompt_turns, prompt, both completions with their masks, is_tie."""
    cut = pairs.withColumn("n", common_turns(F.col("chosen"), F.col("rejected"))).select(
        "pair_id", "n", F.slice("chosen", 1, F.col("n")).alias("p"),
        rest(F.col("chosen"), F.col("n")).alias("c"), rest(F.col("rejected"), F.col("n")).alias("r"))
    return cut.select("pair_id", F.col("n").cast("long").alias("n_prompt_turns"), render_all(F.col("p")).alias("prompt"),
                      render_all(F.col("c")).alias("chosen"), mask(F.col("c")).alias("chosen_mask"),
                      render_all(F.col("r")).alias("rejected"), mask(F.col("r")).alias("rejected_mask"),
                      (F.size("c") + F.size("r") == 0).alias("is_tie"))


def assistant_turns(turns: Column) -> Column:
    """(at, text) of the assistant turns, ``at`` counted from 0."""
    marked = F.transform(turns, lambda t, i: F.struct(i.alias("at"), t["role"].alias("role"), t["text"].alias("text")))
    return F.transform(F.filter(marked, lambda t: t["role"] == ASSISTANT), lambda t: F.struct(t["at"].alias("at"), t["text"].alias("text")))


def borrowed_replies(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) from plain conversations."""
    def side(bit: int, own: str, other: str) -> Column:
        return F.struct((F.col("half") * 2 + bit).alias("pair_id"), F.col(own).alias("own"), F.col(other).alias("other"))

    both = partners(turns).select(F.explode(F.array(side(0, "even", "odd"), side(1, "odd", "even"))).alias("s")).select("s.*").where(F.size("own") > 0)
    ranked = both.withColumn("a", assistant_turns(F.col("own"))).withColumn("b", assistant_turns(F.col("other")))
    same = common_turns(F.transform("a", lambda t: t["text"]), F.transform("b", lambda t: t["text"]))
    parted = ranked.withColumn("same", same).select(
        "pair_id", "own", "other", ((F.size("a") == F.col("same")) & (F.size("b") == F.col("same"))).alias("equal"),
        F.coalesce(F.get("a", F.col("same"))["at"], F.size("own")).alias("keep"), F.coalesce(F.get("b", F.col("same"))["at"], F.size("other")).alias("skip"))
    return parted.select("pair_id", F.col("own").alias("chosen"), F.when(F.col("equal"), F.col("own")).otherwise(
        F.concat(F.slice("own", F.lit(1), F.col("keep")), rest(F.col("other"), F.col("skip")))).alias("rejected"))


def preference_records(turns: DataFrame) -> DataFrame:
    return format_pairs(borrowed_replies(turns))


def spans_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")


#: The same in SQL, over the whole table.
ORACLE_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, xor(conv_id, 1) AS partner FROM t),
s AS (SELECT conv_id, text, i, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS k FROM t WHERE role = 'assistant'),
ks AS (SELECT ids.conv_id, ids.partner, s.k FROM ids JOIN s ON s.conv_id IN (ids.conv_id, ids.partner) GROUP BY ALL),
d AS (SELECT ks.conv_id, min(ks.k) AS k FROM ks LEFT JOIN s o ON o.conv_id = ks.conv_id AND o.k = ks.k
      LEFT JOIN s q ON q.conv_id = ks.partner AND q.k = ks.k WHERE o.text IS DISTINCT FROM q.text GROUP BY ks.conv_id),
f AS (SELECT ids.conv_id, ids.partner, o.i AS keep, q.i AS skip, d.k IS NOT NULL AS parts FROM ids LEFT JOIN d ON d.conv_id = ids.conv_id
      LEFT JOIN s o ON o.conv_id = ids.conv_id AND o.k = d.k LEFT JOIN s q ON q.conv_id = ids.partner AND q.k = d.k),
v AS (SELECT f.conv_id, t.role, t.text, 0 AS part, t.i FROM f JOIN t ON t.conv_id = f.conv_id WHERE NOT f.parts OR f.keep IS NULL OR t.i < f.keep
      UNION ALL SELECT f.conv_id, t.role, t.text, 1, t.i FROM f JOIN t ON t.conv_id = f.partner WHERE f.parts AND t.i >= f.skip),
w AS (SELECT conv_id, 'c' AS side, role, text, i AS j FROM t
      UNION ALL SELECT conv_id, 'r', role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) FROM v),
n AS (SELECT conv_id, count(*) FILTER (WHERE held) AS n FROM (
        SELECT conv_id, j, bool_and(equal) OVER (PARTITION BY conv_id ORDER BY j) AS held FROM (
          SELECT conv_id, j, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS equal FROM w GROUP BY conv_id, j)) GROUP BY conv_id),
x AS (SELECT w.*, n.n, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS turn FROM w JOIN n ON n.conv_id = w.conv_id),
y AS (SELECT *, sum(length(turn)) OVER (PARTITION BY conv_id, side, j > n ORDER BY j) - length(turn) + length(role) + 5 AS start FROM x),
z AS (SELECT *, CAST(start AS BIGINT) || ':' || CAST(start + length(text) + 7 AS BIGINT) AS span FROM y)
SELECT conv_id AS pair_id, CAST(max(n) AS BIGINT) AS n_prompt_turns,
       coalesce(string_agg(turn, '' ORDER BY j) FILTER (WHERE side = 'c' AND j <= n), '') AS prompt,
       coalesce(string_agg(turn, '' ORDER BY j) FILTER (WHERE side = 'c' AND j > n), '') AS chosen,
       coalesce(string_agg(turn, '' ORDER BY j) FILTER (WHERE side = 'r' AND j > n), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY j) FILTER (WHERE side = 'c' AND j > n AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(span, ',' ORDER BY j) FILTER (WHERE side = 'r' AND j > n AND role = 'assistant'), '') AS rejected_spans,
       max(j) = max(n) AS is_tie
FROM z GROUP BY conv_id
"""

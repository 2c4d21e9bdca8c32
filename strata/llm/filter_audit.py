"""Filter interaction audit over relations of failing ids.

Each filter's failing documents are one stored id table.  A document is known by
its ``key`` (a hash of id and text), so that documents of equal id stay apart.

1.  *Documents.*  Rows that agree in part, id, text and labels are one row with a count, before any
    join: copies of a row, however many, cost one.
2.  *Failing-id tables.*  Four filters look at the text alone; the fifth (copies) holds all
    documents but the first of each text, by an anti join on keys: a text that a
    third of all documents hold is one minimum, added up where it is read, and no join key.
3.  *Removals.*  A left-semi join of the documents with a filter's id table gives what
    the filter fails.  Left-anti joins with the other tables, one after the other, give
    for every set of filters before it what is left to remove: after each table the rows
    that pass it are kept twice, with and without that filter in the set, so five joins serve
    all 80 pairs of a filter and a set before it.  At most 16 rows arise from a failing document, and none
    from one that fails nothing.
4.  *Orders.*  What a step removes depends on the set before it, not on its order.  The
    120 orders read their steps from the small table of (part, filter, set) sums: survivors are the part's
    documents less the removals up to the step, redundancies the filter's failures less its removal.

All tables between steps lie in the shared checkpoint folder.  Nothing is collected.

Defined cases: null text is empty; null source is the part ''; a part without failing
documents has its rows, zeros included; documents of equal id are documents of their own, and count each;
a null id is copied from nothing and makes no copies; labels of an id are combined: it
is good (toxic) if any of its label rows says so; an empty table has no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

from .common import text_of

FILTERS = "ABCDE"

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"


def text_failures(text: Column) -> dict[str, Column]:
    """Whether a text (not null) fails the filters A to D."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n = F.size(words)
    return {"A": n < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
            "C": 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 2 * F.length(text),
            "D": text.rlike(SYMBOLS)}


def documents_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, doc_id, digest, key, n, A..D, good, toxic): one row for all rows that agree."""
    text = F.coalesce(text_of(docs), F.lit(""))
    rows = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "doc_id", text.alias("text"))
    rows = rows.select("part", "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), *(c.alias(k) for k, c in text_failures(F.col("text")).items()))
    rows = rows.groupBy("part", "doc_id", "digest", *FILTERS[:4]).agg(F.count("*").alias("n"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    key = F.unhex(F.sha2(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex("digest")), 256))
    return (rows.join(known, "doc_id", "left")
            .select("part", "doc_id", "digest", F.substring(key, 1, 16).alias("key"), "n", *FILTERS[:4],
                    *((F.coalesce(c, F.lit(0)) * F.col("n")).alias(c) for c in ("good", "toxic"))))


def copies(rows: DataFrame) -> DataFrame:
    """Keys of documents whose text a smaller id has, too."""
    ids = rows.where("doc_id is not null").select("doc_id", "digest", "key")
    firsts = ids.groupBy("digest").agg(F.min(F.struct("doc_id", "key")).alias("first")).select("first.key")
    return ids.select("key").join(firsts, "key", "left_anti")


def failing_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """One stored table of keys for each filter."""
    found = {f: rows.where(F.col(f)).select("key") for f in FILTERS[:4]} | {"E": copies(rows)}
    return {f: materialize(t.distinct()) for f, t in found.items()}


def removals(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """(part, filter, before, removed, good_lost, toxic_lost): what each filter removes after
    each set of others (``before``: their bits), summed.  Sums of 0 have no row."""
    rows = rows.select("key", "part", "n", "good", "toxic")
    left = reduce(DataFrame.unionByName, (rows.join(t, "key", "left_semi").withColumn("filter", F.lit(i)) for i, t in enumerate(failing.values())))
    left = materialize(left.withColumn("before", F.lit(0)))
    for i, table in enumerate(failing.values()):
        passed = left.where(F.col("filter") != i).join(table, "key", "left_anti").withColumn("before", F.col("before") + (1 << i))
        left = materialize(left.unionByName(passed))
    return left.groupBy("part", "filter", "before").agg(F.sum("n").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))


def steps() -> list[tuple[str, int, int, int]]:
    """(order, step, filter, set before it) of all orders."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, letter in enumerate(order, 1):
            out.append((order, step, FILTERS.index(letter), before))
            before |= 1 << FILTERS.index(letter)
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley."""
    rows = materialize(documents_of(docs, labels))
    sums = materialize(removals(rows, failing_tables(rows)))
    parts = rows.groupBy("part").agg(F.sum("n").alias("documents"))
    bits = F.bit_count("before").cast("int")
    shares = F.element_at(F.array(*(F.lit(factorial(k) * factorial(len(FILTERS) - 1 - k)) for k in range(len(FILTERS)))), bits + 1)
    others = F.expr(f"{(1 << len(FILTERS)) - 1} - shiftleft(1, filter)")
    per_filter = sums.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("before") == others, F.col("removed"))).alias("unique_fails"), F.sum(F.col("removed") * shares).alias("shapley"))
    # the table of sums as maps of one part: 80 sums and 5 filters at most
    entry = F.struct("removed", "good_lost", "toxic_lost")
    after = sums.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct((32 * F.col("filter") + F.col("before")).alias("k"), entry.alias("v")))).alias("after"))
    whole = per_filter.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("filter", F.struct("fails", "unique_fails", "shapley").alias("v")))).alias("whole"))
    order = F.explode(F.expr("array(" + ", ".join(f"struct('{o}' as filter_order, {s} as step, {f} as filter, {b} as before)" for o, s, f, b in steps()) + ")")).alias("o")
    grid = parts.join(after, "part", "left").join(whole, "part", "left").select("part", "documents", "after", "whole", order).select("part", "documents", "after", "whole", "o.*")
    at = lambda m, k, field: F.coalesce(F.try_element_at(m, k)[field], F.lit(0)).cast("long")
    now = 32 * F.col("filter") + F.col("before")
    upto = Window.partitionBy("part", "filter_order").orderBy("step")
    got = grid.select("part", "documents", "filter_order", "step", at("after", now, "removed").alias("removed"), at("whole", F.col("filter"), "fails").alias("fails"),
                      at("whole", F.col("filter"), "unique_fails").alias("unique_fails"), at("after", now, "good_lost").alias("good_lost"),
                      at("after", now, "toxic_lost").alias("toxic_lost"), at("whole", F.col("filter"), "shapley").alias("shapley"))
    return got.select("part", "filter_order", "step", (F.col("documents") - F.sum("removed").over(upto)).alias("kept"), "removed",
                      (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")


#: The same in SQL, from the documents' failures as bits: no joins of id tables.
ORACLE_SQL = r"""
WITH t AS (SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT part, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
g AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  (CASE WHEN len(w) < 200 THEN ['A'] ELSE [] END) || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN ['B'] ELSE [] END)
  || (CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text) THEN ['C'] ELSE [] END)
  || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN ['D'] ELSE [] END) || (CASE WHEN least < doc_id THEN ['E'] ELSE [] END) AS f
  FROM w LEFT JOIN g USING (doc_id)),
c AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, f),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, string_split(substr(filter_order, 1, step - 1), '') AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, x,
  sum(CASE WHEN NOT list_has_any(f, before) AND NOT list_contains(f, x) THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN NOT list_has_any(f, before) AND list_contains(f, x) THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN list_has_any(f, before) AND list_contains(f, x) THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN f = [x] THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN NOT list_has_any(f, before) AND list_contains(f, x) THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN NOT list_has_any(f, before) AND list_contains(f, x) THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""

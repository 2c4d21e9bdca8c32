"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are the windows of ``WINDOW`` consecutive words of each benchmark item
(one shorter window for a shorter item).  For each pattern length there is one
table set.  The search looks at the block of two words that ends at a position:
a *shift table* says how far the position may move because no pattern has that
block so near its end (a block in no pattern skips almost a whole window), and
where the shift is zero, a *suffix bucket* lists the patterns that end in this
block, which are then compared word by word.

The windows are divided into blocks of at most about ``BLOCK`` by hash; each
block is sent to the tasks on its own and searched against every document, so
the size that is broadcast has a bound whatever the benchmark's size.

Defined cases: null or empty texts have no words and no hits; items without
words have no windows; items with a null id mark words as hit but are not
listed; equal ids in several rows count once; one output row per input row.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

from .common import free_name, match_words, text_of

WINDOW = 10
BLOCK = 200_000

HITS = "n_words long, hits array<struct<s:int,e:int>>, items array<string>"


class Tables:
    """Shift table and suffix buckets for patterns of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.miss = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list] = defaultdict(list)

    def add(self, words: tuple, items: tuple) -> None:
        for end in range(self.block, self.length + 1):
            key, move = words[end - self.block:end], self.length - end
            if move < self.shift.get(key, self.miss):
                self.shift[key] = move
        self.bucket[words[-self.block:]].append((words, items))

    def search(self, words: list) -> Iterable[tuple[int, tuple]]:
        """(start, items) of every occurrence, in order."""
        at, n, m, b = self.length, len(words), self.length, self.block
        shift, miss, bucket = self.shift.get, self.miss, self.bucket
        while at <= n:
            key = tuple(words[at - b:at])
            move = shift(key, miss)
            if move:
                at += move
                continue
            text = tuple(words[at - m:at])
            for pattern, items in bucket[key]:
                if pattern == text:
                    yield at - m, items
            at += 1


def build(patterns: Iterable[tuple[str, list]]) -> list[Tables]:
    tables: dict[int, Tables] = {}
    for window, items in patterns:
        words = tuple(window.encode("utf-8").split(b" "))
        tables.setdefault(len(words), Tables(len(words))).add(words, tuple(items))
    return list(tables.values())


def find(words: list, tables: list[Tables]) -> tuple[list[tuple[int, int]], list[str]]:
    """Hit intervals (merged, end exclusive) and ids of the items that occur."""
    spans, items = [], set()
    for t in tables:
        for start, ids in t.search(words):
            spans.append((start, start + t.length))
            items.update(ids)
    merged: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            if e > merged[-1][1]:
                merged[-1] = (merged[-1][0], e)
        else:
            merged.append((s, e))
    return merged, sorted(items)


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(window, items): each distinct window and the sorted ids that hold it."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            w = [x.decode("utf-8", "replace") for x in match_words(t)]
            out.append(sorted({" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else []))
        return pd.Series(out)

    return (benchmark.select(F.col("item_id").cast("string").alias("item"), F.explode(cut(text_of(benchmark))).alias("window"))
            .groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")))


def search_column(text: Column, tables: list[Tables]) -> Column:
    @F.pandas_udf(HITS)
    def search(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            words = match_words(t)
            spans, items = find(words, tables)
            rows.append((len(words), [{"s": s, "e": e} for s, e in spans], items))
        return pd.DataFrame(rows, columns=["n_words", "hits", "items"])

    return search(text)



def with_hits(docs: DataFrame, benchmark: DataFrame, name: str, width: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``docs`` with a struct column ``name`` (n_words, hits, items)."""
    found = materialize(windows(benchmark, width))
    size = found.agg(F.sum(F.size("items") + 1)).first()[0] or 0
    blocks = max(1, -(-size // block))
    out = docs
    for b in range(blocks):
        part = found if blocks == 1 else found.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)
        tables = build((r["window"], r["items"]) for r in part.toLocalIterator())
        hit = search_column(text_of(docs), tables)
        if b == 0:
            out = out.withColumn(name, hit)
        else:  # one block in memory at a time: earlier blocks' hits are read back
            new = free_name(out, name + "_new")
            out = materialize(out).withColumn(new, hit).withColumn(name, F.struct(
                F.col(f"{new}.n_words").alias("n_words"), F.concat(f"{name}.hits", f"{new}.hits").alias("hits"),
                F.array_union(f"{name}.items", f"{new}.items").alias("items"))).drop(new)
    return out


def hit_words(hits: Column) -> Column:
    """Words covered by a list of intervals (which may overlap)."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, x: F.struct(
        F.greatest(acc["end"], x["e"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["end"]))).alias("n"))
    return F.aggregate(F.array_sort(hits), zero, step, lambda acc: acc["n"])


def scan(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, the items and the hit spans."""
    rows = with_hits(docs.select("doc_id", text_of(docs).alias("text")), benchmark, "f")
    return rows.select("doc_id", "f.n_words", hit_words(F.col("f.hits")).alias("n_hit"),
                       F.size("f.items").cast("long").alias("n_items"), "f.items", "f.hits")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs."""
    f = free_name(docs, "_found")
    return (with_hits(docs, benchmark, f).where(F.size(f"{f}.hits") == 0)
            .select(*[f"`{c}`" for c in docs.columns]))


#: The same as ``scan``'s digest in SQL, over the whole tables: a join of windows.
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
p AS (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
q AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM p),
x AS (SELECT id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM q) WHERE len(w) >= k),
h AS (SELECT DISTINCT id, i, k, item FROM (SELECT id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM x) JOIN q USING (k, g)),
c AS (SELECT id, count(DISTINCT j) AS n FROM (SELECT id, unnest(range(i, i + k)) AS j FROM h) GROUP BY id),
t AS (SELECT id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM h WHERE item IS NOT NULL) GROUP BY id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (id) LEFT JOIN t USING (id)
"""

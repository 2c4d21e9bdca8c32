"""Source divergence audit: which sources of a language use its terms differently.

1.  *Token-start pointers.*  A task joins its Arrow batches to shards of about
    ``SHARD_BYTES``.  Over a shard's text buffer a pointer is built for each place where a term
    starts, and the pointers are sorted by the terms' bytes with a multikey
    quicksort: slices are parted in three by an eight-byte key at the median, the middle
    part goes on with the next eight bytes, and small slices are sorted key by key.
2.  *Equal runs.*  A run of pointers with equal terms gives the term's occurrences and
    documents for each (lang, source); one row of each goes to the shuffle.
3.  *Terms.*  Rows meet by (lang, term); a language keeps the terms that ``LEAST_DOCS`` of
    its documents hold.  A kept term is one row with its counts by source (no more than there
    are sources).
4.  *Terms that stand out.*  Each source's terms are ranked by their divergence; only the first
    ``TOP`` of a source leave a task.
5.  *Pairs of sources.*  The divergence of two sources is a sum over all kept terms of the
    language.  For a term with counts in both it is computed for the pair; the rest depends on
    one count at most, and is summed by distinct counts.  Tasks add up matrices of source by source in
    exact integers; no pair of one term is ever a row.  Sources are taken in blocks of about
    ``BLOCK``, whose counts are the only thing sent to tasks: any number of sources works
    with bounded memory, and the result itself holds a row for each pair.

p and q are 1 + floor(10^9 (count + 1) / (N + V)), taken in three steps of a thousand,
which are exact for any N below 9 * 10^15.

Defined cases: null text, lang and source are ''; texts without terms make their group
appear with pairs and no terms; a language without kept terms has pairs of value 0;
repeated rows and rows of equal or null id are documents of their own; a language with one source
has no pairs; an empty table has no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

from .common import text_of
from .vocabulary import spread

SHARD_BYTES = 16 << 20
LEAST_DOCS = 3
TOP = 200
UNIT = 1_000_000_000

#: Sources whose counts a task holds at once on each side, and pairs it computes at once.
BLOCK = 2048
PAIRS = 1 << 19
#: Groups up to which their one-row statistics are sent to all tasks (each some 60 bytes).
BROADCAST_GROUPS = 100_000

#: Slices up to which pointers are sorted key by key.
SLICE = 1 << 16

#: A-Z are a-z, bytes of no term are 0.
FOLDED = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0 for c in range(256))

# ---------------------------------------------------------------- token pointers


class Shard:
    """Texts in a row as one folded buffer, with a pointer for each term's start."""

    def __init__(self, texts: pa.Array):
        n = len(texts)
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
        raw = memoryview(texts.buffers()[2] or b"")[ends[0]:ends[-1]] if n else b""
        self.buffer = bytes(raw).translate(FOLDED) + bytes(8)
        self.bytes = np.frombuffer(self.buffer, np.uint8)
        self.ends = ends[1:] - ends[0] if n else np.zeros(0, np.int64)
        begins = np.concatenate([[0], self.ends])[:n]
        body = self.bytes[:-8] != 0
        size = len(body)
        first = body.copy()
        first[1:] &= ~body[:-1]
        last = body.copy()
        last[:-1] &= ~body[1:]
        inside = begins[(begins > 0) & (begins < size)]  # a text's border ends a term, too
        first[inside] = body[inside]
        last[inside - 1] = body[inside - 1]
        self.start = np.flatnonzero(first)
        self.length = np.flatnonzero(last) - self.start + 1
        self.doc = np.searchsorted(self.ends, self.start, "right")
        self.eight = np.ndarray((max(len(self.bytes) - 7, 0),), ">u8", self.buffer, strides=(1,))

    def key(self, which: np.ndarray, depth: int) -> np.ndarray:
        """The eight bytes of the terms from ``depth`` on as numbers that sort as they do; 0 beyond a term's end."""
        left = self.length[which] - depth
        at = np.minimum(self.start[which] + depth, len(self.eight) - 1)
        return np.where(left > 0, self.eight[at].astype(np.uint64) & _HEAD[np.clip(left, 0, 8)], np.uint64(0))

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """The pointers sorted by their terms, and the run of equal terms that each is in."""
        order, first = np.arange(len(self.start)), np.zeros(len(self.start), bool)
        waiting = [(0, len(order), 0)]
        while waiting:
            lo, hi, depth = waiting.pop()
            if hi <= lo:
                continue
            if hi - lo <= SLICE:
                order[lo:hi], first[lo:hi] = self._sorted(order[lo:hi], depth)
                continue
            part = order[lo:hi]
            key = self.key(part, depth)
            pivot = np.partition(key[::64], len(key) // 128)[len(key) // 128]
            less, more = key < pivot, key > pivot
            same = part[~(less | more)]
            one = lo + int(less.sum())
            two = one + len(same)
            order[lo:one], order[two:hi] = part[less], part[more]
            order[one:two] = same
            waiting += [(lo, one, depth), (two, hi, depth)]
            if int(pivot) & 0xFF:
                waiting.append((one, two, depth + 8))
            else:
                first[one] = True
        return order, np.cumsum(first) - 1

    def _sorted(self, part: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """A small slice sorted from ``depth`` on, and where its runs begin."""
        key = self.key(part, depth)
        by = np.argsort(key)
        part, key = part[by], key[by]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        at = np.arange(len(part))
        while True:
            more = (key & np.uint64(0xFF)) != 0  # not at its end, and in company
            more &= ~(first[at] & np.append(first, True)[at + 1])
            at, key = at[more], key[more]
            if not len(at):
                return part, first
            depth += 8
            run, key = np.cumsum(first)[at], self.key(part[at], depth)
            by = np.lexsort((key, run))
            part[at], key = part[at][by], key[by]
            first[at[1:]] |= (key[1:] != key[:-1]) & (run[1:] == run[:-1])

    def terms(self, pointers: np.ndarray) -> pa.Array:
        """The terms at the pointers as an Arrow array."""
        ends = np.concatenate([[0], np.cumsum(self.length[pointers])]).astype(np.int64)
        data = self.bytes[spread(self.start[pointers], self.length[pointers])]
        return pa.LargeStringArray.from_buffers(len(pointers), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))


_HEAD = np.array([(0xFFFFFFFFFFFFFFFF << (64 - 8 * n)) & 0xFFFFFFFFFFFFFFFF for n in range(9)], np.uint64)


def shard_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of a shard's texts."""
    shard = Shard(text)
    pairs = pa.table({"lang": lang, "source": source}).append_column("row", pa.array(np.arange(len(text))))
    groups = pairs.group_by(["lang", "source"]).aggregate([("row", "list")])
    sizes = pc.list_value_length(groups["row_list"]).to_numpy().astype(np.int64)
    by_group = pc.list_flatten(groups["row_list"]).to_numpy()
    place = np.empty(len(text), np.int64)  # documents in order of their groups
    place[by_group] = np.arange(len(text))
    group_at = np.repeat(np.arange(len(sizes)), sizes)
    order, run = shard.runs()
    docs = max(len(text), 1)
    one = np.sort(run * docs + place[shard.doc[order]])
    new_doc = np.concatenate([[True], one[1:] != one[:-1]])[:len(one)]
    group = group_at[one % docs] if len(one) else one
    run_at = one // docs
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (run_at[1:] != run_at[:-1])])[:len(one)]
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(one)))
    seen = np.diff(np.append(np.cumsum(new_doc)[at] - 1, new_doc.sum()))
    leader = order[np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])[:len(run)])] if len(run) else order
    terms = shard.terms(leader).take(pa.array(run_at[at]))
    of = pa.array(group[at])
    return pa.RecordBatch.from_arrays([groups["lang"].combine_chunks().take(of), groups["source"].combine_chunks().take(of), terms.cast(pa.string()),
                                       pa.array(n, pa.int64()), pa.array(seen, pa.int64())], names=["lang", "source", "term", "n", "docs"])


def partial_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of each shard; rows of one group and term are to be summed."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < len(batch):  # texts of one shard
                ends = np.cumsum(pc.binary_length(batch.column(2).slice(at)).to_numpy())
                take = max(1, int(np.searchsorted(ends, SHARD_BYTES - size)))
                held.append(batch.slice(at, take))
                size += int(ends[min(take, len(ends)) - 1])
                at += take
                if size >= SHARD_BYTES or at < len(batch):
                    yield from _counted(held)
                    held, size = [], 0
        if held:
            yield from _counted(held)

    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce(text_of(docs), F.lit("")).alias("text"))
    return plain.mapInArrow(work, "lang string, source string, term string, n long, docs long")


def _counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = pa.Table.from_batches(held).combine_chunks()
    lang, source, text = (whole.column(i).cast(pa.large_string()).combine_chunks() for i in range(3))
    out = shard_counts(lang.cast(pa.string()), source.cast(pa.string()), text)
    for at in range(0, len(out), 50_000):
        yield out.slice(at, 50_000)


# ---------------------------------------------------------------- shares and divergences

def shares(count: np.ndarray, n: np.ndarray, v: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / (n + v)), exactly."""
    whole = np.maximum(n + v, 1)
    out, rest = np.zeros(np.broadcast(count, whole).shape, np.int64), count + 1
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + step
    return out + 1


def shares_column(count: Column, n: Column, v: Column) -> Column:
    """``shares`` as an expression."""
    whole, rest, out = F.greatest(n + v, F.lit(1)), count + 1, F.lit(0)
    for _ in range(3):
        out, rest = out * 1000 + _div(rest * 1000, whole), (rest * 1000) % whole
    return out.cast("long") + 1


def _div(a: Column, b: Column) -> Column:
    """Whole-number quotient of longs."""
    return F.call_function("div", a, b)


def spreads(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q)."""
    return (p - q) ** 2 // q


class Side:
    """A language's sources of one block, with their totals."""

    def __init__(self, names: list[str], totals: list[int], v: int):
        self.names, self.number = names, {s: i for i, s in enumerate(names)}
        self.totals, self.v = np.array(totals, np.int64), v
        self.none = shares(np.zeros(len(names), np.int64), self.totals, np.int64(v))


class PairSums:
    """Sums over terms of the divergence of each source of ``one`` from each of ``two``."""

    def __init__(self, one: Side, two: Side):
        self.one, self.two = one, two
        self.sums = np.zeros((len(one.names), len(two.names)), np.int64)
        self.terms = 0
        self.seen: tuple[list, list] = ([], [])

    def add(self, term: np.ndarray, source: list[str], count: np.ndarray, terms: int) -> None:
        """Entries (term, source, count), sorted by term, of ``terms`` terms."""
        self.terms += terms
        sides = []
        for side, seen in ((self.one, self.seen[0]), (self.two, self.seen[1])):
            number = np.fromiter((side.number.get(s, -1) for s in source), np.int64, len(source))
            mine = np.flatnonzero(number >= 0)
            number, t, c = number[mine], term[mine], count[mine]
            if len(c):
                seen.append(_tally(number, c, np.ones(len(c), np.int64)))
            sides.append((number, t, shares(c, side.totals[number], np.int64(side.v))))
            if len(seen) > 64:
                seen[:] = [_tally(*map(np.concatenate, zip(*seen, strict=True)))]
        (g, t, p), (h, u, q) = sides
        lo, hi = np.searchsorted(u, t, "left"), np.searchsorted(u, t, "right")
        upto = np.cumsum(hi - lo)
        at = 0
        while at < len(t):  # each entry of one side with the other side's entries of its term
            done = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
            sizes = (hi - lo)[at:end]
            left, right = np.repeat(np.arange(at, end), sizes), spread(lo[at:end], sizes)
            a, b = g[left], h[right]
            none_a, none_b = self.one.none[a], self.two.none[b]
            value = spreads(p[left], q[right]) - spreads(p[left], none_b) - spreads(none_a, q[right]) + spreads(none_a, none_b)
            np.add.at(self.sums.reshape(-1), a * len(self.two.names) + b, value)
            at = end

    def result(self) -> np.ndarray:
        one, two = self.one, self.two
        base = spreads(one.none[:, None], two.none[None, :])
        out = self.sums + self.terms * base
        for k, (side, seen) in enumerate(zip((one, two), self.seen, strict=True)):
            if not seen:
                continue
            number, c, times = _tally(*map(np.concatenate, zip(*seen, strict=True)))
            mine = shares(c, side.totals[number], np.int64(side.v))
            wide = len((two, one)[k].names)
            for at in range(0, len(c), max(1, PAIRS // max(wide, 1))):
                s = slice(at, at + max(1, PAIRS // max(wide, 1)))
                if k == 0:
                    np.add.at(out, number[s], times[s, None] * (spreads(mine[s, None], two.none[None, :]) - base[number[s]]))
                else:
                    np.add.at(out.T, number[s], times[s, None] * (spreads(one.none[None, :], mine[s, None]) - base.T[number[s]]))
        return out


def _tally(number: np.ndarray, count: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (number, count) with the sum of ``times``."""
    by = np.lexsort((count, number))
    number, count, times = number[by], count[by], times[by]
    first = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (count[1:] != count[:-1])]))
    return number[first], count[first], np.add.reduceat(times, first)


def _sides(rows: list) -> dict[str, Side]:
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    return {lang: Side([r["source"] for r in of], [r["n"] for r in of], of[0]["v"]) for lang, of in by.items()}


def pair_sums(kept: DataFrame, groups: DataFrame, one: dict[str, Side], two: dict[str, Side]) -> DataFrame:
    """(lang, source, item, value): partial sums of the pairs of two blocks of sources."""
    schema = "lang string, source string, item string, value long"

    def rows(lang: str, a: Side, b: Side, values: np.ndarray) -> pa.RecordBatch:
        n, m = values.shape
        return pa.RecordBatch.from_arrays([
            pa.array([lang] * (n * m), pa.string()), pa.array(a.names, pa.string()).take(pa.array(np.repeat(np.arange(n), m))),
            pa.array(b.names, pa.string()).take(pa.array(np.tile(np.arange(m), n))), pa.array(values.reshape(-1), pa.int64())], names=["lang", "source", "item", "value"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, PairSums] = {}
        for batch in batches:
            for lang in pc.unique(batch.column("lang")).to_pylist():
                if lang not in one or lang not in two:
                    continue
                mine = batch.filter(pc.equal(batch.column("lang"), lang))
                lists = mine.column("counts")
                entries = lists.flatten()
                sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
                if lang not in sums:
                    sums[lang] = PairSums(one[lang], two[lang])
                sums[lang].add(np.repeat(np.arange(len(sizes)), sizes), entries.field("source").to_pylist(), entries.field("n").to_numpy().astype(np.int64), len(sizes))
        for lang, s in sums.items():
            yield rows(lang, s.one, s.two, s.result())

    def zeros(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, source in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True):
                if lang in one and lang in two and source in one[lang].number:
                    yield rows(lang, Side([source], [0], 1), two[lang], np.zeros((1, len(two[lang].names)), np.int64))

    return kept.select("lang", "counts").mapInArrow(add, schema).unionByName(groups.select("lang", "source").mapInArrow(zeros, schema))


# ---------------------------------------------------------------- the audit

def kept_terms(docs: DataFrame) -> DataFrame:
    """(lang, term, n, counts): terms in enough documents of their language, with counts by source."""
    rows = partial_counts(docs).repartition("lang", "term")
    by_source = rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return terms.where(F.col("docs") >= LEAST_DOCS).select("lang", "term", "n", "counts")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, n, v, of_lang): every group, the counts of its kept terms, and its
    language's kept terms and their counts."""
    names = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    counts = kept.select("lang", F.explode("counts").alias("c")).select("lang", "c.source", "c.n")
    n = names.select("lang", "source", F.lit(0).cast("long").alias("n")).unionByName(counts).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    of = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("of_lang"))
    zero = F.lit(0).cast("long")
    return n.join(of, "lang", "left").select("lang", "source", "n", F.coalesce("v", zero).alias("v"), F.coalesce("of_lang", zero).alias("of_lang"))


def standing_out(kept: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """The first ``TOP`` terms of each group by divergence from its language."""
    entries = kept.select("lang", "term", F.col("n").alias("all"), F.explode("counts").alias("c")).select("lang", "term", "all", "c.source", F.col("c.n").alias("count"))
    rows = entries.join(F.broadcast(groups) if few else groups, ["lang", "source"])
    rows = rows.select("lang", "source", F.col("term").alias("item"), shares_column(F.col("count"), F.col("n"), F.col("v")).alias("p"),
                       shares_column(F.col("all"), F.col("of_lang"), F.col("v")).alias("q")).where("p > q")
    rows = rows.select("lang", "source", "item", _div((F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q")).alias("value"))
    return _ranked(rows).where(F.col("rank") <= TOP)


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def divergence(docs: DataFrame) -> DataFrame:
    """Per row: lang, source, part (``pair`` or ``term``), item, value, rank."""
    kept = materialize(kept_terms(docs))
    groups = materialize(group_totals(docs, kept))
    n = groups.count()
    blocks = max(1, -(-n // BLOCK))
    block = F.pmod(F.xxhash64("source"), F.lit(blocks))
    sums = []
    for i in range(blocks):
        one = _sides(groups.where(block == i).collect())  # about BLOCK rows
        for j in range(blocks):
            found = pair_sums(kept, groups, one, one if i == j else _sides(groups.where(block == j).collect()))
            summed = found.where("source <> item").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
            sums.append(materialize(summed) if blocks > 1 else summed)
    pairs = sums[0]
    for s in sums[1:]:
        pairs = pairs.unionByName(s)
    out = _ranked(pairs).withColumn("part", F.lit("pair")).unionByName(standing_out(kept, groups, n <= BROADCAST_GROUPS).withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")


#: The same in SQL, over a dense table of all kept terms and sources.
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
  1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (coalesce(s.n, 0)::HUGEINT + v.v) AS p,
  1 + (1000000000::HUGEINT * (k.n + 1)) // (v.n::HUGEINT + v.v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE c > 0 AND p > q),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM y WHERE part = 'pair' OR rank <= 200
"""

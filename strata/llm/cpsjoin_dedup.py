"""Near-duplicate documents: chosen-path set similarity join.

A document's set is its distinct word shingles; two documents are linked when
``100 * intersection >= percent * union``; linked documents form components.

1.  *Sketch.*  One pass makes, per document, the id of its set (a 128-bit hash),
    ``SKETCH`` minwise values of 16 bits, ``TREES`` minwise values of 64 bits,
    and the compressed words.  Equal sets are one node from here on, so a group of
    exact copies costs one row whatever its size.
2.  *Trees.*  Each of ``TREES`` independent trees branches the sets by a minwise
    token; a node holds the sets that chose the same token.
3.  *Pivots.*  Every node names one member (drawn by hash) its pivot.  Each set
    is compared with the pivot it meets most often, then, if still apart, with
    its other pivots: a number of comparisons linear in the sets, which joins
    large groups of near copies into components at once.
4.  *Recursion.*  A node whose members are all in one component is done.
    Other nodes of at most ``SMALL`` members are compared exhaustively, as are those with at most
    ``FEW`` members outside their largest component (these meet all members); the rest
    branch again by further minwise tokens, up to ``DEPTH`` levels.  Their number
    (``branches``: 2.2 a node on average at 0.80, 1.8 at 0.85) is the least that loses a pair at the
    threshold in all trees with at most ``MISSED``, all levels counted; 1 / similarity
    would keep one common child on average, a process that dies out.  A child that keeps over ``STUCK`` percent of its
    parent's members is not branched again, as its members share most tokens and
    further ones would not part them.  What is still large and mixed then is compared in
    blocks: nodes of the same least member are merged, and all members outside the
    node's largest component meet all members, so nothing is dropped.  Inside a group the sketches
    are compared first (``GROUP_SIGMAS`` standard deviations below the threshold: 2e-8 of links at it),
    and only members with a possible partner in another component get their full sets, on
    which links are decided; only links that join components leave a group: fewer rows than it has members.
5.  *Confirmation.*  Pivot pairs whose sketches do not rule the link out
    (``SIGMAS`` standard deviations below the threshold) are confirmed on the full
    sets of shingles; components come from alternating large-star / small-star steps.

A link is missed only if its sets part in all trees: 0.15 ** 10 at similarity
0.85 for a pair of its own, and at most ``MISSED`` for a pair whose nodes are large,
mixed and shrinking on all levels (``missed``).  A pivot pair that its sketch wrongly rules out is
still compared in step 4.

Every step is a join or grouping on node, pair or set; no group is collected,
tables between steps are written to the shared checkpoint folder, and the driver
sees counts only.  Hot nodes meet their one-row summaries in joins, which
Spark splits by size.

Defined cases: null text and text without words have the empty set, linked with
nothing; fewer words than a shingle are one shingle; rows of equal id are
documents of their own, and repeated rows are exact copies; null ids never become a
component's id unless all its ids are null; the output has one row per input row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache, reduce
from math import comb

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

from .common import free_name, text_of, utf8
from .vocabulary import Growing, Vocabulary, give_back, groups, held

TREES = 10
SKETCH = 128
SMALL = 768
FEW = 64
DEPTH = 6
STUCK = 70
BLOCK = 2048
MISSED = 1e-6
SIGMAS = 4.5
GROUP_SIGMAS = 5.5

_RNG = np.random.default_rng(20240229)
_X64, _A64 = (_RNG.integers(0, 1 << 63, TREES, np.uint64) for _ in range(2))
_A64 |= np.uint64(1)
_X32, _A32 = (_RNG.integers(0, 1 << 32, SKETCH, np.uint32) for _ in range(2))
_A32 |= np.uint32(1)


# ---------------------------------------------------------------- sets and sketches

class Words(Vocabulary):
    """64-bit hashes of words."""

    def clear(self) -> None:
        self.hashes = Growing(np.uint64)

    def grow(self, words: list[bytes]) -> None:
        self.hashes.extend(np.frombuffer(b"".join(hashlib.blake2b(w.lower(), digest_size=8).digest() for w in words), "<u8"))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def set_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a list of word hashes."""
    n = len(words)
    if not n:
        return words
    k = min(n, width)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = _mix(h + words[i:n - k + 1 + i])
    h.sort()
    first = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=first[1:])
    return h[first]


def sketch(hashes: np.ndarray) -> tuple[bytes, bytes]:
    """(16-bit minwise values, 64-bit minwise values) of a set."""
    low = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    top = (hashes >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(top), 4096):
        np.minimum(low, ((top[i:i + 4096] ^ _X32[:, None]) * _A32[:, None]).min(axis=1), out=low)
    roots = ((hashes ^ _X64[:, None]) * _A64[:, None]).min(axis=1)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2").tobytes(), roots.astype("<u8").tobytes()


def _words() -> Words:
    """The worker's word hashes, kept over tasks."""
    return held("cpsjoin words", Words)


SET = "n_shingles long, set_id binary, sketch binary, roots binary, body binary"


def describe(texts: list, width: int) -> list[tuple]:
    """(n_shingles, set_id, sketch, roots, body) of each text."""
    out, press = [], zstandard.ZstdCompressor(level=3)
    for s in groups(texts):
        at, counts = _words().index(texts[s])
        hashes, end = _words().hashes.data[at], np.cumsum(counts)
        for t, e, n in zip(texts[s], end.tolist(), counts.tolist(), strict=True):
            if not n:
                out.append((0, None, None, None, None))
                continue
            found = set_hashes(hashes[e - n:e], width)
            out.append((len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), *sketch(found),
                        press.compress(b" ".join(utf8(t).lower().split()))))
    return out


def set_column(text: Column, width: int) -> Column:
    @F.pandas_udf(SET)
    def make(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(describe(texts.tolist(), width), columns=["n_shingles", "set_id", "sketch", "roots", "body"])
    return make(text)


def shingles(body: bytes, width: int) -> set:
    """The full set of a compressed word list."""
    words = zstandard.ZstdDecompressor().decompress(body).split(b" ")
    return set(zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else {tuple(words)}


def hashed_sets(bodies: list[bytes], width: int, most: int = 64) -> list[np.ndarray]:
    """The full sets of compressed word lists as sorted 64-bit hashes, of which ``set_id`` is the hash; ``most``
    lists are numbered together."""
    out, unpack = [], zstandard.ZstdDecompressor().decompress
    for k in range(0, len(bodies), most):
        at, counts = _words().index([unpack(b).decode("utf-8", "surrogatepass") for b in bodies[k:k + most]])
        hashes, end = _words().hashes.data[at], np.cumsum(counts)
        out += [set_hashes(hashes[e - n:e], width) for e, n in zip(end.tolist(), counts.tolist(), strict=True)]
    give_back()
    return out


# ---------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every end of an edge (a, b): root is the smallest id
    reachable.  Alternating large-star and small-star steps."""
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not _stars_only(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def _stars_only(edges: DataFrame) -> bool:
    """Whether every u has one v, which is no u itself: then v is its root."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up")))
    return ends.groupBy("id").agg(F.sum("up").alias("n"), F.min("up").alias("lo")).where("n > 1 or n = 1 and lo = 0").isEmpty()


# ---------------------------------------------------------------- comparisons

def confirmed(pairs: DataFrame, bodies: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets."""
    x = pairs.join(bodies.select(F.col("set_id").alias("a"), F.col("body").alias("x")), "a")
    y = x.join(bodies.select(F.col("set_id").alias("b"), F.col("body").alias("y")), "b")

    def compare(batches):
        known: dict[bytes, set] = {}
        for pdf in batches:
            out = []
            for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["x"], pdf["y"], strict=True):
                if b not in known:  # a pivot's pairs come together: keep its set
                    known = {b: shingles(y, width)}
                one, two = shingles(x, width), known[b]
                both = len(one & two)
                if 100 * both >= percent * (len(one) + len(two) - both):
                    out.append((a, b))
            yield pd.DataFrame(out, columns=["a", "b"])

    return y.select("a", "b", "x", "y").mapInPandas(compare, "a binary, b binary")


def least_estimate(percent: int, sigmas: float = SIGMAS) -> float:
    """The sketch agreement below which a link is ruled out."""
    p = percent / 100
    return p - sigmas * (p * (1 - p) / SKETCH) ** 0.5


def _runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The groups of rows, sorted by key, over batch borders."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf[key].to_numpy()
        cut = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(pdf)]
        for i, j in zip(cut, cut[1:], strict=False):
            if held and held[0][key].iat[0] != k[i]:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(pdf.iloc[i:j])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def with_partners(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (key, set_id, comp, side) of groups whose sketch does not rule out a link to a member
    of another component in the group.  Takes the rows with their ``sketch``."""
    least = least_agreeing(percent)

    def look(batches):
        for g in _runs(batches, "key"):
            near = _partners(g, least)
            found = np.zeros(len(g), bool)
            for i in np.flatnonzero(g["side"].to_numpy() == 0).tolist():  # side 0 comes first
                if len(hit := near(i)):
                    found[i] = found[hit] = True
            if found.any():
                yield g.loc[found, ["key", "set_id", "comp", "side", "sketch"]]

    return (rows.repartition("key").sortWithinPartitions("key", "side", "set_id").select("key", "set_id", "comp", "side", "sketch")
            .mapInPandas(look, "key long, set_id binary, comp binary, side int, sketch binary"))


def least_agreeing(percent: int) -> int:
    """The number of equal sketch values below which a link inside a group is ruled out."""
    return int(np.ceil(SKETCH * least_estimate(percent, GROUP_SIGMAS)))


def _partners(g: pd.DataFrame, least: int) -> Callable[[int], np.ndarray]:
    """For a group, the function from a row to the rows after it that are of another component and agree with it in
    ``least`` sketch values.  Half of the values rule most out: the other half can't make up for what is missing there."""
    sketches, half = np.frombuffer(b"".join(g["sketch"]), "<u2").reshape(-1, SKETCH), SKETCH // 2
    first, last = np.ascontiguousarray(sketches[:, :half]), sketches[:, half:]
    comp = np.unique(g["comp"].to_numpy(), return_inverse=True)[1]

    def near(i: int) -> np.ndarray:
        same = np.count_nonzero(first[i + 1:] == first[i], axis=1)
        some = np.flatnonzero((same >= least - (SKETCH - half)) & (comp[i + 1:] != comp[i]))
        same = same[some] + np.count_nonzero(last[some + i + 1] == last[i], axis=1)
        return some[same >= least] + i + 1
    return near


def linked_in_groups(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that join components inside each group (key, set_id, comp, sketch,
    body, side), confirmed on the full sets where the sketches do not rule them out: at most one
    fewer than the group has components.  ``side`` 0 meets everything, 1 meets side 0 only."""
    least = least_agreeing(percent)

    def compare(batches):
        for g in _runs((b.assign(body=pd.Series(hashed_sets(b["body"].tolist(), width), b.index, object)) for b in batches), "key"):
            ids, comp, side, sets = (g[c].to_numpy() for c in ("set_id", "comp", "side", "body"))
            near = _partners(g, least)
            names, label = np.unique(comp, return_inverse=True)
            root, out = list(range(len(names))), []

            def top(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i in np.flatnonzero(side == 0).tolist():
                for j in near(i).tolist():
                    x, y = top(label[i]), top(label[j])
                    if x != y and linked(sets[i], sets[j], percent):
                        root[x] = y
                        out.append((ids[i], ids[j]))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    return (rows.repartition("key").sortWithinPartitions("key", "side", "set_id").select("key", "set_id", "comp", "sketch", "body", "side")
            .mapInPandas(compare, "a binary, b binary"))


def linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sets of sorted distinct hashes are similar enough."""
    few, many = sorted((len(one), len(two)))
    if 100 * few < percent * many:
        return False
    both = np.sort(np.concatenate([one, two]))
    both = np.count_nonzero(both[1:] == both[:-1])
    return 100 * both >= percent * (few + many - both)


# ---------------------------------------------------------------- the join

def _root_nodes(sets: DataFrame) -> DataFrame:
    """(node, set_id): each set in one node of every tree."""
    roots = F.array(*[F.xxhash64(F.lit(t), F.substring("roots", 8 * t + 1, 8)) for t in range(TREES)])
    return sets.select("set_id", F.explode(roots).alias("node"))


def _labelled(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows with the component of their set (the set itself if alone)."""
    return rows.join(comps.select(F.col("id").alias("set_id"), "root"), "set_id", "left").withColumn("comp", F.coalesce("root", "set_id")).drop("root")


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (node, set_id, comp, parent) of the nodes with several components, with the size and the
    number of members outside the largest component."""
    size = rows.groupBy("node", "comp").agg(F.count("*").alias("n")).groupBy("node").agg(F.sum("n").alias("size"), (F.sum("n") - F.max("n")).alias("outside"))
    return rows.join(size.where("outside > 0"), "node")


def missed(percent: int, branches: float, trees: int = TREES, depth: int = DEPTH) -> float:
    """Chance that all trees part a pair at the threshold whose nodes branch on all
    levels.  The levels share the sketch, so the trees are independent only given
    the share of its values that agree."""
    p, k, out = percent / 100, int(branches), 0.0
    for same in range(SKETCH + 1):
        lost = 0.0  # below a node that holds both
        for _ in range(depth):
            child = 1 - same / SKETCH * (1 - lost)
            lost = child ** k * (1 - (branches - k) * (1 - child))
        out += comb(SKETCH, same) * p ** same * (1 - p) ** (SKETCH - same) * (1 - p + p * lost) ** trees
    return out


@cache
def branches(percent: int) -> float:
    """The least average number of children of a set in a node, in steps of 0.05,
    that misses at most ``MISSED``, or what comes closest (eight)."""
    return next((n / 20 for n in range(20, 160) if missed(percent, n / 20) <= MISSED), 8.0)


def _children(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Branch nodes by ``branches(percent)`` further minwise tokens on average, all
    different: the whole part of them, and one more with the chance of the rest."""
    number = lambda k, n: F.pmod(F.xxhash64("node", F.lit(k)), F.lit(n)).cast("int")
    some = int(branches(percent))
    more = number(3, 100) < round(100 * (branches(percent) - some))
    pick = lambda i: F.pmod(number(1, SKETCH) + F.lit(i) * (2 * number(2, SKETCH // 2) + 1), F.lit(SKETCH))
    picks = F.when(more, F.array(*map(pick, range(some + 1)))).otherwise(F.array(*map(pick, range(some))))
    branched = rows.withColumn("pick", F.explode(picks)).join(sets.select("set_id", "sketch"), "set_id")
    child = F.xxhash64("node", "pick", F.expr("substring(sketch, 2 * pick + 1, 2)"))
    return branched.select(child.alias("node"), "set_id", "comp", F.col("size").alias("parent"))


def _merged(rows: DataFrame) -> DataFrame:
    """Nodes that share their least member (by hash) as one node.  Stuck nodes of
    different trees hold much the same members, and with the chance of their
    overlap the same least one: their pairs are then compared once."""
    least = rows.groupBy("node").agg(F.min(F.xxhash64("set_id")).alias("least"))
    return rows.join(least, "node").select(F.col("least").alias("node"), "set_id", "comp").distinct()


def _blocks(rows: DataFrame) -> DataFrame:
    """Members outside a node's largest component (side 0) against all of its
    members, in blocks of about ``BLOCK`` by ``BLOCK``."""
    counts = rows.groupBy("node", "comp").agg(F.count("*").alias("n"))
    top = counts.groupBy("node").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("total"))
    top = top.select("node", F.col("top.comp").alias("major"), F.ceil(F.col("total") / BLOCK).cast("int").alias("all"),
                     F.ceil((F.col("total") - F.col("top.n")) / BLOCK).cast("int").alias("out"))
    dealt = rows.join(top, "node")
    slot = lambda n, k: F.pmod(F.xxhash64("set_id", F.lit(k)), F.col(n)).cast("int")
    outer = dealt.where("comp <> major").withColumn("o", slot("out", 1)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("all") - 1))).withColumn("side", F.lit(0))
    whole = dealt.withColumn("i", slot("all", 2)).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("out") - 1))).withColumn("side", F.lit(1))
    both = outer.unionByName(whole)
    return both.select(F.xxhash64("node", "o", "i").alias("key"), "set_id", "comp", "side")


def links(described: DataFrame, width: int, percent: int) -> DataFrame:
    """Components (id, root) of the distinct sets of ``described`` (SET columns)."""
    some = described.where("set_id is not null")
    sets = materialize(some.groupBy("set_id").agg(F.first("sketch").alias("sketch"), F.first("roots").alias("roots")))
    nodes = _root_nodes(sets)
    named = nodes.groupBy("node").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("set_id", "node"), "set_id")).alias("p")).where("size > 1")
    nodes = materialize(nodes.join(named.select("node", F.col("p.set_id").alias("pivot")), "node"))
    stars = materialize(nodes.where("set_id <> pivot").groupBy("set_id", "pivot").agg(F.count("*").alias("n"))
                        .join(sets.select("set_id", F.col("sketch").alias("s1")), "set_id")
                        .join(sets.select(F.col("set_id").alias("pivot"), F.col("sketch").alias("s2")), "pivot")
                        .withColumn("agree", _agreement("s1", "s2")).where(F.col("agree") >= least_estimate(percent)).select("set_id", "pivot", "agree"))
    # copies are dropped before the shuffle, and only the sets that a sketch leaves open are written
    texts = some.groupBy("set_id").agg(F.first("body").alias("body"))
    of = lambda ids: texts.join(ids.select("set_id").distinct(), "set_id", "left_semi")
    bodies = materialize(of(stars.select("set_id").unionByName(stars.select(F.col("pivot").alias("set_id")))))

    best = stars.groupBy("set_id").agg(F.max(F.struct("agree", "pivot")).alias("m")).select(F.col("set_id").alias("a"), F.col("m.pivot").alias("b"))
    comps = components(confirmed(best, bodies, width, percent))
    apart = _apart(stars.select(F.col("set_id").alias("a"), F.col("pivot").alias("b")).join(best, ["a", "b"], "left_anti"), comps)
    comps = materialize(components(_edges(comps).unionByName(confirmed(apart, bodies, width, percent))))

    small, whole = [], []
    rows = materialize(_mixed(_labelled(nodes.select("node", "set_id"), comps).withColumn("parent", F.lit(None).cast("long"))))
    for depth in range(DEPTH + 1):
        small.append(rows.where(F.col("size") <= SMALL).select(F.col("node").alias("key"), "set_id", "comp", F.lit(0).alias("side")))
        rows = rows.where(F.col("size") > SMALL)
        done = F.lit(True) if depth == DEPTH else (F.col("outside") <= FEW) | F.coalesce(100 * F.col("size") > STUCK * F.col("parent"), F.lit(False))
        whole.append(rows.where(done).select("node", "set_id", "comp"))
        rows = rows.where(~done)
        if rows.isEmpty():
            break
        rows = materialize(_mixed(materialize(_children(rows, sets, percent))))  # written: what makes rows is not run for their sizes, too
    groups_of = reduce(DataFrame.unionByName, [*small, _blocks(materialize(_merged(reduce(DataFrame.unionByName, whole))))])
    near = materialize(with_partners(groups_of.join(sets.select("set_id", "sketch"), "set_id"), percent))
    joined = linked_in_groups(near.join(of(near), "set_id"), width, percent)
    return components(_edges(comps).unionByName(joined))


def _edges(comps: DataFrame) -> DataFrame:
    """Components as edges (a, b) from each member to its root."""
    return comps.select(F.col("id").alias("a"), F.col("root").alias("b"))


def _agreement(a: str, b: str) -> Column:
    @F.pandas_udf("double")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        one, two = (np.frombuffer(b"".join(v), "<u2").reshape(-1, SKETCH) for v in (x, y))
        return pd.Series((one == two).mean(axis=1))
    return agree(F.col(a), F.col(b))


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component."""
    one = comps.select(F.col("id").alias("a"), F.col("root").alias("ra"))
    two = comps.select(F.col("id").alias("b"), F.col("root").alias("rb"))
    return (pairs.join(one, "a", "left").join(two, "b", "left")
            .where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    made = docs.select("doc_id", set_column(text_of(docs), shingle).alias("s")).select("doc_id", "s.*")
    described = materialize(made)
    comps = links(described, shingle, percent)
    rows = described.select("doc_id", "n_shingles", "set_id")
    ids = rows.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    labelled = _labelled(ids, comps)
    smallest = labelled.groupBy("comp").agg(F.min("least").alias("component_id"))
    final = labelled.select("set_id", "comp").join(smallest, "comp").select("set_id", "component_id")
    out = rows.where("set_id is not null").join(final, "set_id").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("set_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def set_id_column(text: Column, width: int) -> Column:
    @F.pandas_udf("binary")
    def make(texts: pd.Series) -> pd.Series:
        out, listed = [], texts.tolist()
        for s in groups(listed):
            at, counts = _words().index(listed[s])
            hashes, end = _words().hashes.data[at], np.cumsum(counts)
            out += [hashlib.blake2b(set_hashes(hashes[e - n:e], width).tobytes(), digest_size=16).digest() if n else None
                    for e, n in zip(end.tolist(), counts.tolist(), strict=True)]
        return pd.Series(out, dtype=object)
    return make(text)


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component (that of the smallest id), with all
    columns of ``docs``; documents without words all stay."""
    described = materialize(docs.select("doc_id", set_column(text_of(docs), shingle).alias("s")).select("doc_id", "s.*"))
    comps = links(described, shingle, percent)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"))
    ids = described.where("set_id is not null").groupBy("set_id").agg(F.min(order).alias("least"))
    winner = _labelled(ids, comps).groupBy("comp").agg(F.min(F.struct("least", "set_id")).alias("w"))
    # the winner's rows come back by id, then by set; of repeated rows one stays
    key, mine, its = (free_name(docs, n) for n in ("_key", "_mine", "_its"))
    as_key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    winner = winner.select(as_key(F.col("w.least.d")).alias(key), F.col("w.set_id").alias(its))
    has_words = F.coalesce(text_of(docs).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = docs.where(has_words).withColumn(key, as_key(F.col("doc_id"))).join(winner, key)
    kept = kept.withColumn(mine, set_id_column(text_of(docs), shingle)).where(F.col(mine) == F.col(its)).dropDuplicates([key, its])
    columns = [f"`{c}`" for c in docs.columns]
    return kept.select(*columns).unionByName(docs.where(~has_words).select(*columns))


#: The same as ``near_duplicates`` with 3-word shingles and 85 % in SQL, over the whole table.
ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT i, j FROM p JOIN n x ON x.doc_id = i JOIN n y ON y.doc_id = j WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT i, j FROM l UNION ALL SELECT j, i FROM l),
r(i, j) AS (SELECT i, j FROM e UNION SELECT r.i, e.j FROM r JOIN e ON r.j = e.i),
m AS (SELECT i, min(j) AS lo FROM r GROUP BY i)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.lo, d.doc_id)) AS component_id, d.doc_id <= coalesce(m.lo, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.i = d.doc_id
"""

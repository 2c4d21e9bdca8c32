"""Personal data: plain patterns plus a skip-chain conditional random field.

The patterns (e-mail, IP address, card, phone) find the base spans.  The field
then labels the tokens of the same text: neighbouring tokens share a chain
potential, and *distant tokens that repeat or resemble each other* (same digits,
same last seven digits, same address) share a skip potential.  Loopy message
passing lets a mention that the patterns know ("+1 (555) 010-9999") carry its
label to one that they miss ("555-010-9999").

* Only tokens with a digit or an ``@`` are variables; all others are fixed
  to "none", so the field is small even in long texts.
* The occurrences of a key are linked in a row, each with the next, not in all
  pairs: a token repeated n times has n - 1 skip edges.  When the field labels a text,
  each mention that the patterns miss is also linked to its key's nearest mention
  that they know, so evidence reaches all of them however many there are; the
  patterns' labels are fixed, so many bare mentions do not outvote them.
* Messages run until none changes by ``STILL``, at most ``ROUNDS`` steps; texts
  that are done early are left out of later steps.
* The weights are trained by gradient descent on the pseudo-likelihood of the
  base labels over at most ``TRAIN_DOCS`` distinct rows (those with the smallest
  hash of the id among documents with an ``@`` or a digit).  The label that a
  pattern gives a token is hidden in half the training tokens, so that
  the field learns to take it from the linked ones.
* A token is added when the marginal of its label reaches ``SURE``, or
  ``LINKED`` if a token that it shares a skip potential with has that label from
  a pattern.

Defined cases: null text counts as empty; a text without candidates has no
spans; added spans never overlap base spans, which all stay; the order of spans
is by kind as listed, then start; one output row per input row.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows, text_of
from .vocabulary import groups

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 4_000
SURE = 0.9
LINKED = 0.5
STILL = 1e-3
ROUNDS = 1_000

_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_CANDIDATE = re.compile(r"[0-9@]")


# ---------------------------------------------------------------- base spans

def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches: a match has one ``@``, its local part is
    the whole run before it that the match before left over."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            free = found.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", free)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), in order of kind and start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# ---------------------------------------------------------------- the field

#: Observed features of a token: what it looks like, not which pattern found it.
FEATURES = 1 + 2 + 6 + 6 + 4 + 3 + 1


def observe(token: str) -> np.ndarray:
    x = np.zeros(FEATURES, np.float64)
    digits = sum(c.isdigit() and c.isascii() for c in token)
    x[0] = 1
    x[1 + (digits == len(token))] = 1
    x[3 + min(digits // 3, 5)] = 1
    for i, c in enumerate("@.-(+="):
        x[9 + i] = c in token
    dots = token.count(".")
    x[15 + min(dots, 3)] = 1
    letters = sum(c.isalpha() for c in token)
    x[19 + (0 if not letters else 1 if letters < digits else 2)] = 1
    x[22] = token[-1] in ".,;:!?"
    return x


def keys(token: str) -> list[str]:
    """What a token must share with another to resemble it."""
    if "@" in token:
        return ["@" + token.strip(".,;:!?\"'()<>[]#*$%&|").lower()]
    digits = _NOT_DIGIT.sub("", token)
    if len(digits) < 4 or any(c.isalpha() for c in token):
        return []
    return ["d" + digits, *(["t" + digits[-7:]] if len(digits) >= 7 else [])]


class Graph:
    """Tokens (variables) and edges of one or several texts."""

    def __init__(self):
        self.text, self.start, self.end, self.x, self.label = [], [], [], [], []
        self.chain, self.skip, self.anchor = [], [], []

    def add(self, number: int, text: str, spans: list[tuple[int, int, int]]) -> None:
        last, mentions = -2, defaultdict(list)
        spans = sorted(spans, key=lambda s: s[1])
        linked, i = set(), 0
        for n, m in enumerate(_TOKEN.finditer(text)):
            if not _CANDIDATE.search(m[0]):
                continue
            v = len(self.text)
            while i < len(spans) and spans[i][2] <= m.start():
                i += 1
            j, label = i, 0
            while j < len(spans) and spans[j][1] < m.end():
                label = label or spans[j][0] + 1
                j += 1
            self.text.append(number)
            self.start.append(m.start())
            self.end.append(m.end())
            self.x.append(observe(m[0]))
            self.label.append(label)
            if last == n - 1:
                self.chain.append((v - 1, v))
            last = n
            for k in keys(m[0]):
                u = mentions[k][-1] if mentions[k] else v
                if (u, v) not in linked and u != v:
                    self.skip.append((u, v))
                    linked.add((u, v))
                mentions[k].append(v)
        for same in mentions.values():
            known = [v for v in same if self.label[v]]
            at = 0
            for v in same if known else ():
                while at + 1 < len(known) and abs(known[at + 1] - v) <= abs(known[at] - v):
                    at += 1
                u = known[at]
                edge = (min(u, v), max(u, v))
                if not self.label[v] and edge not in linked:
                    self.anchor.append(edge)
                    linked.add(edge)

    def arrays(self, anchors: bool = False):
        skip = [*self.skip, *(self.anchor if anchors else ())]
        edges = np.array([*self.chain, *skip], np.int64).reshape(-1, 2)
        kind = np.array([0] * len(self.chain) + [1] * len(skip), np.int64)
        return np.array(self.x).reshape(-1, FEATURES), np.array(self.label, np.int64), edges, kind


LABELS = len(KINDS) + 1


class Field:
    """Weights: observed features, the pattern's label, chain and skip pairs."""

    def __init__(self):
        self.w = np.zeros((FEATURES, LABELS))
        self.known = np.zeros(LABELS)   # weight of "a pattern gave this label"
        self.pair = np.zeros((2, LABELS, LABELS))  # symmetric: chain, skip

    def unary(self, x: np.ndarray, seen: np.ndarray) -> np.ndarray:
        z = x @ self.w
        z[np.arange(len(x)), seen] += self.known[seen]
        return z

    def train(self, graph: Graph, steps: int = 300, rate: float = 0.5, decay: float = 1e-3, seed: int = 5) -> Field:
        """Pseudo-likelihood: each token given its neighbours' labels."""
        x, y, edges, kind = graph.arrays()
        if not len(x):
            return self
        both = np.concatenate([edges, edges[:, ::-1]])
        kinds = np.concatenate([kind, kind])
        near = np.zeros((2, len(x), LABELS))  # neighbours' labels, counted
        np.add.at(near, (kinds, both[:, 0], y[both[:, 1]]), 1)
        # a token's own pattern label is hidden in every second one: then it counts as seen "none"
        seen = np.where(np.random.default_rng(seed).random(len(x)) < 0.5, y, 0)
        gold = np.eye(LABELS)[y]
        weight = 1 / np.bincount(y, minlength=LABELS).clip(1)[y]
        weight *= len(x) / weight.sum()
        for _ in range(steps):
            z = self.unary(x, seen) + near[0] @ self.pair[0] + near[1] @ self.pair[1]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - gold) * weight[:, None] / len(x)
            self.w -= rate * (x.T @ g + decay * self.w)
            self.known -= rate * (np.bincount(seen, g[np.arange(len(x)), seen], LABELS) + decay * self.known)
            for k in (0, 1):
                d = near[k].T @ g
                self.pair[k] -= rate * ((d + d.T) / 2 + decay * self.pair[k])
        return self

    def marginals(self, graph: Graph, rounds: int = ROUNDS) -> np.ndarray:
        """Loopy sum-product message passing over chain, skip and anchor edges; a
        pattern's label is given."""
        x, y, edges, kind = graph.arrays(anchors=True)
        z = self.unary(x, y)
        z[(y > 0)[:, None] & (np.arange(LABELS) != y[:, None])] = -1e6
        b = z.copy()
        if len(edges):
            src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
            kind, of = np.concatenate([kind, kind]), np.array(graph.text)[src]
            msg, on = np.zeros((len(src), LABELS)), np.arange(len(src))  # on: edges of texts that still change
            s, d, pair, back = src, dst, self.pair[kind], (on + len(edges)) % len(on)
            for _ in range(rounds):
                out = (b[s] - msg[on][back])[:, :, None] + pair
                top = out.max(axis=1)
                new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                new = (msg[on] + new) / 2
                moving = np.abs(new - msg[on]).max(axis=1) >= STILL
                np.add.at(b, d, new - msg[on])
                msg[on] = new
                if not moving.any():
                    break
                live = np.isin(of[on], np.unique(of[on[moving]]))
                if 2 * live.sum() < len(on):
                    on = on[live]
                    s, d, pair = src[on], dst[on], self.pair[kind[on]]
                    back = (np.arange(len(on)) + len(on) // 2) % len(on)
        p = np.exp(b - b.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def add_spans(texts: list[str], base: list[list[tuple[int, int, int]]], field: Field, sure: float = SURE) -> list[list[tuple[int, int, int]]]:
    """The spans that the field adds to each text's base spans."""
    graph = Graph()
    for i, (t, s) in enumerate(zip(texts, base, strict=True)):
        if t and _CANDIDATE.search(t):
            graph.add(i, t, s)
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not graph.text:
        return added
    p = field.marginals(graph)
    best, joined = p.argmax(axis=1), set(graph.chain)
    label, need = np.array(graph.label), np.full(len(p), sure)
    skip = [*graph.skip, *graph.anchor]
    for a, b in (*skip, *((v, u) for u, v in skip)):
        if label[a] == best[b]:
            need[b] = LINKED
    last = -2
    for v in np.flatnonzero((best > 0) & (p.max(axis=1) >= need) & (label == 0)).tolist():
        i, k = graph.text[v], int(best[v]) - 1
        s, e = graph.start[v], graph.end[v]
        t = texts[i]
        while s < e and not (t[s].isalnum() or t[s] in "+("):
            s += 1
        while e > s and not (t[e - 1].isalnum() or t[e - 1] == ")"):
            e -= 1
        if s >= e:
            continue
        if last == v - 1 and (v - 1, v) in joined and added[i] and added[i][-1][0] == k:
            s = added[i].pop()[1]
        added[i].append((k, s, e))
        last = v
    return added


def write_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


# ---------------------------------------------------------------- operators

def fit(docs: DataFrame, most: int = TRAIN_DOCS) -> Field:
    """Weights from the base labels of a bounded set of documents; only the
    token graphs' numbers travel to the driver."""
    rows = docs.select("doc_id", text_of(docs).alias("text")).where(F.col("text").rlike("[0-9@]"))
    drawn = bounded_rows(rows, most)

    def graphs(batches):
        for pdf in batches:
            for doc_id, t in zip(pdf["doc_id"], pdf["text"], strict=True):
                g = Graph()
                g.add(0, t, base_spans(t))
                x, y, edges, kind = g.arrays()
                yield pd.DataFrame({"doc_id": [doc_id], "n": [len(y)], "x": [np.packbits(x.astype(bool)).tobytes()], "y": [y.astype(np.int8).tobytes()],
                                    "edges": [edges.astype(np.int32).tobytes()], "kind": [kind.astype(np.int8).tobytes()]})

    found = (drawn.mapInPandas(graphs, "doc_id long, n int, x binary, y binary, edges binary, kind binary").toPandas()
             .sort_values(["doc_id", "y", "x"]))
    whole = Graph()
    for r in found.itertuples():
        at = len(whole.label)
        whole.x.extend(np.unpackbits(np.frombuffer(r.x, np.uint8))[:r.n * FEATURES].reshape(r.n, FEATURES).astype(float))
        whole.label.extend(np.frombuffer(r.y, np.int8).tolist())
        e = np.frombuffer(r.edges, np.int32).reshape(-1, 2) + at
        k = np.frombuffer(r.kind, np.int8)
        whole.chain.extend(map(tuple, e[k == 0].tolist()))
        whole.skip.extend(map(tuple, e[k == 1].tolist()))
    return Field().train(whole)


def find(texts: list[str | None], field: Field) -> tuple[list, list]:
    """Base spans and added spans of each text."""
    base, added = [], []
    for s in groups(texts, 1 << 18):
        part = [t or "" for t in texts[s]]
        base += [base_spans(t) if _CANDIDATE.search(t) else [] for t in part]
        added += add_spans(part, base[s], field)
    return base, added


def spans_column(text: Column, field: Field) -> Column:
    """Struct column: numbers per kind, base spans and all spans as text."""

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
    def scan(texts: pd.Series) -> pd.DataFrame:
        base, added = find(texts.tolist(), field)
        return pd.DataFrame([(*(sum(s[0] == k for s in b) for k in range(4)), write_spans(b), write_spans([*b, *a]))
                             for b, a in zip(base, added, strict=True)], columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    return scan(text)


def redact_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redacted(text: Column, field: Field) -> Column:
    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        base, added = find(texts.tolist(), field)
        return pd.Series([redact_text(t, [*b, *a]) if b or a else t for t, b, a in zip(texts, base, added, strict=True)], dtype=object)
    return mask(text)


def detect(docs: DataFrame) -> DataFrame:
    """Per document: numbers of base spans, their text, and all spans."""
    return docs.select("doc_id", spans_column(text_of(docs), fit(docs)).alias("s")).select("doc_id", "s.*")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced; ``n_chars`` follows the text."""
    out = docs.withColumn("text", redacted(text_of(docs), fit(docs)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[f"`{c}`" for c in docs.columns])

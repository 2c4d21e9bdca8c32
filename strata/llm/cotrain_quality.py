"""Quality classifier by co-training of a text view and a page-metadata view.

* Text view: logistic regression on hashed tokens (``TEXT_BITS``) and a few
  shape measures of the text.  Metadata view: logistic regression on source,
  language, length class and missing fields, hashed to ``META`` columns; it
  never sees the text.
* Rounds: each view is trained on its labelled rows; all unlabelled documents
  of which one view is sure (calibrated probability of its label at least
  ``SURE`` at the start of the round) get that pseudo-label in the *other* view's
  training.  Labels are balanced by weight.  An exchange that raises a view's log
  loss on the held-back labelled rows is not kept.
* The pseudo-labelled documents stay where they are.  A round makes ``PASSES``
  passes over the features of all unlabelled documents, written once to the shared folder;
  each sums, per view, class and column, the gradient of their loss at the present weights
  and a bound of its curvature (an x x' is at most the diagonal |x| sum|x|).  The weights then
  minimise the labelled rows' loss plus that quadratic, which lies above the loss.
* A sixth of the labelled rows is held back to calibrate each view (Platt scaling) and to judge
  exchanges; another sixth fits the second logistic regression that combines the two
  calibrated log odds.
* The features of at most ``SEED_DOCS`` labelled documents (distinct rows, smallest hashes of
  the id) go to the driver; of the unlabelled ones only sums of fixed size.  The fitted
  weights, of fixed size, score every document.

Defined cases: labels of a document that disagree count by their lowest
quality; null text has no tokens, null metadata is a value of its own; without
both label values every score is the share of good labels (1 without any);
ties at 0.5 are kept; one output row per input row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

from .common import bounded_rows, text_of
from .llr_quality import Tokens, line_metrics, repeated_window_words
from .vocabulary import groups, spread

TEXT_BITS = 14
SHAPE = 8
META = 256
SEED_DOCS = 4_000
ROUNDS = 3
PASSES = 3
IDS = 1 << 20
FAN_IN = 64
UNIT = 1 << 20  # sums travel as whole numbers of 1 / UNIT: their order does not matter
SURE = 0.95

_KEPT: dict[str, Tokens] = {}


def _tokens() -> Tokens:
    """The worker's numbering, kept over tasks."""
    if "tokens" not in _KEPT:
        _KEPT["tokens"] = Tokens()
    return _KEPT["tokens"]


class Rows:
    """Sparse rows: column, value and row of each entry."""

    def __init__(self, at: np.ndarray, value: np.ndarray, of: np.ndarray, n: int):
        self.at, self.value, self.of, self.n = at, value, of, n

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, w[self.at] * self.value, self.n)

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.at, self.value * g[self.of], size)

    def pick(self, rows: np.ndarray) -> Rows:
        number = np.full(self.n, -1)
        number[rows] = np.arange(len(rows))
        on = number[self.of] >= 0
        return Rows(self.at[on], self.value[on], number[self.of[on]], len(rows))


TEXT_SIZE, META_SIZE = (1 << TEXT_BITS) + SHAPE, META + 1


def text_rows(texts: list) -> Rows:
    """Square-root token counts of unit length, then the shape measures."""
    tokens = _tokens()
    at, counts = tokens.index(texts)
    size = tokens.size.data[at]
    hashes = tokens.hashes.data[spread(tokens.start.data[at], size)]
    of = np.repeat(np.repeat(np.arange(len(counts)), counts), size)
    key, times = np.unique((of << TEXT_BITS) | (hashes >> np.uint32(32 - TEXT_BITS)).astype(np.int64), return_counts=True)
    row, col, value = key >> TEXT_BITS, key & ((1 << TEXT_BITS) - 1), np.sqrt(times)
    value = value / np.sqrt(np.maximum(np.bincount(row, times, len(counts)), 1))[row]
    shape, end = np.zeros((len(counts), SHAPE)), np.cumsum(counts)
    for i, t in enumerate(texts):
        n = int(counts[i])
        words = at[end[i] - n:end[i]]
        chars, symbols, dup = line_metrics(t)
        t = t or ""
        shape[i] = (1, np.log1p(n) / 10, min(1, symbols / max(n, 1)), repeated_window_words(words) / max(n, 1),
                    len(np.unique(words)) / max(n, 1), min(1, dup / (1 + t.count("\n"))), min(1, chars / max(n, 1) / 20),
                    sum(1 for c in t if c.isupper()) / max(chars, 1))
    at_shape = np.tile(np.arange(SHAPE) + (1 << TEXT_BITS), len(counts))
    return Rows(np.concatenate([col, at_shape]), np.concatenate([value, shape.ravel()]),
                np.concatenate([row, np.repeat(np.arange(len(counts)), SHAPE)]), len(counts))


def meta_rows(columns: dict[str, list]) -> Rows:
    """One-hot hashed metadata, and a constant."""
    n = len(next(iter(columns.values())))
    at = np.empty((n, len(columns) + 1), np.int64)
    for k, (name, values) in enumerate(columns.items()):
        at[:, k] = [zlib.crc32(f"{name}={v}".encode("utf-8", "surrogatepass")) % META for v in values]
    at[:, -1] = META
    return Rows(at.ravel(), np.ones(at.size), np.repeat(np.arange(n), at.shape[1]), n)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def log_loss(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum())


class Sums:
    """Of a view's pseudo-labelled documents: the number of each class, and per class and
    column the gradient of their loss at some weights and a bound of its curvature."""

    def __init__(self, size: int):
        self.n, self.gradient, self.bound = np.zeros(2), np.zeros((2, size)), np.zeros((2, size))

    def add(self, rows: Rows, w: np.ndarray, given: np.ndarray) -> None:
        p, length = sigmoid(rows.dot(w)), np.bincount(rows.of, np.abs(rows.value), rows.n)
        for y in (0, 1):
            on = given == y
            self.n[y] += on.sum()
            self.gradient[y] += rows.back(np.where(on, p - y, 0.0), len(w))
            self.bound[y] += np.bincount(rows.at, np.abs(rows.value) * np.where(on, length / 4, 0.0)[rows.of], len(w))


def train(rows: Rows, y: np.ndarray, size: int, steps: int = 150, rate: float = 0.5, decay: float = 1e-4,
          sums: Sums | None = None, at: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression, full-batch gradient steps with per-weight rates; with
    ``sums`` at the weights ``at``, over their documents too, starting there."""
    w, seen = np.zeros(size) if at is None else at.copy(), np.full(size, 1e-8)
    share = np.bincount(y.astype(int), minlength=2) + (0 if sums is None else sums.n)
    total, of_class = share.sum(), share.sum() / (2 * share.clip(1))
    weight = of_class[y.astype(int)]
    slope, bound = (0.0, 0.0) if sums is None else (of_class @ sums.gradient, of_class @ sums.bound)
    for _ in range(steps):
        g = rows.back((sigmoid(rows.dot(w)) - y) * weight, size)
        if sums is not None:
            g = g + slope + bound * (w - at)
        g = g / total + decay * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def platt(z: np.ndarray, y: np.ndarray, steps: int = 300) -> tuple[float, float]:
    """Slope and intercept that turn scores into log odds."""
    x = np.column_stack([z, np.ones(len(z))]) if z.ndim == 1 else np.column_stack([z, np.ones(len(z))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):  # damped Newton steps
        p = sigmoid(x @ w)
        g = x.T @ (p - y) / len(y) + 1e-3 * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(w)


class Model:
    """Weights and calibration of both views, and how to combine them."""

    def __init__(self, text=None, meta=None, text_cal=(1.0, 0.0), meta_cal=(1.0, 0.0), both=(1.0, 1.0, 0.0), share=1.0):
        self.text, self.meta, self.text_cal, self.meta_cal, self.both, self.share = text, meta, text_cal, meta_cal, both, share

    def scores(self, texts: list, metadata: dict[str, list]) -> np.ndarray:
        """(text view, metadata view, combined) probabilities."""
        if self.text is None:
            return np.full((len(texts), 3), self.share)
        a = text_rows(texts).dot(self.text) * self.text_cal[0] + self.text_cal[1]
        b = meta_rows(metadata).dot(self.meta) * self.meta_cal[0] + self.meta_cal[1]
        return sigmoid(np.column_stack([a, b, self.both[0] * a + self.both[1] * b + self.both[2]]))


def sure_labels(rows: Rows, w: np.ndarray, cal: tuple[float, float]) -> np.ndarray:
    """1 or 0 where a view is sure, else -1."""
    p = sigmoid(rows.dot(w) * cal[0] + cal[1])
    return np.where(p >= SURE, 1, np.where(p <= 1 - SURE, 0, -1))


def co_train(text: Rows, meta: Rows, y: np.ndarray, exchange, rounds: int = ROUNDS, passes: int = PASSES, seed: int = 3) -> Model:
    """``y``: 1 or 0.  ``exchange(views, at)``: the ``Sums`` of both views over all unlabelled
    documents, labelled by the other of ``views`` (weights, calibration), at the weights ``at``."""
    if len(np.unique(y)) < 2:
        return Model(share=float(y.mean()) if len(y) else 1.0)
    order = np.random.default_rng(seed).permutation(len(y))
    hold, stack, fit = np.split(order, [max(1, len(order) // 6), max(2, len(order) // 3)])
    views, sizes = (text, meta), (TEXT_SIZE, META_SIZE)
    held, rows = [v.pick(hold) for v in views], [v.pick(fit) for v in views]
    gold, label = y[hold].astype(float), y[fit].astype(float)

    def judged(k: int, w: np.ndarray):
        cal = platt(held[k].dot(w), gold)
        return w, cal, log_loss(sigmoid(held[k].dot(w) * cal[0] + cal[1]), gold, np.ones(len(gold)))

    best = [judged(k, train(rows[k], label, sizes[k])) for k in (0, 1)]
    for _ in range(rounds):
        given, now = [b[:2] for b in best], [b[0] for b in best]
        for _ in range(passes):
            sums = exchange(given, now)
            if not any(x.n.sum() for x in sums):
                break
            now = [train(rows[k], label, sizes[k], sums=sums[k], at=now[k]) if sums[k].n.sum() else now[k] for k in (0, 1)]
        new = [judged(k, now[k]) for k in (0, 1)]
        best = [n if n[2] <= b[2] + 1e-9 else b for n, b in zip(new, best, strict=True)]
    odds = np.column_stack([views[k].pick(stack).dot(best[k][0]) * best[k][1][0] + best[k][1][1] for k in (0, 1)])
    return Model(best[0][0], best[1][0], best[0][1], best[1][1], platt(odds, y[stack].astype(float)), float(y.mean()))


# ---------------------------------------------------------------- on Spark

def metadata(docs: DataFrame) -> list[Column]:
    """The page metadata as text; columns that the table lacks are null."""
    has = {c.lower() for c in docs.columns}
    known = lambda c, f: (f if c in has else F.lit(None)).cast("string")
    length = F.floor(F.log2(F.greatest(F.col("n_chars").cast("double"), F.lit(1.0)))) if "n_chars" in has else F.lit(None)
    return [known("source", F.col("source") if "source" in has else F.lit(None)).alias("_source"),
            known("lang", F.col("lang") if "lang" in has else F.lit(None)).alias("_lang"), known("n_chars", length).alias("_length")]


NAMES = ("_source", "_lang", "_length")


def unlabelled(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rows whose id is none of the distinct ids ``labelled``.  The ids are sent to the rows, in as
    many blocks of about ``IDS`` as they take, so that no row is shuffled however many there are."""
    blocks = max(1, -(-labelled.count() // IDS))
    for b in range(blocks):
        some = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == b)
        rows = rows.join(F.broadcast(some), "doc_id", "left_anti")
    return rows


FEATURES = "doc_id long, y int, at binary, value binary, _source string, _lang string, _length string"


def _features(rows: DataFrame) -> DataFrame:
    def features(batches):
        for pdf in batches:
            texts = pdf["text"].tolist()
            for s in groups(texts):
                x, part = text_rows(texts[s]), pdf.iloc[s]
                order = np.argsort(x.of, kind="stable")
                cut = np.cumsum(np.bincount(x.of, minlength=x.n))[:-1]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].tolist(), "y": part["y"].tolist(),
                    "at": [a.astype("<u2").tobytes() for a in np.split(x.at[order], cut)],
                    "value": [v.astype("<f4").tobytes() for v in np.split(x.value[order], cut)],
                    **{n: part[n].tolist() for n in NAMES}})

    return rows.mapInPandas(features, FEATURES)


def _both_rows(pdf: pd.DataFrame) -> tuple[Rows, Rows]:
    size = np.array([len(a) // 2 for a in pdf["at"]])
    text = Rows(np.frombuffer(b"".join(pdf["at"]), "<u2").astype(np.int64), np.frombuffer(b"".join(pdf["value"]), "<f4").astype(float),
                np.repeat(np.arange(len(size)), size), len(size))
    return text, meta_rows({n: pdf[n].tolist() for n in NAMES})


def exchanged(pool: DataFrame, views: list, at: list) -> list[Sums]:
    """``Sums`` of both views over the features of the whole pool, in one pass."""
    sizes = (TEXT_SIZE, META_SIZE)

    def part(batches):
        sums = [Sums(n) for n in sizes]
        for pdf in batches:
            if len(pdf):
                rows = _both_rows(pdf)
                for k in (0, 1):
                    sums[k].add(rows[k], at[k], sure_labels(rows[1 - k], *views[1 - k]))
        at_task = TaskContext.get().partitionId()
        for k in (0, 1):
            for y in (0, 1):
                if sums[k].n[y]:
                    g, h = (np.rint(x[y] * UNIT).astype("<i8").tobytes() for x in (sums[k].gradient, sums[k].bound))
                    yield pd.DataFrame({"slot": [at_task], "k": [k], "y": [y], "n": [int(sums[k].n[y])], "g": [g], "h": [h]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        g, h = (np.sum([np.frombuffer(v, "<i8") for v in group[c]], axis=0).tobytes() for c in "gh")
        return pd.DataFrame({"slot": [group["slot"].iat[0]], "k": [group["k"].iat[0]], "y": [group["y"].iat[0]], "n": [group["n"].sum()], "g": [g], "h": [h]})

    # a tree over the tasks: at most FAN_IN sums of fixed size meet in one place
    schema, found = "slot int, k int, y int, n long, g binary, h binary", None
    found, left = pool.mapInPandas(part, schema), pool.rdd.getNumPartitions()
    while left > 1:
        found, left = found.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int")).groupBy("slot", "k", "y").applyInPandas(add, schema), -(-left // FAN_IN)
    out = [Sums(n) for n in sizes]
    for r in found.toPandas().itertuples():
        out[r.k].n[r.y] = r.n
        out[r.k].gradient[r.y], out[r.k].bound[r.y] = (np.frombuffer(v, "<i8") / UNIT for v in (r.g, r.h))
    return out


def fit(docs: DataFrame, labels: DataFrame, seed_docs: int = SEED_DOCS) -> Model:
    truth = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id")
             .agg((F.min("quality") > 0).cast("int").alias("y")))
    truth = materialize(truth)
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    chosen = (truth.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(seed_docs))
    rows = docs.select("doc_id", text_of(docs).alias("text"), *metadata(docs))
    found = _features(bounded_rows(rows.join(F.broadcast(chosen), "doc_id"), seed_docs)).toPandas().sort_values(["doc_id", "y", "at", "value"]).reset_index(drop=True)
    if not len(found):
        return Model()
    y = found["y"].to_numpy()
    if len(np.unique(y)) < 2:
        return Model(share=float(y.mean()))
    pool = materialize(_features(unlabelled(rows, truth.select("doc_id")).withColumn("y", F.lit(-1))))
    return co_train(*_both_rows(found), y, lambda views, at: exchanged(pool, views, at))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, p_text, p_meta, score, kept (score at least one half)."""
    model = fit(docs, labels)

    @F.pandas_udf("p_text double, p_meta double, score double, kept boolean")
    def judge(texts: pd.Series, source: pd.Series, lang: pd.Series, length: pd.Series) -> pd.DataFrame:
        parts, listed = [], texts.tolist()
        for s in groups(listed):
            parts.append(model.scores(listed[s], {n: c.iloc[s].tolist() for n, c in zip(NAMES, (source, lang, length), strict=True)}))
        p = np.round(np.concatenate(parts), 9) if parts else np.empty((0, 3))
        return pd.DataFrame({"p_text": p[:, 0], "p_meta": p[:, 1], "score": p[:, 2], "kept": p[:, 2] >= 0.5})

    return docs.select("doc_id", judge(text_of(docs), *metadata(docs)).alias("q")).select("doc_id", "q.*")

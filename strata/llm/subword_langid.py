"""Language identification: averaged hashed subword embeddings and a linear
softmax, trained by stochastic gradient descent in numpy.

A word is its letter runs, lower-cased; its subwords are the run itself and its
3- and 4-grams with boundary marks, hashed to ``BUCKETS`` embeddings of
``DIM`` numbers.  A text is the mean embedding of all its subwords (of the whole
text), and a linear layer with softmax gives the language.

* Training uses about ``TRAIN_DOCS`` distinct rows of the learnable split (never more than
  twice as many), drawn evenly over the languages by a hash of id and text.  Their sparse
  subword counts (made in tasks) go to the driver; nothing else does.  At most ``MOST_LANGS``
  languages, those with most rows, are learned, as the tables have a column for each.
* One fifth of the training rows is held back to fit the temperature, and the
  rejection limit is the score under which the share ``REJECT`` of the rightly
  predicted held-back rows lies: ``accepted`` is false below it.
* Prediction needs only the product of embeddings and output layer
  (``BUCKETS`` x languages), a fixed-size table.

Defined cases: a text that is null or has no letter is ``und`` with score 0, not
accepted; without any learnable row every text is ``und``; a language's
score ties go to the first in sorted order; one output row per input row.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows, text_of, utf8
from .vocabulary import Growing, Vocabulary, groups

BUCKETS = 1 << 15
DIM = 16
TRAIN_DOCS = 4_000
EPOCHS = 6
RATE = 0.5
MOST_LANGS = 128
REJECT = 0.01

_LETTERS = re.compile(r"[^\W\d_]+")
_LETTER = regex.compile(r"\p{L}")


def subwords(word: str) -> list[int]:
    """Buckets of a run of letters: itself and its marked 3- and 4-grams."""
    marked = f"<{word}>"
    grams = [marked, *(marked[i:i + k] for k in (3, 4) for i in range(len(marked) - k + 1))]
    return [zlib.crc32(utf8(g)) % BUCKETS for g in grams]


def word_buckets(word: bytes) -> list[int]:
    return [b for run in _LETTERS.findall(word.decode("utf-8", "surrogatepass").lower()) for b in subwords(run)]


def held_out(doc_id: Column) -> Column:
    """The rows that nothing may be learned from: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


class _Counts(Vocabulary):
    def clear(self) -> None:
        self.buckets: list[np.ndarray] = []

    def grow(self, words: list[bytes]) -> None:
        self.buckets.extend(np.array(word_buckets(w), np.int32) for w in words)


def training_rows(docs: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """At most about ``most`` learnable rows, evenly over the languages."""
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), text_of(docs).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(True)))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS).collect()
    share = F.lit(0.0)
    for r in sizes:  # one row a language: no text meets another by its language
        share = F.when(F.col("lang") == r["lang"], most / len(sizes) / r["count"]).otherwise(share)
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1_000_000)) < share * 1_000_000)
    return bounded_rows(drawn, 2 * most).select("doc_id", "lang", "text")


def features(rows: DataFrame) -> pd.DataFrame:
    """(doc_id, lang, buckets, counts) of training rows, ordered by id."""

    def count(batches):
        v = _Counts(100_000)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for s in groups(texts):
                at, counts = v.index(texts[s])
                out, end = [], np.cumsum(counts)
                for e, n in zip(end, counts, strict=True):
                    found = [v.buckets[i] for i in at[e - n:e]]
                    b, c = np.unique(np.concatenate(found) if found else np.empty(0, np.int32), return_counts=True)
                    out.append((b.astype(np.int32).tobytes(), c.astype(np.float32).tobytes()))
                part = pdf.iloc[s]
                yield pd.DataFrame({"doc_id": part["doc_id"].tolist(), "lang": part["lang"].tolist(),
                                    "buckets": [o[0] for o in out], "counts": [o[1] for o in out]})

    found = rows.mapInPandas(count, "doc_id long, lang string, buckets binary, counts binary")
    return found.toPandas().sort_values(["doc_id", "lang", "buckets"]).reset_index(drop=True)


class Model:
    """Languages, table of (subword -> logits), temperature, rejection limit."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, limit: float = 0.0):
        self.langs, self.table, self.bias, self.temperature, self.limit = langs, table, bias, temperature, limit


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(found: pd.DataFrame, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """SGD over mini-batches; then temperature and limit on the held-back fifth."""
    langs = sorted(found["lang"].unique())
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    x = [(np.frombuffer(b, np.int32), np.frombuffer(c, np.float32)) for b, c in zip(found["buckets"], found["counts"], strict=True)]
    y = np.searchsorted(langs, found["lang"]) if langs else np.empty(0, int)
    usable = np.array([i for i, (b, _) in enumerate(x) if len(b)], int)
    order = rng.permutation(usable)
    hold, fit = order[:len(order) // 5], order[len(order) // 5:]

    def mean(rows):
        sizes = [len(x[i][0]) for i in rows]
        at = np.concatenate([x[i][0] for i in rows])
        w = np.concatenate([x[i][1] / x[i][1].sum() for i in rows])
        starts = np.cumsum([0, *sizes[:-1]])
        return at, w, np.repeat(np.arange(len(rows)), sizes), np.add.reduceat(emb[at] * w[:, None], starts)

    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for start in range(0, len(fit), 32):
            rows = rng.permutation(fit)[:32] if start == 0 and len(fit) <= 32 else fit[start:start + 32]
            at, w, of, h = mean(rows)
            g = softmax(h @ out + bias)
            g[np.arange(len(rows)), y[rows]] -= 1
            back = g @ out.T
            out -= rate * (h.T @ g) / len(rows) * 8
            bias -= rate * g.mean(axis=0)
            np.subtract.at(emb, at, rate * w[:, None] * back[of] * 8)
        rng.shuffle(fit)
    model = Model(langs, emb @ out, bias)
    if len(hold):
        z = np.concatenate([mean(hold[i:i + 64])[3] for i in range(0, len(hold), 64)]) @ out + bias
        grid = np.geomspace(0.05, 10, 60)
        loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(hold)), y[hold]], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(z / model.temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == y[hold]]
        model.limit = float(np.quantile(right, REJECT)) if len(right) else 0.0
    return model


class Logits(Vocabulary):
    """Per word: the sum of its subwords' logits, and their number."""

    def __init__(self, model: Model):
        self.model = model
        super().__init__()

    def clear(self) -> None:
        self.rows = Growing(np.float64, len(self.model.langs) + 1)

    def grow(self, words: list[bytes]) -> None:
        found = [word_buckets(w) for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        at = np.fromiter((b for f in found for b in f), np.int64, int(size.sum()))
        of = np.repeat(np.arange(len(found)), size)
        self.rows.extend(np.column_stack([*(np.bincount(of, self.model.table[at, k], len(found)) for k in range(len(self.model.langs))), size]))

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        for s in groups(texts):
            at, counts = self.index(texts[s])
            of = np.repeat(np.arange(len(counts)), counts)
            sums = np.column_stack([np.bincount(of, self.rows.data[at, k], len(counts)) for k in range(self.rows.data.shape[1])])
            p = softmax((sums[:, :-1] / np.maximum(sums[:, -1:], 1) + self.model.bias) / self.model.temperature)
            seen = np.array([bool(t) and _LETTER.search(t) is not None for t in texts[s]])
            names += [self.model.langs[k] if ok else "und" for k, ok in zip(p.argmax(axis=1), seen, strict=True)]
            scores.append(np.where(seen, p.max(axis=1), 0.0))
        return names, np.concatenate(scores) if scores else np.empty(0)


_KEPT: dict[bytes, Logits] = {}


def _logits(model: Model) -> Logits:
    """The worker's word table, kept over tasks of one model."""
    key = model.table.tobytes()[:4096] + repr((model.langs, model.temperature)).encode()
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Logits(model)
    return _KEPT[key]


def language(text: Column, model: Model) -> Column:
    """Struct column: lang_pred, score, accepted."""

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if not model.langs:
            return pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0, "accepted": False})
        names, score = _logits(model).predict(texts.tolist())
        score = np.round(score, 9)
        return pd.DataFrame({"lang_pred": names, "score": score,
                             "accepted": (score >= model.limit) & (np.array(names, object) != "und")})

    return predict(text)


def fit(docs: DataFrame, most: int = TRAIN_DOCS) -> Model:
    return train(features(training_rows(docs, most)))


def identify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, accepted."""
    return (docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                        language(text_of(docs), fit(docs)).alias("p")).select("doc_id", "held_out", "p.*"))

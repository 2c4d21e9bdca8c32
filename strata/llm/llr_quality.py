"""Quality rules: hashed n-gram log-likelihood ratio.

Every document is scored by the mean log ratio, over its word 1- and 2-grams
(hashed to ``BUCKETS`` buckets), of a trusted-target multinomial to the
raw-corpus multinomial; a document is kept when the mean reaches a fixed
threshold and the plain rules on its own text do not reject it.

* Raw counts cover all documents.  Each task sums its documents into one
  vector, so a task sends at most ``BUCKETS`` rows into the aggregation and the
  driver receives at most ``BUCKETS`` rows, whatever the corpus size.
* The target is fitted on all labelled rows: documents whose labels all say
  quality 1 and never toxic.  Their ids are sent to the tasks in as many blocks of
  about ``IDS`` as they take, so that no text is shuffled.
* The ratio of a bucket is ``(target + k) / (expected + k)`` where ``expected``
  is what the raw distribution gives a target of this size: buckets without
  evidence count as neutral.

Defined cases: null or empty text has no words, fails the base rules and has
ratio 0; a text without n-grams has ratio 0; without trusted documents every
ratio is 0 and only the base rules decide; repeated rows count as often as they
stand; the output has one row per input row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

from .common import free_name, text_of, utf8
from .vocabulary import Growing, Vocabulary, groups, held, spread

BITS = 16
BUCKETS = 1 << BITS
IDS = 1 << 20
PSEUDO = 5.0
#: Mean log ratio (nats per n-gram) below which a document is rejected.
THRESHOLD = -0.25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_BLANK = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"

METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class Tokens(Vocabulary):
    """Words with the 32-bit hashes of their tokens (runs of word characters
    or of other characters, lower-cased)."""

    def clear(self) -> None:
        self.hashes, self.start, self.size = Growing(np.uint32), Growing(np.int64), Growing(np.int64)

    def grow(self, words: list[bytes]) -> None:
        found = [[zlib.crc32(utf8(t)) for t in _TOKEN.findall(w.decode("utf-8", "surrogatepass").lower())] for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        self.start.extend(self.hashes.n + np.cumsum(size) - size)
        self.size.extend(size)
        self.hashes.extend(np.array([h for f in found for h in f], np.uint32))

    def ngrams(self, at: np.ndarray, counts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of every 1- and 2-gram of the texts, and the text of each."""
        size = self.size.data[at]
        one = self.hashes.data[spread(self.start.data[at], size)]
        of = np.repeat(np.repeat(np.arange(len(counts)), counts), size)
        two = one[:-1] * np.uint32(0x9E3779B1) + one[1:] + np.uint32(1)
        inside = of[:-1] == of[1:]
        both = np.concatenate([one, two[inside]])
        both ^= both >> np.uint32(15)
        both *= np.uint32(0x85EBCA6B)
        return (both >> np.uint32(32 - bits)).astype(np.int64), np.concatenate([of, of[:-1][inside]])


def repeated_window_words(at: np.ndarray, width: int = 3) -> int:
    """Words (given by number) inside windows that occur at least twice."""
    n = len(at)
    if n <= width:
        return 0
    if int(at.max()) < 1 << 63 // width:
        key = at[:n - width + 1].copy()
        for i in range(1, width):
            key = (key << (63 // width)) | at[i:n - width + 1 + i]
        ordered = np.sort(key)
        if (ordered[1:] != ordered[:-1]).all():
            return 0
        _, where, times = np.unique(key, return_inverse=True, return_counts=True)
        twice = times[where] > 1
    else:  # more words than the packed key has numbers for
        windows = list(zip(*(at[i:].tolist() for i in range(width)), strict=False))
        seen = Counter(windows)
        twice = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(n, bool)
    for i in range(width):
        covered[i:n - width + 1 + i] |= twice
    return int(covered.sum())


def line_metrics(text: str | None) -> tuple[int, int, int]:
    """word_chars, n_symbols, n_dup_lines of a text."""
    if not text:
        return 0, 0, 0
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    return (len(text) - sum(map(text.count, _BLANK)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids whose labels all say quality 1, not toxic."""
    return (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
            .where("q = 1 and t = 0").select("doc_id"))


def with_trusted(docs: DataFrame, labels: DataFrame, ids: int = IDS) -> DataFrame:
    """``text`` of every document and whether its id is trusted."""
    trusted = materialize(trusted_ids(labels))
    blocks = max(1, -(-trusted.count() // ids))
    rows = docs.select("doc_id", text_of(docs).alias("text"), F.lit(False).alias("trusted"))
    for b in range(blocks):
        some = trusted.where(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == b).withColumn("here", F.lit(True))
        rows = (rows.join(F.broadcast(some), "doc_id", "left")
                .select("doc_id", "text", (F.col("trusted") | F.col("here").isNotNull()).alias("trusted")))
    return rows.select("text", "trusted")


def _tokens() -> Tokens:
    """The worker's numbering, kept over tasks."""
    return held("llr tokens", Tokens)


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, ids: int = IDS) -> np.ndarray:
    """Log ratio target / raw per bucket, from all documents and all trusted ones."""
    buckets = 1 << bits
    rows = with_trusted(docs, labels, ids)

    def count(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for pdf in batches:
            texts, is_trusted = pdf["text"].tolist(), pdf["trusted"].to_numpy(bool)
            for s in groups(texts):
                at, of = _tokens().ngrams(*_tokens().index(texts[s]), bits)
                raw += np.bincount(at, minlength=buckets)
                target += np.bincount(at[is_trusted[s][of]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": at, "raw": raw[at], "target": target[at]})

    found = (rows.mapInPandas(count, "bucket long, raw long, target long")
             .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[found["bucket"].astype(int)], target[found["bucket"].astype(int)] = found["raw"], found["target"]
    if not target.sum():
        return np.zeros(buckets)
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + PSEUDO) / (expected + PSEUDO))


def judge_texts(texts: list, ratios: np.ndarray, threshold: float = THRESHOLD) -> list[tuple]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept) of each text."""
    rows = []
    for s in groups(texts):
        at, counts = _tokens().index(texts[s])
        gram, of = _tokens().ngrams(at, counts, len(ratios).bit_length() - 1)
        total = np.bincount(of, minlength=len(counts))
        llr = np.round(np.bincount(of, ratios[gram], len(counts)) / np.maximum(total, 1), 6)
        end = np.cumsum(counts)
        for i, t in enumerate(texts[s]):
            n = int(counts[i])
            repeat = repeated_window_words(at[end[i] - n:end[i]])
            failed = base_failed(n, repeat)
            rows.append((n, *line_metrics(t), repeat, failed, float(llr[i]), not failed and bool(llr[i] >= threshold)))
    return rows


def quality(text: Column, ratios: np.ndarray, threshold: float = THRESHOLD) -> Column:
    """Struct column: the base metrics, ``base_failed``, ``llr`` and ``kept``."""

    @F.pandas_udf(f"{METRICS}, base_failed boolean, llr double, kept boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(judge_texts(texts.tolist(), ratios, threshold), columns=[
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"])

    return judge(text)


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, base metrics, ``llr``, ``kept``."""
    verdict = quality(text_of(docs), fit(docs, labels), threshold)
    return docs.select("doc_id", verdict.alias("v")).select("doc_id", "v.*")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    v = free_name(docs, "_verdict")
    return (docs.withColumn(v, quality(text_of(docs), fit(docs, labels), threshold))
            .where(F.col(f"{v}.kept")).select(*[f"`{c}`" for c in docs.columns]))

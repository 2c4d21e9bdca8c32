"""Byte-level BPE encoding and decoding as a reduction over a tree of halves.

``encode`` cuts a text in halves down to leaves of ``LEAF`` characters, encodes
each leaf, and joins neighbours: a window around their boundary is encoded
anew and replaces the tokens of both sides that it covers.  The window grows
until its ends provably leave the tokens outside alone: an end is safe where a
non-space character is followed by white space, and between ASCII letters, digits
and marks where the kind changes (but not after an apostrophe, which may begin a
contraction).  No match of the split pattern holds such a pair, and no match before it
looks beyond it, so in every context a match ends there, and each match is encoded on
its own.  If a side has no such place the window takes all of it, and that side is
not encoded before.

``decode`` concatenates the tokens' bytes up the same kind of tree.

Defined cases: null text counts as empty (no tokens); a text without a safe
place is one window, encoded once; one output row per input row.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, utf8
from .vocabulary import held

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LEAF = 512
WINDOW = 32

#: A place between a non-space and a white-space character (the pattern's ``\s``;
#: the control characters 1C-1F, which only Python counts as white space, are left out),
#: or between ASCII characters of two kinds.
_MARKS = r"(-/:-@\[-`{-~"
_CUT = re.compile(r"(?<=[^\s])(?=[^\S\x1c-\x1f])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
                  rf"|(?<=[A-Za-z0-9])(?=[!-'{_MARKS}])|(?<=[!-&{_MARKS}])(?=[A-Za-z0-9])")


class Codec:
    def __init__(self, path: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        return self._encode(text, 0, len(text), leaf)

    def _encode(self, text: str, lo: int, hi: int, leaf: int) -> list[int]:
        if hi - lo <= leaf:
            return self.encoding.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        a, b = left_cut(text, lo, mid), right_cut(text, mid, hi)
        left = self._encode(text, lo, mid, leaf) if a > lo else []
        right = self._encode(text, mid, hi, leaf) if b < hi else []
        return self.join(left, right, text, a, mid, b)

    def join(self, left: list[int], right: list[int], text: str, a: int, mid: int, b: int) -> list[int]:
        """Tokens of two neighbours that meet at ``mid``: the window a .. b is encoded anew.  A side that
        lies in the window as a whole may be given without tokens."""
        keep = len(left) - self.covering(reversed(left), len(utf8(text[a:mid]))) if left else 0
        skip = self.covering(right, len(utf8(text[mid:b]))) if right else 0
        return left[:keep] + self.encoding.encode_ordinary(text[a:b]) + right[skip:]

    def covering(self, tokens, size: int) -> int:
        """How many of the tokens hold exactly ``size`` bytes."""
        n = 0
        for t in tokens:
            if size <= 0:
                break
            size -= len(self.bytes_of[t])
            n += 1
        if size:
            raise AssertionError("a window's end is inside a token")
        return n

    def decode(self, ids: list[int], leaf: int = LEAF) -> bytes:
        if len(ids) <= leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid], leaf) + self.decode(ids[mid:], leaf)


def left_cut(text: str, lo: int, mid: int) -> int:
    """The last safe place before ``mid`` in a growing window, or ``lo``."""
    size = WINDOW
    while True:
        start = max(lo, mid - size)
        found = [m.start() for m in _CUT.finditer(text, start, mid)]
        if found:
            return found[-1]
        if start == lo:
            return lo
        size *= 2


def right_cut(text: str, mid: int, hi: int) -> int:
    """The first safe place after ``mid`` in a growing window, or ``hi``."""
    size = WINDOW
    while True:
        end = min(hi, mid + size)
        found = _CUT.search(text, mid + 1, end)
        if found:
            return found.start()
        if end == hi:
            return hi
        size *= 2


def codec(path: str) -> Codec:
    """The worker's copy of the ranks, kept over tasks."""
    return held(f"ranks {path}", lambda: Codec(path))


def encode_column(text: Column, ranks: str = RANKS) -> Column:
    """Array of token ids."""
    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: np.array(codec(ranks).encode(t or ""), np.int32))
    return encode(text)


def decode_column(ids: Column, ranks: str = RANKS) -> Column:
    """The bytes of an array of token ids."""
    @F.pandas_udf("binary")
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda v: codec(ranks).decode([] if v is None else list(v)))
    return decode(ids)


def digest_column(text: Column, ranks: str = RANKS) -> Column:
    """Struct of n_tokens and the hashes of the ids and of the decoded bytes,
    made in one pass so that no id list leaves the task."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        c, rows = codec(ranks), []
        for t in texts:
            ids = c.encode(t or "")
            rows.append((len(ids), hashlib.sha256(" ".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest(),
                         hashlib.sha256(c.decode(ids)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    return digest(text)


def round_trip(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return docs.select("doc_id", digest_column(text_of(docs), ranks).alias("d")).select("doc_id", "d.*")

"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

``Pieces.encode`` puts all adjacent symbol pairs that form a piece on an agenda
ordered by the piece's score, ties from the left.  The best pair is joined and its
new neighbour pairs join the agenda; entries whose symbols have changed since
are skipped.  What remains are pieces, or characters outside the vocabulary,
which become one byte piece per UTF-8 byte.

A white-space mark occurs only at the start of pieces (checked when a model is
loaded; else a text is one word), so no pair spans the place before a run of marks: a
text is cut there, and also around characters that no longer piece holds, and
each distinct word is put through the agenda once while a worker remembers it.
The memory is bounded in bytes and starts anew when full, which changes no
result.

The words of a batch that a worker does not know yet are put through their agendas together,
all of one length as rows of arrays: a round joins the best pair of every row, in place, with the
places before and after each symbol.  Longer words and words
with characters outside the vocabulary have an agenda of their own.

``Pieces.decode`` joins the pieces, drops the mark that encoding put in front, and
reads runs of byte pieces as UTF-8, an invalid byte as U+FFFD.

``digests`` works in Arrow batches and holds every batch against the
sentencepiece library: ``matches_library`` says for each document whether ids and
decoded text are the library's.

Models that normalize, drop white space or have pieces of their own by the user
(none does of the merge type used here) are refused with an error, not encoded wrongly.

Defined cases: null text counts as empty and has the begin and end ids alone; one
output row per input row, repeated rows and null ids included; a text without
white space is one word, in time n log n of its length; an empty table has no rows;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import operator
import struct
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of
from .vocabulary import groups

MODEL = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"

#: Bytes of words, ids and their bookkeeping that a worker remembers; longer words are not kept.
KEEP_BYTES = 320 << 20
KEEP_WORD = 64
ENTRY_BYTES = 250

#: Symbols up to which a word's agenda is a list, searched for its best entry.
LISTED = 48
NO_PIECE = float("inf")
NO_RANK = np.iinfo(np.int32).max

#: Bits of the hash by which pairs of pieces are looked up, and its factor.
SLOT_BITS = 20
SLOT_FACTOR = np.uint64(0x9E3779B97F4A7C15)

#: Words of one length whose agendas are worked on together.
ROWS = 1 << 14

NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
MERGE_TYPE = 2


class Pieces:
    """A merge-type model, read from its file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as model_file
        model = model_file.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if (model.trainer_spec.model_type != MERGE_TYPE or not model.trainer_spec.byte_fallback or rules.precompiled_charsmap or rules.remove_extra_whitespaces
                or not rules.add_dummy_prefix or not rules.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix
                or any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in model.pieces)):
            raise ValueError(f"{path}: only merge-type models with byte pieces and no normalization are encoded")
        self.path = path
        self.known = {p.piece: (-p.score, i) for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p: score for p, (score, _) in self.known.items()}.get
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.begin, self.end = (next(i for i, p in enumerate(model.pieces) if p.type == CONTROL and p.piece == mark) for mark in ("<s>", "</s>"))
        self.bytes_of = [b"" if p.type == CONTROL else model.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else
                         bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else p.piece.replace(MARK, " ").encode() for p in model.pieces]
        self._pairs()
        self.is_byte = np.array([p.type == BYTE for p in model.pieces])
        self.in_front = np.array([p.type == NORMAL and p.piece[:1] == MARK for p in model.pieces])
        inner = {c for p in self.known if len(p) > 1 for c in p}
        lone = "".join(re.escape(chr(c)) for c in range(0x21) if chr(c) not in inner and chr(c) != " ")
        whole = any(MARK in p.lstrip(MARK) for p in self.known)
        self.words = re.compile(".+" if whole else f"{MARK}+[^{MARK}{lone}]*|[^{MARK}{lone}]+|[{lone}]" if lone else f"{MARK}+[^{MARK}]*|[^{MARK}]+", re.S)
        self.kept: dict[str, bytes] = {}
        self.room = KEEP_BYTES

    def _pairs(self) -> None:
        """Arrays for many words at once: the piece of each character (-1 if none), and the pairs of
        pieces that are a piece together, with their rank by score."""
        self.char_id = np.full(0x110000, -1, np.int32)
        for p, (_, i) in self.known.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        scores = {s: k for k, s in enumerate(sorted({s for s, _ in self.known.values()}))}
        rows = sorted((self.known[p[:k]][1] * len(self.bytes_of) + self.known[p[k:]][1], scores[s], i)
                      for p, (s, i) in self.known.items() for k in range(1, len(p)) if p[:k] in self.known and p[k:] in self.known)
        rows = rows or [(-1, 0, 0)]
        self.pair, self.pair_rank, self.pair_piece = (np.array(c, d) for c, d in zip(zip(*rows, strict=True), (np.int64, np.int32, np.int32), strict=True))
        slots, first, sharing = np.unique(_slot(self.pair), return_index=True, return_counts=True)
        self.slot = np.full(1 << SLOT_BITS, -1, np.int32)  # the only pair of a slot, -1 for none, -2 for several
        self.slot[slots] = np.where(sharing == 1, first, -2)

    # ---- encoding

    def agenda(self, word: str) -> list[int]:
        """Ids of a word: the best-scored adjacent pair is joined until none is a piece."""
        ids: list[int] = []
        for s in self._listed(word) if len(word) <= LISTED else self._heaped(word):
            found = self.known.get(s)
            ids += [found[1]] if found is not None else [self.byte_ids[b] for b in s.encode("utf-8", "surrogatepass")]
        return ids

    def _listed(self, word: str) -> list[str]:
        """Symbols of a short word; its agenda is a list with one entry a pair, in place."""
        score, symbols = self.score, list(word)
        waiting = [score(a + b, NO_PIECE) for a, b in zip(symbols, symbols[1:], strict=False)]
        while waiting and (best := min(waiting)) != NO_PIECE:
            at = waiting.index(best)
            symbols[at] += symbols.pop(at + 1)
            del waiting[at]
            if at < len(waiting):
                waiting[at] = score(symbols[at] + symbols[at + 1], NO_PIECE)
            if at:
                waiting[at - 1] = score(symbols[at - 1] + symbols[at], NO_PIECE)
        return symbols

    def _heaped(self, word: str) -> list[str]:
        """Symbols of a long word; its agenda is a heap, and changed pairs are skipped."""
        known, symbols = self.known, list(word)
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        waiting = [(known[a + b][0], i, i + 1, 2) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in known]
        heapq.heapify(waiting)
        last = len(symbols)
        while waiting:
            _, left, right, size = heapq.heappop(waiting)
            one, two = symbols[left], symbols[right]
            if not one or not two or len(one) + len(two) != size:
                continue
            symbols[left], symbols[right] = joined, _ = one + two, ""
            after[left] = next_ = after[right]
            if next_ < last:
                before[next_] = left
                if (found := known.get(joined + symbols[next_])) is not None:
                    heapq.heappush(waiting, (found[0], left, next_, size + len(symbols[next_])))
            if (prev := before[left]) >= 0 and (found := known.get(symbols[prev] + joined)) is not None:
                heapq.heappush(waiting, (found[0], prev, left, size + len(symbols[prev])))
        return [s for s in symbols if s]

    def _word(self, word: str) -> bytes:
        ids = struct.pack(f"<{len(found := self.agenda(word))}I", *found)
        if len(word) <= KEEP_WORD:
            self._keep(word, ids)
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of a text, begin and end ids included, as little-endian uint32."""
        words = self._words(text)
        return self._joined(words, list(map(self.kept.get, words)))

    def _words(self, text: str | None) -> list[str]:
        return self.words.findall(MARK + text.replace(" ", MARK)) if text else []

    def learn(self, words: list[str]) -> None:
        """Remember words that are not known yet, all words of one length at a time: the agenda of
        each is a row of scores, and every round joins the best pair of each row."""
        by_size: dict[int, list[str]] = {}
        for w in words:
            if 1 < len(w) <= KEEP_WORD:
                by_size.setdefault(len(w), []).append(w)
        for size, some in by_size.items():
            for k in range(0, len(some), ROWS):
                self._learn(some[k:k + ROWS], size)

    def _learn(self, words: list[str], size: int) -> None:
        """All arrays have a column per character; an entry of ``waiting`` and ``joined`` is the pair of the
        symbol there and the one after it, and a symbol that was joined to the one before it is -1."""
        symbols = self.char_id[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")].reshape(-1, size)
        named = (symbols >= 0).all(axis=1)  # words with characters outside the vocabulary are taken singly
        number, symbols = np.flatnonzero(named), symbols[named]
        waiting, joined = np.full(symbols.shape, NO_RANK, np.int32), np.zeros(symbols.shape, np.int32)
        waiting[:, :-1], joined[:, :-1] = self._scores(symbols[:, :-1], symbols[:, 1:])
        before, after = (np.tile(np.arange(size) + step, (len(number), 1)) for step in (-1, 1))
        while len(number):
            best = waiting.argmin(axis=1)  # of equal scores the first
            more = waiting[np.arange(len(number)), best] < NO_RANK
            if np.count_nonzero(more) < 0.7 * len(number):
                self._finish(words, number[~more], symbols[~more])
                number, symbols, waiting, joined, before, after, best = (x[more] for x in (number, symbols, waiting, joined, before, after, best))
                more = more[more]
            first = np.flatnonzero(more) * size  # where the rows begin in the flat arrays
            at = first + best[more]
            flat, rank, piece, back, next_ = (x.reshape(-1) for x in (symbols, waiting, joined, before, after))
            right = first + next_[at]
            flat[at], flat[right] = piece[at], -1
            rank[at] = rank[right] = NO_RANK
            follower, next_[at] = next_[right], next_[right]
            has = follower < size
            back[(first + follower)[has]] = (at - first)[has]
            near = np.flatnonzero(back[at] >= 0)
            one = np.concatenate([at[has], first[near] + back[at[near]]])
            rank[one], piece[one] = self._scores(flat[one], flat[np.concatenate([(first + follower)[has], at[near]])])

    def _finish(self, words: list[str], number: np.ndarray, symbols: np.ndarray) -> None:
        """Remember words whose agendas are empty."""
        left = symbols >= 0
        data, ends = symbols[left].astype("<u4").tobytes(), (4 * np.cumsum(left.sum(axis=1))).tolist()
        size = ENTRY_BYTES * len(number) + 4 * symbols.size + len(data)
        if size > self.room:
            self.kept, self.room = {}, KEEP_BYTES
        self.kept.update(zip(map(words.__getitem__, number.tolist()), map(data.__getitem__, map(slice, [0, *ends], ends)), strict=False))
        self.room -= size

    def _scores(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the pieces that pairs of pieces form (``NO_RANK`` if none), and the pieces."""
        key = left.astype(np.int64) * len(self.bytes_of) + right
        at = self.slot[_slot(key)]
        several = np.nonzero(at == -2)
        if len(several[0]):
            at[several] = np.minimum(np.searchsorted(self.pair, key[several]), len(self.pair) - 1)
        return np.where((at >= 0) & (self.pair[at] == key), self.pair_rank[at], NO_RANK), self.pair_piece[at]

    def _keep(self, word: str, ids: bytes) -> None:
        size = ENTRY_BYTES + 4 * len(word) + len(ids)
        if size > self.room:
            self.kept, self.room = {}, KEEP_BYTES
        self.kept[word], self.room = ids, self.room - size

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """``encode`` of many texts; words that are new to the worker are learned together."""
        out = []
        for s in groups(texts):
            lists = list(map(self._words, texts[s]))
            found = [list(map(self.kept.get, words)) for words in lists]
            self.learn(list(set().union(*(compress(w, map(operator.is_, f, repeat(None))) for w, f in zip(lists, found, strict=True)))))
            out += map(self._joined, lists, found)
        return out

    def _joined(self, words: list[str], found: list[bytes | None]) -> np.ndarray:
        """The ids of a text from those of its words; what was not known when ``found`` was made is looked up again."""
        if None in found:
            for i in [i for i, f in enumerate(found) if f is None]:
                found[i] = self.kept.get(words[i]) or self._word(words[i])
        return np.frombuffer(b"".join([struct.pack("<I", self.begin), *found, struct.pack("<I", self.end)]), "<u4")

    # ---- decoding

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of a list of ids, without the mark in front."""
        ids = ids if isinstance(ids, list) else np.asarray(ids, np.int64).tolist()
        start, stop = 0, len(ids)
        while start < stop and ids[start] in (self.begin, self.end):
            start += 1
        while start < stop and ids[stop - 1] in (self.begin, self.end):
            stop -= 1
        if start == stop:
            return ""
        ids = ids[start:stop]
        if self.begin in ids or self.end in ids:  # a control piece inside ends a run of bytes
            return self._repaired(np.array(ids, np.int64))
        joined = b"".join(map(self.bytes_of.__getitem__, ids))
        if self.in_front[ids[0]]:
            joined = joined[1:]
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return self._repaired(np.array(ids, np.int64))

    def _repaired(self, ids: np.ndarray) -> str:
        """As ``decode`` where byte pieces are not UTF-8: each such byte is one U+FFFD."""
        out, at = [], 0
        byte = self.is_byte[ids]
        while at < len(ids):
            end = at + 1
            while end < len(ids) and byte[end] == byte[at]:
                end += 1
            part = b"".join(map(self.bytes_of.__getitem__, ids[at:end].tolist()))
            out.append(_utf8_or_marks(part) if byte[at] else part.decode())
            if at == 0 and self.in_front[ids[0]]:
                out[0] = out[0][1:]
            at = end
        return "".join(out)


def _slot(pairs: np.ndarray) -> np.ndarray:
    return (pairs.astype(np.uint64) * SLOT_FACTOR) >> np.uint64(64 - SLOT_BITS)


def _utf8_or_marks(part: bytes) -> str:
    out, at = [], 0
    while at < len(part):
        for n in (1, 2, 3, 4):
            try:
                out.append(part[at:at + n].decode())
                break
            except UnicodeDecodeError:
                pass
        else:
            n = 1
            out.append("�")
        at += n
    return "".join(out)


_LOADED: dict[str, Pieces] = {}
_LIBRARY: dict[str, object] = {}


def pieces(path: str = MODEL) -> Pieces:
    """The worker's copy of a model, kept over tasks."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def library(path: str = MODEL):
    if path not in _LIBRARY:
        from sentencepiece import SentencePieceProcessor
        _LIBRARY[path] = SentencePieceProcessor(model_file=path)
    return _LIBRARY[path]


# ---------------------------------------------------------------- on tables

def encode_column(text: Column, model: str = MODEL) -> Column:
    """Array of ids, begin and end ids included."""
    @F.pandas_udf("array<int>")
    def encode(texts):
        return pd.Series([i.astype(np.int32) for i in pieces(model).encode_all(texts.tolist())], dtype=object)
    return encode(text)


def decode_column(ids: Column, model: str = MODEL) -> Column:
    """The text of an array of ids; null for null."""
    @F.pandas_udf("string")
    def decode(values):
        return values.map(lambda v: None if v is None else pieces(model).decode(v))
    return decode(ids)


def digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (ids as little-endian uint32), decoded_sha256,
    matches_library."""
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(*f) for f in (
        ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()), ("matches_library", T.BooleanType())))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lib = pieces(model), library(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = own.encode_all(texts)
            back, same = [], []
            for t, i in zip(texts, ids, strict=True):
                listed, its = i.tolist(), lib.encode(t, add_bos=True, add_eos=True)
                back.append(own.decode(listed))
                same.append(listed == its and back[-1] == lib.decode(its))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(b.encode("utf-8", "surrogatepass")).hexdigest() for b in back], pa.string()), pa.array(same, pa.bool_())],
                names=schema.names)

    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(work, schema)

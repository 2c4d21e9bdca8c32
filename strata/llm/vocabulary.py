"""Per-worker numbering of the words of texts, so that what depends on a word
alone is computed once a word and the rest of the work is on integer arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

T = TypeVar("T")


def groups(texts: list, most: int = 1 << 20) -> Iterator[slice]:
    """Slices of about ``most`` characters, so that a batch's temporary lists stay small."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
    give_back()


def give_back() -> None:
    """Return what Arrow's allocator keeps of a batch's temporary arrays to the system: a worker lives as long as
    its executor, and would add the most of any batch to the executor's memory for good."""
    pa.default_memory_pool().release_unused()


_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], T]) -> T:
    """What a worker remembers over the tasks of one operator (made anew whenever it is missing).  It is let go when
    another operator's is asked for, so that the operators of a pipeline do not add up in a worker."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


class Vocabulary:
    """Numbers for the words between ASCII white space (09-0D, 20).

    Subclasses derive data from new words in ``grow``.  Beyond ``keep`` words
    the numbering starts anew, which changes no result: numbers are used only
    within one call."""

    def __init__(self, keep: int = 200_000):
        self.keep = keep
        self.ids: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        pass

    def grow(self, words: list[bytes]) -> None:
        pass

    def index(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of the texts in a row, and the words per text."""
        flat, counts = split_words(pa.array(texts, pa.string()))
        coded = flat.dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        if len(self.ids) > self.keep:
            self.ids = {}
            self.clear()
        number = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            new = [words[i] for i in unknown.tolist()]
            number[unknown] = np.arange(len(self.ids), len(self.ids) + len(new))
            self.ids.update(zip(new, number[unknown].tolist(), strict=True))
            self.grow(new)
        return number[coded.indices.to_numpy()], counts


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between ASCII white space of all texts in a row, and the number per text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, ends = lists.flatten(), lists.offsets.to_numpy()
    has = pc.greater(pc.binary_length(flat), 0)  # splitting leaves empty words at a text's ends
    return flat.filter(has), np.diff(np.concatenate([[0], np.cumsum(has.to_numpy(zero_copy_only=False))])[ends])


class Growing:
    """An array with room to append."""

    def __init__(self, dtype, width: int | None = None):
        self.data, self.n = np.empty((1024,) if width is None else (1024, width), dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.data):
            data = np.empty((max(need, 2 * len(self.data)), *self.data.shape[1:]), self.data.dtype)
            data[:self.n] = self.data[:self.n]
            self.data = data
        self.data[self.n:need] = values
        self.n = need


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges start .. start + size of all elements in a row."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)

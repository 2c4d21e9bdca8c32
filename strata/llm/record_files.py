"""Token-ID output as length-delimited binary records with an offset index.

Each document becomes one record of a TFRecord file::

    uint64 length | uint32 masked crc32c(length) | data | uint32 masked crc32c(data)

``data`` is a serialized ``tf.train.Example`` with the integer features
``doc_id`` and ``input_ids``.  A separate Parquet index holds, per record,
file, offset and sizes, so a trainer can read records in any order.

Documents are range partitioned by ``doc_id`` (ties by a hash of the text, so
that one repeated id does not fill a task) and sorted inside each partition;
each task tokenizes its rows and streams them to one file.  File names carry
the task attempt, and the index rows are written by Spark's own committer, so
after a lost executor only the files of committed attempts are named.  Global
token positions need one total per file, added up in file order.

Files go to a folder under ``spark.checkpoint.dir`` through ``pyarrow.fs``
(local mounts, HDFS, object stores).

Defined cases: null text counts as empty and yields a record with the end id
alone; a null ``doc_id`` sorts first and has an empty ``doc_id`` feature;
repeated rows each get a record; an empty table gives no file and no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_folder, text_of
from .vocabulary import split_words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2

INDEX = ("shard int, file string, doc_id long, offset long, length long, n_tokens long")

# ---------------------------------------------------------------- checksums

_POLY = 0x82F63B78  # fixed value: Castagnoli polynomial, reflected
_MASK = 0xA282EAD8  # fixed value: added by the record format's masking
_CHUNK = 512


def _tables() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(_POLY), t >> 1)
    out = [t]
    for _ in range(3):
        out.append((out[-1] >> 8) ^ t[out[-1] & 255])
    return np.stack(out)


_T = _tables()


def _step(crc: np.ndarray) -> np.ndarray:
    """Advance by four zero bytes."""
    return _T[3][crc & 255] ^ _T[2][(crc >> 8) & 255] ^ _T[1][(crc >> 16) & 255] ^ _T[0][crc >> 24]


def _skip_tables() -> np.ndarray:
    """Advance by ``_CHUNK`` zero bytes, as one table for each byte of the state."""
    out = []
    for byte in range(4):
        crc = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
        for _ in range(_CHUNK // 4):
            crc = _step(crc)
        out.append(crc)
    return np.stack(out)


_SKIP = _skip_tables()


def crc32c(records: list[bytes]) -> np.ndarray:
    """CRC-32C of every record (each of at least four bytes).

    The register's start value equals inverting the first four bytes, and with
    a zero register leading zeros do not count: so all records are padded in
    front to whole chunks, all chunks are reduced side by side, and the chunks
    of a record are then joined by the zero-skip operator."""
    if not records:
        return np.empty(0, np.uint32)
    sizes = np.fromiter(map(len, records), np.int64, len(records))
    chunks = -(-sizes // _CHUNK)
    ends = np.cumsum(chunks) * _CHUNK
    flat = np.zeros(ends[-1], np.uint8)
    for r, n, e in zip(records, sizes, ends, strict=True):
        flat[e - n:e] = np.frombuffer(r, np.uint8)
    for i in range(4):
        flat[ends - sizes + i] ^= 255
    words = np.ascontiguousarray(flat.view("<u4").reshape(-1, _CHUNK // 4).T)
    part = np.zeros(words.shape[1], np.uint32)
    for w in words:
        part = _step(part ^ w)
    first, crc = ends // _CHUNK - chunks, np.zeros(len(records), np.uint32)
    for i in range(int(chunks.max())):
        on = np.flatnonzero(chunks > i)
        c = crc[on]
        crc[on] = (_SKIP[0][c & 255] ^ _SKIP[1][(c >> 8) & 255] ^ _SKIP[2][(c >> 16) & 255] ^ _SKIP[3][c >> 24]
                   ^ part[first[on] + i])
    return crc ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK)


# ---------------------------------------------------------------- sequences

def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _feature(name: str, packed: bytes) -> bytes:
    return _field(1, _field(1, name.encode()) + _field(2, _field(3, _field(1, packed))))


def serialize(doc_ids: list[int | None], sequences: list[bytes]) -> list[bytes]:
    """One ``tf.train.Example`` per document, from its ids as packed varints."""
    return [_field(1, _feature("doc_id", b"" if i is None else _varint(i % (1 << 64))) + _feature("input_ids", s))
            for i, s in zip(doc_ids, sequences, strict=True)]


def _fields(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(number, start, end) of the length-delimited fields of a message."""
    def number():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n
    while at < end:
        tag = number()
        if tag & 7 != 2:
            raise ValueError(f"unexpected wire type in field {tag >> 3}")
        size = number()
        yield tag >> 3, at, at + size
        at += size


def count_varints(data: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(data, np.int8) >= 0))


def unpack_varints(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(b < 128)
    size = np.diff(ends, prepend=-1)
    out = b[ends].astype(np.int64)
    for back in range(1, int(size.max(initial=1))):  # a number's earlier bytes, from its last one
        on = np.flatnonzero(size > back)
        out[on] = (out[on] << 7) | (b[ends[on] - back] & 127)
    return out


def deserialize(data: bytes) -> dict[str, np.ndarray]:
    """Integer features of a ``tf.train.Example``."""
    out = {}
    for _, s, e in _fields(data, 0, len(data)):
        for _, s1, e1 in _fields(data, s, e):
            name, packed = "", b""
            for n, s2, e2 in _fields(data, s1, e1):
                if n == 1:
                    name = data[s2:e2].decode()
                else:
                    for _, s3, e3 in _fields(data, s2, e2):
                        for _, s4, e4 in _fields(data, s3, e3):
                            packed = data[s4:e4]
            out[name] = unpack_varints(packed)
    return out


def frame(records: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(r)) for r in records]
    head_crc, data_crc = masked(crc32c(heads)), masked(crc32c(records))
    return [b"".join((h, struct.pack("<I", a), r, struct.pack("<I", b)))
            for h, a, r, b in zip(heads, head_crc.tolist(), records, data_crc.tolist(), strict=True)]


def _checked(frames: list[bytes]) -> list[bytes]:
    """The data of whole frames; raises if a length or checksum is wrong."""
    heads, data = [f[:8] for f in frames], [f[12:-4] for f in frames]
    for h, d in zip(heads, data, strict=True):
        if struct.unpack("<Q", h)[0] != len(d):
            raise ValueError("record length does not match")
    want = np.array([(struct.unpack("<I", f[8:12])[0], struct.unpack("<I", f[-4:])[0]) for f in frames], np.uint32).reshape(-1, 2)
    if (masked(crc32c(heads)) != want[:, 0]).any() or (masked(crc32c(data)) != want[:, 1]).any():
        raise ValueError("checksum does not match")
    return data


# ---------------------------------------------------------------- files

def _open_fs(uri: str):
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def read_file(uri: str, batch_bytes: int = 4 << 20) -> Iterator[list[bytes]]:
    """Checked record data of a file, in order, in batches of bounded size."""
    fs, path = _open_fs(uri)
    with fs.open_input_stream(path, buffer_size=1 << 20) as f:
        frames, size = [], 0
        while head := f.read(12):
            frames.append(head + f.read(struct.unpack("<Q", head[:8])[0] + 4))
            size += len(frames[-1])
            if size >= batch_bytes:
                yield _checked(frames)
                frames, size = [], 0
        if frames:
            yield _checked(frames)


def read_record(uri: str, offset: int, length: int) -> dict[str, np.ndarray]:
    """One record by its index entry (a shuffled read)."""
    fs, path = _open_fs(uri)
    with fs.open_input_file(path) as f:
        return deserialize(_checked([f.read_at(length, offset)])[0])


# ---------------------------------------------------------------- tokenizer

_ENCODERS: dict[str, Encoder] = {}


#: Letters of Latin-1 as the byte-level alphabet of this kind of tokenizer writes their UTF-8: a byte
#: that prints in Latin-1 is itself, the others are 256 and on, in order.
_PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHAR = {b: chr(b) for b in _PRINTS} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(_PRINTS))}
BYTE_CHARS = {c: "".join(_BYTE_CHAR[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class Encoder:
    """The tokenizer, with a memory of the ids of words.

    With this kind of tokenizer file every step (NFC, white-space folding,
    lower-casing, splitting into pieces, merging inside a piece) works inside the
    words between ASCII white space.  Each distinct word, A-Z lower-cased, goes
    through the library: letters of Latin-1, which are one piece as they stand, go straight to
    its merging model, other words through all its steps.  Splitting and joining are Arrow's.  The
    memory is bounded in bytes and starts anew when full; long words are not kept.

    The library takes an added token's literal ("<|endoftext|>") in a text, in just
    this case, as its one id, before any other step.  Texts that hold one go through
    the library whole.  Words are of texts without one, but lower-casing can make
    one ("<|ENDOFTEXT|>"), so for them the library is told to spell it out."""

    #: A stop after a letter or digit begins a piece of its own: it may as well be a word.
    STOP = "([a-z0-9à-öø-ÿ])([,.;:!?])"
    KEEP_BYTES = 96 << 20
    KEEP_WORD = 64
    letters = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")
    ENTRY_BYTES = 200
    CALL = 2000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.literals = [t.content for t in added]
        self.plain = all(t.special and not t.normalized for t in added)  # then a literal counts as it stands in the text
        self.model = self.tokenizer.model
        self.packed = [_varint(i) for i in range(self.tokenizer.get_vocab_size() + 1)]
        self.known: dict[bytes, bytes] = {}
        self.room = self.KEEP_BYTES

    def _pack(self, ids) -> bytes:
        return b"".join(map(self.packed.__getitem__, ids))

    def _encode(self, texts: list[str], spelled: bool) -> Iterator[bytes]:
        """Packed ids of each text; ``spelled``: added tokens' literals are ordinary text."""
        self.tokenizer.encode_special_tokens = spelled
        return (self._pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words."""
        found = list(map(self.known.get, words))
        unknown = [(i, words[i].decode("utf-8", "surrogatepass")) for i, f in enumerate(found) if f is None]
        other = []
        for i, w in unknown:
            if self.letters.fullmatch(w):  # one piece: nothing is left to normalize or to split
                found[i] = self._pack([t.id for t in self.model.tokenize(w.lower().translate(BYTE_CHARS))])
            else:
                other.append((i, w))
        for at in range(0, len(other), self.CALL):
            some = other[at:at + self.CALL]
            for (i, _), ids in zip(some, self._encode([w for _, w in some], True), strict=True):
                found[i] = ids
        for i, _ in unknown:
            size = self.ENTRY_BYTES + len(words[i]) + len(found[i])
            if len(words[i]) <= self.KEEP_WORD:
                if size > self.room:
                    self.known, self.room = {}, self.KEEP_BYTES
                self.known[words[i]], self.room = found[i], self.room - size
        return found

    def _whole(self, texts: pa.Array) -> pa.Array:
        """Which texts go through the library whole."""
        whole = pa.array(np.full(len(texts), not self.plain))
        for literal in self.literals:
            whole = pc.or_(whole, pc.fill_null(pc.match_substring(texts, literal), False))
        return whole

    def encode(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """The ids of each text and the end id, as packed varints."""
        whole = self._whole(texts)
        lowered = pc.ascii_lower(pc.if_else(whole, "", texts))
        flat, counts = split_words(pc.replace_substring_regex(lowered, self.STOP, r"\1 \2"))
        coded, end = flat.dictionary_encode(), _varint(end_id)
        packed = pa.array(self._words(coded.dictionary.cast(pa.binary()).to_pylist()), pa.binary()).take(coded.indices)
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        out = [t + end for t in pc.binary_join(pa.ListArray.from_arrays(ends, packed), b"").to_pylist()]
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            out[i] = next(self._encode([texts[i].as_py() or ""], False)) + end
        return out


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- operators

def write_records(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write every document; returns the index, read back from ``folder``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")

    def write(batches):
        ctx = TaskContext.get()
        uri = f"{folder}/records/part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.tfrecord"
        out, offset = None, 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids = batch.column("doc_id").to_pylist()
                sequences = encoder(tokenizer).encode(batch.column("text"), end_id)
                frames = frame(serialize(ids, sequences))
                if out is None:
                    fs, path = _open_fs(uri)
                    fs.create_dir(os.path.dirname(path), recursive=True)
                    out = fs.open_output_stream(path, buffer_size=1 << 20)
                for f in frames:
                    out.write(f)
                sizes = np.fromiter(map(len, frames), np.int64, len(frames))
                n = len(frames)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(np.full(n, ctx.partitionId()), pa.int32()), "file": [uri] * n, "doc_id": pa.array(ids, pa.int64()),
                    "offset": offset + np.cumsum(sizes) - sizes, "length": sizes, "n_tokens": pa.array(map(count_varints, sequences), pa.int64())})
                offset += int(sizes.sum())
        finally:
            if out is not None:
                out.close()

    rows.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the files read back, one task per file; with ``digest``
    the ids' unsigned crc32 (``ids_crc32``) in place of the ids, which then stay in the task.
    ``start`` counts the ids of all records before it, in file order: one total a file
    is added up in one task."""
    files = index.groupBy("shard", "file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.select("shard", "file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    n = index.agg(F.countDistinct("shard")).first()[0]

    def read(batches):
        for pdf in batches:
            for uri, start in zip(pdf["file"], pdf["base"].tolist(), strict=True):
                for data in read_file(uri):
                    found = [deserialize(d) for d in data]
                    ids = [f["input_ids"] for f in found]
                    size = np.fromiter(map(len, ids), np.int64, len(ids))
                    packed = [i.astype("<u4").tobytes() for i in ids]
                    yield pd.DataFrame({
                        "doc_id": pd.array([int(f["doc_id"][0]) if len(f["doc_id"]) else None for f in found], "Int64"),
                        "start": start + np.cumsum(size) - size, "n_tokens": size,
                        **({"ids_crc32": [zlib.crc32(p) for p in packed]} if digest else {"ids": packed})})
                    start += int(size.sum())

    return files.repartition(max(1, n)).mapInPandas(read, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary"))


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str = TOKENIZER, digest: bool = False) -> DataFrame:
    """Encode, write, read back; ``ids`` as little-endian unsigned 32-bit integers, or their crc32."""
    return read_records(write_records(docs, shared_folder(spark, "records"), tokenizer), digest)


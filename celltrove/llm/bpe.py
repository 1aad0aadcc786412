"""Byte-level BPE encoding and decoding through a sentencepiece model.

The rank file's vocabulary is serialised directly as a sentencepiece BPE model:
each token's bytes are mapped to printable characters, one piece for each token,
scored by its negative rank, with identity normalisation.  Texts are cut by the
pre-token pattern; every distinct pre-token is encoded once and kept in a bounded
cache as raw little-endian ids, so a document is one lookup for each pre-token.
A pre-token that is itself a token is that token, before any merges.

Row-local: no shuffle, memory bounded by the slice size and ``CACHE``.  Null and
empty texts give no ids and empty bytes.  Decoding is the inverse mapping, so it
returns the text's UTF-8 bytes exactly.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cuts, table

#: Entries of the pre-token cache of one worker; when full it starts anew.
CACHE = 200_000
#: Pre-tokens longer than this are encoded without the cache.
CACHED_CHARS = 64


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable in Latin-1, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in rank order; ranks must be 0 to n-1."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    if sorted(found) != list(range(len(found))):
        raise ValueError("ranks are not contiguous")
    return [found[i] for i in range(len(found))]


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """The vocabulary as a serialised sentencepiece ModelProto; an unknown piece follows the tokens."""

    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 0x7F:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        return bytes([*out, n])

    def field(number: int, data: bytes) -> bytes:
        return varint(number << 3 | 2) + varint(len(data)) + data

    def number(number: int, value: int) -> bytes:
        return varint(number << 3) + varint(value & (1 << 64) - 1)

    letters = byte_characters()

    def piece(text: str, score: float, kind: int) -> bytes:
        return field(1, field(1, text.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + number(3, kind))

    body = b"".join(piece("".join(map(letters.__getitem__, t)), -float(i), 1) for i, t in enumerate(tokens))
    body += piece("<unk>", 0.0, 2)
    trainer = number(3, 2) + number(4, len(tokens) + 1) + number(40, len(tokens)) + b"".join(number(i, -1) for i in (41, 42, 43))
    normal = field(1, b"identity") + number(3, 0) + number(4, 0) + number(5, 0)
    return body + field(2, trainer) + field(3, normal)


@functools.lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import regex
    import sentencepiece

    tokens = read_ranks(path)
    model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
    letters = byte_characters()
    whole = {t: struct.pack("<i", i) for i, t in enumerate(tokens)}
    to_letters = {i: c for i, c in enumerate(letters)}

    class Cache(dict):
        def __missing__(self, token: str) -> bytes:
            raw = token.encode()
            ids = whole.get(raw)
            if ids is None:
                ids = np.array(model.encode(raw.decode("latin-1").translate(to_letters), out_type=int), dtype="<i4").tobytes()
            if len(token) <= CACHED_CHARS:
                if len(self) >= CACHE:
                    self.clear()
                self[token] = ids
            return ids

    return regex.compile(pattern).findall, Cache()


@functools.lru_cache(maxsize=2)
def _pieces(path: str) -> pa.Array:
    return pa.array(read_ranks(path), pa.binary())


def _vocabulary(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: array<int>, the token ids of ``text``.  ``path`` is the rank file, present on every worker."""
    path, pattern = _vocabulary(path, pattern)

    @F.arrow_udf("array<int>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split, cache = _encoder(path, pattern)
        for column in columns:
            for start, count in cuts(column):
                yield _encoded(column.slice(start, count), split, cache)

    return docs.withColumn(out, ids(F.col(text)))


def _encoded(texts: pa.Array, split, cache: dict) -> pa.ListArray:
    raw = [b"".join(map(cache.__getitem__, split(t))) if t else b"" for t in texts.to_pylist()]
    ends = np.zeros(len(raw) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in raw], out=ends[1:])
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(raw))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def decode(rows: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: binary, the bytes that ``ids`` stand for; null ids give empty bytes."""
    path, _ = _vocabulary(path, "")

    @F.arrow_udf("binary")
    def back(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(path)
        for column in columns:
            for start in range(0, len(column), 256):
                yield _decoded(column.slice(start, 256), pieces)

    return rows.withColumn(out, back(F.col(ids)))


def _decoded(ids: pa.ListArray, pieces: pa.Array) -> pa.Array:
    counts = np.array([len(x) if x.is_valid else 0 for x in ids], np.int64)
    flat = pieces.take(ids.flatten())
    bounds = np.concatenate([[0], np.cumsum(counts)])
    offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets[bounds].astype(np.int32).tobytes()), flat.buffers()[2] or pa.py_buffer(b"")])


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add what ``encode`` and then ``decode`` add, by one Python function, so that a task has one worker and not two."""
    path, pattern = _vocabulary(path, pattern)

    @F.arrow_udf("ids array<int>, decoded binary")
    def both(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        (split, cache), pieces = _encoder(path, pattern), _pieces(path)
        for column in columns:
            for start, count in cuts(column):
                for at in range(start, start + count, 256):
                    coded = _encoded(column.slice(at, min(256, start + count - at)), split, cache)
                    yield pa.StructArray.from_arrays([coded, _decoded(coded, pieces)], ["ids", "decoded"])

    coded = docs.withColumn("_coded", both(F.col(text)))
    return coded.withColumns({ids: F.col("_coded.ids"), out: F.col("_coded.decoded")}).drop("_coded")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes decoded from them, as digests."""
    coded = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""Hierarchical packing of documents into sequences of several context sizes.

A document is its token ids and an end id.  Whole windows of the longest context are cut off
first; what is left is routed to the shortest tier that holds it.  Tiers are packed from the
longest on: the longest rest opens a window of its tier, and the gap takes the longest rests of
shorter tiers that fit; where none fits exactly the shortest one is cut and its other part goes
back to its own tier.  So every window is full.  The one that a task can't fill is kept for the
next round of packing, and at the task's end it is cut into sequences of powers of two, which need
no padding either: there is none at all, for at most ten short sequences of a task.

Sequences of a round are dealt from the longest to the shortest, back and forth, over its step
groups of about ``STEP`` ids, so groups have as many of each tier, give or take one, and differ by at
most one window.

Row-local in Spark: a task holds ``POOL`` ids and the document at hand, nothing is shuffled,
and a task that runs again gives the same pieces, as long as its input has the same order (a
file scan, a written table).  Numbers of sequences and groups begin with the task's number.

Null and empty texts are the end id alone.  Rows that share an id or repeat whole are documents
of their own (``row`` tells them apart); ids may be null.  A text that spells a special token gets
that token's id, as the tokenizer's defaults have it.  Empty tables give no rows; columns other
than the key and the text are not looked at, so none can clash.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_characters
from .common import slices, table

#: Context sizes, powers of two; the last one is the longest.
TIERS = (256, 512, 1024)
#: Ids that are packed together, and ids of a step group.
POOL, STEP = 1 << 20, 1 << 16
#: Bits of a number below the task's own.
TASK_BITS = 40

#: Runs of white space that a backtracking pattern may not get through.
_RUNS = re.compile(r"\s{1000}").search


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes and ids, if the tokenizer's file is a plain byte-level BPE whose merges come in the order of ids."""
    model, pre, vocabulary = spec["model"], spec.get("pre_tokenizer") or {}, spec["model"].get("vocab", {})
    plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if not plain or spec.get("normalizer") or any(model.get(x) for x in options):
        return None
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if [vocabulary.get(m) for m in merged] != list(range(256, 256 + len(merged))):
        return None
    added = {t["content"] for t in spec.get("added_tokens", ())}
    letters = {c: b for b, c in enumerate(byte_characters())}
    return {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if t not in added}


@functools.lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    """text -> ids as little-endian unsigned 32-bit integers, equal to those of the tokenizers library.

    Its file is read as ranks where it can be, which costs a third of the time; texts with very
    long runs of white space, and files of other kinds, go to the library itself.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def library(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ranks = _ranks(spec)
    if ranks is None:
        return library
    import tiktoken

    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    encode = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special).encode_to_numpy
    return lambda text: library(text) if _RUNS(text) else encode(text, allowed_special="all").astype("<u4", copy=False).tobytes()


class Rests:
    """Rests by length; a piece is (row, key, document's ids, start, length, its ids)."""

    def __init__(self) -> None:
        self.lists: dict[int, list] = {}
        self.lengths = 0  # bit n is set if there is a rest of n ids

    def add(self, piece: tuple) -> None:
        self.lists.setdefault(piece[4], []).append(piece)
        self.lengths |= 1 << piece[4]

    def _take(self, length: int) -> tuple:
        found = self.lists[length]
        piece = found.pop()
        if not found:
            self.lengths &= ~(1 << length)
        return piece

    def longest(self, most: int) -> tuple | None:
        length = (self.lengths & ((2 << most) - 1)).bit_length() - 1
        return self._take(length) if length > 0 else None

    def shortest(self) -> tuple | None:
        return self._take((self.lengths & -self.lengths).bit_length() - 1) if self.lengths else None


def cut(piece: tuple, length: int) -> tuple[tuple, tuple]:
    row, key, total, start, n, ids = piece
    return (row, key, total, start, length, ids[: 4 * length]), (row, key, total, start + length, n - length, ids[4 * length :])


def windows(rests: Rests, tiers: tuple[int, ...] = TIERS) -> tuple[list[list[tuple]], list[tuple]]:
    """Full windows of all rests, and the pieces of the one that could not be filled."""
    done = []
    while (piece := rests.longest(tiers[-1])) is not None:
        size = next(t for t in tiers if piece[4] <= t)
        window, gap = [piece], size - piece[4]
        while gap:
            piece = rests.longest(gap)
            if piece is None:
                piece = rests.shortest()
                if piece is None:
                    return done, window
                piece, other = cut(piece, gap)
                rests.add(other)
            window.append(piece)
            gap -= piece[4]
        done.append(window)
    return done, []


def powers(window: list[tuple]) -> list[list[tuple]]:
    """The pieces of an open window as sequences of powers of two, the longest first."""
    left, done = sum(p[4] for p in window), []
    window = window[::-1]
    while left:
        room = size = 1 << (left.bit_length() - 1)
        done.append([])
        while room:
            piece = window.pop()
            if piece[4] > room:
                piece, other = cut(piece, room)
                window.append(other)
            done[-1].append(piece)
            room -= piece[4]
        left -= size
    return done


def step_groups(sequences: list[list[tuple]], step: int) -> list[int]:
    """A group for each sequence: dealt by falling length, back and forth."""
    lengths = [sum(p[4] for p in s) for s in sequences]
    groups = max(1, round(sum(lengths) / step))
    out = [0] * len(sequences)
    for n, i in enumerate(sorted(range(len(sequences)), key=lambda i: -lengths[i])):
        turn, at = divmod(n, groups)
        out[i] = groups - 1 - at if turn % 2 else at
    return out


_PIECES = "row long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, step_group long, ids array<int>"


def pack(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", end: int = 0, tiers: tuple[int, ...] = TIERS, pool: int = POOL, step: int = STEP) -> DataFrame:
    """Pieces of all documents: key, row, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, step_group, ids.

    ``path`` is the tokenizer's file, present on every worker; ``tiers`` are powers of two, rising.
    """
    import public_tokenizers

    if not tiers or sorted(set(tiers)) != list(tiers) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers have to be rising powers of two")
    path, most, pattern = path or public_tokenizers.path("byte_bpe_50k.json"), tiers[-1], public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = _encoder(path, pattern), struct.pack("<I", end)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << TASK_BITS
        rests, full, held, row, sequence, group = Rests(), [], 0, base, base, base
        kind = None

        def out(sequences: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group
            groups = step_groups(sequences, step)
            size, rows, parts = 0, [], []

            def batch() -> pa.RecordBatch:
                keys, *longs = zip(*rows, strict=True)
                offsets = np.concatenate([[0], np.cumsum(longs[2])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(parts))]))
                names = ["row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group"]
                return pa.record_batch([pa.array(keys, kind), *(pa.array(x, pa.int64()) for x in longs), ids], ["key", *names, "ids"])

            for pieces, g in zip(sequences, groups, strict=True):
                offset, total = 0, sum(p[4] for p in pieces)
                for number, k, tokens, start, length, ids in pieces:
                    rows.append((k, number, start, length, zlib.crc32(ids), tokens, sequence, offset, total, group + g))
                    parts.append(ids)
                    offset += length
                sequence += 1
                size += total
                if size >= POOL:
                    yield batch()
                    size, rows, parts = 0, [], []
            if rows:
                yield batch()
            group += max(groups, default=-1) + 1

        for batch in slices(batches, 1):
            kind = batch.column(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = memoryview((encode(t) if t else b"") + tail)
                n = len(ids) // 4
                for start in range(0, n, most):
                    piece = (row, k, n, start, min(most, n - start), ids[4 * start : 4 * (start + most)])
                    if piece[4] == most:
                        full.append([piece])
                    else:
                        rests.add(piece)
                row, held = row + 1, held + n
                if held >= pool:
                    done, left = windows(rests, tiers)
                    yield from out(full + done)
                    full, held = [], 0
                    for piece in left:
                        rests.add((*piece[:5], bytes(piece[5])))  # lets go of the document
        done, left = windows(rests, tiers)
        yield from out(full + done + powers(left))

    kind = docs.schema[key].dataType.simpleString()
    packed = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, {_PIECES}")
    return packed.withColumnRenamed("key", key)


def sequences(pieces: DataFrame, size: int = TIERS[-1], pad: int = 0) -> DataFrame:
    """(sequence_id, step_group, ids, segments): whole sequences, padded to ``size`` unless of a power of two.

    ``segments`` numbers the pieces of a sequence from 1, 0 is padding.  A group is at most ``size`` ids.
    """
    parts = pieces.groupBy("sequence_id", "step_group").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
    ids = F.flatten(F.transform("_p", lambda p: p["ids"]))
    segments = F.flatten(F.transform("_p", lambda p, i: F.array_repeat(i + 1, F.size(p["ids"]))))
    n = F.size("ids")
    more = F.when(F.bit_count(n) == 1, 0).otherwise(F.lit(size) - n)
    padded = lambda c, x: F.concat(c, F.array_repeat(F.lit(x), more))
    return parts.select("sequence_id", "step_group", ids.alias("ids"), segments.alias("segments")).select("sequence_id", "step_group", padded("ids", pad).alias("ids"), padded("segments", 0).alias("segments"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of at most 1024 ids."""
    pieces = pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group")

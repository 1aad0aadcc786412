"""Cross-entropy difference scoring with matched n-gram models.

The target model (documents labelled as good) and the background model (all documents) are
word bigram models over one shared vocabulary, all V words of the corpus (lower-cased ASCII,
cut at white space) and an end mark.  Both are smoothed alike: the unigram of the corpus is
add-one, P(c) = (n(c) + 1) / (N + V); the background bigram is Dirichlet-smoothed by it,
P(c | b) = (n(bc) + S P(c)) / (n(b) + S), and so is the target's unigram, which smooths the
target's bigram.  A document's score is the mean over its words and its end of target loss
minus background loss, in bits: lower is closer to the target.

Every document is scored by models of all other rows: its own counts are taken out of both
(out of the target's if it is a target document), so no score is in-sample.  A row that is
repeated still finds its copies in the counts.

The counts of all words and bigrams of all documents are a distributed table that grows with
the corpus and is never broadcast or gathered: documents are packed in blocks, a block sends
its distinct grams once to their buckets (ranges of the 64-bit gram hash), which sum them and
answer the blocks.  A common gram has one entry for each block, so no bucket is hot.  Only
three totals reach the driver.

Null, empty and wordless texts have n_tokens 0 and score 0.  A text of any length is in one
block.  Repeated rows count as often as they occur.  A document is target if any label row
of its id has quality 1; a null id is never target.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE_BYTES, slices, table, text_bytes, written
from .minhash import _M1, _Hashes, _mix

#: Target ids are broadcast up to this many; beyond it the join shuffles.
BROADCAST_IDS = 4_000_000
#: Gram entries of a bucket, over all blocks.
BUCKET = 2 << 20
#: Dirichlet strength of the models.
STRENGTH = 4.0


def with_target(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Add target: whether doc_id is among the ids; broadcast only when counted and small."""
    ids = target_ids.select("doc_id").distinct().withColumn("target", F.lit(True))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left")


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as compressed byte planes."""
    return pa.compress(b"".join(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(data, n * sum(widths), codec="zstd", asbytes=True), np.uint8)
    parts = np.split(raw, np.cumsum(widths)[:-1] * n)
    return [np.ascontiguousarray(p.reshape(w, n).T).view(k).ravel() for p, w, k in zip(parts, widths, kinds, strict=True)]


def _word_grams(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct grams of a block, and the place among them of each position's word and bigram."""
    # The stream ends with the end mark, which also stands before its first word.
    pairs = _mix(_mix(np.roll(stream, 1) + _M1) * _M1 + stream)
    values, place = np.unique(np.concatenate([stream, pairs]), return_inverse=True)
    return values, place[: len(stream)], place[len(stream) :]


def word_blocks(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, target, text) packed in blocks of about SLICE_BYTES of text.

    A block's stream is its documents' word hashes, 0 after each document with words; it
    is stored as places in the block's vocabulary.  sizes are the stream's parts by document.
    """
    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", "target")}
    names = [*kinds, "sizes", "block", "n_vocabulary", "vocabulary", "n", "stream", "n_target"]
    schema = ", ".join(f"{c} array<{k}>" for c, k in kinds.items()) + ", sizes array<int>, block binary, n_vocabulary int, vocabulary binary, n int, stream binary, n_target long"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rows, words, sizes, size = _Hashes(), [], [], [], 0

        def out() -> pa.RecordBatch:
            whole = pa.Table.from_batches(rows).combine_chunks()
            vocabulary, place, found = np.unique(np.array(words, np.uint64), return_inverse=True, return_counts=True)
            order = np.lexsort((vocabulary, -np.frexp(found)[1]))  # common words first, for smaller places
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            target = int(np.array(sizes)[np.array(whole["target"].to_pylist(), bool)].sum())
            lists = [pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), whole[c].combine_chunks()) for c in kinds]
            rest = [pa.array([v], t) for v, t in (
                (sizes, pa.list_(pa.int32())), (uuid.uuid4().bytes, pa.binary()), (len(vocabulary), pa.int32()), (_packed(np.diff(vocabulary[order], prepend=np.uint64(0))), pa.binary()),
                (len(words), pa.int32()), (_packed(rank[place]), pa.binary()), (target, pa.int64()),
            )]
            return pa.RecordBatch.from_arrays([*lists, *rest], names)

        for batch in slices(batches, 2):
            rows.append(batch.select([0, 1]))
            for text in text_bytes(batch.column(2)):
                found = [hashes[x] for x in text.lower().split()]
                words += [*found, 0] if found else []
                sizes.append(len(found) + 1 if found else 0)
                size += len(text)
            if size > SLICE_BYTES:
                yield out()
                rows, words, sizes, size = [], [], [], 0
        if rows:
            yield out()

    return docs.select(*kinds, "text").mapInArrow(pack, schema)


def _stream(row: dict) -> np.ndarray:
    vocabulary = np.cumsum(_unpacked(row["vocabulary"], row["n_vocabulary"], np.uint64)[0], dtype=np.uint64)
    return vocabulary[_unpacked(row["stream"], row["n"], np.uint32)[0]]


def _own(place: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How often the document of each position holds the gram at ``place``."""
    key = np.repeat(np.arange(len(sizes)), sizes) * (int(place.max()) + 1) + place
    _, at, counts = np.unique(key, return_inverse=True, return_counts=True)
    return counts[at]


def word_counts(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, n, counts, n_words): for the distinct grams of a block, in order, how often all and target documents hold them.

    n_words are the distinct words of a bucket, with one of its rows.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if not row["n"]:
                    continue
                values, word, pair = _word_grams(_stream(row))
                place, target = np.concatenate([word, pair]), np.repeat(np.array(row["target"], bool), row["sizes"])
                n_all = np.bincount(place).astype(np.uint32)
                n_target = np.bincount(place, np.concatenate([target, target])).astype(np.uint32)
                is_word = np.zeros(len(values), np.uint8)
                is_word[word] = 1
                bucket = (values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                at = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
                some = np.flatnonzero(at[1:] > at[:-1])
                sent = [_packed(np.diff(values[l:h], prepend=np.uint64(0)), n_all[l:h], n_target[l:h], is_word[l:h]) for l, h in zip(at[some], at[some + 1], strict=True)]
                yield pa.record_batch({"bucket": pa.array(some, pa.int32()), "block": pa.array([row["block"]] * len(some), pa.binary()), "n": pa.array((at[1:] - at[:-1])[some], pa.int32()), "grams": pa.array(sent, pa.binary())})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out() -> pa.RecordBatch:
            parts = [_unpacked(g, n, np.uint64, np.uint32, np.uint32, np.uint8) for _, n, g in held]
            place = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)[1]
            sums = [np.bincount(place, np.concatenate([p[k] for p in parts])).astype(np.uint64)[place] for k in (1, 2)]
            n_words = len(np.unique(place[np.concatenate([p[3] for p in parts]) > 0]))
            ends = np.cumsum([n for _, n, _ in held])
            counts = [_packed(*(s[e - n : e] for s in sums)) for e, (_, n, _) in zip(ends, held, strict=True)]
            words = [n_words, *[0] * (len(held) - 1)]
            return pa.record_batch({"block": pa.array([h[0] for h in held], pa.binary()), "bucket": pa.array([key] * len(held), pa.int32()), "n": pa.array([h[1] for h in held], pa.int32()), "counts": pa.array(counts, pa.binary()), "n_words": pa.array(words, pa.int64())})

        for batch in batches:
            for bucket, block, n, g in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held and bucket != key:
                    yield out()
                    held = []
                key = bucket
                held.append((block, n, g))
        if held:
            yield out()

    sent = blocks.select("block", "target", "sizes", "n_vocabulary", "vocabulary", "n", "stream").mapInArrow(send, "bucket int, block binary, n int, grams binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, "block binary, bucket int, n int, counts binary, n_words long")


def score(docs: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """(doc_id, n_tokens, score) of rows (doc_id, target boolean, text)."""
    blocks = written(word_blocks(docs.select("doc_id", F.coalesce("target", F.lit(False)).alias("target"), "text")), "word-blocks")
    totals = blocks.agg(F.sum("n"), F.sum("n_target")).first()
    every, target = (int(x or 0) for x in totals)
    counts = written(word_counts(blocks, max(1, -(-2 * every // BUCKET))), "word-counts")
    words = int(counts.agg(F.sum("n_words")).first()[0] or 0)
    answers = counts.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "counts"))).alias("answers"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("target", "sizes", "n_vocabulary", "vocabulary", "n", "stream", "answers")}
                sizes, loss = np.array(row["sizes"], np.int64), np.zeros(row["n"])
                if row["n"]:
                    _, word, pair = _word_grams(_stream(row))
                    found = [_unpacked(a["counts"], a["n"], np.uint64, np.uint64) for a in row["answers"]]
                    n_all, n_target = (np.concatenate([f[k] for f in found]).astype(np.float64) for k in (0, 1))
                    good = np.repeat(np.array(row["target"], bool), sizes)
                    own_word, own_pair, own_size = _own(word, sizes), _own(pair, sizes), np.repeat(sizes, sizes)
                    # Of all other rows: the word, the pair, and the word before, which is an end mark at a document's start.
                    w, p, (tw, tp) = n_all[word] - own_word, n_all[pair] - own_pair, (n_target[x] - own * good for x, own in ((word, own_word), (pair, own_pair)))
                    base = (w + 1) / (every - own_size + words)
                    near = (tw + strength * base) / (target - own_size * good + strength)
                    background = (p + strength * base) / (np.roll(w, 1) + strength)
                    before = np.roll(n_target[word], 1) - np.roll(own_word, 1) * good
                    loss = np.log2(background) - np.log2((tp + strength * near) / (before + strength))
                upto, ends = np.concatenate([[0.0], np.cumsum(loss)]), np.cumsum(sizes)
                mean = (upto[ends] - upto[ends - sizes]) / np.maximum(sizes, 1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 1).flatten(), pa.array(np.maximum(sizes - 1, 0)), pa.array(mean)], ["doc_id", "n_tokens", "score"])

    return blocks.drop("n_target").join(answers, "block", "left").mapInArrow(run, f"doc_id {kind}, n_tokens long, score double")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored between documents of quality 1 and the whole corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = with_target(docs, table(spark, sf_dir, "labels").filter("quality = 1"))
    return score(docs).withColumn("score", F.round("score", 6))

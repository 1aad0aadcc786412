"""Removal of repeated byte strings, by suffix sorting in buckets.

Every byte covered by a LENGTH-byte string that also starts elsewhere goes.  All suffixes
of a corpus cannot be brought together, so they are bucketed by content: each window of
LENGTH bytes belongs to its least GRAM-byte hash (its anchor), hence equal windows share
a bucket.  Consecutive windows of one anchor form a span, the unit that is shuffled: a
pair of hashes and a place, about one for every 85 bytes of text.

* Anchors that occur once are done.  The other spans' bytes are cut from their texts, and
  equal spans are grouped by those bytes, combined map-side: copies cost one row, and a span
  that occurs twice is repeated throughout.
* Where an anchor has different spans, all their windows are ordered by deep-shallow
  suffix sorting (``suffix``), and neighbours that agree in LENGTH bytes are repeated.
* An anchor with more than BUCKET windows, or more than MOST_BYTES in its spans (the rim of a
  very common passage has spans of one window with all its bytes), is split by content before it is sorted: its spans are cut into spans of the least hashes of longer
  grams (FINER), which are grouped and sorted in the same way.  The last grams are whole
  windows, of which equal ones are one row, so no bucket grows with the copies of a passage.

Marks return to all spans by an equi-join, and texts meet their runs once more.  Matches
never cross documents; overlaps count; strings are judged on the input.  Null and empty
texts are empty and keep nothing; long texts are hashed in pieces of PIECE windows.  Rows
are the documents: repeated rows are repeats of each other.  Documents are keyed by
(doc_id, text hash).  Two different spans of one anchor and one hash raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import suffix
from .common import cuts, drop, ship, slices, table, text_bytes, written

LENGTH, GRAM = 200, 32
#: Shares of LENGTH - GRAM that the grams of a finer level are longer by; the last makes them whole windows.
FINER = (0.4, 0.75, 1.0)
#: Most windows of an anchor that are sorted together, of a span, and of a span of a finer level.
BUCKET, SPAN, FINE_SPAN = 65_536, 4096, 64
#: Windows of a text that are hashed at a time.
PIECE = 1 << 20
#: Bytes of representatives from which a worker sorts what it holds, and most bytes of an anchor that are sorted together.
SORT_BYTES, MOST_BYTES = 1 << 20, 4 << 20
_BASE, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A mixed polynomial hash of the ``size`` bytes from each position."""
    part, width = data.astype(np.uint64) + np.uint64(1), 1
    whole, done, power = None, 0, _BASE
    with np.errstate(over="ignore"):
        while True:
            if size & width:
                if whole is None:
                    whole = part.copy()
                else:
                    n = len(data) - done - width + 1
                    whole = whole[:n] * power + part[done : done + n]
                done += width
            if 2 * width > size:
                break
            n = len(part) - width
            part = part[:n] * power + part[width:]
            power *= power
            width *= 2
        whole = whole[: len(data) - size + 1]
        whole = (whole ^ (whole >> np.uint64(31))) * _M1
        return (whole ^ (whole >> np.uint64(29))) * _M2


def sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) of the ``width`` values from each position."""
    done = 1
    while 2 * done <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def find_spans(texts: list[bytes], length: int, gram: int, most: int = SPAN) -> tuple:
    """(document, start, windows, anchor, hash, several) of each span; start is a byte of its text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = b"".join(texts)
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    number = np.maximum(sizes - length + 1, 0)
    if not number.sum():
        return (np.zeros(0, np.int64),) * 6
    width = length - gram + 1
    h = gram_hashes(np.frombuffer(data, np.uint8), gram)
    least = sliding(h, width, np.minimum)
    doc = np.repeat(np.arange(len(texts)), number)
    at = np.arange(int(number.sum())) + np.repeat(base - (np.cumsum(number) - number), number)
    m = least[at]
    new = np.concatenate([[True], (m[1:] != m[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    # Long runs (periodic text) are cut into spans of at most ``most`` windows.
    run = np.diff(np.concatenate([first, [len(at)]]))
    pieces = -(-run // most)
    first = np.repeat(first, pieces) + most * (np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    n = np.diff(np.concatenate([first, [len(at)]]))
    start, anchor = at[first], m[first]
    # Anchors that occur more than once in a span: only selected positions can be anchors.
    selected = np.flatnonzero(sliding(np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), width, np.maximum)[: len(h)] == h)
    lo, hi = np.searchsorted(selected, start), np.searchsorted(selected, start + n + width - 1)
    which = np.repeat(np.arange(len(first)), hi - lo)
    inside = selected[np.arange(len(which)) + np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo)]
    several = np.bincount(which[h[inside] == anchor[which]], minlength=len(first)) > 1
    view = memoryview(data)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(view[a:b]) for a, b in zip(start.tolist(), (start + n + length - 1).tolist(), strict=True)], np.uint64)
    return doc[first], start - base[doc[first]], n, anchor.view(np.int64), hashes.view(np.int64), several


def spans_of(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, text_hash, start, n, anchor, span, several) of every span of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 1 << 20):
            # Long texts in pieces that overlap by a window less a byte: each window is in one piece.
            pieces = [(i, a, t[a : a + PIECE + length - 1]) for i, t in enumerate(text_bytes(batch.column(2))) for a in range(0, len(t) - length + 1, PIECE)]
            piece, start, n, anchor, span, several = find_spans([x[2] for x in pieces], length, gram)
            if len(piece):
                doc = pa.array(np.array([x[0] for x in pieces])[piece])
                start = start + np.array([x[1] for x in pieces])[piece]
                yield pa.record_batch({
                    "doc_id": batch.column(0).take(doc), "text_hash": batch.column(1).take(doc), "start": pa.array(start), "n": pa.array(n.astype(np.int32)),
                    "anchor": pa.array(anchor), "span": pa.array(span), "several": pa.array(several.astype(bool)),
                })

    kind = docs.schema["doc_id"].dataType.simpleString()
    long_enough = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").filter(F.octet_length("text") >= length)
    return long_enough.mapInArrow(run, f"doc_id {kind}, text_hash long, start long, n int, anchor long, span long, several boolean")


def _bytes_of(docs: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """(anchor, span, n, several, data) of every span, cut from its text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, 1 << 18):
            for text, pieces in zip(text_bytes(batch.column(0)), batch.column(1), strict=True):
                row = pieces.values
                start, n = row.field("start").to_numpy(), row.field("n").to_numpy()
                # Spans of a long text are cut in bounded parts.
                upto = np.cumsum(n + (length - 1))
                at = 0
                while at < len(n):
                    stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + (1 << 20), side="right")))
                    data = [text[a:z] for a, z in zip(start[at:stop].tolist(), (start[at:stop] + n[at:stop] + length - 1).tolist(), strict=True)]
                    part = row.slice(at, stop - at)
                    yield pa.RecordBatch.from_arrays([*(part.field(c) for c in ("anchor", "span", "n", "several")), pa.array(data, pa.binary())], ["anchor", "span", "n", "several", "data"])
                    at = stop

    per_doc = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("anchor", "span", "start", "n", "several")).alias("pieces"))
    joined = _met(docs, per_doc, "inner").select("text", "pieces")
    return joined.mapInArrow(cut, "anchor long, span long, n int, several boolean, data binary")


def _met(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    right = per_doc.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    return docs.withColumn("_text_hash", F.xxhash64("text")).join(right, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), how)


def _windows(batch: list[tuple[int, int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joined bytes, position of every window, and the row each belongs to."""
    n = np.array([r[2] for r in batch], np.int64)
    base = np.concatenate([[0], np.cumsum([len(r[3]) for r in batch])[:-1]])
    row = np.repeat(np.arange(len(batch)), n)
    at = np.arange(int(n.sum())) + np.repeat(base - (np.cumsum(n) - n), n)
    return np.frombuffer(b"".join(r[3] for r in batch), np.uint8), at, row


def _runs(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [{"o": int(a), "k": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


_RUNS = pa.list_(pa.struct([("o", pa.int32()), ("k", pa.int32())]))
_MARKS = "anchor long, span long, runs array<struct<o: int, k: int>>"


def _sorted_marks(parts: DataFrame, length: int) -> DataFrame:
    """(anchor, span, runs): windows found repeated by suffix sorting the spans (anchor, span, n, data) of each anchor."""

    def marks(rows: list) -> pa.RecordBatch:
        data, at, row = _windows(rows)
        anchors = np.array([r[0] for r in rows], np.int64)
        group = np.cumsum(np.concatenate([[0], anchors[1:] != anchors[:-1]]))
        hit = suffix.repeated(suffix.characters(data), at, group[row], length)
        ends = np.cumsum([r[2] for r in rows])
        out = [(r[0], r[1], runs) for r, e in zip(rows, ends.tolist(), strict=True) if (runs := _runs(hit[e - r[2] : e]))]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), _RUNS))], ["anchor", "span", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held and r[0] != held[-1][0] and size >= SORT_BYTES:
                    yield marks(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[3])
        if held:
            yield marks(held)

    dealt = parts.select("anchor", "span", "n", "data").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, _MARKS)


def _cut_finer(parts: DataFrame, length: int, gram: int) -> DataFrame:
    """(outer_anchor, outer_span, at, anchor, span, n, several, data): the spans of longer grams within the spans of ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 1 << 16):
            texts = batch.column(2).to_pylist()
            outer, start, n, anchor, span, several = find_spans(texts, length, gram, FINE_SPAN)
            data = [texts[i][a : a + k + length - 1] for i, a, k in zip(outer.tolist(), start.tolist(), n.tolist(), strict=True)]
            yield pa.record_batch({
                "outer_anchor": batch.column(0).take(pa.array(outer)), "outer_span": batch.column(1).take(pa.array(outer)), "at": pa.array(start.astype(np.int32)),
                "anchor": pa.array(anchor), "span": pa.array(span), "n": pa.array(n.astype(np.int32)), "several": pa.array(several.astype(bool)), "data": pa.array(data, pa.binary()),
            })

    return parts.select("anchor", "span", "data").mapInArrow(run, "outer_anchor long, outer_span long, at int, anchor long, span long, n int, several boolean, data binary")


def _grouped(spans: DataFrame) -> DataFrame:
    """(anchor, span, n, several, c, data): equal spans as one row, told by their bytes; written."""
    reps = written(spans.groupBy("anchor", "span", "n", "several", "data").agg(F.count(F.lit(1)).alias("c")), "representatives")
    if reps.groupBy("anchor", "span").count().filter("count > 1").limit(1).count():
        raise ValueError("two different spans share an anchor and a hash")
    return reps


def _marks(reps: DataFrame, length: int, grams: list[int], bucket: int, made: list[DataFrame]) -> DataFrame:
    """(anchor, span, runs): the repeated windows of every span of ``reps``, as ``_grouped`` gives them; ``made`` gains the tables it reads."""
    made.append(reps)
    anchors = reps.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.max("several").alias("several"), F.sum("n").alias("windows"), F.sum(F.col("n") + (length - 1)).alias("bytes"))
    large = F.lit(False) if not grams else (F.col("windows") > bucket) | (F.col("bytes") > MOST_BYTES)
    anchors = anchors.filter("k > 1 OR several").select("anchor", large.alias("large"))
    found = _sorted_marks(reps.join(anchors.filter("NOT large"), "anchor"), length)
    if grams and anchors.filter("large").limit(1).count():
        finer = written(_cut_finer(reps.join(anchors.filter("large"), "anchor"), length, grams[0]), "finer")
        made.append(finer)
        deeper = _marks(_grouped(finer.select("anchor", "span", "n", "several", "data")), length, grams[1:], bucket, made)
        # A run at k of a finer span at ``at`` is one at at + k of the span around it.
        moved = F.transform("runs", lambda r: F.struct((F.col("at") + r["o"]).alias("o"), r["k"].alias("k")))
        back = finer.select("outer_anchor", "outer_span", "at", "anchor", "span").join(deeper, ["anchor", "span"])
        back = back.groupBy("outer_anchor", "outer_span").agg(F.flatten(F.collect_list(moved)).alias("runs"))
        found = found.unionByName(back.withColumnsRenamed({"outer_anchor": "anchor", "outer_span": "span"}))
    whole = reps.filter("c > 1").select("anchor", "span", F.array(F.struct(F.lit(0).alias("o"), F.col("n").alias("k"))).alias("runs"))
    return whole.unionByName(found.join(whole.select("anchor", "span"), ["anchor", "span"], "left_anti"))


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, text_hash, runs array<struct<at, upto>>): byte ranges under repeated strings, not yet merged."""
    ship(docs.sparkSession)
    every = written(spans_of(docs, length, gram), "spans")
    anchors = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.max("several").alias("several"))
    spans = written(every.join(anchors.filter("c > 1 OR several").select("anchor"), "anchor"), "repeated-spans")
    drop(every)
    made: list[DataFrame] = []
    finer = [gram + int(f * (length - gram)) for f in FINER]
    marks = _marks(_grouped(_bytes_of(docs, spans, length)), length, [g for g in finer if g > gram], bucket, made)
    hit = spans.select("doc_id", "text_hash", "start", "anchor", "span").join(marks, ["anchor", "span"])
    ranges = F.transform("runs", lambda r: F.struct((F.col("start") + r["o"]).alias("at"), (F.col("start") + r["o"] + r["k"] + (length - 1)).alias("upto")))
    per_doc = hit.select("doc_id", "text_hash", ranges.alias("runs")).groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_set("runs")).alias("runs"))
    per_doc = written(per_doc, "runs")
    drop(spans, *made)
    return per_doc


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET, out: str = "repeats") -> DataFrame:
    """Add ``out``: struct<kept binary, spans array<struct<start, stop>>>, the remaining bytes and the maximal removed runs."""

    @F.arrow_udf("kept binary, spans array<struct<start: long, stop: long>>")
    def cut(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
        for texts, runs in columns:
            for start, count in cuts(texts):
                done = []
                for text, ranges in zip(text_bytes(texts.slice(start, count)), runs.slice(start, count).to_pylist(), strict=True):
                    merged: list[list[int]] = []
                    for at, upto in sorted((r["at"], r["upto"]) for r in ranges or ()):
                        if merged and at <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], upto)
                        else:
                            merged.append([at, upto])
                    edges = [0, *(e for m in merged for e in m), len(text)]
                    done.append({"kept": b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), "spans": [{"start": a, "stop": b} for a, b in merged]})
                yield pa.array(done, kind)

    columns = [c for c in docs.columns if c != out]
    joined = _met(docs, repeated_runs(docs.select("doc_id", "text"), length, gram, bucket), "left")
    return joined.withColumn(out, cut("text", "runs")).select(*columns, out)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings removed from every document."""
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return done.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("repeats.kept")).alias("n_removed"), F.size("repeats.spans").cast("long").alias("n_spans"), F.sha2("repeats.kept", 256).alias("kept_sha256"))


ORACLE = f"""
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, i, md5(b[i:i + {LENGTH - 1}]) AS h FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - {LENGTH - 2})) AS i FROM t)),
d AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
e AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {LENGTH} THEN 0 ELSE 1 END AS f FROM d),
g AS (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM e),
r AS (SELECT doc_id, island, min(i) AS lo, max(i) + {LENGTH - 1} AS hi FROM g GROUP BY ALL),
z AS (SELECT doc_id, count(*) AS n, sum(hi - lo + 1) AS gone FROM r GROUP BY doc_id),
k AS (SELECT doc_id, lo, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) + 1 AS a, lo - 1 AS z FROM (SELECT doc_id, lo, hi FROM r UNION ALL SELECT doc_id, octet_length(b) + 1, octet_length(b) FROM t)),
x AS (SELECT doc_id, string_agg(hex(b[k.a:k.z]), '' ORDER BY lo) AS kept FROM k JOIN t USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, octet_length(b) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(x.kept)) AS kept_sha256
FROM t JOIN x USING (doc_id) LEFT JOIN z USING (doc_id)
"""

"""Hard-negative mining by blocked dense products.

Anchors are dealt into blocks and all rows into shards, each one row holding its ids,
labels and packed matrix in the narrowest integer type.  Anchor blocks are broadcast while
their counted bytes are at most ``BROADCAST``; beyond that they are dealt into parts and a
shard meets each part through an equi-join.  A block meets a shard as one float64 product
(exact below 2^53; larger values go through 64-bit or Python integers, and beyond 64 bits a score saturates).

* First pass: the k greatest scores among other rows of the anchor's label; a tile keeps k
  rows of an anchor, and tile lists merge within groups of shards, then across groups.
* Second pass: the anchors carry their positives, each of which opens a window from
  low/100 of its score to the score itself; a tile keeps k rows of another label for each window,
  merged in the same way.

Work is anchors x rows, the stated job; no pair leaves a tile but as one of k, and a task
holds a block, a shard and one score tile.  Rows with a null id, label or vector, or with null or
non-finite components, take no part; vectors of different length never meet.  Equal scores
go to the smaller id.  Anchors and candidates are rows: rows that repeat an id or a whole row are
candidates of their own and have lists of their own, and an anchor leaves out itself alone.
An anchor without other rows of its label, or with empty windows (those of negative scores always
are), gives no rows.  Empty tables give no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written
from .topk import _product, numbered, quantise

#: Anchors of a block, rows of a shard, and most bytes of anchor blocks that are broadcast.
BLOCK, SHARD, BROADCAST = 512, 2048, 32 << 20
#: Scan tasks whose lists meet in the first level of the merge.
FAN_IN = 16

_SIDE = "dim int, kind string, ids binary, numbers binary, labels binary, bars binary, data binary"
_LONGS = ("ids", "numbers", "labels", "bars")


def labelled(vectors: DataFrame, label: str = "label", scale: int = 256) -> DataFrame:
    """(vec_id, label, q) of the rows that take part."""
    named = vectors.select(F.col("vec_id"), F.col("embedding"), F.col(label).cast("long").alias("label")).filter("label IS NOT NULL")
    return quantise(named, scale, also=("label",))


def _narrow(q: np.ndarray) -> str:
    low, high = int(q.min(initial=0)), int(q.max(initial=0))
    return next(k for k in ("<i2", "<i4", "<i8") if k == "<i8" or (np.iinfo(k).min <= low and high <= np.iinfo(k).max))


def _packed(rows: DataFrame, size: int, bars: str | None = None) -> DataFrame:
    """Tile sides of at most ``size`` vectors of one length; ``bars`` are an anchor's (positive id, score) pairs, flat."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, numbers, labels, marks, vectors = zip(*held.pop(dim), strict=True)
            data = np.array(vectors, np.int64).reshape(len(ids), dim)
            kind = _narrow(data)
            flat = [x for m in marks for x in (len(m) // 2, *m)]
            longs = [np.array(x, "<i8").tobytes() for x in (ids, numbers, labels, flat)]
            row = {"dim": [dim], "kind": [kind], **{k: [v] for k, v in zip(_LONGS, longs, strict=True)}, "data": [data.astype(kind).tobytes()]}
            return pa.record_batch({k: pa.array(v, pa.int32() if k == "dim" else pa.string() if k == "kind" else pa.binary()) for k, v in row.items()})

        for batch in batches:
            ids, numbers, labels, marks = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
            for i, n, label, m, q in zip(ids, numbers, labels, marks, batch.column(3), strict=True):
                v = q.values.to_numpy(zero_copy_only=False)
                held.setdefault(len(v), []).append((i, n, label, m, v))
                if len(held[len(v)]) >= size:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)

    marks = F.col(bars) if bars else F.array().cast("array<bigint>")
    return rows.select("vec_id", "row", "label", "q", marks.alias("bars")).mapInArrow(pack, _SIDE)


def _tiles(anchors: DataFrame, shards: DataFrame) -> DataFrame:
    """Each anchor block beside each shard of its dimension."""
    blocks = anchors.withColumnsRenamed({c: f"a_{c}" for c in ("kind", *_LONGS, "data")})
    size = blocks.agg(F.sum(F.octet_length("a_data") + F.octet_length("a_ids") * 3 + F.octet_length("a_bars"))).first()[0] or 0
    parts = -(-int(size) // BROADCAST)
    if parts <= 1:
        return shards.join(F.broadcast(blocks), "dim")
    blocks = blocks.withColumn("part", F.pmod(F.xxhash64("a_numbers"), F.lit(parts)))
    met = shards.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))).join(blocks, ["dim", "part"]).drop("part")
    return met.repartition(max(1, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _best(score: np.ndarray, ids: np.ndarray, keep: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``keep`` the k of greatest score, ties to the smaller id."""
    s = score[keep]
    if len(s) > k:  # partial selection; ties at the border stay until the sort
        near = s >= np.partition(s, len(s) - k)[len(s) - k]
        keep, s = keep[near], s[near]
    return keep[np.lexsort((ids[keep], ~s))[:k]]  # ~s falls as s rises, without overflow


def _sides(row: dict) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    a, c = ([np.frombuffer(row[f"{p}{x}"], "<i8") for x in _LONGS] for p in ("a_", ""))
    q, v = (np.frombuffer(row[f"{p}data"], row[f"{p}kind"]).reshape(-1, row["dim"]) if row["dim"] else np.zeros((len(s[0]), 0), np.int64) for p, s in (("a_", a), ("", c)))
    return a, c, _product(q.astype(np.int64), v.astype(np.int64))


def _positive_tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                (_, number, label, _), (ids, own, labels, _), score = _sides(row)
                found = [_best(score[r], ids, np.flatnonzero((labels == label[r]) & (own != number[r])), k) for r in range(len(number))]
                at, to = np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate([np.zeros(0, int), *found])
                columns = {"number": number[at], "vec_id": ids[to], "score": score[at, to], "shard_group": np.full(len(at), row["shard_group"])}
                yield pa.record_batch({c: pa.array(x, pa.int64()) for c, x in columns.items()})

    return run


def _negative_tiles(k: int, low: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                (anchor, number, label, bars), (ids, _, labels, _), score = _sides(row)
                out, at = [], 0
                for r in range(len(number)):
                    pairs = bars[at + 1 : at + 1 + 2 * bars[at]].reshape(-1, 2)
                    at += 1 + 2 * int(bars[at])
                    other = labels != label[r]
                    for place, (positive, top) in enumerate(pairs.tolist()):
                        least = -(-low * top // 100)
                        if least > top:
                            continue
                        to = _best(score[r], ids, np.flatnonzero(other & (score[r] >= least) & (score[r] <= top)), k)
                        out.append(np.column_stack([np.broadcast_to([number[r], anchor[r], place, positive, top], (len(to), 5)), ids[to], score[r, to], np.full(len(to), row["shard_group"])]))
                flat = np.concatenate([np.zeros((0, 8), np.int64), *out])
                yield pa.record_batch({c: pa.array(np.ascontiguousarray(flat[:, i]), pa.int64()) for i, c in enumerate(_NEGATIVES)})

    return run


_NEGATIVES = ("number", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score", "shard_group")


def _merged(found: DataFrame, key: list[str], score: str, ident: str, k: int) -> DataFrame:
    """Rank the k best rows of each key: first within groups of shards, then across them."""
    by = (F.desc(score), F.asc(ident))
    near = found.withColumn("_n", F.row_number().over(Window.partitionBy(*key, "shard_group").orderBy(*by))).filter(F.col("_n") <= k)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*by))).filter(F.col("rank") <= k).drop("_n", "shard_group")


def mine(anchors: DataFrame, rows: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of anchor rows against ``rows``.

    Both sides are (vec_id, label, q, row) with row numbers as ``topk.numbered`` gives them.  A window
    is low * positive_score <= 100 * negative_score <= 100 * positive_score.
    """
    shards = _packed(rows, SHARD).withColumn("shard_group", F.floor(F.spark_partition_id() / FAN_IN).cast("long"))
    shards = written(shards, "shards")
    first = _tiles(written(_packed(anchors, BLOCK), "anchor-blocks"), shards)
    found = first.mapInArrow(_positive_tiles(positives), "number long, vec_id long, score long, shard_group long")
    best = _merged(found, ["number"], "score", "vec_id", positives)
    # An anchor has at most ``positives`` of them, so its list is bounded.
    lists = best.groupBy("number").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))), lambda p: F.array(p["vec_id"], p["score"]))).alias("bars"))
    armed = anchors.join(lists.withColumnRenamed("number", "row"), "row")
    second = _tiles(written(_packed(armed, BLOCK, "bars"), "armed-blocks"), shards)
    hard = second.mapInArrow(_negative_tiles(negatives, low), ", ".join(f"{c} long" for c in _NEGATIVES))
    ranked = _merged(hard, ["number", "place"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives below each of five positives, for anchors whose vec_id is divisible by 100."""
    rows = labelled(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = numbered(rows.withColumn("label", moved))
    return mine(rows.filter(F.col("vec_id") % 100 == 0), rows)


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT a.n AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda t: t[1] * t[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.n <> b.n AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
  FROM p WHERE same QUALIFY place <= 5)
SELECT pos.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY pos.anchor, place ORDER BY p.score DESC, p.vec_id) AS INTEGER) AS rank,
       p.vec_id AS negative_id, positive_score, p.score AS negative_score
FROM pos JOIN p ON pos.anchor = p.anchor AND NOT p.same AND 80 * positive_score <= 100 * p.score AND p.score <= positive_score
QUALIFY row_number() OVER (PARTITION BY pos.anchor, place ORDER BY p.score DESC, p.vec_id) <= 5
"""

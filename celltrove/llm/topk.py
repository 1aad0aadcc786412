"""Exact top-k search by tiled integer products.

Candidates are dealt into shards and queries into blocks, each one row holding its
ids and its packed matrix.  A block meets every shard once through an equi-join on
(dimension, part), so a tile is one matrix product of bounded size; partial
selection keeps k rows of a query for each tile, and the per-tile lists are merged
in a tree: first within groups of shards, then across groups.

Work is queries x candidates, the stated job; no pair of rows leaves a tile.  Memory
of a task is one block, one shard and one score tile.  Vectors that are null, or hold
null or non-finite components, and rows without an id take no part; vectors of different length never meet.
Equal scores go to the smaller id.  Queries and candidates are rows: rows that repeat an id
or a whole row are separate candidates and have a list each, from which only the row itself
is left out.  Empty tables give no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: Rows of a query block and of a candidate shard.
BLOCK, SHARD = 512, 2048
#: Scan tasks whose lists meet in the first level of the merge tree.
FAN_IN = 16


def quantise(vectors: DataFrame, scale: int = 256, vec: str = "embedding", key: str = "vec_id", also: tuple[str, ...] = ()) -> DataFrame:
    """(vec_id, ``also``, q array<long>): floor(scale * x) in double arithmetic; rows that take no part are dropped."""
    x = F.col(vec).cast("array<double>")
    whole = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.filter(whole & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), *also, F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("q"))


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``row``, a number of its own for each row; written, so that every reader sees the same numbers."""
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """One row for each tile side: (dim, ids, numbers, data), at most ``size`` vectors in a part."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int):
            ids, numbers, data = zip(*held.pop(dim), strict=True)
            columns = [pa.array([dim], pa.int32()), *(pa.array([np.array(x, "<i8").tobytes()], pa.binary()) for x in (ids, numbers)), pa.array([b"".join(data)], pa.binary())]
            return pa.record_batch(columns, ["dim", "ids", "numbers", "data"])

        for batch in batches:
            for i, n, q in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                v = q.values.to_numpy(zero_copy_only=False).astype("<i8")
                held.setdefault(len(v), []).append((i, n, v.tobytes()))
                if len(held[len(v)]) >= size:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)

    return rows.select("vec_id", "row", "q").mapInArrow(pack, "dim int, ids binary, numbers binary, data binary")


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T; beyond 64 bits the score saturates."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2.0**62:
        return a @ b.T
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, -(2**63), 2**63 - 1).astype(np.int64)


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qi, qn, ci, cn = (np.frombuffer(row[x], "<i8") for x in ("q_ids", "q_numbers", "ids", "numbers"))
                q, c = (np.frombuffer(row[x], "<i8").reshape(len(i), row["dim"]) for x, i in (("q_data", qi), ("data", ci)))
                score = _product(q, c)
                at, vec, val = [], [], []
                for r in range(len(qi)):
                    keep = np.flatnonzero(cn != qn[r])
                    s = score[r, keep]
                    if len(s) > k:  # partial selection; ties at the border stay until the sort
                        border = np.partition(s, len(s) - k)[len(s) - k]
                        near = np.flatnonzero(s >= border)
                        keep, s = keep[near], s[near]
                    best = np.lexsort((ci[keep], -s.astype(object) if len(s) and s.min() == -(2**63) else -s))[:k]
                    at.append(np.full(len(best), r))
                    vec.append(ci[keep][best])
                    val.append(s[best])
                if at:
                    at = np.concatenate(at)
                    yield pa.record_batch({
                        "number": pa.array(qn[at], pa.int64()), "query_id": pa.array(qi[at], pa.int64()), "vec_id": pa.array(np.concatenate(vec), pa.int64()),
                        "score": pa.array(np.concatenate(val), pa.int64()), "shard_group": pa.array(np.full(len(at), row["shard_group"]), pa.int64()),
                    })

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query row, both sides (vec_id, q, row) as ``numbered`` gives them.

    A candidate of a query's own number is left out; numbers of other query sets have to be negative.
    """
    spark = candidates.sparkSession
    # Written once: the number of blocks and the blocks themselves have to agree.
    blocks = _packed(queries, block).withColumnsRenamed({"ids": "q_ids", "numbers": "q_numbers", "data": "q_data"})
    blocks = written(blocks, "query-blocks")
    counts = blocks.groupBy("dim").agg(F.count(F.lit(1)).alias("blocks"))
    number = F.pmod(F.xxhash64("q_numbers"), F.col("blocks"))
    blocks = blocks.join(counts, "dim").withColumn("part", number).drop("blocks")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shards = _packed(candidates, shard).withColumn("shard_group", F.floor(F.spark_partition_id() / FAN_IN).cast("long"))
    tiles = (
        shards.join(counts, "dim")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .drop("blocks")
        .join(blocks, ["dim", "part"])
        .repartition(parts)
    )
    columns = ("dim", "q_ids", "q_numbers", "q_data", "ids", "numbers", "data", "shard_group")
    found = tiles.select(*columns).mapInArrow(_tiles(k), "number long, query_id long, vec_id long, score long, shard_group long")
    by = (F.desc("score"), F.asc("vec_id"))
    near = found.withColumn("n", F.row_number().over(Window.partitionBy("number", "shard_group").orderBy(*by))).filter(F.col("n") <= k)
    last = near.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*by))).filter(F.col("rank") <= k)
    return last.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best partners of every row whose vec_id is divisible by 50."""
    rows = numbered(quantise(table(spark, sf_dir, "embeddings")))
    return top_k(rows.filter(F.col("vec_id") % 50 == 0), rows, 5)


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.n, a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda t: t[1] * t[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.n <> b.n AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) <= 5
"""

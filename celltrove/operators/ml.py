"""Scaling, PCA, k-means with elbow, fusion, neighbours and label propagation."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import drop, written
from .neighbours import usable

SEED = 42


def as_vectors(df: DataFrame, vec: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(vec).cast("array<double>")))


def standardise(df: DataFrame, column: str = "features", out: str = "scaled") -> DataFrame:
    """Zero mean and unit population deviation; the library uses the sample deviation, so it is corrected by its factor."""
    n = df.count()
    model = StandardScaler(withMean=True, withStd=True, inputCol=column, outputCol="_s").fit(df)
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    return model.transform(df).withColumn(out, array_to_vector(F.transform(vector_to_array("_s"), lambda x: x * factor))).drop("_s")


def pca(df: DataFrame, k: int, column: str = "features", out: str = "pcs"):
    model = PCA(k=k, inputCol=column, outputCol=out).fit(df)
    return model.transform(df), [float(x) for x in model.explainedVariance]


def components_for(df: DataFrame, share: float = 0.95, column: str = "features") -> int:
    """Least number of components that explain ``share``."""
    size = len(df.select(vector_to_array(column).alias("v")).first()["v"])
    total, shares = 0.0, pca(df, size, column)[1]
    for i, s in enumerate(shares):
        total += s
        if total >= share - 1e-12:
            return i + 1
    return size


def pca_share(df: DataFrame, share: float = 0.95, column: str = "features", out: str = "pcs"):
    """Standardise, find the number of components for ``share``, and fit again with it."""
    scaled = standardise(df, column)
    n = components_for(scaled, share, "scaled")
    return pca(scaled, n, "scaled", out)[0], n


def inertia_one(df: DataFrame, column: str = "features") -> float:
    """Sum of squares around the mean: the inertia of one cluster, which the library does not fit."""
    row = df.select(Summarizer.metrics("variance", "count").summary(df[column]).alias("s")).select("s.*").first()
    return float(sum(row["variance"])) * (row["count"] - 1)


def elbow(values: list[float]) -> int:
    """Number of clusters (from 1) farthest below the line from first to last."""
    n, top, low = len(values), max(values), min(values)
    if top == low:
        return 1
    gaps = [1 - i / (n - 1) - (v - low) / (top - low) for i, v in enumerate(values)]
    return gaps.index(max(gaps)) + 1


def kmeans_elbow(df: DataFrame, most: int = 10, column: str = "features", out: str = "cluster"):
    """(rows with cluster, inertia of k = 1..most, chosen k)."""
    inertia, models = [inertia_one(df, column)], {}
    for k in range(2, most + 1):
        models[k] = KMeans(k=k, seed=SEED, featuresCol=column, predictionCol=out).fit(df)
        inertia.append(float(models[k].summary.trainingCost))
    k = elbow(inertia)
    return (models[k].transform(df) if k > 1 else df.withColumn(out, F.lit(0))), inertia, k


def mfa(df: DataFrame, blocks: list[str], sizes: list[int], final: int, out: str = "pcs") -> DataFrame:
    """Late fusion: components of each block divided by the root of their greatest variance, joined, and reduced again."""
    names = []
    for i, (block, k) in enumerate(zip(blocks, sizes, strict=True)):
        df, _ = pca(df, k, block, f"_pc{i}")
        variance = df.select(Summarizer.variance(df[f"_pc{i}"]).alias("v")).first()["v"]
        root = math.sqrt(max(float(x) for x in variance)) or 1.0
        df = df.withColumn(f"_b{i}", F.transform(vector_to_array(f"_pc{i}"), lambda x: x / root))  # noqa: B023
        names.append(f"_b{i}")
    joined = df.withColumn("fused", F.concat(*names)).withColumn("_f", array_to_vector("fused"))
    done, _ = pca(joined, final, "_f", out)
    return done.drop("_f", *names, *[f"_pc{i}" for i in range(len(blocks))])


#: Vectors of a block at most, rows of a block that are multiplied at a time, and blocks of queries that a task keeps the best of.
BLOCK, ROWS, OPEN = 8192, 512, 16


def knn(df: DataFrame, k: int, key: str, vec: str, block: int | None = None) -> DataFrame:
    """(key, rank, neighbour, score): exact k greatest inner products (6 digits), ties to the smaller id.

    Rows are dealt into blocks of one length: two for each core, of at most BLOCK vectors (or of about ``block``).  Every block of
    queries meets every block of candidates through an equi-join and matrix products of ROWS rows.  A task keeps
    the best k of its block of queries while the candidates pass, and sends on those alone.  What is
    shuffled is the rows times the blocks.  Rows that repeat an id have a list each, and leave out
    themselves alone; null ids, null vectors and those with components that are no numbers take no part.
    """
    rows = usable(df, key, vec)
    n = rows.count()
    block = block or max(256, min(BLOCK, -(-n // (2 * df.sparkSession.sparkContext.defaultParallelism))))
    blocks = max(1, -(-n // block))
    dealt = rows.groupBy(F.size("v").alias("d"), F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("b")).agg(F.collect_list(F.struct("row", "id", "v")).alias("rows"))
    # Read twice, and candidates go to every block of queries.
    dealt = written(dealt, "blocks")
    drop(rows)
    queries = dealt.select("d", F.col("b").alias("q"), F.col("rows").alias("qs"))
    candidates = dealt.select("d", F.col("b").alias("c"), F.col("rows").alias("cs"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("q"))
    names = ("row", "id", "other", "neighbour", "score")

    def sides(entry: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        numbers, ids = (entry.values.field(c).to_numpy() for c in ("row", "id"))
        flat = entry.values.field("v").flatten().to_numpy(zero_copy_only=False)
        return numbers, ids, flat.reshape(len(ids), len(flat) // len(ids))

    def best(i: np.ndarray, found: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """The first k of each query's (i) candidates: their other, id and score."""
        to, ids, score = found
        order = np.lexsort((to, ids, -score, i))
        i = i[order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        return i[first], *(x[order][first] for x in (to, ids, score))

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[tuple, list] = {}

        def done(qn: np.ndarray, qi: np.ndarray, q: np.ndarray, held: tuple, bars: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch(dict(zip(names, map(pa.array, (qn[held[0]], qi[held[0]], *held[1:])), strict=True)))

        for batch in batches:
            for d, number, a, b in zip(*batch.columns, strict=True):
                at = d.as_py(), number.as_py()
                if at not in open_:
                    if len(open_) >= OPEN:
                        yield done(*open_.pop(next(iter(open_))))
                    qn, qi, q = sides(a)
                    open_[at] = [qn, qi, q, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), np.full(len(qn), -np.inf)]
                qn, qi, q, held, bars = open_[at]
                cn, ci, c = sides(b)
                more = [held]
                for start in range(0, len(q), ROWS):
                    score = q[start : start + ROWS] @ c.T
                    low = bars[start : start + ROWS].copy()
                    new = np.isneginf(low)
                    if new.any() and len(ci) > k + 1:
                        # Of the k + 1 greatest one may be the row itself.
                        low[new] = np.partition(score[new], -k - 1, axis=1)[:, -k - 1]
                    # A margin for what rounding to 6 digits moves.
                    i, j = np.nonzero(score >= low[:, None] - 2e-6)
                    keep = qn[start + i] != cn[j]
                    i, j = i[keep], j[keep]
                    value = np.round(score[i, j], 6)
                    keep = np.isfinite(value)
                    more.append(best(start + i[keep], [cn[j[keep]], ci[j[keep]], value[keep]]))
                joined = [np.concatenate(x) for x in zip(*more, strict=True)]
                held = open_[at][3] = best(joined[0], joined[1:])
                ends = np.flatnonzero(np.append(held[0][1:] != held[0][:-1], True)) if len(held[0]) else np.zeros(0, np.int64)
                full = ends[np.bincount(held[0], minlength=len(qn))[held[0][ends]] >= k]
                bars[held[0][full]] = held[3][full]
        for one in open_.values():
            yield done(*one)

    # Hashed by block, not sorted and not sent to the driver: rows are as long as a block.
    near = candidates.join(queries.hint("shuffle_hash"), ["d", "q"]).select("d", "q", "qs", "cs").mapInArrow(tiles, "row long, id long, other long, neighbour long, score double")
    # Where a block of queries was dealt to several tasks, each has sent its best.
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc("neighbour"), F.asc("other")))).filter(F.col("rank") <= k)
    return ranked.select(F.col("id").alias(key), "rank", "neighbour", "score")


def label_propagation(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, community): each node takes its neighbours' most frequent label, ties to the smaller, until none changes; a stand-in for modularity clustering.

    Of two neighbours that want to change in a round only the one of the greater hash may.
    So the nodes that change together are not neighbours, and every change makes more edges
    of one label, or as many and a smaller label: labels cannot oscillate, and the end is reached.
    """
    both = written(reduce(DataFrame.unionByName, [edges.select(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in ((a, b), (b, a))]).filter("u <> v").distinct(), "edges")
    labels = written(both.select(F.col("u").alias("node")).distinct().withColumn("community", F.col("node")), "labels")
    while True:
        seen = both.join(labels, both["v"] == labels["node"]).groupBy("u", "community").agg(F.count(F.lit(1)).alias("_n"))
        best = seen.groupBy("u").agg(F.min(F.struct((-F.col("_n")).alias("_n"), "community")).alias("_b"))
        own = labels.withColumnsRenamed({"node": "u", "community": "_own"})
        new = best.join(own, "u").select("u", F.col("_b.community").alias("_new"), "_own", (F.col("_b.community") != F.col("_own")).alias("_wants"))
        # The best label is the own one unless that is rarer, or as frequent and greater.
        new = written(new, "wishes")
        want = new.filter("_wants").select("u", F.xxhash64("u").alias("_h"))
        if not want.limit(1).count():
            drop(both, new)
            return labels
        theirs = both.join(want.select(F.col("u").alias("v"), F.struct("_h", F.col("u").alias("_k")).alias("_other")), "v").groupBy("u").agg(F.max("_other").alias("_most"))
        may = want.join(theirs, "u", "left").filter(F.col("_most").isNull() | (F.struct("_h", F.col("u").alias("_k")) > F.col("_most"))).select("u", F.lit(True).alias("_may"))
        last, labels = labels, written(new.join(may, "u", "left").select(F.col("u").alias("node"), F.when(F.col("_may"), F.col("_new")).otherwise(F.col("_own")).alias("community")), "labels")
        drop(new, last)

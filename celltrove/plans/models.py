"""Model queries; without SQL but for the exact neighbours."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import communities, layout, ml, neighbours
from ..operators.relational import union_all
from ..scratch import drop, written
from ..sources.readers import table


def _features(spark, d):
    return ml.as_vectors(table(spark, d, "embeddings", ["vec_id", "embedding", "label"]), "embedding")


def pca_n95(spark, d):
    rows, n = ml.pca_share(_features(spark, d))
    return rows.select("vec_id", F.lit(n).alias("n_components"), F.transform(vector_to_array("pcs"), lambda x: F.round(F.abs(x), 4)).alias("places"))


def kmeans_elbow(spark, d):
    rows, inertia, k = ml.kmeans_elbow(_features(spark, d), 10)
    return rows.select("vec_id", "cluster", F.lit(k).alias("k"), F.round(F.lit(dict(enumerate(inertia, 1)).get(k)), 4).alias("inertia"))


def _near(spark, d, k):
    e = table(spark, d, "embeddings", ["vec_id", "embedding"])
    whole = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000))
    near = ml.knn(e.withColumn("embedding", whole), k, "vec_id", "embedding")
    return near.select("vec_id", "rank", "neighbour", F.col("score").cast("bigint").alias("score"))


def knn_topk(spark, d):
    return _near(spark, d, 10)


def knn_graph(spark, d):
    """About the ten nearest rows of every row."""
    near = neighbours.neighbour_graph(table(spark, d, "embeddings", ["vec_id", "embedding"]), 10, "vec_id", "embedding")
    return near.select("vec_id", "rank", "neighbour", F.round("distance", 6).alias("distance"))


def fuzzy_union(spark, d):
    """Both directions of the exact graph as one weight, with memberships 1 / rank."""
    near = knn_topk(spark, d).withColumn("m", 1.0 / F.col("rank"))
    return neighbours.fuzzy_union(near, "vec_id", "neighbour", "m").withColumn("weight", F.round("weight", 9))


def fuzzy_weights(spark, d):
    """Weights of the approximate graph with fitted bandwidths."""
    near = neighbours.neighbour_graph(table(spark, d, "embeddings", ["vec_id", "embedding"]), 10, "vec_id", "embedding")
    return neighbours.fuzzy_weights(near, "vec_id").withColumn("weight", F.round("weight", 6))


RESOLUTIONS = (0.2, 0.4, 0.6, 0.8)


def modularity_clusters(spark, d):
    """Components, 20 neighbours, fuzzy weights, and clusters at four resolutions."""
    pcs, _ = ml.pca(_features(spark, d), 16)
    near = neighbours.neighbour_graph(pcs.withColumn("pcs", vector_to_array("pcs")), 20, "vec_id", "pcs")
    weights = written(neighbours.fuzzy_weights(near, "vec_id"), "weights")
    found = communities.modularity_clusters(weights, "vec_id", "neighbour", "weight", RESOLUTIONS)
    drop(weights)
    names = [f"res_{r}".replace(".", "_") for r in RESOLUTIONS]
    return communities.cluster_columns(found, names).withColumnRenamed("node", "vec_id")


def graph_layout(spark, d):
    """Places in the plane by the fuzzy weights of the neighbour graph."""
    near = neighbours.neighbour_graph(table(spark, d, "embeddings", ["vec_id", "embedding"]), 10, "vec_id", "embedding")
    weights = written(neighbours.fuzzy_weights(near, "vec_id"), "weights")
    placed = layout.layout(weights, "vec_id", "neighbour", "weight")
    drop(weights)
    return placed.select(F.col("node").alias("vec_id"), F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def graph_modularity(spark, d):
    """Modularity of the labels on the exact neighbour graph, at each resolution."""
    # Written, so that the resolutions do not each find the neighbours again.
    graph = written(communities.undirected(knn_topk(spark, d), "vec_id", "neighbour"), "graph")
    labels = table(spark, d, "embeddings", ["vec_id", "label"])
    each = [communities.modularity(graph, labels, "vec_id", "label", r).select(F.lit(r).alias("resolution"), F.round("modularity", 9).alias("modularity")) for r in RESOLUTIONS]
    return union_all(*each)


def mfa_fusion(spark, d):
    e = table(spark, d, "embeddings", ["vec_id", "embedding"])
    a, b = (e.select("vec_id", F.slice("embedding", s, 32).alias("v")) for s in (1, 33))
    both = ml.as_vectors(a, "v", "nuclei").select("vec_id", "nuclei").join(ml.as_vectors(b, "v", "cells").select("vec_id", "cells"), "vec_id")
    fused = ml.mfa(both, ["nuclei", "cells"], [8, 8], 6)
    return fused.select("vec_id", F.size("fused").alias("n_fused"), F.transform(vector_to_array("pcs"), lambda x: F.round(F.abs(x), 4)).alias("places"))


def label_propagation(spark, d):
    near = knn_topk(spark, d)
    return ml.label_propagation(near, "vec_id", "neighbour")


NAMES = "pca_n95 kmeans_elbow knn_topk knn_graph fuzzy_union fuzzy_weights modularity_clusters graph_modularity graph_layout mfa_fusion label_propagation".split()
QUERIES = {n: globals()[n] for n in NAMES}
_KNN = "WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)) AS v FROM embeddings), p AS (SELECT a.vec_id, b.vec_id AS neighbour, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda t: t[1] * t[2])) AS BIGINT) AS score FROM q a JOIN q b ON a.vec_id <> b.vec_id) SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, neighbour) AS INTEGER) AS rank, neighbour, score FROM p QUALIFY rank <= 10"
_EDGES = f"g AS MATERIALIZED ({_KNN}), h AS (SELECT vec_id AS u, neighbour AS v FROM g UNION ALL SELECT neighbour, vec_id FROM g)"
SQL = {
    "knn_topk": _KNN,
    "fuzzy_union": f"WITH g AS MATERIALIZED ({_KNN}), s AS (SELECT least(vec_id, neighbour) AS a, greatest(vec_id, neighbour) AS b, max(CASE WHEN vec_id < neighbour THEN 1e0 / rank END) AS p, max(CASE WHEN vec_id > neighbour THEN 1e0 / rank END) AS q FROM g GROUP BY ALL) SELECT a AS vec_id, b AS neighbour, round(coalesce(p, 0) + coalesce(q, 0) - coalesce(p, 0) * coalesce(q, 0), 9) AS weight FROM s",
    "graph_modularity": f"WITH {_EDGES}, c AS (SELECT x.label AS c, count(*) AS k, count(*) FILTER (x.label = y.label) AS e FROM h JOIN embeddings x ON x.vec_id = u JOIN embeddings y ON y.vec_id = v GROUP BY 1), t AS (SELECT sum(k) AS m, sum(e) AS e, sum(k * k) AS kk FROM c) SELECT CAST(r AS DOUBLE) AS resolution, round(e / CAST(m AS DOUBLE) - CAST(r AS DOUBLE) * kk / (CAST(m AS DOUBLE) * m), 9) AS modularity FROM t, unnest([0.2, 0.4, 0.6, 0.8]) AS x(r)",
}

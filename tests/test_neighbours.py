"""The approximate neighbour graph against all pairs, and its weights against their definition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from celltrove.operators import ml
from celltrove.operators import neighbours as N
from celltrove.plans import models

SCHEMA = "vec_id long, embedding array<float>"


def exact(ids, x, k):
    d = np.sqrt(np.maximum(np.square(x[:, None, :] - x[None, :, :]).sum(axis=2), 0))
    np.fill_diagonal(d, np.inf)
    return {int(ids[i]): [int(ids[j]) for j in np.lexsort((ids, d[i]))[:k]] for i in range(len(ids))}


def lists(graph):
    out = {}
    for r in graph.collect():
        out.setdefault(r.vec_id, {})[r.rank] = (r.neighbour, r.distance)
    return {i: [v[n] for n in sorted(v)] for i, v in out.items()}


@pytest.mark.parametrize("n, spread", [(1500, 1.0), (1200, 6.0)])
def test_recall_over_all_rows(spark, n, spread):
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((8, 24)) * spread)[rng.integers(0, 8, n)] + rng.standard_normal((n, 24))
    x = x.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    got, want = lists(N.neighbour_graph(df, 10, "vec_id", "embedding", leaf=64)), exact(np.arange(n), x, 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    recall = sum(len({a for a, _ in got[i]} & set(want[i])) for i in want) / (10 * n)
    assert recall >= 0.9, recall
    for i in range(0, n, 97):
        assert [a for a, _ in got[i]] != [] and all(b == pytest.approx(np.linalg.norm(x[i] - x[a])) for a, b in got[i])
        assert [b for _, b in got[i]] == sorted(b for _, b in got[i])


def test_recall_against_the_exact_query(spark):
    """Embeddings of length one have the same order by product and by distance."""
    sf = "/root/testdata/sf0.01"
    want = {}
    for r in models.knn_topk(spark, sf).collect():
        want.setdefault(r.vec_id, set()).add(r.neighbour)
    got = lists(models.knn_graph(spark, sf))
    assert set(got) == set(want)
    assert sum(len({a for a, _ in got[i]} & want[i]) for i in want) / sum(map(len, want.values())) >= 0.9


def test_copies_bad_rows_and_lengths(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(7, [1.0, 2.0]), (7, [5.0, 5.0]), (None, [1.0, 2.0]), (900, None), (901, [1.0, None]), (902, [float("nan"), 1.0]), (903, [1.0]), (904, [2.0]), (905, []), (906, [])]
    got = lists(N.neighbour_graph(spark.createDataFrame(rows, SCHEMA), 3, "vec_id", "embedding", leaf=16))
    assert set(got) == set(range(300)) | {903, 904, 905, 906}
    assert got[903] == [(904, 1.0)] and got[904] == [(903, 1.0)] and got[905] == [(906, 0.0)]
    assert all(d == 0.0 for i in range(300) if i != 7 for _, d in got[i]) and all(a != i for i, v in got.items() if i != 7 for a, _ in v)
    assert N.neighbour_graph(spark.createDataFrame([], SCHEMA), 3, "vec_id", "embedding").count() == 0


def test_leaves_are_bounded_whatever_repeats(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(2000)]
    leaves = N._leaves(N.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding"), 3, 100, 1)
    sizes = [r["count"] for r in leaves.groupBy("tree", "node").count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == 6000


def test_exact_lists_of_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (None, [9.0, 9.0]), (3, None)]
    got = sorted(map(tuple, ml.knn(spark.createDataFrame(rows, SCHEMA), 5, "vec_id", "embedding").collect()))
    assert got == [(1, 1, 2, 1.0), (1, 1, 2, 1.0), (1, 2, 1, 0.0), (1, 2, 1, 0.0), (2, 1, 1, 1.0), (2, 2, 1, 1.0)]


def test_bandwidths_and_union(spark):
    rng = np.random.default_rng(6)
    graph = [(i, j, float(d)) for i in range(12) for j, d in zip((j for j in range(12) if j != i), np.sort(rng.random(11)) + 0.2)]
    graph += [(50, j, 0.0) for j in range(5)]
    df = spark.createDataFrame(graph, "vec_id long, neighbour long, distance double")
    member = {}
    for r in df.groupBy("vec_id").agg(F.array_sort(F.collect_list("distance")).alias("d")).withColumn("w", N.bandwidth(F.col("d"))).collect():
        if r.vec_id == 50:
            assert r.w.rho == 0.0
            continue
        assert r.w.rho == min(r.d)
        assert sum(math.exp(-max(0.0, d - r.w.rho) / r.w.sigma) for d in r.d) == pytest.approx(math.log2(len(r.d)), abs=1e-4)
        member |= {(r.vec_id, j): math.exp(-max(0.0, d - r.w.rho) / r.w.sigma) for i, j, d in graph if i == r.vec_id}
    got = {(r.vec_id, r.neighbour): r.weight for r in N.fuzzy_weights(df, "vec_id").collect()}
    for (a, b), w in got.items():
        if max(a, b) < 50:
            p, q = member.get((a, b), 0.0), member.get((b, a), 0.0)
            assert a < b and w == pytest.approx(p + q - p * q)
    assert {a for a, b in got if b == 50} == set(range(5)) and all(got[a, 50] == 1.0 for a in range(5))


def test_bandwidth_sums_once_a_step(spark):
    df = spark.createDataFrame([([0.5, 1.0, 2.0, 4.0],)], "d array<double>").select(N.bandwidth(F.col("d")).alias("w"))
    assert df._jdf.queryExecution().analyzed().toString().lower().count("exp(") == 1
    w = df.first().w
    assert w.rho == 0.5 and abs(1 + sum(math.exp(-(d - 0.5) / w.sigma) for d in (1.0, 2.0, 4.0)) - 2) < 1e-9

"""Scaling, components, clusters and fusion against dense algebra."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from celltrove.operators import ml
from celltrove.operators import neighbours as N


def table(spark, n=90, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 3)) @ rng.standard_normal((3, 7)) * 2 + rng.standard_normal((n, 7)) * 0.4 + 5
    return x, ml.as_vectors(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i long, v array<double>"), "v")


def column(df, name):
    return np.array([r.x for r in df.select("i", vector_to_array(name).alias("x")).orderBy("i").collect()])


def principal(x):
    c = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    return vt, s**2 / (s**2).sum()


def test_unit_population_deviation(spark):
    x, df = table(spark)
    assert column(ml.standardise(df), "scaled") == pytest.approx((x - x.mean(axis=0)) / x.std(axis=0))


def test_components_for_a_share(spark):
    x, df = table(spark)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    vt, shares = principal(z)
    rows, n = ml.pca_share(df)
    assert n == int(np.searchsorted(np.cumsum(shares), 0.95 - 1e-12) + 1)
    # The library does not centre scores; scaled rows are centred already.
    assert np.abs(column(rows, "pcs")) == pytest.approx(np.abs(z @ vt[:n].T), abs=1e-6)


def test_inertia_by_number_of_clusters(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.standard_normal((40, 2)) * 0.1 + c for c in ((0, 0), (9, 0), (0, 9))])
    df = ml.as_vectors(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i long, v array<double>"), "v")
    rows, inertia, k = ml.kmeans_elbow(df, 6)
    assert k == 3 and inertia[0] == pytest.approx(np.square(x - x.mean(axis=0)).sum())
    owner = np.array([r.cluster for r in rows.orderBy("i").collect()])
    assert inertia[2] == pytest.approx(sum(np.square(x[owner == c] - x[owner == c].mean(axis=0)).sum() for c in range(3)))
    assert len(set(owner[:40])) == len(set(owner[40:80])) == len(set(owner[80:])) == 1


def test_fusion_gives_blocks_the_same_weight(spark):
    (a, da), (b, db) = table(spark, seed=3), table(spark, seed=4)
    both = da.select("i", da["features"].alias("a")).join(db.select("i", db["features"].alias("b")), "i")
    fused = ml.mfa(both, ["a", "b"], [3, 2], 4)
    parts = []
    for x, k in ((a, 3), (b, 2)):
        vt, _ = principal(x)
        s = x @ vt[:k].T
        parts.append(s / np.sqrt(s.var(axis=0, ddof=1).max()))
    want = np.concatenate(parts, axis=1)
    got = np.array([r.fused for r in fused.orderBy("i").collect()])
    assert np.abs(got) == pytest.approx(np.abs(want), abs=1e-6)
    assert got.var(axis=0, ddof=1)[[0, 3]] == pytest.approx([1.0, 1.0])
    vt, _ = principal(got)
    assert np.abs(column(fused, "pcs")) == pytest.approx(np.abs(got @ vt[:4].T), abs=1e-6)


def test_too_many_neighbours_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(N, "MOST_NEIGHBOURS", 3)
    df = spark.createDataFrame([(1, j, 1.0) for j in range(2, 7)], "vec_id long, neighbour long, distance double")
    with pytest.raises(ValueError, match="more than 3"):
        N.fuzzy_weights(df, "vec_id")


def test_exact_neighbours_of_many_blocks_send_only_their_best(spark, monkeypatch):
    rng = np.random.default_rng(8)
    v = rng.integers(-3, 4, (90, 3)).astype(float)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    want = [(i, r + 1, j, float(v[i] @ v[j])) for i in range(90) for r, j in enumerate(sorted((j for j in range(90) if j != i), key=lambda j: (-(v[i] @ v[j]), j))[:4])]
    for most in (16, 1):
        monkeypatch.setattr(ml, "OPEN", most)
        assert sorted(map(tuple, ml.knn(df, 4, "id", "v", block=10).collect())) == want
    plan = ml.knn(df, 4, "id", "v", block=10)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastExchange" not in plan

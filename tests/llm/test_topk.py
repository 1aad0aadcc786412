import math

import numpy as np
from pyspark.sql import functions as F

from celltrove.llm import topk


def brute(rows, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(good):
        if q % 50 == 0:
            found = [(-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(good) if a != b and len(v) == len(w)]
            out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(sorted(found)[:k])]
    return sorted(out)


def run(spark, save, rows):
    got = topk.op3_topk(spark, save(embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")))
    return sorted(map(tuple, got.collect()))


def test_ties_bad_vectors_and_small_tiles(spark, save, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 2)
    monkeypatch.setattr(topk, "SHARD", 7)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 3) / 4], 0) for i in range(0, 300)]
    rows += [(350, None, 0), (400, [1.0, None, 0.0], 0), (450, [float("nan"), 1.0, 1.0], 1), (500, [float("inf"), 1.0, 1.0], 1), (550, [1.0], 1), (600, [], 1)]
    rows += [(700, [0.5, 0.25, -0.5], 0)] * 2 + [(750, [1.0, 0.0, 0.0], 0), (750, [0.0, 1.0, 0.0], 0), (None, [9.0, 9.0, 9.0], 0)]
    assert run(spark, save, rows) == brute([r[:2] for r in rows])


def test_repeated_query_ids_have_a_list_each(spark, save):
    rows = [(50, [1.0, 0.0], 0), (50, [0.0, 1.0], 0), (1, [1.0, 0.5], 0), (2, [0.25, 1.0], 0)]
    got = run(spark, save, rows)
    assert got == brute([r[:2] for r in rows]) and len(got) == 6


def test_clashing_columns(spark, save):
    df = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [3.0, 4.0], 0)], "vec_id long, embedding array<float>, label int")
    for c in ("q", "row", "score", "dim", "part", "rank", "query_id"):
        df = df.withColumn(c, F.lit("x"))
    assert [tuple(r) for r in topk.op3_topk(spark, save(embeddings=df)).collect()] == [(0, 1, 1, 256 * 256 * 11)]


def test_large_components_stay_exact(spark, save):
    rows = [(0, [2.0**24, 3.0], 0), (1, [2.0**20, 1.0], 0), (2, [2.0**20, 2.0], 0), (50, [-1.0, 1.0], 0)]
    assert run(spark, save, rows) == brute([r[:2] for r in rows])


def test_empty_and_alone(spark, save):
    assert run(spark, save, [(50, [1.0], 0)]) == []
    assert run(spark, save, []) == []

import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from celltrove.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, (anchor, v, label) in enumerate(good):
        if anchor % 100:
            continue
        met = [(-sum(x * y for x, y in zip(v, w)), j, other) for b, (j, w, other) in enumerate(good) if a != b and len(v) == len(w)]
        for s, positive, _ in sorted(m for m in met if m[2] == label)[:5]:
            window = sorted((t, j) for t, j, other in met if other != label and 80 * -s <= 100 * -t <= 100 * -s)
            out += [(anchor, positive, n + 1, j, -s, -t) for n, (t, j) in enumerate(window[:5])]
    return sorted(out)


def run(spark, save, rows):
    return sorted(map(tuple, negatives.op11_negatives(spark, save(embeddings=spark.createDataFrame(rows, SCHEMA))).collect()))


def awkward():
    rng = np.random.default_rng(11)
    rows = [(int(i), [float(x) for x in rng.integers(-1, 4, 4) / 4], int(i) % 3) for i in range(400)]
    rows += [(500, [1.0, 1.0, 0.5, 0.5], None), (600, None, 1), (700, [1.0, None, 0.0, 0.0], 1), (800, [float("nan"), 1.0, 1.0, 1.0], 1), (900, [float("-inf"), 1.0, 1.0, 1.0], 1)]
    rows += [(None, [3.0] * 4, 1), (1000, [1.0], 1), (1001, [1.0], 1), (1002, [0.9], 2), (1100, [], 1), (1101, [], 1), (1102, [], 2)]
    rows += [(1200, [1.0, 0.5, 0.25, 0.0], 2)] * 2 + [(1200, [0.5, 0.5, 0.5, 0.5], 1), (1300, [-1.0, -1.0, -1.0, -1.0], 9), (-100, [0.75] * 4, 0), (-7, [0.5] * 4, 9)]
    return rows


def test_brute_force_with_ties_repeats_and_bad_rows(spark, save, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 3)
    monkeypatch.setattr(negatives, "SHARD", 37)
    rows = awkward()
    got = run(spark, save, rows)
    assert got == brute(rows) and len(got) > 50


def test_parts_beyond_the_broadcast_bound(spark, save, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 2)
    monkeypatch.setattr(negatives, "BROADCAST", 150)
    rows = awkward()
    assert run(spark, save, rows) == brute(rows)


def test_large_scores_stay_exact(spark, save):
    rows = [(0, [2.0**20, 3.0], 1), (100, [2.0**20, 1.0], 2), (3, [2.0**20, 4.0], 1), (5, [2.0**20, 2.0], 5), (6, [2.0**20, 5.0], 5)]
    rows += [(200, [2.0**9, 0.25], 5), (202, [2.0**9, 0.5], 5), (203, [2.0**9, 0.25], 4)]
    got = run(spark, save, rows)
    assert got == brute(rows) and got


def test_sql_says_the_same(spark, save):
    rows = [(r, v, y) for r, v, y in awkward() if not v or len(v) == 4]
    path = save(embeddings=spark.createDataFrame(rows, SCHEMA))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/embeddings.parquet/*.parquet')")
    assert sorted(map(tuple, con.execute(negatives.ORACLE).fetchall())) == brute(rows)


def test_clashing_columns(spark, save):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.5], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("q", "row", "score", "dim", "part", "rank", "anchor_id", "number", "bars", "kind", "ids"):
        df = df.withColumn(c, F.lit("x"))
    got = [tuple(r) for r in negatives.op11_negatives(spark, save(embeddings=df)).collect()]
    assert sorted(got) == brute(rows)


def test_empty_and_alone(spark, save):
    assert run(spark, save, []) == []


def test_an_anchor_without_partners(spark, save):
    assert run(spark, save, [(100, [1.0], 1), (101, [1.0], 2)]) == []

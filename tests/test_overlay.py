"""Cutting and repairing of polygons against rasters."""

import random

import pytest
from pyspark.sql import functions as F

from celltrove.operators import overlay as O

from .test_space import CONCAVE, moved

E_SHAPE = [(0.0, 0.0), (9.0, 0.0), (9.0, 1.0), (2.0, 1.0), (2.0, 3.0), (9.0, 3.0), (9.0, 5.0), (2.0, 5.0), (2.0, 7.0), (9.0, 7.0), (9.0, 9.0), (0.0, 9.0)]


def within(rings, x, y):
    return sum(O.odd_inside(x, y, r) for r in rings) % 2 == 1


def area(parts):
    return sum(O.turn(r) for part in parts for r in part)


def components(cells):
    left, n = set(cells), 0
    while left:
        n, todo = n + 1, [left.pop()]
        while todo:
            x, y = todo.pop()
            for c in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if c in left:
                    left.discard(c)
                    todo.append(c)
    return n


def box_cells(rings, box, step=0.5):
    n = lambda v: round(v / step)
    return {(i, j) for i in range(n(box[0]), n(box[2])) for j in range(n(box[1]), n(box[3])) if within(rings, (i + 0.5) * step, (j + 0.5) * step)}


def test_parts_holes_and_area_in_boxes():
    rng = random.Random(1)
    shapes = [[CONCAVE], [E_SHAPE], [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], [(2.0, 2.0), (8.0, 2.0), (8.0, 8.0), (2.0, 8.0)], [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]]]
    for _ in range(300):
        rings = [r[:: rng.choice([1, -1])] for r in rng.choice(shapes)]
        x, y = rng.randrange(-4, 20) / 2, rng.randrange(-4, 20) / 2
        box = (x, y, x + rng.randrange(1, 16) / 2, y + rng.randrange(1, 16) / 2)
        parts = O.box_parts(rings, box)
        cells = box_cells(rings, box)
        assert area(parts) == pytest.approx(len(cells) / 4)
        assert len(parts) == components(cells)
        for part in parts:
            assert O.turn(part[0]) > 0 and all(O.turn(h) < 0 for h in part[1:])
            assert all(box[0] <= px <= box[2] and box[1] <= py <= box[3] for r in part for px, py in r)
            for px, py in [(i + 0.25, j + 0.25) for i in range(-2, 12, 3) for j in range(-2, 12, 3)]:
                if within(part, px, py):
                    assert within(rings, px, py)


def test_a_cut_across_the_arms_gives_two_parts():
    assert len(O.box_parts([CONCAVE], (0.0, 4.0, 9.0, 9.0))) == 2 and len(O.box_parts([CONCAVE], (0.0, 0.0, 9.0, 9.0))) == 1
    assert O.box_parts([CONCAVE], (50.0, 50.0, 60.0, 60.0)) == [] == O.box_parts([], (0.0, 0.0, 1.0, 1.0))


def sampled(rings, n=120):
    xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    w, h = max(xs) - min(xs), max(ys) - min(ys)
    return sum(within(rings, min(xs) + (i + 0.437) * w / n, min(ys) + (j + 0.391) * h / n) for i in range(n) for j in range(n)) * w * h / n / n, w * h


def is_simple(ring):
    n = len(ring)
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    for i in range(n):
        for j in range(i + 2, n):
            if i == 0 and j == n - 1:
                continue
            a, b, c, d = ring[i], ring[(i + 1) % n], ring[j], ring[(j + 1) % n]
            if cross(a, b, c) * cross(a, b, d) < -1e-9 and cross(c, d, a) * cross(c, d, b) < -1e-9:
                return False
    return len(set(ring)) == n


BOW = [(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0)]
SPIRAL = [(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (2.0, 8.0), (2.0, 2.0), (10.0, 2.0), (10.0, 10.0), (0.0, 10.0)]


@pytest.mark.parametrize("rings, parts", [([BOW], 2), ([SPIRAL], None), ([[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0), (-4.0, 0.0), (-4.0, -4.0), (0.0, -4.0)]], 2), ([CONCAVE], 1), ([CONCAVE + CONCAVE], 0), ([[(0.0, 0.0), (5.0, 0.0), (9.0, 0.0)]], 0)])
def test_known_repairs(rings, parts):
    got = O.repaired(rings)
    want, whole = sampled(rings) if parts != 0 else (0.0, 1.0)
    assert area(got) == pytest.approx(want, abs=0.02 * whole)
    assert parts is None or len(got) == parts
    assert all(is_simple(r) for part in got for r in part)


def test_random_rings_are_repaired():
    rng = random.Random(2)
    for _ in range(60):
        rings = [[(float(rng.randrange(12)), float(rng.randrange(12))) for _ in range(rng.randrange(3, 9))] for _ in range(rng.choice([1, 1, 2]))]
        got = O.repaired(rings)
        if not got:
            continue
        want, whole = sampled(rings)
        assert area(got) == pytest.approx(want, abs=0.03 * whole)
        assert all(is_simple(r) for part in got for r in part)
        for _ in range(40):
            x, y = rng.random() * 12, rng.random() * 12
            assert sum(within(part, x, y) for part in got) == within(rings, x, y)


def test_on_tables(spark):
    point = "array<struct<x: double, y: double>>"
    rows = [(1, CONCAVE, 0.0, 4.0, 9.0, 9.0), (2, CONCAVE, 20.0, 20.0, 30.0, 30.0), (3, None, 0.0, 0.0, 1.0, 1.0), (4, [], 0.0, 0.0, 1.0, 1.0), (5, [(0.0, 0.0), (None, 1.0), (1.0, 1.0)], 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, f"i int, ring {point}, xmin double, ymin double, xmax double, ymax double")
    got = O.clip_parts(df).select("i", F.size("parts").alias("n"), O.parts_area("parts").alias("a")).collect()
    assert [tuple(r) for r in got] == [(1, 2, 30.0)]
    nested = spark.createDataFrame([(1, [BOW, moved(BOW, 20.0, 0.0)]), (2, None), (3, [None, []])], f"i int, ring array<{point}>")
    assert {r.i: (r.n, r.a) for r in O.repair(nested).select("i", F.size("parts").alias("n"), O.parts_area("parts").alias("a")).collect()} == {1: (4, 16.0), 2: (0, 0.0), 3: (0, 0.0)}


def test_a_file_of_one_split_is_many_tasks(spark, tmp_path):
    ring = F.array(*[F.struct((F.col("id") + x).cast("double").alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 4), (4, 0), (0, 4))])
    spark.range(40).select(ring.alias("ring")).coalesce(1).write.parquet(f"{tmp_path}/rings")
    df = spark.read.parquet(f"{tmp_path}/rings")
    assert df.rdd.getNumPartitions() == 1
    assert "RoundRobinPartitioning" in O.repair(df)._jdf.queryExecution().executedPlan().toString()

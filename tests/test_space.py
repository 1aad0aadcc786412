"""Points in polygons of any sizes, drawing and cutting of awkward rings, against brute force; queries from another folder."""

import os
import random
import subprocess
import sys

from pyspark.sql import functions as F

from celltrove.operators import spatial as S

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
POLYGON = "slide_id string, cell_id long, ring array<struct<x: double, y: double>>"
CONCAVE = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (6.0, 9.0), (6.0, 3.0), (3.0, 3.0), (3.0, 9.0), (0.0, 9.0)]  # a U


def edges(ring):
    return list(zip(ring, ring[1:] + ring[:1]))


def inside(x, y, ring):
    for (ax, ay), (bx, by) in edges(ring):
        if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
    return sum((ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay) for (ax, ay), (bx, by) in edges(ring)) % 2 == 1


def moved(ring, dx, dy, scale=1.0):
    return [(x * scale + dx, y * scale + dy) for x, y in ring]


def test_polygons_of_all_sizes(spark):
    rng = random.Random(7)
    shapes = [CONCAVE, [(0.0, 0.0), (8.0, 2.0), (3.0, 9.0)], [(2.0, 2.0), (2.0, 2.0), (2.0, 2.0)]]
    polygons = [("ab"[i % 2], i, moved(rng.choice(shapes), float(rng.randrange(-60, 60)), float(rng.randrange(-60, 60)), rng.choice([0.25, 0.5, 1.0, 4.0]))) for i in range(60)]
    polygons += [("a", 100, moved(CONCAVE, -5000.0, -5000.0, 1200.0)), ("b", 101, [(-1e5, -1e5), (1e5, -1e5), (1e5, 1e5), (-1e5, 1e5)])]
    points = [(rng.choice("abc"), n, rng.randrange(-280, 280) / 4, rng.randrange(-280, 280) / 4) for n in range(400)]
    want = sorted((n, c) for s, n, x, y in points for t, c, ring in polygons if s == t and inside(x, y, ring))
    odd_points = [("a", 900, None, 1.0), (None, 901, 1.0, 1.0), ("a", 902, float("nan"), 1.0)]
    odd = [("a", 200, None), ("a", 201, []), ("a", 202, [(0.0, 0.0), (5.0, 5.0)]), ("a", 203, [(0.0, 0.0), (5.0, 0.0), (None, 5.0)]), (None, 204, CONCAVE)]
    p = spark.createDataFrame(points + odd_points, "slide_id string, point long, x double, y double")
    for cell in (None, 3.0, 1000.0):
        got = S.points_in(p, spark.createDataFrame(polygons + odd, POLYGON), cell).select("point", "cell_id")
        assert sorted(map(tuple, got.collect())) == want
    assert S.points_in(p, spark.createDataFrame([], POLYGON)).count() == S.points_in(p.limit(0), spark.createDataFrame(polygons, POLYGON)).count() == 0


def test_boxes_are_tested_before_rings(spark):
    p = spark.createDataFrame([("a", 1.0, 1.0)], "slide_id string, x double, y double")
    plan = S.points_in(p, spark.createDataFrame([("a", 1, CONCAVE)], POLYGON))._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert join.index("CASE WHEN") < join.index("_xl") < join.index("exists(")


def test_a_whole_slide_polygon_meets_each_point_in_one_bucket(spark):
    rows = [("a", 1, moved(CONCAVE, 0.0, 0.0, 10_000.0))] + [("a", i, moved(CONCAVE, float(i), 0.0)) for i in range(2, 30)]
    p = spark.createDataFrame([("a", float(i), 1.0) for i in range(50)], "slide_id string, x double, y double")
    joined = S.points_in(p, spark.createDataFrame(rows, POLYGON))
    joined.collect()
    # One row for each polygon and at most four buckets of its own class, whatever the other sizes are.
    leaf = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in leaf and "CartesianProduct" not in leaf


def raster(rings, width):
    return {(int(r), int(c)) for r in range(width) for c in range(width) if sum(((ay > r + 0.5) != (by > r + 0.5)) and c + 0.5 < ax + (r + 0.5 - ay) * (bx - ax) / (by - ay) for ring in rings for (ax, ay), (bx, by) in edges(ring)) % 2}


def test_holes_and_parts_are_drawn(spark):
    hole = moved(CONCAVE, 3.05, 3.05, 0.55)
    rings = [moved(CONCAVE, 1.1, 0.3, 1.7), [(1.2, 11.3), (4.3, 11.3), (4.3, 14.2)], hole]
    df = spark.createDataFrame([("s", 1, 0, 5, rings), ("s", 1, 1, 6, []), ("s", 1, 1, 7, None), ("s", 1, 1, 8, [[(1.0, 1.0), (2.0, 2.0)], None])], "slide_id string, patch_id long, channel int, value int, ring array<array<struct<x: double, y: double>>>")
    got = {(r.row, r.col) for r in S.rasterise(df, 16).collect()}
    assert got == raster(rings, 16) and len(got) > 40


def test_later_cells_overwrite(spark):
    box = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    df = spark.createDataFrame([("s", 1, 0, 9, 1, box), ("s", 1, 0, 3, 2, moved(box, 2.0, 0.0))], "slide_id string, patch_id long, channel int, value int, turn int, ring array<struct<x: double, y: double>>")
    assert {r.value for r in S.rasterise(df, 8).filter("row = 0 AND col IN (2, 3)").collect()} == {9}
    assert {r.value for r in S.rasterise(df, 8, "turn").filter("row = 0 AND col IN (2, 3)").collect()} == {3}


def test_cut_area_of_any_ring(spark):
    rng, rows, want = random.Random(8), [], {}
    for i in range(40):
        ring = moved(CONCAVE, rng.randrange(-16, 16) / 2, rng.randrange(-16, 16) / 2)
        rows.append((i, ring, 0.0, 0.0, 8.0, 8.0))
        cells = raster([moved(ring, 0.0, 0.0, 2.0)], 16)  # half units are pixels
        if cells:
            want[i] = len(cells) / 4
    rows += [(90, None, 0.0, 0.0, 8.0, 8.0), (91, [], 0.0, 0.0, 8.0, 8.0), (92, moved(CONCAVE, 50.0, 50.0), 0.0, 0.0, 8.0, 8.0)]
    df = spark.createDataFrame(rows, "cell_id long, ring array<struct<x: double, y: double>>, xmin double, ymin double, xmax double, ymax double")
    got = {r.cell_id: r.a for r in S.clip_to_patch(df).select("cell_id", S.area(F.col("clipped")).alias("a")).collect() if r.a > 0}
    assert got == want


def test_every_query_runs_from_another_folder(tmp_path):
    """Workers get what they need although the package isn't in their folder."""
    code = f"""
import sys
sys.path.append({ROOT!r})
from celltrove import session
from celltrove.plans import registry
spark = session.build("elsewhere", "local[4]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false")
spark.sparkContext.setLogLevel("ERROR")
failed = {{}}
long = {{"modularity_clusters", "graph_layout"}}  # minutes each; what they send to workers others send too
for name, query in registry.queries().items():
    if name in long:
        continue
    try:
        query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    except Exception as e:
        failed[name] = str(e)[-300:]
print(failed)
sys.exit(bool(failed))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stdout[-3000:] + done.stderr[-1000:]


def test_copies_of_places_and_rings_meet_once(spark, monkeypatch):
    met = []
    whole = S.points_in
    monkeypatch.setattr(S, "points_in", lambda p, q, cell=None: met.append((p.count(), q.count())) or whole(p, q, cell))
    places, rings = [(1.0, 1.0), (4.0, 5.0), (8.0, 8.0)], [CONCAVE, moved(CONCAVE, 3.0, 3.0)]
    points = [("a", n, *places[n % 3], "fg"[n % 2]) for n in range(120)] + [("a", 900, None, 1.0, "f"), (None, 901, 1.0, 1.0, "f")]
    cells = [("a", c, rings[c % 2], c % 3, f"layer{c % 3}") for c in range(50)]
    p = spark.createDataFrame(points, "slide_id string, point_id long, x double, y double, feature_name string")
    q = spark.createDataFrame(cells, POLYGON + ", priority int, layer string")
    want, label = {}, {n: "NoAnnot" for _, n, *_ in points}
    for s, n, x, y, f in points:
        held = [c for c in cells if s == "a" and x is not None and inside(x, y, c[2])]
        for c in held:
            want["a", c[1], f] = want.get(("a", c[1], f), 0) + 1
        if held:
            label[n] = min((c[3], c[4]) for c in held)[1]
    assert {(r.slide_id, r.cell_id, r.feature_name): r["count"] for r in S.count_in_polygons(p, q).collect()} == want
    assert {r.point_id: r.label for r in S.label_points(p, q).collect()} == label
    # Three places of two features each, with the two points that have none, and two rings.
    assert met == [(8, 2), (5, 2)]

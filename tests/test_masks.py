"""Pooled masks, token sums, compressed rows, overlaps and conflicts against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from celltrove.operators import masks as M
from celltrove.operators import spatial as S

from .test_space import CONCAVE, moved


@pytest.mark.parametrize("size, bins", [(256, 14), (32, 7), (10, 10), (9, 4)])
def test_bins_are_those_of_adaptive_pooling(spark, size, bins):
    edges = [(i * size // bins, -(-(i + 1) * size // bins)) for i in range(bins)]
    got = {r.id: r.b for r in spark.range(size).withColumn("b", M.bins_of(F.col("id"), size, bins)).collect()}
    assert got == {p: [i for i, (a, b) in enumerate(edges) if a <= p < b] for p in range(size)}
    if (size, bins) == (256, 14):
        assert {b - a for a, b in edges} == {19, 20}


def test_token_sums(spark):
    rng = np.random.default_rng(1)
    size, bins, width = 20, 6, 5
    maps = rng.integers(0, 4, (3, size, size)) * (rng.random((3, size, size)) < 0.05)
    tokens = rng.integers(-9, 9, (3, bins, bins, width)).astype(float)
    pixels = [(p, int(maps[p, r, c]), r, c) for p in range(3) for r in range(size) for c in range(size) if maps[p, r, c]]
    bad = [(0, 1, -1, 3), (0, 1, 3, size), (0, 1, None, 3)]
    px = spark.createDataFrame(pixels + bad + pixels[:5], "patch int, cell int, row int, col int")
    tk = spark.createDataFrame([(p, r, c, tokens[p, r, c].tolist()) for p in range(3) for r in range(bins) for c in range(bins)], "patch int, bin_row int, bin_col int, vec array<double>")
    got = {(r.patch, r.cell): r.features for r in M.token_sums(M.pooled_masks(px, ["patch", "cell"], size, bins), tk, ["patch"], ["patch", "cell"]).collect()}
    edges = [(i * size // bins, -(-(i + 1) * size // bins)) for i in range(bins)]
    want = {}
    for p in range(3):
        for cell in set(maps[p].ravel()) - {0}:
            pooled = np.array([[(maps[p, a:b, c:d] == cell).any() for c, d in edges] for a, b in edges], float)
            want[p, int(cell)] = np.einsum("hw,hwc->c", pooled, tokens[p]).tolist()
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_compressed_rows_come_back(spark, tmp_path):
    rng = random.Random(2)
    places = {(m, rng.randrange(6), rng.randrange(8), rng.randrange(3)): rng.randrange(0, 5) for m in range(23) for _ in range(rng.randrange(1, 20))}
    px = spark.createDataFrame([(*k, v) for k, v in places.items()], "mask int, row int, col int, channel int, value int")
    rows = M.compressed_rows(px, ["mask"], 8, 3, chunk=5)
    M.write_compressed(rows, f"{tmp_path}/m")
    M.write_compressed(rows, f"{tmp_path}/m")
    back = spark.read.parquet(f"{tmp_path}/m")
    assert {tuple(r) for r in M.pixels_of(back, ["mask"], 8, 3).collect()} == {(*k, v) for k, v in places.items() if v}
    chunks = defaultdict(list)
    for r in back.orderBy("chunk", "at").collect():
        chunks[r.chunk].append(r)
        assert r.indices == sorted(set(r.indices)) and len(r.data) == len(r.indices) == r.stop - r.start
    for rows in chunks.values():
        assert len(rows) <= 5 and [r.at for r in rows] == list(range(len(rows))) and rows[0].start == 0
        assert all(a.stop == b.start for a, b in zip(rows, rows[1:]))
    with pytest.raises(Exception, match="repeats"):
        M.compressed_rows(px.unionByName(px), ["mask"], 8, 3).collect()
    assert M.compressed_rows(px.limit(0), ["mask"], 8, 3).count() == 0


RING = "slide_id string, cell_id long, ring array<struct<x: double, y: double>>"


def grid_area(a, b):
    """Shared area of rings with corners on whole numbers and sides along the axes, by unit squares."""
    inside = lambda ring, x, y: sum((ay > y) != (by > y) and x < ax for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1])) % 2
    return sum(inside(a, x + 0.5, y + 0.5) and inside(b, x + 0.5, y + 0.5) for x in range(-12, 24) for y in range(-12, 24))


def test_shared_area_of_concave_rings(spark):
    rng = random.Random(3)
    pairs = [(moved(CONCAVE, 0.0, 0.0)[:: rng.choice([1, -1])], moved(rng.choice([CONCAVE, [(0.0, 0.0), (5.0, 0.0), (5.0, 4.0), (0.0, 4.0)]]), float(rng.randrange(-9, 10)), float(rng.randrange(-9, 10)))[:: rng.choice([1, -1])]) for _ in range(40)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)] + [(90, CONCAVE, None), (91, [], CONCAVE), (92, CONCAVE, CONCAVE[:2])], "i int, a array<struct<x: double, y: double>>, b array<struct<x: double, y: double>>")
    got = {r.i: r.s for r in df.select("i", S.overlap_area(F.col("a"), F.col("b")).alias("s")).collect()}
    assert got == pytest.approx({i: float(grid_area(a, b)) for i, (a, b) in enumerate(pairs)} | {90: 0.0, 91: 0.0, 92: 0.0})
    tilted = [(0.0, 0.0), (4.0, 1.0), (5.0, 5.0), (1.0, 4.0)]
    one = spark.createDataFrame([(tilted,)], "a array<struct<x: double, y: double>>")
    assert one.select(S.overlap_area(F.col("a"), F.col("a"))).first()[0] == pytest.approx(one.select(S.area(F.col("a"))).first()[0])


def test_conflicts_go_by_area(spark):
    rng = random.Random(4)
    cells = [(rng.choice("ab"), i, moved([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], float(rng.randrange(16)), float(rng.randrange(16)), rng.choice([0.5, 1.0, 1.5]))) for i in range(120)]
    cells += [("a", 500, None), ("b", 501, []), ("a", 502, cells[0][2]), ("a", 503, cells[0][2])]
    df = spark.createDataFrame(cells, RING)
    pairs = S.overlaps(df, 4.0)
    found = {(r.slide_id, r.a, r.b): r for r in pairs.collect()}
    box = lambda r: (r[0][0], r[0][1], r[2][0], r[2][1])
    size = lambda r: (r[2][0] - r[0][0]) * (r[2][1] - r[0][1]) if r else 0.0
    want = {}
    for s, i, p in cells:
        for t, j, q in cells:
            if s == t and i < j and p and q:
                (a, b, c, d), (e, f, g, h) = box(p), box(q)
                w, v = min(c, g) - max(a, e), min(d, h) - max(b, f)
                if w > 0 and v > 0:
                    want[s, i, j] = w * v / min(size(p), size(q))
    assert {k: r.share for k, r in found.items()} == pytest.approx(want)
    got = {(r.slide_id, r.cell_id): r.kept for r in S.without_conflicts(df, pairs, share=0.3).collect()}
    kept = set()
    for s, i, p in sorted(cells, key=lambda c: (-size(c[2]), c[1])):
        if not any(t == s and want.get((s, min(i, j), max(i, j)), 0) >= 0.3 for t, j in kept):
            kept.add((s, i))
    assert got == {(s, i): (s, i) in kept for s, i, _ in cells} and not all(got.values())
    assert all(r.kept for r in S.without_conflicts(df, pairs.limit(0)).collect())


def test_copies_are_resolved_as_all_pairs_are(spark):
    rng = random.Random(6)
    box = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    rings = [box(float(rng.randrange(60)), float(rng.randrange(60)), float(rng.randrange(4, 25))) for _ in range(25)] + [moved(CONCAVE, 7.0, 9.0)]
    rows = [(rng.choice("ab"), i, rng.choice(rings)) for i in range(150)] + [("a", 900, [(1.0, 1.0), (2.0, 2.0)]), ("a", 901, None), ("a", 902, [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)])]
    cells = spark.createDataFrame(rows, "slide_id string, cell_id long, ring array<struct<x: double, y: double>>")
    want = {tuple(r) for r in S.without_conflicts(cells, S.overlaps(cells, 16.0)).select("slide_id", "cell_id", "kept").collect()}
    assert {tuple(r) for r in S.resolved(cells, 16.0).select("slide_id", "cell_id", "kept").collect()} == want
    assert sum(k for _, _, k in want) < len(rows)


def test_pairs_are_measured_where_they_meet(spark):
    cells = spark.createDataFrame([("a", 1, CONCAVE), ("a", 2, moved(CONCAVE, 1.0, 1.0))], "slide_id string, cell_id long, ring array<struct<x: double, y: double>>")
    plan = S.overlaps(cells, 4.0)._jdf.queryExecution().optimizedPlan().toString()
    # One join, by the bucket: the pairs do not go on to joins with their rings.
    assert plan.count("Join ") == 1


def test_equal_rings_are_measured_once(spark, monkeypatch):
    monkeypatch.setattr(S, "BOX_IDS", 3)  # lists of a ring meet themselves and each other
    rings = [CONCAVE, moved(CONCAVE, 1.0, 1.0), moved(CONCAVE, 40.0, 0.0)]
    cells = spark.createDataFrame([("a", i * 7 % 30, rings[i % 3]) for i in range(30)] + [("a", None, CONCAVE), ("b", 3, CONCAVE)], RING)
    of = {i * 7 % 30: i % 3 for i in range(30)}
    whole = {(0, 0): grid_area(rings[0], rings[0]), (0, 1): grid_area(rings[0], rings[1])}
    want = {(a, b): float(whole[0, 0] if of[a] == of[b] else whole[0, 1]) for a in of for b in of if a < b and (of[a] == of[b] or {of[a], of[b]} == {0, 1})}
    rows = S.overlaps(cells, 4.0, digits=6).collect()
    assert {(r.a, r.b): r.shared for r in rows} == want and len(rows) == len(want) and {r.slide_id for r in rows} == {"a"}
    # The rings of ten cells each are measured as lists: the pairs of ids are made above the measure.
    plan = S.overlaps(cells, 4.0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(_p") < plan.index("_measured")
    assert S.overlaps(cells.limit(0), 4.0).count() == 0


def test_edges_are_met_in_parts(monkeypatch):
    rng = random.Random(5)
    edge = lambda: {"l": float(l := rng.randrange(9)), "h": float(l + 1 + rng.randrange(5)), "y": rng.random() * 9, "m": rng.random(), "s": rng.choice([1.0, -1.0])}
    kind = pa.list_(pa.struct([(c, pa.float64()) for c in "lhyms"]))
    p, q = (pa.array([[edge() for _ in range(rng.randrange(6))] for _ in range(40)], kind) for _ in range(2))
    low = pa.array([0.0] * 40)
    whole = S._measured(p, q, low).to_numpy()
    monkeypatch.setattr(S, "EDGE_PAIRS", 5)
    assert S._measured(p, q, low).to_numpy() == pytest.approx(whole) and (whole > 0).any()

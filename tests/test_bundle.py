"""Bundles written and read, and labels from a reference."""

import numpy as np
import pytest
from celltrove.operators import transfer as T
from celltrove.sources import bundle as B


def elements(spark, extra=()):
    cells = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "slide_id string, cell_id long")
    vertices = spark.createDataFrame([("a", 1, 2, 2.0, 2.0), ("a", 1, 0, 0.0, 0.0), ("a", 1, 1, 2.0, 0.0), ("b", 1, 10, 1.0, 1.0), ("b", 1, 9, 0.0, 1.0), ("b", 1, 8, 0.0, 0.0), ("b", None, 0, 1.0, 1.0), *extra], "slide_id string, cell_id long, vertex int, x double, y double")
    points = spark.createDataFrame([("a", 7, 1.0, 3.0), ("b", 8, 2.0, 2.0)], "slide_id string, point_id long, x double, y double")
    counts = spark.createDataFrame([("a", 1, "g", 3), ("b", 1, "h", 1)], "slide_id string, cell_id long, gene string, count int")
    return {
        "cells": B.Element(cells),
        "boundaries": B.Element(vertices, "vertices", (0.5, 0.0, 10.0, 0.0, 0.5, 0.0), [("cell_id", "cells", "cell_id")]),
        "points": B.Element(points, "points", (1.0, 0.0, 0.0, 0.0, 1.0, -1.0)),
        "counts": B.Element(counts, refers=[("cell_id", "cells", "cell_id")]),
    }


def test_round_trip(spark, tmp_path):
    path = f"{tmp_path}/bundle"
    B.write_bundle(spark, path, elements(spark))
    B.write_bundle(spark, path, elements(spark))
    back = B.read_bundle(spark, path)
    assert set(back) == {"cells", "boundaries", "points", "counts"}
    rings = {(r.slide_id, r.cell_id): [tuple(p) for p in r.ring] for r in back["boundaries"].collect()}
    assert rings[("a", 1)] == [(10.0, 0.0), (11.0, 0.0), (11.0, 1.0)] and rings[("b", 1)] == [(10.0, 0.0), (10.0, 0.5), (10.5, 0.5)]
    assert sorted((r.point_id, r.x, r.y) for r in back["points"].collect()) == [(7, 1.0, 2.0), (8, 2.0, 1.0)]
    some = B.read_bundle(spark, path, ["counts"], ["b"])
    assert list(some) == ["counts"] and [r.gene for r in some["counts"].collect()] == ["h"]
    with pytest.raises(ValueError, match="no \\['nuclei'\\]"):
        B.read_bundle(spark, path, ["nuclei"])


def test_lost_references_and_repeated_vertices(spark, tmp_path):
    B.write_bundle(spark, f"{tmp_path}/x", elements(spark, [("b", 5, 0, 1.0, 1.0)]))
    with pytest.raises(ValueError, match="1 rows of boundaries"):
        B.read_bundle(spark, f"{tmp_path}/x")
    assert B.read_bundle(spark, f"{tmp_path}/x", check=False)["boundaries"].count() == 3
    B.write_bundle(spark, f"{tmp_path}/y", elements(spark, [("a", 1, 0, 5.0, 5.0)]))
    with pytest.raises(Exception, match="vertex repeats"):
        B.read_bundle(spark, f"{tmp_path}/y")["boundaries"].collect()
    with pytest.raises(ValueError, match="refers"):
        B.write_bundle(spark, f"{tmp_path}/z", {"counts": B.Element(spark.range(1), refers=[("id", "cells", "id")])})
    with pytest.raises(ValueError, match="kind"):
        B.write_bundle(spark, f"{tmp_path}/z", {"counts": B.Element(spark.range(1), "image")})


def test_known_mixtures_are_recovered(spark):
    rng = np.random.default_rng(1)
    profile = rng.gamma(0.5, 4.0, (4, 40)).round(2) + 0.01
    unit = profile / np.linalg.norm(profile, axis=1)[:, None]
    weights = rng.dirichlet([0.4] * 4, 60)
    x = weights @ unit
    # A cell's length is divided out, so its weights are of what remains: mixtures of unit length.
    scale = np.linalg.norm(x, axis=1)
    reference = spark.createDataFrame([(f"t{i}", f"g{j}", float(profile[i, j])) for i in range(4) for j in range(40)], "type string, gene string, count double")
    entries = [(c, f"g{j}", float(x[c, j] * 100)) for c in range(60) for j in range(40)]
    expr = spark.createDataFrame(entries + [(0, "unknown", 9.0), (None, "g1", 2.0), (70, "unknown", 3.0)], "cell_id long, gene string, count double")
    cells = spark.range(72).withColumnRenamed("id", "cell_id")
    got = {r.cell_id: r for r in T.transfer_labels(expr, cells, reference, steps=1500).collect()}
    assert set(got) == set(range(72)) and got[70].label is None and got[71].weights is None
    for c in range(60):
        w = np.array(got[c].weights)
        assert w.min() >= 0 and w.sum() == pytest.approx(1.0)
        want = weights[c] / scale[c]
        # Nearest point of the simplex in the sense of the fit: no other mixture is nearer.
        miss = lambda v: np.square(v @ unit - x[c] / scale[c]).sum()  # noqa: B023, E731
        assert all(miss(w) <= miss(v) + 1e-6 for v in [*np.eye(4), want / want.sum(), np.full(4, 0.25)])
        if np.sort(weights[c])[-1] - np.sort(weights[c])[-2] > 0.1:
            assert got[c].label == f"t{weights[c].argmax()}" and got[c].proba == pytest.approx(w.max())


def test_reference_has_to_have_types(spark):
    empty = spark.createDataFrame([], "type string, gene string, count double")
    with pytest.raises(ValueError):
        T.transfer_labels(spark.createDataFrame([(1, "g", 1.0)], "cell_id long, gene string, count double"), spark.range(1).withColumnRenamed("id", "cell_id"), empty)


def test_few_types_take_one_row_for_an_entry(spark, monkeypatch):
    reference = spark.createDataFrame([(t, f"g{g}", float((t + 1) * (g % 3) + (g == t))) for t in range(3) for g in range(6)], "type long, gene string, count double")
    expr = spark.createDataFrame([(c, f"g{(c * g) % 7}", float(c + g)) for c in range(9) for g in range(4)], "cell_id long, gene string, count double")
    cells = spark.range(10).withColumnRenamed("id", "cell_id")
    narrow = T.transfer_labels(expr, cells, reference)
    assert "explode" not in narrow._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(T, "MOST_COLUMNS", 0, raising=False)
    wide = {r.cell_id: r for r in T.transfer_labels(expr, cells, reference).collect()}
    for r in narrow.collect():
        assert r.label == wide[r.cell_id].label and r.weights == (wide[r.cell_id].weights and pytest.approx(wide[r.cell_id].weights))

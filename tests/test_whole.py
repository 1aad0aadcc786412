"""Queries over whole tables: every gene, every pair of boxes, the survey's ranges, labels to the end."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from celltrove.operators import ml
from celltrove.plans import cells, models, more, registry, reports, roles, space

SF = "/root/testdata/sf0.001"


def test_every_gene_is_ranked(spark, monkeypatch):
    rng = random.Random(3)
    counts = {(c, g): rng.randrange(1, 4) for c in range(30) for g in (1, 31, 61, 62) if rng.random() < 0.6}
    expr = spark.createDataFrame([(c, g, n) for (c, g), n in counts.items()], "cell_id long, gene long, count long")
    owned = spark.createDataFrame([(c, c % 3) for c in range(30)], "cell_id long, cluster int")
    monkeypatch.setattr(roles, "expression", lambda *_: expr)
    monkeypatch.setattr(roles, "clusters", lambda *_: owned)
    want = {}
    for g in (1, 31, 61, 62):
        v = [counts.get((c, g), 0) for c in range(30)]
        rank = [sum(y < x for y in v) + (sum(y == x for y in v) + 1) / 2 for x in v]
        for k in range(3):
            want[g, k] = (sum(r for c, r in enumerate(rank) if c % 3 == k) - 10 * 31 / 2) / (10 * 20 * 31 / 12) ** 0.5
    assert {(r["gene"], r["cluster"]): r["z"] for r in cells.rank_genes_z(spark, "").collect()} == pytest.approx(want, abs=1e-6)
    top = {(r["cluster"], r["rank"]): r["gene"] for r in cells.top_genes(spark, "").collect()}
    assert top == {(k, i + 1): g for k in range(3) for i, g in enumerate(sorted((1, 31, 61, 62), key=lambda g: (-round(want[g, k], 6), g)))}
    assert {r["gene"] for r in cells.adjusted_p(spark, "").collect()} == {1, 31, 61, 62}


def test_every_pair_of_boxes(spark, monkeypatch):
    rng = random.Random(4)
    boxes = [(i % 2, i, x := rng.randrange(300), y := rng.randrange(300), x + rng.randrange(10, 60), y + rng.randrange(10, 60)) for i in range(60)]
    monkeypatch.setattr(space, "boxes", lambda *_: spark.createDataFrame(boxes, "slide_id int, cell_id long, xmin int, ymin int, xmax int, ymax int"))
    want = [(a[0], a[1], b[1]) for a in boxes for b in boxes if a[0] == b[0] and a[2] <= b[4] and a[4] >= b[2] and a[3] <= b[5] and a[5] >= b[3]]
    assert sorted(tuple(r) for r in more.box_join(spark, "").collect()) == sorted(want)


def test_large_event_ids_stay(spark, save):
    sf = save(events=spark.createDataFrame([(1, 1, "click", 1.0), (5_000_000_000, 1, "click", 2.0)], "event_id long, user_id long, event_type string, value double"))
    assert [r["values"] for r in reports.metrics_to_lists(spark, sf).collect()] == ["1.00,2.00"]


def test_survey_ranges(spark, monkeypatch):
    assert {r["n"] for r in models.knn_topk(spark, SF).groupBy("vec_id").agg(F.count("*").alias("n")).collect()} == {10}
    seen = []
    monkeypatch.setattr(ml, "kmeans_elbow", lambda df, most=10: seen.append(most) or (df.withColumn("cluster", F.lit(0)), [], 1))
    models.kmeans_elbow(spark, SF)
    assert seen == [10]


def test_labels_settle(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (100, 102), (101, 103), (102, 103)]
    found = {r["node"]: r["community"] for r in ml.label_propagation(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    near = defaultdict(list)
    for a, b in edges:
        near[a].append(b)
        near[b].append(a)
    for node, others in near.items():
        votes = Counter(found[o] for o in others)
        assert found[node] == min(votes, key=lambda c: (-votes[c], c))

"""Null, tie, duplicate and border rules on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from celltrove.functions import scalars as X
from celltrove.functions import tables as T
from celltrove.operators import aggregates as A
from celltrove.operators import expression as E
from celltrove.operators import ml
from celltrove.operators import relational as R
from celltrove.operators import spatial as S
from celltrove.operators import vectors as V
from celltrove.operators import windows as W


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_null_group_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(A.group_size(df, ["k"])) == [("a", 1)]
    assert rows(A.value_counts(df, "k")) == [("a", 1)]
    assert rows(A.value_counts(df, "k", dropna=False)) == [("a", 1), (None, 1)]


def test_lookup_last_duplicate_wins_and_default(spark):
    d = spark.createDataFrame([("a", "1", 0), ("a", "2", 1), (None, "3", 2)], "k string, v string, o int")
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert rows(R.lookup(df, "k", d, "k", "v", "o", "out", "Unknown").select("k", "out")) == [("a", "2"), ("z", "Unknown"), (None, "Unknown")]
    assert rows(R.lookup(df, "k", d, "k", "v", "o", "out").select("k", "out")) == [("a", "2"), ("z", None), (None, None)]
    assert one(spark, R.map_literal(F.lit("x"), {"a": "b"}), R.map_chain(F.lit("a"), {"a": "b"}, {"b": "c"})) == (None, "c")


def test_count_thresholds(spark):
    df = spark.createDataFrame([(9, "x"), (10, "x"), (11, "x"), (None, "x")], "n int, label string")
    assert rows(R.min_count(df, "n")) == [(11, "x")]
    assert [r[1] for r in R.mark_low(df, "n", "label").orderBy("n").collect()] == ["x", "less10", "less10", "x"]
    assert rows(R.threshold_census(df, "n", [10])) == [(10, 1, 25.0)]
    assert rows(R.threshold_census(df.limit(0), "n", [10])) == [(10, 0, None)]


def test_ranges_lists_and_vetoes(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 0.0), (2, 1.0), (None, 0.5)], "id int, jaccard double")
    assert [r[1] for r in rows(R.metric_range(df))] == [0.0, 1.0, 0.5]
    assert len(rows(R.drop_ids(df, "id", [1]))) == 2 and len(rows(R.keep_ids(df, "id", [1]))) == 2
    assert rows(R.veto(df, ["id"], F.col("jaccard") < 0).select("id")) == [(2,), (None,)]
    assert rows(R.drop_null_keys(df, "id").select("id").distinct()) == [(1,), (2,)]
    assert R.sample_rows(df, 2, "jaccard").count() == 2 and rows(R.resume(df, df.filter("id = 1"), ["id"])) == [(2, 1.0), (None, 0.5)]
    assert rows(R.missing_references(df, df.filter("id = 1"), ["id"]).select("id")) == [(2,), (None,)]


@pytest.mark.parametrize(("counts", "want"), [([0, 5, 5], ("A", 0.5)), ([9, 1, 0], ("A", 0.1)), ([9, 0, 0], ("Background", 1.0)), ([0, 0, 0], None), ([5, 5, 5], ("A", 1 / 3))])
def test_votes(spark, counts, want):
    df = spark.createDataFrame([(counts,)], "c array<bigint>")
    got = rows(W.vote(df, F.col("c"), ["Background", "A", "B"]).select("label", "proba"))
    assert got == ([want] if want else [])


@pytest.mark.parametrize(("name", "number"), [("aaaaaaaa-1", 1), ("aaaachba-1", 10001), ("iaaaaaaa-1", 2147483649), ("pppppppp-1", 4294967296)])
def test_cell_ids(spark, name, number):
    assert one(spark, X.cell_number(F.lit(name)), X.cell_name(F.lit(number).cast("bigint"))) == (number, name)


def test_strings(spark):
    assert one(spark, X.tissue_of(F.lit("bone_marrow_s0")), X.joined(F.lit("x"), F.lit(None).cast("string"), F.lit("y"))) == ("bone_marrow", "x_nan_y")
    assert one(spark, X.number_of_file(F.lit("123.png")), X.number_of_file(F.lit("x.png")), X.comma_parts(F.lit("a, b,,c "))) == (123, None, ["a", "b", "c"])
    assert one(spark, X.training_prefix(F.lit("training_27")), X.without_prefix(F.lit("s_a"), "s_"), X.nan_to(F.lit("nan"))) == ("t27", "a", "Unknown")
    assert one(spark, X.rgb_hex(F.lit(255), F.lit(15), F.lit(0)), X.comma_list(F.array(F.lit(1), F.lit(2)))) == ("#ff0f00", "1,2")
    assert one(spark, X.first_max(F.array(F.lit(1), F.lit(3), F.lit(3))), X.argmax_with_background(F.array(F.lit(0.0), F.lit(0.0)))) == (1, 0)
    inverted = one(spark, X.inverted(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2), F.lit("c"), F.lit(1))))[0]
    assert inverted == {1: "c", 2: "b"} and one(spark, X.python_round(F.lit(0.125), 2), X.clip_low(F.lit(-1.0)), X.scaled(F.lit(2.0), 2)) == (0.12, 0.0, 4.0)
    assert one(spark, X.with_alpha(F.array(F.lit(255), F.lit(0)), 0.5), X.is_40x(F.lit(0.2125)), X.null_if_nan(F.lit(float("nan")))) == ([1.0, 0.0, 0.5], True, None)
    assert one(spark, *X.box(*[F.lit(x) for x in (1.9, -1.9, 3.2, 4.0)])) == (1, -1, 3, 4)


def test_fixed_tables():
    assert len(T.CANONICAL) == 50 and len(set(T.CANONICAL.values())) == 11
    for scheme, labels in T.SCHEMES.items():
        assert set(labels.values()) == set(T.CATEGORIES[scheme]) and "Glioblastoma" not in labels
    assert {len(T.CATEGORIES[s]) for s in T.CATEGORIES} == {9, 8, 5} and set(T.ATLAS.values()) == set(T.ATLAS_CATEGORIES) == set(T.ATLAS_COLORS)


def test_merges(spark):
    master = spark.createDataFrame([(1, "m"), (2, "m")], "k int, v string")
    pred = spark.createDataFrame([(1, "late", 5), (1, "early", 2), (3, "x", 1)], "k int, label string, o int")
    assert rows(R.merge_one_to_one(master, pred, ["k"], "o")) == [(1, "m", "early"), (2, "m", None)]
    with pytest.raises(Exception, match="key repeats"):
        R.merge_one_to_one(master.union(master), pred, ["k"], "o").collect()
    with pytest.raises(Exception, match="key repeats"):
        A.unique_across(master.union(master), ["k"]).collect()
    new = spark.createDataFrame([(2, "n"), (3, "n")], "k int, v string")
    assert rows(R.upsert_keep_old(master, new, ["k"])) == [(1, "m"), (2, "m"), (3, "n")]
    assert rows(R.dedup_first(pred, ["k"], "o")) == [(1, "early", 2), (3, "x", 1)]
    assert rows(R.union_outer(master, pred.select("k", "label"))) == [(1, "m", None), (1, None, "early"), (1, None, "late"), (2, "m", None), (3, None, "x")]
    assert rows(R.difference_both(master, new)) == [(1, "m", "left"), (2, "m", "left"), (2, "n", "right"), (3, "n", "right")]
    assert rows(R.unique_names(pred.select("k", "o"), "k", "o").select(F.col("k").cast("string"))) == [("1",), ("1-1",), ("3",)]


def test_outer_comparison_forms_agree(spark):
    a = spark.createDataFrame([(1, 1, "a"), (1, 2, None)], "s int, c int, label string")
    b = spark.createDataFrame([(1, 2, "b"), (2, 1, "c")], "s int, c int, label string")
    c = spark.createDataFrame([(3, 1, "d"), (1, 1, "e")], "s int, c int, label string")
    t = {"x": a, "y": b, "z": c}
    assert rows(R.compare_outer(t, ["s", "c"])) == rows(R.compare_outer_join(t, ["s", "c"])) and R.compare_outer(t, ["s", "c"]).count() == 4
    with pytest.raises(Exception, match="key repeats"):
        R.compare_outer({"x": a.union(a), "y": b}, ["s", "c"]).collect()


def test_completion_conserves_rows(spark):
    whole = spark.createDataFrame([(i, f"v{i}") for i in range(6)], "k int, v string")
    part = whole.filter("k < 2").withColumn("label", F.lit("x"))
    done = R.complete(part, whole, ["k"])
    assert done.count() == 6 and done.filter("label IS NULL").count() == 4
    ids = spark.createDataFrame([(5, 0), (9, 1), (0, 2)], "id int, pos int")
    assert [(r["k"], r["v"]) for r in R.reindex(whole, "k", ids, "id", "pos").orderBy("pos").collect()] == [(5, "v5"), (9, None), (0, "v0")]


def test_grouping_pivots_and_lists(spark):
    df = spark.createDataFrame([("s", 1, 2, 3)], "k string, T int, B int, C int")
    assert rows(A.group_columns(df, {"Immune": ["T", "B"]})) == [("s", 3, 3)]
    with pytest.raises(ValueError, match="missing"):
        A.group_columns(df, {"Immune": ["T", "X"]})
    long = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 0), (None, "x", 9), ("a", None, 9)], "k string, c string, n int")
    assert rows(A.pivot_sum(long, ["k"], "c", "n", ["x", "y"])) == [("a", 3, 0), ("b", 0, 0)]
    assert rows(A.row_percent(A.pivot_sum(long, ["k"], "c", "n", ["x", "y"]), ["x", "y"])) == [("a", 100.0, 0.0), ("b", None, None)]
    assert rows(A.distinct_nonzero(long.select("c", "n"), ["c"], "n")) == [("x", [1, 2, 9]), (None, [9])]
    assert rows(A.removed(long, F.col("n") > 1)) == [(5, 3, 2)]
    votes = spark.createDataFrame([(1, [1, 2]), (2, [3])], "k int, c array<bigint>")
    assert rows(A.merge_votes(votes, votes.filter("k = 1"), "k", "c")) == [(1, [2, 4]), (2, [3])]
    m = spark.createDataFrame([("p", "m", "1.5", 1), ("p", "m", "bad", 0), ("p", "m", "NaN", 2)], "p string, metric string, v string, o int")
    assert rows(A.metrics_to_lists(m, ["p"], "metric", "v", "o")) == [("p", "m", [None, 1.5, None])]


def test_quantile_bins(spark):
    df = spark.createDataFrame([(float(x),) for x in range(8)] + [(None,)], "x double")
    assert [r["bin"] for r in W.quantile_bins(df, "x", 7).orderBy(F.asc_nulls_last("x")).collect()] == [0, 0, 1, 2, 3, 4, 5, 6, None]
    with pytest.raises(ValueError, match="unique"):
        W.quantile_bins(spark.createDataFrame([(1.0,)] * 100, "x double"), "x", 7)


def test_order_statistics_by_narrowing(spark):
    values = [float((i * 7919) % 1000) / 4 for i in range(3000)] + [5.0] * 500 + [-1e300, 1e300]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    ranks = [0, 1, 2, 500, 1750, 3499, 3500, 3501]
    assert W.order_statistics(df, "x", ranks, collect=3) == W.order_statistics(df, "x", ranks) == {r: sorted(values)[r] for r in ranks}


def test_clusters(spark):
    df = spark.createDataFrame([(1, "A", "Unknown"), (1, "A", "Unknown"), (1, "B", "A"), (2, "Unknown", "B"), (2, "Unknown", "C")], "c int, cells string, nuclei string")
    got = {r["c"]: r.asDict() for r in W.cluster_flags(df, "c", "cells", "nuclei").collect()}
    assert got[1]["top_nuclei"] == "A" and not got[1]["different_top"] and not got[1]["unknown_top"] and not got[1]["high_diff"]
    assert got[2]["unknown_top"] and got[2]["different_top"] and got[2]["high_diff"]
    assert rows(W.consensus(df, "c", "cells", {"2": "Z"})) == [(1, "A"), (2, "Z")]
    assert rows(W.category_codes(df.select("nuclei").distinct(), "nuclei")) == [("A", 0), ("B", 1), ("C", 2), ("Unknown", 3)]


def test_instances(spark):
    px = spark.createDataFrame([(1, 0, 0, 0, 7), (1, 0, 1, 0, 9), (1, 0, 1, 1, 4), (1, 1, 1, 1, 0), (1, 1, 0, 0, 9)], "p int, r int, c int, ch int, v int")
    assert rows(W.instance_map(px, ["p"], "r", "c", "ch", "v")) == [(1, 0, 0, 1, 1), (1, 0, 1, 3, 2), (1, 1, 0, 2, 1)]
    assert rows(W.remap_ids(px, ["p"], "v", "n").select("v", "n").distinct()) == [(0, 0), (4, 1), (7, 2), (9, 3)]
    pc = spark.createDataFrame([(1, 60.0), (2, 35.0), (3, 5.0)], "i int, v double")
    assert rows(W.components_for(pc, "i", "v")) == [(2,)]


def test_expression(spark):
    cell = spark.createDataFrame([(1, "g", 1.0), (1, "h", 5.0), (2, "g", 4.0)], "cell int, gene string, count double")
    nuc = spark.createDataFrame([(1, "g", 3.0), (2, "g", 1.0), (3, "g", 1.0)], "cell int, gene string, count double")
    assert rows(R.difference_clipped(cell, nuc, ["cell", "gene"], "count")) == [(2, "g", 3.0)]
    assert rows(R.weighted_sum(cell, nuc, ["cell", "gene"], "count", 2.0)) == [(1, "g", 7.0), (2, "g", 6.0)]
    # A gene seen only in a dropped cell of one side is common all the same.
    one_side = spark.createDataFrame([("c1", "g1", 5.0), ("c2", "g2", 1.0)], "cell string, gene string, count double")
    other = spark.createDataFrame([("c1", "g1", 2.0), ("c1", "g2", 3.0)], "cell string, gene string, count double")
    assert rows(R.weighted_sum(one_side, other, ["cell", "gene"], "count")) == [("c1", "g1", 7.0), ("c1", "g2", 3.0)]
    logs = rows(R.weighted_log_sum(one_side, other, "cell", "gene", "count", 0.5))
    assert [(c, g, round(v, 6)) for c, g, v in logs] == [("c1", "g1", round(math.log1p(1e4) + 0.5 * math.log1p(4000), 6)), ("c1", "g2", round(0.5 * math.log1p(6000), 6))]
    one_side = spark.createDataFrame([("c1", "g1", 5.0), ("c1", "g2", 1.0)], "cell string, gene string, count double")
    other = spark.createDataFrame([("c1", "g1", 2.0), ("c2", "g2", 3.0)], "cell string, gene string, count double")
    assert rows(R.difference_clipped(one_side, other, ["cell", "gene"], "count")) == [("c1", "g1", 3.0), ("c1", "g2", 1.0)]
    assert [rows(x) for x in R.common_keys(one_side, other, "cell", "gene")] == [[("c1", "g1", 5.0), ("c1", "g2", 1.0)], [("c1", "g1", 2.0)]]
    zero = spark.createDataFrame([("g", 1, 1.0), ("g", 2, 0.0), ("h", 1, 1.0), ("h", 2, 2.0)], "gene string, slide_id int, count double")
    assert rows(E.gene_zero_filter(zero, 3, most=2)) == [("h", 1)]
    norm = E.normalise_log1p(spark.createDataFrame([(1, "g", 0.0)], "cell int, gene string, count double"), ["cell"])
    assert rows(norm.select("norm")) == [(0.0,)]
    p = spark.createDataFrame([("c", "a", 0.01), ("c", "b", 0.04), ("c", "d", 0.03)], "c string, g string, p double")
    assert [round(r[1], 6) for r in rows(E.adjust_bh(p, ["c"], "p", "g").select("g", "p_adjusted"))] == [0.03, 0.04, 0.04]
    assert abs(one(spark, E.two_sided_p(F.lit(1.959964)))[0] - 0.05) < 1e-5
    flat = E.scale_clip(spark.createDataFrame([(1, "g", 2.0), (2, "g", 2.0)], "cell int, gene string, norm double"), 2)
    assert rows(flat.select("scaled")) == [(0.0,), (0.0,)]


def test_patches(spark):
    ext = spark.createDataFrame([("s", 10645, 24544)], "slide_id string, x_size int, y_size int")
    assert S.patch_grid(ext).count() == 7168
    small = S.patch_grid(spark.createDataFrame([("s", 448, 256)], "slide_id string, x_size int, y_size int"))
    box = spark.createDataFrame([("s", "touch", 190, 10, 192, 20), ("s", "in", 10, 10, 20, 20), ("s", "out", 900, 10, 910, 20), ("s", "bad", 5, 5, -900, 6)], "slide_id string, cell_id string, xmin int, ymin int, xmax int, ymax int")
    assert rows(S.patch_cells(box, small).select("cell_id", "i")) == [("in", 0), ("touch", 0), ("touch", 1)]
    a = spark.createDataFrame([("s", 1, 0.0, 0.0, 25.0, 25.0), ("s", 2, 30.0, 0.0, 31.0, 1.0)], "slide_id string, a int, xmin double, ymin double, xmax double, ymax double")
    assert rows(S.box_join(a, a.withColumnRenamed("a", "b"), 10.0, "a", "b")) == [("s", 1, 1), ("s", 2, 2)]


def test_equal_boxes_meet_once(spark, monkeypatch):
    monkeypatch.setattr(S, "BOX_IDS", 4, raising=False)  # lists of several parts
    copies = [("s", i, 0, 0, 12, 12) for i in range(9)] + [("s", None, 0, 0, 12, 12), ("s", 3, 0, 0, 12, 12), (None, 50, 0, 0, 12, 12)]
    boxes = [*copies, ("s", 20, 12, 12, 30, 15), ("s", 21, 31, 0, 40, 9), ("t", 22, 0, 0, 12, 12)]
    a = spark.createDataFrame(boxes, "slide_id string, a long, xmin int, ymin int, xmax int, ymax int")
    want = [(x[0], x[1], y[1]) for x in boxes for y in boxes if x[0] and x[0] == y[0] and x[2] <= y[4] and x[4] >= y[2] and x[3] <= y[5] and x[5] >= y[3]]
    got = S.box_join(a, a.withColumnRenamed("a", "b"), 10.0, "a", "b")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    # The pairs are made by two lists of ids, behind the join.
    assert got._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0].count("Generate explode(") == 2
    with pytest.raises(Exception, match="not in the scheme"):
        S.patch_counts(spark.createDataFrame([("p", "x")], "p string, c string"), ["p"], "c", ["y"]).collect()


SQUARE = "array(struct(0D AS x, 0D AS y), struct(10D AS x, 0D AS y), struct(10D AS x, 10D AS y), struct(0D AS x, 10D AS y)) AS ring"


def test_points_and_polygons(spark):
    poly = spark.sql(f"SELECT 's' AS slide_id, l AS layer, p AS priority, l AS cell_id, {SQUARE} FROM VALUES ('B', 2), ('A', 1) AS v(l, p)")
    pts = spark.createDataFrame([("s", 1, 5.0, 5.0), ("s", 2, 10.0, 3.0), ("s", 3, 11.0, 3.0), ("s", 4, 10.0, 10.0)], "slide_id string, point_id int, x double, y double")
    assert rows(S.label_points(pts, poly, 4.0).select("point_id", "label")) == [(1, "A"), (2, "A"), (3, "NoAnnot"), (4, "A")]
    assert rows(S.count_in_polygons(pts.withColumn("feature_name", F.lit("g")), poly.filter("layer = 'A'"), 7.0)) == [("s", "A", "g", 3)]
    assert R.valid_rings(poly).count() == 2 and R.valid_rings(spark.sql("SELECT array(struct(0D AS x, 0D AS y)) AS ring")).count() == 0
    pair = poly.limit(1).selectExpr("slide_id", "ring", "5D AS xmin", "5D AS ymin", "20D AS xmax", "20D AS ymax")
    clipped = S.clip_to_patch(pair).first()["clipped"]
    assert {(p["x"], p["y"]) for p in clipped} == {(5.0, 5.0), (10.0, 5.0), (10.0, 10.0), (5.0, 10.0)}
    assert S.clip_to_patch(pair.withColumn("xmin", F.lit(30.0)).withColumn("xmax", F.lit(40.0))).count() == 0
    px = S.rasterise(poly.selectExpr("slide_id", "1L AS patch_id", "0 AS channel", "priority AS value", "ring"))
    assert px.count() == 100 and {r["value"] for r in px.collect()} == {2}
    same = R.geometry_join(poly.withColumn("cell_id", F.lit(1)), poly.limit(1).withColumn("cell_id", F.lit(2)))
    assert rows(same) == [(1, 2), (1, 2)]


def test_vectors_and_models(spark):
    v = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [1.0, 2.0]), (3, [1.0, None]), (4, None)], "k int, v array<double>")
    assert rows(V.drop_nan_vectors(v, "v").select("k")) == [(2,)]
    patches = spark.createDataFrame([("c", "p1", [1.0, 2.0]), ("c", "p2", [3.0, 4.0]), ("d", "p1", [5.0, 6.0])], "k string, p string, v array<double>")
    whole = V.partial_sums(patches, ["k"], "v", "p")
    split = V.merge_partials(V.partial_sums(patches.filter("p = 'p1'"), ["k"], "v", "p"), V.partial_sums(patches.filter("p = 'p2'"), ["k"], "v", "p"), ["k"])
    assert rows(V.means(whole, ["k"])) == rows(V.means(split, ["k"])) == [("c", [2.0, 3.0], 2, ["p1", "p2"]), ("d", [5.0, 6.0], 1, ["p1"])]
    pts = [[float(10 * (i % 3) + (i % 2) * 0.1), float(i % 5) * 0.1] for i in range(60)]
    feats = ml.as_vectors(spark.createDataFrame([(i, p) for i, p in enumerate(pts)], "k int, v array<double>"), "v")
    mean = [sum(c) / 60 for c in zip(*pts)]
    assert abs(ml.inertia_one(feats) - sum((a - m) ** 2 for p in pts for a, m in zip(p, mean))) < 1e-6
    clustered, inertia, k = ml.kmeans_elbow(feats, 6)
    assert k == 3 and clustered.select("cluster").distinct().count() == 3 and len(inertia) == 6
    assert rows(ml.knn(spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [2.0])], "k int, v array<double>"), 1, "k", "v")) == [(1, 1, 2, 2.0), (2, 1, 3, 4.0), (3, 1, 2, 4.0)]
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (7, 8), (8, 9), (7, 9)], "a int, b int")
    found = {r["node"]: r["community"] for r in ml.label_propagation(edges, "a", "b").collect()}
    assert found[1] == found[2] == found[3] and found[7] == found[8] == found[9] and found[1] != found[7]


def test_hooks_and_masks(spark):
    from celltrove.operators import external as H

    cells = spark.createDataFrame([("s", "c1"), ("s", "c2")], "slide_id string, cell_id string")
    got = H.map_labels(cells, lambda r: [x | {"label": x["cell_id"].upper(), "proba": 0.5} for x in r])
    assert rows(got) == [("s", "c1", "C1", 0.5), ("s", "c2", "C2", 0.5)]
    masks = spark.createDataFrame([("s", 1, [2, 2, 2], [0.0, 5.0, 0.0, 0.0, 0.0, 0.0, 7.0, 0.0])], "slide_id string, patch_id bigint, shape array<bigint>, values array<double>")
    px = H.mask_pixels(masks)
    assert rows(px.select("row", "col", "channel", "value")) == [(0, 0, 1, 5), (1, 1, 0, 7)]
    assert H.dense_mask([r.asDict() for r in px.collect()], 2, 2, 2).ravel().tolist() == [0, 5, 0, 0, 0, 0, 7, 0]
    assert one(spark, X.grouping(F.lit('{"new": ["a", "b"]}')))[0] == {"new": ["a", "b"]}
    assert spark.range(1).select(*X.named_components(F.array(F.lit(1), F.lit(2)), "PC_nuc", 3)).first().asDict() == {"PC_nuc_1": 1, "PC_nuc_2": 2, "PC_nuc_3": None}

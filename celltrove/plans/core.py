"""Filters, joins, set operations and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from ..sources.readers import table
from . import roles
from .roles import CELLS, COUNTS, SIDES

# Fixed values of these queries: raw priorities to labels, labels to indices.
LABELS = {"URGENT": "T_NK", "HIGH": "B_Plasma", "MEDIUM": "Myeloid"}
INDEX = {"T_NK": "0", "B_Plasma": "1"}
EXCLUDED = ("AFRICA_s0", "ASIA_s2", "EUROPE_s3")


def dictionary(spark, d):
    """Part types as a dictionary with repeated keys: brand -> type, ordered by part."""
    return table(spark, d, "part", ["p_partkey", "p_brand", "p_type"])


def label_tables(spark, d):
    """Three label tables over partly overlapping keys."""
    line = table(spark, d, "lineitem", ["l_orderkey", "l_linestatus", "l_returnflag", "l_quantity"])
    key = (F.col("l_orderkey") % 31).alias("slide"), F.col("l_orderkey").alias("cell_id")
    nuclei = line.filter("l_linestatus = 'F'").groupBy(*key).agg(F.min("l_returnflag").alias("final_label"))
    cells = line.filter("l_quantity > 10").groupBy(*key).agg(F.max("l_returnflag").alias("final_label"), F.max("l_quantity").alias("proba"))
    o = table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"]).filter("o_orderstatus <> 'O'")
    combined = o.select((F.col("o_orderkey") % 31).alias("slide"), F.col("o_orderkey").alias("cell_id"), F.col("o_orderpriority").alias("final_label"))
    return {"nuclei": nuclei, "cells": cells, "combined": combined}


_N = "SELECT l_orderkey % 31 AS slide, l_orderkey AS cell_id, min(l_returnflag) AS final_label_nuclei FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL"
_C = "SELECT l_orderkey % 31 AS slide, l_orderkey AS cell_id, max(l_returnflag) AS final_label_cells, max(l_quantity) AS proba_cells FROM lineitem WHERE l_quantity > 10 GROUP BY ALL"
_O = "SELECT o_orderkey % 31 AS slide, o_orderkey AS cell_id, o_orderpriority AS final_label_combined FROM orders WHERE o_orderstatus <> 'O'"


def filter_min_count(spark, d):
    return R.min_count(roles.counts(spark, d), "transcript_counts", 100)


def label_less10(spark, d):
    rows = roles.cells(spark, d).join(roles.counts(spark, d), "cell_id").select("cell_id", "label1", "transcript_counts")
    return R.mark_low(rows, "transcript_counts", "label1")


def threshold_census(spark, d):
    return R.threshold_census(roles.counts(spark, d), "transcript_counts")


def exclude_slides(spark, d):
    return R.drop_ids(roles.cells(spark, d).select("cell_id", "slide_id"), "slide_id", EXCLUDED)


def map_literal(spark, d):
    return roles.cells(spark, d).select("cell_id", R.map_literal(F.col("label1"), LABELS).alias("label"))


def map_fillna(spark, d):
    parts = table(spark, d, "part", ["p_partkey", "p_size"]).withColumn("brand", F.concat(F.lit("Brand#"), F.col("p_size").cast("string")))
    return R.lookup(parts, "brand", dictionary(spark, d), "p_brand", "p_type", "p_partkey", "label", "Unknown").select("p_partkey", "brand", "label")


def map_chain(spark, d):
    return roles.cells(spark, d).select("cell_id", R.map_chain(F.col("label1"), LABELS, INDEX).alias("index"))


def label_compare_outer(spark, d):
    return R.compare_outer(label_tables(spark, d), ["slide", "cell_id"])


def testset_table(spark, d):
    images = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    patches = table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    sets = table(spark, d, "nation", ["n_nationkey", "n_name"])
    return R.inner_renamed(R.inner_renamed(images, patches, "o_custkey", "c_custkey"), sets, "c_nationkey", "n_nationkey")


def patch_metrics_left(spark, d):
    metrics = table(spark, d, "lineitem", ["l_orderkey", "l_discount", "l_quantity"]).filter("l_quantity > 45").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_discount").alias("dice"), F.min("l_discount").alias("jaccard"))
    return R.left_fill(table(spark, d, "orders", ["o_orderkey", "o_custkey"]), metrics, ["o_orderkey"])


def pred_merge_1to1(spark, d):
    pred = table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]).filter("l_quantity > 20")
    order = F.struct("l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber")
    pred = pred.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("label"), F.col("l_quantity").alias("proba"), order.alias("place"))
    return R.merge_one_to_one(table(spark, d, "orders", ["o_orderkey", "o_orderstatus"]), pred, ["o_orderkey"], "place")


def semi_join(spark, d):
    return table(spark, d, "orders", ["o_orderkey", "o_custkey"]).join(table(spark, d, "lineitem", ["l_orderkey", "l_quantity"]).filter("l_quantity = 50").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


def anti_complete(spark, d):
    whole = table(spark, d, "orders", ["o_orderkey", "o_orderstatus"])
    part = whole.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit("scored").alias("label"))
    return R.complete(part, whole, ["o_orderkey"])


def common_cells_genes(spark, d):
    a, _ = R.common_keys(*roles.sides(spark, d), "cell_id", "gene")
    return a.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_genes"), F.sum("count").cast("bigint").alias("total"))


def reindex(spark, d):
    ids = table(spark, d, "customer", ["c_custkey"]).select((F.col("c_custkey") * 11 % 20011).alias("id"), F.col("c_custkey").alias("position"))
    return R.reindex(table(spark, d, "orders", ["o_orderkey", "o_orderstatus"]), "o_orderkey", ids, "id", "position")


def _pair(spark, d):
    o = table(spark, d, "orders", ["o_custkey", "o_orderstatus"])
    return o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'P'")


def union_all(spark, d):
    a, b = _pair(spark, d)
    return R.union_all(a, b)


def union_outer(spark, d):
    a, b = _pair(spark, d)
    return R.union_outer(a, b.select("o_custkey", F.lit(1).alias("extra")))


def set_diff(spark, d):
    a, b = (x.select("o_custkey") for x in _pair(spark, d))
    return R.difference_both(a, b)


def set_intersect(spark, d):
    a, b = (x.select("o_custkey") for x in _pair(spark, d))
    return R.intersect(a, b)


def census_merge(spark, d):
    a, b = _pair(spark, d)
    return R.merge_distinct(a, b, a)


def upsert_keep_old(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    old = o.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max("o_totalprice").alias("price"), F.lit("old").alias("origin"))
    new = o.filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.min("o_totalprice").alias("price"), F.lit("new").alias("origin"))
    return R.upsert_keep_old(old, new, ["o_custkey"])


def dedup_first(spark, d):
    rows = table(spark, d, "orders", ["o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"])
    return R.dedup_first(rows, ["o_custkey"], "o_orderkey")


def pick(**more):
    names = ("filter_min_count label_less10 threshold_census exclude_slides map_literal map_fillna map_chain label_compare_outer testset_table patch_metrics_left pred_merge_1to1 semi_join anti_complete common_cells_genes reindex union_all union_outer set_diff set_intersect census_merge upsert_keep_old dedup_first").split()
    return {n: globals()[n] for n in names} | more


QUERIES = pick()

_CASE = "CASE label1 " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items()) + " END"
_BELOW = " UNION ALL ".join(f"SELECT CAST({t} AS BIGINT) AS threshold, count(*) FILTER (transcript_counts < {t}) AS n_below, round(count(*) FILTER (transcript_counts < {t}) * CAST(100 AS DOUBLE) / count(*), 2) AS percent FROM ({COUNTS}) c" for t in (20, 15, 10))
SQL = {
    "filter_min_count": f"SELECT * FROM ({COUNTS}) c WHERE transcript_counts > 100",
    "label_less10": f"SELECT c.cell_id, CASE WHEN transcript_counts <= 10 THEN 'less10' ELSE label1 END AS label1, transcript_counts FROM ({CELLS}) c JOIN ({COUNTS}) n USING (cell_id)",
    "threshold_census": _BELOW,
    "exclude_slides": f"SELECT cell_id, slide_id FROM ({CELLS}) c WHERE slide_id NOT IN {EXCLUDED}",
    "map_literal": f"SELECT cell_id, {_CASE} AS label FROM ({CELLS}) c",
    "map_fillna": "SELECT p_partkey, brand, coalesce(t, 'Unknown') AS label FROM (SELECT p_partkey, 'Brand#' || p_size AS brand FROM part) p LEFT JOIN (SELECT p_brand, arg_max(p_type, p_partkey) AS t FROM part GROUP BY p_brand) m ON brand = p_brand",
    "map_chain": f"SELECT cell_id, CASE {_CASE} WHEN 'T_NK' THEN '0' WHEN 'B_Plasma' THEN '1' END AS index FROM ({CELLS}) c",
    "label_compare_outer": f"SELECT coalesce(a.slide, b.slide, c.slide) AS slide, coalesce(a.cell_id, b.cell_id, c.cell_id) AS cell_id, final_label_nuclei, final_label_cells, proba_cells, final_label_combined FROM ({_N}) a FULL JOIN ({_C}) b ON a.slide = b.slide AND a.cell_id = b.cell_id FULL JOIN ({_O}) c ON coalesce(a.slide, b.slide) = c.slide AND coalesce(a.cell_id, b.cell_id) = c.cell_id",
    "testset_table": "SELECT o_orderkey, o_totalprice, c_custkey, c_mktsegment, n_nationkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    "patch_metrics_left": "SELECT o_orderkey, o_custkey, coalesce(dice, -1) AS dice, coalesce(jaccard, -1) AS jaccard FROM orders LEFT JOIN (SELECT l_orderkey, max(l_discount) AS dice, min(l_discount) AS jaccard FROM lineitem WHERE l_quantity > 45 GROUP BY l_orderkey) ON l_orderkey = o_orderkey",
    "pred_merge_1to1": "SELECT o_orderkey, o_orderstatus, label, proba FROM orders LEFT JOIN (SELECT l_orderkey, l_partkey AS label, l_quantity AS proba FROM lineitem WHERE l_quantity > 20 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey, l_suppkey, l_linenumber) = 1) ON l_orderkey = o_orderkey",
    "semi_join": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)",
    "anti_complete": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'scored' END AS label, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus FROM orders",
    "common_cells_genes": f"WITH {SIDES} SELECT cell_id, count(*) AS n_genes, CAST(sum(count) AS BIGINT) AS total FROM x GROUP BY cell_id",
    "reindex": "SELECT i.id AS o_orderkey, position, o_orderstatus FROM (SELECT c_custkey * 11 % 20011 AS id, c_custkey AS position FROM customer) i LEFT JOIN orders ON id = o_orderkey",
    "union_all": "SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')",
    "union_outer": "SELECT o_custkey, o_orderstatus, CAST(NULL AS INTEGER) AS extra FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, NULL, 1 FROM orders WHERE o_orderstatus = 'P'",
    "set_diff": "WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') SELECT o_custkey, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT o_custkey, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)",
    "set_intersect": "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'",
    "census_merge": "SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')",
    "upsert_keep_old": "WITH old AS (SELECT o_custkey, max(o_totalprice) AS price FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), new AS (SELECT o_custkey, min(o_totalprice) AS price FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) SELECT o_custkey, price, 'old' AS origin FROM old UNION ALL SELECT o_custkey, price, 'new' FROM new WHERE o_custkey NOT IN (SELECT o_custkey FROM old)",
    "dedup_first": "SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1",
}

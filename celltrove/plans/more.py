"""Smaller filters, checks, functions and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.tables import ATLAS, SCHEMES
from ..operators import aggregates as A
from ..operators import expression as E
from ..operators import relational as R
from ..operators import spatial as S
from ..operators import windows as W
from ..sources.readers import table
from . import roles
from .roles import CELLS, CLUSTERS, EXPR


def drop_null_keys(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_orderstatus"]).withColumn("key", F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey")))
    return R.drop_null_keys(o.select("key", "o_orderstatus"), "key")


def slide_slice(spark, d):
    rows = roles.cells(spark, d).filter(F.col("slide_id") == "ASIA_s2")
    return rows.drop("nation", "tissue", "total", "label3").withColumnsRenamed({"label1": "first_label", "label2": "second_label"})


def keep_genes(spark, d):
    genes = table(spark, d, "part", ["p_partkey", "p_type"]).filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("gene"))
    return E.keep_genes(roles.expression(spark, d), genes)


def valid_rings(spark, d):
    from .space import polygons

    holed = polygons(spark, d).withColumn("ring", F.when(F.col("cell_id") % 10 == 0, F.slice("ring", 1, 2)).otherwise(F.col("ring")))
    return R.valid_rings(holed).select("cell_id")


def sample_rows(spark, d):
    return R.sample_rows(table(spark, d, "orders", ["o_orderkey"]), 700, "o_orderkey")


def resume_slides(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    return R.resume(o, o.filter("o_orderkey % 3 = 0"), ["o_custkey"])


def unique_across(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_orderstatus"])
    return A.unique_across(R.union_all(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'P'")), ["o_orderkey"])


def rows_removed(spark, d):
    return A.removed(table(spark, d, "lineitem", ["l_quantity"]), F.col("l_quantity") > 10)


def distinct_nonzero(spark, d):
    rows = table(spark, d, "lineitem", ["l_suppkey", "l_partkey"]).select("l_suppkey", (F.col("l_partkey") % 9).alias("id"))
    return A.distinct_nonzero(rows, ["l_suppkey"], "id").select("l_suppkey", X.comma_list(F.col("ids")).alias("ids"))


def cumulative_share(spark, d):
    v = table(spark, d, "lineitem", ["l_linenumber", "l_quantity"]).groupBy("l_linenumber").agg(F.sum("l_quantity").alias("variance"))
    return W.cumulative_share(v, "l_linenumber", "variance").select("l_linenumber", F.round("cumulative", 6).alias("cumulative"))


def components_95(spark, d):
    v = table(spark, d, "lineitem", ["l_linenumber", "l_quantity"]).groupBy("l_linenumber").agg(F.sum("l_quantity").alias("variance"))
    return W.components_for(v, "l_linenumber", "variance")


def unique_names(spark, d):
    return R.unique_names(table(spark, d, "part", ["p_partkey", "p_brand"]), "p_brand", "p_partkey")


def box_join(spark, d):
    from .space import boxes

    b = boxes(spark, d)
    return S.box_join(b, b.withColumnRenamed("cell_id", "other_id"), 64.0, "cell_id", "other_id")


def lost_parents(spark, d):
    parents = table(spark, d, "orders", ["o_orderkey"]).filter("o_orderkey % 4 > 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return R.missing_references(table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"]), parents, ["l_orderkey"])


def compare_join_form(spark, d):
    from .core import label_tables

    return R.compare_outer_join(label_tables(spark, d), ["slide", "cell_id"])


def scheme_categories(spark, d):
    label = F.when(F.col("label1") == "URGENT", "T_NK").when(F.col("label1") == "HIGH", "Stem_like").when(F.col("label1") == "LOW", "Glioblastoma").otherwise("Epithelial")
    return roles.cells(spark, d).select("cell_id", *[R.map_literal(label, SCHEMES[s]).alias(s) for s in SCHEMES])


def atlas_categories(spark, d):
    kind = F.when(F.col("label2") == "F", "T_cell").when(F.col("label2") == "P", "nan").otherwise("Other")
    return roles.cells(spark, d).select("cell_id", R.map_literal(kind, ATLAS, "Unknown").alias("category"))


def scalar_functions(spark, d):
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    k = F.col("o_orderkey")
    votes = F.array(k % 7, k % 5, k % 3)
    return o.select(
        "o_orderkey", X.number_of_file(F.concat(k.cast("string"), F.lit(".png"))).alias("number"), X.without_prefix(F.concat(F.lit("slide_"), k.cast("string")), "slide_").alias("stem"),
        X.comma_list(X.comma_parts(F.concat(F.lit(" a, ,"), k.cast("string"), F.lit(" ")))).alias("parts"), X.training_prefix(F.concat(F.lit("training_"), (k % 30).cast("string"))).alias("prefix"),
        X.first_max(votes).alias("first_max"), X.argmax_with_background(votes).alias("with_background"), X.clip_low(F.col("o_custkey") - 700, 0).cast("bigint").alias("clipped"),
        (F.col("o_totalprice") - 250000).cast("int").alias("truncated"), F.round(F.log1p("o_totalprice"), 6).alias("log1p"), X.is_40x(F.when(k % 2 == 0, 0.2125).otherwise(0.5)).alias("is_40x"),
        F.element_at(X.inverted(F.create_map(F.lit("a"), k, F.lit("b"), k + 1)), k + 1).alias("inverted"),
    )


def vector_concat(spark, d):
    e = table(spark, d, "embeddings", ["vec_id", "embedding"])
    joined = F.concat(F.slice("embedding", 1, 2), F.slice("embedding", 5, 2))
    return e.select("vec_id", *X.named_components(joined, "PC_nuc", 4))


def consensus_columns(spark, d):
    return R.lookup(roles.clusters(spark, d), "cluster", W.consensus(roles.clusters(spark, d), "cluster", "label_cells").withColumn("place", F.lit(0)), "cluster", "final", "place", "combined").select("cell_id", "combined")


NAMES = "drop_null_keys slide_slice keep_genes valid_rings sample_rows resume_slides unique_across rows_removed distinct_nonzero cumulative_share components_95 unique_names box_join lost_parents compare_join_form scheme_categories atlas_categories scalar_functions vector_concat consensus_columns".split()
QUERIES = {n: globals()[n] for n in NAMES}

_BOX = "SELECT o_custkey % 7 AS slide_id, o_orderkey AS cell_id, o_orderkey * 37 % 2940 AS xmin, o_orderkey * 101 % 2940 AS ymin, o_orderkey * 37 % 2940 + 10 + o_custkey % 50 AS xmax, o_orderkey * 101 % 2940 + 10 + o_custkey % 50 AS ymax FROM orders"
_V = "SELECT l_linenumber, sum(l_quantity) AS v FROM lineitem GROUP BY 1"
_CUM = f"SELECT l_linenumber, sum(v) OVER (ORDER BY l_linenumber) / sum(v) OVER () AS c FROM ({_V}) v"


def _sql():
    from .core import SQL as core

    top = f"SELECT cluster, label_cells AS final FROM ({CLUSTERS}) x GROUP BY cluster, label_cells QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, label_cells) = 1"
    return {
        "drop_null_keys": "SELECT o_orderkey AS key, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'",
        "slide_slice": f"SELECT cell_id, slide_id, label1 AS first_label, label2 AS second_label FROM ({CELLS}) c WHERE slide_id = 'ASIA_s2'",
        "keep_genes": f"SELECT cell_id, gene, count FROM ({EXPR}) e WHERE gene IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')",
        "valid_rings": "SELECT c_custkey AS cell_id FROM customer WHERE c_custkey % 10 <> 0",
        "sample_rows": "SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey || '_42'), o_orderkey LIMIT 700",
        "resume_slides": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)",
        "unique_across": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')",
        "rows_removed": "SELECT count(*) AS before, count(*) FILTER (l_quantity > 10) AS after, count(*) - count(*) FILTER (l_quantity > 10) AS removed FROM lineitem",
        "distinct_nonzero": "SELECT l_suppkey, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM (SELECT DISTINCT l_suppkey, l_partkey % 9 AS id FROM lineitem) WHERE id <> 0 GROUP BY 1",
        "cumulative_share": f"SELECT l_linenumber, round(c, 6) AS cumulative FROM ({_CUM}) c",
        "components_95": f"SELECT min(l_linenumber) AS n FROM ({_CUM}) c WHERE c >= CAST(0.95 AS DOUBLE)",
        "unique_names": "SELECT p_partkey, CASE WHEN k > 0 THEN p_brand || '-' || k ELSE p_brand END AS p_brand FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS k FROM part)",
        "box_join": f"SELECT a.slide_id, a.cell_id, b.cell_id AS other_id FROM ({_BOX}) a JOIN ({_BOX}) b ON a.slide_id = b.slide_id AND a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin",
        "lost_parents": "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 > 0)",
        "compare_join_form": core["label_compare_outer"],
        "scheme_categories": f"SELECT cell_id, CASE l WHEN 'T_NK' THEN 'T_NK' WHEN 'Stem_like' THEN 'Dead' WHEN 'Epithelial' THEN l END AS ct_1, CASE l WHEN 'T_NK' THEN 'Lymphocyte' WHEN 'Stem_like' THEN 'Dead' WHEN 'Epithelial' THEN l END AS ct_2, CASE l WHEN 'T_NK' THEN 'Immune' WHEN 'Stem_like' THEN 'Other' WHEN 'Epithelial' THEN l END AS ct_3 FROM (SELECT cell_id, CASE label1 WHEN 'URGENT' THEN 'T_NK' WHEN 'HIGH' THEN 'Stem_like' WHEN 'LOW' THEN 'Glioblastoma' ELSE 'Epithelial' END AS l FROM ({CELLS}) c)",
        "atlas_categories": f"SELECT cell_id, CASE label2 WHEN 'F' THEN 'LIC' ELSE 'Unknown' END AS category FROM ({CELLS}) c",
        "scalar_functions": "SELECT o_orderkey, o_orderkey AS number, CAST(o_orderkey AS VARCHAR) AS stem, 'a,' || o_orderkey AS parts, 't' || (o_orderkey % 30) AS prefix, CAST(list_position([o_orderkey % 7, o_orderkey % 5, o_orderkey % 3], list_max([o_orderkey % 7, o_orderkey % 5, o_orderkey % 3])) - 1 AS INTEGER) AS first_max, CAST(list_position([0, o_orderkey % 7, o_orderkey % 5, o_orderkey % 3], list_max([0, o_orderkey % 7, o_orderkey % 5, o_orderkey % 3])) - 1 AS INTEGER) AS with_background, greatest(o_custkey - 700, 0) AS clipped, CAST(trunc(o_totalprice - 250000) AS INTEGER) AS truncated, round(ln(1 + o_totalprice), 6) AS log1p, o_orderkey % 2 = 0 AS is_40x, 'b' AS inverted FROM orders",
        "vector_concat": "SELECT vec_id, embedding[1] AS \"PC_nuc_1\", embedding[2] AS \"PC_nuc_2\", embedding[5] AS \"PC_nuc_3\", embedding[6] AS \"PC_nuc_4\" FROM embeddings",
        "consensus_columns": f"SELECT cell_id, final AS combined FROM ({CLUSTERS}) c JOIN ({top}) t USING (cluster)",
    }


SQL = _sql()

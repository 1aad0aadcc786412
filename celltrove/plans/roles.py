"""The benchmark tables in the roles of the data model, as DataFrames and as SQL.

cell = order, gene = part, slide = nation, tissue = region, expression = lineitem
(nucleus part: line status F), features = embeddings, points = events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import table


def slides(spark: SparkSession, d: str) -> DataFrame:
    """(nation, slide_id, tissue): a few rows for each region."""
    n = table(spark, d, "nation", ["n_nationkey", "n_regionkey"]).join(table(spark, d, "region", ["r_regionkey", "r_name"]), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.col("n_nationkey").alias("nation"), F.concat(F.replace("r_name", F.lit(" "), F.lit("_")), F.lit("_s"), F.col("n_nationkey").cast("string")).alias("slide_id"), F.col("r_name").alias("tissue"))


def cells(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"])
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(slides(spark, d), F.col("c_nationkey") == F.col("nation"))
    return joined.select(F.col("o_orderkey").alias("cell_id"), "slide_id", "nation", "tissue", F.substr("o_orderpriority", F.lit(3)).alias("label1"), F.col("o_orderstatus").alias("label2"), F.col("c_mktsegment").alias("label3"), F.col("o_totalprice").alias("total"))


def expression(spark: SparkSession, d: str, nuclei: bool = False) -> DataFrame:
    rows = table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_linestatus"])
    rows = rows.filter("l_linestatus = 'F'") if nuclei else rows
    return rows.groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("count"))


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Cell and nucleus expression whose cells and genes overlap in part."""
    rows = table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_linestatus", "l_returnflag"])
    counted = lambda df: df.groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("count"))
    return counted(rows.filter("l_returnflag <> 'A' AND l_partkey % 10 <> 3")), counted(rows.filter("l_linestatus = 'F' AND l_partkey % 10 <> 7"))


def counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", ["l_orderkey", "l_quantity"]).groupBy(F.col("l_orderkey").alias("cell_id")).agg(F.sum("l_quantity").cast("bigint").alias("transcript_counts"))


def clusters(spark: SparkSession, d: str) -> DataFrame:
    """Cells with a cluster, and labels from the cell and from its nucleus, some of them unknown."""
    c = cells(spark, d)
    nucleus = F.when(F.col("label2") == "F", F.col("label1")).when(F.col("label2") == "P", F.lit("Unknown")).otherwise(F.lit("LOW"))
    cell = F.when(F.col("label1") == "NOT SPECIFIED", F.lit("Less10")).otherwise(F.col("label1"))
    return c.select("cell_id", (F.col("cell_id") % 12).cast("int").alias("cluster"), cell.alias("label_cells"), nucleus.alias("label_nuclei"))


SLIDES = "SELECT n_nationkey AS nation, concat(replace(r_name, ' ', '_'), '_s', CAST(n_nationkey AS VARCHAR)) AS slide_id, r_name AS tissue FROM nation JOIN region ON n_regionkey = r_regionkey"
CELLS = f"SELECT o_orderkey AS cell_id, slide_id, nation, tissue, substr(o_orderpriority, 3) AS label1, o_orderstatus AS label2, c_mktsegment AS label3, o_totalprice AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN ({SLIDES}) s ON c_nationkey = nation"
EXPR = "SELECT l_orderkey AS cell_id, l_partkey AS gene, sum(l_quantity) AS count FROM lineitem GROUP BY ALL"
_SIDE = "SELECT l_orderkey AS cell_id, l_partkey AS gene, sum(l_quantity) AS count FROM lineitem WHERE {} GROUP BY ALL"
_KEPT = "SELECT * FROM {0} WHERE cell_id IN (SELECT cell_id FROM a) AND cell_id IN (SELECT cell_id FROM b) AND gene IN (SELECT gene FROM a) AND gene IN (SELECT gene FROM b)"
#: Tables x and y: the two sides cut down to common cells and genes.
SIDES = f"a AS ({_SIDE.format("l_returnflag <> 'A' AND l_partkey % 10 <> 3")}), b AS ({_SIDE.format("l_linestatus = 'F' AND l_partkey % 10 <> 7")}), x AS ({_KEPT.format('a')}), y AS ({_KEPT.format('b')})"
COUNTS = "SELECT l_orderkey AS cell_id, CAST(sum(l_quantity) AS BIGINT) AS transcript_counts FROM lineitem GROUP BY ALL"
CLUSTERS = f"SELECT cell_id, CAST(cell_id % 12 AS INTEGER) AS cluster, CASE WHEN label1 = 'NOT SPECIFIED' THEN 'Less10' ELSE label1 END AS label_cells, CASE WHEN label2 = 'F' THEN label1 WHEN label2 = 'P' THEN 'Unknown' ELSE 'LOW' END AS label_nuclei FROM ({CELLS}) c"

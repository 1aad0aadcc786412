"""Sources and sinks as queries: tables are written to the scratch folder in a format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import spatial
from ..scratch import scratch_dir
from ..sources import bundle, readers, writers
from ..sources.readers import table
from . import space


def _path(spark, name: str) -> str:
    return f"{scratch_dir(spark)}/celltrove-{name}-{uuid.uuid4().hex}"


def csv_round_trip(spark, d):
    """Typed CSV, two of four columns read."""
    path = _path(spark, "csv")
    writers.csv(table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]), path)
    return readers.csv(spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string", ["c_custkey", "c_mktsegment"])


def csv_concat(spark, d):
    """Several CSV folders as one table."""
    rows = table(spark, d, "part", ["p_partkey", "p_size"])
    paths = [_path(spark, "csv") for _ in range(3)]
    for i, path in enumerate(paths):
        writers.csv(rows.filter(F.col("p_partkey") % 3 == i), path)
    return readers.csv(spark, paths, "p_partkey bigint, p_size int")


def json_round_trip(spark, d):
    path = _path(spark, "json")
    writers.json_lines(table(spark, d, "supplier", ["s_suppkey", "s_name", "s_nationkey"]), path)
    return spark.read.schema("s_suppkey bigint, s_name string, s_nationkey int").json(path)


def parquet_by_slide(spark, d):
    """A dataset element partitioned by slide, two slides of it read."""
    path = _path(spark, "dataset")
    cells = table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_custkey"]).select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 7).cast("string").alias("slide_id"))
    writers.parquet(cells, f"{path}/cells", ["slide_id"])
    return readers.element(spark, path, "cells", ["2", "5"]).select("o_orderkey", "o_orderstatus", F.col("slide_id").cast("string").alias("slide_id"))


def replaced_element(spark, d):
    """An element read, changed and put back in its place."""
    path = _path(spark, "element")
    writers.parquet(table(spark, d, "nation", ["n_nationkey", "n_name"]), path)
    writers.replace(spark.read.parquet(path).filter("n_nationkey % 2 = 0").withColumn("n_name", F.lower("n_name")), path)
    return spark.read.parquet(path)


def appended_new(spark, d):
    """Two appends that overlap: the first row of a key stays."""
    path = _path(spark, "append")
    rows = table(spark, d, "supplier", ["s_suppkey"])
    writers.append_new(rows.filter("s_suppkey % 3 <> 0").withColumn("batch", F.lit(1)), path, ["s_suppkey"])
    writers.append_new(rows.filter("s_suppkey % 2 = 0").withColumn("batch", F.lit(2)), path, ["s_suppkey"])
    return spark.read.parquet(path)


def merged_chunks(spark, d):
    """Numbered chunks as one table with the chunk of each row."""
    path = _path(spark, "chunks")
    rows = table(spark, d, "part", ["p_partkey", "p_brand"])
    for i in range(3):
        writers.parquet(rows.filter(F.col("p_partkey") % 3 == i), f"{path}/chunk_{i}.parquet")
    return writers.merge_chunks(spark, path, r"_(\d+)\.parquet/[^/]*$")


def matrix_market(spark, d):
    """A coordinate matrix with its name lists, read back as named entries."""
    path = _path(spark, "matrix")
    named = lambda t, c, n: table(spark, d, t, [c]).orderBy(c).select(F.concat(F.lit(n), F.col(c).cast("string")).alias("value")).coalesce(1)
    named("region", "r_regionkey", "r").write.text(f"{path}/rows")
    named("nation", "n_nationkey", "n").write.text(f"{path}/columns")
    entries = table(spark, d, "nation", ["n_nationkey", "n_regionkey"]).select(F.concat_ws(" ", (F.col("n_regionkey") + 1).cast("string"), (F.col("n_nationkey") + 1).cast("string"), (F.col("n_nationkey") + 0.5).cast("string")).alias("value"))
    head = spark.sql("SELECT '%%MatrixMarket matrix coordinate real general' AS value, 0 AS at UNION ALL SELECT '5 25 25', 1")
    head.unionByName(entries.withColumn("at", F.lit(2))).coalesce(1).sortWithinPartitions("at").select("value").write.text(f"{path}/matrix")
    return readers.matrix_market(spark, f"{path}/matrix", f"{path}/rows", f"{path}/columns")


def bundle_round_trip(spark, d):
    """A bundle of points, cell outlines, cells and counts, written, read with its references checked, and put together by cell."""
    path = _path(spark, "bundle")
    shapes = space.polygons(spark, d)
    corners = shapes.select("slide_id", "cell_id", F.posexplode("ring").alias("vertex", "p")).select("slide_id", "cell_id", "vertex", "p.x", "p.y")
    counts = table(spark, d, "orders", ["o_custkey", "o_orderpriority"]).groupBy(F.col("o_custkey").alias("cell_id"), F.col("o_orderpriority").alias("gene")).agg(F.count(F.lit(1)).alias("count"))
    counts = counts.withColumn("slide_id", F.col("cell_id") % 5)
    half = (0.5, 0.0, 100.0, 0.0, 0.5, 0.0)
    cell = [("cell_id", "cells", "cell_id")]
    bundle.write_bundle(spark, path, {
        "cells": bundle.Element(shapes.select("slide_id", "cell_id", "layer")),
        "outlines": bundle.Element(corners, "vertices", half, cell),
        "points": bundle.Element(space.points(spark, d), "points", half),
        "counts": bundle.Element(counts, refers=cell),
    })
    back = bundle.read_bundle(spark, path)
    inside = spatial.count_in_polygons(back["points"], back["outlines"]).groupBy("slide_id", "cell_id").agg(F.sum("count").alias("points"))
    totals = back["counts"].groupBy("slide_id", "cell_id").agg(F.sum("count").alias("counts"))
    shown = back["outlines"].select("slide_id", "cell_id", F.size("ring").alias("corners"), spatial.area(F.col("ring")).alias("area"))
    rows = back["cells"].join(shown, ["slide_id", "cell_id"]).join(totals, ["slide_id", "cell_id"], "left").join(inside, ["slide_id", "cell_id"], "left")
    return rows.select(F.col("slide_id").cast("bigint").alias("slide_id"), "cell_id", "layer", "corners", "area", F.coalesce("counts", F.lit(0)).alias("counts"), F.coalesce("points", F.lit(0)).alias("points"))


NAMES = "bundle_round_trip csv_round_trip csv_concat json_round_trip parquet_by_slide replaced_element appended_new merged_chunks matrix_market".split()
QUERIES = {n: globals()[n] for n in NAMES}
SQL = {
    "bundle_round_trip": f"SELECT c_custkey % 5 AS slide_id, c_custkey AS cell_id, 'layer' || (c_custkey % 3) AS layer, CAST(CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 4 END AS INTEGER) AS corners, CASE WHEN c_custkey % 2 = 0 THEN CAST(187.5 AS DOUBLE) ELSE CAST(200 AS DOUBLE) END AS area, coalesce(n, 0) AS counts, coalesce(k, 0) AS points FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey LEFT JOIN (SELECT cell_id, count(*) AS k FROM ({space._HIT}) h GROUP BY 1) ON cell_id = c_custkey",
    "csv_round_trip": "SELECT c_custkey, c_mktsegment FROM customer",
    "csv_concat": "SELECT p_partkey, p_size FROM part",
    "json_round_trip": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "parquet_by_slide": "SELECT o_orderkey, o_orderstatus, CAST(o_custkey % 7 AS VARCHAR) AS slide_id FROM orders WHERE o_custkey % 7 IN (2, 5)",
    "replaced_element": "SELECT n_nationkey, lower(n_name) AS n_name FROM nation WHERE n_nationkey % 2 = 0",
    "appended_new": "SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 3 <> 0 THEN 1 ELSE 2 END AS INTEGER) AS batch FROM supplier WHERE s_suppkey % 3 <> 0 OR s_suppkey % 2 = 0",
    "merged_chunks": "SELECT p_partkey, p_brand, CAST(p_partkey % 3 AS INTEGER) AS chunk FROM part",
    "matrix_market": "SELECT 'r' || n_regionkey AS gene, 'n' || n_nationkey AS cell, n_nationkey + CAST(0.5 AS DOUBLE) AS count FROM nation",
}

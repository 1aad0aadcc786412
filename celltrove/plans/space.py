"""Spatial queries: boxes from orders, polygons from customers, points from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import overlay
from ..operators import relational as R
from ..operators import spatial as S
from ..operators import windows as W
from ..sources.readers import table

SIDE = 3000
STATUS = ("F", "O", "P")


def boxes(spark, d):
    """Cell boxes on slides of SIDE x SIDE pixels; some touch patch edges exactly."""
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    x, y = F.col("o_orderkey") * 37 % (SIDE - 60), F.col("o_orderkey") * 101 % (SIDE - 60)
    w = 10 + F.col("o_custkey") % 50
    return o.select((F.col("o_custkey") % 7).alias("slide_id"), F.col("o_orderkey").alias("cell_id"), "o_orderstatus", x.alias("xmin"), y.alias("ymin"), (x + w).alias("xmax"), (y + w).alias("ymax"))


def grid(spark, d):
    slides = table(spark, d, "nation", ["n_nationkey"]).filter("n_nationkey < 7").select(F.col("n_nationkey").cast("bigint").alias("slide_id"), F.lit(SIDE).alias("x_size"), (F.lit(SIDE) - F.col("n_nationkey") * 100).alias("y_size"))
    return S.patch_grid(slides)


def _pairs(spark, d):
    return S.patch_cells(boxes(spark, d), grid(spark, d))


def patch_grid(spark, d):
    return grid(spark, d).withColumn("name", S.published_patch_id(F.col("slide_id"), F.col("patch_id"))).select("slide_id", "patch_id", "xmin", "ymin", "xmax", "ymax", "name")


def patch_cell_bbox(spark, d):
    return _pairs(spark, d).select("slide_id", "patch_id", "cell_id")


def cells_per_patch(spark, d):
    from ..operators.aggregates import list_of

    lists = list_of(_pairs(spark, d), ["slide_id", "patch_id"], "cell_id", "cells")
    return lists.select("slide_id", "patch_id", scalars.comma_list(F.col("cells")).alias("cells"))


def patch_cell_count(spark, d):
    return S.patch_counts(_pairs(spark, d), ["slide_id", "patch_id"], "o_orderstatus", STATUS)


def patch_metric_range(spark, d):
    rows = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_discount"]).withColumn("jaccard", F.when(F.col("l_partkey") % 5 == 0, -1.0).otherwise(F.col("l_discount")))
    return R.metric_range(rows.select("l_orderkey", "l_linenumber", "l_partkey", "jaccard"), "jaccard", 0.0, 0.05)


def patch_veto_unknown(spark, d):
    rows = table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_returnflag"])
    return R.veto(rows, ["l_orderkey"], F.col("l_returnflag") == "R")


def polygons(spark, d):
    """Triangles and diamonds, one for each customer, in three layers."""
    c = table(spark, d, "customer", ["c_custkey"])
    x, y = (F.col("c_custkey") * 53 % 900).cast("double"), (F.col("c_custkey") * 71 % 900).cast("double")
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    ring = F.when(F.col("c_custkey") % 2 == 0, F.array(at(0, 0), at(40, 10), at(10, 40))).otherwise(F.array(at(20, 0), at(40, 20), at(20, 40), at(0, 20)))
    layer = (F.col("c_custkey") % 3).cast("int")
    return c.select((F.col("c_custkey") % 5).alias("slide_id"), F.col("c_custkey").alias("cell_id"), F.concat(F.lit("layer"), layer.cast("string")).alias("layer"), layer.alias("priority"), ring.alias("ring"))


def points(spark, d):
    e = table(spark, d, "events", ["event_id", "event_type"])
    return e.select((F.col("event_id") % 5).alias("slide_id"), F.col("event_id").alias("point_id"), (F.col("event_id") * 29 % 940).cast("double").alias("x"), (F.col("event_id") * 43 % 940).cast("double").alias("y"), F.col("event_type").alias("feature_name"))


def transcript_counts(spark, d):
    return S.count_in_polygons(points(spark, d), polygons(spark, d))


def point_label_priority(spark, d):
    return S.label_points(points(spark, d), polygons(spark, d))


def geometry_key_join(spark, d):
    p = polygons(spark, d)
    a, b = p.filter("cell_id % 3 <> 0"), p.filter("cell_id % 2 = 0").withColumn("cell_id", F.col("cell_id") + 1_000_000)
    return R.geometry_join(a, b)


def affine(spark, d):
    x, y = scalars.affine(F.col("x"), F.col("y"), (0.5, -0.25, 10.0, 0.125, 2.0, -3.0))
    return points(spark, d).select("point_id", x.alias("x"), y.alias("y"))


def instance_map(spark, d):
    line = table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"])
    channel = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    px = line.select((F.col("l_orderkey") % 40).alias("patch_id"), (F.col("l_partkey") % 16).alias("row"), (F.col("l_suppkey") % 16).alias("col"), channel.alias("channel"), (F.col("l_orderkey") % 11).alias("value"))
    px = px.groupBy("patch_id", "row", "col", "channel").agg(F.max("value").alias("value"))
    return W.instance_map(px, ["patch_id"], "row", "col", "channel", "value")


def _box_ring(shift_x=0, shift_y=0, scale=1.0):
    at = lambda x, y: F.struct(((F.col(x) - shift_x) / F.lit(scale)).cast("double").alias("x"), ((F.col(y) - shift_y) / F.lit(scale)).cast("double").alias("y"))
    return F.array(at("xmin", "ymin"), at("xmax", "ymin"), at("xmax", "ymax"), at("xmin", "ymax"))


def patch_cell_clip(spark, d):
    """Exact refinement: the part of each cell in each patch it meets, and its area."""
    cells = boxes(spark, d).withColumn("ring", _box_ring()).drop("o_orderstatus")
    pairs = S.grid_cells(cells).select("slide_id", "i", "k", "cell_id", "ring").join(grid(spark, d), ["slide_id", "i", "k"])
    clipped = S.clip_to_patch(pairs).withColumn("area", S.area(F.col("clipped")))
    return clipped.filter("area > 0").select("slide_id", "patch_id", "cell_id", F.size("clipped").alias("corners"), "area")


def concave_cells(spark, d):
    """A U for each customer, on slides of SIDE x SIDE pixels."""
    c = table(spark, d, "customer", ["c_custkey"])
    x, y = (F.col("c_custkey") * 97 % (SIDE - 120)).cast("double"), (F.col("c_custkey") * 131 % (SIDE - 120)).cast("double")
    u = [(0, 0), (90, 0), (90, 90), (60, 90), (60, 30), (30, 30), (30, 90), (0, 90)]
    ring = F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in u])
    return c.select((F.col("c_custkey") % 7).alias("slide_id"), F.col("c_custkey").alias("cell_id"), x.alias("xmin"), y.alias("ymin"), (x + 90).alias("xmax"), (y + 90).alias("ymax"), ring.alias("ring"))


def clipped_parts(spark, d):
    """Concave cells cut by the patches they meet: parts and area."""
    pairs = S.grid_cells(S.spread_rows(concave_cells(spark, d))).select("slide_id", "i", "k", "cell_id", "ring").join(grid(spark, d), ["slide_id", "i", "k"])
    cut = overlay.clip_parts(pairs)
    return cut.select("slide_id", "patch_id", "cell_id", F.size("parts").alias("n_parts"), F.round(overlay.parts_area("parts"), 6).alias("area"))


def repaired_rings(spark, d):
    """A ring of each customer that crosses itself once, as two parts."""
    c = table(spark, d, "customer", ["c_custkey"])
    w = (F.col("c_custkey") % 30 + 10).cast("double")
    x = F.col("c_custkey").cast("double")
    at = lambda a, b: F.struct((x + a).alias("x"), F.lit(b).cast("double").alias("y"))
    ring = F.array(at(F.lit(0.0), F.lit(0.0)), at(w, w), at(w, F.lit(0.0)), at(F.lit(0.0), w))
    parts = overlay.repair(c.select(F.col("c_custkey").alias("cell_id"), ring.alias("ring")))
    return parts.select("cell_id", F.size("parts").alias("n_parts"), F.round(overlay.parts_area("parts"), 6).alias("area"))


PIXEL = 8


def rasterise_cells(spark, d):
    """Cells drawn in their patches, in pixels of PIXEL x PIXEL, one channel for each status."""
    channel = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    cells = S.spread_rows(boxes(spark, d)).withColumn("channel", channel).withColumn("value", F.col("cell_id") % 1000 + 1)
    pairs = S.grid_cells(cells).join(grid(spark, d).select("slide_id", "i", "k", "patch_id", F.col("xmin").alias("px"), F.col("ymin").alias("py")), ["slide_id", "i", "k"])
    return S.rasterise(pairs.withColumn("ring", _box_ring(F.col("px"), F.col("py"), float(PIXEL))), S.WIDTH // PIXEL)


NAMES = "clipped_parts repaired_rings patch_cell_clip rasterise_cells patch_grid patch_cell_bbox cells_per_patch patch_cell_count patch_metric_range patch_veto_unknown transcript_counts point_label_priority geometry_key_join affine instance_map".split()
QUERIES = {n: globals()[n] for n in NAMES}

_BOX = f"SELECT o_custkey % 7 AS slide_id, o_orderkey AS cell_id, o_orderstatus, o_orderkey * 37 % {SIDE - 60} AS xmin, o_orderkey * 101 % {SIDE - 60} AS ymin, o_orderkey * 37 % {SIDE - 60} + 10 + o_custkey % 50 AS xmax, o_orderkey * 101 % {SIDE - 60} + 10 + o_custkey % 50 AS ymax FROM orders"
_GRID = f"SELECT CAST(n_nationkey AS BIGINT) AS slide_id, CAST(i * ny + k AS BIGINT) AS patch_id, CAST(i * 192 AS INTEGER) AS xmin, CAST(k * 192 AS INTEGER) AS ymin, CAST(i * 192 + 256 AS INTEGER) AS xmax, CAST(k * 192 + 256 AS INTEGER) AS ymax FROM (SELECT *, unnest(range(CAST(ny AS BIGINT))) AS k FROM (SELECT n_nationkey, CAST(ceil(({SIDE} - n_nationkey * 100 - 64) / CAST(192 AS DOUBLE)) AS BIGINT) AS ny, unnest(range(CAST(ceil(({SIDE} - 64) / CAST(192 AS DOUBLE)) AS BIGINT))) AS i FROM nation WHERE n_nationkey < 7))"
_PAIR = f"SELECT g.slide_id, g.patch_id, b.cell_id, b.o_orderstatus FROM ({_GRID}) g JOIN ({_BOX}) b ON g.slide_id = b.slide_id AND b.xmin <= g.xmax AND b.xmax >= g.xmin AND b.ymin <= g.ymax AND b.ymax >= g.ymin"
_POINT = "SELECT event_id % 5 AS slide_id, event_id AS point_id, CAST(event_id * 29 % 940 AS DOUBLE) AS x, CAST(event_id * 43 % 940 AS DOUBLE) AS y, event_type AS feature_name FROM events"
# Half planes of the counter-clockwise triangles and diamonds; edges count.
_INSIDE = "CASE WHEN cell_id % 2 = 0 THEN 40 * (p.y - y0) - 10 * (p.x - x0) >= 0 AND -30 * (p.y - y0 - 10) - 30 * (p.x - x0 - 40) >= 0 AND -10 * (p.y - y0 - 40) + 40 * (p.x - x0 - 10) >= 0 ELSE abs(p.x - x0 - 20) + abs(p.y - y0 - 20) <= 20 END"
_HIT = f"SELECT p.*, q.cell_id, q.cell_id % 3 AS priority FROM ({_POINT}) p JOIN (SELECT c_custkey AS cell_id, c_custkey % 5 AS slide_id, c_custkey * 53 % 900 AS x0, c_custkey * 71 % 900 AS y0 FROM customer) q ON p.slide_id = q.slide_id AND {_INSIDE}"
# A U is a bar below and two arms; what is cut off below leaves the arms apart.
_WITHIN = "greatest(0, least(x + {1}, g.xmax) - greatest(x + {0}, g.xmin)) * greatest(0, least(y + {3}, g.ymax) - greatest(y + {2}, g.ymin))"
_ARMS = f"SELECT g.slide_id, g.patch_id, u.cell_id, {_WITHIN.format(0, 90, 0, 30)} AS bar, {_WITHIN.format(0, 30, 30, 90)} AS a, {_WITHIN.format(60, 90, 30, 90)} AS b FROM ({_GRID}) g JOIN (SELECT c_custkey AS cell_id, c_custkey % 7 AS slide_id, CAST(c_custkey * 97 % {SIDE - 120} AS DOUBLE) AS x, CAST(c_custkey * 131 % {SIDE - 120} AS DOUBLE) AS y FROM customer) u ON g.slide_id = u.slide_id AND x < g.xmax AND x + 90 > g.xmin AND y < g.ymax AND y + 90 > g.ymin"
SQL = {
    "clipped_parts": f"SELECT slide_id, patch_id, cell_id, CAST(CASE WHEN bar > 0 THEN 1 ELSE CAST(a > 0 AS INTEGER) + CAST(b > 0 AS INTEGER) END AS INTEGER) AS n_parts, bar + a + b AS area FROM ({_ARMS}) q WHERE bar + a + b > 0",
    "repaired_rings": "SELECT c_custkey AS cell_id, CAST(2 AS INTEGER) AS n_parts, CAST((c_custkey % 30 + 10) * (c_custkey % 30 + 10) AS DOUBLE) / 2 AS area FROM customer",
    "patch_grid": f"SELECT *, slide_id || '_' || patch_id AS name FROM ({_GRID}) g",
    "patch_cell_clip": f"SELECT slide_id, patch_id, cell_id, CAST(4 AS INTEGER) AS corners, CAST(w AS DOUBLE) * h AS area FROM (SELECT g.slide_id, g.patch_id, b.cell_id, least(b.xmax, g.xmax) - greatest(b.xmin, g.xmin) AS w, least(b.ymax, g.ymax) - greatest(b.ymin, g.ymin) AS h FROM ({_GRID}) g JOIN ({_BOX}) b ON g.slide_id = b.slide_id AND b.xmin < g.xmax AND b.xmax > g.xmin AND b.ymin < g.ymax AND b.ymax > g.ymin)",
    "rasterise_cells": f"WITH p AS (SELECT g.slide_id, g.patch_id, CASE b.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS channel, b.cell_id % 1000 + 1 AS value, (b.xmin - g.xmin) / CAST({PIXEL} AS DOUBLE) AS x0, (b.xmax - g.xmin) / CAST({PIXEL} AS DOUBLE) AS x1, (b.ymin - g.ymin) / CAST({PIXEL} AS DOUBLE) AS y0, (b.ymax - g.ymin) / CAST({PIXEL} AS DOUBLE) AS y1 FROM ({_GRID}) g JOIN ({_BOX}) b ON g.slide_id = b.slide_id AND b.xmin <= g.xmax AND b.xmax >= g.xmin AND b.ymin <= g.ymax AND b.ymax >= g.ymin), n AS (SELECT CAST(unnest(range(256 // {PIXEL})) AS INTEGER) AS v) SELECT slide_id, patch_id, r.v AS row, c.v AS col, channel, max(value) AS value FROM p JOIN n r ON r.v + CAST(0.5 AS DOUBLE) >= y0 AND r.v + CAST(0.5 AS DOUBLE) < y1 JOIN n c ON c.v + CAST(0.5 AS DOUBLE) BETWEEN x0 AND x1 GROUP BY ALL",
    "patch_cell_bbox": f"SELECT slide_id, patch_id, cell_id FROM ({_PAIR}) p",
    "cells_per_patch": f"SELECT slide_id, patch_id, string_agg(CAST(cell_id AS VARCHAR), ',' ORDER BY cell_id) AS cells FROM ({_PAIR}) p GROUP BY ALL",
    "patch_cell_count": f"SELECT slide_id, patch_id, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM ({_PAIR}) p GROUP BY ALL",
    "patch_metric_range": "SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 5 = 0 THEN CAST(-1 AS DOUBLE) ELSE l_discount END AS jaccard FROM lineitem) WHERE jaccard BETWEEN 0 AND CAST(0.05 AS DOUBLE)",
    "patch_veto_unknown": "SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    "transcript_counts": f"SELECT slide_id, cell_id, feature_name, count(*) AS count FROM ({_HIT}) h GROUP BY ALL",
    "point_label_priority": f"SELECT p.slide_id, p.point_id, coalesce('layer' || m, 'NoAnnot') AS label FROM ({_POINT}) p LEFT JOIN (SELECT point_id, min(priority) AS m FROM ({_HIT}) h GROUP BY 1) h USING (point_id)",
    "geometry_key_join": "WITH p AS (SELECT c_custkey AS id, c_custkey % 2 AS k, c_custkey * 53 % 900 AS x, c_custkey * 71 % 900 AS y FROM customer) SELECT a.id AS left_id, b.id + 1000000 AS right_id FROM (SELECT * FROM p WHERE id % 3 <> 0) a FULL JOIN (SELECT * FROM p WHERE k = 0) b ON a.k = b.k AND a.x = b.x AND a.y = b.y",
    "affine": f"SELECT point_id, x * CAST(0.5 AS DOUBLE) + y * CAST(-0.25 AS DOUBLE) + 10 AS x, x * CAST(0.125 AS DOUBLE) + y * 2 - 3 AS y FROM ({_POINT}) p",
    "instance_map": "WITH px AS (SELECT l_orderkey % 40 AS patch_id, l_partkey % 16 AS row, l_suppkey % 16 AS col, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS channel, max(l_orderkey % 11) AS value FROM lineitem GROUP BY ALL), k AS (SELECT * FROM px WHERE value <> 0 QUALIFY row_number() OVER (PARTITION BY patch_id, row, col ORDER BY channel DESC) = 1) SELECT patch_id, row, col, dense_rank() OVER (PARTITION BY patch_id ORDER BY channel, value) AS instance, CAST(channel + 1 AS INTEGER) AS type FROM k",
}

"""Patch grids, box joins, point-in-polygon, clipping and rasterising."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..scratch import drop, written
from ..workers import ship

WIDTH, OVERLAP = 256, 64


def axes(ring: str) -> tuple[Column, Column]:
    return F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])


def patch_grid(extents: DataFrame, width: int = WIDTH, overlap: int = OVERLAP) -> DataFrame:
    """(slide_id, patch_id, i, k, xmin, ymin, xmax, ymax) from (slide_id, x_size, y_size): ceil((L - overlap) / stride) patches a side."""
    stride = width - overlap
    number = lambda c: F.greatest(F.ceil((F.col(c) - overlap) / F.lit(stride)), F.lit(1)).cast("int")
    sized = extents.withColumn("_nx", number("x_size")).withColumn("_ny", number("y_size"))
    cells = sized.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("_nx") - 1))).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("_ny") - 1)))
    x, y = F.col("i") * stride, F.col("k") * stride
    ident = (F.col("i").cast("bigint") * F.col("_ny") + F.col("k")).alias("patch_id")
    return cells.select("slide_id", ident, "i", "k", x.alias("xmin"), y.alias("ymin"), (x + width).alias("xmax"), (y + width).alias("ymax"))


def published_patch_id(slide_id: Column, patch_id: Column) -> Column:
    return F.concat_ws("_", slide_id, patch_id)


def grid_cells(boxes: DataFrame, width: int = WIDTH, overlap: int = OVERLAP) -> DataFrame:
    """Each box once for every grid patch (i, k) it meets; touching edges meet.

    Exploding the box side turns the box intersection into an equi-join; a box narrower
    than the stride less the overlap meets at most two patches a side.
    """
    stride = width - overlap
    low = lambda c: F.greatest(F.ceil((F.col(c) - width) / F.lit(stride)), F.lit(0)).cast("int")
    high = lambda c: F.floor(F.col(c) / F.lit(stride)).cast("int")
    ranged = boxes.withColumn("_i0", low("xmin")).withColumn("_i1", high("xmax")).withColumn("_k0", low("ymin")).withColumn("_k1", high("ymax"))
    ranged = ranged.filter("_i0 <= _i1 AND _k0 <= _k1")  # sequence() would count down
    spread = ranged.withColumn("i", F.explode(F.sequence("_i0", "_i1"))).withColumn("k", F.explode(F.sequence("_k0", "_k1")))
    return spread.drop("_i0", "_i1", "_k0", "_k1")


def patch_cells(boxes: DataFrame, patches: DataFrame, width: int = WIDTH, overlap: int = OVERLAP) -> DataFrame:
    """Boxes joined with the grid patches of their slide that they meet; patch columns but the keys are kept."""
    side = patches.select("slide_id", "i", "k", "patch_id")
    return grid_cells(boxes, width, overlap).join(side, ["slide_id", "i", "k"])


#: Ids of equal boxes that travel as one row.
BOX_IDS = 1024


def box_join(a: DataFrame, b: DataFrame, cell: float, a_id: str, b_id: str) -> DataFrame:
    """(slide_id, a_id, b_id): any boxes that meet, through coarse buckets, each pair once.

    Equal boxes of a slide are met once for all, as rows with lists of about BOX_IDS ids at most; the
    pairs of their ids are made last, as rows of the result.  A pair of boxes is reported by the
    bucket of the lower left corner of the common part.
    """
    corners = ["xmin", "ymin", "xmax", "ymax"]
    box = ["slide_id", *corners]

    def spread(df: DataFrame, name: str, ident: str) -> DataFrame:
        at = lambda c: F.floor(F.col(c) / F.lit(cell)).cast("bigint")
        rows = df.select(*box, F.col(ident).alias("_id")).filter(F.col("slide_id").isNotNull() & (at("xmin") <= at("xmax")) & (at("ymin") <= at("ymax")))
        # Boxes of more ids than BOX_IDS, at most one for so many rows; their ids are dealt to several lists.
        many = rows.groupBy(*box).agg(F.ceil(F.count(F.lit(1)) / F.lit(BOX_IDS)).alias("_parts")).filter("_parts > 1")
        part = F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_parts")), F.lit(0).cast("bigint")).alias("_part")
        null = F.array_repeat(F.lit(None).cast(rows.schema["_id"].dataType), F.count_if(F.col("_id").isNull()).cast("int"))
        lists = rows.join(many, box, "left").groupBy(*box, part).agg(F.concat(F.collect_list("_id"), null).alias(f"_{name}_ids"))
        out = lists.select("slide_id", F.struct(*corners).alias(f"_{name}"), f"_{name}_ids", *[at(c).alias(f"_{c}") for c in corners])
        out = out.withColumn("_x", F.explode(F.sequence("_xmin", "_xmax"))).withColumn("_y", F.explode(F.sequence("_ymin", "_ymax")))
        return out.drop(*[f"_{c}" for c in corners])

    both = spread(a, "a", a_id).join(spread(b, "b", b_id), ["slide_id", "_x", "_y"])
    low = {c: F.greatest(F.col("_a")[f"{c}min"], F.col("_b")[f"{c}min"]) for c in "xy"}
    high = {c: F.least(F.col("_a")[f"{c}max"], F.col("_b")[f"{c}max"]) for c in "xy"}
    meets = (low["x"] <= high["x"]) & (low["y"] <= high["y"])
    own = (F.floor(low["x"] / cell) == F.col("_x")) & (F.floor(low["y"] / cell) == F.col("_y"))
    met = both.filter(meets & own).select("slide_id", "_a_ids", "_b_ids")
    return met.select("slide_id", F.explode("_a_ids").alias(a_id), "_b_ids").select("slide_id", a_id, F.explode("_b_ids").alias(b_id))


def edges_of(ring: Column) -> Column:
    """Edges (ax, ay, bx, by) of a ring, the closing one included."""
    n = F.size(ring)
    after = lambda i: F.when(i + 1 < n, i + 1).otherwise(F.lit(0))
    return F.transform(ring, lambda p, i: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), F.get(ring, after(i))["x"].alias("bx"), F.get(ring, after(i))["y"].alias("by")))


def area(ring: Column) -> Column:
    """Area of a ring, whichever way it runs."""
    return F.abs(F.aggregate(edges_of(ring), F.lit(0.0), lambda a, e: a + (e["ax"] * e["by"] - e["bx"] * e["ay"]).cast("double"))) / 2


def inside(x: Column, y: Column, edges: Column) -> Column:
    """Whether (x, y) is in the ring of ``edges``, by crossing number; points on an edge count as inside."""
    cross = lambda e: (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
    within = lambda e: x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
    edge = F.exists(edges, lambda e: (cross(e) == 0) & within(e))
    over = lambda e: ((e["ay"] > y) != (e["by"] > y)) & ((cross(e) > 0) == (e["by"] > e["ay"]))
    odd = F.size(F.filter(edges, over)) % 2 == 1
    return edge | odd


def spread_rows(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan with fewer splits than the cluster has cores; larger ones stay as they are."""
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df  # shuffled rows are spread already, and asking for their partitions would run the shuffle
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def points_in(points: DataFrame, polygons: DataFrame, cell: float | None = None) -> DataFrame:
    """Points (slide_id, x, y, ...) with the columns of every polygon (slide_id, ring, ...) of their slide that holds them.

    Polygons are put in classes by size, each a grid whose side is the power of two (times
    ``cell``, if given) that is not less than their box; so one covers at most four buckets, whatever
    the other sizes are.  A point has a bucket in each class, and the join is an equi-join.  One
    condition tests the box first and the ring only where the box holds the point.
    Points without a place, and polygons of fewer than three points or with one missing, meet nothing.
    """
    base = float(cell or 1.0)
    xs, ys = axes("ring")
    box = {"_xl": F.array_min(xs), "_xh": F.array_max(xs), "_yl": F.array_min(ys), "_yh": F.array_max(ys)}
    whole = (F.size("ring") >= 3) & F.forall("ring", lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    boxes = polygons.filter(whole).withColumns(box)
    side = F.greatest(F.col("_xh") - F.col("_xl"), F.col("_yh") - F.col("_yl"), F.lit(base)).cast("double")
    boxes = boxes.withColumn("_class", F.ceil(F.log2(side / base) - 1e-9).cast("int"))
    # Bounded by the exponents of a double; some twenty on a slide.
    classes = sorted(boxes.agg(F.collect_set("_class")).first()[0])
    at = lambda c: F.floor(F.col(c) / (F.lit(base) * F.pow(F.lit(2.0), "_class"))).cast("bigint")
    buckets = boxes.withColumn("_edges", edges_of(F.col("ring"))).drop("ring")
    buckets = buckets.withColumn("_x", F.explode(F.sequence(at("_xl"), at("_xh")))).withColumn("_y", F.explode(F.sequence(at("_yl"), at("_yh"))))
    spread = spread_rows(points).withColumn("_class", F.explode(F.array(*map(F.lit, classes)).cast("array<int>"))).withColumn("_x", at("x")).withColumn("_y", at("y"))
    p, q = spread.alias("p"), buckets.alias("q")
    same = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in ("slide_id", "_class", "_x", "_y")]
    held = F.when(F.col("x").between(F.col("_xl"), F.col("_xh")) & F.col("y").between(F.col("_yl"), F.col("_yh")), inside(F.col("x"), F.col("y"), F.col("_edges"))).otherwise(F.lit(False))
    hits = p.join(q, reduce(Column.__and__, [*same, held]))
    return hits.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"q.{c}") for c in polygons.columns if c not in ("slide_id", "ring")])


def label_points(points: DataFrame, polygons: DataFrame, cell: float | None = None, default: str = "NoAnnot", point_id: str = "point_id") -> DataFrame:
    """(slide_id, point_id, label) of each point (x, y): the layer of least priority that holds it, else the default.

    ``polygons``: slide_id, layer, priority, ring array<struct<x,y>>.  Places and rings that repeat are met once.
    """
    shapes = polygons.groupBy("slide_id", "ring").agg(F.min(F.struct("priority", "layer")).alias("_b"))
    hits = points_in(points.select("slide_id", "x", "y").distinct(), shapes, cell)
    best = hits.groupBy("slide_id", "x", "y").agg(F.min("_b").alias("_b"))
    return points.select("slide_id", point_id, "x", "y").join(best, ["slide_id", "x", "y"], "left").select("slide_id", point_id, F.coalesce("_b.layer", F.lit(default)).alias("label"))


def count_in_polygons(points: DataFrame, polygons: DataFrame, cell: float | None = None, feature: str = "feature_name") -> DataFrame:
    """(slide_id, cell_id, feature, count) of the points in each cell polygon; a point in two cells counts in both.

    Points of a feature that share a place are one row with their number, and cells that share a ring
    are one polygon; so the pairs met are those of different places and rings, and grow no faster than these.
    """
    places = points.groupBy("slide_id", "x", "y", feature).agg(F.count(F.lit(1)).alias("_n"))
    shapes = polygons.select("slide_id", "ring", F.col("ring").alias("_shape")).distinct()
    hits = points_in(places, shapes, cell).groupBy("slide_id", "_shape", feature).agg(F.sum("_n").alias("_n"))
    cells = polygons.select("slide_id", "cell_id", F.col("ring").alias("_shape"))
    return cells.join(hits, ["slide_id", "_shape"]).groupBy("slide_id", "cell_id", feature).agg(F.sum("_n").alias("count"))


def patch_counts(pairs: DataFrame, patch: Sequence[str], category: str, categories: Sequence[str]) -> DataFrame:
    """Exact number of cells of each category in each patch, 0 where there is none; an unknown category is an error."""
    known = F.col(category).isin(list(categories))
    checked = pairs.withColumn("_ok", F.when(F.coalesce(known, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit("category is not in the scheme"))))
    return checked.filter("_ok").groupBy(*patch).agg(*[F.count_if(F.col(category) == c).alias(c) for c in categories])


def clip_to_patch(pairs: DataFrame, out: str = "clipped") -> DataFrame:
    """Add the part of ``ring`` inside the patch box (xmin..ymax), cut side by side; pairs whose part is empty go.

    The area is exact for every ring; the parts of a concave one stay joined by edges along the side.
    """
    kind = "array<struct<x: double, y: double>>"
    rows = pairs.withColumn(out, F.coalesce(F.col("ring").cast(kind), F.array().cast(kind)))
    for axis, limit, sign in (("x", "xmin", 1), ("x", "xmax", -1), ("y", "ymin", 1), ("y", "ymax", -1)):
        over = lambda e, p: (e[f"{p}{axis}"] - F.col(limit)) * sign  # noqa: B023, E731
        crossing = lambda e, c: e[f"a{c}"] + over(e, "a") / (over(e, "a") - over(e, "b")) * (e[f"b{c}"] - e[f"a{c}"])  # noqa: B023, E731
        none = F.array().cast(kind)

        def kept(e: Column) -> Column:
            own = F.when(over(e, "a") >= 0, F.array(F.struct(e["ax"].alias("x"), e["ay"].alias("y")))).otherwise(none)  # noqa: B023
            cut = F.when(over(e, "a") * over(e, "b") < 0, F.array(F.struct(crossing(e, "x").alias("x"), crossing(e, "y").alias("y")))).otherwise(none)  # noqa: B023
            return F.concat(own, cut)

        # As a generator, so that no later filter is pushed below the step and writes it out again.
        rows = rows.withColumn(out, F.explode(F.filter(F.array(F.flatten(F.transform(edges_of(F.col(out)), kept))), lambda r: F.size(r) > 0)))
    return rows


def signed_area(ring: Column) -> Column:
    return F.aggregate(edges_of(ring), F.lit(0.0), lambda a, e: a + (e["ax"] * e["by"] - e["bx"] * e["ay"]).cast("double")) / 2


def _slopes(ring: Column) -> Column:
    """Edges of a ring that are not vertical, from left to right, each with the sign of its way: struct(l, h, y, m, s)."""
    kind = "array<struct<x: double, y: double>>"
    sloped = F.filter(edges_of(ring.cast(kind)), lambda e: e["ax"] != e["bx"])
    ahead = lambda e: e["ax"] < e["bx"]
    m = lambda e: (e["by"] - e["ay"]) / (e["bx"] - e["ax"])
    return F.transform(sloped, lambda e: F.struct(F.least(e["ax"], e["bx"]).alias("l"), F.greatest(e["ax"], e["bx"]).alias("h"), F.when(ahead(e), e["ay"]).otherwise(e["by"]).alias("y"), m(e).alias("m"), F.when(ahead(e), 1.0).otherwise(-1.0).alias("s")))


def _shared_below(p: Column, q: Column, low: Column) -> Column:
    """The area that the strips between two edges and the line y = ``low`` share, with the product of their signs."""
    left, right = F.greatest(p["l"], q["l"]), F.least(p["h"], q["h"])
    at = lambda e, x: e["y"] + e["m"] * (x - e["l"])
    ends = F.struct(at(p, left).alias("p0"), at(p, right).alias("p1"), at(q, left).alias("q0"), at(q, right).alias("q1"), (right - left).alias("w"))

    def strip(t: Column) -> Column:
        d0, d1 = t["p0"] - t["q0"], t["p1"] - t["q1"]
        # Where the edges cross, the lower one bends, so there is a triangle above the straight line between its ends.
        bend = F.when(d0 * d1 < 0, -d0 * d1 / F.abs(d0 - d1)).otherwise(0.0)
        return t["w"] * ((F.least(t["p0"], t["q0"]) + F.least(t["p1"], t["q1"]) + bend) / 2 - low)

    # As a lambda's argument, so that the ends are not written out again wherever they are used.
    return F.when(left < right, p["s"] * q["s"] * F.get(F.transform(F.array(ends), strip), F.lit(0))).otherwise(0.0)


def _shared(p: Column, q: Column, low: Column) -> Column:
    each = lambda e: F.aggregate(q, F.lit(0.0), lambda a, f: a + _shared_below(e, f, low))
    return F.abs(F.aggregate(p, F.lit(0.0), lambda a, e: a + each(e)))


def overlap_area(ring: Column, other: Column) -> Column:
    """Area that two simple rings share, concave or not, whichever way they run.

    A ring is the sum of the strips below its edges, with the signs of their ways; so the shared area is
    that of all pairs of strips, one from each ring, which is the area under the lower of two edges.
    Rings of fewer than three points, or missing ones, share 0.
    """
    low = F.least(F.array_min(axes(ring)[1]), F.array_min(axes(other)[1])).cast("double")
    return F.when((F.size(ring) >= 3) & (F.size(other) >= 3), _shared(_slopes(ring), _slopes(other), low)).otherwise(F.lit(0.0))


#: Pairs of edges that are in memory at once.
EDGE_PAIRS = 1 << 18


def _measured(p: pa.Array, q: pa.Array, low: pa.Array) -> pa.Array:
    """``_shared`` of two columns of ``_slopes``, EDGE_PAIRS pairs of edges at a time."""
    edges = [np.column_stack([f.to_numpy(zero_copy_only=False) for f in x.flatten().flatten()]) for x in (p, q)]
    sizes = [pc.list_value_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (p, q)]
    starts = [np.cumsum(n) - n for n in sizes]
    low, total = low.to_numpy(zero_copy_only=False), np.zeros(len(p))
    # Edges of p, each with the pair of rings it belongs to; they meet all edges of q.
    ring = np.repeat(np.arange(len(p)), sizes[0])
    ends = np.cumsum(sizes[1][ring])
    at = 0
    while at < len(ring):
        till = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + EDGE_PAIRS, "right")))
        number = sizes[1][ring[at:till]]
        i = np.repeat(np.arange(at, till), number)
        j = starts[1][ring[i]] + np.arange(len(i)) - np.repeat(np.cumsum(number) - number, number)
        (l, h, y, m, s), (k, g, z, n, t) = edges[0][i].T, edges[1][j].T
        left, right = np.maximum(l, k), np.minimum(h, g)
        p0, p1, q0, q1 = y + m * (left - l), y + m * (right - l), z + n * (left - k), z + n * (right - k)
        d0, d1 = p0 - q0, p1 - q1
        crosses = d0 * d1 < 0
        bend = np.where(crosses, -d0 * d1 / np.where(crosses, np.abs(d0 - d1), 1.0), 0.0)
        strip = s * t * (right - left) * ((np.minimum(p0, q0) + np.minimum(p1, q1) + bend) / 2 - low[ring[i]])
        total += np.bincount(ring[i], np.where(left < right, strip, 0.0), len(p))
        at = till
    return pa.array(np.abs(total))


def overlaps(cells: DataFrame, cell: float, slide: str = "slide_id", key: str = "cell_id", digits: int | None = None) -> DataFrame:
    """(slide, a, b, shared, share), a < b: pairs of cells of a slide whose rings share an area, and its share of the smaller one.

    Pairs are found by the boxes' grid of side ``cell``, and measured in the bucket that they meet in, where
    the box's row has the ring's edges; so no pair is shuffled.  Cells of one ring are one row with lists of at most
    BOX_IDS ids, so rings are measured once for all their copies, and the pairs of ids are made last.  Both areas
    are rounded to ``digits``, if given.  Cells are unique by (slide, key).
    """
    ship(cells.sparkSession)
    xs, ys = axes("ring")
    at = lambda c: F.floor(F.col(c) / F.lit(cell)).cast("bigint")
    # Rings and buckets are dealt by number and not merged into few tasks by size: rows are small, with much work each.
    parts = max(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), cells.sparkSession.sparkContext.defaultParallelism)
    rows = cells.filter(F.size("ring") >= 3).select(F.col(slide).alias("slide_id"), "ring", key).repartition(parts, "slide_id", "ring")
    # All ids of a ring come together once, which are less by far than their pairs.
    rings = rows.groupBy("slide_id", "ring").agg(F.array_sort(F.collect_list(key)).alias("_all")).filter(F.size("_all") > 0)
    lists = F.explode(F.transform(F.sequence(F.lit(1), F.size("_all"), F.lit(BOX_IDS)), lambda i: F.slice("_all", i, BOX_IDS))).alias("_ids")
    sized = rings.select("slide_id", lists, area(F.col("ring")).alias("_area"), _slopes(F.col("ring")).alias("_e"), *[f(v).cast("double").alias(n) for n, f, v in (("xl", F.array_min, xs), ("xh", F.array_max, xs), ("yl", F.array_min, ys), ("yh", F.array_max, ys))])
    spread = sized.withColumn("_k", F.get("_ids", F.lit(0))).withColumn("_x", F.explode(F.sequence(at("xl"), at("xh")))).withColumn("_y", F.explode(F.sequence(at("yl"), at("yh"))))
    dealt = spread.repartition(parts, "slide_id", "_x", "_y")
    p, q = dealt.alias("p"), dealt.alias("q")
    same = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in ("slide_id", "_x", "_y")]
    low = {c: F.greatest(F.col(f"p.{c}l"), F.col(f"q.{c}l")) for c in "xy"}
    # Lists go by their first ids, and a list of several meets itself.
    ordered = (F.col("p._k") < F.col("q._k")) | ((F.col("p._k") == F.col("q._k")) & (F.size("p._ids") > 1))
    # Boxes that only touch share nothing; a pair is met by the bucket of the lower left corner of the common part.
    meets = [ordered, *[low[c] < F.least(F.col(f"p.{c}h"), F.col(f"q.{c}h")) for c in "xy"], *[F.floor(low[c] / cell) == F.col(f"p._{c}") for c in "xy"]]
    met = p.join(q, reduce(Column.__and__, [*same, *meets]))
    met = met.withColumn("shared", F.arrow_udf(_measured, "double")(F.col("p._e"), F.col("q._e"), F.least("p.yl", "q.yl"))).filter("shared > 0")
    rounded = lambda c: c if digits is None else F.round(c, digits)
    share = rounded(F.try_divide("shared", F.least("p._area", "q._area"))).alias("share")
    found = met.select(F.col("p.slide_id").alias(slide), F.col("p._ids").alias("_p"), F.col("q._ids").alias("_q"), (F.col("p._k") == F.col("q._k")).alias("_self"), rounded(F.col("shared")).alias("shared"), share)
    ids = found.select(slide, F.explode("_p").alias("_a"), "_q", "_self", "shared", "share").select(slide, "_a", F.explode("_q").alias("_b"), "_self", "shared", "share")
    return ids.filter(~F.col("_self") | (F.col("_a") < F.col("_b"))).select(slide, F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), "shared", "share")


def without_conflicts(cells: DataFrame, pairs: DataFrame, slide: str = "slide_id", key: str = "cell_id", share: float = 0.5) -> DataFrame:
    """``cells`` with ``kept``: of cells that share at least ``share`` of the smaller one's area, the larger stays.

    Cells are gone through by falling area, ties by id, and one that conflicts with a cell that
    stays goes.  Rounds give the same: a cell stays once all larger ones it conflicts with are gone.
    So no pair above the share remains, and every cell that goes conflicts with a larger one that stays.
    """
    rank = cells.select(F.col(slide).alias("s"), F.col(key).alias("u"), F.struct((-F.coalesce(area(F.col("ring")), F.lit(0.0))).alias("n"), F.col(key).alias("k")).alias("r"))
    near = pairs.filter(F.col("share") >= share).select(F.col(slide).alias("s"), F.col("a").alias("u"), F.col("b").alias("v"))
    near = near.join(rank, ["s", "u"]).join(rank.select("s", F.col("u").alias("v"), F.col("r").alias("q")), ["s", "v"])
    # (s, u, v): v is the smaller cell of a conflict.
    arcs = written(near.select("s", F.when(F.col("r") < F.col("q"), F.struct("u", "v")).otherwise(F.struct(F.col("v").alias("u"), F.col("u").alias("v"))).alias("e")).select("s", "e.*"), "conflicts")
    gone, left, made = None, arcs, [arcs]
    while left.limit(1).count():
        # Those that no undecided arc points to stay; what they point to goes, with all its arcs.
        stay = left.select("s", "u").join(left.select("s", F.col("v").alias("u")), ["s", "u"], "left_anti").distinct()
        loses = left.join(stay, ["s", "u"], "left_semi").select("s", "v").distinct()
        now = written(loses if gone is None else gone.unionByName(loses), "gone")
        some = left.join(now, ["s", "v"], "left_anti").join(now.withColumnRenamed("v", "u"), ["s", "u"], "left_anti")
        rest = written(some.join(stay, ["s", "u"], "left_anti"), "conflicts")
        drop(*made, *[gone] if gone is not None else [])
        gone, left, made = now, rest, [rest]
    drop(*made)
    if gone is None:
        return cells.withColumn("kept", F.lit(True))
    lost = gone.select(F.col("s").alias(slide), F.col("v").alias(key), F.lit(False).alias("_kept"))
    return cells.join(lost, [slide, key], "left").withColumn("kept", F.coalesce("_kept", F.lit(True))).drop("_kept")


def resolved(cells: DataFrame, cell: float, slide: str = "slide_id", key: str = "cell_id", share: float = 0.5) -> DataFrame:
    """``cells`` with ``kept``, as ``without_conflicts`` of all ``overlaps``, but of cells with one ring only the first is paired.

    The others go in any case: for the first, if it stays, else for the larger cell that it goes for.
    """
    some = F.coalesce(area(F.col("ring")) > 0, F.lit(False))
    firsts = cells.filter(some).groupBy(slide, "ring").agg(F.min(key).alias(key))
    stay = without_conflicts(firsts, overlaps(firsts, cell, slide, key), slide, key, share).filter("kept").select(slide, key, F.lit(True).alias("_stays"))
    return cells.join(stay, [slide, key], "left").withColumn("kept", ~some | F.coalesce("_stays", F.lit(False))).drop("_stays")


def rasterise(rings: DataFrame, width: int = WIDTH, order: str | None = None) -> DataFrame:
    """(slide_id, patch_id, row, col, channel, value): pixels whose centre is in the ring of (patch, channel, value).

    ``ring`` is one ring or an array of rings, by the even-odd rule, so holes and several parts are
    drawn as such.  Rings are in patch coordinates.  Of several cells on a pixel of a channel the one of
    the greatest ``order`` (ties: the greater value) stays, without an order the greatest value.
    """
    key = ["slide_id", "patch_id", "channel"]
    nested = isinstance(rings.schema["ring"].dataType.elementType, ArrayType)
    parts = F.col("ring") if nested else F.array("ring")
    edges = F.flatten(F.transform(F.filter(parts, lambda r: F.size(r) >= 3), edges_of))
    shown = rings.select(*key, "value", F.col(order).alias("_order") if order else F.lit(0).alias("_order"), edges.alias("_edges")).filter(F.size("_edges") > 0)
    ys = F.transform("_edges", lambda e: e["ay"].cast("double"))
    low, high = F.greatest(F.floor(F.array_min(ys)), F.lit(0)), F.least(F.ceil(F.array_max(ys)), F.lit(width)) - 1
    shown = shown.withColumn("row", F.explode(F.when(low <= high, F.sequence(low, high)))).withColumn("_y", F.col("row") + 0.5)
    crosses = F.filter("_edges", lambda e: (e["ay"] > F.col("_y")) != (e["by"] > F.col("_y")))
    xs = F.array_sort(F.transform(crosses, lambda e: (e["ax"] + (F.col("_y") - e["ay"]) * (e["bx"] - e["ax"]) / (e["by"] - e["ay"])).cast("double")))
    shown = shown.select(*key, "value", "_order", "row", xs.alias("_xs")).filter(F.size("_xs") > 1)
    shown = shown.withColumn("_i", F.explode(F.sequence(F.lit(0), F.size("_xs") - 2, F.lit(2))))
    first, last = F.greatest(F.ceil(F.get("_xs", F.col("_i")) - 0.5), F.lit(0)), F.least(F.floor(F.get("_xs", F.col("_i") + 1) - 0.5), F.lit(width - 1))
    pixels = shown.withColumn("col", F.explode(F.when(first <= last, F.sequence(first, last))))
    best = F.max(F.struct("_order", "value"))["value"].alias("value")
    return pixels.groupBy("slide_id", "patch_id", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), "channel").agg(best)

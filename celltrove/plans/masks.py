"""Queries on masks and overlapping cells: pooled token sums, compressed rows, shared areas, conflicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import masks as M
from ..operators import spatial as S
from ..sources.readers import table
from . import space

#: Pixels of a side of the drawn patches, pooling bins, and components of a token.
SIZE, BINS, WIDTH = S.WIDTH // space.PIXEL, 7, 4
CELL = 64.0


def _instances(spark, d):
    """Pixels of the cells of each patch, an instance for each channel and value."""
    return space.rasterise_cells(spark, d)


def pooled_masks(spark, d):
    return M.pooled_masks(_instances(spark, d), ["slide_id", "patch_id", "channel", "value"], SIZE, BINS)


def token_sums(spark, d):
    """Sums of token vectors under the pooled masks; the tokens of a patch are taken from the embeddings in turn."""
    e = table(spark, d, "embeddings", ["vec_id", "embedding"])
    n = e.count()
    grid = space.grid(spark, d).select("slide_id", "patch_id").withColumn("bin_row", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1)))).withColumn("bin_col", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))))
    at = (F.col("patch_id") * BINS * BINS + F.col("bin_row") * BINS + F.col("bin_col")) % n
    whole = F.transform(F.slice("embedding", 1, WIDTH), lambda x: F.round(x.cast("double") * 1000))
    tokens = grid.withColumn("vec_id", at).join(e.select("vec_id", whole.alias("vec")), "vec_id").drop("vec_id")
    sums = M.token_sums(pooled_masks(spark, d), tokens, ["slide_id", "patch_id"], ["slide_id", "patch_id", "channel", "value"])
    return sums.select("slide_id", "patch_id", "channel", "value", *[F.round(F.col("features")[i]).cast("bigint").alias(f"f{i}") for i in range(WIDTH)])


def compressed_masks(spark, d):
    rows = M.compressed_rows(_instances(spark, d), ["slide_id", "patch_id"], SIZE, 3)
    text = lambda c: F.concat_ws(",", F.col(c).cast("array<string>"))
    return rows.select("chunk", "at", "slide_id", "patch_id", "start", "stop", text("indices").alias("indices"), text("data").alias("data"))


def _rings(spark, d):
    return space.boxes(spark, d).withColumn("ring", space._box_ring()).select("slide_id", "cell_id", "ring")


def shared_areas(spark, d):
    """Cells of a slide that share an area."""
    return S.overlaps(_rings(spark, d), CELL, digits=6).select("slide_id", "a", "b", "shared", "share")


def resolved_cells(spark, d):
    """Of cells that share half of the smaller one, the larger stays."""
    return S.resolved(_rings(spark, d), CELL).select("slide_id", "cell_id", "kept")


NAMES = "pooled_masks token_sums compressed_masks shared_areas resolved_cells".split()
QUERIES = {n: globals()[n] for n in NAMES}
_PIXELS = space.SQL["rasterise_cells"]
_BIN = f"SELECT CAST(i AS INTEGER) AS i, i * {SIZE} // {BINS} AS lo, ((i + 1) * {SIZE} + {BINS - 1}) // {BINS} AS hi FROM (SELECT unnest(range({BINS})) AS i)"
_POOLED = f"SELECT DISTINCT slide_id, patch_id, channel, value, r.i AS bin_row, c.i AS bin_col FROM ({_PIXELS}) p JOIN ({_BIN}) r ON p.row >= r.lo AND p.row < r.hi JOIN ({_BIN}) c ON p.col >= c.lo AND p.col < c.hi"
_BOX = space._BOX
SQL = {
    "pooled_masks": _POOLED,
    "token_sums": f"WITH e AS (SELECT vec_id, list_transform(embedding[1:{WIDTH}], lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)) AS v FROM embeddings), n AS (SELECT count(*) AS n FROM e), m AS ({_POOLED}) SELECT slide_id, patch_id, channel, value, {', '.join(f'CAST(sum(v[{i + 1}]) AS BIGINT) AS f{i}' for i in range(WIDTH))} FROM m, n JOIN e ON e.vec_id = (patch_id * {BINS * BINS} + bin_row * {BINS} + bin_col) % n.n GROUP BY ALL",
    "compressed_masks": f"WITH m AS (SELECT slide_id, patch_id, string_agg(CAST((row * {SIZE} + col) * 3 + channel AS VARCHAR), ',' ORDER BY (row * {SIZE} + col) * 3 + channel) AS indices, string_agg(CAST(value AS VARCHAR), ',' ORDER BY (row * {SIZE} + col) * 3 + channel) AS data, count(*) AS k, row_number() OVER (ORDER BY slide_id, patch_id) - 1 AS n FROM ({_PIXELS}) p WHERE value <> 0 GROUP BY slide_id, patch_id) SELECT CAST(n // {M.CHUNK} AS INTEGER) AS chunk, CAST(n % {M.CHUNK} AS INTEGER) AS at, slide_id, patch_id, CAST(sum(k) OVER (PARTITION BY n // {M.CHUNK} ORDER BY n) - k AS BIGINT) AS start, CAST(sum(k) OVER (PARTITION BY n // {M.CHUNK} ORDER BY n) AS BIGINT) AS stop, indices, data FROM m",
    "shared_areas": f"WITH b AS ({_BOX}), p AS (SELECT x.slide_id, x.cell_id AS a, y.cell_id AS b, CAST(least(x.xmax, y.xmax) - greatest(x.xmin, y.xmin) AS DOUBLE) AS w, CAST(least(x.ymax, y.ymax) - greatest(x.ymin, y.ymin) AS DOUBLE) AS h, least((x.xmax - x.xmin) * (x.ymax - x.ymin), (y.xmax - y.xmin) * (y.ymax - y.ymin)) AS s FROM b x JOIN b y ON x.slide_id = y.slide_id AND x.cell_id < y.cell_id AND x.xmin < y.xmax AND y.xmin < x.xmax AND x.ymin < y.ymax AND y.ymin < x.ymax) SELECT slide_id, a, b, w * h AS shared, round(w * h / s, 6) AS share FROM p",
}

"""String, JSON and vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.tables import DISPLAY_COLORS
from ..operators import vectors as V
from ..sources.readers import table
from . import roles
from .roles import CELLS, SLIDES


def cell_id_codec(spark, d):
    n = table(spark, d, "orders", ["o_orderkey"]).select((F.col("o_orderkey") * 99991 % 4294967296 + 1).alias("number"))
    named = n.withColumn("name", X.cell_name(F.col("number")))
    return named.withColumn("back", X.cell_number(F.col("name")))


def tissue_of(spark, d):
    return roles.slides(spark, d).select("slide_id", X.tissue_of(F.col("slide_id")).alias("tissue"), X.part_from_right(F.col("slide_id")).alias("sample"))


def combined_label(spark, d):
    c = roles.cells(spark, d).withColumn("label2", F.when(F.col("label2") != "O", F.col("label2")))
    return c.select("cell_id", X.joined(F.col("label1"), F.col("label2"), F.col("label3")).alias("combined"), X.nan_to(F.col("label2")).alias("label2"))


def rgb_hex(spark, d):
    rows = F.array(*[F.struct(F.lit(k).alias("label"), *[F.lit(c).alias(n) for c, n in zip(v, "rgb", strict=True)]) for k, v in DISPLAY_COLORS.items()])
    colors = table(spark, d, "region", ["r_regionkey"]).select("r_regionkey", F.explode(rows).alias("c"))
    return colors.select("r_regionkey", "c.label", X.rgb_hex(F.col("c.r"), F.col("c.g"), F.col("c.b")).alias("color"))


def json_explode(spark, d):
    e = table(spark, d, "events", ["event_id", "props"])
    return e.select("event_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "value"))


def vector_nan_filter(spark, d):
    v = table(spark, d, "embeddings", ["vec_id", "embedding"])
    holed = F.transform("embedding", lambda x, i: F.when((F.col("vec_id") % 7 == 0) & (i == F.col("vec_id") % 64), F.lit(float("nan")).cast("float")).otherwise(x))
    return V.drop_nan_vectors(v.withColumn("embedding", holed), "embedding").select("vec_id")


def _patched(spark, d):
    e = table(spark, d, "embeddings", ["vec_id", "embedding", "label"])
    whole = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("bigint"))
    return e.select("label", "vec_id", whole.alias("q"))


def vector_mean(spark, d):
    rows = V.vector_mean(_patched(spark, d), ["label"], "q")
    return rows.select("label", F.col("position").cast("int").alias("position"), F.round("mean", 6).alias("mean"))


def merge_partials(spark, d):
    v = _patched(spark, d)
    a, b = (V.partial_sums(v.filter(f"vec_id % 2 = {k} AND NOT (label = 3 AND vec_id % 2 = 1)"), ["label"], "q", "vec_id") for k in (0, 1))
    means = V.means(V.merge_partials(a, b, ["label"]), ["label"])
    text = F.array_join(F.transform("mean", lambda x: F.round(x, 3).cast("decimal(18,3)").cast("string")), ",")
    return means.select("label", "n", X.comma_list(F.col("patches")).alias("patches"), text.alias("mean"))


NAMES = "cell_id_codec tissue_of combined_label rgb_hex json_explode vector_nan_filter vector_mean merge_partials".split()
QUERIES = {n: globals()[n] for n in NAMES}
_COLORS = ", ".join(f"('{k}', '#{r:02x}{g:02x}{b:02x}')" for k, (r, g, b) in DISPLAY_COLORS.items())
_Q = "SELECT label, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS position FROM embeddings"
SQL = {
    "cell_id_codec": "SELECT number, translate(lpad(lower(to_hex(number - 1)), 8, '0'), '0123456789abcdef', 'abcdefghijklmnop') || '-1' AS name, number AS back FROM (SELECT o_orderkey * 99991 % 4294967296 + 1 AS number FROM orders)",
    "tissue_of": f"SELECT slide_id, regexp_replace(slide_id, '_[^_]*$', '') AS tissue, string_split(slide_id, '_')[-1] AS sample FROM ({SLIDES}) s",
    "combined_label": f"SELECT cell_id, label1 || '_' || CASE WHEN label2 <> 'O' THEN label2 ELSE 'nan' END || '_' || label3 AS combined, CASE WHEN label2 <> 'O' THEN label2 ELSE 'Unknown' END AS label2 FROM ({CELLS}) c",
    "rgb_hex": f"SELECT r_regionkey, label, color FROM region CROSS JOIN (VALUES {_COLORS}) v(label, color)",
    "json_explode": "SELECT event_id, 'k' AS key, CAST(props ->> '$.k' AS BIGINT) AS value FROM events WHERE (props ->> '$.k') IS NOT NULL",
    "vector_nan_filter": "SELECT vec_id FROM embeddings WHERE vec_id % 7 <> 0",
    "vector_mean": f"SELECT label, CAST(position AS INTEGER) AS position, round(sum(CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)) / CAST(count(*) AS DOUBLE), 6) AS mean FROM ({_Q}) q GROUP BY label, position",
    "merge_partials": f"WITH q AS (SELECT * FROM ({_Q}) q WHERE NOT (label = 3 AND vec_id % 2 = 1)), m AS (SELECT label, position, sum(CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)) / CAST(count(*) AS DOUBLE) AS m FROM q GROUP BY ALL), p AS (SELECT label, count(*) AS n, string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY vec_id) AS patches FROM embeddings WHERE NOT (label = 3 AND vec_id % 2 = 1) GROUP BY 1) SELECT label, n, patches, string_agg(CAST(CAST(round(m, 3) AS DECIMAL(18, 3)) AS VARCHAR), ',' ORDER BY position) AS mean FROM m JOIN p USING (label) GROUP BY label, n, patches",
}

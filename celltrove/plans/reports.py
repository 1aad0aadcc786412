"""Census, pivots, shares, cluster reports, votes, bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import windows as W
from ..sources.readers import table
from . import roles
from .roles import CELLS, CLUSTERS

# Fixed values of these queries.
TISSUES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
LABELS = ("URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW")
KINDS = ("click", "error", "purchase", "signup", "view")
VOTES = ("Background", "A", "B", "C")
OVERRIDES = {"3": "Blood_vessel", "11": "Unknown"}


def _nulled(spark, d):
    return roles.cells(spark, d).withColumn("label2", F.when(F.col("label2") != "O", F.col("label2")))


def label_census(spark, d):
    return A.group_size(_nulled(spark, d), ["label1", "label2", "label3"])


def value_counts(spark, d):
    return A.value_counts(_nulled(spark, d), "label2")


def value_counts_null(spark, d):
    return A.value_counts(_nulled(spark, d), "label2", dropna=False)


def distinct_labels(spark, d):
    return A.distinct_values(roles.cells(spark, d), "label1")


def _census(spark, d):
    return A.group_size(roles.cells(spark, d), ["slide_id", "tissue", "label1"])


def pivot_tissue(spark, d):
    return A.pivot_sum(_census(spark, d), ["label1"], "tissue", "cell_count", TISSUES)


def pivot_sample(spark, d):
    return A.pivot_sum(_census(spark, d), ["slide_id"], "label1", "cell_count", LABELS)


def pivot_label(spark, d):
    return A.pivot_sum(_census(spark, d), ["tissue"], "label1", "cell_count", LABELS)


def pivot_rowpct(spark, d):
    return A.row_percent(pivot_label(spark, d), LABELS, 6)


def crosstab_scheme(spark, d):
    return A.crosstab(roles.cells(spark, d), "slide_id", "label3", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))


def share_in_set(spark, d):
    rows = A.share_in(table(spark, d, "events", ["event_type", "user_id"]).withColumn("fold", (F.col("user_id") % 4).cast("int")), "fold", "event_type")
    return rows.withColumn("percent", F.round("percent", 6))


def _wide(spark, d):
    e = table(spark, d, "events", ["user_id", "event_type"]).withColumn("fold", (F.col("user_id") % 4).cast("int"))
    return e.select("fold", *[F.when(F.col("event_type") == k, 1).otherwise(0).cast("bigint").alias(k) for k in KINDS])


def celltype_totals(spark, d):
    return A.totals(_wide(spark, d), "fold", KINDS)


def group_columns(spark, d):
    return A.group_columns(celltype_totals(spark, d), {"Active": ["click", "purchase", "signup"], "Passive": ["view"]})


def cluster_top2(spark, d):
    return A.top_shares(roles.clusters(spark, d), "cluster", "label_cells", 2).withColumn("percent", F.round("percent", 6))


def cluster_disagreement(spark, d):
    found = A.disagreement(roles.clusters(spark, d), "cluster", "label_cells", "label_nuclei")
    return found.select("cluster", F.round("diff_known", 6).alias("diff_known"), F.round("diff_all", 6).alias("diff_all"), "n")


def cluster_flags(spark, d):
    return W.cluster_flags(roles.clusters(spark, d), "cluster", "label_cells", "label_nuclei", limit=40.0)


def cluster_consensus(spark, d):
    return W.consensus(roles.clusters(spark, d), "cluster", "label_cells", OVERRIDES)


def _votes(spark, d):
    line = table(spark, d, "lineitem", ["l_orderkey", "l_returnflag", "l_linenumber"])
    name = {"Background": F.col("l_linenumber") <= 3, "A": F.col("l_returnflag") == "A", "B": F.col("l_returnflag") == "N", "C": F.col("l_returnflag") == "R"}
    n = line.groupBy("l_orderkey").agg(*[F.count_if(c).alias(k) for k, c in name.items()])
    return n.select("l_orderkey", F.array(*VOTES).alias("counts"))


def vote_label(spark, d):
    return W.vote(_votes(spark, d), F.col("counts"), VOTES).select("l_orderkey", "label", F.round("proba", 6).alias("proba"))


def qcut7(spark, d):
    return W.quantile_bins(table(spark, d, "orders", ["o_orderkey", "o_totalprice"]), "o_totalprice", 7, digits=4).select("o_orderkey", "bin")


def category_codes(spark, d):
    return W.category_codes(_nulled(spark, d).select("cell_id", "label2"), "label2")


def remap_ids(spark, d):
    rows = table(spark, d, "lineitem", ["l_suppkey", "l_partkey"]).select((F.col("l_suppkey") % 20).alias("patch"), (F.col("l_partkey") % 97).alias("mask")).distinct()
    return W.remap_ids(rows, ["patch"], "mask", "new_id")


def histogram(spark, d):
    return A.histogram(table(spark, d, "lineitem", ["l_quantity", "l_linenumber"]), "l_quantity", 0, 50, 20, "l_linenumber")


def merge_votes(spark, d):
    v = _votes(spark, d)
    merged = A.merge_votes(v.filter("l_orderkey % 3 > 0"), v.filter("l_orderkey % 2 = 0"), "l_orderkey", "counts")
    return merged.select("l_orderkey", F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"))


def metrics_to_lists(spark, d):
    e = table(spark, d, "events", ["event_id", "user_id", "event_type", "value"])
    rows = e.withColumn("said", F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("decimal(12,2)").cast("string")))
    lists = A.metrics_to_lists(rows, ["user_id"], "event_type", "said", "event_id")
    joined = F.array_join(F.transform("values", lambda v: F.coalesce(v.cast("decimal(12,2)").cast("string"), F.lit("null"))), ",")
    return lists.select("user_id", "event_type", joined.alias("values"))


NAMES = "label_census value_counts value_counts_null distinct_labels pivot_tissue pivot_sample pivot_label pivot_rowpct crosstab_scheme share_in_set celltype_totals group_columns cluster_top2 cluster_disagreement cluster_flags cluster_consensus vote_label qcut7 category_codes remap_ids histogram merge_votes metrics_to_lists".split()
QUERIES = {n: globals()[n] for n in NAMES}


def _pivot(index, column, values, source, number="count(*)"):
    cols = ", ".join(f"CAST(count(*) FILTER ({column} = '{v}') AS BIGINT) AS \"{v}\"" for v in values)
    return f"SELECT {index}, {cols} FROM ({source}) c GROUP BY {index}"


_NULLED = f"SELECT * EXCLUDE (label2), CASE WHEN label2 <> 'O' THEN label2 END AS label2 FROM ({CELLS}) c"
_TOP = "SELECT cluster, {col} AS value, count(*) AS c, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, {col}) AS rank, sum(count(*)) OVER (PARTITION BY cluster) AS t FROM ({src}) x GROUP BY cluster, {col}"
_TOPC, _TOPN = _TOP.format(col="label_cells", src=CLUSTERS), _TOP.format(col="label_nuclei", src=CLUSTERS)
_VOTES = "SELECT l_orderkey, [count(*) FILTER (l_linenumber <= 3), count(*) FILTER (l_returnflag = 'A'), count(*) FILTER (l_returnflag = 'N'), count(*) FILTER (l_returnflag = 'R')] AS counts FROM lineitem GROUP BY 1"
_WIDE = "SELECT CAST(user_id % 4 AS INTEGER) AS fold, " + ", ".join(f"CAST(count(*) FILTER (event_type = '{k}') AS BIGINT) AS \"{k}\"" for k in KINDS) + " FROM events GROUP BY 1"
_PCT = ", ".join(f'round("{c}" * CAST(100 AS DOUBLE) / ({" + ".join(chr(34) + x + chr(34) for x in LABELS)}), 6) AS "{c}"' for c in LABELS)
_DIS = f"SELECT cluster, avg(CASE WHEN label_cells <> label_nuclei AND label_nuclei NOT IN ('Unknown', 'Less10') THEN CAST(100 AS DOUBLE) ELSE 0 END) AS dk, avg(CASE WHEN label_cells <> label_nuclei THEN CAST(100 AS DOUBLE) ELSE 0 END) AS da, count(*) AS n FROM ({CLUSTERS}) x GROUP BY cluster"
SQL = {
    "label_census": f"SELECT label1, label2, label3, count(*) AS cell_count FROM ({_NULLED}) c WHERE label2 IS NOT NULL GROUP BY ALL",
    "value_counts": f"SELECT label2, count(*) AS n FROM ({_NULLED}) c WHERE label2 IS NOT NULL GROUP BY 1",
    "value_counts_null": f"SELECT label2, count(*) AS n FROM ({_NULLED}) c GROUP BY 1",
    "distinct_labels": f"SELECT DISTINCT label1 FROM ({CELLS}) c",
    "pivot_tissue": _pivot("label1", "tissue", TISSUES, CELLS),
    "pivot_sample": _pivot("slide_id", "label1", LABELS, CELLS),
    "pivot_label": _pivot("tissue", "label1", LABELS, CELLS),
    "pivot_rowpct": f"SELECT tissue, {_PCT} FROM ({_pivot('tissue', 'label1', LABELS, CELLS)}) p",
    "crosstab_scheme": _pivot("slide_id", "label3", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), CELLS),
    "share_in_set": "SELECT CAST(user_id % 4 AS INTEGER) AS fold, event_type, count(*) AS count, round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY CAST(user_id % 4 AS INTEGER)), 6) AS percent FROM events GROUP BY 1, 2",
    "celltype_totals": _WIDE,
    "group_columns": f"SELECT fold, error, click + purchase + signup AS \"Active\", \"view\" AS \"Passive\" FROM ({_WIDE}) w",
    "cluster_top2": f"SELECT cluster, CAST(rank AS INTEGER) AS rank, value, round(c * CAST(100 AS DOUBLE) / t, 6) AS percent FROM ({_TOPC}) q WHERE rank <= 2",
    "cluster_disagreement": f"SELECT cluster, round(dk, 6) AS diff_known, round(da, 6) AS diff_all, n FROM ({_DIS}) q",
    "cluster_flags": f"SELECT cluster, top_cells, top_nuclei, top_cells IN ('Unknown', 'Less10') AS unknown_top, top_cells <> top_nuclei AS different_top, dk > 40 AS high_diff FROM (SELECT cluster, max(value) FILTER (rank = 1) AS top_cells FROM ({_TOPC}) q GROUP BY 1) a JOIN (SELECT cluster, CASE WHEN max(value) FILTER (rank = 1) IN ('Unknown', 'Less10') THEN coalesce(max(value) FILTER (rank = 2), max(value) FILTER (rank = 1)) ELSE max(value) FILTER (rank = 1) END AS top_nuclei FROM ({_TOPN}) q GROUP BY 1) b USING (cluster) JOIN ({_DIS}) c USING (cluster)",
    "cluster_consensus": f"SELECT cluster, CASE cluster WHEN 3 THEN 'Blood_vessel' WHEN 11 THEN 'Unknown' ELSE value END AS final FROM ({_TOPC}) q WHERE rank = 1",
    "vote_label": f"WITH v AS ({_VOTES}), e AS (SELECT l_orderkey, unnest(counts) AS n, generate_subscripts(counts, 1) - 1 AS i, list_sum(counts) AS t FROM v), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, i) AS k FROM e WHERE t > 0), p AS (SELECT l_orderkey, any_value(t) AS t, max(i) FILTER (k = 1) AS i1, max(n) FILTER (k = 1) AS n1, max(i) FILTER (k = 2) AS i2, max(n) FILTER (k = 2) AS n2 FROM r GROUP BY 1) SELECT l_orderkey, ['Background', 'A', 'B', 'C'][CAST(CASE WHEN i1 = 0 AND n2 > 0 THEN i2 ELSE i1 END AS INTEGER) + 1] AS label, round(CAST(CASE WHEN i1 = 0 AND n2 > 0 THEN n2 ELSE n1 END AS DOUBLE) / t, 6) AS proba FROM p",
    "qcut7": "WITH e AS (SELECT list_transform(quantile_cont(o_totalprice, [1/7, 2/7, 3/7, 4/7, 5/7, 6/7]), lambda x: round(x, 4)) AS q FROM orders) SELECT o_orderkey, CAST(len(list_filter(q, lambda x: x < o_totalprice)) AS INTEGER) AS bin FROM orders, e",
    "category_codes": f"SELECT cell_id, label2, CAST(CASE WHEN label2 IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY label2 NULLS LAST) - 1 END AS INTEGER) AS code FROM ({_NULLED}) c",
    "remap_ids": "SELECT patch, mask, CASE WHEN mask = 0 THEN 0 ELSE dense_rank() OVER (PARTITION BY patch, mask <> 0 ORDER BY mask) END AS new_id FROM (SELECT DISTINCT l_suppkey % 20 AS patch, l_partkey % 97 AS mask FROM lineitem)",
    "histogram": "SELECT CAST(least(floor(l_quantity * 20 / 50), 19) AS INTEGER) AS bin, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS weight FROM lineitem WHERE l_quantity BETWEEN 0 AND 50 GROUP BY 1",
    "merge_votes": f"WITH v AS ({_VOTES}), u AS (SELECT * FROM v WHERE l_orderkey % 3 > 0 UNION ALL SELECT * FROM v WHERE l_orderkey % 2 = 0), e AS (SELECT l_orderkey, unnest(counts) AS n, generate_subscripts(counts, 1) AS i FROM u), s AS (SELECT l_orderkey, i, sum(n) AS n FROM e GROUP BY ALL) SELECT l_orderkey, string_agg(CAST(n AS VARCHAR), ',' ORDER BY i) AS counts FROM s GROUP BY 1",
    "metrics_to_lists": "SELECT user_id, event_type, string_agg(CASE WHEN event_id % 7 = 0 THEN 'null' ELSE CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) END, ',' ORDER BY event_id) AS values FROM events GROUP BY ALL",
}

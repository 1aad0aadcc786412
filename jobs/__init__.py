"""Runnable jobs, and the queries that run them on the benchmark tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltrove.plans.space import SQL as SPACE
from celltrove.scratch import scratch_dir

from . import count_transcripts, training_set
from .common import configuration


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def job1_transcript_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as points, customers as cells; the second run finds nothing new."""
    folder, config = _folder(spark, "job1"), configuration(spark, f"file://{count_transcripts.CONFIG}")
    points, cells = f"{sf_dir}/events.parquet", f"{sf_dir}/customer.parquet"
    for _ in range(2):
        count_transcripts.run(spark, config, points, cells, f"{folder}/output", f"{folder}/checkpoint")
    return count_transcripts.counts(spark, config, points, cells, f"{folder}/output")


def job2_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, and the census of what was written."""
    folder, config = _folder(spark, "job2"), configuration(spark, f"file://{training_set.CONFIG}")
    documents, labels = f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet"
    for _ in range(2):
        training_set.run(spark, config, documents, labels, folder)
    parts = {"dataset": training_set.dataset(spark, config, documents, folder), "census": training_set.census(spark, config, documents, folder)}
    named = [df.withColumn("output", F.lit(name)) for name, df in parts.items()]
    return named[0].unionByName(named[1], allowMissingColumns=True)


QUERIES = {"job1_transcript_counts": job1_transcript_counts, "job2_training_set": job2_training_set}

_TRAINING = """
WITH r AS MATERIALIZED (
  SELECT doc_id AS record_id, source AS slide_id, lang AS tissue, text, md5(concat_ws(chr(1), coalesce(text, ''), source, lang)) AS digest, md5(coalesce(text, '')) AS text_digest,
         coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0) AS n_words
  FROM documents WHERE doc_id IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY digest) = 1),
a AS (SELECT doc_id AS record_id, min(CASE WHEN toxic = 1 THEN 'Toxic' WHEN quality = 1 THEN 'Good' WHEN quality = 0 THEN 'Poor' ELSE 'NoAnnot' END) AS label FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
l AS (SELECT r.*, CASE WHEN n_words <= 10 THEN 'Less10' ELSE coalesce(label, 'NoAnnot') END AS label FROM r LEFT JOIN a USING (record_id)),
k AS MATERIALIZED (
  SELECT *, CAST(('0x' || substr(text_digest, 1, 8)) AS UBIGINT) / CAST(4294967296 AS DOUBLE) AS place FROM l
  WHERE slide_id IN (SELECT slide_id FROM l WHERE label NOT IN ('NoAnnot', 'Less10') GROUP BY 1 HAVING count(*) >= 5)),
q AS (SELECT quantile_cont(CAST(n_words AS DOUBLE), [0.25, 0.5, 0.75]) AS e FROM k),
d AS MATERIALIZED (
  SELECT record_id, slide_id, label, n_words, CAST((n_words > e[1])::INT + (n_words > e[2])::INT + (n_words > e[3])::INT AS INTEGER) AS bin, text,
         CASE WHEN place < 0.8 THEN 'train' WHEN place < 0.9 THEN 'valid' ELSE 'test' END AS split, tissue FROM k, q),
c AS (SELECT tissue, label, count(*) AS n, CAST(sum(n_words) AS BIGINT) AS words, split FROM d GROUP BY ALL)
SELECT *, CAST(NULL AS BIGINT) AS n, CAST(NULL AS BIGINT) AS words, CAST(NULL AS DOUBLE) AS share, 'dataset' AS output FROM d
UNION ALL BY NAME
SELECT tissue, label, n, words, split, round(n / CAST(sum(n) OVER (PARTITION BY split, tissue) AS DOUBLE), 6) AS share, 'census' AS output FROM c
"""
SQL = {"job1_transcript_counts": SPACE["transcript_counts"], "job2_training_set": _TRAINING}

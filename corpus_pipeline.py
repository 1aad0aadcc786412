"""Corpus pipeline: toxicity, near-dedup, benchmark decontamination, PII, byte BPE.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's docs.
All stages but the last return the columns of documents.  ``run`` applies them to
documents.  Every stage works on all that its predecessor kept:

* toxicity: documents predicted toxic go; labels come from the labels table;
* near_dedup: of each component of near duplicates (shingles of five words) one row stays, that of the least id
  (of the least text hash, if that id has several texts in it; a missing id is greater
  than all others); documents are told apart by id and text, and rows that repeat both
  stay once;
* decontaminate: documents holding a benchmark window go;
* pii: found spans are replaced by their kind, n_chars follows the new text;
* byte_bpe: token ids and the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltrove.llm import bpe, decontaminate, minhash, pii, toxicity
from celltrove.llm.common import drop, ship, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(*COLUMNS), model, out="_toxicity")
    return scored.filter(F.round("_toxicity.score", 6) < 0.5).select(*COLUMNS)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    # Two hashes name a document by id and text, also where one of them is null.
    keys = ["_document", "_text"]
    docs = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("_document"), F.xxhash64("text").alias("_text"))
    kept = minhash.rooted_duplicates(docs.select("doc_id", "text", *keys)).filter("kept")
    linked = kept.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("_text", "_document")).alias("_k")).select("_k.*")
    keep = linked.unionByName(kept.filter("root IS NULL").select(*keys)).distinct()
    # The semi-join has placed the rows by key, so taking one row of a key needs no shuffle.
    one = docs.join(keep, keys, "left_semi").groupBy(*keys).agg(F.min(F.struct(*COLUMNS)).alias("_row"))
    return one.select("_row.*").select(*COLUMNS)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.clean(docs.select(*COLUMNS), items)


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def stage_byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    coded = bpe.round_trip(docs.select(*COLUMNS))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("toxicity", stage_toxicity),
    ("near_dedup", stage_near_dedup),
    ("decontaminate", stage_decontaminate),
    ("pii", stage_pii),
    ("byte_bpe", stage_byte_bpe),
]

#: The stages are not expressible in SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop(before)  # what the stage before wrote; the documents themselves stay
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)

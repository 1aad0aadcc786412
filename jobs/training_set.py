"""The training table of annotated records, and its census.

Records (an id, a slide, a tissue, a text) meet sparse expert annotations:

* rows without an id, slide or tissue are left out; of rows that repeat an id the one of the least digest stays;
* the label is that of the first rule that the record's annotation meets; records without one
  are unlabelled, and records of few words are marked as low, whatever their annotation;
* slides with too few annotated records are vetoed;
* the length bin is the quantile of the record's words among those kept;
* the split goes by the text's digest, so equal texts are never on both sides of a split.

All of this is decided on a narrow table of digests and counts, which also says in which place of
which file a record is; texts meet the decisions by that place, once, and move for that alone.
Written are ``dataset`` (by split and tissue) and ``census`` (by split): records and words by
tissue and label, and their share of the tissue's.  Both are replaced as a whole, so a run that
is repeated, also after a failure, gives the same tables.

    python jobs/training_set.py --documents PATH --labels PATH --output PATH
"""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from celltrove import session  # noqa: E402
from celltrove.operators import aggregates, relational, windows  # noqa: E402
from celltrove.scratch import drop, without_broadcast, written  # noqa: E402
from jobs.common import configuration, selected  # noqa: E402

log = logging.getLogger("training_set")
CONFIG = str(Path(__file__).with_suffix(".json"))
RECORD = ("record_id", "slide_id", "tissue", "text")
#: Where a row lies in the files read: no two rows have the same.
PLACE = {"file": "_metadata.file_path", "place": "_metadata.row_index"}
WORD = r"[^ \t\n\x0B\f\r]+"


def _digest(*columns: str) -> Column:
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def first_rule(rules: list[list[str]], default: str) -> Column:
    found = F.lit(default)
    for label, condition in reversed(rules):
        found = F.when(F.expr(condition), F.lit(label)).otherwise(found)
    return found


def decide(records: DataFrame, annotations: DataFrame, config: dict) -> DataFrame:
    """(file, place, slide_id, tissue, label, n_words, split) of the records that stay; a narrow table."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_words")
    share = (F.conv(F.substr(_digest("text"), F.lit(1), F.lit(8)), 16, 10).cast("double") / 2**32).alias("share")
    # Of an id the row of the least digest; rows that repeat whole are one record, the first in place.
    narrow = F.struct(_digest("text", "slide_id", "tissue").alias("digest"), *PLACE, "slide_id", "tissue", share, words)
    one = records.groupBy("record_id").agg(F.min(narrow).alias("_r")).select("record_id", "_r.*").drop("digest")
    rules = annotations.withColumn("label", first_rule(config["labels"], config["unlabelled"]))
    rules = rules.filter("record_id IS NOT NULL").groupBy("record_id").agg(F.min("label").alias("label"))
    labelled = one.join(relational.small(rules), "record_id", "left").withColumn("label", F.coalesce("label", F.lit(config["unlabelled"])))
    labelled = relational.mark_low(labelled, "n_words", "label", config["least_words"], config["low"])
    annotated = labelled.filter(~F.col("label").isin(config["unlabelled"], config["low"]))
    known = annotated.groupBy("slide_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= config["least_labelled"])
    kept = labelled.join(known.select("slide_id"), "slide_id", "left_semi")
    split = F.lit(None).cast("string")
    for name, upto in reversed(config["splits"]):
        split = F.when(F.col("share") < upto, F.lit(name)).otherwise(split)
    return kept.select(*PLACE, "slide_id", "tissue", "label", "n_words", split.alias("split"))


def run(spark: SparkSession, config: dict, documents: str, labels: str, output: str) -> None:
    lost = F.col("record_id").isNull() | F.col("slide_id").isNull() | F.col("tissue").isNull()
    source = selected(spark.read.parquet(documents), config["record"] | PLACE, (*RECORD, *PLACE))
    annotations = selected(spark.read.parquet(labels), config["annotation"], config["annotation"])
    log.info("records from %s, annotations from %s", documents, labels)
    read, left_out = source.agg(F.count(F.lit(1)), F.count_if(lost)).first()
    decided = written(decide(source.filter(~lost), annotations, config), "training-set")
    binned = windows.quantile_bins(decided, "n_words", config["bins"])
    texts = source.filter(~lost).select("record_id", "text", *PLACE)
    with without_broadcast(spark):
        rows = texts.join(binned, list(PLACE)).select("record_id", "slide_id", "label", "n_words", "bin", "text", "split", "tissue")
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("split", "tissue").parquet(f"{output}/dataset")
    drop(decided)
    back = dataset(spark, config, documents, output)
    log.info("read %d records, left out %d; wrote %d to %s/dataset", read, left_out, back.count(), output)
    census_of(back).write.mode("overwrite").partitionBy("split").parquet(f"{output}/census")
    log.info("wrote %d rows to %s/census", census(spark, config, documents, output).count(), output)


def census_of(rows: DataFrame) -> DataFrame:
    """(tissue, label, n, words, share, split): records and words, and the share of the split's records of a tissue."""
    counts = rows.groupBy("split", "tissue", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"))
    whole = counts.groupBy("split", "tissue").agg(F.sum("n").alias("_all"))
    return counts.join(whole, ["split", "tissue"]).select("tissue", "label", "n", "words", F.round(F.col("n") / F.col("_all"), 6).alias("share"), "split")


def _schemas(spark: SparkSession, config: dict, documents: str) -> tuple[str, str]:
    kinds = dict(selected(spark.read.parquet(documents), config["record"], RECORD).dtypes)
    dataset = f"record_id {kinds['record_id']}, slide_id {kinds['slide_id']}, label string, n_words bigint, bin int, text {kinds['text']}, split string, tissue {kinds['tissue']}"
    return dataset, f"tissue {kinds['tissue']}, label string, n bigint, words bigint, share double, split string"


def dataset(spark: SparkSession, config: dict, documents: str, output: str) -> DataFrame:
    return spark.read.schema(_schemas(spark, config, documents)[0]).parquet(f"{output}/dataset")


def census(spark: SparkSession, config: dict, documents: str, output: str) -> DataFrame:
    return spark.read.schema(_schemas(spark, config, documents)[1]).parquet(f"{output}/census")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    parser.add_argument("--config", default=CONFIG)
    for name in ("documents", "labels", "output"):
        parser.add_argument(f"--{name}", required=True)
    args = vars(parser.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = session.build("training-set")
    try:
        run(spark, configuration(spark, args.pop("config")), **args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

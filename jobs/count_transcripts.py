"""Transcripts of each cell, counted as point files arrive.

Points come as files, slide by slide and in pieces; cells are polygons.  A file stream with a
checkpoint takes the files that are new, in batches.  Each batch

* puts points without a slide, place or feature aside (``rejected/batch=...``),
* counts the others in the cells that hold them (``partials/batch=.../slide_id=...``),
* adds up the partials of the slides it touched (``counts/slide_id=...``); others stay as they are.

All three writes replace the partitions of their own batch or slides, so a batch that runs
again after a failure leaves what it would have left the first time, and a run without new files changes
nothing.  Points of a file count once; a file that is written again under another name is new.
Counts are of the cells at the time a point arrives; a point in two cells counts in both.

    python jobs/count_transcripts.py --points PATH --cells PATH --output PATH --checkpoint PATH
"""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path
from urllib.parse import unquote

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from celltrove import session  # noqa: E402
from celltrove.operators import spatial  # noqa: E402
from celltrove.sources import writers  # noqa: E402
from jobs.common import configuration, selected  # noqa: E402

log = logging.getLogger("count_transcripts")
CONFIG = str(Path(__file__).with_suffix(".json"))
KEY = ["slide_id", "cell_id", "feature_name"]
POINT = ("slide_id", "x", "y", "feature_name")


def _replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def count_batch(points: DataFrame, number: int, cells: DataFrame, output: str) -> None:
    """One batch; it may run again after a failure."""
    spark = points.sparkSession
    bad = F.col("slide_id").isNull() | F.col("feature_name").isNull()
    for c in "xy":
        bad |= F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    read, lost = points.agg(F.count(F.lit(1)), F.count_if(bad)).first()
    if lost:
        _replace_partitions(points.filter(bad).withColumn("batch", F.lit(number)), f"{output}/rejected", "batch")
    partial = spatial.count_in_polygons(points.filter(~bad), cells).select(*KEY, "count").withColumn("batch", F.lit(number))
    _replace_partitions(partial, f"{output}/partials", "batch", "slide_id")
    # Types of partition columns are those of the rows, not guesses from the folders' names.
    partials = spark.read.schema(partial.schema).parquet(f"{output}/partials")
    mine = partials.filter(F.col("batch") == number)
    rows, placed = mine.agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))).first()
    touched = mine.select("slide_id").distinct()
    totals = partials.join(touched, "slide_id", "left_semi").groupBy(*KEY).agg(F.sum("count").alias("count"))
    _replace_partitions(totals, f"{output}/counts", "slide_id")
    log.info("batch %d: read %d points, rejected %d; wrote %d counts of %d points, and the totals of their slides", number, read, lost, rows, placed)


def _watched(source: DataFrame, path: str) -> str:
    """The path for a file stream, which takes folders and patterns; a single file is the pattern that only it meets."""
    path, files = path.rstrip("/"), source.inputFiles()
    alone = len(files) == 1 and unquote(files[0]).rsplit("/", 1)[-1] == path.rsplit("/", 1)[-1]
    return f"{path[:-1]}[{path[-1]}]" if alone else path


def run(spark: SparkSession, config: dict, points: str, cells: str, output: str, checkpoint: str) -> None:
    """Count the point files that are new since the last run with this checkpoint."""
    polygons = selected(spark.read.parquet(cells), config["cell"], ("slide_id", "cell_id", "ring"))
    source = spark.read.parquet(points)
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", config.get("max_files", 200)).parquet(_watched(source, points))
    rows = selected(stream, config["point"], POINT)
    log.info("points from %s, cells from %s, counts to %s/counts", points, cells, output)
    query = rows.writeStream.foreachBatch(lambda df, number: count_batch(df, number, polygons, output)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if not writers.exists(spark, f"{output}/counts"):
        kinds = {f.name: f.dataType.simpleString() for f in [*rows.schema, *polygons.schema]}
        spark.createDataFrame([], ", ".join(f"{c} {kinds[c]}" for c in KEY) + ", count bigint").write.partitionBy("slide_id").parquet(f"{output}/counts")
    log.info("%d batches in this run", sum(p["numInputRows"] > 0 for p in query.recentProgress))


def counts(spark: SparkSession, config: dict, points: str, cells: str, output: str) -> DataFrame:
    """(slide_id, cell_id, feature_name, count): the job's whole output."""
    kinds = dict(selected(spark.read.parquet(cells), config["cell"], ("slide_id", "cell_id")).dtypes)
    feature = dict(selected(spark.read.parquet(points), config["point"], POINT).dtypes)["feature_name"]
    schema = f"cell_id {kinds['cell_id']}, feature_name {feature}, count bigint, slide_id {kinds['slide_id']}"
    return spark.read.schema(schema).parquet(f"{output}/counts").select(*KEY, "count")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    parser.add_argument("--config", default=CONFIG)
    for name in ("points", "cells", "output", "checkpoint"):
        parser.add_argument(f"--{name}", required=True)
    args = vars(parser.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = session.build("count-transcripts")
    try:
        run(spark, configuration(spark, args.pop("config")), **args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

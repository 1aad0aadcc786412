"""Tables of masks: pooled cell masks and their token sums, and compressed rows in chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import row_numbers

#: Masks of a chunk.
CHUNK = 1000


def bins_of(place: Column, size: int, bins: int) -> Column:
    """Numbers of the adaptive pooling bins that hold a pixel: bin i reaches from floor(i size / bins) to ceil((i + 1) size / bins), so uneven bins overlap."""
    first = F.floor(place * bins / F.lit(size))
    last = F.floor(((place + 1) * bins - 1) / F.lit(size))
    return F.sequence(first.cast("int"), last.cast("int"))


def pooled_masks(pixels: DataFrame, instance: Sequence[str], size: int = 256, bins: int = 14, row: str = "row", col: str = "col") -> DataFrame:
    """(instance, bin_row, bin_col): the bins that each instance has a pixel in (max-pooling of its binary mask).

    ``pixels`` are the non-zero ones of instance maps; those outside of the map, or without a place, are left out.
    """
    within = F.col(row).between(0, size - 1) & F.col(col).between(0, size - 1)
    binned = pixels.filter(within).select(*instance, bins_of(F.col(row), size, bins).alias("_r"), F.col(col))
    # Rows of bins first, so that few pixels are spread over columns.
    rows = binned.select(*instance, F.explode("_r").alias("bin_row"), col).distinct()
    return rows.select(*instance, "bin_row", F.explode(bins_of(F.col(col), size, bins)).alias("bin_col")).distinct()


def token_sums(pooled: DataFrame, tokens: DataFrame, patch: Sequence[str], instance: Sequence[str], vec: str = "vec", out: str = "features") -> DataFrame:
    """(instance, ``out``): the sum of the patch's token vectors (patch, bin_row, bin_col, vec) under each pooled mask.

    Sums are combined map-side, vector by vector, as running means (exact to rounding).  An instance without tokens gets no row.
    """
    met = pooled.join(tokens.select(*patch, "bin_row", "bin_col", array_to_vector(F.col(vec).cast("array<double>")).alias("_v")), [*patch, "bin_row", "bin_col"])
    return met.groupBy(*instance).agg(Summarizer.sum(met["_v"]).alias("_s")).select(*instance, vector_to_array("_s").alias(out))


def compressed_rows(pixels: DataFrame, mask: Sequence[str], width: int, channels: int = 1, chunk: int = CHUNK) -> DataFrame:
    """(chunk, at, mask, start, stop, indices, data): masks as compressed sparse rows, numbered by ``mask`` and cut into chunks.

    A row is one mask: the places of its non-zero pixels, rising, in the flattened mask (row, column,
    channel), and their values.  ``start`` and ``stop`` are its pointers in the chunk.  Pixels that repeat a place are an
    error, zeros are left out, and a mask without pixels has no row.
    """
    channel = F.col("channel") if channels > 1 else F.lit(0)
    place = ((F.col("row") * width + F.col("col")) * channels + channel).cast("int")
    # Places are made unique before they are gathered, so a list is bounded by the mask's size.
    once = pixels.filter("value <> 0").groupBy(*mask, place.alias("i")).agg(F.max("value").alias("v"), F.count(F.lit(1)).alias("_c"))
    value = F.when(F.col("_c") > 1, F.raise_error(F.lit("a pixel repeats in a mask"))).otherwise(F.col("v"))
    rows = once.groupBy(*mask).agg(F.array_sort(F.collect_list(F.struct("i", value.alias("v")))).alias("_p"))
    indices, data = F.transform("_p", lambda p: p["i"]), F.transform("_p", lambda p: p["v"])
    numbered = row_numbers(rows.select(*mask, indices.alias("indices"), data.alias("data")), [], list(mask), "_n")
    placed = numbered.withColumn("chunk", F.floor(F.col("_n") / chunk).cast("int")).withColumn("at", (F.col("_n") % chunk).cast("int"))
    # A chunk has at most ``chunk`` masks, so its window is bounded.
    stop = F.sum(F.size("indices")).over(Window.partitionBy("chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("stop", stop).select("chunk", "at", *mask, (F.col("stop") - F.size("indices")).alias("start"), "stop", "indices", "data")


def write_compressed(rows: DataFrame, path: str) -> None:
    """One folder for each chunk; written again, it is replaced as a whole."""
    rows.write.mode("overwrite").partitionBy("chunk").parquet(path)


def pixels_of(rows: DataFrame, mask: Sequence[str], width: int, channels: int = 1) -> DataFrame:
    """The pixels (mask, row, col, channel, value) of compressed rows."""
    flat = rows.select(*mask, F.explode(F.arrays_zip("indices", "data")).alias("_p")).select(*mask, F.col("_p.indices").alias("_i"), F.col("_p.data").alias("value"))
    at = F.floor(F.col("_i") / channels)
    return flat.select(*mask, F.floor(at / width).cast("int").alias("row"), (at % width).cast("int").alias("col"), (F.col("_i") % channels).cast("int").alias("channel"), "value")

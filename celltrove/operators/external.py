"""Hooks for models and image code that stay outside, and the tables they exchange.

A hook runs a caller's function on the workers over Arrow batches.  The function gets and
returns a list of rows as dictionaries; nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

Rows = list[dict]


def apply_rows(df: DataFrame, fn: Callable[[Rows], Rows], schema: str) -> DataFrame:
    """Rows that ``fn`` makes of each batch, with the given schema."""
    fields = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_schema(fields)
        for batch in batches:
            yield pa.RecordBatch.from_pylist(fn(batch.to_pylist()), schema=kind)

    return df.mapInArrow(run, schema)


def map_labels(cells: DataFrame, fn: Callable[[Rows], Rows]) -> DataFrame:
    """Label transfer: ``fn`` gives (slide_id, cell_id, label, proba) of cells."""
    return apply_rows(cells, fn, "slide_id string, cell_id string, label string, proba double")


def embed_patches(patches: DataFrame, fn: Callable[[Rows], Rows]) -> DataFrame:
    """Embeddings: ``fn`` gives (slide_id, patch_id, cell_id, vec) of image patches; ``vectors`` reduces them by cell."""
    return apply_rows(patches, fn, "slide_id string, patch_id bigint, cell_id string, vec array<float>")


def segment(patches: DataFrame, fn: Callable[[Rows], Rows]) -> DataFrame:
    """Segmentation: ``fn`` gives (slide_id, patch_id, cell_id, ring) of image patches."""
    return apply_rows(patches, fn, "slide_id string, patch_id bigint, cell_id string, ring array<struct<x: double, y: double>>")


def mask_pixels(masks: DataFrame) -> DataFrame:
    """(slide_id, patch_id, row, col, channel, value) of the non-zero pixels of dense masks (shape [h, w, c], values)."""
    place = F.posexplode("values").alias("at", "value")
    long = masks.select("slide_id", "patch_id", F.col("shape")[1].alias("_w"), F.col("shape")[2].alias("_c"), place).filter("value <> 0")
    at = F.col("at")
    return long.select("slide_id", "patch_id", F.floor(at / (F.col("_w") * F.col("_c"))).cast("int").alias("row"), (F.floor(at / F.col("_c")) % F.col("_w")).cast("int").alias("col"), (at % F.col("_c")).cast("int").alias("channel"), F.col("value").cast("bigint").alias("value"))


def dense_mask(pixels: list[dict], height: int, width: int, channels: int) -> np.ndarray:
    """The dense mask of one patch's pixels, for code that needs an array."""
    out = np.zeros((height, width, channels), np.int64)
    for p in pixels:
        out[p["row"], p["col"], p["channel"]] = p["value"]
    return out

"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..scratch import drop, scratch_dir, written

__all__ = ["cuts", "drop", "scratch_dir", "ship", "slices", "table", "text_bytes", "word_lists", "written"]

#: Rows and bytes of an Arrow batch; a smaller number of rows and any bytes that the session sets stay.
BATCH_ROWS, _BATCH_ROWS = 500, "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES, _BATCH_BYTES = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT = "67108864b"
#: Python workers cut Arrow batches to about this many text bytes at a time.
SLICE_BYTES = 4 << 20
#: Bytes of a text whose words are Python objects at one time.
WORD_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once for each Spark application, and bound the session's Arrow batches.

    A batch is held off-heap on the JVM's side, so its rows are limited: documents are long.
    """
    if int(spark.conf.get(_BATCH_ROWS, "10000")) > BATCH_ROWS:
        spark.conf.set(_BATCH_ROWS, BATCH_ROWS)
    if spark.conf.get(_BATCH_BYTES, _BATCH_DEFAULT) in (_BATCH_DEFAULT, "-1b"):
        spark.conf.set(_BATCH_BYTES, f"{BATCH_BYTES}b")
    context = spark.sparkContext
    if getattr(context, "_celltrove_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    bundle = Path(tempfile.mkdtemp(prefix="celltrove-"), "celltrove_workers.zip")
    with zipfile.ZipFile(bundle, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    context.addPyFile(str(bundle))
    context._celltrove_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], sized: int = 0, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy cuts of each batch whose column ``sized`` holds about ``most`` bytes (one row at least)."""
    for batch in batches:
        for start, count in cuts(batch.column(sized), most):
            yield batch.slice(start, count)


def cuts(column: pa.Array, most: int = SLICE_BYTES) -> list[tuple[int, int]]:
    n = len(column)
    if not n:
        return []
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    ends = np.cumsum(sizes + 64)
    out, start = [], 0
    while start < n:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        out.append((start, min(stop, n) - start))
        start = stop
    return out


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def word_lists(text: bytes, most: int = WORD_BYTES) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, in lists of about ``most`` bytes; cuts are at white space."""
    start = 0
    while start < len(text):
        space = _SPACE.search(text, start + most)
        stop = space.start() if space else len(text)
        yield text[start:stop].lower().split()
        start = stop

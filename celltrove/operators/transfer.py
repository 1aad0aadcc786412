"""Label transfer: each cell's expression as a mixture of reference types.

A cell's normalised expression x is matched by the mixture R'w of type profiles, weights w at
least 0 and with sum 1.  Its least squares needs only b = R x, one join of the sparse entries with the
profiles and one aggregation by cell, and the types' products R R', which are few numbers.  Then
cells are fitted on their own by accelerated projected gradient steps, many in one matrix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import small

#: Types are few: their products are held by every task.
MOST_TYPES = 1000
#: Up to so many types their sums are columns of one aggregation.
MOST_COLUMNS = 64
STEPS = 300


def profiles(reference: DataFrame, gene: str = "gene", kind: str = "type", value: str = "count") -> DataFrame:
    """(type, gene, r): each type's share of its counts by gene, of unit length over genes; types without counts are left out."""
    sums = reference.filter(F.col(gene).isNotNull() & F.col(kind).isNotNull() & (F.col(value) > 0)).groupBy(F.col(kind).alias("type"), F.col(gene).alias("gene")).agg(F.sum(value).cast("double").alias("s"))
    length = sums.groupBy("type").agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("l"))
    return sums.join(length, "type").select("type", "gene", (F.col("s") / F.col("l")).alias("r"))


def transfer_labels(expr: DataFrame, cells: DataFrame, reference: DataFrame, cell: str = "cell_id", gene: str = "gene", value: str = "count", steps: int = STEPS) -> DataFrame:
    """(cell, label, proba, weights): the type of greatest weight of every cell, ties to the lesser, and all weights by type in order.

    ``reference`` is (type, gene, count); genes that it lacks say nothing about a cell.  A cell without counts of its genes
    has no label and null weights.  Entries that repeat a cell and gene add up.
    """
    known = profiles(reference)
    names = [r.type for r in known.select("type").distinct().orderBy("type").limit(MOST_TYPES + 1).collect()]
    if not names or len(names) > MOST_TYPES:
        raise ValueError(f"the reference has to have between 1 and {MOST_TYPES} types")
    place = {t: i for i, t in enumerate(names)}
    inner = np.zeros((len(names), len(names)))
    products = known.join(known.select(F.col("type").alias("other"), "gene", F.col("r").alias("q")), "gene").groupBy("type", "other").agg(F.sum(F.col("r") * F.col("q")).alias("v"))
    for r in products.collect():
        inner[place[r.type], place[r.other]] = r.v
    ids = cells.select(F.col(cell).alias("cell")).filter("cell IS NOT NULL").distinct()
    once = expr.filter(F.col(cell).isNotNull() & (F.col(value) > 0)).groupBy(F.col(cell).alias("cell"), F.col(gene).alias("gene")).agg(F.sum(value).cast("double").alias("x"))
    order = F.lit(names)
    if len(names) <= MOST_COLUMNS:
        # One row for an entry, and all sums of a cell in one aggregation.
        each = [F.coalesce(F.sum(F.when(F.col("type") == F.lit(t), F.col("r"))), F.lit(0.0)).alias(f"r{i}") for i, t in enumerate(names)]
        met = once.join(small(known.groupBy("gene").agg(*each), 1_000_000 // len(names)), "gene")
        sums = met.groupBy("cell").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"), *[F.sum(F.col("x") * F.col(f"r{i}")).alias(f"b{i}") for i in range(len(names))])
        right = sums.select("cell", F.array(*[F.col(f"b{i}") / F.col("length") for i in range(len(names))]).alias("b"))
    else:
        # Rows of at most as many entries as there are types, so their number bounds the bytes.
        listed = small(known.groupBy("gene").agg(F.collect_list(F.struct("type", "r")).alias("_t")), 1_000_000 // len(names))
        met = once.join(listed, "gene")
        size = met.groupBy("cell").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
        each = met.select("cell", "x", F.explode("_t").alias("_e")).groupBy("cell", F.col("_e.type").alias("type")).agg(F.sum(F.col("x") * F.col("_e.r")).alias("b"))
        # At most MOST_TYPES entries for a cell.
        rows = each.groupBy("cell").agg(F.map_from_entries(F.collect_list(F.struct("type", "b"))).alias("_m")).join(size, "cell")
        right = rows.select("cell", F.transform(order, lambda t: F.coalesce(F.try_element_at("_m", t), F.lit(0.0)) / F.col("length")).alias("b"))
    rate = 1.0 / float(np.linalg.eigvalsh(inner).max())

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = inner.shape[0]

        def onto_simplex(w: np.ndarray) -> np.ndarray:
            s = -np.sort(-w, axis=1)
            over = (np.cumsum(s, axis=1) - 1) / np.arange(1, k + 1)
            last = k - 1 - np.argmax((s > over)[:, ::-1], axis=1)
            return np.maximum(w - over[np.arange(len(w)), last][:, None], 0)

        for batch in batches:
            b = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            w = look = np.full(b.shape, 1.0 / k)
            t = 1.0
            for _ in range(steps):
                new = onto_simplex(look - rate * (look @ inner - b))
                ahead = (1 + np.sqrt(1 + 4 * t * t)) / 2
                look = new + (t - 1) / ahead * (new - w)
                w, t = new, ahead
            offsets = pa.array(np.arange(len(w) + 1, dtype=np.int32) * k)
            yield pa.record_batch({"cell": batch.column(0), "weights": pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))})

    kind = dict(ids.dtypes)["cell"]
    fitted = right.mapInArrow(fit, f"cell {kind}, weights array<double>")
    top = F.array_max("weights")
    label = F.get(order, (F.array_position("weights", top) - 1).cast("int"))
    found = fitted.select("cell", label.alias("label"), top.alias("proba"), "weights")
    return ids.join(found, "cell", "left").withColumnRenamed("cell", cell)

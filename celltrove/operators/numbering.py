"""Row numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written


def row_numbers(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Add ``out``, the number from 0 of each row in its group by ``order``.

    Rows are dealt by ranges of group and order, so a hot group, or a single one, is many
    partitions; each is numbered on its own and moved by the sizes of those before it.
    Groups are told apart null-safely.
    """
    dealt = written(df.repartitionByRange(*group, *order).withColumn("_p", F.spark_partition_id()), "numbered")
    sizes = dealt.groupBy(*group, "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    moved = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_p").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col("_p") == F.col("_q")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    own = F.row_number().over(Window.partitionBy(*group, "_p").orderBy(*order)) - 1
    return dealt.withColumn("_own", own).join(moved, same).withColumn(out, F.col("_own") + F.col("_before")).select(*df.columns, out)

"""Spatial bundles: points, vertices, cells and matrices under one catalogue.

A bundle is a folder with a parquet folder for each element, by slide, and the table ``catalogue``: name, kind,
the affine transform (a b c; d e f) of the element's x and y into the bundle's coordinates, and
the column by which each row refers to another element.  The catalogue is written last, so a
folder without one is not a bundle yet; an element is written again as a whole.

Reading prunes elements and slides, brings coordinates together, assembles rings from vertex rows
and checks references: a row that refers to nothing is an error, found by an anti-join when asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import affine
from ..operators.relational import missing_references

SAME = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
_CATALOGUE = "name string, kind string, transform array<double>, refers array<struct<column: string, element: string, key: string>>"
KINDS = ("points", "vertices", "table")


@dataclass(frozen=True)
class Element:
    """``kind``: points and vertices have x and y; vertices have a cell_id and their place ``vertex`` in its ring; tables neither.

    ``refers``: (column, element, key) of each reference, within a slide.
    """

    rows: DataFrame
    kind: str = "table"
    transform: Sequence[float] = SAME
    refers: Iterable[tuple[str, str, str]] = ()


def write_bundle(spark: SparkSession, path: str, elements: dict[str, Element]) -> None:
    """Write all elements, then the catalogue."""
    listed = []
    for name, e in elements.items():
        refers = [tuple(r) for r in e.refers]
        if e.kind not in KINDS or len(e.transform) != 6:
            raise ValueError(f"{name}: kind is one of {KINDS}, and a transform has six numbers")
        if lost := [r for _, r, _ in refers if r not in elements]:
            raise ValueError(f"{name} refers to {lost}, which the bundle does not have")
        e.rows.write.mode("overwrite").partitionBy("slide_id").parquet(f"{path}/{name}")
        listed.append((name, e.kind, [float(x) for x in e.transform], refers))
    spark.createDataFrame(listed, _CATALOGUE).coalesce(1).write.mode("overwrite").parquet(f"{path}/catalogue")


def rings(vertices: DataFrame) -> DataFrame:
    """(slide_id, cell_id, ring): vertices in the order of their places; a ring's points are few, so the list is bounded by them.

    A place that repeats in a ring is an error; vertices without a place, x or y are left out.
    """
    whole = vertices.filter("cell_id IS NOT NULL AND vertex IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
    lists = whole.groupBy("slide_id", "cell_id").agg(F.array_sort(F.collect_list(F.struct("vertex", "x", "y"))).alias("_v"))
    places = F.transform("_v", lambda p: p["vertex"])
    checked = F.when(F.size(F.array_distinct(places)) < F.size(places), F.raise_error(F.lit("a vertex repeats in a ring"))).otherwise(F.col("_v"))
    return lists.select("slide_id", "cell_id", F.transform(checked, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("ring"))


def read_bundle(spark: SparkSession, path: str, names: Sequence[str] | None = None, slides: Sequence | None = None, check: bool = True) -> dict[str, DataFrame]:
    """The elements by name, in the bundle's coordinates, vertices as rings; with ``check`` their references are tested (an action each)."""
    catalogue = {r.name: r for r in spark.read.schema(_CATALOGUE).parquet(f"{path}/catalogue").collect()}
    wanted = list(catalogue) if names is None else list(names)
    if lost := [n for n in wanted if n not in catalogue]:
        raise ValueError(f"the bundle has no {lost}")

    def scan(name: str) -> DataFrame:
        df = spark.read.parquet(f"{path}/{name}")
        return df.filter(F.col("slide_id").isin(list(slides))) if slides is not None else df

    out = {}
    for name in wanted:
        entry, df = catalogue[name], scan(name)
        if check:
            for r in entry.refers:
                parents = scan(r.element).select("slide_id", F.col(r.key).alias(r.column))
                n = missing_references(df.filter(F.col(r.column).isNotNull()).select("slide_id", r.column), parents, ["slide_id", r.column]).count()
                if n:
                    raise ValueError(f"{n} rows of {name} refer by {r.column} to {r.element} rows that are not there")
        if entry.kind != "table" and tuple(entry.transform) != SAME:
            x, y = affine(F.col("x"), F.col("y"), tuple(entry.transform))
            df = df.withColumns({"x": x, "y": y})
        out[name] = rings(df) if entry.kind == "vertices" else df
    return out

"""Readers.  All scans are lazy and distributed; nothing is listed or parsed on the driver."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A parquet table of a directory; projected columns are all that is read."""
    df = spark.read.parquet(f"{root}/{name}.parquet")
    return df.select(*columns) if columns else df


def element(spark: SparkSession, dataset: str, name: str, slides: Sequence[str] | None = None) -> DataFrame:
    """One element of a dataset partitioned by slide_id; listed slides prune partitions."""
    df = spark.read.parquet(f"{dataset}/{name}")
    return df.filter(F.col("slide_id").isin(list(slides))) if slides is not None else df


def csv(spark: SparkSession, path: str | Sequence[str], schema: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed CSV with a header; many files are one table."""
    df = spark.read.csv(path if isinstance(path, str) else list(path), header=True, schema=schema)
    return df.select(*columns) if columns else df


def csv_list(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV columns as strings, chosen by name."""
    return spark.read.csv(path, header=True).select(*columns)


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object for each file, of the given schema."""
    return spark.read.schema(schema).json(path, multiLine=True)


def json_entries(spark: SparkSession, path: str, value: str = "string") -> DataFrame:
    """(file, key, value) of each entry of JSON dictionaries."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.from_json("value", f"map<string,{value}>").alias("m"))
    return text.select("file", F.explode("m").alias("key", "value"))


def yaml_classes(spark: SparkSession, path: str, section: str = "nuclei_types") -> DataFrame:
    """(index, name) of a YAML class map of one level below ``section``, name and index exchanged."""
    lines = F.split(F.col("value"), "\n")
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(lines).alias("at", "line"))
    file = text.withColumn("top", F.last(F.when(F.col("line").rlike("^[A-Za-z_]"), F.regexp_extract("line", "^([A-Za-z_][\\w ]*):", 1)), ignorenulls=True).over(Window.partitionBy("file").orderBy("at")))
    entry = r"^\s+[\"']?([^:\"']+)[\"']?\s*:\s*([0-9]+)\s*$"
    return file.filter((F.col("top") == section) & F.col("line").rlike(entry)).select(F.regexp_extract("line", entry, 2).cast("int").alias("index"), F.trim(F.regexp_extract("line", entry, 1)).alias("name"))


def matrix_market(spark: SparkSession, matrix: str, rows: str, columns: str) -> DataFrame:
    """(gene, cell, count) of a MatrixMarket coordinate file with one name in each line of ``rows`` and ``columns``.

    Names are numbered by line through their byte order in the file; entries join on the numbers.
    """
    entry = r"^\s*([0-9]+)\s+([0-9]+)\s+(\S+)\s*$"
    lines = spark.read.text(matrix).filter(~F.col("value").startswith("%") & F.col("value").rlike(entry))
    cells = lines.select(*[F.regexp_extract("value", entry, i).alias(n) for i, n in ((1, "r"), (2, "c"), (3, "x"))])
    gene, cell = (numbered_lines(spark, p) for p in (rows, columns))
    sizes = gene.agg(F.count(F.lit(1)).alias("n")).first()["n"], cell.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    body = cells.select(F.col("r").cast("bigint"), F.col("c").cast("bigint"), F.col("x").cast("double"))
    header = spark.read.text(matrix).filter(~F.col("value").startswith("%")).limit(1).first()["value"].split()
    if tuple(map(int, header[:2])) != sizes:
        raise ValueError(f"the matrix is {header[0]} x {header[1]}, the names are {sizes[0]} and {sizes[1]}")
    # The size line is the only one that is not an entry; it is known, and dropped once.
    size = (F.col("r") == int(header[0])) & (F.col("c") == int(header[1])) & (F.col("x") == float(header[2]))
    doubtful = body.filter(size).groupBy("r", "c", "x").agg((F.count(F.lit(1)) - 1).alias("n")).filter("n > 0").select("r", "c", "x")
    kept = body.filter(~size).unionByName(doubtful)
    named = kept.join(gene.select(F.col("number").alias("r"), F.col("name").alias("gene")), "r").join(cell.select(F.col("number").alias("c"), F.col("name").alias("cell")), "c")
    return named.select("gene", "cell", F.col("x").alias("count"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(number from 1, name): lines of one text file of names in order, a file of any size in its splits.

    Lines are numbered within their split and moved by the lines of the splits before it.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"), F.col("value").alias("name"))
    sizes = lines.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    moved = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_b").orderBy("_m"))
    return lines.withColumn("_own", own).join(moved, "_b").select((F.col("_own") + F.col("_before")).cast("bigint").alias("number"), "name")


def files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(path, name) of the files with a suffix, the name without it; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path).select("path")
    return found.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1)).withColumn("name", F.expr(f"left(name, length(name) - {len(suffix)})"))


def zip_members(spark: SparkSession, path: str, suffix: str = ".png") -> DataFrame:
    """(file, number) of members whose base name is a whole number before the suffix; '._' files are skipped."""

    @F.arrow_udf("array<string>")
    def names(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([zipfile.ZipFile(io.BytesIO(x)).namelist() for x in column.to_pylist()], pa.list_(pa.string()))

    blobs = spark.read.format("binaryFile").load(path).select("path", F.explode(names("content")).alias("member"))
    base = F.regexp_extract("member", r"([^/]+)$", 1)
    stem = F.regexp_replace(base, suffix.replace(".", r"\.") + "$", "")
    return blobs.filter(base.endswith(suffix) & ~base.startswith("._") & stem.rlike("^[0-9]+$")).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), stem.cast("bigint").alias("number"))


def arrays(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, shape, values array<double>) of .npy files and of the members of .npz files."""

    @F.arrow_udf("array<struct<name: string, shape: array<bigint>, values: array<double>>>")
    def load(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("name", pa.string()), ("shape", pa.list_(pa.int64())), ("values", pa.list_(pa.float64()))]))
        for column in columns:
            out = []
            for blob in column.to_pylist():
                found = np.load(io.BytesIO(blob), allow_pickle=False)
                many = {"": found} if isinstance(found, np.ndarray) else {k: found[k] for k in found.files}
                out.append([{"name": k, "shape": list(a.shape), "values": a.astype(float).ravel()} for k, a in many.items()])
            yield pa.array(out, kind)

    blobs = spark.read.format("binaryFile").load(path).select("path", F.explode(load("content")).alias("a"))
    return blobs.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "a.*")


def small_dict(path: str) -> dict:
    """A small JSON dictionary on the driver's own file system, for literals."""
    return json.loads(Path(path).read_text())

import io
import zipfile

import numpy as np
from pyspark.sql import functions as F

from celltrove.sources import readers, writers
from celltrove.streaming.upsert import ingest_new


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_text_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n")
    (tmp_path / "b.csv").write_text("k,v\n2,y\n")
    assert rows(readers.csv(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"], "k int, v string", ["k"])) == [(1,), (2,)]
    (tmp_path / "m.json").write_text('{"pixel_size": 0.2125,\n "other": 1}')
    assert rows(readers.json_rows(spark, f"{tmp_path}/m.json", "pixel_size double")) == [(0.2125,)]
    (tmp_path / "d.json").write_text('{"a": "1", "b": "2"}')
    assert rows(readers.json_entries(spark, f"{tmp_path}/d.json")) == [("d.json", "a", "1"), ("d.json", "b", "2")] and readers.small_dict(tmp_path / "d.json")["a"] == "1"
    (tmp_path / "c.yaml").write_text("tissue_types:\n  \"x\": 0\nnuclei_types:\n  \"Background\": 0\n  \"Neoplastic\": 1\n")
    assert rows(readers.yaml_classes(spark, f"{tmp_path}/c.yaml")) == [(0, "Background"), (1, "Neoplastic")]


def test_matrix_market(spark, tmp_path):
    (tmp_path / "m.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n% note\n2 3 3\n1 1 5\n2 3 7\n2 3 3\n")
    (tmp_path / "g").write_text("G1\nG2\n")
    (tmp_path / "c").write_text("c1\nc2\nc3\n")
    assert rows(readers.matrix_market(spark, f"{tmp_path}/m.mtx", f"{tmp_path}/g", f"{tmp_path}/c")) == [("G1", "c1", 5.0), ("G2", "c3", 3.0), ("G2", "c3", 7.0)]


def test_binary_formats(spark, tmp_path):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for name in ("dir/12.png", "dir/._13.png", "x.png", "7.png", "8.txt"):
            z.writestr(name, b"")
    (tmp_path / "a.zip").write_bytes(blob.getvalue())
    assert rows(readers.zip_members(spark, f"{tmp_path}/a.zip")) == [("a.zip", 12), ("a.zip", 7)]
    np.savez(tmp_path / "b.npz", u=np.arange(4).reshape(2, 2))
    np.save(tmp_path / "c.npy", np.array([1.5]))
    assert rows(readers.arrays(spark, [f"{tmp_path}/b.npz", f"{tmp_path}/c.npy"])) == [("b.npz", "u", [2, 2], [0.0, 1.0, 2.0, 3.0]), ("c.npy", "", [1], [1.5])]
    assert [r["name"] for r in readers.files(spark, str(tmp_path), ".zip").collect()] == ["a"]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("s1", 1), ("s2", 2)], "slide_id string, k int")
    writers.parquet(df, f"{tmp_path}/d/t", ["slide_id"])
    assert rows(readers.element(spark, f"{tmp_path}/d", "t", ["s2"]).select("k")) == [(2,)]
    writers.replace(spark.read.parquet(f"{tmp_path}/d/t").withColumn("k", F.col("k") + 10), f"{tmp_path}/d/t")
    assert rows(spark.read.parquet(f"{tmp_path}/d/t").select("k")) == [(11,), (12,)]
    for _ in range(2):
        writers.append_new(df.union(df), f"{tmp_path}/new", ["slide_id"])
    assert spark.read.parquet(f"{tmp_path}/new").count() == 2
    writers.csv(df, f"{tmp_path}/csv")
    writers.json_lines(df, f"{tmp_path}/json")
    assert rows(readers.csv_list(spark, f"{tmp_path}/csv", ["k"])) == [("1",), ("2",)] and spark.read.json(f"{tmp_path}/json").count() == 2
    for n, name in ((1, "part_10"), (2, "part_2"), (3, "rest")):
        spark.range(n, n + 1).coalesce(1).write.parquet(f"{tmp_path}/chunks/{name}.parquet")
    assert [r["id"] for r in writers.chunk_order(writers.merge_chunks(spark, f"{tmp_path}/chunks"), "id").collect()] == [2, 1, 3]


def test_incremental_ingest(spark, tmp_path):
    src, out, mark = f"{tmp_path}/src", f"{tmp_path}/out", f"{tmp_path}/mark"
    for batch in ([(1, "old"), (2, "old")], [(2, "new"), (3, "new")]):
        spark.createDataFrame(batch, "k int, v string").write.mode("append").parquet(src)
        ingest_new(spark, src, "k int, v string", out, ["k"], mark)
    assert rows(spark.read.parquet(out)) == [(1, "old"), (2, "old"), (3, "new")]

"""The jobs over growing input, repeated runs, a batch that runs again, awkward rows, and their command lines."""

import json
import logging
import os
import random
import subprocess
import sys
from collections import Counter
from hashlib import md5

import duckdb
import pytest

import jobs
from jobs import count_transcripts, training_set
from jobs.common import configuration, selected

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
POINT = "slide string, px double, py double, gene string"
CELL = "slide string, cell long, ring array<struct<x: double, y: double>>"
MAPPED = {
    "point": {"slide_id": "slide", "x": "px", "y": "py", "feature_name": "gene"},
    "cell": {"slide_id": "slide", "cell_id": "cell", "ring": "ring"},
    "max_files": 2,
}


def square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]


CELLS = [("a", 1, square(0.0, 0.0, 10.0)), ("a", 2, square(5.0, 5.0, 10.0)), ("a", 3, square(0.0, 0.0, 5000.0)), ("b", 1, square(0.0, 0.0, 10.0)), ("b", 9, None), ("b", 10, [(0.0, 0.0), (1.0, 1.0)]), (None, 4, square(0.0, 0.0, 9.0))]


def expected(points):
    """Squares only: a point on an edge is inside."""
    found = Counter()
    for slide, x, y, gene in points:
        if slide is None or gene is None or x is None or y is None or x != x or y != y or abs(x) == float("inf"):
            continue
        for s, cell, ring in CELLS:
            if s == slide and ring and len(ring) == 4 and ring[0][0] <= x <= ring[2][0] and ring[0][1] <= y <= ring[2][1]:
                found[slide, cell, gene] += 1
    return sorted((*k, n) for k, n in found.items())


def some(rng, n, slides="ab"):
    return [(rng.choice(slides), float(rng.randrange(20)), float(rng.randrange(20)), rng.choice("GHK")) for _ in range(n)]


class Points:
    """A folder of point files that grows, and a job on it."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.all = spark, str(folder), []
        spark.createDataFrame(CELLS, CELL).write.parquet(f"{folder}/cells")

    def add(self, rows, files=1):
        self.all += rows
        self.spark.createDataFrame(rows, POINT).repartition(files).write.mode("append").parquet(f"{self.folder}/points")

    def run(self):
        count_transcripts.run(self.spark, MAPPED, f"{self.folder}/points", f"{self.folder}/cells", f"{self.folder}/out", f"{self.folder}/check")

    def counts(self):
        got = count_transcripts.counts(self.spark, MAPPED, f"{self.folder}/points", f"{self.folder}/cells", f"{self.folder}/out")
        return sorted(map(tuple, got.collect()))

    def files(self):
        return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(f"{self.folder}/out") for f in names if f.endswith(".parquet")}

    def batches(self):
        return {d for d in os.listdir(f"{self.folder}/out/partials") if d.startswith("batch=")}


def test_growing_points(spark, tmp_path, caplog):
    rng, work = random.Random(1), Points(spark, tmp_path)
    bad = [(None, 1.0, 1.0, "G"), ("a", None, 1.0, "G"), ("a", float("nan"), 1.0, "G"), ("a", 1.0, float("inf"), "G"), ("a", 1.0, 1.0, None)]
    work.add(some(rng, 300) + bad, files=5)
    with caplog.at_level(logging.INFO, "count_transcripts"):
        work.run()
    assert work.counts() == expected(work.all) and work.counts()
    first = work.batches()
    assert len(first) == 3  # five files, two for each batch
    read = [r.args[1] for r in caplog.records if r.msg.startswith("batch ")]
    assert sum(read) == 305 and sum(r.args[2] for r in caplog.records if r.msg.startswith("batch ")) == 5
    assert spark.read.parquet(f"{tmp_path}/out/rejected").count() == 5
    # New files only: one slide's points leave the other slide's counts and all older partials as they are.
    before = work.files()
    work.add(some(rng, 50, "a"))
    caplog.clear()
    with caplog.at_level(logging.INFO, "count_transcripts"):
        work.run()
    assert work.counts() == expected(work.all)
    assert [r.args[1] for r in caplog.records if r.msg.startswith("batch ")] == [50] and len(work.batches()) == len(first) + 1
    after = work.files()
    kept = [f for f in before if "/partials/" in f or "/counts/slide_id=b/" in f or "/rejected/" in f]
    assert kept and all(after.get(f) == before[f] for f in kept)
    # Nothing new: nothing changes.
    work.run()
    assert work.files() == after


def test_a_batch_that_runs_again(spark, tmp_path):
    rng, work = random.Random(2), Points(spark, tmp_path)
    work.add(some(rng, 80))
    work.run()
    work.add(some(rng, 80))
    work.run()
    done, batches = work.counts(), work.batches()
    # As after a failure between the writes of the last batch and its commit.
    last = max(os.listdir(f"{tmp_path}/check/commits"), key=lambda f: int(f) if f.isdigit() else -1)
    for name in (last, f".{last}.crc"):
        if os.path.exists(path := f"{tmp_path}/check/commits/{name}"):
            os.remove(path)
    work.run()
    assert work.counts() == done == expected(work.all) and work.batches() == batches


def test_one_hot_slide_and_no_points(spark, tmp_path):
    rng, work = random.Random(3), Points(spark, tmp_path)
    work.add([("b", 500.0, 500.0, "G")])  # in no cell
    work.run()
    assert work.counts() == []
    work.add([("a", 3.0, 3.0, "G")] * 3000 + some(rng, 10), files=3)
    work.run()
    assert work.counts() == expected(work.all)


def test_no_files_give_empty_counts(spark, tmp_path):
    work = Points(spark, tmp_path)
    spark.createDataFrame([], POINT).write.parquet(f"{tmp_path}/points")
    work.run()
    work.run()
    assert work.counts() == []


def test_two_ways_to_the_same_counts(spark, tmp_path):
    rng = random.Random(4)
    rows = some(rng, 200)
    (tmp_path / "x").mkdir(), (tmp_path / "y").mkdir()
    whole, pieces = Points(spark, tmp_path / "x"), Points(spark, tmp_path / "y")
    whole.add(rows)
    whole.run()
    for i in range(0, 200, 70):
        pieces.add(rows[i : i + 70])
        pieces.run()
    assert whole.counts() == pieces.counts()


RECORDS = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["ab", "cd\n", "é", "fg\t"]) for _ in range(rng.randrange(8, 60))), rng.choice(["en", "fr"]), f"s{i % 4}", 0) for i in range(120)]
    rows += [rows[3]] * 2 + [(4, "another text under an id that is taken already, of eleven words or more", "en", "s0", 0)]
    rows += [(None, "no id " * 20, "en", "s1", 0), (200, None, "en", "s2", 0), (201, "", "fr", "s2", 0), (202, "x " * 20, None, "s1", 0), (203, "x " * 20, "en", None, 0), (204, "few labels " * 9, "en", "rare", 0), (205, "word " * 200_000, "en", "s2", 0)]
    return rows


def labels():
    return [(i, i % 2, int(i % 10 == 0)) for i in range(0, 100, 2)] + [(8, 1, 1), (None, 1, 1), (9999, 1, 0), (204, 1, 0), (1, None, None)]


def training(spark, folder, rows, marks):
    config = configuration(spark, f"file://{training_set.CONFIG}")
    spark.createDataFrame(rows, RECORDS).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    paths = f"{folder}/documents.parquet", f"{folder}/labels.parquet", f"{folder}/out"
    training_set.run(spark, config, *paths)
    return [sorted(map(tuple, f(spark, config, paths[0], paths[2]).collect())) for f in (training_set.dataset, training_set.census)]


def test_training_set_equals_its_sql(spark, tmp_path, caplog):
    with caplog.at_level(logging.INFO, "training_set"):
        data, census = training(spark, tmp_path, documents(), labels())
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    sql = jobs.SQL["job2_training_set"]
    assert data == sorted(con.execute(f"SELECT record_id, slide_id, label, n_words, bin, text, split, tissue FROM ({sql}) WHERE output = 'dataset'").fetchall())
    assert census == sorted(con.execute(f"SELECT tissue, label, n, words, share, split FROM ({sql}) WHERE output = 'census'").fetchall())
    told = {r.msg: r.args for r in caplog.records}
    assert any(a and a[:3] == (130, 3, len(data)) for a in told.values())


def test_texts_move_once_and_by_their_place(spark, tmp_path, monkeypatch):
    """What is written to the dataset has two exchanges: of the texts, and of the decisions."""
    kind, plans = type(spark.range(1).write), []
    write = kind.parquet

    def seen(self, path, *a, **k):
        if path.endswith("/dataset"):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *a, **k)

    monkeypatch.setattr(kind, "parquet", seen)
    data, _ = training(spark, tmp_path, documents() * 2, labels())
    assert len({r[0] for r in data}) == len(data)
    moved = [line for line in plans[0].splitlines() if "Exchange" in line]
    assert len(plans) == 1 and len(moved) == 2 and not [line for line in moved if "Broadcast" in line]


def test_training_set_rules(spark, tmp_path):
    data, _ = training(spark, tmp_path, documents(), labels())
    found = {r[0]: r for r in data}
    assert len(found) == len(data) and not {None, 202, 203, 204} & set(found)
    assert found[205][3] == 200_000 and found[200][2] == found[201][2] == "Less10" and found[200][3] == 0
    for i in (i for i in range(100) if i in found and found[i][3] > 10):
        # An id of two annotations has the lesser label, 8 is Poor and Toxic.
        assert found[i][2] == ("NoAnnot" if i % 2 else "Toxic" if i % 10 == 0 else "Poor")
    edges = [0.8, 0.9, 1.0]
    for r in data:
        place = int(md5((r[5] or "").encode()).hexdigest()[:8], 16) / 2**32
        assert r[6] == ("train", "valid", "test")[next(n for n, e in enumerate(edges) if place < e)]


def test_training_set_runs_again(spark, tmp_path):
    first = training(spark, tmp_path, documents(), labels())
    assert training(spark, tmp_path, documents(), labels()) == first
    # What is gone from the input goes from the output, its partitions too.
    data, census = training(spark, tmp_path, [r for r in documents() if r[2] != "fr"], labels())
    assert {r[7] for r in data} == {"en"} == {r[0] for r in census}


def test_training_set_of_nothing(spark, tmp_path):
    assert training(spark, tmp_path, [], []) == [[], []]
    assert training(spark, tmp_path, documents(), []) == [[], []]  # no slide has annotations


def test_configured_columns_have_to_be_there(spark):
    with pytest.raises(ValueError, match="tissue"):
        selected(spark.range(1), {"record_id": "id"}, ("record_id", "tissue"))


def call(job, folder, **where):
    """A job's command line in another working folder, its paths in a store that only Spark can open."""
    conf = f"--master local[2] --conf spark.ui.enabled=false --conf spark.hadoop.fs.viewfs.mounttable.store.link./in=file://{folder} --conf spark.checkpoint.dir=file://{folder}/scratch"
    args = [f"--{k}={v}" for k, v in where.items()]
    return subprocess.run([sys.executable, f"{ROOT}/jobs/{job}.py", *args], cwd=folder, capture_output=True, text=True, timeout=300, env=os.environ | {"PYSPARK_SUBMIT_ARGS": f"{conf} pyspark-shell"})


def test_points_by_command_line_from_a_store(spark, tmp_path):
    rng, work = random.Random(6), Points(spark, tmp_path)
    (tmp_path / "config.json").write_text(json.dumps(MAPPED))
    store = "viewfs://store/in"
    where = {"config": f"{store}/config.json", "points": f"{store}/points", "cells": f"{store}/cells", "output": f"{store}/out", "checkpoint": f"{store}/check"}
    for n in (30, 20):
        work.add(some(rng, n))
        run = call("count_transcripts", tmp_path, **where)
        assert run.returncode == 0, run.stderr[-2000:]
        assert f"read {n} points" in run.stderr
        assert work.counts() == expected(work.all)


def test_training_set_by_command_line_from_a_store(spark, tmp_path):
    data, census = training(spark, tmp_path, documents(), labels())
    store = "viewfs://store/in"
    run = call("training_set", tmp_path, documents=f"{store}/documents.parquet", labels=f"{store}/labels.parquet", output=f"{store}/again")
    assert run.returncode == 0, run.stderr[-2000:]
    assert f"wrote {len(data)} to {store}/again/dataset" in run.stderr
    config = configuration(spark, f"file://{training_set.CONFIG}")
    assert sorted(map(tuple, training_set.dataset(spark, config, f"{tmp_path}/documents.parquet", f"{tmp_path}/again").collect())) == data
    assert sorted(map(tuple, training_set.census(spark, config, f"{tmp_path}/documents.parquet", f"{tmp_path}/again").collect())) == census
    missing = call("training_set", tmp_path, documents=f"{store}/documents.parquet")
    assert missing.returncode == 2 and "--labels" in missing.stderr


def test_queries_restore_the_session_and_leave_their_files(spark):
    before = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.")}
    one, two = (jobs.QUERIES["job1_transcript_counts"](spark, "/root/testdata/sf0.001") for _ in range(2))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and one.inputFiles() != two.inputFiles()
    assert {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.")} == before and not spark.streams.active


def test_jobs_do_not_need_the_training_data_part():
    for name in os.listdir(f"{ROOT}/jobs"):
        if name.endswith(".py"):
            with open(f"{ROOT}/jobs/{name}", encoding="utf-8") as f:
                text = f.read()
            assert "llm" not in text and "corpus_pipeline" not in text, name

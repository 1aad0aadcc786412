import random

from pyspark.sql import functions as F

import corpus_pipeline
from celltrove.llm import decontaminate, pii, toxicity

from .test_minhash import brute as components
from .test_native import brute as hits
from .texts import AWKWARD

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, save, docs, items, labels):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    return save(
        documents=spark.createDataFrame(rows, COLUMNS).withColumn("_toxicity", F.lit(1)),
        benchmark=spark.createDataFrame(items, "item_id long, text string"),
        labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_stages_equal_brute_force(spark, save, tmp_path):
    rng = random.Random(5)
    prose = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    passage, copy = prose(14), prose(60)
    texts = [prose(rng.randrange(5, 80)) + (" vile rotten wretch" if i % 6 == 0 else "") for i in range(240)]
    labels = [(i, 1, int(i % 6 == 0)) for i in range(240)]
    texts += [copy, copy, copy + " more", f"{prose(20)} {passage} {prose(20)}", "mail a@b.com " + prose(9), *AWKWARD, "vile rotten wretch " + prose(10)]
    docs = list(enumerate(texts)) + [(240, copy), (None, "no id here"), (None, "no id here")]
    items = [(1, passage), (2, None)]
    sf = tables(spark, save, docs, items, labels)
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(frame.select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet"))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf)
        frame.write.parquet(f"{tmp_path}/stage-{name}")
        frame = spark.read.parquet(f"{tmp_path}/stage-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == list(corpus_pipeline.COLUMNS)
        seen.append(sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str))
    bad = {"vile", "rotten", "wretch"}
    first = [d for d in docs if not bad & set((d[1] or "").split())]
    assert {w.decode() for w, s in model.lexicon.items() if s > 0} == bad
    assert seen[0] == sorted(first, key=str)
    kept = {d for d, _, _, k in components(first, 5) if k and d is not None}
    second = sorted({d for d in first if d[0] in kept or d[0] is None}, key=str)
    assert seen[1] == second and len(second) < len(first)
    dirty = {d for d, *_, x in hits(second, items) if x}
    third = [d for d in second if d[0] not in dirty]
    assert seen[2] == third and dirty == {243}
    assert seen[3] == sorted([(d, "mail [EMAIL]" + t[12:] if t and t.startswith("mail a@b.com") else t) for d, t in third], key=str)
    assert all(pii.base_spans(t or "") == [] for _, t in seen[3])
    assert seen[4] == sorted([(d, t or "") for d, t in seen[3]], key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.run(spark, sf).collect()), key=str) == seen[4]


def test_empty_tables(spark, save):
    sf = tables(spark, save, [], [], [])
    assert corpus_pipeline.run(spark, sf).count() == 0
    assert decontaminate.WINDOW == 10


def test_near_dedup_decides_by_id_and_text(spark, save):
    prose = lambda k: " ".join(f"{k}{i}" for i in range(40))
    docs = [
        (1, prose("a")), (2, prose("a") + " more"), (2, prose("b")),  # of id 2 only the copy goes, whichever sorts first
        (3, prose("0")), (3, prose("z")), (3, prose("z")),  # two documents, one of them twice
        (4, prose("c")), (4, prose("c") + " more"),  # one component of one id
        (None, prose("a") + " else"), (None, prose("d")), (None, prose("d") + " more"), (None, prose("d")), (None, prose("e")),
        (5, ""), (5, None), (5, None), (None, ""),
    ]
    sf = tables(spark, save, docs, [], [])
    got = corpus_pipeline.stage_near_dedup(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect()
    short = sorted((str(r["doc_id"]), r["text"] and r["text"][:2]) for r in got if r["text"])
    assert short == [("1", "a0"), ("2", "b0"), ("3", "00"), ("3", "z0"), ("4", "c0"), ("None", "d0"), ("None", "e0")]
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got if not r["text"]) == [("5", ""), ("5", "None"), ("None", "")]
    assert got[0].__fields__ == list(corpus_pipeline.COLUMNS)


def test_a_task_of_a_stage_has_one_python_worker(spark, save):
    """Workers of two functions in a row are all alive at once, each with its tables, beside the executor's heap."""
    sf = tables(spark, save, [(1, "mail a@b.com")], [], [])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for stage in (corpus_pipeline.stage_pii, corpus_pipeline.stage_byte_bpe):
        assert stage(spark, docs, sf)._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython ") == 1

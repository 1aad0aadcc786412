import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from celltrove.llm import lm

from .texts import AWKWARD, documents


def brute(rows, good):
    """(id, words, score) of each row, from the counts of all other rows."""
    parts = [((t or "").encode().lower().split(), d in good, d) for d, t in rows]
    parts = [([None, *w, None] if w else [], y, d) for w, y, d in parts]
    grams = lambda w: Counter(w[1:]) + Counter(zip(w, w[1:]))
    n, t = Counter(), Counter()
    for w, y, _ in parts:
        n.update(grams(w))
        if y:
            t.update(grams(w))
    every, target = (sum(len(w) - 1 for w, y, _ in parts if w and y >= k) for k in (0, 1))
    vocabulary, s, out = sum(not isinstance(g, tuple) for g in n), lm.STRENGTH, []
    for w, y, d in parts:
        own, total, size = grams(w), 0.0, max(0, len(w) - 1)
        a = lambda g: n[g] - own[g]  # noqa: B023, E731
        b = lambda g: t[g] - own[g] * y  # noqa: B023, E731
        for x, c in zip(w, w[1:]):
            p = (a(c) + 1) / (every - size + vocabulary)
            q = (b(c) + s * p) / (target - size * y + s)
            total += math.log2((a((x, c)) + s * p) / (a(x) + s)) - math.log2((b((x, c)) + s * q) / (b(x) + s))
        out.append((str(d), max(0, len(w) - 2), total / max(1, size)))
    return sorted(out)


def check(spark, save, rows, good, ids):
    labels = spark.createDataFrame([(i, int(i in good), 0) for i in ids], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("target", F.lit(3)).withColumn("n", F.lit(3))
    got = lm.op10_lm_score(spark, save(documents=docs, labels=labels)).collect()
    found = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in got)
    want = brute(rows, good)
    assert len(found) == len(rows)
    for a, b in zip(found, want, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=2e-5)


@pytest.mark.parametrize(("bucket", "slice_bytes"), [(40, 3000), (lm.BUCKET, lm.SLICE_BYTES)])
def test_scores_equal_brute_force(spark, save, monkeypatch, bucket, slice_bytes):
    monkeypatch.setattr(lm, "BUCKET", bucket)
    monkeypatch.setattr(lm, "SLICE_BYTES", slice_bytes)
    # The last two share their letters and differ in words.
    texts = AWKWARD + [f"w{i % 7} w{i % 11} shared words" for i in range(60)] + ["tone note", "note tone"] * 3 + ["eno tton", "tone note"]
    good = {i for i in range(len(texts)) if i % 4 == 1} | {len(texts) - 1}
    rows = list(enumerate(texts)) + [(3, "another text"), (None, "w1 w2"), (None, None), (20, texts[20])]
    check(spark, save, rows, good, [*range(len(texts)), 1, 5])


def test_long_text(spark, save):
    rows = [(0, "one two three " * 200_000), (1, "two three"), (2, "four"), (3, "one two three")]
    check(spark, save, rows, {1, 3}, range(4))


def test_repeated_documents_are_told_apart(spark, save):
    """A text that occurs twice is likelier under the other rows than one that occurs once."""
    texts = [" ".join(f"u{i}x{k}" for k in range(30)) for i in range(40)]
    texts += texts[:10]
    rows = lm.op10_lm_score(spark, save(documents=documents(spark, texts), labels=spark.createDataFrame([(15, 1, 0)], "doc_id long, quality int, toxic int"))).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert min(score[i] for i in range(10)) > max(score[i] for i in range(10, 40))


def test_empty_tables(spark, save):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert lm.op10_lm_score(spark, save(documents=documents(spark, []), labels=labels)).count() == 0
    rows = lm.op10_lm_score(spark, save(documents=documents(spark, ["a", None]), labels=labels)).collect()
    assert sorted(r["n_tokens"] for r in rows) == [0, 1]

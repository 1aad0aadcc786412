import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from celltrove.llm import toxicity

from .texts import AWKWARD, documents


def brute_segments(scores):
    """All maximal segments by their definition: best segment first, of equal ones the shortest, then left and right of it."""
    if not scores:
        return []
    best = None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or (total, i - j) > (best[2], best[0] - best[1])):
                best = (i, j, total)
    if best is None:
        return []
    i, j, _ = best
    return brute_segments(scores[:i]) + [best] + [(a + j + 1, b + j + 1, s) for a, b, s in brute_segments(scores[j + 1 :])]


@given(st.lists(st.sampled_from([0, 0, 0, 5, -7, 3, 11]), max_size=40))
def test_all_maximal_segments(marks):
    scores = [m - 1 for m in marks]
    got = toxicity.maximal_segments([(i, float(m)) for i, m in enumerate(marks) if m], drift=1.0)
    want = brute_segments(scores)
    assert [(a, b, round(s, 6)) for a, b, s in got] == [(a, b, float(s)) for a, b, s in want]


def brute_model(texts, labels):
    """The whole operator in plain Python: lexicon, Karlin-Altschul constants, logistic curve; a function from text to probability."""
    said = lambda t: re.findall(r"[0-9a-z\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    train = [(said(texts[i]), y) for i, y in labels.items() if zlib.crc32(str(i).encode()) % 5]
    seen = {y: Counter(w for words, z in train if z == y for w in set(words)) for y in (0, 1)}
    total = {y: sum(seen[y].values()) for y in (0, 1)}
    odds, mass = {}, {}
    for w in set(seen[0]) | set(seen[1]):
        t, c = seen[1][w] + 0.5, seen[0][w] + 0.5
        d = math.log(t / (total[1] + 1 - t)) - math.log(c / (total[0] + 1 - c))
        if abs(d) / math.sqrt(1 / t + 1 / c) >= 3:
            odds[w], mass[w] = d, c / total[0]
    scores = lambda words: [odds.get(w, 0.0) - 0.05 for w in words]
    excess = lambda x: sum(mass[w] * math.exp(x * (odds[w] - 0.05)) for w in odds) + max(0, 1 - sum(mass.values())) * math.exp(-0.05 * x) - 1
    low, high = 1e-6, 1.0
    while excess(high) < 0:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    segments = lambda words: [s for *_, s in brute_segments(scores(words))] if any(odds.get(w, 0) > 0 for w in words) else []
    clean = [(len(w), segments(w)) for w, y in train if not y]
    tops = sorted((s for _, p in clean for s in p), reverse=True)
    level = tops[len(clean) // 100] if len(tops) > len(clean) // 100 else 0.0
    log_k = math.log(max(1, sum(s >= level - 1e-9 for s in tops))) + low * level - math.log(sum(n for n, _ in clean))
    evidence = lambda words: math.log1p(sum(max(0.0, low * s - log_k - math.log(max(1, len(words)))) for s in segments(words)))
    x, y = np.array([evidence(w) for w, _ in train]), np.array([float(z) for _, z in train])
    # The penalised likelihood's optimum, by plain gradient steps on a grid that shrinks.
    best, width = (0.0, 0.0), 30.0
    loss = lambda a, b: float(np.logaddexp(0, a * x + b).sum() - y @ (a * x + b)) + 0.5e-2 * a * a + 0.5e-6 * b * b
    for _ in range(80):
        grid = [(best[0] + i * width / 4, best[1] + j * width / 4) for i in range(-4, 5) for j in range(-4, 5)]
        best = min(((a, b) for a, b in grid if 0 <= a <= 30 and -30 <= b <= 30), key=lambda p: loss(*p))
        width *= 0.7
    return lambda t: 1 / (1 + math.exp(-max(-30, min(30, best[0] * evidence(said(t)) + best[1]))))


def test_whole_operator_against_brute_force(spark, save):
    docs, labels = corpus(3, 250)
    texts = docs + AWKWARD + ["x" * 40 + " vile " * 3000 + "é"]
    sf = save(documents=documents(spark, texts), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = {r["doc_id"]: r["score"] for r in toxicity.op1_toxicity(spark, sf).collect()}
    model = brute_model(docs, {i: y for i, _, y in labels})
    for i, t in enumerate(texts[:-1]):
        assert rows[i] == pytest.approx(model(t), abs=2e-3), i
    assert rows[len(texts) - 1] > 0.9


def test_repeated_ids_and_clashing_columns(spark, save):
    docs, labels = corpus(4, 600)
    rows = [(i, t, 0, "f") for i, t in enumerate(docs)] + [(0, "vile rotten scorn wretch vile rotten", 0, "f"), (0, docs[0], 0, "f"), (None, docs[1], 0, "f")]
    sf = save(documents=spark.createDataFrame(rows, "doc_id long, text string, score int, y string"), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = toxicity.op1_toxicity(spark, sf).collect()
    assert len(found) == len(rows) and sorted(r["predicted"] for r in found if r["doc_id"] == 0)[-1] == 1


def corpus(seed, n):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [f"w{min(rng.randrange(400), rng.randrange(400))}" for _ in range(rng.randrange(5, 120))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(rng.randrange(1, 5)):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "rotten", "scorn", "wretch"]))
        docs.append(" ".join(w))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_held_out_accuracy_and_awkward_rows(spark, save):
    docs, labels = corpus(1, 600)
    texts = docs + AWKWARD + ["VILE rotten wretch!"]
    sf = save(documents=documents(spark, texts).withColumn("toxicity", F.lit(1)), labels=spark.createDataFrame(labels + [(5, 0, 0)], "doc_id long, quality int, toxic int"))
    rows = {r["doc_id"]: r for r in toxicity.op1_toxicity(spark, sf).collect()}
    assert len(rows) == len(texts)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for i, r in rows.items())
    test = [(rows[i]["predicted"], y) for i, _, y in labels if rows[i]["held_out"]]
    assert sum(p == y for p, y in test) / len(test) > 0.97
    assert all(rows[len(docs) + k]["predicted"] == 0 for k in range(len(AWKWARD))) and rows[len(texts) - 1]["predicted"] == 1


def test_held_out_labels_and_other_columns_do_not_matter(spark, save):
    docs, labels = corpus(2, 300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (sorted(map(tuple, toxicity.op1_toxicity(spark, save(documents=documents(spark, docs), labels=spark.createDataFrame(x, "doc_id long, quality int, toxic int"))).collect())) for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(0, 1, 1)], [(1, 1, None), (None, 1, 1)]])
def test_without_both_kinds_of_labels(spark, save, labels):
    sf = save(documents=documents(spark, ["a b", None, ""]), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert toxicity.op1_toxicity(spark, sf).count() == 3
    sf = save(documents=documents(spark, []), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert toxicity.op1_toxicity(spark, sf).count() == 0

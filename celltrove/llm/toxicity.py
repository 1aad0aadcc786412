"""Toxicity by maximum-scoring segment search.

Each word has a log-odds of toxic against clean documents under a Dirichlet prior;
words whose log-odds are within Z standard errors of 0 are neutral, and every word
pays a small drift, so a clean text drifts down.  One linear scan finds all maximal
scoring segments of a text.  Scores are turned into E-values by the extreme-value law
of such segments: lambda is the root of E[exp(lambda * s)] = 1 over clean words, K is
matched to the exceedances in clean training documents.  A document's evidence is the
sum of -ln E over its significant passages, and a logistic curve fitted on the training
documents turns it into a probability.

Fitting uses at most MAX_TRAIN labelled documents, those of smallest id hash; that is a
bound on labelled rows only.  The lexicon holds every word of them that is not neutral and
is what goes to the workers.  The driver receives the lexicon, a few numbers and one pair of
numbers for each training document, never texts or passages.  Scoring is row-local and reads
whole texts of any length, by one pass of their words.  Null and empty texts have
no passages and get the curve's base value.  A document with several label rows counts
as toxic if any says so; of several texts of an id the least is learned from.  Without
labels of both kinds the lexicon is empty and the score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cuts, drop, table, text_bytes, written
from .decontaminate import words

MAX_TRAIN = 20_000
#: Prior pseudo-count of a word in each class, standard errors, cost of every word.
PRIOR, Z, DRIFT = 0.5, 3.0, 0.05
#: A-Z to lower case and what is not part of a word to space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass
class Model:
    lexicon: dict[bytes, float] = field(default_factory=dict)
    scale: float = 1.0  # lambda
    log_k: float = 0.0
    weight: float = 0.0
    bias: float = -20.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def maximal_segments(marks: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence that has score s - drift at each (position, s) of ``marks`` and -drift elsewhere."""
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, last earlier one with a smaller sum before
    total = 0.0
    for at, s in marks:
        before = total - drift * at
        total += s
        after = total - drift * (at + 1)
        if after <= before:
            continue
        first = at
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                found.append((first, at, before, after, j))
                break
            first, before = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, round(r - l, 9)) for a, b, l, r, _ in found]  # equal segments have equal scores at any place


def _passages(text: bytes, lexicon: dict[bytes, float], positive: frozenset[bytes]) -> tuple[int, list[tuple[int, int, float]]]:
    said = text.translate(_TABLE).split()
    if positive.isdisjoint(said):
        return len(said), []
    return len(said), maximal_segments([(i, lexicon[w]) for i, w in enumerate(said) if w in lexicon])


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learn from the labelled rows that are not held out; ``docs`` has doc_id and text, ``labels`` doc_id and toxic."""
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # At most max_train rows, so broadcasting has a proven bound.
    train = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    train = written(train, "toxicity-sample")
    per_word = train.select("y", F.explode(F.array_distinct(words(F.col("text")))).alias("word")).groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    totals = per_word.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first()
    n_t, n_c = float(totals["t"]), float(totals["c"])
    model = Model()
    if n_t and n_c:
        odds = lambda y, n: F.log((F.col(y) + PRIOR) / (F.lit(n + PRIOR) - F.col(y)))
        scored = per_word.withColumn("d", odds("t", n_t) - odds("c", n_c)).withColumn("z", F.col("d") / F.sqrt(1 / (F.col("t") + PRIOR) + 1 / (F.col("c") + PRIOR)))
        best = scored.filter(F.abs("z") >= Z).orderBy("word").collect()
        model.lexicon = {r["word"].encode(): r["d"] for r in best}
        weights = np.array([(r["c"] + PRIOR) / n_c for r in best])
        model.scale = _lambda(np.array([r["d"] for r in best]) - DRIFT, weights)
    raw = _features(train, model)
    if model.lexicon:
        # Clean documents are the null model: the level that 1 in 100 of them exceeds fixes K (0 if fewer have any segment).
        clean = raw.filter("y = 0")
        size = clean.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
        scores = clean.select(F.explode("scores").alias("s"))
        place = (size["docs"] or 0) // 100 + 1
        tops = scores.orderBy(F.desc("s")).limit(place).agg(F.min("s").alias("s"), F.count(F.lit(1)).alias("n")).first()
        level = tops["s"] if tops["n"] == place else 0.0
        above = max(1, scores.filter(F.col("s") >= level).count())
        model.log_k = math.log(above) + model.scale * level - math.log(max(1, size["words"] or 0))
    pairs = raw.select("y", _evidence_of(F.col("n"), F.col("scores"), model).alias("x")).toArrow().sort_by([("y", "ascending"), ("x", "ascending")])  # at most max_train rows
    drop(train, raw)
    if not len(pairs):
        return model
    x, y = pairs["x"].to_numpy(), pairs["y"].to_numpy().astype(float)
    model.weight, model.bias = _logistic(np.log1p(x), y)
    return model


def _lambda(s: np.ndarray, p: np.ndarray) -> float:
    """Positive root of E[exp(lambda s)] = 1, the rest of the mass paying the drift alone."""
    rest = max(0.0, 1 - p.sum())

    def excess(x: float) -> float:
        return float(p @ np.exp(np.minimum(x * s, 700)) + rest * math.exp(-x * DRIFT) - 1)

    low, high = 1e-6, 1.0
    if excess(low) >= 0:  # no negative drift: scores are used as they are
        return 1.0
    while excess(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def _log_e(n: int, s: float, model: Model) -> float:
    return model.log_k + math.log(max(n, 1)) - model.scale * s


def _evidence(n: int, scores: list[float], model: Model) -> float:
    return sum(max(0.0, -_log_e(n, s, model)) for s in scores)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Weight and bias by Newton steps; a light ridge on the weight keeps separable data finite."""
    w = np.zeros(2)
    a = np.stack([x, np.ones_like(x)], 1)
    ridge = np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge, a.T @ (p - y) + ridge @ w)
        w = np.clip(w - step, -30, 30)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(0.0, w[0])), float(w[1])


def _evidence_of(n: Column, scores: Column, model: Model) -> Column:
    log_e = F.lit(model.log_k) + F.log(F.greatest(n, F.lit(1)))
    return F.aggregate(scores, F.lit(0.0), lambda a, s: a + F.greatest(F.lit(0.0), F.lit(model.scale) * s - log_e))


def _features(train: DataFrame, model: Model) -> DataFrame:
    """(y, n, scores) of each training document: its words and the scores of its segments."""
    lexicon = model.lexicon

    @F.arrow_udf("n long, scores array<double>")
    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        positive = frozenset(w for w, s in lexicon.items() if s > 0)
        for column in columns:
            for start, count in cuts(column):
                rows = [_passages(t, lexicon, positive) for t in text_bytes(column.slice(start, count))]
                yield pa.array([{"n": n, "scores": [s for *_, s in p]} for n, p in rows], pa.struct([("n", pa.int64()), ("scores", pa.list_(pa.float64()))]))

    return written(train.withColumn("f", scan("text")).select("y", "f.n", "f.scores"), "toxicity-segments")


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Add ``out``: struct<score, evidence, passages array<struct<first_word, last_word, score, log_e>>>, the significant passages of each text."""

    @F.arrow_udf("score double, evidence double, passages array<struct<first_word: int, last_word: int, score: double, log_e: double>>")
    def toxic(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = model.lexicon
        positive = frozenset(w for w, s in lexicon.items() if s > 0)
        span = pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64()), ("log_e", pa.float64())])
        for column in columns:
            for start, count in cuts(column):
                out = []
                for t in text_bytes(column.slice(start, count)):
                    n, found = _passages(t, lexicon, positive)
                    x = _evidence(n, [s for *_, s in found], model)
                    p = 1 / (1 + math.exp(-min(30.0, max(-30.0, model.weight * math.log1p(x) + model.bias))))
                    spans = [(a, b, s, e) for a, b, s in found if (e := _log_e(n, s, model)) < 0]
                    out.append({"score": p, "evidence": x, "passages": [dict(zip(("first_word", "last_word", "score", "log_e"), q, strict=True)) for q in spans]})
                yield pa.array(out, pa.struct([("score", pa.float64()), ("evidence", pa.float64()), ("passages", pa.list_(span))]))

    return docs.withColumn(out, toxic(text))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    p = F.round("toxicity.score", 6)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), p.alias("score"), (p >= 0.5).cast("int").alias("predicted"), F.size("toxicity.passages").cast("long").alias("n_passages"))

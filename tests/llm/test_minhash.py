import random

import numpy as np
import pytest

from celltrove.llm import minhash
from celltrove.llm.common import word_lists
from celltrove.llm.components import connected

from .texts import AWKWARD


def sets(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs, size=4):
    s = [sets(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= 80 * len(s[i] | s[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, len(s[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(docs)), key=str)


def family(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(most)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def run(spark, docs):
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=4)
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("large", [16, 2])
def test_components_equal_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(minhash, "LARGE", large)
    rng = random.Random(large)
    texts = list(AWKWARD) + AWKWARD + ["three word text", "THREE word\ttext", "one"]
    for k in range(6):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.choice([8, 40, 90, 200]))]
        texts += family(rng, base, 25, max(2, len(base) // 12)) + [" ".join(base)] * 3
    rng.shuffle(texts)
    docs = [(3 * i + 1, t) for i, t in enumerate(texts)] + [(1, "row with the id of another"), (None, "null id here now ok"), (None, texts[5])]
    assert run(spark, docs) == brute(docs)


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, None)]) == brute([(1, None), (2, None)])


def test_components_of_a_path(spark):
    rows = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("900", "901"), ("901", "902")]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(rows, "a string, b string")).collect()}
    assert set(got.values()) == {"000", "900"} and got["040"] == "000" and got["902"] == "900"


def test_query_uses_four_words(spark, save):
    docs = [(i, t) for i, t in enumerate(["a b c d e", "a b c d e f", "x y", None])]
    got = minhash.op5_minhash(spark, save(documents=spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS n")))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs) and brute(docs)[0][1] == 2


def test_rows_of_equal_digests_are_confirmed_on_their_sets(spark, monkeypatch):
    """With a digest that tells nothing, only the full sets part the classes."""
    monkeypatch.setattr(minhash, "_digest", lambda h: b"0" * 16)
    monkeypatch.setattr(minhash, "CLASS_ROWS", 7)
    rng = random.Random(5)
    texts = [*AWKWARD, "a b c d e", "A  b\tc d e", "other words than these", None, ""]
    texts += family(rng, [f"w{k}" for k in range(60)], 8, 9) * 2
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, "a row with the id of another"), (None, texts[1]), (None, "null id here")]
    assert run(spark, docs) == brute(docs)


def test_long_texts_are_compared_as_sets_are(monkeypatch):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(9)]
    texts = ["", " ", "one", "ONE", "one two", "one two three four", "a" * 300] + [" ".join(rng.choices(words, k=rng.randrange(1, 200))) for _ in range(12)]
    monkeypatch.setattr(minhash, "LONG", -1)
    for x in texts:
        for y in texts:
            for size in (1, 2, 4, 5):
                a, b = sets(x, size), sets(y, size)
                assert minhash.overlap(x.encode(), y.encode(), size) == (len(a), len(b), len(a & b))


def test_long_texts(spark):
    base = [f"w{k % 997}x{k % 89}" for k in range(300_000)]
    docs = [(1, " ".join(base)), (2, "  ".join(base).upper()), (3, " ".join(base[:250_000])), (4, " ".join(base[:2000])), (5, "x" * 3_000_000), (6, None)]
    assert run(spark, docs) == brute(docs)


def test_words_are_the_same_in_pieces():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choices("aB \t\n\x0b\x0c\r\x1c ", k=rng.randrange(60))).encode()
        assert [w for part in word_lists(text, rng.randrange(1, 9)) for w in part] == text.lower().split()


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(100):
        u = rng.integers(0, 2**63, 300).astype(np.uint64)
        agree.append((minhash.signature(np.unique(u[:240]), 128) == minhash.signature(np.unique(u[60:]), 128)).mean())
    assert abs(np.mean(agree) - 0.6) < 0.02

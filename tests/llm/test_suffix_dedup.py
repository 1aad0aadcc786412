import hashlib
import random
import subprocess
import sys

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from celltrove.llm import suffix, suffix_dedup

from .texts import AWKWARD


def brute(docs, length):
    raw = [(t or "").encode() for _, t in docs]
    seen = {}
    for t in raw:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for (d, _), t in zip(docs, raw):
        gone = np.zeros(len(t) + 2, np.int8)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = 1
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((d, len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs, length=200, **more):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("kept", F.lit(0)).withColumn("start", F.lit("x"))
    done = suffix_dedup.remove_repeats(df, length, **more)
    rows = done.select("doc_id", "text", "repeats").collect()
    return sorted(((r["doc_id"], len((r["text"] or "").encode()), len((r["text"] or "").encode()) - len(r["repeats"]["kept"]), len(r["repeats"]["spans"]), hashlib.sha256(bytes(r["repeats"]["kept"])).hexdigest()) for r in rows), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(x % 3 for x in b)), max_size=6), st.integers(1, 40))
def test_sorting_finds_equal_suffixes(groups, depth):
    data, at, group = b"", [], []
    for g, t in enumerate(groups):
        at += [len(data) + i for i in range(len(t) - depth + 1)]
        group += [g] * max(0, len(t) - depth + 1)
        data += t
    got = suffix.repeated(suffix.characters(np.frombuffer(data, np.uint8)), np.array(at, np.int64), np.array(group, np.int64), depth)
    each = [(g, data[a : a + depth]) for a, g in zip(at, group)]
    assert got.tolist() == [each.count(x) > 1 for x in each]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=1, max_size=12), st.integers(1, 30), st.sampled_from([2, 256])).map(lambda x: bytes(c % x[2] for c in x[0]) * x[1]), min_size=1, max_size=5), st.integers(1, 90))
def test_sorted_order(groups, depth):
    """The order is that of the first ``depth`` bytes within each group, and equal neighbours are marked."""
    data, at, group = b"", [], []
    for g, t in enumerate(groups):
        at += [len(data) + i for i in range(len(t) - depth + 1)]
        group += [g] * max(0, len(t) - depth + 1)
        data += t
    group = np.unique(np.array(group, np.int64), return_inverse=True)[1]
    order, equal = suffix.sort(suffix.characters(np.frombuffer(data, np.uint8)), np.array(at, np.int64), group, depth)
    said = [(int(group[i]), data[at[i] : at[i] + depth]) for i in order]
    assert sorted(order.tolist()) == list(range(len(at))) and said == sorted(said)
    assert equal.tolist() == [i > 0 and said[i] == said[i - 1] for i in range(len(said))]


def test_blind_tries_order_long_common_prefixes():
    rng = random.Random(2)
    stem = bytes(rng.randrange(256) for _ in range(150))
    texts = [stem + bytes(rng.randrange(2) for _ in range(50)) for _ in range(400)]
    texts += texts[:100]
    at = np.arange(len(texts)) * 200
    order, equal = suffix.sort(suffix.characters(np.frombuffer(b"".join(texts), np.uint8)), at, np.zeros(len(at), np.int64), 200)
    said = [texts[i] for i in order]
    assert said == sorted(texts) and equal.sum() == len(texts) - len(set(texts))


def texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, near = prose(60), prose(120).split(" ")
    out = list(AWKWARD) + ["ab" * 300, "ab" * 310 + "x", "z" * 700, "y" + "z" * 199, "z" * 200]
    for _ in range(12):
        out.append(prose(rng.randrange(40)) + passage + prose(rng.randrange(40)))
        w = list(near)
        w[rng.randrange(len(w))] = word()
        out.append(" ".join(w))
    copy = prose(80)
    return out + [copy] * 4 + [copy + "!"]


@pytest.mark.parametrize(("length", "gram", "bucket"), [(200, 32, 65536), (200, 32, 100), (200, 32, 1), (40, 8, 65536), (33, 12, 50)])
def test_equals_brute_force(spark, length, gram, bucket):
    docs = list(enumerate(texts(length + gram)))
    docs += [(3, "same id, other text"), (None, docs[-1][1]), (7, docs[7][1])]
    assert run(spark, docs, length, gram=gram, bucket=bucket) == brute(docs, length)


def test_other_lengths(spark):
    docs = list(enumerate(texts(9)))
    assert run(spark, docs, 60, gram=16) == brute(docs, 60)


def test_query_on_sample_and_empty_table(spark, save):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, suffix_dedup.op9_suffix_dedup(spark, "/root/testdata/sf0.001").collect()), key=str) == brute(docs, 200)
    empty = save(documents=spark.createDataFrame([], "doc_id long, text string"))
    assert suffix_dedup.op9_suffix_dedup(spark, empty).count() == 0


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 100)
    rng = random.Random(4)
    text = bytes(rng.randrange(97, 101) for _ in range(1000))
    pieces = [(a, text[a : a + 100 + 199]) for a in range(0, len(text) - 199, 100)]
    which, start, n, *_ = suffix_dedup.find_spans([p for _, p in pieces], 200, 32)
    begun = sorted(i for w, s, k in zip(which, start, n) for i in range(pieces[w][0] + s, pieces[w][0] + s + k))
    assert begun == list(range(len(text) - 199))


def test_text_longer_than_a_piece(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh") for _ in range(suffix_dedup.PIECE + 1500))
    at = suffix_dedup.PIECE - 130
    docs = [(1, text), (2, "-" * 50 + text[at : at + 400] + "+" * 20), (3, text[-300:])]
    want = [(1, len(text), 700, 2), (2, 470, 400, 1), (3, 300, 300, 1)]
    assert [r[:4] for r in run(spark, docs)] == want


def test_an_anchor_of_many_bytes_is_split(spark, monkeypatch):
    """One window with many surroundings: an anchor of few windows but many bytes."""
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    core = word(60)
    docs = [(i, word(30) + core + word(30)) for i in range(60)] + [(100 + i, word(9) + core[5:50] + word(9)) for i in range(5)]
    want = brute(docs, 40)
    assert run(spark, docs, 40, gram=8, bucket=65536) == want
    monkeypatch.setattr(suffix_dedup, "MOST_BYTES", 200)
    assert run(spark, docs, 40, gram=8, bucket=65536) == want


def test_memory_of_one_sort():
    """The largest anchor that is sorted at once, in spans of one window each."""
    code = """
import resource
import numpy as np
from celltrove.llm import suffix, suffix_dedup as S
n = S.MOST_BYTES // S.LENGTH
rng = np.random.default_rng(1)
data = rng.integers(97, 105, n * S.LENGTH).astype(np.uint8)
data.reshape(n, S.LENGTH)[:, 60:] = data[60 : S.LENGTH]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
suffix.repeated(suffix.characters(data), np.arange(n) * S.LENGTH, np.zeros(n, np.int64), S.LENGTH)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    added = float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert added < 150

import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from celltrove.llm import packing

from .texts import AWKWARD, documents

ODD = ["a\xa0b \xa0 c\xa0\n d", "x\x1c y\x1f\x1f  z", "<|endoftext|> a<|endoftext|>", "  lead　 ", "a \n b\n  c\t\td   ", "it's l'été  '", "!!\n\n??  \r\n\r\n x", "word" * 40_000, "a" + " " * 300_000 + "\n" * 2000 + "b", "\n".join(f"line {i} of a long text, 12{i}" for i in range(9000))]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, size=1024):
    """Sequences are gapless, at most ``size`` and of a power of two; pieces of a row cover it once."""
    sequences, rest = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        rest[r.row].append(r)
        assert r.length > 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size and at & (at - 1) == 0
        assert {p.sequence_tokens for p in pieces} == {at} and len({p.step_group for p in pieces}) == 1
    for pieces in rest.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert {p.doc_tokens for p in pieces} == {at}
    return sequences, rest


def test_whole_documents_come_back(spark, tokenizer):
    texts = AWKWARD + ODD
    docs = documents(spark, texts).unionByName(documents(spark, ["again", "again", None])).repartition(3)
    rows = packing.pack(docs, pool=4096).collect()
    _, rest = check(rows)
    got = []
    for pieces in rest.values():
        pieces.sort(key=lambda p: p.start)
        got.append((pieces[0].doc_id, [i for p in pieces for i in p.ids]))
        assert all(zlib.crc32(struct.pack(f"<{p.length}I", *p.ids)) == p.ids_crc32 for p in pieces)
    assert sorted(got) == sorted((i, expected(tokenizer, t)) for part in (texts, ["again", "again", None]) for i, t in enumerate(part))


def test_ids_are_the_library_s_for_every_character(tokenizer):
    encode = packing._encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    for start in range(0, 0x110000, 256):
        text = "".join(f"a{c}b {c} {c}1{c}{c}\n" for c in map(chr, range(start, start + 256)) if not "\ud800" <= c <= "\udfff")
        assert encode(text) == struct.pack(f"<{len(ids := tokenizer.encode(text, add_special_tokens=False).ids)}I", *ids), start


def test_other_tokenizers_go_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = packing._encoder(path, public_tokenizers.PATTERN)
    ids = Tokenizer.from_file(path).encode("Some words, 12.", add_special_tokens=False).ids
    assert encode("Some words, 12.") == struct.pack(f"<{len(ids)}I", *ids)


def test_query_on_the_given_columns(spark, save, tokenizer):
    df = documents(spark, AWKWARD).withColumn("doc_id", F.when(F.col("doc_id") != 3, F.col("doc_id")))
    for c in ("row", "start", "length", "ids", "key", "offset", "sequence_id", "step_group"):
        df = df.withColumn(c, F.lit("x"))
    got = packing.op12_packing(spark, save(documents=df)).collect()
    totals = {r.doc_id: r.doc_tokens for r in got}
    assert totals == {None if i == 3 else i: len(expected(tokenizer, t)) for i, t in enumerate(AWKWARD)}
    assert sum(r.length for r in got) == sum(totals.values())
    empty = packing.op12_packing(spark, save(documents=df.limit(0)))
    assert empty.count() == 0 and "ids_crc32" in empty.columns


def test_sequences_hold_their_pieces(spark):
    pieces = packing.pack(documents(spark, AWKWARD))
    got = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    for r in pieces.collect():
        s = got[r.sequence_id]
        assert s.ids[r.offset : r.offset + r.length] == r.ids
        assert len(set(s.segments[r.offset : r.offset + r.length])) == 1 and len(s.ids) == len(s.segments)
    odd = spark.createDataFrame([(1, 0, 0, [5, 6, 7])], "sequence_id long, step_group long, offset long, ids array<int>")
    assert [tuple(r) for r in packing.sequences(odd, 8).collect()] == [(1, 0, [5, 6, 7, 0, 0, 0, 0, 0], [1, 1, 1, 0, 0, 0, 0, 0])]


def test_tiers_are_powers_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(documents(spark, ["a"]), tiers=(100, 1024))


def piece(row, n, start=0):
    return (row, row, start + n, start, n, bytes(4 * n))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_windows_are_full_and_cuts_few(lengths):
    rests = packing.Rests()
    for i, n in enumerate(lengths):
        rests.add(piece(i, n))
    done, left = packing.windows(rests, (16, 32, 64))
    short = packing.powers(left)
    assert rests.lengths == 0 and all(sum(p[4] for p in w) in (16, 32, 64) for w in done)
    assert all((n := sum(p[4] for p in w)) & (n - 1) == 0 for w in short) and len(short) <= 6
    covered = defaultdict(list)
    for w in done + short:
        for p in w:
            assert len(p[5]) == 4 * p[4]
            covered[p[0]].append((p[3], p[3] + p[4]))
    for i, n in enumerate(lengths):
        spans = sorted(covered[i])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert sum(map(len, done)) <= len(lengths) + len(done)  # a window cuts one rest at most


def test_a_rest_opens_a_window_of_its_own_tier_and_shorter_tiers_fill_it():
    rests = packing.Rests()
    for i, n in enumerate((40, 24, 20, 12, 10, 6)):
        rests.add(piece(i, n))
    done, left = packing.windows(rests, (16, 32, 64))
    assert [[p[4] for p in w] for w in done] == [[40, 24], [20, 12], [10, 6]] and not left


def test_step_groups_have_the_same_mix():
    seqs = [[piece(i, n)] for i, n in enumerate([1024] * 130 + [512] * 61 + [256] * 50)]
    groups = packing.step_groups(seqs, 1 << 15)
    loads, mix = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for s, g in zip(seqs, groups):
        loads[g] += s[0][4]
        mix[s[0][4]][g] += 1
    assert set(loads) == set(range(5)) and max(loads.values()) - min(loads.values()) <= 1024
    assert all(max(m.values()) - min(m.values()) <= 1 for m in mix.values())

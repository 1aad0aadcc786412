import hashlib
import subprocess
import sys

from hypothesis import given, strategies as st

from pyspark.sql import functions as F

from celltrove.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["", None, "[INST]", "[/INST]", "<s>", "</s>", "[\\INST]", "<\\\\s>", "[END]", "[ROLE]x[/ROLE]", "é🙂", "\\", "[[INST]]", "a[SYS]b[/SYS]c", "<<s>>"]


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    res = {}
    for conv, turns in out.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        res[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), digest(loss))
    return res


def test_round_trip(spark, save):
    rows = [(c, t, role, text) for c, role in enumerate(["user", "assistant", "system", "tool", None, "[INST]"]) for t, text in enumerate(NASTY)]
    rows += [(50, i, r, t) for i, t in enumerate(NASTY) for r in ("assistant", "user")]
    rows += [(50, 1, "user", "[INST]"), (None, 0, "user", "x"), (51, None, "assistant", "y")]
    got = chat.op4_chat(spark, save(conversations=spark.createDataFrame(rows, SCHEMA)))
    want = brute(rows + [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")])
    assert {r["conv_id"]: tuple(r)[1:5] for r in got.collect()} == want


def test_sample_table(spark):
    path = "/root/testdata/sf0.001/conversations.parquet"
    rows = [tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    got = chat.op4_chat(spark, "/root/testdata/sf0.001")
    want = brute(rows)
    assert {r["conv_id"]: tuple(r)[1:5] for r in got.collect() if r["conv_id"] != -7} == want


def test_empty_table(spark, save):
    got = chat.op4_chat(spark, save(conversations=spark.createDataFrame([], SCHEMA))).collect()
    assert [r["conv_id"] for r in got] == [-7] and got[0]["loss_chars"] == 21


@given(st.text(alphabet="<>[]/\\sINTSYROLED x"))
def test_escape_is_reversible(text):
    import re

    safe = re.sub(chat.ESCAPE, r"\1\\\2\3", text)
    assert chat.unescape(safe) == text
    assert list(chat.parse(f"[INST]{safe}[/INST]<s>{safe}</s>")) == [("user", text), ("assistant", text)]


def test_one_conversation_of_25_mb(spark):
    turns, size = 5_000, 5000
    roles = ("user", "assistant")
    rows = spark.range(turns).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, roles[0]).otherwise(roles[1]).alias("role"), F.repeat(F.concat(F.lit("</s>é"), F.format_string("%04d", F.col("id") % 10_000)), size // 10).alias("text")
    )
    got = chat.read_back(chat.format_chat(rows)).first()
    said, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
    for i in range(turns):
        text = f"</s>é{i % 10_000:04d}" * (size // 10)
        said.update(f"{roles[i % 2]}\n{text}\n".encode())
        if i % 2:
            loss.update(text.encode())
            chars += len(text)
    assert tuple(got)[:5] == (1, turns, said.hexdigest(), chars, loss.hexdigest())


def test_memory_of_assembly():
    """Peak above the input, for one conversation of 100 MB, stays within a few times its text."""
    code = """
import resource, sys
import pyarrow as pa
from celltrove.llm import chat
import numpy as np
text = "x" * 5000
rows = pa.table({"conv_id": [1] * 20000, "role": ["user"] * 20000, "text": [text] * 20000})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
chat._assemble(rows, np.array([0, 20000]))
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    added = float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert added < 5 * 100


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(1, 0, "user", "a", 9, "f"), (1, 0, "user", "a", 9, "f"), (1, 1, "assistant", None, 9, "f")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss int, formatted string")
    got = chat.format_chat(docs).first()
    assert got["formatted"] == "[INST]a[/INST][INST]a[/INST]<s></s>" and [tuple(x) for x in got["loss"]] == [(31, 31)]

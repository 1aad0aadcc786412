import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from celltrove.llm import bpe

from .texts import AWKWARD, documents


@pytest.fixture(scope="module")
def reference():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(reference, i, text):
    ids = reference.encode_ordinary(text or "")
    return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_query_equals_the_library(spark, save, reference):
    sample = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts = AWKWARD + sample + AWKWARD
    got = bpe.op6_byte_bpe(spark, save(documents=documents(spark, texts).withColumn("ids", F.lit("clash"))))
    assert sorted(map(tuple, got.collect())) == [expected(reference, i, t) for i, t in enumerate(texts)]


def test_empty_table_and_clashing_columns(spark, save):
    assert bpe.op6_byte_bpe(spark, save(documents=documents(spark, []))).count() == 0
    rows = bpe.decode(bpe.encode(documents(spark, ["ab", None]).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2)))).orderBy("doc_id").collect()
    assert bytes(rows[0]["decoded"]) == b"ab" and rows[1]["ids"] == []


def test_ranks_must_be_contiguous(tmp_path):
    (tmp_path / "r").write_bytes(base64.b64encode(b"a") + b" 3\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "r"))

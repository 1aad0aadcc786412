"""Benchmark decontamination with DataFrame functions only.

A window is WINDOW consecutive words of a benchmark item, or the whole of a shorter
item.  A document is read and cut into words once, and the words into pieces of PIECE words
that overlap by a window less a word, so that what a row carries is bounded however long the
text is.  Any window of L words covers an aligned block of b = (L + 1) // 2 words of its
piece, so only every b-th block is hashed and probed in the broadcast set of the benchmark's
b-word blocks; all lengths L are probed in one pass.  A block that is found
brings its 2L - b neighbouring words along, and the windows in them are verified
against the benchmark windows by their words.  Verified positions are merged for each
document.  Only hits and one row of counts for each document are shuffled, never texts.

The benchmark side is broadcast when counted at no more than BROADCAST_WINDOWS
windows; a larger one is left to a shuffled join.  Null and empty texts have no words
and no hits; an empty benchmark hits nothing.  Documents are keyed by (doc_id, text hash):
repeated rows each get the same result, a null id is an id like any other.  Items that
repeat a window all count; items without an id hit, but are not listed.  Further columns are not looked at, or kept as
they are by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WINDOW = 10
#: Words of a piece of a text.
PIECE = 1024
BROADCAST_WINDOWS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null has none."""
    plain = F.char_length(text) == F.octet_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(F.coalesce(low, F.lit("")), GAP), lambda w: w != "")


def _windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, len, win) of every window of every item."""
    w = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    w = w.withColumn("len", F.least(F.size("w"), F.lit(window)))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("at")
    return w.select("item_id", "len", "w", at).select("item_id", "len", F.slice("w", F.col("at"), F.col("len")).alias("win"))


def window_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, at, len, item_ids): benchmark windows found in documents, ``at`` counted from 0.

    Each row of ``docs`` has one row of len 0 besides, whose ``at`` is its number of words.
    """
    windows = _windows(items, window)
    by_len = {r["len"]: r["n"] for r in windows.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `window` rows
    hint = F.broadcast if sum(by_len.values()) <= BROADCAST_WINDOWS else (lambda df: df)
    half = F.floor((F.col("len") + 1) / 2).cast("int")
    # The rows of len 0 let each document's count of words pass both joins.
    none = docs.sparkSession.range(1)
    known = windows.groupBy("len", F.array_join("win", " ").alias("win")).agg(F.collect_set("item_id").alias("item_ids"))
    known = known.unionByName(none.select(F.lit(0).alias("len"), F.lit("").alias("win"), F.array().cast(known.schema["item_ids"].dataType).alias("item_ids")))
    blocks = windows.select("len", F.explode(F.sequence(F.lit(1), F.col("len") - half + 1)).alias("i"), "win").select("len", F.xxhash64(F.slice("win", F.col("i"), half)).alias("h")).distinct()
    blocks = blocks.unionByName(none.select(F.lit(0).alias("len"), F.lit(0).cast("long").alias("h")))

    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(PIECE)), lambda s: F.struct(s.alias("base"), F.size("w").alias("n"), F.slice("w", s + 1, PIECE + window - 1).alias("w")))
    pieces = split.select("doc_id", "text_hash", F.explode(pieces).alias("p")).select("doc_id", "text_hash", "p.*")

    def probes(size: int):
        b = (size + 1) // 2
        first = lambda i: F.greatest(i * b - (size - b), F.lit(0))
        whole = F.when(F.size("w") >= size, F.sequence(F.lit(0), F.floor(F.size("w") / b).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
        # Of block i: its hash, the word its neighbourhood starts at, the neighbourhood.
        return F.transform(whole, lambda i: F.struct(F.lit(size).alias("len"), F.xxhash64(F.slice("w", i * b + 1, F.lit(b))).alias("h"), (F.col("base") + first(i)).alias("first"), F.slice("w", first(i) + 1, i * b + size - first(i)).alias("near")))

    count = F.struct(F.lit(0).alias("len"), F.lit(0).cast("long").alias("h"), F.col("n").alias("first"), F.array().cast("array<string>").alias("near"))
    empty = F.array().cast("array<struct<len: int, h: bigint, first: int, near: array<string>>>")
    every = F.concat(F.when(F.col("base") == 0, F.array(count)).otherwise(empty), *[probes(size) for size in sorted(by_len)])
    probe = pieces.select("doc_id", "text_hash", F.explode(every).alias("x")).select("doc_id", "text_hash", "x.*")
    hit = probe.join(hint(blocks), ["len", "h"], "left_semi").filter(F.size("near") >= F.col("len"))
    spread = hit.select("doc_id", "text_hash", "len", "first", "near", F.explode(F.sequence(F.lit(0), F.size("near") - F.col("len"))).alias("j"))
    spread = spread.select("doc_id", "text_hash", "len", (F.col("first") + F.col("j")).alias("at"), F.array_join(F.slice("near", F.col("j") + 1, F.col("len")), " ").alias("win"))
    return spread.join(hint(known), ["len", "win"]).select("doc_id", "text_hash", "at", "len", "item_ids")


def covered(spans: Column) -> Column:
    """Number of words under a sorted array of (at, len)."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(s["at"] + s["len"] - F.greatest(a["upto"], s["at"]), F.lit(0))).alias("n"),
        F.greatest(a["upto"], s["at"] + s["len"]).alias("upto"),
    )
    return F.aggregate(spans, start, step, lambda a: a["n"])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, copies, n_words, spans, item_ids) of every document; spans are sorted (at, len) in words, copies its number of rows."""
    hits = window_hits(docs, items, window)
    found = F.col("len") > 0
    one = hits.groupBy("doc_id", "text_hash").agg(
        F.count_if(~found).alias("copies"), F.max(F.when(~found, F.col("at"))).alias("n_words"),
        F.sort_array(F.collect_set(F.when(found, F.struct("at", "len")))).alias("spans"), F.collect_set(F.when(found, F.col("item_ids"))).alias("many"),
    )
    return one.select("doc_id", "text_hash", "copies", "n_words", "spans", F.array_distinct(F.flatten("many")).alias("item_ids"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit, all columns kept."""
    bad = window_hits(docs.select("doc_id", "text"), items, window).filter("len > 0")
    bad = bad.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left_anti")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    found = found.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    ids = F.col("item_ids").cast("array<string>")
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), covered(F.col("spans")).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(ids), ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
il AS (SELECT *, least(len(w), 10) AS n FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM il)),
size AS (SELECT DISTINCT n FROM win),
dp AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, size WHERE len(w) >= n),
hit AS (SELECT doc_id, i, dp.n, item_id FROM dp JOIN win ON dp.n = win.n AND array_to_string(list_slice(w, i, i + dp.n - 1), ' ') = s),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

"""Near-duplicate detection by circulant MinHash.

Signatures: a permutation sigma scatters a document's shingle hashes over the places of a
circle of 2 ** PLACES values, which are a second permutation, pi.  Every coordinate uses
that one pi, circularly shifted by the coordinate's number: h_k is the least
pi(sigma(v) + k) over the set.  BANDS bands of ROWS coordinates give a pair of Jaccard 0.8 a
chance of 1 - 4e-9 to share a band, and one of 0.3 a chance of 0.05.  Sets that fill a good
part of the circle look more alike than they are, which costs comparisons, not links.

Documents whose shingle hashes have one digest are a class, which is confirmed on the full
sets: the texts of a class are compared with its first text, in parts of bounded size, and
rows of another set (hash collisions) become classes of their own.  Classes are the nodes
from there on.
In a band's bucket nobody meets everybody: each class is compared with the bucket's most
central class (whose own buckets are the fullest), on the shingles of the texts
themselves.  Links are closed into components.  What is left are pairs of one bucket in
different components; those are all compared too, so no link of a shared bucket is lost,
but only within exact bounds: in large buckets the shingles that no other class of such
buckets has are counted, and with n shingles of which u are unique an intersection holds
at most n - u.  Copies edited beyond the threshold fall to that bound without a
comparison; the others are compared in tiles of blocks, through inverted lists, so that
only pairs that reach the threshold become rows, which are confirmed on the texts like
all others.

Texts are shuffled once (copies, and classes in shared buckets), then pairs with their texts.
Null, empty and wordless texts have empty sets and link with nothing; a text of any length
is hashed whole, a mebibyte of words at a time, and long ones are compared as numbered
shingles.  Rows are the documents: repeated rows are exact copies, rows that share only an
id are not linked by it.  A null id is greater than all others.  Columns of the input whose
names are those of the result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cuts, drop, ship, slices, table, text_bytes, word_lists, written
from .components import connected

BANDS, ROWS = 64, 6
#: Places of the circle, as a power of two.
PLACES = 22
#: Words of a shingle and the least similarity in per cent, unless a caller says otherwise.
WORDS, PERCENT = 5, 80
#: Buckets of more classes are thinned by unique shingles before their pairs are made.
LARGE = 16
#: Classes and shingle hashes of a block of a tile.
BLOCK, BLOCK_HASHES = 256, 1 << 18
#: Blocks of a group that its outsiders meet in one part.
TILES = 16
#: Rows of a class that are confirmed in one part.
CLASS_ROWS = 4096
#: Texts of more bytes are compared as numbered shingles instead of sets of words.
LONG = 1 << 16
#: Word hashes a worker keeps.
CACHE = 200_000
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE:
            self.clear()
        self[word] = h
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes, hashes: dict, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``size`` words."""
    parts = [np.array([hashes[x] for x in words], np.uint64) for words in word_lists(text)]
    w = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    if not len(w):
        return w
    k = min(size, len(w))
    h = np.full(len(w) - k + 1, np.uint64(k))
    for i in range(k):
        h = _mix(h * _M1 + w[i : len(w) - k + 1 + i])
    return np.unique(h)


def _digest(h: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(h.tobytes())


@lru_cache(maxsize=2)
def _circle(coordinates: int) -> np.ndarray:
    """The permutation pi of the places, and the start of the circle once more."""
    mask = np.uint32((1 << PLACES) - 1)
    x = np.arange(1 << PLACES, dtype=np.uint32)
    for odd in (0x2C1B3C6D, 0x297A2D39, 0x85EBCA6B):  # each step is one to one on PLACES bits
        x = (x * np.uint32(odd)) & mask
        x ^= x >> np.uint32(PLACES // 2)
    return np.concatenate([x, x[:coordinates]])


def signature(h: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a non-empty set: least pi(sigma(v) + k) for each k."""
    shifted = np.lib.stride_tricks.sliding_window_view(_circle(coordinates), coordinates)
    at = (_mix(h ^ _M1) >> np.uint64(64 - PLACES)).astype(np.int64)
    out = np.full(coordinates, np.uint32(0xFFFFFFFF))
    for lo in range(0, len(at), 256):
        np.minimum(out, shifted[at[lo : lo + 256]].min(0), out=out)
    return out.astype(np.uint64)


def shingles(text: bytes, size: int = WORDS) -> set:
    """The shingles themselves, as tuples of words."""
    w = text.lower().split()
    k = min(size, len(w))
    return set(zip(*(w[i:] for i in range(k)), strict=False)) if k else set()


def _numbered(x: bytes, y: bytes, size: int) -> list[np.ndarray]:
    """Sorted numbers of the shingles of both texts; two shingles have one number only if their words are the same."""
    ids: dict[bytes, int] = {}
    words = [np.concatenate([np.empty(0, np.int64), *(np.array([ids.setdefault(w, len(ids)) for w in part], np.int64) for part in word_lists(t))]) for t in (x, y)]
    ks = [min(size, len(w)) for w in words]
    grams = words
    for i in range(1, max(ks)):
        longer = [g[: max(0, len(w) - i)] * len(ids) + w[i:] if i < k else g[:0] for g, w, k in zip(grams, words, ks, strict=True)]
        numbers = np.unique(np.concatenate(longer), return_inverse=True)[1]
        grown = (numbers[: len(longer[0])], numbers[len(longer[0]) :])
        grams = [n if i < k else g for n, g, k in zip(grown, grams, ks, strict=True)]
    if ks[0] != ks[1]:  # one text is a single shingle of fewer words: nothing in common
        grams = [grams[0], -1 - grams[1]]
    return [np.unique(g) for g in grams]


def overlap(x: bytes, y: bytes, size: int = WORDS) -> tuple[int, int, int]:
    """Sizes of two texts' shingle sets and of their intersection, exact at any length."""
    if max(len(x), len(y)) <= LONG:
        a, b = shingles(x, size), shingles(y, size)
        return len(a), len(b), len(a & b)
    a, b = _numbered(x, y, size)
    return len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = WORDS) -> DataFrame:
    """(doc_id, n, set_key binary(16), keys array<long>): set size, set hash and band keys of each row, and further columns."""
    kind = pa.struct([("n", pa.int64()), ("set_key", pa.binary()), ("keys", pa.list_(pa.int64()))])

    @F.arrow_udf("n long, set_key binary, keys array<long>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _Hashes()
        for column in columns:
            for start, count in cuts(column):
                out = []
                for t in text_bytes(column.slice(start, count)):
                    h = shingle_hashes(t, hashes, size)
                    if not len(h):
                        out.append({"n": 0, "set_key": None, "keys": None})
                        continue
                    s = signature(h, bands * rows).reshape(bands, rows)
                    key = np.arange(1, bands + 1, dtype=np.uint64)
                    for r in range(rows):
                        key = _mix(key * _M1 + s[:, r])
                    out.append({"n": len(h), "set_key": _digest(h), "keys": key.view(np.int64)})
                yield pa.array(out, kind)

    carried = [c for c in docs.columns if c != "text"]
    return docs.select(*carried, run("text").alias("s")).select(*carried, "s.*")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) whose texts' shingle sets reach the threshold; ``b`` is the side that repeats."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, theirs = None, set()
        for batch in slices(batches, 2):
            keep = []
            for i, (b, mine, other) in enumerate(zip(batch.column(1).to_pylist(), text_bytes(batch.column(2)), text_bytes(batch.column(3)), strict=True)):
                if max(len(mine), len(other)) > LONG:
                    n, m, both = overlap(mine, other, size)
                else:
                    if b != last:
                        last, theirs = b, shingles(other, size)
                    own = shingles(mine, size)
                    n, m, both = len(own), len(theirs), len(own & theirs)
                keep.append(100 * both >= percent * (n + m - both))
            yield pa.record_batch([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(check, "a binary, b binary")


def _unique_counts(members: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(node, u): shingles of each class that no other class of ``members`` has.  Hash collisions only lower u."""
    kind = pa.list_(pa.int64())

    @F.arrow_udf("array<long>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _Hashes()
        for column in columns:
            for start, count in cuts(column):
                yield pa.array([shingle_hashes(t, hashes, size).view(np.int64) for t in text_bytes(column.slice(start, count))], kind)

    nodes = members.select("node").distinct()
    each = texts.join(nodes, "node").select("node", F.explode(run("text")).alias("h"))
    alone = each.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).filter("c = 1")
    return alone.groupBy("node").agg(F.count(F.lit(1)).alias("u"))


def _standing(members: DataFrame, nodes: DataFrame, texts: DataFrame, roots: DataFrame, percent: int, size: int) -> DataFrame:
    """(key, node, c, n, shared) of the buckets with several components, without classes that cannot link there."""
    at = _rooted(members, roots)
    # Per-bucket results are written first: then a hot bucket's rows can be split in the join.
    mixed = written(at.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key"), "mixed-keys")
    several = written(members.join(mixed, "key"), "mixed")
    uniq = written(_unique_counts(several.filter(F.col("c") > LARGE), texts, size), "unique")
    info = nodes.join(uniq, "node", "left").select("node", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("shared"))
    at = several.join(info, "node")
    # Best case: all shared shingles are met by a partner that has nothing else.
    can = (F.col("c") <= LARGE) | (100 * F.col("shared") >= percent * F.col("n"))
    standing = written(at.filter(can).select("key", "node", "c", "n", "shared"), "standing")
    drop(mixed, several, uniq)
    return standing


def _rooted(rows: DataFrame, roots: DataFrame, node: str = "node", root: str = "root") -> DataFrame:
    """Add the root of ``node``; a class without links is its own."""
    known = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return rows.join(known, node, "left").withColumn(root, F.coalesce(root, node))


def _packed(rows: DataFrame, groups: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(main, nodes, roots, sizes, hashes): the classes of a group in blocks of about BLOCK, with their shingle hashes."""
    dealt = rows.join(groups, "main").join(texts, "node")
    dealt = dealt.select("main", F.pmod(F.xxhash64("node"), "blocks").alias("block"), "node", "root", "text")
    schema = "main binary, nodes array<binary>, roots array<binary>, sizes array<int>, hashes binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, key, held = _Hashes(), None, []

        def out() -> pa.RecordBatch:
            columns = [[key[0]], [[r[0] for r in held]], [[r[1] for r in held]], [[len(r[2]) for r in held]], [b"".join(r[2].tobytes() for r in held)]]
            kinds = (pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["main", "nodes", "roots", "sizes", "hashes"])

        for batch in slices(batches, 4):
            for main, block, node, root, text in zip(*(batch.column(i).to_pylist() for i in range(4)), text_bytes(batch.column(4)), strict=True):
                if held and ((main, block) != key or sum(len(r[2]) for r in held) > BLOCK_HASHES):
                    yield out()
                    held = []
                key = (main, block)
                held.append((node, root, shingle_hashes(text, hashes, size)))
        if held:
            yield out()

    return dealt.repartition("main", "block").sortWithinPartitions("main", "block").mapInArrow(pack, schema)


def _tile(percent: int):
    """Pairs of a tile's rows and columns that reach the threshold by their hashes, through an inverted list of the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y = (np.frombuffer(row[k], np.uint64) for k in ("hashes", "y_hashes"))
                nx, ny = np.array(row["sizes"]), np.array(row["y_sizes"])
                order = np.argsort(y, kind="stable")
                owner, known = np.repeat(np.arange(len(ny)), ny)[order], y[order]
                ends = np.cumsum(nx)
                lo, hi = np.searchsorted(known, x), np.searchsorted(known, x, side="right")
                a, b = [], []
                for i in range(len(nx)):
                    l, h = lo[ends[i] - nx[i] : ends[i]], hi[ends[i] - nx[i] : ends[i]]
                    runs = h - l
                    at = np.arange(int(runs.sum())) + np.repeat(l - (np.cumsum(runs) - runs), runs)
                    both = np.bincount(owner[at], minlength=len(ny))
                    for j in np.flatnonzero(100 * both >= percent * (nx[i] + ny - both)):
                        if row["roots"][i] != row["y_roots"][j]:
                            a.append(row["nodes"][i])
                            b.append(row["y_nodes"][j])
                yield pa.record_batch({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _rest(standing: DataFrame, texts: DataFrame, roots: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs (a, b) that are left: candidates of one bucket, in different components, that reach the threshold by their hashes.

    One side of such a pair is outside its bucket's main component, that of the least
    edited class.  The outsiders of a main component meet all classes of its buckets in
    tiles of blocks, so pairs below the threshold never become rows.
    """
    at = _rooted(standing, roots)
    main = at.groupBy("key").agg(F.max(F.struct(F.col("shared") / F.col("n"), "node", "root")).alias("top")).select("key", F.col("top.root").alias("main"))
    main = written(main, "main")
    at = written(at.join(main, "key").select("main", "node", "root").distinct(), "grouped")
    few = at.filter(F.col("root") != F.col("main"))
    groups = at.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("blocks"), F.max(F.col("root") != F.col("main")).alias("open"))
    groups = written(groups.filter("open").select("main", "blocks"), "groups")
    few = written(_packed(few, groups, texts, size), "outsiders")
    y = _packed(at, groups, texts, size)
    every = written(y.select("main", *[F.col(c).alias(f"y_{c}") for c in ("nodes", "roots", "sizes", "hashes")]), "members")
    # The blocks of a large group are dealt to several parts, each of which its outsiders meet once.
    parts = groups.select("main", F.ceil(F.col("blocks") / F.lit(TILES)).cast("long").alias("parts"))
    y = every.join(parts, "main").withColumn("part", F.pmod(F.xxhash64("y_nodes"), "parts")).drop("parts")
    x = few.join(parts, "main").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    dealt = x.join(y, ["main", "part"]).drop("part").repartition(F.xxhash64("nodes"), F.xxhash64("y_nodes"))
    pairs = written(dealt.mapInArrow(_tile(percent), "a binary, b binary").distinct(), "pairs")
    drop(main, at, groups, few, every)
    return pairs


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text); all links of at least ``percent``."""
    return rooted_duplicates(docs.select("doc_id", "text"), percent, size, bands, rows).drop("root")


def rooted_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of near_duplicates with the root of their component (null without shingles) and the further columns of ``docs``.

    Components may share component_id, the least id in them, where an id has several texts; roots differ.
    """
    ship(docs.sparkSession)
    carried = [c for c in docs.columns if c not in ("doc_id", "text")]
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carried)])
    sketches = written(sketch(hashed, bands, rows, size), "sketches")
    nodes, shared = _classes(sketches)
    wanted, texts = _texts(docs, sketches, nodes, shared, size)
    odd = written(_odd(wanted, texts, size), "odd")
    if odd.limit(1).count():
        same = (sketches["_hash"] == odd["_hash"]) & (sketches["set_key"] == odd["node"]) & sketches["doc_id"].eqNullSafe(odd["doc_id"])
        parted = sketches.join(odd, same, "left").select(*[sketches[c] for c in sketches.columns if c != "set_key"], F.coalesce("name", "set_key").alias("set_key"))
        parted = written(parted, "sketches")
        drop(sketches, nodes, shared, wanted, texts)
        sketches = parted
        nodes, shared = _classes(sketches)
        wanted, texts = _texts(docs, sketches, nodes, shared, size)
    drop(wanted, odd)
    central = shared.groupBy("node").agg(F.sum("c").alias("centre"))
    ranked = shared.join(central, "node")
    leaders = written(ranked.groupBy("key").agg(F.max(F.struct("centre", "node")).alias("top")).select("key", F.col("top.node").alias("leader")), "leaders")
    members = written(shared.join(leaders, "key"), "members")
    pairs = members.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    links = written(_confirmed(pairs, texts, percent, size), "links")
    roots = connected(links)
    standing = _standing(members, nodes, texts, roots, percent, size)
    rest = _rest(standing, texts, roots, percent, size)
    more = written(_confirmed(rest, texts, percent, size), "links")
    if more.limit(1).count():
        roots = connected(links.unionByName(more))
    ids = nodes.join(roots, "node", "left").select("node", "min_id", F.coalesce("root", "node").alias("root"))
    comp = written(ids.join(ids.groupBy("root").agg(F.min("min_id").alias("component_id")), "root").select(F.col("node").alias("set_key"), "component_id", "root"), "components")
    own = [F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)]
    # Empty sets are kept out of the join: they would be one hot key of nulls.
    full = sketches.filter("n > 0").join(comp, "set_key")
    full = full.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "root", *own)
    bare = sketches.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), F.lit(None).cast("binary").alias("root"), *own)
    drop(nodes, shared, leaders, members, texts, links, rest, more, standing)
    return full.unionByName(bare)


def _classes(sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes of equal set keys (node, min_id, min_hash, n, keys, c), and (key, node, c) of the buckets that several share."""
    # A class is represented by a row of its least id, named by id and text hash.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash")).alias("least")
    nodes = sketches.filter("n > 0").groupBy(F.col("set_key").alias("node")).agg(least, F.first("n").alias("n"), F.first("keys").alias("keys"), F.count(F.lit(1)).alias("c"))
    nodes = written(nodes.select("node", F.col("least.doc_id").alias("min_id"), F.col("least._hash").alias("min_hash"), "n", "keys", "c"), "classes")
    bands_of = nodes.select("node", F.explode("keys").alias("key"))
    buckets = written(bands_of.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "buckets")
    shared = written(bands_of.join(buckets, "key"), "shared")
    drop(buckets)
    return nodes, shared


def _texts(docs: DataFrame, sketches: DataFrame, nodes: DataFrame, shared: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows (node, c, first, doc_id, _hash, text) of classes with several rows or shared buckets, and one (node, text) for each of the classes."""
    met = shared.select("node").distinct().withColumn("met", F.lit(True))
    first = nodes.join(met, "node", "left").filter("met OR c > 1").select("node", "c", F.lit(True).alias("first"), F.col("min_id").alias("doc_id"), F.col("min_hash").alias("_hash"))
    several = nodes.filter("c > 1").select(F.col("node").alias("set_key"), "c", "min_id", "min_hash")
    copies = sketches.filter("n > 0").join(several, "set_key")
    copies = copies.filter(~(F.col("doc_id").eqNullSafe(F.col("min_id")) & (F.col("_hash") == F.col("min_hash"))))
    copies = copies.select(F.col("set_key").alias("node"), "c", F.lit(False).alias("first"), "doc_id", "_hash").distinct()
    rows = first.unionByName(copies)
    keyed = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), "text")
    found = keyed.join(rows, (keyed["hash"] == rows["_hash"]) & keyed["id"].eqNullSafe(rows["doc_id"]))
    wanted = written(found.select("node", "c", "first", "doc_id", "_hash", "text"), "wanted")
    return wanted, written(_own_text(wanted.filter("first").select("node", "text"), size), "texts")


def _odd(wanted: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(node, doc_id, _hash, name): rows of a class whose full set is not that of the class's text, named by their own set.

    The class's text meets every part of CLASS_ROWS rows of the class; in a part, rows of one
    set have one name.
    """
    parts = F.ceil(F.col("c") / F.lit(CLASS_ROWS)).cast("long")
    rows = wanted.filter("c > 1")
    base = rows.groupBy("node").agg(F.max("c").alias("c")).join(texts, "node")
    base = base.select("node", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.lit(0).alias("later"), F.lit(None).cast(wanted.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("long").alias("_hash"), "text")
    each = rows.select("node", F.pmod(F.monotonically_increasing_id(), parts).alias("part"), F.lit(1).alias("later"), "doc_id", "_hash", "text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, key, known = _Hashes(), None, []
        for batch in slices(batches, 5):
            at, names = [], []
            for i, (node, part, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(5)), strict=True)):
                if (node, part) != key:
                    key, known = (node, part), [text]
                    continue
                k = next((k for k, other in enumerate(known) if text == other or len(set(overlap(text, other, size))) == 1), len(known))
                if k == len(known):
                    if _digest(shingle_hashes(text, hashes, size)) != node[:16]:
                        continue  # a text of another class with this id and text hash
                    known.append(text)
                if k:
                    at.append(i)
                    names.append(b"%s-%d-%d" % (node, part, k))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at, pa.int64())) for c in (0, 3, 4)), pa.array(names, pa.binary())], ["node", "doc_id", "_hash", "name"])

    dealt = base.unionByName(each).repartition("node", "part").sortWithinPartitions("node", "part", "later")
    kind = wanted.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(check, f"node binary, doc_id {kind}, _hash long, name binary").distinct()


def _own_text(rows: DataFrame, size: int) -> DataFrame:
    """One row (node, text) of each class: rows whose text does not have the class's set are left out."""

    @F.arrow_udf("boolean")
    def own(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hashes = _Hashes()
        for keys, texts in columns:
            out = []
            for k, t in zip(keys.to_pylist(), text_bytes(texts), strict=True):
                h = shingle_hashes(t, hashes, size)
                out.append(len(h) > 0 and _digest(h) == k[:16])
            yield pa.array(out, pa.bool_())

    return rows.filter(own("node", "text")).dropDuplicates(["node"])


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates over all documents, on shingles of four words."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
v AS (SELECT doc_id, w, least(len(w), 4) AS k FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + k - 1), ' ') AS shingle FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM v)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c x ON a = x.doc_id JOIN c y ON b = y.doc_id WHERE 100 * p.n >= 80 * (x.n + y.n - p.n)),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN c USING (doc_id)
"""

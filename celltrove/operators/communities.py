"""Modularity clustering of weighted graphs: local moving, refinement within communities, coarsening.

All resolutions go through the same jobs, told apart by the column ``res``.  A level

* moves nodes to the neighbouring community of greatest gain, in rounds;
* starts each community anew from single nodes and joins those that gain by it (refinement);
* makes one node of each refined group, which begins in the community it came from.

Levels end when refinement joins nothing.  At last communities are cut into their connected
parts, which can only raise modularity.

Moves of a round are decided together, on the communities of the round before.  A node goes only
from a community to one of greater hash (new ones in each round), so no two nodes exchange
places.  The modularity of the outcome is computed exactly; if it fell, that resolution's round is
undone, and of the same wishes only those go ahead that are the best of the community they leave and
of the one they join.  Gains of such moves add up, so modularity never falls.  In refinement only
single nodes leave, and only for groups that stay; so a node joins by an edge, and groups are
connected.

The driver holds a few numbers for each resolution; graphs, moves and communities are tables.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..scratch import bucketed, drop, written
from .numbering import row_numbers

#: Rounds of a level end when modularity rises by less in two of them, and in any case after MOVES: the next level goes on.
TOLERANCE, MOVES, ROUNDS, LEVELS = 1e-3, 12, 60, 30
#: Edges of a block, about, each direction of each resolution counted.
EDGES = 1 << 17
_EPS = 1e-12


def undirected(edges: DataFrame, a: str, b: str, weight: str | None = None) -> DataFrame:
    """(u, v, w), each edge in both directions, weights of repeated and of opposite edges added; loops once.

    Edges with a null end, or a weight that isn't positive, take no part.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"), w.alias("w")).filter("u IS NOT NULL AND v IS NOT NULL AND w > 0 AND w < double('Infinity')")
    back = rows.filter("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"), "w")
    return rows.unionByName(back).groupBy("u", "v").agg(F.sum("w").alias("w"))


def modularity(edges: DataFrame, communities: DataFrame, node: str, community: str, resolution: float = 1.0) -> DataFrame:
    """(modularity) of a partition of ``undirected`` edges: share of inner weight less its expectation; null without weight."""
    comm = communities.select(F.col(node).cast("long").alias("u"), F.col(community).alias("c"))
    # A loop counts twice in its node's strength, as both of its ends are there.
    sided = edges.withColumn("w", F.when(F.col("u") == F.col("v"), F.col("w") * 2).otherwise(F.col("w")))
    both = sided.join(comm, "u").join(comm.withColumnsRenamed({"u": "v", "c": "d"}), "v")
    each = both.groupBy("c").agg(F.sum("w").alias("k"), F.sum(F.when(F.col("c") == F.col("d"), F.col("w")).otherwise(0.0)).alias("e"))
    two_m = F.sum("k")
    return each.agg((F.try_divide(F.sum("e"), two_m) - F.lit(float(resolution)) * F.try_divide(F.sum(F.col("k") * F.col("k")), two_m * two_m)).alias("modularity"))


class _Level:
    """A graph of one level: edges (res, u, v, w) in both directions without loops, nodes (res, u, k[, p]); k has the loops.

    Edges lie packed in blocks of nodes, in buckets, with the nodes as places among those that the block
    sees: its own and their neighbours.  A round sends each node's community once to each block that
    sees the node, and a block finds the wishes of its own nodes.
    """

    def __init__(self, edges: DataFrame, nodes: DataFrame, total: float, gammas: dict[int, float]) -> None:
        self.gammas, self.total = gammas, total
        blocks = max(1, -(-edges.count() // EDGES))
        home = lambda c: F.pmod(F.xxhash64("res", c), F.lit(blocks)).cast("int")
        sided = edges.select(home("u").alias("block"), "res", "u", "v", "w")
        seen = sided.select("res", F.col("v").alias("u"), "block").unionByName(nodes.select("res", "u", home("u").alias("block")))
        self.nodes = written(nodes.join(seen.groupBy("res", "u").agg(F.collect_set("block").alias("blocks")), ["res", "u"]), "nodes")

        def pack(_: tuple, ends: pa.Table, own: pa.Table) -> pa.Table:
            er, u, v = (ends[c].to_numpy() for c in ("res", "u", "v"))
            nr, n = own["res"].to_numpy(), own["u"].to_numpy()
            from_own, to_seen, order = np.empty(len(er), np.int32), np.empty(len(er), np.int32), np.lexsort((n, nr))
            places, start, first = [], 0, 0
            for r in np.unique(nr):
                of, mine = er == r, np.sort(n[nr == r])
                all_seen = np.unique(np.concatenate([mine, v[of]]))
                from_own[of], to_seen[of] = first + np.searchsorted(mine, u[of]), start + np.searchsorted(all_seen, v[of])
                places.append(start + np.searchsorted(all_seen, mine))
                start, first = start + len(all_seen), first + len(mine)
            raw = [np.concatenate(places).astype(np.int32), own["k"].to_numpy()[order], from_own, to_seen, ends["w"].to_numpy()]
            held = own["blocks"].take(pa.array(order)).combine_chunks()
            held = pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), held)
            return pa.table([own["at"].slice(0, 1).combine_chunks(), held, *[pa.array([x.tobytes()], pa.binary()) for x in raw]], ["block", "blocks", "own", "k", "from", "to", "w"])

        stored = self.nodes.select(home("u").alias("at"), "res", "u", "k", "blocks")
        done = sided.groupBy("block").cogroup(stored.groupBy("at")).applyInArrow(pack, "block int, blocks array<array<int>>, own binary, k binary, from binary, to binary, w binary")
        self.packed = bucketed(done, "packed", "block", blocks)

    def drop(self) -> None:
        drop(self.packed, self.nodes)

    def wishes(self, state: DataFrame, fence: bool) -> DataFrame:
        """(res, u, c, k, blocks[, p], inner, size, shared, to, to_shared, gain): what each node has in its community, and its best other one.

        ``state`` is (res, u, c, k, blocks), with the fence p if moves have to stay within it.  A community is shared if it has more nodes.
        """
        more = ["p"] if fence else []
        sizes = state.groupBy("res", "c").agg(F.sum("k").alias("size"))
        sized = state.join(sizes, ["res", "c"]).withColumn("shared", F.col("size") > F.col("k"))
        sent = sized.select(F.explode("blocks").alias("at"), "res", "u", "c", "size", "shared", *more)
        rates = np.array([self.gammas.get(r, 0.0) / self.total for r in range(max(self.gammas) + 1)])

        def wish(block: pa.Table, rows: pa.Table) -> pa.Table:
            order = np.lexsort((rows["u"].to_numpy(), rows["res"].to_numpy()))
            get = lambda c: rows[c].to_numpy()[order]
            read = lambda c, kind: np.frombuffer(block[c][0].as_buffer(), kind)
            res, u, c, size, shared = map(get, ("res", "u", "c", "size", "shared"))
            own, k, a, b, w = read("own", np.int32), read("k", np.float64), read("from", np.int32).astype(np.int64), read("to", np.int32), read("w", np.float64)
            if fence:
                fences = get("p")
                within = np.flatnonzero(fences[b] == fences[own[a]])
                a, b, w = a[within], b[within], w[within]
            # The weight between each node and each community that it meets.
            names, d = np.unique(c[b], return_inverse=True)
            pairs, first, at = np.unique(a * max(1, len(names)) + d, return_index=True, return_inverse=True)
            e = np.bincount(at, w, len(pairs)).astype(np.float64, copy=False)
            node, to, there = a[first], c[b[first]], b[first]
            inside = to == c[own[node]]
            inner = np.bincount(node[inside], e[inside], len(own)).astype(np.float64, copy=False)
            rate = rates[res[own]]
            away = (e - rate[node] * k[node] * size[there])[~inside]
            node, to, there = node[~inside], to[~inside], there[~inside]
            best = np.lexsort((to, -away, node))
            best = best[np.unique(node[best], return_index=True)[1]]
            gain, target, joined = np.zeros(len(own)), np.zeros(len(own), np.int64), np.zeros(len(own), bool)
            none = np.ones(len(own), bool)
            gain[node[best]], target[node[best]], joined[node[best]], none[node[best]] = away[best], to[best], shared[there[best]], False
            gain -= inner - rate * k * (size[own] - k)
            columns = [res[own], u[own], c[own], k, block["blocks"].combine_chunks().values, *([fences[own]] if fence else []), inner, size[own], shared[own]]
            return pa.table([*map(pa.array, columns), pa.array(target, mask=none), pa.array(joined), pa.array(gain, mask=none)], ["res", "u", "c", "k", "blocks", *more, "inner", "size", "shared", "to", "to_shared", "gain"])

        schema = f"res int, u long, c long, k double, blocks array<int>, {'p long, ' if fence else ''}inner double, size double, shared boolean, to long, to_shared boolean, gain double"
        return self.packed.groupBy("block").cogroup(sent.groupBy("at")).applyInArrow(wish, schema)

    def scored(self, wishes: DataFrame, loops: dict[int, float]) -> tuple[DataFrame, dict[int, tuple[float, int]]]:
        """Written wishes, with the modularity and number of wishes of each resolution, found in the same pass."""
        of = {r: F.col("res") == r for r in self.gammas}
        # The sum of k times the size over nodes is that of squared sizes over communities.
        parts = {"e": lambda r: F.sum(F.when(of[r], F.col("inner"))), "kk": lambda r: F.sum(F.when(of[r], F.col("k") * F.col("size"))), "n": lambda r: F.count_if(of[r] & (F.col("gain") > _EPS))}
        seen = Observation()
        done = written(wishes.observe(seen, *[f(r).alias(f"{name}{r}") for r in of for name, f in parts.items()]), "wishes")
        found, m = seen.get, self.total
        return done, {r: (((found[f"e{r}"] or 0.0) + loops[r]) / m - self.gammas[r] * (found[f"kk{r}"] or 0.0) / m / m, found[f"n{r}"]) for r in of}


def _hash(column: str, turn: int) -> Column:
    return F.xxhash64("res", column, F.lit(turn))


def _moved(wishes: DataFrame, turn: int, careful: list[int], more: list[str]) -> DataFrame:
    """The next state: wishes towards greater hashes come true; of careful resolutions only the best of both communities."""
    wants = F.coalesce(F.col("gain") > _EPS, F.lit(False))
    bold = wants & ~F.col("res").isin(careful) & (_hash("c", turn) < _hash("to", turn)) if careful else wants & (_hash("c", turn) < _hash("to", turn))
    keep = ["res", "u", "k", *more]
    if not careful:
        return wishes.select(*keep, F.when(bold, F.col("to")).otherwise(F.col("c")).alias("c"))
    # Each community takes part in one move, the best of all that leave or join it.
    asked = wishes.filter(wants & F.col("res").isin(careful)).select("res", F.explode(F.array("c", "to")).alias("side"), F.struct("gain", "u").alias("s"))
    first = asked.groupBy("res", "side").agg(F.max("s").alias("s")).select("res", F.col("s.u").alias("u")).groupBy("res", "u").agg((F.count(F.lit(1)) == 2).alias("_first"))
    both = wishes.join(first, ["res", "u"], "left")
    going = bold | (wants & F.col("res").isin(careful) & F.coalesce("_first", F.lit(False)))
    return both.select(*keep, F.when(going, F.col("to")).otherwise(F.col("c")).alias("c"))


def _moves(level: _Level, state: DataFrame, loops: dict[int, float], tolerance: float, log: list | None) -> DataFrame:
    """(res, u, c, k) after rounds of moving; modularity never falls."""
    last, score = level.scored(level.wishes(state, False), loops)
    done, slow, careful = set(), dict.fromkeys(score, 0), []
    for turn in range(MOVES):
        done |= {r for r, (_, n) in score.items() if not n} | {r for r, n in slow.items() if n >= 2}
        if done >= set(score):
            break
        still = last.filter(F.col("res").isin(sorted(done))).select("res", "u", "k", "blocks", "c") if done else None
        going = _moved(last.filter(~F.col("res").isin(sorted(done))) if done else last, turn, careful, ["blocks"])
        new, found = level.scored(level.wishes(going.unionByName(still) if done else going, False), loops)
        fell = [r for r in found if r not in done and found[r][0] < score[r][0] - _EPS]
        for r in found:
            if r not in done and r not in fell:
                slow[r] = slow[r] + 1 if found[r][0] - score[r][0] < tolerance and r not in careful else 0
                score[r] = found[r]
                if log is not None:
                    log.append((r, found[r][0]))
        careful = fell
        if fell:
            back = written(new.filter(~F.col("res").isin(fell)).unionByName(last.filter(F.col("res").isin(fell))), "wishes")
            drop(new, last)
            last = back
        else:
            drop(last)
            last = new
    return last


def _refined(level: _Level, state: DataFrame) -> DataFrame:
    """(res, u, c, k, p), written: connected groups c within the communities p of ``state``."""
    now, last = state.select("res", "u", "k", "blocks", F.col("c").alias("p"), F.col("u").alias("c")), None
    able = F.coalesce(F.col("gain") > _EPS, F.lit(False)) & ~F.col("shared")
    half = lambda c, turn: F.pmod(_hash(c, turn), F.lit(2))
    for turn in range(ROUNDS):
        seen = Observation()
        wishes = written(level.wishes(now, True).observe(seen, F.count_if(able).alias("n"), F.count_if(able & F.col("to_shared")).alias("sure")), "refining")
        drop(*[last] if last is not None else [])
        last = now = wishes
        n, sure = seen.get["n"], seen.get["sure"]
        if not n:
            break
        # Only single nodes leave, each for a group that stays: groups of several do in any case, so all go to them where most want to.
        # Else one half goes, to groups of several and to single nodes of the other half.
        leaves = able & F.col("to_shared") if 2 * sure >= n else able & (half("c", turn) == 0) & (F.col("to_shared") | (half("to", turn) == 1))
        now = wishes.select("res", "u", "k", "blocks", "p", F.when(leaves, F.col("to")).otherwise(F.col("c")).alias("c"))
    groups = written(now.select("res", "u", "c", "k", "p"), "groups")
    drop(last)
    return groups


def connected_parts(edges: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """(*key, u, part): the least node reachable from each node of edges (*key, u, v); a loop stands for its node alone.

    Large and small stars by turns: neighbours are linked to the least node that a node sees,
    first those above it, then those below, until all parts are stars.  Every round is a written table.
    """
    key = list(key)
    nodes = edges.select(*key, "u").unionByName(edges.select(*key, F.col("v").alias("u"))).distinct()
    links = written(edges.filter("u <> v").select(*key, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    sign = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*key, "u", "v").cast("decimal(38,0)"))).first()
    while True:
        both = links.unionByName(links.select(*key, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*key, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, [*key, "u"]).filter("v > u").select(*key, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy(*key, "u").agg(F.min("v").alias("m"))
        small = large.join(low, [*key, "u"]).filter("v <> m").select(*key, F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(small.unionByName(low.select(*key, "u", F.col("m").alias("v"))).distinct(), "links")
        drop(links)
        links, before = new, sign
        sign = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*key, "u", "v").cast("decimal(38,0)"))).first()
        if sign == before:
            break
    root = links.groupBy(*key, "u").agg(F.min("v").alias("part"))
    done = written(nodes.join(root, [*key, "u"], "left").select(*key, "u", F.coalesce("part", "u").alias("part")), "parts")
    drop(links)
    return done


def modularity_clusters(edges: DataFrame, a: str, b: str, weight: str | None = None, resolutions: Sequence[float] = (1.0,), tolerance: float = TOLERANCE, log: list | None = None) -> DataFrame:
    """(res, node, community) for each resolution's number (from 0): a community's name is its least node.

    Node ids are integers.  ``log`` gets (res, modularity) of every round that was kept.
    A graph without edges has no communities.
    """
    gammas = dict(enumerate(map(float, resolutions)))
    one = written(undirected(edges, a, b, weight), "graph")
    total = one.agg(F.sum(F.when(F.col("u") == F.col("v"), F.col("w") * 2).otherwise(F.col("w")))).first()[0]
    if total is None:
        return one.select(F.lit(0).alias("res"), F.col("u").alias("node"), F.col("u").alias("community"))
    numbers = F.explode(F.array(*[F.lit(r) for r in gammas])).alias("res")
    graph = one.select(numbers, "u", "v", "w")
    members, inner, written_before = None, None, []
    for _ in range(LEVELS):
        loops = dict.fromkeys(gammas, 0.0) | {r.res: r.w for r in graph.filter("u = v").groupBy("res").agg(F.sum(F.col("w") * 2).alias("w")).collect()}
        nodes = graph.groupBy("res", "u").agg(F.sum(F.when(F.col("u") == F.col("v"), F.col("w") * 2).otherwise(F.col("w"))).alias("k"))
        nodes = nodes if inner is None else nodes.join(inner, ["res", "u"])
        level = _Level(graph.filter("u <> v"), nodes, float(total), gammas)
        state = level.nodes.select("res", "u", F.col("u").alias("c") if inner is None else F.col("p").alias("c"), "k", "blocks")
        moved = _moves(level, state, loops, tolerance, log)
        groups = _refined(level, moved.select("res", "u", "c", "k", "blocks"))
        drop(moved)
        level.drop()
        named = groups.select("res", "u", F.col("c").alias("group"), "p")
        if members is None:
            now = named.withColumnRenamed("u", "node")
        else:
            now = members.select("res", "node", F.col("group").alias("u")).join(named, ["res", "u"]).drop("u")
        now = written(now, "members")
        drop(*[members] if members is not None else [])
        members = now
        before, after = groups.count(), groups.select("res", "c").distinct().count()
        if after == before:
            break
        at = groups.select("res", "u", "c")
        coarse = graph.join(at, ["res", "u"]).join(at.select("res", F.col("u").alias("v"), F.col("c").alias("d")), ["res", "v"])
        # Inner edges come in both directions and become one loop, loops stay as they are.
        w = F.when((F.col("c") == F.col("d")) & (F.col("u") != F.col("v")), F.col("w") / 2).otherwise(F.col("w"))
        new = written(coarse.groupBy("res", F.col("c").alias("u"), F.col("d").alias("v")).agg(F.sum(w).alias("w")), "graph")
        inner = written(named.groupBy("res", F.col("group").alias("u")).agg(F.min("p").alias("p")), "fences")
        drop(*written_before)
        written_before = [new, inner, groups]
        graph = new
    comm = members.select("res", "node", F.col("p").alias("community"))
    within = one.select(numbers, "u", "v").join(comm.withColumnsRenamed({"node": "u", "community": "c"}), ["res", "u"]).join(comm.withColumnsRenamed({"node": "v", "community": "d"}), ["res", "v"])
    # A loop for each node keeps those without inner edges.
    held = within.filter("c = d").select("res", "u", "v").unionByName(members.select("res", F.col("node").alias("u"), F.col("node").alias("v")))
    parts = connected_parts(held, ["res"])
    drop(one, members, *written_before)
    return parts.select("res", F.col("u").alias("node"), F.col("part").alias("community"))


def cluster_columns(clusters: DataFrame, names: Sequence[str]) -> DataFrame:
    """(node, a column for each resolution): clusters numbered from 0 by falling size, ties by their least node."""
    sizes = clusters.groupBy("res", "community").agg((-F.count(F.lit(1))).alias("_n"))
    ranks = row_numbers(sizes, ["res"], ["_n", "community"], "cluster").withColumn("cluster", F.col("cluster").cast("int"))
    named = clusters.join(ranks.select("res", "community", "cluster"), ["res", "community"])
    return named.groupBy("node").agg(*[F.max(F.when(F.col("res") == r, F.col("cluster"))).alias(n) for r, n in enumerate(names)])


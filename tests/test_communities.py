"""Modularity clustering against its definition and a single-machine greedy reference."""

import random
from collections import defaultdict

import pytest

from celltrove.operators import communities as C


def planted(rng, groups, size, inner, outer):
    n = groups * size
    return [(a, b, 1.0) for a in range(n) for b in range(a) if rng.random() < (inner if a // size == b // size else outer)]


def score(edges, comm, gamma=1.0):
    k, inner, total = defaultdict(float), 0.0, 0.0
    for a, b, w in edges:
        k[comm[a]] += w
        k[comm[b]] += w
        total += 2 * w
        inner += 2 * w * (comm[a] == comm[b])
    return inner / total - gamma * sum(x * x for x in k.values()) / total**2


def reference(edges, gamma=1.0):
    """Moving of single nodes and merging, one after the other, on one machine."""
    near, nodes = defaultdict(lambda: defaultdict(float)), {}
    for a, b, w in edges:
        near[a][b] += w
        near[b][a] += w
    nodes, two_m = {u: u for u in near}, sum(map(lambda e: 2 * e[2], edges))
    graph, owner = {u: dict(v) for u, v in near.items()}, dict(nodes)
    while True:
        comm = {u: u for u in graph}
        k = {u: sum(v.values()) + v.get(u, 0.0) for u, v in graph.items()}
        size, moved = dict(k), True
        while moved:
            moved = False
            for u in graph:
                links = defaultdict(float)
                for v, w in graph[u].items():
                    if v != u:
                        links[comm[v]] += w
                size[comm[u]] -= k[u]
                best = max([comm[u], *links], key=lambda c: links[c] - gamma * k[u] * size[c] / two_m)
                if links[best] - gamma * k[u] * size[best] / two_m > links[comm[u]] - gamma * k[u] * size[comm[u]] / two_m + 1e-12:
                    comm[u], moved = best, True
                size[comm[u]] += k[u]
        if len(set(comm.values())) == len(graph):
            return owner
        owner = {n: comm[c] for n, c in owner.items()}
        new = defaultdict(lambda: defaultdict(float))
        for u, vs in graph.items():
            for v, w in vs.items():
                new[comm[u]][comm[v]] += w / 2 if comm[u] == comm[v] and u != v else w
        graph = {u: dict(v) for u, v in new.items()}


def is_connected(edges, comm):
    near = defaultdict(set)
    for a, b, _ in edges:
        if comm[a] == comm[b]:
            near[a].add(b)
            near[b].add(a)
    for c in set(comm.values()):
        members = {u for u in comm if comm[u] == c}
        seen, todo = set(), [next(iter(members))]
        while todo:
            u = todo.pop()
            if u not in seen:
                seen.add(u)
                todo += near[u]
        if seen != members:
            return False
    return True


def clusters(spark, edges, gammas, log=None):
    found = C.modularity_clusters(spark.createDataFrame(edges, "a long, b long, w double"), "a", "b", "w", gammas, log=log).collect()
    return [{r.node: r.community for r in found if r.res == i} for i in range(len(gammas))]


def test_quality_connection_and_rising_modularity(spark):
    rng, log = random.Random(1), []
    edges = planted(rng, 6, 20, 0.35, 0.03) + [(500, 501, 2.0), (501, 502, 1.0)]
    gammas = [0.4, 1.0, 1.8]  # all of them in the same jobs
    found = clusters(spark, edges, gammas, log)
    for r, gamma in enumerate(gammas):
        assert set(found[r]) == {x for e in edges for x in e[:2]}
        assert is_connected(edges, found[r])
        assert all(found[r][c] == c and c == min(u for u in found[r] if found[r][u] == c) for c in set(found[r].values()))
        assert score(edges, found[r], gamma) >= score(edges, reference(edges, gamma), gamma) - 0.02
        told = [q for i, q in log if i == r]
        assert told and all(b >= a - 1e-9 for a, b in zip(told, told[1:]))
        assert score(edges, found[r], gamma) >= told[-1] - 1e-9


def test_clear_groups_are_found(spark):
    rng = random.Random(3)
    edges = planted(rng, 5, 12, 0.9, 0.01)
    (comm,) = clusters(spark, edges, [1.0])
    assert sorted(map(sorted, defaultdict(list, {c: [u for u in comm if comm[u] == c] for c in comm.values()}).values())) == [list(range(i * 12, i * 12 + 12)) for i in range(5)]


def test_awkward_graphs(spark):
    assert clusters(spark, [], [1.0]) == [{}]
    assert clusters(spark, [(1, None, 1.0), (None, 2, 1.0), (3, 4, None), (3, 4, -1.0), (3, 4, 0.0), (5, 6, float("nan"))], [1.0]) in ([{}],)
    assert clusters(spark, [(7, 7, 1.0)], [1.0]) == [{7: 7}]
    star = [(0, i, 1.0) for i in range(1, 40)] * 2 + [(i, 0, 1.0) for i in range(1, 5)]
    (comm,) = clusters(spark, star, [0.5])
    assert set(comm) == set(range(40)) and is_connected(star, comm)


def test_modularity_by_definition(spark):
    rng = random.Random(4)
    edges = [(a, b, rng.randrange(1, 4) / 2) for a, b, _ in planted(rng, 3, 8, 0.6, 0.2)] + [(2, 2, 1.5)]
    comm = {u: u % 3 for u in range(24)}
    df = spark.createDataFrame(sorted(comm.items()), "n long, c int")
    graph = C.undirected(spark.createDataFrame(edges, "a long, b long, w double"), "a", "b", "w")
    for gamma in (0.5, 1.0):
        assert C.modularity(graph, df, "n", "c", gamma).first()[0] == pytest.approx(score(edges, comm, gamma))
    assert C.modularity(graph.limit(0), df, "n", "c").first()[0] is None


def test_connected_parts(spark):
    path = [(i, i + 1) for i in range(70)] + [(200 - i, 199 - i) for i in range(30)] + [(500, 500), (900, 901), (902, 901), (903, 900)]
    got = {r.u: r.part for r in C.connected_parts(spark.createDataFrame(path, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(71)} | {i: 170 for i in range(170, 201)} | {500: 500} | {i: 900 for i in range(900, 904)}


def test_columns_by_size(spark):
    rows = [(0, n, 5) for n in (5, 6)] + [(0, n, 1) for n in (1, 2, 3)] + [(0, 9, 9)] + [(1, n, n) for n in (1, 2, 3, 5, 6, 9)]
    got = C.cluster_columns(spark.createDataFrame(rows, "res int, node long, community long"), ["a", "b"]).orderBy("node").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0), (2, 0, 1), (3, 0, 2), (5, 1, 3), (6, 1, 4), (9, 2, 5)]


def test_a_round_is_few_shuffles_and_one_pass(spark, monkeypatch):
    seen, real = [], C.written

    def watched(df, label):
        if label in ("wishes", "refining"):
            seen.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        return real(df, label)

    monkeypatch.setattr(C, "written", watched)
    monkeypatch.setattr(C, "EDGES", 40, raising=False)  # several blocks
    rng = random.Random(8)
    edges = [(a, b, rng.random() + 0.1) for a in range(60) for b in range(a) if (a // 15 == b // 15 and rng.random() < 0.5) or rng.random() < 0.03]
    found = C.modularity_clusters(spark.createDataFrame([*edges, (99, 99, 1.0)], "a long, b long, w double"), "a", "b", "w", (1.0,)).collect()
    # By community, by community again for the sizes, and by block; no other job counts or looks up anything in a round.
    assert seen and max(seen) <= 4
    of = {r.node: r.community for r in found}
    assert sorted(of) == [*range(60), 99] and of[99] == 99
    assert [len({of[i] for i in range(s, s + 15)}) for s in range(0, 60, 15)] == [1] * 4 and len(set(of.values())) == 5

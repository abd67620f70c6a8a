"""Shortest paths by length against Dijkstra's algorithm, in plain Python."""

import heapq
import math
from collections import defaultdict

import numpy as np
import pytest

from roadlens.operators import graphs


def neighbours(edges):
    near = defaultdict(dict)
    for a, b, w in edges:
        if a != b:
            near[a][b] = min(w, near[a].get(b, math.inf))
            near[b][a] = near[a][b]
    return near


def dijkstra(near, seed):
    """distance, number of shortest paths and predecessors of every node reached, in order of distance."""
    d, paths, before, todo, done = {seed: 0.0}, defaultdict(float, {seed: 1.0}), defaultdict(list), [(0.0, seed)], []
    settled = set()
    while todo:
        far, u = heapq.heappop(todo)
        if u in settled:
            continue
        settled.add(u)
        done.append(u)
        for v, w in near[u].items():
            if far + w < d.get(v, math.inf):
                d[v], paths[v], before[v] = far + w, paths[u], [u]
                heapq.heappush(todo, (d[v], v))
            elif far + w == d[v] and v not in settled:
                paths[v] += paths[u]
                before[v].append(u)
    return d, paths, before, done


def brandes(edges):
    near, out = neighbours(edges), defaultdict(float)
    for s in {x for a, b, _ in edges for x in (a, b)}:
        _, paths, before, order = dijkstra(near, s)
        due = defaultdict(float)
        for v in reversed(order):
            for u in before[v]:
                due[u] += paths[u] / paths[v] * (1 + due[v])
            out[v] += due[v] / 2 if v != s else 0
    return out


def graph(seed, nodes, edges, whole):
    rng = np.random.default_rng(seed)
    rows = [(int(a), int(b), float(w)) for a, b, w in zip(rng.integers(0, nodes, edges), rng.integers(0, nodes, edges), rng.integers(1, 6, edges) if whole else rng.exponential(3, edges) + 1e-3)]
    return rows + [(rows[0][0], rows[0][1], rows[0][2] + 5), (nodes + 1, nodes + 2, 1.0), (nodes + 3, nodes + 3, 2.0)]


@pytest.mark.parametrize("seed, step", [(1, None), (2, 0.7), (3, 50.0)])
def test_lengths_are_those_of_dijkstra(spark, seed, step):
    rows = graph(seed, 40, 70, seed == 1)
    df, seeds = spark.createDataFrame(rows, "src long, dst long, weight double"), [0, 5, 41, 99]
    got = {(r["seed"], r["node"]): r["d"] for r in graphs.lengths(df, spark.createDataFrame([(s,) for s in seeds], "node long"), step=step).collect()}
    want = {(s, v): d for s in seeds for v, d in dijkstra(neighbours(rows), s)[0].items()}
    assert got == pytest.approx(want) and len(got) == len(want)


def test_a_long_road(spark):
    """More ranges than a plan could hold, and a shortcut of many short edges around a long one."""
    rows = [(k, k + 1, 1.0) for k in range(12)] + [(0, 12, 11.5), (3, 20, 30.0), (12, 20, 1.0)]
    got = {r["node"]: r["d"] for r in graphs.lengths(spark.createDataFrame(rows, "src long, dst long, weight double"), spark.createDataFrame([(0,)], "node long"), step=2.0).collect()}
    assert got == {**{k: float(k) for k in range(12)}, 12: 11.5, 20: 12.5}


def test_betweenness_and_closeness_by_length(spark):
    rows = graph(4, 16, 26, True)
    df = spark.createDataFrame(rows, "src long, dst long, weight double")
    nodes = df.select("src").union(df.select("dst")).distinct().withColumnRenamed("src", "node")
    want = brandes(rows)
    got = {r["node"]: r["betweenness"] for r in graphs.betweenness(df, nodes, "weight").collect()}
    assert got == pytest.approx({r["node"]: want[r["node"]] for r in nodes.collect()}, abs=1e-9)
    close = {r["node"]: (r["reached"], r["distance"]) for r in graphs.closeness(df, nodes, "weight").collect()}
    near = neighbours(rows)
    assert close == {s: (len(d) - 1, pytest.approx(sum(d.values()))) for s in close for d in [dijkstra(near, s)[0]]}


def test_betweenness_in_edges(spark):
    rows = [(a, b, 1.0) for a, b, _ in graph(6, 14, 20, True)]
    df = spark.createDataFrame([r[:2] for r in rows], "src long, dst long")
    nodes = df.select("src").union(df.select("dst")).distinct().withColumnRenamed("src", "node")
    want = brandes(rows)
    assert {r["node"]: r["betweenness"] for r in graphs.betweenness(df, nodes).collect()} == pytest.approx({r["node"]: want[r["node"]] for r in nodes.collect()}, abs=1e-9)


def test_detours_by_length(spark):
    rows = [(1, 2, 1.0), (2, 3, 1.0), (1, 4, 5.0), (4, 3, 5.0)]
    df, seeds = spark.createDataFrame(rows, "src long, dst long, weight double"), spark.createDataFrame([(1,)], "node long")
    failed = spark.createDataFrame([(3, 2)], "src long, dst long")
    out = graphs.resilience(df, failed, seeds, "weight").first()
    assert out["connectivity"] == 1.0 and out["detour"] == pytest.approx((1 + 10 + 5) / (1 + 2 + 5))


def test_odd_graphs(spark):
    schema, seeds = "src long, dst long, weight double", spark.createDataFrame([(1,)], "node long")
    assert [tuple(r) for r in graphs.lengths(spark.createDataFrame([], schema), seeds).collect()] == [(1, 1, 0.0)]
    assert graphs.lengths(spark.createDataFrame([(1, 2, 1.0)], schema), seeds.limit(0)).count() == 0
    for bad in (0.0, -1.0, float("nan"), float("inf"), None):
        with pytest.raises(Exception, match="positive number"):
            graphs.lengths(spark.createDataFrame([(1, 2, bad)], schema), seeds).count()


@pytest.mark.parametrize("few", [0, 500_000])
def test_small_fronts_go_to_the_edges(spark, monkeypatch, few):
    """Beyond FEW rows a front meets the edges by shuffle, with the same lengths; below it the edges stay where they lie."""
    monkeypatch.setattr(graphs, "FEW", few)
    edges = spark.createDataFrame([(1, 2, 3.0), (2, 1, 2.0), (2, 3, 1.5), (3, 1, 9.0), (4, 4, 1.0)], "src long, dst long, weight double")
    both, front = graphs.both_ways(edges, "weight"), graphs.cut(spark.createDataFrame([(1, 1, 0.0)], "seed long, node long, d double"))
    plan = graphs._onward(front, both)._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (few > 0)
    assert {tuple(r) for r in graphs.lengths(edges, front.select("node")).collect()} == {(1, 1, 0.0), (1, 2, 2.0), (1, 3, 3.5)}

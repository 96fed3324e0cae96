"""Communities by parallel moves and betweenness by joins, against one-task and plain versions."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.operators import graph, moves

KIND = "src string, dst string, weight double"


def plain_betweenness(edges):
    """Sums over all pairs of the share of shortest paths through a node, by distances between all pairs."""
    nodes = sorted({x for a, b, _ in edges for x in (a, b)})
    near = {(a, b): (0.0 if a == b else float("inf")) for a in nodes for b in nodes}
    way = defaultdict(dict)
    for a, b, w in edges:
        way[a][b] = way[b][a] = w
        near[a, b] = near[b, a] = w
    for m in nodes:
        for a in nodes:
            for b in nodes:
                near[a, b] = min(near[a, b], near[a, m] + near[m, b])
    paths = {}
    for s in nodes:
        paths[s, s] = 1
        for v in sorted((v for v in nodes if v != s), key=lambda v: near[s, v]):
            paths[s, v] = sum(paths.get((s, u), 0) for u, w in way[v].items() if near[s, u] + w == near[s, v] < float("inf"))
    n, out = len(nodes), {}
    for v in nodes:
        hit = sum(paths[s, v] * paths[v, t] / paths[s, t] for s in nodes for t in nodes if len({s, t, v}) == 3 and near[s, t] < float("inf") and near[s, v] + near[v, t] == near[s, t])
        out[v] = hit / max(1, (n - 1) * (n - 2))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_betweenness(spark, seed):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(18 if seed == 1 else 30), 2))) for _ in range(34)}  # the second falls into parts
    rows = [(f"n{a:02d}", f"n{b:02d}", float(rng.randint(1, 4))) for a, b in sorted(pairs)]  # whole numbers: many ties
    df = spark.createDataFrame(rows, KIND)
    want = plain_betweenness(rows)
    for got in (graph.betweenness(df), graph.betweenness(df, pairs=150, landmarks=3)):  # in one batch and in several
        assert {r.node: pytest.approx(r.betweenness) for r in got.collect()} == want


def test_betweenness_of_none(spark):
    assert graph.betweenness(spark.createDataFrame([], KIND)).collect() == []


def test_moved_communities(spark):
    rng = random.Random(4)
    rows = [(f"n{a:03d}", f"n{b:03d}", rng.choice([1.0, 2.0])) for a in range(120) for b in range(a + 1, 120) if rng.random() < (0.4 if a % 6 == b % 6 else 0.02)]
    df = graph.saved(spark.createDataFrame([*rows, ("n000", "n000", 3.0)], KIND), "test")
    got = graph.saved(graph.moved_communities(df), "test")
    by = {r.node: r.community for r in got.collect()}
    assert len(by) == got.count() == 120 and all(c == min(n for n in by if by[n] == c) for c in set(by.values()))
    one = spark.createDataFrame(list(graph._louvain(df.collect(), 1.0).items()), "node string, community string")
    assert graph.modularity(df, got).first().q >= 0.99 * graph.modularity(df, one).first().q
    assert by == {f"n{i:03d}": f"n{i % 6:03d}" for i in range(120)}


def test_moved_communities_odd(spark):
    assert graph.moved_communities(spark.createDataFrame([], KIND)).collect() == []
    rows = [("a", "b", 1.0), ("b", "a", 1.0), ("z", "z", 2.0), ("c", "d", 5.0), ("c", "d", 5.0)]  # repeated, both ways, a loop
    for parts in (1, 5):  # the order of rows changes nothing
        assert {r.node: r.community for r in graph.moved_communities(spark.createDataFrame(rows, KIND).repartition(parts)).collect()} == {"a": "a", "b": "a", "c": "c", "d": "c", "z": "z"}
    star = spark.range(1, 300).select(F.lit("hub").alias("src"), F.format_string("n%03d", "id").alias("dst"), F.lit(1.0).alias("weight"))
    assert {r.community for r in graph.moved_communities(star).collect()} == {"hub"}


def test_moved_communities_agree(spark):
    """In the driver, in blocks and by joins: the same communities, of a graph with groups, loops, hubs and parts of its own."""
    rng = random.Random(9)
    rows = [(f"n{a}", f"n{b}", rng.uniform(0.1, 3)) for a in range(90) for b in range(a, 90) if rng.random() < (0.5 if a % 5 == b % 5 else 0.06)]
    rows += [("hub", f"n{i}", 0.5) for i in range(90)] + [("z", "z", 2.0), ("y1", "y2", 1.0), ("y2", "y1", 1.0)]
    df = graph.saved(spark.createDataFrame(rows, KIND).repartition(5), "test")
    found = [{r.node: r.community for r in graph.moved_communities(df, rounds=5, **how).collect()} for how in ({}, {"few": 0}, {"held": 0})]
    assert found[0] == found[1] == found[2] and len(found[0]) == 94


def test_blocks_cut_anywhere():
    rng = np.random.default_rng(2)
    node = np.sort(rng.integers(0, 40, 600)).astype(np.int32)
    node[100:400] = node[100]  # one node in many blocks
    other, w = rng.integers(0, 40, 600).astype(np.int32), rng.integers(1, 9, 600)
    label, size = rng.integers(0, 7, 40).astype(np.int32), np.bincount(node, w, 40).astype(np.int64)
    mass = np.bincount(label, size, 40).astype(np.int64)

    def all_of(step):
        cut = [(node[i : i + step], other[i : i + step], w[i : i + step]) for i in range(0, 600, step)]
        return {int(n): (int(t), int(own)) for part in moves.choices(cut, label, mass, size, 1.0, float(size.sum())) for n, t, own in zip(*part, strict=True)}

    want = {}
    for n in set(node.tolist()):
        to = defaultdict(int, {int(label[n]): 0})
        for o, x in zip(other[node == n], w[node == n], strict=True):
            if o != n:
                to[int(label[o])] += int(x)
        total = float(size.sum())
        gain = lambda c: round((to[c] - (mass[c] - (size[n] if c == label[n] else 0.0)) * size[n] / total) / total, 13)  # noqa: B023, E731
        want[n] = (max(to, key=lambda c: (gain(c), c == label[n], c)), to[int(label[n])])  # noqa: B023
    assert all_of(1) == all_of(7) == all_of(1000) == want


def test_modularity_of_several(spark):
    rows = [("a", "b", 2.0), ("b", "c", 1.0), ("c", "d", 3.0), ("a", "z", 1.0), ("d", "d", 1.0)]  # z has no community
    df = spark.createDataFrame(rows, KIND)
    c = spark.createDataFrame([("a", "1", "1"), ("b", "1", "2"), ("c", "2", "2"), ("d", "2", "1"), ("far", "3", "3")], "node string, x string, y string")
    both = graph.modularity(df, c, of=("x", "y")).first()
    for i, name in enumerate("xy"):
        assert both[i] == pytest.approx(graph.modularity(df, c.select("node", F.col(name).alias("community"))).first().q)
    d = {"1": 5.0 + 1, "2": 1.0 + 3 + 3 + 2 - 0}  # weights at the ends that have a community
    m = sum(d.values()) / 2
    assert both.q0 == pytest.approx((2 + 3 + 1) / m - sum(x * x for x in d.values()) / (4 * m * m))
    assert graph.modularity(spark.createDataFrame([], KIND), c.withColumnRenamed("x", "community")).first().q is None

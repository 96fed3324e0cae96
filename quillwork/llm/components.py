"""Connected components: up to a stated number of links in one task, beyond it by alternating large-star and small-star
steps. Both give each node the least node of its component."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: a > b. Both steps look at each node's least neighbour through a sum by key and a join, which Spark can
    split for nodes with very many neighbours."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    seen = both.join(least, "a")
    if large:
        out = seen.where("b > a").select(F.col("b").alias("x"), "m")
    else:
        out = seen.select(F.col("b").alias("x"), "m").unionByName(least.select(F.col("a").alias("x"), "m"))
    return out.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over all links of a task."""
    owner: dict[int, int] = {}

    def find(c: int) -> int:
        while owner.setdefault(c, c) != c:
            owner[c] = c = owner[owner[c]]
        return c

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            owner[max(a, b)] = min(a, b)
    nodes = list(owner)
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(c) for c in nodes], pa.int64())], names=["cid", "comp"])


def components(scratch: Scratch, name: str, links: DataFrame, in_one: int = 300_000, most: int = 60) -> DataFrame:
    """cid, comp (the least cid of its component) for every node of links (a, b), links between different nodes.
    Up to in_one links are solved in one task, in some 50 MB; more than that by distributed steps, of which a graph needs
    some log2 of its longest path; an error says so if `most` do not suffice."""
    edges = scratch.put(f"{name}-0", links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), codec="none")
    if edges.count() <= in_one:
        return scratch.put(name, edges.coalesce(1).mapInArrow(_forest, "cid long, comp long"), codec="none")
    mark = None
    for i in range(1, most):
        edges = scratch.put(f"{name}-{i}", _star(_star(edges, True), False), codec="none")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
        scratch.drop(f"{name}-{i - 1}")
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    stars = edges.select(F.col("a").alias("cid"), F.col("b").alias("comp"))
    return stars.unionByName(stars.select(F.col("comp").alias("cid"), "comp").distinct())

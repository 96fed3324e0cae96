"""Weighted graphs: edges, strengths, participation, PageRank, modularity, communities, betweenness, lineage, motifs.

Edges are DataFrames (src, dst, weight ...) with src < dst. Iterations write each step to the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import moves

# Statuses by which relations count.
INCLUDED = ["", "ACTIVE", "VERIFIED", "SUPPORTED", "CONFIRMED", "DOCUMENTED", "SEED"]
EXCLUDED = ["REJECTED", "CONTRADICTED", "SUPERSEDED"]


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='quillwork-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """df written to the cluster's shared folder and read again: short lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def relations(raw: DataFrame) -> DataFrame:
    """FLT-01: source_id, target_id, relationship_type, confidence, evidence_count, primary_source_count, status."""
    status = F.upper(F.trim(F.coalesce("status", F.lit(""))))
    ends = (F.trim("source_id") != "") & (F.trim("target_id") != "") & (F.col("source_id") != F.col("target_id"))
    return raw.where(status.isin(INCLUDED) & ends)


def motif_relations(raw: DataFrame) -> DataFrame:
    """FLT-02: only the excluded statuses go."""
    return raw.where(~F.upper(F.trim(F.coalesce("status", F.lit("")))).isin(EXCLUDED))


def build_edges(raw: DataFrame, types: bool = True, flags: dict[str, list[str]] | None = None) -> DataFrame:
    """GRF-01, AGG-09: parallel relations as one undirected edge: src, dst, weight, evidence, types. Sets of types make Spark
    sort; flags (name: types) say instead whether an edge has one of some types."""
    w = X.edge_weight(F.col("relationship_type"), F.col("confidence"), F.col("evidence_count"), F.col("primary_source_count"))
    rows = relations(raw).withColumn("w", w).where("w > 0")
    return rows.groupBy(F.least("source_id", "target_id").alias("src"), F.greatest("source_id", "target_id").alias("dst")).agg(
        F.sum("w").alias("weight"), F.sum(F.greatest(F.lit(1.0), F.coalesce(F.col("evidence_count").cast("double"), F.lit(1.0)))).alias("evidence"),
        *([F.array_sort(F.collect_set(F.upper("relationship_type"))).alias("types")] if types else []), *(F.bool_or(F.upper("relationship_type").isin(of)).alias(name) for name, of in (flags or {}).items()))


def both_ways(edges: DataFrame) -> DataFrame:
    """node, other, weight."""
    a = edges.select(F.col("src").alias("node"), F.col("dst").alias("other"), "weight")
    return a.unionByName(edges.select(F.col("dst").alias("node"), F.col("src").alias("other"), "weight"))


#: Weights are summed as whole billionths, squares of shares as whole trillionths: sums of doubles depend on their order.
PARTS, SQUARES = 1e9, 1e12


def exact_sum(c: Column, parts: float = PARTS) -> Column:
    """The sum as a whole number of parts: the upper and the lower half of each are summed as integers."""
    whole, half = F.round(c * parts), 2.0**31
    high = F.floor(whole / half)
    low = (whole - high.cast("double") * half).cast("long")
    return (F.sum(high).cast("decimal(28,0)") * F.lit(2**31).cast("decimal(10,0)") + F.sum(low).cast("decimal(28,0)")).cast("decimal(38,0)")


def strengths(edges: DataFrame) -> DataFrame:
    """AGG-10: node, strength, degree."""
    return both_ways(edges).groupBy("node").agg((exact_sum(F.col("weight")).cast("double") / PARTS).alias("strength"), F.count(F.lit(1)).alias("degree"))


def membership(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """GRF-03, AGG-11: node, community, share: a node's weight to each community, its own with 0 if there is none."""
    w = both_ways(edges).join(communities.select(F.col("node").alias("other"), "community"), "other")
    per = w.groupBy("node", "community").agg(exact_sum(F.col("weight")).alias("w"))
    all_ = per.unionByName(communities.select("node", "community", F.lit(0).cast("decimal(38,0)").alias("w"))).groupBy("node", "community").agg(F.sum("w").alias("w"))
    total = F.sum("w").over(Window.partitionBy("node"))
    share = F.col("w").cast("double") / total.cast("double")
    return all_.select("node", "community", F.when(total > 0, share).otherwise(1.0).alias("share"))


def participation(shares: DataFrame) -> DataFrame:
    """GRF-04, MTH-02: 1 - sum of squared shares; outlier is 1 - the largest."""
    return shares.groupBy("node").agg(((SQUARES - exact_sum(F.col("share") * F.col("share"), SQUARES).cast("double")) / SQUARES).alias("participation"), (1 - F.max("share")).alias("outlier"))


def modularity(edges: DataFrame, communities: DataFrame, resolution: float = 1.0, of: tuple[str, ...] = ("community",)) -> DataFrame:
    """GRF-08: one row, q. With several columns of communities in `of` (all of one type), q0, q1 ... of one pass."""
    c = communities.select("node", F.array(*of).alias("c"))
    ends = edges.join(c.select(F.col("node").alias("src"), F.col("c").alias("a")), "src", "left").join(c.select(F.col("node").alias("dst"), F.col("c").alias("b")), "dst", "left")
    # an edge once at each end, its weight inside at the first
    at = lambda i, end, inner: F.struct(F.lit(i).alias("of"), F.col(end)[i].alias("community"), F.col("weight").alias("d"), inner.alias("l"))
    inside = [F.when(F.col("a")[i] == F.col("b")[i], F.col("weight")).otherwise(0.0) for i in range(len(of))]
    rows = ends.select(F.inline(F.array(*(x for i in range(len(of)) for x in (at(i, "a", inside[i]), at(i, "b", F.lit(0.0)))))))
    per = rows.where("community IS NOT NULL").groupBy("of", "community").agg(F.sum("d").alias("d"), F.sum("l").alias("l"))

    def q(i: int) -> Column:
        own = lambda x: F.sum(F.when(F.col("of") == i, x))
        m = own(F.col("d")) / 2
        return own(F.col("l")) / m - resolution * own(F.col("d") * F.col("d")) / (4 * m * m)

    return per.agg(*(q(i).alias("q" if len(of) == 1 else f"q{i}") for i in range(len(of))))


#: Nodes whose ranks are broadcast at most.
HUBS = 400_000


def pagerank(edges: DataFrame, rounds: int = 20, damping: float = 0.85, every: int = 5, tolerance: float | None = None, hubs: int = HUBS) -> DataFrame:
    """GRF-06: node, rank; weighted, undirected, so no node dangles. Edges are dealt once and kept on disk, by node or, from a
    hub (one of `hubs` nodes of most edges) to a node of fewer edges, by that node: the hubs' ranks are broadcast, so such a
    node's sum is made where it is, and what nodes send to a hub is summed before it moves. A lost executor's part is read
    again from the written edges. Ranks are written every round. With a tolerance, looked at every few rounds, they end when ranks change by less than it per node, summed over nodes."""
    nodes = saved(both_ways(edges).groupBy("node").agg(F.sum("weight").alias("out"), F.count(F.lit(1)).alias("degree")), "pr-nodes")
    n = nodes.count()
    side = lambda c: nodes.select(F.col("node").alias(c), F.struct("out", "degree", "node").alias(f"at_{c}"))
    both = edges.select("src", "dst", "weight").join(side("src"), "src").join(side("dst"), "dst")
    more = lambda a, b: F.struct(f"{a}.degree", f"{a}.node") > F.struct(f"{b}.degree", f"{b}.node")
    way = lambda a, b: F.struct(F.col(f"{a}.node").alias("node"), F.col(f"{b}.node").alias("other"), (F.col("weight") / F.col(f"{a}.out")).alias("share"), F.col(f"{a}.degree").alias("degree"), more(a, b).alias("down"))
    ends = saved(both.select(F.inline(F.array(way("at_src", "at_dst"), way("at_dst", "at_src")))), "pr-ways")
    top = saved(ends.where("down").groupBy("node").agg(F.first("degree").alias("degree")).orderBy(F.desc("degree"), "node").limit(hubs).select("node", F.lit(True).alias("hub")), "pr-hubs")
    ways = ends.join(F.broadcast(top), "node", "left")  # hubs: bounded
    pulled = F.col("down") & F.col("hub").isNotNull()
    push, pull = _dealt(ways.where(~pulled).select("node", "other", "share"), "node"), _dealt(ways.where(pulled).select("node", "other", "share"), "other")
    rank = last = nodes.select("node", F.lit(1.0 / max(1, n)).alias("rank"))
    given = F.sum(F.col("rank") * F.col("share")).alias("got")
    for i in range(rounds):
        sent = push.join(rank.hint("shuffle_hash"), "node").groupBy(F.col("other").alias("node")).agg(given)
        taken = pull.join(F.broadcast(rank.join(F.broadcast(top.select("node")), "node", "left_semi")), "node").groupBy(F.col("other").alias("node")).agg(given)
        got = sent.unionByName(taken).groupBy("node").agg(F.sum("got").alias("got"))
        rank = saved(got.select("node", ((1 - damping) / max(1, n) + damping * F.col("got")).alias("rank")), "pr")
        if (i + 1) % every == 0 or i + 1 == rounds:
            if tolerance is not None:
                moved = rank.join(last.withColumnRenamed("rank", "was"), "node").agg(F.sum(F.abs(F.col("rank") - F.col("was")))).first()[0] or 0.0
                if moved < tolerance * n * every:
                    break
            last = rank
    push.unpersist()
    pull.unpersist()
    return rank


def _louvain(edges: list[tuple], resolution: float) -> dict:
    """Weighted Louvain in a fixed order: nodes ascending, best gain, ties to the least community."""
    graph: dict = defaultdict(lambda: defaultdict(float))
    for a, b, w in edges:
        graph[a][b] += w
        if a != b:
            graph[b][a] += w
    total = sum(sum(x.values()) + x.get(n, 0.0) for n, x in graph.items()) / 2
    final = {n: n for n in graph}
    while total:
        home = {n: n for n in graph}
        size = {n: sum(x.values()) + x.get(n, 0.0) for n, x in graph.items()}
        mass, moved, any_move = dict(size), True, False
        while moved:
            moved = False
            for n in sorted(graph):
                links: dict = defaultdict(float)
                for o, w in graph[n].items():
                    if o != n:
                        links[home[o]] += w
                own = home[n]
                mass[own] -= size[n]
                gain = lambda c: links.get(c, 0.0) - resolution * mass[c] * size[n] / (2 * total)  # noqa: B023, E731
                order = {c: i for i, c in enumerate(sorted(links))}
                best = max([own, *order], key=lambda c: (round(gain(c), 12), c == own, -order.get(c, -1)))  # noqa: B023
                mass[best] += size[n]
                if best != own:
                    home[n], moved, any_move = best, True, True
        if not any_move:
            break
        names: dict = {}
        for n in sorted(home):
            names.setdefault(home[n], n)
        final = {n: names[home[c]] for n, c in final.items()}
        coarse: dict = defaultdict(lambda: defaultdict(float))
        for a, x in graph.items():
            for b, w in x.items():
                p, q = names[home[a]], names[home[b]]
                if p != q:
                    coarse[p][q] += w
                elif a == b:
                    coarse[p][p] += w
                else:
                    coarse[p][p] += w / 2
        graph = coarse
    least: dict = {}
    for n in sorted(final):
        least.setdefault(final[n], n)
    return {n: least[c] for n, c in final.items()}


def louvain(edges: DataFrame, by: list[str], resolution: float = 1.0) -> DataFrame:
    """GRF-02: by, node, community (its least node), a task per snapshot or layer in `by`: for many graphs of some thousand
    nodes each. moved_communities() takes one graph of any size."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        found = _louvain(list(frame[["src", "dst", "weight"]].itertuples(index=False)), resolution)
        out = pd.DataFrame(sorted(found.items()), columns=["node", "community"])
        for i, c in enumerate(by):
            out.insert(i, c, frame[c].iloc[0])
        return out

    kinds = dict(edges.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), f"node {kinds['src']}", f"community {kinds['src']}"])
    return edges.groupBy(*by).applyInPandas(work, schema)


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    """rows dealt by columns and kept on disk; a lost executor's part is made again from what was written."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by).persist(StorageLevel.DISK_ONLY)


def _local_moves(edges: DataFrame, start: DataFrame | None, resolution: float, rounds: int, least_gain: float) -> tuple[DataFrame, float]:
    """Rounds of parallel moves over one level's edges (src, dst, weight; src = dst holds what is inside a node), from
    `start` (node, community) or one community a node. The labels with the highest modularity seen, and that.

    Links stay where their `other` is, so a round moves labels to them and each link once, to its node; labels carry their
    community's mass and links their node's size, so nothing else is joined."""
    way = both_ways(edges)
    parts, sum_ = PARTS, way.agg(F.sum("weight")).first()[0]
    while sum_ * parts > 2**61:
        parts /= 10
    whole = F.round(F.col("weight") * parts).cast("long")
    way = way.select("node", "other", whole.alias("w"))
    sizes = saved(way.groupBy("node").agg(F.sum("w").alias("size")), "sizes")
    total = float(sizes.agg(F.sum("size")).first()[0])
    links = _dealt(saved(way.where("node <> other").join(sizes, "node").select("node", "other", "w", "size"), "links"), "other")
    label = start or sizes.select("node", F.col("node").alias("community"))
    label = saved(label.join(sizes, "node"), "labels")
    best, top, still = label, None, 0
    for turn in range(rounds + 1):
        full = label.join(label.groupBy("community").agg(F.sum("size").alias("mass")), "community")
        near = links.join(full.select(F.col("node").alias("other"), "community", "mass").hint("shuffle_hash"), "other").select("node", "community", "w", "mass", "size", F.lit(False).alias("own"))
        mine = full.select("node", "community", F.lit(0).cast("long").alias("w"), "mass", "size", F.lit(True).alias("own"))
        around = near.unionByName(mine).repartition("node").groupBy("node", "community").agg(F.sum("w").cast("double").alias("w"), F.max("mass").cast("double").alias("mass"), F.max("size").alias("size"), F.max("own").alias("own"))
        size, own = F.col("size").cast("double"), F.col("own")
        gain = F.round((F.col("w") - resolution * (F.col("mass") - F.when(own, size).otherwise(0.0)) * size / total) / total, 15)
        # half of the nodes may move in a round: two that want each other's place do not swap for ever
        picked = F.max_by("community", F.struct(gain.alias("g"), own.alias("o"), "community"))
        chosen = around.groupBy("node").agg(picked.alias("to"), F.max(F.when(own, F.col("community"))).alias("home"), F.max("size").alias("size"), F.max(F.when(own, F.col("w"))).alias("inner"), F.max(F.when(own, F.col("mass"))).alias("mass"))
        awake = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0
        after = saved(chosen.withColumn("community", F.when(awake, F.col("to")).otherwise(F.col("home"))), "moves")
        # what the round started from: sum over nodes of the weight inside, less the expected
        q, wants = after.agg(F.sum(F.col("inner") - resolution * F.col("mass") * size / total) / total, F.count_if(F.col("to") != F.col("home"))).first()
        still = 0 if top is None or q > top + least_gain else still + 1
        if top is None or q > top:
            best, top = label, q
        if not wants or still >= 3:
            break
        label = after.select("node", "community", "size")
    links.unpersist()
    inside = edges.where("src = dst").agg(F.sum(whole)).first()[0] or 0
    return best.select("node", "community"), top + 2 * inside / total


#: Nodes of a graph whose communities go to all tasks as arrays, at most, and links that are moved in the driver, at most.
HELD, FEW = 4_000_000, 1_000_000


def moved_communities(edges: DataFrame, resolution: float = 1.0, rounds: int = 16, levels: int = 10, least_gain: float = 1e-4, held: int = HELD, few: int = FEW) -> DataFrame:
    """GRF-02: node, community (its least node) for one graph of any size: local moving for modularity in parallel rounds,
    contraction to a graph of communities, again and again, then moves of the first level's nodes from what was found.

    Up to `held` nodes, links stay in blocks where they are and a round broadcasts the nodes' communities; above that it is
    two joins and a grouping of the edges by node. Levels of up to `few` links (both ways) are moved in the driver; no task
    holds a larger graph, and all ways find the same communities. All weights are summed as whole
    numbers and ties go to the own, then the greatest community, so reruns agree. Parallel moves see each other's
    communities as they were before the round, so a round can lose modularity: the best labels seen are kept. An empty
    graph gives no rows; a node with only a loop is a community of its own."""
    level = saved(edges.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.sum("weight").alias("weight")).where("weight > 0 AND src IS NOT NULL"), "level")
    if level.isEmpty():
        return level.select(F.col("src").alias("node"), F.col("src").alias("community"))
    nodes = saved(both_ways(level).select("node").distinct(), "nodes")
    work = _held_communities if nodes.count() <= held else _joined_communities
    found = work(level, nodes, resolution, rounds, levels, least_gain, few)
    names = found.groupBy("community").agg(F.min("node").alias("least"))
    return found.join(names, "community").select("node", F.col("least").alias("community"))


def _joined_communities(level: DataFrame, nodes: DataFrame, resolution: float, rounds: int, levels: int, least_gain: float, few: int) -> DataFrame:
    first, found, best = level, None, None
    for _ in range(levels):
        label, q = _local_moves(level, None, resolution, rounds, least_gain)
        if best is not None and q <= best + least_gain / 10:
            break
        best = q
        up = label.withColumnRenamed("community", "to")
        found = saved(up.withColumnRenamed("to", "community") if found is None else found.join(up.withColumnRenamed("node", "community"), "community").select("node", F.col("to").alias("community")), "found")
        ends = level.join(label.select(F.col("node").alias("src"), F.col("community").alias("a")), "src").join(label.select(F.col("node").alias("dst"), F.col("community").alias("b")), "dst")
        level = saved(ends.groupBy(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).agg((exact_sum(F.col("weight")).cast("double") / PARTS).alias("weight")), "level")
    return _local_moves(first, found, resolution, rounds, least_gain)[0]


class _Blocks:
    """Links (node, other, w: numbers, both ways) in blocks on the executors' disks; a lost executor's part is made again from
    what was written."""

    def __init__(self, ways: DataFrame, count: int):
        self.spark = ways.sparkSession
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-count // 2_000_000))
        self.rows = ways.repartition(parts, "node").sortWithinPartitions("node").mapInArrow(moves.pack, moves.LINKS).persist(StorageLevel.DISK_ONLY)

    def sizes(self, n: int) -> tuple[np.ndarray, int]:
        size, loops = np.zeros(n, np.int64), 0
        for r in self.rows.mapInArrow(moves.sizes, moves.SIZES).collect():
            np.add.at(size, np.frombuffer(r["node"], np.int32), np.frombuffer(r["size"], np.int64))
            loops += r["loops"]
        return size, loops

    def choices(self, *given) -> list[tuple]:
        sent = self.spark.sparkContext.broadcast(given)  # arrays of at most HELD numbers
        rows = self.rows.mapInArrow(moves.chooser(sent), moves.CHOICES).collect()
        sent.destroy()
        return [(np.frombuffer(r["node"], np.int32), np.frombuffer(r["to"], np.int32), np.frombuffer(r["inner"], np.int64)) for r in rows]

    def contracted(self, label: np.ndarray) -> DataFrame:
        sent = self.spark.sparkContext.broadcast(label)
        rows = self.rows.mapInArrow(moves.contractor(sent), "node long, other long, w long")
        ways = saved(rows.groupBy("node", "other").agg(F.sum("w").alias("w")), "level")
        sent.destroy()
        return ways

    def close(self) -> None:
        self.rows.unpersist()


def _placed(ways: DataFrame, few: int) -> _Blocks | moves.Few:
    """Links in the driver where they are few, else in blocks."""
    count = ways.count()
    if count > few:
        return _Blocks(ways, count)
    t = ways.select("node", "other", "w").toArrow()
    return moves.Few(*(t[c].to_numpy() for c in ("node", "other", "w")))


def _numbered(nodes: DataFrame, rounds: int) -> DataFrame:
    """node, id: its place among all in order, awake: in which rounds it may move, as bits."""
    at = F.monotonically_increasing_id()
    bits = [F.when(F.pmod(F.xxhash64("node", F.lit(i)), F.lit(2)) == 0, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i in range(min(rounds + 1, moves.AWAKE))]
    rows = saved(nodes.sort("node").select("node", F.shiftright(at, 33).alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"), sum(bits[1:], bits[0]).alias("awake")), "numbered")
    parts, before, starts = sorted(rows.groupBy("part").count().collect()), 0, []  # a row for each task that sorted
    for part, n in parts:
        starts.append((part, before))
        before += n
    first = F.broadcast(nodes.sparkSession.createDataFrame(starts, "part long, before long"))
    return saved(rows.join(first, "part").select("node", (F.col("at") + F.col("before")).alias("id"), "awake"), "ids")


def _held_communities(level: DataFrame, nodes: DataFrame, resolution: float, rounds: int, levels: int, least_gain: float, few: int) -> DataFrame:
    ids = _numbered(nodes, rounds)
    t = ids.select("id", "awake").toArrow()  # HELD rows at most
    awake = np.zeros(t.num_rows, np.int64)
    awake[t["id"].to_numpy()] = t["awake"].to_numpy()
    parts, sum_ = PARTS, 2 * level.agg(F.sum("weight")).first()[0]
    while sum_ * parts > 2**61:
        parts /= 10
    number = lambda end, name: ids.select(F.col("node").alias(end), F.col("id").alias(name))
    both = level.join(number("src", "a"), "src").join(number("dst", "b"), "dst").withColumn("w", F.round(F.col("weight") * parts).cast("long"))
    way = lambda a, b: F.struct(F.col(a).alias("node"), F.col(b).alias("other"), "w")
    first = links = _placed(saved(both.select(F.inline(F.array(way("a", "b"), way("b", "a")))), "ways"), few)
    alone = found = np.arange(len(awake), dtype=np.int32)
    best = None
    for _ in range(levels):
        label, q = moves.rounds_of(links, alone, awake, resolution, rounds, least_gain)
        if best is not None and q <= best + least_gain / 10:
            break
        best, found = q, label[found]
        up = links.contracted(label)
        if links is not first:
            links.close()
        links = up if isinstance(up, moves.Few) else _placed(up, few)
    found, _ = moves.rounds_of(first, found, awake, resolution, rounds, least_gain)
    first.close()
    links.close()
    sent = level.sparkSession.sparkContext.broadcast(found)
    out = saved(ids.mapInArrow(moves.labeller(sent), f"node {dict(ids.dtypes)['node']}, community long"), "found")
    sent.destroy()
    return out


def community_ids(members: DataFrame, snapshot: str) -> DataFrame:
    """SRT-03: members (node, community) with community_id C_<snapshot>_0001 ... by size, the largest first, and least node."""
    g = members.groupBy("community").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("least"))
    # one row per community: those of one snapshot
    n = F.row_number().over(Window.orderBy(F.desc("size"), "least"))
    ids = g.select("community", F.concat(F.lit(f"C_{snapshot}_"), F.lpad(n.cast("string"), 4, "0")).alias("community_id"))
    return members.join(ids, "community").select("node", "community_id")


def communities(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """Label propagation in DataFrame steps, for graphs of any size: a node takes the label with most weight around it."""
    e = both_ways(edges)
    # damped: a node's own label votes with half its strength, so that pairs do not swap labels for ever
    half = saved(e.groupBy("node").agg((F.sum("weight") / 2).alias("weight")), "lp-halves")
    e = _dealt(e, "other")
    label = half.select("node", F.col("node").alias("community"))
    for _ in range(rounds):
        # links stay where their `other` is; each goes to its node once a round
        votes = e.join(label.withColumnRenamed("node", "other").hint("shuffle_hash"), "other").select("node", "community", "weight")
        votes = votes.unionByName(label.join(half, "node").select("node", "community", "weight")).repartition("node")
        votes = votes.groupBy("node", "community").agg(F.sum("weight").alias("w"))
        label = saved(votes.groupBy("node").agg(F.max_by("community", F.struct("w", "community")).alias("community")), "lp")
    e.unpersist()
    return label


def _distances(sources: DataFrame, ways: DataFrame, tolerance: float) -> DataFrame:
    """source, node, d: shortest distances from the sources (node) along ways (node, other, weight). Of each round only the
    pairs that came nearer go on."""
    at = sources.select(F.col("node").alias("source"), "node", F.lit(0.0).alias("d"), F.lit(True).alias("moved"))
    while True:
        step = at.where("moved").join(ways, "node").groupBy("source", F.col("other").alias("node")).agg(F.min(F.col("d") + F.col("weight")).alias("new"))
        none = F.lit(None).cast("double")
        both = at.select("source", "node", "d", none.alias("new")).unionByName(step.select("source", "node", none.alias("d"), "new"))
        both = both.groupBy("source", "node").agg(F.min("d").alias("d"), F.min("new").alias("new"))
        nearer = F.col("d").isNull() | (F.col("new") < F.col("d") - tolerance)
        at = saved(both.select("source", "node", F.when(nearer, F.col("new")).otherwise(F.col("d")).alias("d"), F.coalesce(nearer, F.lit(False)).alias("moved")), "distances")
        if at.where("moved").isEmpty():
            return at.select("source", "node", "d")


def betweenness(edges: DataFrame, distance: Column | None = None, pairs: int = 20_000_000, landmarks: int = 16, tolerance: float = 1e-12) -> DataFrame:
    """GRF-05: node, betweenness, normalised; exact, as joins: no task and not the driver holds the graph.
    The default distance is the weight itself; pass 1 / weight to make strong ties short. Distances must be above 0.

    First go edges that are longer than the way by one of some landmarks (the nodes of most edges): no shortest path has
    them. Then sources are taken in batches of so many that a batch has about `pairs` rows (source, node) at most, or one source. Of a
    batch, distances come by rounds; then the edges that lie on shortest paths
    carry numbers of paths forwards and shares of later nodes backwards, a step of the longest path a round. Paths whose
    lengths differ by less than the tolerance are equally short. An empty graph gives no rows."""
    e = both_ways(edges.withColumn("weight", F.col("weight") if distance is None else distance)).where("node <> other")
    e = saved(e.groupBy("node", "other").agg(F.min("weight").alias("weight")), "ways")
    nodes = saved(e.groupBy("node").agg(F.count(F.lit(1)).alias("degree")), "nodes")
    n = nodes.count()
    near = _distances(nodes.orderBy(F.desc("degree"), "node").limit(landmarks), e, tolerance)
    ends = e.join(near.select("source", "node", F.col("d").alias("a")), "node").join(near.select("source", F.col("node").alias("other"), F.col("d").alias("z")), ["source", "other"])
    detour = ends.groupBy("node", "other").agg(F.min(F.col("a") + F.col("z")).alias("round"))
    e = saved(e.join(detour, ["node", "other"], "left").where(F.col("round").isNull() | (F.col("weight") <= F.col("round") + tolerance)).select("node", "other", "weight"), "ways")
    batches = max(1, -(-n * n // pairs))
    parts = [nodes.select("node", F.lit(0.0).alias("b"))]
    for i in range(batches):
        own = nodes.where(F.pmod(F.xxhash64("node"), F.lit(batches)) == i)
        at = _distances(own, e, tolerance)
        far = at.groupBy("source").agg(F.max("d").alias("far"))
        ways = at.join(far, "source").join(e, "node").select("source", "node", "other", (F.col("d") + F.col("weight")).alias("d"), "far").where(F.col("d") <= F.col("far") + tolerance)
        on = saved(ways.drop("far").join(at.select("source", F.col("node").alias("other"), F.col("d").alias("least")), ["source", "other"]).where(F.col("d") <= F.col("least") + tolerance).select("source", "node", "other"), "shortest")
        front = own.select(F.col("node").alias("source"), "node", F.lit(1.0).alias("paths"))
        steps = [front]
        while True:
            front = saved(front.join(on, ["source", "node"]).groupBy("source", F.col("other").alias("node")).agg(F.sum("paths").alias("paths")), "paths")
            if front.isEmpty():
                break
            steps.append(front)
        paths = steps[0]
        for x in steps[1:]:
            paths = paths.unionByName(x)
        paths = saved(paths.groupBy("source", "node").agg(F.sum("paths").alias("paths")), "all-paths")
        ends = paths.select("source", F.col("node").alias("other"), F.col("paths").alias("later"))
        on = saved(on.join(paths, ["source", "node"]).join(ends, ["source", "other"]).select("source", "node", "other", (F.col("paths") / F.col("later")).alias("share")).where("node <> source"), "shares")
        back = on.groupBy("source", "node").agg(F.sum("share").alias("x"))
        while True:
            back = saved(back, "later")
            if back.isEmpty():
                break
            parts.append(saved(back.groupBy("node").agg(F.sum("x").alias("b")), "scores"))
            back = on.join(back.withColumnRenamed("node", "other"), ["source", "other"]).groupBy("source", "node").agg(F.sum(F.col("share") * F.col("x")).alias("x"))
    whole = parts[0]
    for x in parts[1:]:
        whole = whole.unionByName(x)
    scale = 1.0 / max(1, (n - 1) * (n - 2))
    return whole.groupBy("node").agg((F.sum("b") * scale).alias("betweenness"))


def lineage(old: DataFrame, new: DataFrame, threshold: float = 0.18, member: float = 0.15) -> DataFrame:
    """GRF-10, JON-16: old_id, new_id, weighted, plain, kind. old, new: community, node, share (a node in several).

    Weighted Jaccard is sum of minima over sum of maxima; both come from sums of one join, so communities that share
    no node never meet."""
    o, n = old.select(F.col("community").alias("old_id"), "node", F.col("share").alias("a")), new.select(F.col("community").alias("new_id"), "node", F.col("share").alias("b"))
    both = o.join(n, "node").groupBy("old_id", "new_id").agg(F.sum(F.least("a", "b")).alias("low"), F.sum(F.when((F.col("a") >= member) & (F.col("b") >= member), 1).otherwise(0)).alias("common"))
    size = lambda d, c, v: d.groupBy(c).agg(F.sum(v).alias(f"m{v}"), F.sum((F.col(v) >= member).cast("int")).alias(f"n{v}"))
    both = both.join(size(o, "old_id", "a"), "old_id").join(size(n, "new_id", "b"), "new_id")
    jw = F.col("low") / (F.col("ma") + F.col("mb") - F.col("low"))
    jp = F.col("common") / F.greatest(F.lit(1), F.col("na") + F.col("nb") - F.col("common"))
    links = both.select("old_id", "new_id", jw.alias("weighted"), jp.alias("plain")).where(F.greatest("weighted", "plain") >= threshold)
    n_old, n_new = F.count(F.lit(1)).over(Window.partitionBy("old_id")), F.count(F.lit(1)).over(Window.partitionBy("new_id"))
    kind = F.when((n_old > 1) & (n_new > 1), "REFORMED").when(n_old > 1, "SPLIT").when(n_new > 1, "MERGE").otherwise("CONTINUE")
    matched = links.withColumn("kind", kind)
    none = F.lit(0.0)
    births = new.select(F.col("community").alias("new_id")).distinct().join(links, "new_id", "left_anti").select(F.lit(None).cast(dict(old.dtypes)["community"]).alias("old_id"), "new_id", none.alias("weighted"), none.alias("plain"), F.lit("BIRTH").alias("kind"))
    deaths = old.select(F.col("community").alias("old_id")).distinct().join(links, "old_id", "left_anti").select("old_id", F.lit(None).cast(dict(new.dtypes)["community"]).alias("new_id"), none.alias("weighted"), none.alias("plain"), F.lit("DEATH").alias("kind"))
    return matched.unionByName(births).unionByName(deaths)


# Stances by polarity, and adoptions that count as the speaker's own.
NEGATIVE = ["CRITICIZES", "DISPUTES", "ACCUSES", "WARNS_AGAINST", "RIDICULES", "DISTANCES_FROM", "CONTRADICTS", "OPPOSES"]
POSITIVE = ["PRAISES", "ENDORSES", "SUPPORTS", "DEFENDS", "AGREES_WITH", "PROMOTES", "RECOMMENDS"]
ADOPTED = ["ADOPTS", "SUPPORTS", "OWN_STATEMENT", ""]


def own_stances(raw: DataFrame) -> DataFrame:
    """FLT-03: stances (stance_event_id, source_entity_id, target_entity_id, stance_type, speaker_adoption, content_id)
    with source, target and type, adopted by their speaker: source, target, stance, content_id, stance_event_id."""
    text = lambda c: F.trim(F.coalesce(c, F.lit("")))
    x = raw.select(text("source_entity_id").alias("source"), text("target_entity_id").alias("target"), F.upper(text("stance_type")).alias("stance"), X.nz("content_id").alias("content_id"), X.nz("stance_event_id").alias("stance_event_id"), F.upper(text("speaker_adoption")).alias("__a"))
    return x.where((F.col("source") != "") & (F.col("target") != "") & (F.col("stance") != "") & F.col("__a").isin(ADOPTED)).drop("__a")


def relation_pairs(raw: DataFrame) -> DataFrame:
    """FLT-02, SET-07: unordered pairs a < b with their number of relations and the sources of these (source_ids joined by ;)."""
    r = motif_relations(raw).select(F.trim("source_id").alias("x"), F.trim("target_id").alias("y"), "source_ids").where("x <> '' and y <> '' and x <> y")
    ids = F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_list(F.split(F.trim(F.coalesce("source_ids", F.lit(""))), ";"))), lambda s: s != "")))
    return r.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("relations"), ids.alias("source_ids"))


def wedge_motifs(rels: DataFrame, stances: DataFrame) -> DataFrame:
    """GRF-12, JON-14, SET-03, MTH-06: related a, b (relation_pairs) with stances of one polarity to the same target
    (own_stances); negative wins where both have both. The join starts from related pairs, so a target with many sources
    makes no pairs of its own."""
    has = lambda values: F.arrays_overlap(F.collect_set("stance"), F.array(*map(F.lit, values)))
    ids = F.array_sort(F.array_compact(F.collect_list("stance_event_id")))
    side = stances.groupBy("source", "target").agg(has(NEGATIVE).alias("neg"), has(POSITIVE).alias("pos"), F.count(F.lit(1)).alias("n"), F.countDistinct("content_id").alias("c"), ids.alias("events"))
    name = lambda s: side.select(F.col("source").alias(s), "target", *[F.col(c).alias(f"{c}_{s}") for c in ("neg", "pos", "n", "c", "events")])
    both = rels.join(name("a"), "a").join(name("b"), ["b", "target"])
    kind = F.when(F.col("neg_a") & F.col("neg_b"), "SHARED_ADVERSARY_CONNECTED").when(F.col("pos_a") & F.col("pos_b"), "SHARED_SUPPORT_CONNECTED")
    both = both.withColumn("motif_type", kind).where("motif_type is not null")
    strength = X.motif_strength(F.col("relations"), F.col("n_a"), F.col("n_b"), F.col("c_a"), F.col("c_b"))
    return both.select(
        X.stable_id("MF_", F.col("motif_type"), F.col("a"), F.col("b"), F.col("target"), n=20).alias("motif_id"), "motif_type", F.to_json(F.array("a", "b", "target")).alias("node_ids"),
        F.to_json(F.concat("events_a", "events_b")).alias("edge_event_ids"), F.to_json("source_ids").alias("source_ids"), strength.alias("signal_strength"))


def reversals(stances: DataFrame) -> DataFrame:
    """GRF-13: a source with stances of both polarities to one target; strength 35."""
    s = F.col("stance")
    g = stances.groupBy("source", "target").agg(F.count_if(s.isin(NEGATIVE)).alias("neg"), F.count_if(s.isin(POSITIVE)).alias("pos")).where("neg > 0 and pos > 0")
    kind = F.lit("STANCE_REVERSAL")
    return g.select(X.stable_id("MF_", kind, F.col("source"), F.col("target"), n=20).alias("motif_id"), kind.alias("motif_type"), F.to_json(F.array("source", "target")).alias("node_ids"), F.lit("[]").alias("edge_event_ids"), F.lit("[]").alias("source_ids"), F.lit(35.0).alias("signal_strength"))


def bridge_motifs(metrics: DataFrame) -> DataFrame:
    """GRF-14: metrics: snapshot_id, node, participation, bridge, brokerage."""
    hit = (F.col("participation") >= 0.55) & ((F.col("bridge") >= 0.75) | (F.col("brokerage") >= 0.03))
    strength = F.least(F.lit(100.0), 25 + 45 * F.col("participation") + 15 * F.least(F.lit(1.0), F.col("bridge")))
    kind = F.lit("CROSS_COMMUNITY_BRIDGE")
    return metrics.where(hit).select(X.stable_id("MF_", kind, F.col("node"), F.col("snapshot_id"), n=20).alias("motif_id"), kind.alias("motif_type"), F.to_json(F.array("node")).alias("node_ids"), F.lit("[]").alias("edge_event_ids"), F.lit("[]").alias("source_ids"), F.round(strength, 2).alias("signal_strength"))


def node_metrics(edges: DataFrame, shares: DataFrame, between: DataFrame, ranks: DataFrame, snapshot: str) -> DataFrame:
    """GRF-07, MTH-09, AGG-10: one row per node: degree, strength, betweenness, PageRank, participation, bridge, outlier,
    evidence; rounded to even halves. edges with evidence; shares from membership()."""
    ends = edges.select(F.col("src").alias("node"), "weight", "evidence").unionByName(edges.select(F.col("dst").alias("node"), "weight", "evidence"))
    g = ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"), (exact_sum(F.col("weight")).cast("double") / PARTS).alias("s"), F.sum("evidence").alias("evidence_coverage"))
    m = g.join(participation(shares), "node").join(between.select("node", "betweenness"), "node", "left").join(ranks.select("node", "rank"), "node", "left")
    b = F.coalesce("betweenness", F.lit(0.0))
    return m.select(
        F.lit(snapshot).alias("snapshot_id"), "node", F.lit("relationship").alias("layer"), "degree", F.bround("s", 6).alias("weighted_degree"), F.bround(b, 8).alias("betweenness"), F.bround("rank", 8).alias("pagerank"),
        F.bround("participation", 6).alias("participation"), F.bround(X.bridge_score(F.col("participation"), F.col("s")), 6).alias("bridge"), F.bround(b, 8).alias("brokerage"), F.bround("outlier", 6).alias("outlier"), "evidence_coverage")


def stance_edges(stances: DataFrame) -> DataFrame:
    """DCL-02: source to target: stances by polarity, contents, the stance that is most frequent (the first of equals)."""
    s = F.col("stance")
    per = stances.groupBy("source", "target", "stance").agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy("source", "target").agg(F.min_by("stance", F.struct((-F.col("n")).alias("n"), "stance")).alias("dominant"))
    g = stances.groupBy("source", "target").agg(F.count(F.lit(1)).alias("stances"), F.count_if(s.isin(NEGATIVE)).alias("negative"), F.count_if(s.isin(POSITIVE)).alias("positive"), F.countDistinct("content_id").alias("contents"))
    return g.join(top, ["source", "target"])


# Relationships that are money, those that are business, and the weight of a strong tie.
MONEY = ["OWNS", "CONTROLS", "FINANCIAL", "PAYS", "FUNDS", "INVESTS_IN", "EMPLOYS"]
COMMERCE = ["SPONSORSHIP", "AFFILIATE_REFERRAL", "SELLS", "MANUFACTURES", "DISTRIBUTES", "LICENSES", "COMMERCIAL_PROMOTION", "CONTRACTS_WITH", "JOINT_PRODUCT"]
LAYER_TYPES = {"commerce": COMMERCE, "money": MONEY}
STRONG = 8.0


def layers(edges: DataFrame) -> DataFrame:
    """DCL-03: degree and strength of each node in four layers: all edges, strong ties, commerce, money. An edge is in a
    layer if one of its types is; edges have types, or commerce and money (build_edges with LAYER_TYPES)."""
    has = lambda name, values: F.col(name) if name in edges.columns else F.arrays_overlap("types", F.array(*map(F.lit, values)))
    of = {"all": F.lit(True), "strong": F.col("weight") >= STRONG, "commerce": has("commerce", COMMERCE), "money": has("money", MONEY)}
    # one pass over the edges, one row a node; layers become rows after the sums
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"), "weight", *[c.alias(f"in_{name}") for name, c in of.items()])
    sums = [F.struct(F.lit(name).alias("layer"), F.count_if(f"in_{name}").alias("degree"), (exact_sum(F.when(F.col(f"in_{name}"), F.col("weight"))).cast("double") / PARTS).alias("strength")) for name in of]
    return ends.groupBy("node").agg(F.array(*sums).alias("x")).select("node", F.inline("x")).where("degree > 0").select("layer", "node", "degree", "strength")


def carry_review(found: DataFrame, prior: DataFrame) -> DataFrame:
    """GRF-15: motifs once each, with the status and notes that people gave them. prior: motif_id, status, notes."""
    one = found.dropDuplicates(["motif_id"])
    p = prior.select("motif_id", X.nz("status").alias("__s"), X.nz("notes").alias("__n"))
    return one.join(p, "motif_id", "left").select("*", F.coalesce("__s", F.lit("OPEN")).alias("status"), F.coalesce("__n", F.lit("")).alias("review_notes")).drop("__s", "__n")


def named_nodes(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """JON-25: nodes (node, ...) with the entity's name, the id where it has none. names: id, name."""
    return nodes.join(names.select(F.col("id").alias("node"), X.nz("name").alias("__n")), "node", "left").withColumn("label", F.coalesce("__n", F.col("node").cast("string"))).drop("__n")


def snapshot_json(snapshot: str, nodes: DataFrame, edges: DataFrame, communities: DataFrame | None = None, lineage: DataFrame | None = None) -> DataFrame:
    """GRF-11, SNK-04: one JSON text of a graph that fits a page: callers cut it first (DCL-13)."""
    part = lambda df, name: df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))
    given = {"communities": communities, "nodes": nodes, "edges": edges, "lineage": lineage}
    parts = [part(df, name) for name, df in given.items() if df is not None]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.join(p)  # one row each
    return whole.select(F.to_json(F.struct(F.lit(snapshot).alias("snapshot"), *whole.columns)).alias("json"))


def ego(edges: DataFrame, centre, hops: int = 2) -> DataFrame:
    """DCL-13: edges within `hops` of a node."""
    e = both_ways(edges)
    near = edges.sparkSession.createDataFrame([(centre,)], f"node {dict(e.dtypes)['node']}")
    for _ in range(hops):
        near = near.unionByName(e.join(near, "node", "left_semi").select(F.col("other").alias("node"))).distinct()
    return edges.join(near.withColumnRenamed("node", "src"), "src", "left_semi").join(near.withColumnRenamed("node", "dst"), "dst", "left_semi")

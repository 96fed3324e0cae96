"""What operators shuffle, write and hold, as a multiple of their input."""

import numpy as np
import pytest

from quillwork.operators import graph, vectors
from quillwork.sources import io


def stages(spark):
    store = spark.sparkContext._jsc.sc().statusStore()
    found = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return [found.apply(i) for i in range(found.size())]


def volume(spark, run):
    """Bytes that run() shuffles and writes."""
    last = max((s.stageId() for s in stages(spark)), default=-1)
    run()
    return sum(s.shuffleWriteBytes() + s.outputBytes() for s in stages(spark) if s.stageId() > last)


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def test_blocks_are_sent_once_a_shard(spark, no_broadcast):
    rng = np.random.default_rng(3)
    n, dim = 1500, 64
    df = graph.saved(spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(n, dim)))], "id long, vec array<float>"), "test")
    got = volume(spark, lambda: vectors.blocks_topk(df, df, 5, 0.2).count())
    assert got < (n / vectors.SHARD_ROWS + 8) * n * (4 * dim + 100), got


def web(spark, hubs=6, n=4000, each=4):
    """Nodes with `each` links to some of a few hubs, repeated in no order."""
    rng = np.random.default_rng(5)
    rows = [(f"a{h}", f"n{i:05d}", float(rng.integers(1, 5))) for i in range(n) for h in rng.choice(hubs, each, replace=False)]
    return graph.saved(spark.createDataFrame(rows, "src string, dst string, weight double"), "test"), rows


def test_ranks_move_and_not_links(spark, no_broadcast):
    df, rows = web(spark)
    graph.pagerank(df, 1)
    one = volume(spark, lambda: graph.pagerank(df, 2).count())
    many = volume(spark, lambda: graph.pagerank(df, 12).count())
    assert (many - one) / 10 < 30 * 4000 + 10 * len(rows), (many, one)


def test_ranks_with_few_or_no_hubs(spark):
    df, rows = web(spark, n=60)
    out, rank, nodes = {}, {}, {x for r in rows for x in r[:2]}
    for a, b, w in rows:
        for x in (a, b):
            out[x] = out.get(x, 0) + w
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(7):
        new = dict.fromkeys(nodes, 0.15 / len(nodes))
        for a, b, w in rows:
            new[b] += 0.85 * rank[a] * w / out[a]
            new[a] += 0.85 * rank[b] * w / out[b]
        rank = new
    for hubs in (400_000, 2, 0):
        assert {r.node: pytest.approx(r["rank"]) for r in graph.pagerank(df, 7, hubs=hubs).collect()} == rank


def test_flags_stand_for_types(spark):
    raw = spark.createDataFrame([("a", "b", "OWNS", 1), ("b", "a", "SELLS", 9), ("a", "c", "other", 2)], "source_id string, target_id string, relationship_type string, evidence_count long").selectExpr("*", "'' AS confidence", "0 AS primary_source_count", "'' AS status")
    flagged = graph.build_edges(raw, types=False, flags=graph.LAYER_TYPES)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "collect_set" not in plan
    assert sorted(graph.layers(flagged).collect()) == sorted(graph.layers(graph.build_edges(raw)).collect())


def test_rounds_send_each_link_once(spark, no_broadcast):
    df, rows = web(spark)
    one = volume(spark, lambda: graph.communities(df, 1).count())
    many = volume(spark, lambda: graph.communities(df, 5).count())
    assert (many - one) / 4 < 40 * len(rows), (many, one)


def test_moves_of_few_links_run_few_stages(spark):
    df, _ = web(spark)
    last = max(s.stageId() for s in stages(spark))
    graph.moved_communities(df).count()
    assert max(s.stageId() for s in stages(spark)) - last < 60


def test_moves_leave_links_where_they_are(spark, no_broadcast):
    df, rows = web(spark)
    moved = lambda rounds: volume(spark, lambda: graph.moved_communities(df, rounds=rounds, levels=1, least_gain=-1.0, few=0).count())
    few, many = moved(2), moved(8)
    assert (many - few) / 6 < len(rows), (many, few)


def test_one_timer_a_lane():
    import types

    import pandas as pd

    from quillwork.streaming.leases import LeaseQueue

    class State(dict):
        getValue, containsKey, removeKey = dict.__getitem__, dict.__contains__, dict.__delitem__

        def updateValue(self, key, value):  # noqa: N802
            puts.append(key)
            self[key] = value

    puts, timers, queue = [], [], LeaseQueue()
    queue.handle, queue.state = types.SimpleNamespace(registerTimer=timers.append), State()
    at = lambda i: pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=i)
    rows = [("L", i, at(i), "enqueue", i, 1, None, None, 3) for i in range(20)] + [("L", 20 + i, at(20), "lease", None, None, "w", 100.0 + i, 3) for i in range(20)]
    frame = pd.DataFrame(rows, columns="lane seq ts command job_id priority worker seconds most".split())
    list(queue.handleInputRows(("L",), iter([frame]), None))
    first = at(120).value // 1_000_000 + 1
    assert timers == [first] and puts.count(("worker/w",)) == 1
    mark = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: first + 10_000)
    out = pd.concat(queue.handleExpiredTimer(("L",), mark, types.SimpleNamespace(getExpiryTimeInMs=lambda: first)))
    assert len(out) == 10 and set(out.event) == {"lease_expired"} and timers[1:] == [first + 10_000]


def test_names_with_one_short_id_are_many_tasks(spark):
    n = 20_000
    paths = spark.range(n).selectExpr("'/a/x' || id || '_tail.wav' AS path").repartition(8)
    ids = spark.createDataFrame([("x",), ("x77",)], "video_id string")
    manifest = ids.selectExpr("'none' AS audio_path", "video_id")
    got = graph.saved(io.audio_to_video(paths, manifest, ids), "test")
    assert got.count() == n and got.where("video_id = 'x77'").count() == sum(str(i).startswith("77") for i in range(n))
    # the names meet the ids where they are: rows of 20,000 names go by path only
    plan = io.audio_to_video(paths, manifest, ids)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "strategy=broadcast" in plan


def test_chains_are_not_broadcast(spark):
    from quillwork.operators.sequences import citation_lineage

    links = spark.createDataFrame([(i, i // 2 if i > 1 else None) for i in range(200)], "id long, cites long")
    assert "BroadcastHashJoin" not in citation_lineage(links)._jdf.queryExecution().executedPlan().toString()

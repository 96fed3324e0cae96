"""Citation chains and bursts against plain versions."""

import random

from quillwork.operators.sequences import adjacency, bursts, citation_lineage, funnels


def test_lineage(spark):
    rng = random.Random(8)
    cites = {i: rng.choice([None, rng.randrange(400), rng.randrange(400), 10_000]) if i % 3 else i + 1 for i in range(400)}
    cites |= {500: 500, 501: 502, 502: 501, **{600 + i: 600 + (i + 1) % 77 for i in range(77)}, **{800 + i: 801 + i for i in range(150)}, 950: None, 960: 650}
    df = spark.createDataFrame(list(cites.items()), "id long, cites long").repartition(3)
    got = {r.id: (r.origin, r.hops, r.cycle, r.in_cycle) for r in citation_lineage(df).collect()}
    for i in cites:
        path, seen = [i], {i}
        while (nxt := cites[path[-1]]) in cites and nxt not in seen:
            path.append(nxt)
            seen.add(nxt)
        ring = path[path.index(nxt) :] if nxt in cites else []
        assert got[i] == ((None, None, min(ring), i in ring) if ring else (path[-1], len(path) - 1, None, False)), i
    assert len(got) == len(cites) and citation_lineage(df.limit(0)).collect() == []


def test_bursts(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randrange(9), rng.randrange(400)) for _ in range(300)]
    got = sorted(tuple(r) for r in bursts(spark.createDataFrame(rows, "key string, user int, t long"), 20, 4, part=50).select("key", "start", "end", "peak").collect())
    want = []
    for key in "ab":
        own = [(u, t) for k, u, t in rows if k == key]
        start = peak = None
        for now in range(500):
            n = len({u for u, t in own if t <= now < t + 20})
            if n >= 4:
                start, peak = (now, n) if start is None else (start, max(peak, n))
            elif start is not None:
                want.append((key, start, now, peak))
                start = None
    assert got == want
    edge = spark.createDataFrame([("c", u, t) for u, t in ((1, 3590), (2, 3595), (3, 3605), (4, 3608))], "key string, user int, t long")
    assert [tuple(r) for r in bursts(edge, 20, 4).select("start", "end", "peak").collect()] == [(3608, 3610, 4)]  # over an hour's edge
    assert bursts(edge.limit(0), 20, 4).collect() == []


def test_funnels(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice("xyzw"), rng.randrange(500) if i % 40 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "key string, id int, kind string, t long")
    want = {}
    for key in "ab":
        own, chains = [r for r in rows if r[0] == key and r[3] is not None], {}
        for step, kind in enumerate("xyz", 1):
            now = {}
            for _, i, k, t in own:
                if k == kind:
                    come = [(u, s) for u, s in chains.values() if 0 < t - u <= 7]
                    if step == 1 or come:
                        now[i] = (t, t if step == 1 else max(come)[1])
            want |= {(key, i): (step, *x) for i, x in now.items()}
            chains = now
    for part in (None, 15, 1):
        got = funnels(df, list("xyz"), 7, part).collect()
        assert {(r.key, r.id): (r.step, r.t, r.start) for r in got} == want and len(got) == len(want)
    assert sum(x[0] == 3 for x in want.values()) > 5 and funnels(df.limit(0), ["x", "y"], 5).collect() == []
    assert {r.id for r in funnels(df, ["w"], 5).collect()} == {i for k, i, kind, t in rows if k and kind == "w" and t is not None}


def test_adjacency(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice("xyz"), t := rng.randrange(900) if i % 30 else None, None if t is None else t // 12) for i in range(250)]
    df = spark.createDataFrame(rows, "key string, id int, kind string, t long, segment long")
    want = {}
    for key, i, kind, t, seg in rows:
        if kind == "y":
            near = min((abs(t - u) for k, _, x, u, _ in rows if x == "x" and k == key and key and None not in (t, u)), default=None)
            same = any(x == "x" and k == key and key and s == seg is not None for k, _, x, _, s in rows)
            want[i] = (key, near if near is not None and near <= 6 else None, same, near is not None and near <= 2, near is not None and near <= 6)
    for part in (None, 10):
        got = adjacency(df, ["x"], ["y"], [2, 6], part).collect()
        assert {r.id: (r.key, r.apart, r.same_segment, r.within_2, r.within_6) for r in got} == want and len(got) == len(want)
    assert adjacency(df.limit(0), ["x"], ["y"], [2]).collect() == []

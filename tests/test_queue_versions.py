"""The lease queue's parts and the versioned table."""

import random

import pytest

from quillwork.sources.versions import ConflictError, VersionedTable
from quillwork.streaming.leases import Lane, OrderedSet


class Store(dict):
    def put(self, key, value):
        self.pop(key, None) if value is None else self.__setitem__(key, value)


def test_ordered_set_over_reloads():
    rng, kept, want = random.Random(4), Store(), []
    for _ in range(30):
        s = OrderedSet(kept.get, kept.put, most=5)
        for _ in range(40):
            pair = (rng.randrange(20), rng.randrange(40))
            if rng.random() < 0.6 and pair not in want:
                s.add(pair)
                want = sorted([*want, pair])
            elif want:
                gone = rng.choice(want) if rng.random() < 0.7 else pair
                s.discard(gone)
                want = [p for p in want if p != gone]
            assert s.first() == (want[0] if want else None)
        s.flush()
        assert [p for _, c, _ in s.directory for p in map(tuple, kept[c])] == want and len(kept) == len(s.directory) + 1


def test_lane_rules():
    def play(*commands):
        kept, out = Store(), []
        for c in commands:  # each command meets the state as it was stored
            lane = Lane(kept)
            lane.apply(*c)
            lane.flush()
            out += lane.out
        return [(j, t // 10**6, e) for j, t, e, _, _ in out]

    s = 10**6
    put = lambda t, j, p=1: (t * s, "enqueue", j, p, None, 0.0, 2)
    do = lambda t, what, w="a", sec=60.0, j=None: (t * s, what, j, 1, w, sec, 2)
    assert play(put(0, 1), put(1, 2, 0), put(2, 1), do(3, "lease")) == [(1, 0, "enqueued"), (2, 1, "enqueued"), (2, 3, "leased")]
    # 30 seconds at least; the end of a lease frees the job for others; a lost lease completes nothing
    assert play(put(0, 1), do(1, "lease", sec=5), do(30, "lease", "b"), do(32, "lease", "b"), do(33, "complete"))[1:] == [(1, 1, "leased"), (1, 31, "lease_expired"), (1, 32, "leased")]
    assert play(put(0, 1), do(1, "lease"), do(50, "heartbeat"), do(100, "complete"))[1:] == [(1, 1, "leased"), (1, 100, "completed")]
    # retried after its delay until its leases are used up
    again = [(1, 1, "leased"), (1, 2, "retry_scheduled"), (1, 12, "leased"), (1, 13, "failed")]
    assert play(put(0, 1), do(1, "lease"), do(2, "fail", sec=10), do(11, "lease"), do(12, "lease"), do(13, "fail"), do(99, "lease"))[1:] == again
    assert play(put(0, 1), do(1, "lease"), do(2, "complete"), do(3, "force", j=1), do(4, "lease"))[2:] == [(1, 2, "completed"), (1, 3, "requeued_force"), (1, 4, "leased")]


def test_versions(spark, tmp_path):
    table, other = (VersionedTable(spark, f"file://{tmp_path}/t") for _ in range(2))
    with pytest.raises(KeyError):
        table.read()
    table.rebuild("A", lambda: spark.range(3))
    assert other.read().count() == 3

    def late():
        other.rebuild("B", lambda: spark.range(5))  # commits between this rebuild's start and its end
        return spark.range(7)

    with pytest.raises(ConflictError):
        table.rebuild("C", late)
    assert table.read().count() == 5 and len(list((tmp_path / "t" / "data").iterdir())) == 2

    def broken():
        return spark.range(9).selectExpr("if(id > 5, raise_error('no'), id) AS id")

    with pytest.raises(Exception, match="no"):
        table.rebuild("D", broken)
    assert table.read().count() == 5 and table.read("A").count() == 3
    table.restore("A")
    runs = [(r.batch_id, r.state, r.superseded_by) for r in table.runs().orderBy("number").collect()]
    assert runs == [("A", "superseded", "B"), ("B", "superseded", "A"), ("D", "failed", None), ("A", "active", None)] and table.read().count() == 3
    (tmp_path / "t" / "log" / f"{4:010d}").write_text('{"batch_id": ')  # an entry that its writer has not finished
    assert table.read().count() == 3

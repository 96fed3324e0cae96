"""The lease queue as a stream (STM-01 ... STM-06): one state per lane, kept in order, with timers for leases that run out.

Commands come in event time; each takes effect on its lane's state as of its own time, so the log does not depend on how
commands fall into batches. A lane keeps its jobs by id and three ordered sets of them: queued by (priority, id), waiting for
a retry by time, leased by the end of the lease. A set is cut into chunks under a directory, so that a command reads and
writes a few chunks however long the queue is."""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

COMMAND = "lane string, seq long, ts timestamp, command string, job_id long, priority int, worker string, seconds double, most int"
EVENT = "lane string, job_id long, us long, event string, worker string, attempts int"
#: A lease lasts this many seconds at least.
LEAST = 30


class OrderedSet:
    """Pairs of integers in order: a directory [low, chunk, size] and chunks of at most `most` pairs. read and write take
    the place of a state store: None is the directory's key, a number a chunk's."""

    def __init__(self, read, write, most: int = 256):
        self.read, self.write, self.most = read, write, most
        self.directory: list[list] = read(None) or []
        self.chunks: dict[int, list[tuple[int, int]]] = {}
        self.dirty: set[int] = set()
        self.next = max((c for _, c, _ in self.directory), default=-1) + 1

    def _chunk(self, i: int) -> list[tuple[int, int]]:
        c = self.directory[i][1]
        if c not in self.chunks:
            self.chunks[c] = [tuple(x) for x in self.read(c) or []]
        self.dirty.add(c)
        return self.chunks[c]

    def _place(self, pair: tuple[int, int]) -> int:
        return max(0, bisect.bisect_right(self.directory, list(pair), key=lambda d: list(d[0])) - 1)

    def add(self, pair: tuple[int, int]) -> None:
        if not self.directory:
            self.directory.append([list(pair), self.next, 0])
            self.chunks[self.next], self.next = [], self.next + 1
        i = self._place(pair)
        chunk = self._chunk(i)
        bisect.insort(chunk, pair)
        self.directory[i][0], self.directory[i][2] = list(chunk[0]), len(chunk)
        if len(chunk) > self.most:
            half = len(chunk) // 2
            self.chunks[self.next], chunk[half:] = chunk[half:], []
            self.directory[i][2] = half
            self.directory.insert(i + 1, [list(self.chunks[self.next][0]), self.next, len(self.chunks[self.next])])
            self.dirty.add(self.next)
            self.next += 1

    def discard(self, pair: tuple[int, int]) -> None:
        if self.directory:
            i = self._place(pair)
            chunk = self._chunk(i)
            if pair in chunk:
                chunk.remove(pair)
                if chunk:
                    self.directory[i][0], self.directory[i][2] = list(chunk[0]), len(chunk)
                else:
                    del self.directory[i]

    def first(self) -> tuple[int, int] | None:
        return tuple(self.directory[0][0]) if self.directory else None

    def flush(self) -> None:
        held = {c for _, c, _ in self.directory}
        for c in self.dirty:
            self.write(c, self.chunks[c] if c in held else None)
        if self.dirty:
            self.write(None, self.directory)
        self.dirty.clear()


class Lane:
    """One lane's jobs; store gives get and put of text by key (None deletes), a dict or Spark's state."""

    def __init__(self, store):
        self.store = store
        part = lambda name: OrderedSet(lambda c: self._load(f"{name}/{'' if c is None else c}"), lambda c, v: self._save(f"{name}/{'' if c is None else c}", v))
        self.queued, self.waiting, self.leased = part("queued"), part("waiting"), part("leased")
        self.jobs: dict[int, dict] = {}
        self.workers: dict[str | None, int | None] = {}
        self.leased_by: set[str | None] = set()
        self.out: list[tuple[int, int, str, str | None, int]] = []

    def _load(self, key: str):
        found = self.store.get(key)
        return None if found is None else json.loads(found)

    def _save(self, key: str, value) -> None:
        self.store.put(key, None if value is None else json.dumps(value))

    def job(self, job_id: int | None) -> dict | None:
        if job_id is None:
            return None
        if job_id not in self.jobs:
            self.jobs[job_id] = self._load(f"job/{job_id}")
        return self.jobs[job_id]

    def _last(self, worker: str | None) -> int | None:
        """The job that a worker leased last."""
        if worker not in self.workers:
            self.workers[worker] = self._load(f"worker/{worker}")
        return self.workers[worker]

    def _log(self, job: dict, at: int, event: str, worker: str | None) -> None:
        self.out.append((job["id"], at, event, worker, job["attempts"]))

    def _leave(self, job: dict) -> None:
        self.queued.discard((job["priority"], job["id"]))
        self.waiting.discard((job["at"], job["id"]))
        self.leased.discard((job["until"], job["id"]))

    def reclaim(self, now: int) -> None:
        """Leases that ended before now go back to the queue."""
        while (first := self.leased.first()) and first[0] < now:
            job = self.job(first[1])
            self._leave(job)
            self._log(job, job["until"], "lease_expired", job["worker"])
            job |= {"state": "queued", "worker": None, "until": 0}
            self.queued.add((job["priority"], job["id"]))

    def apply(self, now: int, command: str, job_id: int | None, priority: int, worker: str | None, seconds: float, most: int) -> int | None:
        """Gives the end of a new lease, if there is one. A worker's command without a job means the job it leased last."""
        self.reclaim(now)
        while (first := self.waiting.first()) and first[0] <= now:
            self.waiting.discard(first)
            self.queued.add((self.job(first[1])["priority"], first[1]))
        if command in ("enqueue", "force"):
            job = self.job(job_id)
            if job and command == "enqueue":
                return None
            if job:
                self._leave(job)
            self.jobs[job_id] = new = {"id": job_id, "priority": priority, "state": "queued", "attempts": 0, "most": most, "worker": None, "until": 0, "at": now}
            self.queued.add((priority, job_id))
            self._log(new, now, "requeued_force" if job else "enqueued", None)
            return None
        if command == "lease":
            first = self.queued.first()
            if first is None:
                return None
            self.queued.discard(first)
            job = self.job(first[1])
            until = now + int(max(LEAST, seconds) * 1_000_000)
            job |= {"state": "leased", "attempts": job["attempts"] + 1, "worker": worker, "until": until}
            self.leased.add((until, job["id"]))
            self.workers[worker] = job["id"]
            self.leased_by.add(worker)
            self._log(job, now, "leased", worker)
            return until
        job = self.job(self._last(worker) if job_id is None else job_id)
        if job is None:
            return None
        own = job["state"] == "leased" and job["worker"] == worker
        if command == "heartbeat" and own:
            self._leave(job)
            job["until"] = now + int(max(LEAST, seconds) * 1_000_000)
            self.leased.add((job["until"], job["id"]))
            return job["until"]
        if command == "complete" and own:
            self._leave(job)
            job |= {"state": "done", "until": 0}
            self._log(job, now, "completed", worker)
        if command == "fail":  # whatever its state
            self._leave(job)
            again = job["attempts"] < job["most"]
            job |= {"state": "queued" if again else "failed", "worker": None, "until": 0, "at": now + int(max(0.0, seconds) * 1_000_000)}
            if again:
                self.waiting.add((job["at"], job["id"]))
            self._log(job, now, "retry_scheduled" if again else "failed", worker)
        return None

    def flush(self) -> None:
        for part in (self.queued, self.waiting, self.leased):
            part.flush()
        for job_id, job in self.jobs.items():
            if job:
                self._save(f"job/{job_id}", job)
        for worker in self.leased_by:
            self._save(f"worker/{worker}", self.workers[worker])
        self.leased_by.clear()


class _States:
    """Spark's map state as the store of a lane."""

    def __init__(self, state):
        self.state = state

    def get(self, key: str) -> str | None:
        return self.state.getValue((key,))[0] if self.state.containsKey((key,)) else None

    def put(self, key: str, value: str | None) -> None:
        if value is not None:
            self.state.updateValue((key,), (value,))
        elif self.state.containsKey((key,)):
            self.state.removeKey((key,))


class LeaseQueue(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getMapState("lane", "key string", "value string")

    def _rows(self, key, lane: Lane) -> Iterator[pd.DataFrame]:
        # one timer a lane, for the lease that ends first
        if first := lane.leased.first():
            self.handle.registerTimer(first[0] // 1000 + 1)
        lane.flush()
        if lane.out:
            yield pd.DataFrame([(key[0], *x) for x in lane.out], columns=[c.split()[0] for c in EVENT.split(", ")])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        lane = Lane(_States(self.state))
        frame = pd.concat(list(rows)).sort_values(["ts", "seq"], kind="stable")
        null = lambda x: None if pd.isna(x) else x
        whole = lambda x, other: other if pd.isna(x) else int(x)
        for r in frame.itertuples(index=False):
            lane.apply(int(r.ts.value) // 1000, r.command, whole(r.job_id, None), whole(r.priority, 100), null(r.worker), 0.0 if pd.isna(r.seconds) else float(r.seconds), whole(r.most, 3))
        yield from self._rows(key, lane)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # all leases that a timer of their own would have ended by now: those whose next millisecond is before the watermark
        lane = Lane(_States(self.state))
        lane.reclaim(max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1) * 1000)
        yield from self._rows(key, lane)

    def close(self) -> None:
        pass


def lease_log(commands: DataFrame, late: str = "0 seconds") -> DataFrame:
    """STM-01 ... STM-06 of a stream of commands (COMMAND): the queue's event log: lane, job_id, us (microseconds), event,
    worker, attempts.

    enqueue (once per job; force resets it), lease (the first by priority and id, for max(30, seconds)), heartbeat and
    complete (by the worker that holds the lease only), fail (retried after seconds until `most` leases were used). A lease
    that ended is logged at its end, by the lane's next command or by a timer once the watermark is past it. Commands more
    than `late` behind the watermark are dropped. A batch's commands of one lane are held in memory. Needs the RocksDB state
    store (spark.sql.streaming.stateStore.providerClass)."""
    own = commands.withWatermark("ts", late)
    return own.groupBy("lane").transformWithStateInPandas(LeaseQueue(), EVENT, "append", "eventTime")


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_in_order(commands: DataFrame, folder: str, parts: int = 4) -> str:
    """Commands as files of `parts` spans of time, one span after the other, each file with all of a span's commands of some
    lanes; a stream that reads them in order meets every lane's commands in order. Gives the span, for lease_log's late."""
    t = F.unix_micros("ts")
    low, high = commands.agg(F.min(t), F.max(t)).first()
    span = max(1, -(-((high or 0) - (low or 0)) // (parts * 1_000_000)))
    commands = commands.withColumn("part", F.floor((t - F.lit(low or 0)) / F.lit(span * 1_000_000)))
    for i in range(parts + 1):
        commands.where(F.col("part") == i).drop("part").repartition("lane").write.mode("append").parquet(folder)
    return f"{span} seconds"

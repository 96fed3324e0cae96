"""Versioned tables: a log of commits beside the data, rebuilds that supersede, and a way back (TXT-13).

A version's rows are written under a folder of their own and never touched again. A commit is one small file
`log/<number>`, created only if it does not exist: of two writers that start from one head, the second fails and its rows go.
The head is the highest complete entry, so readers see the old version until the commit and the new one after it, and a
rebuild that fails at any point leaves the head as it was. Needs a store whose create fails where the file exists (HDFS,
local disks, object stores with conditional writes)."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ConflictError(RuntimeError):
    """Another writer committed first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _put(self, path: str, text: str) -> None:
        """Creates the file; ConflictError if there is one."""
        if self.fs.exists(self._path(path)):
            raise ConflictError(path)
        try:
            out = self.fs.create(self._path(path), False)
        except Exception as e:
            if "AlreadyExists" in str(e) or "already exists" in str(e):
                raise ConflictError(path) from e
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def history(self) -> list[dict]:
        """The log's entries in order. An entry that is still being written does not count yet."""
        folder = self._path(f"{self.root}/log")
        if not self.fs.exists(folder):
            return []
        names = sorted(f.getPath().toString() for f in self.fs.listStatus(folder) if f.getPath().getName()[:1].isdigit())
        texts = dict(self.spark.sparkContext.wholeTextFiles(",".join(names)).collect()) if names else {}
        found = []
        for _, text in sorted(texts.items(), key=lambda x: x[0].rsplit("/", 1)[1]):
            try:
                found.append(json.loads(text))
            except ValueError:
                break
        return found

    def head(self) -> dict | None:
        return next((e for e in reversed(self.history()) if e["state"] == "committed"), None)

    def read(self, batch_id: str | None = None) -> DataFrame:
        """The head's rows, or those of a batch, superseded or not."""
        entry = self.head() if batch_id is None else next((e for e in self.history() if e["batch_id"] == batch_id and e["state"] == "committed"), None)
        if entry is None:
            raise KeyError(batch_id or "no version yet")
        return self.spark.read.parquet(f"{self.root}/{entry['data']}")

    def _append(self, number: int, entry: dict) -> dict:
        self._put(f"{self.root}/log/{number:010d}", json.dumps(entry | {"number": number}))
        return entry | {"number": number}

    def rebuild(self, batch_id: str, build, reason: str = "extractor_rules_rebuild", check=None) -> dict:
        """Writes build()'s rows as a new version and makes it the head, superseding the active one. check: takes the rows as
        written and raises where they are not right. If anything fails, the rows go, the failure is logged where the log
        allows it, the head stays, and the error is raised again."""
        past = self.history()
        active = next((e for e in reversed(past) if e["state"] == "committed"), None)
        data = f"data/{uuid.uuid4().hex}"
        entry = {"batch_id": batch_id, "data": data, "reason": reason, "supersedes": active and active["batch_id"], "at": time.time()}
        try:
            build().write.parquet(f"{self.root}/{data}")
            rows = self.spark.read.parquet(f"{self.root}/{data}")
            if check:
                check(rows)
            return self._append(len(past), entry | {"state": "committed", "rows": rows.count()})
        except BaseException as e:
            self.fs.delete(self._path(f"{self.root}/{data}"), True)
            if not isinstance(e, ConflictError):
                try:
                    self._append(len(past), entry | {"state": "failed", "supersedes": None, "rows": 0, "error": str(e).splitlines()[0][:500]})
                except ConflictError:
                    pass
            raise

    def restore(self, batch_id: str, reason: str = "restored") -> dict:
        """Makes an earlier version the head again, by a commit of its own; no rows are written."""
        past = self.history()
        old = next(e for e in past if e["batch_id"] == batch_id and e["state"] == "committed")
        active = next(e for e in reversed(past) if e["state"] == "committed")
        return self._append(len(past), old | {"reason": reason, "supersedes": active["batch_id"], "at": time.time()})

    def runs(self) -> DataFrame:
        """number, batch_id, state (active, superseded or failed), superseded_by, reason, rows: one row per entry."""
        past = self.history()
        head = self.head()
        by = {e["supersedes"]: e["batch_id"] for e in past if e["state"] == "committed" and e["supersedes"]}
        state = lambda e: "failed" if e["state"] == "failed" else "active" if head and e["number"] == head["number"] else "superseded"
        rows = [(e["number"], e["batch_id"], state(e), by.get(e["batch_id"]) if state(e) == "superseded" else None, e["reason"], e["rows"]) for e in past]
        return self.spark.createDataFrame(rows, "number int, batch_id string, state string, superseded_by string, reason string, rows long")


class BatchLedger(VersionedTable):
    """Rows of a stream's batches, each batch once (STM-08): a batch's rows are written to a folder of their own, and then
    its number's entry in the log names the folder. A batch that comes again after its entry changes nothing; one that failed
    before it is written anew, and what it left is read by nobody. One stream writes at a time."""

    def entry(self, number: int) -> dict | None:
        return next((e for e in self.history() if e["number"] == number), None)

    def _drop_unfinished(self, number: int) -> None:
        path = self._path(f"{self.root}/log/{number:010d}")
        if self.fs.exists(path) and self.entry(number) is None:
            self.fs.delete(path, False)

    def rows(self, schema=None) -> DataFrame | None:
        """All rows of finished batches; without any, an empty table of the schema, or None."""
        folders = [f"{self.root}/{e['data']}" for e in self.history()]
        if folders:
            return self.spark.read.schema(schema or self.spark.read.parquet(folders[0]).schema).parquet(*folders)
        return None if schema is None else self.spark.createDataFrame([], schema)

    def once(self, batch: DataFrame, number: int, keys: list[str]) -> bool:
        """Adds the batch's rows whose keys (null is a key like any other) no earlier row has; of equal keys in the batch one
        row stays. False, and nothing is done, if the batch is in the ledger."""
        if self.entry(number) is not None:
            return False
        self._drop_unfinished(number)
        fresh, past = batch.dropDuplicates(keys), self.rows(batch.schema)
        same = None
        for k in keys:
            c = F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}"))
            same = c if same is None else same & c
        fresh = fresh.alias("x").join(past.select(*keys).distinct().alias("y"), same, "left_anti")
        data = f"data/{number:010d}-{uuid.uuid4().hex}"
        fresh.write.parquet(f"{self.root}/{data}")
        self._append(number, {"batch_id": str(number), "data": data, "state": "committed", "supersedes": None, "at": time.time()})
        return True


def ledger_sink(root: str, keys: list[str], prepare=None):
    """A foreachBatch function that adds prepare(batch) to the ledger at root."""

    def sink(batch: DataFrame, number: int) -> None:
        BatchLedger(batch.sparkSession, root).once(prepare(batch) if prepare else batch, number, keys)

    return sink

"""Streams: incremental ingest, windows with watermarks, sessions, the job queue (STM-*)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.mentions import iterate_texts


def read_events(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per window and kind; rows later than `late` go, and state goes with them."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.unix_micros("w.start").alias("w"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.unix_micros("w.start").alias("s"), F.unix_micros("w.end").alias("e"), "n")


def distinct_jobs(jobs: DataFrame, late: str = "1 day") -> DataFrame:
    """STM-01: each job_key once, among those that arrive within `late`."""
    return jobs.withWatermark("ts", late).dropDuplicatesWithinWatermark(["job_key"])


def ingest(spark: SparkSession, segments: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """STM-08: names of new segments (seg_id, text), each file once; what is there now is processed and the query ends."""
    found = segments.select("seg_id", "text").mapInPandas(iterate_texts, "seg_id string, surface string, signal string")
    return found.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_now(df: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there and gives its rows, from a table in the folder. It waits for the end, however
    long, and raises what the stream raises. A batch that is run again replaces its own rows."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/{number if mode == 'append' else 0:09d}")

    df.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).option("recursiveFileLookup", True).parquet(f"{folder}/out")


JOB = "job_id string, state string, attempts int, expires double, at double"


def job_states(log: DataFrame, most: int = 3) -> DataFrame:
    """STM-02 ... STM-05, batch: the state of each job by its log (job_id, seq, event, at, seconds, worker).

    The last event decides; a lease lasts max(30, seconds); a failure waits for a retry until `most` leases were used."""
    last = log.groupBy("job_id").agg(F.max_by(F.struct("event", "at", "seconds"), "seq").alias("l"), F.count_if(F.col("event") == "lease").alias("attempts"))
    e = F.col("l.event")
    state = F.when(e == "enqueue", "queued").when(e.isin("lease", "heartbeat"), "leased").when(e == "complete", "done").when((e == "fail") & (F.col("attempts") < most), "queued").when(e == "fail", "failed").otherwise("queued")
    expires = F.when(e.isin("lease", "heartbeat"), F.col("l.at") + F.greatest(F.lit(30.0), F.col("l.seconds")))
    return last.select("job_id", state.alias("state"), "attempts", expires.alias("expires"), F.col("l.at").alias("at"))


def reclaim(states: DataFrame, now: float) -> DataFrame:
    """STM-03, STM-06: leases that ran out go back to the queue, one attempt returned."""
    gone = (F.col("state") == "leased") & (F.col("expires") < now)
    return states.withColumns({"state": F.when(gone, "queued").otherwise(F.col("state")), "attempts": F.when(gone, F.greatest(F.lit(0), F.col("attempts") - 1)).otherwise(F.col("attempts")), "expires": F.when(~gone, F.col("expires"))})


def next_jobs(jobs: DataFrame, states: DataFrame) -> DataFrame:
    """SRT-07: the first queued job of each lane by priority and id."""
    q = jobs.join(states.where("state = 'queued'").select("job_id"), "job_id", "left_semi")
    return q.groupBy("lane").agg(F.min_by("job_id", F.struct("priority", "job_id")).alias("job_id"))


def fan_in(jobs: DataFrame, states: DataFrame) -> DataFrame:
    """STM-07: parents all of whose children are done."""
    j = jobs.join(states.select("job_id", "state"), "job_id", "left")
    return j.groupBy("parent_id").agg(F.countDistinct("job_id").alias("total"), F.count_if(F.col("state") == "done").alias("done")).where("total = done")


def queue_listing(states: DataFrame, limit: int = 100) -> DataFrame:
    """SRT-08."""
    return states.orderBy(F.desc("job_id")).limit(min(limit, 1000))


def resume(items: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """STM-10: items without a result."""
    return items.join(results.select(key), key, "left_anti")


def drop_stale(rows: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """SET-09."""
    return rows.join(current.select(key), key, "left_semi")


def latest_snapshot(df: DataFrame, before: str | None = None) -> DataFrame:
    """WIN-14: rows of the greatest snapshot_id, or of the greatest before a given one."""
    d = df if before is None else df.where(F.col("snapshot_id") < before)
    return d.join(d.agg(F.max("snapshot_id").alias("snapshot_id")), "snapshot_id")

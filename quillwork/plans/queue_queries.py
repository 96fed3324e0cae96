"""The lease queue as a stream and the versioned rebuild, both over whole events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import shared_root
from ..sources.versions import BatchLedger, VersionedTable, ledger_sink
from ..streaming import leases, streams
from .base import duck, made, table
from .registry import register

#: Every event as a command of one of 40 lanes.
COMMANDS = """SELECT 'L' || CAST(user_id % 40 AS STRING) AS lane, event_id AS seq, ts,
CASE event_id % 6 WHEN 0 THEN 'enqueue' WHEN 1 THEN 'enqueue' WHEN 2 THEN 'lease' WHEN 3 THEN 'lease' WHEN 4 THEN (CASE WHEN event_id % 4 = 0 THEN 'heartbeat' ELSE 'complete' END) ELSE (CASE WHEN CAST(floor(event_id / 6) AS BIGINT) % 3 = 0 THEN 'force' ELSE 'fail' END) END AS command,
CASE WHEN event_id % 6 = 0 THEN event_id WHEN event_id % 6 = 1 THEN event_id - CASE WHEN CAST(floor(event_id / 6) AS BIGINT) % 4 = 0 THEN 1 ELSE 0 END WHEN event_id % 6 = 5 AND CAST(floor(event_id / 6) AS BIGINT) % 3 = 0 THEN event_id - 5 END AS job_id,
CAST(CAST(floor(event_id / 2) AS BIGINT) % 3 AS INT) AS priority, 'w' || CAST(CAST(floor(event_id / 6) AS BIGINT) % 2 AS STRING) AS worker, CAST(CAST(floor(event_id / 7) AS BIGINT) % 5 * 7200 AS DOUBLE) AS seconds, CAST(2 AS INT) AS most FROM {events}"""

#: DuckDB's fold: one recursion step takes one command of every lane; all jobs of a lane are a list.
FOLD = duck(cmd=COMMANDS).replace("WITH", "WITH RECURSIVE", 1) + """, c AS (SELECT lane, epoch_us(ts) AS t, command, job_id, priority, worker, (greatest(30, seconds) * 1000000)::BIGINT AS hold, (seconds * 1000000)::BIGINT AS delay, most, row_number() OVER (PARTITION BY lane ORDER BY ts, seq) AS n FROM cmd),
span AS (SELECT greatest(1, ceil((max(epoch_us(ts)) - min(epoch_us(ts))) / 4000000.0))::BIGINT AS s, max(epoch_us(ts)) AS high FROM cmd),
st(lane, n, jobs, ws, out) AS (
SELECT DISTINCT lane, 0::BIGINT, []::STRUCT(id BIGINT, pri INTEGER, state VARCHAR, attempts INTEGER, most INTEGER, worker VARCHAR, until BIGINT, avail BIGINT)[], []::STRUCT(worker VARCHAR, id BIGINT)[],
  []::STRUCT(job_id BIGINT, us BIGINT, event VARCHAR, worker VARCHAR, attempts INTEGER)[] FROM cmd
UNION ALL
SELECT lane, n,
  CASE WHEN command = 'enqueue' AND x IS NOT NULL OR pick IS NULL AND command = 'lease' OR x IS NULL AND command NOT IN ('enqueue', 'force', 'lease') OR command IN ('heartbeat', 'complete') AND NOT own THEN j
  ELSE list_append(list_filter(j, lambda y: y.id <> coalesce(pick, target)), CASE command
    WHEN 'lease' THEN struct_pack(id := x.id, pri := x.pri, state := 'leased', attempts := x.attempts + 1, most := x.most, worker := worker, until := t + hold, avail := x.avail)
    WHEN 'heartbeat' THEN struct_pack(id := x.id, pri := x.pri, state := 'leased', attempts := x.attempts, most := x.most, worker := worker, until := t + hold, avail := x.avail)
    WHEN 'complete' THEN struct_pack(id := x.id, pri := x.pri, state := 'done', attempts := x.attempts, most := x.most, worker := worker, until := 0, avail := x.avail)
    WHEN 'fail' THEN struct_pack(id := x.id, pri := x.pri, state := CASE WHEN x.attempts < x.most THEN 'queued' ELSE 'failed' END, attempts := x.attempts, most := x.most, worker := NULL, until := 0, avail := t + delay)
    ELSE struct_pack(id := target, pri := priority, state := 'queued', attempts := 0, most := most, worker := NULL, until := 0, avail := t) END) END,
  CASE WHEN command = 'lease' AND pick IS NOT NULL THEN list_append(list_filter(ws, lambda y: y.worker <> z.worker), struct_pack(worker := worker, id := pick)) ELSE ws END,
  list_concat(gone, CASE
    WHEN command = 'enqueue' AND x IS NULL THEN [struct_pack(job_id := target, us := t, event := 'enqueued', worker := NULL, attempts := 0)]
    WHEN command = 'force' THEN [struct_pack(job_id := target, us := t, event := CASE WHEN x IS NULL THEN 'enqueued' ELSE 'requeued_force' END, worker := NULL, attempts := 0)]
    WHEN command = 'lease' AND pick IS NOT NULL THEN [struct_pack(job_id := pick, us := t, event := 'leased', worker := worker, attempts := x.attempts + 1)]
    WHEN command = 'complete' AND own THEN [struct_pack(job_id := x.id, us := t, event := 'completed', worker := worker, attempts := x.attempts)]
    WHEN command = 'fail' AND x IS NOT NULL THEN [struct_pack(job_id := x.id, us := t, event := CASE WHEN x.attempts < x.most THEN 'retry_scheduled' ELSE 'failed' END, worker := worker, attempts := x.attempts)] ELSE [] END)
FROM (SELECT *, coalesce(x.state = 'leased' AND x.worker = worker, false) AS own FROM (SELECT *, list_filter(j, lambda y: y.id = coalesce(pick, target))[1] AS x FROM (
  SELECT *, CASE WHEN command = 'lease' THEN list_min(list_transform(list_filter(j, lambda y: y.state = 'queued' AND y.avail <= q.t), lambda y: struct_pack(p := y.pri, i := y.id))).i END AS pick,
    CASE WHEN command <> 'lease' THEN coalesce(job_id, list_filter(ws, lambda y: y.worker = q.worker)[1].id) END AS target
  FROM (SELECT st.lane, c.n, c.t, command, job_id, priority, c.worker, hold, delay, c.most, ws,
    list_transform(list_filter(jobs, lambda y: y.state = 'leased' AND y.until < c.t), lambda y: struct_pack(job_id := y.id, us := y.until, event := 'lease_expired', worker := y.worker, attempts := y.attempts)) AS gone,
    list_transform(jobs, lambda y: CASE WHEN y.state = 'leased' AND y.until < c.t THEN struct_pack(id := y.id, pri := y.pri, state := 'queued', attempts := y.attempts, most := y.most, worker := NULL, until := 0, avail := y.until) ELSE y END) AS j
    FROM st JOIN c ON c.lane = st.lane AND c.n = st.n + 1) q))) z),
ends AS (SELECT lane, unnest(arg_max(jobs, n)) AS y FROM st GROUP BY lane),
late AS (SELECT lane, y.id AS job_id, y.until AS us, 'lease_expired' AS event, y.worker AS worker, y.attempts AS attempts FROM ends, span WHERE y.state = 'leased' AND y.until // 1000 + 1 < high // 1000 - s * 1000)
SELECT lane, o.job_id, o.us, o.event, o.worker, o.attempts FROM (SELECT lane, unnest(out) AS o FROM st) UNION ALL SELECT * FROM late"""


@register("lease_stream", FOLD)
def lease_stream(spark: SparkSession, d: str) -> DataFrame:
    """STM-01 ... STM-06: the queue's log, from commands that a stream reads in several batches."""
    folder = f"{shared_root(spark)}/lease-stream-{uuid.uuid4().hex}"
    commands = made(spark, d, COMMANDS).withColumn("ts", F.col("ts").cast("timestamp"))
    span = leases.write_in_order(commands, f"{folder}/in")
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, leases.ROCKS)
    try:
        return streams.run_now(leases.lease_log(streams.read_events(spark, f"{folder}/in", 4), span), folder)
    finally:
        spark.conf.set(store, before)


@register("versioned_rebuild", """WITH v AS (SELECT 'R1' AS batch_id, event_type AS surface, user_id, epoch_us(ts) AS us FROM events UNION ALL SELECT 'R2', upper(event_type), user_id, epoch_us(ts) FROM events WHERE value >= 1),
r(number, batch_id, state, superseded_by, reason) AS (VALUES (0, 'R1', 'superseded', 'R2', 'first'), (1, 'R2', 'superseded', 'R1', 'rules'), (2, 'R3', 'failed', NULL, 'rules'), (3, 'R1', 'active', NULL, 'restored'))
SELECT number::INTEGER AS number, r.batch_id, state, superseded_by, reason, surface, count(user_id) AS mentions, count(DISTINCT user_id) AS contents, min(us) AS first_at, max(us) AS last_at FROM r LEFT JOIN v ON v.batch_id = r.batch_id GROUP BY ALL""")
def versioned_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """TXT-13: the index of all events is built, rebuilt under new rules, fails once and is restored; every run's own rows
    stay readable, and while the third run fails the second one's are read."""
    table = VersionedTable(spark, f"{shared_root(spark)}/index-{uuid.uuid4().hex}")
    events = made(spark, d, "SELECT event_id, event_type, user_id, value, ts FROM {events}")
    index = lambda rows, surface: rows.groupBy(surface.alias("surface")).agg(F.count(F.lit(1)).alias("mentions"), F.countDistinct("user_id").alias("contents"), F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("first_at"), F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("last_at"))
    table.rebuild("R1", lambda: index(events, F.col("event_type")), "first")
    table.rebuild("R2", lambda: index(events.where("value >= 1"), F.upper("event_type")), "rules")

    def refuse(rows: DataFrame) -> None:
        if rows.where("mentions > 0").count():
            raise ValueError("an index that must not be published")

    try:
        table.rebuild("R3", lambda: index(events, F.lit("all")), "rules", refuse)
        raise AssertionError("a refused rebuild was committed")
    except ValueError:
        if table.head()["batch_id"] != "R2":
            raise
    table.restore("R1")
    runs = table.runs().drop("rows")
    rows = [table.read(b).withColumn("batch_id", F.lit(b)) for b in ("R1", "R2")]
    return runs.join(rows[0].unionByName(rows[1]), "batch_id", "left").withColumn("mentions", F.coalesce("mentions", F.lit(0))).withColumn("contents", F.coalesce("contents", F.lit(0)))


@register("ledger_ingest", """WITH v AS (SELECT *, sha256(coalesce(text, '')) AS sha FROM documents)
SELECT doc_id, sha, max(length(text)) AS n_chars, 1::BIGINT AS times FROM v GROUP BY doc_id, sha""")
def ledger_ingest(spark: SparkSession, d: str) -> DataFrame:
    """STM-08: all documents as a stream of several batches into a ledger, keyed by id and digest. A part comes twice under
    other file names; the sink fails once after a batch's entry, so the restarted stream repeats that batch."""
    folder = f"{shared_root(spark)}/ledger-{uuid.uuid4().hex}"
    docs = table(spark, d, "documents").select("doc_id", "text")
    files = max(4, docs.rdd.getNumPartitions())  # of a split each, however many there are
    docs.repartition(files, "doc_id").write.parquet(f"{folder}/in")
    docs.where("doc_id % 3 = 0").repartition(-(-files // 2), "doc_id").write.mode("append").parquet(f"{folder}/in")
    prepare = lambda rows: rows.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), F.length("text").cast("long").alias("n_chars"))
    add, broken = ledger_sink(f"{folder}/ledger", ["doc_id", "sha"], prepare), []

    def sink(batch: DataFrame, number: int) -> None:
        add(batch, number)
        if number == 1 and not broken:
            broken.append(number)
            raise RuntimeError("after the entry, before the stream's own")

    def run() -> None:
        streams.read_events(spark, f"{folder}/in", files // 2).writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    try:
        run()
    except Exception as e:
        if not broken or "after the entry" not in str(e):
            raise
    run()
    rows = BatchLedger(spark, f"{folder}/ledger").rows()
    return rows.groupBy("doc_id", "sha").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("times"))

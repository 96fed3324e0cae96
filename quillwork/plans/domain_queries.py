"""Queries over the domain operators: mentions, captions, attribution, review views, queue and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import attribution, mentions
from ..operators.graph import saved
from ..streaming import streams
from .base import duck, made, micros, table
from .registry import register
from .text_queries import sentence_rows


def segments(spark: SparkSession, d: str) -> DataFrame:
    s = sentence_rows(table(spark, d, "documents"))
    return s.select(F.concat_ws("-", "doc_id", "idx").alias("seg_id"), F.col("doc_id").cast("string").alias("content_id"), F.lit("text").alias("source_type"), F.col("source").alias("speaker_id"), F.col("sentence").alias("text"))


def known(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary of all capitalised words of the benchmark texts."""
    words = table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("name")).where(F.col("name").rlike("^[A-Z][a-z]{3,}$")).distinct()
    ents = words.select(X.stable_id("E_", F.col("name")).alias("id"), "name", F.lit("term").alias("type"))
    return mentions.known_aliases(ents, ents.select(F.col("id").alias("canonical_id"), F.lower("name").alias("alias")))


@register("mention_candidates")
def mention_candidates(spark: SparkSession, d: str) -> DataFrame:
    """AGG-01. TXT-06 ... TXT-12, AGG-01."""
    out = mentions.candidates(mentions.evidence(segments(spark, d)), known(spark, d))
    return out.select("candidate_key", "display", "kind", "mentions", "contents", "score", "priority")


@register("alias_mentions")
def alias_mentions(spark: SparkSession, d: str) -> DataFrame:
    """JON-23, SET-02. TXT-04."""
    return mentions.alias_mentions(segments(spark, d), known(spark, d)).select("seg_id", "word_no", "surface", "canonical_id")


@register("resolution_queue")
def resolution_queue(spark: SparkSession, d: str) -> DataFrame:
    """JON-22, SRT-05, STR-09. TXT-15: part names against the names of all parts."""
    p = table(spark, d, "part")
    m = p.select(F.col("p_name").alias("surface"), F.col("p_brand").alias("content_id"), F.lit("part").alias("entity_type"), F.col("p_partkey").cast("int").alias("seq"))
    n = p.select(F.col("p_partkey").cast("string").alias("entity_id"), F.col("p_name").alias("name"))
    return mentions.resolution_queue(m, n).select("key", "mentions", "contents", F.size(F.coalesce("candidates", F.expr("cast(array() as array<struct<rank:int,entity_id:string,sim:double>>)"))).alias("found"))


def cues(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as rolling captions: each turn begins with the last words of the one before."""
    t = table(spark, d, "conversations")
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    last = F.array_join(F.slice(F.split(F.coalesce(before, F.lit("")), " "), -5, 5), " ")
    text = F.trim(F.concat_ws(" ", F.when(F.size(F.split(F.coalesce(before, F.lit("")), " ")) >= 5, last), "text"))
    return t.select(F.col("conv_id").cast("string").alias("content_id"), F.col("turn").alias("cue_index"), (F.col("turn") * 4.0).alias("start"), (F.col("turn") * 4.0 + 3.5).alias("end"), text.alias("text"))


@register("caption_fold")
def caption_fold(spark: SparkSession, d: str) -> DataFrame:
    """WIN-03, WIN-07. TXT-02."""
    return attribution.caption_fold(cues(spark, d))


@register("dense_attribution", """WITH c AS (SELECT conv_id::VARCHAR AS content_id, turn AS cue_index, turn * 4.0 AS s, turn * 4.0 + 3.5 AS e FROM conversations),
g AS (SELECT conv_id::VARCHAR AS content_id, role AS speaker, turn * 4.0 - 0.5 AS s, turn * 4.0 + 3.0 AS e FROM conversations),
o AS (SELECT c.content_id, c.cue_index, c.e - c.s AS dur, speaker, sum(least(c.e, g.e) - greatest(c.s, g.s)) AS m FROM c JOIN g ON c.content_id = g.content_id AND least(c.e, g.e) > greatest(c.s, g.s) GROUP BY 1, 2, 3, 4),
r AS (SELECT *, sum(m) OVER w AS total, row_number() OVER (PARTITION BY content_id, cue_index ORDER BY m DESC, speaker) AS k FROM o WINDOW w AS (PARTITION BY content_id, cue_index)),
b AS (SELECT content_id, cue_index, max(CASE WHEN k = 1 THEN speaker END) AS speaker, max(CASE WHEN k = 1 THEN m / total END) AS f, coalesce(max(CASE WHEN k = 2 THEN m / total END), 0) AS s, least(1.0, max(total) / max(dur)) AS cov FROM r GROUP BY 1, 2)
SELECT content_id, cue_index, speaker, round(f, 6) AS first_share, round(cov, 6) AS coverage, CASE WHEN cov < 0.35 THEN 'NO_SPEECH_MATCH' WHEN f >= 0.8 AND s <= 0.2 THEN 'ATTRIBUTED_HIGH' WHEN f >= 0.65 AND s <= 0.35 THEN 'ATTRIBUTED_MEDIUM' ELSE 'AMBIGUOUS' END AS status FROM b""")
def dense_attribution(spark: SparkSession, d: str) -> DataFrame:
    """AGG-12, WIN-02, JON-06. VOI-01."""
    t = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("content_id"), F.col("turn").alias("cue_index"), "role")
    c = t.select("content_id", "cue_index", (F.col("cue_index") * 4.0).alias("start"), (F.col("cue_index") * 4.0 + 3.5).alias("end"))
    g = t.select("content_id", F.col("role").alias("speaker"), (F.col("cue_index") * 4.0 - 0.5).alias("seg_start"), (F.col("cue_index") * 4.0 + 3.0).alias("seg_end"))
    out = attribution.dense(c, g)
    return out.select("content_id", "cue_index", "speaker", F.round("first_share", 6).alias("first_share"), F.round("coverage", 6).alias("coverage"), "status")


LOG = "CASE event_type WHEN 'signup' THEN 'enqueue' WHEN 'view' THEN 'lease' WHEN 'click' THEN 'heartbeat' WHEN 'purchase' THEN 'complete' ELSE 'fail' END"


@register("job_states", f"""WITH l AS (SELECT user_id::VARCHAR AS job_id, event_id, {LOG} AS ev, epoch_us(ts) / 1e6 AS at FROM events), g AS (SELECT job_id, arg_max(ev, event_id) AS ev, count(*) FILTER (WHERE ev = 'lease') AS attempts FROM l GROUP BY 1)
SELECT job_id, attempts, CASE WHEN ev = 'enqueue' THEN 'queued' WHEN ev IN ('lease', 'heartbeat') THEN 'leased' WHEN ev = 'complete' THEN 'done' WHEN attempts < 3 THEN 'queued' ELSE 'failed' END AS state FROM g""")
def job_states(spark: SparkSession, d: str) -> DataFrame:
    """STM-02 ... STM-05."""
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("job_id"), F.col("event_id").alias("seq"), F.expr(LOG).alias("event"), (micros() / 1e6).alias("at"), F.lit(60.0).alias("seconds"))
    return streams.job_states(e).select("job_id", "attempts", "state")


@register("watermark_stream", "SELECT epoch_us(time_bucket(INTERVAL '1 hour', ts)) AS w, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def watermark_stream(spark: SparkSession, d: str) -> DataFrame:
    """Section 2.11: windowed counts of events as a stream over what is there now."""
    src = saved(table(spark, d, "events"), "stream-in")
    path = src.inputFiles()[0].rsplit("/", 1)[0]
    return streams.run_now(streams.windowed_counts(streams.read_events(spark, path), late="60 days"), f"{path}-run", "complete")


JOBS = "SELECT 'J' || CAST(event_id % 300 AS STRING) AS job_key, ts, event_id FROM {events}"


@register("distinct_jobs", "SELECT DISTINCT 'J' || (event_id % 300) AS job_key FROM events")
def distinct_jobs(spark: SparkSession, d: str) -> DataFrame:
    """STM-01: enqueued again, a job stays one; a stream over what is there now."""
    src = saved(made(spark, d, JOBS).withColumn("ts", F.col("ts").cast("timestamp")), "jobs-in")
    path = src.inputFiles()[0].rsplit("/", 1)[0]
    return streams.run_now(streams.distinct_jobs(streams.read_events(spark, path), "60 days"), f"{path}-run").select("job_key")


STATES = """SELECT 'J' || CAST(event_id AS STRING) AS job_id, CASE event_id % 5 WHEN 0 THEN 'queued' WHEN 1 THEN 'leased' WHEN 2 THEN 'done' WHEN 3 THEN 'failed' ELSE 'leased' END AS state, CAST(event_id % 4 AS INT) AS attempts, CAST(event_id AS DOUBLE) AS expires, CAST(event_id AS DOUBLE) AS at FROM {events}"""
LANES = "SELECT 'J' || CAST(event_id AS STRING) AS job_id, event_type AS lane, CAST(event_id % 7 AS INT) AS priority, 'P' || CAST(event_id % 50 AS STRING) AS parent_id FROM {events} WHERE event_id % 5 < 3"


@register("reclaimed_jobs", f"""{duck(s=STATES)} SELECT job_id, CASE WHEN state = 'leased' AND expires < 500 THEN 'queued' ELSE state END AS state, CASE WHEN state = 'leased' AND expires < 500 THEN greatest(0, attempts - 1) ELSE attempts END AS attempts FROM s""")
def reclaimed_jobs(spark: SparkSession, d: str) -> DataFrame:
    """STM-03, STM-06."""
    return streams.reclaim(made(spark, d, STATES), 500.0).select("job_id", "state", "attempts")


@register("next_jobs", f"""{duck(s=STATES, l=LANES)} SELECT lane, arg_min(l.job_id, (priority, l.job_id)) AS job_id FROM l JOIN s ON l.job_id = s.job_id AND s.state = 'queued' GROUP BY 1""")
def next_jobs(spark: SparkSession, d: str) -> DataFrame:
    """SRT-07, STM-02."""
    return streams.next_jobs(made(spark, d, LANES), made(spark, d, STATES))


@register("fan_in", f"""{duck(s=STATES, l=LANES)} SELECT parent_id, count(DISTINCT l.job_id) AS total, count(*) FILTER (WHERE state = 'done') AS done FROM l LEFT JOIN s USING (job_id) GROUP BY 1 HAVING total = done""")
def fan_in(spark: SparkSession, d: str) -> DataFrame:
    """STM-07."""
    return streams.fan_in(made(spark, d, LANES), made(spark, d, STATES))


@register("queue_page", f"""{duck(s=STATES)} SELECT job_id, state FROM s ORDER BY job_id DESC LIMIT 50""")
def queue_page(spark: SparkSession, d: str) -> DataFrame:
    """SRT-08, SRT-06: a page of the listing, which is the feature."""
    return streams.queue_listing(made(spark, d, STATES), 50).select("job_id", "state")


@register("resumed_items", f"""{duck(s=STATES, l=LANES)} SELECT job_id FROM s WHERE job_id NOT IN (SELECT job_id FROM l)""")
def resumed_items(spark: SparkSession, d: str) -> DataFrame:
    """STM-10, STM-08."""
    return streams.resume(made(spark, d, STATES), made(spark, d, LANES), "job_id").select("job_id")


@register("stale_rows", f"""{duck(s=STATES, l=LANES)} SELECT job_id FROM s WHERE job_id IN (SELECT job_id FROM l)""")
def stale_rows(spark: SparkSession, d: str) -> DataFrame:
    """SET-09: rows whose file is still there."""
    return streams.drop_stale(made(spark, d, STATES), made(spark, d, LANES), "job_id").select("job_id")


SNAPS = "SELECT 's' || CAST(event_id % 9 AS STRING) AS snapshot_id, event_id AS node FROM {events}"


@register("latest_snapshot", f"""{duck(s=SNAPS)} SELECT snapshot_id, node FROM s WHERE snapshot_id = (SELECT max(snapshot_id) FROM s WHERE snapshot_id < 's7')""")
def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """WIN-14: the snapshot before a given one."""
    return streams.latest_snapshot(made(spark, d, SNAPS), "s7")

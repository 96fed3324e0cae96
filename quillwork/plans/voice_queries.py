"""Queries over speakers and voices: attribution, sampling, matching, identity. Inputs as in review_queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attribution as A
from ..operators import vectors as V
from .base import duck, made
from .registry import register

CENTRES = "SELECT 'V' || CAST(user_id % 5 AS STRING) AS content_id, event_id AS cue_index, CAST(event_id * 2 AS DOUBLE) AS t FROM {events}"
SAMPLES = "SELECT 'V' || CAST(user_id % 5 AS STRING) AS content_id, event_id AS sample_cue, CAST(event_id * 2 AS DOUBLE) AS t, 'v' || CAST(event_id % 7 % 2 AS STRING) AS voice FROM {events} WHERE event_id % 9 = 0 AND user_id % 5 < 4"


@register("sparse_attribution", f"""{duck(c=CENTRES, s=SAMPLES)}, p AS (SELECT c.*, s.t AS pt, s.voice AS pv, s.sample_cue AS pc FROM c ASOF LEFT JOIN s ON c.content_id = s.content_id AND c.t >= s.t),
n AS (SELECT c.content_id, c.cue_index, s.t AS nt, s.voice AS nv, s.sample_cue AS nc FROM c ASOF LEFT JOIN s ON c.content_id = s.content_id AND c.t <= s.t),
b AS (SELECT p.*, nt, nv, nc, coalesce(p.t - pt, 1e18) AS back, coalesce(nt - p.t, 1e18) AS ahead FROM p JOIN n USING (content_id, cue_index)),
m AS (SELECT *, CASE WHEN pt IS NULL AND nt IS NULL THEN 'sparse_no_sample' WHEN (CASE WHEN back <= ahead THEN pc ELSE nc END) = cue_index THEN 'sparse_exact_sample' WHEN pv = nv AND back <= 150 AND ahead <= 150 THEN 'sparse_same_voice_bracket'
WHEN pv <> nv THEN 'sparse_conflicting_bracket' WHEN least(back, ahead) <= 60 THEN 'sparse_nearest' ELSE 'sparse_sample_too_distant' END AS method FROM b)
SELECT content_id, cue_index, t, CASE method WHEN 'sparse_same_voice_bracket' THEN pv WHEN 'sparse_exact_sample' THEN (CASE WHEN back <= ahead THEN pv ELSE nv END) WHEN 'sparse_nearest' THEN (CASE WHEN back <= ahead THEN pv ELSE nv END) END AS voice,
CASE method WHEN 'sparse_no_sample' THEN 'NO_SPEECH_MATCH' WHEN 'sparse_exact_sample' THEN 'ATTRIBUTED_HIGH' WHEN 'sparse_same_voice_bracket' THEN 'ATTRIBUTED_HIGH' WHEN 'sparse_nearest' THEN 'ATTRIBUTED_MEDIUM' ELSE 'AMBIGUOUS' END AS status, method FROM m""")
def sparse_attribution(spark: SparkSession, d: str) -> DataFrame:
    """VOI-03, JON-10, WIN-09."""
    return A.sparse(made(spark, d, CENTRES), made(spark, d, SAMPLES))


PLAN_CUES = """SELECT 'V' || CAST(user_id % 5 AS STRING) AS content_id, event_id AS cue_index, CAST(event_id * 3 AS DOUBLE) AS start, CAST(event_id * 3 + event_id % 6 AS DOUBLE) AS end,
CASE event_id % 4 WHEN 0 THEN 'one two three' WHEN 1 THEN ' a b  c d ' WHEN 2 THEN 'one two' ELSE '' END AS text FROM {events}"""


@register("sampling_plan", f"""{duck(c=PLAN_CUES)}, r AS (SELECT * FROM c WHERE "end" > start AND trim(text) <> ''), ok AS (SELECT *, (start + "end") / 2 AS t FROM r WHERE "end" - start >= 1.8 AND len(regexp_split_to_array(trim(text), '\\s+')) >= 3),
w AS (SELECT content_id, max("end") AS dur FROM r GROUP BY 1), g AS (SELECT content_id, least(45.0, dur / 2) + 90.0 * k AS target FROM w, range(80) AS x(k) WHERE least(45.0, dur / 2) + 90.0 * k <= dur),
n AS (SELECT content_id, cue_index, row_number() OVER (PARTITION BY content_id, target ORDER BY abs(t - target), cue_index) AS rk FROM g JOIN ok USING (content_id)),
f AS (SELECT DISTINCT content_id, cue_index, 0 AS p FROM n WHERE rk = 1 UNION ALL SELECT content_id, min(cue_index), 1 FROM ok GROUP BY 1 UNION ALL SELECT content_id, max(cue_index), 2 FROM ok GROUP BY 1),
d AS (SELECT content_id, cue_index, min(p) AS p FROM f GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY p, cue_index) AS o FROM d),
j AS (SELECT ok.*, row_number() OVER (PARTITION BY content_id ORDER BY start, cue_index) AS ordinal, least(3.0, "end" - start) AS use FROM k JOIN ok USING (content_id, cue_index) WHERE o <= 80),
x AS (SELECT *, greatest(start, t - use / 2) AS clip_start FROM j) SELECT content_id, cue_index, ordinal, clip_start, least("end", clip_start + use) AS clip_end FROM x""")
def sampling_plan(spark: SparkSession, d: str) -> DataFrame:
    """VOI-05, WIN-13, FLT-15, WIN-11."""
    return A.sampling_plan(made(spark, d, PLAN_CUES)).select("content_id", "cue_index", "ordinal", "clip_start", "clip_end")


UNITS = """SELECT 'V' || CAST(user_id % 5 AS STRING) AS content_id, event_id AS unit_id, CAST(event_id * 3 AS DOUBLE) AS start, CAST(event_id * 3 + 4 + event_id % 3 AS DOUBLE) AS end, 'Said  no ' || CAST(event_id % 2 AS STRING) AS text FROM {events} WHERE event_id % 3 = 0"""
CUES = """SELECT 'V' || CAST(user_id % 5 AS STRING) AS content_id, event_id AS seq, CASE WHEN event_id % 12 = 0 THEN CAST(event_id * 3 AS DOUBLE) ELSE event_id * 3 + 0.5e0 END AS c_start, CASE WHEN event_id % 12 = 0 THEN CAST(event_id * 3 + 4 + event_id % 3 AS DOUBLE) ELSE event_id * 3 + 5.25e0 END AS c_end,
'said no 0' AS c_text, CASE event_id % 6 WHEN 0 THEN 'ATTRIBUTED_HIGH' WHEN 1 THEN 'ATTRIBUTED_MEDIUM' WHEN 2 THEN 'AMBIGUOUS' WHEN 3 THEN 'NO_SPEECH_MATCH' WHEN 4 THEN 'OTHER' ELSE 'ATTRIBUTED_HIGH' END AS status,
CASE WHEN event_id % 10 = 9 THEN '' ELSE 'P' || CAST(event_id % 3 AS STRING) END AS raw_speaker, 'P' || CAST(event_id % 4 AS STRING) AS s1, CASE WHEN event_id % 7 = 0 THEN NULL ELSE 0.75e0 END AS h1, 'P' || CAST((event_id + 1) % 4 AS STRING) AS s2, CASE WHEN event_id % 7 = 0 THEN NULL ELSE 0.25e0 END AS h2, event_id % 5 = 4 AS bare FROM {events}"""


def attributed(spark: SparkSession, d: str) -> DataFrame:
    one = lambda i: F.struct(F.col(f"s{i}").alias("speaker_id"), F.col(f"h{i}").alias("share"))
    return made(spark, d, CUES).withColumn("candidates", F.when(~F.col("bare"), F.array(one(1), one(2))))


VOTE = f"""{duck(u=UNITS, c=CUES)}, o AS (SELECT u.content_id, u.unit_id, u.start, u."end", c.*, least("end", c_end) - greatest(start, c_start) AS ov, CASE status WHEN 'ATTRIBUTED_HIGH' THEN 1.0 WHEN 'ATTRIBUTED_MEDIUM' THEN 0.8 WHEN 'AMBIGUOUS' THEN 0.45 WHEN 'NO_SPEECH_MATCH' THEN 0.0 ELSE 0.6 END AS q
FROM u JOIN c ON u.content_id = c.content_id AND least("end", c_end) > greatest(start, c_start)), v0 AS (SELECT unit_id, seq, s1 AS spk, ov * q AS ow, coalesce(h1, 0.5) AS share FROM o WHERE NOT bare UNION ALL SELECT unit_id, seq, s2, ov * q, coalesce(h2, 0.5) FROM o WHERE NOT bare
UNION ALL SELECT unit_id, seq, raw_speaker, ov * q, 1.0 FROM o WHERE bare AND raw_speaker <> ''), v AS (SELECT unit_id, spk, sum(ow * share) AS score, arg_min(seq, (-ow, seq)) AS rep FROM v0 GROUP BY 1, 2),
r AS (SELECT *, sum(score) OVER w AS total, count(*) OVER w AS n, row_number() OVER (PARTITION BY unit_id ORDER BY score DESC, spk) AS k FROM v WINDOW w AS (PARTITION BY unit_id)),
b AS (SELECT unit_id, max(spk) FILTER (WHERE k = 1) AS speaker, max(rep) FILTER (WHERE k = 1) AS rep, coalesce(max(score / total) FILTER (WHERE k = 1 AND total > 0), 0.0) AS f, coalesce(max(score / total) FILTER (WHERE k = 2 AND total > 0), 0.0) AS s, max(n) AS speakers FROM r GROUP BY 1),
i AS (SELECT unit_id, greatest(start, c_start) AS a, least("end", c_end) AS z, max("end" - start) OVER (PARTITION BY unit_id) AS dur FROM o), i2 AS (SELECT *, max(z) OVER (PARTITION BY unit_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM i),
i3 AS (SELECT unit_id, dur, sum(greatest(0, z - greatest(a, coalesce(seen, a)))) AS len FROM i2 GROUP BY 1, 2), cov AS (SELECT unit_id, least(1.0, len / greatest(0.001, dur)) AS c FROM i3),
vote AS (SELECT unit_id, speaker, rep, speakers, f, s, c, CASE WHEN c < 0.35 THEN 'NO_SPEECH_MATCH' WHEN f >= 0.8 AND s <= 0.2 THEN 'ATTRIBUTED_HIGH' WHEN f >= 0.65 AND s <= 0.35 THEN 'ATTRIBUTED_MEDIUM' ELSE 'AMBIGUOUS' END AS status FROM b JOIN cov USING (unit_id))"""


@register("unit_votes", f"""{VOTE} SELECT u.unit_id, speaker, rep, speakers, round(f, 6) AS first_share, round(s, 6) AS second_share, round(c, 6) AS coverage, status FROM u LEFT JOIN vote USING (unit_id)""")
def unit_votes(spark: SparkSession, d: str) -> DataFrame:
    """JON-09, AGG-16, AGG-17."""
    v = A.unit_vote(made(spark, d, UNITS), attributed(spark, d))
    return v.select("unit_id", "speaker", "rep", "speakers", *[F.round(c, 6).alias(c) for c in ("first_share", "second_share", "coverage")], "status")


@register("unit_attribution", f"""{VOTE}, e AS (SELECT u.unit_id, arg_max(raw_speaker, seq) AS es, arg_max(status, seq) AS et FROM u JOIN c ON u.content_id = c.content_id AND round(u.start, 3) = round(c_start, 3) AND round(u."end", 3) = round(c_end, 3) AND lower(regexp_replace(trim(u.text), '\\s+', ' ', 'g')) = c_text GROUP BY 1)
SELECT u.unit_id, CASE WHEN et IS NOT NULL THEN es ELSE speaker END AS speaker, coalesce(et, status) AS status, CASE WHEN et IS NOT NULL THEN 'exact' WHEN speaker IS NOT NULL THEN 'vote' ELSE 'none' END AS basis FROM u LEFT JOIN e USING (unit_id) LEFT JOIN vote USING (unit_id)""")
def unit_attribution(spark: SparkSession, d: str) -> DataFrame:
    """VOI-04, JON-08, PRJ-03."""
    return A.unit_attribution(made(spark, d, UNITS), attributed(spark, d)).select("unit_id", "speaker", "status", "basis")


TURNS = "SELECT 'V' || CAST(user_id % 5 AS STRING) AS content_id, event_id AS seg_id, 'P' || CAST(event_id % 3 AS STRING) AS speaker, event_id * 2.5e0 AS start, event_id * 2.5e0 + event_id % 9 AS end FROM {events}"


@register("chosen_speakers", f"""{duck(u=UNITS, t=TURNS)}, o AS (SELECT u.unit_id, t.speaker, sum(least(u."end", t."end") - greatest(u.start, t.start)) AS m, min(t.start) AS s FROM u JOIN t ON u.content_id = t.content_id AND least(u."end", t."end") > greatest(u.start, t.start) GROUP BY 1, 2),
b AS (SELECT unit_id, arg_min(speaker, (-m, s, speaker)) AS speaker, max(m) AS m FROM o GROUP BY 1) SELECT unit_id, coalesce(speaker, 'UNKNOWN_SPEAKER') AS speaker, round(least(1.0, coalesce(m, 0) / greatest(0.001, "end" - start)), 6) AS share FROM u LEFT JOIN b USING (unit_id)""")
def chosen_speakers(spark: SparkSession, d: str) -> DataFrame:
    """VOI-14, JON-07."""
    t = made(spark, d, TURNS).select("content_id", "speaker", F.col("start").alias("seg_start"), F.col("end").alias("seg_end"))
    out = A.choose_speaker(made(spark, d, UNITS).withColumnRenamed("unit_id", "cue_index"), t)
    return out.select(F.col("cue_index").alias("unit_id"), "speaker", F.round("share", 6).alias("share"))


@register("marked_overlaps", f"""{duck(t=TURNS)} SELECT seg_id, EXISTS (SELECT 1 FROM t b WHERE b.content_id = a.content_id AND b.speaker <> a.speaker AND least(a."end", b."end") - greatest(a.start, b.start) > 0.03) AS overlap FROM t a""")
def marked_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """WIN-08, VOI-14."""
    return A.mark_overlap(made(spark, d, TURNS)).select("seg_id", "overlap")


SEGS = "SELECT user_id % 20 AS file_id, 'P' || CAST(event_id % 3 AS STRING) AS speaker, event_id * 20e0 AS start, event_id * 20e0 + event_id % 17 AS end, event_id % 5 = 0 AS overlap FROM {events}"


@register("exemplars", f"""{duck(s=SEGS)}, r AS (SELECT *, "end" - start AS dur, row_number() OVER (PARTITION BY file_id, speaker ORDER BY "end" - start DESC, start) AS n FROM s WHERE NOT overlap AND "end" - start >= 2),
c AS (SELECT *, CASE WHEN dur > 10 THEN greatest(0, (start + "end") / 2 - 5) ELSE start END AS clip_start, CASE WHEN dur > 10 THEN greatest(0, (start + "end") / 2 - 5) + 10 ELSE "end" END AS clip_end FROM r WHERE n <= 8)
SELECT file_id, speaker, n, clip_start, clip_end, round(least(1.0, (clip_end - clip_start) / 8), 6) AS quality FROM c""")
def exemplars(spark: SparkSession, d: str) -> DataFrame:
    """VOI-10, MTH-08."""
    return V.exemplars(made(spark, d, SEGS)).withColumn("quality", F.round("quality", 6))


CLUSTERS = "SELECT 'AC' || CAST(p_partkey AS STRING) AS cluster_id, 'SPK' || CAST(p_partkey % 50 AS STRING) AS pipeline_id, 'CH' || CAST(p_partkey % 3 AS STRING) AS channel_id, p_partkey * 7 % 1000 AS created_at FROM {part}"
CLUES = """SELECT event_id AS clue_id, CASE event_id % 3 WHEN 0 THEN 'AC' || CAST(event_id % 300 AS STRING) ELSE '' END AS cluster_id, CASE WHEN event_id % 7 = 0 THEN '' ELSE 'SPK' || CAST(event_id % 60 AS STRING) END AS raw_speaker_id, CASE event_id % 2 WHEN 0 THEN '' ELSE 'CH' || CAST(event_id % 4 AS STRING) END AS channel_id,
CASE event_id % 9 WHEN 0 THEN 'SELF_IDENTIFICATION' WHEN 1 THEN 'HOST_INTRODUCTION' WHEN 2 THEN 'explicit_introduction' WHEN 3 THEN 'CHANNEL_HOST_METADATA' WHEN 4 THEN 'DIRECT_ADDRESS' WHEN 5 THEN 'TITLE_METADATA' WHEN 6 THEN 'CO_SPEAKER_REFERENCE' WHEN 7 THEN 'TRANSCRIPT_CONTEXT' ELSE 'OTHER' END AS evidence_type,
CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN '0.5' WHEN 2 THEN '2' WHEN 3 THEN 'x' WHEN 4 THEN '0.9' ELSE '0' END AS confidence, CASE WHEN event_id % 8 = 0 THEN '' ELSE 'E' || CAST(event_id % 11 AS STRING) END AS entity_id, CASE WHEN event_id % 16 = 8 THEN 'A Name' ELSE '' END AS name, 'C' || CAST(event_id % 5 AS STRING) AS content_id FROM {events}"""


@register("clue_clusters", f"""{duck(k=CLUSTERS, c=CLUES)}, f AS (SELECT clue_id, coalesce(nullif(c.cluster_id, ''), (SELECT arg_max(k.cluster_id, (k.created_at, k.cluster_id)) FROM k WHERE k.pipeline_id = nullif(c.raw_speaker_id, '') AND (c.channel_id = '' OR k.channel_id = c.channel_id))) AS cluster FROM c)
SELECT clue_id, cluster FROM f WHERE cluster IN (SELECT cluster_id FROM k)""")
def clue_clusters(spark: SparkSession, d: str) -> DataFrame:
    """JON-20."""
    return V.clue_clusters(made(spark, d, CLUES), made(spark, d, CLUSTERS)).select("clue_id", "cluster")


WEIGHT = """(CASE upper(evidence_type) WHEN 'SELF_IDENTIFICATION' THEN 1.00 WHEN 'HOST_INTRODUCTION' THEN 0.95 WHEN 'EXPLICIT_INTRODUCTION' THEN 0.95 WHEN 'CHANNEL_HOST_METADATA' THEN 0.85 WHEN 'DIRECT_ADDRESS' THEN 0.70 WHEN 'TITLE_METADATA' THEN 0.65 WHEN 'CO_SPEAKER_REFERENCE' THEN 0.55 WHEN 'TRANSCRIPT_CONTEXT' THEN 0.45 ELSE 0.35 END)::DOUBLE
* (CASE confidence WHEN '0.5' THEN 0.5 WHEN '0.9' THEN 0.9 ELSE 1.0 END)::DOUBLE"""


@register("clue_weights", f"""{duck(c=CLUES)} SELECT clue_id, round({WEIGHT}, 6) AS weight FROM c""")
def clue_weights(spark: SparkSession, d: str) -> DataFrame:
    """VOI-07. An unreadable confidence is 1, as an empty one."""
    return made(spark, d, CLUES).select("clue_id", F.round(V.clue_weight(F.col("evidence_type"), F.col("confidence")), 6).alias("weight"))


PAIRS = "SELECT 'AC' || CAST(o_orderkey % 200 AS STRING) AS left_id, 'AC' || CAST(o_orderkey % 200 + 1 + o_orderkey % 17 AS STRING) AS right_id, 0.5e0 + (o_orderkey % 50) / 100e0 AS sim, CASE WHEN o_orderkey % 6 = 0 THEN 'REJECTED' ELSE 'OPEN' END AS status FROM {orders}"
BINDINGS = "SELECT 'AC' || CAST(p_partkey AS STRING) AS cluster_id, CASE WHEN p_partkey % 20 = 0 THEN '' ELSE 'E' || CAST(p_partkey % 11 AS STRING) END AS entity_id, CASE WHEN p_partkey % 40 = 0 THEN 'A Name' ELSE '' END AS name, CASE p_partkey % 3 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN 'high_confidence' ELSE 'TENTATIVE' END AS binding_status FROM {part} WHERE p_partkey % 5 = 0"
PRIOR = "SELECT 'AC' || CAST(event_id % 300 AS STRING) AS cluster_id, 'E' || CAST(event_id % 11 AS STRING) AS entity_id, CASE event_id % 2 WHEN 0 THEN 'REJECTED' ELSE 'OPEN' END AS status FROM {events} WHERE event_id < 60"


def clue_rows(spark: SparkSession, d: str) -> DataFrame:
    c = made(spark, d, CLUES).where("cluster_id <> ''")
    return c.withColumn("weight", V.clue_weight(F.col("evidence_type"), F.col("confidence")))


FUSED = f"""{duck(c=CLUES, p=PAIRS, b=BINDINGS, r=PRIOR)}, e AS (SELECT *, {WEIGHT} AS w FROM c WHERE cluster_id <> '' AND (entity_id <> '' OR name <> '')),
g AS (SELECT cluster_id, entity_id, name, CASE WHEN max(w) >= 1 THEN 1.0 ELSE 1 - exp(sum(ln(1 - least(w, 1 - 1e-15)))) END AS context, count(*) AS evidence_count, count(DISTINCT content_id) AS contents,
count(*) FILTER (WHERE upper(evidence_type) IN ('SELF_IDENTIFICATION', 'HOST_INTRODUCTION', 'EXPLICIT_INTRODUCTION')) AS direct FROM e GROUP BY ALL),
s AS (SELECT left_id AS cluster_id, right_id AS voice, sim, status FROM p UNION ALL SELECT right_id, left_id, sim, status FROM p), n AS (SELECT s.*, b.entity_id, b.name FROM s JOIN b ON s.voice = b.cluster_id AND upper(binding_status) IN ('VERIFIED', 'HIGH_CONFIDENCE')),
a AS (SELECT cluster_id, entity_id, max(greatest(0.0, least(1.0, (sim - 0.55) / 0.35))) AS acoustic FROM n WHERE entity_id <> '' GROUP BY ALL),
l AS (SELECT DISTINCT cluster_id, entity_id, name FROM n WHERE status <> 'REJECTED' AND (entity_id <> '' OR name <> '') AND cluster_id NOT IN (SELECT cluster_id FROM b)),
k AS (SELECT cluster_id, entity_id, name FROM g UNION SELECT * FROM l), f AS (SELECT k.*, coalesce(context, 0.0) AS context, coalesce(acoustic, 0.0) AS acoustic, coalesce(evidence_count, 0) AS evidence_count, coalesce(contents, 0) AS contents, coalesce(direct, 0) AS direct
FROM k LEFT JOIN g USING (cluster_id, entity_id, name) LEFT JOIN a USING (cluster_id, entity_id)), h AS (SELECT *, 'IH_' || upper(substr(sha256(cluster_id || chr(31) || entity_id || chr(31) || name), 1, 24)) AS hypothesis_id FROM f),
q AS (SELECT DISTINCT 'IH_' || upper(substr(sha256(cluster_id || chr(31) || entity_id || chr(31)), 1, 24)) AS hypothesis_id FROM r WHERE status = 'REJECTED'),
hyp AS (SELECT h.*, 1 - (1 - context) * (1 - acoustic) AS combined, CASE WHEN q.hypothesis_id IS NOT NULL THEN 'REJECTED' WHEN (context >= 0.88 AND acoustic >= 0.7) OR (context >= 0.96 AND contents >= 2 AND direct >= 1) THEN 'HIGH_CONFIDENCE_CANDIDATE' WHEN context <= 0.01 AND acoustic >= 0.7 THEN 'ACOUSTIC_CANDIDATE'
WHEN context < 0.35 AND acoustic < 0.35 THEN 'WEAK' ELSE 'OPEN' END AS status FROM h LEFT JOIN q USING (hypothesis_id))"""


def hypotheses(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.exprs import stable_id

    prior = made(spark, d, PRIOR).select(stable_id("IH_", F.col("cluster_id"), F.col("entity_id"), F.lit("")).alias("hypothesis_id"), "status").where("status = 'REJECTED'").distinct()
    return V.fuse(clue_rows(spark, d), made(spark, d, PAIRS), made(spark, d, BINDINGS), prior)


@register("voice_fusion", f"""{FUSED} SELECT hypothesis_id, cluster_id, entity_id, name, round(context, 6) AS context, round(acoustic, 6) AS acoustic, round(combined, 6) AS combined, evidence_count, contents, direct, status FROM hyp""")
def voice_fusion(spark: SparkSession, d: str) -> DataFrame:
    """VOI-08, AGG-14, AGG-15, JON-19, STR-12."""
    return hypotheses(spark, d).withColumns({c: F.round(c, 6) for c in ("context", "acoustic", "combined")})


VOICES = "SELECT p_partkey AS voice_no, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE 'E' || CAST(p_partkey % 11 AS STRING) END AS entity_id, 'name ' || CAST(p_partkey AS STRING) AS name FROM {part} WHERE p_partkey % 11 < 6"
APPROVED = f"""{FUSED}, v AS ({VOICES.replace('{part}', 'part')}), d AS (SELECT *, CASE WHEN evidence_count % 2 = 0 THEN 'VERIFIED' ELSE 'HIGH_CONFIDENCE' END AS verdict FROM hyp WHERE status = 'HIGH_CONFIDENCE_CANDIDATE'), fv AS (SELECT entity_id, min(voice_no) AS no FROM v WHERE entity_id <> '' GROUP BY 1),
j AS (SELECT d.*, fv.no, CASE WHEN d.entity_id <> '' THEN d.entity_id ELSE hypothesis_id END AS who FROM d LEFT JOIN fv USING (entity_id)), nw AS (SELECT who, arg_min(entity_id, hypothesis_id) AS entity_id, arg_min(name, hypothesis_id) AS name, (SELECT max(voice_no) FROM v) + row_number() OVER (ORDER BY min(hypothesis_id)) AS no FROM j WHERE no IS NULL GROUP BY who),
x AS (SELECT j.*, coalesce(j.no, nw.no) AS voice_no FROM j LEFT JOIN nw USING (who)), bd AS (SELECT cluster_id, arg_max(voice_no, hypothesis_id) AS voice_no, arg_max(verdict, hypothesis_id) AS status, round(arg_max(combined, hypothesis_id), 6) AS confidence FROM x GROUP BY 1)"""


def approved(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    h, v = hypotheses(spark, d), made(spark, d, VOICES)
    verdicts = h.where("status = 'HIGH_CONFIDENCE_CANDIDATE'").select("hypothesis_id", F.when(F.col("evidence_count") % 2 == 0, "verified").otherwise("high_confidence").alias("status"))
    b, new = V.approve(h.drop("status"), verdicts, v)
    return b, new, v


@register("voice_registry", f"""{APPROVED} SELECT cluster_id, voice_no, status, confidence FROM bd""")
def voice_registry(spark: SparkSession, d: str) -> DataFrame:
    """VOI-09."""
    return approved(spark, d)[0].withColumn("confidence", F.round("confidence", 6))


@register("identity_export", f"""{APPROVED}, cl AS ({CLUSTERS.replace('{part}', 'part')}), w AS (SELECT voice_no, entity_id, name FROM v UNION ALL SELECT no, entity_id, name FROM nw)
SELECT cl.cluster_id, pipeline_id, channel_id, 'VOICE_' || lpad(w.voice_no::VARCHAR, 8, '0') AS canonical_voice_id, w.entity_id, w.name, bd.status AS binding_status FROM cl LEFT JOIN bd USING (cluster_id) LEFT JOIN w USING (voice_no)""")
def identity_export(spark: SparkSession, d: str) -> DataFrame:
    """JON-18, VOI-15."""
    b, new, v = approved(spark, d)
    return V.identity_export(made(spark, d, CLUSTERS), b, v.unionByName(new))


RESOLUTION = "SELECT 'AC' || CAST(event_id % 100 AS STRING) AS cluster_id, 'E' || CAST(event_id AS STRING) AS entity_id, CASE event_id % 4 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN ' high_confidence' WHEN 2 THEN 'PROBABLE' END AS status, CASE event_id % 3 WHEN 0 THEN '0.5' WHEN 1 THEN 'x' ELSE '' END AS confidence, event_id % 7 = 0 AS path_match, event_id AS seq FROM {events} WHERE event_id % 100 < 90"


@register("speaker_resolution", f"""{duck(k=CLUSTERS, r=RESOLUTION)}, s AS (SELECT *, CASE WHEN path_match THEN 100 ELSE 0 END + CASE upper(trim(status)) WHEN 'VERIFIED' THEN 20 WHEN 'HIGH_CONFIDENCE' THEN 10 ELSE 0 END + CASE WHEN confidence = '0.5' THEN 0.5 ELSE 0 END AS score FROM r)
SELECT cluster_id, b.entity_id, b.score FROM k LEFT JOIN (SELECT cluster_id, arg_min(entity_id, (-score, seq)) AS entity_id, max(score)::DOUBLE AS score FROM s GROUP BY 1) b USING (cluster_id)""")
def speaker_resolution(spark: SparkSession, d: str) -> DataFrame:
    """JON-17."""
    return A.resolution(made(spark, d, CLUSTERS).select("cluster_id"), made(spark, d, RESOLUTION))


FILES = "SELECT p_partkey AS file_id, '/a/' || CAST(p_partkey AS STRING) || '.wav' AS path, CAST(p_partkey % 5 AS DOUBLE) AS duration, CASE WHEN p_partkey % 4 = 0 THEN 'bad' END AS scan_error FROM {part}"
LOCALS = "SELECT p_partkey * 10 + 1 AS speaker_no, p_partkey AS file_id, 'SPEAKER_0' || CAST(p_partkey % 2 AS STRING) AS local_speaker FROM {part} WHERE p_partkey % 6 <> 0"
ASSIGNED = "SELECT p_partkey * 10 + 1 AS speaker_no, 'G' || CAST(p_partkey % 9 AS STRING) AS global_speaker FROM {part} WHERE p_partkey % 5 <> 0"
DB_SEGS = "SELECT event_id % 100 + 1 AS file_id, 'SPEAKER_0' || CAST((event_id + 1) % 2 AS STRING) AS local_speaker, CAST(event_id AS DOUBLE) AS start, event_id + 0.5e0 AS end FROM {events}"


@register("attributed_segments", f"""{duck(f=FILES, s=DB_SEGS, l=LOCALS, a=ASSIGNED)} SELECT s.file_id, path, s.local_speaker, s.start, s."end", global_speaker FROM s JOIN f USING (file_id) JOIN l ON l.file_id = s.file_id AND l.local_speaker = s.local_speaker LEFT JOIN a USING (speaker_no)""")
def attributed_segments(spark: SparkSession, d: str) -> DataFrame:
    """JON-05, SRC-12."""
    return V.attributed_segments(*(made(spark, d, t) for t in (FILES, DB_SEGS, LOCALS, ASSIGNED)))


@register("sparse_seeds", f"""{duck(f=FILES)} SELECT file_id, 'SPARSE_SAMPLE' AS local_speaker, 0.0::DOUBLE AS start, duration AS "end", duration, false AS overlap FROM f WHERE scan_error IS NULL AND duration >= 1.5""")
def sparse_seeds(spark: SparkSession, d: str) -> DataFrame:
    """VOI-13."""
    return V.sparse_seeds(made(spark, d, FILES))


OBS = "SELECT 'SPK' || CAST(p_partkey AS STRING) AS pipeline_id, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'CH1' END AS channel_id, '/m/' || CAST(p_partkey % 7 AS STRING) AS path, '[' || CAST(p_partkey AS STRING) || ']' AS centroid_json FROM {part} WHERE p_partkey % 2 = 0"
OLD_OBS = "SELECT 'SPK' || CAST(p_partkey AS STRING) AS pipeline_id, 'OLD' AS channel_id, '/m/' || CAST(p_partkey % 7 AS STRING) AS path, '[]' AS centroid_json FROM {part} WHERE p_partkey % 3 = 0"


@register("cluster_observations", f"""{duck(n=OBS, o=OLD_OBS)} SELECT 'AC_' || upper(substr(sha256(path || chr(31) || pipeline_id), 1, 24)) AS cluster_id, pipeline_id, coalesce(nullif(n.channel_id, ''), o.channel_id) AS channel_id, path, coalesce(n.centroid_json, o.centroid_json) AS centroid_json FROM n FULL JOIN o USING (path, pipeline_id)""")
def cluster_observations(spark: SparkSession, d: str) -> DataFrame:
    """VOI-12, VOI-11, SNK-05, STR-12."""
    from ..functions.exprs import stable_id

    old = made(spark, d, OLD_OBS)
    return V.observations(made(spark, d, OBS), old.select(stable_id("AC_", F.col("path"), F.col("pipeline_id")).alias("cluster_id"), "*"))


VECTORS = "SELECT vec_id AS id, embedding, CASE WHEN vec_id % 3 = 0 THEN 'm1' ELSE 'm2' END AS model FROM {embeddings}"


@register("voice_pairs", """WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 3 = 0 THEN 'm1' ELSE 'm2' END || '/' || CASE WHEN vec_id % 4 = 0 THEN 32 ELSE 64 END AS grp, (CASE WHEN vec_id % 4 = 0 THEN embedding[1:32] ELSE embedding END)::DOUBLE[] AS e FROM embeddings),
s AS (SELECT a.id AS qid, b.id AS bid, list_cosine_similarity(a.e, b.e) AS sim FROM v a JOIN v b ON a.grp = b.grp AND a.id <> b.id), r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, bid) AS rank FROM s WHERE sim >= 0.2), m AS (SELECT * FROM r WHERE rank <= 5),
x AS (SELECT *, max(sim) OVER w - coalesce(max(sim) FILTER (WHERE rank = 2) OVER w, 0) AS margin FROM m WINDOW w AS (PARTITION BY qid))
SELECT least(qid, bid) AS left_id, greatest(qid, bid) AS right_id, round(max(sim), 5) AS sim, max(rank) FILTER (WHERE qid < bid) AS rank_left, max(rank) FILTER (WHERE qid > bid) AS rank_right, round(max(margin) FILTER (WHERE qid < bid), 5) AS margin_left, round(max(margin) FILTER (WHERE qid > bid), 5) AS margin_right FROM x GROUP BY 1, 2""")
def voice_pairs(spark: SparkSession, d: str) -> DataFrame:
    """VOI-02, JON-21, WIN-10: two models, two dimensions; vectors meet within both."""
    v = made(spark, d, VECTORS)
    v = v.select("id", F.when(F.col("id") % 4 == 0, F.slice("embedding", 1, 32)).otherwise(F.col("embedding")).alias("vec"), "model")
    return V.ranked_pairs(V.blocks_topk(v, v, 5, 0.2)).withColumns({c: F.round(c, 5) for c in ("sim", "margin_left", "margin_right")})


WORDS = "SELECT 'V' || CAST(user_id % 5 AS STRING) AS content_id, event_id AS word_no, event_id * 0.5e0 AS w_start, event_id * 0.5e0 + 0.25e0 AS w_end, CASE WHEN event_id % 4 = 0 THEN ' w' ELSE 'w' END || CAST(event_id AS STRING) AS word, CASE WHEN event_id % 40 < 20 THEN 'P1' ELSE 'P2' END AS speaker FROM {events}"
MAPS = "SELECT 'V' || CAST(p_partkey % 5 AS STRING) AS content_id, p_partkey AS map_idx, p_partkey * 4e0 AS m_start, p_partkey * 4e0 + 3e0 AS m_end, p_partkey * 100e0 AS s_start FROM {part}"


@register("bridged_words", f"""{duck(w=WORDS, m=MAPS)}, j AS (SELECT w.*, (SELECT arg_min((m_start, s_start), map_idx) FROM m WHERE m.content_id = w.content_id AND (w_start + w_end) / 2 BETWEEN m_start AND m_end) AS k FROM w),
s AS (SELECT *, w_start + k[2] - k[1] AS a, w_end + k[2] - k[1] AS z FROM j WHERE k IS NOT NULL), g AS (SELECT *, CASE WHEN lag(z) OVER o IS NULL OR lag(speaker) OVER o <> speaker OR a - lag(z) OVER o >= 1.25 THEN 1 ELSE 0 END AS new FROM s WINDOW o AS (PARTITION BY content_id ORDER BY word_no)),
r AS (SELECT *, sum(new) OVER (PARTITION BY content_id ORDER BY word_no) AS run FROM g) SELECT content_id, run::BIGINT AS run, speaker, min(a) AS start, max(z) AS "end", string_agg(trim(word), ' ' ORDER BY word_no) AS text FROM r GROUP BY 1, 2, 3""".replace("(m_start, s_start)", "[m_start, s_start]"))
def bridged_words(spark: SparkSession, d: str) -> DataFrame:
    """VOI-06, JON-11, WIN-04."""
    return A.bridge_words(made(spark, d, WORDS), made(spark, d, MAPS))

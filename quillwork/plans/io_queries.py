"""Queries over sources, sinks, scalar functions and the mention roll-ups. Inputs as in review_queries; files are written
to the shared folder first and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import core, mentions
from ..operators.graph import shared_root
from ..sources import io
from .base import duck, made, table
from .registry import register


def folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/io-{uuid.uuid4().hex}"


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file, through the file system that the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


@register("csv_round_trip", """SELECT p_partkey, p_name, p_retailprice, NULL::VARCHAR AS absent FROM part""")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """SRC-01, SNK-01: unknown columns go, absent ones are NULL, a missing file adds nothing."""
    path, schema = folder(spark), "p_partkey long, p_name string, p_retailprice double, absent string"
    io.write_csv(table(spark, d, "part"), path, ["p_name", "p_partkey", "more", "p_retailprice"])
    return io.read_csv(spark, path, schema).unionByName(io.read_csv(spark, f"{path}-none", schema))


@register("json_lines", "SELECT event_id AS id, 'x' || (event_id % 3) AS v FROM events WHERE event_id % 7 > 2")
def json_lines(spark: SparkSession, d: str) -> DataFrame:
    """SRC-02: blank and malformed lines go; read in splits, without numbers."""
    n = F.col("event_id")
    good = F.concat(F.lit('{"id": '), n.cast("string"), F.lit(', "v": "x'), (n % 3).cast("string"), F.lit('"}'))
    value = F.when(n % 7 == 0, "").when(n % 7 == 1, '{"id": broken').when(n % 7 == 2, "   ").otherwise(good)
    path = folder(spark)
    table(spark, d, "events").select(value.alias("value")).write.text(path)
    return io.json_lines(spark, path, "id long, v string", numbered=False).select("id", "v")


@register("json_round_trip", "SELECT event_id AS id, event_type AS v FROM events")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """SRC-03, SNK-03: written in order of the key, read strictly."""
    path = folder(spark)
    io.write_json_lines(table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("v")), path, "id")
    return io.json_lines(spark, path, "id long, v string", strict=True).select("id", "v")


@register("keyed_lines", "SELECT user_id AS id, arg_max(event_type, event_id) AS v FROM events GROUP BY 1")
def keyed_lines(spark: SparkSession, d: str) -> DataFrame:
    """SRC-04: of each key the last line, in order of files and lines."""
    path = folder(spark)
    table(spark, d, "events").orderBy("event_id").select(F.col("user_id").alias("id"), F.col("event_type").alias("v")).write.json(path)
    return io.keyed_lines(spark, path, "id long, v string", "id").select("id", "v")


def put_files(spark: SparkSession, lines: DataFrame, root: str) -> None:
    """lines (file, no, line) as one text file per name: Spark writes a folder per file, whose one part is then renamed. The
    driver handles names only."""
    out = folder(spark)
    named = lines.select(F.base64(F.col("file").cast("binary")).alias("file"), "no", "line")
    named.repartition("file").sortWithinPartitions("file", "no").select("file", "line").write.partitionBy("file").text(out)  # the writer keeps this order
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    names = {r["f"]: r["file"] for r in lines.select("file", F.base64(F.col("file").cast("binary")).alias("f")).distinct().collect()}
    for f, name in names.items():
        (part,) = [x.getPath() for x in fs.globStatus(path(f"{out}/file={f.replace('=', '%3D').replace('/', '%2F')}/part-*"))]
        fs.mkdirs(path(f"{root}/{name}").getParent())
        fs.rename(part, path(f"{root}/{name}"))


#: Conversations as caption files of three channels, one of them not for production, and as one file of spoken turns each;
#: some lines are blank or broken.
SCRIPTS = """SELECT conv_id, turn, role, CASE conv_id % 3 WHEN 0 THEN 'YT001' WHEN 1 THEN 'yt22' ELSE 'test_channel' END AS channel, CAST(conv_id % 30 AS STRING) AS g, CAST(turn AS DOUBLE) * 1.5e0 AS a, CASE WHEN turn % 4 <> 1 THEN CAST(turn AS DOUBLE) * 1.5e0 + 1 END AS z, regexp_replace(text, '[^A-Za-z0-9 .,]', '') AS t,
CASE turn % 7 WHEN 5 THEN 'broken' WHEN 6 THEN '' END AS odd FROM {conversations}"""
ORDERED = """, l AS (SELECT *, regexp_replace(text, '[^A-Za-z0-9 .,]', '', 'g') AS t2, row_number() OVER (PARTITION BY channel, g ORDER BY conv_id, turn) - 1 AS cap, row_number() OVER (PARTITION BY channel ORDER BY conv_id, turn) - 1 AS dia FROM c)"""
SCRIPTS_DUCK = duck(c=SCRIPTS.replace("regexp_replace(text, '[^A-Za-z0-9 .,]', '') AS t", "text")) + ORDERED


def scripts(spark: SparkSession, d: str, root: str) -> None:
    s = made(spark, d, SCRIPTS)
    no = F.struct("conv_id", "turn").alias("no")
    cap = s.select(F.concat("channel", F.lit("/normalized/g"), "g", F.lit(".segments.jsonl")).alias("file"), no, F.coalesce("odd", F.to_json(F.struct(F.col("a").alias("start"), F.col("z").alias("end"), F.col("t").alias("text")))).alias("line"))
    dia = s.select(F.concat("channel", F.lit("/diarized/diarized_transcript.jsonl")).alias("file"), no, F.coalesce("odd", F.to_json(F.struct(F.concat(F.lit("v"), "g").alias("video_id"), F.col("role").alias("speaker_id"), F.col("a").alias("start_seconds"), F.coalesce("z", F.lit(0.0)).alias("end_seconds"), F.col("t").alias("text")))).alias("line"))
    put_files(spark, cap.unionByName(dia), root)


@register("segment_scan", SCRIPTS_DUCK + """ SELECT 'caption' AS source_type, 'g' || g AS content_id, cap::INTEGER AS cue_index, a AS start, coalesce(z, a) AS "end", t2 AS text, NULL AS speaker_id FROM l WHERE odd IS NULL AND channel <> 'test_channel'
UNION ALL SELECT 'diarized', 'v' || g, dia, a, coalesce(z, 0), t2, role FROM l WHERE odd IS NULL AND channel <> 'test_channel'""")
def segment_scan(spark: SparkSession, d: str) -> DataFrame:
    """SRC-05, SRC-06, SRC-07, SET-01, TXT-03: files of all conversations, of two kinds, below three channels."""
    root = folder(spark)
    scripts(spark, d, root)
    return io.production_only(io.segment_scan(spark, root)).drop("path")


#: Events as one text file per user.
USER_FILES = "SELECT 'u' || CAST(user_id % 40 AS STRING) || '/log.txt' AS file, event_id AS no, event_type || ' ' || CAST(event_id AS STRING) AS line FROM {events}"


@register("file_digests", duck(f=USER_FILES) + " SELECT file, sha256(string_agg(line, chr(10) ORDER BY no) || chr(10)) AS sha256 FROM f GROUP BY file")
def file_digests(spark: SparkSession, d: str) -> DataFrame:
    """SRC-08: all events as files of lines."""
    root = folder(spark)
    put_files(spark, made(spark, d, USER_FILES), root)
    return io.file_digests(spark, root).select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("file"), "sha256")


#: Events as attribution rows, some with times that cannot be read.
ATTRIBUTED = """SELECT 'run' || CAST(user_id % 12 AS STRING) AS run, event_id AS no, 'v' || CAST(event_id % 50 AS STRING) AS video_id, CASE event_id % 11 WHEN 0 THEN 'x' WHEN 1 THEN '' ELSE CAST(event_id AS STRING) || '.5' END AS a, CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN ' y ' ELSE CAST(event_id + 2 AS STRING) END AS z,
CASE event_id % 5 WHEN 0 THEN event_type || ', again' ELSE event_type END AS t, 'S' || CAST(user_id AS STRING) AS speaker, CASE WHEN event_id % 3 > 0 THEN 'HIGH' ELSE 'LOW' END AS status FROM {events}"""


@register("attribution_scan", duck(r=ATTRIBUTED) + """, n AS (SELECT *, CASE a WHEN '' THEN 0.0 ELSE TRY_CAST(a AS DOUBLE) END AS s FROM r) SELECT video_id, s AS start, CASE z WHEN '' THEN s ELSE TRY_CAST(z AS DOUBLE) END AS "end", t AS text, speaker AS raw_speaker, status FROM n WHERE a <> 'x' AND z <> ' y '""")
def attribution_scan(spark: SparkSession, d: str) -> DataFrame:
    """SRC-15: all events as rows of files below one folder per run."""
    root = folder(spark)
    r = made(spark, d, ATTRIBUTED)
    file, quoted = F.concat("run", F.lit("/caption_speaker_attribution.csv")).alias("file"), F.concat(F.lit('"'), "t", F.lit('"'))
    rows = r.select(file, "no", F.concat_ws(",", "video_id", "a", "z", quoted, "speaker", "status").alias("line"))
    head = r.select(file).distinct().select("file", F.lit(-1).cast("long").alias("no"), F.lit("video_id,start_seconds,end_seconds,text,raw_speaker_id,speaker_attribution_status").alias("line"))
    put_files(spark, rows.unionByName(head), root)
    return io.attribution_scan(spark, root)


@register("snapshot_write", "SELECT 's' || (event_id % 3) AS snapshot_id, event_id AS node FROM events WHERE event_id % 3 <> 1 UNION ALL SELECT 's1', -event_id FROM events WHERE event_id % 3 = 1")
def snapshot_write(spark: SparkSession, d: str) -> DataFrame:
    """GRF-09: three snapshots, of which one is written again."""
    path, e = folder(spark), table(spark, d, "events")
    own = e.select(F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("snapshot_id"), F.col("event_id").alias("node"))
    io.write_snapshot(own, path)
    io.write_snapshot(own.where("snapshot_id = 's1'").withColumn("node", -F.col("node")), path)
    return spark.read.parquet(path).select(F.col("snapshot_id").cast("string").alias("snapshot_id"), "node")


VTT = """SELECT event_id AS content_id, 'WEBVTT' || chr(10) || chr(10) || '1' || chr(10) || '00:00:0' || CAST(event_id % 10 AS STRING) || '.500 --> 00:00:10.000 align:start' || chr(10) || '<c>Fish &amp;  chips</c> ' || CAST(event_id AS STRING) || chr(10) || chr(10) ||
'01:00:10,000 --> 01:00:12.250' || chr(10) || 'Fish &amp; chips ' || CAST(event_id - event_id % 2 AS STRING) || chr(10) || chr(10) || '00:20.000 --> 00:21.000' || chr(10) || ' ' || chr(10) || chr(10) || '00:30.000 --> 00:31.000' || chr(10) || 'a' || chr(10) || '&lt;b&gt;' AS value FROM {events}"""


@register("vtt_cues", """SELECT event_id AS content_id, event_id % 10 + 0.5::DOUBLE AS start, CASE WHEN event_id % 2 = 0 THEN 3612.25 ELSE 10.0 END::DOUBLE AS "end", 'Fish & chips ' || event_id AS text FROM events UNION ALL SELECT event_id, 3610.0, 3612.25, 'Fish & chips ' || (event_id - 1) FROM events WHERE event_id % 2 = 1
UNION ALL SELECT event_id, 30.0, 31.0, 'a <b>' FROM events""")
def vtt_cues(spark: SparkSession, d: str) -> DataFrame:
    """SRC-09, WIN-05, TXT-01, DTE-03, STR-06."""
    return io.vtt_cues(made(spark, d, VTT)).select("content_id", "start", "end", "text")


SIDE = "SELECT CAST(p_partkey AS STRING) AS content_id, p_name AS title, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'u' END AS url FROM {part} WHERE p_partkey % 2 = 0"
INV = "SELECT CAST(p_partkey AS STRING) AS content_id, 'inventory' AS title, 'iu' AS url FROM {part} WHERE p_partkey % 3 = 0"
IDS = "SELECT CAST(p_partkey AS STRING) AS content_id FROM {part}"


@register("media_metadata", f"""{duck(s=SIDE, i=INV, x=IDS)} SELECT content_id, CASE WHEN s.content_id IS NOT NULL THEN s.title ELSE i.title END AS title, CASE WHEN s.content_id IS NOT NULL THEN s.url ELSE i.url END AS url FROM x LEFT JOIN s USING (content_id) LEFT JOIN i USING (content_id)""")
def media_metadata(spark: SparkSession, d: str) -> DataFrame:
    """SRC-10."""
    return io.media_metadata(*(made(spark, d, t) for t in (IDS, SIDE, INV)))


AUDIO = "SELECT 'vid' || CAST(p_partkey AS STRING) AS video_id, CASE p_partkey % 4 WHEN 0 THEN 'downloaded' WHEN 1 THEN 'Cached' WHEN 2 THEN 'failed' END AS status, '/a/' || (CASE WHEN p_partkey % 3 = 0 THEN 'x' ELSE 'vid' END) || CAST(p_partkey AS STRING) || (CASE WHEN p_partkey % 5 = 0 THEN '.128k' ELSE '' END) || '.mp3' AS audio_path FROM {part}"


@register("dual_key", f"""{duck(a=AUDIO)} SELECT DISTINCT video_id, unnest([video_id, regexp_extract(audio_path, '/a/([^.]+)', 1)]) AS key FROM a WHERE lower(status) IN ('downloaded', 'cached')""")
def dual_key(spark: SparkSession, d: str) -> DataFrame:
    """SRC-11."""
    return io.dual_key(made(spark, d, AUDIO)).select("video_id", "key")


PATHS = "SELECT '/a/' || (CASE p_partkey % 3 WHEN 0 THEN 'vid' || CAST(p_partkey AS STRING) || '.mp3' WHEN 1 THEN 'vid' || CAST(p_partkey AS STRING) || '.128k.mp3' ELSE 'vid' || CAST(p_partkey AS STRING) || '_tail.wav' END) AS path FROM {part}"


@register("audio_to_video", f"""{duck(p=PATHS, a=AUDIO)}, ids AS (SELECT video_id FROM a) SELECT path, coalesce((SELECT any_value(video_id) FROM a WHERE a.audio_path = path), (SELECT any_value(video_id) FROM ids WHERE video_id = regexp_extract(path, '/a/(.+?)(?:\\.128k)?\\.[^.]+$', 1)),
(SELECT arg_max(video_id, length(video_id)) FROM ids WHERE starts_with(regexp_extract(path, '/a/(.*)', 1), video_id))) AS video_id FROM p""")
def audio_to_video(spark: SparkSession, d: str) -> DataFrame:
    """JON-24."""
    a = made(spark, d, AUDIO)
    return io.audio_to_video(made(spark, d, PATHS), a, a.select("video_id"))


TABS = "SELECT p_partkey % 50 AS id, p_partkey AS seq, CASE p_partkey % 3 WHEN 0 THEN 'videos' WHEN 1 THEN 'shorts' ELSE 'streams' END AS tab, p_name AS title FROM {part}"


@register("merged_inventory", f"""{duck(t=TABS)} SELECT id, arg_min(title, seq) AS title, string_agg(DISTINCT tab, ';' ORDER BY tab) AS tabs FROM t GROUP BY 1""")
def merged_inventory(spark: SparkSession, d: str) -> DataFrame:
    """SRC-17."""
    return io.merge_inventory(made(spark, d, TABS))


TRACKS = "SELECT p_partkey % 40 AS content_id, CASE p_partkey % 7 % 2 WHEN 0 THEN 'manual' ELSE 'automatic' END AS kind, CASE p_partkey % 6 WHEN 0 THEN 'en' WHEN 1 THEN 'en-US' WHEN 2 THEN 'en-GB' WHEN 3 THEN 'fr' WHEN 4 THEN 'en-orig' ELSE 'enx' END AS lang FROM {part}"


@register("chosen_captions", f"""{duck(t=TRACKS)} SELECT content_id, kind, lang FROM (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY kind <> 'manual', lang <> 'en', length(lang), lang) AS r FROM t WHERE lang LIKE 'en%') WHERE r = 1""")
def chosen_captions(spark: SparkSession, d: str) -> DataFrame:
    """SRC-18."""
    return io.choose_caption(made(spark, d, TRACKS)).select("content_id", "kind", "lang")


@register("flattened_words", "SELECT conv_id AS content_id, i // 3 AS seg_no, i % 3 AS word_no, w AS word FROM (SELECT conv_id, turn, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations WHERE turn = 0))")
def flattened_words(spark: SparkSession, d: str) -> DataFrame:
    """SRC-14: first turns as segments of three words."""
    t = table(spark, d, "conversations").where("turn = 0").select(F.col("conv_id").alias("content_id"), F.split("text", " ").alias("ws"))
    words = lambda i: F.transform(F.slice("ws", i * 3 + 1, 3), lambda w: F.struct(w.alias("word")))
    segs = F.transform(F.sequence(F.lit(0), ((F.size("ws") - 1) / 3).cast("int")), lambda i: F.struct(words(i).alias("words")))
    return io.flatten_words(t.select("content_id", segs.alias("segments")))


@register("cluster_members", "SELECT label AS id, vec_id AS file_id FROM embeddings")
def cluster_members(spark: SparkSession, d: str) -> DataFrame:
    """SRC-13."""
    g = table(spark, d, "embeddings").groupBy(F.col("label").alias("id")).agg(F.first("embedding").alias("centroid"), F.collect_list(F.struct(F.col("vec_id").alias("file_id"))).alias("members"))
    return io.cluster_members(g).select("id", "file_id")


RUNS = "SELECT 'b' || CAST(p_partkey AS STRING) AS batch_id, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS superseded, CASE WHEN p_partkey % 4 = 0 THEN 'old' ELSE 'v3' END AS processor_version FROM {part}"
EVID = "SELECT event_id, 'b' || CAST(event_id % 250 AS STRING) AS batch_id FROM {events}"


@register("active_evidence", f"""{duck(r=RUNS, e=EVID)} SELECT event_id FROM e WHERE batch_id IN (SELECT batch_id FROM r WHERE NOT coalesce(superseded, false) AND processor_version = 'v3')""")
def active_evidence(spark: SparkSession, d: str) -> DataFrame:
    """SRC-16."""
    return io.active_evidence(made(spark, d, EVID), made(spark, d, RUNS), "v3").select("event_id")


REGISTRY = "SELECT 'CH' || CAST(p_partkey AS STRING) AS channel_id, 'E' || CAST(p_partkey % 60 AS STRING) AS entity_id, CASE p_partkey % 3 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'true' ELSE 'no' END AS enabled, CASE p_partkey % 4 WHEN 0 THEN 'Verified ' WHEN 1 THEN 'candidate' WHEN 2 THEN 'verified' END AS verification_status FROM {part}"
RESEARCH = "SELECT 'E' || CAST(p_partkey AS STRING) AS entity_id, CASE p_partkey % 2 WHEN 0 THEN ' Full_Channel' ELSE 'partial' END AS acquisition_scope FROM {part} WHERE p_partkey < 80"
OPEN = "lower(trim(enabled)) = 'true' AND lower(trim(verification_status)) = 'verified'"


@register("registry_channels", f"{duck(r=REGISTRY)} SELECT channel_id FROM r WHERE {OPEN}")
def registry_channels(spark: SparkSession, d: str) -> DataFrame:
    """FLT-06."""
    return io.registry_channels(made(spark, d, REGISTRY)).select("channel_id")


@register("full_channels", f"""{duck(r=REGISTRY, s=RESEARCH)}, f AS (SELECT DISTINCT entity_id FROM s WHERE lower(trim(acquisition_scope)) = 'full_channel'), c AS (SELECT * FROM r WHERE {OPEN} AND entity_id IN (SELECT entity_id FROM f))
SELECT channel_id AS id, 'chosen' AS kind FROM c UNION ALL SELECT entity_id, 'missing' FROM f WHERE entity_id NOT IN (SELECT entity_id FROM c)""")
def full_channels(spark: SparkSession, d: str) -> DataFrame:
    """FLT-14."""
    chosen, missing = io.full_channels(made(spark, d, REGISTRY), made(spark, d, RESEARCH))
    return chosen.select(F.col("channel_id").alias("id"), F.lit("chosen").alias("kind")).unionByName(missing.select(F.col("entity_id").alias("id"), F.lit("missing").alias("kind")))


STATUSES = "SELECT CASE WHEN p_partkey % 11 = 0 THEN '' ELSE 'v' || CAST(p_partkey AS STRING) END AS video_id, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'u' END AS url, CASE p_partkey % 4 WHEN 0 THEN 'captioned ' WHEN 1 THEN 'failed' WHEN 2 THEN 'manual' ELSE 'none' END AS status FROM {part}"


@register("status_list", f"{duck(s=STATUSES)} SELECT video_id, trim(status) AS status FROM s WHERE trim(status) IN ('captioned', 'manual') AND video_id <> '' AND url <> ''")
def status_list(spark: SparkSession, d: str) -> DataFrame:
    """FLT-12."""
    return io.with_status(made(spark, d, STATUSES), "captioned, manual,").select("video_id", F.trim("status").alias("status"))


MEDIA = "SELECT p_partkey % 30 AS item, 'f' || CAST(p_partkey AS STRING) AS path, p_partkey % 5 AS mtime, p_partkey % 17 AS size FROM {part}"


@register("picked_media", f"{duck(m=MEDIA)} SELECT item, arg_max(path, (mtime, size, path)) AS path FROM m GROUP BY 1")
def picked_media(spark: SparkSession, d: str) -> DataFrame:
    """SRT-09."""
    return io.pick_media(made(spark, d, MEDIA))


@register("merged_batches", "SELECT p_partkey AS id, p_name AS name, NULL::VARCHAR AS brand FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, NULL, p_brand FROM part WHERE p_partkey % 2 = 1")
def merged_batches(spark: SparkSession, d: str) -> DataFrame:
    """SET-08."""
    p = table(spark, d, "part")
    return io.merge_batches([p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), p.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))])


@register("replaced_rows", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, upper(c_name) FROM customer WHERE c_custkey % 3 = 0")
def replaced_rows(spark: SparkSession, d: str) -> DataFrame:
    """SNK-02."""
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return core.upsert(c, c.where("c_custkey % 3 = 0").withColumn("c_name", F.upper("c_name")), ["c_custkey"])


@register("manifest", "SELECT count(*) AS total, (SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type) FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)) AS counts FROM events")
def manifest(spark: SparkSession, d: str) -> DataFrame:
    """SNK-07, AGG-23."""
    m = io.manifest(table(spark, d, "events"), F.col("event_type"), "m")
    return m.select("total", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


@register("processed_files", f"{duck(f=PATHS)} SELECT path FROM f WHERE NOT path LIKE '%128k%'")
def processed_files(spark: SparkSession, d: str) -> DataFrame:
    """SET-04, STM-08: files that this version has not read."""
    f = made(spark, d, PATHS).withColumn("sha256", F.sha2("path", 256))
    done = f.where("path like '%128k%'").withColumn("version", F.lit("v3")).unionByName(f.withColumn("version", F.lit("v2")))
    return mentions.extract_batch(f, done, "v3").select("path")


# ---- scalars

STR = """SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN '  "Hi,  there." ' WHEN 1 THEN 'A  &  B' WHEN 2 THEN '...' WHEN 3 THEN '' WHEN 4 THEN 'It''s (x) ' || CAST(event_id AS STRING) ELSE 'Jo.Do@x_y-z!' END AS t, CASE event_id % 5 WHEN 0 THEN '20260919' WHEN 1 THEN '1000' WHEN 2 THEN 'x' WHEN 3 THEN '' ELSE '1758240000' END AS day FROM {events}"""


@register("clean_text", rf"""{duck(s=STR)} SELECT id, trim(trim(regexp_replace(t, '\s+', ' ', 'g')), ' .,;:!?()[]{{}}"''' || chr(9) || chr(10) || chr(13)) AS clean, trim(regexp_replace(regexp_replace(lower(t), '[^a-z0-9@._'' -]+', ' ', 'g'), '\s+', ' ', 'g')) AS handle,
coalesce(nullif(regexp_replace(lower(t), '[^a-z0-9@_''-]+', '', 'g'), ''), trim(lower(t))) AS token, substr(t, greatest(0, id % 9 - 2) + 1, id % 9 + 4 - greatest(0, id % 9 - 2)) AS snippet FROM s""")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    """STR-01, STR-03, STR-15."""
    t, at = F.col("t"), (F.col("id") % 9).cast("int")
    return made(spark, d, STR).select("id", X.clean(t).alias("clean"), X.norm_handle(t).alias("handle"), X.norm_caption_token(t).alias("token"), X.snippet(t, at, F.lit(2), 2).alias("snippet"))


@register("dated_text", f"""{duck(s=STR)} SELECT id, CASE day WHEN '20260919' THEN '2026-09-19' WHEN '1000' THEN '1970-01-01' WHEN '1758240000' THEN '2025-09-19' END AS date, CASE day WHEN '20260919' THEN 'DATE' WHEN 'x' THEN 'UNKNOWN' WHEN '' THEN 'UNKNOWN' ELSE 'TIMESTAMP' END AS precision,
epoch_us(to_timestamp(id)::TIMESTAMP + to_seconds(greatest(30, id % 100))) AS lease, strftime(to_timestamp(id)::TIMESTAMP, '%Y%m%dT%H%M%SZ') AS stamp FROM s""")
def dated_text(spark: SparkSession, d: str) -> DataFrame:
    """DTE-01, DTE-02, DTE-04."""
    p, now = X.date_with_precision(F.col("day")), F.timestamp_seconds("id")
    return made(spark, d, STR).select("id", p["date"].cast("string").alias("date"), p["precision"].alias("precision"), F.unix_micros(X.lease_until(now, (F.col("id") % 100).cast("int"))).alias("lease"), X.run_stamp(now).alias("stamp"))


ADDR = """SELECT event_id AS id, CASE event_id % 9 WHEN 0 THEN 'https://www.youtube.com/@name/videos/' WHEN 1 THEN 'https://youtube.com/channel/abc?x=1' WHEN 2 THEN 'https://www.youtube.com/watch?v=1' WHEN 3 THEN 'https://example.org/a/videos/' WHEN 4 THEN 'https://www.youtube.com/playlist?list=2' WHEN 5 THEN ' http://m.youtube.com/c/q/streams'
WHEN 6 THEN 'https://www.youtube.com/user/u/featured' WHEN 7 THEN 'https://www.youtube.com/other' ELSE 'https://www.youtube.com/@a/shorts?list=9' END AS url FROM {events}"""


@register("url_roots", f"""{duck(a=ADDR)} SELECT id, CASE id % 9 WHEN 0 THEN 'https://www.youtube.com/@name' WHEN 1 THEN 'https://youtube.com/channel/abc' WHEN 2 THEN 'https://www.youtube.com/watch?v=1' WHEN 3 THEN 'https://example.org/a/videos' WHEN 4 THEN 'https://www.youtube.com/playlist?list=2' WHEN 5 THEN 'http://m.youtube.com/c/q'
WHEN 6 THEN 'https://www.youtube.com/user/u' WHEN 7 THEN 'https://www.youtube.com/other' ELSE 'https://www.youtube.com/@a/shorts?list=9' END AS root, id % 9 IN (0, 1, 5, 6) AS is_channel FROM a""")
def url_roots(spark: SparkSession, d: str) -> DataFrame:
    """STR-07: expected values worked by hand."""
    return made(spark, d, ADDR).select("id", X.url_root(F.col("url")).alias("r")).select("id", "r.root", "r.is_channel")


@register("overlap_words", "WITH w AS (SELECT conv_id, turn, string_split(lower(text), ' ') AS a, lag(string_split(lower(text), ' ')) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations) SELECT conv_id, turn, CASE WHEN b IS NULL THEN 0 ELSE list_max(list_filter(range(least(len(a), len(b), 30) + 1), lambda k: k = 0 OR b[len(b) - k + 1:] = a[1:k])) END AS overlap FROM w")
def overlap_words(spark: SparkSession, d: str) -> DataFrame:
    """ARR-02, WIN-06: words of a turn that repeat the end of the one before."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    t = table(spark, d, "conversations").withColumn("a", F.split(F.lower("text"), " "))
    t = t.withColumn("b", F.coalesce(F.lag("a").over(w), F.expr("cast(array() as array<string>)")))
    return t.select("conv_id", "turn", X.overlap_suffix_prefix(F.col("b"), F.col("a"), 30).alias("overlap"))


@register("array_ops", "SELECT conv_id, array_to_string(list_sort(list_distinct(list(role))), ',') AS roles, len(list(role)) AS n, list_contains(list(role), 'system') AS has_system, array_to_string(list(turn ORDER BY turn)[1:2], ',') AS first_two FROM conversations GROUP BY 1")
def array_ops(spark: SparkSession, d: str) -> DataFrame:
    """ARR-01."""
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list("role").alias("r"), F.array_sort(F.collect_list("turn")).alias("t"))
    return g.select("conv_id", F.array_join(F.array_sort(F.array_distinct("r")), ",").alias("roles"), F.size("r").alias("n"), F.array_contains("r", "system").alias("has_system"), F.array_join(F.transform(F.slice("t", 1, 2), lambda x: x.cast("string")), ",").alias("first_two"))


# ---- mentions

NAMES = """SELECT event_id AS id, CASE event_id % 24 WHEN 0 THEN 'We''re Home' WHEN 1 THEN 'NASA' WHEN 2 THEN 'McDonald' WHEN 3 THEN 'Acme Labs' WHEN 4 THEN 'Acme labs' WHEN 5 THEN 'The Office' WHEN 6 THEN 'Mary Jones. I' WHEN 7 THEN 'ab' WHEN 8 THEN 'www.x.com' WHEN 9 THEN 'john smith' WHEN 10 THEN 'acme research group of the north west'
WHEN 11 THEN 'Bank of America' WHEN 12 THEN 'Jones Because' WHEN 13 THEN 'Place Name' WHEN 14 THEN 'Boston' WHEN 15 THEN 'One Two Three Four Five Six Seven' WHEN 16 THEN 'it''s' WHEN 17 THEN 'Dr. Who Knows' WHEN 18 THEN 'U-2' WHEN 19 THEN 'Anna & Co' WHEN 20 THEN 'Late Then' WHEN 21 THEN 'NATO Summit' WHEN 22 THEN '"Quoted Name"' ELSE 'x y z' END AS surface,
CASE event_id % 5 WHEN 0 THEN 'proper_case' WHEN 1 THEN 'cue_person' WHEN 2 THEN 'cue_entity_named' WHEN 3 THEN 'url' ELSE 'proper_case' END AS signal, CASE WHEN event_id % 7 = 0 THEN 'website' ELSE 'person' END AS kind, CASE WHEN event_id % 11 = 0 THEN 'E1' ELSE '' END AS canonical, event_id % 3 AS contents, CASE WHEN event_id % 13 = 0 THEN 'Approved ' ELSE 'new' END AS prior FROM {events}"""
LISTS = """stop AS (SELECT unnest(string_split('a an the this that these those there here and but or so because for with from into when what why how who where today yesterday tomorrow we you they he she it i me my our your their his her its is are was were be been being have has had do does did can could will would should may might must not no yes yeah mhm uh um right okay ok well now then just really actually basically exactly absolutely probably maybe anyway again all one two three four five look see sure good great wow', ' ')) AS w),
bad AS (SELECT w FROM stop UNION SELECT unnest(string_split('someone somebody something people person thing things way kind lot number new same in on at to from about into over under near around through taking place based', ' '))),
fin AS (SELECT w FROM stop UNION SELECT unnest(string_split('because who that which where when if then so but however although though while was were is are has have had will would can could should may might must', ' ')))"""


@register("candidate_gate", rf"""{duck(n=NAMES)}, {LISTS}, c AS (SELECT *, trim(surface, ' ."') AS raw FROM n), t AS (SELECT *, string_split(raw, ' ') AS tk FROM c), u AS (SELECT *, trim(lower(tk[1]), '.,;:!?()[]{{}}"''') AS f, trim(lower(tk[-1]), '.,;:!?()[]{{}}"''') AS l, len(tk) AS k FROM t)
SELECT id, CASE WHEN canonical <> '' OR lower(trim(prior)) IN ('approved', 'existing', 'accepted') THEN true WHEN signal = 'url' OR kind = 'website' THEN true WHEN length(raw) < 3 THEN false WHEN signal = 'proper_case' AND regexp_matches(raw, '[.!?]') THEN false
WHEN f IN (SELECT w FROM bad) OR l IN (SELECT w FROM fin) OR regexp_matches(f, '^(i|we|you|they|he|she|it|that|what|there|here)''?(m|re|ve|d|ll|s|t)?$') OR regexp_matches(l, '^(i|we|you|they|he|she|it|that|what|there|here)''?(m|re|ve|d|ll|s|t)?$') THEN false
WHEN signal = 'cue_person' THEN k <= 5 WHEN signal = 'cue_entity_named' THEN k <= 6 WHEN k = 1 THEN regexp_matches(raw, '^[A-Z0-9&-]{{2,12}}$') OR regexp_matches(raw, '^.+[A-Z]') OR contents >= 2
ELSE k <= 6 AND len(list_filter(tk, lambda x: NOT (lower(x) IN ('of', 'the', 'and', 'for', 'de', 'del', 'van', 'von', 'la', 'le', '&') OR regexp_matches(x, '^[A-Z][A-Za-z0-9&''-]*$')))) = 0 END AS eligible FROM u""")
def candidate_gate(spark: SparkSession, d: str) -> DataFrame:
    """TXT-09, FLT-11."""
    n = made(spark, d, NAMES)
    return n.select("id", mentions.eligible(F.col("surface"), F.array("signal"), F.col("kind"), F.col("canonical"), F.col("contents"), F.col("prior")).alias("eligible"))


CTX = """SELECT event_id AS id, CASE event_id % 9 WHEN 0 THEN 'on the radio with' WHEN 1 THEN 'at the summit of the agency' WHEN 2 THEN 'the FDA said' WHEN 3 THEN 'a nonprofit for' WHEN 4 THEN 'wrote the book' WHEN 5 THEN 'nothing here' WHEN 6 THEN 'showing off' WHEN 7 THEN 'news from the app' ELSE '' END AS ctx,
CASE event_id % 4 WHEN 0 THEN 'One' WHEN 1 THEN 'One Two' WHEN 2 THEN 'x.com' ELSE 'One Two Three Four Five Six' END AS name FROM {events}"""


@register("context_classes", f"""{duck(c=CTX)} SELECT id, CASE id % 9 WHEN 0 THEN 'media_show' WHEN 1 THEN 'event' WHEN 2 THEN 'government' WHEN 3 THEN 'organization' WHEN 4 THEN 'product' WHEN 7 THEN 'organization' ELSE CASE id % 4 WHEN 1 THEN 'person_or_named_entity' WHEN 2 THEN 'website' ELSE 'named_entity' END END AS kind FROM c""")
def context_classes(spark: SparkSession, d: str) -> DataFrame:
    """TXT-10: expected values worked by hand."""
    return made(spark, d, CTX).select("id", mentions.context_class(F.col("ctx"), F.col("name")).alias("kind"))


MASTER = """SELECT 'k' || CAST(event_id % 60 AS STRING) AS candidate_key, 'Name ' || CAST(event_id % 60 AS STRING) || (CASE WHEN event_id % 2 = 0 THEN '' ELSE ' X' END) AS display, CASE WHEN event_id % 60 % 9 = 0 THEN 'website' ELSE 'person' END AS kind, 'C' || CAST(event_id % 37 AS STRING) AS content_id, 'p' || CAST(event_id % 5 AS STRING) AS source_path,
CASE WHEN event_id % 4 = 0 THEN '' ELSE 'S' || CAST(event_id % 3 AS STRING) END AS speaker, CASE event_id % 3 WHEN 0 THEN 'proper_case' WHEN 1 THEN 'cue_person' ELSE 'known' END AS signal, CASE WHEN event_id % 10 = 0 THEN '' ELSE '2026-01-' || CAST(10 + event_id * 7 % 19 AS STRING) END AS processed_at, 'b' || CAST(event_id % 11 AS STRING) AS batch_id,
CASE WHEN event_id % 60 % 7 = 0 THEN 'E' || CAST(event_id % 60 AS STRING) ELSE '' END AS canonical_id, 'snip ' || CAST(event_id AS STRING) AS snippet, event_id AS seq FROM {events}"""
STATE = "SELECT 'k' || CAST(event_id AS STRING) AS candidate_key, CASE event_id % 3 WHEN 0 THEN 'approved' WHEN 1 THEN '' ELSE 'rejected' END AS review_status, CASE event_id % 3 WHEN 0 THEN 'A1' ELSE '' END AS approved_id, 'n' AS notes FROM {events} WHERE event_id < 30"


@register("master_candidates", f"""{duck(m=MASTER, s=STATE)}, g AS (SELECT candidate_key, arg_min(display, seq) AS display, arg_min(kind, seq) AS kind, arg_min(content_id, seq) AS content_id, arg_min(snippet, seq) AS snippet, arg_min(canonical_id, seq) AS canonical_id, count(*) AS mentions, count(DISTINCT content_id) AS contents, count(DISTINCT source_path) AS sources,
count(DISTINCT nullif(speaker, '')) AS speakers, string_agg(DISTINCT signal, ';' ORDER BY signal) AS signals, min(nullif(processed_at, '')) AS first_seen, max(nullif(processed_at, '')) AS last_seen, arg_min(batch_id, (processed_at, seq)) FILTER (WHERE processed_at <> '') AS first_batch, arg_max(batch_id, (processed_at, seq)) FILTER (WHERE processed_at <> '') AS last_batch FROM m GROUP BY 1),
x AS (SELECT g.*, s.review_status AS rs, s.approved_id AS ap, s.notes, CASE WHEN canonical_id <> '' THEN 100 ELSE 0 END + CASE WHEN kind = 'website' THEN 30 ELSE 0 END + CASE WHEN signals LIKE '%known%' THEN 100 ELSE 0 END + CASE WHEN signals LIKE '%cue\\_%' ESCAPE '\\' THEN 25 ELSE 0 END + CASE WHEN signals LIKE '%proper\\_case%' ESCAPE '\\' THEN 8 ELSE 0 END
+ least(20, 2 * mentions) + least(30, 5 * contents) + least(10, 2 * speakers) AS score FROM g LEFT JOIN s USING (candidate_key))
SELECT candidate_key, display, kind, content_id, snippet, mentions, contents, sources, speakers, signals, first_seen, last_seen, first_batch, last_batch, score, CASE WHEN canonical_id <> '' THEN 'EXISTING' WHEN score >= 45 THEN 'HIGH' WHEN score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS priority,
coalesce(nullif(rs, ''), CASE WHEN canonical_id <> '' THEN 'existing' ELSE 'new' END) AS review_status, coalesce(nullif(ap, ''), nullif(canonical_id, ''), '') AS approved_id FROM x
WHERE canonical_id <> '' OR rs IN ('approved', 'existing', 'accepted') OR kind = 'website' OR signals LIKE '%cue\\_person%' ESCAPE '\\'""")
def master_candidates(spark: SparkSession, d: str) -> DataFrame:
    """AGG-02, TXT-11, TXT-13, MTH-07."""
    m = mentions.master(made(spark, d, MASTER), made(spark, d, STATE))
    return m.select("candidate_key", "display", "kind", "content_id", "snippet", "mentions", "contents", "sources", "speakers", F.array_join("signals", ";").alias("signals"), "first_seen", "last_seen", "first_batch", "last_batch", "score", "priority", "review_status", "approved_id")


SURFACES = """SELECT event_id AS seq, CASE event_id % 5 WHEN 0 THEN 'Acme' WHEN 1 THEN ' ACME ' WHEN 2 THEN 'Jo_Do!' WHEN 3 THEN 'n' || CAST(event_id % 40 AS STRING) ELSE '' END AS surface, CASE WHEN event_id % 11 = 0 THEN 'E1' ELSE '' END AS canonical_id, 'C' || CAST(event_id % 9 AS STRING) AS content_id,
CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'org' ELSE 'person' END AS entity_type, CASE event_id % 4 WHEN 0 THEN 'Acme Inc' WHEN 1 THEN 'Acne' ELSE '' END AS correction FROM {events}"""


@register("surface_rollup", rf"""{duck(s=SURFACES)}, m AS (SELECT *, trim(regexp_replace(regexp_replace(lower(surface), '[^a-z0-9@._'' -]+', ' ', 'g'), '\s+', ' ', 'g')) AS key FROM s WHERE canonical_id = ''), r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq) AS k FROM m WHERE key <> ''),
c AS (SELECT key, '{{' || string_agg('"' || correction || '":' || n, ',' ORDER BY correction) || '}}' AS j FROM (SELECT key, correction, count(*) AS n FROM r WHERE correction <> '' GROUP BY 1, 2) GROUP BY 1)
SELECT key, arg_min(surface, (-length(surface), seq)) FILTER (WHERE k <= 5) AS display, string_agg(surface, '|' ORDER BY seq) FILTER (WHERE k <= 5) AS examples, count(*) AS mentions, count(DISTINCT content_id) AS contents, coalesce(arg_max(entity_type, seq) FILTER (WHERE entity_type <> ''), '') AS entity_type, coalesce(any_value(j), '{{}}') AS corrections_json FROM r LEFT JOIN c USING (key) GROUP BY key""")
def surface_rollup(spark: SparkSession, d: str) -> DataFrame:
    """AGG-13, MAP-01."""
    return mentions.surface_rollup(made(spark, d, SURFACES)).withColumn("examples", F.array_join("examples", "|"))


@register("ranked_channels")
def ranked_channels(spark: SparkSession, d: str) -> DataFrame:
    """SRC-19, STR-09: part names as search results for brands."""
    p = table(spark, d, "part").select(F.col("p_brand").alias("entity_id"), F.col("p_brand").alias("entity_name"), F.concat(F.lit("CH"), (F.col("p_partkey") % 20).cast("string")).alias("channel_id"), F.col("p_name").alias("channel_name"), F.col("p_partkey").alias("seq"))
    return io.rank_channels(p).select("entity_id", "channel_id", "channel_name", F.round("similarity", 4).alias("similarity"), "rank")


@register("priority_order", f"""{duck(m=MASTER)} SELECT candidate_key, row_number() OVER (ORDER BY p, n DESC, candidate_key) AS place FROM (SELECT candidate_key, count(*) AS n, CASE (ascii(substr(candidate_key, 2, 1)) % 5) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 4 END AS p FROM m GROUP BY 1)""")
def priority_order(spark: SparkSession, d: str) -> DataFrame:
    """SRT-01: EXISTING, HIGH, MEDIUM, LOW, then others."""
    from pyspark.sql import Window

    k = F.ascii(F.substring("candidate_key", 2, 1)) % 5
    names = F.when(k == 0, "EXISTING").when(k == 1, "HIGH").when(k == 2, "MEDIUM").when(k == 3, "LOW").otherwise("OTHER")
    g = made(spark, d, MASTER).groupBy("candidate_key").agg(F.count(F.lit(1)).alias("n"))
    # the candidates of a review queue: a total order is the feature
    return g.select("candidate_key", F.row_number().over(Window.orderBy(X.priority_rank(names), F.desc("n"), "candidate_key")).alias("place"))


from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import core
from ..operators.graph import saved


def _missing(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-01: header CSV with or without a byte order mark; unknown columns go, absent ones are NULL, a missing file is empty."""
    want = spark.createDataFrame([], schema)
    try:
        raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    except Exception as e:
        if _missing(e):
            return want
        raise
    names = {c.lstrip("﻿"): c for c in raw.columns}
    cell = lambda f: F.col(f"`{names[f.name]}`").try_cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType)
    return raw.select(*[cell(f).alias(f.name) for f in want.schema.fields])


def numbered_lines(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """path, line_no (from 0), line of text files, which are read in splits: no task has a whole file. An error if there is
    no such path; an empty file has no lines, a null path none.

    A row knows the split it was read from and its place in it. The rows are written once with both, so that numbers do not
    depend on how splits fall to tasks; a split's first number is the sum of the lines of its file's earlier splits. Only
    these sums, a row a split, are ordered by file."""
    raw = spark.read.option("recursiveFileLookup", recursive).option("lineSep", "\n").text(path)
    at = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    lines = saved(raw.select(*at, F.monotonically_increasing_id().alias("n"), F.col("value").alias("line")), "lines")
    blocks = lines.groupBy("path", "block").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("many"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", "first", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("base"))
    return lines.join(blocks, ["path", "block"]).select("path", (F.col("base") + F.col("n") - F.col("first")).cast("int").alias("line_no"), "line")


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False, recursive: bool = True, numbered: bool = True) -> DataFrame:
    """SRC-02, SRC-03: path, line_no (blank lines count) and the fields of each line. Malformed lines go, or stop a strict
    scan. Files of any size are read in splits; numbered lines are written once on the way (numbered_lines), without them
    line_no is NULL."""
    try:
        if numbered:
            lines = numbered_lines(spark, path, recursive)
        else:
            files = spark.read.option("recursiveFileLookup", recursive).text(path)
            lines = files.select(F.col("_metadata.file_path").alias("path"), F.lit(None).cast("int").alias("line_no"), F.col("value").alias("line"))
    except Exception as e:
        if _missing(e):
            return spark.createDataFrame([], f"path string, line_no int, {schema}")
        raise
    lines = lines.where(F.col("line").rlike(r"\S"))
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    kind = schema if strict else f"{schema}, _bad string"
    options = mode if strict else mode | {"columnNameOfCorruptRecord": "_bad"}
    rows = lines.select("path", "line_no", F.from_json("line", kind, options).alias("r"))
    out = rows.select("path", "line_no", "r.*")
    return out if strict else out.where("_bad is null").drop("_bad")


def keyed_lines(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """SRC-04: the last line of each key."""
    return core.latest(json_lines(spark, path, schema).where(F.col(key).isNotNull()), [key], ["path", "line_no"])


SEGMENT = "start double, end double, text string"
DIARIZED = "video_id string, speaker_id string, start_seconds double, end_seconds double, text string"


def segment_scan(spark: SparkSession, root: str) -> DataFrame:
    """SRC-05, SRC-07, TXT-03, SET-01: caption and diarized segments as one relation with source_type and content_id."""
    p = F.col("path")
    cap = json_lines(spark, f"{root}/*/*/*.segments.jsonl", SEGMENT).select(
        F.lit("caption").alias("source_type"), "path", F.regexp_extract(p, r"([^/]+)\.segments\.jsonl$", 1).alias("content_id"), F.col("line_no").alias("cue_index"),
        "start", F.coalesce("end", "start").alias("end"), "text", F.lit(None).cast("string").alias("speaker_id"))
    dia = json_lines(spark, f"{root}/*/*/diarized_transcript.jsonl", DIARIZED).select(
        F.lit("diarized").alias("source_type"), "path", F.col("video_id").alias("content_id"), F.col("line_no").alias("cue_index"),
        F.col("start_seconds").alias("start"), F.col("end_seconds").alias("end"), "text", "speaker_id")
    return cap.unionByName(dia)


def production_only(df: DataFrame, path: str = "path") -> DataFrame:
    """SRC-06."""
    return df.where(F.col(path).rlike(r"(?i)/YT\d+/"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SRC-08: path, sha256."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha256"))


CUE = r"(?m)^((?:\d+:)?\d{2}:\d{2}[.,]\d{3})\s+-->\s+((?:\d+:)?\d{2}:\d{2}[.,]\d{3})[^\n]*\n((?:.+\n?)*)"


def vtt_cues(files: DataFrame) -> DataFrame:
    """SRC-09, WIN-05, TXT-01: files (content_id, value) to content_id, start, end, text; equal texts in a row are one cue."""
    blocks = F.split(F.regexp_replace("value", "\r\n", "\n"), r"\n\s*\n")
    b = files.select("content_id", F.posexplode(blocks).alias("pos", "block")).where(F.col("block").contains("-->"))
    times = r"((?:\d+:)?\d{2}:\d{2}[.,]\d{3})\s+-->\s+((?:\d+:)?\d{2}:\d{2}[.,]\d{3})[^\n]*"
    cue = b.select(
        "content_id", "pos", X.vtt_seconds(F.regexp_extract("block", times, 1)).alias("start"), X.vtt_seconds(F.regexp_extract("block", times, 2)).alias("end"),
        X.squeeze(X.unescape(F.regexp_replace("block", r"(?s)^.*?-->[^\n]*\n?", ""))).alias("text")).where("text <> ''")
    before = F.lag("text").over(Window.partitionBy("content_id").orderBy("pos"))
    runs = core.islands(cue.withColumn("__b", before), ["content_id"], ["pos"], F.col("__b").isNull() | (F.col("__b") != F.col("text")), "run")
    return runs.groupBy("content_id", "run", "text").agg(F.min("start").alias("start"), F.max("end").alias("end")).select("content_id", F.col("run").cast("int").alias("cue_index"), "start", "end", "text")


def media_metadata(ids: DataFrame, sidecar: DataFrame, inventory: DataFrame) -> DataFrame:
    """SRC-10: each id with its own metadata record, else the inventory's row, as a whole. Both: content_id and equal columns."""
    rest = [c for c in sidecar.columns if c != "content_id"]
    a = sidecar.select("content_id", F.struct(*rest).alias("a"))
    b = inventory.select("content_id", F.struct(*rest).alias("b"))
    return ids.join(a, "content_id", "left").join(b, "content_id", "left").select("content_id", F.coalesce("a", "b").alias("m")).select("content_id", "m.*")


def dual_key(manifest: DataFrame) -> DataFrame:
    """SRC-11: rows of usable audio under both of their keys (video_id and the file's stem)."""
    stem = F.regexp_extract("audio_path", r"([^/\\]+?)(?:\.128k)?\.[^./\\]+$", 1)
    return manifest.where(F.lower("status").isin("downloaded", "cached")).withColumn("key", F.explode(F.array_distinct(F.array("video_id", stem))))


def audio_to_video(paths: DataFrame, manifest: DataFrame, names: DataFrame) -> DataFrame:
    """JON-24: path to video id by the path, else its stem without .128k, else the longest id that its name begins with.

    A prefix is an equal key: names are cut at the lengths that ids have, of which there are few."""
    name = F.regexp_extract("path", r"([^/\\]+)$", 1)
    p = paths.select("path", name.alias("name"), F.regexp_extract(name, r"^(.+?)(?:\.128k)?\.[^.]+$", 1).alias("stem"))
    by_path = manifest.select(F.col("audio_path").alias("path"), F.col("video_id").alias("v1"))
    ids = names.select("video_id").distinct()
    lengths = [F.lit(r.n) for r in ids.select(F.length("video_id").alias("n")).distinct().collect()] or [F.lit(1)]
    heads = p.select("path", "name", F.explode(F.array_distinct(F.array(*[F.left("name", n) for n in lengths]))).alias("video_id"))
    # very many names can begin with one short id: heads are counted first, and the few frequent ones among ids are broadcast
    found = saved(heads.groupBy("video_id").agg(F.count(F.lit(1)).alias("n")).join(ids, "video_id"), "heads")
    often = F.col("n") > max(1000, (found.agg(F.sum("n")).first()[0] or 0) // 4000)  # 4,000 ids at most
    few, rest = found.where(often).select("video_id"), found.where(~often).select("video_id")
    heads = heads.join(F.broadcast(few), "video_id", "left_semi").unionByName(heads.join(F.broadcast(few), "video_id", "left_anti").join(rest, "video_id", "left_semi"))
    longest = heads.groupBy("path", "name").agg(F.max(F.length("video_id")).alias("n")).select("path", F.expr("left(name, n)").alias("v3"))
    out = p.join(by_path, "path", "left").join(ids.select(F.col("video_id").alias("stem"), F.col("video_id").alias("v2")), "stem", "left").join(longest, "path", "left")
    return out.select("path", F.coalesce("v1", "v2", "v3").alias("video_id"))


def merge_inventory(rows: DataFrame) -> DataFrame:
    """SRC-17: one row per id, the first seen, with all its tabs. rows: id, seq, tab and more."""
    rest = [c for c in rows.columns if c not in ("id", "seq", "tab")]
    g = rows.groupBy("id").agg(F.min_by(F.struct(*rest), "seq").alias("r"), F.array_join(F.array_sort(F.collect_set("tab")), ";").alias("tabs"))
    return g.select("id", "r.*", "tabs")


def choose_caption(tracks: DataFrame, pattern: str = "^en") -> DataFrame:
    """SRC-18: per content the best track: manual before automatic, 'en' before others, shorter names first."""
    ok = tracks.where(F.col("lang").rlike(pattern))
    order = [F.when(F.col("kind") == "manual", 0).otherwise(1), F.when(F.col("lang") == "en", 0).otherwise(1), F.length("lang"), F.col("lang")]
    return core.topk(ok, ["content_id"], order, 1).drop("rank")


def flatten_words(maps: DataFrame) -> DataFrame:
    """SRC-14: words of a nested map in order: content_id, segments array<struct<..., words array<struct<...>>>>."""
    seg = maps.select("content_id", F.posexplode("segments").alias("seg_no", "seg"))
    return seg.select("content_id", "seg_no", F.posexplode("seg.words").alias("word_no", "w")).select("content_id", "seg_no", "word_no", "w.*")


def cluster_members(manifest: DataFrame) -> DataFrame:
    """SRC-13: id, centroid, members[] to one row per member."""
    return manifest.select("id", "centroid", F.explode("members").alias("m")).select("id", "centroid", "m.*")


def active_evidence(evidence: DataFrame, manifests: DataFrame, version: str) -> DataFrame:
    """SRC-16: evidence of runs that stand and come from this version."""
    ok = manifests.where((F.coalesce("superseded", F.lit(False)) == False) & (F.col("processor_version") == version)).select("batch_id")  # noqa: E712
    return evidence.join(ok, "batch_id", "left_semi")


def attribution_scan(spark: SparkSession, root: str) -> DataFrame:
    """SRC-15: all caption_speaker_attribution.csv below root: video_id, start, end, text, raw_speaker, status. Rows whose
    times cannot be read go; an empty end is the start."""
    fields = "video_id string, start_seconds string, end_seconds string, text string, raw_speaker_id string, speaker_attribution_status string"
    r = read_csv(spark, f"{root}/*/caption_speaker_attribution.csv", fields)
    number = lambda c, d: F.when(F.coalesce(F.trim(c), F.lit("")) == "", d).otherwise(F.col(c).try_cast("double"))
    r = r.withColumn("start", number("start_seconds", F.lit(0.0))).withColumn("end", number("end_seconds", F.col("start"))).where("start is not null and end is not null")
    return r.select("video_id", "start", "end", F.coalesce("text", F.lit("")).alias("text"), F.col("raw_speaker_id").alias("raw_speaker"), F.col("speaker_attribution_status").alias("status"))


def registry_channels(rows: DataFrame) -> DataFrame:
    """FLT-06: enabled and verified channels."""
    is_ = lambda c, v: F.lower(F.trim(F.coalesce(c, F.lit("")))) == v
    return rows.where(is_("enabled", "true") & is_("verification_status", "verified"))


def with_status(rows: DataFrame, statuses: str) -> DataFrame:
    """FLT-12: rows of the statuses in a comma-separated list that have an id and an address."""
    wanted = [s.strip() for s in statuses.split(",") if s.strip()]
    return rows.where(F.trim(F.coalesce("status", F.lit(""))).isin(wanted) & X.nz("video_id").isNotNull() & X.nz("url").isNotNull())


def full_channels(registry: DataFrame, research: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT-14: channels of the entities to be read in full, and those entities without a channel, which there must not be."""
    full = research.where(F.lower(F.trim("acquisition_scope")) == "full_channel").select("entity_id").distinct()
    chosen = registry_channels(registry).join(full, "entity_id", "left_semi")
    return chosen, full.join(chosen, "entity_id", "left_anti")


def rank_channels(found: DataFrame) -> DataFrame:
    """SRC-19: search results (entity_id, entity_name, channel_id, channel_name, seq) as candidates: per entity and channel
    the result with the most similar name (the first of equals), ranked within the entity."""
    from ..operators.mentions import ratio

    s = found.where(X.nz("channel_id").isNotNull()).withColumn("similarity", ratio(X.norm_tokens(F.col("entity_name")), X.norm_tokens(F.col("channel_name"))))
    best = s.groupBy("entity_id", "channel_id").agg(F.min_by(F.struct("channel_name", "similarity", "seq"), F.struct((-F.col("similarity")).alias("s"), "seq")).alias("b")).select("entity_id", "channel_id", "b.*")
    return core.topk(best, ["entity_id"], [F.desc("similarity"), F.asc("seq")], 2**31 - 1)


def merge_batches(batches: list[DataFrame]) -> DataFrame:
    """SET-08: attribution batches as one table, absent columns NULL."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def pick_media(files: DataFrame) -> DataFrame:
    """SRT-09: of each item's files (item, path, mtime, size) the newest, of equals the largest."""
    return files.groupBy("item").agg(F.max_by("path", F.struct("mtime", "size", "path")).alias("path"))


def write_csv(df: DataFrame, path: str, fields: list[str]) -> None:
    """SNK-01: the listed fields, absent ones empty."""
    have = set(df.columns)
    df.select(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in have else F.lit("").alias(f) for f in fields]).write.mode("overwrite").csv(path, header=True, escape='"')


def write_json_lines(df: DataFrame, path: str, key: str) -> None:
    """SNK-03: in key order over all files."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").json(path)


def write_snapshot(df: DataFrame, path: str, part: str = "snapshot_id") -> None:
    """GRF-09, STM-08: replaces the partitions that df holds and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def manifest(df: DataFrame, by: Column, name: str) -> DataFrame:
    """SNK-07, AGG-23: one row: total and counts by a status."""
    n = df.groupBy(by.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.sum("n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("k", F.lit("")), "n")))).alias(name))

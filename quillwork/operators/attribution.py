"""Speaker attribution of cues and units, caption folding, sampling (VOI-*, TXT-02, WIN-07)."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import core


def status_of(coverage: Column, first: Column, second: Column, floor: float = 0.35) -> Column:
    """Thresholds of VOI-01: HIGH .80 / .20, MEDIUM .65 / .35."""
    return (
        F.when(F.coalesce(coverage, F.lit(0.0)) < floor, "NO_SPEECH_MATCH").when((first >= 0.80) & (second <= 0.20), "ATTRIBUTED_HIGH")
        .when((first >= 0.65) & (second <= 0.35), "ATTRIBUTED_MEDIUM").otherwise("AMBIGUOUS")
    )


def dense(cues: DataFrame, segments: DataFrame, width: float = 30.0) -> DataFrame:
    """VOI-01, AGG-12, WIN-02: cues (content_id, cue_index, start, end) by overlap with speakers' segments (content_id,
    speaker, seg_start, seg_end): speaker, coverage, first and second share, speakers, status."""
    ov = core.interval_join(cues.select("content_id", "cue_index", "start", "end"), segments, ["content_id"], ("start", "end"), ("seg_start", "seg_end"), width)
    per = ov.groupBy("content_id", "cue_index", "start", "end", "speaker").agg(F.sum("ov").alias("mass"))
    cue = Window.partitionBy("content_id", "cue_index")
    ranked = per.withColumns({"total": F.sum("mass").over(cue), "n": F.count(F.lit(1)).over(cue), "r": F.row_number().over(cue.orderBy(F.desc("mass"), "speaker"))})
    best = ranked.groupBy("content_id", "cue_index").agg(
        F.max(F.when(F.col("r") == 1, F.col("speaker"))).alias("speaker"), F.max(F.when(F.col("r") == 1, F.col("mass") / F.col("total"))).alias("first_share"),
        F.coalesce(F.max(F.when(F.col("r") == 2, F.col("mass") / F.col("total"))), F.lit(0.0)).alias("second_share"), F.max("n").alias("speakers"), F.max("total").alias("total"))
    out = cues.join(best, ["content_id", "cue_index"], "left")
    out = out.withColumn("coverage", F.when(F.col("end") > F.col("start"), F.least(F.lit(1.0), F.coalesce("total", F.lit(0.0)) / (F.col("end") - F.col("start")))).otherwise(0.0)).drop("total")
    return out.withColumn("status", status_of(F.col("coverage"), F.col("first_share"), F.col("second_share")))


def choose_speaker(segments: DataFrame, turns: DataFrame, width: float = 30.0) -> DataFrame:
    """VOI-14, JON-07: segments (content_id, cue_index, start, end) with the speaker of most overlap, of equals the one
    heard first, and the share of the segment that it covers; UNKNOWN_SPEAKER for none."""
    ov = core.interval_join(segments, turns, ["content_id"], ("start", "end"), ("seg_start", "seg_end"), width)
    per = ov.groupBy("content_id", "cue_index", "speaker").agg(F.sum("ov").alias("m"), F.min("seg_start").alias("s"))
    best = per.groupBy("content_id", "cue_index").agg(F.min_by(F.struct("speaker", "m"), F.struct((-F.col("m")).alias("a"), "s", "speaker")).alias("b"))
    out = segments.join(best, ["content_id", "cue_index"], "left")
    share = F.least(F.lit(1.0), F.coalesce("b.m", F.lit(0.0)) / F.greatest(F.lit(0.001), F.col("end") - F.col("start")))
    return out.select(*segments.columns, F.coalesce("b.speaker", F.lit("UNKNOWN_SPEAKER")).alias("speaker"), share.alias("share"))


def sparse(cues: DataFrame, samples: DataFrame, near: float = 60.0, bracket: float = 150.0) -> DataFrame:
    """VOI-03: cues (content_id, cue_index, t the centre) by voice samples (content_id, sample_cue, t, voice): voice,
    status, method. Two neighbours of different voices are a conflict whatever their distance; the bracket's distance
    counts for equal voices only. Of two nearest samples the earlier counts."""
    b = core.asof_both(cues, samples.select("content_id", "t", "voice", "sample_cue"), ["content_id"], "t", ["voice", "sample_cue"])
    far = F.lit(1e18)
    back, ahead = F.coalesce(F.col("t") - F.col("prev_t"), far), F.coalesce(F.col("next_t") - F.col("t"), far)
    pick = lambda c: F.when(back <= ahead, F.col(f"prev_{c}")).otherwise(F.col(f"next_{c}"))
    both = F.col("prev_t").isNotNull() & F.col("next_t").isNotNull()
    same = F.col("prev_voice") == F.col("next_voice")
    method = (
        F.when(F.col("prev_t").isNull() & F.col("next_t").isNull(), "sparse_no_sample").when(pick("sample_cue") == F.col("cue_index"), "sparse_exact_sample")
        .when(both & same & (back <= bracket) & (ahead <= bracket), "sparse_same_voice_bracket").when(both & ~same, "sparse_conflicting_bracket")
        .when(F.least(back, ahead) <= near, "sparse_nearest").otherwise("sparse_sample_too_distant")
    )
    b = b.withColumn("method", method)
    m = F.col("method")
    status = (
        F.when(m == "sparse_no_sample", "NO_SPEECH_MATCH").when(m.isin("sparse_exact_sample", "sparse_same_voice_bracket"), "ATTRIBUTED_HIGH")
        .when(m == "sparse_nearest", "ATTRIBUTED_MEDIUM").otherwise("AMBIGUOUS")
    )
    voice = F.when(m == "sparse_same_voice_bracket", F.col("prev_voice")).when(status.startswith("ATTRIBUTED"), pick("voice"))
    return b.select(*cues.columns, voice.alias("voice"), status.alias("status"), "method")


# What a cue's status counts in a unit's vote; others 0.6.
STATUS_WEIGHT = {"ATTRIBUTED_HIGH": 1.0, "ATTRIBUTED_MEDIUM": 0.8, "AMBIGUOUS": 0.45, "NO_SPEECH_MATCH": 0.0}


def exact_key(start: str, end: str, text: str) -> list[Column]:
    """JON-08: rounded times and normalised text."""
    return [F.round(F.col(start), 3), F.round(F.col(end), 3), F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))]


def exact_attribution(units: DataFrame, cues: DataFrame) -> DataFrame:
    """JON-08: units (content_id, unit_id, start, end, text) with the cue of the very same place and text, the last one
    of equals (c_start, c_end, c_text, seq, raw_speaker, status): unit_id, speaker, status."""
    keys = [f"__k{i}" for i in range(3)]
    c = cues.select("content_id", *[k.alias(n) for k, n in zip(exact_key("c_start", "c_end", "c_text"), keys, strict=True)], "seq", F.struct(F.col("raw_speaker").alias("speaker"), "status").alias("r"))
    c = c.groupBy("content_id", *keys).agg(F.max_by("r", "seq").alias("r"))
    u = units.select("content_id", "unit_id", *[k.alias(n) for k, n in zip(exact_key("start", "end", "text"), keys, strict=True)])
    return u.join(c, ["content_id", *keys]).select("content_id", "unit_id", "r.*")


def unit_vote(units: DataFrame, cues: DataFrame, width: float = 30.0) -> DataFrame:
    """VOI-04, JON-09, AGG-16, AGG-17: units (content_id, unit_id, start, end) by attributed cues (content_id, c_start,
    c_end, status, raw_speaker, candidates array<struct<speaker_id, share>>, seq): speaker, shares, coverage, status,
    speakers, rep (seq of the cue that speaks most for the speaker). Absent shares are equal shares; a cue without
    candidates votes for its raw speaker. Units without a vote stay with NULLs."""
    from ..functions.exprs import lookup, nz

    ov = core.interval_join(units.select("content_id", "unit_id", "start", "end"), cues, ["content_id"], ("start", "end"), ("c_start", "c_end"), width)
    w = lookup(F.coalesce("status", F.lit("")), STATUS_WEIGHT, 0.6)
    alone = F.array(F.struct(F.col("raw_speaker").alias("speaker_id"), F.lit(1.0).alias("share")))
    given = F.when(F.size(F.coalesce("candidates", F.array())) > 0, F.col("candidates")).otherwise(alone)
    ex = ov.withColumns({"given": given, "n": F.size(given), "ow": F.col("ov") * w}).select("content_id", "unit_id", "ow", "n", "seq", F.explode("given").alias("c")).where(nz("c.speaker_id").isNotNull())
    share = F.greatest(F.lit(0.0), F.coalesce("c.share", 1 / F.col("n")))
    votes = ex.groupBy("content_id", "unit_id", F.col("c.speaker_id").alias("speaker")).agg(F.sum(F.col("ow") * share).alias("score"), F.min_by("seq", F.struct((-F.col("ow")).alias("o"), "seq")).alias("rep"))
    unit = Window.partitionBy("content_id", "unit_id")
    r = votes.withColumns({"total": F.sum("score").over(unit), "n": F.count(F.lit(1)).over(unit), "r": F.row_number().over(unit.orderBy(F.desc("score"), "speaker"))})
    part = lambda k: F.coalesce(F.max(F.when((F.col("r") == k) & (F.col("total") > 0), F.col("score") / F.col("total"))), F.lit(0.0))
    top = lambda c: F.max(F.when(F.col("r") == 1, F.col(c))).alias(c)
    best = r.groupBy("content_id", "unit_id").agg(top("speaker"), top("score"), top("rep"), part(1).alias("first_share"), part(2).alias("second_share"), F.max("n").alias("speakers"))
    clipped = ov.select("content_id", "unit_id", F.greatest("start", "c_start").alias("s"), F.least("end", "c_end").alias("e"))
    cover = core.interval_union(clipped, ["content_id", "unit_id"], "s", "e")
    out = units.join(best, ["content_id", "unit_id"], "left").join(cover, ["content_id", "unit_id"], "left")
    coverage = F.least(F.lit(1.0), F.coalesce("union_length", F.lit(0.0)) / F.greatest(F.lit(0.001), F.col("end") - F.col("start")))
    out = out.withColumn("coverage", F.when(F.col("speaker").isNotNull(), coverage)).drop("union_length")
    return out.withColumn("status", F.when(F.col("speaker").isNotNull(), status_of(F.col("coverage"), F.col("first_share"), F.col("second_share"))))


def unit_attribution(units: DataFrame, cues: DataFrame, width: float = 30.0) -> DataFrame:
    """VOI-04, PRJ-03: the cue with a unit's very key decides, else the vote: content_id, unit_id, speaker, status, basis."""
    e = exact_attribution(units, cues).withColumnRenamed("speaker", "__es").withColumnRenamed("status", "__et")
    v = unit_vote(units, cues, width).join(e, ["content_id", "unit_id"], "left")
    hit = F.col("__et").isNotNull()
    basis = F.when(hit, "exact").when(F.col("speaker").isNotNull(), "vote").otherwise("none")
    return v.select("content_id", "unit_id", F.when(hit, F.col("__es")).otherwise(F.col("speaker")).alias("speaker"), F.when(hit, F.col("__et")).otherwise(F.col("status")).alias("status"), basis.alias("basis"))


def mark_overlap(segments: DataFrame, least: float = 0.03, width: float = 30.0) -> DataFrame:
    """WIN-08: flags segments (content_id, seg_id, speaker, start, end) that another speaker talks over."""
    o = segments.select("content_id", F.col("speaker").alias("os"), F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    hit = core.interval_join(segments, o, ["content_id"], ("start", "end"), ("o_start", "o_end"), width).where((F.col("ov") > least) & (F.col("speaker") != F.col("os")))
    return segments.join(hit.select("content_id", "seg_id").distinct().withColumn("overlap", F.lit(True)), ["content_id", "seg_id"], "left").na.fill(False, ["overlap"])


def sampling_plan(cues: DataFrame, every: float = 90.0, clip: float = 3.0, least: float = 1.8, words: int = 3, most: int = 80) -> DataFrame:
    """VOI-05, WIN-13, FLT-15: per content the eligible cues (content_id, cue_index, start, end, text) nearest to a grid of
    times, then the first and the last while there is room, with clips centred in them. The grid begins at half an
    interval, or half the content where that is shorter, counted from zero; it has `most` times at most. Of two nearest
    cues the earlier counts. A clip shorter than `least` is left out after the ordinals were given."""
    real = cues.where((F.col("end") > F.col("start")) & (F.trim(F.coalesce("text", F.lit(""))) != ""))
    ok = real.where((F.col("end") - F.col("start") >= least) & (F.size(F.split(F.trim("text"), r"\s+")) >= words)).withColumn("t", (F.col("start") + F.col("end")) / 2)
    whole = real.groupBy("content_id").agg(F.max("end").alias("duration"))
    span = ok.groupBy("content_id").agg(F.min("cue_index").alias("head"), F.max("cue_index").alias("last")).join(whole, "content_id")
    first = F.least(F.lit(every / 2), F.greatest(F.lit(0.0), F.col("duration") / 2))
    n = F.least(F.lit(most - 1), F.floor((F.col("duration") - first) / every)).cast("int")
    grid = span.select("content_id", first.alias("first"), F.explode(F.sequence(F.lit(0), n)).alias("k")).select("content_id", (F.col("first") + F.col("k") * every).alias("t"))
    both = core.asof_both(grid, ok.select("content_id", "t", "cue_index"), ["content_id"], "t", ["cue_index"])
    far = F.lit(1e18)
    pick = F.when(F.coalesce(F.col("t") - F.col("prev_t"), far) <= F.coalesce(F.col("next_t") - F.col("t"), far), F.col("prev_cue_index")).otherwise(F.col("next_cue_index"))
    ends = span.select("content_id", F.posexplode(F.array("head", "last")).alias("p", "cue_index")).withColumn("p", F.col("p") + 1)
    found = both.select("content_id", F.lit(0).alias("p"), pick.alias("cue_index")).unionByName(ends).groupBy("content_id", "cue_index").agg(F.min("p").alias("p"))
    kept = core.topk(found, ["content_id"], [F.asc("p"), F.asc("cue_index")], most).select("content_id", "cue_index").join(ok, ["content_id", "cue_index"])
    use = F.least(F.lit(clip), F.col("end") - F.col("start"))
    out = kept.withColumn("ordinal", F.row_number().over(Window.partitionBy("content_id").orderBy("start", "cue_index")))
    out = out.withColumn("clip_start", F.greatest("start", F.col("t") - use / 2)).withColumn("clip_end", F.least(F.col("end"), F.col("clip_start") + use))
    return out.where(F.col("clip_end") - F.col("clip_start") >= least)


def bridge_words(words: DataFrame, mapping: DataFrame, gap: float = 1.25, width: float = 30.0) -> DataFrame:
    """VOI-06, JON-11, WIN-04: words (content_id, word_no, w_start, w_end, word, speaker) into source time through
    mapping (content_id, map_idx, m_start, m_end, s_start), regrouped by speaker and gap."""
    mid = words.withColumn("mid", (F.col("w_start") + F.col("w_end")) / 2)
    j = core.point_in_interval(mid, mapping, ["content_id"], "mid", ("m_start", "m_end"), width, "map_idx").where("map_idx is not null")
    shift = F.col("s_start") - F.col("m_start")
    j = j.withColumns({"start": F.col("w_start") + shift, "end": F.col("w_end") + shift})
    w = Window.partitionBy("content_id").orderBy("word_no")
    j = j.withColumns({"__e": F.lag("end").over(w), "__s": F.lag("speaker").over(w)})
    runs = core.islands(j, ["content_id"], ["word_no"], F.col("__e").isNull() | (F.col("__s") != F.col("speaker")) | (F.col("start") - F.col("__e") >= gap), "run")
    parts = F.array_sort(F.collect_list(F.struct("word_no", "word")))
    text = F.aggregate(parts, F.lit(""), lambda a, x: F.concat(a, F.when((a != "") & ~x["word"].startswith(" "), " ").otherwise(""), x["word"]))
    return runs.groupBy("content_id", "run", "speaker").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.trim(text).alias("text"))


def resolution(clusters: DataFrame, rows: DataFrame) -> DataFrame:
    """JON-17: the best row of each cluster (cluster_id, entity_id, status, confidence, path_match, seq): 100 for the same
    path, 20 for VERIFIED, 10 for HIGH_CONFIDENCE, and the confidence; the first of equals."""
    status = F.upper(F.trim(F.coalesce("status", F.lit(""))))
    score = F.coalesce(F.col("path_match").cast("int") * 100, F.lit(0)) + F.when(status == "VERIFIED", 20).when(status == "HIGH_CONFIDENCE", 10).otherwise(0) + F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.0))
    best = rows.withColumn("score", score).groupBy("cluster_id").agg(F.min_by(F.struct("entity_id", "score"), F.struct((-F.col("score")).alias("s"), "seq")).alias("b"))
    return clusters.join(best.select("cluster_id", "b.*"), "cluster_id", "left")


# Characters of a comparable caption token; what ends a sentence.
TOKEN = re.compile(r"[^a-z0-9@_'-]+")
SENTENCE_END = r"[.!?][\"')\]]*$"


def caption_token(word: str) -> str:
    """STR-03: as exprs.norm_caption_token."""
    low = word.lower().replace("’", "'")
    return TOKEN.sub("", low) or low.strip()


def _fold(words: list[str], most: int = 96, fuzzy: float = 0.92, least: int = 4) -> Iterator[int]:
    """How many leading words of each cue repeat what was said; words: the cues' texts."""
    said: list[str] = []
    for text in words:
        raw = text.split()
        own = [caption_token(w) for w in raw]
        top = min(len(own), len(said), most)
        hit = next((k for k in range(top, 0, -1) if said[-k:] == own[:k]), 0)
        if not hit:
            for k in range(top, least - 1, -1):
                if difflib.SequenceMatcher(None, said[-k:], own[:k], autojunk=False).ratio() >= fuzzy:
                    hit = k
                    break
        said = (said + own[hit:])[-most:]
        yield hit


def caption_fold(cues: DataFrame, cap: int = 42, gap: float = 1.75) -> DataFrame:
    """TXT-02, WIN-03, WIN-07: rolling captions (content_id, cue_index, start, end, text) to segments: content_id, run, part,
    start, end, text.

    What a cue repeats of the words before it goes; the others share the cue's time evenly, by their place in it (a missing
    start is 0, a missing or zero end the start, a cue lasts 0.001 s at least). The fold needs each content's cues in order,
    so it runs per content in Python. A segment ends with a sentence (closing quotes and brackets after the stop count to
    it), before a pause of more than `gap` seconds between a word's end and the next one's start, and at `cap` words."""

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cue_index")
        rows = []
        for c, skip in zip(frame.itertuples(index=False), _fold(frame["text"].fillna("").tolist()), strict=True):
            raw = (c.text or "").split()
            start = 0.0 if pd.isna(c.start) else float(c.start)
            end = start if pd.isna(c.end) or not c.end else float(c.end)
            step = max(0.001, end - start)
            rows += [(c.content_id, c.cue_index, j, start + step * (j / len(raw)), start + step * ((j + 1) / len(raw)), raw[j]) for j in range(skip, len(raw))]
        return pd.DataFrame(rows, columns=["content_id", "cue_index", "j", "a", "z", "word"])

    kinds = dict(cues.dtypes)
    words = cues.select("content_id", "cue_index", "start", "end", "text").groupBy("content_id").applyInPandas(fold, f"content_id {kinds['content_id']}, cue_index {kinds['cue_index']}, j int, a double, z double, word string")
    order = ["cue_index", "j"]
    w = Window.partitionBy("content_id").orderBy(*order)
    words = words.withColumns({"before_z": F.lag("z").over(w), "before": F.lag("word").over(w)})
    runs = core.islands(words, ["content_id"], order, F.col("before_z").isNull() | (F.col("a") - F.col("before_z") > gap) | F.col("before").rlike(SENTENCE_END), "run")
    n = F.row_number().over(Window.partitionBy("content_id", "run").orderBy(*order))
    runs = runs.withColumn("part", F.floor((n - 1) / cap))
    parts = F.array_sort(F.collect_list(F.struct("cue_index", "j", "word", "a", "z")))
    out = runs.groupBy("content_id", "run", "part").agg(parts.alias("w"))
    return out.select("content_id", "run", "part", F.get("w", F.lit(0))["a"].alias("start"), F.element_at("w", -1)["z"].alias("end"), F.array_join("w.word", " ").alias("text"))

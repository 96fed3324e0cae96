"""Mention discovery (TXT-04 ... TXT-15): aliases, names, cues, gate, context classes, roll-ups, resolution queue."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from . import core

# Words that stand for no one by themselves.
STOP = frozenset(
    """a an the this that these those there here and but or so because for with from into when what why how who where today yesterday tomorrow we you they he
    she it i me my our your their his her its is are was were be been being have has had do does did can could will would should may might must not no
    yes yeah mhm uh um right okay ok well now then just really actually basically exactly absolutely probably maybe anyway again all one two three four five look see
    sure good great wow""".split()
)
# Single capitalised words that are no names.
BAD_SINGLE = STOP | frozenset("american chinese iranian russian british european global local federal state national".split())
# Words that a name after a cue does not begin with.
BAD_CUE_START = STOP | frozenset(
    """someone somebody something people person thing things way kind lot number new same in on at to from about into over under near around through taking place based""".split()
)
# Words at which a name after a cue ends.
CUE_STOP = frozenset(
    """because who that which where when if then so but however although though while was were is are has have had will would can could should may might must""".split()
)
# Small words inside names.
CONNECTORS = frozenset("of the and for de del van von la le &".split())
CONTRACTION = r"(?i)^(?:i|we|you|they|he|she|it|that|what|there|here)['’]?(?:m|re|ve|d|ll|s|t)?$"
IS_CONTRACTION = re.compile(CONTRACTION)
TOKEN = r"[A-Za-z0-9&’'\.-]+"
NAME = r"[A-Z][A-Za-z0-9&’'\.-]*"
#: A name: up to six tokens, small connectors inside. It never runs over sentence punctuation (see spans_of).
SPAN = re.compile(rf"\b{NAME}(?:\s+(?:{NAME}|of|the|and|for)){{0,5}}\b")
# What introduces a person, and kinds of things that introduce a name, with their types.
PERSON_CUE = re.compile(
    rf"\b(?:guest(?:\s+is)?|joined\s+by|speaking\s+with|interview(?:ing|\s+with)?|dr\.?|doctor|professor|mr\.?|mrs\.?|ms\.?)\s+({TOKEN}(?:\s+{TOKEN}){{0,4}})", re.I
)
KINDS = {
    "podcast": "media_show", "channel": "media_show", "website": "website", "company": "organization", "organization": "organization", "organisation": "organization",
    "foundation": "organization", "institute": "organization", "book": "product", "report": "product", "film": "product", "documentary": "product",
    "conference": "event", "summit": "event", "project": "organization", "platform": "product", "service": "product", "sponsor": "organization",
}
ENTITY_CUE = re.compile(rf"\b(?P<kind>{'|'.join(KINDS)})\s+(?:(?P<intro>called|named|titled|known\s+as)\s+)?(?P<name>{TOKEN}(?:\s+{TOKEN}){{0,5}})", re.I)
IS_URL = re.compile(r"(?:https?://[^\s<>\"']+|(?:www\.)?[A-Za-z0-9.-]+\.(?:com|org|net|io|tv|news|co|us|gov|edu))", re.I)
ENDS = ".,;:!?()[]{}\"'"
SPOKEN = T.ArrayType(T.StructType([T.StructField(n, k) for n, k in (("surface", T.StringType()), ("kind", T.StringType()), ("start", T.IntegerType()), ("end", T.IntegerType()), ("signal", T.StringType()))]))


def low(word: str) -> str:
    return word.lower().strip(ENDS).replace("’", "'")


def is_proper(token: str) -> bool:
    """Whether a token has the form of a part of a name."""
    t = token.strip("()[]{}\"'")
    return bool(t) and (t.lower() in CONNECTORS or t.isupper() and 2 <= len(t) <= 12 or re.fullmatch(r"[A-Z][A-Za-z0-9&’'-]*", t) is not None)


def trim_cue(raw: str, most: int) -> str:
    """The name at the start of what follows a cue: up to a word that ends names, a sentence's end, or the first
    lower-case word after a proper one."""
    words, kept = raw.split(), []
    if not words or low(words[0]) in BAD_CUE_START:
        return ""
    for w in words[:most]:
        if kept and (low(w) in CUE_STOP or is_proper(kept[-1]) and not is_proper(w.strip(ENDS)) and w[:1].islower()):
            break
        if w.strip(ENDS):
            kept.append(w.strip(ENDS))
        if w[-1] in ".!?" and not re.fullmatch(r"(?:Dr|Mr|Mrs|Ms|St|[A-Z])\.", w):
            break
    while kept and (low(kept[-1]) in STOP or kept[-1].lower() in CONNECTORS):
        kept.pop()
    return " ".join(kept)


def sentence_parts(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """A span cut where a token ends a sentence, so no name runs over one; single letters and titles end none."""
    out, at = [], a
    for m in re.finditer(r"\S+", text[a:b]):
        if m[0][-1] in ".!?" and not re.fullmatch(r"(?:Dr|Mr|Mrs|Ms|St|(?:[A-Z]\.)*[A-Z])\.", m[0]):
            out.append((at, a + m.end()))
            at = a + m.end()
            while at < b and text[at].isspace():
                at += 1
    return [*out, (at, b)] if at < b else out


def spans_of(text: str) -> list[tuple[str, str, int, int, str]]:
    """Names in a text with character offsets; one entry per span and signal."""
    out = []

    def add(name: str, kind: str, start: int, signal: str) -> None:
        if len(name) >= 3 and name.lower() not in STOP:
            out.append((name, kind, start, start + len(name), signal))

    for m in SPAN.finditer(text):
        for p, q in sentence_parts(text, m.start(), m.end()):
            for a, b in _halves(text, p, q):
                words = [(w.start() + a, w[0]) for w in re.finditer(r"\S+", text[a:b])]
                while words and low(words[0][1]) in STOP:
                    words = words[1:]
                while words and words[-1][1].lower() in CONNECTORS:
                    words = words[:-1]
                if not words:
                    continue
                start = words[0][0]
                name = re.sub(r"\s+", " ", text[start : words[-1][0] + len(words[-1][1])]).strip(ENDS + " ")
                if len(words) == 1:
                    before = text[:start].rstrip()
                    mid = bool(before) and before[-1] not in ".!?\n>"
                    if low(name) in BAD_SINGLE or not (name.isupper() and 2 <= len(name) <= 12 or any(c.isupper() for c in name[1:]) or mid):
                        continue
                add(name, "", start, "proper_case")
    for m in PERSON_CUE.finditer(text):
        add(trim_cue(m[1], 4), "person", m.start(1), "cue_person")
    for m in ENTITY_CUE.finditer(text):
        name = trim_cue(m["name"], 5)
        shown = any(is_proper(w) and w.lower() not in CONNECTORS for w in name.split()) or IS_URL.fullmatch(name)
        if name and (m["intro"] or shown):
            add(name, KINDS[m["kind"].lower()], m.start("name"), "cue_entity_named" if m["intro"] else "cue_entity")
    return out


def _halves(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """A span as two where ' and ' joins names of two tokens or more."""
    cut = text.find(" and ", a, b)
    if cut >= 0 and len(text[a:cut].split()) >= 2 and len(text[cut + 5 : b].split()) >= 2:
        return [(a, cut), (cut + 5, b)]
    return [(a, b)]


@F.pandas_udf(SPOKEN)
def name_spans(texts: pd.Series) -> pd.Series:
    """TXT-06, TXT-07, TXT-08."""
    return texts.fillna("").map(lambda t: [dict(zip(("surface", "kind", "start", "end", "signal"), x, strict=True)) for x in spans_of(t)])


def known_aliases(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """TXT-04, SET-02: alias (lower case), canonical_id, name, kind. Names and their parts at '/'; the alias table wins."""
    names = entities.select(F.explode(F.array_union(F.array("name"), F.split("name", "/"))).alias("alias"), F.col("id").alias("canonical_id"), "name", F.col("type").alias("kind"), F.lit(1).alias("p"))
    own = aliases.join(entities.select(F.col("id").alias("canonical_id"), "name", F.col("type").alias("kind")), "canonical_id").select("alias", "canonical_id", "name", "kind", F.lit(0).alias("p"))
    rows = names.unionByName(own).withColumn("alias", F.lower(F.trim("alias"))).where(F.length("alias") >= 3)
    return core.topk(rows, ["alias"], [F.asc("p"), F.asc("canonical_id")], 1).select("alias", "canonical_id", "name", "kind")


def alias_mentions(segments: DataFrame, known: DataFrame) -> DataFrame:
    """TXT-04, JON-23: seg_id, surface, start, canonical_id: aliases on word boundaries, all occurrences.

    Runs of as many words as aliases have are looked up by an equi-join, so the dictionary may be of any size."""
    counts = [F.lit(r.n) for r in known.select(F.size(F.split("alias", " ")).alias("n")).distinct().orderBy("n").collect()] or [F.lit(1)]
    word = r"[\p{L}\p{N}][\p{L}\p{N}'&.-]*[\p{L}\p{N}]|[\p{L}\p{N}]"
    w = segments.select("seg_id", F.lower("text").alias("t")).withColumn("w", F.regexp_extract_all("t", F.lit(f"({word})"), F.lit(1)))
    runs = w.select("seg_id", F.explode(F.flatten(F.transform(F.array(*counts), lambda n: F.transform(
        F.filter(F.sequence(F.lit(0), F.size("w")), lambda i: i + n <= F.size("w")), lambda i: F.struct(i.alias("word_no"), F.array_join(F.slice("w", i + 1, n), " ").alias("alias")))))).alias("r"))
    return runs.select("seg_id", "r.*").join(known, "alias").select("seg_id", "word_no", F.col("alias").alias("surface"), "canonical_id", "name", "kind")


def evidence(segments: DataFrame) -> DataFrame:
    """TXT-05 ... TXT-08, TXT-10, STR-15: one row per span and signal of segments (seg_id, content_id, source_type, speaker_id, text)."""
    keep = ["seg_id", "content_id", "source_type", "speaker_id", "text"]
    names = segments.select(*keep, F.explode(name_spans("text")).alias("m")).select(*keep, "m.*")
    urls = segments.select(*keep, F.explode(X.urls(F.col("text"))).alias("surface")).select(*keep, "surface", F.lit("website").alias("kind"), (F.instr(F.col("text"), F.col("surface")) - 1).alias("start"), F.lit("url").alias("signal"))
    rows = names.drop("end").unionByName(urls)
    context = X.snippet(F.col("text"), F.col("start"), F.length("surface"))
    kind = F.when(F.col("kind") != "", F.col("kind")).otherwise(context_class(context, F.col("surface")))
    return rows.select("seg_id", "content_id", "source_type", "speaker_id", "surface", X.norm_tokens(F.col("surface")).alias("candidate_key"), kind.alias("kind"), "start", "signal", context.alias("snippet")).where("candidate_key <> ''")


# Context words of a kind, in order.
CONTEXTS = [
    ("media_show", r"(?i)\b(podcast|show|channel|radio|newsletter|substack|youtube|rumble|odysee|broadcast)\b"),
    ("event", r"(?i)\b(conference|summit|symposium|forum|congress|expo|webinar|workshop)\b"),
    ("government", r"(?i)\b(department|agency|commission|administration|bureau|ministry|senate|parliament|government|sec|cftc|ftc|fda|doj|fbi|cia|cdc|nih)\b"),
    ("organization", r"(?i)\b(foundation|institute|association|network|organization|organisation|council|committee|alliance|coalition|project|group|media|news|company|corp|corporation|inc|llc|ltd|nonprofit|charity)\b"),
    ("product", r"(?i)\b(report|course|book|film|documentary|device|supplement|membership|subscription|software|platform|service|system|model|program|app)\b"),
]


def context_class(context: Column, surface: Column) -> Column:
    """TXT-10."""
    out = F.when(F.lit(False), "")
    for kind, pattern in CONTEXTS:
        out = out.when(context.rlike(pattern), kind)
    n = F.size(F.split(F.trim(surface), r"\s+"))
    return out.when(surface.rlike(rf"(?i)^(?:{X.URL})$"), "website").when((n >= 2) & (n <= 5), "person_or_named_entity").otherwise("named_entity")


def eligible(surface: Column, signals: Column, kind: Column, canonical: Column, contents: Column, prior: Column | None = None) -> Column:
    """TXT-09, FLT-11: the candidate gate. prior: the status that people gave."""
    raw = X.clean(surface)
    tokens = F.split(raw, " ")
    n = F.size(tokens)
    bare = lambda t: F.replace(F.btrim(F.lower(t), F.lit(ENDS)), F.lit("’"), F.lit("'"))
    first, last = bare(F.get(tokens, F.lit(0))), bare(F.get(tokens, n - 1))
    has = lambda p: F.exists(signals, lambda s: s.startswith(p))
    acronym = lambda t: t.rlike("[A-Z]") & (t == F.upper(t)) & F.length(t).between(2, 12)
    proper = F.forall(tokens, lambda t: F.lower(F.btrim(t, F.lit("()[]{}\"'"))).isin(sorted(CONNECTORS)) | acronym(F.btrim(t, F.lit("()[]{}\"'"))) | F.btrim(t, F.lit("()[]{}\"'")).rlike("^[A-Z][A-Za-z0-9&’'-]*$"))
    single = acronym(raw) | raw.rlike("^.+[A-Z]") | (contents >= 2)
    known = X.nz(canonical).isNotNull()
    if prior is not None:
        known = known | F.lower(F.trim(F.coalesce(prior, F.lit("")))).isin("approved", "existing", "accepted")
    return (
        F.when(known, True).when(F.array_contains(signals, "url") | (kind == "website"), True).when(F.length(raw) < 3, False)
        .when(F.array_contains(signals, "proper_case") & raw.rlike("[.!?]"), False)
        .when(first.isin(sorted(STOP | BAD_CUE_START)) | first.rlike(CONTRACTION) | last.isin(sorted(STOP | CUE_STOP)) | last.rlike(CONTRACTION), False)
        .when(has("cue_person"), n <= 5).when(has("cue_entity"), n <= 6).when(~F.array_contains(signals, "proper_case"), False)
        .when(n == 1, ~raw.rlike(CONTRACTION) & single).otherwise((n <= 6) & proper)
    )


def candidates(ev: DataFrame, known: DataFrame) -> DataFrame:
    """AGG-01, TXT-11, TXT-12: candidate_key, display, kind, counts, signals, canonical_id, score, priority, of eligible ones."""
    order = F.struct("content_id", "seg_id", "start", "signal")
    g = ev.groupBy("candidate_key").agg(
        F.count(F.lit(1)).alias("mentions"), F.countDistinct("content_id").alias("contents"), F.countDistinct("source_type").alias("sources"), F.countDistinct("speaker_id").alias("speakers"),
        F.min_by("surface", order).alias("display"), F.min_by("kind", order).alias("kind"), F.min_by("snippet", order).alias("snippet"), F.array_sort(F.collect_set("signal")).alias("signals"))
    k = known.select(X.norm_tokens(F.col("alias")).alias("candidate_key"), "canonical_id").dropDuplicates(["candidate_key"])
    g = g.join(k, "candidate_key", "left")
    has = F.col("canonical_id").isNotNull()
    g = g.withColumn("score", X.triage_score(has, F.col("kind"), F.col("signals"), F.lit(False), F.col("mentions"), F.col("contents"), F.col("speakers")))
    g = g.withColumn("priority", X.priority(F.col("score"), has))
    return g.where(eligible(F.col("display"), F.col("signals"), F.col("kind"), F.col("canonical_id"), F.col("contents"))).orderBy(X.priority_rank(F.col("priority")), F.desc("score"), F.lower("display"))


def comentions(ev: DataFrame) -> DataFrame:
    """JON-12, AGG-03."""
    return core.unordered_pairs(ev, ["seg_id"], "candidate_key").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def master(evidence: DataFrame, prior: DataFrame) -> DataFrame:
    """AGG-02, TXT-13: candidates over the evidence of all standing batches (candidate_key, display, kind, content_id,
    source_path, speaker, signal, processed_at, batch_id, canonical_id, snippet, seq), with first and last sighting and the
    human state of `prior` (candidate_key, review_status, approved_id, notes). What a row shows first is its first by seq;
    the first batch is the earliest, the last the latest one, the later of equals."""
    first = lambda c: F.min_by(c, "seq").alias(c)
    seen = F.col("processed_at").isNotNull() & (F.col("processed_at") != "")
    g = evidence.groupBy("candidate_key").agg(
        first("display"), first("kind"), first("content_id"), first("snippet"), first("canonical_id"), F.count(F.lit(1)).alias("mentions"), F.countDistinct(X.nz("content_id")).alias("contents"),
        F.countDistinct(X.nz("source_path")).alias("sources"), F.countDistinct(X.nz("speaker")).alias("speakers"), F.array_sort(F.collect_set(X.nz("signal"))).alias("signals"),
        F.min(F.when(seen, F.col("processed_at"))).alias("first_seen"), F.max(F.when(seen, F.col("processed_at"))).alias("last_seen"),
        F.min_by("batch_id", F.when(seen, F.struct("processed_at", "seq"))).alias("first_batch"), F.max_by("batch_id", F.when(seen, F.struct("processed_at", "seq"))).alias("last_batch"))
    g = g.join(prior, "candidate_key", "left")
    known = X.nz("canonical_id").isNotNull()
    score = X.triage_score(known, F.col("kind"), F.col("signals"), F.array_contains("signals", "known"), F.col("mentions"), F.col("contents"), F.col("speakers"))
    g = g.withColumns({"score": score, "priority": X.priority(score, known)})
    g = g.where(eligible(F.col("display"), F.col("signals"), F.col("kind"), F.col("canonical_id"), F.col("contents"), F.col("review_status")))
    return g.withColumns({"review_status": F.coalesce(X.nz("review_status"), F.when(known, "existing").otherwise("new")), "approved_id": X.first_of("approved_id", "canonical_id", default="")})


def surface_rollup(mentions: DataFrame) -> DataFrame:
    """AGG-13: unresolved surfaces (surface, canonical_id, content_id, entity_type, correction, seq) by their norm: counts,
    the first five as examples, of these the longest (the first of equals) for display, the last type, corrections."""
    m = mentions.where(X.nz("canonical_id").isNull()).withColumn("key", X.norm_handle(F.col("surface"))).where("key <> ''")
    first = core.topk(m, ["key"], [F.asc("seq")], 5).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seq", "surface"))).alias("e"))
    longest = F.array_max(F.transform("e", lambda x, i: F.struct(F.length(x["surface"]).alias("n"), (-i).alias("i"), x["surface"].alias("s"))))["s"]
    g = m.groupBy("key").agg(F.count(F.lit(1)).alias("mentions"), F.countDistinct(X.nz("content_id")).alias("contents"), F.max_by("entity_type", F.when(X.nz("entity_type").isNotNull(), F.col("seq"))).alias("entity_type"))
    fixes = core.map_counter(m.where(X.nz("correction").isNotNull()), ["key"], "correction", "corrections")
    out = g.join(first.select("key", longest.alias("display"), F.col("e.surface").alias("examples")), "key").join(fixes, "key", "left")
    return out.select("key", "display", "examples", "mentions", "contents", F.coalesce("entity_type", F.lit("")).alias("entity_type"), F.coalesce(F.to_json("corrections"), F.lit("{}")).alias("corrections_json"))


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """STR-09: SequenceMatcher.ratio."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


#: Letters of handles, common ones first. Any order is right; this one makes the first letters of a text its rare ones.
HANDLE = " eairtonslcdupmghbyfvkwzxqj0123456789.-'_@"


def letters(c: Column) -> Column:
    """The letters of a handle, each with its number among its likes, rare letters first."""
    ordered = F.array_sort(F.filter(F.split(F.translate(c, HANDLE, "".join(chr(0x180 - i) for i in range(len(HANDLE)))), ""), lambda x: x != ""))
    return F.transform(ordered, lambda x, i: F.concat(x, (i - F.array_position(ordered, x)).cast("string")))


def resolution_queue(mentions: DataFrame, names: DataFrame, k: int = 5, least: float = 0.62) -> DataFrame:
    """TXT-15, AGG-13, JON-22: surfaces (surface, content_id, entity_type, seq) with their k nearest known names.

    Matching blocks take each letter once, so a ratio of r needs two texts to have r/2 of all their letters in common,
    counted as often as both have them; of one text alone, r/(2 - r). Two such texts share a letter (with its number)
    among the first letters of each in one order, rare ones first: names are met through these by an equi-join, and no
    pair that reaches the ratio is missed. Distinct texts are measured once; entities are joined afterwards."""
    s = mentions.withColumn("key", X.norm_handle(F.col("surface"))).where("key <> ''").groupBy("key").agg(
        F.count(F.lit(1)).alias("mentions"), F.countDistinct("content_id").alias("contents"), F.max_by("surface", F.struct(F.length("surface"), -F.col("seq"))).alias("display"), F.max_by("entity_type", "seq").alias("entity_type"))
    n = names.select("entity_id", X.norm_handle(F.col("name")).alias("name_key")).where("name_key <> ''")
    first = lambda c: F.length(c) - F.ceil(F.length(c) * (least / (2 - least)) - 1e-9).cast("int") + 1
    met = s.select("key", F.explode(F.slice(letters(F.col("key")), F.lit(1), first("key"))).alias("g")).join(
        n.select("name_key").distinct().select("name_key", F.explode(F.slice(letters(F.col("name_key")), F.lit(1), first("name_key"))).alias("g")), "g")
    both, total = F.size(F.array_intersect(letters(F.col("key")), letters(F.col("name_key")))), F.length("key") + F.length("name_key")
    near = met.where(F.least(F.length("key"), F.length("name_key")) * 2 >= least * total).select("key", "name_key").distinct().where(both * 2 >= least * total)
    pairs = near.withColumn("sim", ratio("key", "name_key")).where(F.col("sim") >= least)
    # of entities with one name, only the first k can be among a key's first k
    firsts = core.topk(n.distinct(), ["name_key"], [F.desc("entity_id")], k).select("entity_id", "name_key")
    best = pairs.join(firsts, "name_key").groupBy("key", "entity_id").agg(F.max("sim").alias("sim"))
    top = core.topk(best, ["key"], [F.desc("sim"), F.desc("entity_id")], k).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "entity_id", "sim"))).alias("candidates"))
    return s.join(top, "key", "left")


def extract_batch(files: DataFrame, done: DataFrame, version: str) -> DataFrame:
    """SET-04, STM-08: files (path, sha256) not yet processed by this version."""
    return files.withColumn("version", F.lit(version)).join(done, ["path", "sha256", "version"], "left_anti")


# Fixed value: the version of the rules that cut units.
BUILDER = "caption_overlap_v2"


def unit_ledger(segments: DataFrame, version: str = BUILDER) -> DataFrame:
    """TXT-14, STR-10: sentence units of segments (content_id, source_sha, cue_index, start, end, text, speaker_id) with stable
    ids: file, content, start, end, speaker, text, the sentence's number and the version of the rules."""
    s = segments.select("content_id", "source_sha", "cue_index", "start", "end", "speaker_id", F.posexplode(X.sentences(X.squeeze(F.col("text")))).alias("sentence_index", "text")).where("text <> ''")
    uid = X.stable_id("TU_", *[F.col(c) for c in ("source_sha", "content_id", "start", "end", "speaker_id", "text", "sentence_index")], F.lit(version))
    return s.withColumn("unit_id", uid)


def pending(units: DataFrame) -> DataFrame:
    """FLT-07."""
    return units.where((F.col("source_status") == "CURRENT") & ((F.coalesce("semantic_status", F.lit("")) != "COMPLETE") | (F.coalesce("fact_status", F.lit("")) != "COMPLETE")))


def ordinals(df: DataFrame, by: str, order: str) -> DataFrame:
    """WIN-11."""
    return df.withColumn("ordinal", F.row_number().over(Window.partitionBy(by).orderBy(order)))


def failures(rows: DataFrame, most: int = 5) -> DataFrame:
    """AGG-22, STR-14: class, count and first examples of failure messages (id, message)."""
    r = rows.withColumn("class", X.failure_class(F.col("message")))
    n = r.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    ex = core.topk(r, ["class"], [F.asc("id")], most).groupBy("class").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id", X.tail(F.col("message"), 900).alias("m")))), lambda x: x["m"]).alias("examples"))
    return n.join(ex, "class").orderBy(F.desc("n"), "class")


def iterate_texts(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The extraction as a mapInPandas step for streams: seg_id, text to seg_id, surface, signal."""
    for frame in it:
        rows = [(i, s[0], s[4]) for i, t in zip(frame["seg_id"], frame["text"].fillna(""), strict=True) for s in spans_of(t)]
        yield pd.DataFrame(rows, columns=["seg_id", "surface", "signal"])

"""Queries over texts: scalar functions, mention discovery, units, roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import core, mentions
from .base import table
from .registry import register

#: A capital and three small letters or more.
TERM = "[A-Z][a-z]{3,}"

SENT = """
sent AS (SELECT doc_id, source, unnest(s) AS sentence, unnest(range(len(s))) AS idx FROM
  (SELECT doc_id, source, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(31), 'g'), chr(31)) AS s FROM documents WHERE text IS NOT NULL))
"""


def sentence_rows(docs: DataFrame) -> DataFrame:
    """TXT-14's unit scan: doc_id, source, idx, sentence."""
    marked = F.split(F.regexp_replace("text", r"([.!?])\s+", "$1\x1f"), "\x1f")
    return docs.where("text is not null").select("doc_id", "source", F.posexplode(marked).alias("idx", "sentence"))


@register("sentence_units", f"WITH {SENT} SELECT doc_id, idx, sentence, length(sentence) AS n_chars FROM sent")
def sentence_units(spark: SparkSession, d: str) -> DataFrame:
    return sentence_rows(table(spark, d, "documents")).select("doc_id", F.col("idx").cast("long").alias("idx"), "sentence", F.char_length("sentence").cast("long").alias("n_chars"))


@register("stable_ids", f"""WITH {SENT} SELECT doc_id, idx, 'TU_' || upper(substr(sha256(concat_ws(chr(31), doc_id::VARCHAR, idx::VARCHAR, sentence)), 1, 24)) AS unit_id FROM sent""")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    """STR-10."""
    s = sentence_rows(table(spark, d, "documents"))
    return s.select("doc_id", F.col("idx").cast("long").alias("idx"), X.stable_id("TU_", F.col("doc_id"), F.col("idx"), F.col("sentence")).alias("unit_id"))


@register("text_norm", """SELECT conv_id, turn, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS norm,
  regexp_replace(role || '/' || text, '[^A-Za-z0-9._-]', '_', 'g') AS safe, right(text, 20) AS tail FROM conversations""")
def text_norm(spark: SparkSession, d: str) -> DataFrame:
    """STR-02, STR-05, STR-16."""
    t = table(spark, d, "conversations")
    return t.select("conv_id", "turn", X.norm_tokens(F.col("text")).alias("norm"), X.safe_name(F.concat("role", F.lit("/"), "text")).alias("safe"), X.tail(F.col("text"), 20).alias("tail"))


URL_SQL = r"""(?i)(?:https?://[^\s<>"'']+|\b(?:www\.)?[A-Za-z0-9.-]+\.(?:com|org|net|io|tv|news|co|us|gov|edu)\b)"""


@register("url_mentions", f"""SELECT page_id, mention, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(url || ' ' || coalesce(html, ''), '{URL_SQL}')) AS mention FROM pages) GROUP BY page_id, mention""")
def url_mentions(spark: SparkSession, d: str) -> DataFrame:
    """STR-08, TXT-05."""
    p = table(spark, d, "pages").select("page_id", F.explode(X.urls(F.concat("url", F.lit(" "), F.coalesce("html", F.lit(""))))).alias("mention"))
    return p.groupBy("page_id", "mention").agg(F.count(F.lit(1)).alias("n"))


TERMS_SQL = f"terms AS (SELECT doc_id, source, unnest(regexp_extract_all(text, '{TERM}')) AS term FROM documents)"


def term_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.explode(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))).alias("term"))


@register("proper_terms", f"WITH {TERMS_SQL} SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM terms GROUP BY term")
def proper_terms(spark: SparkSession, d: str) -> DataFrame:
    return term_rows(table(spark, d, "documents")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("docs"))


@register("proper_terms_per_source", f"""WITH {TERMS_SQL}, c AS (SELECT source, term, count(*) AS n FROM terms GROUP BY source, term)
SELECT source, term, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, term) AS rank FROM c) WHERE rank <= 5""")
def proper_terms_per_source(spark: SparkSession, d: str) -> DataFrame:
    c = term_rows(table(spark, d, "documents")).groupBy("source", "term").agg(F.count(F.lit(1)).alias("n"))
    return core.topk(c, ["source"], [F.desc("n"), F.asc("term")], 5)


@register("comentions_topk", f"""WITH {SENT}, t AS (SELECT DISTINCT doc_id, idx, unnest(regexp_extract_all(sentence, '{TERM}')) AS term FROM sent)
SELECT a.term AS a, b.term AS b, count(*) AS n FROM t a JOIN t b ON a.doc_id = b.doc_id AND a.idx = b.idx AND a.term < b.term GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 100""")
def comentions_topk(spark: SparkSession, d: str) -> DataFrame:
    """JON-12, AGG-03. Sentences are the segments, so a pair join stays within a sentence: bounded by its terms."""
    s = sentence_rows(table(spark, d, "documents"))
    terms = F.array_sort(F.array_distinct(F.regexp_extract_all("sentence", F.lit(TERM), F.lit(0))))
    return core.pairs_in_row(s, terms).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "a", "b").limit(100)


ROLL_SQL = f"""{TERMS_SQL}, roll AS (SELECT term, count(*) AS mentions, count(DISTINCT doc_id) AS contents, count(DISTINCT source) AS sources, min(doc_id) AS first_doc,
  max(doc_id) AS last_doc, min(source) AS first_source FROM terms GROUP BY term)"""


def rollup(docs: DataFrame) -> DataFrame:
    return term_rows(docs).groupBy("term").agg(
        F.count(F.lit(1)).alias("mentions"), F.countDistinct("doc_id").alias("contents"), F.countDistinct("source").alias("sources"),
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.min("source").alias("first_source"),
    )


@register("mention_rollup", f"WITH {ROLL_SQL} SELECT * FROM roll")
def mention_rollup(spark: SparkSession, d: str) -> DataFrame:
    """AGG-01."""
    return rollup(table(spark, d, "documents"))


@register("triage_score", f"""WITH {ROLL_SQL}, s AS (SELECT term, mentions, contents, 8 + least(20, 2 * mentions) + least(30, 5 * contents) + least(10, 2 * sources) AS score FROM roll)
SELECT term, score, CASE WHEN score >= 45 THEN 'HIGH' WHEN score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM s""")
def triage_score(spark: SparkSession, d: str) -> DataFrame:
    """TXT-11, MTH-07."""
    r, no = rollup(table(spark, d, "documents")), F.lit(False)
    score = X.triage_score(no, F.lit("name"), F.array(F.lit("proper_case")), no, F.col("mentions"), F.col("contents"), F.col("sources"))
    return r.select("term", score.alias("score")).withColumn("priority", X.priority(F.col("score"), no))


@register("context_neighbours", """SELECT conv_id, turn,
  coalesce(lag(role, 2) OVER w || ':' || length(lag(text, 2) OVER w) || '|', '') || coalesce(lag(role) OVER w || ':' || length(lag(text) OVER w), '') AS before,
  coalesce(lead(role) OVER w || ':' || length(lead(text) OVER w), '') || coalesce('|' || lead(role, 2) OVER w || ':' || length(lead(text, 2) OVER w), '') AS after
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def context_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """WIN-01."""
    t = table(spark, d, "conversations")
    out = core.neighbours(t, ["conv_id"], ["turn"], F.concat("role", F.lit(":"), F.char_length("text").cast("string")))
    return out.select("conv_id", "turn", F.array_join("before", "|").alias("before"), F.array_join("after", "|").alias("after"))


@register("conversation_role_runs", """WITH f AS (SELECT *, CASE WHEN role = lag(role) OVER w THEN 0 ELSE 1 END AS new FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM f)
SELECT conv_id, run::BIGINT AS run, role, min(turn) AS first_turn, max(turn) AS last_turn, string_agg(text, ' ' ORDER BY turn) AS text FROM g GROUP BY conv_id, run, role""")
def conversation_role_runs(spark: SparkSession, d: str) -> DataFrame:
    """WIN-05."""
    t = table(spark, d, "conversations")
    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    runs = core.islands(t.withColumn("__b", before), ["conv_id"], ["turn"], F.col("__b").isNull() | (F.col("__b") != F.col("role")), "run")
    parts = F.array_sort(F.collect_list(F.struct("turn", "text")))
    out = runs.groupBy("conv_id", "run", "role").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), parts.alias("p"))
    return out.select("conv_id", "run", "role", "first_turn", "last_turn", F.array_join(F.col("p.text"), " ").alias("text"))


@register("rule_violations", """SELECT doc_id AS id, 'short_text' AS rule FROM documents WHERE length(text) < 100 UNION ALL SELECT doc_id, 'length_mismatch' FROM documents WHERE n_chars <> length(text)
UNION ALL SELECT conv_id, 'empty_turn' FROM conversations WHERE trim(text) = '' UNION ALL SELECT conv_id, 'unknown_role' FROM conversations WHERE role NOT IN ('user', 'assistant', 'system')""")
def rule_violations(spark: SparkSession, d: str) -> DataFrame:
    """SEM-02's form: each rule a filter, all of a table evaluated in one scan."""
    docs, conv = table(spark, d, "documents"), table(spark, d, "conversations")
    rule = lambda c, name: F.when(c, F.lit(name))
    a = docs.select(F.col("doc_id").alias("id"), F.array(rule(F.char_length("text") < 100, "short_text"), rule(F.col("n_chars") != F.char_length("text"), "length_mismatch")).alias("r"))
    b = conv.select(F.col("conv_id").alias("id"), F.array(rule(F.trim("text") == "", "empty_turn"), rule(~F.col("role").isin("user", "assistant", "system"), "unknown_role")).alias("r"))
    return a.unionByName(b).select("id", F.explode(F.array_compact("r")).alias("rule"))


@register("fact_status_left", """SELECT d.doc_id, d.source, CASE WHEN l.quality = 1 THEN 'GOOD' WHEN l.quality = 0 THEN 'POOR' ELSE 'UNCHECKED' END AS status FROM documents d LEFT JOIN labels l USING (doc_id)""")
def fact_status_left(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels").select("doc_id", "quality")
    status = F.when(F.col("quality") == 1, "GOOD").when(F.col("quality") == 0, "POOR").otherwise("UNCHECKED")
    return docs.join(labels, "doc_id", "left").select("doc_id", "source", status.alias("status"))


@register("kv_status_pivot", """SELECT source, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE quality = 0) AS poor, count(*) FILTER (WHERE toxic = 1) AS toxic,
  count(*) FILTER (WHERE quality IS NULL) AS pending FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def kv_status_pivot(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels")
    n = lambda c, name: F.count_if(c).alias(name)
    return docs.join(labels, "doc_id", "left").groupBy("source").agg(
        n(F.col("quality") == 1, "good"), n(F.col("quality") == 0, "poor"), n(F.col("toxic") == 1, "toxic"), n(F.col("quality").isNull(), "pending"))


@register("prf_scores", """WITH c AS (SELECT d.source, count(*) FILTER (WHERE quality = 1 AND n_chars >= 800) AS tp, count(*) FILTER (WHERE quality = 0 AND n_chars >= 800) AS fp,
  count(*) FILTER (WHERE quality = 1 AND n_chars < 800) AS fn FROM documents d JOIN labels USING (doc_id) GROUP BY d.source)
SELECT source, tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp / (tp + fn) END, 6) AS recall FROM c""")
def prf_scores(spark: SparkSession, d: str) -> DataFrame:
    """AGG-19: a length rule against gold labels."""
    j = table(spark, d, "documents").select("doc_id", "source", "n_chars").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    long, good = F.col("n_chars") >= 800, F.col("quality") == 1
    c = j.groupBy("source").agg(F.count_if(good & long).alias("tp"), F.count_if((F.col("quality") == 0) & long).alias("fp"), F.count_if(good & ~long).alias("fn"))
    rate = lambda a, b: F.round(F.when(F.col(a) + F.col(b) == 0, 1.0).otherwise(F.col(a) / (F.col(a) + F.col(b))), 6)
    return c.withColumns({"precision": rate("tp", "fp"), "recall": rate("tp", "fn")})


@register("content_cooccurrence", """WITH g AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM events GROUP BY 1, 2)
SELECT user_id, day, errors, purchases FROM g WHERE errors > 0 AND purchases > 0""")
def content_cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    """JON-15: both sides counted in one aggregation instead of two and a join."""
    g = table(spark, d, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    n = lambda t, name: F.count_if(F.col("event_type") == t).alias(name)
    return g.agg(n("error", "errors"), n("purchase", "purchases")).where("errors > 0 and purchases > 0")


@register("sentence_split", r"""SELECT conv_id, turn, unnest(s) AS sentence, unnest(range(len(s))) AS idx FROM (SELECT conv_id, turn, string_split(regexp_replace(text || ' Then. we go? "Yes" (No) 3', '([.!?])\s+([A-Z0-9"''(\[])', '\1' || chr(31) || '\2', 'g'), chr(31)) AS s FROM conversations)""")
def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    """STR-04."""
    t = table(spark, d, "conversations").withColumn("text", F.concat("text", F.lit(' Then. we go? "Yes" (No) 3')))
    return t.select("conv_id", "turn", F.posexplode(X.sentences(F.col("text"))).alias("idx", "sentence"))


@register("unit_ledger", r"""WITH s AS (SELECT conv_id::VARCHAR AS content_id, turn AS cue_index, role AS speaker_id, string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?])\s+([A-Z0-9"''(\[])', '\1' || chr(31) || '\2', 'g'), chr(31)) AS s FROM conversations), u AS (SELECT content_id, cue_index, speaker_id, unnest(s) AS text, unnest(range(len(s))) AS i FROM s)
SELECT content_id, cue_index, i AS sentence_index, text, 'TU_' || upper(substr(sha256(concat_ws(chr(31), 'sha', content_id, (cue_index * 4)::VARCHAR, (cue_index * 4 + 3)::VARCHAR, speaker_id, text, i::VARCHAR, 'caption_overlap_v2')), 1, 24)) AS unit_id FROM u WHERE text <> ''""")
def unit_ledger(spark: SparkSession, d: str) -> DataFrame:
    """TXT-14, STR-04, STR-10: times as whole seconds, for an id takes their text."""
    t = table(spark, d, "conversations")
    seg = t.select(F.col("conv_id").cast("string").alias("content_id"), F.lit("sha").alias("source_sha"), F.col("turn").alias("cue_index"), (F.col("turn") * 4).alias("start"), (F.col("turn") * 4 + 3).alias("end"), F.col("role").alias("speaker_id"), "text")
    return mentions.unit_ledger(seg).select("content_id", "cue_index", "sentence_index", "text", "unit_id")


#: Each document's first words with a reference among them, and what it stands for.
REFERENCES = [("&eacute;", "é"), ("&#8217;", "’"), ("&#x27;", "'"), ("&copy", "©"), ("&notit;", "¬it;"), ("&#128;", "€"), ("&amp;lt;", "&lt;"), ("&bogus;", "&bogus;"), ("&#0;", "\ufffd"), ("&NotEqualTilde;", "≂̸"), ("&", "&"), ("&#x1F600;", "😀"), ("&#1;", "")]
_CASE = lambda k: f"CASE doc_id % {len(REFERENCES)} {' '.join(f"WHEN {i} THEN '{r[k].replace(chr(39), chr(39) * 2)}'" for i, r in enumerate(REFERENCES))} END"


@register("decoded_references", rf"""SELECT doc_id, left(t, 20) || {_CASE(1)} || ' ' || t AS decoded FROM (SELECT doc_id, regexp_replace(text, '[&<>]+', ' ', 'g') AS t FROM documents)""")
def decoded_references(spark: SparkSession, d: str) -> DataFrame:
    """STR-06."""
    t = F.regexp_replace("text", "[&<>]+", " ")
    return table(spark, d, "documents").select("doc_id", X.unescape(F.concat(F.left(t, F.lit(20)), F.expr(_CASE(0)), F.lit(" "), t)).alias("decoded"))

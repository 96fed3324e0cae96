"""Queries over the semantic review: validation, child tables, checks, verification, the seven views, scoring.

Inputs are made from the events table by SQL texts that Spark and DuckDB share; what is computed from them is written
twice. Codes, statuses and rules in the SQL are stated there again, not taken from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import mentions
from ..operators import review as R
from .base import duck, made, values
from .registry import register

#: Predicates that the made events take in turn: code, family, whether a relationship may come of it.
CODES = """FEAR_APPEAL URGENCY_APPEAL SCARCITY_APPEAL EXCLUSIVITY_APPEAL AUTHORITY_APPEAL INSIDER_APPEAL MORAL_APPEAL PATRIOTIC_APPEAL RELIGIOUS_APPEAL ANGER_APPEAL
DISGUST_APPEAL HOPE_APPEAL GREED_APPEAL SOCIAL_PROOF_APPEAL US_VS_THEM_FRAMING ENEMY_FRAMING VICTIM_FRAMING HERO_FRAMING SCAPEGOAT_FRAMING INEVITABILITY_FRAMING CATASTROPHE_FRAMING
CONSPIRACY_FRAMING SECRECY_FRAMING ISSUES_URGENCY ISSUES_CALL_TO_PREPARE RECOMMENDS RECOMMENDS_AS_SOURCE RECOMMENDS_SHOW RECOMMENDS_CHANNEL RECOMMENDS_NEWSLETTER PROMOTES_PRODUCT
RECOMMENDS_PRODUCT ADVERTISES AFFILIATE_PROMOTES CALLS_TO_BUY CALLS_TO_SUBSCRIBE CALLS_TO_DONATE CALLS_TO_INVEST CROSS_PROMOTES LINKS_AUDIENCE_TO CALLS_DISHONEST CALLS_FRAUDULENT
CALLS_SCAM CALLS_LIE CALLS_CORRUPT CALLS_COMPROMISED QUESTIONS_CREDIBILITY QUESTIONS_MOTIVES ACCUSES_FRAUD ACCUSES_THEFT ACCUSES_COLLUSION PRAISES MENTIONS OWNS FALSE_STATEMENT
DEFAMATORY_STATEMENT NOT_IN_LIST""".split()
FAMILIES = "CASE WHEN code LIKE '%APPEAL' OR code LIKE '%FRAMING' THEN 'rhetoric' WHEN code LIKE 'CALLS%' OR code LIKE 'ACCUSES%' THEN 'allegation' ELSE 'other' END"
ONTOLOGY = f"SELECT code AS predicate_code, {FAMILIES} AS family, CASE WHEN code IN ('OWNS', 'PRAISES') THEN 'YES' ELSE 'NO' END AS relationship_graph_eligible FROM (VALUES {values(CODES[:-1])}) AS p(i, code)"

EV = f"""SELECT CAST(event_id AS STRING) AS semantic_event_id, 'U' || CAST(event_id % 997 AS STRING) AS unit_id, 'C' || CAST(event_id % 97 AS STRING) AS content_id, 'S' || CAST(user_id % 40 AS STRING) AS speaker_id,
CASE WHEN event_id % 5 = 0 THEN '' ELSE 'E' || CAST(user_id % 23 AS STRING) END AS source_entity_id, CASE WHEN event_id % 10 = 0 THEN 'one at ' || CAST(user_id % 3 AS STRING) ELSE '' END AS source_surface,
CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'R' || CAST(user_id % 11 AS STRING) END AS reporting_entity_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'T' || CAST(event_id % 13 AS STRING) END AS target_entity_id,
CASE WHEN event_id % 6 = 0 THEN 'thing ' || CAST(event_id % 4 AS STRING) ELSE '' END AS target_surface, CASE WHEN event_id % 9 = 0 THEN 'K' || CAST(event_id % 50 AS STRING) ELSE '' END AS target_claim_id,
p.code AS predicate_code, CASE event_id % 6 WHEN 0 THEN 'NEGATIVE' WHEN 1 THEN 'Positive' WHEN 2 THEN 'NEUTRAL' WHEN 3 THEN 'mixed' WHEN 4 THEN '' END AS polarity,
CASE WHEN event_id % 4 = 0 THEN '' ELSE 'topic ' || CAST(event_id % 5 AS STRING) END AS topic, CASE event_id % 4 WHEN 0 THEN 'ADOPTS' WHEN 1 THEN 'NEUTRAL_REPORT' WHEN 2 THEN 'REJECTS' ELSE '' END AS speaker_adoption,
CASE event_id % 5 WHEN 0 THEN 'CHECKABLE' WHEN 1 THEN 'PARTLY_CHECKABLE' WHEN 2 THEN 'HIGH_PRIORITY' WHEN 3 THEN 'NONE' ELSE '' END AS fact_check_need,
CASE event_id % 11 % 4 WHEN 0 THEN '["K' || CAST(event_id AS STRING) || '","K' || CAST(event_id + 1 AS STRING) || '"]' WHEN 1 THEN '[]' WHEN 2 THEN 'broken' ELSE '["K' || CAST(event_id - 1 AS STRING) || '"]' END AS related_claim_ids_json
FROM {{events}} JOIN (VALUES {values(CODES[:-3])}) AS p(i, code) ON event_id % {len(CODES) - 3} = p.i"""
UNITS = "SELECT DISTINCT 'U' || CAST(event_id % 997 AS STRING) AS unit_id, 'C' || CAST(event_id % 97 % 31 AS STRING) AS content_id, CASE WHEN event_id % 997 % 10 = 3 THEN 'SUPERSEDED' ELSE 'CURRENT' END AS source_status FROM {events} WHERE event_id < 997"
VERIF = "SELECT CAST(event_id AS STRING) AS semantic_event_id, CASE event_id % 8 WHEN 0 THEN 'REJECTED_TEXT' WHEN 4 THEN 'NEEDS_REVIEW' ELSE 'VERIFIED_TEXT' END AS status FROM {events} WHERE event_id % 6 <> 5"
CLAIMS = """SELECT 'K' || CAST(event_id AS STRING) AS claim_id, 'U' || CAST(event_id % 997 AS STRING) AS unit_id, 'it is ' || CAST(event_id AS STRING) AS claim_text, CASE WHEN event_id % 2 = 0 THEN '' ELSE 'E' || CAST(user_id % 23 AS STRING) END AS claimant_entity_id,
CASE WHEN event_id % 14 = 0 THEN '' ELSE 'S' || CAST(user_id % 40 AS STRING) END AS speaker_id, CASE event_id % 4 WHEN 0 THEN 'CHECKABLE' WHEN 1 THEN 'PARTLY_CHECKABLE' WHEN 2 THEN 'OPINION' ELSE 'CHECKABLE' END AS checkability,
CASE event_id % 5 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'verified' WHEN 2 THEN '' ELSE 'UNVERIFIED' END AS fact_check_status FROM {events} WHERE event_id % 3 <> 2"""
CHECKS = """SELECT 'K' || CAST(event_id AS STRING) AS claim_id, CASE event_id % 9 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN 'SUPPORTED_INFERENCE' WHEN 2 THEN 'DISPUTED' WHEN 3 THEN 'UNVERIFIED' WHEN 4 THEN 'CONTRADICTED' WHEN 5 THEN 'OPINION_OR_NOT_CHECKABLE'
WHEN 6 THEN 'NOT_APPLICABLE' WHEN 7 THEN 'pending' ELSE '' END AS status FROM {events} WHERE event_id % 5 = 0"""
PRODUCTS = "SELECT 'C' || CAST(p_partkey % 211 AS STRING) AS content_id, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_name END AS name FROM {part}"
INPUTS = {"ev": EV, "units": UNITS, "verif": VERIF, "claims": CLAIMS, "checks": CHECKS, "products": PRODUCTS}

USED = """, used AS (SELECT e.* FROM ev e JOIN units u ON e.unit_id = u.unit_id AND u.source_status = 'CURRENT' JOIN verif v ON e.semantic_event_id = v.semantic_event_id AND v.status = 'VERIFIED_TEXT'),
tgt AS (SELECT *, coalesce(nullif(source_entity_id, ''), nullif(source_surface, ''), nullif(speaker_id, ''), 'UNKNOWN') AS source, coalesce(nullif(target_entity_id, ''), nullif(target_surface, ''), nullif(target_claim_id, '')) AS target FROM used),
inter AS (SELECT source, target, count(*) AS event_count, count(DISTINCT content_id) AS independent_content_count, count(DISTINCT unit_id) AS unit_count, count(*) FILTER (WHERE lower(polarity) = 'positive') AS positive_count,
count(*) FILTER (WHERE lower(polarity) = 'negative') AS negative_count, count(*) FILTER (WHERE lower(polarity) = 'neutral') AS neutral_count, count(*) FILTER (WHERE lower(polarity) = 'mixed') AS mixed_count,
count(*) FILTER (WHERE predicate_code LIKE 'ACCUSES\\_%' ESCAPE '\\') AS allegation_count,
count(*) FILTER (WHERE predicate_code IN ('RECOMMENDS', 'RECOMMENDS_AS_SOURCE', 'RECOMMENDS_SHOW', 'RECOMMENDS_CHANNEL', 'RECOMMENDS_NEWSLETTER', 'PROMOTES_PRODUCT', 'RECOMMENDS_PRODUCT', 'ADVERTISES', 'AFFILIATE_PROMOTES', 'CALLS_TO_BUY',
'CALLS_TO_SUBSCRIBE', 'CALLS_TO_DONATE', 'CALLS_TO_INVEST', 'CROSS_PROMOTES', 'LINKS_AUDIENCE_TO')) AS promotion_count, count(*) FILTER (WHERE rhetorical) AS rhetorical_event_count,
count(*) FILTER (WHERE fact_check_need IN ('CHECKABLE', 'PARTLY_CHECKABLE', 'HIGH_PRIORITY')) AS checkable_event_count
FROM (SELECT *, predicate_code LIKE '%\\_APPEAL' ESCAPE '\\' OR predicate_code LIKE '%\\_FRAMING' ESCAPE '\\' OR predicate_code IN ('ISSUES_URGENCY', 'ISSUES_CALL_TO_PREPARE') AS rhetorical FROM tgt WHERE target IS NOT NULL) GROUP BY 1, 2)"""


def _json_counts(source: str, by: str, c: str, name: str, where: str = "true") -> str:
    return f"""(SELECT {by}, '{{' || string_agg('"' || {c} || '":' || n, ',' ORDER BY {c}) || '}}' AS {name} FROM (SELECT {by}, coalesce({c}, '') AS {c}, count(*) AS n FROM {source} WHERE {where} GROUP BY ALL) GROUP BY {by})"""


def frames(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {k: made(spark, d, t) for k, t in INPUTS.items()}


def used(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    f = frames(spark, d)
    return R.verified(R.current(f["ev"], f["units"]), f["verif"]), f


@register("view_interactions", f"""{duck(**INPUTS)}{USED} SELECT i.*, predicate_counts_json, coalesce(topic_counts_json, '{{}}') AS topic_counts_json, positive_count > 0 AND negative_count > 0 AS mixed_stance FROM inter i
JOIN {_json_counts("tgt", "source, target", "predicate_code", "predicate_counts_json", "target IS NOT NULL")} USING (source, target) LEFT JOIN {_json_counts("tgt", "source, target", "topic", "topic_counts_json", "target IS NOT NULL AND topic <> ''")} USING (source, target)""")
def view_interactions(spark: SparkSession, d: str) -> DataFrame:
    """SRT-02. SEM-09, AGG-04, FLT-04, FLT-05, JON-01, PRJ-01, JSN-02."""
    return R.interactions(used(spark, d)[0])


@register("view_exposure", f"""{duck(**INPUTS)}{USED}, r AS (SELECT *, coalesce(nullif(reporting_entity_id, ''), nullif(speaker_id, ''), 'UNKNOWN') AS reporting_entity FROM tgt WHERE target IS NOT NULL)
SELECT reporting_entity, target, event_count, independent_content_count, predicate_counts_json, speaker_adoption_counts_json FROM (SELECT reporting_entity, target, count(*) AS event_count, count(DISTINCT content_id) AS independent_content_count FROM r GROUP BY 1, 2)
JOIN {_json_counts("r", "reporting_entity, target", "predicate_code", "predicate_counts_json")} USING (reporting_entity, target) JOIN {_json_counts("r", "reporting_entity, target", "speaker_adoption", "speaker_adoption_counts_json")} USING (reporting_entity, target)""")
def view_exposure(spark: SparkSession, d: str) -> DataFrame:
    """SEM-09, AGG-05."""
    return R.exposure(used(spark, d)[0])


@register("view_pressure", f"""{duck(**INPUTS)}{USED} SELECT target, sum(event_count)::BIGINT AS event_count, count(*) AS distinct_sources, sum(positive_count)::BIGINT AS positive_event_count, sum(negative_count)::BIGINT AS negative_event_count,
count(*) FILTER (WHERE positive_count > 0) AS distinct_positive_sources, count(*) FILTER (WHERE negative_count > 0) AS distinct_negative_sources, sum(allegation_count)::BIGINT AS allegation_count, count(*) FILTER (WHERE allegation_count > 0) AS distinct_allegation_sources,
sum(promotion_count)::BIGINT AS promotion_count, count(*) FILTER (WHERE promotion_count > 0) AS distinct_promoter_sources FROM inter GROUP BY 1""")
def view_pressure(spark: SparkSession, d: str) -> DataFrame:
    """SEM-09, AGG-06."""
    return R.pressure(R.interactions(used(spark, d)[0]))


@register("view_shared_targets", f"""{duck(**INPUTS)}{USED}, o AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY event_count DESC, negative_count DESC, source) AS k FROM inter)
SELECT a.target, a.source AS source_a, b.source AS source_b, least(a.negative_count, b.negative_count) > 0 AS both_negative, least(a.positive_count, b.positive_count) > 0 AS both_positive, least(a.promotion_count, b.promotion_count) > 0 AS both_promote,
a.negative_count AS a_negative, b.negative_count AS b_negative, a.positive_count AS a_positive, b.positive_count AS b_positive, a.promotion_count AS a_promotions, b.promotion_count AS b_promotions FROM o a JOIN o b ON a.target = b.target AND a.k < b.k
WHERE least(a.negative_count, b.negative_count) > 0 OR least(a.positive_count, b.positive_count) > 0 OR least(a.promotion_count, b.promotion_count) > 0""")
def view_shared_targets(spark: SparkSession, d: str) -> DataFrame:
    """SEM-09, JON-13."""
    return R.shared_targets(R.interactions(used(spark, d)[0]))


@register("view_rhetoric_commerce", f"""{duck(**INPUTS)}{USED}, r AS (SELECT * FROM used WHERE predicate_code LIKE '%\\_APPEAL' ESCAPE '\\' OR predicate_code LIKE '%\\_FRAMING' ESCAPE '\\' OR predicate_code IN ('ISSUES_URGENCY', 'ISSUES_CALL_TO_PREPARE')),
p AS (SELECT content_id, count(*) AS product_mention_count, '[' || coalesce(string_agg(DISTINCT '"' || nullif(name, '') || '"', ',' ORDER BY '"' || nullif(name, '') || '"'), '') || ']' AS products_json FROM products GROUP BY 1)
SELECT content_id, rhetorical_event_count, rhetorical_predicates_json, product_mention_count, products_json FROM (SELECT content_id, count(*) AS rhetorical_event_count FROM r GROUP BY 1)
JOIN {_json_counts("r", "content_id", "predicate_code", "rhetorical_predicates_json")} USING (content_id) JOIN p USING (content_id)""")
def view_rhetoric_commerce(spark: SparkSession, d: str) -> DataFrame:
    """SEM-09, AGG-08, JON-15."""
    e, f = used(spark, d)
    return R.rhetoric_commerce(e, f["products"])


STATUS = "c AS (SELECT c.*, upper(coalesce(nullif(k.status, ''), nullif(fact_check_status, ''), 'PENDING')) AS s FROM claims c LEFT JOIN checks k USING (claim_id))"


@register("view_reputation", f"""{duck(**INPUTS)}{USED}, {STATUS}, x AS (SELECT *, regexp_extract_all(related_claim_ids_json, '"([^"]+)"', 1) AS ids FROM used WHERE predicate_code LIKE 'ACCUSES\\_%' ESCAPE '\\'
OR predicate_code IN ('CALLS_DISHONEST', 'CALLS_FRAUDULENT', 'CALLS_SCAM', 'CALLS_LIE', 'CALLS_CORRUPT', 'CALLS_COMPROMISED', 'QUESTIONS_CREDIBILITY', 'QUESTIONS_MOTIVES')),
y AS (SELECT *, unnest(CASE WHEN len(ids) = 0 THEN [''] ELSE ids END) AS cid FROM x)
SELECT semantic_event_id, coalesce(nullif(source_entity_id, ''), y.speaker_id) AS source, coalesce(nullif(target_entity_id, ''), nullif(target_surface, ''), target_claim_id) AS target, predicate_code, cid AS claim_id, coalesce(claim_text, '') AS claim_text,
CASE WHEN cid = '' THEN 'NO_LINKED_CLAIM' ELSE coalesce(s, 'PENDING') END AS fact_status FROM y LEFT JOIN c ON y.cid = c.claim_id""")
def view_reputation(spark: SparkSession, d: str) -> DataFrame:
    """SEM-09, JON-02, FLT-13, JSN-01."""
    e, f = used(spark, d)
    return R.reputation(e, f["claims"], f["checks"])


@register("view_claim_status", f"""{duck(**INPUTS)}, {STATUS}, d AS (SELECT coalesce(nullif(claimant_entity_id, ''), nullif(speaker_id, ''), 'UNKNOWN') AS source, s FROM c)
SELECT source, count(*) AS claim_count, count(*) FILTER (WHERE s IN ('VERIFIED', 'SUPPORTED_INFERENCE', 'DISPUTED', 'UNVERIFIED', 'CONTRADICTED', 'OPINION_OR_NOT_CHECKABLE', 'NOT_APPLICABLE')) AS completed_fact_checks,
count(*) FILTER (WHERE s = 'VERIFIED') AS verified, count(*) FILTER (WHERE s = 'SUPPORTED_INFERENCE') AS supported_inference, count(*) FILTER (WHERE s = 'DISPUTED') AS disputed, count(*) FILTER (WHERE s = 'UNVERIFIED') AS unverified,
count(*) FILTER (WHERE s = 'CONTRADICTED') AS contradicted, count(*) FILTER (WHERE s = 'OPINION_OR_NOT_CHECKABLE') AS opinion_or_not_checkable, count(*) FILTER (WHERE s = 'PENDING') AS pending FROM d GROUP BY 1""")
def view_claim_status(spark: SparkSession, d: str) -> DataFrame:
    """SEM-09, AGG-07, JON-03."""
    f = frames(spark, d)
    return R.claim_status(f["claims"], f["checks"])


@register("fact_queue", f"""{duck(**INPUTS)}, {STATUS.replace("upper(", "(")} SELECT claim_id, unit_id, checkability, s AS fact_check_status FROM c WHERE checkability IN ('CHECKABLE', 'PARTLY_CHECKABLE')
AND s NOT IN ('VERIFIED', 'SUPPORTED_INFERENCE', 'DISPUTED', 'UNVERIFIED', 'CONTRADICTED', 'OPINION_OR_NOT_CHECKABLE', 'NOT_APPLICABLE')""")
def fact_queue(spark: SparkSession, d: str) -> DataFrame:
    """FLT-10, JON-03."""
    f = frames(spark, d)
    return R.fact_queue(R.checked_claims(f["claims"], f["checks"])).select("claim_id", "unit_id", "checkability", "fact_check_status")


NEW_CHECKS = "SELECT 'K' || CAST(event_id AS STRING) AS claim_id, CASE event_id % 4 WHEN 0 THEN 'Disputed' WHEN 1 THEN 'REFUTED' WHEN 2 THEN NULL ELSE 'contradicted' END AS status FROM {events} WHERE event_id % 3 = 0"


@register("fact_gate", f"""{duck(checks=CHECKS, new=NEW_CHECKS)}, n AS (SELECT claim_id, upper(coalesce(status, '')) AS status FROM new),
ok AS (SELECT * FROM n WHERE status IN ('VERIFIED', 'SUPPORTED_INFERENCE', 'DISPUTED', 'UNVERIFIED', 'CONTRADICTED', 'OPINION_OR_NOT_CHECKABLE', 'NOT_APPLICABLE'))
SELECT claim_id, coalesce(ok.status, k.status) AS status, 'kept' AS verdict FROM checks k FULL JOIN ok USING (claim_id) UNION ALL SELECT claim_id, status, 'rejected' FROM n WHERE claim_id NOT IN (SELECT claim_id FROM ok)""")
def fact_gate(spark: SparkSession, d: str) -> DataFrame:
    """SEM-06, SNK-02."""
    kept, gone = R.apply_checks(made(spark, d, CHECKS), made(spark, d, NEW_CHECKS))
    return kept.withColumn("verdict", F.lit("kept")).unionByName(gone.withColumn("verdict", F.lit("rejected")))


NEW_VERIF = "SELECT CAST(event_id AS STRING) AS semantic_event_id, CASE event_id % 4 WHEN 0 THEN 'verified_text' WHEN 1 THEN 'VERIFIED' WHEN 2 THEN 'Needs_Review' ELSE 'rejected_text' END AS status FROM {events} WHERE event_id % 2 = 0"


@register("verification_gate", f"""{duck(verif=VERIF, new=NEW_VERIF)}, ok AS (SELECT semantic_event_id, upper(status) AS status FROM new WHERE upper(status) IN ('VERIFIED_TEXT', 'NEEDS_REVIEW', 'REJECTED_TEXT'))
SELECT semantic_event_id, coalesce(ok.status, v.status) AS status FROM verif v FULL JOIN ok USING (semantic_event_id)""")
def verification_gate(spark: SparkSession, d: str) -> DataFrame:
    """SEM-08."""
    return R.apply_checks(made(spark, d, VERIF), made(spark, d, NEW_VERIF), "semantic_event_id", R.VERIFICATIONS)[0]


LEDGER = "SELECT 'U' || CAST(event_id % 997 AS STRING) AS unit_id, CASE WHEN event_id % 7 = 0 THEN 'PENDING' ELSE 'COMPLETE' END AS semantic_status, 'OPEN' AS fact_status FROM {events} WHERE event_id < 997"


@register("unit_completion", f"""{duck(ledger=LEDGER, claims=CLAIMS)}, p AS (SELECT unit_id, bool_and(fact_check_status IN ('VERIFIED', 'SUPPORTED_INFERENCE', 'DISPUTED', 'UNVERIFIED', 'CONTRADICTED', 'OPINION_OR_NOT_CHECKABLE', 'NOT_APPLICABLE')) AS a
FROM claims WHERE checkability IN ('CHECKABLE', 'PARTLY_CHECKABLE') GROUP BY 1) SELECT unit_id, semantic_status, CASE WHEN semantic_status <> 'COMPLETE' THEN fact_status WHEN a IS NULL THEN 'NOT_APPLICABLE' WHEN a THEN 'COMPLETE' ELSE 'PENDING' END AS fact_status FROM ledger LEFT JOIN p USING (unit_id)""")
def unit_completion(spark: SparkSession, d: str) -> DataFrame:
    """AGG-18."""
    return R.unit_completion(made(spark, d, LEDGER), made(spark, d, CLAIMS))


INDEX = "SELECT CAST(event_id AS STRING) AS semantic_event_id, CASE event_id % 3 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'QUEUED' ELSE 'DONE' END AS status FROM {events} WHERE event_id % 5 = 1"


@register("pending_verification", f"""{duck(ev=EV, units=UNITS, verif=VERIF, ix=INDEX)} SELECT e.semantic_event_id, e.unit_id FROM ev e JOIN units u ON e.unit_id = u.unit_id AND source_status = 'CURRENT'
WHERE NOT EXISTS (SELECT 1 FROM verif v WHERE v.semantic_event_id = e.semantic_event_id AND v.status IN ('VERIFIED_TEXT', 'REJECTED_TEXT')) AND NOT EXISTS (SELECT 1 FROM ix WHERE ix.semantic_event_id = e.semantic_event_id AND ix.status IN ('PENDING', 'QUEUED'))""")
def pending_verification(spark: SparkSession, d: str) -> DataFrame:
    """FLT-09."""
    f = frames(spark, d)
    return R.pending_verification(f["ev"], f["units"], f["verif"], made(spark, d, INDEX)).select("semantic_event_id", "unit_id")


@register("superseded_index", f"""{duck(units=UNITS, ev=EV)}, ix AS (SELECT unit_id, max(CASE WHEN semantic_event_id::INT % 4 = 0 THEN '' WHEN semantic_event_id::INT % 4 = 1 THEN 'PENDING' ELSE 'DONE' END) AS status FROM ev GROUP BY 1)
SELECT ix.unit_id, CASE WHEN u.unit_id IS NULL AND status IN ('PENDING', 'QUEUED', '') THEN 'SUPERSEDED' ELSE status END AS status FROM ix LEFT JOIN units u ON u.unit_id = ix.unit_id AND u.source_status = 'CURRENT'""")
def superseded_index(spark: SparkSession, d: str) -> DataFrame:
    """SEM-01: stale entries of the batch index."""
    n = F.col("semantic_event_id").cast("int") % 4
    ix = made(spark, d, EV).groupBy("unit_id").agg(F.max(F.when(n == 0, "").when(n == 1, "PENDING").otherwise("DONE")).alias("status"))
    return R.superseded_index(ix, made(spark, d, UNITS))


CAPS = """SELECT 'U' || CAST(event_id AS STRING) AS unit_id, CASE WHEN event_id % 3 = 0 THEN 'diarized' ELSE 'youtube_caption' END AS source_type, CASE WHEN event_id % 11 = 0 THEN 'SUPERSEDED' ELSE 'CURRENT' END AS source_status,
CASE WHEN event_id % 4 = 0 THEN 'COMPLETE' WHEN event_id % 4 = 1 THEN NULL ELSE 'PENDING' END AS semantic_status, CASE WHEN event_id % 8 = 0 THEN 'COMPLETE' ELSE 'PENDING' END AS fact_status FROM {events}"""
DONE = "SELECT 'U' || CAST(event_id AS STRING) AS unit_id FROM {events} WHERE event_id % 6 = 1"
ATTR = "SELECT 'U' || CAST(event_id AS STRING) AS unit_id FROM {events} WHERE event_id % 5 < 2"


@register("review_split", f"""{duck(caps=CAPS, done=DONE, attr=ATTR)} SELECT unit_id, source_type <> 'youtube_caption' OR unit_id IN (SELECT unit_id FROM attr) AS ready FROM caps
WHERE source_status = 'CURRENT' AND coalesce(semantic_status, '') <> 'COMPLETE' AND unit_id NOT IN (SELECT unit_id FROM done)""")
def review_split(spark: SparkSession, d: str) -> DataFrame:
    """FLT-08: units to review now, and captions deferred until they are attributed."""
    now, later = R.deferred_split(*(made(spark, d, t) for t in (CAPS, DONE, ATTR)))
    return now.select("unit_id", F.lit(True).alias("ready")).unionByName(later.select("unit_id", F.lit(False).alias("ready")))


@register("pending_units", f"""{duck(caps=CAPS)} SELECT unit_id FROM caps WHERE source_status = 'CURRENT' AND (coalesce(semantic_status, '') <> 'COMPLETE' OR coalesce(fact_status, '') <> 'COMPLETE')""")
def pending_units(spark: SparkSession, d: str) -> DataFrame:
    """FLT-07."""
    return mentions.pending(made(spark, d, CAPS)).select("unit_id")


# ---- review documents

#: One review document per event, before its collections are built.
BASE = f"""SELECT 'U' || CAST(event_id AS STRING) AS unit_id, event_id AS n, 'C' || CAST(event_id % 97 AS STRING) AS content_id, 'S' || CAST(user_id % 40 AS STRING) AS speaker_id, 'AC' || CAST(user_id % 7 AS STRING) AS acoustic_cluster_id,
'E' || CAST(user_id % 23 AS STRING) AS resolved_entity_id, CASE WHEN event_id % 2 = 0 THEN 'P' || CAST(user_id % 9 AS STRING) ELSE '' END AS speaker_entity_id, p.code, event_type FROM {{events}} JOIN (VALUES {values(CODES)}) AS p(i, code) ON event_id % {len(CODES)} = p.i"""


def docs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Review documents and their units."""
    b = made(spark, d, BASE)
    n = F.col("n")
    s = lambda k, *names: F.get(F.array(*[F.lit(x) for x in names]), (n % k).cast("int")).alias
    t = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    event = F.struct(
        F.lower("code").alias("predicate_code"), F.when(n % 9 == 0, "").otherwise(t(" says  ", F.col("event_type"))).alias("raw_predicate"), s(4, "", "RHETORIC", "other", "Allegation")("predicate_family"),
        s(3, "", "X1", None)("source_entity_id"), F.lit(" a  one ").alias("source_surface"), s(2, "T1", "")("target_entity_id"), t("the  thing ", n % 5).alias("target_surface"), F.lit(None).cast("string").alias("target_claim_id"),
        s(5, "", "topic A", "B", None, "C")("topic"), s(4, "negative", "", None, "Positive")("polarity"), s(5, "", "NEUTRAL_REPORT", "adopts", None, "REJECTS")("speaker_adoption"), s(3, "own_claim", "", None)("attribution_mode"),
        s(4, "", "HEDGED", None, "ASSERTED")("certainty"), s(3, "implicit", "", None)("explicitness"), s(6, "", "AD", None, "NONE", "SPONSORED", "")("commerciality"), s(4, "documented", "", None, "ALLEGED")("relationship_evidence_state"),
        s(7, "checkable", "", None, "PARTLY_CHECKABLE", "HIGH_PRIORITY", "NONE", "OPINION")("fact_check_need"), s(3, "high", "", None)("severity"), s(4, "true", "no", None, "1")("negated"), s(3, "", "yes", None)("conditional"), s(5, "y", "", None, "0", "n")("hypothetical"),
        F.array(F.lit("C1"), F.lit("own"), F.lit("none")).alias("related_claim_refs"), F.lit(None).cast("string").alias("object_entity_id"), F.lit("").alias("object_surface"), F.lit(None).cast("string").alias("semantic_event_id"), F.lit("").alias("actor_resolution_status"))
    mention = F.struct(F.when(n % 6 == 0, "").otherwise(t("  Name  ", n % 31)).alias("surface"), F.when(n % 12 == 0, "text name").alias("text"), F.lit(None).cast("string").alias("normalized_surface"), s(3, "person", "", None)("entity_type"), s(2, "E9", "")("canonical_entity_id"),
        F.lit("").alias("resolution_status"), s(3, "", "implied", None)("reference_mode"), s(3, "yes", "false", None)("transcript_fragmented"), s(2, "", "Better name")("correction_candidate"), F.lit(None).cast("string").alias("mention_id"))
    claim = lambda k, name: F.struct(F.lit(name).alias("local_claim_id"), F.when(n % 10 == k, "").otherwise(t("It  is ", n % 50, f" {k}")).alias("claim_text"), F.when(n % 7 == k, t("GIVEN", n)).alias("claim_id"),
        s(4, "", "checkable", "OPINION", None)("checkability"), F.lit(None).cast("string").alias("claim_type"), s(2, "", "high")("severity"), s(2, "E1", None)("claimant_entity_id"))
    some = lambda c, k: F.when(n % 3 != k, F.array(c)).otherwise(F.expr("array()"))
    out = b.select(
        "unit_id", "speaker_entity_id", F.array(event).alias("semantic_events"), F.array(mention).alias("mentions"), F.when(n % 3 != 1, F.array(claim(0, None), claim(1, "own"))).otherwise(F.array()).alias("atomic_claims"),
        some(F.struct(F.lit("S1").alias("subject_entity_id"), s(2, "O1", None)("object_entity_id"), F.lit("KNOWS").alias("relationship_type"), t("They  met ", n % 12).alias("description"), F.lit(None).cast("string").alias("relationship_claim_id")), 0).alias("relationships"),
        some(F.struct(s(3, "criticizes", "", "PRAISES")("stance_type"), s(2, "T2", "")("target_entity_id"), s(5, "", "K1", "", "", "K2")("target_claim_id"), F.lit("a topic").alias("topic"), t("he said ", n % 5).alias("excerpt"), s(2, "", None)("source_entity_id"), s(2, "", "rejects")("speaker_adoption"), F.lit(None).cast("string").alias("stance_event_id")), 1).alias("stances"),
        some(F.struct(s(2, "", "AC_X")("target_acoustic_cluster_id"), F.lit(None).cast("string").alias("target_raw_speaker_id"), s(3, "E5", "", None)("claimed_entity_id"), s(4, "", "A  Person", "", None)("claimed_name"), F.lit("host_introduction").alias("evidence_type"), F.lit("this is").alias("evidence_text"), F.lit(None).cast("string").alias("identity_clue_id")), 2).alias("speaker_identity_clues"),
        some(F.struct(t("Product  ", n % 8).alias("name"), s(2, "sold", None)("role"), F.lit(None).cast("string").alias("product_mention_id")), 0).alias("products"),
        some(F.struct(t("It will  ", n % 8).alias("prediction_text"), s(2, "OPEN", None)("status"), F.lit(None).cast("string").alias("prediction_id")), 1).alias("predictions"),
        some(F.struct(F.lit("PAYMENT").alias("signal_type"), t("pays ", n % 8).alias("description"), F.lit(None).cast("string").alias("signal_id")), 2).alias("money_or_conflict_signals"),
        some(F.struct(t("Paper ", n % 8).alias("name"), s(2, "http://x", None)("url"), F.lit(None).cast("string").alias("citation_mention_id")), 0).alias("citations_or_sources_mentioned"))
    return out, b.select("unit_id", "content_id", "speaker_id", "acoustic_cluster_id", "resolved_entity_id")


def sid(prefix: str, *parts: str) -> str:
    """An id over parts, in SQL."""
    joined = " || chr(31) || ".join(f"trim(regexp_replace(lower(coalesce({p}, '')), '\\s+', ' ', 'g'))" for p in parts)
    return f"'{prefix}' || upper(substr(sha256({joined}), 1, 24))"


def pick(k: int, *names: str | None) -> str:
    return f"(CASE n % {k} " + " ".join(f"WHEN {i} THEN " + ("NULL" if x is None else f"'{x}'") for i, x in enumerate(names)) + " END)"


@register("child_mentions", f"""{duck(b=BASE)}, m AS (SELECT *, CASE WHEN n % 12 = 0 THEN 'text name' WHEN n % 6 = 0 THEN '' ELSE 'Name ' || (n % 31) END AS surface FROM b)
SELECT {sid("MN_", "unit_id", "surface", pick(3, "person", "", None))} AS mention_id, unit_id, content_id, surface, surface AS normalized_surface, coalesce({pick(3, "person", "", None)}, '') AS entity_type, {pick(2, "E9", "")} AS canonical_entity_id,
CASE n % 2 WHEN 0 THEN 'RESOLVED' ELSE 'UNRESOLVED' END AS resolution_status, {pick(3, "EXPLICIT", "IMPLIED", "EXPLICIT")} AS reference_mode, {pick(2, "", "Better name")} AS correction_candidate FROM m WHERE surface <> ''""")
def child_mentions(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03, STR-11."""
    return R.mentions_table(*docs(spark, d))


REFS = f"""CASE WHEN n % 3 = 1 THEN '[]' ELSE '[' || concat_ws(',', CASE WHEN n % 10 <> 0 THEN '"' || (CASE WHEN n % 7 = 0 THEN 'GIVEN' || n ELSE {sid("CL_", "unit_id", "'It is ' || (n % 50) || ' 0'")} END) || '"' END,
CASE WHEN n % 10 <> 1 THEN '"' || (CASE WHEN n % 7 = 1 THEN 'GIVEN' || n ELSE {sid("CL_", "unit_id", "'It is ' || (n % 50) || ' 1'")} END) || '"' END) || ']' END"""


@register("child_events", f"""{duck(b=BASE, o=ONTOLOGY)}, e AS (SELECT *, CASE WHEN speaker_entity_id <> '' THEN speaker_entity_id ELSE resolved_entity_id END AS reporting_entity_id, CASE WHEN n % 9 = 0 THEN '' ELSE 'says ' || event_type END AS raw_predicate,
{pick(2, "T1", "")} AS target_entity_id, 'the thing ' || (n % 5) AS target_surface, coalesce({pick(5, "", "topic A", "B", None, "C")}, '') AS topic FROM b JOIN o ON code = predicate_code),
f AS (SELECT *, coalesce(nullif({pick(3, "", "X1", None)}, ''), reporting_entity_id) AS source_entity_id FROM e)
SELECT {sid("SE_", "unit_id", "predicate_code", "source_entity_id", "target_entity_id", "target_surface", "''", "''", "''", "raw_predicate", "topic")} AS semantic_event_id, unit_id, content_id, speaker_id, reporting_entity_id, source_entity_id, 'a one' AS source_surface,
'RESOLVED' AS actor_resolution_status, predicate_code, upper(family) AS predicate_family, raw_predicate, target_entity_id, target_surface, '' AS target_claim_id, {REFS} AS related_claim_ids_json, topic,
{pick(4, "NEGATIVE", "NOT_APPLICABLE", "NOT_APPLICABLE", "POSITIVE")} AS polarity, {pick(5, "ADOPTS", "NEUTRAL_REPORT", "ADOPTS", "ADOPTS", "REJECTS")} AS speaker_adoption, 'OWN_CLAIM' AS attribution_mode, {pick(4, "ASSERTED", "HEDGED", "ASSERTED", "ASSERTED")} AS certainty,
{pick(3, "IMPLICIT", "EXPLICIT", "EXPLICIT")} AS explicitness, {pick(6, "NONE", "AD", "NONE", "NONE", "SPONSORED", "NONE")} AS commerciality, {pick(4, "DOCUMENTED", "NONE", "NONE", "ALLEGED")} AS relationship_evidence_state,
{pick(7, "CHECKABLE", "NONE", "NONE", "PARTLY_CHECKABLE", "HIGH_PRIORITY", "NONE", "OPINION")} AS fact_check_need, {pick(3, "HIGH", "LOW", "LOW")} AS severity, n % 4 IN (0, 3) AS negated, n % 3 = 1 AS conditional, n % 5 = 0 AS hypothetical FROM f""")
def child_events(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03, SEM-04, PRJ-01, PRJ-02, JSN-04."""
    return R.events_table(*docs(spark, d), made(spark, d, ONTOLOGY))


DOC_CHECKS = "SELECT 'GIVEN' || CAST(event_id AS STRING) AS claim_id, CASE event_id % 3 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN '' ELSE 'DISPUTED' END AS status FROM {events}"


@register("child_claims", f"""{duck(b=BASE, k=DOC_CHECKS)}, c AS (SELECT *, unnest([0, 1]) AS j FROM b WHERE n % 3 <> 1), d AS (SELECT *, 'It is ' || (n % 50) || ' ' || j AS claim_text FROM c WHERE n % 10 <> j),
e AS (SELECT *, CASE WHEN n % 7 = j THEN 'GIVEN' || n ELSE {sid("CL_", "unit_id", "claim_text")} END AS claim_id, {pick(4, "CHECKABLE", "CHECKABLE", "OPINION", "CHECKABLE")} AS checkability FROM d)
SELECT claim_id, unit_id, content_id, speaker_id, claim_text, 'other' AS claim_type, checkability, {pick(2, "LOW", "HIGH")} AS severity, {pick(2, "E1", "")} AS claimant_entity_id,
coalesce(nullif(k.status, ''), CASE WHEN checkability IN ('CHECKABLE', 'PARTLY_CHECKABLE') THEN 'PENDING' ELSE 'NOT_APPLICABLE' END) AS fact_check_status FROM e LEFT JOIN k USING (claim_id)""")
def child_claims(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03, SEM-05, JON-03, JON-04."""
    return R.claims_table(*docs(spark, d), made(spark, d, DOC_CHECKS))


@register("child_relationships", f"""{duck(b=BASE)}, r AS (SELECT *, 'They  met ' || (n % 12) AS raw FROM b WHERE n % 3 <> 0)
SELECT {sid("RL_", "unit_id", "raw", """'{"description": "' || raw || CASE n % 2 WHEN 0 THEN '", "object_entity_id": "O1' ELSE '' END || '", "relationship_type": "KNOWS", "subject_entity_id": "S1"}'""")} AS relationship_claim_id, unit_id, content_id,
'S1' AS subject_entity_id, {pick(2, "O1", "")} AS object_entity_id, 'KNOWS' AS relationship_type, 'They met ' || (n % 12) AS description FROM r""")
def child_relationships(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03."""
    return R.relationships_table(*docs(spark, d))


@register("child_stances", f"""{duck(b=BASE)}, s AS (SELECT *, {pick(3, "CRITICIZES", "", "PRAISES")} AS stance_type, {pick(2, "T2", "")} AS target_entity_id, {pick(5, "", "K1", "", "", "K2")} AS target_claim_id FROM b WHERE n % 3 <> 1)
SELECT {sid("ST_", "unit_id", "target_entity_id", "target_claim_id", "stance_type", "'a topic'", "'he said ' || (n % 5)")} AS stance_event_id, unit_id, content_id, speaker_entity_id AS source_entity_id, target_entity_id, target_claim_id, stance_type, 'a topic' AS topic,
{pick(2, "ADOPTS", "REJECTS")} AS speaker_adoption FROM s WHERE stance_type <> '' AND (target_entity_id <> '' OR target_claim_id <> '')""")
def child_stances(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03."""
    return R.stances_table(*docs(spark, d))


@register("child_clues", f"""{duck(b=BASE)}, c AS (SELECT *, CASE n % 2 WHEN 0 THEN acoustic_cluster_id ELSE 'AC_X' END AS cluster, coalesce({pick(3, "E5", "", None)}, '') AS claimed_entity_id, coalesce({pick(4, "", "A Person", "", None)}, '') AS claimed_name FROM b WHERE n % 3 <> 2)
SELECT {sid("IC_", "unit_id", "cluster", "speaker_id", "claimed_entity_id", "claimed_name", "'HOST_INTRODUCTION'", "'this is'")} AS identity_clue_id, unit_id, content_id, cluster AS target_acoustic_cluster_id, speaker_id AS target_raw_speaker_id, claimed_entity_id, claimed_name,
'HOST_INTRODUCTION' AS evidence_type FROM c WHERE claimed_entity_id <> '' OR claimed_name <> ''""")
def child_clues(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03."""
    return R.clues_table(*docs(spark, d))


@register("child_products", f"""{duck(b=BASE)} SELECT {sid("PM_", "unit_id", "'Product ' || (n % 8)", """'{"name": "Product  ' || (n % 8) || CASE n % 2 WHEN 0 THEN '", "role": "sold' ELSE '' END || '"}'""")} AS product_mention_id, unit_id, content_id, 'Product ' || (n % 8) AS name, {pick(2, "sold", "")} AS role FROM b WHERE n % 3 <> 0""")
def child_products(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03."""
    return R.products_table(*docs(spark, d))


@register("child_predictions", f"""{duck(b=BASE)} SELECT {sid("PD_", "unit_id", "'It will ' || (n % 8)")} AS prediction_id, unit_id, content_id, 'It will ' || (n % 8) AS prediction_text, {pick(2, "OPEN", "PENDING")} AS status FROM b WHERE n % 3 <> 1""")
def child_predictions(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03."""
    return R.predictions_table(*docs(spark, d))


@register("child_money", f"""{duck(b=BASE)} SELECT {sid("MC_", "unit_id", "'pays ' || (n % 8)", """'{"description": "pays ' || (n % 8) || '", "signal_type": "PAYMENT"}'""")} AS signal_id, unit_id, content_id, 'PAYMENT' AS signal_type, 'pays ' || (n % 8) AS description FROM b WHERE n % 3 <> 2""")
def child_money(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03."""
    return R.money_table(*docs(spark, d))


@register("child_citations", f"""{duck(b=BASE)} SELECT {sid("CS_", "unit_id", "'Paper ' || (n % 8)", """'{"name": "Paper ' || (n % 8) || CASE n % 2 WHEN 0 THEN '", "url": "http://x' ELSE '' END || '"}'""")} AS citation_mention_id, unit_id, content_id, 'Paper ' || (n % 8) AS citation_text, {pick(2, "http://x", "")} AS url FROM b WHERE n % 3 <> 0""")
def child_citations(spark: SparkSession, d: str) -> DataFrame:
    """SEM-03."""
    return R.citations_table(*docs(spark, d))


def _missing(field: str, filled: str) -> str:
    return f"SELECT unit_id, 'error' AS level, 'missing_required:{field}' AS rule, code FROM k WHERE coalesce({filled}, '') = ''"


@register("review_violations", f"""{duck(b=BASE, o=ONTOLOGY)}, k AS (SELECT b.*, family, relationship_graph_eligible AS eligible, upper(coalesce({pick(5, "", "NEUTRAL_REPORT", "adopts", None, "REJECTS")}, '')) AS adoption, {pick(3, "own_claim", "", None)} AS mode,
CASE WHEN n % 9 = 0 THEN '' ELSE 'x' END AS raw, upper({pick(4, "", "RHETORIC", "other", "Allegation")}) AS fam, {pick(4, "documented", "", None, "ALLEGED")} AS state, {pick(7, "checkable", "", None, "PARTLY_CHECKABLE", "HIGH_PRIORITY", "NONE", "OPINION")} AS need FROM b JOIN o ON b.code = o.predicate_code)
SELECT unit_id, 'error' AS level, 'unknown_predicate' AS rule, code FROM b WHERE code NOT IN (SELECT predicate_code FROM o)
UNION ALL {_missing("raw_predicate", "raw")} UNION ALL {_missing("speaker_adoption", "adoption")} UNION ALL {_missing("attribution_mode", "mode")} UNION ALL {_missing("certainty", pick(4, "", "HEDGED", None, "ASSERTED"))} UNION ALL {_missing("explicitness", pick(3, "implicit", "", None))}
UNION ALL {_missing("polarity", pick(4, "negative", "", None, "Positive"))} UNION ALL SELECT unit_id, 'error', 'family_mismatch', code FROM k WHERE fam <> '' AND fam <> upper(family)
UNION ALL SELECT unit_id, 'error', 'verdict_predicate', code FROM k WHERE code IN ('TRUE_STATEMENT', 'FALSE_STATEMENT', 'ACCURATE_STATEMENT', 'INACCURATE_STATEMENT', 'DEFAMATORY_STATEMENT', 'SLANDEROUS_STATEMENT', 'LIBELOUS_STATEMENT')
UNION ALL SELECT unit_id, 'error', 'missing_adoption', code FROM k WHERE (starts_with(code, 'ACCUSES_') OR starts_with(code, 'CALLS_')) AND adoption = ''
UNION ALL SELECT unit_id, 'error', 'neutral_own_claim', code FROM k WHERE adoption = 'NEUTRAL_REPORT' AND upper(mode) = 'OWN_CLAIM'
UNION ALL SELECT unit_id, 'error', 'discourse_documented', code FROM k WHERE upper(state) = 'DOCUMENTED' AND eligible = 'NO'
UNION ALL SELECT unit_id, 'warning', 'check_without_claims', code FROM k WHERE upper(need) IN ('CHECKABLE', 'PARTLY_CHECKABLE', 'HIGH_PRIORITY') AND n % 3 = 1
UNION ALL SELECT unit_id, 'warning', 'negated_adopts', code FROM k WHERE n % 4 IN (0, 3) AND adoption = 'ADOPTS'
UNION ALL SELECT unit_id, 'error', 'mention_without_surface', '' FROM b WHERE n % 6 = 0 AND n % 12 <> 0 UNION ALL SELECT unit_id, 'warning', 'fragmented_without_correction', '' FROM b WHERE n % 3 = 0 AND n % 2 = 0""")
def review_violations(spark: SparkSession, d: str) -> DataFrame:
    """SEM-02."""
    return R.violations(docs(spark, d)[0], made(spark, d, ONTOLOGY))


TURNS = "SELECT CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS unit_id, CAST(conv_id % 17 AS STRING) AS content_id, CAST(conv_id * 100 + turn AS DOUBLE) AS start, text FROM {conversations}"


@register("batch_records", f"""{duck(t=TURNS)}, w AS (SELECT *, row_number() OVER o AS k, lag(unit_id, 2) OVER o AS b2, lag(unit_id) OVER o AS b1, lead(unit_id) OVER o AS a1, lead(unit_id, 2) OVER o AS a2 FROM t WINDOW o AS (PARTITION BY content_id ORDER BY start, unit_id)),
i AS (SELECT content_id, (k - 1) // 40 AS bn, 'SR_' || upper(substr(sha256(string_agg(unit_id, '|' ORDER BY k)), 1, 20)) AS batch_id FROM w GROUP BY 1, 2)
SELECT batch_id, unit_id, k AS ordinal, concat_ws(',', b2, b1) AS before, concat_ws(',', a1, a2) AS after FROM w JOIN i ON w.content_id = i.content_id AND (k - 1) // 40 = bn""")
def batch_records(spark: SparkSession, d: str) -> DataFrame:
    """SEM-01, SEM-07, JSN-03, WIN-01, WIN-12, STR-13: the ids are read back from the nested records."""
    r = R.batch_records(R.review_batches(made(spark, d, TURNS)))
    kind = "unit struct<unit_id:string>, context_before array<struct<unit_id:string,text:string>>, context_after array<struct<unit_id:string,text:string>>"
    x = r.select("batch_id", "ordinal", F.from_json("record", kind).alias("r"))
    return x.select("batch_id", "r.unit.unit_id", "ordinal", F.array_join("r.context_before.unit_id", ",").alias("before"), F.array_join("r.context_after.unit_id", ",").alias("after"))


# ---- scoring

GOLD = "SELECT 'g' || CAST(event_id % 41 AS STRING) AS case_id, 'i' || CAST(event_id % 113 AS STRING) AS item FROM {events} WHERE event_id % 3 = 0"
PRED = "SELECT 'g' || CAST(event_id % 43 AS STRING) AS case_id, 'i' || CAST(event_id % 113 AS STRING) AS item FROM {events} WHERE event_id % 43 <> 7 AND event_id % 2 = 0"


def _scores(by: str) -> str:
    key = f"{by}, " if by else ""
    return f"""{duck(g0=GOLD, p0=PRED)}, g AS (SELECT DISTINCT * FROM g0), p AS (SELECT DISTINCT * FROM p0 WHERE case_id IN (SELECT case_id FROM g)), f AS (SELECT coalesce(g.case_id, p.case_id) AS case_id, g.item AS gi, p.item AS pi FROM g FULL JOIN p ON g.case_id = p.case_id AND g.item = p.item),
c AS (SELECT {key}count(*) FILTER (WHERE gi = pi) AS tp, count(*) FILTER (WHERE gi IS NULL) AS fp, count(*) FILTER (WHERE pi IS NULL) AS fn FROM f {f"GROUP BY {by}" if by else ""}), r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp / (tp + fn) END AS q FROM c)
SELECT {key}tp, fp, fn, round(p, 6) AS precision, round(q, 6) AS recall, round(CASE WHEN p + q = 0 THEN 0.0 ELSE 2 * p * q / (p + q) END, 6) AS f1 FROM r"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@register("gold_cases", _scores("case_id"))
def gold_cases(spark: SparkSession, d: str) -> DataFrame:
    """SEM-10, AGG-19, SET-06 by case."""
    return _rounded(R.scores(made(spark, d, GOLD), made(spark, d, PRED), ["case_id"]))


@register("gold_total", _scores(""))
def gold_total(spark: SparkSession, d: str) -> DataFrame:
    """SEM-10, AGG-19 over all cases."""
    return _rounded(R.scores(made(spark, d, GOLD), made(spark, d, PRED), []))


@register("gold_faults", f"""{duck(g=GOLD, p=PRED)} SELECT DISTINCT case_id, 'missing' AS fault FROM g WHERE case_id NOT IN (SELECT case_id FROM p) UNION ALL SELECT DISTINCT case_id, 'extra' FROM p WHERE case_id NOT IN (SELECT case_id FROM g)""")
def gold_faults(spark: SparkSession, d: str) -> DataFrame:
    """SET-06."""
    return R.case_faults(made(spark, d, GOLD), made(spark, d, PRED))


ERRORS = """SELECT user_id, CASE event_id % 16 WHEN 0 THEN 'MENTION_TO_RELATIONSHIP' WHEN 1 THEN 'CRITICISM_TO_ASSOCIATION' WHEN 2 THEN 'QUOTE_TO_BELIEF' WHEN 3 THEN 'hearsay_to_belief' WHEN 4 THEN 'ALLEGATION_TO_FACT' WHEN 5 THEN 'NEGATION_INVERSION' WHEN 6 THEN 'WRONG_CLAIMANT' WHEN 7 THEN 'WRONG_TARGET'
WHEN 8 THEN 'COREFERENCE_GUESSED' WHEN 9 THEN 'RECOMMENDATION_TO_AFFILIATE' WHEN 10 THEN 'PREDICTION_TO_OBSERVED_EVENT' WHEN 11 THEN 'HYPOTHETICAL_TO_ASSERTION' WHEN 12 THEN 'QUESTION_TO_ASSERTION' WHEN 13 THEN 'SHARED_TARGET_TO_COORDINATION' ELSE 'SOMETHING' END AS code FROM {events}"""


@register("gold_penalty", f"""{duck(e=ERRORS)}, p AS (SELECT count(*) AS errors, sum(CASE WHEN upper(code) IN ('ALLEGATION_TO_FACT', 'NEGATION_INVERSION', 'WRONG_CLAIMANT', 'SHARED_TARGET_TO_COORDINATION') THEN 15.0 WHEN upper(code) = 'QUESTION_TO_ASSERTION' THEN 10.0 WHEN upper(code) = 'SOMETHING' THEN 5.0 ELSE 12.0 END)::DOUBLE AS penalty FROM e)
SELECT *, greatest(0.0, 100 - penalty)::DOUBLE AS safety_score FROM p""")
def gold_penalty(spark: SparkSession, d: str) -> DataFrame:
    """SEM-10: the penalty table."""
    return R.safety(made(spark, d, ERRORS))


DUP = f"SELECT code AS predicate_code, {FAMILIES} AS family FROM (VALUES {values([*CODES, 'OWNS', 'PRAISES', 'OWNS'])}) AS p(i, code)"


@register("ontology_faults", f"""{duck(o=DUP)} SELECT 'duplicate:' || predicate_code AS fault FROM o GROUP BY predicate_code HAVING count(*) > 1 UNION ALL SELECT 'too_few_codes' FROM o HAVING count(DISTINCT predicate_code) < 400 UNION ALL SELECT 'families' FROM o HAVING count(DISTINCT family) <> 15""")
def ontology_faults(spark: SparkSession, d: str) -> DataFrame:
    """SEM-11, AGG-24."""
    return R.ontology_faults(made(spark, d, DUP))


SOURCES = "SELECT 'topic ' || CAST(user_id % 5 AS STRING) AS topic, event_id AS source_id, user_id AS lineage_id FROM {events}"


@register("readiness", f"""{duck(s=SOURCES)} SELECT topic, count(DISTINCT lineage_id) AS lineages, count(DISTINCT source_id) AS sources, count(DISTINCT lineage_id) >= 50 AS ready FROM s GROUP BY 1""")
def readiness(spark: SparkSession, d: str) -> DataFrame:
    """DCL-08."""
    return R.readiness(made(spark, d, SOURCES))


USES = "SELECT 'K' || CAST(event_id % 211 AS STRING) AS claim_id, CAST(event_id AS STRING) AS content_id, user_id % 9 AS lineage_id, event_id * 3 AS t FROM {events}"


@register("claim_propagation", f"""{duck(u=USES)} SELECT * FROM (SELECT claim_id, lag(content_id) OVER w AS from_content, content_id AS to_content, t - lag(t) OVER w AS lag, lag(lineage_id) OVER w = lineage_id AS same_lineage FROM u WINDOW w AS (PARTITION BY claim_id ORDER BY t, content_id)) WHERE from_content IS NOT NULL""")
def claim_propagation(spark: SparkSession, d: str) -> DataFrame:
    """DCL-01."""
    return R.propagation(made(spark, d, USES))


LIFT = "SELECT event_type AS term, count(*) AS n, 1000 AS total, sum(user_id % 3) AS base_n, 5000 AS base_total FROM {events} GROUP BY event_type"


@register("term_lift", f"""{duck(l=LIFT)} SELECT term, round((n / total) / ((base_n + 1) / (base_total + 1)), 6) AS lift FROM l""")
def term_lift(spark: SparkSession, d: str) -> DataFrame:
    """DCL-04."""
    return R.lift(made(spark, d, LIFT)).select("term", F.round("lift", 6).alias("lift"))


@register("table_counts", "SELECT 'events' AS name, count(*) AS rows FROM events UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'labels', count(*) FROM labels")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    """AGG-25."""
    return R.union_counts({n: made(spark, d, f"SELECT * FROM {{{n}}}") for n in ("events", "part", "labels")})


MESSAGES = """SELECT event_id AS id, 'try ' || CAST(event_id AS STRING) || ': ' || (CASE event_id % 13 WHEN 0 THEN 'ERROR: HTTP Error 403: Forbidden' WHEN 1 THEN 'needs a PO Token' WHEN 2 THEN 'Only images are available for download' WHEN 3 THEN 'Requested format is not available' WHEN 4 THEN 'Sign in to confirm your age' WHEN 5 THEN 'HTTP Error 429: Too Many Requests'
WHEN 6 THEN 'Unable to download video data' WHEN 7 THEN 'ffmpeg exited with code 1' WHEN 8 THEN 'a spot of bother' WHEN 9 THEN 'no formats, sign in to confirm' WHEN 10 THEN 'Error while decoding a fragment' WHEN 11 THEN NULL ELSE 'rate limit' END) AS message FROM {events}"""


@register("failure_classes", f"""{duck(m=MESSAGES)}, c AS (SELECT *, lower(coalesce(message, '')) AS t FROM m), k AS (SELECT *, CASE WHEN regexp_matches(t, 'http error 403|http 403|403 forbidden') THEN 'HTTP_403' WHEN regexp_matches(t, 'po token|proof of origin|\\bpot\\b') THEN 'PO_TOKEN' WHEN regexp_matches(t, 'only images') THEN 'ONLY_IMAGES'
WHEN regexp_matches(t, 'requested format is not available|no video formats found|no formats') THEN 'NO_FORMAT' WHEN regexp_matches(t, 'sign in to confirm|login required|age-restricted') THEN 'SIGN_IN' WHEN regexp_matches(t, '429|too many requests|rate limit') THEN 'RATE_LIMIT'
WHEN regexp_matches(t, 'fragment|unable to download video data|failed to download') THEN 'FRAGMENT_FAIL' WHEN regexp_matches(t, 'ffmpeg|invalid data found|error while decoding') THEN 'FFMPEG' ELSE 'OTHER' END AS class FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY id) AS rk FROM k) SELECT class, count(*) AS n, string_agg(right(message, 900), '|' ORDER BY id) FILTER (WHERE rk <= 5) AS examples FROM r GROUP BY 1""")
def failure_classes(spark: SparkSession, d: str) -> DataFrame:
    """STR-14, STR-16, AGG-22."""
    out = mentions.failures(made(spark, d, MESSAGES))
    return out.select("class", "n", F.array_join("examples", "|").alias("examples"))

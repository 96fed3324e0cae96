"""Semantic review: batching, validation, child tables, verification, fact checks, views, scoring (SEM-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import core

# Enum columns of an event and what stands where a review leaves them empty.
ENUMS = {
    "polarity": "NOT_APPLICABLE",
    "speaker_adoption": "ADOPTS",
    "attribution_mode": "OWN_CLAIM",
    "certainty": "ASSERTED",
    "explicitness": "EXPLICIT",
    "commerciality": "NONE",
    "relationship_evidence_state": "NONE",
    "fact_check_need": "NONE",
    "severity": "LOW",
}
# Statuses that end a fact check, and those of a text verification.
TERMINAL = ["VERIFIED", "SUPPORTED_INFERENCE", "DISPUTED", "UNVERIFIED", "CONTRADICTED", "OPINION_OR_NOT_CHECKABLE", "NOT_APPLICABLE"]
VERIFICATIONS = ["VERIFIED_TEXT", "NEEDS_REVIEW", "REJECTED_TEXT"]
# Which claims can be checked, and which events say that they need it.
CHECKABLE = ["CHECKABLE", "PARTLY_CHECKABLE"]
NEEDS_CHECK = ["CHECKABLE", "PARTLY_CHECKABLE", "HIGH_PRIORITY"]
# Predicates that are verdicts, not what was said.
VERDICTS = [
    "TRUE_STATEMENT", "FALSE_STATEMENT", "ACCURATE_STATEMENT", "INACCURATE_STATEMENT", "DEFAMATORY_STATEMENT", "SLANDEROUS_STATEMENT", "LIBELOUS_STATEMENT",
]
# Fields that every event must fill.
REQUIRED = ["predicate_code", "raw_predicate", "speaker_adoption", "attribution_mode", "certainty", "explicitness", "polarity"]
# Predicates that promote.
PROMO = [
    "RECOMMENDS", "RECOMMENDS_AS_SOURCE", "RECOMMENDS_SHOW", "RECOMMENDS_CHANNEL", "RECOMMENDS_NEWSLETTER", "PROMOTES_PRODUCT", "RECOMMENDS_PRODUCT", "ADVERTISES",
    "AFFILIATE_PROMOTES", "CALLS_TO_BUY", "CALLS_TO_SUBSCRIBE", "CALLS_TO_DONATE", "CALLS_TO_INVEST", "CROSS_PROMOTES", "LINKS_AUDIENCE_TO",
]
# Rhetorical predicates.
RHETORIC = [
    "FEAR_APPEAL", "URGENCY_APPEAL", "SCARCITY_APPEAL", "EXCLUSIVITY_APPEAL", "AUTHORITY_APPEAL", "INSIDER_APPEAL", "MORAL_APPEAL", "PATRIOTIC_APPEAL", "RELIGIOUS_APPEAL",
    "ANGER_APPEAL", "DISGUST_APPEAL", "HOPE_APPEAL", "GREED_APPEAL", "SOCIAL_PROOF_APPEAL", "US_VS_THEM_FRAMING", "ENEMY_FRAMING", "VICTIM_FRAMING", "HERO_FRAMING",
    "SCAPEGOAT_FRAMING", "INEVITABILITY_FRAMING", "CATASTROPHE_FRAMING", "CONSPIRACY_FRAMING", "SECRECY_FRAMING", "ISSUES_URGENCY", "ISSUES_CALL_TO_PREPARE",
]
# Predicates that touch a reputation, beside those that begin with ACCUSES_.
REPUTATIONAL = ["CALLS_DISHONEST", "CALLS_FRAUDULENT", "CALLS_SCAM", "CALLS_LIE", "CALLS_CORRUPT", "CALLS_COMPROMISED", "QUESTIONS_CREDIBILITY", "QUESTIONS_MOTIVES"]
POLARITIES = ["positive", "negative", "neutral", "mixed"]


def _in(c: Column | str, values: list[str]) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).isin(values), F.lit(False))


def _count(c: Column, name: str) -> Column:
    return F.count_if(F.coalesce(c, F.lit(False))).alias(name)


def _up(c: str) -> Column:
    return F.upper(F.coalesce(F.col(c), F.lit("")))


# ---- batches


def review_batches(units: DataFrame, size: int = 40, prefix: str = "SR_", key: str = "unit_id") -> DataFrame:
    """SEM-01, SEM-07, WIN-01, WIN-12, STR-13: pending rows (key, content_id, start, text) with two neighbours on each
    side, in batches of a content with ids; prefix SV_ for event verification."""
    ctx = core.neighbours(units, ["content_id"], ["start", key], F.struct(key, "text"))
    b = core.batches(ctx, ["content_id"], ["start", key], size)
    ids = b.groupBy("content_id", "batch_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", key))), lambda x: x[key]), "|").alias("ids"))
    return b.join(ids.select("content_id", "batch_no", X.stable_id(prefix, F.col("ids"), n=20).alias("batch_id")), ["content_id", "batch_no"])


def batch_records(batches: DataFrame) -> DataFrame:
    """JSN-03: one nested JSON record per row of review_batches: the unit with its context, as reviewers get it."""
    ctx = lambda c: F.transform(c, lambda x: F.struct(x["unit_id"].alias("unit_id"), x["text"].alias("text")))
    unit = F.struct("unit_id", "content_id", "start", "text")
    record = F.struct("batch_id", unit.alias("unit"), ctx("before").alias("context_before"), ctx("after").alias("context_after"))
    return batches.select("batch_id", "ordinal", "unit_id", F.to_json(record).alias("record"))


def deferred_split(units: DataFrame, indexed: DataFrame, attributed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT-08: current units to review now, and captions that wait for attribution. indexed, attributed: unit_id."""
    open_ = units.where("source_status = 'CURRENT' and coalesce(semantic_status, '') <> 'COMPLETE'").join(indexed.select("unit_id").distinct(), "unit_id", "left_anti")
    known = attributed.select("unit_id").distinct().withColumn("__a", F.lit(True))
    both = open_.join(known, "unit_id", "left").withColumn("__now", (F.col("source_type") != "youtube_caption") | F.col("__a").isNotNull())
    return both.where("__now").drop("__a", "__now"), both.where("not __now").drop("__a", "__now")


def superseded_index(index: DataFrame, units: DataFrame) -> DataFrame:
    """SEM-01: open entries of the batch index (unit_id, status) whose units are no longer current."""
    cur = units.where("source_status = 'CURRENT'").select("unit_id", F.lit(True).alias("__c"))
    gone = F.col("__c").isNull() & F.coalesce("status", F.lit("")).isin("PENDING", "QUEUED", "")
    return index.join(cur, "unit_id", "left").withColumn("status", F.when(gone, "SUPERSEDED").otherwise(F.col("status"))).drop("__c")


def pending_verification(e: DataFrame, units: DataFrame, verifications: DataFrame, index: DataFrame) -> DataFrame:
    """FLT-09: events of current units without a final verification and in no open batch."""
    done = verifications.where(_in("status", ["VERIFIED_TEXT", "REJECTED_TEXT"])).select("semantic_event_id")
    queued = index.where(_in("status", ["PENDING", "QUEUED"])).select("semantic_event_id")
    cur = units.where("source_status = 'CURRENT'").select("unit_id").distinct()
    return e.join(cur, "unit_id", "left_semi").join(done.unionByName(queued).distinct(), "semantic_event_id", "left_anti")


# ---- validation


def violations(docs: DataFrame, ontology: DataFrame) -> DataFrame:
    """SEM-02: unit_id, level (error or warning), rule, code: for review documents (unit_id, semantic_events, mentions,
    atomic_claims) and an ontology (predicate_code, family, relationship_graph_eligible). An event with an unknown
    predicate has that error alone."""
    e = docs.select("unit_id", F.explode("semantic_events").alias("e"), F.size(F.coalesce("atomic_claims", F.array())).alias("claims"))
    o = ontology.select(F.col("predicate_code").alias("code"), F.upper("family").alias("ofam"), F.col("relationship_graph_eligible").alias("eligible"))
    e = e.withColumn("code", _up("e.predicate_code")).join(F.broadcast(o), "code", "left")  # the ontology is a list of some hundred codes
    error = lambda c, name: F.when(c, F.struct(F.lit("error").alias("level"), F.lit(name).alias("rule")))
    warning = lambda c, name: F.when(c, F.struct(F.lit("warning").alias("level"), F.lit(name).alias("rule")))
    adoption, fam = _up("e.speaker_adoption"), _up("e.predicate_family")
    known = F.array(
        *[error(F.coalesce(F.col(f"e.{f}"), F.lit("")) == "", f"missing_required:{f}") for f in REQUIRED],
        error((fam != "") & (fam != F.col("ofam")), "family_mismatch"),
        error(F.col("code").isin(VERDICTS), "verdict_predicate"),
        error((F.col("code").startswith("ACCUSES_") | F.col("code").startswith("CALLS_")) & (adoption == ""), "missing_adoption"),
        error((adoption == "NEUTRAL_REPORT") & (_up("e.attribution_mode") == "OWN_CLAIM"), "neutral_own_claim"),
        error((_up("e.relationship_evidence_state") == "DOCUMENTED") & (F.col("eligible") == "NO"), "discourse_documented"),
        warning(_up("e.fact_check_need").isin(NEEDS_CHECK) & (F.col("claims") == 0), "check_without_claims"),
        warning(F.coalesce(X.truthy(F.col("e.negated")), F.lit(False)) & (adoption == "ADOPTS"), "negated_adopts"),
    )
    rules = F.when(F.col("ofam").isNull(), F.array(error(F.lit(True), "unknown_predicate"))).otherwise(known)
    m = docs.select("unit_id", F.explode("mentions").alias("m"))
    mention = F.array(
        error(X.first_of("m.surface", "m.text").isNull(), "mention_without_surface"),
        warning(F.coalesce(X.truthy(F.col("m.transcript_fragmented")), F.lit(False)) & X.nz("m.correction_candidate").isNull(), "fragmented_without_correction"))
    both = e.select("unit_id", "code", rules.alias("r")).unionByName(m.select("unit_id", F.lit("").alias("code"), mention.alias("r")))
    return both.select("unit_id", "code", F.inline(F.array_compact("r"))).select("unit_id", "level", "rule", "code")


# ---- child tables


def py_json(record: Column, fields: list[str]) -> Column:
    """A flat record as JSON with sorted keys, a space after colons and commas, fields that are NULL left out."""
    value = lambda f: F.regexp_extract(F.to_json(F.array(record[f])), r"^\[(.*)\]$", 1)
    parts = [F.when(record[f].isNotNull(), F.concat(F.lit(f'"{f}": '), value(f))) for f in sorted(fields)]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ", "), F.lit("}"))


def _sid(prefix: str, *parts: Column) -> Column:
    return X.stable_id(prefix, *parts, lower=True)


def _text(*cols: str) -> Column:
    return X.squeeze(X.first_of(*cols, default=""))


def _fields(docs: DataFrame, collection: str) -> list[str]:
    return docs.schema[collection].dataType.elementType.names


def _rows(docs: DataFrame, units: DataFrame, collection: str) -> DataFrame:
    """x: the collection's records, each with its unit u."""
    u = units.select("unit_id", F.struct(*[c for c in units.columns if c != "unit_id"]).alias("u"))
    return docs.select("unit_id", "speaker_entity_id", F.explode(collection).alias("x")).join(u, "unit_id")


def claim_refs(docs: DataFrame) -> Column:
    """JSN-04: map of a document's local claim names to claim ids. Claims without a name are C1, C2, ... by their place."""
    named = F.transform(F.coalesce("atomic_claims", F.array()), lambda c, i: F.struct(
        X.first_of(c["local_claim_id"], default=None).alias("own"), F.concat(F.lit("C"), (i + 1).cast("string")).alias("nth"), X.squeeze(F.coalesce(c["claim_text"], F.lit(""))).alias("t"), X.nz(c["claim_id"]).alias("id")))
    pairs = F.transform(F.filter(named, lambda c: c["t"] != ""), lambda c: F.struct(F.coalesce(c["own"], c["nth"]), F.coalesce(c["id"], _sid("CL_", F.col("unit_id"), c["t"]))))
    # of equal names the last counts
    return F.map_from_entries(F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["col1"] == p["col1"])))


def mentions_table(docs: DataFrame, units: DataFrame) -> DataFrame:
    """SEM-03."""
    r = _rows(docs, units, "mentions").withColumn("surface", _text("x.surface", "x.text")).where("surface <> ''")
    return r.select(
        F.coalesce(X.nz("x.mention_id"), _sid("MN_", F.col("unit_id"), F.col("surface"), F.col("x.entity_type"))).alias("mention_id"), "unit_id", "u.content_id", "surface",
        X.squeeze(X.first_of("x.normalized_surface", "surface")).alias("normalized_surface"), F.coalesce("x.entity_type", F.lit("")).alias("entity_type"), F.coalesce("x.canonical_entity_id", F.lit("")).alias("canonical_entity_id"),
        F.upper(F.coalesce(X.nz("x.resolution_status"), F.when(X.nz("x.canonical_entity_id").isNotNull(), "RESOLVED").otherwise("UNRESOLVED"))).alias("resolution_status"),
        X.upper_enum("x.reference_mode", "EXPLICIT").alias("reference_mode"), _text("x.correction_candidate").alias("correction_candidate"))


def events_table(docs: DataFrame, units: DataFrame, ontology: DataFrame) -> DataFrame:
    """SEM-03, SEM-04, PRJ-02, JSN-04: events with defaults, the ontology's family and claim references as stable ids."""
    r = _rows(docs.withColumn("speaker_entity_id", F.struct(F.col("speaker_entity_id").alias("own"), claim_refs(docs).alias("refs"))), units, "semantic_events")
    r = r.withColumns({"predicate_code": _up("x.predicate_code"), "reporting_entity_id": X.first_of("speaker_entity_id.own", "u.resolved_entity_id", default="")}).where("predicate_code <> ''")
    r = r.join(F.broadcast(ontology.select("predicate_code", F.upper("family").alias("predicate_family"))), "predicate_code")  # some hundred codes
    r = r.withColumns({
        "raw_predicate": _text("x.raw_predicate"), "source_entity_id": X.first_of("x.source_entity_id", "reporting_entity_id", default=""), "target_entity_id": F.coalesce("x.target_entity_id", F.lit("")),
        "target_surface": _text("x.target_surface"), "target_claim_id": F.coalesce("x.target_claim_id", F.lit("")), "topic": _text("x.topic")})
    refs = F.coalesce("x.related_claim_refs", F.expr("cast(array() as array<string>)"))
    parts = [F.col(c) for c in ("unit_id", "predicate_code", "source_entity_id", "target_entity_id", "target_surface", "target_claim_id")]
    uid = _sid("SE_", *parts, F.coalesce("x.object_entity_id", F.lit("")), _text("x.object_surface"), F.col("raw_predicate"), F.col("x.topic"))
    return r.select(
        F.coalesce(X.nz("x.semantic_event_id"), uid).alias("semantic_event_id"), "unit_id", "u.content_id", "u.speaker_id", "reporting_entity_id", "source_entity_id", _text("x.source_surface").alias("source_surface"),
        F.upper(F.coalesce(X.nz("x.actor_resolution_status"), F.when(F.col("source_entity_id") != "", "RESOLVED").otherwise("UNRESOLVED"))).alias("actor_resolution_status"),
        "predicate_code", "predicate_family", "raw_predicate", "target_entity_id", "target_surface", "target_claim_id", F.to_json(X.resolve_refs(refs, F.col("speaker_entity_id.refs"))).alias("related_claim_ids_json"), "topic",
        *[X.upper_enum(f"x.{c}", d).alias(c) for c, d in ENUMS.items()], *[F.coalesce(X.truthy(F.col(f"x.{c}")), F.lit(False)).alias(c) for c in ("negated", "conditional", "hypothetical")])


def claims_table(docs: DataFrame, units: DataFrame, checks: DataFrame) -> DataFrame:
    """SEM-03, SEM-05, JON-03: claims with the status of their fact check. checks: claim_id, status."""
    r = _rows(docs, units, "atomic_claims").withColumn("claim_text", _text("x.claim_text")).where("claim_text <> ''")
    r = r.withColumns({"claim_id": F.coalesce(X.nz("x.claim_id"), _sid("CL_", F.col("unit_id"), F.col("claim_text"))), "checkability": X.upper_enum("x.checkability", "CHECKABLE")})
    r = r.join(checks.select("claim_id", X.nz("status").alias("__s")), "claim_id", "left")
    status = F.coalesce("__s", F.when(F.col("checkability").isin(CHECKABLE), "PENDING").otherwise("NOT_APPLICABLE"))
    return r.select("claim_id", "unit_id", "u.content_id", "u.speaker_id", "claim_text", F.coalesce("x.claim_type", F.lit("other")).alias("claim_type"), "checkability", X.upper_enum("x.severity", "LOW").alias("severity"), F.coalesce("x.claimant_entity_id", F.lit("")).alias("claimant_entity_id"), status.alias("fact_check_status"))


def relationships_table(docs: DataFrame, units: DataFrame) -> DataFrame:
    """SEM-03."""
    r = _rows(docs, units, "relationships").withColumn("description", _text("x.description"))
    uid = _sid("RL_", F.col("unit_id"), F.col("description"), py_json(F.col("x"), _fields(docs, "relationships")))
    return r.select(F.coalesce(X.nz("x.relationship_claim_id"), uid).alias("relationship_claim_id"), "unit_id", "u.content_id", *[F.coalesce(f"x.{c}", F.lit("")).alias(c) for c in ("subject_entity_id", "object_entity_id", "relationship_type")], "description")


def stances_table(docs: DataFrame, units: DataFrame) -> DataFrame:
    """SEM-03."""
    r = _rows(docs, units, "stances").withColumns({"stance_type": _up("x.stance_type"), "target_entity_id": F.coalesce("x.target_entity_id", F.lit("")), "target_claim_id": F.coalesce("x.target_claim_id", F.lit("")), "topic": _text("x.topic"), "excerpt": _text("x.excerpt")})
    r = r.where("stance_type <> '' and (target_entity_id <> '' or target_claim_id <> '')")
    uid = _sid("ST_", *[F.col(c) for c in ("unit_id", "target_entity_id", "target_claim_id", "stance_type", "topic", "excerpt")])
    return r.select(F.coalesce(X.nz("x.stance_event_id"), uid).alias("stance_event_id"), "unit_id", "u.content_id", X.first_of("x.source_entity_id", "speaker_entity_id", default="").alias("source_entity_id"), "target_entity_id", "target_claim_id", "stance_type", "topic", X.upper_enum("x.speaker_adoption", "ADOPTS").alias("speaker_adoption"))


def clues_table(docs: DataFrame, units: DataFrame) -> DataFrame:
    """SEM-03."""
    r = _rows(docs, units, "speaker_identity_clues").withColumns({
        "cluster": X.first_of("x.target_acoustic_cluster_id", "u.acoustic_cluster_id", default=""), "raw": X.first_of("x.target_raw_speaker_id", "u.speaker_id", default=""), "claimed_entity_id": F.coalesce("x.claimed_entity_id", F.lit("")),
        "claimed_name": _text("x.claimed_name"), "evidence_type": _up("x.evidence_type"), "evidence_text": _text("x.evidence_text")})
    r = r.where("(cluster <> '' or raw <> '') and (claimed_entity_id <> '' or claimed_name <> '')")
    uid = _sid("IC_", *[F.col(c) for c in ("unit_id", "cluster", "raw", "claimed_entity_id", "claimed_name", "evidence_type", "evidence_text")])
    return r.select(F.coalesce(X.nz("x.identity_clue_id"), uid).alias("identity_clue_id"), "unit_id", "u.content_id", F.col("cluster").alias("target_acoustic_cluster_id"), F.col("raw").alias("target_raw_speaker_id"), "claimed_entity_id", "claimed_name", "evidence_type")


def products_table(docs: DataFrame, units: DataFrame) -> DataFrame:
    """SEM-03."""
    r = _rows(docs, units, "products").withColumn("name", _text("x.name"))
    uid = _sid("PM_", F.col("unit_id"), F.col("name"), py_json(F.col("x"), _fields(docs, "products")))
    return r.select(F.coalesce(X.nz("x.product_mention_id"), uid).alias("product_mention_id"), "unit_id", "u.content_id", "name", F.coalesce("x.role", F.lit("")).alias("role"))


def predictions_table(docs: DataFrame, units: DataFrame) -> DataFrame:
    """SEM-03."""
    r = _rows(docs, units, "predictions").withColumn("prediction_text", _text("x.prediction_text"))
    return r.select(F.coalesce(X.nz("x.prediction_id"), _sid("PD_", F.col("unit_id"), F.col("prediction_text"))).alias("prediction_id"), "unit_id", "u.content_id", "prediction_text", F.coalesce("x.status", F.lit("PENDING")).alias("status"))


def money_table(docs: DataFrame, units: DataFrame) -> DataFrame:
    """SEM-03."""
    r = _rows(docs, units, "money_or_conflict_signals").withColumn("description", _text("x.description"))
    uid = _sid("MC_", F.col("unit_id"), F.col("description"), py_json(F.col("x"), _fields(docs, "money_or_conflict_signals")))
    return r.select(F.coalesce(X.nz("x.signal_id"), uid).alias("signal_id"), "unit_id", "u.content_id", F.coalesce("x.signal_type", F.lit("")).alias("signal_type"), "description")


def citations_table(docs: DataFrame, units: DataFrame) -> DataFrame:
    """SEM-03."""
    r = _rows(docs, units, "citations_or_sources_mentioned").withColumn("citation_text", _text("x.name"))
    uid = _sid("CS_", F.col("unit_id"), F.col("citation_text"), py_json(F.col("x"), _fields(docs, "citations_or_sources_mentioned")))
    return r.select(F.coalesce(X.nz("x.citation_mention_id"), uid).alias("citation_mention_id"), "unit_id", "u.content_id", "citation_text", F.coalesce("x.url", F.lit("")).alias("url"))


# ---- fact checks and verification


def apply_checks(old: DataFrame, new: DataFrame, key: str = "claim_id", allowed: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """SEM-06, SEM-08, SNK-02: checks after an upsert of those with an allowed status, upper-cased, and the rejected ones.
    For event verifications pass key semantic_event_id and VERIFICATIONS."""
    new = new.withColumn("status", F.upper(F.coalesce("status", F.lit(""))))
    ok = F.col("status").isin(TERMINAL if allowed is None else allowed)
    return core.upsert(old, new.where(ok), [key]), new.where(~ok)


def checked_claims(claims: DataFrame, checks: DataFrame) -> DataFrame:
    """SEM-06, JON-03: claims with the newest status: their check's, else their own, else PENDING."""
    c = claims.join(checks.select("claim_id", X.nz("status").alias("__s")), "claim_id", "left")
    return c.withColumn("fact_check_status", F.coalesce("__s", X.nz("fact_check_status"), F.lit("PENDING"))).drop("__s")


def fact_queue(claims: DataFrame) -> DataFrame:
    """FLT-10: checkable claims without a terminal status."""
    return claims.where(_in("checkability", CHECKABLE) & ~_in("fact_check_status", TERMINAL))


def unit_completion(units: DataFrame, claims: DataFrame) -> DataFrame:
    """AGG-18: of reviewed units (semantic_status COMPLETE): COMPLETE when all checkable claims are terminal,
    NOT_APPLICABLE without any, else PENDING; other units keep their fact_status."""
    per = claims.where(_in("checkability", CHECKABLE)).groupBy("unit_id").agg(F.bool_and(_in("fact_check_status", TERMINAL)).alias("__all"))
    done = F.when(F.col("__all").isNull(), "NOT_APPLICABLE").when(F.col("__all"), "COMPLETE").otherwise("PENDING")
    return units.join(per, "unit_id", "left").withColumn("fact_status", F.when(F.col("semantic_status") == "COMPLETE", done).otherwise(F.col("fact_status"))).drop("__all")


def verified(e: DataFrame, verification: DataFrame, bypass: bool = False) -> DataFrame:
    """FLT-05, JON-01: events verified in the text; none if nothing is."""
    if bypass:
        return e
    return e.join(verification.where("status = 'VERIFIED_TEXT'").select("semantic_event_id").distinct(), "semantic_event_id", "left_semi")


def current(e: DataFrame, units: DataFrame) -> DataFrame:
    """FLT-04: events of current units, if any unit is current at all."""
    cur = units.where("coalesce(source_status, 'CURRENT') = 'CURRENT'").select("unit_id").distinct()
    some = cur.agg((F.count(F.lit(1)) > 0).alias("__some"))
    return e.join(cur.withColumn("__c", F.lit(True)), "unit_id", "left").join(F.broadcast(some)).where("__c or not __some").drop("__c", "__some")  # one row


# ---- views


def key_target() -> Column:
    """PRJ-01: what an event is aimed at: the entity, else its surface, else a claim; NULL for none."""
    return X.first_of("target_entity_id", "target_surface", "target_claim_id")


def is_reputational(code: Column) -> Column:
    """FLT-13."""
    return F.coalesce(code.startswith("ACCUSES_") | code.isin(REPUTATIONAL), F.lit(False))


def _counter(df: DataFrame, by: list[str], c: str, name: str) -> DataFrame:
    """JSN-02: values with their counts as JSON, sorted."""
    return core.map_counter(df.withColumn(c, F.coalesce(c, F.lit(""))), by, c, name).withColumn(name, F.to_json(name))


def interactions(e: DataFrame) -> DataFrame:
    """AGG-04, SRT-02: source against target with 13 measures. e: events after FLT-04 and FLT-05."""
    x = e.select("*", X.first_of("source_entity_id", "source_surface", "speaker_id", default="UNKNOWN").alias("source"), key_target().alias("target")).where("target is not null")
    by, pol, code = ["source", "target"], F.lower(F.coalesce("polarity", F.lit(""))), F.coalesce("predicate_code", F.lit(""))
    g = x.groupBy(*by).agg(
        F.count(F.lit(1)).alias("event_count"), F.countDistinct(X.nz("content_id")).alias("independent_content_count"), F.countDistinct(X.nz("unit_id")).alias("unit_count"),
        *[_count(pol == p, f"{p}_count") for p in POLARITIES], _count(code.startswith("ACCUSES_"), "allegation_count"), _count(code.isin(PROMO), "promotion_count"),
        _count(code.isin(RHETORIC), "rhetorical_event_count"), _count(_in("fact_check_need", NEEDS_CHECK), "checkable_event_count"))
    g = g.join(_counter(x, by, "predicate_code", "predicate_counts_json"), by).join(_counter(x.where(X.nz("topic").isNotNull()), by, "topic", "topic_counts_json"), by, "left")
    return g.withColumns({"topic_counts_json": F.coalesce("topic_counts_json", F.lit("{}")), "mixed_stance": (F.col("positive_count") > 0) & (F.col("negative_count") > 0)})


def exposure(e: DataFrame) -> DataFrame:
    """AGG-05: reporter against target."""
    x = e.select("*", X.first_of("reporting_entity_id", "speaker_id", default="UNKNOWN").alias("reporting_entity"), key_target().alias("target")).where("target is not null")
    by = ["reporting_entity", "target"]
    g = x.groupBy(*by).agg(F.count(F.lit(1)).alias("event_count"), F.countDistinct(X.nz("content_id")).alias("independent_content_count"))
    return g.join(_counter(x, by, "predicate_code", "predicate_counts_json"), by).join(_counter(x, by, "speaker_adoption", "speaker_adoption_counts_json"), by)


def pressure(inter: DataFrame) -> DataFrame:
    """AGG-06: target sums over interactions."""
    some = lambda c, name: _count(F.col(c) > 0, name)
    return inter.groupBy("target").agg(
        F.sum("event_count").alias("event_count"), F.count(F.lit(1)).alias("distinct_sources"), F.sum("positive_count").alias("positive_event_count"), F.sum("negative_count").alias("negative_event_count"),
        some("positive_count", "distinct_positive_sources"), some("negative_count", "distinct_negative_sources"), F.sum("allegation_count").alias("allegation_count"), some("allegation_count", "distinct_allegation_sources"),
        F.sum("promotion_count").alias("promotion_count"), some("promotion_count", "distinct_promoter_sources"))


def shared_targets(inter: DataFrame) -> DataFrame:
    """JON-13: pairs of sources that both praise, both attack or both promote a target; source_a is the one that comes
    first by more events, more negative ones, then name. Sources meet through (target, what they share), so a source that
    only praises meets no attackers."""
    kinds = ["negative_count", "positive_count", "promotion_count"]
    own = inter.select("target", "source", "event_count", *kinds)
    has = own.withColumn("kind", F.explode(F.array_compact(F.array(*[F.when(F.col(k) > 0, k) for k in kinds]))))
    side = lambda s: has.select("target", "kind", *[F.col(c).alias(f"{c}_{s}") for c in ("source", "event_count", *kinds)])
    order = lambda s: F.struct((-F.col(f"event_count_{s}")).alias("e"), (-F.col(f"negative_count_{s}")).alias("n"), F.col(f"source_{s}").alias("s"))
    both = side("a").join(side("b"), ["target", "kind"]).where(order("a") < order("b")).drop("kind").distinct()
    share = lambda k: (F.col(f"{k}_a") > 0) & (F.col(f"{k}_b") > 0)
    return both.select("target", "source_a", "source_b", share("negative_count").alias("both_negative"), share("positive_count").alias("both_positive"), share("promotion_count").alias("both_promote"),
                       *[F.col(f"{k}_{s}").alias(f"{s}_{n}") for k, n in zip(kinds, ("negative", "positive", "promotions"), strict=True) for s in "ab"])


def rhetoric_commerce(e: DataFrame, products: DataFrame) -> DataFrame:
    """JON-15, AGG-08: contents that hold rhetorical events and products (content_id, name)."""
    r = e.where(_in("predicate_code", RHETORIC))
    g = r.groupBy("content_id").agg(F.count(F.lit(1)).alias("rhetorical_event_count")).join(_counter(r, ["content_id"], "predicate_code", "rhetorical_predicates_json"), "content_id")
    p = products.groupBy("content_id").agg(F.count(F.lit(1)).alias("product_mention_count"), F.to_json(F.array_sort(F.collect_set(X.nz("name")))).alias("products_json"))
    return g.join(p, "content_id")


def reputation(e: DataFrame, claims: DataFrame, checks: DataFrame) -> DataFrame:
    """JON-02, FLT-13, JSN-01: reputational events, one row per linked claim with its status; without links one row."""
    x = e.where(is_reputational(F.col("predicate_code")))
    x = x.select("semantic_event_id", X.first_of("source_entity_id", "speaker_id", default="").alias("source"), F.coalesce(key_target(), F.lit("")).alias("target"), "predicate_code", F.explode_outer(X.json_array(F.col("related_claim_ids_json"))).alias("claim_id"))
    c = checked_claims(claims, checks).select("claim_id", "claim_text", F.upper("fact_check_status").alias("fact_status"))
    status = F.when(F.col("claim_id").isNull(), "NO_LINKED_CLAIM").otherwise(F.coalesce("fact_status", F.lit("PENDING")))
    return x.join(c, "claim_id", "left").select("semantic_event_id", "source", "target", "predicate_code", F.coalesce("claim_id", F.lit("")).alias("claim_id"), F.coalesce("claim_text", F.lit("")).alias("claim_text"), status.alias("fact_status"))


def claim_status(claims: DataFrame, checks: DataFrame) -> DataFrame:
    """AGG-07: statuses of claims by who makes them."""
    c = checked_claims(claims, checks).select(X.first_of("claimant_entity_id", "speaker_id", default="UNKNOWN").alias("source"), F.upper("fact_check_status").alias("s"))
    return c.groupBy("source").agg(
        F.count(F.lit(1)).alias("claim_count"), _count(F.col("s").isin(TERMINAL), "completed_fact_checks"),
        *[_count(F.col("s") == s, s.lower()) for s in (*TERMINAL[:-1], "PENDING")])


def views(e: DataFrame, claims: DataFrame, checks: DataFrame, products: DataFrame, units: DataFrame, verifications: DataFrame, bypass: bool = False) -> dict[str, DataFrame]:
    """SEM-09: the seven views over verified events of current units."""
    used = verified(current(e, units), verifications, bypass)
    inter = interactions(used)
    return {
        "interactions": inter, "exposure": exposure(used), "pressure": pressure(inter), "shared_targets": shared_targets(inter), "rhetoric_commerce": rhetoric_commerce(used, products),
        "reputation": reputation(used, claims, checks), "claim_status": claim_status(claims, checks),
    }


# ---- scoring

# Penalty of a critical error; others 5.
PENALTY = {
    "MENTION_TO_RELATIONSHIP": 12.0,
    "CRITICISM_TO_ASSOCIATION": 12.0,
    "QUOTE_TO_BELIEF": 12.0,
    "HEARSAY_TO_BELIEF": 12.0,
    "ALLEGATION_TO_FACT": 15.0,
    "NEGATION_INVERSION": 15.0,
    "WRONG_CLAIMANT": 15.0,
    "WRONG_TARGET": 12.0,
    "COREFERENCE_GUESSED": 12.0,
    "RECOMMENDATION_TO_AFFILIATE": 12.0,
    "PREDICTION_TO_OBSERVED_EVENT": 12.0,
    "HYPOTHETICAL_TO_ASSERTION": 12.0,
    "QUESTION_TO_ASSERTION": 10.0,
    "SHARED_TARGET_TO_COORDINATION": 15.0,
}


def prf(found: DataFrame) -> DataFrame:
    """found with tp, fp, fn gets precision, recall and f1; nothing found and nothing wanted is 1."""
    rate = lambda a, b: F.when(F.col(a) + F.col(b) == 0, 1.0).otherwise(F.col(a) / (F.col(a) + F.col(b)))
    c = found.withColumns({"precision": rate("tp", "fp"), "recall": rate("tp", "fn")})
    return c.withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))))


def scores(gold: DataFrame, predicted: DataFrame, by: list[str]) -> DataFrame:
    """SEM-10, AGG-19, SET-06: distinct items (case_id, item) of gold and prediction compared, by `by` (["case_id"], or []
    for the whole). Predictions of cases that gold does not have are left out; see case_faults."""
    p = predicted.select("case_id", "item").distinct().join(gold.select("case_id").distinct(), "case_id", "left_semi")
    full = gold.select("case_id", "item").where("item is not null").distinct().withColumn("g", F.lit(1)).join(p.where("item is not null").withColumn("p", F.lit(1)), ["case_id", "item"], "full_outer")
    full = full.unionByName(gold.select("case_id").distinct().select("case_id", F.lit(None).cast("string").alias("item"), F.lit(None).cast("int").alias("g"), F.lit(None).cast("int").alias("p")))
    g, q = F.col("g").isNotNull(), F.col("p").isNotNull()
    return prf(full.groupBy(*by).agg(_count(g & q, "tp"), _count(~g & q, "fp"), _count(g & ~q, "fn")))


def case_faults(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """SET-06: cases missing from the prediction, and cases that only it has."""
    g, p = gold.select("case_id").distinct(), predicted.select("case_id").distinct()
    return g.join(p, "case_id", "left_anti").select("case_id", F.lit("missing").alias("fault")).unionByName(p.join(g, "case_id", "left_anti").select("case_id", F.lit("extra").alias("fault")))


def safety(errors: DataFrame) -> DataFrame:
    """SEM-10: one row: number of critical errors (code), their penalty, and 100 less the penalty, 0 at least."""
    loss = F.coalesce(F.sum(X.lookup(F.upper("code"), PENALTY, 5.0)), F.lit(0.0))
    return errors.agg(F.count(F.lit(1)).alias("errors"), loss.alias("penalty")).withColumn("safety_score", F.greatest(F.lit(0.0), 100 - F.col("penalty")))


def ontology_faults(ontology: DataFrame, least_codes: int = 400, families: int = 15) -> DataFrame:
    """SEM-11, AGG-24: what an ontology (predicate_code, family) fails."""
    dup = ontology.groupBy("predicate_code").count().where("count > 1").select(F.concat(F.lit("duplicate:"), "predicate_code").alias("fault"))
    n = ontology.agg(F.countDistinct("predicate_code").alias("codes"), F.countDistinct("family").alias("fams"))
    few = n.select(F.explode(F.array_compact(F.array(F.when(F.col("codes") < least_codes, "too_few_codes"), F.when(F.col("fams") != families, "families")))).alias("fault"))
    return dup.unionByName(few)


def readiness(sources: DataFrame, least: int = 50) -> DataFrame:
    """DCL-08: topics (topic, source_id, lineage_id) with enough sources of separate lineage."""
    return sources.groupBy("topic").agg(F.countDistinct("lineage_id").alias("lineages"), F.countDistinct("source_id").alias("sources")).withColumn("ready", F.col("lineages") >= least)


def propagation(uses: DataFrame) -> DataFrame:
    """DCL-01: claim uses (claim_id, content_id, lineage_id, t): each use with the one before it, the lag and whether both share a lineage."""
    w = Window.partitionBy("claim_id").orderBy("t", "content_id")
    return uses.select("claim_id", F.lag("content_id").over(w).alias("from_content"), F.col("content_id").alias("to_content"), (F.col("t") - F.lag("t").over(w)).alias("lag"), (F.lag("lineage_id").over(w) == F.col("lineage_id")).alias("same_lineage")).where("from_content is not null")


def lift(counts: DataFrame) -> DataFrame:
    """DCL-04: rate of a term in the corpus over its rate in a baseline: term, n, total, base_n, base_total."""
    return counts.withColumn("lift", (F.col("n") / F.col("total")) / F.greatest(F.lit(1e-12), (F.col("base_n") + 1) / (F.col("base_total") + 1)))


def union_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-25: name, rows."""
    return reduce(DataFrame.unionByName, [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n, t in tables.items()])

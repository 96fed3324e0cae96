"""Queries over vectors and graphs: matching, edges, centrality, communities, motifs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import graph as G
from ..operators import vectors as V
from .base import duck, made, table
from .registry import register

SIM = """
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT a.vec_id AS qid, b.vec_id AS bid, list_cosine_similarity(a.e, b.e) AS sim FROM v a JOIN v b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, bid) AS rank FROM s WHERE sim >= 0.2),
m AS (SELECT * FROM r WHERE rank <= 5)
"""


def matches(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return V.blocks_topk(v, v, 5, 0.2)


@register("cosine_topk", f"WITH {SIM} SELECT qid, bid, round(sim, 5) AS sim, rank FROM m")
def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """MTH-05, SRT-04, JON-21."""
    return matches(spark, d).select("qid", "bid", F.round("sim", 5).alias("sim"), "rank")


@register("match_pairs", f"WITH {SIM} SELECT least(qid, bid) AS left_id, greatest(qid, bid) AS right_id, round(max(sim), 5) AS sim FROM m GROUP BY 1, 2")
def match_pairs(spark: SparkSession, d: str) -> DataFrame:
    """VOI-02."""
    return V.canonical_pairs(matches(spark, d)).withColumn("sim", F.round("sim", 5))


@register("match_margins", f"""WITH {SIM}, x AS (SELECT qid, bid, sim, rank, lead(sim) OVER (PARTITION BY qid ORDER BY rank) AS nxt FROM m)
SELECT qid, bid, round(sim, 5) AS sim, round(sim - coalesce(nxt, 0), 5) AS margin FROM x WHERE rank = 1""")
def match_margins(spark: SparkSession, d: str) -> DataFrame:
    """WIN-10."""
    m = V.margins(matches(spark, d))
    return m.select("qid", "bid", F.round("sim", 5).alias("sim"), F.round("margin", 5).alias("margin"))


@register("incremental_match", f"""WITH {SIM}, q AS (SELECT DISTINCT least(qid, bid) AS left_id, greatest(qid, bid) AS right_id FROM m WHERE qid % 10 = 0) SELECT left_id, right_id FROM q WHERE (left_id + right_id) % 7 <> 0""")
def incremental_match(spark: SparkSession, d: str) -> DataFrame:
    """STM-09: a tenth is new; pairs known before do not come again."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.when(F.col("vec_id") % 10 != 0, F.lit(1)).alias("matched_at"))
    found = V.canonical_pairs(matches(spark, d))
    known = found.where("(left_id + right_id) % 7 = 0").select("left_id", "right_id")
    return V.incremental(spark, v, known, 5, 0.2).select("left_id", "right_id")


@register("label_centroid", """WITH x AS (SELECT label, unnest(embedding::DOUBLE[]) AS v, unnest(range(len(embedding))) AS i FROM embeddings) SELECT label, i AS dim, round(avg(v), 6) AS mean FROM x GROUP BY 1, 2""")
def label_centroid(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    return x.groupBy("label", F.col("i").cast("long").alias("dim")).agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("mean"))


#: The graph: customers and suppliers, an edge where a customer's orders hold a supplier's parts.
EDGES = """
raw AS (SELECT 'C' || o_custkey AS source_id, 'S' || l_suppkey AS target_id, o_orderpriority AS p, count(*) AS evidence FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3),
w AS (SELECT *, (CASE p WHEN '1-URGENT' THEN 10.0 WHEN '2-HIGH' THEN 5.0 WHEN '3-MEDIUM' THEN 3.0 ELSE 1.0 END) * 0.85 * (1 + least(1.5, ln(1 + evidence) / 3)) AS weight FROM raw),
edges AS (SELECT least(source_id, target_id) AS src, greatest(source_id, target_id) AS dst, sum(weight) AS weight, sum(evidence) AS evidence FROM w GROUP BY 1, 2),
nodes AS (SELECT 'C' || c_custkey AS node, n_regionkey AS community FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'S' || s_suppkey, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
ways AS (SELECT src AS node, dst AS other, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges)
"""


def raw_relations(spark: SparkSession, d: str) -> DataFrame:
    o, l = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    g = o.join(l, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", "l_suppkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("evidence_count"))
    p = F.col("o_orderpriority")
    kind = F.when(p == "1-URGENT", "OWNS").when(p == "2-HIGH", "SELLS").when(p == "3-MEDIUM", "RECURRING_MEDIA").otherwise("SINGLE_MEDIA")
    return g.select(
        F.concat(F.lit("C"), "o_custkey").alias("source_id"), F.concat(F.lit("S"), "l_suppkey").alias("target_id"), kind.alias("relationship_type"),
        F.lit("").alias("confidence"), "evidence_count", F.lit(0).alias("primary_source_count"), F.lit("ACTIVE").alias("status"))


def edges(spark: SparkSession, d: str, flags: dict[str, list[str]] | None = None) -> DataFrame:
    return G.build_edges(raw_relations(spark, d), types=False, flags=flags)


def kept_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges as a table, for queries that read them more than once."""
    return G.saved(edges(spark, d), "edges")


def regions(spark: SparkSession, d: str) -> DataFrame:
    n = F.broadcast(table(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").alias("community")))  # 25 rows
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("C"), "c_custkey").alias("node"), "community")
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("S"), "s_suppkey").alias("node"), "community")
    return c.unionByName(s)


@register("edge_build", f"WITH {EDGES} SELECT src, dst, round(weight, 5) AS weight, evidence::DOUBLE AS evidence FROM edges")
def edge_build(spark: SparkSession, d: str) -> DataFrame:
    """GRF-01, FLT-01, AGG-09, MTH-01."""
    return edges(spark, d).select("src", "dst", F.round("weight", 5).alias("weight"), "evidence")


@register("node_strength", f"WITH {EDGES} SELECT node, round(sum(round(weight * 1e9)::HUGEINT)::DOUBLE / 1e9, 4) AS strength, count(*) AS degree FROM ways GROUP BY node")
def node_strength(spark: SparkSession, d: str) -> DataFrame:
    """AGG-10."""
    return G.strengths(kept_edges(spark, d)).withColumn("strength", F.round("strength", 4))


#: Weights as whole billionths: sums in any order are equal.
SHARES = f"""{EDGES},
pc AS (SELECT w.node, n.community, sum(round(w.weight * 1e9)::HUGEINT)::HUGEINT AS w FROM ways w JOIN nodes n ON w.other = n.node GROUP BY 1, 2),
sh AS (SELECT node, community, w::DOUBLE / (sum(w) OVER (PARTITION BY node))::DOUBLE AS share, (sum(w) OVER (PARTITION BY node))::DOUBLE / 1e9 AS strength, (sum(w) OVER (PARTITION BY node))::HUGEINT AS parts FROM pc)"""


@register("participation", f"WITH {SHARES} SELECT node, round((1e12 - sum(round(share * share * 1e12)::HUGEINT)::DOUBLE) / 1e12, 6) AS participation, round(1 - max(share), 6) AS outlier FROM sh GROUP BY node")
def participation(spark: SparkSession, d: str) -> DataFrame:
    """GRF-04, MTH-02, AGG-11."""
    e = kept_edges(spark, d)
    shares = G.membership(e, regions(spark, d)).join(G.strengths(e).select("node"), "node", "left_semi")
    p = G.participation(shares)
    return p.select("node", F.round("participation", 6).alias("participation"), F.round("outlier", 6).alias("outlier"))


@register("bridge_score", f"WITH {SHARES}, p AS (SELECT node, (1e12 - sum(round(share * share * 1e12)::HUGEINT)::DOUBLE) / 1e12 AS p, max(strength) AS s FROM sh GROUP BY node) SELECT node, round(p * ln(1 + s), 5) AS bridge FROM p")
def bridge_score(spark: SparkSession, d: str) -> DataFrame:
    """MTH-03."""
    e = kept_edges(spark, d)
    st = G.strengths(e)
    p = G.participation(G.membership(e, regions(spark, d))).join(st, "node")
    return p.select("node", F.round(X.bridge_score(F.col("participation"), F.col("strength")), 5).alias("bridge"))


@register("modularity", f"""WITH {EDGES}, i AS (SELECT a.community, sum(CASE WHEN a.community = b.community THEN weight ELSE 0 END) AS l FROM edges JOIN nodes a ON src = a.node JOIN nodes b ON dst = b.node GROUP BY 1),
g AS (SELECT n.community, sum(weight) AS d FROM ways JOIN nodes n USING (node) GROUP BY 1), m AS (SELECT sum(d) / 2 AS m FROM g)
SELECT round(sum(coalesce(l, 0)) / max(m) - sum(d * d) / (4 * max(m) * max(m)), 6) AS q FROM g LEFT JOIN i USING (community), m""")
def modularity(spark: SparkSession, d: str) -> DataFrame:
    """GRF-08."""
    return G.modularity(kept_edges(spark, d), regions(spark, d)).select(F.round("q", 6).alias("q"))


def _rank_sql(rounds: int) -> str:
    steps = "".join(
        f", r{i + 1} AS MATERIALIZED (SELECT other AS node, 0.15 / (SELECT count(*) FROM r0) + 0.85 * sum(rank * share) AS rank FROM sh JOIN r{i} USING (node) GROUP BY 1)" for i in range(rounds))
    return f"WITH {EDGES}, o AS (SELECT node, sum(weight) AS out FROM ways GROUP BY 1), sh AS MATERIALIZED (SELECT node, other, weight / out AS share FROM ways JOIN o USING (node)), r0 AS MATERIALIZED (SELECT DISTINCT node, 1.0::DOUBLE / count(*) OVER () AS rank FROM o){steps} SELECT node, round(rank, 7) AS rank FROM r{rounds}"


@register("pagerank_20", _rank_sql(20))
def pagerank_20(spark: SparkSession, d: str) -> DataFrame:
    """GRF-06."""
    return G.pagerank(kept_edges(spark, d), 20).select("node", F.round("rank", 7).alias("rank"))


def nation_edges(spark: SparkSession, d: str) -> DataFrame:
    """A small graph: nations by the trade between their customers and suppliers."""
    e = edges(spark, d)
    c = table(spark, d, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("src"), F.col("c_nationkey").alias("a"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("dst"), F.col("s_nationkey").alias("b"))
    g = e.join(c, "src").join(s, "dst").where("a <> b").groupBy(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).agg(F.round(F.sum("weight"), 6).alias("weight"))
    return g.where("weight > 0")


@register("louvain")
def louvain(spark: SparkSession, d: str) -> DataFrame:
    """GRF-02."""
    return G.louvain(nation_edges(spark, d).withColumn("snapshot_id", F.lit("s1")), ["snapshot_id"])


@register("trade_communities", f"WITH {EDGES} SELECT node, 1::BIGINT AS times, TRUE AS named_by_least, TRUE AS above_regions FROM ways GROUP BY node")
def trade_communities(spark: SparkSession, d: str) -> DataFrame:
    """GRF-02 on the whole graph: each node, how often it has a community, whether the community's name is its least member,
    and whether the communities' modularity is above that of the regions."""
    e = kept_edges(spark, d)
    found = G.saved(G.moved_communities(e), "communities")
    least = found.groupBy("community").agg((F.min("node") == F.col("community")).alias("named_by_least"))
    both = found.join(regions(spark, d).select("node", F.col("community").cast("string").alias("region")), "node", "left")
    q = G.modularity(e, both, of=("community", "region")).first()
    above = (q.q0 or 0.0) > (q.q1 or 0.0)
    return found.join(least, "community").groupBy("node").agg(F.count(F.lit(1)).alias("times"), F.bool_and("named_by_least").alias("named_by_least")).withColumn("above_regions", F.lit(above))


@register("betweenness")
def betweenness(spark: SparkSession, d: str) -> DataFrame:
    """GRF-05."""
    return G.betweenness(nation_edges(spark, d)).withColumn("betweenness", F.round("betweenness", 9))


@register("label_communities")
def label_communities(spark: SparkSession, d: str) -> DataFrame:
    return G.communities(kept_edges(spark, d), 4)


MONTHS = """
mem AS (SELECT strftime(ts, '%Y-%m-%d') < '2024-01-15' AS first, event_type || (user_id % 3) AS community, user_id AS node, count(*) AS n FROM events GROUP BY 1, 2, 3),
tot AS (SELECT first, node, sum(n) AS t FROM mem GROUP BY 1, 2), sh AS (SELECT mem.first, community, node, n / t AS share FROM mem JOIN tot USING (first, node)),
o AS (SELECT * FROM sh WHERE first), n AS (SELECT * FROM sh WHERE NOT first),
b AS (SELECT o.community AS old_id, n.community AS new_id, sum(least(o.share, n.share)) AS low, count(*) FILTER (WHERE o.share >= 0.15 AND n.share >= 0.15) AS common FROM o JOIN n USING (node) GROUP BY 1, 2),
so AS (SELECT community AS old_id, sum(share) AS ma, count(*) FILTER (WHERE share >= 0.15) AS na FROM o GROUP BY 1), sn AS (SELECT community AS new_id, sum(share) AS mb, count(*) FILTER (WHERE share >= 0.15) AS nb FROM n GROUP BY 1),
j AS (SELECT old_id, new_id, low / (ma + mb - low) AS weighted, common / greatest(1, na + nb - common) AS plain FROM b JOIN so USING (old_id) JOIN sn USING (new_id)),
k AS (SELECT *, count(*) OVER (PARTITION BY old_id) AS no, count(*) OVER (PARTITION BY new_id) AS nn FROM j WHERE greatest(weighted, plain) >= 0.18)
"""


@register("lineage", f"""WITH {MONTHS} SELECT old_id, new_id, round(weighted, 6) AS weighted, round(plain, 6) AS plain, CASE WHEN no > 1 AND nn > 1 THEN 'REFORMED' WHEN no > 1 THEN 'SPLIT' WHEN nn > 1 THEN 'MERGE' ELSE 'CONTINUE' END AS kind FROM k
UNION ALL SELECT NULL, new_id, 0, 0, 'BIRTH' FROM sn WHERE new_id NOT IN (SELECT new_id FROM k) UNION ALL SELECT old_id, NULL, 0, 0, 'DEATH' FROM so WHERE old_id NOT IN (SELECT old_id FROM k)""")
def lineage(spark: SparkSession, d: str) -> DataFrame:
    """JON-16, SET-05, MTH-04. GRF-10: event kinds as communities of users, first half of the month against the second."""
    e = table(spark, d, "events").select((F.date_format("ts", "yyyy-MM-dd") < "2024-01-15").alias("first"), F.concat("event_type", (F.col("user_id") % 3).cast("string")).alias("community"), F.col("user_id").alias("node"))
    m = e.groupBy("first", "community", "node").agg(F.count(F.lit(1)).alias("n"))
    sh = m.select("first", "community", "node", (F.col("n") / F.sum("n").over(Window.partitionBy("first", "node"))).alias("share"))
    out = G.lineage(sh.where("first").drop("first"), sh.where("not first").drop("first"))
    return out.withColumns({"weighted": F.round("weighted", 6), "plain": F.round("plain", 6)})


SUPPLY = "t AS (SELECT l_suppkey AS s, l_partkey AS p, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS neg FROM lineitem GROUP BY 1, 2)"


@register("target_pressure", f"WITH {SUPPLY} SELECT p AS target, sum(n)::BIGINT AS events, count(*) AS sources, count(*) FILTER (WHERE neg > 0) AS negative_sources, sum(neg)::BIGINT AS negative FROM t GROUP BY 1")
def target_pressure(spark: SparkSession, d: str) -> DataFrame:
    """AGG-06."""
    t = supply(spark, d)
    return t.groupBy(F.col("p").alias("target")).agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("sources"), F.count_if(F.col("neg") > 0).alias("negative_sources"), F.sum("neg").alias("negative"))


def supply(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("neg"))


@register("reciprocity", """WITH e AS (SELECT DISTINCT c_nationkey AS a, s_nationkey AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey)
SELECT x.a, x.b FROM e x JOIN e y ON x.a = y.b AND x.b = y.a WHERE x.a < x.b""")
def reciprocity(spark: SparkSession, d: str) -> DataFrame:
    """DCL-05: nations that buy from each other."""
    e = trade(spark, d)
    return e.join(e.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"]).where("a < b").select("a", "b")


def trade(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    l = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("a"))
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("b"))
    return o.join(l, F.col("o_orderkey") == F.col("l_orderkey")).join(c, F.col("c_custkey") == F.col("o_custkey")).join(s, F.col("s_suppkey") == F.col("l_suppkey")).select("a", "b").distinct()


CYCLE = "e AS (SELECT DISTINCT c_nationkey AS a, s_nationkey AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey WHERE c_nationkey <> s_nationkey)"


@register("cycle_3hop", f"WITH {CYCLE} SELECT x.a AS n1, x.b AS n2, y.b AS n3 FROM e x JOIN e y ON x.b = y.a JOIN e z ON y.b = z.a AND z.b = x.a WHERE x.a < x.b AND x.a < y.b")
def cycle_3hop(spark: SparkSession, d: str) -> DataFrame:
    """DCL-10: directed cycles of three, each from its least node."""
    e = trade(spark, d).where("a <> b")
    x, y, z = (e.select(F.col("a").alias(p), F.col("b").alias(q)) for p, q in (("n1", "n2"), ("n2", "n3"), ("n3", "n1")))
    return x.join(y, "n2").join(z, ["n3", "n1"]).where("n1 < n2 and n1 < n3").select("n1", "n2", "n3")


@register("scope_rule", f"""WITH {EDGES}, s AS (SELECT node, count(*) AS ties, count(*) FILTER (WHERE weight >= 8) AS strong FROM ways GROUP BY node) SELECT node, ties >= 2 OR strong >= 1 AS in_scope FROM s""")
def scope_rule(spark: SparkSession, d: str) -> DataFrame:
    """DCL-09: two ties or one strong tie."""
    s = G.both_ways(kept_edges(spark, d)).groupBy("node").agg(F.count(F.lit(1)).alias("ties"), F.count_if(F.col("weight") >= 8).alias("strong"))
    return s.select("node", ((F.col("ties") >= 2) | (F.col("strong") >= 1)).alias("in_scope"))


@register("strongest_edges", f"""WITH {EDGES}, r AS (SELECT node, other, round(weight, 5) AS weight, row_number() OVER (PARTITION BY node ORDER BY round(weight, 5) DESC, other) AS rank FROM ways) SELECT * FROM r WHERE rank <= 3""")
def strongest_edges(spark: SparkSession, d: str) -> DataFrame:
    """DCL-13."""
    from ..operators.core import topk

    return topk(G.both_ways(kept_edges(spark, d)).withColumn("weight", F.round("weight", 5)), ["node"], [F.desc("weight"), F.asc("other")], 3)


STANCES = """SELECT CASE WHEN event_id % 19 = 0 THEN '' ELSE 'S' || CAST(event_id AS STRING) END AS stance_event_id, CASE WHEN event_id % 23 = 0 THEN ' ' ELSE ' N' || CAST(user_id % 30 AS STRING) END AS source_entity_id, CASE WHEN event_id % 29 = 0 THEN NULL ELSE 'T' || CAST(event_id % 8 AS STRING) END AS target_entity_id,
CASE event_id % 17 WHEN 0 THEN 'CRITICIZES' WHEN 1 THEN 'DISPUTES' WHEN 2 THEN 'accuses' WHEN 3 THEN 'WARNS_AGAINST' WHEN 4 THEN 'RIDICULES' WHEN 5 THEN 'DISTANCES_FROM' WHEN 6 THEN 'CONTRADICTS' WHEN 7 THEN 'OPPOSES' WHEN 8 THEN 'PRAISES' WHEN 9 THEN 'ENDORSES' WHEN 10 THEN 'SUPPORTS' WHEN 11 THEN 'DEFENDS' WHEN 12 THEN 'AGREES_WITH' WHEN 13 THEN 'promotes' WHEN 14 THEN 'RECOMMENDS' WHEN 15 THEN '' ELSE 'MENTIONS' END AS stance_type,
CASE event_id % 7 WHEN 0 THEN 'ADOPTS' WHEN 1 THEN 'supports' WHEN 2 THEN 'OWN_STATEMENT' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN 'REJECTS' ELSE 'NEUTRAL_REPORT' END AS speaker_adoption, CASE WHEN event_id % 31 = 0 THEN '' ELSE 'C' || CAST(event_id % 50 AS STRING) END AS content_id FROM {events}"""
CONNECTIONS = """SELECT 'N' || CAST(p_partkey % 30 AS STRING) AS source_id, CASE WHEN p_partkey % 13 = 0 THEN '' ELSE 'N' || CAST(p_partkey % 30 * 7 % 30 AS STRING) END AS target_id, CASE p_partkey % 6 WHEN 0 THEN 'rejected' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN '' WHEN 3 THEN 'OTHER' WHEN 4 THEN 'SUPERSEDED' END AS status, 'd' || CAST(p_partkey % 4 AS STRING) || ';;d' || CAST(p_partkey % 3 AS STRING) AS source_ids FROM {part}"""
NEG, POS = "('CRITICIZES', 'DISPUTES', 'ACCUSES', 'WARNS_AGAINST', 'RIDICULES', 'DISTANCES_FROM', 'CONTRADICTS', 'OPPOSES')", "('PRAISES', 'ENDORSES', 'SUPPORTS', 'DEFENDS', 'AGREES_WITH', 'PROMOTES', 'RECOMMENDS')"
OWN = """, own AS (SELECT trim(source_entity_id) AS source, trim(target_entity_id) AS target, upper(stance_type) AS stance, nullif(content_id, '') AS content_id, nullif(stance_event_id, '') AS stance_event_id FROM st WHERE trim(source_entity_id) <> '' AND trim(coalesce(target_entity_id, '')) <> '' AND stance_type <> '' AND upper(coalesce(speaker_adoption, '')) IN ('ADOPTS', 'SUPPORTS', 'OWN_STATEMENT', ''))"""


@register("own_stances", f"{duck(st=STANCES)}{OWN} SELECT * FROM own")
def own_stances(spark: SparkSession, d: str) -> DataFrame:
    """FLT-03."""
    return G.own_stances(made(spark, d, STANCES))


RELS = """, rel AS (SELECT least(source_id, target_id) AS a, greatest(source_id, target_id) AS b, count(*) AS relations, array_to_string(list_sort(list_distinct(list_filter(flatten(list(string_split(source_ids, ';'))), lambda s: s <> ''))), ',') AS ids FROM cn
WHERE upper(coalesce(status, '')) NOT IN ('REJECTED', 'CONTRADICTED', 'SUPERSEDED') AND source_id <> '' AND target_id <> '' AND source_id <> target_id GROUP BY 1, 2)"""


@register("relation_pairs", f"{duck(cn=CONNECTIONS)}{RELS} SELECT * FROM rel")
def relation_pairs(spark: SparkSession, d: str) -> DataFrame:
    """FLT-02, SET-07."""
    return G.relation_pairs(made(spark, d, CONNECTIONS)).select("a", "b", "relations", F.array_join("source_ids", ",").alias("ids"))


def _json(*parts: str) -> str:
    return "'[' || " + " || ',' || ".join(f"'\"' || {p} || '\"'" for p in parts) + " || ']'"


MOTIFS = f"""{duck(st=STANCES, cn=CONNECTIONS)}{OWN}{RELS}, side AS (SELECT source, target, bool_or(stance IN {NEG}) AS neg, bool_or(stance IN {POS}) AS pos, count(*) AS n, count(DISTINCT content_id) AS c, string_agg('"' || stance_event_id || '"', ',' ORDER BY stance_event_id) AS ev FROM own GROUP BY 1, 2),
tri AS (SELECT a, b, x.target, relations, ids, x.n AS na, y.n AS nb, x.c AS ca, y.c AS cb, concat_ws(',', x.ev, y.ev) AS ev, CASE WHEN x.neg AND y.neg THEN 'SHARED_ADVERSARY_CONNECTED' WHEN x.pos AND y.pos THEN 'SHARED_SUPPORT_CONNECTED' END AS kind FROM rel JOIN side x ON x.source = a JOIN side y ON y.source = b AND y.target = x.target)"""
WEDGES = f"""SELECT 'MF_' || upper(substr(sha256(kind || chr(31) || a || chr(31) || b || chr(31) || target), 1, 20)) AS motif_id, kind AS motif_type, {_json("a", "b", "target")} AS node_ids, '[' || ev || ']' AS edge_event_ids, CASE WHEN ids = '' THEN '[]' ELSE '["' || replace(ids, ',', '","') || '"]' END AS source_ids,
round(least(100.0, 12 * (1.5 * ln(1 + relations) + ln(1 + na) + ln(1 + nb) + 0.5 * ln(1 + ca + cb))), 2) AS signal_strength FROM tri WHERE kind IS NOT NULL"""
REVERSALS = f"""SELECT 'MF_' || upper(substr(sha256('STANCE_REVERSAL' || chr(31) || source || chr(31) || target), 1, 20)) AS motif_id, 'STANCE_REVERSAL' AS motif_type, {_json("source", "target")} AS node_ids, '[]' AS edge_event_ids, '[]' AS source_ids, 35.0 AS signal_strength
FROM own GROUP BY source, target HAVING count(*) FILTER (WHERE stance IN {NEG}) > 0 AND count(*) FILTER (WHERE stance IN {POS}) > 0"""


@register("wedge_motifs", f"{MOTIFS} {WEDGES}")
def wedge_motifs(spark: SparkSession, d: str) -> DataFrame:
    """GRF-12, JON-14, SET-03, SET-07, MTH-06."""
    return G.wedge_motifs(G.relation_pairs(made(spark, d, CONNECTIONS)), G.own_stances(made(spark, d, STANCES)))


@register("stance_reversals", f"{MOTIFS} {REVERSALS}")
def stance_reversals(spark: SparkSession, d: str) -> DataFrame:
    """GRF-13."""
    return G.reversals(G.own_stances(made(spark, d, STANCES)))


METRICS = "SELECT 's1' AS snapshot_id, 'N' || CAST(p_partkey AS STRING) AS node, (p_partkey % 10) / 10e0 AS participation, (p_partkey % 7) / 5e0 AS bridge, (p_partkey % 11) / 200e0 AS brokerage FROM {part}"
BRIDGES = f"""SELECT 'MF_' || upper(substr(sha256('CROSS_COMMUNITY_BRIDGE' || chr(31) || node || chr(31) || snapshot_id), 1, 20)) AS motif_id, 'CROSS_COMMUNITY_BRIDGE' AS motif_type, {_json("node")} AS node_ids, '[]' AS edge_event_ids, '[]' AS source_ids,
round(least(100, 25 + 45 * participation + 15 * least(1, bridge)), 2) AS signal_strength FROM mt WHERE participation >= 0.55 AND (bridge >= 0.75 OR brokerage >= 0.03)"""


@register("bridge_motifs", f"{duck(mt=METRICS)} {BRIDGES}")
def bridge_motifs(spark: SparkSession, d: str) -> DataFrame:
    """GRF-14."""
    return G.bridge_motifs(made(spark, d, METRICS))


@register("reviewed_motifs", f"""{MOTIFS}, m AS ({WEDGES} UNION ALL {REVERSALS}) SELECT DISTINCT motif_id, CASE WHEN motif_id < 'MF_4' THEN 'DISMISSED' ELSE 'OPEN' END AS status, CASE WHEN motif_id < 'MF_4' AND motif_id > 'MF_2' THEN 'seen' ELSE '' END AS review_notes FROM m""")
def reviewed_motifs(spark: SparkSession, d: str) -> DataFrame:
    """GRF-15: found twice, reviewed before in part."""
    m = wedge_motifs(spark, d).unionByName(stance_reversals(spark, d))
    prior = m.where("motif_id < 'MF_4'").select("motif_id", F.lit("DISMISSED").alias("status"), F.when(F.col("motif_id") > "MF_2", "seen").otherwise("").alias("notes"))
    return G.carry_review(m.unionByName(m), prior).select("motif_id", "status", "review_notes")


@register("stance_edges", f"""{duck(st=STANCES)}{OWN}, c AS (SELECT source, target, stance, count(*) AS n FROM own GROUP BY 1, 2, 3) SELECT source, target, count(*) AS stances, count(*) FILTER (WHERE stance IN {NEG}) AS negative, count(*) FILTER (WHERE stance IN {POS}) AS positive, count(DISTINCT content_id) AS contents,
(SELECT arg_min(c.stance, (-c.n, c.stance)) FROM c WHERE c.source = own.source AND c.target = own.target) AS dominant FROM own GROUP BY 1, 2""")
def stance_edges(spark: SparkSession, d: str) -> DataFrame:
    """DCL-02."""
    return G.stance_edges(G.own_stances(made(spark, d, STANCES)))


@register("layer_degrees", f"""WITH {EDGES}, ty AS (SELECT least(source_id, target_id) AS src, greatest(source_id, target_id) AS dst, bool_or(p = '1-URGENT') AS money, bool_or(p = '2-HIGH') AS commerce FROM raw GROUP BY 1, 2), l AS (SELECT e.src, e.dst, weight, unnest(list_filter(['all', CASE WHEN weight >= 8 THEN 'strong' END, CASE WHEN commerce THEN 'commerce' END, CASE WHEN money THEN 'money' END], lambda x: x IS NOT NULL)) AS layer FROM edges e JOIN ty USING (src, dst))
SELECT layer, node, count(*) AS degree, round(sum(weight), 4) AS strength FROM (SELECT layer, src AS node, weight FROM l UNION ALL SELECT layer, dst, weight FROM l) GROUP BY 1, 2""")
def layer_degrees(spark: SparkSession, d: str) -> DataFrame:
    """DCL-03: all edges, strong ties, commerce, money."""
    return G.layers(edges(spark, d, G.LAYER_TYPES)).withColumn("strength", F.round("strength", 4))


@register("membership_shares", f"WITH {SHARES}, own AS (SELECT node, community, 0.0 AS z FROM nodes WHERE node IN (SELECT node FROM ways)) SELECT node, community, round(coalesce(share, z), 6) AS share FROM sh FULL JOIN own USING (node, community)")
def membership_shares(spark: SparkSession, d: str) -> DataFrame:
    """GRF-03, AGG-11."""
    e = kept_edges(spark, d)
    return G.membership(e, regions(spark, d)).join(G.strengths(e).select("node"), "node", "left_semi").withColumn("share", F.round("share", 6))


#: Half to even, of whole numbers.
EVEN = "({0} // {1} + CASE WHEN 2 * ({0} % {1}) > {1} OR (2 * ({0} % {1}) = {1} AND ({0} // {1}) % 2 = 1) THEN 1 ELSE 0 END)::BIGINT"


@register("node_metrics", f"""WITH {SHARES}, ev AS (SELECT node, sum(evidence) AS ev, count(*) AS degree FROM (SELECT src AS node, evidence FROM edges UNION ALL SELECT dst, evidence FROM edges) GROUP BY 1),
p AS (SELECT node, 1000000000000::HUGEINT - sum(round(share * share * 1e12)::HUGEINT)::HUGEINT AS p, 1 - max(share) AS o, max(parts) AS w FROM sh GROUP BY 1)
SELECT 's1' AS snapshot_id, node, 'relationship' AS layer, degree, {EVEN.format("w", "1000")} AS weighted_degree, {EVEN.format("p", "1000000")} AS participation, round_even((p::DOUBLE / 1e12) * ln(1 + w::DOUBLE / 1e9) * 1e6, 0)::BIGINT AS bridge, round_even(o * 1e6, 0)::BIGINT AS outlier, ev::DOUBLE AS evidence_coverage FROM p JOIN ev USING (node)""")
def node_metrics(spark: SparkSession, d: str) -> DataFrame:
    """GRF-07, AGG-10, MTH-09: all digits, as whole millionths. Betweenness and PageRank have queries of their own."""
    e = kept_edges(spark, d)
    st = G.saved(G.strengths(e), "strengths")
    shares = G.membership(e, regions(spark, d)).join(st.select("node"), "node", "left_semi")
    none = st.select("node", F.lit(0.0).alias("betweenness"), F.lit(0.0).alias("rank"))
    m = G.node_metrics(e, shares, none, none, "s1")
    return m.withColumns({c: F.round(F.col(c) * 1e6).cast("long") for c in ("weighted_degree", "participation", "bridge", "outlier")}).drop("pagerank", "brokerage", "betweenness")


@register("snapshot_payload", f"""WITH n AS (SELECT n_nationkey AS node, n_regionkey AS community, CASE WHEN n_nationkey % 6 = 0 THEN n_nationkey::VARCHAR ELSE n_name END AS label FROM nation) SELECT 'nodes' AS part, '{{"node":' || node || ',"community":' || community || ',"label":"' || label || '"}}' AS item FROM n
UNION ALL SELECT 'edges', '{{"src":' || (n_nationkey - 1) || ',"dst":' || n_nationkey || '}}' FROM nation WHERE n_nationkey > 0 UNION ALL SELECT 'communities', '{{"community":' || n_regionkey || ',"size":' || count(*) || '}}' FROM nation GROUP BY n_regionkey""")
def snapshot_payload(spark: SparkSession, d: str) -> DataFrame:
    """GRF-11, SNK-04, JON-25: the parts of the payload read back from its JSON."""
    n = table(spark, d, "nation")
    nodes = G.named_nodes(n.select(F.col("n_nationkey").alias("node"), F.col("n_regionkey").alias("community")), n.select(F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 6 != 0, F.col("n_name")).alias("name")))
    edges = n.where("n_nationkey > 0").select((F.col("n_nationkey") - 1).alias("src"), F.col("n_nationkey").alias("dst"))
    sizes = n.groupBy(F.col("n_regionkey").alias("community")).agg(F.count(F.lit(1)).alias("size"))
    j = G.snapshot_json("s1", nodes, edges, sizes)
    kind = "nodes array<struct<node:long,community:long,label:string>>, edges array<struct<src:long,dst:long>>, communities array<struct<community:long,size:long>>"
    x = j.select(F.from_json("json", kind).alias("j"))
    item = lambda c: x.select(F.lit(c).alias("part"), F.explode(f"j.{c}").alias("i")).select("part", F.to_json("i").alias("item"))
    return item("nodes").unionByName(item("edges")).unionByName(item("communities"))


@register("ego_edges", f"""WITH {EDGES}, h0 AS (SELECT min(node) AS node FROM ways), h1 AS (SELECT other AS node FROM ways WHERE node IN (SELECT node FROM h0) UNION SELECT node FROM h0) SELECT src, dst FROM edges WHERE src IN (SELECT node FROM h1) AND dst IN (SELECT node FROM h1)""")
def ego_edges(spark: SparkSession, d: str) -> DataFrame:
    """DCL-13: one hop around the first node."""
    e = kept_edges(spark, d)
    return G.ego(e, G.both_ways(e).agg(F.min("node")).first()[0], 1).select("src", "dst")


@register("community_ids", f"""WITH {EDGES}, g AS (SELECT community, row_number() OVER (ORDER BY count(*) DESC, min(node)) AS k FROM nodes GROUP BY 1) SELECT node, 'C_s1_' || lpad(k::VARCHAR, 4, '0') AS community_id FROM nodes JOIN g USING (community)""")
def community_ids(spark: SparkSession, d: str) -> DataFrame:
    """SRT-03."""
    return G.community_ids(regions(spark, d), "s1")

"""Citation lineage and sliding bursts over whole events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sequences as S
from .base import duck, made, micros, table
from .registry import register

#: Every event cites another one: few cite none, some an id that no event has, some run in circles of any length.
CITES = """SELECT event_id AS id, CASE WHEN event_id % 64 = 7 THEN NULL WHEN event_id % 211 = 3 THEN CAST(-1 AS BIGINT) WHEN event_id % 10 < 9 THEN CAST(floor(event_id / 3) AS BIGINT) ELSE (event_id * event_id + 17) % (SELECT max(event_id) + 1 FROM {events}) END AS cites FROM {events}"""


@register("citation_lineage", duck(c=CITES).replace("WITH", "WITH RECURSIVE", 1) + """, f AS (SELECT id, CASE WHEN cites IN (SELECT id FROM c) THEN cites END AS p FROM c),
reach AS (SELECT id, p AS y FROM f WHERE p IS NOT NULL UNION SELECT r.id, f.p FROM reach r JOIN f ON f.id = r.y WHERE f.p IS NOT NULL),
walk AS (SELECT id, id AS y, 0::BIGINT AS hops FROM f WHERE p IS NULL UNION ALL SELECT f.id, w.y, w.hops + 1 FROM walk w JOIN f ON f.p = w.id),
ring AS (SELECT id FROM reach WHERE id = y)
SELECT f.id, w.y AS origin, w.hops, (SELECT min(r.y) FROM reach r WHERE r.id = f.id AND r.y IN (SELECT id FROM ring)) AS cycle, f.id IN (SELECT id FROM ring) AS in_cycle FROM f LEFT JOIN walk w ON w.id = f.id""")
def citation_lineage(spark: SparkSession, d: str) -> DataFrame:
    """DCL-10: origins of all chains, cycles of any length."""
    return S.citation_lineage(made(spark, d, CITES)).select("id", "origin", "hops", "cycle", "in_cycle")


HOUR = 3_600_000_000


@register("sliding_bursts", f"""WITH e AS (SELECT DISTINCT event_type AS key, user_id, epoch_us(ts) AS t FROM events),
s AS (SELECT *, lag(t) OVER w AS a, lead(t) OVER w AS z FROM e WINDOW w AS (PARTITION BY key, user_id ORDER BY t)),
p AS (SELECT key, t, sum(d) AS d FROM (SELECT key, t, 1 AS d FROM s WHERE a IS NULL OR t - a > {HOUR} UNION ALL SELECT key, t + {HOUR}, -1 FROM s WHERE z IS NULL OR z - t > {HOUR}) GROUP BY 1, 2),
l AS (SELECT *, sum(d) OVER (PARTITION BY key ORDER BY t) AS n FROM p), b AS (SELECT *, n >= 4 AS hot, coalesce(lag(n) OVER (PARTITION BY key ORDER BY t), 0) >= 4 AS was FROM l),
i AS (SELECT *, count(*) FILTER (WHERE hot AND NOT was) OVER (PARTITION BY key ORDER BY t) AS k FROM b WHERE hot OR was)
SELECT key, min(t) AS start, max(t) AS "end", max(n)::BIGINT AS peak FROM i GROUP BY key, k""")
def sliding_bursts(spark: SparkSession, d: str) -> DataFrame:
    """DCL-11: spans in which four users or more have events of one kind within an hour, wherever it begins."""
    e = table(spark, d, "events").select(F.col("event_type").alias("key"), F.col("user_id").alias("user"), micros().alias("t"))
    return S.bursts(e, HOUR, 4)


#: Eight contents; their segments are 90 seconds long.
CONTENTS = """SELECT user_id % 8 AS key, event_id AS id, event_type AS kind, {us} AS t, CAST(floor({us} / 90000000) AS BIGINT) AS segment, value FROM {events}"""
CONTENTS_DUCK = "WITH e AS (" + CONTENTS.replace("{us}", "epoch_us(ts)").replace("{events}", "events") + ")"
MINUTE = 60_000_000


def contents(spark: SparkSession, d: str) -> DataFrame:
    return made(spark, d, CONTENTS.replace("{us}", "unix_micros(CAST(ts AS TIMESTAMP))"))


@register("ordered_funnels", CONTENTS_DUCK + f""", s1 AS (SELECT key, id, t, t AS start FROM e WHERE kind = 'error'),
g1 AS (SELECT key, t, max(start) AS start FROM s1 GROUP BY 1, 2),
s2 AS (SELECT e.key, e.id, e.t, g.start FROM e ASOF JOIN g1 g ON e.key = g.key AND e.t > g.t WHERE kind = 'view' AND e.t - g.t <= {120 * MINUTE}),
g2 AS (SELECT key, t, max(start) AS start FROM s2 GROUP BY 1, 2),
s3 AS (SELECT e.key, e.id, e.t, g.start FROM e ASOF JOIN g2 g ON e.key = g.key AND e.t > g.t WHERE kind = 'click' AND e.t - g.t <= {120 * MINUTE}),
g3 AS (SELECT key, t, max(start) AS start FROM s3 GROUP BY 1, 2),
s4 AS (SELECT e.key, e.id, e.t, g.start FROM e ASOF JOIN g3 g ON e.key = g.key AND e.t > g.t WHERE kind = 'purchase' AND e.t - g.t <= {120 * MINUTE}),
u AS (SELECT 1 AS step, * FROM s1 UNION ALL SELECT 2, * FROM s2 UNION ALL SELECT 3, * FROM s3 UNION ALL SELECT 4, * FROM s4)
SELECT key, id, step::INTEGER AS step, (t - start) / {MINUTE}.0::DOUBLE AS minutes FROM u""")
def ordered_funnels(spark: SparkSession, d: str) -> DataFrame:
    """DCL-07: threat, view, click and purchase in order, two hours at most between steps, with minutes since the first."""
    f = S.funnels(contents(spark, d), ["error", "view", "click", "purchase"], 120 * MINUTE)
    return f.select("key", "id", "step", ((F.col("t") - F.col("start")) / float(MINUTE)).alias("minutes"))


@register("pitch_adjacency", CONTENTS_DUCK + f""", l AS (SELECT DISTINCT key, t, segment FROM e WHERE kind = 'error'), p AS (SELECT * FROM e WHERE kind = 'purchase'),
b AS (SELECT p.*, l.t AS a FROM p ASOF LEFT JOIN l ON p.key = l.key AND p.t >= l.t), c AS (SELECT b.*, l.t AS z FROM b ASOF LEFT JOIN l ON b.key = l.key AND b.t <= l.t),
n AS (SELECT *, least(t - a, z - t) AS apart, EXISTS (SELECT 1 FROM l WHERE l.key = c.key AND l.segment = c.segment) AS same_segment FROM c),
m AS (SELECT key, id, CASE WHEN apart <= {5 * MINUTE} THEN apart END AS apart, same_segment, coalesce(apart <= {MINUTE}, false) AS within_1, coalesce(apart <= {5 * MINUTE}, false) AS within_5, value FROM n)
SELECT key, id, apart, same_segment, within_1, within_5, ((CASE WHEN same_segment OR within_1 THEN 2 WHEN within_5 THEN 1 ELSE 0 END) + (CASE WHEN value >= 10 THEN 2 WHEN value >= 5 THEN 1 ELSE 0 END) + (CASE WHEN id % 4 > 2 THEN 2 ELSE id % 4 END))::INTEGER AS score FROM m""")
def pitch_adjacency(spark: SparkSession, d: str) -> DataFrame:
    """DCL-07: purchases beside errors of their content: in one segment, within a minute, within five, and the score."""
    e = contents(spark, d)
    a = S.adjacency(e, ["error"], ["purchase"], [MINUTE, 5 * MINUTE])
    a = a.select("key", "id", "apart", "same_segment", F.col(f"within_{MINUTE}").alias("within_1"), F.col(f"within_{5 * MINUTE}").alias("within_5"))
    near = S.near_points(F.col("same_segment"), F.col("within_1"), F.col("within_5"))
    price = F.when(F.col("value") >= 10, 2).when(F.col("value") >= 5, 1)
    none = F.lit(None)
    score = S.pitch_score(threat=none, urgency=none, adjacency=near, financial=F.col("id") % 4, weakness=none, price=price)
    return a.join(e.select("id", "value"), "id").select("key", "id", "apart", "same_segment", "within_1", "within_5", score.alias("score"))

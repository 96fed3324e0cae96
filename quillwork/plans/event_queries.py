"""Queries over events, orders and conversations: sessions, intervals, as-of joins, fusion, versions, queues, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import core
from .base import micros, table
from .registry import register

HALF_HOUR = 1_800_000_000
DAY6 = 21_600_000_000

SESS = f"""
g AS (SELECT *, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= {HALF_HOUR} THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
h AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g),
sess AS (SELECT user_id, sid::BIGINT AS sid, min(t) AS s, max(t) AS e, count(*) AS n, min(event_type) AS kind FROM h GROUP BY user_id, sid)
"""


def sessions(events: DataFrame) -> DataFrame:
    """WIN-03, WIN-04: a gap of more than half an hour begins a session."""
    e = events.withColumn("t", micros())
    gap = F.col("t") - F.lag("t").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    runs = core.islands(e.withColumn("__g", gap), ["user_id"], ["ts", "event_id"], F.col("__g").isNull() | (F.col("__g") > HALF_HOUR), "sid")
    return runs.groupBy("user_id", "sid").agg(F.min("t").alias("s"), F.max("t").alias("e"), F.count(F.lit(1)).alias("n"), F.min("event_type").alias("kind"))


@register("gap_sessions", f"WITH {SESS} SELECT * FROM sess")
def gap_sessions(spark: SparkSession, d: str) -> DataFrame:
    """WIN-03, WIN-04."""
    return sessions(table(spark, d, "events"))


@register("interval_overlap", f"""WITH {SESS}, x AS (SELECT user_id, sid, kind, s, e, unnest(range(s // {DAY6}, e // {DAY6} + 1)) AS win FROM sess),
o AS (SELECT user_id, win, kind, sum(least(e, (win + 1) * {DAY6}) - greatest(s, win * {DAY6}))::BIGINT AS ov FROM x WHERE least(e, (win + 1) * {DAY6}) > greatest(s, win * {DAY6}) GROUP BY 1, 2, 3),
r AS (SELECT *, sum(ov) OVER (PARTITION BY user_id, win) AS mass, row_number() OVER (PARTITION BY user_id, win ORDER BY ov DESC, kind) AS rk FROM o)
SELECT user_id, win, kind, mass::BIGINT AS mass, round(ov / mass, 6) AS share, CASE WHEN mass < 60000000 THEN 'NO_MATCH' WHEN ov / mass >= 0.8 THEN 'HIGH' WHEN ov / mass >= 0.65 THEN 'MEDIUM' ELSE 'AMBIGUOUS' END AS status
FROM r WHERE rk = 1""")
def interval_overlap(spark: SparkSession, d: str) -> DataFrame:
    """JON-06 and AGG-12: sessions against six-hour windows, dominant kind and status."""
    s = sessions(table(spark, d, "events")).where("e > s")
    wins = s.select("user_id", F.explode(F.sequence(F.floor(F.col("s") / DAY6), F.floor(F.col("e") / DAY6))).alias("win")).distinct()
    wins = wins.withColumns({"ws": F.col("win") * DAY6, "we": (F.col("win") + 1) * DAY6})
    ov = core.interval_join(s, wins, ["user_id"], ("s", "e"), ("ws", "we"), float(DAY6))
    o = ov.groupBy("user_id", "win", "kind").agg(F.sum("ov").alias("ov"))
    mass = F.sum("ov").over(Window.partitionBy("user_id", "win"))
    r = core.topk(o.withColumn("mass", mass), ["user_id", "win"], [F.desc("ov"), F.asc("kind")], 1)
    share = F.col("ov") / F.col("mass")
    status = F.when(F.col("mass") < 60_000_000, "NO_MATCH").when(share >= 0.8, "HIGH").when(share >= 0.65, "MEDIUM").otherwise("AMBIGUOUS")
    return r.select("user_id", "win", "kind", "mass", F.round(share, 6).alias("share"), status.alias("status"))


@register("interval_union", f"""WITH {SESS}, a AS (SELECT kind, s, e, max(e) OVER (PARTITION BY kind ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM sess),
b AS (SELECT *, sum(CASE WHEN seen IS NULL OR s > seen THEN 1 ELSE 0 END) OVER (PARTITION BY kind ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM a),
c AS (SELECT kind, run, max(e) - min(s) AS len FROM b GROUP BY 1, 2) SELECT kind, sum(len)::BIGINT AS union_length FROM c GROUP BY kind""")
def interval_union(spark: SparkSession, d: str) -> DataFrame:
    """AGG-16."""
    return core.interval_union(sessions(table(spark, d, "events")), ["kind"], "s", "e")


@register("asof_prev_next", """WITH p AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events WHERE event_type = 'purchase'), q AS (SELECT user_id, epoch_us(ts) AS t, value FROM events WHERE event_type IN ('click', 'view')),
a AS (SELECT p.*, q.t AS prev_t, q.value AS prev_value FROM p ASOF LEFT JOIN q ON p.user_id = q.user_id AND p.t >= q.t),
b AS (SELECT p.event_id, q.t AS next_t, q.value AS next_value FROM p ASOF LEFT JOIN q ON p.user_id = q.user_id AND p.t <= q.t)
SELECT a.*, b.next_t, b.next_value, CASE WHEN prev_t IS NULL AND next_t IS NULL THEN 'NONE' WHEN least(coalesce(t - prev_t, 9e18::BIGINT), coalesce(next_t - t, 9e18::BIGINT)) <= 600000000 THEN 'NEAR'
  WHEN prev_t IS NOT NULL AND next_t IS NOT NULL THEN 'BRACKET' ELSE 'FAR' END AS bucket FROM a JOIN b USING (event_id)""")
def asof_prev_next(spark: SparkSession, d: str) -> DataFrame:
    """JON-10, WIN-09."""
    e = table(spark, d, "events").select("user_id", "event_id", micros().alias("t"), "event_type", "value")
    p = e.where("event_type = 'purchase'").select("user_id", "event_id", "t")
    out = core.asof_both(p, e.where("event_type in ('click', 'view')").select("user_id", "t", "value"), ["user_id"], "t", ["value"])
    near = F.least(F.coalesce(F.col("t") - F.col("prev_t"), F.lit(9 * 10**18)), F.coalesce(F.col("next_t") - F.col("t"), F.lit(9 * 10**18)))
    bucket = F.when(F.col("prev_t").isNull() & F.col("next_t").isNull(), "NONE").when(near <= 600_000_000, "NEAR").when(F.col("prev_t").isNotNull() & F.col("next_t").isNotNull(), "BRACKET").otherwise("FAR")
    return out.withColumn("bucket", bucket)


@register("point_in_interval", """SELECT o_orderkey, year(o_orderdate) * 4 + quarter(o_orderdate) AS q FROM orders""")
def point_in_interval(spark: SparkSession, d: str) -> DataFrame:
    """JON-11: order dates among the quarters that occur."""
    o = table(spark, d, "orders").select("o_orderkey", F.lit(0).alias("k"), F.datediff("o_orderdate", F.lit("1970-01-01")).alias("t"))
    span = o.agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    day = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), c)
    q = span.select(F.explode(F.sequence(F.trunc(day("lo"), "quarter"), day("hi"), F.expr("interval 3 months"))).alias("b"))
    q = q.select(F.lit(0).alias("k"), (F.year("b") * 4 + F.quarter("b")).cast("long").alias("q"), F.datediff("b", F.lit("1970-01-01")).alias("s"), (F.datediff(F.add_months("b", 3), F.lit("1970-01-01")) - 1).alias("e"))
    return core.point_in_interval(o, q, ["k"], "t", ("s", "e"), 91.0, "s").select("o_orderkey", "q")


@register("grid_sampling", f"""WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events), g AS (SELECT user_id, unnest(range(min(t) // {DAY6}, max(t) // {DAY6} + 1)) * {DAY6} + {DAY6 // 2} AS target FROM e GROUP BY user_id),
r AS (SELECT g.user_id, g.target, e.event_id, row_number() OVER (PARTITION BY g.user_id, g.target ORDER BY abs(e.t - g.target), e.t, e.event_id) AS rk FROM g JOIN e USING (user_id))
SELECT DISTINCT user_id, event_id FROM r WHERE rk = 1""")
def grid_sampling(spark: SparkSession, d: str) -> DataFrame:
    """WIN-13: nearest event to each grid time, by as-of joins to both sides, not all pairs."""
    e = table(spark, d, "events").select("user_id", "event_id", micros().alias("t"))
    span = e.groupBy("user_id").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    grid = span.select("user_id", F.explode(F.sequence(F.floor(F.col("lo") / DAY6), F.floor(F.col("hi") / DAY6))).alias("g")).select("user_id", (F.col("g") * DAY6 + DAY6 // 2).alias("t"))
    both = core.asof_both(grid, e, ["user_id"], "t", ["event_id"])
    far = F.lit(9 * 10**18)
    before, after = F.coalesce(F.col("t") - F.col("prev_t"), far), F.coalesce(F.col("next_t") - F.col("t"), far)
    return both.select("user_id", F.when(before <= after, F.col("prev_event_id")).otherwise(F.col("next_event_id")).alias("event_id")).distinct()


@register("evidence_fusion", """WITH w AS (SELECT user_id, event_type, CASE event_type WHEN 'signup' THEN 0.1 WHEN 'purchase' THEN 0.05 WHEN 'click' THEN 0.02 ELSE 0.01 END AS w FROM events),
f AS (SELECT user_id, 1 - exp(sum(ln(1 - w))) AS p, count(DISTINCT event_type) AS kinds, count(*) FILTER (WHERE event_type = 'signup') AS direct FROM w GROUP BY user_id)
SELECT user_id, round(p, 6) AS combined, kinds, direct, CASE WHEN p >= 0.96 AND kinds >= 2 AND direct >= 1 THEN 'HIGH_CONFIDENCE_CANDIDATE' WHEN p < 0.35 THEN 'WEAK' ELSE 'OPEN' END AS status FROM f""")
def evidence_fusion(spark: SparkSession, d: str) -> DataFrame:
    """AGG-14, VOI-08: noisy OR in logarithms."""
    # Weights of this query's kinds of evidence.
    w = X.lookup(F.col("event_type"), {"signup": 0.1, "purchase": 0.05, "click": 0.02}, 0.01)
    f = table(spark, d, "events").groupBy("user_id").agg(
        (1 - F.exp(F.sum(F.ln(1 - w)))).alias("p"), F.countDistinct("event_type").alias("kinds"), F.count_if(F.col("event_type") == "signup").alias("direct"))
    status = F.when((F.col("p") >= 0.96) & (F.col("kinds") >= 2) & (F.col("direct") >= 1), "HIGH_CONFIDENCE_CANDIDATE").when(F.col("p") < 0.35, "WEAK").otherwise("OPEN")
    return f.select("user_id", F.round("p", 6).alias("combined"), "kinds", "direct", status.alias("status"))


@register("interaction_summary", """SELECT o_custkey, o_orderpriority, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_totalprice > 200000) AS large, count(DISTINCT CAST(o_orderdate AS DATE)) AS days
FROM orders GROUP BY 1, 2""")
def interaction_summary(spark: SparkSession, d: str) -> DataFrame:
    """AGG-04, AGG-05."""
    return table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count_if(F.col("o_totalprice") > 200000).alias("large"),
        F.countDistinct(F.col("o_orderdate").cast("date")).alias("days"))


@register("kind_counters", """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts FROM c GROUP BY user_id""")
def kind_counters(spark: SparkSession, d: str) -> DataFrame:
    """MAP-01, JSN-02: sorted counters."""
    m = core.map_counter(table(spark, d, "events"), ["user_id"], "event_type", "m")
    return m.select("user_id", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


@register("outer_explode_claims", """SELECT event_id, props ->> '$.k' AS claim, CASE WHEN (props ->> '$.k') IS NULL THEN 'NO_LINKED_CLAIM' ELSE 'LINKED' END AS status FROM events""")
def outer_explode_claims(spark: SparkSession, d: str) -> DataFrame:
    """JON-02: outer explode of linked ids."""
    k = F.get_json_object("props", "$.k")
    e = table(spark, d, "events").select("event_id", F.explode_outer(F.when(k.isNotNull(), F.array(k))).alias("claim"))
    return e.withColumn("status", F.when(F.col("claim").isNull(), "NO_LINKED_CLAIM").otherwise("LINKED"))


@register("scd_merge", """WITH o AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey, upper(o_orderpriority) AS o_orderstatus FROM orders WHERE o_orderkey % 3 <> 1)
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus, CASE WHEN n.o_orderkey IS NULL THEN 'SUPERSEDED' ELSE 'CURRENT' END AS source_status,
CASE WHEN o.o_orderkey IS NULL THEN 2 ELSE 1 END AS created_at, CASE WHEN n.o_orderkey IS NULL THEN 1 ELSE 2 END AS last_seen_at, CASE WHEN n.o_orderkey IS NULL THEN 2 END AS superseded_at FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey""")
def scd_merge(spark: SparkSession, d: str) -> DataFrame:
    """AGG-20, TXT-14."""
    o = table(spark, d, "orders")
    old = o.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus", F.lit("CURRENT").alias("source_status"), F.lit(1).alias("created_at"), F.lit(1).alias("last_seen_at"), F.lit(None).cast("int").alias("superseded_at"))
    new = o.where("o_orderkey % 3 <> 1").select("o_orderkey", F.upper("o_orderpriority").alias("o_orderstatus"))
    return core.scd_merge(old, new, "o_orderkey", F.lit(2))


@register("upsert_keep_filled", """WITH o AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE upper(c_name) END AS c_name, '' AS c_mktsegment FROM customer WHERE c_custkey % 5 <> 0)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(nullif(n.c_name, ''), o.c_name) AS c_name, coalesce(nullif(n.c_mktsegment, ''), o.c_mktsegment) AS c_mktsegment FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def upsert_keep_filled(spark: SparkSession, d: str) -> DataFrame:
    """SNK-05."""
    c = table(spark, d, "customer")
    old = c.where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_mktsegment")
    new = c.where("c_custkey % 5 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.upper("c_name")).alias("c_name"), F.lit("").alias("c_mktsegment"))
    return core.upsert(old, new, ["c_custkey"], keep_filled=True)


@register("dedupe_latest", """SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2""")
def dedupe_latest(spark: SparkSession, d: str) -> DataFrame:
    """SRC-04: a maximum by order, which sums on the map side."""
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max("event_id").alias("event_id"), F.max_by("value", "event_id").alias("value"))


@register("already_processed", """SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = e.user_id AND o.o_orderstatus = 'F')""")
def already_processed(spark: SparkSession, d: str) -> DataFrame:
    """SET-04, FLT-08: anti-join."""
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("user_id"))
    return table(spark, d, "events").join(done, "user_id", "left_anti").select("event_id")


@register("review_batches", """WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents)
SELECT source, (n - 1) // 40 AS batch_no, count(*) AS n, 'SR_' || upper(substr(sha256(string_agg(doc_id::VARCHAR, '|' ORDER BY doc_id)), 1, 20)) AS batch_id FROM r GROUP BY 1, 2""")
def review_batches(spark: SparkSession, d: str) -> DataFrame:
    """WIN-12, STR-13."""
    b = core.batches(table(spark, d, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 40)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), "|")
    out = b.groupBy("source", "batch_no").agg(F.count(F.lit(1)).alias("n"), ids.alias("ids"))
    return out.select("source", "batch_no", "n", X.stable_id("SR_", F.col("ids"), n=20).alias("batch_id"))


@register("queue_stats", """SELECT event_type AS kind, count(*) FILTER (WHERE value < 5) AS queued, count(*) FILTER (WHERE value >= 5 AND value < 15) AS leased, count(*) FILTER (WHERE value >= 15) AS done FROM events GROUP BY 1""")
def queue_stats(spark: SparkSession, d: str) -> DataFrame:
    """AGG-21."""
    v = F.col("value")
    return table(spark, d, "events").groupBy(F.col("event_type").alias("kind")).agg(
        F.count_if(v < 5).alias("queued"), F.count_if((v >= 5) & (v < 15)).alias("leased"), F.count_if(v >= 15).alias("done"))


@register("lease_order", """SELECT event_type AS kind, arg_min(event_id, (floor(value)::BIGINT, event_id)) AS next_job FROM events GROUP BY 1""")
def lease_order(spark: SparkSession, d: str) -> DataFrame:
    """SRT-07: the next job by priority and id."""
    order = F.struct(F.floor("value").alias("p"), F.col("event_id").alias("id"))
    return table(spark, d, "events").groupBy(F.col("event_type").alias("kind")).agg(F.min_by("event_id", order).alias("next_job"))


@register("tumbling", "SELECT epoch_us(time_bucket(INTERVAL '1 hour', ts)) AS w, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("win"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.unix_micros(F.col("win.start").cast("timestamp")).alias("w"), "event_type", "n", "total")


@register("sliding", """WITH e AS (SELECT epoch_us(ts) AS t FROM events), x AS (SELECT unnest([(t // 1800000000) * 1800000000, (t // 1800000000 - 1) * 1800000000]) AS w FROM e) SELECT w, count(*) AS n FROM x GROUP BY 1""")
def sliding(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "events").groupBy(F.window("ts", "1 hour", "30 minutes").alias("win")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.unix_micros(F.col("win.start").cast("timestamp")).alias("w"), "n")


@register("session", f"WITH {SESS.replace('<= ' + str(HALF_HOUR), '< ' + str(HALF_HOUR))} SELECT user_id, s, e + {HALF_HOUR} AS e, n FROM sess")
def session(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return g.select("user_id", us("w.start").alias("s"), us("w.end").alias("e"), "n")


@register("status_cube", """SELECT event_type, value >= 10 AS large, count(*) AS n FROM events GROUP BY CUBE (event_type, value >= 10)""")
def status_cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("large", F.col("value") >= 10).cube("event_type", "large").agg(F.count(F.lit(1)).alias("n"))


@register("burst", """WITH b AS (SELECT epoch_us(ts) // 3600000000 AS h, event_type, count(DISTINCT user_id) AS users, count(*) AS n FROM events GROUP BY 1, 2) SELECT h, event_type, users, n FROM b WHERE users >= 4""")
def burst(spark: SparkSession, d: str) -> DataFrame:
    """DCL-11: many users, one kind, one hour."""
    b = table(spark, d, "events").groupBy(F.floor(micros() / 3_600_000_000).alias("h"), "event_type").agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("n"))
    return b.where("users >= 4")


@register("funnel", """WITH p AS (SELECT user_id, epoch_us(ts) AS t, event_type FROM events), f AS (SELECT user_id, min(t) FILTER (WHERE event_type = 'view') AS v FROM p GROUP BY 1),
c AS (SELECT f.user_id, v, min(t) FILTER (WHERE event_type = 'click' AND t > v) AS c FROM f JOIN p USING (user_id) GROUP BY 1, 2), b AS (SELECT c.user_id, v, c, min(t) FILTER (WHERE event_type = 'purchase' AND t > c.c) AS b FROM c JOIN p USING (user_id) GROUP BY 1, 2, 3)
SELECT user_id, (v IS NOT NULL)::INT + (c IS NOT NULL)::INT + (b IS NOT NULL)::INT AS steps, round((b - v) / 60000000.0, 3) AS minutes FROM b""")
def funnel(spark: SparkSession, d: str) -> DataFrame:
    """DCL-07: view, then click, then purchase, by running minima in one pass over each user's events."""
    e = table(spark, d, "events").select("user_id", micros().alias("t"), "event_type")
    w = Window.partitionBy("user_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("v", F.min(F.when(F.col("event_type") == "view", F.col("t"))).over(w))
    e = e.withColumn("c", F.min(F.when((F.col("event_type") == "click") & (F.col("t") > F.col("v")), F.col("t"))).over(w))
    g = e.groupBy("user_id").agg(F.min("v").alias("v"), F.min("c").alias("c"), F.min(F.when((F.col("event_type") == "purchase") & (F.col("t") > F.col("c")), F.col("t"))).alias("b"))
    steps = sum(F.col(x).isNotNull().cast("int") for x in "vcb")
    return g.select("user_id", steps.alias("steps"), F.round((F.col("b") - F.col("v")) / 60_000_000.0, 3).alias("minutes"))


@register("concentration", """WITH c AS (SELECT user_id, event_type, sum(value) AS v FROM events GROUP BY 1, 2) SELECT user_id, event_type, round(v / sum(v) OVER (PARTITION BY user_id), 6) AS share FROM c""")
def concentration(spark: SparkSession, d: str) -> DataFrame:
    """DCL-05."""
    c = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("v"))
    return c.select("user_id", "event_type", F.round(F.col("v") / F.sum("v").over(Window.partitionBy("user_id")), 6).alias("share"))


@register("stance_reversal", """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (WHERE event_type = 'purchase') AS positive, count(*) FILTER (WHERE event_type = 'error') AS negative FROM events GROUP BY 1, 2 HAVING positive > 0 AND negative > 0""")
def stance_reversal(spark: SparkSession, d: str) -> DataFrame:
    """GRF-13."""
    g = table(spark, d, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return g.agg(F.count_if(F.col("event_type") == "purchase").alias("positive"), F.count_if(F.col("event_type") == "error").alias("negative")).where("positive > 0 and negative > 0")


@register("change_log", """SELECT * FROM (SELECT user_id, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before, event_type AS after FROM events) WHERE before <> after""")
def change_log(spark: SparkSession, d: str) -> DataFrame:
    """DCL-12."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, d, "events").select("user_id", "event_id", F.lag("event_type").over(w).alias("before"), F.col("event_type").alias("after")).where("before <> after")


@register("event_study", """WITH p AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events WHERE event_type = 'purchase'), q AS (SELECT user_id, epoch_us(ts) AS t, value FROM events WHERE event_type = 'view')
SELECT p.event_id, count(q.t) FILTER (WHERE q.t < p.t) AS n_before, count(q.t) FILTER (WHERE q.t > p.t) AS n_after, round(coalesce(sum(q.value) FILTER (WHERE q.t > p.t), 0), 4) AS after_value
FROM p LEFT JOIN q ON p.user_id = q.user_id AND q.t BETWEEN p.t - 86400000000 AND p.t + 86400000000 GROUP BY 1""")
def event_study(spark: SparkSession, d: str) -> DataFrame:
    """DCL-06: the day before and after, by range frames over one ordering."""
    e = table(spark, d, "events").select("user_id", "event_id", micros().alias("t"), "event_type", "value")
    day = 86_400_000_000
    w = Window.partitionBy("user_id").orderBy("t")
    before, after = w.rangeBetween(-day, -1), w.rangeBetween(1, day)
    view = F.col("event_type") == "view"
    out = e.withColumns({"n_before": F.count_if(view).over(before), "n_after": F.count_if(view).over(after), "after_value": F.round(F.coalesce(F.sum(F.when(view, F.col("value"))).over(after), F.lit(0.0)), 4)})
    return out.where("event_type = 'purchase'").select("event_id", "n_before", "n_after", "after_value")

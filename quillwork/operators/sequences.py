"""Chains of citations and bursts in time: lineage by pointer doubling, sliding distinct counts by entries and exits."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import saved


def citation_lineage(links: DataFrame) -> DataFrame:
    """DCL-10: id, origin, hops, cycle, in_cycle for links (id, cites): each item cites one other, itself, or none (null or
    an id that is no item's).

    A chain ends at its origin, an item that cites none, hops away; items of one origin are one source. Where a chain runs
    into a cycle, of any length, origin and hops are null and cycle is the least id on it. Pointers are doubled: each round
    joins every open pointer with the one it points at, so chains of n steps take log2 n rounds; pointers that have come to
    an origin take no part any more. What all pointers point at after at least as many steps as there are items is on a
    cycle."""
    items = links.select("id", "cites")
    known = items.select(F.col("id").alias("cites"))
    items = saved(items.join(known, "cites", "left_semi").select("id", "cites").unionByName(items.join(known, "cites", "left_anti").select("id", F.lit(None).cast(dict(items.dtypes)["cites"]).alias("cites"))), "cites")
    at = items.where("cites is not null").select("id", F.col("cites").alias("to"), F.lit(1).cast("long").alias("hops"), F.col("id").alias("least"))
    roots = saved(items.where("cites is null").select(F.col("id").alias("to")), "roots")
    done = roots.select(F.col("to").alias("id"), F.col("to").alias("origin"), F.lit(0).cast("long").alias("hops"))
    for _ in range(max(1, math.ceil(math.log2(items.count() + 1)) + 1)):
        at = saved(at, "pointers")
        ended = at.join(roots.hint("merge"), "to", "left_semi")
        done = done.unionByName(ended.select("id", F.col("to").alias("origin"), "hops"))
        open_ = at.join(roots.hint("merge"), "to", "left_anti")
        if open_.isEmpty():
            break
        # a pointer's target has ended in an earlier round, or is open itself
        onward = at.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"), F.col("least").alias("low"))
        old = done.where("hops > 0").select(F.col("id").alias("to"), F.col("origin").alias("next"), F.col("hops").alias("more"), F.col("id").alias("low"))
        onward = onward.unionByName(old.join(onward.hint("merge"), "to", "left_anti"))
        at = open_.join(onward.hint("merge"), "to").select("id", F.col("next").alias("to"), (F.col("hops") + F.col("more")).alias("hops"), F.least("least", "low").alias("least"))
        done = saved(done, "ended")
    at = saved(at.join(roots.hint("merge"), "to", "left_anti"), "pointers")  # what is open now runs into cycles
    on = at.select(F.col("to").alias("id")).distinct().withColumn("in_cycle", F.lit(True))
    circles = at.join(at.select(F.col("id").alias("to"), F.col("least").alias("cycle")).hint("merge"), "to").select("id", "cycle")
    none = F.lit(None)
    ended = done.select("id", "origin", "hops", none.cast(dict(done.dtypes)["id"]).alias("cycle"), F.lit(False).alias("in_cycle"))
    running = circles.join(on.hint("merge"), "id", "left").select("id", none.cast(dict(done.dtypes)["id"]).alias("origin"), none.cast("long").alias("hops"), "cycle", F.coalesce("in_cycle", F.lit(False)).alias("in_cycle"))
    return ended.unionByName(running)


def bursts(events: DataFrame, width: int, least: int, part: int | None = None) -> DataFrame:
    """DCL-11: key, start, end, peak: maximal spans in which `least` distinct users or more have an event of the key within
    the last `width` units, at every moment of it, wherever the span lies. events: key, user, t (whole units); end is the
    first moment at which there are fewer.

    A user counts from an event on for `width` units; overlapping stretches of a user are one, so the sum of entries less
    exits is the exact number of distinct users. The running sum is taken in parts of time (`part` units): first each part's
    total, then within the parts, so that a key with very many events is not one task."""
    part = part or 50 * width
    w = Window.partitionBy("key", "user").orderBy("t")
    e = events.select("key", "user", "t").distinct()
    gap = e.withColumn("gap", F.col("t") - F.lag("t").over(w))
    # a stretch begins where none runs, and ends `width` after its last event
    enter = gap.where(F.col("gap").isNull() | (F.col("gap") > width)).select("key", "t", F.lit(1).alias("d"))
    leave = e.withColumn("next", F.lead("t").over(w)).where(F.col("next").isNull() | (F.col("next") - F.col("t") > width)).select("key", (F.col("t") + width).alias("t"), F.lit(-1).alias("d"))
    points = saved(enter.unionByName(leave).groupBy("key", "t").agg(F.sum("d").alias("d")).where("d <> 0").withColumn("part", F.floor(F.col("t") / part)), "points")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = points.groupBy("key", "part").agg(F.sum("d").alias("s")).select("key", "part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("key", "part").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    level = points.join(sums, ["key", "part"]).withColumn("level", F.col("base") + F.sum("d").over(inside)).withColumn("was", F.col("level") - F.col("d"))
    level = saved(level.where((F.col("level") >= least) | (F.col("was") >= least)).withColumn("begins", F.when((F.col("was") < least) & (F.col("level") >= least), F.col("t"))), "levels")
    begun = level.groupBy("key", "part").agg(F.max("begins").alias("b")).select("key", "part", F.max("b").over(before).alias("carry"))
    own = level.join(begun, ["key", "part"]).withColumn("start", F.coalesce(F.max("begins").over(inside), "carry"))
    return own.groupBy("key", "start").agg(F.min(F.when(F.col("level") < least, F.col("t"))).alias("end"), F.max("level").alias("peak"))


def _in_parts(events: DataFrame, part: int, before: int, after: int = 0) -> DataFrame:
    """events dealt to stretches of time of `part` units, column part, so that a frequent key is not one task. Events up to
    `before` units before a stretch, and `after` behind it, are in it too, as context: own is false."""
    t = F.col("t")
    at = F.floor(t / part)
    parts = F.sequence(F.floor((t - after) / part), F.floor((t + before) / part))
    return events.withColumn("part", F.explode(parts)).withColumn("own", F.col("part") == at)


def funnels(events: DataFrame, steps: list[str], gap: int, part: int | None = None) -> DataFrame:
    """DCL-07: key, id, step, t, start: each event that ends a chain of its kind's length. events: key, id, kind, t (whole
    units); steps: the kinds in order, each once; step counts from 1.

    A chain takes a step's event strictly later than the one before it and at most `gap` later. Of several chains an event
    continues the latest one (of equal times the latest start), so t - start is the shortest time from the first step. Events
    without key or t end no chain. A chain of k steps reaches back (k - 1) * gap at most, so stretches of time with that much
    context give all of them: one shuffle and one sort, a running maximum a step."""
    back = gap * (len(steps) - 1)
    e = events.where(F.col("kind").isin(steps) & F.col("key").isNotNull() & F.col("t").isNotNull()).select("key", "id", "kind", "t")
    e = _in_parts(e, max(part or 50 * back, back, 1), back)
    earlier = Window.partitionBy("key", "part").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("start", F.when(F.col("kind") == steps[0], F.col("t")))
    for last, kind in zip(steps, steps[1:], strict=False):
        come = F.max(F.when((F.col("kind") == last) & F.col("start").isNotNull(), F.struct("t", "start"))).over(earlier)
        e = e.withColumn("come", come)
        e = e.withColumn("start", F.when((F.col("kind") == kind) & (F.col("t") - F.col("come.t") <= gap), F.col("come.start")).otherwise(F.col("start")))
    step = F.array_position(F.array(*map(F.lit, steps)), F.col("kind")).cast("int")
    return e.where("own and start is not null").select("key", "id", step.alias("step"), "t", "start")


def adjacency(events: DataFrame, lead: list[str], follow: list[str], limits: list[int], part: int | None = None) -> DataFrame:
    """DCL-07: key, id, t, apart, same_segment and within_<limit> for each event of a kind in `follow`: how far the nearest
    event of a kind in `lead` of its key is, before or after it (null beyond the largest limit), whether one is in its own
    segment, and whether one is within each limit. events: key, id, kind, t (whole units), segment.

    Events of a key or a time that is null have no neighbours; a null segment is nobody's."""
    far = max(limits)
    leads, follows = F.col("kind").isin(lead), F.col("kind").isin(follow)
    e = events.where(leads | follows).select("key", "id", "kind", "t", "segment")
    timed = F.col("key").isNotNull() & F.col("t").isNotNull()
    p = _in_parts(e.where(timed), max(part or 50 * far, far, 1), far, far)
    w = Window.partitionBy("key", "part")
    up, down = w.orderBy("t").rangeBetween(Window.unboundedPreceding, 0), w.orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, 0)
    lead_t = F.when(leads, F.col("t"))
    p = p.withColumns({"a": F.col("t") - F.max(lead_t).over(up), "z": F.min(lead_t).over(down) - F.col("t")}).where(F.col("own") & follows)
    near = F.least("a", "z")
    p = p.select("key", "id", "t", "segment", F.when(near <= far, near).alias("apart"))
    p = p.unionByName(e.where(follows & ~timed).select("key", "id", "t", "segment", F.lit(None).cast("long").alias("apart")))
    same = e.where(leads).select("key", "segment", F.lit(True).alias("same_segment")).where("key is not null and segment is not null").distinct()
    p = p.join(same, ["key", "segment"], "left").withColumn("same_segment", F.coalesce("same_segment", F.lit(False)))
    return p.select("key", "id", "t", "apart", "same_segment", *[F.coalesce(F.col("apart") <= x, F.lit(False)).alias(f"within_{x}") for x in limits])


#: The six parts of the pitch score, 0 to 2 each.
SCORED = ["threat", "urgency", "adjacency", "financial", "weakness", "price"]


def pitch_score(**parts):
    """DCL-07: the sum of the six parts (columns), each cut to 0 ... 2, null as 0."""
    return sum(F.greatest(F.lit(0), F.least(F.lit(2), F.coalesce(parts[p].cast("int"), F.lit(0)))) for p in SCORED)


def near_points(same_segment, within_1, within_5):
    """2 for the same segment or a minute, 1 for five minutes, else 0."""
    return F.when(same_segment | within_1, 2).when(within_5, 1).otherwise(0)

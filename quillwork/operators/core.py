"""Relational building blocks: interval and as-of joins, top-k, upserts, islands, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], l_span: tuple[str, str], r_span: tuple[str, str], width: float) -> DataFrame:
    """JON-06, JON-07: pairs of equal keys whose spans [start, end) overlap, each once, with column ov (length of overlap).

    Both sides are dealt to time bins of `width` and joined by (keys, bin), a plain equi-join that Spark can split; a pair
    counts in the first bin that both reach. Choose width near a typical span."""
    (ls, le), (rs, re) = l_span, r_span
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.greatest(F.col(s), F.col(e)) / width)))
    a, b = left.withColumn("__bin", bins(ls, le)), right.withColumn("__bin", bins(rs, re))
    both = a.join(b, [*keys, "__bin"])
    ov = F.least(F.col(le), F.col(re)) - F.greatest(F.col(ls), F.col(rs))
    return both.withColumn("ov", ov).where((F.col("ov") > 0) & (F.col("__bin") == F.floor(F.greatest(F.col(ls), F.col(rs)) / width))).drop("__bin")


def point_in_interval(points: DataFrame, spans: DataFrame, keys: list[str], t: str, span: tuple[str, str], width: float, order: str) -> DataFrame:
    """JON-11: each point with the first (by `order`) closed interval that holds it; points without one stay with NULLs."""
    s, e = span
    q = spans.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width))))
    names = [c for c in spans.columns if c not in keys]
    # points of one time share their interval, so times are looked up, not rows
    times = points.select(*keys, t).distinct().withColumn("__bin", F.floor(F.col(t) / width))
    hits = times.join(q, [*keys, "__bin"]).where((F.col(t) >= F.col(s)) & (F.col(t) <= F.col(e)))
    best = hits.groupBy(*keys, t).agg(F.min_by(F.struct(*names), order).alias("__b"))
    return points.join(best, [*keys, t], "left").select(*points.columns, *[F.col(f"__b.{c}").alias(c) for c in names])


def asof_both(left: DataFrame, right: DataFrame, keys: list[str], t: str, value: list[str]) -> DataFrame:
    """JON-10, WIN-09: left rows with the last right row at or before t (prev_*) and the first at or after it (next_*).

    One union and two window passes over (keys, t); no theta join."""
    cols = [c for c in left.columns if c not in keys and c != t]
    l = left.select(*keys, t, F.lit(1).alias("__side"), *cols, *[F.lit(None).alias(f"__{v}") for v in (t, *value)])
    r = right.select(*keys, t, F.lit(0).alias("__side"), *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in cols], F.col(t).alias(f"__{t}"), *[F.col(v).alias(f"__{v}") for v in value])
    both = l.unionByName(r)
    seen = F.when(F.col("__side") == 0, F.struct(*[f"__{v}" for v in (t, *value)]))
    back = Window.partitionBy(*keys).orderBy(t, "__side").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.desc(t), "__side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumns({"__p": F.last(seen, True).over(back), "__n": F.last(seen, True).over(ahead)}).where("__side = 1")
    return out.select(*left.columns, *[F.col(f"__p.__{v}").alias(f"prev_{v}") for v in (t, *value)], *[F.col(f"__n.__{v}").alias(f"next_{v}") for v in (t, *value)])


def topk(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """SRT-04, SRT-05: row_number <= k, which Spark prunes before the shuffle; rank is 1 ... k."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def islands(df: DataFrame, by: list[str], order: list[str | Column], new: Column, name: str = "island") -> DataFrame:
    """WIN-03, WIN-04, WIN-05: numbers runs; `new` says (by lag and the like) that a row begins one."""
    return df.withColumn(name, F.sum(F.when(new, 1).otherwise(0)).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def interval_union(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """AGG-16: total length of the union of spans per group."""
    w = Window.partitionBy(*by).orderBy(start, end)
    seen = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = islands(df.withColumn("__seen", seen), by, [start, end], F.col("__seen").isNull() | (F.col(start) > F.col("__seen")), "__run")
    spans = runs.groupBy(*by, "__run").agg((F.max(end) - F.min(start)).alias("__len"))
    return spans.groupBy(*by).agg(F.sum("__len").alias("union_length"))


def neighbours(df: DataFrame, by: list[str], order: list[str], value: Column, k: int = 2) -> DataFrame:
    """WIN-01: lists of up to k values before and after each row."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumns({"before": F.collect_list(value).over(w.rowsBetween(-k, -1)), "after": F.collect_list(value).over(w.rowsBetween(1, k))})


def batches(df: DataFrame, by: list[str], order: list[Column | str], size: int) -> DataFrame:
    """WIN-11, WIN-12: ordinal and number of its batch of `size`, within groups."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("ordinal", n).withColumn("batch_no", F.floor((F.col("ordinal") - 1) / size))


def latest(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """SRC-04: the last row of each key."""
    return topk(df, keys, [F.desc(o) if isinstance(o, str) else o for o in order], 1).drop("rank")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_filled: bool = False) -> DataFrame:
    """SNK-02: new rows replace old rows of the same key. SNK-05 with keep_filled: an old value stays where the new is empty."""
    if not keep_filled:
        return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
    rest = [c for c in old.columns if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"__o_{c}") for c in rest])
    full = o.join(new, keys, "full_outer")
    fill = lambda c: F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(c))
    return full.select(*keys, *[F.coalesce(fill(c), F.col(f"__o_{c}")).alias(c) for c in rest])


def map_counter(df: DataFrame, by: list[str], c: str, name: str) -> DataFrame:
    """MAP-01: map of values to counts, sorted by value."""
    n = df.groupBy(*by, c).agg(F.count(F.lit(1)).alias("__n"))
    return n.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "__n")))).alias(name))


def unordered_pairs(df: DataFrame, group: list[str], item: str) -> DataFrame:
    """JON-12: distinct unordered pairs of items within a group."""
    one = df.select(*group, item).distinct()
    a, b = one.withColumnRenamed(item, "a"), one.withColumnRenamed(item, "b")
    return a.join(b, group).where(F.col("a") < F.col("b"))


def pairs_in_row(df: DataFrame, items: Column) -> DataFrame:
    """JON-12 where a group is a row: a, b for each two of a row's sorted distinct items, without a join."""
    pairs = lambda x: F.flatten(F.transform(x, lambda p, i: F.transform(F.slice(x, i + 2, F.size(x)), lambda q: F.struct(p.alias("a"), q.alias("b")))))
    return df.select(items.alias("__x")).where(F.size("__x") > 1).select(F.inline(pairs(F.col("__x"))))


def scd_merge(current: DataFrame, incoming: DataFrame, key: str, run: Column) -> DataFrame:
    """AGG-20, TXT-14: versions. Keys that come again are seen anew, keys that do not are superseded, new keys begin.
    current: key, source_status, created_at, last_seen_at, superseded_at and payload; incoming: key and payload."""
    state = ["source_status", "created_at", "last_seen_at", "superseded_at"]
    rest = [c for c in incoming.columns if c != key]
    o = current.select(key, *[F.col(c).alias(f"__{c}") for c in (*state, *rest)], F.lit(True).alias("__old"))
    both = o.join(incoming.withColumn("__new", F.lit(True)), key, "full_outer")
    came, was = F.col("__new").isNotNull(), F.col("__old").isNotNull()
    return both.select(
        key, *[F.when(came, F.col(c)).otherwise(F.col(f"__{c}")).alias(c) for c in rest],
        F.when(came, "CURRENT").otherwise("SUPERSEDED").alias("source_status"), F.when(was, F.col("__created_at")).otherwise(run).alias("created_at"),
        F.when(came, run).otherwise(F.col("__last_seen_at")).alias("last_seen_at"),
        F.when(came, F.lit(None)).otherwise(F.coalesce("__superseded_at", run)).alias("superseded_at"),
    )

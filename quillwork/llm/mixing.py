"""Mixing sources to target weights by pivotal dependent rounding (DataFrame operations only).

A source's target divided by its size is the expected number of copies of each of its documents. Whole copies are
taken as they are; the fractional parts are rounded by the pivotal method: two fractional documents meet, a random
amount of words moves between them so that one becomes integral, and the other goes on. What a document is expected
to give stays as it was and each source's total moves by no more than one document's share.

The pairing runs as a reduction tree. Documents are dealt by hash to groups of about `group` per source; each group is
folded inside one array expression and leaves one fractional residual at most; residuals are dealt to
groups again, until each source has one group. Longer documents meet first, so that what is left at the end is
short; it is rounded to the nearer side. Groups are bounded, so no source is gathered in one task.

Rows are dealt by a hash of source, doc_id, text and, for rows equal in all of these, a number within them, so groups stay
bounded where ids are missing or shared, and reruns agree however the rows are dealt out.

Defined cases: null text has size 0 and takes 0. A null source sorts last and is a source. Rows that share a doc_id, or
have none, and repeated rows are rounded apart. Zero words in all: all targets are 0. Texts of any length
are read whole. Other columns, whatever their names, are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, by_key, n_words

WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target. sizes: source, size. The excess over `most` times a source's size is shared again by
    weight; that ends at the level L where targets are min(L * weight, most * size), found from sums over sorted ratios.
    Works on one row per source, in one task: fit for some million sources."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), rank)).withColumn("cap", most * F.col("source_size"))
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the level if all sources before this one are full
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    per = per.withColumn("lv", level).withColumn("open", F.col("lv") * F.col("weight") <= F.col("cap"))
    final = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "lv"))).over(every)["lv"]
    return per.select("source", "source_size", F.least("cap", F.coalesce(final * F.col("weight"), F.col("cap"))).alias("target"))


def unit(*cols: Column | int) -> Column:
    """A repeatable number in [0, 1)."""
    h = F.xxhash64(*[c if isinstance(c, Column) else F.lit(c) for c in cols])
    return F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)


UNIT = "struct<o:bigint,h:bigint,doc_id:bigint,mark:bigint,size:bigint,whole:int,p:double>"
STATE = f"struct<done:array<{UNIT}>,carry:{UNIT}>"


def fold(units: Column, level: int, seed: int) -> Column:
    """units: array of UNIT with 0 < p < 1 in a fixed order. Gives STATE: units with p 0 or 1, and the one left over."""

    def meet(state: Column, x: Column) -> Column:
        c = state["carry"]
        up = F.least((1 - c["p"]) * c["size"], x["p"] * x["size"])  # words that x can give
        down = F.least(c["p"] * c["size"], (1 - x["p"]) * x["size"])  # words that the carry can give
        gives = unit(seed, level, c["h"], x["h"]) * (up + down) < down
        full_c, empty_x = (1 - c["p"]) * c["size"] <= up, x["p"] * x["size"] <= up
        empty_c, full_x = c["p"] * c["size"] <= down, (1 - x["p"]) * x["size"] <= down
        pc = F.when(gives, F.when(full_c, 1.0).otherwise(c["p"] + up / c["size"])).otherwise(F.when(empty_c, 0.0).otherwise(c["p"] - down / c["size"]))
        px = F.when(gives, F.when(empty_x, 0.0).otherwise(x["p"] - up / x["size"])).otherwise(F.when(full_x, 1.0).otherwise(x["p"] + down / x["size"]))
        put = lambda u, p: F.struct(u["o"].alias("o"), u["h"].alias("h"), u["doc_id"].alias("doc_id"), u["mark"].alias("mark"), u["size"].alias("size"), u["whole"].alias("whole"), p.alias("p"))
        both = F.array(put(c, pc), put(x, px))
        is_open = lambda u: (u["p"] > 1e-12) & (u["p"] < 1 - 1e-12)
        met = F.struct(F.concat(state["done"], F.filter(both, lambda u: ~is_open(u))).alias("done"), F.get(F.filter(both, is_open), F.lit(0)).alias("carry"))
        first = F.struct(state["done"].alias("done"), x.alias("carry"))
        return F.when(c.isNull(), first.cast(STATE)).otherwise(met.cast(STATE))

    start = F.expr(f"cast(named_struct('done', array(), 'carry', null) as {STATE})")
    return F.aggregate(units, start, meet)


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, group: int = 64, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken and mark (a hash of the text), one row per row of docs."""
    scratch = Scratch(spark, "mix")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", text_mark().alias("mark"), F.coalesce(n_words(F.col("text")), F.lit(0)).cast("long").alias("size"))
    equal = own.groupBy("source", "doc_id", "mark", "size").agg(F.count(F.lit(1)).alias("n"))
    sized = scratch.put("sizes", equal.select("source", "doc_id", "mark", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("nth")))
    targets = scratch.put("targets", source_targets(sized, weights, share, most).withColumn("sid", F.monotonically_increasing_id()))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select("sid", sized["source"], "doc_id", "mark", "nth", "size", copies.alias("e"))
    whole = F.floor(F.col("e") + 1e-12).cast("int")
    rows = rows.select("sid", (-F.col("size")).alias("o"), F.xxhash64(F.lit(seed), "source", "doc_id", "mark", "nth").alias("h"), "doc_id", "mark", "size", whole.alias("whole"), F.greatest(F.lit(0.0), F.col("e") - whole).alias("p"))
    largest = sized.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    depth = max(1, math.ceil(math.log(max(2, largest), group)))
    done = []
    u = F.struct("o", "h", "doc_id", "mark", "size", "whole", "p").cast(UNIT)
    for level in range(depth):
        last = level == depth - 1
        n_groups = 1 if last else math.ceil(largest / group ** (level + 1))
        closed = (F.col("size") == 0) | (F.col("p") < 1e-12)
        deal = F.pmod(F.xxhash64(F.lit(level), "h"), F.lit(n_groups))
        grouped = rows.where(~closed).groupBy("sid", deal.alias("g")).agg(F.array_sort(F.collect_list(u)).alias("units"))
        table = scratch.put(f"level{level}", grouped.select("sid", fold(F.col("units"), level, seed).alias("s")))
        done.append(rows.where(closed).withColumn("p", F.lit(0.0)))
        done.append(table.select("sid", F.inline("s.done")))
        rows = table.where("s.carry is not null").select("sid", "s.carry.*")
    done.append(rows.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0)))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    copies = (F.col("whole") + F.col("p").cast("int")).cast("int")
    return out.join(targets, "sid").select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), "mark")


def text_mark() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


#: Rows of one key that an ordinal is counted over at once.
DEAL = 10_000


def apply_mix(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """docs with each row repeated as often as the mix takes it; rows taken 0 times go. Columns stay as they are, whatever
    their names. Rows equal in source, doc_id and text get their copies dealt over them: each as many, and the first in the
    order of a hash of the row one more, until all are dealt."""
    scratch = Scratch(spark, "mixed")
    key = ["none", "source", "id", "mark"]
    keys = lambda text: [F.col("source").isNull().cast("int") + 2 * F.col("doc_id").isNull().cast("int"), F.coalesce("source", F.lit("")), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), text]
    named = lambda text: [c.alias(k) for c, k in zip(keys(text), key, strict=True)]
    plan = mix(spark, docs, **options).select(*named(F.col("mark")), "copies")
    per = scratch.put("plan", plan.groupBy(*key).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")).where("copies > 0"))
    total = per.agg(F.sum("n")).first()[0] or 0
    rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("tie"), *named(text_mark()))
    both = by_key(rows, per, key, "n", total, "shuffle_hash")
    alone = both.where("n = 1").select("row", "copies")
    # an ordinal among equal rows: counted in parts of bounded size, whose sizes before it are added
    part = both.where("n > 1").withColumn("h", F.xxhash64("row", "tie")).withColumn("part", F.shiftrightunsigned("h", 1) % F.ceil(F.col("n") / DEAL))
    sizes = part.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.withColumn("before", F.sum("size").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).drop("size")
    nth = F.row_number().over(Window.partitionBy(*key, "part").orderBy("h")) + F.coalesce("before", F.lit(0))
    own = F.floor(F.col("copies") / F.col("n")) + (nth <= F.col("copies") % F.col("n")).cast("int")
    shared = part.join(before, [*key, "part"]).select("row", own.cast("long").alias("copies"))
    taken = alone.unionByName(shared).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

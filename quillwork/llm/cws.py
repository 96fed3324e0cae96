"""Document fingerprints by consistent weighted sampling (DataFrame operations only).

A text is a bag of words. For sample k each word has, from its hash, r and c of a Gamma(2, 1) distribution and a uniform
beta. With weight w, t = floor(ln w / r + beta) and a = c / exp(r * (t - beta + 1)); the sample is the (word, t) of the
least a. Two texts agree in a sample with probability equal to the generalised Jaccard similarity of their bags, the sum
of least weights over the sum of greatest. A fingerprint is the 32-bit hashes of its samples in hex.

Words are hashed, sorted and counted inside the row; only the least a of each sample crosses the shuffle. a is kept as
31 bits of its logarithm above the hash of (word, t), so that one minimum of longs finds both.

Defined cases: null text is empty. A text without words has the empty fingerprint, which is like (1) itself and unlike
(0) all others. A null doc_id comes after all others. Rows that share a doc_id follow each other by their text hashes, and
equal rows stay apart. Any 64-bit ids do. Texts of any length are read whole. Other columns, whatever their names, are left
out. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch
from .quality import let, words_of

SAMPLES, AT_ONCE = 32, 4


def terms(text: Column) -> Column:
    """array<struct<term: hash, w: count>> of a text's words."""
    hashes = F.sort_array(F.transform(words_of(text), lambda w: F.xxhash64(w)))

    def counted(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        runs = lambda at: F.transform(at, lambda i, j: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(s)) - i).alias("w")))
        return let(starts, runs)

    kind = "array<struct<term:bigint,w:int>>"
    return let(hashes, lambda s: F.when(F.size(s) > 0, counted(s)).otherwise(F.expr(f"cast(array() as {kind})")))


def sampled(bags: DataFrame, keys: list[str]) -> DataFrame:
    """keys, part, s0.. : bags (keys, term, w) to the least packed a of AT_ONCE samples for each part of the samples.
    keys holds side and info; info stays with part 0 of side 0 only, to keep the other groups' keys short."""
    parts = bags.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(SAMPLES // AT_ONCE)])))
    parts = parts.withColumn("info", F.when((F.col("part") == 0) & (F.col("side") == 0), F.col("info")))
    own = parts.select(*keys, "part", "term", F.ln(F.col("w").cast("double")).alias("lw"), F.xxhash64("term", "part").alias("h"))
    bits = lambda h, shift: (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 21) - 1)).cast("double") + 0.5) / float(1 << 21)
    own = own.select("*", *[F.xxhash64(F.col("h").bitwiseXOR(F.lit(j + 1).cast("long"))).alias(f"x{j}") for j in range(AT_ONCE)])
    own = own.select("*", *[F.xxhash64(f"x{j}").alias(f"y{j}") for j in range(AT_ONCE)])
    own = own.select(*keys, "part", "term", "lw", *[x for j in range(AT_ONCE) for x in (
        f"x{j}",
        (-F.ln(bits(F.col(f"x{j}"), 0) * bits(F.col(f"x{j}"), 21))).alias(f"r{j}"), bits(F.col(f"x{j}"), 42).alias(f"b{j}"),
        F.ln(-F.ln(bits(F.col(f"y{j}"), 0) * bits(F.col(f"y{j}"), 21))).alias(f"c{j}"))])
    own = own.select(*keys, "part", "term", *[x for j in range(AT_ONCE) for x in (
        f"x{j}", f"r{j}", f"b{j}", f"c{j}", F.floor(F.col("lw") / F.col(f"r{j}") + F.col(f"b{j}")).alias(f"t{j}"))])

    def packed(j: int) -> Column:
        la = F.col(f"c{j}") - F.col(f"r{j}") * (F.col(f"t{j}") - F.col(f"b{j}") + 1)
        high = F.least(F.greatest((la + 96.0) * float(1 << 24), F.lit(0.0)), F.lit(float((1 << 31) - 1))).cast("long")
        return F.shiftleft(high, 32).bitwiseOR(F.xxhash64(F.col(f"x{j}").bitwiseXOR(F.col(f"t{j}"))).bitwiseAND(F.lit((1 << 32) - 1)))

    own = own.select(*keys, "part", *[F.when(F.col("term").isNotNull(), packed(j)).alias(f"s{j}") for j in range(AT_ONCE)])
    return own.groupBy(*keys, "part").agg(*[F.min(f"s{j}").alias(f"s{j}") for j in range(AT_ONCE)])


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, side, info, fp (array of SAMPLES longs, empty for a text without words): texts (keys, info, sides: array of
    strings). info goes with side 0."""
    sides = texts.select(*keys, "info", F.posexplode("sides").alias("side", "t"))
    bags = sides.select(*keys, "side", "info", F.inline_outer(terms(F.col("t"))))
    some = sampled(bags, [*keys, "side", "info"])
    low = [F.col(f"s{j}").bitwiseAND(F.lit((1 << 32) - 1)) for j in range(AT_ONCE)]
    whole = some.groupBy(*keys, "side").agg(F.array_sort(F.collect_list(F.struct("part", F.array(*low).alias("v"), "info"))).alias("parts"))
    return whole.select(*keys, "side", F.get("parts", F.lit(0))["info"].alias("info"), F.filter(F.flatten("parts.v"), lambda x: x.isNotNull()).alias("fp"))


def as_hex(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(same / float(SAMPLES))


#: Ranges of a cut at most; a cut's ranges, or the heavy ones among them, are broadcast (some 60 bytes each).
MAX_CELLS = 500_000


def cells(docs: DataFrame, rows_per_cell: int = 2000, most_cuts: int = 16) -> tuple[DataFrame, list[str], DataFrame]:
    """docs (doc_id, h, ...) with columns at0, at1, ...: ranges of ascending (doc_id, descending h) of bounded size, nulls
    below all; the names of these columns; and one row per range with its number of rows, n.

    The ids are cut into ranges of equal width. Ranges that got many rows all the same are cut again, each between its own
    least and greatest id, until none is left; one of a single id is cut by hashes. So outlying ids, gaps and ids of very
    many rows change the number of cuts, not the size of a range."""
    big = "decimal(20,0)"
    heavy_rows = 4 * rows_per_cell
    ids = docs.select("doc_id", "h")
    names: list[str] = []
    groups = ids.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max(F.col("doc_id").isNull()).alias("none"))

    def cut(rows: DataFrame, ranges: DataFrame, name: str) -> DataFrame:
        """rows of ranges (names, lo, hi, parts) numbered by their place within; other rows get 0."""
        met = rows.join(F.broadcast(ranges), names, "left") if names else rows.join(F.broadcast(ranges))
        # a range of several ids is cut by ids, nulls first; one of a single id by hashes, the greatest first
        span = F.greatest(F.col("hi").cast(big) - F.col("lo").cast(big) + 1, F.lit(1).cast(big))
        by_id = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.floor((F.col("doc_id").cast(big) - F.col("lo").cast(big)) * F.col("parts").cast("decimal(10,0)") / span))
        turned = F.bitwise_not("h").cast("double") / 2.0**64 + 0.5
        by_hash = F.least(F.floor(turned * F.col("parts")), F.col("parts") - 1)
        place = F.when(F.col("parts").isNull(), F.lit(0)).when(F.col("one"), by_hash).otherwise(by_id)
        return met.withColumn(name, place.cast("long")).drop("lo", "hi", "parts", "one")

    # a small table is cut finer, for all tasks to have some
    spread = F.least(F.floor(F.col("n") / 50), F.lit(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    found = groups.select("lo", "hi", F.lit(False).alias("one"), F.greatest(F.lit(1), F.least(F.lit(MAX_CELLS), F.greatest(F.ceil(F.col("n") / rows_per_cell), spread))).alias("parts"))
    per = None
    for i in range(most_cuts):
        name = f"at{i}"
        docs, ids = cut(docs, found, name), cut(ids, found, name)
        names.append(name)
        per = ids.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count_distinct("h").alias("hashes"))
        one = F.col("lo").eqNullSafe(F.col("hi"))
        # rows equal in id and hash are one text again and again: no order parts them
        wide = per.where((F.col("n") > heavy_rows) & (~one | (F.col("hashes") > 1)))
        again = wide.select(*names, "lo", "hi", one.alias("one"), F.ceil(F.col("n") / rows_per_cell).alias("parts"))
        if not again.take(1):
            break
        found = again
    return docs, names, per


def with_next(docs: DataFrame, rows_per_cell: int = 2000) -> tuple[DataFrame, list[str]]:
    """doc_id, text, rn, next_*, next_rn, next_text and the columns of its range: each document with its follower in
    descending doc_id order, the first after the last; and the names of the range's columns. Ranges are sorted apart; a
    range's last document gets the first of the next range. The result stays partitioned by range."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    base, names, _ = cells(base, rows_per_cell)
    by = Window.partitionBy(*names).orderBy(F.col("doc_id").desc_nulls_last(), "h", "text")
    cell = F.struct(*names)
    # one row per range: its first document
    first = F.max(F.struct(F.col("doc_id").isNotNull().alias("a"), "doc_id", F.bitwise_not("h").alias("nh")))
    tops = base.groupBy(*names).agg(first.alias("top")).withColumn("cell", cell)
    down = Window.orderBy(F.desc("cell"))
    tops = tops.withColumn("up", F.coalesce(F.lag("cell").over(down), F.min("cell").over(Window.partitionBy())))
    heads = base.join(F.broadcast(tops), names).where(F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.bitwise_not("h") == F.col("top.nh")))
    heads = heads.groupBy("up").agg(F.min(F.struct("text", "cell")).alias("head"))
    heads = heads.select(*[F.col(f"up.{c}").alias(c) for c in names], F.col("head.text").alias("head"), F.col("head.cell").alias("head_cell"))
    own = base.select("*", F.row_number().over(by).alias("rn"), F.lead("text").over(by).alias("lead")).join(heads, names)
    last = F.col("lead").isNull()
    return own.select(
        "doc_id", "text", *names, "rn", *[F.when(last, F.col(f"head_cell.{c}")).otherwise(F.col(c)).alias(f"next_{c}") for c in names],
        F.when(last, 1).otherwise(F.col("rn") + 1).alias("next_rn"), F.coalesce("lead", "head").alias("next_text"),
    ), names


def edited_pairs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each document."""
    scratch = Scratch(spark, "cws")
    n = F.char_length("text")
    half = F.expr("cast(floor(char_length(text) / 2) as int)")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    docs, names = with_next(docs)
    ahead = [f"next_{c}" for c in names]
    info = F.struct(*ahead, "next_rn", "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    own = docs.withColumn("edited", edited).select(*names, "rn", info.alias("info"), F.array("text", "edited").alias("sides"))
    # grouped by range and more: what a range's task makes is summed there, without an exchange
    fps = scratch.put("fps", fingerprints(own, [*names, "rn"]), codec="none")
    mine = fps.where("side = 0").select(*names, "rn", "info.*", "fp")
    changed = fps.where("side = 1").select(*names, "rn", F.col("fp").alias("efp"))
    following = fps.where("side = 0").select(*[F.col(c).alias(f"next_{c}") for c in names], F.col("rn").alias("next_rn"), F.col("fp").alias("nfp"))
    out = mine.join(changed, [*names, "rn"]).join(following, [*ahead, "next_rn"])
    return out.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"),
    )

"""Quality rules with cross-document line frequency (DataFrame operations only).

Each line with a word is normalised (lower case, white space squeezed) and hashed together with its document's host
(column `source`). Keys found in more than `percent` of 100 of a host's documents, and in more than `floor` of them, are
boilerplate; their lines are taken out, and a document that loses more than `max_lost` of its words to them is rejected as
depleted. The limit goes with the host's documents, so small and large hosts are treated alike.

The scan keeps each row's summary (numbers, line hashes, words and place per line) beside its text. Texts are read once
more, to take the lines out by their places; they are shuffled only if the rows that lose lines are too many to broadcast.

Defined cases: null text has no words, fails the base rules and stays null. A null source is a host of its own. Rows that
share a doc_id, or have none, and repeated rows count as separate documents. Texts of any length are read whole. Other
columns, whatever their names, are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_WS, WS, WS_CHARS, Scratch, by_key, n_words


def words_of(text: Column) -> Column:
    """Words in order, without empty strings at the ends."""
    return F.filter(F.split(text, WS + "+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once per row: an expression named inside a lambda is evaluated for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Each window's hash carries its position in the low bits, so one sort of longs brings equal windows together. Windows
    with a neighbour of the same hash are then compared as words, so hashes decide nothing."""
    n = F.size(words)
    bits = F.ceil(F.log2((n + 1).cast("double"))).cast("int")

    def packed(mask: Column) -> Column:
        wins = F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")),
        )
        return F.sort_array(wins)

    def covered(s: Column, mask: Column) -> Column:
        high = lambda x: x.bitwiseAND(F.bitwise_not(mask))
        hit = F.filter(s, lambda x, i: (high(x) == high(F.coalesce(F.get(s, i + 1), F.bitwise_not(x)))) | ((i > 0) & (high(x) == high(F.get(s, i - 1)))))
        window = lambda p: F.concat_ws(" ", F.get(words, p), F.get(words, p + 1), F.get(words, p + 2))
        named = F.sort_array(F.transform(hit, lambda x: F.struct(window(x.bitwiseAND(mask).cast("int")).alias("w"), x.bitwiseAND(mask).alias("p"))))
        same = lambda a, b: F.coalesce(a["w"] == b["w"], F.lit(False))
        sure = let(named, lambda s: F.filter(s, lambda x, i: same(x, F.get(s, i + 1)) | ((i > 0) & same(x, F.get(s, i - 1)))))
        at = F.sort_array(F.transform(sure, lambda x: x["p"]))
        three = F.lit(3).cast("long")
        gaps = let(at, lambda a: F.transform(a, lambda p, i: F.least(three, F.coalesce(F.get(a, i + 1) - p, three))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    one = F.lit(1).cast("long")
    mask = F.call_function("shiftleft", one, bits) - one
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(mask, lambda m: let(packed(m), lambda s: covered(s, m))))


def summary(docs: DataFrame) -> DataFrame:
    """Per row: rid, doc_id, text, the base numbers and lines (array of key hash, words and place of lines with a word), all from one scan."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_WS))
    own = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", "text", text.alias("t"), words_of(text).alias("words"), lines.alias("ls"))
    norm = lambda x: F.lower(F.regexp_replace(F.btrim(x, F.lit(WS_CHARS)), WS + "+", " "))
    return own.select(
        "rid", "doc_id", F.xxhash64("source").alias("host"), "text", F.size("words").cast("long").alias("n_words"),
        (F.char_length("t") - F.regexp_count("t", F.lit(WS))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.filter(
            F.transform(F.split("t", "\n"), lambda x, i: F.struct(F.xxhash64(F.col("source"), norm(x)).alias("h"), n_words(x).cast("int").alias("w"), i.alias("p"))),
            lambda s: s["w"] > 0,
        ).alias("lines"),
    )


def quality(spark: SparkSession, docs: DataFrame, percent: int = 5, floor: int = 10, max_lost: float = 0.5) -> DataFrame:
    """doc_id, the base numbers, n_lost_words, base_failed, kept and text without its boilerplate lines, one row per row of docs."""
    scratch = Scratch(spark, "quality")
    base = scratch.put("summary", summary(docs))
    keys = base.select("host", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    often = keys.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.first("host").alias("host")).where(F.col("n") > floor)
    hosts = base.groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    common = scratch.put("common", often.join(hosts, "host").where(100 * F.col("n") > percent * F.col("docs")).select("h", "n"), codec="none")
    hits = by_key(base.select("rid", F.inline("lines")), common, ["h"], "n", common.agg(F.sum("n")).first()[0] or 0)
    lost = scratch.put("lost", hits.groupBy("rid").agg(F.collect_list("p").alias("gone")))
    scratch.drop("common")
    left = let(F.split("text", "\n"), lambda ls: F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone")), lambda i: F.get(ls, i)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = base.drop("lines", "host").join(lost, "rid", "left").withColumn("text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    out = out.withColumn("n_lost_words", F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(F.col("n_words") - n_words(F.col("text"))))
    out = out.withColumns({"base_failed": failed, "kept": ~failed & (F.col("n_lost_words") <= max_lost * F.col("n_words"))})
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words", "text")

"""Line deduplication over levelled sorted runs of line hashes (DataFrame operations only).

A LineStore holds what it knows of every line key as sorted runs, bucketed by hash, whose keys are disjoint.
A new batch is aggregated to one row per key and merge-anti-joined with the runs: keys that no run holds become
the batch's own run at level 0; known keys go to a log of repeats. When a level holds `fan_out` runs they are
compacted into one run of the next level. Both sides of the merge joins are bucketed by the same hash, so adding a
batch shuffles that batch's keys only.

Defined cases: null or empty text is one empty line. Rows that share a doc_id are one document; a null doc_id is a
document below all others. Lines equal after trimming and A-Z lower-casing share a key; two keys are held apart by
128 bits of hash. Repeated rows are one document's lines. Texts of any length are read whole. Input columns named n_lines
or n_dropped are replaced; all others stay. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, WS_CHARS, Scratch, ascii_lower, by_key, made_table

KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WS_CHARS)))


def keyed_lines(docs: DataFrame, min_chars: int, n_batches: int) -> DataFrame:
    """One row per line whose key has min_chars code points or more: doc, th (the text's hash), pos, h1, h2, batch."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc"), text.alias("t"))
    lines = base.select("doc", F.xxhash64("t").alias("th"), F.posexplode(F.split("t", "\n")).alias("pos", "line"))
    keys = lines.select("doc", "th", "pos", line_key(F.col("line")).alias("k")).where(F.char_length("k") >= min_chars)
    return keys.select(
        "doc", "th", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(0x5EED), "k").alias("h2"),
        F.pmod(F.xxhash64("doc"), F.lit(n_batches)).cast("int").alias("batch"),
    )


class LineStore:
    """Levelled sorted runs of (h1, h2, n_docs, last_doc). In each table, partition known=false is the run, with keys that
    no other run has; partition known=true logs the batch's repeats of keys that older runs have."""

    def __init__(self, spark: SparkSession, n_lines: int, fan_out: int = 3, per_bucket: int = 500_000):
        """n_lines: lines to come, for the number of buckets."""
        self.spark, self.fan_out = spark, fan_out
        self.levels: list[list[str]] = []
        self.buckets = min(20_000, max(1, n_lines // per_bucket))
        self.tag, self.count = uuid.uuid4().hex[:12], 0

    def _save(self, df: DataFrame) -> str:
        self.count += 1
        name = f"quillwork_lines_{self.tag}_{self.count}"
        made_table(name)
        bucket = F.pmod(F.hash(*KEY), F.lit(self.buckets))  # as bucketBy has it: a bucket is one task's and one file
        out = df.repartition(self.buckets, bucket).sortWithinPartitions("known", *KEY).write.format("parquet").option("compression", "none")
        out.partitionBy("known").bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name

    def drop(self) -> None:
        for name in self.runs():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def _part(self, name: str, known: bool) -> DataFrame:
        return self.spark.table(name).where(F.col("known") == known).select(*KEY, "n_docs", "last_doc")

    def add(self, lines: DataFrame) -> None:
        """lines: doc, h1, h2; a document's lines must come in one batch."""
        own = lines.select("doc", *KEY).distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("last_doc"))
        for i, run in enumerate(self.runs()):
            own = own.join(self._part(run, False).select(*KEY, F.lit(True).alias(f"s{i}")), KEY, "left")
        known = reduce(lambda a, b: a | b, [F.col(f"s{i}").isNotNull() for i in range(len(self.runs()))], F.lit(False))
        self._place(self._save(own.select(*KEY, "n_docs", "last_doc", known.alias("known"))), 0)

    def _place(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_out:
            old, self.levels[level] = self.levels[level], []
            merged = self._union(old, False).withColumn("known", F.lit(False)).unionByName(self._repeats(old).withColumn("known", F.lit(True)))
            name = self._save(merged)
            for x in old:
                self.spark.sql(f"DROP TABLE {x}")
            self._place(name, level + 1)

    def _union(self, names: list[str], known: bool) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._part(x, known) for x in names])

    def _repeats(self, names: list[str]) -> DataFrame:
        return self._union(names, True).groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def totals(self) -> DataFrame:
        """h1, h2, n_docs, last_doc of every key over all batches."""
        again = self._repeats(self.runs()).select(*KEY, F.col("n_docs").alias("more"), F.col("last_doc").alias("last"))
        return self._union(self.runs(), False).join(again, KEY, "left").select(*KEY, (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("last_doc", "last").alias("last_doc"))


def repeated_lines(spark: SparkSession, docs: DataFrame, min_chars: int = 40, min_docs: int = 5, n_batches: int = 4, fan_out: int = 3) -> DataFrame:
    """Per document text (doc, th) the sorted positions of lines to drop: those whose key is in min_docs documents or more, but for the last document that holds it."""
    scratch = Scratch(spark, "lines")
    lines = scratch.put("lines", keyed_lines(docs, min_chars, n_batches), by=("batch",), codec="none")
    store = LineStore(spark, lines.count(), fan_out)
    for b in range(n_batches):
        store.add(lines.where(F.col("batch") == b))
    common = scratch.put("common", store.totals().where(F.col("n_docs") >= min_docs).select(*KEY, "n_docs", "last_doc"), codec="none")
    store.drop()
    hits = by_key(lines, common, KEY, "n_docs", common.agg(F.sum("n_docs")).first()[0] or 0).where(F.col("doc") != F.col("last_doc"))
    drops = scratch.put("drops", hits.groupBy("doc", "th").agg(F.collect_set("pos").alias("drop")))
    scratch.drop("lines", "common")
    return drops


def dedup_lines(spark: SparkSession, docs: DataFrame, min_chars: int = 40, min_docs: int = 5, n_batches: int = 4, fan_out: int = 3) -> DataFrame:
    """docs with their texts cut (column text), and n_lines, n_dropped. All other columns stay as they are."""
    docs = docs.drop("n_lines", "n_dropped")
    drops = repeated_lines(spark, docs, min_chars, min_docs, n_batches, fan_out)
    text = F.coalesce("text", F.lit(""))
    # input columns travel in one struct, so that none can clash with the working ones
    own = docs.select(F.struct("*").alias("row"), F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc"), F.xxhash64(text).alias("th"), F.split(text, "\n").alias("ls"), text.alias("whole"))
    both = own.join(drops.hint("shuffle_hash"), ["doc", "th"], "left")
    n = F.size("ls")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drop"))
    new = F.when(F.col("drop").isNull(), F.col("whole")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("ls"), i)), "\n"))
    columns = [new.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return both.select(*columns, n.cast("long").alias("n_lines"), (n - F.coalesce(F.size(kept), n)).cast("long").alias("n_dropped"))

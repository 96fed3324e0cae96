"""A training-data pipeline over documents: language identification, line deduplication, near-duplicate removal, mixing
to target weights, packing. Each stage takes what its predecessor kept and is written before the next one reads it.

Every stage takes nulls in any column, empty and very long texts, ties, repeated rows and an empty table, and keeps columns
of any other name as they are; what it does with them is said at the stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.llm import langid, linededup, mixing, packing, setsketch
from quillwork.llm.common import Scratch, documents

#: Language identification trains a model and packing runs a tokenizer; SQL has neither.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters go (null and empty ones too), and those for which no language is more likely than all others
    together. Each row is judged by itself, so repeated rows and rows without an id fare alike. Without labels all go."""
    model = langid.train(spark, docs.select("doc_id", "text", "lang"))
    found = langid.identify(spark, docs, model)
    return found.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= 0.5)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more that five documents share stay in the last of them only. No row goes; null text
    becomes empty. Rows that share a doc_id are one document, rows without one are one below all others."""
    cut = linededup.dedup_lines(spark, docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8.

    Rows are told apart by a number of their own, so rows that share a doc_id, or have none, are separate texts: a row goes
    only if its own text is a near copy. Of a group the row with the least doc_id stays (one with an id before one without)."""
    scratch = Scratch(spark, "near-rows")
    rows = scratch.put("rows", docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")))
    found = setsketch.near_duplicates(spark, rows.select(F.col("number").alias("doc_id"), "row.text"), k=5, percent=80)
    found = found.select(F.col("doc_id").alias("number"), F.col("component_id").alias("group"))
    doc_id = F.col("row.doc_id")
    first = F.min_by("number", F.struct(doc_id.isNull(), doc_id, "number")).alias("number")
    kept = rows.select("number", "row").join(found, "number").groupBy("group").agg(first)
    left = rows.join(kept.select("number").hint("shuffle_hash"), "number", "left_semi")
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those taken 0 times go, among them texts without words. A null source is
    a source. Rows that share a doc_id are rounded apart; those with the same source and text too get their copies dealt
    over them."""
    return mixing.apply_mix(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences. Null or empty text is its end id alone; rows that share a doc_id are packed apart; a null
    doc_id stays null."""
    return packing.pack_documents(spark, docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mix_sources), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = documents(spark, sf_dir), Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.put(f"{k}-{name}", stage(spark, docs, sf_dir))
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs

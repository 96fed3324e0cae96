"""The registered queries opN_<name>: each applies its operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cws, divergence, htmltext, langid, licenses, linededup, mixing, packing, quality, search, setsketch, suffixdedup, tokenfile
from .common import documents


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(spark, docs.where(~langid.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    out = langid.identify(spark, docs.select("doc_id", "text"), model)
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(spark, documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, documents(spark, sf_dir).select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(spark, documents(spark, sf_dir).select("doc_id", "text"), k=3, percent=85)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spark, documents(spark, sf_dir).select("doc_id", "source", "text")).drop("text")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixdedup.dedup_suffixes(spark, documents(spark, sf_dir).select("doc_id", "text"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passage_words")


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_table(spark, documents(spark, sf_dir).select("doc_id", "text"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.edited_pairs(spark, documents(spark, sf_dir).select("doc_id", "text"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, documents(spark, sf_dir).select("doc_id", "text"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, documents(spark, sf_dir).select("lang", "source", "text"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(spark, documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir).select("doc_id", "text")).drop("found")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_token_file": op4_token_file,
    "op5_html_text": op5_html_text,
    "op6_mixing": op6_mixing,
    "op7_near_dedup": op7_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_fingerprints": op9_fingerprints,
    "op10_packing": op10_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_lexical_search": op12_lexical_search,
    "op13_license_scan": op13_license_scan,
}

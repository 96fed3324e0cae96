"""Table readers and small helpers for the registered queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(c: str = "ts"):
    """Microseconds of a timestamp without time zone."""
    return F.unix_micros(F.col(c).cast("timestamp"))


#: DuckDB's form of the same.
MICROS = "epoch_us(ts)"


def made(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Rows of a SQL text that Spark and DuckDB read alike; {name} stands for a table."""
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in set(re.findall(r"\{(\w+)\}", text))})


def duck(**inputs: str) -> str:
    """WITH ... of made() texts for DuckDB, by name."""
    return "WITH " + ", ".join(f"{name} AS ({re.sub(r'{(\w+)}', r'\1', text)})" for name, text in inputs.items())


def values(items: list[str]) -> str:
    """VALUES of numbered texts."""
    return ", ".join(f"({i}, '{x}')" for i, x in enumerate(items))

"""Shared helpers: the cluster's shared folder, scratch tables, and text rules."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WS = r"[\x20\x09-\x0D]"
NOT_WS = r"[^\x20\x09-\x0D]"
WS_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Stands in for a null doc_id where an order or a key is needed.
NO_ID = -(2**63)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. Where it is unset, one temporary folder
    if driver and executors are one machine (a local master), else an error: a machine-local folder would lose rows."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='quillwork-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Folders and tables made by this process, for sweep().
_MADE: list[tuple[str, str]] = []


#: Spark's setting that deletes an execution's shuffle files at its end.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Parquet tables in the shared folder. They cut lineage and outlive lost executors. Operators drop those that their
    result does not read; sweep() deletes the others when results are no longer needed. tidy: the shuffle files of a
    table's making go when it is written; else they stay until the driver happens to collect its garbage."""

    def __init__(self, spark: SparkSession, tag: str, tidy: bool = False):
        self.spark, self.root, self.tidy = spark, f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}", tidy
        _MADE.append(("folder", self.root))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, name: str, df: DataFrame, by: tuple[str, ...] = (), codec: str = "snappy") -> DataFrame:
        """Writes df, which runs it once, and returns the table. by: partition columns. codec: "none" suits hashes."""
        out = df.write.mode("overwrite").option("compression", codec)
        before = self.spark.conf.get(TIDY, "false")
        try:
            if self.tidy:
                self.spark.conf.set(TIDY, "true")
            (out.partitionBy(*by) if by else out).parquet(self.path(name))
        finally:
            if self.tidy:
                self.spark.conf.set(TIDY, before)
        return self.get(name, df)

    def get(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.path(name))


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def made_table(name: str) -> None:
    _MADE.append(("table", name))


def sweep(spark: SparkSession) -> None:
    """Deletes what operators of this process have left in the shared folder and the warehouse. Results that were not
    written elsewhere can no longer be read."""
    for kind, name in _MADE:
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            delete(spark, name)
    _MADE.clear()


#: Keys that a join of rows by key broadcasts at most.
HEAVY_KEYS = 4000


def by_key(rows: DataFrame, per_key: DataFrame, keys: list[str], n: str, total: int, hint: str | None = None) -> DataFrame:
    """rows joined with per_key, which has one row per key, n of them the rows that have the key, and total all rows or
    more. Keys of more than total / HEAVY_KEYS rows are HEAVY_KEYS at most: they are broadcast and their rows stay where
    they are, so that no task gets all rows of a hot key. All others meet by a shuffle. Both inputs are read twice, so
    they should be tables."""
    heavy = per_key.where(F.col(n) > max(1000, total // HEAVY_KEYS))
    light = per_key.where(F.col(n) <= max(1000, total // HEAVY_KEYS))
    few = rows.join(F.broadcast(heavy), keys)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return few.unionByName(rest.join(light.hint(hint) if hint else light, keys))


#: Bits of a bitmap of Spark's bitmap functions.
BITMAP = 1 << 15


def may_meet(rows: DataFrame, others: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The rows whose keys others has, and about one in nine of those whose keys it has not, which a join drops. others has
    n rows; a bitmap of a byte for each is broadcast, so that a join need not shuffle rows that meet nothing."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(BITMAP * (1 + 8 * n // BITMAP)))
    slot, place = F.floor(bit / BITMAP).alias("_slot"), (bit % BITMAP).alias("_place")
    maps = others.select(slot, place).repartition("_slot").groupBy("_slot").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    here = F.conv(F.hex(F.substring("_bits", F.expr("int(_place div 8) + 1"), F.lit(1))), 16, 10).cast("int")
    found = rows.select("*", slot, place).join(F.broadcast(maps), "_slot").select("*", here.alias("_here"))
    return found.where("shiftright(_here, int(_place % 8)) % 2 = 1").drop("_slot", "_place", "_bits", "_here")


#: What Python workers keep between tasks, by operator.
_KEPT: dict[str, Callable] = {}


def kept(name: str, cached: Callable) -> Callable:
    """Registers an lru_cache function that workers keep between an operator's tasks."""
    _KEPT[name] = cached
    return cached


def keep_only(name: str) -> None:
    """Frees what other operators' tasks have left in this worker."""
    for other, cached in _KEPT.items():
        if other != name:
            cached.cache_clear()


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased and nothing else; pure ASCII strings take the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def n_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(NOT_WS + "+")).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def unhex64(n: int) -> int:
    """n modulo 2^64 as a signed 64-bit value."""
    n &= (1 << 64) - 1
    return n - (1 << 64) if n >> 63 else n

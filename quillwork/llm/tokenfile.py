"""Token ids as files of Simple-8b words, in ascending doc_id order, and their reader.

File format: a folder of Parquet files. A row is a chunk of whole documents that follow each other:
part (files in id order), chunk (within its part), local_start (ids of the part before it), doc_ids, doc_lens (ids of
each document with its end id), n_ids, offsets (first word of each block of 1,024 ids), words (little-endian).
An id's place in the whole is the sum of the parts before it, local_start and its place in the chunk. Spark commits
the files of a task as a whole, so a lost executor leaves no half-written part.

Defined cases: null text is empty and has the end id alone. Rows that share a doc_id follow each other in the order of
their text hashes; null doc_ids come first; repeated rows stay. A very long text is one chunk. Other columns, whatever their
names, are left out. An empty table gives a folder without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b
from .common import Scratch
from .tokens import default_path, encoded, encoder, read_model

CHUNK = "part int, chunk int, local_start long, doc_ids array<long>, doc_lens array<long>, n_ids long, offsets array<long>, words binary"


def _chunk(part: int, k: int, start: int, ids: list, parts: list[bytes]) -> pa.RecordBatch:
    values = np.frombuffer(b"".join(parts), "<u4").astype(np.uint64)
    words, offsets = simple8b.encode(values)
    lens = [len(x) // 4 for x in parts]
    row = {"part": part, "chunk": k, "local_start": start, "doc_ids": ids, "doc_lens": lens, "n_ids": len(values), "offsets": offsets.tolist(), "words": words.astype("<u8").tobytes()}
    types = {"part": pa.int32(), "chunk": pa.int32(), "doc_ids": pa.list_(pa.int64()), "doc_lens": pa.list_(pa.int64()), "offsets": pa.list_(pa.int64()), "words": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], types.get(c, pa.int64())) for c, v in row.items()], names=list(row))


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str | None = None, chunk_ids: int = 250_000) -> None:
    """Writes docs (doc_id, text) to the folder at path."""
    model = spark.sparkContext.broadcast(read_model(tokenizer or default_path()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(model.value), TaskContext.get().partitionId()
        ids, parts, size, k, start = [], [], 0, 0, 0
        for batch in batches:
            for doc, own in encoded(batch, enc):
                ids.append(doc)
                parts.append(own)
                size += len(own) // 4
                if size >= chunk_ids:
                    yield _chunk(part, k, start, ids, parts)
                    start += size
                    k, ids, parts, size = k + 1, [], [], 0
        if parts:
            yield _chunk(part, k, start, ids, parts)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(work, CHUNK).write.mode("overwrite").option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, decoded from the folder at path."""
    chunks = spark.read.schema(CHUNK).parquet(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), row["n_ids"], np.array(row["offsets"])).astype("<u4")
                ends = np.cumsum(row["doc_lens"])
                starts = ends - np.array(row["doc_lens"])
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["local_start"], pa.int64()), pa.array(row["doc_lens"], pa.int64()), pa.array(crc, pa.int64())],
                    names=["part", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    # one row per part: a running sum of as many rows as the writer had tasks
    sums = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sums.select("part", before.alias("base"))
    docs = chunks.mapInArrow(work, "part int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return docs.join(bases, "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_table(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    path = Scratch(spark, "tokens").path("ids")
    write_tokens(spark, docs, path, tokenizer)
    return read_tokens(spark, path)

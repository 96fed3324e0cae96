"""Ranked lexical search: windowed bucket scoring.

Documents are cut into words by bytes (bytewords); each gets its length and, for the terms of the queries, its frequencies.
That table is dealt by doc_id in ranges. A task goes through its range in windows of `window` documents: the window's
frequencies are turned into postings (by term, slots ascending) with their impacts, each query adds its terms' postings to
an array of one number per slot, the terms' bit sets joined say which slots to harvest, and these enter the query's heap of
the k best. What is left of every range, k rows a query, is ranked at the end.

Queries are taken in blocks of about `block` bytes of text, so what goes to the tasks is bounded; the documents are read once
per block. All but a term's weight is in whole numbers.

Defined cases: null or empty text of a document has no term and is never found; null text of an item finds nothing. Rows
that share a doc_id, or have none, are documents of their own (equal scores: by doc_id, rows without one last); items that
share an item_id are queries of their own under that id. Fewer than k matches give fewer rows, an empty table none. Texts of
any length are read whole. Other columns, whatever their names, are left out.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytewords
from .common import UPPER, Scratch, keep_only

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TO_LOWER = str.maketrans(UPPER, UPPER.lower())
FREQUENCIES = "doc_id long, row long, n long, terms array<int>, tfs array<int>"
BEST = "query int, doc_id long, row long, score long"


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(TO_LOWER))


class Vocabulary:
    """Numbers of the queries' terms, found by xxHash64 and confirmed by bytes."""

    def __init__(self, terms: list[str]):
        self.slices = bytewords.cut(pa.array(terms, pa.large_string()), bytewords.LETTERS_DIGITS)
        self.seed = 0
        while len(np.unique(keys := bytewords.hashes(self.slices, self.seed))) < len(terms):
            self.seed += 1  # two terms of the vocabulary with one hash
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def numbers(self, s: bytewords.Slices) -> np.ndarray:
        """The term's number per slice, -1 where it is none."""
        found = np.full(len(s.starts), -1, np.int64)
        if len(self.keys):
            keys = bytewords.hashes(s, self.seed)
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            at = np.flatnonzero(self.keys[place] == keys)
            term = self.order[place[at]]
            sure = bytewords.same_bytes(s, at, self.slices, term)
            found[at[sure]] = term[sure]
        return found


def _frequencies(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("")
        words = Vocabulary(terms)
        for batch in batches:
            for at, to in bytewords.portions(batch.column(2)):
                rows = to - at
                n, hits = np.zeros(rows, np.int64), []
                for piece in bytewords.pieces(batch.column(2).slice(at, rows), bytewords.LETTERS_DIGITS):
                    s = bytewords.cut(piece, bytewords.LETTERS_DIGITS)
                    number = words.numbers(s)
                    n += np.bincount(s.rows, minlength=rows)
                    hit = number >= 0
                    hits.append(s.rows[hit] * max(1, len(terms)) + number[hit])
                keys, tfs = np.unique(np.concatenate(hits), return_counts=True)
                row, term = np.divmod(keys, max(1, len(terms)))
                ends = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, tfs)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, rows), batch.column(1).slice(at, rows), pa.array(n), *lists], names=["doc_id", "row", "n", "terms", "tfs"])

    return run


def _document_counts(n_terms: int):
    """Documents that hold each term, one row per term that a task met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_terms, np.int64)
        for batch in batches:
            seen += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["term", "df"])

    return run


class Scorer:
    """The queries with their weights, and a heap of the k best documents for each."""

    def __init__(self, queries: list[list[tuple[int, int]]], n_terms: int, n_docs: int, n_words: int, k: int, window: int):
        """queries: per query its (term, weight times repeats); n_docs and n_words: N and L."""
        self.queries = [(np.array([t for t, _ in q], np.int64), [w for _, w in q]) for q in queries]
        self.n_terms, self.n_docs, self.n_words, self.k = n_terms, n_docs, n_words, k
        self.scores = np.zeros(window, np.int64)
        #: (score, minus the place in the order of all documents, doc_id, row), the worst first.
        self.heaps: list[list[tuple[int, int, int | None, int]]] = [[] for _ in queries]
        self.before = 0

    def score(self, docs: pa.Table) -> None:
        """One window: at most as many documents as there are slots."""
        n = docs.column("n").to_numpy()
        lists = docs.column("terms").combine_chunks()
        term = lists.flatten().to_numpy(zero_copy_only=False)
        tf = docs.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        slot = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy(zero_copy_only=False))
        norm = 75 + (25 * n * self.n_docs) // self.n_words
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * norm[slot])
        order = np.argsort(term, kind="stable")
        slot, impact, ptr = slot[order], impact[order], np.searchsorted(term[order], np.arange(self.n_terms + 1))
        bits = np.zeros((self.n_terms, (len(n) + 7) // 8), np.uint8)
        np.bitwise_or.at(bits, (term[order], slot >> 3), np.uint8(128) >> (slot & 7).astype(np.uint8))
        ids, rows = docs.column("doc_id").to_pylist(), docs.column("row").to_numpy()
        for heap, (terms, weights) in zip(self.heaps, self.queries, strict=True):
            for t, w in zip(terms.tolist(), weights, strict=True):
                to = slice(ptr[t], ptr[t + 1])
                self.scores[slot[to]] += w * impact[to]
            held = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bits[terms], axis=0), count=len(n)))
            got = self.scores[held]
            self.scores[held] = 0
            least = heap[0][0] if len(heap) == self.k else 0
            good = np.flatnonzero(got > least)
            if len(good) > self.k:
                cut = np.partition(got[good], len(good) - self.k)[len(good) - self.k]
                above, level = good[got[good] > cut], good[got[good] == cut]
                good = np.sort(np.concatenate([above, level[: self.k - len(above)]]))
            for i in good.tolist():
                at = int(held[i])
                entry = (int(got[i]), -(self.before + at), ids[at], int(rows[at]))
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry[:2] > heap[0][:2]:
                    heapq.heapreplace(heap, entry)
        self.before += len(n)


def _best(queries: list[list[tuple[int, int]]], n_terms: int, n_docs: int, n_words: int, k: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(queries, n_terms, n_docs, n_words, k, window)
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = window - sum(b.num_rows for b in waiting)
                waiting.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in waiting) == window:
                    scorer.score(pa.Table.from_batches(waiting))
                    waiting = []
        if waiting:
            scorer.score(pa.Table.from_batches(waiting))
        out = [(q, doc, row, score) for q, heap in enumerate(scorer.heaps) for score, _, doc, row in heap]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for at in range(0, len(out), 10_000):
            columns = zip(*out[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query", "doc_id", "row", "score"])

    return run


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 20, window: int = 8192, block: int = 500_000) -> DataFrame:
    """item_id, rank, doc_id, score: the k best of docs (doc_id, text) for each row of items (item_id, text)."""
    scratch = Scratch(spark, "search")
    texts = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("item"))
    texts = scratch.put("items", texts)
    n_blocks = max(1, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block))
    out = None
    for b in range(n_blocks):
        asked = texts.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == b).orderBy("item").collect()
        found = _one_block(scratch, b, docs, [r["text"] for r in asked], k, window)
        number = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(asked)], spark_schema(items))
        found = found.join(F.broadcast(number), "query").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out


def spark_schema(items: DataFrame) -> str:
    return f"query int, item_id {items.schema['item_id'].dataType.simpleString()}"


def _one_block(scratch: Scratch, b: int, docs: DataFrame, texts: list[str], k: int, window: int) -> DataFrame:
    asked = [Counter(terms_of(t)) for t in texts]
    terms = sorted(set().union(*asked))
    number = {t: i for i, t in enumerate(terms)}
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    held = scratch.put(f"frequencies-{b}", own.mapInArrow(_frequencies(terms), FREQUENCIES).where("n > 0"))
    n_docs, n_words = held.agg(F.count(F.lit(1)), F.sum("n")).first()
    counts = held.select("terms").mapInArrow(_document_counts(len(terms)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = {r["term"]: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1))) for r in counts.collect()}
    queries = [[(number[t], weight[number[t]] * repeats) for t, repeats in sorted(q.items()) if number[t] in weight] for q in asked]
    dealt = held.repartitionByRange(F.col("doc_id").asc_nulls_last(), "row").sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "row")
    best = dealt.mapInArrow(_best(queries, len(terms), n_docs, n_words or 1, k, window), BEST)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)

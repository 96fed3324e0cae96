"""Source divergence audit: how far each source's words stray from the other sources of its language, and which words do it.

Tasks read texts by bytes (bytewords): a lookup table finds the words, xxHash64 groups equal ones and bytes confirm it, so
a portion of texts gives one row per language, source and term. Spark adds them up and keeps the terms that occur in
`min_docs` documents of a language. All probabilities are whole billionths, p = 1 + floor(10^9 (count + a) / (N + a V)),
so every figure is exact.

The distance of two sources is the sum of |p - q| over all kept terms. A source that lacks a term has its floor p0 there, so
the sum is V |p0 - q0| plus what the terms of either source change. Sources are taken in blocks of `block` and terms in
chunks: each task has the rows of two blocks and of one chunk as sparse rows (CSR) and adds the differences per row with
reduceat, so no task gets a whole language or source.

Defined cases: null text, lang and source are ''. Rows that share a doc_id, or have none, count as separate documents. A
source without kept terms has the floor everywhere; a language without kept terms has distances of 0 and no terms. Texts of
any length are read whole. Other columns, whatever their names, are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytewords
from .common import Scratch, by_key, keep_only

PARTS = "lang string, source string, term string, n long, docs long"


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of a portion of texts: row, number of the term and occurrences, one entry per row and term; and the terms."""
    found = None
    for piece in bytewords.pieces(column, bytewords.LETTERS):
        s = bytewords.cut(piece, bytewords.LETTERS)
        number, first = bytewords.grouped(s, bytewords.hashes(s))
        entries, n = np.unique(s.rows * len(first) + number, return_counts=True)
        row, term = np.divmod(entries, max(1, len(first)))
        terms = s.strings(first)
        if found:  # the text's earlier pieces
            both = pa.chunked_array([found[3], terms.take(pa.array(term))]).combine_chunks().dictionary_encode()
            n = np.bincount(both.indices.to_numpy(), np.concatenate([found[2], n])).astype(np.int64)
            row, term, terms = np.zeros(len(n), np.int64), np.arange(len(n)), both.dictionary
        found = row, term, n, terms
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per lang, source and term of each portion: occurrences and documents."""
    keep_only("")
    for batch in batches:
        for at, to in bytewords.portions(batch.column(2)):
            row, term, n, terms = _words(batch.column(2).slice(at, to - at))
            if not len(row):
                continue
            codes = [c.slice(at, to - at).dictionary_encode() for c in (batch.column(0), batch.column(1))]
            langs, sources = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in codes)
            n_sources, n_terms = len(codes[1].dictionary), len(terms)
            group, which = np.unique((langs * n_sources + sources)[row] * n_terms + term, return_inverse=True)
            counts = np.zeros(len(group), np.int64)
            np.add.at(counts, which, n)
            pair, term = np.divmod(group, n_terms)
            lang, source = np.divmod(pair, n_sources)
            columns = [codes[0].dictionary.take(pa.array(lang)), codes[1].dictionary.take(pa.array(source)), terms.take(pa.array(term))]
            columns = [c.cast(pa.string()) for c in columns] + [pa.array(counts), pa.array(np.bincount(which, minlength=len(group)))]
            for k in range(0, len(group), 100_000):
                yield pa.RecordBatch.from_arrays([c.slice(k, 100_000) for c in columns], names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, min_docs: int = 30) -> DataFrame:
    """lang, source, term, n, lang_n: occurrences in the source and in the language, of terms that min_docs documents of the
    language have. docs: lang, source, text."""
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    own = docs.select(*blank).mapInArrow(_count, PARTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    both = own.withColumns({"lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term)})
    return both.where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n")


def billionths(n: str, total: str, terms: str, add: int):
    """1 + floor(10^9 (n + add) / (total + add terms)), exact; 0 where there are no terms."""
    exact = f"cast(1000000000 as decimal(12,0)) * cast({n} + {add} as decimal(20,0)) div cast({total} + {add} * {terms} as decimal(22,0))"
    return F.expr(f"if({terms} = 0, 0L, 1L + ({exact}))")


def group_totals(docs: DataFrame, kept: DataFrame, add: int) -> DataFrame:
    """Per lang and source that occur: total, lang_total, n_terms (V), n_rows (kept rows), floor, sid (number in its language)."""
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_rows"))
    langs = kept.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("n_terms"))
    every = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "n_rows", "lang_total", "n_terms"])
    sid = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int")
    return every.withColumns({"floor": billionths("0L", "total", "n_terms", add), "sid": sid})


def pair_sums(rows: np.ndarray, cols: np.ndarray, data: np.ndarray, floors: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each row a in left: a and, per row b in right, the sum over the terms of either of |a - b| - |floor a - floor b|.

    rows, cols, data: entries, sorted by row; floors: per row what it has elsewhere. All in whole numbers."""
    n_cols = int(cols.max()) + 1 if len(cols) else 0
    ptr = np.searchsorted(rows, np.arange(len(floors) + 1))
    used = right[ptr[right + 1] > ptr[right]]
    entry = np.concatenate([np.arange(ptr[b], ptr[b + 1]) for b in used]) if len(used) else np.zeros(0, np.int64)
    b_col, b_data, b_floor = cols[entry], data[entry], floors[rows[entry]]
    sizes = ptr[used + 1] - ptr[used]
    heads = np.cumsum(sizes) - sizes
    place = np.searchsorted(right, used)
    for a in left.tolist():
        mine = slice(ptr[a], ptr[a + 1])
        dense, has = np.full(n_cols, floors[a], np.int64), np.zeros(n_cols, bool)
        dense[cols[mine]], has[cols[mine]] = data[mine], True
        gap = np.abs(floors[right] - floors[a])
        # over the terms of a, as if b had none of them
        ordered = np.sort(data[mine])
        below = np.concatenate([[0], np.cumsum(ordered)])
        k = np.searchsorted(ordered, floors[right])
        out = floors[right] * (2 * k - len(ordered)) + below[-1] - 2 * below[k] - gap * len(ordered)
        if len(used):
            # over the terms of b; what was added above for those that both have is taken back
            here = dense[b_col]
            change = np.abs(here - b_data) - np.where(has[b_col], np.abs(here - b_floor), np.abs(floors[a] - b_floor))
            out[place] += np.add.reduceat(change, heads)
        yield a, out


def _pairs(table: pa.Table) -> pa.Table:
    """One chunk of terms and two blocks of sources. Rows without a term say which sources there are."""
    col = {name: table.column(name).combine_chunks() for name in ("sid", "term", "p", "lang", "one", "two", "block")}
    sid, p, block, marks = (x.to_numpy(zero_copy_only=False) for x in (col["sid"], col["p"], col["block"], col["term"].is_null()))
    ids, first = np.unique(sid[marks], return_index=True)
    floors, blocks = p[marks][first].astype(np.int64), block[marks][first]
    terms = col["term"].filter(pa.array(~marks)).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    rows, data = np.searchsorted(ids, sid[~marks]), p[~marks].astype(np.int64)
    order = np.argsort(rows, kind="stable")
    one, two = col["one"][0].as_py(), col["two"][0].as_py()
    left, right = np.flatnonzero(blocks == one), np.flatnonzero(blocks == two)
    a, b, diff = [], [], []
    for i, sums in pair_sums(rows[order], terms[order], data[order], floors, left, right):
        later = right > i
        a.append(np.full(int(later.sum()), ids[i]))
        b.append(ids[right[later]])
        diff.append(sums[later])
    a, b, diff = (np.concatenate(x) if x else np.zeros(0) for x in (a, b, diff))
    lang = pa.array([col["lang"][0].as_py()] * len(a), pa.string())
    return pa.Table.from_arrays([lang, pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(diff, pa.int64())], names=["lang", "a", "b", "diff"])


def audit(spark: SparkSession, docs: DataFrame, min_docs: int = 30, add: int = 5, top: int = 50, block: int = 128, chunk: int = 2048) -> DataFrame:
    """lang, source, part, item, value, rank. pair: item is each other source of the language, value their distance; term:
    the `top` terms in which the source exceeds its language, value by how much. Distances are the size of the result: one
    row per ordered pair of sources of a language."""
    scratch = Scratch(spark, "divergence")
    kept = scratch.put("kept", term_counts(docs, min_docs))
    groups = scratch.put("groups", group_totals(docs, kept, add))
    most, sources, n_rows = groups.agg(F.max("n_terms"), F.max("sid"), F.sum("n_rows")).first()
    n_chunks, n_blocks = max(1, -(-(most or 0) // chunk)), (sources or 0) // block + 1

    rows = by_key(kept, groups.where("n_rows > 0"), ["lang", "source"], "n_rows", n_rows or 0)
    rows = rows.select("lang", "source", "sid", "term", "n", billionths("n", "total", "n_terms", add).alias("p"), billionths("lang_n", "lang_total", "n_terms", add).alias("q"))

    own = (F.col("sid") / block).cast("int").alias("block")
    terms = rows.select("lang", "sid", own, "term", "p", F.pmod(F.xxhash64("term"), F.lit(n_chunks)).cast("int").alias("chunk"))
    marks = groups.select("lang", "sid", own, F.lit(None).cast("string").alias("term"), F.col("floor").alias("p"), F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"))
    met = terms.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    met = met.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")})
    sums = met.groupBy("lang", "chunk", "one", "two").applyInArrow(_pairs, "lang string, a int, b int, diff long").groupBy("lang", "a", "b").agg(F.sum("diff").alias("diff"))
    sums = sums.select("lang", F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))), "diff")
    name = lambda c, k: groups.select("lang", F.col("sid").alias(c), F.col("source").alias(f"source{k}"), F.col("floor").alias(f"floor{k}"))
    pairs = sums.join(name("a", 1).join(groups.select("lang", "n_terms").distinct(), "lang"), ["lang", "a"]).join(name("b", 2), ["lang", "b"])
    value = (F.col("n_terms") * F.abs(F.col("floor1") - F.col("floor2")) + F.col("diff")).alias("value")
    pairs = pairs.select("lang", F.col("source1").alias("source"), F.lit("pair").alias("part"), F.col("source2").alias("item"), value)

    over = rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(over.select("*", rank).where(F.col("rank") <= top))

"""Near-duplicate detection on word shingles with SetSketch registers.

Register i of a set is the largest floor(1 - log_B(h_i(x))) over its elements x, h_i(x) exponentially distributed: an
exponentially spaced, truncated minimum. Registers of a union are the maxima of registers. Two sets agree in a register
with about their Jaccard similarity, so bands of registers collide for similar sets; the counts of larger, smaller and
equal registers give a likelihood estimate of the similarity; pairs that may reach the threshold are confirmed on
their full sets.

1. One pass sketches every text. Rows with equal sets are one class; all further work is on classes.
2. Bands of classes are counted by key with map-side sums; no bucket is gathered. Each member of a bucket is compared
   with two of its members: the first, and the one with most company over all bands (the text that others were made
   from, if it is there). A group of n copies costs n comparisons a band, not n squared.
3. Links join classes to components. Pairs inside a component need no check. Buckets of three or more that still hold
   several components form groups by shared members; in each, those outside the largest component are held, in slices
   of bounded size, and compared on full sets with all others, which stream by. So no link between classes that share a
   bucket is lost, and only links that join components leave a task.
The number of bands is such that a pair at the threshold shares no bucket with probability `miss` at most.

Defined cases: null, empty or white text has no set, is linked with nothing and is its own component. Fewer words than a
shingle: the whole sequence is one. Rows that share a doc_id, or have none, are separate texts: texts are found again by
their hashes, not by ids, so they lose no link. A null doc_id comes after all others: a component's id is its least
doc_id, null only if none of its rows has one. Ties and repeated rows have one component. Texts of any length are read
whole. Other columns, whatever their names, are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, by_key, keep_only, kept
from .components import components

U = np.uint64
BASE, TOP = 1.001, 65_534
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_WS = np.zeros(256, bool)
_IS_WS[[9, 10, 11, 12, 13, 32]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    b = 0x9E3779B97F4A7C15
    up, down = np.full(n, U(b)), np.full(n, U(pow(b, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


kept("sets", _powers)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of data."""
    a = np.frombuffer(data, np.uint8)
    word = ~_IS_WS[a]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(1 << max(16, (len(a) + 1).bit_length()))
    total = np.concatenate([np.zeros(1, U), np.cumsum((a.astype(U) + U(1)) * up[: len(a)], dtype=U)])
    return starts, mix64((total[ends] - total[starts]) * down[starts])


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes."""
    raw = [(t or "").encode().translate(_LOWER) for t in texts]
    starts, words = word_hashes(b"\n".join(raw))
    bounds = np.searchsorted(starts, np.cumsum([0] + [len(r) + 1 for r in raw]))
    x = words
    for j in range(1, k):
        x = (x[:-1] if len(x) else x) * U(0xD6E8FEB86659FD93) + words[j:]
    x = mix64(x)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            s = np.sort(x[a : b - k + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            h = np.array([b - a], U)
            for w in words[a:b]:
                h = mix64(h * U(0xD6E8FEB86659FD93) + w)
            out.append(h)
        else:
            out.append(np.zeros(0, U))
    return out


def batches_of(texts: list[str | None], most: int = 500_000) -> Iterator[tuple[int, list[str | None]]]:
    """Portions of texts of bounded size, each with its first index; a very long text is one by itself."""
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and size + n > most:
            yield at, texts[at:i]
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, texts[at:]


class Sketcher:
    def __init__(self, m: int, seed: int = 11):
        r = np.random.default_rng(seed)
        self.salt, self.mul = r.integers(0, 2**63, m, dtype=U), r.integers(0, 2**63, m, dtype=U) * U(2) + U(1)

    def registers(self, s: np.ndarray, step: int = 4096) -> np.ndarray:
        low = np.full(len(self.mul), np.iinfo(U).max)
        for at in range(0, len(s), step):
            low = np.minimum(low, ((s[at : at + step, None] ^ self.salt) * self.mul).min(axis=0))
        v = -np.log1p(-(low.astype(float) + 1) / 2.0**64 * (1 - 1e-16))
        return np.clip(np.floor(1 - np.log(v) / math.log(BASE)), 0, TOP).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def plan(t: float, rows: int = 4, miss: float = 1e-6) -> tuple[int, int]:
    """Registers and bands for threshold t."""
    bands = math.ceil(math.log(miss) / math.log(1 - t**rows))
    return bands * rows, bands


def likely(na: np.ndarray, nb: np.ndarray, ra: np.ndarray, rb: np.ndarray, t: float, slack: float = 5.0) -> np.ndarray:
    """Whether the likelihood estimate of each pair's similarity is no more than `slack` deviations below t.
    na, nb: set sizes; ra, rb: registers (pairs x m)."""
    m = ra.shape[1]
    more, less = (ra > rb).sum(1), (ra < rb).sum(1)
    same = m - more - less
    u = na / (na + nb)
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)
    best, found = np.full(len(na), -np.inf), np.zeros(len(na))
    for j in np.linspace(0, 1, 101):
        ok = j <= np.minimum(u / v, v / u)
        a, b = p(u - v * j), p(v - u * j)
        like = np.where(ok, more * np.log(a) + less * np.log(b) + same * np.log(np.clip(1 - a - b, 1e-12, 1)), -np.inf)
        better = like > best
        best, found = np.where(better, like, best), np.where(better, j, found)
    return found >= t - slack * math.sqrt(t * (1 - t) / m)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def set_id(s: np.ndarray) -> int:
    """64 bits that stand for a set: the same set, the same bits."""
    return int(mix64(np.array([mix64(s ^ U(0xA0761D6478BD642F)).sum(dtype=U) ^ (U(len(s)) << U(40))]))[0].astype(np.int64))


def _sketch(docs: DataFrame, k: int, m: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("sets")
        sketcher = Sketcher(m)
        for batch in batches:
            ids, hashes, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            for at, some in batches_of(texts):
                sets = shingle_sets(some, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, len(some)), hashes.slice(at, len(some)), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_id(s) for s in sets], pa.int64()), pa.array([sketcher.registers(s).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "th", "n", "cid", "regs"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(work, "doc_id long, th long, n long, cid long, regs binary")


def _registers(column: pa.Array, m: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, m)


def _promising(pairs: DataFrame, classes: DataFrame, t: float, m: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow and whose registers make likely a similarity of t."""
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("regs").alias(f"r{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("na", "nb") >= t * F.greatest("na", "nb") - 1e-9)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                ok = likely(x["na"].to_numpy(), x["nb"].to_numpy(), _registers(x["ra"], m), _registers(x["rb"], m), t)
                yield x.select(["a", "b"]).filter(pa.array(ok))

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(work, "a long, b long")


class Held:
    """Sets held for comparison, as one sorted list of their elements with owners."""

    def __init__(self, sets: list[np.ndarray], names: list[int]):
        self.names, self.sizes = np.array(names, np.int64), np.array([len(x) for x in sets], np.int64)
        whole, owner = np.concatenate([*sets, np.zeros(0, U)]), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(whole, kind="stable")
        self.elements, self.owner, self.sets = whole[order], owner[order], sets

    def linked(self, x: np.ndarray, percent: int) -> np.ndarray:
        """Which held sets reach the threshold with x."""
        lo, hi = np.searchsorted(self.elements, x, "left"), np.searchsorted(self.elements, x, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        both = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= percent * (self.sizes + len(x) - both))

    def without(self, gone: set[int]) -> Held:
        keep = [i for i, c in enumerate(self.names.tolist()) if c not in gone]
        return Held([self.sets[i] for i in keep], self.names[keep].tolist())


def _across(members: DataFrame, k: int, percent: int) -> DataFrame:
    """Links that join components within each group. members: grp, slice, rank, cid, comp, text; of a slice, rank 0 is
    held and compared with itself, then with all others as they come: first those outside the largest component (rank
    1), then those in it (rank 2). What has a link to the largest component needs no further one."""

    def solve(rows: Iterator[tuple[int, int, int, str]]) -> Iterator[tuple[int, int]]:
        owner: dict[int, int] = {}

        def find(c: int) -> int:
            while owner.setdefault(c, c) != c:
                owner[c] = c = owner[owner[c]]
            return c

        of: dict[int, int] = {}
        sets, names, held, main, gone = [], [], None, None, set()
        for rank, cid, comp, text in rows:
            x = shingle_sets([text], k)[0]
            if rank == 0:
                sets.append(x)
                names.append(cid)
                of[cid] = comp
                continue
            if held is None:
                held = Held(sets, names)
                yield from among(held, of, find, owner)
            if rank == 2 and main is None:
                main = comp
            yield from meet(held, x, cid, comp, of, find, owner)
            if main is not None:
                gone = {c for c in held.names.tolist() if find(of[c]) == find(main)} if len(held.names) and rank == 2 else gone
                if 2 * len(gone) > len(held.names):
                    held, gone = held.without(gone), set()
        if held is None:
            yield from among(Held(sets, names), of, find, owner)

    def among(held: Held, of: dict, find, owner: dict) -> Iterator[tuple[int, int]]:
        for x, cid in zip(held.sets, held.names.tolist(), strict=True):
            yield from meet(held, x, cid, of[cid], of, find, owner)

    def meet(held: Held, x: np.ndarray, cid: int, comp: int, of: dict, find, owner: dict) -> Iterator[tuple[int, int]]:
        for i in held.linked(x, percent).tolist() if len(held.names) else ():
            other = int(held.names[i])
            a, b = find(comp), find(of[other])
            if a != b:
                owner[a] = b
                yield min(cid, other), max(cid, other)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[tuple[int, int], tuple[int, int, int, str]]]:
            for x in batches:
                for g, sl, *rest in zip(*(x[c].to_pylist() for c in ("grp", "slice", "rank", "cid", "comp", "text")), strict=True):
                    yield (g, sl), tuple(rest)

        for _, group in itertools.groupby(rows(), key=lambda r: r[0]):
            found = list(solve(r[1] for r in group))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    ordered = members.repartition("grp", "slice").sortWithinPartitions("grp", "slice", "rank")
    return ordered.select("grp", "slice", "rank", "cid", "comp", "text").mapInArrow(work, "a long, b long")


def _slices(scratch: Scratch, open_rows: DataFrame, hold: int = 1000) -> DataFrame:
    """Members of buckets that hold several components, by groups of buckets that share members: grp, slice, rank, cid,
    comp. Members outside a group's largest component are dealt to slices of about `hold`, each of which sees all."""
    mixed = open_rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("cid").alias("head")).where("lo <> hi").select("key", "head")
    rows = scratch.put("mixed", open_rows.join(mixed, "key").select("cid", "comp", "head").distinct(), codec="none")
    groups = components(scratch, "g", rows.where("cid <> head").select(F.col("cid").alias("a"), F.col("head").alias("b")))
    own = scratch.put("grouped", rows.select("cid", "comp").distinct().join(groups.withColumnRenamed("comp", "grp"), "cid"), codec="none")
    sizes = own.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("grp").agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("all"))
    largest = largest.select("grp", F.col("m.comp").alias("main"), F.ceil((F.col("all") - F.col("m.n")) / F.lit(hold)).cast("int").alias("slices")).where("slices > 0")
    dealt = own.join(largest, "grp").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    mine = F.pmod(F.xxhash64("cid"), F.col("slices")) == F.col("slice")
    return dealt.select("grp", "slice", F.when(F.col("comp") == F.col("main"), 2).when(mine, 0).otherwise(1).alias("rank"), "cid", "comp")


def _confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold. texts: cid, text."""
    side = lambda c: texts.select(F.col("cid").alias(c), F.col("text").alias(f"t{c}"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            both = list(zip(x["ta"].to_pylist(), x["tb"].to_pylist(), strict=True))
            ok = []
            for at in range(0, len(both), 32):
                sets = shingle_sets([t for pair in both[at : at + 32] for t in pair], k)
                ok += [similar(sets[i], sets[i + 1], percent) for i in range(0, len(sets), 2)]
            yield x.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(work, "a long, b long")


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per row of docs (doc_id, text)."""
    t, scratch = percent / 100, Scratch(spark, "near")
    m, bands = plan(t)
    rows = scratch.put("rows", _sketch(docs, k, m), codec="none")
    solid = rows.where("n > 0")
    classes = scratch.put("classes", solid.groupBy("cid").agg(F.min("doc_id").alias("rep"), F.min("th").alias("th"), F.max("n").alias("n"), F.max("regs").alias("regs")), codec="none")
    width = m // bands * 2
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", i * width + 1, width)) for i in range(bands)])
    banded = classes.select("cid", F.explode(keys).alias("key"))
    shared = scratch.put("shared", banded.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("cid").alias("head")).where("size > 1"), codec="none")
    total = shared.agg(F.sum("size")).first()[0] or 0
    members = scratch.put("members", by_key(banded, shared, ["key"], "size", total), codec="none")
    company = members.groupBy("cid").agg(F.sum("size").alias("company"))
    best = members.join(company, "cid").groupBy("key").agg(F.max(F.struct("company", "cid"))["cid"].alias("centre"), F.max("size").alias("n"))
    centres = scratch.put("centres", best, codec="none")
    stars = by_key(members, centres, ["key"], "n", total).select("cid", F.explode(F.array("head", "centre")).alias("other")).where("cid <> other")
    pairs = stars.select(F.least("cid", "other").alias("a"), F.greatest("cid", "other").alias("b")).distinct()
    first = scratch.put("first", _promising(pairs, classes, t, m), codec="none")

    def texts(name: str, wanted: DataFrame) -> DataFrame:
        """Texts of the wanted classes (cid)."""
        ids = classes.join(wanted, "cid").select("cid", "th")
        found = docs.select(F.xxhash64("text").alias("th"), "text").join(ids.hint("shuffle_hash"), "th")

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:  # where texts share a hash, those of another set go
                ok = [c == set_id(shingle_sets([s], k)[0]) for c, s in zip(x["cid"].to_pylist(), x["text"].to_pylist(), strict=True)]
                yield x.filter(pa.array(ok, pa.bool_()))

        return scratch.put(name, found.select("cid", "text").mapInArrow(own, "cid long, text string").dropDuplicates(["cid"]))

    links = scratch.put("links", _confirm(first, texts("texts", first.select(F.explode(F.array("a", "b")).alias("cid")).distinct()), k, percent), codec="none")
    labels = components(scratch, "c1", links)
    open_rows = members.where("size > 2").select("key", "cid").join(labels, "cid", "left").select("key", "cid", F.coalesce("comp", "cid").alias("comp"))
    others = scratch.put("slices", _slices(scratch, open_rows), codec="none")
    if others.take(1):
        own = texts("texts2", others.select("cid").distinct())
        more = scratch.put("more", _across(others.join(own, "cid"), k, percent), codec="none")
        if more.take(1):
            labels = components(scratch, "c2", links.unionByName(more))
    scratch.drop("shared", "members", "centres", "first", "texts", "links", "mixed", "grouped", "slices", "texts2", "more")
    named = classes.join(labels, "cid", "left").select("cid", "rep", F.coalesce("comp", "cid").alias("comp"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of = named.join(least, "comp").select("cid", "component_id")
    out = solid.join(of, "cid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

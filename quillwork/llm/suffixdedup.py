"""Removal of repeated byte strings by a distributed merge sort of suffixes that knows common prefixes.

A string of `length` units that starts in two places is found through sampled suffixes. Over every window of grams the one
of least hash is an anchor; two equal strings have the same least gram, so they share an anchor, and each possible start
belongs to one anchor: the starts whose first window has that least gram. What follows an anchor, up to the end of its
last string, is its suffix; what precedes it, back to its first start, is its left context.

One run serves two kinds of units: bytes (what is removed) and words as 32-bit hashes (passages of many words, which may
be shorter in bytes; they are counted and nothing is removed for them).

1. One pass finds the anchors. Anchors whose first `length - window + 1` units occur once cannot lie in a repeat; they go
   after a count by key with map-side sums.
2. For the rest, each task sorts suffixes into runs, one per bucket of that key, equal entries as one, and sends
   them front-coded (the length of the prefix shared with the entry before, and the rest) and compressed. Texts without
   such anchors are not sent, and of equal texts (by 128-bit hashes) one, for all of them are repeats from end to end.
3. Each bucket merges its runs with a loser tree. Its nodes keep how much a loser shares with its winner, so prefixes
   known to be equal are never compared again, and each entry comes out with the prefix it shares with the last.
4. These shared prefixes form a tree. Going from long to short, sets of entries are joined, the smaller into the
   larger, kept in order of left contexts; an entry's neighbours there are its longest matches to the left. For each
   entry this gives the first and last start of a repeated string, so a group of n entries takes n log n steps
   and no pair is left out.
5. A key of more than `hot` anchors (a text in very many documents) goes to no bucket. Its strings are counted
   one by one, by 128-bit hashes with map-side sums, which spreads over all tasks whatever the key's size.

Matches in buckets are exact: contexts are compared unit by unit, hashes only choose candidates.

Defined cases: null text is empty. Texts shorter than `length` keep all bytes. Rows that share a doc_id are separate
documents, a null doc_id stays null, and repeated rows are copies of each other. Cuts may split a character; the rest is
bytes, not text. A very long text is read whole, in blocks. Other columns, whatever their names, are left out. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, Scratch, by_key, may_meet
from .setsketch import _powers, mix64, word_hashes

U = np.uint64
PLACE_BITS = 22


@dataclass(frozen=True)
class Kind:
    """Strings of `length` units of `unit` bytes; gram and window, in units, are powers of two."""

    code: int
    unit: int
    length: int
    gram: int
    window: int

    @property
    def need(self) -> int:
        """Units after an anchor that all its strings hold."""
        return self.length - self.window + 1

    def units(self, data: bytes) -> np.ndarray:
        """A text's bytes as units."""
        return np.frombuffer(data, np.uint8) if self.unit == 1 else word_hashes(data)[1].astype(np.uint32)


def byte_kind(length: int) -> Kind:
    return Kind(0, 1, length, 32, 256)


def word_kind(length: int) -> Kind:
    return Kind(1, 4, length, 8, 32)


def anchors(units: np.ndarray, kind: Kind, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor: key (hash of its first kind.need units), place, and how far before it its first and last start lie."""
    length, gram, window, need = kind.length, kind.gram, kind.window, kind.need
    n_starts = len(units) - length + 1
    parts = []
    for at in range(0, max(0, n_starts), block):
        starts = min(block, n_starts - at)
        a = units[at : at + starts + length - 1]
        h = mix64(a.astype(U) + U(1))
        step = 1
        while step < gram:
            h = h[:-step] * U(0x9E3779B97F4A7C15 + 2 * step) + h[step:]
            step *= 2
        v = (mix64(h) & ~U((1 << PLACE_BITS) - 1)) | np.arange(len(h), dtype=U)
        step = 1
        while step < window:
            v = np.minimum(v[:-step], v[step:])
            step *= 2
        place = (v[:starts] & U((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [starts]]) - 1
        p = place[first]
        up, down = _powers(1 << max(16, len(a).bit_length()))
        total = np.concatenate([np.zeros(1, U), np.cumsum((a.astype(U) + U(1)) * up[: len(a)], dtype=U)])
        key = mix64((total[p + need] - total[p]) * down[p] + U(kind.code))
        parts.append((key, p + at, p - first, p - last))
    if not parts:
        return (np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(3)))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


#: A spot packs an anchor's place, kind and its first and last start.
def pack_spots(kind: Kind, place: np.ndarray, far: np.ndarray, near: np.ndarray) -> np.ndarray:
    return place << 19 | kind.code << 18 | far << 9 | near


def unpack_spot(s: int) -> tuple[int, int, int, int]:
    return s >> 18 & 1, s >> 19, s >> 9 & 511, s & 511


def shared(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, that of `at` bytes being known."""
    n = min(len(a), len(b))
    x, y = a[at:n], b[at:n]
    if x == y:
        return n
    return n - (int.from_bytes(x) ^ int.from_bytes(y)).bit_length() // 8 - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() % 8 > 0)


def front_code(entries: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, bytes]:
    """entries in order: shared prefix with the one before, length of the rest and of the left context; then all bytes, as
    one zstd frame."""
    heads, body, before = [], [], b""
    for r, left in entries:
        k = shared(before, r)
        heads.append((k, len(r) - k, len(left)))
        body.append(r[k:])
        body.append(left)
        before = r
    return np.array(heads, "<u2").reshape(-1, 3), pa.compress(b"".join(body), codec="zstd", asbytes=True)


def decoded(heads: np.ndarray, body: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    r, at = b"", 0
    body = pa.decompress(body, int(heads[:, 1:].sum()), codec="zstd", asbytes=True)
    for k, n, m in heads.tolist():
        r = r[:k] + body[at : at + n]
        yield k, r, body[at + n : at + n + m]
        at += n + m


def merge(runs: list[Iterator[tuple[int, bytes, bytes, object]]]) -> Iterator[tuple[int, bytes, bytes, object]]:
    """Loser tree. Each run gives (prefix shared with its entry before, suffix, left context, data) in order; so does
    the merged run. A node holds its loser's run and the prefix that loser shares with the winner."""
    k = len(runs)
    lost: list[tuple[int, int] | None] = [None] * k
    heads: list[tuple | None] = [None] * k
    top = None
    for i in range(k):
        heads[i] = x = next(runs[i], None)
        run, h, node = i, 0 if x else -1, (i + k) // 2
        while node:
            if lost[node] is None:
                lost[node] = run, h
                break
            run, h = _play(heads, lost, node, run, h)
            node //= 2
        else:
            top = run, h
    while top and top[1] >= 0:
        run, h = top
        _, r, left, data = heads[run]
        yield h, r, left, data
        heads[run] = x = next(runs[run], None)
        h, node = x[0] if x else -1, (run + k) // 2
        while node:
            run, h = _play(heads, lost, node, run, h)
            node //= 2
        top = run, h


def _play(heads: list, lost: list, node: int, run: int, h: int) -> tuple[int, int]:
    """The winner at a node; the loser stays there. The one that shares more with the last output comes first."""
    other, g = lost[node]
    if h > g:
        return run, h
    if h < g:
        lost[node] = run, h
        return other, g
    if h < 0:
        return run, h
    a, b = heads[run][1], heads[other][1]
    s = shared(a, b, h)
    if a[s:] <= b[s:]:
        lost[node] = other, s
        return run, h
    lost[node] = run, s
    return other, g


def repeated_starts(common: list[int], rights: list[bytes], lefts: list[bytes], times: list[int], length: int, unit: int = 1) -> list[tuple[int, int] | None]:
    """For entries in suffix order, common[i] being the prefix (in bytes) that i shares with i - 1: how far, in units,
    before the anchor the first and the last start of a repeated string lie; None if there is none. times: occurrences of
    the very entry."""
    n = len(rights)
    far = [len(x) // unit for x in lefts]
    near = [length - len(x) // unit for x in rights]
    best: list[list[int] | None] = [[far[i], near[i]] if times[i] > 1 else None for i in range(n)]

    def meet(i: int, right: int, left: int) -> None:
        lo, hi = max(length - right // unit, near[i]), min(left // unit, far[i])
        if lo <= hi:
            if best[i] is None:
                best[i] = [hi, lo]
            else:
                best[i][0], best[i][1] = max(best[i][0], hi), min(best[i][1], lo)

    owner, groups = list(range(n)), [[(lefts[i], i)] for i in range(n)]

    def find(i: int) -> int:
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    for i in sorted(range(1, n), key=lambda i: -common[i]):
        a, b, right = find(i - 1), find(i), common[i]
        if len(groups[a]) < len(groups[b]):
            a, b = b, a
        large = groups[a]
        # all of the smaller meet the larger as it was; neighbours in the joined order are the longest left matches
        spots = [(bisect_left(large, x), x) for x in groups[b]]
        for at, (left, j) in spots:
            for other in (at - 1, at):
                if 0 <= other < len(large):
                    s = shared(left, large[other][0])
                    meet(j, right, s)
                    meet(large[other][1], right, s)
        if len(spots) * 8 > len(large):
            large.extend(groups[b])
            large.sort()
        else:
            for at, x in reversed(spots):
                large.insert(at, x)
        groups[b], owner[b] = [], a
    return [tuple(x) if x else None for x in best]


def _anchor_table(docs: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, spots = [], []
            for t in batch.column(2):
                data, k, s = t.as_py().encode(), [], []
                for kind in kinds:
                    key, place, far, near = anchors(kind.units(data), kind)
                    k.append(key.astype(np.int64))
                    s.append(pack_spots(kind, place, far, near))
                keys.append(np.concatenate(k))
                spots.append(np.concatenate(s))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (keys, spots)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["doc", "th", "keys", "spots"])

    return docs.mapInArrow(work, "doc long, th long, keys array<long>, spots array<long>")


RUN = "bucket int, kind int, heads binary, body binary, times binary, docs binary"


def _runs(texts: DataFrame, kinds: tuple[Kind, ...], n_buckets: int, most: int = 50_000) -> DataFrame:
    """Front-coded sorted runs of the suffixes at each text's spots. texts: doc, th, t, spots."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes, bytes], list[int]] = {}
        count = 0

        def out() -> Iterator[pa.RecordBatch]:
            by: dict[tuple[int, int], list[tuple[bytes, bytes]]] = {}
            for code, r, left in held:
                kind = kinds[code]
                bucket = int.from_bytes(hashlib.blake2b(r[: kind.need * kind.unit], digest_size=6).digest()) % n_buckets
                by.setdefault((bucket, code), []).append((r, left))
            rows = []
            for (bucket, code), entries in by.items():
                entries.sort()
                heads, body = front_code(entries)
                where = [held[(code, *e)] for e in entries]
                flat = [x for w in where for x in w]
                rows.append((bucket, code, heads.tobytes(), body, np.array([len(w) // 3 for w in where], "<u4").tobytes(), np.array(flat, "<i8").tobytes()))
            held.clear()
            for at in range(0, len(rows), 64):
                cols = list(zip(*rows[at : at + 64], strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:2]), *(pa.array(c, pa.binary()) for c in cols[2:])], names=["bucket", "kind", "heads", "body", "times", "docs"])

        for batch in batches:
            for doc, th, t, spots in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw, d, h, by_code = t.as_py().encode(), doc.as_py(), th.as_py(), {}
                for s in spots.as_py():
                    code, p, far, near = unpack_spot(s)
                    kind = kinds[code]
                    if code not in by_code:
                        units = kind.units(raw)
                        by_code[code] = units.tobytes(), units[::-1].tobytes(), len(units)
                    data, back, n = by_code[code]
                    u = kind.unit
                    held.setdefault((code, data[u * p : u * (p + kind.length - near)], back[u * (n - p) : u * (n - p + far)]), []).extend((d, h, p))
                    count += 1
                if count >= most:
                    yield from out()
                    count = 0
        if held:
            yield from out()

    return texts.mapInArrow(work, RUN)


SPAN = "doc long, th long, kind int, lo long, hi long"


def _merged(runs: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """SPAN: units covered by repeated strings, overlaps included."""

    def solve(code: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        kind = kinds[code]

        def run(heads: bytes, body: bytes, times: bytes, docs: bytes) -> Iterator[tuple[int, bytes, bytes, object]]:
            n, d, at = np.frombuffer(times, "<u4").tolist(), np.frombuffer(docs, "<i8"), 0
            for (k, r, left), m in zip(decoded(np.frombuffer(heads, "<u2").reshape(-1, 3), body), n, strict=True):
                yield k, r, left, d[at : at + 3 * m]
                at += 3 * m

        found: list[np.ndarray] = []

        def close(group: list[tuple[int, bytes, bytes, np.ndarray]]) -> None:
            times = [len(x[3]) // 3 for x in group]
            if len(group) == 1 and times[0] == 1:
                return
            starts = repeated_starts([x[0] for x in group], [x[1] for x in group], [x[2] for x in group], times, kind.length, kind.unit)
            for x, span in zip(group, starts, strict=True):
                if span:
                    w = x[3].reshape(-1, 3)
                    found.append(np.stack([w[:, 0], w[:, 1], w[:, 2] - span[0], w[:, 2] - span[1] + kind.length]))

        group: list[tuple] = []
        for x in merge([run(*r) for r in rows]):
            if group and x[0] < kind.need * kind.unit:
                close(group)
                group = []
            group.append(x)
        if group:
            close(group)
        if found:
            doc, th, lo, hi = (pa.array(c, pa.int64()) for c in np.concatenate(found, axis=1))
            yield pa.RecordBatch.from_arrays([doc, th, pa.array([code] * len(doc), pa.int32()), lo, hi], names=["doc", "th", "kind", "lo", "hi"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now = [], None
        for batch in batches:
            for bucket, code, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (bucket, code) != now:
                    yield from solve(now[1], rows)
                    rows = []
                now = bucket, code
                rows.append(tuple(rest))
        if rows:
            yield from solve(now[1], rows)

    return runs.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(work, SPAN)


def _strings(texts: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """Each string that starts near a hot spot: h1, h2, kind, doc, th, lo. texts: doc, th, t, hot (spots)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, th, t, spots in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw = t.as_py().encode()
                for kind in kinds:
                    own = [x[1:] for x in map(unpack_spot, spots.as_py()) if x[0] == kind.code]
                    if not own:
                        continue
                    units = kind.units(raw).astype(U) + U(1)
                    starts = np.unique(np.concatenate([np.arange(p - far, p - near + 1) for p, far, near in own]))
                    up, down = _powers(1 << max(16, len(units).bit_length()))
                    hashes = []
                    for mixed in (units, mix64(units)):
                        total = np.concatenate([np.zeros(1, U), np.cumsum(mixed * up[: len(units)], dtype=U)])
                        hashes.append(mix64((total[starts + kind.length] - total[starts]) * down[starts] + U(kind.code)).astype(np.int64))
                    n = len(starts)
                    same = [pa.array([x] * n, pa.int64()) for x in (doc.as_py(), th.as_py())]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, hashes), pa.array([kind.code] * n, pa.int32()), *same, pa.array(starts)], names=["h1", "h2", "kind", "doc", "th", "lo"])

    return texts.mapInArrow(work, "h1 long, h2 long, kind int, doc long, th long, lo long")


def _copied(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """doc, th, first: the texts that occur twice or more (by 128-bit hash), and whether doc is the least that has it."""
    ids = scratch.put("ids", docs.select("doc", "th", F.unhex(F.md5("t")).alias("m")), codec="none")
    groups = scratch.put("groups", ids.groupBy("th", "m").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least")).where("n > 1"), codec="none")
    rows = by_key(ids, groups, ["th", "m"], "n", groups.agg(F.sum("n")).first()[0] or 0)
    copied = scratch.put("copied", rows.select("doc", "th", (F.col("doc") == F.col("least")).alias("first")).distinct())
    scratch.drop("ids", "groups")
    return copied


def repeats(spark: SparkSession, docs: DataFrame, kinds: tuple[Kind, ...], per_bucket: int = 10_000, hot: int = 100_000) -> DataFrame:
    """doc, th, spans, whole: per text with repeats, the ranges that they cover by kind, and true if the whole text occurs
    again. docs: doc, th, t."""
    scratch = Scratch(spark, "suffix", tidy=True)
    copied = _copied(scratch, docs)
    table = scratch.put("anchors", _anchor_table(docs, kinds), codec="none")
    counts = table.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = scratch.put("twice", counts, codec="none")
    total = twice.agg(F.sum("n")).first()[0] or 0
    each = table.select("doc", "th", F.inline(F.arrays_zip("keys", "spots"))).withColumnRenamed("keys", "key")
    some = by_key(each, twice, ["key"], "n", total).groupBy("doc", "th")
    of = lambda c: F.sort_array(F.collect_set(F.when(c, F.col("spots"))))
    lists = some.agg(of(F.col("n") <= hot).alias("spots"), of(F.col("n") > hot).alias("hot"))
    # of equal texts one is compared with the others
    spots = scratch.put("spots", lists.join(copied.where("not first"), ["doc", "th"], "left_anti"))
    scratch.drop("anchors", "twice")
    n, n_hot, n_texts = spots.agg(F.sum(F.size("spots")), F.sum(F.size("hot")), F.count(F.lit(1))).first()
    some = may_meet(docs, spots, ["doc", "th"], n_texts)
    with_text = lambda which: some.join(spots.where(F.size(which) > 0).select("doc", "th", which).hint("shuffle_hash"), ["doc", "th"]).select("doc", "th", "t", which)
    found = _merged(_runs(with_text("spots"), kinds, max(1, (n or 0) // per_bucket)), kinds)
    if n_hot:
        strings = scratch.put("strings", _strings(with_text("hot"), kinds), codec="none")
        again = scratch.put("again", strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), codec="none")
        size = F.get(F.array(*[F.lit(k.length) for k in kinds]), F.col("kind"))
        hits = by_key(strings, again, ["h1", "h2"], "n", again.agg(F.sum("n")).first()[0] or 0)
        found = found.unionByName(hits.select("doc", "th", "kind", "lo", (F.col("lo") + size).alias("hi")))
    by_text = found.groupBy("doc", "th").agg(F.collect_list(F.struct("kind", "lo", "hi")).alias("spans"))
    spans = scratch.put("spans", by_text.join(copied.select("doc", "th", F.lit(True).alias("whole")), ["doc", "th"], "full"))
    scratch.drop("spots", "strings", "again", "copied")
    return spans


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that touch or overlap joined."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def dedup_suffixes(spark: SparkSession, docs: DataFrame, length: int = 400, passage: int = 51, hot: int = 100_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), n_passage_words, one row per row of docs (doc_id,
    text). n_passage_words: the words covered by a run of `passage` words that starts anywhere else too (words as equal
    bytes between white space), whatever its bytes; bytes are removed for `length` alone."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc"), F.xxhash64(text).alias("th"), text.alias("t"))
    kinds = byte_kind(length), word_kind(passage)
    spans = repeats(spark, own, kinds, hot=hot)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, found, whole in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
                data, spans = t.as_py().encode(), found.as_py() or []
                if whole.as_py():
                    sizes = ((k, len(k.units(data))) for k in kinds)
                    spans = [{"kind": k.code, "lo": 0, "hi": n} for k, n in sizes if n >= k.length]
                ranges, words = (covered([(x["lo"], x["hi"]) for x in spans if x["kind"] == code]) for code in (0, 1))
                cuts = [0, *(x for r in ranges for x in r), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                rows.append((len(data), sum(b - a for a, b in ranges), len(ranges), kept, sum(b - a for a, b in words)))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64()] * 3 + [pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, types, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "n_passage_words"])

    both = own.join(spans.hint("shuffle_hash"), ["doc", "th"], "left").select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "t", "spans", "whole")
    return both.mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, n_passage_words long")

"""Source divergence, ranked search and license scans against plain versions, on rows with nulls, ties and repeats."""

import math
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from quillwork.llm import bytewords, divergence, licenses, queries, search

WORDS = ["the", "of", "été", "Straße", "x" * 40, "über", "a1b2", "don't", "ONE", "two", "日本", "é"]
ODD = [None, "", " ", "\n\n", "The the THE", "a" * 31 + " " + "a" * 32 + " " + "a" * 33, "é\x00b", "x-y_z", "a" * 31]
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(t):
    return (t or "").translate(search.TO_LOWER)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    made = [" ".join(rng.choice(WORDS, rng.integers(1, 60), p=[0.3, 0.2] + [0.05] * 10)) for _ in range(150)]
    return made + ODD + ["the of " * 20_000, made[0], made[0]]


def test_slices_and_hashes(texts):
    column = pa.array(texts, pa.string()).slice(3)
    s = bytewords.cut(column, bytewords.LETTERS)
    want = [(i, w.encode()) for i, t in enumerate(column.to_pylist()) for w in LETTERS.findall(lower(t))]
    assert [(int(r), s.text(i)) for i, r in enumerate(s.rows)] == want
    assert bytewords.hashes(s, 7).tolist() == [xxhash.xxh64_intdigest(w, 7) for _, w in want]
    number, first = bytewords.grouped(s, bytewords.hashes(s))
    assert [s.text(i) for i in first[number]] == [w for _, w in want] and len(first) == len({w for _, w in want})
    same = np.zeros(len(want), np.uint64)  # one hash for all: bytes alone tell them apart
    number, first = bytewords.grouped(s, same)
    assert [s.text(i) for i in first[number]] == [w for _, w in want] and len(first) == len({w for _, w in want})
    assert len(bytewords.cut(pa.array([], pa.string()), bytewords.LETTERS).starts) == 0


@pytest.mark.parametrize("most", [1, 7, 40, 100_000])
def test_pieces(texts, most):
    for t in ["x", " ", "a b", "ab" * 30, *(t and t[:300] for t in texts[-15:])]:
        got = list(bytewords.pieces(pa.array([t], pa.string()), bytewords.LETTERS, most))
        assert b"".join((p[0].as_py() or "").encode() for p in got) == (t or "").encode()
        assert [w for p in got for w in LETTERS.findall(lower(p[0].as_py()))] == LETTERS.findall(lower(t))
        assert all(p[0] is None or len((p[0].as_py() or "").encode()) <= most + 2 * max(map(len, (t or "").encode().split(b" "))) for p in got)
    column = pa.array(texts, pa.string())
    assert [p.equals(column) for p in bytewords.pieces(column, bytewords.LETTERS, most)] == [True]


@pytest.mark.parametrize("n_texts", [4000, 1])
def test_memory_of_counting(n_texts):
    """12 MB of text, many texts or one, whatever the batch holds: memory is that of a portion."""
    rng = np.random.default_rng(8)
    words = np.array([f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(5000)])[rng.integers(5000, size=2_400_000)]
    texts = [" ".join(w) for w in np.array_split(words, n_texts)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * n_texts), pa.array(["s"] * n_texts), pa.array(texts)], names=["lang", "source", "text"])
    tracemalloc.start()
    n, docs = Counter(), Counter()
    for out in divergence._count(iter([batch])):
        for _, _, term, k, d in zip(*(c.to_pylist() for c in out.columns), strict=True):
            n[term] += k
            docs[term] += d
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == Counter(words.tolist())
    assert docs == Counter(t for text in texts for t in set(text.split()))
    assert peak < 100_000_000


@pytest.mark.parametrize("n_texts", [4000, 1])
def test_memory_of_frequencies(n_texts):
    texts = [" ".join(["the", "of", "on"] * (1_200_000 // n_texts))] * n_texts
    batch = pa.RecordBatch.from_arrays([pa.array(range(n_texts)), pa.array(range(n_texts)), pa.array(texts)], names=["doc_id", "row", "text"])
    tracemalloc.start()
    got = [r for out in search._frequencies(["of", "the"])(iter([batch])) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    k = 1_200_000 // n_texts
    assert got == [{"doc_id": i, "row": i, "n": 3 * k, "terms": [0, 1], "tfs": [k, k]} for i in range(n_texts)]
    assert peak < 100_000_000


def audit_plain(rows, least, add, top):
    """rows: lang, source, text."""
    seen, langs, own = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        ws = LETTERS.findall(lower(text))
        seen[lang].update(set(ws))
        langs[lang].update(ws)
        own[lang, source].update(ws)
    out = []
    for lang, source in own:
        kept = [t for t, n in seen[lang].items() if n >= least]
        p = lambda counts: {t: 1 + 10**9 * (counts[t] + add) // (sum(counts[k] for k in kept) + add * len(kept)) for t in kept}  # noqa: E731, B023
        mine, all_ = p(own[lang, source]), p(langs[lang])
        pairs = [(sum(abs(mine[t] - q) for t, q in p(own[lang, other]).items()), other) for k, other in own if k == lang and other != source]
        terms = [(mine[t] - all_[t], t) for t in kept if own[lang, source][t] and mine[t] > all_[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize(("block", "chunk"), [(128, 2048), (2, 3)])
def test_audit(spark, texts, block, chunk):
    rng = np.random.default_rng(3)
    rows = [(["en", "de", None, "xx"][min(3, i % 4 if t else 3)], [None, "a", "b", "Ä", "c"][rng.integers(5)], t) for i, t in enumerate(texts)]
    rows += [("en", "bare", "!!"), ("yy", "one", "word"), ("yy", "two", None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, term long, sid long").repartition(3)
    got = divergence.audit(spark, df, min_docs=4, add=5, top=3, block=block, chunk=chunk)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got.collect()) == audit_plain(rows, 4, 5, 3)


def test_audit_of_nothing(spark):
    assert divergence.audit(spark, spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def search_plain(docs, items, k):
    own = [(i, d, Counter(search.terms_of(t))) for i, (d, t) in enumerate(docs)]
    own = [x for x in own if x[2]]
    n_docs, n_words = len(own), sum(sum(c.values()) for _, _, c in own)
    df = Counter(t for _, _, c in own for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, d, c in own:
            m = 75 + 25 * sum(c.values()) * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in search.terms_of(text) if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0, i, d))
        out += [(item, r + 1, x[4], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize(("window", "block"), [(8192, 500_000), (7, 60)])
def test_search(spark, texts, window, block):
    docs = [(None if i % 17 == 0 else i // 2 * 3, t) for i, t in enumerate(texts)]
    items = [(1, "one two été"), (2, "the of"), (2, "straße Straße the"), (None, "日本 a1b2"), (3, None), (4, "nowhere"), (5, "é xüy a")]
    df = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, row string, score int").repartition(4)
    asked = spark.createDataFrame([(*r, 9) for r in items], "item_id long, text string, query int").coalesce(1)
    got = search.search(spark, df, asked, k=6, window=window, block=block)
    key = lambda r: tuple((v is None, v or 0) for v in r)
    got = sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=key)
    assert got == sorted(search_plain(docs, items, 6), key=key)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.search(spark, docs, items).collect() == []
    assert search.search(spark, items.withColumnRenamed("item_id", "doc_id"), spark.createDataFrame([], "item_id long, text string")).collect() == []


def licenses_plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    line = f" {' '.join(words)} "
    found = [(m.start(), m.end(), cls, i, label) for i, (label, key, cls, regex) in enumerate(licenses.rules()) if key in words for m in re.finditer(f"(?<= )(?:{regex})(?= )", line)]
    inside = lambda f, g: g[2] <= f[2] and g[0] <= f[0] and g[1] >= f[1] and (g[1] - g[0] > f[1] - f[0] or g[2:4] < f[2:4])
    left = [f for f in found if not any(inside(f, g) for g in found)]
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + phrase.count(" ") + 1] == phrase.split()]
    first, last = (min(places)[0], max(places)[0]) if places else (None, None)
    of = lambda labels: ",".join(sorted(set(labels)))
    score = max([licenses.WORTH[f[2]] for f in left] + [licenses.WORTH[2] for _ in places], default=0.0)
    return (len(words), len(places), first, last, of(x for _, x in places), of([x for _, x in places] + [f[4] for f in left]), score)


NOTES = [
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0", "cc by nc sa 4.0 and CC-BY-NC",
    "GNU Lesser General Public License, version 2.1", "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    "SPDX-License-Identifier: GPL-3.0-or-later", "Permission is hereby granted, free of charge, to any person obtaining\n * a copy of this software and associated documentation files",
    "under the mit license under the mit license", "BSD license", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    "openly licensed under the terms of the Mozilla Public License 2.0", "mit", "an apache in a public common", "https://creativecommons.org/licenses/by-sa/4.0/", "cc", "under the mit license version 2 of apache license version 2",
]


def test_licenses(spark, texts):
    rng = np.random.default_rng(1)
    long = lambda n, note: " ".join([*rng.choice(WORDS, n), note, *rng.choice(WORDS, 5)])
    rows = [*NOTES, *texts, *(long(n, note) for note in NOTES for n in (3, 250, 256, 300, 509))]
    # notes that the cut between two blocks would part
    rows += [long(licenses.BLOCK - k, NOTES[7]) for k in range(20)] + ["\n".join(NOTES * 40)]
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(rows)], "doc_id long, text string, labels string, n_words int").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:8] for r in licenses.scan(df).collect()}
    for i, t in enumerate(rows):
        assert got[i] == licenses_plain(t), t
    assert licenses.scan(df.limit(0)).collect() == []


def test_licenses_repeated_rows(spark):
    df = spark.createDataFrame([(1, NOTES[0]), (1, NOTES[0]), (None, NOTES[0]), (None, None)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["labels"], r["score"]) for r in licenses.scan(df).collect()) == [(0, "", 0.0), (0, "mit", 0.9), (1, "mit", 0.9), (1, "mit", 0.9)]


def test_no_python_in_the_license_scan(spark):
    plan = queries.op13_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

"""Defined cases and brute-force versions of the corpus operators, beside test_queries."""

import math
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillwork.llm import cws, langid, linededup, packing, quality, setsketch, suffixdedup
from quillwork.llm.common import by_key, may_meet

DOC = "doc_id long, text string"


def signed(x):
    return x - 2**64 if x >> 63 else x


def xx(*parts, seed=42):
    """Spark's xxhash64 of strings, longs (int) and ints (np.int32)."""
    for p in parts:
        raw = p.encode() if isinstance(p, str) else p.tobytes() if isinstance(p, np.int32) else (p & (2**64 - 1)).to_bytes(8, "little")
        seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed


def sample_hex(text):
    """A fingerprint recomputed word by word."""
    bag = Counter(re.findall(r"[^\x20\x09-\x0D]+", text))
    out = []
    for part in range(cws.SAMPLES // cws.AT_ONCE):
        for j in range(cws.AT_ONCE):
            best = None
            for word, w in bag.items():
                h = xx(signed(xx(word)), np.int32(part))
                x = xx(signed(h ^ (j + 1)))
                y = xx(signed(x))
                unit = lambda v, s: ((v >> s & ((1 << 21) - 1)) + 0.5) / (1 << 21)
                r, beta = -math.log(unit(x, 0) * unit(x, 21)), unit(x, 42)
                c = math.log(-math.log(unit(y, 0) * unit(y, 21)))
                t = math.floor(math.log(w) / r + beta)
                la = c - r * (t - beta + 1)
                high = int(min(max((la + 96.0) * (1 << 24), 0.0), float((1 << 31) - 1)))
                packed = high << 32 | xx(signed(x ^ (t & (2**64 - 1)))) & 0xFFFFFFFF
                best = packed if best is None else min(best, packed)
            if best is not None:
                out.append(f"{best & 0xFFFFFFFF:08x}")
    return "".join(out)


def test_fingerprints_word_by_word(spark):
    texts = ["a b a c", "one two  two\tthree three three", "", " \n", "x", "a b a d " * 9]
    got = {r.doc_id: r for r in cws.edited_pairs(spark, spark.createDataFrame(list(enumerate(texts)), DOC)).collect()}
    assert {i: got[i].fingerprint for i in got} == {i: sample_hex(t) for i, t in enumerate(texts)}


def test_fingerprint_ranges(spark):
    ids = [-(2**63), 2**63 - 1, 5, None, None, 7, 7, *range(1000, 1200), *[9] * 40, *[None] * 30]
    rows = [(i, f"text {k % 37} of {k % 11}") for k, i in enumerate(ids)]
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), signed(xx(x[1])), x[1]))
    want = Counter((a[0], a[1], b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True))
    docs = spark.createDataFrame(rows, DOC)
    for size in (5, 1000):
        out, names = cws.with_next(docs, size)
        assert Counter((r.doc_id, r.text, r.next_text) for r in out.collect()) == want
        if size == 5:
            assert out.groupBy(*names).count().agg(F.max("count")).first()[0] <= 4 * size


def test_language_of_number_characters(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en", "x"), (2, "le chat et le chien", "fr", "x"), (None, "the dog", "en", "x")], "doc_id long, text string, lang string, score string")
    model = langid.train(spark, docs)
    odd = spark.createDataFrame([(3, "½ ² ³ Ⅷ 12", "y"), (4, "the ½ dog", "y")], "doc_id long, text string, lang_pred string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark, odd, model).collect()}
    assert got == {3: "und", 4: "en"}
    assert langid.identify(spark, docs, model).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert [r.h for r in docs.orderBy(F.col("doc_id").isNull(), "doc_id").select(langid.held_out(F.col("doc_id")).alias("h")).collect()][-1] is False


def test_line_dedup_replaces_columns_of_its_names(spark):
    docs = spark.createDataFrame([(1, "a\nb", "old", "old")], "doc_id long, text string, n_lines string, n_dropped string")
    r = linededup.dedup_lines(spark, docs).first()
    assert (r.n_lines, r.n_dropped, r.text) == (2, 0, "a\nb")
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith("quillwork_lines_")]
    assert not left


def test_near_dedup_without_ids(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words[:-1], "x"]), " ".join([*words[:-2], "y", "x"])]
    rows = [(None, texts[0]), (1, texts[1]), (2, texts[2]), (None, "all alone here now"), (5, None)]
    got = Counter((r.doc_id, r.component_id, r.kept) for r in setsketch.near_duplicates(spark, spark.createDataFrame(rows, DOC)).collect())
    assert got == Counter([(None, 1, False), (1, 1, True), (2, 1, False), (None, None, True), (5, 5, True)])


def test_quality_with_production_limits(spark):
    body = lambda i: " ".join(f"{i}a{j}" for j in range(60))
    rows = [(i, "big", f"{body(i)}\nRead more  here" if i < 20 else body(i)) for i in range(300)] + [(1000 + i, "small", f"{body(i)}\nread more here") for i in range(12)] + [(2000 + i, "tiny", f"{body(i)}\nread more here") for i in range(10)]
    got = {r.doc_id: r.n_lost_words for r in quality.quality(spark, spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    # 20 of 300 documents are more than five in a hundred, 12 of 12 are, 10 documents are too few to tell
    assert got[0] == 3 and got[299] == 0 and got[1000] == 3 and got[2000] == 0


def test_repeats_are_compared_as_words(spark):
    r = np.random.default_rng(4)
    texts = [" ".join(r.choice(["a", "b", "c", "d", "ab"], r.integers(0, 40))) for _ in range(60)]

    def brute(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        wins = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        return len({j for i in range(len(w) - 2) if wins[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)})

    docs = spark.createDataFrame(list(enumerate(texts)), DOC).withColumn("source", F.lit("s"))
    assert {x.doc_id: x.n_repeat_words for x in quality.quality(spark, docs).collect()} == {i: brute(t) for i, t in enumerate(texts)}


def test_suffix_dedup_counts_hot_keys_string_by_string(spark):
    r = np.random.default_rng(2)
    word = lambda: "".join(r.choice(list("abcdefgh"), 6))
    passage = " ".join(word() for _ in range(80))
    short = " ".join(word()[:2] for _ in range(60))  # more than 50 words in less than 400 bytes
    rows = [(i, f"{' '.join(word() for _ in range(i + 3))} {passage} {' '.join(word() for _ in range(9))}") for i in range(8)] + [(20, f"{word()} {short} {word()}"), (21, f"{word()} {short} end"), (22, " ".join(word() for _ in range(200)))]
    docs = spark.createDataFrame([*rows, (None, None)], DOC)
    runs = [sorted(map(tuple, suffixdedup.dedup_suffixes(spark, docs, hot=h).collect()), key=repr) for h in (100_000, 2)]
    assert runs[0] == runs[1]
    got = {x[0]: x for x in runs[0]}
    assert all(got[i][2] >= 400 and got[i][5] >= 80 for i in range(8))
    assert got[20][2] == got[21][2] == 0 and got[20][5] == got[21][5] == 60 and got[22][2] == got[22][5] == 0 and got[None][1] == 0


def test_pack_examples_over_limits_and_nulls(spark):
    rows = [(1, 2000, 1, 0), (2, None, None, None), (3, 10, 99, 1), (None, 10, 1, -5), (4, 500, 1, 500), (4, 500, 1, 500)]
    got = packing.pack_examples(spark.createDataFrame(rows, "id long, n_tokens int, n_segments int, n_loss int")).collect()
    assert Counter((r.id, r.over) for r in got) == Counter([(1, True), (2, False), (3, True), (None, False), (4, False), (4, False)])
    alone = Counter(r.sequence_id for r in got)
    assert all(alone[r.sequence_id] == 1 for r in got if r.over)
    assert packing.pack_examples(spark.createDataFrame([], "id string, n_tokens int, n_segments int, n_loss int")).count() == 0


@pytest.mark.parametrize("heavy", [0, 4000])
def test_by_key_is_the_join(spark, monkeypatch, heavy):
    import quillwork.llm.common as common

    monkeypatch.setattr(common, "HEAVY_KEYS", heavy or 1)
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    per = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 7")
    got = by_key(rows, per, ["k"], "n", 5000)
    assert sorted(map(tuple, got.select("k", "id", "n").collect())) == sorted(map(tuple, rows.join(per, "k").select("k", "id", "n").collect()))


def _shuffle_files(spark):
    """Bytes by name."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if re.match(r"shuffle_.*data", f.getName())}


def test_suffix_dedup_leaves_no_shuffle_files(spark):
    r = np.random.default_rng(5)
    text = lambda: "".join(r.choice(list("abcdefgh "), 900))
    shared = text()
    docs = spark.createDataFrame([(i, i, shared + text() if i % 3 == 0 else text()) for i in range(60)], "doc long, th long, t string")
    before, name = _shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    spans = suffixdedup.repeats(spark, docs, (suffixdedup.byte_kind(400),))
    left = lambda: sum(n for k, n in _shuffle_files(spark).items() if k not in before)
    end = time.time() + 20
    while left() > 2000 and time.time() < end:
        time.sleep(0.2)
    # but for sums of one row, nothing waits for the driver's garbage collection
    assert left() <= 2000 and spark.conf.get(name) == was
    assert {x.doc for x in spans.collect()} == set(range(0, 60, 3))


def test_runs_are_sent_compressed_and_read_back():
    r = np.random.default_rng(6)
    words = ["".join(r.choice(list("abcdefghijklmnop"), 6)).encode() for _ in range(300)]
    entries = sorted((b" ".join(words[i] for i in r.integers(0, 300, 60)), b" ".join(words[i] for i in r.integers(0, 300, 20))[: i % 40]) for i in range(200))
    entries += [(entries[-1][0], b"")] * 2
    heads, body = suffixdedup.front_code(entries)
    assert [(x[1], x[2]) for x in suffixdedup.decoded(heads, body)] == entries
    assert len(body) < 0.7 * int(heads[:, 1:].sum())


def test_may_meet_loses_no_row_that_meets(spark):
    rows = spark.range(40_000).select(F.col("id").alias("doc"), (F.col("id") * 7).alias("th"), F.lit("t").alias("t"))
    rows = rows.unionByName(rows.where("doc % 100 = 0"))  # copies stay
    others = spark.range(0, 40_000, 8).select(F.col("id").alias("doc"), (F.col("id") * 7).alias("th"))
    got = may_meet(rows, others, ["doc", "th"], 5000)
    assert got.columns == rows.columns
    count = Counter(r.doc for r in got.collect())
    want = Counter(r.doc for r in rows.join(others, ["doc", "th"]).collect())
    assert {k: count[k] for k in want} == want and sum(count.values()) - sum(want.values()) < 40_000 * 0.15
    assert may_meet(rows, others.where("false"), ["doc", "th"], 0).count() == 0


def test_suffix_dedup_compares_one_of_equal_texts(spark, monkeypatch):
    r = np.random.default_rng(7)
    text = lambda n: " ".join("".join(r.choice(list("abcdefgh"), 6)) for _ in range(n))
    much, short, brief = text(200), text(20), " ".join(text(1)[:2] for _ in range(60))
    rows = [*((i, much) for i in range(30)), (None, much), (3, much), (40, f"{text(30)} {much[100:900]} {text(30)}"), (41, text(90)), (50, short), (51, short), (60, brief), (61, brief), (70, None), (71, None)]
    sent, runs = [], suffixdedup._runs
    monkeypatch.setattr(suffixdedup, "_runs", lambda texts, *a: sent.append(texts.count()) or runs(texts, *a))
    got = suffixdedup.dedup_suffixes(spark, spark.createDataFrame(rows, DOC)).collect()
    assert Counter(x.doc_id for x in got) == Counter(x[0] for x in rows) and sent[0] <= 4
    of = {x.doc_id: x for x in got}
    assert all((of[i].n_removed, of[i].n_spans, bytes(of[i].kept), of[i].n_passage_words) == (len(much), 1, b"", 200) for i in (*range(30), None))
    assert 800 <= of[40].n_removed <= 804 and of[40].n_spans == 1 and of[41].n_removed == of[41].n_passage_words == 0
    assert all((of[i].n_removed, of[i].n_passage_words, bytes(of[i].kept)) == (0, 0, short.encode()) for i in (50, 51))
    assert all((of[i].n_removed, of[i].n_passage_words) == (0, 60) for i in (60, 61)) and of[70].n_bytes == of[71].n_removed == 0

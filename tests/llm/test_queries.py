"""The registered queries on sf0.001 against SQL or brute force, and all operators on odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from quillwork.llm import cws, htmltext, langid, linededup, mixing, oracles, packing, quality, queries, setsketch, suffixdedup, tokenfile
from quillwork.llm.tokens import END, Encoder, default_path, read_model

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, keys string, lines string, drop int"
CLASHING = ["__lines", "__new", "__doc", "__id", "__row", "__all", "__c", "__r", "row", "number", "group", "copies", "n", "part", "h", "mark", "key", "none", "before", "doc", "th", "ls", "whole"]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns whose names clash."""
    line = "this line of more than forty characters is in many documents"
    rows = [(i, f"head {i}\n{line}\ntail {i}", "en", "s", 1, "k", "l", 1) for i in range(6)]
    rows += [(None, None, None, None, None, None, None, None), (7, "", "en", None, 0, None, None, 0), (8, " \n\t ", "de", "s", 3, "", "", 0), (9, None, "de", "t", 0, "", "", 0)]
    rows += [(10, "word " * 30_000, "en", "s", 5, "", "", 0)] + [(11, "same row of some words here", "en", "t", 27, "", "", 0)] * 3 + [(12, "日本語の文章です é" * 50, "fr", "t", 1, "", "", 0)]
    return spark.createDataFrame(rows, DOC)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = con.sql(oracles.SQL[name])
    order = [want.columns.index(c) for c in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[i] for i in order) for r in want.fetchall())


def test_language_id(spark, odd, texts):
    df = queries.QUERIES["op1_language_id"](spark, SF)
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = df.collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(texts) and all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.95
    out = langid.identify(spark, odd, langid.train(spark, odd))
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert out.columns == [*odd.columns, "lang_pred", "score"] and got[7] == got[8] == got[9] == ("und", 0.0) and 0 <= got[10][1] <= 1
    assert {r.lang_pred for r in langid.identify(spark, odd, langid.train(spark, odd.where("false"))).collect()} == {"und"}


def test_lattice_sums_all_cuts():
    import numpy as np

    pieces = ["a", "b", "ab", "▁", "▁a", "ba"]
    lat, logp = langid.Lattice(pieces), np.log(np.array([[0.2], [0.1], [0.3], [0.15], [0.15], [0.1], [1e-6]]))

    def brute(word):
        s = "▁" + word
        d = [1.0] + [0.0] * len(s)
        for i in range(1, len(s) + 1):
            d[i] = d[i - 1] * 1e-6 + sum(d[i - len(p)] * np.exp(logp[k, 0]) for k, p in enumerate(pieces) if s[:i].endswith(p))
        return np.log(d[-1])

    words = ["ab", "a", "abba", "xabz", "b" * 40, "é"]
    assert np.allclose(lat.score(words, logp)[:, 0], [brute(w) for w in words])
    assert np.isclose((lat.expected(words, np.ones(6), logp[:, 0]) * lat.lengths).sum(), sum(len(w) + 1 for w in words))


def test_line_dedup_odd(spark, odd):
    out = linededup.dedup_lines(spark, odd)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == [*odd.columns, "n_lines", "n_dropped"] and out.count() == odd.count()
    assert [got[i].n_dropped for i in range(6)] == [1, 1, 1, 1, 1, 0] and got[0].text == "head 0\ntail 0" and got[9].n_lines == 1
    assert linededup.dedup_lines(spark, odd.where("false")).count() == 0


def test_line_store_levels(spark):
    lines = spark.range(400).select((F.col("id") % 40).alias("doc"), (F.col("id") % 23).alias("h1"), F.lit(0).cast("long").alias("h2"))
    store = linededup.LineStore(spark, 400, fan_out=2, per_bucket=100)
    for b in range(5):
        store.add(lines.where(F.col("doc") % 5 == b))
    got = {r.h1: (r.n_docs, r.last_doc) for r in store.totals().collect()}
    want = {r.h1: (r.n, r.m) for r in lines.distinct().groupBy("h1").agg(F.count("*").alias("n"), F.max("doc").alias("m")).collect()}
    assert got == want and len(store.runs()) == 2


def test_suffix_dedup(spark, odd, texts):
    got = {r.doc_id: r for r in queries.QUERIES["op3_suffix_dedup"](spark, SF).collect()}
    raw, count = {k: t.encode() for k, t in texts.items()}, Counter()
    for t in raw.values():
        count.update(hashlib.blake2b(t[i : i + 400], digest_size=8).digest() for i in range(len(t) - 399))
    for k, t in raw.items():
        cov = bytearray(len(t))
        for i in range(len(t) - 399):
            if count[hashlib.blake2b(t[i : i + 400], digest_size=8).digest()] > 1:
                cov[i : i + 400] = b"\1" * 400
        kept = bytes(c for c, x in zip(t, cov, strict=True) if not x)
        r = got[k]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), sum(cov), len(re.findall(b"\1+", cov)), hashlib.sha256(kept).hexdigest())
    out = {r.doc_id: r for r in suffixdedup.dedup_suffixes(spark, odd).collect()}
    assert out[10].n_removed == 150_000 and out[12].n_removed > 0 and out[9].n_bytes == 0 and out[11].n_removed == 0
    assert suffixdedup.dedup_suffixes(spark, odd.where("false")).count() == 0


def test_tokens_and_packing(spark, odd, texts):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(default_path())
    ids = {k: b"".join(i.to_bytes(4, "little") for i in fresh.encode(t, add_special_tokens=False).ids) + END for k, t in texts.items()}
    at = 0
    for r in queries.QUERIES["op4_token_file"](spark, SF).orderBy("doc_id").collect():
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids[r.doc_id]) // 4, zlib.crc32(ids[r.doc_id]))
        at += r.n_tokens
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in queries.QUERIES["op10_packing"](spark, SF).collect():
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    assert pieces.keys() == ids.keys()
    for k, rs in pieces.items():
        n = 0
        for r in sorted(rs, key=lambda r: r.start):
            assert r.start == n and r.ids_crc32 == zlib.crc32(ids[k][4 * n : 4 * (n + r.length)]) and r.doc_tokens == len(ids[k]) // 4
            n += r.length
        assert n == len(ids[k]) // 4
    pad = 0
    for rs in seqs.values():
        n = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == n
            n += r.length
        assert n <= 1024
        pad += 0 if n & (n - 1) == 0 else 1024 - n
    assert pad < 0.01 * at
    assert tokenfile.token_table(spark, odd).agg(F.sum("n_tokens")).first()[0] == packing.pack_documents(spark, odd).agg(F.sum("length")).first()[0]
    assert tokenfile.token_table(spark, odd.where("false")).count() == packing.pack_documents(spark, odd.where("false")).count() == 0


def test_parts_give_the_librarys_ids():
    import random

    enc, r = Encoder(read_model(default_path())), random.Random(3)
    some = ["a", "b", "\n", " ", "  ", "\t", "é", "1", "'s", "'", ",", "_", "<|endoftext|>", "日", "\xa0", "\x1c", "​"]
    for _ in range(3000):
        t = "".join(r.choice(some[: r.choice([4, 12, 17])]) for _ in range(r.randint(1, 12)))
        assert enc.encode(t) == enc.whole(t), repr(t)


def test_simple8b_round_trip():
    import numpy as np

    from quillwork.llm import simple8b

    r = np.random.default_rng(1)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        for hi in (1, 2, 50, 50_257, 2**30, 2**61, 2**63):
            v = r.integers(0, hi, n, dtype=np.uint64)
            v = np.where(r.random(n) < 0.1, np.uint64(2**64 - 3), v).astype(np.uint64) if hi == 2**63 else v
            words, offsets = simple8b.encode(v)
            assert (simple8b.decode(words, n, offsets) == v).all()


def test_pack_examples(spark):
    ex = spark.createDataFrame([(i, 100 + 37 * i % 500, 1 + i % 3, 10 + 13 * i % 300) for i in range(200)], "id long, n_tokens int, n_segments int, n_loss int")
    got = packing.pack_examples(ex).join(ex, "id").groupBy("sequence_id").agg(F.sum("n_tokens").alias("t"), F.sum("n_segments").alias("s"), F.sum("n_loss").alias("l"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == 200 and all(r.t <= 1024 and r.s <= 16 and r.l <= 512 for r in got)


def test_html():
    long = "And so it was that the end of the day was the end of the man and of the sea and all that is in it. " * 3
    page = f"<header>Top</header><div id='menu'><a href=x>Home</a></div><p>{long}<p>Short one.<p>{long}<div class='comments'><p>{long}not me</div><footer>c</footer>"
    assert htmltext.main_text(page) == f"{long}Short one. {long}".strip()
    assert htmltext.main_text("<article><h1>T</h1>x<div class='ad'>no</div>y<p>z <a href='q'>l</a> a&amp;b&#39;s <script>q<p>r</script></article><p>out") == "T x y z l a&b's"
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<script>x") == ""


def test_html_article_is_a_prior_only():
    long = "And so it was that the end of the day was the end of the man and of the sea and all that is in it. " * 3
    body = long.strip()
    cards = "".join(f"<article><h3><a href=x>Teaser number {i}</a></h3><p>A short word on the matter.</article>" for i in range(3))
    assert htmltext.main_text(f"<div><p>{long}<p>{long}</div>{cards}") == f"{body} {body}"
    # neighbours decide a block of links inside an article; one that is all links goes
    some = "<p>See <a href=x>the whole list of the other reports on this</a> now"
    assert htmltext.main_text(f"<article><p>{long}{some}<p>{long}</article>") == f"{body} See the whole list of the other reports on this now {body}"
    assert htmltext.main_text(f"<article><p>{long}<p><a href=x>Next</a><p>{long}</article>") == f"{body} {body}"
    # a word in a longer name is no verdict; a whole name is
    assert htmltext.main_text(f"<article><p>{long}<section id='related-work'><h2>Related work</h2><p>{long}</section></article>") == f"{body} Related work {body}"
    assert htmltext.main_text(f"<article><p>{long}<div class='box related'><p>{long}</div><div class='share-bar'>Share</div></article>") == body
    # what stands beside an article is judged as well
    assert htmltext.main_text(f"<article><p>{long}</article><p>{long}<p><a href=x>All pages</a>") == f"{body} {body}"
    # a language without known stop words rests on the prior
    assert htmltext.main_text("<article><p>" + "xyz " * 100 + "</article><p>out") == ("xyz " * 100).strip()


def test_html_query(spark):
    rows = queries.QUERIES["op5_html_text"](spark, SF).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(html) and all(r.n_chars == len(r.text) for r in rows)
    assert all("track(" not in r.text and "example." not in r.text and "<" not in r.text for r in rows)


def test_mixing(spark, odd, texts):
    rows = queries.QUERIES["op6_mixing"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.QUERIES["op6_mixing"](spark, SF).collect()))
    words = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for k, t in texts.items()}
    assert all(r.size == words[r.doc_id] and 0 <= r.taken <= 2 * r.size for r in rows) and len(rows) == len(words)
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = source[r.doc_id]
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert r.source_size and r.target <= 2 * r.source_size + 1e-6
    w = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(sorted(size))}
    left, open_, want = 1.5 * sum(size.values()), set(size), {}
    while True:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > 2 * size[s]}
        if not full:
            want |= {s: level * w[s] for s in open_}
            break
        want |= {s: 2.0 * size[s] for s in full}
        left -= sum(2 * size[s] for s in full)
        open_ -= full
    assert all(target[s] == pytest.approx(want[s]) for s in size)
    longest = max(r.size for r in rows)
    assert all(abs(taken[s] - target[s]) <= longest for s in size)
    out = mixing.apply_mix(spark, odd)
    plan = mixing.mix(spark, odd)
    assert out.columns == odd.columns and out.count() == plan.agg(F.sum("copies")).first()[0] and plan.count() == odd.count()
    assert mixing.mix(spark, odd.where("false")).count() == 0


def test_mixing_tree_has_levels(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 17).cast("int") + 1).alias("text"))
    got = mixing.mix(spark, docs, group=8).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect()
    assert all(abs(r.t - r.n) <= 17 for r in got)


def _components(texts, k, percent):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    owner = {i: i for i in sets}

    def find(i):
        while owner[i] != i:
            i = owner[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                owner[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_dedup(spark, odd, texts):
    want = _components(texts, 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op7_near_dedup"](spark, SF).collect()} == want
    out = setsketch.near_duplicates(spark, odd).collect()
    assert len(out) == odd.count() and {r.component_id for r in out if r.doc_id == 11} == {11} and setsketch.near_duplicates(spark, odd.where("false")).count() == 0


def test_near_dedup_of_a_group_without_a_centre(spark):
    import random

    r, base = random.Random(2), [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(120):
        w = list(base)
        for _ in range(r.randrange(1, 5)):
            w[r.randrange(120)] = f"x{r.randrange(10**6)}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {x.doc_id: x.component_id for x in setsketch.near_duplicates(spark, df).collect()} == {k: v[1] for k, v in _components(texts, 3, 85).items()}


def test_components_both_ways(spark):
    import random

    from quillwork.llm.common import Scratch
    from quillwork.llm.components import components

    r = random.Random(1)
    e = [(a, b) for a, b in ((r.randrange(300), r.randrange(300)) for _ in range(200)) if a != b] + [(1000 + i, 1001 + i) for i in range(40)]
    d = spark.createDataFrame(e, "a long, b long")
    assert sorted(map(tuple, components(Scratch(spark, "t"), "x", d).collect())) == sorted(map(tuple, components(Scratch(spark, "t"), "x", d, in_one=0).collect()))


def test_quality(spark, odd):
    got = {r.doc_id: r for r in quality.quality(spark, odd, percent=0, floor=5).collect()}
    assert got[9].n_words == 0 and got[9].base_failed and got[0].n_lost_words == 11 and got[10].n_repeat_words == 30_000
    body = " ".join(f"a{i}" for i in range(60))
    docs = spark.createDataFrame([(i, "h" if i < 6 else "g", body if i % 2 else f"{body}\n" + " ".join(f"{i}x{j}" for j in range(200))) for i in range(12)], "doc_id long, source string, text string")
    assert {r.doc_id for r in quality.quality(spark, docs, percent=0, floor=5).collect() if not r.kept} == {1, 3, 5, 7, 9, 11}
    assert quality.quality(spark, odd.where("false")).count() == 0


def test_quality_takes_lines_out(spark):
    rows = [(i, "h", f"own  {i}\n Shared\tLine \n\nlast {i}\nshared line") for i in range(6)] + [(6, "g", "shared line\nx"), (7, "h", None), (8, "h", "shared line"), (9, "h", "")]
    got = {r.doc_id: r for r in quality.quality(spark, spark.createDataFrame(rows, "doc_id long, source string, text string"), percent=0, floor=5).collect()}
    assert all((got[i].text, got[i].n_lost_words, got[i].n_words) == (f"own  {i}\n\nlast {i}", 4, 8) for i in range(6))
    assert (got[6].text, got[7].text, got[8].text, got[8].n_lost_words, got[9].text) == ("shared line\nx", None, "", 2, "")


def test_fingerprints(spark, odd, texts):
    rows = {r.doc_id: r for r in queries.QUERIES["op9_fingerprints"](spark, SF).collect()}
    ids, off = sorted(texts, reverse=True), []
    bag = lambda t: Counter(re.findall(r"[^\x20\x09-\x0D]+", t))
    for i, k in enumerate(ids):
        t, nxt, r = texts[k], texts[ids[(i + 1) % len(ids)]], rows[k]
        e = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        a, b = bag(t), bag(e)
        off.append(r.near_edited - sum((a & b).values()) / max(1, sum((a | b).values())))
    assert abs(sum(off) / len(off)) < 0.03 and max(map(abs, off)) < 0.45
    by_text = defaultdict(set)
    for k, t in texts.items():
        by_text[t].add(rows[k].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    out = cws.edited_pairs(spark, odd).collect()
    assert len(out) == odd.count() and {r.fingerprint for r in out if r.doc_id in (7, 8, 9)} == {""} and cws.edited_pairs(spark, odd.where("false")).count() == 0


def test_pipeline(spark, odd):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, SF)
        if name != "packing":
            assert out.columns == docs.columns
            kept = out
    assert corpus_pipeline.run(spark, SF).count() > 0
    rest = odd
    for _, stage in corpus_pipeline.STAGES:
        rest = stage(spark, rest, SF)
    assert rest.count() > 0


def test_pipeline_keeps_clashing_columns(spark, odd):
    import corpus_pipeline

    docs = odd.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c) for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert all(r[c] == f"{c}{'' if r.doc_id is None else r.doc_id}" for r in out.collect() for c in CLASHING), name


def test_mixing_without_ids(spark):
    """Rows without ids, equal ones among them: bounded groups, every source near its target, copies as planned."""
    n = 20_000
    docs = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"),
                                 F.when(F.col("id") % 2 == 0, "same words here").otherwise(F.concat(F.lit("w "), F.col("id").cast("string"))).alias("text"), F.col("id").alias("mark"))
    plan = {(r.source, r.mark): r.c for r in mixing.mix(spark, docs).groupBy("source", "mark").agg(F.sum("copies").alias("c")).collect()}
    per = mixing.mix(spark, docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in per) == n and all(abs(r.taken - r.target) <= 3 for r in per)
    out = mixing.apply_mix(spark, docs)
    got = {(r.source, r.h): r.c for r in out.groupBy("source", F.xxhash64("text").alias("h")).agg(F.count("*").alias("c")).collect()}
    assert got == {k: c for k, c in plan.items() if c}
    same = out.where("text = 'same words here' and source = 'b'").groupBy("mark").count().agg(F.max("count") - F.min("count"), F.min("count")).first()
    assert same[0] <= 1 and out.columns == docs.columns


def test_copies_stay_in_their_source(spark):
    docs = spark.createDataFrame([(1, "s1", "a b c d e f g h"), (1, "s2", "x")] + [(2, "s1", "q r s")], "doc_id long, source string, text string")
    plan = {(r.source, r.size): r.copies for r in mixing.mix(spark, docs).collect()}
    got = Counter((r.source, len(r.text.split())) for r in mixing.apply_mix(spark, docs).collect())
    assert got == Counter({k: c for k, c in plan.items() if c})


def test_tokens_as_the_library_gives_them(spark):
    """Against a fresh tokenizer: added tokens keep the ids that the library gives them."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    model = read_model(default_path())
    fresh = Tokenizer.from_str(model)
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n\nb", "<|endoftext", "x <|EndOfText|> y", "", " <|endoftext|> é 日本", "plain words here\nand there 12's"]
    got = Encoder(model).encode_all(pa.array([*texts, None]))
    assert [bytes(g) for g in got[:-1]] == [b"".join(i.to_bytes(4, "little") for i in fresh.encode(t, add_special_tokens=False).ids) + END for t in texts]
    assert 50256 in fresh.encode(texts[0], add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.ids_crc32 for r in tokenfile.token_table(spark, docs).collect()}
    assert all(rows[i] == zlib.crc32(bytes(g)) for i, g in enumerate(got[:-1]))


def test_pipeline_near_dedup_goes_by_row(spark):
    import corpus_pipeline

    text = lambda c: " ".join(f"{c}{j}" for j in range(60))
    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (1, text("d")), (1, text("e")), (2, text("e") + " more"), (3, text("c") + " more"), (4, text("f")), (4, text("f")), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert out.columns == docs.columns
    want = [(None, text("a")), (None, text("b")), (3, text("c") + " more"), (1, text("d")), (1, text("e")), (4, text("f")), (None, None), (None, "")]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(want)

"""Small cases worked by hand, and properties against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quillwork.functions import exprs as X
from quillwork.operators import attribution as A
from quillwork.operators import core, graph, mentions, review, vectors
from quillwork.sources import io
from quillwork.streaming import streams


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_scalars(spark):
    lit = F.lit
    got = one(spark, X.clean(lit('  "Hi,  there." ')), X.norm_tokens(lit("It's A-1!")), X.safe_name(lit("a b/c")), X.unescape(lit("<b>x</b> &amp; &lt;y&gt;")), X.vtt_seconds(lit("01:02:03.500")))
    assert got == ("Hi,  there".replace("  ", " "), "it s a 1", "a_b_c", "x & <y>", 3723.5)
    assert one(spark, X.failure_class(lit("a spot of trouble")), X.failure_class(lit("needs a PO token")), X.priority(lit(47), lit(False))) == ("OTHER", "PO_TOKEN", "HIGH")
    d = spark.range(1).select(X.date_with_precision(lit("20260919")).alias("a"), X.date_with_precision(lit("1000")).alias("b"), X.date_with_precision(lit("x")).alias("c")).first()
    assert (str(d.a.date), d.a.precision, d.b.precision, d.c.precision) == ("2026-09-19", "DATE", "TIMESTAMP", "UNKNOWN")
    assert one(spark, X.overlap_suffix_prefix(F.split(lit("a b c d"), " "), F.split(lit("c d e"), " "), 30))[0] == 2


def test_edge_weights(spark):
    w = lambda k, c, e, p: one(spark, X.edge_weight(F.lit(k), F.lit(c), F.lit(e), F.lit(p)))[0]
    assert w("OWNS", "HIGH", 1, 0) == pytest.approx(10 * (1 + math.log(2) / 3))
    assert w("whatever", None, None, None) == pytest.approx(0.85 * (1 + math.log(2) / 3))
    assert one(spark, X.motif_strength(*[F.lit(x) for x in (1, 1, 1, 1, 1)]))[0] == pytest.approx(35.70, abs=0.01)


def test_interval_join_is_the_cross_join(spark):
    r = random.Random(4)
    span = lambda i: (i, r.randrange(2), s := r.uniform(0, 50), s + r.uniform(0, 9))
    a, b = [span(i) for i in range(60)], [span(i) for i in range(60)]
    da, db = spark.createDataFrame(a, "i int, k int, s double, e double"), spark.createDataFrame(b, "j int, k int, bs double, be double")
    want = {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and min(x[3], y[3]) - max(x[2], y[2]) > 0}
    for width in (0.7, 5.0, 100.0):
        got = [(x.i, x.j) for x in core.interval_join(da, db, ["k"], ("s", "e"), ("bs", "be"), width).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_interval_union_and_upsert(spark):
    s = spark.createDataFrame([("u", 0.0, 2.0), ("u", 1.0, 3.0), ("u", 5.0, 6.0)], "u string, s double, e double")
    assert core.interval_union(s, ["u"], "s", "e").first().union_length == 4.0
    old, new = spark.createDataFrame([(1, "x"), (2, "y")], "k int, t string"), spark.createDataFrame([(1, ""), (3, "z")], "k int, t string")
    assert sorted(core.upsert(old, new, ["k"], keep_filled=True).collect()) == [(1, "x"), (2, "y"), (3, "z")]
    assert sorted(core.upsert(old, new, ["k"]).collect()) == [(1, ""), (2, "y"), (3, "z")]


def test_scd_merge(spark):
    kind = "k string, v int, source_status string, created_at int, last_seen_at int, superseded_at int"
    old = spark.createDataFrame([("a", 1, "CURRENT", 1, 1, None), ("b", 2, "CURRENT", 1, 1, None)], kind)
    new = spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int")
    got = {r.k: (r.source_status, r.created_at, r.last_seen_at, r.superseded_at) for r in core.scd_merge(old, new, "k", F.lit(2)).collect()}
    assert got == {"a": ("SUPERSEDED", 1, 1, 2), "b": ("CURRENT", 1, 2, None), "c": ("CURRENT", 2, 2, None)}


def test_dense_attribution(spark):
    cues = spark.createDataFrame([("V", 0, 1.0, 2.0), ("V", 1, 3.0, 4.0), ("V", 2, 90.0, 91.0)], "content_id string, cue_index int, start double, end double")
    segs = spark.createDataFrame([("V", "A", 0.8, 2.2), ("V", "A", 3.0, 3.5), ("V", "B", 3.5, 4.0)], "content_id string, speaker string, seg_start double, seg_end double")
    got = {r.cue_index: r for r in A.dense(cues, segs).collect()}
    assert (got[0].status, got[0].coverage, got[0].speakers) == ("ATTRIBUTED_HIGH", 1.0, 1)
    assert (got[1].status, got[1].first_share, got[1].second_share) == ("AMBIGUOUS", 0.5, 0.5)
    assert got[2].status == "NO_SPEECH_MATCH"


def test_unit_vote(spark):
    units = spark.createDataFrame([("V", "u", 10.5, 15.5)], "content_id string, unit_id string, start double, end double")
    cues = spark.createDataFrame(
        [("V", 10.0, 14.0, "ATTRIBUTED_HIGH", [("S", 1.0)], "S", 1), ("V", 12.0, 16.0, "ATTRIBUTED_HIGH", [("S", 1.0)], "S", 2)],
        "content_id string, c_start double, c_end double, status string, candidates array<struct<speaker_id:string,share:double>>, raw_speaker string, seq int")
    r = A.unit_vote(units, cues).first()
    assert (r.speaker, r.score, r.coverage, r.status) == ("S", 7.0, 1.0, "ATTRIBUTED_HIGH")


def test_sparse_attribution(spark):
    samples = spark.createDataFrame([("V", 100, 10.0, "v1"), ("V", 101, 70.0, "v1"), ("V", 102, 200.0, "v2")], "content_id string, sample_cue int, t double, voice string")
    cues = spark.createDataFrame([("V", 1, 40.0), ("V", 2, 130.0), ("V", 3, 300.0), ("V", 102, 200.0), ("W", 1, 5.0)], "content_id string, cue_index int, t double")
    got = {(r.content_id, r.cue_index): r.status for r in A.sparse(cues, samples).collect()}
    assert got == {("V", 1): "ATTRIBUTED_HIGH", ("V", 2): "AMBIGUOUS", ("V", 3): "AMBIGUOUS", ("V", 102): "ATTRIBUTED_HIGH", ("W", 1): "NO_SPEECH_MATCH"}
    far = spark.createDataFrame([("V", 1, 10.0, "v1"), ("V", 2, 400.0, "v2")], samples.schema)
    assert A.sparse(spark.createDataFrame([("V", 9, 40.0)], cues.schema), far).first().method == "sparse_conflicting_bracket"


def test_overlap_marking(spark):
    s = spark.createDataFrame([("V", 0, "A", 0.0, 5.0), ("V", 1, "B", 4.0, 6.0), ("V", 2, "A", 5.5, 7.0), ("V", 3, "B", 9.0, 9.5)], "content_id string, seg_id int, speaker string, start double, end double")
    assert {r.seg_id for r in A.mark_overlap(s).where("overlap").collect()} == {0, 1, 2}


def test_caption_fold(spark):
    phrases = ["the harbour lights went out", "before the storm came in", "and nobody on the pier", "could see the boats return"]
    cues, said = [], []
    for i, p in enumerate(phrases):
        text = (phrases[i - 1] + " " if i else "") + p
        cues += [("c", 2 * i, 2.0 * i, 2.0 * i + 1.9, text), ("c", 2 * i + 1, 2.0 * i + 1.9, 2.0 * i + 1.91, p)]
        said += text.split() + p.split()
    df = spark.createDataFrame(cues, "content_id string, cue_index int, start double, end double, text string")
    text = " ".join(r.text for r in A.caption_fold(df).orderBy("start").collect())
    assert all(text.count(p) == 1 for p in phrases) and len(text.split()) < 0.65 * len(said)


def fold_plainly(cues, cap=42, gap=1.75):
    """The rules of caption folding for one content's cues (start, end, text) in order, one token after the other."""
    import difflib
    import re

    norm = lambda w: re.sub(r"[^a-z0-9@_'-]+", "", w.lower().replace("’", "'")) or w.lower()
    tokens, said = [], []
    for start, end, text in cues:
        start = start or 0.0
        end = end or start
        words = (text or "").split()
        own = [norm(w) for w in words]
        most = min(len(own), len(said), 96)
        same = [k for k in range(1, most + 1) if said[len(said) - k :] == own[:k]]
        near = [k for k in range(4, most + 1) if difflib.SequenceMatcher(None, said[len(said) - k :], own[:k], autojunk=False).ratio() >= 0.92] if not same else []
        skip = max(same or near or [0])
        length = max(0.001, end - start)
        for j in range(skip, len(words)):
            tokens.append((start + length * (j / len(words)), start + length * ((j + 1) / len(words)), words[j]))
            said.append(own[j])
    out, here = [], []
    for i, (a, z, w) in enumerate(tokens):
        here.append((a, z, w))
        pause = i + 1 < len(tokens) and tokens[i + 1][0] - z > gap
        if re.search(r"[.!?][\"')\]]*$", w) or len(here) == cap or pause or i + 1 == len(tokens):
            out.append((here[0][0], here[-1][1], " ".join(x[2] for x in here)))
            here = []
    return out


def test_caption_fold_against_the_plain_rules(spark):
    from collections import defaultdict

    from quillwork.plans.domain_queries import cues

    odd = [("q", 0, 0.0, 8.0, "slow words here now"), ("q", 1, 8.0, 9.0, 'he said "stop." and left again today'), ("r", 0, None, None, "no times"), ("r", 1, 3.0, 0.0, "an end of zero"), ("r", 2, 9.0, 9.5, None), ("r", 3, 10.0, 11.0, "it’s user@home a_b x-y (ok?) [yes.]"),
           ("r", 4, 11.0, 12.0, "IT'S user@home a_b x-y (ok?) [yes.] and more " + "word " * 100)]
    odd += [("t", i, 2.0 * i, 2.0 * i + 2, " ".join(f"w{j}" for j in range(5 * i, 5 * i + 12)).replace("w7", "w7x" if i else "w7")) for i in range(20)]
    df = cues(spark, "/root/testdata/sf0.001").unionByName(spark.createDataFrame(odd, "content_id string, cue_index int, start double, end double, text string"))
    own = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r.cue_index):
        own[r.content_id].append((r.start, r.end, r.text))
    got = defaultdict(list)
    for r in A.caption_fold(df).orderBy("content_id", "run", "part").collect():
        got[r.content_id].append((r.start, r.end, r.text))
    assert len(got["q"]) == 2
    for k, rows in own.items():
        want = fold_plainly(rows)
        assert [t for _, _, t in got[k]] == [t for _, _, t in want], k
        assert all(abs(g[i] - w[i]) < 1e-9 for g, w in zip(got[k], want, strict=True) for i in (0, 1)), k


def test_references_as_the_standard_library(spark):
    import html

    texts = ["it&#8217;s caf&eacute; &#x27;x", "&amp;amp; &lt;b&gt; &AMP &copy2 &notit; &notin; &NotEqualTilde; &zzz; &; & && &#; &#x; &#xZ", "&#0; &#13; &#128; &#129; &#x7f; &#x1F600; &#xD800; &#1114112; &#99999999999; &#11; &#xFFFE; &#00065;", "plain", "", "&bne;&fjlig;&nbsp;|", "&ampx &ltx;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = {r.i: r.d for r in df.select("i", X.references(F.col("t")).alias("d")).collect()}
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts] and got[len(texts)] is None


def test_unit_ids_in_the_order_of_the_parts(spark):
    import hashlib

    seg = spark.createDataFrame([("V1", "ab12", 3, 4, 7, "One here. Two there!", "P")], "content_id string, source_sha string, cue_index int, start int, end int, text string, speaker_id string")
    got = [(r.text, r.unit_id) for r in mentions.unit_ledger(seg).orderBy("sentence_index").collect()]
    want = [(t, "TU_" + hashlib.sha256("\x1f".join(["ab12", "V1", "4", "7", "P", t, str(i), "caption_overlap_v2"]).encode()).hexdigest()[:24].upper()) for i, t in enumerate(["One here.", "Two there!"])]
    assert got == want


def test_sampling_plan(spark):
    cues = spark.createDataFrame([("V", i, 20.0 * i, 20.0 * i + 20, "one two three") for i in range(10)], "content_id string, cue_index int, start double, end double, text string")
    assert [r.cue_index for r in A.sampling_plan(cues).orderBy("cue_index").collect()] == [0, 2, 6, 9]


def test_mentions(spark):
    names = lambda t: {x[0] for x in mentions.spans_of(t)}
    assert "Mara Quill" in names("We had an interview with Mara Quill after lunch.")
    assert "Acme Labs" in names("He runs a company called Acme Labs in town.")
    assert {"Mara Quill", "Tom Reed"} <= names("I met Mara Quill and Tom Reed yesterday.")
    assert "Mara Quill" in names("I trust Mara Quill. I do.")
    assert not names("However it rained.") and not names("It's taking place in june.")
    assert "jane doe" in names("an interview with jane doe because she asked") and not names("He saw the website in town.")
    seg = spark.createDataFrame([("s1", "c1", "cap", "p1", "We spoke to Mara Quill and saw www.acme.org today"), ("s2", "c2", "cap", "p2", "Then Mara Quill left")], "seg_id string, content_id string, source_type string, speaker_id string, text string")
    ev = mentions.evidence(seg)
    known = spark.createDataFrame([("mara quill", "E1")], "alias string, canonical_id string")
    got = {r.candidate_key: r for r in mentions.candidates(ev, known).collect()}
    assert got["mara quill"].priority == "EXISTING" and got["mara quill"].contents == 2 and "www acme org" in got
    assert mentions.comentions(ev).count() == 1
    hits = mentions.alias_mentions(seg, known.selectExpr("alias", "canonical_id", "'n' name", "'p' kind")).collect()
    assert len(hits) == 2


def test_aliases_of_any_length(spark):
    known = spark.createDataFrame([("the very long name of a thing and more", "E1", "n", "p"), ("thing", "E2", "n", "p")], "alias string, canonical_id string, name string, kind string")
    seg = spark.createDataFrame([(1, "So the very long name of a Thing and more.")], "seg_id int, text string")
    assert sorted((r.word_no, r.canonical_id) for r in mentions.alias_mentions(seg, known).collect()) == [(1, "E1"), (7, "E2")]


def test_dictionary_is_whole(spark):
    import re

    from quillwork.plans import domain_queries

    sf = "/root/testdata/sf0.001"
    want = {w.lower() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in r.text.split(" ") if re.fullmatch("[A-Z][a-z]{3,}", w)}
    assert len(want) > 10 and {r.alias for r in domain_queries.known(spark, sf).collect()} == want


def test_resolution_queue_misses_no_pair(spark):
    from difflib import SequenceMatcher

    r = random.Random(7)
    word = lambda: "".join(r.choice("abcde j'") for _ in range(r.randrange(1, 9)))
    keys = {" ".join(w.split()) for w in ["jon", "abc", "lisa", *[word() for _ in range(60)]]} - {""}
    names = {i: " ".join(w.split()) for i, w in enumerate(["jn", "axbxc", "lsia", "jn", *[word() for _ in range(60)]])}
    m = spark.createDataFrame([(k, "c", "t", i) for i, k in enumerate(sorted(keys))], "surface string, content_id string, entity_type string, seq int")
    got = {x.key: [(c.entity_id, c.sim) for c in x.candidates or []] for x in mentions.resolution_queue(m, spark.createDataFrame(list(names.items()), "entity_id int, name string")).collect()}
    for k in keys:
        all_ = [(i, SequenceMatcher(None, k, n).ratio()) for i, n in names.items() if n]
        assert got[k] == sorted([x for x in all_ if x[1] >= 0.62], key=lambda x: (-x[1], -x[0]))[:5]


def test_resolution_queue(spark):
    m = spark.createDataFrame([("Jon Smithe", "c1", "person", 1), ("Jon Smithe", "c2", "person", 2), ("Zzz", "c1", "x", 3)], "surface string, content_id string, entity_type string, seq int")
    n = spark.createDataFrame([("E1", "John Smith"), ("E2", "Unrelated Name")], "entity_id string, name string")
    got = {r.key: r for r in mentions.resolution_queue(m, n).collect()}
    assert got["jon smithe"].candidates[0].entity_id == "E1" and got["jon smithe"].mentions == 2 and got["zzz"].candidates is None


def test_voice_matching_and_fusion(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [0.999, 0.02, 0.0]), (3, [0.0, 1.0, 0.0])], "id long, vec array<double>")
    pairs = vectors.canonical_pairs(vectors.blocks_topk(v, v, 5, 0.8))
    assert [(r.left_id, r.right_id) for r in pairs.collect()] == [(1, 2)]
    again = vectors.incremental(spark, v.withColumn("matched_at", F.lit(1)), pairs.select("left_id", "right_id"), 5, 0.8)
    assert again.count() == 0
    pairs = pairs.withColumn("status", F.lit("OPEN"))
    clues = spark.createDataFrame([(2, "E", "", "HOST_INTRODUCTION", 0.95, "c1")], "cluster_id long, entity_id string, name string, evidence_type string, weight double, content_id string")
    bind = spark.createDataFrame([(1, "E", "", "VERIFIED")], "cluster_id long, entity_id string, name string, binding_status string")
    r = vectors.fuse(clues, pairs, bind).collect()
    assert len(r) == 1 and r[0].status == "HIGH_CONFIDENCE_CANDIDATE" and r[0].context == pytest.approx(0.95) and r[0].combined == 1.0
    half = spark.createDataFrame([(7, "E", "", "TRANSCRIPT_CONTEXT", 0.5, "a"), (7, "E", "", "SELF_IDENTIFICATION", 1.0, "b")], clues.schema)
    assert vectors.fuse(half, pairs, bind.where("false")).first().context == 1.0
    assert vectors.fuse(clues.where("false"), pairs, bind).first().status == "ACOUSTIC_CANDIDATE"


def test_graph(spark):
    path = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 3.0)], "src string, dst string, weight double")
    comm = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "node string, community int")
    p = {r.node: r.participation for r in graph.participation(graph.membership(path, comm)).collect()}
    assert p == {"a": pytest.approx(0), "b": pytest.approx(0.375), "c": pytest.approx(0)}
    unit = path.withColumn("weight", F.lit(1.0))
    assert {r.node: r.betweenness for r in graph.betweenness(unit).collect()} == {"a": 0.0, "b": 1.0, "c": 0.0}
    two = [("a", "b"), ("b", "c"), ("a", "c"), ("d", "e"), ("e", "f"), ("d", "f"), ("c", "d")]
    tri = spark.createDataFrame([(x, y, 1.0) for x, y in two], "src string, dst string, weight double")
    lv = graph.louvain(tri.withColumn("s", F.lit(1)), ["s"])
    assert {r.node: r.community for r in lv.collect()} == {**dict.fromkeys("abc", "a"), **dict.fromkeys("def", "d")}
    assert graph.modularity(tri, lv.select("node", "community")).first().q == pytest.approx(2 * (3 / 7 - 0.25))
    assert sum(r["rank"] for r in graph.pagerank(tri, 10).collect()) == pytest.approx(1.0)
    assert graph.ego(tri, "a", 1).count() == 3


def test_edges_filter(spark):
    kind = "source_id string, target_id string, relationship_type string, confidence string, evidence_count int, primary_source_count int, status string"
    raw = spark.createDataFrame([
        ("a", "b", "OWNS", "HIGH", 1, 0, ""), ("b", "a", "SELLS", "", 2, 0, "ACTIVE"), ("a", "c", "OWNS", "", 1, 0, "REJECTED"), ("a", "d", "OWNS", "", 1, 0, "OTHER"),
        ("a", "a", "OWNS", "", 1, 0, ""), ("a", "e", "IDEOLOGICAL_TOPICAL", "", 1, 0, "")], kind)
    r = graph.build_edges(raw).collect()
    assert [(x.src, x.dst, x.evidence, x.types) for x in r] == [("a", "b", 3.0, ["OWNS", "SELLS"])]


def test_lineage(spark):
    side = lambda d: spark.createDataFrame([(c, n, 1.0) for c, ns in d.items() for n in ns], "community string, node int, share double")
    big, parts = side({"x": [1, 2, 3, 4]}), side({"p": [1, 2], "q": [3, 4]})
    kinds = lambda a, b: sorted(r.kind for r in graph.lineage(a, b).collect())
    assert kinds(big, parts) == ["SPLIT", "SPLIT"] and kinds(parts, big) == ["MERGE", "MERGE"]
    assert kinds(big, side({"z": [9]})) == ["BIRTH", "DEATH"] and kinds(big, big) == ["CONTINUE"]


def test_motifs(spark):
    raw = spark.createDataFrame([("a", "b", "", "s1;s2"), ("b", "a", "OTHER", "s2"), ("a", "c", "REJECTED", "")], "source_id string, target_id string, status string, source_ids string")
    st = spark.createDataFrame(
        [("e1", "a", "x", "CRITICIZES", "", "c1"), ("e2", "a", "x", "PRAISES", "ADOPTS", "c1"), ("e3", "b", "x", "OPPOSES", None, "c2"), ("e4", "c", "x", "OPPOSES", "", "c2"), ("e5", "b", "x", "OPPOSES", "REJECTS", "c3")],
        "stance_event_id string, source_entity_id string, target_entity_id string, stance_type string, speaker_adoption string, content_id string")
    own = graph.own_stances(st)
    m = graph.wedge_motifs(graph.relation_pairs(raw), own)
    r = m.collect()
    assert [(x.motif_type, x.node_ids, x.edge_event_ids, x.source_ids) for x in r] == [("SHARED_ADVERSARY_CONNECTED", '["a","b","x"]', '["e1","e2","e3"]', '["s1","s2"]')]
    assert r[0].signal_strength == round(12 * (1.5 * math.log(3) + math.log(3) + math.log(2) + 0.5 * math.log(3)), 2)
    assert [x.node_ids for x in graph.reversals(own).collect()] == ['["a","x"]']
    prior = spark.createDataFrame([(r[0].motif_id, "ACCEPTED", "n")], "motif_id string, status string, notes string")
    assert graph.carry_review(m, prior).first().status == "ACCEPTED"


def test_unit_completion_and_gates(spark):
    claims = spark.createDataFrame([("k1", "u1", "CHECKABLE", "VERIFIED"), ("k2", "u1", "OPINION", "PENDING"), ("k3", "u2", "PARTLY_CHECKABLE", "PENDING")], "claim_id string, unit_id string, checkability string, fact_check_status string")
    units = spark.createDataFrame([("u1", "COMPLETE", ""), ("u2", "COMPLETE", ""), ("u3", "COMPLETE", ""), ("u4", "", "x")], "unit_id string, semantic_status string, fact_status string")
    assert {r.unit_id: r.fact_status for r in review.unit_completion(units, claims).collect()} == {"u1": "COMPLETE", "u2": "PENDING", "u3": "NOT_APPLICABLE", "u4": "x"}
    assert [r.claim_id for r in review.fact_queue(claims).collect()] == ["k3"]
    ev = spark.createDataFrame([("e1",), ("e2",)], "semantic_event_id string")
    ver = spark.createDataFrame([("e1", "VERIFIED_TEXT")], "semantic_event_id string, status string")
    assert review.verified(ev, ver).count() == 1 and review.verified(ev, ver.where("false")).count() == 0


def test_scores(spark):
    i = lambda *x: spark.createDataFrame(list(x), "case_id string, item string")
    r = review.scores(i(("1", "a"), ("1", "b")), i(("1", "b"), ("1", "c"), ("9", "z")), ["case_id"]).collect()
    assert len(r) == 1 and (r[0].precision, r[0].recall, r[0].f1) == (0.5, 0.5, 0.5)
    s = review.safety(spark.createDataFrame([("WRONG_CLAIMANT",), ("odd",)], "code string")).first()
    assert (s.errors, s.penalty, s.safety_score) == (2, 20.0, 80.0)


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfid,name,extra\n1,\"x, y\",z\n2,,w\n")
    r = io.read_csv(spark, str(tmp_path / "a.csv"), "id int, name string, missing string").orderBy("id").collect()
    assert [tuple(x) for x in r] == [(1, "x, y", None), (2, None, None)]
    assert io.read_csv(spark, str(tmp_path / "none.csv"), "id int").count() == 0
    d = tmp_path / "YT001" / "normalized"
    d.mkdir(parents=True)
    (d / "vid1.segments.jsonl").write_text('{"start": 1, "end": 2, "text": "a"}\n\nnot json\n{"start": 3, "text": "b"}\n')
    seg = io.production_only(io.segment_scan(spark, str(tmp_path))).orderBy("cue_index").collect()
    assert [(x.content_id, x.cue_index, x.start, x.end, x.text) for x in seg] == [("vid1", 0, 1.0, 2.0, "a"), ("vid1", 3, 3.0, 3.0, "b")]
    vtt = "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n<c>Hello</c> &amp; hi\n\n00:00:02.000 --> 00:00:03.000\nHello & hi\n\n00:00:03.000 --> 00:00:04.000\nBye\n"
    got = io.vtt_cues(spark.createDataFrame([("v", vtt)], "content_id string, value string")).orderBy("cue_index").collect()
    assert [(x.start, x.end, x.text) for x in got] == [(1.0, 3.0, "Hello & hi"), (3.0, 4.0, "Bye")]


def test_queue(spark):
    log = spark.createDataFrame([("j1", 1, "enqueue", 0.0, 0.0), ("j1", 2, "lease", 1.0, 10.0), ("j1", 3, "complete", 2.0, 0.0), ("j2", 1, "enqueue", 0.0, 0.0), ("j2", 2, "lease", 1.0, 10.0), ("j3", 1, "enqueue", 0.0, 0.0)], "job_id string, seq int, event string, at double, seconds double")
    st = streams.job_states(log)
    got = {r.job_id: (r.state, r.attempts, r.expires) for r in st.collect()}
    assert got == {"j1": ("done", 1, None), "j2": ("leased", 1, 31.0), "j3": ("queued", 0, None)}
    assert {r.job_id: r.state for r in streams.reclaim(st, 40.0).collect()}["j2"] == "queued"
    jobs = spark.createDataFrame([("j1", "cpu", 5, "p"), ("j2", "cpu", 1, "p"), ("j3", "cpu", 9, "p")], "job_id string, lane string, priority int, parent_id string")
    assert streams.next_jobs(jobs, st).first().job_id == "j3" and streams.fan_in(jobs, st).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "events"
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.repartition(3).write.parquet(str(src))
    s = streams.read_events(spark, str(src))
    got = streams.run_now(streams.windowed_counts(s, late="60 days"), f"file://{tmp_path}/run", "complete")
    want = streams.windowed_counts(e)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

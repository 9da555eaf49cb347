"""Records, selection, dedup rounds, evaluation, files and streams: hand-worked cases with nulls, ties and empty tables."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillwork.functions import text as tx
from quillwork.operators import chunking, corpus, evaluation, funnel, graph, passages, retrieval, similarity
from quillwork.sources import files
from quillwork.sources.scratch import release, scratch, stash


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("href", "want"),
    [("C++%20(lang)", "c++ (lang)"), ("File:x.png", None), ("wikt:word", None), ("A#b", None), ("", None), (None, None), ("100%_pure", "100%_pure"), ("\tFoo\n", "foo"), ("100%_a%20b", "100%_a b"), ("%C3%89t%C3%A9", "été"), ("\xa0x", "x"), ("%", "%"), ("%2", "%2")],
)
def test_link_target(spark, href, want):
    assert one(spark, tx.link_target(F.lit(href).cast("string"))) == want


def test_words_and_answers(spark):
    assert [one(spark, tx.word_count(F.lit(t).cast("string"))) for t in ("", "  a  b ", "a\xa0b", None)] == [0, 2, 2, 0]
    f1, em = evaluation.answer_scores(F.lit("the U.S. Army"), F.lit("US Army"))
    assert one(spark, F.round(f1, 6)) == 0.4 and one(spark, em) == 0.0
    f1, em = evaluation.answer_scores(F.lit(""), F.lit("the"))
    assert one(spark, f1) == 0.0 and one(spark, em) == 1.0
    f1, _ = evaluation.answer_scores(F.lit("x x y"), F.lit("x y y"))
    assert one(spark, F.round(f1, 6)) == 0.666667


def test_histogram(spark):
    df = spark.createDataFrame([(7,), (8,), (60,), (200,)], "n int")
    assert df.agg(evaluation.histogram(F.col("n"), [0, 8, 12, 16, 20, 30, 60]).alias("h")).first().h == [1, 1, 0, 0, 0, 2]
    assert df.filter("n < 0").agg(evaluation.mean(F.col("n"), 2).alias("m")).first().m == 0.0


def reference_ranges(counts, least, most, o1, o2):
    """The rule sentence by sentence."""
    if not counts or sum(counts) <= most:
        return [(0, len(counts))] if counts else []
    out, i = [], 0
    while True:
        j = i + 1
        while j < len(counts) and sum(counts[i:j]) < (least + most) // 2 and sum(counts[i : j + 1]) <= most:
            j += 1
        out.append((i, j))
        if j >= len(counts):
            return out
        k = j
        while k > i + 1 and sum(counts[k:j]) < (o1 + o2) // 2:
            k -= 1
        i = max(i + 1, k)


def test_ranges_by_rule():
    g = random.Random(1)
    for _ in range(500):
        counts = [g.choice([1, 5, 30, 80, 250, 400]) for _ in range(g.randint(0, 30))]
        assert chunking.ranges(counts, 150, 300, 30, 50) == reference_ranges(counts, 150, 300, 30, 50), counts


def test_sections_and_chunks(spark):
    raw = "intro\n== One ==\ntext\n\n===  Two words ===\nmore == no ==\n==Three==\n"
    heads = one(spark, chunking.sections(F.lit(raw)))
    assert [(h.start, h.title) for h in heads] == [(6, "One"), (21, "Two words"), (55, "Three")]
    got = [one(spark, chunking.section_at(chunking.sections(F.lit(raw)), F.lit(o))) for o in (0, 5, 6, 20, 21, 54, 99)]
    assert got == [None, None, "One", "One", "Two words", "Two words", "Three"]
    docs = spark.createDataFrame([(7, "A b. C d.", raw), (8, None, None), (9, " ", "x"), (None, "Z.", None)], "doc_id long, text string, raw string")
    rows = {r.doc_id: r for r in chunking.chunks(docs).collect()}
    assert set(rows) == {7, None} and rows[7].chunk_id == "c_000007_000" and rows[7].section_title is None and rows[None].chunk_id is None
    assert chunking.chunks(docs.limit(0)).count() == 0


def test_graph_types_and_direct_links(spark):
    pages = [(1, "A", ["b", "s"], "x " * 300), (2, "B", ["a", "s"], "x " * 700), (3, None, None, None), (4, "", ["s", "s", "a"], "it led on in 1999 "), (5, "E", ["s"], "because of 2001 ")]
    a = spark.createDataFrame(pages, "page_id long, title string, links array<string>, article string")
    posts = graph.postings(a)
    idf = graph.weights(graph.frequencies(posts), 5, 10)
    e = graph.edges(posts, idf, graph.direct_links(a))
    rows = {(r.a, r.b): r for r in graph.path_score(e, graph.features(a), 2.0).collect()}
    assert rows[1, 2].direct and rows[1, 2].kind == "definition_application" and not rows[2, 5].direct
    assert rows[4, 5].kind == "temporal_chain" and rows[4, 5].bridge == "s" and rows[1, 4].direct
    only = spark.createDataFrame([(1, "A", ["b"]), (2, "B", ["a"])], "page_id long, title string, links array<string>")
    none = graph.frequencies(graph.postings(only)).withColumn("idf", F.lit(1.0)).limit(0)
    r = graph.edges(graph.postings(only), none, graph.direct_links(only)).first()
    assert (r.a, r.b, r.weight, r.direct, r.shared) == (1, 2, 4.0, True, [])
    assert graph.path_score(e.limit(0), graph.features(a), 2.0).count() == 0


def test_quality_of_paths(spark):
    s = graph.quality(F.array(*[F.lit(x) for x in "abcd"]), F.lit(0.5), 1.0, F.lit(False), F.lit(400), F.lit(500))
    assert one(spark, F.round(s, 6)) == 0.97
    assert one(spark, graph.quality(F.array().cast("array<string>"), F.lit(None).cast("double"), 1.0, F.lit(False), F.lit(1), F.lit(1))) == 0.0


def test_sample_by_five_types(spark):
    kinds = list(graph.TYPE_SHARES)
    rows = [(k * 1000 + i, k * 1000 + i + 1, "x", kinds[k], 1.0 - i / 1000) for k in range(5) for i in range(900)]
    got = graph.stratified(spark.createDataFrame(rows + rows[:5], "a long, b long, bridge string, kind string, score double"), graph.TYPE_SHARES, 1200)
    assert {r.kind: r["count"] for r in got.groupBy("kind").count().collect()} == {"bridge_entity": 720, "comparison": 420, "temporal_chain": 60}


def scan_keep(ids, pairs):
    kept = []
    for i in ids:
        if not any((k, i) in pairs for k in kept):
            kept.append(i)
    return kept


def scan_clusters(ids, scores, pairs):
    there = dict.fromkeys(ids, True)
    for i in ids:
        if there[i]:
            near = [i, *[j for j in ids if j > i and there[j] and (i, j) in pairs]]
            best = min(near, key=lambda j: (-(scores[j] or 0.0), j))
            there.update({j: j == best for j in near})
    return [i for i in ids if there[i]]


@pytest.mark.parametrize("seed", range(3))
def test_greedy_removal(spark, seed):
    g = random.Random(seed)
    ids = list(range(40))
    pairs = {(a, b) for a in ids for b in ids if a < b and g.random() < 0.07}
    frame = spark.createDataFrame([g.choice([(a, b), (b, a)]) for a, b in pairs] or [], "a long, b long")
    scores = {i: g.choice([None, 0.5, 0.5, 0.9, 0.1]) for i in ids}
    scored = spark.createDataFrame([(i, scores[i]) for i in ids], "id long, score double")
    assert sorted(r.id for r in similarity.greedy_keep(scored.select("id"), frame).collect()) == scan_keep(ids, pairs)
    assert sorted(r.id for r in similarity.cluster_keep(scored, frame).collect()) == scan_clusters(ids, scores, pairs)


def test_greedy_cases(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    rows = lambda *s: spark.createDataFrame(list(enumerate(s, 1)), "id long, score double")
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(similarity.greedy_keep(rows(0.0, 0.0, 0.0).select("id"), pairs)) == [1, 3]
    assert ids(similarity.cluster_keep(rows(0.5, 0.9, 0.7), pairs)) == [2]
    assert ids(similarity.cluster_keep(rows(0.9, 0.5, 0.7), pairs)) == [1, 3]
    assert ids(similarity.greedy_keep(rows(1.0).select("id"), pairs.limit(0))) == [1]


def test_vectors(spark):
    import numpy as np

    g = np.random.default_rng(3)
    v = g.standard_normal((150, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(999, None)], "id long, vec array<double>")
    got = {(r.a, r.b) for r in similarity.cosine_pairs(df, 0.6, 32).collect()}
    assert got == {(i, j) for i in range(150) for j in range(i + 1, 150) if v[i] @ v[j] >= 0.6}
    top = similarity.vector_topk(df.filter("id < 10"), df, 4, 32).collect()
    for q in range(10):
        s = np.round(v @ v[q], 6)
        want = [i for i in sorted(range(150), key=lambda i: (-s[i], i)) if i != q][:4]
        assert [r.doc for r in sorted((r for r in top if r["query"] == q), key=lambda r: r["rank"])] == want
    assert similarity.cosine_pairs(df.limit(0), 0.5).count() == 0 and similarity.vector_topk(df.limit(0), df, 3).count() == 0


def test_best_of_and_decisions(spark):
    cand = spark.createDataFrame([("p", 0, True, 0.2), ("p", 1, True, 0.9), ("p", 2, False, 1.0), ("q", 3, True, 1.0), ("r", 0, True, 0.5), ("r", 1, True, 0.5), ("s", 0, True, None), ("s", 4, True, 0.1), ("t", 0, False, 1.0), ("u", 0, True, 0.3), ("u", 1, True, 0.1)], "path string, idx int, valid boolean, heuristic double")
    verdict = spark.createDataFrame([("p", 0, False), ("r", -1, False), ("s", None, True), ("q", 5, True), ("u", 7, None)], "path string, best_index int, failed boolean")
    got = {r.path: (r.idx, r.judge) for r in funnel.best_of(cand, verdict).collect()}
    assert got == {"p": (0, 0.80), "q": (3, 0.65), "r": (0, 0.35), "s": (4, 0.55), "u": (0, 0.35)}
    assert {r.path for r in funnel.winners(cand, verdict).filter("single").collect()} == {"q"}
    assert one(spark, F.round(funnel.judge_blend(F.lit(0.8), F.lit(1.0)), 6)) == 0.86
    assert funnel.best_of(cand.limit(0), verdict).count() == 0


def test_validate(spark):
    spans = "array<struct<doc:bigint,spans:array<string>>>"
    rows = [
        (1, True, "Where does the red fox live?", "in\nwoods", "fox", [(5, ["the  woods", ""])]), (2, True, "Where is that", "It", "live", None), (3, None, "x", "x", "x", None),
        (4, True, "Does the red fox live in woods?", "red fox", "woods", [(5, ["absent"]), (9, ["a"]), (6, None)]), (5, True, None, None, None, []), (6, True, "Is a foxes den here now?", "fox", "", None),
    ]
    docs = spark.createDataFrame([(5, "in the\n woods"), (6, None)], "doc long, text string")
    got = {r.id: r.flags for r in funnel.validate(spark.createDataFrame(rows, f"id long, complete boolean, query string, short string, bridge string, spans {spans}"), docs).collect()}
    assert got == {1: [], 2: ["bad_question", "pronoun_answer"], 3: ["schema_invalid"], 4: ["answer_in_question", "bridge_in_question", "span_not_in_doc", "unknown_doc:9"], 5: ["bad_question"], 6: []}


def test_quality_of_records(spark):
    q = lambda *a: one(spark, F.round(funnel.quality_score(*a), 6))
    s = lambda t: F.lit(t).cast("string")
    full = q(s("Marie Curie"), s("Step 1: Document A. Step 2: Document B. step"), s("Who was it?"), F.array(F.lit("x"), F.lit("y")), F.array(F.lit(3), F.lit(2)), F.lit(1.0), F.lit(1.0))
    assert full == round(0.85 * (0.30 + 0.20 * 0.95 + 0.20 * 1.0 + 0.15 * 1.0 + 0.15 * 0.9) + 0.15, 6)
    bare = q(s(None), s(None), s(None), F.lit(None).cast("array<string>"), F.lit(None).cast("array<int>"), F.lit(0.0), F.lit(None).cast("double"))
    assert bare == round(0.85 * (0.30 * 0.7 + 0.20 * 0.3 + 0.20 * 0.4 + 0.15 * 0.4 + 0.15 * 0.3) + 0.15 * 0.65, 6)


def test_distractors(spark):
    dense = spark.createDataFrame([(1, d, 1.0 - d / 10) for d in range(6)], "query long, doc long, score double")
    lexical = spark.createDataFrame([(1, d, k + 1) for k, d in enumerate([0, 1, 2, 7])], "query long, doc long, rank int")
    gold = spark.createDataFrame([(1, 0), (1, 0)], "query long, doc long")
    got = [(r.doc, r.source) for r in retrieval.distractors(dense, lexical, gold).orderBy("place").collect()]
    assert got == [(1, "embedding"), (2, "embedding"), (7, "bm25")]


def test_measures_with_grades(spark):
    hits = spark.createDataFrame([(1, 9, 1), (1, 5, 2), (2, 4, 1)], "query long, doc long, rank int")
    gold = spark.createDataFrame([(1, 5, 3), (1, 6, 2), (2, 4, 2), (2, 8, 1)], "query long, doc long, grade int")
    assert tuple(retrieval.measures(hits, gold).first()) == (2, 0.75, 0.75, 1.0)
    assert tuple(retrieval.measures(hits, gold.limit(0)).first()) == (0, 0.0, 0.0, 0.0)


def test_corpus(spark):
    rows = [(1, "A", "", "x" * 500, ["b", "c", "b"]), (2, "B", "u", "x" * 600, ["a", "c", "File:z"]), (3, "b ", None, "x" * 700, ["a", "b", "zz"]), (4, None, None, None, None), (5, "C", None, "x" * 499, ["a", "b", "c"])]
    a = spark.createDataFrame(rows, "page_id long, title string, url string, article string, links array<string>")
    assert sorted(r.page_id for r in corpus.passes(a).collect()) == [1, 2, 3]
    assert sorted(r.page_id for r in corpus.one_per_title(a).collect()) == [1, 2, 4, 5]
    assert [r.page_id for r in corpus.bounded_scan(a, 2, 5).collect()] == [1, 2]
    assert corpus.seed_tokens(["The Big thing", "big THING here"]) == ["here", "thing"]
    scores = {r.page_id: (r.overlap, r.score) for r in corpus.rank_score(a, ["zz abcd"]).collect()}
    assert 4 not in scores and scores[1] == (1.0, 3.04) and scores[3][0] == round(2 / 3, 6)
    pool = corpus.best_ranked(a, corpus.rank_score(a, []), 4)
    d = {r.page_id: r.degree for r in corpus.degrees(pool).collect()}
    assert d == {1: 2, 2: 2, 3: 2, 5: 3}
    docs = {r.source_id: r for r in corpus.documents(a, F.col("page_id")).collect()}
    assert docs[1].url == "page:1" and docs[2].url == "u" and docs[1].links == ["b", "c", "b"] and docs[4].links == [] and docs[2].links == ["a", "c"]


def test_path_keys(spark):
    rows = [("old", ["doc_000124", "doc_000021"], "near-earth object"), ("keep", None, "x"), ("keep", ["a"], None)]
    got = [r.path_id for r in corpus.migrate_keys(spark.createDataFrame(rows, "path_id string, docs array<string>, bridge string"), "path_id", "docs", "bridge").collect()]
    assert got == ["p_2c1ad1602042", "keep", "keep"]


def test_blocks(spark):
    c = spark.createDataFrame([(1, i, f"t{i}" * 3) for i in range(5)] + [(2, 0, None)], "doc long, idx int, chunk_text string")
    docs = spark.createDataFrame([("p", 0, 2), ("p", 1, 1), ("p", 2, 7)], "path string, pos int, doc long")
    hinted = spark.createDataFrame([("p", 1, 3), ("p", 1, 3)], "path string, doc long, idx int")
    titles = spark.createDataFrame([(1, "One")], "doc long, title string")
    got = passages.documents_block(docs, c, hinted, titles, 3, 4).first().block
    assert got == '--- Document A (doc_id: 2, title: "") ---\n\n\n--- Document B (doc_id: 1, title: "One") ---\nt3t3\nt0t0\nt1t1\n\n--- Document C (doc_id: 7, title: "") ---\n'
    assert one(spark, passages.fill('{"a": {x}, {y}}', x=F.lit("{y}"), y=F.lit(None))) == '{"a": , }'


def test_gates_and_report(spark):
    none = spark.createDataFrame([], "reasoning_type string, quality_score double, hop_count int")
    got = {r.gate: (r.value, r["pass"]) for r in evaluation.gates(none, 10, 0.5, 0.7).collect()}
    assert got["multihop_rate"] == (0.0, False) and got["max_reasoning_type_share"] == (0.0, True) and got["reader_f1_max"] == (0.7, False)
    good = spark.createDataFrame([("a", 0.9, 2), ("b", None, None), ("c", 1.0, 3), (None, 1.0, 2)], "reasoning_type string, quality_score double, hop_count int")
    g = evaluation.gates(good, 4, 0.1, 0.1)
    assert evaluation.escalation(g) == "escalate" and evaluation.escalation(evaluation.gates(none, 1, 0, 0)) == "stop"
    assert "| multihop_rate | 1 | 0.95 | True |" in evaluation.report("R", quality_gates=g)


def test_files(spark, tmp_path):
    (tmp_path / "base.json").write_text(json.dumps({"a": {"b": 1, "c": 2}, "d": [1], "extends": "none.json"}))
    (tmp_path / "own.json").write_text(json.dumps({"extends": "base.json", "a": {"c": 3}, "d": [2]}))
    assert files.settings(tmp_path, "any/own.json") == {"a": {"b": 1, "c": 3}, "d": [2], "extends": "none.json"}
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, t string")
    from quillwork.sources.tables import jsonl

    files.overwrite_jsonl(df, f"{tmp_path}/j")
    files.append_jsonl(df, f"{tmp_path}/j")
    (tmp_path / "j" / "bad.json").write_text('{"id": 7\n\n{"id": 9}\n')
    assert sorted(r.id for r in jsonl(spark, f"{tmp_path}/j", "id int, t string").collect()) == [1, 1, 2, 2, 9]
    files.overwrite_jsonl(df, f"{tmp_path}/j")
    assert jsonl(spark, f"{tmp_path}/j", "id int, t string").count() == 2
    files.write_vectors(spark.createDataFrame([("a", [1.0])], "id string, vec array<double>"), f"{tmp_path}/v")
    assert files.read_vectors(spark, f"{tmp_path}/v").first().vec == [1.0]
    run = files.Run(tmp_path / "state.json", ["one", "two"])
    assert run.phase("one", lambda: {"rows": 3}) == {"rows": 3}
    with pytest.raises(ZeroDivisionError):
        run.phase("two", lambda: 1 / 0)
    s = files.Run(tmp_path / "state.json", ["other"]).state()
    assert s["phases"]["one"]["status"] == "done" and s["phases"]["one"]["rows"] == 3 and s["phases"]["two"]["status"] == "failed" and "other" not in s["phases"]
    assert files.read_json(tmp_path / "missing.json") == {}


def test_scratch(spark):
    a = stash(spark.range(3))
    assert a.count() == 3 and scratch(spark) != scratch(spark)
    release(spark)
    with pytest.raises(Exception, match="(?i)exist|not found"):
        spark.read.parquet(a.inputFiles()[0]).count()


def test_streams(spark, tmp_path):
    from quillwork.streaming.groups import RESULT, append_new, complete_groups, completed, lines

    rows = [("p", "a", 2, False, "high"), ("q", "a", 2, True, None), ("p", "a", 2, True, "low"), ("p", "b", 2, False, None), ("r", "x", 1, True, "")]
    df = spark.createDataFrame(rows, RESULT)
    for i in range(len(rows)):
        df.filter(F.struct(*df.columns) == F.struct(*[F.lit(v).cast(t) for v, (_, t) in zip(rows[i], df.dtypes, strict=True)])).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    (tmp_path / "in" / "bad.json").write_text("{nothing\n")
    q = complete_groups(lines(spark, f"{tmp_path}/in", RESULT, 2)).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.path: sorted(r.docs) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"p": ["a", "b"], "r": ["x"]}
    assert {r.path for r in completed(df).collect()} == {"p", "r"}
    for k in (1, 2):  # the second run finds nothing new, not even with a new checkpoint
        append_new(lines(spark, f"{tmp_path}/in", RESULT), f"{tmp_path}/table", ["path", "doc"], f"{tmp_path}/append{k}").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/table").count() == 4


@pytest.mark.parametrize(("block", "most"), [(4096, 1_000_000), (7, 5)])
def test_cluster_removal_without_all_pairs(spark, tmp_path, monkeypatch, block, most):
    import numpy as np

    from quillwork.plans import catalogue

    g = np.random.default_rng(5)
    v = g.standard_normal((160, 6))
    v[100:130] = v[3]  # one large group of equal vectors
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    scores = [None if i % 7 == 0 else float(i % 3) for i in range(160)]
    df = spark.createDataFrame([(i, [float(x) for x in r], s) for i, (r, s) in enumerate(zip(v, scores, strict=True))] + [(999, None, 1.0)], "id long, vec array<double>, score double")
    pairs = {(i, j) for i in range(160) for j in range(i + 1, 160) if round(v[i] @ v[j], 6) >= 0.6}
    want = [*scan_clusters(range(160), scores, pairs), 999]
    assert sorted(r.id for r in similarity.vector_cluster_keep(df, 0.6, block, most).collect()) == want
    assert similarity.vector_cluster_keep(df.limit(0), 0.6).count() == 0
    monkeypatch.setattr(similarity, "cosine_pairs", None)  # the query needs no list of all pairs
    df.filter("vec is not null").select(F.col("id").alias("vec_id"), F.col("vec").alias("embedding"), (F.col("id") % 10).cast("int").alias("label")).write.parquet(f"{tmp_path}/embeddings.parquet")
    labels = [float(i % 10 % 3) for i in range(160)]
    near = {(i, j) for i in range(160) for j in range(i + 1, 160) if round(v[i] @ v[j], 6) >= 0.4}
    assert sorted(r.vec_id for r in catalogue.cosine_cluster_keep(spark, str(tmp_path)).collect()) == scan_clusters(range(160), labels, near)

import pytest
from pyspark.sql import functions as F

from quillwork.operators import chunking, funnel, graph, passages, retrieval, similarity
from quillwork.sources import scratch


def test_few_files(spark, tmp_path):
    spark.range(500).write.parquet(f"{tmp_path}/in")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(kept, ("64", "false"), strict=True):
            spark.conf.set(k, v)
        out = scratch.stash(spark.read.parquet(f"{tmp_path}/in").groupBy("id").agg(F.count(F.lit(1)).alias("n")))
        assert len(out.inputFiles()) <= 8  # two for each core, not one for each of the 64 partitions
        assert sorted(map(tuple, out.collect())) == [(i, 1) for i in range(500)]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_ranges():
    assert chunking.ranges([50] * 10, 150, 300, 30, 50) == [(0, 5), (4, 9), (8, 10)]
    assert chunking.ranges([400, 10], 150, 300, 30, 50) == [(0, 1), (1, 2)]
    assert chunking.ranges([100, 100], 150, 300, 30, 50) == [(0, 2)]
    assert chunking.ranges([], 150, 300, 30, 50) == []


def test_percentile(spark):
    df = spark.range(1, 101).select(F.col("id").alias("df"))
    assert graph.rank_percentile(df, "df", 0.98).first()["cutoff"] == 99


def test_direct_links(spark):
    a = spark.createDataFrame([(1, "A", ["b"]), (2, "B", ["a"])], "page_id long, title string, links array<string>")
    assert [tuple(r) for r in graph.direct_links(a).collect()] == [(1, 2, 4.0)]


def test_two_hops(spark):
    open_ = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    assert [tuple(r) for r in graph.two_hops(open_).collect()] == [(1, 2, 3)]
    assert graph.two_hops(open_.union(spark.createDataFrame([(1, 3)], "a long, b long"))).count() == 0


def test_bm25(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "b c")], "doc long, text string")
    q = spark.createDataFrame([(1, "a")], "query long, text string")
    rows = retrieval.bm25(docs, q, 10).collect()
    assert [(r.doc, r.score) for r in rows] == [(1, pytest.approx(0.930399, abs=1e-6))]


def test_measures(spark):
    hits = spark.createDataFrame([(1, 9, 1), (1, 5, 2)], "query long, doc long, rank int")
    gold = spark.createDataFrame([(1, 5), (1, 6)], "query long, doc long")
    assert tuple(retrieval.measures(hits, gold).first()) == (1, 0.5, 0.5, 0.0)


def test_decide(spark):
    rows = [("p", False, "high"), ("p", False, None), ("q", True, "low"), ("r", True, "low"), ("r", True, "low")]
    got = {r.path: (r.decision, r.confidence) for r in funnel.decide(spark.createDataFrame(rows, "path string, solvable boolean, confidence string")).collect()}
    assert got == {"p": ("pass", 0.85), "q": ("reject_single_hop", 0.0), "r": ("reject_trivial", 0.0)}


def test_filter_reasons(spark):
    d = spark.createDataFrame([("What is the name of the red fox here today?", "red fox", "x"), ("Who?", "", "")], "q string, s string, l string")
    reject, flag = funnel.filter_reasons(F.col("q"), F.col("s"), F.col("l"), F.lit(0.0))
    rows = d.select(reject.alias("r"), flag.alias("f")).collect()
    assert rows[0].r == ["answer_in_question", "insufficient_citations"]
    assert "empty_short_answer" in rows[1].r and "pronoun_answer" not in rows[1].r and "short_question" in rows[1].r


def test_jaccard_pairs(spark):
    import itertools
    import random

    g = random.Random(1)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(g.sample(words, g.randint(1, 8))) for _ in range(80)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    classes, pairs = similarity.jaccard_pairs(docs, 0.6)
    rep = {r.id: r.rep for r in classes.collect()}
    sets = {i: set((t or "").split()) for i, t in enumerate(texts)}
    reps = sorted(set(rep.values()))
    want = {(a, b) for a, b in itertools.combinations(reps, 2) if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b]) - 1e-9}
    assert {(r.a, r.b) for r in pairs.collect()} == want


def test_pending(spark):
    jobs = spark.range(1).select(F.lit("p1").alias("p"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"))
    done = spark.createDataFrame([("p1", 0)], "p string, i int")
    assert sorted(r.i for r in funnel.pending(jobs, done, ["p", "i"]).collect()) == [1, 2, 3]


def test_passages(spark):
    c = spark.createDataFrame([(1, 0, "alpha beta"), (1, 1, "Gamma delta"), (1, 2, None), (1, 3, "gamma"), (2, 0, "x" * 10), (2, 1, "y" * 5)], "doc long, idx long, chunk_text string")
    e = spark.createDataFrame([(1, "GAMMA"), (1, "none"), (2, "x")], "doc long, entity string")
    got = sorted(tuple(r) for r in passages.hints(c, e, 2).collect())
    assert got == [(1, "GAMMA", 1), (1, "GAMMA", 3), (1, "none", 0), (1, "none", 1), (2, "x", 0)]
    lead = {r.doc: (r.text, r.n_chunks) for r in passages.leading_text(c, 10).collect()}
    assert lead == {1: ("alpha beta", 1), 2: ("x" * 10, 1)}
    s = spark.createDataFrame([(7, 1, ' "delta" '), (8, 1, "absent"), (9, 3, "x"), (5, 1, "")], "id long, doc long, span string")
    assert [tuple(r) for r in passages.map_spans(s, c).collect()] == [(7, 1, 1, 6, 11)]
    row = spark.range(1).select(passages.block("A", F.lit("d1"), F.lit("T"), F.array(F.lit("one"), F.lit("two"))).alias("b")).first()
    assert row.b == '--- Document A (doc_id: d1, title: "T") ---\none\ntwo\n'


def test_jaccard_pairs_of_every_document(spark, tmp_path):
    from quillwork.plans import catalogue

    texts = ["red fox jumps", "red fox jumps", None, "", "the of and", "слова без латиницы", "日本語"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in catalogue.jaccard_pairs(spark, str(tmp_path)).collect())
    assert got == [(0, 0, 0), (1, 0, 0), *[(i, i, 0) for i in range(2, 7)]]


def test_jaccard_pairs_of_a_family_shuffle_each_set_a_few_times(spark):
    import itertools
    import random

    g = random.Random(2)
    words = [f"w{i}" for i in range(130)]
    sets = [set(words[:120]) - set(g.sample(words[:120], 4)) | set(g.sample(words[120:], 2)) for _ in range(250)]
    docs = spark.createDataFrame([(i, " ".join(sorted(s))) for i, s in enumerate(sets)], "id long, text string")
    written = lambda: sum(x.totalShuffleWrite() for x in [spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0)])
    before = written()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with larger tables
    try:
        pairs = {(r.a, r.b): r.similarity for r in similarity.jaccard_pairs(docs, 0.9)[1].collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spent = written() - before
    assert spent < 2_000_000, spent  # thousands of pairs of sets of 1 KB each
    want = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, j in itertools.combinations(range(250), 2) if sets[i] != sets[j]}
    assert pairs == {k: pytest.approx(v, abs=1e-6) for k, v in want.items() if v >= 0.9} and len(pairs) > 1000


def test_jaccard_pairs_in_small_blocks_with_few_known_tokens(spark, monkeypatch):
    import itertools
    import random

    for name, value in (("FREQUENT", 5), ("CELL", 40), ("LISTED", 3)):
        monkeypatch.setattr(similarity, name, value)
    g = random.Random(3)
    sets = [set(g.sample(range(14), g.randint(1, 9))) for _ in range(150)]
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in s)) for i, s in enumerate(sets)], "id long, text string")
    classes, pairs = similarity.jaccard_pairs(docs, 0.6)
    reps = sorted({r.rep for r in classes.collect()})
    want = {(a, b) for a, b in itertools.combinations(reps, 2) if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b]) - 1e-9}
    assert sorted((r.a, r.b) for r in pairs.collect()) == sorted(want)


def test_jaccard_greedy_keep_of_a_family(spark, tmp_path, monkeypatch):
    import random

    from quillwork.plans import catalogue

    monkeypatch.setattr(similarity, "CELL", 500)
    g = random.Random(4)
    words = [f"w{i}" for i in range(64)]
    sets = [set(g.sample(words[:60], 56)) | set(g.sample(words[60:], 1)) for _ in range(80)] + [set()]
    spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(sets)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for i, s in enumerate(sets):
        if not any(s and len(s & sets[k]) / len(s | sets[k]) >= 0.85 for k in kept):
            kept.append(i)
    assert sorted(r.doc_id for r in catalogue.jaccard_greedy_keep(spark, str(tmp_path)).collect()) == kept

"""Each operator against a brute-force version on small inputs with nulls, empties, repeats and clashing columns."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from quillwork.llm import decontaminate, langid, minhash, ppm, quality, repeats, warc
from quillwork.llm.common import scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
G = random.Random(5)
VOCABULARY = ["".join(G.choice("abcdefgh") for _ in range(G.randint(2, 7))) for _ in range(300)]


def prose(n):
    return " ".join(G.choice(VOCABULARY) for _ in range(n))


BASE = prose(120)
SHARED = prose(40)
TEXTS = [
    BASE, BASE, " ".join(w if i % 60 else "changed" for i, w in enumerate(BASE.split())), prose(80) + " " + SHARED + " " + prose(50), prose(30) + "\n" + SHARED + "\n" + prose(70),
    None, "", "  \n ", "a", "x" * 400, "ab " * 200, prose(3), prose(3000), "é" * 150 + " ▁ 日本", prose(60) + "\nLicensed under the Apache License, Version 2.0.",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _rid2 string, h long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "x", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def low(t):
    return [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORD.findall(t or "")]


def test_quality(docs, none):
    rows = {r.doc_id: r for r in quality.measures(docs).collect()}
    for i, t in enumerate(TEXTS):
        w = WORD.findall(t or "")
        c = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for k in (j, j + 1, j + 2)}
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered)), i
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    assert quality.measures(none).count() == 0


def test_quality_lines(spark):
    text = prose(60) + ".\nHome | News | About | Contact\nAll rights reserved by us.\n" + prose(20) + "."
    r = quality.measures(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.kept and r.lost_words == 12 and "Home" not in r.clean_text and "reserved" not in r.clean_text


def test_quality_phrase_within_words(spark):
    lines = ["[Click here]", "(Sign in to read on", '"Powered by us', "•Privacy Policy of ours", "all\u00a0rights reserved by us"]
    rows = [(i, prose(60) + ".\n" + x + ".") for i, x in enumerate(lines)]
    got = {r.doc_id: r.lost_words for r in quality.measures(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: len(WORD.findall(x)) for i, x in enumerate(lines)}


@pytest.mark.parametrize("hot", [20_000, 0])
def test_repeats(docs, none, hot):
    s = repeats.Settings(hot_contexts=hot, block=500, queue_bytes=300, array_bytes=2000)
    rows = {r.doc_id: r for r in repeats.remove_repeats(docs, s).collect()}
    seen = set()
    for i, t in enumerate(TEXTS):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            x = b[k : k + 100]
            if x in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(x)
        kept = bytes(c for c, d in zip(b, gone, strict=True) if not d)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        assert (rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans, rows[i].kept_sha256) == (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()), i
    assert repeats.remove_repeats(none).count() == 0


def shingles(t):
    w = low(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_near_duplicates(docs, none):
    sets = [shingles(t) for t in TEXTS]
    top = list(range(len(sets)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    rows = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    for i, s in enumerate(sets):
        assert (rows[i].n_shingles, rows[i].component_id, rows[i].kept) == (len(s), find(i), find(i) == i), i
    assert minhash.near_duplicates(none).count() == 0


def test_repeated_ids(spark):
    d = spark.createDataFrame([(1, BASE), (1, BASE), (None, BASE), (2, None)], "doc_id long, text string")
    assert minhash.near_duplicates(d).filter("kept").count() == 2
    assert repeats.remove_repeats(d).agg({"n_removed": "sum"}).first()[0] == 2 * len(BASE)


def test_leaks(spark, docs, none):
    items = spark.createDataFrame([(7, SHARED), (8, prose(50)), (9, None), (10, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    want = {(i, 7) for i, t in enumerate(TEXTS) if 100 * len(shingles(SHARED) & shingles(t)) >= 75 * len(shingles(SHARED))}
    assert got == want and len(want) == 2
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_lookup_memory():
    gram = np.unique(np.random.default_rng(3).integers(0, 1 << 48, 1 << 18))
    value, x = np.arange(len(gram), dtype=np.float32), np.tile(gram, 4)
    tracemalloc.start()
    try:
        got = ppm.Lookup(gram, value)(x)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.array_equal(got, np.tile(value, 4))
    assert peak < 100 * len(gram)  # the chunk's own grams and values have 12 bytes each


def test_scores(docs, none):
    rows = {r.doc_id: r for r in ppm.score(docs).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c, ctx = Counter(), {}
    for i, t in enumerate(TEXTS):
        if not held(i):
            c.update([*low(t), None])
            b = b"\xff\xff" + (t or "").encode() + b"\xff"
            for k in range(2, len(b)):
                for n in range(3):
                    ctx.setdefault(b[k - n : k], Counter())[b[k]] += 1

    def chance(b, k):
        out, gone = 1.0, set()
        for n in (2, 1, 0):
            seen = {x: m for x, m in ctx.get(b[k - n : k], {}).items() if x not in gone}
            total = sum(seen.values()) + len(seen)
            if b[k] in seen:
                return out * seen[b[k]] / total
            if seen:
                out *= len(seen) / total
                gone |= set(seen)
        return out / (256 - len(gone))

    total, size = sum(c.values()), len(c)
    for i, t in enumerate(TEXTS):
        w = [*low(t), None]
        b = b"\xff\xff" + (t or "").encode() + b"\xff"
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(c[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(sum(np.log10((c[x] + 1) / (total + size + 1)) for x in w))
        assert r.score == pytest.approx(sum(np.log10(chance(b, k)) for k in range(2, len(b))), rel=1e-4)
    assert ppm.score(none).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/é", "x" * 1500), (2, None, "x" * 1500), (3, "u", "short"), (4, "u", "short"), (5, "u", None)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in warc.read(warc.write(pages, scratch(spark))).collect()}
    assert (rows[1].record_type, rows[1].refers_to, rows[1].payload_bytes) == ("revisit", 2, 1500)
    assert [rows[i].record_type for i in (2, 3, 4, 5)] == ["response"] * 4
    assert rows[1].payload_digest == hashlib.sha1(b"x" * 1500).hexdigest() and rows[5].payload_bytes == 0
    assert warc.read(warc.write(pages.limit(0), scratch(spark))).count() == 0


def test_warc_of_many_partitions(spark, tmp_path):
    """A small table in many partitions: no archive is written over."""
    html = lambda i: f"{i % 400} " * 300
    spark.createDataFrame([(i, "u", html(i)) for i in range(500)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/in")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(kept, ("64", "false"), strict=True):
            spark.conf.set(k, v)
        files = warc.write(spark.read.parquet(f"{tmp_path}/in"), scratch(spark))
        assert len({r.uri for r in files.collect()}) == files.count() == 64 and len(files.inputFiles()) == 1
        got = warc.read(files).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    want = [(i, len(html(i)), hashlib.sha1(html(i).encode()).hexdigest(), *(("revisit", i + 400) if len(html(i)) >= 1000 and i < 100 else ("response", None))) for i in range(500)]
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want


def test_language(spark, none):
    g = random.Random(1)
    make = lambda letters: " ".join("".join(g.choice(letters) for _ in range(5)) for _ in range(30))
    rows = [(i, make("abcde" if i % 2 else "vwxyz"), "one" if i % 2 else "two") for i in range(200)] + [(200, None, "one"), (201, "12 34", "one")]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(got[i].lang_pred == rows[i][2] for i in range(200)) >= 198
    assert got[200].lang_pred == got[201].lang_pred == "und" and all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(none).count() == 0


def test_scores_by_long_contexts(spark, tmp_path, monkeypatch):
    """The query's model uses contexts of five bytes: against a brute-force descent through all contexts."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    ctx = {}
    marked = lambda t: b"\xff" * 5 + (t or "").encode() + b"\xff"
    for i, t in enumerate(TEXTS):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            b = marked(t)
            for k in range(5, len(b)):
                for n in range(6):
                    ctx.setdefault(b[k - n : k], Counter())[b[k]] += 1

    def chance(b, k):
        out, gone = 1.0, set()
        for n in range(5, -1, -1):
            seen = {x: m for x, m in ctx.get(b[k - n : k], {}).items() if x not in gone}
            total = sum(seen.values()) + len(seen)
            if b[k] in seen:
                return out * seen[b[k]] / total
            if seen:
                out *= len(seen) / total
                gone |= set(seen)
        return out / (256 - len(gone))

    # also with shards so large, for their bound, that they are dealt over parts
    parted = ppm.Settings(order=5, chunk_bytes=1000, shard_bytes=400)
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    written, stash = [], ppm.stash
    monkeypatch.setattr(ppm, "stash", lambda df, name="t": written.append(name) or stash(df, name))
    for out in (ppm.query(spark, str(tmp_path)), ppm.score(table, parted)):
        got = {r.doc_id: r.score for r in out.collect()}
        assert len(got) == len(TEXTS)
        for i, t in enumerate(TEXTS):
            b = marked(t)
            assert got[i] == pytest.approx(sum(np.log10(chance(b, k)) for k in range(5, len(b))), rel=1e-5), i
    assert written.count("sums") == 1

"""Near duplicates in buckets that hold many documents without links: brute force over all pairs."""

import random

import numpy as np

from quillwork.llm import minhash

G = random.Random(11)
WORDS = [f"w{i}" for i in range(4000)]


def prose(n):
    return [G.choice(WORDS) for _ in range(n)]


def edited(text, n):
    text = list(text)
    for i in G.sample(range(len(text)), n):
        text[i] = G.choice(WORDS)
    return text


def family():
    passage, base = prose(70), prose(100)
    texts = [passage + prose(45) for _ in range(30)] + [edited(base, n) for n in (0, 1, 1, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 5, 5, 6) for _ in range(3)]
    texts += [edited(base[:k] + prose(100 - k), 1) for k in (60, 70, 80, 85, 90, 95)] + [passage + base[:45]] * 2
    G.shuffle(texts)
    return texts


def brute(texts):
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    top = list(range(len(sets)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return [find(i) for i in range(len(sets))]


def test_hot_buckets(spark, monkeypatch):
    texts, calls = family(), []
    real = minhash._settle
    monkeypatch.setattr(minhash, "_settle", lambda *a: calls.append(1) or real(*a))
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(d).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
    assert calls  # the case meets the prefix filter


def test_settle_alone(spark):
    texts = family()
    h = [sorted({hash(tuple(t[i : i + 5])) for i in range(len(t) - 4)}) for t in texts]
    sets = spark.createDataFrame(list(enumerate(h)), "r long, s array<long>")
    member = spark.createDataFrame([(i, len(x), i) for i, x in enumerate(h)], "r long, n long, c long")
    got = {tuple(r) for r in minhash._settle(member, sets, minhash.Settings()).collect()}
    want = set()
    for j in range(len(h)):
        for i in range(j):
            n = len(set(h[i]) & set(h[j]))
            if 100 * n >= 75 * (len(h[i]) + len(h[j]) - n):
                want.add((i, j))
    assert got == want and len(want) > 50


def test_components(spark):
    r = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in r.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 460)]
    d = spark.createDataFrame(links, "a long, b long").repartition(5)
    one = {tuple(x) for x in minhash.components(d, 1 << 20).collect()}
    many = {tuple(x) for x in minhash.components(d, 0).collect()}
    assert one == many and (460, 400) in one
    assert all({dict(one)[a]} == {dict(one)[b]} for a, b in links)

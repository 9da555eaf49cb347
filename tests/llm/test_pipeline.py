"""The pipeline's rows against a brute-force version of its five stages on a small fixture."""

import random
import re
from collections import Counter

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ENDS = tuple(".!?…:;。！？\"”»')]")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def low(t):
    return [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORD.findall(t or "")]


def shingles(t):
    w = low(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def keeps(t):
    w = WORD.findall(t or "")
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for k in (j, j + 1, j + 2)}
    if len(w) < 50 or 100 * len(covered) > 50 * len(w):
        return False
    lost = 0
    for line in (t or "").split("\n"):
        n = len(WORD.findall(line))
        short = 0 < n < 3 and not line.strip(" \t\n\x0b\x0c\r").endswith(ENDS)
        menu = sum(line.count(x) for x in "|»›•·") >= 3
        phrase = "rights reserved" in line.lower() and n <= 40
        lost += n * (short or menu or phrase)
    return 100 * lost <= 50 * len(w)


def survivors(docs):
    """Of docs, one of each group of near duplicates: the one with the least id."""
    sets = {i: shingles(t) for i, t in docs}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and sets[j]:
                n = len(sets[i] & sets[j])
                if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                    a, b = sorted((find(i), find(j)))
                    top[b] = a
    return [(i, t) for i, t in docs if find(i) == i]


def without_repeats(docs):
    seen, out = set(), []
    for i, t in sorted(docs):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            x = b[k : k + 100]
            if x in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(x)
        out.append((i, bytes(c for c, d in zip(b, gone, strict=True) if not d).decode("utf-8", "ignore") if any(gone) else t))
    return out


def fixture():
    g = random.Random(11)
    vocabulary = ["".join(g.choice("abcdefghij") for _ in range(g.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(g.choice(vocabulary) for _ in range(n))
    items = [(1, prose(40)), (2, prose(12)), (3, None), (4, ""), (5, prose(200))]
    passage, base = prose(45), prose(150)
    texts = [base, base + " more words", " ".join("other" if k % 40 == 7 else w for k, w in enumerate(base.split())), base, None, "", "short", "ab " * 200]
    texts += [prose(g.randint(50, 160)) + "." for _ in range(12)]
    texts += [prose(30) + ". " + passage + " " + prose(g.randint(40, 90)) + "." for _ in range(5)]
    texts += [prose(60) + " " + items[k][1] + " " + prose(20) + "." for k in (0, 1, 4)]
    texts += ["\n".join([prose(20) + ".", *[prose(2) for _ in range(30)]]), prose(40) + "\n" + "é" * 300 + "\n" + prose(40), prose(70) + "\nAll rights reserved by us.\nHome | News | About | Contact"]
    texts += [texts[9]] * 3 + [prose(400)]
    g.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)], items


def test_pipeline(spark, tmp_path):
    import public_tokenizers
    import sentencepiece

    docs, items = fixture()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    judged = [(i, t) for i, t in docs if keeps(t)]
    single = survivors(judged)
    cut = without_repeats(single)
    held = [shingles(t) for _, t in items if shingles(t)]
    clean = [(i, t) for i, t in cut if not any(100 * len(h & shingles(t)) >= 75 * len(h) for h in held)]
    sizes = [len(x) for x in (docs, judged, single, cut, clean)]
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 0 and dict(cut) != dict(single)
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {i: lib.encode(t or "") for i, t in clean}


def test_pipeline_empty(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_number_once(spark, tmp_path, monkeypatch):
    """Repeated and null ids, with a numbering that differs from call to call, as on large tables."""
    from quillwork.llm import decontaminate, minhash, repeats
    from quillwork.llm.common import with_rid

    calls = []

    def other(docs, *args):
        calls.append(1)
        return with_rid(docs, *args).selectExpr("* except (_rid)", f"_rid + {1000 * len(calls)} as _rid")

    for m in (decontaminate, minhash, repeats):
        monkeypatch.setattr(m, "with_rid", other)
    g = random.Random(3)
    prose = lambda n: " ".join("".join(g.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    a, b, item = prose(80), prose(80), prose(30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = lambda *rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], COLUMNS)
    texts = lambda stage, d: sorted(r.text for r in stage(spark, d, str(tmp_path)).collect())
    assert texts(minhash.stage, frame((1, a), (1, a), (None, b))) == sorted([a, b])
    assert texts(decontaminate.stage, frame((1, a), (1, b + " " + item), (None, b))) == sorted([a, b])
    assert texts(repeats.stage, frame((1, a), (1, a), (None, b))) == sorted(["", a, b])

"""Nulls, repeated rows, clashing columns and gradients: cases that the larger comparisons do not hold."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.llm import decontaminate, langid, minhash, ppm, quality, repeats, warc
from quillwork.llm.common import scratch, share, spread_join

G = random.Random(8)


def prose(n):
    return " ".join("".join(G.choice("abcdefgh") for _ in range(6)) for _ in range(n))


CLASHES = ["_rid", "_row", "_w", "_l", "_real", "_bad", "_rk", "_rd", "_rf", "_ri", "_kept", "kept", "n_words", "lost_words", "clean_text", "h", "k", "r", "a", "b", "spans", "_tie", "_part", "c", "s", "band", "w w"]


@pytest.mark.parametrize("stage", [quality.stage, minhash.stage, repeats.stage, decontaminate.stage])
def test_stages_carry_any_column(spark, tmp_path, stage):
    """Columns named like the operators' own, null and repeated ids, null texts: rows that stay are as they were."""
    base = prose(150) + "."
    texts = [prose(80) + ".", base, base + " more", None, "", prose(60) + "."]
    rows = [(i if i < 4 else None, t, "en", "s", 5, *[f"{c}{i}" for c in CLASHES]) for i, t in enumerate(texts)]
    rows.append((0, *rows[5][1:]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))
    spark.createDataFrame([(1, prose(30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = [tuple(r) for r in out.collect()]
    whole = {r[5:] for r in rows}
    assert all(r[5:] in whole for r in got)
    if stage is not repeats.stage:
        assert all(r in rows for r in got)
    if stage is decontaminate.stage:
        assert sorted(got, key=str) == sorted(rows, key=str)
    if stage is minhash.stage:
        assert len(got) == 5  # of the near copies one stays, and of the two equal rows
    if stage is repeats.stage:
        assert len(got) == 7 and sum(r[1] == base for r in got) == 1
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_spread_join(spark, how):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(900)] + [(None, -1)], "k long, v long")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z"), (7, "w")], "k long, t string")
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("_n"))
    got = spread_join(left, right, ["k"], counts, 10, how)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, left.join(right, "k", how).select(*got.columns).collect()), key=str)
    assert share(10**9, spark) > share(10, spark) == 2000


def test_gradients_are_the_loss_slopes():
    s = langid.Settings(hidden=3, seed=5)
    p = langid.start(3, s)
    g = np.random.default_rng(2)
    seq = g.integers(97, 103, (9, 6)).astype(np.intp)
    seq[6:, 0] = langid.PAD
    lang = np.array([0, 1, 2, 0, 1, 2])
    _, grad = langid.gradients(p, seq, lang)
    for name in ("u", "c", "w", "b", "x"):
        flat = np.abs(grad[name]).reshape(-1)
        for i in np.argsort(-flat)[:4]:
            at = np.unravel_index(i, grad[name].shape)
            was = float(p[name][at])
            p[name][at] = was + 1e-2
            up = langid.gradients(p, seq, lang)[0]
            p[name][at] = was - 1e-2
            down = langid.gradients(p, seq, lang)[0]
            p[name][at] = was
            assert (up - down) / 2e-2 == pytest.approx(float(grad[name][at]), rel=0.03, abs=2e-5), (name, at)


def test_prediction_is_the_mean_over_own_bytes():
    """The fast layout against the plain one, and windows that label each byte once."""
    s = langid.Settings(hidden=3, window=20, overlap=4, lanes=8)
    p = langid.start(2, s)
    texts = [b"", b"a", b"abcdef" * 10, bytes(range(60, 92))]
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    who, win, own = langid.cut(data, off, 20, 4)
    assert np.bincount(who, weights=own.sum(1), minlength=4).tolist() == [len(t) for t in texts]
    for i, t in enumerate(texts):
        assert bytes(win[who == i][own[who == i]].astype(np.uint8)) == t
    seq, mine = np.full((20, 8), langid.PAD, np.intp), np.zeros((20, 8), bool)
    seq[:, : len(who)], mine[:, : len(who)] = win[:8].T, own[:8].T
    fast = langid.Runner(p, 20, 8)(seq, mine)
    plain = langid.probabilities(p, langid.states(p, seq)[0])
    assert np.allclose(fast.T, (plain * mine[:, :, None]).sum(0), atol=1e-4)


def test_language_of_repeated_rows(spark):
    make = lambda letters: " ".join("".join(G.choice(letters) for _ in range(5)) for _ in range(40))
    rows = [(i // 2, make("abcde" if i % 4 < 2 else "vwxyz"), "one" if i % 4 < 2 else "two") for i in range(120)]
    rows += [(None, make("abcde"), "one"), (3, None, None), (3, "", "two"), (None, None, None)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langid.Settings(sample_rows=60)).collect()
    assert len(got) == len(rows) and sum(r.lang_pred == "und" for r in got) == 3
    assert sorted(r.held_out for r in got if r.doc_id is None) == [False, False]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)


def test_scores_of_repeated_ids(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (None, "a"), (2, None)]
    got = ppm.score(spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, chunk long, w string"), ppm.Settings(order=4, chunk_bytes=2)).collect()
    assert len(got) == 5
    held = [r for r, _ in rows if r is not None and zlib.crc32(str(r).encode()) % 7 == 2]
    words = [w for i, t in rows if i not in held for w in (t or "").split()]
    total = len(words) + sum(i not in held for i, _ in rows)
    assert {r.train_tokens for r in got} == {total} and all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_warc_of_null_and_repeated_ids(spark):
    big = "y" * 1200
    pages = spark.createDataFrame([(None, "u", big), (4, "u", big), (4, "u", big), (2, None, None), (None, None, "z")], "page_id long, url string, html string")
    got = warc.read(warc.write(pages, scratch(spark))).collect()
    assert len(got) == 5 and sorted(r.payload_bytes for r in got) == [0, 1, 1200, 1200, 1200]
    large = [r for r in got if r.payload_bytes == 1200]
    assert sum(r.record_type == "response" for r in large) >= 1 and all(r.refers_to == 4 for r in large if r.record_type == "revisit")


def test_leaks_of_repeated_rows(spark):
    item = prose(30)
    docs = spark.createDataFrame([(1, prose(20) + " " + item), (1, item), (None, item.upper()), (2, None), (3, "")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, " ")], "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id, r.n_shared) for r in decontaminate.leaks(docs, items).collect())
    assert got == [("1", 7, 26), ("1", 7, 26), ("None", 7, 26)]

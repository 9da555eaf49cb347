"""Token ids and pieces against the libraries themselves."""

import io
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from quillwork.llm import pieces, tokenstore
from quillwork.llm.common import scratch

G = random.Random(5)
MARKS = [" ", "  ", "\n", "\n\n", "\r\n", "\t", "\xa0", "\x1c", "\x85", "a", "bc", "é", "日", "1", ".", "!!", "'s", "\u3000", "\x0b", "\x00", "\x7f", "<|endoftext|>", "<|endof", "text|>", "Word", "▁", "😀", "Ж"]
TEXTS = ["hello <|endoftext|> world", "x  <|endoftext|>", "one\ntwo.\nthree", "", None, " ", "a" * 5000, "ab " * 300] + ["".join(G.choice(MARKS) for _ in range(G.randint(1, 25))) for _ in range(600)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, _rid2 long, part string")


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_the_librarys():
    t = library()
    ids, off = tokenstore.encode_batch(pa.array(TEXTS, pa.string()), tokenstore.Settings(kept_words=100))
    for i, x in enumerate(TEXTS):
        assert ids[off[i] : off[i + 1]].tolist() == [*t.encode(x or "", add_special_tokens=False).ids, 0], x
    assert 50256 in ids


def test_other_tokenizers_go_by_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.WordLevel({"a": 1, "b": 2, "?": 3}, unk_token="?"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.save(f"{tmp_path}/t.json")
    ids, off = tokenstore.encode_batch(pa.array(["a b", None, "c\na"]), tokenstore.Settings(tokenizer=f"{tmp_path}/t.json"))
    assert ids.tolist() == [1, 2, 0, 0, 3, 1, 0] and off.tolist() == [0, 3, 4, 7]


def test_token_files(spark, docs):
    t = library()
    rows = {r.doc_id: r for r in tokenstore.read(tokenstore.write(docs, scratch(spark))).collect()}
    start = 0
    for i, x in enumerate(TEXTS):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokenstore.read(tokenstore.write(docs.limit(0), scratch(spark))).count() == 0


def test_token_files_of_repeated_rows(spark):
    t = library()
    rows = [(5, "b b"), (None, "z"), (5, "a"), (5, "a"), (1, None)]
    got = tokenstore.read(tokenstore.write(spark.createDataFrame(rows, "doc_id long, text string"), scratch(spark))).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 5, 5, 5] and sum(r.n_tokens for r in got) == sum(len(t.encode(x or "").ids) + 1 for _, x in rows)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_token_files_of_many_partitions(spark, docs, tmp_path):
    """Small tables in many partitions: each partition keeps a file of its own; the list and the rows go to few."""
    t = library()
    docs.write.parquet(f"{tmp_path}/in")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(kept, ("64", "false"), strict=True):
            spark.conf.set(k, v)
        files = tokenstore.write(spark.read.parquet(f"{tmp_path}/in"), scratch(spark))
        assert len({r.uri for r in files.collect()}) == files.count() == 64 and len(files.inputFiles()) == 1
        out = tokenstore.read(files)
        assert out.rdd.getNumPartitions() <= 8  # two for each core
        got = {r.doc_id: r for r in out.collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    start = 0
    for i, x in enumerate(TEXTS):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_frames():
    f = io.BytesIO()
    w = tokenstore.Writer(f, tokenstore.Settings(frame_ids=10))
    lists = [np.arange(n, dtype=np.uint32) for n in (3, 0, 9, 25, 1)]
    for i, x in enumerate(lists):
        w.add(i, i, x)
    w.close()
    r = tokenstore.Reader(pa.BufferReader(f.getvalue()))
    for i in (4, 0, 3, 2):
        assert r.document(i).tolist() == lists[i].tolist()
    bad = bytearray(f.getvalue())
    bad[12] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tokenstore.Reader(pa.BufferReader(bytes(bad))).document(0)


def test_pieces(docs):
    import public_tokenizers
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = {r.doc_id: r for r in pieces.encode_decode(docs).collect()}
    for i, t in enumerate(TEXTS):
        ids = lib.encode(t or "")
        assert rows[i].ids == ids and rows[i].decoded == lib.decode(ids) and rows[i].round_trip, t
    assert pieces.encode_decode(docs.limit(0)).count() == 0


def test_a_word_of_a_million_letters():
    ids, off = pieces.encode_batch(pa.array(["abcdefghij" * 100_000]), pieces.Settings())
    assert pieces.decode_batch(ids, off, pieces.Settings()) == [b"abcdefghij" * 100_000]


def field(number, value):
    out = bytearray()
    for n in [number << 3 | (2 if isinstance(value, bytes) else 0), len(value) if isinstance(value, bytes) else value]:
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        out.append(n)
    return bytes(out) + (value if isinstance(value, bytes) else b"")


def test_unigram(tmp_path):
    """A model written by hand: unknown, control and scored pieces."""
    import sentencepiece

    g = random.Random(2)
    scored = {p: -float(g.randint(10, 90)) / 8 for p in ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab", "aa", "é"]}
    piece = lambda p, v, kind: field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", v) + field(3, kind))
    body = piece("<unk>", 0.0, 2) + piece("<s>", 0.0, 3) + piece("</s>", 0.0, 3) + b"".join(piece(p, v, 1) for p, v in scored.items())
    body += field(2, field(3, 1)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    path = tmp_path / "u.model"
    path.write_bytes(body)
    lib = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["".join(g.choice("aabbccé  xy") for _ in range(g.randint(0, 30))) for _ in range(500)] + ["", None, "xx yy", "x"]
    ids, off = pieces.encode_batch(pa.array(texts), pieces.Settings(model=str(path)))
    assert not pieces.encoder(pieces.Settings(model=str(path))).model.bpe
    for i, t in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == lib.encode(t or ""), t

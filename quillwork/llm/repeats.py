"""Removal of repeated byte strings: anchors spread the text over shards, external induced sorting finds the repeats.

Every string of `length` bytes has an anchor: the place of the least hash among its short grams, so equal strings
have equal anchors. Neighbouring strings with one anchor make up a context. A pass over the texts yields a row for
each context; copies of a context are settled by the digest of its bytes (within a batch before the shuffle, then by
a sort-merge stream), and the first context of each digest, where its anchor has another, different one, goes with
its bytes to a shard. The contexts of an anchor that very many different contexts have are cut up by the second anchor
of their strings (the least hash among the other grams), and each part goes to a shard by both. A shard's contexts are
sorted with quillwork.llm.induced, however many they are, and runs of suffixes with a common prefix of `length` are the
repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, carried, gathered, maybe_broadcast, mix, partitions, prepare, share, slices, spread_join, stash, with_rid
from .induced import Limits, Store, later_copies


@dataclass(frozen=True)
class Settings:
    length: int = 100  # bytes of a repeated string
    gram: int = 24  # bytes of a gram; length - gram + 1 grams compete for the anchor
    block: int = 1 << 20  # strings that start in so many bytes are handled at a time
    shard_bytes: int = 3 << 20  # of contexts, on average; a shard may have any size
    queue_bytes: int = 2 << 20  # memory of a sort's queues; beyond it they go to disk
    array_bytes: int = 16 << 20  # larger arrays of a sort are files
    hot_contexts: int = 20_000  # an anchor with more different contexts has them cut up by second anchors
    broadcast_rows: int = 500_000


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        p = np.ones(n, np.uint64)
        p[1:] = BASE
        q = np.ones(n, np.uint64)
        q[1:] = INVERSE
        return np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers) from which the hash of any range follows."""
    n = 1 << max(16, int(len(data) + 1).bit_length())
    if n not in _cache:
        _cache.clear()
        _cache[n] = _powers(n)
    p, q = _cache[n]
    with np.errstate(over="ignore"):
        c = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(SPREAD[data] * p[: len(data)], out=c[1:])
    return c, q


#: A random-looking 64-bit value for each byte.
SPREAD = mix(np.arange(256, dtype=np.uint64), 5)


def range_hash(sums: tuple[np.ndarray, np.ndarray], lo: np.ndarray, hi: np.ndarray, salt: int) -> np.ndarray:
    c, q = sums
    with np.errstate(over="ignore"):
        return mix((c[hi] - c[lo]) * q[lo] + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), salt)


def contexts(data: np.ndarray, off: np.ndarray, s: Settings, skip: np.ndarray | None = None):
    """For texts joined in data: (text, start, end, anchor hash, digest) of each context; places within data.

    skip: a gram hash for each text that is no anchor there.
    """
    n, k, L = len(data), s.gram, s.length
    empty = np.zeros(0, np.int64)
    if n < L:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    sums = prefix_sums(data)
    at = np.arange(n - k + 1)
    with np.errstate(over="ignore"):
        h = mix((sums[0][k:] - sums[0][:-k]) * sums[1][: n - k + 1], 3)
    if skip is not None:
        h[h == np.repeat(skip, np.diff(off))[: len(h)]] = np.uint64(0xFFFFFFFFFFFFFFFF)
    bits = np.uint64(26)
    key = ((h >> bits) << bits) | at.astype(np.uint64)
    w = L - k + 1
    # sliding minimum by doubling
    m, size = key, 1
    while size * 2 <= w:
        m = np.minimum(m[: len(m) - size], m[size:])
        size *= 2
    m = np.minimum(m[: n - L + 1], m[w - size : w - size + n - L + 1])
    place = (m & np.uint64((1 << 26) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))[: n - L + 1]
    valid = np.arange(n - L + 1) + L <= off[text + 1]
    start = np.flatnonzero(valid)
    if not len(start):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    p, t = place[start], text[start]
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (t[1:] != t[:-1])])
    lo = start[new]
    hi = start[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])] + L
    return t[new], lo, hi, h[p[new]], range_hash(sums, lo, hi, 11)


def blocks(rid: np.ndarray, data: np.ndarray, off: np.ndarray, s: Settings):
    """Groups of texts, long ones cut so that each string of s.length lies in one piece: (rid, offset in text, data, offsets)."""
    piece: list[tuple[int, int, int, int]] = []
    held = 0

    def flush():
        o = np.concatenate([[0], np.cumsum([b - a for _, _, a, b in piece])])
        d = np.concatenate([data[a:b] for _, _, a, b in piece])
        return np.array([x[0] for x in piece]), np.array([x[1] for x in piece]), d, o

    for i in range(len(rid)):
        a, b = int(off[i]), int(off[i + 1])
        for x in range(a, max(b - s.length + 1, a), s.block):
            y = min(b, x + s.block + s.length - 1)
            if y - x < s.length:
                continue
            if piece and held + y - x > s.block + s.length:
                yield flush()
                piece, held = [], 0
            piece.append((int(rid[i]), x - a, x, y))
            held += y - x
    if piece:
        yield flush()


def _anchor_rows(s: Settings):
    """Rows (h, c, r, a, b): a context [a, b) of text r; h null: bytes of r to remove, found within the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for x in slices(batch, "text", 4 * s.block):
                data, off = buffers(x.column("text"))
                for rid, base, d, o in blocks(np.asarray(x.column("_rid")), data, off, s):
                    t, lo, hi, h, c = contexts(d, o, s)
                    got.append((rid[t], lo - o[t] + base[t], hi - o[t] + base[t], h, c))
            if not sum(len(x[0]) for x in got):
                continue
            r, a, e, h, c = (np.concatenate(x) for x in zip(*got, strict=True))
            order = np.lexsort((a, r, c, h))
            r, a, e, h, c = r[order], a[order], e[order], h[order], c[order]
            again = np.concatenate([[False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])])
            for i in range(0, len(r), 1 << 16):
                j = slice(i, i + (1 << 16))
                yield pa.record_batch([pa.array(h[j].view(np.int64), mask=again[j]), pa.array(np.where(again[j], mix(r[j].astype(np.uint64)), c[j]).view(np.int64)), pa.array(r[j]), pa.array(a[j]), pa.array(e[j])], names=["h", "c", "r", "a", "b"])

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (h, c, r, a): spans to remove (h null), and first contexts with the number their anchor has so far."""
    last_h = last_c = None
    first: tuple | None = None  # of the anchor, until it has a second context
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        null = np.asarray(batch.column("h").is_null())
        h, c, r, a, b = (np.asarray(batch.column(x).fill_null(0)) for x in ("h", "c", "r", "a", "b"))
        prev_h, prev_c = np.empty(n, np.int64), np.empty(n, np.int64)
        prev_h[1:], prev_c[1:] = h[:-1], c[:-1]
        prev_null = np.concatenate([[False], null[:-1]])
        same_h = (h == prev_h) & ~prev_null
        same_h[0] = last_h is not None and h[0] == last_h
        prev_c[0] = last_c if last_c is not None else 0
        same = same_h & (c == prev_c) & ~null
        gone = null | same
        new = ~gone
        opens = new & ~same_h  # first context of an anchor: told only when a second one comes
        idx = np.flatnonzero(new)
        tell = new & ~opens
        head = np.zeros(n, bool)
        lead = []
        if len(idx):
            o = opens[idx]
            second = np.flatnonzero(~o)
            prior = second - 1
            inside = prior >= 0
            firsts = idx[prior[inside]]
            head[firsts[opens[firsts]]] = True
            if len(second) and second[0] == 0 and first is not None:
                lead = [first]
                first = None
            at = idx[np.flatnonzero(o)]
            if len(at):
                first = None if head[at[-1]] else (h[at[-1]], c[at[-1]], r[at[-1]], a[at[-1]], b[at[-1]])
        keep = np.flatnonzero(gone | tell | head)
        out_h = pa.array(h[keep], mask=gone[keep])
        cols = [out_h, pa.array(c[keep]), pa.array(r[keep]), pa.array(a[keep]), pa.array(b[keep])]
        for x in lead:
            yield pa.record_batch([pa.array([int(v)], pa.int64()) for v in x], names=["h", "c", "r", "a", "b"])
        yield pa.record_batch(cols, names=["h", "c", "r", "a", "b"])
        live = np.flatnonzero(~null)
        if len(live):
            last_h, last_c = h[live[-1]], c[live[-1]]


def merge(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal runs, in order; touching ones are one run."""
    if not len(a):
        return a, b
    o = np.argsort(a, kind="stable")
    a, b = a[o], np.maximum.accumulate(b[o])
    new = np.concatenate([[True], a[1:] > b[:-1]])
    return a[new], b[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(a) - 1]])]


def _cut(s: Settings, shards: int, more: int):
    """The bytes of each context: rows (_rid, text, spans) to rows (shard, r, a, bytes). Contexts of hot anchors, whose
    shard is -1, are cut up by second anchors and dealt to `more` further shards."""

    def rows(d: np.ndarray, o: np.ndarray, key: np.ndarray, r: np.ndarray, a: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(key), pa.array(r), pa.array(a), pa.Array.from_buffers(pa.binary(), len(o) - 1, [None, pa.py_buffer(o.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(d))])], names=["k", "r", "a", "bytes"])

    def pick(data: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        o = np.concatenate([[0], np.cumsum(n)])
        return data[np.repeat(lo - o[:-1], n) + np.arange(o[-1])], o

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column("text"))
            col = batch.column("spans")
            x = col.flatten()
            so = np.asarray(col.offsets) - int(np.asarray(col.offsets)[0])
            key, a, b, h = (np.asarray(x.field(i)) for i in range(4))
            who = np.repeat(np.arange(batch.num_rows), np.diff(so))
            rid = np.asarray(batch.column("_rid"))
            lo, n = off[who] + a, b - a
            for hot in (False, True):
                at = np.flatnonzero((key < 0) == hot)
                for i in range(0, len(at), 8_000):
                    j = at[i : i + 8_000]
                    d, o = pick(data, lo[j], n[j])
                    if not hot:
                        yield rows(d, o, key[j], rid[who[j]], a[j])
                        continue
                    t, p, q, second, _ = contexts(d, o, s, h[j].view(np.uint64))
                    k = shards + (mix(second ^ mix(h[j].view(np.uint64)[t], 13), 17) % np.uint64(more)).astype(np.int64)
                    yield rows(*pick(d, p, q - p), k, rid[who[j]][t], a[j][t] + p - o[t])

    return run


class Shard:
    """The contexts of a shard as they come; bytes beyond a bound go to a file."""

    def __init__(self, s: Settings):
        self.s, self.store = s, Store(s.array_bytes)
        self.parts: list[np.ndarray] = []
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # row id, place in the text, size
        self.held, self.file, self.size = 0, None, 0

    def add(self, r: np.ndarray, a: np.ndarray, data: np.ndarray, off: np.ndarray) -> None:
        self.rows.append((r, a, np.diff(off)))
        self.parts.append(data.copy())
        self.held += len(data)
        self.size += len(data)
        if self.held > self.s.array_bytes:
            self.flush()

    def flush(self) -> None:
        if self.file is None:
            self.file = open(self.store.path(), "w+b")  # noqa: SIM115
        for x in self.parts:
            x.tofile(self.file)
        self.parts, self.held = [], 0

    def spans(self) -> Iterator[pa.RecordBatch]:
        """(r, a, b): the strings that start earlier in the shard too; those that touch are one span."""
        try:
            if self.file is not None:
                self.flush()
                self.file.flush()
                data = np.memmap(self.file, np.uint8, "r", shape=(self.size,))
            else:
                data = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint8)
            r, a, n = (np.concatenate(x) for x in zip(*self.rows, strict=True))
            off = np.concatenate([[0], np.cumsum(n)])
            marks = self.store.zeros(len(data), bool)
            later_copies(data, off, Limits(cap=self.s.length, queue_bytes=self.s.queue_bytes, array_bytes=self.s.array_bytes), marks)
            i = 0
            while i < len(n):  # some contexts at a time
                j = max(i + 1, int(np.searchsorted(off, off[i] + (1 << 22), "right")) - 1)
                p = np.flatnonzero(marks[off[i] : off[j]]) + off[i]
                if len(p):
                    seg = np.searchsorted(off, p, "right") - 1
                    new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (p[1:] > p[:-1] + self.s.length)])
                    at = np.flatnonzero(new)
                    end = np.append(at[1:], len(p)) - 1
                    place = a[seg] + p - off[seg]
                    yield pa.record_batch([pa.array(r[seg[at]]), pa.array(place[at]), pa.array(place[end] + self.s.length)], names=["r", "a", "b"])
                i = j
        finally:
            if self.file is not None:
                self.file.close()
            self.store.close()


def _sort(s: Settings):
    """Spans to remove, from contexts sorted by (shard, r, a)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, key = None, None
        for batch in batches:
            k, r, a = (np.asarray(batch.column(x)) for x in ("k", "r", "a"))
            data, off = buffers(batch.column("bytes"))
            cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else []
            for i, j in zip(cut, np.append(cut[1:], len(k)), strict=True):
                if shard is None or k[i] != key:
                    if shard is not None:
                        yield from shard.spans()
                    shard, key = Shard(s), k[i]
                shard.add(r[i:j], a[i:j], data[off[i] : off[j]], off[i : j + 1])
        if shard is not None:
            yield from shard.spans()

    return run


def without(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """The bytes outside the runs [a, b), which are in order and apart."""
    cut = np.concatenate([[0], np.stack([a, b], 1).reshape(-1), [len(data)]])
    return b"".join(data[x:y].tobytes() for x, y in zip(cut[::2], cut[1::2], strict=True))


def _finish(want_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column("text"))
            col = batch.column("spans")
            out = {k: [] for k in ("_rid", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "spans")}
            x = col.flatten()
            so = np.concatenate([[0], np.cumsum(np.diff(np.asarray(col.offsets)) * ~np.asarray(col.is_null()))])
            a, b = np.asarray(x.field(0)), np.asarray(x.field(1))
            for i in range(batch.num_rows):
                d = data[off[i] : off[i + 1]]
                p, q = merge(a[so[i] : so[i + 1]], b[so[i] : so[i + 1]])
                kept = without(d, p, q)
                out["n_bytes"].append(len(d))
                out["n_removed"].append(len(d) - len(kept))
                out["n_spans"].append(len(p))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept_text"].append(kept.decode("utf-8", "ignore") if want_text else None)
                out["spans"].append(np.stack([p, q], 1).tolist() if want_text else None)
            yield pa.record_batch([batch.column("_rid"), *[pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")], pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept_text"], pa.string()), pa.array(out["spans"], pa.list_(pa.list_(pa.int64())))], names=list(out))

    return run


def repeated_spans(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Spans (r, a, b), possibly overlapping, that together are the bytes to remove. docs: _rid unique, text."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("_rid", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # whole copies of an earlier text go as one span
    whole = docs.select("_rid", F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("x")).filter(F.col("n") >= s.length)
    first = whole.groupBy("x").agg(F.min("_rid").alias("f"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    first = stash(first, "originals")
    same = spread_join(whole, first.select("x", "f"), ["x"], first.select("x", F.col("k").alias("_n")), share(docs.count(), spark))
    copies = stash(same.filter("_rid != f").select(F.col("_rid").alias("r"), F.lit(0).cast("long").alias("a"), F.col("n").alias("b")), "copies")
    ids = copies.select(F.col("r").alias("_rid"))
    if copies.count() <= s.broadcast_rows:
        ids = F.broadcast(ids)
    rest = docs.join(ids, "_rid", "left_anti")
    rows = rest.mapInArrow(_anchor_rows(s), "h long, c long, r long, a long, b long")
    n = partitions(spark)
    # spans already found (h null) carry a random c, so that they spread as well
    dealt = rows.repartition(n, F.coalesce("h", "c")).sortWithinPartitions("h", "c", "r", "a")
    settled = stash(dealt.mapInArrow(_settle, "h long, c long, r long, a long, b long"), "settled")
    spans = copies.union(settled.filter("h is null").select("r", "a", "b"))
    todo = settled.filter("h is not null")
    total = todo.agg(F.coalesce(F.sum(F.col("b") - F.col("a")), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("k")).first()
    if not total["k"]:
        return spans
    hot = stash(todo.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("b") - F.col("a")).alias("n")).filter(F.col("k") > s.hot_contexts), "hot")
    hot_bytes = hot.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards, more = int(total["n"] // s.shard_bytes + 1), int(2 * hot_bytes // s.shard_bytes + 1)  # parts overlap
    key = F.pmod(F.xxhash64("h"), F.lit(shards)).cast("long")
    if hot_bytes:
        todo = todo.join(maybe_broadcast(hot.select("h", F.lit(True).alias("hot")), s.broadcast_rows), "h", "left")
        key = F.when(F.col("hot"), F.lit(-1).cast("long")).otherwise(key)
    need = todo.groupBy(F.col("r").alias("_rid")).agg(F.collect_list(F.struct(key.alias("k"), "a", "b", "h")).alias("spans"))
    pieces = rest.join(need, "_rid").select("_rid", "text", "spans").mapInArrow(_cut(s, shards, more), "k long, r long, a long, bytes binary")
    dealt = pieces.repartition(max(min(shards + more * (hot_bytes > 0), n * 8), 1), "k").sortWithinPartitions("k", "r", "a")
    return spans.union(stash(dealt.mapInArrow(_sort(s), "r long, a long, b long"), "found"))


def remove_repeats(docs: DataFrame, s: Settings = Settings(), want_text: bool = False, numbered: bool = False) -> DataFrame:
    """One row per input row: _rid, doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text, spans if wanted).

    A byte goes if a string of s.length bytes covers it that also starts earlier, in a smaller doc_id or earlier in
    the same text, judged on the input. Null and empty texts have no bytes; their hash is that of no bytes. Repeated
    or null doc_ids: each row is a document, in the order of (doc_id, text). An empty table gives an empty result.
    kept_text leaves out what a cut left of a
    character. Other columns of the input are not read.
    numbered: docs has its _rid from with_rid already; a second numbering of repeated ids may differ from the first.
    """
    named = docs.select("_rid", "doc_id", "text") if numbered else with_rid(docs.select("doc_id", "text"))
    spans = repeated_spans(named, s)
    by_doc = spans.groupBy(F.col("r").alias("_rid")).agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    text = named.select("_rid", "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    schema = "_rid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, spans array<array<long>>"
    # rows leave Python with their row id; the key goes with them by a join on nothing but equal ids being equal keys
    done = text.join(by_doc, "_rid", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<a:long,b:long>>"))).select("_rid", "text", "spans").mapInArrow(_finish(want_text), schema)
    same = dict(named.dtypes)["doc_id"] == "bigint" and named.filter("_rid != doc_id or doc_id is null").limit(1).count() == 0
    done = done.withColumn("doc_id", F.col("_rid")) if same else done.join(named.select("_rid", "doc_id"), "_rid")
    cols = ["_rid", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return done.select(*cols, *(["kept_text", "spans"] if want_text else []))


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("_rid")


#: DuckDB: every string of 100 bytes of every text by its digest, for the query.
SQL = r"""
with d as (select doc_id, encode(coalesce(text, '')) as b, hex(encode(coalesce(text, ''))) as x from documents), n as (select doc_id, x, cast(octet_length(b) as bigint) as n from d),
g as materialized (select doc_id, i, md5(substr(x, 2 * i + 1, 200)) as h from (select doc_id, x, unnest(range(0, n - 99)) as i from n where n >= 100)),
f as (select doc_id, i, row_number() over (partition by h order by doc_id, i) as k from g), e as (select doc_id, i, lag(i) over (partition by doc_id order by i) as p from f where k > 1),
o as (select doc_id, i, sum(case when p is null or i > p + 100 then 1 else 0 end) over (partition by doc_id order by i) as run from e), r as (select doc_id, run, min(i) as a, max(i) + 100 as z from o group by 1, 2),
c as (select doc_id, sum(z - a) as gone, count(*) as spans, list(a order by a) as a, list(z order by a) as z from r group by 1),
k as (select n.doc_id, n, coalesce(gone, 0) as gone, coalesce(spans, 0) as spans, case when gone is null then x else array_to_string(list_transform(range(0, len(a) + 1), lambda j: substr(x, 2 * (case when j = 0 then 0 else z[j] end) + 1, 2 * ((case when j = len(a) then n else a[j + 1] end) - (case when j = 0 then 0 else z[j] end)))), '') end as x from n left join c using (doc_id))
select doc_id, n as n_bytes, cast(gone as bigint) as n_removed, cast(spans as bigint) as n_spans, sha256(unhex(x)) as kept_sha256 from k
"""


def _rewrite(names: list[str]):
    """Rows (_row, spans) to the rows themselves, with the spans' bytes taken out of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = dict(zip(names, batch.column("_row").flatten(), strict=True))
            col = batch.column("spans")
            at = np.flatnonzero(np.asarray(col.is_valid()))
            if len(at):
                text = cols["text"]
                data, off = buffers(text)
                x, o = col.flatten(), np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(col).fill_null(0)))])
                a, b = np.asarray(x.field(0)), np.asarray(x.field(1))
                new = [without(data[off[i] : off[i + 1]], *merge(a[o[i] : o[i + 1]], b[o[i] : o[i + 1]])).decode("utf-8", "ignore") for i in at]
                changed = pa.array(np.asarray(col.is_valid()))
                cols["text"] = pc.replace_with_mask(text, changed, pa.array(new, text.type))
                if "n_chars" in cols:
                    size = pc.utf8_length(pa.array(new, pa.string())).cast(cols["n_chars"].type)
                    cols["n_chars"] = pc.replace_with_mask(cols["n_chars"], changed, size)
            yield pa.record_batch(list(cols.values()), names=names)

    return run


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without their repeated strings; characters cut at an edge go whole. n_chars follows.

    Every input row and column stays; only text and, if there is one, n_chars change. Columns of any name may come
    along. Null and empty texts stay as they are. Repeated or null doc_ids: each row is a document of its own, numbered
    once. An empty table gives an empty result.
    """
    prepare(spark)
    named = with_rid(carried(docs, "doc_id", "text"))
    spans = repeated_spans(named, Settings()).groupBy(F.col("r").alias("_rid")).agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    both = named.select("_rid", "_row").join(spans, "_rid", "left").select("_row", "spans")
    return gathered(both.mapInArrow(_rewrite(docs.columns), docs.schema))

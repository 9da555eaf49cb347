"""Prediction by partial matching over bytes, pretrained on the corpus, and unigram word scores.

The model counts, for each context of up to `order` bytes, which byte follows. A text is its bytes between `order`
start marks and an end mark (byte 255, which UTF-8 never has). A byte not seen after a context escapes to the next
shorter one, with the escape estimate of method C (distinct bytes seen over total plus distinct), and the bytes that
the longer context has seen are excluded there; below order 0 all bytes not yet excluded are equally likely.

The trie of contexts is sharded over executors by the last three bytes of the context, so a shard has every node of
order 3 and more on the way down to its grams (a gram is a context and the byte after it); the nodes of orders 0 to 2,
at most 2^24 grams, go to all. Texts are dealt into chunks. Each chunk sends its distinct grams with their training
counts to their shards, packed; a shard sums them, builds its part of the trie, and sends each chunk the
log-probabilities of that chunk's grams and no others. Every chunk asks about a frequent context, so the rows of such a
shard grow with the data: they are dealt over parts by chunk, the parts' counts are summed first, and each part gets the
sums, of which a context of three bytes has 2^24 at most at order 5. As a longer context sees a subset of what its suffix sees, what
is excluded after a context depends on the context alone, and each node has its sums ready.

Word scores need a count for each token of each text. Each chunk sends its distinct words once, the words' totals come
back to the chunk, and the chunk's texts are scored there.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, maybe_broadcast, mix, partitions, prepare, remainder, slices, stash, with_rid

MARK = 255


@dataclass(frozen=True)
class Settings:
    modulus: int = 7
    held_out: int = 2  # remainder that is not learned from
    slice_bytes: int = 2 << 20
    chunk_bytes: int = 16 << 20  # of text in a chunk, on average
    shard_bytes: int = 16 << 20  # packed grams of a shard; more are dealt over parts
    order: int = 2  # bytes of the longest context, 2 to 6


def symbols(col: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, offsets): each text with order marks before and one after."""
    data, off = buffers(col)
    m = len(off) - 1
    o = off + (order + 1) * np.arange(m + 1)
    out = np.full(o[-1], MARK, np.uint8)
    n = np.diff(off)
    out[np.repeat(o[:-1] + order - off[:-1], n) + np.arange(off[-1])] = data
    return out, o


def grams(col: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(context and byte as one number, offsets): one for each byte of a text and its end mark."""
    s, o = symbols(col, order)
    n = max(len(s) - order, 0)
    code = np.zeros(n, np.int64)
    for j in range(order + 1):
        code <<= 8
        code |= s[j : j + n]
    inner = np.ones(len(s), bool)
    for j in range(order):
        inner[o[:-1] + j] = False
    return code[inner[order:]], o - order * np.arange(len(o))


def summed(gram: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in order, with the sums of their counts."""
    at = np.argsort(gram, kind="stable")
    gram = gram[at]
    first = np.flatnonzero(np.diff(gram, prepend=-1))
    return gram[first], np.add.reduceat(count[at], first) if len(first) else count[:0]


def place(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, found) of each x in sorted keys."""
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    i = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return i, keys[i] == x


def lean() -> None:
    """Give back to the system what this worker has freed, and large arrays from now on as they go: else it keeps what a task once took."""
    with contextlib.suppress(OSError, AttributeError):  # of the GNU library only
        own = ctypes.CDLL(None)
        own.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD
        own.malloc_trim(0)


def slot(x: np.ndarray, bits: int) -> np.ndarray:
    return ((x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Lookup:
    """Values by distinct grams: open addressing, probed for whole arrays at a time; the slots hold places of grams."""

    def __init__(self, gram: np.ndarray, value: np.ndarray):
        self.bits = max(4, int(2 * len(gram)).bit_length())
        self.gram, self.value, self.at = gram, value, np.full(1 << self.bits, -1, np.int32)
        at, todo = slot(gram, self.bits), np.arange(len(gram), dtype=np.int32)
        while len(todo):
            free = self.at[at] == -1
            self.at[at[free]] = todo[free]  # of several for one slot the last stays
            left = self.at[at] != todo
            at, todo = (at[left] + 1) & ((1 << self.bits) - 1), todo[left]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The values of grams, all of which must be there."""
        out = np.zeros(len(x), self.value.dtype)
        for k in range(0, len(x), 1 << 18):
            y = x[k : k + (1 << 18)]
            i = slot(y, self.bits)
            at = self.at[i]
            todo = np.flatnonzero(self.gram[at] != y)
            while len(todo):
                i[todo] = (i[todo] + 1) & ((1 << self.bits) - 1)
                at[todo] = self.at[i[todo]]
                todo = todo[self.gram[at[todo]] != y[todo]]
            out[k : k + (1 << 18)] = self.value[at]
        return out


@dataclass(frozen=True)
class Level:
    """The nodes of one order: grams with counts; contexts with their total, their distinct bytes, and the total that these bytes have after the next shorter context."""

    gram: np.ndarray
    count: np.ndarray
    context: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    below: np.ndarray


def levels(gram: np.ndarray, count: np.ndarray, order: int, known: list[Level]) -> list[Level]:
    """Levels 0..order of grams (distinct, in order) that were learned; known: the lowest levels, if built already."""
    grams_of = {order: (gram, count)}
    for n in range(order - 1, len(known) - 1, -1):
        g, c = grams_of[n + 1]
        grams_of[n] = summed(g & ((1 << 8 * (n + 1)) - 1), c)
    out = list(known)
    for n in range(len(known), order + 1):
        g, c = grams_of[n]
        context = g >> 8
        first = np.flatnonzero(np.diff(context, prepend=-1))
        add = lambda v, first=first: np.add.reduceat(v, first) if len(first) else v[:0]
        low = out[n - 1].count[place(out[n - 1].gram, g & ((1 << 8 * n) - 1))[0]] if n and len(g) else np.zeros(len(g), np.int64)
        out.append(Level(g, c, context[first], add(c), np.diff(np.append(first, len(g))), add(low)))
    return out


def chances(query: np.ndarray, trie: list[Level]) -> np.ndarray:
    """log10 probability of the last byte of each gram after the bytes before it, float64."""
    out, left = np.zeros(len(query)), np.ones(len(query), bool)
    gone_total, gone = np.zeros(len(query), np.int64), np.zeros(len(query), np.int64)  # of the bytes excluded
    for n in range(len(trie) - 1, -1, -1):
        v, x = trie[n], query & ((1 << 8 * (n + 1)) - 1)
        i, known = place(v.context, x >> 8)
        at = lambda a, i=i, known=known: np.where(known, a[i], 0) if len(a) else np.zeros(len(i), np.int64)
        distinct = at(v.distinct)
        new = distinct - gone
        size = (at(v.total) - gone_total + new).astype(np.float64)
        j, has = place(v.gram, x)
        hit, escape = left & has, left & ~has & (new > 0)
        out[hit] += np.log10(v.count[j[hit]] / size[hit]) if hit.any() else 0.0
        out[escape] += np.log10(new[escape] / size[escape])
        left &= ~has
        gone_total, gone = at(v.below), distinct
    out[left] -= np.log10(256.0 - gone[left])
    return out


def pack(x: np.ndarray) -> bytes:
    """Longs as zstandard of the byte planes of their differences."""
    import zstandard

    d = np.diff(x.astype("<i8"), prepend=np.int64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(x: bytes) -> np.ndarray:
    import zstandard

    b = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8)
    return np.cumsum(np.ascontiguousarray(b.reshape(8, -1).T).reshape(-1).view("<i8"))


def _count_chunks(s: Settings, shards: int):
    """Rows of a chunk: its distinct words (w, n) and grams (shard, grams, counts, their bytes n) with training counts; and training trigrams (gram, n) of the task."""

    def row(size: int, **cols) -> pa.RecordBatch:
        return pa.record_batch([cols[f.name] if f.name in cols else pa.nulls(size, f.type) for f in _COUNTED], schema=_COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        words: dict[int, list[tuple[pa.Array, np.ndarray]]] = {}
        trees: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        tri = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: dict[int, int] = {}

        def out(chunk: int) -> Iterator[pa.RecordBatch]:
            parts = words.pop(chunk)
            held.pop(chunk)
            t = pa.table({"w": pa.concat_arrays([w for w, _ in parts]), "n": np.concatenate([n for _, n in parts])}).group_by("w").aggregate([("n", "sum")])
            w = t["w"].combine_chunks()
            yield row(len(w), chunk=pa.array(np.full(len(w), chunk, np.int64)), w=w, n=t["n_sum"].combine_chunks())

        def tree(chunk: int) -> Iterator[pa.RecordBatch]:
            g, c = trees.pop(chunk)
            context = (g >> 8) & 0xFFFFFF
            shard = (mix(context.astype(np.uint64), 3) % np.uint64(shards)).astype(np.int64)
            at = np.argsort(shard, kind="stable")
            ends = np.append(np.flatnonzero(np.diff(shard[at], prepend=-1)), len(at))
            mine = [at[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]
            m = len(mine)
            gs, cs = [pack(g[x]) for x in mine], [pack(c[x]) for x in mine]
            size = pa.array([len(x) + len(y) for x, y in zip(gs, cs, strict=True)], pa.int64())
            yield row(m, chunk=pa.array(np.full(m, chunk, np.int64)), n=size, shard=pa.array([int(shard[x[0]]) for x in mine], pa.int32()), grams=pa.array(gs, pa.binary()), counts=pa.array(cs, pa.binary()))

        for whole in batches:
            for b in slices(whole, "text", s.slice_bytes):
                train = np.asarray(b.column("train").fill_null(True).cast(pa.int8()), dtype=np.int64)
                chunks = np.asarray(b.column("chunk"))
                enc, off, _ = tokens(b.column("text"))
                doc = np.repeat(np.arange(b.num_rows), np.diff(off))
                code = np.asarray(enc.indices)
                for c in np.unique(chunks):
                    for learned in (0, 1):
                        g, _ = grams(b.column("text").filter(pa.array((chunks == c) & (train == learned))), s.order)
                        u, n = np.unique(g, return_counts=True)
                        if learned:
                            low = summed(u & 0xFFFFFF, n)
                            tri = summed(np.concatenate([tri[0], low[0]]), np.concatenate([tri[1], low[1]]))
                        old = trees.get(int(c), (u[:0], n[:0]))
                        trees[int(c)] = summed(np.concatenate([old[0], u]), np.concatenate([old[1], n * learned]))
                    mine = chunks[doc] == c
                    k = np.bincount(code[mine], weights=train[doc[mine]], minlength=len(enc.dictionary)).astype(np.int64)
                    has = np.bincount(code[mine], minlength=len(enc.dictionary)) > 0
                    words.setdefault(int(c), []).append((enc.dictionary.filter(pa.array(has)), k[has]))
                    held[int(c)] = held.get(int(c), 0) + int(has.sum())
                while sum(held.values()) > 2_000_000:
                    yield from out(max(held, key=held.get))
                while sum(len(g) for g, _ in trees.values()) > 8_000_000:
                    yield from tree(max(trees, key=lambda c: len(trees[c][0])))
        for c in list(words):
            yield from out(c)
        for c in list(trees):
            yield from tree(c)
        if len(tri[0]):
            yield row(len(tri[0]), n=pa.array(tri[1]), gram=pa.array(tri[0].astype(np.int32)))
        lean()

    return run


_COUNTED = pa.schema([("chunk", pa.int64()), ("w", pa.string()), ("n", pa.int64()), ("gram", pa.int32()), ("shard", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())])
_near: dict[str, list[Level]] = {}


class Sums:
    """Counts of grams, added up from packed rows."""

    def __init__(self):
        self.parts, self.size = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0

    def add(self, grams: bytes, counts: bytes) -> None:
        g, c = unpack(grams), unpack(counts)
        self.parts.append((g[c > 0], c[c > 0]))
        self.size += len(g)
        if self.size > 4_000_000:
            self.parts, self.size = [self.all()], 0

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        return summed(*map(np.concatenate, zip(*self.parts, strict=True)))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (shard, part), a row for each of them with the sums of its counts."""

    def out(key: tuple[int, int], sums: Sums) -> pa.RecordBatch:
        g, c = sums.all()
        return pa.record_batch([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([pack(g)], pa.binary()), pa.array([pack(c)], pa.binary())], names=["shard", "part", "grams", "counts"])

    last, sums = None, Sums()
    for b in batches:
        for shard, part, g, c in zip(*(b.column(x).to_pylist() for x in ("shard", "part", "grams", "counts")), strict=True):
            if (shard, part) != last:
                if last is not None:
                    yield out(last, sums)
                last, sums = (shard, part), Sums()
            sums.add(g, c)
    if last is not None:
        yield out(last, sums)


def _parted(tree: DataFrame, s: Settings) -> DataFrame:
    """(shard, part, chunk, grams, counts): the rows of a large shard dealt over parts, each with the shard's sums."""
    size = tree.groupBy("shard").agg(F.sum("n").alias("n")).filter(F.col("n") > s.shard_bytes)
    hot = stash(size.select("shard", F.ceil(F.col("n") / s.shard_bytes).cast("int").alias("parts")), "hot")
    if hot.limit(1).count() == 0:
        return tree.select("shard", F.lit(0).alias("part"), "chunk", "grams", "counts")
    n = partitions(tree.sparkSession)
    few = maybe_broadcast(hot, 200_000)
    part = F.coalesce(F.pmod(F.xxhash64("chunk"), F.col("parts")).cast("int"), F.lit(0))
    dealt = tree.join(few, "shard", "left").withColumn("part", part)
    schema = "shard int, part int, grams binary, counts binary"
    sums = dealt.filter("parts is not null").select("shard", "part", "grams", "counts").repartition(n, "shard", "part").sortWithinPartitions("shard", "part").mapInArrow(_merge, schema)
    sums = stash(sums.withColumn("part", F.lit(0)).repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(_merge, schema), "sums")
    each = sums.drop("part").join(few, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    teach = each.select("shard", "part", F.lit(None).cast("long").alias("chunk"), "grams", "counts")
    return dealt.select("shard", "part", "chunk", "grams", F.when(F.col("parts").isNull(), F.col("counts")).alias("counts")).union(teach)


def _shard(s: Settings, model, key: str):
    """The part of the trie below some contexts of three bytes: (chunk, grams, logs) for each row of grams of a chunk.

    Rows without a chunk only teach, rows without counts only ask.
    """

    def run(t: pa.Table) -> pa.Table:
        lean()
        if key not in _near:
            _near.clear()
            _near[key] = levels(*model.value, 2, [])
        rows = list(zip(t["chunk"].to_pylist(), t["grams"].to_pylist(), t["counts"].to_pylist(), strict=True))
        learned = Sums()
        for _, g, c in rows:
            if c is not None:
                learned.add(g, c)
        gram, count = learned.all()
        trie = levels(gram, count, s.order, _near[key]) if s.order > 2 else _near[key]
        rows = [x for x in rows if x[0] is not None]
        logs = [chances(unpack(g), trie).astype(np.float32).tobytes() for _, g, _ in rows]
        return pa.table({"chunk": pa.array([c for c, _, _ in rows], pa.int64()), "grams": pa.array([g for _, g, _ in rows], pa.binary()), "logs": pa.array(logs, pa.binary())})

    return run


def tokens(col: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, pa.Array]:
    """(dictionary-coded words, offsets of the texts, ...): lower-cased A-Z, split at ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(col.fill_null("")))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    off = np.asarray(lists.offsets, dtype=np.int64)
    flat = lists.values.slice(int(off[0]), int(off[-1] - off[0]))
    real = pc.not_equal(flat, "")
    keep = np.asarray(real, dtype=bool)
    total = np.concatenate([[0], np.cumsum(keep)])
    return flat.filter(real).dictionary_encode(), total[off - off[0]], flat


def _score(s: Settings, sums):
    """Score the texts of a chunk, given the chunk's words with their totals and its grams with their log-probabilities."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lean()
        tree = right.filter(pc.is_valid(right["grams"]))
        gram = np.concatenate([np.zeros(0, np.int64), *map(unpack, tree["grams"].to_pylist())])
        logs = np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(x, np.float32) for x in tree["logs"].to_pylist()]])
        lookup = Lookup(gram, logs)
        total, ends, distinct = sums
        known = right.filter(pc.greater(right["c"], 0))
        vocabulary = known["w"].combine_chunks()
        if isinstance(vocabulary, pa.ChunkedArray):
            vocabulary = pa.concat_arrays(vocabulary.chunks) if vocabulary.num_chunks else pa.array([], pa.string())
        counts = np.asarray(known["c"], dtype=np.float64)
        out = []
        base = np.log10(total + distinct + 1.0)
        for whole in left.to_batches():
            for b in slices(whole, "text", s.slice_bytes):
                enc, off, _ = tokens(b.column("text"))
                at = pc.index_in(enc.dictionary, vocabulary)
                c = np.zeros(len(enc.dictionary))
                ok = np.asarray(at.is_valid(), dtype=bool)
                c[ok] = counts[np.asarray(at.drop_null())]
                code = np.asarray(enc.indices)
                logc = np.log10(c + 1.0)
                n = np.diff(off)
                add = lambda v: _sums(v[code], off)
                end_log = np.log10(ends + 1.0)
                score = add(logc) + end_log - base * (n + 1)
                g, go = grams(b.column("text"), s.order)
                out.append(pa.record_batch([b.column("_rid"), b.column("doc_id"), pc.invert(b.column("train").fill_null(True)), pa.array(n + 1), pa.array(_sums(ok.astype(np.int64)[code], off) + int(ends > 0)), pa.array(np.full(len(n), total)), pa.array(score), pa.array(_sums(lookup(g).astype(np.float64), go))], names=["_rid", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.Table.from_batches(out) if out else _EMPTY.empty_table()

    return run


_EMPTY = pa.schema([("_rid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _sums(v: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of v in each range; summed range by range, so that long inputs lose no digits."""
    out = np.zeros(len(off) - 1, v.dtype)
    full = np.flatnonzero(np.diff(off) > 0)
    if len(full):
        out[full] = np.add.reduceat(v, off[full])
    return out


def score(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    score is the sum of log10 probabilities of all bytes of the text and its end. A null text counts as empty: one
    token, the end. A null doc_id is learned from. With nothing to learn from, N and V are 0 and all bytes are equally
    likely. Repeated rows are learned from and scored one by one. An empty table gives an empty result. Other columns
    are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(partitions(spark), int(size // s.chunk_bytes) + 1)
    train = F.coalesce(remainder(F.col("doc_id"), s.modulus) != s.held_out, F.lit(True))
    base = docs.select("doc_id", "text") if "_rid" not in docs.columns else docs.select("doc_id", "text", "_rid")
    d = with_rid(base).select("_rid", F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"), train.alias("train"))
    d = d.withColumn("chunk", F.pmod(F.xxhash64("_rid"), F.lit(n)).cast("long"))
    dealt = d.repartition(n, "chunk")
    counted = stash(dealt.mapInArrow(_count_chunks(s, n), "chunk long, w string, n long, gram int, shard int, grams binary, counts binary"), "counted")
    word = counted.filter("w is not null").select("chunk", "w", "n")
    totals = stash(word.groupBy("w").agg(F.sum("n").alias("c")), "totals")
    known = totals.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = d.filter("train").count()
    sums = (known["n"] + ends, ends, known["v"] + (ends > 0))
    low = counted.filter("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")).orderBy("gram").toArrow()  # 2^24 rows at most
    model = spark.sparkContext.broadcast((np.asarray(low["gram"], dtype=np.int64), np.asarray(low["n"], dtype=np.int64)))
    tree = _parted(counted.filter("shard is not null").select("shard", "chunk", "n", "grams", "counts"), s).groupBy("shard", "part").applyInArrow(_shard(s, model, uuid.uuid4().hex), "chunk long, grams binary, logs binary")
    back = word.select("chunk", "w").join(totals.filter("c > 0"), "w").select("chunk", "w", "c").unionByName(tree, allowMissingColumns=True)
    schema = "_rid long, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(_score(s, sums), schema).drop("_rid")


def query(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), Settings(order=5))

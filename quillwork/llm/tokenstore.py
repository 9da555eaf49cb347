"""Token ids in files of independent zstandard frames with a trailing seek table and a checksum for each frame.

Layout: frames, one after the other, each a zstandard frame with its content checksum, of the ids of some documents as
little-endian unsigned 32-bit integers; then a skippable frame (magic 0x184D2A5E) with the seek table: for each frame
its compressed size, its size and the low 32 bits of the xxh64 of its content, then the number of frames, a descriptor
byte with bit 7 set (checksums), and the magic 0x8F92EAB1, as in the public zstd seekable format. Before it, a skippable
frame (magic 0x184D2A50) holds the document table: row id, document id, and number of ids, 64 bits each. Its
own size is in its header, and the seek table's last 17 bytes are preceded by nothing else, so a reader needs two reads
from the end of the file and then only the frames of the documents it wants.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Known, buffers, gathered, listed, partitions, prepare, scratch, slices, stash, with_rid
from .store import published, random_access

SEEK_MAGIC, DOCS_MAGIC, END_MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1


@dataclass(frozen=True)
class Settings:
    tokenizer: str = ""  # path of a tokenizers file; "": byte_bpe_50k.json of the public tokenizers
    end_id: int = 0
    frame_ids: int = 1 << 16  # ids after which a frame ends, at a document's end
    level: int = 3
    slice_bytes: int = 4 << 20
    kept_words: int = 400_000


class Writer:
    """Writes one file. add() takes the ids of one document."""

    def __init__(self, f, s: Settings):
        self.f, self.s = f, s
        self.pack = zstandard.ZstdCompressor(level=s.level, write_checksum=True, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.n = 0

    def add(self, rid: int, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((rid, NULL if doc_id is None else doc_id, len(ids)))
        self.held.append(ids)
        self.n += len(ids)
        if self.n >= self.s.frame_ids:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.held:
            return
        raw = np.concatenate(self.held).astype("<u4").tobytes()
        packed = self.pack.compress(raw)
        self.f.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.n = [], 0

    def close(self) -> None:
        self.end_frame()
        table = np.array(self.docs, "<i8").reshape(-1, 3).tobytes()
        packed = self.pack.compress(table)
        self.f.write(struct.pack("<II", DOCS_MAGIC, len(packed)) + packed)
        body = b"".join(struct.pack("<III", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, END_MAGIC)
        self.f.write(struct.pack("<II", SEEK_MAGIC, len(body)) + body + struct.pack("<I", len(packed)) + b"QWTK")


NULL = -(1 << 63)


class Reader:
    """Reads one file: its tables at once, its frames on demand."""

    def __init__(self, f):
        self.f = f
        end = f.size()
        f.seek(end - 17)
        tail = f.read(17)
        n, flags, magic, docs, own = struct.unpack("<IBII4s", tail)
        if magic != END_MAGIC or own != b"QWTK" or not flags & 0x80:
            raise ValueError("not a token file, or cut off")
        body = n * 12 + 9
        start = end - 8 - body - 8
        f.seek(start - docs - 8)
        block = f.read(docs + 16 + n * 12)
        magic, size = struct.unpack("<II", block[:8])
        if magic != DOCS_MAGIC or size != docs:
            raise ValueError("the document table is damaged")
        self.unpack = zstandard.ZstdDecompressor()
        self.docs = np.frombuffer(self.unpack.decompress(block[8 : 8 + docs]), "<i8").reshape(-1, 3)
        self.frames = np.frombuffer(block[16 + docs :], "<u4").reshape(-1, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.ids_before = np.concatenate([[0], np.cumsum(self.frames[:, 1] // 4)])
        self.start = np.concatenate([[0], np.cumsum(self.docs[:, 2])])

    def frame(self, k: int) -> np.ndarray:
        self.f.seek(int(self.at[k]))
        raw = self.unpack.decompress(self.f.read(int(self.frames[k, 0])))
        if len(raw) != self.frames[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, "<u4")

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document; only its frame is read."""
        k = int(np.searchsorted(self.ids_before, self.start[i], "right")) - 1
        at = int(self.start[i] - self.ids_before[k])
        return self.frame(k)[at : at + int(self.docs[i, 2])]

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """All documents in file order; each frame is read once."""
        i = 0
        for k in range(len(self.frames)):
            ids, n = self.frame(k), 0
            while i < len(self.docs) and n < len(ids):
                m = int(self.docs[i, 2])
                yield i, ids[n : n + m]
                n += m
                i += 1


class Encoder:
    """A tokenizer of the library, and what a worker remembers of the words that it has met."""

    def __init__(self, s: Settings):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        path = s.tokenizer
        if not path:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        #: strings that the library takes out of a text before it looks at words
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        #: whether words can be encoded apart: byte-level pieces cut by the one public pattern, and nothing else at work
        self.by_words = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and model.get("type") == "BPE" and not model.get("dropout") and not any(x.get("lstrip") or x.get("rstrip") for x in spec.get("added_tokens", []))
        self.known = Known(s.kept_words)
        self.bytes_of = np.zeros(1 + max(self.lib.get_vocab().values()), np.int64)
        for piece, i in self.lib.get_vocab().items():  # a byte is one character of a byte-level piece
            self.bytes_of[i] = len(piece)

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of texts, each by itself."""
        size, flat = [], [np.zeros(0, np.uint32)]
        for i in range(0, len(texts), 1024):
            for e in self.lib.encode_batch_fast(texts[i : i + 1024], add_special_tokens=False):
                x = np.array(e.ids, np.uint32)
                size.append(len(x))
                flat.append(x)
        return np.array(size, np.int64), np.concatenate(flat)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of words. Plain ones are joined and encoded many at a time.

        A plain word has no white space but one leading space; one without it gets a line feed before it, which is a
        piece of its own there. So the pattern cuts the joined text where the words meet.
        """
        data, off = buffers(words)
        n = len(words)
        odd = (data <= 32) | (data == 127) | (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)) | (data >= 0xEE)
        lead = data[off[:-1]] == 32
        strange = np.add.reduceat(odd.astype(np.int64), off[:-1]) if n else np.zeros(0, np.int64)
        plain = (strange - lead == 0) & (np.diff(off) > lead)
        size, ids = np.zeros(n, np.int64), {}
        rest = np.flatnonzero(~plain)
        at = np.flatnonzero(plain)
        for i in range(0, len(at), 8192):
            part = at[i : i + 8192]
            feed = (~lead[part]).astype(np.int64)
            length = np.diff(off)[part] + feed
            end = np.cumsum(length)
            src = np.repeat(off[part] - (end - length) - feed, length) + np.arange(end[-1])
            starts = end - length
            joined = data[np.maximum(src, 0)]
            joined[starts[feed > 0]] = 10
            got = np.array(self.lib.encode_batch_fast([joined.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
            to = np.concatenate([[0], np.cumsum(self.bytes_of[got])])
            first = np.searchsorted(to, starts + feed)
            last = np.searchsorted(to, end)
            if to[-1] != end[-1] or not (np.array_equal(to[first], starts + feed) and np.array_equal(to[last], end)):
                rest = np.concatenate([rest, part])
                continue
            size[part] = last - first
            ids[i] = (part, got[np.repeat(first - (np.cumsum(last - first) - (last - first)), last - first) + np.arange((last - first).sum())])
        if len(rest):
            size[rest], x = self.each(words.take(pa.array(rest)).to_pylist())
            ids[-1] = (rest, x)
        start = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.uint32)
        for part, x in ids.values():
            k = size[part]
            flat[np.repeat(start[part] - (np.cumsum(k) - k), k) + np.arange(len(x))] = x
        return size, flat


_encoders: dict[Settings, Encoder] = {}


def encoder(s: Settings) -> Encoder:
    if s not in _encoders:
        _encoders[s] = Encoder(s)
    return _encoders[s]


def parts(col: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(parts, offsets of the texts): texts cut before each space that a character other than white space follows, and
    on both sides of a single line feed within other characters.

    The byte-level pattern never joins across such a place, so the parts' ids are the texts' ids. The test of the
    neighbours is made for ASCII; before any other byte no cut is made unless it starts a Latin or Greek letter, which
    is no white space either.
    """
    data, off = buffers(col)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        nxt = data[1:]
        dark = ((nxt > 32) & (nxt < 127)) | ((nxt >= 0xC3) & (nxt <= 0xCF))
        cut[:-2] = (data[:-1] == 32) & dark
        # a control character before the space may be white space of the pattern, which could run over the space
        cut[1:-2] &= (data[:-2] > 32) & (data[:-2] < 127) | (data[:-2] >= 0x80) | (data[:-2] == 32) | (data[:-2] == 10)
        at = np.flatnonzero((data[1:-1] == 10) & dark[1:] & (data[:-2] > 32) & (data[:-2] < 127)) + 1
        cut[at] = cut[at + 1] = True
    cut[off] = True
    b = np.flatnonzero(cut)
    a = pa.Array.from_buffers(pa.string(), len(b) - 1, [None, pa.py_buffer(b.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]) if len(b) > 1 else pa.array([], pa.string())
    return a, np.searchsorted(b, off)


def encode_batch(col: pa.Array, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets), end ids included: the library's ids of each text. Texts are encoded by words where that gives
    the same; one that holds an added token's string, and any text of another kind of tokenizer, goes whole."""
    t = encoder(s)
    col = col.fill_null("")
    whole = np.zeros(len(col), bool) if t.by_words else np.ones(len(col), bool)
    for x in t.added if t.by_words else []:
        whole |= np.asarray(pc.match_substring(col, x), dtype=bool)
    if whole.any():
        at = np.flatnonzero(whole)
        n, apart = t.each(col.take(pa.array(at)).to_pylist())
        col = pc.if_else(pa.array(whole), "", col)
    ps, off = parts(col)
    enc = ps.dictionary_encode()
    code = np.asarray(enc.indices, dtype=np.int64)
    first, size, flat = t.known.ids(enc.dictionary, t.words)
    m = len(off) - 1
    k = size[code]
    total = np.concatenate([[0], np.cumsum(k)])
    body = total[off]  # ids of the parts before each text
    src = flat[np.repeat(first[code] - total[:-1], k) + np.arange(total[-1])]
    count = np.diff(body)
    if whole.any():
        count[at] = n
    to = np.concatenate([[0], np.cumsum(count + 1)])
    out = np.full(int(to[-1]), s.end_id, np.uint32)
    doc = np.repeat(to[:-1] - body[:-1], np.diff(body))
    out[doc + np.arange(len(src))] = src
    if whole.any():
        out[np.repeat(to[at] - (np.cumsum(n) - n), n) + np.arange(len(apart))] = apart
    return out, to


def _write(s: Settings, base: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        uri = f"{base}/ids-{part:06d}.qwtk"
        docs = ids = 0
        with published(uri) as f:
            w = Writer(f, s)
            for whole in batches:
                for b in slices(whole, "text", s.slice_bytes):
                    x, off = encode_batch(b.column("text"), s)
                    for i, (r, d) in enumerate(zip(b.column("_rid").to_pylist(), b.column("doc_id").to_pylist(), strict=True)):
                        w.add(r, d, x[off[i] : off[i + 1]])
                    docs, ids = docs + b.num_rows, ids + len(x)
            w.close()
        yield pa.record_batch([pa.array([part], pa.int64()), pa.array([uri]), pa.array([docs], pa.int64()), pa.array([ids], pa.int64())], names=["part", "uri", "docs", "ids"])

    return run


def write(docs: DataFrame, base: str, s: Settings = Settings()) -> DataFrame:
    """Write the ids of all rows in ascending doc_id order; returns the list of files (part, uri, docs, ids).

    Ranges of doc_id go to one file each. Files get their names only when whole. A null text is empty (only the end
    id); null doc_ids go first; rows with one doc_id go by text. An empty table writes files without documents.
    """
    spark = docs.sparkSession
    prepare(spark)
    d = with_rid(docs.select("doc_id", "text")).select("_rid", F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    dealt = d.repartitionByRange(partitions(spark), "_rid").sortWithinPartitions("_rid")
    return listed(dealt.mapInArrow(_write(s, base), "part long, uri string, docs long, ids long"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, before in zip(batch.column("uri").to_pylist(), batch.column("before").to_pylist(), strict=True):
            with random_access(uri) as f:
                r = Reader(f)
                rows: list[tuple] = []
                for i, ids in r.documents():
                    d = int(r.docs[i, 1])
                    rows.append((None if d == NULL else d, int(r.start[i]) + before, len(ids), zlib.crc32(ids.tobytes())))
                    if len(rows) >= 4000:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read(files: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32; frames are checked as they are read."""
    from pyspark.sql import Window

    spark = files.sparkSession
    prepare(spark)
    # one row for each file
    placed = files.withColumn("before", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    dealt = stash(placed.select("uri", "before"), "placed").repartition(partitions(spark))
    return gathered(dealt.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def query(spark, sf_dir: str) -> DataFrame:
    return read(write(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch(spark)))

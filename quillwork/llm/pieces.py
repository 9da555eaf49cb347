"""SentencePiece encoding and decoding by a forward pass shared among words with a common prefix.

The distinct marked words of a batch are sorted and walked as a trie, depth first: a node keeps the forward state of
its prefix, and a word starts from the node of the prefix that it shares with the word before it.

The models are of two kinds. For a unigram model the state is the best score and the length of the last piece
(Viterbi). For a BPE model the best sum of scores is not what the model defines, so the state is the last piece of the
prefix's own encoding: it is the one piece that ends there and whose pair with the last piece before it is stable,
which holds because every prefix of an encoding, cut at a piece's end, is that prefix's encoding. Either way the
ids equal those of the sentencepiece library.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Known, buffers, gathered, prepare, slices

MARK = "▁"


@dataclass(frozen=True)
class Settings:
    model: str = ""  # path of the model file; "": piece_bpe_32k.model of the public tokenizers
    slice_bytes: int = 4 << 20
    kept_words: int = 400_000  # words whose ids a worker remembers; beyond it, it starts anew


#: Fixed value: the number of the BPE kind in a model file.
BPE = 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message in the public protocol-buffer wire format."""

    def varint(i: int) -> tuple[int, int]:
        v = shift = 0
        while True:
            v |= (data[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if data[i - 1] < 128:
                return v, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            v, i = varint(i)
            yield key >> 3, v
        else:
            n, i = varint(i) if kind == 2 else (8 if kind == 1 else 4, i)
            yield key >> 3, data[i : i + n]
            i += n


def model_type(path: str) -> int:
    """The kind of a model file: field 3 of its trainer's settings (field 2), 1 (unigram) if not stated."""
    with open(path, "rb") as f:
        spec = dict(fields(f.read())).get(2, b"")
    return dict(fields(spec)).get(3, 1)


class Model:
    """Pieces, ids and scores of a model file; the library reads the file, the encoding is ours."""

    def __init__(self, path: str):
        import sentencepiece

        if not path:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        self.lib = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_known = sp.is_byte(self.byte[0])
        self.unk = sp.unk_id()
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.longest = max(map(len, self.ids), default=1)
        ranked = [self.score[p] for p in self.ids]
        self.bpe = model_type(path) == BPE
        self.stable: dict[int, bool] = {}
        self.most_pairs = 400_000
        #: by the last two characters: the lengths of the pieces that end so, longest first
        ends: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) > 1:
                ends.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {x: tuple(sorted(v, reverse=True)) for x, v in ends.items()}
        self.lowest = min(ranked, default=0.0) - 10
        out = bytearray()
        at = [0]
        for i, p in enumerate(self.piece):
            out += bytes([self.byte.index(i)]) if sp.is_byte(i) else b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else p.replace(MARK, " ").encode()
            at.append(len(out))
        self.out, self.at = np.frombuffer(bytes(out), np.uint8), np.array(at)

    def merge(self, word: str) -> list[str]:
        """Encode one string by merges of the best pair, leftmost first."""
        s = list(word)
        while len(s) > 1:
            best, at = None, -1
            for i in range(len(s) - 1):
                v = self.score.get(s[i] + s[i + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, i
            if best is None:
                break
            s[at : at + 2] = [s[at] + s[at + 1]]
        return s

    def text_of(self, piece: int) -> str:
        """A piece's characters; numbers beyond the pieces stand for single characters that are none."""
        return self.piece[piece] if piece < len(self.piece) else chr(piece - len(self.piece))

    def is_stable(self, a: int, b: int) -> bool:
        """Whether the pieces a, b are the encoding of their join; a = -1: whether merges reach b from its characters."""
        x, y = self.text_of(a) if a >= 0 else "", self.text_of(b)
        if len(self.stable) > self.most_pairs:
            self.stable.clear()
        v = self.stable[(a + 1) * PAIR + b] = self.merge(x + y) == ([x, y] if x else [y])
        return v

    def fallback(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode()] if self.bytes_known else [self.unk]

    def encode_sorted(self, words: list[str]) -> tuple[list[int], list[int]]:
        """(numbers of ids, ids of all words one after the other) of words, which come sorted.

        A node of the trie keeps its last piece and its length, and for a unigram model its score; a word's ids are
        read off backwards from its last node, so memory and time are linear in its length.
        """
        path = ""  # the prefix whose nodes are held
        size, last, best = [0], [-1], [0.0]  # by length of the prefix
        known, stable, lengths, n = self.ids, self.stable, self.lengths, len(self.piece)
        counts: list[int] = []
        flat: list[int] = []
        for w in words:
            k, most = 0, min(len(w), len(path))
            while k < most and w[k] == path[k]:
                k += 1
            del size[k + 1 :], last[k + 1 :], best[k + 1 :]
            if self.bpe:
                for i in range(k + 1, len(w) + 1):
                    for m in lengths.get(w[i - 2 : i] if i > 1 else "", ()):
                        p = known.get(w[i - m : i]) if m <= i else None
                        if p is not None:
                            key = (last[i - m] + 1) * PAIR + p
                            ok = stable.get(key)
                            if ok is None:
                                ok = self.is_stable(last[i - m], p)
                            if ok:
                                size.append(m)
                                last.append(p)
                                break
                    else:
                        size.append(1)
                        last.append(known.get(w[i - 1], n + ord(w[i - 1])))
            else:
                for i in range(k + 1, len(w) + 1):
                    take, score = 1, best[i - 1] + self.lowest
                    for m in range(1, min(self.longest, i) + 1):
                        v = self.score.get(w[i - m : i])
                        if v is not None and best[i - m] + v > score:
                            take, score = m, best[i - m] + v
                    size.append(take)
                    last.append(known.get(w[i - take : i], n + ord(w[i - 1])))
                    best.append(score)
            path = w
            out = []
            i = len(w)
            while i:
                if last[i] < n:
                    out.append(last[i])
                else:
                    out += reversed(self.fallback(w[i - 1]))
                i -= size[i]
            counts.append(len(out))
            flat += reversed(out)
        return counts, flat


#: More than there are pieces and characters together; a pair of pieces is one number.
PAIR = 1 << 22


class Encoder:
    """A model and what a worker remembers of the words that it has met."""

    def __init__(self, s: Settings):
        self.model, self.known = Model(s.model), Known(s.kept_words)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of marked words."""
        order = pc.array_sort_indices(words)
        names = [w.replace(" ", MARK) for w in words.take(order).to_pylist()]
        counts, flat = self.model.encode_sorted(names)
        at = np.asarray(order)
        k = np.array(counts, np.int64)
        size = np.zeros(len(k), np.int64)
        size[at] = k
        ids = np.array(flat, np.uint32)
        start = np.cumsum(k) - k  # where the sorted words' ids are
        first = np.zeros(len(k), np.int64)
        first[at] = start
        return size, ids[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(len(ids))]


_encoders: dict[Settings, Encoder] = {}


def encoder(s: Settings) -> Encoder:
    if s not in _encoders:
        _encoders[s] = Encoder(s)
    return _encoders[s]


def marked_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, offsets): each text as SentencePiece marks it, cut before each run of marks and round line feeds."""
    col = texts.fill_null("")
    if pc.any(pc.match_substring(col, MARK)).as_py():
        col = pc.replace_substring(col, MARK, " ")
    data, off = buffers(col)
    n = np.diff(off)
    full = n > 0  # an empty text has no dummy mark
    o = np.concatenate([[0], np.cumsum(n + full)])
    d = np.full(o[-1], 32, np.uint8)
    at = np.ones(o[-1], bool)
    at[o[:-1][full]] = False
    d[at] = data
    space, feed = d == 32, d == 10
    cut = np.zeros(len(d) + 1, bool)
    cut[1 : len(d)] = (space[1:] & ~space[:-1]) | (feed[1:] != feed[:-1])
    cut[o] = True
    b = np.flatnonzero(cut)
    ws = pa.Array.from_buffers(pa.string(), len(b) - 1, [None, pa.py_buffer(b.astype(np.int32)), pa.py_buffer(d)]) if len(b) > 1 else pa.array([], pa.string())
    return ws, np.searchsorted(b, o)


def encode_batch(texts: pa.Array, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of all texts; nulls as empty."""
    e = encoder(s)
    ws, off = marked_words(texts)
    enc = ws.dictionary_encode()
    code = np.asarray(enc.indices, dtype=np.int64)
    first, size, flat = e.known.ids(enc.dictionary, e.words)
    k = size[code]
    total = np.concatenate([[0], np.cumsum(k)])
    ids, at = flat[np.repeat(first[code] - total[:-1], k) + np.arange(total[-1])].astype(np.int32), total[off]
    if not e.model.bytes_known:  # a run of unknown characters is one unknown piece
        unk = ids == e.model.unk
        again = np.concatenate([[False], unk[1:] & unk[:-1]]) if len(ids) else unk
        again[at[:-1][at[:-1] < len(ids)]] = False
        ids, at = ids[~again], at - np.concatenate([[0], np.cumsum(again)])[at]
    return ids, at


def decode_batch(ids: np.ndarray, off: np.ndarray, s: Settings) -> list[bytes]:
    """The bytes that the ids stand for; the dummy mark at the start goes."""
    m = encoder(s).model
    size = m.at[ids + 1] - m.at[ids]
    total = np.concatenate([[0], np.cumsum(size)])
    data = m.out[np.repeat(m.at[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
    cut = total[off]
    return [data[a + 1 if data[a : a + 1] == b" " else a : b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _run(s: Settings, want: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = encoder(s).model
        lo, hi = m.byte[0], m.byte[255]
        for whole in batches:
            for b in slices(whole, "text", s.slice_bytes):
                ids, off = encode_batch(b.column("text"), s)
                back = decode_batch(ids, off, s)
                data, to = buffers(b.column("text"))
                raw = data.tobytes()
                same = [raw[to[i] : to[i + 1]].replace(MARK.encode(), b" ") == back[i] for i in range(b.num_rows)]
                u = ids.astype("<u4")
                fall = np.concatenate([[0], np.cumsum((ids >= lo) & (ids <= hi))])
                cols = [b.column("doc_id"), pa.array(np.diff(off)), pa.array(fall[off[1:]] - fall[off[:-1]]), pa.array([zlib.crc32(u[x:y]) for x, y in zip(off[:-1], off[1:], strict=True)], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in back]), pa.array(same)]
                names = ["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "decoded_sha256", "round_trip"]
                if want:
                    cols += [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids)), pa.array([x.decode("utf-8", "replace") for x in back])]
                    names += ["ids", "decoded"]
                yield pa.record_batch(cols, names=names)

    return run


def encode_decode(docs: DataFrame, s: Settings = Settings(), want: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_pieces, n_byte_pieces, ids_crc32, decoded_sha256, round_trip (and ids, decoded).

    A null or empty text has no pieces and decodes to the empty text. The mark character itself in a text counts as
    a space, as in the library. ids_crc32 is over little-endian 32-bit ids. No shuffle; repeated rows each have a row;
    an empty table gives an empty result; other columns are not read.
    """
    prepare(docs.sparkSession)
    schema = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean" + (", ids array<int>, decoded string" if want else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_run(s, want), schema)


def query(spark, sf_dir: str) -> DataFrame:
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), want=False)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: ids and digests of the remaining documents."""
    return gathered(encode_decode(docs).drop("decoded"))

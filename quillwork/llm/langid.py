"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy.

Training is by backpropagation through time on the whole texts of a bounded sample of labelled rows
(Settings.sample_rows, the rows with the least hash of doc_id). A whole text is cut into windows that overlap; in each,
the states of both directions run through the neighbouring bytes first, and every byte gets a probability for each
language in the one window that it is labelled in. A document's probabilities are the mean over all its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, prepare, remainder, slices

PAD = 256


@dataclass(frozen=True)
class Settings:
    modulus: int = 5
    held_out: int = 0  # remainder that is not learned from
    sample_rows: int = 4000  # labelled rows that the network learns from, at most
    window: int = 160  # bytes of a window
    overlap: int = 32  # of these, on each side, bytes that only set the states
    hidden: int = 8  # units in each direction
    epochs: int = 1
    least_steps: int = 400  # small samples are gone over more often
    batch: int = 256
    rate: float = 0.02
    seed: int = 7
    slice_bytes: int = 2 << 20
    lanes: int = 2048  # windows run side by side


def start(langs: int, s: Settings) -> dict[str, np.ndarray]:
    g, h = np.random.default_rng(s.seed), s.hidden
    f = lambda *shape, scale: (g.standard_normal(shape) * scale).astype(np.float32)
    return {"x": f(2, PAD + 1, 3 * h, scale=0.3), "u": f(2, h, 3 * h, scale=1 / np.sqrt(h)), "c": np.zeros((2, 1, h), np.float32), "w": f(2, h, langs, scale=1 / np.sqrt(h)), "b": np.zeros(langs, np.float32)}


def squash(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The squashing function and its slope: x (27 + x^2) / (27 + 9 x^2), which is close to tanh, and 1 beyond 3."""
    x = np.clip(x, -3, 3)
    t = x * x
    return x * (27 + t) / (27 + 9 * t), ((9 - t) / (3 * (3 + t))) ** 2


def squash_in_place(x: np.ndarray, tmp: np.ndarray) -> None:
    np.clip(x, np.float32(-3), np.float32(3), out=x)
    np.multiply(x, x, out=tmp)
    tmp += np.float32(27)
    x *= tmp
    tmp -= np.float32(24)
    tmp *= np.float32(9)
    x /= tmp


def states(p: dict[str, np.ndarray], seq: np.ndarray, keep: bool = False):
    """States after each step, (steps, 2, lanes, hidden); direction 1 runs backwards. seq: (steps, lanes)."""
    n, lanes = seq.shape
    h = p["u"].shape[1]
    out = np.empty((n, 2, lanes, h), np.float32)
    state = np.zeros((2, lanes, h), np.float32)
    x = np.empty((2, lanes, 3 * h), np.float32)
    trace = []
    for t in range(n):
        np.take(p["x"][0], seq[t], axis=0, out=x[0])
        np.take(p["x"][1], seq[n - 1 - t], axis=0, out=x[1])
        v = state @ p["u"]
        zr, slope = squash((x[:, :, : 2 * h] + v[:, :, : 2 * h]) * np.float32(0.5))
        zr, slope = (zr + 1) * np.float32(0.5), slope * np.float32(0.25)
        z, r = zr[:, :, :h], zr[:, :, h:]
        q = v[:, :, 2 * h :] + p["c"]
        m, bend = squash(x[:, :, 2 * h :] + r * q)
        new = m + z * (state - m)
        if keep:
            trace.append((state, z, r, q, m, slope[:, :, :h], slope[:, :, h:], bend))
        out[t] = state = new
    return out, trace


def probabilities(p: dict[str, np.ndarray], out: np.ndarray) -> np.ndarray:
    """(steps, lanes, langs)."""
    e = out[:, 0] @ p["w"][0] + out[::-1, 1] @ p["w"][1] + p["b"]
    e -= e.max(-1, keepdims=True)
    np.exp(e, out=e)
    e /= e.sum(-1, keepdims=True)
    return e


class Runner:
    """The trained network laid out for prediction: lanes innermost, buffers used again, both directions at once."""

    def __init__(self, p: dict[str, np.ndarray], steps: int, lanes: int):
        h = self.h = p["u"].shape[1]
        half = np.ones(3 * h, np.float32)
        half[: 2 * h] = 0.5  # a gate is (1 + squash(x / 2)) / 2
        self.x = np.ascontiguousarray((p["x"] * half).transpose(0, 2, 1))
        self.u = np.ascontiguousarray((p["u"] * half).transpose(0, 2, 1))
        self.c = np.ascontiguousarray(p["c"].transpose(0, 2, 1))
        self.w, self.b = np.ascontiguousarray(p["w"].transpose(0, 2, 1)), p["b"][:, None]
        self.steps, self.lanes = steps, lanes
        f = lambda *shape: np.empty(shape, np.float32)
        self.in_, self.v, self.tmp, self.t2 = f(2, 3 * h, lanes), f(2, 3 * h, lanes), f(2, h, lanes), f(2, 2 * h, lanes)
        self.out = f(steps, 2, h, lanes)

    def __call__(self, seq: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Probabilities (langs, lanes), summed over each window's own bytes. seq, own: (steps, lanes), PAD after the end."""
        h, n, v, x, tmp = self.h, self.steps, self.v, self.in_, self.tmp
        state = np.zeros((2, h, self.lanes), np.float32)
        z, r, q = v[:, :h], v[:, h : 2 * h], v[:, 2 * h :]
        gates, xg, xq = v[:, : 2 * h], x[:, : 2 * h], x[:, 2 * h :]
        for t in range(n):
            np.take(self.x[0], seq[t], axis=1, out=x[0], mode="clip")
            np.take(self.x[1], seq[n - 1 - t], axis=1, out=x[1], mode="clip")
            np.matmul(self.u, state, out=v)
            gates += xg
            squash_in_place(gates, self.t2)
            gates += np.float32(1)
            gates *= np.float32(0.5)
            q += self.c
            q *= r
            q += xq
            squash_in_place(q, tmp)
            np.subtract(state, q, out=tmp)
            np.multiply(tmp, z, out=tmp)
            state = self.out[t]
            np.add(tmp, q, out=state)
        total = np.zeros((len(self.b), self.lanes), np.float32)
        for t in range(n):
            e = self.w[0] @ self.out[t, 0]
            e += self.w[1] @ self.out[n - 1 - t, 1]
            e += self.b
            e -= e.max(0)
            np.exp(e, out=e)
            e *= own[t] / e.sum(0)
            total += e
        return total


def gradients(p: dict[str, np.ndarray], seq: np.ndarray, lang: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over real bytes, and its gradients."""
    n, lanes = seq.shape
    h = p["u"].shape[1]
    out, trace = states(p, seq, True)
    prob = probabilities(p, out)
    real = (seq != PAD).astype(np.float32)
    scale = real / max(real.sum(), 1.0)
    loss = float(-(np.log(np.maximum(prob[:, np.arange(lanes), lang], 1e-9)) * scale).sum())
    d = prob
    d[:, np.arange(lanes), lang] -= 1
    d *= scale[:, :, None]
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["b"] = d.sum((0, 1))
    back = out[::-1, 1]
    g["w"][0] = np.einsum("tlh,tlk->hk", out[:, 0], d, optimize=True)
    g["w"][1] = np.einsum("tlh,tlk->hk", back, d, optimize=True)
    dh = np.stack([d @ p["w"][0].T, (d @ p["w"][1].T)[::-1]], 1)
    carry = np.zeros((2, lanes, h), np.float32)
    ut = p["u"].transpose(0, 2, 1)
    for t in range(n - 1, -1, -1):
        state, z, r, q, m, zs, rs, bend = trace[t]
        dn = dh[t] + carry
        dm = dn * (1 - z) * bend
        dz = dn * (state - m) * zs
        dq = dm * r
        dr = dm * q * rs
        dv = np.concatenate([dz, dr, dq], 2)
        dx = np.concatenate([dz, dr, dm], 2)
        g["u"] += state.transpose(0, 2, 1) @ dv
        g["c"] += dq.sum(1, keepdims=True)
        carry = dn * z + dv @ ut
        np.add.at(g["x"][0], seq[t], dx[0])
        np.add.at(g["x"][1], seq[n - 1 - t], dx[1])
    return loss, g


def train(windows: np.ndarray, lang: np.ndarray, langs: int, s: Settings) -> dict[str, np.ndarray]:
    """Adam over shuffled batches. windows: (rows, bytes) with PAD at the end."""
    p, g = start(langs, s), np.random.default_rng(s.seed + 1)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    round_ = -(-len(lang) // s.batch)
    epochs = max(s.epochs, -(-s.least_steps // max(round_, 1)))
    step, steps = 0, epochs * round_
    for _ in range(epochs):
        order = g.permutation(len(lang))
        for i in range(0, len(order), s.batch):
            at = order[i : i + s.batch]
            _, grad = gradients(p, np.ascontiguousarray(windows[at].T), lang[at])
            size = np.sqrt(sum(float((x * x).sum()) for x in grad.values()))
            step += 1
            rate = s.rate * (1 - step / (steps + 1))
            for k in p:
                x = grad[k] * np.float32(min(1.0, 1.0 / (size + 1e-9)))
                m[k] += np.float32(0.1) * (x - m[k])
                v[k] += np.float32(0.01) * (x * x - v[k])
                p[k] -= np.float32(rate) * (m[k] / np.float32(1 - 0.9**step)) / (np.sqrt(v[k] / np.float32(1 - 0.99**step)) + np.float32(1e-8))
    return p


def cut(data: np.ndarray, off: np.ndarray, n: int, overlap: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each window, (windows, n) symbols padded at the end, which of them are the window's own).

    Each byte is the own one of one window, which has `overlap` bytes before and after it where the text has any.
    """
    size = np.diff(off)
    step = n - 2 * overlap
    k = -(-size // step)
    who = np.repeat(np.arange(len(size)), k)
    if not len(who):
        return who, np.zeros((0, n), np.int16), np.zeros((0, n), bool)
    first = (np.arange(len(who)) - np.repeat(np.cumsum(k) - k, k)) * step
    at = np.maximum(first - overlap, 0)[:, None] + np.arange(n)
    inside = at < size[who][:, None]
    own = inside & (at >= first[:, None]) & (at < first[:, None] + step)
    return who, np.where(inside, data[np.minimum(at + off[who][:, None], max(len(data) - 1, 0))], np.int16(PAD)), own


def _predict(model, names: list[str], s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Runner(model.value, s.window, s.lanes) if names else None
        for whole in batches:
            for b in slices(whole, "text", s.slice_bytes):
                data, off = buffers(b.column("text"))
                total = np.zeros((b.num_rows, len(names)))
                who, win, own = cut(data, off, s.window, s.overlap)
                for i in range(0, len(who) if names else 0, s.lanes):
                    part = who[i : i + s.lanes]
                    seq, mine = np.full((s.window, s.lanes), PAD, np.intp), np.zeros((s.window, s.lanes), bool)
                    seq[:, : len(part)], mine[:, : len(part)] = win[i : i + s.lanes].T, own[i : i + s.lanes].T
                    np.add.at(total, part, net(seq, mine)[:, : len(part)].T)
                mean = total / np.maximum(np.diff(off), 1)[:, None]
                top = mean.argmax(1) if len(names) else np.zeros(b.num_rows, int)
                letters = np.asarray(b.column("letters"), dtype=bool)
                pred = [names[k] if ok and names else "und" for k, ok in zip(top, letters, strict=True)]
                score = np.where(letters, np.clip(mean[np.arange(len(top)), top], 0, 1), 0.0) if names else np.zeros(b.num_rows)
                yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def fit(docs: DataFrame, s: Settings = Settings()) -> tuple[dict[str, np.ndarray], list[str]]:
    """(parameters, languages) learned from the whole texts and lang of at most s.sample_rows training rows: those with the
    least hash of doc_id, then of text, then the least lang."""
    known = docs.filter((remainder(F.col("doc_id"), s.modulus) != s.held_out) & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    order = F.xxhash64("doc_id")
    # first the hash up to which rows are taken, of hashes alone; texts are sent only of those rows
    edge = known.select(order.alias("h")).orderBy("h").limit(s.sample_rows).agg(F.max("h")).first()[0]
    if edge is None:
        return start(0, s), []
    some = known.filter(order <= edge)
    got = some.orderBy(order, F.xxhash64("text"), "lang").limit(s.sample_rows).select("text", "lang").toArrow()
    names = sorted(set(got["lang"].to_pylist()))
    data, off = buffers(got["text"])
    who, win, _ = cut(data, off, s.window)
    lang = np.array([names.index(x) for x in got["lang"].to_pylist()])[who]
    return train(win, lang, len(names), s), names


def identify(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    A null text or one without a letter is `und` with score 0, as is every text if there is nothing to learn from.
    Null doc_ids are never learned from; their held_out is false. Repeated rows are predicted one by one. An empty
    table gives an empty result. lang, source and doc_id play no part in a prediction.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "lang")
    p, names = fit(docs, s)
    model = spark.sparkContext.broadcast(p)
    held = F.coalesce(remainder(F.col("doc_id"), s.modulus) == s.held_out, F.lit(False))
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", held.alias("held_out"), text.rlike(r"\p{L}").alias("letters"), text.alias("text"))
    return d.mapInArrow(_predict(model, names, s), "doc_id long, held_out boolean, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""External induced sorting of suffixes with common-prefix values (after eSAIS: Bingmann, Fischer and Osipov, 2013).

The text is a set of segments of symbols. Each segment ends in a sentinel, symbol 0, smaller than any other; sentinels
are distinct and ordered by place, so a common prefix never leaves its segment.

A level of the recursion does this. The pieces between the suffixes that start a rise after a fall (S*) are sorted and
named; a piece reaches to the end of the run of equal symbols after the next S*, so that no piece is a prefix of
another, and neighbours' common prefixes come with the names. Unless all names differ, the S* suffixes are sorted by
recursion on the string of names, and their common prefixes follow from those of the names. From the order of the S*
suffixes an ascending scan induces all falling (L) suffixes, and a descending scan all rising (S) ones.

The scans take tuples (place, common prefix with the tuple before it) out of a priority queue, which is a queue for
each range of first symbols. A range of one symbol needs no sorting, as its tuples come in the order of their ranks,
and is read in blocks. A range of several symbols has a bounded number of tuples and is sorted when it is due; what it
induces within itself is ranked by doubling along the chains of induction. Queues beyond the memory budget are
appended to files, and arrays beyond their bound are files mapped into memory, all in a folder of the sort's own.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Limits:
    cap: int = 100  # common prefixes are told up to here, 255 at most
    queue_bytes: int = 4 << 20  # memory of a level's queues
    array_bytes: int = 32 << 20  # larger arrays are files
    block: int = 1 << 16  # tuples handled at a time


class Store:
    """Arrays of a sort: in memory up to a bound each, beyond it in files; close() removes them all."""

    def __init__(self, most: int):
        self.most, self.folder, self.files, self.spills = most, None, 0, 0

    def path(self) -> str:
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="induced-")
        self.files += 1
        return f"{self.folder.name}/{self.files}"

    def zeros(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.most:
            return np.zeros(n, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(n,))

    def close(self) -> None:
        if self.folder is not None:
            self.folder.cleanup()


def whole(n: int):
    """The integer type of places in a text of n symbols."""
    return np.int32 if n < 1 << 31 else np.int64


class Queues:
    """FIFO queues of (place, lcp), one for each range; beyond the budget the fullest go to files of their own."""

    def __init__(self, ranges: int, budget: int, store: Store, place: type):
        self.tuple = np.dtype([("place", place), ("lcp", np.uint8)])
        self.most, self.store, self.total = max(budget // self.tuple.itemsize, 1), store, 0
        self.parts: list[list[np.ndarray]] = [[] for _ in range(ranges)]
        self.held = np.zeros(ranges, np.int64)
        self.files: dict[int, list] = {}  # path, tuples read, tuples written

    def push(self, r: int, place: np.ndarray, lcp: np.ndarray) -> None:
        t = np.empty(len(place), self.tuple)
        t["place"], t["lcp"] = place, lcp
        self.parts[r].append(t)
        self.held[r] += len(t)
        self.total += len(t)
        if self.total > self.most:
            for x in np.argsort(-self.held):
                if self.total <= self.most // 2:
                    break
                self._spill(int(x))

    def _spill(self, r: int) -> None:
        self.store.spills += 1
        f = self.files.setdefault(r, [self.store.path(), 0, 0])
        with open(f[0], "ab") as out:
            for t in self.parts[r]:
                t.tofile(out)
        f[2] += int(self.held[r])
        self._drop(r)

    def _drop(self, r: int) -> None:
        self.total -= int(self.held[r])
        self.held[r] = 0
        self.parts[r] = []

    def pop(self, r: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The next tuples of a range in order, at most `most`; empty if there are none."""
        got = []
        f = self.files.get(r)
        if f is not None:
            n = f[2] - f[1] if most is None else min(most, f[2] - f[1])
            got.append(np.fromfile(f[0], self.tuple, n, offset=f[1] * self.tuple.itemsize))
            f[1] += n
            if f[1] == f[2]:
                os.unlink(f[0])
                del self.files[r]
        if r not in self.files and (most is None or not got):
            got += self.parts[r]
            self._drop(r)
        t = np.concatenate(got) if got else np.empty(0, self.tuple)
        if most is not None and len(t) > most:
            self.parts[r] = [t[most:]]
            self.held[r] = len(t) - most
            self.total += len(t) - most
            t = t[:most]
        return t["place"].copy(), t["lcp"].copy()


def range_min(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(v[lo:hi + 1]) for each pair, lo <= hi."""
    out = np.empty(len(lo), v.dtype)
    table = v
    power = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    for level in range(int(power.max()) + 1 if len(lo) else 0):
        at = np.flatnonzero(power == level)
        if len(at):
            out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << level) + 1])
        step = 1 << level
        if step < len(table):
            table = np.minimum(table[:-step], table[step:])
    return out


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of the suffixes at a and b, up to limit."""
    lcp = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x, y = text[a[live] + lcp[live]], text[b[live] + lcp[live]]
        live = live[(x == y) & (x > 0) & (lcp[live] < limit)]
        lcp[live] += 1
    return lcp


def stars(text: np.ndarray, n: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(S* places in order, the place after the run of equal symbols that starts there); a sentinel is its own run's end.

    Read from the right in blocks; the last of the n symbols is a sentinel.
    """
    places, stops = [], []
    after, after_rises, after_stop = 0, True, n  # of the place right of the block
    for hi in range(n, 0, -block):
        lo = max(0, hi - block)
        x = np.asarray(text[lo:hi])
        k = len(x)
        differs = np.empty(k, bool)
        differs[:-1], differs[-1] = x[:-1] != x[1:], x[-1] != after or hi == n
        last = np.where(differs, np.arange(k), k)
        last = np.minimum.accumulate(last[::-1])[::-1]  # the last place of the run, k if it goes on to the right
        nxt = np.append(x[1:], x.dtype.type(after))
        inside = last < k
        rises = np.where(inside, (x < nxt)[np.minimum(last, k - 1)], after_rises)
        stop = np.where(inside, lo + last + 1, after_stop)
        end = x == 0
        rises[end] = True
        star = np.empty(k, bool)
        star[0] = False
        star[1:] = rises[1:] & ~rises[:-1]
        star |= end
        if hi < n and after_rises and not rises[-1] and after > 0:
            places.append(np.array([hi]))
            stops.append(np.array([after_stop]))
        at = np.flatnonzero(star)
        places.append(at + lo)
        stops.append(np.where(end[at], at + lo, stop[at]))
        after, after_rises, after_stop = int(x[0]), bool(rises[0]), int(stop[0])
    return np.concatenate(places[::-1], dtype=whole(n)), np.concatenate(stops[::-1], dtype=whole(n))


class Pieces:
    """The pieces of a level: from each S* place to the stop of the next one; a sentinel is a piece by itself."""

    def __init__(self, text: np.ndarray, n: int, star: np.ndarray, stop: np.ndarray):
        self.text, self.n, self.star = text, n, star
        self.size = np.ones(len(star), whole(n))
        self.size[:-1] = stop[1:] - star[:-1] + 1
        self.size[text[star] == 0] = 1
        self.bits = 8 * text.dtype.itemsize
        self.width = 64 // self.bits  # symbols of a key

    def keys(self, place: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The next symbols of pieces as one number each, zeros after a piece's end."""
        if self.bits == 8:
            whole = np.ndarray((len(self.text) - 7,), ">u8", self.text, strides=(1,))
            key = whole[place].astype(np.uint64)
            return key & MASKS[np.minimum(left, 8)]
        key = np.zeros(len(place), np.uint64)
        for j in range(self.width):
            x = np.where(j < left, self.text[np.minimum(place + j, self.n - 1)], 0).astype(np.uint64)
            key = key << np.uint64(self.bits) | x
        return key

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Leading symbols that two different keys share."""
        x = a ^ b
        high = (x >> np.uint64(32)).astype(np.float64)
        low = (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
        zeros = np.where(high > 0, 32 - np.frexp(high)[1], 64 - np.frexp(low)[1])
        return zeros // self.bits

    def sorted(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pieces in order, whether each differs from the one before, common prefix with that) of the pieces at."""
        place, left = self.star[at], self.size[at]
        key = self.keys(place, left)
        o = np.argsort(key, kind="stable")
        at, place, left, key = at[o], place[o], left[o], key[o]
        new = np.ones(len(at), bool)
        near = np.zeros(len(at), np.int64)
        new[1:] = key[1:] != key[:-1]
        s = np.flatnonzero(new[1:]) + 1
        near[s] = self.same(key[s], key[s - 1])
        depth = self.width
        while True:
            lone = new & np.append(new[1:], True)
            more = np.flatnonzero((left > depth) & ~lone)  # groups as yet equal, whose pieces go on
            if not len(more):
                break
            group = np.cumsum(new)[more]
            key = self.keys(place[more] + depth, left[more] - depth)
            o = np.lexsort((key, group))
            src = more[o]
            at[more], place[more], left[more], key = at[src], place[src], left[src], key[o]
            s = np.flatnonzero((group[1:] == group[:-1]) & (key[1:] != key[:-1])) + 1
            new[more[s]] = True
            near[more[s]] = depth + self.same(key[s], key[s - 1])
            depth += self.width
        ends = self.text[place + left - 1] == 0  # sentinels are all different
        s = ends & ~new
        near[s] = left[s] - 1
        return at, new | ends, near

    def names(self, limits: Limits, store: Store) -> tuple[np.ndarray, int, np.ndarray]:
        """(name of each piece, names, common prefix of each name with the one before)."""
        m = len(self.star)
        name, near, count = store.zeros(m, whole(m)), store.zeros(m, np.uint8), 0
        for at in self.buckets(limits.block * 8):
            at, new, lcp = self.sorted(at)
            x = np.cumsum(new) - 1 + count
            name[at] = x
            near[x[new]] = np.minimum(lcp[new], limits.cap)
            count = int(x[-1]) + 1
        return name, count, near[:count]

    def buckets(self, most: int) -> Iterator[np.ndarray]:
        """Pieces by ranges of their first symbols, in text order each."""
        m = len(self.star)
        if m <= most:
            yield np.arange(m)
            return
        first = self.text[self.star]
        count = np.bincount(first)
        cut = np.flatnonzero(np.diff((np.cumsum(count) - count) // most, prepend=-1))
        for lo, hi in zip(cut, np.append(cut[1:], len(count)), strict=True):
            at = np.flatnonzero((first >= lo) & (first < hi))
            if len(at):
                yield at


#: MASKS[k] keeps the first k bytes of a key.
MASKS = np.array([0] + [((1 << 8 * k) - 1) << (64 - 8 * k) for k in range(1, 9)], np.uint64)


class Scans:
    """The two scans of a level."""

    def __init__(self, text: np.ndarray, n: int, limits: Limits, store: Store):
        self.text, self.n, self.limits, self.store = text, n, limits, store
        count = sum((np.bincount(text[i : min(i + (1 << 22), n)], minlength=self.top(text, n)) for i in range(0, n, 1 << 22)), start=np.zeros(self.top(text, n), np.int64))
        heavy = count > limits.block
        if text.dtype.itemsize < 4:
            edge = np.ones(len(count), bool)
        else:
            filled = (np.cumsum(count) - count) // limits.block
            edge = np.diff(filled, prepend=-1) > 0
            edge |= heavy | np.concatenate([[True], heavy[:-1]])
            edge[:2] = True
        self.range_of = np.cumsum(edge) - 1  # of each symbol; range 0 is the sentinels
        self.first = np.append(np.flatnonzero(edge), len(count))  # first symbol of each range
        self.ranges = len(self.first) - 1

    @staticmethod
    def top(text: np.ndarray, n: int) -> int:
        return 1 + max(int(text[i : min(i + (1 << 22), n)].max()) for i in range(0, n, 1 << 22))

    def start(self, up: bool) -> None:
        self.up = up
        self.queue = Queues(self.ranges, self.limits.queue_bytes, self.store, whole(self.n))
        self.low = np.zeros(len(self.range_of), np.uint8)  # by symbol: least prefix scanned since its last tuple was queued

    def induces(self, place: np.ndarray, symbol, own) -> tuple[np.ndarray, np.ndarray]:
        """(symbol before each place, whether the suffix there is induced now). own: elements of the induced type."""
        before = self.text[np.maximum(place - 1, 0)]
        further = before > symbol if self.up else before < symbol
        return before, (place > 0) & (before > 0) & (further | ((before == symbol) & own))

    def induce(self, place: np.ndarray, val: np.ndarray, symbol, own, done: tuple[int, int] | None = None) -> None:
        """Queue what scanned suffixes induce. val: common prefix of each with the one scanned before it. done: symbols
        [lo, hi) of a range whose own tuples have been dealt with."""
        if not len(place):
            return
        cap = np.uint8(self.limits.cap)
        before, ok = self.induces(place, symbol, own)
        if done is not None:
            ok &= (before < done[0]) | (before >= done[1])
        at = np.flatnonzero(ok)
        if not len(at):
            np.minimum(self.low, val.min(), out=self.low)
            return
        to = before[at]
        o = np.argsort(to, kind="stable")
        at, to = at[o], to[o]
        new = np.ones(len(to), bool)
        new[1:] = to[1:] != to[:-1]
        begin = np.flatnonzero(new)
        lo = np.empty(len(at), np.int64)
        lo[1:] = at[:-1] + 1
        lo[begin] = 0
        least = range_min(val, lo, at)
        head = to[begin]
        least[begin] = np.minimum(least[begin], self.low[head])
        lcp = np.minimum(least.astype(np.int16) + 1, cap).astype(np.uint8)
        np.minimum(self.low, val.min(), out=self.low)
        last = np.append(begin[1:], len(at)) - 1
        tail = np.append(np.minimum.accumulate(val[::-1])[::-1], cap)
        self.low[head] = tail[at[last] + 1]
        prev = place[at] - 1
        r = self.range_of[head]
        cut = np.flatnonzero(np.diff(r, prepend=-1))
        bounds = np.append(begin[cut], len(at))
        for k, x in enumerate(r[cut]):
            self.queue.push(int(x), prev[bounds[k] : bounds[k + 1]], lcp[bounds[k] : bounds[k + 1]])

    def resolve(self, r: int, fixed: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, val, whether induced) of a range of several symbols in scan order. fixed: its suffixes that are known."""
        lo, hi = int(self.first[r]), int(self.first[r + 1])
        qp, qv = self.queue.pop(r)
        place = np.concatenate([qp, fixed[0]])
        kind = np.repeat(np.array([0, 2], np.int8), [len(qp), len(fixed[0])])  # 0 queued, 1 induced within, 2 fixed
        known = np.concatenate([qv, fixed[1]])
        parent = np.full(len(place), -1)
        new = np.arange(len(place))
        while len(new):
            p = place[new]
            before, ok = self.induces(p, self.text[p], kind[new] < 2)
            ok &= (before >= lo) & (before < hi)
            child = p[ok] - 1
            parent = np.concatenate([parent, new[ok]])
            new = np.arange(len(place), len(place) + len(child))
            place = np.concatenate([place, child])
            kind = np.concatenate([kind, np.ones(len(child), np.int8)])
        total = len(place)
        symbol = self.text[place].astype(np.int64)
        sub = np.where(kind == 1, 0, np.arange(total))
        o = np.lexsort((sub, kind, symbol if self.up else -symbol))
        s, k = symbol[o], kind[o]
        rank = np.empty(total, np.int64)
        rank[o] = np.cumsum(np.concatenate([[False], (s[1:] != s[:-1]) | (k[1:] != 1) | (k[:-1] != 1)])) if total else 0
        ancestor = np.where(kind == 1, parent, np.arange(total))
        while total and rank.max() + 1 < total:
            second = rank[ancestor]
            o = np.lexsort((second, rank))
            x, y = rank[o], second[o]
            rank = np.empty(total, np.int64)
            rank[o] = np.cumsum(np.concatenate([[False], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
            ancestor = ancestor[ancestor]
        o = np.empty(total, np.int64)
        o[rank] = np.arange(total)
        place, kind, symbol = place[o], kind[o], symbol[o]
        val = np.zeros(total, np.uint8)
        same = np.concatenate([[False], symbol[1:] == symbol[:-1]]) if total else np.zeros(0, bool)
        before = np.concatenate([[0], kind[:-1]]) if total else kind
        carried = same & ((kind == 0) | ((kind == 2) & (before == 2)))
        val[carried] = known[o[carried]]
        seam = np.flatnonzero(same & (kind == 2) & (before < 2))
        val[seam] = common(self.text, place[seam - 1], place[seam], self.limits.cap)
        val[same & (kind == 1) & (before == 0)] = 1  # the parents start with different symbols
        chain = np.flatnonzero(same & (kind == 1) & (before == 1))
        if len(chain):
            a, b = rank[parent[o[chain - 1]]] + 1, rank[parent[o[chain]]]
            val[chain] = self.limits.cap
            while True:  # each value rests on values before it only
                got = np.minimum(range_min(val, a, b).astype(np.int64) + 1, self.limits.cap).astype(np.uint8)
                if np.array_equal(got, val[chain]):
                    break
                val[chain] = got
        return place, val, kind < 2

    def run(self, star: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, common prefix with the one before) of all suffixes in order, given those of the S* ones."""
        text, block, cap, n = self.text, self.limits.block, self.limits.cap, self.n
        per = np.zeros(self.ranges, np.int64)
        for i in range(0, len(star), block):
            per += np.bincount(self.range_of[text[star[i : i + block]]], minlength=self.ranges)
        at = np.concatenate([[0], np.cumsum(per)])
        falls_p, falls_v = self.store.zeros(n, whole(n)), self.store.zeros(n, np.uint8)
        fell = np.zeros(self.ranges + 1, np.int64)
        end = 0
        self.start(True)
        for i in range(0, at[1], block):
            p = star[i : min(i + block, at[1])]
            self.induce(p, np.zeros(len(p), np.uint8), 0, False)
        for r in range(1, self.ranges):
            if self.first[r + 1] - self.first[r] > 1:
                p, v, own = self.resolve(r, (star[at[r] : at[r + 1]], lcp[at[r] : at[r + 1]]))
                self.induce(p, v, text[p], own, (int(self.first[r]), int(self.first[r + 1])))
                k = int(own.sum())
                falls_p[end : end + k], falls_v[end : end + k] = p[own], v[own]
                end += k
            else:
                last = None
                for p, v in self.stream(r):
                    falls_p[end : end + len(p)], falls_v[end : end + len(p)] = p, v
                    end += len(p)
                    last = p[-1:]
                    self.induce(p, v, int(self.first[r]), True)
                for i in range(at[r], at[r + 1], block):
                    p, v = np.asarray(star[i : min(i + block, at[r + 1])]), lcp[i : min(i + block, at[r + 1])].copy()
                    if i == at[r]:
                        v[0] = 0 if last is None else common(text, last, p[:1], cap)[0]
                    self.induce(p, v, int(self.first[r]), False)
            fell[r + 1] = end
        place, val = self.store.zeros(n, whole(n)), self.store.zeros(n, np.uint8)
        place[: at[1]] = star[: at[1]]
        put = n  # the suffixes are put from the largest down

        def write(p: np.ndarray, v: np.ndarray) -> None:
            nonlocal put
            k = len(p)
            place[put - k : put] = p[::-1]
            if put < n:  # a suffix's value stands with the larger one scanned before it
                val[put - k + 1 : put + 1] = v[::-1]
            else:
                val[put - k + 1 : put] = v[1:][::-1]
            put -= k

        self.start(False)
        for r in range(self.ranges - 1, 0, -1):
            a, b = fell[r], fell[r + 1]
            if self.first[r + 1] - self.first[r] > 1:
                v = np.zeros(b - a, np.uint8)
                v[1:] = falls_v[a + 1 : b][::-1]
                p, v, own = self.resolve(r, (falls_p[a:b][::-1], v))
                self.induce(p, v, text[p], own, (int(self.first[r]), int(self.first[r + 1])))
                if len(p):
                    write(p, v)
            else:
                last = None
                for p, v in self.stream(r):
                    write(p, v)
                    last = p[-1:]
                    self.induce(p, v, int(self.first[r]), True)
                for hi in range(b, a, -block):
                    lo = max(a, hi - block)
                    p = np.asarray(falls_p[lo:hi])[::-1]
                    v = np.zeros(hi - lo, np.uint8)
                    v[1:] = falls_v[lo + 1 : hi][::-1]
                    v[0] = falls_v[hi] if hi < b else 0 if last is None else common(text, last, p[:1], cap)[0]
                    write(p, v)
                    self.induce(p, v, int(self.first[r]), False)
        return place, val

    def stream(self, r: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The tuples of a range of one symbol in order, those induced meanwhile too."""
        fresh = True
        while True:
            p, v = self.queue.pop(r, self.limits.block)
            if not len(p):
                return
            if fresh:
                v[0] = 0
                fresh = False
            yield p, v


def suffixes(text: np.ndarray, n: int, limits: Limits, store: Store, levels: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(place, common prefix with the one before) of all n suffixes in order, sentinels first. levels: takes the size
    of each level's text."""
    if levels is not None:
        levels.append(n)
    star, stop = stars(text, n, limits.block * 4)
    pieces = Pieces(text, n, star, stop)
    name, count, near = pieces.names(limits, store)
    m = len(star)
    if count == m:
        order = store.zeros(m, whole(m))
        order[name] = np.arange(m)
        lcp = near
    else:
        inner = store.zeros(m, np.uint32)
        inner[:] = name + 1
        inner[text[star] == 0] = 0
        order, shared = suffixes(inner, m, limits, store, levels)
        lcp = store.zeros(m, np.uint8)
        step = max(limits.block * 4, 1)
        for lo in range(1, m, step):
            hi = min(lo + step, m)
            i, j, k = order[lo - 1 : hi - 1], order[lo:hi], shared[lo:hi].astype(np.int64)
            far = k >= limits.cap
            k[far] = 0
            a, b = name[i + k], name[j + k]
            far |= a >= b  # only where the limit cut a name's comparison short
            got = np.full(hi - lo, limits.cap, np.int64)
            x = np.flatnonzero(~far)
            got[x] = np.minimum(star[i[x] + k[x]] - star[i[x]] + range_min(near, a[x] + 1, b[x]), limits.cap)
            lcp[lo:hi] = got
    return Scans(text, n, limits, store).run(star[order], lcp)


def joined(data: np.ndarray, offsets: np.ndarray, store: Store) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, places of the sentinels): segments with a sentinel after each; a byte b is b + 1."""
    m, n = len(offsets) - 1, len(data) + len(offsets) - 1
    ends = offsets[1:] + np.arange(m)
    wide = any(int(data[i : i + (1 << 22)].max()) == 255 for i in range(0, len(data), 1 << 22))
    text = store.zeros(n + 8, np.uint16 if wide else np.uint8)  # eight zeros after the end, for keys
    i = 0
    while i < m:  # some segments at a time
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + (1 << 22), "right")) - 1)
        part = data[offsets[i] : offsets[j]]
        inner = np.ones(len(part) + j - i, bool)
        inner[ends[i:j] - offsets[i] - i] = False
        text[offsets[i] + i : offsets[j] + j][inner] = part.astype(text.dtype) + text.dtype.type(1)
        i = j
    return text, ends


def suffix_lcp(data: np.ndarray, offsets: np.ndarray, limits: Limits = Limits(), told: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, place in the segment, common prefix with the suffix before) in suffix order, sentinels left out.

    told: takes the levels' sizes and the number of queues spilled.
    """
    z = np.zeros(0, np.int64)
    if len(offsets) < 2:
        return z, z, z.astype(np.uint8)
    store, levels = Store(limits.array_bytes), []
    try:
        text, ends = joined(data, np.asarray(offsets, np.int64), store)
        place, val = suffixes(text, len(text) - 8, limits, store, levels)
        place, val = np.array(place[len(ends) :]), np.array(val[len(ends) :])
    finally:
        store.close()
    if told is not None:
        told.update(levels=levels, spills=store.spills)
    seg = np.searchsorted(ends, place)
    return seg, place - np.concatenate([[0], ends[:-1] + 1])[seg], val


def later_copies(data: np.ndarray, offsets: np.ndarray, limits: Limits, marks: np.ndarray) -> None:
    """Set marks[i] for each place i of data where a string of limits.cap bytes starts, within a segment, that also
    starts earlier in data. Segments come in the order that "earlier" means."""
    if len(data) < limits.cap:
        return
    store = Store(limits.array_bytes)
    try:
        text, ends = joined(data, np.asarray(offsets, np.int64), store)
        place, val = suffixes(text, len(text) - 8, limits, store)
        lo, n = 0, len(val)
        while lo < n:
            hi = min(lo + limits.block * 4, n)
            while hi < n and val[hi] >= limits.cap:  # groups stay whole
                hi += 1
            p, equal = np.asarray(place[lo:hi], dtype=np.int64), np.asarray(val[lo:hi]) >= limits.cap
            part = equal | np.append(equal[1:], False)
            if part.any():
                p, equal = p[part], equal[part]
                begin = np.flatnonzero(~equal)
                first = np.minimum.reduceat(p, begin)
                later = p[p != np.repeat(first, np.diff(np.append(begin, len(p))))]
                marks[later - np.searchsorted(ends, later)] = True
            lo = hi
    finally:
        store.close()

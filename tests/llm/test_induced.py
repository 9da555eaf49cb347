"""External induced sorting against sorting all suffixes: recursion, spilled queues, mapped arrays, any block size."""

import random

import numpy as np
import pytest

from quillwork.llm import induced
from quillwork.llm.induced import Limits


def segments(g):
    k = g.choice([1, 2, 3, 26, 255])
    out = [bytes(g.randrange(k) + (0 if k == 255 else 97) for _ in range(g.choice([0, 1, 5, 30, 120]))) for _ in range(g.randint(1, 12))]
    if g.random() < 0.5:
        out += [s + b"a" for s in out] + out
    if g.random() < 0.2:
        out += [b"ab" * 70, b"aab" * 50, b"a" * 130 + b"b", b"b" * 90, bytes([255, 254, 255])]
    return out


def flat(segs):
    return np.frombuffer(b"".join(segs), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in segs])])


def brute(segs, cap):
    """(segment, place), common prefixes in suffix order; equal suffixes by segment."""
    rows = sorted(((s[i:], j, i) for j, s in enumerate(segs) for i in range(len(s))), key=lambda x: x[:2])
    lcp, last = [], b""
    for s, _, _ in rows:
        n = 0
        while n < min(cap, len(s), len(last)) and s[n] == last[n]:
            n += 1
        lcp.append(n)
        last = s
    return [x[1:] for x in rows], lcp


@pytest.mark.parametrize("seed", range(4))
def test_suffixes(seed):
    g = random.Random(seed)
    deepest = spills = 0
    for _ in range(60):
        segs, cap, told = segments(g), g.choice([3, 9, 100, 255]), {}
        limits = Limits(cap, g.choice([9, 100, 1 << 20]), g.choice([0, 100, 1 << 20]), g.choice([1, 2, 7, 64, 1 << 16]))
        data, off = flat(segs)
        seg, place, lcp = induced.suffix_lcp(data, off, limits, told)
        want, prefixes = brute(segs, cap)
        got = list(zip(seg.tolist(), place.tolist(), strict=True))
        assert lcp.tolist() == prefixes
        assert [segs[j][i : i + cap] for j, i in got] == [segs[j][i : i + cap] for j, i in want] and sorted(got) == sorted(want)
        if cap == 255:
            assert got == want
        marks = np.zeros(len(data), bool)
        induced.later_copies(data, off, limits, marks)
        seen, later = set(), []
        for s in segs:
            for i in range(len(s)):
                later.append(i + cap <= len(s) and s[i : i + cap] in seen)
                seen.add(s[i : i + cap] if i + cap <= len(s) else None)
        assert marks.tolist() == later
        deepest, spills = max(deepest, len(told["levels"])), spills + told["spills"]
    assert deepest >= 3 and spills > 100


def test_a_text_far_beyond_the_budget():
    """A megabyte with 4 kB of queues and arrays of 16 kB at most: every level spills and the recursion is deep."""
    g = np.random.default_rng(1)
    page = g.integers(97, 101, 50_000, dtype=np.uint8).tobytes()
    segs = [page[i : i + 400] for i in g.integers(0, 49_000, 2_000)] + [bytes(g.integers(97, 123, 100, dtype=np.uint8)) for _ in range(2_000)]
    data, off = flat(segs)
    told = {}
    seg, place, lcp = induced.suffix_lcp(data, off, Limits(100, 4 << 10, 16 << 10, 1 << 12), told)
    assert len(told["levels"]) >= 4 and told["spills"] > 1000
    want = sorted(segs[j][i : i + 100] for j in range(len(segs)) for i in range(len(segs[j])))
    assert [segs[j][i : i + 100] for j, i in zip(seg.tolist(), place.tolist(), strict=True)] == want


def test_nothing_to_sort():
    for segs in ([], [b""], [b"", b""]):
        data, off = flat(segs) if segs else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        assert [len(x) for x in induced.suffix_lcp(data, off)] == [0, 0, 0]

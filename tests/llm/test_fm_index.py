"""The word index against search by hand."""

import random

import numpy as np
import pytest

from strandlake.llm.fm_index import DEPTH, FmIndex, LeastIn, WaveletMatrix


def joined(strings):
    return np.array([x for s in strings for x in (*s, 0)], dtype=np.int64)


def holds(text, pattern):
    return [i for i in range(len(text)) if list(text[i : i + len(pattern)]) == list(pattern)]


def test_wavelet_ranks():
    r = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 500):
        x = r.integers(0, 11, n)
        w = WaveletMatrix(x, 4)
        symbols, at = r.integers(0, 16, 200), r.integers(0, n + 1, 200)
        assert w.rank(symbols, at).tolist() == [int((x[:i] == c).sum()) for c, i in zip(symbols, at, strict=True)]


@pytest.mark.parametrize("seed,symbols,most", [(1, 2, 5), (2, 3, 9), (3, 30, 4), (4, 1, 20), (5, 2, 80)])
def test_matching_statistics(seed, symbols, most):
    r = random.Random(seed)
    word = lambda: r.randint(1, symbols)
    strings = [[word() for _ in range(r.randint(0, 40))] for _ in range(12)]
    strings += [strings[0] * 4, strings[1] + strings[2]]
    text = joined(strings)
    index = FmIndex(text)
    queries = [strings[0] * 3, strings[3][::-1], [], [symbols + 1, 1, symbols + 7], *[[r.randint(1, symbols + 1) for _ in range(r.randint(1, 30))] for _ in range(8)]]
    sizes = np.array([len(q) for q in queries])
    flat = np.array([x for q in queries for x in q], dtype=np.int64)
    ends = np.cumsum(sizes)
    seen = {}
    for at, length, lo, hi in index.matching_statistics(flat, sizes, most):
        for k in range(len(at)):
            seen[int(at[k])] = int(length[k]), sorted(index.places[lo[k] : hi[k]].tolist())
    assert len(seen) == len(flat)
    for i in range(len(flat)):
        end = int(ends[np.searchsorted(ends, i, "right")])
        best = max(n for n in range(min(most, end - i) + 1) if n == 0 or holds(text, flat[i : i + n]))
        length, places = seen[i]
        assert length == best
        if best:
            assert places == holds(text, flat[i : i + best])


def test_least_in():
    r = np.random.default_rng(3)
    values = r.integers(0, 1000, 300)
    lo = r.integers(0, 299, 500)
    hi = np.array([r.integers(a + 1, 301) for a in lo])
    assert LeastIn(values)(lo, hi).tolist() == [int(values[a:b].min()) for a, b in zip(lo, hi, strict=True)]


def test_bounds():
    index = FmIndex(joined([[1, 2, 3]]))
    with pytest.raises(ValueError):
        next(index.matching_statistics(np.array([1]), np.array([1]), DEPTH))
    assert list(FmIndex(joined([[]])).matching_statistics(np.zeros(0, np.int64), np.zeros(0, np.int64), 5)) == []

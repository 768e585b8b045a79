"""A compressed full-text index over words: wavelet matrix, backward search, matching statistics.

The text is an array of symbols: 0 ends each string, words are 1, 2, ... Suffixes are
sorted by their first DEPTH symbols (ranks tripled: 1, 3, 9, 27, 81), which is all that
a search of patterns up to that length needs. The symbols before the suffixes are kept
in a wavelet matrix, one packed bit vector for each bit of a symbol with counts for
every 64 bits: `rank` answers how often a symbol occurs before a place in one step a
bit. All lookups take arrays, so that many searches go on side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

DEPTH = 81
_LOW = np.array([(1 << i) - 1 for i in range(64)], dtype=np.uint64)


def ranks(text: np.ndarray) -> list[np.ndarray]:
    """For each place its rank by 1, 3, 9, 27 and 81 symbols from there; equal ranks mean equal symbols. At most 2^21 symbols."""
    if len(text) >= 1 << 21:
        raise ValueError(f"{len(text)} symbols; ranks of three places must fit 64 bits")
    out, width = [text.astype(np.int64)], 1
    while width < DEPTH:
        now = out[-1]
        far = [np.concatenate([now[k * width :], np.zeros(min(k * width, len(now)), np.int64)])[: len(now)] for k in (1, 2)]
        key = (now << 42) | (far[0] << 21) | far[1]
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.concatenate([[False], key[1:] != key[:-1]])
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(fresh)
        out.append(rank)
        width *= 3
    return out


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.bits = len(symbols), bits
        self.words, self.counts, self.zeros = [], [], []
        now = symbols
        for b in range(bits - 1, -1, -1):
            one = (now >> b) & 1 > 0
            packed = np.packbits(one, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]).astype(np.int32))
            self.zeros.append(len(now) - int(one.sum()))
            now = np.concatenate([now[~one], now[one]])
        every = np.arange(1 << bits, dtype=np.int64)
        self.begins = self._down(every, np.zeros(1 << bits, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.bits):
            word = at >> 6
            ones = self.counts[k][word] + np.bitwise_count(self.words[k][word] & _LOW[at & 63])
            at = np.where((symbols >> (self.bits - 1 - k)) & 1 > 0, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbols, at) - self.begins[symbols]


class FmIndex:
    """texts: strings of words as arrays of symbols from 1 on, joined, each followed by 0."""

    def __init__(self, text: np.ndarray):
        level = ranks(text)
        self.n = len(text)
        self.places = np.argsort(level[-1], kind="stable")
        self.symbols = int(text.max(initial=0)) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))])
        self.before = WaveletMatrix(text[self.places - 1], max(1, (self.symbols - 1).bit_length()))
        self.common = self._common(level)
        self._shallow: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._least = [self.common]

    def _common(self, level: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each suffix in order with the one before; 0 at both ends."""
        out = np.zeros(self.n + 1, np.uint8)
        a, b = self.places[:-1].copy(), self.places[1:].copy()
        far = np.zeros(len(a), np.int64)
        for k in range(len(level) - 1, -1, -1):
            width, rank = 3**k, np.append(level[k], -1)
            for _ in range(1 if k == len(level) - 1 else 2):
                x, y = np.minimum(a + far, self.n), np.minimum(b + far, self.n)
                same = (rank[x] == rank[y]) & (x < self.n) & (y < self.n) & (far + width <= DEPTH)
                far[same] += width
        out[1:-1] = np.minimum(far, DEPTH)
        return out

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the suffixes that begin with the symbol and go on as those in [lo, hi)."""
        known = np.where(symbols < self.symbols, symbols, 0)
        both = self.before.rank(np.concatenate([known, known]), np.concatenate([lo, hi]))
        first = self.first[known]
        lo, hi = first + both[: len(lo)], first + both[len(lo) :]
        return lo, np.where(symbols < self.symbols, hi, lo)

    def widen(self, depth: int, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes that share the first depth symbols with those in [lo, hi), which share as many."""
        if depth not in self._shallow:
            cut = self.common < depth
            at = np.arange(self.n + 1)
            left = np.maximum.accumulate(np.where(cut, at, 0))
            right = np.minimum.accumulate(np.where(cut, at, self.n)[::-1])[::-1]
            self._shallow[depth] = left, right
        left, right = self._shallow[depth]
        return left[lo], right[hi]

    def _level(self, k: int) -> np.ndarray:
        while len(self._least) <= k:
            have, step = self._least[-1], 1 << (len(self._least) - 1)
            out = have.copy()
            out[: self.n + 1 - step] = np.minimum(have[: self.n + 1 - step], have[step:])
            out[self.n + 1 - step :] = 0
            self._least.append(out)
        return self._least[k]

    def parent(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next wider range of suffixes and what they share."""
        depth = np.maximum(self.common[lo], self.common[hi]).astype(np.int64)
        top = self.n.bit_length()
        for k in range(top, -1, -1):
            step, least = 1 << k, self._level(k)
            from_ = np.maximum(lo - step + 1, 0)
            lo = np.where((lo >= step) & (least[from_] >= depth) & (depth > 0), lo - step, lo)
            hi = np.where((hi + step <= self.n) & (least[np.minimum(hi, self.n)] >= depth) & (depth > 0), hi + step, hi)
        return np.where(depth > 0, lo, 0), np.where(depth > 0, hi, self.n), depth

    def matching_statistics(self, queries: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Longest matches of the queries (joined symbols, with their sizes), from right to left, all queries side by side.

        Yields places in queries, and for each the length of the longest word sequence from there
        that the text holds (at most most, below DEPTH) and the range of its suffixes."""
        if not 0 < most < DEPTH:
            raise ValueError(f"matches of 1 to {DEPTH - 1} symbols, not {most}")
        order = np.argsort(-sizes, kind="stable")
        ends = np.cumsum(sizes)[order]
        sizes = sizes[order]
        lo, hi, length = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.n), np.zeros(len(sizes), np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes, -step, "left"))  # sizes above step
            at = ends[:live] - 1 - step
            lo, hi, length = lo[:live], hi[:live], length[:live]
            full = np.flatnonzero(length == most)
            lo[full], hi[full] = self.widen(most - 1, lo[full], hi[full])
            length[full] = most - 1
            todo = np.arange(live)
            while todo.size:
                a, b = self.extend(queries[at[todo]], lo[todo], hi[todo])
                found = a < b
                hit, miss = todo[found], todo[~found]
                lo[hit], hi[hit] = a[found], b[found]
                length[hit] += 1
                todo = miss[length[miss] > 0]
                lo[todo], hi[todo], length[todo] = self.parent(lo[todo], hi[todo])
            yield at, length.copy(), lo.copy(), hi.copy()


class LeastIn:
    """The least of values in ranges, by a table of ranges of 1, 2, 4, ... values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        while len(self.levels) <= level.max(initial=0):
            have, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(have[:-step], have[step:]))
        out = np.empty(len(lo), self.levels[0].dtype)
        for k in np.unique(level):
            mine = level == k
            a, b = self.levels[k][lo[mine]], self.levels[k][hi[mine] - (1 << int(k))]
            out[mine] = np.minimum(a, b)
        return out

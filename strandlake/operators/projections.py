"""Reads laid over references base by base, many pairs side by side.

The matrix of a pair is cut into words of 64 rows (symbols of the read); a lane of
words holds a pair. Each word is one column behind the word above it, so that at one
step all of them need only what the step before told: a step of NumPy over all words
of all lanes does one column of each, and nothing is carried from word to word. Only
words that a band of diagonals meets are gone through. A band is wide enough for a
pair if the path found in it costs less than any that leaves it; other pairs go on
with twice the band, until it is the whole matrix. Ties are those of
`alignment.global_path`, and rows equal `alignment.projected` on every pair.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from . import alignment
from .distances import left_out

#: Bytes that the kept columns of a batch may take, words of it at most, and pairs in a batch that are worth a sweep.
KEPT_BYTES, STEP_WORDS, FEW = 128 << 20, 8192, 8
#: Of pairs in a batch a side is at most so many times that of the first.
UNEVEN = 1.5
#: A read or reference that is so many times the other is first looked at as one with symbols put in.
LONGER = 2
#: The first band has room for pairs that are like each other by chance only: so many parts of the shorter side, less of
#: them the longer the other one is, and no less than the last of these.
SPARE, LESS, LEAST = 0.28, 0.12, 0.04
GAP = 255
_U = np.uint64
_UPTO = ~_U(0) >> (_U(63) - np.arange(64, dtype=_U))


def sweep(queries: list[np.ndarray], references: list[np.ndarray], symbols: int, spare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of each reference (a column for each pair) the query's symbol or GAP, and the edits of the paths found.

    The path of a pair is the right one if its edits show that it is: `gap + 2 * spare + 1` at most."""
    lanes = len(queries)
    m, n = (np.array([len(x) for x in xs], np.int64) for xs in (queries, references))
    longest, columns = int(m.max()), int(n.max())
    words = -(-longest // 64)
    above, below = int((np.maximum(m - n, 0) + spare).max()), int((np.maximum(n - m, 0) + spare).max())
    width = min(words, (above + below + 63) // 65 + 2)  # words that the band meets in one step, at most
    steps = columns + words
    first = np.clip(-((63 + below - np.arange(-1, steps - 1)) // 65), 0, words - width)  # by step: the first word gone through

    bits = max(1, (symbols - 1).bit_length())
    codes, text = np.zeros((lanes, words * 64), np.uint8), np.zeros((lanes, columns), np.uint8)
    for k in range(lanes):
        codes[k, : m[k]] = queries[k]
        text[k, : n[k]] = references[k]
    own = [np.ascontiguousarray(np.packbits(codes >> b & 1, axis=1, bitorder="little").view(_U).T) for b in range(bits)]
    other = []
    for b in range(bits):  # the last column comes first; before it and after the first one as many as there are words
        x = np.zeros((columns + 2 * words, lanes), _U)
        x[words : words + columns] = ((text.T >> b & 1).astype(_U) - _U(1))[::-1]
        other.append(x)

    up, down = np.full((words, lanes), ~_U(0)), np.zeros((words, lanes), _U)
    plus, minus = np.zeros((2, words + 1, lanes), _U), np.zeros((2, words + 1, lanes), _U)
    plus[:, 0] = 1
    eq, x, y, d, right, left = np.empty((6, width, lanes), _U)
    stop, slant = np.empty((2, steps + 1, width + 1, lanes), _U)  # rows at which a path leaves a column, and those in which it does so by a diagonal step
    stop[:, 0], slant[:, 0] = ~_U(0), 0
    stop[0], slant[0] = ~_U(0), 0
    top, last = np.array(63, _U), -1
    for t in range(steps - 1):
        at = int(first[t + 1])
        if at != last:
            end, last = at + width, at
            plus[:, at], minus[:, at] = 1, 0
            q, u, v = [z[at:end] for z in own], up[at:end], down[at:end]
            into, out = [(plus[k, at:end], minus[k, at:end]) for k in (0, 1)], [(plus[k, at + 1 : end + 1], minus[k, at + 1 : end + 1]) for k in (0, 1)]
        if at <= t < end:  # this word comes to its first column
            up[t], down[t] = ~_U(0), 0
        (rise, fall), (rises, falls) = into[t & 1], out[1 - (t & 1)]
        begin = columns + words - 1 - t + at
        np.bitwise_xor(q[0], other[0][begin : begin + width], out=eq)
        for b in range(1, bits):
            np.bitwise_xor(q[b], other[b][begin : begin + width], out=x)
            eq &= x
        np.bitwise_or(eq, fall, out=x)
        np.bitwise_and(x, u, out=y)
        y += u
        y ^= u
        y |= x
        np.bitwise_or(y, v, out=d)
        np.bitwise_or(d, u, out=right)
        np.invert(right, out=right)
        right |= v
        np.bitwise_and(d, u, out=left)
        np.invert(d, out=y)
        np.bitwise_or(y, eq, out=slant[t + 1, 1:])
        np.bitwise_or(slant[t + 1, 1:], right, out=stop[t + 1, 1:])
        np.right_shift(right, top, out=rises)
        np.right_shift(left, top, out=falls)
        right += right
        right |= rise
        left += left
        left |= fall
        np.bitwise_or(d, right, out=u)
        np.invert(u, out=u)
        u |= left
        np.bitwise_and(d, right, out=v)
    return _back(stop, slant, first, codes, text, m, n)


def _back(stop: np.ndarray, slant: np.ndarray, first: np.ndarray, codes: np.ndarray, text: np.ndarray, m: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the last column back to the first one: up to the next row at which the path leaves the column.

    Pairs come with the longest reference first. Rows are counted from a word above the first one."""
    _, width, lanes = stop.shape
    columns = text.shape[1]
    start = (np.arange(len(first)) * (width + 1) - first) * lanes  # of each step, less that of its first word; a word more for each step
    stop, slant = stop.reshape(-1), slant.reshape(-1).view(np.int64)
    lane, place = np.arange(lanes), m + 63
    rows, kept = np.zeros((2, columns, lanes), np.int64)
    counts = np.searchsorted(-n, -np.arange(columns), "left")
    live, here = 0, lane[:0]
    low, by, high, mantissa, bias = (np.array(x) for x in (63, 6, 1, 52, 1023))
    up = np.array(1, _U)
    for j in range(columns - 1, -1, -1):
        if counts[j] != live:
            live = int(counts[j])
            own, here = place[:live], lane[:live] - (j + 1) * lanes
        here += lanes  # a step is a column and a word; the word's part is counted in start
        word = own >> by
        where = start.take(word + j, mode="clip")
        where += here
        s = stop.take(where, mode="clip")
        s &= _UPTO.take(own & low)
        if not s.all():
            left = np.flatnonzero(s == 0)
            while left.size:
                word[left] -= 1
                at = word[left]
                again = np.where(at > 0, start.take(at + j, mode="clip") + here[left], lane[left])
                where[left] = again
                s[left] = stop.take(again, mode="clip")
                left = left[s[left] == 0]
        s &= ~(s >> up)  # so that the number next to it is no higher power of two
        bit = s.astype(np.float64).view(np.int64)
        bit >>= mantissa
        bit -= bias
        word <<= by
        at, step = rows[j, :live], kept[j, :live]
        np.add(word, bit, out=at)
        np.right_shift(slant.take(where, mode="clip"), bit, out=step)
        step &= high
        np.subtract(at, step, out=own)
    symbols = codes[lane, np.maximum(rows - 64, 0)]
    kept = kept > 0
    inside = np.arange(columns)[:, None] < n
    wrong = (kept & (symbols != text.T) & inside).sum(0)
    edits = m + n - 2 * (kept & inside).sum(0) + wrong
    return np.where(kept, symbols, GAP).astype(np.uint8), edits


def _plain(query: str, reference: str, gap: str) -> np.ndarray | None:
    """The row of a pair of which one is the other with symbols put in, or an empty one; None of others."""
    if not query or not reference:
        return np.full(len(reference), gap)
    if query == reference or (len(query) >= LONGER * len(reference) and left_out(reference, query)):
        return np.frombuffer(reference.encode("utf-32-le"), "U1")
    if len(reference) >= LONGER * len(query) and left_out(query, reference):
        out, at = np.full(len(reference), gap), len(reference)
        for symbol in reversed(query):  # read from the end, equal symbols are always a diagonal step
            at = reference.rfind(symbol, 0, at)
            out[at] = symbol
        return out
    return None


def _coded(sequences: Sequence[str]) -> tuple[list[np.ndarray], list[str]] | None:
    """The sequences as numbers of symbols, and those; None if they hold what is no single byte or too much of it."""
    try:
        raw = [np.frombuffer(s.encode("latin-1"), np.uint8) for s in sequences]
    except UnicodeEncodeError:
        return None
    seen = np.zeros(256, bool)
    for x in raw:
        seen[x] = True
    symbols = np.flatnonzero(seen)
    if len(symbols) >= GAP:
        return None
    code = np.zeros(256, np.uint8)
    code[symbols] = np.arange(len(symbols))
    return [code[x] for x in raw], [chr(x) for x in symbols.tolist()]


def project_many(queries: Sequence[str], references: Sequence[str], gap: str = "-") -> list[np.ndarray]:
    """`alignment.projected` of every pair, as arrays of single symbols. Equal pairs share theirs."""
    known = {pair: None for pair in zip(queries, references, strict=True)}
    left = []
    for pair in known:
        known[pair] = _plain(*pair, gap)
        if known[pair] is None:
            left.append(pair)
    coded = _coded([s for pair in left for s in pair]) if left else None
    if coded:
        _in_batches(left, *coded, gap, known)
    elif left:
        known.update((pair, _alone(pair, gap)) for pair in left)
    return [known[pair] for pair in zip(queries, references, strict=True)]


def _alone(pair: tuple[str, str], gap: str) -> np.ndarray:
    return np.array(alignment.projected(*pair, gap), "U1")


def _batch(m: np.ndarray, n: np.ndarray, spare: np.ndarray) -> int:
    """So many of the pairs, which are in order of size, are swept at once."""
    above, below = (np.maximum.accumulate(np.maximum(x, 0) + spare) for x in (m - n, n - m))
    high = -(-np.maximum.accumulate(m) // 64)
    words, count = np.minimum(high, (above + below + 63) // 65 + 2), np.arange(1, len(m) + 1)
    kept = count * (words + 1) * (np.maximum.accumulate(n) + high + 1) * 16
    like = (n <= UNEVEN * n[0] + 64) & (n[0] <= UNEVEN * n + 64) & (m <= UNEVEN * m[0] + 64)
    fits = like & (kept <= KEPT_BYTES) & (count * words <= STEP_WORDS)
    return len(m) if fits.all() else max(1, int(np.argmin(fits)))


def _in_batches(pairs: list[tuple[str, str]], codes: list[np.ndarray], symbols: list[str], gap: str, out: dict) -> None:
    letters = np.full(256, gap)
    letters[: len(symbols)] = symbols
    queries, references = codes[::2], codes[1::2]
    m, n = (np.array([len(x) for x in xs], np.int64) for xs in (queries, references))
    least = np.minimum(m, n)
    spare = (np.maximum(SPARE - LESS * (np.maximum(m, n) / least - 1), LEAST) * least).astype(np.int64) + 32
    todo = np.arange(len(pairs))
    while todo.size:
        todo = todo[np.lexsort((m[todo], np.log(n[todo]) // np.log(UNEVEN)))]
        again, start = [], 0
        while start < len(todo):
            at = todo[start : start + STEP_WORDS]
            at = at[: _batch(m[at], n[at], spare[at])]
            start += len(at)
            if len(at) < FEW:
                out.update((pairs[k], _alone(pairs[k], gap)) for k in at.tolist())
                continue
            at = at[np.argsort(-n[at], kind="stable")]
            rows, edits = sweep([queries[k] for k in at], [references[k] for k in at], len(symbols), spare[at])
            sure = (edits <= np.abs(m - n)[at] + 2 * spare[at] + 1) | (spare[at] >= least[at])
            rows = letters[rows.T]
            out.update((pairs[k], rows[x, : n[k]].copy()) for x, k in enumerate(at.tolist()) if sure[x])
            again += at[~sure].tolist()
        todo = np.array(again, np.int64)
        spare[todo] = np.minimum(2 * spare[todo], least[todo])

"""Alignments of many pairs side by side, in a band of diagonals.

A pair is a lane. Its band holds the cells within a few diagonals of the way from the
first to the last symbol, as bits of one or more 64-bit words that slide down one row
with each column; a step of NumPy over all lanes does a column. Where a band would be
no narrower than the pattern all rows are taken at once instead, and a long text is cut
into stretches that overlap by twice the pattern, so that lanes are of like length and
many go side by side. Rows above the first
are wild (an alignment that may start anywhere) or count up (one that may not). What
a band allows is known, so a distance within it is proved to be the least; pairs beyond
go on with twice the words, until the band is the whole matrix. Ties are those of the
`alignment` module, and results equal its `place` and `global_path` on every pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from ..functions.dna import MASK
from . import alignment

#: Lanes that go side by side at most, words of them that a step takes, and bytes that the columns of a path may take.
LANES, STEP_WORDS, PATH_BYTES = 4096, 16384, 64 << 20
#: Edits that the first band of a pair allows at least.
FIRST = 12
#: A pair whose best in a band of two words or more is so many times what the band allows goes on with a band that allows that.
HOPELESS = 4
#: Fewer pairs than this are not worth a sweep: each step costs the same for one lane as for a hundred.
FEW = 16
#: Columns of a text that a lane of whole columns answers for, at least.
STRETCH = 2048
#: Columns after which the last rows are looked at together.
COLUMNS = 32
#: Of pairs side by side the longest is at most so many times the shortest.
UNEVEN = 1.5
_U = np.uint64
_WILD, _NONE = 254, 255


@dataclass
class Swept:
    """What a sweep tells of each lane. columns: the diagonal and horizontal bits of each column, if kept."""

    best: np.ndarray
    first: np.ndarray
    last: np.ndarray
    final: np.ndarray
    columns: tuple[np.ndarray, np.ndarray] | None = None


def match_table(symbols: list[int], iupac: bool) -> np.ndarray:
    """For each symbol of a text (and for none) which codes of a pattern it matches."""
    out = np.zeros((len(symbols) + 1, 256), bool)
    out[:, _WILD] = True
    for s, x in enumerate(symbols):
        for p, y in enumerate(symbols):
            out[s, p] = x == y or (iupac and MASK.get(chr(x), 0) & MASK.get(chr(y), 0) > 0)
    return out


def sweep(patterns: Sequence[np.ndarray], texts: Sequence[np.ndarray], table: np.ndarray, above: np.ndarray, words: int, free: bool, keep: bool = False) -> Swept:
    """Patterns (rows, as codes) against texts (columns) in bands of 64 * words diagonals, above of them over the main one.

    free: the alignment may start at any column. best is the least value of the last row, first and last its columns
    (0-based; -1 where there is none), final its value in the last column."""
    lanes = len(patterns)
    m, n = (np.array([len(x) for x in xs], np.int64) for xs in (patterns, texts))
    below = 64 * words - 1 - above
    columns = int(np.minimum(n, m + above).max(initial=0))
    held = max((columns >> 6) + words + 2, int((above + m).max(initial=0) >> 6) + 1)
    codes = np.full((lanes, held * 64), _NONE, np.uint8)
    symbols = len(table)
    text = np.full((lanes, columns), symbols - 1, np.uint8)
    for k in range(lanes):
        codes[k, : above[k]] = _WILD
        codes[k, above[k] : above[k] + m[k]] = patterns[k]
        size = min(columns, int(n[k]))
        text[k, :size] = texts[k][:size]
    lane = np.arange(lanes)
    text = np.ascontiguousarray(text.T)
    peq = np.empty((held, symbols, lanes), _U)
    for s in range(symbols):
        peq[:, s] = np.packbits(table[s][codes], axis=1, bitorder="little").view(_U).T
    flat = peq.reshape(held, -1)

    rows = np.arange(64 * words)[None, :] >= above[:, None]  # of column 0: those below row 0
    up = np.ascontiguousarray(np.packbits(rows, axis=1, bitorder="little").view(_U).T)
    down = np.zeros_like(up) if free else ~up
    right, left, shifted = np.empty_like(up), np.empty_like(up), np.empty_like(up)
    part, diagonal = np.empty_like(up), np.empty_like(up)
    turn = np.maximum(m - below, 0)  # the column in which the band's last row is the pattern's
    score = np.where(turn > 0, below, m)
    stop = np.minimum(n, m + above)
    best, first, last = m + 1, np.full(lanes, -1), np.full(lanes, -1)
    final = m.copy()
    early, late = int(turn.min(initial=0)), int(turn.max(initial=0))
    out = Swept(best, first, last, final)
    if keep:
        out.columns = np.empty((columns, words, lanes), _U), np.empty((columns, words, lanes), _U)
    one, index, tops = _U(1), np.empty(lanes, np.int64), np.zeros(lanes, _U)
    for j in range(columns):
        word, bit = j >> 6, _U(j & 63)
        np.multiply(text[j], lanes, out=index, dtype=np.int64)
        index += lane
        eq = flat[word : word + words + 1].take(index, axis=1)
        if bit:
            np.right_shift(eq[:-1], bit, out=part)
            np.left_shift(eq[1:], _U(64) - bit, out=shifted)
            eq = np.bitwise_or(part, shifted, out=eq[:-1])
        else:
            eq = eq[:-1]
        eq |= down
        np.bitwise_and(eq, up, out=part)
        add_carried(part, up, diagonal)
        diagonal ^= up
        diagonal |= eq
        np.bitwise_or(diagonal, up, out=right)
        np.invert(right, out=right)
        right |= down
        np.bitwise_and(diagonal, up, out=left)
        now = j + 1
        if now <= early:  # all lanes still follow their last diagonal
            tops += diagonal[-1] >> _U(63)
            if now == early:
                score += early - tops.astype(np.int64)
        elif now <= late:
            score += np.where(now <= turn, 1 - (diagonal[-1] >> _U(63)).astype(np.int64), 0)
        if now >= early:
            live = (now > turn) & (now <= stop)
            place = np.clip(m + above - now, 0, 64 * words - 1)
            where, shift = (place >> 6) * lanes + lane, (place & 63).astype(_U)
            step = ((right.reshape(-1).take(where) >> shift) & one).astype(np.int64) - ((left.reshape(-1).take(where) >> shift) & one).astype(np.int64)
            score += np.where(live, step, 0)
            live |= (now == turn) & (turn > 0)
            better = live & (score < best)
            best[better], first[better] = score[better], j
            last[live & (score == best)] = j
            ended = now == n
            final[ended] = score[ended]
        if keep:
            out.columns[0][j], out.columns[1][j] = diagonal, right
        np.right_shift(diagonal, one, out=shifted)
        if words > 1:
            shifted[:-1] |= diagonal[1:] << _U(63)
        np.bitwise_or(shifted, right, out=up)
        np.invert(up, out=up)
        up |= left
        np.bitwise_and(shifted, right, out=down)
    return out


def add_carried(part: np.ndarray, up: np.ndarray, out: np.ndarray) -> None:
    """part + up over all words of a lane, low word first; part is a subset of up."""
    np.add(part, up, out=out)
    if len(out) == 1:
        return
    over = out[:-1] < part[:-1]
    while True:
        out[1:] += over
        over &= out[1:] == 0
        if not over[:-1].any():  # out of the last word nothing is carried
            return
        over[1:] = over[:-1]
        over[0] = False


def sweep_rows(patterns: Sequence[np.ndarray], texts: Sequence[np.ndarray], table: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of patterns (of so many words) anywhere in their texts and the first best end, all rows of a column at once."""
    lanes, symbols = len(patterns), len(table)
    m, n = (np.array([len(x) for x in xs], np.int64) for xs in (patterns, texts))
    codes = np.full((lanes, words * 64), _NONE, np.uint8)
    text = np.full((lanes, int(n.max())), symbols - 1, np.uint8)
    for k in range(lanes):
        codes[k, : m[k]] = patterns[k]
        text[k, : n[k]] = texts[k]
    text = np.ascontiguousarray(text.T)
    flat = np.empty((words, symbols, lanes), _U)
    for s in range(symbols):
        flat[:, s] = np.packbits(table[s][codes], axis=1, bitorder="little").view(_U).T
    flat = flat.reshape(words, -1)
    lane, bit = np.arange(lanes), ((m - 1) & 63).astype(_U)
    up, down = np.full((words, lanes), ~_U(0)), np.zeros((words, lanes), _U)
    part, d, right, left, x = (np.empty_like(up) for _ in range(5))
    one, top = _U(1), _U(63)
    score, best, first = m.copy(), m + 1, np.full(lanes, -1)
    rises, falls = np.empty((2, COLUMNS, lanes), _U)
    for begin in range(0, len(text), COLUMNS):
        where = text[begin : begin + COLUMNS] * np.int64(lanes) + lane
        for j, index in enumerate(where):
            flat.take(index, axis=1, out=x, mode="clip")
            x |= down
            np.bitwise_and(x, up, out=part)
            add_carried(part, up, d)
            d ^= up
            d |= x
            np.bitwise_or(d, up, out=right)
            np.invert(right, out=right)
            right |= down
            np.bitwise_and(d, up, out=left)
            rises[j], falls[j] = right[-1], left[-1]
            if words > 1:
                np.right_shift(right, top, out=part)
                np.right_shift(left, top, out=x)
            right <<= one
            left <<= one
            if words > 1:
                right[1:] |= part[:-1]
                left[1:] |= x[:-1]
            np.bitwise_or(d, right, out=up)
            np.invert(up, out=up)
            up |= left
            np.bitwise_and(right, d, out=down)
        size = len(where)
        told = score + np.cumsum(((rises[:size] >> bit) & one).astype(np.int64) - ((falls[:size] >> bit) & one).astype(np.int64), axis=0)
        score = told[-1].copy()
        told[np.arange(begin, begin + size)[:, None] >= n] = np.iinfo(np.int64).max
        at = told.argmin(axis=0)
        least = told[at, lane]
        better = least < best
        best[better], first[better] = least[better], at[better] + begin
    return best, first


def stretches(m: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of n symbols cut for patterns of m: of each stretch its pair, begin and end. An alignment of least edits, m at
    most, takes in 2 m symbols at most, so behind its first 2 m columns a stretch has the values of the whole text;
    those before are never too low and belong to the stretch before."""
    lead, step = 2 * m, np.maximum(STRETCH, 4 * m)
    count = np.maximum(-((lead - n) // step), 1)
    of = np.repeat(np.arange(len(m)), count)
    begin = (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * step[of]
    return of, begin, np.minimum(n[of], begin + step[of] + lead[of])


def _ends(out: Spots, rows: np.ndarray, m: np.ndarray, n: np.ndarray, codes: list[np.ndarray], table: np.ndarray, patterns: list[str], texts: list[str], iupac: bool) -> None:
    """Least edits of the pairs in rows and the first best end, whole columns at a time."""
    if not rows.size:
        return
    of, begin, end = stretches(m[rows], n[rows])
    pair, best, first = rows[of], np.empty(len(of), np.int64), np.empty(len(of), np.int64)
    for at in batches(end - begin, words_for(m[pair])):
        if len(at) < FEW:
            for i in at:
                best[i], ends = alignment.infix_distance(patterns[pair[i]], texts[pair[i]][begin[i] : end[i]], iupac)
                first[i] = ends[0]
        else:
            own = [codes[len(patterns) + k][b:e] for k, b, e in zip(pair[at].tolist(), begin[at].tolist(), end[at].tolist(), strict=True)]
            best[at], first[at] = sweep_rows([codes[k] for k in pair[at]], own, table, int(words_for(m[pair[at[:1]]])[0]))
    first += begin
    order = np.lexsort((first, best, of))
    chosen = order[np.searchsorted(of[order], np.arange(len(rows)))]
    out.distance[rows], out.end[rows] = best[chosen], first[chosen]


def encoded(sequences: Sequence[str], iupac: bool) -> tuple[list[np.ndarray], np.ndarray] | None:
    """The sequences as codes and their match table; None if they hold what is no single byte."""
    try:
        raw = [np.frombuffer(s.encode("latin-1"), np.uint8) for s in sequences]
    except UnicodeEncodeError:
        return None
    seen = np.zeros(256, bool)
    for x in raw:
        seen[x] = True
    symbols = np.flatnonzero(seen).tolist()
    if len(symbols) >= _WILD:
        return None
    code = np.zeros(256, np.uint8)
    code[symbols] = np.arange(len(symbols))
    return [code[x] for x in raw], match_table(symbols, iupac)


def batches(sizes: np.ndarray, words: np.ndarray, most: int = LANES):
    """Pairs that go side by side: equal words, similar sizes."""
    most = np.minimum(most, np.maximum(STEP_WORDS // np.maximum(words, 1), 8))
    order = np.lexsort((sizes, words))
    start = 0
    for i in range(1, len(order) + 1):
        if i == len(order) or words[order[i]] != words[order[start]] or i - start >= most[order[start]] or sizes[order[i]] > UNEVEN * sizes[order[start]] + 64:
            yield order[start:i]
            start = i


def words_for(width: np.ndarray) -> np.ndarray:
    return -(-width // 64)


@dataclass
class Spots:
    """Where patterns lie in texts: least edits, first best start and end (inclusive). open: not told, as two others are nearer."""

    distance: np.ndarray
    start: np.ndarray
    end: np.ndarray
    open: np.ndarray


def locate(patterns: list[str], texts: list[str], iupac: bool = True, rivals: Sequence | None = None) -> Spots:
    """`first_location` of every pair of non-empty sequences, the pattern not longer than the text.

    rivals (a key for each pair): of pairs with one key only those are told that may be among the two with
    the highest identity."""
    count = len(patterns)
    m, n = (np.array([len(x) for x in xs], np.int64) for xs in (patterns, texts))
    out = Spots(np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, -1), np.zeros(count, bool))
    left = []
    for k, (p, t) in enumerate(zip(patterns, texts, strict=True)):
        at = t.find(p) if alignment.PLAIN.issuperset(p) and alignment.PLAIN.issuperset(t) else -1
        if at >= 0:
            out.start[k], out.end[k] = at, at + len(p) - 1
        else:
            left.append(k)
    both = encoded([*patterns, *texts], iupac) if left else None
    if left and both is None:
        for k in left:
            out.distance[k], out.start[k], out.end[k] = alignment.first_location(patterns[k], texts[k], iupac)
        left = []
    todo = np.array(left, np.int64)
    done, started = np.ones(count, bool), np.zeros(count, bool)
    done[todo] = False
    keys = None if rivals is None else np.unique(np.array([str(x) for x in rivals]), return_inverse=True)[1]
    words = words_for(n - m + 2 * np.minimum(FIRST, m) + 1)
    while todo.size:
        codes, table = both
        allow = np.minimum((64 * words - 1 - (n - m)) // 2, m)
        need = 2 * words
        rows = todo[words[todo] >= words_for(m[todo])]  # the band is no narrower than the pattern
        _ends(out, rows, m, n, codes, table, patterns, texts, iupac)
        done[rows] = True
        _starts(out, rows, codes, table, patterns, texts, iupac)
        todo = todo[~done[todo]]
        for group in batches(m[todo], words[todo]):
            at = todo[group]
            if len(at) < FEW:
                for k in at:
                    out.distance[k], out.start[k], out.end[k] = alignment.first_location(patterns[k], texts[k], iupac)
                done[at] = started[at] = True
                continue
            swept = sweep([codes[k] for k in at], [codes[count + k] for k in at], table, n[at] - m[at] + allow[at], int(words[at[0]]), True)
            sure = swept.best <= allow[at]
            out.distance[at[sure]], out.end[at[sure]] = swept.best[sure], swept.first[sure]
            done[at[sure]] = True
            far = (swept.best > HOPELESS * allow[at]) & (words[at] > 1)
            need[at[far]] = words_for(n[at] - m[at] + 2 * swept.best + 1)[far]
        told = todo[done[todo] & ~started[todo]]
        _starts(out, told, codes, table, patterns, texts, iupac)
        todo = todo[~done[todo]]
        if keys is not None and todo.size:
            low = np.where(done, 1 - out.distance / m, -1.0)
            order = np.lexsort((-low, keys))
            begin = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
            second = np.full(keys.max() + 1, -1.0)
            has = np.diff(np.concatenate([begin, [count]])) > 1
            second[keys[order[begin[has]]]] = low[order[begin[has] + 1]]
            out_of = m[todo] / (m[todo] + allow[todo] + 1) < second[keys[todo]]
            out.open[todo[out_of]] = True
            todo = todo[~out_of]
        words[todo] = np.minimum(need[todo], words_for(n[todo] + m[todo] + 1))
    return out


def _starts(out: Spots, told: np.ndarray, codes: list[np.ndarray], table: np.ndarray, patterns: list[str], texts: list[str], iupac: bool) -> None:
    """Starts of the pairs told: from the end backwards, as far as it goes."""
    count, m = len(patterns), np.array([len(p) for p in patterns], np.int64)
    words = np.exp2(np.ceil(np.log2(words_for(2 * out.distance + 1)))).astype(np.int64)
    for group in batches(m[told], words[told]):
        at = told[group]
        if len(at) < FEW:
            for k in at:
                out.start[k] = alignment.infix_start(patterns[k], texts[k], int(out.end[k]), int(out.distance[k]), iupac)
            continue
        distance, end = out.distance[at], out.end[at]
        reach = [codes[count + k][max(0, e + 1 - int(m[k]) - d) : e + 1][::-1] for k, d, e in zip(at, distance.tolist(), end.tolist(), strict=True)]
        swept = sweep([codes[k][::-1] for k in at], reach, table, distance, int(words[at[0]]), False)
        out.start[at] = np.where(swept.best == distance, end - swept.last, end)


def place_many(queries: list[str], references: list[str], rivals: Sequence | None = None) -> dict[str, list]:
    """`alignment.place` of every pair, as columns; with rivals (a key for each pair) null where two others of the key are nearer."""
    inner, outer, swapped, full = [], [], [], []
    for k, (q, r) in enumerate(zip(queries, references, strict=True)):
        if q and r:
            swap = len(q) > len(r)
            inner.append(r if swap else q)
            outer.append(q if swap else r)
            swapped.append(swap)
            full.append(k)
    spots = locate(inner, outer, True, [rivals[k] for k in full] if rivals is not None else None)
    empty = alignment.place("", "")
    out = {name: [value] * len(queries) for name, value in empty.items()}
    out["edit_distance"] = [len(q) + len(r) for q, r in zip(queries, references, strict=True)]
    for i, k in enumerate(full):
        if spots.open[i]:
            for name in out:
                out[name][k] = None
            continue
        distance, inside, whole = int(spots.distance[i]), (int(spots.start[i]), int(spots.end[i]) + 1), (0, len(inner[i]))
        q, r = (inside, whole) if swapped[i] else (whole, inside)
        told = (distance, max(0.0, 1.0 - distance / max(q[1] - q[0], r[1] - r[0], 1)), (q[1] - q[0]) / len(queries[k]), (r[1] - r[0]) / len(references[k]), *q, *r)
        for name, value in zip(out, told, strict=True):
            out[name][k] = value
    return out


_OPS = "=XDI"


def path_many(queries: list[str], references: list[str]) -> list[list[tuple[str, int]]]:
    """`alignment.global_path` of every pair."""
    out: list = [None] * len(queries)
    left = []
    for k, (q, r) in enumerate(zip(queries, references, strict=True)):
        if q == r or not q or not r:
            out[k] = alignment.global_path(q, r)
        else:
            left.append(k)
    both = encoded([*(queries[k] for k in left), *(references[k] for k in left)], False) if left else None
    if left and both is None:
        for k in left:
            out[k] = alignment.global_path(queries[k], references[k])
        return out
    m, n = (np.array([len(xs[k]) for k in left], np.int64) for xs in (queries, references))
    gap = np.abs(n - m)
    todo, words = np.arange(len(left)), words_for(gap + 2 * FIRST + 1)
    while todo.size:
        codes, table = both
        large = (n * words * 16 > PATH_BYTES) | (words > words_for(m))  # such a band is no help
        for i in todo[large[todo]]:
            out[left[i]] = alignment.global_path(queries[left[i]], references[left[i]])
        todo = todo[~large[todo]]
        spare = (64 * words - 1 - gap) // 2
        open_, need = [], 2 * words
        for w in np.unique(words[todo]):
            own = todo[words[todo] == w]
            most = max(1, min(LANES, PATH_BYTES // int(n[own].max() * w * 16)))
            for group in batches(m[own], words[own], most):
                at = own[group]
                if len(at) < min(FEW, most):
                    for i in at:
                        out[left[i]] = alignment.global_path(queries[left[i]], references[left[i]])
                    continue
                above = np.maximum(n[at] - m[at], 0) + spare[at]
                swept = sweep([codes[i] for i in at], [codes[len(left) + i] for i in at], table, above, int(w), False, keep=True)
                allow = gap[at] + 2 * spare[at] + 1
                sure = (swept.final <= allow) | (spare[at] >= np.minimum(m[at], n[at]))
                far = (swept.final > HOPELESS * allow) & (w > 1)
                need[at[far]] = words_for(swept.final + 2)[far]
                for i, path in zip(at[sure], _walk(swept, np.flatnonzero(sure), [codes[i] for i in at], [codes[len(left) + i] for i in at], above), strict=True):
                    out[left[i]] = path
                open_ += at[~sure].tolist()
        todo = np.array(open_, np.int64)
        words[todo] = np.minimum(need[todo], words_for(n[todo] + m[todo] + 1))
    return out


def _walk(swept: Swept, lanes: np.ndarray, queries: list[np.ndarray], references: list[np.ndarray], above: np.ndarray) -> list[list[tuple[str, int]]]:
    """From the last cells back to the first ones: a diagonal step where it costs what it should, else left, else up."""
    if not lanes.size:
        return []
    width = len(queries)
    words = swept.columns[0].shape[1]
    diagonal, right = (x.reshape(-1) for x in swept.columns)
    longest = max(max(len(queries[k]), len(references[k])) for k in lanes)
    q, r = np.zeros((len(lanes), longest), np.uint8), np.zeros((len(lanes), longest), np.uint8)
    for x, k in enumerate(lanes):
        q[x, : len(queries[k])], r[x, : len(references[k])] = queries[k], references[k]
    i, j = (np.array([len(xs[k]) for k in lanes], np.int64) for xs in (queries, references))
    over, row = above[lanes], np.arange(len(lanes))
    steps = []
    while True:
        live = (i > 0) & (j > 0)
        if not live.any():
            break
        x, y = np.maximum(i - 1, 0), np.maximum(j - 1, 0)
        place = i - j + over
        where, bit = (y * words + np.clip(place >> 6, 0, words - 1)) * width + lanes, (place & 63).astype(_U)
        kept = (diagonal.take(where) >> bit) & _U(1) > 0
        plus = (right.take(where) >> bit) & _U(1) > 0
        same = q[row, x] == r[row, y]
        op = np.where(same, 0, np.where(~kept, 1, np.where(plus, 2, 3))).astype(np.uint8)
        i -= live & (op != 2)
        j -= live & (op != 3)
        op[~live] = _NONE
        steps.append(op)
    told = np.array(steps, np.uint8).reshape(len(steps), len(lanes))
    out = []
    for x in range(len(lanes)):
        own = told[:, x]
        own = np.concatenate([own[own != _NONE], np.full(int(j[x]), 2, np.uint8), np.full(int(i[x]), 3, np.uint8)])[::-1]
        cut = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]])
        out.append([(_OPS[own[a]], int(b - a)) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)])
    return out

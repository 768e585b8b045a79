"""The alignment kernel: bit-parallel edit distances, locations and paths.

A pattern's rows are the bits of Python integers, so its length is not bounded;
short patterns (LANE_BITS symbols at most) also run side by side as NumPy lanes.
Symbols match if their IUPAC masks share a base, or literally.

Ties. Of several best places the ends are all given; the start of each is the
farthest one, so an alignment does not open with an insertion if a mismatch will
do. Paths are read from the end and prefer a diagonal step, then a deletion of a
reference base, then an insertion, which puts gaps as far left as they go.
"""

from __future__ import annotations

import math

import numpy as np

from ..functions.dna import COMPLEMENT, IUPAC, MASK

LANE_BITS = 63
PLAIN = frozenset("ACGT")
_COMPLEMENT = str.maketrans(IUPAC, COMPLEMENT)


def reverse_complement(seq: str) -> str:
    return seq.translate(_COMPLEMENT)[::-1]


def match_masks(pattern: str, iupac: bool) -> dict[str, int]:
    """For each symbol of a text the pattern's places that it matches."""
    zeros, backwards = dict.fromkeys(map(ord, set(pattern)), "0"), pattern[::-1]
    own = {p: int(backwards.translate(zeros | {ord(p): "1"}), 2) for p in set(pattern)}
    if not iupac:
        return own
    out = dict.fromkeys({*own, *IUPAC}, 0)
    for symbol in out:
        for p, places in own.items():
            if p == symbol or MASK.get(p, 0) & MASK.get(symbol, 0):
                out[symbol] |= places
    return out


def _columns(pattern: str, text: str, iupac: bool, free_start: bool):
    """Yield for each text place the score of the last row and the vertical differences."""
    peq = match_masks(pattern, iupac)
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    for symbol in text:
        eq = peq.get(symbol, 0)
        x = eq | down
        d = ((((x & up) + up) ^ up) | x) & full
        plus, minus = down | (full & ~(d | up)), up & d
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        plus = (plus << 1) | (0 if free_start else 1)
        minus <<= 1
        up = (minus | ~(d | plus)) & full
        down = plus & d & full
        yield score, up, down


def global_distance(a: str, b: str, iupac: bool = False) -> int:
    """Edits that turn a into b."""
    if not a or not b:
        return len(a) + len(b)
    score = len(a)
    for score, _, _ in _columns(a, b, iupac, False):  # noqa: B007
        pass
    return score


def infix_distance(pattern: str, text: str, iupac: bool = True) -> tuple[int, list[int]]:
    """Least edits of the pattern against any part of the text, and the inclusive ends of all best parts."""
    m = len(pattern)
    best, ends, score = m, [], m
    get, full, last = match_masks(pattern, iupac).get, (1 << m) - 1, 1 << (m - 1)
    up, down = full, 0
    for j, symbol in enumerate(text):  # as _columns, without the columns
        x = get(symbol, 0) | down
        d = ((((x & up) + up) ^ up) | x) & full
        plus, minus = down | (full ^ (d | up)), up & d
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        plus = (plus << 1) & full
        up = ((minus << 1) & full) | (full ^ (d | plus))
        down = plus & d
        if score < best:
            best, ends = score, [j]
        elif score == best:
            ends.append(j)
    return best, ends


def infix_start(pattern: str, text: str, end: int, distance: int, iupac: bool = True) -> int:
    """The farthest start of a best part that ends at end."""
    reach = text[max(0, end + 1 - len(pattern) - distance) : end + 1][::-1]
    start = end
    for j, (score, _, _) in enumerate(_columns(pattern[::-1], reach, iupac, False)):
        if score == distance:
            start = end - j
    return start


def infix_locations(pattern: str, text: str, iupac: bool = True, max_edits: int | None = None) -> tuple[int, list[tuple[int, int]]]:
    """Least edits and the (start, end) of every best part, ends inclusive; none beyond max_edits."""
    if not text:
        return len(pattern), []
    if pattern in text and PLAIN.issuperset(pattern) and PLAIN.issuperset(text):  # nothing is better than all that are equal
        spans, at = [], text.find(pattern)
        while at >= 0:
            spans.append((at, at + len(pattern) - 1))
            at = text.find(pattern, at + 1)
        return 0, spans
    distance, ends = infix_distance(pattern, text, iupac)
    if max_edits is not None and distance > max_edits:
        return distance, []
    spans = {(infix_start(pattern, text, e, distance, iupac), e) for e in ends}
    return distance, sorted(s for s in spans if s[0] <= s[1])


def first_location(pattern: str, text: str, iupac: bool = True) -> tuple[int, int, int] | None:
    """Least edits and the first (start, end) of a best part. Starts never fall as ends rise: of two best paths that
    crossed, the halves could be swapped; so the first end has the first start."""
    if not text:
        return None
    distance, ends = infix_distance(pattern, text, iupac)
    if not ends:
        return None
    return distance, infix_start(pattern, text, ends[0], distance, iupac), ends[0]


def common_tail(a: str, b: str) -> int:
    """How many symbols two texts share at their ends."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[len(a) - middle :] == b[len(b) - middle :]:
            low = middle
        else:
            high = middle - 1
    return low


def _steps(peq: dict[int, int], m: int, text: str, up: int, down: int):
    """Columns of a global alignment from one of which up and down are known: up and down before each column, whether it is a
    diagonal step without cost in each row, and whether its value is one more than that to its left."""
    full = (1 << m) - 1
    for symbol in text:
        eq = peq.get(symbol, 0)
        x = eq | down
        d = ((((x & up) + up) ^ up) | x) & full
        plus, minus = down | (full & ~(d | up)), up & d
        yield up, down, d, plus
        plus, minus = (plus << 1) | 1, minus << 1
        up, down = (minus | ~(d | plus)) & full, plus & d & full


def global_path(query: str, reference: str) -> list[tuple[str, int]]:
    """Operations (=, X, I: only in the query, D: only in the reference) with their counts.

    Only every so many columns are kept; those between are made again when the way back comes to them, so memory grows with
    the square root of the reference's length."""
    tail = common_tail(query, reference)  # read from the end, equal symbols are always a diagonal step
    i, j = len(query) - tail, len(reference) - tail
    counts: list[list] = [["=", tail]] if tail else []  # from the end on

    def add(op: str, n: int) -> None:
        if n and counts and counts[-1][0] == op:
            counts[-1][1] += n
        elif n:
            counts.append([op, n])

    if i and j:
        peq, m, text = match_masks(query[:i], False), i, reference[:j]
        every = math.isqrt(j) + 1
        marks = []
        for at, (up, down, _, _) in enumerate(_steps(peq, m, text, (1 << m) - 1, 0)):
            if at % every == 0:
                marks.append((up, down))
        while marks and i and j:
            start = (len(marks) - 1) * every
            part = [(d, plus) for _, _, d, plus in _steps(peq, m, text[start:j], *marks.pop())]
            while i and j > start:
                d, plus = part[j - 1 - start]
                bit = 1 << (i - 1)
                if query[i - 1] == reference[j - 1]:
                    add("=", 1)
                    i, j = i - 1, j - 1
                elif not d & bit:
                    add("X", 1)
                    i, j = i - 1, j - 1
                elif plus & bit:
                    add("D", 1)
                    j -= 1
                else:
                    add("I", 1)
                    i -= 1
    add("I", i)
    add("D", j)
    return [(op, n) for op, n in reversed(counts)]


def projected(query: str, reference: str, gap: str = "-", path: list[tuple[str, int]] | None = None) -> list[str]:
    """The query's symbol at each reference place, or gap. path: that of the two, if known."""
    out, qi, ri = [gap] * len(reference), 0, 0
    for op, n in global_path(query, reference) if path is None else path:
        if op in "=X":
            out[ri : ri + n] = query[qi : qi + n]
            qi, ri = qi + n, ri + n
        elif op == "I":
            qi += n
        else:
            ri += n
    return out


def place(query: str, reference: str) -> dict:
    """The shorter sequence inside the longer one: distance, identity, coverages and spans (ends exclusive).

    An empty side matches nothing: the other one's length in edits, no identity, no coverage."""
    if not query or not reference:
        return {"edit_distance": len(query) + len(reference), "identity": 0.0, "query_coverage": 0.0, "reference_coverage": 0.0, "query_start": 0, "query_end": 0, "reference_start": 0, "reference_end": 0}
    inner, outer = (query, reference) if len(query) <= len(reference) else (reference, query)
    at = outer.find(inner) if PLAIN.issuperset(inner) and PLAIN.issuperset(outer) else -1
    distance, start, end = (0, at, at + len(inner) - 1) if at >= 0 else first_location(inner, outer) or (len(inner), 0, -1)
    inside, whole = (start, end + 1), (0, len(inner))
    q, r = (whole, inside) if inner is query else (inside, whole)
    longest = max(q[1] - q[0], r[1] - r[0], 1)
    return {
        "edit_distance": distance,
        "identity": max(0.0, 1.0 - distance / longest),
        "query_coverage": (q[1] - q[0]) / len(query),
        "reference_coverage": (r[1] - r[0]) / len(reference),
        "query_start": q[0], "query_end": q[1], "reference_start": r[0], "reference_end": r[1],
    }


class Lanes:
    """Many short patterns against many texts: one 64-bit lane for each pair, one text place at a time."""

    def __init__(self, patterns: list[str], iupac: bool = True):
        if any(not 0 < len(p) <= LANE_BITS for p in patterns):
            raise ValueError(f"lanes hold patterns of 1 to {LANE_BITS} symbols")
        self.patterns = patterns
        size = np.array([len(p) for p in patterns], np.uint64)
        self.full = (np.uint64(1) << size) - np.uint64(1)
        self.last = np.uint64(1) << (size - np.uint64(1))
        self.size = size.astype(np.int32)
        self.peq = np.zeros((256, len(patterns)), np.uint64)
        for k, p in enumerate(patterns):
            for symbol, mask in match_masks(p, iupac).items():
                self.peq[ord(symbol), k] = mask

    def best(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Least edits and first end of every (text, pattern); -1 where a text is empty."""
        n, k = len(texts), len(self.patterns)
        longest = max((len(t) for t in texts), default=0)
        codes = np.zeros((n, longest), np.uint8)
        for i, t in enumerate(texts):
            codes[i, : len(t)] = np.frombuffer(t.encode("ascii", "replace"), np.uint8)
        length = np.array([len(t) for t in texts])
        up = np.broadcast_to(self.full, (n, k)).copy()
        down = np.zeros((n, k), np.uint64)
        score = np.broadcast_to(self.size, (n, k)).copy()
        best, end = score.copy(), np.full((n, k), -1, np.int32)
        for j in range(longest):
            x = self.peq[codes[:, j]] | down
            d = (((x & up) + up) ^ up) | x
            plus, minus = down | ~(d | up), up & d
            score += ((plus & self.last) != 0).astype(np.int32) - ((minus & self.last) != 0).astype(np.int32)
            plus, minus = plus << np.uint64(1), minus << np.uint64(1)
            up, down = (minus | ~(d | plus)) & self.full, plus & d & self.full
            better = (score < best) & (j < length)[:, None]
            best[better] = score[better]
            end[better] = j
        return best, end

    def scores(self, texts: list[str]) -> np.ndarray:
        """For one pattern: its least edits against any part that ends at each place (row) of each text (column); beyond a text's
        end as if a symbol followed that nothing matches."""
        codes = np.zeros((max(map(len, texts), default=0), len(texts)), np.uint8)
        for i, t in enumerate(texts):
            codes[: len(t), i] = np.frombuffer(t.encode("ascii", "replace"), np.uint8)
        full, one, top = self.full[0], np.uint64(1), self.size[0] - 1
        up, down = np.full(len(texts), full), np.zeros(len(texts), np.uint64)
        score, out = np.full(len(texts), self.size[0], np.int8), np.empty(codes.shape, np.int8)
        for j, symbols in enumerate(codes):
            x = self.peq[symbols, 0]
            x |= down
            d = x & up
            d += up
            d ^= up
            d |= x
            plus, minus = down | ~(d | up), up & d
            score += ((plus >> np.uint64(top)) & one).astype(np.int8)
            score -= ((minus >> np.uint64(top)) & one).astype(np.int8)
            out[j] = score
            plus <<= one
            minus <<= one
            up, down = (minus | ~(d | plus)) & full, plus & d & full
        return out

"""Inserts between an ordered pair of fuzzy motifs."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .alignment import LANE_BITS, PLAIN, Lanes, infix_locations, infix_start, reverse_complement
from .distances import pieces

INSERT = pa.struct([("status", pa.string()), ("insert", pa.string()), ("orientation", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())])
INSERT_TYPE = "struct<status:string,insert:string,orientation:string,start:int,end:int,edits:int>"


@dataclass(frozen=True)
class MotifPair:
    left: str
    right: str
    max_edits: int = 2
    both_strands: bool = True
    min_length: int = 0
    max_length: int | None = None
    expected_length: int | None = None

    def __post_init__(self) -> None:
        if self.max_edits < 0 or self.min_length < 0 or (self.max_length is not None and self.max_length < self.min_length):
            raise ValueError("edits and lengths are not negative, the longest insert is not shorter than the shortest")

    def solutions(self, left: tuple[int, list[tuple[int, int]]], right: tuple[int, list[tuple[int, int]]]) -> list[tuple[tuple[int, int, int, int], int]]:
        """((edits, length deviation, left start, right start), left end) of each ordered pair of best places with the least edits
        and deviation. left, right: edits and sorted (start, end) of each motif's best places; of the right ones only those in
        reach of a left one are looked at."""
        out: list[tuple[tuple[int, int, int, int], int]] = []
        least = None
        rights = sorted({s for s, _ in right[1]})
        for start, end in left[1]:
            low = bisect_left(rights, end + 1 + self.min_length)
            high = len(rights) if self.max_length is None else bisect_right(rights, end + 1 + self.max_length)
            if self.expected_length is not None and low < high:  # only the nearest on each side can have the least deviation
                at = bisect_left(rights, end + 1 + self.expected_length, low, high)
                low, high = max(low, at - 1), min(high, at + 1)
            for spot in rights[low:high]:
                off = abs(spot - end - 1 - self.expected_length) if self.expected_length is not None else 0
                if least is None or off <= least:
                    if off != least:
                        out = []
                    least = off
                    out.append(((left[0] + right[0], off, start, spot), end))
        return out

    def places(self, read: str) -> tuple:
        return tuple(infix_locations(m, read, max_edits=self.max_edits) for m in (self.left, self.right))

    def extract(self, read: str, found: list[tuple] | None = None) -> dict:
        """The insert of a read; found: for each strand the places of the left and the right motif, if known."""
        strands = [("forward", read)] + ([("reverse", reverse_complement(read))] if self.both_strands else [])
        every = found if found is not None else [self.places(text) for _, text in strands]
        told = sorted((key, name, text, end + 1) for (name, text), own in zip(strands, every, strict=True) for key, end in self.solutions(*own))
        none = {"insert": None, "orientation": "unknown", "start": None, "end": None, "edits": None}
        if not told:
            return none | {"status": "motif_missing"}
        rivals: set[tuple[str, str]] = set()
        for key, name, text, start in told:
            if key[:2] != told[0][0][:2] or len(rivals) > 1:
                break
            rivals.add((name, text[start : key[3]]))
        if len(rivals) > 1:
            return none | {"status": "ambiguous", "edits": told[0][0][0]}
        key, name, text, start = told[0]
        return {"status": "found", "insert": text[start : key[3]], "orientation": name, "start": start, "end": key[3], "edits": key[0]}


#: Bases that a lane goes through, and lanes that go side by side.
CHUNK, SIDE = 512, 4096


def best_ends(motif: str, texts: list[str], most: int) -> list[tuple[int, np.ndarray]]:
    """Least edits (more than most: most + 1) of a motif in each text, and the ends of all best parts.

    Texts are cut into chunks that overlap by what a part within the edits can span, so lanes are of one length."""
    lanes = Lanes([motif])
    step, reach = CHUNK, len(motif) + most
    of, at, cut = [], [], []
    for k, t in enumerate(texts):
        for i in range(0, len(t), step):
            of.append(k)
            at.append(i)
            cut.append(t[max(0, i - reach) : i + step])
    score = np.full(len(texts), most + 1, np.int64)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(0, len(cut), SIDE):
        part, own, begin = cut[i : i + SIDE], np.array(of[i : i + SIDE]), np.array(at[i : i + SIDE])
        told = lanes.scores(part)  # a row for each place of a chunk
        lead = np.minimum(begin, reach)
        place, lane = np.nonzero((told <= most) & (np.arange(len(told))[:, None] >= lead) & (np.arange(len(told))[:, None] < np.array([len(c) for c in part])))
        edits = told[place, lane].astype(np.int64)
        np.minimum.at(score, own[lane], edits)
        held.append((own[lane], begin[lane] - lead[lane] + place, edits))
    read, end, edits = (np.concatenate(x) if held else np.zeros(0, np.int64) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.int64),) * 3
    best = edits == score[read]
    read, end = read[best], end[best]
    order = np.lexsort((end, read))
    bounds = np.searchsorted(read[order], np.arange(len(texts) + 1))
    return [(int(score[k]), end[order[bounds[k] : bounds[k + 1]]]) for k in range(len(texts))]


def locations(motif: str, texts: list[str], most: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """`infix_locations` of a motif in every text."""
    out: list = [None] * len(texts)
    left = []
    plain = PLAIN.issuperset(motif)
    for k, t in enumerate(texts):
        if not (plain and PLAIN.issuperset(t)) or not 0 < len(motif) <= LANE_BITS or most >= len(motif):
            out[k] = infix_locations(motif, t, max_edits=most)
        elif motif in t:
            out[k] = infix_locations(motif, t, max_edits=most)
        elif not most:
            out[k] = (1, [])
        else:
            left.append(k)
    for k, (edits, ends) in zip(left, best_ends(motif, [texts[k] for k in left], most) if left else (), strict=True):
        spans = {(infix_start(motif, texts[k], e, edits), e) for e in ends.tolist()} if edits <= most else set()
        out[k] = edits, sorted(s for s in spans if s[0] <= s[1])
    return out


def extract_inserts(reads: DataFrame, pair: MotifPair, seq: str = "sequence", name: str = "extraction") -> DataFrame:
    """reads with the extraction as a struct column."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in reads.schema.fields)}, `{name}` {INSERT_TYPE}"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, (seq,)):
                forward = [s or "" for s in part.column(seq).to_pylist()]
                texts = [forward, [reverse_complement(s) for s in forward]] if pair.both_strands else [forward]
                places = [[locations(m, own, pair.max_edits) for m in (pair.left, pair.right)] for own in texts]
                found = [pair.extract(s, [(own[0][k], own[1][k]) for own in places]) for k, s in enumerate(forward)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, INSERT)], [*part.schema.names, name])

    return reads.mapInArrow(kernel, schema)

"""The barcode filter by exact pieces changes no call."""

import random

import pytest

from strandlake.operators import demux


def noisy(r, s, edits):
    s = list(s)
    for _ in range(edits):
        i = r.randrange(len(s))
        s[i : i + 1] = r.choice([[], [r.choice("ACGT")], [s[i], r.choice("ACGT")]])
    return "".join(s)


@pytest.mark.parametrize("seed,policy,both,edits", [(1, "best_margin", True, 3), (2, "best_margin", False, 2), (3, demux.POLICIES[-1], True, 3), (4, "best_margin", True, 4), (5, "best_margin", True, 0)])
def test_calls_equal_without_it(monkeypatch, seed, policy, both, edits):
    r = random.Random(seed)
    new = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    panel = [(f"b{i}", new(r.randint(24, 28))) for i in range(20)]
    reads = []
    for _ in range(150):
        head, tail = noisy(r, r.choice(panel)[1], r.randint(0, 6)), demux.reverse_complement(noisy(r, r.choice(panel)[1], r.randint(0, 6)))
        read = new(r.choice([0, 1, 30])) + r.choice([head, "", new(20)]) + new(r.choice([0, 40, 200])) + r.choice([tail, ""]) + new(r.choice([0, 2, 50]))
        reads.append(read if r.random() < 0.8 else read.replace("A", "N", 2))
    reads += ["", "A", "ACG" * 50, panel[0][1], panel[0][1] * 3]
    s = demux.CallSettings(window=90, max_edits=edits, both_strands=both, policy=policy)
    got = demux.Caller(panel, s).calls(reads)
    assert demux.Caller(panel, s).pieces.usable
    monkeypatch.setattr(demux, "FILTERED", 1 << 30)
    assert got == demux.Caller(panel, s).calls(reads)
    assert sum(c.status == "assigned" for c in got) > 10


def test_short_or_ambiguous_barcodes_go_without_it():
    assert not demux.PieceFilter(["ACGTAC"], 3).usable
    assert not demux.PieceFilter(["ACGTNCGTACGTACGTACGTA"], 3).usable
    assert not demux.PieceFilter([], 3).usable

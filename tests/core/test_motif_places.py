"""Motif places of many reads at once against the one-read kernel."""

import random

import pytest

from strandlake.operators import alignment as al
from strandlake.operators import motifs


@pytest.mark.parametrize("motif,most", [("ACGTACG", 0), ("ACCGTACG", 2), ("GTACCATGACCA", 3), ("ACG", 2), ("RACGT", 1)])
def test_places_equal_the_kernel(monkeypatch, motif, most):
    monkeypatch.setattr(motifs, "CHUNK", 16)
    monkeypatch.setattr(motifs, "SIDE", 7)
    r = random.Random(most)
    texts = ["".join(r.choice("ACGT") for _ in range(r.choice([0, 1, 2, 15, 16, 17, 40, 300]))) for _ in range(80)] + ["ACGNACGTRY" * 5]
    for text, (edits, spans) in zip(texts, motifs.locations(motif, texts, most), strict=True):
        want = al.infix_locations(motif, text, max_edits=most)
        assert spans == want[1] and (edits == want[0] or min(edits, want[0]) > most or not text)


@pytest.mark.parametrize("expected", [None, 12])
def test_pairs_equal_all_pairs(expected):
    r = random.Random(9)
    pair = motifs.MotifPair("ACG", "GTA", 1, True, 3, 40, expected)
    for _ in range(300):
        read = "".join(r.choice("ACGT") for _ in range(r.randint(0, 90)))
        every = []
        for name, text in (("forward", read), ("reverse", al.reverse_complement(read))):
            (a, lefts), (b, rights) = pair.places(text)
            for start, end in lefts:
                for spot, _ in rights:
                    if 3 <= spot - end - 1 <= 40:
                        every.append(((a + b, abs(spot - end - 1 - expected) if expected else 0, start, spot), name, text[end + 1 : spot]))
        every.sort()
        rivals = {x[1:] for x in every if x[0][:2] == every[0][0][:2]}
        got = pair.extract(read)
        assert got["status"] == ("motif_missing" if not every else "ambiguous" if len(rivals) > 1 else "found")
        assert got["status"] != "found" or (got["orientation"], got["insert"], got["end"]) == (*every[0][1:], every[0][0][3])


def test_many_places_of_both_motifs():
    """90,000,000 pairs before; now each left place looks at those in its reach."""
    pair = motifs.MotifPair("ACCGTA", "GTACCA", 0, False, 10, 300, 60)
    read = "ACCGTA" * 8000 + "GTACCA" * 8000
    found = [tuple(motifs.locations(m, [read], 0)[0] for m in (pair.left, pair.right))]
    assert pair.extract(read, found)["status"] in ("found", "ambiguous")

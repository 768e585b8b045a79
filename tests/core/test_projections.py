"""Reads laid over scaffolds side by side, against the one-pair paths."""

import random

import numpy as np
import pytest

from strandlake.operators import alignment as al
from strandlake.operators import clustering as cl
from strandlake.operators import projections as pr


def text(r, n, letters="ACGT"):
    return "".join(r.choice(letters) for _ in range(n))


def worn(r, s, letters="ACGT"):
    return "".join((r.choice(letters) if r.random() < 0.1 else c) + (r.choice(letters) if r.random() < 0.05 else "") for c in s if r.random() > 0.07)


@pytest.mark.parametrize("spare", [0.0, 0.05, 0.28, 1.0])
def test_rows_are_those_of_one_path(monkeypatch, spare):
    """Worn, unlike, equal, empty, much longer and much shorter reads; narrow bands that must be widened; one to four words."""
    monkeypatch.setattr(pr, "SPARE", spare)
    monkeypatch.setattr(pr, "FEW", 1)
    r = random.Random(int(spare * 100))
    for letters, kept in (("ACGT", 1 << 16), ("ACGTN", 1 << 20), ("AB", 1 << 27), ("acgtACGT-.", 1 << 27)):
        monkeypatch.setattr(pr, "KEPT_BYTES", kept)
        for size in (1, 12, 64, 130, 250):
            base = text(r, size, letters)
            other = text(r, r.randint(1, 2 * size), letters)
            pairs = [(worn(r, base, letters), base) for _ in range(12)] + [(text(r, r.randint(0, 3 * size), letters), r.choice([base, other])) for _ in range(25)]
            pairs += [(base, base), ("", base), (base, ""), (other + base * 5, base), (base[::5], base), pairs[0]]
            for (q, s), row in zip(pairs, pr.project_many([q for q, _ in pairs], [s for _, s in pairs]), strict=True):
                assert row.tolist() == al.projected(q, s), (q, s)


def test_symbols_beyond_a_byte():
    assert [x.tolist() for x in pr.project_many(["AŁCC", "A"], ["ŁAC", "AŁ"], ".")] == [al.projected("AŁCC", "ŁAC", "."), ["A", "."]]


def test_unlike_reads_of_a_well_are_laid_once_and_not_one_by_one(monkeypatch):
    """Their paths were told one by one before, and twice for each read."""
    r = random.Random(8)
    base = text(r, 400)
    reads = [text(r, r.randint(300, 420)) for _ in range(30)] + [worn(r, base) for _ in range(30)]
    scaffold = reads[cl.seed_of(reads)]
    rows = np.array([al.projected(q, scaffold) for q in reads])
    polished = "".join(b for b in cl.modal(rows) if b != "-")
    rows = np.array([al.projected(q, polished) for q in reads])
    places = cl.variant_places(rows, cl.ClusterSettings())
    names = [f"r{i:02d}" for i in range(60)]
    expected = cl.gather(names, rows[:, places], cl.ClusterSettings())

    def alone(*_):
        raise AssertionError("a path by itself")

    monkeypatch.setattr(al, "global_path", alone)
    found, at, why = cl.cluster(names, reads)
    assert ((found, why), at) == (expected, places.tolist())
    laid = []
    known = pr.project_many
    monkeypatch.setattr(cl, "project_many", lambda q, s, gap: laid.append(len(q)) or known(q, s, gap))
    same = [base] + ["".join(r.choice("ACGT") if r.random() < 0.1 else c for c in base) for _ in range(29)]
    assert cl.clusters([(names[:30], same), (names[:3], same[:3]), (names[:40], [*same, *same[:10]])])[1][2] == "too few reads"
    assert sum(laid) == 70  # the polished scaffolds are the seeds

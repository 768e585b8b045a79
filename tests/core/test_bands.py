"""Banded lanes against the big-integer kernel, pair by pair."""

import random

import numpy as np
import pytest

from strandlake.operators import alignment as al
from strandlake.operators import bands


@pytest.fixture(autouse=True, params=[1, 16])
def few(request, monkeypatch):
    monkeypatch.setattr(bands, "FEW", request.param)


def mutated(r, s, rate, letters="ACGT"):
    out = []
    for c in s:
        x = r.random()
        if x < rate / 3:
            continue
        out.append(r.choice(letters) if x < 2 * rate / 3 else c)
        if 2 * rate / 3 <= x < rate:
            out.append(r.choice(letters))
    return "".join(out)


def pairs(seed, letters="ACGT", count=120, longest=400):
    r = random.Random(seed)
    new = lambda n: "".join(r.choice(letters) for _ in range(n))
    out = []
    for _ in range(count):
        a = new(r.choice([1, 2, 5, 63, 64, 65, r.randint(1, longest)]))
        kind = r.random()
        b = mutated(r, a, r.choice([0.0, 0.02, 0.1, 0.4]), letters) if kind < 0.6 else new(r.randint(1, longest))
        b = new(r.choice([0, 3, r.randint(0, longest)])) + b + new(r.choice([0, 3, r.randint(0, 60)]))
        out.append((a, b) if r.random() < 0.5 else (b, a))
    return [*out, ("", "ACGT"), ("ACGT", ""), ("", ""), ("A" * 200, "A" * 90), ("AC" * 70, "CA" * 75), ("A" * 130, "C" * 130)]


@pytest.mark.parametrize("seed,letters", [(1, "ACGT"), (2, "ACGTNRY"), (3, "A"), (4, "AC"), (5, "ACGT-é")])
def test_places_equal_the_kernel(seed, letters):
    own = pairs(seed, letters)
    got = bands.place_many([a for a, _ in own], [b for _, b in own])
    for k, (a, b) in enumerate(own):
        assert {name: got[name][k] for name in got} == al.place(a, b), (a, b)


def test_symbols_beyond_one_byte():
    own = [("ACŁGT", "ACGŁT"), ("A", "Ł")]
    got = bands.place_many([a for a, _ in own], [b for _, b in own])
    assert [got["edit_distance"][k] for k in range(2)] == [al.place(*p)["edit_distance"] for p in own]
    assert bands.path_many(["AŁ"], ["ŁA"]) == [al.global_path("AŁ", "ŁA")]


@pytest.mark.parametrize("seed", [1, 2])
def test_two_best_of_a_key_are_told(seed):
    r = random.Random(seed)
    reads, refs, keys = [], [], []
    for key in range(20):
        read = "".join(r.choice("ACGT") for _ in range(300))
        for _ in range(r.randint(1, 7)):
            reads.append(read)
            refs.append(mutated(r, read, r.choice([0.01, 0.05, 0.2, 0.5, 0.9])))
            keys.append(key)
    got = bands.place_many(reads, refs, keys)
    untold = 0
    for key in range(20):
        own = [k for k in range(len(keys)) if keys[k] == key]
        want = {k: al.place(reads[k], refs[k]) for k in own}
        best = sorted((w["identity"] for w in want.values()), reverse=True)[:2]
        for k in own:
            if got["identity"][k] is None:
                untold += 1
                assert want[k]["identity"] < best[1]
            else:
                assert {name: got[name][k] for name in got} == want[k]
    assert untold > 5


@pytest.mark.parametrize("seed,letters", [(1, "ACGT"), (2, "ACGTN-"), (3, "AC"), (4, "A")])
def test_paths_equal_the_kernel(seed, letters):
    own = pairs(seed, letters, 80, 250)
    for (a, b), path in zip(own, bands.path_many([a for a, _ in own], [b for _, b in own]), strict=True):
        assert path == al.global_path(a, b), (a, b)


def test_large_paths_go_to_the_kernel(monkeypatch):
    monkeypatch.setattr(bands, "PATH_BYTES", 4000)
    r = random.Random(3)
    own = [("".join(r.choice("ACGT") for _ in range(n)), "".join(r.choice("ACGT") for _ in range(m))) for n, m in ((40, 300), (300, 40), (20, 22))]
    assert bands.path_many([a for a, _ in own], [b for _, b in own]) == [al.global_path(a, b) for a, b in own]


def test_long_texts_are_cut_into_stretches_of_like_length():
    m, n = np.array([200, 200, 300, 3000]), np.array([150, 40_000, 2_700, 40_000])
    of, begin, end = bands.stretches(m, n)
    assert (end - begin).max() <= np.maximum(2048, 4 * m).max() + 2 * m.max() and (end - begin)[of < 3].max() <= 2048 + 600
    for k in range(len(m)):
        b, e = begin[of == k], end[of == k]
        assert b[0] == 0 and e[-1] == n[k] and (e[:-1] - b[1:] == 2 * m[k]).all() and (e > b).all()


def test_stretches_tell_what_whole_texts_do(monkeypatch):
    monkeypatch.setattr(bands, "STRETCH", 1)
    monkeypatch.setattr(bands, "COLUMNS", 7)
    r = random.Random(12)
    dna = lambda n: "".join(r.choice("ACGTN") for _ in range(n))
    queries, references = [], []
    for _ in range(120):
        p = dna(r.choice((9, 70, 130, 200)))
        spots = [dna(r.randint(0, 900)), "".join(c for c in p if r.random() > 0.1), dna(r.randint(0, 400)), p[:-1] + "A", dna(r.randint(0, 300)), p[:-1] + "A"]
        queries.append("".join(spots[: r.randint(1, 6)]) or "A")
        references.append(p)
    queries += ["A" * 900, "AC" * 700] * 20
    references += ["T" * 70, "CA" * 50] * 20
    got = bands.place_many(queries, references)
    for k, (q, s) in enumerate(zip(queries, references)):
        assert {name: got[name][k] for name in got} == al.place(q, s)

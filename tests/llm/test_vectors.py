"""Centroids and vector codes against plain rounds in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from strandlake.llm import centroids, vector_codes
from strandlake.llm.vectors import CLIP, LONGEST

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, vector int, code string, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", "d", 7, "e", 1) for i, v, label in rows], SCHEMA)


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v, scale):
    return [max(-CLIP, min(CLIP, math.floor(scale * float(np.float32(x))))) for x in v]


def square(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def rounds_of(vectors, start, rounds):
    middle = [list(c) for c in start]
    put = lambda: [min(range(len(middle)), key=lambda j: (square(v, middle[j]), j)) for v in vectors]
    for _ in range(rounds):
        at = put()
        for j in range(len(middle)):
            mine = [v for v, a in zip(vectors, at, strict=True) if a == j]
            if mine:
                middle[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return middle, put()


def brute_clusters(rows, k, rounds, dims, scale):
    kept = [(i, whole(v, scale)) for i, v, _ in rows if good(v) and len(v) == dims]
    drawn = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    middle, at = rounds_of([v for _, v in kept], [v for _, v in drawn[:k]], rounds)
    return sorted((str(i), a, min(LONGEST, square(v, middle[a]))) for (i, v), a in zip(kept, at, strict=True)), middle


def mixed(seed, n, dims):
    """Vectors round a few middles, with copies, ties and everything that is dropped."""
    r = random.Random(seed)
    middles = [[r.uniform(-2, 2) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [x + r.gauss(0, 0.2) for x in r.choice(middles)], r.choice([None, 1, 2, 3])) for i in range(n)]
    rows += [(1000 + i, rows[0][1], 5) for i in range(20)] + [rows[3], rows[3]]
    rows += [(2000, [0.0] * dims, 1), (2001, None, 1), (2002, [], 1), (2003, [math.nan] * dims, 1), (2004, [math.inf] + [0.0] * (dims - 1), 1), (2005, [None] * dims, 1), (2006, [1.0] * (dims - 1), 1), (None, [0.5] * dims, None)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_clusters(spark, rounds):
    rows = mixed(rounds, 150, 8)
    found, middle = centroids.cluster_vectors(table(spark, rows).repartition(3), 5, rounds, 8)
    want, middles = brute_clusters(rows, 5, rounds, 8, 64)
    assert middle == middles
    got = found.collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got) == want
    assert sum(r.computed for r in got) < (rounds + 1) * 5 * len(got)


def test_bounds_skip_most_when_clusters_lie_apart(spark):
    r = random.Random(2)
    rows = [(i, [10.0 * (i % 4 == j) + r.gauss(0, 0.1) for j in range(4)], 0) for i in range(400)]
    found, _ = centroids.cluster_vectors(table(spark, rows), 4, 6, 4)
    assert sum(x.computed for x in found.collect()) < 0.5 * 400 * 4 * 7


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 5), float(i % 3)], 0) for i in range(60)]
    found, middle = centroids.cluster_vectors(table(spark, rows), 7, 2, 2, 1)
    want, middles = brute_clusters(rows, 7, 2, 2, 1)
    assert middle == middles and sorted((str(r.vec_id), r.cluster, r.distance) for r in found.collect()) == want


@pytest.mark.parametrize("size", [3.0e7, 1e12, 1e25])
def test_large_components(spark, size):
    r = random.Random(4)
    rows = [(i, [r.choice([1, -1]) * size * r.random(), r.random()], 0) for i in range(40)]
    found, middle = centroids.cluster_vectors(table(spark, rows).coalesce(1), 4, 3, 2)
    want, middles = brute_clusters(rows, 4, 3, 2, 64)
    assert middle == middles and sorted((str(x.vec_id), x.cluster, x.distance) for x in found.collect()) == want
    brute_codes_equal(spark, rows, 2, 3, 2)


def test_few_and_none(spark):
    found, middle = centroids.cluster_vectors(table(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]), 16, 3, 2)
    assert sorted((x.vec_id, x.cluster, x.distance) for x in found.collect()) == [(1, 0, 0), (2, 0, 0)] and len(middle) == 2
    for rows in ([], [(1, None, 0)], [(1, [1.0], 0)]):
        found, middle = centroids.cluster_vectors(table(spark, rows), 4, 3, 2)
        assert found.collect() == [] and middle == []


def brute_codes_equal(spark, rows, parts, rounds, entries, scale=1024, **more):
    kept = [(i, whole(v, scale), label) for i, v, label in rows if good(v)]
    sizes = [len(v) for _, v, _ in kept]
    dims = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    width = -(-dims // parts)
    fit = [(i, v + [0] * (parts * width - dims), label) for i, v, label in kept if len(v) == dims]
    first = sorted(fit, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books, codes, errors = [], [""] * len(fit), [0] * len(fit)
    for p in range(parts):
        cut = lambda v: v[p * width : (p + 1) * width]  # noqa: B023, E731
        middle, at = rounds_of([cut(v) for _, v, _ in fit], [cut(v) for _, v, _ in first], rounds)
        books += [x for c in middle for x in c]
        for j, a in enumerate(at):
            codes[j] += f"{a:02x}"
            errors[j] += square(cut(fit[j][1]), middle[a])
    out = [(i, codes[j], min(errors[j], LONGEST), label) for j, (i, _, label) in enumerate(fit)] + [(i, None, None, label) for i, v, label in kept if len(v) != dims]
    of = {}
    for _, _, e, label in out:
        of[label] = of.get(label, 0) + (e or 0)
    got, found = vector_codes.compress_vectors(table(spark, rows).repartition(3), parts, entries, rounds, scale, **more)
    shaped = lambda rs: sorted(map(str, rs))
    got = vector_codes.with_label_errors(got, limit=len(of) - 1 if more else 100)
    empty = {label for label in of if all(x[2] is None for x in out if x[3] == label)}
    assert shaped((x.vec_id, x.code, x.error, x.label_error) for x in got.collect()) == shaped((i, c, e, None if label in empty else min(of[label], LONGEST)) for i, c, e, label in out)
    assert found.sha256() == hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()


@pytest.mark.parametrize("parts,dims,more", [(4, 8, {}), (4, 8, {"block": 7}), (2, 7, {})])
def test_codes(spark, parts, dims, more):
    brute_codes_equal(spark, mixed(dims, 120, dims), parts, 3, 16, **more)


def test_codes_of_few_and_none(spark):
    brute_codes_equal(spark, [(1, [1.0, 2.0], 0), (1, [0.0, 2.0], None), (2, [1.0], 3)], 2, 2, 4)
    brute_codes_equal(spark, [(1, [], 0), (2, [], 1)], 2, 2, 4)
    for rows in ([], [(1, None, 0)]):
        got, books = vector_codes.compress_vectors(table(spark, rows))
        assert got.collect() == [] and books.entries.size == 0


def test_labels_of_any_type(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], {"a": i % 2}, [str(i % 2)]) for i in range(6)], "vec_id long, embedding array<float>, m map<string,int>, label array<string>")
    got, _ = vector_codes.compress_vectors(df, 2, 2, 1)
    assert sorted(got.select("label").distinct().collect()) == [(["0"],), (["1"],)]

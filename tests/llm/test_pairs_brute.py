"""Operators against brute force on small fixtures."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from strandlake.llm import near_duplicates as nd
from strandlake.llm import sharding as sh


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, print string, key string, row long, body string")


def docs(spark, pairs):
    """Documents with extra columns whose names clash with internal ones."""
    return frame(spark, [(i, t, "x", "y", 3, "z") for i, t in pairs])


def brute_print(text, words):
    toks = (text or "").encode().lower().split()
    if not toks:
        return 0
    sh = [b" ".join(toks[i : i + words]) for i in range(max(1, len(toks) - words + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints, distance):
    ids = [i for i, _ in prints]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            r = find(i)
            least[r] = min(least.get(r, ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(ids))]


def random_texts(seed, n):
    r = random.Random(seed)
    base = [" ".join(r.choice(["the", "of", "And", "éa", "xy", "q", "zz"]) for _ in range(r.randint(0, 60))) for _ in range(n)]
    out = list(base)
    for t in base[: n // 2]:
        w = t.split()
        for _ in range(3):
            if w:
                w[r.randrange(len(w))] = "new"
                out.append(" ".join(w))
    return [*out, None, "", " \t\n", "One", base[0], base[0], "a" * 50_000]


@pytest.mark.parametrize("bucket", [4096, 7])
def test_near_duplicates_brute(spark, bucket):
    texts = random_texts(5, 60)
    pairs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[1]), (0, texts[0])]
    got = nd.near_duplicates(docs(spark, pairs), words=4, distance=4, bucket=bucket).collect()
    prints = [(i, brute_print(t, 4)) for i, t in pairs]
    want = sorted(((i, p if p < 1 << 63 else p - (1 << 64), c) for (i, p), c in zip(prints, brute_components(prints, 4))), key=str)
    assert sorted(((r.doc_id, r.print, r.component_id) for r in got), key=str) == want


def test_forest_keeps_components_of_dense_and_sparse_items():
    r = np.random.default_rng(3)
    centre = r.integers(0, 1 << 63, 3, dtype=np.uint64)
    prints = np.unique(np.concatenate([c ^ np.array([(1 << int(a)) | (1 << int(b)) for a, b in r.integers(0, 64, (90, 2))], np.uint64) for c in centre]))
    a, b = nd.forest(prints, np.zeros(len(prints), bool), 4)
    assert len(a) < len(prints)
    edges = set(zip(a.tolist(), b.tolist()))
    root = {int(p): int(p) for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in edges:
        assert (x ^ y).bit_count() <= 4
        root[find(x)] = find(y)
    want = brute_components([(int(p), int(p)) for p in prints], 4)
    groups = {}
    for p, c in zip(prints, want):
        groups.setdefault(c, set()).add(find(int(p)))
    assert all(len(g) == 1 for g in groups.values())


@pytest.mark.parametrize("n", [10, 100_000, 10_000_000, 10_000_000_000])
def test_plan_covers_the_distance(n):
    together = np.full((64, 64), n / 4)
    np.fill_diagonal(together, n / 2)
    plan = nd.plan_search(n, together, 4)
    assert sum(t + 1 for _, t in plan) == 5
    bits = [b for p, _ in plan for b in p]
    assert len(bits) == len(set(bits))


def test_empty_near_duplicates(spark):
    assert nd.near_duplicates(docs(spark, [])).collect() == []


@pytest.mark.parametrize("per_part,hot,repeats", [(50, 1.0, 10**6), (3, 0.01, 7), (20_000, 0.05, 10**6)])
def test_sharding_law(spark, per_part, hot, repeats):
    r = random.Random(2)
    texts = ["é" * r.randint(0, 300) for _ in range(300)] + ["same text"] * 40 + [None, "", None]
    pairs = [(i % 330, t) for i, t in enumerate(texts)] + [(5, "again and again")] * 30
    place = lambda df: sorted(tuple(x) for x in sh.shard_documents(df, 8, groups_per_part=per_part, rows_per_bucket=60, hot=hot, repeats=repeats).collect())
    got = sh.shard_documents(docs(spark, pairs), 8, groups_per_part=per_part, rows_per_bucket=60, hot=hot, repeats=repeats).collect()
    assert sorted((x.doc_id, x.size, x.text_crc32) for x in got) == sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
    by_text = {}
    for x in got:
        by_text.setdefault((x.text_crc32, x.size), set()).add(x.shard)
    assert all(len(s) == 1 for s in by_text.values())
    for s in range(8):
        slots = sorted(x.slot for x in got if x.shard == s)
        assert slots == list(range(len(slots)))
    loads = [sum(x.size for x in got if x.shard == s) for s in range(8)]
    assert max(loads) - min(loads) <= max(len((t or "").encode()) for t in texts)
    assert sorted(tuple(x) for x in got) == place(docs(spark, pairs[::-1]).repartition(5))  # whatever the input's order


def test_sharding_empty_and_one_group(spark):
    assert sh.shard_documents(docs(spark, [])).collect() == []
    got = sh.shard_documents(docs(spark, [(None, "a")] * 5)).collect()
    assert {x.shard for x in got} == {got[0].shard} and sorted(x.slot for x in got) == list(range(5))


def test_difference_beats_the_worst_case():
    r = random.Random(1)
    sizes = [r.randint(1, 1000) for _ in range(400)]
    goes = sh.difference([(s, 0, 0, 0) for s in sizes], 4)
    loads = [sum(s for s, g in zip(sizes, goes) if g[0] == k) for k in range(4)]
    assert max(loads) - min(loads) <= 5

"""Repeated passages against brute force."""

import hashlib
import random

import pytest

from strandlake.llm import suffix_dedup as sd


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, 1, "x", b"y") for i, t in pairs], "doc_id long, text string, chunk int, body string, data binary")


def brute(pairs, length=100):
    """Rows in order of ids; ties and null ids in the order given, null ids last."""
    seen, out = set(), [None] * len(pairs)
    for k in sorted(range(len(pairs)), key=lambda k: (pairs[k][0] is None, pairs[k][0] or 0, k)):
        data = (pairs[k][1] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[k] = (str(pairs[k][0]), len(data), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return sorted(out)


def passages(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["the", "of", "é", "anker", "x", "lorem", "qua", "zz"]) + r.choice(["", "", "ing", str(r.randint(0, 99))])
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(n) for n in (20, 25, 30, 60, 200)]
    out = []
    for _ in range(60):
        parts = [text(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            if r.random() < 0.5:
                a = r.randint(0, len(s) // 2)
                s = s[a : a + r.randint(60, len(s))]
            parts += [s, text(r.randint(0, 20))]
        out.append(" ".join(parts))
    return out


@pytest.mark.parametrize("chunk,hot", [(4 << 20, {}), (3000, {}), (1000, {"hot_chunks": 2, "hot_strings": 3}), (1000, {"hot_chunks": 0})])
def test_brute(spark, chunk, hot):
    texts = passages(3)
    texts += [texts[0], texts[1], None, "", "short", "a" * 99, "a" * 100, "a" * 400, "ab" * 300, texts[5] * 3, "é" * 80, "z" * 30_000]
    pairs = list(enumerate(texts))
    random.Random(1).shuffle(pairs)
    got = sd.remove_repeats(docs(spark, pairs).repartition(5), chunk=chunk, **hot)
    from pyspark.sql import functions as F

    rows = got.select("doc_id", "n_bytes", "removed", "kept", "kept_sha256").collect()
    assert sorted((str(x.doc_id), x.n_bytes, sum(b - a for a, b in x.removed), len(x.removed), x.kept_sha256) for x in rows) == brute(pairs)
    assert all(hashlib.sha256(bytes(x.kept)).hexdigest() == x.kept_sha256 for x in rows)


def test_repeated_and_null_ids(spark):
    t = passages(9)
    pairs = [(1, t[0]), (1, t[0]), (None, t[0]), (None, None), (2, t[1]), (0, t[1] + " " + t[0])]
    got = sd.remove_repeats(docs(spark, pairs).coalesce(1)).collect()
    assert sorted((str(x.doc_id), x.n_bytes, sum(b - a for a, b in x.removed), len(x.removed), x.kept_sha256) for x in got) == brute(pairs)


def test_empty(spark):
    assert sd.remove_repeats(docs(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_deep_shallow_orders(seed):
    r = random.Random(seed)
    base = bytes(r.choice(b"ab") for _ in range(60))
    strings = [base[: r.randint(0, 60)] + bytes(r.choice(b"abc") for _ in range(r.randint(0, 30))) for _ in range(r.randint(1, 80))]
    order, lcp = sd.deep_shallow(strings, r.choice([0, 8, 32]))
    assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
    for k in range(1, len(order)):
        assert lcp[k] == sd.common_prefix(strings[order[k - 1]], strings[order[k]])
    trie = sd.BlindTrie(strings)
    for i in range(len(strings)):
        trie.insert(i)
    assert [strings[i] for i, _ in trie.ordered()] == sorted(strings)

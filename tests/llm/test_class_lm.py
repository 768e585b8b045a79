"""The class model against plain Python, and its probabilities as a distribution."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from strandlake.llm import class_lm as lm


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in pairs], "doc_id long, text string, word string, n int, held_out string")


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def texts(seed, n):
    r = random.Random(seed)
    nouns, verbs = [f"noun{k}" for k in range(40)], [f"go{k}es" for k in range(30)]
    return [" ".join(w for _ in range(r.randint(1, 25)) for w in (r.choice(["The", "a"]), r.choice(nouns), r.choice(verbs))) for _ in range(n)]


@pytest.mark.parametrize("lookup,floor,seeds", [(1 << 18, 2, 512), (10, 8, 4), (0, 1, 1)])
def test_base_scores_brute(spark, lookup, floor, seeds):
    pairs = [*enumerate(texts(1, 120)), (120, None), (121, ""), (None, "the noun1"), (5, "again É the"), (5, "again É the"), (122, "zz " * 3000), (123, "long" * 400 + " the"), (124, ("long" * 400 + " ") * 900)]
    got = lm.score_documents(docs(spark, pairs), lookup_words=lookup, floor=floor, seeds=seeds).collect()
    counts = Counter(w for i, t in pairs if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for i, t in pairs)
    assert sorted((str(x.doc_id), x.held_out, x.n_tokens, x.n_known, round(x.base_score, 6)) for x in got) == want
    assert {x.train_tokens for x in got} == {n}
    assert all(x.score < 0 for x in got)


def plain_scores(pairs, model, least):
    """Scores from a class map alone: every count is made anew, token by token."""
    number = lm.Words(model.hashes)
    spelled = {}

    def kind(word):
        i = int(number([word])[0])
        return int(model.word_class[i] if i < lm.BEYOND else model.spell_class[i - lm.BEYOND])

    train = [t for i, t in pairs if not held(i)]
    words, follows, before = Counter(w for t in train for w in tokens(t)), Counter(), Counter()
    for t in train:
        line = [b"\n", *tokens(t)]
        for a, b in zip(line, line[1:]):
            follows[kind(a), kind(b)] += 1
            before[kind(a)] += 1
    k = len(model.log_room)
    n, types = [0] * k, [0] * k
    for w, c in words.items():
        n[kind(w)] += c
        types[kind(w)] += 1
    share = [(n[c] + 0.1 * (types[c] + 1)) / (sum(n) + 0.1 * (sum(types) + k)) for c in range(k)]
    room = [n[c] + 0.1 * (types[c] + (c > 0)) if c else n[0] + 0.1 for c in range(k)]
    out = []
    for i, t in pairs:
        line, total = [b"\n", *tokens(t)], 0.0
        for a, b in zip(line, line[1:]):
            x, y = kind(a), kind(b)
            total += math.log10((follows[x, y] + lm.PULL * share[y]) / (before[x] + lm.PULL)) + math.log10((words[b] + 0.1) / room[y])
        out.append((str(i), round(total, 6)))
    return sorted(out)


@pytest.mark.parametrize("lookup,floor,seeds", [(1 << 18, 2, 20), (40, 3, 10)])
def test_scores_brute(spark, lookup, floor, seeds):
    pairs = [*enumerate(texts(5, 150)), (150, None), (151, "odd words here"), (None, "the noun1")]
    df = lm.text_bytes(docs(spark, pairs), "doc_id", "text")
    train = df.where("doc_id is null or crc32(cast(doc_id as string)) % 10 <> 0")
    counts = lm.word_counts(train).cache()
    model, least = lm.train_model(counts, train, classes=6, lookup_words=lookup, floor=floor, seeds=seeds)
    got = lm.score_documents(docs(spark, pairs), classes=6, lookup_words=lookup, floor=floor, seeds=seeds).collect()
    assert sorted((str(x.doc_id), round(x.score, 6)) for x in got) == plain_scores(pairs, model, least)


def test_contexts_are_those_of_the_text(spark):
    pairs = [*enumerate(texts(6, 90))]
    df = lm.text_bytes(docs(spark, pairs), "doc_id", "text").repartition(5)
    words = lm.listed_words(lm.word_counts(df), floor=3)
    codes = lm.encoded(df, words).cache()
    own = len(words.hashes)
    units = own + lm.SPELL_UNITS
    home = np.arange(units) % 5 + 1
    home[0] = 0
    number = lm.Words(words.hashes)
    want, joint = np.zeros((units, 13), np.int64), np.zeros((6, 6), np.int64)
    for _, t in pairs:
        ids = [int(i) if i < lm.BEYOND else int(i - lm.BEYOND + own) for i in number([b"\n", *tokens(t)])]
        for a, b in zip(ids, ids[1:]):
            want[b, home[a]] += 1
            want[a, 6 + home[b]] += 1
            want[b, 12] += a == b
            joint[home[a], home[b]] += 1
    fan, lm.FAN = lm.FAN, 2  # sums over a tree
    try:
        sums = lm.summed_contexts(lm.class_contexts(codes, home, 6), 6).cache()
        rows = {r.block: r for r in sums.collect()}
    finally:
        lm.FAN = fan
    assert (lm.joint_of(sums, 6) == joint).all()
    got = np.zeros(lm.UNIT_BLOCK * 13, np.int64)
    got[np.cumsum(lm._unpacked(bytes(rows[0].cells), np.uint32).astype(np.int64))] = lm._unpacked(bytes(rows[0].n), np.uint64)
    assert (got.reshape(-1, 13)[:units] == want).all()


def test_best_classes_raise_the_likelihood_most():
    r = np.random.default_rng(5)
    n = r.integers(0, 4, (30, 30))
    home = np.concatenate([[0], r.integers(1, 5, 29)])

    def value(home):
        m = np.eye(5)[home]
        return lm.likelihood(m.T @ n @ m)

    m = np.eye(5)[home]
    u = np.arange(1, 30)
    got = lm.best_classes((n.T @ m)[u], (n @ m)[u], n[u, u].astype(float), home[u], m.T @ n @ m)
    for i, b in zip(u, got):
        tried = [value(np.where(np.arange(30) == i, c, home)) for c in range(1, 5)]
        assert tried[b - 1] == pytest.approx(max(tried))


def test_model_is_a_distribution_and_beats_the_unigrams(spark):
    pairs = [*enumerate(texts(2, 400))]
    df = lm.text_bytes(docs(spark, pairs), "doc_id", "text")
    counts = lm.word_counts(df).cache()
    model, least = lm.train_model(counts, df, classes=6, floor=3, seeds=20)
    assert least == 2 and np.allclose((10**model.log_step).sum(1), 1)
    emission = (model.known + 0.1) / 10 ** model.log_room[model.word_class]
    for c in range(1, 6):
        unknown = 0.1 / 10 ** model.log_room[c]
        assert emission[model.word_class == c].sum() + unknown == pytest.approx(1)
    got = [x for x in lm.score_documents(docs(spark, pairs), classes=6, seeds=80).collect() if x.held_out]
    assert got and sum(x.score for x in got) > sum(x.base_score for x in got) + 10


def test_rounds_cluster_words_beyond_the_seeds(spark):
    """Few seeds, then rounds over all words: better on held-out texts than endings alone."""
    r = random.Random(7)
    kinds = [[f"{r.randint(10**5, 10**6)}{i}" for i in range(60)] for _ in range(4)]
    pairs = [(i, " ".join(r.choice(kinds[k % 4]) for k in range(r.randint(8, 40)))) for i in range(500)]
    score = lambda rounds: sum(x.score for x in lm.score_documents(docs(spark, pairs), classes=8, seeds=20, floor=4, rounds=rounds).collect() if x.held_out)
    assert score(2) > score(0) + 50


def test_exchange_raises_the_likelihood():
    r = np.random.default_rng(1)
    n = r.integers(0, 3, (31, 31))
    n[1:11, 11:21] += 40
    n[11:21, 21:31] += 40

    def value(home, k):
        m = np.eye(k)[home]
        j = m.T @ n @ m
        return lm._xlogx(j).sum() - lm._xlogx(j.sum(0)).sum() - lm._xlogx(j.sum(1)).sum()

    home = lm.exchange(n, 0, 4)
    start = np.array([0] + [1 + i % 3 for i in range(30)])
    assert value(home, 4) > value(start, 4)
    assert len({tuple(sorted(set(home[a : a + 10]))) for a in (1, 11, 21)}) == 3 and all(len(set(home[a : a + 10])) == 1 for a in (1, 11, 21))


def test_empty_and_untrained(spark):
    assert lm.score_documents(docs(spark, [])).collect() == []
    only = next(i for i in range(100) if held(i))
    x = lm.score_documents(docs(spark, [(only, "a b")])).first()
    assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (True, 3, 0, 0) and math.isfinite(x.score)

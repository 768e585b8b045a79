"""Repeated word passages against brute force."""

import hashlib
import random

import pytest

from strandlake.llm import word_windows as ww


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, 1, "x", b"y", 2) for i, t in pairs], "doc_id long, text string, file int, at string, body binary, anchor int")


def brute(pairs, window):
    """n_words, removed runs and kept words of each document."""
    words = [[w for w in (t or "").translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w] for _, t in pairs]
    ids = [(1 << 62) if i is None else i for i, _ in pairs]
    first = {}
    for i, w in zip(ids, words, strict=True):
        for p in range(len(w) - window + 1):
            s = tuple(w[p : p + window])
            first[s] = min(first.get(s, i), i)
    out = []
    for (i, _), own, w in zip(pairs, ids, words, strict=True):
        gone = bytearray(len(w))
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < own:
                gone[p : p + window] = b"\1" * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((str(i), len(w), sum(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def passages(seed, n=60):
    r = random.Random(seed)
    word = lambda: r.choice(["the", "of", "é", "anker", "x\x00", "lorem", "q\x1cua", "zz "]) + r.choice(["", "", "ing", str(r.randint(0, 99))])
    text = lambda k: r.choice([" ", "\n", "\t \x0b", " "]).join(word() for _ in range(k))
    shared = [[word() for _ in range(k)] for k in (12, 20, 25, 60, 200)]
    out = []
    for _ in range(n):
        parts = [text(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, len(s) // 2)
            parts += [" ".join(s[a : a + r.randint(10, len(s))]), text(r.randint(0, 20))]
        out.append("  ".join(parts))
    return out


def check(spark, pairs, window, gram, **more):
    got = ww.remove_passages(docs(spark, pairs).repartition(4), window=window, gram=gram, **more)
    rows = [(str(x.doc_id), x.n_words, sum(r["to"] - r["from"] for r in x.removed), x.kept, x.kept_sha256) for x in got.collect()]
    assert sorted(rows) == brute(pairs, window)


@pytest.mark.parametrize("more", [{}, {"shard_words": 400}, {"hot_spans": 2, "shard_words": 500}, {"hot_spans": 0}, {"limit": 3, "hot_spans": 5}])
def test_brute(spark, more):
    texts = passages(3)
    texts += [texts[0], texts[1], None, "", "short", "w " * 12, "w " * 13, "w " * 60, "a b " * 40, texts[5] * 3, " \n ", "z " * 500]
    pairs = list(enumerate(texts)) + [(7, texts[20]), (7, texts[20]), (None, texts[21]), (None, texts[21]), (None, None), (-4, texts[30])]
    random.Random(1).shuffle(pairs)
    check(spark, pairs, 12, 4, **more)


def test_edges_of_a_common_passage(spark):
    r = random.Random(5)
    common = " ".join(f"c{i}" for i in range(70))
    fresh = lambda k: " ".join(f"w{r.randint(0, 10**6)}" for _ in range(k))
    pairs = [(i, f"{fresh(30)} {common} {fresh(30)}") for i in range(40)] + [(i + 100, fresh(120)) for i in range(20)]
    check(spark, pairs, 50, 8, hot_spans=6)


def test_lists_by_shuffle_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(ww, "LISTED", 3)
    monkeypatch.setattr(ww, "PIECE", 37)
    pairs = list(enumerate(passages(9, 30)))
    check(spark, pairs, 12, 4, hot_spans=4)


def test_windows_that_begin_in_any_part_of_a_long_text():
    import numpy as np

    r = np.random.default_rng(1)
    own = r.integers(0, 1 << 63, 1500, dtype=np.uint64)
    hashes = np.concatenate([own, own[:700], own])
    begins = np.array([0, 1500, 2200, 3700])
    doc, start, count, anchor, k1, k2 = ww.spans_of(hashes, begins, 50, 8)
    assert [int(count[doc == d].sum()) for d in range(3)] == [1451, 651, 1451]
    assert anchor[doc == 0].tolist() == anchor[doc == 2].tolist() and k1[doc == 0].tolist() == k1[doc == 2].tolist() and k2[doc == 0].tolist() == k2[doc == 2].tolist()
    assert len(set(k1.tolist())) <= (doc == 0).sum() + 1


def test_hot_windows_are_few_rows(spark, monkeypatch):
    """Many near copies of one text: their windows do not become a row each, and results stay."""
    made, stash = {}, ww.stash

    def counted(df, name):
        out = stash(df, name)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(ww, "stash", counted)
    r = random.Random(8)
    base = [f"b{i}" for i in range(160)]
    pairs = []
    for i in range(60):
        own = list(base)
        for at in (r.randint(0, 59), r.randint(100, 159)):
            own[at] = f"x{i}"
        pairs.append((i, " ".join(own)))
    check(spark, pairs, 50, 8, hot_spans=20)
    windows = 60 * 111
    assert len(made["window-hot"]) > 1 and sum(made["window-hot"]) > 0
    assert sum(sum(n) for name, n in made.items() if name in ("window-again", "window-singles")) < windows / 4


def test_longer_grams_anchor_equal_windows_alike():
    import numpy as np

    grams = [8]
    while grams[-1] < 50:
        grams.append(ww.longer_gram(grams[-1], 50))
    assert grams == [8, 41, 49, 50]
    r = np.random.default_rng(2)
    own = r.integers(0, 1 << 63, 80, dtype=np.uint64)
    other = np.concatenate([r.integers(0, 1 << 63, 30, dtype=np.uint64), own[10:70], r.integers(0, 1 << 63, 30, dtype=np.uint64)])
    wanted = np.ones(200, bool)
    wanted[[14, 115]] = False
    for gram in grams:
        doc, start, count, anchor, _, _ = ww.spans_of(np.concatenate([own, other]), np.array([0, 80, 200]), 50, gram, wanted)
        at = {(d, s + i): a for d, s, n, a in zip(doc.tolist(), start.tolist(), count.tolist(), anchor.tolist()) for i in range(n)}
        assert len(at) == 31 + 71 - 2 and (0, 14) not in at and (1, 35) not in at
        assert all(at[0, p] == at[1, p + 20] for p in range(10, 21) if p not in (14, 15))


def test_none(spark):
    assert ww.remove_passages(docs(spark, [])).collect() == []
    rows = ww.remove_passages(docs(spark, [(1, None), (2, ""), (3, "a b")])).collect()
    assert sorted((r.doc_id, r.n_words, r.kept) for r in rows) == [(1, 0, ""), (2, 0, ""), (3, 2, "a b")]

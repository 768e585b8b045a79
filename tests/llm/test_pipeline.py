"""Stages of the pipeline, and groups of similar texts, against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from strandlake.llm import decontamination as dc
from strandlake.llm import near_duplicates as nd
from strandlake.llm import similar_texts as st


def docs(spark, pairs, extra="x"):
    return spark.createDataFrame([(i, t, "en", extra, None) for i, t in pairs], "doc_id long, text string, lang string, source string, n_chars long")


def shingles(text, words=5):
    t = (text or "").encode().lower().split()
    return {b" ".join(t[i : i + words]) for i in range(max(1, len(t) - words + 1))} if t else set()


def groups(pairs, similarity=0.8):
    """Components of pairs with enough similarity; texts without words are one group."""
    sets = [shingles(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            both, every = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if not every or both >= similarity * every:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(pairs))]


def corpus(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 4)))
    texts = [" ".join(word() for _ in range(r.randint(30, 300))) for _ in range(n)]
    for t in texts[: n // 3]:
        for edits in (1, 2, 8):
            w = t.split()
            for _ in range(edits):
                w[r.randrange(len(w))] = word()
            texts.append(" ".join(w))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("bucket,dense", [(4096, 8), (40, 8), (4096, 0)])
def test_one_of_each_group(spark, bucket, dense):
    pairs = [*enumerate(corpus(3, 60))]
    pairs += [(500, pairs[4][1]), (501, pairs[4][1].upper()), (502, None), (503, ""), (None, pairs[7][1]), (3, pairs[3][1]), (3, pairs[3][1])]
    got = sorted(str(x.doc_id) for x in st.one_of_each_group(docs(spark, pairs), bucket=bucket, dense=dense).collect())
    least = {}
    for (i, _), g in zip(pairs, groups(pairs)):
        least[g] = min(least.get(g, (True, 0)), (i is None, i or 0))
    assert got == sorted(str(i) for none, i in least.values())


def test_many_near_copies_stay_one(spark):
    r = random.Random(8)
    base = [f"w{r.randint(0, 999)}" for _ in range(220)]
    pairs = []
    for i in range(300):
        w = list(base)
        w[r.randrange(len(w))] = f"new{i}"
        pairs.append((i, " ".join(w)))
    assert [x.doc_id for x in st.one_of_each_group(docs(spark, pairs)).collect()] == [0]


@pytest.mark.parametrize("bucket,open_bytes", [(4096, st.OPEN_BYTES), (90, 20_000)])
def test_dense_items_decide_every_candidate(spark, bucket, open_bytes):
    """Copies and their children whose pairs scatter round the similarity: as if every candidate were verified."""
    r = random.Random(4)
    base, texts = [f"w{r.randint(0, 9999)}" for _ in range(100)], []
    for i in range(100):
        w = list(base)
        w[r.randrange(100)] = f"new{i}"
        texts.append(w)
    for i in range(100):
        w = list(texts[i])
        for k in range(2):
            w[r.randrange(100)] = f"newer{i}x{k}"
        texts.append(w)
    r.shuffle(texts)
    rows = docs(spark, [(i, " ".join(w)) for i, w in enumerate(texts)])
    stay = lambda **kw: sorted(x.doc_id for x in st.one_of_each_group(rows, **kw).collect())
    assert stay(bucket=bucket, open_bytes=open_bytes) == stay(dense=10**6)


def test_repeated_lines_do_not_hide_copies(spark):
    """Copies with one line appended ten times: the shingle sets stay nearly the same."""
    r = random.Random(6)
    pairs = []
    for i in range(0, 80, 2):
        word = lambda: f"w{r.randint(0, 9999)}"
        text = " ".join(word() for _ in range(900))
        pairs += [(i, text), (i + 1, text + (" " + " ".join(word() for _ in range(10))) * 10)]
    assert sorted(x.doc_id for x in st.one_of_each_group(docs(spark, pairs)).collect()) == list(range(0, 80, 2))


def test_empty(spark):
    assert st.one_of_each_group(docs(spark, [])).collect() == []


def words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))


def hits(text, items):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        size = min(13, len(b))
        windows = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)} if b else set()
        for i in range(len(w) - size + 1) if size else ():
            if tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add("" if item is None else str(item))
    longest = 0
    for _, body in items if hit else ():
        b = words(body)
        for i in hit:
            for j in range(len(b)):
                n = 0
                while i + n in hit and j + n < len(b) and w[i + n] == b[j + n]:
                    n += 1
                longest = max(longest, n)
    runs = [(i, next(k for k in range(i, len(w) + 1) if k not in hit)) for i in sorted(hit) if i - 1 not in hit]
    return len(w), len(hit), ",".join(sorted(found)), longest, runs


@pytest.mark.parametrize("block_words,shard_words", [(4_000_000, 2_000_000), (30, 2_000_000), (4_000_000, 100)])
def test_decontamination_brute(spark, block_words, shard_words):
    r = random.Random(5)
    word = lambda: r.choice(["The", "of", "é", "x1", "naïve", "b", "qq", "Zz", "42"])
    items = [(i, ", ".join(word() for _ in range(r.choice([0, 1, 4, 12, 13, 14, 40])))) for i in range(30)] + [(None, "x1 x1 x1 b"), (3, None), (100, "The of the OF the of the of")]
    if block_words > 100:  # without the shortest items the filter of stretches is at work
        items = [(i, t) for i, t in items if len(words(t)) != 1]
    texts = [None, "", "-- ..", *(" ".join(word() for _ in range(r.randint(0, 80))) for _ in range(60))]
    texts += [" ".join([*(word() for _ in range(30)), body or "", *(word() for _ in range(30))]) for _, body in items]
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc string")
    pairs = list(enumerate(texts))
    got = dc.judged(dc.find_contamination(docs(spark, pairs), bench, block_words=block_words, shard_words=shard_words)).collect()
    want = {i: hits(t, items) for i, t in pairs}
    assert {x.doc_id: (x.n_words, x.n_hit, ",".join(x.items), [tuple(y) for y in x.runs]) for x in got} == {i: (n, h, f, runs) for i, (n, h, f, _, runs) in want.items()}
    if block_words > 100:  # a match may go through words that only other blocks hit
        assert {x.doc_id: x.longest for x in got} == {i: x[3] for i, x in want.items()}
    assert all(x.contaminated == (x.n_hit > 0 and 20 * x.n_hit >= x.n_words) for x in got)
    clean = dc.clean(docs(spark, pairs), bench, block_words=block_words).collect()
    assert sorted(x.doc_id for x in clean) == sorted(i for i, (n, h, *_) in want.items() if not (h > 0 and 20 * h >= n))


def test_long_items_in_little_memory():
    """An item of 200,000 words (random, and one word over and over) found in documents that hold it."""
    import tracemalloc

    r = random.Random(3)
    item = " ".join(f"w{r.randint(0, 50_000)}" for _ in range(200_000)).encode()
    same = b"again " * 200_000
    tracemalloc.start()
    bench = dc.Benchmark([("a", item), ("b", same)])
    found = dc.search([b"clean words here " * 50, item, b"x " + b" ".join(item.split()[500:900]) + b" y", b"again " * 30_000], bench)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(x.words, x.runs, x.items, x.longest) for x in found] == [(150, [], [], 0), (200_000, [(0, 200_000)], ["a"], 200_000), (402, [(1, 401)], ["a"], 400), (30_000, [(0, 30_000)], ["b"], 30_000)]
    assert peak < 500 << 20


def test_windows_of_many_items_in_many_documents(spark, monkeypatch):
    """Sets of items are kept once, so items times documents rows are never made; results go out in parts."""
    import random
    import tracemalloc

    shared = [" ".join(f"w{chr(97 + i)}{chr(97 + k)}" for i in range(13)) for k in range(4)]
    r = random.Random(1)
    items = [(f"i{k}", " ".join(r.sample(shared, r.randint(0, 3)) + [f"x{chr(97 + k % 26)}"])) for k in range(60)]
    bodies = [" ".join(r.sample(shared, r.randint(0, 4))) for _ in range(80)]
    found = dc.search([b.encode() for b in bodies], dc.Benchmark([(n, t.encode()) for n, t in items], 13))
    windows = lambda t: {tuple(w[i : i + 13]) for w in [t.split()] for i in range(len(w) - 12)} if len(t.split()) >= 13 else {tuple(t.split())} if t else set()
    for body, one in zip(bodies, found, strict=True):
        text = body.split()
        inside = lambda own, text=text: any(tuple(text[i : i + len(own)]) == own for i in range(len(text) - len(own) + 1))
        assert one.items == sorted(n for n, t in items if any(inside(w) for w in windows(t)))
    bench = dc.Benchmark([(f"i{k}", shared[0].encode()) for k in range(3000)], 13)
    tracemalloc.start()
    assert len(dc.search([shared[0].encode()] * 3000, bench)[2999].items) == 3000
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    monkeypatch.setattr(dc, "BATCH_NAMES", 7)
    rows = dc.find_contamination(docs(spark, list(enumerate(bodies))), spark.createDataFrame(items, "item_id string, text string")).collect()
    assert sorted((x.doc_id, x.items) for x in rows) == [(i, f.items) for i, f in enumerate(found)]


def test_decontamination_empty(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_contamination(docs(spark, []), bench).collect() == []
    assert [x.n_words for x in dc.find_contamination(docs(spark, [(1, "a b")]), bench).collect()] == [2]


def test_longest_match_is_the_longest():
    bench = dc.Benchmark([("1", b"a b c d e f g h i j k l m n o p q"), ("2", b"z z z")])
    one, other = dc.search([b"x a b c d e f g h i j k l m n o x", b"z z z z"], bench)
    assert (one.runs, one.items, one.longest) == ([(1, 16)], ["1"], 15) and (other.items, other.longest) == (["2"], 3)


def test_stages_in_turn(spark, tmp_path):
    """Each stage keeps the columns, decides as its operator does, and the last one places all that is left."""
    base = corpus(11, 40)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    pairs = [*enumerate(base), (900, item + " " + " ".join(base[0].split()[:40])), (901, "too short"), (902, None)]
    (tmp_path / "sf").mkdir()
    path = f"file://{tmp_path}/sf"
    docs(spark, pairs).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, path)
        if name != "sharding":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(f"{path}/{len(seen)}")
        now = spark.read.parquet(f"{path}/{len(seen)}")
        seen.append({x.doc_id for x in now.collect()})
    assert seen[0] == {i for i, t in pairs} - {901, 902}
    left = [(i, t) for i, t in pairs if i in seen[0]]
    least = {}
    for (i, _), g in zip(left, groups(left)):
        least[g] = min(least.get(g, i), i)
    assert seen[1] == set(least.values())
    assert seen[2] == seen[1] - {900} and seen[3] <= seen[2] and seen[4] == seen[3]
    assert {x.doc_id for x in corpus_pipeline.run(spark, path).collect()} == seen[4]


def test_work_item_pairs_agree_with_all_pairs():
    r = np.random.default_rng(2)
    own, other = r.integers(0, 1 << 63, 30, dtype=np.uint64), r.integers(0, 1 << 63, 20, dtype=np.uint64)
    other[:5] = own[:5] ^ np.uint64(3)
    a, b = st.item_pairs(np.arange(30), own, np.arange(30, 50), other, True, 20, 100)
    every = np.concatenate([own, other])
    want = {(i, j) for i in range(30) for j in range(i + 1, 50) if int(every[i] ^ every[j]).bit_count() <= 20}
    assert set(zip(a.tolist(), b.tolist())) == want
    assert nd.ball(4, 2).tolist() == [1, 2, 4, 8, 3, 5, 9, 6, 10, 12]


def test_stages_take_nulls_repeats_and_empty_tables(spark, tmp_path):
    """Every stage alone, on rows with nulls in any column, and on no rows."""
    path = f"file://{tmp_path}"
    long = " ".join(f"w{i % 700}x{i}" for i in range(9000))
    good = "one two three four five six seven eight nine ten eleven"
    rows = [(1, good, "en", "a", 5), (1, good, "en", "a", 5), (None, good + " more", None, None, None), (2, None, "en", None, None), (3, "", None, "a", 0), (4, long, "fr", "b", 9), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, 1, 0), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(None, None), (1, "alpha beta")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    want = {"quality rules": 4, "simhash near-dedup": 3, "benchmark decontamination": 7, "sharding": 7}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, spark.createDataFrame(rows, schema), path).collect()
        assert len(got) == want.get(name, len(got)), name
        assert stage(spark, spark.createDataFrame([], schema), path).collect() == [], name

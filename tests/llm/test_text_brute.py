"""Text operators against plain Python on small fixtures."""

import math
import random
import re

import pytest

from strandlake.llm import quality_rules as qr


def docs(spark, pairs):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, l, "x", "c", 1) for i, t, l in pairs], "doc_id long, text string, lang string, stratum string, body string, n_words int")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def features(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [None, "", " \n\t ", "a b c d e a b c d e", "a a a a a a a a", "x\nx\n\nx \nx\n \n", "one two\x0bthree\x0cfour\rfive", "é#$ b|c <d>\nq\nq", "w " * 5000, "same line\n" * 50, "WOW!! SO!! MUCH!! a b c d e f g h", "a\x1cb\x85c d"]


def test_features_brute(spark):
    r = random.Random(4)
    texts = TEXTS + [" ".join(r.choice("abc") for _ in range(r.randint(0, 40))) for _ in range(60)]
    got = qr.text_features(docs(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()
    assert {x.doc_id: (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in got} == {i: features(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 100, 0.05), (40, 1000, 0.05), (900, 20_000, 0.05), (5, 5, 0.999), (0, 1, 0.5)])
def test_binomial_tail(spark, k, n, p):
    from pyspark.sql import functions as F

    got = spark.range(1).select(qr.binomial_lower_tail(F.lit(k), F.lit(n), p).alias("p")).first().p
    want = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
    assert got == pytest.approx(want, rel=1e-9)


def cuts_brute(rows, good, risk, level, rules):
    """rows: (id, stratum, scores) of documents that pass the base rule."""
    strata = {}
    for i, s, scores in rows:
        if i in good:
            strata.setdefault(s, []).append(scores)
    tail = lambda k, n, p: sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    out = {}
    for s, held in strata.items():
        best = 0
        for i in range(len(rules["symbol_share"])):
            k = sum(any(x[rule] > cuts[i] for rule, cuts in rules.items()) for x in held)
            if tail(k, len(held), risk) > level / len(strata):
                break
            best = i + 1
        out |= {(s, rule): cuts[best - 1] if best else None for rule, cuts in rules.items()}
    return out


def test_thresholds_brute(spark):
    r = random.Random(7)
    pairs = []
    for i in range(900):
        words = [r.choice(["aa", "bb", "cc", "dd", "ee"]) + str(r.randint(0, 10**6)) for _ in range(20)]
        for k in range(r.choice([0, 0, 1, 3, 19])):
            words[k] += r.choice(["$", "!!", "?!", "..."])
        pairs.append((i, " ".join(words), r.choice(["en", "en", "en", None])))
    rows = [(i, int(r.random() < 0.8), 0) for i in range(850)] + [(None, 1, 0), (3, None, 0), (5, 0, 0), (5, 1, 0)]
    risk, level = 0.2, 0.1
    feats = qr.text_features(docs(spark, pairs))
    cuts = {x.stratum: x for x in qr.calibrate(feats, labels(spark, rows), risk, level).collect()}
    good = {i for i, q, _ in rows if i is not None and q == 1}
    want = cuts_brute([(x.doc_id, x.stratum, {k: x[k] for k in qr.RULES}) for x in feats.collect()], good, risk, level, qr.RULES)
    assert any(v is not None for v in want.values())
    assert {(s, k): cuts[s][f"{k}_cut"] for s in cuts for k in qr.RULES} == want
    out = qr.judge(docs(spark, pairs), labels(spark, rows), risk, level).collect()
    for x in out:
        assert x.kept == (not x.base_failed and not any(want[x.stratum, k] is not None and x[k] > want[x.stratum, k] for k in qr.RULES))


def test_quality_empty_tables(spark):
    assert qr.judge(docs(spark, []), labels(spark, [])).collect() == []
    got = qr.judge(docs(spark, [(1, "a b c d e f g h i j k", "en"), (None, None, None)]), labels(spark, [])).collect()
    assert sorted((x.kept for x in got)) == [False, True]

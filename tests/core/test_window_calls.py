"""K-mers of windows against a plain version; only those that the index holds become rows."""

import random

import pytest

from strandlake.operators import chimera, kmers


def plain(reads, groups, k, width, step, least):
    codes = lambda s: {c for i in range(len(s) - k + 1) for c in kmers.canonical_codes(s[i : i + k].encode(), k).tolist()}
    owned = {key: codes(s) for _, key, s in groups}
    count = {}
    for own in owned.values():
        for c in own:
            count[c] = count.get(c, 0) + 1
    out = []
    for uid, library, s in reads:
        for w, at in enumerate(range(0, max(len(s or "") - width, 0) + 1, step)):
            held = codes((s or "")[at : at + width]) if library else set()
            scores = [(-sum(1 / count[c] for c in held & own), key) for key, own in owned.items() if held & own]
            best = min(scores, default=(0, ""))
            out.append((str(uid), w, best[1].split("|")[0] if -best[0] >= least - 1e-9 else None))
    return sorted(out, key=str)


@pytest.fixture
def given(spark):
    r = random.Random(4)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    parts = [dna(120) for _ in range(4)]
    groups = [("lib", f"ref{i}", dna(20) + p + dna(20)) for i, p in enumerate(parts)] + [("lib", "ref8|ref9", parts[0][30:90] + parts[1][:60])]
    reads = [(f"r{i}", "lib", dna(r.randint(0, 300)) + r.choice(parts)[r.randint(0, 60) :] + "N" * (i % 3) + dna(r.randint(0, 90)) + r.choice(parts)[: r.randint(10, 120)]) for i in range(40)]
    reads += [("null", "lib", None), ("empty", "lib", ""), ("short", "lib", parts[2][:30]), ("edge", "lib", parts[2][:90]), ("other", None, parts[2]), (None, "lib", parts[3] + dna(80)), ("odd", "lib", "é" * 50 + parts[1] + "ü" + parts[0])]
    frame = lambda rows, of: spark.createDataFrame(rows, of)
    return reads, groups, frame(reads, "read_uid string, library_id string, insert string").repartition(3), frame(groups, "library_id string, alias_key string, sequence string")


@pytest.mark.parametrize("width, step, limit", [(90, 45, None), (40, 60, None), (10, 7, None), (33, 10, 5)])
def test_calls(spark, given, monkeypatch, width, step, limit):
    reads, groups, inserts, owners = given
    if limit:
        monkeypatch.setattr(kmers, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(kmers, "PIECE", 700)
    got = chimera.window_calls(inserts, owners, 15, width, step)
    assert got.schema.simpleString() == "struct<read_uid:string,window:int,name:string>"
    assert sorted(((str(x.read_uid), x.window, x.name) for x in got.collect()), key=str) == plain(reads, groups, 15, width, step, 1.0)


def test_a_read_twice_has_its_windows_twice(spark, given):
    _, _, inserts, owners = given
    once = chimera.window_calls(inserts, owners, 15).where("read_uid = 'r3'").count()
    assert chimera.window_calls(inserts.unionAll(inserts), owners, 15).where("read_uid = 'r3'").count() == 2 * once


def test_rows_are_those_of_the_index(spark, given):
    _, _, inserts, owners = given
    index = kmers.build_index(owners, 15)
    reads = inserts.withColumnRenamed("insert", "query")
    rows = kmers.kmer_rows(reads, "query", 15, ["read_uid", "library_id"], index, 90, 45)
    assert rows.count() == rows.join(index.select("kmer").distinct(), "kmer").count() > 0
    unlike = reads.limit(0).unionAll(spark.createDataFrame([(str(i), "lib", "AC" * 2000) for i in range(5)], reads.schema))
    assert kmers.kmer_rows(unlike, "query", 15, ["read_uid", "library_id"], index, 90, 45).count() == 0
    assert kmers.kmer_rows(reads, "query", 15, ["read_uid"], index.limit(0)).count() == 0

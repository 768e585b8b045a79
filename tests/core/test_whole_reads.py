"""Queries without SQL, on small tables, against plain versions over whole sequences."""

import random

import pytest

from strandlake.operators import clustering
from strandlake.operators.alignment import reverse_complement
from strandlake.plans import views
from strandlake.plans.catalogue import QUERIES

WORD = "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents that are benchmark items joined, worn and reversed, beyond 1,000 letters too."""
    folder = str(tmp_path_factory.mktemp("whole"))
    r = random.Random(17)
    text = lambda n: "".join(r.choice(WORD) for _ in range(n))
    items = [(i, text(r.choice([150, 240, 400]))) for i in range(10)]

    def worn(s):
        return "".join(r.choice(WORD) if r.random() < 0.03 else c for c in s)

    docs = [(i, worn(items[i % 10][1]) + " " + worn(items[(i + 1) % 10][1])) for i in range(20)]
    docs += [(20 + i, worn(items[i][1])) for i in range(8)] + [(28, text(1500)), (29, "ab"), (30, "")]
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def reads(spark, tables):
    return {x.doc_id: x for x in views.reads(spark, tables).collect()}


@pytest.fixture(scope="module")
def refs(spark, tables):
    return {x.ref_id: x for x in views.refs(spark, tables).collect()}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_split_grades(spark, tables, reads, refs):
    got = QUERIES["split_grades"](spark, tables).collect()
    assert len(got) == sum(f"Block_{i % 40 % 5}_{i % 40}" in refs for i in reads)
    for x in got:
        q, r = reads[x.doc_id].sequence, refs[f"Block_{x.doc_id % 40 % 5}_{x.doc_id % 40}"].sequence
        if not q:
            assert (x.insert_grade, x.vector_status) == ("low_depth", "not_evaluable")
            continue
        assert x.insert_edits + x.vector_edit_distance == distance(q, r)
        assert x.insert_sequence in q and x.insert_query_length == len(x.insert_sequence) and x.insert_length == 50
        assert (x.insert_grade == "perfect") == (x.insert_edits == 0) and (x.vector_status == "perfect") == (x.vector_edit_distance == 0)


def kmers(seq, k):
    return {min(seq[i : i + k], reverse_complement(seq[i : i + k])) for i in range(len(seq) - k + 1)}


def test_chimera_windows(spark, tables, reads, refs):
    by_sequence = {}
    for x in refs.values():
        by_sequence.setdefault(x.sequence, []).append(x.ref_id)
    owned = {"|".join(sorted(ids)): kmers(s, 15) for s, ids in by_sequence.items()}
    count = {}
    for own in owned.values():
        for k in own:
            count[k] = count.get(k, 0) + 1
    want = {}
    for i, x in reads.items():
        if len(x.sequence) < 90:
            continue
        names = []
        for at in range(0, max(len(x.sequence) - 90, 0) + 1, 45):
            held = kmers(x.sequence[at : at + 90], 15)
            scores = [(-sum(1 / count[k] for k in held & own), key) for key, own in owned.items() if held & own]
            best = min(scores, default=(0, ""))
            names.append(best[1].split("|")[0] if -best[0] >= 1 - 1e-9 else None)
        called = [n for n in names if n]
        want[str(i)] = (len(names), ">".join(n for k, n in enumerate(called) if not k or n != called[k - 1]))
    got = {x.read_uid: (x.windows, x.signature) for x in QUERIES["chimera_windows"](spark, tables).collect()}
    assert got == want and any(">" in s for _, s in want.values())


def test_fragment_assembly(spark, tables, reads):
    def bodies(oligo):
        lefts = [i for i in range(len(oligo)) if oligo.startswith("GGTCTC", i)]
        rights = [i for i in range(len(oligo)) if oligo.startswith("GAGACC", i)]
        return [oligo[i + 7 : j - 1] for i in lefts for j in rights if j - 1 - (i + 7) >= 8]

    want = {}
    for i, x in reads.items():
        if len(x.sequence) >= 60:
            gene = "AATT" + x.sequence + "CCGG"
            half = len(gene) // 2 + 2
            first, second = (bodies("GGTCTCA" + s + "TGAGACC") for s in (gene[:half], gene[half - 4 :]))
            want[str(i)] = any(a[-4:] == b[:4] and (a + b[4:])[4:-4] == x.sequence for a in first for b in second)
    got = {x.gene_id: x.assembled for x in QUERIES["fragment_assembly"](spark, tables).collect()}
    assert got == want and all(want.values())


def test_cluster_reads_takes_whole_reads(spark, tables, reads):
    wells = {}
    for i, x in reads.items():
        if x.sequence:
            wells.setdefault(f"{x.plate_id}:{x.well_id}:{len(x.sequence) % 11}", []).append((str(i), x.sequence))
    want = {}
    for well, own in wells.items():
        own.sort()
        found, places, _ = clustering.cluster([n for n, _ in own], [s for _, s in own])
        want |= {(well, n): (c, len(places)) for (n, _), c in zip(own, found)}
    got = {(x.well_id, x.read_uid): (x.cluster, x.n_places) for x in QUERIES["cluster_reads"](spark, tables).collect()}
    assert got == want


def test_assembly_errors(spark, tables, refs):
    own = {int(n.rsplit("_", 1)[1]): x.sequence for n, x in refs.items()}
    halves = {i: (s[: len(s) // 2], s[len(s) // 2 :]) for i, s in own.items()}
    parts = {}
    for i, (a, b) in halves.items():
        parts[f"r{i}", 0] = a
        parts.setdefault((f"r{i + 1}" if i % 3 == 0 else f"r{i}", 1), b)
    got = {x.uid: x for x in QUERIES["assembly_errors"](spark, tables).collect()}
    assert set(got) == {uid for uid, _ in parts}
    for x in got.values():
        assert x.found == sum(uid == x.uid for uid, _ in parts)
        assert x.outcome in ("intact", "chimeric", "missing", "unresolved")
    assert {x.outcome for x in got.values()} >= {"intact", "missing"}


def test_large_wells_are_clustered_as_small_ones(spark, monkeypatch):
    """Wells beyond the limit of one task: two clones, one clone, a null well, empty reads, a read too worn to tell."""
    r = random.Random(5)
    base = "".join(r.choice("ACGT") for _ in range(120))
    other = "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i % 11 == 3 else c for i, c in enumerate(base))
    worn = lambda s: "".join(c for c in s if r.random() > 0.02)
    rows = [("two", f"r{i:03d}", worn(base if i % 3 else other)) for i in range(60)]
    rows += [("one", f"s{i:03d}", worn(base)) for i in range(30)] + [(None, f"t{i:03d}", worn(other if i % 2 else base)) for i in range(40)]
    rows += [("two", "x", ""), ("two", "y", base[:40]), ("two", "z", base[:40]), ("few", "u", base), ("blank", "v", None), ("blank", "w", "")]
    rows += [("void", f"e{i:02d}", "") for i in range(20)]
    reads = spark.createDataFrame(rows, "well_id string, read_uid string, sequence string")
    told = lambda: sorted(map(str, clustering.cluster_reads(reads).collect()))
    expected = told()
    assert len(expected) == len(rows) and any("2 clusters" in x for x in expected)
    monkeypatch.setattr(clustering, "WELL_LIMIT", 10)
    assert told() == expected

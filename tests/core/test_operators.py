"""Operators on small tables: policies, ties, nulls and empty inputs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandlake.functions import dna, protein, reads as rd, statistics as st
from strandlake.operators import alignment as al
from strandlake.operators import assign, chimera, clustering, comparisons, consensus, demux, flanks, fragments, kmers, motifs, pooling, qc


def rand(r, n, symbols="ACGT"):
    return "".join(r.choice(symbols) for _ in range(n))


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def table(a, b, free):
    d = [[0 if free and i == 0 else i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (not dna.MASK[a[i - 1]] & dna.MASK[b[j - 1]]))
    return d


@pytest.mark.parametrize("seed", range(60))
def test_kernel_against_the_table(seed):
    r = random.Random(seed)
    a, b = rand(r, r.randint(1, 30), "ACGTN"), rand(r, r.randint(1, 45), "ACGT")
    assert al.global_distance(a, b, True) == table(a, b, False)[-1][-1]
    last = table(a, b, True)[-1]
    distance, ends = al.infix_distance(a, b)
    assert distance == min(last)
    if distance < len(a):
        assert ends == [j - 1 for j in range(1, len(last)) if last[j] == distance]
    best, end = al.Lanes([a, a[:1]]).best([b, ""])
    assert best[0, 0] == distance and end[1, 0] == -1
    plain = a.replace("N", "A")
    path = al.global_path(plain, b)
    assert sum(n for op, n in path if op != "=") == table(plain, b, False)[-1][-1]
    assert len(al.projected(plain, b)) == len(b)


def test_path_puts_gaps_to_the_left():
    assert al.global_path("ACGGT", "ACGGGT") == [("=", 2), ("D", 1), ("=", 3)]
    assert al.global_path("", "AC") == [("D", 2)] and al.global_path("AC", "") == [("I", 2)]


def test_sequence_columns(spark):
    got = one(spark, n=dna.normalize(F.lit(" acg u\n")), rc=dna.reverse_complement(F.lit("ACGTRY")), k=dna.kmers(F.lit("ACGTNACGTT"), 4), short=dna.kmers(F.lit("AC"), 4), gc=dna.gc_percent(F.lit("GGCA")), run=dna.longest_run(F.lit("AACCCA")), at=dna.run_at(F.lit("AACCCA"), F.lit(3)), t=dna.trim_both(F.lit("ACGTAC"), 2), occ=dna.occurrences(F.lit("AAAA"), "AA"), ex=dna.excisions(F.lit("GGTCTCAAAAATTTTCGAGACC")), circ=dna.circular_region(F.lit("TTTGGGAAACCC"), "ACCC", "GGG"))
    assert (got.n, got.rc, sorted(got.k), got.short, got.gc, got.run, got.at, got.t, got.occ) == ("ACGT", "RYACGT", ["AACG", "ACGT"], [], 75.0, 3, 3, "GT", [0, 1, 2])
    assert got.ex == ["AAAATTTT"] and got.circ == "TTT"
    assert one(spark, x=protein.translate(F.lit("ATGNNNTAAG"))).x == "MX*"
    assert one(spark, x=protein.first_internal_stop(F.lit("M*A*"))).x == 1 and one(spark, x=protein.first_internal_stop(F.lit("MA*"))).x is None
    with pytest.raises(Exception, match="not a nucleotide"):
        one(spark, x=dna.normalize(F.lit("AXC!")))


def test_names_and_medians(spark):
    got = one(spark, q=rd.mean_quality(F.lit("I!")), empty=rd.mean_quality(F.lit("")), well=rd.normalized_well(F.lit("a1")), odd=rd.normalized_well(F.lit("x")), block=rd.block_of(F.lit("Block_12_x")), none=rd.block_of(F.lit("y")), med=st.upper_median(F.array(*map(F.lit, (4, 1, 3, 2)))), safe=rd.safe_name(F.lit("a/b" * 40)), d=rd.duration(F.lit(3725)))
    assert (got.q, got.empty, got.well, got.odd, got.block, got.none, got.med, got.d) == (20.0, 0.0, "A01", "X", "12", None, 3, "1h 02m 05s")
    assert len(got.safe) == 56 and got.safe[-9] == "~"


@pytest.mark.parametrize("k,n,p", [(0, 5, 0.1), (6, 5, 0.1), (3, 40, 0.01), (30, 40, 0.2), (12, 300, 0.02), (5, 10, 0.0), (5, 10, 1.0)])
def test_binomial_tail(spark, k, n, p):
    want = 1.0 if k <= 0 else 0.0 if k > n else sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))
    assert one(spark, x=st.binomial_upper_tail(F.lit(k), F.lit(n), F.lit(p))).x == pytest.approx(want, rel=1e-9, abs=1e-300)


PANEL = [("P1", "AAAACCCCGG"), ("P2", "TTGGCAGTAC")]


def call(read, **settings):
    return demux.Caller(PANEL, demux.CallSettings(**{"window": 30, "max_edits": 2, **settings})).calls([read])[0]


def test_barcode_policies():
    body = "GATTACAGATTACAGATTACAGATTACAGATTACAGATTACA"
    assert (call(PANEL[0][1] + body).id, call(PANEL[0][1] + body).orientation) == ("P1", "forward")
    assert call(al.reverse_complement(PANEL[0][1]) + body).orientation == "reverse"
    assert call(body + al.reverse_complement(PANEL[0][1])).orientation == "forward"
    assert call(body).status == "unassigned" and call("").status == "unassigned"
    assert call(PANEL[0][1] + body + al.reverse_complement(PANEL[1][1])).status == "conflicting"
    assert call(PANEL[0][1] + PANEL[1][1] + body, ends=("head",)).status == "ambiguous"
    for policy in ("legacy_unique_threshold", "legacy_unique_best"):
        assert call(PANEL[0][1] + PANEL[1][1] + body, policy=policy).status == "ambiguous"
        assert (call(PANEL[0][1] + body, policy=policy).status, call(PANEL[0][1] + body, policy=policy).orientation) == ("assigned", "reverse")
    with pytest.raises(ValueError):
        demux.CallSettings(policy="best")


def test_gates_and_nulls(spark):
    rows = [("a", "", ""), ("b", "ACGT", "IIII"), ("c", PANEL[0][1] + "ACGT" * 10, "!" * 50), ("d", "AC.T" * 10, "I" * 40), ("e", PANEL[0][1] + "ACGT" * 10, "I" * 50)]
    reads = spark.createDataFrame(rows, "read_uid string, sequence string, quality string")
    got = {r.read_uid: r.call_status for r in demux.demultiplex(reads, PANEL, None, demux.CallSettings(window=30, max_edits=1), demux.CallSettings(), demux.Gates(10, 100, 10)).collect()}
    assert got == {"a": "empty_read", "b": "out_of_length", "c": "low_quality", "d": "invalid_sequence", "e": "assigned"}
    none = demux.demultiplex(reads.where("false"), PANEL, PANEL, demux.CallSettings(), demux.CallSettings(), demux.Gates())
    assert none.collect() == []


def test_motif_pairs():
    pair = motifs.MotifPair("GATTACA", "CCGGAAT", 1, True, 0, None, 10)
    got = pair.extract("TT" + "GATTACA" + "A" * 10 + "CCGGAAT" + "TT")
    assert (got["status"], got["insert"], got["orientation"], got["edits"]) == ("found", "A" * 10, "forward", 0)
    assert pair.extract(al.reverse_complement("GATTACA" + "ACGTACGTAA" + "CCGGAAT"))["orientation"] == "reverse"
    assert pair.extract("ACGT")["status"] == "motif_missing"
    assert pair.extract("GATTACA" + "C" * 9 + "CCGGAAT" + "T" * 9 + "GATTACA" + "A" * 9 + "CCGGAAT")["status"] == "ambiguous"


def test_kmer_index_and_cascade(spark):
    r = random.Random(1)
    refs = [(f"Block_1_r{i}", rand(r, 300)) for i in range(20)]
    refs.append(("Block_2_copy", refs[0][1]))
    frame = spark.createDataFrame([("lib", n, s) for n, s in refs], "library_id string, ref_id string, sequence string")
    groups = kmers.alias_groups(frame)
    assert groups.where(F.size("ref_ids") == 2).first().alias_key == "Block_1_r0|Block_2_copy"

    def noisy(s, rate):
        return "".join(c if r.random() > rate else r.choice(["", r.choice("ACGT"), c + r.choice("ACGT")]) for c in s)

    reads = [(f"q{i}", "lib", noisy(refs[i][1], 0.08)) for i in range(12)] + [("junk", "lib", rand(r, 300)), ("none", "other", refs[3][1])]
    queries = spark.createDataFrame(reads, "read_uid string, library_id string, query string")
    settings = assign.AssignSettings(kmer_sizes=(15, 11, 9))
    got = {x.read_uid: x for x in assign.assign_reads(queries, groups, settings).collect()}
    assert all(got[f"q{i}"].alias_key == refs[i][0] for i in range(1, 12)) and got["q0"].assignment_status == "assigned_alias_set"
    assert got["junk"].assignment_status == got["none"].assignment_status == "no_match"
    every = {x.read_uid: x.alias_key for x in assign.assign_reads(queries.repartition(7), groups, assign.AssignSettings(kmer_sizes=(15, 11, 9), rescue="all")).collect() if x.assignment_status != "no_match"}
    assert every == {k: v.alias_key for k, v in got.items() if v.assignment_status != "no_match"}
    with pytest.raises(ValueError):
        assign.AssignSettings(kmer_sizes=(9, 11))


@pytest.mark.parametrize("margin,spare", [(6, 16), (0, 0), (-3, 0)])
def test_first_reads_of_large_groups(spark, monkeypatch, margin, spare):
    import hashlib

    monkeypatch.setattr(consensus, "MARGIN", margin)
    monkeypatch.setattr(consensus, "SPARE", spare)
    rows = [("big", f"r{i}") for i in range(3000)] + [("mid", f"r{i}") for i in range(60)] + [("one", "r1")]
    reads = spark.createDataFrame([(g, u, "ACGT") for g, u in rows], "group_id string, read_uid string, sequence string")
    got = sorted((r.group_id, r.selection_rank, r.read_uid) for r in consensus.select_reads(reads, 30, 7).collect())
    name = lambda g, u: hashlib.sha256(f"7\0{g}\0{u}".encode()).hexdigest()
    want = []
    for group in ("big", "mid", "one"):
        own = sorted((u for g, u in rows if g == group), key=lambda u: name(group, u))[:30]
        want += [(group, k + 1, u) for k, u in enumerate(own)]
    assert got == sorted(want)


def test_routing(spark):
    reads = spark.createDataFrame([("a", "P1"), ("b", "P9"), ("c", None)], "read_uid string, plate_id string")
    routes = spark.createDataFrame([("P1", "lib")], "plate_id string, library_id string")
    assert {x.read_uid: x.routing for x in assign.route_plates(reads, routes, ["lib"]).collect()} == {"a": "routed", "b": "unmapped_reference_library", "c": "unmapped_reference_library"}
    assert {x.library_id for x in assign.route_plates(reads, routes.where("false"), ["only"]).collect()} == {"only"}


def built(spark, sequences, reference, quality=None, **settings):
    rows = [("g", f"r{i:03d}", reference, s, None if quality is None else chr(33 + quality) * len(s)) for i, s in enumerate(sequences)]
    frame = spark.createDataFrame(rows, "group_id string, read_uid string, reference string, sequence string, quality string")
    return consensus.build_consensus(frame, consensus.ConsensusSettings(**settings)).first()


def test_consensus_calls(spark):
    ref = "ACGTTGCAAGCTTGCATCGATCGGATTACA"
    assert built(spark, [ref] * 3, ref).sequence == ref
    assert built(spark, [ref] * 2, ref).status == "low_depth"
    changed = ref[:10] + "A" + ref[11:]
    assert built(spark, [changed] * 8, ref).sequence == changed
    split = built(spark, [ref] * 6 + [changed] * 6, ref)
    assert (split.status, split.sequence[10], split.mixed_alleles[0].alleles, split.mixed_positions) == ("mixed_variants", "N", "AC", 1)
    assert built(spark, [ref[:10] + ref[11:]] * 5, ref).sequence == ref[:10] + ref[11:]
    assert built(spark, [ref[:10] + "TT" + ref[10:]] * 9, ref).sequence == ref[:10] + "TT" + ref[10:]
    noise = [ref[:i] + "N" + ref[i + 1 :] for i in range(5)]
    assert built(spark, [ref] * 10 + noise, ref).status == "consensus_pass"
    assert built(spark, [ref] * 4, ref, quality=5).ambiguous_bases == len(ref)
    assert built(spark, [changed] * 4 + [ref], ref, caller="majority").sequence == changed
    assert built(spark, [ref] * 40, ref, max_reads=7).n_reads_used == 7
    with pytest.raises(Exception, match="occurs twice"):
        consensus.select_reads(spark.createDataFrame([("g", "a"), ("g", "a")], "group_id string, read_uid string"), 0).collect()


def test_quality_states_and_grades(spark):
    frame = spark.createDataFrame([("ATGAAATAA", "ATGAAATAA"), ("ATGAATAA", "ATGAAATAA"), ("ATGTAAAAATAA", "ATGTAAAAATAA")], "sequence string, reference string")
    got = [(x.edit_distance, x.reading_frame, x.internal_stops, x.overall) for x in qc.evaluate(frame, qc.QcSettings(), "", "").collect()]
    assert got == [(0, "pass", "pass", "pass"), (1, "fail", "not_evaluable", "fail"), (0, "pass", "fail", "fail")]
    assert qc.evaluate(frame, qc.QcSettings()).first().reading_frame == "not_evaluable"
    assert qc.region_edits("ACTT", "ACGTT", [("a", 0, 2), ("b", 2, 5)]) == {"a": 0, "b": 1}
    assert qc.region_edits("ACGTTA", "ACGTT", [("a", 0, 2), ("b", 2, 5)]) == {"a": 0, "b": 1}
    split = qc.split_states("AAAAGGGGCCCGTTTT", "AAAAGGGGCCCCTTTT", [("flank_5p", 0, 4), ("insert", 4, 12), ("flank_3p", 12, 16)])
    assert (split["insert_edits"], split["vector_edit_distance"], split["insert_sequence"]) == (1, 0, "GGGGCCCG")
    mixed = one(spark, m=qc.parse_mixed(F.lit("3:G>GT:0.4,0.6|5:C>AC")), none=qc.parse_mixed(F.lit(None).cast("string")))
    assert [tuple(x) for x in mixed.m] == [(3, "G", "GT", [0.4, 0.6]), (5, "C", "AC", [])] and mixed.none == []


def test_signatures_and_groups(spark):
    rows = [(f"r{i}", w, n) for i in range(6) for w, n in enumerate(["Block_1_a", "Block_1_a", None, "Block_1_b"])]
    rows += [("u", w, "Block_1_a") for w in range(3)] + [("n", 0, None)] + [("lone", 0, "Block_1_a"), ("lone", 1, "Block_2_c")]
    s = chimera.signatures(spark.createDataFrame(rows, "read_uid string, window int, name string"))
    g = chimera.group_chimeras(s, [], 6).collect()
    assert [(x.signature, x.size, x.junction_window, x.origin) for x in g] == [(["Block_1_a", "Block_1_b"], 6, 3, "assembly")]
    counts = {x.outcome: x["count"] for x in chimera.outcomes(s, chimera.group_chimeras(s, [], 6), []).collect()}
    assert counts == {"unmatched": 1, "uniform": 1, "chimeric_read": 7, "in_group": 6, "below_depth": 1, "group_assembly": 1}
    refs = spark.createDataFrame([("Block_1_a", "A" * 300), ("Block_1_b", "C" * 300)], "ref_id string, sequence string")
    made = chimera.scaffolds(chimera.group_chimeras(s, [], 6), refs).first().scaffold
    assert made == "A" * 135 + "C" * 165


def test_windows_always_give_one(spark):
    frame = spark.createDataFrame([("a", "A" * 200), ("b", "A" * 10), ("c", "")], "read_uid string, insert string")
    assert {x.read_uid: x["count"] for x in chimera.windows(frame).groupBy("read_uid").count().collect()} == {"a": 3, "b": 1, "c": 1}


def test_deconvolution(spark):
    pools = spark.createDataFrame([("P", "c1"), ("P", "c2")], "plate_id string, culture_plate string")
    blocks = spark.createDataFrame([("l", "1", "c1"), ("l", "2", "c1"), ("l", "2", "c2"), ("l", "3", "c9")], "library_id string, block string, culture_plate string")
    reads = spark.createDataFrame([("a", "P", "l", "1"), ("b", "P", "l", "2"), ("c", "P", "l", "3"), ("d", "P", "l", None), ("e", "Q", "l", "1"), ("f", "P", "l", "7")], "uid string, plate_id string, library_id string, block string")
    got = {x.uid: (x.culture_plate_status, x.culture_plate) for x in pooling.deconvolve(reads, pools, blocks).collect()}
    assert got == {"a": ("resolved", "c1"), "b": ("ambiguous", None), "c": ("unexpected_block", None), "d": ("unknown_block", None), "e": ("unknown_pcr_plate", None), "f": ("unknown_block", None)}


def test_fragments():
    gene = "ATGAAACCCGGGTTTACGTACGATCGATTACA"
    full = "AATT" + gene + "CCGG"
    wrap = lambda b: "TTGGTCTCA" + b + "TGAGACCAA"
    pieces = fragments.assemble([wrap(full[:20]), wrap(full[16:])], gene)
    assert [(p.slot, p.start, p.end) for p in pieces] == [(0, -4, 16), (1, 12, 36)]
    assert fragments.assemble([wrap(full[:20]), wrap(full[20:])], gene) is None
    assert fragments.assemble(["ACGT"], gene) is None


def test_clusters_split_two_clones_and_keep_one():
    r = random.Random(5)
    base = rand(r, 200)
    other = "".join(c if i % 12 else {"A": "C", "C": "G", "G": "T", "T": "A"}[c] for i, c in enumerate(base))

    def noisy(s):
        return "".join(c if r.random() > 0.03 else r.choice("ACGT") for c in s)

    reads = [noisy(base) for _ in range(12)] + [noisy(other) for _ in range(9)]
    found, places, _ = clustering.cluster([f"r{i:02d}" for i in range(21)], reads)
    assert len(places) >= 10 and len({*found[:12]}) == 1 and len({*found[12:]}) == 1 and found[0] != found[20]
    alone, _, why = clustering.cluster([f"r{i:02d}" for i in range(12)], reads[:12])
    assert set(alone) == {0} and "variant" in why
    assert clustering.cluster(["a"], ["ACGT"])[0] == [None]


def test_flanks():
    r = random.Random(2)
    left, right, inserts = rand(r, 80), rand(r, 90), [rand(r, 50) for _ in range(4)]
    shared = flanks.from_references([left + i + right for i in inserts])
    assert shared.upstream.startswith(left) and shared.downstream.endswith(right)
    assert shared.transform(left + inserts[0] + right) == (left + inserts[0] + right)[20:-20]
    told, insert = flanks.from_template(al.reverse_complement(left + inserts[2] + right), inserts)
    assert (told.upstream, told.downstream, insert) == (left, right, inserts[2])
    made = told.transform(inserts[1])
    assert made[slice(*told.insert_span(len(made)))] == inserts[1]
    with pytest.raises(ValueError):
        told.transform(made)
    with pytest.raises(ValueError):
        flanks.from_references([left, left])


def test_replicates_and_apportionment(spark):
    side = "well string, identity string, sequence string"
    a = spark.createDataFrame([("1", "x", "AC"), ("2", "x", "AC"), ("3", "x", "AC"), ("4", "x", "AC")], side)
    b = spark.createDataFrame([("1", "x", "AC"), ("2", "x", "AG"), ("3", "y", "AC"), ("5", "z", None)], side)
    got = {x.well: x.category for x in comparisons.compare_wells(a, b, ["well"]).collect()}
    assert got == {"1": "matched_exact", "2": "matched_different_sequence", "3": "different_design", "4": "dedicated_only", "5": "pool_only"}
    clones = spark.createDataFrame([("c", 1, f"w{i}") for i in range(2)] + [("c", 2, f"v{i}") for i in range(4)] + [("c", 3, "u")], "culture_plate string, block int, well_id string")
    assert {x.block: x.wells for x in comparisons.allocated_wells(clones, 10).collect()} == {1: 3, 2: 6, 3: 1}
    assert comparisons.concordance(comparisons.compare_wells(a.where("false"), b.where("false"), ["well"])).first().matched_fraction is None


def test_streamed_calls_equal_batch_calls(spark, tmp_path):
    from strandlake.streaming.reads import demultiplexed_stream, read_stream

    rows = [(i, PANEL[i % 2][1] + "ACGT" * 12, "I" * 58) for i in range(20)]
    reads = spark.createDataFrame(rows, "read_uid long, sequence string, quality string")
    reads.repartition(4).write.parquet(str(tmp_path / "in"))
    s = demux.CallSettings(window=30, max_edits=1)
    stream = demultiplexed_stream(read_stream(spark, str(tmp_path / "in"), "read_uid long, sequence string, quality string", 1), PANEL, s, demux.Gates())
    q = stream.select("read_uid", "call_status", "plate.id").writeStream.format("memory").queryName("calls").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    batch = demux.demultiplex(reads, PANEL, None, s, s, demux.Gates()).select("read_uid", "call_status", "plate.id")
    assert sorted(map(tuple, spark.table("calls").collect())) == sorted(map(tuple, batch.collect()))


def test_event_windows_close_with_the_watermark(spark, tmp_path):
    from strandlake.streaming.reads import arrivals, read_stream

    rows = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id as int)) as ts, 'a' as event_type, 1.0d as value from range(60)")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    q = arrivals(read_stream(spark, str(tmp_path / "in"), "ts timestamp, event_type string, value double")).writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.n for r in spark.table("windows").orderBy("window_start").collect()] == [5] * 12


@pytest.mark.parametrize("seed", range(40))
def test_first_location_is_the_first_of_all(seed):
    r = random.Random(seed)
    a, b = rand(r, r.randint(1, 12), "AC"), rand(r, r.randint(1, 40), "ACG")
    distance, spans = al.infix_locations(a, b)
    first = al.first_location(a, b)
    assert (first[0], first[1:]) == (distance, spans[0]) if spans else True

"""A full-length run in which every grade occurs, reruns, streams, and operators around them."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from strandlake.operators import alignment as al
from strandlake.operators import assign, comparisons, demux, flanks, fragments, qc
from strandlake.plans import amplicon, cli
from strandlake.plans.config import ConfigError, parse_config
from strandlake.plans.stages import StageError
from strandlake.sources import exports, fastq, shared

R = random.Random(21)
STOPS = ("TAA", "TAG", "TGA")
CODONS = [a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT" if a + b + c not in STOPS]


def bases(n):
    return "".join(R.choice("ACGT") for _ in range(n))


START, END = "ATGGCTAGCAAAGGAGAAGAACTT", "GGTTCTGGTAGCCATCACCATTAA"
UP, DOWN = bases(20) + bases(16) + START, END + bases(16) + bases(20)
PLATE = "AACCGGTTACAC"
WELLS = {f"A{i}": bases(14) for i in range(1, 12)}
INSERTS = ["".join(R.choice(CODONS) for _ in range(100)) for _ in range(11)]


def changed(seq, at, base):
    return seq[:at] + base + seq[at + 1 :]


def spot(seq, want, start=90):
    """An in-frame place whose codon stays without a stop when its base changes."""
    return next(i for i in range(start, len(seq), 3) if seq[i] == want)


def clones():
    """well -> (expected grade, its reads' inserts)."""
    i = INSERTS
    g, a = spot(i[2], "G"), spot(i[3], "A")
    many = list(i[7])
    for k in range(0, 300, 15):
        many[k + 0] = "C" if many[k] != "C" else "G"
    stop = i[5][:150] + "TAA" + i[5][153:]
    return {
        "A1": ("perfect", [i[0]] * 4),
        "A2": ("screenable", [changed(i[1], spot(i[1], "A"), "C")] * 4),
        "A3": ("mixed_damage", [i[2]] * 6 + [changed(i[2], g, "T")] * 6),
        "A4": ("mixed_variants", [i[3]] * 6 + [changed(i[3], a, "C")] * 6),
        "A5": ("frameshift", [i[4][:100] + i[4][101:]] * 4),
        "A6": ("premature_stop", [stop] * 4),
        "A7": ("truncated", [i[6][:120] + i[6][132:]] * 4),
        "A8": ("mismatched", ["".join(many)] * 4),
        "A9": ("low_depth", [i[8]] * 2),
    }


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("full")
    reads = [(w, x) for w, (_, own) in clones().items() for x in own]
    reads += [("A10", INSERTS[9][:180] + INSERTS[10][180:])] * 4  # two fifths of another design
    text = "".join(f"@r{k} x\n{PLATE + WELLS[w] + UP + x + DOWN}\n+\n{'I' * (len(PLATE) + 14 + len(UP) + len(x) + len(DOWN))}\n" for k, (w, x) in enumerate(reads))
    (folder / "reads.fastq").write_text(text)
    (folder / "refs.fasta").write_text("".join(f">Block_1_d{k}\n{x}\n" for k, x in enumerate(INSERTS)))
    return folder


def config(files, **more):
    call = {"window": 24, "max_edits": 1, "min_margin": 2, "ends": ["head"], "both_strands": False}
    return parse_config({
        "schema_version": 1, "run_name": "full", "inputs": [{"path": str(files / "reads.fastq"), "sample_id": "s"}], "libraries": {"lib": str(files / "refs.fasta")},
        "plates": {"P1": PLATE}, "wells": WELLS, "plate_call": call, "well_call": {**call, "window": 40}, "gates": {"min_length": 300, "max_length": 800, "min_quality": 10},
        "flanks": {"lib": {"upstream": UP, "downstream": DOWN, "insert_thresholds": True}},
        "assign": {"kmer_sizes": [15], "max_kmer_owners": 2, "candidates": 3, "min_identity": 0.82, "min_query_coverage": 0.8, "min_reference_coverage": 0.8},
        "qc": {"upstream_constant": START, "downstream_constant": END, "insert_left_boundary": START[-12:], "insert_right_boundary": END[:12]}, "export": True, **more,
    }, environment={})


@pytest.fixture(scope="module")
def run(spark, files):
    return amplicon.run(spark, config(files), str(files / "run"))


def test_every_grade_occurs(run):
    want = {w: g for w, (g, _) in clones().items()}
    got = {r.well_id: r for r in run["graded"].collect()}
    assert {w: r.grade for w, r in got.items()} == want and set(want.values()) == set(qc.GRADES)
    assert got["A6"].internal_stop_codon == 8 + 50 and got["A1"].protein_length == 8 + 100 + 7
    left = len(UP) - 20
    assert [(x.name, x.edits, x.length) for x in got["A2"].regions] == [("flank_5p", 0, left), ("insert", 1, 300), ("flank_3p", 0, len(DOWN) - 20)]
    assert (got["A3"].mixed_signature, got["A3"].mixed_in_reading_frame) == ("oxidative", 1) and "insert" in got["A3"].mixed_detail
    assert got["A4"].mixed_signature == "mixed" and 0.4 < got["A3"].designed_allele_fraction < 0.6
    split = {w: (r.insert_grade, r.vector_status) for w, r in got.items()}
    assert split["A1"] == ("perfect", "perfect") and split["A2"] == ("screenable", "perfect") and split["A5"][0] == "frameshift" and split["A6"][0] == "premature_stop"
    assert split["A7"][0] == "truncated" and split["A8"][0] == "mismatched" and split["A3"][0] == "mixed_variants" and split["A9"] == ("low_depth", "not_evaluable")


def test_insert_floors_hold_foreign_inserts_back(run):
    status = {(r.well_id, r.assignment_status) for r in run["assignment"].select("well_id", "assignment_status").distinct().collect()}
    assert ("A10", "insert_mismatch") in status and ("A1", "assigned_unique") in status
    far = run["assignment"].where("assignment_status = 'insert_mismatch'").first()
    assert far.identity >= 0.82 > far.insert_identity


def test_export_and_report(spark, run, files):
    summary = json.loads((files / "run/export/summary.json").read_text())
    assert summary["clones"] == 9 and summary["files"] == 8 and summary["grades"]["perfect"] == 1
    heads = spark.read.text(str(files / "run/export/fasta/plate=P1/source=all/well=A01")).where("value like '>%'").collect()
    assert len(heads) == 1 and "grade=perfect" in heads[0].value and "insert_grade=perfect" in heads[0].value
    index = {r.well_id: r for r in spark.read.option("header", True).csv(str(files / "run/export/index")).collect()}
    assert index["A9"].file is None and index["A1"].file == "plate=P1/source=all/well=A01"
    assert "Clones" in (files / "run/report.html").read_text()
    again = exports.write_graded(run["graded"], str(files / "run/export"))  # an export is replaced
    assert again["clones"] == 9
    (files / "other").mkdir()
    with pytest.raises(exports.ExportError):
        exports.write_graded(run["graded"], str(files / "other"))


def test_rerun_inherits_what_did_not_change(spark, run, files):
    strict = config(files, qc={"length_tolerance": 20, "upstream_constant": START, "downstream_constant": END})
    reads = files / "reads.fastq"
    digests = amplicon.digests_of(spark, [str(reads)])
    out = amplicon.run(spark, strict, str(files / "again"), str(files / "run"), "graded", digests)
    assert {r.well_id: r.grade for r in out["graded"].collect()}["A7"] == "mismatched"
    assert not (files / "again/consensus").exists() and (files / "again/graded").exists()
    with pytest.raises(StageError, match="cannot be inherited"):
        amplicon.run(spark, config(files, gates={"min_length": 1}), str(files / "third"), str(files / "run"), "graded")
    with pytest.raises(StageError, match="no stage"):
        amplicon.run(spark, strict, str(files / "fourth"), str(files / "run"), "nothing")


def test_changed_inputs_are_not_taken_for_the_same(spark, run, files, tmp_path):
    for name in ("reads.fastq", "refs.fasta"):
        (tmp_path / name).write_bytes((files / name).read_bytes())
    amplicon.run(spark, config(tmp_path, demux_only=True), str(tmp_path / "run"))
    amplicon.run(spark, config(tmp_path, demux_only=True), str(tmp_path / "run"))
    (tmp_path / "reads.fastq").write_text((files / "reads.fastq").read_text().replace("I\n", "H\n", 1))
    with pytest.raises(StageError, match="other inputs"):
        amplicon.run(spark, config(tmp_path, demux_only=True), str(tmp_path / "run"))


def test_configuration_of_flanks(files):
    with pytest.raises(ConfigError):
        config(files, flanks={"none": {"derive": True}})
    with pytest.raises(ConfigError):
        config(files, flanks={"lib": {"derive": True, "template": "x"}})
    with pytest.raises(ConfigError):
        config(files, qc={"upstream_constant": "ATG"})
    with pytest.raises(ConfigError, match="full-length"):
        config(files, preset="nothing")
    assert config(files, preset="full-length").consensus.min_depth == 5


def test_command_line_tools(files, tmp_path, capsys):
    assert cli.main(["subsample", str(files / "reads.fastq"), str(tmp_path / "few.fq.gz"), "--reads", "5"]) == 0
    assert gzip.open(tmp_path / "few.fq.gz", "rt").read().count("\n") == 20
    assert cli.main(["subsample", str(files / "reads.fastq"), str(tmp_path / "few.fq.gz"), "--reads", "5"]) == 2
    assert cli.main(["subsample", str(files / "reads.fastq"), str(tmp_path / "any.fq"), "--reads", "6", "--anywhere", "3"]) == 0
    assert len(list(fastq.parse((tmp_path / "any.fq").read_bytes(), "x"))) == 6
    assert cli.main(["init", str(tmp_path / "new")]) == 0 and "preset" in (tmp_path / "new/config.yaml").read_text()
    assert cli.main(["init", str(tmp_path / "new")]) == 2 and "error:" in capsys.readouterr().err


@pytest.mark.parametrize("size", [90, 700, 10**6])
def test_lines_of_splits_make_the_same_records(spark, tmp_path, size):
    r = random.Random(3)
    text = "".join(f"@read_{i} of {i % 7}\r\n{s}\r\n+\r\n{'F' * len(s)}\r\n" for i, s in enumerate("".join(r.choice("ACGTN") for _ in range(r.randint(1, 60))) for _ in range(60)))
    (tmp_path / "a b.fastq").write_bytes(text.encode())
    (tmp_path / "c.fastq.gz").write_bytes(gzip.compress(text[:400].rsplit("@", 1)[0].encode()))
    (tmp_path / "d.bin").write_bytes(gzip.compress(text[:400].rsplit("@", 1)[0].encode()))
    (tmp_path / "empty.fastq").write_bytes(b"")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = sorted(tuple(x) for x in fastq.fastq_files(spark, str(tmp_path), "s").collect())
        (tmp_path / "bad.fastq").write_text(text + "@cut\nAC\n")
        with pytest.raises(Exception, match="cut off"):
            fastq.fastq_files(spark, str(tmp_path / "bad.fastq"), "s").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [row for name in ("a b.fastq", "c.fastq.gz", "d.bin") for row in fastq.parse((tmp_path / name).read_bytes(), "x", "s")]
    assert got == sorted(want)


def test_misnamed_gzip_is_refused(spark, tmp_path):
    (tmp_path / "x.gz").write_bytes(b"@a\nAC\n+\nII\n")
    with pytest.raises(fastq.FastqError, match="not compressed"):
        fastq.fastq_files(spark, str(tmp_path / "x.gz"))


def test_metrics_by_definition(spark):
    rows = [("ACGTACGTAA", "ACGT"), ("ACGT", "ACGTACGTAA"), ("", "ACGT"), ("ACGT", ""), (None, "ACGT")]
    got = qc.evaluate(spark.createDataFrame(rows, "sequence string, reference string"), qc.QcSettings(), "", "").collect()
    assert [(x.edit_distance, x.query_coverage, x.reference_coverage) for x in got] == [(6, 0.4, 1.0), (6, 1.0, 0.4), (-1, 0.0, 0.0), (-1, 0.0, 0.0), (None, None, None)]
    assert got[4].full_amplicon == "not_evaluable" and got[2].reading_frame == "not_evaluable"


def test_empty_sides_match_nothing():
    for q, r in (("", "ACGT"), ("ACGT", ""), ("", "")):
        told = al.place(q, r)
        assert told["identity"] == told["query_coverage"] == told["reference_coverage"] == 0.0 and told["edit_distance"] == len(q) + len(r)


def test_unsafe_pairs_by_shared_bases(spark):
    panel = spark.createDataFrame([("a", "ACGTNN"), ("b", "ACGTAC"), ("c", "TTTTTT")], "barcode_id string, sequence string")
    assert [(x.a, x.b, x.distance) for x in demux.unsafe_pairs(panel, 0, 1, False).collect()] == [("a", "b", 0)]


def test_split_states_against_the_path():
    r = random.Random(8)
    for _ in range(60):
        ref = "".join(r.choice("ACGT") for _ in range(60))
        query = "".join(c for c in ref if r.random() > 0.05)
        query = "".join(r.choice("ACGT") if r.random() < 0.05 else c for c in query)
        spans = [("flank_5p", 0, 20), ("insert", 20, 45), ("flank_3p", 45, 60)]
        told = qc.split_states(query, ref, spans)
        edits = qc.region_edits(query, ref, spans)
        assert told["insert_edits"] == edits["insert"] and told["vector_edit_distance"] == edits["flank_5p"] + edits["flank_3p"]
        assert al.global_distance(query, ref) == sum(edits.values())
    with pytest.raises(ValueError):
        qc.motif_spans("AAAACCCCAAAA", "AAAA", "CCCC")


@pytest.mark.parametrize("limit", [1 << 20, 10])
def test_digests_come_from_tasks(spark, tmp_path, monkeypatch, limit):
    import gzip
    import hashlib

    monkeypatch.setattr(fastq, "WHOLE_BYTES", limit)
    text = b"@a 1\nACGT\n+\nIIII\n" * 40
    for name, data in (("a b.fastq", text), ("c.fastq.gz", gzip.compress(text)), ("empty.fastq", b"")):
        (tmp_path / name).write_bytes(data)
    told = fastq.file_digests(spark, fastq.listed(spark, str(tmp_path)))
    assert sorted(told.values()) == sorted((hashlib.sha256(p.read_bytes()).hexdigest(), p.read_bytes()[:2]) for p in tmp_path.iterdir())
    assert fastq.fastq_files(spark, str(tmp_path), digests=told).count() == 80


def test_flank_columns_agree_with_the_text(spark):
    for own in (flanks.Flanks(UP, DOWN), flanks.Flanks(UP, DOWN, in_references=True)):
        seq = INSERTS[0]
        got = spark.range(1).select(own.column(F.lit(seq)).alias("x")).first().x
        assert got == own.transform(seq)
    with pytest.raises(Exception, match="constant regions"):
        spark.range(1).select(flanks.Flanks(UP, DOWN).column(F.lit(UP + INSERTS[0] + DOWN)).alias("x")).collect()


def test_insert_finder():
    finder = assign.InsertFinder.of(flanks.Flanks(UP, DOWN), 2)
    read = "TTGACA" + UP + INSERTS[3] + DOWN + "GGAT"
    assert finder.insert_of(read) == INSERTS[3] and finder.insert_of(al.reverse_complement(read)) == INSERTS[3]
    worn = read.replace(START[-20:], "T" * 20)
    assert finder.insert_of(worn) == INSERTS[3]  # by offset between the primers
    assert finder.insert_of("ACGT" * 40) is None


def test_numbers_without_one_task(spark):
    rows = [(i * 7919 % 500,) for i in range(500)]
    got = shared.numbered(spark.createDataFrame(rows, "x int").repartition(7), ["x"]).collect()
    assert sorted((r.x, r.place) for r in got) == [(i, i + 1) for i in range(500)]


def test_platform_and_replicate_lookups(spark):
    made = spark.createDataFrame([("c1", "P", "CP1", "consensus_pass", "A"), ("c2", "P", "X1", "low_depth", "A"), ("c3", "P", None, "mixed_variants", "B")], "consensus_id string, plate_id string, culture_plate string, status string, encoding string")
    assert {r.consensus_id for r in comparisons.built_clones(made).collect()} == {"c1", "c3"}
    assert [r.consensus_id for r in comparisons.library_set(made, "P", "CP", ["A"]).collect()] == ["c1"]
    records = spark.createDataFrame([("c1", "ACGT"), ("zz", "T")], "name string, sequence string")
    assert {r.consensus_id: r.sequence for r in comparisons.with_sequences(made, records).collect()} == {"c1": "ACGT", "c2": "", "c3": ""}
    told = comparisons.with_insert_outcomes(made, spark.createDataFrame([("c1", "Perfect")], "consensus_id string, insert_class string"), spark.createDataFrame([("c1", "d1"), ("c2", "")], "consensus_id string, sequence_sha256 string"))
    assert {r.consensus_id: (r.insert_class, r.sequence_id) for r in told.collect()} == {"c1": ("Perfect", "d1"), "c2": (None, "c2"), "c3": (None, "c3")}


def test_partner_support(spark):
    contested = spark.createDataFrame([("P1", "C", "A01", "d", 5, "T"), ("P1", "C", "A01", "e", 5, "T"), ("P1", "C", "A01", "d", 9, "G")], "plate_id string, culture_plate string, well_id string, design string, position int, minor string")
    pairs = spark.createDataFrame([("C", "A01", "P1", "P2"), ("C", "A01", "P2", "P1")], "culture_plate string, well_id string, plate_a string, plate_b string")
    votes = spark.createDataFrame([("P2", "A01", "d", 5, "T", 3), ("P2", "A01", "d", 5, "G", 9)], "plate_id string, well_id string, design string, position int, allele string, n long")
    got = {(r.design, r.position): (r.partner_status, r.partner_depth, r.partner_minor_reads, r.partner_minor_fraction) for r in comparisons.partner_support(contested, pairs, votes).collect()}
    assert got == {("d", 5): ("ok", 12, 3, 0.25), ("e", 5): ("no reads", None, None, None), ("d", 9): ("ok", 0, 0, None)}


def test_assembly_lookups(spark):
    owners = spark.createDataFrame([("r", 0, "g1"), ("r", 0, "g2"), ("r", 1, "g2"), ("s", 0, "g1"), ("s", 1, "g3"), ("t", 0, "g1"), ("t", 1, "g3")], "uid string, slot int, owner string")
    common = fragments.common_owners(owners)
    assert {r.uid: r.common for r in common.collect()} == {"r": ["g2"], "s": [], "t": []}
    assert [tuple(r) for r in fragments.donor_pairs(owners, common.where("size(common) = 0")).collect()] == [("g1", "g3", 2)]
    design, spans = "ACGTACGTGGCCTTAA", [(0, 8), (8, 16)]
    assert fragments.project_spans("ACGTACGGGCCTTAA", design, spans) == ["ACGTACG", "GGCCTTAA"]
    assert "".join(fragments.project_spans("TTACGTACGTGGCCTTAAGG", design, spans)) == "TTACGTACGTGGCCTTAAGG"
    genes = spark.createDataFrame([("g", "b", design, [(0, "ACGTACGT", 0, 8), (1, "GGCCTTAA", 8, 16)])], "gene_id string, block string, sequence string, pieces array<struct<slot:int,sequence:string,start:int,end:int>>")
    parts = fragments.read_parts(spark.createDataFrame([("u", "g", "ACGTACGTGG"), ("v", "g", None)], "uid string, gene_id string, query string"), genes)
    assert [(r.uid, r.slot, r.part) for r in parts.collect()] == [("u", 0, "ACGTACGT")]
    told = fragments.library_summary(spark.createDataFrame([("g", "b", ["A", "C"]), ("h", "b", ["A"])], "gene_id string, block string, oligos array<string>")).first()
    assert (told.genes, told.blocks, told.fragments, told.single_fragment_genes, told.most_fragments) == (2, 1, 3, 1, 2)


def test_permutation_test_counts_all_trials(spark):
    r = random.Random(5)
    rows = [(r.random() + (i < 30) * 2, i < 30) for i in range(90)] + [(0.5, False)] * 40
    frame = spark.createDataFrame(rows, "v double, l boolean")
    got = comparisons.permutation_test(frame, "v", "l", 60, 3).first()
    mean = lambda flag: sum(v for v, l in rows if l == flag) / sum(l == flag for _, l in rows)
    assert got.observed == pytest.approx(mean(True) - mean(False)) and got.p == pytest.approx(1 / 61)
    even = comparisons.permutation_test(spark.createDataFrame([(float(i % 10), i % 2 == 0) for i in range(100)], "v double, l boolean"), "v", "l", 99, 3).first()
    assert even.p > 0.3

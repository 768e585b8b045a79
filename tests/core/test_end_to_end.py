"""A small run from FASTQ to graded clones, its reuse, and the sources and sinks around it."""

import dataclasses
import gzip

import pytest

from strandlake.plans import amplicon
from strandlake.plans.config import ConfigError, parse_config
from strandlake.plans.stages import StageError, Stages, digest
from strandlake.sources import exports, fastq, tables

INSERT_A = "ATGCATGGATCCTGACAATTCGGCACGTAA"
INSERT_B = "ATGTTCCAGGACCTTAAGGCTAACTGCTAA"
P1, A1, B1 = "AAAACCCC", "ACGTACGT", "TGCATGCA"
LEFT, RIGHT = "GATTACA", "CCGGAAT"


def read(well, insert):
    return P1 + well + LEFT + insert + RIGHT


READS = [read(A1, INSERT_A)] * 3 + [read(B1, INSERT_B)] * 3 + [read(A1, "CTCTCTAGAGAGTTTTGGGGCCCCAAAATC")]


@pytest.fixture()
def files(tmp_path):
    text = "".join(f"@read_{i} x\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate(READS))
    (tmp_path / "reads.fastq").write_text(text)
    (tmp_path / "reads.fq.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "refs.fasta").write_text(f">ref_A first\n{INSERT_A[:20]}\n{INSERT_A[20:]}\n>ref_A_alias same\n{INSERT_A}\n>ref_B second\r\n{INSERT_B}\r\n")
    return tmp_path


def config(files, **more):
    call = {"window": 20, "max_edits": 1, "min_margin": 2, "ends": ["head"]}
    return parse_config({
        "schema_version": 1, "run_name": "small", "inputs": [{"path": str(files / "reads.fastq"), "sample_id": "s"}],
        "libraries": {"lib": str(files / "refs.fasta")}, "plates": {"P1": P1, "P2": "CCAATTGG"}, "wells": {"A1": A1, "B1": B1},
        "plate_call": call, "well_call": {**call, "window": 30, "both_strands": False}, "gates": {"min_length": 50, "max_length": 100, "min_quality": 10},
        "motifs": {"left": LEFT, "right": RIGHT, "max_edits": 1},
        "assign": {"kmer_sizes": [7, 5], "max_kmer_owners": 2, "candidates": 3, "min_identity": 0.9, "min_query_coverage": 0.9, "min_reference_coverage": 0.9}, **more,
    }, environment={})


def test_run_and_resume(spark, files):
    out = amplicon.run(spark, config(files), str(files / "run"))
    assert {r[0]: r[1] for r in out["demux"].groupBy("call_status").count().collect()} == {"assigned": 7}
    assert {r[0]: r[1] for r in out["assignment"].groupBy("assignment_status").count().collect()} == {"assigned_alias_set": 3, "assigned_unique": 3, "no_match": 1}
    clones = {r.alias_key: r for r in out["graded"].collect()}
    assert set(clones) == {"ref_A|ref_A_alias", "ref_B"}
    assert clones["ref_B"].sequence == INSERT_B and clones["ref_B"].grade == "perfect" and clones["ref_A|ref_A_alias"].well_id == "A1"
    assert clones["ref_B"].n_reads_used == 3 and clones["ref_B"].min_depth == 3
    assert {(r.scope, r.well_id): r.reads for r in out["demux_index"].collect()} == {("by_plate", None): 7, ("by_well", "A1"): 4, ("by_well", "B1"): 3}
    again = Stages(spark, str(files / "run"))
    again.table("consensus", {"eligible": again.fingerprint("eligible"), "consensus": config(files).consensus}, lambda: pytest.fail("built again"))
    assert again.reused == ["consensus"]
    with pytest.raises(StageError):
        again.table("consensus", {"other": 1}, lambda: pytest.fail("built again"))


def test_layouts_are_checked_before_a_run(spark, files):
    from strandlake.plans import cli

    (files / "layout.csv").write_text("plate_barcode,culture_plate,library,block\nP1,C1,lib,1\nP1,C2,lib,1\nP9,C1,lib,7\n")
    found = {(f["problem"], f["subject"]) for f in cli.validate(spark, config(files, layout=str(files / "layout.csv")))}
    assert {("plate_without_barcode", "P9"), ("block_without_reference", "lib/7"), ("block_shared_in_pool", "P1/lib/1")} <= found
    assert not any(p == "plate_without_route" for p, _ in found)


def test_changed_tables_are_refused(spark, tmp_path):
    from pathlib import Path

    folder = str(tmp_path / "run")
    build = lambda: spark.range(50).repartition(2)
    assert Stages(spark, folder, verify=True).table("a", {}, build).count() == 50
    assert Stages(spark, folder, verify=True).table("a", {}, lambda: pytest.fail("built again")).count() == 50
    part = sorted(Path(folder, "a").glob("part-*"))[0]
    body = part.read_bytes()
    part.write_bytes(body[:-9] + bytes(b ^ 1 for b in body[-9:-8]) + body[-8:])
    for crc in Path(folder, "a").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(StageError, match="changed"):
        Stages(spark, folder, verify=True).table("a", {}, build)
    part.write_bytes(body + b"x")
    with pytest.raises(StageError, match="not those"):
        Stages(spark, folder).table("a", {}, build)
    Stages(spark, folder).table("b", {}, build)
    with pytest.raises(StageError, match="without checksums"):
        Stages(spark, folder, verify=True).table("b", {}, build)

    def broken():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        Stages(spark, folder).table("c", {}, broken)
    assert Path(folder, "c.failed").exists() and not list(Path(folder).glob("c.manifest"))
    assert Stages(spark, folder).table("c", {}, build).count() == 50 and not Path(folder, "c.failed").exists()


def test_shuffled_input_gives_the_same_clones(spark, files):
    calls = amplicon.demultiplexed(amplicon.read_inputs(spark, config(files)), config(files))
    a = {tuple(r) for r in calls.select("read_uid", "call_status", "plate.id", "well.id").collect()}
    b = {tuple(r) for r in amplicon.demultiplexed(amplicon.read_inputs(spark, config(files)).repartition(5), config(files)).select("read_uid", "call_status", "plate.id", "well.id").collect()}
    assert a == b and len(a) == 7


def test_data_source_and_gzip_agree(spark, files):
    spark.dataSource.register(fastq.FastqDataSource)
    names = [c.split()[0] for c in fastq.SCHEMA.split(", ")]
    one = spark.read.format("fastq").option("path", str(files / "reads.fastq")).option("sample_id", "s").load()
    two = fastq.fastq_files(spark, str(files / "reads.fastq"), "s")
    assert sorted(map(tuple, one.select(*names).collect())) == sorted(map(tuple, two.select(*names).collect()))
    packed = fastq.fastq_files(spark, str(files / "reads.fq.gz"))
    assert packed.count() == 7 and fastq.first_records(packed, 3).count() == 3


@pytest.mark.parametrize("text,problem", [
    ("@a\nAC\n+\nI\n", "differ in length"), ("a\nAC\n+\nII\n", "start with @"), ("@a\nAC\n", "cut off"), ("@a\nA!\n+\nII\n", "unknown symbols"),
    ("@a\n\n+\n\n", "empty"), ("@ \nAC\n+\nII\n", "no name"), ("@a\nAC\n+b\nII\n", "another one"), ("@a\nAC\nx\nII\n", "start with +"), ("@a\nA C\n+\nIII\n", "white space"),
])
def test_bad_records_are_refused(text, problem):
    with pytest.raises(fastq.FastqError, match=problem.replace("+", r"\+")):
        list(fastq.parse(text.encode(), "x.fastq"))


def test_misleading_suffix_and_broken_gzip():
    with pytest.raises(fastq.FastqError, match="not compressed"):
        list(fastq.parse(b"@a\nAC\n+\nII\n", "x.gz"))
    with pytest.raises(fastq.FastqError):
        list(fastq.parse(gzip.compress(b"@a\nAC\n+\nII\n" * 50)[:-12], "x.gz"))
    assert len(list(fastq.parse(b"@a\n\n+\n\n", "x", allow_empty=True))) == 1


def test_writers_read_back(spark, files):
    reads = fastq.fastq_files(spark, str(files / "reads.fastq"), "s")
    fastq.write_fastq(reads, str(files / "out"), compress=True)
    assert sorted(r.sequence for r in fastq.fastq_files(spark, str(files / "out/part-*")).collect()) == sorted(READS)
    calls = amplicon.demultiplexed(reads, config(files))
    exports.write_demultiplexed(calls, str(files / "views"))
    assert spark.read.text(str(files / "views/scope=by_well/plate_id=P1/well_id=A1")).count() == 16
    refs = tables.read_fasta(spark, str(files / "refs.fasta"), "lib")
    exports.write_fasta_tree(refs, str(files / "tree"), ["library_id"], "ref_id")
    assert spark.read.text(str(files / "tree/library_id=lib")).where("value like '>%'").count() == 3
    exports.write_index(refs, str(files / "index"), ["ref_id"])
    assert spark.read.option("header", True).csv(str(files / "index")).count() == 3
    assert "&lt;b&gt;" in exports.html_table(spark.createDataFrame([("<b>",)], "x string"), "t")


def test_tables(spark, tmp_path):
    def path(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path / name)

    assert tables.read_registry(spark, path("r.csv", "family_id,barcode_id,sequence\nf,a,acg\nf,b,TTT\ng,a,CCC\n"), "f").count() == 2
    with pytest.raises(tables.TableError):
        tables.read_registry(spark, path("r2.csv", "family_id,barcode_id,sequence\nf,a,acg\nf,a,TTT\n"), "f")
    layout = tables.read_layout(spark, path("l.csv", "﻿plate_barcode,culture_plate,library,block,clonality\nP,C1,l,b1,per_block\nP,C1,l,b1,per_block\n,,,,\nP,C2,l,b2,per_block\n"))
    assert layout.count() == 2
    for bad in ("plate_barcode,culture_plate,library,block,x\nP,C,l,b,1\n", "plate_barcode,culture_plate,library,block\nP,,l,b\n", "plate_barcode,culture_plate,library,block,clonality\nP,C,l,b,a\nP,D,l,b,c\n"):
        with pytest.raises(tables.TableError):
            tables.read_layout(spark, path(f"bad{len(bad)}.csv", bad))
    with pytest.raises(tables.TableError):
        tables.read_fasta(spark, path("f.fasta", ">a\nAC\n>a\nGG\n"))
    with pytest.raises(tables.TableError):
        tables.read_fasta(spark, path("g.fasta", ">a|b\nAC\n"))
    designs = tables.read_designs(spark, path("d.csv", "Block,Sequence Name,DNA Fragment 1,DNA Fragment 2,Full Sequence\nb,g,acgt,,ACGT\n")).first()
    assert (designs.gene_id, designs.oligos, designs.gene) == ("g", ["ACGT"], "ACGT")
    gb = tables.read_genbank(spark, path("x.gb", "LOCUS       pX 12 bp\nFEATURES\nORIGIN\n        1 acgtttgaca tt\n//\n")).first()
    assert (gb.locus, gb.sequence) == ("pX", "ACGTTTGACATT")


def test_config_is_closed(files):
    with pytest.raises(ConfigError):
        config(files, unknown=1)
    with pytest.raises(ConfigError):
        config(files, qc={"nope": 1})
    with pytest.raises(ConfigError):
        config(files, plates={"P": "XYZ!"})
    with pytest.raises(ConfigError):
        parse_config({"schema_version": 1, "inputs": [{"path": "${NOPE}", "sample_id": "s"}], "libraries": {"a": "b"}}, environment={})
    assert parse_config({"schema_version": 1, "preset": "p", "inputs": [{"path": "${D}/x", "sample_id": "s"}], "libraries": {"a": "b"}}, {"p": {"qc": {"length_tolerance": 3}}}, {"D": "d"}).qc.length_tolerance == 3
    assert digest({"b": 1, "a": {2, 1}}) == digest({"a": [1, 2], "b": 1}) and dataclasses.is_dataclass(config(files))


def test_command_line_checks(spark, files, capsys):
    from strandlake.plans import cli

    assert cli.main(["doctor"]) == 0 and "pyspark" in capsys.readouterr().out
    assert cli.main(["validate", str(files / "none.yaml")]) == 2
    assert cli.validate(spark, config(files)) == []
    near = config(files, plates={"a": "AAAACCCC", "b": "AAAACCCG"}, routes={"a": "nowhere"})
    assert [p["problem"] for p in cli.validate(spark, near)] == ["plates too close", "route to no library"]


def test_every_query_has_one_name_and_stable_views():
    from strandlake.plans.catalogue import ORACLES, QUERIES

    assert len(QUERIES) >= 80 and set(ORACLES) <= set(QUERIES)


def test_run_with_mosaics_and_a_layout(spark, tmp_path):
    import random

    r = random.Random(4)
    seq = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    a, b = seq(270), seq(270)
    mosaic = a[:135] + b[135:]
    made = [read(A1, a)] * 4 + [read(A1, mosaic)] * 6 + [read(B1, b)] * 3
    (tmp_path / "reads.fastq").write_text("".join(f"@r{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate(made)))
    (tmp_path / "refs.fasta").write_text(f">Block_1_a\n{a}\n>Block_1_b\n{b}\n")
    (tmp_path / "layout.csv").write_text("plate_barcode,culture_plate,library,block,clonality\nP1,C1,lib,1,per_block\n")
    c = config(tmp_path, gates={"min_length": 50, "max_length": 500, "min_quality": 10}, chimera={"min_depth": 6}, layout=str(tmp_path / "layout.csv"),
               assign={"kmer_sizes": [15], "max_kmer_owners": 2, "candidates": 3, "min_identity": 0.6, "min_query_coverage": 0.6, "min_reference_coverage": 0.6, "min_margin": 0.0})
    out = amplicon.run(spark, c, str(tmp_path / "run"))
    chim = out["chimeras"].collect()
    assert [(x.signature, x.size, x.origin, x.well_id) for x in chim] == [(["Block_1_a", "Block_1_b"], 6, "assembly", "A1")]
    assert out["chimera_consensus"].first().sequence == mosaic
    clones = {(x.well_id, x.alias_key): x for x in out["graded"].collect()}
    assert set(clones) == {("A1", "Block_1_a"), ("B1", "Block_1_b")}
    assert all(x.grade == "perfect" and x.culture_plates == ["C1"] for x in clones.values())
    assert clones["A1", "Block_1_a"].n_reads_available == 4


def test_consensus_queries_take_whole_reads(spark, tmp_path):
    """Bases behind the 60th are called, and wells of short reads have a consensus too."""
    from strandlake.plans.catalogue import QUERIES

    text = "".join("abcdefghijklmnopqrstuvwxyz"[i * i % 26] for i in range(203))
    rows = [(i, text, "en", "a") for i in range(6)] + [(i, text[:30], "fr", "b") for i in range(6, 12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    built = {x.group_id: x.sequence for x in QUERIES["consensus_path"](spark, str(tmp_path)).collect()}
    assert {g: len(s) for g, s in built.items()} == {"en:0": 203, "fr:2": 30}
    assert QUERIES["contributors"](spark, str(tmp_path)).count() == 10

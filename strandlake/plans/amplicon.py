"""The amplicon run: reads to graded clones, as stages.

reads -> demultiplexed -> inserts -> assigned -> (mosaics claim reads) -> grouped -> consensus -> graded
A layout adds the culture plate that a read's block tells. A library with flanks is a
full-length one: its references span the constant regions, reads are cut at the primer
anchors, insert floors and mosaics look at the insert alone, and judgement finds the
reading frame inside the consensus and reports each region. Boundary motifs add separate
grades of insert and vector. Inputs are known by the digests of their contents.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.reads import block_of
from ..operators import assign, chimera, consensus, demux, kmers, motifs, pooling, qc
from ..operators.flanks import LIBRARY_LIMIT, Flanks, from_references, from_template
from ..sources import exports
from ..sources.fastq import fastq_files, file_digests, listed
from ..sources.tables import TableError, read_fasta, read_layout, read_libraries
from .config import FlankSettings, RunConfig
from .stages import Stages

LOG = logging.getLogger(__name__)
#: Stages in the order they run; a rerun inherits those before a named one.
ORDER = ("demux", "references", "assign", "assignment", "sources", "chimeras", "chimera-consensus", "eligible", "consensus", "graded")


def contents_of(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, bytes]]:
    """SHA-256 and first bytes of every file that the paths name."""
    return file_digests(spark, sorted({f for p in paths for f in listed(spark, p)}))


def digests_of(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """SHA-256 of every file that the paths name."""
    return {name: digest for name, (digest, _) in contents_of(spark, paths).items()}


def resolved_flanks(spark: SparkSession, library: str, settings: FlankSettings, config: RunConfig) -> Flanks:
    """The constant regions of one library."""
    if settings.upstream is not None:
        return Flanks(settings.upstream, settings.downstream, settings.anchor_length)
    rows = read_libraries(spark, {library: config.libraries[library]}).select("sequence").distinct().limit(LIBRARY_LIMIT + 1).collect()
    if len(rows) > LIBRARY_LIMIT:
        raise TableError(f"{library}: flanks are found in at most {LIBRARY_LIMIT} references")
    known = sorted(r.sequence for r in rows)
    if settings.derive:
        return from_references(known, settings.anchor_length)
    template = read_fasta(spark, settings.template).collect()
    if len(template) != 1:
        raise TableError(f"{library}: a template is one construct")
    return from_template(template[0].sequence, known, settings.anchor_length)[0]


def references(spark: SparkSession, config: RunConfig, flanks: dict[str, Flanks]) -> DataFrame:
    """Alias groups of what reads span, with the part of it that is the insert."""
    refs = read_libraries(spark, config.libraries)
    full, insert = F.col("sequence"), F.col("sequence")
    for library, own in flanks.items():
        here = F.col("library_id") == library
        spanned = own.column(F.col("sequence"))
        left, right = own.inner
        full = F.when(here, spanned).otherwise(full)
        insert = F.when(here, F.substring(spanned, F.lit(len(left) + 1), F.length(spanned) - (len(left) + len(right)))).otherwise(insert)
    told = refs.withColumns({"_full": full, "_insert": insert}).withColumn("sequence", F.col("_full"))
    inserts = told.groupBy("library_id", "sequence").agg(F.first("_insert").alias("insert_sequence"))
    return kmers.alias_groups(told).join(inserts, ["library_id", "sequence"])


def report_counts(name: str, counts: DataFrame, success: list[str]) -> None:
    """Say how a stage went, and warn where nothing came of it."""
    told = {str(r[0]): r[1] for r in counts.collect()}
    LOG.info("stage %s: %s", name, told)
    if not any(told.get(s) for s in success):
        LOG.warning("stage %s: none of %s reads or clones came through: %s", name, sum(told.values()), told)


def read_inputs(spark: SparkSession, config: RunConfig, contents: dict[str, tuple[str, bytes]] | None = None) -> DataFrame:
    out = None
    for path, sample in config.inputs:
        own = fastq_files(spark, path, sample, allow_empty=config.allow_empty, digests=contents)
        out = own if out is None else out.unionByName(own)
    return out


def demultiplexed(reads: DataFrame, config: RunConfig) -> DataFrame:
    panel = lambda p: sorted(p.items()) if p else None
    return demux.demultiplex(reads, panel(config.plates), panel(config.wells), config.plate_call, config.well_call, config.gates)


def extracted(routed: DataFrame, config: RunConfig, flanks: dict[str, Flanks]) -> DataFrame:
    """Reads cut between the motifs of their library: primer anchors where it has flanks, else the run's motifs, if any."""
    whole = F.struct(F.lit("found").alias("status"), F.col("sequence").alias("insert"), F.lit("forward").alias("orientation"), F.lit(0).alias("start"), F.length("sequence").alias("end"), F.lit(0).alias("edits"))
    plain = routed.where(~F.coalesce(F.col("library_id").isin(*flanks), F.lit(False))) if flanks else routed
    told = motifs.extract_inserts(plain, config.motifs) if config.motifs is not None else plain.withColumn("extraction", whole)
    for library, own in flanks.items():
        pair = motifs.MotifPair(*own.anchors, config.flanks[library].max_edits)
        told = told.unionByName(motifs.extract_inserts(routed.where(F.col("library_id") == library), pair))
    finders = {library: assign.InsertFinder.of(own, config.flanks[library].max_edits) for library, own in flanks.items()}
    told = assign.with_inserts(told, finders) if finders else told.withColumn("own_insert", F.lit(None).cast("string"))
    full = F.col("library_id").isin(*flanks) if flanks else F.lit(False)
    return told.withColumn("own_insert", F.when(F.coalesce(full, F.lit(False)), F.col("own_insert")).when(F.col("extraction.status") == "found", F.col("extraction.insert")))


def assigned(calls: DataFrame, groups: DataFrame, config: RunConfig, keep_stage, flanks: dict[str, Flanks] | None = None) -> DataFrame:
    """Accepted reads with insert, library and assignment."""
    spark = calls.sparkSession
    good = calls.where("call_status = 'assigned'").withColumns({"plate_id": F.col("plate.id"), "well_id": F.col("well.id")})
    routes = spark.createDataFrame(sorted(config.routes.items()), "plate_id string, library_id string")
    routed = assign.route_plates(good, routes, sorted(config.libraries))
    told = keep_stage(extracted(routed, config, flanks or {}), "inserts")
    queries = told.where("extraction.status = 'found' and library_id is not null and length(extraction.insert) > 0").select("read_uid", "library_id", F.col("extraction.insert").alias("query"))
    placed = assign.assign_reads(queries, groups, config.assign, keep_stage)
    joined = told.join(placed.drop("library_id"), "read_uid", "left")
    status = F.when(F.col("library_id").isNull(), F.col("routing")).when(F.col("extraction.status") != "found", F.col("extraction.status")).otherwise(F.coalesce("assignment_status", F.lit("no_match")))
    joined = joined.withColumn("assignment_status", status)
    gated = [library for library in flanks or {} if config.flanks[library].insert_thresholds]
    if not gated:
        return joined.withColumns({"insert_identity": F.lit(None).cast("double"), "insert_query_coverage": F.lit(None).cast("double")})
    own = kmers.joined_small(joined, groups.select("library_id", "alias_key", F.col("insert_sequence").alias("reference_insert")), ["library_id", "alias_key"], "left")
    judged = F.col("library_id").isin(*gated) & F.col("assignment_status").startswith("assigned")
    measured = assign.insert_geometry(own.withColumn("reference_insert", F.when(judged, F.col("reference_insert")))).drop("reference_insert")
    held = assign.insert_gate(F.col("insert_identity"), F.col("insert_query_coverage"), config.assign.min_identity, config.assign.min_query_coverage, F.col("assignment_status"))
    return measured.withColumn("assignment_status", held)


WELL = ["sample_id", "plate_id", "well_id", "library_id"]


def with_culture_plates(calls: DataFrame, config: RunConfig) -> DataFrame:
    """calls with block, culture_plate and its status; without a layout the status is null."""
    block = block_of(F.get(F.split("alias_key", "\\|"), F.lit(0)), config.block_pattern)
    told = calls.withColumn("block", block)
    if config.layout is None:
        return told.withColumns({"culture_plate": F.lit(None).cast("string"), "culture_plate_status": F.lit(None).cast("string")})
    layout = read_layout(calls.sparkSession, config.layout)
    return pooling.deconvolve(told, layout.select("plate_id", "culture_plate").distinct(), layout.select("library_id", "block", "culture_plate").distinct())


def mosaics(calls: DataFrame, groups: DataFrame, config: RunConfig) -> DataFrame:
    """Chimeric clones of the reads that have an insert; windows of a full-length library's reads are those of the insert."""
    inserts = calls.where("own_insert is not null and library_id is not null").select("read_uid", *WELL, F.col("own_insert").alias("insert"))
    own = groups.withColumn("sequence", F.col("insert_sequence"))
    known = own.select(F.explode("ref_ids").alias("ref_id"), "sequence").groupBy("ref_id").agg(F.min("sequence").alias("sequence"))
    return chimera.detect(inserts, own, known, WELL, config.chimera)


def mosaic_consensus(clones: DataFrame, calls: DataFrame, config: RunConfig) -> DataFrame:
    """Consensus of each written chimeric clone against its scaffold."""
    members = clones.where("written and scaffold is not null").select(F.col("chimera_id").alias("group_id"), F.col("scaffold").alias("reference"), F.explode("read_uids").alias("read_uid"))
    reads = calls.select("read_uid", F.col("own_insert").alias("sequence"), F.lit(None).cast("string").alias("quality"))
    return consensus.build_consensus(members.join(reads, "read_uid"), config.consensus)


def eligible(calls: DataFrame, groups: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """Reads a consensus can use: the insert with its own qualities and its reference."""
    good = calls.where("assignment_status in ('assigned_unique', 'assigned_alias_set')").join(groups.select("library_id", "alias_key", F.col("sequence").alias("reference")), ["library_id", "alias_key"])
    oriented = F.when(F.col("extraction.orientation") == "reverse", F.reverse("quality")).otherwise(F.col("quality"))
    cut = F.substring(oriented, F.col("extraction.start") + 1, F.col("extraction.end") - F.col("extraction.start"))
    own = F.when(F.length(cut) == F.length("extraction.insert"), cut)
    return consensus.group_reads(good, claimed).select("group_id", "read_uid", "sample_id", "plate_id", "well_id", "library_id", "alias_key", "culture_plate", "reference", F.col("extraction.insert").alias("sequence"), own.alias("quality"))


def judged(told: DataFrame, config: RunConfig, flanks: dict[str, Flanks]) -> DataFrame:
    """Metrics and states of clones, by what is known of their library."""
    q = config.qc
    out = qc.evaluate(told.where(~F.coalesce(F.col("library_id").isin(*flanks), F.lit(False))) if flanks else told, q, q.upstream_constant, q.downstream_constant)
    empty = "array<struct<name:string,start:int,end:int,edits:int,length:int,identity:double>>"
    out = out.withColumns({"regions": F.lit(None).cast(empty), "frame": F.lit(None).cast("struct<start:int,end:int>")})
    for library, own in flanks.items():
        left, right = own.inner
        out = out.unionByName(qc.evaluate_full_length(told.where(F.col("library_id") == library), q, (len(left), len(right))))
    return out


def graded(built: DataFrame, names: DataFrame, config: RunConfig, flanks: dict[str, Flanks] | None = None) -> DataFrame:
    """Clones with every judgement and their grade."""
    told = judged(built.join(names, "group_id"), config, flanks or {})
    told = qc.classified_mixed(told, regions="regions", frame="frame")
    if config.qc.insert_left_boundary:
        told = qc.split_grades(told, None, config.qc.insert_left_boundary, config.qc.insert_right_boundary, config.qc)
    return told.withColumn("grade", qc.grade(F.col("status"), F.col("overall"), F.coalesce("ambiguous_bases", F.lit(0)), F.col("mixed_signature"), F.col("reading_frame"), F.col("internal_stops"), F.col("expected_length"), F.col("full_amplicon"), F.col("edit_distance")))


def chimera_clones(found: DataFrame, built: DataFrame, config: RunConfig) -> DataFrame:
    """Written chimeric clones in the columns of graded ones, judged against their scaffolds."""
    rows = built.join(found.select(F.col("chimera_id").alias("group_id"), *WELL, F.array_join("signature", "+").alias("alias_key")), "group_id")
    told = qc.evaluate(rows, config.qc, config.qc.upstream_constant, config.qc.downstream_constant).withColumn("consensus_id", F.col("group_id"))
    told = qc.classified_mixed(told)
    return told.withColumns({"kind": F.lit("chimera"), "grade": qc.grade(F.col("status"), F.col("overall"), F.coalesce("ambiguous_bases", F.lit(0)), F.col("mixed_signature"), F.col("reading_frame"), F.col("internal_stops"), F.col("expected_length"), F.col("full_amplicon"), F.col("edit_distance"))})


def run(spark: SparkSession, config: RunConfig, folder: str, source: str | None = None, recompute_from: str | None = None, digests: dict[str, str] | None = None, verify: bool = False) -> dict[str, DataFrame]:
    """All stages; those written before with the same inputs, parameters and code are taken as they are.

    With source, stages before recompute_from come from that run. digests (path to SHA-256) stand for the reads where those are
    no longer there; by default the contents are read. verify compares the contents of tables that are taken again with their
    checksums; without it only names and sizes of their files are compared."""
    stages = Stages(spark, folder, source, recompute_from, ORDER, verify)
    contents = contents_of(spark, [p for p, _ in config.inputs]) if digests is None else None  # told once, for the stage and the reader
    inputs = digests if contents is None else {name: digest for name, (digest, _) in contents.items()}
    calls = stages.table("demux", {"inputs": [inputs, [s for _, s in config.inputs]], "gates": config.gates, "allow_empty": config.allow_empty, "panels": [config.plates, config.wells, config.plate_call, config.well_call]}, lambda: demultiplexed(read_inputs(spark, config, contents), config))
    report_counts("demux", calls.groupBy("call_status").count(), ["assigned"])
    out = {"demux": calls, "demux_index": demux.demux_index(calls.where("call_status = 'assigned'"))}
    if config.demux_only:
        return out
    files = [p for own in config.libraries.values() for p in own] + [f.template for f in config.flanks.values() if f.template]
    flanks = {library: resolved_flanks(spark, library, own, config) for library, own in sorted(config.flanks.items())}
    groups = stages.table("references", {"files": digests_of(spark, files), "libraries": sorted(config.libraries), "flanks": flanks}, lambda: references(spark, config, flanks))
    before = {"demux": stages.fingerprint("demux"), "references": stages.fingerprint("references"), "assign": config.assign, "motifs": config.motifs, "routes": config.routes, "flanks": config.flanks}
    keep = lambda df, name: stages.table(f"assign-{name}", {"before": before}, lambda: df)
    placed = stages.table("assignment", {"before": before}, lambda: assigned(calls, groups, config, keep, flanks))
    report_counts("assignment", placed.groupBy("assignment_status").count(), ["assigned_unique", "assigned_alias_set"])
    layout = digests_of(spark, [config.layout]) if config.layout else None
    told = stages.table("sources", {"assignment": stages.fingerprint("assignment"), "layout": layout, "pattern": config.block_pattern}, lambda: with_culture_plates(placed, config))
    claimed = found = mosaic = None
    if config.chimera is not None:
        after = {"assignment": stages.fingerprint("assignment"), "chimera": config.chimera}
        found = stages.table("chimeras", after, lambda: mosaics(told, groups, config))
        out["chimeras"] = found
        mosaic = out["chimera_consensus"] = stages.table("chimera-consensus", {**after, "consensus": config.consensus}, lambda: mosaic_consensus(found, told, config))
        claimed = chimera.claims(found, config.chimera.claims, F.col("written"))
        out["reads_excluded"] = told.join(claimed.select("read_uid").distinct(), "read_uid", "left_semi").groupBy("plate_id").agg(F.count(F.lit(1)).alias("reads"))
    reads = stages.table("eligible", {"sources": stages.fingerprint("sources"), "chimera": config.chimera}, lambda: eligible(told, groups, claimed))
    built = stages.table("consensus", {"eligible": stages.fingerprint("eligible"), "consensus": config.consensus}, lambda: consensus.build_consensus(reads, config.consensus))
    report_counts("consensus", built.groupBy("status").count(), ["consensus_pass", "mixed_variants"])
    names = reads.groupBy("group_id", *WELL, "alias_key").agg(F.array_sort(F.collect_set("culture_plate")).alias("culture_plates"))
    made = lambda: graded(built, names, config, flanks).withColumns({"kind": F.lit("consensus"), "culture_plate": F.array_join("culture_plates", "|")})
    clones = stages.table("graded", {"consensus": stages.fingerprint("consensus"), "chimeras": stages.fingerprint("chimera-consensus") if mosaic is not None else None, "qc": config.qc, "flanks": flanks}, made)
    out |= {"assignment": told, "eligible": reads, "consensus": built, "graded": clones, "grades": qc.grade_totals(clones)}
    if mosaic is not None:
        out["chimera_clones"] = chimera_clones(found, mosaic, config)
    if config.export:
        every = clones if mosaic is None else clones.unionByName(out["chimera_clones"], allowMissingColumns=True)
        exports.write_graded(every, f"{folder}/export")
        exports.write_report(spark, f"{folder}/report.html", config.run_name, {"Reads": calls.groupBy("call_status").count(), "Assignment": told.groupBy("assignment_status").count(), "Clones": qc.grade_totals(every), "Consensus": built.groupBy("status").count()})
    return out

"""Queries that go through sources and sinks: what is written is read back and returned."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.reads import reference_parts
from ..operators import consensus, kmers, pooling
from ..sources import exports, fastq, tables
from ..sources.shared import shared_folder
from . import views
from .registry import query


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster shares."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("fastq_roundtrip", views.with_views("SELECT 'r' || doc_id AS name, md5(sequence) AS sequence_md5, md5(quality) AS quality_md5, plate_id FROM reads WHERE length(sequence) > 0", "reads"))
def fastq_roundtrip(spark, sf):
    """Reads written as compressed FASTQ by plate and read back with all format checks."""
    r = views.reads(spark, sf).where(F.length("sequence") > 0)
    path = scratch(spark, "fastq")
    fastq.write_fastq(r.select("plate_id", F.concat(F.lit("r"), F.col("doc_id").cast("string"), F.lit(" "), "plate_id").alias("description"), "sequence", "quality", F.lit("x").alias("source_sha256"), F.col("doc_id").alias("record_index")), path, ["plate_id"])
    back = fastq.fastq_files(spark, f"{path}/plate_id=*/*.gz")
    return back.select("name", F.md5("sequence").alias("sequence_md5"), F.md5("quality").alias("quality_md5"), F.split("description", " ")[1].alias("plate_id"))


@query("fasta_roundtrip", views.with_views("SELECT ref_id, library_id, sha256(sequence) AS sequence_sha256 FROM refs WHERE length(sequence) > 0", "refs"))
def fasta_roundtrip(spark, sf):
    """References written as a FASTA tree by library and read back as libraries."""
    path = scratch(spark, "fasta")
    exports.write_fasta_tree(views.refs(spark, sf), path, ["library_id"], "ref_id")
    back = tables.read_libraries(spark, {lib: f"{path}/library_id={lib}/*.txt" for lib in ("lib0", "lib1")})
    return back.select("ref_id", "library_id", "sequence_sha256")


@query("layout_roundtrip", views.with_views("SELECT DISTINCT plate_id, culture_plate, library_id, block, 'per_block' AS clonality FROM pools JOIN blocks USING (culture_plate)", "pools", "blocks"))
def layout_roundtrip(spark, sf):
    """A pooling layout written as CSV and read back with its checks."""
    path = scratch(spark, "layout")
    pools = views.pools(spark, sf)
    tables.write_layout(pools, views.blocks(spark, sf), pools.select("plate_id", F.lit("per_block").alias("clonality")).distinct(), path)
    return tables.read_layout(spark, path)


@query("registry_scan", views.with_views("SELECT barcode_id, sequence FROM nation_panel WHERE key % 2 = 0", "nation_panel"))
def registry_scan(spark, sf):
    """One family of a barcode registry."""
    path = scratch(spark, "registry")
    p = views.panel(spark, sf, "nation")
    p.select(F.when(F.col("key") % 2 == 0, "even").otherwise("odd").alias("family_id"), "barcode_id", F.lower("sequence").alias("sequence"), F.lit("x").alias("source")).write.option("header", True).csv(path)
    return tables.read_registry(spark, path, "even")


@query("index_csv_roundtrip", views.with_views("SELECT clone_id, grade, plate_id, well_id FROM clones", "clones"))
def index_csv_roundtrip(spark, sf):
    """The clone index as compressed CSV and back."""
    path = scratch(spark, "index")
    exports.write_index(views.clones(spark, sf).select("clone_id", "grade", "plate_id", "well_id"), path, ["plate_id", "well_id", "clone_id"])
    return tables.read_stage_csv(spark, path, "clone_id long, grade string, plate_id string, well_id string")


@query("jsonl_roundtrip", views.with_views("SELECT doc_id, md5(sequence) AS sequence_md5, plate_id FROM reads", "reads"))
def jsonl_roundtrip(spark, sf):
    """Accepted reads as JSON lines and back."""
    path = scratch(spark, "jsonl")
    exports.write_jsonl(views.reads(spark, sf).select("doc_id", "sequence", "plate_id"), path)
    return tables.read_stage_jsonl(spark, path, "doc_id long, sequence string, plate_id string").select("doc_id", F.md5("sequence").alias("sequence_md5"), "plate_id")


@query("short_reads", """SELECT o_orderkey, CASE WHEN o_custkey % 10 < 8 THEN (o_custkey % 10) * 100 ELSE 0 END::BIGINT AS reference_length, 'A' AS encoding, (o_custkey % 10)::BIGINT AS block FROM orders""")
def short_reads(spark, sf):
    """Classified short reads with their reference's length, 0 where unknown."""
    path = scratch(spark, "short")
    number = (F.col("o_custkey") % 10).cast("string")
    name = F.concat(F.lit("A_Block_"), number, F.lit("_x"))
    tsv = lambda df, at: df.write.option("header", True).option("sep", "\t").csv(f"{path}/{at}")
    tsv(spark.range(8).select(F.concat(F.lit("A_Block_"), F.col("id").cast("string"), F.lit("_x")).alias("reference_name"), (F.col("id") * 100).alias("reference_length")), "counts")
    tsv(views.table(spark, sf, "orders").select(name.alias("reference_name"), F.col("o_orderkey").cast("string").alias("expected_group"), F.lit(1).alias("expected_block"), F.lit("perfect_match").alias("category"), F.lit(0).alias("edit_distance")), "reads")
    r = tables.read_short_reads(spark, f"{path}/counts", f"{path}/reads")
    parts = reference_parts(F.col("reference_name"))
    return r.select(F.col("expected_group").cast("long").alias("o_orderkey"), F.col("reference_length").cast("long").alias("reference_length"), parts["encoding"].alias("encoding"), F.coalesce(parts["block"], F.lit(-1)).cast("long").alias("block"))


@query("union_of_clones", views.with_views("SELECT kind, count(*)::BIGINT AS n, count(insert_class)::BIGINT AS with_class FROM clones GROUP BY kind", "clones"))
def union_of_clones(spark, sf):
    """Consensus and chimera rows in one table, columns that one lacks as nulls."""
    c = views.clones(spark, sf)
    both = c.where("kind = 'consensus'").unionByName(c.where("kind = 'chimera'").drop("error"), allowMissingColumns=True)
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count("insert_class").alias("with_class"))


@query("flagged_clone_reads", views.with_views("SELECT doc_id, plate_id FROM reads WHERE plate_id || well_id IN (SELECT plate_id || well_id FROM reads GROUP BY ALL HAVING count(*) > 12)", "reads"))
def flagged_clone_reads(spark, sf):
    """The reads behind clones that a rule flags, found again through their groups."""
    r = views.reads(spark, sf)
    deep = r.groupBy("plate_id", "well_id").count().where("count > 12")
    return r.join(deep, ["plate_id", "well_id"], "left_semi").select("doc_id", "plate_id")


@query("alias_deconvolution", views.with_views("""h AS (SELECT library_id, block, list(DISTINCT culture_plate) AS p FROM blocks GROUP BY ALL)
SELECT library_id, CASE WHEN bool_or(len(p) <> 1) THEN 'ambiguous' WHEN count(DISTINCT p[1]) = 1 THEN 'resolved' ELSE 'ambiguous' END AS status FROM h WHERE block::INT < 3 GROUP BY library_id""", "blocks"))
def alias_deconvolution(spark, sf):
    """Aliases agree on a culture plate or are ambiguous."""
    own = views.blocks(spark, sf).where("cast(block as int) < 3").groupBy("library_id", "block").agg(F.collect_set("culture_plate").alias("p"))
    each = own.select("library_id", F.when(F.size("p") == 1, F.get("p", F.lit(0))).alias("plate"), F.when(F.size("p") == 1, "resolved").otherwise("ambiguous").alias("status"))
    told = each.groupBy("library_id").agg(pooling.of_alias_group(F.collect_list("plate"), F.collect_list("status")).alias("t"))
    return told.select("library_id", "t.status")


@query("design_universe", views.with_views("SELECT culture_plate, count(DISTINCT design_key)::BIGINT AS designs, count(DISTINCT sequence_id)::BIGINT AS sequences FROM clones WHERE grade <> 'low_depth' AND kind <> 'chimera' GROUP BY culture_plate", "clones"))
def design_universe(spark, sf):
    c = views.clones(spark, sf).where("grade <> 'low_depth' and kind <> 'chimera'")
    return c.groupBy("culture_plate").agg(F.count_distinct("design_key").alias("designs"), F.count_distinct("sequence_id").alias("sequences"))


@query("contributors")
def contributors(spark, sf):
    """The reads behind each consensus, in the order they were chosen."""
    r = views.reads(spark, sf).where(F.length("sequence") > 0).select(F.concat_ws(":", "plate_id", "well_id").alias("group_id"), F.col("doc_id").cast("string").alias("read_uid"), "sequence", F.lit(None).cast("string").alias("quality"))
    first = r.groupBy("group_id").agg(F.min(F.struct("read_uid", "sequence"))["sequence"].alias("reference"))
    known = kmers.joined_small(r, kmers.checkpointed(first, "first"), ["group_id"])
    return consensus.contributors(consensus.build_consensus(known, consensus.ConsensusSettings(max_reads=5)))


@query("arrival_windows", """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def arrival_windows(spark, sf):
    """The batch form of the stream's event-time windows."""
    from ..streaming.reads import arrivals

    e = views.table(spark, sf, "events")
    return arrivals(e, window="1 hour").select("window_start", "event_type", "n", F.round("total", 4).alias("total"))



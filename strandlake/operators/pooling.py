"""Pooled plates: which culture plate a read's block tells, and whether a layout is sound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kmers import joined_small


def deconvolve(reads: DataFrame, pools: DataFrame, blocks: DataFrame) -> DataFrame:
    """reads (plate_id, library_id, block) with culture_plate and culture_plate_status.

    pools: plate_id, culture_plate. blocks: library_id, block, culture_plate."""
    sources = pools.groupBy("plate_id").agg(F.array_sort(F.collect_set("culture_plate")).alias("_sources"))
    homes = blocks.groupBy("library_id", "block").agg(F.array_sort(F.collect_set("culture_plate")).alias("_homes"))
    told = joined_small(joined_small(reads, sources, ["plate_id"], "left"), homes, ["library_id", "block"], "left")
    both = F.array_intersect("_homes", "_sources")
    status = (
        F.when(F.col("block").isNull(), "unknown_block")
        .when(F.col("_sources").isNull(), "unknown_pcr_plate")
        .when(F.col("_homes").isNull(), "unknown_block")
        .when(F.size(both) == 1, "resolved")
        .when(F.size(both) == 0, "unexpected_block")
        .otherwise("ambiguous")
    )
    return told.withColumns({"culture_plate_status": status, "culture_plate": F.when(status == "resolved", F.get(both, F.lit(0)))}).drop("_sources", "_homes")


def of_alias_group(plates: Column, statuses: Column) -> Column:
    """status, culture_plate of a group of aliases: resolved if all agree on one plate, else the first status that is not, or ambiguous."""
    named = F.array_distinct(F.filter(plates, lambda p: p.isNotNull()))
    other = F.filter(statuses, lambda s: s != "resolved")
    status = F.when(F.size(other) > 0, F.array_min(other)).when(F.size(named) == 1, "resolved").otherwise("ambiguous")
    return F.struct(status.alias("status"), F.when(status == "resolved", F.get(named, F.lit(0))).alias("culture_plate"))


def reference_blocks(references: DataFrame, designs: DataFrame | None, pattern: str) -> DataFrame:
    """references with block: the design table's by sequence, else what the name states."""
    from ..functions.reads import block_of

    named = references.withColumn("_named", block_of(F.col("ref_id"), pattern))
    if designs is None:
        return named.withColumnRenamed("_named", "block")
    known = designs.groupBy("sequence").agg(F.min("block").alias("_design"))
    return named.join(known, "sequence", "left").withColumn("block", F.coalesce("_design", "_named")).drop("_named", "_design")


def pool_conflicts(pools: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rules a plan breaks: culture plates pooled but without blocks, blocks on plates pooled nowhere, and blocks that
    several plates of one pool share (nothing can tell those apart)."""
    row = lambda kind, subject: [F.lit(kind).alias("problem"), subject.cast("string").alias("subject")]
    pooled, placed = pools.select("culture_plate").distinct(), blocks.select("culture_plate").distinct()
    empty = pooled.join(placed, "culture_plate", "left_anti").select(*row("pooled_without_blocks", F.col("culture_plate")))
    orphan = placed.join(pooled, "culture_plate", "left_anti").select(*row("blocks_not_pooled", F.col("culture_plate")))
    shared = pools.join(blocks, "culture_plate").groupBy("plate_id", "library_id", "block").agg(F.count_distinct("culture_plate").alias("n")).where("n > 1")
    return empty.union(orphan).union(shared.select(*row("block_shared_in_pool", F.concat_ws("/", "plate_id", "library_id", "block"))))


def expected_clones(pools: DataFrame, blocks: DataFrame, clonality: DataFrame) -> DataFrame:
    """Clones expected in a well of each PCR plate: the blocks of its culture plates; null unless one clone per block was placed."""
    held = pools.join(blocks, "culture_plate", "left").groupBy("plate_id").agg(F.count_distinct(F.when(F.col("block").isNotNull(), F.struct("library_id", "block"))).alias("blocks"))
    told = held.join(clonality, "plate_id", "left")
    return told.select("plate_id", F.when(F.col("clonality") == "per_block", F.col("blocks")).alias("expected_clones"))


def layout_problems(layout: DataFrame, barcodes: DataFrame, routes: DataFrame, references: DataFrame) -> DataFrame:
    """Cross-checks of a layout (plate_id, culture_plate, library_id, block) against panels, routes and references, as rows of problem and subject."""
    row = lambda kind, subject: [F.lit(kind).alias("problem"), subject.cast("string").alias("subject")]
    block = ["library_id", "block"]
    blocks, refs = layout.select(*block).distinct(), references.select(*block).where("block is not null").distinct()
    plates = layout.select("plate_id").distinct()
    checks = [
        refs.join(blocks, block, "left_anti").select(*row("block_without_plate", F.concat_ws("/", *block))),
        blocks.join(refs, block, "left_anti").select(*row("block_without_reference", F.concat_ws("/", *block))),
        plates.join(barcodes.select(F.col("barcode_id").alias("plate_id")), "plate_id", "left_anti").select(*row("plate_without_barcode", F.col("plate_id"))),
        plates.join(routes.select("plate_id").distinct(), "plate_id", "left_anti").select(*row("plate_without_route", F.col("plate_id"))),
        layout.select("plate_id", "library_id").distinct().join(routes, ["plate_id", "library_id"], "left_anti").select(*row("library_not_routed", F.concat_ws("/", "plate_id", "library_id"))),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.union(c)
    return out


def culture_recovery(clones: DataFrame) -> DataFrame:
    """Sources per well and consensus per source, for clones (plate_id, well_id, culture_plate joined by bars, consensus_id, status)."""
    each = clones.withColumn("source", F.explode(F.split(F.coalesce("culture_plate", F.lit("")), "\\|"))).where("source <> ''")
    built = F.col("status") != "low_depth"
    return each.groupBy("plate_id", "well_id").agg(
        F.count_distinct(F.when(built, F.col("source"))).alias("sources"),
        F.count_distinct(F.when(built, F.col("consensus_id"))).alias("consensus"),
        F.count_if(~built).alias("below_depth"),
    )


def plate_grid(clones: DataFrame) -> DataFrame:
    """All 96 wells of every plate with the clones found in them, zeros too."""
    plates = clones.select("plate_id").distinct().withColumn("well_id", F.explode(F.array(*[F.lit(f"{r}{c:02d}") for r in "ABCDEFGH" for c in range(1, 13)])))
    held = clones.groupBy("plate_id", "well_id").agg(F.count_distinct("clone_id").alias("clones"))
    return plates.join(held, ["plate_id", "well_id"], "left").withColumn("clones", F.coalesce("clones", F.lit(0)))

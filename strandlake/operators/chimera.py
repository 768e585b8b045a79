"""Mosaic molecules: positional signatures, their groups, junctions and origins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dna import spliced
from ..functions.reads import block_of
from . import kmers

WINDOW, STEP = 90, 45
POLICIES = ("written", "all", "none")


@dataclass(frozen=True)
class ChimeraSettings:
    window: int = WINDOW
    step: int = STEP
    kmer: int = 15
    min_depth: int = 6
    min_score: float = 1.0
    block_pattern: str = r"^Block_(\d+)_"
    write_pcr: bool = False
    claims: str = "written"

    def __post_init__(self) -> None:
        if self.window < 1 or self.step < 1 or self.min_depth < 1 or self.claims not in POLICIES:
            raise ValueError(f"window, step and depth are positive, claims one of {', '.join(POLICIES)}")


def windows(inserts: DataFrame, width: int = WINDOW, step: int = STEP, seq: str = "insert") -> DataFrame:
    """One row for each window of an insert: window (number) and query. At least one; a short rest is left out."""
    if width < 1 or step < 1:
        raise ValueError("width and step are positive")
    starts = F.sequence(F.lit(0), F.greatest(F.length(seq) - width, F.lit(0)), F.lit(step))
    return inserts.select("*", F.posexplode(starts).alias("window", "_at")).withColumn("query", F.substring(F.col(seq), F.col("_at") + 1, F.lit(width))).drop("_at")


def window_calls(inserts: DataFrame, groups: DataFrame, k: int, width: int = WINDOW, step: int = STEP, least_score: float = 1.0, max_owners: int | None = None) -> DataFrame:
    """read_uid, window and the best reference of each window (null: none) for inserts of (read_uid, library_id, insert)."""
    if width < 1 or step < 1:
        raise ValueError("width and step are positive")
    index = kmers.build_index(groups, k, max_owners)
    rows = kmers.kmer_rows(inserts.select("read_uid", "library_id", F.col("insert").alias("query")), "query", k, ["read_uid", "library_id"], index, width, step)
    best = kmers.best_references(rows, index, ["read_uid", "library_id", "window"], 1, least_score)
    named = best.select("read_uid", "library_id", F.struct("window", F.split("alias_key", "\\|")[0].alias("name")).alias("call"))
    found = named.groupBy(F.col("read_uid").alias("_uid"), F.col("library_id").alias("_library")).agg(F.array_sort(F.collect_list("call")).alias("_calls"))
    # between two calls a null for each window without one: no row of a window is joined
    told = inserts.select("read_uid", "library_id", (F.floor(F.greatest(F.length("insert") - width, F.lit(0)) / step) + 1).cast("int").alias("_n"))
    told = told.join(found, F.col("read_uid").eqNullSafe(F.col("_uid")) & (F.col("library_id") == F.col("_library")), "left")
    none = F.lit(None).cast("string")
    before = lambda i: F.coalesce(F.get("_calls", i - 1)["window"], F.lit(-1))
    gaps = F.flatten(F.transform("_calls", lambda x, i: F.concat(F.array_repeat(none, x["window"] - before(i) - 1), F.array(x["name"]))))
    rest = F.array_repeat(none, F.greatest(F.col("_n") - 1 - F.coalesce(F.element_at("_calls", -1)["window"], F.lit(-1)), F.lit(0)))
    names = F.slice(F.concat(F.coalesce(gaps, F.array().cast("array<string>")), rest), F.lit(1), F.col("_n"))
    return told.select("read_uid", F.posexplode(names).alias("window", "name"))


def collapse(names: Column) -> Column:
    """The run of distinct names, nulls left out."""
    called = F.filter(names, lambda x: x.isNotNull())
    return F.aggregate(called, F.array().cast("array<string>"), lambda acc, x: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)) == x), acc).otherwise(F.concat(acc, F.array(x))))


def signatures(calls: DataFrame) -> DataFrame:
    """read_uid, names by window, signature and the windows at which the name changes."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("window", "name"))), lambda w: w["name"])
    order = Window.partitionBy("read_uid").orderBy("window")
    changed = calls.where("name is not null").withColumn("before", F.lag("name").over(order)).where("before <> name")
    junctions = changed.groupBy("read_uid").agg(F.array_sort(F.collect_list("window")).alias("junctions"))
    told = calls.groupBy("read_uid").agg(ordered.alias("windows")).withColumn("signature", collapse(F.col("windows")))
    return told.join(junctions, "read_uid", "left").withColumn("junctions", F.coalesce("junctions", F.array().cast("array<int>")))


def origin(signature: Column, pattern: str = r"^Block_(\d+)_") -> Column:
    """assembly: all parents of one block; pcr: of several; unknown: a parent without a block."""
    blocks = F.transform(signature, lambda r: block_of(r, pattern))
    return F.when(F.exists(blocks, lambda b: b.isNull()) | (F.size(signature) == 0), "unknown").when(F.size(F.array_distinct(blocks)) == 1, "assembly").otherwise("pcr")


def group_chimeras(reads: DataFrame, keys: list[str], min_depth: int = 6, pattern: str = r"^Block_(\d+)_") -> DataFrame:
    """Groups of reads (keys, read_uid, signature, junctions) with one signature of several parents, deep enough; the modal junction, the smallest of equal ones."""
    mosaic = reads.where(F.size("signature") > 1)
    sizes = mosaic.groupBy(*keys, "signature").agg(F.count(F.lit(1)).alias("size"), F.array_sort(F.collect_list("read_uid")).alias("read_uids")).where(F.col("size") >= min_depth)
    counted = mosaic.select(*keys, "signature", F.explode("junctions").alias("junction_window")).groupBy(*keys, "signature", "junction_window").count()
    modal = counted.groupBy(*keys, "signature").agg(F.min(F.struct((-F.col("count")).alias("minus"), "junction_window")).alias("m")).select(*keys, "signature", "m.junction_window")
    order = Window.partitionBy(*keys).orderBy(F.col("size").desc(), "signature") if keys else None
    told = sizes.join(modal, [*keys, "signature"], "left").withColumn("origin", origin(F.col("signature"), pattern))
    return told.withColumn("rank", F.row_number().over(order)) if keys else told


def outcomes(reads: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """How many reads and groups of each kind there are."""
    kind = F.when(F.size("signature") == 0, "unmatched").when(F.size("signature") == 1, "uniform").otherwise("chimeric_read")
    of_reads = reads.groupBy(kind.alias("outcome")).count()
    mosaic = reads.where(F.size("signature") > 1).join(groups.select(*keys, "signature", F.lit(True).alias("deep")), [*keys, "signature"], "left")
    of_depth = mosaic.groupBy(F.when(F.col("deep"), "in_group").otherwise("below_depth").alias("outcome")).count()
    of_groups = groups.groupBy(F.concat(F.lit("group_"), "origin").alias("outcome")).count()
    return of_reads.union(of_depth).union(of_groups)


def scaffolds(groups: DataFrame, references: DataFrame, step: int = STEP) -> DataFrame:
    """groups of two parents with the sequence spliced at their junction; others get the first parent's."""
    parent = lambda i, name: references.select(F.col("ref_id").alias(f"_p{i}"), F.col("sequence").alias(name))
    both = groups.withColumns({"_p0": F.get("signature", F.lit(0)), "_p1": F.get("signature", F.lit(1))}).join(parent(0, "_left"), "_p0", "left").join(parent(1, "_right"), "_p1", "left")
    made = F.when((F.size("signature") == 2) & F.col("junction_window").isNotNull(), spliced(F.col("_left"), F.col("_right"), F.col("junction_window"), F.lit(step))).otherwise(F.col("_left"))
    return both.withColumn("scaffold", made).drop("_p0", "_p1", "_left", "_right")


def claims(groups: DataFrame, policy: str = "written", written: Column | None = None) -> DataFrame:
    """read_uid and chimera_id of the reads that chimeric clones own. policy: written, all or none."""
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {', '.join(POLICIES)}")
    kept = groups.where(F.lit(False)) if policy == "none" else groups if policy == "all" else groups.where(written if written is not None else F.col("origin") != "pcr")
    return kept.select("chimera_id", F.explode("read_uids").alias("read_uid"))


def detect(inserts: DataFrame, alias_groups: DataFrame, references: DataFrame, keys: list[str], s: ChimeraSettings) -> DataFrame:
    """Chimeric clones of reads (keys with library_id, read_uid, insert): chimera_id, signature, reads, junction, origin, scaffold, written."""
    called = window_calls(inserts.select("read_uid", "library_id", "insert"), alias_groups, s.kmer, s.window, s.step, s.min_score)
    told = signatures(called).join(inserts.select("read_uid", *keys), "read_uid")
    found = scaffolds(group_chimeras(told, keys, s.min_depth, s.block_pattern), references, s.step)
    name = F.concat(F.lit("chim-"), F.substring(F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.array_join("signature", ">")), 256), 1, 16))
    return found.withColumns({"chimera_id": name, "written": (F.col("origin") != "pcr") | F.lit(s.write_pcr)})

"""Consensus by grouped pileup.

The kernel only aligns: it turns each read into counted observations (base, base of
low quality, deletion, insertion) at reference places, added up per batch before
the shuffle, so a deep group costs rows by places and not by reads. Everything
after that is grouped aggregation. Each place is judged by a majority, or by a
binomial test of every allele against the group's own error rate.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reads import stable_rank
from ..functions.statistics import binomial_upper_tail
from .bands import path_many
from .kmers import checkpointed, joined_small, spread

LOW_RATE, HIGH_RATE = 0.002, 0.25


@dataclass(frozen=True)
class ConsensusSettings:
    min_depth: int = 3
    max_reads: int = 100
    min_support: float = 0.60
    min_base_quality: int = 10
    significance: float = 0.05
    minor_fraction: float = 0.20
    caller: str = "statistical"
    seed: int = 0

    def __post_init__(self) -> None:
        if self.caller not in ("statistical", "majority") or self.max_reads < 0 or self.min_depth < 1:
            raise ValueError("caller is statistical or majority, max_reads is 0 (all) or more, min_depth 1 or more")


def group_reads(reads: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """reads with group_id of sample, plate, well, library and alias group; claimed reads are left out."""
    free = reads if claimed is None else reads.join(claimed.select("read_uid").distinct(), "read_uid", "left_anti")
    parts = ["sample_id", "plate_id", "well_id", "library_id", "alias_key"]
    return free.withColumn("group_id", F.concat_ws("\x1f", *[F.coalesce(c, F.lit("")) for c in parts]))


#: A threshold lets through so many reads more than are wanted: standard deviations of their number, and a few.
MARGIN, SPARE = 6, 16


def named_reads(reads: DataFrame, seed: int) -> DataFrame:
    """group_id, read_uid and the hash by which reads are chosen; a repeated name raises."""
    named = reads.groupBy("group_id", "read_uid").agg(F.count(F.lit(1)).alias("_n"))
    sound = F.when(F.col("_n") > 1, F.raise_error(F.lit("a read occurs twice in a group"))).otherwise(F.lit(True))
    return named.where(sound).select("group_id", "read_uid", stable_rank(F.col("read_uid"), F.col("group_id"), seed).alias("_hash"))


def chosen_names(hashed: DataFrame, most: int) -> DataFrame:
    """The first most names of each group (0: all) of written hashes, with selection_rank.

    A group's size tells below which hash about most of its reads lie, so that only these, little more than most, are ranked
    together whatever the size of the group. Groups of which too few lie below (hardly ever) are ranked whole."""
    order = Window.partitionBy("group_id").orderBy("_hash", "read_uid")
    ranked = (first_by_hash(hashed, most) if most else hashed).select("group_id", "read_uid", F.row_number().over(order).alias("selection_rank"))
    return ranked.where(F.col("selection_rank") <= most) if most else ranked


def select_reads(reads: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """The first most reads of each group by a hash of their names (0: all), with selection_rank; a repeated name raises.

    Names alone are ranked; the sequences meet the chosen names."""
    return joined_small(reads, chosen_names(checkpointed(named_reads(reads, seed), "named"), most), ["group_id", "read_uid"])


def first_by_hash(hashed: DataFrame, most: int) -> DataFrame:
    """Rows among which the first most of each group by _hash (hexadecimal digits) surely are; few more of large groups."""
    sizes = hashed.groupBy("group_id").agg(F.count(F.lit(1)).alias("_size"))
    large = checkpointed(sizes.where(F.col("_size") > most + MARGIN * most**0.5 + SPARE), "large-groups")
    if large.isEmpty():
        return hashed
    share = F.lit(most + MARGIN * most**0.5 + SPARE) / F.col("_size")
    at = F.conv(F.substring("_hash", 1, 13), 16, 10).cast("double") / float(1 << 52)
    told = joined_small(hashed, large, ["group_id"], "left")
    near = told.where(F.col("_size").isNull() | (at < share))
    short = near.where(F.col("_size").isNotNull()).groupBy("group_id").agg(F.count(F.lit(1)).alias("_below"))
    short = large.join(short, "group_id", "left").where(F.coalesce("_below", F.lit(0)) < most).select("group_id")
    if short.isEmpty():
        return near.select(*hashed.columns)
    return near.join(short, "group_id", "left_anti").select(*hashed.columns).unionByName(hashed.join(short, "group_id", "left_semi"))


def observations(reads: DataFrame, min_quality: int) -> DataFrame:
    """group_id, pos, kind (base, low, del, ins), allele, n for reads of (group_id, reference, sequence, quality)."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: Counter = Counter()
            groups, references, queries, qualities = (batch.column(c).to_pylist() for c in ("group_id", "reference", "sequence", "quality"))
            for group, query, quality, path in zip(groups, queries, qualities, path_many(queries, references), strict=True):
                qi = ri = 0
                for op, n in path:
                    if op in "=X":
                        for k in range(n):
                            good = quality is None or ord(quality[qi + k]) - 33 >= min_quality
                            held[group, ri + k, "base" if good else "low", query[qi + k]] += 1
                        qi, ri = qi + n, ri + n
                    elif op == "I":
                        held[group, ri, "ins", query[qi : qi + n]] += 1
                        qi += n
                    else:
                        held.update((group, ri + k, "del", "-") for k in range(n))
                        ri += n
            keys = list(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string()), pa.array([k[3] for k in keys], pa.string()), pa.array([held[k] for k in keys], pa.int64())],
                ["group_id", "pos", "kind", "allele", "n"],
            )

    rows = reads.select("group_id", "reference", "sequence", "quality").mapInArrow(kernel, "group_id string, pos int, kind string, allele string, n long")
    return rows.groupBy("group_id", "pos", "kind", "allele").agg(F.sum("n").alias("n"))


def places(counted: DataFrame) -> DataFrame:
    """One row for each group and place: base counts, observed, spanning, deletions and the best insertion."""
    of = lambda *kinds: F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col("n"))), F.lit(0))
    when = lambda kind, value: F.when(F.col("kind") == kind, value)
    insertion = F.min(when("ins", F.struct((-F.col("n")).alias("minus"), "allele")))
    grouped = counted.groupBy("group_id", "pos").agg(
        F.array_sort(F.collect_list(when("base", F.struct("allele", "n")))).alias("bases"),
        of("base").alias("observed"),
        (of("base", "low") + of("del")).alias("spanning"),
        of("del").alias("deletions"),
        of("low").alias("low_quality"),
        insertion.alias("insertion"),
    )
    return grouped.withColumn("insertion", F.when(F.col("insertion").isNotNull(), F.struct(F.col("insertion.allele").alias("bases"), (-F.col("insertion.minus")).alias("support"))))


def with_rates(placed: DataFrame) -> DataFrame:
    """placed with its group's substitution and deletion error and the number of places with any disagreement.

    A window, not a join, so the pileup is made once; a group has a row for each reference place."""
    own_group = Window.partitionBy("group_id")
    clamped = lambda values: F.least(F.greatest(F.coalesce(F.avg(values).over(own_group), F.lit(LOW_RATE)), F.lit(LOW_RATE)), F.lit(HIGH_RATE))
    own = F.coalesce(F.get(F.filter("bases", lambda b: b["allele"] == F.col("reference_base")), F.lit(0))["n"], F.lit(0))
    off = F.when(F.col("observed") > 0, (F.col("observed") - own) / F.col("observed"))
    gone = F.when(F.col("observed") + F.col("deletions") > 0, F.col("deletions") / (F.col("observed") + F.col("deletions")))
    return placed.withColumns({"substitution_error": clamped(off), "deletion_error": clamped(gone), "testable": F.greatest(F.count_if(off > 0).over(own_group), F.lit(1))})


def majority(alleles: Column) -> Column:
    """The most frequent allele, the smallest of equal ones."""
    return F.array_min(F.transform(alleles, lambda a: F.struct((-a["n"]).alias("minus"), a["allele"].alias("allele"))))["allele"]


def allele_calls(placed: DataFrame, s: ConsensusSettings) -> DataFrame:
    """placed (with rates and reference_base) with call: base, mixed, support, alleles and fractions."""
    depth = F.col("observed") + F.col("deletions")
    err, tests = F.col("substitution_error"), F.col("testable")
    count_of = lambda base: F.coalesce(F.get(F.filter("bases", lambda b: b["allele"] == base), F.lit(0))["n"], F.lit(0))
    significant = F.filter(
        "bases",
        lambda b: (b["n"] >= 2) & (b["n"] / depth >= s.minor_fraction) & (b["n"] > err * depth) & (binomial_upper_tail(b["n"], depth, err) * tests < s.significance),
    )
    told = placed.withColumn("winner", majority(F.col("bases"))).withColumn("significant", significant)
    call = lambda base, mixed, support, alleles=None: F.struct(base.alias("base"), F.lit(mixed).alias("mixed"), support.alias("support"), (alleles if alleles is not None else F.array().cast("array<struct<allele:string,n:bigint>>")).alias("alleles"))
    n, gap = F.lit("N"), F.lit("-")
    share = F.col("deletions") / F.when(F.col("spanning") > 0, F.col("spanning")).otherwise(depth)
    support = count_of(F.col("winner")) / depth
    statistical = (
        F.when(depth <= 0, call(n, False, F.lit(0.0)))
        .when((F.col("deletions") > 0) & (share >= s.min_support), call(gap, False, share))
        .when(F.size("bases") == 0, call(n, False, F.col("deletions") / depth))
        .when(F.size("significant") > 1, call(n, True, support, F.col("significant")))
        .when(F.col("winner") == F.col("reference_base"), call(F.col("winner"), False, support))
        .when(F.size("significant") == 1, F.when(F.get("significant", F.lit(0))["allele"] == F.col("winner"), call(F.col("winner"), False, support)).otherwise(call(n, False, support)))
        .otherwise(call(n, False, support))
    )
    if s.caller == "majority":
        every = F.when(F.col("deletions") > 0, F.concat("bases", F.array(F.struct(F.lit("-").alias("allele"), F.col("deletions").alias("n"))))).otherwise(F.col("bases"))
        told = told.withColumn("every", every).withColumn("top", majority(F.col("every")))
        top = F.coalesce(F.get(F.filter("every", lambda b: b["allele"] == F.col("top")), F.lit(0))["n"], F.lit(0)) / depth
        statistical = F.when(depth <= 0, call(n, False, F.lit(0.0))).when(top < s.min_support, call(n, False, top)).otherwise(call(F.col("top"), False, top))
    shallow = (F.col("observed") < s.min_depth) & (depth < s.min_depth)
    return told.withColumn("call", F.when(shallow, call(n, False, F.lit(1.0))).otherwise(statistical)).withColumn("depth", depth)


def accepted_insertion(s: ConsensusSettings, used: Column) -> Column:
    support = F.col("insertion.support")
    room = F.col("spanning") + support
    if s.caller == "majority":
        good = (support >= s.min_depth) & (support / used >= s.min_support)
    else:
        good = (support >= s.min_depth) & (support / room >= 0.5) & (binomial_upper_tail(support, room, F.col("deletion_error")) * F.col("testable") < s.significance)
    return F.when(F.col("insertion").isNotNull() & good, F.col("insertion.bases")).otherwise("")


def build_consensus(reads: DataFrame, s: ConsensusSettings) -> DataFrame:
    """One row for each group of reads (group_id, read_uid, reference, sequence, quality).

    Insertions after the last reference base are not part of a consensus."""
    hashed = checkpointed(named_reads(reads, s.seed), "named")
    chosen = joined_small(reads, checkpointed(chosen_names(hashed, s.max_reads), "chosen-names"), ["group_id", "read_uid"])
    if s.max_reads:  # a bounded number from each group
        chosen = checkpointed(chosen, "chosen")
    sizes = hashed.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_reads_available"))
    groups = checkpointed(sizes.join(chosen.groupBy("group_id").agg(F.first("reference").alias("reference")), "group_id"), "groups")
    used = chosen.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_reads_used"), F.transform(F.array_sort(F.collect_list(F.struct("selection_rank", "read_uid"))), lambda r: r["read_uid"]).alias("contributors"))
    deep = used.where(F.col("n_reads_used") >= s.min_depth).select("group_id", "n_reads_used")
    deeply = chosen.join(deep.select("group_id"), "group_id", "left_semi").repartition(spread(reads.sparkSession), "group_id", "read_uid")
    counted = observations(deeply, s.min_base_quality)
    placed = places(counted).join(groups.select("group_id", "reference"), "group_id").where(F.col("pos") < F.length("reference"))
    placed = placed.withColumn("reference_base", F.substring("reference", F.col("pos") + 1, 1)).drop("reference")
    rated = with_rates(placed).join(deep, "group_id")
    called = allele_calls(rated, s).withColumn("piece", F.concat(accepted_insertion(s, F.col("n_reads_used")), F.when(F.col("call.base") == "-", "").otherwise(F.col("call.base"))))
    mixed = F.when(F.col("call.mixed"), F.struct("pos", F.col("reference_base").alias("ref"), F.array_join("call.alleles.allele", "").alias("alleles"), F.transform("call.alleles", lambda a: a["n"] / F.col("depth")).alias("fractions")))
    built = called.groupBy("group_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda p: p["piece"]), "").alias("sequence"),
        F.avg("depth").alias("mean_depth"),
        F.min("depth").alias("min_depth"),
        F.count_if(F.col("call.base") == "N").alias("ambiguous_bases"),
        F.array_sort(F.collect_list(mixed)).alias("mixed_alleles"),
        F.first("substitution_error").alias("background_error_rate"),
        F.first("deletion_error").alias("deletion_error_rate"),
        F.min("call.support").alias("weakest_support"),
        F.sum("low_quality").alias("low_quality_bases"),
    )
    out = groups.join(used, "group_id").join(built, "group_id", "left")
    low = F.col("n_reads_used") < s.min_depth
    status = F.when(low, "low_depth").when(F.col("ambiguous_bases") > 0, "mixed_variants").otherwise("consensus_pass")
    name = F.concat(F.lit("cons-"), F.substring(F.sha2(F.concat_ws("\x1e", "group_id", F.coalesce("sequence", F.lit(""))), 256), 1, 16))
    return out.withColumns({"status": status, "consensus_id": name, "failure_reason": F.when(low, F.format_string(f"requires at least {s.min_depth} reads")), "mixed_positions": F.coalesce(F.size("mixed_alleles"), F.lit(0))})


def contributors(built: DataFrame) -> DataFrame:
    return built.select("consensus_id", F.posexplode("contributors").alias("place", "read_uid")).select("consensus_id", "read_uid", (F.col("place") + 1).alias("selection_rank"))

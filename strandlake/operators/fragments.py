"""Oligo designs: fragments that assemble a gene, interchangeable variants, slot owners."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dna import excisions
from .alignment import global_path
from .bands import path_many
from .distances import pieces as cut

OVERHANG = 4
MAX_SLOTS = 64


@dataclass(frozen=True)
class Piece:
    slot: int
    sequence: str
    start: int
    end: int


def bodies(oligo: str, left: str = "GGTCTC", right: str = "GAGACC", spacer: int = 1) -> list[str]:
    """What an oligo may release: each left site with each later right site."""

    def places(motif: str) -> list[int]:
        return [i for i in range(len(oligo) - len(motif) + 1) if oligo.startswith(motif, i)]

    spans = ((i + len(left) + spacer, j - spacer) for i in places(left) for j in places(right))
    return [oligo[a:b] for a, b in spans if b - a >= 2 * OVERHANG]


def assemble(oligos: list[str], gene: str) -> list[Piece] | None:
    """One body of each oligo, neighbours joined by equal overhangs, that give the gene between the outer overhangs; None if none do.

    States are the lengths assembled so far: whatever agrees with the gene up to there is one state."""
    target_at = {}  # length assembled (outer overhang included) -> the pieces that led there
    for slot, oligo in enumerate(oligos):
        following = {}
        for body in bodies(oligo):
            ways = [(0, ())] if slot == 0 else target_at.items()
            for length, pieces in ways:
                start = length - OVERHANG if slot else 0
                # gene coordinates start after the first overhang
                inner_from, inner_to = max(start, OVERHANG), start + len(body) - (OVERHANG if slot == len(oligos) - 1 else 0)
                if slot and pieces[-1].sequence[-OVERHANG:] != body[:OVERHANG]:
                    continue
                inside = body[inner_from - start : inner_to - start]
                if gene[inner_from - OVERHANG : inner_to - OVERHANG] == inside and inner_to - OVERHANG <= len(gene):
                    following.setdefault((start + len(body), body[-OVERHANG:]), (*pieces, Piece(slot, body, start - OVERHANG, start + len(body) - OVERHANG)))
        target_at = {}
        for (length, _), pieces in following.items():
            target_at.setdefault(length, pieces)
    done = target_at.get(len(gene) + 2 * OVERHANG)
    return list(done) if done else None


def assembled_fragments(designs: DataFrame) -> DataFrame:
    """gene_id, block, n_slots, assembled and the pieces of every design (gene_id, block, oligos, gene)."""
    if "block" not in designs.columns:
        raise ValueError("designs name their block")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("slot", pa.int32()), ("sequence", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in (part for whole in batches for part in cut(whole, ("oligos", "gene"))):
            designs = batch.column("oligos").to_pylist()
            found = [assemble(o, g) if o and g is not None else None for o, g in zip(designs, batch.column("gene").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("gene_id"), batch.column("block"), pa.array([len(o or ()) for o in designs], pa.int32()), pa.array([f is not None for f in found]), pa.array([[p.__dict__ for p in f or ()] for f in found], kind)],
                ["gene_id", "block", "n_slots", "assembled", "pieces"],
            )

    return designs.select("gene_id", "block", "oligos", "gene").mapInArrow(kernel, "gene_id string, block string, n_slots int, assembled boolean, pieces array<struct<slot:int,sequence:string,start:int,end:int>>")


def overhang_pairs(pieces: DataFrame) -> DataFrame:
    """pieces (gene_id, block, slot, sequence) with their outer four bases."""
    return pieces.withColumns({"overhang_5": F.substring("sequence", 1, OVERHANG), "overhang_3": F.substring("sequence", -OVERHANG, OVERHANG)})


def interchangeable(pieces: DataFrame) -> DataFrame:
    """Within a block, pieces of different genes with the same pair of overhangs: how many genes and sequences share it."""
    return overhang_pairs(pieces).groupBy("block", "overhang_5", "overhang_3").agg(F.count_distinct("gene_id").alias("genes"), F.count_distinct("sequence").alias("variants")).where("genes > 1")


def excised(oligos: DataFrame, seq: str = "sequence") -> DataFrame:
    return oligos.withColumn("body", F.explode(excisions(F.col(seq))))


def slot_owners(parts: DataFrame, pieces: DataFrame) -> DataFrame:
    """For each part of a read (uid, block, slot, part) the design whose piece is nearest, and the margin in identity to the next design."""
    pairs = parts.join(pieces.select("block", "slot", F.col("gene_id").alias("owner"), F.col("sequence").alias("piece")), ["block", "slot"])
    scored = pairs.withColumn("identity", 1 - F.levenshtein("part", "piece") / F.greatest(F.length("part"), F.length("piece"), F.lit(1)))
    order = Window.partitionBy("uid", "slot").orderBy(F.col("identity").desc(), "owner")
    return scored.withColumns({"rank": F.row_number().over(order), "next": F.lead("identity").over(order)}).where("rank = 1").select("uid", "block", "slot", "owner", "identity", (F.col("identity") - F.coalesce("next", F.lit(0.0))).alias("margin"))


def common_owners(owners: DataFrame) -> DataFrame:
    """uid and the designs that own every slot of a read, for owners of (uid, slot, owner) with several owners a slot."""
    slots = owners.groupBy("uid").agg(F.count_distinct("slot").alias("slots"))
    held = owners.groupBy("uid", "owner").agg(F.count_distinct("slot").alias("held")).join(slots, "uid").where("held = slots")
    every = held.groupBy("uid").agg(F.array_sort(F.collect_list("owner")).alias("common"))
    return slots.join(every, "uid", "left").select("uid", F.coalesce("common", F.array().cast("array<string>")).alias("common"))


def donor_pairs(owners: DataFrame, chimeric: DataFrame, most: int = 8) -> DataFrame:
    """The most frequent pairs of first and last slot's owner (the smallest of several) among chimeric reads, and their reads."""
    ends = owners.join(chimeric.select("uid"), "uid", "left_semi").groupBy("uid").agg(F.min(F.struct("slot", "owner"))["owner"].alias("left"), F.min(F.struct((-F.col("slot")).alias("minus"), "owner"))["owner"].alias("right"))
    return ends.groupBy("left", "right").agg(F.count(F.lit(1)).alias("reads")).orderBy(F.desc("reads"), "left", "right").limit(most)


def library_summary(designs: DataFrame) -> DataFrame:
    """Genes, blocks, pieces and genes of one piece of a design table (gene_id, block, oligos), in one row."""
    n = F.size(F.coalesce("oligos", F.array().cast("array<string>")))
    return designs.agg(F.count_distinct("gene_id").alias("genes"), F.count_distinct("block").alias("blocks"), F.sum(n).alias("fragments"), F.count_if(n == 1).alias("single_fragment_genes"), F.max(n).alias("most_fragments"))


def project_spans(query: str, design: str, spans: list[tuple[int, int]], path: list[tuple[str, int]] | None = None) -> list[str]:
    """What of a query lies on each span of its design; inserted bases belong to the span of the next base. path: that of the two, if known."""
    out, at = [""] * len(spans), 0
    where = lambda k: next((i for i, (a, b) in enumerate(spans) if a <= k < b), None)
    qi = 0
    for op, n in global_path(query, design) if path is None else path:
        for _ in range(n):
            if op != "D":
                i = where(min(at, len(design) - 1))
                if i is not None:
                    out[i] += query[qi]
                qi += 1
            at += op != "I"
    return out


def read_parts(reads: DataFrame, genes: DataFrame) -> DataFrame:
    """uid, block, slot, part of every piece of the design each read is anchored by; a part shorter than half its piece is left out.

    reads: uid, gene_id, query. genes: gene_id, block, sequence, pieces (slot, start, end)."""
    both = reads.join(genes.select("gene_id", "block", "sequence", F.transform(F.array_sort("pieces"), lambda p: F.struct(p["slot"].alias("slot"), p["start"].alias("start"), p["end"].alias("end"))).alias("pieces")), "gene_id")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            uids, blocks, queries, designs, every = (batch.column(c).to_pylist() for c in ("uid", "block", "query", "sequence", "pieces"))
            paths = path_many([q or "" for q in queries], [d or "" for d in designs])
            for uid, block, query, design, pieces, path in zip(uids, blocks, queries, designs, every, paths, strict=True):
                parts = project_spans(query or "", design, [(p["start"], p["end"]) for p in pieces], path) if design else []
                rows += [(uid, block, p["slot"], part) for p, part in zip(pieces, parts, strict=False) if 2 * len(part) >= p["end"] - p["start"]]
            kinds = (pa.string(), pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["uid", "block", "slot", "part"])

    return both.select("uid", "block", "query", "sequence", "pieces").mapInArrow(kernel, "uid string, block string, slot int, part string")


def assembly_outcome(owners: DataFrame, slots: DataFrame, min_identity: float = 0.9, min_margin: float = 0.02) -> DataFrame:
    """intact: one design owns all slots; chimeric: several; missing: a slot has no part; unresolved: an owner is unsure."""
    sure = (F.col("identity") >= min_identity) & (F.col("margin") >= min_margin)
    told = owners.groupBy("uid", "block").agg(F.count(F.lit(1)).alias("found"), F.bool_and(sure).alias("sure"), F.array_sort(F.collect_set("owner")).alias("owners"))
    joined = told.join(slots, "block")
    state = F.when(F.col("found") < F.col("n_slots"), "missing").when(~F.col("sure"), "unresolved").when(F.size("owners") == 1, "intact").otherwise("chimeric")
    return joined.withColumn("outcome", state)

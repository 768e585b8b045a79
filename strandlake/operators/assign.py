"""Assignment of reads to references: a k-mer cascade, then alignment.

For each k, from the largest on, the reads still without a match are joined with
the k-mer index, the best few references by specificity are aligned, and the read
is decided on all that it has met so far; an unambiguous or ambiguous decision
ends its cascade. Reads without any are rescued with more candidates, or with all
references. Each pair of read and reference is aligned once, all pairs of a batch side
by side; of a read's candidates only those that may be its two best are told exactly.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kmers
from .bands import place_many
from .distances import pieces
from .flanks import Flanks
from .motifs import MotifPair

#: Bytes of the sequences whose pairs are aligned at once: the more, the fuller the lanes.
PAIR_BYTES = 32 << 20
GEOMETRY = "edit_distance int, identity double, query_coverage double, reference_coverage double, query_start int, query_end int, reference_start int, reference_end int"
_FIELDS = [(f.split()[0], {"int": pa.int32(), "double": pa.float64()}[f.split()[1]]) for f in GEOMETRY.split(", ")]


@dataclass(frozen=True)
class AssignSettings:
    kmer_sizes: tuple[int, ...] = (15, 11, 9)
    max_kmer_owners: int | None = 10
    candidates: int = 5
    min_score: float = 2.0
    min_identity: float = 0.80
    min_query_coverage: float = 0.70
    min_reference_coverage: float = 0.70
    min_margin: float = 0.02
    rescue: str = "kmer"
    rescue_candidates: int = 25

    def __post_init__(self) -> None:
        if self.rescue not in ("none", "kmer", "all") or list(self.kmer_sizes) != sorted(set(self.kmer_sizes), reverse=True) or not self.kmer_sizes:
            raise ValueError("rescue is none, kmer or all; k-mer sizes fall")


def passes(s: AssignSettings, pair: Column) -> Column:
    return (pair["identity"] >= s.min_identity) & (pair["query_coverage"] >= s.min_query_coverage) & (pair["reference_coverage"] >= s.min_reference_coverage)


def with_decision(df: DataFrame, s: AssignSettings, pairs: str = "pairs") -> DataFrame:
    """df with best (the best pair of an array of them; null without any), second_identity, assignment_status and identity_margin.

    A pair without an identity is none of the two best."""
    told = F.filter(pairs, lambda p: p["identity"].isNotNull())
    keys = F.transform(told, lambda p: F.struct(-p["identity"], -F.least(p["query_coverage"], p["reference_coverage"]), p["edit_distance"], -p["score"], p["alias_key"], p.alias("pair")))
    ranked = df.withColumn("_ranked", F.array_sort(keys))
    ranked = ranked.withColumns({"best": F.get("_ranked", F.lit(0))["pair"], "_second": F.get("_ranked", F.lit(1))["pair"]})
    margin = F.col("best.identity") - F.col("_second.identity")
    close = F.coalesce(passes(s, F.col("_second")) & (margin < s.min_margin), F.lit(False))
    single = F.instr("best.alias_key", "|") == 0
    status = F.when(F.col("best").isNull() | ~passes(s, F.col("best")), "no_match").when(close, "ambiguous").when(single, "assigned_unique").otherwise("assigned_alias_set")
    return ranked.withColumns({"second_identity": F.col("_second.identity"), "assignment_status": status, "identity_margin": margin}).drop("_ranked", "_second")


def decide(aligned: DataFrame, s: AssignSettings, uid: str = "read_uid") -> DataFrame:
    """One row for each read with aligned candidates: its status, best reference and margin."""
    rows = aligned.groupBy(uid).agg(F.collect_list(F.struct(*[c for c in aligned.columns if c != uid])).alias("pairs"))
    return with_decision(rows, s).select(uid, "best.*", "second_identity", "assignment_status", "identity_margin")


def aligned(pairs: DataFrame, rivals: str | None = None) -> DataFrame:
    """pairs (with query and sequence) and their geometry. With rivals (a column that names the read) pairs are left without
    one where two others of the read are nearer, which spares most of the work on far candidates."""
    keep = [f for f in pairs.schema.fields if f.name not in ("query", "sequence")]
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in keep)}, {GEOMETRY}"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, ("query", "sequence"), PAIR_BYTES):
                found = place_many(part.column("query").to_pylist(), part.column("sequence").to_pylist(), part.column(rivals).to_pylist() if rivals else None)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), *(pa.array(found[n], t) for n, t in _FIELDS)], [*(f.name for f in keep), *(n for n, _ in _FIELDS)])

    return pairs.mapInArrow(kernel, schema)


PAIR = f"alias_key string, matches long, score double, step int, {GEOMETRY}"


def assign_reads(queries: DataFrame, groups: DataFrame, s: AssignSettings, keep_stage=None, uid: str = "read_uid") -> DataFrame:
    """uid, assignment_status, alias_key, kmer_size and geometry of every query (uid, library_id, query).

    A step is one table: the reads that wait, each with the pairs it has met as an array, and what they decide.
    keep_stage(df, name) writes a stage's table and reads it back; by default a checkpoint does."""
    keep = keep_stage or kmers.checkpointed
    lookup = groups.select("library_id", "alias_key", "sequence")
    met = f"array<struct<{', '.join(f.replace(' ', ':') for f in PAIR.split(', '))}>>"
    waiting = queries.select(uid, "library_id", "query", F.array().cast(met).alias("pairs"), F.lit(None).cast("int").alias("kmer_size"))
    decided: list[DataFrame] = []

    def meet(found: DataFrame, step: int, k: int, last: bool) -> DataFrame:
        new = kmers.joined_small(found.select(uid, "library_id", "alias_key", "matches", "score"), lookup, ["library_id", "alias_key"])
        known = F.exists("pairs", lambda p: p["alias_key"] == F.col("alias_key"))
        # a number of its own keeps Spark from joining partitions by their bytes: the kernel's time goes by pairs
        parts = kmers.spread(queries.sparkSession)
        pairs = new.drop("library_id").repartition(parts, uid).join(waiting.select(uid, "query", "pairs").repartition(parts, uid), uid).where(~known)
        fresh = aligned(pairs.select(uid, "alias_key", "matches", "score", F.lit(step).alias("step"), "query", "sequence"), uid)
        fresh = fresh.where("identity is not null") if last else fresh  # no later step would meet them again
        fields = [F.col(f.split()[0]) for f in PAIR.split(", ")]
        fresh = fresh.groupBy(uid).agg(F.collect_list(F.struct(*fields)).alias("_fresh"))
        every = F.concat("pairs", F.coalesce("_fresh", F.array().cast(met))).cast(met)
        sizes = F.when(F.col("_fresh").isNotNull(), F.lit(k)).otherwise(F.col("kmer_size"))
        joined = waiting.join(fresh, uid, "left").select(uid, "library_id", "query", every.alias("pairs"), sizes.alias("kmer_size"))
        table = keep(with_decision(joined, s), f"step-{step}")
        decided.append(table.where("assignment_status <> 'no_match'"))
        return table.where("assignment_status = 'no_match'")

    steps, index = list(s.kmer_sizes), None
    for step, k in enumerate(steps):
        index = keep(kmers.build_index(groups, k, s.max_kmer_owners), f"index-{k}")
        waiting = meet(kmers.shortlist(waiting, index, k, s.candidates, s.min_score, uid), step, k, s.rescue == "none" and k == steps[-1])
    if s.rescue == "kmer":
        waiting = meet(kmers.shortlist(waiting, index, steps[-1], s.rescue_candidates, 0.0, uid), len(steps), steps[-1], True)
    elif s.rescue == "all":
        # every reference of the read's own library, for the reads that nothing else placed
        found = waiting.select(uid, "library_id").join(groups.select("library_id", "alias_key"), "library_id").withColumns({"matches": F.lit(0).cast("long"), "score": F.lit(0.0)})
        waiting = meet(found, len(steps), steps[-1], True)
    out = functools.reduce(DataFrame.unionByName, [*decided, waiting])
    return out.select(uid, "library_id", "best.*", "second_identity", "assignment_status", "identity_margin", "kmer_size")


def route_plates(reads: DataFrame, routes: DataFrame, libraries: list[str], plate: str = "plate_id") -> DataFrame:
    """reads with library_id and a routing status. No routes and one library: that one; a plate without a route is unmapped."""
    if routes.isEmpty():
        only = F.lit(libraries[0] if len(libraries) == 1 else None).cast("string")
        joined = reads.withColumn("library_id", only)
    else:
        joined = kmers.joined_small(reads, routes.select(plate, "library_id"), [plate], "left")
    return joined.withColumn("routing", F.when(F.col("library_id").isNull(), "unmapped_reference_library").otherwise("routed"))


@dataclass(frozen=True)
class InsertFinder:
    """The insert of a read that may span its constant regions: between its own boundaries, else by offset between the primers."""

    inner: MotifPair
    outer: MotifPair
    head: int
    tail: int

    @classmethod
    def of(cls, flanks: Flanks, max_edits: int) -> InsertFinder:
        left, right = flanks.inner
        return cls(MotifPair(*flanks.insert_anchors, max_edits), MotifPair(*flanks.anchors, max_edits), len(left), len(right))

    def insert_of(self, read: str) -> str | None:
        own = self.inner.extract(read)
        if own["status"] == "found" and own["insert"]:
            return own["insert"]
        region = self.outer.extract(read)
        if region["status"] != "found" or len(region["insert"] or "") <= self.head + self.tail:
            return None
        return region["insert"][self.head : len(region["insert"]) - self.tail]


def with_inserts(reads: DataFrame, finders: dict[str, InsertFinder], seq: str = "sequence", name: str = "own_insert") -> DataFrame:
    """reads (with library_id) and the insert that their library's finder tells; null for other libraries and where none is found."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in reads.schema.fields)}, `{name}` string"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [finders[lib].insert_of(s) if s and lib in finders else None for s, lib in zip(batch.column(seq).to_pylist(), batch.column("library_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, name])

    return reads.mapInArrow(kernel, schema)


def insert_geometry(reads: DataFrame, insert: str = "own_insert", reference: str = "reference_insert") -> DataFrame:
    """reads with insert_identity and insert_query_coverage of two columns; null where either is missing."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in reads.schema.fields)}, insert_identity double, insert_query_coverage double"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries, references = batch.column(insert).to_pylist(), batch.column(reference).to_pylist()
            both = [bool(q and r) for q, r in zip(queries, references, strict=True)]
            told = place_many([q or "" for q in queries], [r or "" for r in references])
            columns = [pa.array([x if known else None for x, known in zip(told[n], both, strict=True)], pa.float64()) for n in ("identity", "query_coverage")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "insert_identity", "insert_query_coverage"])

    return reads.mapInArrow(kernel, schema)


def insert_gate(identity: Column, coverage: Column, min_identity: float, min_coverage: float, status: Column) -> Column:
    """insert_mismatch where an assigned read's insert is too far from its reference's; unknown inserts pass."""
    bad = (identity < min_identity) | (coverage < min_coverage)
    return F.when(status.startswith("assigned") & F.coalesce(bad, F.lit(False)), "insert_mismatch").otherwise(status)

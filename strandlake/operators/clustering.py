"""Reference-free clusters of the reads of one well.

The reads are projected on a polished scaffold; places where a second allele is
frequent enough describe each read, and reads gather round centres that differ from
them in few of those places, with the centres taken anew until nothing moves. A well
of up to WELL_LIMIT reads is in one task, with others up to BLOCK reads, whose
alignments go side by side. In a larger one the reads are projected and counted where
they lie, and one task gathers only the few bases that describe each read; the results
are the same. Beyond VECTOR_LIMIT reads of one well, an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kmers import checkpointed, spread
from .projections import project_many

WELL_LIMIT = 20_000
BLOCK = 4096
VECTOR_LIMIT = 4_000_000
SALTS = 64
SLICE = 256
ROUNDS = 5
GAP = "-"
BASES = "ACGTRYSWKMBDHVN"


# Fixed value: what is said of a well whose reads differ in too few places.
FEW_PLACES = "too few variant places to split"


@dataclass(frozen=True)
class ClusterSettings:
    min_size: int = 6
    min_allele: float = 0.20
    max_mismatch: float = 0.40
    min_places: int = 3
    min_comparable: float = 0.5

    def __post_init__(self) -> None:
        if self.min_size < 1 or not 0 < self.min_allele < 0.5:
            raise ValueError("clusters have one read or more, an allele less than half of them")


def matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    """A row for each read: its base (or gap) at each place of the scaffold."""
    return np.array(rows, "U1").reshape(len(rows), width)


def alphabet(rows: np.ndarray) -> list[str]:
    """The bases of the rows, in order, without the gap."""
    codes, seen = rows.view(np.uint32), set()
    for i in range(0, len(codes), SLICE):
        seen.update(np.unique(codes[i : i + SLICE]).tolist())
    return [chr(c) for c in sorted(seen) if c != ord(GAP)]


def counts(rows: np.ndarray, base: str) -> np.ndarray:
    """How many rows have the base, by column."""
    return np.count_nonzero(rows.view(np.uint32) == ord(base), axis=0)


def modal(rows: np.ndarray) -> np.ndarray:
    """The most frequent base of each column, the first of equal ones, gap if all are."""
    if len(rows) == 1:
        return rows[0]
    bases = alphabet(rows)
    if not bases:
        return np.full(rows.shape[1], GAP)
    votes = np.array([counts(rows, b) for b in bases])
    best = votes.argmax(0)
    return np.where(votes.max(0) > 0, np.array(bases)[best], GAP)


def seed_of(reads: list[str]) -> int:
    """The read whose length is nearest the median."""
    middle = sorted(map(len, reads))[len(reads) // 2]
    return min(range(len(reads)), key=lambda i: (abs(len(reads[i]) - middle), i))


def variant_places(rows: np.ndarray, s: ClusterSettings) -> np.ndarray:
    """Columns deep enough whose second allele is frequent enough."""
    present = alphabet(rows)
    votes = np.sort(np.array([counts(rows, b) if b in present else np.zeros(rows.shape[1], int) for b in BASES]), 0)
    depth = votes.sum(0)
    return np.flatnonzero((depth >= max(s.min_size, 2)) & (votes[-2] > 0) & (votes[-2] >= s.min_allele * depth))


class _Centres:
    """Centres in the order they came; equal rows look only at those that are new since.

    A row is held against all of them at once."""

    def __init__(self, centres: list[np.ndarray], required: int, most: float):
        self.rows: list[np.ndarray] = []
        self.required, self.most = required, most
        self.usable: list[int] = []
        self.seen: dict[bytes, tuple[int, tuple[int, int] | None]] = {}
        self.held = np.zeros((0, 0), "U1")
        for c in centres:
            self.add(c)

    def add(self, row: np.ndarray) -> int:
        if (row != GAP).sum() >= self.required:  # others share too few places with any read
            at = len(self.usable)
            if at == len(self.held):
                self.held = np.concatenate([self.held.reshape(at, len(row)), np.full((max(16, at), len(row)), GAP)])
            self.held[at] = row
            self.usable.append(len(self.rows))
        self.rows.append(row)
        return len(self.rows) - 1

    def nearest(self, row: np.ndarray) -> int | None:
        key = row.tobytes()
        start, best = self.seen.get(key, (0, None))
        stop = len(self.usable)
        if start < stop:
            own, rows = row.view(np.uint32), self.held[start:stop].view(np.uint32)
            known = own != ord(GAP)
            both = np.count_nonzero((rows != ord(GAP)) & known, axis=1)
            off = both - np.count_nonzero((rows == own) & known, axis=1)
            able = np.flatnonzero((both >= self.required) & (both > 0))
            able = able[off[able] / both[able] <= self.most]
            if able.size:
                k = int(able[np.argmin(off[able])])
                if best is None or off[k] < best[0]:
                    best = int(off[k]), self.usable[start + k]
        self.seen[key] = stop, best
        return best[1] if best else None


def gather(names: list[str], vectors: np.ndarray, s: ClusterSettings) -> tuple[list[int | None], str]:
    """For each read its cluster by the bases that describe it, and why."""
    n, width = vectors.shape
    known = (vectors != GAP).sum(1)
    order = sorted(range(n), key=lambda i: (-known[i], names[i]))
    required = max(s.min_places, int(s.min_comparable * width))
    centres: list[np.ndarray] = []
    members: list[list[int]] = []
    for attempt in range(ROUNDS + 1):
        at = _Centres(centres, required, s.max_mismatch)
        groups: list[list[int]] = [[] for _ in centres]
        for i in order:
            k = at.nearest(np.ascontiguousarray(vectors[i]))
            if k is None:
                k = at.add(vectors[i])
                groups.append([])
            groups[k].append(i)
        if attempt and groups == members:
            break
        members = groups
        if attempt < ROUNDS:
            centres = [modal(vectors[g]) for g in members if g]
    big = sorted((g for g in members if len(g) >= s.min_size), key=lambda g: -len(g))
    if len(big) < 2:
        return [0] * n, "one cluster is deep enough: one clone"
    out: list[int | None] = [None] * n
    for k, g in enumerate(big):
        for i in g:
            out[i] = k
    return out, f"{len(big)} clusters"


def clusters(wells: list[tuple[list[str], list[str]]], s: ClusterSettings = ClusterSettings()) -> list[tuple[list[int | None], list[int], str]]:
    """For the names and reads of each well: the cluster of each read (largest first; None: in none), the variant places, and why.

    Reads of all wells are aligned side by side, and a second time only where polishing changes the scaffold."""
    out: list = [([None] * len(reads), [], "too few reads") for _, reads in wells]
    scaffolds = {k: reads[seed_of(reads)] for k, (_, reads) in enumerate(wells) if len(reads) >= s.min_size}
    rows: dict[int, np.ndarray] = {}
    again = list(scaffolds)
    for first in (True, False):
        laid = iter(project_many([q for k in again for q in wells[k][1]], [scaffolds[k] for k in again for _ in wells[k][1]], GAP))
        for k in again:
            rows[k] = matrix([next(laid) for _ in wells[k][1]], len(scaffolds[k]))
        if first:
            polished = {k: "".join(b for b in modal(rows[k]) if b != GAP) for k in again}
            again = [k for k in again if polished[k] != scaffolds[k]]
            scaffolds |= polished
    for k, (names, reads) in enumerate(wells):
        if k in rows:
            own = rows.pop(k)
            places = variant_places(own, s)
            if len(places) < s.min_places:
                out[k] = [0] * len(reads), places.tolist(), FEW_PLACES
            else:
                found, why = gather(names, own[:, places], s)
                out[k] = found, places.tolist(), why
    return out


def cluster(names: list[str], reads: list[str], s: ClusterSettings = ClusterSettings()) -> tuple[list[int | None], list[int], str]:
    """`clusters` of one well."""
    return clusters([(names, reads)], s)[0]


def _laid(reads: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """_well, read_uid, row: the bases of the reads at the places of the scaffold of their well."""

    def lay(batches):
        for pdf in batches:
            for i in range(0, len(pdf), BLOCK):
                own = pdf.iloc[i : i + BLOCK]
                rows = project_many(own["sequence"].tolist(), own["scaffold"].tolist(), GAP)
                yield pd.DataFrame({"_well": own["_well"], "read_uid": own["read_uid"], "row": [x.tobytes().decode("utf-32-le") for x in rows]})

    return checkpointed(_meet(reads, scaffolds).mapInPandas(lay, "_well string, read_uid string, row string"), "rows")


def _rows(texts: pd.Series) -> np.ndarray:
    """Rows of one length as a matrix."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), "U1").reshape(len(texts), -1)


def _votes(laid: DataFrame) -> DataFrame:
    """_well, position, base, n over rows."""

    def count(batches):
        for pdf in batches:
            for name, own in pdf[pdf["row"] != ""].groupby("_well", dropna=False, sort=False):
                votes: dict[str, np.ndarray] = {}
                for i in range(0, len(own), SLICE):
                    rows = _rows(own["row"].iloc[i : i + SLICE])
                    for b in alphabet(rows):
                        votes[b] = votes.get(b, 0) + counts(rows, b)
                for b, n in votes.items():
                    at = np.flatnonzero(n)
                    yield pd.DataFrame({"_well": None if pd.isna(name) else name, "position": at, "base": b, "n": n[at]})

    return laid.mapInPandas(count, "_well string, position long, base string, n long").groupBy("_well", "position", "base").agg(F.sum("n").alias("n"))


def _meet(reads: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """Reads with the row of their well; a well's reads are spread over SALTS keys."""
    a = reads.withColumn("_salt", F.pmod(F.xxhash64("read_uid", "sequence"), F.lit(SALTS)))
    b = scaffolds.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).withColumnRenamed("_well", "_at")
    return a.join(b, (F.col("_well").eqNullSafe(F.col("_at"))) & (a["_salt"] == b["_salt"])).drop("_at", "_salt")


def _spread(reads: DataFrame, s: ClusterSettings) -> DataFrame:
    """Clusters of large wells, reads of (_well, read_uid, sequence): whole sequences are never in one task."""
    sized = reads.withColumn("_length", F.length("sequence"))
    lengths = sized.groupBy("_well", "_length").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("_well").orderBy("_length")  # a row for each length
    ranked = lengths.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(Window.partitionBy("_well"))})
    middle = ranked.where(F.col("_upto") > F.floor(F.col("_all") / 2)).groupBy("_well").agg(F.min("_length").alias("middle"))
    off = F.abs(F.col("_length") - F.col("middle"))
    seeds = checkpointed(_meet(sized, middle).groupBy("_well").agg(F.min_by("sequence", F.struct(off, "read_uid", "sequence")).alias("scaffold")), "seeds")
    laid = _laid(reads, seeds)
    first = _votes(laid).groupBy("_well", "position").agg(F.max_by("base", F.struct("n", -F.ascii("base"))).alias("base"))
    letters = F.transform(F.array_sort(F.collect_list(F.struct("position", "base"))), lambda x: x["base"])
    joined = seeds.join(first.groupBy(F.col("_well").alias("_at")).agg(F.array_join(letters, "").alias("polished")), F.col("_well").eqNullSafe(F.col("_at")), "left")
    polished = checkpointed(joined.select("_well", F.coalesce("polished", F.lit("")).alias("scaffold"), (F.col("scaffold") == F.coalesce("polished", F.lit(""))).alias("same")), "polished")
    changed = polished.where(~F.col("same")).drop("same")
    if not changed.isEmpty():  # else the rows are those on the seeds
        other = changed.select(F.col("_well").alias("_at"))
        same = F.col("_well").eqNullSafe(F.col("_at"))
        laid = laid.join(other, same, "left_anti").unionByName(_laid(reads.join(other, same, "left_semi"), changed))
    votes = _votes(laid).where(F.col("base").isin(*BASES)).groupBy("_well", "position").agg(F.sum("n").alias("depth"), F.sort_array(F.collect_list("n"), False).alias("votes"))
    second = F.coalesce(F.get("votes", F.lit(1)), F.lit(0))
    variant = votes.where((F.col("depth") >= max(s.min_size, 2)) & (second > 0) & (second >= s.min_allele * F.col("depth")))
    lists = variant.groupBy(F.col("_well").alias("_at")).agg(F.sort_array(F.collect_list("position")).alias("places"))
    told = checkpointed(polished.join(lists, F.col("_well").eqNullSafe(F.col("_at")), "left").select(F.col("_well").alias("_at"), F.coalesce("places", F.array().cast("array<long>")).alias("places")), "places")

    def describe(batches):
        for pdf in batches:
            wanted = [len(at) >= s.min_places for at in pdf["places"]]
            vectors = ["".join(map(row.__getitem__, at)) if w else "" for row, at, w in zip(pdf["row"], pdf["places"], wanted, strict=True)]
            yield pd.DataFrame({"_well": pdf["_well"], "read_uid": pdf["read_uid"], "vector": vectors, "n_places": pdf["places"].map(len)})

    known = laid.join(F.broadcast(told), F.col("_well").eqNullSafe(F.col("_at"))).drop("_at")  # a row for each large well
    vectors = checkpointed(known.mapInPandas(describe, "_well string, read_uid string, vector string, n_places int"), "vectors")
    few = vectors.where(F.col("n_places") < s.min_places).select("_well", "read_uid", F.lit(0).alias("cluster"), "n_places", F.lit(FEW_PLACES).alias("reason"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("read_uid", kind="stable")
        rows = np.array(pdf["vector"].tolist()).view("U1").reshape(len(pdf), -1)
        found, why = gather(pdf["read_uid"].tolist(), rows, s)
        return pd.DataFrame({"_well": pdf["_well"], "read_uid": pdf["read_uid"], "cluster": pd.array(found, "Int32"), "n_places": pdf["n_places"], "reason": why})

    dealt = vectors.where(F.col("n_places") >= s.min_places).repartition(spread(reads.sparkSession), "_well")  # few bytes, but much work
    many = dealt.groupBy("_well").applyInPandas(one, "_well string, read_uid string, cluster int, n_places int, reason string")
    return many.unionByName(few)


def _whole(reads: DataFrame, count: int, s: ClusterSettings) -> DataFrame:
    """Clusters of the wells whose reads, so many in all, are in one task: those of a few wells at a time."""

    def told(wells: list[pd.DataFrame]) -> pd.DataFrame:
        wells = [pdf.sort_values("read_uid", kind="stable") for pdf in wells]
        found = clusters([(pdf["read_uid"].tolist(), pdf["sequence"].tolist()) for pdf in wells], s)
        parts = [pd.DataFrame({"_well": pdf["_well"], "read_uid": pdf["read_uid"], "cluster": pd.array(own, "Int32"), "n_places": len(places), "reason": why}) for pdf, (own, places, why) in zip(wells, found, strict=True)]
        return pd.concat(parts)

    def gathered(batches):
        ready, held, parts, last = [], 0, [], None
        for pdf in batches:
            for name, own in pdf.groupby("_well", dropna=False, sort=False):
                name = (None if pd.isna(name) else name,)
                if parts and name != last:  # the wells come one after the other
                    ready.append(pd.concat(parts))
                    held, parts = held + len(ready[-1]), []
                    if held >= BLOCK:
                        yield told(ready)
                        ready, held = [], 0
                parts.append(own)
                last = name
        if parts:
            yield told([*ready, pd.concat(parts)])

    partitions = max(2 * reads.sparkSession.sparkContext.defaultParallelism, -(-count // BLOCK))  # the cost is in the rows, not in their bytes
    sorted_ = reads.repartition(partitions, "_well").sortWithinPartitions("_well")
    return sorted_.mapInPandas(gathered, "_well string, read_uid string, cluster int, n_places int, reason string")


def cluster_reads(reads: DataFrame, s: ClusterSettings = ClusterSettings(), well: str = "well_id") -> DataFrame:
    """well, read_uid, cluster, n_places, reason for reads of (well, read_uid, sequence)."""
    counted = checkpointed(reads.groupBy(F.col(well).cast("string").alias("_well")).count(), "counted")
    large = counted.where(F.col("count") > max(WELL_LIMIT, s.min_size))
    widest = counted.agg(F.max_by("_well", "count"), F.max("count"), F.sum("count")).first()
    if (widest[1] or 0) > VECTOR_LIMIT:
        raise ValueError(f"well {widest[0]} has more than {VECTOR_LIMIT} reads")

    own = reads.select(F.col(well).cast("string").alias("_well"), "read_uid", F.coalesce("sequence", F.lit("")).alias("sequence"))
    if (widest[1] or 0) <= max(WELL_LIMIT, s.min_size):
        return _whole(own, widest[2] or 0, s).withColumnRenamed("_well", well)
    names = F.broadcast(large.select(F.col("_well").alias("_at")))  # one row for WELL_LIMIT reads at most
    same = F.col("_well").eqNullSafe(F.col("_at"))
    many = checkpointed(own.join(names, same, "left_semi"), "large")  # gone through several times
    out = _whole(own.join(names, same, "left_anti"), widest[2], s).unionByName(_spread(many, s))
    return out.withColumnRenamed("_well", well)

"""Canonical k-mers and the inverted index from k-mer to reference.

A k-mer of up to 31 bases is a BIGINT of two bits a base (A, C, G, T as 0 to 3),
so the smaller number is also the first in the alphabet. Extraction runs in Arrow
batches, because substring() walks a long text from its start for every window.
The index is joined on (library, k-mer); what a k-mer is worth is 1 / owners.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.reads import alias_key
from ..sources.shared import shared_folder
from .distances import pieces

#: An index of more rows is joined by a shuffle on the k-mer instead of a broadcast.
BROADCAST_ROWS = 2_000_000
#: Bits of a code by which it is held against an index first, and bytes of text whose k-mers are told at once.
LOW_BITS, PIECE = 22, 1 << 20
_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGT", np.uint8)] = [0, 1, 2, 3]


def placed_codes(seq: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Canonical k-mers and where they begin; windows that hold another symbol are left out."""
    codes = _CODE[np.frombuffer(seq, np.uint8)].astype(np.int64)
    n = len(codes) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    forward, reverse = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(k):
        part = codes[i : i + n] & 3
        forward = (forward << 2) | part
        reverse |= (3 - part) << (2 * i)
    bad = np.concatenate([[0], np.cumsum(codes > 3)])
    at = np.flatnonzero(bad[k:] == bad[:-k])
    return np.minimum(forward, reverse)[at], at


def canonical_codes(seq: bytes, k: int) -> np.ndarray:
    """Distinct canonical k-mers; windows that hold another symbol are left out."""
    return np.unique(placed_codes(seq, k)[0])


class Known:
    """Whether codes are among given ones, in order: low bits first, which most others fail."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.low = codes, np.zeros(1 << LOW_BITS, bool)
        self.low[codes & (len(self.low) - 1)] = True

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """The places of those that are."""
        at = np.flatnonzero(self.low[codes & (len(self.low) - 1)])
        found = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        return at[self.codes[found] == codes[at]] if len(self.codes) else at


def decode(code: Column, k: int) -> Column:
    """The bases of a code."""
    base = lambda i: F.element_at(F.array(*map(F.lit, "ACGT")), (F.shiftright(code, 2 * (k - 1 - i)).bitwiseAND(3) + 1).cast("int"))
    return F.concat(*[base(i) for i in range(k)])


def kmer_sets(df: DataFrame, seq: str, k: int, keep: list[str]) -> DataFrame:
    """keep and kmers (array of codes) of every row; a null sequence has none."""
    if not 1 <= k <= 31:
        raise ValueError("k is 1 to 31")
    fields = ", ".join(f"{name} {df.schema[name].dataType.simpleString()}" for name in keep)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [canonical_codes(s or b"", k) for s in part.column("_seq").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(sets, pa.list_(pa.int64()))], [*keep, "kmers"])

    return df.select(*keep, F.col(seq).cast("binary").alias("_seq")).mapInArrow(kernel, f"{fields}, kmers array<long>")


def alias_groups(refs: DataFrame) -> DataFrame:
    """library_id, alias_key, ref_ids, sequence: references of a library that share a sequence."""
    return refs.groupBy("library_id", "sequence").agg(F.array_sort(F.collect_list("ref_id")).alias("ref_ids")).select("library_id", alias_key(F.col("ref_ids")).alias("alias_key"), "ref_ids", "sequence")


def build_index(groups: DataFrame, k: int, max_owners: int | None = None) -> DataFrame:
    """library_id, kmer, alias_key, owners; k-mers of more than max_owners groups are dropped."""
    rows = kmer_sets(groups, "sequence", k, ["library_id", "alias_key"]).select("library_id", "alias_key", F.explode("kmers").alias("kmer"))
    owners = rows.withColumn("owners", F.count(F.lit(1)).over(Window.partitionBy("library_id", "kmer")))
    return owners.where(F.col("owners") <= max_owners) if max_owners else owners


def spread(spark: SparkSession) -> int:
    """Partitions for work whose cost lies in the rows: the session's number of shuffle partitions, all cores at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    """A checkpoint in the folder the cluster names; in one of our own only where it names none and all runs in one process."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def joined_small(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """left joined with right, which is broadcast only if its counted rows allow it."""
    return left.join(F.broadcast(right) if right.limit(rows + 1).count() <= rows else right, on, how)


def specificity(hits: DataFrame, keys: list[str]) -> DataFrame:
    """matches and score of each (keys, alias_key): 1 / owners for each shared k-mer.

    The k-mers are counted by owners first and summed in that order, so the sum does not depend on the plan."""
    counted = hits.groupBy(*keys, "alias_key", "owners").agg(F.count(F.lit(1)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("owners", "n")))
    score = F.aggregate(ordered, F.lit(0.0), lambda acc, x: acc + x["n"] / x["owners"])
    return counted.groupBy(*keys, "alias_key").agg(F.sum("n").alias("matches"), score.alias("score"))


def kmer_rows(df: DataFrame, seq: str, k: int, keep: list[str], index: DataFrame, width: int | None = None, step: int = 1) -> DataFrame:
    """keep, window and kmer: a row for each distinct k-mer of each window (without a width: of the whole sequence).

    While the counted k-mers of the index allow it they are broadcast, and only rows with one of them are made."""
    if not 1 <= k <= 31:
        raise ValueError("k is 1 to 31")
    own = index.select("kmer").distinct().limit(BROADCAST_ROWS + 1).toArrow().column(0).to_numpy()
    shared = df.sparkSession.sparkContext.broadcast(np.sort(own)) if len(own) <= BROADCAST_ROWS else None
    fields = ", ".join(f"{name} {df.schema[name].dataType.simpleString()}" for name in keep)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value) if shared else None
        for batch in batches:
            for part in pieces(batch, ("_seq",), PIECE):
                # a byte for each symbol; the byte between two sequences is in no k-mer
                texts = [(s or "").encode("latin-1", "replace") for s in part.column("_seq").to_pylist()]
                sizes = np.array([len(t) for t in texts], np.int64)
                begins = np.concatenate([[0], np.cumsum(sizes + 1)])
                codes, at = placed_codes(b"\n".join(texts), k)
                if known:
                    hit = known(codes)
                    codes, at = codes[hit], at[hit]
                row = np.searchsorted(begins, at, "right") - 1
                at = at - begins[row]
                window = np.zeros(len(at), np.int64)
                if width is not None:
                    first = np.maximum(-((width - k - at) // step), 0)
                    last = np.minimum(at // step, np.maximum(sizes[row] - width, 0) // step)
                    count = np.maximum(last - first + 1, 0)
                    row, codes, ends = np.repeat(row, count), np.repeat(codes, count), np.cumsum(count)
                    window = np.arange(len(row)) + np.repeat(first - (ends - count), count)
                order = np.lexsort((codes, window, row))
                row, window, codes = row[order], window[order], codes[order]
                fresh = np.ones(len(row), bool)
                fresh[1:] = (codes[1:] != codes[:-1]) | (window[1:] != window[:-1]) | (row[1:] != row[:-1])
                of = pa.array(row[fresh])
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(of) for c in keep), pa.array(window[fresh].astype(np.int32)), pa.array(codes[fresh])], [*keep, "window", "kmer"])

    return df.select(*keep, F.col(seq).cast("string").alias("_seq")).mapInArrow(kernel, f"{fields}, window int, kmer long")


def best_references(rows: DataFrame, index: DataFrame, keys: list[str], top: int, least_score: float = 0.0) -> DataFrame:
    """The top references of each of the keys (library_id among them) by specificity, then those that reach least_score."""
    scored = specificity(joined_small(rows, index, ["library_id", "kmer"]), keys)
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "alias_key")
    return scored.withColumn("rank", F.row_number().over(best)).where((F.col("rank") <= top) & (F.col("score") >= least_score))


def shortlist(queries: DataFrame, index: DataFrame, k: int, top: int, least_score: float = 0.0, uid: str = "read_uid") -> DataFrame:
    """The top references of each read by specificity, then those that reach least_score. queries: uid, library_id, query."""
    keys = [uid, "library_id"]
    return best_references(kmer_rows(queries, "query", k, keys, index).drop("window"), index, keys, top, least_score)

"""Vector code compression: a codebook for each part of the vectors, trained by tree aggregation.

Vectors become integers, floor(scale * x), cut into equal consecutive parts (a length
that the parts do not divide is filled with zeros at its end). They are packed once
into a table of column-wise blocks of up to BLOCK vectors; an RDD of these blocks is
all that the rounds read. A part's codebook starts as that part of the vectors with
the smallest ids. In a round each task goes over its blocks, builds the squared
distances to all entries one dimension after the other, and adds its parts to int64
tensors of sums and counts (np.add.at); the tensors meet in a reduction tree, so the
driver gets a few of them, each parts x entries x (width + 1) longs whatever the
input. Entries move to the floor of their parts' mean; unused ones stay.

Dropped: null vectors, null or non-finite components. The codebooks are for the
commonest length (of equally common ones the greatest); vectors of another length come
back with null code and error. Repeated rows all count. Null ids come back and are the
last to start a codebook; ties go by components. Fewer vectors than entries make a
shorter codebook, none an empty result. Components beyond 2^62 are taken as 2^62; where
64 bits would not do a task goes on with Python integers, and errors beyond 2^63 - 1
are taken as that. Columns other than id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, HOT_SHARE, release, stash, table
from .vectors import LONGEST, NARROW, as_long, kept_vectors, matrix, whole

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK = 4096
#: Vectors whose distances to all entries are built at once: they stay in a core's cache.
STRIP = 256
#: Partitions beyond which the reduction tree has one level more.
WIDE_TREE = 1000


@dataclass(frozen=True)
class Codebooks:
    """entries: parts x entries x width integers. dims: length of the vectors."""

    entries: np.ndarray
    dims: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def fitting(most: int, width: int) -> type:
    """The narrowest type that holds squared distances of width components up to most."""
    if width * (2 * most) ** 2 < 1 << 31:
        return np.int32
    return np.int64 if most < NARROW and width <= 64 else object


def largest(values: np.ndarray) -> int:
    return max(-int(values.min()), int(values.max())) if values.size else 0


def assign_parts(columns: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the parts of a block (parts x width x vectors) the nearest entries, lower index first, and squared distances."""
    parts, width, n = columns.shape
    kind = fitting(max(largest(columns), largest(entries)), width)
    columns, entries = columns.astype(kind), entries.astype(kind)
    index, error = np.zeros((parts, n), np.int64), np.zeros((parts, n), object if kind is object else np.int64)
    for p in range(parts):
        for start in range(0, n, STRIP):
            strip = columns[p, :, start : start + STRIP]
            far = np.zeros((strip.shape[1], entries.shape[1]), dtype=kind)
            for d in range(width):
                apart = strip[d][:, None] - entries[p, :, d]
                apart *= apart
                far += apart
            index[p, start : start + STRIP] = near = far.argmin(axis=1)
            error[p, start : start + STRIP] = far[np.arange(len(near)), near]
    return index, error


def unpack(row: Row, parts: int) -> np.ndarray:
    flat = np.frombuffer(row["body"], dtype=row["kind"])
    return flat.reshape(parts, len(flat) // (parts * row["rows"]), row["rows"])


def pack_blocks(kept: DataFrame, dims: int, parts: int, scale: int, size: int = BLOCK) -> DataFrame:
    """Blocks of vectors: ids and labels as arrays, components dimension by dimension as bytes of type kind."""
    width = -(-dims // parts)
    label = kept.schema["label"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                cut = batch.slice(start, size)
                n = cut.num_rows
                values = np.zeros((n, parts * width), np.int64)
                values[:, :dims] = whole(matrix(cut.column(2), dims), scale)
                kind = np.int32 if largest(values) < 1 << 31 else np.int64
                lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), cut.column(i)) for i in (0, 1)]
                yield pa.record_batch([*lists, pa.array([n], pa.int32()), pa.array([np.dtype(kind).str]), pa.array([np.ascontiguousarray(values.T, dtype=kind).tobytes()], pa.binary())], names=["ids", "labels", "rows", "kind", "body"])

    return kept.select("vec_id", "label", "vector").mapInArrow(pack, f"ids array<long>, labels array<{label}>, rows int, kind string, body binary")


def train(packed: DataFrame, start: np.ndarray, rounds: int) -> np.ndarray:
    """The entries after so many rounds over the blocks."""
    entries, parts, width = start, start.shape[0], start.shape[2]
    rdd = packed.select("rows", "kind", "body").rdd
    depth = 2 if rdd.getNumPartitions() <= WIDE_TREE else 3
    for _ in range(rounds):
        now = entries

        def add(total: tuple[np.ndarray, np.ndarray], row: Row) -> tuple[np.ndarray, np.ndarray]:
            sums, counts = total
            columns = unpack(row, parts)
            index, _ = assign_parts(columns, now)  # noqa: B023
            if largest(columns) >= NARROW and sums.dtype != object:
                sums = sums.astype(object)
            for p in range(parts):
                np.add.at(sums[p], index[p], columns[p].T.astype(sums.dtype))
                np.add.at(counts[p], index[p], 1)
            return sums, counts

        def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            return a[0] + b[0], a[1] + b[1]

        zero = (np.zeros((parts, entries.shape[1], width), np.int64), np.zeros((parts, entries.shape[1]), np.int64))
        sums, counts = rdd.treeAggregate(zero, add, merge, depth)
        entries = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], entries).astype(np.int64)
    return entries


def encode(packed: DataFrame, entries: np.ndarray, id_type: str, label_type: str) -> DataFrame:
    """vec_id, label, code and error of every vector in the blocks."""
    parts = entries.shape[0]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["rows", "kind", "body"]).to_pylist()):
                index, error = assign_parts(unpack(row, parts), entries)
                codes = ["".join(f"{x:02x}" for x in code) for code in index.T.tolist()]
                total = error.sum(axis=0)
                total = [min(int(x), LONGEST) for x in total] if total.dtype == object else total
                yield pa.record_batch([batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(codes), pa.array(total, pa.int64())], names=["vec_id", "label", "code", "error"])

    return packed.mapInArrow(step, f"vec_id {id_type}, label {label_type}, code string, error long")


def compress_vectors(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks]:
    """vec_id, label, code and error of every kept vector, as a written table; and the codebooks. At most 256 entries."""
    kept = kept_vectors(df, vector_col, vec_id=id_col, label=label_col).withColumn("vec_id", F.col("vec_id").cast("long"))
    label = kept.schema["label"].dataType.simpleString()
    common = kept.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dims = common["size"] if common else 0
    fits = kept.where(F.size("vector") == dims)
    first = fits.select("vec_id", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    width = -(-dims // parts)
    start = np.zeros((len(first), parts * width), np.int64)
    start[:, :dims] = whole(np.array([r["vector"] for r in first]).reshape(len(first), dims), scale)
    start = start.reshape(len(first), parts, width).transpose(1, 0, 2)
    if not first:
        return stash(encode(pack_blocks(fits, dims, parts, scale), start, "long", label), "codes"), Codebooks(start, dims)
    packed = stash(pack_blocks(fits, dims, parts, scale, block), "vector-blocks")
    books = Codebooks(train(packed, start, rounds), dims)
    coded = encode(packed, books.entries, "long", label)
    others = kept.where(F.size("vector") != dims).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    out = stash(coded.unionByName(others), "codes")
    release(packed)
    return out, books


def with_label_errors(codes: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """codes with label_error, the sum of errors over rows of an equal label, nulls together. Labels are broadcast while they
    are few; beyond that only those that hold many rows are, and the rest are joined by a shuffle."""
    sums = stash(codes.groupBy("label").agg(F.count("*").alias("n"), as_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error")), "label-errors")
    same = F.col("c.label").eqNullSafe(F.col("s.label"))

    def joined(rows: DataFrame, of: DataFrame) -> DataFrame:
        return rows.alias("c").join(of.alias("s"), same).select("c.*", "s.label_error")

    if sums.count() <= limit:
        return joined(codes, F.broadcast(sums))
    share = HOT_SHARE * codes.count()
    hot, rest = sums.where(F.col("n") > share), sums.where(F.col("n") <= share)
    cold = codes.alias("c").join(F.broadcast(hot).alias("s"), same, "left_anti")
    return joined(codes, F.broadcast(hot)).unionByName(joined(cold, rest))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code, error and error of the label of every finite vector, and the digest of the codebooks."""
    codes, books = compress_vectors(table(spark, sf_dir, "embeddings"))
    out = with_label_errors(codes)
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

"""Centroid clustering with Elkan's bounds, exact in integers.

Vectors become integers, floor(scale * x). The first centroids are the k vectors whose
ids have the smallest hashes. Each round assigns all vectors to their nearest centroid
and moves each centroid to the floor of its vectors' mean; then all are assigned once
more. Every vector carries an upper bound of the distance to its own centroid and a
lower bound for each of the k, in a table of the shared folder that each round writes
anew (the one before is deleted). When centroids move, bounds widen by the way they
went; a centroid is skipped if its lower bound, or half its distance from the vector's
own centroid, lies above the upper bound. Bounds are single floats rounded away from
the pruned side and the test is strict, so that a skipped centroid is truly farther:
ties are always computed, from integers, and go to the smaller number.

Tasks hold one Arrow batch. Sums are taken per cluster and task before they are
shuffled; the driver sees k centroids. A cluster that holds most rows costs no more
than others.

Dropped: null vectors, lengths other than dims, null or non-finite components. Repeated
rows all count and all come back. Null ids come back; they become first centroids only
if others do not suffice. Ties of the first hash go by id and components. Fewer than k
vectors make fewer clusters, none an empty result. Components beyond 2^62 are taken as
2^62; distances and sums beyond 2^63 - 1 as that. Columns other than id and vector are
not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, stash, table
from .vectors import LONGEST, as_long, exact, kept_vectors, matrix, whole

CLUSTERS, ROUNDS, DIMS, SCALE, SALT = 16, 3, 64, 64, "1"
#: Bounds are moved by this share to the safe side before they become single floats.
SLACK = 1e-6
_LARGEST = 3e38

STATE = "vec_id long, vector array<long>, cluster int, upper float, lower array<float>, computed int"
STATE_ARROW = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.int64())), ("cluster", pa.int32()), ("upper", pa.float32()), ("lower", pa.list_(pa.float32())), ("computed", pa.int32())])
FINAL = "vec_id long, cluster int, distance long, computed int"
FINAL_ARROW = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("computed", pa.int32())])


def above(values: np.ndarray) -> np.ndarray:
    """Not less than values, as single floats."""
    with np.errstate(over="ignore"):
        return (values * (1 + SLACK)).astype(np.float32)


def below(values: np.ndarray) -> np.ndarray:
    """Not more than values and not negative, as single floats."""
    return np.clip(values * (1 - SLACK), 0, _LARGEST).astype(np.float32)


def squares(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    apart = rows - to
    return (apart * apart).sum(axis=-1)


def distance(x: list[int], y: list[int]) -> float:
    return math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y, strict=True)))


def apart(centroids: list[list[int]]) -> np.ndarray:
    """Half the distances between centroids, rounded down."""
    k = len(centroids)
    out = np.zeros((k, k))
    for i in range(k):
        for j in range(i):
            out[i, j] = out[j, i] = distance(centroids[i], centroids[j]) / 2 * (1 - SLACK)
    return out


def moved(old: list[list[int]], new: list[list[int]]) -> np.ndarray:
    """The ways that centroids went, rounded up."""
    return np.array([distance(x, y) * (1 + SLACK) for x, y in zip(old, new, strict=True)])


def nearest(rows: np.ndarray, centroids: np.ndarray, half: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Put each row to its nearest centroid; cluster, upper and lower are brought up to date in place.
    Returns the number of distances computed for each row."""
    n, k = lower.shape
    best = np.zeros(n, dtype=rows.dtype)
    known = np.zeros(n, dtype=bool)  # best holds the squared distance to the row's own centroid
    computed = np.zeros(n, dtype=np.int32)
    wide = rows.dtype == object  # no bounds: all is computed
    if wide:
        upper[:], lower[:] = np.inf, 0

    def left(at: np.ndarray, j: int) -> np.ndarray:
        """Of the rows at, those for which centroid j may be as near as their own."""
        mine = cluster[at]
        return at[(mine != j) & (upper[at] >= lower[at, j]) & (upper[at] >= half[mine, j])]

    def measure(at: np.ndarray, j: int | np.ndarray) -> np.ndarray:
        computed[at] += 1
        far = squares(rows[at], centroids[j])
        if not wide:
            lower[at, j] = below(np.sqrt(far.astype(np.float64)))
        return far

    every = np.arange(n)
    for j in range(k):
        at = left(every, j)
        fresh = at[~known[at]]
        if fresh.size:
            best[fresh] = measure(fresh, cluster[fresh])
            known[fresh] = True
            if not wide:
                upper[fresh] = above(np.sqrt(best[fresh].astype(np.float64)))
            at = left(at, j)
        if at.size:
            far = measure(at, j)
            better = (far < best[at]) | ((far == best[at]) & (j < cluster[at]))
            at, far = at[better], far[better]
            cluster[at], best[at] = j, far
            if not wide:
                upper[at] = above(np.sqrt(far.astype(np.float64)))
    return computed


def assigner(centroids: list[list[int]], shift: np.ndarray | None, scale: int, last: bool):
    """The step of a round over Arrow batches. Without shift the input has plain vectors, else the state of the round before."""
    half, k, dims = apart(centroids), len(centroids), len(centroids[0])
    middle = exact(np.array(centroids, dtype=np.int64))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            raw = matrix(column["vector"], dims)
            if shift is None:
                raw = whole(raw, scale)
                cluster, upper, lower = np.zeros(n, np.int32), np.full(n, np.inf, np.float32), np.zeros((n, k), np.float32)
                computed = np.zeros(n, np.int32)
            else:
                cluster, computed = (column[c].to_numpy(zero_copy_only=False).copy() for c in ("cluster", "computed"))
                upper = above(column["upper"].to_numpy(zero_copy_only=False).astype(np.float64) + shift[cluster])
                lower = below(matrix(column["lower"], k).astype(np.float64) - shift)
            rows = exact(raw)
            to = middle
            if rows.dtype == object or middle.dtype == object:
                rows, to = rows.astype(object), middle.astype(object)
            computed += nearest(rows, to, half, cluster, upper, lower)
            if last:
                far = squares(rows, to[cluster])
                far = np.array([min(int(x), LONGEST) for x in far], dtype=np.int64) if far.dtype == object else far
                yield pa.record_batch([column["vec_id"], pa.array(cluster, pa.int32()), pa.array(far), pa.array(computed)], schema=FINAL_ARROW)
            else:
                lists = [pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * x.shape[1], pa.array(x.reshape(-1))) for x in (raw, lower)]
                yield pa.record_batch([column["vec_id"], lists[0], pa.array(cluster, pa.int32()), pa.array(upper), lists[1], pa.array(computed)], schema=STATE_ARROW)

    return step


def means(state: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid moved to the floor of its vectors' mean; one without vectors stays."""
    sums = [F.sum(F.col("vector")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(len(centroids[0]))]
    out = list(centroids)
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(len(centroids[0]))]
    return out


def cluster_vectors(df: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, salt: str = SALT, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster, distance (squared) and computed (distances that the rounds computed, of (rounds + 1) * k that
    plain rounds would) for every kept vector; and the final centroids."""
    spark = df.sparkSession
    kept = kept_vectors(df, vector_col, vec_id=id_col).withColumn("vec_id", F.col("vec_id").cast("long")).where(F.size("vector") == dims)
    drawn = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(drawn.asc_nulls_last(), "vec_id", "vector").limit(k).collect()
    if not first:
        return spark.createDataFrame([], FINAL), []
    centroids = [whole(np.array(row.vector), scale).tolist() for row in first]
    state, shift = kept, None
    for _ in range(rounds):
        done = stash(state.mapInArrow(assigner(centroids, shift, scale, False), STATE), "cluster-state")
        if shift is not None:
            release(state)
        state, now = done, means(done, centroids)
        shift, centroids = moved(centroids, now), now
    final = stash(state.mapInArrow(assigner(centroids, shift, scale, True), FINAL), "clusters")
    if shift is not None:
        release(state)
    return final, centroids


def op11_elkan_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of 64 finite components with its cluster of 16 after three rounds, its squared distance and the inertia."""
    found, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole_sum = min(sum(map(int, sums.values())), LONGEST)
    rows = [(c, Decimal(sums.get(c, 0)), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids)]
    of = spark.createDataFrame(rows, "cluster int, s decimal(38,0), centroid_sha256 string")
    out = found.join(F.broadcast(of), "cluster")
    return out.select("vec_id", "cluster", "distance", as_long(F.col("s")).alias("cluster_inertia"), F.lit(whole_sum).cast("long").alias("inertia"), "centroid_sha256")

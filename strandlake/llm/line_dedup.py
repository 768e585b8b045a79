"""Removal of lines that many sites share.

Each line with a word is hashed, and a HyperLogLog sketch of its sites is built per
line hash straight from the lines: sketches of a task merge before they are
shuffled, so a line that stands in every text is one row per task. Where the merged
estimate is close to the threshold (BAND standard errors, one site at least) a second
reading makes the (line, site) pairs of those lines alone and counts their sites
exactly. Lines on MIN_SITES sites or more are removed from all texts; the other
lines stay as they were.

Texts are not shuffled: while the lines to remove are counted to be BROADCAST_LINES at
most (12 bytes each), they travel to the texts. Beyond that the places of removed
lines are found by a join of line hashes and come back to their texts by file and
row.

A line is known by 96 bits of hashes (XXH64 and CRC32). Nulls: a null text is
empty and stays null, a null site counts as the site "", a null id is returned as
it is. Lines of white space are never removed. Repeated rows give one row each.
Other columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PLACE, blocks, by_rows, on_files, place, stash, table

MIN_SITES = 10
LOG_BUCKETS = 12
BAND = 4.0
#: So many removed lines at most are broadcast.
BROADCAST_LINES = 4_000_000
HASH_SEED = 42  # of Spark's xxhash64
BLANKS = b" \t\x0b\f\r"
REMOVED = "doc_id long, n_lines long, removed array<int>, kept_text binary"


def _lines(df: DataFrame, *keep: str) -> DataFrame:
    """One row for each line with a word: what is to be kept, the place and the line's hashes."""
    lines = df.select(*keep, F.posexplode(F.split(F.coalesce("body", F.lit("")), "\n", -1)).alias("place", "line"))
    worded = lines.where(F.length(F.translate("line", BLANKS.decode(), "")) > 0)
    return worded.select(*keep, "place", F.xxhash64("line").alias("h1"), F.crc32("line").alias("h2"))


def widespread_lines(df: DataFrame, min_sites: int = MIN_SITES, log_buckets: int = LOG_BUCKETS, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """h1, h2 of lines on min_sites sites or more, for (site, body)."""
    line, lines = ["h1", "h2"], _lines(df, "site")
    if min_sites <= 1:
        return lines.select(*line).distinct()
    spread = lines.groupBy(*line).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_buckets))).alias("sites"))
    band = max(1.0, BAND * 1.04 / (1 << log_buckets) ** 0.5 * min_sites)
    judged = stash(spread.where(F.col("sites") >= min_sites - band), "lines-spread")
    near = judged.where(F.col("sites") <= min_sites + band).select(*line)
    few = near.limit(broadcast_lines + 1).count() <= broadcast_lines
    pairs = lines.join(F.broadcast(near) if few else near, line, "left_semi").select(*line, "site").distinct()
    exact = pairs.groupBy(*line).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites)
    return judged.where(F.col("sites") > min_sites + band).select(*line).union(exact.select(*line))


class LineSet:
    """Lines by their two hashes, as sorted arrays."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray):
        order = np.lexsort((h2, h1))
        self.h1, self.h2 = h1[order], h2[order]

    def holds(self, lines: list[bytes]) -> np.ndarray:
        keys = np.array([xxhash.xxh64_intdigest(x, HASH_SEED) for x in lines], np.uint64).view(np.int64)
        low, high = np.searchsorted(self.h1, keys, "left"), np.searchsorted(self.h1, keys, "right")
        out = high > low
        for i in np.flatnonzero(out).tolist():
            out[i] = zlib.crc32(lines[i]) in self.h2[low[i] : high[i]]
        return out


def _cut(df: DataFrame, wide: DataFrame) -> DataFrame:
    """REMOVED of (doc_id, body), by a broadcast set of lines."""
    told = wide.toArrow()  # counted to be few
    shared = df.sparkSession.sparkContext.broadcast((told.column("h1").to_numpy(), told.column("h2").to_numpy()))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone = LineSet(*shared.value)
        for batch in blocks(batches):
            parts = [None if b is None else b.split(b"\n") for b in batch.column("body").to_pylist()]
            worded = [[k for k, x in enumerate(p or ()) if x.strip(BLANKS)] for p in parts]
            flags = gone.holds([p[k] for p, own in zip(parts, worded, strict=True) for k in own])
            at, removed, kept = 0, [], []
            for p, own in zip(parts, worded, strict=True):
                out = [k for k, f in zip(own, flags[at : at + len(own)].tolist(), strict=True) if f]
                at += len(own)
                removed.append(out)
                drop = set(out)
                kept.append(None if p is None else b"\n".join(x for k, x in enumerate(p) if k not in drop) if drop else b"\n".join(p))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in worded], pa.int64()), pa.array(removed, pa.list_(pa.int32())), pa.array(kept, pa.binary())],
                ["doc_id", "n_lines", "removed", "kept_text"],
            )

    cut = df.select("doc_id", F.col("body").cast("binary").alias("body")).mapInArrow(kernel, REMOVED)
    return cut.withColumn("kept_text", F.col("kept_text").cast("string"))


def _joined(docs: DataFrame, wide: DataFrame) -> DataFrame:
    """REMOVED of (doc_id, body) of a table on files, by joins of line hashes and of places."""
    hits = _lines(docs.select(*place(docs), "body"), *PLACE).join(wide, ["h1", "h2"], "left_semi")
    places = stash(hits.groupBy(*PLACE).agg(F.sort_array(F.collect_set("place")).alias("removed")), "lines-places")
    texts = by_rows(docs.select(*place(docs), "doc_id", "body"), places, PLACE, "left")
    lines = texts.select("doc_id", "body", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"), F.split(F.coalesce("body", F.lit("")), "\n", -1).alias("lines"))
    blank = lambda x: F.length(F.translate(x, BLANKS.decode(), "")) == 0
    stay: Column = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    kept = F.when(F.size("removed") == 0, F.col("body")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return lines.select("doc_id", F.size(F.filter("lines", lambda x: ~blank(x))).cast("long").alias("n_lines"), "removed", kept.alias("kept_text"))


def remove_lines(df: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", log_buckets: int = LOG_BUCKETS, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """doc_id, n_lines (with a word), removed (places of lines), kept_text of every row."""
    named = lambda d: d.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"), F.col(text_col).cast("string").alias("body"))
    wide = stash(widespread_lines(named(df), min_sites, log_buckets, broadcast_lines), "lines-wide")
    if wide.limit(broadcast_lines + 1).count() <= broadcast_lines:
        return _cut(named(df), wide)
    return _joined(named(on_files(df, "lines-docs")), wide)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))

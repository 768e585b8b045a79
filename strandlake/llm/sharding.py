"""Balanced shards by Karmarkar-Karp differencing.

Documents with equal texts form one indivisible group. Groups are dealt by hash
into parts of about GROUPS_PER_PART; in each part the two partial partitions
with the largest spread are combined again and again, the largest shard of one
with the smallest of the other, until one partial partition of all its groups
is left. The parts' own partial partitions (k sums each) are dealt into parts of
parts and combined in the same way, level by level, in the executors, until one
is left. Balance is by bytes; the size of a document is its UTF-8 bytes plus 1.

Rows with the same id and text are one row with a count until the end. Slots count
from 0 without gaps in each shard, in the order of a hash of id and text, then id and
text; so they do not depend on how the input is partitioned. Groups of more than a
HOT_SHARE of the rows meet their rows by a broadcast (there are few of them), so no
task takes all rows of one text.

Nulls: a null text counts as empty and is grouped with empty texts; a null id
is returned as it is. Repeated rows are separate rows of one group. Other columns
are dropped; an empty table gives an empty result. A group is never split, so a
group larger than a shard's share bounds the balance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, hot_join, release, shuffle_parts, stash, table

SHARDS = 8
GROUPS_PER_PART = 20_000
ROWS_PER_BUCKET = 50_000
#: So many parts (k numbers each) or buckets at most are broadcast.
BROADCAST_PARTS = 200_000
#: A row that stands for more rows than this is dealt to several tasks.
REPEATS = 1_000_000


def difference(states: Iterable[tuple[int, ...]], k: int) -> list[list[int]]:
    """Combine partial partitions of k sums; for each of them the shard that each of its k sums goes to."""
    sums = [tuple(s) for s in states]
    if not sums:
        return []
    leaves = len(sums)
    joins: list[tuple[int, int, list[int], list[int]]] = []
    heap = [(min(s) - max(s), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        high = sorted(range(k), key=sums[a].__getitem__, reverse=True)
        low = sorted(range(k), key=sums[b].__getitem__)
        both = tuple(sums[a][x] + sums[b][y] for x, y in zip(high, low, strict=True))
        least = min(both)
        joins.append((a, b, high, low))
        sums.append(tuple(x - least for x in both))
        heapq.heappush(heap, (min(sums[-1]) - max(sums[-1]), len(sums) - 1))
    goes: list[list[int] | None] = [None] * len(sums)
    goes[-1] = list(range(k))
    for node in range(len(sums) - 1, leaves - 1, -1):
        a, b, high, low = joins[node - leaves]
        goes[a], goes[b] = [0] * k, [0] * k
        for slot, shard in enumerate(goes[node]):
            goes[a][high[slot]] = goes[b][low[slot]] = shard
    return goes[:leaves]


def _small(df: DataFrame) -> DataFrame:
    """df for a join, broadcast while it is counted to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_PARTS + 1).count() <= BROADCAST_PARTS else df


def place_groups(groups: DataFrame, k: int, groups_per_part: int = GROUPS_PER_PART) -> DataFrame:
    """key and shard of every group of (key, bytes); keys are distinct."""
    parts = max(1, -(-groups.count() // groups_per_part))

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
        pdf["slot"] = [g[0] for g in difference([(int(n),) + (0,) * (k - 1) for n in pdf["bytes"]], k)]
        return pdf[["key", "bytes", "part", "slot"]]

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        states = [tuple(int(x) for x in s) for s in pdf["sums"]]
        pdf["goes"] = difference(states, k)
        moved = []
        for own, goes in zip(states, pdf["goes"], strict=True):
            out = [0] * k
            for x, shard in zip(own, goes, strict=True):
                out[shard] += x
            moved.append(out)
        pdf["moved"] = moved
        return pdf[["part", "up", "goes", "moved"]]

    dealt = groups.select("key", "bytes", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("part"))
    placed = stash(dealt.groupBy("part").applyInPandas(combine, "key binary, bytes long, part int, slot int"), "sharding-placed")
    sums = placed.groupBy("part").agg(F.array(*[F.coalesce(F.sum(F.when(F.col("slot") == i, F.col("bytes"))), F.lit(0)) for i in range(k)]).alias("sums"))
    levels = []
    while parts > 1:
        parts = -(-parts // groups_per_part)
        told = sums.withColumn("up", F.pmod("part", F.lit(parts)).cast("int")).groupBy("up").applyInPandas(merge, "part int, up int, goes array<int>, moved array<long>")
        levels.append(stash(told, "sharding-level"))
        sums = levels[-1].groupBy(F.col("up").alias("part")).agg(F.array(*[F.sum(F.col("moved")[i]) for i in range(k)]).alias("sums"))
    shards = None  # where the slots of a part go, from the last level down
    for level in reversed(levels):
        if shards is None:
            shards = level.select("part", F.col("goes").alias("shards"))
        else:
            above = _small(shards.select(F.col("part").alias("up"), F.col("shards").alias("above")))
            shards = level.join(above, "up").select("part", F.transform("goes", lambda g: F.get("above", g)).alias("shards"))
    if shards is None:
        return placed.select("key", F.col("slot").alias("shard"))
    return placed.join(_small(stash(shards, "sharding-moves")), "part").select("key", F.get("shards", F.col("slot")).alias("shard"))


def number_slots(rows: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, repeats: int = REPEATS) -> DataFrame:
    """Add slot, gapless from 0 in each shard, and make n rows of each. rows is a written table with distinct (doc_id, key)."""
    buckets = max(1, -(-rows.count() // rows_per_bucket))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "key"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bucket
    begins = rows.groupBy("bucket", "shard").agg(F.sum("n").alias("held"))
    begins = stash(begins.select("bucket", "shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("begin")), "sharding-begins")
    inside = Window.partitionBy("bucket", "shard").orderBy("doc_id", "key").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("begin") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    numbered = stash(rows.join(_small(begins), ["bucket", "shard"]).withColumn("first", first).drop("bucket", "begin", "key"), "sharding-numbered")
    step = F.lit(repeats).cast("long")
    count = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    few = numbered.where(F.col("n") <= step).withColumn("k", count(F.col("n")))
    many = numbered.where(F.col("n") > step).withColumn("c", count(F.ceil(F.col("n") / step))).repartition(shuffle_parts(rows.sparkSession), "doc_id", "first", "c")
    many = many.withColumn("k", count(F.least(step, F.col("n") - F.col("c") * step))).withColumn("k", F.col("k") + F.col("c") * step).drop("c")
    return few.unionByName(many).withColumn("slot", F.col("first") + F.col("k")).drop("first", "k", "n")


def shard_documents(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", groups_per_part: int = GROUPS_PER_PART, rows_per_bucket: int = ROWS_PER_BUCKET, hot: float = HOT_SHARE, repeats: int = REPEATS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    told = df.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key"))
    rows = stash(told.groupBy("doc_id", "key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")), "sharding-rows")
    groups = stash(rows.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.count(F.lit(1)).alias("held")), "sharding-groups")
    placed = stash(place_groups(groups, shards, groups_per_part), "sharding-shards")
    common = stash(groups.where(F.col("held") > hot * rows.count()).select("key"), "sharding-hot")
    assigned = stash(hot_join(rows, placed, ["key"], common), "sharding-assigned")
    release(rows, groups, placed, common)
    return number_slots(assigned, rows_per_bucket, repeats).select("doc_id", "size", "text_crc32", "shard", "slot")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

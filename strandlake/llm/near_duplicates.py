"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64 bits over word shingles. Equal fingerprints are linked by
grouping; distinct ones are searched as follows. The correlation of the 64 bits
over all fingerprints groups correlated bits into partitions; a dynamic
programme gives each partition its own threshold so that the thresholds plus
one add up to the distance plus one, at the least estimated cost of probes and
candidates. How many pairs come within a threshold on a partition is read from the
pairs of a hash sample of SAMPLE fingerprints, bits taken together as they are, and
from the bits' own rates where the sample shows none; it decides costs, never results. Two fingerprints within the distance agree on some partition within
that partition's threshold, so each partition's values are probed within its
threshold and every candidate is verified. Buckets of more than BUCKET
fingerprints are cut into blocks whose pairs are separate work items. A work
item returns a spanning forest of the links it verified, never all pairs, which
leaves the components unchanged. Components come from label propagation with
pointer jumping over written tables.

Nulls: a null text has no words (fingerprint zero, linked like any other); a
null id is returned as it is and never names a component unless no other id is
there. Repeated rows give one row each. Other columns are dropped; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT_SHARE, blocks, hot_join, release, shuffle_parts, stash, table, text_bytes

BITS = 64
BUCKET = 4096
SEED = 42
#: About so many fingerprints tell the costs of the search.
SAMPLE = 3000
#: So many labels (two longs each) at most are broadcast.
BROADCAST_LABELS = 500_000
#: Nanoseconds of a probe (it is shuffled and sorted) and of a candidate (one comparison in a block).
PROBE_COST, CANDIDATE_COST = 2000.0, 6.0


# Fingerprints


def shingle_hashes(body: bytes | None, words: int) -> list[int]:
    tokens = (body or b"").lower().split()
    if not tokens:
        return []
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return [digest(b" ".join(tokens), SEED)]
    if words == 1:
        return [digest(t, SEED) for t in tokens]
    joined, ends, at = b" ".join(tokens), [], 0
    for t in tokens:
        at += len(t)
        ends.append(at)
        at += 1
    starts = [0, *(e + 1 for e in ends[:-1])]
    view = memoryview(joined)
    return [digest(view[a:b], SEED) for a, b in zip(starts, ends[words - 1 :], strict=False)]


def fingerprints(bodies: list[bytes | None], words: int) -> np.ndarray:
    """A fingerprint for each text: bit i is 1 if more than half of the hashes have it."""
    return majority_bits([shingle_hashes(b, words) for b in bodies])


def majority_bits(per_text: list[list[int]]) -> np.ndarray:
    """A fingerprint for each list of hashes."""
    sizes = np.array([len(h) for h in per_text], np.int64)
    flat = np.fromiter((x for h in per_text for x in h), np.uint64, int(sizes.sum()))
    sums = np.zeros((len(per_text), BITS), np.int64)
    owner = np.repeat(np.arange(len(per_text)), sizes)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    inside = np.arange(len(flat)) - begins[owner]
    cuts = np.flatnonzero(inside % 255 == 0)  # sums of 255 bits fit a byte
    if len(cuts):
        wide = np.unpackbits(flat.astype(">u8").view(np.uint8)).view(np.uint64).reshape(-1, BITS // 8)
        part = np.add.reduceat(wide, cuts, axis=0).view(np.uint8).reshape(-1, BITS)
        np.add.at(sums, owner[cuts], part)
    bits = (2 * sums > sizes[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def simhash(df: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and print (the 64 bits as a signed long) of every row."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, 2 << 20):
            prints = fingerprints(batch.column("body").to_pylist(), words).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], ["doc_id", "print"])

    return text_bytes(df, id_col, text_col).mapInArrow(kernel, "doc_id long, print long")


# Plan of the search


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of distinct fingerprints, and how often each pair of bits is set together (64 x 64)."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy().astype(">i8").view(np.uint8)).reshape(-1, BITS).astype(np.float32)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1)], pa.list_(pa.float64()))], ["together"])

    rows = prints.select("print").mapInArrow(kernel, "together array<double>")
    cells = rows.select(F.posexplode("together").alias("cell", "v")).groupBy("cell").agg(F.sum("v")).collect()  # 4096 rows
    together = np.zeros(BITS * BITS)
    for cell, v in cells:
        together[cell] = v
    return int(prints.count()), together.reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of nearly equal width; a bit joins the open partition it correlates with most."""
    share = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    corr = np.abs((together / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, out = set(range(BITS)), []
    for i in range(parts):
        width = (BITS + i) // parts
        seed = max(left, key=lambda b: (corr[b, sorted(left)].sum(), -b))
        group = [seed]
        left.discard(seed)
        while len(group) < width:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.discard(best)
        out.append(sorted(group))
    return out


def sampled(prints: DataFrame, n: int) -> np.ndarray:
    """About SAMPLE distinct fingerprints by a hash of theirs."""
    some = prints.where(F.pmod(F.xxhash64("print", F.lit(SEED)), F.lit(max(1, n // SAMPLE))) == 0).select("print")
    return some.toArrow().column("print").to_numpy().view(np.uint64)


def near_share(sample: np.ndarray, bits: list[int], most: int) -> np.ndarray:
    """Share of the sample's pairs at each distance up to most on some bits."""
    keys = key_of(sample, bits)
    counts = np.zeros(len(bits) + 1)
    for at in range(0, len(keys), 512):
        far = np.bitwise_count(keys[at : at + 512, None] ^ keys[None, :])
        counts += np.bincount(far.reshape(-1), minlength=len(bits) + 1)[: len(bits) + 1]
    counts[0] -= len(keys)  # each with itself
    share = counts / max(1, len(keys) * (len(keys) - 1))
    return np.concatenate([share, np.zeros(max(0, most + 1 - len(share)))])[: most + 1]


def plan_search(n: int, together: np.ndarray, distance: int, near: float = 1.0, sample: np.ndarray | None = None) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed partition, by dynamic programming over the estimated costs.

    near: the share of all pairs that meet at all, where keys hold more than the bits. sample: fingerprints whose pairs tell
    how often a partition agrees."""
    share = np.diag(together) / max(n, 1)
    agree = share**2 + (1 - share) ** 2
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(2, distance + 2):
        groups = group_bits(n, together, parts)
        costs = []
        for bits in groups:
            law = np.zeros(distance + 2)  # of the distance of two fingerprints on these bits
            law[0] = 1
            for b in bits:
                law[1:] = law[1:] * agree[b] + law[:-1] * (1 - agree[b])
                law[0] *= agree[b]
            if sample is not None and len(sample) > 1:
                law = np.maximum(law[: distance + 1], near_share(sample, bits, distance))
            own, ball, within = [0.0], 0.0, 0.0
            for t in range(distance + 1):
                ball += float(_choose(len(bits), t))
                within += law[t]
                own.append(n * (ball + (t > 0)) * PROBE_COST + n * n * near * within * CANDIDATE_COST)
            costs.append(own)
        least = [(0.0, ())] + [(float("inf"), ())] * (distance + 1)
        for own in costs:
            least = [min((least[u - t][0] + own[t], (*least[u - t][1], t)) for t in range(u + 1)) for u in range(distance + 2)]
        cost, units = least[distance + 1]
        if best is None or cost < best[0]:
            best = cost, [(bits, t - 1) for bits, t in zip(groups, units, strict=True) if t]
    return best[1]


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def key_of(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    """The partition's bits, packed; bit 0 is the highest of a fingerprint."""
    out = np.zeros(len(prints), np.uint64)
    for b in bits:
        out = (out << np.uint64(1)) | ((prints >> np.uint64(BITS - 1 - b)) & np.uint64(1))
    return out


def ball(width: int, radius: int) -> np.ndarray:
    """Masks of up to radius of width bits, without the empty one."""
    return np.array([sum(1 << b for b in c) for r in range(1, radius + 1) for c in combinations(range(width), r)], np.uint64)


# Candidates and links


def probes(prints: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """part, key, probe, print: each fingerprint under its own value of each partition, and as probe under the near ones."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(own), 4096):
                x = own[at : at + 4096]
                for part, (bits, radius) in enumerate(plan):
                    key = key_of(x, bits)
                    yield _rows(part, key, False, x)
                    if radius > 0:
                        masks = ball(len(bits), radius)
                        yield _rows(part, (key[:, None] ^ masks[None, :]).reshape(-1), True, np.repeat(x, len(masks)))

    return prints.select("print").mapInArrow(kernel, "part int, key long, probe boolean, print long")


def _rows(part: int, key: np.ndarray, probe: bool, prints: np.ndarray) -> pa.RecordBatch:
    n = len(key)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(key.view(np.int64)), pa.array(np.full(n, probe)), pa.array(prints.view(np.int64))], ["part", "key", "probe", "print"])


def links(prints: DataFrame, distance: int, plan: list[tuple[list[int], int]], bucket: int = BUCKET) -> DataFrame:
    """a, b: spanning forests of the links within the distance between distinct fingerprints."""
    rows = probes(prints, plan)
    counts = rows.groupBy("part", "key").count().where(F.col("count") > bucket).select("part", "key", F.ceil(F.col("count") / bucket).cast("int").alias("cut"))
    big = stash(counts, "simhash-buckets")
    if big.isEmpty():
        rows = rows.withColumns({"x": F.lit(0), "y": F.lit(0), "side": F.lit(0)})
    else:
        # a large bucket is a grid of blocks; an item (x, y) with x <= y compares block x with block y
        rows = rows.join(big, ["part", "key"], "left").withColumn("cut", F.coalesce("cut", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("print"), F.col("cut")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
        rows = rows.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")}).drop("cut", "own", "other")
    spread = rows.repartition(shuffle_parts(prints.sparkSession), "part", "key", "x", "y").sortWithinPartitions("part", "key", "x", "y")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for item, probe, found in _items(batches):
            if len(found) > 1:
                a, b = forest(found, probe, distance)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return spread.select("part", "key", "x", "y", "probe", "print").mapInArrow(kernel, "a long, b long").distinct()


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """Work items of sorted rows; one is held at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last = None
    for batch in batches:
        cols = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        probe, prints = batch.column(4).to_numpy(zero_copy_only=False), batch.column(5).to_numpy().view(np.uint64)
        if not len(cols):
            continue
        cuts = np.concatenate([[0], np.flatnonzero((cols[1:] != cols[:-1]).any(axis=1)) + 1, [len(cols)]])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            item = tuple(cols[lo])
            if item != last and held:
                yield last, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                held = []
            last = item
            held.append((probe[lo:hi], prints[lo:hi]))
    if held:
        yield last, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def forest(prints: np.ndarray, probe: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links of one work item: own rows against own rows and probes against own rows."""
    own, near = np.unique(prints[~probe]), np.unique(prints[probe])
    if not len(own):
        return own, own
    nodes = np.concatenate([own, near])
    waiting = np.ones(len(nodes), bool)
    a, b = [], []
    if len(nodes) <= 64:  # small items at once: most have no link at all
        hit = np.bitwise_count(nodes[:, None] ^ own[None, :]) <= distance
        if hit.sum() <= len(own):
            return own[:0], own[:0]
    for start in range(len(own)):
        if not waiting[start]:
            continue
        waiting[start] = False
        stack = [start]
        while stack:
            i = stack.pop()
            against = slice(0, len(nodes)) if i < len(own) else slice(0, len(own))
            new = np.flatnonzero(waiting[against] & (np.bitwise_count(nodes[against] ^ nodes[i]) <= distance))
            if len(new):
                waiting[new] = False
                stack += new.tolist()
                a.append(np.full(len(new), nodes[i], np.uint64))
                b.append(nodes[new])
    if not a:
        return own[:0], own[:0]
    x, y = np.concatenate(a), np.concatenate(b)
    keep = x != y
    return np.minimum(x, y)[keep], np.maximum(x, y)[keep]


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of an edge (a, b): the smallest node that is reachable."""
    both = stash(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "components-edges")
    # labels that are counted to be few are broadcast, so that the hub of a large group is not one task's key
    label = stash(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "components-label")
    few = label.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    small = F.broadcast if few else (lambda df: df)
    while True:
        near = both.join(small(label.withColumnRenamed("node", "b")), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("least"))
        lower = label.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "least").alias("root"))
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("further"))
        new = stash(lower.join(small(jump), "root", "left").select("node", "old", F.least("root", F.coalesce("further", "root")).alias("root")), "components-label")
        release(label)
        if new.where("old <> root").isEmpty():
            release(both)
            return new.select("node", "root")
        label = new.select("node", "root")


def near_duplicates(df: DataFrame, words: int = 5, distance: int = 4, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """doc_id, print, component_id (the smallest doc_id of all that links lead to) of every row."""
    docs = stash(simhash(df, words, id_col, text_col), "simhash-prints")
    prints = stash(docs.groupBy("print").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("held")), "simhash-distinct")
    n, together = bit_statistics(prints)
    plan = plan_search(n, together, distance, sample=sampled(prints, n))
    edges = stash(links(prints, distance, plan, bucket), "simhash-links")
    roots = prints.join(components(edges).withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stash(roots.join(least, "root").select("print", "component_id"), "simhash-components")
    hot = stash(prints.where(F.col("held") > HOT_SHARE * docs.count()).select("print"), "simhash-hot")
    release(prints, edges)
    return hot_join(docs, named, ["print"], hot).select("doc_id", "print", "component_id")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")

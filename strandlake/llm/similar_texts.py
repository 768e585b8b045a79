"""Groups of similar texts: SimHash candidates, verified on their word shingles.

Texts with the same words are one node. Fingerprints weigh each distinct shingle
once, as the similarity does, however often a text repeats it. Nodes are candidates if their fingerprints
differ in at most DISTANCE bits and the numbers of their distinct shingles allow
the similarity; the search is the generalised pigeonhole of near_duplicates, with
the size class as part of every key. A pair is linked if the Jaccard similarity of
its shingle sets is SIMILARITY or more, counted exactly. A work item with few
candidates returns all of them, a dense one (more than DENSE for each node) the
minimum spanning tree of its candidates by distance and its rows. Where verified
pairs leave candidates of a dense item in different groups, those rows meet again
with their shingle sets (in blocks of OPEN_BYTES), and every candidate between
groups is counted there. So pairs stay linear in the rows and no candidate is left
undecided. A fingerprint distance of 14 bits or less holds for 95 % of the pairs of
similarity 0.8, 99.9 % of those of 0.9 (binomial estimate).

Nulls: a null text has no words; texts without words are one node. Null ids come
last when the smallest id of a group is sought. Columns of the input stay; empty
tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PLACE, blocks, by_rows, on_files, place, release, shuffle_parts, stash, whole_rows
from .near_duplicates import ball, bit_statistics, components, key_of, majority_bits, plan_search, sampled, shingle_hashes

WORDS = 5
SIMILARITY = 0.8
DISTANCE = 14
BUCKET = 4096
DENSE = 1
#: Bytes of shingle sets in one block of a dense item; two blocks are held at a time.
OPEN_BYTES = 32 << 20
#: What a row is in a work item: compared with all, or with own rows only.
OWN, PROBE = 0, 1
OPEN = ["side", "within", "node", "print", "root"]
FOUND = ["a", "b", "item", "side", "within", "print"]


def described(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """file, at, id, two digests of the words, print and number of distinct shingles of every row of a table on files."""
    given = docs.select(*place(docs), F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("body"))
    id_type = given.schema["id"].dataType.simpleString()

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, 2 << 20):
            bodies = batch.column("body").to_pylist()
            flat = [b" ".join((b or b"").lower().split()) for b in bodies]
            shingles = [list(set(shingle_hashes(b, words))) for b in bodies]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in (*PLACE, "id")),
                    pa.array(np.array([xxhash.xxh64_intdigest(x, 1) for x in flat], np.uint64).view(np.int64)),
                    pa.array(np.array([xxhash.xxh64_intdigest(x, 2) for x in flat], np.uint64).view(np.int64)),
                    pa.array(majority_bits(shingles).view(np.int64)),
                    pa.array([len(x) for x in shingles], pa.int64()),
                ],
                [*PLACE, "id", "d1", "d2", "print", "size"],
            )

    return given.mapInArrow(kernel, f"file long, at long, id {id_type}, d1 long, d2 long, print long, size long")


def size_class(similarity: float) -> Column:
    """Sizes that allow the similarity are in one class or in neighbouring ones."""
    return F.floor(F.log(F.greatest(F.col("size"), F.lit(1)).cast("double")) / math.log(1 / similarity)).cast("int")


def candidates(nodes: DataFrame, distance: int, similarity: float, bucket: int = BUCKET, dense: int = DENSE) -> DataFrame:
    """a, b: pairs of nodes (node, print, size) within the distance, item null; dense items give a spanning tree and
    their rows (a the node, its item, side, whether own rows meet each other, print)."""
    spark = nodes.sparkSession
    n, together = bit_statistics(nodes)
    classes = nodes.withColumn("class", size_class(similarity))
    held = dict(classes.groupBy("class").count().collect())  # some 100 classes at most
    near = sum(c * (c + held.get(k + 1, 0)) for k, c in held.items()) / max(1, n * n)
    plan = plan_search(n, together, distance, near, sampled(nodes, n))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [batch.column(i).to_numpy() for i in range(3)]
            for at in range(0, batch.num_rows, 2048):
                node, prints, kind = (c[at : at + 2048] for c in every)
                x = prints.view(np.uint64)
                for part, (bits, radius) in enumerate(plan):
                    key = key_of(x, bits)
                    masks = ball(len(bits), radius) if radius > 0 else np.zeros(0, np.uint64)
                    # own rows; probes of the own class; all values as probes of the next class
                    yield _rows(part, key, kind, OWN, node, x)
                    if len(masks):
                        yield _rows(part, (key[:, None] ^ masks).reshape(-1), np.repeat(kind, len(masks)), PROBE, np.repeat(node, len(masks)), np.repeat(x, len(masks)))
                        yield _rows(part, (key[:, None] ^ masks).reshape(-1), np.repeat(kind, len(masks)) + 1, PROBE, np.repeat(node, len(masks)), np.repeat(x, len(masks)))
                    yield _rows(part, key, kind + 1, PROBE, node, x)

    rows = classes.select("node", "print", "class").mapInArrow(emit, "part int, key long, class int, side int, node long, print long")
    item = ["part", "class", "key"]
    big = stash(rows.groupBy(*item).count().where(F.col("count") > bucket).select(*item, F.ceil(F.col("count") / bucket).cast("int").alias("cut")), "similar-buckets")
    if big.isEmpty():
        rows = rows.withColumns({"x": F.lit(0), "y": F.lit(0)})
    else:
        # a large item is a grid: own rows of block x meet probes of block y, and own rows of block y where x <= y
        rows = rows.join(big, item, "left").withColumn("cut", F.coalesce("cut", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("node"), F.col("cut")).cast("int"))
        cell = lambda x, y, side: F.struct(x.alias("x"), y.alias("y"), F.lit(side).alias("side"))
        every = F.sequence(F.lit(0), F.col("cut") - 1)
        before = F.filter(every, lambda o: o < F.col("own"))
        grid = F.when(F.col("side") == OWN, F.concat(F.transform(every, lambda o: cell(F.col("own"), o, OWN)), F.transform(before, lambda o: cell(o, F.col("own"), PROBE)))).otherwise(F.transform(every, lambda o: cell(o, F.col("own"), PROBE)))
        rows = rows.withColumn("cell", F.explode(grid)).select(*item, "cell.x", "cell.y", "cell.side", "node", "print")
    order = [*item, "x", "y"]
    spread = rows.repartition(shuffle_parts(spark), *order).sortWithinPartitions(*order)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, side, node, prints in work_items(batches):
            own = side == OWN
            a, b, many = _pairs_or_tree(node[own], prints[own], node[~own], prints[~own], at[3] == at[4], distance, dense)
            if len(a):
                none = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), none, none.cast(pa.int32()), none.cast(pa.bool_()), none], FOUND)
            if many:
                item = np.full(len(node), xxhash.xxh64_intdigest(repr(at).encode()), np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.nulls(len(node), pa.int64()), pa.array(item), pa.array(side), pa.array(np.full(len(node), at[3] == at[4])), pa.array(prints.view(np.int64))], FOUND)

    return spread.select(*order, "side", "node", "print").mapInArrow(kernel, "a long, b long, item long, side int, within boolean, print long")


def _rows(part: int, key: np.ndarray, kind: np.ndarray, side: int, node: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    n = len(key)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, part, np.int32)), pa.array(key.view(np.int64)), pa.array(kind.astype(np.int32)), pa.array(np.full(n, side, np.int32)), pa.array(node), pa.array(prints.view(np.int64))],
        ["part", "key", "class", "side", "node", "print"],
    )


def work_items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray, np.ndarray]]:
    """Work items of sorted rows; one is held at a time."""
    held: list[tuple[np.ndarray, ...]] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)], axis=1)
        rest = (batch.column(5).to_numpy(), batch.column(6).to_numpy(), batch.column(7).to_numpy().view(np.uint64))
        cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            at = tuple(keys[lo].tolist())
            if at != last and held:
                yield last, *(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
            last = at
            held.append(tuple(x[lo:hi] for x in rest))
    if held:
        yield last, *(np.concatenate(x) for x in zip(*held, strict=True))


def item_pairs(own: np.ndarray, own_prints: np.ndarray, other: np.ndarray, other_prints: np.ndarray, within: bool, distance: int, dense: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of an item within the distance; if they are many, a minimum spanning tree of them."""
    return _pairs_or_tree(own, own_prints, other, other_prints, within, distance, dense)[:2]


def _pairs_or_tree(own: np.ndarray, own_prints: np.ndarray, other: np.ndarray, other_prints: np.ndarray, within: bool, distance: int, dense: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of an item, and whether they are only a tree."""
    nodes, prints = np.concatenate([own, other]), np.concatenate([own_prints, other_prints])
    n, k = len(nodes), len(own)
    if n < 2 or not k:
        return nodes[:0], nodes[:0], False
    a, b, held = [], [], 0
    for lo in range(0, k, 512):
        begin = lo if within else k
        hit = np.bitwise_count(own_prints[lo : lo + 512, None] ^ prints[None, begin:]) <= distance
        i, j = np.nonzero(hit)
        i, j = i + lo, j + begin
        keep = (j > i) & (nodes[i] != nodes[j])
        a.append(i[keep])
        b.append(j[keep])
        held += len(a[-1])
        if held > dense * n + 64:
            return *_spanning(nodes, prints, k, within, distance), True
    return nodes[np.concatenate(a)], nodes[np.concatenate(b)], False


def _spanning(nodes: np.ndarray, prints: np.ndarray, k: int, within: bool, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Prim's trees over the pairs within the distance: the nearest pairs that join what pairs join."""
    n = len(nodes)
    best, source = np.full(n, 127, np.int64), np.full(n, -1)
    waiting = np.ones(n, bool)
    a, b = [], []
    for _ in range(n):
        i = int(np.argmin(np.where(waiting, best, 1000)))
        waiting[i] = False
        if source[i] >= 0 and nodes[i] != nodes[source[i]]:
            a.append(int(source[i]))
            b.append(i)
        far = np.bitwise_count(prints ^ prints[i]).astype(np.int64)
        if i >= k:
            far[k:] = 1000
        elif not within:
            far[:k] = 1000
        nearer = waiting & (far <= distance) & (far < best)
        best[nearer], source[nearer] = far[nearer], i
    return nodes[a], nodes[b]


def shingle_sets(docs: DataFrame, told: DataFrame, nodes: DataFrame, words: int, text_col: str) -> DataFrame:
    """node, shingles (sorted hashes as bytes) of the nodes (column row); told says where a row stands in docs."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, 2 << 20):
            out = [np.unique(np.array(shingle_hashes(b, words), np.uint64)).tobytes() for b in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], ["node", "shingles"])

    wanted = stash(told.join(nodes, "row", "left_semi").select(*PLACE, "row"), "similar-places")
    texts = by_rows(docs.select(*place(docs), F.col(text_col).cast("string").cast("binary").alias("body")), wanted, PLACE, "inner")
    return texts.select("row", "body").mapInArrow(sets, "node long, shingles binary")


def verified(pairs: DataFrame, docs: DataFrame, told: DataFrame, words: int, similarity: float, text_col: str) -> DataFrame:
    """The pairs whose shingle sets are similar enough, as a written table."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                every = len(p) + len(q) - both
                keep.append(both >= similarity * every - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = stash(pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))).distinct(), "similar-ends")
    held = stash(shingle_sets(docs, told, ends, words, text_col), "similar-sets")
    joined = pairs.join(held.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a").join(held.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    edges = stash(joined.select("a", "b", "left", "right").mapInArrow(judge, "a long, b long"), "similar-edges")
    release(ends, held)
    return edges


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of equal keys (the first columns) of sorted rows, one group held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(keys)], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1, [len(at)]])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(at[lo].tolist())
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def still_open(members: DataFrame, distance: int, limit: int) -> DataFrame:
    """Rows of dense items (item, side, within, node, print, root, size) that have a candidate in another group; item
    and cell name two blocks (half 0 and 1) or one that are to be compared."""
    spark = members.sparkSession

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, 1):
            side, within, root = rows["side"].to_numpy(), rows["within"][0].as_py(), rows["root"].to_numpy()
            if (root == root[0]).all():
                continue
            prints = rows["print"].to_numpy().view(np.uint64)
            wanted = np.zeros(len(side), bool)
            first, second = np.flatnonzero(side == OWN), np.flatnonzero((side == PROBE) | within)
            for lo in range(0, len(first), 512):
                i = first[lo : lo + 512]
                hit = (np.bitwise_count(prints[i, None] ^ prints[None, second]) <= distance) & (root[i, None] != root[None, second])
                wanted[i] |= hit.any(axis=1)
                wanted[second] |= hit.any(axis=0)
            rows = rows.filter(pa.array(wanted))
            if not rows.num_rows:
                continue
            block = np.cumsum(8 * rows["size"].to_numpy()) // limit
            block = np.unique(block, return_inverse=True)[1]
            n = int(block[-1]) + 1
            for p in range(n):
                for q in range(p, n):
                    part = rows.filter(pa.array((block == p) | (block == q)))
                    half = (block[(block == p) | (block == q)] != p).astype(np.int32)
                    cell = pa.array(np.full(part.num_rows, p * n + q, np.int64))
                    yield from pa.Table.from_arrays([part["item"], cell, pa.array(half), *(part[c] for c in OPEN)], ["item", "cell", "half", *OPEN]).combine_chunks().to_batches()

    spread = members.repartition(shuffle_parts(spark), "item").sortWithinPartitions("item")
    return spread.select("item", "size", *OPEN).mapInArrow(kernel, "item long, cell long, half int, side int, within boolean, node long, print long, root long")


def decided(open_rows: DataFrame, distance: int, similarity: float) -> DataFrame:
    """a, b: verified pairs that join the groups of dense items, every candidate between two groups counted."""
    spark = open_rows.sparkSession

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, 2):
            a, b = joining(*(rows[c].to_numpy() for c in ("half", "side")), rows["within"][0].as_py(), *(rows[c].to_numpy() for c in ("node", "print", "root")), rows["shingles"].to_pylist(), distance, similarity)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    spread = open_rows.repartition(shuffle_parts(spark), "item", "cell").sortWithinPartitions("item", "cell")
    return spread.select("item", "cell", "half", *OPEN, "shingles").mapInArrow(kernel, "a long, b long").distinct()


def joining(half: np.ndarray, side: np.ndarray, within: bool, node: np.ndarray, prints: np.ndarray, root: np.ndarray, shingles: list[bytes], distance: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the distance and similar enough that join groups (root) of one item; nearest ones first."""
    x, group, two = prints.view(np.uint64), root.copy(), bool(half.any())
    sets = [np.frombuffer(s, np.uint64) for s in shingles]
    size = np.array([len(s) for s in sets])
    ids = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(size)[:-1])
    mark = np.zeros(1 + max((int(i.max()) for i in ids if len(i)), default=0), bool)
    a, b = [], []
    for i in np.flatnonzero(side == OWN):
        far = np.bitwise_count(x ^ x[i])
        meet = (far <= distance) & (group != group[i]) & (np.minimum(size, size[i]) >= similarity * np.maximum(size, size[i]) - 1e-9)
        if not within:
            meet &= side == PROBE
        if two:
            meet &= half != half[i]
        found = np.flatnonzero(meet)
        if not len(found):
            continue
        mark[ids[i]] = True
        for j in found[np.argsort(far[found], kind="stable")]:
            if group[j] == group[i]:
                continue
            both = int(np.count_nonzero(mark[ids[j]]))
            if both >= similarity * (size[i] + size[j] - both) - 1e-9:
                group[group == group[j]] = group[i]
                a.append(i)
                b.append(j)
        mark[ids[i]] = False
    return node[a], node[b]


def one_of_each_group(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET, dense: int = DENSE, open_bytes: int = OPEN_BYTES) -> DataFrame:
    """The rows of docs that stay: of each group of similar texts the one with the smallest id (of equal ids, the first row)."""
    docs = on_files(docs, "similar-docs")
    told = stash(described(docs, words, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "similar-described")
    same = ["d1", "d2", "print", "size"]
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    nodes = stash(told.groupBy(*same).agg(F.min("row").alias("node"), first.alias("first")), "similar-nodes")
    found = stash(candidates(nodes.where("size > 0").select("node", "print", "size"), distance, similarity, bucket, dense), "similar-pairs")
    edges = verified(found.where("item is null").select("a", "b").distinct(), docs, told, words, similarity, text_col)
    members = found.where("item is not null").select("item", "side", "within", F.col("a").alias("node"), "print")
    if not members.isEmpty():
        members = members.join(nodes.select("node", "size"), "node").join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
        rest = stash(still_open(members, distance, open_bytes), "similar-open")
        if not rest.isEmpty():
            ends = stash(rest.select(F.col("node").alias("row")).distinct(), "similar-open-ends")
            sets = shingle_sets(docs, told, ends, words, text_col)
            more = stash(edges.union(decided(rest.join(sets, "node"), distance, similarity)), "similar-edges")
            release(edges, ends)
            edges = more
        release(rest)
    roots = nodes.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    stay = roots.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    go = stash(told.join(stay, "row", "left_anti").select(*PLACE), "similar-go")
    release(told, nodes, found, edges)
    return by_rows(whole_rows(docs), go, PLACE, "left_anti").select("doc.*")

"""Removal of repeated passages by a sampled suffix array with deep-shallow sorting.

A byte goes if a LENGTH-byte string that covers it also starts earlier (in a
smaller id, or earlier in the same text). Every such string holds an anchor: of its
GRAM-byte substrings the one with the least hash, the leftmost of equal ones. Equal
strings have their anchor at the same place, so only strings of one anchor need
comparing, and neighbouring strings mostly share an anchor.

1. Texts are packed into chunks of about CHUNK bytes, written to the shared folder.
2. The distinct anchor hashes of each chunk are dealt by hash range; those seen
   twice come back to their chunk as bits.
3. For each repeated anchor the chunk sends the bytes of the strings that chose it
   (a span, a little over LENGTH bytes). Equal spans of a chunk are sent once.
4. Per anchor the spans' suffixes are sorted from the anchor to the right, and the
   part before it from right to left: multikey quicksort to SHALLOW bytes beyond the
   anchor, then a blind trie for each group that still has a common prefix. Common
   prefixes of sorted neighbours tell which strings are equal; all but the earliest
   of each are removed. An anchor that more than HOT_CHUNKS chunks hold is hot: its
   spans would meet in one task, so its strings go singly instead, by 128 bits of hash,
   and the earliest of each is told by an aggregation that begins in every task.
5. The removed runs go back to their chunks and the rest of each text is put together.

What a task holds is bounded by the chunk, and by the buckets, whose number follows
the size of the input. Order: id, then the place in the chunks for repeated ids;
null ids come last. Nulls: a null text is empty, a null id is returned as it is.
Texts shorter than LENGTH lose nothing. Other columns are dropped; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, hot_join, release, stash, table, text_bytes

LENGTH = 100
GRAM = 32
SHALLOW = 16
STEP = 8  # bytes that the quicksort compares at once
CHUNK = 4 << 20
BUCKET_ANCHORS = 1_000_000
BUCKET_BYTES = 6 << 20
HOT_CHUNKS = 256
#: A string that occurs more often meets its earliest place by a broadcast; so many partitions at most take the buckets.
HOT_STRINGS, MOST_PARTS = 100_000, 20_000
SCAN = 1 << 18
NULL_ID = (1 << 63) - 1

_U = np.uint64
_TABLE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_MIX = _U(0xBF58476D1CE4E5B9)


# Anchors


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each substring of gram bytes (a power of two)."""
    h, width = _TABLE[data], 1
    while width < gram:
        h = h[:-width] * _U(pow(_BASE, width, 1 << 64)) + h[width:]
        width *= 2
    h = (h ^ (h >> _U(29))) * _MIX
    return h ^ (h >> _U(32))


def _window_least(keys: np.ndarray, width: int) -> np.ndarray:
    out, have = keys, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def runs_of(data: np.ndarray, sizes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of strings of one anchor: document, first start in it, number, place of the anchor from the first, hash."""
    none = np.zeros(0, np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    begins = np.concatenate([[0], np.cumsum(sizes)])
    first = 0
    while first < len(sizes):
        last = first + 1
        while last < len(sizes) and begins[last + 1] - begins[first] <= SCAN:
            last += 1
        lo, hi = int(begins[first]), int(begins[last])
        if hi - lo >= length:
            found += _runs(data[lo:hi], begins[first : last + 1] - lo, first, length, gram)
        first = last
    if not found:
        return none, none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _runs(data: np.ndarray, begins: np.ndarray, first: int, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    step = (1 << 22) - length  # places fit 22 bits of a key
    for base in range(0, max(1, len(data) - length + 1), step):
        part = data[base : base + step + length - 1]
        hashes = gram_hashes(part, gram)
        low = _U((1 << 22) - 1)
        keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        least = _window_least(keys, length - gram + 1)
        doc = np.searchsorted(begins, np.arange(base, base + len(least)), "right") - 1
        at = np.flatnonzero(np.arange(base, base + len(least)) + length <= begins[doc + 1])
        if not len(at):
            continue
        anchor = (least[at] & low).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[at[1:]] != doc[at[:-1]])]))
        count = np.diff(np.concatenate([cut, [len(at)]]))
        start = at[cut]
        yield doc[start] + first, start + base - begins[doc[start]], count, anchor[cut] - start, hashes[anchor[cut]]


# Sorting


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Orders strings by the bytes at which they branch; inner nodes keep only a depth and the branches."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: int | list | None = None  # a leaf is a list of equal strings, a node [depth, {byte: child}]

    def insert(self, i: int) -> None:
        text = self.strings[i]
        if self.root is None:
            self.root = [-1, [i]]
            return
        node = self.root
        while node[0] >= 0:  # blindly down to some leaf
            branch = text[node[0]] if node[0] < len(text) else -1
            node = node[1].get(branch) or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        depth = common_prefix(text, other)
        if depth == len(text) == len(other):
            node[1].append(i)
            return
        branch = text[depth] if depth < len(text) else -1
        parent, key, node = None, None, self.root
        while 0 <= node[0] < depth:  # down again to where they part
            parent, key = node, text[node[0]] if node[0] < len(text) else -1
            node = node[1][key]
        if node[0] == depth:
            node[1][branch] = [-1, [i]]
            return
        new = [depth, {branch: [-1, [i]], (other[depth] if depth < len(other) else -1): node}]
        if parent is None:
            self.root = new
        else:
            parent[1][key] = new

    def ordered(self) -> Iterator[tuple[int, int]]:
        """Strings in order, each with its common prefix with the one before (-1 for the first)."""
        stack, shared = [(self.root, -1)], -1
        while stack:
            node, above = stack.pop()
            if node[0] < 0:
                for k, i in enumerate(node[1]):
                    yield i, above if k == 0 else len(self.strings[i])
                continue
            children = sorted(node[1].items())
            for k, (_, child) in reversed(list(enumerate(children))):
                stack.append((child, above if k == 0 else node[0]))


def deep_shallow(strings: list[bytes], begin: int, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of the strings and the common prefix of each with the one before (0 for the first).

    All strings agree on the first begin bytes, or differ anywhere."""
    order: list[int] = []
    lcp: list[int] = []
    work = [(list(range(len(strings))), 0)]
    while work:
        group, depth = work.pop()
        if len(group) == 1:
            order.append(group[0])
        elif depth >= begin + shallow:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i)
            order += (i for i, _ in trie.ordered())
        else:
            pivot = strings[group[len(group) // 2]][depth : depth + STEP]
            less, same, more = [], [], []
            for i in group:
                key = strings[i][depth : depth + STEP]
                (same if key == pivot else less if key < pivot else more).append(i)
            if more:
                work.append((more, depth))
            work.append((same, depth + STEP) if len(pivot) == STEP else (same, begin + shallow))
            if less:
                work.append((less, depth))
    for k, i in enumerate(order):
        lcp.append(0 if k == 0 else common_prefix(strings[order[k - 1]], strings[i]))
    return order, lcp


def repeated_strings(spans: list[bytes], anchors: list[int], ranks: list[int], length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(span, first, end) of the strings of distinct spans of one anchor that an earlier span holds too.

    A span of n + length - 1 bytes holds n strings; ranks order the spans."""
    rights = [s[a:] for s, a in zip(spans, anchors, strict=True)]
    lefts = [s[:a][::-1] for s, a in zip(spans, anchors, strict=True)]
    if len(spans) == 2:
        left, right = common_prefix(*lefts), common_prefix(*rights)
        late = 0 if ranks[0] > ranks[1] else 1
        # the place of the anchor in a string that both hold
        low = max(length - right, *(a - (len(s) - length) for s, a in zip(spans, anchors, strict=True)), 0)
        high = min(left, *anchors)
        return [(late, anchors[late] - high, anchors[late] - low + 1)] if low <= high else []
    n = len(spans)
    classes = []
    for strings, begin in ((rights, gram), (lefts, 0)):
        order, lcp = deep_shallow(strings, begin)
        classes.append((np.array(order), np.array(lcp)))
    count = np.array([len(s) - length + 1 for s in spans])
    place = np.array(anchors)
    rank = np.array(ranks)
    out = []
    for a in range(length - gram + 1):  # the place of the anchor in a string
        able = (a <= place) & (a > place - count)
        if able.sum() < 2:
            continue
        key = np.zeros(n, np.int64)
        for (order, lcp), depth in zip(classes, (length - a, a), strict=True):
            key[order] = key[order] * n + np.cumsum(lcp < depth) - 1
        at = np.flatnonzero(able)
        at = at[np.lexsort((rank[at], key[at]))]
        late = at[1:][key[at[1:]] == key[at[:-1]]]
        out += [(int(i), int(place[i]) - a, int(place[i]) - a + 1) for i in late]
    return out


# Chunks


def pack(df: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """chunk, ids, sizes and the compressed bytes of neighbouring texts."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, bodies, held = [], [], 0

        def out() -> pa.RecordBatch:
            data = b"".join(bodies)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(b) for b in bodies]], pa.list_(pa.int64())), pa.array([_squeeze(data)], pa.binary())],
                ["chunk", "ids", "sizes", "data"],
            )

        for batch in blocks(batches):
            for i, body in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist(), strict=True):
                if bodies and held + len(body or b"") > chunk:
                    yield out()
                    number, ids, bodies, held = number + 1, [], [], 0
                ids.append(i)
                bodies.append(body or b"")
                held += len(bodies[-1])
        if bodies:
            yield out()

    return df.select("doc_id", "body").mapInArrow(kernel, "chunk long, ids array<long>, sizes array<long>, data binary")


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "big") + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def _unfold(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "big")
    return pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> _U(20)) % _U(buckets)).astype(np.int64)


def _distinct(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each bucket the sorted distinct hashes and whether each comes twice."""
    values, times = np.unique(hashes, return_counts=True)
    home = _bucket_of(values, buckets)
    order = np.argsort(home, kind="stable")
    edges = np.searchsorted(home[order], np.arange(buckets + 1)) if buckets < len(values) else None
    if edges is None:
        for b in np.unique(home).tolist():
            own = home == b
            yield b, values[own], times[own] > 1
        return
    for b in range(buckets):
        own = order[edges[b] : edges[b + 1]]
        if len(own):
            yield b, values[own], times[own] > 1


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def repeated_anchors(chunks: DataFrame, buckets: int, hot_chunks: int = HOT_CHUNKS) -> DataFrame:
    """chunk, bucket and two bits for each of the chunk's distinct hashes of the bucket: seen twice or more, and hot."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunk_rows(batches):
            data = np.frombuffer(_unfold(row["data"]), np.uint8)
            hashes = runs_of(data, np.array(row["sizes"], np.int64))[4]
            rows = [(b, v.tobytes(), np.packbits(d).tobytes()) for b, v, d in _distinct(hashes, buckets)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([row["chunk"]] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                    ["bucket", "chunk", "hashes", "twice"],
                )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _grouped(batches):
            parts = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
            twice = np.concatenate([np.unpackbits(np.frombuffer(r["twice"], np.uint8))[: len(p)] for r, p in zip(rows, parts, strict=True)])
            every = np.concatenate(parts)
            order = np.argsort(every, kind="stable")
            same = every[order][1:] == every[order][:-1]
            flags = twice.astype(bool)
            flags[order[1:][same]] = True
            flags[order[:-1][same]] = True
            edges = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
            hot = np.zeros(len(every), bool)
            hot[order] = np.repeat(np.diff(edges) > hot_chunks, np.diff(edges))
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            kept = [(r["chunk"], np.packbits(flags[a:b]).tobytes(), np.packbits(hot[a:b]).tobytes(), int(flags[a:b].sum())) for r, a, b in zip(rows, at[:-1], at[1:], strict=True) if flags[a:b].any()]
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket] * len(kept), pa.int32()), pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.binary()), pa.array([k[2] for k in kept], pa.binary()), pa.array([k[3] for k in kept], pa.int64())],
                    ["bucket", "chunk", "bits", "hot", "n"],
                )

    dealt = chunks.select("chunk", "sizes", "data").mapInArrow(emit, "bucket int, chunk long, hashes binary, twice binary")
    return dealt.repartition(min(buckets, MOST_PARTS), "bucket").sortWithinPartitions("bucket").mapInArrow(judge, "bucket int, chunk long, bits binary, hot binary, n long")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one bucket after the other; rows come sorted by bucket."""
    last, held = None, []
    for row in _chunk_rows(batches):
        if row["bucket"] != last and held:
            yield last, held
            held = []
        last = row["bucket"]
        held.append(row)
    if held:
        yield last, held


RUN = np.dtype([("chunk", "<i8"), ("row", "<i4"), ("start", "<i4"), ("end", "<i4")])
STRING = np.dtype([("h1", "<i8"), ("h2", "<i8"), ("id", "<i8"), ("row", "<i4"), ("start", "<i4")])
SPAN = np.dtype([("hash", "<u8"), ("id", "<i8"), ("row", "<i4"), ("start", "<i4"), ("count", "<i2"), ("anchor", "<i2")])


def spans_of(chunks: DataFrame, flags: DataFrame, buckets: int, send: int, length: int = LENGTH) -> DataFrame:
    """bucket, chunk, spans of repeated anchors with their bytes, and runs already known to be repeated in the chunk."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunk_rows(batches):
            data = _unfold(row["data"])
            sizes = np.array(row["sizes"], np.int64)
            doc, start, count, anchor, hashes = runs_of(np.frombuffer(data, np.uint8), sizes)
            told = {f["bucket"]: f for f in row["flags"]}
            marked = [(v, *(np.unpackbits(np.frombuffer(told[b][k], np.uint8))[: len(v)].astype(bool) for k in ("bits", "hot"))) for b, v, _ in _distinct(hashes, buckets) if b in told]
            none = np.zeros(0, np.uint64)
            listed = np.sort(np.concatenate([none, *(v[twice] for v, twice, _ in marked)]))
            crowded = np.sort(np.concatenate([none, *(v[hot] for v, _, hot in marked)]))
            spot = np.minimum(np.searchsorted(listed, hashes), max(0, len(listed) - 1))
            keep = np.flatnonzero(listed[spot] == hashes) if len(listed) else np.zeros(0, np.int64)
            begins = np.concatenate([[0], np.cumsum(sizes)])
            ids = np.array([NULL_ID if i is None else i for i in row["ids"]], np.int64)
            keep = keep[np.lexsort((start[keep], doc[keep], ids[doc[keep]]))]  # earliest first
            if len(crowded):
                apart = crowded[np.minimum(np.searchsorted(crowded, hashes[keep]), len(crowded) - 1)] == hashes[keep]
                yield from _single(row["chunk"], data, begins, ids, doc, start, count, keep[apart], length)
                keep = keep[~apart]
            seen: set[tuple[int, bytes]] = set()
            spans, bodies, known = [], [], []
            lows = (begins[doc[keep]] + start[keep]).tolist()
            highs = (begins[doc[keep]] + start[keep] + count[keep] + length - 1).tolist()
            for k, lo, hi, place in zip(keep.tolist(), lows, highs, anchor[keep].tolist(), strict=True):
                body = data[lo:hi]
                if (place, body) in seen:
                    known.append(k)
                else:
                    seen.add((place, body))
                    spans.append(k)
                    bodies.append(body)
            runs = np.zeros(len(known), RUN)
            runs["chunk"], runs["row"], runs["start"], runs["end"] = row["chunk"], doc[known], start[known], start[known] + count[known] + length - 1
            if len(known):
                yield _sent([-1], [row["chunk"]], [b""], [b""], [_merged(runs).tobytes()])
            at = np.array(spans, np.int64)
            home = _bucket_of(hashes[at] >> _U(13), send)
            for b in np.unique(home).tolist():
                own = np.flatnonzero(home == b)
                table = np.zeros(len(own), SPAN)
                k = at[own]
                table["hash"], table["id"], table["row"], table["start"], table["count"], table["anchor"] = hashes[k], ids[doc[k]], doc[k], start[k], count[k], anchor[k]
                yield _sent([b], [row["chunk"]], [_squeeze(table.tobytes())], [_squeeze(b"".join(bodies[i] for i in own.tolist()))], [b""])

    listed = flags.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits", "hot")).alias("flags"))
    return chunks.join(listed, "chunk").select("chunk", "ids", "sizes", "data", "flags").mapInArrow(kernel, "bucket int, chunk long, spans binary, bodies binary, runs binary")


def _single(chunk: int, data: bytes, begins: np.ndarray, ids: np.ndarray, doc: np.ndarray, start: np.ndarray, count: np.ndarray, spans: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    """The distinct strings of spans (earliest first) of a chunk, and runs of those that are not the chunk's first."""
    seen: set[int] = set()
    rows, known = [], []
    for k in spans.tolist():
        d, s = int(doc[k]), int(start[k])
        base = int(begins[d])
        for at in range(s, s + int(count[k])):
            key = xxhash.xxh3_128_intdigest(data[base + at : base + at + length])
            if key in seen:
                known.append((chunk, d, at, at + length))
            else:
                seen.add(key)
                rows.append((key >> 64, key & 0xFFFFFFFFFFFFFFFF, d, at))
    if known:
        yield _sent([-1], [chunk], [b""], [b""], [_merged(np.array(known, RUN)).tobytes()])
    if rows:
        table = np.zeros(len(rows), STRING)
        high, low = (np.array([r[i] for r in rows], np.uint64).view(np.int64) for i in (0, 1))
        table["h1"], table["h2"], table["row"], table["start"] = high, low, [r[2] for r in rows], [r[3] for r in rows]
        table["id"] = ids[table["row"]]
        yield _sent([-2], [chunk], [_squeeze(table.tobytes())], [b""], [b""])


def late_strings(sent: DataFrame, length: int = LENGTH, hot_strings: int = HOT_STRINGS) -> DataFrame:
    """chunk and runs of the single strings that stand earlier too."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                t = np.frombuffer(_unfold(blob), STRING)
                for at in range(0, len(t), 100_000):
                    part = t[at : at + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), chunk)), *(pa.array(np.ascontiguousarray(part[c])) for c in STRING.names)], ["chunk", *STRING.names])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = np.zeros(batch.num_rows, RUN)
            t["chunk"], t["row"], t["start"] = (batch.column(c).to_numpy() for c in ("chunk", "row", "start"))
            t["end"] = t["start"] + length
            t = _merged(t)
            edges = np.flatnonzero(np.concatenate([[True], t["chunk"][1:] != t["chunk"][:-1], [True]])) if len(t) else [0]
            parts = [t[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array([int(p["chunk"][0]) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], ["chunk", "runs"])

    key, place = ["h1", "h2"], F.struct("id", "chunk", "row", "start")
    strings = sent.where("bucket = -2").select("chunk", "spans").mapInArrow(unpack, "chunk long, h1 long, h2 long, id long, row int, start int")
    firsts = stash(strings.groupBy(*key).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-firsts")
    hot = stash(firsts.where(F.col("n") > hot_strings).select(*key), "suffix-hot")
    met = hot_join(strings, firsts, key, hot)
    return met.where(place != F.col("first")).select("chunk", "row", "start").mapInArrow(runs, "chunk long, runs binary")


def _sent(bucket: list, chunk: list, spans: list, bodies: list, runs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(chunk, pa.int64()), *(pa.array(x, pa.binary()) for x in (spans, bodies, runs))], ["bucket", "chunk", "spans", "bodies", "runs"])


def _merged(runs: np.ndarray) -> np.ndarray:
    """Runs of a text that touch become one."""
    if len(runs) < 2:
        return runs
    runs = runs[np.lexsort((runs["start"], runs["row"], runs["chunk"]))]
    new = np.ones(len(runs), bool)
    text = (runs["chunk"][1:] != runs["chunk"][:-1]) | (runs["row"][1:] != runs["row"][:-1])
    group = np.concatenate([[0], np.cumsum(text)]).astype(np.int64)
    reach = np.maximum.accumulate(group * (1 << 32) + runs["end"])  # ends never reach back over a text
    new[1:] = text | (group[1:] * (1 << 32) + runs["start"][1:] > reach[:-1])
    first = np.flatnonzero(new)
    out = runs[first].copy()
    out["end"] = np.maximum.reduceat(reach, first) - group[first] * (1 << 32)
    return out


def judge_bucket(rows: list[dict], length: int = LENGTH) -> np.ndarray:
    """Runs that an earlier text holds too, for all spans of a bucket."""
    tables, bodies, owners = [], [], []
    for r in rows:
        t = np.frombuffer(_unfold(r["spans"]), SPAN)
        data, at = _unfold(r["bodies"]), 0
        for n in (t["count"].astype(np.int64) + length - 1).tolist():
            bodies.append(data[at : at + n])
            at += n
        tables.append(t)
        owners.append(np.full(len(t), r["chunk"], np.int64))
    spans, owner = np.concatenate(tables), np.concatenate(owners)
    order = np.lexsort((spans["start"], spans["row"], owner, spans["id"], spans["hash"]))  # of one anchor the earliest first
    edges = np.flatnonzero(np.concatenate([[True], spans["hash"][order][1:] != spans["hash"][order][:-1], [True]]))
    where, first, end = [], [], []
    places, starts, counts, listed = spans["anchor"].tolist(), spans["start"].tolist(), spans["count"].tolist(), order.tolist()
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if hi - lo < 2:
            continue
        distinct: dict[tuple[int, bytes], int] = {}
        for i in listed[lo:hi]:
            if distinct.setdefault((places[i], bodies[i]), i) != i:
                where.append(i)
                first.append(starts[i])
                end.append(starts[i] + counts[i] + length - 1)
        if len(distinct) > 1:
            own = list(distinct.values())
            for k, a, b in repeated_strings([bodies[i] for i in own], [places[i] for i in own], list(range(len(own))), length):
                where.append(own[k])
                first.append(starts[own[k]] + a)
                end.append(starts[own[k]] + b + length - 1)
    runs = np.zeros(len(where), RUN)
    if len(where):
        runs["chunk"], runs["row"], runs["start"], runs["end"] = owner[where], spans["row"][where], first, end
    return _merged(runs)


def repeated_runs(sent: DataFrame, send: int, hot_strings: int = HOT_STRINGS) -> DataFrame:
    """chunk and runs of bytes that an earlier string covers."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _grouped(batches):
            runs = judge_bucket(rows)
            edges = np.flatnonzero(np.concatenate([[True], runs["chunk"][1:] != runs["chunk"][:-1], [True]])) if len(runs) else [0]
            parts = [runs[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array([int(p["chunk"][0]) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], ["chunk", "runs"])

    spans = sent.where("bucket >= 0").repartition(min(send, MOST_PARTS), "bucket").sortWithinPartitions("bucket")
    found = spans.mapInArrow(kernel, "chunk long, runs binary").union(sent.where("bucket = -1").select("chunk", "runs"))
    if sent.where("bucket = -2").isEmpty():
        return found
    return found.union(late_strings(sent, hot_strings=hot_strings))


def cut(chunks: DataFrame, runs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed (begin, end), kept (the bytes that stay) of every text."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunk_rows(batches):
            data = _unfold(row["data"])
            found = _merged(np.concatenate([np.frombuffer(x, RUN) for x in row["runs"]])) if row["runs"] else np.zeros(0, RUN)
            own = defaultdict(list)
            for r, a, b in zip(found["row"].tolist(), found["start"].tolist(), found["end"].tolist(), strict=True):
                own[r].append((a, b))
            at, kept, removed = 0, [], []
            for r, size in enumerate(row["sizes"]):
                body, pieces, last = data[at : at + size], [], 0
                for a, b in own.get(r, ()):
                    pieces.append(body[last:a])
                    last = b
                pieces.append(body[last:])
                kept.append(b"".join(pieces))
                removed.append([{"begin": a, "end": b} for a, b in own.get(r, ())])
                at += size
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(row["sizes"], pa.int64()),
                    pa.array(removed, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                ],
                ["doc_id", "n_bytes", "removed", "kept", "kept_sha256"],
            )

    every = runs.groupBy("chunk").agg(F.collect_list("runs").alias("runs"))
    return chunks.join(every, "chunk", "left").select("chunk", "ids", "sizes", "data", "runs").mapInArrow(kernel, "doc_id long, n_bytes long, removed array<struct<begin:long,end:long>>, kept binary, kept_sha256 string")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, bucket_anchors: int = BUCKET_ANCHORS, bucket_bytes: int = BUCKET_BYTES, hot_chunks: int = HOT_CHUNKS, hot_strings: int = HOT_STRINGS) -> DataFrame:
    """doc_id, n_bytes, removed, kept, kept_sha256 of every row."""
    chunks = stash(pack(text_bytes(df, id_col, text_col), chunk), "suffix-chunks")
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda acc, x: acc + x))).first()[0] or 0
    buckets = max(16, -(-total // (34 * bucket_anchors)))
    flags = stash(repeated_anchors(chunks, buckets, hot_chunks), "suffix-flags")
    repeated = flags.agg(F.sum("n")).first()[0] or 0
    send = max(16, -(-repeated * 140 // bucket_bytes))
    sent = stash(spans_of(chunks, flags, buckets, send), "suffix-spans")
    runs = stash(repeated_runs(sent, send, hot_strings), "suffix-runs")
    release(flags, sent)
    return cut(chunks, runs)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + (r["end"] - r["begin"]))
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")

"""Benchmark decontamination with suffix arrays over the training texts.

A shard is what one task holds of the training texts: their words are numbered by
the vocabulary of the benchmark, and the suffixes that a window can begin enter the
shard's suffix array (it is sparse: a suffix stays out if the next words are not all
benchmark words, or two neighbours among them are nowhere neighbours in the
benchmark). Every suffix of every benchmark item is looked up in the array by binary
search, which gives all places of its first WINDOW words. Words inside such places
are hit; a document with enough of them is contaminated. The longest verbatim match of
a document comes from sorting the suffixes of its hit runs together with those of
the benchmark's own matched runs by rank doubling, and comparing neighbours.

Texts are positions in one array of numbers, never copies of suffixes: a shard holds
the numbers of its candidate runs and is searched when the texts end or SHARD_WORDS
of them (or SHARD_TEXTS texts) are held. The benchmark is read in blocks of at most BLOCK_WORDS words (some
20 bytes a word in a task, built once in a worker process); each block is a pass over
the texts, and the hits of several blocks are united per document.

Nulls: a null text has no words, null item texts have no windows, a null item id
is written as an empty string, a null doc_id is returned as it is. Items with
one id count once; repeated documents give one row each; other columns are
dropped; an empty benchmark hits nothing; empty documents give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PLACE, blocks, by_rows, on_files, place, stash, table, whole_rows

WINDOW = 13
BLOCK_WORDS = 4_000_000
SHARD_WORDS, SHARD_TEXTS = 2_000_000, 200_000
#: Of 20 words of a document, so many hit ones contaminate it.
SHARE = 20
#: Bytes are lower-cased (A-Z) and every ASCII character but digits and letters becomes a space.
WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A or 0x30 <= c <= 0x39 else 0x20 for c in range(256))


def words_of(body: bytes | None) -> list[bytes]:
    return (body or b"").translate(WORDS).split()


class Benchmark:
    """A block of items as one array of word numbers (0 between items); suffixes are positions in it."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window, self.ids, self.names = window, {}, [item for item, _ in items]
        numbers, starts, owner, sizes, at = [np.zeros(1, np.uint32)], [], [], [], 1
        for k, (_, body) in enumerate(items):
            own = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(body)], np.uint32)
            if not len(own):
                continue
            size = min(window, len(own))
            n = len(own) - size + 1
            starts.append(np.arange(at, at + n))
            owner.append(np.full(n, k, np.int32))
            sizes.append(np.full(n, size, np.int8))
            numbers += [own, np.zeros(1, np.uint32)]
            at += len(own) + 1
        none = np.zeros(0, np.int64)
        self.numbers = np.concatenate(numbers)
        self.starts, self.owner, self.sizes = (np.concatenate(x) if x else none for x in (starts, owner, sizes))
        self.pair_at = pairs_of(self.numbers)
        self.pairs = np.unique(self.pair_at)
        self.least = int(self.sizes.min()) if len(self.sizes) else 0


def pairs_of(numbers: np.ndarray) -> np.ndarray:
    """A key for each two neighbours; those with a 0 count as none (0)."""
    a, b = numbers[:-1].astype(np.uint64), numbers[1:].astype(np.uint64)
    return np.where((a > 0) & (b > 0), (a << np.uint64(32)) | b, np.uint64(0))


def inside(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys


def run_lengths(good: np.ndarray) -> np.ndarray:
    """How many good ones follow each other from each place on."""
    ends = np.flatnonzero(~np.concatenate([good, [False]]))
    return ends[np.searchsorted(ends, np.arange(len(good)))] - np.arange(len(good))


def heads(numbers: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The first size words from each place, as byte strings that sort as the words do."""
    wide = np.concatenate([numbers, np.zeros(size, np.uint32)])
    if not len(at):
        return np.zeros(0, f"S{4 * size}")
    return np.ascontiguousarray(wide[at[:, None] + np.arange(size)].astype(">u4")).view(f"S{4 * size}").reshape(-1)


@dataclass
class Found:
    """What is known of one document."""

    words: int
    runs: list[tuple[int, int]]
    items: list[str]
    longest: int


class Shard:
    """Candidate runs of the documents a task has read; search() builds the suffix array and looks the benchmark up."""

    def __init__(self, bench: Benchmark):
        self.bench, self.sizes, self.held = bench, [], 0
        self.texts: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.offsets: list[np.ndarray] = []

    def add(self, bodies: list[bytes | None]) -> None:
        bench, get = self.bench, self.bench.ids.get
        numbers, sizes = [0], []
        for body in bodies:
            words = words_of(body)
            sizes.append(len(words))
            numbers += [get(w, 0) for w in words]
            numbers.append(0)  # no match crosses documents
        first = len(self.sizes)
        self.sizes += sizes
        text = np.array(numbers, np.uint32)
        if not bench.least or not text.any():
            return
        # words that stand in a stretch of enough benchmark words whose neighbours are neighbours there
        joined = run_lengths(np.concatenate([inside(bench.pairs, pairs_of(text)) & (text[:-1] > 0) & (text[1:] > 0), [False]]))
        able = (text > 0) & (joined + 1 >= bench.least)
        if bench.least == 1:
            able = text > 0
        if not able.any():
            return
        # each stretch to its end, with a 0 behind it
        begin = np.flatnonzero(able)
        reach = np.zeros(len(text) + 1, np.int64)
        np.add.at(reach, begin, 1)
        np.add.at(reach, begin + joined[begin] + 1, -1)
        inner = np.cumsum(reach)[:-1] > 0
        keep = np.flatnonzero(inner)
        gap = np.flatnonzero(np.diff(keep) > 1) + 1
        starts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)]) + 1
        doc = np.searchsorted(starts, keep, "right") - 1
        self.texts.append(np.append(np.insert(text[keep], gap, 0), 0).astype(np.uint32))
        self.docs.append(np.append(np.insert(doc + first, gap, -1), -1))
        self.offsets.append(np.append(np.insert(keep - starts[doc], gap, -1), -1))
        self.held += len(self.texts[-1])

    def search(self) -> list[Found]:
        """What each document added holds of the benchmark."""
        out = [Found(n, [], [], 0) for n in self.sizes]
        if not self.texts:
            return out
        bench = self.bench
        text, docs, offsets = np.concatenate(self.texts), np.concatenate(self.docs), np.concatenate(self.offsets)
        run = run_lengths(text > 0)
        places, ends, held = [], [], []
        sets: dict[bytes, int] = {}  # items that hold a window, as often several windows have the same ones
        for size in np.unique(bench.sizes).tolist():
            at = np.flatnonzero(run >= size)
            suffixes = np.flatnonzero(bench.sizes == size)
            if size > 1:  # only suffixes whose first two words the shard holds can be there
                pairs = np.unique(pairs_of(np.append(text, 0))[at])
                suffixes = suffixes[inside(pairs, bench.pair_at[bench.starts[suffixes]])]
            if not len(at) or not len(suffixes):
                continue
            array = heads(text, at, size)
            order = np.argsort(array, kind="stable")
            array, at = array[order], at[order]
            for lo in range(0, len(suffixes), 200_000):
                part = suffixes[lo : lo + 200_000]
                keys, which = np.unique(heads(bench.numbers, bench.starts[part], size), return_inverse=True)
                low, high = np.searchsorted(array, keys, "left"), np.searchsorted(array, keys, "right")
                here = np.flatnonzero(high > low)
                if not len(here):
                    continue
                spots = np.concatenate([at[a:b] for a, b in zip(low[here].tolist(), high[here].tolist(), strict=True)])
                places.append(spots)
                ends.append(spots + size)
                # a document and a set of items once for each of the windows that they hold
                inner = (high > low)[which]
                pairs = np.unique(np.stack([which[inner], bench.owner[part[inner]].astype(np.int64)], axis=1), axis=0)
                cut = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] != pairs[:-1, 0], [True]]))
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    key, mine = pairs[a, 0], sets.setdefault(pairs[a:b, 1].tobytes(), len(sets))
                    own = np.unique(docs[at[low[key] : high[key]]])
                    held.append(np.stack([own, np.full(len(own), mine)], axis=1))
        if not places:
            return out
        edge = np.zeros(len(text) + 1, np.int64)
        np.add.at(edge, np.concatenate(places), 1)
        np.add.at(edge, np.concatenate(ends), -1)
        hit = np.cumsum(edge)[:-1] > 0
        hit_text = np.where(hit, text, 0)
        shared = inside(np.unique(pairs_of(hit_text)), bench.pair_at) & (bench.pair_at > 0)
        near = np.concatenate([shared, [False]]) | np.concatenate([[False], shared])  # all that a match of two words or more can touch
        longest = np.maximum(longest_matches(np.where(near, bench.numbers, 0), hit_text), 1)
        covered = np.flatnonzero(hit)
        spots = np.stack([docs[covered], offsets[covered]], axis=1)
        cut = np.flatnonzero(np.concatenate([[True], (spots[1:, 0] != spots[:-1, 0]) | (spots[1:, 1] != spots[:-1, 1] + 1)]))
        last = np.append(cut[1:], len(covered)) - 1
        best = np.maximum.reduceat(longest[covered], cut)
        for doc, a, b, n in zip(spots[cut, 0].tolist(), spots[cut, 1].tolist(), spots[last, 1].tolist(), best.tolist(), strict=True):
            out[doc].runs.append((a, b + 1))
            out[doc].longest = max(out[doc].longest, n)
        members = [np.frombuffer(x, np.int64) for x in sets]
        rows = np.unique(np.concatenate(held), axis=0)
        cut = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0], [True]]))
        named: dict[bytes, list[str]] = {}  # documents that hold the same sets share one list
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            key = rows[a:b, 1].tobytes()
            if key not in named:
                named[key] = sorted({bench.names[item] for item in np.unique(np.concatenate([members[x] for x in rows[a:b, 1].tolist()])).tolist()})
            out[rows[a, 0]].items = named[key]
        return out


def longest_matches(bench: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each place of text the longest match with any place of bench, in words; 0 parts the runs of both.

    Ranks of the first 1, 2, 4... words sort the suffixes of the runs; a place's longest match is with the nearest place of
    bench before or behind it."""
    every = np.concatenate([bench, [0], text]).astype(np.int64)
    own = np.flatnonzero(every)
    out = np.zeros(len(text), np.int64)
    if not len(own):
        return out
    n = len(every)
    deepest = int(max(run_lengths(bench > 0).max(initial=0), run_lengths(text > 0).max(initial=0)))
    base = max(n, int(every.max())) + 1
    ranks, width = [every], 1
    while width < deepest:
        last = ranks[-1].astype(np.int64)
        further = np.concatenate([last[width:], np.zeros(min(width, n), np.int64)])[:n]
        # a run that ends before has no rank, so it equals nothing
        whole = (last > 0) & (further > 0)
        next_rank = np.zeros(n, np.int32)
        next_rank[whole] = np.unique(last[whole] * base + further[whole], return_inverse=True)[1] + 1
        ranks.append(next_rank)
        width *= 2
    order = own[np.argsort(suffix_order(every, own), kind="stable")]
    is_bench = order < len(bench)
    index = np.arange(len(order))
    before = np.maximum.accumulate(np.where(is_bench, index, -1))
    behind = np.minimum.accumulate(np.where(is_bench, index, len(order))[::-1])[::-1]
    places = np.flatnonzero(~is_bench)
    for near in (before, behind):
        able = places[(near[places] >= 0) & (near[places] < len(order))]
        a, b = order[able], order[near[able]]
        same = np.zeros(len(able), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            x, y = np.minimum(a + same, n - 1), np.minimum(b + same, n - 1)
            equal = (ranks[level][x] > 0) & (ranks[level][x] == ranks[level][y])
            same += np.where(equal, 1 << level, 0)
        spot = a - len(bench) - 1
        out[spot] = np.maximum(out[spot], same)
    return out


def suffix_order(every: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes at own by rank doubling; an ending run sorts before one that goes on."""
    n, base = len(every), max(len(every), int(every.max())) + 1
    rank, width = every.copy(), 1
    while True:
        further = np.concatenate([rank[width:], np.zeros(min(width, n), np.int64)])[:n]
        inside_run = np.zeros(n, np.int64)
        inside_run[own] = np.unique(rank[own] * base + further[own], return_inverse=True)[1] + 1
        if width >= n or int(inside_run.max()) == len(own) or (inside_run[own] == rank[own]).all():
            return inside_run[own]
        rank, width = inside_run, width * 2


def search(bodies: list[bytes | None], bench: Benchmark) -> list[Found]:
    """What each of the texts holds of the benchmark."""
    shard = Shard(bench)
    shard.add(bodies)
    return shard.search()


#: The benchmark block that this worker process built last, by the name of its broadcast.
_BUILT: dict[tuple[str, int], Benchmark] = {}


def _bench(name: str, handle, window: int) -> Benchmark:
    if (name, window) not in _BUILT:
        _BUILT.clear()
        _BUILT[name, window] = Benchmark(handle.value if handle else [], window)
    return _BUILT[name, window]


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """Blocks of items; the driver holds one at a time."""
    block, held = [], 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).cast("string").cast("binary").alias("b")).where("b is not null")
    for item, body in rows.toLocalIterator():
        body = bytes(body)
        if block and held + len(body) // 2 > block_words:
            yield block
            block, held = [], 0
        block.append((item, body))
        held += len(body) // 2 + 1
    if block:
        yield block


#: Names of items that one Arrow batch of results holds, and a document's more.
BATCH_NAMES = 500_000
FOUND = "n_words long, runs array<struct<begin:int,end:int>>, items array<string>, longest long"


def _pass(source: DataFrame, keys: list[str], handle, window: int, shard_words: int) -> DataFrame:
    """keys and FOUND of every row, for one block of the benchmark."""

    name = uuid.uuid4().hex

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = _bench(name, handle, window)
        shard, kept = Shard(bench), []

        def out() -> Iterator[pa.RecordBatch]:
            every = shard.search()
            told = pa.Table.from_batches(kept).combine_chunks()
            start = named = 0
            for i, one in enumerate(every):  # a batch holds so many names
                named += len(one.items)
                if named > BATCH_NAMES or i + 1 == len(every):
                    yield batch_of(every[start : i + 1], told.slice(start, i + 1 - start))
                    start, named = i + 1, 0

        def batch_of(found: list[Found], told: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    *(told.column(c).combine_chunks() for c in keys),
                    pa.array([x.words for x in found], pa.int64()),
                    pa.array([[{"begin": a, "end": b} for a, b in x.runs] for x in found], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                    pa.array([x.items for x in found], pa.list_(pa.string())),
                    pa.array([x.longest for x in found], pa.int64()),
                ],
                [*keys, "n_words", "runs", "items", "longest"],
            )

        for batch in blocks(batches):
            shard.add(batch.column("body").to_pylist())
            kept.append(pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_pylist(), batch.column(c).type) for c in keys], keys))
            if shard.held > shard_words or len(shard.sizes) > SHARD_TEXTS:
                yield from out()
                shard, kept = Shard(bench), []
        if kept:
            yield from out()

    types = ", ".join(f"{c} long" for c in keys)
    return source.select(*keys, "body").mapInArrow(kernel, f"{types}, {FOUND}")


def find_contamination(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, located: bool = False) -> DataFrame:
    """doc_id, n_words, runs (begin, end words), items, longest match in words; with located also file and at, which
    place() makes."""
    handles = [documents.sparkSession.sparkContext.broadcast(x) for x in _item_blocks(benchmark, item_col, item_text_col, block_words)]
    several = len(handles) > 1
    if several or located:
        documents = on_files(documents, "contamination-documents")
    keys = ["doc_id", *(PLACE if several or located else [])]
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), *(place(documents) if several or located else []), F.col(text_col).cast("string").cast("binary").alias("body"))
    found = _pass(source, keys, handles[0] if handles else None, window, shard_words)
    if several:  # later blocks send hits only
        for handle in handles[1:]:
            found = found.union(_pass(source, keys, handle, window, shard_words).where("size(runs) > 0"))
        found = found.groupBy(*PLACE).agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), merged_runs(F.flatten(F.collect_list("runs"))).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("longest").alias("longest"))
    return found.select("doc_id", *(PLACE if located else []), "n_words", "runs", "items", "longest")


def merged_runs(runs: Column) -> Column:
    """Runs that touch or overlap become one."""
    none = F.array().cast("array<struct<begin:int,end:int>>")

    def add(acc: Column, r: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], r["end"]).alias("end"))
        apart = last.isNull() | (r["begin"] > last["end"])
        return F.when(apart, F.concat(acc, F.array(r))).otherwise(F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined)))

    return F.aggregate(F.array_sort(runs), none, add)


def judged(found: DataFrame, share: int = SHARE) -> DataFrame:
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + (r["end"] - r["begin"]))
    return found.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def clean(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of documents that are not contaminated, with their own columns."""
    documents = on_files(documents, "contamination-documents")
    found = judged(find_contamination(documents, benchmark, id_col, text_col, located=True, **options))
    go = stash(found.where("contaminated").select(*PLACE), "contamination-go")
    return by_rows(whole_rows(documents), go, PLACE, "left_anti").select("doc.*")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    places = F.array_join(F.transform("runs", lambda r: F.concat_ws(":", r["begin"].cast("string"), r["end"].cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", F.col("longest").alias("longest_match"), places.alias("hit_runs"))

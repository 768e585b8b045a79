"""Removal of repeated word passages with a compressed full-text index for each shard.

A word goes if a window of WINDOW consecutive words that covers it also starts in a
document of a smaller id. Windows are judged on the input. Comparing every document
with an index of every shard would grow with the square of the corpus; here a window
meets only the shard that can hold its like:

1. Of a window's substrings of GRAM words the one with the least hash (the leftmost of
   equal ones) is its anchor, so equal windows have equal anchors. Consecutive windows
   of one anchor are a span; a row of anchor, digest of its words, and place stands
   for each span of each document (about one for 20 words).
2. Anchors that occur in two documents or more are candidates. Their equal spans are
   counted together; the words of one of each are fetched from the texts.
3. An anchor with more than HOT_SPANS different spans (a passage that many documents
   hold, each between other words) is hot: its windows are anchored anew by longer
   substrings, of 41 words, then 49, then whole windows, and pass through step 2 once
   more each time. So no anchor fills a task, and few windows become rows of their own.
4. Spans are dealt by anchor to shards of about SHARD_WORDS words. A shard is an
   `FmIndex` over its spans; the spans are streamed against it by backward search, all
   side by side, and the matching statistics say for every window which suffixes hold
   it. The least document among these is the window's first.
5. Windows of a first document smaller than their own give the removed runs of each
   text; the words outside them are kept.

Digests (128 bits over word hashes) only say which spans are equal copies and so
searched once; what repeats is decided on words. Executors hold one batch of texts, or
one shard. Order of null ids: last, and no smaller than one another; documents of one
id do not remove from one another. A null text has no words; an empty table gives an
empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, HOT_SHARE, PLACE, blocks, by_rows, hot_join, on_files, place, release, stash, table
from .fm_index import FmIndex, LeastIn

WINDOW = 50
GRAM = 8
SHARD_WORDS = 300_000
HOT_SPANS = 1024
#: So many spans at most are broadcast in lists (24 bytes each) to fetch their words.
LISTED = 1_000_000
#: Words hashed at once, and word hashes that a worker remembers.
PIECE, REMEMBERED = 200_000, 1_000_000
NULL_ID = (1 << 63) - 1

SPAN = "anchor long, k1 long, k2 long, doc long, file long, at long, start int, windows int"
UNIT = "shard int, k1 long, k2 long, doc long, words binary"
RUN = "array<struct<from:int,to:int,first:long>>"
_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_places(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the words and the bytes behind their last ones."""
    blank = np.concatenate([[True], _BLANK[np.frombuffer(body, np.uint8)], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    return edge[::2], edge[1::2]


def split_words(body: bytes, starts: np.ndarray, ends: np.ndarray) -> Iterator[list[bytes]]:
    """The words, some at a time."""
    for i in range(0, len(starts), PIECE):
        yield body[starts[i] : ends[min(i + PIECE, len(ends)) - 1]].split()


def word_hashes(body: bytes, known: WordHashes) -> np.ndarray:
    parts = [np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) for words in split_words(body, *word_places(body))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


class Digests:
    """Two 64-bit digests of any run of words, from sums of hashes times powers of a base, which count from the run's start."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.sums, self.powers = [], []
        for k, base in enumerate(_BASES):
            back = _U(pow(int(base), -1, 1 << 64))
            fall, rise = (np.concatenate([[_U(1)], np.full(n, b, np.uint64)]).cumprod(dtype=np.uint64) for b in (back, base))
            own = hashes if k == 0 else mix(hashes + _U(1))
            self.sums.append(np.concatenate([[_U(0)], np.cumsum(own * fall[:-1], dtype=np.uint64)]))
            self.powers.append(rise)

    def __call__(self, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
        return [mix((sums[start + size] - sums[start]) * rise[start] + size.astype(np.uint64)).view(np.int64) for sums, rise in zip(self.sums, self.powers, strict=True)]


def least_gram(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each width neighbouring keys."""
    have = 1
    while have * 2 <= width:
        keys, have = np.minimum(keys[:-have], keys[have:]), have * 2
    spare = width - have
    return np.minimum(keys[: len(keys) - spare], keys[spare:]) if spare else keys


def longer_gram(gram: int, window: int) -> int:
    """The next anchors of a hot one's windows: a window holds a quarter as many of them, one at least."""
    return window + 1 - max(1, (window - gram + 1) // 4)


def spans_of(hashes: np.ndarray, begins: np.ndarray, window: int, gram: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Spans of documents that lie one behind the other (begins: where each begins, and the end): document,
    first word in it, number of windows, anchor, two digests. A document has 2^40 words at most. wanted: of
    each word whether the window from there is taken."""
    none = np.zeros(0, np.int64)
    found = [(none,) * 6]
    step = (1 << 20) - window
    for base in range(0, len(hashes) - window + 1, step):
        part = hashes[base : base + step + window - 1]
        grams, width = part, 1
        while width < gram:
            more = min(width, gram - width)
            grams, width = grams[:-more] * _U(pow(int(_BASES[0]), width, 1 << 64)) + grams[more:], width + more
        grams = mix(grams)
        low = _U((1 << 20) - 1)
        least = least_gram((grams & ~low) | np.arange(len(grams), dtype=np.uint64), window - gram + 1)
        here = np.arange(base, base + len(least))
        doc = np.searchsorted(begins, here, "right") - 1
        inside = here + window <= begins[doc + 1]
        at = np.flatnonzero(inside if wanted is None else inside & wanted[here])
        if not len(at):
            continue
        chosen = (least[at] & low).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (doc[at[1:]] != doc[at[:-1]]) | (np.diff(at) != 1)]))
        count = np.diff(np.concatenate([cut, [len(at)]]))
        start = at[cut]
        digests = Digests(part)(start, count + window - 1)
        found.append((doc[start], start + base - begins[doc[start]], count, grams[chosen[cut]].view(np.int64), *digests))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def body_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc = F.col(f"`{id_col}`").cast("long")
    return df.select(*place(df), doc.alias("doc_id"), F.coalesce(doc, F.lit(NULL_ID)).alias("doc"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"))


def span_rows(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """Spans of the texts; with a column listed only of the windows in the spans that it lists."""
    some = ["listed"] if "listed" in texts.columns else []

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in blocks(batches):
            own = [word_hashes(body, known) for body in batch.column("body").to_pylist()]
            begins = np.concatenate([[0], np.cumsum([len(x) for x in own])])
            wanted = np.zeros(begins[-1], bool) if some else None
            for c in some:
                for begin, listed in zip(begins.tolist(), batch.column(c).to_pylist(), strict=False):
                    for x in listed:
                        wanted[begin + x["start"] : begin + x["start"] + x["windows"]] = True
            doc, start, count, anchor, k1, k2 = spans_of(np.concatenate(own), begins, window, gram, wanted)
            if len(doc):
                of = pa.array(doc)
                yield pa.record_batch([pa.array(anchor), pa.array(k1), pa.array(k2), *(batch.column(c).take(of) for c in ("doc", *PLACE)), pa.array(start, pa.int32()), pa.array(count, pa.int32())], names=["anchor", "k1", "k2", "doc", *PLACE, "start", "windows"])

    return texts.select(*PLACE, "doc", "body", *some).mapInArrow(step, SPAN)


def unit_rows(texts: DataFrame, window: int) -> DataFrame:
    """The words of the listed spans."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            for doc, body, listed in zip(*(batch.column(c).to_pylist() for c in ("doc", "body", "listed")), strict=True):
                starts, ends = word_places(body)
                words = [b" ".join(body[starts[x["start"]] : ends[x["start"] + x["windows"] + window - 2]].split()) for x in listed]
                yield pa.record_batch([pa.array([x["shard"] for x in listed], pa.int32()), pa.array([x["k1"] for x in listed]), pa.array([x["k2"] for x in listed]), pa.array([doc] * len(listed)), pa.array(words, pa.binary())], names=["shard", "k1", "k2", "doc", "words"])

    return texts.select("doc", "body", "listed").mapInArrow(step, UNIT)


def with_lists(texts: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """The texts that rows name by place, with their rows as a list. Lists are broadcast while rows are few; beyond that the
    texts are first thinned to those named, by a broadcast while these are few, and meet their lists by a shuffle."""
    lists = rows.groupBy(*PLACE).agg(F.collect_list(F.struct(*columns)).alias("listed"))
    if rows.limit(LISTED + 1).count() <= LISTED:
        return texts.join(F.broadcast(lists), PLACE)
    named = rows.select(*PLACE).distinct()
    if named.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(named), PLACE, "left_semi")
    return texts.join(lists.hint("shuffle_hash"), PLACE)


def repeated(spans: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Of written spans those whose anchor occurs in two documents; and each different one once: its least
    document with a place there (first), its last document, and the number of its rows."""
    anchors = spans.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("n"))
    anchors = stash(anchors.where("lo < hi").select("anchor", "n"), "window-anchors")
    if anchors.limit(limit + 1).count() <= limit:
        rows = spans.join(F.broadcast(anchors.select("anchor")), "anchor", "left_semi")
    else:
        hot = anchors.where(F.col("n") > HOT_SHARE * spans.count()).select("anchor")
        rows = hot_join(spans, anchors.select("anchor"), ["anchor"], hot)
    rows = stash(rows, "window-spans")
    least = F.min(F.struct("doc", *PLACE, "start")).alias("first")
    different = stash(rows.groupBy("k1", "k2").agg(F.min("anchor").alias("anchor"), least, F.max("doc").alias("last"), F.min("windows").alias("windows"), F.count("*").alias("n")), "window-different")
    release(anchors)
    return rows, different


def first_documents(shard: pa.Table, window: int) -> pa.Table:
    """Search the spans of a shard in its index: for each span runs of windows [from, to) and the least document that holds them."""
    known: dict[bytes, int] = {}
    spans = [[known.setdefault(word, len(known) + 1) for word in words.split()] for words in shard.column("words").to_pylist()]
    sizes = np.array([len(s) for s in spans], dtype=np.int64)
    text = np.array([x for s in spans for x in (*s, 0)], dtype=np.int64)
    docs, rank = np.unique(shard.column("doc").to_numpy(), return_inverse=True)
    index = FmIndex(text)
    least = LeastIn(np.repeat(rank, sizes + 1)[index.places].astype(np.int32))
    queries = text[text > 0]
    first = np.full(len(queries), -1, np.int64)
    for at, length, lo, hi in index.matching_statistics(queries, sizes, window):
        long = length == window
        first[at[long]] = least(lo[long], hi[long])
    ends = np.cumsum(sizes)
    runs = []
    for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
        own = first[end - size : end - window + 1]
        cut = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        runs.append([{"from": a, "to": b, "first": int(docs[own[a]])} for a, b in zip(cut, cut[1:], strict=False)])
    kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("first", pa.int64())]))
    return pa.table([shard.column("k1"), shard.column("k2"), pa.array(runs, kind)], names=["k1", "k2", "runs"])


def join_runs(gone: list[dict]) -> list[dict]:
    """Runs that touch or overlap made one, in order."""
    out: list[dict] = []
    for x in sorted(gone, key=lambda x: x["from"]):
        if out and x["from"] <= out[-1]["to"]:
            out[-1]["to"] = max(out[-1]["to"], x["to"])
        else:
            out.append(dict(x))
    return out


GONE = "array<struct<from:int,to:int>>"
_GONE_ARROW = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def joined_runs(lists: DataFrame) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*(batch.column(c) for c in PLACE), pa.array([join_runs(x) for x in batch.column("gone").to_pylist()], _GONE_ARROW)], names=[*PLACE, "gone"])

    return lists.select(*PLACE, "gone").mapInArrow(step, f"file long, at long, gone {GONE}")


def removed_runs(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS, hot_spans: int = HOT_SPANS, limit: int = BROADCAST_ROWS) -> DataFrame:
    """file, at and the runs of words [from, to) that go, of the texts (from `body_rows`) that lose any."""
    spans, parts, done = stash(span_rows(texts, window, gram), "window-all"), [], []
    while True:
        rows, different = repeated(spans, limit)
        release(spans)
        hot = stash(different.groupBy("anchor").count().where(F.lit(gram < window) & (F.col("count") > hot_spans)).select("anchor"), "window-hot")
        parts.append((rows.join(F.broadcast(hot), "anchor", "left_anti"), different.join(F.broadcast(hot), "anchor", "left_anti")))
        done += [rows, different, hot]
        if hot.isEmpty():
            break
        gram = longer_gram(gram, window)
        spans = stash(span_rows(with_lists(texts, rows.join(F.broadcast(hot), "anchor", "left_semi"), ["start", "windows"]), window, gram), "window-again")
    members, units = parts[0]
    for more, different in parts[1:]:
        members, units = members.unionByName(more), units.unionByName(different)
    size = units.agg(F.sum(F.col("windows") + window - 1).alias("words"), F.sum("n").alias("rows")).first()
    shards = max(1, math.ceil((size.words or 0) / shard_words))
    listed = units.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"), "k1", "k2", "windows", *[F.col("first")[c].alias(c) for c in ("start", *PLACE)])
    words = unit_rows(with_lists(texts, listed, ["shard", "k1", "k2", "start", "windows"]), window)
    found = words.groupBy("shard").applyInArrow(lambda shard: first_documents(shard, window), f"k1 long, k2 long, runs {RUN}")
    found = stash(found, "window-firsts")
    often = stash(units.where(F.col("n") > HOT_SHARE * (size.rows or 0)).select("k1", "k2"), "window-often")
    told = hot_join(members.select("k1", "k2", "doc", *PLACE, "start"), found, ["k1", "k2"], often)
    late = F.filter("runs", lambda r: r["first"] < F.col("doc"))
    own = F.transform(late, lambda r: F.struct((F.col("start") + r["from"]).alias("from"), (F.col("start") + r["to"] + (window - 1)).alias("to")))
    gone = told.select(*PLACE, own.alias("own")).where(F.size("own") > 0).groupBy(*PLACE).agg(F.flatten(F.collect_list("own")).alias("gone"))
    out = stash(joined_runs(gone), "window-gone")
    release(*done, found, often)
    return out


def kept_words(body: bytes, gone: list[dict]) -> tuple[int, Iterator[list[bytes]]]:
    """Number of words, and those outside the runs, some at a time."""
    starts, ends = word_places(body)
    edges = [0, *(x for run in gone for x in (run["from"], run["to"])), len(starts)]

    def parts() -> Iterator[list[bytes]]:
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            yield from split_words(body, starts[a:b], ends[a:b])

    return len(starts), parts()


RESULT = f"doc_id long, n_words long, removed {GONE}, kept string, kept_sha256 string"


def remove_passages(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, **more: int) -> DataFrame:
    """For each document its number of words, the runs of words removed, the kept words joined by a space (null without
    keep_text) and their digest."""
    df = on_files(df, "window-texts")
    texts = body_rows(df, id_col, text_col)
    gone = removed_runs(texts, window, **more)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            counts, kept, digests = [], [], []
            gone = [x or [] for x in batch.column("gone").to_pylist()]
            for body, runs in zip(batch.column("body").to_pylist(), gone, strict=True):
                n, parts = kept_words(body, runs)
                digest, text = hashlib.sha256(), []
                for k, words in enumerate(parts):
                    piece = (b" " if k else b"") + b" ".join(words)
                    digest.update(piece)
                    if keep_text:
                        text.append(piece)
                counts.append(n)
                digests.append(digest.hexdigest())
                kept.append(b"".join(text).decode() if keep_text else None)
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, _GONE_ARROW), pa.array(kept, pa.string()), pa.array(digests)], names=["doc_id", "n_words", "removed", "kept", "kept_sha256"])

    return by_rows(texts, gone, PLACE, "left").select("doc_id", "body", "gone").mapInArrow(step, RESULT)


def op12_fm_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document and how many go as covered by a window of 50 words that a smaller doc_id holds too."""
    out = remove_passages(table(spark, sf_dir, "documents"), keep_text=False)
    removed: Column = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + (r["to"] - r["from"]))
    return out.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")

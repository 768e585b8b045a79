"""Language-model scores by a Brown class-based bigram model.

Words are lower-cased (A-Z) and split by white space; one end token closes each
text. All words are counted over the training texts. Every word counted FLOOR times
or more is a unit of its own (as far as the LOOKUP_WORDS most frequent ones reach,
which bounds what is broadcast: 21 bytes a word); the others share SPELL_UNITS units
by their ending, having too few neighbours to tell a class. The training texts are
written once as numbers of units, and classes come from them by exchange:

1. The SEEDS most frequent words and the endings of all others are clustered on the
   driver by their dense bigram counts, one unit at a time.
2. In each of ROUNDS rounds the classes before and after every unit are counted over
   all training texts (summed in each task, then by blocks of units over a tree of
   tasks), and each unit moves to the class that raises the likelihood of the class
   bigrams most, the others staying. A round that lowers the likelihood is undone.

The end token keeps a class of its own. A token's probability is P(class | previous
class) P(word | class): transitions are smoothed towards the class shares, emissions
by adding ALPHA to each word of a class and to one unknown word.

Words are known to the Python workers by XXH64. Words below the floor are looked up
by a join, aggregated per document first; their logarithms are summed as
decimals, so scores do not depend on the order of a shuffle.

Nulls: a null text is empty (one end token); a null id trains and is not held
out. Repeated rows train as often as they occur and give one row each. Other
columns are dropped; an empty table gives an empty result; if no text trains,
every count is 0.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, release, shuffle_parts, stash, table, text_bytes

END = b"\n"  # no word holds white space
ALPHA = 0.1
CLASSES = 48
SWEEPS = 6
ROUNDS = 2
PULL = 20.0  # strength of the class shares in the smoothing of transitions
FLOOR = 8
SEEDS = 512
SPELL_UNITS = 128
LOOKUP_WORDS = 1 << 21
FLUSH = 400_000
ENDING = 3
HASH_SEED = 42  # of Spark's xxhash64
#: Units whose neighbours are summed together, and how many tasks send theirs to one sum.
UNIT_BLOCK, FAN = 1024, 64
#: Numbers of words that are not in a table start here.
BEYOND = 1 << 40


def tokens_of(body: bytes | None) -> list[bytes]:
    return [*(body or b"").lower().split(), END]


def spell_unit(word: bytes) -> int:
    return zlib.crc32(word[-ENDING:]) % SPELL_UNITS


def word_counts(train: DataFrame) -> DataFrame:
    """word and n over all training texts; partly summed in each task."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in blocks(batches):
            for body in batch.column("body").to_pylist():
                held.update(tokens_of(body))
            if len(held) > FLUSH:
                yield _counted(held)
                held = Counter()
        if held:
            yield _counted(held)

    rows = train.select("body").mapInArrow(kernel, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])


def frequent(counts: DataFrame, most: int) -> int:
    """The count above which there are at most so many words."""
    total = 0
    for n, words in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        total += words
        if total > most:
            return n
    return 0


class Words:
    """Numbers of listed words, by their hashes; others are BEYOND plus the unit of their ending."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.seen: dict[bytes, int] = {}

    def __call__(self, tokens: list[bytes]) -> np.ndarray:
        if len(self.seen) > FLUSH:
            self.seen.clear()
        new = list(set(tokens).difference(self.seen))
        if new:
            keys = np.array([xxhash.xxh64_intdigest(w, HASH_SEED) for w in new], np.uint64).view(np.int64)
            spot = np.minimum(np.searchsorted(self.hashes, keys), len(self.hashes) - 1)
            found = self.hashes[spot] == keys
            number = np.where(found, self.order[spot], BEYOND)
            for i in np.flatnonzero(~found).tolist():
                number[i] += spell_unit(new[i])
            self.seen.update(zip(new, number.tolist(), strict=True))
        return np.fromiter(map(self.seen.__getitem__, tokens), np.int64, len(tokens))


@dataclass
class Listed:
    """The most frequent words, the end token first, then by count: hash, count and unit of the ending."""

    hashes: np.ndarray
    counts: np.ndarray
    endings: np.ndarray
    least: int  # words counted more often than this are here


def listed_words(counts: DataFrame, lookup_words: int = LOOKUP_WORDS, floor: int = FLOOR) -> Listed:
    least = max(floor - 1, frequent(counts, lookup_words))
    end = F.col("word") == F.lit(END)
    rows = counts.where((F.col("n") > least) | end).select(F.xxhash64("word").alias("h"), "n", (F.crc32(F.substring("word", -ENDING, ENDING)) % SPELL_UNITS).cast("int").alias("u"), end.alias("e")).toArrow()
    h, n, u, e = (rows.column(c).to_numpy() for c in ("h", "n", "u", "e"))
    order = np.lexsort((h, -n, ~e.astype(bool)))
    h, n, u = h[order], n[order], u[order]
    if not len(e) or not e.any():
        mark = np.uint64(xxhash.xxh64_intdigest(END, HASH_SEED)).view(np.int64)
        h, n, u = np.concatenate([[mark], h]), np.concatenate([[0], n]), np.concatenate([[spell_unit(END)], u])
    return Listed(h.astype(np.int64), n.astype(np.int64), u.astype(np.int64), least)


def encoded(train: DataFrame, words: Listed) -> DataFrame:
    """The training texts as numbers of units, packed by blocks; a block begins with an end, each text closes with one."""
    shared = train.sparkSession.sparkContext.broadcast(words.hashes)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, own = Words(shared.value), len(shared.value)
        for batch in blocks(batches):
            tokens = [END]
            for body in batch.column("body").to_pylist():
                tokens += tokens_of(body)
            units = number(tokens)
            units = np.where(units >= BEYOND, units - BEYOND + own, units)
            yield pa.RecordBatch.from_arrays([pa.array([_packed(units.astype(np.uint32))], pa.binary())], ["units"])

    return train.select("body").mapInArrow(kernel, "units binary")


def _packed(x: np.ndarray) -> bytes:
    """An array of unsigned numbers, its bytes sorted by significance and compressed."""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "big") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(blob[:8], "big")
    raw = pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(wide, -1).T).view(kind).reshape(-1)


def seed_bigrams(codes: DataFrame, seed_of: np.ndarray, size: int) -> np.ndarray:
    """How often each seed unit follows each other one; a text follows an end."""
    shared = codes.sparkSession.sparkContext.broadcast(seed_of)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                ids = shared.value[_unpacked(blob.as_py(), np.uint32)]
                total += np.bincount(ids[:-1] * size + ids[1:], minlength=size * size)
        cells = np.flatnonzero(total)
        for at in range(0, len(cells), 50_000):
            part = cells[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["cell", "n"])

    rows = codes.mapInArrow(kernel, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # size squared rows at most
    out = np.zeros(size * size, np.int64)
    out[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange(bigrams: np.ndarray, end: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit: each moves to the class that raises the class-bigram likelihood most, until none moves."""
    n = bigrams.astype(np.float64)
    size = len(n)
    order = [u for u in np.argsort(-n.sum(0), kind="stable") if u != end]
    home = np.zeros(size, np.int64)
    for rank, u in enumerate(order):
        home[u] = 1 + rank % max(1, classes - 1)
    member = np.zeros((size, classes))
    member[np.arange(size), home] = 1
    right, left = n @ member, n.T @ member  # to and from each class
    joint = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for u in order:
            own, a = n[u, u], home[u]
            r, f = right[u].copy(), left[u].copy()
            r[a] -= own
            f[a] -= own
            if not r.any() and not f.any() and not own:
                continue
            joint[a] -= r
            joint[:, a] -= f
            joint[a, a] -= own
            rows, cols = joint.sum(1) + f, joint.sum(0) + r  # with the unit's bigrams, but those of its own side
            out, into = r.sum() + own, f.sum() + own
            gain = (_xlogx(joint + r[None, :]) - _xlogx(joint)).sum(1) + (_xlogx(joint + f[:, None]) - _xlogx(joint)).sum(0)
            d = np.diag(joint)
            gain += _xlogx(d + r + f + own) - _xlogx(d + r) - _xlogx(d + f) + _xlogx(d)
            gain -= _xlogx(rows + out) - _xlogx(rows) + _xlogx(cols + into) - _xlogx(cols)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            joint[b] += r
            joint[:, b] += f
            joint[b, b] += own
            if b != a:
                moved += 1
                home[u] = b
                right[:, a] -= n[:, u]
                right[:, b] += n[:, u]
                left[:, a] -= n[u]
                left[:, b] += n[u]
        if not moved:
            break
    return home


def class_contexts(codes: DataFrame, home: np.ndarray, classes: int, joint_only: bool = False) -> DataFrame:
    """block, cells, n: for each block of units the counts of the classes before, the classes after and the unit itself
    before; block -1 holds the class bigrams. Sums of a task."""
    width, shared = 2 * classes + 1, codes.sparkSession.sparkContext.broadcast(home.astype(np.uint8))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = shared.value.astype(np.int64)
        joint, held, size = np.zeros(classes * classes, np.int64), [], 0
        for batch in batches:
            for blob in batch.column(0):
                ids = _unpacked(blob.as_py(), np.uint32).astype(np.int64)
                kinds = home[ids]
                joint += np.bincount(kinds[:-1] * classes + kinds[1:], minlength=classes * classes)
                if joint_only:
                    continue
                before, after, same = ids[1:] * width + kinds[:-1], ids[:-1] * width + classes + kinds[1:], ids[1:][ids[1:] == ids[:-1]] * width + 2 * classes
                held.append(np.unique(np.concatenate([before, after, same]), return_counts=True))
                size += len(held[-1][0])
                if size > 4_000_000:
                    held = [_summed(held)]
                    size = 0
        yield _cells(np.array([-1]), [(np.flatnonzero(joint), joint[joint > 0])])
        if held:
            keys, n = _summed(held)
            of = keys // (width * UNIT_BLOCK)
            edges = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]])
            for at in range(0, len(edges) - 1, 256):
                part = edges[at : at + 257]
                yield _cells(of[part[:-1]], [(keys[a:b] - of[a] * (width * UNIT_BLOCK), n[a:b]) for a, b in zip(part[:-1], part[1:], strict=True)])

    return codes.mapInArrow(kernel, "block int, cells binary, n binary")


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _cells(block: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Cells (as steps from one to the next) and their counts."""
    steps = [_packed(np.diff(c, prepend=0).astype(np.uint32)) for c, _ in parts]
    return pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array(steps, pa.binary()), pa.array([_packed(n.astype(np.uint64)) for _, n in parts], pa.binary())], ["block", "cells", "n"])


def summed_contexts(contexts: DataFrame, classes: int) -> DataFrame:
    """contexts with one row for each block. Tasks are summed by FAN at a time, so no task takes those of all."""
    spark, width = contexts.sparkSession, 2 * classes + 1

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, dense = None, np.zeros(max(UNIT_BLOCK * width, classes * classes), np.int64)

        def out() -> pa.RecordBatch:
            at = np.flatnonzero(dense)
            return _cells(np.array([last]), [(at, dense[at])])

        for batch in batches:
            for block, cells, n in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "n")), strict=True):
                if last is not None and block != last:
                    yield out()
                    dense[:] = 0
                last = block
                dense[np.cumsum(_unpacked(cells, np.uint32).astype(np.int64))] += _unpacked(n, np.uint64).astype(np.int64)
        if last is not None:
            yield out()

    tasks = contexts.rdd.getNumPartitions()
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        spread = contexts.withColumn("part", F.spark_partition_id() % tasks).repartition(max(tasks, shuffle_parts(spark)), "block", "part").sortWithinPartitions("block", "part")
        contexts = spread.select("block", "cells", "n").mapInArrow(kernel, "block int, cells binary, n binary")
    return contexts.repartition(shuffle_parts(spark), "block").sortWithinPartitions("block").mapInArrow(kernel, "block int, cells binary, n binary")


def likelihood(joint: np.ndarray) -> float:
    """Of the class bigrams, but for what no exchange changes."""
    return float(_xlogx(joint).sum() - _xlogx(joint.sum(0)).sum() - _xlogx(joint.sum(1)).sum())


def best_classes(before: np.ndarray, after: np.ndarray, own: np.ndarray, home: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """For each unit the class that raises the likelihood most if it alone moves; class 0 is the end token's."""
    units, k = before.shape
    at = np.arange(units)
    f, r = before.copy(), after.copy()
    f[at, home] -= own
    r[at, home] -= own
    # the bigrams without the unit
    rest = np.repeat(joint[None], units, axis=0)
    rest[at, home] -= r
    rest[at, :, home] -= f
    rest[at, home, home] -= own
    rest = np.maximum(rest, 0)
    rows, cols = rest.sum(2) + f, rest.sum(1) + r  # with the unit's bigrams, but those of its own side
    out, into = (r.sum(1) + own)[:, None], (f.sum(1) + own)[:, None]
    old = _xlogx(rest)
    gain = (_xlogx(rest + r[:, None, :]) - old).sum(2) + (_xlogx(rest + f[:, :, None]) - old).sum(1)
    d = rest[:, np.arange(k), np.arange(k)]
    gain += _xlogx(d + r + f + own[:, None]) - _xlogx(d + r) - _xlogx(d + f) + _xlogx(d)
    gain -= _xlogx(rows + out) - _xlogx(rows) + _xlogx(cols + into) - _xlogx(cols)
    gain[:, 0] = -np.inf
    best = np.argmax(gain, axis=1)
    return np.where(gain[at, best] > gain[at, home] + 1e-9, best, home)


def exchanged(sums: DataFrame, home: np.ndarray, joint: np.ndarray, classes: int) -> np.ndarray:
    """The class of every unit after each moved where it alone raises the likelihood most."""
    width, shared = 2 * classes + 1, sums.sparkSession.sparkContext.broadcast((home.astype(np.uint8), joint.astype(np.float64)))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, joint = shared.value
        for batch in batches:
            for block, cells, n in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "n")), strict=True):
                dense = np.zeros(UNIT_BLOCK * width)
                dense[np.cumsum(_unpacked(cells, np.uint32).astype(np.int64))] = _unpacked(n, np.uint64)
                dense = dense.reshape(UNIT_BLOCK, width)
                units = np.flatnonzero(dense.any(axis=1))
                units = units[units + block * UNIT_BLOCK > 0]  # the end token stays
                for at in range(0, len(units), 64):
                    u = units[at : at + 64]
                    own = home[u + block * UNIT_BLOCK].astype(np.int64)
                    new = best_classes(dense[u, :classes], dense[u, classes : 2 * classes], dense[u, 2 * classes], own, joint)
                    moved = np.flatnonzero(new != own)
                    yield pa.RecordBatch.from_arrays([pa.array((u + block * UNIT_BLOCK)[moved].astype(np.int64)), pa.array(new[moved].astype(np.int32))], ["unit", "class"])

    moves = sums.where("block >= 0").mapInArrow(kernel, "unit long, class int").toArrow()
    new = home.copy()
    new[moves.column("unit").to_numpy()] = moves.column("class").to_numpy()
    return new


def joint_of(sums: DataFrame, classes: int) -> np.ndarray:
    out = np.zeros(classes * classes, np.int64)
    for row in sums.where("block < 0").collect():  # one row
        out[np.cumsum(_unpacked(bytes(row.cells), np.uint32).astype(np.int64))] += _unpacked(bytes(row.n), np.uint64).astype(np.int64)
    return out.reshape(classes, classes)


def cluster(codes: DataFrame, words: Listed, classes: int = CLASSES, seeds: int = SEEDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The class of every unit (own words, then endings), and the class bigrams."""
    seeds = max(1, min(seeds, len(words.hashes)))
    seed_of = np.concatenate([np.arange(seeds), seeds + words.endings[seeds:], seeds + np.arange(SPELL_UNITS)])
    home = exchange(seed_bigrams(codes, seed_of, seeds + SPELL_UNITS), 0, classes)[seed_of]
    best, tables = None, []
    for turn in range(rounds + 1):
        sums = stash(summed_contexts(class_contexts(codes, home, classes, turn == rounds), classes), "class-lm-contexts")
        tables.append(sums)
        joint = joint_of(sums, classes)
        value = likelihood(joint.astype(np.float64))
        if best is not None and value <= best[0]:
            break
        best = value, home, joint
        if turn < rounds:
            home = exchanged(sums, home, joint, classes)
    release(*tables)
    return best[1], best[2]


@dataclass
class Model:
    """What the workers need; its size is bounded by LOOKUP_WORDS, the units and the classes."""

    hashes: np.ndarray  # of the listed words
    known: np.ndarray  # their counts
    word_class: np.ndarray
    spell_class: np.ndarray
    log_room: np.ndarray  # log10 of the denominator of each class's emissions
    log_step: np.ndarray  # log10 of each transition
    tokens: int
    types: int


def train_model(counts: DataFrame, train: DataFrame, classes: int = CLASSES, lookup_words: int = LOOKUP_WORDS, floor: int = FLOOR, seeds: int = SEEDS, rounds: int = ROUNDS) -> tuple[Model, int]:
    """The model, and the count up to which words are not in its table."""
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, types = int(total[0] or 0), int(total[1])
    words = listed_words(counts, lookup_words, floor)
    codes = stash(encoded(train, words), "class-lm-units")
    home, joint = cluster(codes, words, classes, seeds, rounds)
    release(codes)
    word_class, spell_class = home[:-SPELL_UNITS], home[-SPELL_UNITS:]
    # tokens and distinct words of each class
    held = np.bincount(word_class, words.counts, minlength=classes)
    room = np.bincount(word_class, words.counts > 0, minlength=classes)
    rest = counts.where((F.col("n") <= words.least) & (F.col("word") != F.lit(END)))
    for unit, n, distinct in rest.groupBy((F.crc32(F.substring("word", -ENDING, ENDING)) % SPELL_UNITS).alias("unit")).agg(F.sum("n"), F.count(F.lit(1))).collect():
        held[spell_class[int(unit)]] += n
        room[spell_class[int(unit)]] += distinct
    share = (held + ALPHA * (room + 1)) / (held.sum() + ALPHA * (room.sum() + classes))
    step = (joint + PULL * share[None, :]) / (joint.sum(1, keepdims=True) + PULL)
    log_room = np.log10(held + ALPHA * (room + 1))
    log_room[0] = np.log10(held[0] + ALPHA)  # the end token is all of its class
    return Model(words.hashes, words.counts, word_class.astype(np.uint8), spell_class, log_room, np.log10(step), tokens, types), words.least


def score_texts(df: DataFrame, counts: DataFrame, model: Model, least: int) -> DataFrame:
    """Scores of every row of (doc_id, body, held_out)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        number, row, listed = Words(m.hashes), TaskContext.get().partitionId() << 33, len(m.hashes)
        class_of = np.concatenate([m.word_class.astype(np.int64), m.spell_class])
        alone = np.concatenate([np.log10(m.known + ALPHA), np.zeros(SPELL_UNITS)])
        seen = np.concatenate([m.known > 0, np.zeros(SPELL_UNITS, bool)])
        for batch in blocks(batches, 2 << 20):
            tokens, sizes = [], []
            for body in batch.column("body").to_pylist():
                own = tokens_of(body)
                tokens += own
                sizes.append(len(own))
            n = len(sizes)
            ids = number(tokens)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            far = np.flatnonzero(ids >= BEYOND)
            owner = np.searchsorted(starts, far, "right") - 1
            rare = Counter(zip((owner + row).tolist(), [tokens[i] for i in far.tolist()], strict=True))
            ids = np.where(ids >= BEYOND, ids - BEYOND + listed, ids)
            kinds = class_of[ids]
            before = np.concatenate([[0], kinds[:-1]])  # texts end with an end
            base = np.add.reduceat(alone[ids], starts)
            score = np.add.reduceat(alone[ids] + m.log_step[before, kinds] - m.log_room[kinds], starts)
            known = np.add.reduceat(seen[ids].astype(np.int64), starts)
            rows = np.arange(row, row + n)
            # a row's own key: no word holds a space, so it meets nothing in the join
            keys = [b" %d" % r for r in rows.tolist()]
            none = [None] * len(rare)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows.tolist() + [r for r, _ in rare], pa.int64()),
                    pa.array(keys + [w for _, w in rare], pa.binary()),
                    pa.array([0] * n + list(rare.values()), pa.int64()),
                    pa.concat_arrays([batch.column("doc_id"), pa.array(none, pa.int64())]),
                    pa.concat_arrays([batch.column("held_out"), pa.array(none, pa.bool_())]),
                    pa.array(sizes + none, pa.int64()),
                    pa.array(known.tolist() + none, pa.int64()),
                    pa.array(base.tolist() + none, pa.float64()),
                    pa.array(score.tolist() + none, pa.float64()),
                ],
                ["row", "word", "times", "doc_id", "held_out", "n_tokens", "known", "base", "score"],
            )
            row += n

    parts = df.select("doc_id", "body", "held_out").mapInArrow(kernel, "row long, word binary, times long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double")
    rare = counts.where((F.col("n") <= least) & (F.col("word") != F.lit(END))).select("word", "n")
    n = F.coalesce("n", F.lit(0))
    tail = F.sum((F.col("times") * F.log10(n + ALPHA)).cast("decimal(30,12)")).cast("double")
    summed = (
        parts.join(rare, "word", "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            (F.sum("known") + F.sum(F.when(n > 0, F.col("times")).otherwise(0))).alias("n_known"),
            (F.max("base") + tail).alias("base"),
            (F.max("score") + tail).alias("score"),
        )
    )
    room = math.log10(model.tokens + ALPHA * (model.types + 1))
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * room).alias("base_score"), "score")


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **model_options) -> DataFrame:
    """Train on the documents that are not held out (one in ten, by the id) and score all."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    docs = text_bytes(df, id_col, text_col).withColumn("held_out", held)
    train = docs.where(~F.col("held_out"))
    counts = stash(word_counts(train), "class-lm-counts")
    model, least = train_model(counts, train, **model_options)
    return score_texts(docs, counts, model, least)


def op3_class_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_documents(table(spark, sf_dir, "documents"))
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))

"""Edit distances of whole sequences, many pairs in a batch.

The longer text of a pair is gone through once for all that it is compared with: the
shorter ones lie side by side as fields of one Python integer, a spare bit between
them. A distance is the difference in length where the shorter text is found in the
longer one by leaving symbols out; no distance is less. Symbols match literally, as
Spark's and SQL's levenshtein have it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .alignment import match_masks

#: Bits of the fields that lie side by side, bytes of text whose distances are told at once, and texts that travel as one list.
FIELDS, PIECE, LIST = 1 << 16, 4 << 20, 128


def left_out(short: str, long: str) -> bool:
    """Whether short is long with symbols left out."""
    at, find = 0, long.find
    for symbol in short:
        at = find(symbol, at) + 1
        if not at:
            return False
    return True


def fields_distances(patterns: Sequence[str], text: str) -> list[int]:
    """Edits between each pattern and the text, none of them empty."""
    masks: dict[int, int] = {}
    full = low = at = 0
    places = []
    for p in patterns:
        for symbol, bits in match_masks(p, False).items():
            masks[symbol] = masks.get(symbol, 0) | bits << at
        full |= ((1 << len(p)) - 1) << at
        low |= 1 << at
        places.append(at)
        at += len(p) + 1
    get, up, down = masks.get, full, 0
    for symbol in text:
        x = get(symbol, 0) | down
        d = ((((x & up) + up) ^ up) | x) & full
        plus = ((down | (full ^ (d | up))) << 1 | low) & full
        up = ((up & d) << 1 & full) | (full ^ (d | plus))
        down = plus & d
    n, out = len(text), []
    for p, at in zip(patterns, places, strict=True):
        own = (1 << len(p)) - 1
        out.append(n + (up >> at & own).bit_count() - (down >> at & own).bit_count())
    return out


def distances(patterns: Sequence[str], text: str) -> list[int]:
    """Edits between the text and each pattern, none of them longer than it."""
    out, left = [0] * len(patterns), []
    for k, p in enumerate(patterns):
        if left_out(p, text):
            out[k] = len(text) - len(p)
        else:
            left.append(k)
    while left:
        own, bits = [], 0
        while left and (not own or bits + len(patterns[left[-1]]) < FIELDS):
            own.append(left.pop())
            bits += len(patterns[own[-1]]) + 1
        if bits < len(text):  # fewer steps the other way round
            told = [fields_distances([text], patterns[k])[0] for k in own]
        else:
            told = fields_distances([patterns[k] for k in own], text)
        for k, d in zip(own, told, strict=True):
            out[k] = d
    return out


def distance_many(a: Sequence[str | None], b: Sequence[str | None]) -> list[int | None]:
    """The edit distance of every pair; null where a side is."""
    out: list[int | None] = [None] * len(a)
    groups: dict[str, tuple[list[int], list[str]]] = {}
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        if x is None or y is None:
            continue
        if not x or not y or x == y:
            out[k] = 0 if x == y else len(x) + len(y)
            continue
        at, patterns = groups.setdefault(x if len(x) >= len(y) else y, ([], []))
        at.append(k)
        patterns.append(y if len(x) >= len(y) else x)
    for text, (at, patterns) in groups.items():
        for k, d in zip(at, distances(patterns, text), strict=True):
            out[k] = d
    return out


def pieces(batch: pa.RecordBatch, columns: Sequence[str], most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many bytes of those columns, a row at least."""
    rows = batch.num_rows
    size = sum(batch.column(c).nbytes for c in columns)
    step = max(1, rows * most // max(size, 1))
    for at in range(0, rows, step):
        yield batch.slice(at, step)


def _columns(df: DataFrame, but: Sequence[str] = ()) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name not in but]


def with_distances(pairs: DataFrame, a: str, b: str, name: str = "edit_distance") -> DataFrame:
    """pairs with the edit distance of two columns."""
    keep = _columns(pairs)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, (a, b)):
                told = pa.array(distance_many(part.column(a).to_pylist(), part.column(b).to_pylist()), pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, told], [*part.schema.names, name])

    return pairs.mapInArrow(kernel, ", ".join(f"`{n}` {t}" for n, t in [*keep, (name, "int")]))


def distances_to(left: DataFrame, right: DataFrame, on: list[str], a: str, b: str, name: str = "edit_distance") -> DataFrame:
    """The rows of left joined with those of right, without the texts a (of left) and b (of right), with their edit distance.

    Rows of right with the same keys travel as lists, so that a long text is neither made nor sent once for each of them."""
    first, second = _columns(left, (a,)), _columns(right, (*on, b))
    number = F.row_number().over(Window.partitionBy(*on).orderBy(b))
    numbered = right.withColumn("_list", F.floor((number - 1) / LIST))
    lists = numbered.groupBy(*on, "_list").agg(F.collect_list(F.struct(*[n for n, _ in second], F.col(b).alias("_b"))).alias("_right"))
    joined = left.join(lists, on).select(*[n for n, _ in first], F.col(a).alias("_a"), "_right")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, ("_a", "_right")):
                lists = part.column("_right")
                of = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                texts, rows = part.column("_a").to_pylist(), lists.flatten()
                told = pa.array(distance_many([texts[i] for i in of.tolist()], rows.field("_b").to_pylist()), pa.int32())
                of = pa.array(of)
                yield pa.RecordBatch.from_arrays([*(part.column(n).take(of) for n, _ in first), *(rows.field(n) for n, _ in second), told], [n for n, _ in [*first, *second, (name, "")]])

    return joined.mapInArrow(kernel, ", ".join(f"`{n}` {t}" for n, t in [*first, *second, (name, "int")]))

"""Coding sequences as Columns."""

from __future__ import annotations

import re
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .dna import let

#: Fixed value: the standard genetic code, codons in the order TCAG of each place.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {"".join(c): a for c, a in zip(product("TCAG", repeat=3), AMINO_ACIDS, strict=True)}


STOPS = re.compile("(?=TAA|TAG|TGA)")


def translate(seq: Column) -> Column:
    """Protein of frame 0; ambiguous codons are X, an incomplete last codon is dropped."""
    table = F.create_map(*[F.lit(x) for pair in CODONS.items() for x in pair])

    def of(symbols: Column) -> Column:
        count = F.floor(F.size(symbols) / 3).cast("int")
        codon = lambda i: F.concat(F.get(symbols, 3 * i), F.get(symbols, 3 * i + 1), F.get(symbols, 3 * i + 2))
        codons = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), codon)).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.transform(codons, lambda c: F.coalesce(F.try_element_at(table, c), F.lit("X"))), "")

    return let(F.split(seq, ""), of)


def first_internal_stop(protein: Column) -> Column:
    """0-based place of the first stop before the last residue, or null."""
    at = F.locate("*", F.substring(protein, 1, F.greatest(F.length(protein) - 1, F.lit(0))))
    return F.when(at > 0, at - 1)


def orf_of(text: str) -> tuple[int, int] | None:
    """`first_orf` of one text: the stops are gone through once, from the end, frame by frame."""
    stops = np.array([m.start() for m in STOPS.finditer(text)], np.int64)
    starts = np.array([m.start() for m in re.finditer("ATG", text)], np.int64)
    best = None
    for frame in range(3):
        own, ends = starts[starts % 3 == frame], stops[stops % 3 == frame]
        if len(own) and len(ends) and own[0] < ends[-1] and (best is None or own[0] < best[0]):
            best = int(own[0]), int(ends[np.searchsorted(ends, own[0])]) + 3
    return best


def first_orf(seq: Column) -> Column:
    """start, end (0-based, end exclusive) of the first ATG that an in-frame stop ends, or null."""

    @F.arrow_udf("start int, end int")
    def orfs(texts: pa.Array) -> pa.Array:
        found = [orf_of(t.as_py() or "") for t in texts]
        return pa.array([None if f is None else {"start": f[0], "end": f[1]} for f in found], pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    return orfs(seq)

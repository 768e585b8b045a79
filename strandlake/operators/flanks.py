"""Constant regions around the inserts of a library: stated, read from a template, or shared by all references.

A library is small (at most LIBRARY_LIMIT references); this runs on the driver."""

from __future__ import annotations

from dataclasses import dataclass
from os.path import commonprefix

from pyspark.sql import Column
from pyspark.sql import functions as F

from .alignment import infix_locations, reverse_complement

ANCHOR = 20
LIBRARY_LIMIT = 100_000


@dataclass(frozen=True)
class Flanks:
    """upstream and downstream constant sequence, outer anchor_length bases of each being the primer anchors."""

    upstream: str
    downstream: str
    anchor_length: int = ANCHOR
    in_references: bool = False

    def __post_init__(self) -> None:
        if min(len(self.upstream), len(self.downstream)) < self.anchor_length:
            raise ValueError("a constant region is shorter than its anchor")

    @property
    def anchors(self) -> tuple[str, str]:
        return self.upstream[: self.anchor_length], self.downstream[len(self.downstream) - self.anchor_length :]

    @property
    def inner(self) -> tuple[str, str]:
        return self.upstream[self.anchor_length :], self.downstream[: len(self.downstream) - self.anchor_length]

    def transform(self, sequence: str) -> str:
        """What a read spans: the insert between the inner constant regions."""
        if self.in_references:
            if len(sequence) <= 2 * self.anchor_length:
                raise ValueError("a reference is shorter than its anchors")
            return sequence[self.anchor_length : len(sequence) - self.anchor_length]
        left, right = self.inner
        for a, b in ((left, right), (self.upstream, self.downstream)):
            if a and b and sequence.startswith(a) and sequence.endswith(b):
                raise ValueError("the sequence already has its constant regions")
        return left + sequence + right

    @property
    def insert_anchors(self) -> tuple[str, str]:
        """The inner ends of the constant regions, which bound the insert."""
        left, right = self.inner
        if not left or not right:
            raise ValueError("no constant region is left inside the anchors")
        return left[-self.anchor_length :], right[: self.anchor_length]

    def column(self, seq: Column) -> Column:
        """transform for a column of sequences."""
        n = F.length(seq)
        if self.in_references:
            cut = F.substring(seq, F.lit(self.anchor_length + 1), n - 2 * self.anchor_length)
            return F.when(n > 2 * self.anchor_length, cut).otherwise(F.raise_error(F.lit("a reference is shorter than its anchors")))
        left, right = self.inner
        twice = F.lit(False)
        for a, b in ((left, right), (self.upstream, self.downstream)):
            if a and b:
                twice = twice | (seq.startswith(a) & seq.endswith(b))
        return F.when(twice, F.raise_error(F.lit("a sequence already has its constant regions"))).otherwise(F.concat(F.lit(left), seq, F.lit(right)))

    def insert_span(self, length: int) -> tuple[int, int]:
        left, right = self.inner
        return len(left), length - len(right)


def from_template(template: str, inserts: list[str], anchor_length: int = ANCHOR, min_identity: float = 0.90) -> tuple[Flanks, str]:
    """Flanks around the insert that fits an example construct best, on either strand; and that insert."""
    if len(inserts) > LIBRARY_LIMIT:
        raise ValueError(f"a template is compared with at most {LIBRARY_LIMIT} inserts")
    tried = []
    for text in (template, reverse_complement(template)):
        for insert in inserts:
            if insert and len(insert) <= len(text):
                d, spans = infix_locations(insert, text, iupac=False)
                if spans:
                    tried.append((1 - d / len(insert), -spans[0][0], len(insert), insert, text, spans[0]))
    best = max(tried, key=lambda t: t[:4], default=None)
    if best is None or best[0] < min_identity:
        raise ValueError("no insert fits the template")
    text, (start, end) = best[4], best[5]
    if not start or end + 1 >= len(text):
        raise ValueError("the insert reaches an end of the template")
    return Flanks(text[:start], text[end + 1 :], anchor_length), best[3]


def from_references(references: list[str], anchor_length: int = ANCHOR, min_constant: int = 60) -> Flanks:
    """The prefix and suffix that all assembled references share."""
    known = [r for r in references if r]
    if len(known) < 2:
        raise ValueError("shared regions need two references")
    prefix = commonprefix(known)
    shortest = min(map(len, known))
    suffix = commonprefix([r[::-1] for r in known])[: shortest - len(prefix)][::-1]
    if len(prefix) + len(suffix) >= shortest:
        raise ValueError("the references do not vary")
    if min(len(prefix), len(suffix)) < min_constant:
        raise ValueError("the references share too little")
    return Flanks(prefix, suffix, anchor_length, in_references=True)

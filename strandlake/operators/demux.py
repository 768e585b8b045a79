"""Barcode calling and demultiplexing.

A panel is small (its size is checked) and travels to the Python workers; reads
that fail the length or quality gate never reach them. The calls of plate and well
are two passes of the same operator, with the reads oriented between them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dna import is_sequence, reverse_complement as revcomp_column
from .alignment import LANE_BITS, PLAIN, Lanes, global_distance, infix_distance, infix_start, reverse_complement
from .distances import pieces

POLICIES = ("best_margin", "legacy_unique_threshold", "legacy_unique_best")
PANEL_LIMIT = 20_000
CALL = pa.struct([("status", pa.string()), ("id", pa.string()), ("orientation", pa.string()), ("best_edits", pa.int32()), ("second_edits", pa.int32()), ("margin", pa.int32()), ("matched_end", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("reason", pa.string())])
CALL_TYPE = "struct<status:string,id:string,orientation:string,best_edits:int,second_edits:int,margin:int,matched_end:string,start:int,end:int,reason:string>"


@dataclass(frozen=True)
class CallSettings:
    window: int = 400
    max_edits: int = 4
    min_margin: int = 1
    ends: tuple[str, ...] = ("head", "tail")
    both_strands: bool = True
    policy: str = "best_margin"

    def __post_init__(self) -> None:
        if self.window < 1 or self.max_edits < 0 or self.min_margin < 0:
            raise ValueError("window is 1 or more, edits and margin are not negative")
        if self.policy not in POLICIES:
            raise ValueError(f"policy is one of {', '.join(POLICIES)}")
        if not self.ends or set(self.ends) - {"head", "tail"}:
            raise ValueError("ends holds head, tail or both")


#: More edits than any barcode has; forms from which on pieces are looked up first; reads looked up at once.
FAR, FILTERED, READS = 1 << 30, 16, 64


@dataclass(frozen=True, order=True)
class Hit:
    distance: int
    barcode_id: str
    orientation: str
    read_end: str
    start: int
    end: int

    @property
    def owner(self) -> tuple[str, str]:
        return self.barcode_id, self.orientation


@dataclass
class Call:
    status: str
    id: str | None = None
    orientation: str = "unknown"
    best_edits: int | None = None
    second_edits: int | None = None
    margin: int | None = None
    matched_end: str | None = None
    start: int | None = None
    end: int | None = None
    reason: str = ""


_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGT", np.uint8)] = [0, 1, 2, 3]


class PieceFilter:
    """Where barcodes may lie with so many edits: of edits + 1 pieces of a barcode one is unchanged, of edits + 2 two, on
    diagonals that differ by the edits at most. Only the surroundings of such pieces go to the lanes.

    Pieces are looked up by their first bases; one is asked for where it is long enough to be rare."""

    RARE = 6

    def __init__(self, patterns: list[str], edits: int):
        self.edits, self.forms = edits, len(patterns)
        self.size = np.array([len(p) for p in patterns])
        least = int(self.size.min()) if patterns else 0
        self.need = 1 if least // (edits + 1) >= self.RARE else 2
        self.width, self.step = min(least // (edits + self.need), 8), 2 * (edits + 1)
        self.usable = self.width >= 4 and all(set(p) <= set("ACGT") and len(p) <= LANE_BITS for p in patterns)
        if not self.usable:
            return
        rows = []
        for k, p in enumerate(patterns):
            for i in range(edits + self.need):
                at = i * len(p) // (edits + self.need)
                code = 0
                for c in _CODE[np.frombuffer(p[at : at + self.width].encode(), np.uint8)].tolist():
                    code = code * 4 + c
                rows.append((code, k, at))
        table = np.array(sorted(rows), np.int64)
        self.form, self.offset = table[:, 1], table[:, 2]
        self.begin = np.searchsorted(table[:, 0], np.arange(4**self.width + 1))
        self.lanes = Lanes(patterns)

    def best(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `Lanes.best` for pairs within the edits; other pairs have FAR edits and no end. Texts hold A, C, G and T only."""
        best, end = np.full((len(texts), self.forms), FAR, np.int64), np.full((len(texts), self.forms), -1, np.int64)
        length = np.array([len(t) for t in texts], np.int64)
        if not len(texts) or length.max() < self.width:
            return best, end
        codes = np.full((len(texts), int(length.max())), 4, np.uint8)
        for i, t in enumerate(texts):
            codes[i, : len(t)] = _CODE[np.frombuffer(t.encode(), np.uint8)]
        places = codes.shape[1] - self.width + 1
        gram = np.zeros((len(texts), places), np.int64)
        for i in range(self.width):
            gram = gram * 4 + (codes[:, i : i + places] & 3)
        gram[np.arange(places) + self.width > length[:, None]] = 4**self.width  # beyond the text
        first = np.append(self.begin, self.begin[-1])
        read, at = np.nonzero(first[gram + 1] > first[gram])
        start = first[gram[read, at]]
        count = first[gram[read, at] + 1] - start
        entry = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
        read, at, form = np.repeat(read, count), np.repeat(at, count), self.form[entry]
        diagonal = at - self.offset[entry] + int(self.size.max())
        most = 2 * ((codes.shape[1] + 2 * int(self.size.max())) // self.step + 2)
        pair = (read * self.forms + form) * most
        spots = [pair + 2 * (diagonal // self.step)]
        if self.need > 1:  # overlapping ranges of diagonals: any two that are near share one
            spots.append(pair + 2 * ((diagonal + self.step // 2) // self.step) + 1)
        key, hits = np.unique(np.concatenate(spots), return_counts=True)
        pair, spot = np.divmod(key[hits >= self.need], most)
        read, form = np.divmod(pair, self.forms)
        low = (spot // 2) * self.step - (spot % 2) * (self.step // 2) - int(self.size.max()) - self.edits
        high = np.minimum(low + 2 * self.edits + self.step + self.size[form], length[read])
        low = np.maximum(low, 0)
        told, ends = self._lanes(codes, read, form, low, high)
        near = told <= self.edits
        order = np.lexsort((ends[near], told[near], pair[near]))
        pair, told, ends = pair[near][order], told[near][order], ends[near][order]
        lead = np.concatenate([[True], pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, bool)
        best.reshape(-1)[pair[lead]], end.reshape(-1)[pair[lead]] = told[lead], ends[lead]
        return best, end

    def _lanes(self, codes: np.ndarray, read: np.ndarray, form: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits and first end of each form in its part of a text."""
        one = np.uint64(1)
        peq = self.lanes.peq[[*b"ACGT", 0]].reshape(-1)
        last, full = self.lanes.last[form], self.lanes.full[form]
        up, down, score = full.copy(), np.zeros(len(form), np.uint64), self.size[form].astype(np.int64)
        best, end = score.copy(), np.full(len(form), -1, np.int64)
        text = np.concatenate([codes, np.full((len(codes), 1), 4, np.uint8)], axis=1)
        for j in range(int((high - low).max(initial=0))):
            at = low + j
            live = at < high
            symbol = text[read, np.where(live, at, codes.shape[1])].astype(np.int64)
            x = peq.take(symbol * self.forms + form) | down
            d = (((x & up) + up) ^ up) | x
            plus, minus = down | ~(d | up), up & d
            score += ((plus & last) != 0).astype(np.int64) - ((minus & last) != 0)
            plus, minus = plus << one, minus << one
            up, down = (minus | ~(d | plus)) & full, plus & d & full
            better = live & (score < best)
            best[better], end[better] = score[better], at[better]
        return best, end


@dataclass
class Caller:
    """Calls one panel on many reads."""

    panel: list[tuple[str, str]]
    settings: CallSettings
    forms: list[tuple[str, str, str]] = field(default_factory=list)  # barcode, strand, pattern

    def __post_init__(self) -> None:
        for name, seq in self.panel:
            self.forms += [(name, "barcode", seq), (name, "reverse", reverse_complement(seq))]
        patterns = [p for _, _, p in self.forms]
        self.lanes = Lanes(patterns) if patterns and max(map(len, patterns)) <= LANE_BITS else None
        self.pieces = PieceFilter(patterns, self.settings.max_edits)

    def _distances(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Least edits and first end of every (text, form); -1 where there is none."""
        if self.lanes is not None:
            return self.lanes.best(texts)
        found = [[infix_distance(p, t) for _, _, p in self.forms] for t in texts]
        shape = (len(texts), len(self.forms))
        return np.array([[d for d, _ in f] for f in found], np.int32).reshape(shape), np.array([[e[0] if e else -1 for _, e in f] for f in found], np.int32).reshape(shape)

    @property
    def filtered(self) -> bool:
        return len(self.forms) >= FILTERED and self.pieces.usable

    def _near(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `_distances`, where pairs beyond the edits may be left out."""
        if not self.filtered:
            return self._distances(texts)
        plain = np.array([PLAIN.issuperset(t) for t in texts], bool)
        best, ends = np.empty((len(texts), len(self.forms)), np.int64), np.empty((len(texts), len(self.forms)), np.int64)
        for own, find in ((plain, self.pieces.best), (~plain, self._distances)):
            at = np.flatnonzero(own)
            for i in range(0, len(at), READS):
                part = at[i : i + READS]
                best[part], ends[part] = find([texts[k] for k in part])
        return best, ends

    def calls(self, reads: list[str]) -> list[Call]:
        s = self.settings
        hits: list[list[Hit]] = [[] for _ in reads]
        least = np.full(len(reads), FAR, np.int64)
        cut = [min(s.window, len(r)) for r in reads]
        ended = {e: [r[:c] if e == "head" else r[len(r) - c :] for r, c in zip(reads, cut, strict=True)] for e in s.ends}
        # a barcode at the head, or its reverse complement at the tail, reads forward
        ahead = {e: np.array([(strand == "barcode") == (e == "head") for _, strand, _ in self.forms], bool) for e in s.ends}
        for read_end in s.ends:
            texts, forward = ended[read_end], ahead[read_end]
            best, ends = self._near(texts)
            allowed = (ends >= 0) & (forward | s.both_strands)
            if s.policy == "best_margin" and len(self.forms):
                least = np.minimum(least, np.where(allowed, best, FAR).min(axis=1))
            for i, k in zip(*(x.tolist() for x in np.nonzero(allowed & (best <= s.max_edits))), strict=True):
                name, _, pattern = self.forms[k]
                d, end = int(best[i, k]), int(ends[i, k])
                offset = 0 if read_end == "head" else len(reads[i]) - len(texts[i])
                hits[i].append(Hit(d, name, "forward" if forward[k] else "reverse", read_end, infix_start(pattern, texts[i], end, d) + offset, end + offset))
        lost = [i for i, h in enumerate(hits) if not h] if s.policy == "best_margin" and self.filtered else []
        for read_end in s.ends if lost else ():  # reads without a barcode: how far the nearest is
            best, ends = self._distances([ended[read_end][i] for i in lost])
            allowed = (ends >= 0) & (ahead[read_end] | s.both_strands)
            least[lost] = np.minimum(least[lost], np.where(allowed, best, FAR).min(axis=1))
        return [decide(sorted(h), s, int(d) if d < FAR else None) for h, d in zip(hits, least, strict=True)]


def decide(able: list[Hit], s: CallSettings, least: int | None = None) -> Call:
    """The call that a read's hits within the edits allow; one hit for each barcode, end and orientation, best first. least:
    the fewest edits of any barcode."""
    if not able:
        return Call("unassigned", best_edits=least, reason="no barcode within the edits allowed")
    if s.policy != "best_margin":
        return _legacy(able, s)
    sure = []
    for read_end in ("head", "tail"):
        own = [h for h in able if h.read_end == read_end]
        rival = next((h for h in own if h.owner != own[0].owner), None)
        if own and (rival is None or rival.distance - own[0].distance >= s.min_margin):
            sure.append(own[0])
    if len(sure) == 2 and sure[0].owner != sure[1].owner:
        d = sorted(h.distance for h in sure)
        return Call("conflicting", best_edits=d[0], second_edits=d[1], margin=d[1] - d[0], reason="the read's ends support different barcodes or orientations")
    best = able[0]
    rival = next((h for h in able if h.owner != best.owner), None)
    second = rival.distance if rival else None
    margin = second - best.distance if rival else None
    where = {"best_edits": best.distance, "second_edits": second, "margin": margin, "matched_end": best.read_end, "start": best.start, "end": best.end}
    if rival and margin < s.min_margin:
        return Call("ambiguous", **where, reason="the margin to the next barcode is too small")
    return Call("assigned", best.barcode_id, best.orientation, **where, reason="within the edits and the margin")


def _legacy(able: list[Hit], s: CallSettings) -> Call:
    best = able[0]
    rival = next((h for h in able if h.barcode_id != best.barcode_id), None)
    second = rival.distance if rival else None
    margin = second - best.distance if rival else None
    pool = able if s.policy == "legacy_unique_threshold" else [h for h in able if h.distance == best.distance]
    if len({h.barcode_id for h in pool}) > 1:
        return Call("ambiguous", best_edits=best.distance, second_edits=second, margin=margin, matched_end=best.read_end, start=best.start, end=best.end, reason="several barcodes pass the legacy rule")
    own = min((h for h in able if h.barcode_id == pool[0].barcode_id), key=lambda h: (h.distance, h.read_end != "tail", h.start, h.orientation))
    orientation = "forward" if own.read_end == "tail" or not s.both_strands else "reverse"
    return Call("assigned", own.barcode_id, orientation, own.distance, second, margin, own.read_end, own.start, own.end, "one barcode passes the legacy rule")


def panel_rows(panel: DataFrame) -> list[tuple[str, str]]:
    """The panel on the driver; its size is bounded."""
    rows = [(r[0], r[1]) for r in panel.select("barcode_id", "sequence").orderBy("barcode_id").limit(PANEL_LIMIT + 1).collect()]
    if len(rows) > PANEL_LIMIT:
        raise ValueError(f"a panel holds at most {PANEL_LIMIT} barcodes")
    return rows


def call_barcodes(reads: DataFrame, panel: list[tuple[str, str]], settings: CallSettings, name: str, seq: str = "sequence", when: Column | None = None, batch_rows: int = 128) -> DataFrame:
    """reads with the call as a struct column name; rows for which when does not hold are not_attempted."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in reads.schema.fields)}, `{name}` {CALL_TYPE}"
    names = [f.name for f in reads.schema.fields]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caller = Caller(panel, settings)
        for batch in (part for whole in batches for part in pieces(whole, (seq,))):
            wanted = np.flatnonzero(batch.column("_when").to_numpy(zero_copy_only=False))
            calls = [Call("not_attempted")] * batch.num_rows
            for at in range(0, len(wanted), batch_rows):
                rows = wanted[at : at + batch_rows]
                for i, c in zip(rows.tolist(), caller.calls([t or "" for t in batch.column(seq).take(pa.array(rows)).to_pylist()]), strict=True):
                    calls[i] = c
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array([asdict(c) for c in calls], CALL)], [*names, name])

    chosen = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    return reads.withColumn("_when", chosen).mapInArrow(kernel, schema)


def quality_means(reads: DataFrame, quality: str = "quality", name: str = "mean_q") -> DataFrame:
    """reads with the mean of their Phred+33 scores (0 without any), one vector operation a read."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in reads.schema.fields)}, `{name}` double"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(quality)
            raw = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary())
            means = [float(np.frombuffer(x, np.uint8).mean()) - 33 if x else 0.0 for x in raw.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(means, pa.float64())], [*batch.schema.names, name])

    return reads.mapInArrow(kernel, schema)


@dataclass(frozen=True)
class Gates:
    min_length: int = 0
    max_length: int | None = None
    min_quality: float | None = None


def gate(length: Column, quality: Column, gates: Gates) -> Column:
    """pass, or the first reason against a read."""
    long = F.lit(False) if gates.max_length is None else length > gates.max_length
    low = F.lit(False) if gates.min_quality is None else quality < gates.min_quality
    return F.when(length == 0, "empty_read").when((length < gates.min_length) | long, "out_of_length").when(low, "low_quality").otherwise("pass")


def demultiplex(reads: DataFrame, plates: list[tuple[str, str]] | None, wells: list[tuple[str, str]] | None, plate_settings: CallSettings, well_settings: CallSettings, gates: Gates) -> DataFrame:
    """reads with gate, plate, well, call_status and the oriented sequence and quality.

    Status, first that holds: the gate's reason, invalid_sequence, plate_<status>, well_<status>,
    orientation_conflict, assigned. Gated reads are not_attempted; a panel that is not given is skipped."""
    gated = quality_means(reads).withColumn("gate", gate(F.length("sequence"), F.col("mean_q"), gates))
    gated = gated.withColumn("gate", F.when((F.col("gate") == "pass") & ~is_sequence(F.col("sequence")), "invalid_sequence").otherwise(F.col("gate")))
    skipped = F.from_json(F.lit('{"status": "not_attempted", "orientation": "unknown"}'), CALL_TYPE)
    flip = lambda df, when: df.withColumns({"sequence": F.when(when, revcomp_column(F.col("sequence"))).otherwise(F.col("sequence")), "quality": F.when(when, F.reverse("quality")).otherwise(F.col("quality"))})
    backwards = lambda call: (F.col(f"{call}.status") == "assigned") & (F.col(f"{call}.orientation") == "reverse")
    passed = F.col("gate") == "pass"
    every = call_barcodes(gated, plates, plate_settings, "plate", when=passed) if plates is not None else gated.withColumn("plate", skipped)
    every = flip(every, backwards("plate"))
    if wells is not None:
        every = call_barcodes(every, wells, well_settings, "well", when=passed & F.col("plate.status").isin("assigned", "not_attempted"))
        if plates is None:
            every = flip(every, backwards("well"))
    else:
        every = every.withColumn("well", skipped)
    plate_bad = F.lit(plates is not None) & (F.col("plate.status") != "assigned")
    well_bad = F.lit(wells is not None) & (F.col("well.status") != "assigned")
    conflict = F.lit(plates is not None and wells is not None) & (F.col("well.orientation") == "reverse")
    status = (
        F.when(F.col("gate") != "pass", F.col("gate"))
        .when(plate_bad, F.concat(F.lit("plate_"), F.col("plate.status")))
        .when(well_bad, F.concat(F.lit("well_"), F.col("well.status")))
        .when(conflict, "orientation_conflict")
        .otherwise("assigned")
    )
    return every.withColumn("call_status", status)


def demux_index(calls: DataFrame) -> DataFrame:
    """Reads of each exported scope: by plate, by plate and well, and plates with no well."""
    kept = calls.where(F.col("plate.id").isNotNull())
    plate, well = F.col("plate.id").alias("plate_id"), F.col("well.id").alias("well_id")
    scopes = F.array(
        F.struct(F.lit("by_plate").alias("scope"), F.lit(None).cast("string").alias("w")),
        F.struct(F.when(well.isNull(), "unresolved_well").otherwise("by_well").alias("scope"), F.col("well.id").alias("w")),
    )
    rows = kept.select(plate, F.explode(scopes).alias("s")).select("plate_id", "s.scope", F.col("s.w").alias("well_id"))
    return rows.groupBy("scope", "plate_id", "well_id").agg(F.count(F.lit(1)).alias("reads"))


def unsafe_pairs(panel: DataFrame, max_edits: int, min_margin: int, both_strands: bool = True) -> DataFrame:
    """Pairs of barcodes (and of their reverse complements) closer than 2 max_edits + min_margin, by symbols that share a base."""
    forms = panel.select("barcode_id", "sequence", F.lit("barcode").alias("strand"))
    if both_strands:
        forms = forms.union(panel.select("barcode_id", revcomp_column(F.col("sequence")).alias("sequence"), F.lit("reverse").alias("strand")))
    left = forms.where("strand = 'barcode'").select(F.col("barcode_id").alias("a"), F.col("sequence").alias("sa"))
    right = forms.select(F.col("barcode_id").alias("b"), F.col("sequence").alias("sb"), "strand")
    pairs = left.join(F.broadcast(right) if panel.count() <= PANEL_LIMIT else right, F.col("a") < F.col("b"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [global_distance(x, y, True) for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "strand")), pa.array(near, pa.int32())], ["a", "b", "strand", "distance"])

    told = pairs.mapInArrow(kernel, "a string, b string, strand string, distance int")
    return told.where(F.col("distance") < 2 * max_edits + min_margin)


def best_and_margin(scored: DataFrame, keys: list[str], owner: str, distance: str) -> DataFrame:
    """For each key the best owner, the best and second-best distances and their margin."""
    order = Window.partitionBy(*keys).orderBy(distance, owner)
    ranked = scored.withColumn("rank", F.row_number().over(order)).withColumn("second", F.lead(distance).over(order))
    return ranked.where("rank = 1").select(*keys, F.col(owner).alias("best_id"), F.col(distance).alias("best_edits"), F.col("second").alias("second_edits"), (F.col("second") - F.col(distance)).alias("margin"))

"""Token counts of whole texts by overlap resynchronisation.

A text of up to CHUNK characters is encoded at once. A longer one is encoded in
chunks that overlap; two neighbours are spliced at an offset where both have a
token boundary and where no piece of the vocabulary holds the two characters
that meet there. Merges only ever build vocabulary pieces, so none can cross
such an offset: what follows it is encoded alike whatever precedes it. If an
overlap has no such offset it is widened, up to the end of the text.

Nulls: a null text counts as empty (0 bytes, 0 tokens); a null id is returned as
it is. Repeated rows give one row each. Other columns are dropped. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, table, text_bytes

MODEL = "piece_bpe_32k.model"
CHUNK = 1 << 15
OVERLAP = 256
LIMIT = 4096
#: Kinds of pieces that merges build: normal, stated by the user, and unused ones, which are split up again afterwards.
MERGED = (1, 4, 5)


class PieceCounter:
    """Counts the tokens of a text as the library gives them for the whole text."""

    def __init__(self, model_file: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.chunk, self.overlap, self.widened = chunk, overlap, 0
        spec = pb.ModelProto()
        spec.ParseFromString(self.processor.serialized_model_proto())
        self.pairs = {p.piece[i : i + 2] for p in spec.pieces if p.type in MERGED for i in range(len(p.piece) - 1)}
        norm = spec.normalizer_spec
        #: Only where the normaliser keeps each character do offsets of the text prove anything.
        self.literal = not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.escape_whitespaces

    def _fixed(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1].replace(" ", "▁") not in self.pairs

    def _starts(self, text: str) -> list[int]:
        return [p.begin for p in self.processor.encode(text, return_type="proto").pieces]

    def count(self, text: str) -> int:
        if len(text) <= self.chunk or not self.literal:
            return len(self.processor.encode(text))
        total, begin, cut = 0, 0, 0  # the chunk begins at begin, its tokens count from cut on
        overlap = self.overlap
        end = min(len(text), begin + self.chunk + overlap)
        starts = self._starts(text[begin:end])
        while True:
            low = len(text[begin:cut].encode())
            if end >= len(text):
                return total + sum(s >= low for s in starts)
            nxt = max(end - overlap, begin + 1)
            nxt_end = min(len(text), nxt + self.chunk + overlap)
            nxt_starts = self._starts(text[nxt:nxt_end])
            at = self._common(text, begin, nxt, end, starts, nxt_starts, cut)
            if at is None:
                self.widened += 1
                overlap *= 2
                end = min(len(text), end + overlap)
                starts = self._starts(text[begin:end])
                continue
            high = len(text[begin:at].encode())
            total += sum(low <= s < high for s in starts)
            begin, end, starts, cut, overlap = nxt, nxt_end, nxt_starts, at, self.overlap

    def _common(self, text: str, begin: int, nxt: int, end: int, starts: list[int], nxt_starts: list[int], cut: int) -> int | None:
        here, there = set(starts), set(nxt_starts)
        a, b = len(text[begin:nxt].encode()), 0
        for at in range(nxt + 1, end):
            n = len(text[at - 1].encode())
            a, b = a + n, b + n
            if at > cut and a in here and b in there and self._fixed(text, at):
                return at
        return None


@lru_cache(maxsize=4)
def counter(model_file: str, chunk: int, overlap: int) -> PieceCounter:
    return PieceCounter(model_file, chunk, overlap)


def count_tokens(df: DataFrame, model_file: str | None = None, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row. model_file: a path on each machine, by default the public one by its name."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = model_file
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(MODEL)
        tool = counter(path, chunk, overlap)
        for batch in blocks(batches):
            bodies = [x or b"" for x in batch.column("body").to_pylist()]
            texts = [x.decode("utf-8", "replace") for x in bodies]
            short = [i for i, x in enumerate(texts) if len(x) <= chunk]
            counts = [0] * len(texts)
            for i, ids in zip(short, tool.processor.encode([texts[i] for i in short], num_threads=1), strict=True):
                counts[i] = len(ids)
            for i, x in enumerate(texts):
                if len(x) > chunk:
                    counts[i] = tool.count(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in bodies], pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return text_bytes(df, id_col, text_col).mapInArrow(kernel, "doc_id long, n_bytes long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)

"""FASTQ as tables, and writers of FASTQ.

    fastq_files(spark, path)                     # any store that Spark opens
    spark.dataSource.register(FastqDataSource)   # local files
    spark.read.format("fastq").option("path", folder_or_file).load()

``fastq_files`` reads lines through Spark: plain files are split by bytes, compressed
ones are one stream each, and neither is ever held whole. A first pass counts the lines
of each split, so every line knows its number in its file; records that lie across two
splits are put together by a shuffle of their lines alone. The data source streams a
local file in one task. Records are strict: four lines, equal lengths, printable
qualities; the first bad record fails the read with its file and number. Compression
is told by the first bytes: a plain file named .gz is refused, a compressed file of
another name is read as one stream of a task.
"""

from __future__ import annotations

import glob
import gzip
import hashlib
import io
import os
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import StrandlakeError

SCHEMA = "read_uid string, name string, description string, sequence string, quality string, record_index bigint, source_sha256 string, sample_id string"
SYMBOLS = frozenset("ACGTRYSWKMBDHVN.-")
GZIP_MAGIC = b"\x1f\x8b"


class FastqError(StrandlakeError, ValueError):
    """A record that breaks the format, with its file and number."""

    def __init__(self, path: str, record: int, problem: str):
        super().__init__(f"{path}, record {record}: {problem}")


def opened(raw: io.BufferedIOBase, path: str) -> io.TextIOBase:
    """Text of a plain or gzip stream; a .gz name on a plain file is refused."""
    if raw.peek(2)[:2] == GZIP_MAGIC:
        return io.TextIOWrapper(gzip.GzipFile(fileobj=raw), "ascii", newline=None)
    if path.endswith(".gz"):
        raise FastqError(path, 0, "named .gz but not compressed")
    return io.TextIOWrapper(raw, "ascii", newline=None)


def problem_of(lines: list[str], validate: bool, allow_empty: bool) -> str | None:
    """What is wrong with the four lines of a record."""
    head, seq, plus, quality = lines
    if not head.startswith("@"):
        return "the header does not start with @"
    if not all(x.isascii() for x in lines):
        return "other symbols than ASCII"
    name = head[1:].split(maxsplit=1)
    if not name:
        return "the read has no name"
    if not seq and not allow_empty:
        return "the sequence is empty"
    if any(c.isspace() for c in seq):
        return "white space in the sequence"
    if validate and not SYMBOLS.issuperset(seq):
        return "unknown symbols " + "".join(sorted(set(seq) - SYMBOLS))
    if not plus.startswith("+"):
        return "the third line does not start with +"
    if plus[1:] and plus[1:].split(maxsplit=1)[:1] != name[:1]:
        return "the name after + is another one"
    if len(quality) != len(seq):
        return "sequence and quality differ in length"
    if not all(33 <= ord(c) <= 126 for c in quality):
        return "qualities outside Phred+33"
    return None


def row_of(lines: list[str], path: str, digest: str, record: int, sample_id: str, validate: bool, allow_empty: bool) -> tuple:
    """A row of SCHEMA from the four lines of a record."""
    head, seq, plus, quality = lines
    seq = seq.upper()
    if problem := problem_of([head, seq, plus, quality], validate, allow_empty):
        raise FastqError(path, record, problem)
    uid = hashlib.sha256(f"{digest}\0{record}".encode()).hexdigest()
    return uid, head[1:].split(maxsplit=1)[0], head[1:], seq, quality, record, digest, sample_id


def stream(raw: io.BufferedIOBase, path: str, digest: str, sample_id: str = "", validate: bool = True, allow_empty: bool = False) -> Iterator[tuple]:
    """Rows of SCHEMA; one record is held at a time."""
    record = 0
    try:
        with opened(raw, path) as text:
            while head := text.readline():
                rest = [text.readline() for _ in range(3)]
                if not all(rest):
                    raise FastqError(path, record, "the record is cut off")
                yield row_of([x.rstrip("\n") for x in (head, *rest)], path, digest, record, sample_id, validate, allow_empty)
                record += 1
    except (gzip.BadGzipFile, EOFError, UnicodeDecodeError) as error:
        raise FastqError(path, record, str(error)) from error


def parse(data: bytes, path: str, sample_id: str = "", validate: bool = True, allow_empty: bool = False) -> Iterator[tuple]:
    """Rows of SCHEMA of a whole file."""
    yield from stream(io.BufferedReader(io.BytesIO(data)), path, hashlib.sha256(data).hexdigest(), sample_id, validate, allow_empty)


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        path = self.options["path"].removeprefix("file://")
        names = sorted(glob.glob(f"{path}/*") if os.path.isdir(path) else glob.glob(path))
        if not names:
            raise FileNotFoundError(path)
        return [_File(n) for n in names if os.path.isfile(n)]

    def read(self, partition: _File) -> Iterator[tuple]:
        flag = lambda name, default: str(self.options.get(name, default)).lower() == "true"
        with open(partition.path, "rb") as file:
            digest = hashlib.file_digest(file, "sha256").hexdigest()
        with open(partition.path, "rb") as file:
            yield from stream(file, partition.path, digest, self.options.get("sample_id", ""), flag("validate", True), flag("allow_empty", False))


class FastqDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def listed(spark: SparkSession, path: str) -> list[str]:
    """The files a path or pattern names, one folder deep."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    out = []
    for found in store.globStatus(where) or ():
        every = store.listStatus(found.getPath()) if found.isDirectory() else [found]
        out += [f.getPath().toString() for f in every if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    if not out:
        raise FileNotFoundError(path)
    return sorted(out)


#: A file of up to so many bytes is digested as one value of Spark's own reader, a larger one as a stream of a task.
WHOLE_BYTES = 128 << 20
#: Stores that a task opens by itself for that.
STREAMED = frozenset(["file", "hdfs", "s3", "s3a", "gs"])


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        for name in batch.column("file").to_pylist():
            local = name.startswith("file:")
            store, path = (fs.LocalFileSystem(), name.replace("file:///", "/").removeprefix("file:")) if local else fs.FileSystem.from_uri(name.replace("s3a://", "s3://", 1))
            digest, first = hashlib.sha256(), b""
            with store.open_input_stream(path, compression=None) as data:
                while piece := data.read(1 << 20):
                    first = first or piece[:2]
                    digest.update(piece)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([digest.hexdigest()]), pa.array([first], pa.binary())], ["file", "digest", "first"])


def file_digests(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, bytes]]:
    """SHA-256 and first two bytes of each file, told by the executors: the driver sees a row for each file. Only a file of more
    than WHOLE_BYTES in a store that tasks cannot open is streamed through the driver."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    sizes = {n: hadoop(n).getFileSystem(conf).getFileStatus(hadoop(n)).getLen() for n in files}
    large = {n for n in files if sizes[n] > WHOLE_BYTES}
    by_tasks = sorted(n for n in large if n.split(":", 1)[0] in STREAMED)
    out = {n: (hashlib.sha256().hexdigest(), b"") for n in files if not sizes[n]}
    if small := [n for n in files if sizes[n] and n not in large]:
        rows = spark.read.format("binaryFile").load(small).select("path", F.sha2("content", 256).alias("digest"), F.substring("content", 1, 2).alias("first")).collect()
        told = {_plain(r.path): (r.digest, bytes(r.first)) for r in rows}
        out |= {n: told[_plain(n)] for n in small}
    if by_tasks:
        names = spark.createDataFrame([(n,) for n in by_tasks], "file string").repartition(len(by_tasks))
        out |= {r.file: (r.digest, bytes(r.first)) for r in names.mapInArrow(_stream_digests, "file string, digest string, first binary").collect()}
    for name in sorted(large.difference(by_tasks)):
        store = hadoop(name).getFileSystem(conf)
        begin, data = store.open(hadoop(name)), store.open(hadoop(name))
        try:
            out[name] = spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(data), bytes(b for b in (begin.read(), begin.read()) if b >= 0)
        finally:
            begin.close()
            data.close()
    return out


PIECE = "file string, record bigint, line int, value string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _batches(rows: Iterator[tuple], size: int = 5_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "record_index" else pa.string()) for n, c in zip(NAMES, columns, strict=True)], NAMES)


def fastq_files(spark: SparkSession, path: str, sample_id: str = "", validate: bool = True, allow_empty: bool = False, digests: dict[str, tuple[str, bytes]] | None = None) -> DataFrame:
    """Rows of SCHEMA of all files, in memory that does not grow with a file. digests: what `file_digests` tells of them, if known."""
    files = listed(spark, path)
    known = {n: d for n, d in (digests or {}).items() if n in files}
    known |= file_digests(spark, [n for n in files if n not in known])
    for name, (_, first) in known.items():
        if name.endswith(".gz") and first != GZIP_MAGIC and first:
            raise FastqError(name, 0, "named .gz but not compressed")
    odd = [n for n, (_, first) in known.items() if first == GZIP_MAGIC and not n.endswith(".gz")]
    plain = [n for n in files if n not in odd]
    out = None
    if plain:
        out = _by_lines(spark, plain, {n: known[n][0] for n in plain}, sample_id, validate, allow_empty)
    if odd:  # Spark tells compression by names only: these go through whole
        more = _whole(spark, odd, sample_id, validate, allow_empty)
        out = more if out is None else out.unionByName(more)
    return out


def _whole(spark: SparkSession, files: list[str], sample_id: str, validate: bool, allow_empty: bool) -> DataFrame:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path"), batch.column("content"), strict=True):
                yield from _batches(parse(data.as_py(), name.as_py(), sample_id, validate, allow_empty))

    return spark.read.format("binaryFile").load(files).select("path", "content").mapInArrow(kernel, SCHEMA)


def _by_lines(spark: SparkSession, files: list[str], digests: dict[str, str], sample_id: str, validate: bool, allow_empty: bool) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(files)
    meta = raw.metadataColumn("_metadata")
    lines = raw.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), "value")
    counts = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    told = counts.select("file", "block", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy("file")).alias("total")).collect()
    first = {(r.file, r.block): r.first for r in told}
    totals = {r.file: r.total for r in told}
    shared = spark.sparkContext.broadcast((first, totals, {_plain(n): d for n, d in digests.items()}))

    def pieces(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[tuple]:
        """Records that one split holds whole, or the lines of the others."""
        first, totals, digests = shared.value
        at, number, held = None, 0, []
        for batch in batches:
            for file, block, value in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")), strict=True):
                if (file, block) != at:
                    if not whole:
                        yield from ((at[0], number // 4, (number - len(held) + k) % 4, x) for k, x in enumerate(held))
                    at, number, held = (file, block), first[file, block], []
                    lost = -number % 4  # lines of a record that began in the split before
                line = value[:-1] if value.endswith("\r") else value
                if lost:
                    lost -= 1
                    if not whole:
                        yield file, number // 4, number % 4, line
                else:
                    held.append(line)
                number += 1
                if len(held) == 4:
                    if whole:
                        yield row_of(held, file, digests[_plain(file)], number // 4 - 1, sample_id, validate, allow_empty)
                    held = []
        if held and not whole:
            yield from ((at[0], number // 4, (number - len(held) + k) % 4, x) for k, x in enumerate(held))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(pieces(batches, True))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
        rows = list(pieces(batches, False))  # three lines at each end of a split
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["file", "record", "line", "value"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            _, _, digests = shared.value
            for batch in batches:
                for file, record, own in zip(*(batch.column(c).to_pylist() for c in ("file", "record", "own")), strict=True):
                    if len(own) < 4:
                        raise FastqError(file, record, "the record is cut off")
                    yield row_of([x["value"] for x in own], file, digests[_plain(file)], record, sample_id, validate, allow_empty)

        yield from _batches(rows())

    across = lines.mapInArrow(rest, PIECE).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("own"))
    return lines.mapInArrow(records, SCHEMA).unionByName(across.mapInArrow(joined, SCHEMA))


def _plain(name: str) -> str:
    """A file's name without what stores and listings write differently."""
    from urllib.parse import unquote

    return unquote(name).replace("file:///", "file:/").removeprefix("file:")


def offset_sample(path: str, records: int, seed: int = 0) -> list[tuple[int, bytes]]:
    """Records at random byte offsets of a plain local file, each taken once, by their places: a quick look whose odds follow
    the length of records. For a fair sample take reads by a hash of their names."""
    if records < 1:
        raise ValueError("a sample has a record or more")
    size, draw, found = os.path.getsize(path), random.Random(seed), {}
    with open(path, "rb") as file:
        for _ in range(max(1_000, 20 * records)):
            if len(found) == records or not size:
                break
            file.seek(draw.randrange(size))
            if file.tell():
                file.readline()
            for _ in range(8):  # to the next header
                place = file.tell()
                four = [file.readline() for _ in range(4)]
                text = [x.decode("ascii", "replace").rstrip("\r\n") for x in four]
                if not four[0]:
                    break
                if all(four) and problem_of([text[0], text[1].upper(), *text[2:]], True, False) is None:
                    found.setdefault(place, b"".join(four))
                    break
                file.seek(place + len(four[0]))
    if len(found) < records:
        raise ValueError(f"{path}: only {len(found)} records were found")
    return sorted(found.items())


def first_records(reads: DataFrame, n: int) -> DataFrame:
    """The first n records of each file."""
    return reads.where(F.col("record_index") < n)


def record_text() -> Column:
    return F.concat(F.lit("@"), "description", F.lit("\n"), "sequence", F.lit("\n+\n"), "quality")


def write_fastq(reads: DataFrame, path: str, by: list[str] | None = None, compress: bool = True) -> None:
    """FASTQ text in order of the record number, in as many files as there are ranges of it; with by, a folder for each value. No
    task writes, and no later task reads, all records of a value."""
    text = reads.select(*(by or []), "source_sha256", "record_index", record_text().alias("value"))
    order = [*(by or []), "source_sha256", "record_index"]
    ordered = text.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = ordered.select(*(by or []), "value").write.option("compression", "gzip" if compress else "none").mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).text(path)

"""What the operators share: reading, tables in the shared folder, Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a Python kernel takes at once.
BLOCK_BYTES = 4 << 20
#: So many row numbers at most are broadcast (16 bytes each in a hashed relation).
BROADCAST_ROWS = 4_000_000
#: White space by which words are split: 0x20 and 0x09 to 0x0D.
SPACE = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares; one of our own only where none is named and all runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='strandlake-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here and
    a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it by name inside body."""
    return F.transform(F.array(value), body)[0]


def text_bytes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and the UTF-8 bytes of the text, for kernels that read bytes."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("body"))


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, column: str = "body") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about limit bytes of text; a longer row stands alone."""
    for batch in batches:
        size = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(size):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def on_files(df: DataFrame, name: str) -> DataFrame:
    """df if it is read straight from Parquet files (columns and filters apart), else df written to the shared folder."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias") and plan.children().size() == 1:
        plan = plan.children().apply(0)
    straight = plan.nodeName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"
    if straight and plan.relation().fileFormat().getClass().getSimpleName() == "ParquetFileFormat":
        return df
    return stash(df, name)


def place(df: DataFrame) -> list[Column]:
    """file, at: where a row of a table read from Parquet files stands; the same at every reading, so no copy needs numbering."""
    meta = df.metadataColumn("_metadata")
    return [F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("at")]


#: The columns that place() makes.
PLACE = ["file", "at"]


def whole_rows(df: DataFrame) -> DataFrame:
    """file, at and the row as a struct, so that its names meet no others."""
    return df.select(*place(df), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"))


def by_rows(texts: DataFrame, rows: DataFrame, on: str | list[str], how: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """texts joined with rows (a few longs each): broadcast while they are counted to be few, else hashed
    per partition; the texts are never sorted."""
    few = rows.limit(limit + 1).count() <= limit
    return texts.join(F.broadcast(rows) if few else rows.hint("shuffle_hash"), on, how)


#: A key with more than this share of the rows is hot; at most 1 / HOT_SHARE keys are.
HOT_SHARE = 1 / 2000


def hot_join(rows: DataFrame, unique: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """rows joined with a table that holds each key once. Hot keys (a written table, counted to be few by their share) meet
    their rows by a broadcast, so no task takes all rows of one key."""
    few = F.broadcast(unique.join(F.broadcast(hot), on, "left_semi"))
    return rows.join(few, on).unionByName(rows.join(F.broadcast(hot), on, "left_anti").join(unique, on))


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def release(*frames: DataFrame) -> None:
    """Delete stashed tables that nothing reads any more."""
    for df in frames:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)

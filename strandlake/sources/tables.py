"""References, panels, layouts, designs and result tables as DataFrames.

All of them go through Spark's file readers. Checks that a row is wrong raise when
the table is read; checks over rows are small aggregations that raise on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import StrandlakeError
from ..functions.dna import IUPAC, circular_region


class TableError(StrandlakeError, ValueError):
    """A table that breaks its own rules."""


def _refuse(bad: DataFrame, what: str) -> None:
    first = bad.limit(3).collect()
    if first:
        raise TableError(f"{what}: {', '.join(str(tuple(r)) for r in first)}")


def clean(text: Column) -> Column:
    return F.translate(F.upper(F.regexp_replace(text, "\\s", "")), "U", "T")


def read_fasta(spark: SparkSession, paths: str | list[str], library_id: str = "") -> DataFrame:
    """library_id, ref_id, description, sequence, sequence_sha256, source_path; names are unique and hold no bar.

    A file is read as records split at lines that start with >."""
    raw = spark.read.text(paths if isinstance(paths, list) else [paths], wholetext=True).select(F.regexp_replace("value", "\r\n?", "\n").alias("t"), F.input_file_name().alias("source_path"))
    _refuse(raw.where(~F.ltrim("t").startswith(">")).select("source_path"), "not a FASTA file")
    records = raw.select("source_path", F.explode(F.split(F.concat(F.lit("\n"), F.ltrim("t")), "\n>")).alias("r")).where("trim(r) <> ''")
    head, body = F.trim(F.substring_index("r", "\n", 1)), F.substring(F.col("r"), F.length(F.substring_index("r", "\n", 1)) + 1, F.length("r"))
    out = records.select(F.lit(library_id).alias("library_id"), F.split(head, "\\s+")[0].alias("ref_id"), head.alias("description"), clean(body).alias("sequence"), "source_path")
    _refuse(out.where(F.col("ref_id").contains("|") | (F.col("ref_id") == "")).select("ref_id"), "a reference name is empty or holds a bar")
    _refuse(out.where(~F.col("sequence").rlike(f"^[{IUPAC}]+$")).select("ref_id"), "a sequence is empty or holds other symbols")
    _refuse(out.groupBy("ref_id").count().where("count > 1"), "a reference name occurs twice")
    return out.select("library_id", "ref_id", "description", "sequence", F.sha2("sequence", 256).alias("sequence_sha256"), "source_path")


def read_libraries(spark: SparkSession, libraries: dict[str, str | list[str]]) -> DataFrame:
    """The references of several libraries; a name may occur in two of them."""
    out = None
    for name in sorted(libraries):
        own = read_fasta(spark, libraries[name], name)
        out = own if out is None else out.unionByName(own)
    if out is None:
        raise TableError("no library is given")
    return out


def read_genbank(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """locus and sequence (of the ORIGIN block) of every record."""
    raw = spark.read.text(paths if isinstance(paths, list) else [paths], wholetext=True)
    each = raw.select(F.explode(F.split("value", "(?m)^//\\s*$")).alias("r")).where(F.col("r").contains("ORIGIN"))
    origin = F.regexp_extract("r", "(?s)\\nORIGIN[^\\n]*\\n(.*)$", 1)
    return each.select(F.regexp_extract("r", "LOCUS\\s+(\\S+)", 1).alias("locus"), F.upper(F.regexp_replace(origin, "[^A-Za-z]", "")).alias("sequence"))


def genbank_regions(records: DataFrame, left: str, right: str) -> DataFrame:
    """The region between two motifs of each circular record, on either strand."""
    return records.withColumn("region", circular_region(F.col("sequence"), left, right))


def read_registry(spark: SparkSession, path: str, family_id: str) -> DataFrame:
    """barcode_id and sequence of one family."""
    rows = spark.read.option("header", True).csv(path)
    if not {"family_id", "barcode_id", "sequence"} <= set(rows.columns):
        raise TableError("a registry has family_id, barcode_id and sequence")
    own = rows.where(F.trim("family_id") == family_id.strip()).select(F.trim("barcode_id").alias("barcode_id"), F.upper(F.trim("sequence")).alias("sequence"))
    if own.isEmpty():
        raise TableError(f"no barcode family {family_id}")
    _refuse(own.where("barcode_id is null or sequence is null or barcode_id = '' or sequence = ''"), "an empty name or sequence")
    _refuse(own.groupBy("barcode_id").count().where("count > 1"), "a barcode occurs twice")
    return own


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """plate_id, culture_plate, library_id, block, clonality of a pooling layout; repeated rows count once."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows.toDF(*[c.replace("﻿", "").strip() for c in rows.columns])
    known = ["plate_barcode", "culture_plate", "library", "block", "clonality"]
    if set(rows.columns) - set(known) or not set(known[:4]) <= set(rows.columns):
        raise TableError(f"a layout has the columns {', '.join(known)}")
    if "clonality" not in rows.columns:
        rows = rows.withColumn("clonality", F.lit(None).cast("string"))
    rows = rows.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) for c in known]).where(" or ".join(f"{c} is not null" for c in known))
    _refuse(rows.where(" or ".join(f"{c} is null" for c in known[:4])), "an empty cell")
    out = rows.dropDuplicates().select(F.col("plate_barcode").alias("plate_id"), "culture_plate", F.col("library").alias("library_id"), "block", F.coalesce("clonality", F.lit("unspecified")).alias("clonality"))
    _refuse(out.groupBy("plate_id").agg(F.count_distinct("clonality").alias("n")).where("n > 1"), "a barcode with two clonalities")
    return out


def write_layout(pools: DataFrame, blocks: DataFrame, clonality: DataFrame, path: str) -> None:
    """One row for each barcode, culture plate and block."""
    rows = pools.join(blocks, "culture_plate").join(clonality, "plate_id", "left")
    rows.select(F.col("plate_id").alias("plate_barcode"), "culture_plate", F.col("library_id").alias("library"), "block", F.coalesce("clonality", F.lit("unspecified")).alias("clonality")).orderBy("plate_barcode", "culture_plate", "library", "block").coalesce(1).write.option("header", True).csv(path)


def read_designs(spark: SparkSession, path: str) -> DataFrame:
    """gene_id, block, oligos (all columns named DNA Fragment) and the full sequence of a design table."""
    rows = spark.read.option("header", True).csv(path)
    oligos = sorted((c for c in rows.columns if c.startswith("DNA Fragment")), key=lambda c: [int(x) for x in c.split() if x.isdigit()])
    if not {"Block", "Sequence Name", "Full Sequence"} <= set(rows.columns) or not oligos:
        raise TableError("a design table has Block, Sequence Name, Full Sequence and DNA Fragment columns")
    held = F.filter(F.array(*[clean(F.coalesce(F.col(f"`{c}`"), F.lit(""))) for c in oligos]), lambda x: x != "")
    return rows.select(F.trim("Sequence Name").alias("gene_id"), F.trim("Block").alias("block"), held.alias("oligos"), clean(F.col("Full Sequence")).alias("gene"))


def read_short_reads(spark: SparkSession, counts_path: str, reads_path: str) -> DataFrame:
    """Classified short reads with the length of their reference (0 where unknown)."""
    counts = spark.read.option("header", True).option("sep", "\t").schema("reference_name string, reference_length int").csv(counts_path)
    reads = spark.read.option("header", True).option("sep", "\t").schema("reference_name string, expected_group string, expected_block int, category string, edit_distance int").csv(reads_path)
    return reads.join(counts.dropDuplicates(["reference_name"]), "reference_name", "left").withColumn("reference_length", F.coalesce("reference_length", F.lit(0)))


def read_stage_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stage table of an earlier run: compressed CSV whose empty cells are nulls."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_stage_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def first_token_map(references: DataFrame) -> DataFrame:
    """name and sequence of consensus or scaffold records."""
    return references.select(F.split("description", "\\s+")[0].alias("name"), "sequence")

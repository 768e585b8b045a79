"""Sinks: FASTA trees, indexes, CSV and JSON lines, HTML reports, demultiplexed FASTQ views."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import StrandlakeError
from ..functions.dna import fasta_record, wrapped
from ..functions.reads import html_value, normalized_well, safe_name
from .fastq import record_text

#: Rows of a summary that go into HTML.
SUMMARY_ROWS = 10_000


def write_fasta_tree(clones: DataFrame, path: str, folders: list[str], name: str = "consensus_id", seq: str = "sequence") -> None:
    """FASTA text with a folder for each value of folders; clones without a sequence are left out."""
    rows = clones.where(F.col(seq).isNotNull() & (F.col(seq) != ""))
    safe = [safe_name(F.coalesce(F.col(c).cast("string"), F.lit("none"))).alias(c) for c in folders]
    text = rows.select(*safe, F.col(name).alias("_name"), F.rtrim(fasta_record(F.col(name), F.col(seq)), F.lit("\n")).alias("value"))
    text.repartition(*folders).sortWithinPartitions(*folders, "_name").drop("_name").write.mode("errorifexists").partitionBy(*folders).text(path)


def write_index(rows: DataFrame, path: str, order: list[str]) -> None:
    """One table as CSV in a stated order; arrays are joined by bars."""
    flat = [F.array_join(c, "|").alias(c) if t.startswith("array<string") else F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).repartitionByRange(*order).sortWithinPartitions(*order).write.option("header", True).option("compression", "gzip").mode("errorifexists").csv(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.option("compression", "gzip").option("ignoreNullFields", "false").mode("errorifexists").json(path)


def write_demultiplexed(calls: DataFrame, path: str) -> None:
    """Overlapping views of accepted reads: by_plate, by_well, unresolved_well."""
    scope = F.array(
        F.struct(F.lit("by_plate").alias("scope"), F.lit("all").alias("w")),
        F.struct(F.when(F.col("well.id").isNull(), "unresolved_well").otherwise("by_well").alias("scope"), F.coalesce("well.id", F.lit("none")).alias("w")),
    )
    rows = calls.where("call_status = 'assigned' and plate.id is not null").withColumn("_s", F.explode(scope))
    text = rows.select(F.col("_s.scope").alias("scope"), safe_name(F.col("plate.id")).alias("plate_id"), safe_name(F.col("_s.w")).alias("well_id"), "source_sha256", "record_index", record_text().alias("value"))
    keys = ["scope", "plate_id", "well_id"]
    text.repartition(*keys).sortWithinPartitions(*keys, "source_sha256", "record_index").drop("source_sha256", "record_index").write.option("compression", "gzip").mode("errorifexists").partitionBy(*keys).text(path)


def html_table(rows: DataFrame, title: str, limit: int = SUMMARY_ROWS) -> str:
    """A summary as HTML; a table of more rows than limit is refused, not cut."""
    cells = rows.select(F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), html_value(F.col(c)), F.lit("</td>")) for c in rows.columns], F.lit("</tr>")).alias("h")).limit(limit + 1).collect()
    if len(cells) > limit:
        raise ValueError(f"a summary has at most {limit} rows")
    head = "".join(f"<th>{c}</th>" for c in rows.columns)
    return f"<h2>{title}</h2><table><tr>{head}</tr>{''.join(r.h for r in cells)}</table>"


class ExportError(StrandlakeError):
    """A folder that an export must not replace."""


def _path(spark: SparkSession, name: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(name)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and moved there whole."""
    where, store = _path(spark, path)
    beside, _ = _path(spark, f"{path}.{uuid.uuid4().hex}")
    out = store.create(beside)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    store.delete(where, False)
    if not store.rename(beside, where):
        raise ExportError(f"{path} could not be put in its place")


def clone_header(columns: list[str]) -> Column:
    """The FASTA header of a graded clone: name, grade and what else is known of it."""
    parts = [F.concat(F.lit(">"), "consensus_id"), F.concat(F.lit("grade="), "grade")]
    for name in ("kind", "insert_grade", "vector_status", "insert_coding_status", "alias_key", "library_id", "plate_id", "well_id", "culture_plate", "n_reads_used", "mean_depth", "ambiguous_bases", "identity", "mixed_signature", "mixed_detail", "mixed_in_reading_frame", "mixed_worst_effect", "designed_allele_fraction"):
        if name in columns:
            value = F.col(name).cast("string")
            parts.append(F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{name}="), value)))
    return F.concat_ws(" ", *parts)


def graded_index(clones: DataFrame) -> DataFrame:
    """clones with the folder of their FASTA: plate, culture plate (if it is one) and well; empty for clones without a sequence."""
    single = F.when(F.coalesce("culture_plate", F.lit("")).contains("|"), F.lit("")).otherwise(F.coalesce("culture_plate", F.lit("")))
    name = lambda c, none: safe_name(F.coalesce(F.nullif(c, F.lit("")), F.lit(none)))
    folder = {"plate": name(F.col("plate_id"), "unknown_plate"), "source": F.when(single != "", safe_name(single)).otherwise("all"), "well": normalized_well(F.coalesce("well_id", F.lit("unknown_well")))}
    told = clones.withColumns(folder)
    place = F.concat(F.lit("plate="), "plate", F.lit("/source="), "source", F.lit("/well="), "well")
    return told.withColumn("file", F.when(F.coalesce(F.length("sequence"), F.lit(0)) > 0, place).otherwise(""))


def write_graded(clones: DataFrame, path: str) -> dict:
    """FASTA of graded clones by plate, culture plate and well, index and summary.json; returns the summary.

    All is written beside the path and moved there when complete. A folder that holds no index of ours is never replaced."""
    spark = clones.sparkSession
    where, store = _path(spark, path)
    if store.exists(where) and not store.exists(_path(spark, f"{path}/index")[0]):
        raise ExportError(f"{path} is no export; it is not replaced")
    beside = f"{path}.{uuid.uuid4().hex}"
    told = graded_index(clones)
    text = told.where("file <> ''").select("plate", "source", "well", "consensus_id", F.concat(clone_header(told.columns), F.lit("\n"), wrapped(F.col("sequence"), 60)).alias("value"))
    keys = ["plate", "source", "well"]
    text.repartition(*keys).sortWithinPartitions(*keys, "consensus_id").drop("consensus_id").write.partitionBy(*keys).text(f"{beside}/fasta")
    index = told.drop("sequence", "reference", "contributors", "plate", "source", "well", *[n for n, t in told.dtypes if t.startswith(("array", "map", "struct")) and n != "regions"])
    write_index(index, f"{beside}/index", ["plate_id", "well_id", "consensus_id"])
    counted = {(r.plate_id, r.grade): r["count"] for r in told.groupBy("plate_id", "grade").count().collect()}  # plates by grades
    summary: dict = {"grades": {}, "by_plate": {}, "files": told.where("file <> ''").count(), "clones": sum(counted.values())}
    for (plate, grade), n in sorted(counted.items(), key=repr):
        summary["grades"][grade] = summary["grades"].get(grade, 0) + n
        summary["by_plate"].setdefault(str(plate), {})[grade] = n
    for name in ("insert_grade", "vector_status"):
        if name in told.columns:
            summary[f"{name}s"] = {str(r[0]): r[1] for r in told.groupBy(name).count().collect()}
    write_text(spark, f"{beside}/summary.json", json.dumps(summary, indent=1, sort_keys=True))
    if store.exists(where):
        store.delete(where, True)
    if not store.rename(_path(spark, beside)[0], where):
        raise ExportError(f"{path} could not be put in its place")
    return summary


def write_report(spark: SparkSession, path: str, title: str, tables: dict[str, DataFrame]) -> None:
    """A run as one HTML page of small tables."""
    body = "".join(html_table(df, name) for name, df in tables.items())
    write_text(spark, path, f"<!doctype html><meta charset='utf-8'><title>{title}</title><h1>{title}</h1>{body}")


def write_regions(records: DataFrame, path: str) -> None:
    """FASTA of the regions (locus, region) that were found, by name, lines of 60."""
    rows = records.where(F.col("region").isNotNull()).select("locus", F.concat(F.lit(">"), "locus", F.lit("\n"), wrapped(F.col("region"), 60)).alias("value"))
    rows.repartitionByRange("locus").sortWithinPartitions("locus").select("value").write.mode("errorifexists").text(path)

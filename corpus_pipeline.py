"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the driver of the
pipeline writes it and gives the next stage what was written. A stage keeps the
columns of documents and all rows that it does not decide against; the last one
returns the shard and the slot of each document.

Near-duplicates: fingerprints over five-word shingles propose pairs, a Jaccard
similarity of the shingle sets of 0.8 or more links them, and of each group of links
the document with the smallest id stays (of repeated rows, one).

Nulls and other cases. A null or empty text fails the quality rules (fewer than ten
words). A null language or source counts as "" where strata and mixing cells are
made. A null id stays null: such rows pass the filters on their own, never name a
group while another id is there, and share one draw in mixing. Repeated rows are
rows of their own until near-dedup keeps one. Columns beyond those of documents are
dropped by the first stage. Empty documents give empty tables in every stage; without
labels only the base quality rule rejects, without benchmark nothing is contaminated.
Texts are read whole at any length; ties go to the smaller id, then the earlier row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake.llm import common, decontamination, mixing, quality_rules, sharding, similar_texts

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
WORDS = 5
SIMILARITY = 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.select_kept(docs, common.table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return similar_texts.one_of_each_group(docs.select(*COLUMNS), WORDS, SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark words."""
    return decontamination.clean(docs.select(*COLUMNS), common.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics reach their target weights."""
    return mixing.mix(docs.select(*COLUMNS)).where("mix_selected").select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document that is left."""
    return sharding.shard_documents(docs)


STAGES = [("quality rules", quality), ("simhash near-dedup", near_dedup), ("benchmark decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]
#: SimHash groups and Karmarkar-Karp shards are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = common.stash(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs

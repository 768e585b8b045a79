"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import StrandlakeError


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where that is unset and all runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise StrandlakeError("spark.checkpoint.dir names no folder that all executors share")
    return f"file://{tempfile.mkdtemp(prefix='strandlake-')}"


def numbered(df: DataFrame, order: list[str], name: str = "place", keep=None) -> DataFrame:
    """df with its place (from 1) in an order, without one task that holds all rows: ranges are written, counted and numbered."""
    from ..operators.kmers import checkpointed

    ranged = (keep or checkpointed)(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    begins = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.join(F.broadcast(begins), "_range").withColumn(name, (F.col("_begin") + inside).cast("long")).drop("_range", "_begin")

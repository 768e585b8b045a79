"""Reads, references, panels, layouts and clones as projections of the general tables.

The tables hold no DNA; each view is a fixed projection that SQL can state too
(``VIEWS_SQL``), so every query has an independent counterpart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "ACGTACGTACGTACGTACGTACGTAC"
SCORES = "()*+,-./0123456789:;<=>?@A"
HEX = "0123456789abcdef"
HEX_BASES = "ACGTACGTACGTACGT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letters(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z]", "")


def encoded(text: Column) -> Column:
    return F.translate(letters(text), LETTERS, BASES)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, sequence, quality, plate_id, well_id, sample_id of every document."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", encoded(F.col("text")).alias("sequence"), F.translate(letters(F.col("text")), LETTERS, SCORES).alias("quality"), F.col("lang").alias("plate_id"), F.col("source").alias("well_id"), F.lit("s1").alias("sample_id"))


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer partitions than there are cores over all of them, for kernels that work per row; others as they are."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select(
        F.concat(F.lit("Block_"), (F.col("item_id") % 5).cast("string"), F.lit("_"), F.col("item_id").cast("string")).alias("ref_id"),
        F.concat(F.lit("lib"), (F.col("item_id") % 2).cast("string")).alias("library_id"),
        (F.col("item_id") % 5).cast("string").alias("block"),
        encoded(F.col("text")).alias("sequence"),
    )


def barcode(name: Column) -> Column:
    return F.translate(F.substring(F.md5(name), 1, 24), HEX, HEX_BASES)


def panel(spark: SparkSession, sf_dir: str, name: str = "region") -> DataFrame:
    """barcode_id and sequence: one of 24 bases for each region or nation."""
    key, label = f"{name[0]}_{name}key", f"{name[0]}_name"
    return table(spark, sf_dir, name).select(F.col(key).cast("long").alias("key"), F.col(label).alias("barcode_id"), barcode(F.col(label)).alias("sequence"))


def tagged_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reads with the barcode of region doc_id % 5 in front; each third read has three bases of it changed."""
    p = panel(spark, sf_dir).select("key", F.col("barcode_id").alias("true_id"), F.col("sequence").alias("tag"))
    swap = lambda i: F.translate(F.substring("tag", i, 1), "ACGT", "CATG")
    worn = F.concat(F.substring("tag", 1, 6), swap(7), F.substring("tag", 8, 6), swap(14), F.substring("tag", 15, 6), swap(21), F.substring("tag", 22, 3))
    r = reads(spark, sf_dir).withColumn("key", F.col("doc_id") % 5).join(F.broadcast(p), "key")  # five regions
    return r.withColumn("tag", F.when(F.col("doc_id") % 3 == 0, worn).otherwise(F.col("tag"))).withColumns({"sequence": F.concat("tag", "sequence"), "quality": F.concat(F.repeat(F.lit("I"), 24), "quality")}).drop("key", "tag")


def pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """plate_id (region) and culture_plate (nation)."""
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("plate_id"), F.col("n_name").alias("culture_plate"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """library_id, block (supplier group) and culture_plate (nation)."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    joined = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select(F.concat(F.lit("lib"), (F.col("s_suppkey") % 2).cast("string")).alias("library_id"), (F.col("s_suppkey") % 40).cast("string").alias("block"), F.col("n_name").alias("culture_plate")).distinct()


def clones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clones of orders: plate (nation), well, design, grade, depth, identity."""
    o, c, n = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    grade = F.element_at(F.array(*map(F.lit, ("perfect", "screenable", "mixed_damage", "mixed_variants", "frameshift", "premature_stop", "truncated", "mismatched", "low_depth"))), (F.col("o_orderkey") % 9 + 1).cast("int"))
    return joined.select(
        F.col("o_orderkey").alias("clone_id"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("plate_id"),
        F.col("n_name").alias("culture_plate"),
        (F.col("o_custkey") % 96).alias("well"),
        F.concat(F.char((F.lit(65) + F.floor(F.col("o_custkey") % 96 / 12)).cast("int")), F.lpad((F.col("o_custkey") % 12 + 1).cast("string"), 2, "0")).alias("well_id"),
        (F.col("o_orderkey") % 7).alias("block"),
        F.concat(F.lit("d"), (F.col("o_orderkey") % 211).cast("string")).alias("design_key"),
        F.md5(F.concat(F.lit("s"), (F.col("o_orderkey") % 503).cast("string"))).alias("sequence_id"),
        grade.alias("grade"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("Screenable")).alias("insert_class"),
        F.when(F.col("o_orderkey") % 13 == 0, "chimera").otherwise("consensus").alias("kind"),
        (F.col("o_orderkey") % 4 * F.lit(0.01)).alias("error"),
        F.col("o_totalprice").alias("price"),
    )


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pileup observations of lineitem: group_id, pos, kind, allele."""
    li = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_linenumber") == 7, "del").when(F.col("l_quantity") < 5, "low").otherwise("base")
    base = F.translate("l_returnflag", "ANR", "ACG")
    return li.select(F.concat(F.lit("g"), (F.col("l_suppkey") % 20).cast("string")).alias("group_id"), (F.col("l_partkey") % 50).cast("int").alias("pos"), kind.alias("kind"), F.when(kind == "del", "-").otherwise(base).alias("allele"))


def signature_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window calls of events: a read is a user, a window an event in time order, a name the event's type (some unknown)."""
    e = table(spark, sf_dir, "events")
    name = F.when(F.col("event_id") % 10 == 0, None).otherwise(F.concat(F.lit("Block_"), (F.length("event_type") % 3).cast("string"), F.lit("_"), F.col("event_type")))
    part = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.dayofmonth("ts").cast("string"))
    return e.select(part.alias("read_uid"), F.col("event_id").alias("window"), name.alias("name"), (F.col("user_id") % 7).cast("string").alias("well_id"))


def wells(spark: SparkSession, sf_dir: str, side: int) -> DataFrame:
    """Replicate wells of conversations: even turns on one side, odd ones on the other."""
    c = table(spark, sf_dir, "conversations").where(F.col("turn") % 2 == side)
    return c.select((F.col("conv_id") % 60).cast("string").alias("well_id"), F.concat(F.lit("c"), (F.length("text") % 5).cast("string")).alias("identity"), F.substring(encoded(F.col("text")), 1, 40).alias("sequence"))


ENC = "translate(regexp_replace(lower({t}), '[^a-z]', '', 'g'), '" + LETTERS + "', '" + BASES + "')"
VIEWS_SQL = {
    "reads": f"""SELECT doc_id, {ENC.format(t="text")} AS sequence, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{SCORES}') AS quality,
        lang AS plate_id, source AS well_id, 's1' AS sample_id FROM documents""",
    "refs": f"SELECT 'Block_' || (item_id % 5) || '_' || item_id AS ref_id, 'lib' || (item_id % 2) AS library_id, (item_id % 5)::VARCHAR AS block, {ENC.format(t='text')} AS sequence FROM benchmark",
    "panel": f"SELECT r_regionkey::BIGINT AS key, r_name AS barcode_id, translate(substr(md5(r_name), 1, 24), '{HEX}', '{HEX_BASES}') AS sequence FROM region",
    "nation_panel": f"SELECT n_nationkey::BIGINT AS key, n_name AS barcode_id, translate(substr(md5(n_name), 1, 24), '{HEX}', '{HEX_BASES}') AS sequence FROM nation",
    "tagged": """SELECT doc_id, plate_id, well_id, barcode_id AS true_id, tag || r.sequence AS sequence, repeat('I', 24) || quality AS quality FROM (SELECT reads.*, barcode_id,
        CASE WHEN doc_id % 3 = 0 THEN substr(panel.sequence, 1, 6) || translate(substr(panel.sequence, 7, 1), 'ACGT', 'CATG') || substr(panel.sequence, 8, 6)
        || translate(substr(panel.sequence, 14, 1), 'ACGT', 'CATG') || substr(panel.sequence, 15, 6) || translate(substr(panel.sequence, 21, 1), 'ACGT', 'CATG') || substr(panel.sequence, 22, 3)
        ELSE panel.sequence END AS tag FROM reads JOIN panel ON key = doc_id % 5) r""",
    "pools": "SELECT 'R' || n_regionkey AS plate_id, n_name AS culture_plate FROM nation",
    "blocks": "SELECT DISTINCT 'lib' || (s_suppkey % 2) AS library_id, (s_suppkey % 40)::VARCHAR AS block, n_name AS culture_plate FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "clones": """SELECT o_orderkey AS clone_id, 'R' || n_regionkey AS plate_id, n_name AS culture_plate, o_custkey % 96 AS well,
        chr((65 + (o_custkey % 96) // 12)::INT) || lpad((o_custkey % 12 + 1)::VARCHAR, 2, '0') AS well_id, o_orderkey % 7 AS block,
        'd' || (o_orderkey % 211) AS design_key, md5('s' || (o_orderkey % 503)) AS sequence_id,
        ['perfect', 'screenable', 'mixed_damage', 'mixed_variants', 'frameshift', 'premature_stop', 'truncated', 'mismatched', 'low_depth'][(o_orderkey % 9 + 1)::INT] AS grade,
        CASE WHEN o_orderkey % 11 = 0 THEN 'Screenable' END AS insert_class, CASE WHEN o_orderkey % 13 = 0 THEN 'chimera' ELSE 'consensus' END AS kind,
        o_orderkey % 4 * 0.01::DOUBLE AS error, o_totalprice AS price
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "votes": """SELECT 'g' || (l_suppkey % 20) AS group_id, (l_partkey % 50)::INT AS pos, CASE WHEN l_linenumber = 7 THEN 'del' WHEN l_quantity < 5 THEN 'low' ELSE 'base' END AS kind,
        CASE WHEN l_linenumber = 7 THEN '-' ELSE translate(l_returnflag, 'ANR', 'ACG') END AS allele FROM lineitem""",
    "calls": """SELECT user_id || '-' || day(ts) AS read_uid, event_id AS "window", CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'Block_' || (length(event_type) % 3) || '_' || event_type END AS name,
        (user_id % 7)::VARCHAR AS well_id FROM events""",
    "side0": f"SELECT (conv_id % 60)::VARCHAR AS well_id, 'c' || (length(text) % 5) AS identity, substr({ENC.format(t='text')}, 1, 40) AS sequence FROM conversations WHERE turn % 2 = 0",
    "side1": f"SELECT (conv_id % 60)::VARCHAR AS well_id, 'c' || (length(text) % 5) AS identity, substr({ENC.format(t='text')}, 1, 40) AS sequence FROM conversations WHERE turn % 2 = 1",
}
NEEDS = {"tagged": ("reads", "panel")}


def with_views(body: str, *names: str) -> str:
    """SQL with the views it names in front; body may go on with more of its own after a comma."""
    every: list[str] = []
    for n in names:
        every += [x for x in (*NEEDS.get(n, ()), n) if x not in every]
    return "WITH " + ", ".join(f"{n} AS ({VIEWS_SQL[n]})" for n in every) + (" " if body.lstrip().upper().startswith("SELECT") else ", ") + body

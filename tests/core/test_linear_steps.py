"""Steps that grew with the square of a read, or with a plate, held against plain versions."""

import random
import re

from pyspark.sql import functions as F

from strandlake.functions import dna, protein
from strandlake.sources import fastq


def test_sizes_of_excisions_without_bodies(spark):
    """100,000 bases: 1.5 GB of bodies before."""
    r = random.Random(3)
    texts = ["".join(r.choice("ACGT") for _ in range(n)) for n in (0, 3, 40, 400, 1000)] + ["ACGTTGCA" * 30, "ACGT" * 25_000, None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, s string").select("id", "s", dna.excision_sizes(F.col("s"), "ACGT", "TGCA").alias("n"))
    bodies = rows.where("length(s) < 10000").select("n.bodies", "n.shortest", dna.excisions(F.col("s"), "ACGT", "TGCA").alias("all")).collect()
    assert all(x.bodies == len(x["all"]) and x.shortest == min(map(len, x["all"]), default=None) for x in bodies) and any(x.bodies for x in bodies)
    assert [x.bodies for x in rows.where("id > 5").orderBy("id").select("n.bodies").collect()] == [0, 0]
    assert dna.sizes_of_excisions("ACGTTGCA" * 12_500, "ACGT", "TGCA", 1, 8)[0] == 12_498 * 12_499 // 2


def test_first_orf_is_linear(spark):
    r = random.Random(4)
    texts = ["".join(r.choice("ACGT") for _ in range(r.randint(0, 120))) for _ in range(300)] + ["ATG" * 40_000, "ATG" * 40_000 + "ATAA", "ATG" * 9 + "TAA", None]

    def plain(s):
        for m in re.finditer("ATG", s):
            for j in range(m.start() + 3, len(s) - 2, 3):
                if s[j : j + 3] in ("TAA", "TAG", "TGA"):
                    return m.start(), j + 3

    got = spark.createDataFrame(list(enumerate(texts)), "id long, s string").select("id", protein.first_orf(F.col("s")).alias("o")).orderBy("id").collect()
    assert [x.o and tuple(x.o) for x in got[:300]] == [plain(s) for s in texts[:300]]
    assert [x.o and tuple(x.o) for x in got[300:]] == [None, None, (0, 30), None]


def test_a_plate_is_more_than_one_file(spark, tmp_path):
    """Before, all records of a value were one task's."""
    reads = spark.range(4000).select(F.lit("p").alias("plate"), F.concat(F.lit("r"), "id").alias("description"), F.lit("ACGT").alias("sequence"), F.lit("IIII").alias("quality"), F.lit("x").alias("source_sha256"), F.col("id").alias("record_index"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fastq.write_fastq(reads, str(tmp_path / "out"), ["plate"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = sorted((tmp_path / "out" / "plate=p").glob("*.gz"))
    back = [int(x.name[1:]) for n in names for x in fastq.fastq_files(spark, str(n)).orderBy("record_index").collect()]
    assert len(names) > 4 and back == list(range(4000))

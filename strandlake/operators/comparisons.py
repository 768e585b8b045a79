"""Comparing runs: replicate wells, sequencing platforms, encodings of one design."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.statistics import apportioned, rarefied

# Outcomes from best to worst, and what grades and read categories count as.
OUTCOMES = ("Perfect", "Screenable", "Other")
GRADE_OUTCOME = {
    "perfect": "Perfect", "screenable": "Screenable", "mixed_damage": "Screenable", "mixed_variants": "Other",
    "mismatched": "Other", "truncated": "Other", "premature_stop": "Other", "frameshift": "Other",
}
CATEGORY_OUTCOME = {"perfect_match": "Perfect", "synonymous": "Screenable", "nonsynonymous": "Screenable", "premature_stop": "Other", "frameshift": "Other"}


def mapped(value: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), value)


def outcome_rank(outcome: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, OUTCOMES)), outcome)


def ranked_outcome(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, OUTCOMES)), rank.cast("int"))


#: A permutation test counts by so many bits of a hash before it sorts.
HASH_BITS = 12

# What a clone with a sequence is called.
BUILT = ("consensus_pass", "mixed_variants")


def built_clones(clones: DataFrame) -> DataFrame:
    """Clones whose status says that they have a sequence."""
    return clones.where(F.col("status").isin(*BUILT))


def library_set(clones: DataFrame, plate: str, prefix: str, encodings: list[str]) -> DataFrame:
    """Clones of one barcode whose culture plate has a prefix and whose encoding is listed."""
    return clones.where((F.col("plate_id") == plate) & F.coalesce("culture_plate", F.lit("")).startswith(prefix) & F.col("encoding").isin(*encodings))


def with_sequences(calls: DataFrame, records: DataFrame, key: str = "consensus_id") -> DataFrame:
    """calls with the sequence of the record (name, sequence) they name, empty where there is none."""
    one = records.groupBy(F.col("name").alias(key)).agg(F.min("sequence").alias("sequence"))
    return calls.join(one, key, "left").withColumn("sequence", F.coalesce("sequence", F.lit("")))


def with_insert_outcomes(clones: DataFrame, outcomes: DataFrame, digests: DataFrame, key: str = "consensus_id") -> DataFrame:
    """clones with the outcome of their insert (null if not told) and an identity: the sequence's digest, else the name."""
    told = clones.join(outcomes.select(key, "insert_class"), key, "left").join(digests.select(key, "sequence_sha256"), key, "left")
    return told.withColumn("sequence_id", F.coalesce(F.nullif(F.col("sequence_sha256"), F.lit("")), F.col(key))).drop("sequence_sha256")


def partner_support(contested: DataFrame, pairs: DataFrame, votes: DataFrame) -> DataFrame:
    """Contested alleles and what the well's other barcode reads there.

    contested: plate_id, culture_plate, well_id, design, position, minor. pairs: culture_plate, well_id, plate_a, plate_b.
    votes: plate_id, well_id, design, position, allele, n (every place of a group that has reads). Depth, reads and share of the
    minor allele; no reads where the partner has no such group."""
    known = pairs.select("culture_plate", "well_id", F.col("plate_a").alias("plate_id"), F.col("plate_b").alias("partner_plate"))
    there = contested.join(known, ["culture_plate", "well_id", "plate_id"])
    groups = votes.select(F.col("plate_id").alias("partner_plate"), "well_id", "design").distinct().withColumn("_has", F.lit(True))
    counted = votes.groupBy(F.col("plate_id").alias("partner_plate"), "well_id", "design", "position").agg(F.sum("n").alias("partner_depth"), F.map_from_entries(F.collect_list(F.struct("allele", "n"))).alias("partner_counts"))
    told = there.join(groups, ["partner_plate", "well_id", "design"], "left").join(counted, ["partner_plate", "well_id", "design", "position"], "left")
    reads = F.when(F.col("_has"), F.coalesce(F.try_element_at("partner_counts", F.col("minor")), F.lit(0)))
    depth = F.when(F.col("_has"), F.coalesce("partner_depth", F.lit(0)))
    share = F.when(depth > 0, reads / depth)
    return told.withColumns({"partner_depth": depth, "partner_minor_reads": reads, "partner_minor_fraction": share, "partner_status": F.when(F.col("_has"), "ok").otherwise("no reads")}).drop("_has")


# Replicates


def compare_wells(dedicated: DataFrame, pooled: DataFrame, keys: list[str]) -> DataFrame:
    """Category of every well of either side (keys, identity, sequence), by the clones they share.

    exact only if every shared clone has one sequence; distances of shared clones that differ."""

    def wells(side: DataFrame, name: str) -> DataFrame:
        one = side.groupBy(*keys, "identity").agg(F.max("sequence").alias("sequence"))
        return one.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("identity", F.coalesce("sequence", F.lit("")).alias("sequence"))))).alias(name))

    both = wells(dedicated, "_left").join(wells(pooled, "_right"), keys, "full")
    names = lambda c: F.coalesce(F.array_sort(F.map_keys(c)), F.array().cast("array<string>"))
    told = both.withColumns({"dedicated": names("_left"), "pooled": names("_right")}).withColumn("shared", F.array_sort(F.array_intersect("dedicated", "pooled")))
    at = lambda side, k: F.try_element_at(F.col(side), k)
    exact = F.filter("shared", lambda k: (at("_left", k) == at("_right", k)) & (at("_left", k) != ""))
    told = told.withColumn("exact", exact).withColumn("differing", F.array_except("shared", "exact"))
    known = F.filter("differing", lambda k: (at("_left", k) != "") & (at("_right", k) != ""))
    distances = F.map_from_arrays(known, F.transform(known, lambda k: F.levenshtein(at("_left", k), at("_right", k))))
    category = (
        F.when((F.size("shared") > 0) & (F.size("differing") == 0), "matched_exact")
        .when(F.size("shared") > 0, "matched_different_sequence")
        .when((F.size("dedicated") > 0) & (F.size("pooled") > 0), "different_design")
        .when(F.size("dedicated") > 0, "dedicated_only")
        .otherwise("pool_only")
    )
    return told.withColumns({"edit_distances": distances, "category": category}).drop("_left", "_right")


def concordance(outcomes: DataFrame) -> DataFrame:
    """Wells of each kind in one row, and the matched share of dedicated wells."""
    n = lambda *c: F.count_if(F.col("category").isin(*c))
    held = n("matched_exact", "matched_different_sequence", "different_design", "dedicated_only")
    return outcomes.agg(
        F.count(F.lit(1)).alias("wells"),
        *[n(c).alias(c) for c in ("matched_exact", "matched_different_sequence", "different_design", "dedicated_only", "pool_only")],
        F.when(held > 0, n("matched_exact", "matched_different_sequence") / held).alias("matched_fraction"),
    )


def pairing_check(clones: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per claimed culture plate: clones whose block belongs there, and the share of them."""
    home = blocks.groupBy("library_id", "block").agg(F.collect_set("culture_plate").alias("_plates"))
    told = clones.join(home, ["library_id", "block"])
    fits = F.array_contains("_plates", F.col("culture_plate"))
    return told.groupBy("culture_plate").agg(F.count(F.lit(1)).alias("clones"), F.count_if(fits).alias("fitting")).withColumn("fraction", F.col("fitting") / F.col("clones"))


def partners(layout: DataFrame) -> DataFrame:
    """Barcodes that hold the same physical well: culture_plate, well_id and each ordered pair of plates."""
    a = layout.select("culture_plate", "well_id", F.col("plate_id").alias("plate_a"))
    b = layout.select("culture_plate", "well_id", F.col("plate_id").alias("plate_b"))
    return a.join(b, ["culture_plate", "well_id"]).where("plate_a <> plate_b")


def position_facts(votes: DataFrame, keys: list[str]) -> DataFrame:
    """Depth and allele shares at each position of counted votes (keys, position, allele, n)."""
    at = [*keys, "position"]
    grouped = votes.groupBy(*at).agg(F.sum("n").alias("depth"), F.array_sort(F.collect_list(F.struct("allele", "n"))).alias("alleles"))
    return grouped.withColumn("shares", F.transform("alleles", lambda a: F.struct(a["allele"].alias("allele"), (a["n"] / F.col("depth")).alias("share"))))


def heterogeneity(left: DataFrame, right: DataFrame, keys: list[str], min_depth: int, present: float = 0.20, absent: float = 0.05) -> DataFrame:
    """Contested alleles of two replicates side by side: shared, one-sided or ambiguous.

    left, right: keys, position, reference_base, allele, share, depth."""
    on = [*keys, "position", "reference_base", "allele"]
    a = left.select(*on, F.col("share").alias("left_share"), F.col("depth").alias("left_depth"))
    b = right.select(*on, F.col("share").alias("right_share"), F.col("depth").alias("right_depth"))
    both = a.join(b, on).where((F.col("left_depth") >= min_depth) & (F.col("right_depth") >= min_depth) & (F.col("allele") != F.col("reference_base")))
    high, low = F.greatest("left_share", "right_share"), F.least("left_share", "right_share")
    contested = both.where((high >= present) & (high <= 1 - absent))
    verdict = F.when(low >= present, "shared").when(low < absent, "one_sided").otherwise("ambiguous")
    pair = F.concat("reference_base", F.lit(">"), "allele")
    kind = F.when(pair.isin("G>T", "C>A"), "oxidative").when(pair.isin("A>G", "G>A", "C>T", "T>C"), "transition").otherwise("transversion")
    return contested.withColumns({"verdict": verdict, "class": kind})


# Platforms


def wells_per_block(clones: DataFrame) -> DataFrame:
    return clones.groupBy("block").agg(F.count_distinct("culture_plate", "well_id").alias("wells"))


def allocated_wells(clones: DataFrame, wells_per_plate: int) -> DataFrame:
    """Wells of each block if every plate's wells are dealt over its blocks as its clones tell."""
    seen = clones.groupBy("culture_plate", "block").agg(F.count_distinct("well_id").alias("n")).withColumn("seats_total", F.lit(wells_per_plate))
    return apportioned(seen, ["culture_plate"], "block", "n", "seats_total").groupBy("block").agg(F.sum("seats").alias("wells"))


def sequences_per_well(clones: DataFrame, culture_plates: int, wells_per_plate: int, maximum: int = 3) -> DataFrame:
    """Histogram of distinct sequences per allocated well, empty wells counted by what is left."""
    own = clones.groupBy("culture_plate", "well_id").agg(F.least(F.count_distinct("sequence_id"), F.lit(maximum)).cast("int").alias("sequences"))
    held = own.groupBy("sequences").agg(F.count(F.lit(1)).alias("wells"))
    none = held.agg((F.lit(culture_plates * wells_per_plate) - F.coalesce(F.sum("wells"), F.lit(0))).alias("wells")).select(F.lit(0).alias("sequences"), "wells")
    return held.where("sequences > 0").union(none)


def clone_outcome() -> Column:
    return F.coalesce("insert_class", mapped(F.col("grade"), GRADE_OUTCOME))


def best_outcomes(observed: DataFrame, outcome: Column) -> DataFrame:
    """The best outcome of each design_key; observations without one are left out."""
    rank = outcome_rank(outcome)
    return observed.where(rank > 0).groupBy("design_key").agg(ranked_outcome(F.min(rank)).alias("outcome"))


def population_fractions(observed: DataFrame, outcome: Column) -> DataFrame:
    """Percentage of observations at each outcome, zeros too."""
    spark = observed.sparkSession
    counted = observed.select(outcome.alias("outcome")).where("outcome is not null").groupBy("outcome").count()
    every = spark.range(1).select(F.explode(F.array(*map(F.lit, OUTCOMES))).alias("outcome"))
    total = F.sum(F.coalesce("count", F.lit(0))).over(Window.partitionBy(F.lit(0)))  # a row for each outcome
    return every.join(counted, "outcome", "left").select("outcome", F.coalesce("count", F.lit(0)).alias("n"), F.when(total > 0, 100.0 * F.coalesce("count", F.lit(0)) / total).otherwise(0.0).alias("percent"))


def identity_summary(rows: DataFrame, keys: list[str], identity: str = "identity") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(identity).alias("mean"), F.percentile(identity, 0.5).alias("median"), F.avg((F.col(identity) == 1).cast("double")).alias("exact_fraction"))


def hash_sample(rows: DataFrame, depths: DataFrame, keys: list[str], uid: str, seed: int) -> DataFrame:
    """So many rows of each stratum without replacement, by a hash of their names."""
    order = Window.partitionBy(*keys).orderBy(F.sha2(F.concat(F.col(uid).cast("string"), F.lit(f":{seed}")), 256), uid)
    return rows.join(depths, keys).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= F.col("depth")).drop("_rank", "depth")


# Encodings


def rarefaction(weights: DataFrame, keys: list[str], total: str, draws: list[int]) -> DataFrame:
    """Designs expected in each number of draws, for designs found in so many of total wells (keys, weight, total)."""
    rows = weights.withColumn("drawn", F.explode(F.array(*map(F.lit, draws))))
    return rows.groupBy(*keys, "drawn").agg(F.sum(F.when(F.col("drawn") >= F.col(total), 1.0).otherwise(rarefied(F.col("drawn"), F.col(total), F.col("weight")))).alias("expected"))


def outcome_matrix(a: DataFrame, b: DataFrame, kinds: list[str]) -> DataFrame:
    """Designs by outcome in encoding A (rows) and B (columns), and what independence would give."""
    rank = lambda side, name: side.select("design_key", F.col("outcome").alias(name))
    both = rank(a, "a").join(rank(b, "b"), "design_key", "full").fillna("absent", ["a", "b"])
    counted = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))  # a row for each pair of outcomes
    expected = F.sum("n").over(Window.partitionBy("a")) * F.sum("n").over(Window.partitionBy("b")) / F.sum("n").over(every)
    return counted.withColumn("expected", expected).where(F.col("a").isin(*kinds) & F.col("b").isin(*kinds))


def structural_sets(a: DataFrame, b: DataFrame, universe: DataFrame) -> DataFrame:
    """Designs of only one encoding, of both and of neither, in one row."""
    told = universe.select("design_key").distinct()
    for side, name in ((a, "in_a"), (b, "in_b")):
        told = told.join(side.select("design_key").distinct().withColumn(name, F.lit(True)), "design_key", "left")
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    n = lambda when: F.count_if(when)
    return told.agg(n(has("in_a") & ~has("in_b")).alias("only_a"), n(has("in_b") & ~has("in_a")).alias("only_b"), n(has("in_a") & has("in_b")).alias("both"), n(~has("in_a") & ~has("in_b")).alias("neither"))


def gain_decomposition(sampled_a: Column, sampled_union: Column, ever_a: Column, ever_union: Column, universe: Column) -> Column:
    """Points gained by the second encoding as sampled, those its own designs explain, and the rest (oversampling)."""
    headline = 100.0 * (sampled_union - sampled_a) / universe
    structural = 100.0 * (ever_union - ever_a) / universe
    return F.struct(headline.alias("headline"), structural.alias("structural"), (headline - structural).alias("oversampling"))


def permutation_test(rows: DataFrame, value: str, label: str, trials: int, seed: int) -> DataFrame:
    """One-sided p of the difference in means (label true less label false) when labels are dealt anew.

    The rows are repeated once for each trial and dealt by a hash order: counted by ranges of the hash, only the one range in
    which the labels run out is sorted. Rows are told apart by their values and a number among equal ones."""
    own = rows.select(F.col(value).cast("double").alias("v"), F.col(label).cast("boolean").alias("l"))
    ones = own.agg(F.count_if("l").alias("ones"), (F.avg(F.when(F.col("l"), F.col("v"))) - F.avg(F.when(~F.col("l"), F.col("v")))).alias("observed"))
    # equal rows are one with a count until they are dealt
    counted = own.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    single = counted.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("v", "i")
    dealt = single.withColumn("trial", F.explode(F.sequence(F.lit(1), F.lit(trials)))).withColumn("h", F.xxhash64("trial", "v", "i", F.lit(seed)))
    dealt = dealt.withColumn("bucket", F.shiftright("h", 64 - HASH_BITS))
    sums = dealt.groupBy("trial", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("sum"))
    order = Window.partitionBy("trial").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # 2 ** HASH_BITS rows
    placed = sums.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).join(F.broadcast(ones.select("ones")))
    whole = placed.where(F.col("before") + F.col("n") <= F.col("ones")).groupBy("trial").agg(F.sum("n").alias("taken"), F.sum("sum").alias("sum"))
    split = placed.where((F.col("before") < F.col("ones")) & (F.col("before") + F.col("n") > F.col("ones"))).select("trial", "bucket", (F.col("ones") - F.col("before")).alias("room"))
    inside = dealt.join(F.broadcast(split), ["trial", "bucket"]).withColumn("place", F.row_number().over(Window.partitionBy("trial").orderBy("h", "v", "i")))
    part = inside.where(F.col("place") <= F.col("room")).groupBy("trial").agg(F.count(F.lit(1)).alias("taken"), F.sum("v").alias("sum"))
    took = whole.unionByName(part).groupBy("trial").agg(F.sum("taken").alias("taken"), F.sum("sum").alias("sum"))
    total = own.agg(F.count("v").alias("all_n"), F.sum("v").alias("all_sum"))
    each = took.join(F.broadcast(total)).join(F.broadcast(ones)).withColumn("difference", F.col("sum") / F.col("taken") - (F.col("all_sum") - F.col("sum")) / (F.col("all_n") - F.col("taken")))
    return each.agg(F.first("observed").alias("observed"), ((F.count_if(F.col("difference") >= F.col("observed") - 1e-12) + 1) / (F.lit(trials) + 1)).alias("p"))

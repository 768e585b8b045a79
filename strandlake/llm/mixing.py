"""Mixing by iterative proportional fitting, in DataFrame operations only.

Documents are counted in cells of source, language and topic, weighted by their
tokens. The cells' weights are raked to the target marginals of the three in
turn, until no marginal is further than TOLERANCE of all weight from its target or
for SWEEPS rounds; targets that no weights meet are logged, or an error if asked for.
Documents are then kept with the probability that gives each cell its share of a
budget (FRACTION of all tokens); a cell that holds less than its share keeps
everything and the others share the rest of the budget. The draw is a hash of the id
and a seed, so it is the same on every run. At most FEW_CELLS cells are raked in one
task; more by aggregates and joins, a written table after each step.

Unless targets are given they are the observed shares to the power TEMPERATURE,
scaled to 1: large sources give way to small ones. The topic is the form of the
text: ``table``, ``marked`` (symbols in a row) or ``prose``.

Nulls: null texts have no tokens, null sources, languages and ids count as "".
Cells without tokens keep everything. Target values that no cell has are left
out, values without a target get none and are dropped (probability 0). Repeated
rows share one draw. Columns of the input stay; one that has the name of an added
column (ADDED) is renamed <name>_input. Empty tables give empty results.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, release, stash, table

DIMENSIONS = ("mix_source", "mix_lang", "mix_topic")
ADDED = (*DIMENSIONS, "mix_tokens", "mix_weight", "mix_keep", "mix_selected")
SWEEPS = 48
SWEEPS_AT_ONCE = 8
TOLERANCE = 1e-10
TEMPERATURE = 0.7
FRACTION = 0.9
SEED = 17
#: More cells than this are joined by a shuffle and raked in several tasks (a cell is 100 bytes or so).
FEW_CELLS = 100_000


def topic_of(text: Column) -> Column:
    return F.when(F.contains(text, F.lit(" | ")), "table").when(F.regexp_like(text, F.lit("[#*$%&|<>]{2}")), "marked").otherwise("prose")


def with_cells(df: DataFrame, text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None) -> DataFrame:
    """Add mix_source, mix_lang, mix_topic and mix_tokens; input columns of the names that mix() adds become <name>_input."""
    for name in ADDED:
        if name in df.columns:
            other = f"{name}_input"
            while other in df.columns:
                other += "_"
            df = df.withColumnRenamed(name, other)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    words = F.size(F.filter(F.split(text, f"{SPACE}+"), lambda w: w != ""))
    return df.withColumns({"mix_source": name(source_col), "mix_lang": name(lang_col), "mix_topic": topic_of(text) if topic is None else F.coalesce(topic, F.lit("")), "mix_tokens": words.cast("long")})


def observed_targets(cells: DataFrame, dim: str, temperature: float = TEMPERATURE) -> DataFrame:
    """Value and target share of one dimension."""
    share = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).withColumn("p", F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), temperature)).otherwise(0.0))
    return _scaled(share.select(dim, F.col("p").alias(f"{dim}_target")), f"{dim}_target")


def _scaled(df: DataFrame, name: str) -> DataFrame:
    """df with a column divided by its sum (one row)."""
    total = df.agg(F.sum(name).alias("mix_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(name, F.col(name) / F.col("mix_total")).drop("mix_total")


def _fitted(cells: DataFrame, dim: str, few: bool) -> DataFrame:
    """One step: the weights of each value of a dimension scaled to its target."""
    goal = F.col(f"{dim}_target")
    if few:  # in the one task that holds the cells
        held = F.sum("weight").over(Window.partitionBy(dim))
        return cells.withColumn("weight", F.when(held > 0, F.col("weight") * goal / held).otherwise(0.0))
    sums = cells.groupBy(dim).agg(F.sum("weight").alias("mix_held"))
    joined = cells.join(sums, dim)
    return joined.withColumn("weight", F.when(F.col("mix_held") > 0, F.col("weight") * goal / F.col("mix_held")).otherwise(0.0)).drop("mix_held")


def largest_gap(raked: DataFrame) -> float:
    """How far the worst marginal is from its target, as a share of all weight."""
    gaps = [raked.groupBy(dim).agg(F.abs(F.sum("weight") - F.max(f"{dim}_target")).alias("gap")).agg(F.max("gap")).first()[0] for dim in DIMENSIONS]
    return max((g for g in gaps if g is not None), default=0.0)


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE, strict: bool = False, few_cells: int = FEW_CELLS) -> DataFrame:
    """cells with weight: the raked share of each cell. Targets hold a value once. Sweeps end when no marginal is further
    than the tolerance from its target; if that is not reached (no weights meet all targets), strict raises, else it is logged."""
    few = cells.limit(few_cells + 1).count() <= few_cells
    now = cells
    for dim in DIMENSIONS:
        goal = _scaled(targets[dim].join(cells.select(dim).distinct(), dim), f"{dim}_target")  # values that no cell has are left out
        now = now.join(goal, dim, "left").withColumn(f"{dim}_target", F.coalesce(f"{dim}_target", F.lit(0.0)))
    now = stash(now.withColumn("weight", F.col("tokens").cast("double")), "mixing-cells")
    done, gap = 0, float("inf")
    while done < sweeps and gap > tolerance:
        turns = min(SWEEPS_AT_ONCE, sweeps - done) if few else 1
        step = now.coalesce(1) if few else now
        for dim in DIMENSIONS * turns:
            step = _fitted(step, dim, few)
            if not few:
                step = stash(step, "mixing-step")
                release(now)
                now = step
        if few:
            step = stash(step, "mixing-raked")
            release(now)
            now = step
        done, gap = done + turns, largest_gap(now)
    if gap > tolerance:
        message = f"raking: after {done} sweeps a marginal is {gap:.2e} of all weight from its target"
        if strict:
            raise ValueError(message)
        logging.getLogger(__name__).warning(message)
    return now


def keep_shares(raked: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Add keep: the probability of a cell's documents, so that the cells hold their weights of the budget.

    A level of weight to tokens is sought at which cells that have too few tokens are full and all others share the rest; it
    rises from a first guess until no more cells are full. raked is a written table."""
    weighty = F.col("weight") > 0
    sums = lambda when: (F.coalesce(F.sum(F.when(when, F.col("tokens"))), F.lit(0)), F.coalesce(F.sum(F.when(when, F.col("weight"))), F.lit(0.0)))
    every, (open_tokens, total) = raked.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0], raked.agg(*sums(weighty)).first()
    budget, level, last = min(fraction * every, float(open_tokens)), 0.0, -1
    full_tokens, full_weight = 0, 0.0
    while full_tokens != last and total - full_weight > 1e-12 * total:
        level, last = (budget - full_tokens) / (total - full_weight), full_tokens
        full_tokens, full_weight = raked.agg(*sums(weighty & (F.col("tokens") <= level * (1 + 1e-12) * F.col("weight")))).first()
    share = F.when((F.col("tokens") == 0) | (weighty & (F.col("tokens") <= level * (1 + 1e-12) * F.col("weight"))), 1.0).when(~weighty, 0.0).otherwise(level * F.col("weight") / F.col("tokens"))
    return raked.select(*DIMENSIONS, "tokens", (F.col("weight") / F.lit(total)).alias("mix_weight"), share.alias("mix_keep"))


def draw(id_col: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the id and the seed: 52 bits of their MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", targets: dict[str, DataFrame] | None = None, fraction: float = FRACTION, temperature: float = TEMPERATURE, seed: int = SEED, topic: Column | None = None, strict: bool = False, few_cells: int = FEW_CELLS) -> DataFrame:
    """df with mix_source, mix_lang, mix_topic, mix_tokens, mix_weight (of the cell), mix_keep and mix_selected."""
    marked = with_cells(df, text_col, source_col, lang_col, topic)
    cells = stash(marked.groupBy(*DIMENSIONS).agg(F.sum("mix_tokens").alias("tokens")), "mixing-counts")
    goals = targets or {dim: observed_targets(cells, dim, temperature) for dim in DIMENSIONS}
    shares = stash(keep_shares(rake(cells, goals, strict=strict, few_cells=few_cells), fraction).drop("tokens"), "mixing-shares")
    few = shares.limit(few_cells + 1).count() <= few_cells
    joined = marked.join(F.broadcast(shares) if few else shares, list(DIMENSIONS))
    return joined.withColumn("mix_selected", draw(F.col(id_col), seed) < F.col("mix_keep"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    mixed = mix(docs)
    return mixed.select("doc_id", F.col("mix_source").alias("source"), F.col("mix_lang").alias("lang"), F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"), F.round("mix_weight", 6).alias("cell_weight"), F.round("mix_keep", 6).alias("keep_prob"), F.col("mix_selected").alias("selected"))

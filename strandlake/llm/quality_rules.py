"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Each text gets counts (words, word characters, symbols, repeated lines, words in
repeated windows, words that end in several marks) and from them the scores of
RULES. The cut-offs of all rules tighten together along a fixed path of steps. For
every stratum the labelled documents say how many good ones a step would reject,
and the exact binomial tail whether a false rejection rate above RISK would have
shown more. Steps are tested from the mildest on and testing stops at the first that
fails (fixed sequence); the level is divided by the number of strata (Bonferroni).
So with confidence 1 - LEVEL no stratum loses more than RISK of those of its good
documents that pass the base rule. A stratum needs ln(LEVEL / strata) / ln(1 - RISK)
good labelled documents (217 for four strata) before the mildest step can hold; one
with fewer gets no cut-off and loses nothing beyond the base rule.

Nulls: a null text has no words and fails the base rule; a null stratum is a
stratum of its own ("" stands for it); labels with a null id or null quality are
ignored; an id labelled several times is good if any label says so. Repeated
document rows give one row each (a labelled one counts once). Other columns are
dropped; empty tables give empty results, without labels nothing but the base
rule rejects.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import PLACE, SPACE, by_rows, let, on_files, place, release, stash, table, whole_rows

SYMBOLS = "#*$%&|<>"
WINDOW = 5
RISK = 0.02
LEVEL = 0.05
#: Score above the cut-off: rejected. A column of cut-offs is a step of the path, from the mildest to the strictest.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.8, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05),
    "dup_line_share": (0.8, 0.6, 0.5, 0.4, 0.35, 0.3, 0.2, 0.15, 0.1),
    "repeat_share": (0.19, 0.18, 0.17, 0.15, 0.13, 0.12, 0.1, 0.07, 0.05),
    "shout_share": (0.8, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05),
}
#: What a shouted word ends in, twice or more.
MARKS = "!?."
#: Strata beyond this many are joined by a shuffle instead of a broadcast.
BROADCAST_STRATA = 10_000
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text."""
    windows = F.size(words) - (WINDOW - 1)

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), windows - 1), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def covered(h: Column) -> Column:
        # windows as (hash, start), sorted: equal hashes are neighbours
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            n = F.size(s)
            same = lambda k: ((k > 0) & (F.get(s, k - 1)["h"] == F.get(s, k)["h"])) | ((k < n - 1) & (F.get(s, k + 1)["h"] == F.get(s, k)["h"]))
            return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), n - 1), same), lambda k: F.get(s, k)["i"]))

        def length(at: Column) -> Column:
            # each start covers WINDOW words, or up to the next start
            steps = F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

        return let(let(pairs, starts), length)

    found = let(hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(windows < 2, F.lit(0)).otherwise(found).cast("long")


def text_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", extra: list[Column] | None = None) -> DataFrame:
    """doc_id, stratum, the five counts and the scores of RULES; with extra also file and at, which place() makes."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    staged = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"), text.alias("body"), *(extra or []))

    def counts(words: Column) -> Column:
        body = F.col("body")
        lines = F.filter(F.split(body, "\n", -1), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0)
        shouted = F.size(F.filter(words, lambda w: (F.length(w) > 2) & (F.translate(F.right(w, F.lit(2)), MARKS, "") == "")))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0), lambda acc, w: acc + F.length(w)).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            _repeated(words).alias("n_repeat_words"),
            shouted.cast("long").alias("n_shouted"),
        )

    words = F.filter(F.split("body", f"{SPACE}+"), lambda w: w != "")
    kept = PLACE if extra else []
    found = staged.select("doc_id", "stratum", *kept, let(words, counts).alias("c"))
    per = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    c = lambda name: F.col(f"c.{name}")
    return found.select(
        "doc_id",
        "stratum",
        *kept,
        c("n_words").alias("n_words"),
        c("word_chars").alias("word_chars"),
        c("n_symbols").alias("n_symbols"),
        c("lines.dup").alias("n_dup_lines"),
        c("n_repeat_words").alias("n_repeat_words"),
        per(c("n_symbols"), c("n_words")).alias("symbol_share"),
        per(c("lines.dup"), c("lines.n")).alias("dup_line_share"),
        per(c("n_repeat_words"), c("n_words")).alias("repeat_share"),
        per(c("n_shouted"), c("n_words")).alias("shout_share"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _log_factorial(n: Column) -> Column:
    """ln n!; the series is exact to 1e-13 from 10 on."""
    x = n.cast("double")
    small = F.element_at(F.array(*[F.lit(math.lgamma(i + 1)) for i in range(11)]), F.least(n, F.lit(10)).cast("int") + 1)
    y = x + 1
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    return F.when(n <= 10, small).otherwise(series)


def binomial_lower_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ B(n, p), for k <= p n: the terms fall from k downwards, so those beyond 40 deviations are nothing."""
    k, n = k.cast("long"), n.cast("long")
    top = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
    terms = F.least(k, F.ceil(40 * F.sqrt(n * (p * (1 - p)))) + 100)

    def add(acc: Column, i: Column) -> Column:
        j = k - i  # the term of j comes from that of j + 1
        term = acc["term"] * (j + 1) * (1 - p) / ((n - j) * p)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    one = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    rest = F.when(terms > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(terms, F.lit(1))), one, add)["sum"]).otherwise(F.lit(1.0))
    return F.exp(top + F.log(rest))


def rejects(cuts: dict[str, Column | float]) -> Column:
    """A score is above its cut-off (never if that is null)."""
    over = F.lit(False)
    for rule, cut in cuts.items():
        over = over | F.coalesce(F.col(rule) > cut, F.lit(False))
    return over


def calibrate(features: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL, rules: dict[str, tuple[float, ...]] = RULES, label_id: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """stratum, the steps of the path that hold, a cut-off for each rule (null: none can be justified), and the labels behind them."""
    good = labels.where(F.col(label_id).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(label_id).cast("long").alias("doc_id")).agg(F.max(label_col).alias("good"))
    passed = features.where(~base_failed()).join(good.where("good = 1").select("doc_id"), "doc_id")
    # of several texts with one id the one whose stratum and scores come first
    held = passed.groupBy("doc_id").agg(F.min(F.struct("stratum", *rules)).alias("x")).select("x.*")
    steps = len(next(iter(rules.values())))
    rejected = [F.count_if(rejects({rule: cuts[i] for rule, cuts in rules.items()})).alias(f"rejected_{i}") for i in range(steps)]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *rejected)
    tested = counts.withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))  # a row for each stratum
    passes = F.array(*[F.when(F.col(f"rejected_{i}") <= F.col("n_good") * risk, binomial_lower_tail(F.col(f"rejected_{i}"), F.col("n_good"), risk) <= F.lit(level) / F.col("strata")).otherwise(False) for i in range(steps)])
    failed = F.array_position(passes, False)
    last = F.when(failed == 0, F.lit(steps)).otherwise(failed - 1).cast("int")
    return tested.withColumn("steps", last).select("stratum", "n_good", "steps", *[F.get(F.array(*map(F.lit, cuts)), F.col("steps") - 1).alias(f"{rule}_cut") for rule, cuts in rules.items()])


def apply_rules(features: DataFrame, cuts: DataFrame, rules: dict[str, tuple[float, ...]] = RULES) -> DataFrame:
    """Features with base_failed and kept. cuts is a written table."""
    small = cuts.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA
    joined = features.join(F.broadcast(cuts) if small else cuts, "stratum", "left")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~(base_failed() | rejects({rule: F.col(f"{rule}_cut") for rule in rules})))


def judge(documents: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Features, base_failed and kept of every row of documents."""
    features = stash(text_features(documents, id_col, text_col, stratum_col), "quality-features")
    return apply_rules(features, stash(calibrate(features, labels, risk, level), "quality-cuts"))


def select_kept(documents: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of documents that the rules keep, with their own columns. Each text is judged once: its scores are
    written with its place, and the places of what is rejected come back to the texts."""
    documents = on_files(documents, "quality-documents")
    scores = stash(text_features(documents, id_col, text_col, stratum_col, place(documents)), "quality-features")
    go = stash(apply_rules(scores, stash(calibrate(scores, labels, risk, level), "quality-cuts")).where("not kept").select(*PLACE), "quality-go")
    release(scores)
    return by_rows(whole_rows(documents), go, PLACE, "left_anti").select("doc.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *FEATURES, "base_failed", "kept", F.round("symbol_share", 6).alias("symbol_share"), F.round("shout_share", 6).alias("shout_share"))

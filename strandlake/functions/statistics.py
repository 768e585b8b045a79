"""Binomial tails, log factorials, index-style medians and apportionment as Columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def log_factorial(n: Column) -> Column:
    """ln n!: a table up to 10, then Stirling's series (relative error under 1e-13)."""
    small = F.element_at(F.array(*[F.lit(math.lgamma(i + 1)) for i in range(11)]), F.greatest(F.least(n, F.lit(10)), F.lit(0)).cast("int") + 1)
    y = n.cast("double") + 1
    inverse = 1 / y
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + inverse / 12 - F.pow(inverse, 3) / 360 + F.pow(inverse, 5) / 1260 - F.pow(inverse, 7) / 1680
    return F.when(n <= 10, small).otherwise(series)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def binomial_upper_tail(successes: Column, trials: Column, probability: Column, terms: int = 400) -> Column:
    """P(X >= successes): the first term, then at most terms more by their ratio."""
    k, n = successes.cast("long"), trials.cast("long")
    first = log_choose(n, k) + k * F.log(probability) + (n - k) * F.log1p(-probability)
    count = F.least(n - k, F.lit(terms))
    odds = probability / (1 - probability)

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * (n - (k + i)) / (k + i + 1) * odds
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    total = F.when(count > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), F.greatest(count - 1, F.lit(0))), zero, add)["total"]).otherwise(1.0)
    tail = F.least(F.lit(1.0), F.exp(first + F.log(total)))
    return F.when(k <= 0, 1.0).when(k > n, 0.0).when(probability <= 0, 0.0).when(probability >= 1, 1.0).otherwise(tail)


def upper_median(values: Column) -> Column:
    """Element n // 2 of the sorted values."""
    ordered = F.array_sort(values)
    return F.get(ordered, F.floor(F.size(ordered) / 2).cast("int"))


def rarefied(drawn: Column, total: Column, weight: Column) -> Column:
    """Probability that a draw without replacement of so many of total shows an item of this weight."""
    room = total - weight
    return F.when(room < drawn, 1.0).otherwise(1 - F.exp(log_choose(room, drawn) - log_choose(total, drawn)))


def apportioned(shares: DataFrame, group: list[str], key: str, weight: str, seats: str) -> DataFrame:
    """Largest remainders: seats of each group dealt over its keys by weight, ties to the smaller key."""
    own = Window.partitionBy(*group)
    quota = F.col(seats) * F.col(weight) / F.sum(weight).over(own)
    whole = shares.withColumn("_quota", F.coalesce(quota, F.lit(0.0))).withColumn("_whole", F.floor("_quota").cast("long"))
    rest = whole.withColumn("_left", F.col(seats) - F.sum("_whole").over(own))
    place = F.row_number().over(own.orderBy((F.col("_quota") - F.col("_whole")).desc(), key))
    return rest.withColumn("seats", F.col("_whole") + F.when(place <= F.col("_left"), 1).otherwise(0)).drop("_quota", "_whole", "_left")

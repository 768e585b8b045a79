"""What the operators on vectors share: which rows count, and components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer components beyond this are taken as this; sums of them fit 38 digits.
CLIP = 1 << 62
#: Below this, squared distances of up to 64 components, and sums of 2^36 of them, fit 64 bits.
NARROW = 1 << 27
LONGEST = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """True where a vector is there and holds neither nulls nor NaN nor infinities."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def kept_vectors(df: DataFrame, vector_col: str, **others: str) -> DataFrame:
    """The rows with a finite vector: the columns named (new name = old name) and vector as doubles."""
    df = df.select(*[F.col(f"`{old}`").alias(new) for new, old in others.items()], F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    return df.where(finite(F.col("vector")))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, held within CLIP. A scale of a power of two makes this exact."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * float(scale)), -CLIP, CLIP).astype(np.int64)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls, each list of width values, as rows of an array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def exact(values: np.ndarray) -> np.ndarray:
    """64-bit integers where their squared distances fit, else Python integers."""
    if values.dtype == object or not values.size or max(-int(values.min()), int(values.max())) < NARROW:
        return values
    return values.astype(object)


def as_long(total: Column) -> Column:
    """A sum of decimals as a long, held at the largest long."""
    return F.when(total > F.lit(LONGEST), F.lit(LONGEST)).otherwise(total.cast("long"))

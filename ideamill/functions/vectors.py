"""Arithmetic on embedding vectors held as arrays of double."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ideamill.settings import VECTOR_SIZE


def vector_to_text(vector: Column) -> Column:
    """Comma-joined values; NULL for a NULL or all-NaN vector."""
    values = vector.cast("array<double>")
    some = F.exists(values, lambda x: ~F.isnan(x))
    text = F.transform(values, lambda x: F.coalesce(x.cast("string"), F.lit("NaN")))
    return F.when(some, F.array_join(text, ","))


def text_to_vector(text: Column) -> Column:
    """Values of a comma-joined text; a part that is no number becomes NULL."""
    return F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double"))


def mean_of_valid(vectors: list[Column], size: int = VECTOR_SIZE) -> Column:
    """Element-wise mean of the vectors that are not NULL and have the right length.

    A NaN is left out of the mean of its place; NULL when no vector is valid.
    """
    valid = F.filter(
        F.array(*[v.cast("array<double>") for v in vectors]), lambda v: F.size(v) == size
    )
    zeros = F.array_repeat(F.lit(0.0), size)

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x)

    def add_up(step) -> Column:
        return F.aggregate(valid, zeros, lambda acc, v: F.zip_with(acc, v, step))

    # Nearly all vectors are whole: their sums need no test per value.
    gaps = F.exists(valid, lambda v: F.exists(v, lambda x: ~usable(x)))
    plain = F.transform(add_up(lambda a, x: a + x), lambda s: s / F.size(valid))
    careful = F.zip_with(
        add_up(lambda a, x: F.when(usable(x), a + x).otherwise(a)),
        add_up(lambda a, x: F.when(usable(x), a + 1.0).otherwise(a)),
        lambda s, n: F.when(n > 0, s / n).otherwise(F.lit(float("nan"))))
    return F.when(F.size(valid) > 0, F.when(gaps, careful).otherwise(plain))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x
    )


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two vectors of the same length."""
    return F.sqrt(squared_distance(a, b))


def vector_digest(vector: Column) -> Column:
    """A 128-bit key of a vector without NULLs, so that copies meet without moving the vectors.

    Two hashes with different seeds: a generated loop over the values, much cheaper than a
    digest of their text.
    """
    values = vector.cast("array<double>")
    return F.concat_ws("-", F.hex(F.xxhash64(F.lit(1), values)),
                       F.hex(F.xxhash64(F.lit(2), values)))


def vector_sizes(df: DataFrame, group: list[str], vector: str) -> DataFrame:
    """Number of different vector lengths per group, and whether there is one only."""
    sizes = F.size(vector)
    return df.groupBy(*group).agg(
        F.count_distinct(sizes).alias("n_sizes"),
        F.min(sizes).cast("long").alias("min_size"),
        F.max(sizes).cast("long").alias("max_size"),
        (F.count_distinct(sizes) <= 1).alias("is_consistent"),
    )


def mean_vectors(df: DataFrame, keys: list[str], vector: str, output: str = "centroid",
                 weight: str | None = None) -> DataFrame:
    """Element-wise mean vector per group, summed map-side before the shuffle."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    value = array_to_vector(F.col(vector).cast("array<double>"))
    mean = Summarizer.mean(value, F.col(weight)) if weight else Summarizer.mean(value)
    return df.groupBy(*keys).agg(vector_to_array(mean).alias(output))

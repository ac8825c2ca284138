"""Group aggregates that turn rows into columns. All are combined map-side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ideamill.settings import MEMBERS_PER_CELL, USER_COLUMNS


def first_value(value: Column, order: list[str], tie: Column | None = None) -> Column:
    """Aggregate: the first non-NULL value in the given order.

    On a tie the smallest ``tie`` decides, by default the value itself.
    """
    rank = F.struct(*order, (value if tie is None else tie).alias("_tie"))
    return F.min_by(value, F.when(value.isNotNull(), rank))


def first_non_null(df: DataFrame, keys: list[str], columns: list[str],
                   order: list[str]) -> DataFrame:
    """Per group, the first non-NULL value of every column."""
    return df.groupBy(*keys).agg(*[first_value(F.col(c), order).alias(c) for c in columns])


def pivot_first(df: DataFrame, keys: list[str], category: str, order: list[str],
                outputs: Mapping[str, Mapping[str, str]], others: list[str] = (),
                ties: Mapping[str, str] = MappingProxyType({})) -> DataFrame:
    """Per group, the first non-NULL value of each category as a column.

    ``outputs`` maps a value column to {category: output column}; the categories are listed, so
    the schema does not depend on the data. ``others`` are kept as in ``first_non_null``.
    ``ties`` names a shorter column that breaks ties of a wide value column.
    """
    wide = [
        first_value(F.when(F.col(category) == name, F.col(value)), order,
                    F.col(ties[value]) if value in ties else None).alias(output)
        for value, columns in outputs.items() for name, output in columns.items()
    ]
    rest = [first_value(F.col(c), order).alias(c) for c in others]
    return df.groupBy(*keys).agg(*wide, *rest)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in the given order."""
    row = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    return df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(row).select("_row.*")


def rank_pivot(ranked: DataFrame, key: str, rank: str, value: str, name: str,
               columns: int = USER_COLUMNS) -> DataFrame:
    """Values of rank 1..n as columns ``name_1`` .. ``name_n``, always n columns."""
    return ranked.groupBy(key).agg(*[
        F.max(F.when(F.col(rank) == i, F.col(value))).alias(f"{name}_{i}")
        for i in range(1, columns + 1)
    ])


def members_json(ranked: DataFrame, key: str, rank: str, value: str, name: str,
                 output: str = "users", per_cell: int = MEMBERS_PER_CELL) -> DataFrame:
    """JSON objects ``{"name_1": v, ...}`` of the non-NULL members in rank order.

    A cell holds at most ``per_cell`` ranks; a larger group goes on in cells 1, 2, ..., so that
    no task or row ever holds an unbounded group.
    """
    member = F.struct(
        F.col(rank).alias("rank"),
        F.concat(F.lit(f"{name}_"), F.col(rank)).alias("key"),
        F.col(value).alias("value"),
    )
    cell = F.floor((F.col(rank) - 1) / per_cell).alias("cell")
    entries = F.transform(
        F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), member))),
        lambda m: F.struct(m["key"].alias("key"), m["value"].alias("value")),
    )
    return ranked.groupBy(key, cell).agg(F.to_json(F.map_from_entries(entries)).alias(output))


def cluster_count(rows: Column) -> Column:
    """Number of clusters for a group size: a tenth, half rounded to even, at least 1."""
    return F.greatest(F.lit(1), F.bround(rows / 10)).cast("long")

"""Joins on business keys.

No join carries a broadcast hint: the sides grow with the data, so Spark picks the join from
their sizes, and adaptive execution splits a hot key of the left side. The right sides are made
unique before they are joined, which also combines their hot keys map-side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ideamill.settings import HOT_GROUP_ROWS
from ideamill.sources.tables import written


def new_records(source: DataFrame, loaded: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows whose key is not in the loaded table (a NULL key counts as new)."""
    keys = [keys] if isinstance(keys, str) else keys
    return source.join(loaded.select(*keys).distinct(), keys, "left_anti")


def known_rows(source: DataFrame, known: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key is in the known table."""
    keys = known.select(*[F.col(theirs).alias(ours) for ours, theirs in on.items()])
    return source.join(keys.distinct(), list(on), "left_semi")


def left_join_many(left: DataFrame, right: DataFrame, keys: str | list[str],
                   hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Left join with a right side of many rows per key; both sides are read once.

    An outer join cannot split a hot key of its right side. Keys of more than ``hot_rows`` rows there are
    counted first, combined map-side. Their rows are dealt to parts by hash, and a left row of such a key
    meets every part; copies whose part holds none of the key's rows are dropped, as another part does.
    """
    keys = [keys] if isinstance(keys, str) else keys
    hot = right.groupBy(*keys).count().where(F.col("count") > hot_rows).select(
        *keys, F.ceil(F.col("count") / hot_rows).cast("int").alias("_parts"))
    if hot.isEmpty():
        return left.join(right, keys, "left")
    # One row per hot key: at most a hot_rows-th of the right side's rows.
    hot = written(hot, "hot-keys")
    row = F.xxhash64(*[f.name for f in right.schema.fields if not isinstance(f.dataType, MapType)])
    dealt = right.join(hot, keys, "left").withColumns({
        "_part": F.coalesce(F.pmod(row, "_parts").cast("int"), F.lit(0)), "_met": F.lit(True)}).drop("_parts")
    copies = left.join(hot, keys, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    joined = copies.join(dealt, [*keys, "_part"], "left").where(F.col("_parts").isNull() | F.col("_met"))
    return joined.drop("_part", "_parts", "_met")


def unique_lookup(lookup: DataFrame, keys: list[str], value: str, order: str | None = None
                  ) -> DataFrame:
    """One value per key: the one that comes last in ``order``, by default the highest."""
    last = F.max_by(value, F.struct(order, value)) if order else F.max(value)
    return lookup.groupBy(*keys).agg(last.alias(value))


def look_up(df: DataFrame, lookup: DataFrame, on: Mapping[str, str], value: str, output: str,
            default: Column | None = None, order: str | None = None, unique: bool = False
            ) -> DataFrame:
    """Add ``output``: the lookup's value for the key, or the default when it is missing.

    ``on`` maps columns of ``df`` to key columns of ``lookup``. Keys of the lookup are made
    unique first (see ``unique_lookup``), so no row is doubled; ``unique`` says that they are,
    as the surrogate key of a dimension is.
    """
    keys = list(on.values())
    table = lookup if unique else unique_lookup(lookup, keys, value, order)
    side = table.select(
        *[F.col(theirs).alias(f"_key_{ours}") for ours, theirs in on.items()],
        F.col(value).alias("_found"),
    )
    match = [F.col(ours) == F.col(f"_key_{ours}") for ours in on]
    found = F.col("_found") if default is None else F.coalesce(F.col("_found"), default)
    kept = [F.col(c) for c in df.columns if c != output]
    return df.join(side, match, "left").select(*kept, found.alias(output))


def left_join_on(df: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on differently named keys; the right key is dropped."""
    return df.join(right, df[left_key] == right[right_key], "left").drop(right[right_key])


def update_column(table: DataFrame, updates: DataFrame, key: str, column: str,
                  order: str | None = None) -> DataFrame:
    """The table with ``column`` replaced where the updates hold a value for the key."""
    fresh = look_up(table, updates, {key: key}, column, "_fresh", order=order)
    return fresh.withColumn(column, F.coalesce("_fresh", column)).drop("_fresh")

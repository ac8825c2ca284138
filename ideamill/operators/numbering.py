"""Running numbers and surrogate keys without a group in one task.

A window puts a whole group in one task. Groups are counted first (map-side combined); when one
is above ``hot_rows`` the rows are placed by key range instead, numbered inside each range, and
moved up by the number of rows of the same group in earlier ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ideamill.settings import (
    CHUNK_ROWS, EXPORT_BATCH, HOT_GROUP_ROWS, NUMBERED_CATEGORIES, task_count,
)
from ideamill.sources.tables import written

COPY_BLOCK = 10_000  # equal rows written out by one task at a time
PLACE_BITS = 33  # monotonically_increasing_id: the partition is above bit 33


def _tie_columns(df: DataFrame, keys: list[str]) -> list[str]:
    """The columns that decide between rows of equal keys, so that no size changes a number."""
    return [f.name for f in df.schema.fields
            if f.name not in keys and not isinstance(f.dataType, MapType)]


def _placed(df: DataFrame, order: list[str], ties: list[str] = ()) -> DataFrame:
    """Rows sorted by ``order`` over all partitions, with their partition and place in it.

    ``ties`` order the rows of equal keys, which lie in one partition. The written table fixes the
    places: later jobs read them and never compute them again.
    """
    place = F.monotonically_increasing_id()
    return written(
        df.repartitionByRange(*order).sortWithinPartitions(*order, *ties)
        .withColumn("_place", place)
        .withColumn("_range", F.shiftright("_place", PLACE_BITS)), "numbered")


def _numbered_by_ranges(df: DataFrame, group: list[str], order: list[str],
                        name: str) -> DataFrame:
    ties = df.groupBy(*group, *order).count().where(F.col("count") > COPY_BLOCK)
    tied = not ties.isEmpty()
    rest = _tie_columns(df, group + order)
    if tied:
        # No range can split equal keys: the other columns split them too, and rows that are equal
        # in all columns are merged, counted and written out again at the end.
        source = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
        placed = _placed(source, group + order + rest)
    else:
        placed = _placed(df.withColumn("_copies", F.lit(1).cast("long")), group + order, rest)
    earlier_ranges = Window.partitionBy(*group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    # One row per group and range that meet: a hot group has as many as there are ranges.
    starts = (
        placed.groupBy(*group, "_range").agg(F.sum("_copies").alias("_n"), F.min("_place").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier_ranges), F.lit(0)))
        .select(*[F.col(g).alias(f"_g_{g}") for g in group],
                F.col("_range").alias("_r"), "_first", "_before")
    )
    same = F.col("_range") == F.col("_r")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    inside = F.col("_place") - F.col("_first")
    if tied:
        # A merged row stands for several places.
        earlier_places = Window.partitionBy(*group, "_range").orderBy("_place").rowsBetween(
            Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum("_copies").over(earlier_places), F.lit(0))
    started = placed.join(starts, same).withColumn("_inside", inside).select(
        *df.columns, "_copies", (F.col("_inside") + F.col("_before")).alias("_start"))
    if tied:
        return _spread_copies(started, df.columns, name)
    return started.select(*df.columns, (F.col("_start") + 1).cast("long").alias(name))


def _spread_copies(started: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One row per copy, numbered from ``_start`` + 1; many copies go over many tasks."""
    # A fixed number of tasks: a block is small before it is written out.
    whole = started.withColumn("_block", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPY_BLOCK)))
    ).repartition(task_count(started.sparkSession), "_start", "_block")
    first = F.col("_block") * COPY_BLOCK + 1
    last = F.least(F.col("_copies"), (F.col("_block") + 1) * COPY_BLOCK)
    copies = F.explode(F.sequence(first, last)).alias("_copy")
    return whole.select(*columns, "_start", copies).select(
        *columns, (F.col("_start") + F.col("_copy")).cast("long").alias(name))


def running_number(df: DataFrame, group: list[str], order: list[str], name: str,
                   hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Add 1, 2, 3, ... within each group. Ties in ``order`` go by the other columns in turn."""
    hot = df.groupBy(*group).count().where(F.col("count") > hot_rows)
    if not hot.isEmpty():
        return _numbered_by_ranges(df, group, order, name)
    window = Window.partitionBy(*group).orderBy(*order, *_tie_columns(df, group + order))
    return df.withColumn(name, F.row_number().over(window).cast("long"))


def global_number(df: DataFrame, order: list[str], name: str,
                  start: Column | int = 1) -> DataFrame:
    """Add ``start``, ``start`` + 1, ... over the whole table in the given order."""
    placed = _placed(df, order)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: bounded by the number of partitions.
    before = (
        placed.groupBy("_range").agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.join(F.broadcast(before), "_range").select(
        *df.columns, (inside + F.col("_before") + F.lit(start)).cast("long").alias(name))


def surrogate_keys(new: DataFrame, loaded: DataFrame, order: list[str], key: str = "id",
                   unique: bool = False) -> DataFrame:
    """Give new rows the keys after the highest loaded one, in the given order.

    With ``unique`` (``order`` is a unique key without NULLs) only the key columns are sorted and
    written; the numbers are joined back, and wide rows that are already placed by the key do not
    move again.
    """
    highest = loaded.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).first()["m"]
    start = int(highest) + 1
    if unique:
        numbers = global_number(new.select(*order), order, key, start)
        numbered = new.join(numbers, order)
    else:
        numbered = global_number(new, order, key, start)
    return numbered.select(key, *[c for c in new.columns if c != key])


def number_categories(df: DataFrame, company: str, category: str, order: list[str],
                      hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """'Problem' and 'Solution' become 'Problem 1', 'Problem 2', ... within a company."""
    numbered = running_number(df, [company, category], order, "_number", hot_rows)
    named = F.concat_ws(" ", F.col(category), F.col("_number"))
    return numbered.withColumn(
        category,
        F.when(F.col(category).isin(*NUMBERED_CATEGORIES), named).otherwise(F.col(category)),
    ).drop("_number")


def chunk_number(df: DataFrame, group: list[str], order: list[str], rows: int = CHUNK_ROWS,
                 hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Add ``chunk`` (runs of ``rows`` in a group, from 0) and ``position`` in it (from 0)."""
    numbered = running_number(df, group, order, "_number", hot_rows)
    place = F.col("_number") - 1
    return numbered.withColumns({
        "chunk": F.floor(place / rows), "position": place % rows,
    }).drop("_number")


def batch_number(df: DataFrame, order: list[str], rows: int = EXPORT_BATCH) -> DataFrame:
    """Add ``batch_no``: runs of ``rows`` over the whole table, from 0."""
    numbered = global_number(df, order, "_number", start=0)
    return numbered.withColumn("batch_no", F.floor(F.col("_number") / rows)).drop("_number")


def first_groups(df: DataFrame, group: list[str], n: int) -> DataFrame:
    """Rows of the first ``n`` groups in key order."""
    first = df.select(*group).distinct().orderBy(*group).limit(n)
    return df.join(first, group, "left_semi")


def values_before(answers: DataFrame, group: list[str], values: list[str],
                  chunk: str = "chunk") -> DataFrame:
    """``previous_<value>`` of each chunk, keyed by group and the chunk after it."""
    return answers.select(
        *group, (F.col(chunk) + 1).alias(chunk),
        *[F.col(v).alias(f"previous_{v}") for v in values])


def carry_forward(answers: DataFrame, group: list[str], values: list[str],
                  chunk: str = "chunk") -> DataFrame:
    """Add ``previous_<value>``: the value of the chunk before, NULL for the first.

    An equi-join on group and chunk, so that a group with many chunks is spread out.
    """
    return answers.join(
        values_before(answers, group, values, chunk), [*group, chunk], "left")

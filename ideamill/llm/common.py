"""Helpers of the training-data operators: reading, writing between steps, numbering of parts."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ideamill.settings import scratch_path

# Parts of one written table: offset tables hold one row per part, so this bounds what is broadcast.
MAX_PARTS = 65_536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(rows: int, per_part: int) -> int:
    """Parts of at most about per_part rows; more rows per part only beyond MAX_PARTS parts."""
    return max(1, min(MAX_PARTS, math.ceil(rows / per_part)))


def raw_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null counts as empty."""
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(binary).to_pylist()]


def part_id() -> int:
    return TaskContext.get().partitionId()


def starts_of_parts(totals: DataFrame, part: str, count: str, start: str) -> DataFrame:
    """(part, start): how many units lie in earlier parts. totals has one row per part, MAX_PARTS at most."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(start))

"""Readers and writers: parquet, JSON records, CSV and JDBC tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ideamill.settings import EXPORT_BATCH, scratch_path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Rows of a SQL text over the given tables, named in it as ``{name}``."""
    return spark.sql(query, **tables)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int,
              parts: int, **options: str) -> DataFrame:
    """A database table (or bracketed query with an alias), read in key ranges in parallel."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=str(low), upperBound=str(high),
        numPartitions=str(parts), **options).load()


def read_records(spark: SparkSession, path: str, schema: str, array_files: bool = False
                 ) -> DataFrame:
    """JSON records: one per line, or (``array_files``) one array per file.

    An array file is read by one task whole; land large exports as lines.
    """
    return spark.read.schema(schema).option("multiLine", array_files).json(path)


def write_records(df: DataFrame, path: str, run: date) -> None:
    """Land the rows of a run as JSON lines under its date; NULL fields are kept."""
    (df.withColumn("load_date", F.lit(run)).write.partitionBy("load_date")
     .option("ignoreNullFields", "false").mode("append").json(path))


def write_stage(df: DataFrame, path: str, run: date) -> None:
    """Write the rows of a run under its date, replacing an earlier try of the same run."""
    (df.withColumn("load_date", F.lit(run)).write.partitionBy("load_date")
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, read with column pruning.

    Later plans start from the files, so a lost executor cannot change what was written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str, columns: list[str]) -> None:
    """Append all rows, by column name."""
    df.select(*columns).write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, batch: int = EXPORT_BATCH, **options: str
                ) -> None:
    """Append to a database table in batches; a failed task is tried again by Spark."""
    df.write.format("jdbc").options(
        url=url, dbtable=table, batchsize=str(batch), **options).mode("append").save()


def read_sheet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option(
        "multiLine", True).option("escape", '"').csv(path)


def write_sheet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
